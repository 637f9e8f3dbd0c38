from textmill.llm import warc_fixity as W


def got(frame):
    return sorted((tuple(r) for r in frame.select("file", "offset", "state").collect()), key=repr)


def test_damage_is_located(spark):
    rows = [(f, k * 40_000, 40_000, f"{f}-{k} " * 3) for f in range(3) for k in range(60)] + [(9, 50_000_000, 5, "far")]
    schema = "file long, offset long, length long, record string"
    first = spark.createDataFrame(rows, schema).repartition(4)
    assert W.audit(first, first).count() == 0
    other = [r for r in rows if r[:2] != (1, 80_000) and r[0] != 9]
    other = [(f, o, n, t + "!" if (f, o) == (0, 0) else t) for f, o, n, t in other] + [(2, 10**9, 3, "new")]
    assert got(W.audit(first, spark.createDataFrame(other, schema))) == sorted(
        [(0, 0, "changed"), (1, 80_000, "missing"), (9, 50_000_000, "missing"), (2, 10**9, "extra")], key=repr
    )


def test_odd_rows(spark):
    schema = "file long, offset long, length long, record string, hash int"
    rows = [(None, 0, 1, "a", 1), (1, None, 1, "b", 1), (1, 5, 1, None, 1), (1, 5, 1, "", 1), (1, 7, 2, "same", 1), (1, 7, 2, "same", 1), (2, 0, 9, "z" * 2_000_000, 1)]
    one = spark.createDataFrame(rows, schema)
    assert W.audit(one, one).count() == 0
    assert got(W.audit(one, spark.createDataFrame(rows[1:-1], schema))) == sorted([(None, 0, "missing"), (2, 0, "missing")], key=repr)
    assert got(W.audit(one, spark.createDataFrame(rows[:5] + rows[6:], schema))) == [(1, 7, "missing")]
    assert W.audit(one.limit(0), one.limit(0)).count() == 0 and W.audit(one, one.limit(0)).count() == 7


def test_records(spark):
    pages = spark.createDataFrame([(1, "http://a/é", "é<p>"), (2, None, None), (501, "u", "x"), (None, "v", "y")], "page_id long, url string, html string")
    rows = sorted(W.warc_records(pages).collect(), key=lambda r: (r.file, r.offset))
    assert [(r.file, r.offset) for r in rows] == [(-1, 0), (0, 0), (0, rows[1].length), (1, 0)]
    raw = rows[1].record.encode()
    head, _, body = raw.partition(b"\r\n\r\n")
    assert raw.startswith(b"WARC/1.0\r\n") and len(raw) == rows[1].length and b"Content-Length: 5" in head and body == "é<p>\r\n\r\n".encode()
    assert W.warc_records(pages.limit(0)).count() == 0


def test_hot_and_null_ids(spark):
    """Offsets of many rows of one id, or of none, are gapless."""
    rows = [(None, f"u{i}", "a" * (i % 7)) for i in range(300)] + [(7, f"u{i}", "b" * (i % 5)) for i in range(300)] + [(8, "u", "c")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    ends = {}
    for r in sorted(W.record_hashes(pages).collect(), key=lambda r: (r.file, r.offset)):
        assert r.offset == ends.get(r.file, 0)
        ends[r.file] = r.offset + r.length
    assert sorted(ends) == [-1, 0]
    found = W.report(pages)
    assert found.count() == 0 and W.report(pages.limit(0)).count() == 0
