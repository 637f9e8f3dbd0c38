"""Merkle fixity audit of WARC replicas.

Records of a file are hashed; the hashes of the records that begin in one range of ``RANGE`` bytes make a
leaf, ``FAN`` neighbouring nodes make the next level's node, up to one root per file. Replicas are compared by
their roots; where they differ only the differing nodes' children are compared, down to the ranges, and
only the records of differing ranges are compared one by one. Inner levels are written once, so a lost
executor costs one level.

A null record is hashed as an empty one; records without a file form a file of their own; records without an offset lie
in the first range. Records of the same file and offset are ordered by hash and compared as a list. A file missing from one
replica differs in all its records. Equal replicas and empty tables give an empty result.
Other columns are not read. Column expressions, joins and aggregates only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmill.operators import ordering
from textmill.session import stored

RANGE = 1 << 16
FAN = 16
PER_FILE = 500
EMPTY = ["file", "node"]


def record_of(pages: DataFrame) -> Column:
    """A page as a WARC/1.0 resource record."""
    body = F.coalesce(F.col("html"), F.lit(""))
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(F.col("page_id").cast("string"), F.lit("none")),
        F.lit(">\r\nWARC-Target-URI: "),
        F.coalesce(F.col("url"), F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
        body,
        F.lit("\r\n\r\n"),
    )


def record_hashes(pages: DataFrame, per_file: int = PER_FILE, **more: Column) -> DataFrame:
    """Pages as records ``(file, offset, length, page_id, hash, *more)``, in the order of id and hash, in files of ids.

    ``more`` are columns made from ``record``, which is not shuffled itself. Offsets are running sums in two levels: rows of one id, or without an id, are spread by their hashes.
    """
    made = pages.select(
        F.coalesce(F.floor(F.col("page_id") / per_file), F.lit(-1)).cast("long").alias("file"), "page_id", record_of(pages).alias("record")
    )
    narrow = made.select("file", "page_id", F.octet_length("record").cast("long").alias("length"), F.sha2("record", 256).alias("hash"), *[c.alias(n) for n, c in more.items()])
    place = F.coalesce(F.pmod("page_id", F.lit(per_file)), F.lit(0)).cast("long")
    stretch = (place * 256 + F.conv(F.substring("hash", 1, 2), 16, 10).cast("long")).alias("_stretch")
    held = stored(narrow.select("*", stretch), "lengths")
    placed = ordering.running_totals(held, {"offset": F.col("length")}, order=["page_id", "hash"], bucket="_stretch", within=["file"])
    return placed.select("file", "offset", "length", "page_id", "hash", *more)


def warc_records(pages: DataFrame, per_file: int = PER_FILE) -> DataFrame:
    """Pages as WARC/1.0 resource records ``(file, offset, length, page_id, record)``, whole records in place."""
    return record_hashes(pages, per_file, record=F.col("record")).drop("hash")


def leaves(records: DataFrame) -> DataFrame:
    """``(file, offset, length, hash, node)`` of each record; ``node`` is its range. Rows without ``record`` are hashed already."""
    node = F.coalesce(F.floor(F.col("offset") / RANGE), F.lit(0)).cast("long")
    digest = F.sha2(F.coalesce(F.col("record"), F.lit("")), 256) if "record" in records.columns else F.col("hash")
    return records.select("file", "offset", "length", digest.alias("hash"), node.alias("node"))


def _combined(rows: DataFrame, node: Column, place: str) -> DataFrame:
    """A level of nodes: hash of the ordered places and hashes below."""
    below = F.sort_array(F.collect_list(F.struct(F.col(place).alias("p"), F.col("hash"))))
    text = F.array_join(F.transform(below, lambda x: F.concat(F.coalesce(x["p"].cast("string"), F.lit("")), F.lit(":"), x["hash"])), ",")
    return rows.groupBy("file", node.alias("node")).agg(F.sha2(text, 256).alias("hash"))


class Tree:
    """Levels of a replica: records, ranges, and up to the roots."""

    def __init__(self, records: DataFrame, name: str, height: int | None = None):
        self.records = stored(leaves(records), f"{name}_records")
        self.levels = [stored(_combined(self.records, F.col("node"), "offset"), f"{name}_ranges")]
        self.top = self.levels[0].agg(F.max("node")).first()[0] or 0
        while self.top // FAN ** (len(self.levels) - 1) > 0:
            self.raise_one(name)

    def raise_one(self, name: str) -> None:
        above = F.floor(F.col("node") / FAN).cast("long")
        self.levels.append(stored(_combined(self.levels[-1], above, "node"), f"{name}_level"))


def _differing(one: DataFrame, two: DataFrame) -> DataFrame:
    """Nodes ``(file, node)`` whose hashes differ or that only one replica has."""
    other = two.select(F.col("file").alias("_f"), F.col("node").alias("_n"), F.col("hash").alias("_h"))
    same = F.col("file").eqNullSafe(F.col("_f")) & (F.col("node") == F.col("_n"))
    met = one.join(other, same, "full").filter(~F.col("hash").eqNullSafe(F.col("_h")))
    side = F.col("hash").isNotNull()
    return met.select(F.when(side, F.col("file")).otherwise(F.col("_f")).alias("file"), F.coalesce("node", "_n").alias("node"))


def _children(level: DataFrame, parents: DataFrame, fan: int) -> DataFrame:
    above = parents.select(F.col("file").alias("_f"), F.col("node").alias("_n"))
    return level.join(above, F.col("file").eqNullSafe(F.col("_f")) & (F.floor(F.col("node") / fan) == F.col("_n")), "left_semi")


def audit(first: DataFrame, second: DataFrame) -> DataFrame:
    """``(file, offset, first_length, second_length, first_hash, second_hash, state)`` of every record that differs."""
    one, two = Tree(first, "first"), Tree(second, "second")
    while len(one.levels) < len(two.levels):
        one.raise_one("first")
    while len(two.levels) < len(one.levels):
        two.raise_one("second")
    bad = stored(_differing(one.levels[-1], two.levels[-1]), "roots")
    for level in range(len(one.levels) - 2, -1, -1):
        bad = stored(_differing(_children(one.levels[level], bad, FAN), _children(two.levels[level], bad, FAN)), "branches")
    nth = F.row_number().over(Window.partitionBy("file", "offset").orderBy("hash"))
    own = _children(one.records, bad, 1).withColumn("nth", nth)
    other = _children(two.records, bad, 1).withColumn("nth", nth)
    other = other.select(*[F.col(c).alias(f"_{c}") for c in ("file", "offset", "length", "hash", "nth")])
    same = F.col("file").eqNullSafe(F.col("_file")) & F.col("offset").eqNullSafe(F.col("_offset")) & (F.col("nth") == F.col("_nth"))
    met = own.join(other, same, "full").filter(~F.col("hash").eqNullSafe(F.col("_hash")))
    here = F.col("hash").isNotNull()
    state = F.when(F.col("_hash").isNull(), "missing").when(F.col("hash").isNull(), "extra").otherwise("changed")
    return met.select(
        F.when(here, F.col("file")).otherwise(F.col("_file")).alias("file"),
        F.when(here, F.col("offset")).otherwise(F.col("_offset")).alias("offset"),
        F.col("length").alias("first_length"),
        F.col("_length").alias("second_length"),
        F.col("hash").alias("first_hash"),
        F.col("_hash").alias("second_hash"),
        state.alias("state"),
    )


def damage(record: Column, page_id: Column) -> Column:
    """Losses at known places: one byte changed, a record cut short, a record gone (null)."""
    n = F.pmod(page_id, F.lit(400))
    changed = F.concat(F.substring(record, 1, 120), F.lit("~"), F.substr(record, F.lit(122)))
    kept = F.when(n == 3, changed).when(n == 57, F.substring(record, 1, 90)).otherwise(record)
    return F.when(F.coalesce(n != 211, F.lit(True)), kept)


def report(pages: DataFrame) -> DataFrame:
    """The pages as records, audited against a replica with losses at known places."""
    copy = damage(F.col("record"), F.col("page_id"))
    rows = record_hashes(pages, other_length=F.octet_length(copy).cast("long"), other_hash=F.sha2(copy, 256))
    rows = stored(rows, "records")
    other = rows.filter("other_hash IS NOT NULL").select("file", "offset", F.col("other_length").alias("length"), F.col("other_hash").alias("hash"))
    return audit(rows, other)


SQL = f"""
WITH body AS (
  SELECT page_id, floor(page_id / {PER_FILE})::BIGINT AS file, 'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10)
    || 'WARC-Record-ID: <urn:page:' || page_id || '>' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10)
    || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10)
    || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS record
  FROM pages
), records AS (
  SELECT *, coalesce(sum(strlen(record)) OVER (PARTITION BY file ORDER BY page_id, record ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset"
  FROM body
), pairs AS (
  SELECT file, "offset", record AS a, CASE page_id % 400
      WHEN 3 THEN substr(record, 1, 120) || '~' || substr(record, 122)
      WHEN 57 THEN substr(record, 1, 90)
      WHEN 211 THEN NULL ELSE record END AS b
  FROM records
)
SELECT file, "offset", strlen(a)::BIGINT AS first_length, strlen(b)::BIGINT AS second_length, sha256(a) AS first_hash, sha256(b) AS second_hash,
  CASE WHEN b IS NULL THEN 'missing' ELSE 'changed' END AS state
FROM pairs WHERE a IS DISTINCT FROM b
"""
