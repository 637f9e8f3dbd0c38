"""Text to token ids and back, as joins of pieces with a vocabulary.

A document is cut into pieces, the pieces are looked up and the ids are put together again per document. Vocabularies
(but for corpora of up to about a megabyte, or of unknown size, a broadcast join) and rank tables are looked up by an Arrow
function where the pieces are, which are then never rows that would be sorted or spilled. So are ids when they are turned back to text. Documents are partitioned by their id
first: the text, far smaller than its pieces, is what is shuffled; ids are put together where they were looked up.
``partitioned=True`` says that they already are, as after :func:`textmill.sources.corpus.by_document`.

Pieces come together in two levels: those of a stretch of a document first, then the stretches' ids. A long text is
cut before its pieces are made, so that no row or group holds more pieces than a stretch has. Tables too large for
every task, or with a key more than once, are joined with rows of pieces.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill import tables
from textmill.functions import control
from textmill.functions import pieces as P
from textmill.functions.binding import once
from textmill.operators import vocabulary as V
from textmill.sources.corpus import UNKNOWN_BYTES, by_document, estimated_bytes

DICTIONARY_ROWS = 65_536
DICTIONARY_PIECE_BYTES = 128
STRETCH_CHARACTERS = 1 << 16
STRETCH_TOKENS = 1 << 16
LOOKED_UP_AT_ONCE = 1 << 20  # pieces or ids of a batch whose copies are in memory together
JOINED_BYTES = 1 << 20  # a corpus for whose pieces no Python worker is started


def _control_rows(spark, first_id: int, family: str) -> DataFrame:
    return control.control_tokens(spark, first_id).select(F.col(family).alias("piece"), "id")


def _together(docs: DataFrame, key: str, partitioned: bool) -> DataFrame:
    return docs if partitioned else by_document(docs, key)


def _piece_rows(
    docs: DataFrame, keys: Sequence[str], text: str, pattern: str, family: str
) -> DataFrame:
    """One row per piece, with its stretch; a document without pieces keeps one row without a piece."""
    stretches = P.text_stretches(F.col(text), STRETCH_CHARACTERS, pattern)
    cut = P.split_pieces_with_control(F.col("_part"), pattern, family)
    # projections of their own keep the generators inside generated code
    parts = docs.select(*keys, F.posexplode(stretches).alias("stretch", "_part"))
    return parts.select(*keys, "stretch", cut.alias("_pieces")).select(
        *keys, "stretch", F.posexplode_outer("_pieces").alias("pos", "piece")
    )


def _in_order(*values: str) -> Column:
    """Rows ``(pos, *values)`` of a group in order, rows without a first value left out."""
    part = F.when(F.col(values[0]).isNotNull(), F.struct("pos", *values))
    return F.sort_array(F.collect_list(part))


def _whole(parts: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``(*keys, value)``: the arrays of a document's stretches, one after the other."""
    listed = F.sort_array(F.collect_list(F.struct("stretch", value)))
    return parts.groupBy(*keys).agg(F.flatten(listed[value]).alias(value))


def _known(vocabulary: DataFrame, size: int, family: str) -> DataFrame:
    """``(piece, id)`` of a vocabulary and its control tokens."""
    controls = _control_rows(vocabulary.sparkSession, V.control_start(size), family)
    return vocabulary.select("piece", "id").unionByName(controls)


def _found(
    docs: DataFrame, known: DataFrame, keys: Sequence[str], text: str, pattern: str, family: str
) -> DataFrame:
    """Pieces with their ids; null for those outside the vocabulary."""
    known = V.checked_broadcast(known, F.octet_length("piece") + 16)
    return _piece_rows(docs, keys, text, pattern, family).join(known, "piece", "left")


def _small(table: DataFrame, key: str, size: Column) -> DataFrame | None:
    """The table, if every task can have it and each key is in it once; else None."""
    found = table.agg(
        F.sum(size).alias("bytes"), F.count(F.lit(1)).alias("rows"), F.count_distinct(key).alias("keys")
    ).first()
    return table if (found["bytes"] or 0) <= V.BROADCAST_BYTES and found["rows"] == found["keys"] else None


def _listed(frame: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``(*keys, _rows)``: the values of all rows of the keys, as a rule of one."""
    return frame.groupBy(*keys).agg(F.collect_list(F.struct(F.col(value).alias("_value"))).alias("_rows"))


def _by_stretch(listed: DataFrame, keys: Sequence[str], cut: Callable[[Column], Column]) -> DataFrame:
    """``(*keys, stretch, _parts)``: a row for each stretch of :func:`_listed` values, those of equal keys one after the other."""

    def stretches(parts: Column) -> Column:
        last = F.array_max(F.transform(parts, F.size)) - 1
        own = lambda k: F.transform(F.filter(parts, lambda part: F.size(part) > k), lambda part: part[k])
        return F.transform(F.sequence(F.lit(0), last), own)

    parts = once(F.transform("_rows", lambda row: cut(row["_value"])), stretches)
    return listed.select(*keys, F.posexplode(parts).alias("stretch", "_parts"))


def _stretch_pieces(
    docs: DataFrame, keys: Sequence[str], text: str, pattern: str, family: str
) -> DataFrame:
    """``(*keys, stretch, pieces)``: an array of pieces for each row that has the keys, as a rule for one."""
    cut = lambda value: P.text_stretches(value, STRETCH_CHARACTERS, pattern)
    parts = _by_stretch(_listed(docs, keys, text), keys, cut)
    pieces = F.transform("_parts", lambda part: P.split_pieces_with_control(part, pattern, family))
    return parts.select(*keys, "stretch", pieces.alias("pieces"))


def _looked_up(
    stretches: DataFrame, keys: Sequence[str], name: str, table: DataFrame, key: str, value: str, result: str, answer: Callable
) -> DataFrame:
    """``(*keys, name)`` of rows ``(*keys, stretch, arrays of arrays of keys)``, one inner array for each row of a group.

    Each row's keys are looked up in order of position, and the stretches of a document, which stand one after the other
    from 0 on, are put together where they are: nothing is shuffled. ``answer()`` makes, once a task, the function that gives the
    values of distinct keys that the table lacks. ``result`` is the kind of output, ``"ids"`` of lists joined, ``"raw"`` of
    bytes joined or ``"words"`` of pairs. Nested functions travel by value: executors need not have this package.
    """
    found = table.select(key, value).toArrow().combine_chunks()
    columns = [found[c].combine_chunks() if found[c].num_chunks != 1 else found[c].chunk(0) for c in (key, value)]
    shared = table.sparkSession.sparkContext.broadcast(columns)
    most, width = LOOKED_UP_AT_ONCE, len(keys)

    def looked_up(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        names, values = shared.value
        solved = answer()

        def ends_of(lengths):
            return np.concatenate([[0], np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))])

        def per_key(flat):
            """The value of each key of an array, which has no nulls."""
            coded = flat.dictionary_encode()
            place = pc.index_in(coded.dictionary, value_set=names)
            absent = pc.is_null(place)
            both = pa.concat_arrays([values.take(place.drop_null()), solved(coded.dictionary.filter(absent))])
            none = absent.to_numpy(zero_copy_only=False)
            where = np.where(none, (~none).sum() + np.cumsum(none) - 1, np.cumsum(~none) - 1)
            return both.take(pa.array(where[coded.indices.to_numpy(zero_copy_only=False)], pa.int64()))

        def whole(rows):
            lists = rows.flatten()
            flat = lists.flatten()
            lengths = pc.fill_null(pc.list_value_length(lists), 0)
            inner, outer = ends_of(lengths), ends_of(pc.list_value_length(rows))
            ends = inner[outer]
            if flat.null_count:
                there = pc.is_valid(flat).to_numpy(zero_copy_only=False)
                spot = np.flatnonzero(there)
                flat, ends = flat.drop_null(), np.concatenate([[0], np.cumsum(there)])[ends]
            else:
                spot = None
            got = per_key(flat)
            several = np.flatnonzero(np.diff(outer) > 1)
            if len(several):
                # rows of one key: their keys stand by position, then value
                order = np.arange(len(flat))
                at = order if spot is None else spot
                position = at - inner[np.searchsorted(inner, at, side="right") - 1]
                for i in several.tolist():
                    here = range(ends[i], ends[i + 1])
                    by = (lambda k: (position[k], got[k].as_py())) if result == "ids" else (lambda k: (position[k], flat[k].as_py()))
                    order[ends[i] : ends[i + 1]] = sorted(here, key=by)
                flat, got = flat.take(pa.array(order)), got.take(pa.array(order))
            if result == "words":
                return pa.StructArray.from_arrays([flat, got], names=["id", "word"]), ends
            inside = np.frombuffer(got.buffers()[1], np.int32)[got.offset : got.offset + len(got) + 1] if len(got) else np.zeros(1, np.int32)
            if result == "ids":
                return got.flatten(), (inside[ends] - inside[0]).astype(np.int64)
            data = np.frombuffer(got.buffers()[2] or b"", np.uint8)[inside[0] : inside[-1]]
            return pa.array(data), (inside[ends] - inside[0]).astype(np.int64)

        def rows_of(own, parts, cuts):
            """Rows of the keys ``own`` whose values lie in ``parts`` joined, between ``cuts``."""
            values = pa.concat_arrays(parts) if len(parts) != 1 else parts[0]
            cuts = pa.array(cuts - cuts[0], pa.int32())
            if result == "raw":
                data = pa.py_buffer(values.to_numpy().tobytes())
                made = pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, cuts.buffers()[1], data])
            else:
                made = pa.ListArray.from_arrays(cuts, values)
            return pa.RecordBatch.from_arrays([*own.columns, made], names=[*own.schema.names, name])

        own, held = None, []  # the document that may go on in the next rows
        for batch in batches:
            named, at, lists = batch.select(range(width)), batch.column(width).to_numpy(), batch.column(width + 1)
            inner = ends_of(pc.fill_null(pc.list_value_length(lists.flatten()), 0))
            size = inner[ends_of(pc.list_value_length(lists))]
            begin = 0
            while begin < len(batch):
                end = min(max(begin + 1, int(np.searchsorted(size, size[begin] + most, side="right")) - 1), len(batch))
                found_here, ends = whole(lists.slice(begin, end - begin))
                firsts = np.flatnonzero(at[begin:end] == 0)
                goes_on = int(firsts[0]) if len(firsts) else end - begin
                if goes_on:
                    held.append(found_here.slice(0, int(ends[goes_on])))
                if len(firsts):
                    if own is not None:
                        yield rows_of(own, held, np.array([0, sum(map(len, held))]))
                    if len(firsts) > 1:
                        inside = found_here.slice(int(ends[firsts[0]]), int(ends[firsts[-1]] - ends[firsts[0]]))
                        rows = pa.RecordBatch.from_arrays([c.take(pa.array(begin + firsts[:-1])) for c in named.columns], names=named.schema.names)
                        yield rows_of(rows, [inside], ends[firsts])
                    own, held = named.slice(begin + int(firsts[-1]), 1), [found_here.slice(int(ends[firsts[-1]]))]
                begin = end
        if own is not None:
            yield rows_of(own, held, np.array([0, sum(map(len, held))]))

    kinds = {"ids": "array<int>", "raw": "binary", "words": "array<struct<id: int, word: string>>"}
    types = [T.StructField(k, stretches.schema[k].dataType) for k in keys]
    made = T.StructField(name, T.DataType.fromDDL(kinds[result]))
    return stretches.mapInArrow(looked_up, T.StructType([*types, made]))


def _merged(ranks: DataFrame):
    """Pieces that are no token are merged from byte pairs."""
    shared = _shared_ranks(ranks)

    def answer():
        import pyarrow as pa
        import tiktoken

        # the pattern takes a piece as it comes: the cutting is done
        encoder = tiktoken.Encoding(
            "ranks", pat_str=r"[\s\S]+", mergeable_ranks=shared.value, special_tokens={}
        )
        return lambda missing: pa.array(
            [encoder.encode_ordinary(piece) for piece in missing.to_pylist()], pa.list_(pa.int32())
        )

    return answer


def _bytes_of():
    """Pieces outside a vocabulary are their UTF-8 bytes."""

    def answer():
        import numpy as np
        import pyarrow as pa

        def solved(missing):
            whole = pa.concat_arrays([missing.cast(pa.binary())])
            _, ends, data = whole.buffers()
            ends = np.frombuffer(ends, np.int32)[whole.offset : whole.offset + len(whole) + 1] if len(whole) else np.zeros(1, np.int32)
            codes = np.frombuffer(data or b"", np.uint8)[ends[0] : ends[-1]].astype(np.int32)
            return pa.ListArray.from_arrays(pa.array(ends - ends[0]), pa.array(codes))

        return solved

    return answer


def _one_id(number: int):
    """Pieces outside a vocabulary are that id."""

    def answer():
        import pyarrow as pa

        return lambda missing: pa.array([[number]] * len(missing), pa.list_(pa.int32()))

    return answer


def encode_with_vocabulary(
    docs: DataFrame,
    vocabulary: DataFrame,
    size: int = tables.VOCABULARY_SIZE,
    keep: Sequence[str] = (),
    id_col: str = "doc_id",
    text: str = "text",
    pattern: str = "gpt2",
    family: str = "tiktoken",
    unknown: str = "bytes",
    partitioned: bool = False,
) -> DataFrame:
    """Encode by whole pieces: ``(id_col, *keep, tokens)``.

    ``vocabulary`` holds ``(piece, id)``, stored, from :func:`vocabulary.build_vocabulary`. Pieces
    outside it become their UTF-8 bytes, or the unknown token with ``unknown="token"``.
    """
    if unknown not in ("bytes", "token"):
        raise ValueError("unknown must be 'bytes' or 'token'")
    keys = [id_col, *keep]
    known = _known(vocabulary, size, family)
    docs = docs.select(*keys, text)
    together = _together(docs, id_col, partitioned)
    number = control.control_id("unknown", V.control_start(size))
    small = _small(known, "piece", F.octet_length("piece") + 52) if JOINED_BYTES < estimated_bytes(docs) < UNKNOWN_BYTES else None
    if small is not None:
        pieces = _stretch_pieces(together, keys, text, pattern, family)
        table = small.filter("id IS NOT NULL").select("piece", F.array(F.col("id").cast("int")).alias("ids"))
        answer = _one_id(number) if unknown == "token" else _bytes_of()
        return _looked_up(pieces, keys, "tokens", table, "piece", "ids", "ids", answer)
    found = _found(together, known, keys, text, pattern, family)
    if unknown == "token":
        found = found.withColumn(
            "id", F.when(F.col("piece").isNotNull(), F.coalesce("id", F.lit(number)))
        )
    ids = F.when(F.col("id").isNotNull(), F.array("id")).when(
        F.col("piece").isNotNull(), P.utf8_bytes(F.col("piece"))
    )
    parts = found.withColumn("ids", ids).groupBy(*keys, "stretch").agg(_in_order("ids").alias("parts"))
    flat = parts.select(*keys, "stretch", F.flatten(F.col("parts")["ids"]).alias("tokens"))
    return _whole(flat, keys, "tokens")


def vocabulary_sizes(
    docs: DataFrame,
    vocabulary: DataFrame,
    keep: Sequence[str] = (),
    id_col: str = "doc_id",
    text: str = "text",
    pattern: str = "gpt2",
    family: str = "tiktoken",
    size: int = tables.VOCABULARY_SIZE,
) -> DataFrame:
    """Number of tokens per document in byte mode, without building the tokens.

    Counting starts before the shuffle, so the documents stay where they are.
    """
    keys = [id_col, *keep]
    found = _found(docs, _known(vocabulary, size, family), keys, text, pattern, family)
    count = F.when(F.col("id").isNotNull(), 1).otherwise(
        F.coalesce(F.octet_length("piece"), F.lit(0))
    )
    return found.groupBy(*keys).agg(F.sum(count).cast("int").alias("size"))


def ranks_size(ranks: DataFrame) -> int:
    """Number of ids of a rank table: largest id plus one."""
    largest = ranks.agg(F.max("id").alias("id")).first()["id"]
    return 0 if largest is None else largest + 1


def _shared_ranks(ranks: DataFrame):
    """The rank table as a broadcast variable."""
    size = ranks.agg(F.sum(F.octet_length("token") + 16).alias("bytes")).first()["bytes"] or 0
    if size > V.BROADCAST_BYTES:
        raise ValueError(f"a rank table of {size} bytes is too large for every task")
    found = ranks.select("token", "id").toArrow().to_pydict()
    table = dict(zip(found["token"], found["id"]))
    if len(table) != len(found["id"]):
        raise ValueError("a token occurs more than once in the rank table")
    return ranks.sparkSession.sparkContext.broadcast(table)


def _merge_udf(ranks: DataFrame):
    """Arrow UDF: lists of pieces to lists of ids, by byte-pair merges.

    The rank table travels as a broadcast variable; every distinct piece of a batch is
    encoded once. The body imports what it needs, so executors do not have to have
    this package.
    """
    shared = _shared_ranks(ranks)

    def encode_batches(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import pandas as pd
        import tiktoken

        # the pattern takes a piece as it comes: the cutting is done
        encoder = tiktoken.Encoding(
            "ranks", pat_str=r"[\s\S]+", mergeable_ranks=shared.value, special_tokens={}
        )
        for lists in batches:
            codes, distinct = pd.factorize(lists.explode().dropna())
            encoded = [encoder.encode_ordinary(piece) for piece in distinct]
            lengths = lists.map(lambda pieces: 0 if pieces is None else len(pieces))
            yield pd.Series(
                [
                    [encoded[code] for code in codes[end - length : end]]
                    for end, length in zip(lengths.cumsum(), lengths)
                ]
            )

    encode_batches.__annotations__ = {
        "batches": Iterator[pd.Series],
        "return": Iterator[pd.Series],
    }
    return F.pandas_udf(encode_batches, "array<array<int>>")


def whole_piece_table(ranks: DataFrame) -> DataFrame:
    """Tokens of a rank table that are valid text, as ``(piece, ids)``."""
    text = F.col("token").cast("string")
    return ranks.filter(F.is_valid_utf8(text)).select(
        text.alias("piece"), F.array("id").alias("ids")
    )


def piece_dictionary(
    counts: DataFrame,
    ranks: DataFrame,
    rows: int = DICTIONARY_ROWS,
    max_bytes: int = DICTIONARY_PIECE_BYTES,
) -> DataFrame:
    """The most frequent pieces that are no token themselves, each encoded once.

    ``counts`` comes from :func:`vocabulary.piece_counts`. Rows and piece length are
    bounded, so the result can be broadcast; rarer and longer pieces are encoded where
    they occur.
    """
    whole = whole_piece_table(ranks).select("piece")
    split = (
        counts.filter(F.octet_length("piece") <= max_bytes)
        .join(V.checked_broadcast(whole, F.octet_length("piece") + 16), "piece", "left_anti")
        .orderBy(F.desc("occurrences"), "piece")
        .limit(rows)
    )
    merge = _merge_udf(ranks)
    return split.select("piece", merge(F.array("piece"))[0].alias("ids"))


def encode_with_ranks(
    docs: DataFrame,
    ranks: DataFrame,
    keep: Sequence[str] = (),
    id_col: str = "doc_id",
    text: str = "text",
    pattern: str = "gpt2",
    family: str = "tiktoken",
    dictionary: DataFrame | None = None,
    partitioned: bool = False,
    first_control_id: int | None = None,
) -> DataFrame:
    """Encode with a byte-pair rank table ``(token BINARY, id)``: ``(id_col, *keep, tokens)``.

    Pieces that are tokens, control tokens and the pieces of ``dictionary`` are
    looked up. Only the other pieces go through byte-pair merges, each distinct one of a part of an Arrow
    batch once, where they occur: they are not shuffled, so a frequent one is no hot key.
    Control ids begin at ``first_control_id``, by default after the ranks; give the number of ids of a
    model whose own special tokens stand above its ranks.
    """
    keys = [id_col, *keep]
    first = ranks_size(ranks) if first_control_id is None else first_control_id
    if first < ranks_size(ranks):
        raise ValueError("control ids would take ids of ranks")
    controls = _control_rows(docs.sparkSession, first, family).select(
        "piece", F.array("id").alias("ids")
    )
    known = whole_piece_table(ranks).unionByName(controls)
    if dictionary is not None:
        known = known.unionByName(dictionary.select("piece", "ids"))
    bytes_each = F.octet_length("piece") + 4 * F.size("ids") + 48
    together = _together(docs.select(*keys, text), id_col, partitioned)
    if (small := _small(known, "piece", bytes_each)) is not None:
        pieces = _stretch_pieces(together, keys, text, pattern, family)
        return _looked_up(pieces, keys, "tokens", small, "piece", "ids", "ids", _merged(ranks))
    known = V.checked_broadcast(known, bytes_each)
    looked_up = (
        _piece_rows(together, keys, text, pattern, family)
        .join(known, "piece", "left")
        .withColumn("miss", F.when(F.col("ids").isNull(), F.col("piece")))
    )
    grouped = looked_up.groupBy(*keys, "stretch").agg(
        _in_order("ids").alias("hits"), _in_order("miss").alias("misses")
    )
    merge = _merge_udf(ranks)
    merged = grouped.withColumn("merged", merge(F.col("misses")["miss"]))
    parts = F.concat(
        "hits",
        F.zip_with(
            F.col("misses")["pos"],
            "merged",
            lambda pos, ids: F.struct(pos.alias("pos"), ids.alias("ids")),
        ),
    )
    flat = merged.select(*keys, "stretch", F.flatten(F.sort_array(parts)["ids"]).alias("tokens"))
    return _whole(flat, keys, "tokens")


def add_document_ends(
    encoded: DataFrame, first_control_id: int, tokens: str = "tokens"
) -> DataFrame:
    """Start and end of text around the tokens, and ``size`` with both counted."""
    start = control.control_id("start_of_text", first_control_id)
    end = control.control_id("end_of_text", first_control_id)
    whole = F.concat(
        F.array(F.lit(start)),
        F.coalesce(tokens, F.array().cast("array<int>")),
        F.array(F.lit(end)),
    )
    return encoded.withColumn(tokens, whole).withColumn("size", F.size(tokens))


def _all_tokens(ranks: DataFrame, first: int, family: str) -> DataFrame:
    controls = _control_rows(ranks.sparkSession, first, family).select(
        F.col("piece").cast("binary").alias("token"), "id"
    )
    return ranks.select("token", "id").unionByName(controls)


def _token_table(ranks: DataFrame, first: int, family: str) -> DataFrame:
    return V.checked_broadcast(_all_tokens(ranks, first, family), F.octet_length("token") + 16)


def _spelled_in_place(
    encoded: DataFrame,
    ranks: DataFrame,
    keys: Sequence[str],
    tokens: str,
    family: str,
    first: int | None,
    partitioned: bool,
    unknown: str,
    result: str,
    distinct: bool,
) -> DataFrame | None:
    """``(*keys, spelled)`` by looking the ids of each stretch up where they are; None if the table is not for that."""
    if unknown not in ("raise", "replace"):
        raise ValueError("unknown must be 'raise' or 'replace'")
    first = ranks_size(ranks) if first is None else first
    table = _small(_all_tokens(ranks, first, family), "id", F.octet_length("token") + 16)
    if table is None:
        return None
    if result == "words":
        table = table.select("id", F.make_valid_utf8(F.col("token").cast("string")).alias("token"))

    def answer():
        import pyarrow as pa

        def solved(missing):
            if unknown == "raise" and len(missing):
                raise ValueError(f"no token has the id {missing[0].as_py()}")
            other = "\ufffd" if result == "words" else "\ufffd".encode()
            return pa.array([other] * len(missing), pa.string() if result == "words" else pa.binary())

        return solved

    def cut(ids):
        last = F.floor((F.size(ids) - 1) / STRETCH_TOKENS).cast("int")
        several = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(ids, i * STRETCH_TOKENS + 1, STRETCH_TOKENS))
        return F.when(F.size(ids) > STRETCH_TOKENS, several).otherwise(F.array(ids))

    ids = encoded.select(*keys, F.col(tokens).cast("array<int>").alias("_ids"))
    if distinct:
        listed = ids.select(*keys, F.array(F.struct(F.col("_ids").alias("_value"))).alias("_rows"))
    else:
        listed = _listed(_together(ids, keys[0], partitioned), keys, "_ids")
    return _looked_up(_by_stretch(listed, keys, cut), keys, "spelled", table, "id", "token", result, answer)


def vocabulary_ranks(vocabulary: DataFrame) -> DataFrame:
    """A vocabulary of whole pieces with its 256 bytes as a rank table ``(token, id)``."""
    single = vocabulary.sparkSession.range(V.BYTES).select(
        F.unhex(F.lpad(F.hex("id"), 2, "0")).alias("token"), F.col("id").cast("int")
    )
    return single.unionByName(
        vocabulary.select(F.col("piece").cast("binary").alias("token"), "id")
    )


def _spelled(
    encoded: DataFrame,
    ranks: DataFrame,
    keys: Sequence[str],
    tokens: str,
    family: str,
    first: int | None,
    partitioned: bool,
    unknown: str,
) -> DataFrame:
    """Per stretch of a document the ordered ``(pos, id, raw)`` of its tokens; ``raw`` is text of any bytes."""
    first = ranks_size(ranks) if first is None else first
    together = _together(encoded.select(*keys, tokens), keys[0], partitioned)
    rows = together.select(*keys, F.posexplode_outer(tokens).alias("pos", "id")).join(
        _token_table(ranks, first, family), "id", "left"
    )
    if unknown not in ("raise", "replace"):
        raise ValueError("unknown must be 'raise' or 'replace'")
    refused = F.raise_error(
        F.concat(F.lit("no token has the id "), F.col("id").cast("string"))
    ).cast("string")
    other = refused if unknown == "raise" else F.lit("\ufffd")
    spelled = rows.withColumn(
        "raw",
        F.when(F.col("id").isNotNull() & F.col("token").isNull(), other).otherwise(
            F.col("token").cast("string")
        ),
    )
    stretch = F.coalesce(F.floor(F.col("pos") / STRETCH_TOKENS), F.lit(0)).alias("stretch")
    return spelled.groupBy(*keys, stretch).agg(_in_order("id", "raw").alias("parts"))


def decode(
    encoded: DataFrame,
    ranks: DataFrame,
    keep: Sequence[str] = (),
    id_col: str = "doc_id",
    tokens: str = "tokens",
    family: str = "tiktoken",
    first_control_id: int | None = None,
    partitioned: bool = False,
    unknown: str = "raise",
    distinct: bool = False,
) -> DataFrame:
    """Token ids to text: ``(id_col, *keep, text)``. Broken UTF-8 becomes U+FFFD.

    An id that is in no table stops the job, or reads U+FFFD with ``unknown="replace"``. ``distinct`` says that no
    two rows have the same keys, as after encoding: rows then stay where they are.
    """
    keys = [id_col, *keep]
    options = (ranks, keys, tokens, family, first_control_id, partitioned, unknown)
    here = _spelled_in_place(encoded, *options, "raw", distinct)
    if here is not None:
        # a character may lie across two stretches: only the whole is made valid
        return here.select(*keys, F.make_valid_utf8(F.col("spelled").cast("string")).alias("text"))
    joined = F.concat_ws("", F.col("parts")["raw"])
    spelled = _spelled(encoded, ranks, keys, tokens, family, first_control_id, partitioned, unknown)
    # a character may lie across two stretches: only the whole is made valid
    parts = spelled.select(*keys, "stretch", F.array(joined).alias("raw"))
    return _whole(parts, keys, "raw").select(
        *keys, F.make_valid_utf8(F.concat_ws("", "raw")).alias("text")
    )


def words(
    encoded: DataFrame,
    ranks: DataFrame,
    keep: Sequence[str] = (),
    id_col: str = "doc_id",
    tokens: str = "tokens",
    family: str = "tiktoken",
    first_control_id: int | None = None,
    partitioned: bool = False,
    unknown: str = "raise",
    distinct: bool = False,
) -> DataFrame:
    """Each token id with its own text: ``words ARRAY<STRUCT<id, word>>``.

    A token that is only a part of a character reads U+FFFD; unknown ids and ``distinct`` as in :func:`decode`.
    """
    keys = [id_col, *keep]
    options = (ranks, keys, tokens, family, first_control_id, partitioned, unknown)
    here = _spelled_in_place(encoded, *options, "words", distinct)
    if here is not None:
        return here.withColumnRenamed("spelled", "words")
    pairs = F.transform(
        "parts",
        lambda part: F.struct(
            part["id"].alias("id"), F.make_valid_utf8(part["raw"]).alias("word")
        ),
    )
    spelled = _spelled(encoded, ranks, keys, tokens, family, first_control_id, partitioned, unknown)
    return _whole(spelled.select(*keys, "stretch", pairs.alias("words")), keys, "words")
