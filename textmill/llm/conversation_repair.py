"""Repair of the structure of conversations by the cheapest edits, with square-root checkpoints.

Rows of a conversation stand by turn (null first), then role, then text (its first ``PREFIX`` characters, then a digest). A
row's first fault counts: blank, a copy of an earlier row of the conversation (role and text), or cut off (its last
character that is no white space is none of ``.!?``). Edits make the role initials match ``(s?(ua)+)?``: keep a row (0),
give it the role user or assistant (2), delete it (3; blank rows and copies must go), insert an empty row of user or assistant
(2); a cut-off row that stays adds 1. Of the cheapest edits those whose initials (D, I, K, R) are ASCII-least are
taken. An edit's letter and the state before it give the state after it, so the walk that takes
the least tight letter at each step is the least string.

A conversation of n rows is dealt into blocks of about the square root of n. Each block's cost matrix between the four
states is made where the block is; one pass over a conversation's matrices gives the vector of costs to go at each
block's end, and only these checkpoints are stored. Each block is then computed again from its checkpoint: first
to find where it ends for each state it may begin in, then, when these are chained, to walk it. No task holds
more than a block, or one short record per block. A conversation that holds a third of all rows is thus spread; only the
checksum of its repaired text, by nature one after the other, is streamed through one task, row by row.

Null roles and texts become one space; rows of a null ``conv_id`` are one conversation. Repeated rows are copies. Empty
and very long texts are rows like others. An empty table gives an empty result. Columns other than the four are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmill.operators import ordering
from textmill.session import stored

PREFIX = 256
LEAST_BLOCK = 64
CELLS = 1 << 20  # rows of blocks computed at once
NONE = 1 << 60  # no way between two states
BLANKS = "\t\n\x0b\x0c\r "
REROLE, DELETE, INSERT, CUT = 2, 3, 2, 1
#: States: begin, after system, after user, after assistant. The last row's state is the first or the last.
NEXT = np.array([2, 2, 3, 2])
#: State after keeping a row, by state and initial (s, u, a, another); -1 if it must not be kept.
KEEP = np.array([[1, 2, -1, -1], [-1, 2, -1, -1], [-1, -1, 3, -1], [-1, 2, -1, -1]])
END = np.array([0, 2 * INSERT, INSERT, 0], np.int64)
#: What a walk writes for each edit: insertions in small letters, new roles in capitals.
INSERTED = np.array([ord(c) for c in "uuau"], np.uint8)
REROLED = np.array([ord(c) for c in "UUAU"], np.uint8)


def damaged(table: DataFrame) -> DataFrame:
    """Rows with known damage by the checksum of ``conv_id:turn``; nulls become one space."""
    text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", text("conv_id"), text("turn")).cast("binary")) % 20
    marked = table.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), kind.alias("_kind")).filter("_kind != 0")
    changed = (
        F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    )
    return marked.select(
        "conv_id",
        "turn",
        F.when(F.col("_kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        changed.alias("text"),
        F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("_copy"),
    ).drop("_copy")


def in_order(rows: DataFrame) -> DataFrame:
    """The rows with ``at``, which rises along each conversation, and ``key``, a digest of role and text."""
    text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" ")).alias(name)
    plain = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), text("role"), text("text"))
    keyed = plain.withColumn("key", F.unhex(F.sha2(F.concat_ws("\0", F.sha2("role", 256), "text"), 256)))
    # equal rows are spread as well: the last key is the place of the input
    order = ["conv_id", "turn", F.left("role", F.lit(PREFIX)), F.left("text", F.lit(PREFIX)), "key", "_place"]
    dealt = keyed.withColumn("_place", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(dealt.drop("_place").withColumn("at", F.monotonically_increasing_id()), "rows")


def faults(ordered: DataFrame) -> DataFrame:
    """Narrow rows ``(conv_id, turn, at, fault, code)``; ``code`` is the initial, +4 if the row must go, +8 if cut off."""
    inner = F.rtrim("text", F.lit(BLANKS))
    firsts = ordered.groupBy("conv_id", "key").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("first"))
    narrow = ordered.select(
        "conv_id",
        "turn",
        "at",
        F.left("role", F.lit(1)).alias("initial"),
        (inner == "").alias("blank"),
        (~F.right(inner, F.lit(1)).isin(".", "!", "?")).alias("cut"),
    ).join(firsts, "at", "left")
    fault = F.when(F.col("blank"), "blank").when(F.col("first").isNull(), "duplicate").when(F.col("cut"), "truncated")
    initial = F.when(F.col("initial") == "s", 0).when(F.col("initial") == "u", 1).when(F.col("initial") == "a", 2).otherwise(3)
    code = initial + F.when(F.col("fault").isin("blank", "duplicate"), 4).when(F.col("fault") == "truncated", 8).otherwise(0)
    return narrow.withColumn("fault", fault).select("conv_id", "turn", "at", "fault", code.cast("byte").alias("code"))


def blocks(rows: DataFrame, least: int = LEAST_BLOCK) -> DataFrame:
    """``(conv_id, begin, ats, codes)``: stretches of about the square root of a conversation's rows."""
    part = F.shiftright("at", 33)  # the task that put the rows in order
    held = rows.select("conv_id", "at", "code", part.alias("_part"))
    parts = held.groupBy("conv_id", "_part").agg(F.min("at").alias("_first"), F.count("*").alias("_n"))
    # one record per task of a conversation
    total = F.sum("_n").over(Window.partitionBy("conv_id"))
    sizes = parts.select("conv_id", "_part", "_first", F.greatest(F.ceil(F.sqrt(total)), F.lit(least)).cast("long").alias("_size"))
    placed = ordering.null_safe_join(held, sizes, ["conv_id", "_part"])
    begin = F.col("_first") + F.expr("(at - _first) div _size") * F.col("_size")
    listed = F.sort_array(F.collect_list(F.struct("at", "code")))
    return placed.groupBy("conv_id", begin.alias("begin")).agg(listed.alias("_rows")).select("conv_id", "begin", F.col("_rows")["at"].alias("ats"), F.col("_rows")["code"].alias("codes"))


# numpy inside tasks: blocks of like length at once


def _padded(codes: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Codes of each block in a row of a matrix, and the blocks' lengths."""
    lengths = np.diff(codes.offsets.to_numpy()).astype(np.int64)
    values = codes.flatten().to_numpy()
    out = np.zeros((len(lengths), int(lengths.max(initial=0))), np.int64)
    out[np.repeat(np.arange(len(lengths)), lengths), np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    return out, lengths


def _alike(codes: pa.Array) -> Iterator[np.ndarray]:
    """Indexes of blocks, short ones first, whose padded rows are at most ``CELLS`` in all."""
    lengths = np.diff(codes.offsets.to_numpy())
    order, at = np.argsort(lengths, kind="stable"), 0
    while at < len(order):
        end = at + 1
        while end < len(order) and (end + 1 - at) * int(lengths[order[end]]) <= CELLS:
            end += 1
        yield order[at:end]
        at = end


def _inserted(v: np.ndarray) -> np.ndarray:
    """Costs to go with up to two rows inserted here; three lead back to a state seen before."""
    for _ in range(2):
        v = np.minimum(v, INSERT + v[..., NEXT])
    return v


def costs_to_go(codes: np.ndarray, lengths: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Backward vectors of each block: ``[block, row, state]``, the last one the block's checkpoint."""
    blocks, most = codes.shape
    out = np.empty((blocks, most + 1, 4), np.int64)
    out[:, most] = ends
    initial, goes, cut = codes & 3, (codes & 4) > 0, np.where(codes & 8, CUT, 0)
    for p in range(most - 1, -1, -1):
        after = out[:, p + 1]
        target = KEEP[:, initial[:, p]].T
        kept = np.where(target >= 0, np.take_along_axis(after, np.maximum(target, 0), axis=1), NONE)
        stays = np.minimum(kept, REROLE + after[:, NEXT]) + cut[:, p, None]
        best = np.minimum(DELETE + after, np.where(goes[:, p, None], NONE, stays))
        out[:, p] = np.where((p < lengths)[:, None], _inserted(best), after)
    return out


def walk(codes: np.ndarray, lengths: np.ndarray, to_go: np.ndarray, begin: np.ndarray, last: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """The ASCII-least tight edits of each block from its first state, and the state it ends in.

    The last block of a conversation also inserts what its end needs; elsewhere that is the next block's.
    """
    n, most = codes.shape
    every = np.arange(n)
    written = np.zeros((n, 3 * most + 4), np.uint8)
    size, place, state = np.zeros(n, np.int64), np.zeros(n, np.int64), begin.astype(np.int64)
    live = every[(place < lengths) | (last & (to_go[every, place, state] > 0))]
    while len(live):
        p, s = place[live], state[live]
        here, inside = to_go[live, p, s], p < lengths[live]
        code = codes[live, np.minimum(p, most - 1)] if most else np.zeros(len(live), np.int64)
        stays, cut = inside & ((code & 4) == 0), np.where(code & 8, CUT, 0)
        later = to_go[live, np.minimum(p + 1, most)]
        pick = lambda states: later[np.arange(len(live)), states]
        kept = KEEP[s, code & 3]
        delete = inside & (DELETE + pick(s) == here)
        insert = ~delete & (INSERT + to_go[live, p, NEXT[s]] == here)
        keep = ~delete & ~insert & stays & (kept >= 0) & (cut + pick(np.maximum(kept, 0)) == here)
        letter = np.select([delete, insert, keep], [np.uint8(ord("D")), INSERTED[s], np.uint8(ord("K"))], REROLED[s])
        written[live, size[live]] = letter
        size[live] += 1
        state[live] = np.select([delete, keep], [s, kept], NEXT[s])
        place[live] += ~insert
        p, s = place[live], state[live]
        live = live[(p < lengths[live]) | (last[live] & (to_go[live, p, s] > 0))]
    return [written[k, : size[k]].tobytes() for k in range(n)], state


def _illegal(codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Neighbours inside each block whose initials are none of su, ua, au."""
    a, b = codes[:, :-1] & 3, codes[:, 1:] & 3
    legal = ((a == 0) & (b == 1)) | ((a == 1) & (b == 2)) | ((a == 2) & (b == 1))
    inside = np.arange(1, max(codes.shape[1], 1)) < lengths[:, None]
    return (inside & ~legal).sum(axis=1)


def _column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.names.index(name))


def _matrices(batches):
    """Per block the cost from each state at its begin to each at its end, its first and last initial, its illegal pairs."""
    for batch in batches:
        listed = _column(batch, "codes")
        cost, illegal = np.zeros((batch.num_rows, 16), np.int64), np.zeros(batch.num_rows, np.int64)
        ends = np.zeros((batch.num_rows, 2), np.int64)
        for which in _alike(listed):
            codes, lengths = _padded(listed.take(pa.array(which)))
            for state in range(4):
                one = np.full((len(which), 4), NONE, np.int64)
                one[:, state] = 0
                cost[which, state::4] = np.minimum(costs_to_go(codes, lengths, one)[:, 0], NONE)
            illegal[which] = _illegal(codes, lengths)
            ends[which, 0], ends[which, 1] = codes[:, 0] & 3, codes[np.arange(len(which)), lengths - 1] & 3
        matrix = pa.FixedSizeListArray.from_arrays(pa.array(cost.ravel()), 16).cast(pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [_column(batch, "conv_id"), _column(batch, "begin"), matrix, pa.array(ends[:, 0]), pa.array(ends[:, 1]), pa.array(illegal)],
            names=["conv_id", "begin", "matrix", "head", "tail", "illegal"],
        )


def _checkpoints(batches):
    """Per conversation its cost, its illegal pairs and, per block, the vector of costs to go at the block's end."""
    legal = {(0, 1), (1, 2), (2, 1)}
    for batch in batches:
        cost, illegal, vectors = [], [], []
        for parts in _column(batch, "parts").to_pylist():
            v, own = END, []
            for part in reversed(parts):
                own.append({"begin": part["begin"], "ends": v.tolist(), "last": not own})
                v = np.minimum((np.array(part["matrix"]).reshape(4, 4) + v).min(axis=1), NONE)
            cost.append(int(v[0]))
            illegal.append(sum(p["illegal"] for p in parts) + sum((a["tail"], b["head"]) not in legal for a, b in zip(parts, parts[1:])))
            vectors.append(own)
        kind = pa.list_(pa.struct([("begin", pa.int64()), ("ends", pa.list_(pa.int64())), ("last", pa.bool_())]))
        yield pa.RecordBatch.from_arrays(
            [_column(batch, "conv_id"), pa.array(cost, pa.int64()), pa.array(illegal, pa.int64()), pa.array(vectors, kind)],
            names=["conv_id", "cost", "illegal", "vectors"],
        )


def _recomputed(batch: pa.RecordBatch):
    listed, ends = _column(batch, "codes"), _column(batch, "ends").flatten().to_numpy().reshape(-1, 4)
    last = _column(batch, "last").to_numpy(zero_copy_only=False).astype(bool)
    for which in _alike(listed):
        codes, lengths = _padded(listed.take(pa.array(which)))
        yield which, codes, lengths, costs_to_go(codes, lengths, ends[which]), last[which]


def _ways(batches):
    """Per block the state it ends in for each state it may begin in."""
    for batch in batches:
        ways = np.zeros((batch.num_rows, 4), np.int64)
        for which, codes, lengths, to_go, last in _recomputed(batch):
            for state in range(4):
                ways[which, state] = walk(codes, lengths, to_go, np.full(len(which), state), last)[1]
        listed = pa.FixedSizeListArray.from_arrays(pa.array(ways.ravel()), 4).cast(pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([_column(batch, "conv_id"), _column(batch, "begin"), listed], names=["conv_id", "begin", "ways"])


def _chained(batches):
    """The state in which each block of a conversation begins."""
    for batch in batches:
        begins, states = [], []
        for parts in _column(batch, "parts").to_pylist():
            state = 0
            for part in parts:
                begins.append(part["begin"])
                states.append(state)
                state = part["ways"][state]
        yield pa.RecordBatch.from_arrays([pa.array(begins, pa.int64()), pa.array(states, pa.int32())], names=["begin", "state"])


def _walks(batches):
    for batch in batches:
        begin = _column(batch, "state").to_numpy()
        edits: list[bytes] = [b""] * batch.num_rows
        for which, codes, lengths, to_go, last in _recomputed(batch):
            for k, text in zip(which, walk(codes, lengths, to_go, begin[which], last)[0]):
                edits[k] = text
        yield pa.RecordBatch.from_arrays(
            [_column(batch, "conv_id"), _column(batch, "begin"), _column(batch, "ats"), pa.array([e.decode() for e in edits], pa.string())],
            names=["conv_id", "begin", "ats", "edits"],
        )


def edits(rows: DataFrame, least: int = LEAST_BLOCK) -> tuple[DataFrame, DataFrame]:
    """Conversations ``(conv_id, cost, illegal)`` and blocks ``(conv_id, begin, ats, edits)``, from :func:`faults`.

    ``edits`` has a letter an edit: D delete, K keep, U and A give the role user or assistant, u and a insert one.
    """
    held = stored(blocks(rows, least), "blocks")
    kind = rows.schema["conv_id"].dataType.simpleString()
    own = held.mapInArrow(_matrices, f"conv_id {kind}, begin long, matrix array<long>, head long, tail long, illegal long")
    # one record per block: about the square root of a conversation's rows
    gathered = own.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("begin", "matrix", "head", "tail", "illegal"))).alias("parts"))
    known = stored(
        gathered.mapInArrow(_checkpoints, f"conv_id {kind}, cost long, illegal long, vectors array<struct<begin:long,ends:array<long>,last:boolean>>"),
        "checkpoints",
    )
    ends = known.select(F.explode("vectors").alias("v")).select("v.*")
    ready = stored(held.join(ends, "begin"), "blocks")
    ways = ready.select("conv_id", "begin", "codes", "ends", "last").mapInArrow(_ways, f"conv_id {kind}, begin long, ways array<long>")
    chained = ways.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("begin", "ways"))).alias("parts"))
    states = chained.select("parts").mapInArrow(_chained, "begin long, state int")
    walked = ready.join(states, "begin").mapInArrow(_walks, f"conv_id {kind}, begin long, ats array<long>, edits string")
    return known.select("conv_id", "cost", "illegal"), stored(walked, "edits")


def repaired(ordered: DataFrame, walked: DataFrame) -> DataFrame:
    """The conversations after their edits: ``(conv_id, at, part, role, text)``, in the order of ``at, part``."""
    own = F.regexp_extract_all("edits", F.lit("[ua]*[DKUA]"), F.lit(0))
    each = walked.select(F.explode(F.arrays_zip(F.col("ats"), own.alias("edit"))).alias("r")).select("r.ats", "r.edit")
    # a row has at most three edits, two of them insertions; what a conversation's end needs comes behind them
    rest = walked.select("conv_id", F.element_at("ats", -1).alias("at"), F.regexp_extract("edits", "[ua]*$", 0).alias("edit"))
    known = ordered.join(each.withColumnRenamed("ats", "at"), "at")
    letters = lambda edit: F.posexplode(F.split(edit, "")).alias("part", "letter")
    rows = known.select("conv_id", "at", "role", "text", letters("edit")).unionByName(
        rest.filter("edit != ''").select("conv_id", "at", F.lit("").alias("role"), F.lit("").alias("text"), letters("edit")).withColumn("part", F.col("part") + 3)
    )
    letter = F.col("letter")
    role = F.when(F.lower("letter") == "u", "user").when(F.lower("letter") == "a", "assistant").otherwise(F.col("role"))
    return rows.filter(~letter.isin("", "D")).select("conv_id", "at", "part", role.alias("role"), F.when(letter.isin("u", "a"), "").otherwise(F.col("text")).alias("text"))


def checksums(rows: DataFrame) -> DataFrame:
    """``(conv_id, repaired_sha256)`` of rows from :func:`repaired`, streamed in order."""

    def run(batches):
        def done(ids, sums):
            return pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(sums, pa.string())], names=["conv_id", "repaired_sha256"])

        kind, now, state = None, None, None
        for batch in batches:
            kind = _column(batch, "conv_id").type
            ids, sums = [], []
            for conversation, line in zip(_column(batch, "conv_id").to_pylist(), _column(batch, "line").to_pylist()):
                if state is None or conversation != now:
                    if state is not None:
                        ids.append(now)
                        sums.append(state.hexdigest())
                    now, state = conversation, hashlib.sha256(line.encode())
                else:
                    state.update(b"\n")
                    state.update(line.encode())
            yield done(ids, sums)
        if state is not None:
            yield done([now], [state.hexdigest()])

    lines = rows.select("conv_id", "at", "part", F.concat("role", F.lit(":"), "text").alias("line"))
    dealt = lines.repartition("conv_id").sortWithinPartitions("conv_id", "at", "part").select("conv_id", "line")
    return dealt.mapInArrow(run, f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, repaired_sha256 string")


def report(table: DataFrame, least: int = LEAST_BLOCK) -> DataFrame:
    """Per conversation of the table, after known damage: its faults, the cost and letters of its edits, a checksum of the repaired rows."""
    ordered = in_order(damaged(table))
    rows = stored(faults(ordered), "faults")
    costs, walked = edits(rows, least)
    count = lambda fault: F.count_if(F.col("fault") == fault).alias(fault)
    wide = lambda c: c.cast("decimal(38,0)")
    span = wide(F.max("turn")) - wide(F.min("turn")) + 1 - F.count_distinct("turn")
    counts = rows.groupBy("conv_id").agg(
        F.least(F.coalesce(span, F.lit(0)), F.lit((1 << 63) - 1)).cast("long").alias("gaps"), count("blank"), count("duplicate"), count("truncated")
    )
    letters = F.translate(F.array_join(F.sort_array(F.collect_list(F.struct("begin", "edits")))["edits"], ""), "uaUA", "IIRR")
    parts = [
        table.select("conv_id").distinct(),
        counts,
        costs,
        walked.groupBy("conv_id").agg(letters.alias("audit")),
        checksums(repaired(ordered, walked)),
    ]
    everything = parts[0]
    for part in parts[1:]:
        everything = everything.unionByName(part, allowMissingColumns=True)
    value = lambda name, missing: F.coalesce(F.max(name), F.lit(missing)).alias(name)
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return everything.groupBy("conv_id").agg(
        *[value(n, 0) for n in numbers], value("audit", ""), value("repaired_sha256", hashlib.sha256(b"").hexdigest())
    )


def _sql() -> str:
    """What :func:`report` returns, backwards row by row with whole strings."""

    def least(*found: str) -> str:
        return f"list_sort([{', '.join(found)}])[1]"

    def state(cost: str, letters: str, lines: str) -> str:
        return f"{{'c': {cost}, 'a': {letters}, 'r': {lines}}}"

    names = ["user", "user", "assistant", "user"]
    far = "NULL::STRUCT(c BIGINT, a VARCHAR, r VARCHAR)"
    based, once = [], []
    for s in range(4):
        nxt = int(NEXT[s])
        delete = state(f"s{s}.c + {DELETE}", f"'D' || s{s}.a", f"s{s}.r")
        keeps = [
            f"CASE WHEN NOT goes AND initial = '{'sua'[i]}' THEN {state(f's{t}.c + cut', f"'K' || s{t}.a", f"role || ':' || text || chr(10) || s{t}.r")} ELSE {far} END"
            for i, t in enumerate(KEEP[s][:3].tolist())
            if t >= 0
        ]
        rerole = f"CASE WHEN NOT goes THEN {state(f's{nxt}.c + {REROLE} + cut', f"'R' || s{nxt}.a", f"'{names[s]}:' || text || chr(10) || s{nxt}.r")} ELSE {far} END"
        based.append(f"list_sort(list_filter([{', '.join([delete, *keeps, rerole])}], lambda x: x IS NOT NULL))[1] AS s{s}")
        inserted = state(f"s{nxt}.c + {INSERT}", f"'I' || s{nxt}.a", f"'{names[s]}:' || chr(10) || s{nxt}.r")
        once.append(f"{least(f's{s}', inserted)} AS s{s}")
    end = [
        state("0::BIGINT", "''", "''"),
        state("4::BIGINT", "'II'", "'user:' || chr(10) || 'assistant:' || chr(10)"),
        state("2::BIGINT", "'I'", "'assistant:' || chr(10)"),
        state("0::BIGINT", "''", "''"),
    ]
    blanks = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
WITH RECURSIVE steps AS (
  SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS t FROM range(256) AS r(i)
), marked AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ord(x)::BIGINT),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 20 AS kind
  FROM conversations, steps
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM marked WHERE kind <> 0
), ordered AS (
  SELECT *, left(role, 1) AS initial, rtrim(text, {blanks}) AS inside,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n
  FROM damaged
), judged AS (
  SELECT *, CASE WHEN inside = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 'duplicate' WHEN right(inside, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY n) || initial AS pair
  FROM ordered
), counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM judged GROUP BY conv_id
), walked AS (
  SELECT conv_id, n + 1 AS n, {', '.join(f'{e} AS s{k}' for k, e in enumerate(end))} FROM counts
  UNION ALL
  SELECT conv_id, n, {', '.join(once)} FROM (SELECT conv_id, n, {', '.join(once)} FROM (
    SELECT w.conv_id, j.n, {', '.join(based)}
    FROM (SELECT * FROM walked WHERE n > 1) AS w JOIN (
      SELECT conv_id, n, role, text, initial, fault IN ('blank', 'duplicate') AS goes, CASE WHEN fault = 'truncated' THEN {CUT} ELSE 0 END AS cut FROM judged) AS j
      ON w.conv_id IS NOT DISTINCT FROM j.conv_id AND w.n = j.n + 1))
)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(s0.c, 0) AS cost, coalesce(s0.a, '') AS audit, sha256(coalesce(left(s0.r, length(s0.r) - 1), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS c
LEFT JOIN counts ON c.conv_id IS NOT DISTINCT FROM counts.conv_id
LEFT JOIN walked ON c.conv_id IS NOT DISTINCT FROM walked.conv_id AND walked.n = 1
"""


SQL = _sql()
