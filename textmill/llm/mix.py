"""Mixing sources to target weights by pivotal dependent rounding.

A source's documents should give ``target / size`` copies of themselves on average, where sizes and targets
are words. The whole part of that ratio is certain; the fractional part is rounded for all documents together.
Pivotal rounding pairs two documents and moves word mass from one to the other, in a random direction
whose expectation is nothing, until one of them has no or a full copy. So the words of a source stay
what they are at every step. Blocks of about ``BLOCK`` documents are rounded side by side; the at
most one undecided document of each goes on to the next level of a reduction tree. The last undecided
document of a source, one at most, gives that part of its words.

Null and empty texts have size 0 and give nothing. A null source is a source of its own, the last one.
Rows with the same id, source and text are one unit and share its fate; each gives its words. Randomness is
a hash of ids and seed, so reruns agree. An empty table gives an empty result. Other columns are kept;
those named like a result are replaced. Column expressions, joins and aggregates only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmill.session import stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5  # of all sizes
MOST = 2  # copies of a document, and of a source's size
BLOCK = 128
SEED = 11


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def units_of(docs: DataFrame) -> DataFrame:
    """``(doc_id, source, mark, size, rows)``: documents, equal rows once."""
    marked = docs.select("doc_id", "source", F.xxhash64(F.col("text")).alias("mark"), size_of(F.col("text")).alias("size"))
    return marked.groupBy("doc_id", "source", "mark", "size").agg(F.count("*").alias("rows"))


def ranked_sources(units: DataFrame) -> DataFrame:
    """``(source, source_size, units, place)``: totals, and the place of each source in code point order from 0, null last."""
    totals = units.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.count("*").alias("units"))
    order = F.col("source").asc_nulls_last()
    ranged = stored(totals.repartitionByRange(order).withColumn("part", F.spark_partition_id()), "sources")
    # one row for each part, not for each source
    before = ranged.groupBy("part").count().withColumn(
        "before", F.coalesce(F.sum("count").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    own = F.row_number().over(Window.partitionBy("part").orderBy(order))
    return ranged.withColumn("own", own).join(before.select("part", "before"), "part").select(
        "source", "source_size", "units", (F.col("before") + F.col("own") - 1).alias("place")
    )


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """The sources with ``target``: shares by weight, at most ``most`` sizes, the excess reshared."""
    listed = F.array(*map(F.lit, weights))
    table = stored(sources.withColumn("weight", F.get(listed, F.pmod("place", F.lit(len(weights))).cast("int"))), "weighted")
    size, weight = table.agg(F.sum("source_size"), F.sum("weight")).first()
    total, level = share * (size or 0), 0.0
    if size:
        level, before = total / weight, -1.0
        while level > before:  # a higher level can bring more sources to their limit
            before = level
            full = F.col("source_size") * most <= level * F.col("weight")
            taken, left = table.agg(F.sum(F.when(full, F.col("source_size") * most)), F.sum(F.when(~full, F.col("weight")))).first()
            if left:
                level = max(level, (total - (taken or 0)) / left)
    return table.withColumn("target", F.least(F.col("source_size") * F.lit(float(most)), F.col("weight") * F.lit(level)))


def _chance(a: Column, b: Column, level: int, seed: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(a, b, F.lit(level), F.lit(seed)), 11) / F.lit(float(1 << 53))


def _folded(level: int, seed: int, kind: str):
    """The step that meets one more unit: ``(held, done)`` to the same with one of two decided."""

    def step(state: Column, unit: Column) -> Column:
        held = state["held"]
        give = F.least(held["w"] * held["p"], unit["w"] * (1 - unit["p"]))
        take = F.least(unit["w"] * unit["p"], held["w"] * (1 - held["p"]))
        given = _chance(held["key"], unit["key"], level, seed) * (give + take) < take
        # giving empties the holder or fills the other; taking the reverse
        empties = give == held["w"] * held["p"]
        fills = take == held["w"] * (1 - held["p"])
        other = lambda moved: F.greatest(F.lit(0.0), F.least(F.lit(1.0), unit["p"] + moved / unit["w"]))
        own = lambda moved: F.greatest(F.lit(0.0), F.least(F.lit(1.0), held["p"] + moved / held["w"]))
        with_p = lambda u, p: F.struct(*[u[c].alias(c) for c in ("key", "w", "doc_id", "mark", "size", "base", "rows")], p.alias("p"))
        decided = F.when(
            given,
            F.when(empties, F.struct(with_p(held, F.lit(0.0)).alias("d"), with_p(unit, other(give)).alias("h"))).otherwise(
                F.struct(with_p(unit, F.lit(1.0)).alias("d"), with_p(held, own(-give)).alias("h"))
            ),
        ).otherwise(
            F.when(fills, F.struct(with_p(held, F.lit(1.0)).alias("d"), with_p(unit, other(-take)).alias("h"))).otherwise(
                F.struct(with_p(unit, F.lit(0.0)).alias("d"), with_p(held, own(take)).alias("h"))
            )
        )
        met = F.transform(F.array(decided), lambda x: F.struct(x["h"].cast(kind).alias("held"), F.concat(state["done"], F.array(x["d"].cast(kind))).alias("done")))[0]
        whole = (held["p"] <= 0) | (held["p"] >= 1)
        passed = F.struct(unit.cast(kind).alias("held"), F.concat(state["done"], F.array(held)).alias("done"))
        first = F.struct(unit.cast(kind).alias("held"), state["done"].alias("done"))
        return F.when(held.isNull(), first).when(whole, passed).otherwise(met)

    return step


def rounded(units: DataFrame, most_units: int, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """Decided units of all sources: each with ``p``, 0 or 1, but for one at most of each source."""
    kind = units.select("unit").schema["unit"].dataType.simpleString()
    nothing = F.struct(F.lit(None).cast(kind).alias("held"), F.array().cast(f"array<{kind}>").alias("done"))
    blocks, level, parts = -(-most_units // block), 0, []
    rows = units
    while True:
        listed = F.sort_array(F.collect_list("unit"))
        grouped = rows.groupBy("source", "bucket").agg(listed.alias("all"))
        folded = stored(
            grouped.select("source", "bucket", F.aggregate("all", nothing, _folded(level, seed, kind)).alias("s")), "rounded"
        )
        parts.append(folded.select("source", F.explode("s.done").alias("u")))
        if blocks <= 1:
            break
        blocks, level = -(-blocks // block), level + 1
        rows = folded.filter("s.held IS NOT NULL").select("source", F.floor(F.col("bucket") / block).alias("bucket"), F.col("s.held").alias("unit"))
    parts.append(folded.filter("s.held IS NOT NULL").select("source", F.col("s.held").alias("u")))
    return reduce(DataFrame.unionAll, parts).select("source", "u.*")


def decisions(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """``(doc_id, source, mark, size, rows, source_size, target, taken)`` of every unit."""
    units = stored(units_of(docs), "units")
    aims = stored(targets(ranked_sources(units), weights, share, most), "targets")
    top = aims.agg(F.max("units")).first()[0] or 0
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    base = F.floor(ratio)
    key = F.xxhash64("doc_id", "source", "mark", F.lit(seed))
    mine = F.ceil(F.col("units") / block)
    fields = [
        key.alias("key"),
        (F.col("size") * F.col("rows")).cast("double").alias("w"),
        F.col("doc_id"),
        F.col("mark"),
        F.col("size"),
        base.alias("base"),
        F.col("rows"),
        F.when(F.col("size") > 0, ratio - base).otherwise(0.0).alias("p"),
    ]
    joined = units.join(aims.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")))
    placed = joined.select("source", F.pmod(key, mine).alias("bucket"), F.struct(*fields).alias("unit"))
    done = rounded(placed, top, block, seed)
    taken = F.round((F.col("base") + F.col("p")) * F.col("size")).cast("long")
    return done.join(aims.select(F.col("source").alias("_s"), "source_size", "target"), F.col("source").eqNullSafe(F.col("_s"))).select(
        "doc_id", "source", "mark", "size", "rows", "source_size", "target", taken.alias("taken")
    )


def report(docs: DataFrame, **options) -> DataFrame:
    """Per document: its size, its source's size and target, and the words that the mix takes from it."""
    done = decisions(docs, **options)
    each = F.explode(F.array_repeat(F.lit(0), F.col("rows").cast("int")))
    return done.select("doc_id", "size", "source_size", "target", "taken", each.alias("_")).drop("_")


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The documents that the mix takes words from, with ``size``, ``source_size``, ``target``, ``taken``."""
    made = ["size", "source_size", "target", "taken"]
    done = decisions(docs, **options).filter("taken > 0").select(
        F.col("doc_id").alias("_i"), F.col("source").alias("_s"), F.col("mark").alias("_m"), *made
    )
    kept = [c for c in docs.columns if c not in made]
    same = F.col("doc_id").eqNullSafe(F.col("_i")) & F.col("source").eqNullSafe(F.col("_s")) & (F.xxhash64("text") == F.col("_m"))
    return docs.select(kept).join(done, same).select(*kept, *made)
