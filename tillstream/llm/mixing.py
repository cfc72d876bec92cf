"""Mixing sources to target weights along a time-varying curriculum.

Every source has a target (words the mix takes of it) and a weight schedule
over training time. A source's documents stand in a fixed pseudo-random order;
the mix runs through that order, up to three times, until the target is used
up. The integral of the schedule tells how much of the target is demanded by
time t; inverting it at a document's cumulative place gives its position in
training, and documents are range-sorted by position.

Cumulative places are two-level: totals per (source, hash bucket) are prefixed
per source, then each bucket is summed within itself. Every source has as many
buckets as its own rows need (a power of two, without a limit), and the hash is
of the id and of what tells rows of one id apart: neither a hot source nor rows
without an id are gathered in one task.

Defined results: a null text has size 0 and is never taken; a null source is
a source of its own, last in order; repeated rows are documents of their own
(equal rows are interchangeable); a null id or ``apart`` counts as the text
'null'; very long texts are counted whole; an empty table gives an empty result;
clashing input columns are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import RESERVED, discard, let, words_of, written

#: Times a source's words, or a document, may be used.
MOST_REPEATS = 3
#: Weights given to sources in code point order, over and over.
WEIGHTS = (1, 2, 3)
#: Weight schedules by weight: (time, factor) knots, linear in between. Light sources come
#: early, heavy ones late; each is scaled to integrate to 1.
SCHEDULES = {1: ((0.0, 1.5), (1.0, 0.5)), 2: ((0.0, 1.0), (1.0, 1.0)), 3: ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5))}
#: Rows a hash bucket holds on average.
BUCKET_ROWS = 4_000

_ID, _KEY, _BUCKET = f"{RESERVED}source", f"{RESERVED}key", f"{RESERVED}bucket"


def pieces_of(knots) -> list[tuple[float, float, float, float]]:
    """(time, demand before, factor, slope) of each linear piece, scaled to a total demand of 1."""
    area = sum((t1 - t0) * (f0 + f1) / 2 for (t0, f0), (t1, f1) in zip(knots, knots[1:]))
    out, before = [], 0.0
    for (t0, f0), (t1, f1) in zip(knots, knots[1:]):
        out.append((t0, before, f0 / area, (f1 - f0) / area / (t1 - t0)))
        before += (t1 - t0) * (f0 + f1) / 2 / area
    return out


def time_of(share: Column, weight: Column, schedules=SCHEDULES) -> Column:
    """Inverse of the integrated schedule: when ``share`` of the demand is reached."""
    out = F.lit(None).cast("double")
    for w, knots in schedules.items():
        of = None
        for t0, before, factor, slope in pieces_of(knots):
            rest = share - before
            at = t0 + 2 * rest / (factor + F.sqrt(factor * factor + 2 * slope * rest))
            of = at if of is None else F.when(share >= before, at).otherwise(of)
        out = F.when(weight == w, of).otherwise(out)
    return out


def numbered(df: DataFrame, column: str, name: str) -> DataFrame:
    """``df`` (one row per value) with its rank from 0 in order of ``column``, nulls last.

    Range partitions are sorted and counted; the counts' prefix sum (one row a
    partition) offsets each partition's own numbering.
    """
    order = F.col(column).asc_nulls_last()
    inner = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    parts = written(df.repartitionByRange(order).sortWithinPartitions(order)
                    .withColumns({f"{RESERVED}part": F.spark_partition_id(), f"{RESERVED}inner": inner}), "ranked")
    counts = parts.groupBy(f"{RESERVED}part").count()
    before = F.coalesce(F.sum("count").over(
        Window.orderBy(f"{RESERVED}part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select(f"{RESERVED}part", before.alias(f"{RESERVED}before"))
    return (parts.join(offsets, f"{RESERVED}part")
            .withColumn(name, F.col(f"{RESERVED}before") + F.col(f"{RESERVED}inner"))
            .drop(f"{RESERVED}part", f"{RESERVED}inner", f"{RESERVED}before"))


def targets(sources: DataFrame, weights=WEIGHTS, repeats: int = MOST_REPEATS) -> DataFrame:
    """``sources`` (source, source_size) with ``weight``, ``target`` and ``need`` (whole words).

    The total is shared by weight; what a source's cap leaves over is shared
    anew among the others until none is above: then every target is
    ``least(cap, level * weight)``. Each round is one aggregate over sources.
    """
    ranked = numbered(sources, "source", f"{RESERVED}rank")
    weight = F.element_at(F.array(*map(F.lit, weights)),
                          (F.col(f"{RESERVED}rank") % len(weights) + 1).cast("int"))
    weighed = written(ranked.withColumn("weight", weight).drop(f"{RESERVED}rank"), "sources")
    cap, size = F.col("source_size") * repeats, F.col("source_size")
    level, capped, before = None, None, -1
    while capped != before:
        above = F.lit(False) if level is None else cap < F.col("weight") * level
        row = weighed.agg(
            F.sum(size).alias("total"), F.sum(F.when(above, cap).otherwise(0)).alias("taken"),
            F.sum(F.when(above, 0).otherwise(F.col("weight"))).alias("weight"),
            F.sum(above.cast("int")).alias("capped")).first()
        level = ((row["total"] or 0) - (row["taken"] or 0)) / row["weight"] if row["weight"] else 0.0
        before, capped = capped, row["capped"]
    target = F.least(cap.cast("double"), F.col("weight") * F.lit(float(level)))
    return weighed.withColumn("target", target).withColumn("need", F.floor(F.col("target") + 0.5).cast("long"))


def order_key(doc_id: str, apart: str | None) -> Column:
    """32 hex digits by which a source's rows are ordered."""
    told = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in (doc_id, apart) if c]
    return F.md5(F.concat_ws(":", *told).cast("binary"))


def _bucket(key: Column, bits: Column) -> Column:
    """The first ``bits`` (at most 32) bits of a hex key."""
    return F.floor(F.conv(F.substring(key, 1, 8), 16, 10).cast("long") / F.pow(F.lit(2), 32 - bits)).cast("long")


def plan(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", size: str = "size",
         apart: str | None = None, weights=WEIGHTS, repeats: int = MOST_REPEATS, schedules=SCHEDULES,
         bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``docs`` with ``source_size``, ``target``, ``taken`` (words, repeats
    counted) and ``placements``: an array of (epoch, words, position), position
    being the time in [0, 1] at which that copy is trained on.

    ``size``: a column with each document's number of words. ``apart``: a column
    that tells rows of one id apart (a hash of the text). The copy that crosses
    its source's target contributes only the words up to it.
    """
    order = order_key(doc_id, apart)
    stats = written(docs.select(F.col(source).alias("source"), F.substring(order, 1, 8).alias("key"),
                                F.col(size).alias("size")), "sizes")
    bits = F.greatest(F.lit(0), F.least(F.lit(32), F.ceil(F.log2(F.count(F.lit(1)) / bucket_rows)))).cast("int")
    widths = written(stats.groupBy(F.col("source").alias("of")).agg(bits.alias("bits")), "bucket_widths")
    per_bucket = written(stats.join(widths, F.col("source").eqNullSafe(F.col("of")))
                         .groupBy("source", _bucket(F.col("key"), F.col("bits")).alias("bucket"))
                         .agg(F.sum("size").alias("size")), "bucket_sizes")
    discard(stats)
    aim = targets(per_bucket.groupBy("source").agg(F.sum("size").alias("source_size")), weights, repeats)
    before = F.coalesce(F.sum("size").over(
        Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = written(per_bucket.select(F.col("source").alias(f"{_ID}_in"), F.col("bucket").alias(f"{_BUCKET}_of"),
                                       before.alias(f"{RESERVED}before")), "bucket_starts")
    aims = written(aim.join(widths, F.col("source").eqNullSafe(F.col("of"))).select(
        F.col("source").alias(_ID), *[F.col(c).alias(f"{RESERVED}{c}") for c in (
            "bits", "source_size", "weight", "target", "need")]), "targets")
    discard(per_bucket, widths)
    within = Window.partitionBy(source, _BUCKET).orderBy(_KEY, doc_id, size)
    need, whole, words = (F.col(f"{RESERVED}{c}") for c in ("need", "source_size", "size"))
    start = F.col(f"{RESERVED}before") + F.coalesce(F.sum(size).over(
        within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    def placement(epoch: Column) -> Column:
        at = epoch * whole + F.col(f"{RESERVED}start")
        # a source of no words has no demand, and nothing of it is placed
        share = at / F.when(need > 0, need)
        return F.struct(epoch.alias("epoch"), F.greatest(F.lit(0), F.least(words, need - at)).alias("words"),
                        time_of(share, F.col(f"{RESERVED}weight"), schedules).alias("position"))

    return (
        docs.withColumn(_KEY, order).join(aims, F.col(source).eqNullSafe(F.col(_ID)))
        .withColumn(_BUCKET, _bucket(F.col(_KEY), F.col(f"{RESERVED}bits")))
        .join(starts, F.col(source).eqNullSafe(F.col(f"{_ID}_in")) & (F.col(_BUCKET) == F.col(f"{_BUCKET}_of")))
        .withColumn(f"{RESERVED}start", start)
        .withColumn(f"{RESERVED}size", F.col(size))
        .withColumn("placements", F.filter(
            F.transform(F.array(*[F.lit(e).cast("long") for e in range(repeats)]), placement),
            lambda p: p["words"] > 0))
        .withColumns({
            "taken": F.aggregate("placements", F.lit(0).cast("long"), lambda a, p: a + p["words"]),
            "source_size": F.col(f"{RESERVED}source_size").cast("long"),
            "target": F.col(f"{RESERVED}target"),
        })
        .drop(_KEY, _BUCKET, f"{_BUCKET}_of", _ID, f"{_ID}_in",
              *[f"{RESERVED}{c}" for c in ("before", "start", "size", "bits", "source_size", "weight", "target", "need")])
    )


def n_words(text: Column) -> Column:
    return F.size(words_of(text)).cast("long")


def by_position(planned: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Planned documents range-sorted by their first ``position``, those not taken last."""
    out = planned.withColumn("position", F.get(F.col("placements")["position"], 0))
    order = [F.col("position").asc_nulls_last(), F.col(doc_id)]
    return out.repartitionByRange(*order).sortWithinPartitions(*order)


def mix(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", **options) -> DataFrame:
    """The mixed corpus: one row per copy taken, range-sorted by training position.

    Copies are whole: of the copy that crosses its source's target at least
    half must be wanted. Columns are those of ``docs``.
    """
    size, copy, apart = f"{RESERVED}words", f"{RESERVED}copy", f"{RESERVED}apart"
    names = {c: f"{RESERVED}in_{i}" for i, c in enumerate(docs.columns)}
    inner = docs.select(*[F.col(f"`{c}`").alias(a) for c, a in names.items()])
    sized = inner.withColumns({size: n_words(F.col(names[text])), apart: F.md5(F.col(names[text]).cast("binary"))})
    planned = plan(sized, names[doc_id], names[source], size, apart, **options)
    copies = (planned.select(*names.values(), size, F.explode("placements").alias(copy))
              .where(2 * F.col(f"{copy}.words") >= F.col(size)))
    order = [F.col(f"{copy}.position"), F.col(names[doc_id]), F.col(f"{copy}.epoch")]
    return (copies.repartitionByRange(*order).sortWithinPartitions(*order)
            .select(*[F.col(a).alias(c) for c, a in names.items()]))
