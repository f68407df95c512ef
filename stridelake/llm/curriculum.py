"""Mixing sources to target weights by a curriculum that varies over training, in native expressions.

Each source has a target number of words and a weight schedule over training time 0..1. The schedule's integral times
the target is the demand up to a time; a copy of a document stands where the demand reaches the copy's middle, and the
mix is range-sorted by that position. A source's documents come in a fixed pseudo-random order, pass after pass; the
last pass ends where the next whole document would exceed the target, and one more document of the size nearest to
what is missing closes the gap, if that comes nearer.

Only one line for each source is aggregated on the way; levels and targets come from totals of those lines.

NULL texts and texts without words have size 0 and are never taken. NULL sources are a source of their own, last in
the order. Repeated rows are documents of their own; equal rows are interchangeable. Columns of ``docs`` that clash
with a computed one are replaced. An empty table gives an empty mix.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stridelake.llm.common import laid_out, running, stored, word_count

#: Weights by rank of the source, repeating; share of all words that the mix holds; most passes over a source.
WEIGHTS, SHARE, PASSES = (5, 2, 1), 1.5, 2.0
#: Where a row lies in the stored order of its source.
HANDLE = ("_part", "_row")
#: Schedule (time, relative weight) by rank of the source, repeating, linear in between.
SCHEDULES = (
    ((0.0, 1.5), (0.7, 1.0), (1.0, 0.5)),
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 0.2), (0.5, 1.0), (1.0, 2.0)),
)


def _pick(values: Sequence, rank: Column) -> Column:
    return F.element_at(F.array(*[F.lit(float(v)) for v in values]), (F.pmod(rank, F.lit(len(values))) + 1).cast("int"))


def source_targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, passes: float = PASSES) -> DataFrame:
    """``source, source_size, source_rank, weight, target``.

    Targets are weight times one common level, at most ``passes`` times the source's size. The level is found by
    fixing the sources that exceed it and sharing the rest again, from two totals each time.
    """
    per = stored(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    ranked = running(laid_out(per, [F.asc_nulls_last("source")], "sources"), None, "source_rank").drop("_part", "_row")
    ranked = stored(ranked.withColumn("weight", _pick(weights, F.col("source_rank"))), "sources")
    cap = passes * F.col("source_size")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while True:
        full = cap <= level * F.col("weight")
        fixed, free = ranked.agg(F.sum(F.when(full, cap)), F.sum(F.when(~full, F.col("weight")))).first()
        if not free:
            break
        higher = (share * total - (fixed or 0.0)) / free
        if higher <= level:
            break
        level = higher
    return ranked.withColumn("target", F.least(cap, F.lit(level) * F.col("weight")))


def _time(knots: Sequence[tuple[float, float]]) -> Callable[[Column], Column]:
    """Function that gives the time at which a share of the schedule's integral is reached."""
    areas = [(t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:])]

    def at(u: Column) -> Column:
        goal, done, out = u * sum(areas), 0.0, F
        for ((t0, w0), (t1, w1)), area in zip(zip(knots, knots[1:]), areas):
            slope, rest = (w1 - w0) / (t1 - t0), F.greatest(goal - done, F.lit(0.0))
            root = F.sqrt(F.greatest(w0 * w0 + 2 * slope * rest, F.lit(0.0)))
            done += area
            out = out.when(goal <= done, F.least(F.lit(t0) + 2 * rest / (w0 + root), F.lit(t1)))  # stable at slope 0 too
        return out.otherwise(F.lit(knots[-1][0]))

    return at


def mix(docs: DataFrame, weights=WEIGHTS, schedules=SCHEDULES, share: float = SHARE, passes: float = PASSES,
        keep_text: bool = True) -> DataFrame:
    """``docs`` with ``size, source_size, target, taken`` and ``positions``, the times at which its copies are used.

    Without ``keep_text`` only the slim columns are sorted and joined.
    """
    return _drawn(docs, weights, schedules, share, passes, keep_text).drop(*HANDLE)


def _drawn(docs: DataFrame, weights, schedules, share: float, passes: float, keep_text: bool) -> DataFrame:
    """The mix with each row's handle, as it lies in the pseudo-random order of the sources."""
    added = ("size", "source_size", "source_rank", "weight", "target", "taken", "positions", "order_hash", "text_hash")
    rows = docs.drop(*added).withColumns({
        "size": word_count(F.col("text")), "order_hash": F.xxhash64("doc_id", F.lit("mix")), "text_hash": F.xxhash64("text")})
    rows = rows if keep_text else rows.drop("text")
    placed = laid_out(rows, ["source", "order_hash", "doc_id", "text_hash"], "mix")
    slim = placed.select("source", "size", "order_hash", "_part", "_row")
    targets = source_targets(slim, weights, share, passes)
    drawn = running(slim, "size", "before", by=["source"])
    same = F.col("source").eqNullSafe(F.col("of"))
    drawn = drawn.join(targets.withColumnRenamed("source", "of"), same).drop("of")
    end, whole = F.col("before") + F.col("size"), F.floor(F.col("target") / F.col("source_size"))
    # passes that end, with this document, within the target
    copies = F.when(F.col("size") > 0, F.greatest(F.floor((F.col("target") - end) / F.col("source_size")) + 1, F.lit(0))).otherwise(0)
    drawn = stored(drawn.withColumn("copies", copies.cast("int")), "drawn")
    missing = F.first("target") - F.sum(F.col("copies") * F.col("size"))
    gap = drawn.groupBy("source").agg(missing.alias("missing")).select(F.col("source").alias("of"), "missing")
    near = F.abs(F.col("size") - F.col("missing"))
    spare = drawn.join(gap, same).where((F.col("size") > 0) & (F.col("copies") <= whole) & (F.col("copies") + 1 <= passes))
    spare = spare.where(near < F.col("missing"))
    last = spare.groupBy("of").agg(F.min(F.struct(near.alias("near"), "order_hash", "_part", "_row")).alias("last"))
    last = last.select(F.col("last._part").alias("_part"), F.col("last._row").alias("_row"), F.lit(True).alias("closes"))
    drawn = drawn.join(last, ["_part", "_row"], "left").withColumn("closes", F.coalesce("closes", F.lit(False)))
    middle = (F.col("before") + F.col("size") / 2)
    shares = F.transform(
        F.when(F.col("copies") > 0, F.sequence(F.lit(0), F.col("copies") - 1)).otherwise(F.array().cast("array<int>")),
        lambda k: F.least((middle + k * F.col("source_size")) / F.col("target"), F.lit(1.0)))
    shares = F.when(F.col("closes"), F.array_append(shares, F.lit(1.0))).otherwise(shares)
    rank = F.pmod("source_rank", F.lit(len(schedules)))
    positions = F.lit(None)
    for i, knots in enumerate(schedules):
        positions = F.when(rank == i, F.transform(shares, _time(knots))).otherwise(positions)
    taken = (F.col("copies") + F.col("closes").cast("int")) * F.col("size")
    drawn = drawn.select("_part", "_row", "source_size", "target", taken.cast("long").alias("taken"), positions.alias("positions"))
    return placed.drop("order_hash", "text_hash").join(drawn, list(HANDLE))


def training_order(mixed: DataFrame) -> DataFrame:
    """One row for each use of a document, range-sorted by its ``position``."""
    uses = mixed.select("*", F.explode("positions").alias("position")).drop("positions")
    return uses.repartitionByRange("position", "doc_id").sortWithinPartitions("position", "doc_id")


def placed_mix(docs: DataFrame, weights=WEIGHTS, schedules=SCHEDULES, share: float = SHARE, passes: float = PASSES) -> DataFrame:
    """``mix`` without texts, and ``places``: where the uses of the document stand in the training order, from 0.

    The uses of all documents are range-sorted by ``position`` and numbered without gaps; equal positions are ordered by
    ``doc_id``, then as the sources' pseudo-random orders have them. A document that is never taken has no places.
    """
    mixed = stored(_drawn(docs, weights, schedules, share, passes, keep_text=False), "mixed")
    of = [f"_of{c}" for c in HANDLE]
    uses = mixed.select(*[F.col(c).alias(o) for c, o in zip(HANDLE, of)], "doc_id", F.explode("positions").alias("position"))
    ordered = running(laid_out(uses, ["position", "doc_id", *of], "uses"), None, "place")
    places = ordered.groupBy(*of).agg(F.sort_array(F.collect_list("place")).alias("places"))
    same = (F.col("_part") == F.col(of[0])) & (F.col("_row") == F.col(of[1]))
    return mixed.drop("places").join(places, same, "left").withColumn("places", F.coalesce("places", F.array().cast("array<bigint>"))).drop(*HANDLE, *of)
