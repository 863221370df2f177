"""Mixing sources to target weights along a curriculum that changes over training time.

Sources share a budget of words by weight, each at most so many times its size; what a full
source cannot take is shared again among the others (one pass over the sources in the order
in which they fill up). A source's weight changes over training time: its schedule is linear
between knots, and its integral, scaled to the target, is the number of words asked for until a
time. The documents of a source stand in a shuffled order that depends on the seed and
the rows alone; where the running sum of their words meets the demand is found by solving the
integral for the time, which is the document's position. After the last document a source starts
anew, until its target is met; the copy that meets it is taken in part. A range sort by position
gives the training order.

Running sums of a hot source are no single task's work: its order is cut into slices of a
bounded mean number of rows, whose sums are added up first. All of it is built-in functions.

Cases, by definition:

* null and empty texts have size 0; they are taken as 0 words and have no position;
* a null source is a source of its own, the last one; sources without words have target 0;
* rows that repeat an id, or are null there, are rows of their own; equal rows are interchangeable;
* an empty table stays empty; very long texts are counted whole; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from farelane.llm.common import land, let, words_of

#: (time, level) at the knots of a weight schedule, from time 0 to 1.
Schedule = tuple[tuple[float, float], ...]


@dataclass(frozen=True)
class Mix:
    """What to mix: weights repeat over the sources in code point order, with one schedule each."""

    weights: tuple[int, ...] = (5, 2, 1)
    #: Words of the mix, as a percentage of all words.
    share: int = 150
    #: How often a source is taken at most.
    most: int = 2
    #: Heavy sources fade out, middle ones swell towards the middle, light ones come late.
    schedules: tuple[Schedule, ...] = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 0.5), (0.5, 1.5), (1.0, 0.5)), ((0.0, 0.25), (0.75, 0.5), (1.0, 4.0)))
    seed: str = "mix"
    #: Rows of a source in one slice, on average.
    slice_rows: int = 4096


def integral(schedule: Schedule) -> list[float]:
    """The schedule's integral from 0 to each knot."""
    sums = [0.0]
    for (t, v), (u, w) in zip(schedule, schedule[1:]):
        sums.append(sums[-1] + (v + w) / 2 * (u - t))
    return sums


def time_of(schedule: Schedule, done: Column) -> Column:
    """The time at which the share ``done`` (0 to 1) of the schedule's integral is reached."""
    sums = integral(schedule)
    reached = done * F.lit(sums[-1])
    time = F.lit(1.0)
    for (t, v), (u, w), before, after in reversed(list(zip(schedule, schedule[1:], sums, sums[1:]))):
        rest, slope = reached - F.lit(before), (w - v) / (u - t)
        # v * x + slope / 2 * x * x = rest, solved without cancellation.
        root = F.sqrt(F.greatest(F.lit(v * v) + F.lit(2 * slope) * rest, F.lit(0.0)))
        time = F.when(reached < F.lit(after), F.lit(t) + F.try_divide(F.lit(2.0) * rest, F.lit(v) + root)).otherwise(time)
    return F.coalesce(time, F.lit(0.0))


def sized(docs: DataFrame, seed: str) -> DataFrame:
    """(doc_id, source, size, place): the words of each row and its place in the shuffled order, of 60 bits."""
    key = F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.coalesce("text", F.lit("")))
    return docs.select(
        "doc_id",
        "source",
        F.size(words_of(F.col("text"))).cast("long").alias("size"),
        F.conv(F.substring(F.md5(F.encode(key, "UTF-8")), 1, 15), 16, 10).cast("long").alias("place"),
    )


def targets(rows: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """(number, source, source_size, n_rows, slot, target) per source of ``rows`` (columns source, size).

    The windows see one row per source.
    """
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_rows"))
    named = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*map(F.lit, mix.weights))
    sources = sources.withColumn("number", F.row_number().over(named)).withColumn("slot", (F.col("number") - 1) % len(mix.weights))
    sources = sources.withColumn("weight", F.get(weights, F.col("slot")).cast("long"))
    # In the order in which they fill up: source i is full if its even share of the rest exceeds what it may give.
    filling = Window.orderBy(F.col("source_size") / F.col("weight"), "number")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sums = sources.withColumns(
        {
            "full_before": F.coalesce(F.sum("source_size").over(before), F.lit(0)),
            "weight_left": F.sum("weight").over(filling.rowsBetween(0, Window.unboundedFollowing)),
            "total": F.sum("source_size").over(everything),
        }
    )
    rest = F.col("total") * mix.share - F.col("full_before") * (100 * mix.most)
    limit = (F.col("source_size") * (100 * mix.most)).cast("double") * F.col("weight_left").cast("double")
    sums = sums.withColumn("is_full", limit <= F.col("weight").cast("double") * rest.cast("double"))
    open_ = F.when(~F.col("is_full"), F.col("weight"))
    sums = sums.withColumns(
        {
            "open_weight": F.sum(open_).over(everything),
            "full_size": F.coalesce(F.sum(F.when(F.col("is_full"), F.col("source_size"))).over(everything), F.lit(0)),
        }
    )
    shared = F.col("weight") * (F.col("total") * mix.share - F.col("full_size") * (100 * mix.most))
    target = F.when(F.col("is_full"), (F.col("source_size") * mix.most).cast("double")).otherwise(
        shared.cast("double") / (F.col("open_weight") * 100).cast("double")
    )
    return sums.select("number", "source", "source_size", "n_rows", "slot", target.alias("target"))


def _with_start(rows: DataFrame, slice_rows: int) -> DataFrame:
    """``rows`` with ``start``, the words of their source before them in the shuffled order."""
    slices = F.ceil(F.col("n_rows") / slice_rows)
    sliced = rows.withColumn("slice", F.shiftright(F.shiftright("place", 28) * slices, 32))
    sums = sliced.groupBy("number", "slice").agg(F.sum("size").alias("slice_size"))
    earlier = Window.partitionBy("number").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("number", "slice", F.coalesce(F.sum("slice_size").over(earlier), F.lit(0)).alias("offset"))
    within = Window.partitionBy("number", "slice").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    summed = sliced.withColumn("inside", F.coalesce(F.sum("size").over(within), F.lit(0)))
    return summed.join(offsets, ["number", "slice"]).withColumn("start", F.col("offset") + F.col("inside")).drop("slice", "inside", "offset")


def curriculum(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """One row per row of ``docs`` (columns doc_id, text, source), range-sorted by first position.

    (doc_id, source, size, source_size, target, copies, place); copies holds (epoch, taken, position)
    of each time the document is taken, position from 0 to 1. Rows not taken come last.
    """
    rows = land(sized(docs, mix.seed), "mix-sizes")
    sources = land(targets(rows, mix), "mix-targets")
    joined = rows.join(sources.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    placed = _with_start(joined, mix.slice_rows)

    def copy(epoch: Column) -> Column:
        start = F.col("start") + epoch * F.col("source_size")
        done = F.try_divide(start.cast("double"), F.col("target"))
        taken = F.least(F.col("size"), F.floor("target") - start)
        time = reduce(
            lambda other, k: F.when(F.col("slot") == k, time_of(mix.schedules[k], done)).otherwise(other), range(len(mix.weights)), F.lit(0.0)
        )
        return F.struct(epoch.alias("epoch"), taken.alias("taken"), time.alias("position"))

    copies = F.filter(F.array(*[copy(F.lit(e)) for e in range(mix.most)]), lambda c: c["taken"] > 0)
    found = placed.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"), "place")
    first = F.get("copies", F.lit(0))["position"].asc_nulls_last()
    return found.repartitionByRange(first, "place").sortWithinPartitions(first, "place")


def training_order(mixed: DataFrame) -> DataFrame:
    """(doc_id, source, epoch, taken, position): every copy of a curriculum, range-sorted by position."""
    copies = mixed.select("doc_id", "source", "place", F.explode("copies").alias("c")).select("doc_id", "source", "place", "c.*")
    order = ("position", "source", "place", "epoch")
    return copies.repartitionByRange(*order).sortWithinPartitions(*order).drop("place")


def taken_words(copies: Column) -> Column:
    """The words of all copies of a document."""
    return let(copies, lambda some: F.aggregate(some, F.lit(0).cast("long"), lambda total, c: total + c["taken"]))
