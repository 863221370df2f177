"""Interquartile-range outlier flags with exact or approximate quartiles, of a whole frame or per group."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from farelane.model import OUTLIER_COLUMNS
from farelane.session import working_folder

QUARTILES = (0.25, 0.75)
#: First buckets per unit of the logarithm: each holds values within 0.3 % of each other.
_PER_LOG = 369.0


def group_quantiles(
    df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), probabilities: Sequence[float] = QUARTILES, buckets: int = 4096
) -> DataFrame:
    """Exact, linearly interpolated quantiles of numeric columns in each group of ``df``.

    One row (*by, column_name, n_values, quantiles) per group and column that has a value there;
    null groups are groups of their own.

    Spark's own exact percentile keeps every distinct value of a group in one buffer. Here the columns alone
    are written once, one row per value, and the values that hold the wanted ranks are searched
    for all groups and columns in the same passes: the first counts values in buckets of their logarithm, each
    further one cuts the bucket that holds a rank into ``buckets`` parts, until it has a single
    value. A pass is one scan with map-side aggregation; running counts go over the buckets of
    one group and column, whatever the data size. Amounts in cents take one or two passes, continuous values three. Infinite
    values rank first or last; NaN and null take no part.
    """
    groups = [f"_g{k}" for k in range(len(by))]
    keys = [*groups, "_c"]
    entries = [F.when(_number(c).isNotNull(), F.struct(F.lit(k).alias("_c"), _number(c).alias("_v"))) for k, c in enumerate(columns)]
    values = _landed(df.select(*[F.col(b).alias(g) for b, g in zip(by, groups)], F.inline(F.array_compact(F.array(*entries)))), "quantile-values")

    magnitude = F.floor(F.log1p(F.abs("_v")) * F.lit(_PER_LOG))
    first = values.groupBy(*keys, F.when(F.col("_v") < 0, -magnitude).otherwise(magnitude).alias("_bucket"))
    everything = Window.partitionBy(*keys)
    counted = _counted(first, keys).withColumn("_size", F.sum("_n").over(everything)).withColumn("_below", F.col("_upto") - F.col("_n"))
    positions = [F.lit(float(p)) * (F.col("_size") - 1) for p in probabilities]
    ranks = F.array_distinct(F.array(*[end(p) for p in positions for end in (F.floor, F.ceil)]))
    wanted = counted.select(*keys, "_size", F.explode(ranks).alias("_rank"), "_low", "_high", "_below", "_upto")
    found = [_landed(_holding(wanted, [*keys, "_size"]), "quantile-ranks")]
    while not (open_ := found.pop()).where("_low < _high").isEmpty():
        found.append(open_.where("_low = _high"))
        found.append(_landed(_narrowed(values, open_.where("_low < _high"), groups, buckets), "quantile-ranks"))
    closed = reduce(DataFrame.unionByName, [*found, open_])

    values_at = F.map_from_entries(F.collect_list(F.struct("_rank", "_low")))
    each = closed.groupBy(*keys, "_size").agg(values_at.alias("_at"))
    names = F.array(*map(F.lit, columns))
    quantiles = F.array(*[_interpolated(p) for p in positions])
    return each.select(
        *[F.col(g).alias(b) for b, g in zip(by, groups)],
        F.get(names, F.col("_c")).alias("column_name"),
        F.col("_size").alias("n_values"),
        quantiles.alias("quantiles"),
    )


def _counted(buckets, keys: Sequence[str]) -> DataFrame:
    """Rows, least and greatest value of each bucket, and the rows up to its end among the buckets of its key."""
    counts = buckets.agg(F.count("*").alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
    upto = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    return counts.withColumn("_upto", F.sum("_n").over(upto))


def _holding(buckets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Of the buckets offered for a rank, the one that holds it."""
    holds = (F.col("_below") <= F.col("_rank")) & (F.col("_rank") < F.col("_upto"))
    return buckets.where(holds).select(*keys, "_rank", "_low", "_high", "_below")


def _narrowed(values: DataFrame, intervals: DataFrame, groups: Sequence[str], buckets: int) -> DataFrame:
    """Each interval cut to the part that holds its rank."""
    sides = intervals.select(*[F.col(k).alias(f"{k}i") for k in (*groups, "_c")], "_size", "_rank", "_low", "_high", "_below")
    same = [F.col(k).eqNullSafe(F.col(f"{k}i")) for k in groups] + [F.col("_c") == F.col("_ci")]
    inside = values.join(sides, reduce(and_, same)).where(F.col("_v").between(F.col("_low"), F.col("_high")))
    part = F.floor((F.col("_v") - F.col("_low")) / (F.col("_high") - F.col("_low")) * F.lit(float(buckets)))
    keys = [*groups, "_c", "_size", "_rank"]
    # ``_below`` goes with the rank; kept as a key, it needs no join afterwards.
    cut = inside.withColumns({"_bucket": F.least(part, F.lit(buckets - 1)), "_start": F.col("_below")})
    counted = _counted(cut.groupBy(*keys, "_start", "_bucket"), [*keys, "_start"])
    offered = counted.withColumns({"_below": F.col("_start") + F.col("_upto") - F.col("_n"), "_upto": F.col("_start") + F.col("_upto")})
    return _holding(offered, [*groups, "_c", "_size"])


def _interpolated(position: Column) -> Column:
    """The value at a position between ranks, from the map ``_at`` of ranks to values."""
    lower, upper = (F.element_at("_at", end(position)) for end in (F.floor, F.ceil))
    weight = position - F.floor(position)
    return F.when((lower == upper) | (weight == 0), lower).otherwise(lower + (upper - lower) * weight)


def _landed(df: DataFrame, purpose: str) -> DataFrame:
    path = working_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float] = QUARTILES, buckets: int = 4096
) -> dict[str, list[float | None]]:
    """``group_quantiles`` of the whole frame, by column; None for a column without values."""
    found = {r.column_name: list(r.quantiles) for r in group_quantiles(df, columns, (), probabilities, buckets).collect()} if columns else {}
    return {c: found.get(c, [None] * len(probabilities)) for c in columns}


def _number(column: str) -> Column:
    """The column as a double, minus zero as zero; nulls and NaN take no part in quantiles."""
    value = F.col(column).cast("double") + F.lit(0.0)
    return F.when(~F.isnan(value), value)


def approximate_quartiles(df: DataFrame, columns: Sequence[str], accuracy: int = 100) -> dict[str, tuple[Column, Column]]:
    """Quartiles with rank error 1 / ``accuracy``, from a scalar subquery.

    Lazy: the aggregate runs inside the query that uses the columns. All of them
    are fields of one struct, so that every use refers to the same subquery and
    the data is read for it once.
    """
    if not columns:
        return {}
    both = [F.percentile_approx(_number(c), list(QUARTILES), accuracy).alias(f"q{i}") for i, c in enumerate(columns)]
    found = df.agg(F.struct(*both).alias("found")).scalar()
    return {c: (found[f"q{i}"][0], found[f"q{i}"][1]) for i, c in enumerate(columns)}


def quartiles(df: DataFrame, columns: Sequence[str], method: str = "exact") -> dict[str, tuple[Column, Column]]:
    """First and third quartile per column; NULL for a column without values."""
    if method == "approximate":
        return approximate_quartiles(df, columns)
    if method != "exact":
        raise ValueError(f"unknown quartile method {method!r}")
    return {
        column: tuple(F.lit(q).cast("double") for q in values)
        for column, values in exact_quantiles(df, columns).items()
    }


def flag_outliers(
    df: DataFrame,
    columns: Sequence[str] = OUTLIER_COLUMNS,
    multiplier: float = 1.5,
    method: str = "exact",
    by: Sequence[str] = (),
) -> DataFrame:
    """Adds ``<column>_outlier`` per column and ``has_outlier``; never null.

    Columns the frame does not have are skipped. The flags exist and are False
    on empty input as well. With ``by``, a row is measured by the bounds of its group.
    """
    present = [c for c in columns if c in df.columns]
    if not present:
        return df
    if by:
        return flag_by_bounds(df, outlier_bounds(df, present, multiplier, method, by), present, by)
    fences = {c: (low, high) for c, (_, _, low, high) in _fences(df, present, multiplier, method).items()}
    return _flagged(df, fences)


def flag_by_bounds(df: DataFrame, bounds: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """The flags of ``flag_outliers`` from a table of bounds, as ``outlier_bounds`` makes it, joined by group.

    A group or column without bounds has no outliers. The bounds are one row per group here; Spark
    broadcasts them if they are small.
    """
    groups = [f"_g{k}" for k in range(len(by))]
    of = lambda c, side: F.max(F.when(F.col("column_name") == c, F.col(f"{side}_bound"))).alias(f"_{side}_{c}")
    limits = bounds.select(*[F.col(b).alias(g) for b, g in zip(by, groups)], "column_name", "lower_bound", "upper_bound")
    limits = limits.groupBy(*groups).agg(*[of(c, side) for c in columns for side in ("lower", "upper")])
    joined = df.join(limits, reduce(and_, [df[b].eqNullSafe(limits[g]) for b, g in zip(by, groups)]), "left")
    flagged = _flagged(joined, {c: (F.col(f"_lower_{c}"), F.col(f"_upper_{c}")) for c in columns})
    flags = [*[f"{c}_outlier" for c in columns], "has_outlier"]
    return flagged.select(*[c for c in df.columns if c not in flags], *flags)


def _flagged(df: DataFrame, fences: dict[str, tuple[Column, Column]]) -> DataFrame:
    flags = {f"{c}_outlier": F.coalesce((F.col(c) < low) | (F.col(c) > high), F.lit(False)) for c, (low, high) in fences.items()}
    return df.withColumns(flags).withColumn("has_outlier", reduce(or_, map(F.col, flags)))


def outlier_bounds(
    df: DataFrame,
    columns: Sequence[str] = OUTLIER_COLUMNS,
    multiplier: float = 1.5,
    method: str = "exact",
    by: Sequence[str] = (),
) -> DataFrame:
    """One row per column, or per group and column: quartiles and the bounds derived from them.

    Of the whole frame every column has a row; of a group, every column with a value there.
    """
    if by:
        found = _group_quartiles(df, columns, method, by)
        quartile = [F.get("quantiles", F.lit(k)) for k in (0, 1)]
        rows = found.select(*by, "column_name", quartile[0].alias("q1"), quartile[1].alias("q3"))
        reach = F.lit(float(multiplier)) * (F.col("q3") - F.col("q1"))
        return rows.withColumns({"lower_bound": F.col("q1") - reach, "upper_bound": F.col("q3") + reach})
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            q1.alias("q1"),
            q3.alias("q3"),
            low.alias("lower_bound"),
            high.alias("upper_bound"),
        )
        for c, (q1, q3, low, high) in _fences(df, columns, multiplier, method).items()
    ]
    return df.sparkSession.range(1).select(F.inline(F.array(*rows)))


def _group_quartiles(df: DataFrame, columns: Sequence[str], method: str, by: Sequence[str], accuracy: int = 100) -> DataFrame:
    if method == "exact":
        return group_quantiles(df, columns, by)
    if method != "approximate":
        raise ValueError(f"unknown quartile method {method!r}")
    sketches = [F.percentile_approx(_number(c), list(QUARTILES), accuracy).alias(f"_q{k}") for k, c in enumerate(columns)]
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_q{k}").alias("quantiles")) for k, c in enumerate(columns)])
    return df.groupBy(*by).agg(*sketches).select(*by, F.inline(rows)).where("quantiles is not null")


def outlier_summary(flagged: DataFrame, columns: Sequence[str] = OUTLIER_COLUMNS) -> DataFrame:
    """One row: trips, trips with an outlier, their share, and a count per column."""
    counts = flagged.agg(
        F.count("*").alias("total_records"),
        F.count_if("has_outlier").alias("outlier_records"),
        *[F.count_if(f"{c}_outlier").alias(f"{c}_outliers") for c in columns],
    )
    share = F.try_divide("outlier_records", "total_records") * F.lit(100.0)
    return counts.withColumn("outlier_percentage", share)


def _fences(df: DataFrame, columns: Sequence[str], multiplier: float, method: str) -> dict[str, tuple[Column, ...]]:
    fences = {}
    for c, (q1, q3) in quartiles(df, columns, method).items():
        reach = F.lit(float(multiplier)) * (q3 - q1)
        fences[c] = (q1, q3, q1 - reach, q3 + reach)
    return fences
