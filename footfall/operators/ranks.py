"""Running totals, dense positions, exact quantiles and histograms at any size.

A window without a partition, or partitioned by a handful of groups, would put a
whole population into one task. Here rows are spread by value range, each range
is totalled, and only the range totals are added up across ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions.ratios import ratio
from footfall.session import materialise

_PART, _GROUP = "_range", "_group"


def running_totals(
    df: DataFrame,
    by: list[str],
    order: list[str],
    before: dict[str, str],
    label: str,
    whole: dict[str, str] | None = None,
) -> DataFrame:
    """Add, per group, sums over all rows that sort strictly before each row.

    ``before`` maps a new column to the column it sums; ``whole`` does the same for
    sums over the entire group. ``by + order`` must identify a row. The range number
    is written out with the rows because it must not be computed twice: a repeated
    sampling pass could cut the ranges elsewhere.
    """
    whole = whole or {}
    spread = materialise(
        df.repartitionByRange(*by, *order).withColumn(_PART, F.spark_partition_id()), label
    )
    # As one struct, a group with a NULL key still equals itself in the join below.
    keys = [_GROUP] if by else []
    if by:
        spread = spread.withColumn(_GROUP, F.struct(*by))
    sums = spread.groupBy(*keys, _PART).agg(
        *[F.sum(c).alias(n) for n, c in {**before, **whole}.items()]
    )
    earlier = Window.partitionBy(*keys).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        *keys,
        _PART,
        *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"_{n}") for n in before],
        *[F.sum(n).over(Window.partitionBy(*keys)).alias(n) for n in whole],
    )
    inside = (
        Window.partitionBy(*keys, _PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    # Ranges are contiguous in (by, order), so there are at most (ranges + groups)
    # offset rows. Spark broadcasts them if they measure small; if not, both sides
    # meet in the partitioning that the window below needs anyway.
    joined = spread.join(offsets, [*keys, _PART])
    return joined.select(
        *df.columns,
        *whole,
        *[
            (F.col(f"_{n}") + F.coalesce(F.sum(c).over(inside), F.lit(0))).alias(n)
            for n, c in before.items()
        ],
    )


def positions(df: DataFrame, by: list[str], order: str, name: str, label: str) -> DataFrame:
    """Add a dense 0-based position per group in the order of a unique column.

    Rows are sorted within value ranges and numbered as they are written, so they are
    shuffled once; what is added afterwards is one offset per range and group.
    """
    at = "_at"
    ranged = df.repartitionByRange(*by, order).sortWithinPartitions(*by, order)
    placed = materialise(ranged.withColumn(at, F.monotonically_increasing_id()), label)
    # the id holds the number of the range above its 33 low bits, and the row's below
    placed = placed.withColumn(_PART, F.shiftright(at, 33)).withColumn(_GROUP, F.struct(F.lit(0), *by))
    sums = placed.groupBy(_GROUP, _PART).agg(F.count("*").alias("_rows"), F.min(at).alias("_first"))
    earlier = Window.partitionBy(_GROUP).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        _GROUP, _PART, (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift")
    )
    joined = placed.join(offsets, [_GROUP, _PART])
    return joined.select(*df.columns, (F.col(at) + F.col("_shift")).alias(name))


def value_table(
    df: DataFrame, by: list[str], column: str, sums: dict[str, Column] | None = None
) -> DataFrame:
    """The distinct values of a column per group, ranked and written once.

    Columns: ``value``, ``n`` rows with it, ``below`` rows with a smaller one, and the
    group's ``size`` and ``mean``. Any exact statistic of the group follows from this
    table without reading the data again. Rows without a value are kept under NULL
    with ``n = 0``, so ``sums`` (further aggregates) cover all rows.
    """
    counts = (
        df.groupBy(*by, F.col(column).cast("double").alias("value"))
        .agg(F.count(column).alias("n"), *[c.alias(name) for name, c in (sums or {}).items()])
        .withColumn("total", F.col("n") * F.coalesce("value", F.lit(0.0)))
    )
    ranked = running_totals(
        counts, by, ["value"], {"below": "n"}, "values", {"size": "n", "mean": "total"}
    )
    return ranked.drop("total").withColumn("mean", ratio(F.col("mean"), F.col("size")))


def quantiles(
    df: DataFrame, by: list[str], column: str, probs: list[float], method: str = "linear"
) -> DataFrame:
    """Exact quantiles per group, one row per group and probability."""
    return quantiles_of(value_table(df, by, column), by, probs, method)


def quantiles_of(
    values: DataFrame, by: list[str], probs: list[float], method: str = "linear"
) -> DataFrame:
    """Exact quantiles from a ``value_table``.

    ``linear`` interpolates between neighbours; ``index`` takes the sorted element
    at ``floor(p * n)``.
    """
    if method not in ("linear", "index"):
        raise ValueError("method must be 'linear' or 'index'")
    size = F.col("size")

    def wanted(p: float) -> Column:
        exact = F.lit(float(p)) * (size - 1)
        index = F.least(F.floor(F.lit(float(p)) * size), size - 1)
        low, high = (F.floor(exact), F.ceil(exact)) if method == "linear" else (index, index)
        return F.struct(
            F.lit(float(p)).alias("prob"),
            low.alias("low"),
            high.alias("high"),
            (exact - low if method == "linear" else F.lit(0.0)).alias("fraction"),
        )

    # A distinct value covers the sorted positions below .. below + n - 1 of its group,
    # so each row knows by itself which of the wanted positions it holds.
    def holds(position: Column) -> Column:
        return (position >= F.col("below")) & (position < F.col("below") + F.col("n"))

    hits = values.where(F.col("n") > 0).select(
        *by, "value", "below", "n", F.explode(F.array(*[wanted(p) for p in probs])).alias("q")
    ).where(holds(F.col("q.low")) | holds(F.col("q.high")))
    neighbours = hits.groupBy(*by, F.col("q.prob").alias("prob")).agg(
        F.max(F.when(holds(F.col("q.low")), F.col("value"))).alias("low"),
        F.max(F.when(holds(F.col("q.high")), F.col("value"))).alias("high"),
        F.max("q.fraction").alias("fraction"),
    )
    value = F.col("low") + (F.col("high") - F.col("low")) * F.col("fraction")
    return neighbours.select(*by, "prob", value.alias("quantile"))


def histogram(df: DataFrame, column: str, bins: int, by: list[str] | None = None) -> DataFrame:
    """Counts per equal-width bin over the common range of all groups.

    The largest value belongs to the last bin; a constant column has one bin.
    """
    by = by or []
    values = df.where(F.col(column).isNotNull()).select(*by, F.col(column).cast("double").alias("v"))
    span = values.select(F.struct(F.min("v").alias("low"), F.max("v").alias("high"))).scalar()
    width = (span["high"] - span["low"]) / F.lit(float(bins))
    place = F.least(
        F.floor(F.coalesce(ratio(F.col("v") - span["low"], width), F.lit(0.0))), F.lit(bins - 1)
    )
    return (
        values.select(*by, place.cast("int").alias("bin"))
        .groupBy(*by, "bin")
        .agg(F.count("*").alias("n"))
        .withColumn("bin_start", span["low"] + F.col("bin") * width)
        .withColumn("bin_end", span["low"] + (F.col("bin") + 1) * width)
    )
