"""Exact quantiles per group, for groups of any size.

One plan for all sizes: count equal values (shuffled by group *and* value, so a hot group
spreads over all tasks), range-partition the distinct values into ordered slices, find from
the slices' totals which slice holds each wanted rank, and rank only inside those slices. No
task sees more than one slice, whichever group it belongs to, and a running sum may spill.

Ranks, not samples, decide the result; the sampling inside range partitioning only balances
the slices.
"""

from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.operators.rowjoin import row_join
from tidemark.session import store


def _position(n: Column, p: float) -> tuple[Column, Column]:
    """Rank ``(n - 1) * p`` as whole part and remainder share.

    Whole-number arithmetic on the decimal ``p`` stands for: in doubles, 100 * 0.07 is
    already above 7 and would pick the next rank.
    """
    share = Fraction(str(p))
    scaled = (n - 1) * F.lit(share.numerator)
    below = F.lit(share.denominator)
    return F.call_function("div", scaled, below), (scaled % below) / below


def _ranks(n: Column, p: float, interpolate: bool) -> tuple[Column, Column]:
    """Zero-based ranks of the values just below and above quantile ``p`` of ``n``."""
    if interpolate:
        low, rest = _position(n, p)
        return low, F.when(rest > 0, low + 1).otherwise(low)
    share = Fraction(str(p))
    up = n * F.lit(share.numerator) + F.lit(share.denominator - 1)
    rank = F.greatest(F.call_function("div", up, F.lit(share.denominator)) - 1, F.lit(0))
    return rank, rank


def _blend(n: Column, p: float, low: Column, high: Column) -> Column:
    """Linear interpolation between the two ranked values."""
    _, above = _position(n, p)
    return F.when(low == high, low).otherwise((1 - above) * low + above * high)


def _counted(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """How often each value occurs in each group, in ordered slices, written once."""
    counts = df.groupBy(*keys, value).agg(F.count("*").alias("_n"))
    sliced = counts.repartitionByRange(*keys, value).withColumn("_slice", F.spark_partition_id())
    # Slice borders are drawn anew whenever the shuffle is planned anew; all later steps must
    # see the same ones.
    return store(sliced, "quantile-slices")


def _slices(stored: DataFrame, keys: list[str], value: str) -> DataFrame:
    """One row for each slice of a group, with what the whole group holds. A group has at most
    as many slices as there are shuffle partitions."""
    known = F.when(F.col(value).isNotNull(), F.col("_n")).otherwise(F.lit(0))
    totals = stored.groupBy(*keys, "_slice").agg(
        F.sum("_n").alias("_slice_rows"), F.sum(known).alias("_slice_n"),
        F.sum(known * F.col(value)).alias("_slice_sum"),
        F.min(value).alias("_slice_min"), F.max(value).alias("_slice_max"),
    )
    group = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    earlier = group.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    n = F.sum("_slice_n").over(group)
    return totals.withColumns(
        {
            "_before": F.coalesce(F.sum("_slice_n").over(earlier), F.lit(0).cast("long")),
            "_group_n": n,
            "_mean": F.try_divide(F.sum("_slice_sum").over(group), n),
        }
    )


def _ranked(
    stored: DataFrame, slices: DataFrame, keys: list[str], value: str, probs: dict[str, float],
    interpolate: bool,
) -> DataFrame:
    """The quantiles of each group that has a value, ranked slice by slice."""
    wanted = [r for p in probs.values() for r in _ranks(F.col("_group_n"), p, interpolate)]
    local = [F.col(f"_r{i}") for i in range(len(wanted))]
    held = [(rank >= 0) & (rank < F.col("_slice_n")) for rank in local]
    targets = (
        slices.withColumns({f"_r{i}": rank - F.col("_before") for i, rank in enumerate(wanted)})
        .where(F.greatest(*held, F.lit(False)))
        .select(*keys, "_slice", "_group_n", *local)
    )

    # Rank the distinct values inside the slices that hold a wanted rank.
    values = stored.where(F.col(value).isNotNull())
    inside = row_join(values, targets, [*keys, "_slice"], "inner")
    running = Window.partitionBy(*keys, "_slice").orderBy(value)
    upto = F.sum("_n").over(running.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    last = F.col("_upto")

    def hit(rank: Column) -> Column:
        return F.max(F.when((rank < last) & (rank >= last - F.col("_n")), F.col(value)))

    ranked = inside.withColumn("_upto", upto).groupBy(*keys, "_group_n").agg(
        *(hit(rank).alias(f"_v{i}") for i, rank in enumerate(local))
    )
    n = F.col("_group_n")
    return ranked.select(
        *keys,
        *(
            _blend(n, p, F.col(f"_v{2 * i}"), F.col(f"_v{2 * i + 1}")).alias(name)
            for i, (name, p) in enumerate(probs.items())
        ),
    )


def _moments(
    stored: DataFrame, slices: DataFrame, keys: list[str], value: str, wanted: dict[str, str]
) -> DataFrame:
    """Moments of each group from its counted values; squares are summed about the mean."""
    means = slices.select(*keys, "_slice", "_mean")
    squares = row_join(stored, means, [*keys, "_slice"], "inner").groupBy(*keys).agg(
        F.sum(F.col("_n") * F.pow(F.col(value) - F.col("_mean"), 2)).alias("_m2"))
    totals = slices.groupBy(*keys).agg(
        F.sum("_slice_rows").alias("_rows"), F.sum("_slice_n").alias("_count"),
        F.max("_mean").alias("_mean"), F.min("_slice_min").alias("_min"),
        F.max("_slice_max").alias("_max"),
    )
    n = F.col("_count")
    found = {
        "rows": F.col("_rows"), "count": n, "mean": F.col("_mean"), "min": F.col("_min"),
        "max": F.col("_max"), "std": F.when(n > 1, F.sqrt(F.col("_m2") / (n - 1))),
    }
    if not keys:  # an empty table is one group without rows
        found |= {kind: F.coalesce(found[kind], F.lit(0).cast("long")) for kind in ("rows", "count")}
    return _merge(totals, squares, keys).select(
        *keys, *(found[kind].alias(name) for name, kind in wanted.items()))


def _merge(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Columns of two tables that each hold at most one row per group."""
    both = left.unionByName(right, allowMissingColumns=True)
    columns = [c for c in both.columns if c not in keys]
    return both.groupBy(*keys).agg(*(F.max(c).alias(c) for c in columns))


def grouped_quantiles(
    df: DataFrame,
    keys: list[str],
    value: str,
    probs: dict[str, float],
    moments: dict[str, str],
    interpolate: bool = True,
) -> DataFrame:
    """Moments and exact quantiles per group (all rows when ``keys`` is empty).

    ``moments`` names columns that are ``rows``, ``count`` (of values), ``mean``, ``std`` (of the
    sample), ``min`` or ``max``. NULL values count as rows only. ``interpolate`` blends the two
    neighbouring values; without it the result is the smallest value whose share of rows
    reaches the probability.

    ``df`` is read once, when the DataFrame is built: its counted values are written to the
    shared folder, and everything comes from them.
    """
    stored = _counted(df, keys, value)
    slices = _slices(stored, keys, value)
    ranked = _ranked(stored, slices, keys, value, probs, interpolate)
    if not moments:
        return _merge(slices.select(*keys).distinct(), ranked, keys) if keys else ranked
    return _merge(_moments(stored, slices, keys, value, moments), ranked, keys)


def exact_quantiles(
    df: DataFrame, keys: list[str], value: str, probs: dict[str, float], interpolate: bool = True
) -> DataFrame:
    """Exact quantiles per group; see :func:`grouped_quantiles`."""
    return grouped_quantiles(df, keys, value, probs, {}, interpolate)
