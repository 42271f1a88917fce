"""Level arithmetic: thresholds, z-scores, grades, rounding, lookups."""

from itertools import chain

from pyspark.sql import Column, DataFrame, functions as F

# Grade names.
ALERT_RED, ALERT_AMBER, ALERT_NORMAL = "RED", "AMBER", "NORMAL"
RISK_VERY_HIGH, RISK_HIGH, RISK_MEDIUM, RISK_LOW = "Very high", "High", "Medium", "Low"
# Days until a station of a grade is looked at again.
REVIEW_DAYS = {RISK_LOW: 30, RISK_MEDIUM: 14, RISK_HIGH: 7, RISK_VERY_HIGH: 1}
LEVEL_FLOOR = 0.05


def very_high_threshold(mean: Column, std: Column, n_std: float = 2.0) -> Column:
    return mean + F.lit(n_std) * std


def z_score(level: Column, mean: Column, std: Column) -> Column:
    """Deviations from the mean; NULL when the deviation is unknown or zero."""
    return F.try_divide(level - mean, std)


def alert_level(
    level: Column, very_high: Column, high: Column, unknown: str = ALERT_NORMAL
) -> Column:
    """Grade a level. RED is tried first, so it also wins where ``high`` lies above
    ``very_high``. With no threshold at all the grade is ``unknown``."""
    graded = F.when(level >= very_high, ALERT_RED).when(level >= high, ALERT_AMBER)
    if unknown != ALERT_NORMAL:
        graded = graded.when(very_high.isNull() & high.isNull(), unknown)
    return graded.otherwise(ALERT_NORMAL)


def risk_level(level: Column, very_high: Column, high: Column, typical: Column) -> Column:
    """Four-step risk grade from three independent thresholds."""
    return (
        F.when(level >= very_high, RISK_VERY_HIGH)
        .when(level >= high, RISK_HIGH)
        .when(level >= typical, RISK_MEDIUM)
        .otherwise(RISK_LOW)
    )


def clamp_min(value: Column, floor: float = LEVEL_FLOOR) -> Column:
    """The value, at least ``floor``; NULL stays NULL."""
    return F.when(value.isNotNull(), F.greatest(value, F.lit(floor)))


def round_cols(df: DataFrame, columns: list[str], digits: int = 3) -> DataFrame:
    """Round table columns, exact halves to the even digit."""
    return df.withColumns({c: F.bround(F.col(c), digits) for c in columns})


def round_value(value: Column, digits: int = 3) -> Column:
    """Round one computed value, exact halves away from zero."""
    return F.round(value, digits)


def lookup(mapping: dict, key: Column) -> Column:
    """Value of a small fixed mapping, NULL for unknown keys.

    The mapping becomes a literal inside the plan; a table-sized mapping belongs in a
    join instead.
    """
    def literal(value):
        return F.struct(*map(F.lit, value)) if isinstance(value, tuple) else F.lit(value)

    entries = chain.from_iterable((F.lit(k), literal(v)) for k, v in mapping.items())
    return F.try_element_at(F.create_map(*entries), key)


def finite(value: Column) -> Column:
    """The value; NULL where it is no finite number."""
    return F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)


def observed_ranges(p05: Column, median: Column, p95: Column) -> dict[str, Column]:
    """Typical range and alert thresholds from a station's observed percentiles."""
    return {
        "typical_range_low": clamp_min(p05),
        "typical_range_high": median,
        "alert_threshold_high": (median + p95) / 2,
        "alert_threshold_very_high": p95,
    }
