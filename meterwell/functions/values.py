"""Column helpers for missing values, exact sums, ratios and percent text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Measures with at most six decimals and below this size are summed as whole millionths.
UNITS = 1_000_000
COUNTED_BELOW = 1 << 24


def as_column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def without_nan(df: DataFrame) -> DataFrame:
    """`df` with NaN as null in its number columns: a measure is there or it is missing.

    Every reader of wide rows applies it to the months it has unpivoted, so no operator
    meets NaN.
    """
    numbers = [n for n, kind in df.dtypes if kind in ("double", "float")]
    return df.withColumns({n: F.nanvl(n, F.lit(None).cast("double")) for n in numbers})


def zero(c: str | Column) -> Column:
    """The value, or 0.0 where it is null."""
    return F.nvl(as_column(c), F.lit(0.0))


def _present(c: str | Column) -> Column:
    """The value as a double, null where it is NaN."""
    return F.nanvl(as_column(c).cast("double"), F.lit(None).cast("double"))


def number(c: str | Column) -> Column:
    """The value as a double, or 0.0 where it is null or NaN."""
    return zero(_present(c))


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or null."""
    return F.when(condition, 1).otherwise(0)


def exact_sum(value: str) -> Column:
    """`sum` of doubles; `value` is SQL text.

    Values with at most six decimals, give or take the last bits of a double, as money
    and minutes have, are summed as long counters of whole parts and millionths, so
    retries, partition counts and skew splits all give the same bits, at the speed of a
    plain double sum. What does not fit, finer, huge, infinite or NaN values, is summed as doubles and added: the total
    is that of `sum` for every input. Null when no value is present.
    """
    x = f"CAST({value} AS DOUBLE)"
    off = f"abs(rint({x} * {UNITS}) / {UNITS} - {x})"
    counted = f"(abs({x}) < {COUNTED_BELOW} AND {off} <= 1e-15D * abs({x}))"
    low = f"(rint({x} * {UNITS}) - floor({x}) * {UNITS})"
    whole = f"CAST(sum(CASE WHEN {counted} THEN CAST(floor({x}) AS BIGINT) END) AS DECIMAL(20, 0))"
    millionths = f"sum(CASE WHEN {counted} THEN CAST({low} AS BIGINT) END)"
    exact = f"CAST({whole} * {UNITS} + {millionths} AS DOUBLE) / {UNITS}"
    rest = f"sum(CASE WHEN NOT {counted} THEN {x} END)"
    return F.expr(f"CASE WHEN {rest} IS NULL THEN {exact} ELSE nvl({exact}, 0D) + {rest} END")


def exact_avg(value: str) -> Column:
    """Mean over present values, built on `exact_sum`; null when there are none."""
    return F.try_divide(exact_sum(value), F.expr(f"count({value})"))


def ratio(part: str | Column, whole: str | Column, digits: int) -> Column:
    """part / whole rounded half up; null when whole is 0."""
    return F.round(F.try_divide(as_column(part), as_column(whole)), digits)


def decline(now: str | Column, before: str | Column) -> Column:
    """Relative drop from `before` to `now`, 0.0 without a positive `before`."""
    before = as_column(before)
    return F.when(before > 0, F.round(1 - as_column(now) / before, 4)).otherwise(0.0)


def percent_text(part: str | Column, whole: str | Column) -> Column:
    """part / whole as text such as `12.3%`, rounded half up with integer arithmetic."""
    tenths = F.floor((2000 * as_column(part) + as_column(whole)) / (2 * as_column(whole)))
    return F.concat(
        F.floor(tenths / 10).cast("string"), F.lit("."), (tenths % 10).cast("string"), F.lit("%")
    )


def capped(c: str | Column, top: float) -> Column:
    """The value cut off at `top`; null stays null."""
    value = as_column(c)
    return F.when(value > top, F.lit(top)).otherwise(value)


def column_or(columns: list[str], name: str, default: Column) -> Column:
    """The column if the input has it, else a constant."""
    return F.col(name) if name in columns else default
