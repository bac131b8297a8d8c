"""Money, ratio, label and period expressions."""

from __future__ import annotations

from collections.abc import Iterable
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closeworks.config import CATEGORY_BY_FIRST_DIGIT, CATEGORY_RANK, PHASE_NAMES

# Digits after the point that sums of amounts and of rates keep.
MONEY = 4
RATE = 12

# Amounts are summed in three parts of so many bits, the upper one open.
PART_BITS = 21
# Largest number of units of one amount, about 10 ** 25.
MAX_UNITS = 2.0**83


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- sums and ratios --------------------------------------------------------


def unit_sum(c: Column | str, digits: int = MONEY) -> Column:
    """Sum of a double column in whole units of ``10 ** -digits``; see ``amount_of``.

    A double sum depends on the order in which tasks finish. This one does not, so a
    rerun after a lost executor publishes the same figures. Summing decimals would do
    too, at ten times the cost per row. The units are split into three parts while they
    are still a double, which is exact, and each part is added up as whole numbers.

    NaN and infinite amounts count as missing, with ANSI mode on or off. An amount of more than
    ``MAX_UNITS`` units is an error in both modes.
    """
    units = F.rint(_col(c).cast("double") * F.lit(10.0**digits))
    finite = ~F.isnan(units) & (F.abs(units) != F.lit(float("inf")))
    units = F.when(finite & (F.abs(units) > MAX_UNITS), F.raise_error(F.lit("amount out of range")).cast("double")).when(
        finite, units
    )
    size = F.lit(2.0**PART_BITS)
    middle = F.floor(units / size).cast("double")
    upper = F.floor(middle / size).cast("double")
    parts = (units - middle * size, middle - upper * size, upper)
    total_units = None
    for i, part in enumerate(parts):
        scale = F.lit(1 << (PART_BITS * i)).cast("decimal(14,0)")
        added = F.sum(part.cast("bigint")).cast("decimal(20,0)") * scale
        total_units = added if total_units is None else total_units + added
    return total_units


def amount_of(units: Column, digits: int = MONEY) -> Column:
    return units.cast("double") / F.lit(10.0**digits)


def total(c: Column | str) -> Column:
    """Sum of amounts, independent of the row order."""
    return amount_of(unit_sum(c))


def total_when(condition: Column, c: Column | str) -> Column:
    """``SUM(CASE WHEN condition THEN c ELSE 0 END)``."""
    return total(F.when(condition, _col(c)).otherwise(F.lit(0.0)))


def mean(c: Column | str, digits: int = MONEY) -> Column:
    """Average as exact sum over count, independent of the row order."""
    return F.try_divide(amount_of(unit_sum(c, digits), digits), F.count(_col(c)))


def percent_of(part: Column, whole: Column) -> Column:
    """``part / |whole| * 100``; NULL when ``whole`` is zero or NULL."""
    return F.try_divide(part, F.abs(whole)) * F.lit(100.0)


def percent_or_zero(part: Column, whole: Column) -> Column:
    """``part / |whole| * 100``; 0 when ``whole`` is zero or NULL."""
    return F.when(whole != 0, percent_of(part, whole)).otherwise(F.lit(0.0))


def margin_percent(profit: Column, revenue: Column) -> Column:
    """``profit / revenue * 100`` with the sign of revenue; NULL on zero revenue."""
    return F.try_divide(profit, revenue) * F.lit(100.0)


def percent_text(failed: Column, checked: Column) -> Column:
    """``failed / checked`` as text with two decimals, e.g. ``12.50``.

    Worked out in whole numbers so that the text never depends on how a double prints.
    """
    hundredths = F.when(checked > 0, F.floor(F.try_divide(failed * 20000 + checked, checked * 2))).otherwise(F.lit(0))
    return F.concat(
        F.floor(hundredths / 100).cast("string"),
        F.lit("."),
        F.lpad((hundredths % 100).cast("string"), 2, "0"),
    )


# --- labels -----------------------------------------------------------------


def decode(c: Column | str, labels: dict, default: str | None = None) -> Column:
    """Simple CASE: ``labels[c]``, or ``default``."""
    pairs = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in labels.items()))
    found = F.try_element_at(pairs, _col(c))
    return found if default is None else F.coalesce(found, F.lit(default))


def banded(c: Column, bands: Iterable[tuple[float, str]], otherwise: str, strict: bool = True) -> Column:
    """First label whose limit ``c`` exceeds (``strict``) or stays within (not ``strict``)."""
    out = None
    for limit, label in bands:
        hit = c > limit if strict else c <= limit
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(F.lit(otherwise))


def account_category(code: Column | str = "account_code", other: str = "Other") -> Column:
    code = _col(code)
    out = None
    for digit, label in CATEGORY_BY_FIRST_DIGIT.items():
        hit = code.startswith(digit)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(F.lit(other))


def category_rank(category: Column | str = "account_category") -> Column:
    out = None
    for label, rank in CATEGORY_RANK.items():
        hit = _col(category) == label
        out = F.when(hit, rank) if out is None else out.when(hit, rank)
    return out.otherwise(F.lit(4))


def phase_name(phase: Column | str = "phase", default: str | None = None) -> Column:
    return decode(phase, PHASE_NAMES, default)


def has_all(c: Column, required: Iterable) -> Column:
    """Elements of ``required`` that the array ``c`` lacks, sorted."""
    return F.sort_array(F.array_except(F.array(*[F.lit(r) for r in required]), c))


def falsy_null(condition: Column) -> Column:
    """Three-valued logic to two: NULL counts as false."""
    return F.coalesce(condition, F.lit(False))


# --- periods (YYYY-MM strings) ----------------------------------------------


def period_shift(period: Column | str, months: int) -> Column:
    return F.date_format(F.add_months(period_start(period), months), "yyyy-MM")


def prior_period(period: Column | str, months_back: int = 1) -> Column:
    return period_shift(period, -months_back)


def period_start(period: Column | str) -> Column:
    """First day of the period as a date; NULL when the text is no period."""
    return F.to_date(F.try_to_timestamp(_col(period), F.lit("yyyy-MM")))


def closing_period(as_of: Column | str) -> Column:
    """Period being closed on a day: the month before while the day is below 10."""
    as_of = _col(as_of).cast("date")
    day = F.dayofmonth(as_of)
    closing = F.when(day < 10, F.date_sub(as_of, day + 5)).otherwise(as_of)
    return F.date_format(closing, "yyyy-MM")


def phase_deadline(now: Column | str, phase: Column | str, sla_hours: dict[int, int]) -> Column:
    hours = decode(phase, sla_hours)
    return _col(now) + F.make_dt_interval(F.lit(0), hours)


# --- scoping ----------------------------------------------------------------


def in_period(df: DataFrame, period: str | None, column: str = "closure_period") -> DataFrame:
    """Rows of one period, or all of them when ``period`` is None."""
    return df if period is None else df.filter(F.col(column) == period)


def newest_period(df: DataFrame, source: DataFrame | None = None, column: str = "closure_period") -> DataFrame:
    """Rows of the newest period in ``source`` (default: in ``df``), by scalar subquery."""
    newest = (df if source is None else source).select(F.max(column).alias("_newest"))
    return df.filter(F.col(column) == newest.scalar())
