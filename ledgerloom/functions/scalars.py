"""Column expressions shared by the jobs.

All of them stay built-in expressions and are safe with ANSI mode on: blank strings,
zero divisors and missing list positions give NULL or a stated default, never an error.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

ColumnLike = Column | str

RATIO_TYPE = "decimal(9,4)"
AMOUNT_TYPE = "decimal(28,6)"
MONEY_TYPE = "decimal(19,2)"


def as_col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(c: ColumnLike, trim: bool = True) -> Column:
    """TRUE for NULL and for an empty (after trimming) string; never NULL."""
    c = as_col(c)
    text = F.trim(c) if trim else c
    return c.isNull() | (text == "")


def nullif_blank(c: ColumnLike) -> Column:
    """The value, or NULL when it is the empty string. A blank join key then meets nothing."""
    return F.nullif(as_col(c), F.lit(""))


def safe_div(a: ColumnLike, b: ColumnLike, when_null=0) -> Column:
    """``a / b`` with NULL for a zero divisor and ``when_null`` for a missing divisor."""
    a, b = as_col(a), as_col(b)
    return F.when(b.isNull(), F.lit(when_null)).otherwise(F.try_divide(a, b))


def decode(c: ColumnLike, mapping: Mapping[str, str], default: str | None = None) -> Column:
    """Code to label; an unknown code keeps itself unless ``default`` is given."""
    c = as_col(c)
    label = None
    for code, text in mapping.items():
        label = F.when(c == code, F.lit(text)) if label is None else label.when(c == code, F.lit(text))
    return label.otherwise(c if default is None else F.lit(default))


def keep_unless(c: ColumnLike, value) -> Column:
    """Filter that drops rows equal to ``value`` and keeps NULLs."""
    return ~as_col(c).eqNullSafe(F.lit(value))


def after_first(c: ColumnLike, sep: str) -> Column:
    """Text after the first ``sep``; the whole text when there is none."""
    c = as_col(c)
    at = F.instr(c, sep)
    return F.when(at > 0, F.substr(c, at + F.lit(len(sep)))).otherwise(c)


def part_of(c: ColumnLike, sep: str, index: int) -> Column:
    """Element ``index`` of a separated list, NULL past its end."""
    return F.get(split_list(c, sep), F.lit(index))


def split_list(c: ColumnLike, sep: str) -> Column:
    return F.split(as_col(c), "\\Q" + sep + "\\E")


def clean_list(c: ColumnLike, sep: str, quote: str = "'") -> Column:
    """Separated list with quotes stripped; NULL and blank give one empty element."""
    return split_list(F.replace(F.coalesce(as_col(c), F.lit("")), F.lit(quote), F.lit("")), sep)


def elapsed_days(start: ColumnLike, end: ColumnLike) -> Column:
    """Fractional days from ``start`` to ``end`` at one-second resolution."""
    seconds = F.unix_timestamp(as_col(end).cast("timestamp")) - F.unix_timestamp(as_col(start).cast("timestamp"))
    return seconds / F.lit(3600.0) / F.lit(24.0)


def aging_days(c: ColumnLike, as_of: str) -> Column:
    """Whole days from the date in ``c`` to ``as_of``."""
    return F.datediff(F.lit(as_of).cast("date"), as_col(c).cast("date"))


def parse_date(c: ColumnLike, pattern: str = "yyyy/M/d") -> Column:
    """Date from text in ``pattern``; NULL when the text does not fit."""
    return F.try_to_timestamp(as_col(c), F.lit(pattern)).cast("date")


def day_text(c: ColumnLike) -> Column:
    return F.date_format(as_col(c), "yyyy-MM-dd")


def month_text(c: ColumnLike) -> Column:
    return F.date_format(as_col(c), "yyyy-MM")


def earliest_of(*cols: ColumnLike) -> Column:
    """Smallest non-NULL value."""
    return F.least(*[as_col(c) for c in cols])


def first_priced(*cols: ColumnLike, default=0) -> Column:
    """First non-NULL price in priority order. Zero counts as found."""
    return F.coalesce(*[as_col(c) for c in cols], F.lit(default))


def ratio_value(c: ColumnLike) -> Column:
    """Percentage as a number; blank, non-numeric and zero all mean "no ratio" (NULL)."""
    return F.nullif(as_col(c).try_cast(RATIO_TYPE), F.lit(0).cast(RATIO_TYPE))


def ratio_amount(amount: ColumnLike, ratio: ColumnLike) -> Column:
    """Amount grossed up by a percentage, unchanged when there is no ratio.

    Rounded to six decimals per row, so that sums do not depend on the order of rows.
    """
    amount, r = as_col(amount).cast("decimal(24,6)"), ratio_value(ratio)
    return F.when(r.isNotNull(), (amount * F.lit(100) / r).cast(AMOUNT_TYPE)).otherwise(amount.cast(AMOUNT_TYPE))


def int_part(c: ColumnLike) -> Column:
    """Whole part of a number (truncated toward zero), NULL when it is not one."""
    return as_col(c).try_cast("decimal(38,6)").try_cast("bigint")


def first_name(c: ColumnLike, other: str) -> Column:
    """Name, or a fixed text when there is none."""
    return F.coalesce(as_col(c), F.lit(other))
