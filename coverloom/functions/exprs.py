"""Column expressions shared by all plans. Everything stays inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Iterable
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Open end date, risk-product classes.
OPEN_END = "5999-01-01 00:00:00"
RISK_PRODUCTS = ("05", "06", "07", "08", "09", "10", "11", "12")

SAS = "sas"  # a missing number is lower than any number, a missing text is blank
SQL = "sql"  # a comparison with NULL is unknown


def col(name: str | Column) -> Column:
    """Column by name; names holding ``$`` or ``.`` need no quoting by the caller."""
    return name if isinstance(name, Column) else F.col(f"`{name}`")


def text(c: str | Column) -> Column:
    return col(c).cast("string")


def padded(c: str | Column, width: int) -> Column:
    """Zero-padded text; longer values are cut to ``width`` and NULL stays NULL."""
    return F.lpad(text(c), width, "0")


def key(*parts: tuple[str | Column, int]) -> Column:
    """Composite text key from ``(column, width)`` parts; NULL if any part is NULL."""
    return F.concat(*[padded(c, w) for c, w in parts])


def valid_date(digits: Column) -> Column:
    """``yyyyMMdd`` text to date, NULL when it is no date or the year is 0."""
    return F.when(F.substring(digits, 1, 4) != "0000", F.try_to_date(digits, "yyyyMMdd"))


def ymd(year: str, month: str, day: str) -> Column:
    """Date from three integer columns, NULL when they form none or the year is 0.

    Same result as ``valid_date`` over the padded parts. Plain days are built by arithmetic; text
    is parsed only for 29 February and for parts wider than their place. One SQL text per date
    keeps plan building cheap, as some rows have ten dates.
    """
    y, m, d = f"`{year}`", f"`{month}`", f"`{day}`"
    digits = f"lpad({y}, 4, '0') || lpad({m}, 2, '0') || lpad({d}, 2, '0')"
    return F.expr(f"""CASE
        WHEN {y} BETWEEN 1 AND 9999 AND {m} BETWEEN 1 AND 12 AND {d} BETWEEN 1 AND 31
             AND ({d} <= 28 OR ({m} <> 2 AND ({d} <= 30 OR {m} NOT IN (4, 6, 9, 11)))) THEN make_date({y}, {m}, {d})
        WHEN {y} > 9999 OR {m} > 99 OR {d} > 99 OR ({m} = 2 AND {d} = 29)
             THEN CASE WHEN lpad({y}, 4, '0') <> '0000' THEN try_to_date({digits}, 'yyyyMMdd') END
        END""")


def triple(prefix: str, stem: str) -> Column:
    """Date from the three columns ``<prefix>A<stem>``, ``<prefix>M<stem>``, ``<prefix>D<stem>``."""
    return ymd(*[f"{prefix}{part}{stem}" for part in "AMD"])


def as_ntz(c: Column) -> Column:
    return c.cast("timestamp_ntz")


def open_end() -> Column:
    return as_ntz(F.lit(OPEN_END))


def is_open(c: str | Column) -> Column:
    """True for a validity end on the sentinel day."""
    return col(c).cast("date") == F.lit(OPEN_END[:10]).cast("date")


def at(run_ts: str) -> Column:
    """The one pinned time of a run, as a literal."""
    return as_ntz(F.lit(run_ts))


def cents(c: str | Column, precision: int = 18, scale: int = 5) -> Column:
    """Exact decimal value of an amount held in hundredths."""
    exact = col(c).cast("decimal(24,2)") * F.lit(Decimal("0.01"))
    return exact.cast(f"decimal({precision},{scale})")


def least_strict(*cs: Column) -> Column:
    """Smallest argument, NULL if any argument is NULL (``least`` alone skips NULLs)."""
    any_null = F.lit(False)
    for c in cs:
        any_null = any_null | c.isNull()
    return F.when(~any_null, F.least(*cs))


def differs(c: str | Column, value: str, missing: str = SAS) -> Column:
    c = col(c)
    return (F.coalesce(c, F.lit("")) if missing == SAS else c) != value


def below(c: str | Column, bound: int, missing: str = SAS) -> Column:
    c = col(c)
    return (F.coalesce(c, F.lit(bound - 1)) if missing == SAS else c) < bound


def unless(condition: Column, missing: str = SAS) -> Column:
    """NOT condition; with ``missing="sas"`` an unknown condition counts as false."""
    return ~(F.coalesce(condition, F.lit(False)) if missing == SAS else condition)


def blank_to_null(c: str | Column) -> Column:
    c = col(c)
    return F.when(c != "", c)


def dot_to_blank(c: str | Column) -> Column:
    """Trimmed text where the lone missing marker ``.`` becomes the empty text."""
    t = F.trim(text(c))
    return F.when(t == ".", "").otherwise(t)


def without_dots(c: str | Column) -> Column:
    return F.trim(F.translate(text(c), ".", ""))


def has_content(c: str | Column) -> Column:
    """True when something remains after removing blanks and dots."""
    return F.translate(col(c), " .", "") != ""


def number(c: str | Column) -> Column:
    """Text to whole number, NULL when it is none."""
    return col(c).try_cast("decimal(38,0)")


def percent(part: Column, whole: Column) -> Column:
    """part / whole * 100 as double, NULL for an empty whole."""
    return part.cast("double") / F.nullif(whole, F.lit(0)).cast("double") * 100


def digest(cols: Iterable[str | Column], sep: str = "") -> Column:
    """MD5 over the text of the columns, NULL read as empty.

    Without a separator neighbouring values can collide (``"ab"+"c"`` = ``"a"+"bc"``); pass one
    where the digest decides about changes.
    """
    parts: list[Column] = []
    for c in cols:
        if parts and sep:
            parts.append(F.lit(sep))
        parts.append(F.coalesce(text(c), F.lit("")))
    return F.md5(F.concat(*parts))
