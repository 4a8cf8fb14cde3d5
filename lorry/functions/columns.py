"""Scalar column helpers (all built-in expressions, no Python UDFs)."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# The four receivable accounts of each company, by account
# prefix ("01" control, "02" trucking).
COMPANY_ACCOUNTS = {
    "control": ("01-2200-00", "01-2210-00", "01-3000-00", "01-3100-00"),
    "trucking": ("02-2200-00", "02-2210-00", "02-3000-00", "02-3100-00"),
}

# The accrual expense account of the AP extracts.
AP_EXPENSE_ACCOUNT = "01-4000-00"


# Fixed value: the source database compares text linguistically, not by bytes
# ("MONTREAL-EST" < "MONTREAL-NORD" < "MONTREAL,"); ICU root order reproduces it.
TEXT_COLLATION = "UNICODE"


def text_key(c: str | Column) -> Column:
    """A text sort key in the source's order (ascending, NULL last).  Only the
    sort expression is collated; output columns stay plain strings."""
    return F.collate(col(c), TEXT_COLLATION).asc_nulls_last()


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def company_accounts(company: str) -> tuple[str, ...]:
    """The receivable accounts of ``company`` ('control' or 'trucking')."""
    try:
        return COMPANY_ACCOUNTS[company.lower()]
    except KeyError:
        raise ValueError(f"unknown company {company!r}; expected one of {sorted(COMPANY_ACCOUNTS)}") from None


def account_segment(acct: str | Column, n: int = 2) -> Column:
    """The n-th '-'-separated segment of an account string.

    An account without enough hyphens gives NULL (the source database
    raises on the negative substring length; an empty string would hide it).
    """
    a = col(acct)
    parts = F.size(F.split(a, "-", -1))
    return F.when(parts >= n + 1, F.split_part(a, F.lit("-"), F.lit(n)))


def gl_line_code(acct: str | Column) -> Column:
    """'40' for a ...-2200-... account line, else '20' (accounting import line type)."""
    return F.when(col(acct).contains("-2200-"), F.lit("40")).otherwise(F.lit("20"))


def abs_amount(debit: str | Column, credit: str | Column) -> Column:
    """Bigger minus smaller of debit and credit (= |debit - credit|, NULL if either is NULL)."""
    return F.abs(col(debit) - col(credit))


def signed_amount(debit: str | Column, credit: str | Column) -> Column:
    """Signed net, debit minus credit."""
    return col(debit) - col(credit)


def credit_sign(tx_type: str | Column, amount: str | Column) -> Column:
    """Credits are negated."""
    return F.when(col(tx_type) == "Credit", -col(amount)).otherwise(col(amount))


def guarded_ratio(num: str | Column, den: str | Column, scale: int = 10) -> Column:
    """``num / den`` when ``den <> 0`` else 0 (a NULL denominator also gives 0).

    Both sides are treated as decimals so integer distances never divide to 0.
    """
    n = col(num).cast(f"decimal(28,{min(scale, 10)})")
    d = col(den).cast("decimal(28,4)")
    return F.when(d != 0, n / d).otherwise(F.lit(0))


def prorate(amount: str | Column, part: str | Column, whole: str | Column) -> Column:
    """``NVL(ROUND(amount * part/whole, 2), 0)`` with the guarded ratio."""
    return F.coalesce(F.round(col(amount) * guarded_ratio(part, whole), 2), F.lit(0)).cast("decimal(18,2)")


def share(part: str | Column, whole: str | Column) -> Column:
    """Rounded share ``ROUND(part / whole, 2)`` (0 when whole is 0 or NULL)."""
    return F.round(guarded_ratio(part, whole), 2).cast("decimal(18,2)")


def margin_percent(margin: str | Column, revenue: str | Column) -> Column:
    """Margin as a percentage of revenue, 2 decimals, 0 when revenue is 0."""
    r = col(revenue)
    return F.round(F.when(r != 0, col(margin) / r * 100).otherwise(F.lit(0)), 2).cast("decimal(18,2)")


def held_narrow(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, Callable[[str], Column]]:
    """``df`` with those of the decimal ``columns`` in 18 digits whose values all
    fit, and what gives a column its own type back.  Such a value takes 8 bytes
    of a row on its way, a longer one 24."""
    types = {c: df.schema[c].dataType for c in columns if df.schema[c].dataType.precision > 18 >= df.schema[c].dataType.scale}
    if not types:
        return df, F.col
    most = df.agg(*[F.max(F.abs(F.col(c))).alias(c) for c in types]).first()
    fit = {c: k for c, k in types.items() if most[c] is None or most[c] < Decimal(10) ** (18 - k.scale)}
    narrow = df.withColumns({c: F.col(c).cast(DecimalType(18, k.scale)) for c, k in fit.items()})
    return narrow, lambda c: F.col(c).cast(fit[c]).alias(c) if c in fit else F.col(c)


def zone_label(desc: str | Column, is_terminal: str | Column, province: str | Column) -> Column:
    """Zone description, plus ', PROV' when the zone is a terminal.

    ``||`` propagates NULL: a NULL description gives NULL; a missing zone row
    (safe join) falls to the empty suffix.
    """
    suffix = F.when(col(is_terminal) == "True", F.concat(F.lit(", "), col(province))).otherwise(F.lit(""))
    return F.concat(col(desc), suffix)


def blank_to_nbsp(c: str | Column) -> Column:
    """NULL or blank text becomes a non-breaking space (U+00A0)."""
    x = col(c)
    return F.when(x.isNull() | (F.trim(x) == ""), F.lit("\u00a0")).otherwise(x)


def non_blank(c: str | Column) -> Column:
    """``name > ''`` in a blank-padded comparison = has a non-blank character."""
    return F.length(F.rtrim(col(c))) > 0
