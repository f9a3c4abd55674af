"""Scalar column functions: parsing, cleaning, arithmetic, flags and defaults."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame, functions as F

MONEY = "decimal(10,2)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# -- numbers ---------------------------------------------------------------------------------


def parse_number(c: Column | str, kind: str = "bigint", default: float | None = -1) -> Column:
    """Number in a string, or ``default`` where there is none (``'12.7'`` is no integer)."""
    value = _col(c).try_cast(kind)
    if kind in ("double", "float"):
        value = F.when(~F.isnan(value), value)
    return value if default is None else F.coalesce(value, F.lit(default).cast(kind))


def money(c: Column | str) -> Column:
    """Exact amount with two decimals, so that sums do not depend on the order of rows."""
    return _col(c).cast(MONEY)


def cents(c: Column | str) -> Column:
    """Amount in whole hundredths, rounded half up like :func:`money`, and much cheaper to sum.

    A total beyond the range of ``bigint`` fails instead of wrapping around.
    """
    return (_col(c).cast("decimal(18,2)") * 100).cast("bigint")


def from_cents(c: Column | str) -> Column:
    return _col(c) / 100


def round_half_up(c: Column | str, digits: int) -> Column:
    """Round half away from zero; the decimal step keeps binary noise from deciding ties."""
    return F.round(_col(c).cast("decimal(38,10)"), digits).cast("double")


def pct(num: Column | str, den: Column | str, digits: int = 2) -> Column:
    """Percentage of ``den``; NULL where ``den`` is 0 or NULL."""
    den = _col(den)
    return round_half_up(_col(num) * 100.0 / F.when(den != 0, den), digits)


def decade(year: Column | str) -> Column:
    return _col(year) - _col(year) % 10


def portion_year(date: Column | str) -> Column:
    """Day of the year over 365; slightly above 1 on the last day of a leap year."""
    return F.dayofyear(_col(date)) / F.lit(365.0).cast("double")


def weighted_score(
    parts: Sequence[Column | str],
    weights: Sequence[float],
    bonus: Column | str,
    bonus_weight: float = 0.1,
    digits: int = 3,
) -> Column:
    """Weighted sum of ``parts``, scaled by ``1 + bonus_weight * bonus``."""
    base = sum((_col(p) * F.lit(w) for p, w in zip(parts, weights)), F.lit(0.0))
    return round_half_up(base * (1 + F.lit(bonus_weight) * _col(bonus)), digits)


def row_mean(*cols: Column | str) -> Column:
    """Mean over the columns of a row, skipping NULLs; NULL when all are."""
    known = [_col(c) for c in cols]
    total = sum((F.coalesce(c.cast("double"), F.lit(0.0)) for c in known), F.lit(0.0))
    count = sum((c.isNotNull().cast("int") for c in known), F.lit(0))
    return total / F.when(count > 0, count)


def coalesce_zero(c: Column | str) -> Column:
    return F.coalesce(_col(c), F.lit(0))


# -- text ------------------------------------------------------------------------------------


def clean_text(c: Column | str) -> Column:
    """Strip white space at both ends and remove every no-break space."""
    stripped = F.regexp_replace(_col(c), r"^[\s\u00a0]+|[\s\u00a0]+$", "")
    return F.translate(stripped, "\u00a0", "")


def cut_at(c: Column | str, marker: str) -> Column:
    """The text before the first ``marker``, or all of it."""
    return F.substring_index(F.btrim(_col(c)), marker, 1)


def contains_flag(c: Column | str, word: str) -> Column:
    """1 where the text holds ``word`` in any case; 0 otherwise, also for NULL."""
    return F.coalesce(F.contains(F.lower(_col(c)), F.lit(word.lower())), F.lit(False)).cast("int")


def extract_number(c: Column | str) -> Column:
    """First decimal number in the text."""
    found = F.regexp_extract(_col(c), r"\d+(\.\d+)?", 0)
    return F.when(found != "", found).cast("double")


def strip_units(c: Column | str, suffix: str, thousands: str = ",") -> Column:
    """Whole number without its unit and thousands separators; text that is no number fails."""
    bare = F.replace(F.replace(_col(c), F.lit(suffix), F.lit("")), F.lit(thousands), F.lit(""))
    return bare.cast("bigint")


# -- flags and replacements ------------------------------------------------------------------


def map_binary(c: Column | str, mapping: Mapping[str, int], strict: bool = True) -> Column:
    """Category to 0/1. A value outside the mapping fails when strict, else becomes NULL."""
    c = _col(c)
    lookup = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    hit = F.try_element_at(lookup, F.coalesce(c, F.lit("")))
    if not strict:
        return hit.cast("int")
    message = F.concat(F.lit("no code for category: "), F.coalesce(c, F.lit("NULL")))
    return F.coalesce(hit, F.raise_error(message).cast("int")).cast("int")


def present_flag(c: Column | str) -> Column:
    return _col(c).isNotNull().cast("int")


def equals_flag(c: Column | str, value) -> Column:
    return F.coalesce(_col(c) == F.lit(value), F.lit(False)).cast("int")


def replace_where(cond: Column, c: Column | str, value) -> Column:
    """``value`` where the condition holds, the column's own value elsewhere."""
    return F.when(cond, F.lit(value)).otherwise(_col(c))


def with_default(c: Column | str, value) -> Column:
    return F.coalesce(_col(c), F.lit(value))


# -- whole records ---------------------------------------------------------------------------


def project(
    df: DataFrame, include: Sequence[str | int] = (), exclude: Sequence[str] = ()
) -> DataFrame:
    """Keep columns given by name or position, or all but the excluded ones."""
    if include:
        return df.select(*[df.columns[c] if isinstance(c, int) else c for c in include])
    return df.drop(*exclude)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def recast(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast columns; a value that does not fit the type becomes NULL."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def arrange_types(df: DataFrame, spec: Mapping[str, Column]) -> DataFrame:
    """One typed record per row: every output column from its own expression, in one pass."""
    return df.select(*[expr.alias(name) for name, expr in spec.items()])


def fill_missing(df: DataFrame, value, cols: Sequence[str]) -> DataFrame:
    return df.fillna(value, subset=list(cols))


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN becomes NULL, so that aggregates skip it."""
    floats = [c for c, t in df.dtypes if t in ("double", "float")]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats})


def without_nan(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NaN in floating columns as NULL: a missing value like any other."""
    floats = [c for c in cols if df.schema[c].dataType.simpleString() in ("float", "double")]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df
