"""Column expressions shared by every operator.

All helpers return ``Column`` objects built from Spark built-ins, so they stay
inside whole-stage codegen. They encode the null / NaN / infinity rules that the
coverage arithmetic relies on (spreadsheet-style float semantics on top of an
ANSI-mode Spark session):

* division by zero gives +/-inf (0/0 gives NULL instead of NaN),
* NaN never survives: every arithmetic result is normalised to NULL,
* comparisons against NULL are treated as "false" by the flag helpers,
* ``ceil`` keeps DOUBLE and keeps +/-inf instead of saturating to BIGINT.
"""

from __future__ import annotations


from pyspark.sql import Column
from pyspark.sql import functions as F



def _pos_inf() -> Column:
    return F.lit(float("inf"))


def _neg_inf() -> Column:
    return F.lit(float("-inf"))

# Spreadsheet readers turn these cell texts into missing values.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Date layouts accepted by the date casts besides ISO 8601
# (yyyy-MM-dd[ HH:mm:ss] / [THH:mm:ss], handled by the native cast).
DATE_FORMATS = (
    "MM/dd/yyyy",
    "MM/dd/yyyy HH:mm:ss",
)


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c: str | Column) -> Column:
    """NaN -> NULL (Spark sorts and compares NaN as a large value)."""
    c = col_(c)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def ieee_div(n: str | Column, d: str | Column) -> Column:
    """``n / d`` with float semantics: x/0 = +/-inf, 0/0 and null -> NULL.

    Spark 4 in ANSI mode raises on division by zero; this keeps the
    spreadsheet behaviour without leaving the JVM.
    """
    n = col_(n).cast("double")
    d = col_(d).cast("double")
    return (
        F.when(d.isNull() | n.isNull() | F.isnan(n) | F.isnan(d), F.lit(None).cast("double"))
        .when(d == 0, F.when(n > 0, _pos_inf()).when(n < 0, _neg_inf()))
        .otherwise(nan_to_null(n / d))
    )


def safe_sub(a: str | Column, b: str | Column) -> Column:
    """a - b with inf - inf -> NULL."""
    return nan_to_null(col_(a).cast("double") - col_(b).cast("double"))


def safe_mul(a: str | Column, b: str | Column) -> Column:
    """a * b with inf * 0 -> NULL."""
    return nan_to_null(col_(a).cast("double") * col_(b).cast("double"))


def ceil_double(c: str | Column) -> Column:
    """ceil that keeps DOUBLE, +/-inf and NULL.

    Spark's ``ceil`` returns BIGINT and saturates; doubles of magnitude 2^52
    and above are already whole numbers, so they (and +/-inf) pass through.
    """
    c = col_(c).cast("double")
    return F.when(c.isNull() | F.isnan(c), F.lit(None).cast("double")).when(
        F.abs(c) >= F.lit(float(2 ** 52)), c
    ).otherwise(F.ceil(c).cast("double"))


def clamp_min0(c: str | Column) -> Column:
    """max(x, 0) that keeps NULL (``greatest`` alone would skip the NULL); NaN -> NULL."""
    c = nan_to_null(col_(c).cast("double"))
    return F.when(c.isNull(), F.lit(None).cast("double")).otherwise(
        F.greatest(c, F.lit(0.0))
    )


def floor_days(later: str | Column, as_of: str | Column) -> Column:
    """Whole days from ``as_of`` to ``later``, floored (a negative partial day
    is -1, unlike ``datediff``)."""
    micros = F.timestamp_diff("MICROSECOND", col_(as_of), col_(later))
    return F.floor(micros / F.lit(86_400_000_000.0)).cast("double")


def review_flag(gap: str | Column, threshold: float) -> Column:
    """'Review' when gap >= threshold, else 'Okay'; NULL/NaN gap -> 'Okay'."""
    g = nan_to_null(gap)
    return F.when(g >= F.lit(float(threshold)), F.lit("Review")).otherwise(F.lit("Okay"))


def na_normalise(c: str | Column) -> Column:
    """Map spreadsheet NA tokens to NULL."""
    c = col_(c)
    return F.when(c.isin(*NA_TOKENS), F.lit(None).cast("string")).otherwise(c)


def ts_lit(value) -> Column:
    """A TIMESTAMP_NTZ literal from text or a ``datetime`` (wall clock, no zone)."""
    return F.lit(str(value)).cast("timestamp_ntz")


def _parse_ts(c: Column) -> Column:
    # ISO text goes through the native cast (no formatter, no failed parse
    # attempts); the pattern parsers only run for the other layouts.
    return F.coalesce(c.try_cast("timestamp_ntz"),
                      *[F.try_to_timestamp(c, F.lit(f)).cast("timestamp_ntz") for f in DATE_FORMATS])


def strict_timestamp(c: str | Column, name: str = "value") -> Column:
    """Parse text to TIMESTAMP; non-null text that fails every layout raises."""
    c = col_(c).cast("string")
    parsed = _parse_ts(c)
    return F.when(c.isNull(), F.lit(None).cast("timestamp_ntz")).when(
        parsed.isNull(),
        F.raise_error(F.concat(F.lit(f"cannot parse {name} as a date: "), c)).cast("timestamp_ntz"),
    ).otherwise(parsed)


def lenient_timestamp(c: str | Column) -> Column:
    """Parse to TIMESTAMP, bad input -> NULL."""
    c = col_(c)
    return _parse_ts(c.cast("string"))


def strict_double(c: str | Column, name: str = "value") -> Column:
    """Numeric cast where bad text raises (whatever the ANSI setting); NULL passes."""
    c = col_(c)
    parsed = c.try_cast("double")
    return F.when(c.isNotNull() & parsed.isNull(), F.raise_error(
        F.concat(F.lit(f"cannot parse {name} as a number: "), c.cast("string"))).cast("double")
    ).otherwise(parsed)


def lenient_double(c: str | Column) -> Column:
    """Lenient numeric cast, bad input -> NULL."""
    return col_(c).try_cast("double")


def stamp_text(c: str | Column) -> Column:
    """19-character ISO text ``yyyy-MM-ddTHH:mm:ss`` (NULL stays NULL)."""
    return F.date_format(col_(c), "yyyy-MM-dd'T'HH:mm:ss")


def remove_token(list_col: str | Column, token: str | Column) -> Column:
    """Drop ``token`` (trimmed) from a comma list; blanks are dropped too.

    NULL list or NULL token returns the list unchanged.
    """
    lst = col_(list_col)
    tok = F.trim(col_(token))
    parts = F.transform(F.split(lst, ","), lambda u: F.trim(u))
    kept = F.filter(parts, lambda u: (u != F.lit("")) & (u != tok))
    return F.when(lst.isNull() | col_(token).isNull(), lst).otherwise(F.array_join(kept, ","))
