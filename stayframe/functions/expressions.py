"""Column-expression helpers. All JVM-side built-ins: no Python per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "col_", "micros_between", "hours_between", "window_index", "age_years",
    "std_text", "std_unit", "sign_label", "safe_ratio", "minute_boundaries",
    "nan_to_null", "clean_text", "tokens", "coarse_group", "null_safe_flag",
    "round6", "HOUR_US",
]

HOUR_US = 3_600_000_000


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def micros_between(start, end) -> Column:
    """Signed microseconds from ``start`` to ``end`` (exact, integer)."""
    return F.timestamp_diff("MICROSECOND", col_(start), col_(end))


def hours_between(start, end) -> Column:
    """Fractional hours."""
    return micros_between(start, end) / F.lit(float(HOUR_US))


def window_index(start, t, window_hours: float) -> Column:
    """Left-closed window number of ``t`` after ``start`` (X7); integer
    arithmetic on microseconds so the bucket edges are exact."""
    width = int(round(window_hours * HOUR_US))
    return F.floor(micros_between(start, t) / F.lit(width)).cast("int")


def age_years(at, born) -> Column:
    """Whole years by the month/day rule (C7): not months_between, so a
    29 Feb birthday turns a year older on 1 Mar."""
    at, born = col_(at), col_(born)
    md_at = F.month(at) * 100 + F.dayofmonth(at)
    md_born = F.month(born) * 100 + F.dayofmonth(born)
    return (F.year(at) - F.year(born) - (md_at < md_born).cast("int")).cast("int")


def std_text(c) -> Column:
    """Trim (all whitespace, not just spaces), upper, collapse runs."""
    trimmed = F.regexp_replace(col_(c), r"^\s+|\s+$", "")
    return F.upper(F.regexp_replace(trimmed, r"\s+", " "))


def std_unit(c) -> Column:
    """Upper, drop dots and whitespace."""
    return F.upper(F.regexp_replace(col_(c), r"[.\s]", ""))


def sign_label(x, eps: float = 1e-8) -> Column:
    """POS / NEG / ZERO with tolerance; null stays null."""
    x = col_(x)
    return (F.when(x.isNull(), F.lit(None).cast("string"))
            .when(x > eps, "POS").when(x < -eps, "NEG").otherwise("ZERO"))


def safe_ratio(num, den) -> Column:
    """num / den, 0 when the denominator is 0 or null."""
    return F.coalesce(col_(num) / F.nullif(col_(den), F.lit(0)), F.lit(0.0))


def minute_boundaries(start, end) -> Column:
    """Number of minute boundaries crossed from start to end: truncate both
    ends to the minute, then count whole minutes (trap Q5)."""
    return F.timestamp_diff("MINUTE", F.date_trunc("minute", col_(start)),
                           F.date_trunc("minute", col_(end)))


def nan_to_null(c) -> Column:
    c = col_(c)
    return F.when(~F.isnan(c), c)


# Protected-span marker removed before tokenising (N7). ``(?d)`` makes ``.``
# stop only at ``\n`` as in the reference's pattern.
PHI_SPAN = r"(?d)\[\*\*.*?\*\*\]"


def clean_text(c) -> Column:
    """Remove ``[**..**]`` spans, lower, strip, then non-letters -> space.
    Null input becomes the empty string."""
    no_phi = F.regexp_replace(F.coalesce(col_(c), F.lit("")), PHI_SPAN, " ")
    stripped = F.regexp_replace(F.lower(no_phi), r"^\s+|\s+$", "")
    return F.regexp_replace(stripped, r"[^\p{L}\s]", " ")


def tokens(cleaned) -> Column:
    """Whitespace tokens of cleaned text, empties dropped."""
    return F.filter(F.split(col_(cleaned), r"\s+"), lambda t: F.length(t) > 0)


def text_tokens(c) -> Column:
    """``tokens(clean_text(c))`` (N7 + N8) in one pass: what is left between
    the spaces is the runs of letters."""
    no_phi = F.regexp_replace(F.coalesce(col_(c), F.lit("")), PHI_SPAN, " ")
    return F.regexp_extract_all(F.lower(no_phi), F.lit(r"\p{L}+"), F.lit(0))


def coarse_group(c) -> Column:
    """Coarse group by prefix of the lower-cased raw value; null -> other
    (D6, decision Q23)."""
    v = F.lower(col_(c))
    return (F.when(v.startswith("white"), "white")
            .when(v.startswith("black"), "black")
            .when(v.startswith("asian"), "asian")
            .when(v.startswith("hisp") | v.startswith("latin"), "hispanic")
            .otherwise("other"))


def null_safe_flag(pred: Column) -> Column:
    """Comparisons with null are false, as in the reference's pandas masks."""
    return F.coalesce(pred, F.lit(False))


def round6(c) -> Column:
    return F.round(col_(c), 6)
