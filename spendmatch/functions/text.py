"""Text normalisation and certification expressions.

All builders return :class:`pyspark.sql.Column` expressions that stay inside
whole-stage codegen; there is no Python UDF here.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the source system's for identical results.
# ---------------------------------------------------------------------------
# Canonical name, variant A: drop everything but A-Z, 0-9 and space, collapse
# whitespace, then remove these whole-word business suffixes (no final trim).
CANON_A_KEEP = "[^A-Z0-9 ]"
# the ASCII part of it, character by character
ASCII_DROPPED = "".join(c for c in map(chr, range(128)) if not ("0" <= c <= "9" or "A" <= c <= "Z" or c == " "))
CANON_A_SUFFIX = r"\b(LLC|INC|LTD|CO|CORP|COMPANY)\b"
# Canonical name, variant B: first remove a suffix word together with the
# whitespace before it and the whitespace (or end) after it, case-insensitive,
# then drop punctuation, collapse whitespace and trim.
CANON_B_SUFFIX = r"\s+(LLC|INC\.?|LTD\.?|CO\.?|CORP\.?|COMPANY|INCORPORATED|CORPORATION)(\s|$)"
# Certification hierarchy used to pick the best vendor row (lower is better;
# anything else, NULL included, ranks 999).
CERT_RANK = {"MBE": 1, "MWBE": 2, "WBE": 3, "CBE": 4, "SEDBE": 5, "VOB": 6}
CERT_RANK_OTHER = 999
# Certifications that count as certified spend (VOB does not).
QUALIFYING_CERTS = ("MBE", "WBE", "MWBE", "SEDBE", "CBE")
# Contract vendor-type labels.
PRIME_TYPES = ("PRIME", "PRIME CONTRACTOR", "PRIME VENDOR", "CONTRACTOR")
SUB_TYPES = ("SUBCONTRACTOR", "SUB")
ACTIVE_STATUS = "Active"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Python ``str.strip()``: remove leading/trailing (Unicode) whitespace.

    SQL ``trim`` only removes spaces (T5); use this for values that the
    source cleaned in Python.
    """
    return F.regexp_replace(_c(c), r"(?U)^\s+|\s+$", "")


def id_to_text(c) -> Column:
    """Render a numeric id as text without exponent or ``.0`` (T4).

    ``cast(123456789.0 as string)`` gives ``1.23456789E8`` in Spark, so integral
    values go through ``decimal(38,0)`` first.
    """
    c = _c(c)
    return F.when(c == F.floor(c), c.cast("decimal(38,0)").cast("string")).otherwise(c.cast("string"))


def blank_to_null(c) -> Column:
    """F1 ``NULLIF(TRIM(x::text), '')``; a floating id prints without exponent or ``.0`` (T4)."""
    c = _c(c)
    v = c.try_cast("double")
    whole = F.typeof(c).isin("double", "float") & (v == F.floor(v))  # the type is known when planning
    return F.nullif(F.trim(F.when(whole, v.cast("decimal(38,0)").cast("string")).otherwise(c.cast("string"))), F.lit(""))


def norm_label(c) -> Column:
    """F2 ``UPPER(TRIM(x))``."""
    return F.upper(F.trim(_c(c)))


def _kept(x: Column) -> Column:
    """``x`` without the characters of ``CANON_A_KEEP``; only text beyond ASCII meets the regex, which is many times slower."""
    x = F.translate(x, ASCII_DROPPED, "")
    return F.when(F.octet_length(x) == F.length(x), x).otherwise(F.regexp_replace(x, CANON_A_KEEP, ""))


def canon_name_a(c, strip_suffix: bool = True) -> Column:
    """F3 canonical name, variant A (used by the vendor/agency/contract marts).

    ``strip_suffix=False`` reproduces an engine whose ``\\b`` is not a word
    boundary, where the suffix step is a no-op (T1).  No trailing trim (T2).
    """
    x = _kept(norm_label(c))
    # only A-Z, 0-9 and spaces are left, so collapsing whitespace runs is
    # collapsing runs of spaces (cheaper: single spaces are not rewritten)
    x = F.regexp_replace(x, " {2,}", " ")
    if strip_suffix:
        x = F.regexp_replace(x, CANON_A_SUFFIX, "")
    return x


def canon_name_b(c) -> Column:
    """F4 canonical name, variant B (prime/sub roll-ups); trims at the end."""
    x = F.regexp_replace(norm_label(c), "(?i)" + CANON_B_SUFFIX, "")
    x = _kept(x)
    x = F.regexp_replace(x, " {2,}", " ")
    return F.trim(x)


def cert_rank(c) -> Column:
    """F5 hierarchy rank; case-sensitive, NULL and unknown -> 999."""
    c = _c(c)
    expr = None
    for name, rank in CERT_RANK.items():
        expr = (F.when(c == name, rank) if expr is None else expr.when(c == name, rank))
    return expr.otherwise(CERT_RANK_OTHER)


def active_rank(c) -> Column:
    """F6 Active -> 0 else 1."""
    return F.when(_c(c) == ACTIVE_STATUS, 0).otherwise(1)


def is_qualifying(c) -> Column:
    """F7 ``UPPER(TRIM(t)) IN (MBE, WBE, MWBE, SEDBE, CBE)``; NULL stays NULL."""
    return norm_label(c).isin(*QUALIFYING_CERTS)


def is_sub_type(c) -> Column:
    """P11 ``UPPER(TRIM(vendor_type)) IN ('SUBCONTRACTOR','SUB')``."""
    return norm_label(c).isin(*SUB_TYPES)


def certified_amount(cert_type, amount) -> Column:
    """F8 amount when the certification qualifies, else 0."""
    return F.when(is_qualifying(cert_type), _c(amount)).otherwise(F.lit(0))


def certified_spend_any(cert_type, total, cert_subs, uncert_subs) -> Column:
    """F9 (any certification): certified prime keeps total minus uncertified subs."""
    return (F.when(_c(cert_type).isNotNull(),
                   F.when(_c(uncert_subs) > 0, _c(total) - _c(uncert_subs)).otherwise(_c(total)))
            .otherwise(F.coalesce(_c(cert_subs), F.lit(0))))


def certified_spend_qualifying(cert_type, total, cert_subs, uncert_subs) -> Column:
    """F10 (qualifying certification only); may go negative, as the source does."""
    return (F.when(is_qualifying(cert_type),
                   F.when(_c(uncert_subs) > 0, _c(total) - _c(uncert_subs)).otherwise(_c(total)))
            .otherwise(F.coalesce(_c(cert_subs), F.lit(0))))


def certified_spend_floor(cert_type, total, cert_subs, uncert_subs) -> Column:
    """F11 ``GREATEST(total - COALESCE(uncert, 0), 0)`` for certified rows.

    ``greatest`` skips NULLs, so a NULL total gives 0 (as PostgreSQL does).
    """
    return (F.when(_c(cert_type).isNotNull(),
                   F.greatest(_c(total) - F.coalesce(_c(uncert_subs), F.lit(0)), F.lit(0)))
            .otherwise(F.coalesce(_c(cert_subs), F.lit(0))))


def pct(n, d, scale: int = 2) -> Column:
    """F14 ``ROUND(100.0 * n / d, 2)``; division by zero yields NULL, not an error."""
    return F.round(F.lit(100.0) * _c(n) / F.nullif(_c(d), F.lit(0)), scale)


def money(c, precision: int = 38, scale: int = 2) -> Column:
    """Money as an exact decimal so sums do not depend on addition order."""
    return _c(c).cast(f"decimal({precision},{scale})")
