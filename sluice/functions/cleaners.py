"""Column cleaners (Column -> Column).

Each cleaner is a pure expression over built-in functions, so a whole
recipe compiles into one projection inside whole-stage codegen; no Python
runs per row.  Semantics follow the reference code (not its docstrings).
Casts that may fail use ``try_cast`` so results do not depend on ANSI mode.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.functions.common import as_col, empty_to_null, text

# Fixed values (must equal the reference for identical results).
# Phone junk patterns: scientific notation, N/A variants, the word null.
PHONE_SCI_PATTERN = r"(?i)\be\+?\d+"
PHONE_NA_PATTERN = r"(?i)\bn/?a\b"
PHONE_NULL_PATTERN = r"(?i)^null$"
# Characters kept by the name cleaner and the location cleaner.
NAME_DROP_PATTERN = r"[^A-Za-zÀ-ÿ'\-\s]"
LOCATION_DROP_PATTERN = r"[^A-Za-z\s\-']"
# Truthy / falsy spellings of the boolean cleaner.
TRUE_WORDS = ("y", "yes", "true", "1")
FALSE_WORDS = ("n", "no", "false", "0")


def normalize_phone(c) -> Column:
    """CL-1: canonical digits-only phone, leading 62 -> 0, leading 8 -> 08.

    NULL when the trimmed text is empty, ``0``, looks like scientific notation
    (``e+11``), an N/A marker, the word ``null``, or has no digits.

    Written so each step is computed once per row: the digits string is
    rewritten by two anchored replacements (``^62`` -> ``0``; then ``^8`` ->
    ``08``, which can only match when the number did not start with 62), and
    since it holds only digits, "all digits" is "not empty" (``nullif``).
    """
    s = text(c)
    junk = (
        s.isNull()
        | (s == "")
        | (s == "0")
        | s.rlike(PHONE_SCI_PATTERN)
        | s.rlike(PHONE_NA_PATTERN)
        | s.rlike(PHONE_NULL_PATTERN)
    )
    digits = F.regexp_replace(s, "[^0-9]", "")
    lead = F.regexp_replace(F.regexp_replace(digits, "^62", "0"), "^8", "08")
    return F.when(junk, F.lit(None).cast("string")).otherwise(empty_to_null(lead))


# Indonesian numbering plan approximation used for validity
# (separators stripped first; optional +62 / 62 / 0 prefix; mobile 8x or
# landline area codes 2..7, 8 to 11 subscriber digits).
PHONE_SEPARATORS = r"[\s().\-/]"
PHONE_VALID_PATTERN = r"^(\+62|62|0)?(8[1-9][0-9]{7,10}|[2-7][0-9]{7,10})$"


def phone_is_valid(c) -> Column:
    """CL-2 / UD-1: boolean validity as a native predicate (never NULL).

    NULL or empty input is False, as in the reference.  This replaces a
    per-row Python UDF around a phone library with a JVM-side regex; see
    ``sluice.functions.phone_udf`` for a vectorised hook that accepts any
    user validator when exact library parity is required.
    """
    s = F.regexp_replace(text(c), PHONE_SEPARATORS, "")
    return F.coalesce(s.rlike(PHONE_VALID_PATTERN), F.lit(False))


def phone_status(valid, normalized_valid) -> Column:
    """CL-3: both valid -> 'valid'; both invalid -> 'invalid'; else 'check'."""
    v, n = as_col(valid), as_col(normalized_valid)
    return F.when(v & n, F.lit("valid")).when(~v & ~n, F.lit("invalid")).otherwise(F.lit("check"))


def address_part(c) -> Column:
    """CL-4, first stage: trim + initcap, blank -> NULL (the value is
    trimmed, so blank is empty)."""
    return empty_to_null(F.initcap(F.trim(as_col(c))))


def drop_repeats(cols: Sequence) -> list[Column]:
    """CL-4, second stage: a column equal to any earlier one -> NULL.

    Equivalent to the reference's pairwise in-place loop: the first
    occurrence of a value always survives, so a later column is blanked iff
    it equals any earlier (cleaned) column.
    """
    cs = [as_col(c) for c in cols]
    out = []
    for j, cj in enumerate(cs):
        if j == 0:
            out.append(cj)
            continue
        dup = reduce(lambda a, b: a | b, [cj == ci for ci in cs[:j]])
        out.append(F.when(dup, F.lit(None).cast("string")).otherwise(cj))
    return out


def clean_address(cols: Sequence) -> list[Column]:
    """CL-4 as plain expressions: trim + initcap each column, blank -> NULL,
    and a later column equal to any earlier cleaned one -> NULL.  Recipes
    apply the two stages as two projections (``address_part`` then
    ``drop_repeats`` over the cleaned columns) so each value is cleaned
    once per row."""
    return drop_repeats([address_part(c) for c in cols])


def clean_name(c) -> Column:
    """CL-5: keep letters (incl. the Latin-1 range), apostrophes, hyphens and
    whitespace; collapse whitespace; trim; initcap; blank -> NULL."""
    s = F.regexp_replace(as_col(c), NAME_DROP_PATTERN, "")
    s = F.trim(F.regexp_replace(s, r"\s+", " "))
    return empty_to_null(F.initcap(s))  # trimmed, so blank is empty


def clean_nik(c) -> Column:
    """CL-6: digits only; exactly 16 digits else NULL (the digit string is
    matched whole, so it is computed once)."""
    s = F.regexp_replace(F.regexp_replace(F.trim(as_col(c)), r"\s+", ""), r"\D", "")
    return empty_to_null(F.regexp_extract(s, r"^[0-9]{16}$", 0))


def clean_postal_code(c) -> Column:
    """CL-7: whitespace removed; exactly five digits else NULL."""
    s = F.regexp_replace(text(c), r"\s+", "")
    return empty_to_null(F.regexp_extract(s, r"^\d{5}$", 0))


def clean_coordinates(lat, lon) -> tuple[Column, Column]:
    """CL-8: float latitude in [-90, 90] and longitude in [-180, 180] else
    NULL; a longitude of exactly 0 nulls both (a NULL longitude does not)."""
    la = as_col(lat).try_cast("float")
    lo = as_col(lon).try_cast("float")
    la = F.when(la.between(-90, 90), la)
    lo = F.when(lo.between(-180, 180), lo)
    zero = lo == 0.0
    null_f = F.lit(None).cast("float")
    return F.when(zero, null_f).otherwise(la), F.when(zero, null_f).otherwise(lo)


def clean_boolean(c) -> Column:
    """CL-9: y/yes/true/1 -> true, n/no/false/0 -> false (trimmed, any
    case), anything else -> NULL.  Non-string inputs are cast to text."""
    s = F.lower(text(c))
    return F.when(s.isin(*TRUE_WORDS), F.lit(True)).when(s.isin(*FALSE_WORDS), F.lit(False)).otherwise(
        F.lit(None).cast("boolean")
    )


def clean_padded_char(c, allowed: Iterable[str], rtrim: bool = False) -> Column:
    """CL-10: NULL unless ``upper(c)`` is one of ``allowed`` (upper-cased).

    Case is kept and nothing is trimmed (``'Y '`` is rejected), as in the
    reference; ``rtrim=True`` compares blank-padded values after ``rtrim``.
    An empty allowed list nulls every value.
    """
    c = as_col(c)
    probe = F.upper(F.rtrim(c) if rtrim else c)
    allowed_up = [a.upper() for a in allowed]
    keep = probe.isin(*allowed_up) if allowed_up else F.lit(False)
    return F.when(~keep, F.lit(None).cast("string")).otherwise(c)


def clean_location(c, blank_to_null_: bool = False) -> Column:
    """CL-11: keep ASCII letters, whitespace, hyphens, apostrophes; trim;
    initcap.  An all-dropped value stays ``''`` (the reference code does not
    null it); pass ``blank_to_null_=True`` for the documented behaviour."""
    s = F.initcap(F.trim(F.regexp_replace(as_col(c), LOCATION_DROP_PATTERN, "")))
    return empty_to_null(s) if blank_to_null_ else s  # trimmed, so blank is empty


# Product-code markers of the product recipe.
FREE_GOOD_MARKER = "FG"
PROMO_MARKER = "PRM"


def code_flag(c, marker: str) -> Column:
    """'Y' when the code contains ``marker`` (case-sensitive), else 'N'
    (NULL code -> 'N')."""
    return F.when(as_col(c).contains(marker), F.lit("Y")).otherwise(F.lit("N"))


def exact_values(c, allowed: Sequence[str]) -> Column:
    """Keep the value only if it is exactly one of ``allowed`` (case-sensitive)."""
    c = as_col(c)
    return F.when(c.isin(*allowed), c).otherwise(F.lit(None).cast("string"))
