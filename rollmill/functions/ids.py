"""Deterministic ids, seeds and text normal forms as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space of Unicode, with the four separators that Java's class leaves out.
SPACES = r"(?U)[\s\x1c-\x1f]+"


def stable_id(*parts: Column) -> Column:
    """SHA-256 of the parts joined by the unit separator; a null part counts as the word None."""
    return F.sha2(F.concat_ws("\x1f", *(F.coalesce(p.cast("string"), F.lit("None")) for p in parts)), 256)


def rank_key(seed: Column, sample_id: Column) -> Column:
    """The first 16 hex digits: ordered as text they are ordered as 64-bit unsigned numbers."""
    return F.substring(stable_id(seed, sample_id), 1, 16)


def phase_seed(candidate_id: Column, phase: Column) -> Column:
    return F.conv(F.substring(stable_id(candidate_id, phase), 1, 8), 16, 10).cast("bigint")


def _folds() -> tuple[str, str, list[tuple[str, str]]]:
    """Lower-case characters that case folding changes once more: those with one character for it, and those with several."""
    one, many = {}, {}
    for code in range(0x110000):
        if 0xD800 <= code < 0xE000:
            continue
        low, fold = chr(code).lower(), chr(code).casefold()
        if low != fold and len(low) == 1:
            (one if len(fold) == 1 else many)[low] = fold
    return "".join(one), "".join(one.values()), sorted(many.items())


_FROM, _TO, _MANY = _folds()


def fold_case(x: Column) -> Column:
    """Unicode case folding: lower case, then what folding changes beyond it. Characters that become several are rare, and looked for first."""
    low = F.translate(F.replace(F.lower(x), F.lit("ß"), F.lit("ss")), _FROM, _TO)
    full = low
    for c, to in _MANY:
        full = F.replace(full, F.lit(c), F.lit(to))
    return F.when(low.rlike("[" + "".join(c for c, _ in _MANY) + "]"), full).otherwise(low)


def collapse(x: Column) -> Column:
    """White space runs as one space, none at the ends."""
    return F.trim(F.regexp_replace(x, SPACES, " "))


def strip(x: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(x, "^" + SPACES, ""), SPACES + "$", "")


def blank(x: Column) -> Column:
    """Null, empty or white space."""
    return strip(F.coalesce(x, F.lit(""))) == ""


def prompt_key(x: Column) -> Column:
    return collapse(fold_case(x))


def answer_text(x: Column) -> Column:
    """Case folded, without final points, white space collapsed."""
    return collapse(F.regexp_replace(collapse(fold_case(x)), r"\.+$", ""))
