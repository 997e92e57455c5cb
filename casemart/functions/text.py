"""Text and number cleaning as Spark Column expressions.

Everything here stays inside Catalyst (translate / regexp_replace / try_cast),
so it runs in whole-stage codegen on the executors; no Python UDF is involved.
Normalization *profiles* are data: an ordered list of steps folded into one
Column, so each profile can be inspected, tested for idempotence and reused.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# These must equal the reference's tables for identical results.
# ---------------------------------------------------------------------------

# Accent table of the raw (upper-case) profile: 48 characters, includes Ñ/ñ.
UPPER_PROFILE_ACCENTED = "ÁÀÂÃÄÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÇÑáàâãäéèêëíìîïóòôõöúùûüçñ"
UPPER_PROFILE_PLAIN = "AAAAAEEEEIIIIOOOOOUUUUCNaaaaaeeeeiiiiooooouuuucn"

# Accent table of the dimension-key (lower-case) profile: 46 characters, no Ñ/ñ.
LOWER_PROFILE_ACCENTED = "ÁÀÂÃÄÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÇáàâãäéèêëíìîïóòôõöúùûüç"
LOWER_PROFILE_PLAIN = "AAAAAEEEEIIIIOOOOOUUUUCaaaaaeeeeiiiiooooouuuuc"

# Accent table of the matching profile: 23 lower-case characters.
MATCH_PROFILE_ACCENTED = "áàãâäéèêëíìîïóòõôöúùûüç"
MATCH_PROFILE_PLAIN = "aaaaaeeeeiiiiooooouuuuc"

# White space of the pattern ``\s`` but for the space itself.
SPACES = "\t\n\x0b\f\r"

# Mojibake repairs of the matching profile, applied in this order
# (pattern, replacement).  The pattern for "í" holds a soft hyphen (U+00AD).
MATCH_MOJIBAKE_FIXES = [
    ("ã§", "c"),
    ("ã£", "a"),
    ("ã¡", "a"),
    ("ã¢", "a"),
    ("ã©", "e"),
    ("ãª", "e"),
    ("ã\u00ad", "i"),
    ("ã³", "o"),
    ("ã´", "o"),
    ("ãµ", "o"),
    ("ãº", "u"),
    ("ã¼", "u"),
    ("妹", "ca"),
]

# Abbreviation expansions of the matching profile, in order.
MATCH_ABBREVIATIONS = [
    (r"\bjd\b", "jardim"),
    (r"\bjdm\b", "jardim"),
    (r"\bvl\b", "vila"),
    (r"\bres\b", "residencial"),
    (r"\bcond\b", "condominio"),
    (r"\bch\b", "chacara"),
    (r"\bchac\b", "chacara"),
    (r"\bconj\b", "conjunto"),
    (r"\bhab\b", "habitacional"),
]

# Phrase expansions of the matching profile, in order.
MATCH_PHRASES = [
    (r"\bn s apda\b", "nossa senhora aparecida"),
    (r"\bns apda\b", "nossa senhora aparecida"),
    (r"\bnossa senhora apda\b", "nossa senhora aparecida"),
]

# Roman numerals of the matching profile; iii before ii before i.
MATCH_ROMAN_NUMERALS = [
    (r"\biii\b", "3"),
    (r"\bii\b", "2"),
    (r"\bi\b", "1"),
]

# ---------------------------------------------------------------------------


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_int(c: Column | str) -> Column:
    """Integer from dirty text: trim, keep only ``[0-9-]``, empty -> NULL.

    ``"1.234"`` -> 1234 (thousand separators vanish).  Malformed leftovers
    such as ``"-"`` or ``"1-2"`` and out-of-range values become NULL instead
    of failing the job under ANSI mode.
    """
    digits = F.regexp_replace(F.trim(as_column(c).cast("string")), r"[^0-9-]", "")
    return F.when(digits == "", F.lit(None)).otherwise(digits).try_cast("int")


def strip_bom(c: Column | str) -> Column:
    """Remove a leading byte-order mark (U+FEFF)."""
    return F.regexp_replace(as_column(c).cast("string"), "^\ufeff", "")


def clean_label(c: Column | str) -> Column:
    """Sheet label cleanup: strip BOM, trim, upper case."""
    return F.upper(F.trim(strip_bom(c)))


def fold_accents(c: Column, accented: str, plain: str) -> Column:
    """Plain letters for accented ones, and one space for each run of white
    space: one translation, and a pattern only where two spaces meet."""
    x = F.translate(c, accented + SPACES, plain + " " * len(SPACES))
    return F.when(F.contains(x, F.lit("  ")), F.regexp_replace(x, " +", " ")).otherwise(x)


def normalize_text(c: Column | str) -> Column:
    """Upper-case profile of raw line lists: trim, strip accents (incl. Ñ),
    upper, collapse whitespace.  No second trim (matches the source rule)."""
    x = F.trim(as_column(c).cast("string"))
    return F.upper(fold_accents(x, UPPER_PROFILE_ACCENTED, UPPER_PROFILE_PLAIN))


def normalize_key(c: Column | str) -> Column:
    """Lower-case profile of dimension keys: trim, lower, strip accents
    (no Ñ), collapse whitespace."""
    x = F.lower(F.trim(as_column(c).cast("string")))
    return fold_accents(x, LOWER_PROFILE_ACCENTED, LOWER_PROFILE_PLAIN)


def plain_key(c: Column | str) -> Column:
    """Accent-sensitive key: lower(trim(x))."""
    return F.lower(F.trim(as_column(c).cast("string")))


@dataclass(frozen=True)
class Step:
    """One step of a normalization profile."""

    name: str
    apply: Callable[[Column], Column]


def literal_steps(name: str, rules: Sequence[tuple[str, str]]) -> list[Step]:
    """Literal substring replacements (no regex): a string without the
    pattern is passed through without being copied."""
    return [Step(f"{name}:{p}", (lambda x, p=p, r=r: F.replace(x, F.lit(p), F.lit(r))))
            for p, r in rules]


def fold(steps: Sequence[Step], c: Column) -> Column:
    for step in steps:
        c = step.apply(c)
    return c


def _whole_words(rules: Sequence[tuple[str, str]]) -> dict[str, str]:
    """``\\bword\\b -> replacement`` rules as a table of words."""
    return {pattern.removeprefix(r"\b").removesuffix(r"\b"): r for pattern, r in rules}


def replace_words(x: Column, table: dict[str, str]) -> Column:
    """Replace whole words of a text of words with single spaces between them."""
    def look(word: Column) -> Column:
        out = F.when(~word.isin(*table), word)
        for old, new in table.items():
            out = out.when(word == old, F.lit(new))
        return out

    return F.array_join(F.transform(F.split(x, " "), look), " ")


# After the punctuation and space steps a text is words with single spaces, so
# the one-word rules are one look-up a word.  Abbreviations, phrases and
# numerals share no word, so their order among each other does not matter.
MATCH_PROFILE: list[Step] = (
    [Step("lower_trim", lambda x: F.lower(F.trim(x)))]
    + literal_steps("mojibake", MATCH_MOJIBAKE_FIXES)
    + [Step("accents", lambda x: F.translate(x, MATCH_PROFILE_ACCENTED, MATCH_PROFILE_PLAIN)),
       Step("punctuation", lambda x: F.regexp_replace(x, r"[^a-z0-9]+", " ")),
       Step("trim", F.trim),
       Step("words", lambda x: replace_words(x, _whole_words(MATCH_ABBREVIATIONS + MATCH_ROMAN_NUMERALS))),
       Step("phrases", lambda x: F.regexp_replace(x, "|".join(p for p, _ in MATCH_PHRASES), MATCH_PHRASES[0][1]))]
)


def match_key(c: Column | str, profile: Sequence[Step] = MATCH_PROFILE) -> Column:
    """Comparison key for record linkage (not a display name).

    ``"Água Branca I"`` -> ``"agua branca 1"``, ``"jd brasil"`` ->
    ``"jardim brasil"``, ``"n.s.apda"`` -> ``"nossa senhora aparecida"``.
    """
    return fold(profile, as_column(c).cast("string"))
