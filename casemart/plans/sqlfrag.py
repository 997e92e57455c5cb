"""DuckDB SQL fragments mirroring ``casemart.functions`` (oracle side only).

The oracle re-derives every driver query by brute force in plain SQL; these
helpers spell the same cleaning rules as SQL text so the two sides share the
rule *values* but not the engine.
"""

from __future__ import annotations

from casemart.functions import text as T
from casemart.functions.calendar import MONTH_LABELS


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def clean_int(x: str) -> str:
    d = f"regexp_replace(trim(CAST({x} AS VARCHAR)), '[^0-9-]', '', 'g')"
    return f"TRY_CAST(NULLIF({d}, '') AS INTEGER)"


def upper_sql(x: str) -> str:
    # Spark upper-cases U+00DF to "SS"; DuckDB to U+1E9E.
    return f"replace(upper({x}), 'ẞ', 'SS')"


def normalize_text(x: str) -> str:
    t = f"translate(trim(CAST({x} AS VARCHAR)), {q(T.UPPER_PROFILE_ACCENTED)}, {q(T.UPPER_PROFILE_PLAIN)})"
    return f"regexp_replace({upper_sql(t)}, '\\s+', ' ', 'g')"


def normalize_key(x: str) -> str:
    t = f"translate(lower(trim(CAST({x} AS VARCHAR))), {q(T.LOWER_PROFILE_ACCENTED)}, {q(T.LOWER_PROFILE_PLAIN)})"
    return f"regexp_replace({t}, '\\s+', ' ', 'g')"


def match_key(x: str) -> str:
    s = f"lower(trim(CAST({x} AS VARCHAR)))"
    for p, r in T.MATCH_MOJIBAKE_FIXES:
        s = f"replace({s}, {q(p)}, {q(r)})"
    s = f"translate({s}, {q(T.MATCH_PROFILE_ACCENTED)}, {q(T.MATCH_PROFILE_PLAIN)})"
    s = f"regexp_replace({s}, '[^a-z0-9\\s]', ' ', 'g')"
    s = f"trim(regexp_replace({s}, '\\s+', ' ', 'g'))"
    for p, r in T.MATCH_ABBREVIATIONS + T.MATCH_PHRASES + T.MATCH_ROMAN_NUMERALS:
        s = f"regexp_replace({s}, {q(p)}, {q(r)}, 'g')"
    return f"trim(regexp_replace({s}, '\\s+', ' ', 'g'))"


def month_label(ordinal: str) -> str:
    arms = " ".join(f"WHEN {i} THEN {q(m)}" for i, m in enumerate(MONTH_LABELS, start=1))
    return f"(CASE CAST({ordinal} AS INTEGER) {arms} END)"


def month_ordinal(label: str) -> str:
    arms = " ".join(f"WHEN {q(m)} THEN {i}" for i, m in enumerate(MONTH_LABELS, start=1))
    return f"(CASE {label} {arms} END)"


def ym_id(y: str, m: str) -> str:
    return f"CAST(CAST({y} AS VARCHAR) || lpad(CAST({m} AS VARCHAR), 2, '0') AS INTEGER)"


def ym_label(y: str, m: str) -> str:
    return f"(CAST({y} AS VARCHAR) || '-' || lpad(CAST({m} AS VARCHAR), 2, '0'))"


def dense_id(key: str, id_col: str, source: str) -> str:
    """Dense ids 1..n by key order over the distinct non-empty keys."""
    return (f"SELECT CAST(row_number() OVER (ORDER BY {key}) AS INTEGER) AS {id_col}, {key} "
            f"FROM (SELECT DISTINCT {key} FROM ({source}) WHERE {key} IS NOT NULL AND {key} <> '')")
