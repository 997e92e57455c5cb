"""Manual rule overlays on top of automated results.

Rules are keyed by a normalized name (stable across runs, unlike surrogate
ids).  Rule tables are small by nature but are still broadcast only after a
size check; above the bound the overlay is an ordinary shuffle join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


GENERIC_METHOD = "manual_unresolved_generic"


def duplicated_rule_keys(rules: DataFrame, key: str) -> DataFrame:
    """Rule keys that occur more than once (empty when rules are unique)."""
    return rules.groupBy(key).agg(F.count(F.lit(1)).alias("occurrences")).filter(F.col("occurrences") > 1)


def require_unique_rules(rules: DataFrame, key: str, shown: int = 20) -> None:
    """Raise on duplicated rule keys, with their number and the first ``shown``."""
    dup = duplicated_rule_keys(rules, key)
    first = dup.orderBy(key).limit(shown).collect()
    if first:
        raise ValueError(f"{dup.count()} duplicated {key} values in rule table, first {len(first)}: {[r[key] for r in first]}")


def live_rules(rules: DataFrame, base: DataFrame, key: str) -> DataFrame:
    """Rules whose key occurs in ``base`` (semi join: rules never multiply)."""
    return rules.join(base.select(key), key, "left_semi")


def dead_rules(rules: DataFrame, base: DataFrame, key: str) -> DataFrame:
    """Rules whose key does not occur in ``base``."""
    return rules.join(base.select(key), key, "left_anti")


def overlay_values(base: DataFrame, overrides: DataFrame, key: Sequence[str] | str, columns: Sequence[str],
                   prefix: str = "manual_", carry: Sequence[str] = ()) -> DataFrame:
    """``base`` with ``<prefix>col`` of the override of its key in place of
    ``col`` wherever the override has a value, for each of ``columns``; the
    override's ``carry`` columns are added (NULL without an override)."""
    keys = [key] if isinstance(key, str) else list(key)
    new = {c: f"{prefix}{c}" for c in columns}
    both = base.join(overrides.select(*keys, *new.values(), *carry), keys, "left")
    kept = [F.coalesce(new[c], c).alias(c) if c in new else F.col(c) for c in base.columns]
    return both.select(*kept, *carry)


def overlay_standardization(base: DataFrame, rules: DataFrame, key: str = "bairro_original_key") -> DataFrame:
    """Apply manual standardization rules to a standardized mapping.

    A rule's values win where it has them (a NULL query keeps the automated
    one).  A ruled name is reviewed again only if the rule says that it is
    generic; ``use_for_geocoding`` is the rule's, by default true.
    """
    verdict = rules.withColumns({"manual_needs_review": F.col("manual_match_method") == F.lit(GENERIC_METHOD),
                                 "use_for_geocoding": F.col("manual_use_for_geocoding")})
    ruled = overlay_values(base, verdict, key, ["id_bairro_canonico", "bairro_padronizado", "query_geocoding",
                                                "match_method", "needs_review"], carry=["use_for_geocoding", "curation_note"])
    return ruled.withColumn("use_for_geocoding", F.coalesce("use_for_geocoding", F.lit(True)))
