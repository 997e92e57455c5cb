"""Calendar helpers: month labels <-> ordinals, dirty date parsing."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

from casemart.functions.text import as_column

# The twelve valid month labels in calendar order (the label
# "MARÇO" keeps its cedilla; an unaccented "MARCO" is not a valid label).
MONTH_LABELS = [
    "JANEIRO", "FEVEREIRO", "MARÇO", "ABRIL", "MAIO", "JUNHO",
    "JULHO", "AGOSTO", "SETEMBRO", "OUTUBRO", "NOVEMBRO", "DEZEMBRO",
]

DATE_FORMAT = "dd/MM/yyyy"


def _label_to_ordinal_map() -> Column:
    pairs = []
    for i, label in enumerate(MONTH_LABELS, start=1):
        pairs += [F.lit(label), F.lit(i)]
    return F.create_map(*pairs)


def _ordinal_to_label_map() -> Column:
    pairs = []
    for i, label in enumerate(MONTH_LABELS, start=1):
        pairs += [F.lit(i), F.lit(label)]
    return F.create_map(*pairs)


def month_ordinal(label: Column | str) -> Column:
    """1..12 for a valid label, NULL otherwise."""
    return F.try_element_at(_label_to_ordinal_map(), as_column(label))


def month_label(ordinal: Column | str) -> Column:
    """Label for 1..12, NULL otherwise."""
    return F.try_element_at(_ordinal_to_label_map(), as_column(ordinal).cast("int"))


def parse_date(c: Column | str, fmt: str = DATE_FORMAT) -> Column:
    """Strict date parse of trimmed text; unparsable -> NULL (never fails).

    A text without one of the format's separators cannot be parsed (but for
    optional parts in brackets); the parser does not see it, as a refusal costs
    many times what a parse does."""
    text = F.trim(as_column(c).cast("string"))
    likely = reduce(and_, [F.contains(text, F.lit(mark)) for mark in sorted(set(fmt.partition("[")[0]) & set("/-.: "))], F.lit(True))
    return F.when(likely, F.try_to_date(text, fmt))


def year_month_id(year: Column, ordinal: Column) -> Column:
    """Integer ``yyyymm`` built as text then cast (e.g. 2024, 3 -> 202403)."""
    return F.concat_ws("", year.cast("string"), F.lpad(ordinal.cast("string"), 2, "0")).try_cast("int")


def year_month_label(year: Column, ordinal: Column) -> Column:
    """``yyyy-mm`` text."""
    return F.concat_ws("-", year.cast("string"), F.lpad(ordinal.cast("string"), 2, "0"))
