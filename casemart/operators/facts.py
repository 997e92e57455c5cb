"""Line-list cleaning, fact key resolution and denormalized union views."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casemart.functions.calendar import month_label, parse_date
from casemart.functions.text import clean_int, normalize_key, normalize_text

# ---------------------------------------------------------------- line lists

def digit_rows(df: DataFrame, id_col: str = "_c0") -> DataFrame:
    """Keep data rows: the trimmed id cell is all digits (drops headers)."""
    return df.filter(F.trim(F.col(id_col).cast("string")).rlike(r"^[0-9]+$"))


def clean_dated_linelist(df: DataFrame, category: str, id_col: str = "_c0", date_col: str = "_c1",
                         age_col: str = "_c2", sex_col: str = "_c3", place_col: str = "_c4",
                         unit_col: str = "_c5", exam_col: str = "_c6", date_format: str = "dd/MM/yyyy"
                         ) -> DataFrame:
    """Positional dated case list -> ``(data, idade, sexo, bairro,
    unidade_notificacao, exame, doenca)``; rows without a place are dropped."""
    return (digit_rows(df, id_col)
            .select(parse_date(F.col(date_col), date_format).alias("data"),
                    clean_int(F.col(age_col)).alias("idade"),
                    normalize_text(F.col(sex_col)).alias("sexo"),
                    normalize_text(F.col(place_col)).alias("bairro"),
                    F.trim(F.col(unit_col).cast("string")).alias("unidade_notificacao"),
                    normalize_text(F.col(exam_col)).alias("exame"),
                    F.lit(category).alias("doenca"))
            .filter(F.col("bairro").isNotNull() & (F.col("bairro") != "")))


def clean_undated_linelist(df: DataFrame, category: str, reference_year: int, id_col: str = "_c0",
                           age_col: str = "_c1", sex_col: str = "_c2", place_col: str = "_c3"
                           ) -> DataFrame:
    """Positional undated case list -> ``(idade, sexo, bairro,
    ano_referencia, doenca)``."""
    return (digit_rows(df, id_col)
            .select(clean_int(F.col(age_col)).alias("idade"),
                    normalize_text(F.col(sex_col)).alias("sexo"),
                    normalize_text(F.col(place_col)).alias("bairro"),
                    F.lit(reference_year).alias("ano_referencia"),
                    F.lit(category).alias("doenca"))
            .filter(F.col("bairro").isNotNull() & (F.col("bairro") != "")))


@dataclass(frozen=True)
class ListLayout:
    """Where one kind of case list keeps its fields; what a list lacks is None."""

    category: str
    age: str
    sex: str
    place: str
    date: str | None = None
    unit: str | None = None
    exam: str | None = None
    reference_year: int | None = None
    date_format: str = "dd/MM/yyyy"


def clean_linelists(df: DataFrame, list_col: str, layouts: Mapping[str, ListLayout], id_col: str = "_c0") -> DataFrame:
    """Positional case lists of several layouts in one table -> ``(list_col,
    data, idade, sexo, bairro, unidade_notificacao, exame, ano_referencia,
    doenca)`` in one pass, by the rules of the cleaners above.

    ``list_col`` names each row's layout.  What a layout lacks is a typed NULL;
    rows of a list without a layout and rows without a place are dropped.
    """
    def pick(field: str) -> Column:
        """The text cell that holds the field in the row's own layout."""
        out = F.lit(None).cast("string")
        for name, layout in layouts.items():
            if getattr(layout, field) is not None:
                out = F.when(F.col(list_col) == name, F.col(getattr(layout, field)).cast("string")).otherwise(out)
        return out

    def fixed(field: str, kind: str) -> Column:
        out = F.lit(None).cast(kind)
        for name, layout in layouts.items():
            out = F.when(F.col(list_col) == name, F.lit(getattr(layout, field)).cast(kind)).otherwise(out)
        return out

    date = F.lit(None).cast("date")
    for name, layout in layouts.items():
        if layout.date is not None:
            date = F.when(F.col(list_col) == name, parse_date(F.col(layout.date), layout.date_format)).otherwise(date)
    # a place is empty after cleaning if it is empty once trimmed: filtered so, it is cleaned once
    return (digit_rows(df.filter(F.col(list_col).isin(list(layouts))), id_col).filter(F.trim(pick("place")) != "")
            .select(list_col, date.alias("data"), clean_int(pick("age")).alias("idade"),
                    normalize_text(pick("sex")).alias("sexo"), normalize_text(pick("place")).alias("bairro"),
                    F.trim(pick("unit")).alias("unidade_notificacao"), normalize_text(pick("exam")).alias("exame"),
                    fixed("reference_year", "int").alias("ano_referencia"), fixed("category", "string").alias("doenca")))


# ---------------------------------------------------------- key resolution

@dataclass(frozen=True)
class DimRef:
    """A dimension to resolve: join ``dim`` on ``on`` (USING columns)."""

    dim: DataFrame
    on: Sequence[str]


def resolve_keys(fact: DataFrame, dims: Sequence[DimRef], keep: Sequence[str | Column]) -> DataFrame:
    """Replace natural keys by surrogate ids with left joins.

    A key without a match yields a NULL id (surfaced later by the null-key
    audit).  Dimensions are stored tables, so the planner knows their bytes
    and broadcasts those under ``spark.sql.autoBroadcastJoinThreshold``.
    Dimension keys must be unique, otherwise facts fan out (the row
    preservation audit catches that).
    """
    out = fact
    for ref in dims:
        out = out.join(ref.dim, list(ref.on), "left")
    return out.select(*keep)


def with_calendar_keys(df: DataFrame, date_col: str, year_col: str = "ano", label_col: str = "mes",
                       ordinal_col: str = "ordem_mes") -> DataFrame:
    d = F.col(date_col)
    return df.withColumns({year_col: F.year(d), ordinal_col: F.month(d),
                           label_col: month_label(F.month(d))})


def with_normalized(df: DataFrame, cols: Sequence[str], normalize=normalize_key) -> DataFrame:
    return df.withColumns({c: normalize(F.col(c)) for c in cols})
