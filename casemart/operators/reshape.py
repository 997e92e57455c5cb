"""Spreadsheet-shaped inputs -> long relational rows.

* ``extract_blocks``: several tables stacked in one sheet, located by row
  position, tagged in one projection (no join, no per-block rescan).
* ``unpivot_measures``: one column *pair* per year -> one row per year with
  several measures, via ``inline(array(struct ...))`` - a single scan, where
  a union of per-year selects would rescan the input once per year.
* ``series_from_sheet``: the whole monthly-sheet recipe (label cleanup, noise
  removal, unpivot, unpublished-period removal, secondary measure default,
  month ordinal).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casemart.functions.calendar import MONTH_LABELS, month_ordinal
from casemart.functions.text import clean_int, clean_label
from casemart.operators.dims import ordinal

# year -> {measure name -> source column or None (absent measure)}
MeasureMap = Mapping[int, Mapping[str, str | None]]


def with_position(df: DataFrame, order_cols: Sequence[str], out_col: str = "row_id") -> DataFrame:
    """1-based row position following an explicit total order.

    File order is not a property of a distributed DataFrame; the caller names
    the columns that encode it (e.g. a line number).  Uses the distributed
    ``ordinal`` operator, never a single-partition window.
    """
    return ordinal(df, order_cols, out_col)


def extract_blocks(df: DataFrame, position_col: str,
                   blocks: Sequence[tuple[str, int, int]], block_col: str = "block") -> DataFrame:
    """Keep rows whose position lies in one of the closed ranges
    ``(name, lo, hi)`` and tag them with the block name."""
    pos = F.col(position_col)
    tag: Column | None = None
    for name, lo, hi in blocks:
        cond = pos.between(lo, hi)
        tag = F.when(cond, F.lit(name)) if tag is None else tag.when(cond, F.lit(name))
    return df.withColumn(block_col, tag).filter(F.col(block_col).isNotNull())


def keep_valid_labels(df: DataFrame, raw_label_col: str, out_col: str = "mes",
                      valid: Sequence[str] = MONTH_LABELS) -> DataFrame:
    """Clean the label column (BOM, trim, upper) and drop noise rows."""
    return df.withColumn(out_col, clean_label(F.col(raw_label_col))).filter(F.col(out_col).isin(list(valid)))


def unpivot_measures(df: DataFrame, keep_cols: Sequence[str], measure_map: MeasureMap,
                     key_col: str = "ano", measures: Sequence[str] = ("casos", "obitos"),
                     clean=clean_int, absent_value: int = 0) -> DataFrame:
    """Wide -> long with several measures per key in a single scan.

    ``measure_map[year][measure]`` names the source column; ``None`` means the
    sheet has no such column for that year and the measure is ``absent_value``.
    """
    structs = []
    for year, cols in measure_map.items():
        fields = [F.lit(year).alias(key_col)]
        for m in measures:
            src = cols.get(m)
            fields.append((clean(F.col(src)) if src is not None else F.lit(absent_value).cast("int")).alias(m))
        structs.append(F.struct(*fields))
    return df.select(*keep_cols, F.inline(F.array(*structs)))


def finalize_series(df: DataFrame, label: str, main: str = "casos", secondary: str = "obitos",
                    label_col: str = "mes", year_col: str = "ano", ordinal_col: str = "ordem_mes",
                    category_col: str = "doenca") -> DataFrame:
    """Drop unpublished periods (main measure NULL - NULL is not 0), default
    the secondary measure to 0, add the month ordinal and the category tag."""
    return (df.filter(F.col(main).isNotNull())
            .select(F.col(year_col), F.col(label_col), month_ordinal(F.col(label_col)).alias(ordinal_col),
                    F.col(main), F.coalesce(F.col(secondary), F.lit(0)).alias(secondary),
                    F.lit(label).alias(category_col)))


def series_from_sheet(df: DataFrame, label_col: str, measure_map: MeasureMap, category: str) -> DataFrame:
    """Monthly wide sheet -> ``(ano, mes, ordem_mes, casos, obitos, doenca)``."""
    months = keep_valid_labels(df, label_col)
    long = unpivot_measures(months, ["mes"], measure_map)
    return finalize_series(long, category)


def series_from_stacked_sheet(df: DataFrame, position_col: str, label_col: str,
                              blocks: Sequence[tuple[str, int, int, MeasureMap]]) -> DataFrame:
    """Stacked sheet -> one long series.  Each block ``(category, lo, hi,
    measure_map)`` has its own column layout; all blocks are tagged in one
    projection and unpivoted from the same scan."""
    tagged = extract_blocks(df, position_col, [(b[0], b[1], b[2]) for b in blocks], "_cm_block")
    months = keep_valid_labels(tagged, label_col)
    # One struct array per row: only the current block's layout applies.
    structs = []
    for category, _lo, _hi, mmap in blocks:
        for year, cols in mmap.items():
            fields = [F.lit(category).alias("doenca"), F.lit(year).alias("ano")]
            for m in ("casos", "obitos"):
                src = cols.get(m)
                fields.append((clean_int(F.col(src)) if src is not None else F.lit(0).cast("int")).alias(m))
            structs.append((category, F.struct(*fields)))
    # Keep the structs of the row's own block only.
    arrays = None
    for category in dict.fromkeys(c for c, _ in structs):
        arr = F.array(*[s for c, s in structs if c == category])
        arrays = (F.when(F.col("_cm_block") == category, arr) if arrays is None
                  else arrays.when(F.col("_cm_block") == category, arr))
    long = months.select("mes", F.inline(arrays))
    return (long.filter(F.col("casos").isNotNull())
            .select("ano", "mes", month_ordinal(F.col("mes")).alias("ordem_mes"), "casos",
                    F.coalesce(F.col("obitos"), F.lit(0)).alias("obitos"), "doenca"))
