"""The driver's tables re-read as a case-report data mart.

The reference ingests wide monthly spreadsheets, stacked sheets and per-case
line lists.  The driver ships TPC-H-like tables instead, so this module
derives those *shapes* from them, with Spark, at full table size:

* **monthly sheets** - orders counted per (year, month) and pivoted into a
  wide sheet with one column pair per year, thousand separators, a BOM on the
  first label, lower-case/padded labels and noise rows (header, total).  A
  stacked sheet puts one such block per order status under each other, each
  with its own column layout.
* **case line lists** - every lineitem row is a case: its ship date is the
  notification date, quantity the age, return flag the sex, line status the
  source (``F`` dated, ``O`` undated) and the *place* is the part's name,
  perturbed per part key into the usual dirt: upper case, accents, a dropped
  letter, swapped words, an abbreviation plus a roman numeral, or a code
  (the brand) that only a manual rule resolves.
* **reference tables** - canonical places are the distinct part names, aliases
  are the swapped-word spellings, manual rules come from the brands, geocoder
  candidates from the part rows (coordinates, display names, classes and
  types computed from part attributes), manual reference points from a name
  family.

Everything is a DataFrame transformation of the given tables, so the work of
every query grows with them.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casemart.functions.calendar import MONTH_LABELS
from casemart.functions.text import match_key
from casemart.operators.facts import ListLayout

# Labels of the derived sources (parameters of the plans, not of the library).
DATED_SOURCE = "entregas"        # lineitem rows with line status F
UNDATED_SOURCE = "pendentes"     # lineitem rows with line status O
UNDATED_REFERENCE_YEAR = 2026
CITY = "Araçatuba"
RULE_ID_BASE = 900000
DEAD_RULE_SHIFT = 100


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def thousands(c: Column) -> Column:
    """Integer as sheet text with '.' thousand separators ("1.234")."""
    return F.regexp_replace(F.format_number(c.cast("long"), 0), ",", ".")


def place_variant(p_partkey: Column, p_name: Column, p_brand: Column) -> Column:
    """Dirty spelling of a part name, chosen by part key (7 variants)."""
    k = p_partkey % 7
    cut = (p_partkey % F.length(p_name)).cast("int")
    typo = F.concat(p_name.substr(F.lit(1), cut), p_name.substr(cut + 2, F.lit(1 << 20)))
    swapped = F.concat(F.split_part(p_name, F.lit(" "), F.lit(2)), F.lit(" "),
                       F.split_part(p_name, F.lit(" "), F.lit(1)))
    return (F.when(k == 0, p_name)
            .when(k == 1, F.upper(p_name))
            .when(k == 2, F.translate(p_name, "aeiou", "áéíóú"))
            .when(k == 3, typo)
            .when(k == 4, swapped)
            .when(k == 5, F.concat(F.lit("  jd "), p_name, F.lit(" ii ")))
            .otherwise(p_brand))


def display_name(c: Column) -> Column:
    """Capitalised display form of a lower-case name ("small ring" -> "Small ring")."""
    return F.concat(F.upper(F.substring(c, 1, 1)), F.substring(c, 2, 1 << 20))


class World:
    """Lazily derived tables of one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def t(self, name: str) -> DataFrame:
        return read(self.spark, self.sf_dir, name)

    # ------------------------------------------------------------ sheets
    @cached_property
    def monthly_orders(self):
        """Orders and urgent orders per (status, year, month): one scan of
        orders, partially aggregated, stored once (a few hundred rows)."""
        from casemart.session import freeze
        o = self.t("orders").select("o_orderstatus", "o_orderdate", "o_orderpriority")
        return freeze(o.groupBy(F.col("o_orderstatus").alias("s"), F.year("o_orderdate").alias("y"),
                                F.month("o_orderdate").alias("m"))
                      .agg(F.count(F.lit(1)).alias("c"),
                           F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("d")))

    @cached_property
    def order_years(self) -> list[int]:
        """Distinct order years (one column pair each); bounded by the
        calendar span of the data, so collecting them is safe."""
        rows = (self.monthly_orders.select("y").distinct().filter(F.col("y").isNotNull()).orderBy("y").collect())
        return [r.y for r in rows]

    def _sheet_label(self, m: Column) -> Column:
        labels = F.create_map(*[x for i, lab in enumerate(MONTH_LABELS, 1)
                                for x in (F.lit(i), F.lit(lab))])
        lab = F.try_element_at(labels, m)
        return (F.when(m == 1, F.concat(F.lit("\ufeff"), F.lit("Janeiro")))
                .when(m == 3, F.lit(" março "))
                .when(m % 2 == 0, F.lower(lab))
                .otherwise(lab))

    def monthly_sheet(self, status: str | None = None) -> DataFrame:
        """Wide sheet: ``_c0`` label, then per year ``(_c{2i+1}, _c{2i+2})`` =
        (orders, urgent orders) as text; plus a header and a total row."""
        mo = self.monthly_orders
        if status is not None:
            mo = mo.filter(F.col("s") == status)
        monthly = mo.groupBy("y", "m").agg(F.sum("c").alias("c"), F.sum("d").alias("d"))
        years = self.order_years
        wide = (monthly.groupBy("m").pivot("y", years)
                .agg(F.first(thousands(F.col("c"))).alias("c"), F.first(thousands(F.col("d"))).alias("d")))
        cols = [self._sheet_label(F.col("m")).alias("_c0")]
        header = [F.lit("MÊS").alias("_c0")]
        for i, y in enumerate(years):
            cols += [F.col(f"{y}_c").alias(f"_c{2 * i + 1}"), F.col(f"{y}_d").alias(f"_c{2 * i + 2}")]
            header += [F.lit(str(y)).alias(f"_c{2 * i + 1}"), F.lit("óbitos").alias(f"_c{2 * i + 2}")]
        body = wide.select(*cols, F.col("m").alias("_line"))
        total = monthly.groupBy("y").agg(F.sum("c").alias("c"))
        total_row = total.groupBy().pivot("y", years).agg(F.first(thousands(F.col("c"))))
        total_row = total_row.select(F.lit("TOTAL").alias("_c0"),
                                     *[F.col(str(y)).alias(f"_c{2 * i + 1}") for i, y in enumerate(years)],
                                     F.lit(13).alias("_line"))
        head = self.spark.range(1).select(*header, F.lit(0).alias("_line"))
        return body.unionByName(total_row, allowMissingColumns=True).unionByName(head, allowMissingColumns=True)

    def series_layout(self) -> dict[int, dict[str, str | None]]:
        return {y: {"casos": f"_c{2 * i + 1}", "obitos": f"_c{2 * i + 2}"}
                for i, y in enumerate(self.order_years)}

    # stacked sheet: one block per order status, 20 rows apart
    @cached_property
    def stack(self) -> list[tuple[str, int]]:
        """``(status, first line)``: every order status there is, in order, 20 lines apart."""
        rows = self.monthly_orders.select("s").distinct().filter("s IS NOT NULL").orderBy("s").collect()
        return [(r.s, 5 + 20 * i) for i, r in enumerate(rows)]

    def stacked_sheet(self) -> DataFrame:
        frames = []
        for status, lo in self.stack:
            s = self.monthly_sheet(status)
            frames.append(s.withColumn("row_id", F.col("_line") + F.lit(lo - 1)))
        out = frames[0]
        for f in frames[1:]:
            out = out.unionByName(f, allowMissingColumns=True)
        return out.drop("_line")

    def stacked_layout(self):
        """``(category, lo, hi, measure_map)`` per block: blocks start two rows
        after their header, hold 12 months and the total row; the P block has
        no urgent column for its first two years (measure defaults to 0)."""
        years = self.order_years
        out = []
        for status, lo in self.stack:
            mmap = {}
            for i, y in enumerate(years):
                deaths = None if (status == "P" and i < 2) else f"_c{2 * i + 2}"
                mmap[y] = {"casos": f"_c{2 * i + 1}", "obitos": deaths}
            out.append((status.lower(), lo, lo + 12, mmap))
        return out

    # -------------------------------------------------------- line lists
    @cached_property
    def cases_base(self) -> DataFrame:
        li = self.t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                                       "l_returnflag", "l_linestatus", "l_shipdate")
        p = self.t("part").select("p_partkey", place_variant(F.col("p_partkey"), F.col("p_name"), F.col("p_brand")).alias("place"))
        # a case without its part has no place: the line-list cleaners drop it by that rule
        return li.join(p, li.l_partkey == p.p_partkey, "left")

    @staticmethod
    def _case_id(c_orderkey: Column, c_line: Column) -> Column:
        return F.when(c_line == 7, F.lit("Nº"))\
            .otherwise(F.concat(F.lit(" "), (c_orderkey * 10 + c_line).cast("string")))

    @staticmethod
    def _sex(flag: Column) -> Column:
        return F.when(flag == "R", F.lit("Feminino")).when(flag == "A", F.lit("masculino  ")).otherwise(F.lit(""))

    def _dated_cells(self) -> list[Column]:
        flag = F.col("l_returnflag")
        return [self._case_id(F.col("l_orderkey"), F.col("l_linenumber")),
                F.when(F.col("l_linenumber") == 6, F.date_format("l_shipdate", "yyyy-MM-dd"))
                .otherwise(F.date_format("l_shipdate", "dd/MM/yyyy")),
                F.col("l_quantity").cast("int").cast("string"), self._sex(flag), F.col("place"),
                F.concat(F.lit(" UBS "), (F.col("l_suppkey") % 10).cast("string"), F.lit(" ")),
                F.when(flag == "R", F.lit("Positivo")).otherwise(F.lit("não reagente"))]

    def _undated_cells(self) -> list[Column]:
        return [self._case_id(F.col("l_orderkey"), F.col("l_linenumber")), F.col("l_quantity").cast("int").cast("string"),
                self._sex(F.col("l_returnflag")), F.col("place")]

    def _cases(self, status: str, cells: list[Column]) -> DataFrame:
        return self.cases_base.filter(F.col("l_linestatus") == status).select(*[c.alias(f"_c{i}") for i, c in enumerate(cells)])

    def raw_dated_cases(self) -> DataFrame:
        return self._cases("F", self._dated_cells())

    def raw_undated_cases(self) -> DataFrame:
        return self._cases("O", self._undated_cells())

    def raw_cases(self) -> DataFrame:
        """Both case lists in one table, each row in the columns of its own list:
        one join for all of them; ``lista`` names the list."""
        dated = F.col("l_linestatus") == "F"
        cells, others = self._dated_cells(), self._undated_cells()
        others += [F.lit(None).cast("string")] * (len(cells) - len(others))
        return (self.cases_base.filter(F.col("l_linestatus").isin("F", "O"))
                .select(F.when(dated, DATED_SOURCE).otherwise(UNDATED_SOURCE).alias("lista"),
                        *[F.when(dated, x).otherwise(y).alias(f"_c{i}") for i, (x, y) in enumerate(zip(cells, others))]))

    @staticmethod
    def list_layouts() -> dict[str, ListLayout]:
        return {DATED_SOURCE: ListLayout(DATED_SOURCE, date="_c1", age="_c2", sex="_c3", place="_c4", unit="_c5", exam="_c6"),
                UNDATED_SOURCE: ListLayout(UNDATED_SOURCE, age="_c1", sex="_c2", place="_c3", reference_year=UNDATED_REFERENCE_YEAR)}

    # -------------------------------------------------- reference tables
    def canonical_places(self) -> DataFrame:
        """Canonical table: one row per distinct part name."""
        from casemart.operators.dims import dense_ids
        names = self.t("part").select(F.col("p_name").alias("bairro_canonico_norm"))
        ids = dense_ids(names, "bairro_canonico_norm", "id_bairro_canonico")
        name = display_name(F.col("bairro_canonico_norm"))
        query = F.when(F.col("bairro_canonico_norm").startswith("new "), F.lit(None).cast("string"))\
            .otherwise(F.concat(name, F.lit(f", {CITY}, São Paulo, Brasil")))
        return ids.select("id_bairro_canonico", name.alias("bairro_canonico"), "bairro_canonico_norm",
                          F.lit(CITY).alias("municipio"), F.lit("SP").alias("uf"), F.lit("Brasil").alias("pais"),
                          F.lit("bairro").alias("tipo_localidade"), F.lit(True).alias("use_for_geocoding"),
                          query.alias("query_geocoding"))

    def alias_rules(self) -> DataFrame:
        """Swapped-word spellings point at the canonical name; a second set
        points at names that are not canonical (must not resolve)."""
        n = self.t("part").select("p_name").distinct()
        swapped = F.concat(F.split_part("p_name", F.lit(" "), F.lit(2)), F.lit(" "),
                           F.split_part("p_name", F.lit(" "), F.lit(1)))
        good = n.select(swapped.alias("alias_norm_observado"), F.col("p_name").alias("bairro_canonico_sugerido"),
                        F.lit("swapped words").alias("observacao"))
        bad = n.select(F.concat(F.lit("jd "), F.col("p_name"), F.lit(" ii")).alias("alias_norm_observado"),
                       F.concat(F.lit("zona "), F.col("p_name")).alias("bairro_canonico_sugerido"),
                       F.lit("target is not canonical").alias("observacao"))
        return good.unionByName(bad)

    def manual_rules(self) -> DataFrame:
        """Manual standardization rules derived from the brands; rules for
        brand numbers shifted by 100 never match (dead rules)."""
        b = self.t("part").select(F.regexp_extract("p_brand", r"([0-9]+)", 1).cast("int").alias("n")).distinct()
        b = b.filter(F.col("n").isNotNull())
        live = b.select("n", F.col("n").alias("label_n"))
        dead = b.select((F.col("n") + DEAD_RULE_SHIFT).alias("n"), (F.col("n") + DEAD_RULE_SHIFT).alias("label_n"))
        r = live.unionByName(dead)
        generic = (F.col("n") % 5) == 0
        name = F.concat(F.lit("Marca "), F.col("label_n").cast("string"))
        return r.select(
            match_key(F.concat(F.lit("Brand#"), F.col("n").cast("string"))).alias("bairro_original_key"),
            (F.lit(RULE_ID_BASE) + F.col("n")).cast("int").alias("manual_id_bairro_canonico"),
            name.alias("manual_bairro_padronizado"),
            F.when(generic, F.lit(None).cast("string")).otherwise(
                F.concat(name, F.lit(f", {CITY}, São Paulo, Brasil"))).alias("manual_query_geocoding"),
            F.when(generic, F.lit("manual_unresolved_generic")).otherwise(F.lit("manual_new_canonical"))
            .alias("manual_match_method"),
            (~generic).alias("manual_use_for_geocoding"),
            F.lit("brand code curated by hand").alias("curation_note"))

    def geocoder_candidates(self) -> DataFrame:
        """One JSON object per candidate, as a geocoder would return it,
        keyed by the canonical name and the query variant (1..4)."""
        # few bytes a part, many an answer: a task a core at least
        p = self.t("part").repartition(self.spark.sparkContext.defaultParallelism, "p_partkey")
        key = F.col("p_partkey")
        lat = F.when(key % 50 == 0, F.lit("n/a")).otherwise(
            F.concat(F.lit("-21."), F.lpad((key % 400).cast("string"), 3, "0")))
        lon = F.concat(F.lit("-50."), F.lpad(((key * 7) % 700).cast("string"), 3, "0"))
        size = F.col("p_size")
        city = F.when(size % 3 == 0, F.lit("Araçatuba")).when(size % 3 == 1, F.lit("Aracatuba"))\
            .otherwise(F.lit("Birigui"))
        state = F.when(size % 2 == 0, F.lit("São Paulo")).otherwise(F.lit("Minas Gerais"))
        dname = F.concat(display_name(F.col("p_name")), F.lit(", "), city, F.lit(", "), state)
        cls = F.when(F.col("p_type") == "ECONOMY", F.lit("place")).when(F.col("p_type") == "SMALL", F.lit("boundary"))\
            .otherwise(F.lit("highway"))
        typ = F.when(size % 5 == 0, F.lit("suburb")).when(size % 5 == 1, F.lit("neighbourhood"))\
            .when(size % 5 == 2, F.lit("residential")).otherwise(F.lit("road"))
        obj = F.struct(lat.alias("lat"), lon.alias("lon"), dname.alias("display_name"), cls.alias("class"),
                       typ.alias("type"), key.cast("string").alias("osm_id"))
        return p.select(F.col("p_name").alias("place_key"), ((size % 4) + 1).cast("int").alias("query_no"),
                        key.alias("position"), F.to_json(obj).alias("response"))

    def long_places(self) -> DataFrame:
        """Canonical names of 70 characters, one a supplier, that are unlike each
        other but for their beginning."""
        name = F.concat(F.lit("Casa "), F.md5("s_name"), F.lit(" "), F.md5(F.concat("s_name", F.lit("#"))))
        return self.t("supplier").select(F.col("s_suppkey").alias("id_bairro_canonico"), name.alias("bairro_canonico"),
                                         F.lit(None).cast("string").alias("query_geocoding"))

    def long_spellings(self) -> DataFrame:
        """Four spellings a long name: a letter dropped, or 12, 19 or 30 letters overwritten."""
        cut, put = F.array(*map(F.lit, (1, 12, 19, 30))), F.array(*map(F.lit, (0, 12, 19, 30)))
        c = self.long_places().select("*", F.posexplode(cut).alias("v", "cut"))
        at = (6 + F.col("id_bairro_canonico") % 30).cast("int")
        name = F.col("bairro_canonico")
        return c.select((F.col("id_bairro_canonico") * 4 + F.col("v")).alias("id_bairro"), F.concat(
            name.substr(F.lit(1), at - 1), F.repeat(F.lit("z"), F.element_at(put, F.col("v") + 1)),
            name.substr(at + F.col("cut"), F.lit(1 << 20))).alias("bairro_original"))

    def hard_places(self) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
        """``(places, standardized, geocoded, manual points)``, a place a part, in
        which every case of the status cascade occurs: no canonical id, a name not
        to be geocoded, a point set by hand, no coordinates, a point outside the
        box, a low score."""
        k = F.col("p_partkey").cast("int")
        name = F.concat(F.lit("Lugar "), k.cast("string"))
        p = self.t("part")
        standardized = p.select(k.alias("id_bairro"), F.when(k % 13 != 0, k).alias("id_bairro_canonico"), name.alias("bairro_padronizado"),
                                (k % 7 != 0).alias("use_for_geocoding"))
        has = k % 4 != 0
        geocoded = p.select(k.alias("id_bairro_canonico"), F.when(has, F.lit(-21.0) - (k % 500) / F.lit(1000.0)).alias("latitude"),
                            F.when(has, F.lit(-50.4)).alias("longitude"), (k % 500).between(50, 350).alias("is_inside_bbox"),
                            (k % 12).alias("candidate_score"), F.lit("osm").alias("geocode_source_final"))
        points = p.filter(k % 5 == 0).select(name.alias("bairro_padronizado"), F.lit(-21.2).alias("manual_latitude"),
                                             F.lit(-50.43).alias("manual_longitude"), F.lit("mapa").alias("manual_geocode_source"))
        return p.select(k.alias("id_bairro"), F.col("p_name").alias("bairro")), standardized, geocoded, points

    def geocoder_errors(self) -> DataFrame:
        """Failed lookups: the 'cold ...' name family timed out."""
        return (self.t("part").select(F.col("p_name").alias("place_key")).distinct()
                .filter(F.col("place_key").startswith("cold "))
                .select("place_key", F.lit("read timed out").alias("error")))

    def manual_points(self, canonical: DataFrame) -> DataFrame:
        """Manual reference points for the 'small ...' name family."""
        c = canonical.filter(F.col("bairro_canonico_norm").startswith("small "))
        idc = F.col("id_bairro_canonico")
        return c.select(
            F.col("bairro_canonico").alias("bairro_padronizado"),
            (F.lit(-21.2) - (idc % 10) / 1000.0).alias("manual_latitude"),
            (F.lit(-50.44) - (idc % 7) / 1000.0).alias("manual_longitude"),
            F.lit("manual_reference_point").alias("manual_geocode_source"),
            F.lit("Approximate point; not an official centroid.").alias("manual_geocode_note"),
            F.lit("medium").alias("manual_confidence"))
