"""The union, map and serving views as catalog views over the stored tables.

A view's text names stored tables only, so every session of the catalog can
read it and Spark plans it anew each time: a filter on the view reaches the
scans of its facts.  The cases meet the geographic dimension by their place id.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import SparkSession

from casemart.operators.spatial import GEO_VIEW_COLUMNS, MAP_KEYS
from casemart.plans.mart import CaseMart

_CASE = ["fonte", "doenca", "bairro", "sexo", "ano", "mes", "ordem_mes", "ano_mes", "data", "idade", "unidade_notificacao"]
_IDS = ["id_doenca", "id_bairro", "id_sexo", "id_tempo"]


def _select(columns: Mapping[str, str], source: str) -> str:
    return "SELECT " + ", ".join(f"{text} AS `{name}`" for name, text in columns.items()) + f" FROM {source}"


def _joined(prefix: str, fact: str, dims: Sequence[str]) -> str:
    keys = {"dim_doenca": "id_doenca", "dim_bairro": "id_bairro", "dim_sexo": "id_sexo", "dim_tempo": "id_tempo"}
    return f"{prefix}.{fact} AS f " + " ".join(f"LEFT JOIN {prefix}.{d} AS {d} ON f.{keys[d]} = {d}.{keys[d]}" for d in dims)


def _month(of: str) -> dict[str, str]:
    return {c: f"{of}.{c}" for c in ("ano", "mes", "ordem_mes", "ano_mes")}


def _cases(prefix: str, dated: str, undated: str, serving: bool) -> str:
    who = {"doenca": "dim_doenca.doenca", "bairro": "dim_bairro.bairro", "sexo": "dim_sexo.sexo"}
    year = "f.ano_referencia"
    first = {"fonte": f"'{dated}'", **who, **_month("dim_tempo"), "data": "f.data", "idade": "f.idade", "unidade_notificacao": "f.unidade_notificacao"}
    other = {"fonte": f"'{undated}'", **who, "ano": year, "mes": "CAST(NULL AS STRING)", "ordem_mes": "CAST(NULL AS INT)",
             "ano_mes": f"CAST({year if serving else 'NULL'} AS STRING)", "data": "CAST(NULL AS DATE)", "idade": "f.idade",
             "unidade_notificacao": "CAST(NULL AS STRING)"}
    ids = {c: f"f.{c}" for c in _IDS}
    first, other = {**first, **ids}, {**other, **ids, "id_tempo": "CAST(NULL AS INT)"}
    if not serving:         # the place id stays: the geographic view needs it
        first, other = ({c: x[c] for c in [*_CASE, "id_bairro"]} for x in (first, other))
    people = ["dim_doenca", "dim_bairro", "dim_sexo"]
    return (_select(first, _joined(prefix, f"fato_{dated}_final", [*people, "dim_tempo"])) + " UNION ALL "
            + _select(other, _joined(prefix, f"fato_{undated}_final", people)))


def view_texts(prefix: str, mart: CaseMart) -> dict[str, str]:
    """View name -> its query, in order of dependence."""
    out = {"vw_serie_temporal": " UNION ALL ".join(
        _select({"fonte": f"'{f}'", **_month("dim_tempo"), "doenca": "dim_doenca.doenca", "casos": "f.casos", "obitos": "f.obitos"},
                _joined(prefix, f"fato_{f}_final", ["dim_tempo", "dim_doenca"])) for f in mart.series)}
    both = (mart.dated_source, mart.undated_source)
    with_id = _cases(prefix, *both, serving=False)
    out["vw_casos_espaciais"] = f"SELECT {', '.join(_CASE)} FROM ({with_id})"
    out["vw_casos_espaciais_serving"] = _cases(prefix, *both, serving=True)
    geo = ", ".join("g.osm_display_name AS bairro_display_name" if c == "osm_display_name" else f"g.{c}" for c in GEO_VIEW_COLUMNS)
    out["vw_casos_espaciais_geo"] = (f"SELECT {', '.join('c.' + x for x in _CASE)}, {geo} FROM ({with_id}) AS c "
                                     f"LEFT JOIN {prefix}.dim_bairro_geografica AS g ON c.id_bairro = g.id_bairro")
    keys = ", ".join("bairro AS bairro_original" if c == "bairro" else c for c in MAP_KEYS)
    out["vw_mapa_casos_bairro"] = f"SELECT {keys}, count(*) AS casos FROM {prefix}.vw_casos_espaciais_geo GROUP BY {', '.join(MAP_KEYS)}"
    out["vw_mapa_casos_bairro_mapeavel"] = f"SELECT * FROM {prefix}.vw_mapa_casos_bairro WHERE is_mappable"
    served = ["fonte", "doenca", "ano", "mes", "ordem_mes", "ano_mes", "bairro_original", "id_bairro", "id_bairro_canonico", "bairro_padronizado"]
    out["vw_mapa_serving"] = (f"SELECT {', '.join(served)}, latitude_plot AS latitude, longitude_plot AS longitude, casos "
                              f"FROM {prefix}.vw_mapa_casos_bairro_mapeavel WHERE latitude_plot IS NOT NULL AND longitude_plot IS NOT NULL")
    out["vw_qualidade_espacial"] = ("SELECT spatial_status, spatial_quality, is_mappable, count(*) AS registros "
                                    f"FROM {prefix}.vw_casos_espaciais_geo GROUP BY spatial_status, spatial_quality, is_mappable")
    return out


def create_views(spark: SparkSession, prefix: str, mart: CaseMart) -> list[str]:
    """Create or replace every view in the database ``prefix``."""
    texts = view_texts(prefix, mart)
    for name, text in texts.items():
        spark.sql(f"CREATE OR REPLACE VIEW {prefix}.{name} AS {text}")
    return list(texts)
