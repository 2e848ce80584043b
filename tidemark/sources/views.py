"""Curated source views: one row per natural key, lookups resolved, one update time.

Each function takes the operational tables it reads and returns landing columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import three_state
from tidemark.operators.latest import any_row, latest_source_row
from tidemark.operators.lookups import enrich, latest_time, product_within
from tidemark.spec import TIME_SENTINEL, UNDEFINED, UNKNOWN_KEY

# Equipment types that belong to the dimension, and translation keys.
EQUIPMENT_TYPES = ["101", "103", "104", "105", "106", "107", "108", "120", "121", "122"]
TRANSLATIONS = {
    "desc_estado_en_us": "en-us",
    "desc_estado_pt_br": "pt-br",
    "desc_estado_es_es": "es-es",
}


def _number(name: str):
    return F.col(name).cast("decimal(38,0)")


def _cut(column, length: int):
    return F.substring(column.cast("string"), 1, length)


def _or_unknown(name: str):
    return F.coalesce(F.col(name), F.lit(UNKNOWN_KEY)).cast("decimal(38,0)")


def _or_undefined(name: str, length: int = 1000):
    return _cut(F.coalesce(F.col(name), F.lit(UNDEFINED)), length)


def client_view(clients: DataFrame) -> DataFrame:
    """The source has no update time; a constant keeps the contract."""
    base = clients.select("cd_id", "nome", "owner", "server", "fg_ativo")
    return any_row(base, ["cd_id"]).select(
        _number("cd_id").alias("id_cliente"),
        _cut(F.upper("nome"), 255).alias("nome_cliente"),
        _cut(F.upper("owner"), 255).alias("owner_cliente"),
        _cut(F.upper("server"), 255).alias("server_cliente"),
        "fg_ativo",
        F.lit(TIME_SENTINEL).cast("timestamp_ntz").alias("source_updated_at"),
    )


def state_view(states: DataFrame) -> DataFrame:
    base = states.select("cd_estado", "desc_estado", "estado_json", "dt_updated")
    return latest_source_row(base, ["cd_estado"], "dt_updated").select(
        _cut(F.col("cd_estado"), 50).alias("cd_estado"),
        _cut(F.col("desc_estado"), 255).alias("desc_estado"),
        *[
            _cut(F.upper(F.get_json_object("estado_json", f"$['{key}']")), 255).alias(name)
            for name, key in TRANSLATIONS.items()
        ],
        latest_time("dt_updated").alias("source_updated_at"),
    )


def equipment_view(
    equipment: DataFrame, models: DataFrame, types: DataFrame, movements: DataFrame
) -> DataFrame:
    base = equipment.select(
        "cd_cliente",
        "cd_equipamento",
        "desc_equipamento",
        "cd_modelo_equipamento",
        "cd_tp_equipamento",
        "tp_uso_equipamento",
        "fg_ativo",
        "dt_updated",
    ).filter(F.col("cd_tp_equipamento").cast("string").isin(EQUIPMENT_TYPES))
    rows = latest_source_row(base, ["cd_cliente", "cd_equipamento"], "dt_updated")
    rows = enrich(
        rows,
        models,
        {"cd_cliente": "cd_cliente", "cd_modelo_equipamento": "cd_modelo_equipamento"},
        {
            "m_code": "cd_modelo_equipamento",
            "m_text": "desc_modelo_equipamento",
            "m_time": "dt_updated",
        },
    )
    rows = enrich(
        rows,
        types,
        {"cd_cliente": "cd_cliente", "cd_tp_equipamento": "cd_tp_equipamento"},
        {"t_code": "cd_tp_equipamento", "t_text": "desc_tp_equipamento", "t_time": "dt_updated"},
    )
    last = latest_source_row(
        movements.select(
            "cd_cliente",
            "cd_equipamento",
            F.col("fg_ativo").alias("s_active"),
            F.col("dt_hr_utc_movimento").alias("s_moved"),
            F.col("dt_updated").alias("s_time"),
        ),
        ["cd_cliente", "cd_equipamento"],
        "s_moved",
        "s_time",
    )
    rows = rows.join(last, ["cd_cliente", "cd_equipamento"], "left")
    return rows.select(
        _number("cd_cliente").alias("id_cliente"),
        _cut(F.col("cd_equipamento"), 20).alias("cd_equipamento"),
        _cut(F.col("desc_equipamento"), 1000).alias("desc_equipamento"),
        # A code without a lookup row becomes unknown.
        _or_unknown("m_code").alias("cd_modelo_equipamento"),
        _or_undefined("m_text").alias("desc_modelo_equipamento"),
        _or_unknown("t_code").alias("cd_tipo_equipamento"),
        _or_undefined("t_text").alias("desc_tipo_equipamento"),
        three_state(F.col("s_active")).alias("desc_status"),
        _or_unknown("tp_uso_equipamento").alias("tp_uso_equipamento"),
        "fg_ativo",
        latest_time("dt_updated", "m_time", "t_time", "s_moved", "s_time").alias(
            "source_updated_at"
        ),
    )


def operation_view(operations: DataFrame, groups: DataFrame, processes: DataFrame) -> DataFrame:
    base = operations.select(
        "cd_cliente",
        "cd_operacao",
        "desc_operac",
        "cd_grupo_operac",
        "cd_grupo_parada",
        "fg_tipo_operac",
        "cd_processo",
        "fg_ativo",
        "dt_updated",
    )
    rows = latest_source_row(base, ["cd_cliente", "cd_operacao"], "dt_updated")
    rows = enrich(
        rows,
        groups,
        {"cd_cliente": "cd_cliente", "cd_grupo_operac": "cd_grupo_operac"},
        {"g_text": "desc_grupo_operac", "g_time": "dt_updated"},
    )
    rows = enrich(
        rows,
        processes,
        {"cd_cliente": "cd_cliente", "cd_processo": "cd_processo"},
        {"p_text": "desc_processo", "p_time": "dt_updated"},
    )
    return rows.select(
        _number("cd_cliente").alias("id_cliente"),
        _number("cd_operacao").alias("cd_operacao"),
        _cut(F.col("desc_operac"), 1000).alias("desc_operacao"),
        # Codes stay as they are, even without a lookup row.
        _or_unknown("cd_grupo_operac").alias("cd_grupo_operacao"),
        _or_undefined("g_text").alias("desc_grupo_operacao"),
        _or_unknown("cd_grupo_parada").alias("cd_grupo_parada"),
        _or_unknown("cd_processo").alias("cd_processo"),
        _or_undefined("p_text").alias("desc_processo"),
        _cut(F.col("fg_tipo_operac"), 1000).alias("fg_tipo_operacao"),
        "fg_ativo",
        latest_time("dt_updated", "g_time", "p_time").alias("source_updated_at"),
    )


def farm_view(plots: DataFrame, producers: DataFrame) -> DataFrame:
    base = plots.select(
        "cd_cliente",
        "cd_fazenda",
        "desc_fazenda",
        "cd_talhao",
        "desc_talhao",
        "cd_zona",
        "area_metro",
        "cd_produtor",
        "active",
        "dt_updated",
    )
    key = ["cd_cliente", "cd_fazenda", "cd_zona", "cd_talhao"]
    rows = enrich(
        latest_source_row(base, key, "dt_updated"),
        producers,
        {"cd_cliente": "cd_cliente", "cd_produtor": "cd_produtor"},
        {"r_name": "desc_nome", "r_time": "dt_updated"},
    )
    return rows.select(
        _number("cd_cliente").alias("id_cliente"),
        *[_cut(F.col(c), 20).alias(c) for c in ("cd_fazenda", "cd_talhao", "cd_zona")],
        *[_cut(F.col(c), 255).alias(c) for c in ("desc_fazenda", "desc_talhao")],
        F.col("area_metro").cast("decimal(38,8)").alias("area_total"),
        _number("cd_produtor").alias("cd_produtor"),
        _cut(F.col("r_name"), 255).alias("desc_produtor"),
        F.col("active").alias("fg_ativo"),
        latest_time("dt_updated", "r_time").alias("source_updated_at"),
    )


def front_view(
    units: DataFrame,
    groups: DataFrame,
    regions: DataFrame,
    corporates: DataFrame,
    same_client: bool = True,
) -> DataFrame:
    """Units combined with equipment groups, under their region and corporate.

    With ``same_client`` a unit meets the groups of its own client; without it, the
    groups of every client.
    """
    unit_rows = latest_source_row(
        units.select(
            "cd_cliente",
            "cd_unidade",
            "cd_regional",
            "desc_unidade",
            "fg_ativo",
            F.col("dt_updated").alias("u_time"),
        ),
        ["cd_cliente", "cd_unidade", "cd_regional"],
        "u_time",
    )
    group_rows = latest_source_row(
        groups.select(
            F.col("cd_cliente").alias("g_client"),
            F.col("cd_grupo_equipamento").alias("g_code"),
            F.col("desc_grupo_equipamento").alias("g_text"),
            F.col("dt_updated").alias("g_time"),
        ),
        ["g_client", "g_code"],
        "g_time",
    )
    region_rows = latest_source_row(
        regions.select(
            F.col("cd_cliente").alias("r_client"),
            F.col("cd_regional").alias("r_code"),
            F.col("cd_corporativo").alias("r_corporate"),
            F.col("desc_regional").alias("r_text"),
            F.col("dt_updated").alias("r_time"),
        ),
        ["r_client", "r_code", "r_corporate"],
        "r_time",
    )
    # The lookup is unique with the corporate code but joined without it, so a region
    # code that two corporates share gives one row for each.
    placed = unit_rows.join(
        region_rows,
        (F.col("cd_cliente") == F.col("r_client")) & (F.col("cd_regional") == F.col("r_code")),
        "left",
    )
    placed = enrich(
        placed,
        corporates,
        {"r_client": "cd_cliente", "r_corporate": "cd_corporativo"},
        {"c_code": "cd_corporativo", "c_text": "desc_corporativo", "c_time": "dt_updated"},
    )
    meeting = F.col("cd_cliente") if same_client else F.lit(0)
    own = F.col("g_client") if same_client else F.lit(0)
    rows = product_within(
        placed.withColumn("__meet", meeting),
        group_rows.withColumn("__meet", own),
        ["__meet"],
        ["cd_unidade", "cd_regional", "r_corporate"],
    )
    return rows.select(
        _number("cd_cliente").alias("id_cliente"),
        _number("c_code").alias("cd_corporativo"),
        _number("r_code").alias("cd_regional"),
        _number("cd_unidade").alias("cd_unidade"),
        _number("g_code").alias("cd_frente"),
        _cut(F.col("c_text"), 1000).alias("desc_corporativo"),
        _cut(F.col("r_text"), 1000).alias("desc_regional"),
        _cut(F.col("desc_unidade"), 1000).alias("desc_unidade"),
        _cut(F.col("g_text"), 1000).alias("desc_frente"),
        "fg_ativo",
        latest_time("u_time", "g_time", "r_time", "c_time").alias("source_updated_at"),
    )
