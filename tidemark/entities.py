"""The warehouse entities: six dimensions, one fact grain, one work-order table.

Column names, types, lengths and unknown-member values are fixed values of the data
contract.
"""

from __future__ import annotations

from dataclasses import replace

from tidemark.spec import UNDEFINED, UNKNOWN_KEY, Column, EntitySpec, struct_type

NUMBER = "decimal(38,0)"
AREA = "decimal(38,8)"


def _code(name: str, unknown: int = UNKNOWN_KEY) -> Column:
    return Column(name, NUMBER, unknown=unknown)


def _text_code(name: str, length: int = 20) -> Column:
    return Column(name, length=length, unknown=str(UNKNOWN_KEY))


def _text(name: str, upper: bool = True) -> Column:
    return Column(name, upper=upper, unknown=UNDEFINED)


def _active(silent: bool = False) -> Column:
    return Column("fg_ativo", "boolean", unknown=False, silent=silent)


CLIENT = EntitySpec(
    name="sx_cliente_d",
    key=("id_cliente",),
    columns=(
        Column("id_cliente", NUMBER),
        Column("nome_cliente", upper=True),
        Column("owner_cliente", upper=True),
        Column("server_cliente", upper=True),
        Column("fg_ativo", "boolean"),
    ),
    full_extract=True,
    dropped_keys=(UNKNOWN_KEY,),
)

STATE = EntitySpec(
    name="sx_estado_d",
    key=("cd_estado",),
    surrogate_key="sk_estado",
    columns=(
        _text_code("cd_estado", 50),
        _text("desc_estado"),
        _text("desc_estado_en_us"),
        _text("desc_estado_pt_br"),
        _text("desc_estado_es_es"),
    ),
)

EQUIPMENT = EntitySpec(
    name="sx_equipamento_d",
    key=("id_cliente", "cd_equipamento"),
    surrogate_key="sk_equipamento",
    columns=(
        _code("id_cliente"),
        _text_code("cd_equipamento"),
        _text("desc_equipamento"),
        _code("cd_modelo_equipamento"),
        _text("desc_modelo_equipamento"),
        _code("cd_tipo_equipamento"),
        _text("desc_tipo_equipamento"),
        _text("desc_status", upper=False),
        _code("tp_uso_equipamento"),
        _active(),
    ),
)

OPERATION = EntitySpec(
    name="sx_operacao_d",
    key=("id_cliente", "cd_operacao"),
    surrogate_key="sk_operacao",
    columns=(
        _code("id_cliente"),
        _code("cd_operacao"),
        _text("desc_operacao"),
        _code("cd_grupo_operacao"),
        _text("desc_grupo_operacao"),
        _code("cd_grupo_parada"),
        _text("fg_tipo_operacao", upper=False),
        _code("cd_processo"),
        _text("desc_processo"),
        _active(),
    ),
)

FARM = EntitySpec(
    name="sx_fazenda_d",
    key=("id_cliente", "cd_fazenda", "cd_talhao", "cd_zona"),
    surrogate_key="sk_fazenda",
    columns=(
        _code("id_cliente"),
        _text_code("cd_fazenda"),
        _text("desc_fazenda"),
        _text_code("cd_talhao"),
        _text("desc_talhao"),
        _text_code("cd_zona"),
        # The source view calls the area by another name.
        Column("area_metro", AREA, source="area_total", unknown=-999),
        _code("cd_produtor", unknown=-999),
        _text("desc_produtor"),
        _active(),
    ),
)

FRONT = EntitySpec(
    name="sx_frente_d",
    key=("id_cliente", "cd_corporativo", "cd_regional", "cd_unidade", "cd_frente"),
    surrogate_key="sk_frente",
    columns=(
        _code("id_cliente"),
        _code("cd_corporativo"),
        _code("cd_regional"),
        _code("cd_unidade"),
        _code("cd_frente"),
        _text("desc_corporativo"),
        _text("desc_regional"),
        _text("desc_unidade"),
        _text("desc_frente"),
        _active(),
    ),
)

DIMENSIONS = (CLIENT, STATE, EQUIPMENT, OPERATION, FARM, FRONT)


def with_silent_flag(spec: EntitySpec) -> EntitySpec:
    """The variant in which a change of the active flag alone keeps the update time."""
    return replace(
        spec,
        columns=tuple(_active(silent=True) if c.name == "fg_ativo" else c for c in spec.columns),
    )


OPERATION_DETAILS_GRAIN = (
    "id_cliente",
    "dt_dia_fechamento",
    "data",
    "hora",
    "cd_equipamento",
    "cd_grupo_equipamento",
    "cd_operacao",
    "cd_operacao_cb",
    "cd_ordem_servico",
    "cd_unidade",
    "cd_regional",
    "cd_corporativo",
    "cd_fazenda",
    "cd_zona",
    "cd_talhao",
    "cd_missao",
    "cd_estado",
)
_GRAIN_TYPES = {"dt_dia_fechamento": "date", "data": "date", "cd_estado": "string"}
_LOAD_COLUMNS = {
    "etl_batch_id": "string",
    "bi_created_at": "timestamp_ntz",
    "bi_updated_at": "timestamp_ntz",
}
OPERATION_DETAILS_SCHEMA = struct_type(
    {c: _GRAIN_TYPES.get(c, NUMBER) for c in OPERATION_DETAILS_GRAIN}
    | {
        "vl_tempo_segundos": "decimal(38,6)",
        "vl_velocidade_media": "decimal(38,6)",
        "vl_area_operacional_m2": "decimal(38,6)",
        "fg_status": "string",
    }
    | _LOAD_COLUMNS
)

WORK_ORDER_KEY = ("id_cliente", "cd_ordem_servico")
WORK_ORDER_SCHEMA = struct_type(
    {
        "id_cliente": NUMBER,
        "cd_ordem_servico": NUMBER,
        "cd_ord_status": NUMBER,
        "dt_criado_em": "timestamp_ntz",
        "dt_abertura": "timestamp_ntz",
        "dt_encerramento": "timestamp_ntz",
        "dt_inicio_exec": "timestamp_ntz",
        "dt_termino_exec": "timestamp_ntz",
        "dt_inicio_plan_exec": "timestamp_ntz",
        "dt_termino_plan_exec": "timestamp_ntz",
        "desc_os": "string",
        "desc_ord_status": "string",
        "vl_latitude": "decimal(23,15)",
        "vl_longitude": "decimal(23,15)",
        "fg_origem": "string",
        "fg_status": NUMBER,
        "vl_ordem_servico": "string",
        "ticket_number": NUMBER,
        "fg_ativo": "decimal(1,0)",
    }
    | _LOAD_COLUMNS
)
