"""Facts: surrogate keys of all dimensions, stored by closing day."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tidemark.entities import OPERATION_DETAILS_GRAIN
from tidemark.operators.checks import unique_combination_of_columns
from tidemark.plans.dimension import resolve_keys
from tidemark.sources.tables import AppendTable

# Fact columns of operation details -> natural key of each dimension.
OPERATION_DETAILS_KEYS = {
    "sk_estado": {"cd_estado": "cd_estado"},
    "sk_equipamento": {"id_cliente": "id_cliente", "cd_equipamento": "cd_equipamento"},
    "sk_operacao": {"id_cliente": "id_cliente", "cd_operacao": "cd_operacao"},
    "sk_fazenda": {
        "id_cliente": "id_cliente",
        "cd_fazenda": "cd_fazenda",
        "cd_talhao": "cd_talhao",
        "cd_zona": "cd_zona",
    },
    "sk_frente": {
        "id_cliente": "id_cliente",
        "cd_corporativo": "cd_corporativo",
        "cd_regional": "cd_regional",
        "cd_unidade": "cd_unidade",
        "cd_grupo_equipamento": "cd_frente",
    },
}


def resolve_star(
    facts: DataFrame, dimensions: Mapping[str, tuple[DataFrame, dict[str, str]]]
) -> DataFrame:
    """Add one surrogate key per dimension; a missing member gives -1.

    ``dimensions`` maps a surrogate key to its dimension and to the fact columns of its
    natural key.
    """
    for surrogate_key, (dimension, natural_key) in dimensions.items():
        facts = resolve_keys(facts, dimension, natural_key, surrogate_key)
    return facts


def resolve_operation_details(facts: DataFrame, dimensions: Mapping[str, DataFrame]) -> DataFrame:
    """Operation details with the keys of the given dimensions, named by surrogate key."""
    return resolve_star(
        facts, {sk: (df, OPERATION_DETAILS_KEYS[sk]) for sk, df in dimensions.items()}
    )


def repeated_grain(facts: DataFrame) -> DataFrame:
    """Grain values that occur more than once."""
    return unique_combination_of_columns(facts, OPERATION_DETAILS_GRAIN)


def fact_table(spark: SparkSession, root: str) -> AppendTable:
    """Stored operation details, one folder per closing day."""
    return AppendTable(spark, root, "dt_dia_fechamento")
