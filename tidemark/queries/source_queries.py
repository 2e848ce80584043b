"""Curated source views and extraction, over inputs derived from the benchmark tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import three_state
from tidemark.operators.lookups import enrich, latest_time
from tidemark.plans.monitor import active_keys
from tidemark.queries.registry import RUN_1, Tables, query
from tidemark.sources import views
from tidemark.session import work_folder
from tidemark.sources.readers import changed_since, pruned, read_seed


def _bigints(df: DataFrame, *names: str) -> DataFrame:
    """Numeric codes as bigint, for comparison with SQL."""
    return df.withColumns({n: F.col(n).cast("bigint") for n in names})


CLIENT_VIEW_SQL = """
SELECT c_custkey AS id_cliente, upper(c_name) AS nome_cliente, upper(c_mktsegment) AS owner_cliente,
  upper('host-' || c_nationkey) AS server_cliente, c_acctbal > 0 AS fg_ativo, TIMESTAMP '1900-01-01' AS source_updated_at
FROM customer"""


@query("source_client_view", CLIENT_VIEW_SQL)
def source_client_view(t: Tables) -> DataFrame:
    """The input holds every client twice; one row each comes out."""
    clients = t.customer.select(
        F.col("c_custkey").alias("cd_id"),
        F.col("c_name").alias("nome"),
        F.col("c_mktsegment").alias("owner"),
        F.concat(F.lit("host-"), "c_nationkey").alias("server"),
        (F.col("c_acctbal") > 0).alias("fg_ativo"),
    )
    return _bigints(views.client_view(clients.unionByName(clients)), "id_cliente")


STATE_VIEW_SQL = """
WITH base AS (SELECT user_id, event_type, ts, value, 'U' || user_id AS cd_estado, event_type AS desc_estado,
  CASE WHEN value < 5 THEN NULL WHEN value < 30 THEN '{"en-us": "' || event_type || '", "pt-br": "t' || user_id || '"}'
    ELSE '{"es-es": "v-' || event_type || '"}' END AS estado_json,
  CASE WHEN value < 1 THEN NULL ELSE ts END AS dt_updated FROM events)
SELECT cd_estado, desc_estado, upper(estado_json->>'en-us') AS desc_estado_en_us, upper(estado_json->>'pt-br') AS desc_estado_pt_br,
  upper(estado_json->>'es-es') AS desc_estado_es_es, coalesce(dt_updated, TIMESTAMP '1900-01-01') AS source_updated_at
FROM base QUALIFY row_number() OVER (PARTITION BY cd_estado ORDER BY dt_updated DESC NULLS LAST, desc_estado DESC, estado_json DESC NULLS LAST) = 1"""


@query("source_state_view", STATE_VIEW_SQL)
def source_state_view(t: Tables) -> DataFrame:
    kind, v = F.col("event_type"), F.col("value")
    both = F.concat(F.lit('{"en-us": "'), kind, F.lit('", "pt-br": "t'), "user_id", F.lit('"}'))
    one = F.concat(F.lit('{"es-es": "v-'), kind, F.lit('"}'))
    states = t.events.select(
        F.concat(F.lit("U"), "user_id").alias("cd_estado"),
        kind.alias("desc_estado"),
        F.when(v < 30, F.when(v >= 5, both)).otherwise(one).alias("estado_json"),
        F.when(v >= 1, F.col("ts")).alias("dt_updated"),
    )
    return views.state_view(states)


_LINES = """
  SELECT l.*, p.* FROM lineitem l JOIN part p ON l_partkey = p_partkey"""


EQUIPMENT_VIEW_SQL = f"""
WITH lines AS ({_LINES}),
e AS (SELECT l_suppkey, l_partkey, p_name, p_size, 100 + p_size AS tp, l_linenumber, l_returnflag <> 'R' AS fg, l_shipdate
  FROM lines WHERE p_size IN (1, 3, 4, 5, 6, 7, 8, 20, 21, 22)
  QUALIFY row_number() OVER (PARTITION BY l_suppkey, l_partkey ORDER BY l_shipdate DESC, p_name DESC, p_size DESC, l_linenumber DESC, l_returnflag <> 'R' DESC) = 1),
m AS (SELECT l_suppkey, p_size, p_brand, l_shipdate FROM lines WHERE p_size > 4
  QUALIFY row_number() OVER (PARTITION BY l_suppkey, p_size ORDER BY l_shipdate DESC, p_brand DESC) = 1),
ty AS (SELECT l_suppkey, 100 + p_size AS tp, p_type, l_shipdate FROM lines WHERE l_quantity > 20
  QUALIFY row_number() OVER (PARTITION BY l_suppkey, p_size ORDER BY l_shipdate DESC, p_type DESC) = 1),
st AS (SELECT l_suppkey, l_partkey, CASE WHEN l_linestatus = 'F' THEN true WHEN l_tax > 0.02 THEN false END AS active, l_shipdate
  FROM lines WHERE l_discount > 0.03
  QUALIFY row_number() OVER (PARTITION BY l_suppkey, l_partkey ORDER BY l_shipdate DESC,
    CASE WHEN l_linestatus = 'F' THEN true WHEN l_tax > 0.02 THEN false END DESC NULLS LAST) = 1)
SELECT e.l_suppkey AS id_cliente, CAST(e.l_partkey AS VARCHAR) AS cd_equipamento, e.p_name AS desc_equipamento,
  CAST(coalesce(m.p_size, -1) AS BIGINT) AS cd_modelo_equipamento, coalesce(m.p_brand, 'UNDEFINED') AS desc_modelo_equipamento,
  CAST(coalesce(ty.tp, -1) AS BIGINT) AS cd_tipo_equipamento, coalesce(ty.p_type, 'UNDEFINED') AS desc_tipo_equipamento,
  CASE WHEN active = false THEN 'I' WHEN active = true THEN 'A' ELSE 'UNDEFINED' END AS desc_status,
  CAST(coalesce(nullif(l_linenumber, 1), -1) AS BIGINT) AS tp_uso_equipamento, fg AS fg_ativo,
  greatest(e.l_shipdate, coalesce(m.l_shipdate, TIMESTAMP '1900-01-01'), coalesce(ty.l_shipdate, TIMESTAMP '1900-01-01'), coalesce(st.l_shipdate, TIMESTAMP '1900-01-01')) AS source_updated_at
FROM e LEFT JOIN m ON e.l_suppkey = m.l_suppkey AND e.p_size = m.p_size
LEFT JOIN ty ON e.l_suppkey = ty.l_suppkey AND e.tp = ty.tp
LEFT JOIN st ON e.l_suppkey = st.l_suppkey AND e.l_partkey = st.l_partkey"""


@query("source_equipment_view", EQUIPMENT_VIEW_SQL)
def source_equipment_view(t: Tables) -> DataFrame:
    lines = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    client, shipped = F.col("l_suppkey").alias("cd_cliente"), F.col("l_shipdate").alias("dt_updated")
    kind = F.col("p_size") + 100
    equipment = lines.select(
        client,
        F.col("l_partkey").alias("cd_equipamento"),
        F.col("p_name").alias("desc_equipamento"),
        F.col("p_size").alias("cd_modelo_equipamento"),
        kind.alias("cd_tp_equipamento"),
        F.nullif("l_linenumber", F.lit(1)).alias("tp_uso_equipamento"),
        (F.col("l_returnflag") != "R").alias("fg_ativo"),
        shipped,
    )
    models = lines.filter("p_size > 4").select(
        client, F.col("p_size").alias("cd_modelo_equipamento"),
        F.col("p_brand").alias("desc_modelo_equipamento"), shipped,
    )
    types = lines.filter("l_quantity > 20").select(
        client, kind.alias("cd_tp_equipamento"), F.col("p_type").alias("desc_tp_equipamento"), shipped
    )
    active = F.when(F.col("l_linestatus") == "F", True).when(F.col("l_tax") > 0.02, False)
    movements = lines.filter("l_discount > 0.03").select(
        client,
        F.col("l_partkey").alias("cd_equipamento"),
        active.alias("fg_ativo"),
        F.col("l_shipdate").alias("dt_hr_utc_movimento"),
        F.lit(None).cast("timestamp_ntz").alias("dt_updated"),
    )
    return _bigints(
        views.equipment_view(equipment, models, types, movements),
        "id_cliente", "cd_modelo_equipamento", "cd_tipo_equipamento", "tp_uso_equipamento",
    )


OPERATION_VIEW_SQL = """
WITH o AS (SELECT o_custkey, o_orderkey, o_orderpriority, CAST(o_custkey AS BIGINT) AS grp, nullif(o_orderstatus, 'P') AS st, length(o_orderpriority) AS pr, o_orderdate, o_totalprice > 100000 AS fg FROM orders),
g AS (SELECT c_custkey AS grp, c_name, TIMESTAMP '1996-01-01' + to_days(c_nationkey) AS at FROM customer WHERE c_acctbal > 0),
p AS (SELECT o_custkey, length(o_orderpriority) AS pr, o_orderpriority AS txt, o_orderdate AS at FROM orders WHERE o_orderstatus = 'F'
  QUALIFY row_number() OVER (PARTITION BY o_custkey, length(o_orderpriority) ORDER BY o_orderdate DESC, o_orderpriority DESC) = 1)
SELECT o.o_custkey AS id_cliente, o_orderkey AS cd_operacao, o_orderpriority AS desc_operacao, coalesce(o.grp, -1) AS cd_grupo_operacao,
  coalesce(g.c_name, 'UNDEFINED') AS desc_grupo_operacao, CAST(-1 AS BIGINT) AS cd_grupo_parada, o.pr AS cd_processo,
  coalesce(p.txt, 'UNDEFINED') AS desc_processo, st AS fg_tipo_operacao, fg AS fg_ativo,
  greatest(o_orderdate, coalesce(g.at, TIMESTAMP '1900-01-01'), coalesce(p.at, TIMESTAMP '1900-01-01')) AS source_updated_at
FROM o LEFT JOIN g ON o.grp = g.grp LEFT JOIN p ON o.o_custkey = p.o_custkey AND o.pr = p.pr"""


@query("source_operation_view", OPERATION_VIEW_SQL)
def source_operation_view(t: Tables) -> DataFrame:
    client, ordered = F.col("o_custkey").alias("cd_cliente"), F.col("o_orderdate").alias("dt_updated")
    process = F.length("o_orderpriority").alias("cd_processo")
    operations = t.orders.select(
        client,
        F.col("o_orderkey").alias("cd_operacao"),
        F.col("o_orderpriority").alias("desc_operac"),
        F.col("o_custkey").alias("cd_grupo_operac"),
        F.lit(None).cast("bigint").alias("cd_grupo_parada"),
        F.nullif("o_orderstatus", F.lit("P")).alias("fg_tipo_operac"),
        process,
        (F.col("o_totalprice") > 100000).alias("fg_ativo"),
        ordered,
    )
    start = F.lit("1996-01-01").cast("timestamp_ntz")
    groups = t.customer.filter("c_acctbal > 0").select(
        F.col("c_custkey").alias("cd_cliente"),
        F.col("c_custkey").alias("cd_grupo_operac"),
        F.col("c_name").alias("desc_grupo_operac"),
        F.timestamp_add("DAY", F.col("c_nationkey"), start).alias("dt_updated"),
    )
    processes = t.orders.filter("o_orderstatus = 'F'").select(
        client, process, F.col("o_orderpriority").alias("desc_processo"), ordered
    )
    return _bigints(
        views.operation_view(operations, groups, processes),
        "id_cliente", "cd_operacao", "cd_grupo_operacao", "cd_grupo_parada", "cd_processo",
    )


FARM_VIEW_SQL = """
WITH base AS (SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_shipdate, l_linestatus, l_returnflag FROM lineitem),
f AS (SELECT *, CAST(l_orderkey AS VARCHAR) AS farm, CAST(l_linenumber AS VARCHAR) AS plot, l_returnflag AS zone FROM base
  QUALIFY row_number() OVER (PARTITION BY l_suppkey, l_orderkey, l_returnflag, l_linenumber ORDER BY l_shipdate DESC, CAST(l_extendedprice AS DECIMAL(18,2)) DESC, l_partkey DESC, l_linestatus DESC) = 1),
pr AS (SELECT s_suppkey, s_name FROM supplier WHERE s_acctbal > 0)
SELECT f.l_suppkey AS id_cliente, farm AS cd_fazenda, plot AS cd_talhao, zone AS cd_zona, 'farm ' || farm AS desc_fazenda,
  'plot ' || plot AS desc_talhao, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS area_total, f.l_suppkey AS cd_produtor, pr.s_name AS desc_produtor,
  l_linestatus = 'O' AS fg_ativo, CASE WHEN pr.s_suppkey IS NULL THEN l_shipdate ELSE greatest(l_shipdate, TIMESTAMP '1998-06-01') END AS source_updated_at
FROM f LEFT JOIN pr ON f.l_suppkey = pr.s_suppkey"""


@query("source_farm_view", FARM_VIEW_SQL)
def source_farm_view(t: Tables) -> DataFrame:
    plots = t.lineitem.select(
        F.col("l_suppkey").alias("cd_cliente"),
        F.col("l_orderkey").cast("string").alias("cd_fazenda"),
        F.concat(F.lit("farm "), "l_orderkey").alias("desc_fazenda"),
        F.col("l_linenumber").cast("string").alias("cd_talhao"),
        F.concat(F.lit("plot "), "l_linenumber").alias("desc_talhao"),
        F.col("l_returnflag").alias("cd_zona"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("area_metro"),
        F.col("l_suppkey").alias("cd_produtor"),
        (F.col("l_linestatus") == "O").alias("active"),
        F.col("l_shipdate").alias("dt_updated"),
    )
    producers = t.supplier.filter("s_acctbal > 0").select(
        F.col("s_suppkey").alias("cd_cliente"),
        F.col("s_suppkey").alias("cd_produtor"),
        F.col("s_name").alias("desc_nome"),
        F.lit("1998-06-01").cast("timestamp_ntz").alias("dt_updated"),
    )
    found = _bigints(views.farm_view(plots, producers), "id_cliente", "cd_produtor")
    return found.withColumn("area_total", F.col("area_total").cast("double"))


FRONT_VIEW_SQL = """
WITH g AS (SELECT c_nationkey AS client, length(c_mktsegment) AS code, max(c_mktsegment) AS txt FROM customer GROUP BY 1, 2),
r AS (SELECT n_nationkey AS client, n_regionkey AS code, n_regionkey + 100 AS corp, n_name AS txt FROM nation WHERE n_regionkey <> 2),
c AS (SELECT n_nationkey AS client, n_regionkey + 100 AS corp, 'C-' || n_name AS txt FROM nation WHERE n_regionkey <> 3)
SELECT CAST(u.c_nationkey AS BIGINT) AS id_cliente, CAST(c.corp AS BIGINT) AS cd_corporativo, CAST(r.code AS BIGINT) AS cd_regional, u.c_custkey AS cd_unidade,
  g.code AS cd_frente, c.txt AS desc_corporativo, r.txt AS desc_regional, u.c_name AS desc_unidade, g.txt AS desc_frente, c_acctbal > 0 AS fg_ativo,
  TIMESTAMP '2024-01-15' AS source_updated_at
FROM customer u JOIN nation n ON u.c_nationkey = n.n_nationkey JOIN g ON u.c_nationkey = g.client
LEFT JOIN r ON r.client = u.c_nationkey AND r.code = n.n_regionkey
LEFT JOIN c ON c.client = r.client AND c.corp = r.corp"""


@query("source_front_view", FRONT_VIEW_SQL)
def source_front_view(t: Tables) -> DataFrame:
    """Customers as units of their nation, with the nation's market segments as groups."""
    at = F.lit(RUN_1).cast("timestamp_ntz").alias("dt_updated")
    located = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    units = located.select(
        F.col("c_nationkey").alias("cd_cliente"),
        F.col("c_custkey").alias("cd_unidade"),
        F.col("n_regionkey").alias("cd_regional"),
        F.col("c_name").alias("desc_unidade"),
        (F.col("c_acctbal") > 0).alias("fg_ativo"),
        at,
    )
    groups = t.customer.select(
        F.col("c_nationkey").alias("cd_cliente"),
        F.length("c_mktsegment").alias("cd_grupo_equipamento"),
        F.col("c_mktsegment").alias("desc_grupo_equipamento"),
        at,
    )
    corporate = (F.col("n_regionkey") + 100).alias("cd_corporativo")
    regions = t.nation.filter("n_regionkey <> 2").select(
        F.col("n_nationkey").alias("cd_cliente"), F.col("n_regionkey").alias("cd_regional"),
        corporate, F.col("n_name").alias("desc_regional"), at,
    )
    corporates = t.nation.filter("n_regionkey <> 3").select(
        F.col("n_nationkey").alias("cd_cliente"), corporate,
        F.concat(F.lit("C-"), "n_name").alias("desc_corporativo"), at,
    )
    return _bigints(
        views.front_view(units, groups, regions, corporates),
        "id_cliente", "cd_corporativo", "cd_regional", "cd_unidade", "cd_frente",
    )


@query(
    "lookup_enrichment",
    """
WITH p AS (SELECT p_partkey, p_size, p_brand FROM part WHERE p_size > 10),
s AS (SELECT s_suppkey, s_name, s_nationkey FROM supplier)
SELECT l_orderkey, l_linenumber, coalesce(CAST(p.p_size AS BIGINT), -1) AS part_size, coalesce(p.p_brand, 'UNDEFINED') AS brand, s.s_name AS supplier_name,
  CASE WHEN l_returnflag = 'R' THEN 'I' WHEN l_returnflag = 'A' THEN 'A' ELSE 'UNDEFINED' END AS state,
  greatest(l_shipdate, coalesce(CASE WHEN p.p_partkey IS NOT NULL THEN TIMESTAMP '1996-06-01' END, TIMESTAMP '1900-01-01')) AS changed_at
FROM lineitem LEFT JOIN p ON l_partkey = p_partkey LEFT JOIN s ON l_suppkey = s_suppkey""",
)
def lookup_enrichment(t: Tables) -> DataFrame:
    at = F.lit("1996-06-01").cast("timestamp_ntz").alias("dt_updated")
    parts = t.part.filter("p_size > 10").withColumn("dt_updated", at)
    suppliers = t.supplier.withColumn("dt_updated", at)
    base = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_shipdate"
    )
    rows = enrich(
        base, parts, {"l_partkey": "p_partkey"},
        {"size_": "p_size", "brand_": "p_brand", "part_at": "dt_updated"},
    )
    rows = enrich(rows, suppliers, {"l_suppkey": "s_suppkey"}, {"supplier_name": "s_name"})
    flag = F.when(F.col("l_returnflag") == "R", False).when(F.col("l_returnflag") == "A", True)
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        F.coalesce(F.col("size_").cast("bigint"), F.lit(-1)).alias("part_size"),
        F.coalesce("brand_", F.lit("UNDEFINED")).alias("brand"),
        "supplier_name",
        three_state(flag).alias("state"),
        latest_time("l_shipdate", "part_at").alias("changed_at"),
    )


@query(
    "extract_by_cursor",
    "SELECT event_id, ts, value FROM events WHERE ts > TIMESTAMP '2024-01-15'",
)
def extract_by_cursor(t: Tables) -> DataFrame:
    """The cursor bound and the three columns reach the parquet scan."""
    return changed_since(pruned(t.events, ["event_id", "ts", "value"]), "ts", RUN_1)


@query(
    "seed_from_csv",
    """
SELECT o_orderkey, nullif(o_orderstatus, 'P') AS o_orderstatus, o_totalprice, o_orderdate,
  CASE WHEN o_totalprice >= 50000 THEN o_custkey END AS o_custkey, CAST(o_orderdate AS DATE) AS day FROM orders""",
)
def seed_from_csv(t: Tables) -> DataFrame:
    """Orders written as CSV files and read back with declared types; blanks are null."""
    path = work_folder(t.spark, "seed")
    t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("o_orderstatus"),
        "o_totalprice",
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("o_orderdate"),
        F.when(F.col("o_totalprice") >= 50000, F.col("o_custkey")).alias("o_custkey"),
        F.col("o_orderdate").cast("date").alias("day"),
    ).write.csv(path, header=True)
    return read_seed(
        t.spark,
        path,
        "o_orderkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz,"
        " o_custkey bigint, day date",
    )


@query(
    "active_keys",
    """SELECT DISTINCT l_suppkey FROM lineitem WHERE upper(l_returnflag) IN ('1', 'TRUE', 'T', 'ATIVO', 'A') ORDER BY 1""",
)
def active_supplier_keys(t: Tables) -> DataFrame:
    return active_keys(t.lineitem, "l_suppkey", "l_returnflag")
