"""Chain views over the test tables: blocks with forks of depth two, their logs, a journal and its redelivery.

``VIEWS`` is Spark SQL; ``cte`` gives the same views as common table expressions for DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BLOCKS = """
SELECT o_orderkey AS height, sha2('c:' || CAST(o_orderkey AS STRING), 256) AS block_hash,
       CASE WHEN o_orderkey = 0 THEN sha2('genesis', 256) ELSE sha2('c:' || CAST(o_orderkey - 1 AS STRING), 256) END AS parent_hash,
       o_orderdate AS ts, true AS is_canonical, 'unsafe' AS status, 'observed' AS status_source FROM orders
UNION ALL
SELECT o_orderkey, sha2('o:' || CAST(o_orderkey AS STRING), 256),
       CASE WHEN o_orderkey % 97 = 95 THEN sha2('c:' || CAST(o_orderkey - 1 AS STRING), 256) ELSE sha2('o:' || CAST(o_orderkey - 1 AS STRING), 256) END,
       o_orderdate, false, 'unsafe', 'observed' FROM orders WHERE o_orderkey % 97 IN (95, 96)
"""
LOGS = """
WITH n AS (SELECT *, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) - 1 AS INT) AS log_index FROM lineitem),
b AS (SELECT 'c:' AS br, n.* FROM n UNION ALL SELECT 'o:', n.* FROM n WHERE l_orderkey % 97 IN (95, 96) AND l_linenumber <= 2)
SELECT l_orderkey AS block_number, sha2(br || CAST(l_orderkey AS STRING), 256) AS block_hash, CAST(l_linenumber - 1 AS INT) AS transaction_index, log_index,
       sha2('x:' || br || CAST(l_orderkey AS STRING) || ':' || CAST(l_linenumber AS STRING), 256) AS tx_hash,
       substr(sha2('a:' || CAST(l_suppkey AS STRING), 256), 1, 40) AS address, sha2('t:' || l_returnflag, 256) AS topic0,
       sha2('p:' || CAST(l_partkey AS STRING), 256) AS topic1, lpad(lower(hex(CAST(round(l_quantity * 100) AS BIGINT))), 64, '0') AS data FROM b
"""
#: LOGS in two steps: places and numbers, and the texts made of them.
LOG_ROWS = """
SELECT l_orderkey AS block_number, br, CAST(l_linenumber - 1 AS INT) AS transaction_index, log_index, l_partkey, l_suppkey, l_quantity, l_returnflag
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) - 1 AS INT) AS log_index FROM {lineitem})
LATERAL VIEW explode(CASE WHEN l_orderkey % 97 IN (95, 96) AND l_linenumber <= 2 THEN array('c:', 'o:') ELSE array('c:') END) AS br
"""
BLOCK_HASH = "sha2(br || CAST(block_number AS STRING), 256) AS block_hash"
LOG_TEXTS = (
    "block_number", BLOCK_HASH, "transaction_index", "log_index", "sha2('x:' || br || CAST(block_number AS STRING) || ':' || CAST(transaction_index + 1 AS STRING), 256) AS tx_hash",
    "substr(sha2('a:' || CAST(l_suppkey AS STRING), 256), 1, 40) AS address", "sha2('t:' || l_returnflag, 256) AS topic0", "sha2('p:' || CAST(l_partkey AS STRING), 256) AS topic1",
    "lpad(lower(hex(CAST(round(l_quantity * 100) AS BIGINT))), 64, '0') AS data",
)
OUTBOX = """
SELECT event_id, CASE WHEN event_type = 'error' THEN 'rollback' ELSE 'apply' END AS event_kind, user_id AS block_height,
       ts AS created_at, CASE WHEN event_id % 10 <> 0 THEN ts END AS published_at, props AS payload FROM events
"""
DELIVERIES = """
SELECT event_id, event_kind, block_height, 1 AS attempt FROM outbox_fx
UNION ALL SELECT event_id, event_kind, block_height, 2 FROM outbox_fx WHERE event_id % 7 = 0
"""
VIEWS = {"blocks_fx": BLOCKS, "logs_fx": LOGS, "outbox_fx": OUTBOX, "deliveries_fx": DELIVERIES}


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(BLOCKS.replace(" FROM orders", " FROM {orders}"), orders=_read(spark, sf_dir, "orders"))


def log_rows(spark: SparkSession, sf_dir: str, even: bool = False) -> DataFrame:
    """The rows of ``LOGS`` by their numbers, before their texts, which take ten times the room; partitioned by height.

    The table is shuffled once for both branches.  With ``even`` the partitions are as many as set: merged by their size here, they would be too large
    where texts are sorted.
    """
    rows = _read(spark, sf_dir, "lineitem")
    if even:
        rows = rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "l_orderkey")
    return spark.sql(LOG_ROWS, lineitem=rows)


def with_texts(rows: DataFrame) -> DataFrame:
    """``log_rows`` with the columns of ``LOGS``."""
    return rows.selectExpr(*LOG_TEXTS)


def logs(spark: SparkSession, sf_dir: str, even: bool = False) -> DataFrame:
    return with_texts(log_rows(spark, sf_dir, even))


def outbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(OUTBOX.replace(" FROM events", " FROM {events}"), events=_read(spark, sf_dir, "events"))


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(DELIVERIES.replace("FROM outbox_fx", "FROM {outbox}"), outbox=outbox(spark, sf_dir))


def cte(*names: str) -> str:
    """WITH clause of the named views (deliveries_fx needs outbox_fx before it) in DuckDB's dialect."""
    import re

    def dialect(sql: str) -> str:
        sql = re.sub(r"sha2\((.*?), 256\)", r"sha256(\1)", sql)
        return sql.replace("AS STRING", "AS VARCHAR").replace("hex(CAST", "to_hex(CAST")

    return "WITH " + ",\n".join(f"{n} AS ({dialect(VIEWS[n])})" for n in names)
