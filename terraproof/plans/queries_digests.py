"""Queries of canonical keys and digests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraproof.functions import rules
from terraproof.functions.canonical import canonical_key, rows_digest
from terraproof.operators import evidence
from terraproof.plans.registry import query
from terraproof.sources.adapters import view, view_sql, with_views

# a nested value with its fields out of order, a map, and a list of structs
_NESTED = """'{"box":{"east":' || o_orderkey || ',"west":' || o_custkey || '},"parts":[{"a":' || (o_orderkey % 7) || ',"z":"' || o_orderstatus || '"}]' || CASE WHEN o_custkey % 3 = 0 THEN '' ELSE ',"status":"' || o_orderpriority || '"' END || ',"tags":{"b":"' || o_orderstatus || '","y":"1"}}'"""


@query("SELECT o_orderkey AS id, 'nested-' || sha256('nested' || chr(0) || " + _NESTED.replace(""",'"parts'""", "") + ") AS content_key FROM orders")
def canonical_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    made = o.select(
        F.col("o_orderkey").alias("id"),
        F.create_map(F.lit("y"), F.lit("1"), F.lit("b"), "o_orderstatus").alias("tags"),
        F.when(F.col("o_custkey") % 3 != 0, F.col("o_orderpriority")).alias("status"),
        F.array(F.struct(F.col("o_orderstatus").alias("z"), (F.col("o_orderkey") % 7).alias("a"))).alias("parts"),
        F.struct(F.col("o_custkey").alias("west"), F.col("o_orderkey").alias("east")).alias("box"),
    )
    return made.select("id", canonical_key(made, "nested", "tags", "status", "parts", "box").alias("content_key"))


_ROW = """'{"a":' || CAST(event_id AS VARCHAR) || ',"b":"' || event_type || '"}'"""


@query(f"""WITH h AS (SELECT user_id % 5 AS part, sha256({_ROW}) AS h FROM events), e AS (SELECT part, h, count(*) AS c FROM h GROUP BY ALL),
p AS (SELECT part, substring(h, 1, 4) AS p4, sum(c) AS c, sha256(string_agg(h || ':' || c, ',' ORDER BY h || ':' || c)) AS d FROM e GROUP BY ALL)
SELECT part, CAST(sum(c) AS BIGINT) AS n, sha256(string_agg(d, ',' ORDER BY p4)) AS digest FROM p GROUP BY part""")
def events_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").select((F.col("user_id") % 5).alias("part"), F.col("event_type").alias("b"), F.col("event_id").alias("a"))
    return rows_digest(rows.repartition("a"), "part", columns=("b", "a"))


_GOOD = "source = 'Planning' AND authority AND NOT renderable AND feature_class IN (" + ", ".join(f"'{c}'" for c in (*rules.BRIDGE_CLASSES, *rules.BRIDGE_WITHHELD)) + ")"


@query(f"""WITH b AS ({view_sql('bridge_input')}), g AS (SELECT * FROM b WHERE {_GOOD}),
c AS (SELECT feature_class, count(*) AS i, count(*) FILTER (feature_class IN ({', '.join(f"'{c}'" for c in rules.BRIDGE_CLASSES)})) AS o FROM g GROUP BY 1)
SELECT 1 AS schema_version, CAST(sum(i) AS BIGINT) AS input, CAST(sum(o) AS BIGINT) AS passed, CAST(sum(i - o) AS BIGINT) AS withheld,
string_agg(feature_class || '=' || i, ',' ORDER BY feature_class) AS input_by_class, string_agg(feature_class || '=' || o, ',' ORDER BY feature_class) FILTER (o > 0) AS passed_by_class FROM c""")
def bridge_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = evidence.bridge_report(view(spark, sf_dir, "bridge_input").filter(_GOOD))
    text = lambda c: F.array_join(F.transform(F.map_entries(c), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ",").alias(c)
    return found.select("schema_version", "input", "passed", "withheld", text("input_by_class"), text("passed_by_class"))
