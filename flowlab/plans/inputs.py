"""Inputs that Spark derives from the given tables: a dirty flow table and a scored table.

Both are projections of ``lineitem`` written once as SQL text, so that Spark and the checking
engine build the same rows; ``{S}`` is the engine's name for text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

FLOWS_SQL = """
SELECT concat_ws('-', CAST(l_orderkey AS {S}), CAST(l_linenumber AS {S}), CAST(l_partkey AS {S}),
                 CAST(l_suppkey AS {S}),
                 CAST(CAST(ROUND(l_extendedprice * 100) AS BIGINT) AS {S})) AS flow_id,
       CAST(l_quantity - 2 AS {S}) AS duration,
       CAST(l_partkey % 40 AS {S}) AS fwd_packets_count,
       CAST(l_suppkey % 5 AS {S}) AS bwd_packets_count,
       CASE WHEN l_suppkey % 97 = 0 THEN NULL
            ELSE CAST(l_extendedprice AS {S}) END AS fwd_total_payload_bytes,
       CAST(l_extendedprice * l_discount AS {S}) AS bwd_total_payload_bytes,
       CASE WHEN l_quantity = 2 THEN 'Infinity' WHEN l_quantity = 3 THEN 'NaN'
            ELSE CAST(l_extendedprice / (l_quantity + 1) AS {S}) END AS bytes_rate,
       CAST((l_partkey % 40) / CAST(l_quantity + 1 AS DOUBLE) AS {S}) AS packets_rate,
       CASE WHEN l_partkey % 499 = 0 THEN NULL ELSE CASE l_linenumber
            WHEN 1 THEN 'Benign' WHEN 2 THEN 'DoS_Hulk ' WHEN 3 THEN ' Port_Scan'
            WHEN 4 THEN 'Web_XSS' WHEN 5 THEN 'web_brute_force' WHEN 6 THEN 'Web_SQL_Injection'
            ELSE 'Heartbleed' END END AS label
FROM {lineitem}
"""

# model name -> how far an attack row's score is lifted: the larger, the better the model
SCORED_LIFTS = {"Model A - Lift 150": 150, "Model B - Lift 0": 0, "Model C - Lift 400": 400}

SCORED_SQL = """
SELECT model, flow_id, line_class, label, score,
       CASE WHEN score >= 575 THEN 1.0E0 ELSE 0.0E0 END AS prediction
FROM (SELECT model, flow_id, line_class, label,
             base + CAST(lift * label AS BIGINT) AS score
      FROM (SELECT concat_ws('-', CAST(l_orderkey AS {S}), CAST(l_linenumber AS {S}),
                             CAST(l_partkey AS {S}), CAST(l_suppkey AS {S}),
                             CAST(CAST(ROUND(l_extendedprice * 100) AS BIGINT) AS {S})) AS flow_id,
                   l_linestatus AS line_class,
                   CASE WHEN l_returnflag = 'R' THEN 1.0E0 ELSE 0.0E0 END AS label,
                   (l_partkey * 7 + l_suppkey * 13 + l_linenumber) % 1000 AS base
            FROM {lineitem}) rows_once
      {models}) lifted
"""

#: Rows of seven classes, of one that the class index has not seen and of none, with a shift between the
#: class and its prediction and a base for the scores.
CLASSED_SQL = """
SELECT concat_ws('-', CAST(l_orderkey AS {S}), CAST(l_linenumber AS {S}), CAST(l_partkey AS {S}),
                 CAST(l_suppkey AS {S}),
                 CAST(CAST(ROUND(l_extendedprice * 100) AS BIGINT) AS {S})) AS flow_id,
       CASE WHEN l_partkey % 89 = 0 THEN NULL WHEN l_partkey % 97 = 0 THEN 'Other'
            ELSE concat('Class ', CAST((l_linenumber * 3) % 7 AS {S})) END AS label_original,
       CASE WHEN l_partkey % 10 < 6 THEN 0 ELSE l_suppkey % 7 END AS shift,
       (l_partkey * 7 + l_suppkey * 13 + l_linenumber) % 1000 AS base
FROM {lineitem}
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dirty flow table: all text, with every kind of dirt that cleaning has a rule for."""
    sql = FLOWS_SQL.format(S="STRING", lineitem="{lineitem}")
    return spark.sql(sql, lineitem=table(spark, sf_dir, "lineitem"))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows scored by three made-up models, with integer scores so that results are exact."""
    pairs = ", ".join(f"'{name}', {lift}" for name, lift in SCORED_LIFTS.items())
    sql = SCORED_SQL.format(
        S="STRING",
        lineitem="{lineitem}",
        models=f"LATERAL VIEW explode(map({pairs})) lifts AS model, lift",
    )
    return spark.sql(sql, lineitem=table(spark, sf_dir, "lineitem"))


def classed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of several classes, with what a made-up classifier makes of them in whole numbers."""
    sql = CLASSED_SQL.format(S="STRING", lineitem="{lineitem}")
    return spark.sql(sql, lineitem=table(spark, sf_dir, "lineitem"))
