"""The driver tables, with their schemas fixed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Only the columns some query reads.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
    "o_totalprice double, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_linenumber int, l_quantity double, "
    "l_returnflag string, l_linestatus string",
    "customer": "c_custkey bigint, c_name string, c_acctbal double",
    "supplier": "s_suppkey bigint, s_name string, s_acctbal double",
    "documents": "doc_id bigint, text string",
}


def schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(SCHEMAS[name])


def path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(schema(name)).parquet(path(sf_dir, name))
