"""Routing configuration feeds (S5/S6): the config tables as change feeds.

In production these rows come from the configuration database (a snapshot
``op = 'r'`` followed by its changes); here they are short fixed lists. They
are only ever joined to the business feeds, never used alone, and carry a
broadcast hint because they are written out here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

T0 = 1_700_000_000_000

# Dimension routing config changes
# (op, ts_ms, source_table, sink_table, sink_columns, sink_family, sink_row_key).
DIM_CONFIG = [
    ("r", 1, "user_info", "dim_user_info", "id,name,nation_id,segment", "info", "id"),
    ("r", 1, "sku_info", "dim_sku_info", "id,sku_name,brand,type,size", "info", "id"),
    ("r", 1, "base_province", "dim_base_province", "id,name,region_id", "info", "id"),
    ("r", 1, "base_region", "dim_base_region", "id,name", "info", "id"),
    ("u", T0 + 500, "user_info", "dim_user_info", "id,name,segment", "info", "id"),
    ("d", 3, "base_region", "dim_base_region", "id,name", "info", "id"),
]

# Fact routing config (op, ts_ms, source_table, source_type,
# sink_table, sink_columns).
FACT_CONFIG = [
    ("r", 1, "cart_info", "c", "dwd_cart_add", "id,user_id,sku_id,sku_num"),
    ("r", 1, "cart_info", "u", "dwd_cart_update", "id,sku_num"),
    ("r", 1, "comment_info", "r", "dwd_comment", "id,user_id,appraise,comment_txt"),
    ("r", 1, "refund_payment", "u", "dwd_refund_payment_success", "id,order_id,payment_type,refund_status"),
    ("c", 2, "order_info", "c", "dwd_order_created", "id,user_id"),
    ("d", 3, "order_info", "c", "dwd_order_created", "id,user_id"),
]


def dim_config_feed(spark: SparkSession) -> DataFrame:
    return F.broadcast(spark.createDataFrame(
        DIM_CONFIG, "op string, ts_ms bigint, source_table string, sink_table string, "
                    "sink_columns string, sink_family string, sink_row_key string"))


def fact_config_feed(spark: SparkSession) -> DataFrame:
    return F.broadcast(spark.createDataFrame(
        FACT_CONFIG, "op string, ts_ms bigint, source_table string, source_type string, "
                     "sink_table string, sink_columns string"))

