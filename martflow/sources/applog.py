"""Raw application-log feed (JSON text per line), derived from ``events``.

Each event becomes one log line the way the app would send it:

* ``signup`` -> start log (``start`` object, no page);
* ``error``  -> ``err`` object, on a start log when the event's k is even,
  else on a page log; error lines with value < 1 arrive truncated (dirty);
* ``view``   -> page log with ``k % 4`` displays (0 -> an empty array);
* ``click``  -> page log with ``k % 3 + 1`` actions;
* other      -> plain page log.

``k`` is the number in the event's ``props``. The text is built with
``to_json`` (null fields are omitted), one row per event, no driver work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .retail import page_log
from .tables import Tables

COMMON = T.StructType([T.StructField(n, T.StringType()) for n in
                       ("ar", "ba", "ch", "is_new", "md", "mid", "os", "uid", "vc", "sid")])
PAGE = T.StructType([
    T.StructField("page_id", T.StringType()), T.StructField("item", T.StringType()),
    T.StructField("item_type", T.StringType()), T.StructField("last_page_id", T.StringType()),
    T.StructField("during_time", T.LongType()),
])
START = T.StructType([T.StructField("entry", T.StringType()), T.StructField("loading_time", T.LongType()),
                      T.StructField("open_ad_id", T.LongType())])
ERR = T.StructType([T.StructField("error_code", T.LongType()), T.StructField("msg", T.StringType())])
DISPLAY = T.StructType([T.StructField("item", T.StringType()), T.StructField("item_type", T.StringType()),
                        T.StructField("pos_id", T.IntegerType()), T.StructField("pos_seq", T.IntegerType())])
ACTION = T.StructType([T.StructField("action_id", T.StringType()), T.StructField("item", T.StringType()),
                       T.StructField("item_type", T.StringType()), T.StructField("ts", T.LongType())])

LOG_SCHEMA = T.StructType([
    T.StructField("common", COMMON), T.StructField("page", PAGE), T.StructField("start", START),
    T.StructField("err", ERR), T.StructField("displays", T.ArrayType(DISPLAY)),
    T.StructField("actions", T.ArrayType(ACTION)), T.StructField("ts", T.LongType()),
])


def app_log_text(t: Tables) -> DataFrame:
    """One JSON log line per event: DataFrame(value string)."""
    pl = page_log(t, extra=("event_type", "value", "props")) \
        .withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    et, k = F.col("event_type"), F.col("k")
    is_start = (et == "signup") | ((et == "error") & (k % 2 == 0))
    common = F.struct(
        F.col("ar"), F.concat(F.lit("brand_"), F.col("ar")).alias("ba"), F.col("ch"), F.col("is_new"),
        F.lit("model_x").alias("md"), F.col("mid"), F.lit("Android 13").alias("os"), F.col("uid"),
        F.col("vc"), F.concat(F.lit("s_"), F.col("event_id").cast("string")).alias("sid"))
    page = F.struct("page_id", "item", "item_type", "last_page_id", "during_time")
    start = F.struct(F.lit("icon").alias("entry"), F.col("during_time").alias("loading_time"),
                     k.cast("bigint").alias("open_ad_id"))
    err = F.struct(k.cast("bigint").alias("error_code"),
                   F.concat(F.lit("exception at "), F.col("page_id")).alias("msg"))
    displays = F.transform(
        F.sequence(F.lit(0), k % 4 - 1),
        lambda i: F.struct((k + i).cast("string").alias("item"), F.lit("sku_id").alias("item_type"),
                           (i + 1).alias("pos_id"), i.alias("pos_seq")))
    actions = F.transform(
        F.sequence(F.lit(0), k % 3),
        lambda i: F.struct(F.when(i == 0, "cart_add").otherwise("favor_add").alias("action_id"),
                           k.cast("string").alias("item"), F.lit("sku_id").alias("item_type"),
                           (F.col("ts_ms") + i * 1000).alias("ts")))
    rec = F.struct(
        common.alias("common"),
        F.when(~is_start, page).alias("page"),
        F.when(is_start, start).alias("start"),
        F.when(et == "error", err).alias("err"),
        F.when(et == "view", F.when(k % 4 == 0, F.array().cast(T.ArrayType(DISPLAY))).otherwise(displays))
         .alias("displays"),
        F.when(et == "click", actions).alias("actions"),
        F.col("ts_ms").alias("ts"))
    js = F.to_json(rec)
    dirty = (et == "error") & (F.col("value") < 1.0)
    # A cut-off line: the JSON text without its closing brace.
    return pl.select(F.when(dirty, F.left(js, F.length(js) - 1)).otherwise(js).alias("value"))


def app_log_topic(t: Tables) -> DataFrame:
    """The raw log feed as a topic's rows: JSON text in column ``value``. The
    observed row count keeps the optimizer from merging the expressions that
    build the text into those that parse it, as a stored topic would."""
    return app_log_text(t).observe("app_log_topic", F.count(F.lit(1)).alias("rows"))
