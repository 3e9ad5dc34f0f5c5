"""Change-record envelopes and topic sources.

A change record is ``before / after / source`` maps of text plus ``op``,
``ts_ms`` and the log position ``pos`` -- the shape a binlog connector writes
to a topic as JSON. Numbers in the maps are text (decimals as strings,
datetimes as epoch-ms numbers). ``pos`` orders changes of one millisecond; it
may be null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAP_SS = T.MapType(T.StringType(), T.StringType())

ENVELOPE = T.StructType([
    T.StructField("before", MAP_SS),
    T.StructField("after", MAP_SS),
    T.StructField("source", MAP_SS),
    T.StructField("op", T.StringType()),
    T.StructField("ts_ms", T.LongType()),
    T.StructField("pos", T.LongType()),
])

ENVELOPE_COLS = [f.name for f in ENVELOPE.fields]


def text_map(fields: dict[str, Column | str | None]) -> Column:
    """map<string,string> from {key: column}; values are cast to text."""
    kv = []
    for k, v in fields.items():
        c = F.lit(None) if v is None else (F.col(v) if isinstance(v, str) else v)
        kv += [F.lit(k), c.cast("string")]
    return F.create_map(*kv)


def envelope(table: str, op, after: Column | None, before: Column | None, ts_ms: Column,
             db: str = "stream_retail", pos: Column | None = None) -> Column:
    """One change record as a struct (the element type of a feed). The
    ``table``/``db`` arguments are kept for readability; the ``source`` map
    is attached by :func:`explode_envelopes` as a constant column."""
    return F.struct(*_fields(op, after, before, ts_ms, pos))


def _fields(op, after: Column | None, before: Column | None, ts_ms: Column, pos: Column | None) -> list[Column]:
    op_c = F.lit(op) if isinstance(op, str) else op
    return [
        (before if before is not None else F.lit(None).cast(MAP_SS)).alias("before"),
        (after if after is not None else F.lit(None).cast(MAP_SS)).alias("after"),
        op_c.alias("op"),
        ts_ms.cast("bigint").alias("ts_ms"),
        (pos if pos is not None else F.lit(0)).cast("bigint").alias("pos"),
    ]


def source_map(table: str, db: str = "stream_retail") -> Column:
    return F.create_map(F.lit("db"), F.lit(db), F.lit("table"), F.lit(table))


def explode_envelopes(df: DataFrame, records: list[Column], table: str,
                      db: str = "stream_retail") -> DataFrame:
    """Emit zero or more change records of source table ``table`` per input
    row (null records skipped) in a single pass over ``df``.

    ``source`` is a constant column added after the explode, so a job's
    ``source['table'] = ...`` filter folds to true/false at planning time
    and a union of feeds is pruned to the tables the job reads. Plain
    ``explode`` + ``where`` keeps the projection inside whole-stage codegen
    (a higher-order ``filter`` would not be)."""
    if len(records) == 1:
        x = df.select(records[0].alias("r")).where(F.col("r").isNotNull())
    else:
        x = df.select(F.explode(F.array(*records)).alias("r")).where(F.col("r").isNotNull())
    return x.select("r.before", "r.after", source_map(table, db).alias("source"), "r.op", "r.ts_ms", "r.pos")


def change_records(df: DataFrame, table: str, op, after: Column | None, before: Column | None, ts_ms: Column,
                   db: str = "stream_retail", pos: Column | None = None) -> DataFrame:
    """One change record of source table ``table`` per input row.

    The maps are columns of a projection, not fields of a generated struct, so
    where a job reads a few keys of a map the optimizer takes them straight from
    the row and the map is never built."""
    f = _fields(op, after, before, ts_ms, pos)
    return df.select(*f[:2], source_map(table, db).alias("source"), *f[2:])


def replayed(df: DataFrame, again: Column) -> DataFrame:
    """Each row, and once more where ``again`` holds; ``__copy`` numbers the two.
    (Rows are repeated before :func:`change_records` builds their maps.)"""
    return df.withColumn("__copy", F.explode(F.when(again, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))


# --------------------------------------------------------------------------
# topic sources (S1/S2/S9): one string column ``value``
# --------------------------------------------------------------------------

def read_topic(spark: SparkSession, topic: str, fmt: str = "kafka", path: str | None = None,
               servers: str | None = None, starting: str = "earliest", stream: bool = True,
               options: dict | None = None, pattern: bool = False, group: str | None = None) -> DataFrame:
    """A feed of JSON text, one record per row, column ``value``.

    ``kafka``: value bytes as text, earliest offsets, partition discovery is
    built in (needs the Kafka connector on the classpath); ``pattern`` takes
    ``topic`` as a regular expression and follows topics that appear later,
    ``group`` starts the names of the consumer groups: each query has a group of
    its own, since two queries of one group would share out the partitions and
    each miss the other's. ``text``/``json``:
    JSON lines under ``path/topic`` -- the test and file-drop form. Null
    values are skipped (S1).
    """
    reader = spark.readStream if stream else spark.read
    if fmt == "kafka":
        r = (reader.format("kafka").option("kafka.bootstrap.servers", servers)
             .option("subscribePattern" if pattern else "subscribe", topic).option("startingOffsets", starting))
        if group:
            r = r.option("groupIdPrefix", group)
        if "kafka.group.id" in (options or {}):
            raise ValueError("a fixed kafka.group.id loses rows where an application reads the topic twice; give group")
        for k, v in (options or {}).items():
            r = r.option(k, v)
        df = r.load().select(F.col("value").cast("string").alias("value"))
    else:
        r = reader.format("text")
        for k, v in (options or {}).items():
            r = r.option(k, v)
        df = r.load(f"{path.rstrip('/')}/{topic}")
    return df.where(F.col("value").isNotNull())


def to_topic_value(df: DataFrame) -> DataFrame:
    """Serialise rows as JSON text (F17: null fields are omitted)."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


# --------------------------------------------------------------------------
# parsing (P1-P3)
# --------------------------------------------------------------------------

CORRUPT = "_corrupt_record"


def parse_json(df: DataFrame, schema: T.StructType, col: str = "value") -> tuple[DataFrame, DataFrame]:
    """JSON text -> typed columns. Returns ``(good, bad)``: text that is
    not a JSON object goes to ``bad`` (the dirty-record feed) instead of being
    dropped; null text is skipped."""
    with_corrupt = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    # the generator keeps the parser's result as a column: every condition on a
    # field would else be pushed below the projection and parse the text again
    parsed = df.where(F.col(col).isNotNull()).select(
        F.explode(F.array(F.from_json(F.col(col), with_corrupt,
                                      {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}))).alias("j"),
        F.col(col).alias("__raw"))
    bad_cond = F.col("j").isNull() | F.col("j." + CORRUPT).isNotNull()
    good = parsed.where(~bad_cond).select([F.col("j." + f.name).alias(f.name) for f in schema.fields])
    bad = parsed.where(bad_cond).select(F.col("__raw").alias(col))
    return good, bad


def parse_cdc(df: DataFrame, mode: str = "divert", col: str = "value"):
    """Change-record JSON -> envelope columns; records whose op starts
    with ``bootstrap-`` are dropped. ``mode='divert'`` returns
    ``(good, bad)`` (Q21: malformed text is diverted, not fatal);
    ``mode='failfast'`` raises on the first malformed record."""
    if mode == "failfast":
        good = df.select(F.from_json(F.col(col), ENVELOPE, {"mode": "FAILFAST"}).alias("j")).select("j.*")
        bad = None
    else:
        good, bad = parse_json(df, ENVELOPE, col)
    good = good.where(~F.coalesce(F.col("op").startswith("bootstrap-"), F.lit(False)))
    return (good, bad) if mode != "failfast" else good


# --------------------------------------------------------------------------
# topic tables
# --------------------------------------------------------------------------

def read_json_lines(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A JSON-lines file (one object per line) as rows; with a schema no
    inference pass is made over the data."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


PAGE_TOPIC = T.StructType([
    T.StructField("common", MAP_SS), T.StructField("page", MAP_SS), T.StructField("ts", T.LongType()),
])


def page_topic_table(value_df: DataFrame, lag: str | None = "0 seconds", col: str = "value") -> tuple[DataFrame, DataFrame]:
    """The page topic as a table -- ``common`` and ``page`` maps, ``ts``,
    computed event time ``et`` (epoch ms) and, on a stream, a watermark.
    Flattened to the page-log columns the DWS jobs use. Returns ``(table, bad)``:
    text that is no JSON object is diverted (Q21)."""
    j, bad = parse_json(value_df, PAGE_TOPIC, col)
    c, p = F.col("common"), F.col("page")
    out = j.select(
        c["mid"].alias("mid"), c["uid"].alias("uid"), c["vc"].alias("vc"), c["ch"].alias("ch"),
        c["ar"].alias("ar"), c["is_new"].alias("is_new"), c["sid"].alias("sid"),
        p["page_id"].alias("page_id"), p["last_page_id"].alias("last_page_id"),
        p["item"].alias("item"), p["item_type"].alias("item_type"),
        p["during_time"].try_cast("bigint").alias("during_time"),
        F.col("ts").alias("ts_ms"), F.timestamp_millis("ts").alias("ts"))
    return (out.withWatermark("ts", lag) if (lag is not None and value_df.isStreaming) else out), bad


def fact_topic_table(value_df: DataFrame, columns: list[str], lag: str | None = None,
                     col: str = "value") -> tuple[DataFrame, DataFrame]:
    """A DWD fact topic re-read as a table: text columns, ``ts_ms``
    bigint and its event time ``et``; optional watermark (3 s in one of the
    original jobs, none in the other). Returns ``(table, bad)``."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in columns if n != "ts_ms"]
                          + [T.StructField("ts_ms", T.LongType())])
    j, bad = parse_json(value_df, schema, col)
    j = j.withColumn("et", F.timestamp_millis("ts_ms"))
    return (j.withWatermark("et", lag) if (lag is not None and value_df.isStreaming) else j), bad
