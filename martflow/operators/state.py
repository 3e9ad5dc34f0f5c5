"""Keyed state operators, batch form.

The streaming originals keep one value per key and look at records in arrival
order. On a table the same answers come from aggregates over the key, which
Spark evaluates partially on the map side before shuffling -- so a key that
holds a third of all rows costs one partial row per input partition, not one
giant task. Where each input row needs a per-key value back, the value is
joined on the key (:func:`_attach`) in a form whose hot partitions adaptive
execution can split, instead of sorting a key's rows in one task as a
``Window.partitionBy(key)`` would.

The ordering of records within a key is always a total order given by the
caller: the event time followed by tie-breaker columns.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import DATE_FMT


def _cols(xs) -> list[Column]:
    if xs is None:
        return []
    if isinstance(xs, (str, Column)):
        xs = [xs]
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def _names(xs) -> list[str]:
    if xs is None:
        return []
    return [xs] if isinstance(xs, str) else list(xs)


def day_of(ts: str | Column) -> Column:
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.date_format(c, DATE_FMT)


def _ordered_struct(df: DataFrame, order: Sequence, payload: Sequence[str]) -> Column:
    """struct(order keys..., payload columns...) -- min/max of it picks the
    first/last row in the total order and carries the row along."""
    fields = [c.alias(f"__o{i}") for i, c in enumerate(_cols(order))]
    fields += [F.col(c) for c in payload]
    return F.struct(*fields)


def _attach(df: DataFrame, per_key: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join of every row to its key's aggregate (null keys match nothing).

    The join is on a struct of the keys. An aggregate by the keys would
    already be partitioned by them and be joined as it is, and adaptive
    execution splits a skewed partition only if both sides of the join are
    plain shuffles; the struct makes the planner shuffle the (small) aggregate
    once more.
    """
    small = per_key.withColumn("__on", F.struct(*keys)).drop(*keys)
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    # null keys are left out on the rows' side: a filter on the aggregate would be
    # pushed into its input, which then is no longer the rows' own and is made twice
    return df.withColumn("__key", F.when(known, F.struct(*keys))).join(small, F.col("__key") == F.col("__on"), "left").drop("__key", "__on")


def first_of_day(df: DataFrame, keys, ts: str, ties=(), day_col: str = "__day",
                 keep_day: bool = False) -> DataFrame:
    """T4: the first record per key and calendar day (repeats are dropped).

    Equal to the literal rule "emit when the stored date differs from the
    record's date" because dates never decrease along the event order.
    One aggregate with a partial step before the shuffle. (Min over a struct
    is a sort aggregate: each partition's rows, then the partials, are sorted
    by key; no key's rows are held together.)
    """
    keys = _names(keys)
    order = [ts, *_names(ties)]
    payload = [c for c in df.columns if c not in keys]
    g = (df.withColumn(day_col, day_of(ts))
           .groupBy(*keys, day_col)
           .agg(F.min(_ordered_struct(df, order, payload)).alias("__first")))
    out = g.select(*keys, day_col, *[F.col("__first." + c).alias(c) for c in payload])
    out = out.select(*df.columns, day_col)
    return out if keep_day else out.drop(day_col)


def flag_first_of_day(df: DataFrame, keys, ts: str, ties=(), out: str = "uv_ct") -> DataFrame:
    """Every record, with ``out`` = 1 for the first record of its key
    on its day and 0 for the rest (the daily unique-visitor flag).

    The first (ts, ties) per (key, day) is aggregated and attached to the
    rows; a hot (key, day) is split by the skew join.
    """
    keys = _names(keys)
    order = [ts, *_names(ties)]
    firsts = (df.withColumn("__day", day_of(ts))
                .groupBy(*keys, "__day")
                .agg(F.min(F.struct(*[F.col(c).alias(f"__o{i}") for i, c in enumerate(order)])).alias("__f")))
    j = _attach(df.withColumn("__day", day_of(ts)), firsts, [*keys, "__day"])
    me = F.struct(*[F.col(c).alias(f"__o{i}") for i, c in enumerate(order)])
    return j.withColumn(out, F.when(me == F.col("__f"), F.lit(1)).otherwise(F.lit(0)).cast("bigint")) \
            .drop("__day", "__f")


def repair_is_new(df: DataFrame, key: str = "mid", ts: str = "ts", ties=("event_id",),
                  flag: str = "is_new") -> DataFrame:
    """New-visitor repair per ``key``.

    The first record of a key fixes a reference date d0 once: its own date if
    it says ``is_new = '1'``, else the day before. Any later record that says
    ``is_new = '1'`` on a date other than d0 is rewritten to ``'0'``.
    (Q5: the original's 10 s state TTL is not applied; state never expires.)
    """
    order = [ts, *_names(ties)]
    first = (df.groupBy(key)
               .agg(F.min(F.struct(*[F.col(c).alias(f"__o{i}") for i, c in enumerate(order)],
                                   F.col(flag).alias("__flag"))).alias("__f")))
    f_ts = F.col("__f.__o0")
    d0 = F.when(F.col("__f.__flag") == "1", day_of(f_ts)) \
          .otherwise(F.date_format(F.date_sub(f_ts.cast("date"), 1), DATE_FMT))
    j = _attach(df, first, [key])
    fixed = F.when((F.col(flag) == "1") & (d0 != day_of(ts)), F.lit("0")).otherwise(F.col(flag))
    return j.withColumn(flag, fixed).drop("__f").select(*df.columns)


def login_flags(df: DataFrame, key: str = "uid", ts: str = "ts", ties=("event_id",),
                back_days: int = 8) -> DataFrame:
    """T5: per user, the first login of each day gets ``uu_ct = 1``; it also
    gets ``back_ct = 1`` when the user's previous login day is at least
    ``back_days`` days earlier (Q11: the intended rule, not the literal code).

    Logins are first collapsed to one row per (user, day) by a combinable
    aggregate; only then is the previous login day found with ``lag`` -- a
    user's partition holds at most one row per calendar day, so even the
    hottest user stays small.
    """
    days = first_of_day(df, key, ts, ties, day_col="__day", keep_day=True)
    w = Window.partitionBy(key).orderBy("__day")
    prev = F.lag("__day").over(w)
    back = F.when(prev.isNotNull() & (F.datediff(F.col("__day").cast("date"), prev.cast("date")) >= back_days), 1)
    return (days.withColumn("back_ct", F.coalesce(back, F.lit(0)).cast("bigint"))
                .withColumn("uu_ct", F.lit(1).cast("bigint"))
                .drop("__day"))


def keep_latest(df: DataFrame, key, order) -> DataFrame:
    """The last record per key (upsert-table contents, K4; T7 with a hold that
    never ends before the feed, see :func:`hold_and_flush`) under the
    total ``order`` (list of columns / expressions). A max over a struct --
    partial aggregation collapses duplicates before the shuffle."""
    keys = _names(key)
    payload = [c for c in df.columns if c not in keys]
    g = df.groupBy(*keys).agg(F.max(_ordered_struct(df, order, payload)).alias("__last"))
    return g.select(*keys, *[F.col("__last." + c).alias(c) for c in payload]).select(*df.columns)


def hold_and_flush(df: DataFrame, key: str, ts_ms: str, order, hold_ms: int = 5000) -> DataFrame:
    """T7, the rule itself: a key's first record opens a hold of ``hold_ms``; the
    newest record that comes within it (by ``ts_ms``, then ``order``) is emitted
    when it ends; the next record opens another one. Adds ``hold_start`` and
    ``flush_ms`` (epoch ms). A record at the very end of a hold opens the next.
    Records without a time are skipped; null keys are one key.

    Where a hold starts depends on where the one before it ended, so a key's
    records are walked in order: they are shuffled by key once, sorted (with spill)
    and streamed past one open hold, in constant memory however many records a
    hot key has. Records of a key and millisecond always share a hold; they are
    folded to the newest where they are sorted.
    """
    payload = [c for c in df.columns if c not in (key, ts_ms)]
    newest = df.where(F.col(ts_ms).isNotNull()).repartition(key).groupBy(key, ts_ms).agg(F.max(_ordered_struct(df, order, payload)).alias("__last")) \
        .select(key, ts_ms, *[F.col(f"__last.{c}").alias(c) for c in payload]).select(*df.columns)
    at = (df.columns.index(key), df.columns.index(ts_ms))
    out = T.StructType([*newest.schema.fields, T.StructField("hold_start", T.LongType()), T.StructField("flush_ms", T.LongType())])
    return newest.sortWithinPartitions(key, ts_ms).mapInArrow(_holds(at, hold_ms), out)


def _holds(at: tuple[int, int], hold_ms: int):
    """Task of :func:`hold_and_flush`: the last row of each hold."""
    def emit(rows, starts):
        start = pa.array(starts, pa.int64())
        return pa.RecordBatch.from_arrays([*rows.columns, start, pc.add(start, pa.scalar(hold_ms, pa.int64()))],
                                          names=[*rows.schema.names, "hold_start", "flush_ms"])

    def task(batches):
        held, key, start = None, None, None  # the newest row of the open hold
        for b in batches:
            last, starts = [], []
            for i, (k, t) in enumerate(zip(b.column(at[0]).to_pylist(), b.column(at[1]).to_pylist())):
                if start is None or k != key or t >= start + hold_ms:
                    if i and start is not None:
                        last.append(i - 1)
                        starts.append(start)
                    elif held is not None:
                        yield emit(held, [start])
                    key, start = k, t
            if last:
                yield emit(b.take(pa.array(last, pa.int64())), starts)
            if b.num_rows:
                held = b.slice(b.num_rows - 1)
        if held is not None:
            yield emit(held, [start])

    return task


#: Copies of a record that one generated array holds.
COPIES = 1 << 12


def retract_duplicates(df: DataFrame, key, order, measures: Sequence[str],
                       sign_col: str | None = None) -> DataFrame:
    """Retraction dedup ("state + offset").

    Arrival order per key is ``order``. Every record is emitted as is; each
    record that is followed by another one with the same key is emitted once
    more with its ``measures`` negated (the original emits it when the
    successor arrives, keeping the old timestamp -- Q15). Negation is numeric,
    so a null stays null and a negative value flips sign (Q12).

    Exact copies of a record (replays) are counted first: n copies give n
    positive rows, and n negative ones less one if the record is its key's
    last, so summing the output per group equals keeping the last record per
    key. Records that are equal in ``order`` only follow each other in the
    order of their other columns.
    Plan: the rows are dealt out by key once, to learn whether their key has more
    than one (a combinable count, looked up in a join whose hot partitions adaptive
    execution can split). A key's only row is done then. Of the others a combinable
    max per key is found, and copies are counted together with it in one aggregate
    over all columns, so that a hot key's records are spread -- no global sort, no lag.
    """
    keys = _names(key)
    # a record as ordered; columns that the order names are in it once
    named = {c: f"__o{i}" for i, c in enumerate(order) if isinstance(c, str)}
    rest = [c for c in df.columns if c not in (*keys, *named)]
    me = F.struct(*[c.alias(f"__o{i}") for i, c in enumerate(_cols(order))], *[F.col(c) for c in rest])
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    # under names of their own until they are joined: each use then has the same plan, and rows are shuffled once for all
    rows = df.where(known).select(*[F.col(c).alias(f"__r_{c}") for c in df.columns])
    key_of = F.struct(*[F.col(f"__r_{k}").alias(k) for k in keys])
    # compared as structs: both sides are plain shuffles (see _attach)
    several = rows.groupBy(key_of.alias("__on")).agg(F.count(F.lit(1)).alias("__c")).where("__c > 1").select(F.struct("__on.*").alias("__on"))
    back_named = [F.col(f"__r_{c}").alias(c) for c in df.columns]
    many = rows.join(several, key_of == F.col("__on"), "left_semi").select(*back_named)
    # the generator takes whole records: without the columns that the caller drops, this would be another shuffle
    once = rows.join(several, key_of == F.col("__on"), "left_anti").select(F.explode(F.array(F.struct(*back_named))).alias("__row")).select("__row.*")
    last = many.groupBy(*keys).agg(F.max(me).alias("__last")) \
        .select(*[F.col(c) if c in keys else F.col(f"__last.{named.get(c, c)}").alias(c) for c in df.columns])
    n, back = (lambda x: F.lit(x).cast("bigint").alias("__n")), (lambda x: F.lit(x).cast("bigint").alias("__back"))
    counted = many.select("*", n(1), back(1)).unionByName(last.select("*", n(0), back(-1))) \
        .groupBy(*df.columns).agg(F.sum("__n").alias("__n"), F.sum("__back").alias("__back"))
    # null keys are no key: each of their records is taken back
    j = counted.unionByName(once.select("*", n(1), back(0))).unionByName(df.where(~known).select("*", n(1), back(1)))
    taken_back = F.col("__back")
    # copies are counted out in two steps, so that no row holds a long array
    signs = F.explode(F.array(F.struct(F.lit(1).alias("s"), F.col("__n").alias("n")), F.struct(F.lit(-1).alias("s"), taken_back.alias("n"))))
    lots = j.select(*df.columns, signs.alias("__c")).where("__c.n > 0") \
        .withColumn("__lot", F.explode(F.sequence(F.lit(0), F.floor((F.col("__c.n") - 1) / COPIES))))
    some = F.least(F.lit(COPIES), F.col("__c.n") - F.col("__lot") * COPIES).cast("int")
    x = lots.withColumn("__sign", F.explode(F.array_repeat(F.col("__c.s"), some))).drop("__c", "__lot")
    for m in measures:
        dt = df.schema[m].dataType
        x = x.withColumn(m, F.when(F.col("__sign") == -1, -F.col(m)).otherwise(F.col(m)).cast(dt))
    x = x.select(*df.columns, "__sign")
    return x.withColumnRenamed("__sign", sign_col) if sign_col else x.drop("__sign")


def latest_config(df: DataFrame, key, seq: str = "ts_ms", op: str = "op") -> DataFrame:
    """Fold a change feed of configuration rows into its current state:
    the last change per key (by ``seq``, then the log position ``pos`` if there
    is one) wins, a delete (``op = 'd'``) removes the key."""
    latest = keep_latest(df, key, [seq, *(["pos"] if "pos" in df.columns else [])])
    return latest.where(F.col(op) != "d")


def fold_dimension(df: DataFrame, key: str, cols: Sequence[str], seq: str = "seq",
                   op: str = "op") -> DataFrame:
    """Dimension upsert fold. Per key, each column keeps its last
    non-empty value (null / '' cells are not written, so older values
    survive); a delete removes the row and everything before it.

    One combinable aggregate: for every column the max (seq, value) over
    non-empty cells, plus the seq of the last delete; a column value counts
    only if it is newer than that delete; the key survives only if its last
    change is not a delete.
    """
    nonempty = lambda c: F.col(c).isNotNull() & (F.col(c).cast("string") != "")
    aggs = [F.max(F.when(F.col(op) == "d", F.col(seq))).alias("__del"),
            F.max(seq).alias("__lastseq")]
    for c in cols:
        aggs.append(F.max(F.when(nonempty(c) & (F.col(op) != "d"),
                                 F.struct(F.col(seq).alias("s"), F.col(c).alias("v")))).alias("__m_" + c))
    g = df.groupBy(key).agg(*aggs)
    live = F.col("__del").isNull() | (F.col("__lastseq") > F.col("__del"))
    sel = [F.col(key)]
    for c in cols:
        m = F.col("__m_" + c)
        sel.append(F.when(F.col("__del").isNull() | (m["s"] > F.col("__del")), m["v"]).alias(c))
    return g.where(live).select(*sel)
