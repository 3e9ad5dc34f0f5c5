"""DWD fact tables built from the change feed.

Each builder takes the change feed (envelope columns) and returns the fact
table with the column names and order of the original sink tables (all text,
``ts_ms`` bigint). Fact tables are upsert tables keyed by their id, so a
replayed id keeps its last version (``state.keep_latest``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import flexible_date, ms_to_date
from . import cdc, dims, state, versions


def _last(df: DataFrame, key: str) -> DataFrame:
    """The last version per key by change order; ``pos`` is not kept."""
    return state.keep_latest(df, key, cdc.change_order(df)).drop("pos")


# --------------------------------------------------------------------------
# cart add
# --------------------------------------------------------------------------

def cart_add_fact(ods: DataFrame) -> DataFrame:
    """X2 + X5 + P9 + P15: cart additions -- inserts, and updates that raised
    the quantity, with ``sku_num`` = the added quantity; ``ts_ms`` is bound
    to the sink column ``ts`` by position."""
    return _last(cart_add_rows(ods), "id").withColumnRenamed("ts_ms", "ts")


def cart_add_rows(ods: DataFrame) -> DataFrame:
    """Every cart addition of the feed, replays included (``ts_ms``, ``pos``)."""
    c = cdc.quantity_increased(cdc.select_changes(ods, "cart_info", ("c", "u")), "sku_num")
    a = F.col("after")
    return c.select(a["id"].alias("id"), a["user_id"].alias("user_id"), a["sku_id"].alias("sku_id"),
                    cdc.quantity_delta("sku_num").alias("sku_num"), *cdc.change_order(ods))


# --------------------------------------------------------------------------
# order detail (J1 + J2)
# --------------------------------------------------------------------------

#: Texts of a detail record that the fact row lacks and its order needs; the
#: fact's own ``split_original_amount`` is computed.
ORDER_TEXTS = ("source_id", "split_original_amount")


def _order_of(field) -> list[Column]:
    return [field("ts_ms"), field("sku_id").try_cast("bigint"), field("source_id").try_cast("bigint"),
            field("split_original_amount").try_cast("decimal(20,4)"), field("sku_num").try_cast("decimal(20,4)"),
            field("split_activity_amount").try_cast("decimal(20,4)"),
            field("split_coupon_amount").try_cast("decimal(20,4)")]


def detail_order(after: str = "after") -> list[Column]:
    """Default replay order of order_detail records: change time, then the
    line's own values (sku, supplier, amounts) as numbers."""
    return _order_of(lambda c: F.col(c) if c == "ts_ms" else F.col(after)[c])


ORDER_DETAIL_COLS = ["id", "order_id", "user_id", "sku_id", "sku_name", "province_id", "activity_id",
                     "activity_rule_id", "coupon_id", "date_id", "create_time", "sku_num",
                     "split_original_amount", "split_activity_amount", "split_coupon_amount",
                     "split_total_amount", "ts_ms"]


def _detail_rows(ods: DataFrame, order: Sequence[Column] | None, texts: bool = False) -> DataFrame:
    """order_detail inserts projected to fact columns, plus the replay order
    as a struct ``replay_order`` (or, with ``texts``, only the texts that the
    default order takes beside those columns, ``order_texts``). ``split_original_amount`` is
    ``sku_num * order_price`` in decimal(16,2) arithmetic."""
    od = cdc.select_changes(ods, "order_detail", "c").where(F.col("ts_ms").isNotNull())
    a = F.col("after")
    return od.select(
        a["id"].alias("id"), a["order_id"].alias("order_id"), a["sku_id"].alias("sku_id"),
        a["sku_name"].alias("sku_name"), a["create_time"].alias("create_time"),
        a["sku_num"].alias("sku_num"),
        (a["sku_num"].cast("decimal(16,2)") * a["order_price"].cast("decimal(16,2)")).cast("string")
        .alias("split_original_amount"),
        a["split_total_amount"].alias("split_total_amount"),
        a["split_activity_amount"].alias("split_activity_amount"),
        a["split_coupon_amount"].alias("split_coupon_amount"),
        F.col("ts_ms"),
        F.struct(*[a[c].alias(c) for c in ORDER_TEXTS]).alias("order_texts") if texts else
        F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order or detail_order())]).alias("replay_order"))


def _orders(ods: DataFrame) -> DataFrame:
    """The last inserted version of every order: its user and province."""
    oi = cdc.select_changes(ods, "order_info", "c")
    a = F.col("after")
    last = F.max(F.struct(*cdc.change_order(ods), a["user_id"].alias("user_id"), a["province_id"].alias("province_id")))
    return oi.groupBy(a["id"].alias("__oid")).agg(last.alias("__o")).select("__oid", "__o.user_id", "__o.province_id")


LINKS = {"order_detail_activity": ["activity_id", "activity_rule_id"], "order_detail_coupon": ["coupon_id"]}


def _links(ods: DataFrame, table: str) -> DataFrame:
    """(id, link): a detail's activity or coupon records in change order."""
    a = F.col("after")
    return cdc.select_changes(ods, table, "c").select(
        a["order_detail_id"].alias("id"),
        F.struct(*cdc.change_order(ods), *[a[c].alias(c) for c in LINKS[table]]).alias("link"))


def _attach_orders(od: DataFrame, ods: DataFrame) -> DataFrame:
    """Join detail rows to their order (inner), add ``date_id`` (Q7)."""
    return od.join(_orders(ods), F.col("order_id") == F.col("__oid"), "inner") \
             .withColumn("date_id", flexible_date("create_time"))


def order_detail_fact(ods: DataFrame, order: Sequence[Column] | None = None, per_order: DataFrame | None = None,
                      columns: Sequence[str] = ORDER_DETAIL_COLS) -> DataFrame:
    """J1 + J2 as an upsert table: the last version of every order detail,
    joined to its order (inner) and to its last activity and coupon (left).
    ``date_id`` is the date of ``create_time`` (Q7: epoch-ms text is read as
    a time). ``per_order``: a table of one row per order, the order's id first,
    whose other columns are joined with the order (inner). ``columns``: those
    that are wanted.

    Plan: an order's versions of a detail are folded and joined to it where they
    lie by it, as a feed's lines do already; what has no order goes after the
    last fold, since it may replace what has one. Of one row per order, those of
    an id differ by it, so columns that aren't wanted stay behind. Details,
    activities and coupons are keyed by the same id, so they
    are one union in one exchange by id, sorted once behind it and folded by one
    aggregate, which does the left joins too. A hot id's rows are sorted, with
    spill, and streamed. The default order is made of texts that are sent anyway
    (and two more), on either side of the exchange.
    """
    rows = _detail_rows(ods, order, texts=order is None)
    sent = "order_texts" if order is None else "replay_order"
    orders = _orders(ods)
    if per_order is not None:
        key = per_order.columns[0]
        orders = orders.join(per_order, F.col("__oid") == F.col(key), "inner").drop(key)
    of_order = [c for c in orders.columns if c != "__oid" and (c in columns or c not in ORDER_DETAIL_COLS)]
    orders = orders.select("__oid", F.struct(F.lit(True).alias("known"), *of_order).alias("of_order"))
    payload = [c for c in rows.columns if c not in ("id", sent)]

    wanted = {*columns, "order_id", *(["create_time"] if "date_id" in columns else []),
              *(["ts_ms", "sku_id", "sku_num", "split_activity_amount", "split_coupon_amount"] if order is None else [])}

    def ranked(kept: Sequence[str], *more: str) -> Column:
        """The columns as a struct, with the replay order ahead."""
        by = F.col("replay_order") if order is not None else F.struct(
            *[c.alias(f"k{i}") for i, c in enumerate(_order_of(lambda c: F.col("order_texts")[c] if c in ORDER_TEXTS else F.col(c)))])
        return F.struct(by.alias("by"), *[F.col(c).alias(c) for c in (*kept, *more, sent)])

    def with_order(df: DataFrame, how: str) -> DataFrame:
        return df.join(orders, F.col("order_id") == F.col("__oid"), how).drop("__oid")

    # ranked in the aggregate: its sort, which the join goes on with, holds no second form of the texts
    dealt = rows.where(F.col("id").isNotNull()).groupBy("order_id", "id").agg(F.max(ranked(payload)).alias("v"))
    payload = [c for c in payload if c in wanted]
    dealt = with_order(dealt.select("id", "order_id", *[F.col(f"v.{c}").alias(c) for c in (sent, *payload) if c != "order_id"]), "left")
    kinds = {"detail": dealt.select("id", F.lit(True).alias("detail"), sent, *payload, "of_order")}
    kinds |= {t: _links(ods, t).withColumnRenamed("link", t).where(F.col("id").isNotNull()) for t in LINKS}
    union = None
    for name, df in kinds.items():
        union = df if union is None else union.unionByName(df, allowMissingColumns=True)
    union = union.repartition("id").select("id", F.when(F.col("detail"), ranked(payload, "of_order")).alias("d"), *LINKS)
    folded = union.groupBy("id").agg(*[F.max(k).alias(k) for k in ("d", *LINKS)]).where(F.col("d").isNotNull())
    od = folded.select("id", *[F.col(f"d.{c}").alias(c) for c in (*payload, "of_order")],
                       *[F.col(f"{t}.{c}").alias(c) for t, cols in LINKS.items() for c in cols])
    # a detail without an id has no link and no other version
    alone = with_order(rows.where(F.col("id").isNull()).select("id", *payload), "inner")
    od = od.where(F.col("of_order").isNotNull()).unionByName(alone, allowMissingColumns=True)
    od = od.select("*", *[F.col(f"of_order.{c}").alias(c) for c in of_order])
    if "date_id" in columns:
        od = od.withColumn("date_id", flexible_date("create_time"))
    return od.select(*columns, *[c for c in of_order if c not in ORDER_DETAIL_COLS])


def _with_orders(detail: DataFrame | Callable[..., DataFrame], per_order: DataFrame) -> DataFrame:
    """Detail facts joined (inner) to a table of one row per order, the order's
    id first. ``detail``: the facts, or what makes them and takes the table as
    ``per_order`` (:func:`order_detail_fact`); folded facts lie by their id and
    would all be dealt out by their order once more."""
    if callable(detail):
        return detail(per_order=per_order)
    key = per_order.columns[0]
    return detail.join(per_order, F.col("order_id") == F.col(key), "inner").drop(key)


CHANGE_COLS = ["id", "order_id", "user_id", "sku_id", "province_id", "activity_id", "activity_rule_id", "coupon_id", "sku_num",
               "split_original_amount", "split_activity_amount", "split_coupon_amount", "split_total_amount", "change_ms", "sign"]


def order_detail_changes(ods: DataFrame, order: Sequence[Column] | None = None) -> DataFrame:
    """J1 + J2 as the change rows that the streaming join emits: a detail
    appears when its order has (links null until theirs come), and each later
    change of detail, order, activity or coupon retracts the row (``sign`` -1)
    and emits the new one (+1) at ``change_ms``. Null ids join nothing; a detail
    without an id is never retracted.

    The signs of an id sum to 1, and what remains is its row in
    :func:`order_detail_fact`. Changes of a millisecond count as one, so records
    that a replay repeats emit nothing.
    """
    rows = _detail_rows(ods, order, texts=order is None)
    sent = "order_texts" if order is None else "replay_order"
    known = lambda df: df.where(F.col("id").isNotNull() & F.col("ts_ms").isNotNull())
    payload = [c for c in rows.columns if c not in ("id", "ts_ms", sent)]
    links = {t: known(_links(ods, t).select("id", F.col("link.ts_ms").alias("ts_ms"), "link")) for t in LINKS}

    def ranked(d: Column) -> Column:
        """A detail record of one time with the replay order ahead."""
        own = lambda c: F.lit(0) if c == "ts_ms" else d["order_texts"][c] if c in ORDER_TEXTS else d[c]
        by = d["replay_order"] if order is not None else F.struct(*[c.alias(f"k{i}") for i, c in enumerate(_order_of(own))])
        return F.struct(by.alias("by"), *[d[c].alias(c) for c in payload])

    state = versions.merged(known(rows).select("id", "ts_ms", sent, *payload), links, "id", ranked=ranked).select(
        "id", *[F.col(f"main.{c}").alias(c) for c in payload], *[F.col(f"{t}.link.{c}").alias(c) for t, cols in LINKS.items() for c in cols],
        "valid_from", "valid_to")
    alone = rows.where(F.col("id").isNull()).withColumn("valid_from", F.col("ts_ms")).drop(sent, "ts_ms")
    state = state.unionByName(alone, allowMissingColumns=True)
    oi = cdc.select_changes(ods, "order_info", "c")
    a = F.col("after")
    orders = versions.versions(oi.select(a["id"].alias("oid"), a["user_id"].alias("user_id"), a["province_id"].alias("province_id"),
                                         *cdc.change_order(oi)), "oid", cdc.change_order(oi))
    joined = versions.overlap_join(state, orders.select("oid", "user_id", "province_id", "valid_from", "valid_to"), ("order_id", "oid"))
    return versions.signed_changes(joined.select(*CHANGE_COLS[:-2], "valid_from", "valid_to"))


def order_detail_rows(ods: DataFrame, order: Sequence[Column] | None = None) -> DataFrame:
    """Detail versions that have their order (the inner side of J1) without
    attaching anything: the cheap input for per-id dedup or retraction.
    Attaching order, activity and coupon never changes the rows of an id,
    so dedup first and attach after gives the same result on fewer rows."""
    oi = cdc.select_changes(ods, "order_info", "c").select(F.col("after")["id"].alias("order_id")).distinct()
    return _detail_rows(ods, order).join(oi, "order_id", "left_semi")


def order_detail_versions(ods: DataFrame, order: Sequence[Column] | None = None) -> DataFrame:
    """The order-detail topic as the DWS jobs read it: every version of
    every detail (replays included), with ``replay_order`` kept so that
    downstream dedup (T6/T7) knows which version came last."""
    od = _detail_rows(ods, order)
    for t, cols in LINKS.items():
        link = _links(ods, t).groupBy(F.col("id").alias("__lid")).agg(F.max("link").alias("__l")) \
            .select("__lid", *[F.col(f"__l.{c}").alias(c) for c in cols])
        od = od.join(link, F.col("id") == F.col("__lid"), "left").drop("__lid")
    return _attach_orders(od, ods).select(*ORDER_DETAIL_COLS, "replay_order")


# --------------------------------------------------------------------------
# order cancel
# --------------------------------------------------------------------------

ORDER_CANCEL_COLS = ["id", "order_id", "user_id", "sku_id", "sku_name", "province_id", "activity_id",
                     "activity_rule_id", "coupon_id", "date_id", "cancel_time", "sku_num",
                     "split_original_amount", "split_activity_amount", "split_coupon_amount",
                     "split_total_amount", "ts_ms"]


def order_cancel_fact(detail: DataFrame | Callable[..., DataFrame], ods: DataFrame) -> DataFrame:
    """X3 + J3: order-detail facts of orders cancelled (1001 -> 1003);
    ``cancel_time`` = the update's operate_time, ``date_id`` its date,
    ``ts_ms`` the cancel change's time; the last cancellation of an order
    counts. ``detail``: see :func:`_with_orders`."""
    c = cdc.transitioned(cdc.select_changes(ods, "order_info", "u"), "order_status", "1001", "1003")
    c = _last(c.select(F.col("after")["id"].alias("__oid"), F.col("after")["operate_time"].alias("cancel_time"),
                       *cdc.change_order(c)), "__oid").withColumnRenamed("ts_ms", "__cts")
    j = _with_orders(detail, c.withColumnRenamed("__oid", "__coid")).drop("date_id", "create_time", "ts_ms")
    return (j.withColumn("date_id", flexible_date("cancel_time"))
             .withColumnRenamed("__cts", "ts_ms").select(*ORDER_CANCEL_COLS))


# --------------------------------------------------------------------------
# payment success (J4 + J5)
# --------------------------------------------------------------------------

PAYMENT_COLS = ["order_detail_id", "order_id", "user_id", "sku_id", "sku_name", "province_id",
                "activity_id", "activity_rule_id", "coupon_id", "payment_type_code", "payment_type_name",
                "callback_time", "sku_num", "split_original_amount", "split_activity_amount",
                "split_coupon_amount", "split_payment_amount", "ts_ms"]


def payments(ods: DataFrame, source_table: str = "refund_payment", status_col: str = "refund_status", status: str = "1602") -> DataFrame:
    """The last successful payment of each order (``__poid``)."""
    p = cdc.changed_to(cdc.select_changes(ods, source_table, "u"), status_col, status)
    a = F.col("after")
    return _last(p.select(a["order_id"].alias("__poid"), a["payment_type"].alias("payment_type_code"),
                          a["callback_time"].alias("callback_time"), *cdc.change_order(p)), "__poid")


def payment_fact(detail: DataFrame | Callable[..., DataFrame], ods: DataFrame, dic: DataFrame,
                 source_table: str = "refund_payment", status_col: str = "refund_status",
                 status: str = "1602", interval: tuple[str, str] | None = None,
                 detail_time: str = "create_time") -> DataFrame:
    """X4 + J4 + J5: successful payments joined to the order's detail facts
    and to the payment-type name; the last payment of an order counts.

    Q10: the source table and status are parameters (the original reads
    refund_payment / 1602). ``interval=(before, after)`` -- e.g.
    ``("30 minutes", "5 seconds")`` -- keeps detail rows whose time lies in
    ``[pay_time - before, pay_time + after]`` (the interval-join variant);
    the detail time is the epoch-ms column ``detail_time``. ``detail``: see
    :func:`_with_orders`.
    """
    p = payments(ods, source_table, status_col, status).withColumnRenamed("ts_ms", "__pts")
    j = _with_orders(detail, p).drop("ts_ms")
    if interval is not None:
        before, after = interval
        det, pet = F.timestamp_millis(F.col(detail_time).try_cast("bigint")), F.timestamp_millis("__pts")
        j = j.where((det >= pet - F.expr(f"INTERVAL {before}")) & (det <= pet + F.expr(f"INTERVAL {after}")))
    j = dims.dict_lookup(j, dic, "payment_type_code", "payment_type_name", "inner")
    return (j.withColumnRenamed("id", "order_detail_id")
             .withColumnRenamed("split_total_amount", "split_payment_amount")
             .withColumnRenamed("__pts", "ts_ms").select(*PAYMENT_COLS))


def payment_fact_versioned(detail: DataFrame | Callable[..., DataFrame], ods: DataFrame, dic_feed: DataFrame, span_ms: int = versions.DAY_MS, **kw) -> DataFrame:
    """X4 + J4 + J5 as of the payment's time: :func:`payment_fact` with the
    payment-type name that the dictionary held at ``ts_ms``. ``dic_feed``: the
    dictionary's own change feed. A payment whose code was deleted or not yet
    known then is dropped (inner lookup)."""
    p = payments(ods, **kw)
    named = versions.as_of_join(p, dims.dict_versions(dic_feed, "payment_type_code", "payment_type_name", span_ms),
                                "payment_type_code", "ts_ms", span_ms=span_ms)
    named = named.select("__poid", "payment_type_code", "payment_type_name", "callback_time", F.col("ts_ms").alias("__pts"))
    return _with_orders(detail, named).drop("ts_ms").withColumnRenamed("__pts", "ts_ms") \
        .withColumnRenamed("id", "order_detail_id").withColumnRenamed("split_total_amount", "split_payment_amount").select(*PAYMENT_COLS)


# --------------------------------------------------------------------------
# refund (J10)
# --------------------------------------------------------------------------

REFUND_COLS = ["id", "user_id", "order_id", "sku_id", "province_id", "date_id", "create_time",
               "refund_type_code", "refund_type_name", "refund_reason_type_code",
               "refund_reason_type_name", "refund_reason_txt", "refund_num", "refund_amount", "ts_ms"]


def refund_fact(ods: DataFrame, dic: DataFrame, ops: Sequence[str] = ("r", "c")) -> DataFrame:
    """X6 + X4 + J10 + J5x2: refund requests joined to orders that moved to
    1005 (province) and to two dictionary names.

    Q8: the original reads only snapshot rows (``op = 'r'``); ``ops``
    defaults to snapshot and inserts. Q9: the 5 s state limit is a stream
    setting, not a batch filter.
    """
    ri = cdc.project(cdc.select_changes(ods, "order_refund_info", ops),
                     {"id": "id", "user_id": "user_id", "order_id": "order_id", "sku_id": "sku_id",
                      "refund_type_code": "refund_type", "refund_num": "refund_num",
                      "refund_amount": "refund_amount", "refund_reason_type_code": "refund_reason_type",
                      "refund_reason_txt": "refund_reason_txt", "create_time": "create_time"},
                     keep=cdc.change_order(ods))
    ri = _last(ri, "id")
    oi = cdc.changed_to(cdc.select_changes(ods, "order_info", "u"), "order_status", "1005")
    oi = _last(oi.select(F.col("after")["id"].alias("__oid"), F.col("after")["province_id"].alias("province_id"),
                         *cdc.change_order(oi)), "__oid").drop("ts_ms")
    j = ri.join(oi, F.col("order_id") == F.col("__oid"), "inner")
    j = dims.dict_lookup(j, dic, "refund_type_code", "refund_type_name", "inner")
    j = dims.dict_lookup(j, dic, "refund_reason_type_code", "refund_reason_type_name", "inner")
    return j.withColumn("date_id", ms_to_date(F.col("create_time").try_cast("bigint"))).select(*REFUND_COLS)


# --------------------------------------------------------------------------
# comment (J5)
# --------------------------------------------------------------------------

COMMENT_COLS = ["id", "user_id", "sku_id", "appraise", "appraise_name", "comment_txt", "ts_ms"]


def comment_fact(ods: DataFrame, dic: DataFrame, ops: Sequence[str] = ("r", "c")) -> DataFrame:
    """X6 + J5: the last version of each comment with the appraisal name (inner
    lookup: unknown appraisal codes are dropped). Q8 as for refunds."""
    return named_comments(_last(comment_rows(ods, ops), "id"), dic)


def comment_rows(ods: DataFrame, ops: Sequence[str] = ("r", "c")) -> DataFrame:
    """Every comment record of the feed, replays included."""
    return cdc.project(cdc.select_changes(ods, "comment_info", ops),
                       ["id", "user_id", "sku_id", "appraise", "comment_txt"], keep=cdc.change_order(ods))


def named_comments(comments: DataFrame, dic: DataFrame) -> DataFrame:
    return dims.dict_lookup(comments, dic, "appraise", "appraise_name", "inner").select(*COMMENT_COLS)
