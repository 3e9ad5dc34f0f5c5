"""Plan-shape checks for the scale rules: hot keys are combined map-side
before any shuffle, broadcasts only happen under a checked bound, and the
big side of the traffic job is never shuffled row by row."""

from pyspark.sql import functions as F

from martflow.operators import facts, routing, state, text, windows
from martflow.sources import cdc, retail
from martflow.sources.tables import Tables


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def hot(spark, n=30000):
    """A third of all rows share key 0."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("seq"), (F.col("id") * 2).alias("v"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id")).alias("ts"))


def test_keep_latest_hot_key_partial_then_exact(spark):
    df = hot(spark)
    out = state.keep_latest(df, "k", ["seq"])
    p = plan(out)
    assert "partial_max" in p and p.index("partial_max") > p.index("Exchange")  # partial below the exchange
    got = {r.k: (r.seq, r.v) for r in out.where("k = 0").collect()}
    assert got == {0: (29997, 59994)}


def test_first_of_day_hot_key_partial(spark):
    df = hot(spark)
    out = state.first_of_day(df, "k", "ts", ["seq"])
    assert "partial_min" in plan(out)
    first0 = out.where("k = 0").collect()
    assert len(first0) == 1 and first0[0].seq == 0


def test_fold_dimension_partial(spark):
    df = hot(spark).select(F.col("k").cast("string").alias("id"), "seq", F.lit("u").alias("op"),
                           F.col("v").cast("string").alias("name"))
    out = state.fold_dimension(df, "id", ["name"], "seq", "op")
    assert "partial_max" in plan(out)
    assert out.where("id = '0'").first().name == "59994"



def test_traffic_window_never_shuffles_raw_rows(spark):
    pl = retail.page_log(Tables(spark, "/root/testdata/sf0.001"))
    p = plan(windows.traffic_window(pl, "10 seconds"))
    # two exchanges: per-(mid, day) firsts and the final window aggregate, both after partial aggregation
    assert p.count("Exchange hashpartitioning") == 2
    assert "partial_min" in p and "partial_sum" in p


def test_hot_key_rows_are_split(spark):
    """A key with half of the rows: the join that attaches its aggregate to the
    rows is split by adaptive execution."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = spark.range(200_000).select(
            F.col("id").alias("event_id"), F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("mid"),
            F.timestamp_seconds("id").alias("ts"), F.lit("1").alias("is_new"), F.lit(1.0).alias("amt"))
        for x in (state.repair_is_new(df), state.flag_first_of_day(df, "mid", "ts", ["event_id"]),
                  state.retract_duplicates(df, "mid", ["ts", "event_id"], ["amt"])):
            y = x.agg(F.sum(F.hash(*x.columns)))
            y.collect()
            assert "skew=true" in y._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_queries_plan_without_running_jobs(spark):
    """Building a query's plan starts no Spark job (no size checks, no eager writes)."""
    import __spark_entry__
    from martflow.plans.catalog import QUERIES
    tracker = spark.sparkContext.statusTracker()
    for name in ("payment_fact", "refund_fact", "sku_order_window", "dim_route", "fact_route", "log_split_page", "sensitive_word_flag"):
        group = f"plan-{name}"
        spark.sparkContext.setJobGroup(group, name)
        QUERIES[name](spark, __spark_entry__.SMOKE_DIR)
        jobs = [j for j in tracker.getJobIdsForGroup(group)]
        # reading a Parquet file's footer for its schema is Spark's own job
        assert len(jobs) <= 12, (name, jobs)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_feed_maps_are_not_built_for_a_fact(spark):
    """Replays repeat rows, not records: the fact takes its columns from the row, and no detail's map of texts is made."""
    from martflow.plans.catalog import QUERIES
    assert "map(id, " not in plan(QUERIES["order_dedup_latest"](spark, "/root/testdata/sf0.001"))


def test_topic_text_is_parsed_once(spark):
    from martflow.sources.cdc import parse_cdc
    text = spark.createDataFrame([('{"after":{"id":"1"},"op":"c","ts_ms":5}',), ("{cut",), ('{"op":"bootstrap-start"}',), (None,)], "value string")
    good, bad = parse_cdc(text.repartition(2))
    rows = good.where("op = 'c' and ts_ms > 1 and after['id'] is not null")
    assert plan(rows).count("from_json(") == 1
    assert [r.after for r in rows.collect()] == [{"id": "1"}] and [r.value for r in bad.collect()] == ["{cut"]


def test_retraction_and_holds_send_a_row_once(spark):
    """A row's order is no second copy of it in the retraction's joins, and holds need one exchange by key."""
    def ran(x):
        x.collect()
        return x._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]

    df = hot(spark, 3000)
    assert ran(state.hold_and_flush(df.select("k", "seq", "v"), "k", "seq", ["v"], 10)).count("Exchange hashpartitioning") == 1
    p = plan(state.retract_duplicates(df, "k", ["seq"], ["v"]))
    assert not any("__me" in line or "struct(__o0" in line for line in p.split("\n") if "HashAggregate(keys=[k" in line and "count(1)" in line)


def test_routed_changes_are_dealt_out_before_they_become_cells(spark):
    """The rows of a file are spread by change before each becomes several
    cells, also those of a hot row key, and the fold is as before."""
    n = 3000
    routed = spark.range(n, numPartitions=1).select(
        F.lit("dim").alias("sink_table"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("row_key"),
        F.lit("u").alias("op"), F.col("id").alias("ts_ms"), F.lit(0).cast("bigint").alias("pos"),
        F.create_map(F.lit("a"), F.col("id").cast("string"), F.lit("b"), F.when(F.col("id") < 9, "early")).alias("data"))
    cells = routing.dim_cells(routed)
    p = plan(cells)
    assert p.index("Generate explode") < p.index("REPARTITION_BY_COL") and "partial_max" in p
    dealt = routed.repartition("sink_table", "row_key", "ts_ms", "pos").withColumn("p", F.spark_partition_id())
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert dealt.where("row_key = 'hot'").select("p").distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    got = {(r.row_key, r.column): r.value for r in routing.dim_rows(cells).collect()}
    assert got[("hot", "a")] == str(n - 3) and got[("hot", "b")] == "early" and got[("7", "b")] == "early"
    assert len(got) == 1 + n - n // 3 + 1 + 6


def test_keyword_join_has_tasks_by_its_searches(spark, monkeypatch):
    """The join that gives each searched text its keywords is cut by the number
    of searches, not by its input's bytes, and counts are as before."""
    searches = spark.range(900).select(F.timestamp_seconds(F.lit(1704067200) + F.col("id") % 450).alias("ts"),
                                       (F.col("id") % 30).cast("string").alias("item"))
    texts = spark.range(40).select(F.col("id").alias("doc_id"), F.concat(F.lit("one one w"), F.col("id").cast("string")).alias("text"))
    monkeypatch.setattr(windows, "SPREAD_SEARCHES", 100)
    asked = windows.windowed_searches(searches, "1 second")
    tasks = windows.search_tasks(asked)
    assert tasks == 5 and windows.search_tasks(asked.limit(0)) == 1  # 450 pairs, each twice
    out = windows.searched_keyword_counts(asked, text.searched_texts(searches, texts, tasks=tasks), tasks)
    p = plan(out)
    assert p.count("hashpartitioning(ref") >= 2 and "ref#" in p and ", 5), REPARTITION_BY_NUM" in p
    got = {(r.stt, r.keyword): r.keyword_count for r in out.collect()}
    assert len(got) == 900 and got[("2024-01-01 00:00:00", "one")] == 4 and got[("2024-01-01 00:00:00", "w0")] == 2


def test_detail_versions_meet_in_one_exchange(spark):
    """Details and links cross one exchange by id, without a fold and its sort
    ahead of it; the default order still compares numbers, of the record's own
    texts, and a given order still counts."""
    base = {"order_id": "o", "sku_id": "9", "source_id": "9", "sku_num": "1", "order_price": "5", "split_original_amount": "9.5",
            "split_activity_amount": "0", "split_coupon_amount": "0", "split_total_amount": "first", "create_time": "0"}
    rec = lambda table, after: (None, after, {"db": "d", "table": table}, "c", 1000, 0)
    last = {"1": {"sku_id": "10"}, "2": {"source_id": "10"}, "3": {"split_original_amount": "10.5", "order_price": "4"}, "4": {"sku_num": "10", "order_price": "0.1"}}
    rows = [rec("order_detail", base | {"id": k} | more) for k, new in last.items() for more in ({}, new | {"split_total_amount": "last"}, {})]
    rows += [rec("order_detail", base), rec("order_detail", base), rec("order_info", {"id": "o", "user_id": "u", "province_id": "p"}),
             rec("order_detail_coupon", {"order_detail_id": "1", "coupon_id": "7"}), rec("order_detail_coupon", {"order_detail_id": "8", "coupon_id": "7"})]
    ods = spark.createDataFrame(rows, cdc.ENVELOPE)
    out = facts.order_detail_fact(ods)
    p = plan(out)
    assert p.count("REPARTITION_BY_COL") == 1 and p.rindex("partial_max(d") < p.index("REPARTITION_BY_COL")
    got = sorted(((r.id, r.split_total_amount, r.coupon_id, r.user_id) for r in out.collect()), key=str)
    assert got == sorted([("1", "last", "7", "u"), *[(k, "last", None, "u") for k in "234"], (None, "first", None, "u"), (None, "first", None, "u")], key=str)
    backwards = facts.order_detail_fact(ods, [-F.col("after")["sku_id"].try_cast("bigint"), F.col("ts_ms")])
    assert backwards.where("id = '1'").first().split_total_amount == "first"


def exchanges(df) -> int:
    """Shuffles of a plan without broadcasts, as for tables that are too large for them."""
    spark = df.sparkSession
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return plan(df.select("*")).count("Exchange hashpartitioning(")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_details_lie_by_their_order(spark):
    """Where details meet their orders, the feed's lines are not moved again: beyond the lines' own two
    joins only the orders are shuffled."""
    ods = retail.ods(Tables(spark, "/root/testdata/sf0.001"), ("order_detail", "order_info"))
    orders = facts._orders(ods)
    lines = facts._detail_rows(ods, None)
    assert exchanges(lines) == 4  # two joins of two sides
    assert exchanges(facts.order_detail_rows(ods)) == exchanges(lines) + exchanges(orders)


def test_orders_are_joined_ahead_of_the_fold(spark):
    """Folded details are not dealt out by their order for J1 or the joins of an order's other rows."""
    t = Tables(spark, "/root/testdata/sf0.001")
    feed = retail.ods(t, ("order_detail", "order_info", "order_detail_activity", "order_detail_coupon"))
    fact = facts.order_detail_fact(feed)
    own = exchanges(facts._detail_rows(feed, None)) + exchanges(facts._orders(feed))
    alone = 3  # records without an id, which share their orders' shuffles where they are run
    assert exchanges(fact) <= own + alone + own
    from martflow.plans.catalog import QUERIES
    p = plan(QUERIES["order_cancel_fact"](spark, "/root/testdata/sf0.001"))
    assert p.index("Join") > p.index("REPARTITION_BY_COL")  # no join above the exchange by id


def test_a_last_version_without_order_hides_the_earlier_ones(spark):
    """J1 is done ahead of the fold: the version that counts is still the last one of all, and per-order rows are those of its order."""
    rec = lambda table, after, ts=1000, op="c", before=None: (before, after, {"db": "d", "table": table}, op, ts, 0)
    base = {"sku_id": "9", "sku_num": "1", "order_price": "5", "create_time": "0"}
    rows = [rec("order_info", {"id": o, "user_id": f"u{o}", "province_id": "p"}) for o in ("a", "b")]
    rows += [rec("order_detail", base | {"id": i, "order_id": o}, ts) for i, o, ts in
             [("1", "a", 1), ("1", "gone", 2), ("2", "gone", 1), ("2", "a", 2), ("3", "a", 1), ("3", "b", 2), ("4", None, 2), ("4", "a", 1), ("5", "b", 1), (None, "b", 1), (None, "gone", 1)]]
    rows += [rec("order_info", {"id": o, "order_status": "1003", "operate_time": "7"}, ts, "u", {"order_status": "1001"}) for o, ts in [("b", 5), ("b", 6), ("gone", 9)]]
    ods = spark.createDataFrame(rows, cdc.ENVELOPE)
    key = lambda df: sorted(((r.id, r.order_id, r.user_id, r.ts_ms) for r in df.collect()), key=str)
    fact = facts.order_detail_fact(ods)
    assert fact.columns == facts.ORDER_DETAIL_COLS
    assert key(fact) == sorted([("2", "a", "ua", 2), ("3", "b", "ub", 2), ("5", "b", "ub", 1), (None, "b", "ub", 1)], key=str)
    cancelled = sorted([("3", "b", "ub", 6), ("5", "b", "ub", 6), (None, "b", "ub", 6)], key=str)
    for detail in (fact, lambda **more: facts.order_detail_fact(ods, **more)):
        out = facts.order_cancel_fact(detail, ods)
        assert out.columns == facts.ORDER_CANCEL_COLS and key(out) == cancelled


def test_retraction_shuffles_whole_rows_once(spark):
    """All rows are dealt out once; only keys with several rows are counted and compared. Null keys and copies as before."""
    rows = [(str(i), i, i + 0.5) for i in range(500)] + [("a", 1, 1.0), ("a", 2, 2.0), ("a", 2, 2.0), ("a", 2, None), (None, 1, 1.0), (None, 1, 1.0), ("b", 3, -1.0), ("b", 3, -1.0)]
    df = spark.createDataFrame(rows, "k string, seq long, v double").repartition(4)
    old = {c: spark.conf.get(c, None) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    for c in old:
        spark.conf.set(c, "-1")
    try:
        out = state.retract_duplicates(df, "k", ["seq"], ["v"], sign_col="s").select("k", "v", "s")
        got = sorted(((r.k, r.v, r.s) for r in out.collect()), key=str)
        final = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        for c, v in old.items():
            spark.conf.unset(c) if v is None else spark.conf.set(c, v)
    assert got == sorted([(str(i), i + 0.5, 1) for i in range(500)] + [("a", 1.0, 1), ("a", -1.0, -1), ("a", None, 1), ("a", None, -1)] + [("a", 2.0, 1)] * 2 + [("a", -2.0, -1)]
                         + [(None, 1.0, 1), (None, -1.0, -1)] * 2 + [("b", -1.0, 1)] * 2 + [("b", 1.0, -1)], key=str)
    by_key = [line for line in final.split("\n") if "Exchange hashpartitioning(struct(k" in line]
    assert sum("Reused" not in line for line in by_key) == 1


def test_only_wanted_detail_columns_cross_the_exchange(spark):
    """What a window doesn't read stays behind the fold by order, versions are still told apart by all of it; a window is sent as its start."""
    t = Tables(spark, "/root/testdata/sf0.001")
    feed = retail.ods(t, ("order_detail", "order_info", "order_detail_activity", "order_detail_coupon")).persist()
    whole = facts.order_detail_fact(feed)
    for columns in (windows.SKU_IN, windows.PROVINCE_IN, ["coupon_id", "date_id", "id"]):
        some = facts.order_detail_fact(feed, columns=columns)
        assert some.columns == columns
        assert some.exceptAll(whole.select(*columns)).count() == 0 and whole.select(*columns).exceptAll(some).count() == 0
    feed.unpersist()
    base = {"order_id": "o", "sku_id": "9", "source_id": "9", "sku_num": "1", "order_price": "5", "split_original_amount": "9", "split_activity_amount": "0", "split_coupon_amount": "0"}
    rec = lambda table, after: (None, after, {"db": "d", "table": table}, "c", 1000, 0)
    rows = [rec("order_detail", base | {"id": "1", "sku_name": n, "create_time": c, "split_total_amount": v, "order_id": o})
            for n, c, v, o in [("b", "1", "3", "o"), ("a", "2", "9", "o"), ("b", "0", "7", "o"), ("z", "9", "99", "n")]]
    rows += [rec("order_info", {"id": o, "user_id": "u", "province_id": "p"}) for o in "on"]
    tied = spark.createDataFrame(rows, cdc.ENVELOPE)
    for columns in (facts.ORDER_DETAIL_COLS, windows.SKU_IN):
        assert [r.split_total_amount for r in facts.order_detail_fact(tied, columns=columns).collect()] == ["3"]
    from martflow.plans.catalog import QUERIES
    p = plan(QUERIES["sku_order_window"](spark, "/root/testdata/sf0.001"))
    above = p[:p.index("REPARTITION_BY_COL")]
    assert "hashpartitioning(et" in above and "hashpartitioning(window" not in above


def test_change_rows_are_summed_where_they_lie(spark):
    """Change rows hold their order's id, by which the join has dealt them out: no shuffle for their sums, and no numbers beside the texts in the one by id."""
    t = Tables(spark, "/root/testdata/sf0.001")
    feed = retail.ods(t, ("order_detail", "order_info", "order_detail_activity", "order_detail_coupon"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(facts.order_detail_changes(feed))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert p.index("Join") < p.index("Exchange") and p.count("REPARTITION_BY_COL") == 1
    assert "replay_order" not in p[p.index("REPARTITION_BY_COL"):]
