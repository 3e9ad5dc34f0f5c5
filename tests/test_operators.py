"""Edge cases of single operators on tiny literal fixtures (FIXTURES.md 5)."""

import hashlib
from decimal import Decimal

from pyspark.sql import functions as F

from martflow.functions import dates, keys, strings
from martflow.operators import cdc, dims, facts, logsplit, misc, routing, state, text
from martflow.sources import cdc as cdc_src

ENV = "before map<string,string>, after map<string,string>, source map<string,string>, op string, ts_ms bigint"


def env(spark, rows):
    return spark.createDataFrame(rows, ENV)


def src(t):
    return {"db": "stream_retail", "table": t}


def test_null_after_missing_key_and_delete_image(spark):
    df = env(spark, [(None, None, src("x"), "c", 1),
                     ({"id": "1", "n": "a"}, None, src("x"), "d", 2),
                     (None, {"id": "2"}, src("x"), "c", 3)])
    got = cdc.change_image(df).select(F.col("data")["id"].alias("id"), F.col("data")["n"].alias("n")).collect()
    assert [(r.id, r.n) for r in got] == [(None, None), ("1", "a"), ("2", None)]
    gated = cdc.cdc_gate(df, "stream_retail").select("op").collect()
    assert [r.op for r in gated] == ["d", "c"]  # Q4: the delete passes on its before image


def test_parse_json_diverts_dirty_text(spark):
    from martflow.sources.applog import LOG_SCHEMA
    raw = spark.createDataFrame([('{"common":{"mid":"m"},"ts":1}',), ("not json",), ('{"ts":',), (None,)],
                                "value string")
    good, bad = cdc_src.parse_json(raw, LOG_SCHEMA)
    assert good.count() == 1
    assert sorted(r.value for r in bad.collect()) == sorted(['{"ts":', "not json"])


def test_parse_cdc_drops_bootstrap_ops(spark):
    raw = spark.createDataFrame([('{"op":"bootstrap-insert","ts_ms":1}',), ('{"op":"c","ts_ms":2,"after":{"a":9.90}}',)],
                                "value string")
    good, _ = cdc_src.parse_cdc(raw)
    rows = good.collect()
    assert len(rows) == 1 and rows[0].after == {"a": "9.9"}


def test_log_split_edges(spark):
    lines = [
        '{"common":{"mid":"m1","is_new":"1","sid":"a"},"start":{"entry":"icon"},"err":{"error_code":1},"ts":1000}',
        '{"common":{"mid":"m1","is_new":"1","sid":"b"},"page":{"page_id":"home"},"displays":[],"ts":2000}',
        '{"common":{"mid":"m1","is_new":"1","sid":"c"},"page":{"page_id":"home"},'
        '"displays":[{"item":"7"},{"item":"8"}],"actions":[{"action_id":"x"}],"ts":3000}',
        "garbage",
    ]
    raw = spark.createDataFrame([(v,) for v in lines], "value string")
    out = logsplit.split_log(raw)
    assert out["err"].count() == 1 and out["err"].first().start is not None
    assert out["start"].count() == 1 and "err" not in out["start"].columns
    assert out["display"].count() == 2
    assert out["action"].count() == 1 and "ts" not in out["action"].columns
    assert out["page"].count() == 2
    assert out["dirty"].count() == 1


def test_repair_is_new_first_record_old_visitor(spark):
    df = spark.createDataFrame([
        (1, "m", "2024-01-01 10:00:00", "0"), (2, "m", "2024-01-01 11:00:00", "1"),
        (3, "n", "2024-01-01 10:00:00", "1"), (4, "n", "2024-01-01 23:00:00", "1"),
        (5, "n", "2024-01-02 01:00:00", "1")], "event_id long, mid string, ts string, is_new string") \
        .withColumn("ts", F.to_timestamp("ts"))
    got = {r.event_id: r.is_new for r in state.repair_is_new(df, "mid", "ts", ["event_id"]).collect()}
    assert got == {1: "0", 2: "0", 3: "1", 4: "1", 5: "0"}


def test_first_of_day_across_midnight(spark):
    df = spark.createDataFrame([
        (1, "m", "2024-01-01 23:59:59"), (2, "m", "2024-01-02 00:00:01"), (3, "m", "2024-01-02 08:00:00")],
        "event_id long, mid string, ts string").withColumn("ts", F.to_timestamp("ts"))
    flags = {r.event_id: r.uv_ct for r in state.flag_first_of_day(df, "mid", "ts", ["event_id"]).collect()}
    assert flags == {1: 1, 2: 1, 3: 0}
    firsts = sorted(r.event_id for r in state.first_of_day(df, "mid", "ts", ["event_id"]).collect())
    assert firsts == [1, 2]


def test_login_flags_back_after_eight_days(spark):
    df = spark.createDataFrame([
        (1, "u", "2024-01-01 10:00:00"), (2, "u", "2024-01-01 12:00:00"), (3, "u", "2024-01-09 09:00:00"),
        (4, "u", "2024-01-10 09:00:00")], "event_id long, uid string, ts string").withColumn("ts", F.to_timestamp("ts"))
    got = {r.event_id: (r.uu_ct, r.back_ct) for r in state.login_flags(df, "uid", "ts", ["event_id"]).collect()}
    assert got == {1: (1, 0), 3: (1, 1), 4: (1, 0)}


def test_retract_same_id_three_times_and_negation(spark):
    df = spark.createDataFrame([
        ("a", 1, Decimal("10.00")), ("a", 2, Decimal("-5.00")), ("a", 3, None), ("b", 1, Decimal("1.00"))],
        "id string, seq int, amt decimal(10,2)")
    rows = state.retract_duplicates(df, "id", ["seq"], ["amt"], sign_col="sign").collect()
    got = sorted((r.id, r.seq, r.sign, r.amt) for r in rows)
    assert got == sorted([("a", 1, 1, Decimal("10.00")), ("a", 1, -1, Decimal("-10.00")),
                          ("a", 2, 1, Decimal("-5.00")), ("a", 2, -1, Decimal("5.00")),
                          ("a", 3, 1, None), ("b", 1, 1, Decimal("1.00"))])
    last = {r.id: r.seq for r in state.keep_latest(df, "id", ["seq"]).collect()}
    assert last == {"a": 3, "b": 1}


def test_quantity_increased_equal_lower_null(spark):
    df = env(spark, [({"n": "2"}, {"n": "2"}, src("cart_info"), "u", 1),
                     ({"n": "3"}, {"n": "2"}, src("cart_info"), "u", 2),
                     ({"id": "x"}, {"n": "2"}, src("cart_info"), "u", 3),
                     ({"n": "1"}, {"n": "4"}, src("cart_info"), "u", 4),
                     (None, {"n": "5"}, src("cart_info"), "c", 5)])
    got = cdc.quantity_increased(df, "n").select("ts_ms", cdc.quantity_delta("n").alias("d")).collect()
    assert [(r.ts_ms, r.d) for r in got] == [(4, "3"), (5, "5")]


def test_latest_config_and_dimension_fold(spark):
    cfg = spark.createDataFrame([("r", 1, "a", "x"), ("u", 2, "a", "y"), ("r", 1, "b", "x"), ("d", 3, "b", "x")],
                                "op string, ts_ms bigint, source_table string, sink_table string")
    got = [(r.source_table, r.sink_table) for r in state.latest_config(cfg, "source_table").collect()]
    assert got == [("a", "y")]
    rows = spark.createDataFrame([
        ("k", 1, "c", "n1", "s1"), ("k", 2, "u", "n2", ""), ("k", 3, "u", None, "s3"),
        ("j", 1, "c", "n1", "s1"), ("j", 2, "d", None, None), ("j", 3, "c", "n9", None),
        ("z", 1, "c", "n1", "s1"), ("z", 2, "d", None, None)],
        "id string, seq int, op string, name string, seg string")
    got = {r.id: (r.name, r.seg) for r in state.fold_dimension(rows, "id", ["name", "seg"], "seq", "op").collect()}
    assert got == {"k": ("n2", "s3"), "j": ("n9", None)}


def test_route_dims_config_after_data_and_pruning(spark):
    ods = env(spark, [(None, {"id": "1", "a": "x", "b": "y"}, src("t1"), "r", 10),
                      (None, {"id": "2", "a": "q"}, src("t9"), "r", 10)])
    cfg = spark.createDataFrame([("r", 50, "t1", "dim_t1", "id,a", "info", "id")],
                                "op string, ts_ms bigint, source_table string, sink_table string, "
                                "sink_columns string, sink_family string, sink_row_key string")
    r = routing.fold_routed_dims(routing.route_dims(ods, cfg))
    assert sorted((x.row_key, x.column, x.value) for x in r.collect()) == [("1", "a", "x"), ("1", "id", "1")]


def test_province_lookup_missing_key(spark):
    g = spark.createDataFrame([("1",), ("99",)], "province_id string")
    p = spark.createDataFrame([("1", "P1")], "id string, name string")
    got = {r.province_id: r.province_name for r in dims.with_province(g, p).collect()}
    assert got == {"1": "P1", "99": None}


def test_event_day_seconds_millis_garbage(spark):
    df = spark.createDataFrame([("1704067200",), ("1704067200000",), ("abc",), (None,)], "v string")
    got = [r.day for r in misc.with_event_day(df, "v").collect()]
    assert got == ["20240101", "20240101", "error_bucket", "error_bucket"]


def test_hash_bucket_matches_md5_rule(spark):
    df = spark.createDataFrame([(k,) for k in ["0", "12", "abc", "0xDEAD"]], "k string")
    ov = spark.createDataFrame([("0xdead", "9001")], "key_lower string, bucket string")
    got = {r.k: r.bucket for r in keys.with_hash_bucket(df, "k", 128, "bucket", ov).collect()}
    for k in ["0", "12", "abc"]:
        assert got[k] == "%04d" % (int(hashlib.md5(k.encode()).hexdigest()[-3:], 16) % 128)
    assert got["0xDEAD"] == "9001"


def test_dates_and_strings(spark):
    row = spark.range(1).select(
        dates.ms_to_date(F.lit(1704067200123)).alias("d"), dates.ms_to_datetime(F.lit(1704067200123)).alias("dt"),
        dates.flexible_date(F.lit("1704067200123")).alias("f1"), dates.flexible_date(F.lit("2024-01-05 10:00:00")).alias("f2"),
        strings.upper_first(F.lit("hello world")).alias("u"), strings.is_blank(F.lit("  ")).alias("b"),
        strings.charset_match(F.lit("中文ab【】")).alias("c1"), strings.charset_match(F.lit("a b")).alias("c2")).first()
    assert (row.d, row.dt, row.f1, row.f2) == ("2024-01-01", "2024-01-01 00:00:00", "2024-01-01", "2024-01-05")
    assert (row.u, row.b, row.c1, row.c2) == ("Hello world", True, True, False)


def test_tokens_titles_and_word_flags(spark):
    df = spark.createDataFrame([("Hello, World 42 中文词",), ("!!!",)], "text string")
    toks = [r.keyword for r in text.explode_keywords(df, "text").collect()]
    assert toks == ["hello", "world", "42", "中文词"]
    pages = spark.createDataFrame([(1, '<span class="title">A</span><span class="title">B / C</span>')],
                                  "page_id long, html string")
    assert [(r.pos, r.title) for r in text.page_titles(pages).collect()] == [(0, "A")]
    words = spark.createDataFrame([("a",), ("b",), ("a",)], "w string")
    wl = spark.createDataFrame([("a",)], "word string")
    assert {r.word: r.listed for r in text.flag_words(words, "w", wl).collect()} == {"a": True, "b": False}


def test_event_time_fallbacks_and_topic_tables(spark):
    from martflow.operators import windows as W
    df = spark.createDataFrame([(None, 1704067200), (1704067201, 5)], "block_timestamp long, timestamp long")
    got = [str(r.et) for r in W.event_time_from(df, ["block_timestamp", "timestamp"]).collect()]
    assert got == ["2024-01-01 00:00:00", "2024-01-01 00:00:01"]
    b = spark.createDataFrame([([{"window_start_time": 1704067200}],)], "items array<struct<window_start_time:long>>")
    assert str(W.batch_event_time(b, "items").first().et) == "2024-01-01 00:00:00"
    v = spark.createDataFrame([('{"common":{"mid":"m","is_new":"1"},"page":{"page_id":"home","during_time":12},'
                                '"ts":1704067200123}',)], "value string")
    table, bad = cdc_src.page_topic_table(v)
    r = table.first()
    assert bad.count() == 0
    assert (r.mid, r.page_id, r.during_time, r.ts_ms) == ("m", "home", 12, 1704067200123)
    f = spark.createDataFrame([('{"id":"1","order_id":"9","ts_ms":5}',)], "value string")
    table, bad = cdc_src.fact_topic_table(f, ["id", "order_id", "ts_ms"])
    r = table.first()
    assert bad.count() == 0
    assert (r.id, r.order_id, r.ts_ms) == ("1", "9", 5)


def test_camel_columns_and_positional_rename(spark):
    df = spark.createDataFrame([(1, 2)], "sink_table int, sink_row_key int")
    assert strings.camel_columns(df).columns == ["sinkTable", "sinkRowKey"]
    assert cdc.rename_positional(df, ["a", "b"]).columns == ["a", "b"]


# -- replayed records ---------------------------------------------------------

def _feed(spark, rows):
    """(table, op, after, ts_ms, pos) -> change feed."""
    return spark.createDataFrame(
        [(None, after, {"db": "d", "table": t}, op, ts, pos) for t, op, after, ts, pos in rows],
        "before map<string,string>, after map<string,string>, source map<string,string>, op string, ts_ms long, pos long")


def test_retract_exact_replay_sums_to_last(spark):
    df = spark.createDataFrame([("a", 1, 10.0), ("a", 1, 10.0), ("b", 1, 1.0), ("b", 2, 5.0), ("b", 2, 5.0), (None, 1, 2.0)],
                               "id string, seq int, amt double")
    out = state.retract_duplicates(df, "id", ["seq"], ["amt"], sign_col="sign")
    sums = {r["id"]: r["s"] for r in out.groupBy("id").agg(F.sum("amt").alias("s")).collect()}
    assert sums["a"] == 10.0 and sums["b"] == 5.0
    assert out.where("id = 'a' and sign = 1").count() == 2 and out.where("id = 'a' and sign = -1").count() == 1


def test_order_detail_takes_last_order_and_last_link(spark):
    line = {"id": "7", "order_id": "1", "sku_id": "3", "create_time": "1700000000000", "sku_num": "1", "order_price": "2"}
    ods = _feed(spark, [
        ("order_detail", "c", line, 10, 0),
        ("order_info", "c", {"id": "1", "user_id": "9", "province_id": "3"}, 10, 0),
        ("order_info", "c", {"id": "1", "user_id": "10", "province_id": "4"}, 20, 0),
        ("order_detail_activity", "c", {"order_detail_id": "7", "activity_id": "9", "activity_rule_id": "9"}, 11, 1),
        ("order_detail_activity", "c", {"order_detail_id": "7", "activity_id": "10", "activity_rule_id": "8"}, 11, 2),
        ("order_detail_coupon", "c", {"order_detail_id": "7", "coupon_id": "5"}, 11, 0),
        ("order_detail_coupon", "c", {"order_detail_id": "7", "coupon_id": "5"}, 11, 0),
        ("order_detail_coupon", "c", {"order_detail_id": "unknown", "coupon_id": "5"}, 11, 0),
    ])
    rows = facts.order_detail_fact(ods).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.user_id, r.province_id, r.activity_id, r.activity_rule_id, r.coupon_id) == ("10", "4", "10", "8", "5")


def test_delete_and_insert_in_one_millisecond(spark):
    cfg = spark.createDataFrame([("r", 1, "t", "dim_t", "id,v", "info", "id")],
                                "op string, ts_ms long, source_table string, sink_table string, sink_columns string, sink_family string, sink_row_key string")
    ods = _feed(spark, [("t", "c", {"id": "1", "v": "old"}, 5, 1), ("t", "d", None, 9, 2), ("t", "c", {"id": "1", "v": "a"}, 9, 3)])
    ods = ods.withColumn("before", F.when(F.col("op") == "d", F.create_map(F.lit("id"), F.lit("1"))))
    got = {(r["column"], r["value"]) for r in routing.fold_routed_dims(routing.route_dims(ods, cfg)).collect()}
    assert got == {("id", "1"), ("v", "a")}


def test_replayed_facts_keep_one_row(spark):
    ods = _feed(spark, [("comment_info", "r", {"id": "1", "appraise": "1201", "comment_txt": "x"}, 5, 0),
                        ("comment_info", "r", {"id": "1", "appraise": "1201", "comment_txt": "y"}, 5, 1),
                        ("cart_info", "c", {"id": "4", "sku_num": "2"}, 5, 0), ("cart_info", "c", {"id": "4", "sku_num": "2"}, 5, 0)])
    dic = spark.createDataFrame([("1201", "good")], "dic_code string, dic_name string")
    assert [r.comment_txt for r in facts.comment_fact(ods, dic).collect()] == ["y"]
    assert facts.cart_add_fact(ods).count() == 1


def test_tokens_of_any_script_and_dictionary(spark):
    df = spark.createDataFrame([("Größe élan 中文分词 x2, naïve!",)], "t string")
    assert df.select(text.tokens("t").alias("x")).first().x == ["größe", "élan", "中文分词", "x2", "naïve"]
    got = df.select(text.tokens("t", ["中文", "分词", "中"]).alias("x")).first().x
    assert got == ["größe", "élan", "中文", "分词", "x2", "naïve"]
    got = df.select(text.tokens("t", ["文分", "中文分"]).alias("x")).first().x
    assert got == ["größe", "élan", "中文分", "词", "x2", "naïve"]


def test_retraction_of_many_copies_needs_no_long_array(spark, monkeypatch):
    monkeypatch.setattr(state, "COPIES", 8)
    df = spark.createDataFrame([("a", 1, 5)] * 53 + [("a", 2, 7)] * 17 + [("b", 1, 1)], "id string, ts long, amt long")
    got = {(r.id, r.ts, r.sign): r.n for r in state.retract_duplicates(df, "id", ["ts"], ["amt"], sign_col="sign")
           .groupBy("id", "ts", "sign").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == {("a", 1, 1): 53, ("a", 1, -1): 53, ("a", 2, 1): 17, ("a", 2, -1): 16, ("b", 1, 1): 1}
