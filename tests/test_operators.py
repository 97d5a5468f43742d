import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell import schemas
from tidewell.operators import changes, dedup, joins, logs, merges, moderation, shapes, visits
from tidewell.plans import jobs
from tidewell.sources import changes as cdc
from tidewell.sources import dims

DAY = 86_400_000


def envelopes(spark, *rows):
    """Rows of (table, op, before, after, ts_ms)."""
    data = [(b, a, {"db": "shop", "table": t}, op, ts) for t, op, b, a, ts in rows]
    return spark.createDataFrame(data, schemas.ENVELOPE)


# --- changes --------------------------------------------------------------------------------------


def test_filter_valid(spark):
    df = envelopes(
        spark,
        ("t", "r", None, {"id": "1"}, 1),
        ("t", "x", None, {"id": "2"}, 1),
        ("t", "c", None, {}, 1),
        ("t", "d", {"id": "4"}, None, 1),
    )
    ids = [r.after["id"] for r in changes.filter_valid(df, "shop").collect()]
    assert ids == ["1"]
    assert changes.filter_valid(df, "other").count() == 0
    both = changes.filter_valid(df, "shop", use_before_for_delete=True)
    assert sorted(r.after["id"] for r in both.collect()) == ["1", "4"]


def test_cancel_precedence(spark):
    df = envelopes(
        spark,
        ("order_info", "r", None, {"id": "1", "order_status": "1001"}, 1),
        ("order_info", "u", None, {"id": "2", "order_status": "1001"}, 1),
        ("order_info", "u", None, {"id": "3", "order_status": "1003"}, 1),
        ("other", "c", None, {"id": "4", "order_status": "1003"}, 1),
    )
    assert [r.id for r in changes.cancelled_orders(df).collect()] == ["1"]
    assert sorted(r.id for r in changes.cancelled_orders(df, "reference").collect()) == ["1", "3", "4"]


def test_cart_add_modes(spark):
    df = envelopes(
        spark,
        ("cart_info", "r", None, {"id": "1", "sku_num": "2"}, 1),
        ("cart_info", "u", {"sku_num": "2"}, {"id": "2", "sku_num": "5"}, 1),
        ("cart_info", "u", {"sku_num": "5"}, {"id": "3", "sku_num": "2"}, 1),
        ("cart_info", "c", None, {"id": "4", "sku_num": "1"}, 1),
    )
    assert {r.id: r.sku_num for r in changes.cart_add(df, "snapshot").collect()} == {"1": "2"}
    assert {r.id: r.sku_num for r in changes.cart_add(df).collect()} == {"1": "2", "2": "3", "4": "1"}
    with pytest.raises(ValueError):
        changes.cart_add(df, "both")


def test_typed_cart_defaults(spark):
    df = envelopes(spark, ("cart_info", "u", None, {"id": "1", "sku_num": "x"}, 0))
    row = changes.typed_cart_changes(df).first()
    assert (row.id, row.sku_num, row.is_ordered, row.create_time, row.ds) == (1, 0, 0, None, "19700101")


def test_after_or_before(spark):
    df = envelopes(
        spark, ("o", "u", {"id": "1"}, {"id": "2"}, 5), ("o", "d", {"id": "3"}, None, 6), ("o", "d", {"id": "4"}, {}, 7)
    )
    assert [(r.op, r.tm_ms, r.id) for r in changes.after_or_before(df, ["id"]).collect()] == [
        ("u", 5, "2"), ("d", 6, "3"), ("d", 7, "4"),
    ]


def config(spark, *rows):
    return spark.createDataFrame(rows, schemas.DIM_CONFIG)


def test_route_keeps_configured_fields(spark):
    df = envelopes(
        spark, ("sku", "c", None, {"id": "1", "name": "n", "logo": "x"}, 1), ("spu", "c", None, {"id": "2"}, 1)
    )
    rule = ("sku", "dim_sku", "id,name", "info", "id", "r")
    row = changes.route(df, config(spark, rule)).collect()
    assert [(r.sink_table, r.row_key, r.data) for r in row] == [("dim_sku", "1", {"id": "1", "name": "n"})]
    # No trimming: a blank belongs to the name.
    spaced = ("sku", "dim_sku", "id, name", "info", "id", "r")
    assert changes.route(df, config(spark, spaced)).first().data == {"id": "1"}


def test_route_with_and_without_named_tables(spark):
    df = envelopes(spark, ("sku", "c", None, {"id": "1"}, 1), ("spu", "c", None, {"id": "2"}, 1))
    rule = ("sku", "dim_sku", "id", "info", "id", "r")
    for tables in (None, ["sku"]):
        assert [r.row_key for r in changes.route(df, config(spark, rule), tables).collect()] == ["1"]
    assert changes.route(df, config(spark, rule), ["spu"]).count() == 0


def test_current_config(spark):
    def rule(table, sink):
        return {"source_table": table, "sink_table": sink}

    df = envelopes(
        spark,
        ("cfg", "r", None, rule("a", "dim_a"), 1),
        ("cfg", "u", rule("a", "dim_a"), rule("a", "dim_a2"), 2),
        ("cfg", "c", None, rule("b", "dim_b"), 3),
        ("cfg", "d", rule("b", "dim_b"), None, 4),
    )
    now = changes.current_config(df, ["source_table", "sink_table"]).collect()
    assert [(r.source_table, r.sink_table) for r in now] == [("a", "dim_a2")]


def test_snapshot_envelopes_read_back(spark):
    df = spark.createDataFrame([(1, "x"), (2, None)], "id int, name string")
    sent = cdc.envelope_messages(cdc.snapshot_envelopes(df, "shop", "t", F.lit(9)))
    got = cdc.change_view(sent).collect()
    assert [(r.op, r.ts_ms, r.after["id"], r.after.get("name"), r.source["table"]) for r in got] == [
        ("r", 9, "1", "x", "t"), ("r", 9, "2", None, "t"),
    ]


# --- logs -----------------------------------------------------------------------------------------


def test_dirty_records(spark):
    trailing = ['{"ts":1} trailing', '{"ts":1}{', '{"ts":1},{"ts":2}', '{"ts":1}] x', '{"ts":']
    texts = ['{"ts": 1}', '{"ts": "2"}', "{bad", "[1]", "7", "", None, ' \n{"ts":3}', '{"common": 5}', *trailing]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    good, dirty = logs.parse_logs(df)
    assert sorted(r.ts for r in good.collect()) == [1, 2, 3]
    assert sorted(r.value for r in dirty.collect()) == sorted(["{bad", "[1]", "7", "", '{"common": 5}', *trailing])


def test_nesting_decides_what_is_dirty(spark):
    shape = T.StructType.fromDDL("k string, n struct<x: string, m: struct<y: bigint>>, l array<struct<z: string>>")
    good = ['{"k":1}', ' {"n":{"x":null,"m":{"y":"7"}}} ', '{"l":[{"z":"a"},null]}', '{"n":null,"l":null}', '{"other":{"k":1}}']
    bad = ['{"n":5}', '{"n":{"m":"s"}}', '{"n":[1]}', '{"l":{"z":1}}', '{"l":[{"z":"a"},5]}', '{"k":1},0', '{"k":1,"k":2}', "null", "0"]
    df = spark.createDataFrame([(t,) for t in good + bad], "value string")
    parsed, dirty = logs.parse_or_dirty(df, shape)
    assert parsed.count() == len(good) and sorted(r.value for r in dirty.collect()) == sorted(bad)
    assert [r.n.m.y for r in parsed.filter("n IS NOT NULL").collect()] == [7]
    plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1 and "from_json" not in plan, plan


def test_failing_parse(spark):
    df = spark.createDataFrame([('{"ts": 1}',), ("{bad",)], "value string")
    schema = T.StructType([T.StructField("ts", T.LongType())])
    assert logs.parse_or_dirty(df.limit(1), schema, fail=True)[0].count() == 1
    with pytest.raises(Exception, match="not a record"):
        logs.parse_or_dirty(df, schema, fail=True)[0].collect()


def test_split_of_one_record_with_everything(spark):
    views = (
        '{"common":{"mid":"m"},"page":{"page_id":"home"},"err":{"error_code":"1"},'
        '"displays":[{"item":"1"},{"item":"2"}],"actions":[{"item":"3"}],"ts":5}'
    )
    start = '{"common":{"mid":"m"},"start":{"entry":"icon"},"displays":[{"item":"9"}],"ts":6}'
    good, _ = logs.parse_logs(spark.createDataFrame([(views,), (start,)], "value string"))
    split = logs.split_logs(good)
    assert {k: v.count() for k, v in split.items()} == {"err": 1, "start": 1, "page": 1, "display": 2, "action": 1}
    assert split["err"].first().displays is not None
    assert "err" not in split["page"].columns and "displays" not in split["page"].columns
    assert "ts" in split["display"].columns and "ts" not in split["action"].columns


def test_null_stay_counts_as_zero(spark):
    from tidewell.plans import summaries

    text = '{{"common":{{"mid":"m","vc":"1","ch":"1","ar":"1","is_new":"0"}},"page":{{"page_id":"home"{}}},"ts":{}}}'
    rows = [(text.format("", 1000),), (text.format(',"during_time":7', 2000),)]
    good, _ = logs.parse_logs(spark.createDataFrame(rows, "value string"))
    row = summaries.traffic_page_view(good).first()
    assert (row.uv_ct, row.sv_ct, row.pv_ct, row.dur_sum, row.stt) == (1, 2, 2, 7, "1970-01-01 00:00:00")


# --- state ----------------------------------------------------------------------------------------


def visits_of(spark, *ts):
    return spark.createDataFrame([("u", t) for t in ts], "uid string, ts bigint")


def test_return_after_eight_days(spark):
    # The seventh day's last moment is no return; the eighth day counts from midnight of the last date.
    got = visits.return_logins(visits_of(spark, DAY // 2, 8 * DAY - 1, 16 * DAY - DAY)).orderBy("ts").collect()
    assert [(r.login_date, r.back_ct) for r in got] == [("1970-01-01", 0), ("1970-01-08", 0), ("1970-01-16", 1)]


def test_first_of_day_takes_the_earliest_row(spark):
    df = spark.createDataFrame(
        [("u", 500, 2, "late"), ("u", 500, 1, "first"), ("u", 400 + DAY, 3, "next")], "k string, ts bigint, n int, v string"
    )
    got = visits.first_of_day(df, ["k"], "ts", ["n"], ["v"]).orderBy("ts").collect()
    assert [r.v for r in got] == ["first", "next"]


def logs_of(spark, *rows):
    data = [((m, n), t) for m, n, t in rows]
    return spark.createDataFrame(data, "common struct<mid:string,is_new:string>, ts bigint")


@pytest.mark.parametrize(
    "rows, flags",
    [
        ([("1", 0), ("1", 10), ("1", DAY)], ["1", "1", "0"]),
        ([("0", 0), ("1", 10), ("1", DAY)], ["0", "0", "0"]),
        ([("1", 0), ("0", 10), ("1", 20)], ["1", "0", "1"]),
    ],
)
def test_fix_is_new(spark, rows, flags):
    df = logs_of(spark, *[("m", n, t) for n, t in rows])
    assert [r.common.is_new for r in visits.fix_is_new(df).orderBy("ts").collect()] == flags


def test_fix_is_new_keeps_rows_without_device(spark):
    assert visits.fix_is_new(logs_of(spark, (None, "1", 0), ("m", "1", 0))).count() == 2


# --- duplicates -----------------------------------------------------------------------------------


def test_retract_sums_to_newest(spark):
    df = spark.createDataFrame(
        [("a", 1, "10.00"), ("a", 2, "12.50"), ("a", 3, "9.00"), ("b", 1, "1.00")], "id string, v int, amount string"
    )
    got = dedup.retract(df, "id", ["v"], ["amount"])
    assert sorted(r.amount for r in got.collect()) == sorted(["10.00", "-10.00", "12.50", "-12.50", "9.00", "1.00"])
    total = got.agg(F.sum(F.col("amount").cast("decimal(16,2)"))).first()[0]
    assert str(total) == "10.00"


def test_retract_takes_ties_back_but_for_one(spark):
    rows = [("a", 5, 10), ("a", 5, 12), ("a", 5, 9), ("b", 1, 7), ("b", 1, 7), ("b", 1, 7), ("c", 1, 4), ("c", 2, 4)]
    df = spark.createDataFrame(rows, "id string, v int, amount int")
    got = dedup.retract(df, "id", ["v"], ["amount"]).groupBy("id").agg(F.sum("amount").alias("s"), F.count("*").alias("n"))
    got = {r.id: (r.s, r.n) for r in got.collect()}
    assert got["a"][0] in (10, 12, 9) and got["a"][1] == 5 and got["b"] == (7, 5) and got["c"] == (4, 3)


def test_retract_keeps_rows_without_key(spark):
    df = spark.createDataFrame([(None, 1, 5), (None, 2, 6)], "id string, v int, amount int")
    assert sorted(r.amount for r in dedup.retract(df, "id", ["v"], ["amount"]).collect()) == [-5, 5, 6]


def test_latest_goes_by_all_order_columns(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 2, 1), ("a", 2, 2)], "id string, ts int, n int")
    assert [(r.ts, r.n) for r in dedup.latest(df, ["id"], ["ts", "n"]).collect()] == [(2, 2)]


def test_bloom_equals_exact_when_sized(spark):
    df = spark.range(2000).select((F.col("id") % 500).alias("k"), (F.col("id") % 7).alias("ts_ms"))
    got = dedup.bloom(df, ["k", "ts_ms"], 1_000_000, 1e-9, shards=4)
    assert got.count() == got.distinct().count() == df.distinct().count()


# --- joins ----------------------------------------------------------------------------------------


def test_interval_bounds_are_included(spark):
    left = spark.createDataFrame([("u", 600_000)], "k string, ts bigint")
    offsets = (-300_001, -300_000, -1, 0, 299_999, 300_000, 300_001)
    right = spark.createDataFrame([("u", 600_000 + o, o) for o in offsets], "k string, ts bigint, o int")
    got = joins.interval_join(left, right, ("k", "k"), "ts", "-5 minutes", "5 minutes", right_columns={"o": "o"})
    assert sorted(r.o for r in got.collect()) == [-300_000, -1, 0, 299_999, 300_000]


def test_interval_join_equals_plain_condition(spark):
    left = spark.range(400).select((F.col("id") % 3).alias("k"), (F.col("id") * 7919 % 100_000).alias("ts"))
    right = left.select("k", (F.col("ts") * 31 % 100_000).alias("ts"))
    got = joins.interval_join(left, right, ("k", "k"), "ts", "-3 seconds", "10 seconds", prefix="r_")
    r = right.select(F.col("k").alias("r_k"), F.col("ts").alias("r_ts"))
    want = left.join(r, F.expr("k = r_k AND r_ts BETWEEN ts - 3000 AND ts + 10000"))
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0 < want.count()


def test_lookup_miss_keeps_the_row(spark):
    df = spark.createDataFrame([("1",), ("9",), (None,)], "k string")
    dim = spark.createDataFrame([("1", "one")], "row_key string, name string")
    assert {r.k: r.n for r in joins.dim_join(df, dim, "k", {"name": "n"}).collect()} == {"1": "one", "9": None, None: None}
    named = joins.dim_join(df, dim, "k", {"name": "n"}, default="N/A")
    assert {r.k: r.n for r in named.collect()} == {"1": "one", "9": "N/A", None: "N/A"}


# --- merges ---------------------------------------------------------------------------------------


def test_dim_merge(spark):
    df = spark.createDataFrame(
        [
            ("1", "a", "x", "c", 1), ("1", "", "y", "u", 2),
            ("2", "b", "x", "c", 1), ("2", None, None, "d", 2),
            ("3", "c", "x", "c", 1), ("3", None, None, "d", 2), ("3", None, "z", "c", 3),
        ],
        "k string, a string, b string, op string, ts bigint",
    )
    got = merges.dim_merge(df, "k", ["a", "b"], ["ts"])
    assert {r.row_key: (r.a, r.b) for r in got.collect()} == {"1": ("a", "y"), "3": (None, "z")}
    # A change of the same time: the delete wins over the put, the greater of two values over the less.
    tied = df.unionAll(spark.createDataFrame([("3", "q", "z", "d", 3), ("1", "zz", "y", "c", 1)], df.schema))
    assert {r.row_key: (r.a, r.b) for r in merges.dim_merge(tied, "k", ["a", "b"], ["ts"]).collect()} == {"1": ("zz", "y")}


def random_changes(spark, n, seed):
    rng = random.Random(seed)
    rows = [
        (rng.choice("abcd"), rng.choice([None, "", "x", "y", "z"]), rng.choice([None, "p", "q"]), rng.choice("cuud"), rng.randrange(20))
        for _ in range(n)
    ]
    return spark.createDataFrame(rows, "k string, a string, b string, op string, ts bigint"), rows


@pytest.mark.parametrize("seed", range(3))
def test_any_split_into_batches_gives_the_same_table(spark, seed):
    """Against a plain fold, and with the changes cut into batches that come in any order, some twice."""
    df, rows = random_changes(spark, 60, seed)
    cut = [df.filter(F.pmod(F.xxhash64(*df.columns, F.lit(seed)), F.lit(4)) == i) for i in (2, 0, 3, 1, 0)]
    for kind in ("dim", "partial"):
        if kind == "dim":
            cells = [merges.dim_cells(d, "k", ["a", "b"], ["ts"]) for d in (df, *cut)]
            keys, value = ["row_key"], merges.dim_values
        else:
            cells = [merges.partial_cells(d, ["k"], ["a", "b"], ["ts"]) for d in (df, *cut)]
            keys, value = ["k"], lambda c: merges.partial_values(c, ["k"])
        whole = {tuple(r) for r in value(cells[0]).collect()}
        table = cells[1]
        for more in cells[2:]:
            table = merges.fold(table.unionByName(more), keys)
        assert {tuple(r) for r in value(table).collect()} == whole
        want = set()
        for k in {r[0] for r in rows}:
            own = [r for r in rows if r[0] == k]
            gone = max((r[4] for r in own if r[3] == "d"), default=-1)
            puts = [r for r in own if r[3] != "d" and (kind == "partial" or r[4] > gone)]

            def last(at):
                found = [(r[4], r[at]) for r in puts if r[at] is not None and (r[at] != "" or kind == "partial")]
                return max(found)[1] if found else None

            if kind == "partial":
                want.add((k, last(1), last(2), max((r[4] for r in puts), default=None)))
            elif puts:
                want.add((k, last(1), last(2)))
        assert whole == {w for w in want if kind == "dim" or w[3] is not None}


def test_tombstones_are_forgotten(spark):
    df = spark.createDataFrame(
        [("1", "a", "c", 1), ("1", None, "d", 2), ("2", "b", "c", 5), ("2", None, "d", 4), ("3", None, "d", 9)],
        "k string, a string, op string, ts bigint",
    )
    cells = merges.dim_cells(df, "k", ["a"], ["ts"])
    assert {r.row_key for r in merges.forget(cells, 5).collect()} == {"2", "3"}
    assert {r.row_key for r in merges.dim_values(merges.forget(cells, 5)).collect()} == {"2"}


def test_partial_update(spark):
    df = spark.createDataFrame(
        [(1, "d", 5, 3, None), (1, "d", 7, None, "n"), (1, "d", 6, 4, "old")], "id int, ds string, ts bigint, a int, b string"
    )
    row = merges.partial_update(df, ["id", "ds"], ["a", "b"], ["ts"]).first()
    assert (row.a, row.b, row.ts) == (4, "n", 7)


def test_upsert_tombstone(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, None), ("b", 1, "y")], "k string, n int, v string")
    assert [r.k for r in merges.upsert_latest(df, ["k"], ["n"], "v").collect()] == ["b"]


def test_delete_by_keys(spark):
    df = spark.createDataFrame([("1",), ("2",)], "row_key string")
    assert [r.row_key for r in merges.delete_by_keys(df, df.limit(1)).collect()] == ["2"]


def test_lookup_finds_one_row(spark):
    df = spark.createDataFrame([("1",), ("2",), (None,)], "k string")
    dim = spark.createDataFrame([("1", "old"), ("1", "zed"), ("3", "c")], "row_key string, name string")
    got = joins.dim_join(df, dim, "k", {"name": "found"}, "none").collect()
    assert {(r.k, r.found) for r in got} == {("1", "zed"), ("2", "none"), (None, "none")} and len(got) == 3


# --- moderation -----------------------------------------------------------------------------------


def comments(spark, *texts):
    rows = [(i, i, "c", 1, "19700101", t) for i, t in enumerate(texts)]
    return spark.createDataFrame(
        rows, "order_id bigint, user_id bigint, info_consignee string, ts_ms bigint, ds string, commentTxt string"
    )


WORDS = ["bad", "ad", "坏", "worse", "𝒳y"]


@pytest.mark.parametrize("more", [0, 5000])
def test_both_checks(spark, more):
    words = spark.createDataFrame([(w,) for w in WORDS] + [(f"none{i}",) for i in range(more)], "word string")
    texts = ["fine,bad", "a bad thing", "fine", "很坏,", "", None, "badly worse,ok", "x𝒳y"]
    got = moderation.ban_list(comments(spark, *texts), words).orderBy("order_id").collect()
    assert [(r.is_violation, r.violation_grade, r.violation_msg) for r in got] == [
        (1, "P0", "bad"),
        (0, "P1", "bad, ad"),
        (0, "", ""),
        (0, "P1", "坏"),
        (0, "", ""),
        (0, "", ""),
        (0, "P1", "bad, ad, worse"),
        (0, "P1", "𝒳y"),
    ]


@pytest.mark.parametrize("count", [1, 5000])
def test_long_texts_are_checked_to_the_end(spark, monkeypatch, count):
    monkeypatch.setattr(moderation, "PIECE", 4096)
    listed = (["needle", "x", "\U0001d4b3y"] + [f"other{i}" for i in range(count)])[:count]
    words = spark.createDataFrame([(w,) for w in listed], "word string")
    # Words across a cut and at the very end, behind characters beyond the basic plane.
    texts = ["." * 4093 + "needle" + "." * 50, "." * 20_000 + "needle", "." * 9_000, "\U0001d4b3" * 2000 + "." * 2000 + "needle"]
    texts += ["\U0001d4b3" * 50 + "." * 4043 + "needle", "." * 4095 + "\U0001d4b3y", ".x.\U0001d4b3y" * 3000, "needl", None, ""]
    got = moderation.ban_list(comments(spark, *texts), words).orderBy("order_id").collect()
    for text, row in zip(texts, got):
        found = sorted((text.find(w), w) for w in listed if w in (text or "")) if text else []
        assert row.violation_msg == ", ".join(w for _, w in found)


def test_words_check(spark):
    words = spark.createDataFrame([("bad",), ("bad",)], "word string")
    asked = spark.createDataFrame([("bad",), ("good",), ("",)], "word string")
    assert {r.word: r.banned for r in moderation.words_check(asked, words).collect()} == {"bad": True, "good": False, "": False}


# --- shapes, dims, labels ---------------------------------------------------------------------------


def test_snake_json(spark):
    df = spark.createDataFrame([("a", None, 3)], "curDate string, provinceName string, tsMs int")
    assert shapes.to_snake_json(df, hidden=["tsMs"]).first().value == '{"cur_date":"a"}'


def test_dims(spark, tmp_path):
    df = spark.createDataFrame([(2, "b"), (1, "a"), (10, "c")], "id int, tm_name string")
    dim = dims.as_dim(df, "id", {"tm_name": "tm_name"})
    assert dims.get_row(dim, "1", camel=True).columns == ["rowKey", "tmName"]
    assert dims.get_row(dim, "7").count() == 0
    assert [r.row_key for r in dims.scan(dim, 2).collect()] == ["1", "10"]
    assert dims.count_rows(dim).first().row_count == 3
    (tmp_path / "words.txt").write_text("one\n\n two \n")
    assert [r.word for r in dims.word_list(spark, str(tmp_path / "words.txt")).collect()] == ["one", "two"]


def test_user_without_gender_or_image(spark):
    df = envelopes(
        spark,
        ("user_info", "r", None, {"id": "1", "birthday": "12477"}, 1),
        ("user_info", "d", {"id": "2"}, None, 1),
        ("user_info", "r", None, {"id": ""}, 1),
    )
    row = jobs.user_profiles(df, F.lit("2023-02-28").cast("date")).collect()
    assert [(r.uid, r.gender, r.birthday, r.age, r.decade, r.zodiac_sign) for r in row] == [
        ("1", "home", "2004-02-29", 18, 2000, "双鱼座")
    ]


def test_bloom_filters_stay_small():
    assert dedup.filter_shards(1_000, 0.01, 8) == 8
    for expected in (10**9, 10**12):
        per_shard = -(-expected // dedup.filter_shards(expected, 1e-9, 8))
        # A share is rounded up to whole combinations, so by some bytes.
        assert len(dedup.Bloom.sized(per_shard, 1e-9).dump()) <= dedup.FILTER_BYTES + 8


def test_banned_word_filter_grows_with_the_list(spark, monkeypatch):
    assert moderation.filter_bits(0) == moderation.filter_bits(100_000) == moderation.LEAST_BITS
    assert moderation.filter_bits(1 << 20) == 25 and moderation.filter_bits(1 << 40) == moderation.MOST_BITS
    words = [f"w{i}" for i in range(3000)] + ["ä日", "𝄞"]
    listed = spark.createDataFrame([(w,) for w in words], "word string").repartition(3)
    monkeypatch.setattr(moderation, "LEAST_BITS", 16)
    lengths, size, bits = moderation._filter_of(listed)
    assert lengths == [1, 2, 3, 4, 5] and size == 17 and len(bits) == (1 << 17) // 8
    for w in words:
        codes = moderation._codes(w)
        assert len(moderation._passing(bits, moderation._hashes(codes, len(codes), *moderation._sums(codes), size))) == 1
    assert 2000 < np.unpackbits(bits).sum() <= len(words)
    assert moderation._filter_of(listed.filter("false"))[0] == []


def test_banned_words_are_found_in_small_batches(spark, monkeypatch):
    """Candidates leave a task as they come, also within a text, and words are found once with their first place."""
    monkeypatch.setattr(moderation, "CANDIDATES", 4)
    monkeypatch.setattr(moderation, "TEXTS", 3)
    monkeypatch.setattr(moderation, "PIECE", 16)
    monkeypatch.setattr(moderation, "LEAST_BITS", 4)
    monkeypatch.setattr(moderation, "MOST_BITS", 4)
    monkeypatch.setattr(moderation, "BLOCK", 8)
    words = ["ab", "bca", "cabca", "ä日", "dd"]
    rng = random.Random(3)
    texts = ["".join(rng.choice("abcdä日") for _ in range(n)) for n in (0, 1, 5, 17, 40, 200, 90, 33)]
    df = spark.createDataFrame(list(enumerate(texts)), "k long, msg string").coalesce(1)
    listed = spark.createDataFrame([(w,) for w in words], "word string")
    got = {r["_k_k"]: r["_found"] for r in moderation._found(df, listed, ["k"]).collect()}
    want = {k: [w for _, w in sorted((t.index(w), w) for w in words if w in t)] for k, t in enumerate(texts)}
    assert got == {k: w for k, w in want.items() if w} and len(got) > 3


def test_order_detail_on_nulls_and_repeats(spark):
    """Lines, orders, activities and coupons that repeat multiply, as in plain joins; nulls match nothing."""
    names = "id order_id sku_id sku_name create_time source_id source_type sku_num split_total_amount split_activity_amount split_coupon_amount ts_ms split_original_amount"

    def line(i, order, n):
        return (i, order, f"s{n}", f"name{n}", "1704067200000", "1", "x", "2", "3", "4", "5", n, "6")

    lines = [line(f"l{n % 9}", f"o{n % 5}", n % 13) for n in range(40)]
    lines += [line(None, "o1", 90), line(None, "o1", 90), line(None, None, 91), line("l1", None, 92), line("o1", "o2", 93), line("l0", "none", 94)]
    orders = [(f"o{n}", f"u{n}", "p1", n) for n in range(4)] + [("o1", "u1", "p1", 7), ("o1", "u1", "p1", 7), ("o2", None, "p2", 8), (None, "u", "p", 9)]
    activities = [(f"l{n}", f"a{n}", "r", n) for n in range(5)] + [("l1", "a1", "r", 1), ("l1", "b", None, 1), (None, "c", "r", 1), ("o1", "d", "r", 2)]
    coupons = [("l1", "k", 1), ("l1", "k", 1), ("l7", None, 1), (None, "k", 1)]
    text = " string, ".join(names.split()).replace("ts_ms string", "ts_ms long") + " string"
    detail = spark.createDataFrame(lines, text)
    o = spark.createDataFrame(orders, "id string, user_id string, province_id string, ts_ms long")
    a = spark.createDataFrame(activities, "order_detail_id string, activity_id string, activity_rule_id string, ts_ms long")
    c = spark.createDataFrame(coupons, "order_detail_id string, coupon_id string, ts_ms long")
    got = joins.order_detail(detail, o, a, c)
    assert [f.name for f in got.schema][:2] == ["id", "order_id"]
    want = []
    for x in lines:
        for y in orders:
            if x[1] is not None and x[1] == y[0]:
                for z in [z for z in activities if x[0] is not None and z[0] == x[0]] or [(None,) * 4]:
                    for k in [k for k in coupons if x[0] is not None and k[0] == x[0]] or [(None,) * 3]:
                        want.append((x[0], x[1], y[1], x[2], y[2], z[1], z[2], k[1], x[11]))
    columns = "id order_id user_id sku_id province_id activity_id activity_rule_id coupon_id ts_ms".split()
    assert sorted(map(tuple, got.select(*columns).collect()), key=repr) == sorted(want, key=repr) and len(want) > 60
    kept = spark.createDataFrame([("o1", "m", "t", 1), ("o1", "m", "t", 1), (None, "m", "t", 1)], "order_id string, payment_type string, callback_time string, ts_ms long")
    paid = joins.pay_success(kept, got).select("order_detail_id", "order_id").collect()
    assert sorted(map(tuple, paid), key=repr) == sorted(2 * [w[:2] for w in want if w[1] == "o1"], key=repr)
