from pyspark.sql import functions as F

from tidewell import schemas
from tidewell.operators import merges, shapes
from tidewell.session import configure, shared_dir
from tidewell.sources import adapters as ad
from tidewell.sources.streams import file_stream
from tidewell.streaming import runs, sinks


def test_topics_by_row(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "t string, n int")
    path = str(tmp_path)
    for _ in range(2):  # A replay of the same batch replaces what it wrote.
        sinks.write_topic_files(shapes.to_messages(df, F.col("t"), F.col("t")), path, 3)
    got = sinks.read_topic_files(spark, path)
    assert sorted((r.topic, r.value) for r in got.collect()) == [("a", '{"t":"a","n":1}'), ("b", '{"t":"b","n":2}')]


def test_append_table_is_idempotent(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "n int")
    for batch in (0, 1, 1):
        sinks.append_table(df, str(tmp_path), batch)
    assert spark.read.json(str(tmp_path)).count() == 2


def test_kafka_options():
    assert sinks.kafka_options("h:1") == {"kafka.bootstrap.servers": "h:1"}
    assert sinks.kafka_options("h:1", True)["kafka.acks"] == "all"


KEYS = ["id", "ds"]


def carts(spark, *rows):
    df = spark.createDataFrame(rows, "id int, ds string, ts_ms bigint, num int, name string")
    return merges.partial_cells(df, KEYS, ["num", "name"], ["ts_ms"])


def cart_rows(table):
    return {(r.id, r.ds): (r.num, r.name, r.ts_ms) for r in merges.partial_values(table.cells(), KEYS).collect()}


def test_older_changes_may_come_later(spark, tmp_path):
    table = sinks.CellTable(spark, str(tmp_path / "t"), KEYS)
    assert table.cells() is None
    table.add(carts(spark, (1, "20240101", 5, None, "b"), (2, None, 1, 6, None)), 0)
    late = carts(spark, (1, "20240101", 1, 9, "old"))
    for _ in range(2):  # The same batch twice replaces itself.
        table.add(late, 1)
    assert cart_rows(table) == {(1, "20240101"): (9, "b", 5), (2, None): (6, None, 1)}
    table.drop()
    assert table.cells() is None


def test_folders_do_not_pile_up(spark, tmp_path):
    table = sinks.CellTable(spark, str(tmp_path / "t"), KEYS, every=3)
    want, old_plan = {}, None
    for i in range(10):
        table.add(carts(spark, (i % 4, "x", i, i, None), (9, "x", 20 - i, i, "n" if i == 3 else None)), 2 * i)
        want[i % 4, "x"] = (i, None, i)
        if i == 7:
            old_plan, seen = table.cells(), dict(want)
    want[9, "x"] = seen[9, "x"] = (0, "n", 20)
    assert cart_rows(table) == want
    names = [name for _, name in table.folders()]
    assert names == ["upto=6", "batch=8", "batch=10", "upto=12", "batch=14", "batch=16", "upto=18"]
    # A plan from before the last fold still finds its files.
    assert {(r.id, r.ds): (r.num, r.name, r.ts_ms) for r in merges.partial_values(old_plan, KEYS).collect()} == seen


def test_dim_table_from_a_stream(spark, events, tmp_path):
    src = str(tmp_path / "in")
    events.repartition(3).write.parquet(src)
    table = sinks.CellTable(spark, str(tmp_path / "dim"), ["row_key"])
    columns = ["sku_num", "is_ordered"]

    def rows(df):
        made = ad.cart_info(df)
        image = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
        return made.select(image["id"].alias("k"), *[image[c].alias(c) for c in columns], "op", "ts_ms")

    def write(batch, batch_id):
        table.add(merges.dim_cells(batch, "k", columns, ["ts_ms"]), batch_id)

    runs.start_each(rows(file_stream(spark, src, events.schema, max_files=1)), write, str(tmp_path / "cp"), once=True).awaitTermination(120)
    want = merges.dim_merge(rows(events), "k", columns, ["ts_ms"])
    got = merges.dim_values(table.cells())
    assert len(table.folders()) == 3
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0


def test_config_creates_and_drops_tables(spark):
    def apply(op, columns="id,name"):
        row = ("src", "dim_made", columns, "info", "id", op)
        return sinks.apply_dim_config(spark, spark.createDataFrame([row], schemas.DIM_CONFIG))

    apply("r")
    apply("c")
    assert spark.table("dim_made").columns == ["row_key", "id", "name"]
    apply("u", "id")
    assert spark.table("dim_made").columns == ["row_key", "id"]
    apply("d")
    assert not spark.catalog.tableExists("dim_made")


def test_put_rows(spark):
    row = sinks.put_rows(spark.createDataFrame([(1, 2.5)], "id int, v double"), "id").first()
    assert row.asDict() == {"row_key": "1", "v": "2.5", "op": "c"}


def test_shared_dir_is_the_sessions(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_configure(spark):
    assert configure(spark).conf.get("spark.sql.session.timeZone") == "UTC"
