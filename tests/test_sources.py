import datetime as dt
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.operators import report
from silverlode.session import work_folder
from silverlode.sources import csv_load, history, layers, tables
from silverlode.sources.layers import Layer, layer_health, table_health
from silverlode.streaming.report_stream import refresh_report, refresh_state

TARGET = T.StructType(
    [
        T.StructField("ID", T.LongType(), False),
        T.StructField("AMOUNT", T.DecimalType(10, 2)),
        T.StructField("DAY", T.TimestampNTZType()),
        T.StructField("NOTE", T.StringType()),
        T.StructField("EXTRA", T.IntegerType()),
    ]
)
CSV = """day,id,ignored,Amount,note
2024-01-02,1,x,10.50,a
24/12/2024,2,x,,"b, c"
never,3,x,5,d
2024-01-02,x4,x,5,e
2024-01-02,,x,5,f
,6,x,bad,g
Sat 24th of December 2024,7,x,1,h
"""


def _csv(spark):
    path = work_folder(spark, "csv")
    Path(path).mkdir(parents=True)
    (Path(path) / "rows.csv").write_text(CSV)
    return csv_load.read_text_csv(spark, path)


def test_csv_load_rejects_with_reasons(spark):
    load = csv_load.load_csv(_csv(spark), TARGET, {"EXTRA": F.lit(9)})
    good = {r["ID"]: r for r in load.accepted.collect()}
    assert set(good) == {1, 2} and good[1]["EXTRA"] == 9 and good[2]["AMOUNT"] is None
    assert good[2]["DAY"] == dt.datetime(2024, 12, 24) and good[2]["NOTE"] == "b, c"
    reasons = {r["reason"] for r in load.rejected.collect()}
    assert reasons == {
        "DAY: unreadable value never",
        "ID: unreadable value x4",
        "ID: NULL not allowed",
        "AMOUNT: unreadable value bad",
        "DAY: unreadable value Sat 24th of December 2024",
    }
    assert {r["outcome"]: r["rows"] for r in load.counts().collect()} == {"accepted": 2, "rejected": 5}
    assert load.accepted.schema["AMOUNT"].dataType == T.DecimalType(10, 2)


def test_csv_unread_dates(spark):
    rows = _csv(spark)
    kept = {r["ID"]: r["DAY"] for r in csv_load.load_csv(rows, TARGET, unread_dates="null").accepted.collect()}
    assert kept[3] is None and kept[7] is None
    with pytest.raises(ValueError, match="unread_dates"):
        csv_load.load_csv(rows, TARGET, unread_dates="guess")


@pytest.fixture
def small_ranges(spark):
    """Byte ranges of 64 bytes, so that records go over many of them."""
    names = {"spark.sql.files.maxPartitionBytes": "64", "spark.sql.files.openCostInBytes": "1"}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k in names:
        spark.conf.unset(k)


def _random_csv(seed, rows, columns=3, end="\n"):
    rng, out = random.Random(seed), ["a,b,c" + end]
    for _ in range(rows):
        cells = []
        for _ in range(columns + rng.choice([0, 0, 0, 0, -1, 1])):
            kind = rng.random()
            body = "".join(rng.choice(["x", "yz", " ", "é", "1", "," if kind < 0.5 else "-", end if kind < 0.3 else "w", '""' if kind < 0.5 else "q"]) for _ in range(rng.randint(0, 12)))
            cells.append(f'"{body}"' if kind < 0.5 else body + rng.choice(["", "", 'a"b', '"']) if body.strip() else body)
        out.append(",".join(cells) + end + (end if rng.random() < 0.05 else ""))
    return "".join(out)


@pytest.mark.parametrize("seed", range(6))
def test_csv_records_over_ranges(spark, small_ranges, seed):
    """Many tasks cut the records that Spark's reader finds with one task per file."""
    path = work_folder(spark, "csv")
    Path(path).mkdir(parents=True)
    for k in range(2):
        text = _random_csv(seed * 10 + k, 60, end="\r\n" if seed == 5 else "\n")
        (Path(path) / f"{k}.csv").write_bytes((("\ufeff" if seed == 4 else "") + text[: None if seed % 2 else -1]).encode())
    got = csv_load.read_text_csv(spark, path)
    assert got.rdd.getNumPartitions() > 8
    want = csv_load._by_file(spark, path, ["a", "b", "c"], True, True, {})
    plain = lambda df: sorted((tuple(None if x is None else x.replace("\r\n", "\n").strip("\r\n") for x in r) for r in df.collect()), key=repr)
    assert plain(got) == plain(want)


def test_csv_record_over_many_ranges(spark, small_ranges):
    path = work_folder(spark, "csv")
    Path(path).mkdir(parents=True)
    long = "\n".join(f'line {i}, ""{i}""' for i in range(200))
    (Path(path) / "one.csv").write_text(f'a,b,c\n1,"{long}",2\n3,"{long}",4\n5,x,6\n')
    rows = csv_load.read_text_csv(spark, path).collect()
    assert {(r.a, r.b, r.c, r._malformed) for r in rows} == {("1", long.replace('""', '"'), "2", None), ("3", long.replace('""', '"'), "4", None), ("5", "x", "6", None)}


def test_csv_other_separators_and_headers(spark, small_ranges):
    path = work_folder(spark, "csv")
    Path(path).mkdir(parents=True)
    (Path(path) / "one.csv").write_text("a;b\n1;'x\n;y'\n2;z\n")
    rows = csv_load.read_text_csv(spark, path, sep=";", quote="'").collect()
    assert {tuple(r) for r in rows} == {("1", "x\n;y", None), ("2", "z", None)}
    rows = csv_load.read_text_csv(spark, path, sep=";", quote="'", names=["p", "q"]).collect()
    assert {tuple(r) for r in rows} == {("a", "b", None), ("1", "x\n;y", None), ("2", "z", None)}
    (Path(path) / "two.csv").write_text("a;other\n1;2\n")
    with pytest.raises(Exception, match="not the header"):
        csv_load.read_text_csv(spark, path, sep=";", quote="'").collect()


def test_csv_headers(spark):
    with pytest.raises(ValueError, match="no CSV column"):
        csv_load.load_csv(spark.createDataFrame([("1",)], "other string"), TARGET)
    rules = csv_load.rules_table(spark.createDataFrame([("r",)], "Rule string"))
    assert rules.collect()[0].asDict() == {"CATEGORY": "共通", "RULE": "r"}
    with pytest.raises(ValueError, match="TEXT"):
        csv_load.training_table(spark.createDataFrame([("r",)], "category string"))
    assert csv_load.preview_csv(spark, _csv(spark).inputFiles()[0]).count() == 7


def test_publish_csv_modes(spark):
    load = csv_load.load_csv(_csv(spark), TARGET)
    tables.reload_table(load.accepted.limit(0), "loaded_rows")
    csv_load.publish_csv(load, "loaded_rows")
    csv_load.publish_csv(load, "loaded_rows")
    assert spark.table("loaded_rows").count() == 4
    csv_load.publish_csv(load, "loaded_rows", "TRUNCATE & INSERT")
    assert spark.table("loaded_rows").count() == 2


def test_layer_versions(spark):
    layer = Layer(spark, work_folder(spark, "layer"))
    assert layer.latest() is None and not layer.has_data()
    first = spark.createDataFrame([(1, "a"), (2, None)], "id int, old string")
    assert layer.write(first) == 0
    assert layer.write(spark.createDataFrame([(3, 1.5)], "id int, new double"), merge_schema=True) == 1
    assert layer.read().columns == ["id", "old", "new"]
    assert layer.read().collect()[0].asDict() == {"id": 3, "old": None, "new": 1.5}
    assert sorted(r["id"] for r in layer.read(0).collect()) == [1, 2]  # version 0 is unchanged
    with pytest.raises(ValueError):
        layer.read(2)
    # Data without a manifest row is not visible.
    first.write.parquet(f"{layer.root}/data-unfinished")
    assert layer.latest() == 1
    assert layer.write(first.limit(1)) == 2 and layer.read().count() == 1
    assert layer.register("layer_now").count() == 1 and layer.register("layer_now", 0).count() == 2


def test_changes_rewrite_touched_files_only(spark):
    layer = Layer(spark, work_folder(spark, "layer"))
    rows = spark.range(1000).select("id", F.concat(F.lit("n"), "id").alias("name"), F.lit(None).cast("int").alias("none"))
    layer.write(rows.repartitionByRange(100, "id"))
    first = {r["file"] for r in layer.files(0).collect()}
    assert len(first) == 100 and {r["rows"] for r in layer.files(0).collect()} <= set(range(5, 20))
    changes = spark.createDataFrame([(i, f"new{i}") for i in (5, 6, 7, 500, 501, 5000, 5001, 5002, 5003)] + [(None, "nobody")], "id long, name string")
    done = layer.merge_keys(changes, ["id"])
    assert done.version == 1 and 2 <= done.rewritten <= 5 and done.kept == 100 - done.rewritten
    assert len(first & {r["file"] for r in layer.files(1).collect()}) == done.kept
    now = {r["id"]: r["name"] for r in layer.read().collect() if r["id"] is not None}
    assert len(now) == 1004 and now[5] == "new5" and now[501] == "new501" and now[5003] == "new5003" and now[8] == "n8"
    assert layer.read().count() == 1005 and layer.versions().where("version = 1").first().row_count == 1005
    done = layer.update_where({"none": 1}, "name = 'n999'")
    assert (done.rewritten, layer.read().where("none = 1").count()) == (1, 1)
    done = layer.delete_where("name = 'no such name'")
    assert (done.rewritten, done.added, layer.read().count()) == (0, 0, 1005)
    done = layer.append(spark.createDataFrame([(7000,)], "id long"))
    assert (done.rewritten, layer.read().count()) == (0, 1006) and done.kept == layer.files(3).count()
    by_name = layer.merge_keys(spark.createDataFrame([("n10", 10), ("new", 11)], "name string, none int"), ["name"])
    assert by_name.rewritten <= 2 and {(r["id"], r["none"]) for r in layer.read().where("name in ('n10', 'new')").collect()} == {(10, 10), (None, 11)}
    other_type = layer.merge_keys(spark.createDataFrame([("20", "decimal")], "id string, name string").selectExpr("cast(id as decimal(20,1)) id", "name"), ["id"])
    assert other_type.rewritten == 1 and layer.read().where("name = 'decimal'").first()["id"] == 20
    assert layer.read(0).count() == 1000 and layer.register("layer_files").count() == layer.read().count()
    layer.write(layer.read().withColumn("more", F.lit(2)), merge_schema=True)
    assert layer.delete_where("id < 990").version == 8 and layer.read().columns[-1] == "more"


def test_many_keys_are_looked_up_by_stretches(spark, monkeypatch):
    monkeypatch.setattr(layers, "STRETCHES", 4)
    layer = Layer(spark, work_folder(spark, "layer"))
    layer.write(spark.range(400).repartitionByRange(20, "id"))
    changes = spark.range(100, 160).withColumn("x", F.lit(1))
    met = layer.files(0).where(layers._meets(layer.files(0), changes, ["id"], layer.read().schema)).count()
    assert 3 <= met <= 6
    assert layer.merge_keys(changes, ["id"]).rewritten == met and layer.read().count() == 400


def test_changes_to_nothing(spark):
    layer = Layer(spark, work_folder(spark, "layer"))
    with pytest.raises(ValueError, match="no version"):
        layer.append(spark.range(1))
    layer.write(spark.range(0))
    assert layer.read().count() == 0
    assert layer.merge_keys(spark.range(3), ["id"]).rewritten == 0 and layer.read().count() == 3
    assert layer.delete_where("id >= 0").rewritten >= 1 and layer.read().count() == 0
    assert layer.append(spark.range(2)).version == 3 and layer.read().count() == 2


def test_layer_health(spark):
    root = work_folder(spark, "health")
    Layer(spark, f"{root}/b/bronze").write(spark.range(3))
    rows = {r["layer"]: (r["present"], r["row_count"]) for r in layer_health(spark, [f"{root}/a", f"{root}/b"], {"B": "bronze", "G": "gold"}).collect()}
    assert rows == {"B": (True, 3), "G": (False, 0)}
    spark.range(2).write.mode("overwrite").saveAsTable("health_t")
    rows = {r["name"]: (r["present"], r["row_count"]) for r in table_health(spark, ["health_t", "health_none"]).collect()}
    assert rows == {"health_t": (True, 2), "health_none": (False, 0)}


def test_catalog_tables(spark):
    schema = T.StructType([T.StructField("A", T.IntegerType())])
    spark.sql("DROP TABLE IF EXISTS gold_t")
    assert tables.create_if_missing(spark, "gold_t", schema) == (True, 0)
    tables.append_by_position(spark.createDataFrame([(1,), (2,)], "other int"), "gold_t")
    assert tables.create_if_missing(spark, "gold_t", schema) == (False, 2)
    assert tables.reload_table(spark.createDataFrame([(5,)], schema), "gold_t") == 1
    assert "gold_t" in {r["name"] for r in tables.list_tables(spark).collect()}
    assert tables.browse_table(spark, "gold_t", "A > 4").count() == 1
    with pytest.raises(ValueError):
        tables.browse_table(spark, "gold_t; drop")
    with pytest.raises(ValueError):
        tables.read_table(spark, "no_such_table")


def test_names_and_samples(spark):
    names = spark.createDataFrame([(" a",), ("a",), ("",), (None,), ("Bc",)], "n string")
    assert sorted(r[0] for r in tables.distinct_names(names, "n").collect()) == ["Bc", "a"]
    assert [r[0] for r in tables.keyword_search(names, "n", "b").collect()] == ["Bc"]
    assert tables.keyword_search(names, "n", " ").count() == 5
    blocks = tables.sample_blocks({"T": spark.range(3), "E": spark.range(0)}, 2).collect()
    assert [(b["object_name"], b["sample_text"]) for b in blocks] == [("T", "OBJECT: T\nid\n0\n1\n")]


def _lines(folder, lines):
    Path(folder).mkdir(parents=True, exist_ok=True)
    (Path(folder) / f"h{len(list(Path(folder).iterdir()))}.json").write_text("\n".join(lines), encoding="utf-8")


HISTORY = [
    '{"画面名":"s1","実行ID":"1","SQL実行経過時間（秒）":"","SELECT経過時間":"1:05","試行回数":2}',
    "",
    "{broken",
    "[1, 2]",
    '"text"',
    '{"画面名":"s2","SELECT経過時間（秒）":"12ms","SELECT経過時間":"9","全体経過時間（秒）":"soon"}',
]


def test_history(spark):
    folder = work_folder(spark, "history")
    assert history.read_history(spark, folder).count() == 0
    _lines(folder, HISTORY)
    records = history.read_history(spark, folder)
    assert records.columns == history.REPORT_COLUMNS
    by_screen = {r["画面名"]: r for r in records.collect()}
    assert set(by_screen) == {"s1", "s2"}
    assert by_screen["s1"]["SQL実行経過時間（秒）"] == "65.000" and by_screen["s1"]["試行回数"] == "2"
    assert by_screen["s2"]["SQL実行経過時間（秒）"] == "0.012" and by_screen["s2"]["エラー内容"] == ""
    assert history.report(records, "s2").count() == 1 and history.report(records).count() == 2
    exported = {r["画面名"]: r["全体経過時間（秒）"] for r in history.export_frame(records).collect()}
    assert exported == {"s1": None, "s2": None}
    assert history.rejected_lines(spark, folder).count() == 3
    history.append_history(records, folder)
    assert history.read_history(spark, folder).count() == 4
    out = work_folder(spark, "export")
    history.export_csv(records, out)
    assert spark.read.option("header", True).csv(out).count() == 2


def test_history_stream(spark):
    source, target, mark = (work_folder(spark, n) for n in ("in", "out", "mark"))
    _lines(source, HISTORY)
    refresh_report(spark, source, target, mark).awaitTermination()
    assert spark.read.parquet(target).count() == 2
    refresh_report(spark, source, target, mark).awaitTermination()  # nothing new
    _lines(source, ['{"画面名":"s3"}'])
    refresh_report(spark, source, target, mark).awaitTermination()
    assert sorted(r["画面名"] for r in spark.read.parquet(target).collect()) == ["s1", "s2", "s3"]


def _attempts(spark, rows, folder):
    frame = spark.createDataFrame([(f"{e}-{n}", e, dt.datetime(2024, 1, day), phase, f"2024-01-{day:02d}", ms, status) for e, n, day, phase, ms, status in rows],
                                  "record_id string, execution_id string, at timestamp, phase string, started_at string, elapsed_ms double, status string")
    frame.withColumn("finished_at", F.concat("started_at", F.lit("z"))).coalesce(1).write.mode("append").json(folder)


def test_report_state(spark):
    """Refreshes with replayed files, late records and a repeated micro-batch equal one pass over all records."""
    source, mark, layer = work_folder(spark, "in"), work_folder(spark, "mark"), Layer(spark, work_folder(spark, "state"))
    first = [("a", 1, 5, "select_ai", 100.0, "s1"), ("a", 2, 6, "select", 50.5, "s2"), ("b", 1, 6, "select_ai", -3.0, "t1")]
    second = [("a", 3, 4, "select_ai", 7.0, "old"), ("c", 1, 7, "select", 1.0, "u1")]
    late = [("b", 2, 1, "select", 9.0, "too late")]

    def refresh():
        refresh_state(spark, source, layer, mark, "3 days").awaitTermination()

    def now():
        return {r["execution_id"]: (r["attempts"], r["g_ms"] and float(r["g_ms"]), r["r_ms"] and float(r["r_ms"]), r["started_at"], r["latest"]["status"]) for r in layer.read().collect()}

    _attempts(spark, first, source)
    refresh()
    assert now() == {"a": (1, 100.0, 50.5, "2024-01-05", "s2"), "b": (1, 0, None, "2024-01-06", "t1")}
    _attempts(spark, first, source)  # replayed
    _attempts(spark, second, source)
    refresh()
    want = {"a": (2, 107.0, 50.5, "2024-01-04", "s2"), "b": (1, 0, None, "2024-01-06", "t1"), "c": (0, None, 1.0, "2024-01-07", "u1")}
    assert now() == want
    _attempts(spark, late, source)
    refresh()
    assert now() == want
    public = {r["実行ID"]: r for r in report.state_records(layer.read()).collect()}
    assert public["a"]["全体経過時間（秒）"] == "0.158" and public["a"]["ステータス"] == "s2" and public["c"]["Select AI経過時間（秒）"] == ""


def test_a_repeated_batch_is_left_out(spark):
    layer = Layer(spark, work_folder(spark, "state"))
    part = spark.createDataFrame([("a", 5)], "execution_id string, batch long")
    layer.write(part)
    assert layer.files(0).agg(F.max("high batch")).first()[0] == 5
