import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from silverlode.operators import mutate


@pytest.fixture(scope="module")
def target(spark):
    return spark.createDataFrame([(1, "a", 10.0), (2, "b", None), (3, "c", -5.0), (None, "n", 1.0)], "id int, name string, v double")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_null_predicate_is_not_true(target):
    assert [r["id"] for r in mutate.delete_where(target, "v > 0").orderBy("id").collect()] == [2, 3]
    updated = {r["name"]: r["v"] for r in mutate.update_where(target, {"v": F.col("v") * 2, "name": F.col("name")}, "v > 0").collect()}
    assert updated == {"a": 20.0, "b": None, "c": -5.0, "n": 2.0}
    assert mutate.delete_where(target).count() == 0 and mutate.truncate(target).count() == 0
    swapped = mutate.update_where(target, {"id": F.lit(7), "v": F.col("id")}, "id = 1").filter("id = 7").collect()
    assert [tuple(r) for r in swapped] == [(7, "a", 1.0)]  # new values come from the old row


def test_merge(spark, target):
    source = spark.createDataFrame([(2, 20.0), (9, 90.0), (None, 5.0), (None, 6.0)], "id int, v double")
    merged = mutate.merge(target, source, ["id"])
    assert rows(merged) == sorted(
        [(1, "a", 10.0), (2, "b", 20.0), (3, "c", -5.0), (None, "n", 1.0), (9, None, 90.0), (None, None, 5.0), (None, None, 6.0)], key=repr
    )
    again = mutate.merge(mutate.merge(target, source.filter("id IS NOT NULL"), ["id"]), source.filter("id IS NOT NULL"), ["id"])
    assert rows(again) == rows(mutate.merge(target, source.filter("id IS NOT NULL"), ["id"]))  # idempotent
    only_new = mutate.merge(target, source.filter("id = 9"), ["id"])
    assert only_new.count() == 5
    assert rows(mutate.merge(target, source.filter("id = 2"), ["id"])) == rows(mutate.update_where(target, {"v": 20.0}, "id = 2"))


def test_merge_duplicates(spark, target):
    twice = spark.createDataFrame([(2, 1.0), (2, 2.0)], "id int, v double")
    with pytest.raises(PySparkException, match="more than one source row"):
        mutate.merge(target, twice, ["id"]).collect()
    new_twice = spark.createDataFrame([(8, 1.0), (8, 2.0)], "id int, v double")
    assert mutate.merge(target, new_twice, ["id"]).filter("id = 8").count() == 2


def test_merge_custom_columns_and_hot_key(spark):
    hot = spark.range(1000).select(F.when(F.col("id") < 700, 1).otherwise(F.col("id")).cast("int").alias("k"), F.lit("o").alias("s"))
    source = spark.createDataFrame([(1, "new"), (5000, "ins")], "key int, txt string").withColumnRenamed("key", "k")
    merged = mutate.merge(hot, source, ["k"], update={"s": "txt"}, insert={"k": "k", "s": "txt"})
    counts = {r["s"]: r["count"] for r in merged.groupBy("s").count().collect()}
    assert counts == {"new": 700, "o": 300, "ins": 1}


def test_by_name(spark):
    entries = spark.createDataFrame([("Tab", 1), ("other", 2), (" x ", 3)], "name string, n int")
    changed = spark.createDataFrame([("TAB ", 9), (" ", 8), (None, 7)], "name string, n int")
    assert rows(mutate.upsert_by_name(entries, changed, "name")) == [(" x ", 3), ("TAB ", 9), ("other", 2)]
    assert rows(mutate.remove_by_key(entries, spark.createDataFrame([("X",), (None,)], "name string"), "name")) == [("Tab", 1), ("other", 2)]
    assert "updated_at" in mutate.replace_snapshot(entries).columns


def test_sets(spark):
    a = spark.createDataFrame([(1, "x"), (2, None), (2, None)], "a int, b string")
    b = spark.createDataFrame([(2, None)], "a int, b string")
    assert rows(mutate.difference(a, b, ["a", "b"])) == [(1, "x")]
    assert mutate.union_names(a, b).count() == 4


def _steps(spark):
    new = spark.createDataFrame([(10, "j", 1.0)], "id int, name string, v double")
    change = spark.createDataFrame([(1, 11.0), (12, 12.0)], "id int, v double")
    return [
        mutate.update_step({"v": F.col("v") + 1}, "v > 0"),
        mutate.insert_step(new),
        mutate.merge_step(change, ["id"]),
        mutate.merge_step(change, ["id"]),
        mutate.delete_step("id >= 10"),
    ]


def test_batch(spark, target):
    batch = mutate.run_batch(target, _steps(spark))
    summary = batch.summary.orderBy("No").collect()
    assert batch.ok and [(r["Type"], r["RowsAffected"]) for r in summary] == [
        ("UPDATE", 2), ("INSERT", 1), ("MERGE", 2), ("MERGE", 2), ("DELETE", 2),
    ]
    assert {r["Permanent"] for r in summary} == {"確定"}
    assert rows(batch.table) == sorted([(1, "a", 11.0), (2, "b", None), (3, "c", -5.0), (None, "n", 2.0)], key=repr)
    assert [tuple(r) for r in mutate.affected_rows(target, _steps(spark)).orderBy("No").collect()][-1] == (5, "DELETE", 2)


def test_batch_stops_and_rolls_back(spark, target):
    bad = mutate.update_step({"id": F.raise_error(F.lit("boom")).cast("int")}, "id = 1")
    steps = [mutate.delete_step("id = 3"), bad, mutate.truncate_step()]
    batch = mutate.run_batch(target, steps)
    summary = [(r["Status"], r["Message"]) for r in batch.summary.orderBy("No").collect()]
    assert not batch.ok and [s for s, _ in summary] == ["成功", "失敗"] and "boom" in summary[1][1]
    steps[1] = mutate.update_step({"nope": 1})
    batch = mutate.run_batch(target, steps)
    summary = [(r["Status"], r["Permanent"], r["RowsAffected"]) for r in batch.summary.orderBy("No").collect()]
    assert not batch.ok and summary == [("成功", "ロールバック済み", 1), ("失敗", "未反映", -1)]
    assert rows(batch.table) == rows(target)
    assert batch.outcome().collect()[0].asDict() == {"succeeded": 1, "failed": 1, "rows_affected": 1}


def test_lenient_batch(spark, target):
    twice = spark.createDataFrame([(2, 1.0), (2, 2.0)], "id int, v double")
    steps = [mutate.delete_step("id = 3"), mutate.merge_step(twice, ["id"]), mutate.update_step({"nope": 1}), mutate.delete_step("id = 1")]
    batch = mutate.run_lenient(target, steps)
    assert [r["Status"] for r in batch.summary.orderBy("No").collect()] == ["成功", "失敗", "失敗", "成功"]
    assert batch.outcome().collect()[0].asDict() == {"succeeded": 2, "failed": 2, "rows_affected": 2}
    assert batch.table.count() == 2


def test_truncate_is_not_rolled_back(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "id long, name string")
    more = spark.createDataFrame([(3, "c")], "id long, name string")
    steps = [mutate.delete_step("id = 1"), mutate.truncate_step(), mutate.insert_step(more), mutate.update_step({"nowhere": "x"})]
    batch = mutate.run_batch(target, steps)
    assert not batch.ok and batch.table.count() == 0
    assert [(r["RowsAffected"], r["Permanent"]) for r in batch.summary.orderBy("No").collect()] == [
        (1, mutate.COMMITTED), (1, mutate.COMMITTED), (1, mutate.ROLLED_BACK), (-1, mutate.NOT_APPLIED),
    ]


def test_keys_of_different_types(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "id long, name string")
    theirs = spark.createDataFrame([(1.5,), (2.0,)], "id double")
    assert [r["id"] for r in mutate.difference(target, theirs, ["id"]).collect()] == [1]
    large = spark.createDataFrame([(2**53 + 1, "x")], "id long, name string")
    assert mutate.difference(large, spark.createDataFrame([(float(2**53),)], "id double"), ["id"]).count() == 1
