"""Plan checks: what must hold for the plans to work on large and skewed data."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from silverlode.operators import enrich, glossary, lookup, mutate
from tests.conftest import SF

PYTHON_USERS = {"vector_topk", "classify_fit_predict", "payload_text", "glossary_rewrite"}


def plan(df, final=False):
    if final:
        df.write.format("noop").mode("overwrite").save()
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def skewed(spark):
    """No broadcasts, many small partitions, low limits for what counts as skewed."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def _hot(spark, rows=300000):
    """A third of the rows share one key; written in several map tasks."""
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5000)
    return spark.range(0, rows, 1, 8).select(key.alias("k"), F.col("id").alias("v"), F.md5(F.col("id").cast("string")).alias("pad"))


def _split_joins(text):
    return [line for line in text.split("\n") if "SortMergeJoin(skew=true)" in line]


def test_hot_group_is_split_in_enrichment(skewed):
    df = enrich.with_group_averages(_hot(skewed), "k", {"avg_v": "v"})
    assert any("LeftOuter" in line for line in _split_joins(plan(df, final=True)))
    assert df.count() == 300000


def test_hot_key_is_split_in_merge(skewed):
    target = _hot(skewed)
    source = skewed.range(6000).select(F.col("id").alias("k"), F.lit("new").alias("pad"))
    merged = mutate.merge(target, source, ["k"])
    assert any("LeftOuter" in line for line in _split_joins(plan(merged, final=True)))
    counts = merged.agg(F.count("*").alias("n"), F.count_if(F.col("pad") == "new").alias("new")).first()
    assert (counts["n"], counts["new"]) == (301000, 301000)


def test_hot_text_is_one_row_in_the_log_lookup(skewed):
    log = _hot(skewed).select(
        F.col("v").cast("string").alias("sql_id"), F.concat(F.lit("select  "), "k").alias("sql_text"), F.lit("f").alias("sql_fulltext"),
        F.lit(None).cast("timestamp").alias("translated_at"), F.col("v").alias("use_count"),
    )
    asked = skewed.createDataFrame([("select 7",), ("select 8",)], "q string")
    got = lookup.latest_log_entry(asked, "q", log)
    assert [r["sql_id"] for r in got.orderBy("q").collect()][0] == "299997"
    assert "partial_max_by" in plan(got)


def test_filters_and_columns_reach_the_scan(spark):
    queries = entry.queries()
    text = plan(queries["l05_year"](spark, SF))
    assert "GreaterThanOrEqual(o_orderdate" in text and "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>" in text
    assert "IsNotNull(c_acctbal), GreaterThanOrEqual(c_acctbal,0.0)" in plan(queries["quality_filter"](spark, SF))
    assert "PushedFilters: [IsNotNull(c_mktsegment), EqualTo(c_mktsegment,BUILDING)" in plan(queries["policy_relation"](spark, SF))
    assert "TakeOrderedAndProject" in plan(queries["l01_topn"](spark, SF))


@pytest.mark.parametrize(
    "name", ["medallion_flagship", "merge_upsert", "policy_inventory", "privilege_audit", "object_split", "key_listagg", "glossary_rewrite", "vector_topk", "csv_load", "payload_text", "value_normalise", "reply_text"]
)
def test_plans_without_cross_joins_and_row_udfs(skewed, name):
    text = plan(entry.queries()[name](skewed, SF))
    assert "CartesianProduct" not in text and "NestedLoop" not in text and "BatchEvalPython" not in text
    if name not in PYTHON_USERS:
        assert "Python" not in text and "Pandas" not in text


def test_seeded_rows_do_not_depend_on_partitions(spark):
    queries = entry.queries()
    before = sorted(map(tuple, queries["synthetic_rows"](spark, SF).collect()))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        assert sorted(map(tuple, queries["synthetic_rows"](spark, SF).collect())) == before
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_a_hot_category_is_split(skewed):
    questions = _hot(skewed).select(F.col("k").cast("string").alias("category"), F.concat(F.lit("question "), F.col("v").cast("string")).alias("q"))
    rules = skewed.range(200).select("id", F.col("id").cast("string").alias("CATEGORY"), F.lit("rule").alias("RULE"))
    assert "skew=true" in plan(glossary.assemble_prompts(questions, "q", "category", rules, "id"), final=True)

