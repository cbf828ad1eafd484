"""Registered queries: quality, enrichment, conforming, reviews, sentiment, measures."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.functions.text import parse_answer, strip_fences
from silverlode.operators import enrich, quality
from silverlode.operators.enrich import EXACT, SAMPLE_REVIEWS
from silverlode.operators.scoring import REVIEW_INSTRUCTION, review_prompt, score
from silverlode.plans import flagship
from silverlode.sources.tables import read_folder


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sql_pick(key: str, choices: list[str], seed: int = 0) -> str:
    """SQL for ``seeded_pick``."""
    values = ", ".join(quoted(c) for c in choices)
    number = f"('0x' || substr(md5({key}::VARCHAR || ':{seed}'), 1, 8))::BIGINT"
    return f"([{values}])[({number} % {len(choices)})::INT + 1]"


def sql_average(column: str, scale: int = 4) -> str:
    return f"round(sum({column}::DECIMAL(28,10))::DOUBLE / count({column}), {scale})"


def doubles(df: DataFrame) -> DataFrame:
    """Decimals as doubles, where only the comparison with another engine needs it."""
    return df.select(
        *[F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name) for f in df.schema]
    )


REVIEW_SQL = sql_pick("c_custkey", SAMPLE_REVIEWS)
LABEL_SQL = """CASE WHEN regexp_matches({p}, '(?i)delay|lost') THEN 'Negative'
     WHEN regexp_matches({p}, '(?i)comfortable|smooth|great') THEN 'Positive' ELSE 'Neutral' END"""


def medallion_flagship(spark: SparkSession, folder: str) -> DataFrame:
    return doubles(flagship.medallion(read_folder(spark, folder, "customer")))


MEDALLION_SQL = f"""
WITH silver AS (SELECT * FROM customer WHERE c_acctbal IS NOT NULL AND c_acctbal >= 0),
averages AS (SELECT c_mktsegment, {sql_average('c_acctbal')} AS a FROM silver GROUP BY c_mktsegment),
reviewed AS (SELECT s.*, a.a, {REVIEW_SQL} AS review FROM silver s LEFT JOIN averages a USING (c_mktsegment)),
scored AS (SELECT *, {LABEL_SQL.format(p='review')} AS label FROM reviewed)
SELECT c_custkey::DOUBLE AS "C_CUSTKEY", c_name AS "C_NAME", c_mktsegment AS "C_MKTSEGMENT", c_acctbal AS "C_ACCTBAL",
       a AS "AVG_ACCTBAL", review AS "REVIEW", label AS "SENTIMENT_LABEL",
       'key words say ' || lower(label) AS "SENTIMENT_REASON"
FROM scored"""


def quality_filter(spark, folder):
    return quality.quality_filter(read_folder(spark, folder, "customer"), "c_acctbal").select("c_custkey", "c_name", "c_acctbal")


def quality_rejects(spark, folder):
    rejects = quality.quality_rejects(read_folder(spark, folder, "customer"), "c_acctbal")
    return rejects.groupBy("c_mktsegment", "reject_reason").agg(F.count("*").alias("rows"))


def enrich_group_avg(spark, folder):
    part = read_folder(spark, folder, "part").select("p_partkey", "p_brand", "p_retailprice", "p_size")
    return enrich.with_group_averages(part, "p_brand", {"avg_price": "p_retailprice", "avg_size": "p_size"})


def conform_schema(spark, folder):
    target = T.StructType(
        [
            T.StructField("O_ORDERKEY", EXACT),
            T.StructField("O_TOTALPRICE", EXACT),
            T.StructField("O_CUSTKEY", EXACT),
            T.StructField("O_ORDERSTATUS", T.StringType()),
            T.StructField("O_ORDERPRIORITY", T.StringType()),
        ]
    )
    return doubles(enrich.conform(enrich.upper_columns(read_folder(spark, folder, "orders")), target))


def review_assign(spark, folder):
    return enrich.assign_review(read_folder(spark, folder, "customer").select("c_custkey"), "c_custkey", column="review")


def fenced_scorer(prompt):
    """Answers of three shapes: fenced JSON, bare JSON over lines, and text that is not JSON."""
    return (
        F.when(prompt.contains("delay") | prompt.contains("Lost"), '```json\n{"label": "Negative",\n "reason": "bad trip"}\n```')
        .when(prompt.contains("smooth"), '{"label": "Positive",\n"reason": "good trip"}')
        .when(prompt.contains("Great"), '```json{"label": "Positive"}```')
        .otherwise("I cannot say.")
    )


def sentiment_parse(spark, folder):
    customer = read_folder(spark, folder, "customer").select("c_custkey")
    reviewed = enrich.assign_review(customer, "c_custkey", column="review")
    scored = score(reviewed, review_prompt(F.col("review")), fenced_scorer, "answer")
    return scored.select(
        "c_custkey",
        F.length(review_prompt(F.col("review"))).alias("prompt_length"),
        strip_fences(F.col("answer")).alias("cleaned"),
        parse_answer(F.col("answer"))["label"].alias("label"),
        parse_answer(F.col("answer"))["reason"].alias("reason"),
    )


SENTIMENT_PARSE_SQL = f"""
WITH r AS (SELECT c_custkey, {REVIEW_SQL} AS review FROM customer)
SELECT c_custkey, length('Review: ' || review || {quoted(REVIEW_INSTRUCTION)})::INT AS prompt_length,
  CASE WHEN contains(review, 'delay') OR contains(review, 'Lost') THEN '{{"label": "Negative", "reason": "bad trip"}}'
       WHEN contains(review, 'smooth') THEN '{{"label": "Positive","reason": "good trip"}}'
       WHEN contains(review, 'Great') THEN '{{"label": "Positive"}}' ELSE 'I cannot say.' END AS cleaned,
  CASE WHEN contains(review, 'delay') OR contains(review, 'Lost') THEN 'Negative'
       WHEN contains(review, 'smooth') OR contains(review, 'Great') THEN 'Positive' END AS label,
  CASE WHEN contains(review, 'delay') OR contains(review, 'Lost') THEN 'bad trip'
       WHEN contains(review, 'smooth') THEN 'good trip' END AS reason
FROM r"""


def bi_measures(spark, folder):
    return enrich.group_averages(read_folder(spark, folder, "events"), "event_type", {"avg_value": "value"})


def bi_stacked_measure(spark, folder):
    return enrich.stacked_measure(read_folder(spark, folder, "lineitem"), ["l_returnflag", "l_linestatus"], "l_quantity")


def bi_group_detail(spark, folder):
    return enrich.group_detail(read_folder(spark, folder, "part"), "p_brand", "Brand#2", ["p_partkey", "p_name"])


QUERIES = {
    "medallion_flagship": (medallion_flagship, MEDALLION_SQL),
    "quality_filter": (
        quality_filter,
        "SELECT c_custkey, c_name, c_acctbal FROM customer WHERE NOT (c_acctbal IS NULL OR c_acctbal < 0)",
    ),
    "quality_rejects": (
        quality_rejects,
        """SELECT c_mktsegment, CASE WHEN c_acctbal IS NULL THEN 'missing' ELSE 'negative' END AS reject_reason,
           count(*) AS rows FROM customer WHERE c_acctbal IS NULL OR c_acctbal < 0 GROUP BY ALL""",
    ),
    "enrich_group_avg": (
        enrich_group_avg,
        f"""SELECT p.p_partkey, p.p_brand, p.p_retailprice, p.p_size, a.avg_price, a.avg_size
            FROM part p LEFT JOIN (SELECT p_brand, {sql_average('p_retailprice')} AS avg_price,
                                          {sql_average('p_size')} AS avg_size FROM part GROUP BY p_brand) a USING (p_brand)""",
    ),
    "conform_schema": (
        conform_schema,
        """SELECT o_orderkey::DOUBLE AS "O_ORDERKEY", o_totalprice AS "O_TOTALPRICE",
           o_custkey::DOUBLE AS "O_CUSTKEY", o_orderstatus AS "O_ORDERSTATUS", o_orderpriority AS "O_ORDERPRIORITY"
           FROM orders""",
    ),
    "review_assign": (review_assign, f"SELECT c_custkey, {REVIEW_SQL} AS review FROM customer"),
    "sentiment_parse": (sentiment_parse, SENTIMENT_PARSE_SQL),
    "bi_measures": (bi_measures, f"SELECT event_type, {sql_average('value')} AS avg_value FROM events GROUP BY event_type"),
    "bi_stacked_measure": (
        bi_stacked_measure,
        f"""SELECT l_returnflag, l_linestatus, {sql_average('l_quantity')} AS avg_l_quantity, count(*) AS row_count
            FROM lineitem GROUP BY ALL""",
    ),
    "bi_group_detail": (bi_group_detail, "SELECT p_partkey, p_name FROM part WHERE p_brand = 'Brand#2'"),
}
