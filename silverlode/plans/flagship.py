"""The medallion flow on one table: quality filter → group averages → review → sentiment → target schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.operators.enrich import EXACT, assign_review, conform, upper_columns, with_group_averages
from silverlode.operators.quality import quality_filter
from silverlode.operators.scoring import review_prompt, sentiment

GOLD_CUSTOMER = T.StructType(
    [
        T.StructField("C_CUSTKEY", EXACT),
        T.StructField("C_NAME", T.StringType()),
        T.StructField("C_MKTSEGMENT", T.StringType()),
        T.StructField("C_ACCTBAL", EXACT),
        T.StructField("AVG_ACCTBAL", EXACT),
        T.StructField("REVIEW", T.StringType()),
        T.StructField("SENTIMENT_LABEL", T.StringType()),
        T.StructField("SENTIMENT_REASON", T.StringType()),
    ]
)


def keyword_scorer(prompt: Column) -> Column:
    """A stand-in for a model: answers like one (fenced JSON) from key words of the prompt."""
    label = (
        F.when(prompt.rlike("(?i)delay|lost"), "Negative")
        .when(prompt.rlike("(?i)comfortable|smooth|great"), "Positive")
        .otherwise("Neutral")
    )
    reason = F.concat(F.lit("key words say "), F.lower(label))
    body = F.to_json(F.struct(label.alias("label"), reason.alias("reason")))
    return F.when(prompt.isNotNull(), F.concat(F.lit("```json\n"), body, F.lit("\n```")))


def medallion(customer: DataFrame, scorer=keyword_scorer) -> DataFrame:
    silver = quality_filter(customer, "c_acctbal")
    enriched = with_group_averages(silver, "c_mktsegment", {"avg_acctbal": "c_acctbal"})
    reviewed = assign_review(enriched, "c_custkey", column="review")
    scored = sentiment(reviewed, review_prompt(F.col("review")), scorer)
    return conform(upper_columns(scored), GOLD_CUSTOMER)
