"""Text routing by classifier."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, IndexToString, RegexTokenizer, StringIndexer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverlode.functions.text import strip

ALGORITHM = "LogisticRegression"  # fixed value of the metadata record


def training_rows(df: DataFrame, text: str, label: str) -> DataFrame:
    """Rows with text; a missing label is an empty one."""
    return df.filter(F.coalesce(F.col(text), F.lit("")) != "").withColumn(label, F.coalesce(F.col(label).cast("string"), F.lit("")))


def text_features(column: str, size: int = 1 << 18) -> list:
    """T04 without given vectors: hashed and weighted words as pipeline stages, output column ``features``."""
    return [
        RegexTokenizer(inputCol=column, outputCol="words__", pattern=r"\W+"),
        HashingTF(inputCol="words__", outputCol="counts__", numFeatures=size),
        IDF(inputCol="counts__", outputCol="features"),
    ]


def with_vectors(df: DataFrame, embedding: str) -> DataFrame:
    return df.withColumn("features", array_to_vector(F.col(embedding).cast("array<double>")))


def fit(df: DataFrame, label: str, iterations: int = 1, stages: list | None = None, strength: float = 1.0) -> PipelineModel:
    """Multinomial logistic regression, L2, unscaled features, at least 1000 iterations allowed.

    Spark divides the loss by the number of rows, so the usual inverse strength C becomes 1 / (C · rows). Training
    is a sum over partitions per iteration; only coefficients travel.
    """
    rows = df.count()
    if rows == 0:
        raise ValueError("no training rows")
    classifier = LogisticRegression(
        featuresCol="features", labelCol="label__", family="multinomial", standardization=False,
        maxIter=max(1000, iterations * 100), regParam=1.0 / (strength * rows), tol=1e-6,
    )
    index = StringIndexer(inputCol=label, outputCol="label__", stringOrderType="alphabetAsc", handleInvalid="error")
    labels = index.fit(df)
    back = IndexToString(inputCol="prediction", outputCol="predicted", labels=labels.labels)
    return Pipeline(stages=[*(stages or []), labels, classifier, back]).fit(df)


def model_labels(model: PipelineModel) -> list[str]:
    return list(model.stages[-1].getLabels())


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``predicted`` and ``probabilities`` (label → probability with three decimals)."""
    labels = model_labels(model)
    # The label indexer is only needed for training; rows to predict have no label.
    scored = df
    for stage in model.stages:
        if stage.__class__.__name__ != "StringIndexerModel":
            scored = stage.transform(scored)
    p = vector_to_array("probability")
    table = F.create_map(*[x for i, name in enumerate(labels) for x in (F.lit(name), F.round(p[i], 3))])
    return scored.select(*[F.col(f"`{c}`") for c in df.columns], F.col("predicted"), table.alias("probabilities"))


def routed_label(predicted: Column) -> Column:
    return F.lower(strip(predicted))


def training_profile(df: DataFrame, label: str) -> DataFrame:
    """Sample count and sorted labels. Labels are made distinct first, so the set is built from few rows."""
    per_label = df.groupBy(label).agg(F.count("*").alias("n"))
    return per_label.agg(F.sum("n").alias("samples"), F.sort_array(F.collect_list(F.col(label).cast("string"))).alias("labels"))


def model_record(df: DataFrame, label: str, name: str, embed_model: str, iterations: int = 1, created_at: Column | None = None) -> DataFrame:
    """One row that describes a trained model."""
    return training_profile(df, label).select(
        F.lit(name).alias("model_name"),
        "labels",
        "samples",
        F.lit(embed_model).alias("embed_model"),
        F.lit(iterations).alias("iterations"),
        (created_at if created_at is not None else F.current_timestamp()).alias("created_at"),
        F.lit(ALGORITHM).alias("algorithm"),
    )
