"""Metadata tables: lists, columns, keys, profiles, prompts.

Spark has no information schema, so the dictionary tables are DataFrames that the caller supplies; the functions join
and aggregate them like any other data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.functions.text import not_blank, strip, type_text, variant_text
from silverlode.operators.concat import ordered_concat
from silverlode.operators.skew import match
from silverlode.operators.staging import compute_once
from silverlode.sources.tables import union_all


def table_counts(tables: dict[str, DataFrame], comments: dict[str, str] | None = None) -> DataFrame:
    """Name, rows and comment of every table, counted in one job."""
    comments = comments or {}
    return union_all(
        [
            df.agg(F.count("*").alias("rows")).select(F.lit(n).alias("name"), "rows", F.lit(comments.get(n) or " ").alias("comments"))
            for n, df in tables.items()
        ]
    )


def max_id(df: DataFrame, column: str) -> DataFrame:
    """A07"""
    return df.agg(F.max(column).alias("max_id"))


def view_list(spark: SparkSession, schema: str | None = None) -> DataFrame:
    """C02"""
    rows = [(t.name, t.description or " ") for t in spark.catalog.listTables(schema) if t.tableType in ("VIEW", "TEMPORARY")]
    return spark.createDataFrame(rows, "name string, comments string").orderBy("name")


def table_list(objects: DataFrame, statistics: DataFrame, comments: DataFrame) -> DataFrame:
    """Objects with row counts and comments; unknown counts NULL, missing comments a blank."""
    return (
        objects.filter((F.col("object_type") == "TABLE") & ~F.col("object_name").contains("$"))
        .join(statistics, ["owner", "object_name"], "left")
        .join(comments, ["owner", "object_name"], "left")
        .select("object_name", "num_rows", F.coalesce("comments", F.lit(" ")).alias("comments"))
    )


def schema_columns(tables: dict[str, DataFrame]) -> DataFrame:
    """The columns of DataFrames as a dictionary table: object_name, column_id, column_name, data_type, nullable."""
    spark = next(iter(tables.values())).sparkSession
    rows = [
        (name, i, f.name, f.dataType.simpleString().upper(), "Y" if f.nullable else "N", (f.metadata or {}).get("comment"))
        for name, df in tables.items()
        for i, f in enumerate(df.schema.fields, 1)
    ]
    return spark.createDataFrame(
        rows, "object_name string, column_id int, column_name string, data_type string, nullable string, comments string"
    )


def column_details(columns: DataFrame, comments: DataFrame) -> DataFrame:
    """Columns in declared order with rendered type, YES/NO and comment.

    ``columns``: object_name, column_id, column_name, data_type, data_length, data_precision, data_scale, nullable.
    """
    joined = columns.join(comments, ["object_name", "column_name"], "left")
    rendered = type_text(F.col("data_type"), F.col("data_length"), F.col("data_precision"), F.col("data_scale"))
    return joined.select(
        "object_name",
        "column_id",
        "column_name",
        rendered.alias("data_type"),
        F.when(F.col("nullable") == "Y", "YES").otherwise("NO").alias("nullable"),
        F.coalesce("comments", F.lit(" ")).alias("comments"),
    )


def _quoted(text: Column) -> Column:
    return F.concat(F.lit("'"), F.replace(text, F.lit("'"), F.lit("''")), F.lit("'"))


def comment_statements(table_comments: DataFrame, column_comments: DataFrame) -> DataFrame:
    """The COMMENT statements of every object, table first, then columns by name; quotes doubled."""
    tables = table_comments.filter(F.coalesce("comments", F.lit("")) != "").select(
        "object_name",
        F.lit("").alias("column_name"),
        F.concat(F.lit("COMMENT ON TABLE "), F.upper("object_name"), F.lit(" IS "), _quoted(F.col("comments")), F.lit(";")).alias("statement"),
    )
    columns = column_comments.filter("comments IS NOT NULL").select(
        "object_name",
        "column_name",
        F.concat(
            F.lit("COMMENT ON COLUMN "), F.upper("object_name"), F.lit("."), F.col("column_name"), F.lit(" IS "),
            _quoted(F.col("comments")), F.lit(";"),
        ).alias("statement"),
    )
    return tables.unionByName(columns)


def primary_key_text(constraints: DataFrame, members: DataFrame) -> DataFrame:
    """``name: a, b`` per primary key. ``members``: constraint_name, position, column_name."""
    listed = ordered_concat(members, ["constraint_name"], "position", "column_name", ", ", "columns")
    keys = constraints.filter(F.col("constraint_type") == "P")
    return keys.join(listed, "constraint_name").select(
        "object_name", F.concat_ws(": ", "constraint_name", "columns").alias("key_text")
    )


def foreign_key_text(constraints: DataFrame, members: DataFrame) -> DataFrame:
    """``name: a -> T(b)``; the constraints joined to themselves by the referenced name."""
    listed = ordered_concat(members, ["constraint_name"], "position", "column_name", ", ", "columns")
    referenced = constraints.select(F.col("constraint_name").alias("r_name"), F.col("object_name").alias("r_object"))
    r_listed = listed.select(F.col("constraint_name").alias("rc_name"), F.col("columns").alias("r_columns"))
    joined = (
        constraints.filter(F.col("constraint_type") == "R")
        .join(referenced, match([F.col("r_constraint_name")], [F.col("r_name")]))
        .join(listed, "constraint_name")
        .join(r_listed, match([F.col("r_name")], [F.col("rc_name")]), "left")
    )
    text = F.concat(
        F.col("constraint_name"), F.lit(": "), F.col("columns"), F.lit(" -> "), F.col("r_object"), F.lit("("),
        F.coalesce("r_columns", F.lit("")), F.lit(")"),
    )
    return joined.select("object_name", text.alias("key_text"))


def schema_context(details: DataFrame, kind: str = "テーブル") -> DataFrame:
    """Per object a heading and one line per column with type and comment."""
    line = F.concat(F.lit("  - "), F.col("column_name"), F.lit(" ("), F.col("data_type"), F.lit("): "), F.col("comments"))
    lines = ordered_concat(details.withColumn("line__", line), ["object_name"], "column_id", "line__", "\n", "lines__")
    heading = F.concat(F.lit(f"\n--- {kind}: "), F.col("object_name"), F.lit(" ---\n"))
    return lines.select("object_name", F.concat(heading, F.col("lines__")).alias("context"))


def structure_text(details: DataFrame) -> DataFrame:
    """Per object its columns with type and nullability."""
    line = F.concat(F.lit("- "), F.col("column_name"), F.lit(": "), F.col("data_type"), F.lit(" NULLABLE="), F.col("nullable"))
    lines = ordered_concat(details.withColumn("line__", line), ["object_name"], "column_id", "line__", "\n", "lines__")
    return lines.select(
        "object_name", F.concat(F.lit("OBJECT: "), F.col("object_name"), F.lit("\nCOLUMNS:\n"), F.col("lines__")).alias("structure")
    )


def metadata_prompts(structure: DataFrame, primary: DataFrame, foreign: DataFrame, samples: DataFrame, instruction: str, extra: str = "") -> DataFrame:
    """Instruction, structure, keys and samples of every object as one prompt, and extra text at its end. A missing part is empty."""

    def keyed(df: DataFrame, text: str, name: str) -> DataFrame:
        one = df.groupBy("object_name").agg(F.array_join(F.sort_array(F.collect_list(text)), "\n").alias(name))
        return one.withColumn(name, F.concat(F.lit("OBJECT: "), F.col("object_name"), F.lit("\n"), F.col(name)))

    joined = (
        structure.join(keyed(primary, "key_text", "pk"), "object_name", "left")
        .join(keyed(foreign, "key_text", "fk"), "object_name", "left")
        .join(samples, "object_name", "left")
    )
    parts = [("構造", "structure"), ("主キー", "pk"), ("外部キー", "fk"), ("サンプル", "sample_text")]  # fixed values: headings
    body = [F.concat(F.lit(f"<{h}>\n"), F.coalesce(F.col(c), F.lit("")), F.lit("\n\n")) for h, c in parts]
    return joined.select("object_name", F.concat(F.lit(instruction + "\n"), *body, F.lit(extra)).alias("prompt"))


# -- profiles --------------------------------------------------------------------------------------------------------


def latest_attributes(attributes: DataFrame) -> DataFrame:
    """A10: one value per profile and lower-case attribute name; blank names skipped; the last one (``seq``) wins."""
    profile, name = strip(F.col("profile_name")), F.lower(strip(F.col("attribute_name")))
    return (
        attributes.select(profile.alias("profile"), name.alias("attribute"), "attribute_value", "seq")
        .filter((F.coalesce("profile", F.lit("")) != "") & (F.coalesce("attribute", F.lit("")) != ""))
        .groupBy("profile", "attribute")
        .agg(F.max_by("attribute_value", "seq").alias("value"))
    )


def attribute_maps(attributes: DataFrame) -> DataFrame:
    """A10: one map per profile. Duplicates are gone before the map is built, spread over (profile, attribute)."""
    return (
        latest_attributes(attributes)
        .groupBy("profile")
        .agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("attribute", "value")))).alias("attributes"))
    )


def listed_objects(profiles: DataFrame, column: str) -> DataFrame:
    """The names in an object list that is a JSON list, a single object, or a list of plain names."""
    parsed = compute_once(profiles, {"node__": F.try_parse_json(F.col(column))})
    node = F.col("node__")
    kind = F.schema_of_variant(node)
    items = F.when(kind.startswith("ARRAY"), F.try_variant_get(node, "$", "array<variant>")).when(
        kind.startswith("OBJECT"), F.array(node)
    )
    named = parsed.select("profile", F.explode(items).alias("item"))
    is_object = F.schema_of_variant("item").startswith("OBJECT")
    name = F.when(is_object, F.try_variant_get("item", "$.name", "string")).otherwise(variant_text(F.col("item")))
    return named.select("profile", strip(name).alias("name")).filter(F.col("name") != "").distinct()


def split_objects(profiles: DataFrame, column: str, catalog: DataFrame) -> DataFrame:
    """The tables and the views of each profile, sorted, as text. ``catalog``: name, kind (TABLE or VIEW).

    Names are looked up as written first, then in upper case; a table wins over a view of the same name.
    """
    exact = catalog.groupBy(F.col("name").alias("e_name")).agg(F.min("kind").alias("e_kind"))
    folded = catalog.groupBy(F.upper("name").alias("f_key")).agg(F.min(F.struct("kind", "name")).alias("f"))
    found = (
        listed_objects(profiles, column)
        .join(exact, match([F.col("name")], [F.col("e_name")]), "left")
        .join(folded, match([F.upper("name")], [F.col("f_key")]), "left")
        .select("profile", F.coalesce("e_kind", "f.kind").alias("kind"), F.coalesce("e_name", "f.name").alias("name"))
        .filter("kind IS NOT NULL")
        .distinct()
    )

    def names(kind: str) -> Column:
        return F.array_join(F.sort_array(F.collect_list(F.when(F.col("kind") == kind, F.col("name")))), ", ")

    return found.groupBy("profile").agg(names("TABLE").alias("tables"), names("VIEW").alias("views"))


def profile_table(
    profiles: DataFrame, attributes: DataFrame, catalog: DataFrame, kept_categories: DataFrame | None = None, service_entry: str | None = None
) -> DataFrame:
    """Profiles (name, category) with objects, region and models; a stored category wins over the description."""
    name = strip(F.col("name"))
    named = profiles.select(name.alias("profile"), F.coalesce("category", F.lit("")).alias("category")).filter(F.coalesce("profile", F.lit("")) != "")
    if service_entry:
        named = named.filter(F.upper("profile") != service_entry.upper())
    values = latest_attributes(attributes)

    def attribute(key: str) -> Column:
        return F.max(F.when(F.col("attribute") == key, F.col("value"))).alias(f"a_{key}")

    keys = ["object_list", "region", "model", "embedding_model"]
    wide = values.filter(F.col("attribute").isin(*keys)).groupBy(F.col("profile").alias("a_profile")).agg(*[attribute(k) for k in keys])
    joined = named.join(wide, F.col("profile") == F.col("a_profile"), "left")
    objects = split_objects(joined.select("profile", F.col("a_object_list").alias("object_list")), "object_list", catalog).withColumnRenamed(
        "profile", "o_profile"
    )
    joined = joined.join(objects, F.col("profile") == F.col("o_profile"), "left")
    category = F.col("category")
    if kept_categories is not None:
        kept = (
            kept_categories.select(F.lower(strip(F.col("profile"))).alias("k_profile"), not_blank(strip(F.col("category"))).alias("k_category"))
            .filter("k_category IS NOT NULL")
            .groupBy("k_profile")
            .agg(F.max("k_category").alias("k_category"))
        )
        joined = joined.join(kept, F.lower("profile") == F.col("k_profile"), "left")
        category = F.coalesce("k_category", "category")
    return joined.select(
        "profile",
        category.alias("category"),
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("tables", "views")],
        *[F.coalesce(f"a_{k}", F.lit("")).alias(k) for k in ("region", "model", "embedding_model")],
    )


def normalise_entries(entries: DataFrame, name: str, texts: list[str]) -> DataFrame:
    """Trimmed names, NULL texts empty, nameless entries dropped, sorted by name in any case."""
    return (
        entries.select(strip(F.col(name).cast("string")).alias(name), *[F.coalesce(F.col(t).cast("string"), F.lit("")).alias(t) for t in texts])
        .filter(F.coalesce(F.col(name), F.lit("")) != "")
        .orderBy(F.upper(name).asc_nulls_last(), F.col(name))
    )


def status_rows(status: DataFrame, rows: int | None = None) -> DataFrame:
    """The known status columns that are present; all rows, or at most ``rows``."""
    keep = [c for c in ("ID", "NAME", "ROWS_LOADED", "STATUS") if c in status.columns]  # fixed values
    return (status if rows is None else status.limit(rows)).select(*(keep or status.columns))
