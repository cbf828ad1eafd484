"""Tolerant CSV loads with a reject table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.functions.dates import clean_date_text, parse_clean_date
from silverlode.functions.text import not_blank
from silverlode.operators.staging import compute_once
from silverlode.sources.csv_split import records
from silverlode.sources.tables import PREVIEW_ROWS

SHARED_CATEGORY = "共通"  # fixed value: the category whose rules apply everywhere
REPORTED_REJECTS = 5  # fixed value: rejects shown to the user


@dataclass(frozen=True)
class CsvLoad:
    accepted: DataFrame
    rejected: DataFrame
    judged: DataFrame  # every record, with its ``reason`` (empty: accepted)

    def counts(self) -> DataFrame:
        """Accepted and rejected row counts, from one pass over the records."""
        both = self.judged.agg(F.count_if(F.col("reason") == "").alias("accepted"), F.count_if(F.col("reason") != "").alias("rejected"))
        return both.select(F.expr("stack(2, 'accepted', accepted, 'rejected', rejected) AS (outcome, rows)"))

    def reported(self) -> DataFrame:
        """The rejects to show; the reject table itself is complete."""
        return self.rejected.limit(REPORTED_REJECTS)


MALFORMED = "_malformed"


def _reader(spark: SparkSession, multi_line: bool, header: bool, options: dict):
    return spark.read.options(header=header, multiLine=multi_line, escape='"', **options)


def _with_malformed(names: list[str]) -> str:
    return ", ".join("`" + n.replace("`", "``") + "` string" for n in [*names, MALFORMED])


def _by_file(spark: SparkSession, path: str, names: list[str], header: bool, multi_line: bool, options: dict) -> DataFrame:
    reader = _reader(spark, multi_line, header, options)
    return reader.options(enforceSchema=False, mode="PERMISSIVE", columnNameOfCorruptRecord=MALFORMED).schema(_with_malformed(names)).csv(path)


def read_text_csv(spark: SparkSession, path: str, multi_line: bool = True, names: list[str] | None = None, **options) -> DataFrame:
    """A CSV file, or a folder of them, every column as text: no inference pass over the data.

    Files have a header, or ``names`` gives the columns of files without one. A record may go over several lines inside
    quotes; one file is read by many tasks all the same (``csv_split``: a first pass counts quotes per byte range).
    ``multi_line=False`` saves that pass, for data known to have one record per line. A record with too many or too
    few cells is kept whole in ``_malformed``, and the load rejects it. ``options``: those of Spark's reader; with any other
    than ``sep`` and ``quote`` a file with records of several lines is read by one task.
    """
    header = names is None
    names = names or _reader(spark, multi_line, True, options).csv(path).columns
    cut = records(spark, path, options.get("sep", ","), options.get("quote", '"')) if multi_line and set(options) <= {"sep", "quote"} else None
    if cut is None:
        return _by_file(spark, path, names, header, multi_line, options)
    settings = {**options, "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED}
    rows = compute_once(cut, {"cells__": F.from_csv("record", _with_malformed(names), settings)})
    if header:
        cells = F.array(*[F.coalesce(F.col("cells__").getField(n), F.lit("")) for n in names])
        same = F.lower(F.array_join(cells, "\n")) == F.lit("\n".join(names).lower())
        wrong = F.raise_error(F.concat(F.lit("not the header of the first file: "), F.col("record"))).cast("boolean")
        rows = rows.where(F.when(~F.col("first"), True).when(same, False).otherwise(wrong))
    return rows.select(*[F.col("cells__").getField(n).alias(n) for n in [*names, MALFORMED]])


def preview_csv(spark: SparkSession, path: str) -> DataFrame:
    """The first rows; fails on a file without rows. Reads no further than it needs."""
    names = _reader(spark, True, True, {}).csv(path).columns
    head = _by_file(spark, path, names, True, True, {}).drop(MALFORMED).limit(PREVIEW_ROWS)
    if head.isEmpty():
        raise ValueError("the CSV file holds no rows")
    return head


def _is_date(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType))


def typed(value: Column, dtype: T.DataType) -> Column:
    return (parse_clean_date(value) if _is_date(dtype) else value.try_cast(dtype)).cast(dtype)


def load_csv(
    rows: DataFrame,
    schema: T.StructType,
    defaults: dict[str, Column] | None = None,
    unread_dates: str = "reject",
) -> CsvLoad:
    """Conform text rows to a table.

    Headers match table columns in any case; other CSV columns are dropped, table columns without a CSV column take
    their default. A value that cannot be read, or a NULL in a NOT NULL column, sends the row to the rejects with the
    reasons. ``unread_dates``: ``reject`` (default) or ``null`` (keep the row, date NULL).

    Accepted and rejected are two filters over the same narrow plan, without a shuffle.
    """
    if unread_dates not in {"reject", "null"}:
        raise ValueError(f"unread_dates: {unread_dates}")
    by_name = {c.upper(): c for c in rows.columns if c != MALFORMED}
    defaults = defaults or {}
    present = [f for f in schema.fields if f.name.upper() in by_name]
    if not present:
        raise ValueError("no CSV column matches a table column")

    source = [F.col(f"`{c}`").alias(f"s{i}__") for i, c in enumerate(rows.columns)]
    texts, values, problems = {}, {}, []
    if MALFORMED in rows.columns:
        whole = F.col(f"s{rows.columns.index(MALFORMED)}__")
        problems.append(F.when(whole.isNotNull(), F.concat(F.lit("malformed record "), whole)))
    for i, f in enumerate(present):
        raw = not_blank(F.col(f"s{rows.columns.index(by_name[f.name.upper()])}__"))
        texts[f"t{i}__"] = clean_date_text(raw) if _is_date(f.dataType) else raw
        text, value = F.col(f"t{i}__"), F.col(f"v{i}__")
        values[f"v{i}__"] = typed(text, f.dataType)
        strict = not _is_date(f.dataType) or unread_dates == "reject"
        if strict and not isinstance(f.dataType, T.StringType):
            problems.append(F.when(text.isNotNull() & value.isNull(), F.concat(F.lit(f"{f.name}: unreadable value "), text)))
        if not f.nullable:
            problems.append(F.when((text if strict else value).isNull(), F.lit(f"{f.name}: NULL not allowed")))
    position = {f.name: i for i, f in enumerate(present)}
    out = []
    for f in schema.fields:
        if f.name in position:
            out.append(F.col(f"v{position[f.name]}__").alias(f.name))
            continue
        default = defaults.get(f.name, F.lit(None)).cast(f.dataType)
        out.append(default.alias(f.name))
        if not f.nullable:
            problems.append(F.when(default.isNull(), F.lit(f"{f.name}: NULL not allowed")))
    staged = compute_once(compute_once(rows.select(*source), texts), values)
    staged = staged.withColumn("reason", F.concat_ws("; ", *problems) if problems else F.lit(""))
    accepted = staged.filter("reason = ''").select(*out)
    row = F.struct(*[F.col(f"s{i}__").alias(c) for i, c in enumerate(rows.columns) if c != MALFORMED])
    rejected = staged.filter("reason <> ''").select("reason", F.to_json(row).alias("source_row"))
    return CsvLoad(accepted, rejected, staged)


def publish_csv(load: CsvLoad, table: str, mode: str = "INSERT") -> None:
    """INSERT appends, TRUNCATE & INSERT replaces."""
    modes = {"INSERT": False, "TRUNCATE & INSERT": True}
    if mode not in modes:
        raise ValueError(f"mode: {mode}")
    load.accepted.write.insertInto(table, overwrite=modes[mode])


def reference_table(rows: DataFrame, required: list[str], fill: dict[str, str] | None = None) -> DataFrame:
    """Exactly the required columns, headers in any case; a column named in ``fill`` may be missing."""
    by_name = {c.upper(): c for c in rows.columns}
    fill = fill or {}
    missing = [c for c in required if c.upper() not in by_name and c not in fill]
    if missing:
        raise ValueError(f"required columns missing: {', '.join(missing)}")
    return rows.select(
        *[
            (F.col(f"`{by_name[c.upper()]}`") if c.upper() in by_name else F.lit(fill[c])).alias(c)
            for c in required
        ]
    )


def training_table(rows: DataFrame) -> DataFrame:
    return reference_table(rows, ["CATEGORY", "TEXT"])


def glossary_table(rows: DataFrame) -> DataFrame:
    return reference_table(rows, ["TERM", "DEFINITION"])


def rules_table(rows: DataFrame) -> DataFrame:
    return reference_table(rows, ["CATEGORY", "RULE"], {"CATEGORY": SHARED_CATEGORY})
