"""Versioned tables made of files.

A layer is a folder. Every write puts its files into a data folder of its own, which nothing writes to again. A version is a
list of files with, per file, its rows and the least and greatest value of each column that files are found by; it is
published after its data is complete, as the one row of ``manifest/version=N`` that names the list. Readers see only
published versions, so a job that dies half way leaves nothing visible. If two writers publish the same version, the
second one fails and the published version stays as it is.

A change (``merge_keys``, ``update_where``, ``delete_where``) looks up by key range which files can hold rows it touches, reads
and writes only these, and publishes a list in which all other files stand as before.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.operators import mutate
from silverlode.sources.tables import register_table, union_all

MANIFEST_SCHEMA = "row_count long, published_at timestamp, folder string, schema string, file_list string, version long"
RANGED = (T.IntegralType, T.FractionalType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType)
STARTS = 256  # characters of a text that are kept as its range
STRETCHES = 256  # stretches of keys that a set of changes is looked up by


@dataclass(frozen=True)
class Changed:
    """What a change did: the new version, files read and written anew, files taken over, files added."""

    version: int
    rewritten: int
    kept: int
    added: int


@dataclass(frozen=True)
class Layer:
    spark: SparkSession
    root: str
    _seen: dict = field(default_factory=dict, compare=False, repr=False)  # published versions never change

    def _at(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    def _published(self, version: int):
        if version not in self._seen:
            row = self.versions().filter(F.col("version") == version).first()
            if row is None:
                raise ValueError(f"version {version} of {self.root} is not published")
            self._seen[version] = row
        return self._seen[version]

    def path(self, version: int) -> str:
        """The data folder of a version that was written as a whole."""
        folder = self._published(version).folder
        if folder is None:
            raise ValueError(f"version {version} of {self.root} stands in several folders")
        return self._at(folder)

    def versions(self) -> DataFrame:
        """Published versions; empty when nothing has been published."""
        try:
            return self.spark.read.schema(MANIFEST_SCHEMA).json(self._at("manifest"))
        except AnalysisException:
            return self.spark.createDataFrame([], MANIFEST_SCHEMA)

    def latest(self) -> int | None:
        return self.versions().agg(F.max("version")).first()[0]

    def files(self, version: int) -> DataFrame:
        """The files of a version: ``file`` (below the root), ``rows``, and ``low <column>``, ``high <column>`` for its ranges."""
        row = self._published(version)
        if row.file_list is None:
            return _file_list(self.spark.read.parquet(self._at(row.folder)))
        return self.spark.read.parquet(self._at(row.file_list))

    # -- writing ----------------------------------------------------------------------------------------------------------

    def _write_files(self, df: DataFrame) -> tuple[str, DataFrame]:
        """The rows in a data folder of their own, and the list of its files."""
        folder = f"data-{uuid.uuid4().hex}"
        df.write.mode("errorifexists").parquet(self._at(folder))
        return folder, _file_list(self.spark.read.schema(df.schema).parquet(self._at(folder)))

    def _publish(self, version: int, files: DataFrame, schema: T.StructType, folder: str | None) -> int:
        name = f"list-{uuid.uuid4().hex}"
        files.write.mode("errorifexists").parquet(self._at(name))
        rows = self.spark.read.parquet(self._at(name)).agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
        row = self.spark.createDataFrame([(rows, folder, schema.json(), name)], "row_count long, folder string, schema string, file_list string")
        row.withColumn("published_at", F.current_timestamp()).coalesce(1).write.mode("errorifexists").json(self._at("manifest", f"version={version}"))
        if self._published(version).file_list != name:
            raise RuntimeError(f"version {version} of {self.root} was published by another writer")
        return version

    def write(self, df: DataFrame, merge_schema: bool = False) -> int:
        """Publish the rows as the next version and return its number.

        With ``merge_schema`` new columns are accepted and columns that only the last version has are kept as NULL.
        """
        last = self.latest()
        if merge_schema and last is not None:
            df = self.read(last).limit(0).unionByName(df, allowMissingColumns=True)
        folder, files = self._write_files(df)
        return self._publish(0 if last is None else last + 1, files, df.schema, folder)

    # -- reading ----------------------------------------------------------------------------------------------------------

    def _frame(self, files: list[str], schema: T.StructType) -> DataFrame:
        if not files:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[self._at(f) for f in files])

    def read(self, version: int | None = None) -> DataFrame:
        """The snapshot as of a version; the latest when none is given."""
        last = self.latest()
        if last is None or (version is not None and not 0 <= version <= last):
            raise ValueError(f"version {version} of {self.root} is not published")
        row = self._published(last if version is None else version)
        if row.folder is not None:
            return self.spark.read.parquet(self._at(row.folder))
        names = [r.file for r in self.files(row.version).select("file").collect()]
        return self._frame(names, T.StructType.fromJson(json.loads(row.schema)))

    def register(self, name: str, version: int | None = None) -> DataFrame:
        """(re)register a table over a version; a version that stands in several folders becomes a view."""
        chosen = self.latest() if version is None else version
        if self._published(chosen).folder is not None:
            return register_table(self.spark, name, self.path(chosen))
        self.read(chosen).createOrReplaceTempView(name)
        return self.spark.table(name)

    def has_data(self) -> bool:
        return self.latest() is not None

    # -- changes ----------------------------------------------------------------------------------------------------------

    def _change(self, touched: DataFrame, new_rows, schema: T.StructType) -> Changed:
        """Publish the last version with the touched files (column ``file``) replaced by ``new_rows(their rows)``."""
        last = self.latest()
        before = self.files(last)
        names = [r.file for r in touched.select("file").distinct().collect()]
        rows = new_rows(self._frame(names, schema))
        folder, added = self._write_files(rows) if rows is not None else (None, None)
        kept = before.join(self.spark.createDataFrame([(n,) for n in names], "file string"), "file", "left_anti")
        files = kept if added is None else kept.unionByName(added, allowMissingColumns=True)
        new = added.count() if added is not None else 0
        version = self._publish(last + 1, files, schema, None)
        return Changed(version, len(names), self.files(version).count() - new, new)

    def _state(self) -> tuple[DataFrame, T.StructType]:
        """The files of the last version, and its schema."""
        last = self.latest()
        if last is None:
            raise ValueError(f"{self.root} holds no version")
        return self.files(last), self.read(last).schema

    def merge_keys(self, changes: DataFrame, keys: Sequence[str], update: dict | None = None, insert: dict | None = None) -> Changed:
        """M03 on the last version (see ``mutate.merge``): only files with a matching row are written anew.

        Files whose key ranges the changes do not meet are not read; of the others, those are touched that hold a key.
        """
        files, schema = self._state()
        candidates = files.where(_meets(files, changes, keys, schema))
        names = [r.file for r in candidates.select("file").collect()]
        own = _with_file(self._frame(names, schema), names)
        wanted = changes.select(*[F.col(f"`{k}`").alias(f"{k}__c") for k in keys]).distinct()
        hit = own.join(wanted, mutate.match_keys(own, wanted, [(k, f"{k}__c") for k in keys]), "left_semi").select("file")
        return self._change(hit, lambda part: mutate.merge(part, changes, keys, update, insert), schema)

    def _touched(self, where: str | Column) -> tuple[DataFrame, T.StructType]:
        files, schema = self._state()
        names = [r.file for r in files.select("file").collect()]
        return _with_file(self._frame(names, schema), names).where(where).select("file"), schema

    def update_where(self, values: dict[str, object], where: str | Column) -> Changed:
        """M02 on the last version: only files with a row that the predicate holds for are written anew."""
        touched, schema = self._touched(where)
        return self._change(touched, lambda part: mutate.update_where(part, values, where), schema)

    def delete_where(self, where: str | Column) -> Changed:
        """M01, likewise."""
        touched, schema = self._touched(where)
        return self._change(touched, lambda part: mutate.delete_where(part, where), schema)

    def append(self, rows: DataFrame) -> Changed:
        """Files are added, none is read."""
        files, schema = self._state()
        return self._change(files.limit(0), lambda part: mutate.insert_rows(part, rows), schema)


def _file_of(path: Column) -> Column:
    """Folder and name of a file, as they stand below the root."""
    return F.regexp_extract(path, "([^/]+/[^/]+)$", 1)


def _with_file(rows: DataFrame, files: list[str]) -> DataFrame:
    if not files:
        return rows.withColumn("file", F.lit(None).cast("string"))
    return rows.select("*", _file_of(F.col("_metadata.file_path")).alias("file"))


def _short(value: Column, dtype: T.DataType) -> Column:
    """Texts are ranged by how they begin, which keeps their order."""
    return F.substring(value, 1, STARTS) if isinstance(dtype, T.StringType) else value


def _file_list(data: DataFrame) -> DataFrame:
    ranged = [f for f in data.schema.fields if isinstance(f.dataType, RANGED)]
    sides = [side(_short(F.col(f"`{f.name}`"), f.dataType)).alias(f"{name} {f.name}") for f in ranged for name, side in (("low", F.min), ("high", F.max))]
    return data.groupBy(_file_of(F.col("_metadata.file_path")).alias("file")).agg(F.count("*").alias("rows"), *sides)


def _meets(files: DataFrame, changes: DataFrame, keys: Sequence[str], schema: T.StructType) -> Column:
    """Whether a file's range of every key meets one of at most ``STRETCHES`` stretches of the changes' keys.

    Files without a range for a key, and keys of another type than the table's, decide nothing here.
    """
    out = F.lit(True)
    for k in keys:
        dtype = schema[k].dataType
        if changes.schema[k].dataType != dtype or f"low {k}" not in files.columns:
            continue
        value = _short(F.col(f"`{k}`"), dtype).alias("k")
        known = changes.select(value).where("k is not null").distinct()
        head = known.limit(STRETCHES + 1).collect()
        if len(head) <= STRETCHES:
            stretches = [(r.k, r.k) for r in head]
        else:
            dealt = known.repartitionByRange(STRETCHES, "k").groupBy(F.spark_partition_id()).agg(F.min("k").alias("low"), F.max("k").alias("high"))
            stretches = [(r.low, r.high) for r in dealt.collect()]
        own = F.array(*[F.struct(F.lit(a).cast(dtype).alias("low"), F.lit(b).cast(dtype).alias("high")) for a, b in stretches])
        low, high = F.col(f"`low {k}`"), F.col(f"`high {k}`")
        meets = F.exists(own, lambda x: (x["low"] <= high) & (x["high"] >= low)) if stretches else F.lit(False)
        out = out & F.coalesce(meets, F.lit(False))
    return out


def delta_as_of(spark: SparkSession, path: str, version: int) -> DataFrame:
    """S04 where the Delta format is on the class path."""
    return spark.read.format("delta").option("versionAsOf", version).load(path)


def layer_health(spark: SparkSession, prefixes: list[str], layers: dict[str, str]) -> DataFrame:
    """One row per layer: found under any prefix, latest version, row count."""
    rows = []
    for label, relative in layers.items():
        frames = [
            Layer(spark, f"{prefix.rstrip('/')}/{relative}")
            .versions()
            .select(F.struct("version", "row_count").alias("v"))
            for prefix in prefixes
        ]
        rows.append(
            union_all(frames)
            .agg(F.max("v").alias("v"))
            .select(
                F.lit(label).alias("layer"),
                F.col("v").isNotNull().alias("present"),
                F.col("v.version").alias("version"),
                F.coalesce("v.row_count", F.lit(0)).cast("long").alias("row_count"),
            )
        )
    return union_all(rows)


def table_health(spark: SparkSession, names: list[str]) -> DataFrame:
    """S14 for catalog tables: existence and row count."""
    frames = [
        spark.table(n).agg(F.count("*").alias("row_count")).select(F.lit(n).alias("name"), F.lit(True).alias("present"), "row_count")
        if spark.catalog.tableExists(n)
        else spark.range(1).select(F.lit(n).alias("name"), F.lit(False).alias("present"), F.lit(0).cast("long").alias("row_count"))
        for n in names
    ]
    return union_all(frames)
