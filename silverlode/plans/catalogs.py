"""Registered queries: tables of the session's catalog, result caps, the times of a batch's steps."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from silverlode.operators import catalog, mutate
from silverlode.plans.changes import _BATCH_STEPS_SQL, _batch
from silverlode.plans.guarding import _reader
from silverlode.session import work_folder
from silverlode.sources import tables
from silverlode.sources.layers import Layer
from silverlode.sources.tables import MODEL_SQL_RESULT_CAP, read_folder, union_all


def _counted(step: str, frame, **flags):
    """One row: the step, its rows, and what it answered."""
    told = "; ".join(f"{k}={v}" for k, v in flags.items())
    return frame.agg(F.lit(step).alias("step"), F.count("*").alias("rows"), F.lit(told).alias("answer"))


def catalog_tables(spark, folder):
    """A table created once, appended to, read, listed, replaced; one registered over a layer; a view. They are dropped again."""
    name = f"silverlode_{uuid.uuid4().hex[:12]}"
    supplier = read_folder(spark, folder, "supplier")
    layer = Layer(spark, work_folder(spark, "registered"))
    held, out = [], []

    def step(label, frame, **flags):
        out.append(_counted(label, frame, **flags).first())

    try:
        created, present = tables.create_if_missing(spark, name, supplier.schema)
        held.append(f"TABLE {name}")
        step("S08 created", spark.table(name), created=created, present=present)
        tables.append_by_position(supplier, name)
        step("S06 appended", tables.read_table(spark, name))
        created, present = tables.create_if_missing(spark, name, supplier.schema)
        step("S08 kept", spark.table(name), created=created, present=present)
        loaded = tables.reload_table(supplier.where("s_acctbal >= 0"), name)
        step("S07 replaced", spark.table(name), loaded=loaded)
        layer.write(supplier.where("s_acctbal < 0"))
        registered = tables.register_table(spark, f"{name}_layer", layer.path(0))
        held.append(f"TABLE {name}_layer")
        step("S03 registered", registered)
        step("S03 registered again", layer.register(f"{name}_layer"))
        supplier.createOrReplaceTempView(f"{name}_view")
        listed = tables.list_tables(spark).where(F.col("name").startswith(name))
        step("S01 listed", listed, kinds=",".join(sorted({r.table_type for r in listed.collect()})))
        step("C02 views", catalog.view_list(spark).where(F.col("name") == f"{name}_view"))
        stamped = mutate.replace_snapshot(spark.table(name))
        step("M07 stamped", stamped.where("updated_at <= current_timestamp()"), columns=len(stamped.columns) - len(supplier.columns))
    finally:
        for one in held:
            spark.sql(f"DROP TABLE IF EXISTS {one.split()[1]}")
        spark.catalog.dropTempView(f"{name}_view")
    return spark.createDataFrame(out, "step string, rows long, answer string")


def result_caps(spark, folder):
    """A model's SQL returns at most 10,000 rows, the trial of an access rule at most 1,000; a smaller result is whole."""
    lineitem, reader = read_folder(spark, folder, "lineitem"), _reader(spark, folder)
    return union_all(
        [
            _counted("model SQL", tables.model_rows(lineitem), cap=MODEL_SQL_RESULT_CAP),
            _counted("model SQL, few rows", tables.model_rows(lineitem.where("l_quantity < 2"))),
            _counted("rule trial", reader.trial("orders", "BUILDING"), cap=tables.RULE_TEST_RESULT_CAP),
            _counted("rule trial, full", reader.trial("supplier", "anyone")),
        ]
    )


def batch_timed(spark, folder):
    """All seven columns of a batch's summary, each step with a time of its own: one that works, and one that fails after a TRUNCATE."""
    orders, steps = _batch(spark, folder)
    broken = [steps[0], mutate.truncate_step(), steps[2], mutate.update_step({"no_such_column": 1})]
    runs = {"good": mutate.run_batch(orders, steps, timed=True), "broken": mutate.run_batch(orders, broken, timed=True)}
    return union_all(
        [
            batch.summary.select(F.lit(run).alias("run"), "No", "Type", "Status", "RowsAffected", "Message", "Permanent", (F.col("Duration_ms") >= 0).alias("timed"))
            for run, batch in runs.items()
        ]
    )


BATCH_TIMED_SQL = _BATCH_STEPS_SQL + """,
steps(run, "No", "Type", rows) AS (SELECT 'good', 1, 'UPDATE', n1 FROM n UNION ALL SELECT 'good', 2, 'DELETE', n2 FROM n UNION ALL SELECT 'good', 3, 'INSERT', n3 FROM n
  UNION ALL SELECT 'good', 4, 'MERGE', n4 FROM n UNION ALL SELECT 'good', 5, 'DELETE', n5 FROM n
  UNION ALL SELECT 'broken', 1, 'UPDATE', n1 FROM n UNION ALL SELECT 'broken', 2, 'TRUNCATE', n0 FROM n UNION ALL SELECT 'broken', 3, 'INSERT', n3 FROM n)
SELECT run, "No", "Type", '成功' AS "Status", rows AS "RowsAffected", 'RowsAffected=' || rows AS "Message",
  CASE WHEN run = 'broken' AND "No" = 3 THEN 'ロールバック済み' ELSE '確定' END AS "Permanent", true AS timed FROM steps
UNION ALL SELECT 'broken', 4, 'UPDATE', '失敗', -1, 'unknown columns: no_such_column', '未反映', true"""
QUERIES = {
    "catalog_tables": (
        catalog_tables,
        """WITH s AS (SELECT count(*) AS n, count(*) FILTER (s_acctbal >= 0) AS good FROM supplier)
        SELECT 'S08 created' AS step, 0 AS rows, 'created=True; present=0' AS answer UNION ALL SELECT 'S06 appended', n, '' FROM s
        UNION ALL SELECT 'S08 kept', n, 'created=False; present=' || n FROM s UNION ALL SELECT 'S07 replaced', good, 'loaded=' || good FROM s
        UNION ALL SELECT 'S03 registered', n - good, '' FROM s UNION ALL SELECT 'S03 registered again', n - good, '' FROM s
        UNION ALL SELECT 'S01 listed', 3, 'kinds=EXTERNAL,MANAGED,TEMPORARY' UNION ALL SELECT 'C02 views', 1, '' UNION ALL SELECT 'M07 stamped', good, 'columns=1' FROM s""",
    ),
    "batch_timed": (batch_timed, BATCH_TIMED_SQL),
    "result_caps": (
        result_caps,
        """SELECT 'model SQL' AS step, least(10000, count(*)) AS rows, 'cap=10000' AS answer FROM lineitem UNION ALL
        SELECT 'model SQL, few rows', least(10000, count(*)), '' FROM lineitem WHERE l_quantity < 2 UNION ALL
        SELECT 'rule trial', least(1000, count(*)), 'cap=1000' FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
        UNION ALL SELECT 'rule trial, full', least(1000, count(*)), '' FROM supplier""",
    ),
}
