"""Registered queries: table changes, batches, snapshots, CSV loads, dates."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.functions.dates import clean_date_text, parse_clean_date
from silverlode.operators import mutate
from silverlode.operators.quality import quality_filter
from silverlode.plans.guarding import derived
from silverlode.session import work_folder
from silverlode.sources import csv_load
from silverlode.sources.layers import Layer, layer_health
from silverlode.sources.tables import DEFAULT_RESULT_CAP, browse, distinct_names, keyword_search, read_folder, union_all


def _parts_as_customers(spark, folder):
    """A change set with the customer's columns: part keys run past the customer keys, so it updates and inserts."""
    return read_folder(spark, folder, "part").select(
        F.col("p_partkey").alias("c_custkey"), F.col("p_name").alias("c_name"), F.col("p_retailprice").alias("c_acctbal")
    )


def merge_upsert(spark, folder):
    customer = read_folder(spark, folder, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    return mutate.merge(customer, _parts_as_customers(spark, folder), ["c_custkey"])


def update_where(spark, folder):
    orders = read_folder(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    changes = {"o_orderpriority": "0-CLOSED", "o_totalprice": F.lit(0.0)}
    return mutate.update_where(orders, changes, "o_orderstatus = 'F' AND o_totalprice < 200000")


def delete_where(spark, folder):
    orders = read_folder(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return mutate.delete_where(orders, F.col("o_totalprice") < 50000)


def _suppliers_as_customers(spark, folder):
    return read_folder(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("c_custkey"), F.col("s_name").alias("c_name"), F.col("s_acctbal").alias("c_acctbal")
    )


def truncate_insert(spark, folder):
    customer = read_folder(spark, folder, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    return mutate.insert_rows(mutate.truncate(customer), _suppliers_as_customers(spark, folder))


def insert_rows(spark, folder):
    customer = read_folder(spark, folder, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    return mutate.insert_rows(customer, _suppliers_as_customers(spark, folder))


def remove_by_key(spark, folder):
    part = read_folder(spark, folder, "part").select("p_partkey", "p_name")
    gone = read_folder(spark, folder, "part").filter("p_size >= 48").select(F.upper("p_name").alias("p_name"))
    return mutate.remove_by_key(part, gone, "p_name")


def upsert_by_name(spark, folder):
    entries = read_folder(spark, folder, "customer").select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("rows"))
    changed = read_folder(spark, folder, "supplier").select(
        F.upper(F.concat(F.lit("customer"), F.substring("s_name", 9, 10))).alias("name"), F.col("s_acctbal").alias("rows")
    )
    return mutate.upsert_by_name(entries, changed, "name")


def _batch(spark, folder):
    orders = read_folder(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    new = read_folder(spark, folder, "customer").select(
        (-F.col("c_custkey") - 1).alias("o_orderkey"), F.col("c_custkey").alias("o_custkey"), F.col("c_acctbal").alias("o_totalprice")
    )
    repriced = read_folder(spark, folder, "part").select(F.col("p_partkey").alias("o_orderkey"), F.col("p_retailprice").alias("o_totalprice"))
    steps = [
        mutate.update_step({"o_totalprice": F.col("o_totalprice") * 2}, F.col("o_totalprice") < 100000),
        mutate.delete_step("o_totalprice > 400000"),
        mutate.insert_step(new),
        mutate.merge_step(repriced, ["o_orderkey"]),
        mutate.delete_step("o_totalprice < 0"),
    ]
    return orders, steps


def batch_summary(spark, folder):
    return mutate.affected_rows(*_batch(spark, folder))


def batch_outcome(spark, folder):
    """The strict batch and, with a broken step in the middle, the strict and the lenient one."""
    orders, steps = _batch(spark, folder)
    broken = [*steps[:2], mutate.update_step({"no_such_column": 1}), *steps[2:]]
    runs = {
        "strict": mutate.run_batch(orders, steps),
        "strict_broken": mutate.run_batch(orders, broken),
        "lenient_broken": mutate.run_lenient(orders, broken),
    }
    return union_all(
        [
            batch.outcome().select(F.lit(name).alias("run"), "*", batch.table.agg(F.count("*")).scalar().alias("rows_after"))
            for name, batch in runs.items()
        ]
    )


_BATCH_STEPS_SQL = """
WITH s1 AS (SELECT o_orderkey, o_custkey, CASE WHEN o_totalprice < 100000 THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice
            FROM orders),
s2 AS (SELECT * FROM s1 WHERE NOT o_totalprice > 400000),
new AS (SELECT -c_custkey - 1 AS o_orderkey, c_custkey AS o_custkey, c_acctbal AS o_totalprice FROM customer),
s3 AS (SELECT * FROM s2 UNION ALL SELECT * FROM new),
m AS (SELECT p_partkey AS o_orderkey, p_retailprice AS o_totalprice FROM part),
s4 AS (SELECT s3.o_orderkey, s3.o_custkey, coalesce(m.o_totalprice, s3.o_totalprice) AS o_totalprice
       FROM s3 LEFT JOIN m USING (o_orderkey)
       UNION ALL SELECT o_orderkey, NULL, o_totalprice FROM m WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s3)),
n AS (SELECT (SELECT count(*) FROM orders WHERE o_totalprice < 100000) AS n1,
             (SELECT count(*) FROM s1 WHERE o_totalprice > 400000) AS n2,
             (SELECT count(*) FROM new) AS n3, (SELECT count(*) FROM m) AS n4,
             (SELECT count(*) FROM s4 WHERE o_totalprice < 0) AS n5, (SELECT count(*) FROM orders) AS n0,
             (SELECT count(*) FROM s4 WHERE NOT o_totalprice < 0) AS n9)
"""
BATCH_SUMMARY_SQL = _BATCH_STEPS_SQL + """
SELECT 1 AS "No", 'UPDATE' AS "Type", n1 AS "RowsAffected" FROM n UNION ALL SELECT 2, 'DELETE', n2 FROM n
UNION ALL SELECT 3, 'INSERT', n3 FROM n UNION ALL SELECT 4, 'MERGE', n4 FROM n UNION ALL SELECT 5, 'DELETE', n5 FROM n"""
BATCH_OUTCOME_SQL = _BATCH_STEPS_SQL + """
SELECT 'strict' AS run, 5::BIGINT AS succeeded, 0::BIGINT AS failed, (n1 + n2 + n3 + n4 + n5)::BIGINT AS rows_affected, n9 AS rows_after FROM n
UNION ALL SELECT 'strict_broken', 2, 1, (n1 + n2)::BIGINT, n0 FROM n
UNION ALL SELECT 'lenient_broken', 5, 1, (n1 + n2 + n3 + n4 + n5)::BIGINT, n9 FROM n"""


def time_travel(spark, folder):
    """Two versions of a table, the second filtered and with one more column; per version its rows and total."""
    layer = Layer(spark, work_folder(spark, "customer-bronze"))
    layer.write(read_folder(spark, folder, "customer"))
    layer.write(quality_filter(layer.read(0), "c_acctbal").withColumn("checked", F.lit(True)), merge_schema=True)
    frames = [
        layer.read(v).groupBy("c_mktsegment").agg(
            F.lit(v).alias("version"), F.count("*").alias("rows"), F.round(F.sum(F.col("c_acctbal").cast("decimal(18,2)")).cast("double"), 2).alias("total")
        )
        for v in (0, 1)
    ]
    return union_all(frames)


def merge_touched_files(spark, folder):
    """Customers in sixteen files; ten rows merged, some updated, some deleted, some added: other files stay as they are."""
    layer = Layer(spark, work_folder(spark, "customer-files"))
    customer = read_folder(spark, folder, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    layer.write(customer.repartitionByRange(16, "c_custkey"))
    changes = read_folder(spark, folder, "supplier").where("s_suppkey < 9").select(F.col("s_suppkey").alias("c_custkey"), F.col("s_name").alias("c_name"), F.col("s_acctbal").alias("c_acctbal"))
    new = changes.where("c_custkey = 3").withColumn("c_custkey", -F.col("c_custkey"))
    done = [
        layer.merge_keys(changes.union(new), ["c_custkey"]),
        layer.update_where({"c_mktsegment": "none", "c_acctbal": F.col("c_acctbal") + 1}, "c_custkey BETWEEN 20 AND 24"),
        layer.delete_where(F.col("c_custkey") == 30),
        layer.append(changes.select((F.col("c_custkey") - 100).alias("c_custkey"), "c_name")),
    ]
    few = all(x.rewritten <= 2 for x in done)
    return layer.read().withColumn("few_files", F.lit(few))


def layer_check(spark, folder):
    """Bronze and Silver are written, Gold is not."""
    root = work_folder(spark, "lake")
    Layer(spark, f"{root}/delta/customer").write(read_folder(spark, folder, "customer"))
    Layer(spark, f"{root}/old/delta/silver/customer").write(quality_filter(read_folder(spark, folder, "customer"), "c_acctbal"))
    layers = {"Bronze": "delta/customer", "Silver": "delta/silver/customer", "Gold": "delta/gold/customer"}
    return layer_health(spark, [root, f"{root}/old"], layers)


# -- CSV ----------------------------------------------------------------------------------------------------------

ORDER_TABLE = T.StructType(
    [
        T.StructField("O_ORDERKEY", T.LongType(), False),
        T.StructField("O_CUSTKEY", T.LongType(), True),
        T.StructField("O_TOTALPRICE", T.DecimalType(12, 2), True),
        T.StructField("O_ORDERDATE", T.TimestampNTZType(), True),
        T.StructField("O_COMMENT", T.StringType(), True),
    ]
)


def _csv_rows(spark, folder):
    """Orders as a CSV file with other column order and case, an extra column and broken values in two groups."""
    path = work_folder(spark, "orders-csv")
    orders = read_folder(spark, folder, "orders")
    orders.select(
        F.when(F.col("o_orderpriority") == "5-LOW", "some day").otherwise(F.date_format("o_orderdate", "dd/MM/yyyy")).alias("o_orderdate"),
        F.col("o_orderkey").alias("O_OrderKey"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(F.lit("USD "), F.col("o_totalprice").cast("decimal(12,2)").cast("string")))
        .otherwise(F.col("o_totalprice").cast("decimal(12,2)").cast("string"))
        .alias("o_totalprice"),
        F.col("o_custkey"),
        F.col("o_orderstatus").alias("not_in_the_table"),
    ).write.option("header", True).csv(path)
    return csv_load.read_text_csv(spark, path)


def csv_load_query(spark, folder):
    load = csv_load.load_csv(_csv_rows(spark, folder), ORDER_TABLE, {"O_COMMENT": F.lit("loaded")})
    return load.accepted.select(
        "O_ORDERKEY",
        "O_CUSTKEY",
        F.col("O_TOTALPRICE").cast("double").alias("O_TOTALPRICE"),
        F.date_format("O_ORDERDATE", "yyyy-MM-dd HH:mm:ss").alias("O_ORDERDATE"),
        "O_COMMENT",
    )


def csv_rejects(spark, folder):
    load = csv_load.load_csv(_csv_rows(spark, folder), ORDER_TABLE)
    return load.rejected.select(F.get_json_object("source_row", "$.O_OrderKey").cast("long").alias("o_orderkey"), "reason")


def csv_counts(spark, folder):
    return csv_load.load_csv(_csv_rows(spark, folder), ORDER_TABLE, unread_dates="null").counts()


DIRTY_TABLE = T.StructType([T.StructField("O_ORDERKEY", T.LongType(), False), T.StructField("O_NOTE", T.StringType(), True), T.StructField("O_TOTALPRICE", T.DoubleType(), True)])
DIRTY_SQL = '''
SELECT CASE o_orderkey % 4 WHEN 0 THEN cast(o_orderkey AS STRING) || ',"two' || chr(10) || 'lines, ""quoted""",1.5'
  WHEN 1 THEN cast(o_orderkey AS STRING) || ',plain,2.5' WHEN 2 THEN cast(o_orderkey AS STRING) || ',too,many,cells'
  ELSE cast(o_orderkey AS STRING) END AS value FROM orders
'''


def _dirty_csv(spark, folder):
    """Files with line breaks inside quotes, and records with too many or too few cells."""
    path = work_folder(spark, "dirty-csv")
    derived(spark, folder, DIRTY_SQL, "orders").write.option("lineSep", "\n").text(path)
    return csv_load.load_csv(csv_load.read_text_csv(spark, path, names=["o_orderkey", "o_note", "o_totalprice"]), DIRTY_TABLE)


NOTE_SQL = """SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'first' || chr(10) || 'and, "second"' || chr(10) || chr(10) || o_orderpriority
 WHEN 1 THEN o_orderpriority || ', "x' ELSE 'plain' END AS o_note, o_totalprice FROM orders"""


def _one_file(spark, folder):
    path = work_folder(spark, "one-csv")
    derived(spark, folder, NOTE_SQL, "orders").coalesce(1).write.csv(path, header=True, escape='"')
    return path


def csv_one_file(spark, folder):
    """All orders in one file with line breaks in cells; many tasks read it."""
    return csv_load.load_csv(csv_load.read_text_csv(spark, _one_file(spark, folder)), DIRTY_TABLE).accepted


def csv_preview(spark, folder):
    """The first ten rows of that file; which they are depends on how the table was written, what they hold does not."""
    head = csv_load.preview_csv(spark, _one_file(spark, folder))
    return head.agg(F.count("*").alias("rows"), F.count_if(F.col("o_orderkey").try_cast("long").isNotNull()).alias("keys"))


def csv_dirty(spark, folder):
    return _dirty_csv(spark, folder).accepted


def csv_dirty_counts(spark, folder):
    """Accepted and rejected records; together they are all records."""
    return _dirty_csv(spark, folder).counts()


def reference_load(spark, folder):
    """Rules without a category column, replacing what was there."""
    rows = read_folder(spark, folder, "benchmark").select(F.col("text").alias("rule"), "item_id")
    return csv_load.rules_table(rows)


def date_cascade(spark, folder):
    """Every order date written in one of five ways and read back."""
    orders = read_folder(spark, folder, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    days = F.datediff(F.col("o_orderdate"), F.lit("1899-12-30").cast("date"))
    text = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.date_format("o_orderdate", "yyyy-M-d"))
        .when(F.col("o_orderpriority") == "2-HIGH", F.date_format("o_orderdate", "dd/MM/yyyy HH:mm:ss"))
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.date_format("o_orderdate", "yyyyMMdd"))
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", days.cast("string"))
        .otherwise(F.date_format("o_orderdate", "yyyy/MM/dd H:mm:ss.SSS"))
    )
    staged = orders.select("o_orderkey", clean_date_text(text).alias("text"))
    return staged.select("o_orderkey", F.date_format(parse_clean_date(F.col("text")), "yyyy-MM-dd HH:mm:ss").alias("parsed"))


# -- browsing and names ---------------------------------------------------------------------------------------------


def browse_filter(spark, folder):
    return browse(read_folder(spark, folder, "supplier"), "s_acctbal > 5000 AND s_nationkey < 10", None)


def browse_capped(spark, folder):
    """Without an order the capped rows are any rows; how many is defined."""
    rows = browse(read_folder(spark, folder, "orders"), "o_totalprice > 1000", DEFAULT_RESULT_CAP)
    return rows.agg(F.count("*").alias("rows"))


def keyword_names(spark, folder):
    return keyword_search(read_folder(spark, folder, "part").select("p_partkey", "p_name"), "p_name", " WIDGET ")


def name_sets(spark, folder):
    """Names of two kinds united, trimmed, each once, in case-insensitive order."""
    names = mutate.union_names(
        read_folder(spark, folder, "part").select(F.concat(F.lit("  "), F.col("p_name")).alias("name")),
        read_folder(spark, folder, "customer").select(F.col("c_name").alias("name")),
        read_folder(spark, folder, "supplier").select(F.lit(" ").alias("name")),
    )
    return distinct_names(names, "name").orderBy(F.upper("name").asc_nulls_last(), "name")


def set_difference(spark, folder):
    orders = read_folder(spark, folder, "orders").select(F.col("o_custkey").alias("key"), F.col("o_orderstatus").alias("status"))
    finished = orders.filter("status = 'F'").select("key")
    return mutate.difference(orders.select("key").distinct(), finished, ["key"])


QUERIES = {
    "merge_upsert": (
        merge_upsert,
        """SELECT coalesce(c.c_custkey, p.p_partkey) AS c_custkey, coalesce(p.p_name, c.c_name) AS c_name,
           coalesce(p.p_retailprice, c.c_acctbal) AS c_acctbal, c.c_mktsegment
           FROM customer c FULL JOIN part p ON c.c_custkey = p.p_partkey""",
    ),
    "update_where": (
        update_where,
        """SELECT o_orderkey, o_orderstatus,
           CASE WHEN o_orderstatus = 'F' AND o_totalprice < 200000 THEN '0-CLOSED' ELSE o_orderpriority END AS o_orderpriority,
           CASE WHEN o_orderstatus = 'F' AND o_totalprice < 200000 THEN 0.0 ELSE o_totalprice END AS o_totalprice FROM orders""",
    ),
    "delete_where": (delete_where, "SELECT o_orderkey, o_totalprice FROM orders WHERE NOT o_totalprice < 50000"),
    "truncate_insert": (
        truncate_insert,
        """SELECT s_suppkey AS c_custkey, s_name AS c_name, s_acctbal AS c_acctbal, NULL::VARCHAR AS c_mktsegment FROM supplier""",
    ),
    "insert_rows": (
        insert_rows,
        """SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer
           UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL FROM supplier""",
    ),
    "remove_by_key": (
        remove_by_key,
        """SELECT p_partkey, p_name FROM part
           WHERE upper(trim(p_name)) NOT IN (SELECT upper(trim(p_name)) FROM part WHERE p_size >= 48)""",
    ),
    "upsert_by_name": (
        upsert_by_name,
        """WITH changed AS (SELECT upper('customer' || substr(s_name, 9, 10)) AS name, s_acctbal AS rows FROM supplier)
           SELECT c_name AS name, c_acctbal AS rows FROM customer WHERE upper(c_name) NOT IN (SELECT upper(name) FROM changed)
           UNION ALL SELECT name, rows FROM changed""",
    ),
    "batch_summary": (batch_summary, BATCH_SUMMARY_SQL),
    "batch_outcome": (batch_outcome, BATCH_OUTCOME_SQL),
    "time_travel": (
        time_travel,
        """SELECT c_mktsegment, 0 AS version, count(*) AS rows, round(sum(c_acctbal::DECIMAL(18,2))::DOUBLE, 2) AS total FROM customer GROUP BY ALL
           UNION ALL SELECT c_mktsegment, 1, count(*), round(sum(c_acctbal::DECIMAL(18,2))::DOUBLE, 2) FROM customer
           WHERE c_acctbal >= 0 GROUP BY ALL""",
    ),
    "merge_touched_files": (
        merge_touched_files,
        """WITH s AS (SELECT s_suppkey AS k, s_name, s_acctbal FROM supplier WHERE s_suppkey < 9), merged AS (
             SELECT c_custkey, coalesce(s_name, c_name) AS c_name, CASE WHEN k IS NULL THEN c_acctbal ELSE s_acctbal END AS c_acctbal, c_mktsegment FROM customer LEFT JOIN s ON c_custkey = k
             UNION ALL SELECT k, s_name, s_acctbal, NULL FROM s WHERE k NOT IN (SELECT c_custkey FROM customer)
             UNION ALL SELECT -k, s_name, s_acctbal, NULL FROM s WHERE k = 3)
           SELECT c_custkey, c_name, CASE WHEN c_custkey BETWEEN 20 AND 24 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal,
             CASE WHEN c_custkey BETWEEN 20 AND 24 THEN 'none' ELSE c_mktsegment END AS c_mktsegment, true AS few_files FROM merged WHERE c_custkey <> 30
           UNION ALL SELECT k - 100, s_name, NULL, NULL, true FROM s""",
    ),
    "layer_check": (
        layer_check,
        """SELECT 'Bronze' AS layer, true AS present, 0::BIGINT AS version, count(*) AS row_count FROM customer
           UNION ALL SELECT 'Silver', true, 0, count(*) FROM customer WHERE c_acctbal >= 0
           UNION ALL SELECT 'Gold', false, NULL, 0""",
    ),
    "csv_load": (
        csv_load_query,
        """SELECT o_orderkey AS "O_ORDERKEY", o_custkey AS "O_CUSTKEY", o_totalprice::DECIMAL(12,2)::DOUBLE AS "O_TOTALPRICE",
           strftime(o_orderdate, '%Y-%m-%d 00:00:00') AS "O_ORDERDATE", 'loaded' AS "O_COMMENT" FROM orders
           WHERE o_orderpriority NOT IN ('5-LOW', '1-URGENT')""",
    ),
    "csv_rejects": (
        csv_rejects,
        """SELECT o_orderkey, CASE o_orderpriority WHEN '5-LOW' THEN 'O_ORDERDATE: unreadable value some day'
           ELSE 'O_TOTALPRICE: unreadable value USD ' || o_totalprice::DECIMAL(12,2)::VARCHAR END AS reason FROM orders
           WHERE o_orderpriority IN ('5-LOW', '1-URGENT')""",
    ),
    "csv_counts": (
        csv_counts,
        """SELECT 'accepted' AS outcome, count(*) FILTER (o_orderpriority <> '1-URGENT') AS rows FROM orders
           UNION ALL SELECT 'rejected', count(*) FILTER (o_orderpriority = '1-URGENT') FROM orders""",
    ),
    "reference_load": (reference_load, """SELECT '共通' AS "CATEGORY", text AS "RULE" FROM benchmark"""),
    "date_cascade": (date_cascade, "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS parsed FROM orders"),
    "csv_dirty": (
        csv_dirty,
        """SELECT o_orderkey AS "O_ORDERKEY", CASE o_orderkey % 4 WHEN 0 THEN 'two' || chr(10) || 'lines, "quoted"' ELSE 'plain' END AS "O_NOTE",
        CASE o_orderkey % 4 WHEN 0 THEN 1.5::DOUBLE ELSE 2.5 END AS "O_TOTALPRICE" FROM orders WHERE o_orderkey % 4 < 2""",
    ),
    "csv_dirty_counts": (
        csv_dirty_counts,
        """SELECT 'accepted' AS outcome, count(*) AS rows FROM orders WHERE o_orderkey % 4 < 2
        UNION ALL SELECT 'rejected', count(*) FROM orders WHERE o_orderkey % 4 >= 2""",
    ),
    "csv_one_file": (
        csv_one_file,
        """SELECT o_orderkey AS "O_ORDERKEY", CASE o_orderkey % 3 WHEN 0 THEN 'first' || chr(10) || 'and, "second"' || chr(10) || chr(10) || o_orderpriority
        WHEN 1 THEN o_orderpriority || ', "x' ELSE 'plain' END AS "O_NOTE", o_totalprice AS "O_TOTALPRICE" FROM orders""",
    ),
    "csv_preview": (csv_preview, "SELECT least(10, count(*)) AS rows, least(10, count(*)) AS keys FROM orders"),
    "browse_filter": (browse_filter, "SELECT * FROM supplier WHERE s_acctbal > 5000 AND s_nationkey < 10"),
    "browse_capped": (browse_capped, "SELECT least(100, count(*)) AS rows FROM orders WHERE o_totalprice > 1000"),
    "keyword_names": (keyword_names, "SELECT p_partkey, p_name FROM part WHERE contains(lower(p_name), 'widget')"),
    "name_sets": (
        name_sets,
        "SELECT trim(p_name) AS name FROM part UNION SELECT c_name FROM customer",
    ),
    "set_difference": (
        set_difference,
        "SELECT o_custkey AS key FROM orders EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'",
    ),
}
