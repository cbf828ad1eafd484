"""The fifteen SELECT lessons as DataFrame functions.

Each takes its tables and column names, so the same function serves the lesson tables and any others. Null order is
spelled out, and every sort ends with a unique key, so that a range-partitioned sort can split a hot value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverlode.functions.dates import year_range
from silverlode.operators.enrich import exact_average
from silverlode.operators.skew import join_per_key, match_keys
from silverlode.sources.tables import read_folder


def asc(name: str) -> Column:
    return F.col(name).asc_nulls_last()


def desc(name: str) -> Column:
    return F.col(name).desc_nulls_first()


def top_rows(df: DataFrame, key: str, columns: list[str], n: int = 10) -> DataFrame:
    """A top-k heap per task, no full sort."""
    return df.select(*columns).orderBy(asc(key)).limit(n)


def at_least(df: DataFrame, column: str, low: float, columns: list[str], key: str) -> DataFrame:
    """L02"""
    return df.filter(F.col(column) >= low).select(*columns).orderBy(desc(column), asc(key))


def name_contains(df: DataFrame, column: str, word: str, columns: list[str]) -> DataFrame:
    """``upper(c) LIKE upper('%word%')``."""
    return df.filter(F.upper(column).like(f"%{word.upper()}%")).select(*columns)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """L04"""
    return df.select(column).distinct().orderBy(asc(column))


def in_year(df: DataFrame, date: str, year: int, columns: list[str], key: str) -> DataFrame:
    """The year is an argument, not the clock."""
    return df.filter(year_range(F.col(date), year)).select(*columns).orderBy(asc(date), asc(key))


def banded(df: DataFrame, column: str, high: float, middle: float, band: str, columns: list[str], key: str) -> DataFrame:
    """S from ``high``, M from ``middle``, else L."""
    label = F.when(F.col(column) >= high, "S").when(F.col(column) >= middle, "M").otherwise("L")
    return df.select(*columns, label.alias(band)).orderBy(desc(column), asc(key))


def join_parent(child: DataFrame, parent: DataFrame, on: Column, columns: list[str], order: list[str]) -> DataFrame:
    """L07"""
    return child.join(parent, on).select(*columns).orderBy(*[asc(c) for c in order])


def _child_keys(parent: DataFrame, parent_key: str, child: DataFrame, child_key: str) -> tuple[DataFrame, Column]:
    """Each key of the children once (partial distinct first: a hot key is a row per task), and the join on it."""
    keys = child.select(F.col(child_key).alias("child__")).distinct()
    return keys, match_keys(parent, keys, [(parent_key, "child__")])


def without_children(parent: DataFrame, child: DataFrame, parent_key: str, child_key: str, columns: list[str], order: list[str]) -> DataFrame:
    """The outer join with a NULL test, written as the anti-join it is."""
    return parent.join(*_child_keys(parent, parent_key, child, child_key), "left_anti").select(*columns).orderBy(*[asc(c) for c in order])


def count_and_sum(child: DataFrame, parent: DataFrame, on: Column, group: list[str], measure: str) -> DataFrame:
    """Grouped after the join, with map-side partial sums."""
    return (
        child.join(parent, on)
        .groupBy(*group)
        .agg(F.count("*").alias("row_count"), F.sum(F.col(measure).cast("decimal(18,2)")).alias("total"))
        .orderBy(desc("row_count"), *[asc(g) for g in group])
    )


def average_at_least(df: DataFrame, group: str, measure: str, low: float) -> DataFrame:
    """HAVING."""
    averages = df.groupBy(group).agg(exact_average(measure).alias("average"))
    return averages.filter(F.col("average") >= low).orderBy(desc("average"), asc(group))


def above_overall_average(df: DataFrame, measure: str, columns: list[str], key: str) -> DataFrame:
    """One number from a scalar subquery; no join."""
    overall = df.agg(exact_average(measure, 10)).scalar()
    return df.filter(F.col(measure) > overall).select(*columns).orderBy(desc(measure), asc(key))


def above_group_average(df: DataFrame, group: str, measure: str, columns: list[str], key: str) -> DataFrame:
    """What Catalyst makes of the correlated subquery: an aggregate joined on the correlation key."""
    averages = df.groupBy(F.col(group).alias("group__")).agg(exact_average(measure, 10).alias("average__"))
    joined = join_per_key(df, averages, group, "group__", "inner")
    return joined.filter(F.col(measure) > F.col("average__")).select(*columns).orderBy(desc(measure), asc(key))


def with_children(parent: DataFrame, child: DataFrame, parent_key: str, child_key: str, columns: list[str], order: list[str]) -> DataFrame:
    """EXISTS."""
    return parent.join(*_child_keys(parent, parent_key, child, child_key), "left_semi").select(*columns).orderBy(*[asc(c) for c in order])


def with_parent_and_average(
    child: DataFrame, parent: DataFrame, on: Column, group: str, measure: str, columns: list[str], order: list[Column]
) -> DataFrame:
    """A grouped CTE, an inner join and a left join."""
    averages = child.groupBy(F.col(group).alias("group__")).agg(exact_average(measure).alias("average"))
    joined = join_per_key(child, averages, group, "group__", "left").join(parent, on)
    return joined.select(*columns, "average").orderBy(*order)


def customer_nation_view(spark, folder: str, name: str = "v_customer_nation") -> str:
    """A view that stores the join."""
    customer, nation = read_folder(spark, folder, "customer"), read_folder(spark, folder, "nation")
    customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", "c_name", "c_acctbal", "n_name"
    ).createOrReplaceTempView(name)
    return name


# -- the same lessons over the driver tables ----------------------------------------------------------------------


def l01_topn(spark, folder):
    return top_rows(read_folder(spark, folder, "customer"), "c_custkey", ["c_custkey", "c_name", "c_acctbal"])


def l02_where(spark, folder):
    return at_least(read_folder(spark, folder, "orders"), "o_totalprice", 400000, ["o_orderkey", "o_totalprice"], "o_orderkey")


def l03_like(spark, folder):
    return name_contains(read_folder(spark, folder, "part"), "p_name", "Ring", ["p_partkey", "p_name"])


def l04_distinct(spark, folder):
    return distinct_values(read_folder(spark, folder, "customer"), "c_mktsegment")


def l05_year(spark, folder):
    rows = in_year(read_folder(spark, folder, "orders"), "o_orderdate", 1998, ["o_orderkey", "o_orderdate", "o_totalprice"], "o_orderkey")
    return rows.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


def l06_case(spark, folder):
    return banded(read_folder(spark, folder, "customer"), "c_acctbal", 6000, 3000, "band", ["c_custkey", "c_acctbal"], "c_custkey")


def l07_join(spark, folder):
    customer, nation = read_folder(spark, folder, "customer"), read_folder(spark, folder, "nation")
    on = F.col("c_nationkey") == F.col("n_nationkey")
    columns = ["c_name", "n_name", "c_acctbal", "n_nationkey", "c_custkey"]
    return join_parent(customer, nation, on, columns, ["n_nationkey", "c_custkey"])


def l08_anti(spark, folder):
    orders, lineitem = read_folder(spark, folder, "orders"), read_folder(spark, folder, "lineitem")
    return without_children(orders, lineitem, "o_orderkey", "l_orderkey", ["o_orderkey", "o_totalprice"], ["o_orderkey"])


def l09_count_sum(spark, folder):
    orders, customer = read_folder(spark, folder, "orders"), read_folder(spark, folder, "customer")
    on = F.col("o_custkey") == F.col("c_custkey")
    return count_and_sum(orders, customer, on, ["c_mktsegment"], "o_totalprice").withColumn("total", F.round(F.col("total").cast("double"), 2))


def l10_having(spark, folder):
    return average_at_least(read_folder(spark, folder, "part"), "p_brand", "p_size", 25)


def l11_view(spark, folder):
    name = customer_nation_view(spark, folder)
    return spark.table(name).select("c_name", "n_name", "c_acctbal").orderBy(asc("n_name"), asc("c_name"))


def l12_scalar(spark, folder):
    return above_overall_average(read_folder(spark, folder, "orders"), "o_totalprice", ["o_orderkey", "o_totalprice"], "o_orderkey")


def l13_correlated(spark, folder):
    orders = read_folder(spark, folder, "orders")
    return above_group_average(orders, "o_custkey", "o_totalprice", ["o_orderkey", "o_custkey", "o_totalprice"], "o_orderkey")


def l14_exists(spark, folder):
    orders, lineitem = read_folder(spark, folder, "orders"), read_folder(spark, folder, "lineitem")
    return with_children(orders, lineitem, "o_orderkey", "l_orderkey", ["o_orderkey", "o_totalprice"], ["o_orderkey"])


def l15_cte(spark, folder):
    supplier, nation = read_folder(spark, folder, "supplier"), read_folder(spark, folder, "nation")
    on = F.col("s_nationkey") == F.col("n_nationkey")
    return with_parent_and_average(
        supplier, nation, on, "s_nationkey", "s_acctbal", ["s_name", "n_name", "s_acctbal"],
        [asc("n_name"), desc("s_acctbal"), asc("s_suppkey")],
    )


def doc_without_label(spark, folder):
    documents, labels = read_folder(spark, folder, "documents"), read_folder(spark, folder, "labels").withColumnRenamed("doc_id", "l_doc_id")
    return without_children(documents, labels, "doc_id", "l_doc_id", ["doc_id", "lang", "source"], ["doc_id"])


def _avg(column: str, scale: int) -> str:
    return f"round(sum({column}::DECIMAL(28,10))::DOUBLE / count({column}), {scale})"


QUERIES: dict[str, tuple[Callable, str | None]] = {
    "l01_topn": (l01_topn, "SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_custkey LIMIT 10"),
    "l02_where": (l02_where, "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice >= 400000"),
    "l03_like": (l03_like, "SELECT p_partkey, p_name FROM part WHERE upper(p_name) LIKE upper('%ring%')"),
    "l04_distinct": (l04_distinct, "SELECT DISTINCT c_mktsegment FROM customer"),
    "l05_year": (
        l05_year,
        """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_totalprice FROM orders
           WHERE extract(year FROM o_orderdate) = 1998""",
    ),
    "l06_case": (
        l06_case,
        """SELECT c_custkey, c_acctbal, CASE WHEN c_acctbal >= 6000 THEN 'S' WHEN c_acctbal >= 3000 THEN 'M' ELSE 'L' END
           AS band FROM customer""",
    ),
    "l07_join": (
        l07_join,
        """SELECT c_name, n_name, c_acctbal, n_nationkey, c_custkey FROM customer
           JOIN nation ON c_nationkey = n_nationkey""",
    ),
    "l08_anti": (
        l08_anti,
        """SELECT o_orderkey, o_totalprice FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
           WHERE l_orderkey IS NULL""",
    ),
    "l09_count_sum": (
        l09_count_sum,
        """SELECT c_mktsegment, count(*) AS row_count, round(sum(o_totalprice::DECIMAL(18,2))::DOUBLE, 2) AS total
           FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment""",
    ),
    "l10_having": (
        l10_having,
        f"""SELECT p_brand, {_avg('p_size', 4)} AS average FROM part GROUP BY p_brand
            HAVING {_avg('p_size', 4)} >= 25""",
    ),
    "l11_view": (
        l11_view,
        "SELECT c_name, n_name, c_acctbal FROM customer JOIN nation ON c_nationkey = n_nationkey",
    ),
    "l12_scalar": (
        l12_scalar,
        f"""SELECT o_orderkey, o_totalprice FROM orders
            WHERE o_totalprice > (SELECT {_avg('o_totalprice', 10)} FROM orders)""",
    ),
    "l13_correlated": (
        l13_correlated,
        f"""SELECT o.o_orderkey, o.o_custkey, o.o_totalprice FROM orders o WHERE o.o_totalprice >
            (SELECT {_avg('i.o_totalprice', 10)} FROM orders i WHERE i.o_custkey = o.o_custkey)""",
    ),
    "l14_exists": (
        l14_exists,
        """SELECT o_orderkey, o_totalprice FROM orders
           WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""",
    ),
    "l15_cte": (
        l15_cte,
        f"""WITH a AS (SELECT s_nationkey, {_avg('s_acctbal', 4)} AS average FROM supplier GROUP BY s_nationkey)
            SELECT s.s_name, n.n_name, s.s_acctbal, a.average FROM supplier s
            JOIN nation n ON s.s_nationkey = n.n_nationkey LEFT JOIN a ON a.s_nationkey = n.n_nationkey""",
    ),
    "doc_without_label": (
        doc_without_label,
        "SELECT doc_id, lang, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    ),
}
