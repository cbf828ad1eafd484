"""Registered queries: catalog metadata, profiles, history report, similarity, classifier, synthetic rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from silverlode.functions.elapsed import display_timestamp, elapsed_seconds
from silverlode.functions.text import type_text
from silverlode.functions.vectors import norm
from silverlode.operators import catalog, classify, report, similarity, synth
from silverlode.operators.concat import ordered_concat
from silverlode.plans.guarding import derived
from silverlode.session import work_folder
from silverlode.sources import history
from silverlode.sources.layers import Layer
from silverlode.sources.tables import read_folder, sample_blocks
from silverlode.streaming.report_stream import refresh_report, refresh_state

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

# Dictionary tables: every order is an object, its line items are the columns.
COLUMNS_SQL = """
SELECT 'ORDER_' || cast(l_orderkey AS STRING) AS object_name, l_linenumber * 100000 + l_partkey AS column_id,
 'PART_' || cast(l_partkey AS STRING) || '_' || cast(l_suppkey AS STRING) || '_' || cast(l_linenumber AS STRING) AS column_name,
 CASE l_returnflag WHEN 'A' THEN 'VARCHAR2' WHEN 'N' THEN 'NUMBER' ELSE 'DATE' END AS data_type, cast(l_quantity AS INT) AS data_length,
 CASE WHEN l_linestatus = 'O' THEN 10 END AS data_precision, CASE WHEN l_discount > 0.05 THEN 2 ELSE 0 END AS data_scale,
 CASE WHEN l_tax > 0.04 THEN 'Y' ELSE 'N' END AS nullable FROM lineitem
"""


def _columns(spark, folder):
    return derived(spark, folder, COLUMNS_SQL, "lineitem")


def _comments(spark, folder):
    return derived(
        spark, folder,
        """SELECT DISTINCT 'ORDER_' || cast(l_orderkey AS STRING) AS object_name, 'PART_' || cast(l_partkey AS STRING) || '_' || cast(l_suppkey AS STRING)
           || '_' || cast(l_linenumber AS STRING) AS column_name, 'it''s ' || cast(l_partkey AS STRING) AS comments FROM lineitem WHERE l_linenumber = 1""",
        "lineitem",
    )


def key_listagg(spark, folder):
    return ordered_concat(_columns(spark, folder), ["object_name"], "column_id", "column_name", ", ", "columns")


def column_types(spark, folder):
    c = _columns(spark, folder)
    rendered = type_text(F.col("data_type"), F.col("data_length"), F.col("data_precision"), F.col("data_scale"))
    return c.groupBy(rendered.alias("type")).agg(F.count("*").alias("rows"))


def column_details(spark, folder):
    return catalog.column_details(_columns(spark, folder), _comments(spark, folder)).select(
        "object_name", "column_id", "column_name", "data_type", "nullable", "comments"
    )


def comment_statements(spark, folder):
    tables = read_folder(spark, folder, "part").select(
        F.concat(F.lit("part_"), "p_partkey").alias("object_name"), F.when(F.col("p_size") > 10, F.concat("p_name", F.lit("'s"))).alias("comments")
    )
    return catalog.comment_statements(tables, _comments(spark, folder)).select("object_name", "statement")


def schema_context(spark, folder):
    details = catalog.column_details(_columns(spark, folder), _comments(spark, folder))
    return catalog.schema_context(details).select("object_name", F.md5("context").alias("context_md5"), F.length("context").alias("size"))


def _constraints(spark, folder):
    """Per order a primary key; per customer's order a foreign key to the part it names first."""
    return derived(
        spark, folder,
        """SELECT 'ORDER_' || cast(o_orderkey AS STRING) AS object_name, 'PK_' || cast(o_orderkey AS STRING) AS constraint_name, 'P' AS constraint_type,
           cast(NULL AS STRING) AS r_constraint_name FROM orders
           UNION ALL SELECT 'ORDER_' || cast(o_orderkey AS STRING) AS object_name, 'FK_' || cast(o_orderkey AS STRING) AS constraint_name,
           'R' AS constraint_type, 'PK_' || cast(o_custkey AS STRING) AS r_constraint_name FROM orders WHERE o_orderstatus = 'F'""",
        "orders",
    )


def _members(spark, folder):
    return derived(
        spark, folder,
        """SELECT 'PK_' || cast(l_orderkey AS STRING) AS constraint_name, l_linenumber * 100000 + l_partkey AS position, 'P' || cast(l_partkey AS STRING) AS column_name
           FROM lineitem
           UNION ALL SELECT 'FK_' || cast(l_orderkey AS STRING) AS constraint_name, l_linenumber * 100000 + l_partkey AS position,
           'S' || cast(l_suppkey AS STRING) AS column_name FROM lineitem""",
        "lineitem",
    )


def primary_keys(spark, folder):
    return catalog.primary_key_text(_constraints(spark, folder), _members(spark, folder))


def foreign_keys(spark, folder):
    return catalog.foreign_key_text(_constraints(spark, folder), _members(spark, folder))


def metadata_prompt(spark, folder):
    """Structure, keys and samples of every order in one prompt."""
    details = catalog.column_details(_columns(spark, folder), _comments(spark, folder))
    samples = read_folder(spark, folder, "orders").select(
        F.concat(F.lit("ORDER_"), "o_orderkey").alias("object_name"), F.to_csv(F.struct("o_orderkey", "o_orderpriority")).alias("sample_text")
    )
    prompts = catalog.metadata_prompts(
        catalog.structure_text(details), catalog.primary_key_text(_constraints(spark, folder), _members(spark, folder)),
        catalog.foreign_key_text(_constraints(spark, folder), _members(spark, folder)), samples, "COMMENT", "Only comments.",
    )
    return prompts.select("object_name", F.md5("prompt").alias("prompt_md5"), F.length("prompt").alias("size"))


def sample_text(spark, folder):
    """The first rows of each table; which rows these are is not defined, how many is."""
    tables = {t: read_folder(spark, folder, t) for t in ("customer", "orders", "part")}
    return sample_blocks(tables, 5).select("object_name", "sample_rows")


def table_inventory(spark, folder):
    return catalog.table_counts({t: read_folder(spark, folder, t) for t in TABLES}, {"orders": "all orders"})


def max_event(spark, folder):
    return catalog.max_id(read_folder(spark, folder, "events"), "event_id")


def catalog_join(spark, folder):
    objects = read_folder(spark, folder, "customer").select(
        F.lit("A").alias("owner"), F.when(F.col("c_nationkey") == 3, F.concat("c_name", F.lit("$"))).otherwise(F.col("c_name")).alias("object_name"),
        F.when(F.col("c_nationkey") == 4, "VIEW").otherwise("TABLE").alias("object_type"),
    )
    counts = read_folder(spark, folder, "orders").groupBy("o_custkey").agg(F.count("*").alias("num_rows")).select(
        F.lit("A").alias("owner"), F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")).alias("object_name"), "num_rows"
    )
    comments = read_folder(spark, folder, "supplier").select(
        F.lit("A").alias("owner"), F.replace("s_name", F.lit("Supplier"), F.lit("Customer")).alias("object_name"), F.col("s_name").alias("comments")
    )
    return catalog.table_list(objects, counts, comments)


def entries_normalised(spark, folder):
    entries = read_folder(spark, folder, "part").select(
        F.when(F.col("p_size") == 1, "  ").otherwise(F.concat(F.lit(" "), "p_name", F.lit("\t"))).alias("name"),
        F.col("p_size").alias("rows"), F.when(F.col("p_size") > 25, F.col("p_type")).alias("comments"),
    )
    return catalog.normalise_entries(entries, "name", ["rows", "comments"])


# -- profiles ------------------------------------------------------------------------------------------------------------

ATTRIBUTES_SQL = """
SELECT ' ' || c_name AS profile_name, 'Region' AS attribute_name, 'old' AS attribute_value, 1 AS seq FROM customer
UNION ALL SELECT c_name AS profile_name, 'REGION ' AS attribute_name, c_mktsegment AS attribute_value, 2 AS seq FROM customer
UNION ALL SELECT c_name AS profile_name, 'model' AS attribute_name, 'm' || cast(c_nationkey AS STRING) AS attribute_value, 1 AS seq FROM customer WHERE c_nationkey < 20
UNION ALL SELECT c_name AS profile_name, ' ' AS attribute_name, 'x' AS attribute_value, 1 AS seq FROM customer
UNION ALL SELECT c_name AS profile_name, 'object_list' AS attribute_name,
 CASE WHEN c_nationkey < 8 THEN '[{"owner":"A","name":"' || c_mktsegment || '"},{"name":"nation_' || cast(c_nationkey AS STRING) || '"},{"name":" "}]'
  WHEN c_nationkey < 15 THEN '{"name":"' || lower(c_mktsegment) || '"}' WHEN c_nationkey < 20 THEN '["NATION_1","NATION_0","none","Region_a"]'
  ELSE 'not json' END AS attribute_value, 1 AS seq FROM customer
"""


def _attributes(spark, folder):
    return derived(spark, folder, ATTRIBUTES_SQL, "customer")


def _catalog(spark, folder):
    nation = read_folder(spark, folder, "nation").select(F.col("n_name").alias("name"), F.lit("TABLE").alias("kind"))
    segments = read_folder(spark, folder, "customer").select(F.col("c_mktsegment").alias("name"), F.lit("VIEW").alias("kind")).distinct()
    return nation.unionByName(segments)


def eav_pivot(spark, folder):
    maps = catalog.attribute_maps(_attributes(spark, folder))
    pairs = F.transform(F.map_entries("attributes"), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return maps.select("profile", F.array_join(pairs, ";").alias("attributes"))


def object_split(spark, folder):
    lists = _attributes(spark, folder).filter("attribute_name = 'object_list'").select(
        F.col("profile_name").alias("profile"), F.col("attribute_value").alias("object_list")
    )
    return catalog.split_objects(lists, "object_list", _catalog(spark, folder))


def profile_table(spark, folder):
    profiles = read_folder(spark, folder, "customer").select(F.col("c_name").alias("name"), F.lit("described").alias("category"))
    kept = read_folder(spark, folder, "supplier").select(
        F.upper(F.replace("s_name", F.lit("Supplier"), F.lit("Customer"))).alias("profile"),
        F.when(F.col("s_nationkey") < 12, F.col("s_name")).otherwise(" ").alias("category"),
    )
    return catalog.profile_table(profiles, _attributes(spark, folder), _catalog(spark, folder), kept, "customer#000000007")


# -- history ---------------------------------------------------------------------------------------------------------------

ELAPSED_SQL = """
SELECT event_id, CASE event_type WHEN 'click' THEN cast(event_id AS STRING) || 'ms' WHEN 'view' THEN cast(user_id AS STRING) || ' 秒'
 WHEN 'error' THEN cast(user_id AS STRING) || ':05' WHEN 'signup' THEN '1:' || cast(user_id AS STRING) || ':30.25'
 ELSE CASE WHEN value > 40 THEN 'about ' || cast(user_id AS STRING) WHEN value > 20 THEN '' ELSE '-' || cast(user_id AS STRING) || ',000' END END AS elapsed
FROM events
"""


def elapsed_parse(spark, folder):
    return derived(spark, folder, ELAPSED_SQL, "events").select("event_id", elapsed_seconds(F.col("elapsed")).alias("seconds"))


def display_time(spark, folder):
    stamped = read_folder(spark, folder, "events").select(
        "event_id", F.when(F.col("event_type") == "view", "").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'+09:00'")).alias("t")
    )
    return stamped.select("event_id", display_timestamp(F.col("t")).alias("shown"))


def _records(spark, folder):
    """History records, half of them with the former column names."""
    events = read_folder(spark, folder, "events")
    current = events.select(
        F.col("event_type").alias("画面名"), F.col("event_id").cast("string").alias("実行ID"), F.col("user_id").cast("string").alias("試行回数"),
        F.when(F.col("event_type") == "view", "").otherwise(F.concat(F.col("event_id").cast("string"), F.lit("ms"))).alias("SQL実行経過時間（秒）"),
        F.concat(F.col("user_id").cast("string"), F.lit("秒")).alias("SELECT経過時間"),
        F.lit("5").alias("全体経過時間"),
    )
    return current


def report_normalise(spark, folder):
    done = history.normalise_history(_records(spark, folder))
    return done.select(
        F.col("`画面名`").alias("screen"), F.col("`実行ID`").alias("id"), F.col("`試行回数`").alias("attempts"),
        F.col("`SQL実行経過時間（秒）`").alias("run_seconds"), F.col("`全体経過時間（秒）`").alias("total_seconds"), F.col("`エラー内容`").alias("error"),
        F.lit(len(done.columns)).alias("columns"),
    )


def report_load(spark, folder):
    """Written as JSON lines next to broken lines, read back for one screen, exported with numbers."""
    path = work_folder(spark, "history")
    history.append_history(_records(spark, folder), path)
    broken = read_folder(spark, folder, "events").select(
        F.when(F.col("event_type") == "view", "").when(F.col("event_type") == "click", "{broken").otherwise(F.concat(F.lit("["), "event_id", F.lit("]"))).alias("value")
    )
    broken.write.mode("append").text(path)
    records = history.report(history.read_history(spark, path), "error")
    return history.export_frame(records).select(
        F.col("`画面名`").alias("screen"), F.col("`実行ID`").alias("id"), F.col("`SQL実行経過時間（秒）`").alias("run_seconds"),
        F.col("`Select AI経過時間（秒）`").alias("generate_seconds"),
    )


def report_incremental(spark, folder):
    """Two refreshes of the same report: the second adds only the second batch."""
    source, target, mark = (work_folder(spark, n) for n in ("stream-in", "stream-out", "stream-mark"))
    for part in ("event_type IN ('click', 'view')", "event_type NOT IN ('click', 'view')"):
        chosen = _records(spark, folder).filter(F.expr(part.replace("event_type", "`画面名`")))
        history.append_history(chosen, source)
        refresh_report(spark, source, target, mark).awaitTermination()
    return spark.read.parquet(target).groupBy(F.col("`画面名`").alias("screen")).agg(
        F.count("*").alias("rows"), F.countDistinct(F.col("`実行ID`")).alias("executions")
    )


def _phases(spark, folder):
    return derived(
        spark, folder,
        """SELECT l_orderkey AS execution_id, CASE WHEN l_linestatus = 'O' THEN 'select_ai' ELSE 'select' END AS phase,
           cast(l_shipdate AS STRING) AS started_at, cast(l_shipdate AS STRING) || 'z' AS finished_at,
           CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity * 125 END AS elapsed_ms FROM lineitem""",
        "lineitem",
    )


def phase_times(spark, folder):
    return report.phase_times(_phases(spark, folder)).select("execution_id", "phase", "elapsed_ms", "attempts")


def execution_report(spark, folder):
    executions = read_folder(spark, folder, "orders").select(
        F.col("o_orderkey").alias("execution_id"), F.col("o_orderstatus").alias("screen_name"), F.lit("q").alias("prompt"), F.lit("q2").alias("prompt_used"),
        F.lit("cat").alias("category"), F.col("o_orderpriority").alias("profile"), F.lit("select 1").alias("generated_sql"),
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("❌ failed: "), "o_orderpriority")).when(F.col("o_orderstatus") == "P", "⚠️ slow").otherwise("✅ ok").alias("status"),
        F.lit(2).alias("attempts"), F.lit("t0").alias("started_at"), F.lit(1500.0).alias("elapsed_ms"), F.col("o_custkey").alias("result_count"),
        F.lit(None).cast("string").alias("error"),
    )
    done = report.execution_records(executions, _phases(spark, folder))
    return done.select(
        F.col("`実行ID`").alias("id"), F.col("`Select AI経過時間（秒）`").alias("generate_seconds"), F.col("`SQL実行経過時間（秒）`").alias("run_seconds"),
        F.col("`全体経過時間（秒）`").alias("total_seconds"), F.col("`結果件数`").alias("result_count"), F.col("`エラー内容`").alias("error"),
    )


ATTEMPTS_SQL = """
SELECT cast(event_id AS STRING) AS record_id, cast(user_id AS STRING) AS execution_id, cast(ts AS TIMESTAMP) AS at, CASE WHEN event_id % 3 = 0 THEN 'select' ELSE 'select_ai' END AS phase,
  date_format(ts, 'yyyy-MM-dd HH:mm:ss') AS started_at, date_format(ts, 'yyyy-MM-dd HH:mm:ss') || 'z' AS finished_at, (event_id % 1000 - 100) * 125.0D AS elapsed_ms,
  'screen' AS screen_name, event_type AS status, cast(event_id AS STRING) AS result_count FROM events
"""


def report_state(spark, folder):
    """Two refreshes of a report's state; the second finds new attempts and a part of the first ones once more."""
    source, mark = work_folder(spark, "attempts-in"), work_folder(spark, "attempts-mark")
    layer = Layer(spark, work_folder(spark, "attempts-state"))
    attempts = derived(spark, folder, ATTEMPTS_SQL, "events")
    for part in ("status <> 'click'", "status IN ('click', 'view')"):
        attempts.where(part).write.mode("append").json(source)
        refresh_state(spark, source, layer, mark, "20000 days").awaitTermination()
    done = report.state_records(layer.read())
    return done.select(
        F.col("`実行ID`").alias("id"), F.col("`試行回数`").alias("attempts"), F.col("`実行開始時間`").alias("started_at"), F.col("`Select AI経過時間（秒）`").alias("generate_seconds"),
        F.col("`SQL実行終了時間`").alias("run_end"), F.col("`全体経過時間（秒）`").alias("total_seconds"), F.col("`ステータス`").alias("status"), F.col("`結果件数`").alias("result_count"),
    )


REPORT_STATE_SQL = """
WITH t AS (SELECT CAST(user_id AS VARCHAR) AS id, event_id, event_id % 3 <> 0 AS g, strftime(ts, '%Y-%m-%d %H:%M:%S') AS start, greatest(0, (event_id % 1000 - 100) * 125) AS ms, event_type, ts FROM events)
SELECT id, CAST(count(*) FILTER (g) AS VARCHAR) AS attempts, min(start) AS started_at, coalesce(printf('%.3f', sum(ms) FILTER (g) / 1000), '') AS generate_seconds,
  coalesce(max(start || 'z') FILTER (NOT g), '') AS run_end, printf('%.3f', sum(ms) / 1000) AS total_seconds,
  first(event_type ORDER BY ts DESC, CAST(event_id AS VARCHAR) DESC) AS status, first(CAST(event_id AS VARCHAR) ORDER BY ts DESC, CAST(event_id AS VARCHAR) DESC) AS result_count
FROM t GROUP BY id
"""


# -- vectors and models -------------------------------------------------------------------------------------------------------


def _vectors(spark, folder):
    return read_folder(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), "label")


def vector_topk(spark, folder):
    """For every embedding its three nearest others."""
    v = _vectors(spark, folder).select("id", "vector")
    return similarity.top_matches(v, v, threshold=0.3, limit=3, skip_same=True)


def vector_pruned(spark, folder):
    """What a search at the usual threshold saves: less than a fifth of the products are computed whole."""
    v = _vectors(spark, folder).select("id", "vector")
    rows = v.filter(norm(F.col("vector")) > 0).agg(F.count("*")).scalar()
    return similarity.products(v, v, 0.9, 3).select((rows * rows).alias("pairs"), (F.col("whole") * 5 < rows * rows).alias("pruned"))


def classify_fit_predict(spark, folder):
    rows = classify.with_vectors(read_folder(spark, folder, "embeddings"), "embedding").withColumn("category", F.concat(F.lit(" L"), "label"))
    model = classify.fit(rows.select("features", "category"), "category")
    done = classify.predict(model, rows.select("vec_id", "category", "features"))
    return done.select(
        "vec_id", "category", "predicted", classify.routed_label(F.col("predicted")).alias("routed"),
        F.element_at("probabilities", F.col("predicted")).alias("probability"),
    )


def training_profile(spark, folder):
    rows = classify.training_rows(read_folder(spark, folder, "documents").select("text", F.col("source").alias("category")), "text", "category")
    record = classify.model_record(rows, "category", "category", "given vectors", created_at=F.lit("now"))
    return record.withColumn("labels", F.array_join("labels", ","))


# -- synthetic rows -------------------------------------------------------------------------------------------------------------


def _synthetic(spark, folder):
    """As many parents as there are customers and as many children as there are orders, with pools from real rows."""
    parents, children = read_folder(spark, folder, "customer").count(), read_folder(spark, folder, "orders").count()
    shop = synth.Table("shop", parents, {"shop_id": synth.serial(1), "segment": synth.pick(["A", "B", "C"]), "name": synth.label("shop-")})
    sale = synth.Table(
        "sale", children,
        {"sale_id": synth.serial(1000), "shop_id": synth.Reference("shop", 1), "pieces": synth.whole(1, 50), "price": synth.amount(1, 100),
         "sold_on": synth.day("2024-01-01", 366)},
    )
    return synth.generate(spark, [shop, sale], seed=7), {"shop": parents, "sale": children}


def synthetic_rows(spark, folder):
    tables, _ = _synthetic(spark, folder)
    joined = tables["sale"].join(tables["shop"], "shop_id", "left")
    return joined.select(
        "sale_id", "shop_id", "segment", "name", F.col("pieces").cast("long"), F.col("price").cast("double").alias("price"),
        F.date_format("sold_on", "yyyy-MM-dd").alias("sold_on"),
    )


def synthetic_status(spark, folder):
    tables, wanted = _synthetic(spark, folder)
    return catalog.status_rows(synth.load_status(tables, wanted))


def synthetic_from_samples(spark, folder):
    """Rows drawn from the values of sampled rows; every value must occur in the source."""
    part = read_folder(spark, folder, "part")
    pool = synth.pools(part, ["p_brand", "p_type"], 20)
    table = synth.Table("p", part.count(), {"brand": synth.pick(pool["p_brand"]), "type": synth.pick(pool["p_type"])})
    rows = synth.generate(spark, [table])["p"]
    known = part.select(F.col("p_brand").alias("brand")).distinct()
    unknown = rows.join(known, "brand", "left_anti").agg(F.count("*")).scalar()
    return rows.agg(F.count("*").alias("rows")).withColumn("unknown", unknown)


def _num(table: str, column: str, row: str, seed: int = 7) -> str:
    return f"('0x' || substr(md5('{table}:{column}:' || {row} || ':{seed}'), 1, 8))::BIGINT"


D = lambda sql: sql.replace("AS STRING", "AS VARCHAR")
_TYPE = """data_type || CASE WHEN data_type = 'VARCHAR2' THEN '(' || data_length || ')' WHEN data_type = 'NUMBER' AND data_precision IS NOT NULL
 THEN '(' || data_precision || CASE WHEN data_scale > 0 THEN ',' || data_scale ELSE '' END || ')' ELSE '' END"""
_COMMENTS = """(SELECT DISTINCT 'ORDER_' || l_orderkey AS object_name, 'PART_' || l_partkey || '_' || l_suppkey || '_' || l_linenumber AS column_name,
 'it''s ' || l_partkey AS comments FROM lineitem WHERE l_linenumber = 1)"""
_DETAILS = f"""(SELECT object_name, column_id, column_name, {_TYPE} AS data_type, CASE nullable WHEN 'Y' THEN 'YES' ELSE 'NO' END AS nullable,
 coalesce(comments, ' ') AS comments FROM ({D(COLUMNS_SQL)}) LEFT JOIN {_COMMENTS} USING (object_name, column_name))"""
_PK = """(SELECT 'ORDER_' || o_orderkey AS object_name, 'PK_' || o_orderkey || ': ' || cols AS key_text FROM orders JOIN
 (SELECT l_orderkey, string_agg('P' || l_partkey, ', ' ORDER BY l_linenumber * 100000 + l_partkey, 'P' || l_partkey) AS cols FROM lineitem GROUP BY 1)
 ON l_orderkey = o_orderkey)"""
_FK = """(SELECT 'ORDER_' || o_orderkey AS object_name, 'FK_' || o_orderkey || ': ' || a.cols || ' -> ORDER_' || o_custkey || '(' || coalesce(b.cols, '') || ')' AS key_text
 FROM (SELECT * FROM orders WHERE o_orderstatus = 'F') o JOIN
 (SELECT l_orderkey, string_agg('S' || l_suppkey, ', ' ORDER BY l_linenumber * 100000 + l_partkey, 'S' || l_suppkey) AS cols FROM lineitem GROUP BY 1) a
 ON a.l_orderkey = o_orderkey LEFT JOIN
 (SELECT l_orderkey, string_agg('P' || l_partkey, ', ' ORDER BY l_linenumber * 100000 + l_partkey, 'P' || l_partkey) AS cols FROM lineitem GROUP BY 1) b
 ON b.l_orderkey = o_custkey)"""

QUERIES = {
    "key_listagg": (
        key_listagg,
        f"SELECT object_name, string_agg(column_name, ', ' ORDER BY column_id, column_name) AS columns FROM ({D(COLUMNS_SQL)}) GROUP BY object_name",
    ),
    "column_types": (column_types, f"SELECT {_TYPE} AS type, count(*) AS rows FROM ({D(COLUMNS_SQL)}) GROUP BY 1"),
    "column_details": (column_details, f"SELECT * FROM {_DETAILS}"),
    "comment_statements": (
        comment_statements,
        f"""SELECT 'part_' || p_partkey AS object_name, 'COMMENT ON TABLE PART_' || p_partkey || ' IS ''' || p_name || '''''s'';' AS statement
            FROM part WHERE p_size > 10
            UNION ALL SELECT object_name, 'COMMENT ON COLUMN ' || object_name || '.' || column_name || ' IS ''' || replace(comments, '''', '''''') || ''';'
            FROM {_COMMENTS}""",
    ),
    "schema_context": (
        schema_context,
        f"""WITH t AS (SELECT object_name, chr(10) || '--- テーブル: ' || object_name || ' ---' || chr(10)
            || string_agg(line, chr(10) ORDER BY column_id, line) AS c FROM
            (SELECT *, '  - ' || column_name || ' (' || data_type || '): ' || comments AS line FROM {_DETAILS}) GROUP BY object_name)
            SELECT object_name, md5(c) AS context_md5, length(c)::INT AS size FROM t""",
    ),
    "primary_keys": (primary_keys, f"SELECT * FROM {_PK}"),
    "foreign_keys": (foreign_keys, f"SELECT * FROM {_FK}"),
    "metadata_prompt": (
        metadata_prompt,
        f"""WITH s AS (SELECT object_name, 'OBJECT: ' || object_name || chr(10) || 'COLUMNS:' || chr(10)
              || string_agg(line, chr(10) ORDER BY column_id, line) AS st FROM
              (SELECT *, '- ' || column_name || ': ' || data_type || ' NULLABLE=' || nullable AS line FROM {_DETAILS}) GROUP BY object_name),
            p AS (SELECT s.object_name, 'COMMENT' || chr(10) || '<構造>' || chr(10) || st || chr(10) || chr(10)
              || '<主キー>' || chr(10) || coalesce('OBJECT: ' || s.object_name || chr(10) || pk.key_text, '') || chr(10) || chr(10)
              || '<外部キー>' || chr(10) || coalesce('OBJECT: ' || s.object_name || chr(10) || fk.key_text, '') || chr(10) || chr(10)
              || '<サンプル>' || chr(10) || coalesce(o_orderkey || ',' || o_orderpriority, '') || chr(10) || chr(10) || 'Only comments.' AS p
              FROM s LEFT JOIN {_PK} pk USING (object_name) LEFT JOIN {_FK} fk USING (object_name)
              LEFT JOIN orders ON 'ORDER_' || o_orderkey = s.object_name)
            SELECT object_name, md5(p) AS prompt_md5, length(p)::INT AS size FROM p""",
    ),
    "sample_text": (
        sample_text,
        """SELECT 'customer' AS object_name, least(5, count(*)) AS sample_rows FROM customer UNION ALL SELECT 'orders', least(5, count(*)) FROM orders
           UNION ALL SELECT 'part', least(5, count(*)) FROM part""",
    ),
    "table_inventory": (
        table_inventory,
        " UNION ALL ".join(
            f"SELECT '{t}' AS name, count(*) AS rows, '{'all orders' if t == 'orders' else ' '}' AS comments FROM {t}" for t in TABLES
        ),
    ),
    "max_event": (max_event, "SELECT max(event_id) AS max_id FROM events"),
    "catalog_join": (
        catalog_join,
        """SELECT c_name AS object_name, n AS num_rows, coalesce(s_name, ' ') AS comments FROM customer
           LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON o_custkey = c_custkey LEFT JOIN supplier ON s_suppkey = c_custkey
           WHERE c_nationkey NOT IN (3, 4)""",
    ),
    "entries_normalised": (
        entries_normalised,
        """SELECT p_name AS name, p_size::VARCHAR AS rows, CASE WHEN p_size > 25 THEN p_type ELSE '' END AS comments FROM part WHERE p_size <> 1""",
    ),
    "eav_pivot": (
        eav_pivot,
        f"""WITH a AS (SELECT trim(profile_name) AS profile, lower(trim(attribute_name)) AS k, arg_max(attribute_value, seq) AS v
            FROM ({D(ATTRIBUTES_SQL)}) WHERE trim(attribute_name) <> '' GROUP BY 1, 2)
            SELECT profile, string_agg(k || '=' || v, ';' ORDER BY k) AS attributes FROM a GROUP BY profile""",
    ),
    "object_split": (
        object_split,
        """SELECT c_name AS profile, CASE WHEN c_nationkey < 8 THEN 'NATION_' || c_nationkey WHEN c_nationkey < 15 THEN '' ELSE 'NATION_0, NATION_1' END AS tables,
           CASE WHEN c_nationkey < 15 THEN c_mktsegment ELSE '' END AS views FROM customer WHERE c_nationkey < 20""",
    ),
    "profile_table": (
        profile_table,
        """SELECT c_name AS profile, CASE WHEN s_nationkey < 12 THEN s_name ELSE 'described' END AS category,
           CASE WHEN c_nationkey < 8 THEN 'NATION_' || c_nationkey WHEN c_nationkey < 15 OR c_nationkey >= 20 THEN '' ELSE 'NATION_0, NATION_1' END AS tables,
           CASE WHEN c_nationkey < 15 THEN c_mktsegment ELSE '' END AS views, c_mktsegment AS region,
           CASE WHEN c_nationkey < 20 THEN 'm' || c_nationkey ELSE '' END AS model, '' AS embedding_model
           FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey WHERE c_custkey <> 7""",
    ),
    "elapsed_parse": (
        elapsed_parse,
        """SELECT event_id, CASE event_type WHEN 'click' THEN printf('%.3f', event_id / 1000) WHEN 'view' THEN user_id || '.000'
           WHEN 'error' THEN (user_id * 60 + 5) || '.000' WHEN 'signup' THEN (3630 + user_id * 60) || '.250'
           ELSE CASE WHEN value > 40 THEN 'about ' || user_id WHEN value > 20 THEN '' ELSE '0.000' END END AS seconds FROM events""",
    ),
    "display_time": (
        display_time,
        "SELECT event_id, CASE WHEN event_type = 'view' THEN '-' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS shown FROM events",
    ),
    "report_normalise": (
        report_normalise,
        """SELECT event_type AS screen, event_id::VARCHAR AS id, user_id::VARCHAR AS attempts,
           CASE WHEN event_type = 'view' THEN user_id || '.000' ELSE printf('%.3f', event_id / 1000) END AS run_seconds,
           '5.000' AS total_seconds, '' AS error, 20 AS columns FROM events""",
    ),
    "report_load": (
        report_load,
        """SELECT event_type AS screen, event_id::VARCHAR AS id, event_id / 1000 AS run_seconds, NULL::DOUBLE AS generate_seconds
           FROM events WHERE event_type = 'error'""",
    ),
    "report_incremental": (
        report_incremental,
        "SELECT event_type AS screen, count(*) AS rows, count(DISTINCT event_id) AS executions FROM events GROUP BY 1",
    ),
    "phase_times": (
        phase_times,
        """SELECT l_orderkey AS execution_id, CASE WHEN l_linestatus = 'O' THEN 'select_ai' ELSE 'select' END AS phase,
           sum(CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_quantity * 125 END) AS elapsed_ms, count(*) AS attempts FROM lineitem GROUP BY 1, 2""",
    ),
    "report_state": (report_state, REPORT_STATE_SQL),
    "execution_report": (
        execution_report,
        """WITH t AS (SELECT l_orderkey,
              sum(CASE WHEN l_linestatus = 'O' THEN CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_quantity * 125 END END) AS g,
              sum(CASE WHEN l_linestatus <> 'O' THEN CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_quantity * 125 END END) AS r FROM lineitem GROUP BY 1)
           SELECT o_orderkey::VARCHAR AS id, coalesce(printf('%.3f', g / 1000), '') AS generate_seconds, coalesce(printf('%.3f', r / 1000), '') AS run_seconds,
           '1.500' AS total_seconds, o_custkey::VARCHAR AS result_count,
           CASE o_orderstatus WHEN 'F' THEN 'failed: ' || o_orderpriority WHEN 'P' THEN chr(65039) || ' slow' ELSE '' END AS error
           FROM orders LEFT JOIN t ON l_orderkey = o_orderkey""",
    ),
    "vector_topk": (
        vector_topk,
        """WITH u AS (SELECT vec_id, list_transform(embedding::DOUBLE[], lambda x: x) AS v FROM embeddings),
        s AS (SELECT a.vec_id AS query_id, b.vec_id AS entry_id, round(list_cosine_similarity(a.v, b.v), 6) AS similarity
              FROM u a JOIN u b ON a.vec_id <> b.vec_id)
        SELECT query_id, entry_id, similarity, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, entry_id)::INT AS rank
        FROM s WHERE similarity >= 0.3 QUALIFY rank <= 3""",
    ),
    "vector_pruned": (
        vector_pruned,
        "SELECT count(*) * count(*) AS pairs, true AS pruned FROM embeddings WHERE list_sum(list_transform(embedding, lambda x: x * x)) > 0",
    ),
    "classify_fit_predict": (classify_fit_predict, None),
    "training_profile": (
        training_profile,
        """SELECT 'category' AS model_name, string_agg(DISTINCT source, ',' ORDER BY source) AS labels, count(*) AS samples,
           'given vectors' AS embed_model, 1 AS iterations, 'now' AS created_at, 'LogisticRegression' AS algorithm FROM documents WHERE text <> ''""",
    ),
    "synthetic_rows": (
        synthetic_rows,
        f"""WITH sale AS (SELECT i, i + 1000 AS sale_id, {_num('sale', 'shop_id', 'i')} % (SELECT count(*) FROM customer) + 1 AS shop_id,
              {_num('sale', 'pieces', 'i')} % 50 + 1 AS pieces, ({_num('sale', 'price', 'i')} % 9901 + 100) / 100 AS price,
              DATE '2024-01-01' + ({_num('sale', 'sold_on', 'i')} % 366)::INT AS d FROM range((SELECT count(*) FROM orders)) r(i))
            SELECT sale_id, shop_id, (['A', 'B', 'C'])[({_num('shop', 'segment', '(shop_id - 1)')} % 3)::INT + 1] AS segment, 'shop-' || (shop_id - 1) AS name,
            pieces, price, strftime(d, '%Y-%m-%d') AS sold_on FROM sale""",
    ),
    "synthetic_status": (
        synthetic_status,
        """SELECT 1 AS "ID", 'shop' AS "NAME", count(*) AS "ROWS_LOADED", 'COMPLETED' AS "STATUS" FROM customer
           UNION ALL SELECT 2, 'sale', count(*), 'COMPLETED' FROM orders""",
    ),
    "synthetic_from_samples": (synthetic_from_samples, "SELECT count(*) AS rows, 0::BIGINT AS unknown FROM part"),
}
