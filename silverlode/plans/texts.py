"""Registered queries: text cells, model answers, query logs, payloads, glossary, prompts, lookups, feedback."""

from __future__ import annotations

from pyspark.sql import functions as F

from silverlode.functions import text as tx
from silverlode.functions.vectors import parse_embedding
from silverlode.operators import chat, feedback, glossary, lookup
from silverlode.operators.scoring import retry
from silverlode.operators.staging import compute_once
from silverlode.plans.guarding import derived
from silverlode.sources.tables import read_folder

# -- cells ------------------------------------------------------------------------------------------------------------


def text_preview(spark, folder):
    return read_folder(spark, folder, "documents").select("doc_id", tx.preview(F.col("text")).alias("preview"))


def value_normalise(spark, folder):
    documents = read_folder(spark, folder, "documents").select(F.lit("d").alias("kind"), F.col("doc_id").alias("id"), "text")
    events = read_folder(spark, folder, "events").select(F.lit("e").alias("kind"), F.col("event_id").alias("id"), F.col("props").alias("text"))
    cells = documents.unionByName(events)
    return cells.select("kind", "id", tx.normalise_value(F.concat(F.lit(" \t"), "text", F.lit("\\n"))).alias("value")).unionByName(
        events.select(F.lit("j").alias("kind"), "id", tx.normalise_value(F.concat(F.lit(" "), "text", F.lit("\n"))).alias("value"))
    )


def byte_cells(spark, folder):
    """Texts as UTF-8 bytes and as Latin-1 bytes, decoded again."""
    texts = read_folder(spark, folder, "conversations").select("conv_id", "turn", "text")
    latin = F.encode(F.regexp_replace("text", r"[^\x00-\xff]", "?"), "ISO-8859-1")
    return texts.select(
        "conv_id",
        "turn",
        tx.decode_bytes(F.encode("text", "UTF-8")).alias("from_utf8"),
        tx.decode_bytes(F.concat(latin, F.lit(b"\xe9"))).alias("from_latin1"),
    )


def json_extract(spark, folder):
    return read_folder(spark, folder, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"))


def json_or_text(spark, folder):
    rows = read_folder(spark, folder, "events").select(
        "event_id", F.when(F.col("event_type") == "error", F.concat(F.lit("not json "), "props")).otherwise(F.col("props")).alias("value")
    )
    parsed = tx.json_or_text(F.col("value"))
    return rows.select(
        "event_id",
        F.try_variant_get(parsed, "$.k", "int").alias("k"),
        F.when(F.schema_of_variant(parsed) == "STRING", tx.variant_text(parsed)).alias("plain"),
    )


# -- answers and logs -------------------------------------------------------------------------------------------------

ANSWERS_SQL = """
SELECT o_orderkey, CASE o_orderpriority
 WHEN '1-URGENT' THEN 'Here: ' || chr(10) || '```SQL' || chr(10) || 'SELECT * FROM t WHERE id = ' || cast(o_orderkey AS STRING) || ';' || chr(10) || '```' || chr(10) || 'done'
 WHEN '2-HIGH' THEN 'The sql : delete from t' || chr(10) || ' where id = ' || cast(o_orderkey AS STRING) || '  '
 WHEN '3-MEDIUM' THEN 'I would say with x as (select ' || cast(o_orderkey AS STRING) || ') table x'
 WHEN '4-NOT SPECIFIED' THEN '{"note": 1, "query": "update t set a = ' || cast(o_orderkey AS STRING) || '"}'
 ELSE 'Sorry, SELECT Statement Could Not be generated for ' || cast(o_orderkey AS STRING) END AS answer
FROM orders
"""


def sql_extract(spark, folder):
    answers = derived(spark, folder, ANSWERS_SQL, "orders")
    asked = compute_once(answers, {"text": F.col("answer")}).select("o_orderkey", tx.extract_sql(F.col("text")).alias("sql"))
    return asked.withColumn("failed", tx.failed_generation(F.col("sql")))


STATEMENTS_SQL = """
SELECT o_orderkey, CASE o_orderpriority
 WHEN '1-URGENT' THEN '/* lead' || chr(10) || ' */ -- note' || chr(10) || ' select ''--keep'' as a -- drop ' || o_orderstatus || chr(10) || 'from t -- x'
 WHEN '2-HIGH' THEN 'With a as (select 1) select * from a where k=' || cast(o_orderkey AS STRING)
 WHEN '3-MEDIUM' THEN CASE o_orderstatus WHEN 'F' THEN 'comment  on table t is ''a--b''' WHEN 'O' THEN 'begin null; end;' ELSE 'comment_it' END
 WHEN '4-NOT SPECIFIED' THEN CASE o_orderstatus WHEN 'F' THEN 'merge into t using s' WHEN 'O' THEN 'Truncate table t' ELSE 'insert--x' || chr(10) || 'into t' END
 ELSE CASE o_orderstatus WHEN 'F' THEN 'selection' WHEN 'O' THEN '--only a comment' ELSE 'it''s -- open quote' END END AS stmt
FROM orders
"""


def statement_class(spark, folder):
    return derived(spark, folder, STATEMENTS_SQL, "orders").select("o_orderkey", tx.statement_class(F.col("stmt")).alias("class"))


def strip_comments(spark, folder):
    return derived(spark, folder, STATEMENTS_SQL, "orders").select("o_orderkey", tx.strip_comments(F.col("stmt")).alias("stmt"))


LOG_SQL = """
SELECT 'id' || cast(o_orderkey AS STRING) AS sql_id, 'SELECT  ' || o_orderpriority || chr(10) || ' FROM c' || cast(o_custkey AS STRING) AS sql_text,
 'FULL ' || o_orderstatus || '   c' || cast(o_custkey AS STRING) AS sql_fulltext,
 CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS translated_at, o_orderkey AS use_count FROM orders
"""
ASKED_SQL = """
SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'FULL O c' || cast(c_custkey AS STRING)
 WHEN c_mktsegment = 'MACHINERY' THEN '  ' ELSE ' SELECT 1-URGENT' || chr(10) || chr(9) || 'FROM c' || cast(c_custkey AS STRING) || ' ' END AS stmt FROM customer
"""


def text_key_latest(spark, folder):
    asked = derived(spark, folder, ASKED_SQL, "customer")
    return lookup.latest_log_entry(asked, "stmt", derived(spark, folder, LOG_SQL, "orders")).select("c_custkey", "sql_id")


def section_split(spark, folder):
    answers = derived(
        spark, folder,
        """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN '```text' || chr(10) || 'JOIN: a.id = ' || cast(o_orderkey AS STRING) || chr(10)
           || '  Where:  x > 1 ```' WHEN 'O' THEN 'join: ' || chr(10) || 'where: y = ' || o_orderpriority ELSE 'nothing' END AS answer FROM orders""",
        "orders",
    )
    return answers.select("o_orderkey", tx.section(F.col("answer"), 1).alias("join_text"), tx.section(F.col("answer"), 2).alias("where_text"))


def annotation_filter(spark, folder):
    scripts = derived(
        spark, folder,
        """SELECT p_partkey, 'ALTER TABLE t' || chr(10) || 'ALTER TABLE t annotations (ui ''' || p_name || ', x'', SAMPLE_header ''a,b'', "sample_data" ''1'', note '
           || p_type || ');' || chr(10) || 'ALTER VIEW v ANNOTATIONS (sample_data ''q'')' AS script FROM part""",
        "part",
    )
    return scripts.select("p_partkey", tx.filter_annotations(F.col("script")).alias("script"))


def identifier_check(spark, folder):
    names = derived(
        spark, folder,
        """SELECT p_partkey, CASE WHEN p_size < 20 THEN '"s"."' || p_name || '" ' WHEN p_size < 40 THEN ' Sch.' || replace(p_name, ' ', '_') || ';'
           ELSE p_name END AS name FROM part""",
        "part",
    )
    keyed = names.select("p_partkey", "name", tx.object_key(F.col("name")).alias("key"))
    return keyed.select("p_partkey", "key", tx.is_object_name(F.col("key")).alias("valid"), tx.is_table_name(F.col("name")).alias("table_ok"))


def retry_rows(spark, folder):
    """Answers that get better with each attempt, depending on the priority."""
    orders = read_folder(spark, folder, "orders").select("o_orderkey", "o_orderpriority")

    def attempt(prompt, n):
        level = F.substring(prompt, 1, 1).cast("int")
        return F.when(level <= n, F.concat(F.lit(f"SELECT {n} -- "), prompt)).otherwise("Exception Encountered: try again")

    return retry(orders, attempt, "o_orderpriority")


# -- payloads and conversations -----------------------------------------------------------------------------------------


def payload_text(spark, folder):
    turns = read_folder(spark, folder, "conversations")
    half = (F.length("text") / 2).cast("int")
    parts = F.array(
        F.struct(F.substring(F.col("text"), F.lit(1), half).alias("text")), F.struct(F.substring(F.col("text"), half + 1, F.length("text")).alias("text"))
    )
    payload = (
        F.when(F.col("role") == "user", F.to_json(F.struct(F.array(F.struct(F.struct(F.col("text").alias("content")).alias("delta"))).alias("choices"))))
        .when(F.col("role") == "assistant", F.to_json(F.struct(F.struct(parts.alias("content")).alias("message"))))
        .otherwise(F.to_json(F.struct(F.lit(7).alias("content"), F.col("text"))))
    )
    sent = compute_once(turns.select("conv_id", "turn", payload.alias("p")), {"payload": F.col("p")})
    return sent.select("conv_id", "turn", tx.payload_text("payload").alias("text"))


def reply_text(spark, folder):
    turns = read_folder(spark, folder, "conversations")
    answer = (
        F.when(F.col("role") == "user", F.to_json(F.struct(F.lit(3).alias("content"), F.col("text").alias("reply"))))
        .when(F.col("role") == "assistant", F.concat(F.lit(" "), "text", F.lit("\n")))
        .otherwise(F.to_json(F.array(F.col("conv_id"))))
    )
    return turns.select("conv_id", "turn", tx.reply_text(answer).alias("reply"))


def delta_concat(spark, folder):
    """Every message cut into pieces of seven characters and put together again."""
    turns = read_folder(spark, folder, "conversations")
    pieces = turns.select("conv_id", "turn", F.posexplode(F.regexp_extract_all("text", F.lit("(?s).{1,7}"), F.lit(0))).alias("seq", "delta"))
    return chat.join_deltas(pieces, ["conv_id", "turn"], "seq", "delta")


def chat_history(spark, folder):
    return chat.histories(read_folder(spark, folder, "conversations"))


def chat_replace_last(spark, folder):
    """The last message of every conversation replaced by a new text."""
    turns = read_folder(spark, folder, "conversations")
    last = turns.groupBy("conv_id").agg(F.max("turn").alias("turn")).withColumn("text", F.lit("done"))
    return chat.replace_last(turns, last)


def latest_prompts(spark, folder):
    prompts = read_folder(spark, folder, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("prompt_id"), F.col("role").alias("team_name"), "text"
    )
    return chat.latest_prompts(prompts, "prompt_id", "user")


def embedding_parse(spark, folder):
    vectors = read_folder(spark, folder, "embeddings")
    as_list = F.to_json(F.struct(F.col("embedding").alias("embed_vector"), F.col("vec_id").alias("chunk_id")))
    as_text = F.to_json(F.struct(F.to_json("embedding").alias("embed_vector")))
    chunk = F.when(F.col("label") < 4, as_list).when(F.col("label") < 8, as_text).otherwise(F.lit('{"other": 1}'))
    vector = F.col("vector")
    return vectors.select("vec_id", parse_embedding(chunk).alias("vector")).select(
        "vec_id",
        F.when(vector.isNotNull(), F.size(vector)).alias("dims"),
        F.round(F.aggregate(vector, F.lit(0.0), lambda a, x: a + x), 4).alias("total"),
    ).filter("dims IS NOT NULL")


# -- glossary, prompts, lookups, feedback --------------------------------------------------------------------------------

TERMS = {
    "the": "DER",
    "then": "DANN",
    "their": "IHR",
    "tion": "-TION-",
    "ation": "-ATION-",
    "de": "the",
    "der": "ONE",
    "ing the": "ING+THE",
    "a.b": "dot",
}


def _glossary(spark):
    return spark.createDataFrame(list(TERMS.items()) + [("x1", " "), (" ", "y")], "TERM string, DEFINITION string")


def glossary_rewrite(spark, folder):
    texts = read_folder(spark, folder, "documents").select("doc_id", "text")
    done = glossary.rewrite(texts, "text", _glossary(spark))
    return done.select("doc_id", F.array_join("matched_terms", "|").alias("matched_terms"), "rewritten")


def glossary_inverse(spark, folder):
    texts = read_folder(spark, folder, "benchmark").select("item_id", "text")
    done = glossary.rewrite(texts, "text", _glossary(spark), inverse=True)
    return done.select("item_id", "rewritten")


def _glossary_sql(table: str, key: str, pairs: dict[str, str], matched: bool) -> str:
    ordered = sorted(pairs, key=lambda t: (-len(t), t))
    pattern = "|".join(t.replace(".", "\\.").replace("-", "\\-").replace("+", "\\+") for t in ordered)
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in pairs.items())
    hits = f"regexp_extract_all(text, '{pattern}')"
    pieces = f"regexp_split_to_array(text, '{pattern}')"
    terms = f"array_to_string(list_sort(list_distinct({hits})), '|') AS matched_terms," if matched else ""
    return f"""SELECT {key}, {terms} array_to_string(list_transform(list_zip({pieces}, {hits}),
        lambda z: z[1] || coalesce(CASE z[2] {cases} END, '')), '') AS rewritten FROM {table}"""


RULES_SQL = """
SELECT item_id AS no, CASE WHEN text LIKE 'T%' THEN 'en' WHEN text LIKE 'R%' THEN 'fr' WHEN text LIKE 'E%' THEN ' nan ' WHEN text LIKE 'A%' THEN NULL
 ELSE 'de' END AS CATEGORY, CASE WHEN text LIKE 'S%' THEN ' ' ELSE text END AS RULE FROM benchmark
"""


def rules_prompt(spark, folder):
    questions = read_folder(spark, folder, "documents").select("doc_id", F.concat("text", F.lit(";")).alias("question"), "lang")
    rules = derived(spark, folder, RULES_SQL, "benchmark")
    prompts = glossary.assemble_prompts(questions, "question", "lang", rules, "no", F.col("lang"))
    return prompts.select("doc_id", F.length("prompt").alias("prompt_length"), F.md5("prompt").alias("prompt_md5"))


def rules_for_category(spark, folder):
    rules = glossary.rules_for(derived(spark, folder, RULES_SQL, "benchmark"), "en")
    return rules.select("no", F.col("CATEGORY").alias("category"))


PROFILES = [
    ("SALES", "1-URGENT"),
    ("sales_b", "1-URGENT"),
    ("HR", "2-HIGH "),
    ("3-MEDIUM", "HR"),
    ("OPS", "3-MEDIUM"),
]


def _profiles(spark):
    return spark.createDataFrame(PROFILES, "profile string, category string")


def two_stage_lookup(spark, folder):
    orders = read_folder(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    return lookup.resolve_name(orders, "o_orderpriority", _profiles(spark))


def two_stage_fallback(spark, folder):
    orders = read_folder(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    return lookup.resolve_name(orders, "o_orderpriority", _profiles(spark), category_first=True)


def route_lookup(spark, folder):
    orders = read_folder(spark, folder, "orders").select("o_orderkey", F.lower("o_orderpriority").alias("predicted"))
    return lookup.route(orders, "predicted", _profiles(spark), "DEFAULT")


def _said(spark, folder):
    turns = read_folder(spark, folder, "conversations")
    answers = turns.filter("role = 'assistant'").select(
        F.col("conv_id").alias("a_conv"), (F.col("turn") - 1).alias("a_turn"), F.col("text").alias("response")
    )
    asked = turns.filter("role = 'user'").join(answers, (F.col("conv_id") == F.col("a_conv")) & (F.col("turn") == F.col("a_turn")), "left")
    return asked.select(
        F.concat(F.lit(" "), "text", F.lit(";")).alias("question"),
        F.when(F.col("turn") <= 1, "positive").otherwise("negative").alias("kind"),
        "response",
        F.col("role").alias("comment"),
        (F.col("conv_id") * 1000 + F.col("turn")).alias("given_at"),
    )


def feedback_upsert(spark, folder):
    entries = read_folder(spark, folder, "conversations").filter("turn <= 1 AND role = 'user'").select(
        feedback.feedback_key(F.col("text")).alias("sql_text"), F.lit("OLD").alias("feedback_type"), F.lit("r").alias("response"), F.lit("c").alias("content")
    ).dropDuplicates(["sql_text"])
    merged = feedback.add_feedback(entries, _said(spark, folder))
    gone = read_folder(spark, folder, "conversations").filter("turn >= 4").select(feedback.feedback_key(F.col("text")).alias("sql_text"))
    return feedback.delete_feedback(merged, gone)


def feedback_refused(spark, folder):
    return feedback.refused(_said(spark, folder)).agg(F.count("*").alias("refused"))


def feedback_index(spark, folder):
    index = read_folder(spark, folder, "events").select(
        F.concat(F.lit("select ai showsql "), "event_type").alias("CONTENT"),
        F.to_json(F.struct(F.concat(F.lit("id"), "event_id").alias("sql_id"), F.concat(F.lit('a "quoted" '), "event_type").alias("sql_text"))).alias("ATTRIBUTES"),
    )
    return feedback.index_view(index, None).select("CONTENT", "SQL_ID", "SQL_TEXT")


D = lambda sql: sql.replace("AS STRING", "AS VARCHAR")
_WS = (
    "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(28) || chr(29) || chr(30) || chr(31) || ' ' || chr(133) || chr(160) || chr(5760)"
    " || chr(8192) || chr(8193) || chr(8194) || chr(8195) || chr(8196) || chr(8197) || chr(8198) || chr(8199) || chr(8200) || chr(8201)"
    " || chr(8202) || chr(8232) || chr(8233) || chr(8239) || chr(8287) || chr(12288)"
)


def _unescaped(text: str) -> str:
    return rf"""replace(replace(replace(replace({text}, '\n', chr(10)), '\t', chr(9)), '\r', ''), '\"', '"')"""


_TRIMMED = f"trim(text, {_WS})"
_ASKED = f"trim(text || ';', {_WS})"

QUERIES = {
    "text_preview": (text_preview, "SELECT doc_id, CASE WHEN length(text) > 200 THEN substr(text, 1, 200) || ' ...' ELSE text END AS preview FROM documents"),
    "value_normalise": (
        value_normalise,
        rf"""SELECT 'd' AS kind, doc_id AS id, {_unescaped(f"ltrim(text, {_WS}) || '\n'")} AS value FROM documents
            UNION ALL SELECT 'e', event_id, props || chr(10) FROM events
            UNION ALL SELECT 'j', event_id, '{{' || chr(10) || '  "k": ' || (props->>'k') || chr(10) || '}}' FROM events""",
    ),
    "byte_cells": (
        byte_cells,
        r"""SELECT conv_id, turn, text AS from_utf8, regexp_replace(text, '[^\x00-\x{ff}]', '?', 'g') || 'é' AS from_latin1 FROM conversations""",
    ),
    "json_extract": (json_extract, "SELECT event_id, props->>'k' AS k FROM events"),
    "json_or_text": (
        json_or_text,
        """SELECT event_id, CASE WHEN event_type <> 'error' THEN (props->>'k')::INT END AS k,
           CASE WHEN event_type = 'error' THEN 'not json ' || props END AS plain FROM events""",
    ),
    "sql_extract": (
        sql_extract,
        """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'SELECT * FROM t WHERE id = ' || o_orderkey || ';'
           WHEN '2-HIGH' THEN 'delete from t' || chr(10) || ' where id = ' || o_orderkey
           WHEN '3-MEDIUM' THEN 'with x as (select ' || o_orderkey || ') table x'
           WHEN '4-NOT SPECIFIED' THEN 'update t set a = ' || o_orderkey
           ELSE 'SELECT Statement Could Not be generated for ' || o_orderkey END AS sql, o_orderpriority = '5-LOW' AS failed FROM orders""",
    ),
    "statement_class": (
        statement_class,
        """SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'SELECT'
           WHEN o_orderpriority = '3-MEDIUM' THEN CASE o_orderstatus WHEN 'F' THEN 'COMMENT' WHEN 'O' THEN 'PLSQL' ELSE 'UNKNOWN' END
           WHEN o_orderpriority = '4-NOT SPECIFIED' THEN CASE o_orderstatus WHEN 'F' THEN 'MERGE' WHEN 'O' THEN 'TRUNCATE' ELSE 'INSERT' END
           ELSE 'UNKNOWN' END AS class FROM orders""",
    ),
    "strip_comments": (
        strip_comments,
        f"""SELECT o_orderkey, array_to_string(list_transform(string_split(stmt, chr(10)),
            lambda l: regexp_replace(l, '^((?:[^''-]|''[^'']*''|-[^''-]|-''[^'']*'')*)--.*$', '\\1')), chr(10)) AS stmt FROM ({D(STATEMENTS_SQL)})""",
    ),
    "text_key_latest": (
        text_key_latest,
        f"""WITH log AS ({D(LOG_SQL)}), q AS ({D(ASKED_SQL)}),
        a AS (SELECT regexp_replace(sql_text, '\\s+', ' ', 'g') AS k, arg_max(sql_id, (coalesce(translated_at, '0001-01-01'::TIMESTAMP), use_count)) AS id FROM log GROUP BY 1),
        b AS (SELECT regexp_replace(sql_fulltext, '\\s+', ' ', 'g') AS k, arg_max(sql_id, (coalesce(translated_at, '0001-01-01'::TIMESTAMP), use_count)) AS id FROM log GROUP BY 1)
        SELECT c_custkey, coalesce(a.id, b.id) AS sql_id FROM (SELECT *, regexp_replace(trim(stmt), '\\s+', ' ', 'g') AS k FROM q) q
        LEFT JOIN a ON a.k = q.k LEFT JOIN b ON b.k = q.k""",
    ),
    "section_split": (
        section_split,
        """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'a.id = ' || o_orderkey ELSE 'None' END AS join_text,
           CASE o_orderstatus WHEN 'F' THEN 'x > 1' WHEN 'O' THEN 'y = ' || o_orderpriority ELSE 'None' END AS where_text FROM orders""",
    ),
    "annotation_filter": (
        annotation_filter,
        """SELECT p_partkey, 'ALTER TABLE t' || chr(10) || 'ALTER TABLE t annotations (ui ''' || p_name || ', x'', note ' || p_type || ');' AS script FROM part""",
    ),
    "identifier_check": (
        identifier_check,
        """WITH k AS (SELECT p_partkey, p_size, p_name, upper(CASE WHEN p_size >= 20 AND p_size < 40 THEN replace(p_name, ' ', '_') ELSE p_name END) AS key FROM part)
           SELECT p_partkey, key, regexp_matches(key, '^[A-Z][A-Z0-9_$#]{0,127}$') AS valid,
           p_size >= 40 AND regexp_matches(upper(p_name), '^[A-Z0-9_$#]+$') AS table_ok FROM k""",
    ),
    "retry_rows": (
        retry_rows,
        """SELECT o_orderkey, o_orderpriority, least(n, 3)::INT AS attempts,
           CASE WHEN n <= 3 THEN 'SELECT ' || n || ' -- ' || o_orderpriority END AS answer, n <= 3 AS succeeded
           FROM (SELECT *, substr(o_orderpriority, 1, 1)::INT AS n FROM orders)""",
    ),
    "payload_text": (payload_text, "SELECT conv_id, turn, text FROM conversations"),
    "reply_text": (
        reply_text,
        f"""SELECT conv_id, turn, CASE role WHEN 'user' THEN text WHEN 'assistant' THEN {_TRIMMED}
            ELSE '[' || chr(10) || '  ' || conv_id || chr(10) || ']' END AS reply FROM conversations""",
    ),
    "delta_concat": (delta_concat, "SELECT conv_id, turn, text AS message FROM conversations"),
    "chat_history": (
        chat_history,
        """SELECT conv_id, '[' || string_agg(to_json({'role': role, 'content': text})::VARCHAR, ',' ORDER BY turn) || ']' AS history
           FROM conversations GROUP BY conv_id""",
    ),
    "chat_replace_last": (
        chat_replace_last,
        """SELECT conv_id, turn, role, CASE WHEN turn = max(turn) OVER (PARTITION BY conv_id) THEN 'done' ELSE text END AS text FROM conversations""",
    ),
    "latest_prompts": (
        latest_prompts,
        "SELECT conv_id * 1000 + turn AS prompt_id, role AS team_name, text FROM conversations WHERE role = 'user' ORDER BY 1 DESC LIMIT 50",
    ),
    "embedding_parse": (
        embedding_parse,
        "SELECT vec_id, len(embedding)::INT AS dims, round(list_sum(embedding::DOUBLE[]), 4) AS total FROM embeddings WHERE label < 8",
    ),
    "glossary_rewrite": (glossary_rewrite, _glossary_sql("documents", "doc_id", TERMS, True)),
    "glossary_inverse": (glossary_inverse, _glossary_sql("benchmark", "item_id", {v: k for k, v in TERMS.items()}, False)),
    "rules_prompt": (
        rules_prompt,
        f"""WITH r AS (SELECT no, CASE WHEN CATEGORY IS NULL OR trim(CATEGORY) = 'nan' THEN NULL ELSE CATEGORY END AS cat, RULE AS rule
                 FROM ({RULES_SQL}) WHERE trim(RULE) <> ''),
        langs AS (SELECT DISTINCT lang FROM documents),
        t AS (SELECT lang, string_agg(trim(rule, {_WS}), chr(10) || chr(10) ORDER BY no) AS rules FROM langs JOIN r ON cat IS NULL OR cat = lang GROUP BY lang),
        p AS (SELECT doc_id, lang || chr(10) || chr(10) || text || ';' || coalesce(chr(10) || chr(10) || '=== Rules ===' || chr(10) || rules, '') AS p
              FROM documents LEFT JOIN t USING (lang)),
        x AS (SELECT doc_id, CASE WHEN ends_with(p, ';') THEN left(p, length(p) - 1) ELSE p END AS p FROM p)
        SELECT doc_id, length(p)::INT AS prompt_length, md5(p) AS prompt_md5 FROM x""",
    ),
    "rules_for_category": (
        rules_for_category,
        """SELECT item_id AS no, CASE WHEN text LIKE 'T%' THEN 'en' ELSE '共通' END AS category FROM benchmark
           WHERE text LIKE 'T%' OR text LIKE 'E%' OR text LIKE 'A%'""",
    ),
    "two_stage_lookup": (
        two_stage_lookup,
        """SELECT o_orderkey, o_orderpriority, CASE o_orderpriority WHEN '3-MEDIUM' THEN '3-MEDIUM' WHEN '1-URGENT' THEN 'SALES' WHEN '2-HIGH' THEN 'HR'
           ELSE o_orderpriority END AS resolved, CASE o_orderpriority WHEN '3-MEDIUM' THEN 'name' WHEN '1-URGENT' THEN 'category'
           WHEN '2-HIGH' THEN 'category' ELSE 'text' END AS resolved_by FROM orders""",
    ),
    "two_stage_fallback": (
        two_stage_fallback,
        """SELECT o_orderkey, o_orderpriority, CASE o_orderpriority WHEN '3-MEDIUM' THEN 'OPS' WHEN '1-URGENT' THEN 'SALES' WHEN '2-HIGH' THEN 'HR'
           ELSE o_orderpriority END AS resolved, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN 'category' ELSE 'text' END
           AS resolved_by FROM orders""",
    ),
    "route_lookup": (
        route_lookup,
        """SELECT o_orderkey, lower(o_orderpriority) AS predicted, CASE o_orderpriority WHEN '1-URGENT' THEN 'SALES' WHEN '2-HIGH' THEN 'HR'
           WHEN '3-MEDIUM' THEN 'OPS' ELSE 'DEFAULT' END AS route FROM orders""",
    ),
    "feedback_upsert": (
        feedback_upsert,
        f"""WITH u AS (SELECT c.*, trim(a.text, {_WS}) AS response FROM conversations c
                 LEFT JOIN conversations a ON a.conv_id = c.conv_id AND a.turn = c.turn + 1 AND a.role = 'assistant' WHERE c.role = 'user'),
        f AS (SELECT 'select ai showsql ' || ltrim(text, {_WS}) AS sql_text, conv_id * 1000 + turn AS said, response,
                 'NEGATIVE' AS feedback_type, role AS content FROM u WHERE response <> ''),
        s AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY sql_text ORDER BY said DESC) = 1),
        strip AS (SELECT conv_id, turn, role, trim(text, {_WS}) AS t FROM conversations),
        keyed AS (SELECT *, 'select ai showsql ' || CASE WHEN ends_with(t, ';') THEN left(t, length(t) - 1) ELSE t END AS sql_text FROM strip),
        e AS (SELECT DISTINCT sql_text FROM keyed WHERE turn <= 1 AND role = 'user'),
        m AS (SELECT coalesce(e.sql_text, s.sql_text) AS sql_text, coalesce(s.feedback_type, 'OLD') AS feedback_type,
                 coalesce(s.response, 'r') AS response, coalesce(s.content, 'c') AS content FROM e FULL JOIN s ON s.sql_text = e.sql_text)
        SELECT * FROM m WHERE sql_text NOT IN (SELECT sql_text FROM keyed WHERE turn >= 4)""",
    ),
    "feedback_refused": (
        feedback_refused,
        """SELECT count(*) AS refused FROM conversations c LEFT JOIN conversations a ON a.conv_id = c.conv_id AND a.turn = c.turn + 1
           AND a.role = 'assistant' WHERE c.role = 'user' AND coalesce(trim(a.text), '') = ''""",
    ),
    "feedback_index": (
        feedback_index,
        """SELECT 'select ai showsql ' || event_type AS "CONTENT", 'id' || event_id AS "SQL_ID", 'a "quoted" ' || event_type AS "SQL_TEXT" FROM events""",
    ),
}
