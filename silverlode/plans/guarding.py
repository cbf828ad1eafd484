"""Registered queries: row-level access, rule registry, inventory, privilege audit.

Catalog-like inputs (objects, rules, policies, grants) are derived from the driver tables by SQL that both engines
understand, so they grow with the data.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.operators import access
from silverlode.operators.access import FULL, RELATION_MATCH, ROW_MATCH, GuardedReader, Rule
from silverlode.sources.tables import read_folder, union_all

OWNER, REGISTRY, CONTEXT = "ADMIN", "ACCESS_RULES", "CTX_PKG"


def derived(spark: SparkSession, folder: str, sql: str, *tables: str) -> DataFrame:
    """A DataFrame from SQL over tables of the folder."""
    frames = {t: read_folder(spark, folder, t) for t in tables}
    text = sql.replace("{", "{{").replace("}", "}}")
    text = re.sub(rf"\b(FROM|JOIN)(\s+)({'|'.join(tables)})\b", r"\1\2{\3}", text)
    return spark.sql(text, **frames)


OBJECTS_SQL = """
SELECT upper(c_name) AS object_name, CASE WHEN c_mktsegment = 'FURNITURE' THEN 'VIEW' ELSE 'TABLE' END AS object_type,
 CASE WHEN c_nationkey = 7 THEN 'Y' ELSE 'N' END AS temporary, CASE WHEN c_nationkey = 8 THEN 'Y' ELSE 'N' END AS generated,
 'N' AS secondary FROM customer
UNION ALL SELECT 'BIN$' || s_name AS object_name, 'TABLE' AS object_type, 'N' AS temporary, 'N' AS generated, 'N' AS secondary
 FROM supplier
"""
RULES_SQL = """
SELECT upper(c_name) AS OBJECT_NAME, 'TABLE' AS OBJECT_TYPE,
 CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'FULL' WHEN 'BUILDING' THEN 'ROW_MATCH' WHEN 'HOUSEHOLD' THEN 'ROW_MATCH'
  ELSE 'RELATION_MATCH' END AS ACCESS_MODE,
 CASE WHEN c_mktsegment IN ('BUILDING', 'HOUSEHOLD') THEN 'LOGIN' END AS MATCH_COLUMN,
 CASE WHEN c_mktsegment IN ('FURNITURE', 'MACHINERY') THEN 'CUSTOMER#' || lpad(cast(c_nationkey AS STRING), 9, '0') END
  AS RELATION_OBJECT,
 CASE WHEN c_mktsegment IN ('FURNITURE', 'MACHINERY') THEN 'KEY_ID' END AS RELATION_TARGET_COLUMN,
 CASE WHEN c_mktsegment IN ('FURNITURE', 'MACHINERY') THEN 'KEY_ID' END AS RELATION_OBJECT_COLUMN,
 CASE WHEN c_mktsegment IN ('FURNITURE', 'MACHINERY') THEN 'LOGIN' END AS RELATION_MATCH_COLUMN,
 CASE WHEN c_mktsegment <> 'AUTOMOBILE' THEN 'POL_' || cast(c_custkey AS STRING) END AS POLICY_NAME,
 CASE WHEN c_mktsegment <> 'AUTOMOBILE' THEN 'FN_' || cast(c_custkey AS STRING) END AS FUNCTION_NAME,
 CASE WHEN c_acctbal < 4000 THEN 'STAGED' WHEN c_acctbal > 9000 THEN 'ERROR' ELSE 'ACTIVE' END AS STATE
FROM customer WHERE c_acctbal >= 2000
"""
BROKEN_RULES_SQL = """
SELECT CASE WHEN c_nationkey = 5 THEN c_name ELSE upper(c_name) END AS OBJECT_NAME, 'TABLE' AS OBJECT_TYPE,
 CASE WHEN c_nationkey = 4 THEN 'SOME' WHEN c_mktsegment = 'AUTOMOBILE' THEN 'FULL' WHEN c_mktsegment = 'BUILDING' THEN 'ROW_MATCH'
  ELSE 'RELATION_MATCH' END AS ACCESS_MODE,
 CASE WHEN c_acctbal < 3000 THEN 'LOGIN' END AS MATCH_COLUMN,
 CASE WHEN c_acctbal > 6000 THEN 'T' END AS RELATION_OBJECT, CASE WHEN c_acctbal > 7000 THEN 'A' END AS RELATION_TARGET_COLUMN,
 CASE WHEN c_acctbal > 7000 THEN 'B' END AS RELATION_OBJECT_COLUMN, CASE WHEN c_acctbal > 7000 THEN 'C' END AS RELATION_MATCH_COLUMN,
 CASE WHEN c_nationkey = 3 THEN 'OLD' ELSE 'ACTIVE' END AS STATE FROM customer
UNION ALL SELECT 'CUSTOMER#' || lpad(cast(s_suppkey AS STRING), 9, '0') AS OBJECT_NAME, 'TABLE' AS OBJECT_TYPE, 'FULL' AS ACCESS_MODE,
 NULL AS MATCH_COLUMN, NULL AS RELATION_OBJECT, NULL AS RELATION_TARGET_COLUMN, NULL AS RELATION_OBJECT_COLUMN,
 NULL AS RELATION_MATCH_COLUMN, 'ACTIVE' AS STATE FROM supplier
"""
COLUMNS_SQL = """
SELECT upper(c_name) AS object_name, 'KEY_ID' AS column_name, 'NUMBER' AS data_type,
 CASE WHEN c_nationkey < 12 THEN 0 ELSE 2 END AS data_scale, 'NO' AS hidden FROM customer
UNION ALL SELECT upper(c_name) AS object_name, 'LOGIN' AS column_name,
 CASE WHEN c_nationkey = 1 THEN 'NUMBER' WHEN c_nationkey = 2 THEN 'DATE' ELSE 'VARCHAR2' END AS data_type,
 CASE WHEN c_nationkey = 1 THEN 2 END AS data_scale, CASE WHEN c_nationkey = 6 THEN 'YES' ELSE 'NO' END AS hidden FROM customer
"""
POLICIES_SQL = """
SELECT upper(c_name) AS object_name,
 CASE WHEN c_nationkey = 9 THEN 'OTHER' ELSE 'POL_' || cast(c_custkey AS STRING) END AS policy_name,
 CASE WHEN c_nationkey = 10 THEN 'GROUP_B' ELSE 'SYS_DEFAULT' END AS policy_group, 'YES' AS select_flag,
 CASE WHEN c_nationkey = 11 THEN 'NO' ELSE 'YES' END AS enabled FROM customer WHERE c_mktsegment <> 'AUTOMOBILE' AND c_acctbal >= 1000
"""
GRANTS_SQL = """
SELECT o_custkey AS grantee, 'ADMIN' AS owner,
 CASE WHEN o_orderpriority = '1-URGENT' THEN 'CTX_PKG' ELSE 'CUSTOMER#' || lpad(cast(o_custkey AS STRING), 9, '0') END AS object_name,
 CASE o_orderpriority WHEN '1-URGENT' THEN 'EXECUTE' WHEN '2-HIGH' THEN 'READ' WHEN '3-MEDIUM' THEN 'SELECT' ELSE 'DELETE' END AS privilege
FROM orders WHERE o_orderstatus = 'O' AND o_totalprice > 250000
"""
SYSTEM_SQL = """
SELECT o_custkey AS grantee, CASE o_orderpriority WHEN '1-URGENT' THEN 'CREATE SESSION' WHEN '2-HIGH' THEN 'EXEMPT ACCESS POLICY'
 WHEN '3-MEDIUM' THEN 'READ ANY TABLE' WHEN '5-LOW' THEN 'SELECT ANY DICTIONARY' ELSE 'CONNECT' END AS privilege
FROM orders WHERE o_orderstatus = 'P'
"""
ROLES_SQL = """
SELECT o_custkey AS grantee, CASE o_orderpriority WHEN '1-URGENT' THEN 'DBA' ELSE 'RESOURCE' END AS role
FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 300000
"""
SCHEMAS_SQL = """
SELECT o_custkey AS grantee, CASE o_orderpriority WHEN '3-MEDIUM' THEN 'READ ANY TABLE' ELSE 'SELECT ANY TABLE' END AS privilege,
 CASE WHEN o_orderpriority IN ('3-MEDIUM', '2-HIGH') THEN 'ADMIN' ELSE 'OTHER' END AS schema_name
FROM orders WHERE o_orderstatus = 'F' AND o_totalprice < 100000
"""


def _objects(spark, folder):
    return derived(spark, folder, OBJECTS_SQL, "customer", "supplier")


def _rules(spark, folder):
    return derived(spark, folder, RULES_SQL, "customer")


def _policies(spark, folder):
    return derived(spark, folder, POLICIES_SQL, "customer")


def _grants(spark, folder):
    return derived(spark, folder, GRANTS_SQL, "orders")


def _reader(spark, folder) -> GuardedReader:
    tables = {t: read_folder(spark, folder, t) for t in ("customer", "orders", "supplier", "part")}
    rules = [
        Rule("CUSTOMER", "TABLE", ROW_MATCH, match_column="c_mktsegment"),
        Rule("CUSTOMER", "TABLE", ROW_MATCH, match_column="c_mktsegment"),
        Rule("ORDERS", "TABLE", RELATION_MATCH, None, "CUSTOMER", "o_custkey", "c_custkey", "c_mktsegment"),
        Rule("SUPPLIER", "TABLE", FULL),
        Rule("PART", "TABLE", FULL, state="STAGED"),
    ]
    return GuardedReader(tables, rules)


def policy_row_match(spark, folder):
    return _reader(spark, folder).read("customer", "BUILDING")


def policy_row_match_number(spark, folder):
    rule = Rule("ORDERS", "TABLE", ROW_MATCH, match_column="o_custkey")
    orders = read_folder(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    seen = [access.apply_rule(orders, rule, login).withColumn("login", F.lit(login)) for login in ("42", "0042", "4e1", "x42", "4.5")]
    out = seen[0]
    for rows in seen[1:]:
        out = out.unionByName(rows)
    return out


def policy_gold_decimal(spark, folder):
    """A match column of the type that Gold numbers have."""
    rule = Rule("ORDERS", "TABLE", ROW_MATCH, match_column="o_custkey")
    orders = read_folder(spark, folder, "orders").select("o_orderkey", F.col("o_custkey").cast("decimal(38,10)").alias("o_custkey"))
    seen = access.apply_rule(orders, rule, "0042").unionByName(access.apply_rule(orders, rule, "4.5"))
    return seen.select("o_orderkey", F.col("o_custkey").cast("double").alias("o_custkey"))


def policy_relation(spark, folder):
    return _reader(spark, folder).read("orders", "BUILDING").select("o_orderkey", "o_custkey", "o_totalprice")


def policy_and(spark, folder):
    """A relation rule and a row rule on one object."""
    reader = _reader(spark, folder)
    both = GuardedReader(reader.tables, [*reader.rules, Rule("ORDERS", "TABLE", ROW_MATCH, match_column="o_orderstatus")])
    by_relation = GuardedReader(reader.tables, reader.rules).read("orders", "BUILDING")
    rule = Rule("ORDERS", "TABLE", ROW_MATCH, match_column="o_orderstatus")
    nobody = both.read("orders", "BUILDING").agg(F.count("*").alias("rows")).withColumn("case", F.lit("one login"))
    some = access.apply_rule(by_relation, rule, "F").agg(F.count("*").alias("rows")).withColumn("case", F.lit("two logins"))
    return nobody.unionByName(some)


def policy_no_login(spark, folder):
    return _reader(spark, folder).read("customer", None)


def policy_full(spark, folder):
    return _reader(spark, folder).read("supplier", "anyone")


def policy_registry_check(spark, folder):
    return access.registry_violations(derived(spark, folder, BROKEN_RULES_SQL, "customer", "supplier"))


def policy_rule_problems(spark, folder):
    objects = access.business_objects(_objects(spark, folder), REGISTRY)
    columns = derived(spark, folder, COLUMNS_SQL, "customer")
    return access.rule_problems(_rules(spark, folder), objects, columns, _policies(spark, folder)).select(
        F.col("OBJECT_NAME").alias("object_name"), "reason"
    )


def eligible_columns(spark, folder):
    columns = derived(spark, folder, COLUMNS_SQL, "customer")
    matching = access.match_columns(columns).groupBy("data_type").agg(F.count("*").alias("match_columns"))
    related = access.relation_columns(columns).groupBy(F.col("data_type").alias("d")).agg(F.count("*").alias("relation_columns"))
    return related.join(matching, F.col("d") == F.col("data_type"), "left").select(F.col("d").alias("data_type"), "match_columns", "relation_columns")


def object_filter(spark, folder):
    objects = _objects(spark, folder)
    kept = access.business_objects(objects, REGISTRY).groupBy("object_type").agg(F.count("*").alias("rows"))
    listed = access.listed_tables(objects).agg(F.count("*").alias("rows")).select(F.lit("listed").alias("object_type"), "rows")
    return kept.unionByName(listed)


def policy_inventory(spark, folder):
    objects = access.business_objects(_objects(spark, folder), REGISTRY)
    grants = _grants(spark, folder).filter(F.col("privilege").isin("READ", "SELECT"))
    return access.access_inventory(objects, _rules(spark, folder), _policies(spark, folder), grants, broad_read=False)


def policy_attributes(spark, folder):
    policies = derived(
        spark, folder,
        """SELECT 'ADMIN' AS object_owner, upper(c_name) AS object_name, 'SYS_DEFAULT' AS policy_group,
           'POL_' || cast(c_custkey AS STRING) AS policy_name, CASE WHEN c_nationkey = 0 THEN 'PKG' END AS package FROM customer""",
        "customer",
    )
    attributes = derived(
        spark, folder,
        """SELECT 'ADMIN' AS object_owner, 'CUSTOMER#' || lpad(cast(s_suppkey AS STRING), 9, '0') AS object_name, 'SYS_DEFAULT' AS policy_group,
           'POL_' || cast(s_suppkey AS STRING) AS policy_name, s_name AS namespace, 'LOGIN' AS attribute FROM supplier""",
        "supplier",
    )
    return access.policies_with_attributes(policies, attributes)


def collected_privileges(spark, folder):
    return access.collected_privileges(_grants(spark, folder)).select("object_name", F.array_join("privileges", ",").alias("privileges"))


def _audit(spark, folder):
    return access.privilege_audit(
        derived(spark, folder, "SELECT c_custkey AS grantee FROM customer", "customer"),
        derived(spark, folder, SYSTEM_SQL, "orders"),
        derived(spark, folder, ROLES_SQL, "orders"),
        derived(spark, folder, SCHEMAS_SQL, "orders"),
        _grants(spark, folder),
        _rules(spark, folder),
        OWNER,
        CONTEXT,
    )


def privilege_audit(spark, folder):
    return _audit(spark, folder)


def severity_rollup(spark, folder):
    return access.rollup(_audit(spark, folder), "grantee")


def unexpected_grants(spark, folder):
    return access.unexpected_grants(_grants(spark, folder), OWNER, REGISTRY, CONTEXT).groupBy("privilege").agg(F.count("*").alias("rows"))


#: Users hold roles of their nation, nations those of their region; three regions hold one another's in a circle.
EFFECTIVE = {
    "users": "SELECT c_custkey AS grantee FROM customer",
    "system": """SELECT cast(c_custkey AS STRING) AS grantee, 'EXEMPT ACCESS POLICY' AS privilege FROM customer WHERE c_custkey % 50 = 0
UNION ALL SELECT 'N' || cast(n_nationkey AS STRING) AS grantee, CASE WHEN n_nationkey % 8 = 0 THEN 'READ ANY TABLE' ELSE 'CREATE SESSION' END AS privilege FROM nation WHERE n_nationkey % 4 = 0
UNION ALL SELECT 'R2' AS grantee, 'CREATE ANY CONTEXT' AS privilege FROM region WHERE r_regionkey = 2""",
    "roles": """SELECT cast(c_custkey AS STRING) AS grantee, 'N' || cast(c_nationkey AS STRING) AS role FROM customer WHERE c_custkey % 3 <> 0
UNION ALL SELECT 'N' || cast(n_nationkey AS STRING) AS grantee, 'R' || cast(n_regionkey AS STRING) AS role FROM nation
UNION ALL SELECT 'R' || cast(r_regionkey AS STRING) AS grantee, CASE WHEN r_regionkey < 3 THEN 'R' || cast((r_regionkey + 1) % 3 AS STRING) ELSE 'DBA' END AS role FROM region WHERE r_regionkey <> 3""",
    "schemas": """SELECT 'R3' AS grantee, 'READ ANY TABLE' AS privilege, 'ADMIN' AS schema_name FROM region WHERE r_regionkey = 3
UNION ALL SELECT 'N' || cast(n_nationkey AS STRING) AS grantee, 'SELECT ANY TABLE' AS privilege, n_name AS schema_name FROM nation WHERE n_nationkey < 4""",
    "objects": """SELECT cast(c_custkey AS STRING) AS grantee, 'ADMIN' AS owner, CASE WHEN c_custkey % 40 = 1 THEN 'ACCESS_RULES' WHEN c_custkey % 40 = 2 THEN 'CTX_PKG' ELSE 'T' END AS object_name,
 CASE WHEN c_custkey % 40 = 2 THEN 'EXECUTE' WHEN c_custkey % 40 = 3 THEN 'DELETE' ELSE 'READ' END AS privilege FROM customer WHERE c_custkey % 40 < 6
UNION ALL SELECT 'N5' AS grantee, 'ADMIN' AS owner, 'T2' AS object_name, 'SELECT' AS privilege FROM nation WHERE n_nationkey = 5""",
}


def effective_audit(spark, folder):
    tables = [derived(spark, folder, sql, "customer", "nation", "region") for sql in EFFECTIVE.values()]
    return access.effective_audit(*tables, OWNER, REGISTRY, CONTEXT)


EFFECTIVE_SQL = f"""WITH RECURSIVE users AS ({EFFECTIVE['users']}), system AS ({EFFECTIVE['system']}), roles AS ({EFFECTIVE['roles']}), schemas AS ({EFFECTIVE['schemas']}), objects AS ({EFFECTIVE['objects']}),
held AS (SELECT cast(grantee AS STRING) AS u, cast(grantee AS STRING) AS h FROM users UNION SELECT u, role FROM held JOIN roles ON h = grantee),
found AS (
 SELECT u, 1 AS no, privilege AS item FROM held JOIN system ON h = grantee WHERE privilege <> 'CREATE SESSION' UNION SELECT u, 1, h FROM held WHERE h IN ('DBA', 'ADB_DBA')
 UNION SELECT u, 2, '有効。テーブル許可リストへの移行が必要です' FROM held JOIN schemas ON h = grantee WHERE schema_name = 'ADMIN'
 UNION SELECT u, 3, privilege || ' ON SCHEMA ' || schema_name FROM held JOIN schemas ON h = grantee WHERE schema_name <> 'ADMIN'
 UNION SELECT u, 4, privilege || ' ON ADMIN.' || object_name || ' (' || h || ')' FROM held JOIN objects ON h = grantee
 WHERE NOT (u = h AND (object_name = 'CTX_PKG' AND privilege = 'EXECUTE' OR object_name <> 'ACCESS_RULES' AND privilege = 'READ'))),
texts AS (SELECT u, no, string_agg(item, ', ' ORDER BY item) AS finding FROM found GROUP BY u, no),
checks(no, "check", bad) AS (VALUES (1, '実行セッションの危険な有効権限', '危険'), (2, '実行セッションのADMIN schema全表読取', '移行警告'),
 (3, '実行セッションの想定外Schema権限', '危険'), (4, '実行セッションの想定外オブジェクト権限', '危険'))
SELECT cast(grantee AS STRING) AS grantee, c."check", CASE WHEN finding IS NULL THEN 'OK' ELSE bad END AS status, coalesce(finding, 'なし') AS finding
FROM users CROSS JOIN checks c LEFT JOIN texts t ON t.u = cast(grantee AS STRING) AND t.no = c.no""".replace("AS STRING", "AS VARCHAR")

LISTED_SQL = POLICIES_SQL.replace("'YES' AS select_flag,", "'YES' AS select_flag, 'ADMIN' AS pf_owner, CASE WHEN c_nationkey = 0 THEN 'PKG' END AS package, 'FN_' || cast(c_custkey AS STRING) AS function, 'DYNAMIC' AS policy_type,")


def policy_list(spark, folder):
    return access.policy_list(derived(spark, folder, LISTED_SQL, "customer"), _rules(spark, folder))


def policy_refused(spark, folder):
    """What a reader without a rule, with a staged rule and without a login gets; orders show that others are served."""
    reader, out = _reader(spark, folder), []
    for name, login in (("region", "BUILDING"), ("part", "BUILDING"), ("orders", None), ("orders", "BUILDING")):
        try:
            rows = reader.read(name, login).agg(F.count("*").alias("rows"))
            out.append(rows.select(F.lit(name).alias("object"), F.lit(login).cast("string").alias("login"), F.lit("read").alias("outcome"), "rows"))
        except PermissionError:
            count = read_folder(spark, folder, name).agg(F.count("*").alias("rows"))
            out.append(count.select(F.lit(name).alias("object"), F.lit(login).cast("string").alias("login"), F.lit("refused").alias("outcome"), "rows"))
    return union_all(out)


def login_alias_collision(spark, folder):
    logins = derived(
        spark, folder,
        """SELECT cast(c_custkey AS STRING) AS login FROM customer UNION ALL SELECT lpad(cast(s_suppkey AS STRING), 4, '0') AS login
           FROM supplier UNION ALL SELECT c_name AS login FROM customer""",
        "customer", "supplier",
    )
    return access.login_collisions(logins)


def rule_lifecycle(spark, folder):
    """Staged rules are activated, active ones staged again, and the latter deleted."""
    rules = _rules(spark, folder).withColumn("UPDATED_AT", F.lit("old")).withColumn("UPDATED_BY", F.lit("setup"))
    staged = rules.filter("STATE = 'STAGED'").select("OBJECT_NAME")
    active = rules.filter("STATE = 'ACTIVE'").select("OBJECT_NAME")
    moved = access.change_state(rules, active, "STAGED", "admin", F.lit("t1"))
    kept = access.delete_rules(moved, active)
    done = access.change_state(kept, staged, "ACTIVE", "admin", F.lit("t2"))
    return done.select(
        F.col("OBJECT_NAME").alias("object_name"), F.col("STATE").alias("state"), F.col("UPDATED_AT").alias("updated_at"),
        F.col("UPDATED_BY").alias("updated_by"),
    )


def allowlist_check(spark, folder):
    return access.activation_problems(_rules(spark, folder), _policies(spark, folder)).select(
        F.col("OBJECT_NAME").alias("object_name"), "reason"
    )


OBJECT_FILTER = """object_type IN ('TABLE', 'VIEW') AND NOT starts_with(object_name, 'BIN$') AND temporary = 'N'
 AND generated = 'N' AND regexp_matches(object_name, '^[A-Z][A-Z0-9_$#]{0,127}$')"""
DUCK = {
    name: sql.replace("AS STRING", "AS VARCHAR")
    for name, sql in {
        "objects": OBJECTS_SQL, "rules": RULES_SQL, "broken": BROKEN_RULES_SQL, "columns": COLUMNS_SQL, "policies": POLICIES_SQL,
        "grants": GRANTS_SQL, "sys": SYSTEM_SQL, "roles": ROLES_SQL, "schemas": SCHEMAS_SQL,
    }.items()
}
AUDIT_SQL = f"""
sysg AS ({DUCK['sys']}), roleg AS ({DUCK['roles']}), schemag AS ({DUCK['schemas']}), objg AS ({DUCK['grants']}),
rules AS ({DUCK['rules']}),
found AS (
 SELECT DISTINCT grantee, 'privilege ' || privilege AS "check", privilege AS item FROM sysg WHERE privilege <> 'CONNECT'
 UNION SELECT grantee, 'role ' || role, role FROM roleg WHERE role IN ('DBA', 'ADB_DBA')
 UNION SELECT grantee, 'broad schema read', privilege FROM schemag WHERE schema_name = 'ADMIN'
 UNION SELECT grantee, 'unexpected schema privilege', privilege || ' ON SCHEMA ' || schema_name FROM schemag WHERE schema_name <> 'ADMIN'
 UNION SELECT grantee, 'context execute', object_name FROM objg WHERE object_name = 'CTX_PKG'
 UNION SELECT grantee, 'unregistered read', object_name FROM objg WHERE privilege IN ('READ', 'SELECT')
  AND object_name NOT IN (SELECT OBJECT_NAME FROM rules WHERE STATE = 'ACTIVE')),
counts AS (SELECT grantee, "check", count(*) AS findings, string_agg(item, ', ' ORDER BY item) AS items FROM found GROUP BY grantee, "check"),
checks("check", bad, required) AS (VALUES ('privilege CREATE SESSION', '不足', true), ('context execute', '不足', true),
 ('privilege EXEMPT ACCESS POLICY', '危険', false), ('privilege READ ANY TABLE', '危険', false),
 ('privilege SELECT ANY TABLE', '危険', false), ('privilege SELECT ANY DICTIONARY', '危険', false),
 ('privilege CREATE ANY CONTEXT', '危険', false), ('privilege EXECUTE ANY PROCEDURE', '危険', false), ('role DBA', '危険', false),
 ('role ADB_DBA', '危険', false), ('broad schema read', '移行警告', false), ('unexpected schema privilege', '危険', false),
 ('unregistered read', '危険', false)),
audit AS (SELECT c_custkey AS grantee, k."check", CASE WHEN k.required = (coalesce(findings, 0) > 0) THEN 'OK' ELSE bad END AS status,
 coalesce(findings, 0)::BIGINT AS findings, CASE WHEN k."check" IN ('unexpected schema privilege', 'unregistered read') THEN coalesce(items, 'なし')
 WHEN findings > 0 THEN CASE WHEN k."check" = 'broad schema read' THEN '付与あり。テーブル許可リストへの移行が必要です' ELSE '付与あり' END ELSE '付与なし' END AS finding
 FROM customer CROSS JOIN checks k LEFT JOIN counts n ON n.grantee = c_custkey AND n."check" = k."check")"""

QUERIES = {
    "policy_row_match": (policy_row_match, "SELECT * FROM customer WHERE c_mktsegment = 'BUILDING'"),
    "policy_row_match_number": (
        policy_row_match_number,
        """SELECT o_orderkey, o_custkey, o_totalprice, login FROM orders
           JOIN (VALUES ('42', 42), ('0042', 42), ('4e1', 40)) l(login, n) ON o_custkey = n""",
    ),
    "policy_gold_decimal": (policy_gold_decimal, "SELECT o_orderkey, CAST(o_custkey AS DOUBLE) AS o_custkey FROM orders WHERE o_custkey = 42"),
    "policy_relation": (
        policy_relation,
        """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
           WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
    ),
    "policy_and": (
        policy_and,
        """SELECT 'one login' AS "case", 0::BIGINT AS rows UNION ALL SELECT 'two logins', count(*) FROM orders
           JOIN customer ON c_custkey = o_custkey WHERE c_mktsegment = 'BUILDING' AND o_orderstatus = 'F'""",
    ),
    "policy_no_login": (policy_no_login, "SELECT * FROM customer WHERE 1 = 0"),
    "policy_full": (policy_full, "SELECT * FROM supplier"),
    "policy_registry_check": (
        policy_registry_check,
        f"""WITH r AS ({DUCK['broken']}),
        v AS (SELECT *, (RELATION_OBJECT IS NOT NULL)::INT + (RELATION_TARGET_COLUMN IS NOT NULL)::INT
              + (RELATION_OBJECT_COLUMN IS NOT NULL)::INT + (RELATION_MATCH_COLUMN IS NOT NULL)::INT AS rel FROM r)
        SELECT OBJECT_NAME AS "OBJECT_NAME", 'MODE' AS violation FROM v WHERE ACCESS_MODE NOT IN ('FULL', 'ROW_MATCH', 'RELATION_MATCH')
        UNION ALL SELECT OBJECT_NAME, 'STATE' FROM v WHERE STATE NOT IN ('STAGED', 'ACTIVE', 'ERROR')
        UNION ALL SELECT OBJECT_NAME, 'COLUMNS' FROM v WHERE (ACCESS_MODE = 'FULL' AND NOT (MATCH_COLUMN IS NULL AND rel = 0))
          OR (ACCESS_MODE = 'ROW_MATCH' AND NOT (MATCH_COLUMN IS NOT NULL AND rel = 0))
          OR (ACCESS_MODE = 'RELATION_MATCH' AND NOT (MATCH_COLUMN IS NULL AND rel = 4))
        UNION ALL SELECT OBJECT_NAME, 'NAME' FROM v WHERE NOT regexp_matches(OBJECT_NAME, '^[A-Z][A-Z0-9_$#]{{0,127}}$')
        UNION ALL SELECT OBJECT_NAME, 'DUPLICATE' FROM v GROUP BY OBJECT_NAME HAVING count(*) > 1""",
    ),
    "policy_rule_problems": (
        policy_rule_problems,
        f"""WITH r AS ({DUCK['rules']}), o AS (SELECT * FROM ({DUCK['objects']}) WHERE {OBJECT_FILTER}),
        c AS (SELECT *, data_type <> 'NUMBER' OR data_scale IS NULL OR data_scale = 0 AS ok FROM ({DUCK['columns']})
              WHERE data_type IN ('CHAR', 'NCHAR', 'VARCHAR2', 'NVARCHAR2', 'NUMBER') AND hidden = 'NO'),
        p AS ({DUCK['policies']}),
        nested AS (SELECT DISTINCT r.OBJECT_NAME AS n FROM r JOIN p ON p.object_name = r.OBJECT_NAME AND p.policy_name = r.POLICY_NAME
                   WHERE r.ACCESS_MODE = 'RELATION_MATCH' AND p.enabled = 'YES' AND p.policy_group = 'SYS_DEFAULT'),
        x AS (SELECT r.OBJECT_NAME AS object_name, CASE
          WHEN r.ACCESS_MODE = 'ROW_MATCH' AND NOT coalesce(m.ok, false) THEN 'match column not eligible'
          WHEN r.ACCESS_MODE <> 'RELATION_MATCH' THEN NULL
          WHEN coalesce(o.object_type, '-') <> 'TABLE' THEN 'relation is not a table'
          WHEN r.RELATION_OBJECT = r.OBJECT_NAME THEN 'relation is the target itself'
          WHEN t.data_type IS NULL OR k.data_type IS NULL THEN 'key column not eligible'
          WHEN t.data_type <> k.data_type THEN 'key columns differ in type'
          WHEN NOT coalesce(l.ok, false) THEN 'relation match column not eligible'
          WHEN nested.n IS NOT NULL THEN 'relation carries a relation rule' END AS reason
        FROM r LEFT JOIN c m ON m.object_name = r.OBJECT_NAME AND m.column_name = r.MATCH_COLUMN
        LEFT JOIN o ON o.object_name = r.RELATION_OBJECT
        LEFT JOIN c t ON t.object_name = r.OBJECT_NAME AND t.column_name = r.RELATION_TARGET_COLUMN
        LEFT JOIN c k ON k.object_name = r.RELATION_OBJECT AND k.column_name = r.RELATION_OBJECT_COLUMN
        LEFT JOIN c l ON l.object_name = r.RELATION_OBJECT AND l.column_name = r.RELATION_MATCH_COLUMN
        LEFT JOIN nested ON nested.n = r.RELATION_OBJECT)
        SELECT * FROM x WHERE reason IS NOT NULL""",
    ),
    "eligible_columns": (
        eligible_columns,
        f"""WITH c AS ({DUCK['columns']}) SELECT data_type,
            nullif(count(*) FILTER (data_type <> 'NUMBER' OR data_scale IS NULL OR data_scale = 0), 0) AS match_columns,
            count(*) AS relation_columns FROM c
            WHERE data_type IN ('CHAR', 'NCHAR', 'VARCHAR2', 'NVARCHAR2', 'NUMBER') AND hidden = 'NO' GROUP BY data_type""",
    ),
    "object_filter": (
        object_filter,
        f"""WITH o AS ({DUCK['objects']}) SELECT object_type, count(*) AS rows FROM o WHERE {OBJECT_FILTER} GROUP BY object_type
            UNION ALL SELECT 'listed', count(*) FROM o WHERE NOT contains(object_name, '$')""",
    ),
    "policy_inventory": (
        policy_inventory,
        f"""WITH o AS (SELECT * FROM ({DUCK['objects']}) WHERE {OBJECT_FILTER}), r AS ({DUCK['rules']}), p AS ({DUCK['policies']}),
        g AS (SELECT DISTINCT object_name FROM ({DUCK['grants']}) WHERE privilege IN ('READ', 'SELECT')),
        t AS (SELECT p.object_name, count(*) FILTER (NOT m) AS bad, bool_or(m AND enabled = 'YES') AS on_ FROM
              (SELECT p.*, coalesce(policy_group = 'SYS_DEFAULT' AND p.policy_name = r.POLICY_NAME, false) AS m
               FROM p LEFT JOIN r ON r.OBJECT_NAME = p.object_name) p GROUP BY p.object_name),
        j AS (SELECT o.object_name, o.object_type, r.*, coalesce(t.bad, 0) AS bad, coalesce(t.on_, false) AS on_,
              g.object_name IS NOT NULL AS rd, r.OBJECT_NAME IS NOT NULL AS ruled
              FROM o LEFT JOIN r ON r.OBJECT_NAME = o.object_name LEFT JOIN t ON t.object_name = o.object_name
              LEFT JOIN g ON g.object_name = o.object_name)
        SELECT object_name, object_type,
          CASE WHEN bad > 0 THEN '競合' WHEN ruled AND ACCESS_MODE = 'FULL' AND rd THEN 'すべての行の参照を許可'
               WHEN ruled AND ACCESS_MODE = 'ROW_MATCH' AND rd AND on_ THEN 'ログインユーザーの行のみ'
               WHEN ruled AND ACCESS_MODE = 'RELATION_MATCH' AND rd AND on_ THEN '関連テーブルで判定'
               WHEN NOT ruled AND rd THEN '未登録のREAD付与' ELSE '参照を許可しない' END AS access,
          CASE WHEN bad > 0 OR NOT ruled OR ACCESS_MODE = 'FULL' THEN '-' WHEN ACCESS_MODE = 'ROW_MATCH' THEN 'LOGIN=LOGIN_USER'
               ELSE 'KEY_ID ← ' || RELATION_OBJECT || '.KEY_ID / LOGIN=LOGIN_USER' END AS "condition",
          CASE WHEN bad > 0 THEN '競合（' || bad || '件）'
               WHEN ruled AND ACCESS_MODE <> 'FULL' AND STATE = 'ACTIVE' AND NOT (rd AND on_) THEN 'ドリフト'
               WHEN ruled THEN STATE WHEN rd THEN 'ドリフト' ELSE '-' END AS state,
          CASE WHEN bad > 0 THEN '未登録Policyがあり、Oracleでは他PolicyとAND結合されます。高度な操作から個別に削除できます'
               WHEN ruled AND ACCESS_MODE <> 'FULL' AND STATE = 'ACTIVE' AND NOT (rd AND on_)
               THEN 'ACTIVE登録と実際のREAD/Policy状態が一致しません' WHEN ruled THEN '-'
               WHEN rd THEN '台帳にない直接READ/SELECT権限があります' ELSE '-' END AS exception FROM j""",
    ),
    "effective_audit": (effective_audit, EFFECTIVE_SQL),
    "policy_list": (
        policy_list,
        f"""WITH p AS ({LISTED_SQL.replace("AS STRING", "AS VARCHAR")}), r AS ({DUCK['rules']}),
        j AS (SELECT p.*, coalesce(policy_group = 'SYS_DEFAULT' AND p.policy_name = r.POLICY_NAME, false) AS own FROM p LEFT JOIN r ON r.OBJECT_NAME = p.object_name)
        SELECT object_name, policy_name, policy_group, 'ADMIN.' || CASE WHEN package IS NULL THEN '' ELSE 'PKG.' END || "function" AS "function", enabled, policy_type,
        CASE WHEN own THEN '管理対象' ELSE '参照のみ・競合' END AS state, CASE WHEN own THEN '-' ELSE '未登録Policyです。高度な操作から削除できます' END AS remark FROM j""",
    ),
    "policy_refused": (
        policy_refused,
        """SELECT 'region' AS object, 'BUILDING' AS login, 'refused' AS outcome, count(*) AS rows FROM region UNION ALL SELECT 'part', 'BUILDING', 'refused', count(*) FROM part
        UNION ALL SELECT 'orders', NULL, 'read', 0 UNION ALL
        SELECT 'orders', 'BUILDING', 'read', count(*) FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
    ),
    "policy_attributes": (
        policy_attributes,
        """SELECT upper(c_name) AS object_name, 'POL_' || c_custkey AS policy_name, 'SYS_DEFAULT' AS policy_group,
           CASE WHEN c_nationkey = 0 THEN 'PKG' ELSE '-' END AS package, coalesce(s_name, '-') AS namespace,
           CASE WHEN s_name IS NULL THEN '-' ELSE 'LOGIN' END AS attribute FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey""",
    ),
    "collected_privileges": (
        collected_privileges,
        f"""SELECT object_name, string_agg(DISTINCT privilege, ',' ORDER BY privilege) AS privileges FROM ({DUCK['grants']})
            WHERE privilege IN ('READ', 'SELECT') GROUP BY object_name""",
    ),
    "privilege_audit": (privilege_audit, f"WITH {AUDIT_SQL} SELECT * FROM audit"),
    "severity_rollup": (
        severity_rollup,
        f"""WITH {AUDIT_SQL} SELECT grantee, CASE WHEN bool_or(status = '危険') THEN 'error'
            WHEN bool_or(status IN ('不足', '移行警告')) THEN 'warning' ELSE 'ok' END AS verdict FROM audit GROUP BY grantee""",
    ),
    "unexpected_grants": (
        unexpected_grants,
        f"SELECT privilege, count(*) AS rows FROM ({DUCK['grants']}) WHERE privilege = 'DELETE' GROUP BY privilege",
    ),
    "login_alias_collision": (
        login_alias_collision,
        """WITH l AS (SELECT c_custkey::VARCHAR AS login FROM customer UNION SELECT lpad(s_suppkey::VARCHAR, 4, '0') FROM supplier)
           SELECT regexp_replace(login, '^0+(.)', '\\1') AS number, count(*) AS logins, string_agg(login, '/' ORDER BY login) AS names
           FROM l GROUP BY 1 HAVING count(*) > 1""",
    ),
    "rule_lifecycle": (
        rule_lifecycle,
        f"""SELECT OBJECT_NAME AS object_name, CASE STATE WHEN 'STAGED' THEN 'ACTIVE' ELSE STATE END AS state,
            CASE STATE WHEN 'STAGED' THEN 't2' ELSE 'old' END AS updated_at, CASE STATE WHEN 'STAGED' THEN 'admin' ELSE 'setup' END AS updated_by
            FROM ({DUCK['rules']}) WHERE STATE <> 'ACTIVE'""",
    ),
    "allowlist_check": (
        allowlist_check,
        f"""WITH r AS ({DUCK['rules']}), p AS ({DUCK['policies']}),
        j AS (SELECT r.OBJECT_NAME AS object_name, r.ACCESS_MODE AS mode,
              count(*) FILTER (p.object_name IS NOT NULL AND NOT (policy_group = 'SYS_DEFAULT' AND p.policy_name = r.POLICY_NAME)) AS bad,
              bool_or(coalesce(policy_group = 'SYS_DEFAULT' AND p.policy_name = r.POLICY_NAME AND enabled = 'YES', false)) AS on_
              FROM r LEFT JOIN p ON p.object_name = r.OBJECT_NAME WHERE r.STATE = 'ACTIVE' GROUP BY ALL)
        SELECT object_name, CASE WHEN bad > 0 THEN 'unregistered policy' ELSE 'policy is not enabled' END AS reason FROM j
        WHERE bad > 0 OR (mode <> 'FULL' AND NOT on_)""",
    ),
}
