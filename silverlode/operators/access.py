"""Row-level access rules.

A rule becomes a filter or a semi-join on the scan of the table it protects, so Catalyst pushes it like any other
predicate. The login is an argument of the read: a DataFrame belongs to the login it was built for.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, fields
from decimal import Decimal, InvalidOperation
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.functions.text import OBJECT_NAME, is_object_name
from silverlode.operators.skew import match, match_keys
from silverlode.session import work_folder
from silverlode.sources.tables import RULE_TEST_RESULT_CAP

NONE, FULL, ROW_MATCH, RELATION_MATCH = "NONE", "FULL", "ROW_MATCH", "RELATION_MATCH"
STAGED, ACTIVE, ERROR = "STAGED", "ACTIVE", "ERROR"
MODES = (FULL, ROW_MATCH, RELATION_MATCH)
STATES = (STAGED, ACTIVE, ERROR)
FILTERED = (ROW_MATCH, RELATION_MATCH)

# Labels and remarks of the access inventory.
MODE_LABELS = {
    NONE: "参照を許可しない",
    FULL: "すべての行の参照を許可",
    ROW_MATCH: "ログインユーザーの行のみ",
    RELATION_MATCH: "関連テーブルで判定",
}
LABEL_CONFLICT = "競合"
LABEL_UNMANAGED = "未管理・全行参照（移行前）"
LABEL_UNREGISTERED = "未登録のREAD付与"
STATE_DRIFT = "ドリフト"
STATE_MIGRATE = "移行必要"
NOTE_CONFLICT = "未登録Policyがあり、Oracleでは他PolicyとAND結合されます。高度な操作から個別に削除できます"
NOTE_DRIFT = "ACTIVE登録と実際のREAD/Policy状態が一致しません"
NOTE_MIGRATE = "許可リスト移行後はアクセス不可になります"
NOTE_UNREGISTERED = "台帳にない直接READ/SELECT権限があります"

# Audit states and their severity.
OK, MISSING, DANGEROUS, MIGRATION = "OK", "不足", "危険", "移行警告"
ERROR_STATES = ["エラー", "非対応", "利用不可", "危険"]
WARNING_STATES = ["不足", "未作成", "未インストール", "更新必要", "未確認", "未設定", "移行警告", "PoC警告", "高リスク警告"]

# Privileges and roles that a restricted user must not hold.
DANGEROUS_PRIVILEGES = [
    "EXEMPT ACCESS POLICY",
    "READ ANY TABLE",
    "SELECT ANY TABLE",
    "SELECT ANY DICTIONARY",
    "CREATE ANY CONTEXT",
    "EXECUTE ANY PROCEDURE",
]
DANGEROUS_ROLES = ["DBA", "ADB_DBA"]
BROAD_READS = ["READ ANY TABLE", "SELECT ANY TABLE"]
# Texts of findings, checks of a session's rights, and what the list of policies says.
FINDING_GRANTED, FINDING_NOT_GRANTED, FINDING_NONE = "付与あり", "付与なし", "なし"
FINDING_BROAD, FINDING_BROAD_EFFECTIVE = "付与あり。テーブル許可リストへの移行が必要です", "有効。テーブル許可リストへの移行が必要です"
EFFECTIVE_CHECKS = [
    "実行セッションの危険な有効権限",
    "実行セッションのADMIN schema全表読取",
    "実行セッションの想定外Schema権限",
    "実行セッションの想定外オブジェクト権限",
]
MANAGED, FOREIGN = "管理対象", "参照のみ・競合"
NOTE_FOREIGN = "未登録Policyです。高度な操作から削除できます"
CHARACTER_TYPES = ["CHAR", "NCHAR", "VARCHAR2", "NVARCHAR2"]


# -- rules ---------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """One row of the rule registry."""

    object_name: str
    object_type: str
    access_mode: str
    match_column: str | None = None
    relation_object: str | None = None
    relation_target_column: str | None = None
    relation_object_column: str | None = None
    relation_match_column: str | None = None
    policy_name: str | None = None
    function_name: str | None = None
    state: str = ACTIVE

    def __post_init__(self) -> None:
        relation = [
            self.relation_object,
            self.relation_target_column,
            self.relation_object_column,
            self.relation_match_column,
        ]
        if self.access_mode not in MODES:
            raise ValueError(f"access mode: {self.access_mode}")
        if self.state not in STATES:
            raise ValueError(f"state: {self.state}")
        if bool(self.match_column) != (self.access_mode == ROW_MATCH):
            raise ValueError(f"{self.access_mode}: match column")
        if self.access_mode == RELATION_MATCH and not all(relation):
            raise ValueError(f"{self.access_mode}: relation columns missing")
        if self.access_mode != RELATION_MATCH and any(relation):
            raise ValueError(f"{self.access_mode}: relation columns not allowed")

    @classmethod
    def from_row(cls, row: Sequence) -> Rule:
        """Registries of three ages: 3 columns (active by definition), 7 columns (no relation), 11 columns."""
        values = [None if v in (None, "") else str(v) for v in row]
        if len(values) == 3:
            return cls(*values)
        if len(values) == 7:
            return cls(*values[:4], policy_name=values[4], function_name=values[5], state=values[6])
        if len(values) == len(fields(cls)):
            return cls(*values)
        raise ValueError("unknown registry layout")


REGISTRY_COLUMNS = [f.name.upper() for f in fields(Rule)]


def login_number(login: str) -> int | None:
    """The login as an integer; NULL when it is not a number or not a whole one."""
    text = login.strip()
    if not re.fullmatch(r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d{1,3})?", text):
        return None
    try:
        number = Decimal(text)
    except InvalidOperation:
        return None
    return int(number) if number == number.to_integral_value() else None


def matches_login(df: DataFrame, column: str, login: str | None) -> Column:
    """The predicate for a login, with a literal of the column's own type so that it is pushed down."""
    if not login:
        return F.lit(False)
    dtype = df.schema[column].dataType
    if isinstance(dtype, T.StringType):
        return F.col(column) == F.lit(login)
    bits = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}
    number = login_number(login)
    if type(dtype) in bits:
        half = 1 << (bits[type(dtype)] - 1)
        fits = number is not None and -half <= number < half
        return F.col(column) == F.lit(number).cast(dtype) if fits else F.lit(False)
    if isinstance(dtype, T.DecimalType):
        if number is None or abs(number) >= 10 ** (dtype.precision - dtype.scale):
            return F.lit(False)
        return F.col(column) == F.lit(Decimal(number)).cast(dtype)
    raise ValueError(f"{column}: a match column is text, a whole number or a decimal")


def apply_rule(df: DataFrame, rule: Rule, login: str | None, relation: DataFrame | None = None) -> DataFrame:
    """The rows that the login may see.

    The relation is filtered by the login before the semi-join; whether it is then broadcast is left to its size.
    """
    if rule.access_mode == FULL:
        return df
    if rule.access_mode == ROW_MATCH:
        return df.filter(matches_login(df, rule.match_column, login))
    if relation is None:
        raise ValueError(f"relation {rule.relation_object} is needed")
    keys = relation.filter(matches_login(relation, rule.relation_match_column, login)).select(
        F.col(rule.relation_object_column).alias("key__")
    )
    keys = keys.distinct()  # a hot key is a row per task
    return df.join(keys, match_keys(df, keys, [(rule.relation_target_column, "key__")]), "left_semi")


@dataclass(frozen=True)
class GuardedReader:
    """The only way to the tables for restricted users. No ACTIVE rule → no access."""

    tables: Mapping[str, DataFrame]
    rules: Sequence[Rule]

    def read(self, name: str, login: str | None) -> DataFrame:
        wanted = name.strip().upper()
        active = [r for r in self.rules if r.object_name.upper() == wanted and r.state == ACTIVE]
        if not active:
            raise PermissionError(f"{name}: no active access rule")
        by_name = {k.upper(): v for k, v in self.tables.items()}
        rows = by_name[wanted]
        for rule in active:  # several rules combine with AND
            relation = by_name.get(rule.relation_object.upper()) if rule.relation_object else None
            rows = apply_rule(rows, rule, login, relation)
        return rows

    def trial(self, name: str, login: str | None) -> DataFrame:
        """What is shown when a rule is tried out."""
        return self.read(name, login).limit(RULE_TEST_RESULT_CAP)


# -- the registry as a table ---------------------------------------------------------------------------------------


def registry_violations(rules: DataFrame) -> DataFrame:
    """One row per broken constraint of a registry table."""
    relation = ["RELATION_OBJECT", "RELATION_TARGET_COLUMN", "RELATION_OBJECT_COLUMN", "RELATION_MATCH_COLUMN"]
    any_relation = F.coalesce(*[F.col(c) for c in relation]).isNotNull()
    every_relation = F.lit(True)
    for c in relation:
        every_relation = every_relation & F.col(c).isNotNull()
    match = F.col("MATCH_COLUMN").isNotNull()
    mode = F.col("ACCESS_MODE")
    consistent = (
        F.when(mode == FULL, ~match & ~any_relation)
        .when(mode == ROW_MATCH, match & ~any_relation)
        .when(mode == RELATION_MATCH, ~match & every_relation)
        .otherwise(True)
    )
    problems = F.array(
        F.when(~F.coalesce(mode.isin(*MODES), F.lit(False)), "MODE"),
        F.when(~F.coalesce(F.col("STATE").isin(*STATES), F.lit(False)), "STATE"),
        F.when(~consistent, "COLUMNS"),
        F.when(~is_object_name(F.col("OBJECT_NAME")), "NAME"),
    )
    broken = rules.select("OBJECT_NAME", F.explode(F.filter(problems, lambda p: p.isNotNull())).alias("violation"))
    twice = rules.groupBy("OBJECT_NAME").agg(F.count("*").alias("n")).filter("n > 1")
    return broken.unionByName(twice.select("OBJECT_NAME", F.lit("DUPLICATE").alias("violation")))


def business_objects(objects: DataFrame, registry_table: str) -> DataFrame:
    """tables and views a rule may protect. Columns: object_name, object_type, temporary, generated, secondary, and, if
    the catalog has them, oracle_maintained and subobject_name (objects of the system and parts of objects are none)."""
    name = F.col("object_name")
    if "oracle_maintained" in objects.columns:
        objects = objects.filter(F.coalesce("oracle_maintained", F.lit("N")) != "Y")
    if "subobject_name" in objects.columns:
        objects = objects.filter(F.col("subobject_name").isNull())
    return objects.filter(
        F.col("object_type").isin("TABLE", "VIEW")
        & ~name.startswith("BIN$")
        & ~name.startswith("VECTOR$")
        & (F.col("temporary") == "N")
        & (F.col("generated") == "N")
        & (F.col("secondary") == "N")
        & (name != registry_table)
        & name.rlike(OBJECT_NAME)
    )


def listed_tables(objects: DataFrame) -> DataFrame:
    """F07, the looser rule of the table lists: no ``$`` in the name."""
    return objects.filter(~F.col("object_name").contains("$"))


def _relation_column() -> Column:
    return (
        F.col("data_type").isin(*CHARACTER_TYPES, "NUMBER")
        & (F.col("hidden") == "NO")
        & F.col("column_name").rlike(OBJECT_NAME)
    )


def _whole_number() -> Column:
    return F.col("data_scale").isNull() | (F.col("data_scale") == 0)


def relation_columns(columns: DataFrame) -> DataFrame:
    """F08 for relation keys: text or NUMBER of any scale."""
    return columns.filter(_relation_column())


def match_columns(columns: DataFrame) -> DataFrame:
    """F08 for match columns: text, or NUMBER without decimals."""
    return columns.filter(_relation_column() & ((F.col("data_type") != "NUMBER") | _whole_number()))


def rule_problems(rules: DataFrame, objects: DataFrame, columns: DataFrame, policies: DataFrame) -> DataFrame:
    """Rules that do not fit the catalog, with the first reason that applies.

    ``objects``: object_name, object_type. ``columns``: object_name, column_name, data_type, data_scale, hidden.
    ``policies``: object_name, policy_name, policy_group, select_flag, enabled. Equi-joins on names only.
    """
    usable = relation_columns(columns).select(
        "object_name", "column_name", "data_type", ((F.col("data_type") != "NUMBER") | _whole_number()).alias("eligible")
    )

    def side(prefix: str) -> DataFrame:
        return usable.select(*[F.col(c).alias(f"{prefix}_{c}") for c in usable.columns])

    def attach(df: DataFrame, prefix: str, object_column: str, column: str) -> DataFrame:
        other = side(prefix)
        on = (F.col(object_column) == F.col(f"{prefix}_object_name")) & (F.col(column) == F.col(f"{prefix}_column_name"))
        return df.join(other, on, "left")

    nested = (
        rules.filter(F.col("ACCESS_MODE") == RELATION_MATCH)
        .select(F.col("OBJECT_NAME").alias("nested_name"), F.col("POLICY_NAME").alias("nested_policy"))
        .join(
            policies.filter("enabled = 'YES' AND policy_group = 'SYS_DEFAULT'"),
            (F.col("nested_name") == F.col("object_name")) & (F.col("nested_policy") == F.col("policy_name")),
            "left_semi",
        )
        .select("nested_name")
        .distinct()
    )
    tables = objects.select(F.col("object_name").alias("r_object"), F.col("object_type").alias("r_type"))
    checked = attach(rules, "m", "OBJECT_NAME", "MATCH_COLUMN")
    checked = attach(checked, "t", "OBJECT_NAME", "RELATION_TARGET_COLUMN")
    checked = attach(checked, "o", "RELATION_OBJECT", "RELATION_OBJECT_COLUMN")
    checked = attach(checked, "l", "RELATION_OBJECT", "RELATION_MATCH_COLUMN")
    checked = checked.join(tables, F.col("RELATION_OBJECT") == F.col("r_object"), "left")
    checked = checked.join(nested, match([F.col("RELATION_OBJECT")], [F.col("nested_name")]), "left")
    row, relation = F.col("ACCESS_MODE") == ROW_MATCH, F.col("ACCESS_MODE") == RELATION_MATCH
    reason = (
        F.when(row & ~F.coalesce(F.col("m_eligible"), F.lit(False)), "match column not eligible")
        .when(relation & ~F.coalesce(F.col("r_type") == "TABLE", F.lit(False)), "relation is not a table")
        .when(relation & (F.col("RELATION_OBJECT") == F.col("OBJECT_NAME")), "relation is the target itself")
        .when(relation & (F.col("t_data_type").isNull() | F.col("o_data_type").isNull()), "key column not eligible")
        .when(relation & (F.col("t_data_type") != F.col("o_data_type")), "key columns differ in type")
        .when(relation & ~F.coalesce(F.col("l_eligible"), F.lit(False)), "relation match column not eligible")
        .when(relation & F.col("nested_name").isNotNull(), "relation carries a relation rule")
    )
    return checked.withColumn("reason", reason).filter("reason IS NOT NULL").select("OBJECT_NAME", "ACCESS_MODE", "reason")


# Allowed changes of a rule's state.
TRANSITIONS = {STAGED: (ACTIVE, ERROR), ACTIVE: (STAGED, ERROR), ERROR: (STAGED,)}


def change_state(rules: DataFrame, names: DataFrame, state: str, user: str, at: Column | None = None) -> DataFrame:
    """Move the named rules to a state; a move that the lifecycle does not know stops the job."""
    wanted = names.select(F.col("OBJECT_NAME").alias("name__")).distinct()
    allowed = [old for old, new in TRANSITIONS.items() if state in new]
    hit = F.col("name__").isNotNull()
    legal = F.when(hit & ~F.col("STATE").isin(*allowed), F.raise_error(F.concat(F.lit("not allowed from "), F.col("STATE"))).cast("boolean"))
    return (
        rules.join(wanted, F.col("OBJECT_NAME") == F.col("name__"), "left")
        .filter(F.coalesce(legal, F.lit(True)))
        .select(
            *[F.col(c) for c in rules.columns if c not in ("STATE", "UPDATED_AT", "UPDATED_BY")],
            F.when(hit, F.lit(state)).otherwise(F.col("STATE")).alias("STATE"),
            F.when(hit, at if at is not None else F.current_timestamp()).otherwise(F.col("UPDATED_AT")).alias("UPDATED_AT"),
            F.when(hit, F.lit(user)).otherwise(F.col("UPDATED_BY")).alias("UPDATED_BY"),
        )
    )


def delete_rules(rules: DataFrame, names: DataFrame) -> DataFrame:
    """A rule may be deleted once it is staged again."""
    wanted = names.select(F.col("OBJECT_NAME").alias("name__")).distinct()
    joined = rules.join(wanted, F.col("OBJECT_NAME") == F.col("name__"), "left")
    refuse = F.raise_error(F.lit("stage the rule before deleting it")).cast("boolean")
    keep = F.when(F.col("name__").isNull(), True).when(F.col("STATE") != STAGED, refuse).otherwise(False)
    return joined.filter(keep).drop("name__")


def policies_with_attributes(policies: DataFrame, attributes: DataFrame) -> DataFrame:
    """The four-key left join; missing names are shown as ``-``."""
    keys = ["object_owner", "object_name", "policy_group", "policy_name"]
    joined = policies.join(attributes, keys, "left")
    return joined.select(
        "object_name",
        "policy_name",
        "policy_group",
        F.coalesce("package", F.lit("-")).alias("package"),
        F.coalesce("namespace", F.lit("-")).alias("namespace"),
        F.coalesce("attribute", F.lit("-")).alias("attribute"),
    )


def collected_privileges(grants: DataFrame, grantee: str | None = None) -> DataFrame:
    """The set of read privileges per object."""
    rows = grants.filter(F.col("privilege").isin("READ", "SELECT"))
    if grantee is not None:
        rows = rows.filter(F.col("grantee") == grantee)
    return rows.groupBy("object_name").agg(F.sort_array(F.collect_set(F.upper("privilege"))).alias("privileges"))


def access_inventory(
    objects: DataFrame, rules: DataFrame, policies: DataFrame, reads: DataFrame, broad_read: bool, problems: DataFrame | None = None
) -> DataFrame:
    """Per object its label, condition, state and remark.

    Policies and grants are reduced to one row per object before the joins, so no join multiplies rows.
    """
    ours = rules.select(*[F.col(c).alias(f"rule_{c.lower()}") for c in REGISTRY_COLUMNS])
    enabled_select = policies.filter("select_flag = 'YES'")
    tagged = enabled_select.join(ours, F.col("object_name") == F.col("rule_object_name"), "left").withColumn(
        "managed",
        F.coalesce(
            (F.upper("policy_group") == "SYS_DEFAULT") & (F.col("policy_name") == F.col("rule_policy_name")), F.lit(False)
        ),
    )
    per_object = tagged.groupBy(F.col("object_name").alias("p_object")).agg(
        F.count_distinct(F.when(~F.col("managed"), F.col("policy_name"))).alias("unmanaged"),  # a policy may have several rows
        F.bool_or(F.col("managed") & (F.upper("enabled") == "YES")).alias("policy_on"),
    )
    readable = reads.select(F.col("object_name").alias("g_object")).distinct()
    joined = (
        objects.select("object_name", "object_type")
        .join(ours, F.col("object_name") == F.col("rule_object_name"), "left")
        .join(per_object, F.col("object_name") == F.col("p_object"), "left")
        .join(readable, F.col("object_name") == F.col("g_object"), "left")
    )
    problem = F.lit(None).cast("string")
    if problems is not None:
        reasons = problems.groupBy(F.col("OBJECT_NAME").alias("x_object")).agg(F.min("reason").alias("x_reason"))
        joined = joined.join(reasons, F.col("object_name") == F.col("x_object"), "left")
        problem = F.when(F.col("rule_access_mode") == RELATION_MATCH, F.col("x_reason"))
    may_read = F.lit(broad_read) | F.col("g_object").isNotNull()
    mode = F.col("rule_access_mode")
    unmanaged = F.coalesce("unmanaged", F.lit(0))
    has_rule = F.col("rule_object_name").isNotNull()
    effective = F.when(mode == FULL, may_read).otherwise(may_read & F.coalesce("policy_on", F.lit(False)))
    label_of = F.lit(None).cast("string")
    for m in MODES:
        label_of = F.when(mode == m, MODE_LABELS[m]).otherwise(label_of)
    drift = mode.isin(*FILTERED) & ~effective & (F.col("rule_state") == ACTIVE)
    condition = (
        F.when(mode == ROW_MATCH, F.concat(F.col("rule_match_column"), F.lit("=LOGIN_USER")))
        .when(
            mode == RELATION_MATCH,
            F.concat(
                F.col("rule_relation_target_column"), F.lit(" ← "), F.col("rule_relation_object"), F.lit("."),
                F.col("rule_relation_object_column"), F.lit(" / "), F.col("rule_relation_match_column"), F.lit("=LOGIN_USER"),
            ),
        )
        .otherwise("-")
    )
    return joined.select(
        "object_name",
        "object_type",
        F.when(unmanaged > 0, LABEL_CONFLICT)
        .when(has_rule & effective, label_of)
        .when(has_rule, MODE_LABELS[NONE])
        .when(F.lit(broad_read), LABEL_UNMANAGED)
        .when(F.col("g_object").isNotNull(), LABEL_UNREGISTERED)
        .otherwise(MODE_LABELS[NONE])
        .alias("access"),
        F.when((unmanaged == 0) & has_rule, condition).otherwise("-").alias("condition"),
        F.when(unmanaged > 0, F.concat(F.lit("競合（"), unmanaged.cast("string"), F.lit("件）")))
        .when(has_rule & (drift | problem.isNotNull()), STATE_DRIFT)
        .when(has_rule, F.col("rule_state"))
        .when(F.lit(broad_read), STATE_MIGRATE)
        .when(F.col("g_object").isNotNull(), STATE_DRIFT)
        .otherwise("-")
        .alias("state"),
        F.when(unmanaged > 0, NOTE_CONFLICT)
        .when(has_rule & problem.isNotNull(), problem)
        .when(has_rule & drift, NOTE_DRIFT)
        .when(has_rule, "-")
        .when(F.lit(broad_read), NOTE_MIGRATE)
        .when(F.col("g_object").isNotNull(), NOTE_UNREGISTERED)
        .otherwise("-")
        .alias("exception"),
    )


def unexpected_grants(grants: DataFrame, owner: str, registry_table: str, context_package: str) -> DataFrame:
    """Object grants that a restricted user should not hold."""
    read = (F.col("owner") == owner) & (F.col("object_name") != registry_table) & F.col("privilege").isin("READ", "SELECT")
    context = (
        (F.col("owner") == owner) & (F.col("object_name") == context_package) & (F.col("privilege") == "EXECUTE")
    )
    return grants.filter(~F.coalesce(read | context, F.lit(False)))


def unregistered_reads(grants: DataFrame, rules: DataFrame) -> DataFrame:
    """Reads of objects without an ACTIVE rule."""
    active = rules.filter(F.col("STATE") == ACTIVE).select(F.col("OBJECT_NAME").alias("known__"))
    reads = grants.filter(F.col("privilege").isin("READ", "SELECT"))
    return reads.join(active, F.col("object_name") == F.col("known__"), "left_anti")


def privilege_audit(
    users: DataFrame, system: DataFrame, roles: DataFrame, schemas: DataFrame, objects: DataFrame, rules: DataFrame,
    owner: str, context_package: str,
) -> DataFrame:
    """For every user the checks with their status, the number of findings, and what was found as text.

    ``users``: grantee. ``system``: grantee, privilege. ``roles``: grantee, role. ``schemas``: grantee, privilege,
    schema_name. ``objects``: grantee, owner, object_name, privilege. The grants are turned into (grantee, check)
    marks and counted once; a user's checks are then read from one row per user.
    """
    broad = F.col("privilege").isin(*BROAD_READS) & (F.col("schema_name") == owner)
    marks = [
        system.filter(F.col("privilege").isin("CREATE SESSION", *DANGEROUS_PRIVILEGES)).select(
            "grantee", F.concat(F.lit("privilege "), F.col("privilege")).alias("check"), F.col("privilege").alias("item")
        ),
        roles.filter(F.col("role").isin(*DANGEROUS_ROLES)).select(
            "grantee", F.concat(F.lit("role "), F.col("role")).alias("check"), F.col("role").alias("item")
        ),
        schemas.filter(broad).select("grantee", F.lit("broad schema read").alias("check"), F.col("privilege").alias("item")),
        schemas.filter(~broad).select(
            "grantee",
            F.lit("unexpected schema privilege").alias("check"),
            F.concat_ws(" ON SCHEMA ", "privilege", "schema_name").alias("item"),
        ),
        objects.filter(
            (F.col("owner") == owner) & (F.col("object_name") == context_package) & (F.col("privilege") == "EXECUTE")
        ).select("grantee", F.lit("context execute").alias("check"), F.col("object_name").alias("item")),
        unregistered_reads(objects.filter(F.col("owner") == owner), rules).select(
            "grantee", F.lit("unregistered read").alias("check"), F.col("object_name").alias("item")
        ),
    ]
    found = marks[0]
    for mark in marks[1:]:
        found = found.unionByName(mark)
    listed_items = F.expr("listagg(item, ', ') WITHIN GROUP (ORDER BY item)").alias("items")
    counts = found.distinct().groupBy(F.col("grantee").alias("u__"), F.col("check").alias("c__")).agg(F.count("*").alias("findings"), listed_items)
    checks = [
        ("privilege CREATE SESSION", MISSING, True),
        ("context execute", MISSING, True),
        *[(f"privilege {p}", DANGEROUS, False) for p in DANGEROUS_PRIVILEGES],
        *[(f"role {r}", DANGEROUS, False) for r in DANGEROUS_ROLES],
        ("broad schema read", MIGRATION, False),
        ("unexpected schema privilege", DANGEROUS, False),
        ("unregistered read", DANGEROUS, False),
    ]
    listed = F.explode(
        F.array(*[F.struct(F.lit(c).alias("check"), F.lit(s).alias("bad"), F.lit(r).alias("required")) for c, s, r in checks])
    )
    expected = users.select("grantee").distinct().select("grantee", listed.alias("c")).select("grantee", "c.*")
    joined = expected.join(counts, (F.col("grantee") == F.col("u__")) & (F.col("check") == F.col("c__")), "left")
    n = F.coalesce("findings", F.lit(0))
    lists = F.col("check").isin("unexpected schema privilege", "unregistered read")
    granted = F.when(F.col("check") == "broad schema read", FINDING_BROAD).otherwise(FINDING_GRANTED)
    return joined.select(
        "grantee",
        "check",
        F.when(F.col("required") == (n > 0), OK).otherwise(F.col("bad")).alias("status"),
        n.alias("findings"),
        F.when(lists, F.coalesce("items", F.lit(FINDING_NONE))).when(n > 0, granted).otherwise(FINDING_NOT_GRANTED).alias("finding"),
    )


def reachable_roles(users: DataFrame, roles: DataFrame) -> DataFrame:
    """(``user``, ``holder``): each user and every role held directly or through other roles, as text.

    ``users``: grantee. ``roles``: grantee (a user or a role), role. A round adds the roles of the roles found last, until
    nothing is new, so grants that form a circle end. Each round is a join that can split a role which many users hold.
    """
    spark = users.sparkSession
    folder = work_folder(spark, "roles")
    grants = roles.select(F.col("grantee").cast("string").alias("from__"), F.col("role").cast("string").alias("to__")).where("from__ IS NOT NULL AND to__ IS NOT NULL").distinct()
    newest = users.select(F.col("grantee").cast("string").alias("user")).where("user IS NOT NULL").distinct().withColumn("holder", F.col("user"))
    schema, number = "user string, holder string", 0
    while True:
        newest.write.parquet(f"{folder}/{number:05d}")
        newest = spark.read.schema(schema).parquet(f"{folder}/{number:05d}")
        known = spark.read.schema(schema).parquet(f"{folder}/*")
        if newest.isEmpty():
            return known
        number += 1
        found = newest.join(grants, match([newest["holder"]], [grants["from__"]])).select("user", F.col("to__").alias("holder")).distinct()
        newest = found.join(known.toDF("u__", "h__"), match([found["user"], found["holder"]], [F.col("u__"), F.col("h__")]), "left_anti")


def effective_audit(
    users: DataFrame, system: DataFrame, roles: DataFrame, schemas: DataFrame, objects: DataFrame, owner: str, registry_table: str, context_package: str,
) -> DataFrame:
    """What a session of each user may do in the end, in four checks with status and findings as text.

    Tables as for ``privilege_audit``, but a grantee may be a role: rights count that a user or any reachable role holds.
    Object rights are as expected only where the user's own: reading the owner's tables but the registry, and the context.
    """
    held = reachable_roles(users, roles)

    def through(grants: DataFrame, check: str, item: Column, where: Column) -> DataFrame:
        rows = grants.where(where).select(F.col("grantee").cast("string").alias("g__"), F.struct(*[F.col(c) for c in grants.columns]).alias("r__"))
        joined = held.join(rows, match([held["holder"]], [rows["g__"]])).select("user", "holder", "r__.*")
        return joined.select("user", F.lit(check).alias("check"), item.alias("item"))

    broad = F.col("privilege").isin(*BROAD_READS) & (F.col("schema_name") == owner)
    own = (F.col("user") == F.col("holder")) & (F.col("owner") == owner)
    expected = own & (
        ((F.col("object_name") == context_package) & (F.col("privilege") == "EXECUTE"))
        | ((F.col("object_name") != registry_table) & F.col("privilege").isin("READ", "SELECT"))
    )
    where = F.concat(F.col("privilege"), F.lit(" ON "), F.col("owner"), F.lit("."), F.col("object_name"), F.lit(" ("), F.col("holder"), F.lit(")"))
    found = reduce(
        DataFrame.unionByName,
        [
            through(system, EFFECTIVE_CHECKS[0], F.col("privilege"), F.col("privilege").isin(*DANGEROUS_PRIVILEGES)),
            held.where(F.col("holder").isin(*DANGEROUS_ROLES) & (F.col("holder") != F.col("user"))).select("user", F.lit(EFFECTIVE_CHECKS[0]).alias("check"), F.col("holder").alias("item")),
            through(schemas, EFFECTIVE_CHECKS[1], F.lit(FINDING_BROAD_EFFECTIVE), broad),
            through(schemas, EFFECTIVE_CHECKS[2], F.concat_ws(" ON SCHEMA ", "privilege", "schema_name"), ~broad),
            through(objects, EFFECTIVE_CHECKS[3], F.when(~F.coalesce(expected, F.lit(False)), where), F.lit(True)).where("item IS NOT NULL"),
        ],
    )
    texts = found.distinct().groupBy(F.col("user").alias("u__"), F.col("check").alias("c__")).agg(F.expr("listagg(item, ', ') WITHIN GROUP (ORDER BY item)").alias("finding"))
    checks = F.explode(F.array(*[F.struct(F.lit(c).alias("check"), F.lit(MIGRATION if k == 1 else DANGEROUS).alias("bad")) for k, c in enumerate(EFFECTIVE_CHECKS)])).alias("c")
    listed = users.select(F.col("grantee").cast("string").alias("grantee")).distinct().select("grantee", checks).select("grantee", "c.*")
    joined = listed.join(texts, match([listed["grantee"], listed["check"]], [texts["u__"], texts["c__"]]), "left")
    return joined.select("grantee", "check", F.when(F.col("finding").isNull(), OK).otherwise(F.col("bad")).alias("status"), F.coalesce("finding", F.lit(FINDING_NONE)).alias("finding"))


def policy_list(policies: DataFrame, rules: DataFrame) -> DataFrame:
    """The policies one by one, and whether the registry manages them.

    ``policies``: object_name, policy_name, policy_group, pf_owner, package (or NULL), function, enabled, policy_type.
    """
    ours = rules.select(F.col("OBJECT_NAME").alias("o__"), F.col("POLICY_NAME").alias("p__"))
    joined = policies.join(ours, match([policies["object_name"]], [ours["o__"]]), "left")
    managed = F.coalesce((F.upper("policy_group") == "SYS_DEFAULT") & (F.col("policy_name") == F.col("p__")), F.lit(False))
    package = F.when(F.coalesce("package", F.lit("-")) != "-", F.concat(F.col("package"), F.lit("."))).otherwise("")
    return joined.select(
        "object_name", "policy_name", "policy_group", F.concat("pf_owner", F.lit("."), package, "function").alias("function"), "enabled", "policy_type",
        F.when(managed, MANAGED).otherwise(FOREIGN).alias("state"), F.when(managed, "-").otherwise(NOTE_FOREIGN).alias("remark"),
    )


def severity(status: Column) -> Column:
    """A13 per row: 2 = error, 1 = warning, 0 = fine."""
    return F.when(status.isin(*ERROR_STATES), 2).when(status.isin(*WARNING_STATES), 1).otherwise(0)


def rollup(audit: DataFrame, by: str) -> DataFrame:
    """The worst state per group."""
    worst = audit.groupBy(by).agg(F.max(severity(F.col("status"))).alias("worst"))
    return worst.select(by, F.element_at(F.array(F.lit("ok"), F.lit("warning"), F.lit("error")), F.col("worst") + 1).alias("verdict"))


def login_collisions(logins: DataFrame, column: str = "login") -> DataFrame:
    """All-digit logins that are the same number. Only colliding numbers get their names joined."""
    digits = logins.select(F.col(column).alias("login")).filter(F.col("login").rlike("^[0-9]+$")).distinct()
    keyed = digits.withColumn("number", F.regexp_replace("login", "^0+(?=.)", ""))
    return (
        keyed.groupBy("number")
        .agg(F.count("*").alias("logins"), F.array_join(F.sort_array(F.collect_list("login")), "/").alias("names"))
        .filter("logins > 1")
    )


def activation_problems(rules: DataFrame, policies: DataFrame) -> DataFrame:
    """Why the allow-list cannot be switched on; no row = it can.

    Reasons: no ACTIVE rule at all, a policy nobody registered, or a filtered rule whose policy is not on.
    """
    active = rules.filter(F.col("STATE") == ACTIVE).select(
        F.col("OBJECT_NAME").alias("rule_object"), F.col("ACCESS_MODE").alias("mode"), F.col("POLICY_NAME").alias("rule_policy")
    )
    selects = policies.filter("select_flag = 'YES'").select(
        F.col("object_name").alias("policy_object"), F.col("policy_name").alias("found_policy"), "policy_group", "enabled"
    )
    ours = (F.upper("policy_group") == "SYS_DEFAULT") & (F.col("found_policy") == F.col("rule_policy"))
    joined = active.join(selects, F.col("rule_object") == F.col("policy_object"), "left")
    per_rule = joined.groupBy("rule_object", "mode").agg(
        F.count_if(F.col("policy_object").isNotNull() & ~F.coalesce(ours, F.lit(False))).alias("unmanaged"),
        F.bool_or(F.coalesce(ours & (F.upper("enabled") == "YES"), F.lit(False))).alias("policy_on"),
    )
    problems = per_rule.withColumn(
        "reason",
        F.when(F.col("unmanaged") > 0, "unregistered policy").when(
            F.col("mode").isin(*FILTERED) & ~F.col("policy_on"), "policy is not enabled"
        ),
    ).filter("reason IS NOT NULL")
    none = active.agg(F.count("*").alias("n")).filter("n = 0")
    return problems.select(F.col("rule_object").alias("OBJECT_NAME"), "reason").unionByName(
        none.select(F.lit("-").alias("OBJECT_NAME"), F.lit("no active rule").alias("reason"))
    )


def rules_from(rows: Iterable[Sequence]) -> list[Rule]:
    return [Rule.from_row(r) for r in rows]
