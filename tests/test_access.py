import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from silverlode.operators import access
from silverlode.operators.access import FULL, RELATION_MATCH, ROW_MATCH, GuardedReader, Rule


@pytest.fixture(scope="module")
def tables(spark):
    sales = spark.createDataFrame([(1, 12, "taro"), (2, 7, "Taro"), (3, None, None), (4, 12, "x")], "id int, owner long, login string")
    staff = spark.createDataFrame([(12, "taro"), (None, "taro"), (7, "hanako")], "owner long, login string")
    return {"SALES": sales, "staff": staff}


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_row_match(tables):
    rule = Rule("SALES", "TABLE", ROW_MATCH, match_column="login")
    assert ids(access.apply_rule(tables["SALES"], rule, "taro")) == [1]
    assert ids(access.apply_rule(tables["SALES"], rule, None)) == [] and ids(access.apply_rule(tables["SALES"], rule, "")) == []


@pytest.mark.parametrize("login, seen", [("12", [1, 4]), ("0012", [1, 4]), ("1.2e1", [1, 4]), ("12.5", []), ("abc", []), ("9" * 30, []), ("7", [2]), ("1_2", [])])
def test_row_match_number(tables, login, seen):
    rule = Rule("SALES", "TABLE", ROW_MATCH, match_column="owner")
    assert ids(access.apply_rule(tables["SALES"], rule, login)) == seen
    decimals = tables["SALES"].withColumn("owner", F.col("owner").cast("decimal(20,0)"))
    assert ids(access.apply_rule(decimals, rule, login)) == seen


def test_relation_and_reader(tables):
    rule = Rule("SALES", "TABLE", RELATION_MATCH, None, "STAFF", "owner", "owner", "login")
    reader = GuardedReader(tables, [rule])
    assert ids(reader.read("sales", "taro")) == [1, 4] and ids(reader.read("sales", "nobody")) == []
    assert ids(reader.read("sales", None)) == []
    with pytest.raises(PermissionError):
        reader.read("staff", "taro")
    with pytest.raises(PermissionError):
        GuardedReader(tables, [Rule("SALES", "TABLE", FULL, state="ERROR")]).read("sales", "taro")
    both = GuardedReader(tables, [rule, Rule("SALES", "TABLE", ROW_MATCH, match_column="login")])
    assert ids(both.read("sales", "taro")) == [1]
    assert ids(GuardedReader(tables, [Rule("sales", "TABLE", FULL)]).read("SALES", None)) == [1, 2, 3, 4]


def test_predicate_reaches_the_scan(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    rule = Rule("ORDERS", "TABLE", ROW_MATCH, match_column="o_custkey")
    plan = access.apply_rule(orders, rule, "42")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(o_custkey,42)" in plan


@pytest.mark.parametrize(
    "bad",
    [
        dict(access_mode="NONE"),
        dict(access_mode=FULL, match_column="A"),
        dict(access_mode=ROW_MATCH),
        dict(access_mode=ROW_MATCH, match_column="A", relation_object="R"),
        dict(access_mode=RELATION_MATCH, relation_object="R", relation_target_column="A"),
        dict(access_mode=FULL, state="OLD"),
    ],
)
def test_rule_constraints(bad):
    with pytest.raises(ValueError):
        Rule("T", "TABLE", **bad)


def test_registry_generations():
    assert Rule.from_row(("T", "TABLE", "FULL")).state == "ACTIVE"
    seven = Rule.from_row(("T", "TABLE", "ROW_MATCH", "LOGIN", "P", "F", "STAGED"))
    assert (seven.match_column, seven.policy_name, seven.state) == ("LOGIN", "P", "STAGED")
    eleven = Rule.from_row(("T", "TABLE", "RELATION_MATCH", "", "R", "A", "B", "C", "P", "F", "ACTIVE"))
    assert eleven.relation_match_column == "C" and eleven.match_column is None
    with pytest.raises(ValueError):
        Rule.from_row(("T", "TABLE"))


def test_collisions(spark):
    logins = spark.createDataFrame([("7",), ("007",), ("0",), ("000",), ("abc",), ("70",), ("7",)], "login string")
    found = {r["number"]: r["names"] for r in access.login_collisions(logins).collect()}
    assert found == {"7": "007/7", "0": "0/000"}


def test_lifecycle(spark):
    rules = spark.createDataFrame([("A", "STAGED"), ("B", "ACTIVE")], "OBJECT_NAME string, STATE string").withColumn("UPDATED_AT", F.lit("x")).withColumn("UPDATED_BY", F.lit("x"))
    a, b = (spark.createDataFrame([(n,)], "OBJECT_NAME string") for n in "AB")
    active = access.change_state(rules, a, "ACTIVE", "me", F.lit("now"))
    assert {r["OBJECT_NAME"]: (r["STATE"], r["UPDATED_BY"]) for r in active.collect()} == {"A": ("ACTIVE", "me"), "B": ("ACTIVE", "x")}
    with pytest.raises(PySparkException, match="not allowed"):
        access.change_state(rules, b, "ACTIVE", "me", F.lit("now")).collect()
    with pytest.raises(PySparkException, match="stage the rule"):
        access.delete_rules(rules, b).collect()
    assert [r["OBJECT_NAME"] for r in access.delete_rules(rules, a).collect()] == ["B"]


def test_severity(spark):
    audit = spark.createDataFrame([("u", "OK"), ("u", "不足"), ("v", "危険"), ("v", "不足"), ("w", "OK")], "u string, status string")
    assert {r["u"]: r["verdict"] for r in access.rollup(audit, "u").collect()} == {"u": "warning", "v": "error", "w": "ok"}


def test_allowlist_without_rules(spark):
    rules = spark.createDataFrame([("A", "FULL", None, "STAGED")], "OBJECT_NAME string, ACCESS_MODE string, POLICY_NAME string, STATE string")
    policies = spark.createDataFrame([], "object_name string, policy_name string, policy_group string, select_flag string, enabled string")
    assert [tuple(r) for r in access.activation_problems(rules, policies).collect()] == [("-", "no active rule")]


def test_roles_in_a_circle(spark):
    users = spark.createDataFrame([("u",), ("v",), ("w",), (None,)], "grantee string")
    roles = spark.createDataFrame([("u", "a"), ("a", "b"), ("b", "c"), ("c", "a"), ("v", "b"), ("x", "DBA"), (None, "a"), ("w", None), ("u", "a")], "grantee string, role string")
    got = {(r.user, r.holder) for r in access.reachable_roles(users, roles).collect()}
    assert got == {(u, h) for u in "uv" for h in u + "abc"} | {("w", "w")}


def test_effective_audit(spark):
    table = lambda rows, names: spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names.split()))
    users = table([("u",), ("v",), ("DBA",)], "grantee")
    roles = table([("u", "r"), ("r", "DBA"), ("v", "s")], "grantee role")
    system = table([("r", "READ ANY TABLE"), ("u", "CREATE SESSION"), ("v", "SELECT ANY TABLE"), ("v", "READ ANY TABLE")], "grantee privilege")
    schemas = table([("s", "READ ANY TABLE", "ADMIN"), ("s", "SELECT ANY TABLE", "X"), ("v", "INSERT ANY TABLE", "ADMIN")], "grantee privilege schema_name")
    objects = table([("u", "ADMIN", "T", "READ"), ("u", "ADMIN", "REG", "READ"), ("r", "ADMIN", "T", "READ"), ("u", "ADMIN", "PKG", "EXECUTE"), ("u", "O", "T", "READ"), ("u", None, "T", "READ")], "grantee owner object_name privilege")
    rows = {(r.grantee, access.EFFECTIVE_CHECKS.index(r.check)): (r.status, r.finding) for r in access.effective_audit(users, system, roles, schemas, objects, "ADMIN", "REG", "PKG").collect()}
    assert len(rows) == 12 and rows["u", 0] == ("危険", "DBA, READ ANY TABLE") and rows["v", 0] == ("危険", "READ ANY TABLE, SELECT ANY TABLE")
    assert rows["v", 1][0] == "移行警告" and rows["u", 1] == ("OK", "なし") and rows["DBA", 0] == ("OK", "なし")
    assert rows["v", 2] == ("危険", "INSERT ANY TABLE ON SCHEMA ADMIN, SELECT ANY TABLE ON SCHEMA X")
    assert rows["u", 3] == ("危険", "READ ON ADMIN.REG (u), READ ON ADMIN.T (r), READ ON O.T (u)") and rows["v", 3] == ("OK", "なし")
