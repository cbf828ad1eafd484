import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.operators import automaton, catalog, chat, classify, enrich, feedback, glossary, lookup, quality, report, scoring, similarity, synth
from silverlode.operators.concat import ordered_concat
from silverlode.operators.staging import compute_once
from silverlode.plans import flagship, lessons
from tests import fixtures


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# -- quality and enrichment


def test_quality(spark):
    df = spark.createDataFrame([(None,), (-1,), (0,), (5,)], "d int")
    assert rows(quality.quality_filter(df, "d")) == [(0,), (5,)]
    assert rows(quality.quality_rejects(df, "d")) == [(-1, "negative"), (None, "missing")]


def test_group_averages(spark):
    flights = spark.createDataFrame(fixtures.FLIGHTS, fixtures.FLIGHT_SCHEMA)
    measures = {"AVG_DEP_DELAY": "DEP_DELAY", "AVG_DISTANCE": "DISTANCE"}
    got = enrich.with_group_averages(flights, "AIRLINE", measures)
    assert got.count() == 8
    blue = got.filter("FLIGHT_ID = 1003").collect()[0]
    assert (blue["AVG_DEP_DELAY"], blue["AVG_DISTANCE"]) == (11.0, 2443.0)
    typed = enrich.conform(enrich.upper_columns(got), T.StructType([T.StructField("AVG_DISTANCE", enrich.EXACT), T.StructField("FLIGHT_ID", T.StringType())]))
    assert typed.schema["AVG_DISTANCE"].dataType == enrich.EXACT and typed.columns == ["AVG_DISTANCE", "FLIGHT_ID"]


def test_seeded_pick_is_stable(spark):
    base = spark.range(500)
    a = rows(enrich.assign_review(base, "id", seed=3))
    assert a == rows(enrich.assign_review(base.repartition(7), "id", seed=3)) and a != rows(enrich.assign_review(base, "id", seed=4))
    assert len({r[1] for r in a}) == 5


def test_medallion_plan_has_no_python(spark):
    customer = spark.read.parquet("/root/testdata/sf0.001/customer.parquet")
    plan = flagship.medallion(customer)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "GreaterThanOrEqual(c_acctbal,0.0)" in plan


# -- lessons


@pytest.fixture(scope="module")
def staff(spark):
    d = spark.createDataFrame(fixtures.DEPARTMENTS, "d_id int, d_name string, location string")
    e = spark.createDataFrame(fixtures.EMPLOYEES, "e_id int, dept int, e_name string, salary double")
    p = spark.createDataFrame(fixtures.PROJECTS, "p_id int, p_dept int, started string").withColumn("started", F.col("started").cast("timestamp_ntz"))
    return d, e, p


def test_lessons(staff):
    d, e, p = staff
    in_order = lambda df, c: [r[c] for r in df.collect()]
    on = F.col("dept") == F.col("d_id")
    assert in_order(lessons.top_rows(e, "e_id", ["e_id"], 3), "e_id") == [1, 2, 3]
    assert in_order(lessons.at_least(e, "salary", 530000, ["e_id", "salary"], "e_id"), "e_id") == [6, 5, 4, 7]
    assert sorted(in_order(lessons.name_contains(e, "e_name", "sa", ["e_id", "e_name"]), "e_id")) == [1, 8]
    assert in_order(lessons.distinct_values(d, "location"), "location") == ["Kobe", "Osaka", "Tokyo", None]
    assert in_order(lessons.in_year(p, "started", 2025, ["p_id", "started"], "p_id"), "p_id") == [104, 101, 102]
    bands = lessons.banded(e, "salary", 600000, 500000, "band", ["e_id", "salary"], "e_id")
    assert "".join(in_order(bands, "band")) == "LSSMMMLL"  # NULL first when descending
    assert in_order(lessons.join_parent(e, d, on, ["d_id", "e_id"], ["d_id", "e_id"]), "e_id") == [1, 2, 5, 6, 3, 8, 4, 7]
    assert in_order(lessons.without_children(d, p, "d_id", "p_dept", ["d_id"], ["d_id"]), "d_id") == [80]
    assert in_order(lessons.with_children(d, p, "d_id", "p_dept", ["d_id"], ["d_id"]), "d_id") == [10, 20, 30, 40]
    sums = lessons.count_and_sum(e, d, on, ["d_name"], "salary").collect()
    assert [(r["d_name"], r["row_count"], int(r["total"])) for r in sums][:2] == [("B", 3, 1730000), ("C", 2, 480000)]
    assert in_order(lessons.average_at_least(e, "dept", "salary", 500000), "dept") == [20, 40]
    assert in_order(lessons.above_overall_average(e, "salary", ["e_id", "salary"], "e_id"), "e_id") == [6, 5, 4]
    assert in_order(lessons.above_group_average(e, "dept", "salary", ["e_id", "salary"], "e_id"), "e_id") == [6, 5, 4]
    cte = lessons.with_parent_and_average(e, d, on, "dept", "salary", ["e_name", "d_name", "salary"], [lessons.asc("d_name"), lessons.desc("salary")])
    assert in_order(cte, "average")[1:4] == [576666.6667] * 3


# -- model calls


def test_sentiment_of_odd_answers(spark):
    df = spark.createDataFrame([("good",), ("odd",), (None,)], "REVIEW string")
    scorer = lambda p: F.when(p.contains("good"), '```json\n{"label":"Positive"}\n```').when(p.isNotNull(), "?")
    assert rows(scoring.sentiment(df, scoring.review_prompt(F.col("REVIEW")), scorer)) == sorted([("good", "Positive", None), ("odd", None, None), (None, None, None)], key=repr)


def test_model_is_asked_once_per_prompt(spark, tmp_path):
    log = str(tmp_path)

    def model(batches):
        import uuid

        for batch in batches:
            with open(f"{log}/{uuid.uuid4()}", "w") as f:
                f.write("\n".join(batch))
            yield batch.str.upper()

    df = spark.range(1000).select("id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") < 900, F.concat(F.lit("p"), (F.col("id") % 5))).alias("p"))
    out = scoring.score_with_model(df, F.col("p"), model, "answer", calls=2)
    got = out.collect()
    assert out.filter("answer = 'HOT'").count() == 334 and len(out.groupBy("answer").count().collect()) == 7  # two more consumers
    assert len(got) == 1000 and all(r["answer"] == (r["p"].upper() if r["p"] else None) for r in got)
    asked = [line for f in tmp_path.iterdir() for line in f.read_text().split("\n") if line]
    assert sorted(asked) == ["hot", "p0", "p1", "p2", "p3", "p4"]


def test_retry(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3), ("c", 9)], "q string, good_at int")
    attempt = lambda p, n: F.when(F.col("good_at") <= n, F.concat(p, F.lit(f"{n}"))).otherwise("Exception encountered")
    got = scoring.retry(df, attempt, "q")
    assert rows(got.select("q", "attempts", "answer", "succeeded")) == [("a", 1, "a1", True), ("b", 3, "b3", True), ("c", 3, None, False)]

    def model(batches):
        for batch in batches:
            yield batch.map(lambda p: "select 1" if p == "a" else "statement could not be generated")

    rounds = scoring.retry_with_model(df, F.col("q"), model)
    assert rows(rounds.groupBy("prompt").agg(F.count("*"), F.max("succeeded"))) == [("a", 1, True), ("b", 3, False), ("c", 3, False)]


# -- joined text, chat


def test_ordered_concat_over_runs(spark):
    df = spark.range(2500).select(F.lit("hot").alias("k"), F.col("id").cast("int").alias("pos"), F.col("id").cast("string").alias("v")).repartition(5)
    assert ordered_concat(df, ["k"], "pos", "v", "\n").collect()[0]["joined"] == "\n".join(map(str, range(2500)))
    assert ordered_concat(df, ["k"], "pos", "v", "\n", run=1000).collect()[0]["joined"] == "\n".join(map(str, range(2500)))
    quoted = spark.createDataFrame([("k", 1, "a"), ("k", 2, None), ("k", 3, "b")], "k string, pos int, v string")
    assert ordered_concat(quoted, ["k"], "pos", "v", "'\\").collect()[0]["joined"] == "a'\\b"


def test_chat(spark):
    turns = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", ""), (2, 0, "user", "é\"")], "conv_id int, turn int, role string, text string")
    deltas = spark.createDataFrame([(1, 1, 2, "lo"), (1, 1, 1, "hel"), (9, 0, 0, None)], "conv_id int, turn int, seq int, text string")
    joined = chat.join_deltas(deltas, ["conv_id", "turn"], "seq", "text")
    assert rows(joined) == [(1, 1, "hello"), (9, 0, "")]
    history = {r["conv_id"]: r["history"] for r in chat.histories(chat.replace_last(turns, joined.withColumnRenamed("message", "text"))).collect()}
    assert history[1] == '[{"role":"user","content":"hi"},{"role":"assistant","content":"hello"}]'


# -- glossary and prompts


TERMS = [("net", "NETWORK"), ("network", "mesh"), ("a.b", "dot"), ("NETWORK", "x"), (" ", "y"), ("z", " ")]


def _reference_rewrite(text, pairs):
    out, i = "", 0
    while i < len(text):
        hit = max((t for t in pairs if text.startswith(t, i)), key=len, default=None)
        out, i = (out + pairs[hit], i + len(hit)) if hit else (out + text[i], i + 1)
    return out


_row = Row("id", "rewritten", "matched_terms")


def _terms(df):
    return {r["id"]: r for r in df.collect()}


@pytest.mark.parametrize("more, sizes", [(0, {}), (400, {}), (0, {"part_bytes": 8, "round_bytes": 1}), (400, {"part_bytes": 900, "round_bytes": 40_000})])
def test_glossary(spark, more, sizes):
    texts = ["the network net aXb a.b", "netnetwork", "", "none", "NETWORKnet", "net"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    g = spark.createDataFrame(TERMS + [(f"term {i:04d}", f"d{i}") for i in range(more)], "TERM string, DEFINITION string")
    got = _terms(glossary.rewrite(df, "t", g, **sizes))
    pairs = {t: d for t, d in TERMS if t.strip() and d.strip()}
    assert [got[i]["rewritten"] for i in range(len(texts))] == [_reference_rewrite(t, pairs) for t in texts]
    assert got[0]["matched_terms"] == ["a.b", "net", "network"] and got[3]["matched_terms"] == []
    back = glossary.rewrite(df.limit(1), "t", g, True, **sizes).collect()[0]
    assert back["rewritten"] == "the network net aXb a.b"
    odd = spark.createDataFrame([(1, "net"), (1, "a.b"), (None, "net"), (2, None)], "id int, t string")
    assert sorted(map(str, glossary.rewrite(odd, "t", g, **sizes).select("id", "rewritten", "matched_terms").collect())) == sorted(
        map(str, [_row(1, "NETWORK", ["net"]), _row(1, "dot", ["a.b"]), _row(None, "NETWORK", ["net"]), _row(2, None, None)])
    )


def test_overlapping_and_long_terms(spark):
    long = "ab" * 3000
    terms = {"a": "1", "ab": "2", "abab": "3", "bab": "4", long: "LONG", long + "c": "LONGC", "é": "e", "日本": "JP", "本": "X", "aé": "5", "\x00b": "Z"}
    texts = ["ababab", "babab", long + "c" + long + long[1:], "x" + long[:-1], "日本語本é aé", "é日", "a\x00b", "\x00", "b" * 5000 + "abab" * 2500]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    g = spark.createDataFrame(list(terms.items()), "TERM string, DEFINITION string")
    want = [_reference_rewrite(t, terms) for t in texts]
    for sizes in ({}, {"part_bytes": 5000, "round_bytes": 1}):
        got = _terms(glossary.rewrite(df, "t", g, **sizes))
        assert [got[i]["rewritten"] for i in range(len(texts))] == want
        assert [len(got[i]["matched_terms"]) > 0 for i in range(len(texts))] == [w != t for w, t in zip(want, texts)]


def test_automaton_blocks(monkeypatch):
    rng = random.Random(3)
    terms = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(1, 9))) for _ in range(60)})
    made = automaton.built([(t.encode(), t) for t in terms])
    text = "".join(rng.choice("abcd") for _ in range(9000))
    want = {i: max((t for t in terms if text.startswith(t, i)), key=len, default=None) for i in range(len(text))}
    for block, lanes in ((1 << 22, 4096), (1000, 3), (7, 2)):
        monkeypatch.setattr(automaton, "BLOCK_BYTES", block)
        monkeypatch.setattr(automaton, "LANES", lanes)
        places, numbers = automaton.occurrences(made, np.frombuffer(text.encode(), np.uint8))
        assert dict(zip(places.tolist(), (terms[n] for n in numbers))) == {i: t for i, t in want.items() if t} and sorted(places.tolist()) == places.tolist()


def test_an_index_of_many_terms_is_small():
    terms = [f"term{i * 7919:x}" for i in range(20000)]
    assert automaton.built([(t.encode(), t.upper()) for t in terms]).size < 100 * len(terms)


def test_a_batch_of_texts_is_walked_in_stretches(monkeypatch):
    monkeypatch.setattr(glossary, "SLICE_BYTES", 100)
    kind = pa.struct([("matched_terms", pa.list_(pa.string())), ("rewritten", pa.string())])
    texts = pa.array(["a net " * 10, None, "net", "", "x" * 300, "net"])
    parts = list(glossary._walked(iter([texts]), [automaton.built([(b"net", "NETWORK")])], True, True, kind))
    assert len(parts) == 3 and max(map(len, parts)) <= 4
    assert [x and x["rewritten"] for part in parts for x in part.to_pylist()] == [t and t.replace("net", "NETWORK") for t in texts.to_pylist()]


def test_equal_glossary_rows_are_folded_before_they_are_sorted(spark):
    words = spark.range(1000).selectExpr("concat('w', id % 10) AS word").selectExpr("word AS TERM", "upper(word) AS DEFINITION").distinct()
    pairs = glossary._pairs(words, False)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") >= 2 and sorted(map(tuple, pairs.collect())) == [(f"w{i}", f"W{i}") for i in range(10)]


def test_empty_glossary(spark):
    df = spark.createDataFrame([(1, "x")], "id int, t string")
    g = spark.createDataFrame([], "TERM string, DEFINITION string")
    assert glossary.rewrite(df, "t", g).collect()[0]["rewritten"] == "x"


def test_prompts(spark):
    rules = spark.createDataFrame([(1, "HR", "r1"), (2, None, "r2"), (3, "nan", " "), (4, "共通", "r4;"), (5, "IT", "r5")], "no long, CATEGORY string, RULE string")
    q = spark.createDataFrame([("q1;", "HR"), ("q2;", "none"), ("q3", None)], "q string, c string")
    got = {r["q"]: r["prompt"] for r in glossary.assemble_prompts(q, "q", "c", rules, "no").collect()}
    assert got["q1;"] == "q1;\n\n=== Rules ===\nr1\n\nr2\n\nr4"
    assert got["q2;"] == "q2;\n\n=== Rules ===\nr2\n\nr4" and got["q3"].startswith("q3\n\n===")
    none = glossary.assemble_prompts(q, "q", "c", rules.limit(0), "no", F.lit(" extra ")).collect()
    assert {r["prompt"] for r in none} == {"extra\n\nq1", "extra\n\nq2", "extra\n\nq3"}


# -- lookups and feedback


def test_lookups(spark):
    profiles = spark.createDataFrame([("b", "Sales"), ("A", "Sales"), ("Sales ", "x"), ("c", "")], "profile string, category string")
    df = spark.createDataFrame([("Sales",), (" x",), ("sales",), ("",), (None,)], "t string")
    assert [r["resolved"] for r in lookup.resolve_name(df, "t", profiles).collect()] == ["Sales", "Sales", "sales", "", None]
    assert lookup.resolve_name(df, "t", profiles, True).collect()[0]["resolved"] == "A"
    assert [r["route"] for r in lookup.route(df, "t", profiles, "D").collect()] == ["A", "Sales ", "A", "D", "D"]


def test_latest_log_entry(spark):
    log = spark.createDataFrame(
        [("1", "select  1", "f", None, 9), ("2", "select\n1", "f", "2024", 1), ("3", "select 1", "f", "2024", 2), ("4", "x", "full  text", None, 1)],
        "sql_id string, sql_text string, sql_fulltext string, translated_at string, use_count int",
    )
    q = spark.createDataFrame([("select 1 ",), ("full text",), ("none",), (" ",)], "q string")
    assert [r["sql_id"] for r in lookup.latest_log_entry(q, "q", log).collect()] == ["3", "4", None, None]


def test_feedback(spark):
    given = spark.createDataFrame(
        [(" q1;", "positive", " r ", None, 1), ("q1", "negative", "r2", "c", 2), ("q2", "Negative", "r", "c", 1), (";", "x", "r", "", 1), ("q3", "positive", " ", "", 1)],
        "question string, kind string, response string, comment string, given_at int",
    )
    old = spark.createDataFrame([("select ai showsql q2", "NEGATIVE", "old", "")], "sql_text string, feedback_type string, response string, content string")
    got = feedback.add_feedback(old, given)
    assert rows(got) == [("select ai showsql q1", "NEGATIVE", "r2", "c"), ("select ai showsql q2", "NEGATIVE", "r", "c")]
    assert feedback.refused(given).count() == 2
    assert feedback.delete_feedback(got, old).count() == 1
    honest = feedback.prepared(given.filter("given_at = 1"), keep_quirk=False)
    assert {r["feedback_type"] for r in honest.collect()} == {"POSITIVE", "NEGATIVE"}


# -- similarity


@pytest.mark.parametrize("threshold, limit, skip", [(0.9, 3, False), (0.3, 2, True), (0.1, 5, False)])
def test_similarity_equals_brute_force(spark, threshold, limit, skip):
    rng = random.Random(5)
    centre = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(3)]
    # A third of all vectors are near copies of one another.
    data = [(i, [c + rng.gauss(0, 0.05 if i % 3 == 0 else 0.8) for c in centre[0 if i % 3 == 0 else i % 3]]) for i in range(120)]
    data += [(200, [0.0] * 6), (201, data[0][1]), (202, [2 * x for x in data[0][1]])]
    df = spark.createDataFrame(data, "id long, vector array<double>")

    def cos(a, b):
        n = math.sqrt(sum(x * x for x in a)) * math.sqrt(sum(x * x for x in b))
        return round(sum(x * y for x, y in zip(a, b)) / n, 6) if n else -2

    want = []
    for q, v in data:
        ranked = sorted((-s, e) for e, w in data if not (skip and e == q) and (s := cos(v, w)) >= threshold)[:limit]
        want += [(q, e, -s, n) for n, (s, e) in enumerate(ranked, 1)]
    for pivots, block in ((4, 20000), (8, 10), (1, 50)):
        got = similarity.top_matches(df, df, threshold, limit, skip, pivots=pivots, block_rows=block)
        assert sorted(tuple(r) for r in got.collect()) == sorted(want)


@pytest.mark.parametrize("threshold, width", [(0.9, 64), (0.6, 40), (0.25, 5), (0.1, 1)])
def test_scan_equals_all_products(threshold, width):
    rng = np.random.default_rng(width)
    units = rng.normal(size=(1500, width))
    units[::9] = units[0] + rng.normal(size=units[::9].shape) * 0.05
    units /= np.linalg.norm(units, axis=1)[:, None]
    ids = rng.permutation(1500).astype(np.int64)
    scan = similarity._Scan(similarity._rotation(units[:200]), threshold, 3, True)
    got = sorted(zip(*[x.tolist() for x in scan.run(ids[:700], units[:700], ids, units)]))
    scores = np.round(units[:700] @ units.T, similarity.DIGITS)
    want = []
    for q in range(700):
        ranked = sorted((-s, i) for s, i in zip(scores[q].tolist(), ids.tolist()) if i != ids[q] and s >= threshold)[:3]
        want += [(int(ids[q]), i, -s) for s, i in ranked]
    assert [x[:2] for x in got] == [x[:2] for x in sorted(want)] and np.allclose([x[2] for x in got], [x[2] for x in sorted(want)], atol=2e-6)
    assert scan.pairs == 700 * 1500 and (width < 64 or scan.full < 0.2 * scan.pairs)


def test_few_products_are_counted_one_by_one(monkeypatch):
    rng = np.random.default_rng(4)
    units = rng.normal(size=(3000, 64))
    units /= np.linalg.norm(units, axis=1)[:, None]
    single, whole = [], np.einsum
    monkeypatch.setattr(np, "einsum", lambda text, a, b: single.append(len(a)) or whole(text, a, b))
    ids = np.arange(3000)
    found = similarity._Scan(similarity._rotation(units), 0.3, 3, True).run(ids, units, ids, units)
    assert len(found[0]) == 9000 and sum(single) < 0.02 * 3000 * 3000


def test_similarity_without_entries(spark):
    some = spark.createDataFrame([(1, [1.0, 0.0])], "id long, vector array<double>")
    assert similarity.top_matches(some, some.limit(0)).count() == 0
    assert similarity.top_matches(some.limit(0), some).count() == 0
    with pytest.raises(ValueError):
        similarity.top_matches(some, some, threshold=0.99)


# -- classifier


def test_classifier(spark):
    rng = random.Random(1)
    data = [(f"L{i % 3}", [float(i % 3 == k) + rng.gauss(0, 0.1) for k in range(3)]) for i in range(90)]
    df = classify.with_vectors(spark.createDataFrame(data, "category string, e array<float>"), "e")
    model = classify.fit(df, "category")
    assert classify.model_labels(model) == ["L0", "L1", "L2"]
    got = classify.predict(model, df.drop("category").withColumn("want", F.col("e")))
    first = got.collect()[0]
    assert first["predicted"] == "L0" and sum(first["probabilities"].values()) == pytest.approx(1, abs=0.01)
    assert classify.predict(model, df).filter("category = predicted").count() >= 85
    record = classify.model_record(df, "category", "m", "e").collect()[0]
    assert (record["samples"], record["labels"], record["algorithm"]) == (90, ["L0", "L1", "L2"], "LogisticRegression")


def test_classifier_on_text(spark):
    data = [("fruit", "apple pear plum"), ("car", "wheel engine road"), ("fruit", "pear plum"), ("car", "engine wheel"), ("car", ""), (None, "apple")]
    df = classify.training_rows(spark.createDataFrame(data, "category string, text string"), "text", "category")
    assert df.count() == 5
    model = classify.fit(df.filter("category <> ''"), "category", stages=classify.text_features("text", 256))
    got = classify.predict(model, spark.createDataFrame([("wheel road",), ("plum apple",)], "text string"))
    assert [r["predicted"] for r in got.collect()] == ["car", "fruit"]


# -- catalog


def test_attributes_and_profiles(spark):
    attributes = spark.createDataFrame(
        [(" P", "Region", "old", 1), ("P", "REGION", "eu", 2), ("P", " ", "x", 1), ("", "a", "x", 1), ("P", "object_list", '[{"name":"T1"},{"name":"v1"},"t1"]', 1),
         ("Q", "object_list", '{"name":"V1"}', 1), ("SVC", "region", "x", 1)],
        "profile_name string, attribute_name string, attribute_value string, seq int",
    )
    maps = {r["profile"]: r["attributes"] for r in catalog.attribute_maps(attributes).collect()}
    assert maps["P"]["region"] == "eu" and set(maps) == {"P", "Q", "SVC"}
    objects = spark.createDataFrame([("T1", "TABLE"), ("V1", "VIEW"), ("V1", "TABLE")], "name string, kind string")
    profiles = spark.createDataFrame([("P", "desc"), ("Q", None), ("svc", ""), (" ", "x"), ("R", "r")], "name string, category string")
    kept = spark.createDataFrame([("p", "kept"), ("R", " ")], "profile string, category string")
    got = {r["profile"]: r for r in catalog.profile_table(profiles, attributes, objects, kept, "SVC").collect()}
    assert set(got) == {"P", "Q", "R"}
    assert (got["P"]["category"], got["P"]["tables"], got["P"]["region"]) == ("kept", "T1, V1", "eu")
    assert (got["Q"]["category"], got["Q"]["tables"], got["R"]["category"], got["R"]["views"]) == ("", "V1", "r", "")


def test_keys_and_statements(spark):
    constraints = spark.createDataFrame(
        [("ORD", "PK_O", "P", None), ("CUST", "PK_C", "P", None), ("ORD", "FK_O", "R", "PK_C")],
        "object_name string, constraint_name string, constraint_type string, r_constraint_name string",
    )
    members = spark.createDataFrame([("PK_O", 2, "B"), ("PK_O", 1, "A"), ("PK_C", 1, "ID"), ("FK_O", 1, "C_ID")], "constraint_name string, position int, column_name string")
    assert rows(catalog.primary_key_text(constraints, members)) == [("CUST", "PK_C: ID"), ("ORD", "PK_O: A, B")]
    assert rows(catalog.foreign_key_text(constraints, members)) == [("ORD", "FK_O: C_ID -> CUST(ID)")]
    statements = catalog.comment_statements(
        spark.createDataFrame([("t", "it's"), ("u", None)], "object_name string, comments string"),
        spark.createDataFrame([("t", "C", "x")], "object_name string, column_name string, comments string"),
    )
    assert [r["statement"] for r in statements.collect()] == ["COMMENT ON TABLE T IS 'it''s';", "COMMENT ON COLUMN T.C IS 'x';"]
    columns = catalog.schema_columns({"T": spark.range(1).withColumn("n", F.lit("x"))})
    assert [(r["column_name"], r["data_type"]) for r in columns.orderBy("column_id").collect()] == [("id", "BIGINT"), ("n", "STRING")]


def test_views(spark):
    spark.range(3).createOrReplaceTempView("v_three")
    assert "v_three" in {r["name"] for r in catalog.view_list(spark).collect()}


# -- report and synthetic rows


def test_execution_records(spark):
    executions = spark.createDataFrame(
        [("e1", "s", "q", "q", "c", "p", "sql", "❌ no", 2, "t", 10.0, None, ""), ("e2", "s", "q", "q", "c", "p", "sql", "✅", 1, "t", None, "3", None)],
        "execution_id string, screen_name string, prompt string, prompt_used string, category string, profile string, generated_sql string, "
        "status string, attempts int, started_at string, elapsed_ms double, result_count string, error string",
    )
    phases = spark.createDataFrame(
        [("e1", "select_ai", "t1", "t2", 100.0), ("e1", "select_ai", "t3", "t4", 50.0), ("e1", "select", "t5", "t6", -5.0)],
        "execution_id string, phase string, started_at string, finished_at string, elapsed_ms double",
    )
    got = {r["実行ID"]: r for r in report.execution_records(executions, phases).collect()}
    assert (got["e1"]["Select AI経過時間（秒）"], got["e1"]["Select AI開始時間"], got["e1"]["Select AI終了時間"]) == ("0.150", "t1", "t4")
    assert (got["e1"]["SQL実行経過時間（秒）"], got["e1"]["エラー内容"], got["e1"]["結果件数"]) == ("0.000", "no", "")
    assert (got["e2"]["Select AI経過時間（秒）"], got["e2"]["全体経過時間（秒）"], got["e2"]["エラー内容"]) == ("", "", "")


def test_synthetic(spark):
    tables = [
        synth.Table("p", 50, {"id": synth.serial(100), "kind": synth.pick(["a", None, "c"])}),
        synth.Table("c", 400, {"p_id": synth.Reference("p", 100), "n": synth.whole(-2, 2), "price": synth.amount(1, 3), "d": synth.day("2024-01-30", 3)}),
    ]
    a, b = synth.generate(spark, tables, 1), synth.generate(spark, tables, 1)
    assert rows(a["c"]) == rows(b["c"].repartition(9)) and rows(a["c"]) != rows(synth.generate(spark, tables, 2)["c"])
    assert a["c"].join(a["p"], F.col("p_id") == F.col("id"), "left_anti").count() == 0
    assert {r["n"] for r in a["c"].collect()} == {-2, -1, 0, 1, 2}
    prices = [float(r["price"]) for r in a["c"].collect()]
    assert min(prices) >= 1 and max(prices) <= 3
    status = catalog.status_rows(synth.load_status(a, {"p": 50, "c": 401})).collect()
    assert [tuple(r) for r in status] == [(1, "p", 50, "COMPLETED"), (2, "c", 400, "FAILED")]
    with pytest.raises(ValueError, match="first"):
        synth.generate(spark, tables[::-1])
    pool = synth.pools(spark.createDataFrame([("x", 1), ("y", None)], "s string, n int"), ["s", "n"], 10)
    assert pool == {"s": ["x", "y"], "n": [1]}
    many = synth.pools(spark.range(1000).selectExpr("id % 25 AS brand"), ["brand"], 20)
    assert len(many["brand"]) == 20


def test_compute_once(spark):
    df = compute_once(spark.range(3), {"twice": F.col("id") * 2}).filter("twice > 2")
    assert rows(df) == [(2, 4)]
