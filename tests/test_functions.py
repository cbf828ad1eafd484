import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.functions import text as tx
from silverlode.functions.dates import parse_date, year_range
from silverlode.functions.elapsed import display_timestamp, elapsed_seconds, status_message
from silverlode.functions.vectors import cosine, parse_embedding, unit

D = dt.datetime
DATES = [
    ("2024-12-24", D(2024, 12, 24)),
    ("2024/1/2", D(2024, 1, 2)),
    ("24-12-2024", D(2024, 12, 24)),
    ("24/12/2024", D(2024, 12, 24)),
    ("01/02/2024", D(2024, 2, 1)),  # day first wins
    ("12/24/2024", D(2024, 12, 24)),
    ("20241224", D(2024, 12, 24)),
    ("2024-12-24 15:30:00", D(2024, 12, 24, 15, 30)),
    ("2024/12/24 5:03:09", D(2024, 12, 24, 5, 3, 9)),
    ("24-12-2024 15:30:00", D(2024, 12, 24, 15, 30)),
    ("24/12/2024 15:30:00", D(2024, 12, 24, 15, 30)),
    ("2024-12-24T15:30:00", D(2024, 12, 24, 15, 30)),
    ("2024-12-24 15:30", D(2024, 12, 24, 15, 30)),
    ("1900/01/01   0:00", D(1900, 1, 1)),
    ("1900/01/01 00:00:00.000000000", D(1900, 1, 1)),
    ("2024-12-24T15:30:00.250Z", D(2024, 12, 24, 15, 30, 0, 250000)),
    ("12/24/2024 15:30", D(2024, 12, 24, 15, 30)),
    ("Dec 24, 2024", D(2024, 12, 24)),
    ("24 December 2024", D(2024, 12, 24)),
    ("45000", D(2023, 3, 15)),
    ("45000.5", D(2023, 3, 15, 12)),
    ("0", None),
    ("2958466", None),
    (" ", None),
    (None, None),
    ("some day", None),
    ("2024-13-45", None),
    ("2024-02-30", None),
]


def test_date_cascade(one):
    assert one([d for d, _ in DATES], parse_date(F.col("x"))) == [want for _, want in DATES]


def test_dates_of_other_types(one):
    assert one([1.0, 45000.5, 0.5], parse_date(F.col("x"), T.DoubleType()), "x double") == [D(1899, 12, 31), D(2023, 3, 15, 12), None]
    assert one([dt.date(2024, 1, 2)], parse_date(F.col("x"), T.DateType()), "x date") == [D(2024, 1, 2)]


def test_year_range(one):
    rows = one([D(2024, 12, 31, 23), D(2025, 1, 1), D(2025, 12, 31), None], year_range(F.col("x"), 2025), "x timestamp_ntz")
    assert rows == [False, True, True, None]


def test_elapsed(one):
    cases = {
        "12ms": "0.012", "3秒": "3.000", "1:05": "65.000", "1:02:03": "3723.000", "1,234": "1234.000", "-5": "0.000", "": "", " ": "",
        "about": "about", "x ms": "x ms", "1:2:3:4": "1:2:3:4", "1.5": "1.500", "5d": "5d", "2.0005": "2.001", "1.0005": "1.000", "1e3ms": "1.000", None: "",
    }
    assert one(list(cases), elapsed_seconds(F.col("x"))) == list(cases.values())


def test_display_timestamp_and_status(one):
    assert one(["2025-01-02T03:04:05.678+09:00", "2025-01-02T03:04:05", "", None], display_timestamp(F.col("x"))) == [
        "2025-01-02 03:04:05", "2025-01-02 03:04:05", "-", "-",
    ]
    assert one(["❌ bad ", "✅ ok", "plain", None], status_message(F.col("x"))) == ["bad", "ok", "plain", ""]


def test_strip_fences_and_parse(one):
    answers = [
        '```json\n{"label": "Positive", "reason": "a\nb"}\n```',
        '{"label": "Neutral"}',
        '```\n{"label": "Negative", "reason": "x"}\n```',
        "no json",
        None,
    ]
    assert one(answers, tx.strip_fences(F.col("x"))) == [
        '{"label": "Positive", "reason": "ab"}', '{"label": "Neutral"}', '```{"label": "Negative", "reason": "x"}', "no json", None,
    ]
    labels = one(answers, tx.parse_answer(F.col("x"))["label"])
    assert labels == ["Positive", "Neutral", None, None, None]


def test_extract_sql(one):
    cases = {
        "x\n```SQL\n select 1 \n``` y": "select 1",
        "Sql :  delete from t ": "delete from t",
        "try WITH a as (select 1)": "WITH a as (select 1)",
        '{"generated_sql": " update t "}': "update t",
        '{"sql": "", "Query": "drop t"}': "drop t",
        "preselected": "",
        "": "",
    }
    assert one(list(cases), tx.extract_sql(F.col("x"))) == list(cases.values())
    assert one(["A STATEMENT could not be generated.", "ok"], tx.failed_generation(F.col("x"))) == [True, False]


def test_value_normalise(one):
    cases = {
        '  {"a": [1, 2], "b": "é"} ': '{\n  "a": [\n    1,\n    2\n  ],\n  "b": "é"\n}',
        '{"a": "x\\ny"}': '{\n  "a": "x\ny"\n}',
        "{not json}\\t": "{not json}\t",
        'a\\nb\\r\\"c\\" ': 'a\nb"c"',
        "　wide ": "wide",
        None: None,
    }
    assert one(list(cases), tx.normalise_value(F.col("x"))) == list(cases.values())


def test_decode_bytes(one):
    data = [bytearray("é".encode()), bytearray(b"caf\xe9"), None]
    assert one(data, tx.decode_bytes(F.col("x")), "x binary") == ["é", "café", None]


def test_preview(one):
    assert one(["a" * 200, "a" * 201, None], tx.preview(F.col("x"))) == ["a" * 200, "a" * 200 + " ...", None]


def test_comments_and_classes(one):
    sql = ["select '--x' -- y\nfrom t--z", "it''s -- gone", "'open -- stays", "a - b -- c", "", None, "x--\r"]
    assert one(sql, tx.strip_comments(F.col("x"))) == ["select '--x' \nfrom t", "it''s ", "'open -- stays", "a - b ", "", "", "x"]
    classes = {
        " /* a */ -- b\n select 1": "SELECT", "with x as": "SELECT", "comment  on t": "COMMENT", "commented": "UNKNOWN", "exec p": "PLSQL",
        "Declare x": "PLSQL", "grant a": "GRANT", "/* open select": "UNKNOWN", "selects": "UNKNOWN", "": "UNKNOWN", None: "UNKNOWN",
    }
    assert one(list(classes), tx.statement_class(F.col("x"))) == list(classes.values())


def test_payload_text(one):
    cases = {
        '{"choices":[{"delta":{"content":"a"}}]}': "a",
        '{"choices":[{"delta":{}},{"message":{"content":"b"}}]}': "b",
        '{"choices":[{"content":[{"text":"c"},"d",{"content":"e"}]}]}': "cde",
        '{"choices":[],"message":{"content":{"text":"f"}}}': "f",
        '{"content":"","text":"g"}': "g",
        '{"content":5,"text":6}': "",
        "[1]": "",
        '{"content":[[["deep"]]]}': "deep",
        "broken": "",
        '{"content":' + "[" * 20_000 + '"far"' + "]" * 20_000 + "}": "far",
        '{"choices":[' + '{"content":{"content":' * 20_000 + '"farther"' + "}}" * 20_000 + "]}": "farther",
        '{"content":' + "[" * 20_000 + '"open"' + "]" * 19_999 + "}": "",
        '{"content":[[[[[1,]]]]]}': "",
        None: "",
    }
    assert one(list(cases), tx.payload_text("x")) == list(cases.values())


def _random_json(rng, depth=0):
    kind = rng.random()
    if depth < 5 and kind < 0.25:
        return {rng.choice(["a", "b c", "é", 'q"', "\\", ""]) + str(i): _random_json(rng, depth + 1) for i in range(rng.randint(0, 4))}
    if depth < 5 and kind < 0.5:
        return [_random_json(rng, depth + 1) for _ in range(rng.randint(0, 5))]
    return rng.choice([None, True, False, 0, -7, 12345678901234567890, 1.5, -0.25, 1e5, 1e22, 1.5e-7, 123456789.25, 0.0001, -2e16, 1e300, "text", "{,}", 'say "x"', "a\\", "\\\"", "line\nbreak\t", "日本 😀", "\x07", ""])


def test_pretty_json(one):
    rng = random.Random(4)
    values = [_random_json(rng) for _ in range(150)] + [[list(range(1000)), {"k": [[]] * 300}], {}, [], {"a": []}, [[[{}]]]]
    texts = [json.dumps(v, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 1]), separators=rng.choice([None, (",", ":")])) for v in values]
    texts += ['["\\u00e9\\/\\u000a\\u0007 \\\\u0041"]', "[1E5, 1.0e+2, -0, -0.0, 1e400, 100.10, 1e-4, 0.00012]", " [ 1 , 2 ] "]
    assert one(texts, tx.pretty_json(F.col("x"))) == [json.dumps(json.loads(t), ensure_ascii=False, indent=2) for t in texts]
    assert one(["{", "[1,]", "text", "", None, '{"a":1,"a":2}', "\x01", "[1] 2"], tx.pretty_json(F.col("x")))[:5] == [None] * 5


def test_reply_text(one):
    cases = {
        '{"reply":"a","content":"b"}': "a", '{"reply":1,"content":"b"}': "b", '{"x":1}': '{\n  "x": 1\n}', "[1]": "[\n  1\n]", " text ": "text", "": "",
    }
    assert one(list(cases), tx.reply_text(F.col("x"))) == list(cases.values())


def test_json_or_text(one):
    kinds = one(['{"a":1}', "text", "[1]"], F.schema_of_variant(tx.json_or_text(F.col("x"))))
    assert [k.split("<")[0] for k in kinds] == ["OBJECT", "STRING", "ARRAY"]


def test_sections(one):
    answers = ["```sql\nJOIN: a\n = b\n  where:  c ```", "JOIN: only", "Join: \nWhere: x"]
    assert one(answers, tx.section(F.col("x"), 1)) == ["a\n = b", "None", "None"]
    assert one(answers, tx.section(F.col("x"), 2)) == ["c", "None", "x"]


def test_annotations(one):
    script = """ALTER TABLE T ANNOTATIONS (ui 'a, ''b''', "sample_header" 'x,y', SAMPLE_DATA '1', note)
ALTER VIEW V annotations (sample_data 'z')
-- other line"""
    assert one([script], tx.filter_annotations(F.col("x"))) == ["ALTER TABLE T ANNOTATIONS (ui 'a, ''b''', note)\n-- other line"]
    assert one([script], tx.filter_annotations(F.col("x"), True)) == [script]


def test_names(one):
    assert one(['"adm"."Tab1" ', "tab;", " x.y.z ", None], tx.object_key(F.col("x"))) == ["TAB1", "TAB", "Z", None]
    assert one(["A1$#_", "1A", "a", None, "A" * 129], tx.is_object_name(F.col("x"))) == [True, False, False, False, False]
    assert one(["a1", "a b"], tx.is_table_name(F.col("x"))) == [True, False]


def test_type_text(spark):
    rows = [("VARCHAR2", 20, None, None), ("NUMBER", 22, 10, 2), ("NUMBER", 22, 10, 0), ("NUMBER", 22, None, None), ("DATE", 7, None, None)]
    df = spark.createDataFrame(rows, "t string, l int, p int, s int")
    out = [r[0] for r in df.select(tx.type_text(F.col("t"), F.col("l"), F.col("p"), F.col("s"))).collect()]
    assert out == ["VARCHAR2(20)", "NUMBER(10,2)", "NUMBER(10)", "NUMBER", "DATE"]


def test_vectors(spark, one):
    assert one(['{"embed_vector":[1,2.5]}', '{"embed_vector":"[3]"}', '{"other":1}', "x"], parse_embedding(F.col("x"))) == [[1.0, 2.5], [3.0], None, None]
    df = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0]), ([0.0, 0.0], [1.0, 0.0])], "a array<double>, b array<double>")
    rows = df.select(unit(F.col("a")).alias("u"), cosine(F.col("a"), F.col("b")).alias("c")).collect()
    assert rows[0]["u"] == [0.6, 0.8] and rows[0]["c"] == pytest.approx(0.96)
    assert rows[1]["u"] is None and rows[1]["c"] is None
