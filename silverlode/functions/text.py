"""Text expressions for answers, logs, payloads and names.

All are built-in expressions but one: payloads nested deeper than those follow go through an Arrow UDF.
"""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The characters that the source treats as white space when it trims.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Phrases that mark an answer as a failed generation.
FAILURE_PHRASES = [
    "statement could not be generated",
    "with the restriction of",
    "Here is some more information to help you further",
    "Exception encountered",
]

# Statement verbs that are their own class.
STATEMENT_VERBS = [
    "INSERT", "UPDATE", "DELETE", "MERGE", "CREATE", "DROP", "ALTER", "TRUNCATE", "GRANT", "REVOKE",
]

# Keys under which a JSON answer may carry its SQL, in order of preference.
SQL_KEYS = ["sql", "SQL", "generated_sql", "query", "Query"]

# Annotation names that need sample rows.
SAMPLE_ANNOTATIONS = ["sample_header", "sample_data"]

OBJECT_NAME = r"^[A-Z][A-Z0-9_$#]{0,127}$"
TABLE_NAME = r"^[A-Z0-9_$#]+$"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITE_SPACE))


def not_blank(text: Column) -> Column:
    """The text, or NULL when it is empty: lets ``coalesce`` express "first non-empty"."""
    return F.nullif(text, F.lit(""))


# -- answers -----------------------------------------------------------------------------------------------------


def strip_fences(answer: Column) -> Column:
    """Drop a leading ```json, a trailing ``` and every newline; a plain leading fence stays."""
    return F.regexp_replace(answer, r"(^```json|```$|\n)", "")


def parse_answer(answer: Column, schema: str = "label STRING, reason STRING") -> Column:
    """JSON text → struct; broken JSON → a struct of NULLs."""
    return F.from_json(strip_fences(answer), schema)


def extract_sql(answer: Column) -> Column:
    """P20: the SQL of a model answer; '' when there is none."""
    fence, label, bare = r"(?i)```sql\s*([\s\S]*?)```", r"(?i)SQL\s*:([\s\S]+)$", r"(?i)\b(?:SELECT|WITH)\b[\s\S]*"
    found = (
        F.when(answer.rlike(fence), strip(F.regexp_extract(answer, fence, 1)))
        .when(answer.rlike(label), strip(F.regexp_extract(answer, label, 1)))
        .when(answer.rlike(bare), strip(F.regexp_extract(answer, bare, 0)))
    )
    # Escaped JSON keys: get_json_object is NULL on text that is not JSON.
    from_keys = [strip(F.get_json_object(answer, f"$.{key}")) for key in SQL_KEYS]
    return F.coalesce(not_blank(found), *[not_blank(k) for k in from_keys], F.lit(""))


def failed_generation(answer: Column) -> Column:
    """Does the text contain one of the failure phrases, in any case?"""
    lowered = F.lower(answer)
    hit = F.lit(False)
    for phrase in FAILURE_PHRASES:
        hit = hit | lowered.contains(phrase.lower())
    return hit


def section(answer: Column, part: int) -> Column:
    """1 = the JOIN section, 2 = the WHERE section, 'None' when missing."""
    clean = F.regexp_replace(answer, r"```+\w*", "")
    pattern = r"(?i)JOIN:\s*([\s\S]*?)\n\s*WHERE:\s*([\s\S]*)$"
    return F.coalesce(not_blank(strip(F.regexp_extract(clean, pattern, part))), F.lit("None"))


# -- cells -------------------------------------------------------------------------------------------------------


def preview(text: Column, size: int = 200) -> Column:
    """P09"""
    return F.when(F.length(text) > size, F.concat(F.substring(text, 1, size), F.lit(" ..."))).otherwise(text)


def decode_bytes(data: Column) -> Column:
    """Bytes → text: UTF-8, else Latin-1."""
    return F.coalesce(F.try_validate_utf8(data.cast("string")), F.decode(data, "ISO-8859-1"))


def _bind(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body looks at it."""
    return F.element_at(F.transform(F.array(value), body), 1)


# JSON again as indented text, without leaving the JVM. Two characters that no JSON text holds stand for escapes meanwhile.
_BACKSLASH, _QUOTE = "\x01", "\x02"
_TOKENS = r'"[^"]*"|[{}\[\]:,]|[^\s{}\[\]:,"]+'
_STRETCH = 128  # tokens whose depths are counted together


def _float_text(token: Column) -> Column:
    """The shortest decimal form: plain digits for exponents from -4 to 15, else ``1.5e-07``."""

    def form(s: Column) -> Column:
        mantissa, power = F.substring_index(s, "E", 1), F.substring_index(s, "E", -1).try_cast("int")
        sign, short = F.when(s.startswith("-"), "-").otherwise(""), F.regexp_replace(mantissa, r"\.0$", "")
        digits = F.regexp_replace(short, r"[.-]", "")
        whole = F.concat(F.rpad(digits, power + 1, "0"), F.lit(".0"))
        parted = F.concat(F.substring(digits, F.lit(1), power + 1), F.lit("."), F.substring(digits, power + 2, F.length(digits)))
        large = F.concat(sign, F.when(F.length(digits) <= power + 1, whole).otherwise(parted))
        other = F.concat(short, F.lit("e"), F.when(power < 0, "-").otherwise("+"), F.lpad(F.abs(power).cast("string"), F.greatest(F.lit(2), F.length(F.abs(power).cast("string"))), "0"))
        return F.when(~s.contains("E"), s).when(power.between(7, 15), large).when(power == -4, F.concat(sign, F.lit("0.000"), digits)).otherwise(other)

    return _bind(token.try_cast("double").cast("string"), form)


def _string_token(token: Column) -> Column:
    """A string as the shortest JSON of its characters; only those with numbered or needless escapes need a look."""
    own = F.replace(F.replace(token, F.lit(_BACKSLASH), F.lit("\\\\")), F.lit(_QUOTE), F.lit('\\"'))

    def escaped(text: Column) -> Column:
        for char, escape in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"), ("\b", "\\b"), ("\f", "\\f")):
            text = F.replace(text, F.lit(char), F.lit(escape))
        for code in (*range(8), 11, *range(14, 32)):
            text = F.replace(text, F.lit(chr(code)), F.lit(f"\\u{code:04x}"))
        return F.concat(F.lit('"'), text, F.lit('"'))

    read = F.try_variant_get(F.try_parse_json(own), "$", "string")
    return F.when(token.contains("\\u") | token.contains("\\/"), escaped(read)).otherwise(own)


def pretty_json(text: Column) -> Column:
    """Indented JSON (two blanks a level, numbers and strings in their shortest form); NULL when the text is not JSON.

    The text is cut into tokens, their depths are summed up stretch by stretch, and every token is written with the line
    break and blanks that belong to it. JSON with a repeated key in an object, or deeper than the reader goes, is NULL.
    """
    masked = F.replace(F.replace(text, F.lit("\\\\"), F.lit(_BACKSLASH)), F.lit('\\"'), F.lit(_QUOTE))

    def step(token: Column) -> Column:
        return F.when(token.isin("{", "["), 1).when(token.isin("}", "]"), -1).otherwise(0)

    def depths(tokens: Column) -> Column:
        zero = F.array().cast("array<int>")
        stretches = F.transform(F.sequence(F.lit(0), F.floor((F.size(tokens) - 1) / _STRETCH).cast("int")), lambda k: F.slice(tokens, k * _STRETCH + 1, _STRETCH))

        def running(values: Column, start: Column) -> Column:
            first = F.struct(start.cast("int").alias("now"), zero.alias("all"))

            def add(acc: Column, x: Column) -> Column:
                return F.struct((acc["now"] + x).alias("now"), F.array_append(acc["all"], acc["now"] + x).alias("all"))

            return F.aggregate(values, first, add, lambda acc: acc["all"])

        def laid(parts: Column) -> Column:
            sums = F.transform(parts, lambda p: F.aggregate(p, F.lit(0), lambda a, t: a + step(t)))
            before = F.concat(F.array(F.lit(0)), running(sums, F.lit(0)))
            return F.flatten(F.transform(parts, lambda p, k: running(F.transform(p, step), F.get(before, k))))

        return _bind(stretches, laid)

    def written(tokens: Column) -> Column:
        def one(depth: Column):
            def put(token: Column, k: Column) -> Column:
                line = F.concat(F.lit("\n"), F.repeat(F.lit("  "), F.get(depth, k)))
                empty_ahead, empty_behind = F.get(tokens, k + 1).isin("}", "]"), F.get(tokens, k - 1).isin("{", "[")
                number = F.when(token.rlike("[.eE]"), _float_text(token)).when(token == "-0", "0").otherwise(token)
                first = F.ascii(token)

                def starts(chars: str) -> Column:
                    return first.isin(*map(ord, chars))

                return (
                    F.when(starts('"'), _string_token(token))
                    .when(starts(":"), ": ")
                    .when(starts(","), F.concat(token, line))
                    .when(starts("-0123456789"), number)
                    .when(starts("{["), F.when(empty_ahead, token).otherwise(F.concat(token, line)))
                    .when(starts("}]"), F.when(empty_behind, token).otherwise(F.concat(line, token)))
                    .otherwise(token)
                )

            return F.array_join(F.transform(tokens, put), "")

        return _bind(depths(tokens), one)

    signs = lambda c, these: F.length(c) - F.length(F.translate(c, these, ""))
    blanks = F.lit(" \t\r\n")

    def quick(m: Column) -> Column:
        inner = F.btrim(F.substring(m, F.lit(2), F.length(m) - 2), blanks)
        lines = F.regexp_replace(F.regexp_replace(inner, r"\s*,\s*", ",\n  "), r"\s*:\s*", ": ")
        shown = F.concat(F.substring(m, 1, 1), F.lit("\n  "), lines, F.lit("\n"), F.substring(m, -1, 1))
        return F.replace(F.replace(shown, F.lit(_BACKSLASH), F.lit("\\\\")), F.lit(_QUOTE), F.lit('\\"'))

    def either(m: Column) -> Column:
        # One level without signs in strings, numbered escapes or numbers to rewrite: breaks are put in by replacement.
        def plain(bare: Column) -> Column:
            return (signs(m, "{}[]:,") == signs(bare, "{}[]:,")) & (signs(bare, "{}[]") == 2) & ~bare.rlike(r"[0-9][.eE]|-0(?![0-9])|^.\s*.$")

        simple = ~m.contains("\\u") & ~m.contains("\\/") & _bind(F.regexp_replace(m, '"[^"]*"', ""), plain)
        return F.when(simple, quick(m)).otherwise(_bind(F.regexp_extract_all(m, F.lit(_TOKENS), F.lit(0)), written))

    return F.when(F.try_parse_json(text).isNotNull(), _bind(F.btrim(masked, blanks), either))


def looks_like_json(text: Column) -> Column:
    return (text.startswith("{") & text.endswith("}")) | (text.startswith("[") & text.endswith("]"))


def unescape(text: Column) -> Column:
    for literal, char in (("\\n", "\n"), ("\\t", "\t"), ("\\r", ""), ('\\"', '"')):
        text = F.replace(text, F.lit(literal), F.lit(char))
    return text


def normalise_value(text: Column) -> Column:
    """P10 for text cells: trimmed, JSON indented, literal escapes turned into characters."""
    return _bind(strip(text), lambda t: unescape(F.coalesce(pretty_json(F.when(looks_like_json(t), t)), t)))


def json_or_text(value: Column) -> Column:
    """JSON → VARIANT, anything else → the text as a VARIANT string."""
    return F.coalesce(F.try_parse_json(value), value.cast("variant"))


def variant_text(value: Column) -> Column:
    """A VARIANT as display text: strings as they are, everything else as JSON."""
    return F.try_variant_get(value, "$", "string")


# -- payloads ----------------------------------------------------------------------------------------------------


def _kind(value: Column) -> Column:
    return F.schema_of_variant(value)


def _string(node: Column, path: str) -> Column:
    """The string at a path; NULL for anything that is not a string."""

    def check(v: Column) -> Column:
        return F.when(_kind(v) == "STRING", F.try_variant_get(v, "$", "string"))

    return _bind(F.variant_get(node, path, "variant"), check)


def _content_sql(node: str, depth: int) -> str:
    """SQL for the text of a content node; the node is bound to a lambda variable, so it is computed once."""
    v, x = f"v{depth}", f"x{depth}"
    branches = f"WHEN schema_of_variant({v}) = 'STRING' THEN try_variant_get({v}, '$', 'string')"
    if depth > 0:
        own = f"""element_at(transform(array(variant_get({v}, '$.text', 'variant')), t ->
            CASE WHEN schema_of_variant(t) = 'STRING' THEN nullif(try_variant_get(t, '$', 'string'), '') END), 1)"""
        nested = _content_sql(f"variant_get({v}, '$.content', 'variant')", depth - 1)
        items = f"transform(try_variant_get({v}, '$', 'array<variant>'), {x} -> {_content_sql(x, depth - 1)})"
        branches += f" WHEN startswith(schema_of_variant({v}), 'OBJECT') THEN coalesce({own}, {nested})"
        branches += f" WHEN startswith(schema_of_variant({v}), 'ARRAY') THEN array_join({items}, '')"
    return f"element_at(transform(array({node}), {v} -> coalesce(CASE {branches} END, '')), 1)"


SHALLOW_LEVELS, SHALLOW_BRACKETS = 3, 4


def _deep_content(node) -> str:
    """The text of a content node of any depth, without recursion."""
    out, work = [], [node]
    while work:
        value = work.pop()
        if isinstance(value, str):
            out.append(value)
        elif isinstance(value, list):
            work.extend(reversed(value))
        elif isinstance(value, dict):
            own = value.get("text")
            work.append(own if isinstance(own, str) and own else value.get("content"))
    return "".join(out)


_NESTED = re.compile(r'\s*(?:("(?:[^"\\]|\\.)*")|([{}\[\]:,])|([^\s{}\[\]:,"]+))', re.DOTALL)


def _nested(text: str):
    """A JSON value of any depth: containers wait on a list instead of in calls. Raises ValueError for other text."""
    open_, at, end = [], 0, len(text.rstrip())
    value, key, wanted = None, None, "value"  # ``wanted``: value, first (value or end of a list), name, end (name or end), colon, more
    while at < end:
        found = _NESTED.match(text, at)
        if not found:
            raise ValueError("not JSON")
        string, sign, word = found.groups()
        at = found.end()
        closes = sign in ("}", "]") and open_ and isinstance(open_[-1][0], dict) == (sign == "}")
        if closes and wanted in ("more", "end" if sign == "}" else "first"):
            value, key = open_.pop()
        elif sign == "," and wanted == "more" and open_:
            wanted = "name" if isinstance(open_[-1][0], dict) else "value"
            continue
        elif string and wanted in ("name", "end"):
            key, wanted = json.loads(string), "colon"
            continue
        elif sign == ":" and wanted == "colon":
            wanted = "value"
            continue
        elif wanted not in ("value", "first") or sign in ("}", "]", ":", ","):
            raise ValueError("not JSON")
        elif sign:
            open_.append(({}, key) if sign == "{" else ([], key))
            wanted = "end" if sign == "{" else "first"
            continue
        else:
            value = json.loads(string or word)
        wanted = "more"
        if not open_:
            wanted = "nothing"
        elif isinstance(open_[-1][0], dict):
            open_[-1][0][key] = value
        else:
            open_[-1][0].append(value)
    if open_ or wanted != "nothing":
        raise ValueError("not JSON")
    return value


@F.pandas_udf(T.StringType())
def _deep_payload_text(payloads: pd.Series) -> pd.Series:
    def part(value, *path):
        for name in path:
            value = value.get(name) if isinstance(value, dict) else None
        return value

    def one(payload):
        if payload is None:
            return None
        try:
            root = _nested(payload)
        except ValueError:
            return ""
        choices = part(root, "choices")
        nodes = [part(c, *path) for c in (choices if isinstance(choices, list) else []) for path in (("delta", "content"), ("message", "content"), ("content",))]
        nodes += [part(root, "message", "content"), part(root, "content")]
        plain = part(root, "text")
        texts = (_deep_content(n) for n in nodes)
        return next((t for t in texts if t), plain if isinstance(plain, str) else "")

    return payloads.map(one, na_action="ignore")


def payload_text(payload: str) -> Column:
    """The first non-empty text of a chat payload (a column name or SQL expression).

    Looked for in each choice (delta, message, content), then in the message, the content and the text of the payload.
    A content is a string, an object with ``text`` or ``content``, or a list of such, however deep. Payloads with so few
    brackets that built-in expressions reach every level stay in the JVM; only the others are sent to Python.
    """
    brackets = f"length({payload}) - length(translate({payload}, '[{{', ''))"
    deep = F.expr(f"{brackets} > {SHALLOW_BRACKETS}")
    return F.when(deep, _deep_payload_text(F.when(deep, F.expr(payload)))).otherwise(_shallow_payload_text(payload, SHALLOW_LEVELS))


def _shallow_payload_text(payload: str, depth: int) -> Column:

    def at(node: str, path: str) -> str:
        return f"nullif({_content_sql(f"variant_get({node}, '{path}', 'variant')", depth)}, '')"

    choice = f"coalesce({at('c', '$.delta.content')}, {at('c', '$.message.content')}, {at('c', '$.content')})"
    choices = f"transform(try_variant_get(r, '$.choices', 'array<variant>'), c -> {choice})"
    plain = "CASE WHEN schema_of_variant(variant_get(r, '$.text', 'variant')) = 'STRING' THEN try_variant_get(r, '$.text', 'string') END"
    body = f"""coalesce(try_element_at(filter({choices}, k -> k IS NOT NULL), 1), {at('r', '$.message.content')},
        {at('r', '$.content')}, {plain}, '')"""
    return F.expr(f"element_at(transform(array(try_parse_json({payload})), r -> {body}), 1)")


def reply_text(answer: Column) -> Column:
    """``reply``, else ``content``, else the JSON indented, else the text."""
    text = strip(answer)
    known = _bind(F.try_parse_json(text), lambda root: F.coalesce(_string(root, "$.reply"), _string(root, "$.content")))
    rest = pretty_json(F.when(known.isNull() & F.try_parse_json(text).isNotNull(), text))
    return F.coalesce(known, rest, text, F.lit(""))


# -- query logs --------------------------------------------------------------------------------------------------


def strip_comments(sql: Column) -> Column:
    """Drop ``--`` comments outside single quotes, line by line."""
    line_comment = r"(?s)^((?:[^'-]++|'[^']*+'|-(?!-))*+)--.*$"
    lines = F.transform(F.split(sql, "\n"), lambda line: F.regexp_replace(line, line_comment, "$1"))
    return F.coalesce(F.array_join(lines, "\n"), F.lit(""))


def statement_class(sql: Column) -> Column:
    """Class of a logged statement, comments ignored."""
    bare = F.regexp_replace(F.coalesce(sql, F.lit("")), r"(?s)--[^\n]*(?:\n|\z)|/\*.*?(?:\*/|\z)", " ")
    head = F.ltrim(bare, F.lit(WHITE_SPACE))
    verb = F.upper(F.regexp_extract(head, rf"(?i)^({'|'.join(STATEMENT_VERBS)})\b", 1))
    return (
        F.when(head.rlike(r"(?i)^(SELECT|WITH)\b"), "SELECT")
        .when(head.rlike(r"(?i)^COMMENT\s+ON\b"), "COMMENT")
        .when(head.rlike(r"(?i)^(DECLARE|BEGIN|EXEC|EXECUTE)\b"), "PLSQL")
        .otherwise(F.coalesce(not_blank(verb), F.lit("UNKNOWN")))
    )


def text_key(text: Column) -> Column:
    """The same text with other white space has the same key."""
    return F.regexp_replace(text, r"\s+", " ")


def drop_semicolon(text: Column) -> Column:
    """One trailing ``;`` dropped."""
    return F.when(text.endswith(";"), F.substring(text, F.lit(1), F.length(text) - 1)).otherwise(text)


# -- names -------------------------------------------------------------------------------------------------------


def object_key(name: Column) -> Column:
    """Last dotted part, trimmed, without quotes and trailing ``;``, upper case."""
    bare = F.rtrim(strip(name), F.lit(";"))
    last = F.element_at(F.split(bare, r"\."), -1)
    return F.upper(F.btrim(strip(last), F.lit('"')))


def is_object_name(name: Column) -> Column:
    """P25"""
    return F.coalesce(name.rlike(OBJECT_NAME), F.lit(False))


def is_table_name(name: Column) -> Column:
    """P25, the looser rule for browsing."""
    return F.coalesce(F.upper(name).rlike(TABLE_NAME), F.lit(False))


def type_text(data_type: Column, length: Column, precision: Column, scale: Column) -> Column:
    """``VARCHAR2(20)``, ``NUMBER(10,2)``, ``NUMBER(10)``, ``DATE``."""
    digits = F.concat(
        F.lit("("),
        precision.cast("string"),
        F.when(scale > 0, F.concat(F.lit(","), scale.cast("string"))).otherwise(""),
        F.lit(")"),
    )
    return F.concat(
        data_type,
        F.when(
            data_type.isin("VARCHAR2", "CHAR", "NVARCHAR2", "NCHAR"),
            F.concat(F.lit("("), length.cast("string"), F.lit(")")),
        )
        .when((data_type == "NUMBER") & precision.isNotNull(), digits)
        .otherwise(""),
    )


# -- annotations -------------------------------------------------------------------------------------------------


def filter_annotations(script: Column, has_samples: Column | bool = False) -> Column:
    """Without sample rows, drop the sample annotations; a statement that keeps no item is dropped."""
    statement = r"(?is)^(.*?ANNOTATIONS\s*)\((.*)\)(.*)$"

    def keep(item: Column) -> Column:
        name = F.regexp_extract(item, r'^\s*(?:"([^"]+)"|[A-Za-z0-9_$#]+)', 0)
        return (item != "") & ~F.lower(strip(F.replace(name, F.lit('"'), F.lit("")))).isin(SAMPLE_ANNOTATIONS)

    def one(line: Column) -> Column:
        inner = F.regexp_extract(line, statement, 2)
        items = F.regexp_extract_all(inner, F.lit(r"""(?:'[^']*+'|"[^"]*+"|[^,'"]++)+"""), F.lit(0))
        kept = F.array_join(F.filter(F.transform(items, strip), keep), ", ")
        rebuilt = F.concat(
            F.regexp_extract(line, statement, 1), F.lit("("), kept, F.lit(")"), F.regexp_extract(line, statement, 3)
        )
        return F.when(~line.rlike(statement), line).when(kept != "", rebuilt)

    lines = F.split(F.regexp_replace(script, r"\r\n?", "\n"), "\n")
    filtered = F.array_join(F.filter(F.transform(lines, one), lambda x: x.isNotNull()), "\n")
    keep_all = F.lit(has_samples) if isinstance(has_samples, bool) else has_samples
    return F.when(keep_all, script).otherwise(filtered)
