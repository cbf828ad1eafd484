"""Turn repair against all edits of small conversations."""

import hashlib
import random
import re
import zlib
from functools import cache

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from silverlode.llm import turn_repair as tr
from silverlode.llm.queries import QUERIES
from tests.conftest import SF

SCHEMA = "conv_id long, turn long, role string, text string, conv string, gone string, fault string, print int, behind string, deal double, kind string, copies string"
GRAMMAR = re.compile(r"(s?(ua)+)?\Z")


def cheapest(rows):
    """(cost, audit, turns) by trying all edits of rows (role, text, fault), least audit among the cheapest."""
    best = [10**9, "", []]

    def go(i, cost, audit, out, inserted):
        if cost > best[0]:
            return
        if i == len(rows) and GRAMMAR.match("".join(r[:1] or "?" for r, _ in out)):
            if (cost, audit) < (best[0], best[1]):
                best[:] = [cost, audit, out]
        if inserted < 2 and len(out) <= len(rows) + 2:
            for role in ("user", "assistant"):
                go(i, cost + 5, audit + "I", [*out, (role, "")], inserted + 1)
        if i < len(rows):
            role, text, fault = rows[i]
            go(i + 1, cost + 2, audit + "D", out, 0)
            if fault not in "BD":
                more = 5 * (fault == "T")
                go(i + 1, cost + more, audit + "K", [*out, (role, text)], 0)
                for new in ("user", "assistant"):
                    go(i + 1, cost + 1 + more, audit + "R", [*out, (new, text)], 0)

    go(0, 0, "", [], 0)
    return tuple(best)


def visible(text):
    return re.findall(r"[^\x20\x09-\x0d]", text)


def marked(rows):
    seen, out = set(), []
    for role, text in rows:
        chars = visible(text)
        out.append("B" if not chars else "D" if (role, text) in seen else "T" if chars[-1] not in ".!?" else "-")
        seen.add((role, text))
    return out


def spoiled(rows):
    """Rows after damage, by turn with nulls first, equal turns by role and text checksum."""
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).hexdigest()))


def expected(rows, solve):
    """Result rows of the query, with ``solve(roles and texts, faults) -> (cost, audit, turns)``."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = spoiled([r for r in rows if r[0] == conv])
        turns = [t for t, _, _ in own if t is not None]
        pairs = [(r, t) for _, r, t in own]
        kinds = marked(pairs)
        cost, audit, after = solve(pairs, kinds)
        legal = {"su", "ua", "au"}
        initials = [r[:1] for r, _ in pairs]
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, kinds.count("B"), kinds.count("D"), kinds.count("T"),
            sum(a + b not in legal for a, b in zip(initials, initials[1:])), cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in after).encode()).hexdigest(),
        )
    return out


def by_trying(pairs, kinds):
    return cheapest([(r, t, k) for (r, t), k in zip(pairs, kinds)])


def by_states(pairs, kinds):
    cost, audit = tr.repair_long("".join(r[:1] or "?" for r, _ in pairs), "".join(kinds))
    return cost, audit, list(tr.repaired(audit, iter(pairs)))


TURNS = st.lists(st.tuples(st.sampled_from("suax"), st.sampled_from("---TBD")), max_size=5)
MANY = st.lists(st.tuples(st.sampled_from("suauaax"), st.sampled_from("-----TBD")), max_size=60)


@settings(max_examples=300, deadline=None)
@given(TURNS)
def test_all_edits(turns):
    rows = [({"s": "system", "u": "user", "a": "assistant", "x": "tool"}[i], f"t{k}", f) for k, (i, f) in enumerate(turns)]
    initials, faults = "".join(i for i, _ in turns), "".join(f for _, f in turns)
    cost, audit, after = cheapest(rows)
    assert tr.repair(initials, faults) == (cost, audit) == tr.repair_long(initials, faults)
    assert list(tr.repaired(audit, iter([r[:2] for r in rows]))) == after


@settings(max_examples=300, deadline=None)
@given(MANY)
def test_bands_and_states_agree(turns):
    initials, faults = "".join(i for i, _ in turns), "".join(f for _, f in turns)
    assert tr.repair(initials, faults) == tr.repair_long(initials, faults)
    assert tr.repair(initials, faults)[0] <= tr.greedy(initials, faults)


@pytest.mark.parametrize("n", [tr.LONG - 1, tr.LONG, tr.LONG + 1, tr.LONG + 2])
def test_both_ways_at_the_switch(n):
    rng = random.Random(n)
    initials = "".join(rng.choice("sx") if rng.random() < 0.05 else "ua"[(k + (rng.random() < 0.1)) % 2] for k in range(n))
    faults = "".join(rng.choice("BDT") if rng.random() < 0.15 else "-" for _ in range(n))
    assert tr.repair(initials, faults) == tr.repair_long(initials, faults)


def conversations():
    rng, rows = random.Random(5), []
    for conv in range(60):
        roles = rng.choice([["user", "assistant"], ["user", "assistant", "tool"], ["assistant"], ["User", "bot"]])
        for turn in range(rng.randint(0, 5)):
            role = "system" if turn == 0 and rng.random() < 0.3 else roles[turn % len(roles)]
            rows.append((conv, turn + (turn > 2 and rng.random() < 0.2), role, rng.choice(["Yes.", "No!", "why?  \n", "cut off", "", " \t", "日本。", "a.b", f"t{turn}."])))
    rows += [(70, None, "user", "a."), (70, None, "assistant", "b."), (70, 3, None, None), (71, None, None, "x."), (None, 0, "user", "q?"), (None, 1, "assistant", "r."), (72, 1, "user", "same."), (72, 1, "user", "same.")]
    return [*rows, (73, 2, "", "x."), (73, 3, "assistant", "y." + "z" * 100_000)]


def turns_table(spark, rows):
    return spark.createDataFrame([(*r, "c", "g", "f", 1, "b", 2.0, "k", "x") for r in rows], SCHEMA).repartition(3)


def repaired(spark, rows):
    held = tr.damaged(tr.prepared(turns_table(spark, rows)))
    audited = tr.audits(tr.faults(held)).cache()
    sums = {r.conv: r.repaired_sha256 for r in tr.digests(held, audited).collect()}
    return {r.conv: (*tuple(r)[1:], sums[r.conv]) for r in audited.collect()}, tr.edited(held, audited)


def test_odd_rows(spark):
    rows = conversations()
    got, turns = repaired(spark, rows)
    assert got == expected(rows, by_trying)
    after = {}
    for r in sorted(turns.collect(), key=lambda r: r.turn_no):
        after.setdefault(r.conv, []).append(f"{r.role}:{r.text}")
    assert {c: hashlib.sha256("\n".join(after.get(c, [])).encode()).hexdigest() for c in got} == {c: x[-1] for c, x in got.items()}


def test_one_long_conversation(spark):
    rng = random.Random(8)
    rows = [(1, k, rng.choice(["user", "assistant"]) if rng.random() < 0.1 else ["user", "assistant"][k % 2], f"turn {k % 2000}.") for k in range(6000)]
    rows += [(2, 0, "user", "a."), (2, 1, "assistant", "b.")]
    assert repaired(spark, rows)[0] == expected(rows, by_states)


def test_empty_table(spark):
    assert repaired(spark, [])[0] == {}


def test_query(spark):
    df = QUERIES["op13_turn_repair"][0](spark, SF)
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: tuple(r)[1:] for r in df.collect()}
    assert got == expected(rows, by_states)
    assert df.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
