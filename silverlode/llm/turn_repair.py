"""Conversation structure repair: the cheapest edits that make the turns alternate, with an audit of them.

A conversation is well formed if the initials of its roles are nothing, or an optional system turn and then pairs of user
and assistant turns: ``(s?(ua)+)?``. Rows have at most one fault, the first of: blank (no visible character), duplicate
(role and text seen earlier in the conversation), truncated (the last visible character is none of ``.!?``).

A row is kept (cost 0), given the role user or assistant (1) or deleted (2; blank and duplicate rows always); an empty turn
is inserted for 5; a truncated row that is not deleted adds 5. For every length the grammar has one target string, and
the turns are aligned to each feasible one by the Wagner-Fischer recurrence. All targets end alike, so their tables are
one: the cost of turning the rows from ``i`` on into the last ``r`` symbols. A greedy repair gives the first incumbent cost,
and only cells whose count of deletions or insertions can stay within it are filled (Ukkonen's band). The cheapest
lengths are traced, at each step by the least letter of ``D I K R`` that stays cheapest, and the least audit wins.

The band is as wide as the incumbent, so a conversation of more than ``LONG`` rows is aligned to all lengths at once by the
grammar's four states instead, which is linear; tests hold both against each other.

On Spark, rows are damaged (``damaged``) and their faults found by built-in functions; duplicates by ranking rows of one
conversation, role and text checksum, which splits even one huge conversation. Alignment needs one letter per row, in the
order of the turns: rows without texts are dealt by conversation, sorted and streamed. Texts are sent once more, behind
the conversation's edits, and go through the checksum row by row; a task holds one text and one letter per row of one
conversation. (A checksum over a conversation has to be computed in order, so that step is one task per conversation.)

Null role, text, and id or turn in the damage key, read as one space. Turns are ordered with nulls first, equal turns by role,
then by the text's checksum. Rows with null conversation ids are one conversation. Repeated rows are duplicates. An empty table
gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from silverlode.llm.common import table, written

#: The costs.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
LONG = 1000
NEVER = 1 << 60
USER, ASSISTANT = "user", "assistant"
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}
VISIBLE = r"[^\x20\x09-\x0D]"


# -- alignment of one conversation ----------------------------------------------------------------------------------------


def symbol(left: int) -> str:
    """The grammar's symbol when ``left`` are still to come."""
    return "a" if left % 2 else "u"


def staying(initial: str, fault: str, wanted: str) -> tuple[int, str]:
    """Cost and letter of using a row for a symbol; a system turn is never made, only kept."""
    if fault in "BD":
        return NEVER, ""
    more = TRUNCATED if fault == "T" else 0
    return (KEEP + more, "K") if initial == wanted else (NEVER, "") if wanted == "s" else (REROLE + more, "R")


def greedy(initials: str, faults: str) -> int:
    """Cost of one repair: sound rows alternate, by a new role where needed, and an odd last one is deleted."""
    cost, used, system = 0, 0, False
    for initial, fault in zip(initials, faults):
        if fault != "-":
            cost += DELETE
        elif initial == "s" and not used and not system:
            system = True
        else:
            cost += REROLE * (initial != "ua"[used % 2])
            used += 1
    cost += DELETE * (used % 2)
    return cost + DELETE * (system and used < 2)


def _bands(faults: str, most: int) -> list[range]:
    """Per row, the numbers of symbols that the rows from it on can still become within the incumbent cost."""
    sound = short = forced = 0
    suffix = [(0, 0, 0)]
    for fault in reversed(faults):
        sound, short, forced = sound + (fault == "-"), short + (fault == "T"), forced + (fault != "-")
        suffix.append((sound, short, forced))
    spare = most - DELETE * forced
    out = []
    for sound, short, _ in reversed(suffix):
        kept = min(short, spare // (TRUNCATED - DELETE))
        up = kept + (spare - (TRUNCATED - DELETE) * kept) // INSERT
        out.append(range(max(0, sound - spare // DELETE), sound + up + 1))
    return out


def repair(initials: str, faults: str) -> tuple[int, str]:
    """Cost and audit, aligned to every feasible length. ``faults``: ``B D T`` or ``-`` per row."""
    m = len(initials)
    most = greedy(initials, faults)
    bands = _bands(faults, most)
    # ``costs``: into the last r symbols of any target; ``opened``: into the whole of an odd one, its system turn included.
    costs: list[list[int]] = [[] for _ in range(m + 1)]
    opened: list[list[int]] = [[] for _ in range(m + 1)]
    costs[m] = [INSERT * r for r in bands[m]]
    opened[m] = [NEVER] * len(bands[m])

    def at(rows: list[list[int]], i: int, r: int) -> int:
        k = r - bands[i].start
        return rows[i][k] if 0 <= k < len(rows[i]) else NEVER

    for i in range(m - 1, -1, -1):
        initial, fault = initials[i], faults[i]
        use = [staying(initial, fault, symbol(r))[0] for r in (0, 1)]
        system = staying(initial, fault, "s")[0]
        here, first = [], []
        for r in bands[i]:
            best = DELETE + at(costs, i + 1, r)
            if r:
                best = min(best, use[r % 2] + at(costs, i + 1, r - 1), INSERT + (here[-1] if here else NEVER))
            here.append(min(best, NEVER))
            first.append(min(NEVER, DELETE + at(opened, i + 1, r), system + at(costs, i + 1, r - 1)))
        costs[i], opened[i] = here, first
    lengths = [(at(costs, 0, r), False, r) for r in bands[0] if r % 2 == 0]
    lengths += [(at(opened, 0, r), True, r) for r in bands[0] if r % 2 and r > 1]
    best = min(c for c, *_ in lengths)

    def traced(system: bool, r: int) -> str:
        i, out = 0, []
        while i < m or r:
            left = at(opened if system else costs, i, r)
            if i < m and DELETE + at(opened if system else costs, i + 1, r) == left:
                out.append("D")
                i += 1
            elif not system and r and INSERT + at(costs, i, r - 1) == left:
                out.append("I")
                r -= 1
            else:
                out.append(staying(initials[i], faults[i], "s" if system else symbol(r))[1])
                i, r, system = i + 1, r - 1, False
        return "".join(out)

    return best, min(traced(system, r) for c, system, r in lengths if c == best)


#: The grammar's states: nothing yet, after the system turn, before an assistant turn, after one; and their moves.
MOVES = {0: (("s", 1), ("u", 2)), 1: (("u", 2),), 2: (("a", 3),), 3: (("u", 2),)}


def repair_long(initials: str, faults: str) -> tuple[int, str]:
    """The same for a conversation of any length: costs per row and state, then the least letters from the front."""
    m = len(initials)
    costs = [[NEVER] * 4 for _ in range(m + 1)]

    def insertions(row: list[int]) -> None:
        for _ in range(3):
            for state, moves in MOVES.items():
                row[state] = min([row[state], *(INSERT + row[to] for wanted, to in moves if wanted != "s")])

    costs[m] = [0, NEVER, NEVER, 0]
    insertions(costs[m])
    for i in range(m - 1, -1, -1):
        ahead = costs[i + 1]
        for state, moves in MOVES.items():
            costs[i][state] = min([NEVER, DELETE + ahead[state], *(staying(initials[i], faults[i], wanted)[0] + ahead[to] for wanted, to in moves)])
        insertions(costs[i])
    i, state, out = 0, 0, []
    while i < m or costs[m][state]:
        left, options = costs[i][state], []
        if i < m and DELETE + costs[i + 1][state] == left:
            options.append(("D", i + 1, state))
        for wanted, to in MOVES[state]:
            if wanted != "s" and INSERT + costs[i][to] == left:
                options.append(("I", i, to))
            if i < m:
                cost, letter = staying(initials[i], faults[i], wanted)
                if letter and cost + costs[i + 1][to] == left:
                    options.append((letter, i + 1, to))
        letter, i, state = min(options)
        out.append(letter)
    return costs[0][0], "".join(out)


def repaired(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """The turns after the edits; rows are taken one by one."""
    left = len(audit) - audit.count("D")
    left -= left % 2
    system = len(audit) - audit.count("D") - left
    for letter in audit:
        if letter == "I":
            yield (USER if symbol(left) == "u" else ASSISTANT), ""
            left -= 1
            continue
        role, text = next(rows)
        if letter == "D":
            continue
        yield ((USER if symbol(left) == "u" else ASSISTANT) if letter == "R" else role), text
        left, system = (left, 0) if system else (left - 1, 0)


# -- on Spark -------------------------------------------------------------------------------------------------------------


def prepared(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(``conv``, ``turn``, ``role``, ``text``, ``gone``): rows as they are, nulls as one space; none is gone."""
    blank = F.lit(" ")
    return turns.select(
        F.col(conversation).alias("conv"), F.col(turn).alias("turn"), F.coalesce(F.col(role), blank).alias("role"), F.coalesce(F.col(text), blank).alias("text"), F.lit(False).alias("gone"),
    )


def damaged(rows: DataFrame) -> DataFrame:
    """Faults put into prepared rows by the checksum of conversation and turn: one in twenty of each of five kinds."""
    blank = F.lit(" ")
    kind = F.crc32(F.concat(F.coalesce(F.col("conv").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank)).cast("binary")) % 20
    return (
        rows.withColumn("kind", kind)
        .withColumn("gone", F.col("kind") == 0)
        .withColumn("text", F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")))
        .withColumn("role", F.when(F.col("kind") == 4, F.lit(USER)).otherwise(F.col("role")))
        .withColumn("copies", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
        .select("conv", "turn", "role", "text", "gone")
    )


def faults(rows: DataFrame) -> DataFrame:
    """Rows without texts: ``conv``, ``turn``, ``role``, ``print`` (the text's checksum), ``gone``, ``fault``."""
    shape = F.when(~F.col("text").rlike(VISIBLE), "B").when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), "T").otherwise("-")
    light = rows.select("conv", "turn", "role", F.md5(F.col("text").cast("binary")).alias("print"), "gone", shape.alias("shape"))
    earlier = F.row_number().over(W.partitionBy("conv", "role", "print", "gone").orderBy(F.col("turn").asc_nulls_first()))
    return light.withColumn("fault", F.when((F.col("shape") != "B") & (earlier > 1), "D").otherwise(F.col("shape"))).drop("shape")


def _streamed(df: DataFrame, *order) -> DataFrame:
    """Rows of a conversation together in one task, in order; conversations are told apart by a hash and the id."""
    return df.withColumn("deal", F.xxhash64("conv")).repartition("deal").sortWithinPartitions("deal", F.col("conv").asc_nulls_first(), *order)


AUDITED = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def audits(marked: DataFrame) -> DataFrame:
    """Per conversation: counts of faults, cost and audit."""
    names = [x.split()[0] for x in AUDITED.split(", ")]
    kinds = [pa.int64()] * 6 + [pa.string()]

    def summed(turns: list, roles: str, kinds_: str) -> list:
        cost, audit = repair(roles, kinds_) if len(roles) <= LONG else repair_long(roles, kinds_)
        gaps = turns[1] - turns[0] + 1 - turns[2] if turns[2] else 0
        illegal = sum(x not in LEGAL for x in zip(roles, roles[1:]))
        return [gaps, kinds_.count("B"), kinds_.count("D"), kinds_.count("T"), illegal, cost, audit]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, turns, roles, found = None, [0, 0, 0], bytearray(), bytearray()

        for batch in batches:
            ids, out = [], []
            convs, deals = batch.column("conv"), batch.column("deal").to_pylist()
            for i, (conv, turn, initial, gone, fault) in enumerate(zip(convs.to_pylist(), *(batch.column(c).to_pylist() for c in ("turn", "initial", "gone", "fault")))):
                if now != (deals[i], conv):
                    if now is not None:
                        ids.append(now[1])
                        out.append(summed(turns, roles.decode("latin-1"), found.decode()))
                    now, turns, roles, found = (deals[i], conv), [0, 0, 0], bytearray(), bytearray()
                if gone:
                    continue
                if turn is not None and not (turns[2] and turn == turns[1]):
                    turns = [turn if not turns[2] else turns[0], turn, turns[2] + 1]
                roles += initial.encode()
                found += fault.encode()
            yield pa.RecordBatch.from_arrays([pa.array(ids, convs.type), *(pa.array([x[k] for x in out], t) for k, t in enumerate(kinds))], names=["conv", *names])
        if now is not None:
            last = summed(turns, roles.decode("latin-1"), found.decode())
            yield pa.RecordBatch.from_arrays([pa.array([now[1]], convs.type), *(pa.array([x], t) for x, t in zip(last, kinds))], names=["conv", *names])

    initial = F.substring("role", 1, 1)
    light = marked.select("conv", "turn", "role", "print", "gone", "fault", F.when(initial.isin("s", "u", "a"), initial).otherwise("x").alias("initial"))
    # Of equal rows of one turn the first is no duplicate.
    sorted_ = _streamed(light, F.col("turn").asc_nulls_first(), "role", "print", F.col("fault") == "D").select("deal", "conv", "turn", "initial", "gone", "fault")
    return sorted_.mapInArrow(run, f"conv {marked.schema['conv'].dataType.simpleString()}, {AUDITED}")


def edited(rows: DataFrame, audited: DataFrame) -> DataFrame:
    """(``conv``, ``turn_no``, ``role``, ``text``): the repaired conversations, turns numbered from 0."""
    return _walk(rows, audited, True)


def digests(rows: DataFrame, audited: DataFrame) -> DataFrame:
    """(``conv``, ``repaired_sha256``): of the repaired ``role:text``, joined by line feeds."""
    return _walk(rows, audited, False)


def _walk(rows: DataFrame, audited: DataFrame, spelled: bool) -> DataFrame:
    """The edits of a conversation come first, its rows stream by behind them."""
    kind = rows.schema["conv"].dataType.simpleString()
    light = rows.where(~F.col("gone")).select("conv", F.lit(1).alias("behind"), "turn", "role", F.md5(F.col("text").cast("binary")).alias("print"), "text")
    heads = audited.select("conv", F.lit(0).alias("behind"), F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"), F.lit("").alias("role"), F.lit("").alias("print"), F.col("audit").alias("text"))
    sorted_ = _streamed(heads.union(light), "behind", F.col("turn").asc_nulls_first(), "role", "print").select("conv", "behind", "role", "text")

    def conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                yield from zip(*(c.to_pylist() for c in part.columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream, held = conversations(batches), []

        def flush() -> pa.RecordBatch:
            columns = [pa.array(x, f.type) for x, f in zip(zip(*held), schema)] if held else [pa.array([], f.type) for f in schema]
            held.clear()
            return pa.RecordBatch.from_arrays(columns, names=schema.names)

        size = 0
        for conv, _, _, audit in stream:
            behind = ((role, text) for _, _, role, text in stream)
            total, first = hashlib.sha256(), True
            for number, (role, text) in enumerate(repaired(audit, behind)):
                if spelled:
                    held.append((conv, number, role, text))
                    size += len(text)
                else:
                    total.update(f"{'' if first else chr(10)}{role}:{text}".encode())
                    first = False
                if size > 1 << 22:
                    yield flush()
                    size = 0
            if not spelled:
                held.append((conv, total.hexdigest()))
            if len(held) >= 4096:
                yield flush()
        yield flush()

    ddl = f"conv {kind}, turn_no long, role string, text string" if spelled else f"conv {kind}, repaired_sha256 string"
    schema = to_arrow_schema(StructType.fromDDL(ddl))
    return sorted_.mapInArrow(run, ddl)


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation of ``conversations`` after damage: faults, cost, audit and the checksum of the repaired turns."""
    rows = damaged(prepared(table(spark, sf_dir, "conversations")))
    audited = written(audits(faults(rows)), "audits")
    return audited.join(digests(rows, audited).withColumnRenamed("conv", "of"), F.col("conv").eqNullSafe(F.col("of")), "left").select(
        F.col("conv").alias("conv_id"), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"
    )


QUERIES = {"op13_turn_repair": (op13_turn_repair, None)}
