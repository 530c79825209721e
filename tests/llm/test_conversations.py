"""Conversation repair against a plain search over all edits."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from enrichkit.llm import conversations as op
from enrichkit.llm import queries

SF = "/root/testdata/sf0.001"
WS = " \t\n\x0b\x0c\r"


def damage(rows):
    for conv, turn, role, text in rows:
        case = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if case == 1:
            text = ""
        if case == 2:
            text = re.sub("[.!?]", "", text)
        if case == 4:
            role = "user"
        for _ in range({0: 0, 3: 2}.get(case, 1)):
            yield conv, turn, role, text


def search(rows):
    """(cost, letters, edits) of the cheapest, least audit for rows (fault, initial): every edit from every state."""
    n, step, role = len(rows), {0: 2, 1: 2, 2: 3, 3: 2}, {0: "u", 1: "u", 2: "a", 3: "u"}
    best = {(n, s): (0, "", ()) if s in (0, 3) else (10**9, "", ()) for s in range(4)}

    def insert(i):
        for _ in range(4):
            for s in range(4):
                cost, letters, edits = best[i, step[s]]
                best[i, s] = min(best[i, s], (cost + 3, "I" + letters, (("I", role[s]), *edits)))

    insert(n)
    for i in range(n - 1, -1, -1):
        fault, initial = rows[i]
        for s in range(4):
            ways = [(4, "D", s, None)]
            if fault in ("", "truncated"):
                cut = 3 * (fault == "truncated")
                ways.append((3 + cut, "R", step[s], role[s]))
                if s == 0 and initial == "s":
                    ways.append((cut, "K", 1, None))
                if initial == role[s]:
                    ways.append((cut, "K", step[s], None))
            found = []
            for cost, letter, to, new in ways:
                rest = best[i + 1, to]
                found.append((cost + rest[0], letter + rest[1], ((letter, new), *rest[2])))
            best[i, s] = min(found)
        insert(i)
    return best[0, 0]


def brute(rows):
    """The contract, row by row, of damaged rows; rows: conv -> its rows."""
    out = []
    for conv, mine in rows.items():
        mine = sorted(mine, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).hexdigest()))
        seen, judged = set(), []
        for _, _, role, text in mine:
            if not text.strip(WS):
                fault = "blank"
            elif (role, text) in seen:
                fault = "duplicate"
            else:
                fault = "" if text.rstrip(WS)[-1] in ".!?" else "truncated"
            seen.add((role, text))
            judged.append((fault, role[:1]))
        cost, letters, edits = search(judged)
        left, made = iter(mine), []
        for letter, new in edits:
            long = {"u": "user", "a": "assistant", None: None}[new]
            if letter == "I":
                made.append(f"{long}:")
            else:
                _, _, role, text = next(left)
                made += [] if letter == "D" else [f"{long or role}:{text}"]
        turns = {r[1] for r in mine if r[1] is not None}
        initials = [i for _, i in judged]
        out.append((
            conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            *(sum(f == k for f, _ in judged) for k in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)),
            cost, letters, hashlib.sha256("\n".join(made).encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


SCHEMA = "conv long, turn long, role string, text string"


def found(df):
    return sorted((tuple(r) for r in op.report(df.select("conv"), df).collect()), key=repr)


def by_conv(rows):
    out = defaultdict(list)
    for r in rows:
        out[r[0]].append(r)
    return out


def made_up(seed, convs=40, longest=12):
    r = random.Random(seed)
    texts = ["Yes.", "No!", "cut off", "", " \t", "Why? \n", "One more.", "and"]
    for c in range(convs):
        for t in range(r.randint(0, longest)):
            role = r.choice(["user", "assistant"]) if r.random() < 0.3 else ("user", "assistant")[t % 2]
            role = "system" if t == 0 and r.random() < 0.4 else r.choice(["tool", "", "system", "s"]) if r.random() < 0.1 else role
            text = r.choice(texts) if r.random() < 0.4 else f"Text {t} of {c}."
            yield (None if c == 3 else c, None if r.random() < 0.05 else t, role, text)


@pytest.mark.parametrize("seed", [1, 2])
def test_cheapest_and_least(spark, seed):
    rows = list(made_up(seed))
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(3)) == brute(by_conv(rows))


@pytest.mark.parametrize("chunk", [1, 7])
def test_chunks_join_to_the_same_repair(spark, monkeypatch, chunk):
    """Conversations over many chunks and partitions, also with rows that keep vectors apart."""
    monkeypatch.setattr(op, "CHUNK", chunk)
    monkeypatch.setattr(op, "MARK", 2)
    rows = list(made_up(5, 6, 60)) + [(100, t, ("user", "assistant")[t % 2], f"Fine {t}.") for t in range(60)]
    rows += [(101, t, "tool", f"None {t}.") for t in range(40)] + [(102, t, "user", "Same.") for t in range(40)]
    rows += [(103, None, "assistant", f"No turn {t % 9}.") for t in range(50)]
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(4)) == brute(by_conv(rows))


def test_given_conversations(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = {r[0]: [] for r in rows} | by_conv(damage(rows))
    got = queries.op12_conversation_repair(spark, SF)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(want)


def test_damage_of_awkward_rows(spark):
    rows = [(c, t, r, x) for c in (None, 1, 2, 3) for t in (None, 0, 1, 2, 5) for r in (None, "user", "s") for x in (None, "", "A. b!")]
    df = spark.createDataFrame(rows, SCHEMA.replace("conv ", "conv_id ")).withColumn("case", F.lit(1)).withColumn("col", F.lit(2))
    got = [tuple(r) for r in op.damaged(df).collect()]
    assert sorted(got, key=repr) == sorted(damage(rows), key=repr)


def test_empty_tables_and_lost_conversations(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert found(none) == []
    lost = op.report(spark.createDataFrame([(1,), (None,)], "conv long"), none).collect()
    assert [tuple(r)[1:] for r in lost] == [(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())] * 2


def test_repaired_rows_are_legal(spark):
    rows = list(made_up(9))
    edited, _, _ = op.repair(spark.createDataFrame(rows, SCHEMA))
    by = defaultdict(list)
    for r in op.repaired_rows(edited).orderBy("number", "at", "step").collect():
        by[r.conv].append(r.role[:1])
    assert all(re.fullmatch("(s?(ua)+)?", "".join(x)) for x in by.values())


def test_a_rerun_stops_where_the_vectors_meet():
    costs = op._Costs()
    codes = bytes([1, 2] * 500)
    _, _, marks = costs.backward(codes, op.UNKNOWN)
    calls = []
    costs.before = lambda v, c, f=costs.before: calls.append(1) or f(v, c)
    left, total, again = costs.backward(codes, (5, 5, 0, 5), marks)
    assert len(calls) <= 2 * op.MARK
    fresh = op._Costs().backward(codes, (5, 5, 0, 5))
    assert (left, total) == fresh[:2] and (again == fresh[2]).all()
