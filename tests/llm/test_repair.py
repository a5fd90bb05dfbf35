"""Conversation repair against a plain search, and the query against SQL."""

import itertools
import random
import re
import zlib
from hashlib import sha256

import pytest

from tests.harness import TESTDATA, connect, differences
from tramline.llm import queries, repair

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows, costs):
    """rows: (role, text, fault) -> cost, letters, repaired rows; every row state keeps its least (cost, letters)."""
    legal = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
    names = {"u": "user", "a": "assistant"}

    def inserted(best):
        for _ in range(2):
            for state, (cost, audit, out) in list(best.items()):
                for to in "ua":
                    if (state, to) in legal:
                        new = (cost + costs.insert, audit + "I", [*out, (names[to], "")])
                        if to not in best or new[:2] < best[to][:2]:
                            best[to] = new
        return best

    best = {"": (0, "", [])}
    for role, text, fault in rows:
        nxt = {}

        def offer(state, new, nxt=nxt):
            if state not in nxt or new[:2] < nxt[state][:2]:
                nxt[state] = new

        for state, (cost, audit, out) in inserted(best).items():
            offer(state, (cost + costs.delete, audit + "D", out))
            if fault in ("blank", "duplicate"):
                continue
            more = costs.truncated if fault == "truncated" else 0
            if (state, role[:1]) in legal:
                offer(role[:1], (cost + more, audit + "K", [*out, (role, text)]))
            for to in "ua":
                if (state, to) in legal:
                    offer(to, (cost + costs.rerole + more, audit + "R", [*out, (names[to], text)]))
        best = nxt
    return min((best := inserted(best))[s] for s in ("", "a") if s in best)


def expected(turns, costs=None, damaged=True):
    costs = costs or repair.Costs()
    convs = {}
    for conv, turn, role, text in turns:
        kept = convs.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        said = lambda x: " " if x is None else x
        how = zlib.crc32(f"{said(conv)}:{said(turn)}".encode()) % 20 if damaged else 9
        if how == 0:
            continue
        text = "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text
        kept += [(turn, "user" if how == 4 else role, text)] * (2 if how == 3 else 1)
    found = set()
    for conv, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, judged = set(), []
        for _, role, text in rows:
            shown = text.rstrip(" \t\n\x0b\x0c\r")
            fault = "blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else ""
            seen.add((role, text))
            judged.append((role, text, fault))
        turns_seen = {r[0] for r in rows} - {None}
        gaps = max(turns_seen) - min(turns_seen) + 1 - len(turns_seen) if turns_seen else 0
        illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
        cost, audit, out = plain(judged, costs)
        count = lambda k: sum(f == k for *_, f in judged)
        digest = sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
        found.add((conv, gaps, count("blank"), count("duplicate"), count("truncated"), illegal, cost, audit, digest))
    return found


def random_turns(r, convs, most):
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "u", "sage"]
    texts = ["Yes.", "No!", "cut", "", None, "  \n", "a?  ", "Yes.", "é.", "x ", *map(str, range(4))]
    return [
        (r.choice([None, -3, 12])if c == 0 else c, r.choice([None, t, t, t, t // 2]), r.choice(roles), r.choice(texts))
        for c in range(convs) for t in range(r.randint(0, most))
    ]


@pytest.mark.parametrize("seed,block,partitions", [(1, 256, 8), (2, 3, 30), (3, 1, 2)])
def test_against_plain(spark, monkeypatch, seed, block, partitions):
    monkeypatch.setattr(repair, "BLOCK", block)
    turns = random_turns(random.Random(seed), 40, 14)
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        frame = spark.createDataFrame([(*t, "clash") for t in turns], f"{SCHEMA}, key string")
        got = {tuple(r) for r in repair.report(frame).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
    assert got == expected(turns)


@pytest.mark.parametrize("costs", [(1, 2, 5, 5), (3, 9, 1, 2), (0, 1, 1, 0), (2, 7, 3, 1), (4, 4, 2, 9)])
def test_blocks_of_any_size_give_the_same(costs):
    costs = repair.Costs(*costs)
    r = random.Random(5)
    names = {0: "x", 1: "s", 2: "u", 3: "a"}
    faults = {0: "", 1: "blank", 2: "duplicate", 3: "truncated"}
    for _ in range(300):
        codes = [r.choice([0, 4, 8, 12, 8, 12, 13, 6, 11, 15]) for _ in range(r.randint(0, 9))]
        wanted = plain([(names[c // 4], f"{k}", faults[c % 4]) for k, c in enumerate(codes)], costs)
        for size in (1, 2, 4, 9):
            parts = [codes[k : k + size] for k in range(0, len(codes), size)]
            cost, found, ending = repair.joined_ways([repair.block_ways(p, costs) for p in parts], len(codes), costs)
            assert (cost, "".join(x for _, x in found) + ending) == wanted[:2]
            out = []
            for k, (part, (state, letters)) in enumerate(zip(parts, found)):
                out += [(e["role"] or names[part[e["row"]] // 4], "" if e["row"] is None else str(k * size + e["row"])) for e in repair.repaired_entries(part, state, letters)]
            short = lambda rows: [(role[0], text) for role, text in rows]
            assert short(out) == short(wanted[2][: len(wanted[2]) - len(ending)])


def test_insertions_reach_the_rows(spark, monkeypatch):
    monkeypatch.setattr(repair, "BLOCK", 2)
    turns = [(1, 0, "system", "A."), (2, 0, "assistant", "B."), (2, 1, "assistant", "C."), (3, 0, "user", "D."), (3, 1, "user", "E."), (4, 0, "tool", "F.")]
    costs = repair.Costs(rerole=9, delete=20, insert=1)
    done = repair.Repair(spark.createDataFrame(turns, SCHEMA), costs)
    audits = {r["key"]: (r["cost"], r["audit"]) for r in done.plans.collect()}
    assert audits == {"=1": (2, "KII"), "=2": (2, "IKIK"), "=3": (2, "KIKI"), "=4": (10, "IR")}
    rows = done.repaired.orderBy("key", "block", "at").collect()
    assert [(r["key"], r["role"], r["text"]) for r in rows] == [
        ("=1", "system", "A."), ("=1", "user", ""), ("=1", "assistant", ""), ("=2", "user", ""), ("=2", "assistant", "B."), ("=2", "user", ""),
        ("=2", "assistant", "C."), ("=3", "user", "D."), ("=3", "assistant", ""), ("=3", "user", "E."), ("=3", "assistant", ""),
        ("=4", "user", ""), ("=4", "assistant", "F."),
    ]


def test_a_conversation_over_many_partitions(spark):
    r = random.Random(9)
    turns = [(7, t // 3, r.choice(["user", "assistant", "system"]), f"{t % 900}{r.choice(['.', '', '!'])}") for t in range(4000)] + [(8, 0, "user", "Hi.")]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {tuple(x) for x in repair.report(spark.createDataFrame(turns, SCHEMA)).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == expected(turns)


def test_empty_table_and_dropped_rows(spark):
    assert repair.report(spark.createDataFrame([], SCHEMA)).collect() == []
    dropped = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    got = [tuple(r) for r in repair.report(spark.createDataFrame([(dropped, 0, "user", "Hi.")], SCHEMA)).collect()]
    assert got == [(dropped, 0, 0, 0, 0, 0, 0, "", sha256(b"").hexdigest())]


def test_costs_are_checked():
    with pytest.raises(ValueError, match="insertion"):
        repair.Costs(insert=0)


def test_query_equals_sql(spark):
    folder = f"{TESTDATA}/sf0.01"
    name = "op13_conversation_repair"
    assert differences(queries.QUERIES[name](spark, folder), connect(folder), queries.SQL[name]) is None
