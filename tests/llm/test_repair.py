"""Conversation repair against all edits, other code and SQL."""

import hashlib
import itertools
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from oracle import compare, connect

from riskloom.llm import audits, repair
from riskloom.llm.sql import REPAIR

ORDER = re.compile("(s?(ua)+)?")
GAPS = ["", "u", "a", "ua", "au"]


def every_edit(codes):
    """Cost and letters of all edits with up to two inserts in a place that give the role order."""
    ways = []
    for c in codes:
        more = 5 if c.isupper() else 0
        ways.append([("", 2, "D")] if c == "d" else [("", 2, "D"), (c.lower(), more, "K"), ("u", 1 + more, "R"), ("a", 1 + more, "R")])
    for gaps in itertools.product(GAPS, repeat=len(codes) + 1):
        for way in itertools.product(*ways):
            roles = gaps[0] + "".join(w[0] + g for w, g in zip(way, gaps[1:], strict=True))
            if ORDER.fullmatch(roles):
                yield 5 * sum(map(len, gaps)) + sum(w[1] for w in way), "I" * len(gaps[0]) + "".join(w[2] + "I" * len(g) for w, g in zip(way, gaps[1:], strict=True))


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_cheapest_equals_all_edits(n):
    codes = ["".join(c) for c in itertools.product("uasxUAd", repeat=n)]
    for c in codes if n < 3 else codes[::9]:
        assert audits.cheapest(c) == min(every_edit(c)), c


def plain(codes):
    """The same program with whole strings."""
    best = {0: (0, "")}

    def insert(best):
        for _ in range(2):
            for s, (cost, text) in list(best.items()):
                t = 3 if s == 2 else 2
                best[t] = min(best.get(t, (10**9, "")), (cost + 5, text + "I"))

    for c in codes:
        insert(best)
        out, more = {}, 5 if c.isupper() else 0
        for s, (cost, text) in best.items():
            steps = [(s, cost + 2, "D")]
            if c != "d":
                steps.append((3 if s == 2 else 2, cost + 1 + more, "R"))
                kept = {"u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}, "s": {0: 1}}.get(c.lower(), {})
                if s in kept:
                    steps.append((kept[s], cost + more, "K"))
            for t, new, letter in steps:
                out[t] = min(out.get(t, (10**9, "")), (new, text + letter))
        best = out
    insert(best)
    return min(best[s] for s in (0, 3) if s in best)


@settings(max_examples=200, deadline=None)
@given(st.text("uasxUASXd", max_size=60), st.integers(1, 20))
def test_long_codes_and_cut_runs(codes, run):
    assert audits.cheapest(codes) == plain(codes)
    pieces = [codes[i : i + run] for i in range(0, len(codes), run)] or [""]
    table = audits.segment(pieces[0], len(pieces) == 1)
    for i, p in enumerate(pieces[1:], 2):
        table = audits.joined(table, audits.segment(p, i == len(pieces)))
    assert min(table[0, s] for s in (0, 3) if (0, s) in table) == audits.cheapest(codes)


def test_colliding_hashes_are_verified(monkeypatch):
    monkeypatch.setattr(audits, "_PRIME", 1)
    for codes in ("xuasUAdxau" * 5, "aauuss" * 7):
        assert audits._cheapest(codes) == plain(codes)


def test_replay_follows_the_audit():
    replay = audits.Replay("KIRDKI")
    said = [t for turn in (("system", "s"), ("tool", "t"), ("user", "u"), ("user", "v")) for t in replay.turn(*turn)] + list(replay.end())
    assert said == [("system", "s"), ("user", ""), ("assistant", "t"), ("user", "v"), ("assistant", "")]


@pytest.mark.parametrize("limits", [{}, {"long_turns": 2, "run": 2, "fan": 2}])
def test_equals_sql(spark, limits):
    folder = "/root/testdata/sf0.001"
    assert compare(repair.repair(spark.read.parquet(f"{folder}/conversations.parquet"), **limits), connect(folder), REPAIR)[:5] == []


@pytest.mark.parametrize("limits", [{}, {"long_turns": 1, "run": 3, "fan": 2}])
def test_odd_rows(spark, limits):
    schema = "conv_id long, turn long, role string, text string, conv string, code string, rank string"
    assert repair.repair(spark.createDataFrame([], schema), **limits).count() == 0
    x = ("x", "x", "x")
    kept = next(i for i in range(1000) if zlib.crc32(f"{i}:1".encode()) % 20 > 4)
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:1".encode()) % 20 == 0)
    rows = [
        (kept, 1, "user", "Hello.", *x), (kept, 1, "user", "Hello.", *x), (kept, 1, "tool", None, *x), (kept, 1, None, "x" * 100_000, *x), (gone, 1, "user", "Gone.", *x),
        (None, None, None, None, *x), (None, None, "assistant", "Yes.", *x), (-5, None, "system", " ", *x),
    ]
    got = {r["conv_id"]: r for r in repair.repair(spark.createDataFrame(rows, schema).repartition(3), **limits).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    assert set(got) == {kept, gone, None, -5}
    assert tuple(got[gone])[1:] == (0, 0, 0, 0, 0, 0, "", empty)
    # order: the null role (as one space), tool, user, user again
    assert (got[kept]["blank"], got[kept]["duplicate"], got[kept]["truncated"], got[kept]["illegal"], got[kept]["gaps"]) == (1, 1, 1, 3, 0)
    assert got[kept]["audit"] == "DDDD" and got[kept]["cost"] == 8 and got[kept]["repaired_sha256"] == empty


def test_one_conversation_holds_a_third_of_all_rows(spark):
    long = [(1, t, "user" if t % 2 else "assistant", f"Turn {t % 50}." if t % 3 else "open") for t in range(3000)]
    rows = long + [(c, t, "user", "Hi.") for c in range(2, 2000) for t in range(3)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6)
    cut = {r["conv_id"]: tuple(r) for r in repair.repair(table, long_turns=500, run=100, fan=4).collect()}
    assert cut == {r["conv_id"]: tuple(r) for r in repair.repair(table).collect()}
