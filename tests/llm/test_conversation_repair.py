"""Conversation repair against a plain shortest-path search over (row, state) that keeps the least (cost, audit)."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib

import pytest

from ledgerline.llm import conversation_repair as R
from ledgerline.llm import queries
from ledgerline.llm.common import written

SF = "/root/testdata/sf0.001"
PATTERN = re.compile(r"(s?(ua)+)?")


def _damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        deal = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        row = [conv, turn, "user" if deal == 4 else role, "" if deal == 1 else re.sub("[.!?]", "", text) if deal == 2 else text]
        out += [row] * (0 if deal == 0 else 2 if deal == 3 else 1)
    return out


def _cheapest(rows):
    """(cost, audit, roles and texts) by uniform-cost search in order of (cost, audit); rows are (role, text, fault)."""
    heap, seen = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, shape, lines = heapq.heappop(heap)
        if i == len(rows) and PATTERN.fullmatch(shape):
            return cost, audit, lines
        key = (i, shape[-1:], shape == "s")
        if key in seen:
            continue
        seen.add(key)

        def go(letter, price, taken, role=None, text=""):
            grown = shape + (role[:1] if role else "")
            if role is not None and not (role and re.fullmatch(r"s|s?(ua)*u|s?(ua)+", grown)):
                return
            heapq.heappush(heap, (cost + price, audit + letter, i + taken, grown, lines + ((role, text),) * (role is not None)))

        for made in ("user", "assistant"):
            go("I", 5, 0, made)
        if i < len(rows):
            role, text, fault = rows[i]
            go("D", 2, 1)
            if fault not in ("blank", "duplicate"):
                go("K", 5 * (fault == "truncated"), 1, role, text)
                for made in ("user", "assistant"):
                    go("R", 1 + 5 * (fault == "truncated"), 1, made, text)


def _expected(rows):
    out, held = [], {}
    for r in rows:
        held.setdefault(r[0], [])
    for r in _damage(rows):
        held[r[0]].append(r)
    for conv, own in held.items():
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        seen, count, named = set(), dict.fromkeys(("blank", "duplicate", "truncated"), 0), []
        for _, _, role, text in own:
            end = text.rstrip(" \t\n\x0b\x0c\r")
            fault = "blank" if not end else "duplicate" if (role, text) in seen else None if end[-1] in ".!?" else "truncated"
            seen.add((role, text))
            named.append((role, text, fault))
            if fault:
                count[fault] += 1
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") for a, b in zip(named, named[1:]))
        cost, audit, lines = _cheapest(named)
        digest = hashlib.sha256("\n".join(f"{a}:{b}" for a, b in lines).encode()).hexdigest()
        out.append((conv, gaps, *count.values(), illegal, cost, audit, digest))
    return sorted(out, key=repr)


def _rows(df):
    assert df.columns == ["conv_id", *R.RESULT]
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _codes(codes):
    role = {"s": "system", "u": "user", "a": "assistant", "o": "tool", "x": "user"}
    return [(role[c.lower()], "t", "blank" if c == "x" else "truncated" if c.isupper() else None) for c in codes]


def test_searches_equal_a_plain_shortest_path():
    rnd = random.Random(5)
    for _ in range(2500):
        codes = "".join(rnd.choice("uauauasxUAo" if rnd.random() < 0.5 else "xsuaoSUAO") for _ in range(rnd.randrange(0, 14)))
        cost, audit = R.search(codes, R.START, R.ACCEPTING, True)
        assert (cost, audit) == _cheapest(_codes(codes))[:2], codes
        assert R.estimates(codes)[0] <= cost


def test_chains_of_segments_equal_one_search():
    rnd = random.Random(6)
    for _ in range(300):
        codes = "".join(rnd.choice("uauauasxUAo" if rnd.random() < 0.7 else "xsuaoSUAO") for _ in range(rnd.randrange(2, 30)))
        size = rnd.randrange(1, 6)
        parts = [codes[i : i + size] for i in range(0, len(codes), size)]
        steps = R.chained([R.table_of(p, i == len(parts) - 1) for i, p in enumerate(parts)])
        got = [R.search(p, a, R.ACCEPTING if i == len(parts) - 1 else (b,), i == len(parts) - 1) for i, (p, (a, b)) in enumerate(zip(parts, steps))]
        assert (sum(g[0] for g in got), "".join(g[1] for g in got)) == R.search(codes, R.START, R.ACCEPTING, True), (codes, size)


@pytest.fixture(scope="module")
def edge(spark):
    rnd = random.Random(7)
    texts = ["Fine.", "Really?", "No end", " \t\n", "", "Stop! ", "Wait.\x0b", "a.b", None, "é…", "Yes. "]
    rows = [(c, rnd.choice([t, t, t, 3, None]), rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "admin"]), rnd.choice(texts))
            for c in [None, *range(60)] for t in range(rnd.randrange(1, 9))]
    rows += [(100, t, "user" if t % 2 == 0 else "assistant", f"turn {t}.") for t in range(500)]  # four segments
    rows += [(101, t, rnd.choice(["user", "assistant"]), rnd.choice(["Same.", f"own {t}", f"own {t}."])) for t in range(300)]
    rows += [(102, 5, "user", "x" * 300_000 + "."), (103, None, "system", "only.")]
    gone = next(i for i in range(200, 10_000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows += [(gone, 0, "user", "dropped.")]
    df = spark.createDataFrame([(*r, 1, "g", True) for r in rows],
                               "conv_id long, turn long, role string, text string, place int, fault string, gone boolean").repartition(4)
    return rows, written(spark, df, "conversations")


def test_edge_rows_equal_brute_force(spark, edge):
    rows, df = edge
    assert _rows(R.repair(spark, R.damaged(df))) == _expected(rows)
    assert R.repair(spark, R.damaged(df.limit(0))).collect() == []


def test_small_segments_change_nothing(spark, edge, monkeypatch):
    rows, df = edge
    want = _expected(rows)
    monkeypatch.setattr(R, "SEGMENT", 3)
    assert _rows(R.repair(spark, R.damaged(df))) == want


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert _rows(queries.op12_conversation_repair(spark, SF)) == _expected(rows)
