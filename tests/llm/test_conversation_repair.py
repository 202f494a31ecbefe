"""Repaired conversations against a shortest-path search over whole edit strings."""

import hashlib
import heapq
import re
import zlib
from collections import defaultdict
from itertools import pairwise

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from larder.llm import conversation_repair as repair
from larder.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"
KEEPS = {"s": {"": "s"}, "u": {"": "u", "s": "u", "a": "u"}, "a": {"u": "a"}}
CHOSEN = {"": "u", "s": "u", "u": "a", "a": "u"}
NAMES = {"u": "user", "a": "assistant"}


def plain_cheapest(rows):
    """Dijkstra over (rows taken, last initial), by cost and then by the whole audit."""
    heap, seen = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, i, last, out = heapq.heappop(heap)
        if (i, last) in seen:
            continue
        seen.add((i, last))
        if i == len(rows) and last in ("", "a"):
            return cost, audit, out
        to = CHOSEN[last]
        heapq.heappush(heap, (cost + 3, audit + "I", i, to, (*out, (NAMES[to], ""))))
        if i == len(rows):
            continue
        role, text, fault = rows[i]
        heapq.heappush(heap, (cost + 4, audit + "D", i + 1, last, out))
        if fault not in ("blank", "duplicate"):
            more = 3 if fault == "truncated" else 0
            heapq.heappush(heap, (cost + more + 3, audit + "R", i + 1, to, (*out, (NAMES[to], text))))
            if last in KEEPS.get(role[:1], {}):
                heapq.heappush(heap, (cost + more, audit + "K", i + 1, KEEPS[role[:1]][last], (*out, (role, text))))


def judged(rows):
    """Rows (turn, role, text) of a conversation in order, with their first fault."""
    seen, out = set(), []
    for turn, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode())):
        bare = re.sub("[\x20\x09-\x0d]", "", text)
        fault = "duplicate" if (role, text) in seen else "truncated" if bare[-1:] not in (".", "!", "?") else None
        out.append((turn, role, text, fault if bare else "blank"))
        seen.add((role, text))
    return out


def plain_summary(rows):
    rows = judged(rows)
    cost, audit, out = plain_cheapest([row[1:] for row in rows])
    turns = [turn for turn, *_ in rows if turn is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    counts = [sum(row[3] == name for row in rows) for name in ("blank", "duplicate", "truncated")]
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in pairwise(rows))
    digest = hashlib.sha256("\n".join(f"{role}:{text}" for role, text in out).encode()).hexdigest()
    return (gaps, *counts, illegal, cost, audit, digest)


def said(value):
    return " " if value is None else str(value)


def plain_damage(rows):
    """The planted faults; conversations that lose all their rows stay, without rows."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        held, kind = out[conv], zlib.crc32(f"{said(conv)}:{said(turn)}".encode()) % 20
        role, text = said(role), said(text)
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 4:
            role = "user"
        held += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


@pytest.fixture(scope="module")
def table(spark):
    return spark.read.parquet(f"{FOLDER}/conversations.parquet")


@pytest.mark.parametrize("rows", [4096, 2])
def test_query_equals_the_search(spark, table, monkeypatch, rows):
    """In one block for each conversation, and with all but the shortest cut into blocks."""
    monkeypatch.setattr(repair, "BLOCK_ROWS", rows)
    got = {row[0]: tuple(row[1:]) for row in QUERIES["op11_conversation_repair"](spark, FOLDER).collect()}
    expected = {conv: plain_summary(held) for conv, held in plain_damage(table.collect()).items()}
    assert got == expected


def odd_rows():
    rows = [
        (1, 0, "system", "Be kind."), (1, 1, "user", "Hi there."), (1, 1, "user", "Hi there."), (1, 3, "assistant", "Hello"),
        (1, None, "assistant", None), (2, None, None, None), (2, None, None, "what?"), (3, 5, "", "no role."),
        (None, 1, "user", "who am I?"), (None, 2, "assistant", "Nobody."), (4, 7, "umpire", " \t\v\r\n\f "),
        (5, -2, "user", "long " * 20_000 + "end."), (5, 3, "tool", "result!"), (6, 1, "user", "a."), (6, 1, "assistant", "ü? "),
    ]
    return rows + [(7, turn % 5, "user" if turn % 3 else "assistant", f"{turn % 11}.") for turn in range(60)]


@pytest.mark.parametrize(("rows", "size"), [(4096, 8 << 20), (3, 8 << 20), (4096, 50)])
def test_odd_rows(spark, monkeypatch, rows, size):
    monkeypatch.setattr(repair, "BLOCK_ROWS", rows)
    monkeypatch.setattr(repair, "BLOCK_BYTES", size)
    held = defaultdict(list)
    for conv, turn, role, text in odd_rows():
        held[conv].append((turn, said(role), said(text)))
    df = spark.createDataFrame(odd_rows(), "conv_id long, turn long, role string, text string")
    df = df.selectExpr("*", "1 as conv", "2 as block", "'x' as edits", "3 as long_conv", "4 as `a.b`")
    blocks = repair.repair(df).persist()
    got = {row[0]: tuple(row[1:]) for row in repair.summary(blocks).collect()}
    assert got == {conv: plain_summary(rows) for conv, rows in held.items()}
    assert blocks.select(F.max("n_rows")).first()[0] <= rows
    assert (blocks.where("not whole").count() > 0) == ((rows, size) != (4096, 8 << 20))
    assert repair.repair(df.where("1 = 0")).collect() == []
    assert repair.summary(repair.repair(df.where("1 = 0"))).collect() == []


ROWS = st.lists(st.tuples(st.sampled_from(["s", "u", "a", "x", ""]), st.sampled_from([None, "blank", "truncated"])), max_size=12)


@settings(max_examples=150, deadline=None)
@given(rows=ROWS, modulus=st.sampled_from([(1 << 61) - 1, 3, 1]))
def test_audits_are_the_least(rows, modulus):
    """Whatever the hashes: with a modulus of 1 all strings collide and all are verified."""
    found = repair.cheapest(rows, trails=repair.Trails(modulus=modulus))
    best = min(found[0, end] for end in repair.ENDS if (0, end) in found)
    cost, audit, _ = plain_cheapest([(initial, "", fault) for initial, fault in rows])
    assert best == (cost, audit)


@settings(max_examples=100, deadline=None)
@given(rows=ROWS, cuts=st.lists(st.integers(0, 12), max_size=4))
def test_blocks_join_to_the_whole(rows, cuts):
    bounds = sorted({0, len(rows), *(c for c in cuts if c < len(rows))})
    joined, blocks = repair.Joined(), []
    for a, b in pairwise(bounds):
        blocks.append(repair.cheapest(rows[a:b], range(4)))
        joined.add(blocks[-1])
    ways = [moves[way] for moves, way in zip(blocks, joined.chosen(), strict=True)]
    cost, audit, _ = plain_cheapest([(initial, "", fault) for initial, fault in rows])
    assert (sum(c for c, _ in ways), "".join(a for _, a in ways)) == (cost, audit)


@settings(max_examples=100, deadline=None)
@given(words=st.lists(st.text("DIKR", max_size=9), min_size=2, max_size=6), modulus=st.sampled_from([(1 << 61) - 1, 2]))
def test_trails_compare_like_strings(words, modulus):
    trails, nodes = repair.Trails(modulus=modulus), []
    for word in words:
        at = 0
        for letter in word:
            at = trails.add(at, letter)
        nodes.append(at)
    for a, one in zip(nodes, words, strict=True):
        assert trails.text(a) == one
        for b, other in zip(nodes, words, strict=True):
            assert trails.less(a, b) == (one < other)


def test_prefixes_are_shared():
    trails = repair.Trails()
    repair.cheapest([("u", None), ("a", None)] * 500, trails=trails)
    assert len(trails.letter) < 1000 * 16
