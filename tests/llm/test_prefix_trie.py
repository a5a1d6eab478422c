"""The prefix trie against one built conversation by conversation."""

import hashlib
import math
import os
import random
import zlib

import pyarrow.parquet as pq
import pytest

import __spark_entry__ as entry
from fleetpulse.llm import prefix_trie

FOLDER = os.environ.get("LLM_SF_DIR", "/root/testdata/sf0.001")
KIND = "conv_id long, turn long, role string, text string, depth string, k1 string, words string"


def trie_by_hand(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append(((turn is not None, turn or 0), (role or "", text or "")))
    own = {c: [t for _, t in sorted(turns, key=lambda t: t[0])] for c, turns in own.items()}
    nodes = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 4
        base = conv - int(math.fmod(conv, 20))  # as in SQL, also below zero
        path = tuple(own.get(base, [])[:h] + turns[h:])
        for depth in range(len(path) + 1):
            node = nodes.setdefault(path[:depth], {"members": [], "ends": []})
            node["members"].append(conv)
            if depth == len(path):
                node["ends"].append(conv)
    out = set()
    children = {p: [q for q in nodes if q and q[:-1] == p] for p in nodes}

    def under(path):
        yield path
        for child in children[path]:
            yield from under(child)

    for path, node in nodes.items():
        below = list(under(path))
        saved = sum(
            (len(nodes[q]["members"]) - 1) * len(q[-1][1].encode().split()) for q in below if q
        )
        ends = ",".join(map(str, sorted(node["ends"])))
        out.add((
            min(node["members"]), len(path), min(nodes[path[:-1]]["members"]) if path else None,
            len(node["members"]), len(children[path]), sum(not children[q] for q in below), saved,
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return out


def answer(df, **how):
    rows = [tuple(r) for r in prefix_trie.prefix_trie(df, **how).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_op12(spark):
    table = pq.read_table(f"{FOLDER}/conversations.parquet").to_pylist()
    expected = trie_by_hand([(r["conv_id"], r["turn"], r["role"], r["text"]) for r in table])
    assert {tuple(r) for r in entry.queries()["op12_prefix_trie"](spark, FOLDER).collect()} == expected


@pytest.fixture(scope="module")
def odd():
    rng = random.Random(3)
    rows = []
    for conv in range(60):  # copies, shared openings, gaps, NULLs; 21 and 40 are missing
        if conv in (21, 40):
            continue
        topic = rng.randrange(4)
        for turn in range(rng.randint(1, 7)):
            rows.append((conv, turn, rng.choice(["user", None, ""]) if turn > 3 else "user", f"say {topic} {turn}"))
    rows += [(71, n, "user", f"long {n}" if n < 40 else None) for n in range(90)]
    rows += [(80, n, "user", f"long {n}") for n in range(45)]
    rows += [(None, 0, "user", "nobody"), (-5, 0, "user", ""), (-5, None, None, None), (90, None, "user", "first")]
    rows += [(1_000_000 + n, 0, "user", "same") for n in range(0, 40_000, 4000)]
    return rows


def test_odd_conversations_for_any_band_and_piece(spark, odd):
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in odd], KIND).repartition(3)
    expected = trie_by_hand(odd)
    for how in ({}, {"height": 2}, {"height": 5, "piece": 7, "max_run_rows": 20}):
        assert answer(df, **how) == expected


def test_ties_and_repeated_rows_are_turns_and_empty_tables_have_no_nodes(spark):
    rows = [(3, 1, "user", "b"), (3, 1, "user", "a"), (3, 1, "user", "a"), (23, 1, "user", "a")]
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], KIND)
    found = answer(df)
    assert max(r[1] for r in found) <= 3 and found == answer(df.orderBy("text", ascending=False))
    assert answer(df.limit(0)) == set()
