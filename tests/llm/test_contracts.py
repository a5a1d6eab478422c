"""Each registered query against a brute-force version over its whole table."""

import hashlib
import os
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as entry
from tests.llm.by_hand import lines_kept, roots, simhash_by_hand, targets_by_hand

FOLDER = os.environ.get("LLM_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def docs():
    table = pq.read_table(f"{FOLDER}/documents.parquet").to_pylist()
    return {r["doc_id"]: r for r in table}


def answer(spark, name):
    return [r.asDict() for r in entry.queries()[name](spark, FOLDER).collect()]


def by_id(rows, key="doc_id"):
    found = {r[key]: r for r in rows}
    assert len(found) == len(rows)
    return found


def shingle_set(text, width=5):
    words = text.encode().lower().split()
    if len(words) < width:
        return {b" ".join(words)} if words else set()
    return {b" ".join(words[n : n + width]) for n in range(len(words) - width + 1)}


def test_op1(spark, docs):
    found = by_id(answer(spark, "op1_fingerprints"))
    assert set(found) == set(docs)
    order = sorted(docs)
    errors = [], [], []  # of less than 8 shingles, less than 128, and more
    for n, i in enumerate(order):
        text, after = docs[i]["text"] or "", docs[order[(n + 1) % len(order)]]["text"] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        r = found[i]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        a, b, c = shingle_set(text), shingle_set(edited), shingle_set(after)
        for other, near, inside in ((b, "near_edited", "contained_edited"), (c, "near_next", "contained_next")):
            assert 0 <= r[near] <= 1 and 0 <= r[inside] <= 1
            by_length = errors[min(2, len(a).bit_length() // 4)]
            by_length.append(r[near] - (len(a & other) / len(a | other) if a | other else 1))
            if len(a) > 200:
                by_length.append(r[inside] - len(a & other) / max(1, len(a)))
            if len(a) < 64 and len(other) < 64:
                assert abs(by_length[-1]) < 1e-12
        if text == edited:
            assert r["near_edited"] == 1 and r["fingerprint"] == r["edited_fingerprint"]
    errors = [float(np.sqrt(np.mean(np.square(e)))) if e else 0.0 for e in errors]
    print("errors of near_edited and near_next:", errors)
    assert all(e < 0.06 for e in errors)
    prints = defaultdict(set)
    for i, r in found.items():
        prints[docs[i]["text"]].add(r["fingerprint"])
    assert all(len(p) == 1 for p in prints.values())


def test_op2(spark, docs):
    found = by_id(answer(spark, "op2_quality"))
    assert set(found) == set(docs)
    labels = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{FOLDER}/labels.parquet").to_pylist()}
    right = [0, 0]
    for i, r in found.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
        if r["held_out"] and i in labels:
            right[r["predicted"] == labels[i]] += 1
    assert right[1] / sum(right) > 0.85


def test_op3(spark, docs):
    found = by_id(answer(spark, "op3_simhash"))
    prints = {i: simhash_by_hand(r["text"] or "") for i, r in docs.items()}
    assert {i: r["fingerprint"] for i, r in found.items()} == {i: f"{p:016x}" for i, p in prints.items()}
    ids = sorted(prints)
    values = np.array([prints[i] for i in ids], np.uint64)
    links = [
        (ids[n], ids[m])
        for n in range(len(ids))
        for m in np.flatnonzero(np.bitwise_count(values ^ values[n]) <= 2).tolist()
        if m > n
    ]
    assert {i: r["component_id"] for i, r in found.items()} == roots(links, ids)


def test_op4(spark, docs):
    import base64

    import tiktoken

    lines = open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb").read().splitlines()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = by_id(answer(spark, "op4_byte_bpe"))
    assert set(found) == set(docs)
    for i, r in docs.items():
        text = r["text"] or ""
        ids = own.encode_ordinary(text)
        packed = struct.pack(f"<{len(ids)}I", *ids)
        assert found[i] == {
            "doc_id": i, "n_tokens": len(ids), "ids_sha256": hashlib.sha256(packed).hexdigest(),
            "decoded_sha256": hashlib.sha256(text.encode()).hexdigest(),
        }


def test_op5(spark, docs):
    found = by_id(answer(spark, "op5_licenses"))
    phrases = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
    for i, r in docs.items():
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r["text"] or "")
        words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", text)
        places = [
            (n, label) for n in range(len(words)) for phrase, label in phrases.items()
            if words[n : n + len(phrase.split())] == phrase.split()
        ]
        starts, base = [p for p, _ in places], {label for _, label in places}
        row = found[i]
        assert (row["n_words"], row["n_base"]) == (len(words), len(places))
        assert (row["first_word"], row["last_word"]) == ((min(starts), max(starts)) if starts else (None, None))
        assert row["base_labels"] == ",".join(sorted(base))
        assert base <= set(filter(None, row["labels"].split(",")))
        assert 0 <= row["score"] <= 1 and (row["score"] > 0) == bool(row["labels"])


def test_op6(spark, docs):
    rows = answer(spark, "op6_shards")
    found = by_id(rows)
    assert set(found) == set(docs)
    slots = defaultdict(list)
    for i, r in docs.items():
        data = (r["text"] or "").encode()
        row = found[i]
        assert (row["size"], row["text_crc32"]) == (len(data) + 8, zlib.crc32(data))
        assert row["law"] == "rows" and row["grown_shard"] is None and 0 <= row["shard"] < 24
        slots[row["shard"]].append(row["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots[n]) for n in range(24)]
    assert max(sizes) - min(sizes) <= 1
    groups = defaultdict(list)
    for i, r in docs.items():
        groups[r["text"]].append(found[i]["shard"])
    several = [g for g in groups.values() if len(g) > 1]
    part = max(1, len(docs) // 96)
    together = sum(max(Counter(g).values()) >= min(len(g), part) for g in several)
    assert together >= 0.8 * len(several)


def test_op7(spark):
    rows = pq.read_table(f"{FOLDER}/embeddings.parquet").to_pylist()
    found = by_id(answer(spark, "op7_embeddings"), "vec_id")
    assert set(found) == {r["vec_id"] for r in rows}
    usable = [r for r in rows if r["label"] is not None and r["embedding"]
              and all(v is not None and np.isfinite(v) for v in r["embedding"]) and any(r["embedding"])]
    ids = np.array([r["vec_id"] for r in usable])
    label = np.array([r["label"] for r in usable])
    unit = np.array([r["embedding"] for r in usable], np.float64)
    unit /= np.sqrt((unit**2).sum(1))[:, None]
    near = (unit @ unit.T >= 0.98) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    true = dict(zip(ids.tolist(), near.sum(1).tolist(), strict=True))
    assert all(r["n_links"] <= true.get(i, 0) for i, r in found.items())
    assert sum(r["n_links"] for r in found.values()) >= 0.98 * sum(true.values())
    links = [(int(ids[a]), int(ids[b])) for a, b in zip(*np.nonzero(near), strict=True)]
    whole = roots(links, found)
    same = sum(r["component_id"] == whole[i] for i, r in found.items())
    assert same >= 0.98 * len(found)
    assert all(whole[r["component_id"]] == whole[i] for i, r in found.items())
    assert all(r["kept"] == (i == r["component_id"]) for i, r in found.items())


def test_op8(spark, docs):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found = by_id(answer(spark, "op8_token_counts"))
    assert set(found) == set(docs)
    for i, r in docs.items():
        count = len(own.encode(r["text"] or "", add_special_tokens=False).ids)
        assert found[i] == {"doc_id": i, "n_bytes": len((r["text"] or "").encode()), "n_tokens": count,
                            "over_limit": count > 1024}


def test_op9(spark, docs):
    found = by_id(answer(spark, "op9_line_dedup"))
    texts = {i: r["text"] or "" for i, r in docs.items()}
    for i, kept in lines_kept(texts).items():
        n_lines = len(texts[i].split("\n"))
        assert found[i] == {"doc_id": i, "n_lines": n_lines, "n_dropped": n_lines - len(kept),
                            "kept_sha256": hashlib.sha256("\n".join(kept).encode()).hexdigest()}


def test_op10(spark, docs):
    rows = answer(spark, "op10_mixing")
    found = by_id(rows)
    assert set(found) == set(docs)
    totals, taken, largest = Counter(), Counter(), Counter()
    for i, r in docs.items():
        size = len((r["text"] or "").encode().split())
        assert found[i]["size"] == size and found[i]["taken"] in (0, size, 2 * size)
        totals[r["source"]] += size
        taken[r["source"]] += found[i]["taken"]
        largest[r["source"]] = max(largest[r["source"]], size)
    target = targets_by_hand(totals)
    for i, r in docs.items():
        assert found[i]["source_size"] == totals[r["source"]]
        assert found[i]["target"] == pytest.approx(target[r["source"]])
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in totals)
    again = {r["doc_id"]: r["taken"] for r in answer(spark, "op10_mixing")}
    assert again == {i: r["taken"] for i, r in found.items()}


def test_line_sql(spark):
    import duckdb

    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    sql = duck.execute(entry.oracle_sql()["op9_line_dedup"]).fetchall()
    ours = [(r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_sha256"]) for r in answer(spark, "op9_line_dedup")]
    assert sorted(sql) == sorted(ours)
