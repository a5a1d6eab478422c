"""The pipeline against a brute-force version of its stages, and the machine's linear-time sum."""

import hashlib
import os
import struct
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import tiktoken

import __spark_entry__ as entry
from fleetpulse.llm import bpe, quality
from fleetpulse.llm.common import read_table
from tests.llm.by_hand import lines_kept, targets_by_hand
from tests.llm.test_near_copies import groups_by_hand

FOLDER = os.environ.get("LLM_SF_DIR", "/root/testdata/sf0.001")


def score_by_pairs(model, active):
    """The machine's output with every pair of features multiplied out."""
    values = np.concatenate([np.ones(12), np.full(len(active) - 12, max(1, len(active) - 12) ** -0.5)])
    vectors = model.factors[active].astype(float) * values[:, None]
    pairs = np.triu(vectors @ vectors.T, 1).sum()
    logit = model.bias + float((model.linear[active] * values).sum()) + pairs
    return 1 / (1 + np.exp(-logit))


def test_pipeline(spark):
    docs = {r["doc_id"]: r for r in pq.read_table(f"{FOLDER}/documents.parquet").to_pylist()}
    model = quality.train(read_table(spark, FOLDER, "documents"), read_table(spark, FOLDER, "labels"))
    buckets = quality.WordBuckets()
    texts, unsure = {}, set()
    for i, r in docs.items():
        active = quality.features((r["text"] or "").encode(), r["n_chars"], buckets)
        by_pairs = score_by_pairs(model, active)
        found = model.scores(active, np.array([len(active)]))[0]
        assert abs(by_pairs - found) < 1e-4
        if abs(by_pairs - quality.THRESHOLD) < 1e-4:
            unsure.add(i)
        if by_pairs >= quality.THRESHOLD:
            texts[i] = r["text"] or ""
    assert not unsure and 0 < len(texts) < len(docs)

    texts = {i: "\n".join(lines) for i, lines in lines_kept(texts).items()}
    texts = {i: texts[i] for i, root in groups_by_hand(texts).items() if i == root}

    rows = [r.asDict() for r in entry.queries()["pipeline"](spark, FOLDER).collect()]
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in rows:
        text = texts[r["doc_id"]]
        tokens = own.encode_ordinary(text)
        assert r["n_tokens"] == len(tokens)
        assert r["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(tokens)}I", *tokens)).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()

    times = Counter(r["doc_id"] for r in rows)
    assert max(times.values()) <= 2
    totals, taken, largest = Counter(), Counter(), Counter()
    for i, text in texts.items():
        source, size = docs[i]["source"], len(text.encode().split())
        totals[source] += size
        taken[source] += times[i] * size
        largest[source] = max(largest[source], size)
    target = targets_by_hand(totals)
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in totals)
