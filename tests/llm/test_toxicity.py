"""Toxicity: held-out accuracy, planted words and their misspellings, and the mean by definition."""

import os
import random
import re
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as entry
from fleetpulse.llm import toxicity

FOLDER = os.environ.get("LLM_SF_DIR", "/root/testdata/sf0.001")
LARGER = "/root/testdata/sf0.1"
KIND = "doc_id long, text string, lang string, source string, score double, held_out string, buckets string"


@pytest.fixture(scope="module")
def answers(spark):
    return {r.doc_id: r for r in entry.queries()["op11_toxicity"](spark, LARGER).collect()}


def test_op11_on_held_out_rows(answers):
    docs = {r["doc_id"]: r["text"] or "" for r in pq.read_table(f"{LARGER}/documents.parquet").to_pylist()}
    labels = {r["doc_id"]: r["toxic"] for r in pq.read_table(f"{LARGER}/labels.parquet").to_pylist()}
    assert set(answers) == set(docs)
    for i, r in answers.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    kept = [i for i in labels if answers[i].held_out]
    # Words in toxic texts alone, of those not held out, tell the planted ones from stray labels.
    words = re.compile(r"[^\W\d_]+")
    seen = [{}, {}]
    for i, y in labels.items():
        if not answers[i].held_out:
            for w in set(words.findall(docs[i].lower())):
                seen[y][w] = seen[y].get(w, 0) + 1
    planted = {w for w, n in seen[1].items() if n >= 40 and not seen[0].get(w)}
    assert planted
    toxic = {i for i in kept if planted & set(words.findall(docs[i].lower()))}
    assert np.mean([answers[i].predicted for i in toxic]) > 0.95
    assert np.mean([answers[i].predicted for i in kept if i not in toxic]) < 0.02
    # Stray labels bound what any answer can agree with: ours agrees about as often as the words do.
    best = np.mean([(i in toxic) == labels[i] for i in kept])
    assert np.mean([answers[i].predicted == labels[i] for i in kept]) > best - 0.015


def test_op11_smallest_table(spark):
    rows = entry.queries()["op11_toxicity"](spark, FOLDER).collect()
    ids = [r["doc_id"] for r in pq.read_table(f"{FOLDER}/documents.parquet").to_pylist()]
    assert sorted(r.doc_id for r in rows) == sorted(ids)


def corpus(count, seed):
    rng = random.Random(seed)
    common = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 8))) for _ in range(600)]
    texts, labels = [], []
    for n in range(count):
        words = [rng.choice(common) for _ in range(rng.randint(20, 120))]
        labels.append(int(n % 5 == 0))
        if labels[-1]:
            for _ in range(max(2, len(words) // 30)):
                words[rng.randrange(len(words))] = rng.choice(["wretchedly", "vermin", "blockhead"])
        texts.append(" ".join(words))
    return texts, labels


def test_misspellings_never_seen_share_the_vectors(spark):
    texts, labels = corpus(1_500, 1)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    model = toxicity.train(docs, spark.createDataFrame(list(enumerate(labels)), "doc_id long, toxic int"))
    leans, bias = model.lean()
    words = toxicity.WordLeans(leans)
    others, marks = corpus(1_500, 1)  # texts of the same common words
    clean = next(t for t, y in zip(reversed(others), reversed(marks), strict=True) if not y)
    usual = clean.split()[0]
    at = lambda word: toxicity.score_of(f"{clean} {word} {word}".encode(), words, bias)
    assert at(usual) < 0.3
    for word in ("vermin", "vermiin", "Wretchedlly", "blockheaad", "bl0ckhead", "wretchedly!!!"):
        assert at(word) > 0.7, word


def test_scores_are_the_softmax_over_the_mean_of_words_by_definition():
    texts, labels = corpus(300, 2)
    model = toxicity.fit([toxicity.bag(t.encode()) for t in texts], np.array(labels, float))
    assert np.any(model.vectors)
    leans, bias = model.lean()
    words = toxicity.WordLeans(leans)
    for text in [*texts[:40], "", " ", "vermin", "ÉTÉ vermin's (blockhead) %%%"]:
        means = []
        for word in text.encode().lower().split():
            marked = f"<{toxicity.bare(word)}>"
            parts = [marked[a : a + n] for n in (3, 4, 5) for a in range(len(marked) - n + 1)]
            buckets, sizes = toxicity.grams([toxicity.bare(word)])
            assert sizes[0] == len(parts)
            means.append(model.vectors[buckets].astype(float).mean(0))
        mean = np.mean(means, 0) if means else np.zeros(toxicity.WIDTH)
        logits = mean @ model.softmax + model.bias
        chance = np.exp(logits[1]) / np.exp(logits).sum()
        assert abs(toxicity.score_of(text.encode(), words, bias) - chance) < 1e-4


def test_odd_rows_labels_and_empty_tables(spark):
    rows = [(n, t, "en", "s", 1.0, "h", "b") for n, t in enumerate([None, "", " \n ", "a" * 200_000, "x y " * 90_000, "!!! ???", "same", "same"])]
    rows += [rows[3], (None, "no id", *["z"] * 2, None, None, None), (2, "another", *[None] * 5)]
    docs = spark.createDataFrame(rows, KIND).repartition(2)
    labels = spark.createDataFrame([(n, n % 2) for n in range(8)] + [(3, 0), (None, 1), (4, None)], "doc_id long, toxic int")
    for some in (labels, labels.limit(0), labels.filter("toxic = 1")):
        found = toxicity.classify(docs, some).collect()
        assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
        assert [r.held_out for r in found if r.doc_id is None] == [None]
    assert toxicity.classify(docs.limit(0), labels).collect() == []
    few = toxicity.classify(docs, labels, max_rows=2)
    assert sorted(map(str, few.collect())) == sorted(map(str, toxicity.classify(docs, labels, max_rows=2).collect()))
