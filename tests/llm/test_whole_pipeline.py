"""The pipeline's last table: its token ids, and the mixture over one text of each Jaccard group."""

import hashlib
import os
import struct
from collections import Counter

import public_tokenizers
import pyarrow.parquet as pq

import __spark_entry__ as entry
from fleetpulse.llm import bpe, quality
from fleetpulse.llm.common import read_table
from tests.llm.by_hand import lines_kept, targets_by_hand
from tests.llm.test_near_copies import groups_by_hand

FOLDER = os.environ.get("LLM_SF_DIR", "/root/testdata/sf0.001")


def test_ids_and_mixture(spark):
    docs = {r["doc_id"]: r for r in pq.read_table(f"{FOLDER}/documents.parquet").to_pylist()}
    table = read_table(spark, FOLDER, "documents")
    model = quality.train(table, read_table(spark, FOLDER, "labels"))
    good = {r.doc_id for r in quality.keep_good(table, model).collect()}
    texts = {i: "\n".join(v) for i, v in lines_kept({i: docs[i]["text"] or "" for i in good}).items()}
    texts = {i: texts[i] for i, root in groups_by_hand(texts).items() if i == root}

    rows = [r.asDict() for r in entry.queries()["pipeline"](spark, FOLDER).collect()]
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    tokens = {rank: token for token, rank in ranks.items()}
    for r in rows:
        packed = struct.pack(f"<{len(r['ids'])}I", *r["ids"])
        assert b"".join(tokens[i] for i in r["ids"]) == texts[r["doc_id"]].encode()
        assert r["n_tokens"] == len(r["ids"])
        assert r["ids_sha256"] == hashlib.sha256(packed).hexdigest()

    times = Counter(r["doc_id"] for r in rows)
    totals, taken, largest = Counter(), Counter(), Counter()
    for i, text in texts.items():
        source, size = docs[i]["source"], len(text.encode().split())
        totals[source] += size
        taken[source] += times[i] * size
        largest[source] = max(largest[source], size)
    target = targets_by_hand(totals)
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in totals)
