"""Fill-in-the-middle against plain cuts, and exact round trips."""

import hashlib
import os
import re

import pyarrow.parquet as pq

import __spark_entry__ as entry
from fleetpulse.llm import fill_middle
from fleetpulse.llm.common import read_table
from pyspark.sql import functions as F

FOLDER = os.environ.get("LLM_SF_DIR", "/root/testdata/sf0.001")


def by_hand(ident, text):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if ident is None else ident}".encode()).hexdigest()
    h = [int(digest[8 * n : 8 * n + 8], 16) for n in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    parts = ["".join(units[:a]), "".join(units[a:b]), "".join(units[b:])]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")):
        return len(units), "plain", None, None, text
    if h[3] % 100 < 50:
        return len(units), "spm", len(parts[0]), len(parts[1]), f"<S>{parts[2]}<P>{parts[0]}<M>{parts[1]}"
    return len(units), "psm", len(parts[0]), len(parts[1]), f"<P>{parts[0]}<S>{parts[2]}<M>{parts[1]}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_op13(spark):
    rows = {r["doc_id"]: r for r in entry.queries()["op13_fill_in_middle"](spark, FOLDER).collect()}
    table = pq.read_table(f"{FOLDER}/documents.parquet").to_pylist()
    assert len(rows) == len(table)
    for r in table:
        *head, output = by_hand(r["doc_id"], r["text"])
        assert list(rows[r["doc_id"]])[1:] == [*head, sha(output), sha(r["text"] or "")]


def test_operator_returns_the_outputs_themselves(spark):
    found = fill_middle.fill_in_middle(read_table(spark, FOLDER, "documents"))
    texts = {r["doc_id"]: r["text"] or "" for r in pq.read_table(f"{FOLDER}/documents.parquet").to_pylist()}
    back = found.select("doc_id", fill_middle.restored(F.col("form"), F.col("output")).alias("text"))
    assert {r.doc_id: r.text for r in back.collect()} == texts


def test_odd_texts(spark):
    texts = [
        None, "", "\n", "\n\n\n", "one", "one\n", "a\r\nb\rc d", "has <P> in it", "<M>", "<S", "P>\n<", "x" * 300_000,
        "\n" * 40_000, "a line\n" * 60_000, "\U0001f600\n" * 50, "$1 \\1 ${x}\n" * 9, "<P\n>\nS>\n", "end<\n", "漢\n字",
    ]
    rows = [(n, t, "f", "o") for n, t in enumerate(texts * 3)] + [(None, "no id\nat all\n", "f", "o"), (3, "three", "f", "o"), (3, "three", "f", "o")]
    df = spark.createDataFrame(rows, "doc_id long, text string, form string, output string").repartition(3)
    found = fill_middle.fill_in_middle(df)
    answers = sorted(map(repr, (tuple(r) for r in found.collect())))
    assert answers == sorted(repr((i, *by_hand(i, t))) for i, t, _, _ in rows)
    back = found.select(fill_middle.restored(F.col("form"), F.col("output"))).collect()
    assert sorted(r[0] for r in back) == sorted(t or "" for _, t, _, _ in rows)
    assert fill_middle.fill_in_middle(df.limit(0)).collect() == []


def test_share_of_texts_left_plain(spark):
    df = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("a\nb\nc").alias("text"))
    forms = [r.form for r in fill_middle.fill_in_middle(df, percent=30, spm_percent=0).collect()]
    assert 200 < forms.count("plain") < 360 and forms.count("spm") == 0
