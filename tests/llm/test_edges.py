"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fleetpulse.llm import (
    bpe, components, embeddings, fingerprints, licenses, line_runs, mixing, near_copies, quality, shards, simhash,
    token_counts,
)

KIND = (
    "doc_id long, text string, lang string, source string, n_chars long,"
    " fingerprint string, score double, shard int, batch string, tag string, copies string"
)
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
LONG = " ".join(f"w{n % 977}x" for n in range(60_000)) + "\n" + "a" * 5_000
LINE = "A line that is long enough to count"


def rows():
    rng = random.Random(2)
    words = ["alpha", "beta", "gamma", "delta", "the", "of", "MIT", "License"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 60))) for _ in range(40)]
    texts += [None, "", "", " \n \t", "x", LONG, LINE, LINE + "\n" + "other", "  " + LINE.upper() + " \nend"]
    out = [(n, t, "en", ["a", "b", None][n % 3], len(t or ""), "f", 1.0, 1, "b", "t", "c") for n, t in enumerate(texts)]
    out += [out[3], out[3], (3, "another text", None, None, None, None, None, None, None, None, None)]
    return out + [(None, "no id", *[None] * 9), (None, None, *[None] * 9)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), KIND).repartition(3)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(
        [(n, n % 2, 0) for n in range(40)] + [(3, 0, 0), (None, 1, 0), (5, None, None)],
        "doc_id long, quality int, toxic int",
    )


OPERATORS = {
    "fingerprints": lambda d, _: fingerprints.compare_with_next(d),
    "quality": lambda d, l: quality.classify(d, l),  # noqa: E741
    "simhash": lambda d, _: simhash.near_duplicates(d),
    "bpe": lambda d, _: bpe.encode_documents(d, RANKS, public_tokenizers.PATTERN),
    "licenses": lambda d, _: licenses.scan_licenses(d),
    "shards": lambda d, _: shards.shard_documents(d),
    "token_counts": lambda d, _: token_counts.token_counts(d, TOKENIZER),
    "line_runs": lambda d, _: line_runs.dedup_lines(d).select("id", "n_lines", "n_dropped", "kept"),
    "mixing": lambda d, _: mixing.mix(d),
}


@pytest.mark.parametrize("name", list(OPERATORS))
def test_odd_rows_and_empty_tables(spark, docs, labels, name):
    found = OPERATORS[name](docs, labels).collect()
    assert len(found) == len(rows())
    empty = spark.createDataFrame([], KIND)
    assert OPERATORS[name](empty, labels).collect() == []
    if name == "quality":
        assert len(OPERATORS[name](docs, labels.limit(0)).collect()) == len(rows())


def test_stages_keep_columns_and_stand_empty_tables(spark, docs, labels, tmp_path):
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for table in (docs, spark.createDataFrame([], KIND)):
        held = table
        for name, stage in corpus_pipeline.STAGES[:-1]:
            held = stage(spark, held, str(tmp_path))
            assert held.columns == docs.columns, name
            path = str(tmp_path / f"{name}-{table is docs}")
            held.write.parquet(path)
            held = spark.read.parquet(path)
        last = corpus_pipeline.STAGES[-1][1](spark, held, str(tmp_path))
        assert last.count() == held.count()


def test_near_duplicate_stage_leaves_one_row_of_each_group(spark, docs):
    found = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    kept = [r.doc_id for r in simhash.keep_one(docs).collect() if r.doc_id is not None]
    assert sorted(kept) == sorted({c for _, c in found if c is not None})


def test_unlike_texts_of_one_id_all_stay(spark):
    texts = [(5, "a b c d e f g"), (5, "h i j k l m n"), (6, "o p q r s t u"), (7, "o p q r s t u"), (None, "v w x y z 1 2"), (None, "v w x y z 1 2"), (None, "a b c d e f g")]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    kept = simhash.keep_one(df, find=near_copies.near_copies).collect()
    assert sorted((r.doc_id or 0, r.text[0]) for r in kept) == [(0, "v"), (5, "a"), (5, "h"), (6, "o")]


def test_line_stage_changes_text_and_length_only(spark, docs):
    found = {r.doc_id: r for r in line_runs.without_repeated_lines(docs).collect() if r.doc_id}
    n = len(rows()) - 8
    assert [found[k].text for k in (n, n + 1, n + 2)][1:] == ["other", "  " + LINE.upper() + " \nend"]
    assert found[n + 1].n_chars == 5 and found[n + 1].lang == "en"


def test_line_runs_agree_for_any_number_of_batches(spark, docs):
    base = sorted(map(str, line_runs.dedup_lines(docs, batches=1).select("id", "n_dropped", "kept").collect()))
    for batches, fan_out in ((3, 2), (5, 3)):
        again = line_runs.dedup_lines(docs, batches=batches, fan_out=fan_out)
        assert sorted(map(str, again.select("id", "n_dropped", "kept").collect())) == base


def test_crowded_postings_give_the_same_components(spark):
    rng = random.Random(4)
    base = rng.getrandbits(63)
    values = {base} | {base ^ (1 << rng.randrange(63)) ^ (1 << rng.randrange(63)) for _ in range(60)}
    values |= {rng.getrandbits(63) for _ in range(60)}
    values = sorted(values)
    nodes = spark.createDataFrame([(v, n) for n, v in enumerate(values)], "fp long, node long")
    true = {(a, b) for a in range(len(values)) for b in range(a) if (values[a] ^ values[b]).bit_count() <= 2}
    for most in (64, 3):
        found = {(max(r), min(r)) for r in simhash.fingerprint_links(nodes, most).collect()}
        assert found <= true
        links = spark.createDataFrame(sorted(true), "a long, b long")
        expected = sorted(map(tuple, components.components(links).collect()))
        held = spark.createDataFrame(sorted(found), "a long, b long")
        assert sorted(map(tuple, components.components(held).collect())) == expected


def test_components_of_chains_hubs_and_nothing(spark):
    links = [(n, n + 1) for n in range(20)] + [(100, 100 + n) for n in range(50)] + [(7, 7), (None, 3)]
    found = dict(map(tuple, components.components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert found == {**{n: 0 for n in range(1, 21)}, **{100 + n: 100 for n in range(1, 50)}}
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_odd_vectors_and_blocks(spark):
    rng = random.Random(5)
    base = [rng.gauss(0, 1) for _ in range(16)]
    near = [[x + rng.gauss(0, 0.02) for x in base] for _ in range(30)]
    odd = [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15]
    table = [(n, v, 1, "x") for n, v in enumerate([base, base, *near])]
    table += [(100 + n, v, 1, "x") for n, v in enumerate(odd)]
    table += [(200, base, 2, "x"), (201, base, None, "x"), (202, base[:4], 1, "x"), (203, [2 * x for x in base], 1, "x")]
    df = spark.createDataFrame(table, "vec_id long, embedding array<double>, label int, cell string")
    def answer(**how):
        return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicates(df, **how).collect()}
    plain = answer(recall=1.0)
    assert plain[0] == (32, 0, True) and plain[203] == (32, 0, False)
    assert all(plain[k] == (0, k, True) for k in (*range(100, 106), 200, 201, 202))
    assert answer(recall=1.0, block_rows=5, codes=3) == plain
    assert embeddings.near_duplicates(df.limit(0)).collect() == []


@pytest.mark.parametrize("target", [0.999, 0.9])
def test_recall_of_the_grid_and_links_from_both_sides(spark, target):
    """Thousands of vectors a label, most pairs just above the threshold, 24 codes a half."""
    rng = np.random.default_rng(12)
    base = rng.standard_normal((3_000, 32))
    base /= np.linalg.norm(base, axis=1)[:, None]
    aside = rng.standard_normal(base.shape)
    aside -= (aside * base).sum(1)[:, None] * base
    aside /= np.linalg.norm(aside, axis=1)[:, None]
    cosine = rng.uniform(0.979, 0.985, len(base))[:, None]
    vectors = np.concatenate([base, cosine * base + np.sqrt(1 - cosine**2) * aside])
    label = np.concatenate([np.arange(3_000) % 2] * 2)
    table = [(n, v.tolist(), int(k)) for n, (v, k) in enumerate(zip(vectors, label, strict=True))]
    df = spark.createDataFrame(table, "vec_id long, embedding array<double>, label int").repartition(4)
    found = {r.vec_id: r for r in embeddings.near_duplicates(df, recall=target, codes=24, block_rows=200).collect()}
    true, counted, got = {}, 0, 0
    for k in range(2):
        ids = np.flatnonzero(label == k)
        near = vectors[ids] @ vectors[ids].T >= 0.98
        for row, n in zip(near, ids.tolist(), strict=True):
            true[n] = int(row.sum()) - 1
    for n, links in true.items():
        counted, got = counted + links, got + found[n].n_links
        assert found[n].n_links <= links
    assert counted > 4_000
    print(f"recall {got / counted:.5f} at a target of {target}")
    assert got / counted >= (0.99 if target > 0.99 else 0.85)
    for n in range(3_000):  # all links here are within pairs, and count for both
        assert found[n].n_links == found[n + 3_000].n_links
        assert (found[n + 3_000].component_id == n) == (found[n].n_links == 1)


def test_fingerprints_merge():
    words = fingerprints.WordHashes()
    a, b = (" ".join(f"{k}{n}" for n in range(400)).encode() for k in "ab")
    merged = fingerprints.merge(fingerprints.sketch(a, words), fingerprints.sketch(b, words))
    assert fingerprints.containment(fingerprints.sketch(a, words), merged) == 1
    assert fingerprints.decode(fingerprints.encode(merged)).tolist() == merged.tolist()


def test_decoding_returns_the_text(spark, docs):
    coded = bpe.encode_documents(docs, RANKS, public_tokenizers.PATTERN, with_ids=True)
    texts = sorted(r.text for r in bpe.decode_ids(coded, RANKS).select("text").collect())
    assert texts == sorted(r[1] or "" for r in rows())


def test_long_documents_are_spliced_like_whole_ones():
    with open(TOKENIZER, encoding="utf-8") as file:
        data = file.read()
    own, margin = token_counts.load(data), token_counts.margin_for(data)
    rng = random.Random(6)
    parts = ["the", " ", "\n\n", "<|endoftext|>", "<|end", "漢字", "'s", "12", "!!!", "a" * 90, " " * 70]
    for _ in range(200):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 300)))
        whole = len(own.encode(text, add_special_tokens=False).ids)
        assert token_counts.count_long(own, text, 80, 32, margin) == whole


def test_full_licence_texts_are_found(spark):
    notice = licenses.TEMPLATES[1][1].capitalize()
    df = spark.createDataFrame([(1, "Words before. " + notice + ". After."), (2, "granted free permission")], "doc_id long, text string")
    found = {r.doc_id: r for r in licenses.scan_licenses(df).collect()}
    assert (found[1].labels, found[1].base_labels, found[2].labels) == ("mit", "", "")
    assert found[1].score > 0.9 and found[2].score == 0


def test_mixing_in_many_blocks_stays_near_targets(spark):
    df = spark.range(3_000).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 37 + 1).cast("int")).alias("text"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None).otherwise("b").alias("source"),
    )
    found = mixing.mix(df, block_rows=50).join(df.select("doc_id", "source"), "doc_id").groupBy("source").agg(
        F.sum("taken").alias("taken"), F.first("target").alias("target"), F.count("*").alias("n")
    ).collect()
    assert sum(r.n for r in found) == 3_000
    assert all(abs(r.taken - r.target) <= 37 for r in found)


def test_sharding_splits_a_group_larger_than_a_shard(spark):
    df = spark.range(1_200).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("text")
    )
    found = shards.shard_documents(df).groupBy("shard").agg(F.count("*").alias("n"), F.max("slot").alias("last")).collect()
    assert len(found) == 24 and all(r.n == 50 and r.last == 49 for r in found)


def test_a_file_that_quotes_every_template_has_every_label(spark):
    text = "\n\n".join(notice + " ." + " filler" * 40 for _, notice, _ in licenses.TEMPLATES)
    found = licenses.scan_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert found.labels == ",".join(sorted({label for label, _, _ in licenses.TEMPLATES}))


def test_any_pattern_is_applied_to_long_texts_whole(monkeypatch):
    import numpy as np
    import tiktoken

    pattern = r"[^\s\p{L}]+[\r\n]*|\p{L}+(?= )|\p{L}+|\s+"  # a match may end in line breaks
    ranks = bpe.read_ranks(RANKS)
    own = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    monkeypatch.setattr(bpe, "SEGMENT_CHARS", 50)
    monkeypatch.setattr(bpe, "SEGMENT_PIECES", 7)
    encoder = bpe.Encoder(bpe.merge_tables(ranks), pattern)
    rng = random.Random(8)
    texts = ["".join(rng.choice(["a", "bc ", "!", "\n", "\r\n", " ", "12"]) for _ in range(n)) for n in range(200)]
    for text, packed in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(packed, "<u4").tolist() == own.encode_ordinary(text)


def test_very_large_and_very_small_vectors_have_their_cosines(spark):
    base = [float(n % 5 - 2) for n in range(16)]
    other = [float(n % 3) for n in range(16)]
    table = [(n, [x * 10.0**k for x in base], 1) for n, k in enumerate((0, 200, -200, 307))]
    table.append((9, [x * 1e250 for x in other], 1))
    df = spark.createDataFrame(table, "vec_id long, embedding array<double>, label int")
    found = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_duplicates(df).collect()}
    assert found == {**{n: (3, 0) for n in range(4)}, 9: (0, 9)}
