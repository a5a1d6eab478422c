"""The operators as queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.llm import (
    bpe,
    embeddings,
    fill_middle,
    fingerprints,
    licenses,
    line_runs,
    mixing,
    prefix_trie,
    quality,
    shards,
    simhash,
    token_counts,
    toxicity,
)
from fleetpulse.llm.common import read_table

Query = Callable[[SparkSession, str], DataFrame]
RANKS = "byte_bpe_50k.tiktoken"
TOKENIZER = "byte_bpe_50k.json"

QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_next(read_table(spark, sf_dir, "documents"))


@query
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    )


@query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents")).drop("tie")


@query
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path(RANKS)
    docs = read_table(spark, sf_dir, "documents")
    coded = bpe.encode_documents(
        docs, ranks, public_tokenizers.PATTERN, with_packed=True, with_decoded=True
    )
    return coded.select("doc_id", "n_tokens", *bpe.digests())


@query
def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read_table(spark, sf_dir, "documents"))


@query
def op6_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard_documents(read_table(spark, sf_dir, "documents"))


@query
def op7_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(read_table(spark, sf_dir, "embeddings"))


@query
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(
        read_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER)
    )


@query
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_runs.dedup_lines(read_table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_lines",
        "n_dropped",
        F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"),
    )


@query
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


@query
def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    )


@query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(read_table(spark, sf_dir, "conversations"))


@query
def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fill_middle.fill_in_middle(read_table(spark, sf_dir, "documents"))
    text = fill_middle.restored(F.col("form"), F.col("output"))
    return found.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(text.cast("binary"), 256).alias("restored_sha256"),
    )


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpus_pipeline import run

    return run(spark, sf_dir)


ORACLES: dict[str, str] = {
    "op9_line_dedup": r"""
        WITH lines AS (
          SELECT doc_id, u.pos, u.line,
            translate(trim(u.line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS bare
          FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents) d,
            LATERAL (SELECT unnest(range(1, len(d.parts) + 1)) AS pos, unnest(d.parts) AS line) u),
        repeated AS (
          SELECT bare, max(doc_id) AS top FROM lines WHERE length(bare) >= 20
          GROUP BY bare HAVING count(DISTINCT doc_id) >= 3)
        SELECT l.doc_id, count(*) AS n_lines,
          count(*) FILTER (r.bare IS NOT NULL AND l.doc_id <> r.top) AS n_dropped,
          sha256(coalesce(string_agg(l.line, chr(10) ORDER BY l.pos)
            FILTER (r.bare IS NULL OR l.doc_id = r.top), '')) AS kept_sha256
        FROM lines l LEFT JOIN repeated r ON r.bare = l.bare
        GROUP BY l.doc_id
    """,
}

# CRC-32 of a decimal number, a bit at a time; its last two bits say how many turns are shared.
_CRC = """list_reduce(list_prepend(4294967295::BIGINT,
          list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: ord(x)::BIGINT)),
          lambda crc, x: list_reduce(list_prepend(xor(crc, x), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
            lambda v, y: xor(v >> 1, 3988292384 * (v & 1))))"""

ORACLES["op12_prefix_trie"] = f"""
    WITH turns AS (
      SELECT conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS own,
        xor({_CRC}, 4294967295) & 3 AS h
      FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
    rebuilt AS (
      SELECT c.conv_id, list_concat(coalesce(b.own[1:c.h], []), c.own[c.h + 1:]) AS path
      FROM turns c LEFT JOIN turns b ON b.conv_id = c.conv_id - c.conv_id % 20),
    prefixes AS (
      SELECT conv_id, d AS depth, path[1:d] AS path, d = len(path) AS ends
      FROM (SELECT conv_id, path, unnest(range(0, len(path) + 1)) AS d FROM rebuilt)),
    nodes AS (
      SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
        coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '') AS ids,
        (count(*) - 1) * CASE WHEN depth = 0 THEN 0
          ELSE len(regexp_extract_all(path[depth].t, '[^\\x20\\x09-\\x0D]+')) END AS saved
      FROM prefixes GROUP BY path, depth),
    children AS (
      SELECT path[1:depth - 1] AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
    full_nodes AS (
      SELECT n.*, coalesce(c.n, 0) AS n_children FROM nodes n LEFT JOIN children c ON c.path = n.path),
    totals AS (
      SELECT path[1:d] AS path, sum(saved) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
      FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM full_nodes) GROUP BY ALL)
    SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, t.n_leaves,
      CAST(t.saved_tokens AS BIGINT) AS saved_tokens, sha256(n.ids) AS ends_sha256
    FROM full_nodes n JOIN totals t ON t.path = n.path
    LEFT JOIN nodes p ON n.depth > 0 AND p.path = n.path[1:n.depth - 1]
"""

ORACLES["op13_fill_in_middle"] = """
    WITH cut AS (
      SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || doc_id) AS digest,
        regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS units FROM documents),
    drawn AS (
      SELECT doc_id, text, units, len(units) AS n,
        CAST('0x' || digest[1:8] AS BIGINT) % (len(units) + 1) AS one,
        CAST('0x' || digest[9:16] AS BIGINT) % (len(units) + 1) AS two,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
            OR CAST('0x' || digest[17:24] AS BIGINT) % 100 >= 100 THEN 'plain'
          WHEN CAST('0x' || digest[25:32] AS BIGINT) % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM cut),
    parts AS (
      SELECT doc_id, text, n, form, array_to_string(units[1:least(one, two)], '') AS prefix,
        array_to_string(units[least(one, two) + 1:greatest(one, two)], '') AS middle,
        array_to_string(units[greatest(one, two) + 1:], '') AS suffix FROM drawn)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
      CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
      sha256(CASE form WHEN 'plain' THEN text
        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
      sha256(text) AS restored_sha256
    FROM parts
"""
