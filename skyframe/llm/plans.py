"""The registered queries of the document and vector operators, with SQL where SQL can say them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from skyframe.llm import (
    collocations, conversations, exact_search, licenses, line_dedup, mixing, neighbours, packing, simhash, subwords, surrogates, toxicity, windows)
from skyframe.plans.registry import query, table

BYTE_BPE = "byte_bpe_50k.json"
PIECE_BPE = "piece_bpe_32k.model"
CHAIN = ["quality", "toxic"]


def tokenizer_files() -> dict[str, str]:
    """Where the given vocabulary lies, as the tokenizer's own file and as ranks."""
    return {"path": public_tokenizers.path(BYTE_BPE), "ranks": public_tokenizers.path("byte_bpe_50k.tiktoken"), "pattern": public_tokenizers.PATTERN}


@query("op1_multiprobe_neighbours")
def op1_multiprobe_neighbours(spark, folder):
    """The five nearest vectors by cosine that multiprobe hashing finds for every fiftieth vector."""
    return neighbours.search(table(spark, folder, "embeddings"), "id % 50 = 0", 5)


SCORE_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, r.vec_id, CAST(list_dot_product(q.v, r.v) AS BIGINT) AS score
  FROM v q JOIN v r ON q.vec_id <> r.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM s
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 20
"""


@query("op2_exact_top_k", SCORE_SQL)
def op2_exact_top_k(spark, folder):
    """The twenty greatest inner products of every twentieth vector, in whole 64ths."""
    return exact_search.top_k(exact_search.as_integers(table(spark, folder, "embeddings")), "id % 20 = 0", 20)


@query("op3_best_fit_packing")
def op3_best_fit_packing(spark, folder):
    """All documents as byte-level ids in sequences of at most 1024 tokens."""
    return packing.packed_sequences(table(spark, folder, "documents"), **tokenizer_files())


LINE_SQL = r"""
WITH line AS (
  SELECT doc_id, n, unnest(l) AS line, unnest(range(len(l))) AS place
  FROM (SELECT doc_id, row_number() OVER () AS n, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM line),
known AS (
  SELECT key, max(doc_id) AS keeps FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
judged AS (
  SELECT k.*, coalesce(k.doc_id <> known.keeps, false) AS dropped FROM keyed k LEFT JOIN known ON k.key = known.key)
SELECT doc_id, count(*) AS n_lines, CAST(sum(dropped::INT) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id, n
"""


@query("op4_line_dedup", LINE_SQL)
def op4_line_dedup(spark, folder):
    """Lines that three documents or more hold, dropped from all but the last."""
    rows = line_dedup.without_repeated_lines(table(spark, folder, "documents"), raw=True)
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@query("op5_simhash")
def op5_simhash(spark, folder):
    """Near copies by SimHash fingerprints that differ in at most four bits."""
    return simhash.near_groups(table(spark, folder, "documents"), words=4, max_bits=4)


WINDOW_SQL = r"""
WITH word AS (
  SELECT doc_id, n, w, len(w) AS n_words FROM (
    SELECT doc_id, row_number() OVER () AS n, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents)),
win AS (
  SELECT doc_id, n, p, array_to_string(list_slice(w, p + 1, p + 20), ' ') AS content
  FROM (SELECT doc_id, n, w, unnest(range(n_words - 19)) AS p FROM word WHERE n_words >= 20 AND doc_id IS NOT NULL)),
first AS (SELECT content, min((doc_id, p)) AS best FROM win GROUP BY content HAVING count(*) > 1),
lost AS (
  SELECT DISTINCT n, p + k AS place FROM win JOIN first USING (content), (SELECT unnest(range(20)) AS k)
  WHERE (doc_id, p) <> best),
kept AS (
  SELECT word.n, list(x.v ORDER BY x.i) AS w FROM word, (SELECT n, unnest(w) AS v, unnest(range(n_words)) AS i FROM word) x
  WHERE x.n = word.n AND NOT EXISTS (SELECT 1 FROM lost WHERE lost.n = x.n AND lost.place = x.i) GROUP BY word.n)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(n_words - coalesce(len(kept.w), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(kept.w, ' '), '')) AS kept_sha256
FROM word LEFT JOIN kept ON word.n = kept.n
"""


@query("op6_window_dedup", WINDOW_SQL)
def op6_window_dedup(spark, folder):
    """Words of 20-word windows that start earlier too, removed."""
    rows = windows.without_repeated_windows(table(spark, folder, "documents"), raw=True)
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op7_license_scan")
def op7_license_scan(spark, folder):
    """License phrases and notices of every document."""
    return licenses.digest(licenses.scan(table(spark, folder, "documents")))


@query("op8_toxicity_chain")
def op8_toxicity_chain(spark, folder):
    """Every document's probabilities along the chain, and whether it is rejected."""
    rows = toxicity.toxic(table(spark, folder, "documents"), table(spark, folder, "labels"), CHAIN, "toxic")
    # Six digits: sums over the words of a text come in any order.
    return rows.select("doc_id", *[F.round(F.col("p")[i], 6).alias(f"p_{c}") for i, c in enumerate(CHAIN)], F.col("rejected").alias("toxic"))


@query("op9_surrogates")
def op9_surrogates(spark, folder):
    """Every document with its personal data and secrets replaced."""
    rows = surrogates.with_surrogates(table(spark, folder, "documents"), key="surrogates-1")
    kinds = F.array_join(F.array_sort(F.array_distinct(F.col("entities.kind"))), ",")
    return rows.select("doc_id", "text", F.size("entities").cast("long").alias("n_entities"), kinds.alias("kinds"))


@query("op10_mixing")
def op10_mixing(spark, folder):
    """How many words of every document a mix of all sources by weight takes."""
    return mixing.mixed(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op11_collocations")
def op11_collocations(spark, folder):
    """Every language's first 2000 phrases of two to four words by how firmly their parts belong together."""
    return collocations.collocations(table(spark, folder, "documents"))


@query("op12_subword_round_trip")
def op12_subword_round_trip(spark, folder):
    """Digests of every text's SentencePiece ids and of the text that they decode to."""
    rows = subwords.encoded(table(spark, folder, "documents"), public_tokenizers.path(PIECE_BPE))
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"), "agrees")


@query("op13_conversation_repair")
def op13_conversation_repair(spark, folder):
    """Faults, cheapest edits and the repaired form of every damaged conversation."""
    rows = table(spark, folder, "conversations")
    return conversations.audits(conversations.damaged(rows), rows)
