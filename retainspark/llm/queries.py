"""Registered queries of the training-data operators: ``(spark, sf_dir)`` to a
DataFrame over the whole table, and DuckDB SQL where SQL can express one."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from retainspark.llm import arrow_tokens, decontaminate, langid, negatives, packing, pieces, preference, quality, repair, sharding, simhash, substring, warc
from retainspark.llm.common import hex16, materialise, table

import corpus_pipeline
QUERIES = {}
ORACLES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op2_simhash_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document: 3-word shingles, 2 bits."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return found.select("doc_id", hex16(F.col("fp")).alias("fingerprint"), "component_id")


@query
def op5_rabin_karp_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left of every document after repeated 20-word windows are removed."""
    out = substring.remove_repeats(table(spark, sf_dir, "documents"), window=20, keep=["doc_id"])
    return out.select("doc_id", "n_words", "n_removed",
                      F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


ORACLES["op5_rabin_karp_spans"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, s, array_to_string(w[s:s+19], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM d)),
later AS (SELECT doc_id, s FROM g QUALIFY row_number() OVER (PARTITION BY g ORDER BY doc_id, s) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS p FROM later),
cut AS (SELECT doc_id, count(*) AS n, list(p) AS ps FROM gone GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed,
       sha256(coalesce(array_to_string(CASE WHEN n IS NULL THEN w ELSE list_transform(list_filter(range(1, len(w) + 1), lambda i: NOT list_contains(ps, i)), lambda i: w[i]) END, ' '), '')) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)
"""


@query
def op8_broadcast_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside 10-word windows of the benchmark."""
    out = decontaminate.find_contamination(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                           table(spark, sf_dir, "benchmark"), n=10)
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


ORACLES["op8_broadcast_ngrams"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, unnest(CASE WHEN len(w) < 10 THEN [w] ELSE list_transform(range(1, len(w) - 8), lambda i: w[i:i+9]) END) AS g FROM b WHERE len(w) > 0),
sizes AS (SELECT DISTINCT len(g) AS n FROM bw),
dw AS (SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS s, w FROM d, sizes),
hit AS (SELECT doc_id, s, n, g, item_id FROM (SELECT doc_id, s, n, w[s:s+n-1] AS g FROM dw) JOIN bw USING (g)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, list_sort(list(DISTINCT item_id::VARCHAR)) AS i FROM hit GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(len(i), 0)::BIGINT AS n_items,
       sha256(coalesce(array_to_string(i, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query
def op7_histogram_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document: 16 shards of equal bytes in id order."""
    out = sharding.shard_by_bytes(table(spark, sf_dir, "documents").select("doc_id", "text"), shards=16)
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return out.select("doc_id", "size", F.crc32(text).alias("text_crc32"), F.lit("bytes").alias("law"),
                      "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


# crc32 by its bit rule: a table of 256 steps, then one table look-up per byte
ORACLES["op7_histogram_sort"] = """
WITH RECURSIVE bits AS (SELECT i, i::BIGINT AS c, 0 AS k FROM range(256) r(i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
steps AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) + 1 AS size FROM documents),
s AS (SELECT *, coalesce(sum(size) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
             sum(size) OVER () AS total FROM d),
p AS (SELECT *, (before * 16 // total)::INT AS shard FROM s)
SELECT doc_id, size::BIGINT AS size,
       xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, size - 1), lambda i: ('0x' || h[2 * i + 1:2 * i + 2])::BIGINT)),
           lambda c, b: xor(t[xor(c & 255, b) + 1], c >> 8)))::BIGINT AS text_crc32,
       'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, NULL::INT AS grown_shard
FROM p, steps
"""


@query
def op1_crf_line_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word counts and the content verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.label_lines(docs, model, keep=["doc_id"]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "content_share")


@query
def op9_crf_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; the model has seen four folds of five."""
    docs = table(spark, sf_dir, "documents")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    model = langid.fit(docs.filter(fold != 0))
    rows = docs.select("doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), "text")
    return langid.identify(rows, model, keep=["doc_id", "held_out"]).drop("segments")


@query
def op6_gumbel_segmentations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two distinct sampled segmentations of every document, decoded again."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"))
    out = pieces.sample_segmentations(rows, model, k=2, keep=["doc_id", "text_crc32"], decoded=True)
    return out.select("doc_id", "sample", "n_pieces", "log_prob", "perturbed", "log_inclusion",
                      F.crc32("ids").alias("ids_crc32"),
                      (F.crc32(F.col("decoded").cast("binary")) == F.col("text_crc32")).alias("round_trip"))


@query
def op3_arrow_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, size and checksum of every document's ids, read from the files."""
    folder = arrow_tokens.token_folder(spark)
    files = arrow_tokens.write_sequences(table(spark, sf_dir, "documents"), folder,
                                         public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return arrow_tokens.read_documents(spark, folder, files)


@query
def op4_preference_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation against the same one with another's last answer: the
    conversation whose number differs in the lowest bit gives the rejected
    answer.  Conversations without a partner's answer have the chosen side only."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    last = (turns.filter("role = 'assistant'").groupBy("conv_id").agg(F.max(F.struct("turn", "text")).alias("l"))
            .select("conv_id", F.col("l.turn").alias("at"), F.col("l.text").alias("reply")))
    other = last.select(F.col("conv_id").bitwiseXOR(F.lit(1)).alias("conv_id"), F.col("reply").alias("other"))
    cut = last.join(other, "conv_id")
    rejected = (turns.join(cut, "conv_id").filter("turn < at").select(turns.columns)
                .union(cut.select("conv_id", "at", F.lit("assistant"), "other")))
    return preference.format_preferences(turns, rejected, pair="conv_id")


ORACLES["op4_preference_prefix"] = """
WITH l AS (SELECT conv_id, max(turn) AS last_turn, max_by(text, turn) AS reply FROM conversations WHERE role = 'assistant' GROUP BY conv_id),
cut AS (SELECT l.conv_id, l.last_turn, p.reply AS other FROM l JOIN l p ON p.conv_id = xor(l.conv_id, 1)),
t AS (SELECT conv_id, 'c' AS side, turn, role, text FROM conversations
  UNION ALL SELECT conv_id, 'r', turn, role, text FROM conversations JOIN cut USING (conv_id) WHERE turn < last_turn
  UNION ALL SELECT conv_id, 'r', last_turn, 'assistant', other FROM cut),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id, side ORDER BY turn) - 1 AS i FROM t),
n AS (SELECT coalesce(a.conv_id, b.conv_id) AS conv_id,
    coalesce(min(CASE WHEN a.i IS NULL OR b.i IS NULL OR a.role <> b.role OR a.text <> b.text THEN coalesce(a.i, b.i) END), count(*)) AS n
  FROM (SELECT * FROM o WHERE side = 'c') a FULL JOIN (SELECT * FROM o WHERE side = 'r') b ON a.conv_id = b.conv_id AND a.i = b.i GROUP BY 1),
s AS (SELECT o.*, n, '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS x FROM o JOIN n USING (conv_id)),
e AS (SELECT *, sum(CASE WHEN i >= n THEN length(x) ELSE 0 END) OVER (PARTITION BY conv_id, side ORDER BY i)::BIGINT AS e FROM s),
m AS (SELECT *, (e - length(text) - 11)::VARCHAR || '-' || e::VARCHAR AS span FROM e)
SELECT conv_id, any_value(n)::BIGINT AS n_prompt,
  coalesce(string_agg(x, '' ORDER BY i) FILTER (side = 'c' AND i < n), '') AS prompt,
  coalesce(string_agg(x, '' ORDER BY i) FILTER (side = 'c' AND i >= n), '') AS chosen,
  coalesce(string_agg(x, '' ORDER BY i) FILTER (side = 'r' AND i >= n), '') AS rejected,
  (count(*) FILTER (side = 'c' AND i >= n))::BIGINT AS n_chosen, (count(*) FILTER (side = 'r' AND i >= n))::BIGINT AS n_rejected,
  coalesce(string_agg(span, ',' ORDER BY i) FILTER (side = 'c' AND i >= n AND role = 'assistant'), '') AS chosen_mask,
  coalesce(string_agg(span, ',' ORDER BY i) FILTER (side = 'r' AND i >= n AND role = 'assistant'), '') AS rejected_mask
FROM m GROUP BY conv_id
"""


@query
def op10_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata and conversion records of every page, whole."""
    return warc.derivatives(table(spark, sf_dir, "pages"), keep=["page_id"])


@query
def op11_sorted_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cheapest repair of every conversation of the damaged turns."""
    turns = table(spark, sf_dir, "conversations")
    rows = repair.damage(turns.select("conv_id", "turn", "role", "text"))
    planned = materialise(repair.plans(rows, turns), "repair-plans")
    hashed = repair.digests(rows, planned).withColumnRenamed("conv_id", "of")
    return planned.join(hashed, F.col("conv_id").eqNullSafe(F.col("of"))).drop("of")


@query
def op12_threshold_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth vector, from all vectors."""
    rows = table(spark, sf_dir, "embeddings").filter("label IS NOT NULL AND embedding IS NOT NULL")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = rows.filter(~F.exists("embedding", bad)).select(
        F.col("vec_id").alias("id"), F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"),
        F.transform("embedding", lambda x: F.floor(x.cast("double") * 256)).alias("vector"))
    return negatives.mine(rows, rows.filter("id % 50 = 0"))


ORACLES["op12_threshold_negatives"] = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS own, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM v a, v b WHERE a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE own
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER w::INT AS rank, id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT own AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)
QUALIFY row_number() OVER w <= 3
"""


@query
def op13_nnls_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces in sequences of 2048 ids (or a power of two)."""
    out = packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
