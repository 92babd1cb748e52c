"""One query for each operator over its whole table, and their SQL where SQL can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmill.llm import (
    byte_bpe,
    candidate_pii,
    chosen_path,
    fertility,
    learned_partitions,
    pivot_clusters,
    positional_index,
    quotation_links,
    string_kernel,
    suffix_dedup,
    trie_lm,
    viterbi_counts,
    window_alignment,
)
from newsmill.llm.tables import fold, read, stored

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
MERGES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.dedup(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def tokeniser_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return fertility.rate(docs, PIECES, RANKS, public_tokenizers.PATTERN).drop("text")


def subsequence_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = string_kernel.train(string_kernel.with_labels(docs.filter(fold(F.col("doc_id")) != 0), labels))
    return string_kernel.score(docs, model).select("doc_id", F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "score", "predicted")


def elias_fano_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return trie_lm.score(docs, fold(F.col("doc_id")) == 1).select(
        F.col("id").alias("doc_id"), F.col("held").alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def positional_index_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = positional_index.contamination(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


def viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return viterbi_counts.token_counts(docs, PIECES).select("doc_id", "n_tokens", "n_byte_tokens")


def segment_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    ids = byte_bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN)
    return ids.select("doc_id", F.expr("octet_length(token_ids) div 4").cast("long").alias("n_tokens"),
                      F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def boosted_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    each = candidate_pii.spans_by_text(candidate_pii.find(docs))
    base = F.filter("spans", lambda s: s["base"])
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")
    table = stored(each.select("key", *map(count, candidate_pii.KINDS), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans")), "span-columns")
    keyed = docs.select("doc_id", positional_index.text_key(F.col("text")).alias("key")).join(table, "key", "left")
    return keyed.select("doc_id", *(F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in candidate_pii.KINDS),
                        F.coalesce("base_sha256", F.sha2(F.lit(""), 256)).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"))


def chosen_path_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return chosen_path.classes(docs).select(F.col("id").alias("doc_id"), "class_id", "class_size", "n_links")


def quotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = quotation_links.link(read(spark, sf_dir, "conversations"))
    return linked.select("conv_id", "turn", "role", "formatted", "n_quoted", "n_linked", "reply_to", "root", "depth", F.array_join(F.transform("path", lambda x: x.cast("string")), "/").alias("path"))


def anchor_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return window_alignment.align(docs, MERGES, public_tokenizers.PATTERN, PIECES)[0]


CENTROID_COLUMNS = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def pivot_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pivot_clusters.cluster(
        read(spark, sf_dir, "embeddings"), order=lambda x: F.sha2(F.concat(F.lit("3:"), x.cast("string")).cast("binary"), 256))
    if found is None:
        return spark.createDataFrame([], CENTROID_COLUMNS)
    return pivot_clusters.with_statistics(found).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def learned_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return learned_partitions.search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def pivot_table_sql(rounds: int = 10, k: int = 8) -> str:
    """The rounds as one chain of tables: components (vec_id, pos, x) and centroids (c, pos, x)."""
    steps = ["""kept AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)""",
             "parts AS MATERIALIZED (SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM kept)",
             f"""firsts AS (SELECT vec_id, row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS c FROM kept QUALIFY c < {k}),
c0 AS MATERIALIZED (SELECT c, pos, x FROM firsts JOIN parts USING (vec_id))"""]
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (SELECT vec_id, arg_min(c, (d, c)) AS cluster, min(d) AS distance FROM (
  SELECT vec_id, c, CAST(sum((p.x - m.x) * (p.x - m.x)) AS BIGINT) AS d FROM parts p JOIN c{i} m USING (pos) GROUP BY vec_id, c) GROUP BY vec_id)""")
        if i < rounds:
            steps.append(f"""s{i} AS (SELECT cluster AS c, pos, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM parts JOIN a{i} USING (vec_id) GROUP BY cluster, pos),
c{i + 1} AS MATERIALIZED (SELECT c, pos, COALESCE((s - ((s % n) + n) % n) // n, o.x) AS x FROM c{i} o LEFT JOIN s{i} USING (c, pos))""")
    return "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, digest AS centroid_sha256
FROM a{rounds} JOIN (SELECT c AS cluster, sha256(string_agg(x, ',' ORDER BY pos)) AS digest FROM c{rounds} GROUP BY c) USING (cluster)"""


WORDS_SQL = f"regexp_extract_all(translate(text, '{positional_index.UPPER}', '{positional_index.LOWER}'), '{positional_index.WORD}')"
POSITIONAL_SQL = f"""WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, COALESCE({WORDS_SQL}, []) AS w FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item, {WORDS_SQL} AS w FROM benchmark),
windows AS MATERIALIZED (SELECT DISTINCT item, list_slice(w, i, i + 9) AS x FROM (
  SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT len(x) AS n FROM windows),
places AS (SELECT r, i, n, list_slice(w, i, i + n - 1) AS x FROM (
  SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs JOIN sizes ON len(w) >= n)),
found AS MATERIALIZED (SELECT r, i, n, x FROM places SEMI JOIN windows USING (x)),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM found) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (
  SELECT DISTINCT r, item FROM found JOIN windows USING (x) WHERE item IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, COALESCE(n_hit, 0) AS n_hit, COALESCE(n_items, 0) AS n_items,
  sha256(COALESCE(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN hit USING (r) LEFT JOIN named USING (r)"""


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_suffix_array": suffix_array, "op2_tokeniser_fertility": tokeniser_fertility, "op3_subsequence_kernel": subsequence_kernel,
    "op4_elias_fano_trie": elias_fano_trie, "op5_positional_index": positional_index_hits, "op6_viterbi_counts": viterbi,
    "op7_segment_tree_bpe": segment_tree_bpe, "op8_boosted_pii": boosted_pii, "op9_chosen_path": chosen_path_join,
    "op10_quotation_links": quotations, "op11_pivot_table": pivot_table, "op12_anchor_windows": anchor_windows,
    "op13_learned_partitions": learned_parts, "pipeline": pipeline,
}
ORACLES: dict[str, str] = {"op5_positional_index": POSITIONAL_SQL, "op11_pivot_table": pivot_table_sql()}
