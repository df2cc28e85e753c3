"""The registered queries: each operator over its whole table, and check SQL where there can be any."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from buyerscope.llm import decontamination, fill_middle, importance, mixing, pii, quality, quality_model, rollups
from buyerscope.llm import sharding, simhash, token_counts, token_files, toxicity, warc
from buyerscope.llm.common import replaced, table, utf8
from buyerscope.llm.shared_files import new_folder
from buyerscope.sources.staging import staged

#: Tokenizer file of op4; a parameter wherever it is used.
TOKENIZER = "word_bpe_49k.json"
#: Tokenizer versions that op8 counts with, and their files.
VERSIONS = {"word-49k": "word_bpe_49k.json", "bytes-50k": "byte_bpe_50k.tiktoken"}


def op1_latent_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = docs.select("doc_id", F.xxhash64("text").alias("text"), sharding.text_size().alias("size"), F.crc32(utf8("text")).alias("text_crc32"))
    found = sharding.shard(rows, size=F.col("size"))
    return found.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op3_suffix_array_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op4_flat_uint32_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    parts = token_files.write(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return token_files.read(parts).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op5_transaction_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = warc.write(table(spark, sf_dir, "pages"))
    found = warc.payloads(warc.assemble(warc.records(spark, files)))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_deletion_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_checksums_and_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op8_delta_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inserts of all documents with estimated counts, the exact counts, removal of what labels call bad; two deliveries repeated.

    Versions are two tokenizers; the estimate is a token for four characters.
    """
    import public_tokenizers

    docs = replaced(table(spark, sf_dir, "documents"), estimate=F.ceil(F.coalesce("n_chars", F.lit(0)) / 4))
    paths = {v: public_tokenizers.path(file) for v, file in VERSIONS.items()}
    found = staged(
        token_counts.counted(docs, ["doc_id", "source", "lang", "estimate"], paths, public_tokenizers.PATTERN), "token-counts"
    )
    rows = found.unpivot(["doc_id", "source", "lang", "estimate"], list(VERSIONS), "version", "new_tokens")
    rows = rows.withColumnRenamed("estimate", "n_tokens")
    bad = table(spark, sf_dir, "labels").where("quality = 0").select("doc_id").distinct()
    gone = rows.join(bad, "doc_id", "left_semi").withColumn("n_tokens", F.col("new_tokens"))
    totals = rollups.Rollup(spark, new_folder(spark, "rollup"))
    totals.commit("1-insert", rollups.insert(rows))
    totals.commit("2-revise", rollups.revise(rows))
    totals.commit("2-revise", rollups.revise(rows))
    totals.compact()
    totals.commit("3-delete", rollups.delete(gone))
    totals.commit("1-insert", rollups.insert(rows))
    return totals.totals()


def op9_naive_bayes_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.scores(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op10_pareto_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = mixing.copies(docs, mixing.plan(docs))
    return found.select(
        "row.doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies"
    )


def op11_fenwick_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = fill_middle.rearranged(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_middle.restored(), 256).alias("restored_sha256"),
    )


def op12_segment_deduplication(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = importance.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def op13_follow_the_regularised_leader(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_model.scores(docs, quality_model.fit(docs, table(spark, sf_dir, "labels")))


QUERIES = {
    "op1_latent_decontamination": op1_latent_decontamination,
    "op2_sampled_splitters": op2_sampled_splitters,
    "op3_suffix_array_repetition": op3_suffix_array_repetition,
    "op4_flat_uint32_files": op4_flat_uint32_files,
    "op5_transaction_assembly": op5_transaction_assembly,
    "op6_deletion_variants": op6_deletion_variants,
    "op7_checksums_and_context": op7_checksums_and_context,
    "op8_delta_rollups": op8_delta_rollups,
    "op9_naive_bayes_ngrams": op9_naive_bayes_ngrams,
    "op10_pareto_order": op10_pareto_order,
    "op11_fenwick_cuts": op11_fenwick_cuts,
    "op12_segment_deduplication": op12_segment_deduplication,
    "op13_follow_the_regularised_leader": op13_follow_the_regularised_leader,
}

ORACLE = {
    "op11_fenwick_cuts": r"""
WITH hashed AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, ''))::BIGINT AS n, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS d FROM documents
), drawn AS (
  SELECT doc_id, t, n, ('0x' || substr(d, 1, 8))::BIGINT % (n + 1) AS x, ('0x' || substr(d, 9, 8))::BIGINT % (n + 1) AS y,
    ('0x' || substr(d, 17, 8))::BIGINT % 100 >= 90 OR n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') AS plain,
    ('0x' || substr(d, 25, 8))::BIGINT % 100 < 20 AS spm
  FROM hashed
), cut AS (
  SELECT doc_id, t, n, CASE WHEN plain THEN 'plain' WHEN spm THEN 'spm' ELSE 'psm' END AS form, least(x, y) AS a, greatest(x, y) AS b FROM drawn
), parts AS (
  SELECT *, substring(t, 1, a) AS p, substring(t, a + 1, b - a) AS m, substring(t, b + 1, n - b) AS s FROM cut
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts""",
}
