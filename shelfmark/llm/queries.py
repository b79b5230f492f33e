"""The registered queries of the corpus operators: each runs over its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm import (
    licenses,
    line_dedup,
    mixing,
    near_duplicates,
    packing,
    periodic_runs,
    quality_model,
    quality_rules,
    secrets,
    surrogates,
    topk,
    warc,
    whitening,
)
from shelfmark.llm.common import kept, shared_folder

TOKENIZER = "word_bpe_49k.json"
KEY = "shelfmark-surrogates"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer_path())


def maxscore_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search_embeddings(_table(spark, sf_dir, "embeddings"))


def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality_model.score_quality(docs, _table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogates.replace_private(docs, KEY)


def warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = warc.with_revisits(_table(spark, sf_dir, "pages"))
    folder = shared_folder(spark, "warc")
    index = kept(warc.write_bundles(pages, folder), "warc-index")
    records = warc.read_records(index)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs, spans="removed").withColumn(
        "removed", F.coalesce("removed", F.array().cast("array<struct<start:int,stop:int>>"))
    )


def host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    judged = quality_rules.apply_host_rules(docs)
    return judged.select("doc_id", *counts, "base_failed", "host_rejected", "kept")


def minhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.each_row(mixing.mix(_table(spark, sf_dir, "documents")))
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return mixed.select("doc_id", "size", "source_size", "target", taken)


def embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deviations beyond 64 bits are null."""
    found = whitening.whiten(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return found.withColumn("deviation", F.col("deviation").try_cast("long"))


def periodic_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.detect_runs(_table(spark, sf_dir, "documents"), loop=True)
    line = lambda r: F.format_string("%d,%d,%d\n", r.start, r.length, r.period)
    return found.select(
        *("doc_id", "n_runs", "start", "length", "period", "exponent_milli"),
        F.sha2(F.concat_ws("", F.transform("runs", line)), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    def of(*kinds: str) -> Column:
        return F.filter("spans", lambda s: s.kind.isin(*kinds))

    def listed(spans: Column) -> Column:
        return F.concat_ws(",", F.transform(spans, lambda s: F.format_string("%s:%d:%d", s.kind, s.start, s.stop)))

    found = secrets.scan_secrets(_table(spark, sf_dir, "documents"))
    counts = [F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in secrets.BASE_KINDS]
    digest = F.sha2(listed(of(*secrets.BASE_KINDS)), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, listed(F.col("spans")).alias("spans"))


QUERIES = {
    "op1_license_scan": license_scan,
    "op2_best_fit_packing": best_fit_packing,
    "op3_maxscore_top_k": maxscore_top_k,
    "op4_quality_scores": quality_scores,
    "op5_pii_surrogates": pii_surrogates,
    "op6_warc_bundles": warc_bundles,
    "op7_line_runs": line_runs,
    "op8_host_rules": host_rules,
    "op9_minhash_components": minhash_components,
    "op10_source_mix": source_mix,
    "op11_embedding_whitening": embedding_whitening,
    "op12_secret_scan": secret_scan,
    "op13_periodic_runs": periodic_words,
}
