"""The registered queries of the corpus operators: production parameters, whole tables, full results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spikelens.llm import decontaminate, editprint, extract, jaccard, langid, merkle, packing, pitman_yor, quality, repeats, spelling, sql, toxicity, urlgraph
from spikelens.llm.common import documents, split_of
from spikelens.sources import stage


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packing_digest(packing.pack(documents(spark, sf_dir)))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = pitman_yor.score_corpus(documents(spark, sf_dir), pitman_yor.training_rows())
    return scored.select("doc_id", (~F.col("trained")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(documents(spark, sf_dir))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_contamination(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlgraph.judge_urls(documents(spark, sf_dir, "pages"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.fit_toxicity(docs, documents(spark, sf_dir, "labels"))
    scored = toxicity.score_toxicity(docs, model)
    return scored.select("doc_id", (split_of("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = extract.extract_pages(documents(spark, sf_dir, "pages"))
    return pages.withColumn("n_chars", F.length("text").cast("long"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = stage(quality.document_statistics(documents(spark, sf_dir)), "statistics")
    model = quality.fit_quality(stats, documents(spark, sf_dir, "labels"))
    return quality.judge_quality(stats, model).select("doc_id", *quality.COUNTS, "base_failed", "kept", "chance")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = langid.identify(docs, langid.fit_languages(docs, langid.training_rows()))
    return found.select("doc_id", (split_of("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeats_digest(repeats.remove_repeats(documents(spark, sf_dir)))


def op11_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return editprint.edit_fingerprints(documents(spark, sf_dir))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    proofs = merkle.merkle_proofs(docs, merkle.leaf_of(*[F.col(c) for c in merkle.FIELDS]), merkle.tampered_leaf())
    return merkle.verify_proofs(proofs).withColumnRenamed("row", "doc_id")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(documents(spark, sf_dir))


QUERIES = {
    f.__name__: f
    for f in (
        op1_packing,
        op2_lm_scoring,
        op3_ngram_jaccard_join,
        op4_decontamination,
        op5_url_filters,
        op6_toxicity,
        op7_html_extraction,
        op8_quality_rules,
        op9_language_id,
        op10_suffix_array_dedup,
        op11_document_fingerprints,
        op12_merkle_manifest,
        op13_spelling_variants,
    )
}
ORACLES: dict[str, str] = sql.ORACLES
