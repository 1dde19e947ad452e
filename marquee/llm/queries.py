"""Registered queries: each applies its operator, with production parameters, to whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

import corpus_pipeline
from marquee.llm import qualityrules
from marquee.llm.bytebpe import encode_and_decode
from marquee.llm.chunkdedup import remove_repeats
from marquee.llm.collocations import collocations
from marquee.llm.common import read, vocabulary, written
from marquee.llm.decontam import find_leaks
from marquee.llm.hyperminhash import near_duplicates
from marquee.llm.htmltext import extract_main_text
from marquee.llm.ordermin import document_fingerprints
from marquee.llm.oracles import ORACLES  # noqa: F401  (re-exported for the entry module)
from marquee.llm.ruleclassifier import classify
from marquee.llm.suffixdedup import remove_repeated
from marquee.llm.surrogates import replace_entities
from marquee.llm.urlfilter import judge_urls
from marquee.llm.whitening import whiten


def op1_main_text(spark, sf_dir):
    pages = read(spark, sf_dir, "pages", "page_id", "url", "html")
    return extract_main_text(pages, "html", keep=["page_id", "url"])


def op2_near_duplicates(spark, sf_dir):
    return near_duplicates(read(spark, sf_dir, "documents", "doc_id", "text"))


def op3_surrogates(spark, sf_dir):
    return replace_entities(read(spark, sf_dir, "documents", "doc_id", "text"), corpus_pipeline.SURROGATE_KEY)


def op4_suffix_dedup(spark, sf_dir):
    return remove_repeated(read(spark, sf_dir, "documents", "doc_id", "text"), keep=["doc_id"], texts=False)


def op5_quality_rules(spark, sf_dir):
    # the statistics are narrow: written once, then read to fit and to judge
    stats = written(qualityrules.with_stats(read(spark, sf_dir, "documents", "doc_id", "text"), keep=["doc_id"]), "op5-stats")
    model = qualityrules.fit_votes(qualityrules.vote_counts(stats))
    return qualityrules.judge(stats, model).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.round("p_good", 6).alias("p_good"))


def op6_chunk_dedup(spark, sf_dir):
    return remove_repeats(read(spark, sf_dir, "documents", "doc_id", "text"))


def op7_byte_bpe(spark, sf_dir):
    return encode_and_decode(read(spark, sf_dir, "documents", "doc_id", "text"), *vocabulary(), keep=["doc_id"])


def op8_decontamination(spark, sf_dir):
    found = find_leaks(read(spark, sf_dir, "documents", "doc_id", "text"), read(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select("doc_id", "n_words", "n_hit", F.size("leak_items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("leak_items", ","), 256).alias("items_sha256"), "contaminated")


def op9_url_filter(spark, sf_dir):
    return judge_urls(read(spark, sf_dir, "pages", "page_id", "url")).select("page_id", "host", "path", "rule", "verdict")


def op10_quality_classifier(spark, sf_dir):
    stats = written(qualityrules.with_stats(read(spark, sf_dir, "documents", "doc_id", "text"), keep=["doc_id"]), "op10-stats")
    return classify(stats, read(spark, sf_dir, "labels", "doc_id", "quality")).select("doc_id", "held_out", "score", "predicted")


def op11_document_fingerprints(spark, sf_dir):
    return document_fingerprints(read(spark, sf_dir, "documents", "doc_id", "text"))


def op12_embedding_whitening(spark, sf_dir):
    rows = whiten(read(spark, sf_dir, "embeddings", "vec_id", "embedding"))
    return rows.withColumn("deviation", F.col("deviation").cast("long"))


def op13_collocations(spark, sf_dir):
    return collocations(read(spark, sf_dir, "documents", "lang", "text"))


QUERIES = {
    "op1_main_text": op1_main_text,
    "op2_near_duplicates": op2_near_duplicates,
    "op3_surrogates": op3_surrogates,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_quality_rules": op5_quality_rules,
    "op6_chunk_dedup": op6_chunk_dedup,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_decontamination": op8_decontamination,
    "op9_url_filter": op9_url_filter,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_document_fingerprints": op11_document_fingerprints,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_collocations": op13_collocations,
    "pipeline": corpus_pipeline.run,
}
