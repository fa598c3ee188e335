"""Queries that apply each text operator to its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers

import corpus_pipeline
from tripkpi.llm import (
    dialogue,
    infilling,
    language,
    minhash,
    mixing,
    oracles,
    quality_lines,
    simhash,
    site_style,
    suffixes,
    token_counts,
    toxicity,
    vptree,
    wfst,
)
from tripkpi.llm.common import table

PIECES = "piece_bpe_32k.model"


def op1_sentencepiece(spark, sf_dir):
    return wfst.encode(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))


def op2_toxicity(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return toxicity.score(documents, toxicity.fit(documents, table(spark, sf_dir, "labels")))


def op3_quality_rules(spark, sf_dir):
    return quality_lines.assess(table(spark, sf_dir, "documents"))


def op4_suffix_dedup(spark, sf_dir):
    return suffixes.repeats(table(spark, sf_dir, "documents"))


def op5_minhash(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_nearest_neighbours(spark, sf_dir):
    return vptree.nearest(table(spark, sf_dir, "embeddings"))


def op7_html_extraction(spark, sf_dir):
    return site_style.extract(table(spark, sf_dir, "pages"))


def op8_language_id(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return language.identify(documents, language.fit(documents))


def op9_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


def op10_token_counts(spark, sf_dir):
    path = public_tokenizers.path(PIECES)
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), path)


def op11_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op12_fill_in_middle(spark, sf_dir):
    return infilling.digests(infilling.infill(table(spark, sf_dir, "documents")))


def op13_conversation_repair(spark, sf_dir):
    return dialogue.digests(table(spark, sf_dir, "conversations"))


def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)


_QUERIES = (
    op1_sentencepiece,
    op2_toxicity,
    op3_quality_rules,
    op4_suffix_dedup,
    op5_minhash,
    op6_nearest_neighbours,
    op7_html_extraction,
    op8_language_id,
    op9_mixing,
    op10_token_counts,
    op11_simhash,
    op12_fill_in_middle,
    op13_conversation_repair,
    pipeline,
)


def queries():
    return {query.__name__: query for query in _QUERIES}


def oracle_sql():
    return oracles.oracle_sql()
