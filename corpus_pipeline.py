"""From raw documents to packed training sequences.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame, which is
written and read again as the next one's ``docs``.  All but the last return the columns of ``documents``.

1. quality rules: documents that a rule rejects go;
2. language ID, fitted on the stage's own input: documents of undetermined language go;
3. n-gram Jaccard join: one document of each component stays, the one with the smallest id;
4. mixing: every document is taken as often as its rounded rate says (not at all, once or twice);
5. best-fit packing: one row per piece with its sequence and offset.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickframe.llm import jaccard_join, language_id, mixing, packing, quality_rules
from tickframe.llm.common import stage_table, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs)


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.keep_identified(docs, language_id.train(docs, F.lit(True)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.one_per_component(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality),
    ("language ID", languages),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources", mixture),
    ("best-fit packing", sequences),
]

#: Trained models and connected components have no SQL form; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stage_table(docs, f"pipeline-{k}")
    return docs
