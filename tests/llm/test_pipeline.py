"""The corpus pipeline against plain Python, stage by stage."""
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers

import corpus_pipeline
from test_operators import SF, components_by_hand
from tickframe.llm import common, token_counts
from tickframe.llm.queries import ORACLES


def test_stages(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    docs = {r[0]: r[1] for r in con.execute("SELECT doc_id, text FROM documents").fetchall()}
    judged = con.execute(f"SELECT doc_id FROM ({ORACLES['op9_quality_rules']}) WHERE kept").fetchall()
    found, tables = spark.read.parquet(f"{SF}/documents.parquet"), []
    columns = found.columns
    for name, stage in corpus_pipeline.STAGES:
        found = common.stage_table(stage(spark, found, SF), "test-pipeline")
        tables.append(found)
    assert all(t.columns == columns for t in tables[:-1])
    ids = [[r.doc_id for r in t.select("doc_id").collect()] for t in tables[:-1]]
    assert sorted(ids[0]) == sorted(r[0] for r in judged)
    assert set(ids[1]) <= set(ids[0]) and len(ids[1]) > 0.98 * len(ids[0])
    assert sorted(ids[2]) == sorted({c for _, _, c in components_by_hand([(i, docs[i]) for i in ids[1]])})
    assert set(ids[3]) <= set(ids[2]) and max(Counter(ids[3]).values()) <= 2
    tokenizer = token_counts.load_tokenizer(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    for i in ids[3]:
        x = np.array([*tokenizer.encode(docs[i], add_special_tokens=False).ids, 1], "<u4")
        want.update((i, p, zlib.crc32(x[p * 4096:(p + 1) * 4096].tobytes())) for p in range(-(-len(x) // 4096)))
    assert Counter((r.doc_id, r.piece, r.ids_crc32) for r in tables[-1].collect()) == want


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.stage_table(stage(spark, docs, SF), "test-pipeline")
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == 0
