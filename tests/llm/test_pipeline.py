"""The pipeline: registered, stage by stage on messy rows, and whole against its parts."""

import importlib.util
import os
import zlib

import numpy as np

import corpus_pipeline as C
from tavolo.llm import packing
from tavolo.llm.shared import written

SF = "/root/testdata/sf0.001"


def test_registered_queries():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(os.path.dirname(C.__file__), "__spark_entry__.py"))
    entry = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(entry)
    names = [q for q in entry.queries() if q == "pipeline" or q.startswith("op")]
    assert sorted(n.split("_")[0] for n in names if n.startswith("op") and n[2].isdigit()) == sorted(f"op{i}" for i in range(1, 14)) and "pipeline" in names
    assert {"op2_line_dedup", "op9_url_filters", "op12_source_divergence", "op13_reply_trees"} <= set(entry.oracle_sql())


def test_stages_on_messy_rows(spark, clashing, nothing):
    for docs in (clashing, nothing):
        for i, (_, stage) in enumerate(C.STAGES):
            out = written(stage(spark, docs, SF), "test")
            if i < len(C.STAGES) - 1:
                assert out.columns == docs.columns
                docs = out
        assert docs is not clashing
        assert (out.count() == 0) == (docs.count() == 0)


def test_run_is_the_stages_and_packs_what_they_keep(spark):
    packed = C.run(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    n = [docs.count()]
    for _, stage in C.STAGES[:-1]:
        docs = written(stage(spark, docs, SF), "test")
        n.append(docs.count())
    assert n[0] > n[1] == n[2] > n[3] and docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    table = packing.WordIds(packing.vocabulary_path())
    want = []
    for doc, text in texts:
        ids = table.ids((text or "").encode()) + np.array([1], "<u4").tobytes()
        want += [(doc, s, length, zlib.crc32(ids[4 * s:4 * (s + length)])) for s, length, _ in packing.cut(len(ids) // 4)]
    assert sorted((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in packed) == sorted(want)

