"""The pipeline's stages against brute force on the smallest table, and odd rows through all of them."""

from __future__ import annotations

import corpus_pipeline
from freightlens.llm import language

FOLDER = "/root/testdata/sf0.001"


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "exact_dedup", "simhash", "decontaminate", "pack"]


def test_pipeline_against_brute_force(spark):
    from test_dedup_ops import brute_fingerprint, plain_lower

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    items = [decon(r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    known = {r.doc_id for r in language.identify(spark.read.parquet(f"{FOLDER}/documents.parquet")).where("lang_pred <> 'und' and score >= 0.5").collect()}
    left = {r.doc_id: r.text for r in docs if r.doc_id in known}
    best: dict = {}
    for i, t in left.items():
        best[plain_lower(t)] = max(i, best.get(plain_lower(t), i))
    left = {i: left[i] for i in best.values()}
    prints = {i: brute_fingerprint(t) for i, t in sorted(left.items())}
    root = {i: i for i in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in prints:
        for b in prints:
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    left = {i: t for i, t in left.items() if find(i) == i}
    clean = {i for i, t in left.items() if not any(f" {item} " in f" {decon(t)} " for item in items)}
    got = {r.doc_id for r in corpus_pipeline.run(spark, FOLDER).select("doc_id").distinct().collect()}
    assert got == clean


def decon(text):
    import re

    return " ".join(re.findall(r"\w+", (text or "").lower()))


def test_odd_rows_pass_every_stage(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, length long, row string"
    odd = [(1, None, None, None, None, None, None), (None, "ab", "en", "s", 2, 1, "r"), (2, "", "en", "s", 0, 1, None),
           (3, "same text here", "en", "s", 1, 1, "b"), (3, "same text here", "en", "s", 1, 1, "a"), (4, "word " * 40_000, "en", "s", 1, 1, "x")]
    for rows in (odd, []):
        docs = spark.createDataFrame(rows, schema)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, FOLDER)
            assert docs.columns == [f.split()[0] for f in schema.split(", ")], name
        packed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
        assert {r.doc_id for r in packed} == ({None, 3, 4} if rows else set())
        assert all(r.row == "a" for r in docs.where("doc_id = 3").collect())
