"""The pipeline on the smallest given tables, stage by stage against brute force."""

import re

import corpus_pipeline
from test_text_operators import brute_classes, brute_repeats

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    kept, frames = [], []
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, SF), f"test-{name}")
        frames.append(docs)
        kept.append({r.doc_id: r.text for r in docs.collect()} if "text" in docs.columns else None)
    assert all(f.columns == columns for f in frames[:-1])
    clean, single, cut, fresh = kept[:4]
    assert set(single) == {i for i, (_, c) in brute_classes(sorted(clean.items()), 5, 80, 100).items() if i == c}
    removed = {r[0]: r[2] for r in brute_repeats(sorted(single.items()))}
    assert set(cut) == set(single)
    assert all((cut[i] == single[i]) == (removed[i] == 0) for i in cut)
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in t or ""))
    windows = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = words(r.text)
        windows |= {tuple(w[k : k + 10]) for k in range(len(w) - 9)}
    bad = {i for i, t in cut.items() if any(tuple(words(t)[k : k + 10]) in windows for k in range(len(words(t)) - 9))}
    assert set(fresh) == set(cut) - bad
    assert {r.doc_id for r in frames[-1].collect()} == set(fresh)


def test_empty_and_odd_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for some in (docs.where("false"), docs.limit(1).selectExpr("cast(null as bigint) doc_id", "cast(null as string) text", "lang", "source", "n_chars", "1 as component_id")):
        n = some.count()
        for _, stage in corpus_pipeline.STAGES:
            some = corpus_pipeline.stored(stage(spark, some, SF), "test-odd")
            assert some.count() == n


def test_clashing_column_names(spark):
    """Columns named like helpers of the stages come out as they went in."""
    names = ["__id", "__hash", "__text", "__kept", "__row", "__none", "id_", "hash_", "its_hash", "kept_text", "none", "kept_id",
             "row_no", "toxicity_score", "Toxicity_Score_", "named", "component_id", "start", "text_hash", "w", "h"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs = docs.selectExpr("*", *[f"concat('{n}', doc_id) as `{n}`" for n in names])
    repeated = docs.unionByName(docs.limit(1))  # a repeated id takes the second stage's other way
    for first in (docs, repeated):
        some = first
        for name, stage in corpus_pipeline.STAGES[:-1]:
            some = corpus_pipeline.stored(stage(spark, some, SF), f"test-{name}")
            assert some.columns == docs.columns
            wrong = " or ".join(f"`{n}` <> concat('{n}', doc_id)" for n in names)
            assert some.where(wrong).count() == 0 and some.count() > 0
        assert corpus_pipeline.STAGES[-1][1](spark, some, SF).count() > 0
