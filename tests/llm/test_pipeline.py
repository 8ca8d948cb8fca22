"""The pipeline end to end on a small corpus, each stage against plain code."""

import collections

import pytest

from gridloom.llm import near_dup, segment, toxicity
from tests.llm.test_operators import DOCS, LONG, ODD, _components, _labelled, clashing, docs

pipeline = pytest.importorskip("corpus_pipeline")


def test_pipeline_stages(spark, tmp_path):
    rows, labels = _labelled(600)
    rows = [(i, f"{t}\nRead more about it on page {i} of this site", "en", "hot" if i % 3 else f"s{i % 4}", 0) for i, t, *_ in rows]
    rows += [(1000 + i, rows[5][1], "en", "hot", 0) for i in range(20)]
    data = str(tmp_path)
    spark.createDataFrame(rows, DOCS).write.parquet(f"{data}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{data}/labels.parquet")
    docs = spark.read.parquet(f"{data}/documents.parquet")
    seen = [docs.collect()]
    for k, (_, stage) in enumerate(pipeline.STAGES):
        stage(spark, docs, data).write.parquet(f"{data}/{k}")
        docs = spark.read.parquet(f"{data}/{k}")
        seen.append(docs.collect())
        if k < len(pipeline.STAGES) - 1:
            assert docs.columns == [c.split()[0] for c in DOCS.split(", ")]
    start, clean, cut, unique, mixed, pieces = seen
    label = {i: t for i, _, t in labels}
    right = sum((r.doc_id in {x.doc_id for x in clean}) == (not label[r.doc_id]) for r in start if r.doc_id in label)
    assert right / len(labels) > 0.97
    assert len(cut) == len(clean) and all("Read more" not in r.text for r in cut if r.doc_id < 1000 and r.doc_id != 5)
    want = _components([(r.doc_id, r.text) for r in cut])
    assert sorted(r.doc_id for r in unique) == sorted(set(want.values()))
    counts = collections.Counter(r.doc_id for r in mixed)
    assert set(counts) <= {r.doc_id for r in unique} and max(counts.values()) <= 2
    v = segment.Vocabulary.load(segment.model_path())
    text = {r.doc_id: r.text for r in mixed}
    assert all(v.decode(r.ids) == text[r.doc_id] for r in pieces)
    assert {r.doc_id for r in pieces} == set(counts)
    final = pipeline.run(spark, data)
    assert sorted(map(str, final.collect())) == sorted(map(str, pieces))


def test_pipeline_odd_rows(spark, tmp_path):
    data = str(tmp_path)
    spark.createDataFrame([(3, 1, 0), (4, 1, None)], "doc_id long, quality int, toxic int").write.parquet(f"{data}/labels.parquet")
    for name, rows in (("odd", clashing(docs(spark))), ("none", docs(spark, []))):
        seen = rows
        for k, (_, stage) in enumerate(pipeline.STAGES):
            before = seen.columns
            stage(spark, seen, data).write.parquet(f"{data}/{name}{k}")
            seen = spark.read.parquet(f"{data}/{name}{k}")
            assert k == len(pipeline.STAGES) - 1 or seen.columns == before
        got = {r.doc_id for r in seen.collect()}
        assert got <= ({r[0] for r in ODD} if name == "odd" else set())
    unique = spark.read.parquet(f"{data}/odd2").collect()
    assert len(unique) == 5 and sum(r.text == LONG for r in unique) == 1
