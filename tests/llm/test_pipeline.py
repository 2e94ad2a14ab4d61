"""The corpus pipeline, stage by stage, against brute force on the smallest tables."""

import random

from test_operators import SMALL, brute_components, brute_counts, brute_secrets, packed_right

import corpus_pipeline
from plotwright.llm import quality, simhash


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, seen = docs.columns, []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SMALL).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        seen.append(docs.collect())
        assert k == 3 or docs.columns == columns
    first = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    judge = quality.judge_from_labels(spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/labels.parquet"))
    kept = {i for i, t in first.items() if (c := brute_counts(t)) and c[0] >= 50 and 2 * c[4] <= c[0]}
    assert {r.doc_id for r in seen[0]} <= kept and judge.forest is not None
    groups = brute_components([(r.doc_id, r.text) for r in seen[0]])
    assert {r.doc_id for r in seen[1]} == {c for _, _, c in groups} and len(seen[1]) == len({c for _, _, c in groups})
    assert {r.doc_id for r in seen[2]} == {r.doc_id for r in seen[1]}
    before = {r.doc_id: r for r in seen[1]}
    for r in seen[2]:
        assert brute_secrets(r.text)[:3] == (0, 0, 0)
        assert r.text == before[r.doc_id].text or "[SECRET]" in r.text and r.n_chars == len(r.text)
    packed_right(seen[3], [(r.doc_id, r.text) for r in seen[2]])


def test_near_dedup_with_split_anchors(spark, monkeypatch):
    """Of groups of exactly two near copies one stays, also where each anchor's guests are dealt over several cells."""
    monkeypatch.setattr(simhash, "CELL", 1)
    rng = random.Random(5)
    rows = []
    for i in range(0, 60, 2):
        words = [f"w{rng.randrange(10**6)}" for _ in range(2000)]
        rows.append((i, " ".join(words)))
        words[1000] = "changed"
        rows.append((i + 1, " ".join(words)))
    groups = brute_components(rows)
    assert len({c for _, _, c in groups}) < 40
    left = dict(corpus_pipeline.STAGES)["SimHash near-dedup"](spark, spark.createDataFrame(rows, "doc_id long, text string"), SMALL)
    assert {r.doc_id for r in left.collect()} == {c for _, _, c in groups}


def test_run(spark):
    assert corpus_pipeline.run(spark, SMALL).count() > 0
