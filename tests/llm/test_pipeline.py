"""The pipeline's stages on a small corpus, against plain Python."""

import random

import corpus_pipeline
from tidepanel.llm import mixing, packing, quality_cnn, similar

from .test_operators import labelled, lower, prose


def test_stages(spark, tmp_path):
    texts, marks = labelled(spark, 120)
    rng = random.Random(12)
    rows = [(r.doc_id, r.text, "en", f"s{r.doc_id % 3}", len(r.text)) for r in texts.collect()]
    rows += [(1000 + i, rows[1][1].upper() if i % 2 else rows[1][1], "en", "s0", 1) for i in range(4)]
    long = prose(rng, 400)
    rows += [(2000, long, "en", "s1", 1), (2001, long + " end", "en", "s1", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    marks.write.parquet(str(tmp_path / "labels.parquet"))
    d = str(tmp_path)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "exact_dedup", "simhash_near_dedup", "mixing", "packing"]
    docs = spark.read.parquet(f"{d}/documents.parquet")
    columns, seen = docs.columns, [docs]
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, seen[-1], d)
        out.write.parquet(str(tmp_path / f"stage{len(seen)}"))
        seen.append(spark.read.parquet(str(tmp_path / f"stage{len(seen)}")))
    assert all(s.columns == columns for s in seen[:-1])
    rejected = {r.doc_id for r in quality_cnn.quality_scores(docs, marks).where("predicted = 0").collect()}
    stage = [[(r.doc_id, r.text) for r in s.select("doc_id", "text").collect()] for s in seen[:-1]]
    assert {i for i, _ in stage[1]} == {r[0] for r in rows} - rejected and {i for i in rejected if i < 1000} >= {0, 4, 8}
    best = {}
    for i, t in stage[1]:
        best[lower(t)] = max(i, best.get(lower(t), i))
    assert sorted(i for i, _ in stage[2]) == sorted(best.values())
    near = similar.similar_components(similar.wide_fingerprints(seen[2])).collect()
    assert sorted(i for i, _ in stage[3]) == sorted({r.component_id for r in near}) and not {2000, 2001} <= {i for i, _ in stage[3]}
    copies = {r.doc_id: r.base + r.extra for r in mixing.mix(seen[3]).collect()}
    assert sorted(i for i, _ in stage[4]) == sorted(i for i, n in copies.items() for _ in range(n))
    assert seen[5].count() == packing.pieces(seen[4]).count()
    assert corpus_pipeline.run(spark, d).count() == seen[5].count()


def test_run_on_odd_tables(spark, tmp_path):
    """Null and empty texts, repeated doc_ids, null sources, and empty tables."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rng = random.Random(3)
    rows = [(i % 40, prose(rng, 20 + i), None, None if i % 5 else "s", None) for i in range(60)] + [(90, None, "en", "s", 0), (91, "", "en", None, 0), (None, prose(rng, 30), "en", "s", 1)]
    marks = spark.createDataFrame([(i, i % 2, 0) for i in range(40)] + [(90, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for name, table, known in (("odd", rows, marks), ("empty", [], marks), ("unmarked", rows, marks.limit(0))):
        d = tmp_path / name
        spark.createDataFrame(table, schema).write.parquet(str(d / "documents.parquet"))
        known.write.parquet(str(d / "labels.parquet"))
        got = corpus_pipeline.run(spark, str(d)).collect()
        assert bool(got) == bool(table) and all(r.length >= 1 and r.offset >= 0 for r in got)
