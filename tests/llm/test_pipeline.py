import numpy as np
import pytest

import corpus_pipeline
from atrium.llm import queries


def test_stages_keep_columns_and_clean_documents(spark, tmp_path):
    good = [" ".join(f"word{(i * 7 + k * k) % 97}" for k in range(80)) for i in range(40)]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(good)]
    rows += [(100, good[0], "en", "s", 1), (101, None, None, None, None), (102, "", "en", "s", 0), (103, "## " * 200, "en", "s", 600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in (*range(40), 100)] + [(103, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, str(tmp_path))
        assert now.columns == docs.columns, name
    assert {r.doc_id for r in now.collect()} == set(range(40))
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id for r in packed.collect()} == set(range(40))
    assert all(stage(spark, docs.limit(0), str(tmp_path)).count() == 0 for _, stage in corpus_pipeline.STAGES)


def test_stages_take_clashing_columns_repeated_rows_and_null_ids(spark, tmp_path):
    good = [" ".join(f"word{(i * 7 + k * k) % 97}" for k in range(80)) for i in range(30)]
    names = ("score", "id_", "key_", "Rejected_ID", "node", "text_key", "grp", "fold", "words", "bucket", "h", "label")
    rows = [(i, t, *[f"{n}{i}" for n in names]) for i, t in enumerate(good)]
    rows += [(3, good[3], *[f"{n}3" for n in names]), (3, good[4], *["z"] * len(names)), (None, good[5], *["z"] * len(names)), (None, None, *[None] * len(names))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(20)] + [(None, 1, 1), (25, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, str(tmp_path))
        assert now.columns == docs.columns, name
        assert all(r.score == f"score{r.doc_id}" and r.id_ == f"id_{r.doc_id}" for r in now.where("doc_id IS NOT NULL AND score <> 'z'").collect()), name
    got = now.collect()
    assert {r.doc_id for r in got if r.doc_id is not None} == set(range(30)) and [r.text for r in got if r.doc_id is None] == [good[5]]
    assert corpus_pipeline.STAGES[-1][1](spark, now, str(tmp_path)).where("doc_id IS NULL").count() == 1


def test_every_operator_has_a_query():
    assert sorted(int(n.split("_")[0][2:]) for n in queries.queries()) == list(range(1, 11))


@pytest.mark.parametrize("n", [200, 1000, 10_000])
def test_unlabelled_clean_documents_stay_at_every_size(spark, tmp_path, n):
    rng = np.random.default_rng(n)
    clean = [f"w{i}" for i in range(5000)]
    junk = [f"sale{i}" for i in range(40)]
    rare = 1 / np.arange(10, 5010)
    kind = np.where(np.arange(n) % 17 == 0, "junk", "clean")
    texts = [" ".join(rng.choice(junk, 80) if k == "junk" else rng.choice(clean, 120, p=rare / rare.sum())) for k in kind]
    labelled = rng.random(n) < 0.4
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spark.createDataFrame([(i, int(kind[i] == "clean"), 0) for i in range(n) if labelled[i]], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    kept = np.isin(np.arange(n), [r.doc_id for r in corpus_pipeline.quality_stage(spark, docs, str(tmp_path)).select("doc_id").collect()])
    for some in (labelled, ~labelled):
        assert kept[some & (kind == "clean")].mean() >= 0.95 and kept[some & (kind == "junk")].mean() <= 0.05
