"""The stages of the pipeline on odd tables: null and repeated ids, copies, no labels, clashing names, nothing at all."""

from __future__ import annotations

import pytest

import corpus_pipeline
from tallymill.llm import quality, toxicity

BASE = " ".join(f"word{k}" for k in range(60))
OTHER = " ".join(f"other{k}" for k in range(40))
ROWS = [
    (1, BASE), (1, OTHER), (1, OTHER), (2, BASE + " tail"), (2, "a clean text of its own with enough words to stand"),
    (None, BASE), (None, "no id but a text"), (None, "no id but a text"), (7, None), (7, None), (8, ""), (9, ""), (10, "long " * 30_000),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "s", 0, "x", k) for k, (i, t) in enumerate(ROWS)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, row int, `x.y` string, n_chars long"
    ).repartition(3)


@pytest.fixture
def labels(spark, folder):
    def write(*rows):
        spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        return folder

    return write


def test_one_row_of_each_group_stays(spark, docs, folder):
    kept = corpus_pipeline.drop_near_copies(spark, docs, folder)
    assert kept.columns == docs.columns
    texts = [r["text"] for r in kept.collect()]
    assert sum(t in (BASE, BASE + " tail") for t in texts if t) == 1
    assert texts.count(None) == 2 and texts.count("") == 1
    assert sorted(t for t in texts if t and not t.startswith(BASE)) == sorted({t for _, t in ROWS if t and not t.startswith(BASE)})
    assert corpus_pipeline.drop_near_copies(spark, docs.where("false"), folder).count() == 0


@pytest.mark.parametrize("rows", [(), ((1, None, None), (None, 1, 1)), ((99, 1, 0), (98, 0, 1))])
def test_without_usable_labels_everything_stays(spark, docs, labels, rows):
    sf_dir = labels(*rows)
    for stage in (corpus_pipeline.drop_toxic, corpus_pipeline.drop_poor):
        kept = stage(spark, docs, sf_dir)
        assert kept.columns == docs.columns and kept.count() == len(ROWS)
        assert stage(spark, docs.where("false"), sf_dir).count() == 0


def test_whole_pipeline(spark, docs, labels, folder):
    labels((1, 1, 0))
    docs.write.parquet(f"{folder}/documents.parquet")
    pieces = corpus_pipeline.run(spark, folder)
    kept = corpus_pipeline.drop_near_copies(spark, docs, folder).count()
    assert pieces.where("piece = 0").count() == kept
    docs.where("false").write.parquet(f"{folder}/none/documents.parquet")
    spark.read.parquet(f"{folder}/labels.parquet").write.parquet(f"{folder}/none/labels.parquet")
    assert corpus_pipeline.run(spark, f"{folder}/none").count() == 0


def test_one_pass_judges_like_two():
    model = toxicity.Model({"bad": 4.0, "awful": 2.5}, -3.0)
    for text in (None, "", "fine. all fine", "bad. fine! awful awful\nbad awful", "x" * 100_000):
        assert model.judged(text) == (model.score(text), model.offending(text))


def test_quality_model_without_labels_is_neutral():
    mean, scale, weights = quality.fit([])
    assert len(mean) == len(scale) == len(weights) == len(quality.surface(None))
    assert weights[0] > 0 and not any(weights[1:])
