"""The positive-unlabelled classifier: held-out accuracy, the class prior, odd rows, long texts."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from trackflow.llm import positive
from trackflow.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def test_held_out(spark):
    got = QUERIES["op12_positive"](spark, FOLDER)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert got.count() == docs.count()
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    assert got.where(F.col("held_out") != (fold == 2)).count() == 0
    assert got.where("score < 0 or score > 1 or predicted <> int(score >= 0.7)").count() == 0
    held = got.where("held_out").join(spark.read.parquet(f"{FOLDER}/labels.parquet"), "doc_id").toPandas()
    good, bad = held[held.quality == 1], held[held.quality == 0]
    assert good.predicted.mean() > 0.95 and bad.predicted.mean() < 0.2


def test_bad_labels_are_not_learned_from(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    one, two = positive.learn(docs, labels), positive.learn(docs, labels.where("quality = 1"))
    assert (one.weights == two.weights).all() and one.bias == two.bias and 0.75 < one.prior < 0.95


def test_prior_of_made_samples():
    rng = np.random.default_rng(0)

    def rows(n, centre):
        x = rng.integers(0, 40, (n, positive.SIZE))
        x[:, :8] = np.clip(rng.normal(centre, 12, (n, 8)), 0, 255)
        return x.astype(np.uint8)

    for share in (0.3, 0.6):
        good = int(3000 * share)
        model = positive.train(rows(1500, 120), np.concatenate((rows(good, 120), rows(3000 - good, 60))))
        assert model.prior == pytest.approx(share, abs=0.08)
        assert (positive.scores(rows(200, 120), model) > 0.7).mean() > 0.95
        assert (positive.scores(rows(200, 60), model) < 0.3).mean() > 0.95


def test_features_of_long_texts(monkeypatch):
    text = "Some words, words and words and\nCAPITALS 12 !! " * 900 + "y" * 4000 + " é漢 a b a b"
    whole = positive.features(pa.array([text, "", "a", None]))
    assert not whole[1].any() and not whole[3].any()
    monkeypatch.setattr(positive, "PIECE", 1000)
    assert (positive.features(pa.array([text])) == whole[:1]).all()


def test_counts_of_a_short_text():
    grams, repeats = positive._grams(positive.SHAPE[np.frombuffer(b"ab aB", np.uint8)], np.zeros(5, np.int64), 1, np.ones(5, bool)), None
    assert grams.sum() == 5 + 4 + 3
    words = positive.tx.Words(*positive.tx.buffers(pa.array(["a a b a b", "b a"])))
    repeats = positive._repeats(words)
    assert repeats.tolist() == [[1, 2, 1, 0], [0, 0, 0, 0]]


ROWS = [
    (1, "Good text with some words."), (1, "Good text with some words."), (2, "Good text."), (3, None), (4, ""), (None, "No id."),
    (5, "$$$ ### $$$"), (6, "漢字 é"), (7, "word " * 300_000),
]


def test_odd_rows(spark):
    docs = spark.createDataFrame(ROWS, "doc_id bigint, text string").withColumns({"score": F.lit("own"), "row": F.lit("own"), "_least": F.lit(1)})
    labels = spark.createDataFrame(
        [(1, 1), (1, 1), (2, 1), (2, 0), (3, 1), (5, 0), (6, None), (None, 1), (99, 1)], "doc_id bigint, quality int"
    )
    found = positive.classify(docs, docs, labels).collect()
    assert len(found) == len(ROWS) and all(0 <= r.score <= 1 and r.row.score == "own" for r in found)
    by_text = {}
    for r in found:
        assert by_text.setdefault(r.row.text or "", r.score) == r.score and r.predicted == int(r.score >= 0.7)
    for nothing in (labels.limit(0), labels.where("quality = 0")):
        assert {(r.score, r.predicted) for r in positive.classify(docs, docs, nothing).collect()} == {(0.5, 0)}
    assert positive.classify(docs.limit(0), docs.limit(0), labels).collect() == []
