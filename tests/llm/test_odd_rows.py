"""Every operator and stage on nulls, empty and long texts, ties, repeated rows, clashing columns, empty tables."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from trackflow.llm import extraction, langid, mixing, neardup, neighbours, packing, quality, scoring, sharding, toxicity
from trackflow.llm import text as tx
from trackflow.llm.queries import vocabulary

LONG = " ".join(f"word{i % 977} of the long text." for i in range(20_000))
ROWS = [
    (1, "The cat sat on the mat and the dog sat on the rug near the door.", "en", "a", 64),
    (1, "The cat sat on the mat and the dog sat on the rug near the door.", "en", "a", 64),
    (1, "The cat sat on the mat and the dog sat on the rug near the door.", "en", "a", 64),
    (2, "The cat sat on the mat and the dog sat on the rug near the door.", "en", "b", 64),
    (2, "same id, other text", "en", "b", 19),
    (3, None, "en", "a", 0),
    (4, "", None, "a", 0),
    (5, " \n\t \r\n", "en", None, 5),
    (None, "no id here at all, but some words", "en", "b", 33),
    (None, None, None, None, None),
    (6, "123 456 !!! 789", "en", "c", 15),
    (7, "ÉÀÜ ß 漢字   \U0001f600 İstanbul ﬁ", "fr", "é", 20),
    (8, LONG, "en", "a", len(LONG)),
    (9, "x", "en", "\U0001f600", 1),
]
NAMES = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CLASHING = (
    "size score predicted lang_pred row_id node bands signature text_hash class_id kept target copies identity host lines"
    " source_size part local start length offset shard slot count n key h toxic _hash _id _part band root held_out rank"
).split()


def frame(spark, rows):
    df = spark.createDataFrame(rows, NAMES)
    return df.withColumns({c: F.lit(f"own {c}") for c in CLASHING})


@pytest.fixture(scope="module")
def odd(spark):
    return frame(spark, ROWS)


@pytest.fixture(scope="module")
def none(spark):
    return frame(spark, [])


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(
        [(1, 1, 0), (1, 1, 1), (2, 1, 0), (8, None, None), (None, 1, 1), (99, 1, 1)], "doc_id bigint, quality int, toxic int"
    )


OPERATORS = {
    "langid": lambda docs, labels: langid.identify(docs, docs),
    "quality": lambda docs, labels: quality.judge(docs),
    "packing": lambda docs, labels: packing.pack(docs, vocabulary()),
    "scoring": lambda docs, labels: scoring.score(docs, docs),
    "neardup": lambda docs, labels: neardup.near_duplicates(docs),
    "dedupe": lambda docs, labels: neardup.dedupe(docs),
    "mixing": lambda docs, labels: mixing.mix(docs),
    "sample": lambda docs, labels: mixing.sample(docs),
    "toxicity": lambda docs, labels: toxicity.classify(docs, docs, labels),
    "sharding": lambda docs, labels: sharding.shard_documents(docs, 5),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(none, labels, name):
    assert OPERATORS[name](none, labels.limit(0)).collect() == []


def test_langid(odd, labels):
    rows = OPERATORS["langid"](odd, labels).collect()
    assert len(rows) == len(ROWS)
    assert all(0 <= r.score <= 1 and r["size"] == "own size" for r in rows)
    for r in rows:
        lettered = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred in ("en", "fr")) == lettered and (r.lang_pred == "und") != lettered


def test_quality(odd, labels):
    rows = {(r.doc_id, r.n_words): r for r in OPERATORS["quality"](odd, labels).collect()}
    assert OPERATORS["quality"](odd, labels).count() == len(ROWS)
    assert rows[(8, 100_000)].n_repeat_words == 100_000 and rows[(8, 100_000)].base_failed
    assert rows[(3, 0)].base_failed and not rows[(3, 0)].kept
    assert rows[(1, 16)].kept and rows[(1, 16)].word_chars == 49


def test_packing(odd, labels):
    rows = OPERATORS["packing"](odd, labels).collect()
    placed = sum(r.length for r in rows)
    # Repeated ids make whole documents per row: sum each row's first piece.
    assert placed == sum(r.doc_tokens for r in rows if r.start == 0)
    assert sum(r.start == 0 for r in rows) == len(ROWS)
    assert sum(r.doc_tokens == 1 for r in rows) == 4  # null and empty texts: the end alone


def test_scoring(odd, labels):
    rows = OPERATORS["scoring"](odd, labels).collect()
    assert len(rows) == len(ROWS) and len({r.train_tokens for r in rows}) == 1
    assert all(r.score < 0 and r.n_known == r.n_tokens for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (3, 4, 5)} == {1}


def test_neardup(odd, labels):
    rows = OPERATORS["neardup"](odd, labels).collect()
    assert len(rows) == len(ROWS) and sum(r.kept for r in rows) == len({r.class_id for r in rows})
    assert {r.class_id for r in rows if r.doc_id == 1} == {1}
    assert {(r.class_id, r.class_size) for r in rows if r.doc_id in (3, 4, 5)} == {(3, 4)}
    kept = OPERATORS["dedupe"](odd, labels)
    assert kept.columns == odd.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [
        (False, 1), (False, 2), (False, 3), (False, 6), (False, 7), (False, 8), (False, 9), (True, 0)
    ]


def test_mixing(odd, labels):
    rows = OPERATORS["mixing"](odd, labels).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.copies <= 3 for r in rows)
    assert {r.target for r in rows if r.source is None} == {0.0}
    taken = OPERATORS["sample"](odd, labels)
    assert taken.columns == odd.columns and taken.count() > 0


def test_toxicity(odd, labels):
    rows = OPERATORS["toxicity"](odd, labels).collect()
    assert len(rows) == len(ROWS)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)


def test_sharding(odd, labels):
    rows = OPERATORS["sharding"](odd, labels).collect()
    assert len(rows) == len(ROWS)
    for s in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    assert len({r.shard for r in rows if r.doc_id is None}) == 1
    assert {r["size"] for r in rows if r.doc_id in (3, 4)} == {8}


def test_pages(spark):
    rows = [(1, "u", None), (1, "u", None), (None, None, ""), (2, "u", "<p>a<p>b"), (3, "u", "<div " * 50), (4, "u", "<b>" * 3000 + "deep")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("text", F.lit("own"))
    got = extraction.extract(pages).collect()
    assert [(r.page_id, r.text, r.n_chars) for r in got[:4]] == [(1, "", 0), (1, "", 0), (None, "", 0), (2, "a\nb", 3)]
    assert got[5].text == "deep"
    assert extraction.extract(pages.limit(0)).collect() == []


def test_vectors(spark):
    rows = [(i, [float(i % 3), 1.0, 0.5]) for i in range(9)] + [
        (0, [0.0, 1.0, 0.5]), (20, None), (21, [0.0, 0.0, 0.0]), (22, [1.0, None, 0.0]), (23, [1.0, float("nan"), 0.0]),
        (24, [1.0, float("inf"), 1.0]), (25, [1.0]), (None, [1.0, 1.0, 1.0]), (40, []),
    ]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("score", F.lit("own"))
    got = neighbours.search(vectors, "vec_id % 20 = 0").orderBy("rank").collect()
    # Ties go to the smaller id; all candidates are given if there are fewer than k.
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in got] == [
        (0, i + 1, v, 1.25) for i, v in enumerate(range(1, 9))
    ]
    assert neighbours.search(vectors.limit(0), "vec_id % 20 = 0").collect() == []


def test_stages(spark, odd, none, labels, tmp_path):
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for docs in (spark.createDataFrame(ROWS, NAMES), odd, none):
        for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, str(tmp_path))
            if i < len(corpus_pipeline.STAGES) - 1:
                assert out.columns == docs.columns, name
            out.count()


def test_stages_on_bytes_that_are_no_text(spark, labels, tmp_path):
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    bad = F.concat("text", F.unhex(F.lit("2041FF42C320EDA08041E282")).cast("string"))
    docs = spark.createDataFrame(ROWS, NAMES).withColumn("text", F.when(F.col("doc_id") != 9, bad).otherwise(F.col("text")))
    docs.write.parquet(str(tmp_path / "documents"))
    docs = spark.read.parquet(str(tmp_path / "documents"))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        assert out.count() > 0, name
        if name != "packing":
            # Rows pass byte for byte.
            assert out.select(F.hex("text")).subtract(docs.select(F.hex("text"))).count() == 0, name


def test_bytes_that_are_no_text_become_marks():
    raw, ends = b"A\xffB\xc3 \xed\xa0\x80HELLO\xe2\x82A", [0, 8, 13, 16, 16]
    column = pa.Array.from_buffers(pa.string(), 4, [pa.py_buffer(b"\x07"), pa.py_buffer(np.array(ends, np.int32)), pa.py_buffer(raw)])
    assert tx.lowered(column).to_pylist() == ["a\ufffdb\ufffd \ufffd\ufffd\ufffd", "hello", "\ufffda", None]
    assert tx.lowered(pa.array(["É", None])).to_pylist() == ["é", None]


TEXTS = {
    "words": "The words of a long text, É and 漢字 too. \U0001f600\n" * 700,
    "others": " 1, 2; \n" * 5000 + "word" + " 3" * 9000,
    "one word": "aé漢" * 9000,
    "no letter": "12 3,, " * 5000,
}


@pytest.mark.parametrize("name", TEXTS)
def test_pieces_of_long_texts(name, monkeypatch):
    """A text in pieces has the scores of the whole one."""
    column = pa.array([TEXTS[name]])
    rows = [("en", "The words of the text are of a kind that one can read."), ("xx", "aé漢 É漢字 aé漢")] * 3
    model = langid.train(rows, langid.Fit())
    toxic = toxicity.Model(b" words ", b" a long text ", 1, (0.1, 0.2, 0.3, 0.4))
    whole, hits = langid.scores(column, model), toxicity.score(column, toxic, 1000)
    for size in (100, 1024, 4096):
        for words in (True, False):
            parts = list(tx.pieces(column, size, words))
            assert len(parts) > 1 or name == "one word" and words
            assert "".join(p[0].as_py() for p in parts) == TEXTS[name]
            assert all(p[0].as_py()[-1].isspace() for p in parts[:-1] if words)
    cut = tx.pieces
    monkeypatch.setattr(tx, "pieces", lambda column, limit=0, words=True: cut(column, 1024, words))
    monkeypatch.setattr(langid, "CHUNK_BYTES", 1024)
    monkeypatch.setattr(tx, "CHUNK_BYTES", 1024)
    names, score, fit = langid.scores(column, model)
    assert names == whole[0] and np.allclose(score, whole[1]) and np.allclose(fit, whole[2])
    assert (toxicity.score(column, toxic, 1000) == hits).all()


def most_held(run):
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_long_texts_are_not_held_many_times():
    text = "The words of a long text, É and 漢字 too. \n" * 400_000
    column, size = pa.array([text]), len(text.encode())
    model = langid.train([("en", text[:9000]), ("xx", "aé漢 É漢字 aé漢" * 99)], langid.Fit())
    toxic = toxicity.Model(b" words ", b" a long text ", 1, (0.1, 0.2, 0.3, 0.4))
    assert most_held(lambda: toxicity.score(column, toxic, 1000)) < 8 * size
    assert most_held(lambda: langid.scores(column, model)) < 16 * size


def test_many_languages_are_learned_a_part_at_a_time():
    rng = np.random.default_rng(3)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz    "))
    rows = [(f"l{i}", "".join(rng.choice(letters, 1 << 14))) for i in range(4) for _ in range(160)]
    size = sum(len(t) for _, t in rows)
    assert most_held(lambda: langid.train(rows, langid.Fit())) < 30 * size
