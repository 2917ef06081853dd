"""Max-sketch search against a plain scorer, on given and on odd rows."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from trackflow.llm import lexical
from trackflow.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG = " ".join(f"Word{i % 97}-of text{i}" for i in range(40_000))
DOCS = [
    (3, "the cat sat on the mat"), (1, "the cat sat on the mat"), (1, "the cat sat on the mat"), (None, "the cat sat on the mat"),
    (4, None), (5, ""), (6, " .,;\n"), (7, "ÉTÉ été Éte naïve 漢字 x1 X1"), (8, LONG), (9, "mat"), (10, "word5 of cat"),
]
ITEMS = [(0, "Cat MAT cat"), (0, "Cat MAT cat"), (1, None), (2, "..."), (3, "été 漢字"), (4, "WORD5 text77"), (None, "mat"), (5, "nothing known")]


def terms(text):
    return TERM.findall((text or "").translate(SMALL))


def plain(docs, items, k=50):
    """(item, rank, doc, score) by scoring everything."""
    counted = [(d, Counter(terms(t))) for d, t in docs]
    n_docs, total = sum(1 for _, c in counted if c), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    weights = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
    out = []
    for item, text in dict.fromkeys(items):
        asked, scored = set(terms(text)), []
        for d, c in counted:
            m = 50 + 50 * sum(c.values()) * n_docs // max(total, 1)
            score = sum(weights[t] * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m)) for t in asked if t in c)
            scored += [(-score, d is None, d or 0, d)] if score > 0 else []
        out += [(item, i + 1, d, -s) for i, (s, _, _, d) in enumerate(sorted(scored, key=lambda x: x[:3])[:k])]
    return sorted(out, key=repr)


def frames(spark, docs, items):
    more = {"score": F.lit("own"), "rank": F.lit("own"), "item": F.lit("own"), "id": F.lit("own")}
    return (
        spark.createDataFrame(docs, "doc_id bigint, text string").withColumns(more),
        spark.createDataFrame(items, "item_id bigint, text string").withColumns(more),
    )


def found(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("plan", [lexical.Plan(), lexical.Plan(k=2, step=1), lexical.Plan(coordinates=3, block_items=2, chunk_rows=2)])
def test_odd_rows(spark, plan):
    assert found(lexical.search(*frames(spark, DOCS, ITEMS), plan)) == plain(DOCS, ITEMS, plan.k)


def test_empty_tables(spark):
    for docs, items in (([], ITEMS), (DOCS, []), ([], []), ([(1, None)], ITEMS)):
        assert found(lexical.search(*frames(spark, docs, items))) == []


def test_string_ids(spark):
    docs = spark.createDataFrame([("b", "x y"), ("a", "x y"), ("", "x")], "doc_id string, text string")
    got = lexical.search(docs, spark.createDataFrame([("q", "y")], "item_id string, text string")).collect()
    assert [(r.item_id, r.rank, r.doc_id) for r in got] == [("q", 1, "a"), ("q", 2, "b")]


def test_given_rows(spark):
    def rows(name, *columns):
        return [tuple(r) for r in spark.read.parquet(f"{FOLDER}/{name}.parquet").select(*columns).collect()]

    want = plain(rows("documents", "doc_id", "text"), rows("benchmark", "item_id", "text"))
    assert found(QUERIES["op11_lexical"](spark, FOLDER)) == want and len(want) > 500


def test_pieces_of_long_texts(monkeypatch):
    text = pa.array([LONG[:30_000] + "x" * 5000 + " " + LONG[:10_000]])
    whole = lexical.frequencies(text)
    monkeypatch.setattr(lexical, "PIECE", 700)
    assert all((a == b).all() for a, b in zip(lexical.frequencies(text), whole, strict=True))


def test_most_documents_are_never_rescored(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").limit(4000).toPandas()
    items = spark.read.parquet("/root/testdata/sf0.1/benchmark.parquet").limit(40).selectExpr("item_id as id", "text", "item_id as item")
    block = lexical._block(items.collect())
    rank = np.array([lexical.weight(len(docs), 20)] * len(block.vocabulary))
    ranking = lexical.Ranking(block, rank, len(docs), len(docs) * 300, lexical.Plan())
    for lo in range(0, len(docs), 500):
        part = docs[lo : lo + 500]
        ranking.add(part.doc_id.to_numpy(object), pa.array(part.text))
    assert ranking.rescored < 0.25 * ranking.bounded
