"""Ranked lexical search by hashed max-sketches.

A document's impacts (what one unit of a term's weight adds to its score) fold into a short vector:
each term hashes to a coordinate, which keeps the largest impact that falls on it. For a query the
weights of its terms times those coordinates can only be too large, so all documents of a chunk get
their upper bounds for a block of queries by one matrix product. Documents are then rescored exactly
in the order of their bounds, until a bound falls below the score of the k-th best found.

Two passes over the documents per block of queries: one counts documents and terms (a task keeps one
number per query term), one ranks. A task keeps k scores per query of the block and hands these on, so
what is exchanged is tasks x queries x k rows at most, whatever the documents.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trackflow.llm import text as tx
from trackflow.llm.shared import shared_dir, stored

# Bytes outside terms, as a space; A-Z as a-z.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[:128] = 32
FOLD[48:58] = np.arange(48, 58)
FOLD[97:123] = np.arange(97, 123)
FOLD[65:91] = np.arange(97, 123)

PIECE = 1 << 20  # a longer text is counted in pieces of about so many bytes
RESULT = "item_id {id}, item long, doc_id {doc}, score long"


@dataclass(frozen=True)
class Plan:
    k: int = 50
    coordinates: int = 16_384
    chunk_rows: int = 512  # documents whose sketches are held at once
    block_items: int = 512  # queries of one pass; their terms are held by every task
    step: int = 32  # documents rescored between two looks at the threshold


@dataclass(frozen=True)
class Block:
    """Queries of a pass: their distinct terms (sorted hashes), and each query's terms as places."""

    ids: list
    rows: np.ndarray  # numbers of the queries, unique over all blocks
    vocabulary: np.ndarray
    terms: list[np.ndarray]


def _pieces(data: np.ndarray) -> Iterator[np.ndarray]:
    """A folded text cut between terms into pieces of about PIECE bytes."""
    lo = 0
    while lo < len(data):
        hi = min(lo + PIECE, len(data))
        while hi < len(data):
            gaps = np.flatnonzero(data[hi : hi + PIECE] == 32)
            if len(gaps):
                hi += int(gaps[0])
                break
            hi = min(hi + PIECE, len(data))
        yield data[lo:hi]
        lo = hi


def _merged(doc: np.ndarray, term: np.ndarray, tf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One entry per document and term, in that order."""
    order = np.lexsort((term, doc))
    doc, term, tf = doc[order], term[order], tf[order]
    firsts = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (term[1:] != term[:-1]))) if len(doc) else np.zeros(0, np.int64)
    return doc[firsts], term[firsts], np.add.reduceat(tf, firsts) if len(firsts) else tf


def frequencies(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, hash of term, occurrences) of a column of texts, ordered by text and hash."""
    data, offsets = tx.buffers(column)
    if len(offsets) == 2 and len(data) > PIECE:
        parts = [_counted(piece, np.array([0, len(piece)])) for piece in _pieces(FOLD[data])]
        return _merged(*(np.concatenate([p[i] for p in parts]) for i in range(3)))
    return _counted(FOLD[data], offsets)


def _counted(folded: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    words = tx.Words(folded, offsets)
    return _merged(words.doc, words.hashes(), np.ones(len(words.doc), np.int64))


def _block(rows: list) -> Block:
    """Queries of one block from rows of (item, id, text)."""
    doc, term, _ = frequencies(pa.array([r.text or "" for r in rows], pa.large_string()))
    vocabulary, place = np.unique(term, return_inverse=True)
    bounds = np.searchsorted(doc, np.arange(len(rows) + 1))
    terms = [place[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    return Block([r.id for r in rows], np.array([r.item for r in rows], np.int64), vocabulary, terms)


def _found(vocabulary: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which entries are in the vocabulary, and their places there."""
    place = np.minimum(np.searchsorted(vocabulary, term), max(len(vocabulary) - 1, 0))
    known = vocabulary[place] == term if len(vocabulary) else np.zeros(len(term), bool)
    return np.flatnonzero(known), place[known]


def counts(texts: DataFrame, vocabulary: np.ndarray) -> tuple[int, int, np.ndarray]:
    """Documents with a term, terms with their repeats, and documents per term of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(vocabulary) + 2, np.int64)
        for batch in batches:
            for part in tx.chunks(batch):
                doc, term, tf = frequencies(part.column("text"))
                total[0] += len(np.unique(doc))
                total[1] += tf.sum()
                total[2:] += np.bincount(_found(vocabulary, term)[1], minlength=len(vocabulary))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"place": pa.array(at), "value": pa.array(total[at])})

    sums = texts.mapInArrow(run, "place long, value long").groupBy("place").agg(F.sum("value").alias("value")).collect()
    total = np.zeros(len(vocabulary) + 2, np.int64)
    for r in sums:
        total[r.place] = r.value
    return int(total[0]), int(total[1]), total[2:]


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(doc: np.ndarray, tf: np.ndarray, n_docs: int, n_terms: int, rows: int) -> np.ndarray:
    """What one unit of weight adds for each entry; below a million."""
    lengths = np.bincount(doc, tf, minlength=rows).astype(np.int64)
    longest = int(lengths.max()) if len(lengths) else 0
    if 50 * longest * n_docs >= 1 << 62:
        m = np.array([50 + 50 * int(x) * n_docs // n_terms for x in lengths], np.int64)
    else:
        m = 50 + 50 * lengths * n_docs // n_terms
    return 1_000_000_000 * tf // (1000 * tf + 20 * m[doc])


class Ranking:
    """The k best documents of each query of a block among those seen by a task."""

    def __init__(self, block: Block, weights: np.ndarray, n_docs: int, n_terms: int, plan: Plan) -> None:
        self.block, self.n_docs, self.n_terms, self.plan = block, n_docs, n_terms, plan
        self.weights = weights
        coordinate = (block.vocabulary % np.uint64(plan.coordinates)).astype(np.int64)
        # Coordinates that no query looks at need not be kept.
        used = np.unique(coordinate)
        self.slot = np.full(plan.coordinates, -1)
        self.slot[used] = np.arange(len(used))
        self.lookup = np.zeros((len(used), len(block.terms)), np.float32)
        for q, terms in enumerate(block.terms):
            np.add.at(self.lookup[:, q], self.slot[coordinate[terms]], weights[terms])
        self.scores = [np.zeros(0, np.int64) for _ in block.terms]
        self.docs: list[np.ndarray] = [np.zeros(0, object) for _ in block.terms]
        self.threshold = np.ones(len(block.terms), np.int64)  # a lower score is of no use
        self.rescored = self.bounded = 0

    def sketches(self, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, rows: int) -> np.ndarray:
        out = np.zeros((rows, self.lookup.shape[0]), np.float32)
        slot = self.slot[(term % np.uint64(self.plan.coordinates)).astype(np.int64)]
        seen = slot >= 0
        np.maximum.at(out, (doc[seen], slot[seen]), impact[seen].astype(np.float32))
        return out

    def add(self, ids: np.ndarray, column: pa.Array) -> None:
        """Rank the documents of a chunk."""
        doc, term, tf = frequencies(column)
        if not len(doc):
            return
        impact = impacts(doc, tf, self.n_docs, self.n_terms, len(ids))
        sketch = self.sketches(doc, term, impact, len(ids))
        # Single precision loses at most a share of 2**-24 per addition.
        bounds = (sketch @ self.lookup) * np.float32(1 + 1e-3) + 1
        self.bounded += bounds.size
        at, place = _found(self.block.vocabulary, term)
        doc, impact = doc[at], impact[at]
        starts = np.searchsorted(doc, np.arange(len(ids) + 1))
        for q in np.flatnonzero(bounds.max(axis=0) >= self.threshold):
            own = np.zeros(len(self.weights), np.int64)
            own[self.block.terms[q]] = self.weights[self.block.terms[q]]
            near = np.flatnonzero(bounds[:, q] >= self.threshold[q])
            near = near[np.argsort(-bounds[near, q], kind="stable")]
            for lo in range(0, len(near), self.plan.step):
                some = near[lo : lo + self.plan.step]
                some = some[bounds[some, q] >= self.threshold[q]]
                if not len(some):
                    break
                self.rescored += len(some)
                size = starts[some + 1] - starts[some]
                entries = np.repeat(starts[some] - np.cumsum(size) + size, size) + np.arange(size.sum())
                exact = tx.totals(own[place[entries]] * impact[entries], np.append(0, np.cumsum(size)))
                good = exact >= self.threshold[q]
                self._keep(int(q), exact[good], ids[some[good]])

    def _keep(self, q: int, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate((self.scores[q], scores)), np.concatenate((self.docs[q], ids))
        if len(scores) > self.plan.k:
            # All ties with the k-th stay until ids are compared.
            limit = np.partition(scores, len(scores) - self.plan.k)[len(scores) - self.plan.k]
            above = scores > limit
            tied = np.flatnonzero(scores == limit)
            room = self.plan.k - int(above.sum())
            if len(tied) > room:
                tied = tied[sorted(range(len(tied)), key=lambda i: (ids[tied[i]] is None, 0 if ids[tied[i]] is None else ids[tied[i]]))[:room]]
            chosen = np.concatenate((np.flatnonzero(above), tied))
            scores, ids = scores[chosen], ids[chosen]
            self.threshold[q] = max(limit, 1)
        self.scores[q], self.docs[q] = scores, ids

    def rows(self, id_type: pa.DataType, doc_type: pa.DataType) -> Iterator[pa.RecordBatch]:
        sizes = [len(s) for s in self.scores]
        if sum(sizes):
            names = [i for i, size in zip(self.block.ids, sizes, strict=True) for _ in range(size)]
            yield pa.RecordBatch.from_pydict(
                {
                    "item_id": pa.array(names, id_type),
                    "item": pa.array(np.repeat(self.block.rows, sizes)),
                    "doc_id": pa.array(np.concatenate(self.docs), doc_type),
                    "score": pa.array(np.concatenate(self.scores)),
                }
            )


def best_in_tasks(docs: DataFrame, block: Block, plan: Plan, id_type: str) -> DataFrame | None:
    """Each task's k best documents of every query of the block; None if no document has a term."""
    n_docs, n_terms, df = counts(docs.select("text"), block.vocabulary)
    if not n_docs:
        return None
    # Terms of no document add to no score; without weight they do not loosen the bounds.
    weights = np.array([weight(n_docs, int(d)) if d else 0 for d in df], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranking = Ranking(block, weights, n_docs, n_terms, plan)
        doc_type = pa.int64()
        for batch in batches:
            doc_type = batch.column("doc_id").type
            for chunk in tx.chunks(batch):
                for lo in range(0, chunk.num_rows, plan.chunk_rows):
                    part = chunk.slice(lo, plan.chunk_rows)
                    ranking.add(np.array(part.column("doc_id").to_pylist(), object), part.column("text"))
        kind = pa.string() if id_type == "string" else pa.int64()
        yield from ranking.rows(kind, doc_type)

    schema = RESULT.format(id=id_type, doc=docs.schema["doc_id"].dataType.simpleString())
    return docs.mapInArrow(run, schema)


def search(docs: DataFrame, items: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of each item, best first, ties to smaller doc_id.

    Equal rows of items are one query; an item without terms, null texts included, finds nothing, and
    a null doc_id comes after all others among ties. Rows of docs are ranked one by one, repeated ids too;
    other columns of either table are ignored. Ids of items are integers or strings."""
    spark = docs.sparkSession
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    asked = items.select(F.col("item_id").alias("id"), F.col("text").cast("string").alias("text")).distinct()
    if asked.schema["id"].dataType.simpleString() not in ("string", "bigint"):
        asked = asked.withColumn("id", F.col("id").cast("bigint"))
    id_type = asked.schema["id"].dataType.simpleString()
    # A number per query, and its block; fixed by being written.
    numbered = asked.withColumn("item", F.monotonically_increasing_id())
    queries = stored(numbered, "lexical-items")
    blocks = -(-queries.count() // plan.block_items)
    path = f"{shared_dir(spark)}/lexical-{uuid.uuid4().hex}"
    schema = RESULT.format(id=id_type, doc=texts.schema["doc_id"].dataType.simpleString())
    best: DataFrame | None = None
    for b in range(blocks):
        # A block holds about block_items queries, dealt by hash; it alone comes to the driver.
        own = queries if blocks == 1 else queries.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b)
        block = _block(own.orderBy("item").collect())
        found = best_in_tasks(texts, block, plan, id_type)
        if found is None:
            break
        if blocks == 1:
            best = found
        else:
            found.write.mode("append").parquet(path)
            best = spark.read.schema(schema).parquet(path)
    if best is None:
        return spark.createDataFrame([], schema).select("item_id", F.lit(0).alias("rank"), "doc_id", "score")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= plan.k)
    return ranked.select("item_id", "rank", "doc_id", "score")
