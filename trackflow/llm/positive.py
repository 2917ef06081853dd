"""Quality classifier learned from trusted positives and unlabelled text.

Texts labelled as good are the positives; rows of the whole corpus, whatever their label, are the
unlabelled ones. Rows labelled as bad are not learned from. With the share pi of good text in the
corpus, the risk of calling text bad is the corpus's minus pi times the positives', so that

    pi * E_P[loss(g)] + max(0, E_U[loss(-g)] - pi * E_P[loss(-g)])

is minimised (non-negative unbiased risk, logistic loss), g linear in the features. Where a step's
estimate of the second part is negative, the step goes the other way for that part alone, so that the
classifier unlearns what only fits the sample.

The share pi is estimated from the same two samples: classifiers that tell positives from unlabelled
rows of one half score the other half. The share of unlabelled rows above a threshold over the share
of positives above it bounds pi; the threshold with the least bound, confidence included, is taken.

Features are shares of one- to three-byte shapes of the text (letters, capitals, digits, white space,
every other sign by itself), hashed, and shares of words that stand one to four words before as well,
each kept in one byte, so that a training row costs little whatever its text's length.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructType

from trackflow.llm import text as tx

PIECE = 1 << 20  # a longer text is counted in pieces of so many bytes
ROWS = 512  # texts whose counts are held at once
BUCKETS = 1024
LAGS = (1, 2, 3, 4)
SIZE = BUCKETS + len(LAGS)
CUT = 0.7
UNSURE = 0.5  # the score where nothing could be learned

# Shapes of bytes: small letters and bytes of other scripts, capitals, digits, white space, signs.
SHAPE = np.arange(256, dtype=np.uint8)
SHAPE[97:123] = SHAPE[128:] = ord("a")
SHAPE[65:91] = ord("A")
SHAPE[48:58] = ord("0")
SHAPE[[9, 11, 12, 13]] = 32
SPACE = np.array([32, 9, 10, 11, 12, 13], np.uint8)


@dataclass(frozen=True)
class Fit:
    """Bounds of the samples, and of the optimiser.

    About so many rows are drawn by a hash of their ids, of any length: the driver gets their
    features, SIZE bytes a row, never their texts."""

    positive_rows: int = 3000
    unlabelled_rows: int = 6000
    steps: int = 400
    rate: float = 0.05
    decay: float = 1e-3
    confidence: float = 0.1
    seed: int = 12


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float
    prior: float


def _grams(shape: np.ndarray, doc: np.ndarray, texts: int, inside: np.ndarray) -> np.ndarray:
    """Occurrences of the hashed one- to three-byte shapes that begin where inside holds."""
    out = np.zeros((texts, BUCKETS), np.int64)
    code = np.zeros(len(shape), np.uint64)
    for n in (1, 2, 3):
        end = len(shape) - n + 1
        if end <= 0:
            break
        code = code[:end] * np.uint64(257) + shape[n - 1 :].astype(np.uint64) + np.uint64(1)
        fits = inside[:end] & (doc[:end] == doc[n - 1 :])
        bucket = (tx.mix(code[fits] ^ np.uint64(n << 40)) % np.uint64(BUCKETS)).astype(np.int64)
        out += np.bincount(doc[:end][fits] * BUCKETS + bucket, minlength=texts * BUCKETS).reshape(texts, BUCKETS)
    return out


def _repeats(words: tx.Words, first: int = 0) -> np.ndarray:
    """Words from the given one on that are equal to the word so many places before."""
    hashes = words.hashes()
    texts = len(words.offsets) - 1
    out = np.zeros((texts, len(LAGS)), np.int64)
    for i, lag in enumerate(LAGS):
        at = np.flatnonzero((hashes[lag:] == hashes[:-lag]) & (words.doc[lag:] == words.doc[:-lag])) + lag
        out[:, i] = np.bincount(words.doc[at[at >= first]], minlength=texts)
    return out


def _long_counts(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Counts of one long text, in pieces that overlap by what shapes and repeats look back on."""
    grams, repeats, n_words = np.zeros((1, BUCKETS), np.int64), np.zeros((1, len(LAGS)), np.int64), 0
    for lo in range(0, len(data), PIECE):
        part = data[lo : lo + PIECE + 2]
        inside = np.arange(len(part)) < PIECE
        grams += _grams(SHAPE[part], np.zeros(len(part), np.int64), 1, inside)
    lo, tail = 0, np.zeros(0, np.uint8)  # the last words of the pieces before
    while lo < len(data):
        hi = min(lo + PIECE, len(data))
        while hi < len(data) and not len(gaps := np.flatnonzero(np.isin(data[hi : hi + PIECE], SPACE))):
            hi = min(hi + PIECE, len(data))
        hi += int(gaps[0]) if hi < len(data) else 0
        part = np.concatenate((tail, data[lo:hi]))
        words = tx.Words(part, np.array([0, len(part)]))
        carried = int(np.searchsorted(words.starts, len(tail)))
        repeats += _repeats(words, carried)
        n_words += len(words.starts) - carried
        kept = words.starts[-max(LAGS) :]
        tail = np.append(part[kept[0] : words.ends[-1]], np.uint8(32)) if len(kept) else tail
        lo = hi
    return grams, repeats, n_words


def parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in slices that are small in bytes and in rows."""
    for chunk in tx.chunks(batch):
        for lo in range(0, chunk.num_rows, ROWS):
            yield chunk.slice(lo, ROWS)


def features(column: pa.Array) -> np.ndarray:
    """A row of SIZE bytes for each text: square roots of shares, 255 for all."""
    data, offsets = tx.buffers(column)
    if len(offsets) == 2 and len(data) > PIECE:
        grams, repeats, n = _long_counts(data)
        n_words = np.array([n])
    else:
        doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        grams = _grams(SHAPE[data], doc, len(offsets) - 1, np.ones(len(data), bool))
        words = tx.Words(data, offsets)
        repeats, n_words = _repeats(words), words.counts
    sizes = np.maximum(np.diff(offsets), 1)
    shares = np.concatenate((grams / sizes[:, None], repeats / np.maximum(n_words, 1)[:, None]), axis=1)
    return np.rint(255 * np.sqrt(np.minimum(shares, 1.0))).astype(np.uint8)


def _scaled(x: np.ndarray) -> np.ndarray:
    return x.astype(np.float32) * np.float32(8 / 255)


def _sigmoid(g: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(g, -30, 30)))


def _minimise(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None, fit: Fit) -> tuple[np.ndarray, float]:
    """Weights and bias. With a prior by the non-negative risk; without, positives against unlabelled."""
    w, b = np.zeros(positive.shape[1], np.float32), 0.0
    first, second = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for step in range(1, fit.steps + 1):
        gp, gu = positive @ w + b, unlabelled @ w + b
        up, uu = _sigmoid(gp), _sigmoid(gu)
        if prior is None:
            on_positive, on_unlabelled = (up - 1) / len(up), uu / len(uu)
        else:
            bad_risk = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
            if bad_risk >= 0:
                on_positive, on_unlabelled = prior * (up - 1 - up) / len(up), uu / len(uu)
            else:
                on_positive, on_unlabelled = prior * (up - 1 + up) / len(up), -uu / len(uu)
        slope = np.append(on_positive @ positive + on_unlabelled @ unlabelled + fit.decay * w, on_positive.sum() + on_unlabelled.sum())
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope * slope
        move = fit.rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        w, b = (w - move[:-1]).astype(np.float32), b - float(move[-1])
    return w, b


def estimated_prior(positive: np.ndarray, unlabelled: np.ndarray, fit: Fit) -> float:
    """Share of rows like the positives among the unlabelled ones."""
    if len(positive) < 2 or len(unlabelled) < 2:
        return 0.5
    found: list[list[np.ndarray]] = [[], []]
    for half in (0, 1):
        w, b = _minimise(positive[half::2], unlabelled[half::2], None, fit)
        for scored, x in zip(found, (positive, unlabelled), strict=True):
            scored.append(x[1 - half :: 2] @ w + b)
    p, u = (np.sort(np.concatenate(x)) for x in found)
    cuts = np.unique(p)
    above_p = 1 - np.searchsorted(p, cuts) / len(p)
    above_u = 1 - np.searchsorted(u, cuts) / len(u)
    slack = sum(math.sqrt(math.log(4 / fit.confidence) / (2 * len(x))) for x in (p, u))
    best = np.argmin((above_u + slack) / above_p)
    return float(np.clip(above_u[best] / above_p[best], 0.01, 0.99))


def train(positive: np.ndarray, unlabelled: np.ndarray, fit: Fit = Fit()) -> Model | None:
    """A model from features of the two samples; None if either is empty."""
    if not len(positive) or not len(unlabelled):
        return None
    rng = np.random.default_rng(fit.seed)
    positive, unlabelled = (_scaled(x[rng.permutation(len(x))]) for x in (positive, unlabelled))
    prior = estimated_prior(positive, unlabelled, fit)
    w, b = _minimise(positive, unlabelled, prior, fit)
    return Model(w, b, prior)


def scores(x: np.ndarray, model: Model | None) -> np.ndarray:
    if model is None:
        return np.full(len(x), UNSURE)
    return _sigmoid((_scaled(x) @ model.weights).astype(np.float64) + model.bias)


def _sample(texts: DataFrame) -> np.ndarray:
    """Features of a sample, whose texts stay where they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch):
                rows = features(part.column("text"))
                yield pa.RecordBatch.from_pydict({"x": pa.array([r.tobytes() for r in rows], pa.binary())})

    found = sorted(bytes(r.x) for r in texts.select("text").mapInArrow(run, "x binary").collect())
    return np.frombuffer(b"".join(found), np.uint8).reshape(-1, SIZE)


def learn(corpus: DataFrame, labels: DataFrame, fit: Fit = Fit()) -> Model | None:
    """A model from corpus (doc_id, text) and labels (doc_id, quality).

    A document is a trusted positive if it has labels and all are 1; null labels and ids count for
    nothing. Samples are drawn by a hash of the id, so repeated rows come along together."""
    parts = 1 << 30
    draw = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(fit.seed)), F.lit(parts))
    trusted = labels.where("doc_id is not null and quality is not null").groupBy("doc_id")
    trusted = trusted.agg(F.min("quality").alias("_least")).where("_least = 1").select("doc_id")
    slim = corpus.select("doc_id", F.col("text").cast("string").alias("text"))
    n_trusted, n_corpus = trusted.count(), slim.count()
    if not n_trusted or not n_corpus:
        return None
    # About positive_rows ids: bounded, hence broadcast. Texts are not exchanged.
    some = trusted.where(draw < F.lit(min(parts, parts * fit.positive_rows // n_trusted)))
    positive = _sample(slim.join(F.broadcast(some), "doc_id", "left_semi"))
    unlabelled = _sample(slim.where(draw < F.lit(min(parts, parts * fit.unlabelled_rows // n_corpus))))
    return train(positive, unlabelled, fit)


def classify(docs: DataFrame, corpus: DataFrame, labels: DataFrame, fit: Fit = Fit()) -> DataFrame:
    """score and predicted for each row of docs (doc_id, text), besides its own columns as a struct `row`.

    The score is the chance that the text is good, 0.5 for all if nothing can be learned; it depends
    on the text alone, null and empty ones included, and predicted is 1 from CUT on."""
    model = learn(corpus, labels, fit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch):
                found = scores(features(part.column("text")), model)
                yield pa.RecordBatch.from_pydict(
                    {
                        "row": part.column("row"),
                        "score": pa.array(found),
                        "predicted": pa.array((found >= CUT).astype(np.int32)),
                    }
                )

    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text").cast("string").alias("text"))
    schema = StructType().add(packed.schema["row"]).add("score", DoubleType()).add("predicted", IntegerType())
    return packed.mapInArrow(run, schema)
