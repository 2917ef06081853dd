"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on toxic and one on ordinary text. A window is compressed
with either; the bytes that the toxic dictionary saves are its evidence. A text's score is the share
of toxic documents among calibration documents with as many windows above the threshold.

* Toxic text: the words of toxic documents that hold letter 5-grams which are over-represented there.
  5-grams are counted in distinct contexts (word, neighbours to the left and right), so that passages
  that documents share count once. Stems that the trainer leaves out are appended.
* Ordinary text gets the larger dictionary, so that endings which both kinds of words share cost no
  more with it.
* A window is a word with the spaces around it. zstandard neither searches the last 8 bytes of its
  input nor shrinks a few bytes, so a window stands between two copies of a frame that both
  dictionaries end with; its cost is the same in both. A worker compresses each distinct word once.
* The threshold is the one that separates the calibration documents best.
"""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructType

from trackflow.llm import text as tx

GRAM = 5
FRAME = b" 0123456789abcdef0123456789ABCDEF"
CUT = 0.3


@dataclass(frozen=True)
class Fit:
    """Bounds of the labelled sample, and of what counts as over-represented.

    A row longer than max_bytes is not drawn for the sample (it is scored like any other)."""

    toxic_rows: int = 800
    ordinary_rows: int = 1600
    max_bytes: int = 1 << 16
    calibration_part: int = 3  # one in so many rows
    toxic_bytes: int = 4096
    ordinary_bytes: int = 65_536
    least_evidence: float = 25.0  # log likelihood ratio statistic of a 5-gram
    least_ratio: float = 30.0
    max_cached_words: int = 1_500_000


@dataclass(frozen=True)
class Model:
    """Dictionary contents, the threshold in bytes, and P(toxic) for 0, 1, 2 ... windows above it."""

    toxic: bytes
    ordinary: bytes
    threshold: int
    chance: tuple[float, ...]


def _contexts(texts: list[str]) -> tuple[dict[str, int], int]:
    """Distinct contexts of each 5-gram, and of all words."""
    seen: set[int] = set()
    grams: defaultdict[str, int] = defaultdict(int)
    for text in texts:
        words = text.split()
        for context in zip(["", *words[:-1]], words, [*words[1:], ""], strict=True):
            key = hash(context)
            if key not in seen:
                seen.add(key)
                spaced = f" {context[1]} "
                for gram in {spaced[i : i + GRAM] for i in range(len(spaced) - GRAM + 1)}:
                    grams[gram] += 1
    return grams, max(len(seen), 1)


def evidence(a: int, n: int, b: int, m: int) -> float:
    """Twice the log likelihood ratio of a in n and b in m against a common rate."""

    def fit(k: int, size: int, rate: float) -> float:
        return (k * math.log(rate) if k else 0.0) + ((size - k) * math.log1p(-rate) if size > k else 0.0)

    common = (a + b) / (n + m)
    return 2 * (fit(a, n, a / n) + fit(b, m, b / m) - fit(a, n, common) - fit(b, m, common))


def stems(spaced: str, strong: set[str]) -> list[str]:
    """Longest runs of a word that strong 5-grams cover one after another."""
    found, i, last = [], 0, len(spaced) - GRAM
    while i <= last:
        j = i
        while j <= last and spaced[j : j + GRAM] in strong:
            j += 1
        if j > i:
            found.append(spaced[i : j - 1 + GRAM])
        i = max(j, i + 1)
    return found


def trained(samples: list[bytes], size: int) -> bytes:
    """Contents of a dictionary trained on the samples; the samples themselves if they are too few."""
    try:
        return zstandard.train_dictionary(size, samples, k=32, d=6).as_bytes()
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(samples))[-size:]


class Lengths:
    """Bytes that the toxic dictionary saves on each word; every distinct word is compressed once."""

    def __init__(self, toxic: bytes, ordinary: bytes, most: int) -> None:
        self.toxic, self.ordinary = (self._compressor(x + FRAME) for x in (toxic, ordinary))
        self.most = most
        self.keys, self.saved = np.zeros(0, np.uint64), np.zeros(0, np.int16)

    @staticmethod
    def _compressor(content: bytes) -> zstandard.ZstdCompressor:
        parameters = zstandard.ZstdCompressionParameters(
            strategy=zstandard.STRATEGY_LAZY, min_match=4, window_log=17, hash_log=15, chain_log=15, search_log=5,
            target_length=32, write_content_size=False, write_checksum=False, write_dict_id=False,
        )
        dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        return zstandard.ZstdCompressor(dict_data=dictionary, compression_params=parameters)

    def of(self, word: bytes) -> int:
        window = FRAME + b" " + word + b" " + FRAME
        saved = len(self.ordinary.compress(window)) - len(self.toxic.compress(window))
        return min(max(saved, -1000), 1000)

    def words(self, words: tx.Words) -> np.ndarray:
        if (words.ends - words.starts).max(initial=0) > 2 * tx.CHUNK_BYTES:
            # Hashing so long a word takes fifty times its memory: it is compressed as it is, and not kept.
            spans = zip(words.starts.tolist(), words.ends.tolist(), strict=True)
            return np.array([self.of(words.data[a:b].tobytes()) for a, b in spans], np.int16)
        hashed = words.hashes()
        unique, where, inverse = np.unique(hashed, return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, unique)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == unique[known]
        if not known.all():
            if len(self.keys) + int((~known).sum()) > self.most:
                self.keys, self.saved, known = self.keys[:0], self.saved[:0], np.zeros(len(unique), bool)
            raw = words.data.tobytes()
            new = where[~known]
            spans = zip(words.starts[new].tolist(), words.ends[new].tolist(), strict=True)
            fresh = np.fromiter((self.of(raw[a:b]) for a, b in spans), np.int16, len(new))
            keys, saved = np.concatenate((self.keys, unique[~known])), np.concatenate((self.saved, fresh))
            order = np.argsort(keys)
            self.keys, self.saved = keys[order], saved[order]
            at = np.searchsorted(self.keys, unique)
        return self.saved[at][inverse]


def train(rows: list[tuple[int, str]], fit: Fit) -> Model:
    """Model of (label, text) rows; without evidence every text gets the share of toxic rows."""
    rows = [(label, text.lower()) for label, text in rows]
    held = [r for i, r in enumerate(rows) if i % fit.calibration_part == 0]
    used = [r for i, r in enumerate(rows) if i % fit.calibration_part]
    toxic, ordinary = [t for y, t in used if y], [t for y, t in used if not y]
    rate = (sum(y for y, _ in rows) + 1) / (len(rows) + 10)
    in_toxic, n = _contexts(toxic)
    in_ordinary, m = _contexts(ordinary)
    strong = {
        gram
        for gram, a in in_toxic.items()
        if a * m >= fit.least_ratio * in_ordinary.get(gram, 0) * n
        and evidence(a, n, in_ordinary.get(gram, 0), m) > fit.least_evidence
    }
    draw = random.Random(7)
    runs = Counter(run for text in toxic for word in text.split() for run in stems(f" {word} ", strong))
    if not runs:
        return Model(b"", b"", 1000, (rate,))
    samples = [f" {word} ".encode() for text in toxic for word in text.split() if stems(f" {word} ", strong)]
    draw.shuffle(samples)
    share = -(-60_000 // max(len(ordinary), 1))
    some = (draw.sample(w, min(len(w), share)) for w in map(str.split, ordinary))
    plain = [f" {w} ".encode() for words in some for w in words]
    toxic_content = trained(samples, fit.toxic_bytes)
    left = [s.encode() for s, _ in sorted(runs.items(), key=lambda x: (x[1], x[0])) if s.encode() not in toxic_content]
    toxic_content += b"".join(left)
    ordinary_content = trained(plain, fit.ordinary_bytes)

    lengths = Lengths(toxic_content, ordinary_content, fit.max_cached_words)
    labels = np.array([y for y, _ in held])
    saved = [lengths.words(tx.Words(*tx.buffers(pa.array([t])))) for _, t in held]
    best, threshold = -1.0, 1
    for level in range(1, 17):
        hit = np.array([(s >= level).any() for s in saved])
        f1 = 2 * (hit & (labels == 1)).sum() / max(hit.sum() + labels.sum(), 1)
        if f1 > best:
            best, threshold = f1, level
    counts = np.array([min(int((s >= threshold).sum()), 3) for s in saved])
    chance, floor = [], 0.0
    for k in range(4):
        own = labels[counts == k]
        # A few windows' worth of the overall rate as a prior; never falling.
        floor = max(floor, (own.sum() + 2 * rate) / (len(own) + 2))
        chance.append(float(floor))
    return Model(toxic_content, ordinary_content, threshold, tuple(chance))


def sample(docs: DataFrame, labels: DataFrame, fit: Fit) -> list[tuple[int, str]]:
    """Bounded sample of (label, text), the same for any order or partitioning.

    labels: doc_id, toxic. Of several labels of one id the larger counts."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    known = known.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    known = known.withColumn("h", F.xxhash64(F.col("doc_id"), F.lit("sample")))
    parts = []
    for label, most in ((1, fit.toxic_rows), (0, fit.ordinary_rows)):
        parts.append(known.where(F.col("toxic") == label).orderBy("h", "doc_id").limit(most))
    chosen = F.broadcast(parts[0].unionByName(parts[1]))
    short = docs.where(F.col("text").isNotNull() & (F.octet_length("text") <= fit.max_bytes)).select("doc_id", "text")
    found = short.join(chosen, "doc_id").groupBy("doc_id", "h", "toxic").agg(F.min("text").alias("text"))
    rows = found.select("h", "doc_id", "toxic", "text").collect()
    return [(r.toxic, r.text) for r in sorted(rows, key=lambda r: (r.h, r.doc_id))]


def score(column: pa.Array, model: Model, most: int) -> np.ndarray:
    if len(model.chance) == 1:
        return np.full(len(column), model.chance[0])
    lengths = tx.held((model.toxic, model.ordinary), lambda: Lengths(model.toxic, model.ordinary, most))
    hits = np.zeros(len(column), np.int64)
    for piece in tx.pieces(column):
        words = tx.Words(*tx.buffers(tx.lowered(piece)))
        hits += tx.totals(lengths.words(words) >= model.threshold, words.bounds)
    return np.array(model.chance)[np.minimum(hits, len(model.chance) - 1)]


def classify(docs: DataFrame, training: DataFrame, labels: DataFrame, fit: Fit = Fit()) -> DataFrame:
    """The rows of docs with score (0 to 1) and predicted (score >= 0.3) in place of columns of these names.

    training: doc_id, text; labels: doc_id, toxic. A bounded sample of them (see Fit) is learned from
    when this is called. Null and empty texts have no window above the threshold. Repeated rows stay."""
    model = train(sample(training, labels, fit), fit)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop("score", "predicted")
    fields = docs.columns
    at = fields.index("text")
    most = fit.max_cached_words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tx.chunks(batch):
                values = score(part.column(at), shared.value, most)
                hit = pa.array((values >= CUT).astype(np.int32))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(values), hit], names=[*fields, "score", "predicted"])

    schema = StructType([*docs.schema.fields]).add("score", DoubleType()).add("predicted", IntegerType())
    return docs.mapInArrow(run, schema)

