"""Language identification by string kernels.

A text is cut into windows of about 512 characters. A window is the set of its letter n-grams of
lengths 1 to 3 (a blended spectrum, presence only). The kernel of two windows is the size of the sets'
intersection over the root of the product of their sizes. Landmarks drawn from the labelled sample
give Nystroem features; one-versus-rest kernel ridge regression is solved on them. A text's margins
are the means over its windows, weighted by their letters, so that the larger part of a text that
quotes another language decides.

With landmark sets as columns of a 0/1 matrix P, kernel values are X P and scores are (X P) A. The
product P A is formed once, so that a batch of texts is scored by one product of its sparse presence
matrix X with a small dense one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructType

from trackflow.llm import text as tx

UNKNOWN = "und"
ORDERS = 3
WINDOW = 512
CHUNK_BYTES = 1 << 19
BLOCK = 1 << 23


@dataclass(frozen=True)
class Fit:
    """Bounds of the labelled sample that the model is fitted on.

    A row longer than max_bytes is not drawn for the sample (it is predicted like any other)."""

    rows_per_language: int = 160
    max_bytes: int = 1 << 14
    windows_per_language: int = 512
    languages: int = 128
    landmarks: int = 192
    ridge: float = 0.01
    symbols: int = 64


@dataclass(frozen=True)
class Model:
    """classes: letter class of each code point (0: no letter, 1: a rare one); weights: a row per n-gram,
    whose last column says whether any landmark has it; usual: per language the share of known n-grams
    that its windows hardly ever fall below."""

    languages: list[str]
    classes: np.ndarray
    base: int
    weights: np.ndarray
    bias: np.ndarray
    usual: np.ndarray


def _letters() -> np.ndarray:
    """1 for code points that are letters."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), np.uint8, 0x110000)


def code_points(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased code points of a text column, and offsets."""
    data, offsets = tx.buffers(tx.lowered(column))
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    starts = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=starts[1:])
    return points, starts[offsets]


def separated(points: np.ndarray, offsets: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Letter classes of the texts' code points, a run of other characters as one 0, and bounds of the texts."""
    kind = classes[points]
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    keep = np.ones(len(kind), bool)
    keep[1:] = (kind[1:] != 0) | (kind[:-1] != 0) | (doc[1:] != doc[:-1])
    return kind[keep], np.searchsorted(doc[keep], np.arange(len(offsets)))


def windows_of(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The text and window of each place, and bounds of the texts in the windows. A text has a window at least."""
    size = np.diff(bounds)
    windows = np.maximum((size + WINDOW // 2) // WINDOW, 1)
    first = np.append(0, np.cumsum(windows))
    doc = np.repeat(np.arange(len(size)), size)
    place = np.arange(bounds[-1]) - bounds[doc]
    return first[doc] + place * windows[doc] // size[doc], first


def window_sets(kind: np.ndarray, window: np.ndarray, count: int, base: int) -> tuple[np.ndarray, ...]:
    """Distinct n-grams of count windows one after another, bounds of the windows, and letters in each.

    n-grams of separators alone do not exist."""
    kind = kind.astype(np.int64)
    letters = np.bincount(window[kind > 0], minlength=count)
    width = gram_space(base)
    keys, start, code = [], 0, np.zeros(len(kind), np.int64)
    for n in range(1, ORDERS + 1):
        # n-grams that end at each place; those of length n start at `start` in the numbering.
        previous = np.zeros(len(code), np.int64)
        previous[1:] = code[:-1]
        code = previous * base + kind
        whole = np.zeros(len(code), bool)
        whole[n - 1 :] = window[n - 1 :] == window[: len(window) - n + 1]
        whole &= code > 0
        keys.append((window * width + start + code)[whole])
        start += base**n
    found = np.sort(np.concatenate(keys))
    if len(found):
        found = found[np.append(True, found[1:] != found[:-1])]
    cuts = np.searchsorted(found, np.arange(count + 1) * width)
    return found - np.repeat(np.arange(count) * width, np.diff(cuts)), cuts, letters


def gram_sets(points: np.ndarray, offsets: np.ndarray, classes: np.ndarray, base: int) -> tuple[np.ndarray, ...]:
    """What window_sets gives for the windows of the texts, and bounds of the texts in the windows."""
    kind, bounds = separated(points, offsets, classes)
    window, first = windows_of(bounds)
    return *window_sets(kind, window, int(first[-1]), base), first


def gram_space(base: int) -> int:
    return sum(base**n for n in range(1, ORDERS + 1))


def row_sums(weights: np.ndarray, grams: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The product of a 0/1 matrix, given by its rows' columns, with weights."""
    out = np.zeros((len(bounds) - 1, weights.shape[1]), weights.dtype)
    full = np.flatnonzero(np.diff(bounds))
    # Some windows at a time, so that the rows of weights taken are few for any number of languages.
    step = max(1, BLOCK // (weights.shape[1] * ORDERS * WINDOW))
    for i in range(0, len(full), step):
        some = full[i : i + step]
        a, b = bounds[some[0]], bounds[some[-1] + 1]
        out[some] = np.add.reduceat(weights[grams[a:b]], bounds[some] - a, axis=0)
    return out


def sample(docs: DataFrame, fit: Fit) -> list[tuple[str, str]]:
    """(language, text) of at most rows_per_language rows of each of the most frequent languages.

    Rows are drawn by the hash of their text, so the draw does not hang on order or partitions."""
    short = F.octet_length("text") <= fit.max_bytes
    labelled = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & short).select(
        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")
    )
    counts = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(fit.languages)
    # Twice the rows needed pass the first sieve, then the smallest hashes stay.
    share = F.least(F.lit(1.0), (2.0 * fit.rows_per_language + 32) / F.col("count"))
    counts = counts.select("lang", (share * (1 << 31)).alias("limit"))
    drawn = labelled.join(F.broadcast(counts), "lang").withColumn("h", F.xxhash64("text"))
    drawn = drawn.where((F.col("h").bitwiseAND((1 << 31) - 1)) <= F.col("limit"))
    drawn = drawn.dropDuplicates(["lang", "h"])
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h", "text"))
    drawn = drawn.withColumn("n", place).where(F.col("n") <= fit.rows_per_language)
    return sorted((r.lang, r.text) for r in drawn.select("lang", "text").collect())


def sample_chunks(rows: list[tuple[str, str]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Code points and offsets of the sample's texts, some texts at a time."""
    batch = pa.RecordBatch.from_pydict({"text": pa.array([t for _, t in rows], pa.large_string())})
    for part in tx.chunks(batch, limit=CHUNK_BYTES):
        yield code_points(part.column("text"))


def train(rows: list[tuple[str, str]], fit: Fit) -> Model:
    letters = _letters()
    counts = np.zeros(len(letters), np.int64)
    for points, _ in sample_chunks(rows):
        seen, times = np.unique(points, return_counts=True)
        counts[seen] += times
    seen = np.flatnonzero((counts > 0) & (letters > 0))
    common = seen[np.lexsort((seen, -counts[seen]))][: fit.symbols - 2]
    classes = letters.copy()
    classes[common] = np.arange(2, 2 + len(common))
    base = fit.symbols
    width = gram_space(base)
    # Windows with letters, per language; the n-grams of those that are learned from are taken afterwards.
    owner, lettered = [], []
    at = 0
    for points, offsets in sample_chunks(rows):
        kind, bounds = separated(points, offsets, classes)
        window, first = windows_of(bounds)
        lettered.append(np.bincount(window[kind > 0], minlength=first[-1]) > 0)
        names = np.array([lang for lang, _ in rows[at : at + len(bounds) - 1]], object)
        owner.append(np.repeat(names, np.diff(first)))
        at += len(bounds) - 1
    owner, lettered = np.concatenate([*owner, np.zeros(0, object)]), np.concatenate([*lettered, np.zeros(0, bool)])
    languages = sorted(set(owner[lettered]))
    if not languages:
        return Model([], classes, base, np.zeros((width, 0)), np.zeros(0), np.zeros(0))
    # Windows spread evenly over those of the sample.
    good = []
    for name in languages:
        own = np.flatnonzero((owner == name) & lettered)
        good.append(own[np.unique(np.linspace(0, len(own) - 1, min(len(own), fit.windows_per_language)).astype(int))])
    label = np.repeat(np.arange(len(languages)), [len(g) for g in good])
    each = max(1, fit.landmarks // len(languages))
    marks = np.concatenate([g[np.unique(np.linspace(0, len(g) - 1, min(len(g), each)).astype(int))] for g in good])
    good = np.concatenate(good)
    needed, sets, at = np.isin(np.arange(len(owner)), good), {}, 0
    for points, offsets in sample_chunks(rows):
        grams, bounds, _, first = gram_sets(points, offsets, classes, base)
        for i in np.flatnonzero(needed[at : at + first[-1]]):
            sets[at + i] = grams[bounds[i] : bounds[i + 1]].astype(np.int32)
        at += int(first[-1])
    # A row for each n-gram of a landmark, and one of zeros for all others.
    own = np.unique(np.concatenate([sets[i] for i in marks]))
    row = np.full(width, len(own))
    row[own] = np.arange(len(own))
    features = np.zeros((len(own) + 1, len(marks)), np.float32)
    for j, i in enumerate(marks):
        features[row[sets[i]], j] = 1 / np.sqrt(len(sets[i]))
    kernel = {i: features[row[sets[i]]].sum(axis=0) / np.sqrt(len(sets[i])) for i in good}
    values, vectors = np.linalg.eigh(np.array([kernel[i] for i in marks], np.float64))
    sound = values > 1e-6 * values[-1]
    whiten = vectors[:, sound] / np.sqrt(values[sound])
    x = np.array([kernel[i] for i in good], np.float64) @ whiten
    y = np.eye(len(languages))[label]
    # Each language weighs the same.
    weight = (1 / np.bincount(label))[label][:, None]
    weight /= weight.sum()
    mean_x, mean_y = (weight * x).sum(axis=0), (weight * y).sum(axis=0)
    x -= mean_x
    y -= mean_y
    solved = np.linalg.solve(x.T @ (weight * x) + fit.ridge / len(good) * np.eye(x.shape[1]), x.T @ (weight * y))
    weights = (features @ (whiten @ solved).astype(np.float32)).astype(np.float32)
    known = np.ones((len(own) + 1, 1), np.float32)
    known[-1] = 0
    weights = np.concatenate((weights, known), axis=1)[row]
    # Windows that are no landmarks: as far below the median as three times the first percentile.
    others = ~np.isin(good, marks)
    usual = np.zeros(len(languages))
    for c in range(len(languages)):
        some = good[others & (label == c)]
        if len(some):
            shares = [weights[sets[i], -1].mean() for i in some]
            low, middle = np.quantile(shares, [0.01, 0.5])
            usual[c] = max(middle - 3 * (middle - low), 0.0)
    return Model(languages, classes, base, weights, mean_y - mean_x @ solved, usual)


def _margins(grams: np.ndarray, bounds: np.ndarray, letters: np.ndarray, model: Model) -> np.ndarray:
    """Margins and share of known n-grams of each window, times its letters."""
    sizes = np.maximum(np.diff(bounds), 1)
    sums = row_sums(model.weights, grams, bounds)
    margins = np.column_stack((sums[:, :-1] / np.sqrt(sizes)[:, None] + model.bias, sums[:, -1] / sizes))
    return margins * letters[:, None]


def summed(column: pa.Array, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Letters of each text, and sums over its windows. Of a long text only one byte a character is held."""
    kinds, last = [], 1
    for piece in tx.pieces(column, CHUNK_BYTES, words=False):
        points, offsets = code_points(piece)
        if piece is column:
            grams, bounds, letters, first = gram_sets(points, offsets, model.classes, model.base)
            margins = _margins(grams, bounds, letters, model)
            return np.add.reduceat(letters, first[:-1]), np.add.reduceat(margins, first[:-1], axis=0)
        kind, _ = separated(points, offsets, model.classes)
        # A run of other characters goes on over a cut.
        kinds.append(kind[int(last == 0 and kind[0] == 0) :])
        last = kind[-1]
    kind = np.concatenate(kinds)
    windows = max((len(kind) + WINDOW // 2) // WINDOW, 1)
    total, sums, step = 0, 0.0, CHUNK_BYTES // WINDOW
    for lo in range(0, windows, step):
        hi = min(lo + step, windows)
        a, b = -(-lo * len(kind) // windows), -(-hi * len(kind) // windows)
        window = np.arange(a, b) * windows // len(kind) - lo
        grams, bounds, letters = window_sets(kind[a:b], window, hi - lo, model.base)
        total, sums = total + letters.sum(), sums + _margins(grams, bounds, letters, model).sum(axis=0)
    return np.array([total]), sums[None, :]


def scores(column: pa.Array, model: Model) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score and fit of each text; fits are not numbers if nothing was learned."""
    if not model.languages:
        return [UNKNOWN] * len(column), np.zeros(len(column)), np.full(len(column), np.nan)
    total, margins = summed(column, model)
    margins = margins / np.maximum(total, 1)[:, None]
    margins, shares = margins[:, :-1], margins[:, -1]
    best = margins.argmax(axis=1)
    score = np.clip(margins[np.arange(len(best)), best], 0.0, 1.0)
    known = total > 0
    usual = model.usual[best]
    fit = np.where(usual > 0, shares / np.maximum(usual, 1e-9), 1.0)
    names = [model.languages[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
    return names, np.where(known, score, 0.0), np.where(known, fit, 0.0)


def identify(docs: DataFrame, training: DataFrame, fit: Fit = Fit()) -> DataFrame:
    """The rows of docs with lang_pred, score (0 to 1) and lang_fit in place of columns of these names.

    lang_fit compares the share of a text's n-grams that the landmarks know with what its language hardly
    ever falls below: under 1 the text is in none of the languages; null if nothing could be learned.

    training has text and lang; a bounded sample of it (see Fit) is learned from when this is called.
    Null texts and texts without a letter get `und` and 0, and so do all texts if nothing could be
    learned. Repeated rows stay."""
    model = train(sample(training, fit), fit)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop("lang_pred", "score", "lang_fit")
    fields = docs.columns
    at = fields.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tx.chunks(batch, limit=CHUNK_BYTES):
                names, values, fits = scores(part.column(at), shared.value)
                columns = [*part.columns, pa.array(names, pa.string()), pa.array(values), pa.array(fits, from_pandas=True)]
                yield pa.RecordBatch.from_arrays(columns, names=[*fields, "lang_pred", "score", "lang_fit"])

    schema = StructType([*docs.schema.fields]).add("lang_pred", StringType()).add("score", DoubleType())
    schema = schema.add("lang_fit", DoubleType())
    return docs.mapInArrow(run, schema)
