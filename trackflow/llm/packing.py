"""Pack documents into token sequences with order-preserving dynamic programming.

The tokens of consecutive documents form one stream. A sequence is a window of the stream of at most
`length` tokens; the cuts between windows lie at ends of documents, ends of sentences or, inside very
long sentences, at every `stride`-th token. The cuts chosen minimise padding plus a penalty for each
truncated document:

    cost(j) = penalty(j) + min over i with place(j) - place(i) <= length of cost(i) + length - (place(j) - place(i))

As cost(i) + place(i) does not depend on j, the minimum slides along the stream in a monotone queue.

The stream of a task is its partition of the input, in the order of the rows. Only the last sequence
of a partition is cut short. Sequence numbers become global by summing up the counts of partitions.
"""

from __future__ import annotations

import json
import zlib
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trackflow.llm import text as tx
from trackflow.llm.shared import stored

END_ID = 1
# Marks that end a sentence, and marks that may be cut off a word that ends in a letter: the
# tokenizer's own split always has a boundary there.
SENTENCE_END = np.zeros(256, bool)
SENTENCE_END[[ord(c) for c in ".!?"]] = True
_TAIL = np.zeros(256, bool)
_TAIL[[ord(c) for c in ".,!?;:%$#&*"]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@dataclass(frozen=True)
class Plan:
    """Penalties are in tokens of padding; stride bounds the distance of two possible cuts.

    A part is what one run of the dynamic program sees: the state that runs on is bounded by it."""

    length: int = 2048
    sentence_penalty: float = 4.0
    token_penalty: float = 32.0
    stride: int = 64
    part_tokens: int = 1 << 22


class WordTokens:
    """Token ids of words, kept by the words' hashes; forgets all beyond a number of words.

    Words are looked up in sorted arrays; the newest are merged in once per chunk."""

    def __init__(self, path: str, most: int = 1_500_000) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        normalizer = json.dumps(json.loads(self.tokenizer.to_str())["normalizer"])
        self.lower = '"Lowercase"' in normalizer
        self.most = most
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.first = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int32)
        self.ids = np.zeros(0, np.uint32)

    def learn(self, keys: np.ndarray, words: list[str]) -> None:
        if len(self.keys) + len(keys) > self.most:
            self.clear()
        found = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        count = np.fromiter(map(len, found), np.int32, len(found))
        flat = np.fromiter((i for ids in found for i in ids), np.uint32, int(count.sum()))
        first = len(self.ids) + np.cumsum(count, dtype=np.int64) - count
        keys, first, count = (np.concatenate(x) for x in ((self.keys, keys), (self.first, first), (self.count, count)))
        order = np.argsort(keys)
        self.keys, self.first, self.count = keys[order], first[order], count[order]
        self.ids = np.concatenate((self.ids, flat))

    def encode(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, words: tx.Words) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after another, and how many each word has."""
        hashed = words.span_hash(starts, ends)
        unique, where, inverse = np.unique(hashed, return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, unique)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == unique[known]
        if not known.all():
            if len(self.keys) + int((~known).sum()) > self.most:
                self.clear()
                known[:] = False
            raw = data.tobytes()
            new = where[~known]
            spans = zip(starts[new].tolist(), ends[new].tolist(), strict=True)
            self.learn(unique[~known], [raw[a:b].decode("utf-8", "replace") for a, b in spans])
            at = np.searchsorted(self.keys, unique)
        count = self.count[at][inverse]
        first = self.first[at][inverse]
        total = int(count.sum())
        begin = np.cumsum(count, dtype=np.int64) - count
        index = np.repeat(first - begin, count) + np.arange(total)
        return self.ids[index], count


def word_tokens(path: str) -> WordTokens:
    """The worker's own."""
    return tx.held(("tokens", path), lambda: WordTokens(path))


def tokenize(column: pa.Array, tokens: WordTokens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of every text with the end id, tokens per text, and the places where sentences end.

    Equal to the tokenizer on whole texts, for tokenizers that drop white space: a word is split only
    where a letter meets closing marks. Texts with a special token's start are left in their case."""
    data, offsets = tx.buffers(column)
    words = tx.Words(data, offsets)
    if tokens.lower and b"<|" not in data.tobytes():
        words.data = data = _LOWER[data]
    n = len(words.starts)
    # Cut off closing marks: the last byte that is none of them must be a letter.
    last = np.maximum.accumulate(np.where(_TAIL[data], -1, np.arange(len(data)))) if len(data) else data.astype(np.int64)
    stem = last[words.ends - 1] + 1
    cut = (stem < words.ends) & (stem > words.starts)
    cut[cut] = _LETTER[data[stem[cut] - 1]]
    stem[~cut] = words.ends[~cut]
    spans = np.zeros((n, 2, 2), np.int64)
    spans[:, 0, 0], spans[:, 0, 1], spans[:, 1, 0], spans[:, 1, 1] = words.starts, stem, stem, words.ends
    spans = spans.reshape(-1, 2)
    real = np.ones(2 * n, bool)
    real[1::2] = cut
    ids, per_span = tokens.encode(data, spans[real, 0], spans[real, 1], words)
    filled = np.zeros(2 * n, np.int64)
    filled[real] = per_span
    per_word = filled.reshape(-1, 2).sum(axis=1)
    ends = np.cumsum(per_word)  # tokens up to each word's end, without end ids
    sums = np.append(0, ends)
    per_doc = sums[words.bounds[1:]] - sums[words.bounds[:-1]]
    # Put the end id after each text.
    out = np.full(len(ids) + len(per_doc), END_ID, np.uint32)
    doc_of = np.repeat(np.arange(len(per_doc)), per_doc)
    out[np.arange(len(ids)) + doc_of] = ids
    stop = SENTENCE_END[data[words.ends - 1]] if n else np.zeros(0, bool)
    return out, per_doc + 1, (ends + words.doc)[stop]


def best_cuts(places: np.ndarray, penalties: np.ndarray, length: int) -> list[int]:
    """Places that cut the stream from 0 to the last place at the least cost.

    places rise strictly, start with 0 and are at most length apart."""
    place, penalty = places.tolist(), penalties.tolist()
    n = len(place)
    back = [0] * n
    queue: deque[tuple[float, int, int]] = deque([(0.0, 0, 0)])  # cost + place, place, index
    for j in range(1, n):
        at = place[j]
        while at - queue[0][1] > length:
            queue.popleft()
        least, _, back[j] = queue[0]
        value = least + length + penalty[j]  # cost(j) + place(j)
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, at, j))
    cuts, j = [], n - 1
    while j > 0:
        cuts.append(place[j])
        j = back[j]
    return cuts[::-1]


def candidates(per_doc: np.ndarray, sentences: np.ndarray, plan: Plan) -> tuple[np.ndarray, np.ndarray]:
    """Possible cuts of a stream and their penalties."""
    ends = np.cumsum(per_doc)
    sentences = np.setdiff1d(sentences, ends)
    places = np.concatenate(([0], ends, sentences))
    penalties = np.concatenate((np.zeros(len(ends) + 1), np.full(len(sentences), plan.sentence_penalty)))
    order = np.argsort(places, kind="stable")
    places, penalties = places[order], penalties[order]
    gaps = np.diff(places)
    extra = np.maximum((gaps - 1) // plan.stride, 0)
    if extra.any():
        step = np.arange(int(extra.sum())) - np.repeat(np.cumsum(extra) - extra, extra) + 1
        more = np.repeat(places[:-1], extra) + step * plan.stride
        places = np.concatenate((places, more))
        penalties = np.concatenate((penalties, np.full(len(more), plan.token_penalty)))
        order = np.argsort(places, kind="stable")
        places, penalties = places[order], penalties[order]
    return places, penalties


class Stream:
    """Packs the texts of a task part by part; the last, unfinished window opens the next part."""

    def __init__(self, plan: Plan) -> None:
        self.plan, self.sequence = plan, 0
        self.ids: list[np.ndarray] = []
        self.per_doc: list[np.ndarray] = []
        self.sentences: list[np.ndarray] = []
        self.keys: list[pa.Array] = []
        self.starts: list[np.ndarray] = []  # ids of a document that earlier parts have packed
        self.wholes: list[np.ndarray] = []
        self.held = 0

    def add(self, keys: pa.Array, ids: np.ndarray, per_doc: np.ndarray, sentences: np.ndarray) -> None:
        self.sentences.append(sentences + self.held)
        self.ids.append(ids)
        self.per_doc.append(per_doc)
        self.wholes.append(per_doc)
        self.starts.append(np.zeros(len(per_doc), np.int64))
        self.keys.append(keys)
        self.held += len(ids)

    def pack(self, finish: bool) -> pa.RecordBatch | None:
        if not self.held:
            return None
        plan = self.plan
        ids, per_doc, sentences = (np.concatenate(x) for x in (self.ids, self.per_doc, self.sentences))
        starts, wholes = np.concatenate(self.starts), np.concatenate(self.wholes)
        keys = pa.concat_arrays(self.keys)
        places, penalties = candidates(per_doc, sentences, plan)
        cuts = best_cuts(places, penalties, plan.length)
        if not finish:
            cuts = cuts[:-2]
        stop = cuts[-1] if cuts else 0
        # Pieces: windows cut by documents.
        ends = np.cumsum(per_doc)
        begins = ends - per_doc
        bounds = np.union1d(np.append(0, cuts), ends[ends <= stop]).astype(np.int64)
        lo, hi = bounds[:-1], bounds[1:]
        doc = np.searchsorted(ends, lo, "right")
        window = np.searchsorted(np.array(cuts, np.int64), lo, "right")
        opening = np.append(0, cuts).astype(np.int64)[window]
        raw = ids.astype("<u4").tobytes()
        view = memoryview(raw)
        crc = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(lo.tolist(), hi.tolist(), strict=True)]
        out = pa.RecordBatch.from_pydict(
            {
                "doc_id": keys.take(pa.array(doc)),
                "start": pa.array(lo - begins[doc] + starts[doc]),
                "length": pa.array(hi - lo),
                "ids_crc32": pa.array(np.array(crc, np.int64)),
                "doc_tokens": pa.array(wholes[doc].astype(np.int64)),
                "local": pa.array(window + self.sequence),
                "offset": pa.array(lo - opening),
                "part": pa.array(np.full(len(lo), TaskContext.get().partitionId(), np.int32)),
            }
        )
        self.sequence += len(cuts)
        # What is left opens the next part.
        first = int(np.searchsorted(ends, stop, "right"))
        rest = per_doc[first:].copy()
        begun = starts[first:].copy()
        if len(rest):
            done = stop - begins[first]
            rest[0] -= done
            begun[0] += done
        self.ids, self.per_doc, self.starts, self.wholes = [ids[stop:]], [rest], [begun], [wholes[first:]]
        self.sentences, self.keys = [sentences[sentences > stop] - stop], [keys[first:]]
        self.held = len(ids) - stop
        return out


def pack(docs: DataFrame, vocabulary: str, plan: Plan = Plan()) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset; a row per piece.

    vocabulary: a file of the tokenizers library whose tokenizer drops white space; every executor
    has it. Null and empty texts are the end id alone. Repeated rows and ids are packed one by one.
    Only doc_id and text of the input are read."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream, tokens = Stream(plan), word_tokens(vocabulary)
        for batch in batches:
            for part in tx.chunks(batch):
                stream.add(part.column("doc_id"), *tokenize(part.column("text"), tokens))
                if stream.held >= plan.part_tokens:
                    yield stream.pack(False)
        if (last := stream.pack(True)) is not None:
            yield last

    schema = f"doc_id {id_type}, start long, length long, ids_crc32 long, doc_tokens long, local long, offset long, part int"
    slim = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    pieces = stored(slim.mapInArrow(run, schema), "packing")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = pieces.groupBy("part").agg((F.max("local") + 1).alias("_n"))
    # One row per input partition: whether that is few enough to be broadcast is measured at run time.
    starts = counts.select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return pieces.join(starts, "part").select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("_start") + F.col("local")).alias("sequence_id"), "offset"
    )
