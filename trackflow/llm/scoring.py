"""Language-model scores by prediction by partial matching.

The model is a trie of byte contexts of up to ORDER bytes, counted over all training texts. A byte is
predicted in the longest context known; if it has not been seen there, an escape leads to the next
shorter context, in which the bytes of the longer one are excluded. Escapes are estimated by method C:
a context with n occurrences and u different bytes escapes with u / (n + u). Below the empty context
all 257 symbols (the bytes and the text's end) that were not excluded are equally likely.

Every n-gram counts, however rare, so the model grows with the corpus and is nowhere whole. As the trie
does not change while it scores, a symbol's probability depends on its (ORDER + 1)-gram alone:

1. Texts are dealt into chunks. A chunk's distinct n-grams are sent, with their counts in its training
   texts, to buckets: all n-grams whose two bytes before the last one are the same meet in one bucket.
2. A bucket adds the counts up. What it holds are all contexts of two and more bytes that end alike, so
   it can build its part of the trie; shorter contexts (at most 257 + 257 ** 2 n-grams) are broadcast.
3. A bucket answers each chunk with the probabilities of the n-grams that it asked for.
4. A chunk's texts meet its answers and add them up.

Buckets are as many as the texts' bytes ask for, and a bucket's requests are dealt to several tasks when
there are many. Unigram word scores take the same way, with words as keys and counts as answers.
Keys and answers travel as sorted, compressed arrays.

As an n-gram is never more frequent than its suffix, the symbols of a context are always among those of
its suffix, as exclusion needs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from trackflow.llm import text as tx
from trackflow.llm.shared import stored

ORDER = 5
BITS = 9
END = 257  # symbols: 1 to 256 are bytes, 257 is the text's end, 0 stands before a text
ALPHABET = 257
GRAMS, WORDS, TEXTS = 0, 1, 2  # kinds of rows
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_END_WORD = np.uint64(0x51ED270B7A1F4C3D)  # hash of the end token


def lowered(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = tx.buffers(column)
    return _LOWER[data], offsets


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The (ORDER + 1)-gram that ends at each symbol of the texts, and bounds of the texts.

    The newest symbol is in the lowest bits. Each text is followed by its end."""
    n = len(offsets) - 1
    doc = np.arange(n)
    bounds = offsets + np.append(doc, n)
    symbols = np.full(len(data) + n, END, np.int64)
    where = np.ones(len(symbols), bool)
    where[bounds[1:] - 1] = False
    symbols[where] = data.astype(np.int64) + 1
    place = np.arange(len(symbols)) - np.repeat(bounds[:-1], np.diff(bounds))
    key = symbols.copy()
    for back in range(1, ORDER + 1):
        before = np.zeros(len(symbols), np.int64)
        before[back:] = symbols[:-back]
        before[place < back] = 0
        key |= before << (BITS * back)
    return key, bounds


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's words and its end token, and bounds of the texts."""
    words = tx.Words(data, offsets)
    n = len(offsets) - 1
    bounds = words.bounds + np.arange(n + 1)
    out = np.full(len(words.starts) + n, _END_WORD, np.uint64)
    where = np.ones(len(out), bool)
    where[bounds[1:] - 1] = False
    out[where] = words.hashes()
    return out, bounds


def pieces(data: np.ndarray, offsets: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """n-grams and word hashes of texts with their bounds; one long text comes in pieces of about size bytes.

    A piece ends after white space (a longer word stays whole) and sees the ORDER bytes before it; the
    text's end is in the last one."""
    if len(offsets) > 2 or len(data) <= 2 * size:
        yield *grams(data, offsets), *word_hashes(data, offsets)
        return
    lo = 0
    while lo < len(data):
        hi = min(lo + size, len(data))
        if hi < len(data):
            blank = np.flatnonzero(tx.blank(data[lo:hi]))
            while not len(blank) and hi < len(data):
                more = min(hi + size, len(data))
                blank = np.flatnonzero(tx.blank(data[hi:more])) + (hi - lo)
                hi = more
                # Of a long word's following piece only what belongs to the word is taken.
                blank = blank[:1]
            hi = lo + int(blank[-1]) + 1 if len(blank) else len(data)
        last = hi == len(data)
        before = min(lo, ORDER)
        keys, _ = grams(data[lo - before : hi], np.array([0, hi - lo + before]))
        hashed, _ = word_hashes(data[lo:hi], np.array([0, hi - lo]))
        keys, hashed = (keys[before:], hashed) if last else (keys[before:-1], hashed[:-1])
        yield keys, np.array([0, len(keys)]), hashed, np.array([0, len(hashed)])
        lo = hi


@dataclass(frozen=True)
class Sizes:
    """What a task holds at once. Results do not depend on it."""

    bucket_bytes: int = 1 << 25  # of all texts, for each bucket; there are no fewer than shuffle partitions
    salt_bytes: int = 1 << 38  # of all texts, for each task that serves a bucket
    chunk_bytes: int = 1 << 26
    chunk_keys: int = 1_500_000
    row_keys: int = 1 << 20
    piece_bytes: int = 1 << 20  # of a long text


class Counts:
    """Counts of keys, merged now and then so that memory stays bounded."""

    def __init__(self, most: int = 3_000_000) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.held, self.most = 0, most

    def add(self, keys: np.ndarray, counted: np.ndarray) -> None:
        """Occurrences of keys; those that are not counted make a key known with a count of 0."""
        self.add_counts(*np.unique(keys[counted], return_counts=True))
        rest = np.unique(keys[~counted])
        self.add_counts(rest, np.zeros(len(rest), np.int64))

    def add_counts(self, keys: np.ndarray, n: np.ndarray) -> None:
        """Counts of distinct keys in ascending order."""
        if len(keys):
            self.parts.append((keys, n))
            self.held += len(keys)
        if self.held > self.most:
            self.merge()
            # A large table is not merged again before it has doubled.
            self.most = max(self.most, 2 * self.held)

    def merge(self) -> None:
        if len(self.parts) > 1:
            keys, n = (np.concatenate(x) for x in zip(*self.parts, strict=True))
            self.parts = [_sums(keys, n)]
        self.held = sum(len(k) for k, _ in self.parts)

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        self.merge()
        out = self.parts[0] if self.parts else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        self.parts, self.held = [], 0
        return out


def pack(values: np.ndarray) -> bytes:
    """A compressed array of 8-byte values, their bytes in planes."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def rounded(values: np.ndarray) -> np.ndarray:
    """Doubles to 29 significant bits, which pack into less."""
    return ((values.view(np.int64) + (1 << 23)) & -(1 << 24)).view(np.float64)


def unpack(packed: pa.Scalar, kind: type = np.int64) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed.as_py()), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def pack_keys(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=np.int64(0)))


def unpack_keys(packed: pa.Scalar) -> np.ndarray:
    return np.cumsum(unpack(packed))


def bucket_of(kind: int, keys: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each key; n-grams of one two-byte context lie together."""
    named = (keys >> BITS) & ((1 << (2 * BITS)) - 1) if kind == GRAMS else keys
    return (tx.mix(named.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def requests(docs: DataFrame, buckets: int, sizes: Sizes) -> DataFrame:
    """Per chunk and bucket the distinct keys and their training counts; and the texts to score.

    docs: doc_id, text, train, scored. Rows: chunk, kind, bucket, keys, counts, doc_id, text."""
    id_field = docs.schema["doc_id"]
    schema = StructType.fromDDL("chunk long, kind int, bucket long, keys binary, counts binary")
    schema = schema.add("doc_id", id_field.dataType).add("text", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, size = TaskContext.get().partitionId() << 32, 0
        tables = (Counts(2 * sizes.chunk_keys), Counts(2 * sizes.chunk_keys))
        id_type = None

        def sent() -> Iterator[pa.RecordBatch]:
            for kind, table in enumerate(tables):
                keys, n = table.take()
                home = bucket_of(kind, keys, buckets)
                order = np.argsort(home, kind="stable")
                keys, n, home = keys[order], n[order], home[order]
                names, cuts = np.unique(home, return_index=True)
                spans = list(zip(cuts.tolist(), [*cuts[1:].tolist(), len(home)], strict=True))
                for lo in range(0, len(spans), 1000):
                    some = spans[lo : lo + 1000]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "chunk": pa.array([chunk] * len(some)),
                            "kind": pa.array([kind] * len(some), pa.int32()),
                            "bucket": pa.array(names[lo : lo + 1000]),
                            "keys": pa.array([pack_keys(keys[a:b]) for a, b in some], pa.binary()),
                            "counts": pa.array([pack(n[a:b]) for a, b in some], pa.binary()),
                            "doc_id": pa.nulls(len(some), id_type),
                            "text": pa.nulls(len(some), pa.string()),
                        }
                    )

        for batch in batches:
            for part in tx.chunks(batch):
                id_type = part.column("doc_id").type
                data, offsets = lowered(part.column("text"))
                train = part.column("train").to_numpy(zero_copy_only=False).astype(bool)
                for keys, bounds, hashed, word_bounds in pieces(data, offsets, sizes.piece_bytes):
                    tables[GRAMS].add(keys, np.repeat(train, np.diff(bounds)))
                    tables[WORDS].add(hashed.view(np.int64), np.repeat(train, np.diff(word_bounds)))
                wanted = part.filter(part.column("scored"))
                n = wanted.num_rows
                yield pa.RecordBatch.from_pydict(
                    {
                        "chunk": pa.array(np.full(n, chunk)),
                        "kind": pa.array(np.full(n, TEXTS, np.int32)),
                        "bucket": pa.nulls(n, pa.int64()),
                        "keys": pa.nulls(n, pa.binary()),
                        "counts": pa.nulls(n, pa.binary()),
                        "doc_id": wanted.column("doc_id"),
                        "text": wanted.column("text"),
                    }
                )
                size += len(data)
                if size > sizes.chunk_bytes or max(t.held for t in tables) > 2 * sizes.chunk_keys:
                    yield from sent()
                    chunk, size = chunk + 1, 0
        if size or any(t.held for t in tables):
            yield from sent()

    return docs.select("doc_id", "text", "train", "scored").mapInArrow(run, schema)


def added(parts: DataFrame, by: list[str], tasks: int, sizes: Sizes) -> DataFrame:
    """Training counts of parts added up per group of by: its columns, keys, counts, total, distinct.

    A group may have several rows, of different keys."""
    schema = StructType([parts.schema[c] for c in by]).add("keys", "binary").add("counts", "binary")
    schema = schema.add("total", "long").add("distinct", "long")
    arrow = pa.schema([(c, pa.int32() if c == "kind" else pa.int64()) for c in by])
    for name, kind in (("keys", pa.binary()), ("counts", pa.binary()), ("total", pa.int64()), ("distinct", pa.int64())):
        arrow = arrow.append(pa.field(name, kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, table = None, Counts()

        def done() -> Iterator[pa.RecordBatch]:
            keys, n = table.take()
            keys, n = keys[n > 0], n[n > 0]
            for lo in range(0, len(keys), sizes.row_keys):
                at = slice(lo, lo + sizes.row_keys)
                row = dict(zip(by, group, strict=True)) | {"keys": pack_keys(keys[at]), "counts": pack(n[at])}
                row |= {"total": int(n[at].sum()), "distinct": len(n[at])}
                yield pa.RecordBatch.from_pylist([row], arrow)

        for batch in batches:
            names = zip(*(batch.column(c).to_pylist() for c in by), strict=True)
            for i, name in enumerate(names):
                if name != group:
                    if group is not None:
                        yield from done()
                    group, table = name, Counts()
                table.add_counts(unpack_keys(batch.column("keys")[i]), unpack(batch.column("counts")[i]))
        if group is not None:
            yield from done()

    return parts.select(*by, "keys", "counts").repartition(tasks, *by).sortWithinPartitions(*by).mapInArrow(run, schema)


class Table:
    """A hash table of 64-bit keys to row numbers, filled once, looked up for whole arrays."""

    def __init__(self, keys: np.ndarray) -> None:
        bits = max(4, int(2 * len(keys)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.mask = np.int64((1 << bits) - 1)
        self.keys = np.full(1 << bits, -1, np.int64)
        self.rows = np.zeros(1 << bits, np.int32)
        left = np.arange(len(keys))
        slot = self._home(keys)
        while len(left):
            free = self.keys[slot] == -1
            # Of several keys for a free slot the last written stays.
            self.rows[slot[free]] = left[free]
            self.keys[slot[free]] = keys[left[free]]
            lost = self.keys[slot] != keys[left]
            left, slot = left[lost], (slot[lost] + 1) & self.mask

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key, -1 if it is not there."""
        slot = self._home(keys)
        held = self.keys[slot]
        out = np.where(held == keys, self.rows[slot], np.int32(-1))
        on = np.flatnonzero((held != keys) & (held != -1))
        slot = slot[on]
        while len(on):
            slot = (slot + 1) & self.mask
            held = self.keys[slot]
            hit = held == keys[on]
            out[on[hit]] = self.rows[slot[hit]]
            more = ~hit & (held != -1)
            on, slot = on[more], slot[more]
        return out


@dataclass(frozen=True)
class Trie:
    """Per length of n-gram: its keys, counts and direct log10 probabilities; per length of context:
    its keys, and logs of the escape, of the escape after exclusion one level below, and of the
    total there."""

    gram_keys: list[np.ndarray]
    gram_counts: list[np.ndarray]
    gram_logs: list[np.ndarray]
    context_keys: list[np.ndarray]
    escape: list[np.ndarray]
    passed_escape: list[np.ndarray]
    passed_total: list[np.ndarray]
    nothing: float


def _sums(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    cuts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[cuts], (np.add.reduceat(values, cuts) if len(cuts) else values[:0])


def build(lengths: dict[int, tuple[np.ndarray, np.ndarray]]) -> Trie:
    """The trie of n-gram counts {length: (keys, counts)}.

    n-grams of some lengths may be fewer than all: of contexts with a certain end. Then contexts with
    other ends are not asked for."""
    empty = (np.zeros(0, np.int64), np.zeros(0, np.int64))
    gram_keys, gram_counts, gram_logs = [], [], []
    context_keys, escape, passed_escape, passed_total = [], [], [], []
    below: tuple[np.ndarray, ...] | None = None  # keys, totals, kinds of the shorter contexts
    for k in range(ORDER + 1):
        keys, counts = lengths.get(k + 1, empty)
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order].astype(np.float64)
        context = keys >> BITS
        names, totals = _sums(context, counts)
        _, kinds = _sums(context, np.ones(len(keys)))
        row = np.searchsorted(names, context)
        gram_keys.append(keys)
        gram_counts.append(counts)
        gram_logs.append(np.log10(counts / (totals + kinds)[row]))
        context_keys.append(names)
        escape.append(np.log10(kinds / (totals + kinds)))
        if below is None:
            left = max(ALPHABET - (int(kinds[0]) if len(kinds) else 0), 1)
            passed_escape.append(np.zeros(len(names)))
            passed_total.append(np.full(len(names), np.log10(left)))
        else:
            # What the shorter context has besides the symbols of this one.
            up = np.searchsorted(below[0], names & ((1 << (BITS * (k - 1))) - 1))
            shorter = np.searchsorted(gram_keys[k - 1], keys & ((1 << (BITS * k)) - 1))
            _, excluded = _sums(context, gram_counts[k - 1][shorter])
            others = below[2][up] - kinds
            total = np.maximum(below[1][up] - excluded, 0.0) + others
            with np.errstate(divide="ignore", invalid="ignore"):
                passed_escape.append(np.where(total > 0, np.log10(others / total), 0.0))
                passed_total.append(np.where(total > 0, np.log10(total), 0.0))
        below = (names, totals, kinds)
    return Trie(
        gram_keys, gram_counts, gram_logs, context_keys, escape, passed_escape, passed_total, float(np.log10(ALPHABET))
    )


class Scorer:
    """log10 probabilities of symbols after their contexts."""

    def __init__(self, trie: Trie) -> None:
        self.trie = trie
        self.grams = [Table(k) for k in trie.gram_keys]
        self.contexts = [Table(k) for k in trie.context_keys]
        self.logs = [np.log10(c) if len(c) else c for c in trie.gram_counts]

    def symbols(self, keys: np.ndarray) -> np.ndarray:
        trie = self.trie
        out = np.zeros(len(keys))
        on = np.arange(len(keys))  # symbols still to be found
        held = np.full(len(keys), -1, np.int32)  # the longer context that has excluded its symbols
        for k in range(ORDER, -1, -1):
            own = keys[on] & ((1 << (BITS * (k + 1))) - 1)
            row = self.grams[k].find(own)
            hit = row >= 0
            fresh = hit & (held < 0)
            out[on[fresh]] += trie.gram_logs[k][row[fresh]]
            passed = hit & (held >= 0)
            if passed.any():
                total = trie.passed_total[k + 1][held[passed]]
                out[on[passed]] += self.logs[k][row[passed]] - total
            miss = ~hit
            on, held, own = on[miss], held[miss], own[miss]
            if not len(on):
                return out
            context = self.contexts[k].find(own >> BITS)
            first = (held < 0) & (context >= 0)
            out[on[first]] += trie.escape[k][context[first]]
            later = held >= 0
            if later.any():
                out[on[later]] += trie.passed_escape[k + 1][held[later]]
            held = context
        seen = held >= 0
        out[on[seen]] -= trie.passed_total[0][held[seen]]
        out[on[~seen]] -= trie.nothing
        return out


@dataclass(frozen=True)
class Facts:
    """What all buckets share."""

    short: dict[int, tuple[np.ndarray, np.ndarray]]  # n-grams of one and of two symbols
    tokens: int
    vocabulary: int


def facts(counts: DataFrame) -> Facts:
    sums = counts.groupBy("kind").agg(F.sum("total").alias("n"), F.sum("distinct").alias("v")).collect()
    words = next((r for r in sums if r.kind == WORDS), None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                pairs, n = _sums(unpack_keys(batch.column("keys")[i]) & _mask(2), unpack(batch.column("counts")[i]))
                yield pa.RecordBatch.from_pydict({"key": pa.array(pairs), "n": pa.array(n)})

    pairs = counts.where(F.col("kind") == GRAMS).select("keys", "counts").mapInArrow(run, "key long, n long")
    found = pairs.groupBy("key").agg(F.sum("n").alias("n")).toArrow()
    two = _sums(found["key"].to_numpy(), found["n"].to_numpy())
    return Facts({1: _sums(two[0] & _mask(1), two[1]), 2: two}, words.n if words else 0, words.v if words else 0)


def _mask(length: int) -> int:
    return (1 << (BITS * length)) - 1


class Bucket:
    """A bucket's counts, and its answers."""

    def __init__(self, kind: int, short: dict[int, tuple[np.ndarray, np.ndarray]]) -> None:
        self.kind, self.short = kind, short
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.made: Scorer | Table | None = None
        self.counts = np.zeros(0)

    def answer(self, keys: np.ndarray) -> np.ndarray:
        """log10 probabilities of n-grams, counts of words."""
        if self.made is None:
            empty = np.zeros(0, np.int64)
            known, n = (np.concatenate(x) for x in zip((empty, empty), *self.parts, strict=True))
            self.parts = []
            if self.kind == WORDS:
                self.made, self.counts = Table(known), np.append(n, 0).astype(np.float64)
            else:
                lengths = dict(self.short)
                lengths[ORDER + 1] = _sums(known, n)
                for length in range(ORDER, 2, -1):
                    longer, n = lengths[length + 1]
                    lengths[length] = _sums(longer & _mask(length), n)
                self.made = Scorer(build(lengths))
        if isinstance(self.made, Scorer):
            return self.made.symbols(keys)
        return self.counts[self.made.find(keys)]


def answers(parts: DataFrame, counts: DataFrame, shared: Facts, salts: int, tasks: int) -> DataFrame:
    """(chunk, kind, keys, answers) for the keys that chunks ask for."""
    by = ["kind", "bucket", "salt"]
    asked = parts.select(*by, F.lit(1).alias("phase"), "chunk", "keys", F.lit(None).cast("binary").alias("counts"))
    salt = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).alias("salt")
    known = counts.select("kind", "bucket", salt, F.lit(0).alias("phase"), F.lit(None).cast("long").alias("chunk"), "keys", "counts")
    short = parts.sparkSession.sparkContext.broadcast(shared.short)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, bucket = None, None
        for batch in batches:
            keys, counts = batch.column("keys"), batch.column("counts")
            names = zip(*(batch.column(c).to_pylist() for c in [*by, "phase", "chunk"]), strict=True)
            for i, (*name, phase, chunk) in enumerate(names):
                if name != group:
                    group, bucket = name, Bucket(name[0], short.value)
                if phase == 0:
                    bucket.parts.append((unpack_keys(keys[i]), unpack(counts[i])))
                else:
                    row = [chunk], [name[0]], [keys[i].as_py()], [pack(rounded(bucket.answer(unpack_keys(keys[i]))))]
                    kinds = pa.int64(), pa.int32(), pa.binary(), pa.binary()
                    columns = [pa.array(x, t) for x, t in zip(row, kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, names=["chunk", "kind", "keys", "answers"])

    dealt = asked.unionByName(known).repartition(tasks, *by).sortWithinPartitions(*by, "phase")
    return dealt.mapInArrow(run, "chunk long, kind int, keys binary, answers binary")


class Answers:
    """What a chunk's keys got."""

    def __init__(self, parts: list[tuple[np.ndarray, np.ndarray]]) -> None:
        keys, values = (np.concatenate(x) for x in zip(*parts, strict=True))
        self.table, self.values = Table(keys), values

    def __getitem__(self, keys: np.ndarray) -> np.ndarray:
        return self.values[self.table.find(keys)]


def summed(texts: DataFrame, replies: DataFrame, shared: Facts, tasks: int, sizes: Sizes) -> DataFrame:
    """The scores of the texts of each chunk, from the answers that it got."""
    tokens = shared.tokens
    floor = tokens + 0.5 * (shared.vocabulary + 1)
    left = texts.select("chunk", "kind", "doc_id", "text")
    both = left.unionByName(replies, allowMissingColumns=True)
    # Chunks are numbered within the partitions that they come from; tasks get them in turn.
    turn = F.pmod(F.shiftright("chunk", 32) + F.col("chunk").bitwiseAND((1 << 32) - 1) * 31, F.lit(tasks)).cast("int")
    both = both.repartitionById(tasks, turn).sortWithinPartitions("chunk", "kind")
    schema = StructType([texts.schema["doc_id"]])
    for name, kind in (("n_tokens", "long"), ("n_known", "long"), ("train_tokens", "long"), ("base_score", "double")):
        schema = schema.add(name, kind)
    schema = schema.add("score", "double").add("n_symbols", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: int | None = None
        parts: tuple[list, list] = ([], [])
        tables: list[Answers] = []
        for batch in batches:
            chunk, kind = (batch.column(c).to_numpy() for c in ("chunk", "kind"))
            changes = np.flatnonzero((chunk[1:] != chunk[:-1]) | (kind[1:] != kind[:-1])) + 1
            for a, b in zip([0, *changes.tolist()], [*changes.tolist(), batch.num_rows], strict=True):
                if chunk[a] != now:
                    now, parts, tables = chunk[a], ([], []), []
                if kind[a] != TEXTS:
                    for i in range(a, b):
                        keys, values = unpack_keys(batch.column("keys")[i]), unpack(batch.column("answers")[i], np.float64)
                        parts[kind[a]].append((keys, values))
                    continue
                if not tables:
                    tables, parts = [Answers(p) for p in parts], ([], [])
                for part in tx.chunks(batch.slice(a, b - a)):
                    data, offsets = lowered(part.column("text"))
                    found = np.zeros((5, part.num_rows))
                    for keys, bounds, hashed, word_bounds in pieces(data, offsets, sizes.piece_bytes):
                        n = tables[WORDS][hashed.view(np.int64)]
                        found[0] += np.diff(word_bounds)
                        found[1] += tx.totals(n > 0, word_bounds)
                        found[2] += tx.totals(np.log10((n + 0.5) / floor), word_bounds)
                        found[3] += tx.totals(tables[GRAMS][keys], bounds)
                        found[4] += np.diff(bounds)
                    whole = found.astype(np.int64)
                    yield pa.RecordBatch.from_pydict(
                        {
                            "doc_id": part.column("doc_id"),
                            "n_tokens": pa.array(whole[0]),
                            "n_known": pa.array(whole[1]),
                            "train_tokens": pa.array(np.full(part.num_rows, tokens)),
                            "base_score": pa.array(found[2]),
                            "score": pa.array(found[3]),
                            "n_symbols": pa.array(whole[4]),
                        }
                    )

    return both.mapInArrow(run, schema)


def score_marked(docs: DataFrame, sizes: Sizes = Sizes()) -> DataFrame:
    """As score, for one table: docs has doc_id, text, train and scored (booleans)."""
    size = docs.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets, salts = max(least, -(-size // sizes.bucket_bytes)), max(1, -(-size // sizes.salt_bytes))
    rows = stored(requests(docs, buckets, sizes), "lm-requests")
    parts = rows.where(F.col("kind") != TEXTS).withColumn("salt", F.pmod(F.xxhash64("chunk"), F.lit(salts).cast("long")))
    counts = parts
    if salts > 1:
        counts = added(counts, ["kind", "bucket", "salt"], buckets * salts, sizes)
    counts = stored(added(counts, ["kind", "bucket"], buckets, sizes), "lm-counts")
    shared = facts(counts)
    found = answers(parts, counts, shared, salts, buckets * salts)
    return summed(rows.where(F.col("kind") == TEXTS), found, shared, max(least, -(-size // sizes.chunk_bytes)), sizes)


def score(docs: DataFrame, training: DataFrame, sizes: Sizes = Sizes()) -> DataFrame:
    """Per row of docs: doc_id, n_tokens, n_known, train_tokens, base_score, score, n_symbols.

    training has text. Texts are taken with A to Z in lower case; a null one is empty, that is its end
    alone. Repeated rows stay. Without training texts all symbols are equally likely and base_score is
    that of unknown words."""
    text = F.col("text").cast("string").alias("text")
    rows = docs.select("doc_id", text, F.lit(False).alias("train"), F.lit(True).alias("scored"))
    id_type = docs.schema["doc_id"].dataType
    no_id = F.lit(None).cast(id_type).alias("doc_id")
    learned = training.select(no_id, text, F.lit(True).alias("train"), F.lit(False).alias("scored"))
    return score_marked(rows.unionByName(learned), sizes)
