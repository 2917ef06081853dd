"""Words, lines and hashes of whole Arrow text columns, as numpy arrays over their bytes.

A batch is cut into chunks of a few megabytes, never inside a text, so that temporary arrays stay
small; a longer text is a chunk of its own."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n-1 of an odd base and of its inverse, modulo 2**64."""
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        for i, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


_held: dict[object, object] = {}


def held(key: object, make: Callable[[], object]) -> object:
    """What make gives, kept by a worker process until it is asked for something under another key.

    A worker serves many tasks, of several operators in turn; only the last one's tables stay."""
    if key not in _held:
        _held.clear()
        _held[key] = make()
    return _held[key]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column and its n+1 offsets; a null counts as empty."""
    column = column.cast(pa.large_string()) if column.type != pa.large_string() else column
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def lowered(column: pa.Array) -> pa.Array:
    """A text column in lower case. Bytes that are no UTF-8, which Spark lets pass, become U+FFFD first."""
    try:
        return pc.utf8_lower(column)
    except pa.ArrowInvalid:
        raw = column.cast(pa.large_binary()).to_pylist()
        return pc.utf8_lower(pa.array([b and b.decode("utf-8", "replace") for b in raw], pa.large_string()))


def pieces(column: pa.Array, limit: int = CHUNK_BYTES, words: bool = True) -> Iterator[pa.Array]:
    """The column, or, if it is one long text, columns of one piece of it each, of about limit bytes.

    A text is cut behind white space, so that a longer word is a piece of its own, or else (not words)
    before any character."""
    data, _ = buffers(column)
    if len(column) != 1 or len(data) <= 2 * limit:
        yield column
        return
    lo = 0
    while lo < len(data):
        hi = _cut(data, lo, limit, words)
        bounds = pa.py_buffer(np.array([0, hi - lo], np.int64))
        yield pa.Array.from_buffers(pa.large_string(), 1, [None, bounds, pa.py_buffer(data[lo:hi])])
        lo = hi


def _cut(data: np.ndarray, lo: int, limit: int, words: bool) -> int:
    """The end of the piece that begins at lo."""
    hi = lo + limit
    if hi >= len(data):
        return len(data)
    if not words:
        # Bytes of one character but the first are 10xxxxxx, at most three of them.
        return next((i for i in range(hi, hi - 4, -1) if data[i] & 0xC0 != 0x80), hi)
    spaces = np.flatnonzero(blank(data[lo:hi]))
    if len(spaces):
        return lo + int(spaces[-1]) + 1
    for at in range(hi, len(data), limit):
        spaces = np.flatnonzero(blank(data[at : at + limit]))
        if len(spaces):
            return at + int(spaces[0]) + 1
    return len(data)


def chunks(batch: pa.RecordBatch, column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about limit bytes of text, at least a row each."""
    _, offsets = buffers(batch.column(column))
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield batch.slice(lo, hi - lo)
        lo = hi


def blank(data: np.ndarray) -> np.ndarray:
    """Which bytes lie between words."""
    return _SPACE[data]


def totals(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of values between consecutive bounds; empty ranges are 0."""
    sums = np.zeros(len(values) + 1, np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=sums[1:])
    return sums[bounds[1:]] - sums[bounds[:-1]]


class Words:
    """Words `[^\\x20\\x09-\\x0D]+` of the texts in a chunk."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        self.data, self.offsets = data, offsets
        solid = np.zeros(len(data) + 1, bool)
        np.logical_not(_SPACE[data], out=solid[:-1])
        edges = np.zeros(len(data) + 1, bool)
        edges[offsets] = True
        before = np.zeros(len(data) + 1, bool)
        before[1:] = solid[:-1]
        self.solid = solid[:-1]
        self.starts = np.flatnonzero(solid & (~before | edges))
        self.ends = np.flatnonzero(before & (~solid | edges))
        self.bounds = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.bounds)
        self.doc = np.repeat(np.arange(len(offsets) - 1), self.counts)
        self._sums: np.ndarray | None = None

    def span_hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hash of the bytes of each span."""
        up, down = powers(len(self.data) + 1)
        if self._sums is None:
            self._sums = np.zeros(len(self.data) + 1, np.uint64)
            np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=self._sums[1:])
        h = (self._sums[ends] - self._sums[starts]) * down[starts]
        return mix(h ^ ((ends - starts).astype(np.uint64) << np.uint64(40)))

    def hashes(self) -> np.ndarray:
        return self.span_hash(self.starts, self.ends)

    def windows(self, hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the width words that begin at each word, and which of them lie in one text."""
        n = len(hashes)
        out = np.zeros(n, np.uint64)
        fits = np.zeros(n, bool)
        if n >= width:
            rolling = np.zeros(n - width + 1, np.uint64)
            for j in range(width):
                rolling = rolling * np.uint64(_BASE) + hashes[j : n - width + 1 + j]
            out[: n - width + 1] = mix(rolling)
            fits[: n - width + 1] = self.doc[: n - width + 1] == self.doc[width - 1 :]
        return out, fits


def group_hash(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """64-bit hash of the sequence of hashes between consecutive bounds."""
    up, down = powers(len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * up[:-1], out=sums[1:])
    h = (sums[bounds[1:]] - sums[bounds[:-1]]) * down[bounds[:-1]]
    return mix(h ^ (np.diff(bounds).astype(np.uint64) << np.uint64(40)))


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Consecutive values as a list column."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values).cast(kind))
