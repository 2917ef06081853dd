"""Quality rules: counts per document, and lines that many documents of a host share.

Lines are normalised (lower case, runs of white space as one space, trimmed) and hashed. A line is
counted once per distinct text of its host, so exact copies of a document do not make its lines
frequent. Lines found in more documents than the limit allows are removed, and a document that loses
more than a share of its words is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackflow.llm import text as tx
from trackflow.llm.shared import stored

SYMBOLS = "#*$%&|<>"
WINDOW = 5


@dataclass(frozen=True)
class Rules:
    """A line is frequent in more than max_docs documents of a host, however large that is; in a host that is
    so small that they are more than host_percent of it, already in more than min_docs."""

    max_docs: int = 30
    min_docs: int = 10
    host_percent: int = 1
    max_removed: float = 0.5
    min_words: int = 10
    max_repeat_percent: int = 20


def base_counts(data: np.ndarray, offsets: np.ndarray) -> tuple[tx.Words, dict[str, np.ndarray]]:
    """The base counts of each text."""
    words = tx.Words(data, offsets)
    symbols = np.zeros(256, bool)
    symbols[np.frombuffer(SYMBOLS.encode(), np.uint8)] = True
    points = words.solid & ((data & 0xC0) != 0x80)

    # Lines: where they begin, which text they are in, whether they have a word.
    starts = np.union1d(np.flatnonzero(data == 10) + 1, offsets[:-1][np.diff(offsets) > 0])
    starts = starts[starts < len(data)]
    ends = np.append(starts[1:], len(data))
    # A line ends before its line break, which the next text does not have.
    ends = ends - ((ends > starts) & (data[np.maximum(ends - 1, 0)] == 10)) if len(starts) else ends
    firsts = np.searchsorted(words.starts, np.append(starts, len(data)))
    full = np.diff(firsts) > 0
    doc = np.searchsorted(offsets, starts, "right") - 1
    doc = doc[full]
    hashed = words.span_hash(starts[full], ends[full])
    n_dup = np.zeros(len(offsets) - 1, np.int64)
    if len(doc):
        order = np.lexsort((hashed, doc))
        again = (doc[order][1:] == doc[order][:-1]) & (hashed[order][1:] == hashed[order][:-1])
        n_dup = np.bincount(doc[order][1:][again], minlength=len(n_dup))

    # Words inside windows that occur again in the same text.
    grams, fits = words.windows(words.hashes(), WINDOW)
    at = np.flatnonzero(fits)
    keys = grams[at] ^ tx.mix(words.doc[at].astype(np.uint64))
    order = np.argsort(keys)
    same = np.zeros(len(at) + 1, bool)
    if len(at):
        same[1:-1] = keys[order][1:] == keys[order][:-1]
    repeated = at[order[same[1:] | same[:-1]]]
    covered = np.zeros(len(words.starts) + 1, np.int32)
    np.add.at(covered, repeated, 1)
    np.subtract.at(covered, repeated + WINDOW, 1)
    inside = np.cumsum(covered[:-1]) > 0
    return words, {
        "n_words": words.counts.astype(np.int64),
        "word_chars": tx.totals(points, offsets),
        "n_symbols": tx.totals(symbols[data], offsets),
        "n_dup_lines": n_dup,
        "n_repeat_words": tx.totals(inside, words.bounds),
    }


def full_lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lines with a word of lower-cased texts: text, number within it, hash, words."""
    words = tx.Words(data, offsets)
    breaks = np.cumsum(data == 10)
    line = breaks[words.starts] + words.doc if len(words.starts) else np.zeros(0, np.int64)
    cuts = np.flatnonzero(np.diff(line, prepend=-1)) if len(line) else np.zeros(0, np.int64)
    bounds = np.append(cuts, len(line))
    doc = words.doc[cuts]
    # A line break itself counts to the lines before it.
    before = np.append(0, breaks)[offsets[:-1]] + np.arange(len(offsets) - 1)
    return doc, line[cuts] - before[doc], tx.group_hash(words.hashes(), bounds), np.diff(bounds)


def line_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text the distinct normalised lines: their number, hashes and words in all repeats."""
    doc, _, hashed, size = full_lines(data, offsets)
    order = np.lexsort((hashed, doc))
    doc, hashed, size = doc[order], hashed[order], size[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (hashed[1:] != hashed[:-1])
    firsts = np.append(np.flatnonzero(new), len(doc))
    n = np.bincount(doc[new], minlength=len(offsets) - 1)
    return n, hashed[new], tx.totals(size, firsts)


_MEASURED = (
    "row_id long, doc_id {id}, source string, text_key long, n_words long, word_chars long, n_symbols long,"
    " n_dup_lines long, n_repeat_words long, lines array<long>, line_words array<long>"
)


def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Base counts, a row number, a hash of the text and its normalised lines."""
    row = TaskContext.get().partitionId() << 36
    for batch in batches:
        for part in tx.chunks(batch):
            column = part.column("text")
            data, offsets = tx.buffers(column)
            words, base = base_counts(data, offsets)
            n, lines, sizes = line_hashes(*tx.buffers(pc.utf8_lower(column)))
            columns = {
                "row_id": pa.array(np.arange(row, row + part.num_rows)),
                "doc_id": part.column("doc_id"),
                "source": part.column("source"),
                "text_key": pa.array(words.span_hash(offsets[:-1], offsets[1:]).view(np.int64)),
                **{k: pa.array(v) for k, v in base.items()},
                "lines": tx.lists(lines.view(np.int64), n, pa.int64()),
                "line_words": tx.lists(sizes, n, pa.int64()),
            }
            row += part.num_rows
            yield pa.RecordBatch.from_pydict(columns)


def host() -> Column:
    return F.coalesce(F.concat(F.lit("="), "source"), F.lit("null"))


def frequent_lines(rows: DataFrame, rules: Rules) -> DataFrame:
    """(host, line) of the lines in more texts of their host than the limits; rows: row_id, host, text_key, lines."""
    # One row for each distinct text of a host.
    texts = rows.groupBy("host", "text_key").agg(F.min("row_id").alias("row_id"))
    counted = rows.select("row_id", "lines").join(texts, "row_id").select("host", F.explode("lines").alias("line"))
    counted = counted.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n_docs"))
    counted = counted.where(F.col("n_docs") > min(rules.min_docs, rules.max_docs))
    hosts = texts.groupBy("host").agg(F.count(F.lit(1)).alias("host_docs"))
    in_small = (F.col("n_docs") > rules.min_docs) & (100 * F.col("n_docs") > rules.host_percent * F.col("host_docs"))
    return counted.join(hosts, "host").where((F.col("n_docs") > rules.max_docs) | in_small).select("host", "line")


def lines_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines of texts that have a row number, without other counts."""
    for batch in batches:
        for part in tx.chunks(batch):
            data, offsets = tx.buffers(part.column("text"))
            n, lines, _ = line_hashes(*tx.buffers(pc.utf8_lower(part.column("text"))))
            keys = tx.Words(data, offsets).span_hash(offsets[:-1], offsets[1:])
            yield pa.RecordBatch.from_pydict(
                {
                    "row_id": part.column("row_id"),
                    "host": part.column("host"),
                    "text_key": pa.array(keys.view(np.int64)),
                    "lines": tx.lists(lines.view(np.int64), n, pa.int64()),
                }
            )


def without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the lines whose hashes come with them."""
    for batch in batches:
        for part in tx.chunks(batch):
            doc, number, hashed, _ = full_lines(*tx.buffers(pc.utf8_lower(part.column("text"))))
            bounds = np.searchsorted(doc, np.arange(part.num_rows + 1))
            texts = []
            for i, (text, cut) in enumerate(zip(part.column("text").to_pylist(), part.column("cut").to_pylist(), strict=True)):
                own = slice(bounds[i], bounds[i + 1])
                gone = set(number[own][np.isin(hashed[own].view(np.int64), cut)].tolist())
                texts.append("\n".join(x for k, x in enumerate(text.split("\n")) if k not in gone))
            yield pa.RecordBatch.from_pydict({"row_id": part.column("row_id"), "clean": pa.array(texts, pa.string())})


def strip(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The rows of docs, all columns, with the frequent lines of their host taken out of the text.

    Lines without a word stay, as do null texts; a text of frequent lines alone becomes empty. Only texts
    with such lines are written anew."""
    whole = docs.select(F.struct("*").alias("row"), host().alias("host"), F.col("text").cast("string").alias("text"))
    # Row numbers are fixed by being written.
    whole = stored(whole.withColumn("row_id", F.monotonically_increasing_id()), "quality-texts")
    schema = "row_id long, host string, text_key long, lines array<long>"
    rows = stored(whole.select("row_id", "host", "text").mapInArrow(lines_of, schema), "quality-lines")
    spread = rows.select("row_id", "host", F.explode("lines").alias("line"))
    hits = spread.join(frequent_lines(rows, rules), ["host", "line"], "left_semi")
    hits = hits.groupBy("row_id").agg(F.collect_list("line").alias("cut"))
    clean = whole.select("row_id", "text").join(hits, "row_id").mapInArrow(without, "row_id long, clean string")
    out = whole.join(clean, "row_id", "left")
    return out.select(F.col("row").withField("text", F.coalesce("clean", "row.text")).alias("row")).select("row.*")


def judge(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """doc_id, the base counts, base_failed, removed_words, kept; a row per input row.

    Nulls: a null text is empty and fails the base rules, null sources are one host. Repeated rows
    are judged one by one. Columns of the input besides doc_id, source and text are not carried."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    slim = docs.select("doc_id", F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text"))
    rows = stored(slim.mapInArrow(measure, _MEASURED.format(id=id_type)), "quality-rows")
    rows = rows.withColumn("host", host())
    frequent = frequent_lines(rows, rules)

    pairs = F.explode(F.arrays_zip("lines", "line_words"))
    spread = rows.select("row_id", "host", pairs.alias("p")).select(
        "row_id", "host", F.col("p.lines").alias("line"), F.col("p.line_words").alias("words")
    )
    removed = spread.join(frequent, ["host", "line"], "left_semi")
    removed = removed.groupBy("row_id").agg(F.sum("words").alias("removed_words"))

    failed = (F.col("n_words") < rules.min_words) | (
        100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words")
    )
    out = rows.drop("lines", "line_words").join(removed, "row_id", "left")
    lost = F.coalesce(F.col("removed_words"), F.lit(0))
    return out.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        lost.alias("removed_words"),
        (~failed & (lost <= rules.max_removed * F.col("n_words"))).alias("kept"),
    )
