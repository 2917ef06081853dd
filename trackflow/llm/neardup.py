"""Near duplicates by DartMinHash signatures.

A text is a weighted set: its shingles of five words with their counts. Each unit of weight of an
element is a strip on which a hash throws darts, a Poisson process along the strip. A text of weight w
sees the darts up to a height of t / w, about t = k ln k + 2 k of them whatever its size, each of which
falls on one of k coordinates. The earliest dart of a coordinate is the signature there; two texts
agree in it with the probability of their weighted Jaccard similarity. Texts with an empty coordinate
look twice as high.

Signatures are joined in bands. In a bucket every text is compared with leaders first. Where the
share of equal coordinates is several standard errors away from the limit it decides; in between, the
similarity is computed exactly, from the strips of both texts. First every text meets one leader, the
first in a common order of all that lead its buckets; then texts of a bucket that are still in
different classes meet the leaders of two orders drawn per bucket. At last all pairs of texts that share
a bucket and are still in different classes are compared, block by block. Classes are the connected
components of the links. Equal texts are one node from the start.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackflow.llm import text as tx
from trackflow.llm.components import components, forest_roots
from trackflow.llm.shared import stored


@dataclass(frozen=True)
class Plan:
    """Two texts with similarity s share a bucket with probability 1 - (1 - s**rows)**bands."""

    width: int = 5
    similarity: float = 0.8
    bands: int = 24
    rows: int = 6
    errors: float = 3.5  # standard errors from the limit beyond which signatures decide
    block: int = 256  # texts of a block, whose pairs with another block one task compares

    @property
    def coordinates(self) -> int:
        return self.bands * self.rows

    @property
    def margin(self) -> float:
        return self.errors * math.sqrt(self.similarity * (1 - self.similarity) / self.coordinates)


_STEP = np.uint64(0xD1B54A32D192ED03)
_UNIT = 1.0 / (1 << 53)


def strips(words: tx.Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Strip hashes of each text, one text after another, and bounds.

    A text of fewer than `width` words is one shingle, one without words has none."""
    hashed = words.hashes()
    shingles, fits = words.windows(hashed, width)
    short = np.flatnonzero((words.counts > 0) & (words.counts < width))
    whole = tx.group_hash(hashed, words.bounds)[short]
    keys = np.concatenate((shingles[fits], whole))
    doc = np.concatenate((words.doc[fits], short))
    order = np.lexsort((keys, doc))
    keys, doc = keys[order], doc[order]
    # The how-manieth equal shingle of its text each one is.
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (doc[1:] != doc[:-1])
    at = np.arange(len(keys))
    copy = at - np.maximum.accumulate(np.where(new, at, 0))
    keys = np.where(copy > 0, tx.mix(keys + copy.astype(np.uint64) * _STEP), keys)
    return keys, np.searchsorted(doc, np.arange(len(words.counts) + 1))


def signatures(keys: np.ndarray, bounds: np.ndarray, k: int) -> np.ndarray:
    """Signature matrix of the texts; rows of texts without strips are 0."""
    weight = np.diff(bounds)
    out = np.zeros((len(weight), k), np.uint64)
    height = (k * math.log(k) + 2 * k) / np.maximum(weight, 1)
    todo = np.flatnonzero(weight)
    while len(todo):
        # Darts of the texts still to be done, by their number on the strip.
        index = np.concatenate([np.arange(bounds[d], bounds[d + 1]) for d in todo]) if len(todo) < len(weight) else np.arange(len(keys))
        row = np.repeat(np.arange(len(todo)), weight[todo])
        strip, limit, level, throw = keys[index], height[todo][row], np.zeros(len(index)), 0
        first = np.full(len(todo) * k, np.inf)
        cells, levels, darts = [], [], []
        while len(strip):
            throw += 1
            dart = tx.mix(strip + np.uint64(throw * int(_STEP) & 0xFFFFFFFFFFFFFFFF))
            level = level - np.log(((dart >> np.uint64(11)).astype(np.float64) + 0.5) * _UNIT)
            seen = level <= limit
            strip, limit, level, row, dart = strip[seen], limit[seen], level[seen], row[seen], dart[seen]
            name = tx.mix(dart ^ _STEP)
            cell = row * k + (name % np.uint64(k)).astype(np.int64)
            np.minimum.at(first, cell, level)
            cells.append(cell)
            levels.append(level)
            darts.append(name)
        cell, level, dart = np.concatenate(cells), np.concatenate(levels), np.concatenate(darts)
        won = level == first[cell]
        found = np.zeros(len(todo) * k, np.uint64)
        found[cell[won]] = dart[won]
        out[todo] = found.reshape(-1, k)
        empty = np.isinf(first).reshape(-1, k).any(axis=1)
        todo = todo[empty]
        height[todo] *= 2
    return out


def band_keys(signature: np.ndarray, plan: Plan) -> np.ndarray:
    """One key per text and band; keys of different bands differ."""
    parts = signature.reshape(len(signature), plan.bands, plan.rows)
    keys = np.broadcast_to(np.arange(1, plan.bands + 1, dtype=np.uint64) * _STEP, parts.shape[:2]).copy()
    for i in range(plan.rows):
        keys = tx.mix(keys ^ parts[:, :, i]) + np.uint64(i)
    return keys


def _slim(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("text_hash"))


def sign(docs: DataFrame, plan: Plan) -> DataFrame:
    """row_id, doc_id, text_hash, node (a hash of the lower-case words), bands, signature (2 bytes each)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 36
        for batch in batches:
            for part in tx.chunks(batch):
                words = tx.Words(*tx.buffers(tx.lowered(part.column("text"))))
                keys, bounds = strips(words, plan.width)
                signature = signatures(keys, bounds, plan.coordinates)
                full = np.diff(bounds) > 0
                low = signature.astype(np.uint16)
                yield pa.RecordBatch.from_pydict(
                    {
                        "row_id": pa.array(np.arange(row, row + part.num_rows)),
                        "doc_id": part.column("doc_id"),
                        "text_hash": part.column("text_hash"),
                        "node": pa.array(tx.group_hash(words.hashes(), words.bounds).view(np.int64)),
                        "bands": tx.lists(
                            band_keys(signature, plan)[full].ravel().view(np.int64), np.where(full, plan.bands, 0), pa.int64()
                        ),
                        "signature": pa.array([x.tobytes() for x in low], pa.binary()),
                    }
                )
                row += part.num_rows

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return _slim(docs).mapInArrow(
        run, f"row_id long, doc_id {id_type}, text_hash long, node long, bands array<long>, signature binary"
    )


def strip_sets(texts: DataFrame, plan: Plan) -> DataFrame:
    """(node, strips): the strips of (node, text) rows as sorted 4-byte numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tx.chunks(batch):
                words = tx.Words(*tx.buffers(tx.lowered(part.column("text"))))
                keys, bounds = strips(words, plan.width)
                low = keys.astype(np.uint32)
                raw = [np.unique(low[a:b]).tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                yield pa.RecordBatch.from_pydict({"node": part.column("node"), "strips": pa.array(raw, pa.binary())})

    return texts.select("node", "text").mapInArrow(run, "node long, strips binary")


def agreement(a: pd.Series, b: pd.Series) -> pd.Series:
    """Share of equal coordinates of two signatures."""
    both = zip(a, b, strict=True)
    return pd.Series([float((np.frombuffer(x, np.uint16) == np.frombuffer(y, np.uint16)).mean()) for x, y in both], dtype="float64")


def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Weighted Jaccard similarity of two sets of strips."""
    out = []
    for x, y in zip(a, b, strict=True):
        x, y = np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32)
        common = len(np.intersect1d(x, y, assume_unique=True))
        out.append(common / max(len(x) + len(y) - common, 1))
    return pd.Series(out, dtype="float64")


def contents_of(docs: DataFrame, texts: DataFrame, need: DataFrame, plan: Plan, name: str) -> DataFrame:
    """(node, strips) of the nodes needed, stored."""
    need = texts.select("node", F.col("first.doc_id").alias("_id"), F.col("first.text_hash").alias("_hash")).join(need, "node")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    return stored(strip_sets(_slim(docs).join(need, same), plan).dropDuplicates(["node"]), f"{name}-strips")


def linked(docs: DataFrame, texts: DataFrame, pairs: DataFrame, plan: Plan, name: str) -> DataFrame:
    """Those of the pairs (a, b) of nodes that are similar enough, stored."""
    sketch = texts.select("node", "signature")
    both = pairs.join(sketch.toDF("a", "x"), "a").join(sketch.toDF("b", "y"), "b")
    judged = stored(both.select("a", "b", F.pandas_udf(agreement, "double")("x", "y").alias("s")), f"{name}-judged")
    sure, maybe = plan.similarity + plan.margin, plan.similarity - plan.margin
    clear = judged.where(F.col("s") >= sure).select("a", "b")
    unclear = judged.where((F.col("s") < sure) & (F.col("s") >= maybe)).select("a", "b")
    need = unclear.select("a").union(unclear.select("b")).distinct().withColumnRenamed("a", "node")
    contents = contents_of(docs, texts, need, plan, name)
    both = unclear.join(contents.toDF("a", "x"), "a").join(contents.toDF("b", "y"), "b")
    exact = both.where(F.pandas_udf(similarity, "double")("x", "y") >= plan.similarity).select("a", "b")
    return stored(clear.union(exact), f"{name}-links")


def cell_links(cell: pd.DataFrame, plan: Plan) -> list[tuple[int, int]]:
    """Links that join the classes of a cell: all pairs of its block i with its block j, or within the one block.

    A pair is compared in the first of the bands it shares only. Texts that links of this cell have
    joined already are not compared again."""
    sure, maybe = plan.similarity + plan.margin, plan.similarity - plan.margin
    node, block = cell["node"].to_numpy(), cell["block"].to_numpy()
    band, first_block = cell["band"].iloc[0], cell["i"].iloc[0]
    bands = np.stack(cell["bands"].to_numpy())
    sketch = np.stack([np.frombuffer(x, np.uint16) for x in cell["signature"]])
    strip = [np.frombuffer(x, np.uint32) for x in cell["strips"]]
    group = np.unique(cell["root"].to_numpy(), return_inverse=True)[1]
    within = first_block == cell["j"].iloc[0]
    place = int(np.flatnonzero(bands[0] == band)[0])
    out = []
    for a in np.flatnonzero(block == first_block):
        others = group != group[a]
        others &= (np.arange(len(node)) > a) if within else (block != first_block)
        at = np.flatnonzero(others)
        at = at[~(bands[at, :place] == bands[a, :place]).any(axis=1)]
        agree = (sketch[at] == sketch[a]).mean(axis=1)
        for b, s in zip(at[agree >= maybe], agree[agree >= maybe], strict=True):
            if group[a] == group[b]:
                continue
            if s < sure:
                common = len(np.intersect1d(strip[a], strip[b], assume_unique=True))
                if common < plan.similarity * max(len(strip[a]) + len(strip[b]) - common, 1):
                    continue
            out.append((node[a], node[b]))
            group[group == group[b]] = group[a]
    return out


def open_links(docs: DataFrame, texts: DataFrame, buckets: DataFrame, plan: Plan) -> DataFrame:
    """Links (a, b) between the classes of each bucket, of all pairs of its texts in different classes, stored.

    buckets: (band, node, root) of the buckets with several classes. Texts of a bucket's largest class meet
    the other texts only. Both sides are dealt into blocks, and each pair of blocks is a group of its own."""
    sizes = buckets.groupBy("band", "root").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.groupBy("band").agg(F.sum("n").alias("n"), F.max(F.struct("n", "root")).alias("top"))
    blocks = sizes.select(
        "band",
        F.col("top.root").alias("top"),
        F.ceil((F.col("n") - F.col("top.n")) / plan.block).alias("few"),
        F.ceil(F.col("top.n") / plan.block).alias("many"),
    )
    drawn = F.xxhash64("node", "band")
    dealt = buckets.join(blocks, "band").withColumn("is_top", F.col("root") == F.col("top"))
    dealt = dealt.withColumn(
        "block", F.when(F.col("is_top"), F.col("few") + F.pmod(drawn, "many")).otherwise(F.pmod(drawn, "few"))
    )
    last = F.when(F.col("is_top"), F.col("few")).otherwise(F.col("few") + F.col("many")) - 1
    dealt = dealt.select("band", "node", "root", "block", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("other"))
    cells = dealt.select(
        "band", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "root"
    )
    contents = contents_of(docs, texts, buckets.select("node").distinct(), plan, "third")
    cells = cells.join(texts.select("node", "bands", "signature"), "node").join(contents, "node")
    names = ["band", "i", "j", "block", "node", "root", "bands", "signature", "strips"]
    cells = cells.select(*names).repartition("band", "i", "j").sortWithinPartitions("band", "i", "j")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(frame: pd.DataFrame, cuts: np.ndarray) -> pa.RecordBatch:
            found = [x for a, b in zip(cuts[:-1], cuts[1:], strict=True) for x in cell_links(frame.iloc[a:b], plan)]
            ends = np.array(found, np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_pydict({"a": pa.array(ends[:, 0]), "b": pa.array(ends[:, 1])})

        held = pd.DataFrame(columns=names)  # the last cell, which may go on in the next batch
        for batch in batches:
            frame = batch.to_pandas()
            frame = pd.concat([held, frame], ignore_index=True) if len(held) else frame
            keys = frame[["band", "i", "j"]].to_numpy(np.int64)
            starts = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1))) if len(keys) else np.zeros(1, np.int64)
            yield links(frame, starts)
            held = frame.iloc[starts[-1] :]
        if len(held):
            yield links(held, np.array([0, len(held)]))

    return stored(cells.mapInArrow(run, "a long, b long"), "third-links")


def torn_buckets(shared: DataFrame, found: DataFrame, name: str) -> DataFrame:
    """(band, node, root) of the buckets whose texts are in several classes, stored."""
    named = shared.join(found, "node", "left").select("band", "node", F.coalesce("root", "node").alias("root"))
    named = stored(named, f"{name}-named")
    torn = named.groupBy("band").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi")
    return stored(named.join(torn.select("band"), "band"), f"{name}-torn")


def merged_classes(found: DataFrame, more: DataFrame) -> DataFrame:
    """(node, root) after links (a, b) between classes."""
    if more.isEmpty():
        return found
    # Classes that these links join, by their roots.
    ends = more.join(found.toDF("a", "ra"), "a", "left").join(found.toDF("b", "rb"), "b", "left")
    merged = components(ends.select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b")))
    lone = more.select("a").union(more.select("b")).distinct().toDF("node").join(found, "node", "left_anti")
    every = found.unionByName(lone.select("node", F.col("node").alias("root")))
    merged = merged.toDF("root", "top")
    return stored(every.join(merged, "root", "left").select("node", F.coalesce("top", "root").alias("root")), "classes")


def classes(docs: DataFrame, rows: DataFrame, plan: Plan) -> DataFrame:
    """(node, root) of the texts linked to another one; rows: the stored result of sign(docs)."""
    texts = rows.groupBy("node").agg(
        F.min(F.struct("row_id", "doc_id", "text_hash")).alias("first"),
        F.first("bands").alias("bands"),
        F.first("signature").alias("signature"),
    )
    texts = stored(texts, "texts")
    buckets = texts.select("node", F.explode("bands").alias("band"))
    leader = F.min(F.struct(F.xxhash64("node").alias("o"), "node"))
    leaders = buckets.groupBy("band").agg(leader.alias("leader"), F.min("node").alias("lo"), F.max("node").alias("hi"))
    leaders = leaders.where("lo <> hi").select("band", "leader")
    # Only buckets of several texts go on.
    shared = stored(buckets.join(leaders, "band"), "buckets")

    # A leader comes before the text in the common order, so links are a forest.
    met = shared.where("node <> leader.node").groupBy("node").agg(F.min("leader").alias("leader"))
    links = linked(docs, texts, met.select(F.col("node").alias("a"), F.col("leader.node").alias("b")), plan, "first")
    found = forest_roots(links)

    # Buckets whose texts are still in several classes, with two orders of their own.
    torn = torn_buckets(shared, found, "second")
    orders = (("node", "band"), ("band", "node"))
    leaders = torn.groupBy("band").agg(
        *[F.min(F.struct(F.xxhash64(*o).alias("o"), "node", "root")).alias(f"l{i}") for i, o in enumerate(orders)]
    )
    again = F.explode(F.array("l0", "l1")).alias("l")
    again = torn.join(leaders, "band").select("node", "root", again).where("root <> l.root").select(
        F.col("node").alias("a"), F.col("l.node").alias("b")
    )
    found = merged_classes(found, linked(docs, texts, again.distinct(), plan, "second"))

    # All pairs that are still open.
    torn = torn_buckets(torn.select("band", "node"), found, "third")
    if torn.isEmpty():
        return found
    return merged_classes(found, open_links(docs, texts, torn, plan))


def near_duplicates(docs: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """doc_id, text_hash (xxhash64 of the text), class_id, class_size, kept; a row per input row.

    class_id is the smallest id of the class, and that row is kept (of repeated rows the first).
    Texts are compared in lower case. Texts without words, null ones among them, are equal to each
    other. A null id comes last in a class. Other columns of the input are not carried."""
    rows = stored(sign(docs, plan), "signed")
    found = classes(docs, rows, plan)
    ids = rows.select("row_id", "doc_id", "text_hash", "node")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row_id"))
    nodes = ids.groupBy("node").agg(best.alias("best"), F.count(F.lit(1)).alias("n"))
    nodes = nodes.join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
    heads = nodes.groupBy("root").agg(F.min("best").alias("head"), F.sum("n").alias("class_size"))
    placed = nodes.select("node", "root").join(heads, "root").select("node", "head", "class_size")
    return ids.join(placed, "node").select(
        "doc_id",
        "text_hash",
        F.col("head.doc_id").alias("class_id"),
        "class_size",
        (F.col("row_id") == F.col("head.row_id")).alias("kept"),
    )


def dedupe(docs: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """The rows of docs without near copies: one of each class stays, with all its columns."""
    kept = near_duplicates(docs, plan).where("kept").select(F.col("doc_id").alias("kept_id"), F.col("text_hash").alias("kept_hash"))
    # The input's columns stay in a struct, so that no name can clash.
    whole = docs.select(F.struct("*").alias("row")).withColumn("hash", F.xxhash64(F.col("row.text").cast("string")))
    joined = whole.join(kept, F.col("row.doc_id").eqNullSafe(F.col("kept_id")) & (F.col("hash") == F.col("kept_hash")))
    return joined.dropDuplicates(["kept_id", "kept_hash"]).select("row.*")
