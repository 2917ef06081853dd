"""Ordered computations equal plain loops, whether or not keys are cut into chunks."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from trackflow.operators.ordered import CHUNK, WHOLE, Ordered, _chunk, pick


def table(seed, n=400):
    rnd = random.Random(seed)
    t, rows = {}, []
    for i in range(n):
        key = "hot" if rnd.random() < 0.6 else rnd.choice("abcde")
        t[key] = t.get(key, 100) + rnd.choice([0, 1, 1, 2, 3, 4, 9, -3])
        value = rnd.choice([None, rnd.randint(1, 50)])
        rows.append((i * 7 + 1000, key, t[key], value, rnd.random() < 0.03))
    return rows


@pytest.mark.parametrize("limit", [10_000, 9])
@pytest.mark.parametrize("seed", [1, 2])
def test_against_loops(spark, limit, seed):
    rows = table(seed)
    df = spark.createDataFrame(rows, "seq bigint, key string, t bigint, v bigint, reset boolean")
    ordered = Ordered.by_key(df, "key", "seq", limit)
    assert ordered.cut_keys == (limit == 9)
    got = ordered.last_before(before=F.col("v"))
    got = got.last_before(descending=True, after=F.col("v"))
    got = got.sum_since(F.col("reset"), exact=True, whole=F.coalesce("v", F.lit(0)))
    got = got.sum_since(F.col("reset"), part=F.col("v") * 0.5)
    got = got.sum_since(None, n=F.lit(1))
    result = {r.seq: r for r in got.rows().collect()}
    kept = {r.seq for r in ordered.sample_every(5, "t", F.col("reset")).rows().collect()}

    assert len(result) == len(rows)
    memory = {}
    for seq, key, t, v, reset in rows:
        m = memory.setdefault(key, {"last": None, "sum": 0, "n": 0, "kept": None})
        m["n"] += 1
        m["sum"] += v or 0
        r = result[seq]
        assert (r.before, r.whole, r.n) == (m["last"], m["sum"], m["n"])
        assert (r.part or 0.0) == pytest.approx(m["sum"] * 0.5)
        m["last"] = v if v is not None else m["last"]
        due = reset or m["kept"] is None or t - m["kept"] >= 5
        assert (seq in kept) == due, seq
        if due:
            m["kept"] = None if reset else t
        m["sum"] = 0 if reset else m["sum"]
    after = {}
    for seq, key, t, v, reset in reversed(rows):
        assert result[seq].after == after.get(key)
        after[key] = v if v is not None else after.get(key)


def test_chunks_are_bounded(spark):
    df = spark.range(5000).select(F.col("id").alias("seq"), (F.col("id") % 10 == 0).alias("key"))
    ordered = Ordered.by_key(df, "key", "seq", 500)
    sizes = ordered.df.groupBy("key", CHUNK).count().collect()
    assert max(r["count"] for r in sizes) <= 1024
    assert all((r[CHUNK] == WHOLE) == r["key"] for r in sizes)


def test_dense_run_longer_than_any_block(spark):
    """One ping a second without a pause: no row is certain but the first."""
    df = spark.range(3000).select(F.col("id").alias("seq"), F.lit(1).alias("key"), F.col("id").alias("t"))
    for limit in (10_000, 100):
        kept = Ordered.by_key(df, "key", "seq", limit).sample_every(7, "t").rows()
        assert sorted(r.t for r in kept.collect()) == list(range(0, 3000, 7))


def test_null_key_and_empty(spark):
    df = spark.createDataFrame([(i, None, i) for i in range(50)], "seq bigint, key string, v bigint")
    got = Ordered.by_key(df, "key", "seq", 7).sum_since(None, s=F.col("v")).rows()
    assert got.orderBy("seq").collect()[-1].s == sum(range(50))
    assert Ordered.by_key(df.limit(0), "key", "seq", 7).last_before(b=F.col("v")).rows().count() == 0
    assert Ordered.globally(df.limit(0), "seq", 7).sum_since(None, s=F.col("v")).rows().count() == 0


@pytest.mark.parametrize("limit", [10_000, 6])
def test_global_order(spark, limit):
    df = spark.range(200).select((F.col("id") * 5).alias("seq"), F.col("id").alias("v"))
    rows = Ordered.globally(df, "seq", limit).sum_since(None, s=F.col("v")).rows().orderBy("seq")
    assert [r.s for r in rows.collect()] == [i * (i + 1) // 2 for i in range(200)]


def greedy(times, interval):
    kept, last = [], None
    for i, t in enumerate(times):
        if last is None or t - last >= interval:
            kept.append(i)
            last = t
    return kept


@pytest.mark.parametrize("limit", [100_000, 700])
def test_late_stretch(spark, limit):
    """A first ping from the future, then a long stretch of ordinary ones, then later ones again."""
    times = [1_000_000, *range(0, 9_000, 1), *range(999_000, 1_001_500)]
    df = spark.createDataFrame([(i, "k", t) for i, t in enumerate(times)], "seq bigint, key string, t bigint")
    rows = Ordered.by_key(df, "key", "seq", limit).sample_every(5, "t").rows()
    assert sorted(r.seq for r in rows.collect()) == greedy(times, 5)


def test_uneven_density_is_cut_evenly(spark):
    """One early row and many dense ones far later, by key and over all rows."""
    df = spark.range(20_000).select(
        F.when(F.col("id") == 0, F.lit(0)).otherwise(F.col("id") + 10**12).alias("seq"), F.lit("k").alias("key")
    )
    for ordered in (Ordered.by_key(df, "key", "seq", 2000), Ordered.globally(df, "seq", 2000)):
        sizes = [r["count"] for r in ordered.df.groupBy(CHUNK).count().collect()]
        assert sum(sizes) == 20_000 and max(sizes) <= 2000 and len(sizes) >= 10


def test_dense_key_takes_linear_time():
    """The next row to keep is found by bisection, not by a look at every row before it."""
    times = np.arange(2_000_000)
    kept, last = pick(times, None, 5)
    assert kept == list(range(0, 2_000_000, 5)) and last == 1_999_995


def test_plan_of_a_global_sequence_does_not_grow(spark):
    """Neither bounds nor constant chunks in the plan, however many chunks there are."""
    sizes = []
    for n, limit in ((300, 20), (30_000, 200)):
        df = spark.range(n).select((F.col("id") * 3).alias("seq"), F.col("id").alias("v"))
        rows = Ordered.globally(df, "seq", limit)
        assert rows.df.select(CHUNK).distinct().count() >= n // limit
        plan = rows.totals({}, s=F.col("v")).rows()._jdf.queryExecution().optimizedPlan().toString()
        sizes.append(len(plan))
        assert "Window" in plan and "windowspecdefinition(0" not in plan
    assert abs(sizes[0] - sizes[1]) < 200


def test_small_chunks_do_not_make_tasks(spark):
    """Chunks of a global sequence are cut within the tasks' ranges; equal order values stay together."""
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df = spark.range(30_000).select(F.floor(F.col("id") / 2).alias("seq"), F.lit(1).alias("v"))
    ordered = Ordered.globally(df, "seq", 20)
    assert ordered.df.rdd.getNumPartitions() <= tasks
    chunks = ordered.df.groupBy(CHUNK).agg(F.count("seq").alias("n"), F.min("seq").alias("lo"), F.max("seq").alias("hi"))
    chunks = chunks.orderBy(CHUNK).collect()
    assert len(chunks) >= 1500 and max(r.n for r in chunks) <= 20
    assert all(a.hi < b.lo for a, b in zip(chunks, chunks[1:]))
    sums = ordered.sum_since(None, s=F.col("v")).rows().select("s").orderBy("s").collect()
    assert [r.s for r in sums] == list(range(1, 30_001))


def test_small_chunks_are_no_groups(spark):
    """Steps of chunks and their composition stream through Arrow; no Python call per chunk or key."""
    df = spark.range(300).select(F.col("id").alias("seq"), (F.col("id") % 3).alias("key"), F.col("id").alias("t"))
    held = []
    ordered = Ordered.by_key(df, "key", "seq", 9)
    ordered.hold = lambda rows: held.append(rows) or rows
    assert ordered.sample_every(5, "t").rows().count() == 150
    plan = held[0]._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroups" not in plan and "MapInArrow" in plan


def test_cut_key_with_chunks_longer_than_a_batch(spark):
    """Chunks of more rows than an Arrow batch, rows without a time and restarts: as if the key were not cut."""
    i = F.col("id")
    noise = F.pmod(F.xxhash64("id"), F.lit(1000))
    rare = i.isin(100, 31_000, 31_001, 47_500)
    df = spark.range(60_000).select(
        i.alias("seq"), F.lit(None).cast("string").alias("key"), F.when(noise >= 30, i + noise % 7).alias("t"), rare.alias("reset")
    )
    kept = []
    for limit in (100_000, 30_000, 7):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1000)
        try:
            rows = Ordered.by_key(df, "key", "seq", limit).sample_every(5, "t", F.col("reset")).rows()
            kept.append(sorted(r.seq for r in rows.select("seq").collect()))
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert kept[0] == kept[1] == kept[2] and {100, 31_000, 31_001, 47_500} <= set(kept[0])


def test_chunk_of_a_row_is_found_by_bisection(spark):
    """The work per row grows with the logarithm of the bounds; no filter looks at each of them."""
    for n in (0, 1, 2, 63, 64, 300):
        bounds = [i * 3 for i in range(n)]
        inside = _chunk("id", F.array(*[F.lit(b).cast("bigint") for b in bounds]).cast("array<bigint>"), n + 1)
        assert "filter" not in str(inside).lower()
        rows = spark.range(-2, 3 * n + 2).select("id", inside.alias("c")).collect()
        assert [r.c for r in rows] == [int(np.searchsorted(bounds, r.id)) for r in rows]


def test_totals(spark):
    """Running sums and the largest value before each row, over one range and over many."""
    rnd = random.Random(4)
    rows = [(i * 2, rnd.choice([None, rnd.randint(-9, 9)]), rnd.randint(0, 99)) for i in range(300)]
    df = spark.createDataFrame(rows, "seq bigint, v bigint, t bigint")
    for limit in (10_000, 20):
        got = Ordered.globally(df, "seq", limit).totals({"top": F.col("t")}, s=F.coalesce("v", F.lit(0))).rows()
        total, top = 0, None
        for (_, v, t), r in zip(rows, got.orderBy("seq").collect(), strict=True):
            total += v or 0
            assert (r.s, r.top) == (total, top)
            top = t if top is None else max(top, t)


def test_last_value_within_few_rows(spark):
    df = spark.range(400).select(F.col("id").alias("seq"))
    rows = Ordered.globally(df, "seq", 20)
    few = rows.df.where("seq % 90 = 7").select("seq", CHUNK, F.col("seq").alias("mark"))
    marked = rows.like(rows.df.join(few, ["seq", CHUNK], "left"))
    got = marked.last_before(upto=True, within=few, kept=F.col("mark")).rows().orderBy("seq").collect()
    for r in got:
        assert r.kept == (None if r.seq < 7 else (r.seq - 7) // 90 * 90 + 7)
