"""Ordered computations per key that do not depend on one task holding a whole key.

Every stateful operator of the pipeline needs one of three things from the earlier rows of its
key: the last value of some kind, a running sum since the last reset, or a greedy down-sampling.
With ordinary keys these are plain windows over one hash exchange. A key with more rows than
``max_group_rows`` is cut into chunks of its order column, and a sequence over all rows always is.
The bounds of chunks are measured quantiles of the order column (integers unique within the key), so
chunks are even however uneven the density is. Rows are then exchanged by (key, chunk); each chunk is
computed on its own and reduced to one summary row, the summaries are scanned per key, and what
flows into a chunk comes back by an equi-join on (key, chunk). Results are the same either way.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackflow.session import cut

CHUNK = "_chunk"
WHOLE = -1  # chunk number of a key that is not cut
MAX_SPLIT_KEYS = 1_000_000  # upper bound on the keys to cut; there are at most twice as many bounds
FEW = 10_000  # rows of a sequence that are not worth several chunks
TASK_ROWS = 1_000_000  # rows of a sequence that are worth a task beyond those of a shuffle
RANGE_BITS = 40  # chunks of one range, as a power of two


def _as_is(df: DataFrame) -> DataFrame:
    return df


def _quantiles(order: str, pieces: int) -> Column:
    """Bounds between so many even pieces of the order column; one more row per hundred at most."""
    shares = [i / pieces for i in range(1, pieces)]
    return F.percentile_approx(F.col(order).cast("bigint"), shares, 100 * pieces)


def _chunk(order: str, bounds: Column, pieces: int) -> Column:
    """How many of the sorted bounds, fewer than ``pieces``, lie below the order value; by bisection."""
    value = F.col(order).cast("bigint")
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(pieces.bit_length()))])
    # Beyond the last bound there is null, which is not below.
    found = F.aggregate(
        steps, F.lit(0), lambda at, step: F.when(F.get(bounds, at + step - 1) < value, at + step).otherwise(at)
    )
    return found.cast("bigint")


class Ordered:
    """A DataFrame with a key, an integer order column and a chunk number per row."""

    def __init__(
        self, df: DataFrame, key: list[str], order: str, cut_keys: bool,
        hold: Callable[[DataFrame], DataFrame] = cut,
    ):
        self.df, self.key, self.order, self.cut_keys = df, key, order, cut_keys
        self.hold = hold  # keeps what several steps read, and what flows into chunks

    @classmethod
    def by_key(cls, df: DataFrame, key: str, order: str, max_group_rows: int) -> "Ordered":
        """Measure the keys (two columns, map-side combined) and cut those that are too large."""
        sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
        total, top = sizes.agg(F.sum("_n"), F.max("_n")).first()
        if (top or 0) <= max_group_rows:
            return cls(df.withColumn(CHUNK, F.lit(WHOLE).cast("bigint")), [key], order, False)
        # At most MAX_SPLIT_KEYS keys can exceed this. Their pieces have about half of it, so there
        # are at most 2 * total / limit bounds, and the table below is safe to broadcast.
        limit = max(max_group_rows, total // MAX_SPLIT_KEYS)
        pieces = -(-2 * top // limit)
        large = sizes.where(F.col("_n") > limit).select(F.col(key).alias("_key"))
        same = F.col(key).eqNullSafe(F.col("_key"))
        bounds = df.join(F.broadcast(large), same, "left_semi").groupBy(F.col(key).alias("_key")).agg(
            F.count(F.lit(1)).alias("_n"), _quantiles(order, pieces).alias("_bounds")
        )
        # A key with fewer rows than the largest needs only every so-manieth bound.
        every = F.greatest(F.floor(F.lit(pieces) / F.ceil(2 * F.col("_n") / F.lit(limit))), F.lit(1))
        kept = F.filter("_bounds", lambda x, i: (i + 1) % every == 0)
        bounds = cut(bounds.select("_key", kept.alias("_bounds")))
        out = df.join(F.broadcast(bounds), same, "left")
        inside = F.when(F.col("_bounds").isNotNull(), _chunk(order, F.col("_bounds"), pieces))
        out = out.withColumn(CHUNK, F.coalesce(inside, F.lit(WHOLE).cast("bigint")))
        return cls(out.drop("_key", "_bounds"), [key], order, True)

    @classmethod
    def globally(
        cls, df: DataFrame, order: str, max_group_rows: int, hold: Callable[[DataFrame], DataFrame] = cut
    ) -> "Ordered":
        """One sequence over all rows; its chunks are the ranges of a range exchange on the order.

        A row's chunk is the range that it was dealt to, so no bounds reach the driver or the plan,
        whose size does not depend on the number of rows. ``hold`` keeps the numbered rows: a
        checkpoint, or for a micro-batch tables that go with it. So few rows that
        cutting them costs more than it gives are one range. A range is a task, so chunks too small
        to be worth a task each are cut within the ranges, by the rows' places there.
        """
        # Read by the count, by the exchange's sample and by the exchange. Rows of a micro-batch are at rest.
        read = df.persist() if hold is cut else df
        n = read.count()
        tasks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2)
        pieces = max(-(-2 * n // max_group_rows) if n > max_group_rows else 1, min(tasks, -(-n // FEW)))
        ranges = min(pieces, max(tasks, -(-n // TASK_ROWS)))
        ranged = read.repartitionByRange(ranges, F.col(order).asc())
        ranged = ranged.withColumn(CHUNK, F.spark_partition_id().cast("bigint"))
        if ranges < pieces:
            # Rows of the same order value stay together, as they do in ranges.
            place = F.rank().over(Window.partitionBy(CHUNK).orderBy(order)).cast("bigint") - 1
            within = F.floor(place / F.lit(max_group_rows)).cast("bigint")
            ranged = ranged.withColumn(CHUNK, F.shiftleft(CHUNK, RANGE_BITS) + within)
        if pieces > 1 or hold is cut:
            ranged = hold(ranged)
        else:
            hold = _as_is  # one range of few rows is cheaper computed again than kept
        if hold is cut:
            read.unpersist()
        return cls(ranged, [], order, pieces > 1, hold)

    def like(self, df: DataFrame) -> "Ordered":
        """The same key, order and chunks over a DataFrame derived from this one."""
        return Ordered(df, self.key, self.order, self.cut_keys, self.hold)

    # -- plain DataFrame steps -------------------------------------------------------------

    def where(self, condition: Column) -> "Ordered":
        return self.like(self.df.where(condition))

    def add(self, **columns: Column) -> "Ordered":
        return self.like(self.df.withColumns(columns))

    def drop(self, *names: str) -> "Ordered":
        return self.like(self.df.drop(*names))

    def settled(self) -> "Ordered":
        """Written out once, if keys are cut: each later step reads the rows to find its carries.

        The checkpoint keeps the partitioning, so later steps need no further exchange.
        """
        return self.like(self.hold(self.df)) if self.cut_keys else self

    def rows(self) -> DataFrame:
        return self.df.drop(CHUNK)

    # -- ordered computations --------------------------------------------------------------

    def _window(self, *extra: str, descending: bool = False):
        order = F.col(self.order).desc() if descending else F.col(self.order).asc()
        return Window.partitionBy(*self.key, CHUNK, *extra).orderBy(order)

    def _cut_rows(self, df: DataFrame) -> DataFrame:
        return df if not self.key else df.where(F.col(CHUNK) != WHOLE)

    def _attach(self, df: DataFrame, carry: DataFrame) -> DataFrame:
        """Join what flows into each chunk; the carry has one row per chunk of a cut key."""
        names = [*self.key, CHUNK]
        side = carry.withColumnsRenamed({n: f"_in{n}" for n in names})
        same = reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(f"_in{n}")) for n in names])
        return df.join(side, same, "left").drop(*[f"_in{n}" for n in names])

    def last_before(
        self, descending: bool = False, upto: bool = False, within: DataFrame | None = None, **values: Column
    ) -> "Ordered":
        """Last non-null value strictly before the row (strictly after it when descending).

        ``upto`` counts the row itself; ``within`` are the only rows with values, where they are
        known, so that what flows into chunks need not be looked for in all rows."""
        before = self._window(descending=descending).rowsBetween(Window.unboundedPreceding, 0 if upto else -1)
        local = {n: F.last(v, ignorenulls=True).over(before) for n, v in values.items()}
        if not self.cut_keys:
            return self.like(self.df.withColumns(local))
        pick = F.min_by if descending else F.max_by
        summary = self._cut_rows(self.df if within is None else within)
        summary = summary.withColumns({f"_v{n}": v for n, v in values.items()})
        summary = summary.groupBy(*self.key, CHUNK).agg(
            *[
                pick(f"_v{n}", F.when(F.col(f"_v{n}").isNotNull(), F.col(self.order))).alias(n)
                for n in values
            ]
        )
        order = F.col(CHUNK).desc() if descending else F.col(CHUNK).asc()
        earlier = Window.partitionBy(*self.key).orderBy(order)
        earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
        if within is not None:
            # Chunks without such rows take over what flowed into the one before.
            chunks = self.df.select(*self.key, CHUNK).distinct()
            summary = chunks.join(summary, [*self.key, CHUNK], "left")
        carry = self.hold(
            summary.select(
                *self.key, CHUNK,
                *[F.last(n, ignorenulls=True).over(earlier).alias(f"_c{n}") for n in values],
            )
        )
        out = self._attach(self.df.withColumns(local), carry)
        out = out.withColumns({n: F.coalesce(F.col(n), F.col(f"_c{n}")) for n in values})
        return self.like(out.drop(*[f"_c{n}" for n in values]))

    def sum_since(self, reset: Column | None, exact: bool = False, **values: Column) -> "Ordered":
        """Running sums including the row, starting anew after each row where ``reset`` holds.

        ``exact`` is for integers: a running total less its value at the last reset needs no
        window beyond the key's own. Doubles get a window per stretch, so that no digits cancel.
        """
        names = list(values)
        mark = F.coalesce(reset, F.lit(False)) if reset is not None else F.lit(False)
        df = self.df.withColumns({**{f"_v{n}": v for n, v in values.items()}, "_reset": mark})
        before = self._window().rowsBetween(Window.unboundedPreceding, -1)
        upto = self._window().rowsBetween(Window.unboundedPreceding, 0)
        part = F.lit(0).cast("bigint")
        if reset is not None:
            part = F.coalesce(F.sum(F.col("_reset").cast("bigint")).over(before), part)
        if exact or reset is None:
            df = df.withColumns({"_part": part, **{n: F.sum(f"_v{n}").over(upto) for n in names}})
            out = df
            if reset is not None:
                at_reset = {f"_b{n}": F.last(F.when(F.col("_reset"), F.col(n)), True) for n in names}
                out = out.withColumns({b: c.over(before) for b, c in at_reset.items()})
                base = {n: F.coalesce(F.col(f"_b{n}"), F.lit(0)) for n in names}
                out = out.withColumns({n: F.col(n) - base[n] for n in names}).drop(*at_reset)
        else:
            df = df.withColumn("_part", part)
            upto = self._window("_part").rowsBetween(Window.unboundedPreceding, 0)
            out = df.withColumns({n: F.sum(f"_v{n}").over(upto) for n in names})
        if self.cut_keys:
            out = self._attach(out, self._sums_into_chunks(df, names))
            inflow = F.col("_part") == 0
            out = out.withColumns(
                {
                    n: F.when(
                        inflow & F.col(f"_c{n}").isNotNull(),
                        F.coalesce(F.col(n), F.lit(0)) + F.col(f"_c{n}"),
                    ).otherwise(F.col(n))
                    for n in names
                }
            ).drop(*[f"_c{n}" for n in names])
        return self.like(out.drop("_reset", "_part", *[f"_v{n}" for n in names]))

    def _sums_into_chunks(self, df: DataFrame, names: list[str]) -> DataFrame:
        rows = self._cut_rows(df)
        parts = rows.groupBy(*self.key, CHUNK, "_part").agg(
            F.max("_reset").alias("_closed"), *[F.sum(f"_v{n}").alias(n) for n in names],
        )
        tails = parts.groupBy(*self.key, CHUNK).agg(
            F.max_by(F.struct("_closed", *names), "_part").alias("_tail"),
            F.max((F.col("_part") > 0) | F.col("_closed")).cast("int").alias("_resets"),
        )
        open_sum = {n: F.when(~F.col("_tail._closed"), F.col(f"_tail.{n}")) for n in names}
        scan = Window.partitionBy(*self.key).orderBy(CHUNK)
        tails = tails.withColumns(open_sum).withColumn("_era", F.sum("_resets").over(scan))
        era = Window.partitionBy(*self.key, "_era").orderBy(CHUNK)
        era = era.rowsBetween(Window.unboundedPreceding, 0)
        running = tails.withColumns({n: F.sum(n).over(era) for n in names})
        return self.hold(
            running.select(
                *self.key, CHUNK, *[F.lag(n).over(scan).alias(f"_c{n}") for n in names]
            )
        )

    def totals(self, top: dict[str, Column], **sums: Column) -> "Ordered":
        """Running sums including the row, and under ``top`` the largest value strictly before it.

        Both flow into chunks by one summary of all chunks."""
        upto = self._window().rowsBetween(Window.unboundedPreceding, 0)
        before = self._window().rowsBetween(Window.unboundedPreceding, -1)
        local = {n: F.sum(v).over(upto) for n, v in sums.items()}
        local |= {n: F.max(v).over(before) for n, v in top.items()}
        if not self.cut_keys:
            return self.like(self.df.withColumns(local))
        summary = self._cut_rows(self.df).groupBy(*self.key, CHUNK).agg(
            *[F.sum(v).alias(f"_c{n}") for n, v in sums.items()],
            *[F.max(v).alias(f"_c{n}") for n, v in top.items()],
        )
        earlier = Window.partitionBy(*self.key).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
        carry = summary.select(
            *self.key, CHUNK,
            *[F.sum(f"_c{n}").over(earlier).alias(f"_c{n}") for n in sums],
            *[F.max(f"_c{n}").over(earlier).alias(f"_c{n}") for n in top],
        )
        out = self._attach(self.df.withColumns(local), self.hold(carry))
        out = out.withColumns(
            {n: F.col(n) + F.coalesce(F.col(f"_c{n}"), F.lit(0)) for n in sums}
            | {n: F.greatest(F.col(n), F.col(f"_c{n}")) for n in top}
        )
        return self.like(out.drop(*[f"_c{n}" for n in (*sums, *top)]))

    def sample_every(self, interval: int, time: str, restart: Column | None = None) -> "Ordered":
        """Keep rows at least ``interval`` seconds after the last kept one; greedy, in order.

        Rows where ``restart`` holds are always kept, and so is the next row after them. A
        decision depends on the last decision, which no window expresses: the rows of a task, in
        the order of their chunks, stream through a step that carries the last kept time along.
        """
        mark = F.coalesce(restart, F.lit(False)) if restart is not None else F.lit(False)
        df = self.df.withColumn("_restart", mark)
        inflow = F.lit(None).cast("bigint")
        if self.cut_keys:
            df = self._attach(df, self._kept_before_chunks(df, interval, time))
            inflow = F.col("_last").cast("bigint")
        names = self.df.columns
        # The window brings the rows of a chunk together and in order.
        df = df.select(
            *names, "_restart", F.col(time).cast("bigint").alias("_time"), inflow.alias("_inflow"),
            F.row_number().over(self._window()).alias("_place"),
        )
        return self.like(df.mapInArrow(thin(names, interval), self.df.schema))

    def _kept_before_chunks(self, df: DataFrame, interval: int, time: str) -> DataFrame:
        """One summary row per chunk and one scan per key, both streamed: neither a chunk nor a key is a group of its own."""
        keep = [*self.key, CHUNK]
        types = {f.name: f.dataType for f in df.schema.fields}
        keyed = [T.StructField(n, types[n]) for n in keep]
        # The windows bring the rows of a chunk, and the chunks of a key, together and in order.
        rows = self._cut_rows(df).select(
            *keep, F.col(time).cast("bigint").alias("_time"), "_restart",
            F.row_number().over(self._window()).alias("_place"),
        )
        steps = rows.mapInArrow(
            chunk_steps(keep, interval),
            T.StructType(
                keyed
                + [T.StructField("_fixed", T.BooleanType()), T.StructField("_out", T.LongType())]
                + [T.StructField(n, T.ArrayType(T.LongType())) for n in ("_upto", "_then")]
            ),
        )
        scan = Window.partitionBy(*self.key).orderBy(CHUNK)
        carry = steps.withColumn("_place", F.row_number().over(scan)).mapInArrow(
            compose_steps(keep, interval), T.StructType(keyed + [T.StructField("_last", T.LongType())])
        )
        return self.hold(carry)


def pick(times: np.ndarray, last: int | None, interval: int) -> tuple[list[int], int | None]:
    """Places of the rows to keep among rows without a restart, and the last kept time.

    Kept times rise, and no row before the last kept one is an interval later than it, so the next
    one to keep is where the running maximum first gets there."""
    kept: list[int] = []
    if last is None and len(times):
        kept, last = [0], int(times[0])
    latest = np.maximum.accumulate(times)
    while True:
        at = 0 if last is None else int(np.searchsorted(latest, last + interval))
        if at >= len(times):
            return kept, last
        kept.append(at)
        last = int(times[at])


def kept_rows(batch: pa.RecordBatch, last: int | None, interval: int) -> tuple[np.ndarray, int | None]:
    """Which rows of a batch to keep, in linear time; chunks begin at place 1, ``last`` flows in."""
    place = batch.column("_place").to_numpy(zero_copy_only=False)
    restart = batch.column("_restart").to_numpy(zero_copy_only=False)
    inflow = batch.column("_inflow")
    time = batch.column("_time")
    # A row without a time is kept only where any row would be; it leaves no time behind.
    timed = time.is_valid().to_numpy(zero_copy_only=False)
    times = time.fill_null(0).to_numpy(zero_copy_only=False)
    keep = np.zeros(batch.num_rows, bool)
    alone = restart | ~timed
    cuts = np.unique(np.concatenate((np.flatnonzero(place == 1), np.flatnonzero(alone), np.flatnonzero(alone) + 1)))
    cuts = np.append(cuts[cuts < len(place)], len(place))
    lo = 0
    for hi in cuts.tolist():
        if hi == lo:
            continue
        if place[lo] == 1:
            last = inflow[lo].as_py()
        if restart[lo]:
            keep[lo], last = True, None
        elif not timed[lo]:
            keep[lo] = last is None
        else:
            kept, last = pick(times[lo:hi], last, interval)
            keep[lo + np.array(kept, np.int64)] = True
        lo = hi
    return keep, last


def thin(names: list[str], interval: int, flag: str | None = None) -> Callable:
    """Filter the ordered rows of chunks, or flag in a further column which ones would stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: int | None = None
        for batch in batches:
            keep, last = kept_rows(batch, last, interval)
            if flag is not None:
                yield batch.select(names).append_column(flag, pa.array(keep))
            elif keep.any():
                yield batch.select(names).filter(pa.array(keep))

    return run


class Step:
    """The map from the kept time flowing into a chunk to the one flowing out, from its rows so far.

    With a restart inside, the outflow is fixed. Otherwise only rows later than all before them
    can be kept, each has one successor, and the outflow is a step function of the inflow whose
    values lie within one interval of the chunk's latest time, so it has at most that many steps.
    Rows without a time leave the kept time as it is.
    """

    def __init__(self, interval: int):
        self.interval, self.fixed, self.out = interval, False, None
        self.latest = np.zeros(0, np.int64)  # times later than all before them

    def add(self, times: np.ndarray, timed: np.ndarray, restart: np.ndarray) -> None:
        if restart.any():
            after = int(np.flatnonzero(restart)[-1]) + 1
            self.fixed, self.out = True, None
            times, timed = times[after:], timed[after:]
        if not timed.all():
            times = times[timed]
        if self.fixed:
            self.out = pick(times, self.out, self.interval)[1]
        elif len(times):
            top = np.maximum.accumulate(np.append(self.latest[-1:], times))
            rising = np.append(not len(self.latest), top[1:] > top[:-1])
            self.latest = np.append(self.latest, top[rising])

    def summary(self) -> tuple[bool, int | None, list[int], list[int]]:
        if self.fixed:
            return True, self.out, [], []
        t = self.latest
        follower, final = np.searchsorted(t, t + self.interval), t.copy()
        for i in range(int(np.searchsorted(follower, len(t))) - 1, -1, -1):
            final[i] = final[follower[i]]
        ends = np.flatnonzero(np.append(final[1:] != final[:-1], True)) if len(t) else []
        return False, None, t[ends].tolist(), final[ends].tolist()


def chunk_steps(names: list[str], interval: int) -> Callable:
    """Reduce each chunk of the ordered rows of a task to one row with its step; chunks begin at place 1."""

    def rows(keys: pa.RecordBatch, done: list[tuple]) -> pa.RecordBatch:
        fixed, out, upto, then = zip(*done)
        steps = [pa.array(fixed, pa.bool_()), pa.array(out, pa.int64())]
        steps += [pa.array(x, pa.list_(pa.int64())) for x in (upto, then)]
        return pa.RecordBatch.from_arrays([*keys.columns, *steps], [*names, "_fixed", "_out", "_upto", "_then"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step, keys = None, None  # the chunk that is still open
        for batch in batches:
            time = batch.column("_time")
            timed = time.is_valid().to_numpy(zero_copy_only=False)
            times = time.fill_null(0).to_numpy(zero_copy_only=False)
            restart = batch.column("_restart").to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(batch.column("_place").to_numpy(zero_copy_only=False) == 1)
            cuts = [*starts.tolist(), batch.num_rows]
            if step is not None:
                step.add(times[: cuts[0]], timed[: cuts[0]], restart[: cuts[0]])
            done = []
            for lo, hi in zip(cuts, cuts[1:]):
                if step is not None:
                    done.append(step.summary())
                step = Step(interval)
                step.add(times[lo:hi], timed[lo:hi], restart[lo:hi])
            opened = batch.select(names).take(pa.array(starts))
            keys = opened if keys is None else pa.concat_batches([keys, opened])
            if done:
                yield rows(keys.slice(0, len(done)), done)
                keys = keys.slice(len(done))
        if step is not None:
            yield rows(keys, [step.summary()])

    return run


def compose_steps(names: list[str], interval: int) -> Callable:
    """Follow the chunk summaries of each key in order; one row per chunk with the time flowing in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: int | None = None
        for batch in batches:
            inflow = []
            columns = (batch.column(n).to_pylist() for n in ("_place", "_fixed", "_out", "_upto", "_then"))
            for place, fixed, out, upto, then in zip(*columns):
                state = None if place == 1 else state
                inflow.append(state)
                if fixed:
                    state = out
                else:
                    i = 0 if state is None else bisect_left(upto, state + interval)
                    state = then[i] if i < len(then) else state
            yield pa.RecordBatch.from_arrays(
                [*batch.select(names).columns, pa.array(inflow, pa.int64())], [*names, "_last"]
            )

    return run
