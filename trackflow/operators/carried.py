"""The ordered computations of one micro-batch, opened by what earlier ones left behind.

``Carried`` has the steps of ``Ordered``, so the batch chain runs over it unchanged. Each step that
looks back takes what flows in from columns of the key's stored state, and leaves what flows out in
columns of its own. Rows that a step rejects stay until the end, marked as gone, so that the last row
of each key holds what all steps leave: the state that opens the key's next micro-batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackflow.operators.ordered import CHUNK, WHOLE, Ordered, thin

ALIVE = "_alive"
STATE = "_state_"  # columns that flow in, and their names in the stored state
LEFT = "_left_"  # columns that flow out


class Carried(Ordered):
    """Rows of one micro-batch per key, with the key's state of before.

    A key's rows of a micro-batch are bounded by its trigger, so keys are never cut."""

    def __init__(
        self, df: DataFrame, key: list[str], order: str, steps: int = 0,
        tape: list[Callable[[DataFrame], DataFrame]] | None = None,
    ):
        super().__init__(df, key, order, False)
        self.steps = steps  # steps that look back so far: their number names what they carry
        self.tape = [] if tape is None else tape  # what was done to the rows, to be done to further ones

    @classmethod
    def opened(cls, df: DataFrame, key: str, order: str, state: DataFrame | None) -> "Carried":
        """``state``: one row per key with the columns of ``closing``; none before the first batch."""
        rows = df.withColumns({CHUNK: F.lit(WHOLE).cast("bigint"), ALIVE: F.lit(True)})
        if state is not None:
            names = [c for c in state.columns if c.startswith(STATE)]
            side = state.select(F.col(key).alias("_key"), *names)
            rows = rows.join(side, F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key")
        return cls(rows, [key], order)

    def _do(self, change: Callable[[DataFrame], DataFrame]) -> "Carried":
        return Carried(change(self.df), self.key, self.order, self.steps, [*self.tape, change])

    def again(self, opened: "Carried") -> "Carried":
        """The same steps over another micro-batch with the same columns; columns are not built anew."""
        df = opened.df
        for change in self.tape:
            df = change(df)
        return Carried(df, self.key, self.order, self.steps, self.tape)

    def like(self, df: DataFrame) -> "Carried":
        return Carried(df, self.key, self.order, self.steps, self.tape)

    def where(self, condition: Column) -> "Carried":
        alive = F.col(ALIVE) & F.coalesce(condition, F.lit(False))
        return self._do(lambda df: df.withColumn(ALIVE, alive))

    def add(self, **columns: Column) -> "Carried":
        return self._do(lambda df: df.withColumns(columns))

    def drop(self, *names: str) -> "Carried":
        return self._do(lambda df: df.drop(*names))

    def settled(self) -> "Carried":
        return self

    def rows(self) -> DataFrame:
        """Rows that no step has rejected, without what is carried."""
        private = [c for c in self.df.columns if c.startswith((STATE, LEFT))]
        return self.df.where(ALIVE).drop(CHUNK, ALIVE, *private)

    def closing(self) -> DataFrame:
        """Per key of the micro-batch what its last row leaves: the state for the next one."""
        left = [c for c in self.df.columns if c.startswith(LEFT)]
        last = self.df.groupBy(*self.key).agg(F.max_by(F.struct(*left), self.order).alias("_last"))
        return last.select(*self.key, *[F.col("_last")[c].alias(STATE + c.removeprefix(LEFT)) for c in left])

    # -- steps -----------------------------------------------------------------------------

    def _next(self, names: list[str]) -> dict[str, str]:
        """Names of what a further step carries."""
        self.steps += 1
        return {n: f"{self.steps}{n}" for n in names}

    def _inflow(self, name: str) -> Column:
        return F.col(STATE + name) if STATE + name in self.df.columns else F.lit(None)

    def last_before(self, descending: bool = False, **values: Column) -> "Carried":
        if descending:
            raise ValueError("rows of later micro-batches are not known yet")
        before = self._window().rowsBetween(Window.unboundedPreceding, -1)
        names = self._next(list(values))
        alive = {n: F.when(F.col(ALIVE), v) for n, v in values.items()}
        found = {n: F.coalesce(F.last(v, ignorenulls=True).over(before), self._inflow(names[n])) for n, v in alive.items()}
        left = {LEFT + names[n]: F.coalesce(v, F.col(n)) for n, v in alive.items()}
        return self._do(lambda df: df.withColumns(found).withColumns(left))

    def sum_since(self, reset: Column | None, exact: bool = False, **values: Column) -> "Carried":
        if reset is not None and not exact:
            raise ValueError("only whole numbers are summed over micro-batches")
        names = self._next(list(values))
        upto = self._window().rowsBetween(Window.unboundedPreceding, 0)
        before = self._window().rowsBetween(Window.unboundedPreceding, -1)
        mark = F.col(ALIVE) & (F.coalesce(reset, F.lit(False)) if reset is not None else F.lit(False))
        zero = F.lit(0).cast("bigint")
        added = {f"_v{n}": F.when(F.col(ALIVE), F.coalesce(v, zero)).otherwise(zero) for n, v in values.items()}
        sums = {n: F.sum(f"_v{n}").over(upto) for n in values}
        # A running sum less its value at the last reset; before any, what flowed in comes on top.
        at_reset = {f"_b{n}": F.last(F.when(F.col("_reset"), F.col(n)), True).over(before) for n in values}
        inflow = {n: F.coalesce(self._inflow(names[n]).cast("bigint"), zero) for n in values}
        since = {n: F.col(n) - F.coalesce(F.col(f"_b{n}"), -inflow[n]) for n in values}
        left = {LEFT + names[n]: F.when(F.col("_reset"), zero).otherwise(F.col(n)) for n in values}
        steps = [added | {"_reset": mark}, sums, at_reset, since, left]

        def change(df: DataFrame) -> DataFrame:
            for columns in steps:
                df = df.withColumns(columns)
            return df.drop("_reset", *added, *at_reset)

        return self._do(change)

    def totals(self, top: dict[str, Column], **sums: Column) -> "Carried":
        raise ValueError("totals are taken over the rows of all keys")

    def sample_every(self, interval: int, time: str, restart: Column | None = None) -> "Carried":
        carried = self._next(["kept"])["kept"]
        mark = F.coalesce(restart, F.lit(False)) if restart is not None else F.lit(False)
        names, alive = self.df.columns, F.col(ALIVE)
        steps = {
            "_restart": mark & alive,
            "_time": F.when(alive, F.col(time).cast("bigint")),
            "_inflow": self._inflow(carried).cast("bigint"),
        }
        place = F.row_number().over(self._window()).alias("_place")
        columns = [*names, *[c.alias(n) for n, c in steps.items()]]
        kept_names = [*names, *steps]
        schema = T.StructType([*self.df.select(*columns).schema.fields, T.StructField("_keep", T.BooleanType())])
        # What is left: the last kept time, none after a restart.
        upto = self._window().rowsBetween(Window.unboundedPreceding, 0)
        kept = F.when(alive, F.struct(F.when(~F.col("_restart"), F.col("_time")).alias("s")))
        last = F.last(kept, ignorenulls=True).over(upto)
        left = F.when(last.isNotNull(), last["s"]).otherwise(F.col("_inflow"))

        def change(df: DataFrame) -> DataFrame:
            df = df.select(*columns, place).mapInArrow(thin(kept_names, interval, "_keep"), schema)
            df = df.withColumn(ALIVE, alive & F.col("_keep")).withColumn(LEFT + carried, left)
            return df.drop("_keep", *steps)

        return self._do(change)
