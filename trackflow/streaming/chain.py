"""The keyed chain under Structured Streaming: the batch chain's windows over each micro-batch.

Each taxi's state (a row of what every step carries) is kept in a versioned table. A micro-batch joins
the states of its taxis to their pings, runs the batch chain over them, and writes the states that its
last rows leave. Rows of a taxi are put in arrival order within a micro-batch, so late ones meet the same
rules as in the batch chain, and the results are the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackflow.config import DEFAULTS, Settings
from trackflow.operators.carried import Carried
from trackflow.operators.fleet import TOTALS, differences
from trackflow.plans.chain import chained
from trackflow.schema import DOUBLE, FLAG, INT, LONG, TEXT, row
from trackflow.session import Held
from trackflow.sources.versions import Versioned

INPUT = ["seq", "taxi_id", "event_s", "latitude", "longitude", "trip_status", "sent_at_utc_ms",
         "processed_at_utc_ms", "received_at_utc_ms"]
PROCESSED = row(
    seq=LONG, taxi_id=INT, event_s=LONG, latitude=DOUBLE, longitude=DOUBLE, trip_status=TEXT,
    sent_at_utc_ms=LONG, processed_at_utc_ms=LONG, received_at_utc_ms=LONG, speed=DOUBLE, is_valid_speed=FLAG,
    avg_speed=DOUBLE, total_distance_km=DOUBLE, distance_from_forbidden_city_km=DOUBLE,
    is_in_range=FLAG, geofence_alert=FLAG, speed_alert=FLAG,
)
PRIVATE = [f"_d_{n}" for n in TOTALS]  # differences that a row makes to the fleet totals
TOUCHED = "_touched_ms"


class ChainStep:
    """Processed rows of one micro-batch after another."""

    def __init__(self, out: str, cfg: Settings = DEFAULTS):
        self.out, self.cfg = out, cfg
        self.built: dict[tuple[str, ...], Carried] = {}  # the chain's steps, by the columns they begin with

    def _state(self, batch: DataFrame, batch_id: int) -> DataFrame | None:
        state = Versioned(batch.sparkSession, f"{self.out}/state", "taxi_id").read(batch_id - 1)
        if state is not None and self.cfg.state_ttl_s:
            state = state.where(F.col(TOUCHED) > F.unix_millis(F.current_timestamp()) - self.cfg.state_ttl_s * 1000)
        return state

    def size(self, batch: DataFrame, batch_id: int) -> int:
        """Rows that a micro-batch has to go through: its own, or the states if they are more."""
        states = Versioned(batch.sparkSession, f"{self.out}/state", "taxi_id").rows(batch_id - 1)
        return max(batch.count(), states)

    def rows(self, batch: DataFrame, batch_id: int, hold: Held) -> tuple[DataFrame, DataFrame]:
        """(processed rows with their fleet differences, states that the batch leaves).

        ``received_at_utc_ms`` is null where the pings have none. The computed rows are held."""
        if "received_at_utc_ms" not in batch.columns:
            batch = batch.withColumn("received_at_utc_ms", F.lit(None).cast("bigint"))
        pings = Carried.opened(batch.select(*INPUT), "taxi_id", "seq", self._state(batch, batch_id))
        names = tuple(pings.df.columns)
        if names in self.built:
            chain = self.built[names].again(pings)
        else:
            chain = self.built[names] = differences(chained(pings, self.cfg), self.cfg)
        chain = chain.like(hold(chain.df))
        left = chain.closing().withColumn(TOUCHED, F.unix_millis(F.current_timestamp()))
        return chain.rows().select(*PROCESSED.fieldNames(), *PRIVATE), left

    def close(self, states: DataFrame, batch_id: int) -> None:
        """Write the states; done last, so that a batch that fails before is computed from the old ones."""
        Versioned(states.sparkSession, f"{self.out}/state", "taxi_id").upsert(states, batch_id)
