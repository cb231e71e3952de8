"""Status observations as a stream: each ad's lifecycle is state, kept up to date row by row.

An ad's state holds the six fields of its lifecycle and the place of its last observation, and a list of its observations. A row after
the last one is one step; a row that comes late is looked up in the list: where its time and id are known it changes nothing, else only
that ad is folded again from its list. So a batch costs what its rows and the ads with late or repeated rows hold, whatever the log has grown
to. State is asked for by ad and batch, not by row: each question is a message between the Python worker and the JVM. Lateness is
unbounded in the domain, so nothing expires.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType, StructField, StructType, TimestampType

from admill.operators.lifecycle import MISSES
from admill.operators.relational import latest_per_key

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
COLUMNS = ["observation_id", "ad_id", "observed_at", "observed_status", "poll_complete", "reported_stop_date"]
NEW = ("unknown", None, None, None, None, 0, 0)


def step(now: tuple, at: Any, status: str | None, complete: bool | None, stop: Any, misses: int = MISSES) -> tuple:
    """(state, last_active_at, first_missing_at, event_at, reported_stop_date, misses in a row, observations) after one more observation."""
    state, active, missing, event, stopped, run, n = now
    if status == "active":
        return ("active", at, None, event, stopped, 0, n + 1)
    if status == "explicitly_inactive":
        return ("inactive_explicit", active, missing, at, stop, 0, n + 1)
    if status == "not_observed" and complete:
        run, missing = run + 1, missing or at
        if state != "inactive_explicit" and run >= misses:
            state, event = "inactive_inferred", missing
    return (state, active, missing, event, stopped, run, n + 1)


class Lifecycles(StatefulProcessor):
    """Yields each new observation once, and each touched ad's state after the batch."""

    def __init__(self, observation: StructType, misses: int = MISSES):
        self.kinds, self.misses = {f.name: f.dataType for f in observation}, misses

    def init(self, handle: StatefulProcessorHandle) -> None:
        at, number, stop = self.kinds["observed_at"], self.kinds["observation_id"], self.kinds["reported_stop_date"]
        fields = [("state", StringType()), ("active", at), ("missing", at), ("event", at), ("stopped", stop), ("run", IntegerType()), ("n", LongType()), ("last_at", at), ("last_id", number)]
        self.now = handle.getValueState("now", StructType([StructField(n, t) for n, t in fields]))
        self.seen = handle.getListState("seen", StructType([StructField("at", at), StructField("id", number), StructField("status", StringType()), StructField("complete", BooleanType()), StructField("stop", stop)]))

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        held = self.now.get()
        held = (*NEW, None, None) if held is None else tuple(held)
        now, last = held[:7], held[7:]
        told: dict[tuple, Row] = {}
        for r in rows:  # of one ad in one batch
            told.setdefault((r.observed_at, r.observation_id), r)
        places, seen = sorted(told), None
        if last[0] is not None and places[0] <= last:
            seen = [tuple(o) for o in self.seen.get()]
            known = {o[:2] for o in seen}
            places = [p for p in places if p not in known]
        if not places:
            return
        fresh = [told[p] for p in places]
        added = [(*p, r.observed_status, r.poll_complete, r.reported_stop_date) for p, r in zip(places, fresh)]
        self.seen.appendList(added)
        if seen is not None and places[0] < last:
            now, last, added = NEW, max(last, places[-1]), sorted([*seen, *added], key=lambda o: o[:2])
        else:
            last = places[-1]
        for o in added:
            now = step(now, o[0], *o[2:], self.misses)
        self.now.update((*now, *last))
        yield Row(ad_id=key[0], fresh=[Row(**{c: r[c] for c in COLUMNS if c != "ad_id"}) for r in fresh], state=now[0], last_active_at=now[1], first_missing_at=now[2], event_at=now[3], reported_stop_date=now[4], consecutive_complete_misses=now[5], observation_count=now[6])

    def close(self) -> None:
        pass


def updates(observations: DataFrame, misses: int = MISSES) -> DataFrame:
    """Touched ads' states with their new observations, from a stream of COLUMNS. Repeats are told apart by observation_id and time."""
    timed = isinstance(observations.schema["observed_at"].dataType, TimestampType)
    if timed:  # state holds times as numbers: they compare alike whatever zone a worker runs in
        observations = observations.withColumn("observed_at", F.unix_micros("observed_at"))
    kinds = {f.name: f.dataType for f in observations.schema}
    at, stop = kinds["observed_at"], kinds["reported_stop_date"]
    fresh = StructType([StructField(c, kinds[c]) for c in COLUMNS if c != "ad_id"])
    fields = [("ad_id", kinds["ad_id"]), ("fresh", ArrayType(fresh)), ("state", StringType()), ("last_active_at", at), ("first_missing_at", at), ("event_at", at), ("reported_stop_date", stop), ("consecutive_complete_misses", LongType()), ("observation_count", LongType())]
    observations.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    told = observations.filter(F.col("observed_at").isNotNull() & F.col("observation_id").isNotNull()).select(*COLUMNS)
    out = told.groupBy("ad_id").transformWithState(Lifecycles(observations.schema, misses), StructType([StructField(n, t) for n, t in fields]), "Update", "None")
    if not timed:
        return out
    read = lambda o: o.withField("observed_at", F.timestamp_micros(o["observed_at"]))
    return out.withColumns({c: F.timestamp_micros(c) for c in ("last_active_at", "first_missing_at", "event_at")}).withColumn("fresh", F.transform("fresh", read))


def run(observations: DataFrame, log: str, states: str, checkpoint: str, counts: str | None = None, misses: int = MISSES) -> StreamingQuery:
    """Starts the stream over what is available: new observations into log, touched ads' states into states, each epoch in a folder of its own that a retry replaces.

    counts: where to note the number of new observations of each epoch, for `due`.
    """

    def batch(rows: DataFrame, epoch: int) -> None:
        rows.persist()
        rows.select("ad_id", F.explode("fresh").alias("o")).select("ad_id", "o.*").write.mode("overwrite").parquet(f"{log}/epoch={epoch}")
        rows.drop("fresh").write.mode("overwrite").parquet(f"{states}/epoch={epoch}")
        if counts:
            rows.agg(F.coalesce(F.sum(F.size("fresh")), F.lit(0)).alias("n_new")).write.mode("overwrite").parquet(f"{counts}/epoch={epoch}")
        rows.unpersist()

    return updates(observations, misses).writeStream.outputMode("update").foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current_states(spark: SparkSession, states: str) -> DataFrame:
    """The latest state of each ad over all epochs."""
    return latest_per_key(spark.read.parquet(states), ["ad_id"], [F.desc("epoch")]).drop("epoch")


def due(spark: SparkSession, counts: str, done: int = -1, least: int = 50) -> DataFrame:
    """One row: new observations since epoch `done`, the last epoch among them, and whether there are enough for the next model run."""
    out = spark.read.parquet(counts).filter(F.col("epoch") > done).agg(F.coalesce(F.sum("n_new"), F.lit(0)).alias("n_new"), F.max("epoch").alias("epoch"))
    return out.withColumn("due", F.col("n_new") >= least)
