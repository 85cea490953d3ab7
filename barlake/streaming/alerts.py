"""Tick streams: a durable tick table and threshold alerts with state across restarts.

Alerts compare each tick with the one before it, across micro-batches. Every micro-batch is evaluated by the same
chunked operator as a batch table (``operators.rules``), so a symbol that makes up a third of a batch is still spread over
many tasks, and no rows pass through Python. Ticks in order need one row per instrument of the past: its last tick.

A tick that arrives late changes two verdicts, its own and that of the tick after it. The history of ticks is foldered by a
hash of the instrument and by day, and a small index holds the days on which each instrument has ticks. Late ticks read from
the history the day they belong to and the nearest days with ticks before and after it, however long the history is. The
verdicts of new ticks and of those that follow a new tick replace the earlier ones, so the alerts always equal those of a
batch job over all ticks received. Everything a batch writes goes to runs that are merged as they grow (``runs``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.utils import AnalysisException

from barlake.operators.chunks import CHUNK, TICK_CHUNK_SECONDS, join_parameters, with_previous, with_tick_chunk
from barlake.operators.rules import INSTRUMENT, SPOT, TICK_ORDER, event_lines, rule_matches, signal_events, threshold_alerts
from barlake.schema import TICK
from barlake.session import scratch_scope, stored, subfolders
from barlake.sources.klines import missing_path
from barlake.sources.layers import observe_rows, observed_rows
from barlake.streaming.runs import WIDTH, Runs

# Fixed value: default seconds between polls of a continuous run.
POLL_SECONDS = 5
_JUDGED = "exchange string, symbol string, event_time timestamp, price double, batch_id bigint"
_DAYS = "exchange string, symbol string, day date, bucket int"
_CYCLE = "tick_count bigint, alert_count bigint, late_count bigint, batch_id bigint"
HISTORY_BUCKETS = 16
_FOLDERS = ["bucket", "day"]
_PRICE_SCHEMA = "exchange string, symbol string, event_time timestamp, price double, batch_id bigint"


def tick_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Ticks landed as Parquet files, as a stream."""
    reader = spark.readStream.schema(TICK)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def _trigger(continuous: bool, poll_seconds: float) -> dict:
    return {"processingTime": f"{poll_seconds} seconds"} if continuous else {"availableNow": True}


def start_tick_sink(
    ticks: DataFrame, path: str, checkpoint: str, continuous: bool = False, poll_seconds: float = POLL_SECONDS
) -> StreamingQuery:
    """Write ticks exactly once, foldered by exchange, symbol and event date."""
    return (
        ticks.withColumn("date", F.to_date("event_time"))
        .writeStream.format("parquet")
        .partitionBy("exchange", "symbol", "date")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(continuous, poll_seconds))
        .start()
    )


def _last_prices(spark: SparkSession, state: str, batch_id: int) -> DataFrame:
    """The last tick of each instrument as of the batch before ``batch_id``.

    Two folders take turns: a batch reads its predecessor's and overwrites the other, so repeating a failed batch
    starts from the same state and writes the same state.
    """
    try:
        stored = spark.read.schema(_PRICE_SCHEMA).parquet(f"{state}/prices/slot{(batch_id - 1) % 2}")
    except AnalysisException as error:
        if not missing_path(error):
            raise
        stored = spark.createDataFrame([], _PRICE_SCHEMA)
    return stored.where(F.col("batch_id") == batch_id - 1).drop("batch_id")


def _next_prices(prior: DataFrame, ticks: DataFrame) -> DataFrame:
    newest = F.max_by(F.struct("event_time", "price"), F.struct("event_time", "_rank", "price"))
    known = prior.withColumn("_rank", F.lit(None).cast("timestamp"))
    seen = ticks.select(*INSTRUMENT, "event_time", "price", F.col("ingested_at").alias("_rank"))
    return known.unionByName(seen).groupBy(*INSTRUMENT).agg(newest.alias("_t")).select(*INSTRUMENT, "_t.*")


_KEY = [*INSTRUMENT, "event_time", "price"]


def _late_instruments(ticks: DataFrame, prior: DataFrame) -> DataFrame:
    """Instruments with ticks older than their last judged one (``_since``: the first of them) and how many."""
    seen = prior.select(*INSTRUMENT, F.col("event_time").alias("_seen"))
    late = join_parameters(ticks, seen, INSTRUMENT, spread=["event_time"]).where(F.col("event_time") <= F.col("_seen"))
    return late.groupBy(*INSTRUMENT).agg(
        F.min("event_time").alias("_since"), F.count_if(F.col("event_time") < F.col("_seen")).alias("_late")
    )


# History.


def _foldered(ticks: DataFrame) -> DataFrame:
    bucket = F.pmod(F.xxhash64(*INSTRUMENT), F.lit(HISTORY_BUCKETS)).cast("int")
    return ticks.withColumns({"bucket": bucket, "day": F.to_date("event_time")})


def _write_history(ticks: DataFrame, path: str) -> None:
    ticks.hint("rebalance", *_FOLDERS).write.mode("overwrite").partitionBy(*_FOLDERS).parquet(path)


def _write_days(days: DataFrame, path: str) -> None:
    days.distinct().write.mode("overwrite").partitionBy("bucket").parquet(path)


def neighbour_days(late: DataFrame, days: DataFrame) -> DataFrame:
    """Instrument, bucket and day of the late ticks' own days and of the nearest ones with stored ticks around them."""
    along = Window.partitionBy(*INSTRUMENT).orderBy("day")
    known = days.select(*INSTRUMENT, "bucket", "day", F.col("day").alias("_stored"), F.lit(None).cast("date").alias("_wanted"))
    asked = late.select(*INSTRUMENT, "bucket", "day", F.lit(None).cast("date").alias("_stored"), F.col("day").alias("_wanted"))
    each = known.unionByName(asked).groupBy(*INSTRUMENT, "bucket", "day").agg(F.max("_stored").alias("_stored"), F.max("_wanted").alias("_wanted"))
    before = F.last("_stored", ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, -1))
    after = F.first("_stored", ignorenulls=True).over(along.rowsBetween(1, Window.unboundedFollowing))
    near = each.withColumn("_near", F.array("_stored", before, after)).where("_wanted IS NOT NULL")
    return near.select(*INSTRUMENT, "bucket", F.explode(F.array_compact("_near")).alias("day")).distinct()


def near_history(late: DataFrame, ticks: Runs, days: Runs, until: int) -> DataFrame:
    """Stored ticks of the late instruments on the days next to the late ticks; only their folders are listed and read.

    ``late`` holds the ticks of those instruments in the current batch, with bucket and day.
    """
    spark = ticks.spark
    buckets = [row.bucket for row in late.select("bucket").distinct().collect()]
    indexes = [f"{run}/bucket={b}" for run in days.live(until) for b in buckets if f"bucket={b}" in subfolders(spark, run)]
    if not indexes:
        return spark.createDataFrame([], TICK)
    index = spark.read.schema("exchange string, symbol string, day date").parquet(*indexes)
    index = _foldered(index.withColumn("event_time", F.col("day"))).select(*INSTRUMENT, "bucket", "day")
    instruments = late.select(*INSTRUMENT).distinct()
    wanted = stored(neighbour_days(late, index.join(instruments, INSTRUMENT, "left_semi")), "near-days")
    by_bucket = {row.bucket: {f"day={day}" for day in row.days} for row in wanted.groupBy("bucket").agg(F.collect_set("day").alias("days")).collect()}
    paths = []
    for run in ticks.live(until):
        for bucket, folders in by_bucket.items():
            paths += [f"{run}/bucket={bucket}/{day}" for day in subfolders(spark, f"{run}/bucket={bucket}") if day in folders]
    if not paths:
        return spark.createDataFrame([], TICK)
    rows = spark.read.schema(TICK).parquet(*paths).withColumn("day", F.to_date("event_time"))
    return rows.join(wanted.select(*INSTRUMENT, "day"), [*INSTRUMENT, "day"], "left_semi").select(*TICK.fieldNames())


def _judged_again(fresh: DataFrame, near: DataFrame, chunk_seconds: int) -> DataFrame:
    """``fresh`` ticks of instruments with late ticks, and stored ones that follow them, with ``previous_price``.

    ``near`` holds whole days of stored ticks, the nearest before and after each fresh tick among them, so neighbours of a
    fresh tick are always right. Ticks that share instrument, time and price are judged together, since a stored alert does
    not tell them apart.
    """
    rows = fresh.select(*TICK.fieldNames(), F.lit(True).alias("_new")).unionByName(near.withColumn("_new", F.lit(False)))
    paired = rows.withColumn("_pair", F.struct("price", "_new"))
    compared = with_previous(with_tick_chunk(paired, chunk_seconds), INSTRUMENT, TICK_ORDER, "_pair", "_previous")
    touched = F.col("_new") | F.coalesce("_previous._new", F.lit(False))
    # A chunk follows from the time, so ticks of one key lie together already and are not shuffled again.
    same = Window.partitionBy(*INSTRUMENT, CHUNK, "event_time", "price")
    return (
        compared.withColumn("_touched", F.max(touched).over(same))
        .where("_touched")
        .select(*TICK.fieldNames(), "_new", F.col("_previous.price").alias("previous_price"))
    )


# Batches.


class _Logs:
    """Everything an alert stream writes, each as runs."""

    def __init__(self, spark: SparkSession, alerts_path: str, state: str, width: int = WIDTH):
        self.ticks, self.days = Runs(spark, f"{state}/ticks", width), Runs(spark, f"{state}/days", width)
        self.cycles, self.judged = Runs(spark, f"{state}/cycles", width), Runs(spark, f"{alerts_path}/judged", width)
        self.events = Runs(spark, f"{alerts_path}/events", width)

    def merge_before(self, batch_id: int) -> None:
        tick = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in TICK.fields) + ", bucket int, day date"
        self.ticks.merge_before(batch_id, lambda parts, out: _write_history(self.ticks.read(parts, tick), out))
        self.days.merge_before(batch_id, lambda parts, out: _write_days(self.days.read(parts, _DAYS), out))
        for log, schema in ((self.cycles, _CYCLE), (self.judged, _JUDGED)):
            log.merge_before(
                batch_id, lambda parts, out, log=log, schema=schema: log.read(parts, schema).hint("rebalance").write.mode("overwrite").parquet(out)
            )
        self.events.merge_before(
            batch_id, lambda parts, out: _alerts_of(self.events, parts).hint("rebalance").write.mode("overwrite").json(out, ignoreNullFields=False)
        )


def _alert_batch(
    alerts_path: str, state: str, rules: DataFrame, interval: str, chunk_seconds: int, width: int = WIDTH
) -> Callable[[DataFrame, int], None]:
    def evaluate(batch: DataFrame, batch_id: int) -> None:
        with scratch_scope(batch.sparkSession):
            judge(batch, batch_id, _Logs(batch.sparkSession, alerts_path, state, width))

    def judge(batch: DataFrame, batch_id: int, logs: _Logs) -> None:
        spark = batch.sparkSession
        prior = _last_prices(spark, state, batch_id)
        number = F.lit(batch_id).cast("bigint").alias("batch_id")
        # Every target is named by the batch, so a repeated batch replaces what it wrote before.
        _write_history(_foldered(batch.select(*TICK.fieldNames())), logs.ticks.path(batch_id))
        ticks = spark.read.schema(TICK).parquet(logs.ticks.path(batch_id)).select(*TICK.fieldNames())
        _write_days(_foldered(ticks).select(*INSTRUMENT, "day", "bucket").where("day IS NOT NULL"), logs.days.path(batch_id))
        late = stored(_late_instruments(ticks, prior), "late")
        late_count = late.agg(F.coalesce(F.sum("_late"), F.lit(0))).first()[0]
        if late.isEmpty():
            events = threshold_alerts(ticks, rules, prior, interval, chunk_seconds)
            again = spark.createDataFrame([], _JUDGED)
        else:
            instruments = late.select(*INSTRUMENT)
            in_order = ticks.join(instruments, INSTRUMENT, "left_anti")
            fresh = ticks.join(instruments, INSTRUMENT, "left_semi")
            near = near_history(_foldered(fresh), logs.ticks, logs.days, batch_id - 1)
            judged = stored(_judged_again(fresh, near, chunk_seconds), "judged")
            observed = judged.drop("_new").withColumn("interval", F.lit(interval))
            events = threshold_alerts(in_order, rules, prior.join(instruments, INSTRUMENT, "left_anti"), interval, chunk_seconds)
            events = events.unionByName(signal_events(rule_matches(observed, rules, spread="event_time")))
            again = judged.where("NOT _new").select(*_KEY).distinct().select(*_KEY, number)
        again.write.mode("overwrite").parquet(logs.judged.path(batch_id))
        lines, alerts = observe_rows(event_lines(events))
        lines.write.mode("overwrite").text(logs.events.path(batch_id))
        counts = ticks.agg(F.count("*").alias("tick_count")).select(
            "tick_count", F.lit(observed_rows(alerts)).cast("bigint").alias("alert_count"), F.lit(late_count).cast("bigint").alias("late_count"), number
        )
        counts.write.mode("overwrite").parquet(logs.cycles.path(batch_id))
        _next_prices(prior, ticks).select("*", number).write.mode("overwrite").parquet(f"{state}/prices/slot{batch_id % 2}")
        logs.merge_before(batch_id)

    return evaluate


def start_alerts(
    ticks: DataFrame,
    rules: DataFrame,
    alerts_path: str,
    checkpoint: str,
    continuous: bool = False,
    poll_seconds: float = POLL_SECONDS,
    interval: str = SPOT,
    chunk_seconds: int = TICK_CHUNK_SECONDS,
    width: int = WIDTH,
) -> StreamingQuery:
    """Evaluate rules on a tick stream; one JSON line per alert under ``alerts_path/events``, a run per batch.

    ``width`` runs are merged into one. Read the result with ``read_alerts``, which leaves out verdicts that a later batch
    has replaced.
    """
    evaluate = _alert_batch(alerts_path, f"{checkpoint}/state", rules, interval, chunk_seconds, width)
    return (
        ticks.writeStream.foreachBatch(evaluate)
        .option("checkpointLocation", f"{checkpoint}/progress")
        .trigger(**_trigger(continuous, poll_seconds))
        .start()
    )


def run_once(
    spark: SparkSession,
    source: str,
    rules: DataFrame,
    ticks_path: str,
    alerts_path: str,
    checkpoint: str,
    files_per_batch: int | None = None,
    chunk_seconds: int = TICK_CHUNK_SECONDS,
) -> dict[str, int]:
    """Process everything that has arrived, then stop; returns tick and alert counts of this run."""
    ticks = tick_stream(spark, source, files_per_batch)
    state = f"{checkpoint}/alerts"
    done = _last_batch(cycle_counts(spark, state))
    stored = start_tick_sink(ticks, ticks_path, f"{checkpoint}/ticks")
    alerts = start_alerts(ticks, rules, alerts_path, state, chunk_seconds=chunk_seconds)
    for query in (stored, alerts):
        query.awaitTermination()
    fresh = cycle_counts(spark, state).where(F.col("batch_id") > done)
    return fresh.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tick_count", "alert_count")]
    ).first().asDict()


def _last_batch(cycles: DataFrame) -> int:
    return cycles.agg(F.coalesce(F.max("batch_id"), F.lit(-1))).first()[0]


def cycle_counts(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Ticks, alerts raised and late ticks of every micro-batch of an alert stream."""
    cycles = Runs(spark, f"{checkpoint}/state/cycles")
    return cycles.read(cycles.live(), _CYCLE)


ALERT_SCHEMA = (
    "signal_name string, exchange string, symbol string, interval string, event_time timestamp, "
    "observed_value double, threshold double, direction string, source string, metadata map<string,string>, "
    "batch_id bigint"
)


def _alerts_of(runs: Runs, paths: list[str]) -> DataFrame:
    """Alert lines of some runs. Those of single batches get the batch from their folder, merged ones carry it."""
    if not paths:
        return runs.spark.createDataFrame([], ALERT_SCHEMA)
    rows = runs.spark.read.schema(f"{ALERT_SCHEMA}, size int, run bigint").option("basePath", runs.root).json(paths)
    return rows.withColumn("batch_id", F.coalesce("batch_id", "run")).drop("size", "run")


def read_alerts(spark: SparkSession, alerts_path: str) -> DataFrame:
    """The alerts that hold, with the batch that raised them."""
    events = Runs(spark, f"{alerts_path}/events")
    alerts = _alerts_of(events, events.live())
    judged = Runs(spark, f"{alerts_path}/judged")
    replaced = judged.read(judged.live(), _JUDGED).groupBy(*INSTRUMENT, "event_time", F.col("price").alias("observed_value")).agg(F.max("batch_id").alias("_judged"))
    latest = alerts.join(replaced, [*INSTRUMENT, "event_time", "observed_value"], "left")
    return latest.where(F.col("_judged").isNull() | (F.col("batch_id") >= F.col("_judged"))).select(*alerts.columns)


def read_ticks(spark: SparkSession, ticks_path: str) -> DataFrame:
    return spark.read.schema(TICK).parquet(ticks_path).select(*TICK.fieldNames())

