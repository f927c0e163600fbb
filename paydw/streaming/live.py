"""Live streams of use events: daily totals, sessions, and what comes too late.

``withWatermark`` + ``window(ts, '1 day')`` + ``groupBy``: state is kept
per (day window, client) and dropped once the watermark passes the end of
the day, so it stays bounded by (days within the lateness) x clients.
Rows later than the watermark are dropped by Spark, by design; ``split_late``
goes before and writes them to a table of their own.

Output mode ``update`` through ``foreachBatch``: every micro-batch appends
the new values of the windows it changed, tagged with its batch id, to a
parquet table. ``read_latest_totals`` keeps the last version per key. A
retried batch appends the same rows with the same batch id, which the read
collapses, so the log is idempotent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paydw.functions.money import amount
from paydw.session import scratch_path


def _event_time(c):
    """An instant whose UTC wall clock is the event's wall clock (no session time zone involved).

    Event times without a zone are read as local wall clock; the watermark
    needs a TIMESTAMP, and day windows are aligned to UTC midnight, so the
    wall clock is carried over as UTC instead of being shifted by the
    session zone.
    """
    secs = (F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date")).cast("long") * 86400
            + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c))
    return F.timestamp_seconds(secs)  # whole seconds: enough for day windows and lateness


def daily_totals_stream(events: DataFrame, ts_col: str = "ts", client_col: str = "user_id",
                        value_col: str = "value", lateness: str = "1 day") -> DataFrame:
    x = events.select(_event_time(F.col(ts_col)).alias("_ts"),
                      F.col(client_col).cast("long").alias("id_cliente"), F.col(value_col).alias("_v"))
    day = F.date_from_unix_date(F.floor(F.unix_seconds(F.col("window.start")) / 86400).cast("int"))
    return (x.withWatermark("_ts", lateness)
             .groupBy(F.window("_ts", "1 day"), "id_cliente")
             .agg(F.count(F.lit(1)).alias("eventos"), F.sum(amount("_v")).alias("_total"))
             .select(day.alias("dia"), "id_cliente", "eventos",
                     F.col("_total").cast("double").alias("valor_total")))


def live_daily_totals(spark: SparkSession, events: DataFrame, out_path: str,
                      checkpoint: str | None = None, available_now: bool = True,
                      processing_time: str | None = None, **kw):
    """Start the live aggregation; returns the running query."""
    checkpoint = checkpoint or scratch_path(spark, "paydw-streams", "live-daily")
    agg = daily_totals_stream(events, **kw)

    def _batch(df: DataFrame, batch_id: int) -> None:
        df.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("append").parquet(out_path)

    w = agg.writeStream.outputMode("update").foreachBatch(_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "1 minute")
    return w.start()


def _latest(log: DataFrame) -> DataFrame:
    w = Window.partitionBy("dia", "id_cliente").orderBy(F.col("batch_id").desc())
    return log.dropDuplicates().withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1).drop("_r")


def read_latest_totals(spark: SparkSession, out_path: str, snapshot: str | None = None) -> DataFrame:
    """Last value of each (day, client) in the update log.

    With ``snapshot`` (written by ``snapshot_totals``) only log entries of
    later batches are read on top of it, so log files older than the
    snapshot can be expired.
    """
    log = spark.read.parquet(out_path)
    if snapshot is not None:
        snap = spark.read.parquet(snapshot)
        upto = snap.agg(F.max("batch_id").alias("m")).first()["m"]
        if upto is not None:
            log = snap.unionByName(log.where(F.col("batch_id") > F.lit(upto)))
    return _latest(log).drop("batch_id")


def snapshot_totals(spark: SparkSession, out_path: str, snapshot_path: str,
                    previous: str | None = None) -> None:
    """Write the latest value of every (day, client), with its batch id, to a new folder."""
    log = spark.read.parquet(out_path)
    if previous is not None:
        prev = spark.read.parquet(previous)
        upto = prev.agg(F.max("batch_id").alias("m")).first()["m"]
        if upto is not None:
            log = prev.unionByName(log.where(F.col("batch_id") > F.lit(upto)))
    _latest(log).write.parquet(snapshot_path)


def _seconds(length: str) -> int:
    """Whole seconds of an interval such as ``1 day`` or ``30 minutes``."""
    n, unit = length.split()
    return int(n) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]


def split_late(spark: SparkSession, events: DataFrame, out_path: str, checkpoint: str, ts_col: str = "ts",
               lateness: str = "1 day"):
    """Start the split of a stream into rows on time (``pontuais``) and late ones (``atrasados``).

    A row is late if its event time lies more than ``lateness`` before the
    latest one of the batches before; rows without a time are on time. A batch
    writes its rows and its latest time (one row) to folders of its own, so a
    batch that is run again replaces what it wrote.
    """
    late_by = _seconds(lateness)

    def batch(df: DataFrame, n: int) -> None:
        at, high = F.unix_seconds(_event_time(F.col(ts_col))), None
        if n:
            marks = spark.read.schema("latest long, batch long").parquet(f"{out_path}/marcas").where(F.col("batch") < n)
            high = marks.agg(F.max("latest")).first()[0]
        late = F.coalesce(at < F.lit(high - late_by), F.lit(False)) if high is not None else F.lit(False)
        df.agg(F.max(at).alias("latest")).write.mode("overwrite").parquet(f"{out_path}/marcas/batch={n}")
        df.where(~late).write.mode("overwrite").parquet(f"{out_path}/pontuais/batch={n}")
        df.where(late).write.mode("overwrite").parquet(f"{out_path}/atrasados/batch={n}")

    return events.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def live_sessions(events: DataFrame, out_path: str, checkpoint: str, gap: str = "30 minutes", ts_col: str = "ts",
                  client_col: str = "user_id", value_col: str = "value", lateness: str = "1 day"):
    """Start the stream of closed sessions per client: ``(id_cliente, inicio, fim, eventos, valor_total)``.

    A session ends ``gap`` after its last event (``fim``) and is written once
    the watermark has passed that. State holds open sessions only. Each batch
    writes a folder of its own.
    """
    x = events.select(_event_time(F.col(ts_col)).alias("_ts"), F.col(client_col).cast("long").alias("id_cliente"),
                      F.col(value_col).alias("_v"))
    sessions = x.withWatermark("_ts", lateness).groupBy(F.session_window("_ts", gap), "id_cliente").agg(
        F.count(F.lit(1)).alias("eventos"), F.sum(amount("_v")).alias("_total"))
    rows = sessions.select("id_cliente", *[F.unix_seconds(F.col(f"session_window.{a}")).alias(b)
                                           for a, b in (("start", "inicio"), ("end", "fim"))],
                           "eventos", F.col("_total").cast("double").alias("valor_total"))

    def batch(df: DataFrame, n: int) -> None:
        df.write.mode("overwrite").parquet(f"{out_path}/batch={n}")

    return rows.writeStream.outputMode("append").foreachBatch(batch).option("checkpointLocation", checkpoint) \
        .trigger(availableNow=True).start()
