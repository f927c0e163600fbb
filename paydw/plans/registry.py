"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the driver tables of ``sf_dir`` through the warehouse
built from them (``warehouse_for_sf``), or the tables directly; none runs on
fixed inputs and none caps or samples rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paydw.operators.contracts import resolve_contract
from paydw.operators.skew import hot_keys
from paydw.operators.summary import daily_summary
from paydw.plans import explore, revenue, segments, timeseries, trends, usage, volume
from paydw.plans.common import drop_partition, materialized
from paydw.plans.warehouse import warehouse_for_sf
from paydw.sources.driver import staging_from_sf, use_events

Query = Callable[[SparkSession, str], DataFrame]


def _wh(fn) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(warehouse_for_sf(spark, sf_dir))
    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


def _dense(wh):
    # the join and the aggregate run once: bounds, axis and facts of the dense form read their result
    sparse = materialized(wh, "segment_day_all", segments.segment_day_all)
    return materialized(wh, "segment_day_dense", lambda w: segments.dense_days(sparse))


def _split(wh):
    return materialized(wh, "series_split",
                        lambda w: timeseries.series_split(w, dense=_dense(w)))


def _daily(wh):
    return materialized(wh, "revenue_day", revenue.revenue_day)


def _type_trend(fn) -> Query:
    return _wh(lambda wh: fn(wh, daily=_daily(wh)))


def _seg_trend(fn) -> Query:
    return _wh(lambda wh: fn(wh, dense=_dense(wh)))


def _ts(fn) -> Query:
    return _wh(lambda wh: fn(wh, split=_split(wh)))


def _resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J5 straight from staging: transactions with the contract in force."""
    st = staging_from_sf(spark, sf_dir)
    return resolve_contract(st.transacoes, st.contratos,
                            hot_clients=hot_keys(st.transacoes, "id_cliente"))


def _one_client(wh) -> DataFrame:
    """F1 on volume: the client with the smallest id in the summary."""
    first = wh.fact_dia.agg(F.min("id_cliente")).first()[0]
    return volume.volume_client_day(wh, id_cliente=first)


def _one_year(wh) -> DataFrame:
    """F2 on use: the year after the first day with data."""
    year = wh.fact_dia.agg(F.year(F.min("data_movimentacao"))).first()[0]
    return usage.usage_client_day_type(wh, ano=year + 1)


def _merge_insert_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3 run twice with the same staging data into a fresh table: the table equals one run."""
    import uuid

    from paydw.operators.key_index import KeyIndex, indexed_merge
    from paydw.session import scratch_path

    st = staging_from_sf(spark, sf_dir)
    base = scratch_path(spark, "paydw-merge-check", uuid.uuid4().hex[:12])
    src = resolve_contract(st.transacoes, st.contratos)
    keys = KeyIndex(spark, f"{base}/keys", ("id_transacao", "id_cliente"))
    for run in (1, 2):
        indexed_merge(src, f"{base}/fact", keys, run)
    return spark.read.parquet(f"{base}/fact")


def _stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New transactions arrive as files; an availableNow stream resolves and merges them."""
    import uuid

    from paydw.plans.warehouse import Warehouse
    from paydw.session import scratch_path
    from paydw.sources.driver import orders_to_transacoes, staging_from_sf
    from paydw.streaming.ingest import staging_stream

    sf_dir = sf_dir.rstrip("/")
    st = staging_from_sf(spark, sf_dir)
    run = scratch_path(spark, "paydw-stream-ingest", uuid.uuid4().hex[:12])
    wh = Warehouse(spark, run)
    wh.create_tables()
    wh.load_clientes(st.clientes)
    wh.load_contratos(st.contratos)
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    stream = staging_stream(spark, f"{sf_dir}/orders*.parquet", orders.schema, orders_to_transacoes)
    wh.ingest(stream, f"{run}/_checkpoint", "9999-01-01").awaitTermination()
    return drop_partition(wh.fact)


_INCREMENTAL: dict = {}


def _incremental(spark: SparkSession, sf_dir: str):
    """A warehouse loaded in three runs that cut every day, with late clients, contracts and open days.

    Run 1 (interval): a third of the transactions, without the clients whose
    id divides by 5 and their contracts; days before 1997 are closed. Run 2
    (interval): another third and what was missing; days before mid-1999 are
    closed. Run 3 (ingest stream): the rest; all days are closed. Facts,
    summary and calendar must equal those of one run over everything.
    """
    import uuid

    from paydw.plans.warehouse import Warehouse
    from paydw.session import scratch_path
    from paydw.sources.driver import Staging, orders_to_transacoes, staging_from_sf
    from paydw.streaming.ingest import staging_stream

    sf_dir = sf_dir.rstrip("/")
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _INCREMENTAL:
        st = staging_from_sf(spark, sf_dir)
        run = scratch_path(spark, "paydw-incremental", uuid.uuid4().hex[:12])
        wh = Warehouse(spark, run)
        part, late = F.col("id_transacao") % 3, F.col("id_cliente") % 5 == 0
        wh.create_tables()
        wh.run_interval(Staging(st.clientes.where(F.col("id") % 5 != 0), st.contratos.where(~late),
                                st.transacoes.where(part == 0)), end_date="last", process_date="1997-01-01")
        wh.run_interval(Staging(st.clientes, st.contratos, st.transacoes.where(part == 1)),
                        end_date="last", process_date="1999-06-15")
        orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
        stream = staging_stream(spark, f"{sf_dir}/orders*.parquet", orders.schema,
                                lambda df: orders_to_transacoes(df).where(part == 2))
        wh.ingest(stream, f"{run}/_checkpoint", "9999-01-01").awaitTermination()
        _INCREMENTAL[key] = wh
    return _INCREMENTAL[key]


def _stream_daily_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily totals per client on the event stream, watermark-bounded state."""
    import uuid

    from paydw.session import scratch_path
    from paydw.streaming.live import live_daily_totals, read_latest_totals

    sf_dir = sf_dir.rstrip("/")
    run = scratch_path(spark, "paydw-stream-live", uuid.uuid4().hex[:12])
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    stream = spark.readStream.schema(ev.schema).parquet(f"{sf_dir}/events*.parquet")
    q = live_daily_totals(spark, stream, f"{run}/totals", checkpoint=f"{run}/_checkpoint")
    q.awaitTermination()
    return read_latest_totals(spark, f"{run}/totals")


def _late_stream(spark: SparkSession, sf_dir: str) -> str:
    """The event stream in three batches: the month's first half, its second, and every fiftieth event late."""
    import uuid

    from paydw.session import scratch_path
    from paydw.streaming.live import split_late

    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LATE:
        run = scratch_path(spark, "paydw-stream-late", uuid.uuid4().hex[:12])
        ev = spark.read.parquet(f"{sf_dir}/events.parquet")
        late, first = F.col("event_id") % 50 == 0, F.dayofmonth("ts") <= 15
        for n, rows in enumerate((ev.where(~late & first), ev.where(~late & ~first), ev.where(late))):
            rows.write.parquet(f"{run}/in/b={n}")
            stream = spark.readStream.schema(ev.schema).parquet(f"{run}/in/*")
            split_late(spark, stream, f"{run}/out", f"{run}/_split").awaitTermination()
        _LATE[key] = run
    return _LATE[key]


_LATE: dict = {}


def _stream_late_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that came later than the watermark, kept in their own table."""
    run = _late_stream(spark, sf_dir.rstrip("/"))
    return spark.read.parquet(f"{run}/out/atrasados").select("event_id", "user_id", "event_type", "value")


def _stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed sessions (30 minutes without an event) per client of the rows on time."""
    import uuid

    from paydw.streaming.live import live_sessions

    run, sf_dir = _late_stream(spark, sf_dir.rstrip("/")), sf_dir.rstrip("/")
    out = f"{run}/sessions-{uuid.uuid4().hex[:8]}"
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    live_sessions(spark.readStream.schema(schema).parquet(f"{run}/out/pontuais/*"), out, f"{out}/_ck").awaitTermination()
    return spark.read.parquet(out).drop("batch")


def _trend_incremental(wh) -> DataFrame:
    """T5 from kept sums: all months but the last, then the last one alone."""
    import uuid

    path = f"{wh.path}/_trend_sums-{uuid.uuid4().hex[:8]}"
    months = sorted(r[0] for r in wh.fact_dia.select("mes_ref").distinct().collect())  # one row a month
    for some in (months[:-1], months[-1:]):
        if some:
            trends.keep_trend_sums(wh, path, some)
    return trends.trend_of_kept_sums(wh, path)


def _event_use_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return usage.event_use_days(spark, use_events(spark, sf_dir))


QUERIES: dict[str, Query] = {
    # ETL outputs
    "dim_clientes": _wh(lambda wh: wh.clientes),
    "dim_contratos": _wh(lambda wh: wh.contratos),
    "calendar": _wh(lambda wh: wh.tempo),
    "resolve_contract": lambda spark, sf_dir: _resolved(spark, sf_dir),
    "daily_summary": lambda spark, sf_dir: daily_summary(_resolved(spark, sf_dir)),
    "warehouse_fact": _wh(lambda wh: drop_partition(wh.fact)),
    "warehouse_summary": _wh(lambda wh: drop_partition(wh.fact_dia)),
    "merge_insert_only": _merge_insert_only,
    # incremental runs that cut days
    "incremental_fact": lambda spark, sf_dir: drop_partition(_incremental(spark, sf_dir).fact),
    "incremental_summary": lambda spark, sf_dir: drop_partition(_incremental(spark, sf_dir).fact_dia),
    "incremental_calendar": lambda spark, sf_dir: _incremental(spark, sf_dir).tempo,
    "incremental_revenue_day": lambda spark, sf_dir: revenue.revenue_day(_incremental(spark, sf_dir)),
    # volume (G2, W1, J1 + F7, G10-G11)
    "daily_join_calendar": _wh(volume.daily_join_calendar),
    "daily_with_calendar": _wh(volume.daily_with_calendar),
    "daily_with_client_contract": _wh(segments.daily_with_client_contract),
    "volume_client_day": _wh(volume.volume_client_day),
    "volume_one_client": _wh(_one_client),
    "volume_moving_avg": _wh(volume.volume_moving_avg),
    "date_bounds": _wh(volume.date_bounds),
    # use (G3, W2, P8, W4)
    "usage_client_day_type": _wh(usage.usage_client_day_type),
    "usage_one_year": _wh(_one_year),
    "usage_window": _wh(usage.usage_window),
    "usage_dense": _wh(usage.usage_dense),
    "usage_pivot_type": _wh(usage.usage_pivot_type),
    "usage_gaps": _wh(usage.usage_gaps),
    "event_use_days": _event_use_days,
    "usage_streaks": _wh(usage.usage_streaks),
    "event_streaks": lambda spark, sf_dir: usage.event_streaks(use_events(spark, sf_dir)),
    # streaming
    "stream_ingest": _stream_ingest,
    "stream_daily_totals": _stream_daily_totals,
    "stream_late_events": _stream_late_events,
    "stream_sessions": _stream_sessions,
    # revenue (G4, G5)
    "revenue_client_day": _wh(revenue.revenue_client_day),
    "revenue_day": _wh(revenue.revenue_day),
    # segments (G6-G8, W3)
    "clients_per_segment": _wh(segments.clients_per_segment),
    "segment_day": _wh(segments.segment_day),
    "segment_day_dense": _wh(_dense),
    "segment_revenue_day": _wh(segments.segment_revenue_day),
    # trends (T1-T9)
    "trend_value_type": _type_trend(trends.trend_value_type),
    "trend_revenue_type": _type_trend(trends.trend_revenue_type),
    "trend_segment_count": _seg_trend(trends.trend_segment_count),
    "trend_segment_value": _seg_trend(trends.trend_segment_value),
    "trend_segment_revenue": _seg_trend(trends.trend_segment_revenue),
    "trend_incremental": _wh(_trend_incremental),
    "residual_summary": _type_trend(trends.value_residuals),
    "trend_extrapolate": _type_trend(trends.trend_extrapolate_value),
    "trend_predictions": _type_trend(trends.trend_predictions),
    "trend_predictions_revenue": _type_trend(trends.trend_predictions_revenue),
    "trend_predictions_segment": _seg_trend(trends.trend_predictions_segment),
    # time series
    "daily_total": _wh(timeseries.daily_total),
    "series_split": _wh(_split),
    "acf": _ts(timeseries.acf_train),
    "acf_first_lag": _ts(timeseries.acf_candidate),
    "acf_blocks": _ts(lambda wh, split: timeseries.acf_train(wh, split=split, block_rows=256)),
    "pacf": _ts(timeseries.pacf_train),
    "pacf_first_lag": _ts(timeseries.pacf_candidate),
    # proposed analyses
    "type_by_segment": _wh(explore.type_by_segment),
    "movement_cube": _wh(explore.movement_cube),
    "client_profile": _wh(explore.client_profile),
    "weekday_seasonality": _wh(explore.weekday_seasonality),
    "month_seasonality": _wh(explore.month_seasonality),
}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue and value per day by type: contract resolution -> summary -> revenue."""
    return QUERIES["revenue_day"](spark, sf_dir).orderBy(F.col("data"))
