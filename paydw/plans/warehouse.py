"""The warehouse: bootstrap and interval ETL into a parquet star schema.

Steps (each an insert-only merge, K1-K5):

1. ``dim_clientes``        <- staging clients (``id`` renamed to ``id_cliente``)
2. ``dim_contratos``       <- staging contracts
3. ``fact_transacoes``     <- staging transactions with their contract (J5)
4. ``dim_tempo``           <- calendar from the first transaction day (S7)
5. ``fact_transacoes_dia`` <- daily summary (G1) of the fact rows of the
   days being processed (all days at bootstrap, ``days`` in interval runs)

Fact tables are partitioned by month (``mes_ref`` = yyyymm: months, not
days, so files stay large); a month's files follow its bytes and are sorted by
client and row key. Every table is a written parquet table with a fixed schema,
so the analytics start from scans (lineage is cut; a lost executor only re-runs
tasks of the current job) and an empty table reads as an empty table.

A run stages its transactions once (``plans/runs.py``): one left join with the
latest contracts gives each row its contract or none. Facts, waiting rows,
partial summaries and keys are filters of these staged rows, so a run that
breaks is finished by the next one and loses nothing.

Incremental runs lose nothing either: transactions without a contract wait in
``pending_transacoes`` (rows that runs added, less those that runs took out)
and are tried again when their client gets a new contract, so a retry costs
what the new contracts cost, not what has ever waited. The calendar grows
without holes from the first day seen; only closed days (before the run's
``process_date``) are summarized. Each run adds partial sums per client, day
and contract (``resumo_parcial``); rows that arrive for a summarized day give
that day its new sum from these (``late="recompute"``) or are left out of the
summary as in the reference (``late="ignore"``). Writers to one warehouse take turns.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
import os
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegerType, LongType, StringType, StructField, StructType

from paydw.functions.calendar import month_ref
from paydw.operators.contracts import resolve_contract
from paydw.operators.key_index import KeyIndex
from paydw.operators.merge import append, insert_only_merge, new_rows, read_table
from paydw.operators.skew import hot_keys
from paydw.operators.summary import SUMMARY_GROUP, merged_summary, partial_summary
from paydw.plans.runs import Runs
from paydw.schemas import (DIM_CLIENTES, DIM_CONTRATOS, DIM_TEMPO, FACT_TRANSACOES, FACT_TRANSACOES_DIA, KEYS,
                           MONTH_PARTITION, STAGING_TRANSACOES)
from paydw.session import scratch_path
from paydw.sources.calendar import calendar
from paydw.sources.driver import Staging, staging_from_sf
from paydw.storage import children, exists, files, has_data, make_folder, remove

_MONTH = StructField(MONTH_PARTITION, IntegerType(), True)
TABLES = {"dim_clientes": DIM_CLIENTES, "dim_contratos": DIM_CONTRATOS, "dim_tempo": DIM_TEMPO,
          "fact_transacoes": StructType([*FACT_TRANSACOES.fields, _MONTH]),
          "fact_transacoes_dia": StructType([*FACT_TRANSACOES_DIA.fields, _MONTH])}
WAITING_BUCKETS = 64
# Bump when the ETL output changes so cached warehouses are rebuilt.
WAREHOUSE_VERSION = "6"
# Summary rows that a task adds up and sorts, whatever the length of the history.
SUMMARY_ROWS = 500_000


def at_once(*steps) -> None:
    """Run steps that do not need each other's results as jobs side by side; the first error is raised."""
    with ThreadPoolExecutor(len(steps)) as pool:
        for done in [pool.submit(step) for step in steps]:
            done.result()


def month_of(day) -> int:
    return int(str(day)[:4]) * 100 + int(str(day)[5:7])


@dataclass
class Warehouse:
    spark: SparkSession
    path: str
    # split clients holding >= this share of a batch's transactions over salted tasks
    hot_client_share: float | None = 0.02
    salt_buckets: int = 32
    key_buckets: int = 16
    # a frozen (built, no longer loaded) warehouse lists each table's files once
    frozen: bool = False
    _tables: dict = field(default_factory=dict, repr=False, compare=False)

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.path}/{name}")

    def table(self, name: str) -> DataFrame:
        if not self.frozen:
            return self._read(name)
        df = self._tables.get(name)
        if df is None:
            df = self._tables[name] = self._read(name)
        return df

    def table_or_none(self, name: str) -> DataFrame | None:
        return self._read(name) if has_data(self.spark, f"{self.path}/{name}") else None

    @property
    def runs(self) -> Runs:
        return Runs(self.spark, f"{self.path}/_runs")

    @property
    def keys(self) -> KeyIndex:
        return KeyIndex(self.spark, f"{self.path}/chaves_transacoes", KEYS["fact_transacoes"], self.key_buckets)

    @property
    def clientes(self) -> DataFrame:
        return self.table("dim_clientes")

    @property
    def contratos(self) -> DataFrame:
        return self.table("dim_contratos")

    @property
    def tempo(self) -> DataFrame:
        return self.table("dim_tempo")

    @property
    def fact(self) -> DataFrame:
        return self.table("fact_transacoes")

    @property
    def fact_dia(self) -> DataFrame:
        return self.table("fact_transacoes_dia")

    # -- ETL steps -----------------------------------------------------
    def load_clientes(self, staging_clientes: DataFrame) -> None:
        src = staging_clientes.withColumnRenamed("id", "id_cliente").select(
            "id_cliente", "razao_social", "data_inicio_relacionamento", "status",
            "data_fim_relacionamento", "segmento")
        insert_only_merge(src, f"{self.path}/dim_clientes", KEYS["dim_clientes"])

    def load_contratos(self, staging_contratos: DataFrame) -> None:
        """Insert new contracts; their clients are noted beforehand if transactions wait."""
        path = f"{self.path}/dim_contratos"
        if has_data(self.spark, f"{self.path}/pending_transacoes"):
            new = new_rows(staging_contratos, self.table_or_none("dim_contratos"), KEYS["dim_contratos"])
            new.select("id_cliente").distinct().write.parquet(f"{self.path}/_retry/{uuid.uuid4().hex[:12]}")
        insert_only_merge(staging_contratos, path, KEYS["dim_contratos"])

    # -- transactions that wait ------------------------------------------
    def _waiting(self, what: str, buckets: list[int] | None = None, before: int | None = None) -> DataFrame | None:
        """Rows that runs added to the waiting ones (``entrada``) or took out of them (``saida``)."""
        path = f"{self.path}/pending_transacoes/{what}"
        if not has_data(self.spark, path):
            return None
        fields = STAGING_TRANSACOES.fields if what == "entrada" else []
        schema = StructType([*fields, StructField("espera", StringType()), StructField("balde", IntegerType()),
                             StructField("run", LongType())])
        df = self.spark.read.schema(schema).parquet(path)
        if buckets is not None:
            df = df.where(F.col("balde").isin(buckets))
        return df if before is None else df.where(F.col("run") < before)

    def pending(self, buckets: list[int] | None = None, before: int | None = None) -> DataFrame | None:
        """Transactions that no contract has taken yet (of some client buckets, added by runs before ``before``)."""
        added, gone = self._waiting("entrada", buckets, before), self._waiting("saida", buckets, before)
        return added if added is None or gone is None else added.join(gone.select("balde", "espera"), ["balde", "espera"], "left_anti")

    def _due(self) -> DataFrame | None:
        """Waiting transactions of the clients that got contracts since the last run that was done."""
        if not children(self.spark, f"{self.path}/_retry"):
            return None
        clients = self.spark.read.schema("id_cliente long").parquet(f"{self.path}/_retry/*").where("id_cliente is not null").distinct()
        buckets = [r[0] for r in clients.select(_waiting_bucket().alias("b")).distinct().collect()]  # at most WAITING_BUCKETS
        waiting = self.pending(buckets) if buckets else None
        return None if waiting is None else waiting.join(clients, "id_cliente", "left_semi")

    def load_transacoes(self, staging_transacoes: DataFrame, finish: bool = True) -> DataFrame:
        """Resolve and insert new transactions and those that are due; what has no contract waits.

        Runs that broke are finished first. With ``finish=False`` the caller
        ends the run by ``finish_runs``, after what follows from it. Returns
        the days of the resolved rows (one row a day).
        """
        self.create_tables()
        for run in self.runs.with_mark("staged", without="done"):
            self._apply(run)
        self._index_keys()
        run = self.runs.begin()
        self._stage(run, staging_transacoes)
        self._apply(run)
        opened = self.runs.with_mark("staged", without="done")
        days = reduce(DataFrame.unionAll, [self.runs.rows(n).where("id_contrato is not null").select("data_movimentacao")
                                           for n in opened]).distinct()
        if finish:
            self.finish_runs()
        return days

    def finish_runs(self) -> None:
        """All that follows from the open runs is written: they are done."""
        for run in self.runs.with_mark("staged", without="done"):
            self.runs.mark(run, "done")
        remove(self.spark, f"{self.path}/_retry")
        self.runs.forget()

    def _index_keys(self) -> None:
        """Put the keys of finished runs into the index; until now their staged rows held them."""
        for run in self.runs.with_mark("done", without="indexed"):
            self.keys.append(self.runs.rows(run).where("nova"), run)
            self.runs.mark(run, "indexed")

    def _stage(self, run: int, staging_transacoes: DataFrame) -> None:
        """Write the run's rows, each with its contract or none; ``nova``: goes into the facts."""
        names, key = STAGING_TRANSACOES.fieldNames(), list(KEYS["fact_transacoes"])
        rows = staging_transacoes.select(*names).withColumn("espera", F.lit(None).cast("string"))
        due = self._due()
        if due is not None:  # of a row that waits and comes again, the one that comes counts
            rows = rows.unionByName(due.join(rows.select(*key), key, "left_anti").select(*rows.columns))
        hot = hot_keys(rows, "id_cliente", min_share=self.hot_client_share) if self.hot_client_share else []
        marked = resolve_contract(rows, self.table("dim_contratos"), hot_clients=hot, salt_buckets=self.salt_buckets,
                                  keep_unresolved=True)
        known = self.keys.matched(rows)
        if known is None:
            marked = marked.withColumn("conhecida", F.lit(False))
        else:
            marked = marked.join(known.withColumn("_k", F.lit(True)), key, "left") \
                .withColumn("conhecida", F.col("_k").isNotNull()).drop("_k")
        self.runs.write(run, marked.select(
            *[F.col(f.name).cast(f.dataType) for f in FACT_TRANSACOES.fields], "espera", "conhecida",
            (F.col("id_contrato").isNotNull() & ~F.col("conhecida")).alias("nova"),
            month_ref(F.col("data_movimentacao")).alias(MONTH_PARTITION), _waiting_bucket().alias("balde")))

    def _apply(self, run: int) -> None:
        """Everything that follows from a run's staged rows but calendar and summary; may be done again."""
        rows, again = self.runs.rows(run), self.runs.has(run, "applying")
        self.runs.mark(run, "applying")
        settled = F.col("id_contrato").isNotNull() | F.col("conhecida")
        came, waited = F.col("espera").isNull() & ~settled, F.col("espera").isNotNull() & settled
        n = rows.agg(F.count_if("nova").alias("new"), F.count_if(came).alias("waits"), F.count_if(waited).alias("leaves")).first()
        new = rows.where("nova")

        def facts():
            if n["new"] and not self.runs.has(run, "fact"):
                fact = new.select(*TABLES["fact_transacoes"].fieldNames())
                append(self._not_in_fact(fact) if again else fact, f"{self.path}/fact_transacoes",
                       partition_by=MONTH_PARTITION, sort_by=["id_cliente", "id_transacao"])
            self.runs.mark(run, "fact")

        def partials():
            if n["new"]:
                # the aggregate's own exchange deals the rows to files
                self._put(partial_summary(new).withColumn(MONTH_PARTITION, month_ref(F.col("data_movimentacao"))),
                          "resumo_parcial", run, MONTH_PARTITION, "data_movimentacao", dealt=True)

        def waits():
            if n["waits"]:
                arrived = rows.where(came).select(*STAGING_TRANSACOES.fieldNames(), "balde").withColumn("espera", F.expr("uuid()"))
                before = self.pending(before=run)
                if before is not None:  # what waits already and comes again does not wait twice
                    key = ["balde", *KEYS["fact_transacoes"]]
                    arrived = arrived.join(before.select(*key), key, "left_anti")
                self._put(arrived, "pending_transacoes/entrada", run, "balde", "id_cliente")
            if n["leaves"]:
                self._put(rows.where(waited).select("espera", "balde").distinct(), "pending_transacoes/saida", run, "balde", "espera")

        at_once(facts, partials, waits)

    def _put(self, rows: DataFrame, name: str, run: int, *order: str, dealt: bool = False) -> None:
        """A run's rows of a table of state, in place of what a broken attempt wrote.

        Sorted by the columns that readers filter by, so row groups are skipped
        by their statistics; files follow the bytes. Rows that an exchange has
        just ``dealt`` are not moved again.
        """
        rows = rows if dealt else rows.hint("rebalance", F.col(order[0]))
        rows.sortWithinPartitions(*order).write.mode("overwrite") \
            .option("parquet.block.size", str(16 << 20)).parquet(f"{self.path}/{name}/run={run}")

    def _not_in_fact(self, rows: DataFrame) -> DataFrame:
        """Rows of a broken run that it has not appended (an append shows whole or not at all).

        Rows with a null key cannot be looked up: they are taken to be there
        if any other row of the run is.
        """
        fact = self.table_or_none("fact_transacoes")
        if fact is None:
            return rows
        missing = new_rows(rows, fact, KEYS["fact_transacoes"], prune_on=MONTH_PARTITION)
        keyed = F.col("id_transacao").isNotNull() & F.col("id_cliente").isNotNull()
        return missing if missing.where(keyed).count() == rows.where(keyed).count() else missing.where(keyed)

    def load_tempo(self, transacoes: DataFrame, end_date="today") -> None:
        """Extend the calendar: every day from the first one seen so far to ``end_date`` or the last one seen."""
        days = transacoes.select("data_movimentacao")
        known = self.table_or_none("dim_tempo")
        if known is not None:
            days = days.union(known.select("data"))
        insert_only_merge(calendar(days, "data_movimentacao", end_date=end_date),
                          f"{self.path}/dim_tempo", KEYS["dim_tempo"])

    def _partials(self) -> DataFrame | None:
        if not has_data(self.spark, f"{self.path}/resumo_parcial"):
            return None
        schema = StructType([*FACT_TRANSACOES_DIA.fields[:3], StructField("tipo_transacao", StringType()),
                             StructField("quantidade", LongType()), StructField("total", DecimalType(38, 10)),
                             _MONTH, StructField("run", LongType())])
        return self.spark.read.schema(schema).parquet(f"{self.path}/resumo_parcial")

    def summarize_closed(self, process_date, touched: DataFrame, late: str = "recompute") -> None:
        """Summary of the days before ``process_date`` that have none yet, and of late rows.

        ``touched``: the days of the run's resolved rows. Those up to the last
        summarized day are late: they get new sums, other days are not read.
        """
        last = self.table("fact_transacoes_dia").agg(F.max("data_movimentacao")).first()[0]
        d = F.col("data_movimentacao")
        if last is not None and late == "recompute":
            rows = touched.where((d <= F.lit(last)) & (d < F.lit(str(process_date)).cast("date"))).collect()
            self.recompute_summary([r[0] for r in rows])  # at most one row a day
        self.load_summary(after=last, before=process_date, closing=True)

    def load_summary(self, days: list | None = None, after=None, before=None, closing: bool = False) -> None:
        """Daily summary of ``days`` (all days when None), insert-only on (client, day).

        ``after`` and ``before`` bound the days, both exclusive; ``closing``
        says that the summary has no day after ``after`` yet.
        """
        if days is not None and len(days) == 0:
            return
        partials = self._partials()
        if partials is None:
            return
        d, month = F.col("data_movimentacao"), F.col(MONTH_PARTITION)
        if days is not None:
            partials = partials.where(month.isin(sorted({month_of(x) for x in days}))
                                      & d.isin([F.lit(str(x)).cast("date") for x in days]))
        if after is not None:
            partials = partials.where((month >= month_of(after)) & (d > F.lit(str(after)).cast("date")))
        if before is not None:
            partials = partials.where((month <= month_of(before)) & (d < F.lit(str(before)).cast("date")))
        target, layout = f"{self.path}/fact_transacoes_dia", {
            "partition_by": MONTH_PARTITION, "sort_by": ["id_cliente", "data_movimentacao"]}
        layout["laid_out"] = True
        if closing:  # days that the summary does not have: nothing to compare with
            append(self._summary(partials), target, **layout)
        else:
            insert_only_merge(self._summary(partials), target, KEYS["fact_transacoes_dia"], prune_on=MONTH_PARTITION, **layout)

    def _summary(self, partials: DataFrame) -> DataFrame:
        """Summary rows of ``partials``, laid out by month and client.

        The narrow rows move once, to the task that adds them up and writes
        them: a range of months and clients holds whole groups. A run has
        at most one row a group and type, so no client makes a range long.
        """
        return merged_summary(self._laid_out(partials), (MONTH_PARTITION, *SUMMARY_GROUP)) \
            .select(*[F.col(f.name).cast(f.dataType) for f in FACT_TRANSACOES_DIA.fields], MONTH_PARTITION)

    def _laid_out(self, rows: DataFrame) -> DataFrame:
        """``rows`` in ranges of month and client of about ``SUMMARY_ROWS`` rows."""
        return rows.repartitionByRange(max(1, -(-rows.count() // SUMMARY_ROWS)), MONTH_PARTITION, "id_cliente")

    def recompute_summary(self, days: list) -> None:
        """Late rows (Q17): new sums for ``days``, from the partial sums of these days.

        The other days of their months are copied from the summary, then exactly
        these month partitions are replaced when the job commits (dynamic
        partition overwrite, which may read what it replaces); other months are
        untouched and the fact table is not read.
        """
        partials = self._partials()
        if not days or partials is None:
            return
        months = F.col(MONTH_PARTITION).isin(sorted({month_of(x) for x in days}))
        # one row a day, so bounded by the length of the calendar
        late = F.broadcast(self.spark.createDataFrame([(_dt.date.fromisoformat(str(d)),) for d in days], "data_movimentacao date"))
        names = TABLES["fact_transacoes_dia"].fieldNames()
        new = self._summary(partials.where(months).join(late, "data_movimentacao", "left_semi"))
        others = self.table("fact_transacoes_dia").where(months).join(late, "data_movimentacao", "left_anti")
        new.select(*names).unionByName(self._laid_out(others).select(*names)) \
            .sortWithinPartitions(MONTH_PARTITION, "id_cliente", "data_movimentacao") \
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
            .partitionBy(MONTH_PARTITION).parquet(f"{self.path}/fact_transacoes_dia")

    def create_tables(self) -> None:
        """Empty tables (bootstrap step 2): their folders, which read by their schemas (``TABLES``)."""
        for name in TABLES:
            if not exists(self.spark, f"{self.path}/{name}"):
                make_folder(self.spark, f"{self.path}/{name}")

    def bootstrap(self, staging: Staging, end_date="today") -> None:
        """Create the model, load it from staging, calendar, then the daily summary (K9)."""
        self.run_interval(staging, end_date=end_date)

    def daily_summary_job(self, process_date) -> None:
        """Summary of the day before ``process_date`` (the run at the first minute of a day)."""
        d = _dt.date.fromisoformat(str(process_date)) - _dt.timedelta(days=1)
        self.load_summary([d])

    def run_interval(self, staging: Staging, end_date="today", summary_days: list | None = None,
                     summarize: bool = True, process_date=None, late: str = "recompute") -> None:
        """One ETL run: bootstrap when the tables are empty, an interval load otherwise.

        With ``process_date`` the days before it are closed and summarized
        (see ``summarize_closed``); without it all days, or ``summary_days``,
        are, insert-only. Staging is read once and kept until the run ends.
        """
        self.create_tables()
        tx = staging.transacoes.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            dims = [lambda: self.load_tempo(tx, end_date=end_date)]
            if staging.clientes is not None:
                dims.append(lambda: self.load_clientes(staging.clientes))
            if staging.contratos is not None:
                dims.append(lambda: self.load_contratos(staging.contratos))
            at_once(*dims)
            touched = self.load_transacoes(tx, finish=False)
            if summarize and process_date is not None:
                self.summarize_closed(process_date, touched, late)
            elif summarize:
                self.load_summary(summary_days)
            self.finish_runs()
        finally:
            tx.unpersist()

    def ingest(self, stream: DataFrame, checkpoint: str, process_date, end_date="last", late: str = "recompute"):
        """Start an ``availableNow`` stream of staging transactions into the warehouse.

        Every micro-batch is an interval run without new clients and contracts
        (load these first): facts, calendar, closed days, pending rows.
        """
        def batch(df: DataFrame, _: int) -> None:
            self.run_interval(Staging(None, None, df), end_date=end_date,
                              process_date=process_date, late=late)

        return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint) \
            .trigger(availableNow=True).start()


def _waiting_bucket() -> Column:
    """The bucket of a waiting transaction, by its client; what runs keep of waiting rows is partitioned by it."""
    return F.pmod(F.xxhash64("id_cliente"), F.lit(WAITING_BUCKETS)).cast("int")


_CODE_DIGEST: list[str] = []


def _code_digest() -> str:
    """Digest of this package's source: a changed job never reuses an old build."""
    if not _CODE_DIGEST:
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        h = hashlib.sha1()
        for d, _, files in sorted(os.walk(root)):
            for f in sorted(files):
                if f.endswith(".py"):
                    with open(os.path.join(d, f), "rb") as fh:
                        h.update(f.encode() + b"\0" + fh.read())
        _CODE_DIGEST.append(h.hexdigest()[:12])
    return _CODE_DIGEST[0]


def _fingerprint(spark: SparkSession, sf_dir: str) -> str:
    """Digest of the code, the folder and its tables' files (names, sizes, times of change)."""
    h = hashlib.sha1(f"{WAREHOUSE_VERSION}|{_code_digest()}|{sf_dir.rstrip('/')}".encode())
    for name in ("customer", "orders"):
        h.update(repr((name, sorted(files(spark, f"{sf_dir}/{name}.parquet")))).encode())
    return h.hexdigest()[:16]


_OPEN: dict[tuple[str, str], Warehouse] = {}


def warehouse_for_sf(spark: SparkSession, sf_dir: str, end_date="last",
                     rebuild: bool = False) -> Warehouse:
    """The warehouse built from the driver tables of ``sf_dir`` (built once, then reused).

    It lives below ``spark.checkpoint.dir``: ``<fingerprint>/<attempt>``; a
    one-row pointer table ``_latest`` names the last complete attempt, so an
    interrupted build is never read.
    """
    fp = _fingerprint(spark, sf_dir) + (f"-{end_date}" if end_date != "last" else "")
    key = (spark.sparkContext.applicationId, fp)
    if key in _OPEN and not rebuild:
        return _OPEN[key]
    base = scratch_path(spark, "paydw-warehouse", fp)
    latest = None if rebuild else read_table(spark, f"{base}/_latest")
    if latest is not None:
        row = latest.first()
        if row is not None:
            _OPEN[key] = Warehouse(spark, row["path"], frozen=True)
            return _OPEN[key]
    path = f"{base}/{uuid.uuid4().hex[:12]}"
    wh = Warehouse(spark, path)
    wh.run_interval(staging_from_sf(spark, sf_dir), end_date=end_date)
    spark.createDataFrame([(path, _dt.datetime.now(_dt.timezone.utc).isoformat())],
                          "path string, built_at string") \
        .coalesce(1).write.mode("overwrite").parquet(f"{base}/_latest")
    _OPEN[key] = Warehouse(spark, path, frozen=True)
    return _OPEN[key]
