"""The ledger of ETL runs: what a broken run leaves behind is finished by the next one.

A run first writes what it is going to do (``rows``: its transactions, each
with its contract or none) and marks that as ``staged``; everything after is a
function of these rows and can be done again. Runs are numbered; a mark is an
empty file that is made once, so no pointer is ever overwritten. Marks:

* ``staged``: the rows are complete;
* ``applying``: the facts may have been appended, by this or a broken attempt;
* ``fact``: the facts have been appended;
* ``done``: all that follows from the rows has been written;
* ``indexed``: the run's keys are in the key index.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paydw import storage


class Runs:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def folder(self, run: int) -> str:
        return f"{self.path}/run-{run:08d}"

    def numbers(self) -> list[int]:
        return [int(n[4:]) for n in storage.children(self.spark, self.path) if n.startswith("run-")]

    def begin(self) -> int:
        run = max(self.numbers(), default=0) + 1
        storage.make_folder(self.spark, self.folder(run))
        return run

    def mark(self, run: int, what: str) -> None:
        storage.mark(self.spark, f"{self.folder(run)}/_{what}")

    def has(self, run: int, what: str) -> bool:
        return storage.exists(self.spark, f"{self.folder(run)}/_{what}")

    def with_mark(self, what: str, without: str) -> list[int]:
        return [n for n in self.numbers() if self.has(n, what) and not self.has(n, without)]

    def write(self, run: int, rows: DataFrame) -> None:
        rows.write.mode("overwrite").parquet(f"{self.folder(run)}/rows")
        self.mark(run, "staged")

    def rows(self, run: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder(run)}/rows")

    def forget(self) -> None:
        """Remove runs that are done and indexed, and those that staged nothing; the highest number stays."""
        for n in self.numbers()[:-1]:
            if not self.has(n, "staged") or (self.has(n, "done") and self.has(n, "indexed")):
                storage.remove(self.spark, self.folder(n))
