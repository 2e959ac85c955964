"""Where the ledger's changes are kept."""

from __future__ import annotations

from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.ledger import current
from tidemark.schema import LEDGER
from tidemark.sources.files import remove_files


@dataclass(frozen=True)
class LedgerStore:
    """An append-only table behind any Spark source that can append.

    ``LedgerStore.at(path)`` keeps it as Parquet. With ``format="jdbc"`` and
    the options of Spark's JDBC source it lives in a database table.
    """

    format: str
    options: dict[str, str] = field(default_factory=dict)

    @classmethod
    def at(cls, path: str) -> LedgerStore:
        return cls("parquet", {"path": path})

    def create(self, spark: SparkSession) -> None:
        """Create the table empty unless it exists."""
        empty = spark.createDataFrame([], LEDGER)
        empty.write.format(self.format).options(**self.options).mode("ignore").save()

    def append(self, changes: DataFrame) -> None:
        # One row per date: one small file.
        writer = changes.coalesce(1).write.format(self.format)
        writer.options(**self.options).mode("append").save()

    def log(self, spark: SparkSession) -> DataFrame:
        reader = spark.read.format(self.format).options(**self.options)
        if self.format != "jdbc":  # the database names the types itself
            reader = reader.schema(LEDGER)
        return reader.load()

    def current(self, spark: SparkSession) -> DataFrame:
        return current(self.log(spark))

    def next_seq(self, spark: SparkSession) -> int:
        """Number for the next change. Runs on one store must not overlap."""
        return self.log(spark).agg(F.coalesce(F.max("seq"), F.lit(0)) + 1).first()[0]

    def fold(self, spark: SparkSession) -> int:
        """Keep only the latest change of every date; files removed.

        The latest changes are appended as a file of their own, and only when it
        has been counted do the files before it go. Until then a date's latest
        change is there twice, which makes no difference, so a driver may be lost
        at any point. No run may use the store meanwhile. Earlier changes are gone.
        A database table is folded by the database.
        """
        if self.format != "parquet":
            raise ValueError(f"a ledger in {self.format} is not kept in files")
        before = self.log(spark).inputFiles()
        if len(before) < 2:
            return 0
        dates = self.log(spark).select("partition_date").distinct().count()
        self.append(self.current(spark))
        folded = sorted(set(self.log(spark).inputFiles()) - set(before))
        if not folded or spark.read.schema(LEDGER).parquet(*map(unquote, folded)).count() != dates:
            raise RuntimeError("the folded ledger lacks dates; the files before it stay")
        return remove_files(spark, map(unquote, before))  # Spark names them as URIs
