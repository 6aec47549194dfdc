"""Sums by key that streams maintain: each micro-batch adds its own, readers touch only some buckets.

The store is a folder in shared storage. Micro-batch n writes partial sums under ``batch=n``, dealt to
buckets of the key; writing it again replaces it, so a batch that is repeated after a failure counts
once. Keys are looked up in the buckets they fall in. ``compact`` folds older batches into one table.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class KeyedSums:
    """``sums`` names the kept columns with their types; ``key`` is the key's name and type."""

    def __init__(
        self, spark: SparkSession, folder: str, key: tuple[str, str], sums: Mapping[str, str], buckets: int = 64
    ):
        self.spark, self.folder, self.buckets = spark, folder.rstrip("/"), buckets
        self.key, self.sums = key[0], dict(sums)
        self.schema = ", ".join(f"{n} {t}" for n, t in [key, *sums.items()])

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def _added(self, rows: DataFrame) -> DataFrame:
        # Sums keep the type they came with, so that a store can be folded again and again.
        return rows.groupBy(self.key).agg(*[F.sum(n).cast(t).alias(n) for n, t in self.sums.items()])

    def merge(self, rows: DataFrame, batch: int) -> None:
        """Add a micro-batch with the key and the columns of ``sums``; for ``foreachBatch``."""
        parts = self._added(rows.filter(F.col(self.key).isNotNull())).withColumn("bucket", self.bucket())
        parts.repartition("bucket").write.partitionBy("bucket").mode("overwrite").parquet(
            f"{self.folder}/batch={batch}"
        )

    def _whole(self, name: str) -> bool:
        """Whether a table was written to its end."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}/_SUCCESS")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def tables(self) -> list[str]:
        """The latest folded table, if there is one, and the batches after it."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        system = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in system.listStatus(path)] if system.exists(path) else []
        number = lambda name: int(name.split("=")[1])
        whole = [n for n in names if n.startswith(("batch=", "folded=")) and self._whole(n)]
        folded = max((n for n in whole if n.startswith("folded=")), key=number, default=None)
        done = number(folded) if folded else -1
        batches = sorted((n for n in whole if n.startswith("batch=") and number(n) > done), key=number)
        return [*([folded] if folded else []), *batches]

    def read(self, buckets: list[int] | None = None) -> DataFrame:
        """(key, sums...) of all keys, or of the keys in some buckets: other files are not opened."""
        parts = None
        for name in self.tables():
            rows = self.spark.read.schema(f"{self.schema}, bucket int").parquet(f"{self.folder}/{name}")
            if buckets is not None:
                rows = rows.filter(F.col("bucket").isin(buckets))
            rows = rows.drop("bucket")
            parts = rows if parts is None else parts.unionByName(rows)
        if parts is None:
            return self.spark.createDataFrame([], self.schema)
        return self._added(parts)

    def join(self, rows: DataFrame) -> DataFrame:
        """``rows`` (with the key) and the sums of their keys, missing where the store has none."""
        # One number per bucket at most.
        touched = [r[0] for r in rows.select(self.bucket()).distinct().collect()]
        return rows.join(self.read(touched), self.key, "left")

    def compact(self) -> None:
        """Fold all batches so far into one table; the older files are no longer read."""
        names = self.tables()
        if not names:
            return
        upto = names[-1].split("=")[1]
        if names == [f"folded={upto}"]:
            return
        self.read().withColumn("bucket", self.bucket()).repartition("bucket").write.partitionBy("bucket").mode(
            "overwrite"
        ).parquet(f"{self.folder}/folded={upto}")
