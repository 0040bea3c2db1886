"""A keyed result that is written batch by batch and folded together now and then, so that reads stay small."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: So many batches are folded into one base.
EVERY = 10


class Batches:
    """Folders ``batch=N`` with the rows that batch N has changed, and ``base=N`` with the newest row of each key up to N.

    A base counts once its write has ended, so a reader sees the one before it or the new one. What neither the newest
    base nor the one before it needs is removed, so the number of folders is bounded by ``every`` and not by the batches.
    The newest row is that of the last batch, or the greatest in ``order``. Bases may be split by a ``partition`` column.
    """

    def __init__(self, path: str, keys: Iterable[str], every: int = EVERY, order: Iterable[str] = (), partition: str | None = None):
        self.path, self.keys, self.every = path, tuple(keys), every
        self.order, self.partition = tuple(order), partition

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """A repeated batch overwrites its own folder, so a restart does not double rows."""
        batch.write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")
        if (batch_id + 1) % self.every == 0:
            self._fold(batch.sparkSession, batch_id)

    def next_id(self, spark: SparkSession) -> int:
        """One more than any batch there is, finished or not."""
        names = [f.getName().partition("=") for f in self._folders(spark)[1]]
        return max((int(number) for kind, _, number in names if kind in ("base", "batch")), default=-1) + 1

    def read(self, spark: SparkSession, where: Column | None = None) -> DataFrame:
        """The newest row of each key; ``where`` restricts the keys, before anything else."""
        bases, batches = self._finished(spark)
        if not bases and not batches:
            raise FileNotFoundError(f"no finished batch in {self.path}")
        return self._newest(spark, bases[-1] if bases else None, batches, where).drop("batch")

    def _folders(self, spark: SparkSession):
        root = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        system = root.getFileSystem(spark._jsc.hadoopConfiguration())
        return system, [s.getPath() for s in system.listStatus(root)] if system.exists(root) else []

    def _finished(self, spark: SparkSession) -> tuple[list[int], list[int]]:
        """Numbers of the finished bases and batches, in order."""
        system, folders = self._folders(spark)
        out: dict[str, list[int]] = {"base": [], "batch": []}
        for folder in folders:
            kind, _, number = folder.getName().partition("=")
            if kind in out and system.exists(spark._jvm.org.apache.hadoop.fs.Path(folder, "_SUCCESS")):
                out[kind].append(int(number))
        return sorted(out["base"]), sorted(out["batch"])

    def _newest(self, spark: SparkSession, base: int | None, batches: list[int], where: Column | None = None) -> DataFrame:
        """The base's rows whose keys no later batch has, and the newest of all others."""

        def wanted(frame: DataFrame) -> DataFrame:
            return frame if where is None else frame.where(where)

        def one_each(rows: DataFrame) -> DataFrame:
            rest = [c for c in rows.columns if c not in (*self.keys, "batch")]
            newest = F.max_by(F.struct(*rest, "batch"), F.struct(*self.order, "batch"))
            return rows.groupBy(*self.keys).agg(newest.alias("s")).select(*self.keys, *[f"s.{c}" for c in rest], "s.batch")

        after = [f"{self.path}/batch={b}" for b in batches if base is None or b > base]
        folded = None if base is None else wanted(spark.read.parquet(f"{self.path}/base={base}"))
        if not after:
            return folded
        changed = wanted(spark.read.option("basePath", self.path).parquet(*after).withColumn("batch", F.col("batch").cast("bigint")))
        if folded is None:
            return one_each(changed)
        touched = changed.select(*self.keys).distinct()
        met = one_each(changed.unionByName(folded.join(touched, list(self.keys), "left_semi")))
        return met.unionByName(folded.join(touched, list(self.keys), "left_anti"))

    def _fold(self, spark: SparkSession, batch_id: int) -> None:
        bases, batches = self._finished(spark)
        if bases and bases[-1] >= batch_id:
            return
        before = bases[-1] if bases else None
        rows = self._newest(spark, before, [b for b in batches if b <= batch_id])
        writer = rows.repartition(self.partition).write.partitionBy(self.partition) if self.partition else rows.write
        writer.mode("overwrite").parquet(f"{self.path}/base={batch_id}")
        system, folders = self._folders(spark)
        for folder in folders:
            kind, _, number = folder.getName().partition("=")
            unused = before is not None and (kind == "base" and int(number) < before or kind == "batch" and int(number) <= before)
            if unused:
                system.delete(folder, True)
