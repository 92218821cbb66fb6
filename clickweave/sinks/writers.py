"""Writers, each with an exact mode."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from clickweave.workspace import fresh_dir, fresh_name


def save(df: DataFrame, path: str, format: str = "parquet", mode: str = "error") -> None:
    """Modes: append, overwrite, ignore, error."""
    df.write.format(format).mode(mode).save(path)


def save_text(lines: DataFrame, path: str) -> None:
    lines.write.text(path)


def append_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Insert into a catalog table, made on first use."""
    writer = df.write.mode("append").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def new_table(spark: SparkSession, label: str) -> tuple[str, str]:
    """Name and folder for a table of its own."""
    name = fresh_name(spark, label)
    return name, fresh_dir(spark, name)


def jdbc_append(df: DataFrame, url: str, name: str, batch: int = 1000, **options: str) -> None:
    """Plain inserts, in batches, one connection per partition."""
    df.write.format("jdbc").options(url=url, dbtable=name, batchsize=str(batch), **options).mode("append").save()


def save_sharded(pairs: DataFrame, path: str, shards: int, mode: str = "append") -> None:
    """Pairs (key, value) by hash of the key, one folder per shard; every task writes its own files."""
    shard = F.pmod(F.hash("key"), F.lit(shards)).alias("shard")
    pairs.select("key", "value", shard).write.mode(mode).partitionBy("shard").parquet(path)


def few_files(df: DataFrame, *keys: str) -> DataFrame:
    """Rows of one folder brought together so that it gets few files; a very large folder is split again."""
    return df.hint("rebalance", *keys)


def save_by_month(df: DataFrame, date: str, path: str) -> None:
    dated = df.withColumn("month", F.date_format(date, "yyyy-MM"))
    few_files(dated, "month").write.partitionBy("month").parquet(path)


def replace_partitions(df: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Replace exactly the (keys) folders that ``df`` has rows for; others stay."""
    writer = few_files(df, *keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*keys).parquet(path)


class BatchLog:
    """A keyed table as a log of batches: one folder per batch id, merged when read.

    Writing a batch again replaces its own folder and nothing else, so a retried batch counts once. The log compacts
    itself in tiers: when ``every`` batches have come since the last fold, and before the next is written, they become
    one folder of tier 1; ``every`` folders of tier 1 become one of tier 2, and so on. A row is written once per tier, so
    n batches cost in the order of n log n and no fold rewrites the whole table; a read opens less than ``every`` + 1
    folders of each tier. A folder carries the highest batch id it holds. Batches up to the highest folded id are never
    added again, whatever is retried; a fold that was interrupted is made again, and what it covers is read only once,
    from the fold once that is complete. ``how`` says what folding does:

    * ``totals``: per key the sum of the batches;
    * ``latest``: per key the values of the last batch that had it;
    * ``sketches``: per key the union of the batches' distinct sketches;
    * ``rows``: all rows, moved together;
    * ``batch``: only the last batch is kept.

    ``day`` names a column with a date or time; the log is then laid out by its day, and ``rows(days)`` reads only
    the folders of those days.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: str, keys: Sequence[str], how: str = "totals", every: int = 8, day: str | None = None
    ) -> None:
        self.spark, self.path, self.keys, self.how, self.every, self.day = spark, path, list(keys), how, every, day
        self.schema = T.StructType.fromDDL(schema)
        self.values = [f.name for f in self.schema if f.name not in self.keys]

    def _fs(self, path: str):
        target = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()), target

    def _ids(self, tier: int) -> list[int]:
        """Ids of the complete folders of a tier; tier 0 has the batches as they came."""
        fs, target = self._fs(f"{self.path}/{self._name(tier)}")
        if not fs.exists(target):
            return []
        names = [status.getPath() for status in fs.listStatus(target)]
        return sorted(int(p.getName()) for p in names if fs.exists(self._fs(f"{p}/_SUCCESS")[1]))

    @staticmethod
    def _name(tier: int) -> str:
        return f"tier-{tier}" if tier else "batches"

    def _tiers(self) -> list[list[int]]:
        """Per tier the ids of the folders that count: those no folder of a higher tier covers."""
        fs, target = self._fs(self.path)
        if not fs.exists(target):
            return [[]]
        there = {status.getPath().getName() for status in fs.listStatus(target)}
        found = [self._ids(0)]
        while self._name(len(found)) in there:
            found.append(self._ids(len(found)))
        covered = -1
        for tier in range(len(found) - 1, -1, -1):
            found[tier] = [i for i in found[tier] if i > covered]
            covered = max([covered, *found[tier]])
        return found

    def folded(self) -> int:
        """The highest batch id that a fold holds; -1 if none does."""
        return max((i for ids in self._tiers()[1:] for i in ids), default=-1)

    def _save(self, rows: DataFrame, path: str) -> None:
        if self.day:
            day = F.date_format(self.day, "yyyy-MM-dd").alias("_day")
            rows.select("*", day).write.mode("overwrite").partitionBy("_day").parquet(path)
        else:
            rows.write.mode("overwrite").parquet(path)

    def write(self, batch: DataFrame, batch_id: int) -> None:
        if batch_id <= self.folded():
            return  # a retry of a batch that a fold holds
        self._compact(batch_id)
        rows = batch.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema])
        self._save(rows, f"{self.path}/{self._name(0)}/{batch_id}")

    def _compact(self, below: int) -> None:
        """Fold every tier that is full; batches from ``below`` on stay as they are."""
        tier = 0
        while True:
            tiers = self._tiers()
            ready = [i for i in tiers[tier] if i < below] if tier < len(tiers) else []
            if len(ready) < (1 if self.how == "batch" else self.every):
                return
            if self.how != "batch":
                rows = self._read([(i, f"{self.path}/{self._name(tier)}/{i}") for i in ready])
                merge = {"totals": self._sums, "latest": self._lasts, "sketches": self._unions, "rows": lambda r: r.drop("batch_id")}[self.how]
                self._save(merge(rows).select(*self.schema.names), f"{self.path}/{self._name(tier + 1)}/{ready[-1]}")
            # also what earlier, interrupted folds have left
            for i in self._ids(tier):
                if i <= ready[-1]:
                    fs, target = self._fs(f"{self.path}/{self._name(tier)}/{i}")
                    fs.delete(target, True)
            if self.how == "batch":
                return
            tier += 1

    def _read(self, folders: list[tuple[int, str]], days: tuple | None = None) -> DataFrame:
        schema = T.StructType([*self.schema, *[T.StructField("_day", T.StringType())] * bool(self.day)])
        out = self.spark.createDataFrame([], T.StructType([*self.schema, T.StructField("batch_id", T.LongType())]))
        for i, folder in folders:
            part = self.spark.read.schema(schema).parquet(folder)
            if days is not None:
                if not self.day:
                    raise ValueError("this log is not laid out by day")
                part = part.where(F.col("_day").between(*days))
            out = out.unionByName(part.drop("_day").withColumn("batch_id", F.lit(i).cast("long")))
        return out

    def rows(self, days: tuple | None = None, below: int | None = None) -> DataFrame:
        """All rows with their ``batch_id`` (of folded ones the fold's), or those of the days from..to, or of
        batches ``below`` an id."""
        folders = [(i, f"{self.path}/{self._name(tier)}/{i}") for tier, ids in enumerate(self._tiers()) for i in ids]
        return self._read([(i, folder) for i, folder in sorted(folders) if below is None or i < below], days)

    def of(self, batch_id: int) -> DataFrame:
        """Rows of one batch; none if it is folded already."""
        there = batch_id in self._tiers()[0]
        return self._read([(batch_id, f"{self.path}/{self._name(0)}/{batch_id}")] if there else []).drop("batch_id")

    def before(self, batch_id: int) -> DataFrame:
        """Rows of earlier batches, only their folders read."""
        return self.rows(below=batch_id)

    def _lasts(self, rows: DataFrame) -> DataFrame:
        last = F.max_by(F.struct(*self.values), "batch_id").alias("last")
        return rows.groupBy(*self.keys).agg(last).select(*self.keys, "last.*")

    def _sums(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self.keys).agg(*[F.sum(v).alias(v) for v in self.values])

    def _unions(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self.keys).agg(*[F.hll_union_agg(v).alias(v) for v in self.values])

    def latest(self, days: tuple | None = None, below: int | None = None) -> DataFrame:
        """Upsert that sets: per key the values of the last batch that had it."""
        return self._lasts(self.rows(days, below))

    def totals(self, days: tuple | None = None) -> DataFrame:
        """Upsert that adds: per key the sum over all batches."""
        return self._sums(self.rows(days))
