"""A hash-sharded key/value store as a data source of its own, ``sharded_kv``.

The store is ``<path>/shard=<n>/*.parquet`` with text columns key and value; a pair lies in shard crc32(key) % shards, a
null key in shard 0.

Reading: one partition per shard; a shard of more than ``partition_bytes`` gives several, by its files, so a hot key does
not end in one task. Conditions ``key = ...`` and ``key in (...)`` choose the shards to open and filter inside them:
through the option ``keys`` (a JSON list) always, and pushed down from ``where`` if ``pushdown`` is true, which needs
``spark.sql.python.filterPushdown.enabled``. Batches are Arrow; a task holds one at a time.

Writing: append or overwrite. Tasks write into a staging folder; the commit moves the files of the successful tasks into
their shards, an abort removes the folder, so a write that fails or a task that runs twice leaves nothing behind. An
overwrite removes the old shards at its commit. Duplicate keys, null values and empty tables are kept as they are.

File systems are those of pyarrow (local, hdfs, s3, gs, abfs).
"""

from __future__ import annotations

import json
import time
import uuid
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, WriterCommitMessage,
)

NAME = "sharded_kv"
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
PARTITION_BYTES = 128 << 20
_PAIRS = pa.schema([("key", pa.string()), ("value", pa.string())])
_BUFFER_BYTES = 32 << 20  # of one writing task, over all its shards


def shard_of(key: str | None, shards: int) -> int:
    return 0 if key is None else zlib.crc32(key.encode()) % shards


def shard_column(key: str, shards: int) -> Column:
    """The same number inside Spark."""
    return F.coalesce(F.crc32(F.col(key).cast("binary")) % shards, F.lit(0)).cast("int")


def _opened(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[len("file:") :].lstrip("/")
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


@dataclass
class Shard(InputPartition):
    number: int
    files: list[str]


class _Reader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path, self.shards = options["path"], int(options["shards"])
        self.partition_bytes = int(options.get("partition_bytes", PARTITION_BYTES))
        self.keys = set(json.loads(options["keys"])) if "keys" in options else None

    def _only(self, keys: set) -> None:
        self.keys = keys if self.keys is None else self.keys & keys

    def partitions(self) -> Sequence[Shard]:
        fs, root = _opened(self.path)
        numbers = range(self.shards) if self.keys is None else sorted({shard_of(k, self.shards) for k in self.keys})
        return [part for number in numbers for part in self._parts(fs, f"{root}/shard={number}", number)]

    def _parts(self, fs: pafs.FileSystem, folder: str, number: int) -> Iterator[Shard]:
        found = fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True))
        files, size = [], 0
        for info in sorted((i for i in found if i.path.endswith(".parquet")), key=lambda i: i.path):
            if files and size + info.size > self.partition_bytes:
                yield Shard(number, files)
                files, size = [], 0
            files.append(info.path)
            size += info.size
        yield Shard(number, files)

    def read(self, partition: Shard | None) -> Iterator[pa.RecordBatch]:
        if partition is None or not partition.files:  # None: no shard is wanted at all
            return
        fs, _ = _opened(self.path)
        wanted = None if self.keys is None else ds.field("key").isin(pa.array(sorted(self.keys), pa.string()))
        pairs = ds.dataset(partition.files, schema=_PAIRS, format="parquet", filesystem=fs)
        for batch in pairs.to_batches(filter=wanted, batch_size=10_000, batch_readahead=1, fragment_readahead=1, use_threads=False):
            if batch.num_rows:
                number = pa.array([partition.number], pa.int32()).take(pa.array([0] * batch.num_rows, pa.int32()))
                yield pa.record_batch([batch["key"], batch["value"], number], names=["key", "value", "shard"])


class _PushedReader(_Reader):
    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Conditions on the key are done here, in full; the others are left to Spark."""
        for one in filters:
            if isinstance(one, EqualTo) and one.attribute == ("key",):
                self._only({one.value})
            elif isinstance(one, In) and one.attribute == ("key",):
                self._only({v for v in one.value if v is not None})
            else:
                yield one


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[int, str]]  # shard and file name


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool) -> None:
        self.path, self.shards, self.overwrite = options["path"], int(options["shards"]), overwrite
        self.file_rows = int(options.get("file_rows", 1_000_000))
        self.staging = f"_staging-{uuid.uuid4().hex}"
        fs, root = _opened(self.path)
        fs.create_dir(f"{root}/{self.staging}", recursive=True)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, root = _opened(self.path)
        attempt, files = uuid.uuid4().hex, []
        waiting: dict[int, list[pa.RecordBatch]] = {}
        opened: dict[int, tuple[pq.ParquetWriter, int]] = {}

        def put(shard: int, rows: pa.Table) -> None:
            """Rows into the shard's open file; a new one begins where that has its number of rows."""
            while rows.num_rows:
                if shard not in opened:
                    name, folder = f"{attempt}-{len(files)}.parquet", f"{root}/{self.staging}/shard={shard}"
                    # not recursive: an abort has taken the staging folder away from the tasks that still run
                    fs.create_dir(folder, recursive=False)
                    files.append((shard, name))
                    opened[shard] = pq.ParquetWriter(f"{folder}/{name}", _PAIRS, filesystem=fs), 0
                writer, written = opened.pop(shard)
                part = rows.slice(0, self.file_rows - written)
                writer.write_table(part)
                rows = rows.slice(part.num_rows)
                if written + part.num_rows < self.file_rows:
                    opened[shard] = writer, written + part.num_rows
                else:
                    writer.close()

        def flush() -> None:
            for shard, batches in waiting.items():
                put(shard, pa.Table.from_batches(batches))
            waiting.clear()

        size = 0
        for batch in iterator:
            pairs = pa.RecordBatch.from_arrays([batch["key"].cast(pa.string()), batch["value"].cast(pa.string())], schema=_PAIRS)
            numbers = pa.array([shard_of(k, self.shards) for k in pairs["key"].to_pylist()], pa.int32())
            for shard in numbers.unique().to_pylist():
                waiting.setdefault(shard, []).append(pairs.filter(pc.equal(numbers, shard)))
            size += pairs.nbytes
            if size >= _BUFFER_BYTES:
                flush()
                size = 0
        flush()
        for writer, _ in opened.values():
            writer.close()
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        fs, root = _opened(self.path)
        if self.overwrite:
            for info in fs.get_file_info(pafs.FileSelector(root)):
                if info.base_name.startswith("shard="):
                    fs.delete_dir(info.path)
        files = [file for message in messages if message for file in message.files]
        for shard in sorted({shard for shard, _ in files}):
            fs.create_dir(f"{root}/shard={shard}", recursive=True)
        for shard, name in files:
            fs.move(f"{root}/{self.staging}/shard={shard}/{name}", f"{root}/shard={shard}/{name}")
        self._clear(fs, root)

    def abort(self, messages: list[Written | None]) -> None:
        self._clear(*_opened(self.path))

    def _clear(self, fs: pafs.FileSystem, root: str) -> None:
        folder = f"{root}/{self.staging}"
        for _ in range(20):  # a task that still runs may add a file meanwhile
            if fs.get_file_info(folder).type != pafs.FileType.Directory:
                return
            try:
                fs.delete_dir(folder)
            except OSError:
                time.sleep(0.1)


class ShardedStore(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return "key string, value string, shard int"

    def reader(self, schema) -> DataSourceReader:
        return (_PushedReader if self.options.get("pushdown") == "true" else _Reader)(dict(self.options))

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(dict(self.options), overwrite)


def load(
    spark: SparkSession, path: str, shards: int, keys: Sequence[str] | None = None, partition_bytes: int = PARTITION_BYTES
) -> DataFrame:
    """(key, value, shard) of the store; with ``keys`` only the shards that can hold one of them are opened."""
    spark.dataSource.register(ShardedStore)
    options = {"path": path, "shards": shards, "partition_bytes": partition_bytes, "pushdown": spark.conf.get(PUSHDOWN, "false")}
    if keys is not None:
        options["keys"] = json.dumps(list(keys))
    return spark.read.format(NAME).options(**options).load()


def save(pairs: DataFrame, path: str, shards: int, mode: str = "append", file_rows: int = 1_000_000) -> None:
    """Write (key, value), both as text; rows of a shard come together first, so that it gets few files."""
    pairs.sparkSession.dataSource.register(ShardedStore)
    texts = pairs.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))
    together = texts.withColumn("_shard", shard_column("key", shards)).hint("rebalance", "_shard").select("key", "value")
    together.write.format(NAME).options(path=path, shards=shards, file_rows=file_rows).mode(mode).save()
