"""Readers for files, packed records and external tables."""

from __future__ import annotations

import dataclasses
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

_TYPES = {int: T.LongType(), float: T.DoubleType(), str: T.StringType(), bool: T.BooleanType()}


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def collection(spark: SparkSession, rows: Sequence[tuple], schema: str, partitions: int) -> DataFrame:
    """A small in-memory list as a DataFrame in ``partitions`` partitions."""
    return spark.createDataFrame(rows, schema).repartition(partitions)


def json_table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """JSON files; the schema is inferred unless given."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def json_strings(df: DataFrame, column: str, schema: str) -> DataFrame:
    """JSON text of a column as columns of its own."""
    return df.withColumn("_json", F.from_json(column, schema)).select(*[c for c in df.columns if c != column], "_json.*")


def delimited(spark: SparkSession, path: str, schema: str, sep: str = ",") -> DataFrame:
    return spark.read.schema(schema).option("sep", sep).csv(path)


def merged_schema(spark: SparkSession, path: str) -> DataFrame:
    """Parquet files with different columns; a column a file lacks is null."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def schema_of(record: type) -> T.StructType:
    """Schema of a dataclass."""
    hints = {f.name: f.type if isinstance(f.type, type) else eval(f.type) for f in dataclasses.fields(record)}
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in hints.items()])


def typed(df: DataFrame, record: type) -> DataFrame:
    """Columns of ``df`` by name, in the order and types of a dataclass."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema_of(record)])


def xml_row(columns: Mapping[str, Column]) -> Column:
    """``<row Name="value" ... />`` text; a null value leaves its attribute out."""
    parts = []
    for name, value in columns.items():
        text = value.cast("string")
        for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
            text = F.replace(text, F.lit(char), F.lit(entity))
        parts.append(F.concat(F.lit(f'{name}="'), text, F.lit('"')))
    return F.concat(F.lit("<row "), F.concat_ws(" ", *parts), F.lit(" />"))


def xml_rows(lines: DataFrame, column: str, fields: Mapping[str, str]) -> DataFrame:
    """Attributes of ``<row .../>`` lines as columns; a missing attribute is null."""
    schema = ", ".join(f"_{name} {kind}" for name, kind in fields.items())
    parsed = lines.select(F.from_xml(column, schema).alias("r"))
    return parsed.select(*[F.col(f"r._{name}").alias(name) for name in fields])


def xml_files(spark: SparkSession, path: str, fields: Mapping[str, str], row_tag: str = "row", broken: str = "_broken") -> DataFrame:
    """Attributes of the ``row_tag`` elements of XML files, whatever stands around them.

    Large files are split between tasks. An element that is no XML has null fields and its text in ``broken``, which is
    null for all others; so no row is lost, and none stops the read. A value that is not of its field's type counts
    as broken too. Spark refuses to read ``broken`` alone from the files; select it with a field, or store the rows.
    """
    schema = ", ".join([*(f"_{name} {kind}" for name, kind in fields.items()), f"{broken} string"])
    reader = spark.read.format("xml").schema(schema).option("rowTag", row_tag).option("mode", "PERMISSIVE")
    # element by element: the other parser gives up the rest of a file at the first broken one, and fails on wrong types
    reader = reader.option("useLegacyXMLParser", "true").option("columnNameOfCorruptRecord", broken)
    rows = reader.load(path)
    return rows.select(*[F.col(f"_{name}").alias(name) for name in fields], broken)


def json_variant(df: DataFrame, column: str) -> DataFrame:
    """JSON text of a column parsed once, into a variant that keeps all its fields; what is no JSON becomes null."""
    return df.withColumn(column, F.try_parse_json(column))


def variant_fields(df: DataFrame, column: str, fields: Mapping[str, tuple[str, str]]) -> DataFrame:
    """``name: (path, type)`` of a variant as columns beside it; what is missing or not of the type becomes null."""
    return df.select("*", *[F.try_variant_get(column, path, kind).alias(name) for name, (path, kind) in fields.items()])


def variant_schema(df: DataFrame, column: str, *keys: str, name: str = "fields") -> DataFrame:
    """The fields and types that all values of a variant have together, for each ``keys``."""
    return df.groupBy(*keys).agg(F.schema_of_variant_agg(column).alias(name))


def tagged(sources: Mapping[str, DataFrame]) -> DataFrame:
    """Several inputs as one table with their origin; a column an input lacks is null."""
    frames = [df.withColumn("origin", F.lit(tag)) for tag, df in sources.items()]
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def jdbc_table(
    spark: SparkSession,
    url: str,
    name: str,
    split: tuple[str, int, int, int] | None = None,
    **options: str,
) -> DataFrame:
    """A database table; ``split`` (column, low, high, parts) reads it in parallel ranges."""
    return spark.read.format("jdbc").options(**jdbc_options(url, name, split, **options)).load()


def jdbc_options(
    url: str, name: str, split: tuple[str, int, int, int] | None = None, **options: str
) -> dict[str, str]:
    out = {"url": url, "dbtable": name, **options}
    if split is not None:
        column, low, high, parts = split
        out |= {"partitionColumn": column, "lowerBound": str(low), "upperBound": str(high), "numPartitions": str(parts)}
    return out


def good_students(students: DataFrame, scores: DataFrame, over: int) -> DataFrame:
    """Two tables joined on name, kept above a score; the filter reaches the source."""
    return students.join(scores.where(F.col("score") > over), "name")


def sharded(spark: SparkSession, path: str, shards: int, key: Column | None = None) -> DataFrame:
    """Pairs of a sharded store; with a ``key`` only the shard that can hold it is read."""
    pairs = spark.read.parquet(path)
    if key is None:
        return pairs
    return pairs.where((F.col("shard") == F.pmod(F.hash(key), F.lit(shards))) & (F.col("key") == key))


def months(spark: SparkSession, path: str, wanted: Sequence[str]) -> DataFrame:
    """Only the folders of the given months."""
    return spark.read.parquet(path).where(F.col("month").isin(*wanted))


def months_of(spark: SparkSession, path: str, chosen: DataFrame, facts: str) -> DataFrame:
    """Rows of the months that ``chosen`` names, found while the query runs.

    ``chosen`` has one row a month and a condition on it; its months prune the folders of the facts before they are
    read (dynamic partition pruning). It is broadcast, as a calendar has 12 rows a year. ``facts`` is the facts' schema
    without ``month``, so that no file is opened to find it.
    """
    rows = spark.read.schema(f"{facts}, month string").parquet(path)
    return rows.join(F.broadcast(chosen), "month")
