"""Readers and writers for named tables, and schema helpers."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Where a reader of records puts a line that is none.
CORRUPT = "_corrupt_record"


@dataclass(frozen=True)
class TableSpec:
    """Where a table is and how it is read or written."""

    path: str
    format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)
    partition_by: tuple[str, ...] = ()
    schema: T.StructType | None = None
    mode: str = "errorifexists"


def read_table(spark: SparkSession, spec: TableSpec) -> DataFrame:
    reader = spark.read.format(spec.format).options(**spec.options)
    if spec.schema is not None:
        reader = reader.schema(spec.schema)
    return reader.load(spec.path)


def read_records(spark: SparkSession, spec: TableSpec) -> DataFrame:
    """JSON lines by spec's schema, with a column more, CORRUPT: the whole line where it is no record, else null.

    A line that can't be parsed, or holds a field of another type, doesn't end the run; its other columns hold what could be
    read, if anything.
    """
    schema = T.StructType([*spec.schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {**spec.options, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return read_table(spark, replace(spec, format="json", options=options, schema=schema))


def quarantined(records: DataFrame) -> DataFrame:
    """trace_source, record, parsed: the broken lines of read_records, their files, and as JSON what could be read of them.

    All columns are asked for, as the reader doesn't look for what is wrong with others.
    """
    parsed = F.to_json(F.struct(*(c for c in records.columns if c != CORRUPT))).alias("parsed")
    return with_source_file(records).select("trace_source", F.col(CORRUPT).alias("record"), parsed).filter("record is not null and parsed is not null")


def read_tables(spark: SparkSession, specs: Mapping[str, TableSpec]) -> dict[str, DataFrame]:
    return {name: read_table(spark, spec) for name, spec in specs.items()}


def write_table(df: DataFrame, spec: TableSpec) -> None:
    """df at spec's path; of mode overwrite_partitions only the partitions that df has rows of are replaced."""
    writer = df.write.format(spec.format).options(**spec.options)
    if spec.mode == "overwrite_partitions":
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode(spec.mode)
    if spec.partition_by:
        writer = writer.partitionBy(*spec.partition_by)
    writer.save(spec.path)


def write_tables(tables: Mapping[str, tuple[DataFrame, TableSpec]]) -> None:
    for df, spec in tables.values():
        write_table(df, spec)


def default_outputs(base: str, format: str, *names: str) -> dict[str, TableSpec]:
    """A spec for each name, in one folder."""
    return {name: TableSpec(f"{base}/{name}", format) for name in names}


def numbered(specs: list[TableSpec]) -> dict[str, TableSpec]:
    """Specs under names that can't collide."""
    return {f"r{i}": spec for i, spec in enumerate(specs)}


def with_source_file(df: DataFrame, name: str = "trace_source") -> DataFrame:
    """The file that each row came from."""
    return df.withColumn(name, F.input_file_name())


def renamed_type(kind: T.DataType, rename: Callable[[str], str]) -> T.DataType:
    """kind with every field renamed, in structs and arrays of structs at any depth."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(rename(f.name), renamed_type(f.dataType, rename), f.nullable) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(renamed_type(kind.elementType, rename), kind.containsNull)
    return kind


def rename_fields(df: DataFrame, rename: Callable[[str], str]) -> DataFrame:
    """df with all fields renamed, nested ones too. A cast by position: no row leaves the engine."""
    return df.select(*(F.col(f"`{f.name}`").cast(renamed_type(f.dataType, rename)).alias(rename(f.name)) for f in df.schema.fields))


def spaces_to_underscores(df: DataFrame) -> DataFrame:
    return rename_fields(df, lambda n: n.replace(" ", "_"))


def snake_to_camel(df: DataFrame) -> DataFrame:
    return rename_fields(df, lambda n: re.sub(r"_+([A-Za-z0-9])", lambda m: m[1].upper(), n))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """df's columns in the order and types of schema; a missing one is null."""
    have = set(df.columns)
    return df.select(*((F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields))
