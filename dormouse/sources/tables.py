"""Opening the account tables from files, a catalog or a live database."""

from __future__ import annotations

from collections.abc import Callable, Collection, Iterator, Mapping
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dormouse.sources.schemas import SOURCE_COLUMNS, SOURCE_NAMES


class Tables(Mapping[str, DataFrame]):
    """The tables of one system by name, each opened and checked when first used."""

    def __init__(
        self, schemas: Mapping[str, T.StructType], open_table: Callable[[str], DataFrame]
    ) -> None:
        self._schemas = schemas
        self._open_table = open_table
        self._opened: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        schema = self._schemas[name]
        if name not in self._opened:
            self._opened[name] = conform(name, self._open_table(name), schema)
        return self._opened[name]

    def raw(self, name: str) -> DataFrame:
        """The table as its source has it, with all columns under their own names."""
        if name not in self._schemas:
            raise KeyError(name)
        return self._open_table(name)

    def opened(self) -> Mapping[str, DataFrame]:
        """The tables used so far."""
        return dict(self._opened)

    def __iter__(self) -> Iterator[str]:
        return iter(self._schemas)

    def __len__(self) -> int:
        return len(self._schemas)


def conform(name: str, table: DataFrame, schema: T.StructType) -> DataFrame:
    """Only the columns used, in the types expected, with ``active`` as boolean ``is_active``.

    Columns that already have the right type are left alone, so filters on
    them still reach the scan.
    """
    found = {field.name.lower(): field.dataType for field in table.schema}
    renamed = {
        target: source
        for source, target in SOURCE_COLUMNS.get(name, {}).items()
        if source in found and target not in found
    }
    columns, missing = [], []
    for field in schema:
        source = renamed.get(field.name, field.name)
        if source in found:
            columns.append(_column(source, field, found[source]))
        elif field.name == "lower_group_name" and "group_name" in found:
            columns.append(F.lower("group_name").alias(field.name))
        else:
            missing.append(field.name)
    if missing:
        raise ValueError(f"table {name!r} lacks columns {missing}; it has {sorted(found)}")
    return table.select(*columns)


def _column(source: str, field: T.StructField, found: T.DataType) -> Column | str:
    if field.name == "active":
        return _flag(F.col(source), found).alias("is_active")
    if found != field.dataType:
        return F.col(source).cast(field.dataType).alias(field.name)
    return source if source == field.name else F.col(source).alias(field.name)


def _flag(column: Column, found: T.DataType) -> Column:
    if isinstance(found, T.BooleanType):
        return column
    if isinstance(found, T.StringType):
        return column == "T"
    return column == 1


def from_parquet(
    spark: SparkSession,
    root: str,
    schemas: Mapping[str, T.StructType],
    names: Mapping[str, str] = SOURCE_NAMES,
) -> Tables:
    """Tables exported as Parquet, one folder or file per table below ``root``."""
    return Tables(schemas, lambda name: spark.read.parquet(f"{root}/{names[name]}"))


def from_catalog(
    spark: SparkSession,
    database: str,
    schemas: Mapping[str, T.StructType],
    names: Mapping[str, str] = SOURCE_NAMES,
) -> Tables:
    """Tables of a catalog database."""
    return Tables(schemas, lambda name: spark.table(f"{database}.`{names[name]}`"))


@dataclass(frozen=True)
class Split:
    """How to read one database table in parallel ranges of a column."""

    column: str
    lower: int | datetime
    upper: int | datetime
    partitions: int


def from_jdbc(
    spark: SparkSession,
    url: str,
    schemas: Mapping[str, T.StructType],
    splits: Mapping[str, Split],
    properties: Mapping[str, str] | None = None,
    names: Mapping[str, str] = SOURCE_NAMES,
    small: Collection[str] = (),
) -> Tables:
    """Tables of a live database, each read in the ranges of its split.

    A table without one is read by a single task, so it has to be named in
    ``small``; any other is refused when it is first used.
    """

    def open_table(name: str) -> DataFrame:
        if name not in splits and name not in small:
            raise ValueError(f"table {name!r} needs a split, or to be marked as small")
        reader = spark.read.format("jdbc").option("url", url)
        reader = reader.option("dbtable", f'"{names[name]}"').options(**(properties or {}))
        if name in splits:
            split = splits[name]
            reader = reader.options(
                partitionColumn=split.column,
                lowerBound=str(split.lower),
                upperBound=str(split.upper),
                numPartitions=str(split.partitions),
            )
        return reader.load()

    return Tables(schemas, open_table)
