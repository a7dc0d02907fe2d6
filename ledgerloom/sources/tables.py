"""Named tables: parquet folders, metastore tables and JDBC tables behind one catalog."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ledgerloom.sources.versions import VersionedTable


@dataclass(frozen=True)
class Catalog(Mapping[str, DataFrame]):
    """Logical table name to DataFrame.

    A name resolves to its entry in ``stores`` (the newest version of a versioned table),
    else in ``paths`` (parquet), else in ``tables`` (metastore), else to
    ``<root>/<name>.parquet``.
    """

    spark: SparkSession
    root: str | None = None
    paths: Mapping[str, str] = field(default_factory=dict)
    tables: Mapping[str, str] = field(default_factory=dict)
    stores: Mapping[str, str] = field(default_factory=dict)
    _opened: dict[str, DataFrame] = field(default_factory=dict, repr=False, compare=False)

    def __getitem__(self, name: str) -> DataFrame:
        # Opening lists files and reads a footer, so each name is opened once.
        if name not in self._opened:
            self._opened[name] = self._open(name)
        return self._opened[name]

    def _open(self, name: str) -> DataFrame:
        if name in self.stores:
            return VersionedTable(self.spark, self.stores[name]).read()
        if name in self.paths:
            return self.spark.read.parquet(self.paths[name])
        if name in self.tables:
            return self.spark.table(self.tables[name])
        if self.root is None:
            raise KeyError(name)
        return self.spark.read.parquet(f"{self.root}/{name}.parquet")

    def __iter__(self) -> Iterator[str]:
        return iter({**self.stores, **self.paths, **self.tables})

    def __len__(self) -> int:
        return len({**self.stores, **self.paths, **self.tables})


@dataclass(frozen=True)
class JdbcTarget:
    """Connection of a JDBC database; credentials come from the caller, never from code."""

    url: str
    user: str
    password: str = field(repr=False)
    driver: str = "com.mysql.cj.jdbc.Driver"

    def options(self) -> dict[str, str]:
        return {"url": self.url, "user": self.user, "password": self.password, "driver": self.driver}


def jdbc_read_options(
    target: JdbcTarget,
    table: str,
    partition_col: str | None = None,
    bounds: tuple[str, str] | None = None,
    partitions: int | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    options = {**target.options(), "dbtable": table, "fetchsize": str(fetch_size)}
    if partition_col:
        if bounds is None or partitions is None:
            raise ValueError("a partitioned read needs the bounds of its column and a number of slices")
        options |= {
            "partitionColumn": partition_col,
            "lowerBound": bounds[0],
            "upperBound": bounds[1],
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(spark: SparkSession, target: JdbcTarget, table: str, **kwargs) -> DataFrame:
    """Read a JDBC table; with ``partition_col`` and ``bounds`` in parallel slices."""
    return spark.read.format("jdbc").options(**jdbc_read_options(target, table, **kwargs)).load()


def period_slice(df: DataFrame, col: str, period: str, whole_year: bool = False) -> DataFrame:
    """Rows of one ``yyyyMM`` period, or of its whole year; ``col`` holds such texts or days.

    Written as a range on the column itself, so files and partitions can be skipped.
    """
    if not isinstance(df.schema[col].dataType, T.StringType):
        year, month = int(period[:4]), 1 if whole_year else int(period[4:])
        after = (year + 1, 1) if whole_year or month == 12 else (year, month + 1)
        return df.where((df[col] >= F.lit(dt.date(year, month, 1))) & (df[col] < F.lit(dt.date(*after, 1))))
    if whole_year:
        return df.where(df[col].between(period[:4] + "01", period[:4] + "12"))
    return df.where(df[col] == period)
