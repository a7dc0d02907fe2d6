"""Writing results: tables, slices, reports, JDBC."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, functions as F

from ledgerloom.session import scratch, shared_folder, written_table
from ledgerloom.sources.tables import JdbcTarget

BATCH_ROWS = 10_000


def write_table(
    df: DataFrame, target: str, columns: Sequence[str] | None = None, as_path: bool = True, files: int | None = None
) -> None:
    """Replace a parquet folder or metastore table, columns picked by name.

    The number of files follows the data unless ``files`` asks for a redistribution.
    """
    df = df.select(*columns) if columns else df
    out = (df.repartition(files) if files else df).write.mode("overwrite")
    # A full replacement also drops the partitions the new rows do not have.
    out = out.option("partitionOverwriteMode", "static")
    out.parquet(target) if as_path else out.saveAsTable(target)


def staged_overwrite(df: DataFrame, path: str) -> None:
    """Replace ``path`` with rows that may have been read from ``path`` itself.

    The rows are first written to the shared folder, and deleted there once ``path`` is
    whole. Should the second write be lost half-way, the staged copy stays and the error
    names its folder.
    """
    with scratch(df.sparkSession):
        staged = written_table(df, "staged")
        try:
            staged.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
        except Exception as error:
            error.add_note(f"{path} can be restored from the staged copy in {shared_folder(df.sparkSession)}: {staged.inputFiles()[:1]}")
            raise


def replace_slice(df: DataFrame, path: str, part_col: str) -> None:
    """Replace just the partitions ``df`` has rows for; a rerun gives the same table.

    A partition that should become empty keeps its old rows; ``VersionedTable.replace_slices``
    names the slices it replaces and empties those.
    """
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(part_col)
        .parquet(path)
    )


def write_report_csv(df: DataFrame, path: str, files: int | None = None) -> int:
    """Write a CSV report and return its row count, taken while writing.

    The number of files follows the data unless ``files`` asks for a redistribution
    (1 for a report that is to be opened by hand).
    """
    out = df.repartition(files) if files else df
    return write_counted(out, lambda rows: rows.write.mode("overwrite").csv(path, header=True))


def observed_count(df: DataFrame, name: str = "written") -> tuple[DataFrame, Observation]:
    """Row count taken while the frame is written, instead of a second run for ``count()``."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def write_counted(df: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """Run one of the writers above and return how many rows went through it."""
    counted, seen = observed_count(df)
    write(counted)
    return seen.get["rows"]


def jdbc_write_options(
    target: JdbcTarget, table: str, max_connections: int, column_types: Mapping[str, str] | None = None
) -> dict[str, str]:
    options = {
        **target.options(),
        "dbtable": table,
        "batchsize": str(BATCH_ROWS),
        "numPartitions": str(max_connections),
        "truncate": "false",
    }
    if column_types:
        options["createTableColumnTypes"] = ", ".join(f"{c} {t}" for c, t in column_types.items())
    return options


def write_jdbc(
    df: DataFrame,
    target: JdbcTarget,
    table: str,
    max_connections: int,
    mode: str = "overwrite",
    column_types: Mapping[str, str] | None = None,
) -> None:
    """Overwrite or append a JDBC table; ``column_types`` declares the created columns.

    ``max_connections`` bounds the connections however many partitions the result has.
    """
    df.write.format("jdbc").mode(mode).options(**jdbc_write_options(target, table, max_connections, column_types)).save()


def typed(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast columns to the types a sink declares."""
    return df.withColumns({c: F.col(c).cast(t) for c, t in types.items()})
