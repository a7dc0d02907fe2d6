"""Keeping stored tables fresh: newest versions, deltas, slices, dated snapshots."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ledgerloom.operators.merge import change_flag, upsert
from ledgerloom.operators.windows import latest_per_key
from ledgerloom.sources.versions import VersionedTable


@dataclass(frozen=True)
class TableSpec:
    """A table to refresh: its key and the column that orders versions."""

    table: str
    key: str
    order: str


def parse_specs(text: str) -> list[TableSpec]:
    """Specs from ``table--key--order`` triples separated by commas."""
    return [TableSpec(*(p.strip() for p in item.split("--"))) for item in text.split(",") if item.strip()]


def newest_versions(
    tables: Mapping[str, DataFrame], specs: Sequence[TableSpec], ties: Mapping[str, Sequence[str]] | None = None
) -> Iterator[tuple[str, DataFrame]]:
    """Newest row per key of every listed table, to be written with a staged overwrite."""
    for spec in specs:
        extra = (ties or {}).get(spec.table, ())
        yield spec.table, latest_per_key(tables[spec.table], [spec.key], spec.order, extra)


def merged_deltas(
    tables: Mapping[str, DataFrame], deltas: Mapping[str, DataFrame], specs: Sequence[TableSpec], insert_new: bool = True
) -> Iterator[tuple[str, DataFrame]]:
    """Every listed table with its delta applied; versions inside a delta are reduced first."""
    for spec in specs:
        newest = latest_per_key(deltas[spec.table], [spec.key], spec.order)
        yield spec.table, upsert(tables[spec.table], newest, [spec.key], insert_new)


def refresh_stores(
    stores: Mapping[str, VersionedTable], specs: Sequence[TableSpec], ties: Mapping[str, Sequence[str]] | None = None
) -> None:
    """Reduce every listed stored table to the newest row per key, each in one step."""
    stored = {spec.table: stores[spec.table].read() for spec in specs}
    for name, newest in newest_versions(stored, specs, ties):
        stores[name].publish(newest)


def apply_deltas(
    stores: Mapping[str, VersionedTable], deltas: Mapping[str, DataFrame], specs: Sequence[TableSpec], insert_new: bool = True
) -> dict[str, list[str]]:
    """Apply deltas to tables stored by key; returns the buckets rewritten of each table.

    Versions inside a delta are reduced first. A table whose delta fails stays as it was,
    as do the tables after it.
    """
    return {
        spec.table: stores[spec.table].upsert(latest_per_key(deltas[spec.table], [spec.key], spec.order), insert_new)
        for spec in specs
    }


def publish_flagged(
    store: VersionedTable,
    status: DataFrame,
    run: str,
    key: Sequence[str],
    text_cols: Sequence[str],
    int_cols: Mapping[str, int | None],
    name: str = "changed",
) -> DataFrame:
    """Publish a run's status rows, flagged against the last run before it.

    ``run`` orders the runs (a date as text). A repeated run is flagged against the same
    earlier one as the first time, not against itself; the first run meets no rows.
    """
    earlier = store.before(run)
    flagged = change_flag(status, status.limit(0) if earlier is None else earlier, key, text_cols, int_cols, name)
    return store.read(store.publish(flagged, label=run))


def previous_month(as_of: str) -> str:
    """Month (``yyyy-MM``) of the day before ``as_of``."""
    return (dt.date.fromisoformat(as_of) - dt.timedelta(days=1)).strftime("%Y-%m")


def keep_other_slices(stored: DataFrame, fresh: DataFrame, col: str, replaced: Sequence[str]) -> DataFrame:
    """Stored rows outside the replaced slices plus the fresh rows."""
    return stored.where(~stored[col].isin(*replaced) | stored[col].isNull()).unionByName(fresh)
