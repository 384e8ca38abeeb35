"""Load modes of the marts (K1 replace window, K2 full refresh, K3 append).

All three write new rows beside the table and commit one manifest
(``versions``), so a reader sees the old version or the new one, and a job that
dies at any step leaves the old version:

* K1 windows start on a whole day or month, and a mart is partitioned by it.
  The new version has the new rows' partitions in place of all partitions of
  the window; a window partition without new rows is empty from then on, and
  partitions before the window and listed ``keep`` partitions stay the same files.
* K2 replaces all rows.
* K3 adds rows under a batch name. A ledger in the manifest holds rows and
  checksum of every batch and partition: a batch that comes again adds nothing,
  one that comes again with other rows is refused, and a partition that K1 has
  replaced since forgets what batches had added to it.

A ``note`` (run, versions read) is stored with the version that it belongs to.
"""

from __future__ import annotations

import json
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from . import versions
from .versions import Batch, Manifest


REPLACE, REFRESH, APPEND = "replace window", "full refresh", "append"


class BatchMismatch(ValueError):
    """A batch came again with other rows than the first time."""


def exists(spark: SparkSession, path: str) -> bool:
    return versions.current(spark, path) is not None


def _schema(df: DataFrame, part_col: str | None) -> str:
    """The table's schema; partition columns stand last, as Parquet readers put them."""
    return df.select(*[c for c in df.columns if c != part_col], *([part_col] if part_col else [])).schema.json()


def _checked(before: Manifest | None, path: str, schema: str, part_col: str | None) -> None:
    if before and before.part_col != part_col:
        raise ValueError(f"{path} is partitioned by {before.part_col}, not by {part_col}")
    if before and _types(before.schema) != _types(schema):
        raise ValueError(f"{path} has other columns: {_types(before.schema)}, not {_types(schema)}")


def _types(schema: str) -> list[tuple[str, str]]:
    return [(f["name"], str(f["type"])) for f in json.loads(schema)["fields"]]


def _commit(spark: SparkSession, path: str, before: Manifest | None, after: Manifest, new: dict) -> None:
    """Commits ``after``, with the rows of the ``new`` folders from the Parquet footers."""
    versions.ensure_last(spark, path, before)  # an overtaking writer may have deleted them
    versions.commit(spark, path, before, replace(after, rows=versions.read(spark, path, after, new).count()))
    versions.vacuum(spark, path)


def replace_window(df: DataFrame, path: str, part_col: str, in_window, keep=(), note: dict | None = None) -> list[str]:
    """K1: replace every partition ``v`` with ``in_window(v)`` true by ``df``.

    ``df`` must carry ``part_col`` and only rows of the window. Returns the
    partition values that are empty now, as they received no rows.
    """
    spark, schema = df.sparkSession, _schema(df, part_col)
    before = versions.current(spark, path)
    _checked(before, path, schema, part_col)
    new = versions.write_rows(df, path, part_col)
    old = before.folders if before else {}
    emptied = [v for v in old if in_window(v) and v not in keep and v not in new]
    folders = {v: f for v, f in old.items() if v not in new and v not in emptied} | new
    batches = tuple(b for b in (before.batches if before else ()) if b.value not in new and b.value not in emptied)
    after = Manifest(0, REPLACE, schema, part_col, dict(sorted(folders.items())), batches, note=note or {})
    _commit(spark, path, before, after, new)
    return emptied


def full_refresh(df: DataFrame, path: str, note: dict | None = None) -> None:
    """K2: replace the whole table. ``df`` may read the version it replaces."""
    spark = df.sparkSession
    before = versions.current(spark, path)
    new = versions.write_rows(df, path, None)
    after = Manifest(0, REFRESH, df.schema.json(), None, new, note=note or {})
    _commit(spark, path, before, after, new)


def append_rows(df: DataFrame, path: str, batch: str, part_col: str | None = None, note: dict | None = None) -> int:
    """K3: add the rows of ``df`` as ``batch``, once; returns how many were added.

    A partition to which the batch has added before gets nothing if the rows are
    the same again, and BatchMismatch is raised, before any change, if they aren't.
    """
    spark, schema = df.sparkSession, _schema(df, part_col)
    before = versions.current(spark, path)
    _checked(before, path, schema, part_col)
    written = versions.write_rows(df, path, part_col)
    draft = Manifest(0, APPEND, schema, part_col, written)
    versions.ensure_last(spark, path, before)
    sums = versions.summed(versions.read(spark, path, draft), part_col)
    known = {b.value: b for b in (before.batches if before else ()) if b.batch == batch}
    for value, (n, checksum) in sums.items():
        if value in known and (known[value].rows, known[value].checksum) != (n, checksum):
            raise BatchMismatch(f"{path}: batch {batch} had {known[value].rows} rows in partition {value}, now {n}, or others")
    missing = [v for v in known if v not in sums and known[v].rows]
    if missing:
        raise BatchMismatch(f"{path}: batch {batch} had rows in partitions {missing}, now it has none")
    fresh = {v: x for v, x in sums.items() if v not in known}
    if not fresh and before:
        versions.vacuum(spark, path)
        return 0
    for folder in (f for v, fs in written.items() if v not in fresh for f in fs):
        versions.Files(spark, path).delete(versions.DATA, *folder.split("/"))
    folders = {v: list(f) for v, f in (before.folders if before else {}).items()}
    for value in fresh:
        folders[value] = folders.get(value, []) + written.get(value, [])
    folders = {v: f for v, f in folders.items() if f}
    batches = (*(before.batches if before else ()), *[Batch(batch, v, n, c) for v, (n, c) in fresh.items()])
    order = folders if part_col is None else dict(sorted(folders.items()))
    added = sum(n for n, _ in fresh.values())
    versions.commit(spark, path, before, replace(draft, folders=order, batches=batches, rows=added, note=note or {}))
    versions.vacuum(spark, path)
    return added


def read_table(spark: SparkSession, path: str, columns=None, version: int | None = None) -> DataFrame:
    """The current version of a mart, or the listed one with that number."""
    found = [m for m in versions.history(spark, path, None if version else 1) if version in (None, m.number)]
    if not found:
        raise FileNotFoundError(f"no table {path}" if version is None else f"no version {version} of {path}")
    df = versions.read(spark, path, found[-1])
    return df.select(*columns) if columns else df
