"""Listing a stage as a Spark data source: tasks list its folders, empty files included (S9, T-12).

Spark's own file sources list on the driver, keep every file's status there
and leave out files without bytes. This source only looks at the first level
of the stage when it is planned; a task lists each folder found there with all
that lies below it, and another one the files directly in the stage. Rows go from the tasks into the plan, so a listing can be filtered,
joined and written like any table and never is on the driver.

The store is reached through ``pyarrow.fs`` (local files, S3, GCS, ABFS, HDFS with
its client library). Names are hidden as Spark hides them: a leading ``.``, or a
leading ``_`` without ``=``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fnmatch import fnmatchcase

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "path string, name string, size bigint, last_modified timestamp_ntz"
ROWS = 10_000   # files of a batch of rows
TASKS = 1000    # tasks of a listing, at most
FEW, FOLDERS = 32, 16   # so many folders have a task each; of more, a task takes several: starting it takes longer


def open_store(root: str):
    """(file system, base path) of a qualified root such as ``file:/x`` or ``s3a://bucket/x``."""
    from pyarrow import fs
    uri = root
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    if uri.startswith(("s3a://", "s3n://")):
        uri = "s3" + uri[3:]
    store, base = fs.FileSystem.from_uri(uri)
    return store, base.rstrip("/")


def hidden(name: str) -> bool:
    return name.startswith(".") or (name.startswith("_") and "=" not in name)


@dataclass
class Prefixes(InputPartition):
    paths: list[str]
    recursive: bool


class StageReader(DataSourceReader):
    def __init__(self, root: str, name_glob: str | None = None):
        self.root, self.name_glob = root, name_glob

    def partitions(self) -> list[Prefixes]:
        from pyarrow import fs
        store, base = open_store(self.root)
        found = store.get_file_info(fs.FileSelector(base, allow_not_found=True))
        folders = sorted(f.path for f in found if f.type == fs.FileType.Directory and not hidden(f.base_name))
        n = min(len(folders), max(FEW, min(TASKS, -(-len(folders) // FOLDERS))))
        return [Prefixes([base], False), *[Prefixes(folders[k::n], True) for k in range(n)]]

    def read(self, partition: Prefixes) -> Iterator:
        store, base = open_store(self.root)
        for path in partition.paths:
            yield from self._list(store, base, path, partition.recursive)

    def _list(self, store, base: str, path: str, recursive: bool) -> Iterator:
        import pyarrow as pa
        from pyarrow import fs
        found = store.get_file_info(fs.FileSelector(path, allow_not_found=True, recursive=recursive))
        rows = []
        for f in found:
            name = f.path[len(base) + 1:]
            if (f.type == fs.FileType.File and not any(hidden(part) for part in name.split("/"))
                    and (self.name_glob is None or fnmatchcase(f.base_name, self.name_glob))):
                rows.append((f"{self.root}/{name}", name, f.size, (f.mtime_ns or 0) // 1_000_000 * 1000))
        for at in range(0, len(rows), ROWS):
            path, name, size, time = zip(*rows[at:at + ROWS], strict=True)
            yield pa.RecordBatch.from_pydict({
                "path": pa.array(path), "name": pa.array(name), "size": pa.array(size, pa.int64()),
                "last_modified": pa.array(time, pa.timestamp("us"))})


class StageFiles(DataSource):
    """``spark.read.format("stage_files").load(root)`` with a qualified root."""

    @classmethod
    def name(cls) -> str:
        return "stage_files"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> StageReader:
        return StageReader(self.options["path"].rstrip("/"), self.options.get("name_glob"))
