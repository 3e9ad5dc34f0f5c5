"""A table's snapshot and then its changes, as one stream.

A Python data source whose first micro-batch reads a snapshot and whose later ones
read the change files that have arrived in a folder since, in the order of their
names. Snapshot rows come as change records with ``op = 'r'``, time 0 and no
before image; change files hold envelope JSON lines.

An offset says how far the snapshot's and the changes' file names had got, and
nothing else: it is found by listing, and a batch is planned from its two offsets
alone. So a stream that is started again, on another driver too, runs a batch
that was cut short on the same files and goes on behind the last one, without gap
or repeat. Changes that were there before the stream began belong to its first
batch. Names must grow: a change file whose name sorts before one already read
is never read.

Each file is one partition, read where the task runs.
"""

from __future__ import annotations

import json
import posixpath

import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from .cdc import ENVELOPE

FORMAT = "martflow_snapshot_changes"


def _file_system(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def _files(path: str, suffix: str) -> list[str]:
    fs, base = _file_system(path)
    found = fs.get_file_info(pafs.FileSelector(base, allow_not_found=True))
    return sorted(posixpath.basename(f.path) for f in found if f.type == pafs.FileType.File and f.path.endswith(suffix)
                  and not posixpath.basename(f.path).startswith(("_", ".")))


class FilePart(InputPartition):
    def __init__(self, kind: str, name: str):
        self.kind, self.name = kind, name


class SnapshotReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.snapshot, self.changes = options["snapshot"], options["changes"]
        self.table, self.db = options["table"], options.get("db", "stream_retail")

    def initialOffset(self) -> dict:
        return {"snapshot": None, "changes": ""}

    def latestOffset(self) -> dict:
        return {"snapshot": max(_files(self.snapshot, ".parquet"), default=""), "changes": max(_files(self.changes, ".json"), default="")}

    def partitions(self, start: dict, end: dict):
        parts = []
        if start["snapshot"] is None:
            parts += [FilePart("snapshot", f) for f in _files(self.snapshot, ".parquet") if f <= end["snapshot"]]
        return parts + [FilePart("changes", f) for f in _files(self.changes, ".json") if start["changes"] < f <= end["changes"]]

    def read(self, partition: FilePart):
        if partition.kind == "snapshot":
            fs, base = _file_system(self.snapshot)
            source = {"db": self.db, "table": self.table}
            with pq.ParquetFile(fs.open_input_file(posixpath.join(base, partition.name))) as f:
                for b in f.iter_batches():
                    for row in b.to_pylist():
                        yield (None, {k: None if v is None else str(v) for k, v in row.items()}, source, "r", 0, 0)
        else:
            fs, base = _file_system(self.changes)
            with fs.open_input_stream(posixpath.join(base, partition.name)) as s:
                rest = b""
                while block := s.read(1 << 20):
                    *lines, rest = (rest + block).split(b"\n")
                    yield from map(_envelope, filter(None, lines))
                if rest:
                    yield _envelope(rest)

    def commit(self, end: dict) -> None:
        pass


def _envelope(line: bytes) -> tuple:
    r = json.loads(line)

    def text(m):
        return None if m is None else {k: v if v is None or isinstance(v, str) else json.dumps(v) for k, v in m.items()}

    return text(r.get("before")), text(r.get("after")), text(r.get("source")), r.get("op"), r.get("ts_ms"), r.get("pos") or 0


class SnapshotSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self):
        return ENVELOPE

    def streamReader(self, schema):
        return SnapshotReader(self.options)


def read_snapshot_then_changes(spark: SparkSession, snapshot: str, changes: str, table: str, db: str = "stream_retail") -> DataFrame:
    """Envelope stream of one table: ``snapshot`` is a folder of Parquet files,
    ``changes`` one of envelope JSON-line files whose names sort by age."""
    spark.dataSource.register(SnapshotSource)
    return spark.readStream.format(FORMAT).option("snapshot", snapshot).option("changes", changes) \
        .option("table", table).option("db", db).load()
