"""K2 / K5: a transactional sink as a Python data source.

Every task of a micro-batch writes its rows to files of its own and hands their
names to the driver as its commit message. When all tasks are done, the driver
publishes the batch with one small manifest that names the files; a failed batch
is aborted, which removes what its tasks had written. A reader lists manifests,
so it sees a batch as a whole or not at all, also while one is being written or
after a task or the driver was lost; files that no manifest names are garbage.

The manifest of batch n is ``<path>/_commits/<run>/<n>.json``. ``run`` names the
stream's checkpoint: a stream that starts anew with another checkpoint, and so
counts its batches from 0 again, publishes beside the old run. A batch that was
published and is run again (the driver died before the checkpoint noted it) keeps
its first manifest.

Rows go to ``<path>/<topic>/`` where ``topic`` is a column (K2: the topic each row
names) or the option of that name.
"""

from __future__ import annotations

import json
import posixpath
import uuid
from collections import defaultdict
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage

FORMAT = "martflow_txn"
#: Rows that a task holds per topic before it writes them as a row group.
GROUP_ROWS = 20_000


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and plain path of a URI (any that Arrow knows) or a path."""
    if "://" in path or path.startswith("file:"):
        if path.startswith("file:") and not path.startswith("file://"):
            path = "file://" + path[5:]
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, str, int]]  # topic, file name, rows


class TxnWriter(DataSourceStreamArrowWriter):
    def __init__(self, options: dict, schema):
        self.path, self.run = options["path"], options["run"]
        self.topic, self.columns = options.get("topic"), schema.fieldNames()
        if self.topic is None and "topic" not in self.columns:
            raise ValueError("give a topic column or the option topic")

    # -- in the tasks -------------------------------------------------------

    def write(self, iterator) -> Written:
        fs, base = file_system(self.path)
        writers, held, files = {}, defaultdict(list), []

        def flush(topic):
            table = pa.Table.from_batches(held.pop(topic))
            if topic not in writers:
                fs.create_dir(posixpath.join(base, topic), recursive=True)
                name = f"{uuid.uuid4().hex}.parquet"
                writers[topic] = (name, pq.ParquetWriter(fs.open_output_stream(posixpath.join(base, topic, name)), table.schema), [0])
            _, w, n = writers[topic]
            w.write_table(table)
            n[0] += table.num_rows

        try:
            for b in iterator:
                if self.topic is not None:
                    parts = {self.topic: b}
                else:
                    at = b.schema.get_field_index("topic")
                    rows = b.select([c for c in b.schema.names if c != "topic"])
                    where = defaultdict(list)
                    for i, t in enumerate(b.column(at).to_pylist()):
                        where[t or "_none"].append(i)
                    parts = {t: rows.take(pa.array(i)) for t, i in where.items()}
                for t, rows in parts.items():
                    held[t].append(rows)
                    if sum(x.num_rows for x in held[t]) >= GROUP_ROWS:
                        flush(t)
            for t in list(held):
                flush(t)
        except BaseException:
            for t, (name, w, _) in writers.items():
                w.close()
                fs.delete_file(posixpath.join(base, t, name))
            raise
        for t, (name, w, n) in writers.items():
            w.close()
            files.append((t, name, n[0]))
        return Written(files)

    # -- on the driver --------------------------------------------------------

    def _manifest(self, batch_id: int) -> str:
        return posixpath.join(file_system(self.path)[1], "_commits", self.run, f"{batch_id}.json")

    def commit(self, messages, batchId: int) -> None:
        fs, base = file_system(self.path)
        name = self._manifest(batchId)
        files = sorted(f for m in messages if m is not None for f in m.files)
        if fs.get_file_info(name).type == pafs.FileType.File:
            self._remove(fs, base, files)  # published before
            return
        fs.create_dir(posixpath.dirname(name), recursive=True)
        hidden = f"{name}.{uuid.uuid4().hex}.tmp"
        with fs.open_output_stream(hidden) as out:
            out.write(json.dumps({"batch": batchId, "files": files}).encode())
        fs.move(hidden, name)

    def abort(self, messages, batchId: int) -> None:
        fs, base = file_system(self.path)
        self._remove(fs, base, [f for m in messages if m is not None for f in m.files])

    @staticmethod
    def _remove(fs, base, files) -> None:
        for topic, name, _ in files:
            fs.delete_file(posixpath.join(base, topic, name))


class TxnSource(DataSource):
    """``df.writeStream.format("martflow_txn").option("path", ...).option("run", ...)``"""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamWriter(self, schema, overwrite):
        return TxnWriter(self.options, schema)


def txn_stream(stream: DataFrame, path: str, run: str, checkpoint: str, topic: str | None = None, trigger: dict | None = None):
    """Starts the sink: rows to ``path``, each micro-batch whole or not at all."""
    stream.sparkSession.dataSource.register(TxnSource)
    w = stream.writeStream.format(FORMAT).option("path", path).option("run", run).option("checkpointLocation", checkpoint)
    if topic is not None:
        w = w.option("topic", topic)
    return w.trigger(**(trigger or {"processingTime": "0 seconds"})).start()


def committed_files(path: str, topic: str) -> list[str]:
    """The published files of a topic."""
    fs, base = file_system(path)
    found = fs.get_file_info(pafs.FileSelector(posixpath.join(base, "_commits"), allow_not_found=True, recursive=True))
    out = []
    for f in sorted(x.path for x in found if x.path.endswith(".json")):
        with fs.open_input_stream(f) as s:
            out += [posixpath.join(path, t, name) for t, name, _ in json.loads(s.read())["files"] if t == topic]
    return out


def read_committed(spark: SparkSession, path: str, topic: str, schema) -> DataFrame:
    """The rows of a topic that published batches hold."""
    files = committed_files(path, topic)
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
