"""Side effects per partition whose records count once, however often a task runs."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as fs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

NAME = "weft_partition_sink"

Action = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


@dataclass
class Written(WriterCommitMessage):
    """What a task that ended well has left: a file, or nothing."""

    file: str | None


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _writer(action: Action, path: str, run: str) -> DataSourceArrowWriter:
    class Writer(DataSourceArrowWriter):
        def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
            store, folder = _open(path)
            store.create_dir(f"{folder}/data", recursive=True)
            # Another attempt of the task writes another file; one of them is named in the end.
            name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.parquet"
            file, out = f"{folder}/data/{name}", None
            try:
                for batch in action(batches):
                    out = out or pq.ParquetWriter(file, batch.schema, filesystem=store)
                    out.write_batch(batch)
            except BaseException:
                if out:
                    out.close()
                    store.delete_file(file)
                raise
            if out is None:
                return Written(None)
            out.close()
            return Written(name)

        def commit(self, messages: list[Written | None]) -> None:
            store, folder = _open(path)
            files = [m.file for m in messages if m and m.file]
            manifest = f"{folder}/manifest/{run}.txt"
            if store.get_file_info(manifest).type != fs.FileType.NotFound:
                self.abort(messages)  # this run has counted before
                return
            store.create_dir(f"{folder}/manifest", recursive=True)
            # The name appears with the whole list behind it, or not at all.
            with store.open_output_stream(f"{folder}/manifest/_{run}") as out:
                out.write("".join(f"{name}\n" for name in files).encode())
            store.move(f"{folder}/manifest/_{run}", manifest)

        def abort(self, messages: list[Written | None]) -> None:
            store, folder = _open(path)
            for message in messages:
                if message and message.file:
                    store.delete_file(f"{folder}/data/{message.file}")

    return Writer()


def for_each_partition(df: DataFrame, path: str, action: Action | None = None, *, run: str | None = None) -> str:
    """Calls ``action`` once per partition with its Arrow batches; the batches it yields
    (by default, its input) are its records, kept below ``path``.

    A task that fails and runs again, or runs twice, leaves its records once: each attempt
    writes a file of its own, a task that ends well names its file, and only when all have
    ended are the names committed, in one manifest. A job that fails commits nothing and
    its files are deleted; those of a lost executor stay, unnamed. What the action does to
    the outside is its own affair; its records tell which attempt counted. Returns the
    name of the run; a run whose name is given and has been committed before is not
    committed again. ``path`` must be one that every executor reaches.
    """
    run = run or uuid.uuid4().hex
    keep = action or iter

    class Sink(DataSource):
        @classmethod
        def name(cls) -> str:
            return NAME

        def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
            return _writer(keep, path, run)

    df.sparkSession.dataSource.register(Sink)
    df.write.format(NAME).mode("append").save()
    return run


def committed(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Records of all committed runs; with no files, an empty frame of ``schema``."""
    names = [r[0] for r in spark.read.text(f"{path}/manifest").collect()]
    reader = spark.read.schema(schema) if schema is not None else spark.read
    files = [f"{path}/data/{name}" for name in names]
    if not files:
        return spark.createDataFrame([], schema if schema is not None else "none int")
    return reader.parquet(*files)
