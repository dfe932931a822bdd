"""SNK-4: the prediction log as a committing stream sink (a Python data source).

Two phases: each task writes its rows to a part of its own name, and when all of a batch have, the commit writes
one record per batch id that lists them, by a move that either happens or not. A batch that failed has parts
but no record; a batch that is replayed after its record was written drops its new parts. Readers go by the records, so every
row is in the log exactly once. Paths may be on any file system that pyarrow knows (the shared checkpoint folder is one).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, WriterCommitMessage
from pyspark.sql.types import StructType

NAME = "fareline_prediction_log"
PARTS, COMMITS = "parts", "_commits"
ROWS = 5_000                # rows that are written at once


@dataclass
class Part(WriterCommitMessage):
    name: str | None
    rows: int


def _file_system(path: str):
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


class PredictionLogWriter(DataSourceStreamWriter):
    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[Row]) -> Part:
        """On an executor: the rows of one task as JSON lines in a part of its own."""
        fs, base = _file_system(self.path)
        fs.create_dir(f"{base}/{PARTS}", recursive=True)
        name, n, out, lines = f"{uuid.uuid4().hex}.json", 0, None, []

        def put() -> None:
            out.write(("\n".join(lines) + "\n").encode("utf-8"))
            lines.clear()

        try:
            for row in iterator:
                out = out or fs.open_output_stream(f"{base}/{PARTS}/{name}")
                lines.append(json.dumps(row.asDict(), default=str))
                n += 1
                if len(lines) >= ROWS:
                    put()
            if lines:
                put()
        finally:
            if out is not None:
                out.close()
        return Part(name if n else None, n)

    def commit(self, messages: list[Part | None], batchId: int) -> None:
        """On the driver: the batch's record, unless it has one already."""
        from pyarrow.fs import FileType

        fs, base = _file_system(self.path)
        fs.create_dir(f"{base}/{COMMITS}", recursive=True)
        done, parts = f"{base}/{COMMITS}/{int(batchId):012d}.json", [m for m in messages if m is not None and m.name]
        if fs.get_file_info(done).type != FileType.NotFound:
            self._drop(fs, base, parts)
            return
        draft = f"{base}/{COMMITS}/_{uuid.uuid4().hex}"
        with fs.open_output_stream(draft) as out:
            out.write(json.dumps({"batch_id": int(batchId), "rows": sum(p.rows for p in parts), "parts": [p.name for p in parts]}).encode("utf-8"))
        fs.move(draft, done)

    def abort(self, messages: list[Part | None], batchId: int) -> None:
        fs, base = _file_system(self.path)
        self._drop(fs, base, [m for m in messages if m is not None and m.name])

    @staticmethod
    def _drop(fs, base: str, parts: list[Part]) -> None:
        for p in parts:
            fs.delete_file(f"{base}/{PARTS}/{p.name}")


class PredictionLogSource(DataSource):
    """``writeStream.format(NAME).option("path", folder)``."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def streamWriter(self, schema: StructType, overwrite: bool) -> PredictionLogWriter:
        return PredictionLogWriter(self.options["path"])


def write_prediction_log(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append everything available to the log at ``path``, each row once; waits until it is done."""
    stream.sparkSession.dataSource.register(PredictionLogSource)
    q = (stream.writeStream.format(NAME).option("path", path).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def read_prediction_log(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The committed rows of the log."""
    commits = spark.read.schema("batch_id long, rows long, parts array<string>").json(f"{path}/{COMMITS}")
    parts = [f"{path}/{PARTS}/{p}" for r in commits.orderBy("batch_id").collect() for p in r["parts"]]      # a name per written file
    if not parts:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(parts)
