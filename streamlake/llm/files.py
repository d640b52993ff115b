"""Binary files in the shared folder: written by tasks, read by any executor.

Spark has no sink for binary records, so tasks write them through pyarrow's file
systems (local, HDFS, S3, GCS URIs). A file gets its final name only when it is whole.
A repeated task writes the same bytes to the same name, and readers follow a manifest
table that Spark commits, so a lost executor leaves nothing half-written in sight.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from streamlake.session import scratch_dir

READ_BUFFER = 1 << 20


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, as ``--py-files`` would;
    the Python tasks import it there."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    archive = os.path.join(tempfile.mkdtemp(prefix="package-"), f"{package.name}.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for path in sorted(package.rglob("*.py")):
            z.write(path, path.relative_to(package.parent))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)


def locate(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


class WholeFile:
    """An output file that appears under its name when it is closed."""

    def __init__(self, uri: str):
        self._fs, self._path = locate(uri)
        self._temporary = f"{self._path}.{uuid.uuid4().hex}.tmp"
        self._fs.create_dir(self._path.rsplit("/", 1)[0], recursive=True)
        self._out = self._fs.open_output_stream(self._temporary, compression=None)
        self.size = 0

    def write(self, data: bytes) -> None:
        self._out.write(data)
        self.size += len(data)

    def close(self) -> None:
        self._out.close()
        self._fs.move(self._temporary, self._path)


def open_input(uri: str):
    """A buffered input stream."""
    file_system, path = locate(uri)
    return file_system.open_input_stream(path, compression=None, buffer_size=READ_BUFFER)


def open_random(uri: str):
    file_system, path = locate(uri)
    return file_system.open_input_file(path)


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared scratch folder: lineage ends there, and an executor
    that is lost later costs a re-read and not a second computation."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
