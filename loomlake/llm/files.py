"""Whole binary files, written by tasks and read by Spark."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession


def write_file(uri: str, parts: Iterable[bytes]) -> int:
    """Writes ``parts`` to ``uri`` and returns the bytes written.

    The file appears whole or not at all: a task that runs again, or twice at once, replaces it by the same content.
    """
    store, path = pafs.FileSystem.from_uri(uri)
    store.create_dir(path.rpartition("/")[0], recursive=True)
    draft, n = f"{path}.{uuid.uuid4().hex}.draft", 0
    with store.open_output_stream(draft) as out:
        for part in parts:
            out.write(part)
            n += len(part)
    store.move(draft, path)
    return n


def read_files(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """(path, content) of the files below ``path`` whose names match the glob ``pattern``."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path", "content")
