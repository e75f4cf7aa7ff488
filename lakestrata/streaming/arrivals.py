"""What lies in a folder, as a stream: a data source whose offset changes whenever a file comes, goes or changes.

Spark's own file stream passes over files without content, hidden names and files that bear an old time. Here
the offset is a fingerprint of all (path, size, time), so any change makes a micro-batch; its rows are the files the
folder then holds. Which of them are new is for the reader's own records to say.
"""

import hashlib
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from lakestrata.sources.storage import locate

ARRIVALS = "folder_content"
SCHEMA = "path string, length bigint, modified bigint"


def folder_content(path: str) -> list[tuple[str, int, int]]:
    """(path, size, time in ms) of the regular files directly in a folder, in order; none for a folder that is not there."""
    from pyarrow import fs

    system, inner = locate(path)
    prefix = "file:" if isinstance(system, fs.LocalFileSystem) else path[:path.index(inner)] if inner in path else ""
    found = system.get_file_info(fs.FileSelector(inner, allow_not_found=True))
    return sorted((prefix + info.path, info.size, (info.mtime_ns or 0) // 1_000_000) for info in found
                  if info.type == fs.FileType.File and not info.base_name.startswith(".") and info.base_name != "_SUCCESS")


class Whole(InputPartition):
    """The folder is listed by one task: a listing is a few bytes a file."""


class FolderReader(DataSourceStreamReader):
    def __init__(self, path: str):
        self.path = path

    def initialOffset(self) -> dict:
        return {"files": 0, "fingerprint": ""}

    def latestOffset(self) -> dict:
        found = folder_content(self.path)
        if not found:
            return self.initialOffset()
        return {"files": len(found), "fingerprint": hashlib.sha256(repr(found).encode()).hexdigest()}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [Whole(0)] if start != end else []

    def read(self, partition: InputPartition) -> Iterator[tuple[str, int, int]]:
        yield from folder_content(self.path)


class FolderContent(DataSource):
    @classmethod
    def name(cls) -> str:
        return ARRIVALS

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return FolderReader(self.options["path"])


def folder_stream(spark: SparkSession, path: str):
    """The content of a folder as a stream of ``path, length, modified``."""
    spark.dataSource.register(FolderContent)
    return spark.readStream.format(ARRIVALS).option("path", path).load()
