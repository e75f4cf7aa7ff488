"""Single files by the names Spark uses: their metadata on the driver, their content in tasks."""

import os
import re
import stat
from collections.abc import Iterator, Sequence
from typing import NamedTuple

from pyspark.sql import SparkSession


class FileInfo(NamedTuple):
    """A file or folder; ``modified`` is in epoch milliseconds."""

    path: str
    length: int
    modified: int
    is_file: bool


def _opened(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _info(status) -> FileInfo:
    name = re.sub("^file:/+", "file:/", status.getPath().toString())
    return FileInfo(name, status.getLen(), status.getModificationTime(), status.isFile())


def _local_info(path: str) -> FileInfo | None:
    """Metadata of one local file, as Hadoop tells it; asking Hadoop takes a call to the JVM for each value."""
    try:
        found = os.stat(path)
    except (FileNotFoundError, NotADirectoryError):
        return None
    return FileInfo(f"file:{path}", found.st_size, found.st_mtime_ns // 1_000_000, not stat.S_ISDIR(found.st_mode))


def list_folder(spark: SparkSession, folder: str) -> Iterator[FileInfo]:
    """What lies directly in a folder, metadata only; nothing for a folder that does not exist."""
    place, system = _opened(spark, folder)
    if not system.exists(place):
        return
    if system.getUri().getScheme() == "file" and system.getFileStatus(place).isDirectory():
        inner = system.makeQualified(place).toUri().getPath().rstrip("/")
        with os.scandir(inner or "/") as entries:
            for entry in entries:
                info = _local_info(f"{inner}/{entry.name}")
                if info is not None:
                    yield info
        return
    found = system.listStatusIterator(place)
    while found.hasNext():
        yield _info(found.next())


def file_info(spark: SparkSession, path: str) -> FileInfo | None:
    """Metadata of one file, None if it is not there."""
    place, system = _opened(spark, path)
    return _info(system.getFileStatus(place)) if system.exists(place) else None


def file_infos(spark: SparkSession, paths: Sequence[str]) -> Iterator[FileInfo]:
    """Metadata of many files; those that are not there are left out."""
    for path in paths:
        local = re.match("^file:/+(.*)$", path, re.DOTALL)
        info = _local_info("/" + local.group(1)) if local else file_info(spark, path)
        if info is not None:
            yield info


def delete_folder(spark: SparkSession, folder: str) -> None:
    place, system = _opened(spark, folder)
    system.delete(place, True)


def locate(path: str):
    """(filesystem, path inside it) of a local or remote file name."""
    from pyarrow import fs

    local = re.match(r"^(?:file:)?/+(.*)$", path)
    if local:
        return fs.LocalFileSystem(), "/" + local.group(1)
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", path))


def open_input(path: str):
    filesystem, inner = locate(path)
    return filesystem.open_input_stream(inner)


def read_range(path: str, at: int, length: int) -> bytes:
    """Up to ``length`` bytes of a file from a place on; fewer where it ends."""
    system, inner = locate(path)
    with system.open_input_file(inner) as stream:
        return stream.read_at(length, at)


def open_output(path: str):
    filesystem, inner = locate(path)
    filesystem.create_dir(inner.rsplit("/", 1)[0], recursive=True)
    return filesystem.open_output_stream(inner)
