"""The last lines of text files, read from the end."""

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata import constants as const
from lakestrata.sources.files import list_files, named_files
from lakestrata.sources.storage import locate

#: Bytes taken at first; each further step takes twice as many.
BLOCK = 1 << 16
_BREAK = re.compile(rb"\r\n|\n|\r")
TAIL_SCHEMA = "source string, block bigint, position bigint, line string"


def last_lines(stream, size: int, count: int, block: int = BLOCK) -> list[str]:
    """The last ``count`` lines of a file that allows random access, the last one last.

    Lines end as Spark's text scan has them: at a line feed, a carriage return or both. Bytes that are not UTF-8 are
    replaced. No more is read than twice what these lines need, and a first block.
    """
    at, pieces = size, []
    while True:
        step = min(block, at)
        at -= step
        pieces.append(stream.read_at(step, at))
        data = b"".join(reversed(pieces))
        pieces, lines = [data], _BREAK.split(data)
        if lines[-1] == b"":  # the file ends with the end of a line
            lines.pop()
        # the first line may have begun earlier
        if at == 0 or len(lines) > count:
            return [line.decode("utf-8", "replace") for line in lines[max(0, len(lines) - count):]] if count else []
        block *= 2


def log_tails(spark: SparkSession, path: str | list[str], count: int = const.LOG_SCAN_LINES) -> DataFrame:
    """The last lines of every text file of a folder, or of some files: ``source, block, position, line``.

    A task opens a file at its end, so a log may be of any length. Columns are those of ``scan_logs``; a file that has
    no line has no row.
    """
    files = list_files(spark, path) if isinstance(path, str) else named_files(spark, path)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, source in batch[["path", "file_name"]].itertuples(index=False):
                system, inner = locate(name)
                with system.open_input_file(inner) as stream:
                    lines = last_lines(stream, stream.size(), count)
                yield pd.DataFrame({"source": [source] * len(lines), "block": 0, "position": range(len(lines)), "line": lines}).astype(
                    {"block": "int64", "position": "int64", "source": "object", "line": "object"})

    return files.select("path", "file_name").repartition(F.col("path")).mapInPandas(read, TAIL_SCHEMA)
