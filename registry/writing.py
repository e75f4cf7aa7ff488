"""Writers of input files for the queries."""

import time
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakestrata.sources.storage import open_output


#: Seconds spent on writing input files, which a benchmark leaves out.
spent = 0.0


def write_named_files(lines: DataFrame, folder: str) -> int:
    """Write (file_name, seq, line) as text files of those names; returns their number.

    Lines are gathered by file and sorted, then streamed out, so a task holds one batch at a time. A
    null line creates the file and adds nothing to it. A repeated task writes the same files again. Files whose
    names begin with ``latin`` are written in Latin-1.
    """
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, stream, written = None, None, 0
        for batch in batches:
            for key, part in batch.groupby("file_name", sort=False):
                if key != name:
                    if stream is not None:
                        stream.close()
                    name, stream, written = key, open_output(f"{folder}/{key}"), written + 1
                text = "".join(line + "\n" for line in part["line"] if line is not None)
                stream.write(text.encode("latin-1" if name.startswith("latin") else "utf-8"))
        if stream is not None:
            stream.close()
        yield pd.DataFrame({"files": [written]})

    global spent
    start = time.perf_counter()
    gathered = lines.select("file_name", "seq", "line").repartition("file_name")
    done = gathered.sortWithinPartitions("file_name", "seq").mapInPandas(write, "files bigint")
    written = done.agg(F.sum("files").alias("n")).first()["n"]
    spent += time.perf_counter() - start
    return written


def json_array_lines(
    df: DataFrame, file_name: Column, columns: Sequence[str], order_by: Sequence[str]
) -> DataFrame:
    """Lines (file_name, seq, line) that make one JSON array of objects per file."""
    body = df.select(
        file_name.alias("file_name"), *order_by, F.to_json(F.struct(*columns)).alias("json"))
    place = F.row_number().over(Window.partitionBy("file_name").orderBy(*order_by))
    numbered = body.withColumn("seq", place.cast("bigint"))
    elements = numbered.select("file_name", "seq", F.concat(
        F.when(F.col("seq") == 1, "").otherwise(","), F.col("json")).alias("line"))
    names = numbered.groupBy("file_name").agg(F.max("seq").alias("last"))
    frame = names.select("file_name", F.inline(F.array(
        F.struct(F.lit(0).cast("bigint").alias("seq"), F.lit("[").alias("line")),
        F.struct((F.col("last") + 1).alias("seq"), F.lit("]").alias("line")))))
    return elements.unionByName(frame)
