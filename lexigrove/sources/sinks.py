"""Writing bundles and reports."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_report(df: DataFrame, folder: str) -> None:
    """A report as JSON lines, its columns in alphabetical order."""
    df.select(*sorted(df.columns)).write.mode("overwrite").json(folder)


def write_files(texts: DataFrame, folder: str) -> DataFrame:
    """Write (path, text) rows as files below a folder that all executors reach, and return (path, n_chars).

    A file is written aside and moved into place, so a retried task leaves a whole file.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                target = f"{root}/{path}"
                system.create_dir(target.rpartition("/")[0], recursive=True)
                with system.open_output_stream(f"{target}.part", compression=None) as out:
                    out.write((text or "").encode())
                system.move(f"{target}.part", target)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(t or "") for t in batch.column(1).to_pylist()], pa.int64())], names=["path", "n_chars"])

    return texts.select("path", "text").mapInArrow(write, "path string, n_chars long")


def passage_markdown(passages: DataFrame, group: str) -> DataFrame:
    """(path, text): one markdown file per group, its passages in order under numbered headings."""
    block = lambda title, col: F.when(F.col(col) != "", F.concat(F.lit(f"### {title}\n\n"), F.col(col), F.lit("\n\n"))).otherwise("")
    one = F.concat(F.lit("## Passage "), F.lpad(F.col("passage").cast("string"), 3, "0"), F.lit("\n\n"), block("Citation", "citation"), block("Commentary", "commentary"), block("Reference Notes", "reference"))
    ordered = F.array_sort(F.collect_list(F.struct("passage", one.alias("t"))))
    return passages.groupBy(group).agg(F.array_join(F.transform(ordered, lambda x: x["t"]), "").alias("text")).select(F.concat(F.lit("rag/"), F.col(group).cast("string"), F.lit(".md")).alias("path"), "text")
