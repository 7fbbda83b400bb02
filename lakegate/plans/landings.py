"""Landings written from the dirty views, so the readers run on real files.

Every writer is a Spark job over the whole view; files land below the shared
scratch folder (``spark.checkpoint.dir``), one folder per landed file name
(``landing_name=<name>``) so partition discovery gives each line its file.
"""

from __future__ import annotations

import io
import os
import uuid
import zipfile
from collections.abc import Iterator, Sequence
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegate.session import ensure_dir, lean_on_disk, local_path

LANDING = "landing_name"


def write_csv(df: DataFrame, root: str, names: Sequence[str], delimiter: str = ";",
              mode: str = "errorifexists") -> str:
    """CSV files with a header line per file, one folder per landed name."""
    (df.select(F.col("_file_name").alias(LANDING), *names)
       .write.mode(mode).partitionBy(LANDING).option("header", "true").option("sep", delimiter).csv(root))
    return root


def write_text_with_header(df: DataFrame, root: str, names: Sequence[str], line: F.Column,
                           delimiter: str = ";") -> str:
    """One text file per landed name: the header line, then the lines in order."""
    body = df.select(F.col("_file_name").alias(LANDING), F.col("_line_order").cast("long").alias("_o"),
                     line.alias("value"))
    head = (df.select(F.col("_file_name").alias(LANDING)).distinct()
            .select(LANDING, F.lit(-1).cast("long").alias("_o"), F.lit(delimiter.join(names)).alias("value")))
    (body.unionByName(head).repartition(LANDING).sortWithinPartitions(LANDING, "_o")
     .drop("_o").write.partitionBy(LANDING).text(root))
    return root


def write_json(df: DataFrame, root: str, names: Sequence[str]) -> str:
    df.select(F.col("_file_name").alias(LANDING), *names).write.partitionBy(LANDING).json(root)
    return root


def write_parquet(df: DataFrame, root: str, names: Sequence[str]) -> str:
    df.select(F.col("_file_name").alias(LANDING), *names).write.partitionBy(LANDING).parquet(root)
    return root


def _zip_writer(root: str, header: str):
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        path = os.path.join(local_path(root), f"part-{uuid.uuid4().hex[:12]}.zip")
        entries, lines, current, fh = 0, 0, None, None
        zf = None
        for pdf in batches:
            if zf is None:
                zf = zipfile.ZipFile(path, "w", compression=zipfile.ZIP_DEFLATED)
                zf.writestr("__MACOSX/._skipped.csv", "ignored\n")
                zf.writestr(".DS_Store", "ignored\n")
            for name, text in zip(pdf[LANDING], pdf["value"]):
                if name != current:
                    if fh is not None:
                        fh.close()
                    fh = io.TextIOWrapper(zf.open(name, "w"), encoding="utf-8", newline="")
                    if not name.endswith(".json"):
                        fh.write(header + "\n")
                    current, entries = name, entries + 1
                fh.write(text + "\n")
                lines += 1
        if fh is not None:
            fh.close()
        if zf is not None:
            zf.close()
            yield pd.DataFrame([{"archive": path, "entries": entries, "lines": lines}])
    return write


def write_zips(df: DataFrame, root: str, names: Sequence[str], archives: int = 4, delimiter: str = ";",
               line: F.Column | None = None) -> DataFrame:
    """Zip archives written by tasks (each task streams its sorted lines into one
    archive, one entry per landed name).  The scratch folder must be a mounted
    path the Python workers can open (local disk in tests, a FUSE mount on a
    cluster).  ``line`` replaces the delimited cells; JSON entries get no header line.  Returns the per-archive summary (already computed)."""
    ensure_dir(root)
    if line is None:
        line = F.concat_ws(delimiter, *[F.coalesce(F.col(n), F.lit("")) for n in names])
    body = (df.select(F.col("_file_name").alias(LANDING), F.col("_line_order").cast("long").alias("_o"),
                      line.alias("value"))
            .repartition(archives, LANDING).sortWithinPartitions(LANDING, "_o"))
    summary = body.mapInPandas(_zip_writer(root, delimiter.join(names)), "archive string, entries int, lines long")
    rows = summary.collect()  # one small row per archive written; forces the write
    return df.sparkSession.createDataFrame(rows, "archive string, entries int, lines long")


def write_named_csv(df: DataFrame, root: str, names: Sequence[str], delimiter: str = ";",
                    file_col: str = "_file_name", order_col: str = "_line_order") -> int:
    """Landed files named as the source sends them (``<table>_<yyyymmdd>.csv``), one
    per distinct ``file_col``, header line first, lines in ``order_col`` order.
    Spark's CSV writer makes one file per name below a folder of its own, which is
    then given its landed name by the file system, so any shared store will do.
    Returns the number of files written."""
    spark = df.sparkSession
    parts = f"{root.rstrip('/')}-parts-{uuid.uuid4().hex[:12]}"
    with lean_on_disk(spark):  # the shuffle is as large as half the landing
        (df.select(F.col(file_col).alias(LANDING), F.col(order_col).alias("_o"), *[F.col(n).cast("string") for n in names])
         .repartition(LANDING).sortWithinPartitions(LANDING, "_o").drop("_o")
         .write.partitionBy(LANDING).option("header", "true").option("sep", delimiter).option("emptyValue", "")
         .csv(parts))
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(parts).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(path(root))
    written = 0
    for part in fs.globStatus(path(f"{parts}/{LANDING}=*/part-*")):
        name = unquote(part.getPath().getParent().getName().split("=", 1)[1])
        fs.rename(part.getPath(), path(root, name))
        written += 1
    fs.delete(path(parts), True)
    return written
