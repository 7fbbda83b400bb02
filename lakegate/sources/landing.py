"""Landing listing (SRC-2/3/11): one row per landed file, content never read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakegate.functions.filenames import plain_path
from lakegate.operators.files import manifest_from_paths


def list_files(spark: SparkSession, root: str | Sequence[str], glob: str | None = None) -> DataFrame:
    """``binaryFile`` listing (recursive) projected to path/size/mtime: the content
    column is pruned, so files are listed by executors' file index, not read."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    files = r.load(root if isinstance(root, str) else list(root))
    return files.select(plain_path("_metadata.file_path").alias("path"), "length", "modificationTime")


def landing_manifest(spark: SparkSession, root: str | Sequence[str]) -> DataFrame:
    """SRC-2/SRC-3: listing -> manifest (table, date, format; hidden and unsupported dropped)."""
    files = list_files(spark, root)
    return manifest_from_paths(files).join(files.select("path", "length", "modificationTime"), "path", "left")


def split_zip_and_direct(manifest: DataFrame) -> tuple[DataFrame, DataFrame]:
    """SRC-2: archives to expand vs files read directly."""
    is_zip = F.col("file_format") == "zip"
    return manifest.filter(is_zip), manifest.filter(~is_zip)
