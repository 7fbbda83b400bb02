"""File-level gates over a manifest (FIL-1..10, FIL-14..18, SRC-2/3/11, JOI-3/4/5).

A manifest is a DataFrame with one row per landed file (``path``, ``filename``
and, once derived, ``table_name``).  Every gate is a projection or a join of the
manifest with the tracking table; nothing is listed or looped on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakegate.constants import (CODE_BAD_NAME_OR_DATE, CODE_DUPLICATE_FILE, CODE_FILE_ORDER)
from lakegate.functions.dates import file_date, filename_date_reason
from lakegate.functions.filenames import (base_name, file_format, fix_part_from_filename,
                                          fix_part_from_pattern, table_from_filename, ymd_from_name)

ERROR_STRUCT = "struct<type:string,code:string,message:string>"


def describe_files(files: DataFrame, name_col: str = "filename") -> DataFrame:
    """FIL-1, FIL-8, SCA-3/4, SRC-2: table, date, yyyy/mm/dd and format of each file name."""
    f = F.col(name_col)
    y, m, d = ymd_from_name(f)
    return files.select(
        "*",
        table_from_filename(f).alias("table_name"),
        file_date(f).alias("file_date"),
        y.alias("yyyy"), m.alias("mm"), d.alias("dd"),
        file_format(f).alias("file_format"),
    )


def manifest_from_paths(paths: DataFrame, path_col: str = "path") -> DataFrame:
    """SRC-2/SRC-3: listing rows (e.g. ``binaryFile`` without content) -> manifest.

    Hidden files/folders (a path element starting with '.' or '__MACOSX') and
    unsupported formats are dropped.
    """
    p = F.col(path_col)
    name = base_name(p)
    hidden = p.rlike(r"(^|/)(\.|__MACOSX)[^/]*(/|$)")
    return (paths.filter(~hidden)
            .select(p.alias("path"), name.alias("filename"))
            .transform(describe_files)
            .filter(F.col("file_format").isNotNull()))


def files_by_table(manifest: DataFrame) -> DataFrame:
    """SRC-3/SRC-11: per table the number of files and folders, and the first and last file name.

    The files themselves stay rows of the manifest; a table's are never gathered in one value.
    """
    folder = F.regexp_replace(F.col("path"), r"/[^/]*$", "")
    return manifest.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("file_count"),
        F.min("filename").alias("first_file"),
        F.max("filename").alias("last_file"),
        F.count_distinct(folder).cast("int").alias("folders"),
    )


def date_gate(files: DataFrame, name_col: str = "filename", require_date: bool = False) -> DataFrame:
    """FIL-2 (lenient: undated names pass) / FIL-3 (``require_date``)."""
    reason = filename_date_reason(F.col(name_col), require_date)
    return files.select(
        "*",
        reason.alias("date_reason"),
        F.when(reason.isNotNull(), F.lit(CODE_BAD_NAME_OR_DATE)).alias("date_error_code"),
    )


def fix_part_gate(files: DataFrame, table_conf: DataFrame, name_col: str = "filename") -> DataFrame:
    """FIL-4/5/6: case-sensitive fixed part of the name vs the configured pattern.

    ``table_conf``: normalised table spec (table_name, filename_pattern, fix_part).
    No config row, no pattern or an empty fixed part -> accept.  The spec has one
    row per configured table, so Spark broadcasts it by its size.
    """
    conf = table_conf.select(
        F.col("table_name").alias("_cfg_table"),
        F.coalesce(F.col("fix_part"), fix_part_from_pattern(F.col("filename_pattern"))).alias("fix_part_expected"),
    )
    j = files.join(conf, files["table_name"] == conf["_cfg_table"], "left").drop("_cfg_table")
    actual = fix_part_from_filename(F.col(name_col))
    expected = F.col("fix_part_expected")
    bad = expected.isNotNull() & (expected != "") & (actual != expected)
    return j.select(
        "*",
        actual.alias("fix_part_actual"),
        F.when(bad, F.format_string("fix part mismatch (case-sensitive): expected '%s', got '%s'",
                                    expected, actual)).alias("fix_part_reason"),
        F.when(bad, F.lit(CODE_BAD_NAME_OR_DATE)).alias("fix_part_error_code"),
    )


def last_success_dates(tracking: DataFrame) -> DataFrame:
    """AGG-4: per table the latest file date of a SUCCESS registration."""
    return (tracking.filter((F.col("status") == "SUCCESS") & F.col("file_date").isNotNull())
            .groupBy("table_name").agg(F.max("file_date").alias("last_date")))


def history_checks(files: DataFrame, tracking: DataFrame, name_col: str = "filename",
                   order_col: str = "path") -> DataFrame:
    """FIL-7 duplicate (JOI-3), FIL-9 order (JOI-5), FIL-10 combined (first code wins).

    Duplicate: the (table, file name) has a SUCCESS registration, or appears
    earlier in the same batch.  Order: the file date is before the latest SUCCESS
    date of its table (equal passes, undated passes).  Files of one table are
    processed in date order, so files of the same batch cannot make each other
    late.
    """
    done = (tracking.filter(F.col("status") == "SUCCESS")
            .select("table_name", F.col("filename").alias("_done_name")).distinct()
            .withColumn("_done", F.lit(True)))
    last = last_success_dates(tracking)
    w = Window.partitionBy("table_name", name_col).orderBy(order_col)
    j = (files.join(done, (files["table_name"] == done["table_name"]) & (files[name_col] == done["_done_name"]),
                    "left").drop(done["table_name"]).drop("_done_name")
         .join(last, "table_name", "left")
         .withColumn("_seen_before", F.row_number().over(w) > 1))
    dup = F.coalesce(F.col("_done"), F.lit(False)) | F.col("_seen_before")
    late = F.col("file_date").isNotNull() & F.col("last_date").isNotNull() & (F.col("file_date") < F.col("last_date"))
    dup_err = F.when(dup, F.struct(F.lit("DUPLICATE_FILE").alias("type"), F.lit(CODE_DUPLICATE_FILE).alias("code"),
                                   F.format_string("%s was ingested into %s before",
                                                   F.col(name_col), F.col("table_name")).alias("message")))
    late_err = F.when(late, F.struct(F.lit("INVALID_FILE_ORDER").alias("type"), F.lit(CODE_FILE_ORDER).alias("code"),
                                     F.format_string("dated %s, older than the newest ingested date %s of %s",
                                                     F.date_format("file_date", "yyyy-MM-dd HH:mm:ss"),
                                                     F.date_format("last_date", "yyyy-MM-dd HH:mm:ss"),
                                                     F.col("table_name")).alias("message")))
    errors = F.filter(F.array(dup_err, late_err), lambda e: e.isNotNull())
    return j.select(
        "*",
        dup.alias("is_duplicate"),
        late.alias("is_late"),
        errors.alias("errors"),
    ).drop("_done", "_seen_before") \
     .withColumn("error_code", F.try_element_at(F.col("errors"), F.lit(1))["code"]) \
     .withColumn("valid", F.size("errors") == 0)


def quarantine(rejected: DataFrame, as_of: F.Column) -> DataFrame:
    """FIL-14: rejected-file manifest (the reference moves files and writes .reason)."""
    return rejected.select(
        "filename", "table_name", "error_code", "reason",
        as_of.alias("rejected_at"),
        F.concat(F.lit("rejected/"), F.col("table_name"), F.lit("/"), F.col("filename")).alias("quarantine_path"),
    )


def empty_files(manifest: DataFrame, lines: DataFrame, name_col: str = "filename",
                line_file_col: str = "_file_name") -> DataFrame:
    """FIL-16: manifest files without any line (skipped, not failed)."""
    counts = lines.groupBy(F.col(line_file_col).alias("_lf")).agg(F.count(F.lit(1)).alias("line_count"))
    j = manifest.join(counts, manifest[name_col] == counts["_lf"], "left").drop("_lf")
    return j.select("*", F.coalesce("line_count", F.lit(0)).alias("lines")).drop("line_count") \
        .withColumn("is_empty", F.col("lines") == 0)
