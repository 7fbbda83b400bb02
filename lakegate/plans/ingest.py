"""End-to-end ingestion run over a landing folder (the reference's orchestrator, E1/E2).

    run = Ingestion(spark, table_sheet, column_sheet, warehouse, params)
    result = run.run(landing_root, run_id="20251016T1011")

Steps (every one a Spark job over DataFrames; the driver only loops over the
configured tables and holds configuration and per-file metadata):

1. listing of the landing (``binaryFile`` without content) -> manifest;
   zip archives expanded by tasks (SRC-1/2/3);
2. file gates on the manifest: config resolution (FIL-18), name date (FIL-2/3),
   fixed part (FIL-6), duplicate / order against tracking (FIL-7/9/10);
3. per configured table: read the accepted files as text under the table's
   header mode (SRC-4..9), validate in one projection (QUA-1..8), write the
   validated lines to staging once (H4 - the file gates, the line numbers in file
   order (H3) and the routing read staging, not the CSV again);
4. per-file gates (QUA-9..12, FIL-15/16) -> `_last` / `_all` / invalid lines;
5. ingestion mode on the current `_last` version (MOD-1..6), `_all` appended as
   this run's folder, invalid lines and tracking appended (SNK-*);
6. reports: execution report, quality log, run status, completeness (RPT-*).

Re-running a run id rewrites only that run's folders, versions and buckets: it keeps the
time of its first registration, only runs registered before it are history to it, and
`_last` starts again from what it was before. Where a later run has written `_last` since,
a repeated run replaces nothing of the later one: a snapshot stays the later run's, and
keys that the later run has replaced stay as they are.
A table that fails with an exception gets ERROR outcomes; the other tables go on.
"""

from __future__ import annotations

import datetime as dt
import time
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakegate.constants import (CODE_COLUMN_COUNT, CODE_FAIL_FAST, FAIL_FAST_STOP, FORMAT_BY_EXTENSION, HEADER_USE, MODE_FULL_KEY_REPLACE,
                                MODE_FULL_SNAPSHOT, MODE_HISTORIZED, MODE_UPSERT)
from lakegate.functions.dates import file_date
from lakegate.functions.filenames import as_literal_path, base_name, table_from_filename
from lakegate.operators import files as fl
from lakegate.operators import invalid_lines as il
from lakegate.operators import modes as md
from lakegate.operators import projections as pj
from lakegate.operators import tracking as tk
from lakegate.operators.gates import (FILE_REASON, ROWS_TO_ALL, ROWS_TO_LAST, TO_ALL, TO_LAST, GateParams,
                                      apply_file_gate, bad_records, file_decisions, file_stats, stop_at_fail_fast)
from lakegate.operators.quality import duplicate_keys, file_line_numbers, quality_issues
from lakegate.operators.rules import explode_errors, validate
from lakegate.plans import buckets as bk
from lakegate.plans import reports as rp
from lakegate.plans import tables as tb
from lakegate.plans.specs import (ColumnRule, TableRule, load_column_rules, load_table_rules, merge_keys,
                                  normalise_table_sheet, resolve_table_config, start_validity_column)
from lakegate.session import lean_on_disk
from lakegate.sources import archives as ar
from lakegate.sources import delimited as dl
from lakegate.sources import landing as lg

FILES_PER_BATCH = 1000
"""Files of a micro-batch: the bound of what a stream's driver holds."""


@dataclass(frozen=True)
class RunParams:
    """Environment parameters (dev defaults; see ``for_env``)."""
    fail_fast_enabled: bool = False
    fail_fast_threshold: float = 10
    invalid_lines_generated: bool = True
    duplicate_check_enabled: bool = True
    file_order_check_enabled: bool = True
    non_zip_support_enabled: bool = True
    require_date: bool = False
    allow_substring_config: bool = False
    ict_default: float = 10
    rlt_default: float = 10
    partitioning_default: str = "yyyy/mm/dd"
    tracking_cleanup_days: int = 90
    invalid_lines_cleanup_days: int = 30
    strict_tolerance: bool = False
    all_keeps_ict_rejects: bool = True
    input_header_mode: str = ""          # used when a table's sheet row leaves it empty
    concurrent_jobs: int = 4             # tables, and sinks of a table, submitted at the same time
    kept_versions: int = 3               # of each `_last` table (before-images of one kept in buckets)
    last_buckets: int = 64               # of a new keyed `_last` table: about one per gigabyte

    @staticmethod
    def for_env(env: str) -> "RunParams":
        if env.lower() in ("prd", "prod", "production"):
            return RunParams(fail_fast_enabled=True, fail_fast_threshold=5, tracking_cleanup_days=365,
                             invalid_lines_cleanup_days=90)
        return RunParams(fail_fast_enabled=True, fail_fast_threshold=10)


@dataclass
class RunResult:
    outcomes: DataFrame            # one row per received file
    execution_report: DataFrame
    quality_log: DataFrame
    run_status: DataFrame
    completeness: DataFrame
    quarantine: DataFrame
    mode_stats: DataFrame | None = None          # MOD-9: mode, rows, tables written, per table
    tables: dict = field(default_factory=dict)   # table -> {"last": path, "all": path, ...}


class Ingestion:
    def __init__(self, spark: SparkSession, table_sheet: DataFrame, column_sheet: DataFrame,
                 warehouse: str, params: RunParams | None = None):
        self.spark = spark
        self.params = params or RunParams()
        p = self.params
        self.table_conf = normalise_table_sheet(table_sheet, p.ict_default, p.rlt_default, p.partitioning_default)
        self.tables: dict[str, TableRule] = load_table_rules(table_sheet, ict_default=p.ict_default,
                                                             rlt_default=p.rlt_default,
                                                             partitioning_default=p.partitioning_default)
        self.columns: dict[str, list[ColumnRule]] = {t: load_column_rules(column_sheet, t) for t in self.tables}
        self.warehouse = warehouse.rstrip("/")
        self._missing: dict[str, DataFrame] = {}  # QUA-17 reports of HEADER_USE reads

    # ------------------------------------------------------------- paths
    def path(self, *parts: str) -> str:
        return "/".join([self.warehouse, *parts])

    def tracking(self, but_run: str | None = None) -> DataFrame:
        """All registrations so far (append-only run folders of the tracking table); with
        ``but_run`` only those of runs that were registered before it."""
        cur = self._registrations()
        registered = None if but_run is None else self.registered_at(but_run)
        if but_run is not None:
            cur = cur.filter(F.col("run") != but_run)
        if registered is not None:
            cur = cur.filter(~_after(registered, but_run))
        return cur.select(*tk.TRACKING_SCHEMA.fieldNames())

    def _registrations(self) -> DataFrame:
        cur = tb.read_runs(self.spark, self.path("tracking"), tk.TRACKING_SCHEMA)
        run = F.col("run").cast("string") if "run" in cur.columns else F.lit(None).cast("string")
        return cur.withColumn("run", run)

    def registered_at(self, run_id: str) -> dt.datetime | None:
        """When the run was registered first, None for a new run."""
        return self._registrations().filter(F.col("run") == run_id).agg(F.min("processed_date").alias("at")).first()["at"]

    def _is_latest(self, table: str, run_id: str) -> bool:
        """No run registered after this one has ingested a file of the table."""
        registered = self.registered_at(run_id)
        return registered is None or self._registrations().filter(
            (F.col("table_name") == table) & (F.col("status") == "SUCCESS") & (F.col("run") != run_id)
            & _after(registered, run_id)).isEmpty()

    # ------------------------------------------------------------- gates
    def file_gates(self, manifest: DataFrame, run_id: str | None = None) -> DataFrame:
        """FIL-18, FIL-2/3, FIL-6, FIL-7/9/10 over the manifest -> gate columns.

        ``table_name`` becomes the configured table the file resolves to; files
        without a configuration keep the name-derived table and fail NO_CONFIG.
        """
        p = self.params
        # Files that go to their archive's table needn't have that table's kind of name.
        free = manifest.filter("table_hint is not null").select("path", F.lit(True).alias("_free")) \
            if "table_hint" in manifest.columns else None
        m = resolve_table_config(manifest.select("path", "filename", "table_name", "file_date", "file_format"),
                                 self.table_conf, allow_substring=p.allow_substring_config)
        m = m.select("path", "filename", F.coalesce("cfg_table_name", "table_name").alias("table_name"),
                     "file_date", "file_format", F.col("cfg_table_name").alias("config_table"))
        m = fl.date_gate(m, require_date=p.require_date)
        m = fl.fix_part_gate(m, self.table_conf)
        if free is not None:
            m = m.join(free, "path", "left").withColumn("fix_part_error_code", F.when(F.col("_free").isNull(), F.col(
                "fix_part_error_code"))).withColumn("fix_part_reason", F.when(F.col("_free").isNull(), F.col("fix_part_reason")))
        h = fl.history_checks(m, self.tracking(but_run=run_id))
        dup = F.col("is_duplicate") & F.lit(p.duplicate_check_enabled)
        late = F.col("is_late") & F.lit(p.file_order_check_enabled)
        first_history = F.try_element_at(F.filter("errors", lambda e: (
            (e["code"] == "000000002") & F.lit(p.duplicate_check_enabled)) | (
            (e["code"] == "000000003") & F.lit(p.file_order_check_enabled))), F.lit(1))
        code = (F.when(F.col("config_table").isNull(), F.lit("NO_CONFIG"))
                .when(F.col("date_error_code").isNotNull(), F.col("date_error_code"))
                .when(F.col("fix_part_error_code").isNotNull(), F.col("fix_part_error_code"))
                .when(dup | late, first_history["code"]))
        reason = (F.when(F.col("config_table").isNull(), F.lit("no configuration for this file's table"))
                  .when(F.col("date_reason").isNotNull(), F.col("date_reason"))
                  .when(F.col("fix_part_reason").isNotNull(), F.col("fix_part_reason"))
                  .when(dup | late, first_history["message"]))
        return h.select("path", "filename", "table_name", "file_date", "file_format",
                        code.alias("gate_code"), reason.alias("gate_reason"))

    # ------------------------------------------------------------- read
    def _stage(self, df: DataFrame, path: str) -> DataFrame:
        """SNK-1: a frame of this run, written once; everything after reads this Parquet copy."""
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    def read_table(self, trule: TableRule, landing_root: str | list[str], formats: set[str], accepted: DataFrame,
                   zip_lines: DataFrame | None, stage: str) -> DataFrame:
        """Text lines of the table's accepted files (``path, file_format, from_archive``).

        The same way at every size: each format that occurs is read below the landing root by a
        file-name pattern that covers every name the table's files can have, and a semi join on
        the path keeps the accepted ones; no list of paths goes through the driver.
        """
        names = [r.name for r in self.columns[trule.table_name] if not (r.enrich or "")]
        header_use = (trule.header_mode or self.params.input_header_mode.upper()) == HEADER_USE
        multiline = trule.input_format.endswith("_ml")
        frames = []
        for fmt in sorted(formats):
            mine = accepted.filter((F.col("file_format") == fmt) & ~F.col("from_archive")).select("path")

            def kept(df: DataFrame) -> DataFrame:
                return df.join(mine.withColumnRenamed("path", "_file_path"), "_file_path", "left_semi")
            glob = _name_glob("" if self.params.allow_substring_config else trule.table_name, fmt)
            if fmt == "json":
                frames.append(kept(dl.read_json(self.spark, landing_root, names, glob=glob)))
            elif fmt == "parquet":
                frames.append(kept(dl.read_parquet_as_text(self.spark, landing_root, names, glob=glob, accepted=mine)))
            elif header_use:
                # The headers (a row per file) are stored; lines are mapped as they are read, without a copy.
                first = self._stage(dl.first_lines(self.spark, landing_root, mine, glob), f"{stage}/first_lines")
                width = max(len(names), dl.first_width(first, trule.delimiter))

                def positional(skip_header: bool) -> tuple[DataFrame, list[str]]:
                    return dl.read_positional(self.spark, landing_root, width, delimiter=trule.delimiter, charset=trule.charset,
                                              multiline=multiline, glob=glob, skip_header=skip_header)
                raw, pos = positional(skip_header=True)
                by_line = not multiline and (trule.charset or "UTF-8").upper().replace("-", "") == "UTF8"
                hdr = dl.parsed_headers(first, pos, trule.delimiter) if by_line else \
                    dl.header_lines(kept(positional(skip_header=False)[0]), pos, trule.delimiter)
                hdr = self._stage(hdr, f"{stage}/headers")
                frames.append(dl.remap_by_header(raw, names, pos, trule.delimiter, headers=hdr))
                self._missing[trule.table_name] = dl.missing_by_header(raw, names, pos, trule.delimiter, headers=hdr)
            else:
                # csv / csv_quote / csv_quote_ml (quoted fields over several lines)
                r = kept(dl.read_delimited(self.spark, landing_root, names, delimiter=trule.delimiter,
                                           charset=trule.charset, multiline=multiline, glob=glob))
                frames.append(pj.drop_header_lines(r, names))  # PRJ-4: header lines repeated inside a file
        if zip_lines is not None:
            frames.append(self._archive_rows(trule, names, header_use, zip_lines, accepted))
        out = frames[0]
        for f in frames[1:]:
            out = out.unionByName(f, allowMissingColumns=True)
        return out if dl.CORRUPT in out.columns else out.withColumn(dl.CORRUPT, F.lit(None).cast("string"))  # Parquet alone

    def _archive_rows(self, trule: TableRule, names: list[str], header_use: bool, zip_lines: DataFrame,
                      accepted: DataFrame) -> DataFrame:
        """Lines of the table's accepted archive entries, by the rules of directly landed files of their format."""
        mine = accepted.filter("from_archive").select(F.col("path").alias("_file_path"), F.col("file_format").alias("_format"))
        raw = F.encode("line", "ISO-8859-1")  # the bytes, to be read in the sheet's charset
        utf8 = trule.charset.upper().replace("-", "") == "UTF8"
        text = F.make_valid_utf8(raw.cast("string")) if utf8 else F.decode(raw, trule.charset)
        z = (zip_lines.filter("status = 'OK'").join(mine, "_file_path")
             .select("_file_path", F.col("entry_name").alias("_file_name"), "_format", "line_no", "row_no", "record_no",
                     F.when(F.col("_format") == "json", F.make_valid_utf8(raw.cast("string"))).otherwise(text).alias("line")))
        files = ["_file_path", "_file_name"]
        numbered = [*files, F.lit(0).cast("long").alias("_block")]
        rows = z.filter("row_no is not null").select(*numbered, "_format", F.col("row_no").alias("_rid"), "line")
        from_json = ar.parse_json_lines(rows.filter("_format = 'json'").drop("_format"), names, dl.CORRUPT).drop("line")
        if trule.input_format.endswith("_ml"):
            z = ar.records(z.filter("_format <> 'json'"), files).select(*numbered, F.col("record_no").alias("_rid"), "line")
        else:
            z = rows.filter("_format <> 'json'").drop("_format")
        if not header_use:
            z = ar.parse_lines(z.filter("_rid > 1"), names, trule.delimiter, corrupt=dl.CORRUPT).drop("line")
            return pj.drop_header_lines(z, names).unionByName(from_json)
        width = z.filter("_rid = 1").agg(F.coalesce(F.max(dl.field_count("line", trule.delimiter)), F.lit(0)).alias("n")).first()["n"]
        pos = dl.positional_names(max(len(names), width))
        raw = ar.parse_lines(z, pos, trule.delimiter, corrupt=dl.CORRUPT).drop("line")
        missing = dl.missing_by_header(raw, names, pos, trule.delimiter)
        before = self._missing.get(trule.table_name)
        self._missing[trule.table_name] = missing if before is None else before.unionByName(missing)
        return dl.remap_by_header(raw, names, pos, trule.delimiter).unionByName(from_json)

    # ------------------------------------------------------------- run
    def _archives(self, landing_root: str | list[str], run_id: str) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Archives expanded once and stored: their lines, entries (``path, filename, archive``) and
        what can't be read (``path, filename, error``)."""
        lines = ar.expand_archives(self.spark, landing_root, skip_header=False, encoding="iso-8859-1",
                                   stage=self.path("_archive_pieces", f"run={run_id}"))
        lines = lines.withColumn("_file_path", F.concat_ws("!/", "archive", "entry"))
        lines = self._stage(lines, self.path("_archive_lines", f"run={run_id}"))
        broken = lines.filter("status = 'ERROR'").select(
            F.col("_file_path").alias("path"), F.coalesce("entry_name", base_name("archive")).alias("filename"), "error")
        entries = (lines.filter("status = 'ENTRY'").select(F.col("_file_path").alias("path"),
                                                           F.col("entry_name").alias("filename"), "archive")
                   .join(broken.select("path"), "path", "left_anti"))
        # An entry whose name leads to no configured table belongs to its archive's table.
        known = self.table_conf.select(F.col("table_name").alias("_known")).distinct()
        entries = (entries.withColumn("_own", table_from_filename("filename")).join(known, F.col("_own") == F.col("_known"), "left")
                   .withColumn("table_hint", F.when(F.col("_known").isNull(), table_from_filename(base_name("archive")))))
        return lines, entries.select("path", "filename", "table_hint"), broken

    def run(self, landing_root: str | list[str], run_id: str, run_at: str | None = None,
            table: str | None = None) -> RunResult:
        """One run over a landing folder, or over the landed files of a list (as a stream's micro-batch gives
        them); with ``table`` only over what belongs to that table."""
        with lean_on_disk(self.spark):
            return self._run(landing_root, run_id, run_at, table)

    def _run(self, landing_root: str | list[str], run_id: str, run_at: str | None, table: str | None) -> RunResult:
        spark, p = self.spark, self.params
        processed = _clock(run_at, self.registered_at(run_id))
        manifest = self._stage(lg.landing_manifest(spark, landing_root), self.path("_manifest", f"run={run_id}"))  # listed once
        zips, direct = lg.split_zip_and_direct(manifest)
        no_hint = F.lit(None).cast("string").alias("table_hint")
        files = direct.select("path", "filename", no_hint, F.lit(False).alias("from_archive"))
        if not p.non_zip_support_enabled:
            files = files.limit(0)
        zip_lines = broken = None
        if not zips.isEmpty():
            zip_lines, entries, broken = self._archives(landing_root, run_id)
            files = files.unionByName(entries.withColumn("from_archive", F.lit(True)))
        described = fl.describe_files(files).withColumn("table_name", F.coalesce("table_hint", "table_name"))
        kinds = described.select("path", "from_archive")
        # A Parquet entry would have to be unpacked as a file of its own; it is refused by name, not read as text.
        packed = F.col("from_archive") & (F.col("file_format") == "parquet") & F.col("gate_code").isNull()
        gated = (self.file_gates(described, run_id).join(kinds, "path")
                 .withColumn("gate_reason", F.when(packed, F.lit("Parquet inside an archive is not read")).otherwise(F.col("gate_reason")))
                 .withColumn("gate_code", F.when(packed, F.lit("INVALID_ARCHIVE")).otherwise(F.col("gate_code"))))
        gated = gated if table is None else gated.filter(F.col("table_name") == table)
        gated = self._stage(gated, self.path("_gates", f"run={run_id}"))
        accepted = gated.filter(F.col("gate_code").isNull()).select("table_name", "path", "filename", "file_date",
                                                                    "file_format", "from_archive")
        # What occurs: bounded by the configured tables and the formats, not by the files.
        occurring: dict[str, set] = {}
        for r in accepted.groupBy("table_name", "file_format", "from_archive").count().collect():
            occurring.setdefault(r["table_name"], set()).add(None if r["from_archive"] else r["file_format"])

        outcomes: list[DataFrame] = [_outcomes(gated.filter(F.col("gate_code").isNotNull()), "FAILED",
                                               F.col("gate_code"), F.col("gate_reason"))]
        received = gated.select("path", "table_name")
        if broken is not None:
            bad = fl.describe_files(broken)
            bad = bad if table is None else bad.filter(F.col("table_name") == table)
            outcomes.append(_outcomes(bad, "FAILED", F.lit("INVALID_ARCHIVE"), F.col("error")))
            received = received.unionByName(bad.select("path", "table_name"))
        reports, qlogs, mstats, table_paths = [], [], [], {}
        work = [(tname, lambda t=trule, o=occurring[tname]: self._run_table(
                    t, landing_root, o, accepted.filter(F.col("table_name") == t.table_name), zip_lines, run_id, processed))
                for tname, trule in self.tables.items() if tname in occurring]
        # Tables are independent: their jobs are submitted from parallel threads, and one that fails stops no other.
        for (tname, _), res in zip(work, _concurrently([_guarded(w) for _, w in work], p.concurrent_jobs)):
            if isinstance(res, Exception):
                reason = str(res).strip().split("\n")[0][:500] or type(res).__name__
                outcomes.append(_outcomes(accepted.filter(F.col("table_name") == tname), "ERROR",
                                          F.lit("TECHNICAL_ERROR"), F.lit(reason)))
                continue
            outcomes.append(res["outcomes"])
            reports.append(res["report"])
            qlogs.append(res["quality"])
            mstats.append(res["mode_stats"])
            table_paths[tname] = res["paths"]
        out = reduce(lambda a, b: a.unionByName(b), outcomes)
        out = out.withColumn("rows_rejected", F.when(F.col("status") == "SUCCESS", F.col("rejected_lines"))
                             .otherwise(F.coalesce(F.col("total_lines"), F.lit(0))).cast("long"))
        # The outcomes as they were decided, stored before tracking: reading them later must not decide again.
        out = self._stage(out, self.path("outcomes", f"run={run_id}"))
        new_tracking = tk.registrations(out.withColumn("row_count", F.col("rows_ingested")), processed)
        tb.write_run(new_tracking, self.path("tracking"), run_id)
        received = self._stage(received, self.path("received", f"run={run_id}"))

        def union(xs: list[DataFrame]) -> DataFrame:
            return reduce(lambda a, b: a.unionByName(b), xs)
        frames = {"execution_report": union(reports) if reports else None,
                  "quality_log": union(qlogs) if qlogs else None,
                  "run_status": rp.run_status(out),
                  "completeness": rp.completeness(received, out, "path"),
                  "quarantine": fl.quarantine(out.filter(F.col("status") == "FAILED"), processed),
                  "mode_stats": union(mstats) if mstats else None}
        # Reports are kept with the run, each written once; what is read later is what was written.
        made = [n for n, f in frames.items() if f is not None]
        kept = dict(zip(made, _concurrently([lambda n=n: self._stage(frames[n], self.path("reports", n, f"run={run_id}"))
                                             for n in made], p.concurrent_jobs)))
        empty_rep = spark.createDataFrame([], "table_name string")
        return RunResult(outcomes=out, tables=table_paths, **{"execution_report": empty_rep, "quality_log": empty_rep} | kept)

    def report(self, name: str) -> DataFrame | None:
        """A report (``execution_report``, ``quality_log``, ``run_status``, ``completeness``, ``quarantine`` or
        ``mode_stats``) of all runs so far, batch and stream, with the run's id in ``run``."""
        return tb.read_runs(self.spark, self.path("reports", name))

    def _run_table(self, trule: TableRule, landing_root: str | list[str], occurring: set, accepted: DataFrame,
                   zip_lines: DataFrame | None, run_id: str, processed: F.Column) -> dict:
        stage = self.path(f"{trule.table_name}_staging", f"run={run_id}")
        raw = self.read_table(trule, landing_root, occurring - {None}, accepted,
                              zip_lines if None in occurring else None, stage)
        return self.process_table(trule, raw, run_id, processed, expected=accepted)

    def process_table(self, trule: TableRule, raw: DataFrame, run_id: str, processed: F.Column,
                      expected: DataFrame | None = None) -> dict:
        """Steps 3-6 for one table over ``raw`` text lines (with ``_file_path``,
        ``_file_name``, ``_block``, ``_rid``): the same code serves a batch run and a
        streaming micro-batch."""
        spark, p = self.spark, self.params
        started = time.perf_counter()
        rules = self.columns[trule.table_name]
        work = f"_per_file/{trule.table_name}"  # frames of a row per file or split, stored so that joins know their size
        # H4: lines are read, validated and written once; gates, line numbers and routing read them back.
        staging = self.path(f"{trule.table_name}_validated", f"run={run_id}")
        v = self._stage(validate(raw, rules, ict=trule.ict, strict=p.strict_tolerance, raw_data_sep=trule.delimiter), staging)
        gp = GateParams(rlt=trule.rlt, strict=p.strict_tolerance, fail_fast_enabled=p.fail_fast_enabled,
                        fail_fast_threshold=p.fail_fast_threshold, all_keeps_ict_rejects=p.all_keeps_ict_rejects)
        # A file is its path: equal names in two folders are two files.
        stats = file_stats(v, rules, "_file_path")
        dec = file_decisions(stats, rules, gp, "_file_path").join(bad_records(v, dl.CORRUPT), "_file_path", "left") \
            .withColumn("path", F.col("_file_path"))
        bad_cols = F.coalesce(F.col("corrupt_lines"), F.lit(0)) > 0
        dec = dec.withColumn("file_reason", F.when(bad_cols, F.lit(CODE_COLUMN_COUNT)).otherwise(F.col("file_reason"))) \
                 .withColumn("file_status", F.when(bad_cols, F.lit("REJECTED")).otherwise(F.col("file_status"))) \
                 .withColumn(ROWS_TO_LAST, F.when(bad_cols, F.lit(0)).otherwise(F.col(ROWS_TO_LAST)).cast("long")) \
                 .withColumn(ROWS_TO_ALL, F.when(bad_cols, F.lit(0)).otherwise(F.col(ROWS_TO_ALL)).cast("long"))
        if p.fail_fast_enabled:  # judged on the counts, before any sink of the table is written
            dec = stop_at_fail_fast(dec, [file_date(F.col("_file_name")), F.col("_file_name"), F.col("_file_path")])
        dec = self._stage(dec.withColumn("_extracted", file_date(F.col("_file_name"))),
                          self.path(work, f"run={run_id}", "decisions"))
        numbered = file_line_numbers(v, store=lambda o: self._stage(o, self.path(work, f"run={run_id}", "offsets")))
        routed = apply_file_gate(numbered, dec, gp, "_file_path", ["_extracted"])
        # A file that failed fast leaves its errors; the files behind it leave nothing.
        begun = routed.filter(F.coalesce(F.col(FILE_REASON) != FAIL_FAST_STOP, F.lit(True)))
        reported = begun.filter(F.coalesce(F.col(FILE_REASON) != CODE_FAIL_FAST, F.lit(True)))
        business = [r.name for r in rules]
        tech = lambda df: pj.with_technical_columns(
            df, business, line_col="line_number", file_col="_file_name",
            extraction_date=F.col("_extracted"), process_date=processed)
        batch_last = tech(routed.filter(F.col(TO_LAST)))
        batch_all = pj.with_partitions(tech(routed.filter(F.col(TO_ALL))), trule.partitioning)
        batch_all = pj.with_comments(batch_all, {r.name: r.comment for r in rules if r.comment})
        last_root = self.path(trule.last_table)
        all_root = self.path(trule.all_table, f"run={run_id}")
        mode = trule.ingestion_mode.strip().upper()
        appended = mode == MODE_HISTORIZED  # `_last` only grows: this run's folder, nothing is rewritten
        keyed = mode in (MODE_UPSERT, MODE_FULL_KEY_REPLACE)  # only the buckets of the batch's keys are rewritten
        keys, start = merge_keys(rules), start_validity_column(rules)
        # A rejected file never reaches the mode: without an accepted one `_last` stays as it is. An accepted
        # file whose lines were all rejected is an empty snapshot; a file without lines is SKIPPED and is none.
        taken = dec.filter(F.col("file_status") == "ACCEPTED").select(
            F.col("_extracted").alias("FILE_EXTRACTION_DATE"), F.col("_file_name").alias("FILE_NAME_RECEIVED"))
        any_taken = not taken.isEmpty()
        latest = self._is_latest(trule.table_name, run_id)
        # QUA-15: keys that accepted lines repeat, found once; the modes look at no others within the batch.
        repeated = None if not keys else self._stage(
            duplicate_keys(batch_last, keys, trule.table_name), self.path(f"{trule.table_name}_repeated_keys", f"run={run_id}"))
        if mode == MODE_FULL_SNAPSHOT:
            batch_last = md.newest_file(batch_last, files=taken)
        elif mode == MODE_FULL_KEY_REPLACE:
            several = self.path(f"{trule.table_name}_keys_of_several_files", f"run={run_id}")
            batch_last = md.newest_file_per_key(batch_last, keys, repeated=repeated, store=lambda s: self._stage(s, several))
        cur = None if appended or keyed or mode == MODE_FULL_SNAPSHOT else tb.read_before(spark, last_root, run_id)
        res = md.apply_mode(trule.ingestion_mode, cur, None, batch_last, keys, start)
        if mode == MODE_FULL_KEY_REPLACE:  # joined, and read for its buckets, by the merge and for the statistics: made once
            batch_last = self._stage(batch_last, self.path(f"{trule.table_name}_batch", f"run={run_id}"))

        def merge_bucket(current: DataFrame | None, batch: DataFrame) -> DataFrame:
            if current is not None and mode == MODE_FULL_KEY_REPLACE and not latest:
                newer = current.filter(F.col("FILE_PROCESS_DATE") > processed).select(*keys).distinct()
                batch = batch.join(newer, keys, "left_anti")
            return md.apply_mode(mode, current, None, batch, [*keys, bk.BUCKET], start, repeated=repeated.select(*keys)).last

        def merge_last() -> None:
            bk.merge(last_root, self.path(f"{trule.last_table}_before"), run_id, batch_last, keys,
                     ["FILE_NAME_RECEIVED", "FILE_LINE_ID"], merge_bucket, p.last_buckets, latest, p.kept_versions)
        parts = [c for c in ("yyyy", "mm", "dd", "hhmmss") if c in batch_all.columns]
        paths_out = {"last": last_root, "all": self.path(trule.all_table), "staging": staging}
        # The three sinks are independent jobs over staging: submit them together.
        writes = [lambda: batch_all.write.mode("overwrite").partitionBy(*parts).parquet(all_root)]
        if appended:
            writes.append(lambda: tb.write_run(batch_last, last_root, run_id))
        elif keyed and (any_taken or bk.has_image(spark, self.path(f"{trule.last_table}_before"), run_id)):
            writes.append(merge_last)
        elif mode == MODE_FULL_SNAPSHOT and any_taken and latest:
            writes.append(lambda: tb.write_run_version(res.last, last_root, run_id, p.kept_versions))
        # SNK-3: error log, one row per recorded error (appended as this run's folder)
        errors = explode_errors(begun, ["_file_name", "line_number"]).select(
            F.lit(trule.table_name).alias("table_name"), F.col("_file_name").alias("filename"), "line_number",
            "error_pos", "column", "code", "action", "message", "raw_value")
        missing = self._missing.pop(trule.table_name, None)
        if missing is not None:  # QUA-17: configured column absent from a file's header
            errors = errors.unionByName(missing.select(
                F.lit(trule.table_name).alias("table_name"), "filename",
                F.lit(None).cast("long").alias("line_number"), F.lit(None).cast("int").alias("error_pos"),
                F.col("column_name").alias("column"), F.lit("INFO_MISSING_COLUMN").alias("code"),
                F.lit("INFO").alias("action"),
                F.concat(F.lit("missing column "), F.col("column_name"), F.lit(" added as NULL")).alias("message"),
                F.lit(None).cast("string").alias("raw_value")))
        errors_root = self.path(f"{trule.table_name}_errors", f"run={run_id}")
        writes.append(lambda: errors.write.mode("overwrite").parquet(errors_root))
        paths_out["errors"] = self.path(f"{trule.table_name}_errors")
        # SRC-8: lines the parser could not map (bad records), kept verbatim
        bad = begun.filter(F.col(dl.CORRUPT).isNotNull()).select(
            F.col("_file_name").alias("filename"), "line_number", F.col(dl.CORRUPT).alias("raw_line"))
        bad_root = self.path(f"{trule.table_name}_bad_records", f"run={run_id}")
        writes.append(lambda: bad.write.mode("overwrite").parquet(bad_root))
        paths_out["bad_records"] = self.path(f"{trule.table_name}_bad_records")
        if p.invalid_lines_generated:
            line_id = F.xxhash64(F.lit(run_id), "_file_path", "line_number")
            inv = il.invalid_lines(reported.withColumn("_line_id", line_id), business, id_col="_line_id", line_col="line_number",
                                   raw_col="_raw_data", rejection_date=processed)
            inv_root = self.path(f"{trule.table_name}_invalid_lines", f"run={run_id}")
            writes.append(lambda: inv.write.mode("overwrite").parquet(inv_root))
            paths_out["invalid_lines"] = self.path(f"{trule.table_name}_invalid_lines")
        # QUA-15/16: keys that the accepted lines repeat, files whose columns are all empty
        issues = quality_issues(reported.filter(F.col(TO_LAST)), reported, keys, business, trule.table_name, repeated)
        issues_root = self.path(f"{trule.table_name}_quality_issues", f"run={run_id}")
        writes.append(lambda: issues.write.mode("overwrite").parquet(issues_root))
        paths_out["quality_issues"] = self.path(f"{trule.table_name}_quality_issues")
        _concurrently(writes, p.concurrent_jobs)
        o = dec.select(
            F.lit(trule.table_name).alias("table_name"), "path", F.col("_file_name").alias("filename"),
            F.col("_extracted").alias("file_date"),
            F.col("total_lines").cast("long"), F.col("rejected_lines").cast("long"),
            F.col(ROWS_TO_ALL).alias("rows_ingested"),
            F.when((F.col("total_lines") == 0) | (F.col("file_status") == "NOT_STARTED"), F.lit("SKIPPED"))
             .when(F.col("file_status") == "ACCEPTED", F.lit("SUCCESS")).otherwise(F.lit("FAILED")).alias("status"),
            F.col("file_reason").alias("error_code"), F.col("file_reason").alias("reason"))
        outcomes = o
        if expected is not None:  # FIL-16: accepted files that produced no line at all are skipped.
            none = expected.join(dec.select("path"), "path", "left_anti")
            outcomes = o.unionByName(_outcomes(none, "SKIPPED", F.lit(None).cast("string"), F.lit("empty file"), lines=0))
        outcomes = self._stage(outcomes, self.path(work, f"run={run_id}", "outcomes"))
        stats = md.mode_stats(res, batch_last).select(F.lit(trule.table_name).alias("table_name"), "*")
        report = rp.execution_report(dec, trule.table_name).withColumn(
            "duration_sec", F.lit(round(time.perf_counter() - started, 3)))
        return {"outcomes": outcomes, "report": report, "mode_stats": stats,
                "quality": rp.quality_log(dec, trule.table_name), "paths": paths_out}

    # ------------------------------------------------------------- retention
    def retained_tracking(self, as_of: str) -> DataFrame:
        """FIL-13: tracking rows inside the retention window (``tracking_cleanup_days``)."""
        t = F.lit(as_of).cast("timestamp_ntz")
        return tk.retain(self.tracking(), t, self.params.tracking_cleanup_days)

    def retained_invalid_lines(self, table: str, as_of: str) -> DataFrame | None:
        """QUA-21: invalid lines inside the retention window (``invalid_lines_cleanup_days``)."""
        inv = tb.read_runs(self.spark, self.path(f"{table}_invalid_lines"))
        if inv is None:
            return None
        t = F.lit(as_of).cast("timestamp_ntz")
        return tk.retain(inv, t, self.params.invalid_lines_cleanup_days, date_col="rejection_date")

    def purge(self, as_of: str) -> dict[str, tuple[int, int]]:
        """FIL-13 / QUA-21 in storage: rows outside the retention windows are removed from the tracking table and
        the invalid lines; per table the number of run folders dropped and rewritten."""
        p, day = self.params, dt.datetime.fromisoformat(as_of).date()
        windows = {"tracking": ("processed_date", p.tracking_cleanup_days)} | {
            f"{t}_invalid_lines": ("rejection_date", p.invalid_lines_cleanup_days) for t in self.tables}
        return {name: tb.expire_runs(self.spark, self.path(name), column, str(day - dt.timedelta(days=days)))
                for name, (column, days) in windows.items()}

    # ------------------------------------------------------------- stream
    def run_stream(self, landing_root: str, table: str | None, checkpoint: str, run_prefix: str,
                   max_files_per_trigger: int = FILES_PER_BATCH, run_at: str | None = None):
        """STR-1: the batch run over the files that land, each file taken once (``availableNow``).

        The stream is the landing's listing: the source remembers which files it has given, their content is
        read by the batch run of a micro-batch, so every format, archive and header mode gives what a batch run
        gives, with all gates and reports, as run ``<run_prefix>-<batch id>``.  A replayed micro-batch is that
        run repeated.  Files come in the order of their modification times, at most ``max_files_per_trigger`` at
        once; the run is given their paths, so it reads no file of another micro-batch.  With ``table`` only that
        table's files and entries are taken: archives of any name are opened for them.  A table that fails gets
        ERROR outcomes, as in a batch run, and the stream goes on.  The rows counted are the lines of files that
        passed the file gates.
        """
        from lakegate.streaming import staging as stg
        stream = stg.file_stream(self.spark, landing_root, max_files_per_trigger)
        lines: dict[int, int] = {}

        def each(batch: DataFrame, batch_id: int) -> None:
            paths = [r["path"] for r in batch.select("path").collect()]  # bounded by max_files_per_trigger
            if paths:
                done = self.run([as_literal_path(x) for x in paths], f"{run_prefix}-{batch_id}", run_at, table)
                lines[batch_id] = done.outcomes.agg(F.coalesce(F.sum("total_lines"), F.lit(0)).alias("n")).first()["n"]

        q = (stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
        q.awaitTermination()
        rows = sum(lines.values())
        return stg.RunStats(rows, len(lines), "SUCCESS" if rows else "NO_DATA")


def _concurrently(tasks: list, max_workers: int) -> list:
    """Run callables that each submit Spark jobs from their own thread; results in order."""
    if len(tasks) <= 1:
        return [t() for t in tasks]
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=min(max_workers, len(tasks))) as ex:
        return list(ex.map(lambda f: f(), tasks))


def _guarded(task):
    """The task's result, or the exception it ended with."""
    def run():
        try:
            return task()
        except Exception as exc:  # noqa: BLE001  becomes the table's ERROR outcome
            return exc
    return run


def _clock(run_at: str | None, registered: dt.datetime | None = None) -> F.Column:
    """One time for everything that a run writes; a repeated run keeps its first one."""
    at = str(registered) if registered else run_at or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(at).cast("timestamp_ntz")


def _after(registered: dt.datetime, run_id: str) -> F.Column:
    """Tracking rows of runs registered after ``run_id`` (the run id decides between equal times)."""
    at = F.lit(str(registered)).cast("timestamp_ntz")
    return (F.col("processed_date") > at) | ((F.col("processed_date") == at) & (F.col("run") > run_id))


def _outcomes(files: DataFrame, status: str, code: F.Column, reason: F.Column, lines: int | None = None) -> DataFrame:
    """Outcome rows of files that no line was ingested from."""
    return files.select(
        "table_name", "path", "filename", "file_date", F.lit(lines).cast("long").alias("total_lines"),
        F.lit(lines).cast("long").alias("rejected_lines"), F.lit(0).cast("long").alias("rows_ingested"),
        F.lit(status).alias("status"), code.alias("error_code"), reason.alias("reason"))


def _name_glob(table: str, fmt: str) -> str:
    """File-name pattern, in any case, that covers all files of a format whose name holds the table's."""
    def any_case(text: str) -> str:
        return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c if c.isalnum() or c in "_-" else "?" for c in text)
    ends = ",".join(any_case(e) for e, f in FORMAT_BY_EXTENSION.items() if f == fmt)
    return f"*{any_case(table)}*.{{{ends}}}" if table else f"*.{{{ends}}}"
