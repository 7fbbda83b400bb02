"""Specification tables (SRC-10) and their normalised form (PRJ-9, SCA-8, MOD-7/8, FIL-18).

Two small configuration frames drive everything:

* ``table_spec``  - one row per target table (sheet "File-Table")
* ``column_spec`` - one row per column (sheet "Field-Column")

They keep the sheet's column headers so a user can load the same sheet exported
as CSV/JSON/Parquet.  Normalisation (null tokens, booleans, percents, upper-case
actions) is done with Spark expressions; the normalised rows are configuration,
bounded by the number of configured tables/columns, and are collected to build
the per-column expressions.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, fields
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakegate.constants import (ACTION_ICT, DEFAULT_DATE_PATTERNS, ERROR_ACTIONS, NULL_TOKENS,
                                SPECIAL_MERGE_KEY, SPECIAL_START_VALIDITY)
from lakegate.functions.config import parse_bool, parse_percent
from lakegate.functions.text import null_token
from lakegate.functions.types import is_date_type

# Sheet headers (text cells), in sheet order.
TABLE_SHEET_COLUMNS = (
    "Delta Table Name", "Filename Pattern", "Input Format", "Input delimiter",
    "Input charset", "Input header", "Ingestion mode", "Last Table Name",
    "delta_table_name_conf", "last_table_name_conf", "fix_part_filename",
    "Invalid column per line tolerance", "Rejected line per file tolerance", "Partitioning",
)
COLUMN_SHEET_COLUMNS = (
    "Delta Table Name", "Column Name", "Field type", "Transformation Type",
    "Transformation pattern", "Regex replacement", "Is Nullable", "Error action",
    "Default when invalid", "Is Special", "Rejected line per file tolerance",
    "Comment", "Enrich type",
)

MAX_SPEC_ROWS = 100_000  # configuration, not data: refuse anything larger


def _sheet_schema(cols: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField("position", T.LongType(), False)]
                        + [T.StructField(c, T.StringType(), True) for c in cols])


def sheet_frame(spark: SparkSession, rows: Iterable[dict], cols: Sequence[str]) -> DataFrame:
    """A spec sheet from dict rows (missing cells are NULL); position = row order."""
    data = [(i, *[None if r.get(c) is None else str(r.get(c)) for c in cols])
            for i, r in enumerate(rows)]
    return spark.createDataFrame(data, _sheet_schema(cols))


def table_sheet(spark: SparkSession, rows: Iterable[dict]) -> DataFrame:
    return sheet_frame(spark, rows, TABLE_SHEET_COLUMNS)


def column_sheet(spark: SparkSession, rows: Iterable[dict]) -> DataFrame:
    return sheet_frame(spark, rows, COLUMN_SHEET_COLUMNS)


def read_sheet(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """SRC-10: a sheet exported as CSV (header row) / JSON / Parquet; all text."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", "true").option("inferSchema", "false")
    df = reader.load(path)
    df = df.select([F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
    return df.withColumn("position", F.monotonically_increasing_id())


VERBATIM_CELLS = ("Input delimiter", "Regex replacement")  # white space counts: a tab, a blank


def _cell(df: DataFrame, name: str) -> Column:
    if name in VERBATIM_CELLS and name in df.columns:
        c = F.col(f"`{name}`").cast("string")
        token = F.lower(F.trim(c))
        return F.when(c.isNull() | (c == "") | ((token != "") & token.isin(*NULL_TOKENS)), F.lit(None)).otherwise(c)
    return null_token(F.col(f"`{name}`")) if name in df.columns else F.lit(None).cast("string")


def _clean_cells(sheet: DataFrame, cols: Sequence[str]) -> DataFrame:
    """First projection: every sheet cell through PRJ-9 once (short column names)."""
    return sheet.select(F.col("position").cast("long").alias("position"),
                        *[_cell(sheet, c).alias(f"c{i}") for i, c in enumerate(cols)])


# ----------------------------------------------------------------- tables
def normalise_table_sheet(sheet: DataFrame, ict_default: float = 10.0,
                          rlt_default: float = 10.0, partitioning_default: str = "yyyy/mm/dd") -> DataFrame:
    """PRJ-9/SCA-8/MOD-7 on the table sheet; one clean row per table."""
    c = {name: F.col(f"c{i}") for i, name in enumerate(TABLE_SHEET_COLUMNS)}
    clean = _clean_cells(sheet, TABLE_SHEET_COLUMNS)
    base = F.lower(c["Delta Table Name"])
    stem = F.coalesce(c["delta_table_name_conf"], base)
    last_conf = F.coalesce(c["last_table_name_conf"], c["Last Table Name"])
    return clean.select(
        "position",
        base.alias("table_name"),
        c["Filename Pattern"].alias("filename_pattern"),
        F.lower(F.coalesce(c["Input Format"], F.lit("csv"))).alias("input_format"),
        F.coalesce(c["Input delimiter"], F.lit(",")).alias("delimiter"),
        F.coalesce(c["Input charset"], F.lit("UTF-8")).alias("charset"),
        F.coalesce(F.upper(c["Input header"]), F.lit("")).alias("header_mode"),
        F.coalesce(F.upper(c["Ingestion mode"]), F.lit("")).alias("ingestion_mode"),
        F.concat(stem, F.lit("_all")).alias("all_table"),
        F.coalesce(last_conf, F.concat(stem, F.lit("_last"))).alias("last_table"),
        c["fix_part_filename"].alias("fix_part"),
        parse_percent(c["Invalid column per line tolerance"], ict_default, clean=True).alias("ict"),
        parse_percent(c["Rejected line per file tolerance"], rlt_default, clean=True).alias("rlt"),
        F.lower(F.coalesce(c["Partitioning"], F.lit(partitioning_default))).alias("partitioning"),
    )


@dataclass(frozen=True)
class TableRule:
    table_name: str
    filename_pattern: str | None = None
    input_format: str = "csv"
    delimiter: str = ","
    charset: str = "UTF-8"
    header_mode: str = ""
    ingestion_mode: str = ""
    all_table: str = ""
    last_table: str = ""
    fix_part: str | None = None
    ict: Decimal = Decimal(10)
    rlt: Decimal = Decimal(10)
    partitioning: str = "yyyy/mm/dd"
    position: int = 0


# ---------------------------------------------------------------- columns
def normalise_column_sheet(sheet: DataFrame) -> DataFrame:
    """PRJ-9/SCA-8/MOD-8 on the column sheet."""
    c = {name: F.col(f"c{i}") for i, name in enumerate(COLUMN_SHEET_COLUMNS)}
    clean = _clean_cells(sheet, COLUMN_SHEET_COLUMNS)
    action = F.upper(c["Error action"])
    return clean.select(
        "position",
        F.lower(c["Delta Table Name"]).alias("table_name"),
        c["Column Name"].alias("name"),
        F.upper(F.coalesce(c["Field type"], F.lit("STRING"))).alias("field_type"),
        F.lower(c["Transformation Type"]).alias("transformation"),
        c["Transformation pattern"].alias("pattern"),
        F.coalesce(c["Regex replacement"], F.lit("")).alias("replacement"),
        parse_bool(c["Is Nullable"], True, clean=True).alias("nullable"),
        F.when(action.isin(*ERROR_ACTIONS), action).otherwise(F.lit(ACTION_ICT)).alias("action"),
        c["Default when invalid"].alias("default"),
        F.lower(c["Is Special"]).alias("special"),
        parse_percent(c["Rejected line per file tolerance"], None, clean=True).alias("tolerance"),
        c["Comment"].alias("comment"),
        F.lower(c["Enrich type"]).alias("enrich"),
    )


@dataclass(frozen=True)
class ColumnRule:
    name: str
    field_type: str = "STRING"
    transformation: str | None = None
    pattern: str | None = None
    replacement: str = ""
    nullable: bool = True
    action: str = ACTION_ICT
    default: str | None = None
    special: str | None = None
    tolerance: Decimal | None = None
    comment: str | None = None
    enrich: str | None = None
    position: int = 0
    table_name: str | None = None

    @property
    def date_pattern(self) -> str:
        """QUA-2: the configured pattern, else the first default pattern."""
        return self.pattern or DEFAULT_DATE_PATTERNS[0]

    @property
    def is_date(self) -> bool:
        return is_date_type(self.field_type)


def _rows_to(cls, rows) -> list:
    names = {f.name for f in fields(cls)}
    out = []
    for r in rows:
        d = {k: v for k, v in r.asDict().items() if k in names and v is not None}
        out.append(cls(**d))
    return out


def _collect_config(df: DataFrame) -> list:
    rows = df.limit(MAX_SPEC_ROWS + 1).collect()
    if len(rows) > MAX_SPEC_ROWS:
        raise ValueError("specification frame is larger than a configuration can be")
    return rows


# Driver-side normalisation of the collected sheet rows.  Same rules as the
# expression versions above (``normalise_*_sheet``, used where a spec frame is
# joined); tests assert both give the same result.
def _py_cell(v) -> str | None:
    if v is None:
        return None
    t = str(v).strip()
    return None if t.lower() in NULL_TOKENS else t


def _py_verbatim(v) -> str | None:
    """A cell whose white space counts (a delimiter, a replacement): only an empty or null one is unset."""
    token = "" if v is None else str(v).strip().lower()
    return None if v is None or v == "" or (token and token in NULL_TOKENS) else str(v)


def _py_bool(v, default: bool) -> bool:
    t = (_py_cell(v) or "").lower()
    if t in ("true", "t", "yes", "y", "1", "oui", "o"):
        return True
    if t in ("false", "f", "no", "n", "0", "non"):
        return False
    return default


def _py_percent(v, default) -> Decimal | None:
    t = _py_cell(v)
    dflt = None if default is None else Decimal(str(default)).quantize(Decimal("0.0001"))
    if t is None:
        return dflt
    try:
        num = Decimal(t.replace("%", "").replace(",", ".")).quantize(Decimal("0.0001"))
    except ArithmeticError:
        return dflt
    out = num if (t.endswith("%") or num > 1) else num * 100
    return out.quantize(Decimal("0.0001"))


def _raw_rows(sheet: DataFrame) -> list[dict]:
    return sorted((r.asDict() for r in _collect_config(sheet)), key=lambda r: r.get("position") or 0)


def table_rule_from_cells(r: dict, ict_default=10.0, rlt_default=10.0,
                          partitioning_default: str = "yyyy/mm/dd") -> TableRule:
    g = lambda k: _py_cell(r.get(k))
    base = (g("Delta Table Name") or "").lower()
    stem = g("delta_table_name_conf") or base
    return TableRule(
        table_name=base, filename_pattern=g("Filename Pattern"),
        input_format=(g("Input Format") or "csv").lower(), delimiter=_py_verbatim(r.get("Input delimiter")) or ",",
        charset=g("Input charset") or "UTF-8", header_mode=(g("Input header") or "").upper(),
        ingestion_mode=(g("Ingestion mode") or "").upper(), all_table=f"{stem}_all",
        last_table=g("last_table_name_conf") or g("Last Table Name") or f"{stem}_last",
        fix_part=g("fix_part_filename"),
        ict=_py_percent(r.get("Invalid column per line tolerance"), ict_default),
        rlt=_py_percent(r.get("Rejected line per file tolerance"), rlt_default),
        partitioning=(g("Partitioning") or partitioning_default).lower(), position=int(r.get("position") or 0))


def column_rule_from_cells(r: dict) -> ColumnRule:
    g = lambda k: _py_cell(r.get(k))
    action = (g("Error action") or "").upper()
    return ColumnRule(
        name=g("Column Name") or "", field_type=(g("Field type") or "STRING").upper(),
        transformation=(g("Transformation Type") or "").lower() or None, pattern=g("Transformation pattern"),
        replacement=_py_verbatim(r.get("Regex replacement")) or "", nullable=_py_bool(r.get("Is Nullable"), True),
        action=action if action in ERROR_ACTIONS else ACTION_ICT, default=g("Default when invalid"),
        special=(g("Is Special") or "").lower() or None,
        tolerance=_py_percent(r.get("Rejected line per file tolerance"), None),
        comment=g("Comment"), enrich=(g("Enrich type") or "").lower() or None,
        position=int(r.get("position") or 0), table_name=(g("Delta Table Name") or "").lower() or None)


def load_table_rules(table_sheet_df: DataFrame, ict_default: float = 10.0, rlt_default: float = 10.0,
                     partitioning_default: str = "yyyy/mm/dd") -> dict[str, TableRule]:
    out: dict[str, TableRule] = {}
    for r in _raw_rows(table_sheet_df):
        rule = table_rule_from_cells(r, ict_default, rlt_default, partitioning_default)
        out.setdefault(rule.table_name, rule)
    return out


def load_column_rules(column_sheet_df: DataFrame, table: str | None = None,
                      check_patterns: bool = True) -> list[ColumnRule]:
    rules = [column_rule_from_cells(r) for r in _raw_rows(column_sheet_df)]
    if table is not None:
        rules = [r for r in rules if r.table_name == table.lower()]
    if check_patterns and rules:
        validate_patterns(column_sheet_df.sparkSession, rules)
    return rules


def validate_patterns(spark: SparkSession, rules: Sequence[ColumnRule]) -> None:
    """D20 for a whole spec: every date and regex pattern checked in one small job."""
    probes = [F.try_to_timestamp(F.lit("x"), F.lit(r.date_pattern)) for r in rules if r.is_date]
    # Patterns are Spark's (Java) regular expressions, so Spark judges them.
    probes += [F.rlike(F.lit("x"), F.lit(r.pattern)) for r in rules if (r.transformation or "") == "regex" and r.pattern]
    if probes:
        spark.range(1).select(*probes).collect()  # raises on a bad date or regex pattern


def merge_keys(rules: Sequence[ColumnRule]) -> list[str]:
    """MOD-8: columns flagged IsMergeKey (case-insensitive), in sheet order."""
    return [r.name for r in rules if (r.special or "") == SPECIAL_MERGE_KEY]


def start_validity_column(rules: Sequence[ColumnRule]) -> str | None:
    """MOD-8: the first IsStartValidity column, if any."""
    for r in rules:
        if (r.special or "") == SPECIAL_START_VALIDITY:
            return r.name
    return None


def special_columns(column_sheet_df: DataFrame) -> DataFrame:
    """MOD-8 as a frame: per table, merge keys (sheet order) and the compare column."""
    n = normalise_column_sheet(column_sheet_df)
    w = Window.partitionBy("table_name")
    return (n.groupBy("table_name").agg(
        F.transform(
            F.array_sort(F.collect_list(F.when(F.col("special") == SPECIAL_MERGE_KEY,
                                               F.struct("position", "name")))),
            lambda s: s["name"]).alias("merge_keys"),
        F.min_by(F.when(F.col("special") == SPECIAL_START_VALIDITY, F.col("name")),
                 F.when(F.col("special") == SPECIAL_START_VALIDITY, F.col("position"))).alias("start_validity"),
    ))


# ------------------------------------------------------- config resolution
def resolve_table_config(files: DataFrame, table_conf: DataFrame, table_col: str = "table_name",
                         allow_substring: bool = False) -> DataFrame:
    """FIL-18 (D2): attach the config row of each file's table.

    Exact name first; with ``allow_substring`` a name contained either way is the
    fallback, first in sheet order.
    """
    conf = table_conf.select([F.col(c).alias(f"cfg_{c}") for c in table_conf.columns])
    key_cols = list(files.columns)
    first = Window.partitionBy(*key_cols).orderBy("cfg_position")

    def first_of(matches: DataFrame) -> DataFrame:
        return matches.withColumn("_rn", F.row_number().over(first)).filter("_rn = 1").drop("_rn")
    t = F.col(table_col)
    exact = first_of(files.join(conf, t == F.col("cfg_table_name"), "left"))
    if not allow_substring:
        return exact
    # Only names that no row matches exactly go on; containment is equality with a substring, so it stays an equi-join.
    rest = exact.filter(F.col("cfg_table_name").isNull()).select(*key_cols)
    names = rest.select(t.alias("_name")).distinct()
    lengths = [r[0] for r in conf.select(F.length("cfg_table_name")).distinct().collect() if r[0]]  # of the sheet's names
    within = names.select("_name", F.explode(_substrings(F.col("_name"), lengths)).alias("_part"))
    around = conf.select("*", F.explode(_substrings(F.col("cfg_table_name"), range(max(lengths, default=0) + 1))).alias("_part"))
    near = within.join(conf, F.col("_part") == F.col("cfg_table_name")).select("_name", *conf.columns).unionByName(
        names.join(around, F.col("_part") == F.col("_name")).select("_name", *conf.columns))
    best = near.groupBy("_name").agg(F.min_by(F.struct(*conf.columns), "cfg_position").alias("_cfg"))
    found = rest.join(best, t == F.col("_name"), "left").select(*key_cols, *[F.col("_cfg")[c].alias(c) for c in conf.columns])
    return exact.filter(F.col("cfg_table_name").isNotNull()).unionByName(found)


def _substrings(text: Column, lengths: Iterable[int]) -> Column:
    """All substrings of ``text`` that have one of the ``lengths``, each once."""
    def of(size: int) -> Column:
        starts = F.sequence(F.lit(1), F.length(text) - size + 1)
        return F.when(F.length(text) >= size, F.transform(starts, lambda i: F.substring(text, i, F.lit(size)))).otherwise(
            F.array().cast("array<string>"))
    parts = [of(n) for n in lengths if n > 0] + ([F.array(F.lit(""))] if 0 in lengths else [])
    return F.array_distinct(F.concat(*parts)) if parts else F.array().cast("array<string>")
