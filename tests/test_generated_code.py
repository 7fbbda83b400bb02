"""Generated code that the JVM can compile, and small frames that joins know to be small."""

import re
import uuid

from lakegate.operators.gates import bad_records
from lakegate.operators.quality import file_line_numbers
from lakegate.operators.rules import validate
from lakegate.plans import common as cm
from lakegate.sources import delimited as dl

JIT_BYTES = 8000
"""Methods of more bytes are interpreted by the JVM, whatever they cost."""


def test_validation_of_a_wide_table_is_compiled(spark, capsys):
    _, rules = cm.rules_for(spark, "lineitem")
    lines = spark.createDataFrame([("f.csv", "x", *["1"] * (len(rules) - 1))], "_file_name string, " + ", ".join(
        f"`{r.name}` string" for r in rules)).repartition(2)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        validate(lines, rules, raw_data_sep=",").explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < JIT_BYTES
    row = validate(lines, rules, raw_data_sep=",").first()
    assert row["_n_errors"] == len(row["_errors"]) and row["_errors"][0]["column"] == "orderkey"


def test_mapped_numbered_and_validated_lines_are_compiled(spark, tmp_root, capsys):
    _, rules = cm.rules_for(spark, "lineitem")
    names = [r.name for r in rules]
    for i, order in enumerate((names, names[::-1][1:])):
        with open(f"{tmp_root}/f{i}.csv", "w") as f:
            f.write(",".join(order) + "\n" + ",".join("7" for _ in order) + "\n")

    def store(df):
        path = f"{tmp_root}/kept/{uuid.uuid4().hex}"
        df.write.parquet(path)
        return spark.read.parquet(path)
    raw, pos = dl.read_positional(spark, tmp_root, len(names), glob="*.csv")
    raw = store(raw)
    lines = file_line_numbers(dl.remap_by_header(raw, names, pos, store=store), store=store)
    v = validate(lines, rules, raw_data_sep=",")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = v._jdf.queryExecution().executedPlan().toString()
        v.select("*").explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < JIT_BYTES
    got = {r["_file_name"]: (r["suppkey"], r["shipdate"], r["_raw_data"].count("7"), r["line_number"], r[dl.CORRUPT]) for r in v.collect()}
    assert got == {"f0.csv": (7, None, len(names), 1, None), "f1.csv": (7, None, len(names) - 1, 1, None)}


def test_bad_records_are_counted_without_sorting_lines(spark):
    lines = spark.createDataFrame([("/a/f.csv", "f.csv", "x"), ("/a/f.csv", "f.csv", None), ("/b/f.csv", "f.csv", None),
                                   ("/c", None, "y"), (None, "n", "z")], "_file_path string, _file_name string, _corrupt_record string")
    counts = bad_records(lines, dl.CORRUPT)
    plan = counts._jdf.queryExecution().sparkPlan().toString()
    assert plan.rfind("HashAggregate") > plan.rfind("SortAggregate")  # the one next to the lines
    got = {r["_file_path"]: (r["corrupt_lines"], r["_file_name"]) for r in counts.collect()}
    assert got == {"/a/f.csv": (1, "f.csv"), "/b/f.csv": (0, "f.csv"), "/c": (1, None), None: (1, "n")}
