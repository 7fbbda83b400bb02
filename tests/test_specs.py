from lakegate.plans.specs import (column_sheet, load_column_rules, load_table_rules, merge_keys,
                                  special_columns, start_validity_column, table_sheet)


def test_table_names_golden(spark):
    rows = [{"Delta Table Name": "billing", "last_table_name_conf": "billing_last_version"},
            {"Delta Table Name": "site", "last_table_name_conf": "nan"}]
    t = load_table_rules(table_sheet(spark, rows))
    assert t["billing"].last_table == "billing_last_version"
    assert t["billing"].all_table == "billing_all"
    assert t["site"].last_table == "site_last"
    assert t["site"].all_table == "site_all"


def test_column_rules_normalised(spark):
    rows = [{"Delta Table Name": "T", "Column Name": "id", "Field type": "long", "Is Special": "IsMergeKey",
             "Error action": "nan", "Is Nullable": "False"},
            {"Delta Table Name": "T", "Column Name": "d", "Field type": "DATE", "Is Special": "ISSTARTVALIDITY"},
            {"Delta Table Name": "T", "Column Name": "d2", "Field type": "DATE", "Is Special": "IsStartValidity"}]
    sheet = column_sheet(spark, rows)
    rules = load_column_rules(sheet, "t")
    assert [r.name for r in rules] == ["id", "d", "d2"]
    assert rules[0].action == "ICT_DRIVEN" and rules[0].nullable is False
    assert rules[1].date_pattern == "dd/MM/yyyy HH:mm:ss"
    assert merge_keys(rules) == ["id"]
    assert start_validity_column(rules) == "d"
    sc = special_columns(sheet).collect()[0]
    assert sc["merge_keys"] == ["id"] and sc["start_validity"] == "d"


def test_bad_date_pattern_rejected_at_load(spark):
    import pytest
    rows = [{"Delta Table Name": "t", "Column Name": "d", "Field type": "DATE", "Transformation pattern": "qqqqq"}]
    with pytest.raises(Exception):
        load_column_rules(column_sheet(spark, rows), "t")


def test_driver_and_expression_normalisation_agree(spark):
    from lakegate.plans import fixtures as fx
    from lakegate.plans.specs import (ColumnRule, TableRule, _rows_to, normalise_column_sheet,
                                      normalise_table_sheet)
    cs = column_sheet(spark, fx.ORDERS_COLUMN_ROWS + fx.LINEITEM_COLUMN_ROWS)
    ts = table_sheet(spark, fx.ORDERS_TABLE_ROWS + fx.LINEITEM_TABLE_ROWS + [{"Delta Table Name": "x",
                                                                              "Rejected line per file tolerance": "0.05"}])
    via_expr = _rows_to(ColumnRule, normalise_column_sheet(cs).orderBy("position").collect())
    assert via_expr == load_column_rules(cs, check_patterns=False)
    t_expr = {r.table_name: r for r in _rows_to(TableRule, normalise_table_sheet(ts).orderBy("position").collect())}
    assert t_expr == load_table_rules(ts)


def test_white_space_cells_and_java_patterns(spark):
    from lakegate.plans.specs import normalise_table_sheet
    sheet = table_sheet(spark, [{"Delta Table Name": "a", "Input delimiter": "\t"}, {"Delta Table Name": "b", "Input delimiter": "NaN"}])
    rules = load_table_rules(sheet)
    assert (rules["a"].delimiter, rules["b"].delimiter) == ("\t", ",")
    assert [r["delimiter"] for r in normalise_table_sheet(sheet).orderBy("position").collect()] == ["\t", ","]
    rows = [{"Delta Table Name": "a", "Column Name": "c", "Transformation Type": "regex",
             "Transformation pattern": r"\p{L}+", "Regex replacement": " "}]
    assert load_column_rules(column_sheet(spark, rows), "a")[0].replacement == " "


def test_substring_lookup_is_an_equi_join(spark):
    """FIL-18: exact name, then a name contained either way, the first in sheet order; no nested loop."""
    from lakegate.plans.specs import normalise_table_sheet, resolve_table_config, table_sheet
    sheet = ["salesarchive", "sales", "ale", "stock", "x" * 60]
    conf = normalise_table_sheet(table_sheet(spark, [{"Delta Table Name": n} for n in sheet]))
    names = ["sales", "sales2", "mysalesarchive", "sto", "whole", "", None, "none", "x" * 59, "sales2"]
    files = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, table_name string")
    got = resolve_table_config(files, conf, allow_substring=True)

    def expected(name):
        if name is None or name in sheet:
            return name
        return next((s for s in sheet if s in name or name in s), None)
    assert {r["i"]: r["cfg_table_name"] for r in got.collect()} == {i: expected(n) for i, n in enumerate(names)}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
