"""DuckDB oracle SQL for the registered queries.

Written by hand from the rules' meaning (not generated from the Spark code), so
the comparison checks the engine against an independent statement of the
semantics.  DuckDB accepts some text Spark rejects ('1.5' or '1e3' as BIGINT,
single-digit days for %d), so integer and date parses are guarded by a regex.
"""

from __future__ import annotations

from lakegate.plans.fixtures import DIRTY_LINEITEM_SQL, DIRTY_ORDERS_SQL, ORDERS_BATCH2_SQL

AS_OF_SQL = "TIMESTAMP '2026-01-01 00:00:00'"


def _int(x: str, typ: str = "BIGINT") -> str:
    r = f"trim(replace({x}, ',', '.'))"
    return f"CASE WHEN regexp_full_match({r}, '[+-]?[0-9]+') THEN TRY_CAST({r} AS {typ}) END"


def _dec(x: str) -> str:
    return f"TRY_CAST(trim(replace({x}, ',', '.')) AS DECIMAL(18,2))"


def _blank(x: str) -> str:
    return f"({x} IS NULL OR trim({x}) = '')"


def orders_typed_ctes(source_sql: str = DIRTY_ORDERS_SQL, name: str = "t", p: str = "") -> str:
    """CTEs {p}d (dirty view), {p}v (parsed), {p}e, <name>, <name>2, <name>x (typed + line decisions)."""
    return f"""
{p}d AS ({source_sql}),
{p}v AS (
  SELECT _line_order, _file_name,
    orderkey AS r_orderkey, custkey AS r_custkey, totalprice AS r_totalprice,
    orderdate AS r_orderdate, orderstatus AS r_orderstatus, orderpriority AS r_orderpriority,
    {_blank('orderkey')} AS b_orderkey,
    {_blank('custkey')} AS b_custkey,
    {_blank('totalprice')} AS b_totalprice,
    {_blank('orderdate')} AS b_orderdate,
    {_blank('lower(orderstatus)')} AS b_orderstatus,
    {_blank("regexp_replace(orderpriority, '^[0-9]+-', '')")} AS b_orderpriority,
    {_int('orderkey')} AS p_orderkey,
    {_int('custkey')} AS p_custkey,
    {_dec('totalprice')} AS p_totalprice,
    CASE WHEN regexp_full_match(orderdate, '[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}}')
         THEN try_strptime(orderdate, '%d/%m/%Y') END AS p_orderdate,
    lower(orderstatus) AS p_orderstatus,
    regexp_replace(orderpriority, '^[0-9]+-', '') AS p_orderpriority
  FROM {p}d),
{p}e AS (
  SELECT *,
    CASE WHEN NOT b_orderkey AND p_orderkey IS NULL THEN 'TYPE_MISMATCH' WHEN b_orderkey THEN 'NULL_VALUE' END AS e_orderkey,
    CASE WHEN NOT b_custkey AND p_custkey IS NULL THEN 'TYPE_MISMATCH' WHEN b_custkey THEN 'NULL_VALUE' END AS e_custkey,
    CASE WHEN NOT b_totalprice AND p_totalprice IS NULL THEN 'TYPE_MISMATCH' WHEN b_totalprice THEN 'NULL_VALUE' END AS e_totalprice,
    CASE WHEN NOT b_orderdate AND p_orderdate IS NULL THEN 'DATE_PARSE_ERROR' WHEN b_orderdate THEN 'NULL_VALUE' END AS e_orderdate,
    CASE WHEN b_orderstatus THEN 'NULL_VALUE' END AS e_orderstatus
  FROM {p}v),
{name} AS (
  SELECT _line_order, _file_name,
    r_orderkey, r_custkey, r_totalprice, r_orderdate, r_orderstatus, r_orderpriority,
    e_orderkey, e_custkey, e_totalprice, e_orderdate, e_orderstatus,
    CASE WHEN NOT b_orderkey THEN p_orderkey END AS orderkey,
    CASE WHEN NOT b_custkey THEN p_custkey END AS custkey,
    CASE WHEN NOT b_totalprice THEN p_totalprice END AS totalprice,
    CASE WHEN NOT b_orderdate THEN p_orderdate END AS orderdate,
    CASE WHEN NOT b_orderstatus THEN p_orderstatus END AS orderstatus,
    CASE WHEN NOT b_orderpriority THEN p_orderpriority END AS orderpriority,
    CAST((e_orderkey IS NOT NULL) AS INTEGER) + CAST((e_custkey IS NOT NULL) AS INTEGER)
      + CAST((e_totalprice IS NOT NULL) AS INTEGER) + CAST((e_orderdate IS NOT NULL) AS INTEGER)
      + CAST((e_orderstatus IS NOT NULL) AS INTEGER) AS n_errors,
    CAST((e_orderkey IS NOT NULL) AS INTEGER) + CAST((e_custkey IS NOT NULL) AS INTEGER)
      + CAST((e_orderdate IS NOT NULL) AS INTEGER) AS n_ict,
    concat_ws(';', 'orderkey:' || e_orderkey, 'custkey:' || e_custkey, 'totalprice:' || e_totalprice,
              'orderdate:' || e_orderdate, 'orderstatus:' || e_orderstatus) AS error_codes,
    e_totalprice IS NOT NULL AS reject
  FROM {p}e),
{name}2 AS (
  SELECT *, (n_ict > 0 AND 100 * n_ict >= 30 * 6) AS ict_rejected
  FROM {name}),
{name}x AS (
  SELECT *, (reject OR ict_rejected) AS line_rejected FROM {name}2)"""


def orders_gate_ctes(typed: str = "tx", rlt: int = 7, fail_fast: int | None = None, p: str = "") -> str:
    """CTEs {p}fs (per-file stats), {p}fa, {p}dec (decisions), {p}rt (routed lines)."""
    ff = (f"100 * error_lines >= {fail_fast} * total_lines" if fail_fast is not None else "false")
    return f"""
{p}fs AS (
  SELECT _file_name, count(*) AS total_lines,
    count(*) FILTER (WHERE reject) AS reject_lines,
    count(*) FILTER (WHERE ict_rejected AND NOT reject) AS ict_lines,
    count(*) FILTER (WHERE line_rejected) AS rejected_lines,
    count(*) FILTER (WHERE n_errors > 0) AS error_lines,
    CAST(sum(n_errors) AS BIGINT) AS errors,
    count(*) FILTER (WHERE e_custkey IS NOT NULL) AS invalid_custkey,
    count(*) FILTER (WHERE e_orderdate IS NOT NULL) AS invalid_orderdate
  FROM {typed} GROUP BY _file_name),
{p}fa AS (
  SELECT *,
    concat_ws(',', CASE WHEN 100 * invalid_custkey >= 20 * total_lines THEN 'custkey' END,
                   CASE WHEN 100 * invalid_orderdate >= 10 * total_lines THEN 'orderdate' END) AS ab,
    (100 * rejected_lines >= {rlt} * total_lines) AS rlt_exceeded,
    ({ff}) AS fail_fast
  FROM {p}fs),
{p}dec AS (
  SELECT _file_name, total_lines, reject_lines, ict_lines, rejected_lines, error_lines, errors,
    invalid_custkey, invalid_orderdate,
    NULLIF(ab, '') AS aborted_columns, rlt_exceeded, fail_fast,
    CASE WHEN fail_fast THEN '000000007' WHEN ab <> '' THEN 'ICT_DRIVEN_ABORT'
         WHEN rlt_exceeded THEN 'RLT_EXCEEDED' END AS file_reason,
    CASE WHEN fail_fast OR ab <> '' OR rlt_exceeded THEN 'REJECTED' ELSE 'ACCEPTED' END AS file_status
  FROM {p}fa),
{p}rt AS (
  SELECT {typed}.*, {p}dec.file_status = 'REJECTED' AS file_rejected, {p}dec.file_reason,
    ({p}dec.file_status = 'ACCEPTED' AND NOT line_rejected) AS to_last,
    ({p}dec.file_status = 'ACCEPTED' AND NOT reject) AS to_all,
    row_number() OVER (PARTITION BY _file_name ORDER BY _line_order) AS line_number
  FROM {typed} LEFT JOIN {p}dec USING (_file_name))"""


ORACLES: dict[str, str] = {}


def oracle(name: str):
    def deco(fn):
        ORACLES[name] = fn()
        return fn
    return deco


# ---------------------------------------------------------------- rules (A)
@oracle("typed_orders")
def _():
    return f"""WITH {orders_typed_ctes()}
SELECT _file_name, _line_order, orderkey, custkey, totalprice, orderdate, orderstatus, orderpriority,
       n_errors, n_ict, error_codes, reject, ict_rejected, line_rejected
FROM tx"""


def error_rows_cte() -> str:
    """CTE ``err`` (one row per error of the typed orders) over ``tx``."""
    return """
er AS (
  SELECT _file_name, _line_order, 0 AS col_pos, 'orderkey' AS "column", e_orderkey AS code, 'ICT_DRIVEN' AS action,
         r_orderkey AS raw_value, 'LONG' AS typ FROM tx WHERE e_orderkey IS NOT NULL
  UNION ALL
  SELECT _file_name, _line_order, 1, 'custkey', e_custkey, 'ICT_DRIVEN', r_custkey, 'LONG' FROM tx WHERE e_custkey IS NOT NULL
  UNION ALL
  SELECT _file_name, _line_order, 2, 'totalprice', e_totalprice, 'REJECT', r_totalprice, 'DECIMAL' FROM tx WHERE e_totalprice IS NOT NULL
  UNION ALL
  SELECT _file_name, _line_order, 3, 'orderdate', e_orderdate, 'ICT_DRIVEN', r_orderdate, 'DATE' FROM tx WHERE e_orderdate IS NOT NULL
  UNION ALL
  SELECT _file_name, _line_order, 4, 'orderstatus', e_orderstatus, 'LOG_ONLY', r_orderstatus, 'STRING' FROM tx WHERE e_orderstatus IS NOT NULL),
err AS (
SELECT _file_name, _line_order,
  CAST(row_number() OVER (PARTITION BY _file_name, _line_order ORDER BY col_pos) - 1 AS INTEGER) AS error_pos,
  "column", code, action,
  CASE WHEN code = 'NULL_VALUE' THEN 'NULL VALUE: column ' || "column" || ' is not nullable'
       WHEN code = 'DATE_PARSE_ERROR' THEN 'DATE_PARSE_ERROR: column ' || "column" || ' pattern ''dd/MM/yyyy'' does not match value: ' || coalesce(raw_value, 'NULL')
       ELSE 'TYPE MISMATCH: column ' || "column" || ' expected ' || typ || ' value: ' || coalesce(raw_value, 'NULL') END AS message,
  raw_value
FROM er)"""


@oracle("error_rows")
def _():
    return f"""WITH {orders_typed_ctes()}, {error_rows_cte()}
SELECT * FROM err"""


@oracle("rlt_files")
def _():
    return f"""WITH {orders_typed_ctes()}, {orders_gate_ctes()}
SELECT _file_name, total_lines, reject_lines, ict_lines, rejected_lines, error_lines, errors,
       aborted_columns, rlt_exceeded, fail_fast, file_reason, file_status
FROM dec"""


@oracle("fail_fast")
def _():
    return f"""WITH {orders_typed_ctes()}, {orders_gate_ctes(fail_fast=30)}
SELECT _file_name, total_lines, error_lines, fail_fast, file_reason, file_status FROM dec"""


@oracle("column_abort")
def _():
    return f"""WITH {orders_typed_ctes()}, {orders_gate_ctes()}
SELECT _file_name, total_lines, invalid_custkey, invalid_orderdate, aborted_columns FROM dec"""


@oracle("ict_lines")
def _():
    return f"""WITH {orders_typed_ctes()}
SELECT _file_name, _line_order, n_ict, ict_rejected, line_rejected
FROM tx WHERE n_ict > 0"""


@oracle("quality_log")
def _():
    return f"""WITH {orders_typed_ctes()}, {orders_gate_ctes()}
SELECT 'orders' AS table_name, _file_name AS filename, total_lines AS total_rows,
       total_lines - rejected_lines AS valid_rows, rejected_lines AS invalid_rows, file_status AS status
FROM dec"""


@oracle("execution_report")
def _():
    return f"""WITH {orders_typed_ctes()}, {orders_gate_ctes()},
w AS (SELECT _file_name, count(*) FILTER (WHERE to_last) AS rows_to_last,
             count(*) FILTER (WHERE to_all) AS rows_to_all FROM rt GROUP BY _file_name)
SELECT 'orders' AS table_name, dec._file_name AS filename, total_lines AS rows_processed,
       rejected_lines AS rows_rejected, errors AS invalid_cells,
       CAST(coalesce(rows_to_last, 0) AS BIGINT) AS rows_to_last,
       CAST(coalesce(rows_to_all, 0) AS BIGINT) AS rows_to_all,
       CASE WHEN file_status = 'ACCEPTED' THEN 'SUCCESS' ELSE 'FAILED' END AS status,
       file_reason AS reason
FROM dec LEFT JOIN w USING (_file_name)"""


def lineitem_typed_ctes() -> str:
    """CTEs ld, lv, le, lt2 and lt (typed lineitem + line decisions)."""
    li = DIRTY_LINEITEM_SQL
    return f"""
ld AS ({li}),
lv AS (
  SELECT *,
    {_int('orderkey')} AS p_orderkey, {_int('linenumber', 'INTEGER')} AS p_linenumber,
    {_int('partkey')} AS p_partkey, {_int('suppkey')} AS p_suppkey,
    {_dec('quantity')} AS p_quantity, {_dec('extendedprice')} AS p_extendedprice,
    {_dec('discount')} AS p_discount, {_dec('tax')} AS p_tax,
    CASE WHEN regexp_full_match(shipdate, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}')
         THEN try_strptime(shipdate, '%Y-%m-%d') END AS p_shipdate
  FROM ld),
le AS (
  SELECT *,
    CASE WHEN NOT {_blank('orderkey')} AND p_orderkey IS NULL THEN 'TYPE_MISMATCH' WHEN {_blank('orderkey')} THEN 'NULL_VALUE' END AS e_orderkey,
    CASE WHEN NOT {_blank('linenumber')} AND p_linenumber IS NULL THEN 'TYPE_MISMATCH' WHEN {_blank('linenumber')} THEN 'NULL_VALUE' END AS e_linenumber,
    CASE WHEN NOT {_blank('partkey')} AND p_partkey IS NULL THEN 'TYPE_MISMATCH' WHEN {_blank('partkey')} THEN 'NULL_VALUE' END AS e_partkey,
    CASE WHEN NOT {_blank('suppkey')} AND p_suppkey IS NULL THEN 'TYPE_MISMATCH' END AS e_suppkey,
    CASE WHEN NOT {_blank('quantity')} AND p_quantity IS NULL THEN 'TYPE_MISMATCH' WHEN {_blank('quantity')} THEN 'NULL_VALUE' END AS e_quantity,
    CASE WHEN NOT {_blank('extendedprice')} AND p_extendedprice IS NULL THEN 'TYPE_MISMATCH' WHEN {_blank('extendedprice')} THEN 'NULL_VALUE' END AS e_extendedprice,
    CASE WHEN NOT {_blank('discount')} AND p_discount IS NULL THEN 'TYPE_MISMATCH' END AS e_discount,
    CASE WHEN NOT {_blank('tax')} AND p_tax IS NULL THEN 'TYPE_MISMATCH' END AS e_tax,
    CASE WHEN NOT {_blank('shipdate')} AND p_shipdate IS NULL THEN 'DATE_PARSE_ERROR' WHEN {_blank('shipdate')} THEN 'NULL_VALUE' END AS e_shipdate
  FROM lv),
lt2 AS (
  SELECT _file_name, _line_order,
    CASE WHEN NOT {_blank('orderkey')} THEN p_orderkey END AS orderkey,
    CASE WHEN NOT {_blank('linenumber')} THEN p_linenumber END AS linenumber,
    CASE WHEN NOT {_blank('partkey')} THEN p_partkey END AS partkey,
    CASE WHEN NOT {_blank('suppkey')} THEN p_suppkey END AS suppkey,
    CASE WHEN NOT {_blank('quantity')} THEN p_quantity END AS quantity,
    CASE WHEN NOT {_blank('extendedprice')} THEN p_extendedprice END AS extendedprice,
    CASE WHEN NOT {_blank('discount')} THEN p_discount END AS discount,
    CASE WHEN NOT {_blank('tax')} THEN p_tax END AS tax,
    CASE WHEN NOT {_blank('lower(returnflag)')} THEN lower(returnflag) END AS returnflag,
    CASE WHEN NOT {_blank('linestatus')} THEN linestatus END AS linestatus,
    CASE WHEN NOT {_blank('shipdate')} THEN p_shipdate END AS shipdate,
    CAST((e_orderkey IS NOT NULL) AS INTEGER) + CAST((e_linenumber IS NOT NULL) AS INTEGER)
      + CAST((e_partkey IS NOT NULL) AS INTEGER) + CAST((e_suppkey IS NOT NULL) AS INTEGER)
      + CAST((e_quantity IS NOT NULL) AS INTEGER) + CAST((e_extendedprice IS NOT NULL) AS INTEGER)
      + CAST((e_discount IS NOT NULL) AS INTEGER) + CAST((e_tax IS NOT NULL) AS INTEGER)
      + CAST((e_shipdate IS NOT NULL) AS INTEGER) AS n_errors,
    CAST((e_orderkey IS NOT NULL) AS INTEGER) + CAST((e_linenumber IS NOT NULL) AS INTEGER)
      + CAST((e_partkey IS NOT NULL) AS INTEGER) + CAST((e_suppkey IS NOT NULL) AS INTEGER)
      + CAST((e_discount IS NOT NULL) AS INTEGER) + CAST((e_tax IS NOT NULL) AS INTEGER)
      + CAST((e_shipdate IS NOT NULL) AS INTEGER) AS n_ict,
    concat_ws(';', 'orderkey:' || e_orderkey, 'linenumber:' || e_linenumber, 'partkey:' || e_partkey,
              'suppkey:' || e_suppkey, 'quantity:' || e_quantity, 'extendedprice:' || e_extendedprice,
              'discount:' || e_discount, 'tax:' || e_tax, 'shipdate:' || e_shipdate) AS error_codes,
    e_extendedprice IS NOT NULL AS reject
  FROM le),
lt AS (
  SELECT *, (n_ict > 0 AND 100 * n_ict >= 10 * 11) AS ict_rejected,
         (reject OR (n_ict > 0 AND 100 * n_ict >= 10 * 11)) AS line_rejected
  FROM lt2)"""


def lineitem_gate_ctes() -> str:
    """CTEs lfs, ldec, lrt: per-file RLT (5 %) decisions of the lineitem landing."""
    return """
lfs AS (
  SELECT _file_name, count(*) AS total_lines,
    count(*) FILTER (WHERE reject) AS reject_lines,
    count(*) FILTER (WHERE ict_rejected AND NOT reject) AS ict_lines,
    count(*) FILTER (WHERE line_rejected) AS rejected_lines,
    count(*) FILTER (WHERE n_errors > 0) AS error_lines,
    CAST(sum(n_errors) AS BIGINT) AS errors
  FROM lt GROUP BY _file_name),
ldec AS (
  SELECT *, CASE WHEN 100 * rejected_lines >= 5 * total_lines THEN 'RLT_EXCEEDED' END AS file_reason,
    CASE WHEN 100 * rejected_lines >= 5 * total_lines THEN 'REJECTED' ELSE 'ACCEPTED' END AS file_status
  FROM lfs),
lrt AS (
  SELECT lt.*, (ldec.file_status = 'ACCEPTED' AND NOT line_rejected) AS to_last,
    (ldec.file_status = 'ACCEPTED' AND NOT reject) AS to_all
  FROM lt LEFT JOIN ldec USING (_file_name))"""


@oracle("typed_lineitem")
def _():
    return f"""WITH {lineitem_typed_ctes()}
SELECT * FROM lt"""


# ----------------------------------------------------------- file gates (B)
def landing_cte() -> str:
    return """
lm AS (
  SELECT '/landing/' || filename AS path, filename, lines FROM (
    SELECT 'orders_' || strftime(o_orderdate, '%Y%m') || '01.csv' AS filename, count(*) AS lines
    FROM orders GROUP BY 1
    UNION ALL
    SELECT 'lineitem_' || strftime(l_shipdate, '%Y%m') || '01.csv' AS filename, count(*) AS lines
    FROM lineitem GROUP BY 1))"""


def _base(f: str) -> str:
    return f"regexp_replace({f}, '^(.+)\\.[^.]*$', '\\1')"


def _first_non_digit(base: str) -> str:
    return (f"coalesce(list_filter(string_split({base}, '_'), lambda p: NOT regexp_full_match(p, '[0-9]+'))[1], "
            f"string_split({base}, '_')[1])")


def table_from_name(f: str) -> str:
    return f"lower({_first_non_digit(_base(f))})"


def file_date_sql(f: str) -> str:
    p1, p2, p3, p4 = r"(\d{8})_(\d{6})", r"(\d{8})", r"(\d{4})-(\d{2})-(\d{2})", r"(\d{4})_(\d{2})_(\d{2})"
    return f"""CASE
  WHEN regexp_matches({f}, '{p1}') THEN try_strptime(regexp_extract({f}, '{p1}', 1) || regexp_extract({f}, '{p1}', 2), '%Y%m%d%H%M%S')
  WHEN regexp_matches({f}, '{p2}') THEN try_strptime(regexp_extract({f}, '{p2}', 1), '%Y%m%d')
  WHEN regexp_matches({f}, '{p3}') THEN try_strptime(regexp_extract({f}, '{p3}', 1) || regexp_extract({f}, '{p3}', 2) || regexp_extract({f}, '{p3}', 3), '%Y%m%d')
  WHEN regexp_matches({f}, '{p4}') THEN try_strptime(regexp_extract({f}, '{p4}', 1) || regexp_extract({f}, '{p4}', 2) || regexp_extract({f}, '{p4}', 3), '%Y%m%d')
END"""


def describe_cols(f: str = "filename") -> str:
    ymd = r"_(\d{4})(\d{2})(\d{2})"
    ext = f"lower(regexp_extract({f}, '^.+\\.([^.]*)$', 1))"
    return f"""{table_from_name(f)} AS table_name,
  {file_date_sql(f)} AS file_date,
  TRY_CAST(regexp_extract({f}, '{ymd}', 1) AS INTEGER) AS yyyy,
  TRY_CAST(regexp_extract({f}, '{ymd}', 2) AS INTEGER) AS mm,
  TRY_CAST(regexp_extract({f}, '{ymd}', 3) AS INTEGER) AS dd,
  CASE {ext} WHEN 'zip' THEN 'zip' WHEN 'csv' THEN 'csv' WHEN 'txt' THEN 'csv' WHEN 'parquet' THEN 'parquet'
       WHEN 'json' THEN 'json' WHEN 'jsonl' THEN 'json' END AS file_format"""


@oracle("file_manifest_orders")
def _():
    return f"""WITH {landing_cte()}
SELECT path, filename, lines, {describe_cols()} FROM lm"""


def date_reason_sql(f: str, require_date: bool) -> str:
    pat = r"(\d{4})(\d{2})(\d{2})"
    m = f"regexp_extract({f}, '{pat}', 0)"
    y = f"TRY_CAST(regexp_extract({f}, '{pat}', 1) AS INTEGER)"
    mo = f"TRY_CAST(regexp_extract({f}, '{pat}', 2) AS INTEGER)"
    d = f"TRY_CAST(regexp_extract({f}, '{pat}', 3) AS INTEGER)"
    nodate = "'no date yyyyMMdd in file name'" if require_date else "NULL"
    return f"""CASE WHEN {m} = '' THEN {nodate}
  WHEN NOT ({y} BETWEEN 1900 AND 2100) THEN printf('year %d outside 1900 to 2100', {y})
  WHEN NOT ({mo} BETWEEN 1 AND 12) THEN printf('month %d outside 1 to 12', {mo})
  WHEN NOT ({d} BETWEEN 1 AND 31) THEN printf('day %d outside 1 to 31', {d})
  WHEN try_strptime({m}, '%Y%m%d') IS NULL THEN 'no such day: ' || printf('%04d-%02d-%02d', {y}, {mo}, {d})
END"""


@oracle("filename_date_gate")
def _():
    return f"""WITH dd AS (SELECT DISTINCT o_orderdate AS d FROM orders),
names AS (
  SELECT DISTINCT unnest([
    'orders_' || strftime(d, '%Y%m%d') || '.csv',
    'orders_' || strftime(d, '%Y') || '13' || strftime(d, '%d') || '.csv',
    'orders_' || strftime(d, '%Y%m') || '32.csv',
    'orders_' || strftime(d, '%Y') || '0230.csv',
    'orders_' || CAST(year(d) - 200 AS VARCHAR) || strftime(d, '%m%d') || '.csv',
    'orders_extra_' || strftime(d, '%d') || '.csv']) AS filename
  FROM dd)
SELECT filename, {date_reason_sql('filename', False)} AS date_reason,
  CASE WHEN ({date_reason_sql('filename', False)}) IS NOT NULL THEN '000000001' END AS date_error_code,
  {date_reason_sql('filename', True)} AS strict_reason
FROM names"""


CONF_SQL = """
conf AS (
  SELECT * FROM (VALUES
    (0, 'orders', 'orders_<yyyy><mm><dd>.csv', 'orders_all', 'orders_last'),
    (1, 'lineitem', 'lineitem_<yyyy><mm><dd>.csv', 'li_all', 'lineitem_current'),
    (2, 'ordersarchive', '<yyyy><mm><dd>.csv', 'ordersarchive_all', 'ordersarchive_last'))
  AS c(position, table_name, filename_pattern, all_table, last_table)),
confx AS (
  SELECT *, trim(split_part(replace(replace(regexp_replace(filename_pattern, '<[^>]+>', '', 'g'), '.csv', ''), '.CSV', ''), '_', 1)) AS fix_part_expected
  FROM conf)"""


def fix_part_actual_sql(f: str) -> str:
    b = _base(f)
    return (f"CASE WHEN contains({b}, '_') THEN {_first_non_digit(b)} "
            f"ELSE trim(regexp_replace({b}, '[0-9]+$', '')) END")


@oracle("fix_part_gate")
def _():
    return f"""WITH {landing_cte()}, {CONF_SQL},
v AS (
  SELECT DISTINCT unnest([filename,
      upper(substr(split_part(filename, '_', 1), 1, 1)) || lower(substr(split_part(filename, '_', 1), 2))
        || substr(filename, length(split_part(filename, '_', 1)) + 1),
      upper(split_part(filename, '_', 1)) || substr(filename, length(split_part(filename, '_', 1)) + 1)]) AS filename
  FROM lm),
f AS (SELECT filename, {table_from_name('filename')} AS table_name, {fix_part_actual_sql('filename')} AS fix_part_actual FROM v),
g AS (
  SELECT f.filename, f.table_name, c.fix_part_expected, f.fix_part_actual,
    (c.fix_part_expected IS NOT NULL AND c.fix_part_expected <> '' AND f.fix_part_actual <> c.fix_part_expected) AS bad
  FROM f LEFT JOIN confx c ON f.table_name = c.table_name)
SELECT filename, table_name, fix_part_expected, fix_part_actual,
  CASE WHEN bad THEN printf('fix part mismatch (case-sensitive): expected ''%s'', got ''%s''', fix_part_expected, fix_part_actual) END AS fix_part_reason,
  CASE WHEN bad THEN '000000001' END AS fix_part_error_code
FROM g"""


@oracle("table_names")
def _():
    return f"""WITH {landing_cte()}, {CONF_SQL},
v AS (SELECT DISTINCT filename FROM (SELECT filename FROM lm UNION ALL
      SELECT regexp_replace(filename, '^orders_', 'ordersarchive_') FROM lm UNION ALL
      SELECT regexp_replace(filename, '^orders_', 'orders2_') FROM lm)),
f AS (SELECT filename, {table_from_name('filename')} AS table_name FROM v),
j AS (
  SELECT f.filename, f.table_name, c.table_name AS config_table, c.all_table, c.last_table,
    row_number() OVER (PARTITION BY f.filename, f.table_name
                       ORDER BY CASE WHEN f.table_name = c.table_name THEN 0 ELSE 1 END, c.position) AS rn
  FROM f LEFT JOIN conf c ON f.table_name = c.table_name OR contains(f.table_name, c.table_name)
                          OR contains(c.table_name, f.table_name))
SELECT filename, table_name, config_table, all_table, last_table FROM j WHERE rn = 1"""


def history_ctes(src: str) -> str:
    """hist (state before the run, from the landing), done, lastd, hc (checks over ``src``)."""
    return f"""
lf AS (SELECT path, filename, lines, {describe_cols()} FROM lm),
hist0 AS (
  SELECT table_name, filename, file_date, lines,
    CASE WHEN file_date <= TIMESTAMP '1996-06-01 00:00:00' THEN 'SUCCESS'
         WHEN file_date BETWEEN TIMESTAMP '1997-01-01 00:00:00' AND TIMESTAMP '1997-03-01 00:00:00' THEN 'FAILED' END AS status
  FROM lf WHERE table_name = 'orders'),
hist AS (
  SELECT table_name, filename, file_date, file_date + INTERVAL 1 DAY AS processed_date, status,
    CAST(CASE WHEN status = 'SUCCESS' THEN lines ELSE 0 END AS BIGINT) AS row_count
  FROM hist0 WHERE status IS NOT NULL),
done AS (SELECT DISTINCT table_name, filename FROM hist WHERE status = 'SUCCESS'),
lastd AS (SELECT table_name, max(file_date) AS last_date FROM hist
          WHERE status = 'SUCCESS' AND file_date IS NOT NULL GROUP BY table_name),
hc0 AS (
  SELECT s.*, lastd.last_date,
    (done.filename IS NOT NULL
     OR row_number() OVER (PARTITION BY s.table_name, s.filename ORDER BY s.path) > 1) AS is_duplicate
  FROM {src} s
  LEFT JOIN done ON s.table_name = done.table_name AND s.filename = done.filename
  LEFT JOIN lastd ON s.table_name = lastd.table_name),
hc AS (
  SELECT *,
    (file_date IS NOT NULL AND last_date IS NOT NULL AND file_date < last_date) AS is_late,
    CASE WHEN is_duplicate THEN '000000002'
         WHEN (file_date IS NOT NULL AND last_date IS NOT NULL AND file_date < last_date) THEN '000000003' END AS error_code,
    CASE WHEN is_duplicate THEN filename || ' was ingested into ' || table_name || ' before'
         WHEN (file_date IS NOT NULL AND last_date IS NOT NULL AND file_date < last_date)
         THEN 'dated ' || strftime(file_date, '%Y-%m-%d %H:%M:%S') || ', older than the newest ingested date '
              || strftime(last_date, '%Y-%m-%d %H:%M:%S') || ' of ' || table_name END AS first_message,
    filename || ' was ingested into ' || table_name || ' before' AS dup_message
  FROM hc0)"""


@oracle("file_validation")
def _():
    return f"""WITH {landing_cte()}, {history_ctes('lf')}
SELECT filename, table_name, file_date, is_duplicate, is_late,
  CAST(CAST(is_duplicate AS INTEGER) + CAST(is_late AS INTEGER) AS INTEGER) AS n_errors,
  error_code, (NOT is_duplicate AND NOT is_late) AS valid
FROM hc"""


@oracle("duplicate_files")
def _():
    return f"""WITH {landing_cte()}, {history_ctes('lf')}
SELECT filename, table_name, '000000002' AS error_code, dup_message AS message FROM hc WHERE is_duplicate"""


@oracle("file_order_gate")
def _():
    return f"""WITH {landing_cte()}, {history_ctes('lf')}
SELECT filename, table_name, file_date, last_date, is_late FROM hc"""


def outcomes_ctes() -> str:
    """Run outcomes of both landings: CTE ``oc``."""
    return f"""{landing_cte()}, {orders_typed_ctes()}, {orders_gate_ctes()}, {lineitem_typed_ctes()}, {lineitem_gate_ctes()},
ofl AS (
  SELECT 'orders' AS kind, dec._file_name AS filename, total_lines, rejected_lines, file_status, file_reason,
    w.rows_to_all, w.rows_to_last
  FROM dec LEFT JOIN (SELECT _file_name, count(*) FILTER (WHERE to_all) AS rows_to_all,
                             count(*) FILTER (WHERE to_last) AS rows_to_last FROM rt GROUP BY 1) w USING (_file_name)
  UNION ALL
  SELECT 'lineitem', ldec._file_name, total_lines, rejected_lines, file_status, file_reason,
    w.rows_to_all, w.rows_to_last
  FROM ldec LEFT JOIN (SELECT _file_name, count(*) FILTER (WHERE to_all) AS rows_to_all,
                              count(*) FILTER (WHERE to_last) AS rows_to_last FROM lrt GROUP BY 1) w USING (_file_name)),
rf AS (SELECT *, '/landing/' || filename AS path, {describe_cols()} FROM ofl),
{history_ctes('rf')[1:]},
oc0 AS (
  SELECT *, CASE WHEN total_lines = 0 THEN 'SKIPPED' WHEN error_code IS NOT NULL THEN 'FAILED'
                 WHEN file_status = 'REJECTED' THEN 'FAILED' ELSE 'SUCCESS' END AS status2
  FROM hc),
oc AS (
  SELECT table_name, filename, file_date, total_lines, rejected_lines,
    CAST(CASE WHEN status2 = 'SUCCESS' THEN rows_to_all ELSE 0 END AS BIGINT) AS rows_ingested,
    CAST(CASE WHEN status2 = 'SUCCESS' THEN rows_to_last ELSE 0 END AS BIGINT) AS rows_to_last,
    CAST(CASE WHEN status2 = 'SUCCESS' THEN rejected_lines ELSE total_lines END AS BIGINT) AS rows_rejected,
    status2 AS status,
    CASE WHEN status2 <> 'SUCCESS' THEN coalesce(error_code, file_reason) END AS error_code,
    CASE WHEN status2 <> 'SUCCESS' THEN coalesce(first_message, file_reason) END AS reason
  FROM oc0)"""


TRACK_NEW = f"""
tnew AS (
  SELECT table_name, filename, file_date, {AS_OF_SQL} AS processed_date, status,
    CAST(CASE WHEN status = 'SUCCESS' THEN rows_ingested ELSE 0 END AS BIGINT) AS row_count
  FROM oc),
tall AS (SELECT * FROM hist UNION ALL SELECT * FROM tnew)"""


@oracle("tracking_register")
def _():
    return f"""WITH {outcomes_ctes()}, {TRACK_NEW}
SELECT * FROM tnew"""


@oracle("tracking_summary")
def _():
    return f"""WITH {outcomes_ctes()}, {TRACK_NEW}
SELECT status, count(*) AS count FROM tall GROUP BY status"""


@oracle("tracking_summary_ranked")
def _():
    return f"""WITH {outcomes_ctes()}, {TRACK_NEW}
SELECT status, count(*) AS count, CAST(row_number() OVER (ORDER BY count(*) DESC, status) AS INTEGER) AS rank
FROM tall GROUP BY status"""


@oracle("tracking_by_table")
def _():
    return f"""WITH {outcomes_ctes()}, {TRACK_NEW}
SELECT table_name, count(*) AS files, CAST(sum(row_count) AS BIGINT) AS rows,
  count(*) FILTER (WHERE status = 'SUCCESS') AS success, count(*) FILTER (WHERE status = 'FAILED') AS failed
FROM tall GROUP BY table_name"""


@oracle("tracking_latest10")
def _():
    return f"""WITH {outcomes_ctes()}, {TRACK_NEW}
SELECT * FROM tall ORDER BY processed_date DESC, table_name, filename LIMIT 10"""


@oracle("tracking_retention")
def _():
    return f"""WITH {outcomes_ctes()}, {TRACK_NEW}
SELECT * FROM tall WHERE processed_date >= CAST(CAST({AS_OF_SQL} AS DATE) - INTERVAL 90 DAY AS TIMESTAMP)"""


@oracle("quarantine_manifest")
def _():
    return f"""WITH {outcomes_ctes()}
SELECT filename, table_name, error_code, reason, {AS_OF_SQL} AS rejected_at,
  'rejected/' || table_name || '/' || filename AS quarantine_path
FROM oc WHERE status = 'FAILED'"""


@oracle("completeness_check")
def _():
    return f"""WITH {outcomes_ctes()},
rec AS (SELECT {table_from_name('filename')} AS table_name, filename FROM lm),
j AS (SELECT coalesce(rec.table_name, oc.table_name) AS table_name, oc.status
      FROM rec FULL OUTER JOIN oc ON rec.table_name = oc.table_name AND rec.filename = oc.filename),
a AS (SELECT table_name, count(*) FILTER (WHERE status = 'SUCCESS') AS ingested,
        count(*) FILTER (WHERE status = 'SKIPPED') AS ignored, count(*) FILTER (WHERE status = 'FAILED') AS rejected,
        count(*) FILTER (WHERE status = 'ERROR') AS technical_errors FROM j GROUP BY table_name),
r AS (SELECT table_name, count(*) AS received FROM rec GROUP BY table_name)
SELECT coalesce(r.table_name, a.table_name) AS table_name, coalesce(received, 0) AS received, ingested, ignored,
  rejected, technical_errors, (ingested + ignored + rejected + technical_errors) = coalesce(received, 0) AS complete
FROM r FULL OUTER JOIN a ON r.table_name = a.table_name"""


@oracle("run_status")
def _():
    return f"""WITH {outcomes_ctes()},
a AS (SELECT table_name, count(*) AS files_received,
        count(*) FILTER (WHERE status = 'SUCCESS') AS files_processed,
        count(*) FILTER (WHERE status = 'FAILED') AS files_failed,
        count(*) FILTER (WHERE status = 'SKIPPED') AS files_skipped,
        count(*) FILTER (WHERE status = 'ERROR') AS files_error,
        CAST(sum(rows_ingested) AS BIGINT) AS rows_ingested,
        CAST(sum(rows_rejected) AS BIGINT) AS rows_rejected
      FROM oc GROUP BY table_name)
SELECT *, CASE WHEN files_error > 0 THEN 'ERROR'
               WHEN files_processed > 0 AND files_failed + files_skipped = 0 THEN 'SUCCESS'
               WHEN files_processed > 0 THEN 'PARTIAL' ELSE 'NO_DATA' END AS run_status
FROM a"""


@oracle("empty_files")
def _():
    return f"""WITH e AS (SELECT DISTINCT 'orders_' || strftime(l_shipdate, '%Y%m') || '01.csv' AS filename FROM lineitem),
c AS (SELECT 'orders_' || strftime(o_orderdate, '%Y%m') || '01.csv' AS filename, count(*) AS n FROM orders GROUP BY 1)
SELECT e.filename, coalesce(c.n, 0) AS lines, coalesce(c.n, 0) = 0 AS is_empty FROM e LEFT JOIN c USING (filename)"""


@oracle("column_count_gate")
def _():
    return """WITH l AS (
  SELECT 'customer_' || CAST(c_nationkey AS VARCHAR) || '.csv' AS _file_name,
    concat_ws(';', CAST(c_custkey AS VARCHAR), c_name, CAST(c_nationkey AS VARCHAR),
              CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR), c_mktsegment)
      || CASE WHEN c_custkey % 50 = 0 THEN ';extra' ELSE '' END AS line
  FROM customer),
s AS (SELECT _file_name, CAST(min(len(string_split(line, ';'))) AS INTEGER) AS min_fields,
        CAST(max(len(string_split(line, ';'))) AS INTEGER) AS max_fields, count(*) AS total_lines
      FROM l GROUP BY _file_name)
SELECT _file_name, total_lines, min_fields, max_fields, 5 AS expected_fields,
  CASE WHEN min_fields <> 5 OR max_fields <> 5 THEN '000000006' END AS error_code,
  CASE WHEN min_fields <> 5 OR max_fields <> 5 THEN 'REJECTED' ELSE 'ACCEPTED' END AS file_status
FROM s"""


# ---------------------------------------------- projections & quality (C/D)
ORDER_VALUES_SQL = "orderkey, custkey, totalprice, orderdate, orderstatus, orderpriority"


@oracle("header_line_filter")
def _():
    def eq(c, v):
        return f"lower(trim({c})) IS NOT DISTINCT FROM '{v}'"
    cond = " AND ".join(eq(c, c) for c in ["orderkey", "custkey", "totalprice", "orderdate", "orderstatus"])
    return f"""WITH d AS ({DIRTY_ORDERS_SQL}), f AS (SELECT DISTINCT _file_name FROM d),
a AS (
  SELECT _file_name, _line_order, orderkey, custkey, totalprice, orderdate, orderstatus FROM d
  UNION ALL SELECT _file_name, -1, 'ORDERKEY', 'CustKey', 'totalprice', 'OrderDate', ' orderstatus ' FROM f
  UNION ALL SELECT _file_name, -2, 'ORDERKEY', 'CustKey', NULL, 'OrderDate', ' orderstatus ' FROM f)
SELECT _file_name, count(*) AS lines_kept, count(*) FILTER (WHERE _line_order < 0) AS header_like_kept
FROM a WHERE NOT ({cond})
GROUP BY _file_name"""


@oracle("positional_rename")
def _():
    return f"""WITH d AS ({DIRTY_LINEITEM_SQL})
SELECT _file_name, orderkey, linenumber, partkey, suppkey, quantity, extendedprice, discount, tax,
       returnflag, linestatus, shipdate FROM d"""


@oracle("lowercase_names")
def _():
    return f"""WITH d AS ({DIRTY_ORDERS_SQL}) SELECT _file_name, {ORDER_VALUES_SQL} FROM d"""


@oracle("missing_columns")
def _():
    return f"""WITH d AS ({DIRTY_ORDERS_SQL})
SELECT DISTINCT _file_name AS filename, 'orderpriority' AS column_name, 'INFO_MISSING_COLUMN' AS error_type,
  'orders' AS table_name, 'missing column orderpriority added as NULL' AS error_message,
  CAST(NULL AS VARCHAR) AS raw_value
FROM d"""


def _dmy(x: str) -> str:
    return f"CASE WHEN regexp_full_match({x}, '[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}}') THEN try_strptime({x}, '%d/%m/%Y') END"


def _ymd(x: str) -> str:
    return f"CASE WHEN regexp_full_match({x}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN try_strptime({x}, '%Y-%m-%d') END"


@oracle("date_strict")
def _():
    return f"""WITH d AS ({DIRTY_ORDERS_SQL}),
p AS (SELECT _line_order, orderdate AS raw,
        CASE WHEN NOT {_blank('orderdate')} THEN {_dmy('orderdate')} END AS parsed,
        {_blank('orderdate')} AS b FROM d)
SELECT _line_order, raw, parsed, strftime(parsed, '%Y-%m-%d %H:%M:%S') AS output_text,
       (NOT b AND parsed IS NULL) AS is_error FROM p"""


@oracle("date_multi_default")
def _():
    return f"""WITH o AS ({DIRTY_ORDERS_SQL}), l AS ({DIRTY_LINEITEM_SQL}),
r AS (SELECT _line_order, 'lineitem' AS src, shipdate AS raw FROM l
      UNION ALL SELECT _line_order, 'orders', orderdate FROM o),
p AS (SELECT *, coalesce({_ymd('raw')}, {_dmy('raw')}) AS first FROM r)
SELECT src, _line_order, raw, coalesce(first, TIMESTAMP '1900-01-01 00:00:00') AS parsed,
  CASE WHEN first IS NULL AND {_blank('raw')} THEN 'EMPTY_DATE' WHEN first IS NULL THEN 'INVALID_DATE' END AS error_message
FROM p"""


@oracle("text_transforms")
def _():
    return """SELECT c_custkey, lower(c_mktsegment) AS segment_lower, upper(c_name) AS name_upper,
  regexp_replace(c_name, '#0*', '', 'g') AS name_regex, regexp_replace(c_name, '[0-9]', '9', 'g') AS name_digits,
  CAST(length(trim(c_name)) AS INTEGER) AS name_length
FROM customer"""


@oracle("filename_enrich")
def _():
    return f"""WITH d AS ({DIRTY_ORDERS_SQL})
SELECT _file_name, CASE WHEN NOT {_blank('orderkey')} THEN {_int('orderkey')} END AS orderkey,
  regexp_extract(_file_name, '.{{12}}$', 0) AS file_suffix, regexp_extract(_file_name, '[0-9]{{6}}', 0) AS file_month
FROM d"""


@oracle("line_numbers")
def _():
    return f"""WITH d AS ({DIRTY_ORDERS_SQL})
SELECT _file_name, _line_order, row_number() OVER (PARTITION BY _file_name ORDER BY _line_order) AS line_number
FROM d"""


def invalid_lines_cte() -> str:
    return f"""{orders_typed_ctes()},
inv AS (
  SELECT _line_order AS invalid_line_id, _file_name AS filename,
    strptime(regexp_extract(_file_name, '(\\d{{8}})', 1) || '000000', '%Y%m%d%H%M%S') + INTERVAL 1 DAY AS rejection_date,
    CASE WHEN reject THEN 'REJECT' ELSE 'ICT_DRIVEN' END AS rejection_reason,
    coalesce(e_orderkey, e_custkey, e_totalprice, e_orderdate, e_orderstatus) AS error_type,
    error_codes AS error_details,
    row_number() OVER (PARTITION BY _file_name ORDER BY _line_order) AS line_number,
    concat_ws(';', r_orderkey, r_custkey, r_totalprice, r_orderdate, r_orderstatus, r_orderpriority) AS raw_data,
    {ORDER_VALUES_SQL}, line_rejected
  FROM tx)"""


@oracle("invalid_lines")
def _():
    return f"""WITH {invalid_lines_cte()}
SELECT invalid_line_id, filename, rejection_date, rejection_reason, error_type, error_details, line_number,
       raw_data, {ORDER_VALUES_SQL}
FROM inv WHERE line_rejected"""


@oracle("invalid_lines_summary")
def _():
    return f"""WITH {invalid_lines_cte()}
SELECT 'orders' AS table_name, rejection_reason, error_type, count(*) AS lines, count(DISTINCT filename) AS files
FROM inv WHERE line_rejected GROUP BY rejection_reason, error_type"""


@oracle("invalid_lines_latest10")
def _():
    return f"""WITH {invalid_lines_cte()}
SELECT filename, line_number, rejection_date, rejection_reason, error_type,
  CAST(row_number() OVER (ORDER BY rejection_date DESC, filename, line_number) AS INTEGER) AS rank
FROM inv WHERE line_rejected ORDER BY rank LIMIT 10"""


@oracle("invalid_lines_by_file_ranked")
def _():
    return f"""WITH {invalid_lines_cte()}
SELECT filename, count(*) AS lines, CAST(row_number() OVER (ORDER BY count(*) DESC, filename) AS INTEGER) AS rank
FROM inv WHERE line_rejected GROUP BY filename"""


@oracle("invalid_lines_retention")
def _():
    return f"""WITH {invalid_lines_cte()}
SELECT invalid_line_id, filename, rejection_date, line_number FROM inv
WHERE line_rejected AND rejection_date >= CAST(DATE '1998-09-01' - INTERVAL 30 DAY AS TIMESTAMP)"""


@oracle("error_sample_top")
def _():
    return f"""WITH {orders_typed_ctes()}, {error_rows_cte()},
s AS (SELECT *, CAST(row_number() OVER (PARTITION BY _file_name, "column" ORDER BY _line_order) AS INTEGER) AS sample_rank
      FROM err)
SELECT _file_name, "column", sample_rank, _line_order, code, raw_value FROM s WHERE sample_rank <= 3"""


@oracle("null_checks")
def _():
    return f"""WITH {orders_typed_ctes()}, {error_rows_cte()}
SELECT _file_name, "column", action, count(*) AS null_values FROM err WHERE code = 'NULL_VALUE'
GROUP BY _file_name, "column", action"""


@oracle("type_mismatch")
def _():
    return f"""WITH {orders_typed_ctes()}, {error_rows_cte()}
SELECT "column", code, count(*) AS errors, count(DISTINCT raw_value) AS distinct_values, min(raw_value) AS example
FROM err WHERE code IN ('TYPE_MISMATCH', 'DATE_PARSE_ERROR') GROUP BY "column", code"""


@oracle("duplicate_keys")
def _():
    return f"""WITH {orders_typed_ctes()}
SELECT 'orders' AS table_name, 'custkey' AS column_name, custkey, 'DUPLICATE_KEY' AS error_message,
       count(*) AS error_count
FROM tx GROUP BY custkey HAVING count(*) > 1"""


@oracle("all_null_columns")
def _():
    cols = ["orderkey", "custkey", "totalprice", "orderdate", "orderstatus", "orderpriority"]
    counts = ", ".join(f"count({c}) AS nonnull_{c}" for c in cols)
    names = ", ".join(f"CASE WHEN nonnull_{c} = 0 THEN '{c}' END" for c in cols)
    alln = " AND ".join(f"nonnull_{c} = 0" for c in cols)
    return f"""WITH {orders_typed_ctes()},
g AS (SELECT _file_name, count(*) AS rows, {counts} FROM tx GROUP BY _file_name)
SELECT *, concat_ws(',', {names}) AS all_null_columns, CASE WHEN {alln} THEN 'FILE_EMPTY' END AS error_type
FROM g"""


# ------------------------------------------------------------------ modes (E)
def batches_ctes() -> str:
    """b1l/b1a (batch 1 `_last`/`_all`) and b2l/b2a (batch 2), technical columns first."""
    def tech(rt: str, when: str, flag: str) -> str:
        return f"""SELECT CAST(line_number AS BIGINT) AS FILE_LINE_ID, _file_name AS FILE_NAME_RECEIVED,
    {file_date_sql('_file_name')} AS FILE_EXTRACTION_DATE, {when} AS FILE_PROCESS_DATE,
    {ORDER_VALUES_SQL} FROM {rt} WHERE {flag}"""
    b1 = f"{AS_OF_SQL} - INTERVAL 1 DAY"
    return f"""{orders_typed_ctes()}, {orders_gate_ctes()},
{orders_typed_ctes(ORDERS_BATCH2_SQL, name='b', p='b')}, {orders_gate_ctes(typed='bx', p='b')},
b1l AS ({tech('rt', b1, 'to_last')}),
b1a AS ({tech('rt', b1, 'to_all')}),
b2l AS ({tech('brt', AS_OF_SQL, 'to_last')}),
b2a AS ({tech('brt', AS_OF_SQL, 'to_all')})"""


TECH_COLS_SQL = f"FILE_LINE_ID, FILE_NAME_RECEIVED, FILE_EXTRACTION_DATE, FILE_PROCESS_DATE, {ORDER_VALUES_SQL}"

UPSERT_SQL = f"""
src AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY orderkey
      ORDER BY orderdate DESC NULLS LAST, FILE_NAME_RECEIVED DESC, FILE_LINE_ID DESC) AS rn FROM b2l) WHERE rn = 1),
ups AS (
  SELECT t.* FROM b1l t LEFT JOIN src s ON t.orderkey = s.orderkey
  WHERE s.orderkey IS NULL OR NOT (s.orderdate > t.orderdate OR (t.orderdate IS NULL AND s.orderdate IS NOT NULL))
  UNION ALL
  SELECT {TECH_COLS_SQL} FROM src s WHERE NOT EXISTS (SELECT 1 FROM b1l t WHERE t.orderkey = s.orderkey)
     OR EXISTS (SELECT 1 FROM b1l t WHERE t.orderkey = s.orderkey
                AND (s.orderdate > t.orderdate OR (t.orderdate IS NULL AND s.orderdate IS NOT NULL))))"""


@oracle("mode_full_snapshot")
def _():
    return f"""WITH {batches_ctes()} SELECT *, 'last' AS kept_in FROM b2l
UNION ALL SELECT *, 'all' FROM b1l UNION ALL SELECT *, 'all' FROM b2l"""


@oracle("mode_full_snapshot_files")
def _():
    return f"""WITH {batches_ctes()}
SELECT * FROM b1l WHERE (FILE_EXTRACTION_DATE, FILE_NAME_RECEIVED) = (
  SELECT (FILE_EXTRACTION_DATE, FILE_NAME_RECEIVED) FROM b1l ORDER BY 1 DESC LIMIT 1)"""


@oracle("mode_key_replace_files")
def _():
    return f"""WITH {batches_ctes()}, both_batches AS (SELECT * FROM b1l UNION ALL SELECT * FROM b2l)
SELECT * EXCLUDE (newest) FROM (SELECT *, max(FILE_EXTRACTION_DATE) OVER (PARTITION BY custkey) AS newest FROM both_batches)
WHERE FILE_EXTRACTION_DATE = newest"""


@oracle("mode_upsert_new_column")
def _():
    return f"""WITH {batches_ctes()}, {UPSERT_SQL}
SELECT orderkey, FILE_NAME_RECEIVED, FILE_LINE_ID, orderdate,
  CASE WHEN EXISTS (SELECT 1 FROM b2l s WHERE s.orderkey = ups.orderkey AND s.FILE_NAME_RECEIVED = ups.FILE_NAME_RECEIVED
    AND s.FILE_LINE_ID = ups.FILE_LINE_ID) THEN 'batch 2' END AS note
FROM ups"""


@oracle("mode_delta_flow")
def _():
    return f"WITH {batches_ctes()} SELECT * FROM b1a UNION ALL SELECT * FROM b2a"


@oracle("mode_upsert")
def _():
    return f"WITH {batches_ctes()}, {UPSERT_SQL} SELECT * FROM ups"


@oracle("mode_historized")
def _():
    return f"WITH {batches_ctes()} SELECT * FROM b1l UNION ALL SELECT * FROM b2l"


@oracle("mode_key_replace")
def _():
    return f"""WITH {batches_ctes()}
SELECT * FROM b1l t WHERE NOT EXISTS (SELECT 1 FROM b2l s WHERE s.orderkey = t.orderkey)
UNION ALL SELECT * FROM b2l"""


@oracle("technical_columns")
def _():
    return f"WITH {batches_ctes()} SELECT * FROM b1a"


@oracle("partition_columns")
def _():
    return f"""WITH {batches_ctes()}
SELECT strftime(FILE_EXTRACTION_DATE, '%Y') AS yyyy, strftime(FILE_EXTRACTION_DATE, '%m') AS mm,
  strftime(FILE_EXTRACTION_DATE, '%d') AS dd, strftime(FILE_EXTRACTION_DATE, '%H%M%S') AS hhmmss, count(*) AS rows
FROM b1a GROUP BY 1, 2, 3, 4"""


@oracle("last_vs_all")
def _():
    return f"""WITH {batches_ctes()}, {UPSERT_SQL}
SELECT 'orders_last' AS table_name, count(*) AS row_count FROM ups
UNION ALL SELECT 'orders_all', (SELECT count(*) FROM b1a) + (SELECT count(*) FROM b2a)"""


@oracle("staging_stats")
def _():
    return f"""WITH o AS ({DIRTY_ORDERS_SQL}), l AS ({DIRTY_LINEITEM_SQL})
SELECT 'orders_staging' AS table_name, count(*) AS row_count, count(DISTINCT _file_name) AS file_count FROM o
UNION ALL
SELECT 'lineitem_staging', count(*), count(DISTINCT _file_name) FROM l"""


# --------------------------------------------------------------- sources (G)
def _nz(c: str) -> str:
    return f"NULLIF({c}, '')"


@oracle("csv_roundtrip_headers")
def _():
    vals = ", ".join(f"{_nz(c)} AS {c}" for c in ORDER_VALUES_SQL.split(", "))
    return f"""WITH d AS ({DIRTY_ORDERS_SQL})
SELECT _file_name, {vals}, m.header_mode
FROM d CROSS JOIN (VALUES ('DEFAULT'), ('FIRST_LINE'), ('HEADER_USE')) AS m(header_mode)"""


@oracle("corrupt_records")
def _():
    cols = ORDER_VALUES_SQL.split(", ")
    full = "concat_ws(';', " + ", ".join(cols) + ")"
    short = "concat_ws(';', " + ", ".join(cols[:-1]) + ")"
    vals = ", ".join(f"{_nz(c)} AS {c}" for c in cols[:-1])
    return f"""WITH d AS ({DIRTY_ORDERS_SQL})
SELECT _file_name,
  CASE WHEN _line_order % 29 = 0 THEN {short} ELSE {full} || ';extra' END AS corrupt_record,
  {vals}, CASE WHEN _line_order % 29 = 0 THEN NULL ELSE {_nz('orderpriority')} END AS orderpriority
FROM d WHERE _line_order % 29 = 0 OR _line_order % 31 = 0"""


@oracle("json_parquet_sources")
def _():
    return f"""WITH d AS ({DIRTY_ORDERS_SQL})
SELECT _file_name, {ORDER_VALUES_SQL}, f.format
FROM d CROSS JOIN (VALUES ('json'), ('parquet')) AS f(format)"""


@oracle("landing_listing")
def _():
    return """WITH n AS (SELECT DISTINCT 'orders_' || strftime(o_orderdate, '%Y%m') || '01.csv' AS landing_name FROM orders)
SELECT landing_name, f.file_format, true AS present
FROM n CROSS JOIN (VALUES ('csv'), ('json'), ('parquet')) AS f(file_format)"""


@oracle("zip_expand")
def _():
    vals = ", ".join(f"{_nz(c)} AS {c}" for c in ORDER_VALUES_SQL.split(", "))
    return f"""WITH d AS ({DIRTY_ORDERS_SQL})
SELECT _file_name AS entry_name, 'orders' AS table_name,
  row_number() OVER (PARTITION BY _file_name ORDER BY _line_order) + 1 AS line_no, {vals}
FROM d"""


# ------------------------------------------------------------- streaming (H)
@oracle("stream_events_staging")
def _():
    return """SELECT 'events_' || strftime(ts, '%Y%m%d') || '.json' AS _file_name,
  CAST(event_id AS VARCHAR) AS event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts,
  CAST(user_id AS VARCHAR) AS user_id, event_type,
  CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS value, props
FROM events"""


@oracle("stream_upsert_events")
def _():
    return """WITH r AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
SELECT user_id, event_id, strptime(strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), '%Y-%m-%d %H:%M:%S.%f') AS ts,
  event_type, CAST(value AS DECIMAL(18,2)) AS value, props
FROM r WHERE rn = 1"""


# ------------------------------------------------------- end-to-end run (I)
@oracle("ingest_run_quality")
def _():
    return f"""WITH {orders_typed_ctes()}, {orders_gate_ctes()}, {lineitem_typed_ctes()}, {lineitem_gate_ctes()}
SELECT 'orders' AS table_name, _file_name AS filename, total_lines AS total_rows,
       total_lines - rejected_lines AS valid_rows, rejected_lines AS invalid_rows, file_status AS status FROM dec
UNION ALL
SELECT 'lineitem', _file_name, total_lines, total_lines - rejected_lines, rejected_lines, file_status FROM ldec"""


@oracle("files_by_table")
def _():
    return f"""WITH {landing_cte()},
f AS (SELECT path, filename, {table_from_name('filename')} AS table_name FROM lm)
SELECT table_name, count(*) AS file_count, min(filename) AS first_file, max(filename) AS last_file,
  CAST(count(DISTINCT regexp_replace(path, '/[^/]*$', '')) AS INTEGER) AS folders
FROM f GROUP BY table_name"""


@oracle("stream_ingest_orders")
def _():
    return f"""WITH {batches_ctes()}
SELECT FILE_LINE_ID, FILE_NAME_RECEIVED, FILE_EXTRACTION_DATE, {AS_OF_SQL} AS FILE_PROCESS_DATE, {ORDER_VALUES_SQL}
FROM b1l"""


@oracle("validity_ranges")
def _():
    return f"""WITH {batches_ctes()}, h AS (SELECT * FROM b1a UNION ALL SELECT * FROM b2a)
SELECT orderkey, FILE_NAME_RECEIVED, FILE_LINE_ID, orderdate, orderdate AS valid_from,
  lead(orderdate) OVER (PARTITION BY orderkey ORDER BY orderdate NULLS FIRST, FILE_NAME_RECEIVED, FILE_LINE_ID) AS valid_to
FROM h"""


@oracle("ingest_rerun_last")
def _():
    return ORACLES["stream_ingest_orders"]


@oracle("stream_ingest_archives")
def _():
    return ORACLES["stream_ingest_orders"]


@oracle("ingest_rerun_tracking")
def _():
    return f"""SELECT table_name, filename, status, rows_to_all AS row_count
FROM ({ORACLES["execution_report"]})"""


@oracle("ingest_table_error")
def _():
    return f"""WITH {lineitem_typed_ctes()}, {lineitem_gate_ctes()}
SELECT table_name, filename, status, rows_to_all AS rows_ingested FROM ({ORACLES["execution_report"]})
UNION ALL SELECT 'lineitem', _file_name, 'ERROR', 0 FROM ldec"""


def _with_process_date(batch: str) -> str:
    return f"SELECT {TECH_COLS_SQL} FROM {batch}"


@oracle("ingest_upsert_buckets")
def _():
    return f"WITH {batches_ctes()}, {UPSERT_SQL} {_with_process_date('ups')}"


@oracle("ingest_key_replace_buckets")
def _():
    # Several files may hold a key: all its rows of the newest one stay.
    def newest(b: str) -> str:
        return f"""(SELECT {TECH_COLS_SQL} FROM (SELECT *, rank() OVER (PARTITION BY orderkey
      ORDER BY FILE_EXTRACTION_DATE DESC NULLS LAST, FILE_NAME_RECEIVED DESC) AS rk FROM {b}) WHERE rk = 1)"""
    return f"""WITH {batches_ctes()}
SELECT * FROM {newest('b1l')} t WHERE NOT EXISTS (SELECT 1 FROM b2l s WHERE s.orderkey = t.orderkey)
UNION ALL SELECT * FROM {newest('b2l')}"""


@oracle("ingest_rejected_snapshot")
def _():
    return f"""WITH {batches_ctes()}, newest AS (
  SELECT _file_name AS f FROM dec WHERE file_status = 'ACCEPTED' ORDER BY {file_date_sql('_file_name')} DESC, f DESC LIMIT 1)
SELECT FILE_LINE_ID, FILE_NAME_RECEIVED, FILE_EXTRACTION_DATE, {AS_OF_SQL} AS FILE_PROCESS_DATE, {ORDER_VALUES_SQL}
FROM b1l WHERE FILE_NAME_RECEIVED = (SELECT f FROM newest)"""


@oracle("ingest_same_names")
def _():
    return f"""WITH {orders_typed_ctes()}, lines AS (
  SELECT 'a' AS folder, _file_name AS filename, line_rejected FROM tx
  UNION ALL SELECT 'b', _file_name, line_rejected FROM tx WHERE orderkey % 2 = 0)
SELECT folder, filename, count(*) AS total_lines, count(*) FILTER (WHERE line_rejected) AS rejected_lines
FROM lines GROUP BY folder, filename"""


@oracle("ingest_older_rerun")
def _():
    return ORACLES["ingest_rerun_tracking"]


@oracle("header_use_extra_cell")
def _():
    return ORACLES["corrupt_records"]


@oracle("zip_json")
def _():
    vals = ", ".join(f"{c} AS {c}" for c in ORDER_VALUES_SQL.split(", "))
    return f"""WITH d AS ({DIRTY_ORDERS_SQL})
SELECT regexp_replace(_file_name, 'csv$', 'json') AS entry_name, 'orders' AS table_name,
  row_number() OVER (PARTITION BY _file_name ORDER BY _line_order) AS line_no, {vals}
FROM d"""


@oracle("csv_quote_ml")
def _():
    return f"""WITH d AS ({DIRTY_ORDERS_SQL})
SELECT _file_name AS file_name, orderkey, orderstatus || ';"' || totalprice || '"' || chr(10) || 'line 2' AS note,
  orderpriority, false AS corrupt, source FROM d, (VALUES ('direct'), ('archive')) s(source)"""


@oracle("ingest_fail_fast")
def _():
    return f"""WITH {orders_typed_ctes()}, {orders_gate_ctes(fail_fast=30)},
stop AS (SELECT min(_file_name) AS f FROM dec WHERE fail_fast),
w AS (SELECT _file_name, count(*) FILTER (WHERE to_all) AS n FROM rt GROUP BY _file_name)
SELECT _file_name AS filename,
  CASE WHEN _file_name > f THEN 'SKIPPED' WHEN file_status = 'ACCEPTED' THEN 'SUCCESS' ELSE 'FAILED' END AS status,
  CASE WHEN _file_name > f THEN 'FAIL_FAST_STOP' ELSE file_reason END AS error_code,
  CASE WHEN _file_name > f THEN 0 ELSE n END AS rows_ingested,
  CASE WHEN _file_name >= f THEN 0 ELSE rejected_lines END AS invalid_lines
FROM dec JOIN w USING (_file_name), stop"""


@oracle("ingest_error_log")
def _():
    return f"""WITH {orders_typed_ctes()}, {error_rows_cte()},
ln AS (SELECT _file_name, _line_order, row_number() OVER (PARTITION BY _file_name ORDER BY _line_order) AS line_number FROM tx)
SELECT 'orders' AS table_name, _file_name AS filename, line_number, error_pos, "column", code, action, message,
  nullif(raw_value, '') AS raw_value  -- a blank cell of a file is NULL
FROM err JOIN ln USING (_file_name, _line_order)"""


@oracle("ingest_mode_stats")
def _():
    return f"""WITH {orders_typed_ctes()}, {orders_gate_ctes()}
SELECT 'orders' AS table_name, 'DELTA_FROM_NON_HISTORIZED' AS mode, count(*) AS rows, true AS last_written, true AS all_written
FROM rt WHERE to_last"""


@oracle("ingest_quality_issues")
def _():
    twice = f"SELECT * FROM ({DIRTY_ORDERS_SQL}) UNION ALL SELECT * FROM ({DIRTY_ORDERS_SQL}) WHERE _line_order % 3 = 0"
    return f"""WITH {orders_typed_ctes(twice)}, {orders_gate_ctes()}
SELECT 'orders' AS table_name, CAST(NULL AS VARCHAR) AS filename, 'orderkey' AS column_name,
  CAST(orderkey AS VARCHAR) AS key_value, 'DUPLICATE_KEY' AS error_message, count(*) AS error_count
FROM rt WHERE to_last GROUP BY orderkey HAVING count(*) > 1"""


@oracle("ingest_retention")
def _():
    return f"""WITH {orders_typed_ctes()}
SELECT 'orders_invalid_lines' AS kept_in, _file_name AS filename, count(*) AS kept_rows
FROM tx WHERE line_rejected AND substr(_file_name, 8, 4) >= '1995' GROUP BY _file_name
UNION ALL SELECT DISTINCT 'tracking', _file_name, 1 FROM tx"""


@oracle("history_type_change")
def _():
    return """SELECT CAST(o_orderkey AS BIGINT) AS orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS price,
  strftime(o_orderdate, '%Y-%m-%d') AS day, CASE WHEN o_orderkey % 2 <> 0 THEN o_orderstatus END AS status FROM orders"""


@oracle("parquet_types")
def _():
    return """SELECT CAST(o_orderkey AS VARCHAR) AS orderkey, CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_custkey AS VARCHAR) END AS custkey,
  CASE WHEN o_orderkey % 2 <> 0 THEN o_orderstatus END AS status FROM orders"""


@oracle("invalid_lines_all_tables")
def _():
    return f"""WITH {invalid_lines_cte()}, {lineitem_typed_ctes()},
every AS (
  SELECT 'orders' AS table_name, rejection_reason, error_type, filename FROM inv WHERE line_rejected
  UNION ALL SELECT 'lineitem', CASE WHEN reject THEN 'REJECT' ELSE 'ICT_DRIVEN' END, regexp_extract(error_codes, '^[^:]*:([^;]*)', 1),
    _file_name FROM lt WHERE line_rejected)
SELECT table_name, rejection_reason, error_type,
  CAST(grouping(table_name) + grouping(rejection_reason) + grouping(error_type) AS INTEGER) AS level,
  count(*) AS lines, count(DISTINCT (table_name, filename)) AS files
FROM every GROUP BY ROLLUP (table_name, rejection_reason, error_type)"""


@oracle("stream_staging_stats")
def _():
    return "SELECT 'events_staging' AS table_name, count(*) AS reported_rows, 'SUCCESS' AS status FROM events"
