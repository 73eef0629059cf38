"""DuckDB SQL for every ``q_*`` key (the correctness oracle).

The SQL restates each operator the way the warehouse scripts state it —
UPDATE-then-INSERT for Type 1, the three sequential steps with EXISTS / NOT
EXISTS for Type 2, ROW_NUMBER() for keys — so it checks the Spark
formulations (full outer join, windowed Type-2 merge, distributed keys)
independently.  Tables ``region nation customer part orders lineitem`` are
views over the same parquet files.

Named CTEs are kept in one registry with their dependencies; each query pulls
in only the CTEs it needs, in dependency order.
"""

from __future__ import annotations

from sparkmart.plans import scenarios as S
from sparkmart.plans.build import REPRICE_FACTOR, REPRICED_PRODUCTS, RENAMED_FACILITY
from sparkmart.plans.queries import CALENDAR_YEARS, SLICER_COUNTRIES, SLICER_FACILITIES, SLICER_FROM, SLICER_REGIONS, SLICER_TO
from sparkmart.sources.bindings import LINE_ORDER

NOW = f"TIMESTAMP '{S.NOW.isoformat(sep=' ')}'"
EARLIER = f"TIMESTAMP '{S.EARLIER.isoformat(sep=' ')}'"
AS_OF = f"DATE '{S.AS_OF.isoformat()}'"
SCD2_START = f"DATE '{S.SCD2_START.isoformat()}'"
CLOSED_END = f"DATE '{S.CLOSED_END.isoformat()}'"
SYNCED_UNTIL = f"DATE '{S.SYNCED_UNTIL.isoformat()}'"
EPOCH = "TIMESTAMP '1970-01-01 00:00:00'"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _in(values) -> str:
    return ", ".join(_q(v) if isinstance(v, str) else str(v) for v in values)


CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, sql: str, *deps: str) -> None:
    CTES[name] = (sql, deps)


def with_clause(*names: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    # Materialised: the plan of a long chain doesn't hang on how often a step is used.
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED (\n{CTES[n][0]}\n)" for n in order)


def query(body: str, *names: str) -> str:
    return with_clause(*names) + "\n" + body


# --- bindings (test data → source model) ----------------------------------------
cte("src_region", "SELECT CAST(r_regionkey AS BIGINT) AS region_id, r_name AS region_name FROM region")
cte(
    "src_country",
    "SELECT CAST(n_nationkey AS BIGINT) AS country_id, n_name AS country_name, "
    "CAST(n_regionkey AS BIGINT) AS region_id FROM nation",
)
cte(
    "src_facility",
    "SELECT CAST(c_custkey AS BIGINT) AS facility_id, c_name AS facility_name, c_mktsegment AS facility_type, "
    "CAST(c_nationkey AS BIGINT) AS country_id FROM customer",
)
cte(
    "src_category",
    "SELECT CAST(MIN(p_partkey) AS BIGINT) AS category_id, p_type AS category_name FROM part GROUP BY p_type",
)
cte(
    "src_product",
    "SELECT CAST(p.p_partkey AS BIGINT) AS product_id, p.p_name AS product_name, c.category_id, "
    "CAST(p.p_retailprice AS DECIMAL(10,2)) AS unit_price, TRUE AS is_active "
    "FROM part p LEFT JOIN src_category c ON p.p_type = c.category_name",
    "src_category",
)
cte(
    "src_order",
    "SELECT CAST(o_orderkey AS BIGINT) AS order_id, CAST(o_custkey AS BIGINT) AS facility_id, "
    "CAST(o_orderdate AS DATE) AS order_date, CAST(o_totalprice AS DECIMAL(12,2)) AS total_amount FROM orders",
)
_LINE_COLS = (
    "CAST(l.l_orderkey AS BIGINT) AS order_id, CAST(l.l_linenumber AS BIGINT) AS line_number, "
    "CAST(l.l_partkey AS BIGINT) AS product_id, CAST(l.l_quantity AS INTEGER) AS quantity, "
    "COALESCE(CAST(p.p_retailprice AS DECIMAL(10,2)), CAST(l.l_extendedprice / NULLIF(l.l_quantity, 0) AS DECIMAL(10,2))) "
    "AS unit_price_sold, CAST(l.l_extendedprice AS DECIMAL(12,2)) AS line_total"
)
cte(
    "src_line",
    f"SELECT ROW_NUMBER() OVER (ORDER BY {', '.join('l.' + c for c in LINE_ORDER)}) AS order_line_id, {_LINE_COLS} "
    "FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey",
)
cte("src_line_unkeyed", f"SELECT {_LINE_COLS} FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey")

# --- staging extracts (E1–E3) ------------------------------------------------------
cte(
    "stg_facility",
    "SELECT f.facility_id, f.facility_name, f.facility_type, c.country_name, r.region_name, "
    f"{NOW} AS source_load_date "
    "FROM src_facility f JOIN src_country c ON f.country_id = c.country_id "
    "JOIN src_region r ON c.region_id = r.region_id",
    "src_facility",
    "src_country",
    "src_region",
)
cte(
    "stg_product",
    "SELECT p.product_id, p.product_name, c.category_name, p.unit_price, p.is_active, "
    f"{NOW} AS source_load_date "
    "FROM src_product p JOIN src_category c ON p.category_id = c.category_id",
    "src_product",
    "src_category",
)
for _name, _lines, _id in (("stg_order", "src_line", "l.order_line_id, "), ("stg_order_unkeyed", "src_line_unkeyed", "")):
    cte(
        _name,
        f"SELECT {_id}o.order_id, o.order_date, o.facility_id, l.product_id, l.quantity, l.unit_price_sold, "
        f"l.line_total, {NOW} AS source_load_date "
        f"FROM {_lines} l JOIN src_order o ON l.order_id = o.order_id",
        _lines,
        "src_order",
    )

# --- calendar (D3) -----------------------------------------------------------------
cte("years", "SELECT MIN(year(order_date)) AS y0, MAX(year(order_date)) AS y1 FROM src_order", "src_order")


def calendar_sql(stamp: str, first_day_of_week: int = 7) -> str:
    dow = f"(((dayofweek(d) - {first_day_of_week}) % 7 + 7) % 7 + 1)"
    return (
        "SELECT CAST(datediff('day', make_date(y0, 1, 1), d) + 1 AS BIGINT) AS date_key, d AS full_date, "
        "CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter, "
        "CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name, "
        f"CAST(day(d) AS INTEGER) AS day_of_month, CAST({dow} AS INTEGER) AS day_of_week, "
        f"{dow} IN (6, 7) AS is_weekend, {stamp} AS last_updated "
        "FROM (SELECT y0, CAST(unnest(generate_series(CAST(make_date(y0, 1, 1) AS TIMESTAMP), "
        "CAST(make_date(y1, 12, 31) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d FROM years)"
    )


cte("dim_date", calendar_sql(NOW), "years")
cte("dim_date_before", calendar_sql(EARLIER), "years")

# --- unknown members (D5) ------------------------------------------------------------
_UNK_FAC = (
    "SELECT CAST(-1 AS BIGINT) AS facility_key, CAST(-1 AS BIGINT) AS facility_id_source, "
    "'Unknown Facility' AS facility_name, 'Unknown' AS facility_type, CAST(NULL AS VARCHAR) AS country_name, "
    "CAST(NULL AS VARCHAR) AS region_name, {ts} AS last_updated"
)
_UNK_PROD = (
    "SELECT CAST(-1 AS BIGINT) AS product_key, CAST(-1 AS BIGINT) AS product_id_source, "
    "'Unknown Product' AS product_name, CAST(NULL AS VARCHAR) AS category_name, "
    "CAST(0 AS DECIMAL(10,2)) AS unit_price, TRUE AS is_active, DATE '2000-01-01' AS row_start_date, "
    "CAST(NULL AS DATE) AS row_end_date, TRUE AS is_current, {ts} AS last_updated"
)
_FAC_COLS = "facility_key, facility_id_source, facility_name, facility_type, country_name, region_name, last_updated"
_PROD_COLS = (
    "product_key, product_id_source, product_name, category_name, unit_price, is_active, "
    "row_start_date, row_end_date, is_current, last_updated"
)


def scd1_sql(out: str, dim: str, stg: str, now: str = NOW) -> None:
    """Type 1 as the warehouse procedure states it: UPDATE … FROM, then INSERT new ids."""
    diff = " OR ".join(f"d.{a} IS DISTINCT FROM s.{a}" for a in ("facility_name", "facility_type", "country_name", "region_name"))
    cte(
        f"{out}_upd",
        "SELECT d.facility_key, d.facility_id_source, s.facility_name, s.facility_type, s.country_name, "
        f"s.region_name, CASE WHEN {diff} THEN {now} ELSE d.last_updated END AS last_updated "
        f"FROM {dim} d JOIN {stg} s ON d.facility_id_source = s.facility_id",
        dim,
        stg,
    )
    cte(
        f"{out}_keep",
        f"SELECT {_FAC_COLS} FROM {dim} d WHERE NOT EXISTS "
        f"(SELECT 1 FROM {stg} s WHERE s.facility_id = d.facility_id_source)",
        dim,
        stg,
    )
    cte(
        f"{out}_k0",
        f"SELECT CASE WHEN MAX(facility_key) IS NULL OR MAX(facility_key) < 1 THEN 1 ELSE MAX(facility_key) + 1 END "
        f"AS k0 FROM {dim}",
        dim,
    )
    cte(
        f"{out}_ins",
        "SELECT k0 - 1 + ROW_NUMBER() OVER (ORDER BY s.facility_id) AS facility_key, s.facility_id AS "
        "facility_id_source, s.facility_name, s.facility_type, s.country_name, s.region_name, "
        f"{now} AS last_updated FROM {stg} s LEFT JOIN {dim} d ON d.facility_id_source = s.facility_id "
        f"CROSS JOIN {out}_k0 WHERE d.facility_id_source IS NULL",
        dim,
        stg,
        f"{out}_k0",
    )
    cte(
        out,
        f"SELECT {_FAC_COLS} FROM {out}_upd UNION ALL SELECT {_FAC_COLS} FROM {out}_keep "
        f"UNION ALL SELECT {_FAC_COLS} FROM {out}_ins",
        f"{out}_upd",
        f"{out}_keep",
        f"{out}_ins",
    )


def scd2_sql(out: str, dim: str, stg: str, as_of: str, now: str, initial_start: str) -> None:
    """Type 2 as three sequential steps: expire, re-version, insert brand new."""
    cte(
        f"{out}_exp",
        f"SELECT DISTINCT d.product_key FROM {dim} d JOIN {stg} s ON d.product_id_source = s.product_id "
        "WHERE d.is_current AND d.unit_price <> s.unit_price",
        dim,
        stg,
    )
    cte(
        f"{out}_s1",
        "SELECT d.product_key, d.product_id_source, d.product_name, d.category_name, d.unit_price, d.is_active, "
        f"d.row_start_date, CASE WHEN e.product_key IS NOT NULL THEN {as_of} ELSE d.row_end_date END AS row_end_date, "
        "CASE WHEN e.product_key IS NOT NULL THEN FALSE ELSE d.is_current END AS is_current, "
        f"CASE WHEN e.product_key IS NOT NULL THEN {now} ELSE d.last_updated END AS last_updated "
        f"FROM {dim} d LEFT JOIN {out}_exp e ON d.product_key = e.product_key",
        dim,
        f"{out}_exp",
    )
    cte(
        f"{out}_new",
        f"SELECT 2 AS step, s.*, {as_of} AS start_date FROM {stg} s "
        f"WHERE NOT EXISTS (SELECT 1 FROM {out}_s1 d WHERE d.product_id_source = s.product_id AND d.is_current) "
        f"AND EXISTS (SELECT 1 FROM {out}_s1 d WHERE d.product_id_source = s.product_id) "
        f"UNION ALL SELECT 3 AS step, s.*, {initial_start} AS start_date FROM {stg} s "
        f"WHERE NOT EXISTS (SELECT 1 FROM {out}_s1 d WHERE d.product_id_source = s.product_id)",
        stg,
        f"{out}_s1",
    )
    cte(
        f"{out}_k0",
        f"SELECT CASE WHEN MAX(product_key) IS NULL OR MAX(product_key) < 1 THEN 1 ELSE MAX(product_key) + 1 END "
        f"AS k0 FROM {dim}",
        dim,
    )
    cte(
        out,
        f"SELECT {_PROD_COLS} FROM {out}_s1 UNION ALL "
        "SELECT k0 - 1 + ROW_NUMBER() OVER (ORDER BY step, product_id) AS product_key, product_id AS product_id_source, "
        "product_name, category_name, unit_price, is_active, start_date AS row_start_date, "
        f"CAST(NULL AS DATE) AS row_end_date, TRUE AS is_current, {now} AS last_updated "
        f"FROM {out}_new CROSS JOIN {out}_k0",
        f"{out}_s1",
        f"{out}_new",
        f"{out}_k0",
    )


def fact_sql(out: str, stg: str, dim_fac: str, dim_prod: str, cal: str, stamp: str, keyed: bool) -> None:
    """D4 as the load procedure states it: three LEFT JOINs, COALESCE to -1."""
    key = "o.order_line_id AS order_line_key, " if keyed else ""
    cte(
        out,
        f"SELECT {key}d.date_key, COALESCE(f.facility_key, -1) AS facility_key, "
        "COALESCE(p.product_key, -1) AS product_key, o.order_id, o.quantity, o.unit_price_sold, o.line_total, "
        f"{stamp} AS last_updated FROM {stg} o "
        f"LEFT JOIN {dim_fac} f ON o.facility_id = f.facility_id_source "
        f"LEFT JOIN {dim_prod} p ON o.product_id = p.product_id_source AND o.order_date >= p.row_start_date "
        "AND (o.order_date < p.row_end_date OR p.row_end_date IS NULL) "
        f"LEFT JOIN {cal} d ON o.order_date = d.full_date",
        stg,
        dim_fac,
        dim_prod,
        cal,
    )


# --- canonical build (D6) ------------------------------------------------------------
cte("fac0", _UNK_FAC.format(ts=NOW))
cte("prod0", _UNK_PROD.format(ts=NOW))
cte("initial_start", "SELECT make_date(y0, 1, 1) AS d FROM years", "years")
scd1_sql("fac1", "fac0", "stg_facility")
scd2_sql("prod1", "prod0", "stg_product", AS_OF, NOW, "(SELECT d FROM initial_start)")
CTES["prod1_new"] = (CTES["prod1_new"][0], CTES["prod1_new"][1] + ("initial_start",))
_rid, _rname = RENAMED_FACILITY
cte(
    "stg_facility_edit",
    f"SELECT facility_id, CASE WHEN facility_id = {_rid} THEN {_q(_rname)} ELSE facility_name END AS facility_name, "
    "facility_type, country_name, region_name, source_load_date FROM stg_facility",
    "stg_facility",
)
cte(
    "stg_product_edit",
    "SELECT product_id, product_name, category_name, "
    f"CASE WHEN product_id IN ({_in(REPRICED_PRODUCTS)}) THEN CAST(unit_price * {REPRICE_FACTOR} AS DECIMAL(10,2)) "
    "ELSE unit_price END AS unit_price, is_active, source_load_date FROM stg_product",
    "stg_product",
)
scd2_sql("prod2", "prod1", "stg_product_edit", AS_OF, NOW, "(SELECT d FROM initial_start)")
CTES["prod2_new"] = (CTES["prod2_new"][0], CTES["prod2_new"][1] + ("initial_start",))
scd1_sql("fac2", "fac1", "stg_facility_edit")
fact_sql("fact_pipeline", "stg_order", "fac2", "prod2", "dim_date", NOW, keyed=True)
fact_sql("fact_first", "stg_order", "fac1", "prod1", "dim_date", NOW, keyed=True)
fact_sql("fact_report", "stg_order_unkeyed", "fac2", "prod2", "dim_date", NOW, keyed=False)
cte(
    "star",
    "SELECT f.date_key, f.facility_key, f.product_key, f.order_id, f.quantity, f.unit_price_sold, f.line_total, "
    "d.full_date, d.year, d.month, fa.facility_name, fa.country_name, fa.region_name, p.product_name, p.category_name "
    "FROM fact_report f JOIN dim_date d ON f.date_key = d.date_key "
    "JOIN fac2 fa ON f.facility_key = fa.facility_key JOIN prod2 p ON f.product_key = p.product_key",
    "fact_report",
    "dim_date",
    "fac2",
    "prod2",
)

# --- second load: orders before SYNCED_UNTIL, then all, with edited staging ----------
_LOAD_KEY = "ROW_NUMBER() OVER (ORDER BY order_id, product_id, quantity, line_total)"
cte("lines_1", f"SELECT {_LOAD_KEY} AS order_line_id, * FROM stg_order_unkeyed WHERE order_date < {SYNCED_UNTIL}", "stg_order_unkeyed")
cte(
    "lines_2",
    f"SELECT (SELECT COUNT(*) FROM lines_1) + {_LOAD_KEY} AS order_line_id, * FROM stg_order_unkeyed WHERE order_date >= {SYNCED_UNTIL}",
    "stg_order_unkeyed",
    "lines_1",
)
cte("start_1", f"SELECT make_date(MIN(year(order_date)), 1, 1) AS d FROM src_order WHERE order_date < {SYNCED_UNTIL}", "src_order")
scd2_sql("prod_first", "prod0", "stg_product", AS_OF, NOW, "(SELECT d FROM start_1)")
CTES["prod_first_new"] = (CTES["prod_first_new"][0], CTES["prod_first_new"][1] + ("start_1",))
scd2_sql("prod_load", "prod_first", "stg_product_edit", AS_OF, NOW, "(SELECT d FROM start_1)")
CTES["prod_load_new"] = (CTES["prod_load_new"][0], CTES["prod_load_new"][1] + ("start_1",))
fact_sql("load_1", "lines_1", "fac1", "prod_first", "dim_date", NOW, keyed=True)
fact_sql("load_2", "lines_2", "fac2", "prod_load", "dim_date", NOW, keyed=True)

# --- Type 1 scenario ------------------------------------------------------------------
cte(
    "scd1_before",
    f"SELECT facility_id + 1 AS facility_key, facility_id AS facility_id_source, "
    f"facility_name, facility_type, country_name, region_name, {EARLIER} AS last_updated FROM stg_facility "
    f"WHERE facility_type <> {_q(S.FAC_NEW_SEGMENT)} "
    f"UNION ALL {_UNK_FAC.format(ts=EARLIER)}",
    "stg_facility",
)
cte(
    "fac_edited",
    "SELECT facility_id, "
    f"CASE WHEN facility_type = {_q(S.FAC_RENAMED_TYPE)} THEN 'Renamed ' || facility_name ELSE facility_name END "
    "AS facility_name, facility_type, "
    f"CASE WHEN region_name = {_q(S.FAC_NO_COUNTRY_REGION)} THEN NULL ELSE country_name END AS country_name, "
    f"CASE WHEN region_name = {_q(S.FAC_NO_COUNTRY_REGION)} THEN NULL ELSE region_name END AS region_name, "
    "source_load_date FROM stg_facility",
    "stg_facility",
)
cte("scd1_stg", f"SELECT * FROM fac_edited WHERE facility_type <> {_q(S.FAC_ABSENT_SEGMENT)}", "fac_edited")
scd1_sql("scd1_after", "scd1_before", "scd1_stg")

# --- Type 2 scenario ------------------------------------------------------------------
_closed = f"category_name = {_q(S.PROD_CLOSED_CATEGORY)}"
cte(
    "scd2_before",
    "SELECT product_id + 1 AS product_key, product_id AS product_id_source, "
    f"product_name, category_name, unit_price, is_active, {SCD2_START} AS row_start_date, "
    f"CASE WHEN {_closed} THEN {CLOSED_END} ELSE CAST(NULL AS DATE) END AS row_end_date, "
    f"NOT ({_closed}) AS is_current, {EARLIER} AS last_updated FROM stg_product "
    f"WHERE category_name <> {_q(S.PROD_NEW_CATEGORY)} "
    f"UNION ALL {_UNK_PROD.format(ts=EARLIER)}",
    "stg_product",
)
cte(
    "scd2_stg",
    "SELECT product_id, "
    f"CASE WHEN suffix(product_name, {_q(S.PROD_RENAMED_SUFFIX)}) THEN product_name || ' v2' ELSE product_name END "
    "AS product_name, category_name, "
    f"CASE WHEN suffix(product_name, {_q(S.PROD_REPRICED_SUFFIX)}) "
    f"THEN CAST(unit_price * {S.PROD_REPRICE_FACTOR} AS DECIMAL(10,2)) "
    f"WHEN suffix(product_name, {_q(S.PROD_NULL_PRICE_SUFFIX)}) THEN CAST(NULL AS DECIMAL(10,2)) "
    "ELSE unit_price END AS unit_price, is_active, source_load_date FROM stg_product "
    f"WHERE category_name <> {_q(S.PROD_ABSENT_CATEGORY)}",
    "stg_product",
)
scd2_sql("scd2_after", "scd2_before", "scd2_stg", AS_OF, NOW, SCD2_START)
cte("fac_loaded", f"SELECT * FROM scd1_after WHERE facility_type <> {_q(S.FAC_NEVER_SEGMENT)}", "scd1_after")
cte("prod_loaded", f"SELECT * FROM scd2_after WHERE category_name IS DISTINCT FROM {_q(S.PROD_NEVER_CATEGORY)}", "scd2_after")
fact_sql("fact_scenario", "stg_order", "fac_loaded", "prod_loaded", "dim_date", NOW, keyed=True)

# --- incremental scenario -------------------------------------------------------------------
fact_sql(
    "sync_source_fact",
    "stg_order",
    "fac_loaded",
    "prod_loaded",
    "dim_date",
    f"CASE WHEN o.quantity >= {S.CORRECTED_MIN_QTY} THEN {NOW} ELSE CAST(o.order_date AS TIMESTAMP) END",
    keyed=True,
)
cte(
    "stg_order_stale",
    f"SELECT order_line_id, order_id, order_date, facility_id, product_id, "
    f"CAST(CASE WHEN quantity >= {S.CORRECTED_MIN_QTY} THEN quantity - 1 ELSE quantity END AS INTEGER) AS quantity, "
    f"unit_price_sold, line_total, source_load_date FROM stg_order WHERE order_date < {SYNCED_UNTIL}",
    "stg_order",
)
fact_sql(
    "sync_target_fact",
    "stg_order_stale",
    "fac_loaded",
    "prod_loaded",
    "dim_date",
    "CAST(o.order_date AS TIMESTAMP)",
    keyed=True,
)
_FACT_COLS = (
    "order_line_key, date_key, facility_key, product_key, order_id, quantity, unit_price_sold, line_total, last_updated"
)
_DATE_COLS = (
    "date_key, full_date, year, quarter, month, month_name, day_of_month, day_of_week, is_weekend, last_updated"
)
# (table, source CTE, target CTE, key, columns, ignores key -1)
SYNC_TABLES = (
    ("dim_date", "dim_date", "dim_date_before", "date_key", _DATE_COLS, False),
    ("dim_facility", "scd1_after", "scd1_before", "facility_key", _FAC_COLS, True),
    ("dim_product", "scd2_after", "scd2_before", "product_key", _PROD_COLS, True),
    ("fact_orders", "sync_source_fact", "sync_target_fact", "order_line_key", _FACT_COLS, False),
)
for _t, _src, _tgt, _key, _cols, _unk in SYNC_TABLES:
    _where = f" WHERE {_key} <> -1" if _unk else ""
    cte(f"wm_{_t}", f"SELECT COALESCE(MAX(last_updated), {EPOCH}) AS watermark FROM {_tgt}{_where}", _tgt)
    cte(f"delta_{_t}", f"SELECT {_cols} FROM {_src} WHERE last_updated > (SELECT watermark FROM wm_{_t})", _src, f"wm_{_t}")
    cte(
        f"upserted_{_t}",
        f"SELECT {_cols} FROM {_tgt} t WHERE NOT EXISTS (SELECT 1 FROM delta_{_t} x WHERE x.{_key} = t.{_key}) "
        f"UNION ALL SELECT {_cols} FROM delta_{_t}",
        _tgt,
        f"delta_{_t}",
    )


# --- a synced copy that drifted without a new stamp ---------------------------------------------
cte(
    "drifted_fact_orders",
    f"SELECT {_FACT_COLS.replace('quantity', 'CAST(CASE WHEN date_key % 100 = 1 AND quantity = 7 THEN quantity + 1 ELSE quantity END AS INTEGER) AS quantity')} "
    "FROM upserted_fact_orders WHERE NOT (date_key % 100 = 2 AND quantity = 11)",
    "upserted_fact_orders",
)


def _difference_sql(source: str, target: str, key: str, cols: str) -> str:
    """(key, status) of the rows in which two copies differ, by comparing all of them."""
    names = [c.strip() for c in cols.split(",")]
    unequal = " OR ".join(f"s.{c} IS DISTINCT FROM t.{c}" for c in names)
    return (
        f"SELECT COALESCE(s.{key}, t.{key}) AS {key}, CASE WHEN t.{key} IS NULL THEN 'missing' WHEN s.{key} IS NULL THEN 'extra' "
        f"ELSE 'changed' END AS status FROM {source} s FULL JOIN {target} t ON s.{key} = t.{key} WHERE {unequal}"
    )


_MONTHLY = (
    "SELECT year, month, month_name, CAST(revenue AS DECIMAL(22,2)) AS revenue, order_count, units_sold, "
    "CAST(LAG(revenue) OVER (ORDER BY year, month) AS DECIMAL(22,2)) AS prev_month_revenue, "
    "CAST(ROUND((revenue - LAG(revenue) OVER (ORDER BY year, month)) "
    "/ NULLIF(LAG(revenue) OVER (ORDER BY year, month), 0) * 100, 2) AS DECIMAL(18,2)) AS mom_growth_pct "
    "FROM (SELECT d.year, d.month, d.month_name, SUM(f.line_total) AS revenue, "
    "CAST(COUNT(DISTINCT f.order_id) AS BIGINT) AS order_count, CAST(SUM(f.quantity) AS BIGINT) AS units_sold "
    "FROM fact_report f JOIN dim_date d ON f.date_key = d.date_key GROUP BY d.year, d.month, d.month_name)"
)


def _rank_sql(fn: str, fact: str = "fact_report", products: str = "prod2") -> str:
    return query(
        "SELECT p.product_name, p.category_name, CAST(SUM(f.line_total) AS DECIMAL(22,2)) AS total_revenue, "
        "CAST(SUM(f.quantity) AS BIGINT) AS total_units, CAST(COUNT(DISTINCT f.order_id) AS BIGINT) AS order_count, "
        f"CAST({fn}() OVER (ORDER BY SUM(f.line_total) DESC NULLS FIRST) AS BIGINT) AS revenue_rank "
        f"FROM {fact} f JOIN {products} p ON f.product_key = p.product_key WHERE p.product_key <> -1 "
        "GROUP BY p.product_name, p.category_name",
        fact,
        products,
    )


def _domain(table: str, cte_name: str, lengths: dict, decimals: dict) -> list[str]:
    out = []
    for c, n in lengths.items():
        out.append(
            f"SELECT {_q(table)} AS table_name, {_q(c)} AS column_name, {_q(f'length<={n}')} AS rule, "
            f"CAST(COALESCE(SUM(CASE WHEN length({c}) > {n} THEN 1 ELSE 0 END), 0) AS BIGINT) AS violations FROM {cte_name}"
        )
    for c, (p, s) in decimals.items():
        out.append(
            f"SELECT {_q(table)} AS table_name, {_q(c)} AS column_name, {_q(f'numeric({p},{s})')} AS rule, "
            f"CAST(COALESCE(SUM(CASE WHEN {c} IS NOT NULL AND TRY_CAST({c} AS DECIMAL({p},{s})) IS NULL THEN 1 ELSE 0 END), 0) "
            f"AS BIGINT) AS violations FROM {cte_name}"
        )
    return out


def oracle_sql() -> dict[str, str]:
    from sparkmart import schemas

    fac_len = schemas.DIM_FACILITY_SPEC.lengths
    prod_len = schemas.DIM_PRODUCT_SPEC.lengths
    prod_dec = schemas.DIM_PRODUCT_SPEC.decimals
    cte("raw_line_total", "SELECT l_extendedprice AS line_total FROM lineitem")
    cte("raw_lines", "SELECT 1 AS one FROM lineitem")
    return _with_reports({
        "q_incremental_scan": query("SELECT * FROM delta_fact_orders", "delta_fact_orders"),
        "q_upsert_fact": query("SELECT * FROM upserted_fact_orders", "upserted_fact_orders"),
        "q_upsert_facility": query("SELECT * FROM upserted_dim_facility", "upserted_dim_facility"),
        "q_watermarks": query(
            " UNION ALL ".join(f"SELECT '{t}' AS table_name, watermark FROM wm_{t}" for t, *_ in SYNC_TABLES),
            *[f"wm_{t}" for t, *_ in SYNC_TABLES],
        ),
        "q_sync_report": query(
            " UNION ALL ".join(
                f"SELECT {i + 1} AS sync_order, '{t}' AS table_name, (SELECT watermark FROM wm_{t}) AS watermark, "
                f"CAST(COUNT(*) AS BIGINT) AS rows_synced FROM delta_{t}"
                for i, (t, *_) in enumerate(SYNC_TABLES)
            ),
            *[f"delta_{t}" for t, *_ in SYNC_TABLES],
        ),
        "q_extract_facility": query("SELECT * FROM stg_facility", "stg_facility"),
        "q_extract_product": query("SELECT * FROM stg_product", "stg_product"),
        "q_extract_order": query("SELECT * FROM stg_order", "stg_order"),
        "q_staging_price_update": query("SELECT * FROM stg_product_edit", "stg_product_edit"),
        "q_surrogate_keys": query(
            "SELECT order_line_id, order_id, line_number, product_id FROM src_line", "src_line"
        ),
        "q_dim_date": query("SELECT * FROM dim_date", "dim_date"),
        "q_scd1_facility": query("SELECT * FROM scd1_after", "scd1_after"),
        "q_scd2_product": query("SELECT * FROM scd2_after", "scd2_after"),
        "q_asof_product_join": query(
            "SELECT o.order_id, o.order_date, o.product_id, o.quantity, o.line_total, "
            "COALESCE(p.product_key, -1) AS product_key FROM stg_order_unkeyed o "
            "LEFT JOIN prod_loaded p ON o.product_id = p.product_id_source AND o.order_date >= p.row_start_date "
            "AND (o.order_date < p.row_end_date OR p.row_end_date IS NULL)",
            "stg_order_unkeyed",
            "prod_loaded",
        ),
        "q_fact_unknown_members": query("SELECT * FROM fact_scenario", "fact_scenario"),
        "q_fact_load": query("SELECT * FROM fact_first", "fact_first"),
        "q_pipeline": query("SELECT * FROM fact_pipeline", "fact_pipeline"),
        "q_monthly_revenue": query(_MONTHLY, "fact_report", "dim_date"),
        "q_product_revenue_rank": _rank_sql("RANK"),
        "q_product_revenue_dense_rank": _rank_sql("DENSE_RANK"),
        "q_slicer_sales": query(
            "SELECT country_name, CAST(SUM(line_total) AS DECIMAL(22,2)) AS revenue, "
            "CAST(COUNT(DISTINCT order_id) AS BIGINT) AS order_count, CAST(SUM(quantity) AS BIGINT) AS units_sold "
            f"FROM star WHERE full_date >= DATE '{SLICER_FROM}' AND full_date <= DATE '{SLICER_TO}' "
            f"AND region_name IN ({_in(SLICER_REGIONS)}) GROUP BY country_name",
            "star",
        ),
        "q_kpi_cards": query(
            "SELECT CAST(SUM(line_total) AS DECIMAL(22,2)) AS total_sales, "
            "CAST(COUNT(DISTINCT order_id) AS BIGINT) AS total_orders FROM star",
            "star",
        ),
        "q_revenue_daily": query(
            "SELECT full_date, CAST(SUM(line_total) AS DECIMAL(22,2)) AS revenue FROM star GROUP BY full_date", "star"
        ),
        "q_sales_by_country": query(
            "SELECT country_name, CAST(SUM(line_total) AS DECIMAL(22,2)) AS revenue, "
            "CAST(COUNT(DISTINCT order_id) AS BIGINT) AS order_count, CAST(SUM(quantity) AS BIGINT) AS units_sold "
            "FROM star GROUP BY country_name",
            "star",
        ),
        "q_revenue_by_category": query(
            "SELECT category_name, CAST(SUM(line_total) AS DECIMAL(22,2)) AS revenue, "
            "ROUND(CAST(SUM(line_total) AS DOUBLE) / NULLIF(CAST((SELECT SUM(line_total) FROM star) AS DOUBLE), 0), 6) "
            "AS revenue_share FROM star GROUP BY category_name",
            "star",
        ),
        "q_top_products": query(
            "SELECT product_name, category_name, CAST(SUM(line_total) AS DECIMAL(22,2)) AS total_revenue FROM star "
            "WHERE product_key <> -1 GROUP BY product_name, category_name "
            "ORDER BY total_revenue DESC NULLS FIRST, product_name, category_name LIMIT 5",
            "star",
        ),
        "q_units_vs_price": query(
            "SELECT product_name, category_name, CAST(SUM(quantity) AS BIGINT) AS units_sold, "
            "ROUND(CAST(SUM(unit_price_sold) AS DOUBLE) / COUNT(unit_price_sold), 6) AS avg_unit_price FROM star WHERE product_key <> -1 "
            "GROUP BY product_name, category_name",
            "star",
        ),
        "q_row_counts": query(
            " UNION ALL ".join(
                f"SELECT '{n}' AS table_name, CAST(COUNT(*) AS BIGINT) AS row_count FROM {c}"
                for n, c in (
                    ("region", "src_region"),
                    ("country", "src_country"),
                    ("product_category", "src_category"),
                    ("product", "src_product"),
                    ("facility", "src_facility"),
                    ("purchase_order", "src_order"),
                    ("order_line", "raw_lines"),
                )
            ),
            "src_region",
            "src_country",
            "src_category",
            "src_product",
            "src_facility",
            "src_order",
            "raw_lines",
        ),
        "q_dq_not_null": query(
            "SELECT *, concat_ws(','," + ", ".join(
                f"CASE WHEN {c} IS NULL THEN '{c}' END"
                for c in ("facility_id", "facility_name", "facility_type", "country_name", "region_name")
            ) + ") AS null_columns FROM fac_edited "
            "WHERE facility_id IS NULL OR facility_name IS NULL OR facility_type IS NULL OR country_name IS NULL "
            "OR region_name IS NULL",
            "fac_edited",
        ),
        "q_dq_unique": query(
            "SELECT order_id, line_number, CAST(COUNT(*) AS BIGINT) AS duplicate_count FROM src_line_unkeyed "
            "GROUP BY order_id, line_number HAVING COUNT(*) > 1",
            "src_line_unkeyed",
        ),
        "q_dq_foreign_key": query(
            "SELECT o.order_id, o.order_date, o.facility_id, o.product_id, o.line_total FROM stg_order_unkeyed o "
            "WHERE o.facility_id IS NOT NULL AND NOT EXISTS "
            "(SELECT 1 FROM fac_loaded f WHERE f.facility_id_source = o.facility_id)",
            "stg_order_unkeyed",
            "fac_loaded",
        ),
        "q_dq_domain": query(
            " UNION ALL ".join(
                _domain("raw_facility", "stg_facility", fac_len, {})
                + _domain("raw_product", "stg_product", prod_len, prod_dec)
                + _domain("raw_order", "raw_line_total", {}, {"line_total": (12, 2)})
            ),
            "stg_facility",
            "stg_product",
            "raw_line_total",
        ),
    })


def _with_reports(sql: dict[str, str]) -> dict[str, str]:
    """The ordered reports, the stored forms and the loads, from the statements they share."""
    sql["q_sync_stored"] = sql["q_log_fact"] = sql["q_log_compacted"] = sql["q_log_stream"] = sql["q_upsert_fact"]
    sql["q_asof_merge_join"] = sql["q_asof_product_join"]
    sql["q_verify_rows"] = query(
        _difference_sql("sync_source_fact", "drifted_fact_orders", "order_line_key", _FACT_COLS), "sync_source_fact", "drifted_fact_orders"
    )
    copies = {t: "drifted_fact_orders" if t == "fact_orders" else f"upserted_{t}" for t, *_ in SYNC_TABLES}
    counts = ", ".join(f"CAST(COUNT(*) FILTER (WHERE status = '{x}') AS BIGINT) AS {x}" for x in ("missing", "extra", "changed"))
    sql["q_verify_report"] = query(
        " UNION ALL ".join(
            f"SELECT {_q(t)} AS table_name, {counts} FROM ({_difference_sql(src, copies[t], key, cols)})" for t, src, _, key, cols, _ in SYNC_TABLES
        ),
        *[src for _, src, *_ in SYNC_TABLES],
        *copies.values(),
    )
    sql["q_log_commit"] = query(
        " UNION ALL ".join(f"SELECT {_q(t)} AS table_name, CAST(COUNT(*) AS BIGINT) AS row_count FROM upserted_{t}" for t, *_ in SYNC_TABLES),
        *[f"upserted_{t}" for t, *_ in SYNC_TABLES],
    )
    sql["q_maintained_monthly_revenue"] = query(
        _MONTHLY.replace("fact_report", "upserted_fact_orders").replace("dim_date", "upserted_dim_date"), "upserted_fact_orders", "upserted_dim_date"
    )
    sql["q_maintained_product_rank"] = _rank_sql("RANK", "upserted_fact_orders", "upserted_dim_product")
    sql["q_merged_order_counts"] = query(
        "SELECT d.year, CAST(CEIL(d.month / 3.0) AS INTEGER) AS quarter, CAST(COUNT(DISTINCT f.order_id) AS BIGINT) AS order_count "
        "FROM upserted_fact_orders f JOIN upserted_dim_date d ON f.date_key = d.date_key GROUP BY 1, 2",
        "upserted_fact_orders",
        "upserted_dim_date",
    )
    sql["q_monthly_report"] = sql["q_monthly_revenue"] + " ORDER BY year, month"
    sql["q_rank_report"] = sql["q_product_revenue_rank"] + " ORDER BY revenue_rank, product_name, category_name"
    sql["q_sql_views"] = query(
        "SELECT d.year, d.month, p.category_name, m.revenue AS month_revenue, r.n_products, r.best_rank, "
        "CAST(SUM(f.line_total) AS DECIMAL(22,2)) AS revenue, CAST(COUNT(*) AS BIGINT) AS line_count "
        "FROM fact_report f JOIN dim_date d ON f.date_key = d.date_key JOIN prod2 p ON f.product_key = p.product_key "
        f"JOIN fac2 c ON f.facility_key = c.facility_key JOIN ({_MONTHLY}) m ON m.year = d.year AND m.month = d.month "
        "JOIN (SELECT category_name, CAST(COUNT(*) AS BIGINT) AS n_products, CAST(MIN(revenue_rank) AS BIGINT) AS best_rank "
        "FROM (SELECT p.product_name, p.category_name, RANK() OVER (ORDER BY SUM(f.line_total) DESC NULLS FIRST) AS revenue_rank "
        "FROM fact_report f JOIN prod2 p ON f.product_key = p.product_key WHERE p.product_key <> -1 GROUP BY p.product_name, p.category_name) "
        "GROUP BY category_name) r ON r.category_name = p.category_name GROUP BY ALL",
        "fact_report",
        "dim_date",
        "prod2",
        "fac2",
    )
    sql["q_second_load"] = query("SELECT * FROM load_1 UNION ALL SELECT * FROM load_2", "load_1", "load_2")
    sql["q_second_load_product"] = query("SELECT * FROM prod_load", "prod_load")
    tables = (
        ("raw_facility", "stg_facility"), ("raw_product", "stg_product"), ("raw_order", "stg_order_unkeyed"), ("dim_date", "dim_date"),
        ("dim_facility", "fac2"), ("dim_product", "prod2"), ("fact_orders", "fact_report"),
    )
    sql["q_snapshot_rebuild"] = query(
        " UNION ALL ".join(
            f"SELECT {_q(t)} AS table_name, {v} AS version, CAST(COUNT(*) AS BIGINT) AS row_count FROM {c}" for t, c in tables for v in (0, 1)
        ),
        *[c for _, c in tables],
    )
    y0, y1 = CALENDAR_YEARS
    days = calendar_sql(NOW).replace("FROM years", f"FROM (SELECT {y0} AS y0, {y1} AS y1)")
    sql["q_calendar_years"] = query(
        f"SELECT c.*, coalesce(o.n, 0) AS n_orders FROM ({days}) c LEFT JOIN "
        "(SELECT order_date, COUNT(*) AS n FROM src_order GROUP BY order_date) o ON c.full_date = o.order_date",
        "src_order",
    )
    share = (
        "SELECT category_name, CAST(SUM(line_total) AS DECIMAL(22,2)) AS revenue, "
        "ROUND(CAST(SUM(line_total) AS DOUBLE) / NULLIF(CAST(SUM(SUM(line_total)) OVER () AS DOUBLE), 0), 6) AS revenue_share, "
        "{slicer} AS slicer FROM star WHERE {column} IN ({values}) GROUP BY category_name"
    )
    sql["q_slicer_facility"] = query(
        share.format(slicer="'country'", column="country_name", values=_in(SLICER_COUNTRIES))
        + " UNION ALL "
        + share.format(slicer="'facility'", column="facility_name", values=_in(SLICER_FACILITIES)),
        "star",
    )
    return sql
