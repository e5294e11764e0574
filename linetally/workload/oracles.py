"""The same queries in SQL, over the same test tables.

Every statement is built from named parts (common table expressions) that
follow the adapter's rules, then the engine's.
"""

from __future__ import annotations

from linetally.fixed_values import REVENUE_TOLERANCE
from linetally.workload.queries import DUPLICATE_LIMIT, FRESH_AS_OF, HOLD_BACK_DAYS, SMALL_COUNTRY
from linetally.workload.warehouse import SALT

# ------------------------------------------------------------------------ parts

_PARTS: dict[str, tuple[tuple[str, ...], str]] = {}


def part(name: str, needs: str, sql: str) -> None:
    _PARTS[name] = (tuple(needs.split()), sql)


def sql(needs: str, body: str) -> str:
    """A statement with the parts it needs, in dependency order."""
    order: list[str] = []

    def add(name: str) -> None:
        for dep in _PARTS[name][0]:
            add(dep)
        if name not in order:
            order.append(name)

    for name in needs.split():
        add(name)
    return "WITH " + ",\n".join(f"{n} AS ({_PARTS[n][1]})" for n in order) + "\n" + body


ORDER_FIELDS = (
    "invoice_no, stock_code, description, quantity, invoice_date, unit_price, customer_id, country, "
    "source_system, ingested_at"
)
PERIOD = "lpad(CAST({y} AS VARCHAR), 4, '0') || '-' || lpad(CAST({m} AS VARCHAR), 2, '0')"


def dec(x: str) -> str:
    return f"CAST({x} AS DECIMAL(18,4))"


def total(x: str) -> str:
    return f"CAST(sum({dec(x)}) AS DOUBLE)"


part(
    "lines",
    "",
    """
  SELECT CASE WHEN o_orderkey % 50 = 0 THEN 'C' ELSE '' END || o_orderkey AS invoice_no,
         CAST(l_partkey AS VARCHAR) AS stock_code,
         CASE WHEN l_partkey % 97 = 0 THEN NULL
              WHEN l_linenumber % 5 = 0 THEN ' ' || upper(p_name) ELSE p_name END AS description,
         CAST(CASE WHEN o_orderkey % 50 = 0 OR l_orderkey % 211 = 0 THEN -l_quantity ELSE l_quantity END AS INTEGER)
           AS quantity,
         o_orderdate AS invoice_date,
         CASE WHEN (l_orderkey + l_linenumber) % 331 = 0 THEN 0.0::DOUBLE
              ELSE l_extendedprice / l_quantity END AS unit_price,
         CASE WHEN o_custkey % 7 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS customer_id,
         n_name AS country,
         CASE WHEN o_orderdate >= TIMESTAMP '2001-07-01' THEN 'stream_live' ELSE 'batch_historical' END AS source_system,
         TIMESTAMP '2001-11-30' AS ingested_at,
         l_orderkey AS order_key
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON n_nationkey = (c_nationkey + CASE WHEN o_orderkey % 13 = 0 THEN 1 ELSE 0 END) % 25""",
)
part(
    "raw",
    "lines",
    f"""
  SELECT {ORDER_FIELDS}, CAST(year(invoice_date) AS INTEGER) AS partition_year,
         CAST(month(invoice_date) AS INTEGER) AS partition_month,
         TIMESTAMP '2001-12-01' + to_days(load_no - 1) AS loaded_at,
         'orders/year=' || year(invoice_date) || '/month=' || month(invoice_date) || '/part-' || load_no
           || '.snappy.parquet' AS source_file
  FROM lines, (VALUES (1), (2)) AS loads(load_no)
  WHERE load_no = 1 OR order_key % 40 = 0""",
)
CUT = "(CAST(stock_code AS BIGINT) * 7 + quantity) % 997 = 0"
UNDATED = "(CAST(stock_code AS BIGINT) * 3 + quantity) % 499 = 0"
part(
    "landed",
    "raw",
    f"SELECT *, {CUT} AS is_cut, NOT ({CUT}) AND {UNDATED} AS is_undated, "
    "strftime(invoice_date, '%Y-%m') AS path_period FROM raw",
)
_LANDED = (
    "invoice_no, stock_code, description, quantity, invoice_date, unit_price, customer_id, country, source_system, ingested_at"
)
_PROD = f"""SELECT * REPLACE (CAST(quantity + CASE WHEN invoice_no = (SELECT min(invoice_no) FROM raw) THEN 1 ELSE 0 END
           AS INTEGER) AS quantity) FROM (SELECT {_LANDED}, partition_year AS y, partition_month AS m FROM raw
           WHERE NOT (partition_year = 1996 AND partition_month = 2 AND unit_price <= 0))"""
_TYPED = f"""
  SELECT invoice_no, stock_code, trim(description) AS description, quantity, invoice_date, unit_price, customer_id,
         trim(country) AS country, source_system, ingested_at, loaded_at, source_file,
         {PERIOD.format(y="partition_year", m="partition_month")} AS period,
         CAST(invoice_date AS DATE) AS invoice_date_only,
         invoice_no LIKE 'C%' AS is_cancellation,
         CASE WHEN invoice_no LIKE 'C%' THEN 'cancellation' WHEN quantity < 0 THEN 'negative_adjustment'
              WHEN unit_price <= 0 THEN 'zero_or_negative_price' ELSE 'normal' END AS line_type,
         quantity * unit_price AS line_amount,
         CAST(row_number() OVER (
           PARTITION BY invoice_no, stock_code, quantity, invoice_date, unit_price
           ORDER BY loaded_at, source_file, description NULLS FIRST, customer_id NULLS FIRST, country NULLS FIRST
         ) AS INTEGER) AS duplicate_occurrence
  FROM """
part("stg", "raw", _TYPED + "raw")
part(
    "fct_lines",
    "stg",
    "SELECT invoice_no, stock_code, description, customer_id, country, invoice_date, period, quantity, unit_price, "
    "line_amount, is_cancellation, line_type, source_system FROM stg WHERE duplicate_occurrence = 1",
)
part(
    "fct_orders",
    "fct_lines",
    f"""
  SELECT invoice_no, min(customer_id) AS customer_id, min(country) AS country, min(period) AS period,
         min(invoice_date) AS invoice_date, count(DISTINCT stock_code) AS line_item_count,
         CAST(sum(quantity) AS BIGINT) AS total_quantity, {total("line_amount")} AS total_revenue,
         bool_or(is_cancellation) AS is_cancelled_order
  FROM fct_lines GROUP BY invoice_no""",
)
part(
    "monthly",
    "fct_orders",
    f"""
  SELECT period, country,
         count(invoice_no) FILTER (NOT is_cancelled_order) AS total_orders,
         coalesce(CAST(sum({dec("total_revenue")}) FILTER (NOT is_cancelled_order) AS DOUBLE), 0) AS total_revenue,
         CAST(coalesce(sum(total_quantity) FILTER (NOT is_cancelled_order), 0) AS BIGINT) AS total_units,
         count(DISTINCT customer_id) FILTER (NOT is_cancelled_order) AS total_customers,
         count(invoice_no) FILTER (is_cancelled_order) AS cancelled_orders,
         coalesce(CAST(sum(abs({dec("total_revenue")})) FILTER (is_cancelled_order) AS DOUBLE), 0) AS cancelled_revenue
  FROM fct_orders GROUP BY period, country""",
)
part(
    "revenue_monthly",
    "monthly",
    """
  SELECT m.*, lag(total_revenue) OVER w AS prior_period_revenue,
         CASE WHEN lag(total_revenue) OVER w = 0 THEN 0
              ELSE (total_revenue - lag(total_revenue) OVER w) / nullif(lag(total_revenue) OVER w, 0) END
           AS revenue_mom_change,
         lag(total_revenue) OVER w IS NULL AS is_first_period_for_country
  FROM monthly m WINDOW w AS (PARTITION BY country ORDER BY period)""",
)
part("known_lines", "fct_lines", "SELECT * FROM fct_lines WHERE customer_id IS NOT NULL")
part(
    "customer_country",
    "known_lines",
    """
  SELECT customer_id, country FROM (SELECT customer_id, country, count(*) AS n FROM known_lines GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY n DESC, country ASC NULLS LAST) = 1""",
)
part(
    "product_description",
    "fct_lines",
    """
  SELECT stock_code, description
  FROM (SELECT stock_code, description, count(*) AS n FROM fct_lines WHERE description IS NOT NULL GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY stock_code ORDER BY n DESC, description ASC) = 1""",
)
part(
    "per_customer",
    "known_lines",
    f"""
  SELECT customer_id, min(invoice_date) AS first_order_date, max(invoice_date) AS last_order_date,
         count(DISTINCT invoice_no) FILTER (NOT is_cancellation) AS total_orders,
         count(DISTINCT invoice_no) FILTER (is_cancellation) AS total_cancelled_orders,
         count(*) AS total_line_items,
         CAST(coalesce(sum(quantity) FILTER (NOT is_cancellation), 0) AS BIGINT) AS total_units_purchased,
         coalesce(CAST(sum({dec("line_amount")}) FILTER (NOT is_cancellation) AS DOUBLE), 0) AS total_revenue
  FROM known_lines GROUP BY customer_id""",
)
part(
    "customers",
    "per_customer customer_country",
    """
  SELECT customer_id, country, first_order_date, last_order_date,
         CAST(date_diff('day', first_order_date, last_order_date) AS INTEGER) AS customer_tenure_days,
         total_orders, total_cancelled_orders, total_line_items, total_units_purchased, total_revenue,
         CAST(total_cancelled_orders AS DOUBLE) / nullif(CAST(total_orders + total_cancelled_orders AS DOUBLE), 0)
           AS cancellation_rate,
         total_revenue / nullif(CAST(total_orders AS DOUBLE), 0) AS avg_order_value,
         CAST(date_diff('day', last_order_date, (SELECT max(invoice_date) FROM known_lines)) AS INTEGER)
           AS rfm_recency_days,
         total_orders AS rfm_frequency, total_revenue AS rfm_monetary,
         CASE ntile(3) OVER (ORDER BY total_revenue, customer_id)
           WHEN 3 THEN 'high_value' WHEN 2 THEN 'mid_value' ELSE 'low_value' END AS customer_segment
  FROM per_customer JOIN customer_country USING (customer_id)""",
)
part(
    "products",
    "fct_lines product_description",
    f"""
  SELECT l.stock_code, any_value(d.description) AS description, min(invoice_date) AS first_sold_date,
         max(invoice_date) AS last_sold_date, count(DISTINCT invoice_no) AS total_orders_containing,
         CAST(coalesce(sum(quantity) FILTER (NOT is_cancellation), 0) AS BIGINT) AS total_units_sold,
         coalesce(CAST(sum({dec("line_amount")}) FILTER (NOT is_cancellation) AS DOUBLE), 0) AS total_revenue,
         CAST(coalesce(sum(abs(quantity)) FILTER (is_cancellation), 0) AS BIGINT) AS total_cancelled_units,
         CAST(sum(CAST(unit_price AS DECIMAL(18,8))) FILTER (NOT is_cancellation) AS DOUBLE)
           / nullif(CAST(count(unit_price) FILTER (NOT is_cancellation) AS DOUBLE), 0) AS avg_unit_price,
         CAST(coalesce(sum(abs(quantity)) FILTER (is_cancellation), 0) AS DOUBLE)
           / nullif(CAST(coalesce(sum(quantity) FILTER (NOT is_cancellation), 0)
                         + coalesce(sum(abs(quantity)) FILTER (is_cancellation), 0) AS DOUBLE), 0) AS cancellation_rate
  FROM fct_lines l LEFT JOIN product_description d ON d.stock_code = l.stock_code
  GROUP BY l.stock_code""",
)
part(
    "mapping",
    "",
    """
  SELECT n_name AS retail_country,
         CASE WHEN n_nationkey % 10 <> 2 THEN 'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') END
           AS worldbank_country_id,
         CASE WHEN n_nationkey % 10 = 2 THEN 'unmappable' WHEN n_nationkey % 3 = 0 THEN 'exact'
              WHEN n_nationkey % 3 = 1 THEN 'alias' ELSE 'assumed' END AS mapping_type,
         CASE WHEN n_nationkey % 3 = 1 THEN 'also known as ' || lower(n_name) END AS note
  FROM nation""",
)
part(
    "wb_countries",
    "",
    """
  SELECT 'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS country_id,
         lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS iso2_code, n_name AS country_name,
         'R' || lpad(CAST(r_regionkey AS VARCHAR), 2, '0') AS region_id, r_name AS region_name,
         '' AS admin_region_id, level AS income_level_id, 'Level ' || level AS income_level_name,
         'IBD' AS lending_type_id,
         CASE WHEN n_nationkey <> 3 THEN ' City ' || n_nationkey END AS capital_city,
         CASE WHEN n_nationkey = 4 THEN 'n/a' ELSE n_nationkey || '.5' END AS longitude,
         CASE WHEN n_nationkey <> 5 THEN '-' || n_nationkey || '.25' END AS latitude,
         'worldbank_api' AS source_system
  FROM (SELECT *, CASE n_nationkey % 3 WHEN 0 THEN 'HIC' WHEN 1 THEN 'LMC' ELSE 'LIC' END AS level FROM nation)
  JOIN region ON n_regionkey = r_regionkey
  UNION ALL
  SELECT 'A' || lpad(CAST(r_regionkey AS VARCHAR), 2, '0'), 'a' || r_regionkey, 'All of ' || r_name, 'NA',
         'Aggregates', '', 'NA', 'Aggregates', '', NULL, NULL, NULL, 'worldbank_api'
  FROM region""",
)
part(
    "nation_totals",
    "",
    """
  SELECT n_nationkey, n_name, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS gdp,
         count(c_custkey) AS population
  FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL""",
)
part(
    "wb_indicators",
    "nation_totals",
    """
  SELECT CASE WHEN n_nationkey <> 6 THEN 'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') END AS country_id,
         n_name AS country_name, code AS indicator_id, label AS indicator_name, '2010' AS year,
         CASE WHEN dataset = 'population' THEN CAST(population AS DOUBLE) WHEN n_nationkey <> 7 THEN gdp END AS value,
         'worldbank_api' AS source_system, dataset
  FROM nation_totals, (VALUES ('gdp', 'NY.GDP.MKTP.CD', 'GDP (current US$)'),
                              ('population', 'SP.POP.TOTL', 'Population, total')) AS i(dataset, code, label)""",
)
part(
    "stg_countries",
    "wb_countries",
    """
  SELECT country_id, iso2_code, country_name, region_id, region_name, income_level_id, income_level_name,
         lending_type_id, nullif(trim(capital_city), '') AS capital_city,
         TRY_CAST(longitude AS DOUBLE) AS longitude, TRY_CAST(latitude AS DOUBLE) AS latitude, source_system,
         TIMESTAMP '2001-12-01' AS loaded_at
  FROM wb_countries WHERE region_id <> 'NA'""",
)
part(
    "stg_indicators",
    "wb_indicators",
    """
  SELECT country_id, year, gdp_usd, population,
         CASE WHEN population > 0 THEN gdp_usd / population END AS gdp_per_capita_usd, source_system, loaded_at
  FROM (SELECT country_id, year, max(value) FILTER (indicator_id = 'NY.GDP.MKTP.CD') AS gdp_usd,
               max(value) FILTER (indicator_id = 'SP.POP.TOTL') AS population,
               max(source_system) AS source_system, TIMESTAMP '2001-12-01' AS loaded_at
        FROM wb_indicators WHERE country_id IS NOT NULL GROUP BY country_id, year)""",
)
part(
    "period_counts",
    "raw",
    "SELECT partition_year AS y, partition_month AS m, count(*) AS n FROM raw GROUP BY ALL",
)
_DUE = f"""
  SELECT {PERIOD.format(y="y", m="m")} AS period, 'run-' || {PERIOD.format(y="y", m="m")} || '-' || attempt AS run_id,
         'json-to-parquet' AS job_name,
         CASE attempt WHEN 0 THEN TIMESTAMP '2001-11-29 06:00' ELSE TIMESTAMP '2001-11-30 06:00' END AS recon_at,
         n + m % 3 + m % 2 AS source_lines, CAST(m % 3 AS BIGINT) AS corrupt_rows, CAST(m % 2 AS BIGINT) AS undated_rows,
         n AS expected_rows, back AS rows_written_back, back - n AS difference,
         attempt = 1 AND m <> 7 AS glue_balanced, n + m % 2 AS q_rows_total, CAST(0 AS BIGINT) AS q_null_invoice_no,
         CAST(m AS BIGINT) AS q_null_customer_id, CAST(m * 2 AS BIGINT) AS q_negative_quantity,
         CAST(m * 3 AS BIGINT) AS q_non_positive_price, CAST(m * 4 AS BIGINT) AS q_cancellations,
         CAST(m % 2 AS BIGINT) AS q_unparseable_date, TIMESTAMP '2001-12-01' AS loaded_at
  FROM (SELECT *, CASE WHEN attempt = 0 THEN 0 WHEN y = 1997 AND m = 2 THEN NULL WHEN m = 5 THEN n - 1 ELSE n END AS back
        FROM attempts)"""
part(
    "attempts",
    "period_counts",
    """
  SELECT y, m, n, 1 AS attempt FROM period_counts WHERE NOT (y = 1996 AND m = 11)
  UNION ALL SELECT y, m, n, 0 FROM period_counts WHERE m = 3
  UNION ALL SELECT max(y), 12, 5, 1 FROM period_counts""",
)
part("records", "attempts", _DUE)
part(
    "latest",
    "records",
    "SELECT * FROM records QUALIFY row_number() OVER (PARTITION BY period ORDER BY recon_at DESC, run_id DESC) = 1",
)
part(
    "stale_stg",
    "stg",
    "SELECT * FROM stg WHERE NOT (period LIKE '%-09' AND loaded_at = TIMESTAMP '2001-12-02')",
)
part(
    "recon",
    "latest period_counts stale_stg",
    f"""
  SELECT period, source_lines AS ndjson_source_lines, corrupt_rows, undated_rows,
         rows_written_back AS glue_wrote_to_s3, r.n AS snowflake_loaded, s.n AS dbt_staging_rows,
         coalesce(r.n, 0) - coalesce(rows_written_back, 0) AS s3_to_snowflake_diff,
         coalesce(s.n, 0) - coalesce(r.n, 0) AS snowflake_to_staging_diff, glue_balanced,
         recon_at AS last_glue_run_at, run_id AS last_glue_run_id,
         CASE WHEN run_id IS NULL THEN 'no_glue_record' WHEN r.n IS NULL THEN 'not_loaded_to_snowflake'
              WHEN NOT glue_balanced THEN 'glue_unbalanced'
              WHEN coalesce(r.n, 0) <> rows_written_back THEN 's3_to_snowflake_mismatch'
              WHEN coalesce(s.n, 0) <> r.n THEN 'snowflake_to_staging_mismatch' ELSE 'ok' END AS recon_status
  FROM latest
  FULL JOIN (SELECT {PERIOD.format(y="y", m="m")} AS period, n FROM period_counts) r USING (period)
  FULL JOIN (SELECT period, count(*) AS n FROM stale_stg GROUP BY period) s USING (period)""",
)
part(
    "held_from",
    "raw",
    f"SELECT min(d) AS cutoff FROM (SELECT DISTINCT CAST(invoice_date AS DATE) AS d FROM raw ORDER BY d DESC "
    f"LIMIT {HOLD_BACK_DAYS})",
)
part(
    "resplit",
    "raw held_from",
    "SELECT * EXCLUDE (source_system), CASE WHEN CAST(invoice_date AS DATE) >= (SELECT cutoff FROM held_from) "
    "THEN 'stream_live' ELSE 'batch_historical' END AS source_system FROM raw",
)


def by_period(source: str, more: str = "") -> str:
    return (
        f"SELECT period{more}, count(*) AS row_count, count(*) FILTER (duplicate_occurrence > 1) AS duplicate_rows, "
        f"CAST(sum(quantity) AS BIGINT) AS units, {total('line_amount')} AS revenue FROM {source} GROUP BY period{more}"
    )


def violations(table: str, checks: list[tuple[str, str, str]], source: str) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{name}' AS check_name, '{severity}' AS severity, "
        f"count(*) FILTER ({bad}) AS violations FROM {source}"
        for name, severity, bad in checks
    )


# months of a country whose revenue is negative: the one declared check that the test lines can fail
NEGATIVE_MONTHS = """SELECT count(*) FROM (
    SELECT sum(round(quantity * unit_price, 4)) AS revenue FROM (
      SELECT DISTINCT path_period, country, invoice_no, stock_code, quantity, invoice_date, unit_price
      FROM landed WHERE NOT is_cut AND NOT is_undated)
    WHERE invoice_no NOT LIKE 'C%' GROUP BY path_period, country) WHERE revenue < 0"""
# the declared checks, by table; those that only warn say so
DECLARED_CHECKS = {
    "raw_orders": (
        "not_null(invoice_no)",
        "not_null(stock_code)",
        "not_null(quantity)",
        "not_null(invoice_date)",
        "not_null(unit_price)",
        "not_null(country)",
        "not_null(source_system)",
        "not_null(partition_year)",
        "not_null(partition_month)",
        "not_null(source_file)",
        "accepted_values(source_system)",
    ),
    "stg_orders": (
        "not_null(invoice_no)",
        "not_null(period)",
        "not_null(line_type)",
        "not_null(is_cancellation)",
        "not_null(line_amount)",
        "not_null(duplicate_occurrence)",
        "accepted_values(line_type)",
        "accepted_values(source_system)",
        "expression(quantity < 0) : warn",
    ),
    "fct_order_lines": (
        "not_null(invoice_no)",
        "not_null(stock_code)",
        "not_null(line_amount)",
    ),
    "fct_orders": (
        "not_null(invoice_no)",
        "expression(line_item_count > 0)",
        "unique(invoice_no)",
    ),
    "fct_revenue_monthly": (
        "not_null(total_revenue)",
        "accepted_range(total_revenue)",
        "unique(period, country)",
    ),
    "dim_customer": (
        "not_null(customer_id)",
        "not_null(total_orders)",
        "not_null(total_revenue)",
        "accepted_range(cancellation_rate)",
        "accepted_values(customer_segment)",
        "unique(customer_id)",
    ),
    "dim_product": (
        "not_null(stock_code)",
        "accepted_range(avg_unit_price)",
        "unique(stock_code)",
    ),
    "dim_country": (
        "not_null(retail_country)",
        "accepted_values(mapping_type)",
        "unique(retail_country)",
    ),
    "dim_date": (
        "not_null(date_day)",
        "unique(date_day)",
    ),
    "fct_pipeline_reconciliation": (
        "not_null(period)",
        "accepted_values(recon_status)",
        "accepted_range(s3_to_snowflake_diff)",
        "accepted_range(snowflake_to_staging_diff)",
        "unique(period)",
    ),
    "raw_worldbank_countries": (
        "not_null(country_id)",
        "not_null(country_name)",
        "unique(country_id)",
    ),
    "raw_worldbank_indicators": (
        "not_null(indicator_id)",
        "accepted_values(indicator_id)",
    ),
    "stg_worldbank_countries": (
        "not_null(country_id)",
        "not_null(country_name)",
        "not_null(region_name)",
        "unique(country_id)",
    ),
    "stg_worldbank_indicators": (
        "not_null(country_id)",
        "not_null(year)",
        "unique(country_id, year)",
    ),
    "country_mapping": (
        "not_null(retail_country)",
        "not_null(mapping_type)",
        "accepted_values(mapping_type)",
        "unique(retail_country)",
    ),
    "stg_glue_recon": (
        "not_null(period)",
        "unique(period)",
    ),
    "glue_recon_raw": (
        "not_null(recon_record)",
    ),
}
DECLARED = ", ".join(
    f"('{table}', '{name.split(' : ')[0]}', '{name.split(' : ')[1] if ' : ' in name else 'error'}')"
    for table, names in DECLARED_CHECKS.items()
    for name in names
)


def converted(columns: str, extra: str = "") -> str:
    return sql(
        "landed",
        f"""SELECT {columns} FROM (
  SELECT path_period AS period, count(*) AS source_lines, count(*) FILTER (is_cut) AS corrupt_rows,
         count(*) FILTER (is_undated) AS undated_rows, count(*) FILTER (NOT is_cut AND NOT is_undated) AS expected_rows,
         count(*) FILTER (NOT is_cut AND NOT is_undated) AS rows_written_back, CAST(0 AS BIGINT) AS difference,
         true AS balanced, true AS glue_balanced, CAST(0 AS BIGINT) AS stray_rows, 'converted' AS status,
         count(*) FILTER (NOT is_cut) AS q_rows_total, CAST(0 AS BIGINT) AS q_null_invoice_no,
         count(*) FILTER (NOT is_cut AND customer_id IS NULL) AS q_null_customer_id,
         count(*) FILTER (NOT is_cut AND quantity < 0) AS q_negative_quantity,
         count(*) FILTER (NOT is_cut AND unit_price <= 0) AS q_non_positive_price,
         count(*) FILTER (NOT is_cut AND invoice_no LIKE 'C%') AS q_cancellations,
         count(*) FILTER (is_undated) AS q_unparseable_date
  FROM landed GROUP BY path_period){extra}""",
    )


RECON_COUNTS = "period, source_lines, corrupt_rows, undated_rows, expected_rows, rows_written_back, difference"
RAW_COLUMNS = [
    *ORDER_FIELDS.split(", "),
    "source_file",
    "loaded_at",
    "partition_year",
    "partition_month",
]
MASK = f"sha256('{SALT}' || customer_id)"

ORACLES: dict[str, str] = {
    # ---------------------------------------------------------- sources, sinks
    "csv_source_scan": sql(
        "raw",
        f"""SELECT invoice_no, stock_code, description, quantity, invoice_date, unit_price, customer_id, country,
         'batch_historical' AS source_system, CAST(invoice_date AS DATE) AS event_date FROM raw WHERE NOT ({UNDATED})""",
    ),
    "csv_source_scan_uci": sql(
        "raw",
        f"""SELECT invoice_no, stock_code, description || chr(10) || 'said "new"' AS description, quantity, invoice_date, unit_price,
         customer_id, country, 'batch_historical' AS source_system, CAST(invoice_date AS DATE) AS event_date
  FROM raw WHERE NOT ({UNDATED})""",
    ),
    "source_profile": sql(
        "raw",
        f"""SELECT count(*) AS row_count, CAST(min(invoice_date) AS DATE) AS first_date,
         CAST(max(invoice_date) AS DATE) AS last_date, count(DISTINCT invoice_no) AS distinct_invoices,
         count(DISTINCT customer_id) AS distinct_customers, count(DISTINCT country) AS distinct_countries,
         count(*) FILTER (customer_id IS NULL) AS null_customer_id, count(*) FILTER (quantity < 0) AS negative_quantity,
         count(*) FILTER (unit_price <= 0) AS non_positive_price,
         count(*) FILTER (invoice_no LIKE 'C%') AS cancellations,
         count(*) - (SELECT count(*) FROM (SELECT DISTINCT invoice_no, stock_code, description, quantity, invoice_date,
                       unit_price, customer_id, country FROM raw WHERE NOT ({UNDATED}))) AS exact_duplicates,
         CAST(count(*) FILTER (customer_id IS NULL) AS DOUBLE) / count(*) AS null_customer_share
  FROM raw WHERE NOT ({UNDATED})""",
    ),
    "ndjson_month_scan": sql(
        "landed",
        "SELECT path_period, * EXCLUDE (path_period, partition_year, partition_month, loaded_at, source_file, is_cut, "
        "is_undated, invoice_date), CASE WHEN NOT is_undated THEN invoice_date END AS invoice_date "
        "FROM landed WHERE NOT is_cut",
    ),
    "ndjson_daily_roundtrip": sql(
        "raw", f"SELECT strftime(invoice_date, '%Y-%m-%d') AS event_date, {ORDER_FIELDS} FROM raw"
    ),
    "quality_metrics": sql(
        "landed",
        """SELECT count(*) AS rows_total, count(*) FILTER (invoice_no IS NULL) AS null_invoice_no,
         count(*) FILTER (customer_id IS NULL) AS null_customer_id, count(*) FILTER (quantity < 0) AS negative_quantity,
         count(*) FILTER (unit_price <= 0) AS non_positive_price,
         count(*) FILTER (invoice_no LIKE 'C%') AS cancellations, count(*) FILTER (is_undated) AS unparseable_date
  FROM landed WHERE NOT is_cut""",
    ),
    "corrupt_sample": sql(
        "landed",
        """SELECT path_period, left('{"invoice_no":"' || invoice_no || '","stock_code":"', 20) AS line
  FROM landed WHERE is_cut ORDER BY line, path_period LIMIT 3""",
    ),
    "stray_row_guard": sql(
        "landed",
        """SELECT strftime(invoice_date + INTERVAL 1 MONTH, '%Y-%m') AS path_period, count(*) AS stray_rows,
         min(invoice_date) AS first_stray_date, max(invoice_date) AS last_stray_date
  FROM landed WHERE day(invoice_date) = 1 AND NOT is_cut AND NOT is_undated GROUP BY 1""",
    ),
    "convert_month": sql(
        "landed",
        """SELECT partition_year AS year, partition_month AS month, count(*) AS row_count,
         CAST(sum(quantity) AS BIGINT) AS units, min(invoice_date) AS first_invoice_date,
         count(*) FILTER (customer_id IS NULL) AS null_customer_id
  FROM landed WHERE NOT is_cut AND NOT is_undated GROUP BY ALL""",
    ),
    "convert_month_recon": converted(f"{RECON_COUNTS}, balanced, stray_rows, status"),
    "recon_audit_record": converted(
        f"{RECON_COUNTS}, glue_balanced, q_rows_total, q_null_invoice_no, q_null_customer_id, q_negative_quantity, "
        "q_non_positive_price, q_cancellations, q_unparseable_date"
    ),
    "backfill_months": converted(
        "period, source_lines, rows_written_back, status",
        """
  UNION ALL SELECT strftime(min(invoice_date) - INTERVAL 1 MONTH, '%Y-%m'), 0, 0, 'no_source_lines' FROM landed
  UNION ALL SELECT strftime(max(invoice_date) + INTERVAL 1 MONTH, '%Y-%m'), 0, 0, 'no_source_lines' FROM landed""",
    ),
    "undated_quarantine": sql(
        "landed",
        """SELECT path_period AS period, CASE WHEN is_cut THEN 'corrupt' ELSE 'undated' END AS reason,
         count(*) AS line_count FROM landed WHERE is_cut OR is_undated GROUP BY ALL""",
    ),
    "quarantine_after_rerun": sql(
        "landed",
        """SELECT path_period AS period, CASE WHEN is_cut THEN 'corrupt' ELSE 'undated' END AS reason,
         count(*) AS line_count FROM landed
  WHERE (is_cut OR is_undated) AND CAST(substr(path_period, 6, 2) AS INTEGER) % 2 = 1 GROUP BY ALL""",
    ),
    "convert_effort": sql("landed", "SELECT DISTINCT path_period AS period, true AS has_bytes, true AS has_seconds FROM landed"),
    "raw_orders_load": sql(
        "raw",
        f"SELECT {ORDER_FIELDS}, partition_year, partition_month, TIMESTAMP '2001-12-01' AS loaded_at, "
        "true AS source_file_matches FROM raw",
    ),
    "raw_load_skip_loaded": sql(
        "raw",
        "SELECT partition_year, partition_month, loaded_at, count(*) AS row_count, 0 AS files_loaded_again "
        "FROM raw GROUP BY ALL",
    ),
    "raw_orders_reload": sql(
        "raw",
        """SELECT partition_year, partition_month,
         CASE partition_month WHEN 6 THEN TIMESTAMP '2001-12-02' ELSE TIMESTAMP '2001-12-01' END AS loaded_at,
         count(*) AS row_count, CAST(sum(quantity) AS BIGINT) AS units
  FROM raw WHERE partition_month <> 6 OR unit_price > 0 GROUP BY ALL""",
    ),
    "raw_orders_reload_interrupted": sql(
        "raw",
        """SELECT partition_year, partition_month,
         CASE WHEN state = 'reloaded' AND partition_month = 6 THEN TIMESTAMP '2001-12-02' ELSE TIMESTAMP '2001-12-01' END
           AS loaded_at,
         count(*) AS row_count, CAST(sum(quantity) AS BIGINT) AS units, state
  FROM raw, (VALUES ('stopped'), ('open reader'), ('reloaded')) AS x(state)
  WHERE state <> 'reloaded' OR partition_month <> 6 OR unit_price > 0 GROUP BY ALL""",
    ),
    "raw_partition_summary": sql(
        "raw",
        """SELECT partition_year, partition_month, count(*) AS row_count, min(invoice_date) AS first_invoice_date,
         max(invoice_date) AS last_invoice_date FROM raw GROUP BY ALL ORDER BY 1, 2""",
    ),
    "raw_null_partition_keys": sql(
        "raw", "SELECT count(*) AS rows_with_null_partition FROM raw WHERE partition_month = 2"
    ),
    # ---------------------------------------------------------- reference data
    "wb_flatten_countries": sql("wb_countries", "SELECT * FROM wb_countries"),
    "wb_flatten_indicators": sql("wb_indicators", "SELECT * FROM wb_indicators"),
    "wb_page_check": """SELECT d AS dataset, CASE d WHEN 'gdp' THEN 3 ELSE 2 END AS pages_expected,
         count(DISTINCT n_nationkey % 2) AS pages_seen, CAST(d = 'gdp' AS BIGINT) AS malformed_pages, d <> 'gdp' AS complete
  FROM nation, (VALUES ('countries'), ('gdp'), ('population')) AS x(d) GROUP BY d""",
    "wb_fetch_recon": sql(
        "wb_countries wb_indicators",
        """SELECT 'countries' AS dataset, count(*) AS fetched, count(*) AS written, true AS balanced,
         count(*) FILTER (region_id = 'NA') AS aggregates_included, CAST(NULL AS BIGINT) AS null_values,
         'overwrite_in_place' AS write_mode FROM wb_countries
  UNION ALL SELECT dataset, count(*), count(*), true, NULL, count(*) FILTER (value IS NULL), 'overwrite_in_place'
  FROM wb_indicators GROUP BY dataset""",
    ),
    "worldbank_countries_load": sql("wb_countries", "SELECT *, TIMESTAMP '2001-12-01' AS loaded_at FROM wb_countries"),
    "worldbank_indicators_load": sql(
        "wb_indicators", "SELECT * EXCLUDE (dataset), TIMESTAMP '2001-12-01' AS loaded_at FROM wb_indicators"
    ),
    "worldbank_country_counts": sql(
        "wb_countries",
        """SELECT count(*) AS total_rows, count(*) FILTER (region_id = 'NA') AS aggregates,
         count(*) FILTER (region_id <> 'NA') AS actual_countries FROM wb_countries""",
    ),
    "worldbank_indicator_nulls": sql(
        "wb_indicators",
        """SELECT indicator_id, year, count(*) AS row_count, count(value) AS non_null_values,
         count(*) - count(value) AS null_values FROM wb_indicators GROUP BY ALL ORDER BY 1, 2""",
    ),
    "seed_country_mapping": sql("mapping", "SELECT * FROM mapping"),
    "stg_worldbank_countries": sql("stg_countries", "SELECT * FROM stg_countries"),
    "stg_worldbank_indicators": sql("stg_indicators", "SELECT * FROM stg_indicators"),
    # ----------------------------------------------------------------- staging
    "stg_orders_full": sql("stg", "SELECT * FROM stg"),
    "line_type_breakdown": sql(
        "stg", f"SELECT line_type, count(*) AS row_count, {total('line_amount')} AS revenue FROM stg GROUP BY line_type"
    ),
    "duplicate_lines": sql(
        "stg",
        """SELECT invoice_no, stock_code, quantity, invoice_date, unit_price, period, loaded_at, duplicate_occurrence
  FROM stg WHERE duplicate_occurrence > 1""",
    ),
    "duplicate_rate": sql(
        "stg",
        """SELECT period, count(*) AS total_rows, count(*) FILTER (duplicate_occurrence > 1) AS duplicate_rows,
         CAST(count(*) FILTER (duplicate_occurrence > 1) AS DOUBLE) / count(*) AS duplicate_rate
  FROM stg GROUP BY period""",
    ),
    "stg_orders_incremental": sql("stg", by_period("stg")),
    "stg_orders_incremental_after_reprocess": sql("stg", by_period("stg")),
    "stg_orders_incremental_ledger": sql("stg", by_period("stg")),
    "stg_orders_reprocess": sql(
        "raw",
        f"""SELECT * FROM ({by_period(f'''({_TYPED} (SELECT * FROM raw WHERE NOT (partition_year = 1996 AND partition_month = 2)
    AND NOT (partition_month = 6 AND loaded_at = TIMESTAMP '2001-12-02')))''')})""",
    ),
    "stg_schema_guard": sql(
        "stg",
        """SELECT 'stg_orders' AS obj, c AS column_name, t AS data_type, side AS only_in,
         CASE WHEN c = 'quantity' THEN (SELECT count(quantity) FROM stg) ELSE (SELECT count(country) FROM stg) END
           AS filled_rows
  FROM (VALUES ('country', 'string', 'table'), ('quantity', 'int', 'table'), ('ship_country', 'string', 'drifted'),
               ('quantity', 'bigint', 'drifted')) AS d(c, t, side)""",
    ),
    "stg_recon_latest": sql("latest", "SELECT * FROM latest"),
    "recon_raw_load": sql("records", "SELECT * FROM records"),
    # ------------------------------------------------------------------- recon
    "pipeline_reconciliation": sql("recon", "SELECT * FROM recon"),
    "recon_status_report": sql(
        "recon",
        """SELECT period, ndjson_source_lines, glue_wrote_to_s3, snowflake_loaded, dbt_staging_rows,
         s3_to_snowflake_diff, snowflake_to_staging_diff, recon_status FROM recon ORDER BY period""",
    ),
    "recon_gate": sql(
        "recon",
        """SELECT period, CASE WHEN recon_status <> 'ok' THEN recon_status ELSE 'unknown_counts' END AS reason
  FROM recon WHERE recon_status <> 'ok' OR glue_wrote_to_s3 IS NULL OR glue_balanced IS NULL""",
    ),
    "recon_vs_loaded": sql(
        "records period_counts",
        f"""SELECT period, run_id, rows_written_back AS glue_wrote, r.n AS rows_loaded,
         r.n - rows_written_back AS difference
  FROM records LEFT JOIN (SELECT {PERIOD.format(y="y", m="m")} AS period, n FROM period_counts) r USING (period)""",
    ),
    "volume_anomaly": sql(
        "stg",
        """SELECT period, n AS rows_in_staging, CAST(sum(n) OVER w AS DOUBLE) / nullif(count(n) OVER w, 0) AS prior_average,
         n / nullif(CAST(sum(n) OVER w AS DOUBLE) / nullif(count(n) OVER w, 0), 0) AS volume_ratio
  FROM (SELECT period, count(*) AS n FROM stg GROUP BY period)
  WINDOW w AS (ORDER BY period ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)""",
    ),
    # ------------------------------------------------------------------- marts
    "fct_order_lines": sql("fct_lines", "SELECT * FROM fct_lines"),
    "fct_orders": sql("fct_orders", "SELECT * FROM fct_orders"),
    "orders_avg_line_value": sql(
        "fct_orders",
        "SELECT invoice_no, line_item_count, total_revenue, total_revenue / nullif(CAST(line_item_count AS DOUBLE), 0) "
        "AS avg_line_value FROM fct_orders",
    ),
    "fct_revenue_monthly": sql("revenue_monthly", "SELECT * FROM revenue_monthly"),
    "dim_customer": sql("customers", "SELECT * FROM customers"),
    "dim_customer_ranged": sql("customers", "SELECT * FROM customers"),
    "customer_country_mode": sql("customer_country", "SELECT * FROM customer_country"),
    "customer_segment_sizes": sql(
        "customers",
        """SELECT customer_segment, count(*) AS customers, min(total_revenue) AS lowest_revenue,
         max(total_revenue) AS highest_revenue FROM customers GROUP BY 1""",
    ),
    "dim_product": sql("products", "SELECT * FROM products"),
    "product_description_mode": sql("product_description", "SELECT * FROM product_description"),
    "dim_country": sql(
        "mapping stg_countries stg_indicators fct_lines",
        f"""SELECT retail_country, worldbank_country_id, mapping_type, country_name, region_name, income_level_name,
         gdp_usd, population, gdp_per_capita_usd, coalesce(total_orders, 0) AS total_orders,
         coalesce(total_customers, 0) AS total_customers, coalesce(revenue, 0) AS total_revenue,
         revenue / nullif(population, 0) AS revenue_per_capita
  FROM mapping m
  LEFT JOIN stg_countries c ON c.country_id = worldbank_country_id
  LEFT JOIN stg_indicators i ON i.country_id = worldbank_country_id AND i.year = '2010'
  LEFT JOIN (SELECT country, count(DISTINCT invoice_no) AS total_orders, count(DISTINCT customer_id) AS total_customers,
                    coalesce(CAST(sum({dec("line_amount")}) FILTER (NOT is_cancellation) AS DOUBLE), 0) AS revenue
             FROM fct_lines GROUP BY country) a ON a.country = retail_country""",
    ),
    "dim_date": sql(
        "fct_orders",
        """SELECT CAST(d AS DATE) AS date_day, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
         monthname(d) AS month_name, CAST(quarter(d) AS INTEGER) AS quarter, CAST(dayofweek(d) AS INTEGER) AS day_of_week,
         dayname(d) AS day_name, dayofweek(d) IN (0, 6) AS is_weekend, CAST(d AS DATE) = last_day(d) AS is_month_end,
         strftime(d, '%Y-%m') AS period, coalesce(n, 0) AS order_count
  FROM (SELECT unnest(generate_series(min(invoice_date), max(invoice_date), INTERVAL 1 DAY)) AS d FROM fct_orders)
  LEFT JOIN (SELECT CAST(invoice_date AS DATE) AS o, count(*) AS n FROM fct_orders GROUP BY 1) ON o = CAST(d AS DATE)""",
    ),
    "date_spine": sql(
        "fct_lines",
        """SELECT CAST(d AS DATE) AS date_day, strftime(d, '%Y-%m') AS period, coalesce(n, 0) AS line_count
  FROM (SELECT unnest(generate_series(min(CAST(invoice_date AS DATE)), max(CAST(invoice_date AS DATE)) - 1, INTERVAL 1 DAY)) AS d
        FROM fct_lines)
  LEFT JOIN (SELECT CAST(invoice_date AS DATE) AS o, count(*) AS n FROM fct_lines GROUP BY 1) ON o = CAST(d AS DATE)""",
    ),
    # ------------------------------------------------------------------ reader
    "masked_dim_customer": sql("customers", f"SELECT * REPLACE ({MASK} AS customer_id) FROM customers"),
    "reader_views": sql(
        "fct_orders monthly customers products mapping",
        """SELECT 'fct_orders' AS view_name, count(*) AS row_count, count(DISTINCT customer_id) AS distinct_customers,
         count(customer_id) AS masked_rows FROM fct_orders
  UNION ALL SELECT 'fct_revenue_monthly', count(*), 0, 0 FROM monthly
  UNION ALL SELECT 'dim_customer', count(*), count(DISTINCT customer_id), count(customer_id) FROM customers
  UNION ALL SELECT 'dim_product', count(*), 0, 0 FROM products
  UNION ALL SELECT 'dim_country', count(*), 0, 0 FROM mapping
  UNION ALL SELECT 'dim_date', date_diff('day', DATE '2009-12-01', DATE '2012-01-31'), 0, 0""",
    ),
    "small_country_suppression": sql(
        "customers",
        f"""SELECT CASE WHEN count(DISTINCT customer_id) OVER (PARTITION BY country) >= {SMALL_COUNTRY}
                THEN {MASK} END AS customer_id, country, total_orders, total_revenue FROM customers""",
    ),
    # ------------------------------------------------------------ environments
    "env_content_diff": sql(
        "raw",
        f"""SELECT {PERIOD.format(y="y", m="m")} AS period, * EXCLUDE (y, m), count(*) AS copies FROM (
    SELECT *, 'dev' AS only_in FROM (SELECT {_LANDED}, partition_year AS y, partition_month AS m FROM raw EXCEPT ALL {_PROD})
    UNION ALL
    SELECT *, 'prod' FROM ({_PROD} EXCEPT ALL SELECT {_LANDED}, partition_year, partition_month FROM raw))
  GROUP BY ALL""",
    ),
    "env_row_counts": sql(
        "raw wb_countries wb_indicators mapping",
        """SELECT env, obj, CASE obj
           WHEN 'RAW.ORDERS' THEN (SELECT count(*) FROM raw WHERE env = 'dev' OR source_system = 'batch_historical')
           WHEN 'RAW.WORLDBANK_COUNTRIES' THEN (SELECT count(*) FROM wb_countries)
           WHEN 'RAW.WORLDBANK_INDICATORS' THEN (SELECT count(*) FROM wb_indicators)
           ELSE (SELECT count(*) FROM mapping WHERE env = 'dev' OR mapping_type <> 'unmappable') END AS row_count
  FROM (VALUES ('dev'), ('prod')) AS e(env),
       (VALUES ('RAW.ORDERS'), ('RAW.WORLDBANK_COUNTRIES'), ('RAW.WORLDBANK_INDICATORS'), ('STAGING.COUNTRY_MAPPING'))
         AS o(obj)""",
    ),
    "env_schema_diff": sql(
        "raw mapping",
        """SELECT 'RAW.ORDERS' AS obj, 'source_file' AS column_name, 'string' AS data_type, 'dev' AS only_in,
         count(source_file) AS filled_rows FROM raw
  UNION ALL SELECT 'STAGING.COUNTRY_MAPPING', 'note', 'string', 'dev', count(note) FROM mapping""",
    ),
    # ------------------------------------------------------------------ checks
    "check_not_null": sql(
        "raw",
        violations("raw_orders", [(f"not_null({c})", "error", f"{c} IS NULL") for c in RAW_COLUMNS], "raw"),
    ),
    "check_unique": sql(
        "raw fct_lines fct_orders customers",
        "\nUNION ALL ".join(
            f"SELECT '{name}' AS table_name, count(*) AS repeated_keys, CAST(coalesce(sum(n), 0) AS BIGINT) AS rows_covered "
            f"FROM (SELECT {key}, count(*) AS n FROM {src} WHERE {key} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"
            for name, src, key in (
                ("raw_orders", "raw", "invoice_no"),
                ("fct_order_lines", "fct_lines", "stock_code"),
                ("fct_orders", "fct_orders", "invoice_no"),
                ("dim_customer", "customers", "customer_id"),
            )
        ),
    ),
    "check_accepted_values": sql(
        "stg",
        "SELECT line_type AS value, count(*) AS row_count FROM stg "
        "WHERE line_type NOT IN ('normal', 'cancellation') GROUP BY 1",
    ),
    "check_relationships": sql(
        "fct_lines customers",
        """SELECT customer_id AS key, count(*) AS row_count FROM fct_lines
  WHERE customer_id NOT IN (SELECT customer_id FROM customers WHERE total_orders > 8) GROUP BY 1""",
    ),
    "check_accepted_range": sql(
        "stg",
        violations(
            "stg_orders",
            [
                ("accepted_range(quantity)", "error", "quantity < 1"),
                ("accepted_range(unit_price)", "error", "unit_price < 0"),
                ("accepted_range(unit_price)", "error", "unit_price < 0.01"),
                (
                    "accepted_range(line_amount)",
                    "error",
                    "NOT is_cancellation AND (line_amount < -1000 OR line_amount > 50000)",
                ),
                ("accepted_range(duplicate_occurrence)", "error", "duplicate_occurrence <> 1"),
            ],
            "stg",
        ),
    ),
    "check_expression": sql(
        "stg",
        violations(
            "stg_orders",
            [
                ("expression(quantity < 0)", "warn", "is_cancellation AND quantity >= 0"),
                ("expression(line_amount > 0)", "error", "line_amount <= 0"),
                ("expression(quantity > 0)", "error", "NOT is_cancellation AND quantity <= 0"),
            ],
            "stg",
        ),
    ),
    "check_unique_combination": sql(
        "raw",
        "SELECT invoice_no, stock_code, quantity, count(*) AS row_count FROM raw GROUP BY ALL HAVING count(*) > 1",
    ),
    "check_cancellation_consistent": sql(
        "fct_lines",
        """SELECT invoice_no, count(DISTINCT is_cancellation <> (CAST(stock_code AS BIGINT) % 101 = 0))
           AS distinct_flag_values FROM fct_lines GROUP BY 1 HAVING distinct_flag_values > 1""",
    ),
    "check_duplicate_rate": sql(
        "stg",
        f"""SELECT *, CASE period WHEN '1996-01' THEN 'known exception' ELSE 'ordinary period' END AS period_class
  FROM (SELECT period, count(*) AS total_rows, count(*) FILTER (duplicate_occurrence > 1) AS duplicate_rows,
               CAST(count(*) FILTER (duplicate_occurrence > 1) AS DOUBLE) / count(*) AS duplicate_rate
        FROM stg GROUP BY period)
  WHERE duplicate_rate > CASE period WHEN '1996-01' THEN 0.05 ELSE {DUPLICATE_LIMIT} END""",
    ),
    "check_marts_dedup": sql(
        "stg fct_lines",
        """SELECT period, staging_count, marts_count, staging_count - marts_count AS diff
  FROM (SELECT period, count(*) AS staging_count FROM stg WHERE duplicate_occurrence = 1 GROUP BY 1)
  JOIN (SELECT period, count(*) AS marts_count FROM fct_lines WHERE description IS NOT NULL GROUP BY 1) USING (period)
  WHERE staging_count <> marts_count""",
    ),
    "check_marts_dedup_strict": sql(
        "stg",
        """SELECT period, count(*) AS staging_count, CAST(0 AS BIGINT) AS marts_count, count(*) AS diff
  FROM stg WHERE duplicate_occurrence = 1 AND period >= '1999-01' GROUP BY 1""",
    ),
    "check_marts_revenue": sql(
        "stg fct_lines",
        f"""SELECT *, abs(staging_revenue - marts_revenue) AS diff
  FROM (SELECT period, {total("line_amount")} AS staging_revenue FROM stg WHERE duplicate_occurrence = 1 GROUP BY 1)
  JOIN (SELECT period, {total("line_amount + CASE WHEN CAST(stock_code AS BIGINT) % 89 = 0 THEN 1 ELSE 0 END")}
          AS marts_revenue FROM fct_lines GROUP BY 1) USING (period)
  WHERE abs(staging_revenue - marts_revenue) > {REVENUE_TOLERANCE}""",
    ),
    "check_duplicate_raw_files": sql(
        "raw",
        f"""SELECT period, source_file, distinct_files FROM (
    SELECT period, source_file, count(*) OVER (PARTITION BY period) AS distinct_files FROM (
      SELECT DISTINCT {PERIOD.format(y="partition_year", m="partition_month")} AS period, source_file FROM raw))
  WHERE distinct_files > 1""",
    ),
    "check_duplicate_raw_files_listed": sql(
        "raw",
        f"""SELECT period, count(*) AS distinct_files, string_agg(source_file, ', ' ORDER BY source_file) AS file_list FROM (
      SELECT DISTINCT {PERIOD.format(y="partition_year", m="partition_month")} AS period, source_file FROM raw)
  GROUP BY period HAVING count(*) > 1""",
    ),
    "check_double_load": sql(
        "raw",
        "SELECT source_file, count(*) * 2 AS rows_in_raw, count(*) AS rows_in_file FROM raw "
        "WHERE partition_month = 3 GROUP BY 1",
    ),
    "check_unmapped_countries": sql(
        "stg mapping",
        "SELECT DISTINCT country FROM stg WHERE country NOT IN "
        "(SELECT retail_country FROM mapping WHERE mapping_type <> 'alias')",
    ),
    "check_mapping_resolves": sql(
        "mapping wb_countries",
        """SELECT retail_country, worldbank_country_id, mapping_type FROM mapping
  WHERE mapping_type <> 'unmappable'
    AND worldbank_country_id NOT IN (SELECT country_id FROM wb_countries WHERE income_level_id <> 'LIC')""",
    ),
    "check_staging_matches_recon": sql(
        "stale_stg latest",
        """SELECT period, staging_rows, rows_written_back AS glue_rows,
         coalesce(staging_rows, 0) - coalesce(rows_written_back, 0) AS difference
  FROM (SELECT period, count(*) AS staging_rows FROM stale_stg GROUP BY 1) FULL JOIN latest USING (period)
  WHERE coalesce(staging_rows, 0) <> coalesce(rows_written_back, 0)""",
    ),
    "source_freshness": sql(
        "raw",
        f"""SELECT *, CASE WHEN age_days > 30 THEN 'error' WHEN age_days > 7 THEN 'warn' ELSE 'pass' END AS state
  FROM (SELECT max(loaded_at) AS newest_load,
               date_diff('second', max(loaded_at), TIMESTAMP '{FRESH_AS_OF}') / 86400.0::DOUBLE AS age_days FROM raw)""",
    ),
    # --------------------------------------------------------------- streaming
    "stream_holdback_split": sql(
        "resplit",
        """SELECT source_system, count(*) AS row_count, count(DISTINCT CAST(invoice_date AS DATE)) AS days,
         CAST(min(invoice_date) AS DATE) AS first_date, CAST(max(invoice_date) AS DATE) AS last_date
  FROM resplit GROUP BY 1""",
    ),
    "source_system_union": sql("resplit", by_period(f"({_TYPED} resplit)", ", source_system")),
    "stream_replay": sql("resplit", by_period(f"({_TYPED} resplit)", ", source_system")),
    "stream_late_lines": sql("stg", by_period("stg")),
    "stream_second_checkpoint": sql("stg", by_period("stg")),
    "stream_batch_recon": sql(
        "resplit",
        """SELECT count(*) AS source_lines, count(*) AS rows_written, 0::BIGINT AS repeated_rows, 0::BIGINT AS difference, true AS balanced
  FROM resplit WHERE source_system = 'stream_live'""",
    ),
    # --------------------------------------------------------------- whole run
    "recon_content": sql(
        "landed",
        """SELECT path_period AS period, count(*) AS rows_in_lines, count(*) AS rows_in_files, count(*) AS rows_in_raw,
         count(*) AS rows_in_staging,
         CASE WHEN NOT bool_or(CAST(stock_code AS BIGINT) % 389 = 0) THEN 'ok' WHEN path_period LIKE '%-05' THEN 'staged_to_raw_differ'
              WHEN path_period LIKE '%-08' THEN 'raw_to_staging_differ' ELSE 'ok' END AS content_status
  FROM landed WHERE NOT is_cut AND NOT is_undated GROUP BY path_period""",
    ),
    "full_run": converted(
        """period, source_lines AS ndjson_source_lines, rows_written_back AS glue_wrote_to_s3,
         rows_written_back AS snowflake_loaded, rows_written_back AS dbt_staging_rows,
         CAST(0 AS BIGINT) AS s3_to_snowflake_diff, CAST(0 AS BIGINT) AS snowflake_to_staging_diff, 'ok' AS recon_status,
         """ + f"CASE WHEN ({NEGATIVE_MONTHS}) > 0 THEN 'FAILED' ELSE 'SUCCESS' END AS run_state"
    ),
    "full_run_tables": sql(
        "landed mapping",
        f"""SELECT *, CASE WHEN ({NEGATIVE_MONTHS}) > 0 THEN 'FAILED' ELSE 'SUCCESS' END AS state FROM (
  SELECT t AS table_name, (SELECT count(*) FROM landed WHERE NOT is_cut AND NOT is_undated) AS row_count
  FROM (VALUES ('raw_orders'), ('stg_orders')) AS x(t)
  UNION ALL SELECT 'fct_order_lines', count(*) FROM (SELECT DISTINCT invoice_no, stock_code, quantity, invoice_date, unit_price
    FROM landed WHERE NOT is_cut AND NOT is_undated)
  UNION ALL SELECT 'fct_orders', count(*) FROM (SELECT DISTINCT invoice_no FROM landed WHERE NOT is_cut AND NOT is_undated)
  UNION ALL SELECT 'fct_revenue_monthly', count(*) FROM (SELECT DISTINCT path_period, country FROM landed WHERE NOT is_cut AND NOT is_undated)
  UNION ALL SELECT 'dim_customer', count(DISTINCT customer_id) FROM landed WHERE NOT is_cut AND NOT is_undated
  UNION ALL SELECT 'dim_product', count(*) FROM (SELECT DISTINCT stock_code FROM landed WHERE NOT is_cut AND NOT is_undated)
  UNION ALL SELECT 'dim_country', count(*) FROM mapping
  UNION ALL SELECT t, (SELECT count(DISTINCT path_period) FROM landed)
  FROM (VALUES ('stg_glue_recon'), ('fct_pipeline_reconciliation')) AS x(t))""",
    ),
    "declared_checks": sql(
        "landed",
        f"""SELECT table_name, check_name, severity,
         CASE WHEN check_name = 'accepted_range(total_revenue)' THEN ({NEGATIVE_MONTHS}) ELSE CAST(0 AS BIGINT) END AS violations
  FROM (VALUES {DECLARED}) AS x(table_name, check_name, severity)""",
    ),
}
