"""The questions as SQL over the layers."""

from __future__ import annotations

from ..schemas import BRONZE, GOLD, SILVER
from .layers import LAYERS, with_layers

# Percentage with two decimals, rounded half away from zero, in whole numbers throughout.
GROWTH = """
    CASE WHEN {previous} <> 0 THEN (sign({current} - {previous}) * sign({previous})
        * ((2 * abs({current} - {previous})::HUGEINT * 10000 + abs({previous}))
           // (2 * abs({previous}))))::DECIMAL(18, 0) END"""


def _growth(current: str, previous: str) -> str:
    hundredths = GROWTH.format(current=current, previous=previous)
    return f"(({hundredths}) * 0.01)::DECIMAL(18, 2)"


def _int_avg(column: str) -> str:
    return f"(sum({column}) // count({column}))::BIGINT"


def _count_by(column: str, table: str, key: str, name: str) -> str:
    return f"SELECT {column}, count({key}) AS {name} FROM {table} GROUP BY {column}"


def _revenue_by(columns: str, dimension: str, key: str) -> str:
    return f"""
        SELECT {columns}, sum(sales_amount)::BIGINT AS revenue
        FROM gold_sales AS s LEFT JOIN {dimension} AS d ON s.{key} = d.{key}
        GROUP BY {columns}"""


def _per_year(measure: str) -> str:
    return f"""
        SELECT year(order_date)::INT AS order_year, {measure}
        FROM gold_sales GROUP BY year(order_date)"""


CUSTOMER_NAME = "concat(coalesce(first_name, ''), ' ', coalesce(last_name, ''))"

CUSTOMER_REVENUE = f"""
        SELECT {CUSTOMER_NAME} AS customer_name, sum(sales_amount)::BIGINT AS revenue
        FROM gold_sales AS s LEFT JOIN gold_customers AS c ON s.customer_key = c.customer_key
        GROUP BY {CUSTOMER_NAME}"""

YEARLY_PRODUCT_REVENUE = """
        SELECT year(order_date)::INT AS order_year, product_name,
               sum(sales_amount)::BIGINT AS revenue
        FROM gold_sales AS s LEFT JOIN gold_products AS p ON s.product_key = p.product_key
        {where}
        GROUP BY year(order_date), product_name"""

QUESTIONS: dict[str, str] = {
    "customer_countries": "SELECT DISTINCT country FROM gold_customers",
    "customers_by_country": _count_by("country", "gold_customers", "customer_key", "total_customers"),
    "customers_by_gender": _count_by("gender", "gold_customers", "customer_key", "total_customers"),
    "customers_by_marital_status": _count_by(
        "marital_status", "gold_customers", "customer_key", "total_customers"
    ),
    "customers_by_create_year": """
        SELECT year(create_date)::INT AS create_year, count(customer_key) AS total_customers
        FROM gold_customers GROUP BY year(create_date)""",
    "birthdate_range": """
        SELECT min(birthdate) AS oldest_birthdate, max(birthdate) AS youngest_birthdate
        FROM gold_customers""",
    "product_hierarchy": "SELECT category, subcategory, product_name FROM gold_products",
    "products_by_category": _count_by("category", "gold_products", "product_key", "total_products"),
    "products_by_subcategory": _count_by(
        "category, subcategory", "gold_products", "product_key", "total_products"
    ),
    "avg_cost_by_category": f"""
        SELECT category, {_int_avg("cost")} AS average_cost FROM gold_products GROUP BY category""",
    "top10_products_highest_cost": """
        SELECT product_name, category, subcategory, cost FROM gold_products
        ORDER BY cost DESC NULLS LAST, product_key LIMIT 10""",
    "top10_products_lowest_cost": """
        SELECT product_name, category, subcategory, cost FROM gold_products
        ORDER BY cost NULLS FIRST, product_key LIMIT 10""",
    "order_period": """
        SELECT min(order_date) AS first_order, max(order_date) AS last_order,
               date_diff('year', min(order_date), max(order_date))::INT AS range_years
        FROM gold_sales""",
    "all_sales": "SELECT * FROM gold_sales",
    "key_sales_metrics": f"""
        SELECT sum(quantity)::BIGINT AS total_sold, sum(sales_amount)::BIGINT AS total_sales,
               {_int_avg("price")} AS average_price, count(order_number) AS total_orders,
               count(DISTINCT product_key) AS total_products_sold,
               count(DISTINCT customer_key) AS total_customers
        FROM gold_sales""",
    "revenue_by_category": _revenue_by("category", "gold_products", "product_key"),
    "revenue_by_subcategory": _revenue_by("category, subcategory", "gold_products", "product_key"),
    "revenue_by_customer": CUSTOMER_REVENUE,
    "top10_customers_by_revenue": f"""
        SELECT * FROM ({CUSTOMER_REVENUE})
        ORDER BY revenue DESC NULLS LAST, customer_name LIMIT 10""",
    "revenue_by_country": _revenue_by("country", "gold_customers", "customer_key"),
    "customers_and_revenue_by_country": """
        SELECT country, count(DISTINCT c.customer_key) AS total_customers,
               sum(sales_amount)::BIGINT AS revenue
        FROM gold_sales AS s LEFT JOIN gold_customers AS c ON s.customer_key = c.customer_key
        GROUP BY country""",
    "product_revenue_quantity": """
        SELECT product_name, category, subcategory, sum(sales_amount)::BIGINT AS revenue,
               sum(quantity)::BIGINT AS quantity_sold
        FROM gold_sales AS s LEFT JOIN gold_products AS p ON s.product_key = p.product_key
        GROUP BY product_name, category, subcategory""",
    "top10_products_by_revenue": f"""
        {_revenue_by("product_name, category", "gold_products", "product_key")}
        ORDER BY revenue DESC NULLS LAST, product_name NULLS FIRST, category NULLS FIRST
        LIMIT 10""",
    "top10_products_by_quantity": """
        SELECT product_name, category, sum(quantity)::BIGINT AS quantity_sold
        FROM gold_sales AS s LEFT JOIN gold_products AS p ON s.product_key = p.product_key
        GROUP BY product_name, category
        ORDER BY quantity_sold DESC NULLS LAST, product_name NULLS FIRST, category NULLS FIRST
        LIMIT 10""",
    "yearly_revenue": _per_year("sum(sales_amount)::BIGINT AS revenue"),
    "monthly_revenue": """
        SELECT year(order_date)::INT AS order_year, month(order_date)::INT AS order_month,
               sum(sales_amount)::BIGINT AS revenue
        FROM gold_sales GROUP BY year(order_date), month(order_date)""",
    "yearly_orders": _per_year("count(DISTINCT order_number) AS total_orders"),
    "average_order_value": """
        SELECT (sum(sales_amount) // count(DISTINCT order_number))::BIGINT AS average_order_value
        FROM gold_sales""",
    "average_quantity_per_order": """
        SELECT ((units::HUGEINT * 10000000000000 // orders)::DECIMAL(24, 0)
                * 0.0000000000001::DECIMAL(14, 13))::DECIMAL(29, 13) AS average_quantity_per_order
        FROM (SELECT sum(quantity) AS units, count(DISTINCT order_number) AS orders
              FROM gold_sales) AS totals""",
    "revenue_by_gender": _revenue_by("gender", "gold_customers", "customer_key"),
    "revenue_by_marital_status": _revenue_by("marital_status", "gold_customers", "customer_key"),
    "yearly_quantity": _per_year("sum(quantity)::BIGINT AS total_quantity"),
    "yearly_active_customers": _per_year("count(DISTINCT customer_key) AS active_customers"),
    "yearly_average_order_value": _per_year(
        "(sum(sales_amount) // count(DISTINCT order_number))::BIGINT AS average_order_value"
    ),
    "yearly_category_revenue": """
        SELECT year(order_date)::INT AS order_year, category, sum(sales_amount)::BIGINT AS revenue
        FROM gold_sales AS s LEFT JOIN gold_products AS p ON s.product_key = p.product_key
        GROUP BY year(order_date), category""",
    "top10_products_per_year": f"""
        SELECT order_year, product_name, revenue, product_rank FROM (
            SELECT *, row_number() OVER (PARTITION BY order_year
                ORDER BY revenue DESC NULLS LAST, product_name NULLS FIRST)::INT AS product_rank
            FROM ({YEARLY_PRODUCT_REVENUE.format(where="")}))
        WHERE product_rank <= 10""",
    "yearly_country_revenue": """
        SELECT year(order_date)::INT AS order_year, country, sum(sales_amount)::BIGINT AS revenue
        FROM gold_sales AS s LEFT JOIN gold_customers AS c ON s.customer_key = c.customer_key
        GROUP BY year(order_date), country""",
    "yearly_revenue_growth": f"""
        SELECT order_year, revenue, previous_revenue, revenue - previous_revenue AS revenue_change,
               {_growth("revenue", "previous_revenue")} AS revenue_growth_percentage
        FROM (SELECT *, lag(revenue) OVER (ORDER BY order_year NULLS FIRST) AS previous_revenue
              FROM ({_per_year("sum(sales_amount)::BIGINT AS revenue")}))""",
    "running_total_revenue": f"""
        SELECT order_date, revenue,
               (sum(revenue) OVER (ORDER BY order_date))::BIGINT AS running_total_revenue,
               (sum(avg_price) OVER (ORDER BY order_date)
                   // count(avg_price) OVER (ORDER BY order_date))::BIGINT
                   AS cumulative_average_price
        FROM (SELECT date_trunc('year', order_date)::DATE AS order_date,
                     sum(sales_amount)::BIGINT AS revenue, {_int_avg("price")} AS avg_price
              FROM gold_sales AS s WHERE s.order_date IS NOT NULL
              GROUP BY date_trunc('year', s.order_date))""",
    "product_yoy_performance": f"""
        SELECT order_year, product_name, current_sales, avg_sales,
               current_sales - avg_sales AS diff_avg,
               CASE WHEN current_sales > avg_sales THEN 'Above Avg'
                   WHEN current_sales < avg_sales THEN 'Below Avg' ELSE 'Avg' END AS avg_change,
               previous_year_sales, current_sales - previous_year_sales AS diff_previous_year,
               {_growth("current_sales", "previous_year_sales")} AS yoy_growth_percentage,
               CASE WHEN current_sales > previous_year_sales THEN 'Increase'
                   WHEN current_sales < previous_year_sales THEN 'Decrease'
                   ELSE 'No Change' END AS yoy_change
        FROM (SELECT order_year, product_name, revenue AS current_sales,
                     (sum(revenue) OVER (PARTITION BY product_name)
                         // count(revenue) OVER (PARTITION BY product_name))::BIGINT AS avg_sales,
                     lag(revenue) OVER (PARTITION BY product_name ORDER BY order_year)
                         AS previous_year_sales
              FROM ({YEARLY_PRODUCT_REVENUE.format(where="WHERE order_date IS NOT NULL")}))""",
    "surrogate_key": """
        SELECT row_number() OVER (ORDER BY prd_start_dt, prd_key, prd_id) AS version_key,
               prd_start_dt, prd_key, prd_id
        FROM silver_crm_prd_info""",
}

# The declared columns of each table and their types.
COLUMNS: dict[str, list[tuple[str, str]]] = {
    **{
        f"bronze.{table}": [(f.name, f.dataType.simpleString()) for f in schema.fields]
        for table, schema in BRONZE.items()
    },
    "silver.crm_cust_info": [
        ("cst_id", "bigint"), ("cst_key", "string"), ("cst_firstname", "string"),
        ("cst_lastname", "string"), ("cst_marital_status", "string"), ("cst_gndr", "string"),
        ("cst_create_date", "date"),
    ],
    "silver.crm_prd_info": [
        ("prd_id", "bigint"), ("cat_id", "string"), ("prd_key", "string"), ("prd_nm", "string"),
        ("prd_cost", "int"), ("prd_line", "string"), ("prd_start_dt", "date"),
        ("prd_end_dt", "date"),
    ],
    "silver.crm_sales_details": [
        ("sls_ord_num", "string"), ("sls_prd_key", "string"), ("sls_cust_id", "bigint"),
        ("sls_order_dt", "date"), ("sls_ship_dt", "date"), ("sls_due_dt", "date"),
        ("sls_sales", "int"), ("sls_quantity", "int"), ("sls_price", "int"),
    ],
    "silver.erp_loc_a101": [("cid", "string"), ("cntry", "string")],
    "silver.erp_cust_az12": [("cid", "string"), ("bdate", "date"), ("gen", "string")],
    "silver.erp_px_cat_g1v2": [
        ("id", "string"), ("cat", "string"), ("subcat", "string"), ("maintenance", "string"),
    ],
    "gold.customers": [
        ("customer_key", "bigint"), ("customer_id", "bigint"), ("customer_number", "string"),
        ("first_name", "string"), ("last_name", "string"), ("country", "string"),
        ("marital_status", "string"), ("gender", "string"), ("birthdate", "date"),
        ("create_date", "date"),
    ],
    "gold.products": [
        ("product_key", "bigint"), ("product_id", "bigint"), ("product_number", "string"),
        ("product_name", "string"), ("category_id", "string"), ("category", "string"),
        ("subcategory", "string"), ("maintenance", "string"), ("cost", "int"),
        ("product_line", "string"), ("start_date", "date"),
    ],
    "gold.sales": [
        ("order_number", "string"), ("product_key", "bigint"), ("customer_key", "bigint"),
        ("order_date", "date"), ("shipping_date", "date"), ("due_date", "date"),
        ("sales_amount", "int"), ("quantity", "int"), ("price", "int"),
    ],
}


def _as_text(column: str, kind: str) -> str:
    if kind == "timestamp_ntz":
        return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"
    return f"{column}::VARCHAR"


def _table_profile(audit_columns: int = 0) -> str:
    """Profile of all tables; cleaned tables have ``audit_columns`` more than the layers here."""

    def columns(name: str) -> int:
        return len(COLUMNS[name]) + (audit_columns if name.startswith("silver.") else 0)

    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS n_rows, {columns(name)} AS n_columns"
        f" FROM {name.replace('.', '_')}"
        for name in COLUMNS
    )


def _column_profile() -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS table_name, '{column}' AS column_name, '{kind}' AS data_type,"
        f" count({column}) AS n_non_null, count(DISTINCT {column}) AS n_distinct,"
        f" {_as_text(f'min({column})', kind)} AS min_value,"
        f" {_as_text(f'max({column})', kind)} AS max_value FROM {name.replace('.', '_')}"
        for name, columns in COLUMNS.items()
        for column, kind in columns
    )


# Order lines as text, with a word for a number in some of them.
SALES_LINES = """
        SELECT concat_ws(',', sls_ord_num, sls_prd_key, sls_cust_id::VARCHAR,
                   sls_order_dt::VARCHAR, sls_ship_dt::VARCHAR, sls_due_dt::VARCHAR,
                   coalesce(sls_sales::VARCHAR, ''), 'many', coalesce(sls_price::VARCHAR, ''))
                   AS bad_line, 'crm_sales_details.csv' AS delivered_file
        FROM bronze_crm_sales_details WHERE sls_quantity = 13"""


def _load_times() -> str:
    """Rows of each cleaned table under the one load time."""
    return "\nUNION ALL ".join(
        f"SELECT '{table}' AS table_name, TIMESTAMP '2025-01-01 06:30:00' AS dwh_create_date,"
        f" count(*) AS n_rows FROM silver_{table} HAVING count(*) > 0"
        for table in SILVER
    )


def _respelt(column: str, by: str) -> str:
    return (
        f"CASE ({by}) % 3 WHEN 0 THEN lower({column}) WHEN 1 THEN {column} || '  ' ELSE {column} END"
    )


def _same(a: str, b: str) -> str:
    return f"lower(rtrim({a})) = lower(rtrim({b}))"


# Keys and names spelt in several ways, and joins that do not mind.
COLLATED_REVENUE = f"""
        SELECT lower(rtrim(country)) AS country, lower(rtrim(category)) AS category,
               count(*) AS n_lines, sum(sls_sales)::BIGINT AS revenue,
               count(DISTINCT lower(rtrim(product_number))) AS n_products
        FROM (SELECT * REPLACE ({_respelt('sls_prd_key', 'sls_quantity')} AS sls_prd_key)
              FROM silver_crm_sales_details) AS s
        LEFT JOIN (
            SELECT p.prd_key AS product_number, c.cat AS category
            FROM (SELECT * REPLACE ({_respelt('cat_id', 'prd_id')} AS cat_id)
                  FROM silver_crm_prd_info) AS p
            LEFT JOIN (SELECT {_respelt('id', 'ascii(right(id, 1))')} AS id,
                          {_respelt('cat', 'length(subcat)')} AS cat
                       FROM silver_erp_px_cat_g1v2) AS c ON {_same('p.cat_id', 'c.id')}
            WHERE p.prd_end_dt IS NULL
        ) AS products ON {_same('s.sls_prd_key', 'product_number')}
        LEFT JOIN (
            SELECT c.cst_id AS customer_id, l.cntry AS country
            FROM silver_crm_cust_info AS c
            LEFT JOIN (SELECT cid FROM silver_erp_cust_az12) AS e
                ON {_same('c.cst_key', 'e.cid')}
            LEFT JOIN (SELECT {_respelt('cid', 'ascii(right(cid, 1))')} AS cid,
                          {_respelt('cntry', 'ascii(right(cid, 1)) + 1')} AS cntry
                       FROM silver_erp_loc_a101) AS l ON {_same('c.cst_key', 'l.cid')}
        ) AS customers ON s.sls_cust_id = customer_id
        GROUP BY 1, 2"""

COLLATED_VERSIONS = f"""
        SELECT prd_id, lower(rtrim(substr(spelt, 7))) AS prd_key, prd_start_dt::DATE AS prd_start_dt,
               (lead(prd_start_dt) OVER (PARTITION BY lower(rtrim(spelt))
                   ORDER BY prd_start_dt NULLS FIRST, prd_id) - INTERVAL 1 DAY)::DATE AS prd_end_dt
        FROM (SELECT prd_id, prd_start_dt, {_respelt('prd_key', 'prd_id')} AS spelt
              FROM bronze_crm_prd_info)"""


def oracle_queries() -> dict[str, str]:
    """SQL for every registered query, by its name."""
    result = {name: with_layers(f"SELECT * FROM {name}") for name in LAYERS}
    for table in BRONZE:
        blank = ", nullif(gen, '') AS gen" if table == "erp_cust_az12" else ""
        columns = f"* EXCLUDE (gen){blank}" if blank else "*"
        result[f"csv_{table}"] = with_layers(f"SELECT {columns} FROM bronze_{table}")
    result["csv_rejected_lines"] = with_layers(SALES_LINES)
    for layer, tables in (("silver", SILVER), ("gold", GOLD)):
        for table in tables:
            result[f"loaded_{layer}_{table}"] = with_layers(f"SELECT * FROM {layer}_{table}")
    result["full_load"] = with_layers(_table_profile(audit_columns=1))
    result["silver_load_times"] = with_layers(_load_times())
    result["collated_revenue"] = with_layers(COLLATED_REVENUE)
    result["collated_product_versions"] = with_layers(COLLATED_VERSIONS)
    result["table_profile"] = with_layers(_table_profile())
    result["column_profile"] = with_layers(_column_profile())
    result.update({name: with_layers(sql) for name, sql in QUESTIONS.items()})
    return result


assert set(GOLD) == {name.split(".")[1] for name in COLUMNS if name.startswith("gold.")}
