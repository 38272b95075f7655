"""The warehouse layers as SQL common table expressions over the sample tables."""

from __future__ import annotations

import re

# Each expression may use those before it.
LAYERS: dict[str, str] = {
    "bronze_crm_cust_info": """
        SELECT CASE WHEN c_custkey % 97 <> 96 THEN c_custkey END AS cst_id,
               'AW' || lpad(c_custkey::VARCHAR, greatest(8, length(c_custkey::VARCHAR))::INT, '0')
                   AS cst_key,
               '  ' || substr(c_name, 1, 8) AS cst_firstname,
               substr(c_name, 10, 9) || ' ' AS cst_lastname,
               CASE c_custkey % 4 WHEN 0 THEN 'S' WHEN 1 THEN ' m ' WHEN 2 THEN 'M' END
                   AS cst_marital_status,
               CASE c_custkey % 5 WHEN 0 THEN 'F' WHEN 1 THEN ' m' WHEN 2 THEN 'M ' WHEN 3 THEN 'f'
                   END AS cst_gndr,
               DATE '2010-01-01' + (c_custkey % 1500)::INT AS cst_create_date
        FROM customer
        UNION ALL
        SELECT c_custkey,
               'AW' || lpad(c_custkey::VARCHAR, greatest(8, length(c_custkey::VARCHAR))::INT, '0'),
               NULL, substr(c_name, 10, 9), 'S', 'M',
               DATE '2009-01-01' + (c_custkey % 300)::INT
        FROM customer WHERE c_custkey % 10 = 3""",
    "bronze_crm_prd_info": """
        SELECT p_partkey * 3 + v AS prd_id,
               substr(p_type, 1, 2) || '-' || lpad(split_part(p_brand, '#', 2),
                   greatest(2, length(split_part(p_brand, '#', 2)))::INT, '0') || '-'
                   || lpad(p_partkey::VARCHAR, greatest(6, length(p_partkey::VARCHAR))::INT, '0')
                   AS prd_key,
               p_name || ' ' || (p_partkey % 50)::VARCHAR AS prd_nm,
               CASE WHEN p_partkey % 41 <> 7 THEN (floor(p_retailprice) + v * 10)::INT END
                   AS prd_cost,
               CASE p_size % 6 WHEN 0 THEN 'R ' WHEN 1 THEN 'm ' WHEN 2 THEN 'S' WHEN 3 THEN 'T '
                   END AS prd_line,
               (DATE '1994-07-01' + (365 * v)::INT)::TIMESTAMP AS prd_start_dt,
               NULL::TIMESTAMP AS prd_end_dt
        FROM part, (SELECT unnest([0, 1, 2]) AS v) AS versions
        WHERE v <= p_partkey % 3""",
    "bronze_crm_sales_details": """
        SELECT 'SO' || l_orderkey::VARCHAR AS sls_ord_num,
               CASE WHEN l_orderkey % 307 = 9 THEN 'ZZZZZZ' ELSE
                   lpad(l_partkey::VARCHAR, greatest(6, length(l_partkey::VARCHAR))::INT, '0') END
                   AS sls_prd_key,
               o_custkey AS sls_cust_id,
               CASE l_orderkey % 211 WHEN 5 THEN 0 WHEN 6 THEN 32154
                   ELSE strftime(o_orderdate, '%Y%m%d')::INT END AS sls_order_dt,
               strftime(l_shipdate, '%Y%m%d')::INT AS sls_ship_dt,
               strftime(l_shipdate + INTERVAL 7 DAY, '%Y%m%d')::INT AS sls_due_dt,
               CASE l_orderkey % 103 WHEN 1 THEN NULL WHEN 2 THEN -5 WHEN 3 THEN 17
                   ELSE floor(l_quantity)::INT * floor(l_extendedprice / l_quantity)::INT END
                   AS sls_sales,
               floor(l_quantity)::INT AS sls_quantity,
               CASE l_orderkey % 101 WHEN 1 THEN NULL
                   WHEN 2 THEN -floor(l_extendedprice / l_quantity)::INT
                   ELSE floor(l_extendedprice / l_quantity)::INT END AS sls_price
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "bronze_erp_loc_a101": """
        SELECT 'AW-' || lpad(c_custkey::VARCHAR, greatest(8, length(c_custkey::VARCHAR))::INT, '0')
                   AS cid,
               CASE n_nationkey WHEN 0 THEN 'DE' WHEN 1 THEN 'US' WHEN 2 THEN 'USA ' WHEN 3 THEN '  '
                   WHEN 4 THEN NULL ELSE ' ' || n_name || ' ' END AS cntry
        FROM customer JOIN nation ON c_nationkey = n_nationkey
        WHERE c_custkey % 30 <> 11""",
    "bronze_erp_cust_az12": """
        SELECT CASE WHEN c_custkey % 3 = 0 THEN 'NAS' ELSE '' END || 'AW'
                   || lpad(c_custkey::VARCHAR, greatest(8, length(c_custkey::VARCHAR))::INT, '0')
                   AS cid,
               CASE c_custkey % 50 WHEN 49 THEN DATE '2999-01-01' WHEN 48 THEN NULL
                   ELSE DATE '1940-01-01' + ((c_custkey * 7) % 20000)::INT END AS bdate,
               CASE c_custkey % 7 WHEN 0 THEN 'F' WHEN 1 THEN ' female' WHEN 2 THEN 'M'
                   WHEN 3 THEN 'Male ' WHEN 4 THEN '' END AS gen
        FROM customer WHERE c_custkey % 20 <> 7""",
    "bronze_erp_px_cat_g1v2": """
        SELECT DISTINCT substr(p_type, 1, 2) || '_' || lpad(split_part(p_brand, '#', 2),
                   greatest(2, length(split_part(p_brand, '#', 2)))::INT, '0') AS id,
               p_type AS cat, p_type || ' ' || p_brand AS subcat,
               CASE WHEN p_brand LIKE '%1%' THEN 'Yes' ELSE 'No' END AS maintenance
        FROM part WHERE p_brand <> 'Brand#7'""",
    "silver_crm_cust_info": """
        SELECT cst_id, cst_key, trim(cst_firstname) AS cst_firstname,
               trim(cst_lastname) AS cst_lastname,
               CASE upper(trim(cst_marital_status)) WHEN 'S' THEN 'Single' WHEN 'M' THEN 'Married'
                   ELSE 'n/a' END AS cst_marital_status,
               CASE upper(trim(cst_gndr)) WHEN 'F' THEN 'Female' WHEN 'M' THEN 'Male'
                   ELSE 'n/a' END AS cst_gndr,
               cst_create_date
        FROM bronze_crm_cust_info WHERE cst_id IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY cst_id
            ORDER BY cst_create_date DESC NULLS LAST, cst_key NULLS FIRST,
                cst_firstname NULLS FIRST, cst_lastname NULLS FIRST) = 1""",
    "silver_crm_prd_info": """
        SELECT prd_id, replace(substr(prd_key, 1, 5), '-', '_') AS cat_id,
               substr(prd_key, 7) AS prd_key, prd_nm, coalesce(prd_cost, 0) AS prd_cost,
               CASE upper(trim(prd_line)) WHEN 'M' THEN 'Mountain' WHEN 'R' THEN 'Road'
                   WHEN 'S' THEN 'Other Sales' WHEN 'T' THEN 'Touring' ELSE 'n/a' END AS prd_line,
               prd_start_dt::DATE AS prd_start_dt,
               (lead(prd_start_dt) OVER (PARTITION BY bronze_crm_prd_info.prd_key
                   ORDER BY bronze_crm_prd_info.prd_start_dt NULLS FIRST, prd_id,
                   prd_nm NULLS FIRST, bronze_crm_prd_info.prd_cost NULLS FIRST,
                   bronze_crm_prd_info.prd_line NULLS FIRST)
                   - INTERVAL 1 DAY)::DATE AS prd_end_dt
        FROM bronze_crm_prd_info""",
    "silver_crm_sales_details": """
        SELECT sls_ord_num, sls_prd_key, sls_cust_id,
               CASE WHEN sls_order_dt = 0 OR length(sls_order_dt::VARCHAR) <> 8 THEN NULL
                   ELSE try_strptime(sls_order_dt::VARCHAR, '%Y%m%d')::DATE END AS sls_order_dt,
               CASE WHEN sls_ship_dt = 0 OR length(sls_ship_dt::VARCHAR) <> 8 THEN NULL
                   ELSE try_strptime(sls_ship_dt::VARCHAR, '%Y%m%d')::DATE END AS sls_ship_dt,
               CASE WHEN sls_due_dt = 0 OR length(sls_due_dt::VARCHAR) <> 8 THEN NULL
                   ELSE try_strptime(sls_due_dt::VARCHAR, '%Y%m%d')::DATE END AS sls_due_dt,
               CASE WHEN b.sls_sales IS NULL OR b.sls_sales <= 0
                        OR b.sls_sales <> sls_quantity * abs(b.sls_price)
                   THEN sls_quantity * abs(b.sls_price) ELSE b.sls_sales END AS sls_sales,
               sls_quantity,
               CASE WHEN b.sls_price IS NULL OR b.sls_price <= 0
                   THEN b.sls_sales // nullif(sls_quantity, 0) ELSE b.sls_price END AS sls_price
        FROM bronze_crm_sales_details AS b""",
    "silver_erp_cust_az12": """
        SELECT CASE WHEN cid LIKE 'NAS%' THEN substr(cid, 4) ELSE cid END AS cid,
               CASE WHEN bdate > DATE '2025-01-01' THEN NULL ELSE bdate END AS bdate,
               CASE WHEN upper(trim(gen)) IN ('F', 'FEMALE') THEN 'Female'
                   WHEN upper(trim(gen)) IN ('M', 'MALE') THEN 'Male' ELSE 'n/a' END AS gen
        FROM bronze_erp_cust_az12""",
    "silver_erp_loc_a101": """
        SELECT replace(cid, '-', '') AS cid,
               CASE WHEN trim(cntry) = 'DE' THEN 'Germany'
                   WHEN trim(cntry) IN ('US', 'USA') THEN 'United States'
                   WHEN cntry IS NULL OR trim(cntry) = '' THEN 'n/a'
                   ELSE trim(cntry) END AS cntry
        FROM bronze_erp_loc_a101""",
    "silver_erp_px_cat_g1v2": "SELECT id, cat, subcat, maintenance FROM bronze_erp_px_cat_g1v2",
    "gold_customers": """
        SELECT row_number() OVER (ORDER BY cst_id, cntry NULLS FIRST,
                   CASE WHEN cst_gndr <> 'n/a' THEN cst_gndr ELSE coalesce(gen, 'n/a') END,
                   bdate NULLS FIRST) AS customer_key,
               cst_id AS customer_id, cst_key AS customer_number, cst_firstname AS first_name,
               cst_lastname AS last_name, cntry AS country, cst_marital_status AS marital_status,
               CASE WHEN cst_gndr <> 'n/a' THEN cst_gndr ELSE coalesce(gen, 'n/a') END AS gender,
               bdate AS birthdate, cst_create_date AS create_date
        FROM silver_crm_cust_info
        LEFT JOIN silver_erp_cust_az12 AS e ON cst_key = e.cid
        LEFT JOIN silver_erp_loc_a101 AS l ON cst_key = l.cid""",
    "gold_products": """
        SELECT row_number() OVER (ORDER BY prd_start_dt NULLS FIRST, prd_key NULLS FIRST, prd_id,
                   prd_nm NULLS FIRST, cat_id, cat NULLS FIRST, subcat NULLS FIRST,
                   maintenance NULLS FIRST, prd_cost, prd_line) AS product_key,
               prd_id AS product_id, prd_key AS product_number, prd_nm AS product_name,
               cat_id AS category_id, cat AS category, subcat AS subcategory, maintenance,
               prd_cost AS cost, prd_line AS product_line, prd_start_dt AS start_date
        FROM silver_crm_prd_info LEFT JOIN silver_erp_px_cat_g1v2 ON cat_id = id
        WHERE prd_end_dt IS NULL""",
    "gold_sales": """
        SELECT sls_ord_num AS order_number, product_key, customer_key, sls_order_dt AS order_date,
               sls_ship_dt AS shipping_date, sls_due_dt AS due_date, sls_sales AS sales_amount,
               sls_quantity AS quantity, sls_price AS price
        FROM silver_crm_sales_details
        LEFT JOIN gold_products ON sls_prd_key = product_number
        LEFT JOIN gold_customers ON sls_cust_id = customer_id""",
}


def with_layers(body: str, extra: dict[str, str] | None = None) -> str:
    """``body`` below the layers it uses, directly or through another layer."""
    known = {**LAYERS, **(extra or {})}
    needed: set[str] = set()
    waiting = [body]
    while waiting:
        text = waiting.pop()
        for name in known.keys() - needed:
            if re.search(rf"\b{name}\b", text):
                needed.add(name)
                waiting.append(known[name])
    if not needed:
        return body
    parts = [f"{name} AS ({known[name]}\n)" for name in known if name in needed]
    return "WITH " + ",\n".join(parts) + "\n" + body
