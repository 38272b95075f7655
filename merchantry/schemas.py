"""Declared columns of the raw and the cleaned tables.

Identifiers are BIGINT, wide enough for any number of customers or products;
amounts, prices and quantities of a single line are INT.
"""

from pyspark.sql.types import (
    DataType,
    DateType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

ID, INT, TEXT, DATE = LongType(), IntegerType(), StringType(), DateType()
DATETIME, STAMP = TimestampNTZType(), TimestampType()

AUDIT_COLUMN = "dwh_create_date"


def _columns(**kinds: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in kinds.items()])


def _audited(columns: StructType) -> StructType:
    return StructType([*columns.fields, StructField(AUDIT_COLUMN, STAMP)])


BRONZE = {
    "crm_cust_info": _columns(
        cst_id=ID,
        cst_key=TEXT,
        cst_firstname=TEXT,
        cst_lastname=TEXT,
        cst_marital_status=TEXT,
        cst_gndr=TEXT,
        cst_create_date=DATE,
    ),
    "crm_prd_info": _columns(
        prd_id=ID,
        prd_key=TEXT,
        prd_nm=TEXT,
        prd_cost=INT,
        prd_line=TEXT,
        prd_start_dt=DATETIME,
        prd_end_dt=DATETIME,
    ),
    "crm_sales_details": _columns(
        sls_ord_num=TEXT,
        sls_prd_key=TEXT,
        sls_cust_id=ID,
        sls_order_dt=INT,
        sls_ship_dt=INT,
        sls_due_dt=INT,
        sls_sales=INT,
        sls_quantity=INT,
        sls_price=INT,
    ),
    "erp_loc_a101": _columns(cid=TEXT, cntry=TEXT),
    "erp_cust_az12": _columns(cid=TEXT, bdate=DATE, gen=TEXT),
    "erp_px_cat_g1v2": _columns(id=TEXT, cat=TEXT, subcat=TEXT, maintenance=TEXT),
}

# The cleaned tables keep the raw columns, with these exceptions, and gain the load time.
SILVER = {
    **{table: _audited(columns) for table, columns in BRONZE.items()},
    "crm_prd_info": _audited(
        _columns(
            prd_id=ID,
            cat_id=TEXT,
            prd_key=TEXT,
            prd_nm=TEXT,
            prd_cost=INT,
            prd_line=TEXT,
            prd_start_dt=DATE,
            prd_end_dt=DATE,
        )
    ),
    "crm_sales_details": _audited(
        _columns(
            sls_ord_num=TEXT,
            sls_prd_key=TEXT,
            sls_cust_id=ID,
            sls_order_dt=DATE,
            sls_ship_dt=DATE,
            sls_due_dt=DATE,
            sls_sales=INT,
            sls_quantity=INT,
            sls_price=INT,
        )
    ),
}

GOLD = {
    "customers": _columns(
        customer_key=ID,
        customer_id=ID,
        customer_number=TEXT,
        first_name=TEXT,
        last_name=TEXT,
        country=TEXT,
        marital_status=TEXT,
        gender=TEXT,
        birthdate=DATE,
        create_date=DATE,
    ),
    "products": _columns(
        product_key=ID,
        product_id=ID,
        product_number=TEXT,
        product_name=TEXT,
        category_id=TEXT,
        category=TEXT,
        subcategory=TEXT,
        maintenance=TEXT,
        cost=INT,
        product_line=TEXT,
        start_date=DATE,
    ),
    "sales": _columns(
        order_number=TEXT,
        product_key=ID,
        customer_key=ID,
        order_date=DATE,
        shipping_date=DATE,
        due_date=DATE,
        sales_amount=INT,
        quantity=INT,
        price=INT,
    ),
}
