from datetime import date, datetime

import pytest
from helpers import bronze_rows, rows_of

from merchantry.plans import silver


def customer(**columns):
    return {"cst_id": 1, "cst_key": "AW1", "cst_create_date": date(2020, 1, 1), **columns}


def test_customers_keep_the_latest_row_of_each_id(spark):
    df = silver.silver_customers(
        bronze_rows(
            spark,
            "crm_cust_info",
            customer(cst_firstname="old", cst_create_date=date(2019, 1, 1)),
            customer(cst_firstname=" new "),
            customer(cst_firstname="undated", cst_create_date=None),
            customer(cst_id=None, cst_firstname="nobody"),
            customer(cst_id=2, cst_firstname=None, cst_create_date=None),
        )
    )
    assert sorted((r.cst_id, r.cst_firstname) for r in df.collect()) == [(1, "new"), (2, None)]


def test_customers_with_equal_dates_are_told_apart_by_key(spark):
    rows = [customer(cst_key=k) for k in ("AW3", "AW1", "AW2")]
    for order in (rows, rows[::-1]):
        df = silver.silver_customers(bronze_rows(spark, "crm_cust_info", *order))
        assert [r.cst_key for r in df.collect()] == ["AW1"]


@pytest.mark.parametrize(
    "code, label",
    [("S", "Single"), (" s ", "Single"), ("M", "Married"), ("m", "Married"), (None, "n/a"),
     ("X", "n/a"), ("", "n/a")],
)
def test_marital_status(spark, code, label):
    df = bronze_rows(spark, "crm_cust_info", customer(cst_marital_status=code))
    assert silver.silver_customers(df).first().cst_marital_status == label


@pytest.mark.parametrize(
    "code, label", [("F", "Female"), (" f", "Female"), ("M ", "Male"), (None, "n/a"), ("D", "n/a")]
)
def test_crm_gender(spark, code, label):
    df = bronze_rows(spark, "crm_cust_info", customer(cst_gndr=code))
    assert silver.silver_customers(df).first().cst_gndr == label


def test_trim_takes_spaces_only(spark):
    df = bronze_rows(spark, "crm_cust_info", customer(cst_lastname=" a\t "))
    assert silver.silver_customers(df).first().cst_lastname == "a\t"


# A few delivered product rows.
HELMET, PEDAL = "AC-HE-HL-U509-R", "CO-PE-PD-M282"
DELIVERED = [
    (210, "CO-RF-FR-R92B-58", "HL Road Frame - Black- 58", None, "R ", 2003, None),
    (212, HELMET, "Sport-100 Helmet- Red", 12, "S ", 2011, datetime(2007, 12, 28)),
    (213, HELMET, "Sport-100 Helmet- Red", 14, "S ", 2012, datetime(2008, 12, 27)),
    (214, HELMET, "Sport-100 Helmet- Red", 13, "S ", 2013, None),
    (348, "BI-MB-BK-M82B-38", "Mountain-100 Black- 38", 1898, "M ", 2011, datetime(2007, 12, 28)),
    (542, PEDAL, "LL Mountain Pedal", 18, "M ", 2013, None),
]


def delivered_products(spark):
    names = ["prd_id", "prd_key", "prd_nm", "prd_cost", "prd_line", "prd_start_dt", "prd_end_dt"]
    rows = [dict(zip(names, (*r[:5], datetime(r[5], 7, 1), r[6]))) for r in DELIVERED]
    return bronze_rows(spark, "crm_prd_info", *rows)


def test_products(spark):
    found = {r.prd_id: r for r in silver.silver_products(delivered_products(spark)).collect()}
    frame, helmet = found[210], found[212]
    assert (frame.cat_id, frame.prd_key, frame.prd_cost) == ("CO_RF", "FR-R92B-58", 0)
    assert (frame.prd_line, frame.prd_start_dt) == ("Road", date(2003, 7, 1))
    assert (helmet.cat_id, helmet.prd_key, helmet.prd_line) == ("AC_HE", "HL-U509-R", "Other Sales")
    ends = {i: found[i].prd_end_dt for i in found}
    assert ends == {
        210: None, 212: date(2012, 6, 30), 213: date(2013, 6, 30), 214: None, 348: None, 542: None
    }


@pytest.mark.parametrize(
    "code, label",
    [("M", "Mountain"), (" r ", "Road"), ("S ", "Other Sales"), ("t", "Touring"), (None, "n/a"),
     ("Z", "n/a")],
)
def test_product_line(spark, code, label):
    row = {"prd_id": 1, "prd_key": "AA-BB-1", "prd_line": code}
    assert silver.silver_products(bronze_rows(spark, "crm_prd_info", row)).first().prd_line == label


def test_versions_of_one_category_and_key_only_follow_each_other(spark):
    rows = [
        {"prd_id": 1, "prd_key": "AA-BB-X", "prd_start_dt": datetime(2020, 1, 1)},
        {"prd_id": 2, "prd_key": "CC-DD-X", "prd_start_dt": datetime(2021, 1, 1)},
    ]
    df = silver.silver_products(bronze_rows(spark, "crm_prd_info", *rows))
    assert {r.prd_end_dt for r in df.collect()} == {None}


def test_the_last_hour_of_a_version_does_not_matter(spark):
    rows = [
        {"prd_id": 1, "prd_key": "AA-BB-X", "prd_start_dt": datetime(2020, 1, 1, 9)},
        {"prd_id": 2, "prd_key": "AA-BB-X", "prd_start_dt": datetime(2020, 3, 1, 1)},
        {"prd_id": 3, "prd_key": "AA-BB-X", "prd_start_dt": None},
    ]
    df = silver.silver_products(bronze_rows(spark, "crm_prd_info", *rows))
    assert {r.prd_id: r.prd_end_dt for r in df.collect()} == {
        3: date(2019, 12, 31), 1: date(2020, 2, 29), 2: None
    }


@pytest.mark.parametrize(
    "sales, quantity, price, repaired",
    [
        (20, 2, 10, (20, 10)),
        (None, 2, 10, (20, 10)),
        (0, 2, 10, (20, 10)),
        (-5, 2, 10, (20, 10)),
        (17, 2, 10, (20, 10)),
        (20, 2, -10, (20, 10)),
        # The price is derived from the delivered sales, not from the repaired ones.
        (17, 2, -10, (20, 8)),
        (None, 2, -10, (20, None)),
        (-5, 2, 0, (0, -2)),
        # Without a price there is nothing to compare sales with.
        (21, 2, None, (21, 10)),
        (None, 2, None, (None, None)),
        (-5, 2, None, (None, -2)),
        (20, 0, None, (20, None)),
        (20, 0, 10, (0, 10)),
        (20, None, 10, (20, 10)),
    ],
)
def test_amount_and_price_repair(spark, sales, quantity, price, repaired):
    row = {"sls_sales": sales, "sls_quantity": quantity, "sls_price": price}
    found = silver.silver_sales(bronze_rows(spark, "crm_sales_details", row)).first()
    assert (found.sls_sales, found.sls_price) == repaired


def test_sales_dates(spark):
    row = {"sls_order_dt": 20101229, "sls_ship_dt": 0, "sls_due_dt": 20101350}
    found = silver.silver_sales(bronze_rows(spark, "crm_sales_details", row)).first()
    assert found[3:6] == (date(2010, 12, 29), None, None)


def test_erp_customers(spark):
    rows = [
        {"cid": "NASAW1", "bdate": date(1980, 1, 1), "gen": " f "},
        {"cid": "AW2", "bdate": date(2025, 1, 2), "gen": "Female"},
        {"cid": "nasAW3", "bdate": date(2025, 1, 1), "gen": "MALE"},
        {"cid": None, "bdate": None, "gen": ""},
        {"cid": "NAS", "bdate": None, "gen": "m"},
    ]
    df = silver.silver_erp_customers(
        bronze_rows(spark, "erp_cust_az12", *rows), as_of=date(2025, 1, 1)
    )
    assert rows_of(df) == [
        ("AW1", date(1980, 1, 1), "Female"),
        ("AW2", None, "Female"),
        ("nasAW3", date(2025, 1, 1), "Male"),
        (None, None, "n/a"),
        ("", None, "Male"),
    ]


def test_birthdates_are_compared_with_now_by_default(spark):
    rows = [{"cid": "1", "bdate": date(2999, 1, 1)}, {"cid": "2", "bdate": date(1999, 1, 1)}]
    df = silver.silver_erp_customers(bronze_rows(spark, "erp_cust_az12", *rows))
    assert [r.bdate for r in df.collect()] == [None, date(1999, 1, 1)]


def test_locations(spark):
    pairs = [("A-1-2", "DE"), ("B", " US "), ("C", "USA"), ("D", "  "), ("E", None), ("F", ""),
             ("G", " France "), ("H", "de")]
    rows = [{"cid": c, "cntry": n} for c, n in pairs]
    assert rows_of(silver.silver_locations(bronze_rows(spark, "erp_loc_a101", *rows))) == [
        ("A12", "Germany"), ("B", "United States"), ("C", "United States"), ("D", "n/a"),
        ("E", "n/a"), ("F", "n/a"), ("G", "France"), ("H", "de"),
    ]


def test_categories_are_copied(spark):
    row = {"id": "AC_BR", "cat": "Accessories", "subcat": "Bike Racks", "maintenance": "Yes"}
    df = silver.silver_categories(bronze_rows(spark, "erp_px_cat_g1v2", row))
    assert rows_of(df) == [("AC_BR", "Accessories", "Bike Racks", "Yes")]


def test_audit_column(spark):
    stamp = datetime(2024, 5, 6, 7, 8)
    assert silver.with_audit(spark.range(1), stamp).first().dwh_create_date == stamp
    assert silver.with_audit(spark.range(1)).first().dwh_create_date is not None
