"""A warehouse over raw tables whose layers are built when first asked for."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from ..functions import collated
from ..schemas import BRONZE, GOLD
from ..session import scratch, store, unsorted_rows, workspace
from ..sources.sample_data import SAMPLE_TABLES, raw_tables
from ..sources.tables import CODEC, exists, footer_scan, state
from . import gold, silver


class Warehouse:
    """Tables by name: ``bronze.*``, ``silver.*`` and ``gold.*``.

    The dimensions and the fact are stored once in the shared folder, so all
    questions see one set of surrogate keys and scan only the columns they
    need. Cleaned tables feed them without being stored in between; those given as
    ``cleaned`` are taken as they are. Under a ``collation`` the star schema has its
    strings under it, order numbers excepted, which lay out the fact.
    """

    def __init__(
        self,
        raw: Mapping[str, DataFrame],
        as_of: date | None = None,
        collation: str | None = None,
        cleaned: Mapping[str, DataFrame] | None = None,
    ):
        self._tables: dict[str, DataFrame] = {f"bronze.{t}": df for t, df in raw.items()}
        self._tables.update({f"silver.{t}": df for t, df in (cleaned or {}).items()})
        self._collation = collation
        self._stored: dict[str, DataFrame] = {}
        self._fact: DataFrame | None = None
        self._fact_path = ""
        self._as_of = as_of

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self._build(name)
        return self._tables[name]

    def fact(self) -> DataFrame:
        """The sales fact as it is laid out: with the order year, by which it is partitioned."""
        self.table("gold.sales")
        return self._fact

    def footers(self, name: str) -> DataFrame:
        """The table as a scan whose row count comes from file footers, if it is stored."""
        df = self.table(name)
        if not name.startswith("gold."):
            return df
        if name == "gold.sales":
            return footer_scan(df.sparkSession, self._fact_path, self._fact.schema).drop(gold.YEAR)
        return footer_scan(df.sparkSession, df.inputFiles()[0].rpartition("/")[0], df.schema)

    def dated_footers(self) -> DataFrame:
        """Dated lines of the fact as a scan whose first and last dates come from file footers.

        Every file of a year has a date, those of undated lines are left out.
        """
        self.table("gold.sales")
        scan = footer_scan(self._fact.sparkSession, self._fact_path, self._fact.schema)
        return scan.where(scan[gold.YEAR].isNotNull())

    def stored(self, name: str) -> DataFrame:
        """The table as a stored one, for whoever scans it many times.

        What is built after that reads it there and does not derive it again.
        """
        if name.startswith("gold."):
            return self.table(name)
        if name not in self._stored:
            with unsorted_rows(self.table(name).sparkSession):
                self._stored[name] = store(self.table(name), name.replace(".", "-"), codec=CODEC)
            self._tables[name] = self._stored[name]
        return self._stored[name]

    def _kept(self, build: Callable[..., DataFrame], parts: list[DataFrame], label: str) -> DataFrame:
        """A table stored for good, without what was stored on the way to it."""
        with scratch(parts[0].sparkSession):
            return store(build(*parts), label, keep=True)

    def _build(self, name: str) -> DataFrame:
        t = self.table
        match name:
            case "silver.crm_cust_info":
                return silver.silver_customers(t("bronze.crm_cust_info"))
            case "silver.crm_prd_info":
                return silver.silver_products(t("bronze.crm_prd_info"))
            case "silver.crm_sales_details":
                return silver.silver_sales(t("bronze.crm_sales_details"))
            case "silver.erp_cust_az12":
                return silver.silver_erp_customers(t("bronze.erp_cust_az12"), self._as_of)
            case "silver.erp_loc_a101":
                return silver.silver_locations(t("bronze.erp_loc_a101"))
            case "silver.erp_px_cat_g1v2":
                return silver.silver_categories(t("bronze.erp_px_cat_g1v2"))
            case "gold.customers":
                names = ("crm_cust_info", "erp_cust_az12", "erp_loc_a101")
                parts = [collated(t(f"silver.{n}"), self._collation) for n in names]
                return self._kept(gold.gold_customers, parts, "gold-customers")
            case "gold.products":
                names = ("crm_prd_info", "erp_px_cat_g1v2")
                parts = [collated(t(f"silver.{n}"), self._collation) for n in names]
                return self._kept(gold.gold_products, parts, "gold-products")
            case "gold.sales":
                with ThreadPoolExecutor() as pool:  # neither dimension needs the other
                    list(pool.map(t, ("gold.products", "gold.customers")))
                lines = collated(t("silver.crm_sales_details"), self._collation, "sls_prd_key")
                sales = gold.gold_sales(lines, t("gold.products"), t("gold.customers"))
                self._fact, self._fact_path = gold.store_fact(sales, "gold_sales")
                return self._fact.drop(gold.YEAR)
        raise KeyError(name)


TABLE_NAMES = (
    *(f"bronze.{t}" for t in BRONZE),
    *(f"silver.{t}" for t in BRONZE),
    *(f"gold.{t}" for t in GOLD),
)

_open: dict[tuple, Warehouse] = {}


def open_warehouse(spark: SparkSession, folder: str, as_of: date | None = None) -> Warehouse:
    """The warehouse over the sample tables in ``folder``.

    The same one for the whole application, until one of its tables changes or
    the folder of stored tables is cleared.
    """
    files = tuple(state(spark, f"{folder}/{name}.parquet") for name in SAMPLE_TABLES)
    key = (spark.sparkContext.applicationId, folder, as_of, files)
    if key not in _open or not exists(spark, workspace(spark)):
        _open[key] = Warehouse(raw_tables(spark, folder), as_of)
    return _open[key]
