"""Raw layer: six CSV files loaded as they are, into typed tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..schemas import BRONZE
from .tables import Release, create_database, read_table, table_path

# The file each table is loaded from, below the source folder.
SOURCE_FILES = {
    "crm_cust_info": "source_crm/cust_info.csv",
    "crm_prd_info": "source_crm/prd_info.csv",
    "crm_sales_details": "source_crm/sales_details.csv",
    "erp_loc_a101": "source_erp/loc_a101.csv",
    "erp_cust_az12": "source_erp/cust_az12.csv",
    "erp_px_cat_g1v2": "source_erp/px_cat_g1v2.csv",
}

# Of a malformed line its text, the file it stands in, and where the part of the file begins
# that was read with it.
BAD_LINE, BAD_FILE, BAD_BLOCK = "bad_line", "bad_file", "bad_block"
REJECT_COLUMNS = (
    StructField(BAD_LINE, StringType()),
    StructField(BAD_FILE, StringType()),
    StructField(BAD_BLOCK, LongType()),
)


class TooManyErrors(RuntimeError):
    """More malformed lines than the load allows; the old table is untouched."""


@dataclass(frozen=True)
class LoadCount:
    """Lines of one load."""

    loaded: int
    rejected: int


def read_raw_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Comma-separated lines below one header line, mapped to ``schema`` by position.

    Nothing is quoted, an empty field is NULL, spaces are kept. A line that
    does not fit the schema keeps its text in ``bad_line``.
    """
    return (
        spark.read.schema(StructType([*schema.fields, StructField(BAD_LINE, StringType())]))
        .option("header", True)
        .option("enforceSchema", True)
        .option("quote", "")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", BAD_LINE)
        .csv(path)
    )


def _observed_lines(
    spark: SparkSession, source: str, schema: StructType
) -> tuple[DataFrame, Observation]:
    """Lines of a file as they are stored, and counts that are there once they are written.

    The place of a bad line comes from the metadata of its file, so the file is
    still read once.
    """
    seen = Observation()
    is_bad = F.col(BAD_LINE).isNotNull()
    lines = read_raw_csv(spark, source, schema).select(
        "*",
        F.when(is_bad, F.col("_metadata.file_path")).alias(BAD_FILE),
        F.when(is_bad, F.col("_metadata.file_block_start")).alias(BAD_BLOCK),
    )
    counted = lines.observe(
        seen, F.count_if(~is_bad).alias("loaded"), F.count_if(is_bad).alias("rejected")
    )
    return counted, seen


def _checked(source: str, seen: Observation, max_errors: int | None) -> LoadCount:
    counts = LoadCount(**seen.get)
    if max_errors is not None and counts.rejected > max_errors:
        raise TooManyErrors(f"{source}: {counts.rejected} malformed lines, {max_errors} allowed")
    return counts


def load_raw_table(
    spark: SparkSession,
    source: str,
    target: str,
    schema: StructType,
    max_errors: int | None = None,
) -> LoadCount:
    """Full refresh of one raw table; any number of malformed lines, or ``max_errors`` of them.

    The file is read once. Bad lines stay in the table, as text in a column of
    their own that readers filter on, with their file and place; these are empty
    otherwise and cost next to nothing. The counts are observed while the write
    runs.
    """
    lines, seen = _observed_lines(spark, source, schema)
    folder, _, name = target.rstrip("/").rpartition("/")
    with Release(spark, folder) as release:
        release.write(lines, name)
        counts = _checked(source, seen, max_errors)
        release.publish()
    return counts


def load_bronze(
    spark: SparkSession,
    source_dir: str,
    bronze_dir: str,
    max_errors: int | None = None,
    files: Mapping[str, str] = SOURCE_FILES,
) -> dict[str, LoadCount]:
    """Load the six raw files side by side and release the tables at once.

    An error ends the load and is raised; the six tables are the old ones then.
    All malformed lines are kept and counted; a bound is for the caller to state,
    and holds for each file.
    """
    sources = {table: f"{source_dir}/{files[table]}" for table in BRONZE}
    seen: dict[str, Observation] = {}

    def lines(table: str) -> DataFrame:
        found, seen[table] = _observed_lines(spark, sources[table], BRONZE[table])
        return found

    with Release(spark, bronze_dir) as release:
        release.write_all({table: partial(lines, table) for table in BRONZE})
        counts = {t: _checked(sources[t], seen[t], max_errors) for t in BRONZE}
        release.publish()
    return counts


def _stored(spark: SparkSession, bronze_dir: str, table: str) -> DataFrame:
    schema = StructType([*BRONZE[table].fields, *REJECT_COLUMNS])
    return read_table(spark, f"{bronze_dir}/{table}", schema)


def read_bronze(spark: SparkSession, bronze_dir: str, table: str) -> DataFrame:
    """Scan of a raw table without its malformed lines."""
    return _stored(spark, bronze_dir, table).where(F.col(BAD_LINE).isNull()).select(
        *BRONZE[table].fieldNames()
    )


def read_rejects(spark: SparkSession, bronze_dir: str, table: str) -> DataFrame:
    """The malformed lines of a raw table's last load: text, file and block of the file."""
    rejects = _stored(spark, bronze_dir, table).where(F.col(BAD_LINE).isNotNull())
    return rejects.select(BAD_LINE, BAD_FILE, BAD_BLOCK)


def publish_bronze(spark: SparkSession, bronze_dir: str) -> None:
    """Make the raw tables known to SQL as ``bronze.<table>``, without the malformed lines."""
    create_database(spark, "bronze", bronze_dir)
    for table, schema in BRONZE.items():
        columns = ", ".join(schema.fieldNames())
        spark.sql(
            f"CREATE OR REPLACE VIEW bronze.{table} AS SELECT {columns}"
            f" FROM parquet.`{table_path(spark, f'{bronze_dir}/{table}')}` WHERE {BAD_LINE} IS NULL"
        )
