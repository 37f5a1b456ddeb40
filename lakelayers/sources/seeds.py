"""Seeds: small reference tables kept as CSV with padded fields."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: seed columns and types -----------------------------------
SEED_TYPES = {
    "products": {
        "product_id": "bigint",
        "product_name": "string",
        "category": "string",
        "price": "double",
    },
    "cq": {
        "item": "string",
        "demographic": "string",
        "sales_category": "string",
        "ppg": "string",
        "product_type": "string",
        "collection": "string",
        "fabric_family": "string",
        "color_family": "string",
        "cost": "string",
        "dummy": "string",
    },
    "state_to_region_mapping": {"State": "string", "State_Code": "string", "Region": "string"},
}


def read_seed(
    spark: SparkSession, path: str, columns: Mapping[str, str], types: Mapping[str, str] | None = None
) -> DataFrame:
    """A header CSV as declared columns; ``types`` overrides some of them.

    Padding around fields is cut off before the cast: with it, numbers would
    read as NULL. A field that still does not fit its type stops the read.
    """
    ddl = ", ".join(f"`{c}` {(types or {}).get(c, t)}" for c, t in columns.items())
    return (
        spark.read.schema(ddl)
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )


def write_padded(df: DataFrame, path: str, lead: int = 2, trail: int = 140) -> None:
    """Write a seed the way they arrive: padded in front of the first field and
    behind the last."""
    first, last = df.columns[0], df.columns[-1]
    padded = df.withColumns({
        first: F.concat(F.lit(" " * lead), F.col(first).cast("string")),
        last: F.concat(F.col(last).cast("string"), F.lit(" " * trail)),
    })
    (
        padded.write.option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
