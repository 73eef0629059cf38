"""S1 typed scans and S7 view registration."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None, fmt: str = "parquet") -> DataFrame:
    """Full scan of a typed table.

    With a schema, columns are selected and cast to the declared types (a
    projection Catalyst prunes and pushes into the scan); a missing column is
    an error rather than a silent null.
    """
    df = spark.read.format(fmt).load(path)
    if schema is None:
        return df
    return conform(df, schema)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast ``df`` to ``schema`` (by name)."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing from input: {missing}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_jdbc(spark: SparkSession, url: str, table: str, schema: T.StructType, **options: str) -> DataFrame:
    """S1 over JDBC: the same typed scan for a database source.

    Filters and column lists applied afterwards are pushed into the SQL the
    JDBC source sends; pass ``partitionColumn``/``lowerBound``/``upperBound``/
    ``numPartitions`` in ``options`` for a parallel read.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for key, value in options.items():
        reader = reader.option(key, value)
    return conform(reader.load(), schema)


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """``CREATE OR REPLACE VIEW`` for each frame (session-scoped)."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def register_warehouse_views(spark: SparkSession, warehouse, method: str = "rank") -> list[str]:
    """S7 for SQL users: the warehouse tables plus the two analytic views.

    Registers ``fact_orders``, ``dim_date``, ``dim_facility``, ``dim_product``,
    ``vw_monthly_revenue`` and ``vw_product_revenue_rank`` as temporary views,
    so ``spark.sql("SELECT * FROM vw_monthly_revenue ORDER BY year, month")``
    works as it does on the reference's database.
    """
    from sparkmart.plans.views import monthly_revenue, product_revenue_rank

    tables = {
        "fact_orders": warehouse.fact_orders,
        "dim_date": warehouse.dim_date,
        "dim_facility": warehouse.dim_facility,
        "dim_product": warehouse.dim_product,
        "vw_monthly_revenue": monthly_revenue(warehouse.fact_orders, warehouse.dim_date),
        "vw_product_revenue_rank": product_revenue_rank(warehouse.fact_orders, warehouse.dim_product, method),
    }
    register_views(tables)
    return list(tables)
