"""The supplied tables, and variants of them with defects.

The tables are clean, so defects are derived from their own values: the same
conditions appear in the SQL each query is compared with. Variants keep all rows of
their table, but for those that serve as the incomplete side of a reference: solvent
customers, and the schema made of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NBSP = "\u00a0"


class Source:
    """Tables of one folder by name."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{table}.parquet")

    def orders_with_gaps(self) -> DataFrame:
        """Urgent orders lack their customer; ``o_comment`` is empty throughout."""
        urgent = F.col("o_orderpriority") == "1-URGENT"
        return self.orders.withColumn(
            "o_custkey", F.when(~urgent, F.col("o_custkey"))
        ).withColumn("o_comment", F.lit(None).cast("string"))

    def orders_with_text_dates(self) -> DataFrame:
        """Dates as text: urgent orders in another format, finished high ones without."""
        iso = F.date_format("o_orderdate", "yyyy-MM-dd")
        other = F.date_format("o_orderdate", "dd/MM/yyyy")
        missing = (F.col("o_orderpriority") == "2-HIGH") & (F.col("o_orderstatus") == "F")
        return self.orders.withColumn(
            "o_orderdate",
            F.when(F.col("o_orderpriority") == "1-URGENT", other).when(~missing, iso),
        )

    def orders_corrected(self) -> DataFrame:
        """A second copy in which the status of expensive orders differs."""
        return self.orders.withColumn(
            "o_orderstatus",
            F.when(F.col("o_totalprice") > 400000, "X").otherwise(F.col("o_orderstatus")),
        )

    def orders_with_copies(self) -> DataFrame:
        """Two real copies of columns and one that only holds the same values elsewhere."""
        return self.orders.withColumns(
            {
                "key_copy": F.col("o_orderkey"),
                "priority_copy": F.col("o_orderpriority"),
                "key_swapped": F.col("o_orderkey").bitwiseXOR(F.lit(1).cast("bigint")),
            }
        )

    def customers_moved(self) -> DataFrame:
        """Home nations under another name; customers in debt live one nation further."""
        return self.customer.select(
            "c_custkey",
            F.when(F.col("c_acctbal") < 0, F.col("c_nationkey") + 1)
            .otherwise(F.col("c_nationkey"))
            .alias("home_nation"),
        )

    def solvent_customers(self) -> DataFrame:
        return self.customer.where(F.col("c_acctbal") > 0)

    def part_sizes(self) -> DataFrame:
        """Sizes as text, unreadable for one brand."""
        return self.part.withColumn(
            "p_size",
            F.when(F.col("p_brand") == "Brand#4", "n/a").otherwise(F.col("p_size").cast("string")),
        )

    def events_with_text_times(self) -> DataFrame:
        """Times as text, error events in another format."""
        return self.events.withColumn(
            "ts",
            F.when(
                F.col("event_type") == "error", F.date_format("ts", "yyyy/MM/dd HH:mm")
            ).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")),
        )

    def part_sheet(self) -> DataFrame:
        """A dictionary sheet with padded upper-case names; large parts were renamed."""
        original = F.concat(F.lit("  "), F.upper("p_name"), F.lit(NBSP))
        name = F.when(F.col("p_size") > 40, F.col("p_name")).when(F.col("p_size") > 1, original)
        return self.part.select(
            original.alias("original"),
            name.alias("column_name"),
            F.col("p_type").alias("Description"),
            F.lit("part").alias("source_sheet"),
        )

    def supplier_sheet(self) -> DataFrame:
        """Supplier names without the mark in front of their number."""
        return self.supplier.select(
            F.regexp_replace("s_name", "#", "").alias("column_name"),
            F.lit("a supplier").alias("Description"),
            F.lit("supplier").alias("source_sheet"),
        )

    def customer_sheet(self) -> DataFrame:
        return self.customer.select(
            F.concat("c_name", F.lit(" ")).alias("column_name"),
            F.col("c_mktsegment").alias("Description"),
            F.lit("customer").alias("source_sheet"),
        )

    def customer_schema(self) -> DataFrame:
        """A schema table with a column per solvent customer."""
        segment = F.col("c_mktsegment")
        return self.solvent_customers().select(
            F.lower("c_name").alias("column_name"),
            F.when(segment == "BUILDING", "int")
            .when(segment == "MACHINERY", "double")
            .otherwise("string")
            .alias("column_type"),
        )

    def supplier_schema(self) -> DataFrame:
        """A schema table with a column per supplier."""
        return self.supplier.select(
            F.col("s_name").alias("column_name"),
            F.when(F.col("s_acctbal") < 0, "int").otherwise("string").alias("column_type"),
        )

    def part_labels(self) -> DataFrame:
        """Short labels, words joined by nothing."""
        words = F.concat_ws("_", F.regexp_replace("p_name", " ", ""), "p_brand", "p_type")
        return self.part.select(F.lower(words).alias("label"))

    def part_columns(self) -> DataFrame:
        """Full labels, words joined by underscores."""
        words = F.concat_ws("_", F.regexp_replace("p_name", " ", "_"), "p_brand", "p_type")
        return self.part.select(F.lower(words).alias("label"))

    def event_columns(self) -> DataFrame:
        """A column per kind of event; sign-ups are never filled."""
        return self.events.select(
            *[
                F.when(F.col("event_type") == kind, F.col("value")).alias(kind)
                for kind in ("click", "error", "purchase", "view")
            ],
            F.lit(None).cast("double").alias("signup"),
        )

    def event_mapping(self) -> DataFrame:
        """Names to look up: kinds of events and market segments."""
        kinds = self.events.select(F.col("event_type").alias("column_name_fixed"))
        segments = self.customer.select(F.col("c_mktsegment").alias("column_name_fixed"))
        return kinds.union(segments).distinct()

    def document_mapping(self) -> DataFrame:
        """Each document as a dictionary entry: its text describes it, its language types it."""
        lang = F.col("lang")
        good = self.labels.where("quality = 1").select("doc_id", F.lit(True).alias("is_required"))
        return (
            self.documents.join(good, "doc_id", "left")
            .select(
                F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("column_name"),
                F.col("text").alias("Description"),
                F.when(lang == "de", "int")
                .when(lang == "fr", "double")
                .when(lang == "es", "date")
                .otherwise("string")
                .alias("column_type"),
                F.coalesce("is_required", F.lit(False)).alias("is_required"),
            )
        )
