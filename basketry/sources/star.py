"""The star-schema Parquet tables seen as the five base tables.

Keys stay 64-bit, as the files carry them.  ``order_number`` is 16-bit like the
declared table whenever no customer has more orders than that can number; only
with a hotter customer does it widen, and the windows over orders and purchases
then run in slices.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketry.functions.calendar import dow_of
from basketry.operators.sequence import number_rows, position_slice
from basketry.schema import GAP, TOP_N
from basketry.session import dealt, stage

# How the star schema maps to the base tables.
SHORT_MAX = 32767
TYPE_SPAN = 10
UNKNOWN_PARTS = 2147483647
SLICE_ROWS = 1_000_000
REQUEST_EVENT = "view"
REQUEST_GAP = 7.0


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _numbered_values(part: DataFrame, column: str, id_name: str) -> DataFrame:
    """Distinct labels with dense ids.  The id is 16-bit by declaration, so the
    table has at most 32,767 rows: one window partition and a broadcast are safe."""
    labels = part.select(column).filter(F.col(column).isNotNull()).distinct()
    return labels.select(column, F.row_number().over(Window.orderBy(column)).cast("smallint").alias(id_name))


def aisles(part: DataFrame) -> DataFrame:
    return _numbered_values(part, "p_brand", "aisle_id").select("aisle_id", F.col("p_brand").alias("aisle"))


def departments(part: DataFrame) -> DataFrame:
    return _numbered_values(part, "p_type", "department_id").select(
        "department_id", F.col("p_type").alias("department")
    )


def _part_labels(part: DataFrame) -> DataFrame:
    brands = _numbered_values(part, "p_brand", "aisle_id")
    types = _numbered_values(part, "p_type", "department_id").withColumn(
        "_span", F.greatest(F.lit(TYPE_SPAN), F.count("*").over(Window.partitionBy()))
    )
    product_id = (F.col("aisle_id").cast("bigint") - 1) * F.col("_span") + F.col("department_id")
    return (
        part.select("p_partkey", "p_brand", "p_type")
        .join(F.broadcast(brands), "p_brand")
        .join(F.broadcast(types), "p_type")
        .withColumn("product_id", product_id.cast("int"))
    )


def products(part: DataFrame) -> DataFrame:
    return _part_labels(part).select(
        "product_id",
        F.concat_ws(" ", "p_type", "p_brand").alias("product_name"),
        "aisle_id",
        "department_id",
    ).distinct()


def _day_slices(dated: DataFrame) -> tuple[DataFrame, Column]:
    """Slices for users too busy for one task: a day each, and where a single
    day of one user is still large, equal ranges of that day's own order keys."""
    per_day = dated.groupBy("user_id", "day").agg(
        F.count("*").alias("_n"), F.min("order_id").alias("_low"), F.max("order_id").alias("_high")
    )
    ranges = -(-per_day.agg(F.max("_n")).first()[0] // SLICE_ROWS)
    large = per_day.filter(F.col("_n") > SLICE_ROWS).select("user_id", "day", "_low", "_high")
    marked = dated.join(large, ["user_id", "day"], "left")
    day = F.datediff("day", F.lit("1970-01-01").cast("date")).cast("bigint")
    width = F.ceil((F.col("_high") - F.col("_low") + 1) / ranges)
    inside = F.coalesce(F.floor((F.col("order_id") - F.col("_low")) / width), F.lit(0))
    return marked, day * ranges + inside.cast("bigint")


def orders(raw: DataFrame) -> DataFrame:
    """Orders numbered per customer by date, the last one held out."""
    dated = raw.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.to_date("o_orderdate").alias("day"),
    )
    per_user = dated.groupBy("user_id").agg(F.count("*").alias("user_orders"))
    busiest = per_user.agg(F.max("user_orders")).first()[0] or 0
    order_by = ["day", "order_id"]
    previous = {"previous_day": "day"}
    if busiest <= SHORT_MAX:
        numbered = number_rows(dated, ["user_id"], order_by, "order_number", previous)
        whole = Window.partitionBy("user_id")
        numbered = numbered.withColumn("user_orders", F.count("*").over(whole))
        number_type = "smallint"
    else:
        marked, slices = _day_slices(dated)
        numbered = number_rows(marked, ["user_id"], order_by, "order_number", previous, slices)
        numbered = numbered.join(per_user, "user_id")
        number_type = "int"

    held_out = F.when(F.col("user_id") % 5 == 0, "test").otherwise("train")
    return numbered.select(
        "order_id",
        "user_id",
        F.when(F.col("order_number") == F.col("user_orders"), held_out).otherwise("prior").alias("eval_set"),
        F.col("order_number").cast(number_type).alias("order_number"),
        dow_of(F.col("day")).cast("smallint").alias("order_dow"),
        (F.col("order_id") % 24).cast("smallint").alias("order_hour_of_day"),
        F.datediff("day", "previous_day").cast(GAP).alias("days_since_prior_order"),
    )


def order_products(lineitem: DataFrame, part: DataFrame, base_orders: DataFrame) -> DataFrame:
    """One row per order and product.  The window over an order sees each
    product once, so the catalogue bounds it; lines are merged before it.

    Every line is kept, for the foreign-key check to find: one without an order
    keeps its order id and is no reorder; one whose part is missing or has no
    brand or type gets a negative product id from its part key.

    Lines are dealt out by order first: merging, the cart window and the join with
    the orders then need no other exchange.
    """
    count = lineitem.count()
    labels = _part_labels(part).select("p_partkey", "product_id")
    lines = lineitem.select("l_orderkey", "l_partkey", "l_linenumber").join(
        labels, F.col("l_partkey") == F.col("p_partkey"), "left"
    )
    unknown = (-1 - F.pmod(F.col("l_partkey"), F.lit(UNKNOWN_PARTS))).cast("int")
    by_order = lines.select(
        F.col("l_orderkey").alias("order_id"), F.coalesce("product_id", unknown).alias("product_id"), "l_linenumber"
    )
    by_order = dealt(by_order.repartition("order_id"), count, "order_id")
    items = by_order.groupBy("order_id", "product_id").agg(F.min("l_linenumber").alias("_line"))
    cart = Window.partitionBy("order_id").orderBy("_line", "product_id")
    items = items.withColumn("add_to_cart_order", F.row_number().over(cart).cast("smallint"))
    placed = items.join(base_orders.select("order_id", "user_id", "order_number"), "order_id", "left").drop("_line")
    # a line without an order has no user: its order stands in, so such lines meet in no group
    placed = placed.withColumn("_owner", F.coalesce("user_id", -1 - F.col("order_id")))
    bought = number_rows(
        placed,
        ["_owner", "product_id"],
        ["order_number"],
        "_purchase",
        {},
        position_slice(placed, "order_number"),
        count,
    )
    return bought.select(
        "order_id",
        "product_id",
        "add_to_cart_order",
        F.when(F.col("_purchase") > 1, 1).otherwise(0).cast("smallint").alias("reordered"),
    )


def requests(events: DataFrame) -> DataFrame:
    """Each view event asks for recommendations at its own hour and day."""
    return events.filter(F.col("event_type") == REQUEST_EVENT).select(
        F.col("event_id").alias("request_id"),
        "user_id",
        F.hour("ts").alias("current_hour"),
        dow_of(F.col("ts")).alias("current_dow"),
        F.when(F.col("event_id") % 2 != 0, REQUEST_GAP).alias("days_since_last_order"),
        F.lit(TOP_N).alias("top_n"),
    )


class StarTables:
    """The base tables of one directory.  Orders and line items feed several
    branches of every later plan, so each is written once on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def _read(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    @cached_property
    def aisles(self) -> DataFrame:
        return aisles(self._read("part"))

    @cached_property
    def departments(self) -> DataFrame:
        return departments(self._read("part"))

    @cached_property
    def products(self) -> DataFrame:
        return products(self._read("part"))

    @cached_property
    def orders(self) -> DataFrame:
        return stage(orders(self._read("orders")), "orders")

    @cached_property
    def order_products(self) -> DataFrame:
        return stage(
            order_products(self._read("lineitem"), self._read("part"), self.orders),
            "order_products",
        )

    @cached_property
    def requests(self) -> DataFrame:
        return requests(self._read("events"))

    def base_tables(self) -> dict[str, DataFrame]:
        return {
            "aisles": self.aisles,
            "departments": self.departments,
            "products": self.products,
            "orders": self.orders,
            "order_products": self.order_products,
        }
