"""Line item records rolled up to purchase orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplyloom.operators.aggregates import counted_lines_text
from supplyloom.operators.joins import Lookup, denormalize, measured

ORDER_KEY = ("po_number", "period", "_category_id", "category")
SMALLEST = ("team", "sap_backend", "created_at", "_user", "po_created_by", "ifa_number", "ifa_supplier_name", "_are", "customer_id")


def order_record_view(
    record: DataFrame,
    category: DataFrame,
    team: DataFrame,
    users: DataFrame,
    are: DataFrame,
    with_lines: bool = True,
    xml_escape: bool = False,
) -> DataFrame:
    """One row per order, period and known category, with the smallest value of each attribute.

    Lines whose category is not in the category table share one row without category. The text covers the whole
    order, whatever the category; it is NULL where no line of the row names a category or the period is NULL.
    ``with_lines=False`` leaves it out.

    The record is read once for the orders and, with few columns, once for the text. Users are one row per GID and
    meet the lines where those are while they fit into memory, so that a record that lies by order stays so: neither
    the lines nor the orders are dealt out again.
    """
    people = users.groupBy("GID").agg(F.min("Name").alias("Name"), F.count(F.lit(1)).alias("_rows"))
    named = denormalize(
        record,
        [
            Lookup(category, "category_id", {"_category_id": "id", "category": "name"}),
            Lookup(team, "team_id", {"team": "name"}),
            Lookup(measured(people), "po_created_by", {"_user": "Name", "_users": "_rows"}, pk="GID"),
            Lookup(are, "are_id", {"_are": "name"}),
        ],
    )
    lines = named.groupBy(*ORDER_KEY, "number_of_line_item").agg(
        *(F.min(c).alias(c) for c in SMALLEST),
        F.max(F.col("category_id").isNotNull() & F.col("period").isNotNull()).alias("_named"),
    )
    orders = lines.groupBy(*ORDER_KEY).agg(
        *(F.min(c).alias(c) for c in SMALLEST),
        F.max("_named").alias("_named"),
        F.count("number_of_line_item").cast("int").alias("po_items_count"),
    )
    orders = orders.select(
        "po_number",
        "period",
        F.col("_category_id").alias("category_id"),
        "category",
        "team",
        "sap_backend",
        "created_at",
        F.coalesce("_user", "po_created_by").alias("created_by"),
        "ifa_number",
        "ifa_supplier_name",
        F.col("_are").alias("are"),
        "customer_id",
        "po_items_count",
        "_named",
    )
    if with_lines:
        # a line counts once for every user of its GID
        counted = named.groupBy("po_number", "number_of_line_item").agg(F.sum(F.coalesce("_users", F.lit(1))).alias("_n"))
        text = counted_lines_text(counted, xml_escape)
        orders = orders.join(text, "po_number", "left").withColumn(
            "line_items_text", F.when(F.col("_named"), F.col("line_items_text"))
        )
    return orders.drop("_named")


def new_items_by_team(requests: DataFrame, record_view: DataFrame) -> DataFrame:
    """Requested items per team and period: one per request and order row, as the plain join counts them.

    Both sides are counted per order and period before they meet, so an order requested many times costs
    one row.
    """
    asked = requests.groupBy("po_number", "period").agg(F.count(F.lit(1)).alias("_asked"))
    shown = record_view.groupBy("po_number", "period", "team").agg(F.count(F.lit(1)).alias("_shown"))
    return (
        asked.join(shown, ["po_number", "period"], "left")
        .groupBy("team", "period")
        .agg(F.sum(F.col("_asked") * F.coalesce(F.col("_shown"), F.lit(1))).alias("new_items"))
    )
