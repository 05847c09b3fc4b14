"""Test-data columns derived from ids: the same ids and seed give the same rows on any cluster.

Any frame with an id column can be filled, for example ``spark.range(n)`` or the keys of a table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Shares of the generated values, in percent.
TIERS = (("Bronze", 40), ("Silver", 30), ("Gold", 20), ("Platinum", 10))
COUNTRIES = (("USA", 80), ("Canada", 10), ("UK", 5), ("Other", 5))
ORDER_STATUSES = (("delivered", 30), ("shipped", 25), ("processing", 20), ("pending", 15), ("cancelled", 10))
CATEGORIES = (("Electronics", 25), ("Clothing", 20), ("Home & Garden", 15), ("Sports", 15), ("Books", 10), ("Other", 15))
TRANSACTION_TYPES = ("IN", "OUT", "ADJUSTMENT")


def draw(key: Column, name: str, n: int, seed: int = 0) -> Column:
    """Even whole number below ``n`` that depends only on key, column name and seed."""
    text = F.concat_ws("-", F.lit(str(seed)), F.lit(name), key.cast("string"))
    return (F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % F.lit(n)).cast("bigint")


def pick(key: Column, name: str, shares, seed: int = 0) -> Column:
    """One of the values, by its share in percent."""
    at, upto, out = draw(key, name, 100, seed), 0, None
    for value, share in shares[:-1]:
        upto += share
        out = F.when(at < upto, value) if out is None else out.when(at < upto, value)
    return out.otherwise(shares[-1][0])


def customers(ids: DataFrame, key: str = "id", seed: int = 0) -> DataFrame:
    k = F.col(key)
    return ids.select(
        k.alias("customer_id"),
        F.concat(F.lit("First"), draw(k, "first", 500, seed)).alias("first_name"),
        F.concat(F.lit("Last"), draw(k, "last", 1000, seed)).alias("last_name"),
        F.concat(F.lit("user"), k, F.lit("@example.com")).alias("email"),
        F.when(draw(k, "phone?", 100, seed) < 70, F.concat(F.lit("+1555"), F.lpad(draw(k, "phone", 10**7, seed).cast("string"), 7, "0"))).alias("phone"),
        F.concat(F.lit("City"), draw(k, "city", 300, seed)).alias("city"),
        pick(k, "country", COUNTRIES, seed).alias("country"),
        pick(k, "tier", TIERS, seed).alias("customer_tier"),
        (draw(k, "active", 100, seed) < 95).alias("is_active"),
        (draw(k, "value", 500001, seed).cast("double") / 100).alias("lifetime_value"),
        F.date_sub(F.lit("2025-01-01").cast("date"), draw(k, "age", 1826, seed).cast("int")).alias("registration_date"),
    )


def products(ids: DataFrame, key: str = "id", seed: int = 0) -> DataFrame:
    k = F.col(key)
    cents = draw(k, "price", 199001, seed) + 1000
    return ids.select(
        k.alias("product_id"),
        F.concat(F.lit("Product "), k).alias("product_name"),
        pick(k, "category", CATEGORIES, seed).alias("category"),
        (cents.cast("double") / 100).alias("price"),
        (F.floor(cents * (draw(k, "margin", 11, seed) + 60) / 100).cast("double") / 100).alias("cost"),
        draw(k, "stock", 501, seed).alias("stock_quantity"),
        F.to_json(F.struct(F.concat(F.lit("Brand"), draw(k, "brand", 50, seed)).alias("brand"))).alias("metadata"),
    )


def orders(ids: DataFrame, customer: str, key: str = "id", seed: int = 0) -> DataFrame:
    """Orders whose customer is a column of the id frame, so that references hold."""
    k = F.col(key)
    return ids.select(
        k.alias("order_id"),
        F.col(customer).alias("customer_id"),
        F.date_sub(F.lit("2025-01-01").cast("date"), draw(k, "age", 730, seed).cast("int")).alias("order_date"),
        ((draw(k, "total", 199001, seed) + 1000).cast("double") / 100).alias("total_amount"),
        pick(k, "status", ORDER_STATUSES, seed).alias("status"),
        F.to_json(F.struct(F.concat(F.lit("City"), draw(k, "city", 300, seed)).alias("city"))).alias("shipping_address"),
    )


def order_items(ids: DataFrame, order: str, product: str, key: str = "id", seed: int = 0) -> DataFrame:
    k = F.col(key)
    return ids.select(
        k.alias("order_item_id"),
        F.col(order).alias("order_id"),
        F.col(product).alias("product_id"),
        (draw(k, "quantity", 10, seed) + 1).alias("quantity"),
        ((draw(k, "price", 199001, seed) + 1000).cast("double") / 100).alias("unit_price"),
    )


def inventory(ids: DataFrame, product: str, key: str = "id", seed: int = 0) -> DataFrame:
    """Stock movements; quantities are given without sign and the new stock is never negative."""
    k = F.col(key)
    kind = F.element_at(F.array(*[F.lit(t) for t in TRANSACTION_TYPES]), (draw(k, "kind", 3, seed) + 1).cast("int"))
    d = ids.select(
        k.alias("transaction_id"),
        F.col(product).alias("product_id"),
        kind.alias("transaction_type"),
        (draw(k, "previous", 451, seed) + 50).alias("previous_quantity"),
        draw(k, "amount", 1000003, seed).alias("__a"),
    )
    t, prev, a = F.col("transaction_type"), F.col("previous_quantity"), F.col("__a")
    moved = (
        F.when(t == "IN", a % 91 + 10)
        .when(t == "OUT", -(a % F.least(F.lit(50), prev) + 1))
        .otherwise(a % 41 - 20)
    )
    d = d.withColumn("__m", moved)
    return d.select(
        "transaction_id", "product_id", "transaction_type",
        F.abs("__m").alias("quantity"), "previous_quantity",
        F.greatest(F.lit(0), prev + F.col("__m")).alias("new_quantity"),
    )


def suppliers(ids: DataFrame, key: str = "id", seed: int = 0) -> DataFrame:
    k = F.col(key)
    return ids.select(
        k.alias("supplier_id"),
        F.concat(F.lit("Supplier "), k).alias("supplier_name"),
        F.concat(F.lit("Contact"), draw(k, "contact", 1000, seed)).alias("contact_name"),
        F.concat(F.lit("supplier"), k, F.lit("@example.com")).alias("email"),
    )


TABLES = {
    "customers": customers,
    "products": products,
    "orders": orders,
    "order_items": order_items,
    "inventory": inventory,
    "suppliers": suppliers,
}


def table(name: str, ids: DataFrame, **args) -> DataFrame:
    return TABLES[name](ids, **args)
