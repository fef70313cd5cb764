"""Category, price and picture rules for the serving tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tasteloom.functions.scalar import text_bits

# Fixed values.
CATEGORY_WORDS = {
    "Electronics": ["laptop", "phone", "tv", "camera"],
    "Books": ["book"],
    "Sports": ["gym", "shoe", "sport"],
}
OTHER_CATEGORY = "Home"
PRICE_RANGES = {
    "Electronics": (25000, 150000),
    "Books": (299, 1499),
    "Home": (1500, 25000),
    "Sports": (499, 12000),
}
OTHER_PRICE_RANGE = (1000, 5000)
PLACEHOLDERS = {
    "Electronics": "https://images.unsplash.com/photo-1498049794561-7780e7231661?w=500",
    "Books": "https://images.unsplash.com/photo-1495446815901-a7297e633e8d?w=500",
    "Sports": "https://images.unsplash.com/photo-1461896836934-ffe607ba8211?w=500",
    "Home": "https://images.unsplash.com/photo-1556228578-0d85b1a4d571?w=500",
}
PICTURE_PATH = "/static/product_images/{}.png"


def category_of(name: Column) -> Column:
    """The first category one of whose words occurs in ``name``."""
    lowered = F.lower(name)
    rule = F
    for category, words in CATEGORY_WORDS.items():
        found = reduce(lambda a, b: a | b, [lowered.contains(w) for w in words])
        rule = rule.when(found, F.lit(category))
    return rule.otherwise(F.lit(OTHER_CATEGORY))


def price_of(category: Column, product: Column) -> Column:
    """A price in the category's range that depends on the product id alone."""
    bits = text_bits(product.cast("string"))

    def within(low: int, high: int) -> Column:
        return F.pmod(bits, F.lit(high - low).cast("long")) + F.lit(low).cast("long")

    rule = F
    for name, (low, high) in PRICE_RANGES.items():
        rule = rule.when(category == name, within(low, high))
    return rule.otherwise(within(*OTHER_PRICE_RANGE))


def placeholder_of(category: Column) -> Column:
    rule = F
    for name, url in PLACEHOLDERS.items():
        rule = rule.when(category == name, F.lit(url))
    return rule.otherwise(F.lit(None).cast("string"))
