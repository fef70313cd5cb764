"""Serving tables on literal inputs."""

import pytest

from tasteloom.functions import catalog
from tasteloom.operators import serving
from tests.helpers import rows

NAMES = {
    1: ("Sony Gaming Laptop", "Electronics"), 2: ("Notebook", "Books"), 3: ("Gym Shoe", "Sports"),
    4: ("Smartphone", "Electronics"), 5: ("red plate", "Home"), 6: ("Book about TV", "Electronics"),
}


@pytest.fixture
def catalogue(spark):
    return spark.createDataFrame([(k, v[0]) for k, v in NAMES.items()], "product_id long, product_name string")


@pytest.fixture
def recs(spark):
    data = [(u, p, 10.0 - p) for u in (1, 2) for p in NAMES]
    return spark.createDataFrame(data, "user_id long, product_id long, rating double")


def test_categories_prices_pictures(spark, recs, catalogue):
    manifest = spark.createDataFrame([(2,), (5,)], "product_id long")
    full = serving.enriched(recs, catalogue, manifest).filter("user_id = 1").collect()
    for r in full:
        assert r.category == NAMES[r.product_id][1]
        low, high = catalog.PRICE_RANGES[r.category]
        assert low <= r.price < high
        own = catalog.PICTURE_PATH.format(r.product_id)
        expected = own if r.product_id in (2, 5) else catalog.PLACEHOLDERS[r.category]
        assert r.image_url == expected


def test_price_depends_on_the_product_alone(recs, catalogue):
    priced = serving.with_price(serving.with_category(serving.with_names(recs, catalogue)))
    per_user = {u: rows(priced.filter(f"user_id = {u}"), "product_id", "price") for u in (1, 2)}
    assert per_user[1] == per_user[2]


def test_fallback(spark, recs):
    requested = spark.createDataFrame([(1,), (7,), (8,)], "user_id long")
    out = serving.lists_or_fallback(recs, requested, 4)
    counts = {r.user_id: (r["count"], r.is_fallback) for r in out.groupBy("user_id", "is_fallback").count().collect()}
    assert counts == {1: (6, False), 7: (4, True), 8: (4, True)}
    assert rows(out.filter("user_id = 7"), "product_id") == [(1,), (1,), (2,), (2,)]


def test_pages(recs, catalogue):
    named = serving.with_price(serving.with_category(serving.with_names(recs, catalogue)))
    out = serving.pages(named, text="OO", size=1).filter("user_id = 1")
    assert rows(out, "product_id", "page") == [(2, 1), (6, 2)]
    electronics = serving.pages(named, category="Electronics", sort="price_low", size=2).filter("user_id = 2")
    listed = [(r.price, r.page) for r in electronics.orderBy("position").collect()]
    assert listed == sorted(listed) and [p for _, p in listed] == [1, 1, 2]


def test_dashboard(spark):
    recs = spark.createDataFrame([(1, 1, 12.0), (1, 2, 3.0), (2, 1, 40.0)], "user_id long, product_id long, rating double")
    assert rows(serving.dashboard(recs)) == [(1, 2, 7.5, 50.0), (2, 1, 40.0, 100.0)]
    assert rows(serving.users_list(recs)) == [("1",), ("2",)]


def test_category_mix(recs, catalogue):
    mix = serving.category_mix(serving.with_category(serving.with_names(recs, catalogue)))
    assert ("Electronics", 3) in rows(mix.filter("user_id = 1"), "category", "items")
