"""Queries for id codes, splits, the model and recommendations."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tasteloom.operators import clean, encode, model, ranking, recommend, relate, split
from tasteloom.plans import train
from tasteloom.registry import inputs
from tasteloom.registry.book import query
from tasteloom.registry.tables import hundredth
from tasteloom.shared import new_path, settle
from tasteloom.sources import feeds


def fitted(spark, folder, spec=model.FAST):
    return train.train(clean.dedup(feeds.orders_feed(spark, folder)), spec)


def _index_sql(column):
    return f"""(SELECT {column}, cast(row_number() OVER (ORDER BY count(*) DESC,
        cast({column} AS varchar)) - 1 AS int) AS idx FROM train GROUP BY 1)"""


@query("encode_hash")
def encode_hash(spark, folder):
    return encode.hash_codes(feeds.orders_feed(spark, folder))


@query("hash_collisions")
def hash_collisions(spark, folder):
    return encode.hash_collisions(feeds.orders_feed(spark, folder))


@query(
    "encode_frequency",
    f"""SELECT c.user_id, c.product_id, c.rating, c.ts, u.idx AS user_idx, p.idx AS item_idx
        FROM clean_orders c JOIN {_index_sql('user_id')} u USING (user_id)
             JOIN {_index_sql('product_id')} p USING (product_id)""",
)
def encode_frequency(spark, folder):
    ratings = inputs.clean_orders(spark, folder)
    known, _ = split.split(ratings)
    indexes = {c: encode.dense_index(known, c, out) for c, out in encode.CODES.items()}
    return encode.encode(ratings, indexes)


@query(
    "encode_cast",
    """SELECT *, try_cast(user_id AS int) AS user_idx, try_cast(product_id AS int) AS item_idx
       FROM dirty_feed
       WHERE try_cast(user_id AS int) IS NOT NULL AND try_cast(product_id AS int) IS NOT NULL""",
)
def encode_cast(spark, folder):
    return encode.cast_codes(feeds.dirty_feed(spark, folder))


@query(
    "encode_rejects",
    """SELECT 'user_id' AS column_name, 'int' AS type, count(*) FILTER (WHERE user_id IS NOT NULL
              AND try_cast(user_id AS int) IS NULL) AS rejected FROM dirty_feed
       UNION ALL SELECT 'product_id', 'int', count(*) FILTER (WHERE product_id IS NOT NULL
              AND try_cast(product_id AS int) IS NULL) FROM dirty_feed""",
)
def encode_rejects(spark, folder):
    """Ids that have no int code."""
    return clean.cast_rejects(feeds.dirty_feed(spark, folder), dict.fromkeys(encode.CODES, "int"))


@query(
    "encode_hash_codes",
    """SELECT *, cast('0x' || substr(md5(cast(user_id AS varchar)), 1, 8) AS bigint) AS user_idx,
              cast('0x' || substr(md5(cast(product_id AS varchar)), 1, 8) AS bigint) AS item_idx FROM orders_feed""",
)
def encode_hash_codes(spark, folder):
    """Codes that any system can work out."""
    return encode.hash_codes(feeds.orders_feed(spark, folder), code=encode.md5_code())


def _collisions_sql(column):
    return f"""SELECT '{column}' AS column_name, cast(sum(n) AS bigint) AS ids, count(*) AS codes,
        cast(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS bigint) AS colliding_ids
      FROM (SELECT substr(md5(cast({column} AS varchar)), 1, 2) AS code, count(DISTINCT {column}) AS n
            FROM orders_feed GROUP BY 1)"""


@query("hash_collision_ids", f"{_collisions_sql('user_id')} UNION ALL {_collisions_sql('product_id')}")
def hash_collision_ids(spark, folder):
    """Ids that share a code, with so few codes that many do."""
    return encode.hash_collisions(feeds.orders_feed(spark, folder), code=encode.md5_code(8))


@query("split_random_rows", "SELECT count(*) AS rows, 0 AS in_both FROM (SELECT DISTINCT * FROM orders_feed)")
def split_random_rows(spark, folder):
    """A random split deals every row to one part."""
    rows = feeds.orders_feed(spark, folder).distinct()
    known, held_out = split.split(rows, how="random")
    both = known.join(held_out, known.columns, "left_semi").agg(F.count(F.lit(1)).cast("int").alias("in_both"))
    sizes = known.unionByName(held_out).agg(F.count(F.lit(1)).alias("rows"))
    return sizes.withColumn("in_both", both.scalar())


KNOWN = "user_id IN (SELECT user_id FROM train) AND product_id IN (SELECT product_id FROM train)"


@query(
    "als_facts",
    f"""SELECT (SELECT count(*) FROM test WHERE {KNOWN}) AS predictions,
               (SELECT count(*) FROM test WHERE {KNOWN}) AS finite,
               (SELECT count(*) FROM train) AS train_rows, (SELECT count(*) FROM test) AS test_rows""",
)
def als_facts(spark, folder):
    """One finite prediction for every test row whose user and product were trained on."""
    trained = fitted(spark, folder)
    score = F.col("prediction")
    finite = F.count_if(~F.isnan(score) & (F.abs(score) < float("inf")))
    found = trained.predictions().agg(F.count(F.lit(1)).alias("predictions"), finite.alias("finite"))
    rows = lambda df: df.agg(F.count(F.lit(1))).scalar()
    return found.select("*", rows(trained.train).alias("train_rows"), rows(trained.test).alias("test_rows"))


@query(
    "recommend_unseen_facts",
    """SELECT count(*) AS users, cast(sum(least(10, t.n - coalesce(r.n, 0))) AS bigint) AS rows,
              0 AS rated_pairs, 0 AS gaps
       FROM (SELECT DISTINCT user_id FROM train) u
            LEFT JOIN (SELECT user_id, count(DISTINCT product_id) AS n
                       FROM (SELECT user_id, product_id FROM train UNION ALL SELECT user_id, product_id FROM test)
                       WHERE product_id IN (SELECT product_id FROM train) GROUP BY 1) r USING (user_id),
            (SELECT count(DISTINCT product_id) AS n FROM train) t
       WHERE t.n > coalesce(r.n, 0)""",
)
def recommend_unseen_facts(spark, folder):
    """Every trained user has a full list, ranked without gaps, of products the user never rated."""
    trained = fitted(spark, folder)
    lists = settle(trained.lists(10))
    rated = lists.join(
        trained.coded.select("user_id", "product_id").distinct(), ["user_id", "product_id"], "left_semi"
    ).agg(F.count(F.lit(1)).cast("int"))
    users = lists.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.max("rank").alias("last"))
    return users.agg(
        F.count(F.lit(1)).alias("users"),
        F.sum("n").alias("rows"),
        F.count_if(F.col("n") != F.col("last")).cast("int").alias("gaps"),
    ).withColumn("rated_pairs", rated.scalar())


@query(
    "recommend_users_facts",
    """SELECT count(DISTINCT user_id) AS users, count(DISTINCT user_id) * least(10, (
              SELECT count(DISTINCT product_id) FROM train)) AS rows FROM train""",
)
def recommend_users_facts(spark, folder):
    """Every trained user has a full list."""
    nested = recommend.recommend_users(fitted(spark, folder).model, 10)
    return nested.agg(
        F.count(F.lit(1)).alias("users"), F.sum(F.size("recommendations")).cast("long").alias("rows")
    )


@query(
    "index_cardinality",
    """SELECT count(DISTINCT user_id) AS distinct_user_idx, count(DISTINCT product_id) AS distinct_item_idx
       FROM orders_feed""",
)
def index_cardinality(spark, folder):
    feed = feeds.orders_feed(spark, folder)
    indexes = {c: encode.dense_index(feed, c, out) for c, out in encode.CODES.items()}
    return encode.index_cardinality(encode.encode(feed, indexes))


@query("split_random")
def split_random(spark, folder):
    return split.split_sizes(*split.split(feeds.orders_feed(spark, folder), how="random"))


@query(
    "split_hash",
    f"""SELECT user_id, product_id, rating, ts,
               CASE WHEN {hundredth("concat(user_id, ':', product_id)")} < 80
                    THEN 'train' ELSE 'test' END AS part FROM orders_feed""",
)
def split_hash(spark, folder):
    known, held_out = split.split(feeds.orders_feed(spark, folder))
    return known.withColumn("part", F.lit("train")).unionByName(
        held_out.withColumn("part", F.lit("test"))
    )


@query(
    "split_sizes",
    """SELECT part, count(*) AS rows,
              round(count(*) / (SELECT count(*) FROM marked) * 100, 2) AS share_pct
       FROM (SELECT CASE WHEN b < 80 THEN 'train' ELSE 'test' END AS part FROM marked) GROUP BY 1""",
)
def split_sizes(spark, folder):
    return split.split_sizes(*inputs.train_test(spark, folder))


@query("als_fit_predict")
def als_fit_predict(spark, folder):
    trained = fitted(spark, folder, model.FULL)
    return trained.predictions().select("user_id", "product_id", "rating", "prediction")


@query("als_blocked_predict")
def als_blocked_predict(spark, folder):
    trained = fitted(spark, folder, model.BLOCKED)
    return trained.predictions().select("user_id", "product_id", "rating", "prediction")


@query("recommend_users")
def recommend_users(spark, folder):
    trained = fitted(spark, folder)
    indexes = {encode.CODES[c]: index for c, index in trained.indexes.items()}
    return recommend.flatten_recommendations(
        recommend.recommend_users(trained.model, 10), indexes=indexes
    )


@query("recommend_user_subset")
def recommend_user_subset(spark, folder):
    trained = fitted(spark, folder)
    some = trained.train.select("user_idx").distinct().orderBy("user_idx").limit(100)
    indexes = {encode.CODES[c]: index for c, index in trained.indexes.items()}
    return recommend.flatten_recommendations(
        recommend.recommend_users(trained.model, 10, some), indexes=indexes
    )


@query("recommend_unseen")
def recommend_unseen(spark, folder):
    return fitted(spark, folder).lists(10).select("user_id", "product_id", "rank", "prediction")


@query(
    "flatten_recommendations",
    """SELECT user_id, product_id, cast(rn AS int) AS rank, round(prediction, 6) AS score
       FROM (SELECT *, row_number() OVER (PARTITION BY user_id
                    ORDER BY prediction DESC, product_id) AS rn FROM predictions) WHERE rn <= 5""",
)
def flatten_recommendations(spark, folder):
    best = ranking.top_k(inputs.predictions(spark, folder), 5)
    indexes = {c: encode.dense_index(best, c, out) for c, out in encode.CODES.items()}
    entry = F.struct("rank", "item_idx", F.col("prediction").alias("rating"))
    nested = encode.encode(best.select("user_id", "product_id", "rank", "prediction"), indexes)
    arrays = nested.groupBy("user_idx").agg(F.sort_array(F.collect_list(entry)).alias("recommendations"))
    by_code = {encode.CODES[c]: index for c, index in indexes.items()}
    flat = recommend.flatten_recommendations(arrays, indexes=by_code)
    return flat.select("user_id", "product_id", "rank", F.round("score", 6).alias("score"))


@query("recommend_one_user")
def recommend_one_user(spark, folder):
    """For the most active user, whose code is 0."""
    trained = fitted(spark, folder)
    best = recommend.recommend_one(trained.model, trained.coded, 0, 10, "user_idx", "item_idx")
    return train.decode(settle(best), trained.indexes).select("user_id", "product_id", "prediction")


@query(
    "recommend_one_facts",
    """SELECT least(10, (SELECT count(DISTINCT product_id) FROM train)
                        - (SELECT max(n) FROM (SELECT count(*) AS n FROM clean_orders GROUP BY user_id))) AS rows,
              (SELECT max(n) FROM (SELECT count(*) AS n FROM clean_orders GROUP BY user_id)) AS user_rows,
              0 AS rated, 0 AS out_of_order""",
)
def recommend_one_facts(spark, folder):
    """The most active user's list is full, holds no rated product, and every entry scores as the model says, best first."""
    trained = fitted(spark, folder)
    best = settle(recommend.recommend_one(trained.model, trained.coded, 0, 10, "user_idx", "item_idx"))
    named = settle(train.decode(best, trained.indexes))
    rated = named.join(trained.coded.select("user_id", "product_id"), ["user_id", "product_id"], "left_semi")
    own_rows = trained.coded.filter("user_idx = 0").count()  # so many more entries hold ten unseen ones
    every = trained.model.recommendForUserSubset(best.select("user_idx").distinct(), 10 + own_rows)
    scores = every.select(F.inline("recommendations")).select("item_idx", F.col("rating").alias("score"))
    unseen = scores.join(trained.coded.filter("user_idx = 0").select("item_idx"), "item_idx", "left_anti")
    order = Window.orderBy(F.desc("score"), "item_idx")  # over one user's ten best
    top = unseen.orderBy(F.desc("score"), "item_idx").limit(10).withColumn("at", F.row_number().over(order))
    mine = best.withColumn("at", F.row_number().over(Window.orderBy(F.desc("prediction"), "item_idx")))
    off = mine.join(top.select("at", "score"), "at").filter(F.abs(F.col("prediction") - F.col("score")) > 1e-4)
    count = lambda df: df.agg(F.count(F.lit(1)).cast("int")).scalar()
    own = trained.coded.join(F.broadcast(named.select("user_id").distinct()), "user_id", "left_semi")
    return named.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows", own.agg(F.count(F.lit(1))).scalar().alias("user_rows"),
        count(rated).alias("rated"), count(off).alias("out_of_order"),
    )


@query(
    "train_report_facts",
    f"""SELECT unnest(['settings:train_rows', 'settings:rank', 'settings:iterations', 'settings:reg', 'test:test_rows',
                       'test:scored_rows', 'test:cold_start_rows', 'test:scored_pct', 'error:rmse_within', 'error:mae_within']) AS metric,
               unnest([(SELECT count(*) FROM train), {model.FAST.rank}, {model.FAST.iterations}, {model.FAST.reg},
                       t.n, t.k, t.n - t.k, round(t.k / t.n * 100, 2), 1.0, 1.0]::double[]) AS value
        FROM (SELECT count(*) AS n, count(*) FILTER (WHERE {KNOWN}) AS k FROM test) t""",
)
def train_report_facts(spark, folder):
    """Sizes, settings and yield as SQL counts them; the errors are those of the predictions, worked out here anew."""
    trained = fitted(spark, folder)
    report = settle(train.train_report(trained))
    off = F.col("rating") - F.col("prediction")
    errors = settle(trained.predictions().agg(F.sqrt(F.avg(off * off)).alias("rmse"), F.avg(F.abs(off)).alias("mae")))
    name = F.concat_ws(":", "section", "metric")
    counts = report.filter("section <> 'error' AND metric <> 'fit_seconds'").select(name.alias("metric"), "value")
    for error in ("rmse", "mae"):
        same = (F.abs(F.col("value") - errors.select(error).scalar()) < 1e-4).cast("double")
        one = report.filter((F.col("section") == "error") & (F.col("metric") == error))
        counts = counts.unionByName(one.select(F.lit(f"error:{error}_within").alias("metric"), same.alias("value")))
    return counts


@query(
    "recommend_popular",
    """SELECT u.user_id, b.product_id, cast(b.rank AS int) AS rank
       FROM (SELECT DISTINCT user_id FROM orders_feed) u CROSS JOIN best_products b""",
)
def recommend_popular(spark, folder):
    feed = feeds.orders_feed(spark, folder)
    return recommend.recommend_popular(feed, relate.distinct_of(feed, "user_id"))


@query("train_report")
def train_report(spark, folder):
    return train.train_report(fitted(spark, folder), new_path(spark, "als"))
