"""Queries for samples, mergeable summaries, and tables that are kept and read again."""

from __future__ import annotations

from pyspark.sql import functions as F

from tasteloom.functions.scalar import utc_day
from tasteloom.operators import clean, features, profile, ranking, sampling, sketches, stats
from tasteloom.plans import ingest
from tasteloom.registry import cleaning, inputs
from tasteloom.registry.book import query
from tasteloom.shared import new_path, settle
from tasteloom.sources import feeds, readers, writers
from tasteloom.sources.bucketed import Bucketed

KEYED = "ORDER BY substr(md5('42|=' || event_id), 1, 15) LIMIT"
SAMPLE = 700


@query("sample_exact", f"SELECT * FROM events_feed {KEYED} {SAMPLE}")
def sample_exact(spark, folder):
    return sampling.bottom_k(feeds.events_feed(spark, folder), SAMPLE, ["event_id"])


@query(
    "sample_share",
    f"SELECT * FROM events_feed {KEYED} (SELECT cast(floor(count(*) * 0.1) AS bigint) FROM events_feed)",
)
def sample_share(spark, folder):
    return sampling.sample_share(feeds.events_feed(spark, folder), 0.1, ["event_id"])


@query("sample_merged", f"SELECT * FROM events_feed {KEYED} {SAMPLE}")
def sample_merged(spark, folder):
    """The samples of two halves, merged, are the sample of both."""
    events = feeds.events_feed(spark, folder)
    early = sampling.bottom_k(events.filter("event_id % 2 = 0"), SAMPLE, ["event_id"])
    late = sampling.bottom_k(events.filter("event_id % 2 <> 0"), SAMPLE, ["event_id"])
    return sampling.bottom_k(settle(early.unionByName(late), "halves"), SAMPLE, ["event_id"])


@query("clean_watched", cleaning.AUDIT)
def clean_watched(spark, folder):
    """The audit, taken by the pass that writes the clean rows."""
    watched = clean.Watched(feeds.dirty_feed(spark, folder))
    with watched.writing:
        settle(watched.rows, "clean")
    return watched.audit()


def _near(estimates, exact):
    """Estimated distinct values against exact ones."""
    known = exact.select("column_name", F.col("distinct_count").alias("exact"))
    close = F.abs(F.col("distinct_count") - F.col("exact")) <= 0.02 * F.col("exact")
    return estimates.join(F.broadcast(known), "column_name").select(
        "column_name", "total_rows", "null_count", close.alias("within_2_pct")
    )


DIRTY = ["user_id", "product_id", "rating", "ts"]
SKETCHED = " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count(*) AS total_rows, count(*) FILTER (WHERE {c} IS NULL) AS null_count,
               true AS within_2_pct FROM dirty_feed"""
    for c in DIRTY
)


@query("ingest_sketched", SKETCHED)
def ingest_sketched(spark, folder):
    """Rows, nulls and distinct values of every column, from the pass that writes the feed."""
    feed, kept = ingest.ingest_sketched(feeds.dirty_feed(spark, folder).select(*DIRTY))
    return _near(sketches.distinct_estimates(kept), profile.distinct_values(feed))


@query("profile_merged", SKETCHED)
def profile_merged(spark, folder):
    """A stored profile merged with that of newer rows, without reading the old rows again."""
    rows = feeds.dirty_feed(spark, folder).select(*DIRTY)
    # The earlier days of each week stand for what is stored; rows without a time are new.
    old = F.coalesce(F.floor(F.col("ts") / 86400) % 7 < 4, F.lit(False))
    stored = settle(sketches.column_sketches(rows.filter(old)), "profile")
    merged = sketches.merge_columns(stored, sketches.column_sketches(rows.filter(~old)))
    return _near(sketches.distinct_estimates(merged), profile.distinct_values(rows))


MONTH = "strftime(to_timestamp(ts) AT TIME ZONE 'UTC', '%Y-%m')"


def _month():
    return F.date_format(utc_day(F.col("ts")), "yyyy-MM")


@query(
    "median_sketches",
    f"""SELECT {MONTH} AS month, count(rating) AS rows, true AS within_1_pct FROM orders_feed GROUP BY 1
        UNION ALL SELECT 'all', count(rating), true FROM orders_feed""",
)
def median_sketches(spark, folder):
    """Medians per month, and of the months' sketches merged, with the rank of each checked on exact counts."""
    feed = feeds.orders_feed(spark, folder).select("rating", _month().alias("month"))
    monthly = settle(sketches.quantile_sketches(feed, ["month"]), "months")
    whole = sketches.merge_quantiles(monthly).select(F.lit("all").alias("month"), "rows", "sketch")
    medians = sketches.quantiles(monthly.unionByName(whole))
    counts = settle(feed.groupBy("month", "rating").agg(F.count("rating").alias("n")), "counts")
    every = counts.unionByName(counts.withColumn("month", F.lit("all")))
    met = every.join(F.broadcast(medians), "month")
    below = F.sum(F.when(F.col("rating") < F.col("median"), F.col("n")).otherwise(0))
    upto = F.sum(F.when(F.col("rating") <= F.col("median"), F.col("n")).otherwise(0))
    return met.groupBy("month", "rows").agg(
        ((below <= F.col("rows") * 0.51) & (upto >= F.col("rows") * 0.49)).alias("within_1_pct")
    )


@query(
    "distinct_by_bitmap",
    f"""SELECT substr({MONTH}, 1, 4) AS year, count(DISTINCT user_id) AS users, count(DISTINCT product_id) AS products
        FROM orders_feed GROUP BY 1
        UNION ALL SELECT 'all', count(DISTINCT user_id), count(DISTINCT product_id) FROM orders_feed""",
)
def distinct_by_bitmap(spark, folder):
    """Distinct users and products per year and over all, from monthly bitmaps."""
    feed = settle(feeds.orders_feed(spark, folder).select("user_id", "product_id", _month().alias("month")), "feed")
    out = None
    for column, name in (("user_id", "users"), ("product_id", "products")):
        monthly = settle(sketches.code_bitmaps(feed, column, ["month"]), "bitmaps")
        yearly = sketches.merge_bitmaps(monthly.withColumn("year", F.substring("month", 1, 4)), ["year"])
        whole = sketches.merge_bitmaps(monthly).withColumn("year", F.lit("all"))
        counts = sketches.distinct_codes(yearly.unionByName(whole), ["year"], name)
        out = counts if out is None else out.join(counts, "year")
    return out


@query(
    "popularity_rank",
    """SELECT product_id, score, dense_rank() OVER (ORDER BY score DESC) AS place
       FROM (SELECT product_id, round(avg(rating) * ln(count(rating) + 1), 9) AS score FROM orders_feed GROUP BY 1)""",
)
def popularity_rank(spark, folder):
    """Dense rank by a continuous score."""
    scored = stats.popularity_score(feeds.orders_feed(spark, folder))
    table = settle(scored.select("product_id", F.round("score", 9).alias("score")), "scores")
    return ranking.value_rank(table, "score", "place")


@query(
    "bucketed_features",
    """SELECT f.user_id, f.product_id, f.rating, f.ts, u.user_activity_score, u.user_avg_rating, r.user_rank
       FROM orders_feed f JOIN user_features u USING (user_id)
            JOIN (SELECT user_id, user_rank FROM ranked_users) r USING (user_id)""",
)
def bucketed_features(spark, folder):
    """Two joins on the user over one bucketed feed."""
    feed = settle(feeds.orders_feed(spark, folder), "feed")
    users = settle(features.user_features(feed), "users")
    ranked = ranking.count_rank(users, "user_activity_score", "user_rank").select("user_id", "user_rank")
    laid = Bucketed(feed, "user_id", int(spark.conf.get("spark.sql.shuffle.partitions")))
    return laid.join([users.select("user_id", "user_activity_score", "user_avg_rating"), ranked])


@query(
    "csv_rejects",
    """SELECT event_id, coalesce(product_id, '') || ',' || user_id || ',' || event_id AS rejected_line,
              (SELECT count(*) FROM dirty_feed2 WHERE user_id IS NOT NULL AND user_id <> 'U-bad') AS good_rows
       FROM dirty_feed2 WHERE user_id = 'U-bad'""".replace(
        "dirty_feed2",
        """(SELECT event_id, CASE WHEN event_id % 37 = 0 THEN NULL WHEN event_id % 53 = 0 THEN 'U-bad'
                   ELSE cast(user_id AS varchar) END AS user_id, cast(product_id AS varchar) AS product_id
            FROM events_feed)""",
    ),
)
def csv_rejects(spark, folder):
    """Lines of a file that its types cannot hold, written aside as they stand, and the number of rows that are left."""
    lines = feeds.dirty_events(spark, folder).filter("user_id IS NOT NULL")
    path, aside = new_path(spark, "events-csv"), new_path(spark, "rejects")
    text = F.concat_ws(",", F.coalesce("product_id", F.lit("")), "user_id", F.col("event_id").cast("string"))
    lines.select(text).write.text(path)
    good = readers.divert(spark, path, aside, readers.EVENT_SCHEMA)
    rejects = spark.read.text(aside).withColumnRenamed("value", "rejected_line")
    number = F.element_at(F.split("rejected_line", ","), -1).cast("long")
    return rejects.select(number.alias("event_id"), "rejected_line", good.agg(F.count(F.lit(1))).scalar().alias("good_rows"))


@query(
    "run_rerun",
    """SELECT user_id, product_id, rating, 'r1' AS run FROM recs
       UNION ALL SELECT user_id, product_id, rating, 'r2' FROM recs WHERE rating >= 3""",
)
def run_rerun(spark, folder):
    """Two runs side by side; the second one is written again and replaces its own folder alone."""
    recs, base = inputs.recs(spark, folder), new_path(spark, "runs")
    for rows, run in ((recs, "r1"), (recs, "r2"), (recs.filter("rating >= 3"), "r2")):
        writers.write_run(rows, base, run)
    return spark.read.parquet(base).select("user_id", "product_id", "rating", F.col("run").cast("string").alias("run"))


@query(
    "feature_frames",
    """SELECT 'training' AS frame, cast(user_id AS bigint) AS user_id, cast(product_id AS bigint) AS product_id,
              rating, NULL::int AS user_rank, NULL::int AS product_rank FROM orders_feed
       UNION ALL SELECT 'features', f.user_id, f.product_id, f.rating, u.user_rank, p.product_rank
       FROM orders_feed f JOIN ranked_users u USING (user_id) JOIN ranked_products p USING (product_id)""",
)
def feature_frames(spark, folder):
    """The training frame and the rows with all features, from one call."""
    training, rows = features.feature_frames(feeds.orders_feed(spark, folder))
    none = F.lit(None).cast("int")
    first = training.select(
        F.lit("training").alias("frame"), F.col("user_id").cast("long").alias("user_id"),
        F.col("product_id").cast("long").alias("product_id"), F.col("rating").cast("double").alias("rating"),
        none.alias("user_rank"), none.alias("product_rank"),
    )
    second = rows.select(F.lit("features").alias("frame"), "user_id", "product_id", "rating", "user_rank", "product_rank")
    return first.unionByName(second)
