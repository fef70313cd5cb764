"""Invariants of the splits, the model and the recommendations."""

import subprocess
import sys
import time
from dataclasses import replace
from pathlib import Path
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from tasteloom.operators import clean, encode, evaluate, model, recommend, split
from tasteloom.plans import train as plans
from tasteloom.registry import modelling
from tasteloom.shared import new_path
from tasteloom.sources import feeds
from tests.helpers import plan_of, rows

SPEC = replace(model.FAST, rank=4, iterations=5)


@pytest.fixture(scope="module")
def ratings(spark, small):
    events = feeds.events_feed(spark, small)
    return clean.dedup(clean.in_range(events)).select("user_id", "product_id", "rating").cache()


@pytest.fixture(scope="module")
def trained(ratings):
    return plans.train(ratings, SPEC)


def factors(frame):
    found = frame.orderBy("id").collect()
    return [r.id for r in found], np.array([r.features for r in found], dtype="float64")


def best_by_hand(trained, n):
    """Score every pair, leave out the rated ones, sort."""
    users, left = factors(trained.model.userFactors)
    items, right = factors(trained.model.itemFactors)
    seen = {(r.user_idx, r.item_idx) for r in trained.train.collect()}
    scores = (left @ right.T).astype("float32")
    lists = {}
    for i, user in enumerate(users):
        open_items = [(-scores[i, j], item) for j, item in enumerate(items) if (user, item) not in seen]
        lists[user] = [(item, -score) for score, item in sorted(open_items)[:n]]
    return lists


def lists_of(df):
    out = {}
    for r in df.orderBy("user_idx", "rank").collect():
        out.setdefault(r.user_idx, []).append((r.item_idx, r.prediction))
    return out


@pytest.mark.parametrize("user_block, item_block", [(16_384, 65_536), (5, 7), (1, 1_000)])
def test_unseen_lists_equal_brute_force(trained, user_block, item_block):
    got = lists_of(
        recommend.recommend_unseen(
            trained.model, trained.train, 6, "user_idx", "item_idx", user_block, item_block
        )
    )
    expected = best_by_hand(trained, 6)
    assert set(got) == {u for u, items in expected.items() if items}
    for user, items in got.items():
        assert [s for _, s in items] == pytest.approx([s for _, s in expected[user]], rel=1e-5)
        assert [i for i, _ in items] == [i for i, _ in expected[user]]


def test_unseen_lists_for_some_users(trained):
    some = trained.train.select("user_idx").distinct().orderBy("user_idx").limit(3)
    got = lists_of(
        recommend.recommend_unseen(trained.model, trained.train, 4, "user_idx", "item_idx", users=some)
    )
    expected = best_by_hand(trained, 4)
    assert got.keys() == {r.user_idx for r in some.collect()}
    assert all([i for i, _ in got[u]] == [i for i, _ in expected[u]] for u in got)


def test_k_above_the_catalogue(trained):
    got = lists_of(recommend.recommend_unseen(trained.model, trained.train, 500, "user_idx", "item_idx"))
    expected = best_by_hand(trained, 500)
    assert {u: len(i) for u, i in got.items()} == {u: len(i) for u, i in expected.items() if i}


def test_user_who_rated_everything_gets_nothing(trained):
    everything = trained.model.itemFactors.select(F.lit(0).alias("user_idx"), F.col("id").alias("item_idx"))
    seen = trained.train.select("user_idx", "item_idx").unionByName(everything)
    got = recommend.recommend_unseen(trained.model, seen, 5, "user_idx", "item_idx")
    assert got.filter("user_idx = 0").count() == 0


def test_ties_go_to_the_lower_item():
    scores = np.array([[1, 1, 1, 1], [0, 2, 2, -np.inf], [-np.inf, -np.inf, 5, -np.inf]], dtype="float32")
    row, column = recommend._best(scores, 2)
    assert list(zip(row.tolist(), column.tolist(), strict=True)) == [(0, 0), (0, 1), (1, 1), (1, 2), (2, 2)]


def test_block_function_works_where_the_package_is_missing(tmp_path):
    """As on an executor that has PySpark, numpy and pandas only."""
    blob = tmp_path / "function"
    blob.write_bytes(cloudpickle.dumps(recommend._block_kernel(1)))
    script = (
        "import pickle, numpy as np, pandas as pd\n"
        f"f = pickle.loads(open({str(blob)!r}, 'rb').read())\n"
        "one = np.array([1.0], dtype='float32')\n"
        "rows = pd.DataFrame({'kind': [0, 1, 1, 2], 'id': [5, 7, 8, 5], 'other': [0, 0, 0, 7],\n"
        "                     'features': [one, one, one, None]})\n"
        "print(f(rows)['item'].tolist())\n"
    )
    done = subprocess.run(
        [sys.executable, "-c", script], cwd="/", capture_output=True, text=True, timeout=60
    )
    assert done.stdout.strip() == "[8]", done.stderr


@pytest.mark.parametrize("low", [0.0, -1.0])
def test_most_pairs_are_ruled_out_and_the_lists_are_exact(spark, low):
    """Users that rated the best items and one without a taste among them."""
    rng = np.random.default_rng(3)
    left, right = (rng.uniform(low, 1, (m, 3)).astype("float32").round(2) for m in (1_500, 6_000))
    left[7] = 0
    frame = lambda m: spark.createDataFrame(
        [(i, f.tolist()) for i, f in enumerate(m)], "id int, features array<float>"
    )
    found = SimpleNamespace(userFactors=frame(left), itemFactors=frame(right))
    scores = (left.astype("float64") @ right.astype("float64").T).astype("float32")
    order = np.lexsort((np.broadcast_to(np.arange(6_000), scores.shape), -scores), axis=1)
    rated = {u: set(order[u, : 60 * (u % 3)].tolist()) for u in range(1_500)}
    seen = spark.createDataFrame([(u, i) for u, s in rated.items() for i in s], "user_idx int, item_idx int")
    got = lists_of(recommend.recommend_unseen(found, seen, 5, "user_idx", "item_idx"))
    for u in range(1_500):
        expected = [i for i in order[u].tolist() if i not in rated[u]][:5]
        assert [i for i, _ in got[u]] == expected
    head = right[np.unique(order[:200, :8])].astype("float64")
    centres = left[:50][np.arange(50) != 7].astype("float64")
    centres /= np.linalg.norm(centres, axis=1)[:, None]
    none = found.userFactors.withColumns({"other": F.lit(0), "held": F.lit(0)})
    cells = recommend._cells(recommend._placed(none, head, centres, 5), 3, len(centres))
    matches = recommend._matches(cells, list(range(len(cells))), len(centres), 3)
    _, group = matches(right.astype("float64"))
    assert sum(cells[g]["users"] for g in group) < 0.2 * scores.size
    assert sum(c["users"] for c in cells if c["cell"] == len(centres)) == 1


def test_one_user_equals_the_lists(trained):
    expected = best_by_hand(trained, 10)[2]
    got = recommend.recommend_one(trained.model, trained.train, 2, 10, "user_idx", "item_idx").collect()
    assert [r.item_idx for r in got] == [i for i, _ in expected]
    nobody = recommend.recommend_one(trained.model, trained.train, 10**6, 10, "user_idx", "item_idx")
    assert nobody.count() == 0


def test_lists_have_no_rated_pairs_and_falling_scores(trained):
    lists = trained.lists(10)
    seen = trained.coded.select("user_id", "product_id")
    assert lists.join(seen, ["user_id", "product_id"]).count() == 0
    for r in lists.groupBy("user_id").agg(F.sort_array(F.collect_list(F.struct("rank", "prediction"))).alias("l")).collect():
        assert [e["rank"] for e in r.l] == list(range(1, len(r.l) + 1))
        scores = [e["prediction"] for e in r.l]
        assert scores == sorted(scores, reverse=True)


def test_all_users_as_arrays(trained):
    nested = recommend.recommend_users(trained.model, 3)
    flat = recommend.flatten_recommendations(nested)
    assert flat.count() == 3 * trained.model.userFactors.count()
    by_code = {encode.CODES[c]: index for c, index in trained.indexes.items()}
    named = recommend.flatten_recommendations(nested, indexes=by_code)
    assert named.columns == ["rank", "score", "user_id", "product_id"]
    assert named.count() == flat.count()


def test_fit_is_repeatable_and_beats_the_product_mean(ratings, trained):
    again = plans.train(ratings, SPEC)
    first = evaluate.error_metrics(trained.predictions()).first()
    assert first.rmse == evaluate.error_metrics(again.predictions()).first().rmse
    fitted = evaluate.error_metrics(model.predict(trained.model, trained.train)).first().rmse
    means = model.mean_predictor(trained.train)
    baseline = evaluate.error_metrics(trained.train.join(means, "product_id")).first().rmse
    assert fitted < baseline


def test_factors_are_not_negative(trained):
    assert factors(trained.model.userFactors)[1].min() >= 0
    assert factors(trained.model.itemFactors)[1].min() >= 0


def test_user_factors_solve_their_equations(ratings):
    spec = replace(SPEC, nonnegative=False)
    fitted = plans.train(ratings, spec)
    items = dict(zip(*factors(fitted.model.itemFactors), strict=True))
    users = dict(zip(*factors(fitted.model.userFactors), strict=True))
    by_user = {}
    for r in fitted.train.collect():
        by_user.setdefault(r.user_idx, []).append((r.item_idx, r.rating))
    for user, rated in by_user.items():
        v = np.array([items[i] for i, _ in rated])
        target = v.T @ np.array([r for _, r in rated])
        left = (v.T @ v + spec.reg * len(rated) * np.eye(spec.rank)) @ users[user]
        assert np.linalg.norm(left - target) / np.linalg.norm(target) < 1e-5


def test_unknown_ids_are_dropped(spark, trained):
    pairs = spark.createDataFrame([(0, 0, 1.0), (0, 10**6, 1.0)], "user_idx int, item_idx int, rating double")
    assert model.predict(trained.model, pairs).count() == 1


def test_reloaded_model_predicts_the_same(spark, trained):
    again = model.load_model(model.save_model(trained.model, new_path(spark, "als")))
    columns = ["user_idx", "item_idx", "prediction"]
    assert rows(model.predict(again, trained.test), *columns) == rows(trained.predictions(), *columns)


def test_metrics_agree_with_mllib(trained):
    predictions = trained.predictions()
    ours = evaluate.error_metrics(predictions).first()
    for name in ("rmse", "mae", "r2"):
        theirs = RegressionEvaluator(metricName=name, labelCol="rating").evaluate(predictions)
        assert ours[name] == pytest.approx(theirs, abs=1e-5)


def test_reports(spark, trained):
    report = {r.metric: r.value for r in plans.train_report(trained).collect()}
    assert report["test_rows"] == report["scored_rows"] + report["cold_start_rows"]
    full = {r.metric: r.value for r in plans.evaluation_report(trained, 5).collect()}
    assert full["train_size"] + full["test_size"] == report["train_rows"] + report["test_rows"]
    assert 0 <= full["precision_at_5"] <= 1 and 0 <= full["recall_at_5"] <= 1
    assert full["rmse"] == report["rmse"]


@pytest.mark.parametrize("how", ["hash", "random"])
def test_split_is_disjoint_and_complete(ratings, how):
    known, held_out = split.split(ratings, how=how)
    assert rows(known.unionByName(held_out)) == rows(ratings)
    assert known.join(held_out, ["user_id", "product_id"]).count() == 0
    shares = {r.part: r.share_pct for r in split.split_sizes(known, held_out).collect()}
    assert 70 < shares["train"] < 90


def test_settled_split_needs_no_hash_later(ratings):
    whole, known, held_out = split.settled_split(ratings)
    assert [rows(d) for d in (whole, known, held_out)] == [rows(d) for d in (ratings, *split.split(ratings))]
    assert "md5" in plan_of(split.split(ratings)[0])
    assert "md5" not in plan_of(known) and "md5" not in plan_of(held_out)
    _, some, others = split.settled_split(ratings, how="random")
    assert rows(some.unionByName(others)) == rows(ratings)


def test_rows_of_a_trained_model_need_no_hash(trained):
    for df in (trained.train, trained.test, trained.predictions()):
        assert "md5" not in plan_of(df)


def test_report_works_predictions_out_once(trained):
    """What the report reads are written rows, not the joins with the factors."""
    report = plan_of(plans.train_report(trained))
    assert "features" not in report


def test_unknown_split(ratings):
    with pytest.raises(ValueError):
        split.split(ratings, how="time")


def test_hash_split_does_not_depend_on_partitions(ratings):
    assert rows(split.split(ratings)[0]) == rows(split.split(ratings.repartition(3))[0])


def test_dense_index_equals_string_indexer(spark, ratings):
    from pyspark.ml.feature import StringIndexer

    fitted = StringIndexer(inputCol="product_id", outputCol="idx").fit(ratings)
    expected = {label: i for i, label in enumerate(fitted.labels)}
    for partitions in ("1", "3", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        index = encode.dense_index(ratings, "product_id", "item_idx").collect()
        assert {str(r.product_id): r.item_idx for r in index} == expected


def test_hash_codes(ratings):
    coded = encode.hash_codes(ratings)
    assert coded.groupBy("user_id").agg(F.count_distinct("user_idx").alias("n")).filter("n > 1").count() == 0
    report = {r.column_name: r for r in encode.hash_collisions(ratings).collect()}
    assert report["user_id"].ids == ratings.select("user_id").distinct().count()
    assert report["user_id"].ids - report["user_id"].codes <= report["user_id"].colliding_ids


def test_metrics_without_rows(spark):
    nothing = spark.createDataFrame([], "user_id long, product_id long, rating double, prediction double")
    assert evaluate.error_metrics(nothing).first().rmse is None
    ranking = evaluate.ranking_metrics(nothing, nothing).first()
    assert (ranking.precision, ranking.recall) == (0.0, 0.0)
    assert evaluate.score_spread(nothing).first().diversity == 0.0
    assert evaluate.coverage_candidates(nothing).first().coverage_pct == 0.0


def test_one_user_is_checked_without_a_list_of_the_catalogue(spark, small, monkeypatch):
    """Ten entries and as many as the user rated are enough."""
    asked, whole = [], model.ALSModel.recommendForUserSubset

    def noted(self, users, n):
        asked.append(n)
        return whole(self, users, n)

    monkeypatch.setattr(model.ALSModel, "recommendForUserSubset", noted)
    found = modelling.recommend_one_facts(spark, small).first()
    assert asked == [10 + found.user_rows]
    assert (found.rows, found.rated, found.out_of_order) == (10, 0, 0)


def test_blocks_follow_memory_not_more(spark):
    """Every block more is another copy of the factors in every iteration."""
    count = lambda spec, rows: (spec.estimator(rows).getNumUserBlocks(), spec.estimator(rows).getNumItemBlocks())
    assert count(model.FULL, 0) == count(model.FULL, 172_800_000) == (10, 10)
    assert count(model.FULL, 4_000_000_000) == (200, 200)
    assert count(model.BLOCKED, 172_800_000) == (20, 20)


def test_shuffles_of_past_iterations_are_freed(spark, trained):
    """What a fit leaves on disk does not grow with its iterations."""
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()

    def shuffles():
        return {f.name.split("_")[1] for d in folders for f in Path(d).rglob("shuffle_*.data")}

    before = shuffles()
    spec = replace(trained.spec, iterations=9)  # 18 shuffles of factors
    fitted = model.fit(trained.train, spec)
    assert fitted.userFactors.count() == trained.model.userFactors.count()
    for _ in range(50):  # files are deleted in the background
        if len(shuffles() - before) < 9:
            break
        time.sleep(0.2)
    assert len(shuffles() - before) < 9
