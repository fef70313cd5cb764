"""Top-N recommendations."""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasteloom.functions.scalar import dot
from tasteloom.operators.ranking import top_k, top_n
from tasteloom.operators.relate import with_each, with_ids
from tasteloom.operators.stats import popularity_score
from tasteloom.shared import settle
from tasteloom.spread import spread_join

# Executors need not have this package: the functions below travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

USER, ITEM, SEEN = 0, 1, 2
# Scores that a task holds at once.
CELLS = 8_388_608
# Rows of blocks that a task works through, one block after the other, on average at most.
TASK_ROWS = 2_000_000
# Users whose factors shape the search; those whose best items make the head; items of the head at most.
SAMPLE, GUIDES, HEAD = 8_192, 512, 8_192
# Users around one of the sample, on average at least.
CELL_USERS = 32
# Scores that take about as long as sending a row.
ROW_COST = 200


def recommend_users(model: ALSModel, n: int = 10, users: DataFrame | None = None) -> DataFrame:
    """Top-``n`` items as an array per user, for all users or for those given.

    Searches as ``recommend_unseen`` does, with nothing to leave out.
    """
    user, item = model.getOrDefault("userCol"), model.getOrDefault("itemCol")
    nothing = model.userFactors.select(F.col("id").alias(user), F.col("id").alias(item)).filter(F.lit(False))
    best = recommend_unseen(model, nothing, n, user, item, users=users)
    entry = F.struct("rank", F.col(item), F.col("prediction").alias("rating"))
    lists = best.groupBy(user).agg(F.sort_array(F.collect_list(entry)).alias("_all"))
    bare = F.transform("_all", lambda e: F.struct(e[item].alias(item), e["rating"].alias("rating")))
    return lists.select(user, bare.alias("recommendations"))


def _best(scores: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column numbers of the ``n`` best finite scores of every row.

    Equal scores: the lower column wins.
    """
    n = min(n, scores.shape[1])
    least = -np.partition(-scores, n - 1, axis=1)[:, n - 1 : n]
    chosen = (scores >= least) & np.isfinite(scores)
    crowded = np.flatnonzero(chosen.sum(axis=1) > n)
    for row in crowded:
        order = np.argsort(-scores[row], kind="stable")[:n]
        chosen[row] = False
        chosen[row, order] = np.isfinite(scores[row, order])
    return np.nonzero(chosen)


def _found(ids: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of ``wanted`` in the sorted ``ids``, and which of them exist."""
    at = np.minimum(np.searchsorted(ids, wanted), len(ids) - 1)
    return at, ids[at] == wanted


def _kept(scores: np.ndarray, floors: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column numbers of the finite scores that reach the row's floor, the best ``limits`` of a row at most.

    Equal scores: the lower column wins.
    """
    chosen = (scores >= floors[:, None]) & np.isfinite(scores)
    for row in np.flatnonzero(chosen.sum(axis=1) > limits):
        at, limit = np.flatnonzero(chosen[row]), limits[row]
        least = -np.partition(-scores[row, at], limit - 1)[limit - 1]
        at = at[scores[row, at] >= least]
        chosen[row] = False
        chosen[row, at[np.argsort(-scores[row, at], kind="stable")[:limit]]] = True
    return np.nonzero(chosen)


def _block_kernel(n: int):
    def best_of_block(rows: pd.DataFrame) -> pd.DataFrame:
        """The best unseen items of one item block for every user of one user block.

        Rated pairs in the block are left out.  ``other`` of a user is the number of rated items that are left out
        later, so that many more are passed on; what is below the user's ``floor`` is not.
        """
        users = rows[rows["kind"] == USER].sort_values("id")
        items = rows[rows["kind"] == ITEM].sort_values("id")
        seen = rows[rows["kind"] == SEEN]
        out = [pd.DataFrame({"user": [], "item": [], "score": []})]
        if len(users) and len(items):
            user_ids, item_ids = users["id"].to_numpy(), items["id"].to_numpy()
            left = np.stack(users["features"].to_numpy()).astype("float64")
            right = np.stack(items["features"].to_numpy()).astype("float64").T
            limits = n + users["other"].to_numpy().astype("int64")
            floors = users["floor"].to_numpy() if "floor" in users else np.full(len(users), -np.inf)
            at_user, known_user = _found(user_ids, seen["id"].to_numpy())
            at_item, known_item = _found(item_ids, seen["other"].to_numpy())
            at_user, at_item = (a[known_user & known_item] for a in (at_user, at_item))
            chunk = max(1, CELLS // len(item_ids))
            for start in range(0, len(user_ids), chunk):
                scores = (left[start : start + chunk] @ right).astype("float32")
                here = (at_user >= start) & (at_user < start + chunk)
                scores[at_user[here] - start, at_item[here]] = -np.inf
                row, column = _kept(scores, floors[start : start + chunk], limits[start : start + chunk])
                found = {"user": user_ids[start + row], "item": item_ids[column]}
                out.append(pd.DataFrame({**found, "score": scores[row, column]}))
        return pd.concat(out[1:]) if len(out) > 1 else out[0]

    return best_of_block


def _matrix(rows: pd.Series, rank: int) -> np.ndarray:
    return np.stack(rows.to_numpy()).astype("float64") if len(rows) else np.empty((0, rank))


def _head(items: DataFrame, guides: np.ndarray, each: int) -> list:
    """Items (``id``, ``features``) that are among the best ``each`` of one of the ``guides``."""
    rank = guides.shape[1]

    def best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            if len(rows):
                rows = rows.sort_values("id")
                scores = (guides @ _matrix(rows["features"], rank).T).astype("float32")
                guide, at = _best(scores, each)
                found = {"guide": guide, "id": rows["id"].to_numpy()[at], "score": scores[guide, at]}
                yield pd.DataFrame({**found, "features": rows["features"].to_numpy()[at]})

    found = items.select("id", "features").mapInPandas(best, "guide int, id int, score float, features array<float>")
    chosen = top_k(found, each, "guide", [F.desc("score"), F.col("id")])
    return chosen.groupBy("id").agg(F.first("features").alias("features")).orderBy("id").collect()


def _placed(users: DataFrame, head: np.ndarray, centres: np.ndarray, n: int) -> DataFrame:
    """``users`` with ``floor``, which ``n`` unseen items of the ``head`` reach, and ``cell``, the most similar centre.

    ``held`` is the number of items of the head that the user rated.  Users for whom the head is too short, or who
    score 0 throughout, are in a cell of their own, the last.  Floors are a little too low, never too high.
    """
    rank, size, last = head.shape[1], len(head), len(centres)
    reach = float(np.sqrt((head**2).sum(axis=1)).max()) if size else 0.0

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        step = max(1, CELLS // max(1, size, last))
        for batch in batches:
            for start in range(0, len(batch), step):
                rows = batch.iloc[start : start + step].copy()
                left = _matrix(rows["features"], rank)
                wanted = n + rows["held"].to_numpy().astype("int64")
                norm = np.sqrt((left**2).sum(axis=1))
                floor = np.full(len(rows), -np.inf)
                if size:
                    scores = (left @ head.T).astype("float32")
                    scores[~np.isfinite(scores)] = -np.inf
                    few = min(size, n + 32)
                    top = -np.sort(np.partition(-scores, few - 1, axis=1)[:, :few], axis=1)
                    near = np.flatnonzero(wanted <= few)
                    floor[near] = top[near, wanted[near] - 1]
                    for row in np.flatnonzero((wanted > few) & (wanted <= size)):
                        floor[row] = -np.partition(-scores[row], wanted[row] - 1)[wanted[row] - 1]
                    floor -= 1e-6 * np.abs(floor) + 1e-9 * norm * reach
                known = np.isfinite(floor) & np.isfinite(norm) & (norm > 0) & (last > 0)
                cell = np.full(len(rows), last)
                if known.any():
                    cell[known] = np.argmax(left[known] / norm[known, None] @ centres.T, axis=1)
                floor[~known] = -np.inf
                rows["norm"], rows["floor"], rows["cell"] = norm, floor, cell
                yield rows[["id", "features", "other", "norm", "floor", "cell"]]

    return users.mapInPandas(
        place, "id int, features array<float>, other int, norm double, floor double, cell int"
    )


def _cells(placed: DataFrame, rank: int, last: int) -> list:
    """Per cell: users, the least floor and the bounds of every coordinate, all for users of length one."""
    unit = [F.try_divide(F.col("features")[k].cast("double"), F.col("norm")) for k in range(rank)]
    bounds = [F.array(*[f(u) for u in unit]).alias(name) for f, name in ((F.min, "low"), (F.max, "high"))]
    least = F.min(F.try_divide("floor", "norm")).alias("least")
    found = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("users"), least, *bounds)
    return found.filter(F.col("cell") <= last).orderBy("cell").collect()


def _matches(cells: list, groups: list[int], last: int, rank: int):
    """A function that says for items in which groups of cells a user might score one of them as high as the floor."""
    order = np.argsort(groups, kind="stable")
    firsts = np.flatnonzero(np.diff(np.asarray(groups)[order], prepend=-1))
    names = np.asarray(groups)[order][firsts]
    inner = [cells[i] for i in order]
    low = np.array([c["low"] if c["cell"] < last else [0.0] * rank for c in inner], dtype="float64").T
    high = np.array([c["high"] if c["cell"] < last else [0.0] * rank for c in inner], dtype="float64").T
    least = np.array([c["least"] if c["cell"] < last else -np.inf for c in inner])

    def matches(features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and the names of their groups."""
        slack = 1e-9 * np.sqrt((features**2).sum(axis=1))
        bound = np.maximum(features, 0) @ high
        if (features < 0).any():
            bound += np.minimum(features, 0) @ low
        bound += slack[:, None]
        met = bound >= least
        row, at = np.nonzero(met if len(names) == len(inner) else np.logical_or.reduceat(met, firsts, axis=1))
        return row, names[at]

    return matches


def _candidates(items: DataFrame, matches, size: int, rank: int, counted: bool = False) -> DataFrame:
    """Items with every group (``grp``) where they are candidates, or ``counted`` per group."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        step = max(1, CELLS // 8 // max(1, size))
        for batch in batches:
            for start in range(0, len(batch), step):
                rows = batch.iloc[start : start + step]
                row, group = matches(_matrix(rows["features"], rank))
                if counted:
                    group, times = np.unique(group, return_counts=True)
                    yield pd.DataFrame({"grp": group, "n": times})
                else:
                    found = {"grp": group, "id": rows["id"].to_numpy()[row]}
                    yield pd.DataFrame({**found, "features": rows["features"].to_numpy()[row]})

    schema = "grp int, n long" if counted else "grp int, id int, features array<float>"
    return items.select("id", "features").mapInPandas(run, schema)


def recommend_unseen(
    model: ALSModel,
    seen: DataFrame,
    n: int = 10,
    user: str = "user_id",
    item: str = "product_id",
    user_block: int = 16_384,
    item_block: int = 65_536,
    users: DataFrame | None = None,
) -> DataFrame:
    """The ``n`` best items per user that the user has not rated.

    The search is exact, but most pairs are never scored.  The best items of a bounded sample of
    users are the head.  Among its items that a user has not rated the ``n``-th best gives the floor: no
    lower score can be in the list.  Users are grouped in cells by the direction of their factors; an item meets a
    cell only if some user within the cell's bounds could score it as high as the cell's least floor.
    The sample decides how much is scored, not the result.

    Users and candidates of a cell are cut into blocks of about the given sizes.  A group of rows is a
    block of each; it passes on what reaches the floor, ``n`` items and as many as the user
    has rated at most.  Rated pairs then go, and the rest is merged per user.  Where bounds rule out so little that
    blocks alone would be cheaper, cells are merged into such blocks.  ``seen`` is read several times.
    """
    factors, items = model.userFactors, model.itemFactors
    rated = seen.select(F.col(user).cast("int").alias("id"), F.col(item).cast("int").alias("other"))
    if users is not None:
        wanted = users.select(F.col(user).cast("int").alias("id")).distinct()
        factors = factors.join(wanted, "id", "left_semi")
        rated = settle(spread_join(rated, wanted, ["id"], "left_semi", identity=["other"]), "rated")
    spark = seen.sparkSession
    cores = spark.sparkContext.defaultParallelism
    people, things = factors.count(), items.count()

    some = factors.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).collect()
    rank = len(some[0]["features"]) if some else 0
    sample = np.array([r["features"] for r in some], dtype="float64").reshape(len(some), rank)
    norms = np.sqrt((sample**2).sum(axis=1))
    sample = sample[np.isfinite(norms) & (norms > 0)]
    sample /= np.sqrt((sample**2).sum(axis=1))[:, None]
    each = n + n // 2 + 1
    guides = sample[: max(1, min(GUIDES, HEAD // each))]
    head = _head(items, guides, each) if len(guides) else []
    centres = sample[: math.ceil(people / CELL_USERS)]
    last = len(centres)

    named = spark.createDataFrame([(r["id"],) for r in head], "other int")
    held = rated.join(F.broadcast(named), "other", "left_semi").distinct()
    held = held.groupBy("id").agg(F.count(F.lit(1)).cast("int").alias("held"))
    known = rated.groupBy("id").agg(F.count(F.lit(1)).cast("int").alias("other"))
    counted = factors.join(known, "id", "left").join(held, "id", "left").na.fill(0, ["other", "held"])
    best_known = np.array([r["features"] for r in head], dtype="float64").reshape(len(head), rank)
    placed = settle(_placed(counted, best_known, centres, n), "users")

    cells = _cells(placed, rank, last)
    groups = list(range(len(cells)))
    sizes = dict(
        _candidates(items, _matches(cells, groups, last, rank), len(cells), rank, counted=True)
        .groupBy("grp").agg(F.sum("n")).collect()
    ) if cells else {}
    plain = max(1, math.ceil(people / user_block))
    # What is scored and sent by cells, and by blocks alone.
    by_cells = sum(sizes.get(i, 0) * (c["users"] + ROW_COST) for i, c in enumerate(cells))
    if by_cells > things * (people + ROW_COST * plain):
        groups = [i * plain // len(cells) for i in groups]
        sizes = dict.fromkeys(groups, things)
    crowd = dict.fromkeys(groups, 0)
    for group, cell in zip(groups, cells, strict=True):
        crowd[group] += cell["users"]
    cut = {g: (math.ceil(crowd[g] / user_block), math.ceil(sizes.get(g, 0) / item_block) or 1) for g in crowd}
    layout = [(c["cell"], g, *cut[g]) for g, c in zip(groups, cells, strict=True)]
    by_cell = spark.createDataFrame(layout, "cell int, grp int, ubs int, ibs int")
    by_group = spark.createDataFrame([(g, *b) for g, b in cut.items()], "grp int, ubs int, ibs int")
    pairs = sum(a * b for a, b in cut.values())
    sent = sum(crowd[g] * b + sizes.get(g, 0) * a for g, (a, b) in cut.items())
    tasks = max(1, min(pairs, max(4 * cores, math.ceil(sent / TASK_ROWS))))

    def at(blocks: str) -> Column:
        return F.pmod(F.xxhash64("id"), F.col(blocks).cast("long")).cast("int")

    def every(blocks: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))

    def part(source: DataFrame, kind: int, ub: Column, ib: Column, other: Column, floor: Column) -> DataFrame:
        return source.select(
            "grp", ub.alias("ub"), ib.alias("ib"), F.lit(kind).alias("kind"), "id",
            other.alias("other"), "features", floor.alias("floor"),
        )

    if cells:
        found = _candidates(items, _matches(cells, groups, last, rank), len(cells), rank)
    else:
        found = items.select(F.lit(0).alias("grp"), "id", "features").filter(F.lit(False))
    blocks = part(
        placed.join(F.broadcast(by_cell), "cell"), USER, at("ubs"), every("ibs"), F.col("other"), F.col("floor")
    ).unionByName(
        part(found.join(F.broadcast(by_group), "grp"), ITEM, every("ubs"), at("ibs"), F.lit(0), F.lit(None).cast("double"))
    )
    best = (
        blocks.repartition(tasks, "grp", "ub", "ib")
        .groupBy("grp", "ub", "ib")
        .applyInPandas(_block_kernel(n), "user int, item int, score float")
    )
    fresh = best.join(rated.select(F.col("id").alias("user"), F.col("other").alias("item")), ["user", "item"], "left_anti")
    merged = top_k(fresh, n, "user", [F.desc("score"), F.col("item")])
    return merged.select(
        F.col("user").alias(user), F.col("item").alias(item), "rank", F.col("score").alias("prediction")
    )


def recommend_one(
    model: ALSModel, seen: DataFrame, user_value: int, n: int = 10,
    user: str = "user_id", item: str = "product_id",
) -> DataFrame:
    """The ``n`` best items for one user among all that the user has not rated."""
    taste = model.userFactors.filter(F.col("id") == user_value).select("features").scalar()
    own = seen.filter(F.col(user) == user_value).select(F.col(item).cast("int").alias("id")).distinct()
    scored = (
        model.itemFactors.join(own, "id", "left_anti")
        .withColumn("_taste", taste)
        .select(
            F.lit(user_value).cast("int").alias(user),
            F.col("id").alias(item),
            dot("features", "_taste").cast("float").alias("prediction"),
        )
        .filter(F.col("prediction").isNotNull())
    )
    return top_n(scored, [F.desc("prediction"), F.col(item)], n)


def flatten_recommendations(
    recs: DataFrame,
    user: str = "user_idx",
    item: str = "item_idx",
    indexes: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """One row per recommended item instead of an array per user.

    ``indexes`` maps code columns to tables that give back the original ids; the rows are
    written down before that, so the lists are worked out only once.
    """
    flat = recs.select(user, F.posexplode("recommendations").alias("_at", "_rec")).select(
        user,
        F.col(f"_rec.{item}").alias(item),
        (F.col("_at") + 1).cast("int").alias("rank"),
        F.col("_rec.rating").alias("score"),
    )
    return with_ids(settle(flat), indexes) if indexes else flat


def popular_products(df: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` products with the highest popularity score."""
    scores = popularity_score(df).select("product_id", F.round("score", 9).alias("score"))
    return top_n(scores, [F.desc("score"), F.col("product_id")], n)


def recommend_popular(df: DataFrame, users: DataFrame, n: int = 10) -> DataFrame:
    """The same ``n`` popular products, ranked, for every user."""
    best = popular_products(df, n)
    ranked = with_each(users.select("user_id"), best, [F.desc("score"), F.col("product_id")])
    return ranked.select("user_id", "product_id", "rank")
