"""Statistics of items rated by the same users, safe against very active users.

A user with n ratings has n² item pairs. Users up to ``heavy`` ratings give their pairs
directly, which is at most ``heavy`` rows per rating. Users above it never do: where only
sums are needed their part is rearranged into per-user overlaps, and where cells are needed
it is computed in blocks of items that give back the best few per item. Nothing is dropped.

What would be one row per pair travels packed: a user's items and ratings are two arrays, sent once
to each item of the user. The pairs unfold where an item's rows lie, and are summed, ranked and asked
there. Only very popular items go pair by pair, summed before they are sent.

Ratings are frames (user, item, r).
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemart.operators.relational import broadcast_if_small
from tidemart.session import written

HEAVY = 1000
MOST_HEAVY = 10_000
BLOCK = 1024
BLOCK_RATINGS = 2_000_000
USERS_AT_ONCE = 4096
PLACES = 9
CELLS_AT_ONCE = 2_000_000
HOT_ITEM = 20_000_000


class Split(NamedTuple):
    light: DataFrame
    heavy: DataFrame
    any_heavy: bool


def by_activity(ratings: DataFrame, heavy: int = HEAVY) -> Split:
    """Ratings of users with at most ``heavy`` ratings, and of the others.

    Where more than ``MOST_HEAVY`` users lie above the limit, it is raised until about that
    many do, so the busy side has a bounded number of users.
    """
    activity = ratings.groupBy("user").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > heavy)
    above = activity.count()
    if above > MOST_HEAVY:
        heavy = activity.agg(
            F.percentile_approx("n", 1 - MOST_HEAVY / above, F.lit(10_000)).alias("n")
        ).first()["n"]
    if not above:
        return Split(ratings, ratings.limit(0), False)
    busy = broadcast_if_small(written(activity.filter(F.col("n") > heavy).select("user"), "busy"))
    return Split(
        ratings.join(busy, "user", "left_anti"), ratings.join(busy, "user", "left_semi"), True
    )


def _lists(ratings: DataFrame) -> DataFrame:
    """(user, own): the user's ratings in one row, written once; for users up to the limit only."""
    spark = ratings.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    known = ratings.filter("user is not null and item is not null").select("user", "item", "r")
    return written(
        known.repartition(parts, "user").groupBy("user").agg(
            F.collect_list(F.struct("item", "r")).alias("own")),
        "lists",
    )


def _packed(lists: DataFrame) -> DataFrame:
    """(i, ri, js, rs): each rating with all items and ratings of its user."""
    return lists.select(
        F.explode("own").alias("e"), F.col("own.item").alias("js"), F.col("own.r").alias("rs")
    ).select(F.col("e.item").alias("i"), F.col("e.r").alias("ri"), "js", "rs")


def _meeting(packed: DataFrame, apply):
    """``apply`` to unpacked rows (…, j, rj), j ≠ i, that lie together by ``i``.

    ``apply`` groups by ``i`` and more, so it needs no further exchange. Items with very many
    cells go through it on their own, unfolded before Spark combines them.
    """
    size = written(packed.groupBy("i").agg(F.sum(F.size("js")).alias("n")), "cells")
    total = size.agg(F.sum("n")).first()[0] or 0
    hot = size.filter(F.col("n") > HOT_ITEM).select("i")
    parts = max(packed.sparkSession.sparkContext.defaultParallelism, -(-total // CELLS_AT_ONCE))

    def unpacked(rows: DataFrame) -> DataFrame:
        rest = [c for c in rows.columns if c not in ("js", "rs")]
        cell = F.explode(F.arrays_zip("js", "rs")).alias("c")
        return rows.select(*rest, cell).select(
            *rest, F.col("c.js").alias("j"), F.col("c.rs").alias("rj")).filter("i <> j")

    if hot.isEmpty():
        return apply(unpacked(packed.repartition(parts, "i")))
    hot = broadcast_if_small(hot)
    cold = packed.join(hot, "i", "left_anti").repartition(parts, "i")
    return apply(unpacked(cold)).unionByName(apply(unpacked(packed.join(hot, "i", "left_semi"))))


def _cell_sums(rows: DataFrame) -> DataFrame:
    gap = F.col("ri") - F.col("rj")
    return rows.groupBy("i", "j").agg(
        F.count(F.lit(1)).alias("n"), F.sum(gap).alias("diff"), F.sum(gap * gap).alias("gap")
    )


def _two(ratings: DataFrame, item: str, value: str) -> DataFrame:
    return ratings.select("user", F.col("item").alias(item), F.col("r").alias(value))


def pair_sums(light: DataFrame) -> DataFrame:
    """(i, j, n, diff, gap): for i < j the common raters, Σ(r_i − r_j) and Σ(r_i − r_j)²."""
    later = F.filter(F.arrays_zip("js", "rs"), lambda c: c["js"] > F.col("i"))
    half = _packed(_lists(light)).select("i", "ri", later.alias("c")).filter(F.size("c") > 0).select(
        "i", "ri", F.col("c.js").alias("js"), F.col("c.rs").alias("rs")
    )
    return _meeting(half, _cell_sums)


def both_ways(pairs: DataFrame) -> DataFrame:
    back = pairs.select(
        F.col("j").alias("i"), F.col("i").alias("j"), "n", (-F.col("diff")).alias("diff"), "gap"
    )
    return pairs.select("i", "j", "n", "diff", "gap").unionByName(back)


# --- Slope One --------------------------------------------------------------------------


def item_deviations(ratings: DataFrame) -> DataFrame:
    """(item_i, item_j, avg_diff, n) for i < j: the explicit table, as large as its cells."""
    return pair_sums(ratings).select(
        F.col("i").alias("item_i"), F.col("j").alias("item_j"),
        (F.col("diff") / F.col("n")).alias("avg_diff"), "n",
    )


def _raters_and_askers(lists: DataFrame, asked: DataFrame) -> DataFrame:
    """(i, user, ri, js, rs): packed ratings of i, without user, and the askers' own lists."""
    who = asked.schema["user"].dataType
    raters = _packed(lists).withColumn("user", F.lit(None).cast(who))
    askers = asked.join(lists, "user").select(
        F.col("item").alias("i"), F.lit(None).cast(raters.schema["ri"].dataType).alias("ri"),
        F.col("own.item").alias("js"), F.col("own.r").alias("rs"), "user",
    )
    return raters.unionByName(askers)


def _asked_terms(rows: DataFrame) -> DataFrame:
    """Per asking user and item: every cell (i, j) of the raters that the asker has a rating for."""
    rater = F.col("user").isNull()
    cells = rows.groupBy("i", "j", "user").agg(
        F.count(F.when(rater, 1)).alias("n"),
        F.sum(F.when(rater, F.col("ri") - F.col("rj"))).alias("diff"),
        F.count(F.lit(1)).alias("times"), F.sum("rj").alias("rj"),
    )
    cell = Window.partitionBy("i", "j")
    met = cells.withColumns({
        "n": F.sum("n").over(cell), "diff": F.sum("diff").over(cell),
    }).filter(~rater & (F.col("n") > 0))
    return met.groupBy("user", "i").agg(
        F.sum(F.col("diff") * F.col("times") + F.col("n") * F.col("rj")).alias("num"),
        F.sum(F.col("n") * F.col("times")).alias("den"),
    )


def slope_one_sums(ratings: DataFrame, asked: DataFrame, heavy: int = HEAVY) -> DataFrame:
    """(user, item, num, den) of the weighted Slope One estimate for the asked pairs.

    num = Σ_j Σ_v (r_vi − r_vj + r_uj) and den = Σ_j Σ_v 1 over the items j ≠ i the user
    rated and the users v who rated both i and j.
    """
    light, busy, any_busy = by_activity(ratings, heavy)
    asked = asked.select("user", "item").distinct()
    term = F.col("diff") + F.col("n") * F.col("rj")
    from_few = _meeting(_raters_and_askers(_lists(light), asked), _asked_terms)
    if not any_busy:
        return asked.join(from_few.withColumnRenamed("i", "item"), ["user", "item"], "left")
    pairs = both_ways(pair_sums(light))

    # Asking user with many: meet the pair table on j and sum before anything is asked.
    from_busy = (
        pairs.join(_two(busy, "j", "rj"), "j")
        .groupBy("user", "i").agg(F.sum(term).alias("num"), F.sum("n").alias("den"))
    )
    # Raters v with many ratings: Σ_j over the items that u and v share, from overlaps.
    shared = (
        _two(ratings, "j", "ru")
        .join(_two(busy, "j", "rv").withColumnRenamed("user", "v"), "j")
        .groupBy("user", "v")
        .agg(
            F.count(F.lit(1)).alias("n"), F.sum("rv").alias("sv"), F.sum("ru").alias("su")
        )
    )
    self_rating = ratings.select("user", "item", F.col("r").alias("rui"))
    one = F.col("rui").isNotNull().cast("int")
    n = F.col("n") - one
    from_raters = (
        asked.join(busy.select(F.col("user").alias("v"), "item", F.col("r").alias("rvi")), "item")
        .join(shared, ["user", "v"])
        .join(self_rating, ["user", "item"], "left")
        .select(
            "user", F.col("item").alias("i"),
            (
                F.col("rvi") * n - (F.col("sv") - F.col("rvi") * one)
                + F.col("su") - F.coalesce("rui", F.lit(0.0))
            ).alias("num"),
            n.alias("den"),
        )
        .groupBy("user", "i").agg(F.sum("num").alias("num"), F.sum("den").alias("den"))
    )
    sums = (
        from_few.unionByName(from_busy).unionByName(from_raters)
        .groupBy("user", "i").agg(F.sum("num").alias("num"), F.sum("den").alias("den"))
        .withColumnRenamed("i", "item")
    )
    return asked.join(sums, ["user", "item"], "left")


# --- neighbours -------------------------------------------------------------------------


def _similarity(n, gap):
    return F.round(1.0 / (gap / n + 1.0), PLACES)


def _best(cells: DataFrame, k: int) -> DataFrame:
    place = Window.partitionBy("i").orderBy(F.desc("sim"), "j")
    return cells.withColumn("place", F.row_number().over(place)).filter(
        F.col("place") <= k
    ).drop("place")


def nearest_items(ratings: DataFrame, k: int = 40, min_common: int = 1, heavy: int = HEAVY,
                  block: int = BLOCK) -> DataFrame:
    """(i, j, sim): the ``k`` most similar items of each item.

    Similarity is 1 / (1 + mean squared rating difference) over the common raters.
    """
    light, busy, any_busy = by_activity(ratings, heavy)
    if not any_busy:
        def ranked(rows: DataFrame) -> DataFrame:
            cells = _cell_sums(rows).filter(F.col("n") >= min_common)
            return _best(cells.select("i", "j", _similarity(F.col("n"), F.col("gap")).alias("sim")), k)

        return _meeting(_packed(_lists(light)), ranked)
    pairs = pair_sums(light)
    busy_items = busy.select(F.col("item")).distinct()
    size = busy.agg(
        F.countDistinct("item").alias("items"), F.count(F.lit(1)).alias("ratings")
    ).first()
    # Cells with an end that no busy user rated are complete as they are.
    known = busy_items.withColumn("known", F.lit(True))
    marked = pairs.join(
        known.withColumnsRenamed({"item": "i", "known": "ki"}), "i", "left"
    ).join(known.withColumnsRenamed({"item": "j", "known": "kj"}), "j", "left")
    inside = F.coalesce("ki", F.lit(False)) & F.coalesce("kj", F.lit(False))
    outside = both_ways(marked.filter(~inside)).filter(F.col("n") >= min_common).select(
        "i", "j", _similarity(F.col("n"), F.col("gap")).alias("sim")
    )
    blocks = max(-(-size["items"] // block), -(-size["ratings"] // BLOCK_RATINGS))
    near = _block_cells(busy, marked.filter(inside), blocks, k, min_common)
    return _best(outside.unionByName(near), k)


def _block_cells(busy: DataFrame, pairs: DataFrame, blocks: int, k: int, min_common: int
                 ) -> DataFrame:
    """Best cells per item among the items of busy users, block pair by block pair.

    Each rating goes to the block pairs its block takes part in. A task holds two blocks of
    items and the light sums between them and returns at most ``k`` cells per item.
    """
    def block_of(col):
        return F.pmod(F.xxhash64(col), F.lit(blocks)).cast("int")

    all_blocks = F.sequence(F.lit(0), F.lit(blocks - 1))
    spread = busy.withColumn("own", block_of("item")).withColumn("other", F.explode(all_blocks))
    ratings = spread.select(
        F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"),
        "own", "user", "item", "r",
    )
    low, high = block_of("i"), block_of("j")
    sums = pairs.select(
        F.least(low, high).alias("a"), F.greatest(low, high).alias("b"), "i", "j", "n", "gap"
    )

    def combine(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"i": [], "j": [], "sim": []})
        if left.empty:
            return empty
        a, b = int(left["a"].iloc[0]), int(left["b"].iloc[0])
        left = left.drop_duplicates(["user", "item"])
        one = np.sort(left.loc[left["own"] == a, "item"].unique())
        two = np.sort(left.loc[left["own"] == b, "item"].unique())
        if not len(one) or not len(two):
            return empty
        n, gap = np.zeros((len(one), len(two))), np.zeros((len(one), len(two)))
        users = np.sort(left["user"].unique())
        for start in range(0, len(users), USERS_AT_ONCE):
            some = users[start:start + USERS_AT_ONCE]
            rows = left[(left["user"] >= some[0]) & (left["user"] <= some[-1])]

            def dense(block, items, rows=rows, some=some):
                own = rows[rows["own"] == block]
                seen, value = np.zeros((len(items), len(some))), np.zeros((len(items), len(some)))
                x, y = np.searchsorted(items, own["item"]), np.searchsorted(some, own["user"])
                seen[x, y], value[x, y] = 1.0, own["r"]
                return seen, value

            (s1, v1), (s2, v2) = dense(a, one), dense(b, two)
            n += s1 @ s2.T
            gap += (v1 * v1) @ s2.T + s1 @ (v2 * v2).T - 2.0 * (v1 @ v2.T)
        for p, q in (("i", "j"), ("j", "i")):
            held = right[right[p].isin(one) & right[q].isin(two)]
            x, y = np.searchsorted(one, held[p]), np.searchsorted(two, held[q])
            n[x, y] += held["n"].to_numpy()
            gap[x, y] += held["gap"].to_numpy()
        ids1, ids2 = one, two
        sim = np.round(1.0 / (np.maximum(gap, 0.0) / np.maximum(n, 1.0) + 1.0), PLACES)
        sim[(n < max(min_common, 1)) | (ids1[:, None] == ids2[None, :])] = -1.0
        found = _top(sim, ids1, ids2, k)
        if a != b:
            found += _top(sim.T, ids2, ids1, k)
        return pd.DataFrame(found, columns=["i", "j", "sim"]) if found else empty

    item = busy.schema["item"].dataType.simpleString()
    return ratings.groupBy("a", "b").cogroup(sums.groupBy("a", "b")).applyInPandas(
        combine, f"i {item}, j {item}, sim double"
    )


def _top(sim: np.ndarray, rows: np.ndarray, cols: np.ndarray, k: int) -> list[tuple]:
    found = []
    for x, line in enumerate(sim):
        for y in np.lexsort((cols, -line))[:k]:
            if line[y] < 0:
                break
            found.append((rows[x], cols[y], float(line[y])))
    return found


def neighbour_sums(ratings: DataFrame, near: DataFrame, asked: DataFrame, heavy: int = HEAVY
                   ) -> DataFrame:
    """(user, item, num, den): similarity-weighted ratings the user gave to near items.

    A user with up to ``heavy`` ratings brings them along in one row and meets an item's whole
    list of neighbours; a busier one meets them one by one.
    """
    asked = asked.select("user", "item").distinct()
    light, busy, any_busy = by_activity(ratings, heavy)
    lists = near.groupBy("i").agg(F.collect_list(F.struct("j", "sim")).alias("near")).select(
        F.col("i").alias("item"), F.col("near.j").alias("nj"), F.col("near.sim").alias("ns")
    )
    met = asked.join(_lists(light), "user").join(lists, "item").withColumn("own", F.filter(
        F.transform("own", lambda e: F.struct(
            e["r"].alias("r"), F.get("ns", F.array_position("nj", e["item"]) - 1).alias("sim"))),
        lambda e: e["sim"].isNotNull(),
    ))

    def total(value):
        return F.aggregate(F.transform("own", value), F.lit(0.0), lambda a, b: a + F.coalesce(b, F.lit(0.0)))

    sums = met.filter(F.size("own") > 0).select(
        "user", "item", total(lambda e: e["sim"] * e["r"]).alias("num"),
        total(lambda e: e["sim"]).alias("den"),
    )
    if any_busy:
        sums = sums.unionByName(
            asked.join(near.withColumnsRenamed({"i": "item", "j": "other"}), "item")
            .join(busy.select("user", F.col("item").alias("other"), "r"), ["user", "other"])
            .groupBy("user", "item")
            .agg(F.sum(F.col("sim") * F.col("r")).alias("num"), F.sum("sim").alias("den"))
        )
    return asked.join(sums, ["user", "item"], "left")
