"""What crosses the network or the disk stays in proportion, with the same results."""

from pyspark.sql import functions as F

from tidemart.operators import cooccurrence
from tidemart.operators.relational import with_firsts
from tidemart.plans import collaborative, content


def _repeated_products(build):
    goods = [(1, "a", 5, 50, 1, 100, 10, 5, 5), (2, "b", 5, 50, 1, 100, 10, 5, 5),
             (3, "b", 5, 50, 1, None, 10, 5, 5)]
    return build.star(
        items=[(o, f"o{o}", o % 3, 1, p, 10 + o, 1) for o in range(1, 9) for p in (1, 2, 3)],
        orders=[build.order(o) for o in range(1, 9)],
        customers=[(0, "u0", "x", "s", True), (1, "u0", "y", "s", True), (2, "u2", "x", "s", True)],
        products=[goods[0], goods[0], goods[0], goods[1], goods[2]],
        reviews=[(f"r{o}", o, o % 3, 1 + o % 5, 1, 20000120, 20000121) for o in range(1, 5)],
    )


def test_ratings_carry_only_what_they_need(build, monkeypatch):
    star = _repeated_products(build)
    whole = collaborative.cf_cleaned(collaborative.cf_interaction_table(star, ordered=False))
    want = whole.select("customer_unique_id", "product_key", "avg_review_score_by_user")
    kept = []
    keep = collaborative.written
    monkeypatch.setattr(
        collaborative, "written", lambda df, label: kept.append(df.columns) or keep(df, label))
    got = collaborative.cf_ratings(star)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert "total_spent_on_product" not in kept[0] and "user_total_monetary" not in kept[0]
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()


def test_medians_count_every_copy(build):
    star = _repeated_products(build)
    for scores in ([1, 1, 5, None], [5, 5, 2, None]):
        rows = [("u", p, "x", "s", "c", 1, 1, 1, 1, float(v) if v else None)
                for p, v in enumerate(scores) for _ in range(3 if v == 5 else 1)]
        schema = ", ".join(f"{c} {'long' if c == 'product_key' else 'int' if c in collaborative.SIZE_COLUMNS else 'string'}"
                           for c in collaborative.IDENTITY) + ", avg_review_score_by_user double"
        table = star.spark.createDataFrame(rows, schema)
        want = collaborative.cf_cleaned(table).collect()
        got = collaborative.cf_cleaned(table, collaborative.IDENTITY).select(*table.columns).collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def _ratings(spark, users=14, items=12):
    rows = [(f"u{u}", i, float(1 + (u * 7 + i * 3) % 5)) for u in range(users) for i in range(items)
            if (u * i + u + 2 * i) % 3 or u == 0]
    return rows, spark.createDataFrame(
        [*rows, (None, 1, 2.0), ("u1", None, 3.0)], "user string, item long, r double")


def _cells(frame, *cols):
    return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r)
                  for r in frame.select(*cols).collect())


def test_pairs_unfold_where_they_are_summed(spark):
    _, df = _ratings(spark)
    for frame in (cooccurrence.nearest_items(df, 4), cooccurrence.pair_sums(df)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and "REPARTITION_BY_NUM" in plan


def test_very_popular_items_give_the_same_cells(spark, monkeypatch):
    _, df = _ratings(spark)
    asked = df.select("user", ((F.col("item") * 5) % 13).alias("item"))
    found = []
    for hot in (20_000_000, 60, 0):
        monkeypatch.setattr(cooccurrence, "HOT_ITEM", hot)
        found.append((
            _cells(cooccurrence.nearest_items(df, 4), "i", "j", "sim"),
            _cells(cooccurrence.pair_sums(df), "i", "j", "n", "diff", "gap"),
            sorted(map(str, cooccurrence.slope_one_sums(df, asked).collect())),
        ))
    assert found[0] == found[1] == found[2]


def test_neighbour_sums_match_brute_force_for_all_users(spark):
    rows, df = _ratings(spark)
    near = cooccurrence.nearest_items(df, 3)
    sims = {}
    for i, j, s in near.collect():
        sims.setdefault(i, {})[j] = s
    asked = [(f"u{u}", i) for u in range(15) for i in range(13)]
    pairs = spark.createDataFrame(asked, "user string, item long")
    for heavy in (1, 8, 1000):
        for r in cooccurrence.neighbour_sums(df, near, pairs, heavy).collect():
            met = [(sims.get(r["item"], {}).get(j), v) for u, j, v in rows if u == r["user"]]
            met = [(s, v) for s, v in met if s is not None]
            if not met:
                assert r["num"] is None and r["den"] is None
            else:
                assert abs(r["num"] - sum(s * v for s, v in met)) < 1e-9
                assert abs(r["den"] - sum(s for s, _ in met)) < 1e-9


def test_distinct_counts_do_not_copy_rows(build):
    star = _repeated_products(build)
    for frame, counts in (
        (content.product_sales(star), ["num_unique_purchasers", "num_sellers"]),
        (content.customer_transactions(star), ["frequency", "distinct_sellers_count"]),
    ):
        assert "Expand" not in frame._jdf.queryExecution().executedPlan().toString()
        assert {tuple(r) for r in frame.select(*counts).collect()} <= {(2, 1), (5, 1), (3, 1)}


def test_first_rows_count_distinct_values(spark):
    rows = [(1, "a", 1), (1, "a", 2), (1, None, 2), (2, "b", None), (2, "b", None), (None, "c", 1), (None, "d", 1)]
    df = spark.createDataFrame(rows, "k long, x string, y long")
    want = df.groupBy("k").agg(F.countDistinct("x").alias("x"), F.countDistinct("y").alias("y"))
    got = with_firsts(df, "k", "x", "y").groupBy("k").agg(
        F.sum("first_x").alias("x"), F.sum("first_y").alias("y"))
    assert got.schema["x"].dataType == want.schema["x"].dataType
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_lines_meet_placed_orders_once(small):
    """Same rows as items joined with orders and customers, though orders meet customers first."""
    placed = small.orders.select("order_key", "order_purchase_date_key")
    persons = small.customers.select("customer_key", "customer_unique_id")
    cols = ["order_key", "product_key", "seller_key", "order_purchase_date_key", "customer_unique_id"]
    got = small.sold(["product_key", "seller_key"], placed, persons).select(*cols)
    want = small.items.join(placed, "order_key").join(persons, "customer_key").select(*cols)
    assert got.count() == want.count() and not got.exceptAll(want).head(1)
