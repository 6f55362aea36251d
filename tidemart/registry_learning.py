"""Queries for preparation, models, search, recommenders, scoring and text."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.functions.scalars import sixth
from tidemart.learn import (
    balance, content_model, evaluate, factor_sgd, models, prep, recommend, search, towers,
)
from tidemart.operators import cooccurrence
from tidemart.operators.neighbours import nearest
from tidemart.operators.relational import broadcast_if_small
from tidemart.oracle import features as sql_features
from tidemart.oracle import marts as sql_marts
from tidemart.oracle.star import star_sql
from tidemart.plans import churn, collaborative, content, scoring, text
from tidemart.registry import over_star, rounded
from tidemart.registry_basics import unit_sql
from tidemart.session import shared_dir, written
from tidemart.sources.star import Star

def kept(t: Star, name: str, build):
    """A stage of one query, made once; every query has a star of its own and starts anew."""
    stages = t.__dict__.setdefault("_stages", {})
    if name not in stages:
        made = build()
        stages[name] = written(made, name) if isinstance(made, DataFrame) else made
    return stages[name]


def churn_table(t: Star) -> DataFrame:
    return kept(t, "churn", lambda: search.row_identity(churn.churn_features(t)))


def _churn(body: str, **more: str) -> str:
    return star_sql(body, **sql_marts.churn_ctes(), **more)


# --- preparation ------------------------------------------------------------------------

def impute_zero(t: Star) -> DataFrame:
    df = churn_table(t)
    return prep.filled(df, prep.fill_values(df, prep.ZERO_FILLED, [])).select(
        "customer_id", *prep.ZERO_FILLED
    )


over_star("impute_constant", impute_zero, _churn(
    "select customer_id, " + ", ".join(
        f"coalesce({c}, 0)::double as {c}" for c in prep.ZERO_FILLED
    ) + " from churn"
))


def impute_median(t: Star) -> DataFrame:
    df = churn_table(t)
    return rounded(prep.filled(df, prep.fill_values(df, [], prep.MEDIAN_FILLED)).select(
        "customer_id", *prep.MEDIAN_FILLED
    ))


over_star("impute_median", impute_median, _churn(
    "select customer_id, " + ", ".join(
        f"round(coalesce({c}, (select median({c}) from churn))::double, 6) as {c}"
        for c in prep.MEDIAN_FILLED
    ) + " from churn"
))


def standard_scaler(t: Star) -> DataFrame:
    df = churn_table(t)
    return rounded(prep.scaled(df, prep.scale_values(df, prep.PLAIN)).select(
        "customer_id", *prep.PLAIN
    ))


over_star("standard_scaler", standard_scaler, _churn(
    "select customer_id, " + ", ".join(
        f"round(({c} - (select avg({c}::double) from churn)) / "
        f"(select stddev_pop({c}::double) from churn), 6) as {c}" for c in prep.PLAIN
    ) + " from churn"
))


def one_hot(t: Star) -> DataFrame:
    df = churn_table(t)
    flags = prep.one_hot(prep.ONE_HOT, prep.categories(df, prep.ONE_HOT))
    return df.select(
        "customer_id", *[c.alias("is_" + n.split("=")[1]) for n, c in flags.items()]
    )


over_star("one_hot", one_hot, _churn(
    "select customer_id, " + ", ".join(
        f"case when coalesce({prep.ONE_HOT}, 'unknown') = '{v}' then 1.0 else 0.0 end::double "
        f"as is_{v}" for v in ("boleto", "credit_card", "debit_card", "not_defined", "voucher")
    ) + " from churn"
))


def frequency_encoder(t: Star) -> DataFrame:
    """Frequencies learned on the training part, applied to the other part."""
    train, test = prep.split(churn_table(t), 0.9, 42, "customer_id")
    return rounded(prep.FrequencyEncoder(prep.FREQUENCY).fit(train).transform(test).select(
        "customer_id", prep.FREQUENCY
    ))


_TRAIN = f"{unit_sql('split', 42, 'customer_id')} < 0.9"
over_star("frequency_encoder", frequency_encoder, _churn(
    "select customer_id, round(coalesce(f, 0), 6)::double as most_purchased_product from churn "
    "left join freq using (most_purchased_product) where not " + _TRAIN,
    freq="select most_purchased_product, count(*)::double / sum(count(*)) over () as f "
    f"from churn where most_purchased_product is not null and {_TRAIN} "
    "group by most_purchased_product",
))


def assembled(t: Star) -> DataFrame:
    """Width and sum of every prepared feature vector."""
    df = churn_table(t)
    ready = prep.ChurnPrep().fit(df).transform(df, "customer_id")
    values = vector_to_array("features")
    return ready.select(
        "customer_id", F.size(values).alias("width"),
        sixth(F.aggregate(values, F.lit(0.0), lambda s, x: s + x)).alias("total"),
    )


def _z(col: str) -> str:
    return f"({col} - avg({col}) over ()) / coalesce(nullif(stddev_pop({col}) over (), 0), 1)"


_SCALED = [*prep.ZERO_FILLED, *prep.MEDIAN_FILLED, *prep.PLAIN]
over_star("column_transformer", assembled, _churn(
    f"select customer_id, {len(_SCALED) + 1} + (select count(distinct "
    f"coalesce({prep.ONE_HOT}, 'unknown')) from churn) as width, "
    f"round({' + '.join(_z(c) for c in [*_SCALED, 'f'])} + 1, 6) as total from ready",
    shares="select most_purchased_product as product, count(*)::double / sum(count(*)) over () "
    "as share from churn where most_purchased_product is not null group by all",
    ready="select customer_id, " + ", ".join(
        [f"coalesce({c}, 0)::double as {c}" for c in prep.ZERO_FILLED]
        + [f"coalesce({c}, (select median({c}) from churn))::double as {c}"
           for c in prep.MEDIAN_FILLED]
        + [f"{c}::double as {c}" for c in prep.PLAIN]
    ) + ", coalesce(share, 0) as f from churn left join shares "
    "on product = most_purchased_product",
))


def _kinds(t: Star, df: DataFrame, skip: list[str]) -> DataFrame:
    kinds = prep.auto_feature_types(df, skip)
    return t.spark.createDataFrame(list(kinds.items()), "feature string, kind string")


def auto_types(t: Star) -> DataFrame:
    return _kinds(t, kept(t, "products", lambda: content.product_content_features(t)), ["product_key"])


_PRODUCT_KINDS = {
    "product_category_name": "s", "product_name_lenght": "i", "product_description_lenght": "i",
    "product_photos_qty": "i", "product_weight_g": "i", "product_length_cm": "i",
    "product_height_cm": "i", "product_width_cm": "i", "product_volume_cm3": "i",
    "total_sales_count": "i", "num_unique_purchasers": "i", "repurchase_ratio": "d",
    "avg_price": "d", "stddev_price": "d", "avg_freight_value": "d",
    "freight_to_price_ratio": "d", "total_reviews_count": "i", "avg_review_score": "d",
    "stddev_review_score": "d", "positive_review_ratio": "d", "negative_review_ratio": "d",
    "num_sellers": "i", "avg_payment_installments": "d", "first_sale_date_key": "i",
    "last_sale_date_key": "i",
}
_KIND_SQL = {
    "s": "'cat'", "d": "'num'",
    "i": "case when (select count(distinct {c}) from product_features) < 30 "
    "then 'cat' else 'num' end",
}
over_star("auto_feature_types", auto_types, star_sql(
    " union all ".join(
        f"select '{c}' as feature, {_KIND_SQL[k].format(c=c)} as kind"
        for c, k in _PRODUCT_KINDS.items()
    ),
    **sql_features.PRODUCT_PARTS,
))


def fill_by_type(t: Star) -> DataFrame:
    df = t.products.select("product_key", "product_category_name", "product_weight_g")
    return prep.fill_by_type(df, {"product_category_name": "cat", "product_weight_g": "num"})


over_star("fill_by_type", fill_by_type, star_sql(
    "select product_key, coalesce(product_category_name, '<MISSING>') as product_category_name, "
    "coalesce(product_weight_g, (select median(product_weight_g) from s_products))::double "
    "as product_weight_g from s_products"
))


def label_encode(t: Star) -> DataFrame:
    """Cities of customers and sellers coded by one vocabulary."""
    people = t.customers.select("customer_key", F.col("customer_city").alias("city"))
    shops = t.sellers.select("seller_key", F.col("seller_city").alias("city"))
    codes = content_model.vocabulary([people, shops], "city")
    return content_model.label_encoded(people, "city", codes)


over_star("label_encoding", label_encode, star_sql(
    "select customer_key, code as city from s_customers join (select city, "
    "cast(row_number() over (order by city) - 1 as int) as code from (select customer_city "
    "as city from s_customers union select seller_city from s_sellers)) on city = customer_city"
))


def entity_scalers(t: Star) -> DataFrame:
    df = t.products.select("product_key", "product_description_lenght", "product_photos_qty")
    return rounded(prep.scaled(df, prep.scale_values(df, df.columns[1:])))


over_star("entity_scalers", entity_scalers, star_sql(
    "select product_key, " + ", ".join(
        f"round(({c} - (select avg({c}) from s_products)) / "
        f"(select stddev_pop({c}) from s_products), 6) as {c}"
        for c in ("product_description_lenght", "product_photos_qty")
    ) + " from s_products"
))


def _history(t: Star) -> DataFrame:
    return kept(
        t, "preferences", lambda: content.customer_preferences(t)
    ).select("customer_unique_id", "purchase_category_history")


def sequence_tokens(t: Star) -> DataFrame:
    """Category histories as vocabulary codes; codes come from the categorised products."""
    goods = t.products.filter("product_category_name is not null")
    codes = content_model.vocabulary([goods], "product_category_name")
    tokens = content_model.sequence_codes(_history(t), codes)
    return tokens.select(
        "customer_unique_id",
        F.array_join(F.transform("tokens", lambda x: x.cast("string")), " ").alias("tokens"),
    )


_CODED = {
    "codes": "select product_category_name, cast(row_number() over (order by "
    "product_category_name) as int) as code from (select distinct product_category_name "
    "from s_products where product_category_name is not null)",
    "coded": "select customer_unique_id, order_purchase_date_key, product_category_name, code "
    "from s_items join s_orders using (order_key) join s_customers using (customer_key) "
    "join s_products using (product_key) join codes using (product_category_name)",
}
over_star("sequence_tokens", sequence_tokens, star_sql(
    "select customer_unique_id, string_agg(code::varchar, ' ' order by order_purchase_date_key, "
    "product_category_name) as tokens from coded group by all", **_CODED
))


def masked_history(t: Star) -> DataFrame:
    """Padding each code list needs, and the mean code of its real tokens.

    The widest list sets the width, but no list is filled up to it, and the vocabulary is joined
    to the counts of tokens, not carried on every row.
    """
    goods = t.products.filter("product_category_name is not null")
    codes = content_model.vocabulary([goods], "product_category_name")
    tokens = kept(t, "tokens", lambda: content_model.sequence_codes(_history(t), codes))
    lists = tokens.select("customer_unique_id", F.size("tokens").alias("n"))
    weights = codes.select((F.col("code") + 1).alias("token"), (F.col("code") + 1).alias("weight"))
    counts = tokens.select("customer_unique_id", F.explode("tokens").alias("token")).filter(
        "token <> 0").groupBy("customer_unique_id", "token").count()
    means = counts.join(broadcast_if_small(weights), "token").groupBy("customer_unique_id").agg(
        (F.sum(F.col("count") * F.col("weight")) / F.sum("count")).alias("mean"))
    width = lists.agg(F.max("n")).scalar()
    return lists.join(means, "customer_unique_id", "left").select(
        "customer_unique_id", width.alias("width"), (width - F.col("n")).alias("n_padding"),
        sixth(F.col("mean")).alias("mean_code"),
    )


over_star("masked_sequence_mean", masked_history, star_sql(
    "select customer_unique_id, (select max(n) from lens)::bigint as width, "
    "(select max(n) from lens) - n as n_padding, mean_code from lens",
    **_CODED,
    lens="select customer_unique_id, count(*) as n, round(avg(code), 6) as mean_code "
    "from coded group by all",
))


def train_test_split(t: Star) -> DataFrame:
    train, test = prep.split(churn_table(t), 0.9, 42, "customer_id")
    parts = train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test"))
    )
    return parts.groupBy("part", "churn_label").agg(F.count(F.lit(1)).alias("n_rows"))


over_star("train_test_split", train_test_split, _churn(
    f"select case when {_TRAIN} then 'train' else 'test' end as part, churn_label, "
    "count(*) as n_rows from churn group by all"
))


def stratified(t: Star) -> DataFrame:
    main, held = prep.stratified_split(churn_table(t), 0.1, 42, "churn_label", "customer_id")
    return held.groupBy("churn_label").agg(F.count(F.lit(1)).alias("n_held")).join(
        main.groupBy("churn_label").agg(F.count(F.lit(1)).alias("n_main")), "churn_label"
    )


over_star("stratified_validation", stratified, _churn(
    "select churn_label, count(*) filter (place <= floor(size * 0.1 + 0.5)) as n_held, "
    "count(*) filter (place > floor(size * 0.1 + 0.5)) as n_main from ranked group by all",
    ranked="select churn_label, row_number() over (partition by churn_label) as place, "
    "count(*) over (partition by churn_label) as size from churn",
))


def stratified_folds(t: Star) -> DataFrame:
    """Every customer's fold; each class is spread evenly over five."""
    return prep.with_stratified_fold(churn_table(t), 5, 42, prep.LABEL, "customer_id").select(
        "customer_id", "churn_label", "fold")


over_star("stratified_folds", stratified_folds, _churn(
    "select customer_id, churn_label, ((place - 1 + (select coalesce(sum(n), 0) from sizes "
    "where l < churn_label)) % 5)::int as fold from ranked",
    sizes="select churn_label as l, count(*) as n from churn group by all",
    ranked="select customer_id, churn_label, row_number() over (partition by churn_label order by "
    f"{unit_sql('stratified fold', 42, 'churn_label', 'customer_id')}, customer_id) as place from churn",
))


def cf_pairs(t: Star) -> DataFrame:
    """Cleaned ratings, one row per (user, item)."""
    return kept(t, "ratings", lambda: recommend.as_ratings(collaborative.cf_ratings(t)))


_PAIRS = {
    **sql_features.CF_PARTS,
    "rated": 'select "userID" as "user", "itemID" as item, max(rating) as r from ratings '
    "group by all",
    "train": f"select * from rated where {unit_sql('split', 42, chr(34) + 'user' + chr(34), 'item')} < 0.8",
    "test": f"select * from rated where {unit_sql('split', 42, chr(34) + 'user' + chr(34), 'item')} >= 0.8",
}


def interaction_split(t: Star) -> DataFrame:
    train, test = recommend.rating_split(cf_pairs(t))
    return train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test"))
    ).groupBy("part").agg(F.count(F.lit(1)).alias("n_pairs"), sixth(F.sum("r")).alias("total"))


over_star("interaction_split", interaction_split, star_sql(
    "select 'train' as part, count(*) as n_pairs, round(sum(r), 6) as total from train "
    "union all select 'test', count(*), round(sum(r), 6) from test", **_PAIRS
))


def folds(t: Star) -> DataFrame:
    return prep.with_fold(churn_table(t), 5, 42, "customer_id").groupBy("fold", "churn_label").agg(
        F.count(F.lit(1)).alias("n_rows")
    )


over_star("cross_folds", folds, _churn(
    f"select cast(floor({unit_sql('fold', 42, 'customer_id')} * 5) as int) as fold, churn_label, "
    "count(*) as n_rows from churn group by all"
))


def _vectors(t: Star) -> DataFrame:
    df = churn_table(t).withColumn("label", F.col(prep.LABEL).cast("int"))
    return kept(
        t, "vectors", lambda: prep.ChurnPrep().fit(df).transform(df, "row_id", "label")
    )


def oversample(t: Star) -> DataFrame:
    rows = balance.random_oversample(_vectors(t), "label", "row_id")
    return rows.groupBy("label").agg(F.count(F.lit(1)).alias("n_rows"))


over_star("random_oversampler", oversample, _churn(
    "select l as label, (select max(n) from sizes) as n_rows from sizes",
    sizes="select churn_label as l, count(*) as n from churn group by all",
))


def smote_rows(t: Star) -> DataFrame:
    rows = balance.smote(_vectors(t), "label", "row_id")
    return rows.groupBy("label", "synthetic").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("row_id").alias("n_ids")
    )


over_star("smote", smote_rows, _churn(
    "select l as label, false as synthetic, n as n_rows, n as n_ids from sizes union all "
    "select l, true, (select max(n) from sizes) - n, (select max(n) from sizes) - n from sizes "
    "where n < (select max(n) from sizes)",
    sizes="select churn_label as l, count(*) as n from churn group by all",
))


def metric_neighbours(t: Star) -> DataFrame:
    """The three parts nearest to every part in size and price, by Manhattan distance."""
    cents = F.round(F.col("p_retailprice") * 100)
    rows = t.raw("part").select(
        F.col("p_partkey").alias("id"), F.array(F.col("p_size").cast("double"), cents).alias("vec"))
    return nearest(rows, rows, 3, "manhattan", others=True).select(
        F.col("id").alias("p_partkey"), F.col("j").alias("near_partkey"), F.col("d").alias("distance"))


over_star("metric_neighbours", metric_neighbours, """
select p_partkey, near_partkey, distance from (
  select a.p_partkey, b.p_partkey as near_partkey,
    abs(a.p_size - b.p_size) + abs(round(a.p_retailprice * 100) - round(b.p_retailprice * 100)) as distance,
    row_number() over (partition by a.p_partkey order by abs(a.p_size - b.p_size)
      + abs(round(a.p_retailprice * 100) - round(b.p_retailprice * 100)), b.p_partkey) as place
  from part a join part b on a.p_partkey <> b.p_partkey) where place <= 3
""")


def temporal(t: Star) -> DataFrame:
    days = t.raw("orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    return prep.temporal_columns(days, "d")


over_star("temporal_features", temporal,
          "select o_orderkey, o_orderdate::date as d, year(o_orderdate) as d_year, "
          "month(o_orderdate) as d_month, day(o_orderdate) as d_day, "
          "isodow(o_orderdate) as d_weekday from orders")


def polynomial(t: Star) -> DataFrame:
    df = churn_table(t).select("customer_id", "frequency_orders", "customer_tenure")
    return prep.interactions(df, ["frequency_orders", "customer_tenure"])


over_star("polynomial_features", polynomial, _churn(
    "select customer_id, frequency_orders, customer_tenure, "
    "(frequency_orders * frequency_orders)::double as frequency_orders_x_frequency_orders, "
    "(frequency_orders * customer_tenure)::double as frequency_orders_x_customer_tenure, "
    "(customer_tenure * customer_tenure)::double as customer_tenure_x_customer_tenure from churn"
))

# --- models -----------------------------------------------------------------------------

def prepared(t: Star) -> search.Prepared:
    return kept(t, "prepared", lambda: search.prepare(
        *prep.split(churn_table(t), 0.9, 42, "customer_id")))


def model_query(name: str, learner) -> None:
    """Test rows with label, prediction and score of one model."""

    def run(t: Star) -> DataFrame:
        p = prepared(t)
        return learner().fit(p.train).transform(p.test).select(
            "row_id", "label", F.col("prediction").cast("int").alias("prediction"), "score"
        )

    over_star(name, run)


def plain_bayes(t: Star) -> DataFrame:
    """Naive Bayes on two raw columns of all rows, small enough to be written in SQL."""
    df = churn_table(t).select(
        "customer_id", F.col(prep.LABEL).cast("int").alias("label"),
        array_to_vector(F.array(
            F.col("customer_tenure").cast("double"), F.col("frequency_orders").cast("double")
        )).alias("features"),
    )
    scored = models.GaussianNaiveBayes(1e-3).fit(df).transform(df)
    return scored.select(
        "customer_id", "label", F.col("prediction").cast("int").alias("prediction"),
        sixth(F.col("score")).alias("score"),
    )


def _log_density(x: str, c: int) -> str:
    return (
        f"(-0.5 * ln(2 * pi() * (v{x}{c} + e)) - 0.5 * power({x} - m{x}{c}, 2) / (v{x}{c} + e))"
    )


over_star("gaussian_nb_plain", plain_bayes, _churn(
    "select customer_id, label, case when p > 0.5 then 1 else 0 end as prediction, "
    "round(p, 6) as score from (select *, 1 / (1 + exp(-(ln(n1 / n0)"
    + "".join(f" + {_log_density(x, 1)} - {_log_density(x, 0)}" for x in ("a", "b"))
    + "))) as p from points, fitted)",
    points="select customer_id, churn_label as label, customer_tenure::double as a, "
    "frequency_orders::double as b from churn",
    fitted="select " + ", ".join(
        f"avg({x}) filter (label = {c}) as m{x}{c}, var_pop({x}) filter (label = {c}) as v{x}{c}"
        for x in ("a", "b") for c in (0, 1)
    ) + ", (count(*) filter (label = 1))::double as n1, "
    "(count(*) filter (label = 0))::double as n0, "
    "0.001 * greatest(var_pop(a), var_pop(b)) as e from points",
))
model_query("churn_gaussian_nb", models.GaussianNaiveBayes)
model_query("churn_pca_nb", lambda: models.Projected(models.GaussianNaiveBayes(), 10))
model_query("churn_boosting", models.gradient_boosting)
model_query("churn_logistic", lambda: models.logistic(c=1.0))
model_query("churn_kernel_svc", lambda: models.KernelSVC(rounds=30))
model_query("churn_decision_tree", models.decision_tree)
model_query("churn_random_trees", models.random_trees)
model_query("churn_bagged_knn", models.BaggedNeighbours)
model_query("churn_stacking", lambda: models.Stacking(
    {
        "boost": models.gradient_boosting(rounds=5, depth=3),
        "trees": models.random_trees(20, 6),
        "pca_nb": models.Projected(models.GaussianNaiveBayes(), 10),
    },
    folds=3,
))


def _search_folds(t: Star) -> list[search.Prepared]:
    return kept(t, "folds", lambda: search.prepare_folds(
        prep.split(churn_table(t), 0.9, 42, "customer_id")[0], 5, 42, "customer_id"))


def halving(t: Star) -> DataFrame:
    """Successive halving over the smoothing grid of naive Bayes."""
    found = search.halving_search(
        "gaussian_nb", models.GaussianNaiveBayes, search.NB_GRID, _search_folds(t)
    )
    return evaluate.run_log(t.spark, found.rows())


def seeded_search(t: Star) -> DataFrame:
    """Random search over the tree space."""
    found = search.random_search(
        "decision_tree", models.decision_tree, search.TREE_SPACE, search.TRIALS["tree"],
        _search_folds(t),
    )
    return evaluate.run_log(t.spark, found.rows())


def surrogate_search(t: Star) -> DataFrame:
    """All trials over the tree space on five folds, each chosen by a Gaussian process."""
    found = search.bayesian_search(
        "decision_tree", models.decision_tree, search.TREE_SPACE, search.TRIALS["tree"],
        _search_folds(t),
    )
    return evaluate.run_log(t.spark, found.rows())


over_star("bayesian_search", surrogate_search)
over_star("halving_search", halving)
over_star("random_search", seeded_search)


def model_scores(t: Star) -> DataFrame:
    """Accuracy and weighted F1 on train and test rows."""
    p = prepared(t)
    rows = []
    for name, learner in {
        "gaussian_nb": models.GaussianNaiveBayes(), "decision_tree": models.decision_tree(),
    }.items():
        fitted = learner.fit(p.train)
        for part, frame in (("train", p.train), ("test", p.test)):
            for metric, value in evaluate.classification_scores(fitted.transform(frame)).items():
                rows.append({
                    "model": name, "trial": 0, "fold": 0, "params": part, "metric": metric,
                    "value": float(value),
                })
    return evaluate.run_log(t.spark, rows)


over_star("model_scores", model_scores)


def rule_scored(df: DataFrame) -> DataFrame:
    """A fixed rule in place of a model, so that the counts can be checked in SQL."""
    return df.select(
        F.col("churn_label").alias("label"),
        F.when(F.col("frequency_orders") <= 2, 1).otherwise(0).alias("prediction"),
    )


over_star("confusion_matrix", lambda t: evaluate.confusion(rule_scored(churn_table(t))), _churn(
    "select churn_label as label, case when frequency_orders <= 2 then 1 else 0 end "
    "as prediction, count(*) as n from churn group by all"
))


def rule_metrics(t: Star) -> DataFrame:
    scores = evaluate.classification_scores(rule_scored(churn_table(t)))
    return t.spark.createDataFrame(
        [(k, round(v, 6)) for k, v in scores.items()], "metric string, value double"
    )


over_star("weighted_f1", rule_metrics, _churn(
    "select 'accuracy' as metric, round(sum(n) filter (a = p) / sum(n), 6) as value from m "
    "union all select 'f1_weighted', round(sum(support / total * 2 * hit / (support + guessed)), "
    "6) from (select c, (select coalesce(sum(n), 0) from m where a = c)::double as support, "
    "(select coalesce(sum(n), 0) from m where p = c) as guessed, "
    "(select coalesce(sum(n), 0) from m where a = c and p = c) as hit, "
    "(select sum(n) from m) as total from (values (0), (1)) v(c))",
    m="select churn_label as a, case when frequency_orders <= 2 then 1 else 0 end as p, "
    "count(*) as n from churn group by all",
))


def feature_importance(t: Star) -> DataFrame:
    p = prepared(t)
    stage = models.random_trees(30, 6).fit(p.train).stage
    return evaluate.importance(t.spark, p.prep.names, stage.featureImportances.toArray())


over_star("feature_importance", feature_importance)


def saved_model(t: Star) -> DataFrame:
    """Preparation saved, loaded and applied: both give the same vectors."""
    df = churn_table(t)
    path = shared_dir(t.spark, "model")
    fitted = prep.ChurnPrep().fit(df)
    fitted.save(t.spark, path)
    again = prep.ChurnPrep.load(t.spark, path)
    a = fitted.transform(df, "row_id").select("row_id", vector_to_array("features").alias("a"))
    b = again.transform(df, "row_id").select("row_id", vector_to_array("features").alias("b"))
    return a.join(b, "row_id").groupBy((F.col("a") == F.col("b")).alias("same")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


over_star("save_load_model", saved_model, _churn("select true as same, count(*) as n_rows from churn"))

# --- recommenders -----------------------------------------------------------------------

_R2 = {
    "mu": "select avg(r) as m from train",
    "umeans": 'select "user", avg(r) as um from train group by all',
    "duo": 'select a.item as i, b.item as j, count(*) as n, sum(a.r - b.r) as diff, '
    'sum((a.r - b.r) * (a.r - b.r)) as gap from train a join train b on a."user" = b."user" '
    "and a.item <> b.item group by all",
}


def slope_one_predictions(t: Star) -> DataFrame:
    train, test = recommend.rating_split(cf_pairs(t))
    return rounded(recommend.slope_one(train, test))


over_star("slope_one", slope_one_predictions, star_sql(
    'select t."user", t.item, round(greatest(1, least(5, coalesce(num / den, um, '
    '(select m from mu)))), 6) as prediction from test t left join (select q."user", q.item, '
    'sum(d.diff + d.n * o.r) as num, sum(d.n) as den from test q join train o '
    'on o."user" = q."user" join duo d on d.i = q.item and d.j = o.item group by all) s '
    'on s."user" = t."user" and s.item = t.item left join umeans u on u."user" = t."user"',
    **_PAIRS, **_R2,
))


def knn_predictions(t: Star) -> DataFrame:
    train, test = recommend.rating_split(cf_pairs(t))
    return rounded(recommend.knn_items(train, test))


_NEAR = {
    "near": "select i, j, round(1.0 / (gap / n + 1.0), 9) as sim from duo "
    "qualify row_number() over (partition by i order by sim desc, j) <= 40"
}
over_star("knn_items", knn_predictions, star_sql(
    'select t."user", t.item, round(greatest(1, least(5, coalesce(num / den, um, '
    '(select m from mu)))), 6) as prediction from test t left join (select q."user", q.item, '
    'sum(sim * o.r) as num, sum(sim) as den from test q join near d on d.i = q.item '
    'join train o on o."user" = q."user" and o.item = d.j group by all) s '
    'on s."user" = t."user" and s.item = t.item left join umeans u on u."user" = t."user"',
    **_PAIRS, **_R2, **_NEAR,
))


def knn_neighbours(t: Star) -> DataFrame:
    train, _ = recommend.rating_split(cf_pairs(t))
    return cooccurrence.nearest_items(train, 5, 2).toDF("item_i", "item_j", "sim")


over_star("knn_neighbours", knn_neighbours, star_sql(
    "select i as item_i, j as item_j, round(1.0 / (gap / n + 1.0), 9) as sim from duo "
    "where n >= 2 qualify row_number() over (partition by i order by sim desc, j) <= 5",
    **_PAIRS, **_R2,
))


def baseline_errors(t: Star) -> DataFrame:
    """RMSE and MAE of user means on the held-out ratings."""
    train, test = recommend.rating_split(cf_pairs(t))
    means = train.groupBy("user").agg(F.avg("r").alias("prediction"))
    return rounded(evaluate.regression_errors(test.join(means, "user"), "r"))


over_star("rating_errors", baseline_errors, star_sql(
    "select count(*) as n, round(sqrt(avg((um - r) * (um - r))), 6) as rmse, "
    'round(avg(abs(um - r)), 6) as mae from test join umeans using ("user")', **_PAIRS, **_R2,
))


def factor_query(name: str, fit) -> None:
    """Held-out ratings with the prediction of one factor model."""

    def run(t: Star) -> DataFrame:
        train, test = recommend.rating_split(cf_pairs(t))
        return fit(train).predict(test).select("user", "item", "r", "prediction")

    over_star(name, run)


factor_query("svd", lambda train: recommend.fit_svd(train, rank=50, rounds=20))
factor_query("svdpp", factor_sgd.fit_svdpp_sgd)
factor_query("nmf", lambda train: recommend.fit_nmf(train, rank=15, rounds=50))


#: Every factor model that is tuned, with its fit and its grid.
RECOMMENDERS = [
    ("svd", factor_sgd.fit_svd_sgd, recommend.SVD_GRID),
    ("svdpp", factor_sgd.fit_svdpp_sgd, recommend.SVDPP_GRID),
    ("nmf", recommend.fit_nmf, recommend.NMF_GRID),
]


def recommender_grid(t: Star) -> DataFrame:
    """Errors on the held-out ratings of every grid point of SVD, SVD++ and NMF."""
    train, test = recommend.rating_split(cf_pairs(t))
    rows = None
    for name, fit, grid in RECOMMENDERS:
        one = recommend.grid_search(fit, grid, train, test).select(F.lit(name).alias("model"), "*")
        rows = one if rows is None else rows.unionByName(one)
    return rows


over_star("recommender_grid", recommender_grid)


def top_recommendations(t: Star) -> DataFrame:
    return recommend.fit_nmf(cf_pairs(t), rank=15, rounds=50).recommend(10)


over_star("recommend_top_k", top_recommendations)


def candidate_requests(t: Star) -> DataFrame:
    """One request per bought (person, product): the product and its two successors; some
    requests are not valid JSON and some name products that do not exist."""
    pairs = collaborative.user_item_interactions(t).select("customer_unique_id", "product_key")
    p = F.col("product_key")
    return pairs.select(
        F.concat_ws("-", "customer_unique_id", "product_key").alias("request_id"),
        "customer_unique_id",
        F.when(p % 17 == 0, F.lit("oops")).otherwise(
            F.to_json(F.array(p, p + 1, p + 2))
        ).alias("candidate_product_ids"),
    )


def mean_scorer(t: Star):
    """Score = mean of the product's and the person's average review score."""
    goods = content.product_review_stats(t).select(
        "product_key", F.col("avg_review_score").alias("liked")
    )
    people = content.customer_reviews(t).select(
        "customer_unique_id", F.col("avg_review_score").alias("given")
    )

    def predict(rows: DataFrame) -> DataFrame:
        return rows.join(goods, "product_key", "left").join(
            people, "customer_unique_id", "left"
        ).withColumn(
            "prediction",
            sixth((F.coalesce("liked", F.lit(0.0)) + F.coalesce("given", F.lit(0.0))) / 2),
        )

    return predict


def scored_candidates(t: Star) -> DataFrame:
    goods = t.products.filter("product_category_name is not null")
    return scoring.score_candidates(candidate_requests(t), t.customers, goods, mean_scorer(t))


_CANDIDATES = {
    "goods": "select product_key from s_products where product_category_name is not null",
    "pairs": "select distinct customer_unique_id, product_key as p from s_items "
    "join s_customers using (customer_key)",
    "cand": "select customer_unique_id || '-' || p as request_id, customer_unique_id, "
    "unnest([p, p + 1, p + 2]) as product_key from pairs where p % 17 <> 0",
    "lost": "select * from cand where product_key not in (select product_key from goods)",
}


def candidate_lookup(t: Star) -> DataFrame:
    goods = t.products.filter("product_category_name is not null")
    return scoring.candidate_rows(candidate_requests(t), t.customers, goods)


over_star("candidate_lookup", candidate_lookup, star_sql(
    "select request_id, customer_unique_id, product_key, true as known from cand "
    "where request_id not in (select request_id from lost) union all "
    "select distinct request_id, customer_unique_id, null::bigint, false from lost",
    **_CANDIDATES,
))
over_star("score_candidates", scored_candidates, star_sql(
    "select request_id, customer_unique_id as customer_id, product_key, predicted_score, "
    "cast(row_number() over (partition by request_id order by predicted_score desc, product_key) "
    "as int) as rank from (select *, round((coalesce(liked, 0) + coalesce(given, 0)) / 2, 6) "
    "as predicted_score from cand left join liking using (product_key) "
    "left join giving using (customer_unique_id)) "
    "where request_id not in (select request_id from lost) union all "
    "select distinct request_id, customer_unique_id, null, null, null from lost",
    **_CANDIDATES,
    liking="select product_key, sum(score)::double / count(score) as liked from s_items "
    "join s_reviews using (order_key) group by all",
    giving="select customer_unique_id, sum(score)::double / count(score) as given from s_reviews "
    "join s_customers using (customer_key) group by all",
))


def interaction_features(t: Star) -> DataFrame:
    """Each satisfaction label with its person's and product's features."""
    people = kept(t, "customers", lambda: content.customer_content_features(t))
    goods = kept(t, "products", lambda: content.product_content_features(t))
    return rounded(
        content.satisfaction_labels(t)
        .join(people.select("customer_unique_id", "total_orders", "favorite_category"),
              "customer_unique_id")
        .join(goods.select("product_key", "total_sales_count", "avg_price"), "product_key")
    )


over_star("interaction_features", interaction_features, star_sql(
    "select customer_unique_id, product_key, round(sum(score)::double / count(score), 6) "
    "as avg_review_score_by_user, count(i.order_id) as purchase_count, any_value(total_orders) "
    "as total_orders, any_value(favorite_category) as favorite_category, "
    "any_value(total_sales_count) as total_sales_count, any_value(avg_price) as avg_price "
    "from s_reviews r join s_items i on i.order_key = r.order_key "
    "join s_customers c on c.customer_key = r.customer_key "
    "join customer_features using (customer_unique_id) join product_features using (product_key) "
    "group by customer_unique_id, product_key",
    **{**sql_features.PRODUCT_PARTS, **sql_features.CUSTOMER_PARTS},
))


def fitted_content(t: Star):
    labels = kept(t, "labels", lambda: content.satisfaction_labels(t))
    train, test = prep.split(labels, 0.8, 42, "customer_unique_id", "product_key")
    model = content_model.fit_content(
        kept(t, "customers", lambda: content.customer_content_features(t)),
        kept(t, "products", lambda: content.product_content_features(t)),
        train, factors=32, rounds=20,
    )
    return model, test


def content_scores(t: Star) -> DataFrame:
    """Global RMSE and MAE of the content model on held-out labels."""
    model, test = fitted_content(t)
    return evaluate.regression_errors(model.predict(test), "avg_review_score_by_user")


over_star("content_model", content_scores)


def content_candidates(t: Star) -> DataFrame:
    """Candidate lists ranked by the content model."""
    model, _ = fitted_content(t)
    goods = t.products.filter("product_category_name is not null")
    return scoring.score_candidates(candidate_requests(t), t.customers, goods, model.predict)


over_star("content_score_candidates", content_candidates)


def content_towers(t: Star) -> DataFrame:
    """Held-out labels with the prediction of the two-tower model, which reads the history."""
    labels = kept(t, "labels", lambda: content.satisfaction_labels(t))
    train, test = prep.split(labels, 0.8, 42, "customer_unique_id", "product_key")
    model = towers.fit_towers(
        kept(t, "customers", lambda: content.customer_content_features(t)),
        kept(t, "products", lambda: content.product_content_features(t)), train,
    )
    return model.predict(test)


over_star("content_towers", content_towers)


def _versions(t: Star):
    """Brands stand in for models: the largest size of any part is the current version, the
    largest size of a standard part the released one."""
    parts = t.raw("part").select(F.col("p_brand").alias("name"), "p_size", "p_type")
    current = parts.groupBy("name").agg(F.max("p_size").alias("version"))
    released = parts.filter("p_type = 'STANDARD'").groupBy("name").agg(
        F.max("p_size").alias("version")
    )
    return current, released


_VERSIONS = {
    "cur": "select p_brand as name, max(p_size) as version from part group by all",
    "rel": "select p_brand as name, max(p_size) as version from part "
    "where p_type = 'STANDARD' group by all",
}
over_star("scd_version_diff", lambda t: scoring.scd_version_diff(*_versions(t)), star_sql(
    "select name, cur.version, coalesce(rel.version, 0) as last_version from cur "
    "left join rel using (name) where cur.version > coalesce(rel.version, 0)", **_VERSIONS
))
over_star("state_upsert", lambda t: scoring.state_upsert(*reversed(_versions(t))), star_sql(
    "select name, coalesce(cur.version, rel.version) as version from rel "
    "full join cur using (name)", **_VERSIONS
))

# --- text -------------------------------------------------------------------------------

over_star("summarise_reviews", lambda t: text.summarise_reviews(t.review_content), star_sql(
    "select review_content_key, array_to_string(list_slice(list_filter(regexp_split_to_array("
    "string_agg(sentence, ' ' order by pos), '\\s+'), lambda w: w <> ''), 1, 100), ' ') "
    "as summary from (select *, sum(n_words) over (partition by review_content_key "
    "order by score desc, pos) as upto from ranked) where upto <= 100 or upto - n_words < 10 "
    "group by review_content_key",
    chosen="select review_content_key, review_comment_message as m from s_content where "
    "len(list_filter(regexp_split_to_array(review_comment_message, '\\s+'), "
    "lambda w: w <> '')) >= 8",
    cut="select review_content_key, string_split(regexp_replace(trim(m), '([.!?])\\s+', "
    "'\\1' || chr(1), 'g'), chr(1)) as parts from chosen",
    parts="select * from (select review_content_key, pos, sentence, "
    "list_filter(regexp_split_to_array(lower(sentence), '\\s+'), lambda w: w <> '') as words, "
    "len(words) as n_words from (select review_content_key, unnest(parts) as sentence, "
    "generate_subscripts(parts, 1) as pos from cut)) where n_words > 0",
    terms="select review_content_key, pos, word, count(*) as n_here from (select "
    "review_content_key, pos, unnest(words) as word from parts) where length(word) >= 4 "
    "group by all",
    counts="select review_content_key, word, sum(n_here) as n_all from terms group by all",
    weights="select review_content_key, pos, sum(n_here * n_all) as weight from terms "
    "join counts using (review_content_key, word) group by all",
    ranked="select *, coalesce(weight, 0)::double / n_words as score from parts "
    "left join weights using (review_content_key, pos)",
))
