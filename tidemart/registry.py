"""Every query the engine answers, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemart.functions.scalars import sixth
from tidemart.oracle import features as sql_features
from tidemart.oracle import marts as sql_marts
from tidemart.plans import churn, collaborative, content, marts
from tidemart.session import tune
from tidemart.sources.star import Star, load_star

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def over_star(name: str, plan: Callable[[Star], DataFrame], oracle: str | None = None) -> None:
    """Register a plan over the star schema."""
    QUERIES[name] = lambda spark, root: plan(load_star(tune(spark), root))
    if oracle:
        ORACLES[name] = oracle


def rounded(frame: DataFrame) -> DataFrame:
    """Every double column at six places; exact decimals as double."""
    def shown(c: str, kind: str):
        if kind == "double":
            return sixth(frame[c]).alias(c)
        return frame[c].cast("double").alias(c) if kind.startswith("decimal") else frame[c]

    return frame.select(*[shown(c, kind) for c, kind in frame.dtypes])


for _name, _sql in sql_marts.MARTS.items():
    over_star(_name, getattr(marts, _name), _sql)
for _name, _sql in sql_marts.CHURN.items():
    if hasattr(churn, _name):
        _plan = getattr(churn, _name)
        over_star(
            _name, _plan if "features" in _name else (lambda t, p=_plan: rounded(p(t))), _sql
        )
over_star(
    "customer_mart", lambda t: marts.customer_mart(churn.churn_features(t)),
    sql_marts.CHURN["customer_mart"],
)

for _name, _sql in sql_features.COLLABORATIVE.items():
    if _name != "duplicate_count":
        over_star(_name, lambda t, p=getattr(collaborative, _name): rounded(p(t)), _sql)
over_star(
    "duplicate_count",
    lambda t: collaborative.duplicate_count(collaborative.cf_interaction_table(t, ordered=False)),
    sql_features.COLLABORATIVE["duplicate_count"],
)
for _name in ("product_content_features", "customer_content_features", "satisfaction_labels"):
    over_star(
        _name, lambda t, p=getattr(content, _name): rounded(p(t)), sql_features.CONTENT[_name]
    )
over_star(
    "product_performance",
    lambda t: rounded(marts.product_performance(content.product_content_features(t))),
    sql_features.CONTENT["product_performance"],
)

# The other registries add to the same tables.
from tidemart import registry_basics, registry_learning, registry_medallion  # noqa: E402, F401
