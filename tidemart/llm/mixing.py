"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each document gets an exponential key, -ln(u) / w, where u is a hash of its id and w its quality
weight. Sorted by that key within a source, a prefix of the documents is a weighted sample without
replacement. A source's token budget is spent on complete epochs first; what is left is the prefix
whose words add up to it, the last document being cut.

A source may hold a third of all rows, so no source is sorted as a whole: keys fall into bins,
words are summed per source and bin, and only the bin in which the budget ends is sorted.

Defined cases: null text has size 0 and takes nothing; null source is a source of its own, last;
null ids are hashed like an empty id; equal keys go by id; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemart.llm.common import WORD, table, word_count
from tidemart.operators.relational import broadcast_if_small
from tidemart.session import written

BINS = 4096
WEIGHTS = (5, 2, 1)
#: Characters that count against a document's quality weight.
SYMBOLS = "#*$%&|<>"


def quality_weight(text: Column) -> Column:
    """From 1 down to 0.05 as the share of symbol characters rises to a fifth."""
    n = F.length(text)
    share = (n - F.length(F.translate(text, SYMBOLS, ""))) / n
    return F.when(n > 0, F.greatest(F.lit(0.05), 1 - 5 * share)).otherwise(F.lit(1.0))


def uniform(key: Column, seed: int) -> Column:
    """A number in (0, 1] from a hash of the key."""
    digits = F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string"))), 1, 13)
    return (F.conv(digits, 16, 10).cast("long") + 1) / F.lit(float(16 ** 13))


def source_targets(sizes: DataFrame, weights: Sequence[float], most: float) -> DataFrame:
    """source, source_size -> also target: shares by weight, none above `most` times its size.

    The sources that stop at their limit are those with the least limit per weight, so one pass in
    that order finds them. One row per source is ordered, not the documents.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    given = F.array(*[F.lit(float(w)) for w in weights])
    limit, weight = F.col("_limit"), F.col("_weight")
    ranked = sizes.withColumn("_weight", F.get(given, place % len(weights))).withColumn(
        "_limit", F.col("source_size") * F.lit(float(most)))
    everything = Window.orderBy(F.lit(0)).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    upto = Window.orderBy(limit / weight, F.col("source").isNull(), "source").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    ranked = (
        ranked.withColumn("_all", F.sum("source_size").over(everything).cast("double"))
        .withColumn("_weights", F.sum(weight).over(everything))
        .withColumn("_limits_before", F.sum(limit).over(upto) - limit)
        .withColumn("_weights_before", F.sum(weight).over(upto) - weight)
    )
    open_weight = F.col("_weights") - F.col("_weights_before")
    ranked = ranked.withColumn(
        "_stops", limit * open_weight <= weight * (F.col("_all") - F.col("_limits_before")))
    stopped = F.coalesce(F.sum(F.when(F.col("_stops"), limit)).over(everything), F.lit(0.0))
    stopped_weight = F.coalesce(F.sum(F.when(F.col("_stops"), weight)).over(everything), F.lit(0.0))
    return ranked.withColumn("_stopped", stopped).withColumn("_sw", stopped_weight).select(
        "source", "source_size",
        F.when(F.col("_stops"), limit).otherwise(
            weight * (F.col("_all") - F.col("_stopped")) / (F.col("_weights") - F.col("_sw"))
        ).alias("target"),
    )


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", weights: Sequence[float] = WEIGHTS, max_epochs: int = 3,
        quality: Column | None = None, seed: int = 5) -> DataFrame:
    """Per row: doc_id, source, size, source_size, target, taken, copies.

    taken: words the mix takes, complete epochs and the sampled rest together. copies: how often
    the whole document would be written (the cut one counts from half its words on).
    """
    text = F.col(text_col)
    sized = written(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        word_count(text_col).alias("size"),
        (-F.log(uniform(F.col(id_col), seed))
         / (quality if quality is not None else quality_weight(text))).alias("_key"),
    ).withColumn("_bin", F.floor(F.lit(BINS) * (1 - F.exp(-F.coalesce("_key", F.lit(0.0))))).cast("int")),
        "mix-sizes")
    cells = written(sized.groupBy("source", "_bin").agg(
        F.sum("size").alias("words")), "mix-cells")
    plan = source_targets(
        cells.groupBy("source").agg(F.sum("words").alias("source_size")), weights, max_epochs)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
    plan = written(plan.withColumn("_epochs", F.coalesce(epochs, F.lit(0)).cast("long")).withColumn(
        "_rest", F.round(F.col("target") - F.col("_epochs") * F.col("source_size")).cast("long")),
        "mix-plan")
    filled = Window.partitionBy("source").orderBy("_bin").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    ends = (
        cells.withColumn("_upto", F.sum("words").over(filled))
        .join(plan.select(F.col("source").alias("_s"), "_rest"), F.col("source").eqNullSafe(F.col("_s")))
        .where((F.col("_upto") >= F.col("_rest")) & (F.col("_upto") - F.col("words") < F.col("_rest")))
        .groupBy("_s").agg(F.min(F.struct("_bin", (F.col("_upto") - F.col("words")).alias("before"))).alias("_end"))
        .select(F.col("_s").alias("_e"), F.col("_end._bin").alias("_last"), F.col("_end.before").alias("_before"))
    )
    plan = written(
        plan.join(ends, F.col("source").eqNullSafe(F.col("_e")), "left")
        .select(F.col("source").alias("_s"), "source_size", "target", "_epochs", "_rest",
                F.coalesce("_last", F.lit(-1)).alias("_last"), F.coalesce("_before", F.lit(0)).alias("_before")),
        "mix-ends")
    rows = sized.join(broadcast_if_small(plan), F.col("source").eqNullSafe(F.col("_s")))
    whole = rows.where(F.col("_bin") != F.col("_last")).withColumn(
        "_part", F.when(F.col("_bin") < F.col("_last"), F.col("size")).otherwise(F.lit(0)))
    order = Window.partitionBy("source").orderBy("_key", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    cut = rows.where(F.col("_bin") == F.col("_last")).withColumn(
        "_part", F.greatest(F.lit(0), F.least(
            F.col("size"),
            F.col("_rest") - F.col("_before") - (F.sum("size").over(order) - F.col("size")))))
    return whole.unionByName(cut).select(
        "doc_id", "source", "size", "source_size", "target",
        (F.col("_epochs") * F.col("size") + F.col("_part")).cast("long").alias("taken"),
        (F.col("_epochs") + F.when((F.col("_part") > 0) & (2 * F.col("_part") >= F.col("size")), 1)
         .otherwise(0)).cast("int").alias("copies"),
    )


def mixed(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The documents themselves, each as often as the mix takes it; rows with one id fare alike."""
    copies = written(mix(docs, id_col, **options).groupBy(F.col("doc_id").alias("__mix_id")).agg(
        F.max("copies").alias("__copies")).where("__copies > 0"), "mix-copies")
    return docs.join(broadcast_if_small(copies), F.col(id_col).eqNullSafe(F.col("__mix_id"))).withColumn(
        "__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(*docs.columns)


def op5_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


OP5_SQL = rf"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS BIGINT) AS size,
    -ln((CAST('0x' || substr(md5('5:' || CAST(doc_id AS VARCHAR)), 1, 13) AS BIGINT) + 1) / {float(16 ** 13)})
    / CASE WHEN length(text) > 0 THEN greatest(0.05, 1 - 5 * ((length(text)
        - length(translate(text, '{SYMBOLS}', ''))) / CAST(length(text) AS DOUBLE)))
      ELSE 1.0 END AS k
  FROM documents
), sources AS (
  SELECT source, sum(size)::DOUBLE AS source_size,
    CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END AS w
  FROM sized GROUP BY source
), levels AS (
  SELECT *, sum(source_size) OVER () AS s, sum(w) OVER () AS sw,
    sum(3 * source_size) OVER o - 3 * source_size AS b, sum(w) OVER o - w AS bw
  FROM sources WINDOW o AS (ORDER BY 3 * source_size / w, source NULLS LAST ROWS UNBOUNDED PRECEDING)
), stops AS (
  SELECT *, 3 * source_size * (sw - bw) <= w * (s - b) AS stop FROM levels
), targets AS (
  SELECT source, source_size, CASE WHEN stop THEN 3 * source_size ELSE
    w * (s - coalesce(sum(3 * source_size) FILTER (stop) OVER (), 0))
      / (sw - coalesce(sum(w) FILTER (stop) OVER (), 0)) END AS target FROM stops
), parts AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM targets
), keyed AS (
  SELECT d.doc_id, d.size, p.source_size, p.target, p.epochs,
    round(p.target - p.epochs * p.source_size)
      - (sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) - d.size) AS room
  FROM sized d JOIN parts p ON d.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target,
  CAST(epochs * size + greatest(0, least(size, room)) AS BIGINT) AS taken FROM keyed
"""
