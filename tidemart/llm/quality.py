"""Quality rules with risk-controlled thresholds. DataFrame functions only.

Each rule is a measure of a text, higher being worse, with eight cutoffs from loose to strict.
Documents labelled good are the holdout. A level is certified in a group of n good documents, k of
which it would reject, if seeing k or fewer had probability at most its share of delta were the true
rate at the allowed one: the exact binomial test, the Clopper-Pearson bound read the other way.
Levels are nested, so they are tested in a fixed sequence from the loosest on and the first failure
ends it; no correction for the number of cutoffs is due. Four families of sequences share delta:

* joint (1/2, over strata): all rules at the same level together reject at most alpha;
* rules (1/4, over strata and rules): a rule alone rejects at most alpha / rules;
* pool (1/8): all rules at a level reject at most alpha of all good documents together;
* loose (1/8, over strata): they reject at most ``loose`` of the stratum's good documents.

With probability 1 - delta every certified statement holds, so a stratum may use whichever of joint
and rules reached further. A stratum whose labels certify neither takes the lower of its pool and
loose levels: it then loses at most ``loose`` of its good documents, and all strata together at most
alpha. With none of these its rules are silent. With four strata and no exceedance joint needs 252
good labels, loose 62.

Defined cases: null text has no words and fails the base rule; a null or unlabelled stratum is a
stratum of its own, and without labels silent; several labels of one document count as good only if
all are; repeated rows count as often as they appear; very long texts are counted whole; columns are
taken by name and others are ignored, whatever they are called; empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemart.llm.common import WORD, table
from tidemart.operators.relational import broadcast_if_small
from tidemart.session import written

WINDOW = 8
#: Rules: measure over the base counts, and the cutoffs tried.
RULES = {
    "symbols": ("n_symbols / word_chars", (0.002, 0.005, 0.01, 0.02, 0.04, 0.08, 0.16, 0.32)),
    "dup_lines": ("n_dup_lines / n_lines", (0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.6, 0.8)),
    "repeats": ("n_repeat_words / n_words", (0.02, 0.05, 0.08, 0.12, 0.16, 0.2, 0.25, 0.3)),
    "word_length": ("word_chars / n_words", (6.5, 7.0, 8.0, 9.0, 10.0, 12.0, 15.0, 20.0)),
}


def _window_hashes(hashes: str) -> Column:
    """A hash per window of words, from the words' hashes; two levels cost less than slices."""
    ahead = ", ".join(f"get({hashes}, i + {k})" for k in range(1, WINDOW))
    return F.expr(
        f"if(size({hashes}) >= {WINDOW}, slice(transform({hashes}, (h, i) -> xxhash64(h, {ahead})),"
        f" 1, size({hashes}) - {WINDOW - 1}), array())")


def _covered(ordered: str) -> Column:
    """Words covered by windows that occur twice or more; `ordered`: (hash, place), sorted."""
    starts = F.expr(
        f"transform({ordered}, (e, j) -> if(e.h = get({ordered}, j - 1).h"
        f" or e.h = get({ordered}, j + 1).h, e.i, null))")
    return F.coalesce(F.aggregate(
        F.array_sort(F.array_compact(starts)),
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
        lambda a, i: F.struct(
            i.alias("last"), (a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n")),
        lambda a: a["n"]), F.lit(0)).cast("long")


def base_counts(docs: DataFrame, text_col: str, keep: dict[str, Column]) -> DataFrame:
    """The columns in `keep`, and the base counts of the whole text."""
    made = docs.select(
        *[c.alias(n) for n, c in keep.items()], F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    made = made.select(
        *keep, "_text",
        F.array_remove(F.split("_text", r"[\x20\x09-\x0D]+"), "").alias("_words"),
        F.filter(F.split("_text", "\n"), lambda x: F.rlike(x, F.lit(WORD))).alias("_lines"))
    made = made.select(
        *keep, F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_hashes"))
    rest = [c for c in made.columns if c != "_hashes"]
    made = made.select(*rest, _window_hashes("_hashes").alias("_windows"))
    made = made.select(*rest, F.expr(
        "if(size(array_distinct(_windows)) < size(_windows),"
        " array_sort(transform(_windows, (h, i) -> struct(h as h, i as i))), null)").alias("_ordered"))
    return made.select(*rest, _covered("_ordered").alias("n_repeat_words")).withColumn(
        "base_failed",
        (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))


def measure(rule: str) -> Column:
    """A rule's measure; null where its divisor is 0."""
    over, under = RULES[rule][0].split(" / ")
    return F.when(F.col(under) > 0, F.col(over) / F.col(under))


def binomial_tail(n: Column, k: Column, rate: float) -> Column:
    """P(X <= k) for X binomial(n, rate), exact; 1 where k is not below the mean."""
    odds = rate / (1 - rate)
    tail = F.aggregate(
        F.sequence(F.lit(1), F.greatest(k, F.lit(1))),
        F.struct((n * F.log1p(F.lit(-rate))).alias("at"), F.exp(n * F.log1p(F.lit(-rate))).alias("sum")),
        lambda a, i: F.struct(
            (a["at"] + F.log((n - i + 1) * odds / i)).alias("at"),
            (a["sum"] + F.when(i <= k, F.exp(a["at"] + F.log((n - i + 1) * odds / i)))
             .otherwise(0.0)).alias("sum")),
        lambda a: a["sum"])
    return F.when(n == 0, 1.0).when(k >= n * rate, 1.0).otherwise(F.least(tail, F.lit(1.0)))


LEVELS = len(next(iter(RULES.values()))[1])
assert all(len(cuts) == LEVELS for _, cuts in RULES.values())


def _families(alpha: float, delta: float, loose: float) -> list[tuple[str, str, float, float, bool]]:
    """Sequence, the counts it tests, allowed rate, share of delta, and if strata divide the share."""
    return [
        ("joint", "joint", alpha, delta / 2, True), ("loose", "joint", loose, delta / 8, True),
        ("pool", "pool", alpha, delta / 8, False),
        *[(r, r, alpha / len(RULES), delta / 4 / len(RULES), True) for r in RULES]]


def thresholds(good: DataFrame, alpha: float, delta: float, loose: float = 0.1) -> DataFrame:
    """good: stratum and base counts of good documents -> stratum and a cutoff per rule.

    One row per stratum leaves the first grouping; counts for all rules and levels are sums in it.
    """
    over = {r: [F.coalesce(measure(r) > c, F.lit(False)) for c in reversed(cuts)]
            for r, (_, cuts) in RULES.items()}
    over["joint"] = [F.greatest(*[over[r][i] for r in RULES]) for i in range(LEVELS)]
    everyone = Window.partitionBy()  # one row per stratum
    counted = good.groupBy("stratum").agg(
        F.count("*").alias("n"),
        *[F.array(*[F.sum(x.cast("long")) for x in each]).alias(f"k_{name}") for name, each in over.items()]
    ).withColumns({
        "strata": F.count("*").over(everyone), "n_pool": F.sum("n").over(everyone),
        "k_pool": F.array(*[F.sum(F.col("k_joint")[i]).over(everyone) for i in range(LEVELS)])})
    tried = counted.select("stratum", F.explode(F.array(*[
        F.struct(
            F.lit(name).alias("name"), F.lit(level).alias("level"),
            (binomial_tail(F.col("n_pool" if counts == "pool" else "n"), F.col(f"k_{counts}")[level], rate)
             <= F.lit(share) / (F.col("strata") if divided else F.lit(1))).alias("certified"))
        for name, counts, rate, share, divided in _families(alpha, delta, loose)
        for level in range(LEVELS)])).alias("t")).select("stratum", "t.*")
    reached = tried.groupBy("stratum").agg(*[
        F.coalesce(F.min(F.when((F.col("name") == name) & ~F.col("certified"), F.col("level"))),
                   F.lit(LEVELS)).alias(name)
        for name, *_ in _families(alpha, delta, loose)])
    alone = sum((F.col(r) for r in RULES), F.lit(0))
    level = {r: F.when((F.col("joint") > 0) & (F.col("joint") * len(RULES) >= alone), F.col("joint"))
             .when(alone > 0, F.col(r)).otherwise(F.least("pool", "loose")) for r in RULES}
    return reached.select("stratum", *[
        F.get(F.array(*[F.lit(float(c)) for c in reversed(cuts)]), level[r] - 1).alias(f"{r}_cutoff")
        for r, (_, cuts) in RULES.items()])


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          stratum_col: str = "lang", label_col: str = "quality", alpha: float = 0.02,
          delta: float = 0.05, loose: float = 0.1) -> DataFrame:
    """Per row: id, base counts, base_failed, kept, and the name of the rule that rejects it."""
    counts = written(base_counts(docs, text_col, {
        "doc_id": F.col(id_col), "stratum": F.col(stratum_col).cast("string")}), "quality-counts")
    good = labels.groupBy(F.col(id_col).alias("_labelled")).agg(
        F.min(label_col).alias("_label")).where(F.col("_label") == 1)
    cutoffs = thresholds(
        counts.where(~F.col("base_failed")).join(good, F.col("doc_id") == F.col("_labelled")),
        alpha, delta, loose).withColumnRenamed("stratum", "_stratum")
    judged = counts.join(
        broadcast_if_small(written(cutoffs, "quality-cutoffs")),
        F.col("stratum").eqNullSafe(F.col("_stratum")), "left")
    rejecting = F.coalesce(*[
        F.when(measure(r) > F.col(f"{r}_cutoff"), F.lit(r)) for r in RULES])
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", (~F.col("base_failed") & rejecting.isNull()).alias("kept"),
        F.when(F.col("base_failed"), F.lit("base")).otherwise(rejecting).alias("rejected_by"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _sql(alpha: float = 0.02, delta: float = 0.05, loose: float = 0.1) -> str:
    """The same in DuckDB: binomial tails from log-gamma terms."""
    measured = {r: "case when {1} > 0 then {0}::double / {1} end".format(*m.split(" / "))
                for r, (m, _) in RULES.items()}
    tail = ("case when n = 0 or k >= n * rate then 1 else list_sum(list_transform(range(0, k + 1), "
            "lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) "
            "+ i * ln(rate) + (n - i) * ln(1 - rate)))) end")
    level = [" or ".join(f"coalesce({measured[r]} > {cuts[-1 - i]}, false)" for r, (_, cuts) in RULES.items())
             for i in range(LEVELS)]
    counted = " union all ".join(
        [f"select stratum, 'joint' as counts, {i} as level, count(*) as n, "
         f"count(*) filter ({x}) as k from good group by stratum" for i, x in enumerate(level)]
        + [f"select stratum, '{r}', {i}, count(*), count(*) filter ({measured[r]} > {c}) from good group by stratum"
           for r, (_, cuts) in RULES.items() for i, c in enumerate(reversed(cuts))])
    families = ", ".join(
        f"('{name}', '{counts}', {rate}::double, {share}::double, {str(divided).lower()})"
        for name, counts, rate, share, divided in _families(alpha, delta, loose))
    alone = " + ".join(RULES)
    cutoffs = ", ".join(
        f"[{', '.join(str(c) for c in reversed(cuts))}][case when joint > 0 and joint * {len(RULES)} >= {alone} "
        f"then joint when {alone} > 0 then {r} else least(pool, loose) end] as {r}_cutoff"
        for r, (_, cuts) in RULES.items())
    reached = ", ".join(f"coalesce(min(level) filter (name = '{name}' and not certified), {LEVELS}) as {name}"
                        for name, *_ in _families(alpha, delta, loose))
    rejected = " ".join(f"when {measured[r]} > {r}_cutoff then '{r}'" for r in RULES)
    return f"""
with split as (
  select doc_id, lang as stratum, coalesce(text, '') as t,
    regexp_extract_all(coalesce(text, ''), '{WORD}') as w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{WORD}')) as lines
  from documents
), windows as (
  select doc_id, unnest(range(1, len(w) - 6)) as pos,
    unnest(list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i:i + 7], ' '))) as gram
  from split where len(w) >= 8
), doubled as (
  select doc_id, pos from windows qualify count(*) over (partition by doc_id, gram) > 1
), covered as (
  select doc_id, sum(least(8, coalesce(next - pos, 8)))::bigint as n_repeat_words from (
    select doc_id, pos, lead(pos) over (partition by doc_id order by pos) as next from doubled) group by doc_id
), counts as (
  select doc_id, stratum, len(w) as n_words, length(array_to_string(w, '')) as word_chars,
    length(t) - length(translate(t, '#*$%&|<>', '')) as n_symbols, len(lines) as n_lines,
    len(lines) - len(list_distinct(lines)) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words
  from split left join covered using (doc_id)
), judged as (
  select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from counts
), good as (
  select judged.* from judged join (
    select doc_id from labels group by doc_id having min(quality) = 1) using (doc_id) where not base_failed
), counted as ({counted}
), pooled as (
  select * from counted union all
  select s.stratum, 'pool', level, sum(n)::bigint, sum(k)::bigint from counted, (
    select distinct stratum from good) s where counts = 'joint' group by all
), tried as (
  select stratum, name, level, {tail} <= share / case when divided then (
    select count(*) from (select distinct stratum from good)) else 1 end as certified
  from pooled join (values {families}) f(name, counts, rate, share, divided) using (counts)
), reached as (
  select stratum, {reached} from tried group by stratum
), cutoffs as (
  select stratum, {cutoffs} from reached
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and rejecting is null as kept,
  case when base_failed then 'base' else rejecting end as rejected_by
from (select j.*, case {rejected} end as rejecting
      from judged j left join cutoffs c on j.stratum is not distinct from c.stratum)
"""


OP2_SQL = _sql()
