"""Language identification: family first, then one-versus-one linear SVMs within the family.

A text's features are the shares of its byte trigrams, hashed to DIM values; letters of A-Z are
lower-cased and everything else below 128 counts as space. A linear machine's decision over a whole
text is then the mean of one weight per position, computed in numpy on the bytes as they come.

Training takes a bounded sample: at most about SAMPLE documents in all, shared equally among the
languages, chosen by a hash of the id. Features are made by Spark tasks; only they reach the driver.

Defined cases: null text, or one without a letter, is `und` with score 0; without any training row
every text is `und`; a single language or family needs no machine and scores 1; labels that are
null never train; languages missing from the family table are families of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.common import give_back, in_batches, lean, pieces, table

DIM_BITS = 12
DIM = 1 << DIM_BITS
SAMPLE = 2000
UNKNOWN = "und"

# Families of languages by ISO 639-1 code.
FAMILIES = {
    "germanic": "af da de en fy is lb nb nl nn no sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "baltic": "lt lv",
    "uralic": "et fi hu",
    "turkic": "az kk ky tr tt uz",
    "indic": "bn gu hi mr ne pa si ur",
    "iranian": "fa ku ps tg",
    "semitic": "am ar he mt",
    "celtic": "br cy ga gd",
    "dravidian": "kn ml ta te",
    "sinitic": "zh",
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

_SEEN = np.full(256, 0x20, np.uint32)
_SEEN[97:123] = np.arange(97, 123)
_SEEN[65:91] = np.arange(97, 123)
_SEEN[128:] = np.arange(128, 256)


def family(lang: str) -> str:
    return _FAMILY.get(lang.split("-")[0].lower(), lang)


def trigrams(data: np.ndarray) -> np.ndarray:
    """A hashed trigram for each byte but the last two."""
    b = _SEEN[data]
    code = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
    return (code * np.uint32(2654435761)) >> np.uint32(32 - DIM_BITS)


def _per_text(texts: pa.Array, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum over each text's trigrams of the rows of `weights`, and the number of trigrams."""
    sums = np.zeros((len(texts), weights.shape[1]))
    count = np.zeros(len(texts), np.int64)
    for first, n, data, bounds in pieces(texts):
        if len(data) < 3:
            continue
        codes = trigrams(data)
        begin, end = bounds[:-1], np.maximum(bounds[:-1], bounds[1:] - 2)
        count[first:first + n] += end - begin
        for k in range(weights.shape[1]):
            upto = np.concatenate(([0.0], np.cumsum(weights[codes, k], dtype=np.float64)))
            sums[first:first + n, k] += upto[end] - upto[begin]
    return sums, count


def _features(batches):
    for batch in batches:
        texts = batch.column("_text").fill_null("")
        rows = np.zeros((len(texts), DIM))
        for first, n, data, bounds in pieces(texts):
            if len(data) < 3:
                continue
            codes = trigrams(data)
            for i in range(n):
                own = codes[bounds[i]:max(bounds[i], bounds[i + 1] - 2)]
                rows[first + i] += np.bincount(own, minlength=DIM)
        made = [r.astype(np.uint32) for r in rows]
        yield pa.RecordBatch.from_arrays(
            [batch.column("lang"), pa.array([
                np.concatenate((i := np.flatnonzero(r).astype(np.uint32), r[i])).tobytes() for r in made],
                pa.binary())], ["lang", "cells"])


def _machine(x: np.ndarray, side: np.ndarray, rounds: int = 40, reg: float = 1e-5) -> tuple[np.ndarray, float]:
    """A linear SVM: hinge loss, classes weighted alike, averaged subgradient steps."""
    rng = np.random.default_rng(8)
    n, w, b = len(x), np.zeros(x.shape[1]), 0.0
    mean, mean_b, steps, t = np.zeros_like(w), 0.0, 0, 0
    weight = np.where(side > 0, n / (2 * max(1, (side > 0).sum())), n / (2 * max(1, (side < 0).sum())))
    for epoch in range(rounds):
        for part in np.array_split(rng.permutation(n), max(1, n // 32)):
            t += 1
            rate = 2.0 / (1 + t / (n / 32 * 4 + 1))
            wrong = part[side[part] * (x[part] @ w + b) < 1]
            pull = weight[wrong] * side[wrong] / len(part)
            w *= 1 - rate * reg
            w += rate * (pull @ x[wrong])
            b += rate * 0.1 * pull.sum()
            if epoch >= rounds // 2:
                mean, mean_b, steps = mean + w, mean_b + b, steps + 1
    return mean / max(1, steps), mean_b / max(1, steps)


class Model:
    """Machines for pairs of families, and for pairs of languages in each family."""

    def __init__(self, langs: list[str], x: np.ndarray):
        self.langs = sorted(set(langs))
        self.families: dict[str, list[str]] = {}
        for lang in self.langs:
            self.families.setdefault(family(lang), []).append(lang)
        names, own = np.array(langs), np.array([family(v) for v in langs])
        scale = 1 / np.maximum(np.sqrt((x ** 2).mean(0)), np.float32(1e-4)) if len(x) else np.ones(DIM, np.float32)
        scaled = x * scale / 8
        self.pairs, columns, self.bias = [], [], []
        groups = [(own, list(self.families))] + [(names, v) for v in self.families.values()]
        for values, among in groups:
            for a, b in combinations(among, 2):
                rows = (values == a) | (values == b)
                w, bias = _machine(scaled[rows], np.where(values[rows] == a, 1.0, -1.0))
                self.pairs.append((a, b))
                columns.append(w * scale / 8)
                self.bias.append(bias)
        self.weights = np.stack(columns, 1).astype(np.float32) if columns else np.zeros((DIM, 0), np.float32)

    def _vote(self, among: list[str], margins: dict) -> tuple[np.ndarray, np.ndarray]:
        """Winner's place among the names by votes, then by summed margins; its least margin."""
        n = len(next(iter(margins.values()))) if margins else 0
        votes, sums = np.zeros((n, len(among))), np.zeros((n, len(among)))
        least = np.full((n, len(among)), np.inf)
        for i, j in combinations(range(len(among)), 2):
            m = margins[among[i], among[j]]
            for k, own in ((i, m), (j, -m)):
                votes[:, k] += own > 0
                sums[:, k] += own
                least[:, k] = np.minimum(least[:, k], own)
        best = np.argmax(votes + np.tanh(sums / 1e3) * 1e-3, 1)
        return best, least[np.arange(n), best]

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        sums, count = _per_text(texts, self.weights)
        decided = sums / np.maximum(count, 1)[:, None] + np.array(self.bias)[None, :]
        margins = {p: decided[:, k] for k, p in enumerate(self.pairs)}
        every = np.arange(len(texts))
        names = list(self.families)
        if len(names) > 1:
            top, sure = self._vote(names, {p: margins[p] for p in combinations(names, 2)})
        else:
            top, sure = np.zeros(len(texts), int), np.full(len(texts), np.inf)
        out = np.empty(len(texts), object)
        for f, name in enumerate(names):
            rows, among = every[top == f], self.families[name]
            if len(among) > 1 and len(rows):
                best, least = self._vote(
                    among, {p: margins[p][rows] for p in combinations(among, 2)})
                out[rows] = np.array(among, object)[best]
                sure[rows] = np.minimum(sure[rows], least)
            else:
                out[rows] = among[0]
        return list(out), 1 / (1 + np.exp(-2 * np.clip(sure, -20, 20)))


def _unpack(cells: bytes) -> np.ndarray:
    row = np.zeros(DIM, np.float32)
    both = np.frombuffer(cells, np.uint32)
    half = len(both) // 2
    row[both[:half]] = both[half:]
    return row / np.float32(max(1.0, row.sum()))


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        sample: int = SAMPLE) -> Model:
    """A model from labelled rows; about `sample` of them are used."""
    rows = labelled.where(F.col(lang_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("_text"),
        (F.pmod(F.xxhash64(F.col(id_col), F.lit(8)), F.lit(1 << 30)) / float(1 << 30)).alias("_draw"))
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return Model([], np.zeros((0, DIM)))
    each = max(10, sample // len(counts))
    taken = F.lit(False)
    for lang, n in sorted(counts.items()):
        taken = taken | ((F.col("lang") == lang) & (F.col("_draw") < each / n))
    found = in_batches(rows.where(taken).drop("_draw")).mapInArrow(lean(_features), "lang string, cells binary").collect()
    found.sort(key=lambda r: (r[0], bytes(r[1])))  # the fit must not depend on the order of arrival
    return Model([r[0] for r in found], np.array([_unpack(r[1]) for r in found]).reshape(-1, DIM))


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows with lang_pred and score added, in place of columns of these names.

    Rejected rows are those with `und`.
    """
    def judged(texts: pd.Series) -> pd.DataFrame:
        empty = [not t or not any(map(str.isalpha, t)) for t in texts]
        if not model.langs:
            langs, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
        else:
            langs, score = model.predict(pa.array(texts.tolist(), pa.string()))
        return pd.DataFrame({
            "lang_pred": [UNKNOWN if e else v for e, v in zip(empty, langs)],
            "score": np.where(empty, 0.0, score)})

    @F.pandas_udf("lang_pred string, score double")
    def label(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        try:
            yield from map(judged, batches)
        finally:
            give_back()

    rest = [c for c in docs.columns if c not in ("lang_pred", "score")]
    return in_batches(docs).withColumn("__label", label(F.col(text_col))).select(*rest, "__label.*")


def remainder(id_col: str, of: int) -> Column:
    """crc32 of the id as text, modulo `of`."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(of))


def held_out(id_col: str) -> Column:
    return F.coalesce(remainder(id_col, 4) == 2, F.lit(False))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(~held_out("doc_id")))
    return identify(
        docs.select("doc_id", held_out("doc_id").alias("held_out"), "text"), model
    ).select("doc_id", "held_out", "lang_pred", "score")
