"""Spelling variants: words one edit apart, found by search schemes over two FM-indexes.

One edit leaves one half of a word as it is. Each word is therefore searched twice: its right half
is matched exactly and extended to the left across the other with one error allowed, and its left
half is matched exactly and extended to the right. Extension to the left is a step of the FM-index
of the delimited words; extension to the right is the same step in the index of the reversed words.
Intervals of suffix ranks stand for all matches at once, and only existing symbols are followed.

The vocabulary is cut into ranges of at most about BLOCK words, in the order of the words for the
second search and of the reversed words for the first, so that words which share a half lie side
by side. A word is sent to the ranges that may hold words with its half; a range whose questions
are many is sent once for every BLOCK of them. A task reads a range's words, builds the index, then
answers the questions as they stream by. Counting and the lookup of forms are DataFrame operations.

Defined cases: null texts have no words; a null id counts as empty text; repeated rows are counted
as often as they stand; long runs of letters are words whatever their length; an empty table gives
no rows. Of near words with equal n the smallest in code-point order wins. Columns other than the
two named are not read, so their names cannot clash.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.common import lean, table
from tidemart.session import written

RUN = "[A-Za-z\\u00C0-\\u00FF]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SHORTEST, FEWEST = 5, 3
#: Every so many runs, by hash, lose a letter.
ERRORS = 97
#: Words of a range, and questions answered by one copy of it.
BLOCK = 20_000
#: Questions searched at once inside a task, and their letters.
ASKED, LETTERS = 4_096, 1 << 18


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", errors: int | None = ERRORS,
               shortest: int = SHORTEST, fewest: int = FEWEST) -> DataFrame:
    """word, n: what occurs often enough. With `errors`, every so many runs lose a letter first."""
    runs = docs.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(F.col(text_col), F.lit(RUN), F.lit(0))).alias("run"),
    ).where(F.length("run") >= shortest)
    run = F.when(F.col("run").rlike("[A-Z]"), F.translate("run", UPPER, LOWER)).otherwise(F.col("run"))
    words = runs.select("id", run.alias("word"))
    if errors:
        h = F.crc32(F.concat("id", F.lit(":"), "word").cast("binary"))
        at = (h % F.length("word")).cast("int")
        words = words.withColumn("_h", h).select(F.when(
            F.col("_h") % errors == 0,
            F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))
        ).otherwise(F.col("word")).alias("word")).where(F.length("word") >= shortest)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= fewest)


class Index:
    """FM-index of words, each between delimiters; words are read from their end to their start."""

    def __init__(self, words: list[str]):
        text = "\n" + "".join(w + "\n" for w in words)
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        self.alphabet, text = np.unique(codes, return_inverse=True)  # the delimiter sorts first: 0
        text = text.astype(np.int64)
        n = len(text)
        self.n, self.symbols = n, len(self.alphabet)
        order = self._suffixes(text, self.symbols)
        before = text[order - 1]  # the first suffix is preceded by the last symbol
        # Sorted by symbol, then rank: the place of (c, i) is the number of suffixes that start
        # with less than c, plus the occurrences of c before rank i.
        self.keys = np.sort(before * (n + 1) + np.arange(n))
        self.before = before
        starts = np.flatnonzero(text[:-1] == 0)
        self.word_at = np.full(n, -1)
        self.word_at[starts] = np.arange(len(starts))
        self.word_at = self.word_at[order]

    @staticmethod
    def _suffixes(text: np.ndarray, symbols: int) -> np.ndarray:
        """Ranks of suffixes by doubling; the first comparison already covers several symbols."""
        n, bits = len(text), max(1, int(symbols).bit_length())
        width = 62 // bits
        key = np.zeros(n, np.int64)
        for j in range(width):
            key <<= bits
            key[:n - j] |= text[j:] + 1 if j < n else 0
        step = width
        while True:
            order = np.argsort(key, kind="stable")
            new = np.empty(n, bool)
            new[0] = True
            new[1:] = key[order][1:] != key[order][:-1]
            if new.all():
                return order
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(new)
            key = rank * (n + 1)
            key[:max(0, n - step)] += rank[step:]
            step *= 2

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Symbols (-1: none here) of the words from their end, each followed by -1; starts, lengths."""
        sizes = np.array([len(w) for w in words], np.int64)
        flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        at = np.searchsorted(self.alphabet, flat)
        at[at == self.symbols] = 0
        starts = np.cumsum(sizes + 1) - sizes - 1
        row = np.repeat(np.arange(len(words)), sizes)
        place = np.arange(len(flat)) - (starts - np.arange(len(words)))[row]
        out = np.full(len(flat) + len(words), -1)
        out[starts[row] + sizes[row] - 1 - place] = np.where(self.alphabet[at] == flat, at, -1)
        return out, starts, sizes

    def step(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the matches extended by a symbol on the left."""
        base = symbol * (self.n + 1)
        return np.searchsorted(self.keys, base + low), np.searchsorted(self.keys, base + high)

    def children(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, symbol) of every symbol but the delimiter that precedes a match."""
        wide = high - low > self.symbols
        span = np.where(wide, 0, high - low)
        row = np.repeat(np.arange(len(low)), span)
        rank = np.repeat(low, span) + np.arange(span.sum()) - np.repeat(np.cumsum(span) - span, span)
        pairs = np.unique(row * self.symbols + self.before[rank])
        every = (np.flatnonzero(wide)[:, None] * self.symbols + np.arange(self.symbols)).ravel()
        pairs = np.concatenate([pairs, every])
        pairs = pairs[pairs % self.symbols > 0]
        return pairs // self.symbols, pairs % self.symbols

    def near(self, words: list[str], exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(question, indexed word) one edit apart, the last `exact` letters being the same."""
        code, starts, size = self.encode(words)
        seen = [np.zeros((2, 0), np.int64)]

        def forward(row, done, low, high):
            """States one letter further, where it is there."""
            symbol = code[starts[row] + done]
            lo, hi = self.step(np.maximum(symbol, 0), low, high)
            keep = (symbol >= 0) & (lo < hi)
            return row[keep], done[keep] + 1, lo[keep], hi[keep]

        zero = np.zeros(len(words), np.int64)
        low, high = self.step(zero, zero, zero + self.n)  # the delimiter behind the word
        row, done = np.arange(len(words)), zero
        spent = (zero[:0],) * 4  # states whose error is made: only the rest of the word may follow
        while len(row) or len(spent[0]):
            free = done >= exact[row]  # past the exact half: an error may come here
            r, d, lo, hi = row[free], done[free], low[free], high[free]
            at, symbol = self.children(lo, hi)
            lo2, hi2 = self.step(symbol, lo[at], hi[at])
            some = lo2 < hi2
            at, symbol, lo2, hi2 = at[some], symbol[some], lo2[some], hi2[some]
            swap = (d[at] < size[r[at]]) & (symbol != code[starts[r[at]] + d[at]])
            drop = d < size[r]
            made = (np.concatenate([r[at], r[at][swap], r[drop]]),
                    np.concatenate([d[at], d[at][swap] + 1, d[drop] + 1]),
                    np.concatenate([lo2, lo2[swap], lo[drop]]), np.concatenate([hi2, hi2[swap], hi[drop]]))
            # Edits within a run of one letter lead to the same state: it is followed once.
            spent = np.unique(np.stack([np.concatenate(p) for p in zip(spent, made)]), axis=1)
            ends = spent[1] == size[spent[0]]
            owner, lo, hi = spent[0][ends], *self.step(np.zeros(ends.sum(), np.int64), spent[2][ends], spent[3][ends])
            span = hi - lo
            rank = np.repeat(lo, span) + np.arange(span.sum()) - np.repeat(np.cumsum(span) - span, span)
            seen.append(np.stack([np.repeat(owner, span), self.word_at[rank]]))
            spent = forward(*spent[:, ~ends])
            row, done, low, high = forward(row, done, low, high)
        pairs = np.unique(np.concatenate(seen, axis=1), axis=1)
        return pairs[0], pairs[1]


def _route(bounds: list[list[str]]):
    """Rows (side, block, asks, word, n): each word in its range of either side, and as a question
    in every range that may hold words with its exact half.

    bounds: first keys of all ranges but the first, for each side; keys of side 0 are reversed words.
    """

    def places(word: str) -> list[tuple[int, int, bool]]:
        half = len(word) // 2
        out = []
        for side, key, exact in ((0, word[::-1], word[half:][::-1]), (1, word, word[:half])):
            out.append((side, bisect_right(bounds[side], key), False))
            low, high = bisect_right(bounds[side], exact), bisect_left(bounds[side], exact + "\U0010ffff")
            out += [(side, block, True) for block in range(low, high + 1)]
        return out

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found = [places(w) for w in part.column("word").to_pylist()]
            rows = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]), pa.int64())
            flat = [f for each in found for f in each]
            yield pa.RecordBatch.from_pydict({
                "side": pa.array([f[0] for f in flat], pa.int32()),
                "block": pa.array([f[1] for f in flat], pa.int32()),
                "asks": pa.array([f[2] for f in flat], pa.bool_()),
                "word": part.column("word").take(rows), "n": part.column("n").take(rows)})

    return run


def _answer(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (side, block, chunk, asks): a range's words, then its questions."""
    key, words, counts, index, waiting, letters = None, [], [], None, [], 0

    def results() -> pa.RecordBatch:
        half = np.array([len(w) // 2 for w in waiting])
        exact = np.array([len(w) for w in waiting]) - half if key[0] == 0 else half
        own = [w[::-1] for w in waiting] if key[0] else waiting
        ask, hit = index.near(own, exact)
        keep = []
        for i, j in zip(ask.tolist(), hit.tolist()):
            word, other = waiting[i], words[j]
            # a match that shares both halves is counted on side 0
            keep.append(key[0] == 0 or not other.endswith(word[half[i]:]))
        ask, hit = ask[keep] if len(ask) else ask, hit[keep] if len(hit) else hit
        return pa.RecordBatch.from_pydict({
            "word": pa.array([waiting[i] for i in ask.tolist()], pa.string()),
            "near": pa.array([words[j] for j in hit.tolist()], pa.string()),
            "near_n": pa.array([counts[j] for j in hit.tolist()], pa.int64())})

    for part in parts:
        for side, block, chunk, asks, word, n in zip(*(c.to_pylist() for c in part.columns)):
            if (side, block, chunk) != key:
                if waiting:
                    yield results()
                key, words, counts, index, waiting, letters = (side, block, chunk), [], [], None, [], 0
            if not asks:
                words.append(word)
                counts.append(n)
                continue
            if index is None:
                index = Index([w[::-1] for w in words] if side else words)
            waiting.append(word)
            letters += len(word)
            if len(waiting) == ASKED or letters > LETTERS:
                yield results()
                waiting, letters = [], 0
    if waiting:
        yield results()


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """word, near, near_n: all pairs exactly one edit apart, in both directions.

    `words` has distinct words and their n. The driver holds the first word of every range.
    """
    count = -(-words.count() // block)
    bounds: list[list[str]] = [[], []]
    for side, key in enumerate((F.reverse("word"), F.col("word"))):
        if count > 1:
            cut = words.select(key.alias("key")).repartitionByRange(count, "key").groupBy(F.spark_partition_id())
            bounds[side] = sorted(r["first"] for r in cut.agg(F.min("key").alias("first")).collect())[1:]
    routed = written(words.select("word", "n").mapInArrow(
        _route(bounds), "side int, block int, asks boolean, word string, n long"), "routed")
    chunks = routed.where("asks").groupBy("side", "block").agg(
        F.ceil(F.count("*") / block).cast("int").alias("_chunks"))
    own = F.array(F.pmod(F.xxhash64("word"), F.col("_chunks")).cast("int"))
    return routed.join(F.broadcast(chunks), ["side", "block"]).select(  # a row per range: bounded
        "side", "block", F.explode(F.when(F.col("asks"), own).otherwise(
            F.sequence(F.lit(0), F.col("_chunks") - 1))).alias("chunk"), "asks", "word", "n",
    ).repartition("side", "block", "chunk").sortWithinPartitions("side", "block", "chunk", "asks").mapInArrow(
        lean(_answer), "word string, near string, near_n long")


def roots(words: DataFrame) -> DataFrame:
    """Adds root: the end of the chain of forms. Forms grow at least twofold, so chains are short."""
    links = written(words.where("form is not null").select("word", F.col("form").alias("root")), "forms")
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        links = written(links.join(ahead, "root", "left").select(
            "word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")), "forms")
        if not links.where("_moved").head(1):
            break
        links = links.select("word", "root")
    return words.join(links.select("word", "root"), "word", "left").withColumn("root", F.coalesce("root", "word"))


def variants(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """word, n, n_near, form, form_n, root for every row of `words` (word, n)."""
    words = written(words.select("word", F.col("n").cast("long").alias("n")), "words")
    best = near_words(words, block).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    chosen = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("best.less") >= 2 * F.col("n"), F.col("best")).alias("best"))
    return roots(written(chosen.select(
        "word", F.col("best.near").alias("form"), "n", "n_near", (-F.col("best.less")).alias("form_n")), "chosen"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(vocabulary(table(spark, sf_dir, "documents")))
