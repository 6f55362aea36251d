"""Substring dedup: suffix trees over groups of suffixes that share a prefix.

A suffix is a text from one of its words on; two suffixes with the same first WINDOW words meet in
an internal node of the suffix tree at that depth, and the smallest document below the node keeps
its copy. The tree is never built whole. Every window has an anchor, the leftmost smallest hash
among its stretches of PREFIX words, which is the same one in each of its occurrences, so suffixes
are dealt by the stretch at their window's anchor. Neighbouring suffixes mostly have one anchor and
travel as one stretch of text.

1. Equal texts: all but the one of the smallest document are repeats from end to end; only that one
   takes part below.
2. Anchors of all texts are counted. A prefix that no two documents share ends in leaves, its
   suffixes cannot repeat and are left out.
3. Suffixes of a prefix that few share (GROUP) go to a task with their words, which builds the
   subtree: ranks of suffixes by doubling, common prefix lengths of neighbours, and the nodes of
   depth WINDOW or more. Where more share a prefix, it is lengthened to the whole WINDOW, which is
   the node itself: 128-bit hashes of those windows are aggregated to their smallest document.
4. Windows whose node has a smaller document become spans, collected per document.

Words are compared as they are inside a subtree; hashes decide only equal texts (MD5), which
prefixes are worth a look, and windows of prefixes that more than GROUP stretches share (128 bits
over 64-bit values of their words).

Defined cases: null texts have no words; rows with a null id take part in nothing and keep their
words; rows of one id never remove each other's words, as neither document is smaller; repeated
rows each get the same result; texts of any length are read whole; an empty table gives no rows.
Ids are whole numbers. Columns other than the two named are not read, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.common import _mix, chunks, in_batches, lean, table
from tidemart.session import written

WINDOW = 50
PREFIX = 10
#: Most stretches of text under one prefix that a subtree is built for.
GROUP = 2_000
#: Words of whole groups put into one tree at once.
TREE_WORDS = 1 << 18
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _word_hashes(texts: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(row, 64-bit values of the words) of every text, whole."""
    at, parts = 0, []
    for first, n, words in chunks(texts):
        values = words.hashes()
        cuts = np.searchsorted(words.text, np.arange(n + 1))
        for i in range(n):
            if first + i != at:
                yield at, np.concatenate(parts)
                at, parts = first + i, []
            parts.append(values[cuts[i]:cuts[i + 1]])
    if parts:
        yield at, np.concatenate(parts)


def _stretches(values: np.ndarray, size: int) -> np.ndarray:
    """A value for every run of `size` words."""
    n = len(values) - size + 1
    out = np.zeros(max(n, 0), np.uint64)
    for j in range(size if n > 0 else 0):
        out = out * _BASE + values[j:j + n]
    return _mix(out)


def _anchors(values: np.ndarray, window: int, prefix: int) -> tuple[np.ndarray, np.ndarray]:
    """Value at, and place of, the anchor of every window."""
    if len(values) < window:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    keys = _stretches(values, prefix)
    width = window - prefix + 1
    places = np.empty(len(values) - window + 1, np.int64)
    for i in range(0, len(places), 1 << 16):  # bounded views
        part = np.lib.stride_tricks.sliding_window_view(keys[i:i + (1 << 16) + width - 1], width)
        places[i:i + len(part)] = part.argmin(1) + np.arange(i, i + len(part))
    return keys[places], places


def _keys_of(window: int, prefix: int):
    """Per text its anchors' prefixes, and at how many places each stands."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            keys, times, sizes = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [0]
            for _, values in _word_hashes(part.column("text")):
                found, places = _anchors(values, window, prefix)
                first = np.append(True, places[1:] != places[:-1])[:len(places)]
                key, count = np.unique(found[first], return_counts=True)
                keys.append(key)
                times.append(count)
                sizes.append(len(key))
            pairs = pa.StructArray.from_arrays(
                [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(times), pa.int64())],
                ["key", "times"])
            yield pa.RecordBatch.from_pydict({
                "doc_id": part.column("doc_id"), "digest": part.column("digest"),
                "keys": pa.ListArray.from_arrays(pa.array(np.cumsum(sizes), pa.int32()), pairs)})

    return lean(run)


def _window_hashes(values: np.ndarray, window: int) -> list[np.ndarray]:
    """Two independent 64-bit values of every window, by doubling."""
    out = []
    for seed in (1, 2):
        level, size = _mix(values + np.uint64(seed)), 1
        while 2 * size <= window:
            level = _mix(level[:len(level) - size] * _BASE + level[size:])
            size *= 2
        rest = window - size
        last = level[:len(level) - rest] * _BASE + level[rest:] if rest else level
        out.append(_mix(last + np.uint64(seed)).view(np.int64))
    return out


_SUFFIXES = ("key long, doc_id long, digest binary, start int, starts int, words binary, a long, b long, "
             "places array<int>")


def _suffixes(window: int, prefix: int):
    """Stretches of suffixes of shared prefixes with their words; windows of frequent ones hashed."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if not part.num_rows:
                continue
            shared = part.column("shared").to_pylist()
            texts = part.column("text").fill_null("")
            out: dict[str, list] = {k: [] for k in ("row", "key", "start", "starts", "words", "a", "b", "places")}

            def add(row, key, start, starts, words, a, b, places):
                for name, values in zip(out, (np.full(len(key), row), key, start, starts, words, a, b, places)):
                    out[name].append(values)

            for row, values in _word_hashes(texts):
                keys, places = _anchors(values, window, prefix)
                wanted = np.array([s["key"] for s in shared[row]], np.int64).view(np.uint64)
                often = np.array([s["often"] for s in shared[row]], bool)
                order = np.argsort(wanted)
                wanted, often = wanted[order], often[order]
                found = np.minimum(np.searchsorted(wanted, keys), len(wanted) - 1)
                has = wanted[found] == keys
                many = has & often[found]
                if many.any():
                    at = np.flatnonzero(many)
                    a, b = (h[at] for h in _window_hashes(values, window))
                    order = np.lexsort((b, a))  # a text that repeats a window sends it once
                    at, a, b = at[order], a[order], b[order]
                    new = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
                    add(row, keys[at[new]].view(np.int64), at[new], np.ones(len(new), np.int64), [None] * len(new),
                        a[new], b[new], np.split(at, new[1:]))
                few = has & ~many
                new = few.copy()
                new[1:] &= ~few[:-1] | (places[1:] != places[:-1])
                at = np.flatnonzero(new)
                if len(at):
                    ends = np.append(at[1:], len(few))
                    passed = np.cumsum(few)
                    count = passed[ends - 1] - passed[at] + 1
                    words = texts[row].as_py().encode().split()
                    add(row, keys[at].view(np.int64), at, count,
                        [b" ".join(words[i:i + n + window - 1]) for i, n in zip(at.tolist(), count.tolist())],
                        np.zeros(len(at), np.int64), np.zeros(len(at), np.int64), [at[:0]] * len(at))
            if not out["row"]:
                continue
            rows = pa.array(np.concatenate(out["row"]).astype(np.int64))
            yield pa.RecordBatch.from_pydict({
                "key": np.concatenate(out["key"]), "doc_id": part.column("doc_id").take(rows),
                "digest": part.column("digest").take(rows),
                "start": np.concatenate(out["start"]).astype(np.int32),
                "starts": np.concatenate(out["starts"]).astype(np.int32),
                "words": pa.array([w for ws in out["words"] for w in ws], pa.binary()),
                "a": np.concatenate(out["a"]), "b": np.concatenate(out["b"]),
                "places": pa.array([p.tolist() for ps in out["places"] for p in ps], pa.list_(pa.int32()))})

    return lean(run)


class Subtree:
    """Suffix tree of stretches of words, as sorted suffixes and common prefix lengths."""

    def __init__(self, stretches: list[bytes], window: int):
        tokens = b" ".join(stretches).split()
        codes = pd.factorize(np.array(tokens, object))[0].astype(np.int64)
        self.window, self.ranks, self.top = window, [codes], 1
        while 2 * self.top <= window:  # ranks of the first 1, 2, 4, ... words
            rank = self.ranks[-1]
            pair = rank * (len(codes) + 1)
            pair[:len(codes) - self.top] += rank[self.top:] + 1
            self.ranks.append(np.unique(pair, return_inverse=True)[1].astype(np.int64))
            self.top *= 2

    def deep_nodes(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffixes in tree order, and where nodes of depth `window` or more begin among them.

        Every suffix has `window` words within its stretch.
        """
        rank = self.ranks[-1]
        order = starts[np.lexsort((rank[starts + self.window - self.top], rank[starts]))]
        common = np.zeros(max(len(order) - 1, 0), np.int64)
        for level in range(len(self.ranks) - 1, -1, -1):  # lengths below 2 top: each level once at most
            step, rank = 1 << level, self.ranks[level]
            fits = common + step <= self.window
            i, j = np.where(fits, order[:-1] + common, 0), np.where(fits, order[1:] + common, 0)
            common += (fits & (rank[i] == rank[j])) * step
        return order, np.flatnonzero(np.append(len(order) > 0, common < self.window))


_SPANS = "doc_id long, digest binary, first int, last int"


def _trees(window: int):
    """Windows with a smaller document, of groups that come sorted by key: first and last start."""

    def spans(rows: list[tuple]) -> pa.RecordBatch:
        tree = Subtree([r[3] for r in rows], window)
        count = np.array([r[2] for r in rows])
        lengths = count + window - 1
        begin = np.cumsum(lengths) - lengths
        which = np.repeat(np.arange(len(rows)), count)
        within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        order, nodes = tree.deep_nodes(begin[which] + within)
        docs = np.array([r[0][0] for r in rows], np.int64)
        owner = np.empty(lengths.sum(), np.int64)
        owner[begin[which] + within] = docs[which]
        least = np.minimum.reduceat(owner[order], nodes)
        smaller = np.empty(lengths.sum(), bool)
        smaller[order] = np.repeat(least, np.diff(np.append(nodes, len(order)))) < owner[order]
        hit = smaller[begin[which] + within]
        # runs of starts within a stretch
        first = hit & ~np.append(False, hit[:-1] & (which[1:] == which[:-1]))
        last = hit & ~np.append(hit[1:] & (which[1:] == which[:-1]), False)
        start = np.array([r[1] for r in rows])
        rows_of, from_, to = which[first], (start[which] + within)[first], (start[which] + within)[last]
        return pa.RecordBatch.from_pydict({
            "doc_id": docs[rows_of], "digest": pa.array([rows[i][0][1] for i in rows_of.tolist()], pa.binary()),
            "first": from_.astype(np.int32), "last": to.astype(np.int32)})

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ready, group, words = None, [], [], 0
        for part in parts:
            for k, doc, digest, start, starts, text in zip(*(c.to_pylist() for c in part.columns)):
                if k != key:
                    if words > TREE_WORDS:
                        yield spans(ready + group)
                        ready, group, words = [], [], 0
                    ready += group
                    key, group = k, []
                group.append(((doc, digest), start, starts, text))
                words += starts + window - 1
        if ready or group:
            yield spans(ready + group)

    return lean(run)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"),
                       F.unhex(F.md5(text.cast("binary"))).alias("digest"))


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   prefix: int = PREFIX, group: int = GROUP) -> DataFrame:
    """doc_id, digest of the text, copy, spans: what repeats a smaller document.

    A copy repeats the whole text. Spans are (first, last) starts of windows, so they cover the
    words first to last + window - 1. Documents without repeats have no row.
    """
    keyed = _keyed(docs, id_col, text_col).where("doc_id is not null")
    texts = written(keyed.groupBy("digest").agg(F.min("doc_id").alias("least")), "texts")
    copies = keyed.select("doc_id", "digest").join(texts, "digest").where("doc_id > least").select(
        "doc_id", "digest").distinct()
    anchors = in_batches(keyed).mapInArrow(
        _keys_of(window, prefix), "doc_id long, digest binary, keys array<struct<key:long,times:long>>")
    anchors = written(anchors.join(texts, "digest").where("doc_id = least").select(
        "doc_id", "digest", F.inline("keys")), "anchors")
    shared = anchors.groupBy("key").agg(
        F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.sum("times").alias("n")
    ).where("low < high").select("key", (F.col("n") > group).alias("often"))
    asked = anchors.join(shared, "key").groupBy("doc_id", "digest").agg(
        F.collect_set(F.struct("key", "often")).alias("shared"))  # at most a key per word of the text
    suffixes = written(in_batches(keyed.join(asked, ["doc_id", "digest"]).select(
        "doc_id", "digest", "text", "shared")).mapInArrow(_suffixes(window, prefix), _SUFFIXES), "suffixes")
    few = suffixes.where("words is not null").select("key", "doc_id", "digest", "start", "starts", "words")
    found = few.repartition("key").sortWithinPartitions("key").mapInArrow(_trees(window), _SPANS)
    often = suffixes.where("words is null").select("doc_id", "digest", "places", "a", "b")
    least = often.groupBy("a", "b").agg(F.min("doc_id").alias("least"))
    hashed = often.join(least, ["a", "b"]).where("doc_id > least").select("doc_id", "digest", F.transform(
        "places", lambda p: F.struct(p.alias("first"), p.alias("last"))).alias("spans"))
    spans = found.select("doc_id", "digest", F.array(F.struct("first", "last")).alias("spans")).union(hashed).groupBy(
        "doc_id", "digest").agg(F.flatten(F.collect_list("spans")).alias("spans"))  # a span per word at most
    none = F.array().cast("array<struct<first:int,last:int>>")
    return spans.select("doc_id", "digest", F.lit(False).alias("copy"), "spans").union(
        copies.select("doc_id", "digest", F.lit(True), none))


def _cut(window: int, keep_text: bool):
    """Words counted, removed and kept, of rows with copy and spans."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            counts, removed, results = [], [], []
            for text, copy, spans in zip(part.column("text"), part.column("copy").to_pylist(),
                                         part.column("spans").to_pylist()):
                words = text.as_py().encode().split()
                counts.append(len(words))
                if copy and len(words) >= window:
                    kept = []
                elif spans:
                    edge = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edge, [s["first"] for s in spans], 1)
                    np.add.at(edge, [s["last"] + window for s in spans], -1)
                    kept = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]
                else:
                    kept = words
                removed.append(len(words) - len(kept))
                whole = b" ".join(kept)
                results.append(whole.decode() if keep_text else hashlib.sha256(whole).hexdigest())
            yield pa.RecordBatch.from_pydict({
                "doc_id": part.column("doc_id"), "n_words": pa.array(counts, pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                ("kept_text" if keep_text else "kept_sha256"): pa.array(results, pa.string())})

    return lean(run)


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                keep_text: bool = True, **options: int) -> DataFrame:
    """doc_id, n_words, n_removed and kept_text (or kept_sha256) of every row."""
    spans = repeated_spans(docs, id_col, text_col, window, **options)
    rows = _keyed(docs, id_col, text_col).join(spans, ["doc_id", "digest"], "left").select(
        "doc_id", "text", F.coalesce("copy", F.lit(False)).alias("copy"), "spans")
    last = "kept_text" if keep_text else "kept_sha256"
    return in_batches(rows).mapInArrow(
        _cut(window, keep_text), f"doc_id long, n_words long, n_removed long, {last} string")


def op13_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate(table(spark, sf_dir, "documents"), keep_text=False)
