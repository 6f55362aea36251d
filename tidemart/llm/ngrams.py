"""Interpolated modified Kneser-Ney bigram model, counted in Spark, memory-mapped by workers.

The model is a set of arrays in the shared folder, cut into parts by key range:

* words: 64-bit hashes of the training tokens in order, with their counts; a word's id is its place;
* bigrams: context id * (words + 1) + word id, in order, with their counts;
* per word id: how many kinds of word precede it, and how many words follow it once, twice, more.

Each part is written by the task that has gathered it, under a name of its own, and put in place by
a rename, so a task that runs again writes the same file. Workers map the files; where the folder is
not a local path they copy a file first and unlink the copy once it is mapped.

Counting is done in numpy on the bytes of the texts: a task sorts a few million tokens at a time and
sends each part its share as compressed arrays. Bigrams are dealt by where they fall in the order of
contexts weighted by the known word counts, so a very frequent context spreads over as many parts
as its share needs. Only one row per part reaches the driver. Three passes read the texts: words,
bigrams, scores.

Defined cases: null text is empty and scores its end alone; words not seen in training share one
unknown probability; without training texts every probability is 1; repeated rows count and are
scored each. More than 2**32 different words are refused with an error.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.common import chunks, in_batches, table
from tidemart.llm.language import remainder
from tidemart.session import shared_dir, written

START, END = np.uint64(1), np.uint64(2)
#: Tokens gathered by a task before it sorts and sends them.
GATHER = 1 << 22
#: Added to every count of the base score.
BASE_ADD = 0.1


# Arrays in the shared folder.

def _filesystem(root: str):
    from pyarrow import fs

    if root.startswith("file:/") and not root.startswith("file://"):
        root = "file://" + root[5:]
    return fs.FileSystem.from_uri(root) if "://" in root else (fs.LocalFileSystem(), root)


def put(root: str, name: str, values: np.ndarray) -> None:
    files, path = _filesystem(root)
    files.create_dir(path, recursive=True)
    draft = f"{path}/.{name}-{uuid.uuid4().hex}"
    with files.open_output_stream(draft) as out:
        out.write(np.ascontiguousarray(values).tobytes())
    files.move(draft, f"{path}/{name}")


_MAPPED: dict[str, np.ndarray] = {}


def mapped(root: str, name: str, kind) -> np.ndarray:
    """The array under that name, mapped once per worker."""
    from pyarrow import fs

    key = f"{root}/{name}"
    if key not in _MAPPED:
        files, path = _filesystem(root)
        place = f"{path}/{name}"
        if not files.get_file_info(place).size:
            _MAPPED[key] = np.zeros(0, kind)
        elif isinstance(files, fs.LocalFileSystem):
            _MAPPED[key] = np.memmap(place, kind, "r")
        else:
            handle, copy = tempfile.mkstemp()
            with files.open_input_stream(place) as source, os.fdopen(handle, "wb") as target:
                while block := source.read(1 << 24):
                    target.write(block)
            _MAPPED[key] = np.memmap(copy, kind, "r")
            os.unlink(copy)
    return _MAPPED[key]


def packed(values: np.ndarray) -> bytes:
    """Ascending 64-bit values: differences, byte plane by byte plane, deflated."""
    steps = np.diff(values, prepend=np.uint64(0)).astype("<u8")
    return zlib.compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


def _small(values: np.ndarray) -> bytes:
    return zlib.compress(np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), 1)


def _unsmall(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Different keys in order, and the sums of each value over equal keys."""
    if not len(keys):
        return (keys, *values)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return (keys[first], *(np.add.reduceat(v[order], first) for v in values))


# Tokens.

def token_pairs(texts: pa.Array):
    """(first text, number of texts, text of each token, token before it, token) chunk by chunk.

    Tokens are hashes; every text begins after START and ends in END, also across chunks.
    """
    held, before = None, START
    for (first, n, words), following in _ahead(chunks(texts, lower=True)):
        unfinished = following is not None and following[0] == first + n - 1
        hashes, own = words.hashes(), words.text
        count = np.bincount(own, minlength=n)
        ends = np.cumsum(count)[:n - unfinished]
        token = np.insert(hashes, ends, END)
        text = np.insert(own, ends, np.arange(len(ends)))
        previous = np.empty_like(token)
        previous[1:] = token[:-1]
        begin = np.searchsorted(text, np.arange(n))
        begin = begin[begin < len(token)]
        previous[begin] = START
        if len(token):
            if held == first:
                previous[0] = before
            before = token[-1]
        if not unfinished:
            held = None
        elif held != first or n > 1:
            held = first + n - 1
            before = token[-1] if len(token) and text[-1] == n - 1 else START
        yield first, n, text, previous, token


def _ahead(items):
    last = None
    for item in items:
        if last is not None:
            yield last, item
        last = item
    if last is not None:
        yield last, None


def _part_of_hash(keys: np.ndarray, parts: int) -> np.ndarray:
    return (((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)


def _by_part(part: np.ndarray, parts: int):
    """(part, slice) of an ascending array of part numbers."""
    cuts = np.searchsorted(part, np.arange(parts + 1))
    for p in np.flatnonzero(cuts[1:] > cuts[:-1]):
        yield int(p), slice(cuts[p], cuts[p + 1])


def _gathered(batches, tokens_of, parts: int, part_of):
    """Counts of what tokens_of gives, as (part, keys, counts) rows."""
    held, size = [], 0

    def send():
        keys, counts = np.unique(np.concatenate(held), return_counts=True)
        rows = [(p, packed(keys[s]), _small(counts[s])) for p, s in _by_part(part_of(keys), parts)]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary()),
             pa.array([r[2] for r in rows], pa.binary())], ["part", "keys", "counts"])

    for batch in batches:
        for _, _, _, previous, token in token_pairs(batch.column("_text")):
            held.append(tokens_of(previous, token))
            size += len(token)
            if size >= GATHER:
                yield send()
                held, size = [], 0
    if size:
        yield send()


_COUNTED = "part int, keys binary, counts binary"


class Model:
    """Where the arrays lie and the few numbers that describe them; small enough for a closure."""

    def __init__(self, root: str, parts: int):
        self.root, self.parts = root, parts
        self.first = np.zeros(parts + 1, np.int64)  # first id of each part of the words
        self.mass = np.zeros(parts + 1, np.int64)  # tokens before each part
        self.documents = 0
        self.codes: list[tuple[int, int]] = []  # (part, last code) of the bigram parts with rows
        self.start = (0, 0, 0)
        self.kinds = 0
        self.discount = self.word_discount = (0.5, 1.0, 1.5)
        self.word_kinds = (0, 0, 0)

    @property
    def words(self) -> int:
        return int(self.first[-1])

    @property
    def tokens(self) -> int:
        return int(self.mass[-1])

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Ids of ascending hashes; -1 for words not in the model."""
        out = np.full(len(hashes), -1, np.int64)
        for p, s in _by_part(_part_of_hash(hashes, self.parts), self.parts):
            keys = mapped(self.root, f"words-{p}", np.uint64) if self.first[p + 1] > self.first[p] else ()
            if len(keys):
                at = np.minimum(np.searchsorted(keys, hashes[s]), len(keys) - 1)
                out[s] = np.where(keys[at] == hashes[s], self.first[p] + at, -1)
        return out

    def take(self, name: str, kind, ids: np.ndarray) -> np.ndarray:
        """Values of ascending ids (each from 0 to words - 1)."""
        out = np.zeros(len(ids), kind)
        part = np.searchsorted(self.first, ids, "right") - 1
        for p, s in _by_part(part, self.parts):
            out[s] = mapped(self.root, f"{name}-{p}", kind)[ids[s] - self.first[p]]
        return out

    def bigram_counts(self, codes: np.ndarray) -> np.ndarray:
        """Counts of ascending codes; 0 for bigrams not in the model."""
        out = np.zeros(len(codes), np.int64)
        lasts = np.array([c for _, c in self.codes], np.uint64)
        for k, s in _by_part(np.searchsorted(lasts, codes), len(lasts)):
            p = self.codes[k][0]
            keys = mapped(self.root, f"bigrams-{p}", np.uint64)
            at = np.minimum(np.searchsorted(keys, codes[s]), len(keys) - 1)
            out[s] = np.where(keys[at] == codes[s], mapped(self.root, f"bigram-counts-{p}", np.uint32)[at], 0)
        return out


def _discounts(n: np.ndarray) -> tuple[float, float, float]:
    """Chen and Goodman's discounts from the numbers of things seen 1, 2, 3 and 4 times."""
    if n[0] <= 0 or n[1] <= 0:
        return 0.5, 0.75, 0.75
    y = n[0] / (n[0] + 2 * n[1])
    found = [1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2] if n[2] else 1.5]
    return tuple(float(min(max(d, 0.05), k + 0.95)) for k, d in enumerate(found))


def _words_part(root: str):
    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        keys, counts = summed(
            np.concatenate([unpacked(b) for b in rows["keys"]]),
            np.concatenate([_unsmall(b) for b in rows["counts"]]).astype(np.int64))
        part = int(key[0])
        put(root, f"words-{part}", keys)
        put(root, f"counts-{part}", counts)
        put(root, f"before-{part}", np.cumsum(counts) - counts)
        return pd.DataFrame({"part": [part], "words": [len(keys)], "tokens": [int(counts.sum())]})

    return run


def _bigram_part(model: Model):
    base = np.uint64(model.words + 1)

    def sent(rows, kind, ids, *values):
        """Statistics per id, one row for each part of the words; START has a part of its own."""
        part = np.searchsorted(model.first, ids, "right") - 1
        part[ids >= model.words] = model.parts
        for p, s in _by_part(part, model.parts + 1):
            rows.append((kind, p, packed(ids[s].astype(np.uint64)),
                         *(_small(v[s]) for v in values), *[None] * (3 - len(values)), 0, None))

    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        codes, counts = summed(
            np.concatenate([unpacked(b) for b in rows["keys"]]),
            np.concatenate([_unsmall(b) for b in rows["counts"]]).astype(np.int64))
        part = int(key[0])
        put(model.root, f"bigrams-{part}", codes)
        put(model.root, f"bigram-counts-{part}", counts.astype(np.uint32))
        seen = [int((counts == k).sum()) for k in (1, 2, 3, 4)] + [len(codes)]
        out = [(0, part, None, None, None, None, int(codes[-1].astype(np.int64)), seen)]
        sent(out, 1, *summed((codes // base).astype(np.int64), *(
            c.astype(np.int64) for c in (counts == 1, counts == 2, counts > 2))))
        sent(out, 2, *summed((codes % base).astype(np.int64), np.ones(len(codes), np.int64)))
        return pd.DataFrame(out, columns=["kind", "part", "ids", "a", "b", "c", "last", "seen"])

    return run


_STATS = "kind int, part int, ids binary, a binary, b binary, c binary, last long, seen array<long>"


def _stats_part(model: Model):
    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        part = int(key[0])
        first = int(model.first[part]) if part < model.parts else model.words
        size = int(model.first[part + 1]) - first if part < model.parts else 1
        after = [np.zeros(size, np.int64) for _ in range(3)]
        kinds = np.zeros(size, np.int64)
        for r in rows.itertuples():
            at = unpacked(r.ids).astype(np.int64) - first
            if r.kind == 1:
                for values, data in zip(after, (r.a, r.b, r.c)):
                    values[at] += _unsmall(data)
            else:
                kinds[at] += _unsmall(r.a)
        if part < model.parts:
            for name, values in zip(("once", "twice", "more", "kinds"), (*after, kinds)):
                put(model.root, f"{name}-{part}", values.astype(np.uint32))
        seen = [int((kinds == k).sum()) for k in (1, 2, 3, 4)] + [int((kinds > 2).sum())]
        return pd.DataFrame([(part, [int(v.sum()) for v in after], seen)], columns=["part", "after", "seen"])

    return run


def train(docs: DataFrame, text_col: str = "text") -> Model:
    """Count the texts and write the model's arrays to the shared folder."""
    spark = docs.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    model = Model(shared_dir(spark, "ngrams"), parts)
    texts = docs.select(F.col(text_col).cast("string").alias("_text"))

    def words(batches):
        yield from _gathered(batches, lambda _, t: t, parts, lambda k: _part_of_hash(k, parts))

    found = in_batches(texts).mapInArrow(words, _COUNTED).groupBy("part").applyInPandas(
        _words_part(model.root), "part int, words long, tokens long").collect()
    sizes, mass = np.zeros(parts, np.int64), np.zeros(parts, np.int64)
    for r in found:
        sizes[r["part"]], mass[r["part"]] = r["words"], r["tokens"]
    model.first[1:], model.mass[1:] = np.cumsum(sizes), np.cumsum(mass)
    if model.words >= 1 << 32:
        raise ValueError("more than 2**32 different words")
    if not model.words:
        return model
    model.documents = texts.count()

    def bigrams(batches):
        base = np.uint64(model.words + 1)

        def codes(previous, token):
            both, back = np.unique(np.concatenate((previous, token)), return_inverse=True)
            ids = model.ids(both)
            ids[both == START] = model.words
            ids = ids[back].astype(np.uint64)
            return ids[:len(token)] * base + ids[len(token):]

        def share(ids):
            """Tokens before each id and of it; START comes after all words."""
            some, back = np.unique(np.minimum(ids, model.words - 1), return_inverse=True)
            part = np.searchsorted(model.first, some, "right") - 1
            before = (model.take("before", np.int64, some) + model.mass[part])[back]
            count = model.take("counts", np.int64, some)[back]
            starts = ids >= model.words
            return np.where(starts, model.tokens, before), np.where(starts, model.documents, count)

        def part_of(keys):
            """Ascends with the key; a context gets the room of its tokens."""
            before, count = share((keys // base).astype(np.int64))
            inner, _ = share((keys % base).astype(np.int64))
            place = (before + count * (inner / model.tokens)) / (model.tokens + model.documents)
            return np.minimum((place * parts).astype(np.int64), parts - 1)

        yield from _gathered(batches, codes, parts, part_of)

    stats = written(texts.mapInArrow(bigrams, _COUNTED).groupBy("part").applyInPandas(
        _bigram_part(model), _STATS), "ngram-stats")
    rows = stats.where("kind = 0").select("part", "last", "seen").collect()
    model.codes = sorted(((r["part"], r["last"] % (1 << 64)) for r in rows), key=lambda x: x[1])
    seen = np.array([r["seen"] for r in rows]).sum(0)
    model.discount, model.kinds = _discounts(seen[:4]), int(seen[4])
    rows = stats.where("kind > 0").groupBy("part").applyInPandas(
        _stats_part(model), "part int, after array<long>, seen array<long>").collect()
    seen = np.zeros(5, np.int64)
    for r in rows:
        if r["part"] == parts:
            model.start = tuple(r["after"])
        else:
            seen += np.array(r["seen"])
    model.word_discount = _discounts(seen[:4])
    model.word_kinds = (int(seen[0]), int(seen[1]), int(seen[4]))
    return model


def _cut(counts: np.ndarray, discount: tuple[float, float, float]) -> np.ndarray:
    return np.maximum(counts - np.array((0.0, *discount))[np.minimum(counts, 3)], 0.0)


def _token_scores(model: Model, previous: np.ndarray, token: np.ndarray):
    """(known, base score, model score) of each token."""
    both, back = np.unique(np.concatenate((previous, token)), return_inverse=True)
    ids = model.ids(both)
    seen = ids >= 0
    order = ids[seen]  # ids ascend with the hashes
    count = np.zeros(len(both), np.int64)
    lower = np.zeros(len(both))
    weight = np.ones(len(both))  # of the lower order after this context
    total = np.zeros(len(both), np.int64)
    spread = sum(d * n for d, n in zip(model.word_discount, model.word_kinds))
    uniform = (spread / model.kinds if model.kinds else 1.0) / (model.words + 1)
    if len(order):
        count[seen] = model.take("counts", np.int64, order)
        lower[seen] = _cut(model.take("kinds", np.uint32, order).astype(np.int64), model.word_discount) / model.kinds
        after = [model.take(n, np.uint32, order).astype(np.int64) for n in ("once", "twice", "more")]
        total[seen] = np.where(sum(after) > 0, count[seen], 0)
        weight[seen] = np.where(
            total[seen] > 0, sum(d * n for d, n in zip(model.discount, after)) / np.maximum(count[seen], 1), 1.0)
    lower += uniform
    start = both == START
    if start.any() and model.documents:
        total[start] = model.documents
        weight[start] = sum(d * n for d, n in zip(model.discount, model.start)) / model.documents
        ids[start] = model.words
    before, now = back[:len(token)], back[len(token):]
    pair = np.zeros(len(token), np.int64)
    known = (ids[before] >= 0) & (ids[now] >= 0)
    if known.any():
        codes, at = np.unique(
            ids[before][known].astype(np.uint64) * np.uint64(model.words + 1) + ids[now][known].astype(np.uint64),
            return_inverse=True)
        pair[known] = model.bigram_counts(codes)[at]
    higher = _cut(pair, model.discount) / np.maximum(total[before], 1)
    score = np.log10(higher + weight[before] * lower[now])
    base = np.log10((count + BASE_ADD) / (model.tokens + BASE_ADD * (model.words + 1)))
    return count[now] > 0, base[now], score


def score(docs: DataFrame, model: Model, keep: dict[str, Column], text_col: str = "text") -> DataFrame:
    """The columns in `keep` and n_tokens, n_known, train_tokens, base_score, score, perplexity."""
    rows = docs.select(*[c.alias(n) for n, c in keep.items()], F.col(text_col).cast("string").alias("_text"))
    kept = ", ".join(f"{n} {t}" for n, t in rows.dtypes if n != "_text")
    names = [n for n in rows.columns if n != "_text"]

    def run(batches):
        for batch in batches:
            size = batch.num_rows
            tokens, known = np.zeros(size, np.int64), np.zeros(size, np.int64)
            base, own = np.zeros(size), np.zeros(size)
            for first, n, text, previous, token in token_pairs(batch.column("_text")):
                has, b, s = _token_scores(model, previous, token)
                here = slice(first, first + n)
                tokens[here] += np.bincount(text, minlength=n)
                known[here] += np.bincount(text, has, n).astype(np.int64)
                base[here] += np.bincount(text, b, n)
                own[here] += np.bincount(text, s, n)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(tokens), pa.array(known),
                 pa.array(np.full(size, model.tokens, np.int64)), pa.array(base), pa.array(own),
                 pa.array(10.0 ** (-own / np.maximum(tokens, 1)))],
                [*names, "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"])

    return in_batches(rows).mapInArrow(
        run, f"{kept}, n_tokens long, n_known long, train_tokens long, base_score double, score double,"
        " perplexity double")


def op9_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(remainder("doc_id", 10) == 0, F.lit(False))
    model = train(docs.where(~held_out))
    return score(docs, model, {"doc_id": F.col("doc_id"), "held_out": held_out})
