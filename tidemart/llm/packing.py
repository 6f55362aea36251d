"""Packing token sequences by Karmarkar-Karp multiway differencing.

Each task tokenizes its own texts and packs them as they come, so nothing is shuffled. Whole
windows are cut from long documents. What is left goes to pools of GROUP windows: the pieces
of a pool start as partial partitions with one loaded window each; the two with the largest spread
are merged again and again, the fullest windows of one onto the emptiest of the other, until one
partition is left, whose windows are nearly equal. If a window exceeds the capacity, the pool is
partitioned anew into one window more. The last document of a pool is cut so that the pool's total
comes to the wanted fill.

Words are tokenized once and remembered per worker: this tokenizer never joins characters across
white space, so the ids of a text are the ids of its words in a row (tests compare the two).

Defined cases: null and empty texts give the end id alone; texts of any length are read in chunks;
repeated rows are packed each; an empty table gives no rows. Sequence ids are (partition, number).
"""

from __future__ import annotations

import heapq
import os
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.common import chunks, in_batches, lean, table

CAPACITY = 4096
#: Windows per pool, and the part of them that a pool fills.
GROUP, FILL = 256, 0.998
END = 2
#: Words remembered per worker before starting over.
REMEMBERED = 1 << 19
#: Words handed to the tokenizer at once; its results take a kilobyte each.
AT_ONCE = 4096
#: Words of printable ASCII and Western letters, without an apostrophe, and their runs in lower case.
PLAIN = re.compile("[!-&(-~À-ÖØ-öø-ÿ]+")
RUNS = re.compile("[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")


class WordIds:
    """Token ids of words, remembered under their 64-bit hashes in sorted arrays."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their names in a text are ordinary text
        self.model = Tokenizer(self.tokenizer.model)
        self.model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        named = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.names = {c: named.pre_tokenize_str(c)[0][0] for c in map(chr, range(0xDF, 0x100))}
        # The model marks the last token of every run.
        vocabulary, mark = self.tokenizer.get_vocab(), self.tokenizer.model.end_of_word_suffix
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        if mark:
            self.closes[[i for token, i in vocabulary.items() if token.endswith(mark)]] = True
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.begin = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int64)
        self.pool = np.zeros(1 << 16, np.uint32)
        self.used = 0

    def _plain(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids in a row, ids per word) of PLAIN words. They skip the normalizer: lower-cased, cut
        into letters, single digits and the rest, their bytes named, they go to the same model."""
        cut = [RUNS.findall(w) for w in " ".join(words).lower().split(" ")]
        runs = [r for one in cut for r in one]
        text = " ".join(runs)
        for c in set(text).intersection(self.names):
            text = text.replace(c, self.names[c])
        made, = self.model.encode_batch_fast([text], add_special_tokens=False)
        ids = np.array(made.ids, np.uint32)
        ends = np.flatnonzero(self.closes[ids]) + 1
        if len(ends) != len(runs):  # a run whose end the model does not tell
            return self._each(words)
        upto = ends[np.cumsum([len(one) for one in cut]) - 1]
        return ids, np.diff(upto, prepend=0)

    def _each(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        made = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        length = np.fromiter(map(len, made), np.int64, len(made))
        return np.fromiter((i for ids in made for i in ids), np.uint32, int(length.sum())), length

    def _learn(self, keys: np.ndarray, words: list[str]) -> None:
        plain = np.fromiter((PLAIN.fullmatch(w) is not None for w in words), bool, len(words))
        begin, length = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        for places, encoded in ((np.flatnonzero(plain), self._plain), (np.flatnonzero(~plain), self._each)):
            for i in range(0, len(places), AT_ONCE):
                some = places[i:i + AT_ONCE]
                flat, length[some] = encoded([words[k] for k in some])
                if self.used + len(flat) > len(self.pool):
                    self.pool = np.concatenate((self.pool, np.zeros(len(self.pool) + len(flat), np.uint32)))
                self.pool[self.used:self.used + len(flat)] = flat
                begin[some] = self.used + np.cumsum(length[some]) - length[some]
                self.used += len(flat)
        at = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, at, keys)
        self.begin = np.insert(self.begin, at, begin)
        self.length = np.insert(self.length, at, length)

    def encode(self, words) -> tuple[np.ndarray, np.ndarray]:
        """(ids in a row, number of ids per word) of one chunk's words."""
        keys, first, back = np.unique(words.hashes(), return_index=True, return_inverse=True)
        if len(self.keys) > REMEMBERED:
            self.clear()
        at = np.minimum(np.searchsorted(self.keys, keys), max(0, len(self.keys) - 1))
        new = np.flatnonzero(self.keys[at] != keys) if len(self.keys) else np.arange(len(keys))
        if len(new):
            data = words.data.tobytes()
            i = first[new]
            self._learn(keys[new], [
                data[a:b].decode("utf-8", "replace")
                for a, b in zip(words.starts[i].tolist(), words.ends[i].tolist())])
            at = np.searchsorted(self.keys, keys)
        begin, length = self.begin[at][back], self.length[at][back]
        upto = np.cumsum(length)
        if not len(upto):
            return np.zeros(0, np.uint32), length
        index = np.arange(upto[-1]) + np.repeat(begin - (upto - length), length)
        return self.pool[index], length


_KNOWN: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """The worker's own table of words, kept from task to task."""
    if path not in _KNOWN:
        _KNOWN[path] = WordIds(path)
    return _KNOWN[path]


def tokenized(texts: pa.Array, words: WordIds, end: int = END):
    """(place in the column, ids with the end id) for every text, in order."""
    held: list[np.ndarray] = []
    last = 0
    for first, n, found in chunks(texts):
        ids, length = words.encode(found)
        if first > last:  # the text before is complete
            yield last, np.concatenate([*held, np.array([end], np.uint32)])
            held, last = [], first
        upto = np.concatenate(([0], np.cumsum(length)))
        cuts = upto[np.searchsorted(found.text, np.arange(n + 1))]
        for i in range(n - 1):
            yield first + i, np.concatenate([*held, ids[cuts[i]:cuts[i + 1]], np.array([end], np.uint32)])
            held = []
        held.append(ids[cuts[n - 1]:cuts[n]])
        last = first + n - 1
    if len(texts):
        yield last, np.concatenate([*held, np.array([end], np.uint32)])


def differenced(sizes: list[int], windows: int) -> np.ndarray:
    """The window of each item by multiway differencing."""
    heap, merges = [], []
    for i, size in enumerate(sizes):
        loads = np.zeros(windows, np.int64)
        loads[-1] = size
        heap.append((-size, i, loads))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, i, a = heapq.heappop(heap)
        _, j, b = heapq.heappop(heap)
        loads = a + b[::-1]
        order = np.argsort(loads, kind="stable")
        loads = loads[order]
        heapq.heappush(heap, (int(loads[0] - loads[-1]), len(sizes) + len(merges), loads - loads[0]))
        merges.append((i, j, order))
    # Back from the last partition: each slot's window goes to the slots it was merged from.
    slots = {len(sizes) + len(merges) - 1: np.arange(windows)}
    for k in range(len(merges) - 1, -1, -1):
        i, j, order = merges[k]
        own = slots.pop(len(sizes) + k)
        for child, place in ((i, order), (j, windows - 1 - order)):
            if child < len(sizes):
                slots[child] = own[place == windows - 1][0]
            else:
                slots[child] = np.empty(windows, np.int64)
                slots[child][place] = own
    if len(sizes) == 1:
        return np.zeros(1, np.int64)
    return np.array([slots[i] for i in range(len(sizes))], np.int64)


def windows_of(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """The fewest windows that differencing fills within the capacity; every item must fit."""
    windows = max(1, -(-sum(sizes) // capacity))
    while True:
        dealt = differenced(sizes, windows)
        if np.bincount(dealt, sizes).max() <= capacity:
            order = np.argsort(dealt, kind="stable")
            return [w.tolist() for w in np.split(order, np.flatnonzero(np.diff(dealt[order])) + 1)]
        windows += 1


class Packer:
    """Takes documents, gives (sequence, offset, document, start, ids, document's ids)."""

    def __init__(self, base: int, capacity: int, group: int, fill: float):
        self.sequence, self.capacity = base, capacity
        self.want = int(capacity * group * fill)
        self.pool: list[tuple] = []
        self.held = 0

    def _close(self):
        for window in windows_of([len(p[2]) for p in self.pool], self.capacity):
            offset = 0
            for i in sorted(window):
                doc, start, ids, total = self.pool[i]
                yield self.sequence, offset, doc, start, ids, total
                offset += len(ids)
            self.sequence += 1
        self.pool, self.held = [], 0

    def add(self, doc, ids: np.ndarray):
        start, total = 0, len(ids)
        while total - start >= self.capacity:
            yield self.sequence, 0, doc, start, ids[start:start + self.capacity], total
            self.sequence += 1
            start += self.capacity
        while start < total:
            cut = min(total, start + self.want - self.held)
            self.pool.append((doc, start, ids[start:cut], total))
            self.held += cut - start
            start = cut
            if self.held == self.want:
                yield from self._close()

    def close(self):
        """The last pool; its rest below a whole window is cut into powers of two, unpadded."""
        rest = self.held % self.capacity
        tail = []
        while self.pool and rest:
            doc, start, ids, total = self.pool.pop()
            cut = max(0, len(ids) - rest)
            tail.append((doc, start + cut, ids[cut:], total))
            rest -= len(ids) - cut
            if cut:
                self.pool.append((doc, start, ids[:cut], total))
        if self.pool:
            yield from self._close()
        left = sum(len(t[2]) for t in tail)
        room, offset = 0, 0
        for doc, start, ids, total in reversed(tail):
            at = 0
            while at < len(ids):
                if not room:
                    room, offset = 1 << (left.bit_length() - 1), 0
                    self.sequence += 1
                take = min(room, len(ids) - at)
                yield self.sequence - 1, offset, doc, start + at, ids[at:at + take], total
                at, room, offset, left = at + take, room - take, offset + take, left - take


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = CAPACITY, group: int = GROUP, fill: float = FILL) -> DataFrame:
    """Per piece: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens,
    sequence_id, offset. tokenizer: path of the vocabulary file on every executor."""
    names = ["sequence_id", "offset", "doc_id", "start", "ids", "doc_tokens"]
    kind = docs.schema[id_col].dataType

    def run(batches):
        words = word_ids(tokenizer)
        packer = Packer(TaskContext.get().partitionId() << 32, capacity, group, fill)
        schema = None

        def batch(rows):
            columns = list(zip(*rows)) or [[]] * 6
            columns[4] = [np.ascontiguousarray(i, "<u4").tobytes() for i in columns[4]]
            types = [pa.int64(), pa.int64(), schema, pa.int64(), pa.binary(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

        for b in batches:
            schema = b.column("doc_id").type
            ids = b.column("doc_id").to_pylist()
            rows = []
            for at, tokens in tokenized(b.column("text"), words):
                rows.extend(packer.add(ids[at], tokens))
            if rows:
                yield batch(rows)
        rows = list(packer.close())
        if rows:
            yield batch(rows)

    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = in_batches(texts).mapInArrow(
        lean(run), f"sequence_id long, offset long, doc_id {kind.simpleString()}, start long, ids binary, doc_tokens long")
    return out.select(
        "doc_id", "start", F.floor(F.octet_length("ids") / 4).alias("length"), "ids", "doc_tokens",
        "sequence_id", "offset")


def op3_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
