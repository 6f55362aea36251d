"""SimHash near-duplicates found with pivot distance tables.

Fingerprints: a text's shingles are hashed (XXH64, seed 42); a bit of the fingerprint is 1 if more
than half of the hashes have it.

Pivots: four random reference fingerprints, and for each of them eight more in which one of the
eight bytes is complemented, 36 in all. The Hamming distances to them are the coordinates of a
fingerprint. Two fingerprints that differ in at most two bits differ by at most 2 in every
coordinate. They also agree in at least six of the eight bytes, and the difference between a
reference's distance and that of its complemented partner depends on one byte only, so these
differences agree there too. Candidates are therefore joined on equal coordinate differences with
two bytes left out, for each of the 28 ways to leave out two; pairs whose largest coordinate
difference exceeds the limit are discarded; the rest is verified bit by bit. Nothing is lost.

Equal fingerprints are merged before the join, so a group of copies counts once. Each link comes
from one key only, the first that holds it. Groups are connected components, found by taking the
least label among neighbours and jumping to the label's label until nothing changes.

Defined cases: null and empty texts have fingerprint zero and link like any other; fewer words than
a shingle make one shingle of all words; repeated rows are returned each; null ids never become a
component's id; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemart.llm.common import _mix, in_batches, lean, pieces, table
from tidemart.operators.relational import broadcast_if_small
from tidemart.session import written

SEED = 42
BLOCKS = 8
REFERENCES = 4
MAX_BITS = 2
#: Thinned fingerprints per text for `near_duplicates`, and shingles in each.
THINNED, THIN = 8, 2


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


#: Reference fingerprints, and their partners with one byte complemented.
PIVOTS = [int(x) for x in _mix(np.arange(1, REFERENCES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))]
PARTNERS = [[p ^ (0xFF << (8 * b)) for b in range(BLOCKS)] for p in PIVOTS]
LEFT_OUT = list(combinations(range(BLOCKS), 2))


def _hashed(words: list[bytes], k: int) -> np.ndarray:
    """XXH64 of every run of k words, joined by spaces."""
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    return np.array([
        digest(line[a:b], SEED) for a, b in zip(starts[:len(words) - k + 1].tolist(), ends[k - 1:].tolist())
    ], np.uint64)


def _majority(hashes: np.ndarray) -> int:
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return int(np.packbits(2 * bits.sum(0, dtype=np.int64) > len(hashes), bitorder="little").view(np.int64)[0])


def text_shingles(texts: pa.Array, k: int):
    """(place, shingle hashes) of each text in order; a long text comes in several parts.

    The last item of a text has a third value True.
    """
    tail: list[bytes] = []
    some, last = False, -1
    for first, n, data, bounds in pieces(texts):
        line = data.tobytes().lower()
        for j in range(n):
            at = first + j
            if at != last:
                if last >= 0:
                    yield last, _short(tail, k) if not some else np.zeros(0, np.uint64), True
                tail, some, last = [], False, at
            words = tail + line[bounds[j]:bounds[j + 1]].split()
            if len(words) >= k:
                some = True
                yield at, _hashed(words, k), False
            tail = words[-(k - 1):] if k > 1 else []
    if last >= 0:
        yield last, _short(tail, k) if not some else np.zeros(0, np.uint64), True


def _short(words: list[bytes], k: int) -> np.ndarray:
    return _hashed(words, len(words)) if words else np.zeros(0, np.uint64)


def _fingerprints(k: int):
    def run(batches):
        for batch in batches:
            texts = batch.column("_text")
            made, held, count = [], np.zeros(64, np.int64), 0
            for _, hashes, complete in text_shingles(texts, k):
                if len(hashes):
                    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                    held += bits.sum(0, dtype=np.int32)
                    count += len(hashes)
                if complete:
                    made.append(np.packbits(2 * held > count, bitorder="little").view(np.int64)[0])
                    held, count = np.zeros(64, np.int64), 0
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(made, pa.int64())], ["doc_id", "fp"])

    return lean(run)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """doc_id, fp (the 64 bits as a long) per row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("_text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return in_batches(rows).mapInArrow(_fingerprints(shingle), f"doc_id {kind}, fp long")


def _distance(f: Column, pivot: int) -> Column:
    return F.bit_count(f.bitwiseXOR(F.lit(_signed(pivot))))


def _keys(f: Column) -> Column:
    """An array of 28 keys: which two bytes are left out, and the other bytes' coordinates."""
    halves = []
    for half in (range(0, 4), range(4, 8)):
        nibbles = [
            F.shiftleft(
                F.shiftright(_distance(f, PIVOTS[r]) + 8 - _distance(f, PARTNERS[r][b]), 1).cast("long"),
                16 * (b % 4) + 4 * r)
            for b in half for r in range(REFERENCES)]
        halves.append(reduce(lambda x, y: x.bitwiseOR(y), nibbles))

    def without(x: int, y: int, half: int) -> int:
        mask = (1 << 64) - 1
        for b in (x, y):
            if b // 4 == half:
                mask &= ~(0xFFFF << (16 * (b % 4)))
        return _signed(mask)

    table_row = F.struct(halves[0].alias("low"), halves[1].alias("high"))
    return F.transform(F.array(table_row), lambda t: F.array(*[
        F.struct(F.lit(i).cast("byte").alias("pair"), F.xxhash64(
            F.lit(i), t["low"].bitwiseAND(F.lit(without(x, y, 0))),
            t["high"].bitwiseAND(F.lit(without(x, y, 1)))).alias("key"))
        for i, (x, y) in enumerate(LEFT_OUT)]))[0]


def _first_key(diff: Column) -> Column:
    """Number of the first way to leave out bytes that covers all set bits of `diff`."""
    hit = [diff.bitwiseAND(F.lit(_signed(0xFF << (8 * b)))) != 0 for b in range(BLOCKS)]
    low = F.coalesce(*[F.when(hit[b], b) for b in range(BLOCKS)])
    high = F.coalesce(*[F.when(hit[b], b) for b in reversed(range(BLOCKS))])
    x = F.when(low < high, low).otherwise(F.lit(0))
    y = F.when(high > 0, high).otherwise(F.lit(1))
    return (x * (2 * BLOCKS - 1 - x) / 2 + y - x - 1).cast("int")


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """fp (distinct longs) -> a, b: every pair at 1 to `max_bits` (at most 2) differing bits, once."""
    if max_bits > 2:
        raise ValueError("the keys leave out two bytes, so at most two bits may differ")
    keyed = prints.select("fp", F.explode(_keys(F.col("fp"))).alias("k")).select("fp", "k.pair", "k.key")
    left = keyed.select(F.col("fp").alias("a"), F.col("pair").alias("_pair"), F.col("key").alias("_key"))
    right = keyed.select(F.col("fp").alias("b"), "key")
    a, b = F.col("a"), F.col("b")
    farthest = F.greatest(*[
        F.abs(_distance(a, p) - _distance(b, p)) for p in PIVOTS + [q for row in PARTNERS for q in row]])
    diff = a.bitwiseXOR(b)
    # Spark counts the 28 keys of a fingerprint as one row and would broadcast them all.
    return left.join(
        right.hint("merge"), (F.col("_key") == F.col("key")) & (a < b) & (farthest <= max_bits)
        & (F.bit_count(diff) <= max_bits) & (F.col("_pair") == _first_key(diff))).select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """a, b -> node, label: the least node of its component, for every node that has an edge."""
    both = written(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "links")
    labels = written(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("_least"))
        .select("node", F.least("node", "_least").alias("label")), "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("_near"))
        stepped = written(labels.join(near, F.col("node") == F.col("a")).select(
            "node", F.col("label").alias("_old"), F.least("label", "_near").alias("_new")), "steps")
        jumped = written(stepped.join(
            stepped.select(F.col("node").alias("_at"), F.col("_new").alias("_next")),
            F.col("_new") == F.col("_at")).select("node", "_old", F.col("_next").alias("label")), "labels")
        labels = jumped.select("node", "label")
        if jumped.where(F.col("_old") != F.col("label")).isEmpty():
            return labels


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     shingle: int = 3, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fp, component_id per row: the smallest id reachable over linked fingerprints."""
    prints = written(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    least = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprint-ids")
    labels = components(links(least.select("fp"), max_bits))
    linked = least.join(labels, F.col("fp") == F.col("node")).select("fp", "label", "least")
    best = linked.groupBy("label").agg(F.min("least").alias("_best")).withColumnRenamed("label", "_label")
    moved = linked.join(best, F.col("label") == F.col("_label")).select(
        F.col("fp").alias("_moved"), "_best")
    # Written, so that the join below is between two plain tables and a hot fingerprint can be split.
    final = written(least.join(moved, F.col("fp") == F.col("_moved"), "left").select(
        F.col("fp").alias("_fp"), F.coalesce("_best", "least").alias("component_id")), "components")
    return prints.join(final, F.col("fp") == F.col("_fp")).select("doc_id", "fp", "component_id")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_groups(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


# Near-duplicates by shingle similarity, for the pipeline.

def _sketches(k: int):
    """Per text: number of different shingles, the whole fingerprint and the thinned ones.

    A thinned fingerprint is the SimHash of the THIN shingles that come first in an order of their
    own. Two texts share it with probability about J ** THIN where J is their similarity, so it
    finds similar texts whose whole fingerprints lie more than a few bits apart.
    """
    salts = _mix(np.arange(101, 101 + THINNED, dtype=np.uint64))

    def run(batches):
        for batch in batches:
            made, parts = [], []
            for _, hashes, complete in text_shingles(batch.column("_text"), k):
                parts.append(hashes)
                if complete:
                    every = np.concatenate(parts)
                    different = np.unique(every)
                    row = [len(different), _majority(every) if len(every) else 0]
                    for salt in salts:
                        order = _mix(different ^ salt)
                        first = np.argpartition(order, THIN - 1)[:THIN] if len(order) > THIN else slice(None)
                        row.append(_majority(different[first]) if len(different) else 0)
                    made.append(row)
                    parts = []
            columns = np.array(made, np.int64).reshape(len(made), 2 + THINNED).T
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(columns[0]), pa.array(columns[1]),
                 pa.FixedSizeListArray.from_arrays(pa.array(columns[2:].T.ravel()), THINNED).cast(pa.list_(pa.int64()))],
                ["doc_id", "shingles", "fp", "thinned"])

    return lean(run)


def _sets(texts: pa.Array, k: int):
    """The different shingle hashes of each text, in ascending order."""
    parts: list[np.ndarray] = []
    for _, hashes, complete in text_shingles(texts, k):
        parts.append(hashes)
        if complete:
            yield np.unique(np.concatenate(parts))
            parts = []


def _similar(k: int, least: float):
    def run(batches):
        for batch in batches:
            keep = []
            for a, b in zip(_sets(batch.column("_ta"), k), _sets(batch.column("_tb"), k)):
                both = len(np.intersect1d(a, b, assume_unique=True))
                union = len(a) + len(b) - both
                keep.append(union == 0 or both >= least * union)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return lean(run)


def _listed(k: int):
    """The different shingles of each text; a text without any has the single token 0."""
    def run(batches):
        for batch in batches:
            for i, own in enumerate(_sets(batch.column("_text"), k)):
                at = pa.array(np.full(max(1, len(own)), i))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_row").take(at), batch.column("label").take(at),
                     pa.array(np.full(len(at), len(own))),
                     pa.array(own.view(np.int64) if len(own) else np.zeros(1, np.int64))],
                    ["_row", "label", "size", "token"])

    return lean(run)


def _prefix_pairs(texts: DataFrame, k: int, similarity: float) -> DataFrame:
    """doc_id, label, _text -> a, b: candidates of different labels; no similar pair is left out.

    Shingles have one order for all texts: those of a single label first, then the rarest, counted
    over all texts. The first shingle that two similar texts have in common lies among the first
    (1 - s) n of the longer and the first (1 - 2s / (1 + s)) n of the shorter, and both have enough
    left after it. Shingles of a single label make no candidates, so they only take up places.
    """
    label = texts.schema["label"].dataType.simpleString()
    # Written, so that the numbers of the rows stay.
    texts = written(texts.withColumn("_row", F.monotonically_increasing_id()), "numbered-texts")
    listed = written(in_batches(texts.select("_row", "label", "_text")).mapInArrow(
        _listed(k), f"_row long, label {label}, size long, token long"), "shingles")
    mixed = written(listed.groupBy(F.col("token").alias("_token")).agg(
        F.count("*").alias("_n"), F.min("label").alias("_low"), F.max("label").alias("_high")).where(
        "_low < _high").select("_token", "_n"), "mixed-shingles")
    shared = listed.join(mixed, F.col("token") == F.col("_token")).select("_row", "size", "token", "_n")
    own = Window.partitionBy("_row")
    # The places start after the shingles of a single label.
    first = shared.withColumn("place", F.col("size") - F.count("*").over(own) + F.row_number().over(
        own.orderBy("_n", F.xxhash64("token"), "token")) - 1)
    first = first.where((F.col("place") <= (1 - similarity) * F.col("size") + 1e-9) | (F.col("size") == 0))
    held = written(first.join(
        texts.select(F.col("_row").alias("_of"), "doc_id", "label"), F.col("_row") == F.col("_of")).select(
        "doc_id", "label", "size", "token", F.greatest("place", F.lit(0)).alias("place")), "prefixes")
    a, b = (held.select(*[F.col(c).alias(f"{c}_{side}") for c in held.columns]) for side in ("a", "b"))
    a = a.where(F.col("place_a") <= (1 - 2 * similarity / (1 + similarity)) * F.col("size_a") + 1e-9)
    left = F.least(F.col("size_a") - F.col("place_a"), F.col("size_b") - F.col("place_b"))
    return a.join(
        b, (F.col("token_a") == F.col("token_b")) & (F.col("label_a") != F.col("label_b"))
        & (F.struct("size_a", "doc_id_a") < F.struct("size_b", "doc_id_b"))
        & (left * (1 + similarity) >= similarity * (F.col("size_a") + F.col("size_b")) - 1e-6)).select(
        F.least("doc_id_a", "doc_id_b").alias("a"), F.greatest("doc_id_a", "doc_id_b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 5, similarity: float = 0.8, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, keeper of every document that is not the one of its group that stays.

    Equal texts are merged first. Candidates are pairs whose whole fingerprints link (pivot tables,
    `max_bits`), and pairs of a document with the first one that has a thinned fingerprint in
    common, so a group of n similar texts makes at most n pairs per thinned fingerprint. Every
    candidate is verified by the exact similarity of the shingle sets; groups are components.

    Where texts with a fingerprint in common are then still in different groups, as texts that
    share a long passage are, those texts are joined on their rarest shingles, which finds every
    similar pair across groups.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    texts = written(rows.select("doc_id", F.unhex(F.md5("_text")).alias("_md5")), "text-hashes")
    first = written(texts.groupBy("_md5").agg(F.min("doc_id").alias("_first")), "first-texts")
    alike = texts.join(first.withColumnRenamed("_md5", "_m"), F.col("_md5") == F.col("_m")).where(
        F.col("doc_id") != F.col("_first")).select(F.col("doc_id").alias("_id"), F.col("_first").alias("keeper"))
    alike = written(alike, "equal-texts")
    single = rows.join(
        broadcast_if_small(alike.select("_id")), F.col("doc_id") == F.col("_id"), "left_anti")
    sketch = written(in_batches(single).mapInArrow(
        _sketches(shingle), f"doc_id {kind}, shingles long, fp long, thinned array<long>"), "sketches")
    shared = sketch.select("doc_id", "shingles", F.posexplode("thinned").alias("_t", "_k")).union(
        sketch.select("doc_id", "shingles", F.lit(-1), "fp"))
    heads = shared.groupBy(F.col("_t").alias("_ht"), F.col("_k").alias("_hk")).agg(
        F.min(F.struct("doc_id", "shingles")).alias("_head"), F.count("*").alias("_n")).where("_n > 1")
    pairs = shared.join(heads, (F.col("_t") == F.col("_ht")) & (F.col("_k") == F.col("_hk"))).select(
        F.col("_head.doc_id").alias("a"), F.col("_head.shingles").alias("_na"),
        F.col("doc_id").alias("b"), F.col("shingles").alias("_nb"))
    least = sketch.groupBy("fp").agg(F.min(F.struct("doc_id", "shingles")).alias("_of"))
    least = written(least, "sketch-ids")
    near = links(least.select("fp"), max_bits)
    for side in ("a", "b"):
        near = near.join(
            least.select(F.col("fp").alias(f"_f{side}"), F.col("_of").alias(f"_{side}")),
            F.col(side) == F.col(f"_f{side}"))
    near = written(near.select(
        F.least("_a.doc_id", "_b.doc_id").alias("a"), F.col("_a.shingles").alias("_na"),
        F.greatest("_a.doc_id", "_b.doc_id").alias("b"), F.col("_b.shingles").alias("_nb"),
        "_fa", "_fb"), "near-fingerprints")
    fits = F.least("_na", "_nb") >= similarity * F.greatest("_na", "_nb")
    bodies = rows.select(F.col("doc_id").alias("_d"), F.col("_text").alias("_t"))

    def verify(candidates: DataFrame) -> DataFrame:
        both = candidates.join(bodies.withColumnRenamed("_t", "_ta"), F.col("a") == F.col("_d")).drop("_d")
        both = both.join(bodies.withColumnRenamed("_t", "_tb"), F.col("b") == F.col("_d")).drop("_d")
        return written(in_batches(both.select("a", "b", "_ta", "_tb")).mapInArrow(
            _similar(shingle, similarity), f"a {kind}, b {kind}"), "verified")

    verified = verify(written(
        pairs.union(near.drop("_fa", "_fb")).where((F.col("a") != F.col("b")) & fits)
        .select("a", "b").distinct(), "candidates"))
    labels = components(verified)

    # What a fingerprint has in common but the verified pairs do not connect.
    named = labels.select(F.col("node").alias("_node"), F.col("label").alias("_label"))
    labelled = written(sketch.join(named, F.col("doc_id") == F.col("_node"), "left").select(
        "doc_id", "shingles", "fp", "thinned", F.coalesce("_label", "doc_id").alias("label")), "labelled-sketches")
    shared = labelled.select("doc_id", "label", F.posexplode("thinned").alias("_t", "_k")).union(
        labelled.select("doc_id", "label", F.lit(-1), "fp"))
    split = shared.groupBy(F.col("_t").alias("_st"), F.col("_k").alias("_sk")).agg(
        F.min("label").alias("_low"), F.max("label").alias("_high")).where("_low < _high").select("_st", "_sk")
    for side in ("a", "b"):
        near = near.join(named.select(F.col("_node").alias(f"_at{side}"), F.col("_label").alias(f"_of{side}")),
                         F.col(side) == F.col(f"_at{side}"), "left")
    apart = near.where(F.coalesce("_ofa", "a") != F.coalesce("_ofb", "b"))
    split = split.union(apart.select(F.lit(-1), "_fa")).union(apart.select(F.lit(-1), "_fb")).distinct()
    unsettled = written(shared.join(
        split, (F.col("_t") == F.col("_st")) & (F.col("_k") == F.col("_sk")), "left_semi").groupBy(
        F.col("doc_id").alias("_id")).agg(F.min("label").alias("label")), "unsettled")
    if not unsettled.isEmpty():
        again = single.join(
            broadcast_if_small(unsettled), F.col("doc_id") == F.col("_id")).select("doc_id", "label", "_text")
        more = verify(written(_prefix_pairs(again, shingle, similarity), "candidates"))
        if not more.isEmpty():
            labels = components(verified.union(more))
    near_keepers = labels.where(F.col("node") != F.col("label")).select(
        F.col("node").alias("doc_id"), F.col("label").alias("keeper"))
    moved = alike.join(
        near_keepers.select(F.col("doc_id").alias("_near"), F.col("keeper").alias("_best")),
        F.col("keeper") == F.col("_near"), "left")
    return near_keepers.union(moved.select("_id", F.coalesce("_best", "keeper"))).distinct()


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """The rows of one document of each group; rows that repeat an id stay together."""
    gone = written(near_duplicates(docs, id_col, text_col, shingle, similarity).select(
        F.col("doc_id").alias("__gone")), "gone")
    return docs.join(broadcast_if_small(gone), F.col(id_col) == F.col("__gone"), "left_anti")
