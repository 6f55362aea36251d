"""Secret scan with corpus-wide ownership frequency.

One pass finds candidates in each text: the three base kinds, credentials of known formats, and
long mixed tokens of high entropy. Candidates are hashed; per hash the distinct repositories and
owners are counted over the whole corpus. A value that many owners hold is a widely copied example;
one that a single owner or two hold looks live, however many copies they have. Base spans always
stay. Other candidates become spans only if they look live.

A private key counts from BEGIN to END, so its value is the key and not its header. Without an END
it reaches as far as its lines do. Base spans inside are left out of its span, which then comes in
parts.

A value may occur in a third of all documents: counts are grouped by (hash, owner, repository)
first, so a hash reaches the last grouping once per owner, and the join back may split it.

Defined cases: null text is empty; null owner or repository is one of its own; repeated rows are
scanned and returned each; spans count code points.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.common import in_batches, lean, table
from tidemart.operators.relational import broadcast_if_small
from tidemart.session import written

#: Kinds in the order in which they are listed; the first three are the base.
KINDS = ("assign", "access", "hex", "format", "entropy")
BASE = 3

ASSIGN = re.compile(
    r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile("AKIA[A-Z0-9]{16,}")  # runs that are too short hold no longer one
HEX = re.compile("[0-9a-f]{24,}")
FORMAT = re.compile(
    r"gh[pousr]_[A-Za-z0-9]{36}|github_pat_[A-Za-z0-9_]{50,}|glpat-[A-Za-z0-9_-]{20,}"
    r"|xox[abprs]-[A-Za-z0-9-]{20,}|sk_(?:live|test)_[A-Za-z0-9]{16,}|sk-[A-Za-z0-9_-]{32,}"
    r"|AIza[A-Za-z0-9_-]{35}|eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"
    r"|-----BEGIN [A-Z0-9 ]{0,30}PRIVATE KEY(?: BLOCK)?-----"
    r"(?:(?>[^-]*(?:-(?!----)[^-]*)*)-----END [A-Z0-9 ]{0,30}PRIVATE KEY(?: BLOCK)?-----"
    r"|(?>(?:\\[rn]|[\s\"'+,])*[A-Za-z0-9+/=]{16,})*)")
FORMAT_SIGNS = ("gh", "glpat-", "xox", "sk_", "sk-", "AIza", "eyJ", "-----BEGIN")
LONG = re.compile(r"[A-Za-z0-9+/_-]{20,}")
KEYWORD = re.compile(r"(?ai:passw|secret|token|api_?key)")
#: A candidate token mixes cases and digits and has at least so many bits per character.
BITS = 3.5
#: From so many owners on a value is a widely copied example.
OWNERS = 3


def entropy(value: str) -> float:
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values())


def candidates(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind number, end, value) in order of start, then kind."""
    found = []
    if KEYWORD.search(text):
        found += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    more = []
    if any(s in text for s in FORMAT_SIGNS):
        more += [(m.start(), 3, m.end(), m[0]) for m in FORMAT.finditer(text)]
    for m in LONG.finditer(text):
        v = m[0]
        if not v.isalpha() and any(c.isdigit() for c in v) and any("A" <= c <= "Z" for c in v) and any(
                "a" <= c <= "z" for c in v) and entropy(v) >= BITS:
            more.append((m.start(), 4, m.end(), v))
    more = [part for x in more for part in (_beside(x, found) if x[3].startswith("-----") else [x])]
    for x in more:  # one span per place
        if all(x[2] <= y[0] or y[2] <= x[0] for y in found):
            found.append(x)
    return sorted(found)


def _beside(key: tuple[int, int, int, str], found: list[tuple[int, int, int, str]]):
    """The parts of a private key that no other span covers, each with the value of the whole."""
    at, kind, until, value = key
    for start, _, end, _ in sorted(found):
        if end > at and start < until:
            if start > at:
                yield at, kind, start, value
            at = max(at, end)
    if at < until:
        yield at, kind, until, value


def joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{start}:{end}" for start, k, end, *_ in spans)


_FOUND = "array<struct<start:long,kind:int,end:long,value:string>>"


def _scan(batches):
    kind = pa.list_(pa.struct([
        ("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()), ("value", pa.string())]))
    for batch in batches:
        base, found = [], []
        for text in batch.column("_text").to_pylist():
            spans = candidates(text or "")
            base.append(joined(s for s in spans if s[1] < BASE))
            found.append([
                {"start": a, "kind": k, "end": b, "value": hashlib.sha256(v.encode()).hexdigest()}
                for a, k, b, v in spans])
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(n) for n in batch.schema.names if n != "_text"),
             pa.array(base, pa.string()), pa.array(found, kind)],
            [*(n for n in batch.schema.names if n != "_text"), "base_spans", "_found"])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         owner_col: str = "source", repo_col: str = "doc_id") -> DataFrame:
    """Per row: id, base_spans, spans, found.

    found has every candidate: start, kind, end, sha256 of its value, owners and repositories that
    hold it, and whether it looks live; ordered like the spans.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("doc_id"),
        F.xxhash64(text_col).alias("_text_hash"), F.col(owner_col).cast("string").alias("_owner"),
        F.col(repo_col).cast("string").alias("_repo"), F.col(text_col).cast("string").alias("_text"))
    kept = ", ".join(f"{n} {t}" for n, t in rows.dtypes if n != "_text")
    scanned = written(
        in_batches(rows).mapInArrow(lean(_scan), f"{kept}, base_spans string, _found {_FOUND}"), "secret-candidates")
    each = scanned.where(F.size("_found") > 0).select(
        "_row", "doc_id", "_text_hash", "base_spans", "_owner", "_repo", F.explode("_found").alias("f"))
    frequency = (
        each.select(F.col("f.value").alias("_value"), "_owner", "_repo")
        .groupBy("_value", "_owner", "_repo").agg(F.lit(1).alias("_one"))
        .groupBy("_value", "_owner").agg(F.count("*").alias("_repos"))
        .groupBy("_value").agg(F.count("*").alias("owners"), F.sum("_repos").alias("repositories"))
    )
    entry = F.struct(
        "f.start", "f.kind", "f.end", F.col("f.value").alias("sha256"), "owners", "repositories",
        (F.col("owners") < OWNERS).alias("live"))
    judged = (
        each.join(frequency, F.col("f.value") == F.col("_value"))
        .groupBy("_row", "doc_id", "_text_hash", "base_spans")
        .agg(F.sort_array(F.collect_list(entry)).alias("found"))  # bounded by one document
    )
    none = scanned.where(F.size("_found") == 0).select(
        "_row", "doc_id", "_text_hash", "base_spans",
        F.lit(None).cast(judged.schema["found"].dataType).alias("found"))
    names = F.array(*[F.lit(k) for k in KINDS])
    listed = F.transform(
        shown(F.col("found")),
        lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")))
    return judged.unionByName(none).withColumn("found", F.coalesce("found", F.array().cast(
        judged.schema["found"].dataType))).withColumn("spans", F.array_join(listed, ","))


def shown(found: Column) -> Column:
    """The spans among the candidates: the base ones, and the others that look live."""
    return F.filter(found, lambda s: (s["kind"] < BASE) | s["live"])


def _without(text: Column, spans: Column) -> Column:
    """The text with each span, in order of start, replaced by its kind; overlaps go as one."""
    names = F.array(*[F.lit(k.upper()) for k in KINDS])

    def cut(state: Column, s: Column) -> Column:
        until = F.concat(
            state["out"], F.substr(text, state["at"] + 1, (s["start"] - state["at"]).cast("int")),
            F.lit("["), F.get(names, s["kind"]), F.lit("]"))
        return F.struct(
            F.greatest(state["at"], s["end"].cast("int")).alias("at"),
            F.when(s["start"] >= state["at"], until).otherwise(state["out"]).alias("out"))

    return F.aggregate(
        spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), cut,
        lambda state: F.concat(state["out"], F.substr(text, state["at"] + 1)))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           owner_col: str = "source", repo_col: str = "doc_id") -> DataFrame:
    """The documents with every span's text replaced by its kind; only rows with spans change.

    Few rows have spans, so they are looked up and the texts stay where they are unless the list
    is too long to broadcast.
    """
    spans = written(
        scan(docs, id_col, text_col, owner_col, repo_col).where(F.col("spans") != "")
        .groupBy(F.col("doc_id").alias("__span_id"), F.col("_text_hash").alias("__span_hash"))
        .agg(F.first(F.transform(shown(F.col("found")), lambda s: F.struct(
            s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))).alias("__spans")),
        "secret-spans")
    found = docs.join(
        broadcast_if_small(spans),
        F.col(id_col).eqNullSafe(F.col("__span_id")) & (F.xxhash64(text_col) == F.col("__span_hash")), "left")
    return found.withColumn(
        text_col, F.when(F.col("__spans").isNull(), F.col(text_col)).otherwise(
            _without(F.col(text_col), F.col("__spans")))).select(*docs.columns)


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    def count(kind: int):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")

    return scan(table(spark, sf_dir, "documents")).select(
        "doc_id", *[count(k).alias(f"n_{KINDS[k]}") for k in range(BASE)],
        F.sha2("base_spans", 256).alias("base_sha256"), "spans",
        F.size(F.filter("found", lambda s: s["live"])).cast("long").alias("n_live"),
        F.size(F.filter("found", lambda s: ~s["live"])).cast("long").alias("n_example"))
