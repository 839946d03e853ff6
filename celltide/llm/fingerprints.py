"""Document fingerprints by I-Match with randomised lexicons.

Terms are words, A-Z in lower case. The lexicon keeps those whose inverse document frequency lies in a
band: in at least `RARE` and at most `COMMON` of all documents, counted over all of them. As a document
has w distinct words on average, no more than w / RARE terms can be in the band, however many documents
there are; that bound is checked before the lexicon is broadcast.

Terms are counted in two passes. The first adds up counters of a sketch of fixed size, which never fall
below a term's true count; the second counts exactly the terms whose counter reaches the band.

Each of `LEXICONS` randomised lexicons is a family of nested subsets of the lexicon, each half of the one
before. A document's hash in it is that of its sorted distinct terms in the smallest subset that has any
of them. The fingerprint is these hashes side by side; two fingerprints are as alike as the share of
lexicons in which they agree, which is near the Jaccard likeness of the terms.

Defined cases: null is empty; a text without terms in the band has the hash of its whole text in place
of each of its lexicons' hashes, so only equal texts of this kind agree; equal texts have equal
fingerprints; rows with equal doc_id are ordered by their text; rows without doc_id come first; a single
document is its own next document; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from celltide.llm import textops
from celltide.llm.frames import as_text, load, shuffles

RARE, COMMON = 0.002, 0.2
LEXICONS = 64
SKETCH = 18
MOST_TERMS = 4_000_000  # 32 MB; a lexicon beyond it is refused rather than broadcast
SHARE = 4096  # documents of a bucket of neighbours, about


def _terms(data, offsets, hasher, spaces, fold):
    """Distinct terms of each text: (row numbers, hashes)."""
    lower = fold[data]
    start, end, row = textops.words(lower, offsets, spaces)
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = hasher.load(lower).of(start, end)
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return row[keep], h[keep]


def _tools():
    return textops.Hasher(), textops.is_space(), textops.lower()


def _slot(h):
    return (h >> np.uint64(64 - SKETCH)).astype(np.int64)


def _sketched(batches):
    tools, counts, n = _tools(), np.zeros(1 << SKETCH, np.int64), 0
    for rows, data, at in textops.texts(batches):
        counts += np.bincount(_slot(_terms(data, at, *tools)[1]), minlength=len(counts))
        n += len(rows)
    full = np.flatnonzero(counts)
    yield pa.record_batch({"slot": pa.array(full), "n": pa.array(counts[full])})
    yield pa.record_batch({"slot": pa.array([-1], pa.int64()), "n": pa.array([n], pa.int64())})


def _counted(enough):
    def fn(batches):
        tools = _tools()
        keep = enough.value
        for rows, data, at in textops.texts(batches):
            h = _terms(data, at, *tools)[1]
            term, n = np.unique(h[keep[_slot(h)]], return_counts=True)
            yield pa.record_batch({"term": pa.array(term.view(np.int64)), "n": pa.array(n)})

    return fn


def lexicon(docs: DataFrame, text="text", rare=RARE, common=COMMON) -> np.ndarray:
    """Sorted hashes of the terms in the band."""
    spark = docs.sparkSession
    body = docs.select(as_text(docs, text).alias("text"))
    sums = body.mapInArrow(_sketched, "slot BIGINT, n BIGINT").groupBy("slot").agg(F.sum("n").alias("n")).toPandas()
    sums = dict(zip(sums["slot"], sums["n"]))  # 2**SKETCH + 1 rows at most
    docs_n = int(sums.pop(-1, 0))
    counters = np.zeros(1 << SKETCH, np.int64)
    counters[list(sums)] = list(sums.values())
    low, high = max(1, rare * docs_n), max(1, common * docs_n)
    if counters.sum() > MOST_TERMS * low:
        raise ValueError("the documents have too many terms for this band; raise `rare`")
    enough = spark.sparkContext.broadcast(counters >= low)
    terms = body.mapInArrow(_counted(enough), "term BIGINT, n BIGINT").groupBy("term").agg(F.sum("n").alias("n"))
    found = terms.where((F.col("n") >= low) & (F.col("n") <= high)).select("term").toPandas()
    return np.sort(found["term"].to_numpy(np.int64).view(np.uint64))


class Fingerprinter:
    """Fingerprints of texts as arrays of 32-bit numbers, one for each lexicon."""

    def __init__(self, terms: np.ndarray, lexicons=LEXICONS):
        self.terms, self.tools = terms, _tools()
        self.salts = textops.mix(np.arange(1, lexicons + 1, dtype=np.uint64) * textops.BASE2)

    def of(self, data, offsets):
        n, k = len(offsets) - 1, len(self.salts)
        out = np.zeros((n, k), np.uint32)
        row, h = _terms(data, offsets, *self.tools)
        if len(h) and len(self.terms):
            at = np.minimum(np.searchsorted(self.terms, h), len(self.terms) - 1)
            keep = self.terms[at] == h
            row, h = row[keep], h[keep]
        else:
            row, h = row[:0], h[:0]
        bounds = textops.runs(row, n)
        full = np.flatnonzero(np.diff(bounds))
        if len(full):
            starts = bounds[:-1][full]
            size = np.diff(bounds)[full]
            for j, salt in enumerate(self.salts):
                r = textops.mix(h ^ salt)
                # A term is in as many nested subsets as its number has zeros at the end.
                bit = (r | np.uint64(1 << 62)) & (~r + np.uint64(1))
                depth = np.where(bit == 0, np.uint64(1 << 62), bit)
                top = np.maximum.reduceat(depth, starts)
                inside = depth == np.repeat(top, size)
                total = np.add.reduceat(np.where(inside, textops.mix(r + textops.BASE), np.uint64(0)), starts)
                out[full, j] = (textops.mix(total + top) >> np.uint64(32)).astype(np.uint32)
        for i in np.flatnonzero(np.diff(bounds) == 0):
            whole = hashlib.sha256(data[offsets[i] : offsets[i + 1]].tobytes()).digest()
            seed = np.frombuffer(whole[:8], np.uint64)
            out[i] = (textops.mix(self.salts ^ seed) >> np.uint64(32)).astype(np.uint32)
        return out


def likeness(a, b):
    """The share of lexicons in which fingerprints agree."""
    return (a == b).mean(axis=-1)


def _joined(texts):
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    return np.frombuffer(b"".join(raw), np.uint8), offsets


def fingerprint(docs: DataFrame, text="text", terms=None, lexicons=LEXICONS) -> DataFrame:
    """The documents with a column `fingerprint` (hexadecimal) beside them."""
    terms = docs.sparkSession.sparkContext.broadcast(lexicon(docs, text) if terms is None else terms)
    name = "fingerprint" if "fingerprint" not in docs.columns else "fingerprint_1"
    body = docs.withColumn(f"__{name}", as_text(docs, text))
    schema = docs.schema.add(name, "string")

    def fn(batches):
        maker = Fingerprinter(terms.value, lexicons)
        for rows, data, at in textops.texts(batches, f"__{name}"):
            made = [r.astype(">u4").tobytes().hex() for r in maker.of(data, at)]
            yield rows.select(list(range(rows.num_columns - 1))).append_column(name, pa.array(made, pa.string()))

    return body.mapInArrow(fn, schema)


RESULT = (
    "doc_id BIGINT, n_chars BIGINT, edited_sha256 STRING, fingerprint STRING, edited_fingerprint STRING,"
    " near_edited DOUBLE, near_next DOUBLE"
)


def _edited(text, following):
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compare(terms, lexicons):
    """Each row with the row after it; rows come by bucket and in order, each bucket ended by a copy
    of the first row of the next."""

    def flush(maker, rows):
        ids, texts = [r[0] for r in rows[:-1]], [r[1] for r in rows]
        edited = [_edited(a, b) for a, b in zip(texts, texts[1:])]
        own, new = maker.of(*_joined(texts)), maker.of(*_joined(edited))
        return pa.record_batch({
            "doc_id": pa.array(ids, pa.int64()), "n_chars": pa.array([len(t) for t in texts[:-1]], pa.int64()),
            "edited_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
            "fingerprint": pa.array([r.astype(">u4").tobytes().hex() for r in own[:-1]], pa.string()),
            "edited_fingerprint": pa.array([r.astype(">u4").tobytes().hex() for r in new], pa.string()),
            "near_edited": pa.array(likeness(own[:-1], new)), "near_next": pa.array(likeness(own[:-1], own[1:])),
        })

    def fn(batches):
        maker, held, size, bucket = Fingerprinter(terms.value, lexicons), [], 0, None
        for batch in batches:
            for b, i, text in zip(*(c.to_pylist() for c in batch.columns[:3])):
                if b != bucket:
                    if len(held) > 1:
                        yield flush(maker, held)
                    held, size, bucket = [], 0, b
                held.append((i, text))
                size += len(text)
                if size > textops.CHUNK and len(held) > 1:
                    yield flush(maker, held)
                    held, size = held[-1:], len(text)
        if len(held) > 1:
            yield flush(maker, held)

    return fn


def compare_neighbours(docs: DataFrame, id_column="doc_id", text="text", terms=None, lexicons=LEXICONS) -> DataFrame:
    """Each document with its edited text and with the next document, in the order of doc_id."""
    spark = docs.sparkSession
    terms = spark.sparkContext.broadcast(lexicon(docs, text) if terms is None else terms)
    rows = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), as_text(docs, text).alias("text"))
    # Buckets of neighbours, by quantiles of doc_id; equal ids share a bucket.
    many = max(shuffles(spark), 1)
    cuts = sorted(set(rows.where("doc_id IS NOT NULL").approxQuantile(
        "doc_id", [i / many for i in range(1, many)], 1 / (10 * many)))) if many > 1 else []
    cuts = [int(c) for c in cuts]

    def bucket_of(column):
        ladder = F.lit(0)
        return ladder if not cuts else F.when(column.isNull(), 0).otherwise(
            F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= column)))

    rows = rows.withColumn("bucket", bucket_of(F.col("doc_id")))
    order = F.struct(F.col("doc_id").isNotNull().alias("k"), "doc_id", F.xxhash64("text").alias("h"))
    firsts = {r["bucket"]: r["f"] for r in rows.groupBy("bucket").agg(F.min(order).alias("f")).collect()}
    filled = sorted(firsts)  # one row for each bucket
    if not filled:
        return spark.createDataFrame([], RESULT)
    ends = spark.createDataFrame(
        [(firsts[b]["doc_id"], firsts[b]["h"], filled[i - 1]) for i, b in enumerate(filled)],
        "i BIGINT, h BIGINT, to INT")
    first = rows.join(F.broadcast(ends), F.col("doc_id").eqNullSafe(F.col("i")) & (F.xxhash64("text") == F.col("h")))
    tails = first.dropDuplicates(["to"]).select(F.col("to").alias("bucket"), "doc_id", "text", F.lit(1).alias("tail"))
    every = rows.select("bucket", "doc_id", "text", F.lit(0).alias("tail")).union(tails)
    every = every.select("bucket", "doc_id", "text", "tail", F.xxhash64("text").alias("h"))
    spread = every.repartition(len(filled), "bucket").sortWithinPartitions(
        "bucket", "tail", F.col("doc_id").asc_nulls_first(), "h")
    return spread.mapInArrow(_compare(terms, lexicons), RESULT)


def op2_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_neighbours(load(spark, sf_dir, "documents"))


