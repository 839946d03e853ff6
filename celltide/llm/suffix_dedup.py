"""Suffix-array dedup: bytes covered by a long string that also starts anywhere else.

A logarithmic family of sparse suffix arrays. Not every suffix is kept, but those that start at
anchors chosen by content: in each window of `SPREAD` positions the one whose next bytes have the least
hash. Any two equal strings of `length` bytes have their first anchor at the same place, so it is
enough to sort and compare anchored suffixes, about one in SPREAD / 2.

New documents come in batches. A batch's suffix array (anchored suffixes in order of their first
bytes, one row for each distinct prefix of `length - SPREAD + 1` bytes) is merge-scanned against every
level of the family: both are tables in the same buckets, so neither is shuffled. Prefixes found twice
are the long matches. The batch then is a new level, and levels of equal rank are merged.

Matches are extended to exact windows of `length` bytes by hashes of ever shorter ranges: an anchor's
windows all at once, then by `STEP`, then one by one. Only anchors whose prefix occurs elsewhere with
other bytes around it go on to the next range, and only counts of hashes are compared: no group of
matches is ever brought together, and copies are not paired.

Defined cases: null is empty; texts shorter than `length` lose nothing; rows with equal doc_id are
different texts, equal rows are copies of each other (so both lose all they share) and each keeps its
row; an empty table gives an empty result. Bytes are compared by two 64-bit hashes.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from celltide.llm import textops
from celltide.llm.frames import as_text, filter_bits, load, materialize, passing, shuffles

LENGTH, SPREAD, GRAM, STEP = 400, 256, 32, 16
BATCHES = 4
FILTER = 24
PIECE = 1 << 20  # window starts worked on at once
ANCHOR = (
    "doc_id BIGINT, text_id BIGINT, at BIGINT, first BIGINT, last BIGINT, head BIGINT, core BIGINT, ctx BIGINT"
)
RANGE = "doc_id BIGINT, text_id BIGINT, first BIGINT, last BIGINT, core BIGINT, ctx BIGINT"


def _least(values, width):
    """The least of each run of `width` values, for every start; the end is padded with the greatest."""
    n = len(values)
    padded = np.full(-(-(n + width) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    fore = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], fore[width - 1 : width - 1 + n])


def anchors(data, offsets, length, hasher, second):
    """For each run of windows with one anchor: row, anchor, first and last window, head, core, ctx."""
    n = len(data)
    out = [np.zeros(0, np.int64)] * 4 + [np.zeros(0, np.uint64)] * 3
    if n < length:
        return out
    start = np.arange(n - GRAM + 1)
    hasher.load(data)
    gram = hasher.of(start, start + GRAM)
    packed = (gram & ~np.uint64((1 << 24) - 1)) | start.astype(np.uint64)
    spot = (_least(packed, SPREAD) & np.uint64((1 << 24) - 1)).astype(np.int64)
    ends = np.repeat(offsets[1:], np.diff(offsets))
    window = np.flatnonzero(np.arange(n) + length <= ends)
    if not len(window):
        return out
    at = spot[window]
    new = np.ones(len(window), bool)
    new[1:] = (at[1:] != at[:-1]) | (window[1:] != window[:-1] + 1)
    i = np.flatnonzero(new)
    first, at = window[i], at[i]
    last = window[np.append(i[1:], len(window)) - 1]
    head = np.zeros(len(at), np.uint64)
    for k in range(8):
        head = (head << np.uint64(8)) | data[at + k].astype(np.uint64)
    core = hasher.of(at, at + length - SPREAD + 1)
    ctx = around(second.load(data), at, first, last, length)
    return [np.searchsorted(offsets, first, "right") - 1, at, first, last, head, core, ctx]


def around(second, at, first, last, length):
    """Hash of all bytes of the windows, and of where they lie beside the anchor."""
    place = (at - first).astype(np.uint64) * textops.BASE + (at - last).astype(np.uint64) * textops.BASE2
    return textops.mix(second.of(first, last + length) + textops.mix(place))


def _pieces(rows, data, offsets, length):
    """A text of any length in pieces that overlap by a window: (bytes, offsets, shift)."""
    if len(data) <= PIECE + length:
        yield data, offsets, 0
        return
    for lo in range(0, len(data) - length + 1, PIECE):
        piece = data[lo : lo + PIECE + length - 1]
        yield piece, np.array([0, len(piece)]), lo


def _anchored(length):
    def fn(batches):
        hasher, second = textops.Hasher(), textops.Hasher(textops.BASE2)
        for rows, data, offsets in textops.texts(batches):
            for piece, at, shift in _pieces(rows, data, offsets, length):
                row, spot, first, last, head, core, ctx = anchors(piece, at, length, hasher, second)
                base = at[:-1][row] - shift
                take = pa.array(row)
                yield pa.record_batch({
                    "doc_id": rows.column(0).take(take), "text_id": rows.column(1).take(take),
                    "at": pa.array(spot - base), "first": pa.array(first - base),
                    "last": pa.array(last - base), "head": pa.array((head >> np.uint64(1)).view(np.int64)),
                    "core": pa.array(core.view(np.int64)), "ctx": pa.array(ctx.view(np.int64)),
                })

    return fn


class SuffixFamily:
    """Levels of sparse suffix arrays, at most one of each rank when a batch has been added."""

    def __init__(self, spark: SparkSession, buckets: int | None = None):
        self.spark, self.buckets = spark, buckets or shuffles(spark)
        self.levels: list[tuple[int, str]] = []

    def _store(self, rows: DataFrame) -> str:
        name = f"suffixes_{uuid.uuid4().hex}"
        rows.write.bucketBy(self.buckets, "core").sortBy("head", "core").format("parquet").saveAsTable(name)
        return name

    def _merge(self, low: str, high: str) -> str:
        a, b = self.spark.table(low), self.spark.table(high)
        both = a.join(b.select("core", F.col("head").alias("h"), F.col("n").alias("m")), "core", "full")
        merged = self._store(both.select(
            "core", F.coalesce("head", "h").alias("head"),
            (F.coalesce("n", F.lit(0)) + F.coalesce("m", F.lit(0))).alias("n"),
        ))
        for name in (low, high):
            self.spark.sql(f"DROP TABLE {name}")
        return merged

    def add(self, suffixes: DataFrame) -> DataFrame:
        """Takes in the anchored suffixes of new documents; returns the prefixes found twice."""
        batch = self._store(
            suffixes.groupBy("core").agg(F.first("head").alias("head"), F.count("*").alias("n")))
        rows = self.spark.table(batch)
        found = rows.where("n > 1").select("core")
        for _, level in self.levels:
            found = found.union(rows.join(self.spark.table(level).select("core"), "core").select("core"))
        found = materialize(found.distinct(), "matches")
        rank = 0
        while self.levels and self.levels[-1][0] == rank:
            batch = self._merge(self.levels.pop()[1], batch)
            rank += 1
        self.levels.append((rank, batch))
        return found

    def drop(self):
        for _, name in self.levels:
            self.spark.sql(f"DROP TABLE {name}")
        self.levels = []


def _ranges(length, step):
    """The ranges of `step` windows, by distance from the anchor, of the anchors listed with a text."""

    def fn(batches):
        hasher, second = textops.Hasher(), textops.Hasher(textops.BASE2)
        for rows, data, offsets in textops.texts(batches):
            parts = rows.column(3)
            lists = np.diff(parts.offsets.to_numpy()) if len(parts) else np.zeros(0, int)
            flat = parts.flatten()
            at, first, last, core = (
                flat.field(k).to_numpy(zero_copy_only=False) for k in ("at", "first", "last", "core"))
            row = np.repeat(np.arange(len(rows)), lists)
            near, far = (at - last) // step, (at - first) // step
            count = far - near + 1
            i = np.repeat(np.arange(len(at)), count)
            q = np.arange(len(i)) - np.repeat(np.cumsum(count) - count, count) + near[i]
            base = offsets[:-1][row][i]
            lo = np.maximum(first[i], at[i] - step * q - step + 1)
            hi = np.minimum(last[i], at[i] - step * q)
            spot = at[i] + base
            # What all windows of the whole range have in common, whether or not this text has them all.
            left, right = spot - step * q, spot - step * q - step + 1 + length
            hasher.load(data), second.load(data)
            inside = (left >= base) & (right <= offsets[1:][row][i])
            left, right = np.where(inside, left, spot), np.where(inside, right, spot)
            common = textops.mix(
                hasher.of(left, right) + core[i].view(np.uint64) + q.astype(np.uint64) * textops.BASE)
            ctx = around(second, spot, lo + base, hi + base, length)
            take = pa.array(row[i])
            yield pa.record_batch({
                "doc_id": rows.column(0).take(take), "text_id": rows.column(1).take(take),
                "at": pa.array(at[i]), "first": pa.array(lo), "last": pa.array(hi),
                "core": pa.array(common.view(np.int64)), "ctx": pa.array(ctx.view(np.int64)),
            })

    return fn


def _cut(length):
    """What is left of each text without the spans listed with it."""

    def fn(batches):
        for rows, data, offsets in textops.texts(batches):
            spans = rows.column(3)
            bounds = spans.offsets.to_numpy()
            flat = spans.flatten()
            first, last = (flat.field(k).to_numpy(zero_copy_only=False) for k in ("first", "last"))
            bounds = bounds - (bounds[0] if len(bounds) else 0)
            removed, pieces, sums, runs = [], [], [], []
            for i in range(len(rows)):
                text = data[offsets[i] : offsets[i + 1]]
                a, b = first[bounds[i] : bounds[i + 1]], last[bounds[i] : bounds[i + 1]] + length
                change = np.zeros(len(text) + 1, np.int32)
                np.add.at(change, a, 1)
                np.add.at(change, b, -1)
                gone = np.cumsum(change[:-1]) > 0
                edge = np.diff(np.concatenate([[0], gone.view(np.int8), [0]]))
                start, end = np.flatnonzero(edge > 0), np.flatnonzero(edge < 0)
                removed.append(int(gone.sum()))
                pieces.append(len(start))
                runs.append([{"start": int(s), "end": int(e)} for s, e in zip(start, end)])
                sums.append(hashlib.sha256(text[~gone].tobytes()).hexdigest())
            yield pa.record_batch({
                "doc_id": rows.column(0), "n_bytes": pa.array(np.diff(offsets)),
                "n_removed": pa.array(removed, pa.int64()), "n_spans": pa.array(pieces, pa.int64()),
                "kept_sha256": pa.array(sums, pa.string()),
                "spans": pa.array(runs, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
            })

    return fn


RESULT = (
    "doc_id BIGINT, n_bytes BIGINT, n_removed BIGINT, n_spans BIGINT, kept_sha256 STRING,"
    " spans ARRAY<STRUCT<start: BIGINT, end: BIGINT>>"
)
KEYS = ["doc_id", "text_id"]


def _counted(rows: DataFrame) -> DataFrame:
    """One place for each hash of ranges, and how many places have it."""
    place = F.struct("doc_id", "text_id", "at", "first", "last")
    return rows.groupBy("core", "ctx").agg(F.count("*").alias("n"), F.min(place).alias("place"))


def _open(counted: DataFrame) -> DataFrame:
    """Distinct surroundings of a prefix, where it has several and some of them only once."""
    mixed = counted.groupBy("core").agg(F.min("ctx").alias("a"), F.max("ctx").alias("b"), F.min("n").alias("least"))
    # Stored first, so that the join can split a prefix with very many surroundings.
    mixed = materialize(mixed.where("a <> b AND least = 1").select("core"), "mixed")
    return counted.join(mixed, "core", "left_semi")


def _by_text(rows: DataFrame, name: str, *fields) -> DataFrame:
    """All rows of a text in one list; it is as long as the text at most. Equal rows count once."""
    return rows.groupBy(*KEYS).agg(F.collect_set(F.struct(*fields)).alias(name))


def _with_text(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """The texts that have marks, with them. A filter of fixed size keeps most others from moving."""
    bits = docs.sparkSession.sparkContext.broadcast(filter_bits(marks.select("text_id"), "text_id", FILTER))
    some = passing(docs, "text_id", bits, FILTER)
    marks = marks.select(F.col("doc_id").alias("i"), F.col("text_id").alias("t"), marks.columns[2])
    return some.join(marks, (F.col("text_id") == F.col("t")) & F.col("doc_id").eqNullSafe(F.col("i"))).select(
        "doc_id", "text_id", "text", marks.columns[2])


def repeated_spans(docs: DataFrame, id_column="doc_id", text="text", length=LENGTH, batches=BATCHES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the removed spans of each document."""
    if length < SPREAD + GRAM:
        raise ValueError(f"strings of {SPREAD + GRAM} bytes at least")
    spark = docs.sparkSession
    body = as_text(docs, text).cast("binary")
    docs = docs.select(
        F.col(id_column).cast("bigint").alias("doc_id"), F.xxhash64(body).alias("text_id"), body.alias("text"))
    found = materialize(docs.mapInArrow(_anchored(length), ANCHOR), "anchors")

    family = SuffixFamily(spark)
    batch = F.pmod(F.xxhash64("text_id"), F.lit(batches))
    matches = [family.add(found.where(batch == k)) for k in range(batches)]
    family.drop()
    core = matches[0]
    for more in matches[1:]:
        core = core.union(more)
    core = materialize(core.distinct(), "cores")  # so that the join can split a hot prefix
    bits = spark.sparkContext.broadcast(filter_bits(core, "core", FILTER))
    rows = passing(found.drop("head"), "core", bits, FILTER).join(core, "core", "left_semi")
    rows = materialize(rows, "candidates")

    counted = materialize(_counted(rows), "surroundings")
    twice = rows.join(counted.where("n > 1").select("core", "ctx"), ["core", "ctx"], "left_semi")
    spans = [twice.select(*KEYS, "first", "last")]
    still = _open(counted)
    for step in (STEP, 1):
        parts = _by_text(
            still.select("place.*", "core"), "parts", "at", "first", "last", "core")
        parts = materialize(parts, "parts")
        ranges = materialize(
            _with_text(docs, parts).mapInArrow(
                _ranges(length, step), RANGE.replace("first", "at BIGINT, first", 1)), "ranges")
        counted = materialize(_counted(ranges.select(*KEYS, "at", "first", "last", "core", "ctx")), "counted")
        twice = ranges.join(counted.where("n > 1").select("core", "ctx"), ["core", "ctx"], "left_semi")
        spans.append(twice.select(*KEYS, "first", "last"))
        still = _open(counted) if step > 1 else None

    every = spans[0]
    for more in spans[1:]:
        every = every.union(more)
    marks = materialize(_by_text(every, "spans", "first", "last"), "marks")
    cut = _with_text(docs, marks).mapInArrow(_cut(length), RESULT)
    bits = spark.sparkContext.broadcast(filter_bits(marks.select("text_id"), "text_id", FILTER))
    whole = passing(docs, "text_id", bits, FILTER, "hit")
    clean = whole.where("NOT hit").select("doc_id", "text")
    known = marks.select(F.col("doc_id").alias("i"), F.col("text_id").alias("t"))
    missed = whole.where("hit").join(
        known, (F.col("text_id") == F.col("t")) & F.col("doc_id").eqNullSafe(F.col("i")), "left_anti"
    ).select("doc_id", "text")
    clean = clean.union(missed)
    none = F.array().cast("array<struct<start: bigint, end: bigint>>")
    return cut.union(clean.select(
        "doc_id", F.octet_length("text").cast("bigint"), F.lit(0).cast("bigint"), F.lit(0).cast("bigint"),
        F.sha2("text", 256), none,
    ))


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_spans(load(spark, sf_dir, "documents")).drop("spans")
