"""Quality classifier: labelled neighbours vote, by cosine in a latent space.

A text is described by counts of hashed words and of hashed trigrams of character classes (which
letter case, digit, sign or blank follows which) and by how far its words repeat. Latent semantic
analysis of a bounded sample of labelled documents (`SAMPLE` of each label, those with the least hash)
gives a space of `TOPICS` dimensions. The sample's vectors are broadcast, and every document is compared
with all of them in blocks. Its score is the mean label of the `NEIGHBOURS` nearest ones, weighted by
similarity, where the labels count as if they were as frequent in the sample as among all labels.

Labels are learned only from documents whose crc32(doc_id as text) mod 5 is not 0, and the sample is the
only thing that is not taken over all rows.

Defined cases: a text without any feature (null, empty) gets the share of label 1; without labels every
score is 0.5, with one label alone that label; labels that are null or have no document are not used,
of several labels of a document each counts; documents without doc_id are scored and never learned from.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from celltide.llm import textops
from celltide.llm.frames import as_text, load, materialize, packed

SAMPLE, TOPICS, NEIGHBOURS, POWER = 2000, 48, 15, 4
WORD_BITS, SHAPE_BITS = 12, 11
WIDTH = (1 << WORD_BITS) + (1 << SHAPE_BITS) + 16
THRESHOLD, FOLDS = 0.3, 5
ROWS, BLOCK = 4096, 64  # texts scored, and texts counted, at a time: one has `WIDTH` counts, however short it is
MODEL = "kind STRING, rows INT, data BINARY"


def _classes():
    """Lower case, upper case, digit, blank, line feed, and each sign for itself."""
    out = np.zeros(256, np.uint64)
    out[:] = np.arange(256) + 8
    out[[*range(97, 123), *range(128, 256)]] = 1
    out[65:91], out[48:58], out[[32, 9]] = 2, 3, 4
    return out


def features(data, offsets, hasher, spaces, fold, classes):
    """One row of feature counts for each text."""
    n = len(offsets) - 1
    out = np.zeros((n, WIDTH), np.float32)
    if not len(data):
        return out
    lower = fold[data]
    start, end, row = textops.words(lower, offsets, spaces)
    flat = out.reshape(-1)
    if len(start):
        w = hasher.load(lower).of(start, end)
        at = row * WIDTH + (w >> np.uint64(64 - WORD_BITS)).astype(np.int64)
        flat += np.bincount(at, minlength=flat.size).astype(np.float32)
        # How many words are the same as the one before, and how many are new in the text.
        same = np.bincount(row[1:][(w[1:] == w[:-1]) & (row[1:] == row[:-1])], minlength=n)
        order = np.lexsort((w, row))
        fresh = np.ones(len(w), bool)
        fresh[1:] = (w[order][1:] != w[order][:-1]) | (row[order][1:] != row[order][:-1])
        many = np.bincount(row, minlength=n)
        kinds = np.bincount(row[order], weights=fresh, minlength=n)
        full = many > 0
        at = WIDTH - 16 + (8 * (1 - kinds[full] / many[full])).astype(int).clip(0, 7)
        out[np.flatnonzero(full), at] = many[full]
        at = WIDTH - 8 + (8 * same[full] / many[full]).astype(int).clip(0, 7)
        out[np.flatnonzero(full), at] = many[full]
    c = classes[data]
    if len(c) > 2:
        code = textops.mix(c[:-2] * np.uint64(1 << 20) + c[1:-1] * np.uint64(1 << 10) + c[2:])
        owner = np.repeat(np.arange(n), np.diff(offsets))
        inside = owner[2:] == owner[:-2]
        at = owner[:-2] * WIDTH + (1 << WORD_BITS) + (code >> np.uint64(64 - SHAPE_BITS)).astype(np.int64)
        flat += np.bincount(at[inside], minlength=flat.size).astype(np.float32)
    return out


def _parts(batches, most):
    """As `textops.texts`, of at most so many texts each."""
    for rows, data, offsets in textops.texts(batches):
        for lo in range(0, len(rows), most):
            at = offsets[lo : lo + most + 1]
            yield rows.slice(lo, most), data[at[0] : at[-1]], at - at[0]


def _counts(data, offsets, tools):
    """The features of all texts, made of a block of them at a time."""
    out = np.zeros((len(offsets) - 1, WIDTH), np.float32)
    for lo in range(0, len(out), BLOCK):
        at = offsets[lo : lo + BLOCK + 1]
        out[lo : lo + BLOCK] = features(data[at[0] : at[-1]], at - at[0], *tools)
    return out


def _weighted(x, idf):
    """Logarithmic counts by rarity, in place; words and shapes have equal length, then the whole has 1."""
    cut = 1 << WORD_BITS
    for lo in range(0, len(x), BLOCK):
        some = x[lo : lo + BLOCK]
        np.log1p(some, out=some)
        some *= idf
        for part, size in ((some[:, :cut], 0.5), (some[:, cut:], 1.0)):
            norm = np.sqrt((part * part).sum(axis=1, keepdims=True))
            part *= size / np.maximum(norm, 1e-12)
    return x


def _unit(x):
    return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-12)


def _fit(topics):
    """One task makes the model of the bounded sample: rarity, topics, vectors and labels."""

    def fn(batches):
        tools = textops.Hasher(), textops.is_space(), textops.lower(), _classes()
        counts, labels = [], []
        for rows, data, offsets in _parts(batches, BLOCK):
            part = features(data, offsets, *tools)
            at = np.flatnonzero(part)  # most counts are 0
            counts.append((len(rows), at, part.ravel()[at]))
            labels.append(rows.column(1).to_numpy())
        if not counts:
            return
        x, y = np.zeros((sum(n for n, _, _ in counts), WIDTH), np.float32), np.concatenate(labels).astype(np.float64)
        lo = 0
        for n, at, some in counts:
            x[lo : lo + n].ravel()[at] = some
            lo += n
        idf = np.log((1 + len(x)) / (1 + (x > 0).sum(axis=0))).astype(np.float32) + np.float32(0.05)
        x = _weighted(x, idf)
        k = min(topics, len(x))
        base = np.random.default_rng(1).standard_normal((WIDTH, k + 16)).astype(np.float32)
        for _ in range(5):
            base, _ = np.linalg.qr(x.T @ (x @ base))
        _, _, turn = np.linalg.svd(x @ base, full_matrices=False)
        space = (base @ turn.T[:, :k]).astype(np.float32)
        vectors = _unit(x @ space).astype(np.float32)
        for name, a in (("idf", idf), ("space", space), ("vectors", vectors), ("labels", y)):
            yield pa.record_batch({
                "kind": [name], "rows": pa.array([len(a)], pa.int32()), "data": pa.array([a.tobytes()])})

    return fn


def _scored(model, neighbours, power):
    def fn(batches):
        m = model.value
        tools = textops.Hasher(), textops.is_space(), textops.lower(), _classes()
        for rows, data, offsets in _parts(batches, ROWS):
            scores = np.full(len(rows), m["prior"])
            x = _counts(data, offsets, tools)
            full = np.flatnonzero(x.any(axis=1))
            if len(m["labels"]) and len(full):
                if len(full) < len(x):
                    x = x[full]
                near = _unit(_weighted(x, m["idf"]) @ m["space"]) @ m["vectors"].T
                x = None
                k = min(neighbours, near.shape[1])
                for lo in range(0, len(full), BLOCK):
                    some = near[lo : lo + BLOCK]
                    top = np.argpartition(-some, k - 1, axis=1)[:, :k]
                    weight = np.maximum(np.take_along_axis(some, top, axis=1), 0).astype(np.float64) ** power
                    weight *= m["weights"][top]
                    total = weight.sum(axis=1)
                    vote = (weight * m["labels"][top]).sum(axis=1) / np.maximum(total, 1e-300)
                    scores[full[lo : lo + BLOCK]] = np.where(total > 0, vote, m["prior"])
            yield rows.select([0]).append_column("score", pa.array(np.clip(scores, 0, 1)))

    return fn


def held_out(column):
    """Whether a document is kept from learning."""
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


class NeighbourVote:
    """A classifier of whole texts. `fit` learns, `score` adds a column to any documents."""

    def __init__(self, sample=SAMPLE, topics=TOPICS, neighbours=NEIGHBOURS, power=POWER):
        self.sample, self.topics, self.neighbours, self.power = sample, topics, neighbours, power
        self.model = None

    def fit(self, docs: DataFrame, labels: DataFrame, label="quality", id_column="doc_id", text="text"):
        known = labels.select(F.col(id_column).alias("i"), F.col(label).cast("int").alias("y")).where(
            F.col("y").isin(0, 1) & F.col("i").isNotNull() & ~held_out(F.col("i")))
        share = known.agg(F.avg("y").alias("p")).first()["p"]
        order = [F.xxhash64("i"), "i"]
        some = [known.where(F.col("y") == y).orderBy(*order).limit(self.sample) for y in (0, 1)]
        some = materialize(some[0].union(some[1]), "sample")  # 2 * sample rows at most
        body = docs.select(F.col(id_column).alias("d"), as_text(docs, text).alias("text"))
        learn = body.join(F.broadcast(some), body["d"] == some["i"]).select("text", "y", "i")
        learn = learn.orderBy("i", "y", "text").coalesce(1)
        rows = materialize(learn.select("text", "y").mapInArrow(_fit(self.topics), MODEL), "model").collect()
        part = {r["kind"]: (r["rows"], bytes(r["data"])) for r in rows}
        self.model = {"prior": 0.5 if share is None else float(share), "labels": np.zeros(0)}
        if part:
            n = part["labels"][0]
            y = np.frombuffer(part["labels"][1], np.float64)
            ones = y.mean()
            p = self.model["prior"]
            balance = np.where(y > 0, p / max(ones, 1e-9), (1 - p) / max(1 - ones, 1e-9))
            self.model |= {
                "idf": np.frombuffer(part["idf"][1], np.float32),
                "space": np.frombuffer(part["space"][1], np.float32).reshape(WIDTH, -1),
                "vectors": np.frombuffer(part["vectors"][1], np.float32).reshape(n, -1),
                "labels": y, "weights": balance,
            }
        return self

    def score(self, docs: DataFrame, text="text") -> DataFrame:
        """row, score: the documents and how likely label 1 is for each."""
        shared = docs.sparkSession.sparkContext.broadcast(self.model)
        rows = packed(docs, text=as_text(docs, text))
        schema = rows.select("row").schema.add("score", "double")
        return rows.mapInArrow(_scored(shared, self.neighbours, self.power), schema)


def accepted(docs: DataFrame, labels: DataFrame, threshold=THRESHOLD, **options) -> DataFrame:
    """The documents whose score reaches the threshold."""
    model = NeighbourVote(**options).fit(docs, labels)
    return model.score(docs).where(F.col("score") >= threshold).select("row.*")


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    model = NeighbourVote().fit(docs, load(spark, sf_dir, "labels"))
    return model.score(docs.select("doc_id", "text")).select(
        "row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )
