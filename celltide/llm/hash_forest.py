"""Approximate nearest neighbours by cosine in a forest of hash prefixes.

Each of `TREES` trees gives every vector a long string of `BITS` signs of random projections. Of each tree
it is counted how many places each prefix of `TOP` signs has (a table of fixed size). A query descends to its
own prefix of `TOP` signs in each tree, and then ascends in all trees at once: the prefix that must match is
shortened until at least `places` of them share it, a share of the vectors, whatever their number. All
places that share it are compared exactly: places are dealt by prefix into buckets of about `BLOCK`, a prefix
of more places than that is spread over as many buckets as it needs, and a query is sent to every bucket that
its prefix reaches. Only the best ones leave a bucket.

Equal vectors are one class: the arrays hold it once, with the smallest vec_ids, as many as an answer can
hold; queries with equal vectors are answered together. So a vector that a third of all rows have is
one place of an array.

The index holds every row. Its recall against brute force is measured by `recall`; on vectors without
structure, as in the test tables, neighbours are hardly nearer than others, and the number of candidates
that 0.9 takes is a large part of the rows. So the work grows with queries times rows.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components take no part;
only vectors of one length are compared; rows with equal vec_id are no candidates of each other; with
fewer candidates than asked for, all are returned; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from celltide.llm.frames import load, materialize

TREES, BITS, BLOCK, CANDIDATES = 16, 48, 2048, 60_000
SHARE = 0.8  # places per vector that a query's prefix has in all trees together, CANDIDATES at least
TOP = 12  # signs of the longest prefix whose places are counted
NEAREST = 5
BUCKET = ["tree", "part", "block"]


def places(n):
    """How many places a query is compared with at least, in a table of n vectors."""
    return max(CANDIDATES, int(np.ceil(SHARE * n)))


def _valid(dtype):
    """Rows with usable vectors: vec_id, query, dim, vec (its components as bytes)."""

    def fn(batches):
        for batch in batches:
            vectors = batch.column(2)
            size = np.diff(vectors.offsets.to_numpy()) if len(vectors) else np.zeros(0, int)
            there = vectors.is_valid().to_numpy(zero_copy_only=False)
            flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(dtype)
            size = np.where(there, size, 0)
            bounds = np.concatenate([[0], np.cumsum(size)])
            odd = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
            some = np.concatenate([[0], np.cumsum(flat != 0)])
            a, b = bounds[:-1], bounds[1:]
            keep = (size > 0) & (odd[b] == odd[a]) & (some[b] > some[a])
            keep &= batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            rows = np.flatnonzero(keep)
            yield pa.record_batch({
                "vec_id": batch.column(0).take(pa.array(rows)), "query": batch.column(1).take(pa.array(rows)),
                "dim": pa.array(size[rows], pa.int32()),
                "vec": pa.array([(flat[a[i] : b[i]] + 0).tobytes() for i in rows], pa.binary()),
            })

    return fn


def units(vectors, dtype):
    """The vectors at length 1 in double precision, whatever their size."""
    x = np.frombuffer(b"".join(vectors), dtype).reshape(len(vectors), -1).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _keys(vectors, dims, dtype, trees, bits, planes):
    """(rows, dim, their strings in all trees) for each length of vectors."""
    for dim in np.unique(dims):
        at = np.flatnonzero(dims == dim)
        x = units(vectors.take(pa.array(at)).to_pylist(), dtype)
        if dim not in planes:
            planes[dim] = np.random.default_rng(int(dim)).standard_normal((dim, trees * bits))
        signs = (x @ planes[dim] > 0).reshape(len(at), trees, bits)
        yield at, int(dim), signs @ (1 << np.arange(bits - 1, -1, -1, dtype=np.int64))


def _counts(dtype, trees, bits, top):
    """tree, cell, n: how many places of a batch have each prefix of `top` signs."""

    def fn(batches):
        planes = {}
        for batch in batches:
            for _, dim, keys in _keys(batch.column(2), batch.column(1).to_numpy(), dtype, trees, bits, planes):
                cell = (keys >> (bits - top)) + (np.arange(trees) << top)
                cells, n = np.unique(cell, return_counts=True)
                yield pa.record_batch({
                    "tree": pa.array((cells >> top) + (dim << 16)), "cell": pa.array(cells & ((1 << top) - 1)),
                    "n": pa.array(n)})

    return fn


class Shape:
    """The trees of one length of vectors: places before each prefix, buckets of each prefix."""

    def __init__(self, counts, block):
        self.before = np.concatenate([np.zeros((len(counts), 1), np.int64), np.cumsum(counts, axis=1)], axis=1)
        self.part = self.before[:, :-1] // block  # prefixes that begin in one block share its buckets
        self.split = [np.maximum(1, -(-np.bincount(p, n).astype(np.int64) // block)) for p, n in zip(self.part, counts)]

    def depths(self, cells, top, least):
        """How long a prefix of each query (a row of prefixes, one of each tree) must match."""
        out, tree = np.zeros(len(cells), np.int64), np.arange(len(self.before))
        for d in range(1, top + 1):
            low = cells >> (top - d) << (top - d)
            n = (self.before[tree, low + (1 << (top - d))] - self.before[tree, low]).sum(axis=1)
            out[n >= least] = d
        return out


def _dealt(dtype, trees, bits, top, room, shapes, least=None):
    """The places of the trees by bucket, or, with `least`, the queries in all buckets they reach."""

    def fn(batches):
        planes, known = {}, {dim: Shape(table, room) for dim, table in shapes.value.items()}
        for batch in batches:
            for at, dim, keys in _keys(batch.column(2), batch.column(1).to_numpy(), dtype, trees, bits, planes):
                shape, cells = known[dim], keys >> (bits - top)
                rows, tree, part, block = [], [], [], []
                if least is None:
                    salt = np.frombuffer(b"".join(batch.column(0).take(pa.array(at)).to_pylist()), "<u8")[::2]
                    for t in range(trees):
                        p = shape.part[t][cells[:, t]]
                        rows.append(np.arange(len(at)))
                        tree.append(np.full(len(at), t))
                        part.append(p)
                        block.append((salt % shape.split[t][p].astype(np.uint64)).astype(np.int64))
                    depth = np.zeros(len(at), np.int64)
                else:
                    depth = shape.depths(cells, top, least[dim])
                    for i, d in enumerate(depth):
                        for t in range(trees):
                            low = cells[i, t] >> (top - d) << (top - d)
                            p = np.unique(shape.part[t][low : low + (1 << (top - d))])
                            k = shape.split[t][p]
                            part.append(np.repeat(p, k))
                            block.append(np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k))
                            rows.append(np.full(k.sum(), i))
                            tree.append(np.full(k.sum(), t))
                rows, tree, part, block = (np.concatenate(x) for x in (rows, tree, part, block))
                for lo in range(0, len(rows), 1 << 14):
                    r, t = rows[lo : lo + (1 << 14)], tree[lo : lo + (1 << 14)]
                    take = pa.array(at[r])
                    yield pa.record_batch({
                        "tree": pa.array(t + (dim << 16)), "part": pa.array(part[lo : lo + (1 << 14)]),
                        "block": pa.array(block[lo : lo + (1 << 14)]), "key": pa.array(keys[r, t]),
                        "c": batch.column(0).take(take), "vec": batch.column(2).take(take),
                        "low": batch.column(3).take(take), "ask": pa.array(np.full(len(r), least is not None)),
                        "depth": pa.array(depth[r].astype(np.int32))})

    return fn


def _depth(a, b, bits):
    """Length of the common prefix of each string of a with each of b."""
    x = a[:, None] ^ b[None, :]
    _, exponent = np.frexp(x.astype(np.float64))
    return bits - np.where(x == 0, 0, exponent)


def _searcher(dtype, bits, nearest):
    def fn(group: pd.DataFrame) -> pd.DataFrame:
        asks = group["ask"].to_numpy()
        rows, ask = group[~asks], group[asks]
        found = {"q": [], "c": [], "score": []}
        if len(ask) and len(rows):
            x, y = units(rows["vec"], dtype), units(ask["vec"], dtype)
            ids, low = rows["c"].to_numpy(), rows["low"].to_numpy()
            for lo in range(0, len(ask), 256):
                part = ask.iloc[lo : lo + 256]
                score = y[lo : lo + 256] @ x.T
                depth = _depth(part["key"].to_numpy(), rows["key"].to_numpy(), bits)
                score[depth < part["depth"].to_numpy()[:, None]] = -np.inf
                for q, s in zip(part["c"], score):
                    k = min(nearest + 1, len(s))
                    edge = -np.partition(-s, k - 1)[k - 1]
                    at = np.flatnonzero((s >= edge) & (s > -np.inf))
                    at = at[np.lexsort((low[at], -s[at]))][: nearest + 1]
                    found["q"] += [q] * len(at)
                    found["c"] += ids[at].tolist()
                    found["score"] += s[at].tolist()
        return pd.DataFrame(found)

    return fn


class HashForest:
    """The index of a table of vectors, and the search in it."""

    def __init__(self, table: DataFrame, queries, id_column="vec_id", vector="embedding", nearest=NEAREST,
                 trees=TREES, bits=BITS, block=BLOCK, candidates=None):
        self.nearest, self.trees, self.bits, self.block = nearest, trees, bits, block
        self.candidates, self.top = candidates, min(TOP, bits)
        element = table.schema[vector].dataType.elementType
        self.dtype = "<f4" if isinstance(element, T.FloatType) else "<f8"
        wide = F.col(vector) if self.dtype == "<f4" else F.col(vector).cast("array<double>")
        rows = table.select(
            F.col(id_column).cast("bigint").alias("vec_id"), F.coalesce(queries, F.lit(False)).alias("query"),
            wide.alias("v"))
        rows = rows.mapInArrow(
            _valid(self.dtype), "vec_id BIGINT, query BOOLEAN, dim INT, vec BINARY"
        ).withColumn("c", F.unhex(F.md5("vec")))
        self.rows = materialize(rows, "vectors")
        self.queries = self.rows.where("query").select("vec_id", "c").distinct()
        # Spark keeps only the first ranks of each class before the shuffle.
        rank = F.dense_rank().over(Window.partitionBy("c").orderBy("vec_id"))
        first = self.rows.drop("query").withColumn("rank", rank).where(F.col("rank") <= nearest + 1)
        classes = first.groupBy("c").agg(
            F.sort_array(F.collect_set("vec_id")).alias("ids"), F.first("dim").alias("dim"), F.first("vec").alias("vec"))
        asked = self.queries.select("c").distinct().withColumn("query", F.lit(True))
        self.classes = materialize(classes.join(asked, "c", "left").withColumn(
            "query", F.coalesce("query", F.lit(False))), "classes")
        self.spark: SparkSession = table.sparkSession

    def _shapes(self):
        """The places by prefix of each length of vectors, as plain arrays, and how many its queries must see."""
        counts = self.classes.select("c", "dim", "vec").mapInArrow(
            _counts(self.dtype, self.trees, self.bits, self.top), "tree BIGINT, cell BIGINT, n BIGINT")
        # At most 2**TOP rows for each tree.
        got = counts.groupBy("tree", "cell").agg(F.sum("n").alias("n")).toPandas()
        shapes, least = {}, {}
        for dim, rows in got.groupby(got["tree"] // (1 << 16)):
            table = np.zeros((self.trees, 1 << self.top), np.int64)
            table[rows["tree"] % (1 << 16), rows["cell"]] = rows["n"]
            shapes[dim] = table
            least[dim] = places(int(table[0].sum())) if self.candidates is None else self.candidates
        return shapes, least

    def search(self) -> DataFrame:
        """query_id, rank, vec_id, score: the nearest ones found for each query."""
        shapes, least = self._shapes()
        shapes = self.spark.sparkContext.broadcast(shapes)
        schema = "tree BIGINT, part BIGINT, block BIGINT, key BIGINT, c BINARY, vec BINARY, low BIGINT, ask BOOLEAN, depth INT"
        body = self.classes.select("c", "dim", "vec", F.col("ids")[0].alias("low"), "query")
        rows, asks = (
            x.mapInArrow(_dealt(self.dtype, self.trees, self.bits, self.top, self.block, shapes, n), schema)
            for x, n in ((body, None), (body.where("query"), least)))
        found = rows.union(asks).groupBy(*BUCKET).applyInPandas(
            _searcher(self.dtype, self.bits, self.nearest), "q BINARY, c BINARY, score DOUBLE")
        found = materialize(found.groupBy("q", "c").agg(F.max("score").alias("score")), "found")
        best = Window.partitionBy("q").orderBy(F.desc("score"), F.col("ids")[0])
        kept = found.join(self.classes.select("c", "ids"), "c").withColumn(
            "r", F.row_number().over(best)).where(F.col("r") <= self.nearest + 1)
        kept = materialize(kept.select("q", "score", "ids"), "kept")
        answers = self.queries.join(kept, F.col("c") == F.col("q")).select(
            F.col("vec_id").alias("query_id"), "score", F.explode("ids").alias("vec_id")).where("vec_id <> query_id")
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return answers.distinct().withColumn("rank", F.row_number().over(order)).where(
            F.col("rank") <= self.nearest).select("query_id", "rank", "vec_id", "score")


def recall(found: DataFrame, exact: DataFrame) -> float:
    """The share of the exact answers that were found."""
    both = exact.select("query_id", "vec_id").join(found.select("query_id", "vec_id"), ["query_id", "vec_id"])
    return both.count() / max(exact.count(), 1)


def op3_hash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = load(spark, sf_dir, "embeddings")
    return HashForest(table, F.col("vec_id") % 50 == 0).search()
