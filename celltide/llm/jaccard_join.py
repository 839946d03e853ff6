"""N-gram Jaccard join: which documents are linked by near-equal sets of word shingles.

A size-aware heavy-light join. Sets of few shingles ("light") are joined by enumeration: two sets of
sizes n and m are linked exactly if they share some subset of the least overlap c(n, m), so each set
emits all its subsets of that size, and equal subsets meet in one group; no pair is ever formed. All
others ("heavy") are joined by scanning inverted lists of the rarest shingles of each set, as many as
any link must share one of, and comparing whole sets. The boundary is where enumeration would cost
more than the lists, by the sizes found in the data.

Only links that can still join two components are tested. Each list is first compared with two
of its members; then members outside the list's main component are compared with all of another
component. So a family of n near copies costs about n tests, and no link is lost. Before whole texts
meet, a pair is tested by parity sketches: one bit for each of two to four slots per shingle, set where an
odd number of shingles falls. Sketches differ in no more bits than the sets differ in members, so a pair
whose sketches differ in more than a link allows is none; only the others move their texts.

Defined cases: words are runs of bytes other than white space, A-Z in lower case; null and empty texts
and texts of white space have no shingles and are linked with nothing; a text of fewer words than a
shingle is one shingle of all its words; equal sets are linked; rows with equal doc_id stay apart as
rows; a row without doc_id keeps its links, but is never the name of a component. Shingles are
compared by 64-bit hashes.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from celltide.llm import textops
from celltide.llm.components import components
from celltide.llm.frames import (
    _in_filter,
    as_text,
    filter_bits,
    load,
    materialize,
    packed,
    passing,
)
from celltide.session import drop_scratch, scratch_paths, small_batches

WORDS, PERCENT = 5, 80
SLOTS = 22  # 2**22 slots tell how common a shingle is (4 MB); they order the lists, no more
WINDOW, OFTEN = 1 << 20, 3  # a task tells of shingles that this many of so many shingles in a row are
CHUNK = 1 << 18  # bytes of text worked on at a time; the arrays made of it are many times as large
FILTER = 24  # hash bits of the fixed-size filters (2 MB) that keep rows out of shuffles
LIST_COST = 20  # what a row of an inverted list costs, in rows of enumerated subsets
MOST_SUBSETS = 20_000  # no size is enumerated that takes more subsets


def overlap(n, m, percent=PERCENT):
    """Least number of common members that links sets of sizes n and m."""
    return -(-percent * (n + m) // (100 + percent))


def partners(n, percent=PERCENT):
    """Sizes that a set linked with one of size n can have."""
    return range(-(-percent * n // 100), 100 * n // percent + 1)


def prefix(n, percent=PERCENT):
    """Two linked sets have a common member among this many first ones of each, in any one order."""
    return n + percent * -n // 100 + 1 if n else 0


def subsets(n, percent=PERCENT):
    """Rows that a set of size n emits when joined by enumeration."""
    return sum(
        comb(n, c) for m in partners(n, percent)
        if (c := overlap(n, m, percent)) <= min(n, m)
    )


def boundary(sizes: dict[int, int], percent=PERCENT) -> int:
    """Largest size to enumerate, at the least total cost. `sizes`: number of sets by size."""
    best = cost = at = 0
    for n in range(1, max(sizes, default=0) + 1):
        if subsets(n, percent) > MOST_SUBSETS:
            break
        cost += sizes.get(n, 0) * (subsets(n, percent) - LIST_COST * prefix(n, percent))
        if cost < best:
            best, at = cost, n
    return at


def _tools():
    return textops.Hasher(), textops.is_space(), textops.lower()


def _signed(x):
    return pa.array(x.view(np.int64))


def _describe(size):
    """Set hash and size of each row, and the shingles that are common within a task."""

    def fn(batches):
        hasher, spaces, fold = _tools()
        held, size_held = np.empty(WINDOW, np.uint64), 0

        def common():
            seen = held[:size_held]
            seen.sort()  # in place
            again = seen[OFTEN - 1 :] == seen[: max(0, len(seen) - OFTEN + 1)]
            again[1:] &= seen[1 : len(again)] != seen[: max(0, len(again) - 1)]
            first = np.flatnonzero(again)
            token = seen[first]
            n = np.searchsorted(seen, token, "right") - first
            none = pa.nulls(len(n), pa.int64())
            return pa.record_batch({
                "doc_id": _signed(token), "text_id": none, "set_id": none, "n": pa.array(n, pa.int64())})

        for rows, data, at in textops.texts(batches, chunk=CHUNK):
            row, h = textops.shingles(data, at, size, hasher, spaces, fold)
            ids, n = textops.set_hash(row, h, len(rows))
            for lo in range(0, len(h), WINDOW):
                part = h[lo : lo + WINDOW]
                if size_held + len(part) > WINDOW:
                    yield common()
                    size_held = 0
                held[size_held : size_held + len(part)] = part
                size_held += len(part)
            yield pa.record_batch({
                "doc_id": rows.column(0), "text_id": rows.column(1), "set_id": _signed(ids),
                "n": pa.array(n, pa.int64()),
            })
        yield common()

    return fn


def _subsets_of(size, most, percent, wanted):
    """(subset, set, size) for each subset that a light set shares with any set it is linked to.

    Only of the texts that the filter passes.
    """

    def fn(batches):
        hasher, spaces, fold = _tools()
        for rows, data, at in textops.texts(_in_filter("text_id", None, FILTER, wanted)(batches), chunk=CHUNK):
            row, h = textops.shingles(data, at, size, hasher, spaces, fold)
            ids, n = textops.set_hash(row, h, len(rows))
            ends = textops.runs(row, len(rows))
            keys, sets, sizes = [], [], []
            for i in np.flatnonzero((n > 0) & (n <= most)):
                own = textops.mix(h[ends[i] : ends[i + 1]] * textops.BASE)
                k = int(n[i])
                for m in partners(k, percent):
                    c = overlap(k, m, percent)
                    if c > min(k, m) or m > most:
                        continue
                    gone = np.array(list(combinations(range(k), k - c)), np.int64)
                    rest = own.sum() - own[gone].sum(axis=1, dtype=np.uint64)
                    pair = np.array([min(k, m) * 100_003 + max(k, m)], np.uint64)
                    keys.append(textops.mix(rest + pair * textops.BASE2))
                    sets.append(np.full(len(rest), ids[i]))
                    sizes.append(np.full((len(rest), 2), (k, m)))
            if keys:
                sizes = np.concatenate(sizes)
                yield pa.record_batch({
                    "key": _signed(np.concatenate(keys)), "set_id": _signed(np.concatenate(sets)),
                    "n": pa.array(sizes[:, 0]), "m": pa.array(sizes[:, 1]),
                })

    return fn


def _rarest(size, level, least, percent, wanted=None):
    """(shingle, set, size, place) of the rarest shingles of each set, those that `wanted` may hold."""

    def fn(batches):
        hasher, spaces, fold = _tools()
        common = level.value
        bits = wanted.value if wanted is not None else None
        for rows, data, at in textops.texts(batches, chunk=CHUNK):
            row, h = textops.shingles(data, at, size, hasher, spaces, fold)
            if not len(h):
                continue
            ids, n = textops.set_hash(row, h, len(rows))
            order = common[(h >> np.uint64(64 - SLOTS)).astype(np.int64)].astype(np.uint64)
            order = (order << np.uint64(56)) | (h >> np.uint64(8))
            s = np.lexsort((order, row))
            row, h = row[s], h[s]
            place = np.arange(len(h)) - textops.runs(row, len(rows))[row]
            k = n[row]
            take = (k >= least) & (place < k + percent * -k // 100 + 1)
            if bits is not None:
                slot = (h >> np.uint64(64 - FILTER)).astype(np.int64)
                take &= (bits[slot // 60] >> (slot % 60)) & 1 > 0
            if take.any():
                row = row[take]
                yield pa.record_batch({
                    "token": _signed(h[take]), "set_id": _signed(ids[row]),
                    "n": pa.array(n[row]), "place": pa.array(place[take]),
                })

    return fn


def sketch(h):
    """The parity sketch of a set of hashes: a power of two of slots, at least two for each member.

    Half as many slots give the exclusive or of both halves, so sketches of different widths compare.
    """
    slots = max(64, 1 << (2 * len(h) - 1).bit_length())
    at = (textops.mix(h * textops.BASE2) & np.uint64(slots - 1)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=slots) & 1 > 0)


def differ(x, y):
    """Slots in which two sketches differ: at most the number of members that only one of the sets has."""
    while len(x) != len(y):
        long, short = (x, y) if len(x) > len(y) else (y, x)
        x, y = long[: len(long) // 2] ^ long[len(long) // 2 :], short
    return int(np.bitwise_count(x ^ y).sum())


def _sketches(size, wanted):
    """(set, size, sketch) of the texts that the filter passes."""

    def fn(batches):
        hasher, spaces, fold = _tools()
        for rows, data, at in textops.texts(_in_filter("text_id", None, FILTER, wanted)(batches), chunk=CHUNK):
            row, h = textops.shingles(data, at, size, hasher, spaces, fold)
            ids, n = textops.set_hash(row, h, len(rows))
            ends = textops.runs(row, len(rows))
            some = np.flatnonzero(n)
            yield pa.record_batch({
                "set_id": _signed(ids[some]), "n": pa.array(n[some], pa.int64()),
                "bits": pa.array([sketch(h[ends[i] : ends[i + 1]]).tobytes() for i in some], pa.binary()),
            })

    return fn


def _near(percent):
    """Pairs whose sketches a link allows."""

    def fn(batches):
        for batch in batches:
            a, b, n, m, x, y = batch.columns
            keep = [
                differ(np.frombuffer(p, np.uint8), np.frombuffer(q, np.uint8)) <= k + j - 2 * overlap(k, j, percent)
                for k, j, p, q in zip(n.to_pylist(), m.to_pylist(), x.to_pylist(), y.to_pylist())
            ]
            yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return fn


def _linked(size, percent):
    """Pairs of texts whose sets are linked."""

    def fn(batches):
        hasher, spaces, fold = _tools()
        for batch in batches:
            good = []
            b = pa.RecordBatch.from_arrays([batch.column(3)], ["text"])
            others = list(textops.texts([b], chunk=CHUNK))
            i = 0
            for rows, data, at in textops.texts([batch], "text_a", CHUNK):
                ra, ha = textops.shingles(data, at, size, hasher, spaces, fold)
                ends = textops.runs(ra, len(rows))
                for j in range(len(rows)):
                    good.append(ha[ends[j] : ends[j + 1]])
            keep = np.zeros(batch.num_rows, bool)
            for rows, data, at in others:
                rb, hb = textops.shingles(data, at, size, hasher, spaces, fold)
                ends = textops.runs(rb, len(rows))
                for j in range(len(rows)):
                    x, y = good[i], hb[ends[j] : ends[j + 1]]
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep[i] = both >= overlap(len(x), len(y), percent)
                    i += 1
            yield batch.select([0, 1]).filter(pa.array(keep))

    return fn


class JaccardJoin:
    """The join of one table. `result()` has a row for each document; `links()` the links tested."""

    def __init__(self, docs: DataFrame, id_column="doc_id", text="text", words=WORDS, percent=PERCENT):
        self.spark: SparkSession = small_batches(docs.sparkSession)
        self.words, self.percent = words, percent
        body = as_text(docs, text)
        self.docs = docs.select(
            F.col(id_column).cast("bigint").alias("doc_id"), F.xxhash64(body).alias("text_id"),
            body.alias("text"),
        )
        both = materialize(self.docs.mapInArrow(
            _describe(words), "doc_id BIGINT, text_id BIGINT, set_id BIGINT, n BIGINT"), "sets")
        self.sets = both.where("set_id IS NOT NULL")
        self.distinct = self.sets.where("n > 0").groupBy("set_id").agg(
            F.first("n").alias("n"), F.min("text_id").alias("text_id"))
        self.light = self._boundary()
        self.level = self.spark.sparkContext.broadcast(self._levels(both.where("set_id IS NULL")))
        self.tested = None

    def _boundary(self):
        top = next(n for n in range(1, 10**6) if subsets(n, self.percent) > MOST_SUBSETS)
        sizes = self.distinct.where(F.col("n") < top).groupBy("n").count().collect()
        return boundary({r["n"]: r["count"] for r in sizes}, self.percent)

    def _levels(self, counts):
        """How common the commonest shingle of each slot is, in steps of a quarter of a doubling."""
        sums = counts.groupBy("doc_id").agg(F.sum("n").alias("n"))
        slot = F.expr(f"shiftrightunsigned(doc_id, {64 - SLOTS})").alias("slot")
        got = sums.groupBy(slot).agg(F.max("n").alias("n")).toPandas()  # 2**SLOTS rows at most
        out = np.zeros(1 << SLOTS, np.float32)
        out[got["slot"].to_numpy(np.int64)] = got["n"].to_numpy()
        return (4 * np.log2(1 + out)).astype(np.uint8)

    def _light_edges(self):
        few = self.distinct.where(F.col("n") <= self.light)
        bits = self.spark.sparkContext.broadcast(filter_bits(few, "text_id", FILTER))
        # Filtered in the same function: a second one in the stage would be a second Python worker.
        rows = self.docs.select("text_id", "text").mapInArrow(
            _subsets_of(self.words, self.light, self.percent, bits),
            "key BIGINT, set_id BIGINT, n BIGINT, m BIGINT",
        ).distinct()
        rows = materialize(rows, "subsets")
        meet = rows.groupBy("key").agg(
            F.min("set_id").alias("low"), F.max("set_id").alias("high"),
            F.min("n").alias("short"), F.max(F.greatest("n", "m")).alias("long"), F.max("n").alias("longer"),
        ).where("low <> high AND (short = long OR short < longer)")
        return rows.join(meet.select("key", "low"), "key").select("set_id", "low").where("set_id <> low")

    def _lists(self):
        """The inverted lists with two distinct sets at least."""
        least = min(partners(self.light + 1, self.percent))
        schema = "token BIGINT, set_id BIGINT, n BIGINT, place BIGINT"
        found = self.docs.mapInArrow(_rarest(self.words, self.level, least, self.percent), schema)
        shared = materialize(
            found.groupBy("token").agg(F.min("set_id").alias("low"), F.max("set_id").alias("high"))
            .where("low <> high").select("token"), "shared")
        bits = self.spark.sparkContext.broadcast(filter_bits(shared, "token", FILTER))
        again = self.docs.mapInArrow(_rarest(self.words, self.level, least, self.percent, bits), schema)
        # The filter lets others through; they go before copies of a set are put together.
        lists = again.join(shared, "token").groupBy("token", "set_id").agg(
            *[F.first(c).alias(c) for c in ("n", "place")])
        return materialize(lists, "lists")

    def _possible(self, a, b):
        """Sizes and places that a link can have; at least one of the two is heavy."""
        p = self.percent
        n, m, i, j = (F.col(c) for c in (f"{a}.n", f"{b}.n", f"{a}.place", f"{b}.place"))
        # The first shingle that two sets share has all they share behind it, in both. It is enough
        # that they meet there.
        most = F.least(n - i, m - j)
        return (
            (F.greatest(n, m) > self.light) & (100 * F.least(n, m) >= p * F.greatest(n, m))
            & ((100 + p) * most >= p * (n + m)) & (F.col(f"{a}.set_id") != F.col(f"{b}.set_id"))
        )

    @staticmethod
    def _open(lists, roots):
        """The lists that more than one component has a part in."""
        rows = lists.join(roots.withColumnRenamed("node", "set_id"), "set_id", "left").select(
            "token", "set_id", "n", "place", F.coalesce("root", "set_id").alias("comp"))
        many = rows.groupBy("token").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1")).where("c0 <> c1")
        return materialize(rows.join(many.select("token"), "token", "left_semi"), "open")

    def _star_pairs(self, rows):
        """Each member of a list with the list's two centres: the text that edited copies were made
        from, as far as it can be told, and any other.

        An edited copy has shingles that no other set has. So the first centre is the set with the
        largest share of its rarest shingles in lists.
        """
        known = rows.groupBy("set_id").agg(F.count("*").alias("k"), F.first("n").alias("n"))
        length = F.col("n") - F.ceil(F.col("n") * self.percent / 100) + 1
        known = known.select("set_id", F.least(F.col("k") / length, F.lit(1.0)).alias("share"))
        rows = materialize(rows.join(known, "set_id"), "known")
        what = ["set_id", "n", "place", "comp"]
        centres = rows.groupBy("token").agg(
            F.max(F.struct("share", F.xxhash64("set_id").alias("o"), *what)).alias("c"),
            F.max(F.struct(F.xxhash64("set_id", F.lit(1)).alias("o"), *what)).alias("d"),
        ).select("token", F.explode(F.array(*[F.struct(*[F.col(f"{c}.{w}") for w in what]) for c in "cd"])).alias("c"))
        centres = materialize(centres.select("token", "c.*"), "centres")  # so that the join can split a list
        a, b = rows.alias("a"), centres.alias("b")
        return a.join(b, "token").where(self._possible("a", "b") & (F.col("a.comp") != F.col("b.comp")))

    def _rest_pairs(self, rows):
        """Each member outside a list's main component with all members of other components."""
        parts = rows.groupBy("token", "comp").agg(F.count("*").alias("k"))
        main = parts.groupBy("token").agg(
            F.max(F.struct("k", "comp")).alias("top"), F.count("*").alias("parts")
        ).where("parts > 1").select("token", F.col("top.comp").alias("main"))
        a = rows.join(main, "token").where("comp <> main").alias("a")
        return a.join(rows.alias("b"), "token").where(
            self._possible("a", "b") & (F.col("a.comp") != F.col("b.comp"))
            & ((F.col("b.comp") == F.col("a.main")) | (F.col("a.comp") < F.col("b.comp")))
        )

    def _test(self, candidates):
        """The linked ones of the candidate pairs; `candidates` makes the join that holds them."""
        seen = Observation()

        def store():
            pairs = candidates().select(
                F.least("a.set_id", "b.set_id").alias("a"), F.greatest("a.set_id", "b.set_id").alias("b")
            ).distinct()
            if self.tested is not None:
                pairs = pairs.join(self.tested, ["a", "b"], "left_anti")
            return materialize(pairs.observe(seen, F.count("*").alias("n")), "pairs")

        pairs = self._storing(store)
        if not seen.get["n"]:
            return None
        self.tested = pairs if self.tested is None else self.tested.union(pairs)
        return self._storing(lambda: self._whole(self._sketched(pairs)))

    def _picks(self, pairs):
        """(set, text) of one text of each set in the pairs, and the filter of these texts."""
        ids = pairs.select(F.col("a").alias("set_id")).union(pairs.select("b")).distinct()
        picks = materialize(
            self.distinct.join(ids, "set_id", "left_semi").select("set_id", "text_id"), "picks")
        return picks, self.spark.sparkContext.broadcast(filter_bits(picks, "text_id", FILTER))

    def _sketched(self, pairs):
        """The pairs that their sketches do not rule out."""
        _, bits = self._picks(pairs)
        found = self.docs.select("text_id", "text").mapInArrow(
            _sketches(self.words, bits), "set_id BIGINT, n BIGINT, bits BINARY")
        found = materialize(
            found.groupBy("set_id").agg(F.first("n").alias("n"), F.first("bits").alias("bits")), "sketches")
        a, b = (found.select(F.col("set_id").alias(c), F.col("n").alias(f"n_{c}"), F.col("bits").alias(f"bits_{c}"))
                for c in "ab")
        both = pairs.join(a, "a").join(b, "b").select("a", "b", "n_a", "n_b", "bits_a", "bits_b")
        return materialize(both.mapInArrow(_near(self.percent), "a BIGINT, b BIGINT"), "near")

    def _whole(self, pairs):
        """The linked pairs, by whole sets."""
        picks, bits = self._picks(pairs)
        found = passing(self.docs.select("text_id", "text"), "text_id", bits, FILTER)
        found = found.join(picks, "text_id").groupBy("set_id").agg(F.first("text").alias("text"))
        found = materialize(found, "texts")
        full = (
            pairs.join(found.select(F.col("set_id").alias("a"), F.col("text").alias("text_a")), "a")
            .join(found.select(F.col("set_id").alias("b"), F.col("text").alias("text")), "b")
            .select("a", "b", "text_a", "text")
        )
        return materialize(full.mapInArrow(_linked(self.words, self.percent), "a BIGINT, b BIGINT"), "links")

    def _storing(self, make):
        """What `make` returns, which it stores last; the tables it stored before that go."""
        before = set(scratch_paths())
        out = make()
        drop_scratch(self.spark, [p for p in scratch_paths() if p not in before][:-1])
        return out

    def roots(self) -> DataFrame:
        """(node, root): the components of all links, on set ids."""
        edges = self._storing(lambda: materialize(self._light_edges().toDF("a", "b"), "light"))
        lists = self._storing(self._lists)
        stars = self._test(lambda: self._star_pairs(lists.withColumn("comp", F.col("set_id"))))
        if stars is not None:
            edges = edges.union(stars)
        roots = components(edges)
        rest = self._test(lambda: self._rest_pairs(self._open(lists, roots)))
        return roots if rest is None else components(edges.union(rest))

    def result(self) -> DataFrame:
        """doc_id, text_id, root, n_shingles, component_id for each row of the input; root tells components apart."""
        sets = self.sets.join(
            self.roots().withColumnRenamed("node", "set_id"), "set_id", "left"
        ).withColumn("root", F.coalesce("root", "set_id"))
        least = sets.where("n > 0").groupBy("root").agg(F.min("doc_id").alias("component_id"))
        sets = materialize(sets, "rooted")
        return sets.join(least, "root", "left").select(
            "doc_id", "text_id", "root", F.col("n").alias("n_shingles"),
            F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        )


def jaccard_components(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_shingles, component_id: the least doc_id that links lead to, for each document."""
    return JaccardJoin(docs, **options).result().drop("text_id", "root")


def keep_one(docs: DataFrame, id_column="doc_id", text="text", **options) -> DataFrame:
    """The documents without near copies: of each component the one with the least doc_id.

    Of rows that agree in doc_id and in the whole text, one stays. Rows without doc_id come after
    all others. Documents without words are linked with nothing and all stay.
    """
    found = materialize(JaccardJoin(docs, id_column, text, **options).result(), "components")
    found = found.where("n_shingles > 0")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_id")
    first = materialize(found.groupBy("root").agg(
        F.count("*").alias("k"), F.min(order).alias("first")), "first")
    crowd = found.join(first.where("k > 1"), "root", "left_semi").select("text_id")
    bits = docs.sparkSession.sparkContext.broadcast(filter_bits(crowd, "text_id", FILTER))
    body = as_text(docs, text)
    rows = packed(
        docs, __id=F.col(id_column).cast("bigint"), __text=F.xxhash64(body),
        __none=~body.rlike(r"[^\x20\x09-\x0D]"),
    )
    rows = passing(rows, "__text", bits, FILTER, "__crowd")
    alone = rows.where("__none OR NOT __crowd").select("row.*")
    one = first.select(F.col("first.doc_id").alias("__i"), F.col("first.text_id").alias("__t"))
    chosen = rows.where("NOT __none AND __crowd").join(
        one, F.col("__id").eqNullSafe(F.col("__i")) & (F.col("__text") == F.col("__t"))
    ).dropDuplicates(["__id", "__text"]).select("row.*")
    return alone.unionByName(chosen)


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(load(spark, sf_dir, "documents"))

