"""Ranked lexical search over an index whose strata are documents of equal normaliser.

Building: a first pass counts documents by their number of terms, which gives the documents N, all terms L,
the normaliser m of every document and the size of each stratum. A second pass moves each document's
distinct terms to its stratum. A stratum is cut into blocks of some `BLOCK` terms, whatever its size, so a
length that a third of all documents have is many blocks. A block is one row: its documents, its terms, and
for each term the postings of each tf.

Searching: the impact of a tf is a matter of m and tf alone, so it is computed once for each tf of a block.
The greatest impacts of an item's terms bound what a block can give the item. A task visits the blocks it
holds in the order of these bounds and leaves out the items whose bound is below what they have already.
Items are taken in sets of some `ENTRIES` terms, which meet all blocks; only a task's best of each item
leave it. Weights come from exact counts of documents.

Defined cases: null and empty texts and texts without terms are in no stratum and count nowhere; documents
of one id, or of none, are documents each (no id comes before the others among equal scores; the id -2**63
is read as none); rows of one item_id are one item, which has the terms of all of them; an item without
terms, or whose terms no document has, gets no rows; long texts are read whole; other columns play no part;
an empty table of documents or items gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from celltide.llm.divergence import strings
from celltide.llm.frames import as_text, load, materialize
from celltide.llm.textops import lower, texts, words

BLOCK = 1 << 17  # terms, with repeats, of a block
ENTRIES = 1 << 18  # terms of the items that are searched together
PAIRS = 1 << 22  # postings that are added up at a time
BEST = 10
NO_ID = -(1 << 63)

INDEX = (
    "m BIGINT, total BIGINT, ids ARRAY<BIGINT>, terms ARRAY<STRING>, "
    "list_term ARRAY<INT>, list_tf ARRAY<INT>, list_end ARRAY<INT>, doc ARRAY<INT>"
)


def gaps():
    """True for the bytes that separate terms: ASCII without digits and letters."""
    lut = np.zeros(256, bool)
    lut[:128] = True
    lut[48:58] = lut[65:91] = lut[97:123] = False
    return lut


def _lengths(batches):
    apart = gaps()
    for rows, data, offsets in texts(batches):
        _, _, row = words(data, offsets, apart)
        n, count = np.unique(np.bincount(row, minlength=len(rows)), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(n.astype(np.int64)), pa.array(count)], ["n", "documents"])


def _term_lists(batches):
    """Each document with a term: id, number of terms, its distinct terms and their counts."""
    apart, fold = gaps(), lower()
    for rows, data, offsets in texts(batches):
        data = fold[data]
        start, end, row = words(data, offsets, apart)
        if not len(start):
            continue
        coded = strings(data, start, end, apart).dictionary_encode()
        size = len(coded.dictionary)
        key, tf = np.unique(row * size + coded.indices.to_numpy().astype(np.int64), return_counts=True)
        of = key // size
        has, first = np.unique(of, return_index=True)
        ends = pa.array(np.append(first, len(key)).astype(np.int32))
        yield pa.RecordBatch.from_arrays([
            rows.column("id").take(pa.array(has)), pa.array(np.bincount(row, minlength=len(rows))[has].astype(np.int64)),
            pa.ListArray.from_arrays(ends, coded.dictionary.take(pa.array(key % size)).cast(pa.string())),
            pa.ListArray.from_arrays(ends, pa.array(tf.astype(np.int32)))], ["id", "n", "terms", "tf"])


def _block(table: pa.Table) -> pa.Table:
    """A block's documents by id, and its postings by term, tf and document."""
    table = table.combine_chunks()
    ids = table.column("id").combine_chunks().fill_null(NO_ID).to_numpy()
    order = np.argsort(ids, kind="stable")
    place = np.empty(len(ids), np.int64)
    place[order] = np.arange(len(ids))
    terms, tf = (table.column(c).combine_chunks() for c in ("terms", "tf"))
    doc = np.repeat(place, pc.list_value_length(terms).to_numpy(zero_copy_only=False))
    coded, tf = terms.flatten().dictionary_encode(), tf.flatten().to_numpy()
    code = coded.indices.to_numpy().astype(np.int64)
    by = np.lexsort((doc, tf, code))
    code, tf, doc = code[by], tf[by], doc[by]
    last = np.flatnonzero(np.append((code[1:] != code[:-1]) | (tf[1:] != tf[:-1]), True))

    def one(values, kind):
        return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, kind))

    return pa.table({
        "m": table.column("m").slice(0, 1).combine_chunks(), "total": pa.array([pc.sum(table.column("n")).as_py()]),
        "ids": one(ids[order], pa.int64()),
        "terms": pa.ListArray.from_arrays(pa.array([0, len(coded.dictionary)], pa.int32()), coded.dictionary),
        "list_term": one(code[last].astype(np.int32), pa.int32()), "list_tf": one(tf[last].astype(np.int32), pa.int32()),
        "list_end": one((last + 1).astype(np.int32), pa.int32()), "doc": one(doc.astype(np.int32), pa.int32())})


def build(docs: DataFrame, path: str | None = None, block=BLOCK) -> DataFrame:
    """The index of `docs` (doc_id, text), written to `path` or to the shared folder; read it back as parquet."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("bigint").alias("id"), as_text(docs, "text").alias("text"))
    lengths = rows.select("text").mapInArrow(_lengths, "n BIGINT, documents BIGINT")
    lengths = materialize(lengths.groupBy("n").agg(F.sum("documents").alias("documents")).where("n > 0"), "lengths")
    whole = lengths.agg(F.sum("documents"), F.sum(F.col("n") * F.col("documents"))).first()
    documents, total = whole[0] or 0, whole[1] or 1
    m = F.expr(f"10L + (90L * n * {documents}L) div {total}L")
    strata = lengths.groupBy(m.alias("m")).agg(F.sum(F.col("n") * F.col("documents")).alias("all"))
    cut = materialize(strata.select(
        "m", F.expr(f"cast(all div {block} AS INT) + 1").alias("blocks")).where("blocks > 1"), "strata")
    lists = rows.mapInArrow(_term_lists, "id BIGINT, n BIGINT, terms ARRAY<STRING>, tf ARRAY<INT>")
    # Where there are many, documents go to a block by their place in the input, so equal ids are spread too.
    lists = lists.withColumns({"m": m, "at": F.xxhash64(F.monotonically_increasing_id())}).join(cut, "m", "left")
    part = F.coalesce(F.pmod("at", F.col("blocks")), F.lit(0)).cast("int")
    blocks = lists.select("m", part.alias("part"), "id", "n", "terms", "tf").groupBy("m", "part").applyInArrow(_block, INDEX)
    if path is None:
        return materialize(blocks, "index")
    blocks.write.mode("overwrite").parquet(path)
    return spark.read.schema(blocks.schema).parquet(path)


def _rows(batch: pa.RecordBatch, vocabulary: pa.Array):
    """Each block of a batch: m, ids, and of the lists whose term is wanted: term, tf, start, end; the documents."""
    flat = {c: batch.column(c).flatten() for c in ("ids", "terms", "list_term", "list_tf", "list_end", "doc")}
    size = {c: np.concatenate([[0], np.cumsum(pc.list_value_length(batch.column(c)).to_numpy())]) for c in flat}
    wanted = pc.fill_null(pc.index_in(flat["terms"].cast(pa.large_string()), value_set=vocabulary), -1).to_numpy()
    values = {c: v.to_numpy() for c, v in flat.items() if c != "terms"}
    for r, m in enumerate(batch.column("m").to_pylist()):
        part = {c: v[size[c][r] : size[c][r + 1]] for c, v in values.items()}
        term = wanted[size["terms"][r] : size["terms"][r + 1]][part["list_term"]]
        end = part["list_end"].astype(np.int64)
        start = np.concatenate([[0], end[:-1]])
        keep = term >= 0
        yield m, part["ids"], term[keep], part["list_tf"][keep].astype(np.int64), start[keep], end[keep], part["doc"]


def _document_counts(shared):
    def fn(batches):
        names = shared.value
        vocabulary, n = pa.array(names, pa.large_string()), np.zeros(len(names), np.int64)
        for batch in batches:
            for _, _, term, _, start, end, _ in _rows(batch, vocabulary):
                np.add.at(n, term, end - start)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n[some])], ["term", "n"])

    return fn


def _spans(start, end):
    """The numbers from each start to its end, one after the other, and which pair each comes from."""
    size = end - start
    which = np.repeat(np.arange(len(size)), size)
    return np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size) + start[which], which


class _Best:
    """The best documents of each item so far, ties to the smaller id; `least` is what the last of them has."""

    def __init__(self, items, best):
        self.best, self.least = best, np.zeros(items, np.int64)
        self.kept = [(np.zeros(0, np.int64),) * 3]
        self.new = 0

    def add(self, item, score, doc):
        good = (score > 0) & (score >= self.least[item])
        self.kept.append((item[good], score[good], doc[good]))
        self.new += int(good.sum())
        if self.new > 2 * self.best * len(self.least):
            self.settle()

    def settle(self):
        item, score, doc = (np.concatenate(x) for x in zip(*self.kept))
        order = np.lexsort((doc, -score, item))
        item, score, doc = item[order], score[order], doc[order]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        full = rank == self.best - 1
        self.least[item[full]] = score[full]
        some = rank < self.best
        self.kept, self.new = [(item[some], score[some], doc[some])], 0
        return self.kept[0]


def _search(shared, best):
    def fn(batches):
        names, item, term, weight, items = shared.value  # entries by item
        vocabulary, found = pa.array(names, pa.large_string()), _Best(items, best)
        first = np.searchsorted(item, np.arange(items))  # every item has an entry
        for batch in batches:
            blocks = []
            for m, ids, of, tf, start, end, doc in _rows(batch, vocabulary):
                tfs, at = np.unique(tf, return_inverse=True)
                impact = (1_000_000_000 * tfs // (1000 * tfs + 8 * m))[at]
                top = np.zeros(len(names), np.int64)
                np.maximum.at(top, of, impact)
                bound = np.add.reduceat(weight * top[term], first)
                blocks.append((int(bound.max()), bound, top, ids, of, impact, start, end, doc))
            for _, bound, top, ids, of, impact, start, end, doc in sorted(blocks, key=lambda b: -b[0]):
                wanted = (bound > 0) & (bound >= found.least)
                entry = np.flatnonzero(wanted[item] & (top[term] > 0))
                if not len(entry):
                    continue
                # Lists of a term lie side by side, but terms are in the block's own order.
                order = np.argsort(of, kind="stable")
                low, high = (np.searchsorted(of[order], term[entry], side) for side in ("left", "right"))
                costs = np.concatenate([[0], np.cumsum((end - start)[order])])
                costs = np.cumsum(costs[high] - costs[low])
                done = 0
                while done < len(entry):
                    # Whole items, as many as fit.
                    before = costs[done - 1] if done else 0
                    upto = int(np.searchsorted(costs, before + PAIRS, "right"))
                    upto = max(upto, done + 1)
                    if upto < len(entry):
                        whole = int(np.searchsorted(item[entry], item[entry[upto]], "left"))
                        upto = whole if whole > done else int(np.searchsorted(item[entry], item[entry[done]], "right"))
                    some = slice(done, upto)
                    lists, by = _spans(low[some], high[some])
                    lists, by = order[lists], entry[some][by]
                    at, which = _spans(start[lists], end[lists])
                    key = item[by][which] * len(ids) + doc[at]
                    gain = (weight[by] * impact[lists])[which]
                    sort = np.argsort(key, kind="stable")
                    key, gain = key[sort], gain[sort]
                    begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
                    key = key[begin]
                    found.add(key // len(ids), np.add.reduceat(gain, begin), ids[key % len(ids)])
                    done = upto
        item, score, doc = found.settle()
        yield pa.RecordBatch.from_arrays([
            pa.array(item), pa.array(score), pa.array(doc, mask=doc == NO_ID)], ["item", "score", "doc_id"])

    return fn


def item_terms(items: DataFrame, item="item_id", text="text") -> DataFrame:
    """item (a struct with its id), term: each item's distinct terms."""
    rows = items.select(F.struct(F.col(item).alias("id")).alias("item"), as_text(items, text).alias("text"))
    low = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = F.regexp_extract_all(low, F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), F.lit(0))
    return rows.select("item", F.explode(F.array_distinct(found)).alias("term")).distinct()


def search(index: DataFrame, items: DataFrame, best=BEST, entries=ENTRIES) -> DataFrame:
    """item_id, rank, doc_id, score of the best documents of each item."""
    spark = index.sparkSession
    asked = materialize(item_terms(items), "items")
    total = index.agg(F.sum(F.size("ids"))).first()[0] or 0
    id_type = items.schema["item_id"].dataType.simpleString()
    schema = f"item_id {id_type}, doc_id BIGINT, score BIGINT"
    sets, out = -(-asked.count() // entries), None
    for k in range(sets):
        rows = asked.where(F.pmod(F.xxhash64("item"), F.lit(sets)) == k).collect()  # some `entries` rows
        if not rows:
            continue
        names = sorted({r["term"] for r in rows})
        place = {t: i for i, t in enumerate(names)}
        ids = list(dict.fromkeys(r["item"]["id"] for r in rows))
        number = {x: i for i, x in enumerate(ids)}
        shared = spark.sparkContext.broadcast(names)
        n = index.mapInArrow(_document_counts(shared), "term BIGINT, n BIGINT").groupBy("term").agg(F.sum("n").alias("n"))
        df = np.zeros(len(names), np.int64)
        for r in n.collect():  # one row for each of `names` at most
            df[r["term"]] = r["n"]
        weight = np.array([math.floor(1000 * math.log((2 * total + 2) / (2 * int(x) + 1))) for x in df], np.int64)
        pairs = np.array(sorted((number[r["item"]["id"]], place[r["term"]]) for r in rows), np.int64)
        asks = spark.sparkContext.broadcast((names, pairs[:, 0], pairs[:, 1], weight[pairs[:, 1]], len(ids)))
        found = index.mapInArrow(_search(asks, best), "item BIGINT, score BIGINT, doc_id BIGINT")
        told = spark.createDataFrame(list(enumerate(ids)), f"item BIGINT, item_id {id_type}")
        part = materialize(found.join(told, "item").select("item_id", "doc_id", "score"), "found")
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = spark.createDataFrame([], schema)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    return out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best).select(
        "item_id", "rank", "doc_id", "score")


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(build(load(spark, sf_dir, "documents")), load(spark, sf_dir, "benchmark"))


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), whole AS (SELECT count(*)::BIGINT AS docs, sum(len(terms))::BIGINT AS total FROM d WHERE len(terms) > 0),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), postings AS (
  SELECT row, any_value(doc_id) AS doc_id, term, count(*)::BIGINT AS tf, 100 - 90 + ((90 * any_value(n) * any_value(docs)) // any_value(total)) AS m
  FROM (SELECT row, doc_id, len(terms)::BIGINT AS n, unnest(terms) AS term FROM d), whole GROUP BY row, term
), weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM postings, whole GROUP BY term
), scores AS (
  SELECT item_id, row, any_value(doc_id) AS doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN postings USING (term) GROUP BY item_id, row
)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INT AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 10
"""
