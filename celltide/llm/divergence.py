"""Audit of how sources differ in their words, over a minimal acyclic transducer of the vocabulary.

1. Documents of each language that hold a term are counted; the terms in enough of them are kept.
2. The kept terms are sorted by ranges of their bytes, which gives each its lexicographic ordinal in its
   language. From every `SHARD` sorted terms one task builds a minimal acyclic transducer: states with the
   same future are one state, and each arc says how many terms lie before it, so a walk ends with the ordinal.
3. All texts stream through the transducers again, whole chunks at a time, one byte of every word per step.
   What comes out are ordinals, counted by source. Transducers are broadcast in rounds of at most `ROUND`
   bytes; a vocabulary beyond one round reads the texts once for each.
4. Probabilities are whole numbers. Terms are compared with the language's; sources with each other by
   blocks of ordinals, of which each returns only its sums for the pairs. Ties go by ordinal.

Defined cases: null text, language and source are empty ones; documents of one id are documents each;
a group without terms is compared like any other; a language without kept terms has pairs of value 0 and no
terms; a long text is one chunk; other columns play no part; an empty table gives an empty one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from celltide.llm.frames import as_text, load, materialize, shuffles
from celltide.llm.textops import lower, texts, words

LEAST_DOCUMENTS, LONGEST = 3, 200
SHARD = 1 << 19  # terms of one transducer
ROUND = 1 << 26  # bytes of transducers that a pass over the texts carries
CELLS = 1 << 17  # terms times sources of one block of comparisons
HELD = 1 << 20  # counters a task holds before it passes them on


def gaps():
    """True for the bytes that separate terms: ASCII without letters."""
    lut = np.zeros(256, bool)
    lut[:128] = True
    lut[65:91] = lut[97:123] = False
    return lut


def strings(data, start, end, apart):
    """The words as an Arrow array, without a loop: all their bytes stand one after the other."""
    at = np.zeros(len(start) + 1, np.int64)
    np.cumsum(end - start, out=at[1:])
    return pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(at), pa.py_buffer(data[~apart[data]]))


def _document_counts(batches):
    apart, fold = gaps(), lower()
    for rows, data, offsets in texts(batches):
        data = fold[data]
        start, end, row = words(data, offsets, apart)
        if not len(start):
            continue
        coded = strings(data, start, end, apart).dictionary_encode()
        code, size = coded.indices.to_numpy().astype(np.int64), len(coded.dictionary)
        lang = rows.column("lang").dictionary_encode()
        pair = np.unique(row * size + code)
        key, n = np.unique(lang.indices.to_numpy().astype(np.int64)[pair // size] * size + pair % size, return_counts=True)
        yield pa.RecordBatch.from_arrays([
            lang.dictionary.take(pa.array(key // size)).cast(pa.string()),
            coded.dictionary.take(pa.array(key % size)).cast(pa.string()), pa.array(n)], ["lang", "term", "n"])


def vocabulary(docs: DataFrame, least=LEAST_DOCUMENTS, shard=SHARD) -> DataFrame:
    """lang, term, ordinal, shard of the kept terms; `docs` has lang and text without nulls."""
    counted = docs.select("lang", "text").mapInArrow(_document_counts, "lang STRING, term STRING, n BIGINT")
    kept = materialize(counted.groupBy("lang", "term").agg(F.sum("n").alias("n")).where(
        F.col("n") >= least).select("lang", "term"), "kept")
    ranges = kept.repartitionByRange(shuffles(docs.sparkSession), "lang", "term").sortWithinPartitions("lang", "term")
    placed = materialize(ranges.select(
        "lang", "term", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), "sorted")
    runs = placed.groupBy("lang", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("lang").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("lang", "part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ordinal = F.col("before") + F.col("at") - F.col("first")
    return materialize(placed.join(runs, ["lang", "part"]).select(
        "lang", "term", ordinal.alias("ordinal"), F.floor(ordinal / shard).alias("shard")), "vocabulary")


def transducer(terms) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """From sorted distinct byte strings: arcs (state * 256 + byte, ascending), target, skipped; final states.

    The terms come in order, so a state is finished as soon as the next term leaves its path; a finished
    state is replaced by the one that has the same arcs, where there is one. The first state is the start.
    """
    known, states = {}, []  # signature to state; per state its arcs, whether it is final, its number of terms

    def finish(arcs, final):
        key = (final, tuple(arcs))
        if key not in known:
            known[key] = len(states)
            states.append((arcs, final, final + sum(states[t][2] for _, t in arcs)))
        return known[key]

    path, last = [([], False)], b""  # open states along the last term, each with its finished arcs
    for term in terms:
        shared = 0
        for a, b in zip(term, last):
            if a != b:
                break
            shared += 1
        for k in range(len(last), shared, -1):
            state = finish(*path.pop())
            path[-1][0].append((last[k - 1], state))
        path += [([], False) for _ in range(len(term) - shared)]
        path[-1] = (path[-1][0], True)
        last = term
    for k in range(len(last), 0, -1):
        state = finish(*path.pop())
        path[-1][0].append((last[k - 1], state))
    start = finish(*path.pop())
    # States are numbered from the start backwards, as it was finished last.
    n = len(states)
    key, target, skip = [], [], []
    for s in range(n - 1, -1, -1):
        arcs, final, _ = states[s]
        passed = int(final)
        for byte, t in arcs:
            key.append((n - 1 - s) * 256 + byte)
            target.append(n - 1 - t)
            skip.append(passed)
            passed += states[t][2]
    assert start == n - 1
    final = np.array([states[n - 1 - s][1] for s in range(n)], bool)
    return np.array(key, np.int64), np.array(target, np.int32), np.array(skip, np.int32), final


def _build(table: pa.Table) -> pa.Table:
    table = table.sort_by("ordinal")
    parts = transducer(t.encode() for t in table.column("term").to_pylist())
    blobs = [p.tobytes() for p in parts]
    return pa.table({
        "lang": table.column("lang").slice(0, 1).combine_chunks(), "base": table.column("ordinal").slice(0, 1).combine_chunks(),
        "bytes": pa.array([sum(map(len, blobs))]),
        **{k: pa.array([b], pa.binary()) for k, b in zip(("key", "target", "skip", "final"), blobs)}})


def transducers(vocabulary: DataFrame) -> DataFrame:
    """lang, base (ordinal of its first term), bytes, and the arrays of each shard's transducer."""
    return materialize(vocabulary.groupBy("lang", "shard").applyInArrow(
        _build, "lang STRING, base BIGINT, bytes BIGINT, key BINARY, target BINARY, skip BINARY, final BINARY"), "transducers")


def walk(arrays, data, start, end):
    """The ordinal of each word, or -1: all words take one step at a time."""
    keys, target, skip, final = arrays
    out = np.full(len(start), -1, np.int64)
    at = np.arange(len(start))
    state, passed, step = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64), 0
    while len(at) and len(keys):
        ended = end[at] - start[at] == step
        good = ended & final[state]
        out[at[good]] = passed[good]
        at, state, passed = at[~ended], state[~ended], passed[~ended]
        key = state * 256 + data[start[at] + step]
        arc = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        goes = keys[arc] == key
        at, arc = at[goes], arc[goes]
        state, passed, step = target[arc].astype(np.int64), passed[goes] + skip[arc], step + 1
    return out


def _recount(shared):
    def fn(batches):
        apart, fold, held = gaps(), lower(), []
        groups, names = {}, []
        shards = [(lang, base, tuple(np.frombuffer(b, k) for b, k in zip(blobs, (np.int64, np.int32, np.int32, bool))))
                  for lang, base, blobs in shared.value]

        def merged():
            group, ordinal, n = (np.concatenate(x) for x in zip(*held))
            order = np.lexsort((ordinal, group))
            group, ordinal, n = group[order], ordinal[order], n[order]
            first = np.flatnonzero(np.concatenate([[True], (group[1:] != group[:-1]) | (ordinal[1:] != ordinal[:-1])]))
            return group[first], ordinal[first], np.add.reduceat(n, first)

        def passed_on():
            group, ordinal, n = held[0]
            of = pa.array(group)
            return pa.RecordBatch.from_arrays([
                pa.array([x[0] for x in names], pa.string()).take(of), pa.array([x[1] for x in names], pa.string()).take(of),
                pa.array(ordinal), pa.array(n)], ["lang", "source", "ordinal", "n"])

        for rows, data, offsets in texts(batches):
            data = fold[data]
            start, end, row = words(data, offsets, apart)
            if not len(start):
                continue
            pairs = list(zip(rows.column("lang").to_pylist(), rows.column("source").to_pylist()))
            for p in pairs:
                if p not in groups:
                    groups[p] = len(names)
                    names.append(p)
            group = np.array([groups[p] for p in pairs], np.int64)[row]
            # Each word of the chunk takes its way once, however often it occurs.
            coded = strings(data, start, end, apart).dictionary_encode()
            code, size = coded.indices.to_numpy().astype(np.int64), len(coded.dictionary)
            some = np.zeros(size, np.int64)
            some[code] = np.arange(len(code))  # any one place of each word
            pair, n = np.unique(group * size + code, return_counts=True)
            group, code = pair // size, pair % size
            for lang, base, arrays in shards:
                mine = np.flatnonzero(np.array([name[0] == lang for name in names], bool)[group])
                asked = np.unique(code[mine])
                found = np.full(size, -1, np.int64)
                found[asked] = walk(arrays, data, start[some[asked]], end[some[asked]])
                ordinal = found[code[mine]]
                hit = ordinal >= 0
                if hit.any():
                    held.append((group[mine[hit]], ordinal[hit] + base, n[mine[hit]]))
            if sum(len(h[0]) for h in held) > HELD:
                held[:] = [merged()]
                if len(held[0][0]) > HELD // 2:
                    yield passed_on()
                    held.clear()
                    groups.clear()
                    names.clear()
        if held:
            held[:] = [merged()]
            yield passed_on()

    return fn


def recount(docs: DataFrame, shards: DataFrame, round_bytes=ROUND) -> DataFrame:
    """lang, source, ordinal, n: occurrences of the kept terms, by streaming the texts through the transducers."""
    spark = docs.sparkSession
    sizes = shards.select("lang", "base", "bytes").orderBy("lang", "base").collect()  # one row for each SHARD terms
    rounds, room = [], 0
    for s in sizes:
        if not rounds or s["bytes"] > room:
            rounds.append([])
            room = round_bytes
        rounds[-1].append((s["lang"], s["base"]))
        room -= s["bytes"]
    out = None
    for chosen in rounds:
        wanted = spark.createDataFrame(chosen, "lang STRING, base BIGINT")
        carried = [(r["lang"], r["base"], (bytes(r["key"]), bytes(r["target"]), bytes(r["skip"]), bytes(r["final"])))
                   for r in shards.join(wanted, ["lang", "base"]).collect()]  # round_bytes at most, or one shard
        shared = spark.sparkContext.broadcast(carried)
        part = docs.where(F.col("lang").isin(sorted({c[0] for c in chosen}))).select("lang", "source", "text").mapInArrow(
            _recount(shared), "lang STRING, source STRING, ordinal BIGINT, n BIGINT")
        part = materialize(part.groupBy("lang", "source", "ordinal").agg(F.sum("n").alias("n")), "recount")
        shared.destroy()
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = spark.createDataFrame([], "lang STRING, source STRING, ordinal BIGINT, n BIGINT")
    return out


def share(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(10^9 (n + 1) / (total + kept)), exact for any counts that fit a long."""
    return F.lit(1).cast("bigint") + F.call_function(
        "div", F.lit(1_000_000_000).cast("decimal(10,0)") * (n + 1).cast("decimal(20,0)"), (total + kept).cast("decimal(20,0)"))


def distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _pair_sums(left: pa.Table, right: pa.Table) -> pa.Table:
    """Sums over a block's terms of how far each source is from each other one."""
    src, base = right.column("src").to_numpy(), right.column("p0").to_numpy()
    base = base[np.argsort(src)]
    n, terms = len(base), int(right.column("terms")[0].as_py())
    block = np.repeat(base[None, :], terms, axis=0)
    if left.num_rows:
        block[left.column("at").to_numpy(), left.column("src").to_numpy()] = left.column("p").to_numpy()
    sums = np.zeros((n, n), np.int64)
    for k in range(n):
        apart = block[:, k : k + 1] - block
        sums[k] = (apart * apart // block).sum(axis=0)
    a, b = np.nonzero(~np.eye(n, dtype=bool))
    lang = pa.array([right.column("lang")[0].as_py()], pa.string()).take(pa.array(np.zeros(len(a), np.int64)))
    return pa.table({"lang": lang, "src": pa.array(a), "other": pa.array(b), "value": pa.array(sums[a, b])})


def audit(docs: DataFrame, least=LEAST_DOCUMENTS, longest=LONGEST, shard=SHARD, round_bytes=ROUND, cells=CELLS) -> DataFrame:
    """lang, source, part, item, value, rank; `docs` has text, lang and source."""
    rows = docs.select(*[as_text(docs, c).alias(c) for c in ("lang", "source", "text")])
    known = vocabulary(rows, least, shard)
    counts = recount(rows, transducers(known), round_bytes)
    kept = known.groupBy("lang").agg(F.count("*").alias("kept"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    by_name = Window.partitionBy("lang").orderBy("source")
    zero = F.lit(0).cast("bigint")
    groups = materialize(
        rows.groupBy("lang", "source").agg(F.count("*").alias("docs")).join(totals, ["lang", "source"], "left").join(
            kept, "lang", "left").select(
            "lang", "source", F.coalesce("total", zero).alias("total"), F.coalesce("kept", zero).alias("kept"),
            (F.row_number().over(by_name) - 1).cast("bigint").alias("src"),
            F.count("*").over(Window.partitionBy("lang")).alias("sources"),
            F.sum(F.coalesce("total", zero)).over(Window.partitionBy("lang")).alias("all")), "groups")
    told = materialize(
        counts.join(groups, ["lang", "source"]).select(
            "lang", "source", "ordinal", "src", share(F.col("n"), F.col("total"), F.col("kept")).alias("p"),
            F.sum("n").over(Window.partitionBy("lang", "ordinal")).alias("n"), "all", "kept", "sources"), "shares")

    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ordinal")
    q = told.withColumn("q", share(F.col("n"), F.col("all"), F.col("kept"))).where("p > q")
    terms = q.withColumn("value", distance(F.col("p"), F.col("q"))).withColumn(
        "rank", F.row_number().over(best)).where(F.col("rank") <= longest).select("lang", "source", "ordinal", "value", "rank")
    terms = terms.join(known.select("lang", "ordinal", "term"), ["lang", "ordinal"]).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")

    size = F.greatest(F.call_function("div", F.lit(cells).cast("bigint"), F.col("sources")), F.lit(1).cast("bigint"))
    block = F.call_function("div", F.col("ordinal"), size)
    left = told.select("lang", block.alias("block"), (F.col("ordinal") % size).alias("at"), "src", "p")
    last = F.call_function("div", F.greatest(F.col("kept") - 1, zero), size)
    right = groups.where("sources > 1").withColumn("size", size).select(
        "lang", "src", "kept", "size", F.when(F.col("kept") > 0, share(zero, F.col("total"), F.col("kept"))).otherwise(
            F.lit(1).cast("bigint")).alias("p0"), F.explode(F.sequence(zero, last)).alias("block")).select(
        "lang", "block", "src", "p0", F.least(F.col("size"), F.col("kept") - F.col("block") * F.col("size")).alias("terms"))
    left = left.join(right.select("lang", "block").distinct(), ["lang", "block"], "left_semi")
    sums = left.groupBy("lang", "block").cogroup(right.groupBy("lang", "block")).applyInArrow(
        _pair_sums, "lang STRING, src BIGINT, other BIGINT, value BIGINT")
    sums = sums.groupBy("lang", "src", "other").agg(F.sum("value").alias("value"))
    names = groups.select("lang", "src", "source")
    pairs = sums.join(names, ["lang", "src"]).join(
        names.select("lang", F.col("src").alias("other"), F.col("source").alias("item")), ["lang", "other"])
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    return pairs.unionByName(terms)


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(load(spark, sf_dir, "documents"))


ORACLE = rf"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), t AS (SELECT id, lang, source, unnest(terms) AS term FROM d),
kept AS (
  SELECT lang, term FROM (SELECT DISTINCT id, lang, term FROM t) GROUP BY lang, term HAVING count(*) >= {LEAST_DOCUMENTS}
), counts AS (
  SELECT t.lang, t.source, t.term, count(*)::HUGEINT AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL
), sizes AS (SELECT lang, count(*)::HUGEINT AS v FROM kept GROUP BY lang),
groups AS (
  SELECT g.lang, g.source, coalesce(v, 0) AS v, coalesce((SELECT sum(n) FROM counts c WHERE c.lang = g.lang AND c.source = g.source), 0)::HUGEINT AS total
  FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN sizes USING (lang)
), p AS (
  SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(n, 0) + 1)) // (total + v) AS p
  FROM groups g JOIN kept k USING (lang) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), totals AS (SELECT lang, sum(n)::HUGEINT AS total FROM counts GROUP BY lang),
q AS (
  SELECT c.lang, c.term, 1 + (1000000000::HUGEINT * (sum(n)::HUGEINT + 1)) // (any_value(t.total) + any_value(v)) AS q
  FROM counts c JOIN totals t USING (lang) JOIN sizes USING (lang) GROUP BY c.lang, c.term
), term AS (
  SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS value FROM p JOIN q USING (lang, term)
  WHERE n > 0 AND p > q
), pair AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // y.p) AS value
    FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL
  ) s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
)
SELECT lang, source, part, item, value::BIGINT AS value,
  (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank
FROM (SELECT * FROM term UNION ALL SELECT * FROM pair)
QUALIFY part = 'pair' OR rank <= {LONGEST}
"""
