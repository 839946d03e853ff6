"""Mixing sources to target weights by temperature.

Each source's share of all tokens is raised to an exponent between 0 (all sources equal) and 1 (as
they are). The exponent is found by sections of a shrinking interval, each evaluated by Spark over the
table of sources, which never leaves it: the least exponent that keeps to a repetition limit, or the
one that gives a target entropy; with both, the greater of the two.

The weights are realised as blocks. A block is one pass over a source in an order of its own, by a hash
of the seed, the block and the document. A source whose budget is e passes has floor(e) whole blocks and
the head of one more, up to its tokens. The head ends at a hash, which is found in two steps: sums by
slices of the hash range, then a running sum inside the one slice where the budget ends. So no source
is ever sorted as a whole.

Without a budget, there are as many tokens as give the least repeated source exactly one pass: every
document stays, and smaller sources repeat.

Defined cases: a null source is a source of its own; null and empty texts have no tokens and go with
whole blocks, and into a head while its budget lasts; equal rows have equal hashes, so they are in a head
together; a table with no tokens at all stays as it is; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from celltide.llm.frames import as_text, load, materialize, packed

REPEATS, SEED = 1.5, 7
POINTS, ROUNDS = 64, 7  # 64**-7 < 1e-12
SLICES = 4096
TOP = 15 * 4  # bits of a hash
WORD = r"[^\x20\x09-\x0D]+"


def source_tokens(docs: DataFrame, source="source", text="text") -> DataFrame:
    """source, tokens, docs."""
    rows = docs.select(F.col(source).cast("string").alias("source"), as_text(docs, text).alias("text"))
    return rows.groupBy("source").agg(
        F.sum(F.regexp_count("text", F.lit(WORD)).cast("bigint")).alias("tokens"), F.count("*").alias("docs"))


def _measures(shares: DataFrame, lo: float, hi: float):
    """For each point between lo and hi the entropy and the most passes over any source.

    Passes are counted beside the source that has the fewest.
    """
    at = F.lit(lo) + F.col("i") * F.lit((hi - lo) / POINTS)
    rows = shares.select("share", F.explode(F.sequence(F.lit(0), F.lit(POINTS))).alias("i"))
    rows = rows.withColumn("p", F.pow("share", at)).withColumn("e", F.pow("share", at - 1))
    found = rows.groupBy("i").agg(
        F.sum("p").alias("z"), F.sum(F.col("p") * F.log("p")).alias("plogp"),
        (F.max("e") / F.min("e")).alias("passes"),
    )
    return {r["i"]: (r["z"], r["plogp"], r["passes"]) for r in found.collect()}  # POINTS + 1 rows


def _least(shares: DataFrame, good) -> float:
    """The least exponent that is good, where all greater ones are too."""
    lo, hi = 0.0, 1.0
    for _ in range(ROUNDS):
        at = _measures(shares, lo, hi)
        if not at:
            return 1.0
        i = next((i for i in range(POINTS + 1) if good(*at[i])), POINTS)
        if i == 0:
            return lo
        width = (hi - lo) / POINTS
        lo, hi = lo + (i - 1) * width, lo + i * width
    return hi


def exponent(tokens: DataFrame, repeats: float | None = REPEATS, entropy: float | None = None) -> float:
    """The exponent for sources with `tokens`. `entropy` is in nats."""
    from math import log

    shares = tokens.where("tokens > 0").select(
        (F.col("tokens") / F.sum("tokens").over(Window.partitionBy(F.lit(0)))).alias("share"))
    out = 0.0 if repeats is not None or entropy is not None else 1.0
    if repeats is not None:
        out = max(out, _least(shares, lambda z, plogp, passes: passes <= repeats))
    if entropy is not None:
        out = max(out, _least(shares, lambda z, plogp, passes: log(z) - plogp / z <= entropy))
    return out


def weights(tokens: DataFrame, power: float, budget: float | None = None) -> DataFrame:
    """source, tokens, weight, passes. The sums over all sources are one row."""
    some = tokens.where("tokens > 0")
    total = some.agg(F.sum("tokens").alias("t")).first()["t"]
    share = F.col("tokens") / F.lit(float(total or 1))
    one = some.agg(F.sum(F.pow(share, F.lit(power))).alias("z"), F.max("tokens").alias("m")).first()
    z, most = one["z"] or 1.0, one["m"] or 1
    weight = F.when(F.col("tokens") > 0, F.pow(share, F.lit(power)) / F.lit(z)).otherwise(F.lit(0.0))
    if budget is None:
        # The largest source is passed over least, exactly once.
        passes = F.when(F.col("tokens") == most, 1.0).otherwise(
            F.pow(F.col("tokens") / F.lit(float(most)), F.lit(power - 1)))
    else:
        passes = weight * F.lit(float(budget)) / F.col("tokens")
    return tokens.select(
        "source", "tokens", weight.alias("weight"), F.when(F.col("tokens") > 0, passes).otherwise(1.0).alias("passes"))


def place(block, seed=SEED):
    """A document's place in a block: 60 bits of a hash that SQL engines share."""
    head = F.concat_ws("|", F.lit(str(seed)), block.cast("string"), F.col("source"), F.col("doc_id").cast("string"))
    return F.conv(F.substring(F.md5(head), 1, 15), 16, 10).cast("bigint")


def _heads(docs: DataFrame, quota: DataFrame, seed) -> DataFrame:
    """source, whole, last: whole blocks, and the hash up to which documents are in one more."""
    part = quota.select(
        F.col("source").alias("s"), F.floor("passes").alias("whole"),
        ((F.col("passes") - F.floor("passes")) * F.col("tokens")).alias("rest"))
    part = materialize(part, "quota")
    rows = docs.join(part, F.col("source").eqNullSafe(F.col("s"))).where("rest > 0").withColumn(
        "h", place(F.col("whole") + 1, seed))
    slice_ = F.shiftright("h", TOP - 12)
    sums = materialize(rows.groupBy("source", slice_.alias("slice")).agg(
        F.sum("tokens").alias("sum"), F.first("rest").alias("rest")), "slices")
    run = Window.partitionBy("source").orderBy("slice")  # SLICES rows of a source at most
    upto = sums.withColumn("upto", F.sum("sum").over(run))
    edge = upto.where("upto >= rest AND upto - sum < rest").select(
        F.col("source").alias("e"), F.col("slice").alias("edge"), (F.col("upto") - F.col("sum")).alias("before"))
    edge = materialize(edge, "edges")
    inside = rows.withColumn("slice", slice_).join(
        edge, F.col("source").eqNullSafe(F.col("e")) & (F.col("slice") == F.col("edge")))
    order = Window.partitionBy("source").orderBy("h").rangeBetween(Window.unboundedPreceding, -1)
    earlier = F.col("before") + F.coalesce(F.sum("tokens").over(order), F.lit(0))
    last = inside.withColumn("earlier", earlier).where("earlier < rest").groupBy("source").agg(
        F.max("h").alias("last"))
    last = last.select(F.col("source").alias("l"), "last")
    return part.join(last, F.col("s").eqNullSafe(F.col("l")), "left").select("s", "whole", "last")


def mix(docs: DataFrame, id_column="doc_id", source="source", text="text", repeats=REPEATS, entropy=None,
        budget=None, seed=SEED) -> DataFrame:
    """row, source, weight, block, place: each document once for each block it is in."""
    tokens = materialize(source_tokens(docs, source, text), "tokens")
    quota = weights(tokens, exponent(tokens, repeats, entropy), budget)
    rows = packed(
        docs, doc_id=F.col(id_column), source=F.col(source).cast("string"), text=as_text(docs, text))
    keys = rows.select(
        "doc_id", "source", F.regexp_count("text", F.lit(WORD)).cast("bigint").alias("tokens"))
    heads = materialize(_heads(keys, quota, seed), "heads")
    found = rows.drop("text").join(heads, F.col("source").eqNullSafe(F.col("s")))
    more = F.coalesce(place(F.col("whole") + 1, seed) <= F.col("last"), F.lit(False)).cast("bigint")
    found = found.withColumn("blocks", F.col("whole") + more).where("blocks > 0")
    found = found.withColumn("block", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("blocks"))))
    return found.select("row", "doc_id", "source", "block", place(F.col("block"), seed).alias("place"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mixture with their own columns; one row for each block."""
    return mix(docs, **options).select("row.*")


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(load(spark, sf_dir, "documents")).select("doc_id", "source", "block", "place")


_HASH = "('0x' || substr(md5(concat_ws('|', '{seed}', {block}::VARCHAR, source, doc_id::VARCHAR)), 1, 15))::BIGINT"

# Under a repetition limit alone the exponent has a closed form: ln(repeats) = (1 - power) ln(most / least).
ORACLE = rf"""
WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS tokens FROM documents
), sizes AS (SELECT source, sum(tokens) AS t FROM docs GROUP BY source),
ends AS (SELECT max(t) AS hi, min(t) AS lo FROM sizes WHERE t > 0),
power AS (
  SELECT hi, CASE WHEN hi = lo THEN 0 ELSE greatest(0, 1 - ln({REPEATS}) / ln(hi / lo)) END AS p FROM ends
), quota AS (
  SELECT source, CASE WHEN t = hi OR t = 0 THEN 1.0 ELSE pow(t / hi, p - 1) END AS e, t FROM sizes, power
), parts AS (SELECT source, floor(e)::BIGINT AS whole, (e - floor(e)) * t AS rest FROM quota),
head AS (
  SELECT doc_id, source, whole, rest, tokens, {_HASH.format(seed=SEED, block="(whole + 1)")} AS h
  FROM docs JOIN parts USING (source)
), chosen AS (
  SELECT *, coalesce(sum(tokens) OVER (
    PARTITION BY source ORDER BY h RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) < rest AS more FROM head
), blocks AS (
  SELECT doc_id, source, unnest(generate_series(1, whole + more::INT)) AS block FROM chosen
)
SELECT doc_id, source, block, {_HASH.format(seed=SEED, block="block")} AS place FROM blocks
"""
