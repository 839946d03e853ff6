"""Document chunks, nearest vectors, routing and request parsing."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from celltide.functions.text import strip
from celltide.schemas import REQUEST_SCHEMA
from celltide.session import materialize

SEPARATORS = ["\n\n", "\n", " ", ""]  # fixed values: where a text may be cut, best first
VECTOR_BLOCK, QUERY_BLOCK = 4096, 256  # rows of one matrix product


def chunk_documents(
    df: DataFrame, size=1500, overlap=100, whole: Column | None = None, text="text", key="doc_id",
) -> DataFrame:
    """Chunks of `size` characters, each starting `overlap` before the end of the last.

    Documents for which `whole` holds stay in one piece. No chunk is made of overlap alone. The
    text is read once, into blocks as long as the step between chunks; a chunk is its block and the
    start of what follows. Cutting each chunk out of the whole text would count characters from
    the beginning every time.
    """
    step = size - overlap
    following = -(-overlap // step)
    blocks = F.regexp_extract_all(F.col(text), F.lit(f"(?s).{{1,{step}}}"), F.lit(0))
    if whole is not None:
        blocks = F.when(whole, F.array(text)).otherwise(blocks)
    cut = df.where(F.length(text) > 0).select(
        key, blocks.alias("_blocks"),
        F.floor((F.greatest(F.lit(1), F.length(text) - overlap) - 1) / step).alias("_last"),
    )
    chunks = F.transform(
        F.slice("_blocks", 1, F.col("_last").cast("int") + 1),
        lambda b, i: F.concat(b, F.substring(
            F.array_join(F.slice("_blocks", i + 2, F.lit(following)), ""), 1, overlap
        )),
    )
    rows = cut.select(key, F.posexplode_outer(chunks).alias("pos", "chunk_text"))
    return rows.select(key, (F.col("pos") + 1).alias("chunk_no"), "chunk_text")


def _merge(parts: list[str], size: int, overlap: int) -> list[str]:
    """Neighbouring parts joined up to `size`; a chunk repeats up to `overlap` of the last one."""
    chunks, held, length = [], deque(), 0
    for part in parts:
        if held and length + len(part) > size:
            chunks.append("".join(held))
            while held and (length > overlap or length + len(part) > size):
                length -= len(held.popleft())
        held.append(part)
        length += len(part)
    return [*chunks, "".join(held)]


def split_text(text: str, size: int, overlap: int, separators=tuple(SEPARATORS)) -> list[str]:
    """Cut at the best separator the text has; a part still too long is cut at finer ones.

    A separator stays at the start of the part after it. Chunks are stripped, empty ones dropped.
    """
    mark, finer = next(
        (s, separators[i + 1:]) for i, s in enumerate(separators) if s == "" or s in text
    )
    if mark:
        first, *rest = text.split(mark)
        parts = [first, *(mark + p for p in rest)]
    else:
        parts = list(text)
    chunks, run = [], []
    for part in filter(None, parts):
        if len(part) < size:
            run.append(part)
            continue
        chunks += _merge(run, size, overlap)
        run = []
        chunks += split_text(part, size, overlap, finer) if finer else [part]
    chunks += _merge(run, size, overlap)
    return [c for c in (chunk.strip() for chunk in chunks) if c]


def chunk_at_separators(
    df: DataFrame, size=1500, overlap=100, whole: Column | None = None, text="text", key="doc_id"
) -> DataFrame:
    """Chunks cut at paragraph, line or word ends where possible. Arrow batches of whole texts.

    Documents for which `whole` holds stay in one piece.
    """
    kind = df.schema[key].dataType
    keep = F.lit(False) if whole is None else F.coalesce(whole, F.lit(False))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, numbers, chunks = [], [], []
            for i, (t, one) in enumerate(zip(*(c.to_pylist() for c in batch.columns[1:3]))):
                parts = ([t] if t else []) if one else split_text(t or "", size, overlap)
                rows += [i] * len(parts)
                numbers += range(1, len(parts) + 1)
                chunks += parts
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(numbers, pa.int32()),
                 pa.array(chunks, pa.string())],
                names=[key, "chunk_no", "chunk_text"],
            )

    return df.select(key, text, keep.alias("_whole")).mapInArrow(
        cut, f"{key} {kind.simpleString()}, chunk_no INT, chunk_text STRING"
    )


def _places(text: str, pieces: list[str]) -> list[int]:
    """A place for each piece, rising, with only white space between the end of one and the start of the next,

    so that the last one ends where the text does; none if there is no such way. Repeated passages leave several
    places for a piece: all that some way leads to are followed, each with the place before it.
    """
    def gap(a, b):
        return b <= a or not text[a:b].strip()

    ways, ends = [], {-1: 0}
    for piece in pieces:
        found, at = {}, text.find(piece, min(ends) + 1)
        high = max(ends.values())
        while at >= 0 and gap(high, at):
            before = next((s for s in sorted(ends, reverse=True) if s < at and gap(ends[s], at)), None)
            if before is not None:
                found[at] = before
            at = text.find(piece, at + 1)
        if not found:
            return []
        ways.append(found)
        ends = {p: p + len(piece) for p in found}
    last = next((p for p in sorted(ends, reverse=True) if not text[ends[p]:].strip()), None)
    out = []
    for found in reversed(ways):
        if last is None:
            return []
        out.append(last)
        last = found[last]
    return out[::-1]


def chunk_places(df: DataFrame, chunks: DataFrame, text="text", key="doc_id") -> DataFrame:
    """(key, chunk_no, start, stop, fresh) of the chunks of each text, in code points, from 0.

    Chunks lie in rising places of the text and may overlap; only white space lies between the end of one and
    the start of the next. `fresh` is what a chunk adds to those before it, without white space. Where chunks do
    not lie so, they have no places and add their whole texts, so a missing or swapped chunk shows. Chunks of one
    text meet in one row of Spark's: they are no more than the text and its overlaps.
    """
    kind = df.schema[key].dataType
    parts = chunks.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("chunk_no", "chunk_text"))).alias("_chunks"))
    rows = parts.join(df.select(key, text), key).select(
        key, text, F.transform("_chunks", lambda c: c["chunk_no"]).alias("_no"),
        F.transform("_chunks", lambda c: c["chunk_text"]).alias("_parts"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told = {"row": [], "no": [], "start": [], "stop": [], "fresh": []}
            for i, (t, numbers, pieces) in enumerate(zip(*(c.to_pylist() for c in batch.columns[1:]))):
                end, places = 0, _places(t, pieces)
                for no, piece, at in zip(numbers, pieces, places or [None] * len(pieces)):
                    stop = None if at is None else at + len(piece)
                    fresh = piece if at is None else t[max(at, end): stop]
                    end = max(end, stop or 0)
                    for name, value in zip(told, (i, no, at, stop, "".join(fresh.split()))):
                        told[name].append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(told["row"], pa.int64())), pa.array(told["no"], pa.int32()),
                 pa.array(told["start"], pa.int64()), pa.array(told["stop"], pa.int64()),
                 pa.array(told["fresh"], pa.string())],
                names=[key, "chunk_no", "start", "stop", "fresh"])

    return rows.mapInArrow(
        place, f"{key} {kind.simpleString()}, chunk_no INT, start BIGINT, stop BIGINT, fresh STRING")


def label_centroids(df: DataFrame, vector="embedding", label="label") -> DataFrame:
    """Mean vector of each label."""
    places = df.select(label, F.posexplode(vector).alias("place", "v"))
    means = places.groupBy(label, "place").agg(F.avg("v").alias("v"))
    return means.groupBy(label).agg(F.transform(
        F.array_sort(F.collect_list(F.struct("place", "v"))), lambda s: s["v"]
    ).alias("query_vector"))


def _blocks(rows):
    """Usable vectors of a task in blocks of `rows`: ids, width, components. Vectors that are null,
    empty or hold a component that is null or not finite are left out one by one."""

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(1)
            size = np.diff(vectors.offsets.to_numpy()) if len(vectors) else np.zeros(0, int)
            size = np.where(vectors.is_valid().to_numpy(zero_copy_only=False), size, 0)
            flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(float)
            end = np.cumsum(size)
            odd = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
            good = (size > 0) & (odd[end] == odd[end - size])
            good &= batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for width in np.unique(size[good]):
                at = np.flatnonzero(good & (size == width))
                for lo in range(0, len(at), rows):
                    part = at[lo:lo + rows]
                    places = (end - size)[part][:, None] + np.arange(width)
                    yield pa.record_batch({
                        "width": pa.array([width], pa.int32()),
                        "ids": pa.array([ids[part].astype(np.int64).tobytes()], pa.binary()),
                        "data": pa.array([flat[places].tobytes()], pa.binary()),
                    })

    return fn


def _scorer(k, cosine, digits):
    """The k best of a block of vectors for each query of a block of queries."""

    def read(width, ids, data):
        ids = np.frombuffer(ids, np.int64)
        rows = np.frombuffer(data, np.float64).reshape(len(ids), width)
        if cosine:  # a zero vector has no direction
            norm = np.sqrt((rows * rows).sum(1))
            ids, rows = ids[norm > 0], rows[norm > 0] / norm[norm > 0, None]
        return ids, rows

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                width, ids, data, q_width, q_ids, q_data = (c[i].as_py() for c in batch.columns[:6])
                if width != q_width:
                    continue
                keys, points = read(width, ids, data)
                names, asked = read(width, q_ids, q_data)
                if not len(keys) or not len(names):
                    continue
                for j, near in enumerate(_candidates(points, asked, k, cosine, digits)):
                    q, p = asked[j], points[near]
                    # Row by row, so equal vectors get equal distances whatever their block.
                    far = 1.0 - (p * q).sum(1) if cosine else np.sqrt(((p - q) ** 2).sum(1))
                    far = np.round(far, digits)
                    best = np.lexsort((keys[near], far))[:k]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([names[j]] * len(best), pa.int64()),
                         pa.array(keys[near][best], pa.int64()), pa.array(far[best], pa.float64())],
                        names=["query_id", "key", "distance"],
                    )

    return fn


def _candidates(points, asked, k, cosine, digits):
    """Per query, the rows that can be among its k best.

    One matrix product gives distances with a small error; every row within that error and the
    rounding of the k-th best stays in.
    """
    product = points @ asked.T
    if cosine:
        far = 1.0 - product
    else:
        square = (points * points).sum(1)[:, None] + (asked * asked).sum(1)[None, :]
        far = np.sqrt(np.maximum(square - 2.0 * product, 0.0))
    norms = np.linalg.norm(points, axis=1).max() + np.linalg.norm(asked, axis=1).max()
    error = 4.0 * np.sqrt(points.shape[1] * np.finfo(float).eps) * norms
    slack = 2.0 * 10.0 ** -digits + error
    limit = far.max(0) if len(far) <= k else np.partition(far, k - 1, axis=0)[k - 1]
    for j in range(far.shape[1]):
        yield np.flatnonzero(far[:, j] <= limit[j] + slack)


def nearest(
    vectors: DataFrame, queries: DataFrame, k=4, vector="embedding", key="vec_id",
    query_id="query_id", query_vector="query_vector", metric="l2", digits=6,
    vector_block=VECTOR_BLOCK, query_block=QUERY_BLOCK,
) -> DataFrame:
    """The k nearest vectors of each query: exact, ties by key.

    Vectors and queries are packed into blocks where they are; the blocks of vectors are dealt out
    evenly and each share gets the blocks of queries. Neither is collected, and a pair of blocks
    yields k rows per query.
    Only vectors as long as the query are compared with it. Vectors with null or non-finite
    components, and for cosine zero vectors, are left out on either side.
    """
    kind = "width INT, ids BINARY, data BINARY"
    points = vectors.select(F.col(key).cast("bigint").alias("i"), F.col(vector).cast("array<double>"))
    asked = queries.select(
        F.col(query_id).cast("bigint").alias("i"), F.col(query_vector).cast("array<double>"))
    shares = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    points = points.mapInArrow(_blocks(vector_block), kind).withColumn(
        "share", F.pmod(F.xxhash64("ids"), F.lit(shares)))
    asked = asked.mapInArrow(_blocks(query_block), kind).toDF("q_width", "q_ids", "q_data").withColumn(
        "share", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(shares - 1).cast("bigint"))))
    pairs = points.join(asked, "share").drop("share")
    scored = pairs.mapInArrow(
        _scorer(k, metric == "cosine", digits), "query_id BIGINT, key BIGINT, distance DOUBLE")
    best = Window.partitionBy("query_id").orderBy("distance", "key")
    return scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", F.col("key").alias(key), "distance", "rank")


def route(df: DataFrame, label="label", query="query") -> DataFrame:
    """`route`: forecast, upgrade or general, by the label and the query text."""
    said, asked = F.upper(F.col(label)), F.upper(F.col(query))
    return df.withColumn(
        "route",
        F.when(F.contains(said, F.lit("PREDICTION")), "forecast")
        .when(F.contains(said, F.lit("UPGRADE")) | F.contains(asked, F.lit("YAML")), "upgrade")
        .otherwise("general"),
    )


# The error texts of a request that cannot be read.
NO_LIST = (
    "Error: Action Input must be a JSON list like "
    "[{'Cell ID': '1', 'Datetime_ts': '2026-02-26T12:00:00'}]."
)
BAD_LIST = "Error parsing tool input: Please provide a VALID JSON list."
BAD_DATE = (
    "Error: Invalid date provided (e.g., Feb 29 in a non-leap year). "
    "Please use March 1st (2026-03-01) instead."
)


def _no_such_day(item: Column) -> Column:
    """A date of a possible form whose month has no such day."""
    day = F.regexp_extract(
        item.getField("Datetime_ts"), r"^\s*(\d{4}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12]\d|3[01]))(?:\D|$)", 1)
    return (day != "") & day.try_cast("date").isNull()


def parse_request(df: DataFrame, text="text", limit=5) -> DataFrame:
    """`requests`: the first list in the text, at most `limit` items; `error` otherwise.

    The limit is part of the request format: a call answers at most that many items.
    """
    swapped = F.replace(strip(F.col(text)), F.lit("'"), F.lit('"'))
    found = F.regexp_extract(swapped, r"(?s)\[.*\]", 0)
    parsed = F.from_json(found, REQUEST_SCHEMA, {"mode": "PERMISSIVE"})
    out = df.withColumn("_found", found).withColumn("_parsed", parsed)
    # Broken JSON gives NULL or a list of empty items, as the reader is permissive.
    valid = F.col("_parsed").isNotNull() & ~F.exists(
        "_parsed", lambda r: r.getField("Cell ID").isNull() & r.getField("Datetime_ts").isNull()
    )
    asked = F.slice("_parsed", 1, limit)
    wrong = valid & F.coalesce(F.exists(asked, _no_such_day), F.lit(False))
    return out.withColumns({
        "requests": F.when(valid & ~wrong, asked),
        "error": F.when(F.coalesce(F.col("_found"), F.lit("")) == "", NO_LIST)
        .when(~F.coalesce(valid, F.lit(False)), BAD_LIST)
        .when(wrong, BAD_DATE),
    }).drop("_found", "_parsed")


def full_outer(left: DataFrame, right: DataFrame, keys) -> DataFrame:
    """Full outer join. Rows without a full key match nothing, and stay.

    Spark cannot split a hot key of a full outer join. So it is written as the matches plus the
    rows of either side without a partner: an inner join can be split on both sides, an anti join
    on its left, where the rows are.
    """
    keys = list(keys)
    matched = left.join(right, keys)
    left_alone = left.join(right.select(*keys).distinct(), keys, "left_anti")
    right_alone = right.join(left.select(*keys).distinct(), keys, "left_anti")
    return matched.unionByName(left_alone, allowMissingColumns=True).unionByName(
        right_alone, allowMissingColumns=True
    )


def join_kpi_du(scores: DataFrame, traffic: DataFrame, du: DataFrame) -> DataFrame:
    """Anomaly score, predicted traffic and host resources on (cell, time); missing stays NULL.

    The first join is stored, for the second one reads it three times.
    """
    keys = ["cell_id", "event_time"]
    return full_outer(materialize(full_outer(scores, traffic, keys), "outer"), du, keys)


# Status lines, with the column behind each, its digits and its unit.
STATUS_LINES = [
    ("CellID", "cell_id", None, ""),
    ("KPI Anomaly Score", "anomaly_score", 4, ""),
    ("Predicted Traffic Load", "predicted_traffic", 2, ""),
    ("DU CPU Usage", "cpu_pct", 2, "%"),
    ("Memory Usage", "memory_mb", None, " MB"),
    ("Disk Usage", "disk_gb", 2, " GB"),
    ("RTT", "rtt_ms", 2, " ms"),
    ("Temperature", "temperature_c", 2, " °C"),
    ("Power Usage", "power_w", 2, " W"),
]


def status_text(df: DataFrame) -> DataFrame:
    """`status_text`: one line per figure, '-' for what is missing."""
    lines = []
    for title, c, digits, unit in STATUS_LINES:
        value = F.col(c) if digits is None else F.round(c, digits)
        lines.append(F.concat(
            F.lit(f"{title}: "), F.coalesce(value.cast("string"), F.lit("-")), F.lit(unit)
        ))
    return df.withColumn("status_text", F.concat_ws("\n", *lines))
