"""Neighbour matching: each cell gets up to its wanted number of links.

Links join cells of one city that share a band. They are granted in the order (distance, more
shared bands, lower id, higher id) while both ends still want one. Distances count to 1e-9 km, so
that rounding noise in trigonometric functions cannot decide between equal links.

No link leaves a city, so a city of bounded size is matched in one task. A larger city is matched
by Spark jobs that give the very same links without ever forming all its pairs:

* Same place first. Cells at one place all lie at distance zero, and lower ids are served first,
  so the lowest ids of each band set are enough to go on (`_serve_place`). What is left open at a
  place afterwards is bounded: two open cells share no band or are linked already.
* Then by distance, in rings of doubling width. Inside a ring only open cells meet, in cubes as
  wide as the ring. Earlier rings have closed all but a bounded number of cells per cube, so the
  pairs of a ring grow with the open cells, not with their square. Cubes settle the links they can
  be sure of, each in one task, and links across cubes are granted when both sides are sure; that
  repeats until the ring is empty.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from celltide.functions.geo import EARTH_RADIUS_KM, haversine
from celltide.session import materialize

MOST_BANDS = 62  # sets of bands are kept in 64-bit numbers
MAX_GROUP = 2_000  # cells of a city that one task may match: two million pairs
MAX_CUBE = 256  # open cells a cube of the first ring may hold
PLACE_CHUNK = 20_000  # lowest ids per band set that one task serves at a time
DEGREES, KM = 9, 9  # digits kept of coordinates and distances

NEAREST = (
    "city STRING, cell_id BIGINT, other BIGINT, distance_km DOUBLE, shared INT, rank INT"
)
LINK = "city STRING, a BIGINT, b BIGINT, distance_km DOUBLE, shared INT"


def _mask(bands: Column, names) -> Column:
    bits = [
        F.when(F.array_contains(bands, n), F.lit(1 << i)).otherwise(F.lit(0))
        for i, n in enumerate(names)
    ]
    return reduce(lambda x, y: x + y, bits).cast("bigint")


def _names(cells: DataFrame, bands) -> list[str]:
    """The bands that count: those given, or all that any cell has. A set of them is one number."""
    if bands is None:
        named = cells.select(F.explode("bands").alias("band")).where("band IS NOT NULL")
        bands = [r["band"] for r in named.distinct().orderBy("band").limit(MOST_BANDS + 1).collect()]
    if len(bands) > MOST_BANDS:
        raise ValueError(f"more than {MOST_BANDS} bands; name those that count")
    return list(bands)


def _prepare(cells: DataFrame, wanted: str, names) -> DataFrame:
    return cells.where("city IS NOT NULL AND cell_id IS NOT NULL").select(
        "city",
        F.col("cell_id").cast("bigint").alias("id"),
        F.round("lat", DEGREES).alias("lat"),
        F.round("lon", DEGREES).alias("lon"),
        _mask(F.col("bands"), names).alias("mask"),
        F.col(wanted).cast("int").alias("open"),
    ).where("mask > 0 AND open > 0 AND lat IS NOT NULL AND lon IS NOT NULL")


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x.astype(np.uint64)).astype(np.int32)


def _km(lat1, lon1, lat2, lon2) -> np.ndarray:
    lat1, lon1, lat2, lon2 = (np.radians(v) for v in (lat1, lon1, lat2, lon2))
    chord = np.sin((lat2 - lat1) / 2) ** 2
    chord += np.cos(lat1) * np.cos(lat2) * np.sin((lon2 - lon1) / 2) ** 2
    chord = np.minimum(chord, 1.0)
    return np.round(2 * EARTH_RADIUS_KM * np.arctan2(np.sqrt(chord), np.sqrt(1 - chord)), KM)


def _match_city(group: pd.DataFrame) -> pd.DataFrame:
    """All links of one bounded city."""
    g = group.sort_values("id")
    ids, masks = g["id"].to_numpy(), g["mask"].to_numpy()
    lat, lon = g["lat"].to_numpy(), g["lon"].to_numpy()
    left = g["open"].to_numpy().copy()
    first, second = np.triu_indices(len(g), 1)
    shared = _popcount(masks[first] & masks[second])
    keep = shared > 0
    first, second, shared = first[keep], second[keep], shared[keep]
    km = _km(lat[first], lon[first], lat[second], lon[second])
    queue = np.lexsort((second, first, -shared, km))
    granted = []
    while len(queue):
        head, queue = queue[:4096], queue[4096:]
        for e in head:
            i, j = first[e], second[e]
            if left[i] and left[j]:
                left[i] -= 1
                left[j] -= 1
                granted.append(e)
        queue = queue[(left[first[queue]] > 0) & (left[second[queue]] > 0)]
    e = np.array(granted, dtype=int)
    return pd.DataFrame({
        "city": np.full(len(e), g["city"].iloc[0], dtype=object), "a": ids[first[e]], "b": ids[second[e]],
        "distance_km": km[e], "shared": shared[e].astype("int32"),
    })


def match_neighbours(
    cells: DataFrame, wanted="wanted", bands=None, max_group=MAX_GROUP,
    max_cube=MAX_CUBE, chunk=PLACE_CHUNK,
) -> DataFrame:
    """The granted links: (city, a, b, distance_km, shared) with a < b.

    Only the largest city's size comes to the driver, to see whether the second way is needed.
    """
    bands = _names(cells, bands)
    ready = _prepare(cells, wanted, bands)
    sizes = ready.groupBy("city").agg(F.count("*").alias("n"), F.max("open").alias("open"))
    large = sizes.where(F.col("n") > max_group).select("city")
    most, degree = sizes.agg(F.max("n"), F.max("open")).first()
    # A cell may be linked to up to `degree` of the lowest ids already; a chunk has to go past them.
    chunk = max(chunk, 2 * (degree or 0) + 2)
    if (most or 0) <= max_group:
        return ready.groupBy("city").applyInPandas(_match_city, LINK)
    small = ready.join(large, "city", "left_anti").groupBy("city").applyInPandas(_match_city, LINK)
    opened = materialize(ready.join(large, "city", "left_semi"), "open-cells")
    return small.unionByName(_match_large(opened, max_cube, chunk))


def nearest_links(
    cells: DataFrame, k=3, bands=None, max_group=MAX_GROUP, max_cube=MAX_CUBE
) -> DataFrame:
    """The k best candidate links of every cell: (city, cell_id, other, distance_km, shared, rank).

    Candidates are the cells of the same city that share a band, in the order of the links. Large
    cities are searched place by place and ring by ring: of the cells of one place and band set
    only the lowest ids can be among anyone's best, and a cell leaves the search once it has k.
    """
    ready = _prepare(cells.withColumn("_wanted", F.lit(k)), "_wanted", _names(cells, bands))
    sizes = ready.groupBy("city").agg(F.count("*").alias("n"))
    large = sizes.where(F.col("n") > max_group).select("city")
    most = sizes.agg(F.max("n")).first()[0] or 0
    if most <= max_group:
        return ready.groupBy("city").applyInPandas(_nearest_in_city(k), NEAREST)
    small = ready.join(large, "city", "left_anti").groupBy("city").applyInPandas(
        _nearest_in_city(k), NEAREST
    )
    # Dealt to all tasks: each ranks its seekers' candidates, and cells may come in one row group.
    seekers = ready.join(large, "city", "left_semi").drop("open").repartition("id")
    seekers = materialize(seekers, "seekers")
    return small.unionByName(_nearest_large(seekers, k, max_cube))


def _nearest_in_city(k: int):
    def search(group: pd.DataFrame) -> pd.DataFrame:
        g = group.sort_values("id")
        ids, masks = g["id"].to_numpy(), g["mask"].to_numpy()
        lat, lon = g["lat"].to_numpy(), g["lon"].to_numpy()
        parts = []
        for i in range(len(g)):
            shared = _popcount(masks & masks[i])
            shared[i] = 0
            near = np.flatnonzero(shared)
            km = _km(lat[i], lon[i], lat[near], lon[near])
            best = np.lexsort((ids[near], -shared[near], km))[:k]
            parts.append((np.full(len(best), ids[i]), ids[near][best], km[best],
                          shared[near][best], np.arange(1, len(best) + 1)))
        own, other, km, shared, rank = (np.concatenate(c) for c in zip(*parts))
        return pd.DataFrame({
            "city": np.full(len(own), g["city"].iloc[0], dtype=object), "cell_id": own,
            "other": other, "distance_km": km.astype("float64"), "shared": shared.astype("int32"),
            "rank": rank.astype("int32"),
        })

    return search


def _nearest_large(seekers: DataFrame, k: int, max_cube: int) -> DataFrame:
    place = ["city", "lat", "lon"]
    lowest = Window.partitionBy(*place, "mask").orderBy("id")
    offered = materialize(
        seekers.withColumn("nth", F.row_number().over(lowest)).where(F.col("nth") <= k + 1)
        .drop("nth"), "offered",
    )
    there = offered.select(*place, F.col("id").alias("id_b"), F.col("mask").alias("mask_b"))
    here = _linked(seekers.join(there, place).withColumn("distance_km", F.lit(0.0)), k)
    # Without a hit at its own place a cell may still have some around it.
    width, widest = _first_ring(offered, max_cube)
    found, done = [], materialize(here, "links-here")
    seeking = _unserved(seekers, done, k)
    while width is not None and seeking.head(1):
        around = _around(seeking, offered, width).where(
            (F.col("distance_km") > 0) & (F.col("distance_km") <= width)
        )
        at_place = done.join(seeking.select(F.col("id").alias("cell_id")), "cell_id", "left_semi")
        hits = materialize(_ranked(at_place.drop("rank").unionByName(_linked(around, k).drop("rank")),
                                   k), "links-around")
        left = _unserved(seeking, hits, k)
        if width < widest:
            served = hits.join(left.select(F.col("id").alias("cell_id")), "cell_id", "left_anti")
        else:
            served, left = hits, left.where("false")
        found.append(served)
        seeking = materialize(left, "seekers")
        width *= 2
    late = reduce(lambda x, y: x.unionByName(y), found, done.where("false"))
    early = done.join(_unserved(seekers, done, k).select(F.col("id").alias("cell_id")), "cell_id",
                      "left_anti")
    columns = ["city", "cell_id", "other", "distance_km", "shared", "rank"]
    return early.select(*columns).unionByName(late.select(*columns))


def _unserved(seekers: DataFrame, links: DataFrame, k: int) -> DataFrame:
    served = links.where(F.col("rank") == k).select(F.col("cell_id").alias("id"))
    return seekers.join(served, "id", "left_anti").select(seekers.columns)


def _linked(pairs: DataFrame, k: int) -> DataFrame:
    """Pairs of seekers and offered cells as ranked links."""
    links = (
        pairs.where(F.col("id") != F.col("id_b"))
        .withColumn("shared", F.bit_count(F.col("mask").bitwiseAND(F.col("mask_b"))).cast("int"))
        .where("shared > 0")
        .select("city", F.col("id").alias("cell_id"), F.col("id_b").alias("other"), "distance_km",
                "shared")
    )
    return _ranked(links, k)


def _ranked(links: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("cell_id").orderBy("distance_km", F.desc("shared"), "other")
    return links.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def _around(here: DataFrame, there: DataFrame, width: float) -> DataFrame:
    """Pairs of `here` and `there` in the same or touching cubes, with their distance."""
    cube = [c.alias(n) for c, n in zip(_cube(F.lit(width)), "xyz")]
    near = here.select("city", "id", "lat", "lon", "mask", *cube)
    for n in "xyz":
        near = near.withColumn("step", F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1)))).withColumn(
            n, F.col(n) + F.col("step")
        ).drop("step")
    other = there.select(
        "city", *[F.col(c).alias(f"{c}_b") for c in ("id", "lat", "lon", "mask")], *cube
    )
    km = F.round(haversine(F.col("lat"), F.col("lon"), F.col("lat_b"), F.col("lon_b")), KM)
    return near.join(other, ["city", *"xyz"]).withColumn("distance_km", km)


def adjacency(links: DataFrame, cells: DataFrame) -> DataFrame:
    """Cells with `adjacent_cells`, the sorted ids they are linked to; none is an empty list."""
    ends = links.select(F.col("a").alias("cell_id"), F.col("b").alias("other")).unionByName(
        links.select(F.col("b").alias("cell_id"), F.col("a").alias("other"))
    )
    lists = ends.groupBy("cell_id").agg(F.array_sort(F.collect_list("other")).alias("_lists"))
    empty = F.array().cast("array<bigint>")
    return cells.drop("adjacent_cells").join(lists, "cell_id", "left").withColumn(
        "adjacent_cells", F.coalesce("_lists", empty)
    ).drop("_lists")


def _close(opened: DataFrame, links: DataFrame) -> DataFrame:
    """Open cells after `links` are granted."""
    ends = links.select(F.explode(F.array("a", "b")).alias("id"))
    used = ends.groupBy("id").agg(F.count("*").cast("int").alias("used"))
    return opened.join(used, "id", "left").withColumn(
        "open", F.col("open") - F.coalesce("used", F.lit(0))
    ).where("open > 0").select(opened.columns)


def _match_large(opened: DataFrame, max_cube: int, chunk: int) -> DataFrame:
    granted = []
    most = opened.agg(F.max(F.bit_count("mask"))).first()[0] or 0
    for shared in range(most, 0, -1):
        opened, found = _match_places(opened, shared, chunk)
        granted += found
    width, widest = _first_ring(opened, max_cube)
    inner = 0.0
    while width is not None and inner < widest:
        opened, found = _match_ring(opened, inner, width)
        granted += found
        if not opened.head(1):
            break
        inner, width = width, width * 2
    empty = opened.sparkSession.createDataFrame([], LINK)
    return reduce(lambda x, y: x.unionByName(y), granted, empty)


def _serve_place(shared: int, chunk: int):
    """Links between cells of one place that share exactly `shared` bands.

    Gets the lowest ids of each band set. A set with `chunk` rows may go on beyond them. Cells are
    served in id order, each taking the lowest ids after its own; serving stops at the first cell
    that may have lower-numbered cells or partners outside the chunk. `after` is the last partner
    of a cell whose serving was cut off earlier.
    """
    def serve(group: pd.DataFrame) -> pd.DataFrame:
        g = group.sort_values("id")
        ids, masks = g["id"].to_numpy(), g["mask"].to_numpy()
        left, after = g["open"].to_numpy().copy(), g["after"].to_numpy()
        kinds = {m: np.flatnonzero(masks == m) for m in np.unique(masks)}
        last = {m: ids[rows[-1]] for m, rows in kinds.items()}
        more = {m for m, rows in kinds.items() if len(rows) >= chunk}
        horizon = min([last[m] for m in more], default=ids[-1])
        meets = {
            m: [k for k in kinds if int(m & k).bit_count() == shared] for m in kinds
        }
        pointer = dict.fromkeys(kinds, 0)
        first, second = [], []
        for i in range(len(ids)):
            if ids[i] > horizon:
                break
            if not left[i]:
                continue
            partners = []
            for k in meets[masks[i]]:
                rows = kinds[k]
                # Rows before the pointer are closed or lie before every cell still to serve.
                p = pointer[k]
                while p < len(rows) and (not left[rows[p]] or rows[p] <= i):
                    p += 1
                pointer[k] = p
                found = 0
                while p < len(rows) and found < left[i]:
                    j = rows[p]
                    if left[j] and ids[j] > after[i]:
                        partners.append(j)
                        found += 1
                    p += 1
                if found < left[i] and k in more:
                    partners.append(-1 - kinds[k][-1])
            # A negative mark stands for unseen partners above that row.
            partners.sort(key=lambda j: (j if j >= 0 else -1 - j, j < 0))
            cut = False
            for j in partners:
                if not left[i]:
                    break
                if j < 0:
                    cut = True
                    break
                left[i] -= 1
                left[j] -= 1
                first.append(ids[i])
                second.append(ids[j])
            if cut:
                break
        return pd.DataFrame({
            "city": np.full(len(first), g["city"].iloc[0], dtype=object),
            "a": np.array(first, dtype="int64"), "b": np.array(second, dtype="int64"),
            "distance_km": np.zeros(len(first)),
            "shared": np.full(len(first), shared, dtype="int32"),
        })

    return serve


def _match_places(opened: DataFrame, shared: int, chunk: int):
    """Grant every distance-zero link of `shared` bands: (open cells, link tables)."""
    place = ["city", "lat", "lon"]
    granted = []
    opened = opened.withColumn("after", F.lit(-(2**63)).cast("bigint"))
    while True:
        kinds = opened.groupBy(*place, "mask").agg(F.count("*").alias("n"))
        others = kinds.select(*place, F.col("mask").alias("other"), F.col("n").alias("m"))
        useful = (
            kinds.join(others, place)
            .where(F.bit_count(F.col("mask").bitwiseAND(F.col("other"))) == shared)
            .where((F.col("mask") != F.col("other")) | (F.col("m") > 1))
            .select(*place, "mask").distinct()
        )
        lowest = Window.partitionBy(*place, "mask").orderBy("id")
        ready = opened.join(useful, [*place, "mask"], "left_semi").withColumn(
            "nth", F.row_number().over(lowest)
        ).where(F.col("nth") <= chunk).drop("nth")
        links = materialize(
            ready.groupBy(*place).applyInPandas(_serve_place(shared, chunk), LINK), "place-links"
        )
        if not links.head(1):
            return opened.drop("after"), granted
        granted.append(links)
        reached = links.groupBy(F.col("a").alias("id")).agg(F.max("b").alias("reached"))
        opened = materialize(
            _close(opened, links).join(reached, "id", "left").withColumn(
                "after", F.greatest("after", F.coalesce("reached", "after"))
            ).drop("reached"),
            "open-cells",
        )


def _cube(width, lat="lat", lon="lon") -> list[Column]:
    """Cube of a cell in space: straight lines are never longer than arcs, at poles or elsewhere."""
    lat, lon = F.radians(lat), F.radians(lon)
    axes = [F.cos(lat) * F.cos(lon), F.cos(lat) * F.sin(lon), F.sin(lat)]
    return [F.floor(a * EARTH_RADIUS_KM / width) for a in axes]


def _first_ring(opened: DataFrame, max_cube: int):
    """(width of the first ring, an upper bound for any distance inside a city), in km."""
    lat, lon = F.radians("lat"), F.radians("lon")
    axes = {"x": F.cos(lat) * F.cos(lon), "y": F.cos(lat) * F.sin(lon), "z": F.sin(lat)}
    box = opened.select("city", *[a.alias(n) for n, a in axes.items()]).groupBy("city").agg(
        F.sqrt(sum((F.max(n) - F.min(n)) ** 2 for n in axes)).alias("d")
    )
    # An arc is at most pi/2 times its chord.
    span = box.agg(F.max("d")).first()[0]
    if span is None:
        return None, 0.0
    widest = max(span * EARTH_RADIUS_KM * 1.6, 1e-6)
    steps = F.explode(F.sequence(F.lit(0), F.lit(34))).alias("step")
    width = F.lit(widest) / F.pow(F.lit(2.0), F.col("step"))
    levels = opened.select("city", "lat", "lon", steps)
    crowd = levels.groupBy("step", "city", *[c.alias(n) for c, n in zip(_cube(width), "xyz")])
    most = crowd.agg(F.count("*").alias("n")).groupBy("step").agg(F.max("n").alias("n"))
    fitting = most.where(F.col("n") <= max_cube).agg(F.min("step")).first()[0]
    step = 34 if fitting is None else fitting
    return widest / 2**step, widest


def _match_ring(opened: DataFrame, inner: float, outer: float):
    """Grant every link with inner < distance <= outer: (open cells, link tables).

    The pairs of a ring go to the blocks of both their ends, cubes as wide as the ring. Each block settles what it
    can see through (`_vote`), a chain of links that wait for each other in one go; pairs across blocks are granted
    when both sides say so. Rounds are as many as the blocks that a chain runs through.
    """
    ends = [F.xxhash64("city", *_cube(F.lit(outer), lat, lon)).alias(n)
            for lat, lon, n in (("lat", "lon", "block_a"), ("lat_b", "lon_b", "block_b"))]
    pairs = (
        _around(opened, opened, outer)
        .where(F.col("id") < F.col("id_b"))
        .withColumn("shared", F.bit_count(F.col("mask").bitwiseAND(F.col("mask_b"))))
        .where("shared > 0")
        .where((F.col("distance_km") > inner) & (F.col("distance_km") <= outer))
        .select("city", F.col("id").alias("a"), F.col("id_b").alias("b"), "distance_km",
                F.col("shared").cast("int").alias("shared"), *ends)
    )
    live, granted = materialize(_with_room(pairs, opened), "ring-pairs"), []
    while live.head(1):
        seen = live.withColumn("block", F.explode(F.array_distinct(F.array("block_a", "block_b"))))
        votes = seen.groupBy("block").applyInPandas(_vote, f"{LINK}, votes INT")
        both = votes.groupBy("city", "a", "b", "distance_km", "shared").agg(F.sum("votes").alias("n"))
        links = materialize(both.where("n = 2").drop("n"), "ring-links")
        granted.append(links)
        opened = materialize(_close(opened, links), "open-cells")
        waiting = live.drop("open_a", "open_b").join(links.select("a", "b"), ["a", "b"], "left_anti")
        live = materialize(_with_room(waiting.select(pairs.columns), opened), "ring-pairs")
    return opened, granted


def _with_room(pairs: DataFrame, opened: DataFrame) -> DataFrame:
    """Pairs of open cells, with the links that both ends still want."""
    for end in ("a", "b"):
        pairs = pairs.join(opened.select(F.col("id").alias(end), F.col("open").alias(f"open_{end}")), end)
    return pairs


def _vote(group: pd.DataFrame) -> pd.DataFrame:
    """The links that one block can be sure of: two votes for a link inside, one for a link across.

    Links are looked at in their order. One that is not settled may still be granted, so a slot of its ends inside is
    kept for it. A later link is sure where a slot is left beyond those; it is out where an end has all its links.
    """
    first, second = group["a"].to_numpy(), group["b"].to_numpy()
    km, shared = group["distance_km"].to_numpy(), group["shared"].to_numpy()
    cells, ends = np.unique(np.concatenate([first, second]), return_inverse=True)
    room = np.zeros(len(cells), dtype=np.int64)
    room[ends] = np.concatenate([group["open_a"], group["open_b"]])
    block = group["block"].iloc[0]
    here = [(group[c] == block).to_numpy().tolist() for c in ("block_a", "block_b")]
    left, kept = room.tolist(), [0] * len(cells)
    at = ends[:len(group)].tolist(), ends[len(group):].tolist()
    sure, votes = [], []
    for e in np.lexsort((second, first, -shared, km)).tolist():
        inside = [side[e] for side, mine in zip(at, here) if mine[e]]
        if not all(left[i] for i in inside):
            continue
        fits = all(left[i] > kept[i] for i in inside)
        if fits:
            sure.append(e)
            votes.append(len(inside))
        for i in inside:
            if fits and len(inside) == 2:
                left[i] -= 1
            else:
                kept[i] += 1
    return pd.DataFrame({
        "city": group["city"].to_numpy()[sure], "a": first[sure], "b": second[sure], "distance_km": km[sure],
        "shared": shared[sure], "votes": np.array(votes, dtype="int32"),
    })
