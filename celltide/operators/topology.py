"""Cell topology: bands, candidate links, audit, degrees, counts, sentences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from celltide.functions.geo import haversine
from celltide.functions.lookups import VALID_BANDS

MAX_DEGREE = 3  # fixed value: most neighbours a cell may have


def cell_bands(cells: DataFrame, keep=("cell_id",)) -> DataFrame:
    """One row per cell and band."""
    return cells.select(*keep, F.explode("bands").alias("band"))


def edges(cells: DataFrame) -> DataFrame:
    """One row per named neighbour."""
    return cells.select("cell_id", F.explode("adjacent_cells").alias("adjacent_cell"))


def band_set(bands: Column) -> Column:
    return F.array_sort(F.array_distinct(bands))


def candidate_links(cells: DataFrame) -> DataFrame:
    """Per cell, how many cells of its city share one, two, ... bands with it.

    All pairs of a city are never formed: cells of a city with the same set of bands are counted
    first. There are at most 2^bands such sets per city, so the sets are joined instead of the
    cells and the counts come back to the cells.
    """
    sets = cells.where("city IS NOT NULL").select(
        "cell_id", "city", band_set(F.col("bands")).alias("band_set")
    )
    counted = sets.groupBy("city", "band_set").agg(F.count("*").alias("n"))
    other = counted.select("city", F.col("band_set").alias("other_set"), F.col("n").alias("m"))
    shared = F.size(F.array_intersect("band_set", "other_set"))
    met = counted.join(other, "city").withColumn("shared", shared).where("shared > 0").withColumn(
        "m", F.col("m") - F.when(F.col("band_set") == F.col("other_set"), 1).otherwise(0)
    )
    width = range(1, len(VALID_BANDS) + 1)
    partners = met.groupBy("city", "band_set").agg(
        F.sum("m").alias("links"),
        *[F.coalesce(F.sum(F.when(F.col("shared") == s, F.col("m"))), F.lit(0)).alias(
            f"sharing_{s}"
        ) for s in width],
    )
    return sets.join(partners, ["city", "band_set"], "left").select(
        "cell_id", "city",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("links", *(f"sharing_{s}" for s in width))],
    )


def audit_topology(cells: DataFrame, max_degree=MAX_DEGREE) -> DataFrame:
    """Every named neighbour with its checks: known, mutual, same city, shared band, degrees."""
    named = edges(cells).distinct()
    own = cells.select(
        "cell_id", "city", "bands", "lat", "lon", F.size("adjacent_cells").alias("degree")
    )
    there = own.select(*[F.col(c).alias(f"to_{c}") for c in own.columns])
    back = named.select(
        F.col("adjacent_cell").alias("cell_id"), F.col("cell_id").alias("adjacent_cell"),
        F.lit(True).alias("_back"),
    )
    joined = (
        named.join(own, "cell_id")
        .join(there, F.col("adjacent_cell") == F.col("to_cell_id"), "left")
        .join(back, ["cell_id", "adjacent_cell"], "left")
    )

    def sure(c):
        return F.coalesce(c, F.lit(False))

    out = joined.select(
        "cell_id",
        "adjacent_cell",
        F.col("to_cell_id").isNotNull().alias("is_known"),
        sure(F.col("_back")).alias("is_mutual"),
        sure(F.col("city") == F.col("to_city")).alias("same_city"),
        sure(F.arrays_overlap("bands", "to_bands")).alias("shares_band"),
        (F.col("degree") <= max_degree).alias("degree_ok"),
        sure(F.col("to_degree") <= max_degree).alias("neighbour_degree_ok"),
        haversine(F.col("lat"), F.col("lon"), F.col("to_lat"), F.col("to_lon")).alias(
            "distance_km"
        ),
    )
    checks = ["is_known", "is_mutual", "same_city", "shares_band", "degree_ok",
              "neighbour_degree_ok"]
    fine = F.lit(True)
    for c in checks:
        fine = fine & F.col(c)
    return out.withColumn("is_ok", fine)


def degree_stats(cells: DataFrame) -> DataFrame:
    degree = F.coalesce(F.size("adjacent_cells"), F.lit(0))
    return cells.agg(
        F.count("*").alias("cells"),
        F.min(degree).alias("min_degree"),
        F.max(degree).alias("max_degree"),
        F.avg(degree).alias("avg_degree"),
    )


def cell_sentences(cells: DataFrame) -> DataFrame:
    """A sentence per cell for retrieval, with the cell's facts as metadata.

    Fixed values: the wording of the sentence.
    """
    capacity = F.coalesce(F.col("max_capacity").cast("string"), F.lit("unknown"))
    text = F.concat(
        F.lit("Cell "), F.col("cell_id").cast("string"), F.lit(" in city "), F.col("city"),
        F.lit(" is an "), F.col("area_type"), F.lit(" area with capacity "), capacity,
        F.lit(" and bands: "), F.array_join("bands", ", "), F.lit("."),
    )
    meta = [c for c in ("cell_id", "lat", "lon", "bands", "adjacent_cells", "area_type", "city",
                        "source") if c in cells.columns]
    return cells.select(
        "cell_id", text.alias("page_content"), F.struct(*meta).alias("metadata")
    )


def topology_counts(cells: DataFrame) -> DataFrame:
    """Cells per city, per area type and per band, in one scan: (kind, name, n)."""
    facts = F.flatten(F.array(
        F.array(F.struct(F.lit("city").alias("kind"), F.col("city").alias("name"))),
        F.array(F.struct(F.lit("area_type").alias("kind"), F.col("area_type").alias("name"))),
        F.transform("bands", lambda b: F.struct(F.lit("band").alias("kind"), b.alias("name"))),
    ))
    return cells.select(F.explode(facts).alias("f")).select("f.*").groupBy("kind", "name").agg(
        F.count("*").alias("n")
    )
