"""Region tree: every proper ancestor, the ancestor set, and related pairs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanewise.session import materialize_with


def _ancestor_paths(regions: DataFrame) -> DataFrame:
    """(slug, ancestor, level, copies) for every proper ancestor.

    Path lengths double per round: the paths of the greatest length so far are
    continued by every known path, so a tree of depth d takes log2(d) rounds. Copies
    of an edge are counted, not carried, so a region delivered many times costs one
    row. The continuing side is unique per (slug, ancestor, level); the other may
    crowd on one ancestor, which AQE splits. Each round is written to the shared
    folder, so a lost executor costs a round at most and the plan does not grow.
    """
    path = ["slug", "ancestor", "level"]
    cycle = F.max(F.when(F.col("slug") == F.col("ancestor"), F.col("slug")))
    newest = (
        regions.filter(F.col("parent").isNotNull())
        .groupBy("slug", F.col("parent").alias("ancestor"), F.lit(1).alias("level"))
        .agg(F.count("*").alias("copies"))
    )
    parts, length = [], 1
    while True:
        newest, found = materialize_with(
            newest, "region-paths", longest=F.max("level"), cycle=cycle
        )
        if found.get("cycle") is not None:
            raise ValueError(f"region {found['cycle']!r} is its own ancestor")
        parts.append(newest)
        if found.get("longest") != length:
            break
        known = reduce(DataFrame.unionByName, parts)
        upper = known.select(
            F.col("slug").alias("ancestor"),
            F.col("ancestor").alias("further"),
            F.col("level").alias("more"),
            F.col("copies").alias("more_copies"),
        )
        newest = (
            newest.filter(F.col("level") == length)
            .join(upper, "ancestor")
            .groupBy(
                "slug",
                F.col("further").alias("ancestor"),
                (F.col("level") + F.col("more")).alias("level"),
            )
            .agg(F.sum(F.col("copies") * F.col("more_copies")).alias("copies"))
        )
        length *= 2
    return reduce(DataFrame.unionByName, parts).select(*path, "copies")


def closure(regions: DataFrame) -> DataFrame:
    """(slug, parent_slug, ancestor, level), one row per path (bag semantics)."""
    copy = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))
    return (
        _ancestor_paths(regions)
        .withColumn("copy", copy)
        .select("slug", F.col("ancestor").alias("parent_slug"), "ancestor", "level")
    )


def roots(regions: DataFrame) -> DataFrame:
    return regions.filter(F.col("parent").isNull())


def ancestor_set(regions: DataFrame) -> DataFrame:
    """Distinct (slug, ancestor); a root is its own ancestor, other regions are not."""
    paths = _ancestor_paths(regions).select("slug", "ancestor")
    own = roots(regions).select("slug", F.col("slug").alias("ancestor"))
    return paths.union(own).distinct()


def related_pairs(ancestors: DataFrame) -> DataFrame:
    """Pairs (left_region, right_region) of which one is an ancestor of the other.

    Both directions are listed, so excluding them is a hash anti join on two keys
    instead of a nested loop over an OR.
    """
    down = ancestors.select(
        F.col("slug").alias("left_region"), F.col("ancestor").alias("right_region")
    )
    up = ancestors.select(
        F.col("ancestor").alias("left_region"), F.col("slug").alias("right_region")
    )
    return down.union(up).distinct()


def drop_related(pairs: DataFrame, ancestors: DataFrame, left: str, right: str) -> DataFrame:
    """Keep pairs that are not related; a pair with a NULL side is kept."""
    related = related_pairs(ancestors)
    return pairs.join(
        related,
        (pairs[left] == related["left_region"]) & (pairs[right] == related["right_region"]),
        "left_anti",
    )
