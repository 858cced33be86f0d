"""Topology joins: groups, supergroups, weights, profile listings, ancestors."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from uptrail.operators.selection import ENDPOINT


def group_members(eg: DataFrame, group_type: str) -> DataFrame:
    """(service, hostname, group) of one grouping type, each once."""
    return eg.where(F.col("type") == group_type).select(*ENDPOINT, "group").distinct()


def add_groups(df: DataFrame, eg: DataFrame, group_type: str) -> DataFrame:
    """One row per group an endpoint belongs to; endpoints without a group are dropped."""
    return df.join(group_members(eg, group_type), ENDPOINT)


def first_supergroup(gg: DataFrame, group_type: str, *by: str) -> DataFrame:
    """(group, supergroup): one supergroup of the type for each subgroup, the first by name."""
    return (gg.where(F.col("type") == group_type)
            .groupBy(F.col("subgroup").alias("group"), *by)
            .agg(F.min("group").alias("supergroup")))


def with_supergroup(df: DataFrame, gg: DataFrame, group_type: str) -> DataFrame:
    """Add the supergroup of each group, null when there is none."""
    return df.join(first_supergroup(gg, group_type), "group", "left")


def first_weight(weights: DataFrame, weight_type: str, *by: str) -> DataFrame:
    """(group, weight): one weight of the type for each group, the smallest."""
    return (weights.where(F.col("type") == weight_type)
            .groupBy(F.col("site").alias("group"), *by)
            .agg(F.min(F.col("weight").cast("int")).alias("weight")))


def with_weight(df: DataFrame, weights: DataFrame, weight_type: str) -> DataFrame:
    """Add the weight of each group, 0 when there is none."""
    return (df.join(first_weight(weights, weight_type), "group", "left")
            .withColumn("weight", F.coalesce("weight", F.lit(0))))


def with_ops(df: DataFrame, profile: DataFrame) -> DataFrame:
    """Add availability group and operations by service; other services are dropped."""
    return df.join(profile, "service")


def outside_profile(df: DataFrame, profile: DataFrame) -> DataFrame:
    """Rows ``with_ops`` drops, for diagnosis."""
    return df.join(profile, "service", "left_anti")


def profile_services(mp: DataFrame) -> DataFrame:
    """(profile, service) of the metric profiles."""
    return mp.select("profile", "service").distinct()


def service_metrics(mp: DataFrame) -> DataFrame:
    """(profile, service, metrics): the sorted metrics of each service."""
    return (mp.groupBy("profile", "service")
            .agg(F.sort_array(F.collect_set("metric")).alias("metrics")))


def group_services(profile: DataFrame) -> DataFrame:
    """(ag_group, services): the sorted services of each availability group."""
    return (profile.groupBy("ag_group")
            .agg(F.sort_array(F.collect_set("service")).alias("services")))


def group_tags(df: DataFrame, keys: list[str]) -> DataFrame:
    """Tags of the first matching row of each key, as sorted entries."""
    entries = F.array_sort(F.map_entries("tags"))
    return df.groupBy(*keys).agg(F.min(entries).alias("tags"))


def ancestor_groups(gg: DataFrame) -> DataFrame:
    """(group, ancestor, depth) up the group tree, with the least depth.

    After k rounds all pairs of depth 2^k or less are known; a round joins them with themselves and keeps
    the least depth of each, so a tree of depth n takes about log2(n) rounds. The loop ends when
    a round has no new pair, so also on a cycle. Rounds are checkpointed: the lineage stays short, and each
    is computed once.
    """
    edges = gg.select(F.col("subgroup").alias("group"), F.col("group").alias("ancestor"), F.lit(1).alias("depth"))
    known = edges.where("`group` IS NOT NULL AND ancestor IS NOT NULL").distinct().checkpoint()
    pairs = known.count()
    while True:
        upper = known.select(F.col("group").alias("_at"), F.col("ancestor").alias("_up"), F.col("depth").alias("_more"))
        longer = known.join(upper, F.col("ancestor") == F.col("_at")).select(
            "group", F.col("_up").alias("ancestor"), (F.col("depth") + F.col("_more")).alias("depth"))
        both = known.unionByName(longer).groupBy("group", "ancestor").agg(F.min("depth").alias("depth"))
        known = both.checkpoint()
        before, pairs = pairs, known.count()
        if pairs == before:
            return known


def under_ancestors(df: DataFrame, closure: DataFrame, group: str = "name") -> DataFrame:
    """A row for each ancestor of a group, with ``ancestor``; groups without any are dropped."""
    return df.join(closure.select(F.col("group").alias(group), "ancestor"), group)
