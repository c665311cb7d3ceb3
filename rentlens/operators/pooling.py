"""Pooling of small sectors with the sector of the closest code.

Everything here works on the table of sector counts, never on listings. Its size is segments x sectors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentlens.functions.text import code_similarity
from rentlens.operators.clean import SEGMENT
from rentlens.sources.store import stage

LONGEST = 5


def sector_counts(df: DataFrame, by: list[str] = SEGMENT, code: str = "CODIGO_BARRIO") -> DataFrame:
    return df.groupBy(*by, F.col(code).alias("code")).agg(F.count(F.lit(1)).alias("n"))


def small_sectors(counts: DataFrame, cutoff: int = 10) -> DataFrame:
    return counts.filter(F.col("n") <= cutoff)


def nearest_code(counts: DataFrame, by: list[str] = SEGMENT, cutoff: int = 10) -> DataFrame:
    """The neighbour of each small sector: longest shared prefix (5 to 0 characters), then similarity, then
    size, then the smaller code. A sector alone in its segment has none.

    Each sector is compared only inside the longest prefix it shares with another one. A sector alone below
    that prefix is one of at most an alphabet of such sectors, so pairs grow linearly with the sectors.
    """
    nodes = (counts.withColumn("len", F.explode(F.sequence(F.lit(0), F.lit(LONGEST))))
             .filter(F.col("len") <= F.length("code"))
             .withColumn("prefix", F.expr("substring(code, 1, len)")))
    shared = nodes.groupBy(*by, "len", "prefix").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    level = (nodes.filter(F.col("n") <= cutoff).join(shared, [*by, "len", "prefix"], "left_semi")
             .groupBy(*by, F.col("code").alias("own")).agg(F.max("len").alias("len")))
    level = level.withColumn("prefix", F.expr("substring(own, 1, len)"))
    pairs = level.join(nodes, [*by, "len", "prefix"]).filter(F.col("own") != F.col("code"))
    rank = F.struct((-code_similarity(F.col("own"), F.col("code"))).alias("far"),
                    (-F.col("n")).alias("few"), F.col("code").alias("code"))
    best = pairs.groupBy(*by, "own").agg(F.min(rank).alias("best"), F.max("len").alias("prefix_len"))
    return best.select(*by, F.col("own").alias("code"), F.col("best.code").alias("neighbour"), "prefix_len",
                       (-F.col("best.far")).alias("similarity"), (-F.col("best.few")).alias("n_neighbour"))


def chain_roots(links: DataFrame, by: list[str] = SEGMENT) -> DataFrame:
    """Follow neighbours to the first sector that is not small; on a cycle, to its last sector in code order.

    Pointer jumping: every jump doubles the distance covered and carries the greatest code passed. It stops
    when nothing moves, or once the distance exceeds the sectors of the largest segment, as on a cycle.
    """
    state = stage(links.select(*by, "code", F.col("neighbour").alias("to"), F.col("code").alias("top")), "links")
    covered, longest = 1, None
    while True:
        state = stage(_jump(_jump(state, by).drop("changed"), by), "links")
        still = state.filter("changed").isEmpty()
        state = state.drop("changed")
        covered *= 4
        if not still and covered > 1000 and longest is None:
            longest = state.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
        if still or (longest is not None and covered > 2 * longest):
            break
    # a target that is itself small lies on a cycle; its greatest code passed is the root
    cycle = state.select(*by, F.col("code").alias("to"), F.col("top").alias("cycle_top"))
    return state.join(cycle, [*by, "to"], "left").select(
        *by, "code", F.coalesce("cycle_top", "to").alias("root"))


def _jump(state: DataFrame, by: list[str]) -> DataFrame:
    """Double the distance of every sector: continue with what its target has covered."""
    ahead = state.select(*by, F.col("code").alias("to"), F.col("to").alias("next"), F.col("top").alias("next_top"))
    return state.join(ahead, [*by, "to"], "left").select(
        *by, "code", F.coalesce("next", "to").alias("to"),
        F.greatest("top", F.coalesce("next_top", "top")).alias("top"),
        (F.col("next").isNotNull()
         & ((F.col("next") != F.col("to")) | (F.col("next_top") > F.col("top")))).alias("changed"))


def merges(counts: DataFrame, by: list[str] = SEGMENT, cutoff: int = 10) -> DataFrame:
    """One round: (segment, code, root) of the sectors that join another one."""
    return chain_roots(nearest_code(counts, by, cutoff), by).filter(F.col("root") != F.col("code"))


def pool_sectors(counts: DataFrame, by: list[str] = SEGMENT, cutoff: int = 10) -> DataFrame:
    """(segment, code, n, pool): merge small sectors until no pool of a segment has fewer than ``cutoff`` rows.

    Sectors with up to ``cutoff`` rows merge, pools under ``cutoff`` ask for another round. A segment stops
    when one pool is left or a round changes nothing.
    """
    pools = stage(counts.select(*by, "code", "n", F.col("code").alias("pool")), "pools")
    sizes = pools.select(*by, "code", "n")
    while True:
        roots = merges(stage(sizes, "pool-sizes"), by, cutoff).withColumnRenamed("code", "pool")
        pools = stage(pools.drop("moved").join(roots, [*by, "pool"], "left").select(
            *by, "code", "n", F.coalesce("root", "pool").alias("pool"),
            F.col("root").isNotNull().alias("moved")), "pools")
        totals = pools.groupBy(*by, "pool").agg(F.sum("n").alias("n"), F.max("moved").alias("moved"))
        again = (totals.groupBy(*by).agg(F.min("n").alias("least"), F.count(F.lit(1)).alias("pools"),
                                         F.max("moved").alias("moved"))
                 .filter((F.col("least") < cutoff) & (F.col("pools") > 1) & F.col("moved")).select(*by))
        if again.isEmpty():
            return pools.select(*by, "code", "n", "pool")
        sizes = totals.join(again, by, "left_semi").select(*by, F.col("pool").alias("code"), "n")


def pool_codes(df: DataFrame, by: list[str] = SEGMENT, code: str = "CODIGO_BARRIO",
               cutoff: int = 10) -> DataFrame:
    """Rows with CODIGO_BARRIO_NEW, the code of their pool."""
    pools = pool_sectors(sector_counts(df, by, code), by, cutoff)
    mapping = pools.select(*by, F.col("code").alias(code), F.col("pool").alias("CODIGO_BARRIO_NEW"))
    return df.join(mapping, [*by, code], "left").withColumn(
        "CODIGO_BARRIO_NEW", F.coalesce("CODIGO_BARRIO_NEW", code))
