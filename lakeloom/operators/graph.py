"""Common neighbours and shortest hop paths on edge lists.

A graph is a DataFrame ``(src, dst)`` of strings with distinct rows: ``src`` lists ``dst``. One row per edge
lets Spark split the list of a hub; no list is ever gathered into one row before a join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.text import strip_ascii
from lakeloom.session import enable_checkpoints


def parse_neighbor_lists(lines: DataFrame) -> DataFrame:
    """Edges of lines ``A:B,C,D``."""
    parts = F.split(strip_ascii("value"), ":")
    return lines.select(
        F.get(parts, F.lit(0)).alias("src"), F.explode(F.split(F.get(parts, F.lit(1)), ",")).alias("dst")).distinct()


def parse_adjacency(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes ``(node, path, dist)`` and edges of lines ``node path dist neighbour...``."""
    tokens = lines.select(F.split(strip_ascii("value"), " ").alias("t")).select(
        F.get("t", F.lit(0)).alias("node"), F.get("t", F.lit(1)).alias("path"),
        F.get("t", F.lit(2)).try_cast("int").alias("dist"), "t").where(F.col("dist").isNotNull())
    edges = tokens.where(F.size("t") > 3).select(
        F.col("node").alias("src"), F.explode(F.slice("t", 4, F.size("t"))).alias("dst")).distinct()
    return tokens.select("node", "path", "dist"), edges


def both_ways(edges: DataFrame) -> DataFrame:
    """Every edge in both directions, once, without loops."""
    ends = F.array(F.struct("src", "dst"), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst")))
    return edges.where(F.col("src") != F.col("dst")).select(F.inline(ends)).distinct()


def stored(edges: DataFrame) -> DataFrame:
    """Edges written once to the checkpoint folder, for the operators below, which read them several times."""
    enable_checkpoints(edges.sparkSession)
    return edges.checkpoint()


#: Who lists whom in a pair (a, b); bits.
FIRST_LISTS, SECOND_LISTS, LOOP = 1, 2, 4
MUTUAL = FIRST_LISTS | SECOND_LISTS


def common_neighbors(edges: DataFrame) -> DataFrame:
    """For every connected pair, one row per neighbour both list: ``a, b, neighbor, list_of``, with ``a <= b``.

    Where only one end lists the other, its whole list counts: such a pair is one row that names it in ``list_of``, and
    ``with_whole_lists`` writes the list out, n times for a node that lists n others. A pair with nothing in common keeps one
    row with a NULL neighbour. Three nodes linked with each other are found once, from the one with the fewest links, and
    give the rows of all their pairs. So a hub costs no more than its neighbours' lists: of n links no node has more than
    sqrt(2 n) to nodes with as many links as itself. The pairs are written once, when this is called.
    """
    pairs = stored(pairs_of(edges))
    ranked = ranked_pairs(pairs)
    shared = _common_of_triangles(wedges(links(ranked)), links(ranked)).unionByName(_common_of_loops(ranked))
    list_of = F.when(F.col("lists").isin(FIRST_LISTS, LOOP, FIRST_LISTS | LOOP), F.col("a")).when(
        F.col("lists") == SECOND_LISTS, F.col("b")).alias("list_of")
    return pairs.select("a", "b", list_of).join(shared, ["a", "b"], "left").select("a", "b", "neighbor", "list_of")


def pairs_of(edges: DataFrame) -> DataFrame:
    """``a, b, lists``: each connected pair with the bits of who lists whom."""
    a, b = F.least("src", "dst"), F.greatest("src", "dst")
    lists = F.when(F.col("src") == F.col("dst"), LOOP).when(F.col("src") == a, FIRST_LISTS).when(
        F.col("src") == b, SECOND_LISTS).otherwise(0)
    return edges.select(a.alias("a"), b.alias("b"), lists.alias("lists")).groupBy("a", "b").agg(
        F.bit_or("lists").alias("lists"))


def ranked_pairs(pairs: DataFrame) -> DataFrame:
    """Pairs of different nodes with the rank of both: four times its number of links, + 1 if any is mutual, + 2 if it lists itself."""
    marks = F.when(F.col("lists") == MUTUAL, 1).when(F.col("lists").bitwiseAND(LOOP) > 0, 2).otherwise(0)
    rank = pairs.select(F.explode(F.array("a", "b")).alias("node"), marks.alias("marks")).groupBy("node").agg(
        (4 * F.count("*") + F.bit_or("marks")).alias("rank"))
    of_a, of_b = (rank.select(F.col("node").alias(x), F.col("rank").alias(f"rank_{x}")) for x in "ab")
    return pairs.where(F.col("a") != F.col("b")).join(of_a, "a").join(of_b, "b")


def links(ranked: DataFrame) -> DataFrame:
    """``low, high, high_rank, lists``: each pair from its end with the fewer links, without those that no mutual pair can use."""
    a_low = F.col("rank_a") <= F.col("rank_b")  # equal ranks go by name, and a < b
    turned = F.when(F.col("lists") == FIRST_LISTS, SECOND_LISTS).when(F.col("lists") == SECOND_LISTS, FIRST_LISTS).otherwise(
        F.col("lists"))
    # A list counts only in a mutual pair of its node.
    used = F.when(F.col("lists") == SECOND_LISTS, F.col("rank_b")).otherwise(F.col("rank_a")).bitwiseAND(1) > 0
    return ranked.where(used).select(
        F.when(a_low, F.col("a")).otherwise(F.col("b")).alias("low"),
        F.when(a_low, F.col("b")).otherwise(F.col("a")).alias("high"),
        F.greatest("rank_a", "rank_b").alias("high_rank"),
        F.when(a_low, F.col("lists")).otherwise(turned).alias("lists"))


def wedges(links: DataFrame) -> DataFrame:
    """``low, mid, high, to_mid, to_high``: any two links of their common lowest node that a mutual pair can use."""
    mid = links.select("low", F.col("high").alias("mid"), F.col("high_rank").alias("mid_rank"), F.col("lists").alias("to_mid"))
    high = links.select("low", "high", "high_rank", F.col("lists").alias("to_high"))
    both = F.col("to_mid").bitwiseAND(F.col("to_high"))
    one_mutual = (F.col("to_mid") == MUTUAL) | (F.col("to_high") == MUTUAL)
    useful = (one_mutual & (both.bitwiseAND(FIRST_LISTS) > 0)) | (both.bitwiseAND(SECOND_LISTS) > 0)
    return mid.join(high, "low").where(
        (F.struct("mid_rank", "mid") < F.struct("high_rank", "high")) & useful).select(
        "low", "mid", "high", "to_mid", "to_high")


def _common_of_triangles(wedges: DataFrame, links: DataFrame) -> DataFrame:
    """``a, b, neighbor`` of the wedges whose ends are linked."""
    def listed(column: str, bit: int):
        return F.col(column).bitwiseAND(bit) > 0

    def common(x: str, y: str, neighbor: str, holds):
        return F.when(holds, F.struct(F.least(x, y).alias("a"), F.greatest(x, y).alias("b"), F.col(neighbor).alias("neighbor")))

    found = F.array(
        common("low", "mid", "high", (F.col("to_mid") == MUTUAL) & listed("to_high", FIRST_LISTS) & listed("across", FIRST_LISTS)),
        common("low", "high", "mid", (F.col("to_high") == MUTUAL) & listed("to_mid", FIRST_LISTS) & listed("across", SECOND_LISTS)),
        common("mid", "high", "low", (F.col("across") == MUTUAL) & listed("to_mid", SECOND_LISTS) & listed("to_high", SECOND_LISTS)))
    across = links.select(F.col("low").alias("mid"), "high", F.col("lists").alias("across"))
    return wedges.join(across, ["mid", "high"]).select(F.inline(F.array_compact(found)))


def _common_of_loops(ranked: DataFrame) -> DataFrame:
    """``a, b, neighbor`` of mutual pairs one end of which lists itself: both ends list it."""
    def common(x: str):
        holds = (F.col("lists") == MUTUAL) & (F.col(f"rank_{x}").bitwiseAND(2) > 0)
        return F.when(holds, F.struct("a", "b", F.col(x).alias("neighbor")))

    return ranked.select(F.inline(F.array_compact(F.array(common("a"), common("b")))))


def with_whole_lists(common: DataFrame, edges: DataFrame) -> DataFrame:
    """``a, b, neighbor`` of ``common_neighbors`` with the lists of one-sided pairs written out."""
    lists = edges.select(F.col("src").alias("list_of"), F.col("dst").alias("neighbor"))
    whole = common.where(F.col("list_of").isNotNull()).drop("neighbor").join(lists, "list_of")
    return common.where(F.col("list_of").isNull()).select("a", "b", "neighbor").unionByName(
        whole.select("a", "b", "neighbor"))


def shortest_paths(nodes: DataFrame, edges: DataFrame, rounds: int = 4) -> DataFrame:
    """Hop distance and path from the nodes that have ``dist >= 0``, after at most ``rounds`` hops.

    ``nodes`` is ``(node, path, dist)`` with -1 and ``_`` where not reached yet. A path lists the
    nodes before it, nearest first; of equally short ones the first in text order stays. Only the
    nodes reached last are expanded. Each round writes what it reached, and no more, to the checkpoint
    folder, so a lost executor costs one round. Stops as soon as a round reaches nothing new.
    """
    enable_checkpoints(nodes.sparkSession)
    levels = [nodes.where(F.col("dist") >= 0).select("node", "path", "dist").checkpoint()]
    for _ in range(rounds):
        step = levels[-1].join(edges, F.col("node") == F.col("src")).groupBy(F.col("dst").alias("node")).agg(
            F.min(F.struct((F.col("dist") + 1).alias("dist"), F.concat("node", F.lit(":"), "path").alias("path")))
            .alias("best"))
        # Starting nodes may lie at different distances, so a later hop can still shorten a path.
        known = _all(levels).groupBy("node").agg(F.min("dist").alias("known_dist"))
        level = step.join(known, "node", "left").where(
            F.col("known_dist").isNull() | (F.col("best.dist") < F.col("known_dist"))).select(
            "node", "best.path", "best.dist").checkpoint()
        if level.isEmpty():
            break
        levels.append(level)
    best = _all(levels).groupBy("node").agg(F.min(F.struct("dist", "path")).alias("best"))
    return nodes.select("node", F.col("path").alias("_path"), F.col("dist").alias("_dist")).join(
        best, "node", "left").select(
        "node", F.coalesce("best.path", "_path").alias("path"), F.coalesce("best.dist", "_dist").alias("dist"))


def _all(levels: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, levels)
