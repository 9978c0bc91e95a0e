"""Graph operators on small graphs and against plain Python."""

import random

import pytest

from lakeloom.operators import graph


def neighbor_sets(df):
    found = {}
    for r in df.collect():
        found.setdefault((r.a, r.b), set())
        if r.neighbor is not None:
            found[r.a, r.b].add(r.neighbor)
    return found


def py_common(lists):
    result = {}
    for node, friends in lists.items():
        for friend in friends:
            pair = tuple(sorted((node, friend)))
            result[pair] = result[pair] & friends if pair in result else set(friends)
    return result


def test_common_neighbors_of_lists(lines):
    """A wheel: the hub knows all five rim nodes, and each of those its two sides."""
    edges = graph.parse_neighbor_lists(lines(
        "hub:p,q,r,s,t", "p:hub,q,t", "q:hub,p,r", "r:hub,q,s", "s:hub,r,t", "t:hub,s,p"))
    found = neighbor_sets(graph.common_neighbors(edges))
    assert found["hub", "p"] == {"q", "t"}
    assert found["p", "q"] == {"hub"}
    assert found["s", "t"] == {"hub"}
    assert len(found) == 10


def test_one_sided_edge_gives_the_whole_list(lines):
    edges = graph.parse_neighbor_lists(lines("A:B,C", "C:A"))
    common = graph.common_neighbors(edges)
    assert {(r.a, r.b, r.list_of) for r in common.collect()} == {("A", "B", "A"), ("A", "C", None)}
    found = neighbor_sets(graph.with_whole_lists(common, edges))
    assert found == {("A", "B"): {"B", "C"}, ("A", "C"): set()}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_common_neighbors_at_random(spark, seed):
    """Directed lists with a hub that everybody lists."""
    rnd = random.Random(seed)
    names = [f"n{i}" for i in range(30)]
    lists = {n: {m for m in names if m != n and (m == "n0" or n == "n0" or rnd.random() < 0.2)} for n in names}
    edges = spark.createDataFrame([(a, b) for a, bs in lists.items() for b in bs], "src string, dst string")
    assert neighbor_sets(graph.with_whole_lists(graph.common_neighbors(edges), edges)) == py_common(lists)


@pytest.mark.parametrize("seed", [4, 5])
def test_common_neighbors_are_rows_once_with_loops(spark, seed):
    """Directed lists, sparse and dense, some of which name their own node."""
    rnd = random.Random(seed)
    names = [f"n{i}" for i in range(24)]
    lists = {n: {m for m in names if rnd.random() < (0.2 if seed == 4 else 0.6)} for n in names}
    edges = spark.createDataFrame([(a, b) for a, bs in lists.items() for b in bs], "src string, dst string")
    rows = [tuple(r) for r in graph.common_neighbors(edges).collect()]
    assert len(rows) == len(set(rows))
    want = set()
    for a, b in {tuple(sorted((x, y))) for x in names for y in lists[x]}:
        mutual = a != b and b in lists[a] and a in lists[b]
        both = lists[a] & lists[b] if mutual else set()
        list_of = None if mutual else a if b in lists[a] else b
        want |= {(a, b, c, list_of) for c in both or [None]}
    assert set(rows) == want


def test_each_triangle_is_looked_up_once(spark):
    """220 triangles of a clique of 12; a hub of 50 others, unlinked with each other, gives nothing to look up."""
    names = [f"n{i:02d}" for i in range(12)]
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1:]] + [("hub", f"s{i}") for i in range(50)]
    edges = graph.both_ways(spark.createDataFrame(pairs, "src string, dst string"))
    probed = graph.wedges(graph.links(graph.ranked_pairs(graph.pairs_of(edges))))
    assert probed.count() == 220
    assert graph.common_neighbors(edges).where("neighbor IS NOT NULL").count() == 660


ADJACENCY = ["k1 _ 0 k2 k3", "k2 _ -1 k4", "k3 _ -1 k4 k5", "k4 _ -1 k6", "k5 _ -1 k6", "k6 _ -1 k1 k7", "k7 _ -1",
             "alone _ -1", "bad _ x k1"]


def paths(lines, rounds):
    nodes, edges = graph.parse_adjacency(lines(*ADJACENCY))
    return {r.node: (r.path, r.dist) for r in graph.shortest_paths(nodes, edges, rounds).collect()}


def test_shortest_paths(lines):
    assert paths(lines, 4) == {
        "k1": ("_", 0), "k2": ("k1:_", 1), "k3": ("k1:_", 1), "k4": ("k2:k1:_", 2), "k5": ("k3:k1:_", 2),
        "k6": ("k4:k2:k1:_", 3), "k7": ("k6:k4:k2:k1:_", 4), "alone": ("_", -1)}


def test_rounds_bound_the_search(lines):
    found = paths(lines, 2)
    assert found["k5"] == ("k3:k1:_", 2)
    assert found["k6"] == ("_", -1)


def test_equal_paths_take_the_first_in_text_order(lines):
    nodes, edges = graph.parse_adjacency(lines("S _ 0 b a", "a _ -1 T", "b _ -1 T", "T _ -1"))
    found = {r.node: r.path for r in graph.shortest_paths(nodes, edges).collect()}
    assert found["T"] == "a:S:_"


def test_starting_nodes_at_different_distances(lines):
    """d is first reached from the far start, then over a shorter path from the near one."""
    nodes, edges = graph.parse_adjacency(lines("n _ 0 a", "a _ -1 b", "b _ -1 d", "f _ 9 d", "d _ -1 e", "e _ -1"))
    found = {r.node: (r.path, r.dist) for r in graph.shortest_paths(nodes, edges, 5).collect()}
    assert found["d"] == ("b:a:n:_", 3)
    assert found["e"] == ("d:b:a:n:_", 4)
    assert found["f"] == ("_", 9)


def test_paths_at_random_match_breadth_first_search(spark):
    rnd = random.Random(11)
    names = [f"n{i:02d}" for i in range(40)]
    links = {(a, b) for a in names for b in names if a != b and rnd.random() < 0.05}
    links |= {("n00", b) for b in names[1:15]}
    want, frontier = {"n00": ("_", 0)}, ["n00"]
    for hop in range(1, 5):
        reached = {}
        for a, b in links:
            if a in frontier and b not in want:
                reached[b] = min(reached.get(b, "~"), f"{a}:{want[a][0]}")
        want.update({b: (path, hop) for b, path in reached.items()})
        frontier = list(reached)
    nodes = spark.createDataFrame(
        [(n, "_", 0 if n == "n00" else -1) for n in names], "node string, path string, dist int")
    edges = graph.stored(spark.createDataFrame(sorted(links), "src string, dst string"))
    found = {r.node: (r.path, r.dist) for r in graph.shortest_paths(nodes, edges, 4).collect()}
    assert found == {n: want.get(n, ("_", -1)) for n in names}


def test_both_ways(spark, rows):
    edges = spark.createDataFrame([("a", "b"), ("b", "a"), ("c", "c"), ("a", "c")], "src string, dst string")
    assert rows(graph.both_ways(edges)) == [("a", "b"), ("a", "c"), ("b", "a"), ("c", "a")]
