"""Connected components by contraction in a random order, in about as many rounds as their size has bits."""

from pyspark.sql import DataFrame, functions as F

from parcelworks.llm.ordering import new_folder

def stored(df: DataFrame, name: str) -> DataFrame:
    """The table written below the shared folder and read again, so that no later failure recomputes it."""
    folder = new_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _moves(edges: DataFrame, number: int) -> DataFrame:
    """(a, b): where each vertex goes in a round: to the first vertex within two edges, then on from there.

    First is by a hash of the id and the round's number, so it has nothing to do with how ids run
    along a chain. Only vertices that come first among all within two edges stay: one of five in a
    chain, one in a star or a clique.
    """
    both = edges.union(edges.selectExpr("b AS a", "a AS b")).union(edges.selectExpr("a", "a AS b"))
    both = both.union(edges.selectExpr("b AS a", "b"))
    nearest = both.groupBy("a").agg(F.expr(f"min(struct(xxhash64(b, {number}L) AS place, b AS id)) AS first"))
    nearest = stored(nearest, "nearest")
    second = both.join(nearest.selectExpr("a AS b", "first"), "b").groupBy("a").agg(F.expr("min(first).id AS b"))
    second = stored(second, "steps")
    following = second.selectExpr("a AS b", "b AS next")
    return stored(second.join(following, "b").selectExpr("a", "next AS b"), "moves")


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every vertex of edges (a, b): the smallest id that it reaches.

    Each round moves every vertex along the edges and keeps the edges between different places;
    both ends of an edge move, so what was connected stays connected. Rounds are as many as the
    logarithm of the vertices, expected over the hash, also for chains. Each round's moves
    are applied to all vertices and stored, so no plan grows with the rounds. A vertex with very
    many edges is combined on the map side before it is shuffled, and Spark splits the large
    partitions of the joins. Self-loops count as vertices; null ids are left out.
    """
    named = edges.select("a", "b").filter("a IS NOT NULL AND b IS NOT NULL")
    left = stored(named.distinct(), "edges")
    places, number = None, 0
    while not left.isEmpty():
        moves = _moves(left, number)
        if places is None:
            places = moves.selectExpr("a AS id", "b AS place")
        else:
            step = moves.selectExpr("a AS place", "b AS next")
            places = places.join(step, "place", "left").selectExpr("id", "coalesce(next, place) AS place")
            places = stored(places, "places")
        first, second = moves.selectExpr("a", "b AS new_a"), moves.selectExpr("a AS b", "b AS new_b")
        moved = left.join(first, "a").join(second, "b").filter("new_a <> new_b")
        left = stored(moved.selectExpr("least(new_a, new_b) AS a", "greatest(new_a, new_b) AS b").distinct(), "edges")
        number += 1
    if places is None:
        return left.selectExpr("a AS id", "b AS component")
    least = places.groupBy("place").agg(F.expr("min(id) AS component"))
    return stored(places.join(least, "place").select("id", "component"), "components")
