"""Connected components of a link table, as DataFrame rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludex.session import stage_table


def connected_components(links: DataFrame) -> DataFrame:
    """``links`` (a, b) -> one row (node, comp) per linked node; ``comp`` is
    the least node reachable.

    In a round every node points to the least of itself and its neighbours,
    pointers are followed to their ends, and the edges are rewritten between
    these ends. Edges inside an end's tree go, so the edges of a star are read
    in one round or two, and later rounds read only what is still apart. The
    least node of a component is always an end and remains. Pointers, edges
    and labels stay distributed, each step written to the shared folder. Nodes
    may be of any orderable type. An empty table gives an empty table."""
    ordered = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    edges = stage_table(links.select(*ordered).where("a <> b").distinct(), "edges")
    rounds: list[DataFrame] = []
    while edges.limit(1).count():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        ends = _ends(stage_table(
            both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
            .select("node", F.least("node", "low").alias("comp")), "pointers"))
        rounds.append(ends)
        side = lambda s: ends.select(F.col("node").alias(s), F.col("comp").alias(f"end_{s}"))  # noqa: B023, E731
        edges = stage_table(
            edges.join(side("a"), "a").join(side("b"), "b")
            .select(F.least("end_a", "end_b").alias("a"), F.greatest("end_a", "end_b").alias("b"))
            .where("a <> b").distinct(), "edges")
    if not rounds:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("comp"))
    labels = rounds.pop()
    while rounds:  # the label of an end is that of all nodes that ended there
        last = labels.select(F.col("node").alias("comp"), F.col("comp").alias("last"))
        labels = stage_table(rounds.pop().join(last, "comp", "left").select(
            "node", F.coalesce("last", "comp").alias("comp")), "labels")
    return labels


def _ends(pointers: DataFrame) -> DataFrame:
    """``pointers`` (node, comp), where every comp is a node and not greater
    than its node: comp becomes the end of the node's chain. A step triples
    how far a pointer reaches."""
    while True:
        hop = lambda a, b: pointers.select(F.col("node").alias(a), F.col("comp").alias(b))  # noqa: B023, E731
        reached = stage_table(
            pointers.join(hop("comp", "second"), "comp").join(hop("second", "third"), "second")
            .select("node", F.col("third").alias("comp"),
                    (F.col("third") != F.col("second")).alias("moved")), "pointers")
        pointers = reached.select("node", "comp")
        if not reached.where("moved").limit(1).count():
            return pointers
