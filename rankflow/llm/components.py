"""Connected components of a table of links, by hooking and pointer jumping.

Each round hooks every node to its smallest neighbour, flattens the chains by
pointer jumping, and contracts the links to those between different roots.
Nothing but row counts reaches the driver; every round is written to the
shared folder, so the plan stays short and a lost executor costs one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankflow.llm.common import written


def _ordered(links: DataFrame, a: str, b: str) -> DataFrame:
    return links.select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi")).where("lo < hi").distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node with a link; the root is the smallest node
    of its component."""
    edges = written(_ordered(links, a, b), "edges")
    found = None
    while not edges.isEmpty():
        both = edges.select(F.col("lo").alias("node"), F.col("hi").alias("to")).union(edges.select("hi", "lo"))
        tree = written(both.groupBy("node").agg(F.min("to").alias("to"))
                       .select("node", F.least("node", "to").alias("root")), "hooks")
        while True:
            # four steps up at once; hooked trees are rarely deeper
            one = tree.select(F.col("node").alias("u_node"), F.col("root").alias("u_root"))
            twice = written(tree.join(one, F.col("root") == F.col("u_node")).select("node", F.col("u_root").alias("root")), "jumps")
            two = twice.select(F.col("node").alias("v_node"), F.col("root").alias("v_root"))
            tree = written(twice.join(two, F.col("root") == F.col("v_node"))
                           .select("node", F.col("v_root").alias("root"), (F.col("root") != F.col("v_root")).alias("moved")), "jumps")
            if tree.where("moved").isEmpty():
                break
            tree = tree.drop("moved")
        tree = tree.drop("moved")
        if found is None:
            found = tree
        else:
            up = tree.select(F.col("node").alias("u"), F.col("root").alias("u_root"))
            found = written(found.join(up, F.col("root") == F.col("u"), "left")
                            .select("node", F.coalesce("u_root", "root").alias("root")), "roots")
        x, y = (tree.select(F.col("node").alias(f"{k}_node"), F.col("root").alias(f"{k}_root")) for k in "xy")
        edges = written(_ordered(edges.join(x, F.col("lo") == F.col("x_node")).join(y, F.col("hi") == F.col("y_node")),
                                 "x_root", "y_root"), "edges")
    if found is None:
        found = edges.select(F.col("lo").alias("node"), F.col("hi").alias("root"))
    return found
