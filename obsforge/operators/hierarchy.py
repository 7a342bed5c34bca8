"""Parent-child links to full hierarchies by pointer doubling.

Every inner node (one that is somebody's parent) points at an ancestor; each
round joins the pointers with themselves, so the distance jumped doubles and the
path segments are concatenated.  Leaves are joined once, at the end.  If a round
resolves nobody, no acyclic node is left: were there one of depth d > 2^k, its
ancestor of depth 2^(k-1)+1 would have been resolved in round k.  The remaining
nodes are on or below loops; they go on without paths until the jumps exceed
their number, carrying the smallest id seen, which then covers the whole loop.

Defined cases: links with a null on either side are ignored, but the other id
counts as a node; repeated links count once; of several parents of one child the
smallest is taken; a link to oneself is a loop; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from obsforge.operators.skew import SHARE, hot_keys
from obsforge.session import materialize

LEAST, LONGEST = 1000, 4096


@dataclass
class Hierarchy:
    nodes: DataFrame  # node_id, root_id, node_depth, node_path
    loops: DataFrame  # node_id, loop_id: the ids on loops


def _jump(state: DataFrame, paths: bool, left: int) -> DataFrame:
    """One doubling of the pointers that aren't done, of which there are ``left``.

    After a few rounds a third of all nodes may point at one ancestor.  The rows of such ancestors, at most SHARE
    by their share of the pointers and with paths of at most LONGEST characters, are broadcast; the other pointers
    are shuffled to their ancestors.
    """
    u = state.where("NOT done")
    hot = F.broadcast(u.groupBy("anc").agg(F.count("*").alias("n")).where(F.col("n") > max(LEAST, left // SHARE)).select("anc"))
    a = state.select(*[F.col(c).alias(f"to_{c}") for c in ("node", "anc", "dist", "low", "done", "path")])
    heads = a.where(F.coalesce(F.length("to_path"), F.lit(0)) <= LONGEST).join(hot, F.col("to_node") == F.col("anc")).drop("anc")
    on = F.col("anc") == F.col("to_node")
    rest = u.join(F.broadcast(heads.select(F.col("to_node").alias("anc"))), "anc", "left_anti").select(u.columns)
    met = u.join(F.broadcast(heads), on).unionByName(rest.join(a, on))
    path = F.concat_ws("/", "to_path", "path") if paths else F.lit(None).cast("string")
    dist = F.col("dist") + F.col("to_dist") if paths else F.lit(0)
    return met.select("node", F.col("to_anc").alias("anc"), dist.alias("dist"), F.least("low", "to_low").alias("low"), F.col("to_done").alias("done"), path.alias("path"))


def hierarchy(links: DataFrame, parent: str = "parent", child: str = "child") -> Hierarchy:
    raw = links.select(F.col(parent).cast("long").alias("p"), F.col(child).cast("long").alias("c"))
    edges = materialize(raw.where("p IS NOT NULL AND c IS NOT NULL").groupBy("c").agg(F.min("p").alias("p")), "edges")
    ids = raw.select(F.explode(F.array("p", "c")).alias("node")).where("node IS NOT NULL").distinct()
    inner = edges.select(F.col("p").alias("node")).distinct()
    start = inner.join(edges, inner.node == edges.c, "left").select(
        "node", F.coalesce("p", "node").alias("anc"), F.when(F.col("p").isNull(), 0).otherwise(1).alias("dist"),
        F.coalesce("p", "node").alias("low"), F.col("p").isNull().alias("done"), F.col("node").cast("string").alias("path"),
    )
    state = materialize(start, "pointers")
    left = state.where("NOT done").count()
    reach = 1
    while left:
        fresh = materialize(_jump(state, True, left), "pointers")
        after = fresh.where("NOT done").count()
        state = state.where("done").unionByName(fresh)
        reach *= 2
        stuck, left = after == left, after
        if stuck:
            break
    looped = state.where("NOT done").withColumn("path", F.lit(None).cast("string"))
    while left and reach < left:
        looped = materialize(_jump(looped, False, left), "loops")
        reach *= 2
    # A jump of at least as many steps as there are nodes ends on the loop, and the ends are all of the loop's nodes.
    a, b = looped.alias("a"), looped.alias("b")
    below = a.join(b, F.col("a.anc") == F.col("b.node")).select(F.col("a.node").alias("node"), F.col("b.low").alias("loop"))
    on_loop = looped.select(F.col("anc").alias("node")).distinct()
    solved = materialize(
        state.where("done")
        .select("node", F.col("anc").alias("root_id"), F.col("dist").alias("node_depth"), F.col("path").alias("node_path"))
        .unionByName(below.select("node", F.col("loop").alias("root_id"), F.lit(-1).alias("node_depth"), F.lit("").alias("node_path"))),
        "inner",
    )
    outer = ids.join(inner, "node", "left_anti").join(edges, F.col("node") == F.col("c"), "left").select("node", "p")
    # A family head may have a third of all rows as children: its row is copied to as many salts as its children are spread over.
    hot = hot_keys(edges, "p").withColumn("hot", F.lit(True))
    salted = outer.join(F.broadcast(hot), "p", "left").withColumn("salt", F.when(F.col("hot"), F.pmod(F.hash("node"), F.lit(32))).otherwise(F.lit(0)))
    heads = solved.withColumnRenamed("node", "p").join(F.broadcast(hot), "p", "left")
    heads = heads.withColumn("salt", F.explode(F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(31))).otherwise(F.array(F.lit(0))))).drop("hot")
    leaves = salted.drop("hot").join(heads, ["p", "salt"], "left").select(
        F.col("node").alias("node_id"),
        F.coalesce("root_id", "node").alias("root_id"),
        F.when(F.col("p").isNull(), 0).when(F.col("node_depth") < 0, -1).otherwise(F.col("node_depth") + 1).cast("int").alias("node_depth"),
        F.when(F.col("p").isNull(), F.col("node").cast("string")).when(F.col("node_depth") < 0, "").otherwise(F.concat_ws("/", "node_path", "node")).alias("node_path"),
    )
    nodes = solved.select(F.col("node").alias("node_id"), "root_id", F.col("node_depth").cast("int").alias("node_depth"), "node_path").unionByName(leaves)
    loops = on_loop.join(below, "node").select(F.col("node").alias("node_id"), F.col("loop").alias("loop_id"))
    return Hierarchy(nodes, loops)


def descendants(nodes: DataFrame) -> DataFrame:
    """(ancestor_id, node_id, distance) for each node and each of its descendants outside loops, read off the paths."""
    steps = nodes.where("node_depth > 0").select("node_id", "node_depth", F.posexplode(F.split("node_path", "/")).alias("pos", "anc"))
    return steps.where("pos < node_depth").select(F.col("anc").cast("long").alias("ancestor_id"), "node_id", (F.col("node_depth") - F.col("pos")).cast("int").alias("distance"))


def summary(nodes: DataFrame) -> DataFrame:
    """Per root: members, greatest depth, and whether it stands for a loop."""
    return nodes.groupBy("root_id").agg(F.count("*").alias("members"), F.max("node_depth").alias("max_depth"), (F.min("node_depth") < 0).alias("looped"))
