"""A Merkle manifest of a dataset: a leaf for each row, a tree of three for each group, and one over the groups.

The leaves of a group stand by id. Runs of three neighbours, the last may be shorter, become a node each, the SHA-256 of their
digests, until one node is left; the same joins the groups' roots, ordered by name. A level is one window: rows are partitioned
by group and parent index, and the ordered list of the whole frame gives the parent's preimage as well as each row's siblings. One row
of each run then stands for the parent on the next level, so levels shrink threefold. Digests travel as 32 bytes.

A row's proof is its siblings on all levels. It is put together from the top: each node gets its own siblings and those
of its parent, so that what is shuffled on the way down shrinks threefold with each level, too. No group, level or run has to fit in a task: leaves
are numbered by a range sort over all groups with a count for each partition and group, so a group of a third of all rows is many tasks' work.

Null fields are told from empty ones. Null ids come first in a group and null groups first of all; rows of one id are
ordered by their leaf, and equal rows are leaves next to each other. An empty table gives an empty result.
A group of one row is its own root; one group's root is the root. Columns that aren't named don't count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arborlens.llm.common import cut, cut_small

#: Nodes of a run.
ARITY = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field(c: Column) -> Column:
    """- for null, else the number of bytes of the value's text, a colon and the text."""
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(columns: dict[str, Column]) -> Column:
    """The leaf, 32 bytes, of a row's fields in their order."""
    return F.unhex(F.sha2(F.concat(*[field(c) for c in columns.values()]), 256))


def hex_of(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def joined(digests: Column) -> Column:
    """Digests as hex text, one after another."""
    return F.array_join(F.transform(digests, hex_of), "")


def numbered(leaves: DataFrame, group: str, order: list[Column]) -> DataFrame:
    """leaves with _i, their place in their group from 0, and _n, the rows of the group.

    Rows are sorted by range over all groups; the rows of a group before a partition, and in all, are sums over a table of one row per
    partition and group, so a group of most rows is joined in as many pieces as it has partitions.
    """
    first = F.col(group).asc_nulls_first()
    ranged = cut(leaves.repartitionByRange(first, *order).sortWithinPartitions(first, *order).withColumn("_m", F.monotonically_increasing_id()))
    counts = ranged.groupBy(F.shiftright("_m", 33).alias("_p"), F.col(group).alias("_g")).agg(F.count(F.lit(1)).alias("_k"), F.min("_m").alias("_least"))
    mine = Window.partitionBy("_g")
    before = F.coalesce(F.sum("_k").over(mine.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("_p", "_g", (before - F.col("_least")).alias("_shift"), F.sum("_k").over(mine).alias("_n"))
    same = (F.shiftright("_m", 33) == F.col("_p")) & F.col(group).eqNullSafe(F.col("_g"))
    return ranged.join(starts, same).select(*leaves.columns, (F.col("_m") + F.col("_shift")).alias("_i"), "_n")


def levels(nodes: DataFrame, group: str, most: int, extra: list[str]) -> tuple[list[DataFrame], DataFrame]:
    """All levels from nodes (group, _i, _h, _n: nodes of the group on this level, and extra columns, which the lowest level keeps), and the root of each group.

    A level has, for each node, _left and _right, the digests of its run before and after it. most: the largest group.
    """
    made, roots = [], nodes.where("_n = 1").select(group, F.col("_h").alias("_root"))
    w = Window.partitionBy(group, "_parent").orderBy("_i").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    at = (F.col("_i") % ARITY).cast("int")
    while most > 1:
        run = nodes.where("_n > 1").withColumn("_parent", F.expr(f"_i div {ARITY}")).withColumn("_run", F.collect_list("_h").over(w))
        around = [F.slice("_run", F.lit(1), at).alias("_left"), F.slice("_run", at + 2, F.lit(ARITY)).alias("_right")]
        level = cut_small(run.select(group, "_i", "_parent", "_n", "_h", *around, *(extra if not made else [])))
        made.append(level)
        parent = F.unhex(F.sha2(F.concat(hex_of(F.col("_h")), joined(F.col("_right"))), 256))
        nodes = level.where(f"_i % {ARITY} = 0").select(group, F.col("_parent").alias("_i"), parent.alias("_h"), F.expr(f"(_n + {ARITY - 1}) div {ARITY}").alias("_n"))
        roots = roots.unionByName(nodes.where("_n = 1").select(group, F.col("_h").alias("_root")))
        most = -(-most // ARITY)
    return made, roots


def paths(made: list[DataFrame], group: str, top: DataFrame, extra: list[str]) -> DataFrame | None:
    """Nodes of the lowest level that have a parent: group, _i, _path, the other columns of top, and extra. A path is an array of (left, right), from a node's own run up to the root of all.

    top: group, _path of each group's root, and columns to hand down. None where no group has two nodes.
    """
    handed = [c for c in top.columns if c not in (group, "_path")]
    over = [F.col(group).alias("_og"), F.col("_path").alias("_op"), *handed]
    own = F.array(F.struct(F.col("_left").alias("left"), F.col("_right").alias("right")))
    above = None
    for level in reversed(made):
        wanted = [group, "_i", F.concat(own, "_op").alias("_path"), *handed, *(extra if level is made[0] else [])]
        # at most ARITY nodes of a group stand right below its root
        found = level.where(F.col("_n") <= ARITY).join(top.select(*over), F.col(group).eqNullSafe(F.col("_og"))).select(*wanted)
        if above is not None:
            deep = level.where(F.col("_n") > ARITY).join(above.select(*over, F.col("_i").alias("_oi")), F.col(group).eqNullSafe(F.col("_og")) & (F.col("_parent") == F.col("_oi")))
            found = found.unionByName(deep.select(*wanted))
        above = found
    return above


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to, as hex."""
    return F.aggregate(path, hex_of(leaf), lambda h, run: F.sha2(F.concat(joined(run["left"]), h, joined(run["right"])), 256))


def proof_digest(path: Column) -> Column:
    """SHA-256 of all siblings as hex text, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda run: F.concat(joined(run["left"]), joined(run["right"]))), ""), 256)


def manifest(rows: DataFrame, group: str, id_col: str, leaf: str, others: list[str]) -> DataFrame:
    """rows with subroot and root (hex), and _path, from columns group, id_col, leaf (32 bytes) and others, which are kept."""
    kept = [id_col, leaf, *others]
    leaves = cut(numbered(rows.select(group, *kept), group, [F.col(id_col).asc_nulls_first(), F.col(leaf).asc()]).withColumn("_h", F.col(leaf)))
    made, roots = levels(leaves, group, leaves.agg(F.max("_n")).first()[0] or 0, kept)
    # the tree over the groups: one group of all roots
    named = roots.select(F.lit(0).alias("_all"), F.col(group).alias("_name"), F.col("_root").alias("_h"))
    over = cut_small(numbered(named, "_all", [F.col("_name").asc_nulls_first()]).withColumn("_sub", F.col("_h")))
    upper, root = levels(over, "_all", over.agg(F.max("_n")).first()[0] or 0, ["_name", "_sub"])
    end = F.array().cast("array<struct<left:array<binary>,right:array<binary>>>").alias("_path")
    below = paths(upper, "_all", root.select("_all", end), ["_name", "_sub"])
    tops = over.select("_name", "_sub", end) if below is None else below.select("_name", "_sub", "_path")
    top = cut_small(tops.join(F.broadcast(root.select("_root"))).select(F.col("_name").alias("_og"), "_sub", "_root", "_path"))  # beside one row
    out = leaves.where("_n = 1").join(top, F.col(group).eqNullSafe(F.col("_og"))).select(group, *kept, "_sub", "_root", "_path")
    deep = paths(made, group, top.withColumnRenamed("_og", group), kept)
    if deep is not None:
        out = out.unionByName(deep.select(*out.columns))
    return out.select(group, *kept, hex_of(F.col("_sub")).alias("subroot"), hex_of(F.col("_root")).alias("root"), "_path")


def verify(docs: DataFrame, tampered: dict[str, Column], fields: tuple[str, ...] = FIELDS, group: str = "source", id_col: str = "doc_id") -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256 of the rows as they are, and folded_root and verified for rows with some columns replaced.

    tampered: what stands for a named field when a row is checked against its proof.
    """
    as_they_are = {f: F.col(f"`{f}`") for f in fields}
    given = docs.select(F.col(f"`{group}`").alias("_group"), F.col(f"`{id_col}`").cast("long").alias("_id"), leaf_of(as_they_are).alias("_leaf"), leaf_of(as_they_are | tampered).alias("_now"))
    made = manifest(given, "_group", "_id", "_leaf", ["_now"])
    out = made.select(F.col("_id").alias("doc_id"), hex_of(F.col("_leaf")).alias("leaf"), "subroot", "root", proof_digest(F.col("_path")).alias("proof_sha256"), folded(F.col("_now"), F.col("_path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
