"""Merkle dataset manifest: one digest for a table, by group, with a proof for every row.

Leaves of a group stand in order; every ``fanout`` consecutive nodes have one parent, until one node remains: the
group's subroot. The subroots, in the order of their groups, are the leaves of the tree above, whose node is the root.

* Slot pivot: conditional aggregates spread the nodes below one ancestor, ``fanout ** step`` of them, into as many slot
  columns of its row. Runs of ``fanout`` columns, concatenated, give the parents, and so on up to the ancestor: one
  exchange for ``step`` levels, and all of them together move each node about once.
* The stored columns give the siblings: a run's columns without the own one. Paths go down the stored tables, so only
  ancestors carry a path through an exchange (one for ``fanout ** step`` children); rows get theirs at the end.
* Keys of all exchanges and joins are (group, ancestor), so a group that holds most rows spreads over all tasks. Positions
  come from running totals over range partitions. Nothing but the height of the tree passes the driver.

Cases: NULL fields hash as ``-``, NULL groups are a group and come first, NULL order values come first; rows of one order
value stand by their leaf, and equal rows next to each other, each with its own place and proof. A group of one row is its own subroot.
A table without rows gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldloom.operators.order import running_totals
from fieldloom.session import materialise


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the parts one after the other; NULL parts add nothing."""
    return F.sha2(F.concat_ws("", *parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """A value with its length in bytes, so that neighbours can't run into each other; ``-`` for NULL."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(*values: Column) -> Column:
    return digest(*[field(v) for v in values])


def folded(path: Column | str, leaf: Column | str) -> Column:
    """The root that a leaf has under a path."""
    start = F.col(leaf) if isinstance(leaf, str) else leaf
    return F.aggregate(path, start, lambda below, s: digest(s["left"], below, s["right"]))


def path_digest(path: Column | str) -> Column:
    """Digest of all siblings of a path, from the leaf up, left to right."""
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""))


def placed(rows: DataFrame, order: str) -> DataFrame:
    """Rows with ``at``, their place from 0 by ``order`` in the group ``g``."""
    counted = running_totals(rows.withColumn("one", F.lit(1).cast("long")), order, ["one"], by=["g"])
    return counted.withColumn("at", F.col("one_before")).drop("one", "one_before")


@dataclass
class Forest:
    """The pivoted steps of the trees of all groups, lowest first: g, at, levels, digests ``d<level>_<node>``, and ``row`` by slot."""

    steps: list[DataFrame]
    fanout: int
    step: int

    @property
    def width(self) -> int:
        return self.fanout ** self.step

    def roots(self) -> DataFrame:
        """g, digest: the node that remains of each group."""
        return self.steps[-1].select("g", "top").withColumnRenamed("top", "digest")

    def below(self, tops: DataFrame) -> DataFrame:
        """g, at, digest, row, path of every leaf, with the other columns of ``tops`` (g, path, ...), whose path goes on from a leaf's own."""
        rest = [c for c in tops.columns if c not in ("g", "path")]
        level = tops.withColumn("at", F.lit(0).cast("long"))
        for number, table in reversed(list(enumerate(self.steps))):
            fields = lambda j: [F.lit(j).alias("slot"), F.col(f"d0_{j}").alias("digest"), self._siblings(j).alias("own"), *([F.col(f"row_{j}").alias("row")] if number == 0 else [])]  # noqa: E731, B023
            children = F.array(*[F.struct(*fields(j)) for j in range(self.width)])
            level = (
                table.join(level, ["g", "at"]).select("g", "at", "path", *rest, F.inline(children)).where("digest IS NOT NULL")
                .select("g", (F.col("at") * self.width + F.col("slot")).alias("at"), "digest", *(["row"] if number == 0 else []), F.concat("own", "path").alias("path"), *rest)
            )
            level = level if number == 0 else level.drop("digest")
        return level

    def _siblings(self, slot: int) -> Column:
        """The run's other columns at each level of the step, from the slot upwards."""
        own = []
        for level in range(self.step):
            node = slot // self.fanout ** level
            first = node // self.fanout * self.fanout
            column = lambda i: F.col(f"d{level}_{i}")  # noqa: E731, B023
            own.append(F.struct(F.concat_ws("", *map(column, range(first, node))).alias("left"), F.concat_ws("", *map(column, range(node + 1, first + self.fanout))).alias("right")))
        return F.slice(F.array(*own), 1, F.col("levels"))


def build(nodes: DataFrame, fanout: int, step: int) -> Forest:
    """The trees over ``nodes`` (g, at, digest, row), g not NULL, at gapless from 0 in each group."""
    if fanout < 2 or step < 1:
        raise ValueError("fanout must be 2 or more, step 1 or more")
    forest, left = Forest([], fanout, step), nodes.agg(F.max("at")).first()[0]
    left = 0 if left is None else left + 1
    while True:
        table = materialise(_pivot(nodes, fanout, step, "row" in nodes.columns))
        forest.steps.append(table)
        if left <= forest.width:
            return forest
        left = -(-left // forest.width)
        nodes = table.select("g", "at", F.col("top").alias("digest"))


def _pivot(nodes: DataFrame, fanout: int, step: int, with_rows: bool) -> DataFrame:
    width = fanout ** step
    slot = F.col("at") % width
    held = F.struct("digest", *(["row"] if with_rows else []))
    spread = nodes.groupBy("g", F.floor(F.col("at") / width).cast("long").alias("up")).agg(*[F.max(F.when(slot == j, held)).alias(f"s_{j}") for j in range(width)])
    out = spread.select("g", F.col("up").alias("at"), *[F.col(f"s_{j}.digest").alias(f"d0_{j}") for j in range(width)], *([F.col(f"s_{j}.row").alias(f"row_{j}") for j in range(width)] if with_rows else []))
    for level in range(1, step + 1):
        runs = [[f"d{level - 1}_{i * fanout + k}" for k in range(fanout)] for i in range(fanout ** (step - level))]
        out = out.select("*", *[F.when(F.col(run[0]).isNotNull(), digest(*map(F.col, run))).alias(f"d{level}_{i}") for i, run in enumerate(runs)])
    # The first row of a group has all its nodes if they fill fewer slots: there the tree may end below the ancestor.
    filled = reduce(lambda a, b: a + b, [F.col(f"d0_{j}").isNotNull().cast("int") for j in range(width)])
    needed = reduce(lambda a, t: F.when(filled <= fanout ** t, t).otherwise(a), range(step - 1, -1, -1), F.lit(step))
    out = out.withColumn("levels", F.when(F.col("at") == 0, needed).otherwise(F.lit(step)))
    return out.withColumn("top", reduce(lambda a, t: F.when(F.col("levels") == t, F.col(f"d{t}_0")).otherwise(a), range(step), F.col(f"d{step}_0")))


def proofs(rows: DataFrame, leaf: Column, group: str, order: str, carry: Sequence[Column] = (), fanout: int = 2, step: int = 3) -> DataFrame:
    """``carry``, leaf, subroot, root and path of every row.

    ``path`` holds the siblings left and right of the own node at each level, from the leaf up to the root.
    """
    leaves = rows.select(field(F.col(group)).alias("g"), F.col(group).alias("grp"), F.col(order).alias("ord"), leaf.alias("digest"), F.struct(F.lit(0).alias("_"), *carry).alias("row"))
    leaves = materialise(leaves)  # texts are read and hashed once; range bounds are sampled from the digests
    stored = materialise(placed(leaves.withColumn("by", F.struct("ord", "digest")).drop("ord"), "by").drop("by"))
    low = build(stored.drop("grp"), fanout, step)
    names = stored.where("at = 0").select("g", "grp")
    tops = low.roots().join(names, "g").select(F.lit("").alias("g"), "grp", "digest", F.struct(F.col("g").alias("name")).alias("row"))
    high = build(materialise(placed(tops, "grp").drop("grp")), fanout, step)
    path = F.array().cast("array<struct<left:string,right:string>>")
    above = high.below(high.roots().select("g", path.alias("path"), F.col("digest").alias("root")))
    under = low.below(above.select(F.col("row.name").alias("g"), "path", F.col("digest").alias("subroot"), "root"))
    return under.select("row.*", F.col("digest").alias("leaf"), "subroot", "root", "path").drop("_")
