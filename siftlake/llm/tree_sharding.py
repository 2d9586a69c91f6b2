"""Shards by weighted hash draws down a tree of regions, racks and shards, in DataFrame functions only.

At each level every child draws ``-ln(u) / weight`` with ``u`` from a hash of the key and the child's name, and the
smallest draw wins. A child's draw depends on its own name and weight alone: where a weight grows, rows move into that child and
nowhere else; within unchanged subtrees nothing moves.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftlake.llm.columns import put_aside

# A region holds four racks of five shards. Shards beyond the last full region are regions of their own until they fill
# one, so that one more shard adds a subtree at the root and changes the weight of no other.
RACKS_PER_REGION = 4
SHARDS_PER_RACK = 5
SHARDS = 40
LAW = "key"
ROWS_PER_PART = 10_000

# Names of regions, of racks and numbers of shards, with the weights of the shards.
Tree = Mapping[str, Mapping[str, Mapping[int, float]]]


def regular_tree(shards: int, base: int = SHARDS) -> Tree:
    """``base`` shards of weight 1 in full regions, as far as there are so many, and each further one by itself.

    From ``base`` shards on, one more takes rows only into itself.
    """
    per_region = RACKS_PER_REGION * SHARDS_PER_RACK
    full = min(shards, base) // per_region * per_region
    tree: dict[str, dict[str, dict[int, float]]] = {}
    for shard in range(shards):
        alone = shard >= full
        region = f"alone-{shard}" if alone else f"region-{shard // per_region}"
        rack = "rack-0" if alone else f"rack-{shard % per_region // SHARDS_PER_RACK}"
        tree.setdefault(region, {}).setdefault(rack, {})[shard] = 1.0
    return tree


def _total(node) -> float:
    return sum(map(_total, node.values())) if isinstance(node, Mapping) else float(node)


def _level(parents: list[tuple[str, Mapping]]) -> tuple[Column, list[tuple[str, Mapping]]]:
    """The children of each node of a level as ``name, weight, number``, and those children in the order of their numbers.
    Shards keep their own numbers. A child of weight 0 is left out."""
    lists, children = [], []
    for path, node in parents:
        of_node = []
        for name, child in node.items():
            if _total(child) > 0:
                number = len(children) if isinstance(child, Mapping) else name
                children.append((f"{path}/{name}", child))
                of_node.append(
                    F.struct(
                        F.lit(f"{path}/{name}").alias("name"), F.lit(_total(child)).alias("weight"),
                        F.lit(number).cast("int").alias("number"),
                    )
                )
        lists.append(F.array(*of_node))
    return F.array(*lists), children


def _winner(key: Column, children: Column) -> Column:
    """The number of the child with the smallest draw."""

    def draw(child: Column) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(key, child["name"]), 11)
        u = (bits + F.lit(0.5)) * F.lit(2.0**-53)
        return F.struct((-F.log(u) / child["weight"]).alias("draw"), child["number"].alias("number"))

    return F.array_min(F.transform(children, draw))["number"]


def shard_of(key: Column, tree: Tree) -> Column:
    """The shard of a key; all null keys fall into one shard. Shards of weight 0 get nothing."""
    if _total(tree) <= 0:
        raise ValueError("a tree needs a shard of positive weight")
    number, nodes = F.lit(0), [("root", tree)]
    for _ in ("region", "rack", "shard"):
        lists, nodes = _level(nodes)
        number = _winner(key, F.element_at(lists, number + 1))
    return number


def assign(docs: DataFrame, shards: int = SHARDS, tree: Tree | None = None, grown: Tree | None = None) -> DataFrame:
    """``docs`` (``doc_id, text`` and more) with ``size`` (bytes of the text and 16), ``text_crc32``, ``law``, ``shard``,
    ``slot`` (from 0 without gaps in each shard) and ``grown_shard`` (with one more shard).

    A null text has no bytes and the checksum of an empty one. All rows without an id go to one shard. Rows that repeat
    an id share its shard, each with a slot of its own. Columns of ``docs`` that bear the name of a new one are replaced. An empty table
    gives no rows.

    Slots are counted in parts of a shard, and over the parts: a shard never has to be put in order as a whole. The
    number of parts follows the number of rows.
    """
    new = ["size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    tree = tree or regular_tree(shards)
    grown = grown or regular_tree(shards + 1)
    text = F.coalesce("text", F.lit(""))
    docs, own = put_aside(docs.drop(*new), ("doc_id", "text"))
    parts = -(-docs.count() // (ROWS_PER_PART * shards)) or 1
    placed = docs.withColumns(
        {
            "size": (F.octet_length(text) + 16).cast("long"),
            "text_crc32": F.crc32(text),
            "law": F.lit(LAW),
            "shard": shard_of(F.col("doc_id"), tree),
            "grown_shard": shard_of(F.col("doc_id"), grown),
        }
    ).withColumn("part", F.pmod(F.xxhash64("doc_id", "text_crc32", F.lit("part")), F.lit(parts)).cast("int"))
    counts = placed.groupBy("shard", "part").agg(F.count("*").alias("rows"))
    earlier = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "part", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"))
    within = Window.partitionBy("shard", "part").orderBy("doc_id", "text_crc32", "size")
    numbered = placed.withColumn("number", F.row_number().over(within) - 1).join(offsets, ["shard", "part"])
    return numbered.select(
        *own.values(), "size", "text_crc32", "law", "shard", (F.col("before") + F.col("number")).alias("slot"), "grown_shard"
    )


def write(assigned: DataFrame, path: str) -> None:
    """Assigned rows as Parquet, a folder per shard; a shard's rows may be written by several tasks."""
    assigned.write.partitionBy("shard").parquet(path)
