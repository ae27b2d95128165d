"""Merkle manifest of a table: a leaf a row, a tree a group, one root over all; and a proof for each row.

Hashes are lower-case hexadecimal SHA-256 of texts put one after the other. A leaf is the hash of a row's
fields, each as ``-`` if null, else its UTF-8 length, ``:`` and the value. In a tree every two neighbours,
and a last one alone, give their hash, level by level until one node is left; a single leaf is its root.

1. Places. Rows are hashed once and written as (group, id, leaf); equal ones combine to a row with their
   number. They are dealt by range of (group, id, leaf), so a group that holds a third of all rows lies
   in many tasks; a place is the task's base, from prefix sums of its counts, plus the place inside.
2. Blocks. ``BLOCK`` neighbours are an aligned block. It keeps each of its levels as one string of
   hexadecimal digits: parents hash fixed-width substrings of the level below.
3. The blocks' roots are the leaves of the next round, until each group has one node. The groups'
   roots, in order of the group, go the same way to the root of the table.
4. Proofs. A node's sibling is the fixed-width substring beside it, empty if there is none. The siblings
   above a block are found once a block and handed down; a row's proof is its own block's and these.

Ids ascend, null ids come first, equal ids stand in the order of their leaves; groups ascend by UTF-8
bytes, null first. Equal rows are equal leaves side by side. An empty table gives an empty result. Texts
of any length are one field; columns other than the fields are ignored. Field values are written as
Spark casts them to text, integers in decimal.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import settle

LEVELS = 8
BLOCK = 1 << LEVELS
WIDTH = 64

#: Levels of the block from the nodes of its lowest one; ``height`` is how many the block has above it.
GROW = f"""
aggregate(sequence(1, height), array(level), (done, j) -> concat(done, array(array_join(transform(
    sequence(0, (length(element_at(done, -1)) div {WIDTH} + 1) div 2 - 1),
    i -> sha2(substring(element_at(done, -1), i * {2 * WIDTH} + 1, {2 * WIDTH}), 256)), ''))))
"""
#: What stands beside node ``at`` on each level below the top, and whether the node is the right one of the two.
BESIDE = f"""
transform(slice(levels, 1, size(levels) - 1), (l, j) -> struct(
    substring(l, (shiftright(at, j) ^ 1) * {WIDTH} + 1, {WIDTH}) AS sibling, shiftright(at, j) % 2 = 1 AS right))
"""
PATH = "array<struct<sibling:string,right:boolean>>"


def field(c: Column | str) -> Column:
    text = (F.col(c) if isinstance(c, str) else c).cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields: Sequence[Column | str]) -> Column:
    return F.sha2(F.concat(*[field(c) for c in fields]), 256)


def folded(start: Column, path: str = "path") -> Column:
    """The root that a leaf and the siblings on its way up give."""
    return F.aggregate(path, start, lambda x, s: F.sha2(F.when(s["right"], F.concat(s["sibling"], x)).otherwise(F.concat(x, s["sibling"])), 256))


def places(rows: DataFrame, group: str, order: Sequence[str], carried: Sequence[str] = ()) -> DataFrame:
    """Distinct rows of (group, order, carried) with ``times`` they occur, ``first``: the place of the first
    of them in the group, and ``n``: the group's rows."""
    keys = [group, *order, *carried]
    dealt = rows.groupBy(*keys).agg(F.count("*").alias("times")).repartitionByRange(group, *order, *carried)
    dealt = settle(dealt.withColumn("part", F.spark_partition_id()), "places")
    sums = dealt.groupBy(group, "part").agg(F.sum("times").alias("held"))
    whole = Window.partitionBy(group)
    bases = sums.select(group, "part", F.sum("held").over(whole).alias("n"),
                        (F.sum("held").over(whole.orderBy("part")) - F.col("held")).alias("base"))
    inside = F.sum("times").over(Window.partitionBy(group, "part").orderBy(*order, *carried).rowsBetween(Window.unboundedPreceding, 0))
    bases = bases.withColumnsRenamed({group: "its_group", "part": "its_part"})
    here = F.col(group).eqNullSafe(F.col("its_group")) & (F.col("part") == F.col("its_part"))
    return dealt.withColumn("inside", inside - F.col("times")).join(bases, here).select(
        *keys, "times", (F.col("base") + F.col("inside")).alias("first"), "n")


def blocks(nodes: DataFrame, group: str, carried: Sequence[str] = ()) -> DataFrame:
    """(group, block, n, items, levels) from nodes (group, first, times, n, node, carried). ``items`` are the
    block's nodes: first place in the block, how often, node, carried."""
    spread = nodes.withColumn("block", F.explode(F.expr(f"sequence(first div {BLOCK}, (first + times - 1) div {BLOCK})")))
    low, high = F.greatest("first", F.col("block") * BLOCK), F.least(F.col("first") + F.col("times"), (F.col("block") + 1) * BLOCK)
    item = F.struct((low - F.col("block") * BLOCK).cast("int").alias("at"), (high - low).cast("int").alias("times"), "node", *carried)
    held = spread.groupBy(group, "block").agg(F.first("n").alias("n"), F.array_sort(F.collect_list(item)).alias("items"))
    level = F.array_join(F.transform("items", lambda x: F.repeat(x["node"], x["times"])), "")
    # a tree of more than one block has all levels in each of them
    height = F.least(F.lit(LEVELS), F.ceil(F.log2("n"))).cast("int")
    held = held.withColumns({"level": level, "height": height})
    grown = F.when(F.col("height") > 0, F.expr(GROW)).otherwise(F.array("level"))
    return held.withColumn("levels", grown).drop("level", "height")


def rounds(bottom: DataFrame, group: str, largest: int) -> list[DataFrame]:
    """The blocks of all rounds, written; each round's nodes are the roots of the one before."""
    out = [settle(bottom, "blocks")]
    while largest > BLOCK:
        above = out[-1].select(group, F.col("block").alias("first"), F.lit(1).alias("times"),
                               F.ceil(F.col("n") / BLOCK).alias("n"), F.element_at("levels", -1).alias("node"))
        out.append(settle(blocks(above, group), "blocks"))
        largest = -(-largest // BLOCK)
    return out


def handed_down(tree: list[DataFrame], group: str, above: DataFrame) -> DataFrame:
    """(group, block, path, ...) of the lowest blocks: the siblings above them. ``above`` has the group's path
    above its root, and other columns that are handed down too."""
    others = [c for c in above.columns if c not in (group, "path")]
    at = above.select(F.col(group).alias("its_group"), F.lit(0).cast("long").alias("its_block"), "path", *others)
    for i, level in reversed(list(enumerate(tree))):
        here = F.col(group).eqNullSafe(F.col("its_group")) & (F.col("block") == F.col("its_block"))
        if i == 0:
            return level.join(at, here).drop("its_group", "its_block")
        items = level.join(at, here).select(
            group, "block", "levels", "path", *others, F.explode(F.sequence(F.lit(0), F.size("items") - 1)).alias("at"))
        at = items.select(F.col(group).alias("its_group"), (F.col("block") * BLOCK + F.col("at")).alias("its_block"),
                          F.concat(F.expr(BESIDE), "path").alias("path"), *others)
    raise ValueError("a tree has one round at least")


def roots(tree: list[DataFrame], group: str) -> DataFrame:
    return tree[-1].select(group, F.element_at("levels", -1).alias("node"))


def manifest(rows: DataFrame, group: str, row_id: str, fields: Sequence[str], changed: Column | None = None) -> DataFrame:
    """(id, group, leaf, subroot, root, proof_sha256, folded_root, verified) for each row.

    ``changed``, if given, is the leaf that a row has now; its way up by the siblings of the manifest is
    ``folded_root``, and ``verified`` says whether that is the manifest's root.
    """
    now = leaf(fields) if changed is None else changed
    hashed = rows.select(F.col(group).alias("tree"), F.col(row_id).alias("id"), leaf(fields).alias("node"), now.alias("now"))
    # most rows are what they were; their hash is kept once
    hashed = settle(hashed.withColumn("now", F.nullif("now", "node")), "leaves")
    placed = places(hashed, "tree", ["id", "node"], ["now"])
    largest = hashed.groupBy("tree").count().agg(F.max("count")).first()[0]
    if largest is None:
        empty = rows.sparkSession.createDataFrame([], "leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
        return hashed.select(F.col("id").alias(row_id), F.col("tree").alias(group)).join(empty)
    low = rounds(blocks(placed, "tree", ["id", "now"]), "tree", largest)

    subroots = settle(roots(low, "tree").withColumn("all", F.lit(0)), "subroots")
    ordered = places(subroots, "all", ["tree"], ["node"])
    top = rounds(blocks(ordered, "all", ["tree"]), "all", subroots.count())
    head = roots(top, "all").select("all", F.expr(f"cast(array() AS {PATH})").alias("path"), F.col("node").alias("root"))
    over = handed_down(top, "all", head).withColumn("item", F.explode("items"))
    over = over.withColumn("at", F.col("item.at")).select(
        F.col("item.tree").alias("tree"), F.concat(F.expr(BESIDE), "path").alias("path"), "root", F.col("item.node").alias("subroot"))

    under = handed_down(low, "tree", over).withColumn("item", F.explode("items"))
    each = under.withColumn("at", F.explode(F.expr("sequence(item.at, item.at + item.times - 1)")))
    each = each.select("tree", F.col("item.id").alias("id"), F.col("item.node").alias("leaf"), F.coalesce("item.now", "item.node").alias("now"),
                       "subroot", "root", F.concat(F.expr(BESIDE), "path").alias("path"))
    # the path leaves the projection that builds it as a column: what follows does not build it again
    each = each.withColumn("folded_root", folded(F.col("now")))
    return each.select(F.col("id").alias(row_id), F.col("tree").alias(group), "leaf", "subroot", "root",
                       F.sha2(F.array_join("path.sibling", ""), 256).alias("proof_sha256"), "folded_root",
                       (F.col("folded_root") == F.col("root")).alias("verified"))


FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def audited(docs: DataFrame, tampered: Column) -> DataFrame:
    """The manifest of documents by language, held against what they are with 1 added to n_chars where
    ``tampered``."""
    touched = F.col("n_chars") + F.when(tampered, 1).otherwise(0)
    now = leaf([touched if c == "n_chars" else c for c in FIELDS])
    return manifest(docs, "lang", "doc_id", FIELDS, now)
