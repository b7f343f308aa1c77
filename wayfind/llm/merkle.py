"""Merkle manifest of a dataset: levels stored as parent-linked node rows, proofs by a recursive query that climbs from every leaf.

Each row is a leaf of the tree of its group; the groups' subroots are the leaves of one tree above. A
node is one row: what its children are (their digests, one after the other) and where its own parent
is. The recursive query meets each leaf with its parent, emits the siblings, folds the digest and goes
on from the parent, until there is none.

Every leaf climbs to the root, so upper nodes are met by all rows of a group. A node is therefore
stored once for each block of 4,096 consecutive leaves below it, and is joined by block: no key of the
join holds more than a block of leaves, whatever the size of a group. That adds a row per block and level.

The siblings of a level are a row of the recursion's result, and a leaf's rows are put together after
it. One growing value would be shuffled again in every round, with all levels below.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfind.llm.common import union_all, with_key
from wayfind.operators.ordered import numbered
from wayfind.sources.scratch import materialise, step

#: Children of a node as a power of two: 8 consecutive ones.
BITS = 3
#: Leaves of a block, as a power of two that is a whole number of levels.
BLOCK_BITS = 4 * BITS
#: Bytes of a digest.
SIZE = 32

# Digests are kept as bytes and hashed as hex text; place is where the child stands among its parent's children.
CLIMB = f"""
with recursive climb(tree, o, step, above, level, idx, place, fold, siblings) as (
    select tree, o, 0, above, level, idx, place, changed, cast('' as binary) from {{leaves}}
    union all
    select tree, o, step + 1, next_above, next_level, next_idx, next_place, unhex(sha2(lower(hex(concat(left, fold, right))), 256)), concat(left, right)
    from (
        select c.tree, c.o, c.step, c.fold, n.next_above, n.next_level, n.next_idx, n.next_place,
               substring(n.children, 1, {SIZE} * c.place) as left, substring(n.children, {SIZE} * c.place + {SIZE + 1}) as right
        from climb c join {{nodes}} n on n.tree = c.tree and n.block = shiftright(c.o, {BLOCK_BITS}) and n.above = c.above and n.level = c.level and n.idx = c.idx)
)
select tree, o, step, siblings, case when level is null then fold end as last_fold from climb
"""


def canonical(columns: list[Column]) -> Column:
    """The values one after the other, each as its length in UTF-8 bytes, a colon and the value as text, or `-` if null."""
    texts = [c.cast("string") for c in columns]
    return F.concat(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts))


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def hex_text(value: Column) -> Column:
    return F.lower(F.hex(value))


def _joined(digests: Column) -> Column:
    """The bytes of an array of digests as one value."""
    return F.unhex(F.array_join(F.transform(digests, F.hex), ""))


def _levels(leaves: DataFrame, most: int) -> list[DataFrame]:
    """Tables of nodes (tree, level, idx, n, children, hash), from the parents of leaves(tree, idx, n, hash) upwards; n is the number of nodes of the tree at that level, most the largest at the leaves."""
    out, now = [], leaves
    while most > 1:
        children = F.transform(F.sort_array(F.collect_list(F.struct("idx", "hash"))), lambda c: c["hash"])
        up = now.filter("n > 1").groupBy("tree", F.shiftright("idx", BITS).alias("up")).agg(_joined(children).alias("children"), F.max("n").alias("n"))
        level = F.lit(len(out) + 1).alias("level")
        now, _ = materialise(up.select("tree", level, F.col("up").alias("idx"), F.shiftright(F.col("n") + ((1 << BITS) - 1), BITS).alias("n"), "children", digest(hex_text(F.col("children"))).alias("hash")), "level")
        out.append(now)
        most = -(-most >> BITS)
    return out


def _link(tree: Column, level: Column, idx: Column, n: Column) -> list[Column]:
    """Where the parent of a node of a group's tree is: in its own tree, or above where it is that tree's only node."""
    top = n == 1
    at = F.when(top, tree).otherwise(idx)
    return [top.alias("above"), F.when(top, 1).otherwise(level + 1).alias("level"), F.shiftright(at, BITS).alias("idx"), at.bitwiseAND((1 << BITS) - 1).cast("int").alias("place")]


def _spread(levels: list[DataFrame], above: list[DataFrame], trees: DataFrame) -> DataFrame:
    """Nodes once for each block of leaves below them: tree and block, the node (above, level, idx), its children, and next_* where its own parent is, null at the root."""
    last = len(above)
    key = ["children", "next_above", "next_level", "next_idx", "next_place"]
    ends = [F.shiftright(F.col("leaves") - 1, BLOCK_BITS)]
    parts = []
    for k, nodes in enumerate(levels, 1):
        a, level, idx, place = _link(F.col("tree"), F.lit(k), F.col("idx"), F.col("n"))
        over = F.lit(last == 0) & (F.col("n") == 1)  # the only group's subroot is the root
        follow = [F.when(~over, c).alias(name) for c, name in zip((a, level, idx, place), key[1:], strict=True)]
        if k * BITS <= BLOCK_BITS:
            block = F.shiftright("idx", BLOCK_BITS - k * BITS)
            rows = nodes.withColumn("block", block)
        else:
            width = k * BITS - BLOCK_BITS
            rows = nodes.join(trees, "tree").withColumn("block", F.explode(F.sequence(F.shiftleft("idx", width), F.least(F.shiftleft(F.col("idx") + 1, width) - 1, *ends))))
        parts.append(rows.select("tree", "block", F.lit(False).alias("above"), F.lit(k).alias("level"), "idx", "children", *follow))
    blocks = trees.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), *ends)))
    for k, nodes in enumerate(above, 1):
        own = nodes.select(F.col("idx").alias("at"), "children")
        follow = [F.when(F.lit(k < last), c).alias(name) for c, name in zip((F.lit(True), F.lit(k + 1), F.shiftright("at", BITS), F.col("at").bitwiseAND((1 << BITS) - 1).cast("int")), key[1:], strict=True)]
        rows = blocks.withColumn("at", F.shiftright("tree", k * BITS)).join(own, "at")
        parts.append(rows.select("tree", "block", F.lit(True).alias("above"), F.lit(k).alias("level"), F.col("at").alias("idx"), "children", *follow))
    return union_all(parts)


@contextmanager
def _unlimited(spark: SparkSession) -> Iterator[None]:
    """Recursive queries may give as many rows as there are: they have a row for each leaf and level."""
    name = "spark.sql.cteRecursionRowLimit"
    was = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        yield
    finally:
        spark.conf.set(name, was)


def manifest(docs: DataFrame, columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), group: str = "lang", order: str = "doc_id", changed: dict[str, Column] | None = None, where: Column | None = None) -> DataFrame:
    """id, leaf, subroot, root, proof_sha256, folded_root, verified of every row of docs: digests as lower-case hex.

    A leaf is the digest of the columns in canonical() form. Leaves of a group are ordered by `order`,
    null first, and 8 consecutive nodes become one, level by level; so do the subroots of the groups
    in byte order, null first. proof_sha256 is the digest of all siblings from leaf to root.
    folded_root is what the root comes to with the siblings as they were and the leaf as it is after
    tampering: `changed` has new values of columns, for rows where `where` is true; without it, no row
    is tampered with. Rows that repeat an id are ordered by digest, and rows alike in all stand in any
    order, which gives the same result; a null in `where` leaves a row as it is. A table of one row is
    its own root, with the digest of nothing as its proof; an empty table gives no rows. Columns beyond
    those named are ignored.
    """
    with step(docs.sparkSession) as keep:  # levels, nodes and the order of leaves go at its end
        return _manifest(docs, columns, group, order, changed or {}, where, keep)


def _manifest(docs: DataFrame, columns: tuple[str, ...], group: str, order: str, changed: dict[str, Column], where: Column | None, keep: Callable[[str], None]) -> DataFrame:
    spark = docs.sparkSession
    field = lambda c: F.col("d").getField(c)
    keyed = with_key(docs)
    leaf = digest(canonical([field(c) for c in columns]))
    after = F.when(where, digest(canonical([changed.get(c, field(c)) for c in columns]))).otherwise(leaf) if where is not None else leaf
    name = F.coalesce(F.concat(F.lit("1"), field(group).cast("string")), F.lit("0"))  # null first, a group of its own
    rows, _ = materialise(keyed.select(name.alias("g"), field(order).alias("id"), leaf.alias("leaf"), after.alias("changed"), "key"), "leaves")
    groups, _ = materialise(numbered(rows.groupBy("g").agg(F.count(F.lit(1)).alias("n")).withColumn("all", F.lit(0)), "all", ["g"]).select("g", F.col("o").alias("tree"), "n"), "groups")
    told = groups.agg(F.max("n").alias("most"), F.count(F.lit(1)).alias("groups")).first()
    if not told["groups"]:
        return spark.createDataFrame([], docs.select(F.col(order).alias("id")).schema.add("leaf", "string").add("subroot", "string").add("root", "string").add("proof_sha256", "string").add("folded_root", "string").add("verified", "boolean"))
    leaves, leaves_at = materialise(numbered(rows, "g", ["id", "leaf", "key"]).join(groups, "g").select("tree", "o", "n", "id", "leaf", "changed"), "placed")
    keep(leaves_at)
    levels = _levels(leaves.select("tree", F.col("o").alias("idx"), "n", F.col("leaf").alias("hash")), told["most"])
    tops = union_all([x.filter("n = 1").select("tree", "hash") for x in [leaves.select("tree", "n", F.col("leaf").alias("hash")), *levels]])
    tops, tops_at = materialise(tops, "subroots")
    keep(tops_at)
    above = _levels(tops.select(F.lit(-1).cast("long").alias("tree"), F.col("tree").alias("idx"), F.lit(told["groups"]).cast("long").alias("n"), "hash"), told["groups"])
    root = (above[-1] if above else tops).select(hex_text(F.col("hash")).alias("root")).first()["root"]
    if not levels and not above:  # one row, which has nothing to climb
        only = leaves.select("id", hex_text(F.col("leaf")).alias("leaf"), hex_text(F.col("leaf")).alias("subroot"), F.lit(root).alias("root"), F.sha2(F.lit(""), 256).alias("proof_sha256"), hex_text(F.col("changed")).alias("folded_root"))
        return only.withColumn("verified", F.col("folded_root") == F.col("root"))
    nodes, _ = materialise(_spread(levels, above, groups.select("tree", F.col("n").alias("leaves"))), "nodes")
    begin = leaves.select("tree", "o", "changed", *(F.when(F.lit(bool(above)) | (F.col("n") > 1), c).alias(x) for c, x in zip(_link(F.col("tree"), F.lit(0), F.col("o"), F.col("n")), ("above", "level", "idx", "place"), strict=True)))
    with _unlimited(spark):
        climbed = spark.sql(CLIMB, leaves=begin, nodes=nodes)
        steps = F.sort_array(F.collect_list(F.struct("step", "siblings")))
        proofs = climbed.groupBy("tree", "o").agg(F.sha2(F.array_join(F.transform(steps, lambda s: hex_text(s["siblings"])), ""), 256).alias("proof_sha256"), hex_text(F.max("last_fold")).alias("folded_root"))
        proofs, proofs_at = materialise(proofs, "proofs")
    keep(proofs_at)
    subroots = tops.select("tree", hex_text(F.col("hash")).alias("subroot"))
    out = leaves.join(proofs, ["tree", "o"]).join(subroots, "tree").select("id", hex_text(F.col("leaf")).alias("leaf"), "subroot", F.lit(root).alias("root"), "proof_sha256", "folded_root")
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
