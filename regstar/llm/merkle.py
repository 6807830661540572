"""Merkle dataset manifest: trees of sha256 digests with nested-interval labels.

Every row of ``documents`` is a leaf; the leaves of a source, by doc_id, are
the leaves of its tree, and the trees' roots, by source, those of one more
tree. A node is labelled by the interval [lo, hi) of leaf ranks it covers, so
an ancestor is a node whose interval contains the leaf's, and the siblings on
a path are what the parent's interval holds besides the node's own.

Ranks come from a range partitioning and the sizes of its parts, so no source
is gathered in one task. Nodes are built and attached by ``STRIDE`` levels at a
time: nodes of a level with one bucket (lo div FAN ** (level + STRIDE)) are a
family, at most FAN ** STRIDE of them, and a family computes the tiers of nodes
above its members up to one node. Paths go the other way: each family joins
the family that contains its interval in the bucket of the next level, takes
the siblings found there, and hands its whole path down; leaves do so last. A
table of a level is a ``FAN ** STRIDE``-th of the one below, so all of them
together cost little more than the leaves.

Defined cases: a null value is hashed as ``-`` (an empty text as ``0:``); a
null source is the first source; rows without a doc_id come first in their
source, rows with one doc_id follow each other by their digests, and equal rows
in any order (their results are equal as a multiset); a null doc_id is not
tampered with; a lone leaf is its source's root, a lone source's root the root;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regstar.llm.shared import SharedTables, columns

FAN = 3
STRIDE = 4
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")

_NODE = "struct<lo:bigint,hi:bigint,hash:string>"
_POSITION = (1 << 33) - 1  # the part of monotonically_increasing_id that counts a partition's rows


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the concatenated texts."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf_digest(values: dict[str, Column]) -> Column:
    """Digest of a row's values: UTF-8 byte count, ``:`` and value, or ``-``."""
    told = []
    for name in LEAF_COLUMNS:
        value = values[name].cast("string")
        told.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return digest(*told)


def ranked(rows: DataFrame, order: list[str], shared: SharedTables, name: str) -> DataFrame:
    """``rows`` with ``rank`` (0, 1, ... within ``tree`` by ``order``) and ``total``
    (rows of the tree)."""
    dealt = rows.withColumn("nth", F.monotonically_increasing_id())  # splits ties of equal rows
    by = ["tree", *order, "nth"]
    dealt = dealt.repartitionByRange(*by).sortWithinPartitions(*by).drop("nth")
    placed = shared.put(
        dealt.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION)).alias("at")),
        name,
    )
    sizes = shared.put(placed.groupBy("tree", "part").agg(F.count("*").alias("n"), F.min("at").alias("first")), f"{name}_sizes")
    tree = Window.partitionBy("tree")
    shift = F.sum("n").over(tree.orderBy("part")) - F.col("n") - F.col("first")
    before = sizes.select("tree", "part", shift.alias("shift"), F.sum("n").over(tree).alias("total"))
    joined = placed.join(before, ["tree", "part"])
    return joined.withColumn("rank", F.col("at") + F.col("shift")).drop("part", "at", "shift")


# ---------------------------------------------------------------- bottom up


def _parents(tier: Column) -> Column:
    """The nodes above a tier: each covers ``FAN`` neighbours, the last fewer."""

    def parent(i: Column) -> Column:
        kids = F.slice(tier, i * FAN + 1, FAN)
        return F.struct(
            F.element_at(kids, 1)["lo"].alias("lo"),
            F.element_at(kids, -1)["hi"].alias("hi"),
            digest(F.array_join(F.transform(kids, lambda kid: kid["hash"]), "")).alias("hash"),
        )

    return F.transform(F.sequence(F.lit(0), F.floor((F.size(tier) - 1) / FAN).cast("int")), parent)


def _tiers(members: Column, whole: Column) -> Column:
    """``STRIDE + 1`` tiers: the members and the nodes above them. A family that
    covers its whole tree ends with one node; the tiers above that are empty."""

    def grown(tiers: Column, _: Column) -> Column:
        last = F.element_at(tiers, -1)
        more = F.size(last) > F.when(whole, F.lit(1)).otherwise(F.lit(0))
        return F.concat(tiers, F.array(F.when(more, _parents(last)).otherwise(F.array().cast(f"array<{_NODE}>"))))

    start = F.array(members).cast(f"array<array<{_NODE}>>")
    return F.aggregate(F.sequence(F.lit(1), F.lit(STRIDE)), start, grown)




def families(leaves: DataFrame, shared: SharedTables, name: str) -> list[DataFrame]:
    """(tree, bucket, lo, hi, total, whole, tiers) of ``leaves`` (tree, rank,
    total, hash), one table for each ``STRIDE`` levels."""
    nodes = leaves.select("tree", "total", F.col("rank").alias("lo"), (F.col("rank") + 1).alias("hi"), "hash")
    found, level = [], 0
    while True:
        node = F.struct("lo", "hi", "hash")
        grouped = nodes.groupBy("tree", F.expr(f"lo div {FAN ** (level + STRIDE)}").alias("bucket")).agg(
            F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.max("total").alias("total"),
            F.array_sort(F.collect_list(node)).alias("members"),
        )
        whole = (F.col("lo") == 0) & (F.col("hi") == F.col("total"))
        family = grouped.withColumn("whole", whole).withColumn("tiers", _tiers(F.col("members"), F.col("whole")))
        found.append(shared.put(family.drop("members"), f"{name}_families{level}"))
        more = found[-1].where("NOT whole")
        if more.isEmpty():
            return found
        level += STRIDE
        top = F.element_at(F.col("tiers"), -1)[0]
        nodes = more.select("tree", "total", "lo", "hi", top["hash"].alias("hash"))


def top_hash(tiers: Column) -> Column:
    """Digest of the one node above all of a whole family."""
    return F.element_at(F.filter(tiers, lambda tier: F.size(tier) > 0), -1)[0]["hash"]


# ----------------------------------------------------------------- top down


def _siblings(tiers: Column, lo: Column, first: Column, level: int) -> Column:
    """For each tier below another one: digests of the nodes that the parent's
    interval holds before and after the node that contains ``lo``. ``first`` is
    where the family, whose members are of ``level``, begins."""
    widths = F.array(*(F.lit(min(FAN ** (level + j + 1), 1 << 62)).cast("long") for j in range(STRIDE)))

    def one(j: Column) -> Column:
        parent = F.floor((lo - first) / F.get(widths, j)).cast("int")  # its place in the tier above
        inside = F.slice(F.get(tiers, j), parent * FAN + 1, FAN)
        joined = lambda keep: F.array_join(F.transform(F.filter(inside, keep), lambda node: node["hash"]), "")
        return F.struct(
            joined(lambda node: node["hi"] <= lo).alias("before"), joined(lambda node: node["lo"] > lo).alias("after")
        )

    levels = F.size(F.filter(tiers, lambda tier: F.size(tier) > 0)) - 1
    return F.when(levels > 0, F.transform(F.sequence(F.lit(0), levels - 1), one)).otherwise(
        F.array().cast("array<struct<before:string,after:string>>")
    )


def attached(rows: DataFrame, lo: str, family: DataFrame, level: int) -> DataFrame:
    """``rows`` (tree, ``lo``) joined with the family that contains ``lo`` in its
    bucket of ``level``; ``path`` is the row's way up to the root."""
    up = family.select("tree", F.col("bucket").alias("up_bucket"), F.col("lo").alias("up_lo"), F.col("hi").alias("up_hi"), "tiers", "path", "tree_root", "root")
    below = rows.withColumn("own_bucket", F.expr(f"{lo} div {FAN ** (level + STRIDE)}"))
    same = (below["tree"] == up["tree"]) & (below["own_bucket"] == up["up_bucket"])
    contained = same & (up["up_lo"] <= below[lo]) & (below[lo] < up["up_hi"])
    return below.join(up, contained).select(
        *(below[c] for c in rows.columns),
        F.concat(_siblings(up["tiers"], below[lo], up["up_lo"], level), up["path"]).alias("path"), up["tree_root"], up["root"],
    )


def paths(found: list[DataFrame], above: DataFrame) -> DataFrame:
    """The lowest families with ``path`` (from their top node to the root),
    ``tree_root`` and ``root``; ``above`` has these by tree for the tree's own root."""
    upper = None
    for i in range(len(found) - 1, -1, -1):
        here = found[i]
        tops = here.where("whole").join(above, "tree").select(*here.columns, "path", "tree_root", "root")
        if upper is None:
            upper = tops
        else:
            upper = attached(here.where("NOT whole"), "lo", upper, STRIDE * (i + 1)).unionByName(tops)
    return upper


# ----------------------------------------------------------------- operator


def manifest(docs: DataFrame, *, tampered: Column | None = None) -> DataFrame:
    """(doc_id, leaf, subroot, root, path, folded_root, verified) for each row of
    ``docs`` (``LEAF_COLUMNS``). ``path`` has the siblings' digests before and
    after the node, by level. ``folded_root`` is what a reader computes from
    ``tampered`` (a text in place of ``text``; null: the text is unchanged) and
    the path of the original."""
    shared = SharedTables(docs.sparkSession, "merkle")
    rows = columns(docs, *LEAF_COLUMNS)
    values = {c: F.col(c) for c in LEAF_COLUMNS}
    changed = tampered if tampered is not None else F.lit(None).cast("string")
    leaves = rows.select(
        "doc_id", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")).alias("tree"),  # null first
        leaf_digest(values).alias("hash"),
        F.when(changed.isNotNull(), leaf_digest(values | {"text": changed})).alias("held"),
    )
    leaves = shared.put(leaves, "leaves")
    leaves = ranked(leaves, ["doc_id", "hash"], shared, "ranked")
    trees = families(leaves.select("tree", "rank", "total", "hash"), shared, "trees")

    roots = None
    for found in trees:
        part = found.where("whole").select(F.lit("").alias("tree"), F.col("tree").alias("of"), top_hash(F.col("tiers")).alias("hash"))
        roots = part if roots is None else roots.unionByName(part)
    roots = ranked(shared.put(roots, "roots"), ["of"], shared, "ranked_roots")
    summit = families(roots.select("tree", "rank", "total", "hash"), shared, "summit")
    top = summit[-1].select("tree", top_hash(F.col("tiers")).alias("root"))  # one row, if any
    no_path = F.array().cast("array<struct<before:string,after:string>>")
    over = top.select("tree", no_path.alias("path"), F.col("root").alias("tree_root"), "root")
    placed = attached(roots, "rank", paths(summit, over), 0)
    above = shared.put(placed.select(F.col("of").alias("tree"), "path", F.col("hash").alias("tree_root"), "root"), "above")

    proven = attached(leaves, "rank", paths(trees, above), 0)
    fold = F.aggregate("path", F.coalesce("held", "hash"), lambda h, s: digest(s["before"], h, s["after"]))
    return proven.select(
        "doc_id", F.col("hash").alias("leaf"), F.col("tree_root").alias("subroot"), "root", "path", fold.alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def path_digest(path: Column) -> Column:
    """Digest of a path's siblings, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""))
