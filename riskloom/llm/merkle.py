"""A Merkle manifest of a table of documents, and versions of its tree after tampering.

Leaves are hashed where the rows are read; from then on only ids and digests move. Each language's leaves are
ranked by range (a language that holds most rows is cut over many tasks) and dealt in aligned blocks of ``BLOCK``
leaves, each a small persistent tree. A version for a tampered leaf shares all nodes but the copied ancestors of
that leaf; where its block's top differs it goes on as a row of the next stage, whose blocks are made of the tops,
until one node per language is left; the languages' roots are one more sequence of the same kind. Upper versions
copy a path per row, joined to their node by its place, so that thousands of versions of one node spread.

Defined results: every null counts as ``-`` in a leaf; a null language is a tree of its own and comes first; null
ids come first and equal ids are ordered by their leaves; repeated rows are leaves of their own; an empty table
gives an empty manifest; very long texts are hashed where they are; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import small
from riskloom.operators.prefix import range_positions
from riskloom.session import checkpointed

BLOCK = 1024
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
NODES = "tree string, block long, place int, top string, path array<string>"
PROVEN = "doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


class Tree:
    """A hash tree over a run of digests; ``levels`` fixes its height, else it ends at a single node.

    Nodes are (digest, left, right) in one list and never change. ``version`` adds a leaf and copies of its
    ancestors and returns the new top; all other nodes are shared with the first version.
    """

    def __init__(self, leaves: list[str], levels: int | None = None) -> None:
        self.nodes: list[tuple[str, int, int]] = [(h, -1, -1) for h in leaves]
        self.levels = [list(range(len(leaves)))]
        while len(self.levels[-1]) > 1 if levels is None else len(self.levels) <= levels:
            below = self.levels[-1]
            self.levels.append([self._node(below[i], below[i + 1] if i + 1 < len(below) else -1) for i in range(0, len(below), 2)])
        self.top = self.levels[-1][0]

    def _node(self, left: int, right: int) -> int:
        self.nodes.append((digest(*(self.nodes[i][0] for i in (left, right) if i >= 0)), left, right))
        return len(self.nodes) - 1

    def path(self, i: int) -> list[str]:
        """Siblings from the leaf up: L or R for their side before the digest, empty where there is none."""
        out = []
        for level in self.levels[:-1]:
            j = i ^ 1
            out.append("" if j >= len(level) else ("L" if j < i else "R") + self.nodes[level[j]][0])
            i //= 2
        return out

    def version(self, i: int, leaf: str) -> int:
        """The top of the version in which leaf ``i`` is another."""
        self.nodes.append((leaf, -1, -1))
        new = len(self.nodes) - 1
        for above in self.levels[1:]:
            _, left, right = self.nodes[above[i // 2]]
            new = self._node(left, new) if i % 2 else self._node(new, right)
            i //= 2
        return new


def fold(node: str, path: list[str]) -> str:
    for step in path:
        node = digest(step[1:], node) if step[:1] == "L" else digest(node, step[1:])
    return node


def leaf_hash(**changed: Column) -> Column:
    """The leaf of a row; fields may be replaced by other columns."""
    parts = []
    for name in FIELDS:
        value = changed.get(name, F.col(name)).cast("string")
        parts.append(F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)))
    return F.sha2(F.concat(*parts), 256)


def _height(nodes: int, block: int) -> int | None:
    """Levels of a block's tree: all of them where its sequence has more blocks, else up to a single node."""
    return None if nodes <= block else block.bit_length() - 1


def _tops(block: int):
    """For one block: its top with no path of its own (place -1), and every node's path or every version's top."""

    def run(group: pa.Table) -> pa.Table:
        tree, number, n = group["tree"][0].as_py(), group["block"][0].as_py(), group["n"][0].as_py()
        rows = sorted(zip(group["rank"].to_pylist(), group["top"].to_pylist(), group["changed"].to_pylist(), strict=True))
        made = Tree([r[1] for r in rows], _height(n, block))
        places, tops, paths = [-1], [made.nodes[made.top][0]], [None]
        for i, (_, _, changed) in enumerate(rows):
            if changed is not None:
                places.append(i), tops.append(made.nodes[made.version(i, changed)][0]), paths.append(None)
        return pa.table({"tree": [tree] * len(places), "block": [number] * len(places), "place": pa.array(places, pa.int32()), "top": tops, "path": pa.array(paths, pa.list_(pa.string()))})

    return run


def _paths(block: int):
    """For one block of an upper stage: its top (place -1) and every node's path inside it."""

    def run(group: pa.Table) -> pa.Table:
        tree, number, n = group["tree"][0].as_py(), group["block"][0].as_py(), group["n"][0].as_py()
        rows = sorted(zip(group["rank"].to_pylist(), group["top"].to_pylist(), strict=True))
        made = Tree([r[1] for r in rows], _height(n, block))
        places = [-1, *range(len(rows))]
        paths = [None, *(made.path(i) for i in range(len(rows)))]
        return pa.table({"tree": [tree] * len(places), "block": [number] * len(places), "place": pa.array(places, pa.int32()), "top": [made.nodes[made.top][0]] * len(places), "path": pa.array(paths, pa.list_(pa.string()))})

    return run


def _folded(node: Column, path: Column) -> Column:
    """A version's node copied up a path, as a column."""
    return F.aggregate(path, node, lambda h, s: F.sha2(F.when(F.substring(s, 1, 1) == "L", F.concat(F.substring(s, 2, 64), h)).otherwise(F.concat(h, F.substring(s, 2, 64))), 256))


def _climb(nodes: DataFrame, versions: DataFrame, block: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Upper stages until one node is left per tree.

    ``nodes``: tree, rank, n (nodes in that tree), top. ``versions``: tree, rank (the node they change), top and
    columns of their own. Returns the single nodes, the versions of them, and each first node's whole path.
    """
    first = nodes.select("tree", "rank", F.col("rank").alias("at"), F.array().cast("array<string>").alias("path"))
    while nodes.where("n > 1").limit(1).count():
        dealt = nodes.withColumn("block", F.floor(F.col("rank") / block))
        made = checkpointed(dealt.groupBy("tree", "block").applyInArrow(_paths(block), NODES))
        own = made.where("place >= 0").select("tree", (F.col("block") * block + F.col("place")).alias("rank"), F.col("path").alias("more"))
        sizes = made.where("place = -1").groupBy("tree").agg(F.count(F.lit(1)).alias("n"))
        versions = versions.join(own, ["tree", "rank"]).withColumns({"top": _folded(F.col("top"), F.col("more")), "rank": F.floor(F.col("rank") / block)}).drop("more")
        versions = checkpointed(versions)
        above = first.join(own.withColumnRenamed("rank", "at"), ["tree", "at"])
        first = checkpointed(above.select("tree", "rank", F.floor(F.col("at") / block).alias("at"), F.concat("path", "more").alias("path")))
        nodes = made.where("place = -1").select("tree", F.col("block").alias("rank"), "top").join(small(sizes), "tree")
    return nodes, versions, first.select("tree", "rank", "path")


def _prove(block: int, kind: str):
    """For one block: its leaves' proofs and folded roots from the block's tree, the path above it and its versions' roots."""

    def run(key, leaves: pa.Table, above: pa.Table) -> pa.Table:
        rows = sorted(zip(leaves["rank"].to_pylist(), leaves["top"].to_pylist(), leaves["changed"].to_pylist(), range(leaves.num_rows), strict=True))
        order = [r[3] for r in rows]
        places, tops = above["place"].to_pylist(), above["top"].to_pylist()
        at = places.index(-1)
        path, subroot, root = above["path"][at].as_py(), above["subroot"][at].as_py(), above["root"][at].as_py()
        changed_roots = dict(zip(places, tops, strict=True))
        made = Tree([r[1] for r in rows], _height(leaves["n"][0].as_py(), block))
        top, upper = made.nodes[made.top][0], "".join(s[1:] for s in path)
        proofs, folded = [], []
        for i, (_, leaf, changed, _) in enumerate(rows):
            own = made.path(i)
            proofs.append(digest("".join(s[1:] for s in own), upper))
            if changed is not None:
                folded.append(changed_roots[i])
            else:
                here = fold(leaf, own)
                folded.append(root if here == top else fold(here, path))
        n = len(rows)
        return pa.table({"doc_id": leaves["doc_id"].take(pa.array(order)), "leaf": [r[1] for r in rows], "subroot": [subroot] * n, "root": [root] * n, "proof_sha256": proofs, "folded_root": folded, "verified": [f == root for f in folded]})

    return run


def manifest(docs: DataFrame, tampered: Column | None = None, *, block: int = BLOCK) -> DataFrame:
    """Leaf, roots, proof and folded root of every row.

    ``tampered`` is the tampered row's leaf, null for rows that are left alone (see ``leaf_hash``).
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    changed = F.lit(None).cast("string") if tampered is None else tampered
    tree = F.when(F.col("lang").isNull(), "").otherwise(F.concat(F.lit("="), "lang"))
    leaves = docs.select("doc_id", tree.alias("tree"), leaf_hash().alias("top"), changed.alias("changed"))
    leaves = range_positions(leaves, ["tree"], ["doc_id", "top"]).withColumn("block", F.floor(F.col("rank") / block))
    leaves = checkpointed(leaves.select("doc_id", "tree", "top", F.when(F.col("changed") != F.col("top"), F.col("changed")).alias("changed"), "rank", "block"))
    sizes = leaves.groupBy("tree").agg(F.count(F.lit(1)).alias("n"))
    # never dealt by tree alone, which may hold most rows: blocks are dealt by (tree, block)
    leaves = leaves.join(small(sizes), "tree")
    made = checkpointed(leaves.groupBy("tree", "block").applyInArrow(_tops(block), NODES))
    tops = made.where("place = -1").select("tree", F.col("block").alias("rank"), "top")
    nodes = tops.join(small(tops.groupBy("tree").agg(F.count(F.lit(1)).alias("n"))), "tree")
    versions = made.where("place >= 0").select("tree", F.col("block").alias("rank"), "top", "block", "place", F.col("tree").alias("own"))
    subroots, versions, paths = _climb(nodes, versions, block)
    subroots = checkpointed(subroots.select("tree", F.col("top").alias("subroot")))
    # the languages' roots as one sequence
    ranked = checkpointed(range_positions(subroots.withColumn("all", F.lit("")), ["all"], ["tree"]))
    count = ranked.count()
    nodes = ranked.select(F.col("all").alias("tree"), "rank", F.lit(count).cast("long").alias("n"), F.col("subroot").alias("top"))
    versions = versions.drop("rank", "tree").join(small(ranked.select(F.col("tree").alias("own"), F.col("all").alias("tree"), "rank")), "own")
    root, versions, upper = _climb(nodes, versions, block)
    upper = ranked.join(upper.select("rank", F.col("path").alias("more")), "rank").crossJoin(F.broadcast(root.select(F.col("top").alias("root"))))  # one row
    paths = paths.join(small(upper.select("tree", "subroot", "root", "more")), "tree")
    above = paths.select("tree", F.col("rank").alias("block"), F.lit(-1).alias("place"), F.lit(None).cast("string").alias("top"), F.concat("path", "more").alias("path"), "subroot", "root")
    changed = versions.select(F.col("own").alias("tree"), "block", "place", "top", F.lit(None).cast("array<string>").alias("path"), *[F.lit(None).cast("string").alias(c) for c in ("subroot", "root")])
    both = above.unionByName(changed)
    return leaves.groupBy("tree", "block").cogroup(both.groupBy("tree", "block")).applyInArrow(_prove(block, kind), PROVEN.format(kind=kind))


def tampered_leaf() -> Column:
    """The leaf with one character more in ``n_chars``, where 7 divides the checksum of the id; null elsewhere."""
    hit = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    return F.when(hit & F.col("n_chars").isNotNull(), leaf_hash(n_chars=F.col("n_chars") + 1))
