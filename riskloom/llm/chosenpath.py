"""Similarity join of documents on word shingles by chosen paths.

A document is the set of its five-word shingles; documents of equal sets are one node. In every run a node
follows each of its shingles whose hash, seeded by the run, falls below ``1 / (threshold * set size)``, so
that two sets of the threshold's similarity share one path on average. Nodes on one path form a bucket. A
bucket above ``LIMIT`` nodes is split again, with the node's sketch (one minimum per hash bin) as its
tokens, to at most ``DEPTH`` levels. With ``q`` the chance that a pair at the threshold stays together down
to the last level, ``(1 - q) ^ runs`` bounds the chance to miss it; the number of runs follows from the
wanted recall.

A split keeps a share of ``mean similarity / threshold`` of a bucket's pairs but multiplies its rows; where that
share is above a half, the bucket is searched at once.

Buckets are searched by brute force on sketches for candidate links; one whose nodes are alike is finished in
one pass, since a node that was reached needs no second one. The connected components of
candidates are then compared exactly, block against block, on whole sets: this decides every link and its
count, and also finds links inside a component that no bucket held. Nodes are never expanded into copies
and pairs never leave a task; only sums per node and one edge per node and block do.

Defined results: a text of one to four words is one shingle; null texts and texts without a word are
documents without links, each its own class; repeated rows are copies of each other; ``class_id`` is the
smallest id of the class; an empty table gives no rows; other columns are ignored. Nodes are known by a
64-bit hash of their set.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import binary_column, parts_for, pieces, small, strings, unused
from riskloom.llm.components import components
from riskloom.llm.hashing import distinct, mix, shingles, text_words
from riskloom.session import checkpointed

SHINGLE, THRESHOLD, RECALL = 5, 0.8, 0.999
LIMIT, DEPTH, BLOCK, BUCKET_BLOCK = 512, 4, 1024, 8192
BINS, MARGIN, DENSE = 128, 0.11, 0.5
_CHUNK = 1 << 20
U = np.uint64


def runs_for(recall: float, depth: int) -> int:
    """Runs after which a pair at the threshold is missed with probability ``1 - recall`` at most."""
    stay = 1.0
    for _ in range(depth):
        stay = 1.0 - math.exp(-stay)
    return math.ceil(math.log(1.0 - recall) / math.log(1.0 - stay))


def limits(sizes: np.ndarray, threshold: float) -> np.ndarray:
    """Hashes below this follow the path: a share of ``1 / (threshold * size)`` of them."""
    share = 1.0 / np.maximum(threshold * sizes, 1e-9)
    return np.where(share >= 1.0, np.iinfo(U).max, (np.minimum(share, 0.999999) * 2.0**64).astype(U)).astype(U)


def scramble(values: np.ndarray, seed: int) -> np.ndarray:
    x = (values ^ U(seed)) * U(0x9FB21C651E98DF25)
    x ^= x >> U(29)
    x *= U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


def first_paths(sets: np.ndarray, at: np.ndarray, runs: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Paths of the first level of all runs, by row."""
    n = np.diff(at)
    limit, row = np.repeat(limits(n, threshold), n), np.repeat(np.arange(len(n)), n)
    rows, paths = [], []
    for run in range(runs):
        seed = int(mix(np.array([run + 1], U))[0])
        taken = np.flatnonzero(scramble(sets, seed) <= limit)
        rows.append(row[taken])
        paths.append(mix(sets[taken] + U(seed)))
    rows, paths = np.concatenate(rows), np.concatenate(paths)
    order = np.argsort(rows, kind="stable")
    to = np.zeros(len(at), np.int64)
    np.cumsum(np.bincount(rows, minlength=len(n)), out=to[1:])
    return paths[order], to


def sketches(sets: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One value per bin and row: the smallest hash that falls into it, in 16 bits; 0 for an empty bin."""
    n = np.diff(at)
    h = scramble(sets, 0xA0761D6478BD642F)
    place = np.repeat(np.arange(len(n)), n) * BINS + (h & U(BINS - 1)).astype(np.int64)
    low = np.full(len(n) * BINS, np.iinfo(U).max, U)
    np.minimum.at(low, place, h >> U(7))
    return np.where(low == np.iinfo(U).max, 0, 1 + low % U(65535)).astype(np.uint16).reshape(-1, BINS)


def _documents(runs: int, threshold: float):
    def run(batches):
        for batch in batches:
            data, offsets = strings(batch.column(1))
            for i, j in pieces(offsets, _CHUNK):
                words, at = text_words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                sets, at = distinct(*shingles(words, at, SHINGLE))
                node = [int.from_bytes(hashlib.blake2b(sets[a:b].tobytes(), digest_size=8).digest(), "little", signed=True) if b > a else None for a, b in zip(at[:-1], at[1:], strict=True)]
                paths, to = first_paths(sets, at, runs, threshold)
                sk = sketches(sets, at)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(node, pa.int64()), pa.array(np.diff(at), pa.int64()), pa.ListArray.from_arrays(pa.array(to, pa.int32()), pa.array(paths.view(np.int64), pa.int64())), binary_column(sk.ravel(), np.arange(j - i + 1) * BINS)],
                    names=["doc_id", "node", "n", "paths", "sketch"],
                )

    return run


def _deeper(threshold: float):
    """Paths of the next level: tokens are the filled bins of the sketch, their choice depends on the path."""

    def run(batches):
        for batch in batches:
            path = batch.column(0).to_numpy(zero_copy_only=False).view(U)
            node = batch.column(1)
            sk = strings(batch.column(2))[0].view(np.uint16).reshape(-1, BINS)
            if not len(path):
                continue
            for i in range(0, len(path), 4096):
                s, p = sk[i : i + 4096], path[i : i + 4096]
                token = mix(s.astype(U) * U(BINS) + np.arange(BINS, dtype=U)[None, :] + U(1) + (p * U(0x9E3779B97F4A7C15))[:, None])
                row, col = np.nonzero((s > 0) & (token <= limits((s > 0).sum(1), threshold)[:, None]))
                child = mix(token[row, col] + U(0x2545F4914F6CDD1D))
                yield pa.RecordBatch.from_arrays([pa.array(child.view(np.int64)), node.slice(i, 4096).take(pa.array(row))], names=["path", "node"])

    return run


def _signs(batches):
    """Per path and task: nodes, and per bin the sum of a random sign of the bin's value."""
    total: dict[int, tuple[int, np.ndarray]] = {}
    for batch in batches:
        if not batch.num_rows:
            continue
        path = batch.column(0).to_numpy()
        sk = strings(batch.column(2))[0].view(np.uint16).reshape(-1, BINS)
        sign = (mix(sk.astype(U) * U(BINS) + np.arange(BINS, dtype=U)) >> U(63)).astype(np.int64) * 2 - 1
        sign[sk == 0] = 0
        names, of = np.unique(path, return_inverse=True)
        sums = np.zeros((len(names), BINS), np.int64)
        np.add.at(sums, of, sign)
        for name, n, z in zip(names.tolist(), np.bincount(of).tolist(), sums, strict=True):
            old = total.get(name, (0, 0))
            total[name] = (old[0] + n, old[1] + z)
    if total:
        yield pa.RecordBatch.from_arrays([pa.array(list(total)), pa.array([n for n, _ in total.values()]), pa.array([z.tobytes() for _, z in total.values()])], names=["path", "n", "z"])


def _likeness(batches):
    """Mean similarity of two nodes of a bucket: the squared sign sums count, in expectation, pairs of equal values."""
    total: dict[int, tuple[int, np.ndarray]] = {}
    for batch in batches:
        for name, n, z in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            old = total.get(name, (0, 0))
            total[name] = (old[0] + n, old[1] + np.frombuffer(z, np.int64))
    mean = [float((z.astype(float) ** 2).mean()) / n**2 for n, z in total.values()]
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(mean, pa.float64())], names=["path", "mean"])


def grouped(batches, keys: int, run):
    """Rows arrive sorted by their first ``keys`` columns; ``run`` gets one table per group."""
    held: list[pa.RecordBatch] = []

    def same(a, b):
        return all(a.column(k)[-1] == b.column(k)[0] for k in range(keys))

    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(keys)]
        cut = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols], axis=0)) + 1
        edges = np.concatenate([[0], cut, [batch.num_rows]])
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            part = batch.slice(a, b - a)
            if held and not same(held[-1], part):
                yield from run(pa.Table.from_batches(held))
                held = []
            held.append(part)
    if held:
        yield from run(pa.Table.from_batches(held))


def alike(sk: np.ndarray, n: np.ndarray, one: int, others: np.ndarray, threshold: float) -> np.ndarray:
    """Which of the others may reach the threshold with one, by sizes (exact) and sketches (with a margin)."""
    small_, large = np.minimum(n[others], n[one]), np.maximum(n[others], n[one])
    others = others[small_ >= threshold * large - 1e-9]
    a, b = sk[one][None, :], sk[others]
    filled = ((a > 0) | (b > 0)).sum(1)
    return others[((a == b) & (a > 0)).sum(1) >= (threshold - MARGIN) * filled]


def reached(sk: np.ndarray, n: np.ndarray, threshold: float):
    """Edges of a spanning forest of the candidate graph: every node searches only what none has reached yet."""
    left = np.arange(len(n))
    while len(left) > 1:
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            one = queue.pop()
            found = alike(sk, n, one, left, threshold)
            if len(found):
                left = np.setdiff1d(left, found, assume_unique=True)
                queue += found.tolist()
                yield from ((one, int(x)) for x in found)


def _search(threshold: float):
    def bucket(table: pa.Table):
        node = table.column("node").to_numpy()
        sk = strings(table.column("sketch"))[0].view(np.uint16).reshape(-1, BINS)
        n = table.column("n").to_numpy()
        _, once = np.unique(node, return_index=True)
        node, sk, n = node[once], sk[once], n[once]
        if edges := list(reached(sk, n, threshold)):
            yield node[[a for a, _ in edges]], node[[b for _, b in edges]]

    def run(batches):
        a, b = [], []
        for x, y in grouped(batches, 2, bucket):
            a.append(x), b.append(y)
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

    return run


def block_pairs(df: DataFrame, count: str, block: int, *keep: str) -> DataFrame:
    """Deal each group's rows to blocks, and every row to all pairs of blocks with its own; ``part`` numbers the pairs."""
    blocks = F.ceil(F.col(count) / block).cast("int")
    df = df.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("node", F.lit(3)), F.col("blocks")).cast("int"))
    pair = F.struct(F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    df = df.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return df.select(*keep, "own", (pair["i"].cast("long") * F.col("blocks") + pair["j"]).alias("part"))


def candidates(nodes: DataFrame, threshold: float) -> DataFrame:
    """Candidate edges between nodes, from the buckets of all levels."""
    rows = nodes.select(F.explode("paths").alias("path"), "node")
    sides = nodes.select("node", "n", "sketch")
    leaves = None
    for level in range(1, DEPTH + 1):
        buckets = rows.groupBy("path").agg(F.count(F.lit(1)).alias("members"), F.sum(F.xxhash64("node").cast("decimal(20,0)")).cast("decimal(38,0)").alias("who")).where("members > 1")
        # buckets of the same members are searched once
        buckets = buckets.groupBy("members", "who").agg(F.min("path").alias("path")).select("path", "members")
        rows = checkpointed(rows.join(buckets, "path").select("path", "node", "members"))
        done = rows if level == DEPTH else rows.where(F.col("members") <= LIMIT)
        leaves = done if leaves is None else leaves.union(done)
        if level < DEPTH:
            rows = rows.where(F.col("members") > LIMIT)
            if rows.limit(1).count() == 0:
                break
            large = checkpointed(rows.join(sides.select("node", "sketch"), "node").select("path", "node", "sketch", "members"))
            mean = large.select("path", "node", "sketch").mapInArrow(_signs, "path long, n long, z binary").repartition("path").mapInArrow(_likeness, "path long, mean double")
            large = large.join(small(checkpointed(mean)), "path")
            leaves = leaves.union(large.where(F.col("mean") >= DENSE * threshold).select("path", "node", "members"))
            rows = checkpointed(large.where(F.col("mean") < DENSE * threshold).select("path", "node", "sketch").mapInArrow(_deeper(threshold), "path long, node long"))
    found = block_pairs(leaves, "members", BUCKET_BLOCK, "path", "node").join(sides, "node").select("path", "part", "node", "n", "sketch")
    found = found.repartition("path", "part").sortWithinPartitions("path", "part")
    return found.mapInArrow(_search(threshold), "a long, b long").distinct()


def link_matrix(sets: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which pairs of sets reach the threshold, exactly. Hashes that only one set holds cannot be shared and are left out."""
    m, n = len(sets), np.array([len(s) for s in sets], np.int64)
    token, row = np.concatenate(sets), np.repeat(np.arange(m), n)
    order = np.argsort(token, kind="stable")
    token, row = token[order], row[order]
    new = np.ones(len(token), bool)
    new[1:] = token[1:] != token[:-1]
    ids = np.cumsum(new) - 1
    shared = np.bincount(ids)[ids] > 1
    row, ids = row[shared], ids[shared]
    _, ids = np.unique(ids, return_inverse=True)
    both = np.zeros((m, m))
    width = max(256, min(4096, (1 << 24) // max(m, 1)))
    cuts = np.searchsorted(ids, np.arange(0, (ids[-1] if len(ids) else -1) + width + 1, width))
    for k in range(len(cuts) - 1):
        if cuts[k + 1] > cuts[k]:
            part = np.zeros((m, width), np.float32)
            part[row[cuts[k] : cuts[k + 1]], ids[cuts[k] : cuts[k + 1]] - k * width] = 1
            both += part @ part.T
    either = n[:, None] + n[None, :] - both
    link = both >= threshold * either - 1e-6
    np.fill_diagonal(link, False)
    return link


def _verify(threshold: float):
    def block(table: pa.Table):
        node = table.column("node").to_numpy()
        _, once = np.unique(node, return_index=True)
        if len(once) < 2:
            return
        table = table.take(pa.array(once))
        node, own, copies = node[once], table.column("own").to_numpy(), table.column("copies").to_numpy()
        data, at = strings(table.column("shingles"))
        sets = [data[a:b].view(U) for a, b in zip(at[:-1], at[1:], strict=True)]
        link = link_matrix(sets, threshold)
        if own.min() != own.max():
            link &= own[:, None] != own[None, :]
        linked = np.flatnonzero(link.any(1))
        if not len(linked):
            return
        root = np.full(len(node), -1)
        for one in linked:
            if root[one] < 0:
                root[one], queue = one, [one]
                while queue:
                    near = np.flatnonzero(link[queue.pop()] & (root < 0))
                    root[near] = one
                    queue += near.tolist()
        yield node[linked], node[root[linked]], (link[linked] @ copies.astype(np.int64)).astype(np.int64)

    def run(batches):
        for node, root, n in grouped(batches, 2, block):
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(root), pa.array(n)], names=["a", "b", "links"])

    return run


def _sets():
    """Whole sets of the given documents, where their node is the wanted one."""

    def run(batches):
        for batch in batches:
            data, offsets = strings(batch.column(0))
            want = batch.column(1).to_numpy()
            for i, j in pieces(offsets, _CHUNK):
                words, at = text_words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                sets, at = distinct(*shingles(words, at, SHINGLE))
                keep = [k for k in range(j - i) if at[k + 1] > at[k] and int.from_bytes(hashlib.blake2b(sets[at[k] : at[k + 1]].tobytes(), digest_size=8).digest(), "little", signed=True) == want[i + k]]
                if keep:
                    raw = [sets[at[k] : at[k + 1]] for k in keep]
                    take = pa.array([i + k for k in keep])
                    yield pa.RecordBatch.from_arrays([*[batch.column(c).take(take) for c in range(1, 5)], binary_column(np.concatenate(raw), np.cumsum([0, *map(len, raw)]))], names=["node", "group", "members", "copies", "shingles"])

    return run


def similarity_classes(docs: DataFrame, *, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """doc_id, class_id, n_links (other documents at or above the threshold) and n_copies of every document."""
    runs = runs_for(recall, DEPTH)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = checkpointed(source.mapInArrow(_documents(runs, threshold), "doc_id long, node long, n long, paths array<long>, sketch binary"))
    nodes = rows.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("first_doc"), F.count(F.lit(1)).alias("copies"), F.any_value("n").alias("n"), F.any_value("paths").alias("paths"), F.any_value("sketch").alias("sketch"))
    nodes = checkpointed(nodes)
    groups = components(candidates(nodes, threshold))
    groups = groups.join(groups.groupBy("root").agg(F.count(F.lit(1)).alias("members")), "root").withColumnRenamed("root", "group")
    wanted = checkpointed(groups.join(nodes.select("node", "first_doc", "copies"), "node"))
    text = source.join(small(wanted), source["doc_id"] == wanted["first_doc"]).select("text", "node", "group", "members", "copies")
    sets = text.mapInArrow(_sets(), "node long, group long, members long, copies long, shingles binary")
    sets = block_pairs(sets, "members", BLOCK, "group", "node", "copies", "shingles").select("group", "part", "node", "own", "copies", "shingles")
    n = parts_for(wanted.count(), 2000)
    links = checkpointed(sets.repartition(n, "group", "part").sortWithinPartitions("group", "part").mapInArrow(_verify(threshold), "a long, b long, links long"))
    classes = components(links.select("a", "b"))
    counts = links.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    info = nodes.select("node", "first_doc", "copies").join(classes, "node", "left").join(counts, "node", "left")
    info = info.withColumn("root", F.coalesce("root", "node"))
    low = info.groupBy("root").agg(F.min("first_doc").alias("class_id"))
    info = info.join(low, "root").select("node", "class_id", "copies", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"))
    out = rows.select("doc_id", "node").join(info, "node", "left")
    return out.select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("links", F.lit(0)).alias("n_links"), F.coalesce("copies", F.lit(1)).alias("n_copies"))


def one_per_class(docs: DataFrame, **parameters) -> DataFrame:
    """The document with the smallest id of every class, with the input's columns.

    Rows that repeat an id and a text count once; rows that repeat an id with other texts, and rows without
    an id, stay or go together.
    """
    key = unused(docs, "doc")
    classes = checkpointed(similarity_classes(docs, **parameters).select(F.col("doc_id").alias(key), "class_id"))
    gone = small(classes.where(F.col(key) != F.col("class_id")).select(key).distinct())
    kept = docs.join(gone, F.col("doc_id") == F.col(key), "left_anti")
    twice = checkpointed(classes.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(key))
    if twice.limit(1).count() == 0:
        return kept
    same, twice = F.col("doc_id").eqNullSafe(F.col(key)), small(twice)
    return kept.join(twice, same, "left_anti").unionByName(kept.join(twice, same, "left_semi").dropDuplicates(["doc_id", "text"]))
