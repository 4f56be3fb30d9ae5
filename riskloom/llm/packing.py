"""Conflict-constrained best-fit packing of documents into training sequences.

Documents are dealt by a hash of their id into shards of a few thousand rows; a shard is packed by one
task. Inside, documents go from large to small. Open bins are kept by the room they have left; the
search starts at the smallest sufficient room and moves on to its successors until it finds the
tightest bin in which the document conflicts with none of those already there. Every bin carries one
bitmap of duplicate clusters and one bitmap per allowed repetition of a source. A conflict is: the
document's duplicate cluster is already in the bin, or its source is there ``per_source`` times.

A document longer than a bin is cut into full bins of its own and a remainder, which is packed like
any other. Defined results: null texts and texts without a word take no room and get no bin (``bin``
is null); equal rows are members of one cluster and go to different bins; null sources are a source like any
other and rows without a class are clusters of equal texts; an empty table gives no rows; a very long text is cut
into bins without being read again; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.chosenpath import similarity_classes
from riskloom.llm.common import n_words, parts_for, text_or_empty

CAPACITY, SHARD_ROWS, PER_SOURCE = 2048, 4096, 4
SCHEMA = "doc_id long, piece long, start_word long, n_words long, bin string, bin_words long"


def pack(sizes, clusters, sources, capacity: int = CAPACITY, per_source: int = PER_SOURCE) -> list[int]:
    """The bin of every item, items taken from large to small (then by cluster, source and place)."""
    code: dict = {}
    cl = [code.setdefault(("c", x), len(code)) for x in clusters]
    sr = [code.setdefault(("s", x), len(code)) for x in sources]
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], cl[i], sr[i], i))
    by_room: list[dict[int, None]] = [{} for _ in range(capacity + 1)]  # in the order in which bins came to this room
    rooms = 0  # bit r: some open bin has room r
    room_of: list[int] = []
    cluster_bits: list[int] = []
    source_bits: list[list[int]] = []
    out, run, found = [0] * len(sizes), None, iter(())

    def candidates(size: int):
        """Bins by growing room, as they were when the run of equal items began."""
        mask, at = rooms >> size, size
        while mask:
            step = (mask & -mask).bit_length() - 1
            at += step
            mask >>= step + 1
            yield from list(by_room[at])
            at += 1

    for i in order:
        size, c, s = sizes[i], 1 << cl[i], 1 << sr[i]
        # a bin that an equal item has tried is closed to the next one: it took that item or refuses both
        if run != (size, c, s):
            run, found = (size, c, s), candidates(size)
        for b in found:
            if not cluster_bits[b] & c and not source_bits[b][-1] & s:
                old = room_of[b]
                del by_room[old][b]
                if not by_room[old]:
                    rooms &= ~(1 << old)
                break
        else:
            b, old = len(room_of), capacity
            room_of.append(capacity)
            cluster_bits.append(0)
            source_bits.append([0] * per_source)
        room_of[b] = old - size
        by_room[old - size][b] = None
        rooms |= 1 << (old - size)
        cluster_bits[b] |= c
        for k in range(per_source):
            if not source_bits[b][k] & s:
                source_bits[b][k] |= s
                break
        out[i] = b
    return out


def _shard(capacity: int, per_source: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "cluster", "size"], kind="stable", ignore_index=True)
        size = rows["size"].to_numpy(np.int64)
        cluster, source = ([None if pd.isna(x) else x for x in rows[c]] for c in ("cluster", "source"))
        parts, shard = [], int(rows["shard"].iloc[0])
        count = -(-size // capacity)
        left = size - np.maximum(count - 1, 0) * capacity
        full = np.repeat(np.arange(len(rows)), np.maximum(count - 1, 0))
        piece = np.arange(len(full)) - np.repeat(np.cumsum(np.maximum(count - 1, 0)) - np.maximum(count - 1, 0), np.maximum(count - 1, 0))
        parts.append(pd.DataFrame({"row": full, "piece": piece, "n_words": capacity, "bin": [f"{shard}-f{k}" for k in range(len(full))], "bin_words": capacity}))
        some = np.flatnonzero(left > 0)
        bins = np.array(pack(left[some].tolist(), [cluster[i] for i in some], [source[i] for i in some], capacity, per_source), np.int64)
        fill = np.bincount(bins, left[some]) if len(some) else np.zeros(0)
        parts.append(pd.DataFrame({"row": some, "piece": count[some] - 1, "n_words": left[some], "bin": [f"{shard}-{b}" for b in bins], "bin_words": fill[bins].astype(np.int64) if len(some) else []}))
        none = np.flatnonzero(left == 0)
        parts.append(pd.DataFrame({"row": none, "piece": 0, "n_words": 0, "bin": None, "bin_words": 0}))
        out = pd.concat([p for p in parts if len(p)], ignore_index=True)
        out["doc_id"] = rows["doc_id"].to_numpy()[out["row"].to_numpy(np.int64)]
        out["start_word"] = out["piece"].astype(np.int64) * capacity
        return out[["doc_id", "piece", "start_word", "n_words", "bin", "bin_words"]]

    return run


def near_copies(docs: DataFrame) -> DataFrame:
    """doc_id and the class of near copies it is in, one row per id."""
    return similarity_classes(docs).groupBy("doc_id").agg(F.min("class_id").alias("class_id"))


def best_fit(docs: DataFrame, *, classes: DataFrame | None = None, capacity: int = CAPACITY, per_source: int = PER_SOURCE, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per piece of a document: its place in the document and its bin.

    Clusters are the given ``classes`` (doc_id, class_id); without them, and for rows that have none, equal texts.
    """
    rows = docs.select("doc_id", F.col("source").cast("string").alias("source"), F.xxhash64(text_or_empty()).cast("string").alias("cluster"), n_words().alias("size"))
    if classes is not None:
        given = classes.select(F.col("doc_id").alias("_id"), F.concat(F.lit("class "), F.col("class_id").cast("string")).alias("_class"))
        rows = rows.join(given, rows["doc_id"] == given["_id"], "left").withColumn("cluster", F.coalesce("_class", "cluster")).drop("_id", "_class")
    shards = parts_for(docs.count(), shard_rows, 1)
    # the cluster takes part in the deal, so that rows which repeat one id spread as well
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", "cluster", "size", F.lit(7)), F.lit(shards)).cast("int"))
    return rows.groupBy("shard").applyInPandas(_shard(capacity, per_source), SCHEMA)
