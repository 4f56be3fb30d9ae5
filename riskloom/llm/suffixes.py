"""Removal of byte strings that an earlier document holds, by suffix sorting in two stages.

Every byte that lies in a ``LENGTH``-byte string which also starts in a document with a smaller id goes. The
work is cut so that equal strings meet without moving all suffixes:

1. Texts are dealt once, by a hash of id and text, to shelves of a few megabytes; later steps read the same
   exchange. Equal rows that together exceed a shelf are counted first and travel as one. Each ``LENGTH``-byte window belongs to the smallest ``ANCHOR``-byte substring inside it (by
   hash, leftmost of equals), which depends on the window's bytes alone; neighbouring windows mostly share
   it, so that there is one run of windows for about 16 bytes of text.
2. Per shelf the distinct anchors go to shards by their hash; a shard tells each shelf which of its anchors
   occur in two documents, and which have more than ``HOT`` contexts. An anchor is sent once per shelf,
   however many documents hold it.
3. The bytes of the runs of shared anchors (contexts), once per shelf, go to the shard of the anchor. Runs of
   an anchor with too many contexts (the edge of a passage that very many documents hold) are cut into their
   windows, which go to the shard of their own hash: equal windows still meet, in all shards. There the suffixes that begin a window are sorted in two stages: those smaller than their successors directly,
   all others induced by one scan over the buckets of first bytes. Adjacent suffixes with a common prefix of
   ``LENGTH`` are equal windows, and the smallest id among their documents is their first place.
4. Each shelf marks the windows whose first place is a smaller id.

Defined results: null counts as an empty text; texts under ``LENGTH`` bytes stay whole; rows that repeat an id
do not remove from each other; a null id counts as the smallest; an empty table gives no rows; other columns
are ignored. Strings never cross documents and are judged on the input.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import parts_for, small, strings, text_bytes, text_or_empty
from riskloom.llm.hashing import mix, powers
from riskloom.session import checkpointed

LENGTH, ANCHOR = 50, 20
SHELF_BYTES, SHARD_BYTES, HOT = 6 << 20, 16 << 20, 1 << 17
_STEP = 1 << 20
_NULL = -(1 << 63)
U = np.uint64


def window_runs(data: np.ndarray, at: np.ndarray, length: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor: piece, first window, number of windows, hashes of the anchor and of the run's bytes."""
    n, span = len(data), length - anchor + 1
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none, np.zeros(0, U), np.zeros(0, U)
    up, down = powers(n + 1)
    total = np.zeros(n + 1, U)
    np.cumsum((data.astype(U) + U(1)) * up[:n], out=total[1:])
    whole = mix((total[anchor:] - total[:-anchor]) * down[: n - anchor + 1])
    low = (whole & U(0xFFFFFFFF00000000)) | np.arange(len(whole), dtype=U)
    width = 1
    while width * 2 <= span:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if span > width:
        low = np.minimum(low[: len(low) - (span - width)], low[span - width :])
    place = (low & U(0xFFFFFFFF)).astype(np.int64)
    piece = np.repeat(np.arange(len(at) - 1), np.maximum(np.diff(at) - length + 1, 0))
    first = np.cumsum(np.maximum(np.diff(at) - length + 1, 0))
    window = np.arange(len(piece)) - np.repeat(np.concatenate([[0], first[:-1]]), np.maximum(np.diff(at) - length + 1, 0)) + at[piece]
    if not len(window):
        return none, none, none, np.zeros(0, U), np.zeros(0, U)
    mine = place[window]
    new = np.ones(len(window), bool)
    new[1:] = (mine[1:] != mine[:-1]) | (piece[1:] != piece[:-1])
    begin = np.flatnonzero(new)
    first, count = window[begin], np.diff(np.append(begin, len(window)))
    bytes_hash = mix((total[first + count + length - 1] - total[first]) * down[first] + count.astype(U))
    return piece[begin], first, count, whole[mine[begin]], bytes_hash


class Shelf:
    """The texts of one shelf in a fixed order, and their runs of windows."""

    def __init__(self, table: pa.Table, shards: int, length: int, anchor: int):
        table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")])
        self.length, self.keys, self.copies = length, table.column("doc_id").to_numpy(), table.column("copies").to_numpy()
        self.data, self.at = strings(table.column("text"))
        doc, start, count, code, run = [], [], [], [], []
        todo, size = [], 0
        for d, (a, b) in enumerate(zip(self.at[:-1].tolist(), self.at[1:].tolist(), strict=True)):
            # a long text is cut between windows, so that every window is in one piece
            for x in range(a, b - length + 1, _STEP):
                y = min(b, x + _STEP + length - 1)
                if size + y - x > _STEP and todo:
                    self._add(todo, anchor, doc, start, count, code, run)
                    todo, size = [], 0
                todo.append((d, x, y))
                size += y - x
        if todo:
            self._add(todo, anchor, doc, start, count, code, run)
        join = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
        self.doc, self.start, self.count = join(doc, np.int64), join(start, np.int64), join(count, np.int64)
        code, self.run = join(code, U), join(run, U)
        # a shard and 32 bits: anchors that fall together only cost a needless comparison
        self.key = ((code & U(0xFFFFFFFF)) % U(shards)) << U(32) | (code >> U(32))
        self.names, self.of = np.unique(self.key, return_inverse=True)
        self.cuts = np.searchsorted(self.names, np.arange(shards + 1, dtype=U) << U(32))

    def _add(self, todo, anchor, doc, start, count, code, run) -> None:
        data = np.concatenate([self.data[x:y] for _, x, y in todo])
        at = np.concatenate([[0], np.cumsum([y - x for _, x, y in todo])])
        piece, window, n, h, r = window_runs(data, at, self.length, anchor)
        doc.append(np.array([d for d, _, _ in todo])[piece])
        start.append(window - at[piece] + np.array([x for _, x, _ in todo])[piece])
        count.append(n), code.append(h), run.append(r)

    def repeated(self) -> np.ndarray:
        """Which anchors occur in two documents of this shelf."""
        if not len(self.names):
            return np.zeros(0, bool)
        low, high = np.full(len(self.names), np.iinfo(np.int64).max), np.full(len(self.names), _NULL)
        np.minimum.at(low, self.of, self.keys[self.doc])
        np.maximum.at(high, self.of, self.keys[self.doc])
        return low < high

    def n_contexts(self) -> np.ndarray:
        """How many different runs each anchor has in this shelf, by their hash (65,535 at most)."""
        n = np.bincount(self.of, minlength=len(self.names))
        more = np.flatnonzero(n[self.of] > 1)
        order = more[np.lexsort((self.run[more], self.of[more]))]
        of, run = self.of[order], self.run[order]
        again = np.zeros(len(of), bool)
        again[1:] = (of[1:] == of[:-1]) & (run[1:] == run[:-1])
        n -= np.bincount(of[again], minlength=len(n))
        return np.minimum(n, 65535).astype(np.uint16)

    def contexts(self, shared: np.ndarray, hot: np.ndarray):
        """Distinct bytes of the runs of shared anchors, and of the windows of hot ones.

        Returns document, first byte and context of every occurrence, the contexts, their smallest ids and shards.
        """
        runs = np.flatnonzero(shared[self.of])
        runs = runs[np.argsort(self.key[runs] >> U(32), kind="stable")]
        cut = hot[self.of[runs]]
        n = np.where(cut, self.count[runs], 1)
        runs, cut = np.repeat(runs, n), np.repeat(cut, n)
        start = self.start[runs] + np.arange(len(runs)) - np.repeat(np.cumsum(n) - n, n)
        stop = start + np.where(cut, 1, self.count[runs]) + self.length - 1
        raw, known, which, low = self.data.tobytes(), {}, np.empty(len(runs), np.int64), []
        ids = self.keys[self.doc[runs]].tolist()
        shard, shards = np.where(cut, -1, (self.key[runs] >> U(32)).astype(np.int64)).tolist(), len(self.cuts) - 1
        owner = []
        for i, (a, b, d) in enumerate(zip(start.tolist(), stop.tolist(), ids, strict=True)):
            part = raw[a:b]
            k = known.setdefault(part, len(low))
            if k == len(low):
                low.append(d), owner.append(shard[i] if shard[i] >= 0 else zlib.crc32(part) % shards)
            elif d < low[k]:
                low[k] = d
            which[i] = k
        return self.doc[runs], start, which, list(known), np.array(low, np.int64), np.array(owner, np.int64)


def sorted_windows(data: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """The places of all windows of the contexts in the order of their bytes, by two-stage sorting."""
    n, end = len(data), at[1:]
    if not n:
        return np.zeros(0, np.int64)
    # a suffix is small if it is smaller than its successor: the next differing byte is larger
    step = np.zeros(n, np.int8)
    step[:-1] = np.sign(np.diff(data.astype(np.int16)))
    step[end - 1] = -1
    differs = np.flatnonzero(step)
    is_small = step[differs[np.searchsorted(differs, np.arange(n))]] > 0
    smalls = np.flatnonzero(is_small)
    last_window = end - length
    # what is sorted: the windows, and from the last window of a context on up to the next small suffix
    k = np.searchsorted(smalls, last_window)
    until = np.where(k < len(smalls), smalls[np.minimum(k, max(len(smalls) - 1, 0))] if len(smalls) else n, n)
    until = np.minimum(until, end - 1)
    edge = np.zeros(n + 1, np.int64)
    edge[at[:-1]] += 1
    np.subtract.at(edge, until + 1, 1)
    member = np.cumsum(edge)[:n] > 0
    final = np.zeros(n, bool)
    final[end - 1] = True
    direct = np.flatnonzero(member & (is_small | final))
    padded = np.concatenate([data, np.zeros(64, np.uint8)])
    words = np.ndarray((n + 56,), ">u8", padded, strides=(1,))
    direct = direct[np.lexsort([words[direct + 8 * j].astype(U) for j in range(-(-length // 8) - 1, -1, -1)])]
    first = data[direct]
    induced = member & ~is_small & ~final
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    out = []
    for c in range(256):
        mine = direct[first == c] if len(direct) else direct
        ends = final[mine]
        layer = np.concatenate([mine[ends], *waiting[c]]) if waiting[c] or ends.any() else mine[:0]
        large = [layer]
        while len(layer):
            # predecessors with the same byte follow in the same bucket
            before = layer[layer > 0] - 1
            layer = before[induced[before] & (data[before] == c)]
            large.append(layer)
        bucket = np.concatenate([*large, mine[~ends]])
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[induced[before] & (data[before] > c)]
        byte = data[before]
        order = np.argsort(byte, kind="stable")
        before, byte = before[order], byte[order]
        for part in np.split(before, np.flatnonzero(np.diff(byte)) + 1):
            if len(part):
                waiting[data[part[0]]].append(part)
    out = np.concatenate(out)
    of = np.searchsorted(at, out, "right") - 1
    return out[out <= last_window[of]]


def first_places(parts: list[bytes], low: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For every window of every context the smallest id of a document with the same bytes, and the contexts' first windows."""
    data = np.frombuffer(b"".join(parts), np.uint8)
    at = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    order = sorted_windows(data, at, length)
    context = np.searchsorted(at, order, "right") - 1
    padded = np.concatenate([data, np.zeros(64, np.uint8)])
    words = np.ndarray((len(data) + 56,), "<u8", padded, strides=(1,))
    a, b = order[:-1], order[1:]
    equal = np.ones(len(a), bool)
    for j in [*range(0, length - 7, 8), *([length - 8] if length % 8 else [])]:
        equal &= words[a + j] == words[b + j]
    starts = np.flatnonzero(np.concatenate([[True], ~equal]))
    group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(order))))
    least = np.minimum.reduceat(low[context], starts)
    window = np.concatenate([[0], np.cumsum(np.diff(at) - length + 1)])
    out = np.empty(len(order), np.int64)
    out[window[context] + order - at[context]] = least[group]
    return out, window


def _pack(*arrays: np.ndarray) -> bytes:
    raw = b"".join(len(a).to_bytes(8, "little") + a.dtype.str.encode().ljust(4) + a.tobytes() for a in arrays)
    return zstandard.ZstdCompressor(1).compress(raw)


def _unpack(raw: bytes) -> list[np.ndarray]:
    raw, at, out = zstandard.ZstdDecompressor().decompress(raw), 0, []
    while at < len(raw):
        n, kind = int.from_bytes(raw[at : at + 8], "little"), np.dtype(raw[at + 8 : at + 12].decode().strip())
        out.append(np.frombuffer(raw, kind, n, at + 12))
        at += 12 + n * kind.itemsize
    return out


def _masks_of(side: pa.Table, shelf: Shelf) -> tuple[np.ndarray, np.ndarray]:
    """Which anchors of the shelf are shared, and which are hot."""
    shared, hot = np.zeros(len(shelf.names), bool), np.zeros(len(shelf.names), bool)
    for shard, blob in zip(side.column("shard").to_pylist(), side.column("blob").to_pylist(), strict=True):
        a, b = shelf.cuts[shard], shelf.cuts[shard + 1]
        shared[a:b], hot[a:b] = (np.unpackbits(x, count=b - a) for x in _unpack(blob))
    return shared, hot


_ROW = "shard int, shelf int, blob binary"


def _row(shard, shelf, blob) -> pa.Table:
    return pa.table({"shard": pa.array(shard, pa.int32()), "shelf": pa.array(shelf, pa.int32()), "blob": pa.array(blob, pa.binary())})


def _equal_rows(rows: DataFrame) -> tuple[DataFrame, bool]:
    """The rows with their number of copies: 1, but for equal rows that together exceed a shelf, which become one."""
    code = F.xxhash64("text")
    many = rows.groupBy("doc_id", code.alias("code")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("size"))
    many = checkpointed(many.where((F.col("n") > 1) & (F.col("size") > SHELF_BYTES)).select(F.col("doc_id").alias("_id"), "code"))
    if many.isEmpty():
        return rows.withColumn("copies", F.lit(1).cast("long")), False
    many = small(many)
    mine = (F.col("doc_id") == F.col("_id")) & (code == F.col("code"))
    some = rows.join(many, mine, "left_anti").withColumn("copies", F.lit(1).cast("long"))
    return some.unionByName(rows.join(many, mine, "left_semi").groupBy("doc_id", "text").agg(F.count(F.lit(1)).alias("copies"))), True


def remove_repeats(docs: DataFrame, *, length: int = LENGTH, anchor: int = ANCHOR, hot: int = HOT, keep_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256; with ``keep_text`` also the remaining bytes as ``kept`` (binary).

    Anchors with more than ``hot`` contexts are cut into windows.
    """
    size = text_bytes(docs)
    shelves, shards = parts_for(size, SHELF_BYTES), parts_for(size, SHARD_BYTES)
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL))
    rows, copied = _equal_rows(docs.select(key.alias("doc_id"), text_or_empty().alias("text")))
    texts = rows.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(shelves)).cast("int").alias("shelf"), "doc_id", "text", "copies")
    # no more rows than these ever move with their text; the exchange below is made once and read three times
    texts = texts.repartition(parts_for(shelves, 3), "shelf")

    def anchors(table: pa.Table) -> pa.Table:
        shelf = Shelf(table, shards, length, anchor)
        twice, n, rows = shelf.repeated(), shelf.n_contexts(), []
        for shard in range(shards):
            a, b = shelf.cuts[shard], shelf.cuts[shard + 1]
            if b > a:
                rows.append((shard, table.column("shelf")[0].as_py(), _pack((shelf.names[a:b] & U(0xFFFFFFFF)).astype(np.uint32), np.packbits(twice[a:b]), n[a:b])))
        return _row(*zip(*rows, strict=True)) if rows else _row([], [], [])

    def shared(table: pa.Table) -> pa.Table:
        parts = [_unpack(x) for x in table.column("blob").to_pylist()]
        names = np.concatenate([p[0] for p in parts])
        twice = np.concatenate([np.unpackbits(p[1], count=len(p[0])).astype(bool) for p in parts])
        order = np.argsort(names, kind="stable")
        s = names[order]
        near = np.zeros(len(s), bool)
        near[1:] = s[1:] == s[:-1]
        near[:-1] |= near[1:]
        twice[order] |= near
        many = np.zeros(len(s), bool)
        first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
        n = np.add.reduceat(np.concatenate([p[2] for p in parts]).astype(np.int64)[order], first)
        many[order] = np.repeat(n > hot, np.diff(np.append(first, len(s))))
        cuts = np.cumsum([len(p[0]) for p in parts])[:-1]
        both = zip(np.split(twice, cuts), np.split(many, cuts), strict=True)
        return _row(table.column("shard").to_pylist(), table.column("shelf").to_pylist(), [_pack(np.packbits(x), np.packbits(y)) for x, y in both])

    def contexts(texts: pa.Table, side: pa.Table) -> pa.Table:
        if not len(texts):
            return _row([], [], [])
        shelf = Shelf(texts, shards, length, anchor)
        _, _, _, parts, low, owner = shelf.contexts(*_masks_of(side, shelf))
        rows = []
        for shard in np.unique(owner):
            mine = np.flatnonzero(owner == shard)
            sizes = np.array([len(parts[i]) for i in mine], np.uint32)
            data = np.frombuffer(b"".join(parts[i] for i in mine), np.uint8)
            rows.append((int(shard), texts.column("shelf")[0].as_py(), _pack(sizes, low[mine], data)))
        return _row(*zip(*rows, strict=True)) if rows else _row([], [], [])

    def places(table: pa.Table) -> pa.Table:
        known: dict[bytes, int] = {}
        low, own = [], []
        for blob in table.column("blob").to_pylist():
            sizes, least, data = _unpack(blob)
            raw, ends = data.tobytes(), np.cumsum(sizes.astype(np.int64)).tolist()
            mine, a = [], 0
            for b, d in zip(ends, least.tolist(), strict=True):
                k = known.setdefault(raw[a:b], len(low))
                if k == len(low):
                    low.append(d)
                elif d < low[k]:
                    low[k] = d
                mine.append(k)
                a = b
            own.append(np.array(mine, np.int64))
        if not known:
            return _row([], [], [])
        least, window = first_places(list(known), np.array(low, np.int64), length)
        # stretches of windows with one first place
        new = np.ones(len(least), bool)
        new[1:] = least[1:] != least[:-1]
        new[window[:-1]] = True
        begin = np.flatnonzero(new)
        run, value = np.diff(np.append(begin, len(least))), least[begin]
        first = np.searchsorted(begin, window)
        blobs = []
        for mine in own:
            n = first[mine + 1] - first[mine]
            take = np.repeat(first[mine] - np.cumsum(n) + n, n) + np.arange(n.sum())
            blobs.append(_pack(n.astype(np.uint32), run[take].astype(np.uint32), value[take]))
        return _row(table.column("shard").to_pylist(), table.column("shelf").to_pylist(), blobs)

    def result(texts: pa.Table, masks: pa.Table, found: pa.Table) -> pa.Table:
        shelf = Shelf(texts, shards, length, anchor)
        doc, start, which, parts, _, owner = shelf.contexts(*_masks_of(masks, shelf))
        edge = np.zeros(len(shelf.data) + 1, np.int32)
        number, stretch, value = np.zeros(len(parts), np.int64), {}, {}
        for shard, blob in zip(found.column("shard").to_pylist(), found.column("blob").to_pylist(), strict=True):
            mine = np.flatnonzero(owner == shard)
            number[mine], stretch[shard], value[shard] = _unpack(blob)
        order = np.argsort(owner, kind="stable")
        at = np.zeros(len(parts), np.int64)
        at[order] = np.cumsum(number[order]) - number[order]
        names = sorted(stretch)
        run = np.concatenate([stretch[s] for s in names]).astype(np.int64) if names else np.zeros(0, np.int64)
        least = np.concatenate([value[s] for s in names]) if names else np.zeros(0, np.int64)
        upto = np.cumsum(run)
        n = number[which]
        take = np.repeat(at[which] - np.cumsum(n) + n, n) + np.arange(n.sum())
        base = np.where(at < len(upto), (upto - run)[np.minimum(at, max(len(upto) - 1, 0))] if len(upto) else 0, 0)
        begin = np.repeat(start - base[which], n) + (upto - run)[take]
        gone = least[take] < np.repeat(shelf.keys[doc], n)
        begin, stop = begin[gone], begin[gone] + run[take][gone] + length - 1
        np.add.at(edge, begin, 1)
        np.subtract.at(edge, stop, 1)
        removed = np.cumsum(edge)[:-1] > 0
        rows = []
        for d, (a, b) in enumerate(zip(shelf.at[:-1].tolist(), shelf.at[1:].tolist(), strict=True)):
            mask = removed[a:b]
            left = shelf.data[a:b][~mask].tobytes()
            key = int(shelf.keys[d])
            rows.append((int(shelf.copies[d]), None if key == _NULL else key, b - a, b - a - len(left), int(mask[:1].sum()) + int((mask[1:] & ~mask[:-1]).sum()), hashlib.sha256(left).hexdigest(), *([left] if keep_text else [])))
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names_out)

    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), *([pa.binary()] if keep_text else [])]
    names_out = ["copies", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept"] if keep_text else [])]

    def finish(texts: pa.Table, side: pa.Table) -> pa.Table:
        if not len(texts):
            return pa.table([pa.array([], t) for t in kinds], names=names_out)
        kind = np.array(side.column("kind").to_pylist(), np.int64)
        return result(texts, side.filter(pa.array(kind == 0)), side.filter(pa.array(kind == 1)))

    masks = texts.groupBy("shelf").applyInArrow(anchors, _ROW).groupBy("shard").applyInArrow(shared, _ROW)
    found = texts.groupBy("shelf").cogroup(masks.groupBy("shelf")).applyInArrow(contexts, _ROW).groupBy("shard").applyInArrow(places, _ROW)
    side = masks.withColumn("kind", F.lit(0)).union(found.withColumn("kind", F.lit(1)))
    schema = "copies long, doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if keep_text else "")
    out = texts.groupBy("shelf").cogroup(side.groupBy("shelf")).applyInArrow(finish, schema)
    if copied:
        out = out.withColumn("copies", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return out.drop("copies")
