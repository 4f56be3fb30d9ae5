"""I-Match fingerprints: hashes of a document's distinct terms inside a band of document frequencies.

The lexicon holds the terms that occur in at least ``low`` and at most ``high`` of all documents (and in
two at least). A document's distinct lexicon terms, sorted, give one hash over the whole lexicon and one
over each of many random parts of it: ``SUBSETS`` parts that keep every 8th term, as many that keep every
32nd, 128th and 512th. Two documents are alike in the share of parts, among those not empty in both, whose
hashes agree, taken over the sizes at which a good number of parts is empty: there this share tends to the
share of common terms, for short and long documents alike. The lexicon cannot exceed ``distinct terms per document / low``
entries, whatever the number of documents, which is why it may be broadcast.

Defined results: null counts as an empty text; a document without a lexicon term is known by the hash of its
bytes alone, and is alike (1) only to equal ones; equal texts have equal fingerprints; the order of rows
that repeat an id is that of their texts; a null id is the smallest; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import parts_for, pieces, strings, text_bytes, text_or_empty
from riskloom.llm.hashing import distinct, mix, text_words

LOW, HIGH, SUBSETS = 0.001, 0.2, 32
ONE_IN = (8, 32, 128, 512)
FULL, MOST = 65535, 8
PART_BYTES = 24 << 20
_CHUNK = 1 << 20
U = np.uint64
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:48] = _FOLD[58:65] = _FOLD[91:97] = _FOLD[123:128] = 32
_FOLD[65:91] = np.arange(97, 123)


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct term hashes of every text; ASCII letters in lower case, other ASCII but digits as space."""
    return distinct(*text_words(_FOLD[data], offsets))


def lexicon(docs: DataFrame, low: float = LOW, high: float = HIGH) -> np.ndarray:
    """Sorted hashes of the terms inside the band, counted over all documents."""

    def run(batches):
        for batch in batches:
            data, offsets = strings(batch.column(0))
            parts = [terms(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])[0] for i, j in pieces(offsets, _CHUNK)]
            term, n = np.unique(np.concatenate(parts), return_counts=True) if parts else (np.zeros(0, U), np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(term.view(np.int64)), pa.array(n.astype(np.int32))], names=["term", "n"])

    total = docs.count()
    counts = docs.select("text").mapInArrow(run, "term long, n int").groupBy("term").agg(F.sum("n").alias("n"))
    band = counts.where((F.col("n") >= max(2.0, low * total)) & (F.col("n") <= max(2.0, high * total)))
    return np.sort(band.select("term").toPandas()["term"].to_numpy(np.int64).view(U))


class Fingerprints:
    """Hashes of texts for one lexicon and its random parts."""

    def __init__(self, known: np.ndarray, subsets: int = SUBSETS):
        self.known, self.subsets = known, subsets
        self.parts = []
        for one_in in ONE_IN:
            member = np.zeros((len(known), subsets), bool)
            for k in range(subsets):
                member[:, k] = mix(known ^ U(0x51ED270B + 1000 * one_in + k)) % U(one_in) == 0
            self.parts.append((np.concatenate([[0], np.cumsum(member.sum(1))]), np.nonzero(member)[1]))

    def hashes(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per text the hash over the whole lexicon, and those of the parts (0: no term, FULL: too many to tell)."""
        values, at = terms(data, offsets)
        n = len(offsets) - 1
        row = np.repeat(np.arange(n), np.diff(at))
        place = np.searchsorted(self.known, values)
        inside = self.known[np.minimum(place, len(self.known) - 1)] == values if len(self.known) else np.zeros(len(values), bool)
        values, row, place = values[inside], row[inside], place[inside]
        whole, found = np.zeros(n, U), np.bincount(row, minlength=n)
        np.add.at(whole, row, mix(values))
        for i in np.flatnonzero(found == 0):
            whole[i] = int.from_bytes(hashlib.blake2b(data[offsets[i] : offsets[i + 1]].tobytes(), digest_size=8).digest(), "little")
        out = np.zeros((len(ONE_IN), n, self.subsets), np.uint16)
        for tier, (one_in, (first, part)) in enumerate(zip(ONE_IN, self.parts, strict=True)):
            # parts that hold many terms of a long text would differ at the slightest edit
            far = (found > MOST * one_in) & (tier < len(ONE_IN) - 1)
            near = ~far[row]
            v, r, p = values[near], row[near], place[near]
            count = first[p + 1] - first[p]
            k = part[np.repeat(first[p] - np.cumsum(count) + count, count) + np.arange(count.sum())]
            total = np.zeros(n * self.subsets, U)
            np.add.at(total, np.repeat(r, count) * self.subsets + k, mix(np.repeat(v, count) + k.astype(U) * U(0x9E3779B97F4A7C15)))
            out[tier] = np.where(total > 0, 1 + (total >> U(16)) % U(FULL - 1), 0).reshape(n, self.subsets)
            out[tier, far] = FULL
        return whole, out.transpose(1, 0, 2)


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    some = (a[1] > 0) | (b[1] > 0)
    same = ((a[1] == b[1]) & some & (a[1] < FULL)).sum(2)
    some = some.sum(2)
    use = some <= 0.75 * a[1].shape[2]
    use[:, -1] |= ~use.any(1)
    share = (same * use).sum(1) / np.maximum((some * use).sum(1), 1)
    return np.where(a[0] == b[0], 1.0, share)


def as_text(whole: np.ndarray, parts: np.ndarray) -> list[str]:
    raw = parts.astype(">u2").tobytes().hex()
    size = parts[0].size * 4 if len(parts) else 0
    return [f"{int(w):016x}:{raw[i * size : (i + 1) * size]}" for i, w in enumerate(whole)]


def _packed(texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64), raw


def places(ids: np.ndarray, codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many of the bounds (rows of id and code, ascending) are below each pair."""
    place = np.searchsorted(bounds[:, 0], ids)
    cut = np.unique(bounds[:, 0])
    for b in cut[np.isin(cut, ids)]:
        here = np.flatnonzero(ids == b)
        i, j = np.searchsorted(bounds[:, 0], b), np.searchsorted(bounds[:, 0], b, "right")
        place[here] = i + np.searchsorted(bounds[i:j, 1], codes[here])
    return place


def rough_bounds(cuts: list[int]) -> np.ndarray:
    """Pairs of id and code that cut at the given ids; an id that is given ``m`` times is cut into ``m`` spans of codes."""
    ids, m = np.unique(np.array(cuts, np.int64), return_counts=True)
    rows = [(int(c), -(1 << 63) + ((j + 1) << 64) // int(n) - 1) for c, n in zip(ids, m, strict=True) for j in range(n)]
    return np.array(rows, np.int64).reshape(-1, 2)


def in_order(docs: DataFrame) -> tuple[DataFrame, int]:
    """Texts dealt to contiguous ranges of ids, each in descending order, followed by the document after the range.

    Rows are ordered by id, rows of one id by the hash of their text, so that an id of very many rows is cut as
    well. The greatest pair of each range is counted exactly; its row is copied to the range above as a guest
    (``guest`` = 1). After the smallest id comes the largest.
    """
    parts = parts_for(text_bytes(docs), PART_BYTES)
    low = -(1 << 63)
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(low)).alias("doc_id"), text_or_empty().alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("code"), "text")
    cuts = [i / parts for i in range(1, parts)]
    rough = rough_bounds(rows.agg(F.percentile_approx("doc_id", cuts, 100 * parts)).first()[0] or [])

    def greatest(batches):
        for batch in batches:
            key, code = (batch.column(k).to_numpy() for k in range(2))
            place = places(key, code, rough)
            order = np.lexsort((code, key, place))
            last = order[np.append(place[order][1:] != place[order][:-1], True)] if len(order) else order
            yield pa.RecordBatch.from_arrays([pa.array(x[last], pa.int64()) for x in (place, key, code)], names=["place", "doc_id", "code"])

    ends = rows.select("doc_id", "code").mapInArrow(greatest, "place long, doc_id long, code long").groupBy("place").agg(F.max(F.struct("doc_id", "code")).alias("end"))
    bounds = np.array(sorted(tuple(r["end"]) for r in ends.collect()), np.int64).reshape(-1, 2)
    top, bounds = bounds[-1:], bounds[:-1]

    def run(batches):
        for batch in batches:
            key, code = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            own = places(key, code, bounds)
            end = np.flatnonzero(own < len(bounds))
            end = end[(bounds[own[end], 0] == key[end]) & (bounds[own[end], 1] == code[end])]
            # of rows that are equal in id and text one guest will do
            end = end[np.unique(own[end], return_index=True)[1]]
            last = np.flatnonzero((key == top[0, 0]) & (code == top[0, 1]))[:1]
            place = np.concatenate([own, own[end] + 1, np.zeros(len(last), np.int64)])
            take = np.concatenate([np.arange(len(key)), end, last])
            guest = np.repeat([0, 1, 1], [len(key), len(end), len(last)])
            yield pa.RecordBatch.from_arrays([pa.array(place.astype(np.int32)), pa.array(guest.astype(np.int32)), *[c.take(pa.array(take)) for c in batch.columns]], names=["place", "guest", "doc_id", "code", "text"])

    rows = rows.mapInArrow(run, "place int, guest int, doc_id long, code long, text string").repartitionById(len(bounds) + 1, "place")
    return rows.sortWithinPartitions("guest", F.col("doc_id").desc(), F.col("code").desc(), "text").drop("code"), low


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def fingerprints(docs: DataFrame, *, low: float = LOW, high: float = HIGH) -> DataFrame:
    """Fingerprints of every text and of its edited form, and their likeness."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon(docs, low, high))
    rows, null = in_order(docs)

    def run(batches):
        make = Fingerprints(shared.value)
        held_keys, held_texts, size = [], [], 0

        def flush(keys, texts):
            """All but the last text, which is only the next one of the last but one."""
            own = make.hashes(*_packed(texts)[:2])
            edited = [t[: len(t) - len(t) // 3] + after[: len(t) // 3] for t, after in zip(texts[:-1], texts[1:], strict=True)]
            data, offsets, raw = _packed(edited)
            new = make.hashes(data, offsets)
            mine, after = (own[0][:-1], own[1][:-1]), (own[0][1:], own[1][1:])
            ids = np.array(keys[:-1], np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64(), mask=ids == null), pa.array([len(t) for t in texts[:-1]], pa.int64()), pa.array([hashlib.sha256(r).hexdigest() for r in raw]), pa.array(as_text(*mine)), pa.array(as_text(*new)), pa.array(likeness(mine, new)), pa.array(likeness(mine, after))],
                names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )

        done = False
        for batch in batches:
            for guest, key, text in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3)), strict=True):
                if done:
                    continue
                held_keys.append(key), held_texts.append(text)
                size += len(text)
                done = guest == 1
                if (size >= _CHUNK or done) and len(held_keys) > 1:
                    yield flush(held_keys, held_texts)
                    held_keys, held_texts, size = held_keys[-1:], held_texts[-1:], len(held_texts[-1])

    return rows.mapInArrow(run, SCHEMA)
