"""Token ids of documents in a block file coded with one shared frequency table.

Texts are range-partitioned by id and tokenised once; the ids are kept as compressed blocks of whole
documents. From them come the shared table (one row per vocabulary entry) and the number of ids per
partition, whose running sum gives every block its place beside the ids that its own partition holds before
it. Blocks are then coded independently and written as one Parquet table (columns ``BLOCK_COLUMNS``) beside
the table of frequencies; readers may take any blocks in any order.

Parts between ASCII white space (and at stops after letters) are tokenised once per worker and reused: the
tokenizer's own pre-tokenisation never joins characters across these places, so a text's ids are its parts'
ids in order.

Defined results: null counts as an empty text, which has only the end id; rows that repeat an id follow
each other in the file, by a hash of their text; a null id comes first; an empty table gives an empty file; other columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import rans
from riskloom.llm.common import parts_for, pieces, strings, text_bytes, text_or_empty
from riskloom.llm.hashing import word_bounds, word_hashes
from riskloom.session import checkpointed, shared_folder

PART_BYTES, BLOCK_IDS, END = 32 << 20, 1 << 18, 2
_CHUNK, _CACHE, _BATCH = 2 << 20, 2_000_000, 1000
BLOCK_COLUMNS = "part int, block int, first long, n_ids long, doc_ids binary, lengths binary, payload binary"


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_STOP = np.zeros(256, bool)
_STOP[list(b".,;:!?")] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def segments(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the parts of all texts that are tokenised on their own, and each text's first part.

    Parts end at ASCII white space, and where a letter is followed by one of ``.,;:!?``: the tokenizer's
    pattern always ends a match there. Letters are ASCII ones and U+00C0 to U+00FF.
    """
    n, full = len(data), ~_SPACE[data]
    letter = _LETTER[data]
    letter[1:] |= (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] < 0xC0) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    begin, last = np.zeros(n, bool), np.zeros(n, bool)
    begin[1:] = ~full[:-1] | (_STOP[data[1:]] & letter[:-1])
    some = offsets[1:] > offsets[:-1]
    begin[offsets[:-1][some]] = True
    last[:-1] = ~full[1:] | begin[1:]
    last[-1:] = True
    start = np.flatnonzero(full & begin)
    return start, np.flatnonzero(full & last) + 1, np.searchsorted(start, offsets)


# fixed values: how the vocabulary marks the last id of a word; letters that its pattern never parts
WORD_END = "</w>"
LETTERS = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")


class Words:
    """Ids of parts of texts, each tokenised once per worker and found again by a 64-bit hash; starts anew beyond a bound."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        # tasks are the unit of parallel work here
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab(with_added_tokens=False)
        self.last = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
        self.last[[i for t, i in vocab.items() if t.endswith(WORD_END)]] = True
        self.clear()

    def clear(self) -> None:
        self.codes, self.slots = np.zeros(1 << 17, np.uint64), np.full(1 << 17, -1, np.int32)  # open addressing, at most half full
        self.count, self.used = 0, 0
        self.start, self.size = np.zeros(1 << 16, np.int32), np.zeros(1 << 16, np.int32)
        self.ids = np.zeros(1 << 18, np.uint32)

    def find(self, codes: np.ndarray) -> np.ndarray:
        """Slots of all codes, -1 for new ones."""
        mask = np.uint64(len(self.codes) - 1)
        at = (codes & mask).astype(np.int64)
        out = self.slots[at]
        left = np.flatnonzero((out >= 0) & (self.codes[at] != codes))
        at = at[left]
        while len(left):
            at = (at + 1) & int(mask)
            slot = self.slots[at]
            out[left] = slot
            more = (slot >= 0) & (self.codes[at] != codes[left])
            left, at = left[more], at[more]
        return out

    def place(self, codes: np.ndarray, slots: np.ndarray) -> None:
        """Enter distinct new codes: whoever is first at a free place keeps it, the others go on."""
        mask = len(self.codes) - 1
        at = (codes & np.uint64(mask)).astype(np.int64)
        while len(codes):
            free = self.slots[at] < 0
            _, first = np.unique(at[free], return_index=True)
            won = np.flatnonzero(free)[first]
            self.codes[at[won]], self.slots[at[won]] = codes[won], slots[won]
            keep = np.ones(len(codes), bool)
            keep[won] = False
            codes, slots, at = codes[keep], slots[keep], (at[keep] + 1) & mask

    def tokenised(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each part, and all ids."""
        if all(map(LETTERS.fullmatch, parts)):
            # parts of letters alone have one word end each, which tells them apart in one text
            ids = np.array(self.tokenizer.encode(" ".join(parts), add_special_tokens=False).ids, np.uint32)
            ends = np.flatnonzero(self.last[ids])
            if len(ends) == len(parts):
                return np.diff(ends, prepend=-1).astype(np.int32), ids
        got = [e.ids for e in self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)]
        n = np.array([len(x) for x in got], np.int32)
        return n, np.fromiter((k for x in got for k in x), np.uint32, int(n.sum()))

    def add(self, codes: np.ndarray, parts: list[str]) -> None:
        slots = np.arange(self.count, self.count + len(parts), dtype=np.int32)
        while self.count + len(parts) > len(self.start):
            self.start, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.size))
        for i in range(0, len(parts), 2000):
            n, flat = self.tokenised(parts[i : i + 2000])
            while self.used + len(flat) > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
            a = self.count + i
            self.start[a : a + len(n)] = self.used + np.cumsum(n) - n
            self.size[a : a + len(n)] = n
            self.ids[self.used : self.used + len(flat)] = flat
            self.used += len(flat)
        self.count += len(parts)
        if 2 * self.count > len(self.codes):
            full = self.slots >= 0
            old = self.codes[full], self.slots[full]
            size = len(self.codes)
            while 2 * self.count > size:
                size *= 2
            self.codes, self.slots = np.zeros(size, np.uint64), np.full(size, -1, np.int32)
            self.place(*old)
        self.place(codes, slots)

    def encode(self, data: np.ndarray, offsets: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, each with the end id, and the number per text."""
        if self.count > _CACHE:
            self.clear()
        start, stop, at = segments(data, offsets)
        raw = data.tobytes()
        if b"<|" not in raw:
            # the tokenizer lowers letters; in texts that may hold its special tokens their case matters
            data = _LOWER[data]
            raw = data.tobytes()
        else:
            start, stop, at = word_bounds(data, offsets)
        codes = word_hashes(data, start, stop)
        slot = self.find(codes)
        miss = np.flatnonzero(slot < 0)
        if len(miss):
            new, first = np.unique(codes[miss], return_index=True)
            first = miss[first]
            parts = [raw[a:b].decode() for a, b in zip(start[first].tolist(), stop[first].tolist(), strict=True)]
            plain = np.array([LETTERS.fullmatch(x) is not None for x in parts])
            for some in (plain, ~plain):
                if some.any():
                    self.add(new[some], [parts[k] for k in np.flatnonzero(some)])
            slot[miss] = self.find(codes[miss])
        n = self.size[slot]
        upto = np.zeros(len(n) + 1, np.int64)
        np.cumsum(n, out=upto[1:])
        flat = self.ids[np.repeat(self.start[slot] - upto[:-1], n) + np.arange(upto[-1])]
        per_text = upto[at[1:]] - upto[at[:-1]]
        out = np.full(len(flat) + len(per_text), end, np.uint32)
        out[np.arange(len(flat)) + np.repeat(np.arange(len(per_text)), per_text)] = flat
        return out, per_text + 1


_words: dict[str, Words] = {}


def _tokenise(path: str, end: int):
    def run(batches):
        words = _words.setdefault(path, None) or Words(path)
        _words[path] = words
        part, block, done, press = TaskContext.get().partitionId(), 0, 0, zstandard.ZstdCompressor(1)
        held: list = []

        def row():
            nonlocal block, done, held
            keys, sizes, ids = (np.concatenate(x) for x in zip(*held, strict=True))
            held = []
            raw = pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "block": pa.array([block], pa.int32()), "before": pa.array([done], pa.int64()), "n_ids": pa.array([len(ids)], pa.int64()), "doc_ids": [keys.tobytes()], "lengths": [sizes.astype(np.int64).tobytes()], "ids": [press.compress(ids.astype(np.uint16 if ids.max() < 1 << 16 else np.uint32).tobytes())], "wide": [bool(ids.max() >= 1 << 16)]})
            block, done = block + 1, done + len(ids)
            return raw

        for batch in batches:
            keys = batch.column(0).fill_null(np.iinfo(np.int64).min).to_numpy()
            data, offsets = strings(batch.column(1))
            for i, j in pieces(offsets, _CHUNK):
                ids, sizes = words.encode(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], end)
                upto, a = np.cumsum(sizes), 0
                while a < j - i:
                    room = BLOCK_IDS - sum(len(x[2]) for x in held)
                    b = max(a + (not held), int(np.searchsorted(upto, (upto[a - 1] if a else 0) + room, "right")))
                    if b > a:
                        lo = upto[a - 1] if a else 0
                        held.append((keys[i + a : i + b], sizes[a:b], ids[lo : upto[b - 1]]))
                        a = b
                    if a < j - i or sum(len(x[2]) for x in held) >= BLOCK_IDS:
                        yield row()
        if held:
            yield row()

    return run


def _ids(batch: pa.RecordBatch, i: int) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(batch.column("ids")[i].as_py())
    return np.frombuffer(raw, np.uint32 if batch.column("wide")[i].as_py() else np.uint16)


def _histogram(batches):
    total = np.zeros(0, np.int64)
    for batch in batches:
        for i in range(batch.num_rows):
            n = np.bincount(_ids(batch, i), minlength=len(total))
            n[: len(total)] += total
            total = n
    here = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(here, pa.int64()), pa.array(total[here], pa.int64())], names=["id", "n"])


def write(docs: DataFrame, tokenizer: str, folder: str, *, end: int = END) -> None:
    """Tokenise all texts and write the file: ``folder/table`` and ``folder/blocks``."""
    spark = docs.sparkSession
    parts = parts_for(text_bytes(docs), PART_BYTES)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).withColumn("code", F.xxhash64("text"))
    # an id of very many rows is cut by the hash of its texts
    rows = rows.repartitionByRange(parts, "doc_id", "code").sortWithinPartitions("doc_id", "code", "text").drop("code")
    kept = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(kept)
    try:
        # texts go to the workers in smaller batches than by default
        spark.conf.set(kept, min(_BATCH, int(before)) if int(before) > 0 else _BATCH)
        tokens = checkpointed(rows.mapInArrow(_tokenise(tokenizer, end), "part int, block int, before long, n_ids long, doc_ids binary, lengths binary, ids binary, wide boolean"))
    finally:
        spark.conf.set(kept, before)
    # one row per vocabulary entry, one per partition
    counts = tokens.select("ids", "wide").mapInArrow(_histogram, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).orderBy("id").toPandas()
    sizes = {r["part"]: r["n"] for r in tokens.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()}
    begin, at = {}, 0
    for part in sorted(sizes):
        begin[part], at = at, at + sizes[part]
    freq = np.zeros(int(counts["id"].max()) + 1 if len(counts) else 1, np.int64)
    freq[counts["id"].to_numpy(np.int64)] = rans.frequencies(counts["n"].to_numpy())
    shared = spark.sparkContext.broadcast((freq, begin))

    def code(batches):
        freq, begin = shared.value
        table = rans.Table(freq)
        for batch in batches:
            for i in range(batch.num_rows):
                part = batch.column("part")[i].as_py()
                payload = rans.encode(_ids(batch, i).astype(np.int64), table)
                yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "block": batch.column("block").slice(i, 1), "first": pa.array([begin[part] + batch.column("before")[i].as_py()], pa.int64()), "n_ids": batch.column("n_ids").slice(i, 1), "doc_ids": batch.column("doc_ids").slice(i, 1), "lengths": batch.column("lengths").slice(i, 1), "payload": [payload]})

    spark.createDataFrame([(int(i), int(freq[i])) for i in np.flatnonzero(freq)], "id long, frequency long").coalesce(1).write.parquet(f"{folder}/table")
    # one narrow pass over the kept partitions, so the files follow each other in the order of the ids
    tokens.mapInArrow(code, BLOCK_COLUMNS).write.parquet(f"{folder}/blocks")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Decode the file: doc_id, start, n_tokens and ids_crc32 of every document."""
    rows = spark.read.parquet(f"{folder}/table").toPandas()
    freq = np.zeros(int(rows["id"].max()) + 1 if len(rows) else 1, np.int64)
    freq[rows["id"].to_numpy(np.int64)] = rows["frequency"].to_numpy(np.int64)
    shared = spark.sparkContext.broadcast(freq)

    def run(batches):
        table = rans.Table(shared.value)
        for batch in batches:
            for i in range(batch.num_rows):
                ids = rans.decode(batch.column("payload")[i].as_py(), table).astype("<u4")
                keys, sizes = (np.frombuffer(batch.column(c)[i].as_py(), np.int64) for c in ("doc_ids", "lengths"))
                to = np.concatenate([[0], np.cumsum(sizes)])
                crc = [zlib.crc32(ids[a:b].data) for a, b in zip(to[:-1], to[1:], strict=True)]
                null = keys == np.iinfo(np.int64).min
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64(), mask=null), pa.array(batch.column("first")[i].as_py() + to[:-1], pa.int64()), pa.array(sizes, pa.int64()), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return spark.read.parquet(f"{folder}/blocks").select("first", "doc_ids", "lengths", "payload").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, tokenizer: str, *, end: int = END) -> DataFrame:
    """Write the documents' file into the shared folder and read it back."""
    folder = shared_folder(docs.sparkSession)
    write(docs, tokenizer, folder, end=end)
    return read(docs.sparkSession, folder)
