"""Range asymmetric numeral systems with one static table, in interleaved lanes, on numpy arrays.

A block of ids is spread over ``lanes`` states in turn; the states share one stream of 32-bit words. The
block keeps the states and the place in the stream at regular steps (checkpoints), so that its parts can
be decoded on their own, and a checksum of all its bytes.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

U = np.uint64
SCALE, LOW, LANES, STEPS = 20, 1 << 31, 1024, 128
_HEAD = struct.Struct("<4sBxHIIII")
_MAGIC = b"RANS"


def frequencies(counts: np.ndarray) -> np.ndarray:
    """Counts scaled to a sum of 2^SCALE; what occurs keeps at least 1."""
    counts = np.asarray(counts, np.float64)
    used = np.flatnonzero(counts)
    if len(used) > 1 << SCALE:
        raise ValueError(f"{len(used)} symbols do not fit a table of 2^{SCALE}")
    out = np.zeros(len(counts), np.int64)
    if not len(used):
        return out
    out[used] = np.maximum(1, np.floor(counts[used] * (1 << SCALE) / counts.sum())).astype(np.int64)
    left = (1 << SCALE) - int(out.sum())
    order = used[np.argsort(-counts[used], kind="stable")]
    if left > 0:
        out[order[0]] += left
    for i in order:
        if left >= 0:
            break
        cut = min(int(out[i]) - 1, -left)
        out[i] -= cut
        left += cut
    return out


class Table:
    """Frequencies, their running sums and the symbol of every slot."""

    def __init__(self, freq: np.ndarray):
        self.freq = np.asarray(freq, np.uint32)
        self.start = (np.cumsum(freq) - freq).astype(np.uint32)
        self.slot = np.repeat(np.arange(len(freq), dtype=np.uint32), freq)
        self.code = zlib.crc32(np.asarray(freq, "<u4").tobytes())


def encode(ids: np.ndarray, table: Table, lanes: int = LANES, every: int = STEPS) -> bytes:
    n = len(ids)
    while lanes > 1 and n < 64 * lanes:
        lanes //= 2
    steps = -(-n // lanes)
    state = np.full(lanes, LOW, U)
    f, c = table.freq[ids].astype(U), table.start[ids].astype(U)
    if n and not f.all():
        raise ValueError("an id is missing from the table")
    words, marks, written = [], [], 0
    for step in range(steps - 1, -1, -1):
        a, b = step * lanes, min(n, (step + 1) * lanes)
        x, freq = state[: b - a], f[a:b]
        full = x >= freq << U(63 - SCALE)
        if full.any():
            out = (x[full] & U(0xFFFFFFFF)).astype(np.uint32)
            words.append(out[::-1])
            written += len(out)
            x = np.where(full, x >> U(32), x)
        q = x // freq
        state[: b - a] = (q << U(SCALE)) + (x - q * freq) + c[a:b]
        if step % every == 0:
            marks.append((written, state.copy()))
    stream = np.concatenate(words)[::-1] if words else np.zeros(0, np.uint32)
    body = b"".join(struct.pack("<I", written - at) + s.astype("<u8").tobytes() for at, s in reversed(marks))
    head = _HEAD.pack(_MAGIC, 1, lanes, n, every, len(marks), table.code)
    raw = head + body + stream.astype("<u4").tobytes()
    return raw + struct.pack("<I", zlib.crc32(raw))


def decode(raw: bytes, table: Table, first_mark: int = 0, last_mark: int | None = None) -> np.ndarray:
    """The ids of a block, or only those from one checkpoint to before another."""
    if zlib.crc32(raw[:-4]) != struct.unpack("<I", raw[-4:])[0]:
        raise ValueError("checksum of a block differs")
    magic, version, lanes, n, every, marks, code = _HEAD.unpack_from(raw)
    if magic != _MAGIC or version != 1 or code != table.code:
        raise ValueError("not a block of this table")
    size = 4 + 8 * lanes
    base = _HEAD.size + marks * size
    stream = np.frombuffer(raw, "<u4", (len(raw) - 4 - base) // 4, base)
    last = marks if last_mark is None else min(last_mark, marks)
    if first_mark >= last:
        return np.zeros(0, np.uint32)
    at = struct.unpack_from("<I", raw, _HEAD.size + first_mark * size)[0]
    state = np.frombuffer(raw, "<u8", lanes, _HEAD.size + first_mark * size + 4).astype(U)
    begin, end = first_mark * every * lanes, min(n, last * every * lanes)
    out = np.empty(end - begin, np.uint32)
    for a in range(begin, end, lanes):
        b = min(n, a + lanes)
        x = state[: b - a]
        slot = x & U((1 << SCALE) - 1)
        ids = table.slot[slot]
        out[a - begin : b - begin] = ids
        x = table.freq[ids] * (x >> U(SCALE)) + slot - table.start[ids]
        low = np.flatnonzero(x < U(LOW))
        if len(low):
            x[low] = (x[low] << U(32)) | stream[at : at + len(low)]
            at += len(low)
        state[: b - a] = x
    return out
