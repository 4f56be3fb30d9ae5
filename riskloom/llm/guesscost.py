"""Secret scan: fixed patterns, and values in a credential context whose guess cost is high.

The guess cost of a value is the cheapest way to write it as words, dates, repeats, keyboard walks and
brute-force characters, in decimal logarithms of guesses, found by dynamic programming over the end of
the value. A value that no cheap reading explains is reported as a span of kind ``guess``. Words are the
frequent words of passwords, words that occur twice in the same text, and the words of the corpus, ranked by
the number of documents that hold them. Values in a credential context are nobody's words: they count neither
towards their text's words nor towards the corpus, and a word of one text alone, however often it is copied, is
none of the corpus. So a secret is found however often it is repeated or copied.

Defined results: null counts as an empty text, which has no spans; an empty table gives an empty result; very long
texts are scanned whole in time linear in their length; equal rows give equal results; a span
of the fixed patterns always stays, and an added span may overlap one but is never wholly inside it; other
columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Collection, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import slices
from riskloom.llm.spans import SECRET_KINDS, digest, joined, ordered, secrets
from riskloom.session import checkpointed

# fixed values: frequent words of passwords, most frequent first
WORDS = """password admin welcome login letmein monkey dragon master secret football baseball shadow sunshine princess
iloveyou trustno superman batman hello freedom whatever hunter summer winter spring autumn test user guest root pass
changeme default example sample token key value none null true false string your here the love""".split()
KEY_ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./", "abcdefghijklmnopqrstuvwxyz", "0123456789")
KINDS = (*SECRET_KINDS, "guess")
MIN_COST, MIN_LENGTH = 10.0, 8
LONGEST_WORD = 32
# a corpus word holds this share of all pairs of document and word (so there are at most 500,000) and is in this many documents
WORD_SHARE, WORD_DOCS = 2e-6, 3
_COUNTED = 1_000_000
_LETTERS = re.compile(r"[^\W\d_]{3,}")

_CONTEXT = re.compile(
    r"""(?<![A-Za-z])(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|api[_-]?key|(?:access|private|auth)[_-]?key|credentials?|authorization|bearer|login|pin)"""
    r"""["']?[\x20\t]*(?:[:=]|:=|=>|->|\x20is\x20)[\x20\t]*(?:bearer\x20+|basic\x20+)?["']?([^\s"'<>]+)""",
    re.ASCII | re.IGNORECASE,
)
_HINTS = ("pass", "pwd", "secret", "token", "key", "credential", "authorization", "bearer", "login", "pin")
_RANK = {w: i + 1 for i, w in enumerate(WORDS)}
_NEXT = {(a, b) for row in KEY_ROWS for a, b in (*zip(row, row[1:], strict=False), *zip(row[1:], row, strict=False))}
_DATE = re.compile(r"(?:19|20)\d\d(?:[-/.]?(?:0[1-9]|1[0-2])(?:[-/.]?(?:0[1-9]|[12]\d|3[01]))?)?|(?:0[1-9]|[12]\d|3[01])[-/.]?(?:0[1-9]|1[0-2])(?:[-/.]?(?:19|20)?\d\d)?")


def char_cost(c: str) -> float:
    return math.log10(10 if c.isdigit() else 26 if c.isalpha() and c.isascii() else 33 if c.isascii() else 100)


def guess_cost(value: str, known: Collection[str] = (), ranks: Mapping[str, int] | None = None) -> float:
    """Decimal logarithm of the guesses of the cheapest segmentation; ``known``: words that are free to look up nearby; ``ranks``: of corpus words."""
    n, low, ranks = len(value), value.lower(), ranks or {}
    lower = low if len(low) == n else "".join(c.lower() if len(c.lower()) == 1 else c for c in value)
    best = [0.0] + [math.inf] * n
    same = {}  # same[u][j]: characters from j on that equal the one u places later
    for unit in range(1, min(8, n // 2) + 1):
        run = [0] * (n + 1)
        for j in range(n - unit - 1, -1, -1):
            run[j] = run[j + 1] + 1 if value[j] == value[j + unit] else 0
        same[unit] = run
    anchor: dict[tuple[int, int], int] = {}  # the last start tried, by unit and place modulo the unit
    for j in range(n):
        here = best[j]
        # a brute-force span grows one character at a time
        best[j + 1] = min(best[j + 1], here + char_cost(value[j]))
        for k in range(j + 3, min(n, j + LONGEST_WORD) + 1):
            part = lower[j:k]
            rank = min(_RANK.get(part, math.inf), ranks.get(part, math.inf), len(_RANK) + len(known) + 1 if part in known else math.inf)
            if rank < math.inf:
                case = 0 if value[j:k] == part else 1
                best[k] = min(best[k], here + math.log10(rank + 1) + case * math.log10(2 * (k - j)))
        if value[j].isdigit():
            for k in range(j + 4, min(n, j + 10) + 1):
                if _DATE.fullmatch(value, j, k):
                    best[k] = min(best[k], here + math.log10(365 * 120 if k - j > 4 else 365))
        k = j + 1
        while k < n and (lower[k - 1], lower[k]) in _NEXT:
            k += 1
            if k - j >= 3:
                best[k] = min(best[k], here + math.log10(47 * 2 * (k - j)))
        for unit in range(1, min(8, (n - j) // 2) + 1):
            if same[unit][j] < unit:
                continue
            # a start inside a run adds nothing where the earlier one gives every later repeat at no more
            first = anchor.get((unit, j % unit))
            if first is not None and same[unit][first] >= j - first and here >= best[first] + math.log10(((j - first) // unit + 2) / 2):
                continue
            anchor[unit, j % unit] = j
            cost = here + sum(map(char_cost, value[j : j + unit]))
            for times in range(2, same[unit][j] // unit + 2):
                k = j + unit * times
                best[k] = min(best[k], cost + math.log10(times))
    return best[n]


def without_values(text: str, low: str) -> str:
    """The lower-case text without the values in credential contexts."""
    if not any(k in low for k in _HINTS):
        return low
    out, last = [], 0
    for m in _CONTEXT.finditer(text):
        out.append(text[last : m.start(1)])
        last = m.end(1)
    return " ".join([*out, text[last:]]).lower() if out else low


def lexicon(docs: DataFrame, *, share: float = WORD_SHARE, least: int = WORD_DOCS) -> dict[str, int]:
    """The rank of every corpus word by the number of documents that hold it, ties by the word.

    Words of a single text and its copies are left out: beside the count travel the least and the greatest
    hash of the texts that hold a word.
    """

    def run(batches):
        words: list[str] = []
        counts: list[int] = []
        hashes: list[int] = []

        def out():
            column = pa.array(np.repeat(np.array(hashes, np.int64), counts))
            table = pa.table({"word": pa.array(words, pa.string()), "h": column}).group_by("word").aggregate([("h", "count"), ("h", "min"), ("h", "max")])
            yield from table.select(["word", "h_count", "h_min", "h_max"]).rename_columns(["word", "n", "low", "high"]).combine_chunks().to_batches()

        for batch in (part for whole in batches for part in slices(whole)):
            for text, h in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = {w for w in _LETTERS.findall(without_values(text, text.lower())) if len(w) <= LONGEST_WORD}
                words.extend(own)
                counts.append(len(own))
                hashes.append(h)
            if len(words) > _COUNTED:
                yield from out()
                words, counts, hashes = [], [], []
        if words:
            yield from out()

    text = F.coalesce("text", F.lit(""))
    counts = docs.select(text.alias("text"), F.xxhash64(text).alias("h")).mapInArrow(run, "word string, n long, low long, high long")
    counts = checkpointed(counts.groupBy("word").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")))
    total = counts.agg(F.sum("n")).first()[0] or 0
    rows = counts.where((F.col("n") >= max(float(least), share * total)) & (F.col("low") < F.col("high"))).select("word", "n").toArrow()
    order = sorted(zip(rows.column("n").to_pylist(), rows.column("word").to_pylist(), strict=True), key=lambda x: (-x[0], x[1]))
    return {w: i + 1 for i, (_, w) in enumerate(order)}


def find(text: str, min_cost: float = MIN_COST, ranks: Mapping[str, int] | None = None) -> tuple[list, list, float]:
    """Fixed spans, added spans and the highest guess cost of any value in a credential context."""
    base, added, top = secrets(text), [], 0.0
    low = text.lower()
    if any(k in low for k in _HINTS):
        known = None
        for m in _CONTEXT.finditer(text):
            value = m[1].rstrip(".,;:!?)]}")
            if len(value) < MIN_LENGTH:
                continue
            if known is None:
                seen: set[str] = set()
                known = set()
                for w in _LETTERS.findall(without_values(text, low)):
                    (known if w in seen else seen).add(w)
            cost = guess_cost(value, known, ranks)
            top = max(top, cost)
            a, b = m.start(1), m.start(1) + len(value)
            if cost >= min_cost and not any(s <= a and b <= e for _, s, e in base):
                added.append(("guess", a, b))
    return base, added, top


SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_guess long, top_cost double"
_ARROW = pa.schema([("doc_id", pa.int64()), *[(c, pa.int64()) for c in ("n_assign", "n_access", "n_hex")], ("base_sha256", pa.string()), ("spans", pa.string()), ("n_guess", pa.int64()), ("top_cost", pa.float64())])


def scan_secrets(docs: DataFrame, *, min_cost: float = MIN_COST) -> DataFrame:
    """One row per document with the counts and spans of its secrets."""
    words = docs.sparkSession.sparkContext.broadcast(lexicon(docs))

    def run(batches):
        ranks = words.value
        for batch in (part for whole in batches for part in slices(whole)):
            rows = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                base, added, top = find(text, min_cost, ranks)
                n = [sum(s[0] == k for s in base) for k in SECRET_KINDS]
                rows.append((key, *n, digest(base), joined(ordered([*base, *added], KINDS)), len(added), top))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ARROW, strict=True)] if rows else [pa.array([], f.type) for f in _ARROW], schema=_ARROW)

    return docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, SCHEMA)
