"""Information-theoretic sanitisation of personal data.

The fixed patterns find protected entities (e-mail addresses, IP addresses, card and phone numbers).
Terms in the same document reveal an entity to the degree in which the corpus ties both together: with
document frequencies ``f`` over ``N`` documents, the pointwise mutual information of term and entity is
``log2(P(e | t) / P(e))`` and the information of the entity is ``log2(1 / P(e))``, where ``P(e)`` is
``f(e) / N``. ``P(e | t)`` is smoothed towards ``P(e)`` by ``prior`` documents,
``(f(t, e) + prior P(e)) / (f(t) + prior)``: a rare entity is revealed by the terms of its one document, a
frequent one takes more documents in agreement. Where a term gives away at least ``threshold`` of the
entity's information, all its occurrences in documents of that entity are spans of kind ``term``: they are
generalised, or removed if generalising leaves the same text.

A term is a run of characters other than white space and fixed spans, in lower case and without
punctuation at its ends, that has a letter or a digit.

Defined results: null counts as an empty text, which has no spans; equal rows give equal results; spans of
the fixed patterns stay and added ones never overlap them; in a corpus of fewer documents than
``(1 + prior) ** (1 / (1 - threshold))`` (58) an entity of one document gets no terms; other columns are
ignored.

Entities and terms travel as 64-bit hashes, entities of the same documents as one. Counts are summed before they are shuffled, so that an entity
or a term in a third of all documents is one partial sum per task.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.common import BROADCAST_ROWS, pieces, slices, small, strings, text_or_empty
from riskloom.llm.hashing import distinct, word_bounds, word_hashes
from riskloom.llm.spans import PII_KINDS, digest, joined, personal
from riskloom.session import checkpointed

THRESHOLD, PRIOR = 0.9, 0.5
_CHUNK = 1 << 20
KINDS = (*PII_KINDS, "term")
_WORD = re.compile(r"[^ \t\n\x0b\x0c\r]+")
_EDGE = ".,;:!?\"'()[]{}<>"
_EDGE_MAP = np.zeros(256, bool)
_EDGE_MAP[[ord(c) for c in _EDGE]] = True


def hash_of(values: list[str]) -> np.ndarray:
    """64-bit hashes of short strings, the same as those of the corpus words."""
    data, offsets = strings(pa.array(values, pa.string()))
    return word_hashes(data, offsets[:-1], offsets[1:]).view(np.int64)


def trimmed(text: str, a: int, b: int) -> tuple[int, int]:
    while a < b and text[a] in _EDGE:
        a += 1
    while a < b and text[b - 1] in _EDGE:
        b -= 1
    return a, b


def terms_of(text: str, spans: list) -> dict[str, list[tuple[int, int]]]:
    """The places of every term outside the fixed spans."""
    parts, free = [], 0
    for _, a, b in spans:
        parts += [text[free:a], " " * (b - max(a, free))]
        free = max(free, b)
    out: dict[str, list[tuple[int, int]]] = {}
    for m in _WORD.finditer("".join(parts) + text[free:]):
        a, b = trimmed(text, m.start(), m.end())
        if any(map(str.isalnum, text[a:b])):
            out.setdefault(text[a:b].lower(), []).append((a, b))
    return out


_TERMS = pa.list_(pa.struct([("term", pa.int64()), ("places", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])))]))
_BASE = pa.schema([("doc_id", pa.int64()), ("digest", pa.int64()), ("n_email", pa.int64()), ("n_ip", pa.int64()), ("n_card", pa.int64()), ("n_phone", pa.int64()), ("base_sha256", pa.string()), ("base", pa.string()), ("terms", _TERMS), ("entities", pa.list_(pa.int64()))])
_BASE_SQL = "doc_id long, digest long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, base string, terms array<struct<term:long,places:array<struct<start:int,stop:int>>>>, entities array<long>"


def scan_base(docs: DataFrame) -> DataFrame:
    """Fixed spans of every document, its entities, and the terms of documents with entities with their places."""

    def run(batches):
        for batch in (part for whole in batches for part in slices(whole)):
            rows = []
            for key, code, text in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                spans = personal(text)
                terms, entities = [], []
                if spans:
                    entities = sorted(set(hash_of([f"{k}:{text[a:b].lower()}" for k, a, b in spans]).tolist()))
                    found = terms_of(text, spans)
                    terms = [{"term": t, "places": [{"start": a, "stop": b} for a, b in at]} for t, at in zip(hash_of(list(found)).tolist() if found else [], found.values(), strict=True)]
                n = [sum(s[0] == k for s in spans) for k in PII_KINDS]
                rows.append((key, code, *n, digest(spans), joined(spans), terms, entities))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _BASE, strict=True)] if rows else [pa.array([], f.type) for f in _BASE], schema=_BASE)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_or_empty()).alias("digest"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, _BASE_SQL)


def trimmed_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words without punctuation at their ends, and each text's first place among them."""
    start, end, _ = word_bounds(data, offsets)
    here, edge = np.arange(len(data)), _EDGE_MAP[data]
    first = np.minimum.accumulate(np.where(edge, len(data), here)[::-1])[::-1][start]
    stop = np.maximum.accumulate(np.where(edge, -1, here))[end - 1] + 1
    some = first < np.minimum(stop, end)
    start, end = first[some], stop[some]
    return word_hashes(data, start, end), np.searchsorted(start, offsets)


def term_frequency(docs: DataFrame) -> DataFrame:
    """In how many documents each word (lower case, without punctuation at its ends) occurs, by its hash."""

    def run(batches):
        for batch in batches:
            data, offsets = strings(batch.column(0))
            parts = []
            for i, j in pieces(offsets, _CHUNK):
                words, at = trimmed_words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                parts.append(distinct(words, at)[0])
            terms, n = np.unique(np.concatenate(parts), return_counts=True) if parts else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            yield pa.RecordBatch.from_pydict({"term": pa.array(terms.view(np.int64), pa.int64()), "n": pa.array(n.astype(np.int32), pa.int32())})

    return docs.select(F.lower(text_or_empty()).alias("text")).mapInArrow(run, "term long, n int").groupBy("term").agg(F.sum("n").alias("f_term"))


def entity_classes(base: DataFrame) -> DataFrame:
    """The classes of entities in every document, each with its number of documents.

    Entities that occur in the same documents (the addresses of one list, for instance) are tied to the same terms,
    so they are one class, known by the sums of two hashes of its documents.
    """
    links = base.select("doc_id", "digest", F.explode("entities").alias("entity"))
    marks = [F.sum(F.xxhash64(F.lit(k), "doc_id", "digest").cast("decimal(20,0)")).alias(f"mark{k}") for k in range(2)]
    single = links.groupBy("entity").agg(F.count(F.lit(1)).alias("f_entity"), *marks)
    single = checkpointed(single.select("entity", F.xxhash64("f_entity", "mark0", "mark1").alias("class"), "f_entity"))
    found = links.join(small(single), "entity").groupBy("doc_id", "digest").agg(F.collect_set(F.struct("class", "f_entity")).alias("classes"))
    return found.withColumnsRenamed({"doc_id": "_id", "digest": "_digest"})


def near_terms(base: DataFrame, terms: DataFrame, n_docs: int, threshold: float, prior: float) -> DataFrame:
    """Classes of entities and terms of every document, without the pairs that cannot reach the threshold.

    Term and entity meet in ``f(e)`` documents at most, so a frequent term cannot reveal a rare entity. Only the
    most frequent terms are looked up; any other may be as rare as need be.
    """
    # cut to the most frequent terms before they are fetched: a fetched limit would send as many from every partition
    words = checkpointed(terms.orderBy(F.desc("f_term"), "term").limit(BROADCAST_ROWS)).toPandas().sort_values("term")
    words = base.sparkSession.sparkContext.broadcast((words["term"].to_numpy(np.int64), words["f_term"].to_numpy(np.int64)))

    def pairs(keys, codes, found, classes, most):
        """The pairs of one document in runs of at most ``_CHUNK``, or one class's."""
        names, frequency = words.value
        at = np.minimum(np.searchsorted(names, found), max(len(names) - 1, 0))
        f_term = np.where(names[at] == found, frequency[at], 0) if len(names) else np.zeros(len(found), np.int64)
        order = np.argsort(f_term, kind="stable")
        known = most / n_docs
        bound = (most + prior * known) * (1 + 1e-9) / known ** (1 - threshold) - prior
        n = np.searchsorted(f_term[order], bound, "right")
        for i, j in pieces(np.concatenate([[0], np.cumsum(n)]), _CHUNK):
            count = n[i:j]
            place = order[np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)]
            yield [np.full(len(place), codes), np.repeat(classes[i:j], count), np.repeat(most[i:j], count), place, found[place]], [keys] * len(place)

    def run(batches):
        names = ["digest", "entity", "f_entity", "place", "term"]
        for batch in batches:
            at, to = (np.concatenate([[0], np.cumsum(pc.list_value_length(batch.column(k)).to_numpy())]) for k in (2, 3))
            found, both = batch.column(2).flatten().to_numpy(), batch.column(3).flatten()
            classes, most = (pc.struct_field(both, k).to_numpy(zero_copy_only=False) for k in ("class", "f_entity"))
            held, ids, size = [], [], 0
            for i, (key, code) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                for part, keys in pairs(key, code, found[at[i] : at[i + 1]], classes[to[i] : to[i + 1]], most[to[i] : to[i + 1]]):
                    held.append(part), ids.extend(keys)
                    size += len(keys)
                    if size >= _CHUNK:
                        yield rows(held, ids, names)
                        held, ids, size = [], [], 0
            if size:
                yield rows(held, ids, names)

    def rows(held, ids, names):
        columns = [np.concatenate(x) for x in zip(*held, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *[pa.array(c, pa.int64()) for c in columns]], names=["doc_id", *names])

    some = base.where("size(entities) > 0").select("doc_id", "digest", F.col("terms.term").alias("found"))
    some = some.join(entity_classes(base), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest")))
    return some.select("doc_id", "digest", "found", "classes").mapInArrow(run, "doc_id long, digest long, entity long, f_entity long, place long, term long")


def revealing_terms(near: DataFrame, terms: DataFrame, n_docs: int, threshold: float, prior: float) -> DataFrame:
    """Pairs of a class of entities and a term whose mutual information reaches the threshold."""
    both = near.groupBy("entity", "f_entity", "term").agg(F.count(F.lit(1)).alias("f_both"))
    # a term that stands beside a fixed span is not always a word of its own in the corpus
    pairs = both.join(terms, "term", "left").withColumn("f_term", F.greatest("f_term", "f_both"))
    known = F.col("f_entity") / F.lit(float(n_docs))
    pmi = F.log2((F.col("f_both") + F.lit(prior) * known) / ((F.col("f_term") + F.lit(prior)) * known))
    return pairs.where((known < 1) & (pmi >= F.lit(threshold) * -F.log2(known))).select("entity", "term")


def scan_personal(docs: DataFrame, *, threshold: float = THRESHOLD, prior: float = PRIOR) -> DataFrame:
    """doc_id, digest of the text, counts, base_sha256, base spans and the added spans as start-stop pairs."""
    base = checkpointed(scan_base(docs))
    terms, n_docs = checkpointed(term_frequency(docs)), base.count()
    near = near_terms(base, terms, n_docs, threshold, prior)
    pairs = small(checkpointed(revealing_terms(near, terms, n_docs, threshold, prior)))
    added = near.join(pairs, ["entity", "term"]).groupBy("doc_id", "digest").agg(F.collect_set("place").alias("places"))
    added = added.withColumnsRenamed({"doc_id": "_id", "digest": "_digest"})
    out = base.join(added, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest")), "left")
    spans = F.sort_array(F.flatten(F.transform("places", lambda k: F.col("terms")[k.cast("int")]["places"])))
    return out.select("doc_id", "digest", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "base", spans.alias("added"))


def spans_column(base: str = "base", added: str = "added"):
    """All spans in order of their start, as text."""
    fixed = F.transform(F.filter(F.split(base, ","), lambda x: x != ""), lambda x: F.struct(F.split(x, ":")[1].cast("int").alias("start"), x.alias("span")))
    more = F.transform(F.coalesce(added, F.array().cast("array<struct<start:int,stop:int>>")), lambda x: F.struct(x["start"].alias("start"), F.format_string("term:%d:%d", x["start"], x["stop"]).alias("span")))
    # a stable merge: starts differ, but for fixed spans of several kinds, which are already in order
    both = F.concat(F.transform(fixed, lambda x, i: F.struct(x["start"].alias("start"), i.alias("place"), x["span"].alias("span"))), F.transform(more, lambda x, i: F.struct(x["start"].alias("start"), i.alias("place"), x["span"].alias("span"))))
    return F.array_join(F.transform(F.array_sort(both), lambda x: x["span"]), ",")


def clean_text(text: str, added: list[tuple[int, int]]) -> str:
    """The text with entities replaced by their kind and revealing terms by their first letter, or nothing."""
    spans = [(a, b, f"<{k.upper()}>") for k, a, b in personal(text)]
    spans += [(a, b, "" if b - a <= 1 else text[a] + "_") for a, b in added]
    out, free = [], 0
    for a, b, new in sorted(spans):
        if a >= free:
            out += [text[free:a], new]
            free = b
        elif b > free:
            # an overlap with the span before: its characters go as well
            free = b
    return "".join(out) + text[free:]


def sanitise(docs: DataFrame, **parameters) -> DataFrame:
    """The documents with every text sanitised and the other columns as they are."""
    found = scan_personal(docs, **parameters).where("added is not null").select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"), "added").dropDuplicates(["_id", "_digest"])
    found = small(checkpointed(found))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_or_empty()).alias("digest"))
    rows = rows.join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest")), "left").select("row", "added")

    def run(batches):
        for batch in (part for whole in batches for part in slices(whole)):
            texts = pc.struct_field(batch.column(0), "text").to_pylist()
            new = [None if t is None else clean_text(t, [(x["start"], x["stop"]) for x in a or []]) for t, a in zip(texts, batch.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(new, pa.string())], names=["row", "clean"])

    out = rows.mapInArrow(run, T.StructType([rows.schema["row"], T.StructField("clean", T.StringType())]))
    cols = []
    for c in docs.columns:
        if c == "text":
            cols.append(F.col("clean").alias("text"))
        elif c == "n_chars":
            cols.append(F.when(F.col("row.text").isNull(), F.col("row.n_chars")).otherwise(F.char_length("clean")).cast(docs.schema[c].dataType).alias(c))
        else:
            cols.append(F.col("row")[c].alias(c))
    return out.select(*cols)
