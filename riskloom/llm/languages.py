"""Language identification as a mixture: each document's language proportions by expectation-maximisation.

Training counts byte trigrams of lower-case letters over all labelled training rows and gives one smoothed
distribution per language. A document is cut into words; the likelihood of each word under each language
follows from its trigrams, and expectation-maximisation finds the proportions of the languages. The set
of languages is then chosen by likelihood less a penalty per language (half the logarithm of the number
of words plus a constant), over sets of every size; the proportions fitted on that set give the prediction, its
score and the reported mixture.

Defined results: ``und`` with score 0 for null texts and texts without a letter; an empty table gives an empty
result; very long texts are read whole, in runs of a megabyte of texts; equal texts get equal results; ties go to the language that sorts first; with no labelled row every result is ``und``; other
columns are ignored. The model holds one row per language of the labels, so it is small by nature.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.common import pieces, strings, text_or_empty

BITS = 15
TOLERANCE, MOST_STEPS = 1e-3, 1000
_CHUNK = 1 << 20
_LETTER = np.zeros(256, np.uint8)
_LETTER[97:123] = np.arange(97, 123)
_LETTER[128:] = np.arange(128, 256)


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of the trigram around every letter byte, first gram of every word, first word of every text."""
    x = _LETTER[data]
    before, after = np.zeros_like(x), np.zeros_like(x)
    before[1:], after[:-1] = x[:-1], x[1:]
    some = offsets[1:] > offsets[:-1]
    before[offsets[:-1][some]] = 0
    after[offsets[1:][some] - 1] = 0
    at = np.flatnonzero(x)
    code = (before[at].astype(np.uint32) << 16) | (x[at].astype(np.uint32) << 8) | after[at]
    bucket = (code * np.uint32(2654435761)) >> np.uint32(32 - BITS)
    word = np.flatnonzero(before[at] == 0)
    return bucket.astype(np.int64), word, np.searchsorted(at[word], offsets)


def train(docs: DataFrame, lang: Column) -> tuple[list[str], np.ndarray]:
    """Languages and the logarithm of their trigram distributions, from all given rows."""

    def count(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            data, offsets = strings(batch.column(1))
            names = np.array(batch.column(0).to_pylist(), object)
            for i, j in pieces(offsets, _CHUNK):
                for name in set(names[i:j]):
                    rows = [k for k in range(i, j) if names[k] == name]
                    own = np.concatenate([data[offsets[k] : offsets[k + 1]] for k in rows])
                    to = np.concatenate([[0], np.cumsum([offsets[k + 1] - offsets[k] for k in rows])])
                    total.setdefault(name, np.zeros(1 << BITS, np.int64))
                    total[name] += np.bincount(grams(own, to)[0], minlength=1 << BITS)
        for name, n in total.items():
            here = np.flatnonzero(n)
            yield pa.RecordBatch.from_pydict({"lang": pa.array([name] * len(here), pa.string()), "bucket": pa.array(here, pa.int64()), "n": pa.array(n[here], pa.int64())})

    rows = docs.select(lang.cast("string").alias("lang"), F.lower("text").alias("text")).where("lang is not null and text is not null")
    rows = rows.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    names = sorted(rows["lang"].unique())
    counts = np.zeros((len(names), 1 << BITS))
    counts[rows["lang"].map({x: i for i, x in enumerate(names)}).to_numpy(np.int64), rows["bucket"].to_numpy(np.int64)] = rows["n"].to_numpy(float)
    used = max(1, int((counts.sum(0) > 0).sum()))
    return names, np.log((counts + 0.5) / (counts.sum(1, keepdims=True) + 0.5 * used)).astype(np.float32)


def word_logs(data: np.ndarray, offsets: np.ndarray, model: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log-likelihood of every word under every language, letters per word, first word of every text."""
    bucket, word, at = grams(data, offsets)
    out = np.empty((len(word), len(model)), np.float32)
    for k in range(len(model)):
        out[:, k] = np.add.reduceat(model[k][bucket], word) if len(word) else 0
    return out, np.diff(np.append(word, len(bucket))).astype(np.float32), at


def mixture(logs: np.ndarray, weight: np.ndarray, at: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions of the allowed languages per text, stepped until none changes by ``TOLERANCE``, and the log-likelihood reached."""
    n, text = np.diff(at), np.repeat(np.arange(len(at) - 1), np.diff(at))
    peak = logs.max(1, keepdims=True)
    like = np.exp(logs - peak)
    total = np.add.reduceat(weight, at[:-1])
    share = allowed / allowed.sum(1, keepdims=True)
    going = np.arange(len(n))
    rows, own, first = np.arange(len(text)), like, at[:-1]
    for _ in range(MOST_STEPS):
        if not len(going):
            break
        # texts that have settled are left alone
        got = own * np.repeat(share[going], n[going], axis=0)
        got *= (weight[rows] / np.maximum(got.sum(1), 1e-30))[:, None]
        new = np.add.reduceat(got, first, axis=0) / total[going][:, None]
        new = np.where(allowed[going] > 0, np.maximum(new, 1e-9), 0)
        moved = np.abs(new - share[going]).max(1) > TOLERANCE
        share[going] = new
        if not moved.all():
            keep = np.repeat(moved, n[going])
            going, rows, own = going[moved], rows[keep], own[keep]
            first = np.concatenate([[0], np.cumsum(n[going])])[:-1]
    fit = np.add.reduceat(np.log(np.maximum((like * share[text]).sum(1), 1e-30)) + peak[:, 0], at[:-1])
    return (share / share.sum(1, keepdims=True)).astype(np.float32), np.where(n > 0, fit, 0)


def identify(data: np.ndarray, offsets: np.ndarray, model: np.ndarray, penalty: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text: proportions fitted on the chosen set, that set as a mask, number of words.

    Sets are the most probable 1, 2, ... up to all languages of the unrestricted fit; the one with the highest
    likelihood less its penalty is chosen.
    """
    n_lang = len(model)
    logs, weight, at = word_logs(data, offsets, model)
    n = np.diff(at)
    share = np.zeros((len(n), n_lang), np.float32)
    chosen = np.zeros((len(n), n_lang), bool)
    some = np.flatnonzero(n > 0)
    if not len(some):
        return share, chosen, n
    starts = np.append(at[some], at[-1])
    share[some], whole = mixture(logs, weight, starts, np.ones((len(some), n_lang), np.float32))
    order = np.argsort(-share[some], axis=1, kind="stable")
    chosen[some, order[:, 0]] = True
    # the fit with one language needs no steps; where all languages together gain less than one more costs, no other set is better
    one = np.add.reduceat(np.take_along_axis(logs, np.repeat(order[:, :1], n[some], axis=0), 1)[:, 0], starts[:-1])
    cost = 0.5 * np.log(np.maximum(n[some], 2)) + penalty
    single = whole - one <= cost
    open_, best, cost = some[~single], (one - cost)[~single], cost[~single]
    share[some[single]] = chosen[some[single]]
    if len(open_):
        take = np.concatenate([np.arange(at[i], at[i + 1]) for i in open_])
        sub = np.concatenate([[0], np.cumsum(n[open_])])
        rank = np.argsort(np.argsort(-share[open_], axis=1, kind="stable"), axis=1)
        share[open_] = chosen[open_]
        for k in range(2, n_lang + 1):
            allowed = (rank < k).astype(np.float32)
            fitted, fit = mixture(logs[take], weight[take], sub, allowed)
            value = fit - k * cost
            better = value > best
            best[better] = value[better]
            chosen[open_[better]] = allowed[better] > 0
            share[open_[better]] = fitted[better]
    return share, chosen, n


SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double, n_languages int, mixture string"
_ARROW = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64()), ("n_languages", pa.int32()), ("mixture", pa.string())])


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def detect(docs: DataFrame, names: list[str], model: np.ndarray, *, penalty: float = 5.0, keep: bool = False) -> DataFrame:
    """doc_id, held_out, lang_pred, score, n_languages, mixture; with ``keep`` the input's rows under ``row`` as well."""
    share_model = docs.sparkSession.sparkContext.broadcast((names, model))

    def run(batches):
        names, model = share_model.value
        for batch in batches:
            data, offsets = strings(batch.column(1))
            letter = np.array(batch.column(2).to_pylist(), bool)
            pred, score, count, text = [], [], [], []
            for i, j in pieces(offsets, _CHUNK):
                if names:
                    share, chosen, n = identify(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], model, penalty)
                for k in range(j - i):
                    if not names or not letter[i + k] or n[k] == 0:
                        pred.append("und"), score.append(0.0), count.append(0), text.append("")
                        continue
                    top = int(np.argmax(np.where(chosen[k], share[k], -1)))
                    pred.append(names[top]), score.append(min(1.0, float(share[k, top]))), count.append(int(chosen[k].sum()))
                    text.append(",".join(f"{names[x]}:{share[k, x]:.4f}" for x in np.argsort(-share[k], kind="stable") if chosen[k, x]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(3), pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(count, pa.int32()), pa.array(text, pa.string())], schema=_ARROW)

    def keeping(batches):
        for batch in batches:
            own = next(run([pa.RecordBatch.from_arrays([batch.column(k) for k in range(4)], names=["doc_id", "low", "letter", "held_out"])]))
            yield pa.RecordBatch.from_arrays([batch.column(4), own.column(2), own.column(3)], names=["row", "lang_pred", "score"])

    cols = [F.col("doc_id").cast("long"), F.lower(text_or_empty()).alias("low"), text_or_empty().rlike("\\p{L}").alias("letter"), held_out().alias("held_out")]
    if not keep:
        return docs.select(*cols).mapInArrow(run, SCHEMA)
    rows = docs.select(*cols, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return rows.mapInArrow(keeping, T.StructType([rows.schema["row"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))


def accepted(docs: DataFrame, names: list[str], model: np.ndarray) -> DataFrame:
    """The documents whose chosen set holds learned languages, however many, with the input's columns."""
    rows = detect(docs, names, model, keep=True).where(F.col("lang_pred") != "und")
    return rows.select(*[F.col("row")[c].alias(c) for c in docs.columns])
