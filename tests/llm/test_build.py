"""Packing, token files, the source mix and the pipeline."""

import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from oracle import compare, connect
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskloom.llm import packing, pareto, rans, tokenfile
from riskloom.llm.queries import ORACLES, QUERIES
from riskloom.llm.spans import personal

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, name):
    assert compare(QUERIES[name](spark, FOLDER), connect(FOLDER), ORACLES[name])[:5] == []


def naive_pack(sizes, clusters, sources, capacity, per_source):
    """Best fit by looking at every bin."""
    codes, seen = {}, {}
    for kind, values in (("c", clusters), ("s", sources)):
        for v in values:
            codes.setdefault((kind, v), len(codes))
    bins, out = [], [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], codes["c", clusters[i]], codes["s", sources[i]], i)):
        fit = [b for b in bins if b["room"] >= sizes[i] and clusters[i] not in b["c"] and b["s"][sources[i]] < per_source]
        if fit:
            best = min(fit, key=lambda b: (b["room"], b["since"]))
        else:
            best = {"room": capacity, "c": set(), "s": Counter(), "no": len(bins), "since": 0}
            bins.append(best)
        best["room"] -= sizes[i]
        best["c"].add(clusters[i])
        best["s"][sources[i]] += 1
        best["since"] = len(seen)
        seen[len(seen)] = i
        out[i] = best["no"]
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 20), st.integers(0, 4), st.sampled_from("ab")), max_size=40))
def test_packing_equals_naive_best_fit(items):
    args = [[x[k] for x in items] for k in range(3)]
    assert packing.pack(*args, 20, 3) == naive_pack(*args, 20, 3)


def test_near_copies_never_share_a_bin(make):
    words = [f"w{i}" for i in range(60)]
    near = [(i, " ".join([*words[:-1], f"end{i}"])) for i in range(12)]
    rows = [*near, *[(100 + i, f"another text number {i} of its own") for i in range(30)], (None, " ".join(words)), (7, " ".join(words))]
    docs = make(rows)
    bins = defaultdict(list)
    for r in packing.best_fit(docs, classes=packing.near_copies(docs)).collect():
        bins[r["bin"]].append(r["doc_id"])
    assert all(sum(i is not None and i < 12 for i in ids) <= 1 for ids in bins.values())
    assert sum(map(len, bins.values())) == len(rows)


def test_larger_documents_have_larger_odds(make):
    rows = [(i, "w " * (10 if i % 2 else 40), "en", "s") for i in range(4000)] + [(10_000 + i, "w " * 25, "en", "t") for i in range(200)]
    got = pareto.mix_sources(make(rows)).where("source_size > 50000").collect()
    part = got[0]["target"] / got[0]["source_size"] % 1
    extra = {n: np.mean([r["copies"] - min(x["copies"] for x in got) for r in got if r["size"] == n]) for n in (10, 40)}
    assert abs(sum(r["taken"] for r in got) - got[0]["target"]) <= 40 and 0 < part < 1
    assert extra[40] > 2 * extra[10] > 0


def test_packing_keeps_all_words_and_all_rules(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = packing.best_fit(docs, shard_rows=300).collect()
    text = {r["doc_id"]: r for r in docs.collect()}
    words, bins = Counter(), defaultdict(list)
    for r in rows:
        words[r["doc_id"]] += r["n_words"]
        bins[r["bin"]].append(r)
    assert words == {k: len(r["text"].split()) for k, r in text.items()}
    for name, inside in bins.items():
        if name is None:
            continue
        assert sum(r["n_words"] for r in inside) == inside[0]["bin_words"] <= packing.CAPACITY
        assert len({text[r["doc_id"]]["text"] for r in inside}) == len(inside)
        assert max(Counter(text[r["doc_id"]]["source"] for r in inside).values()) <= packing.PER_SOURCE
    total = sum(words.values())
    assert total / (packing.CAPACITY * sum(n is not None for n in bins)) > 0.9


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 300), max_size=400), st.sampled_from([1, 4, 256]), st.sampled_from([1, 7, 128]))
def test_rans_round_trip_and_checkpoints(ids, lanes, every):
    ids = np.array(ids, np.int64)
    table = rans.Table(rans.frequencies(np.bincount(ids, minlength=301)))
    raw = rans.encode(ids, table, lanes, every)
    assert (rans.decode(raw, table) == ids).all()
    marks = rans._HEAD.unpack_from(raw)[5]
    assert np.concatenate([rans.decode(raw, table, k, k + 1) for k in range(marks)] or [ids]).tolist() == ids.tolist()
    with pytest.raises(ValueError):
        rans.decode(raw[:-5] + bytes([raw[-5] ^ 1]) + raw[-4:], table)


def test_rans_is_near_the_entropy():
    ids = np.random.default_rng(0).zipf(1.4, 60_000) % 5000
    n = np.bincount(ids, minlength=5000)
    p = n[n > 0] / n.sum()
    raw = rans.encode(ids, rans.Table(rans.frequencies(n)))
    states = rans._HEAD.unpack_from(raw)[5] * (4 + 8 * rans.LANES)
    assert len(raw) - states < 1.01 * (-(p * np.log2(p)).sum() * len(ids) / 8) + 100


def test_frequencies_keep_rare_symbols():
    freq = rans.frequencies(np.array([10**12, 1, 0, 1]))
    assert freq.sum() == 1 << rans.SCALE and (freq > 0).tolist() == [True, True, False, True]


def test_token_file_round_trip(spark, make, hard, monkeypatch):
    monkeypatch.setattr(tokenfile, "BLOCK_IDS", 50)
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = [r for r in hard if r[0] not in (None, 4, 5)] + [(20, "<|endoftext|> áb  ÀÉ it's <|startoftext|>x y z\x0b\x1cq")]
    tokenizer, at = Tokenizer.from_file(path), 0
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in tokenfile.round_trip(make(rows), path).collect()}
    for k, text, *_ in sorted(rows):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        assert got[k] == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_mix_comes_near_its_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = pareto.mix_sources(docs).join(docs.select("doc_id", "source"), "doc_id").collect()
    taken, target = Counter(), {}
    for r in rows:
        assert r["taken"] == r["copies"] * r["size"] and r["copies"] <= 2
        taken[r["source"]] += r["taken"]
        target[r["source"]] = (r["target"], r["source_size"])
    largest = max(r["size"] for r in rows)
    assert all(abs(taken[s] - t) <= largest / 2 + 1 and t <= 2 * n + 1e-6 for s, (t, n) in target.items())
    assert abs(sum(t for t, _ in target.values()) - 1.5 * sum(n for _, n in target.values())) < 1e-3
    again = pareto.mix_sources(docs.repartition(7)).collect()
    assert sorted((r["doc_id"], r["copies"]) for r in again) == sorted((r["doc_id"], r["copies"]) for r in rows)


def test_pareto_takes_the_smallest_odds(make):
    rows = [(i, "w " * (1 + i % 5), "en", "a") for i in range(200)] + [(1000 + i, "w w", "en", "b") for i in range(50)]
    got = {r["doc_id"]: r for r in pareto.mix_sources(make(rows), weights=(1,), share=0.5, cap=2.0).collect()}
    spark = make(rows).sparkSession
    u = dict(spark.range(2000).select("id", pareto.uniform(F.col("id"), "mix")).collect())
    for low in (0, 1000):
        own = {k: r for k, r in got.items() if (k >= 1000) == (low == 1000)}
        first = next(iter(own.values()))
        left = first["target"] - first["target"] // first["source_size"] * first["source_size"]
        per_word = left / sum(r["size"] ** 2 for r in own.values())

        def rank(k, own=own, per_word=per_word):
            inclusion = min(pareto.MOST, per_word * own[k]["size"])
            return (u[k] / (1 - u[k])) / (inclusion / (1 - inclusion)) if inclusion else float("inf"), k

        base = min(r["copies"] for r in own.values())
        more = [k for k, r in own.items() if r["copies"] > base]
        rest = [k for k, r in own.items() if r["copies"] == base]
        assert not more or max(map(rank, more)) < min(map(rank, rest))


def test_pipeline_stages_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, FOLDER).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        kept[name] = docs.collect()
    assert len(kept["language_id"]) > len(kept["near_copies"])
    assert any(personal(r["text"]) for r in kept["near_copies"]) and not any(personal(r["text"]) for r in kept["personal_data"])
    assert all(r["n_chars"] == len(r["text"]) for r in kept["personal_data"])
    assert {r["doc_id"] for r in kept["personal_data"]} == {r["doc_id"] for r in kept["near_copies"]}
    assert max(Counter(r["doc_id"] for r in kept["source_mix"]).values()) == 2
    words = sum(len(r["text"].split()) for r in kept["source_mix"])
    assert abs(words / sum(len(r["text"].split()) for r in kept["personal_data"]) - 1.5) < 0.05
    assert sum(r["n_words"] for r in kept["packing"]) == words
