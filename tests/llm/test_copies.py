"""Near copies, repeated strings and fingerprints against brute force."""

import hashlib
import random
import re

import numpy as np

from riskloom.llm import chosenpath, imatch, suffixes
from riskloom.llm.components import components

WORDS = [f"w{i}" for i in range(400)]


def brute_classes(rows):
    sets, word = [], re.compile("[^\x20\x09-\x0d]+")
    for _, t, *_ in rows:
        w = word.findall(t or "")
        sets.append(frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset())
    n = len(rows)
    link = [[i != j and bool(sets[i]) and bool(sets[j]) and 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j]) for j in range(n)] for i in range(n)]
    root = list(range(n))
    for i in range(n):
        for j in range(n):
            if link[i][j] and root[i] != root[j]:
                old, new = max(root[i], root[j]), min(root[i], root[j])
                root = [new if r == old else r for r in root]
    ids = [r[0] for r in rows]
    return {ids[i]: (min(ids[j] for j in range(n) if root[j] == root[i]), sum(link[i])) for i in range(n)}


def edited(rng, text, share):
    return " ".join(rng.choice(WORDS) if rng.random() < share else w for w in text.split())


def near_rows():
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(WORDS) for _ in range(rng.randint(1, 120)))) for i in range(60)]
    rows += [(100 + i, rows[i % 6][1]) for i in range(20)]
    long = " ".join(rng.choice(WORDS) for _ in range(150))
    rows += [(200 + i, edited(rng, long, 0.02)) for i in range(80)]
    shared = " ".join(rng.choice(WORDS) for _ in range(30))
    rows += [(400 + i, shared + " " + " ".join(rng.choice(WORDS) for _ in range(90))) for i in range(60)]
    return [*rows, (900, None), (901, ""), (902, "one two"), (903, "one two")]


def test_classes_and_links_equal_brute_force(make, monkeypatch):
    rows = near_rows()
    want = brute_classes(rows)
    # small limits, so that buckets are split and blocks are paired in a small table
    for limit, block, bucket in ((512, 1024, 8192), (8, 16, 16)):
        monkeypatch.setattr(chosenpath, "LIMIT", limit)
        monkeypatch.setattr(chosenpath, "BLOCK", block)
        monkeypatch.setattr(chosenpath, "BUCKET_BLOCK", bucket)
        got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in chosenpath.similarity_classes(make(rows)).collect()}
        assert got == want


def test_sparse_buckets_are_split(make, monkeypatch):
    monkeypatch.setattr(chosenpath, "LIMIT", 8)
    monkeypatch.setattr(chosenpath, "DENSE", 2.0)
    rows = near_rows()
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in chosenpath.similarity_classes(make(rows)).collect()}
    assert got == brute_classes(rows)


def test_one_document_of_each_class_stays(make):
    rows = [(1, "a b c d e f g"), (2, "a b c d e f g"), (2, "a b c d e f g"), (3, "x y z u v w q"), (3, "x y z u v w q"), (4, None)]
    got = sorted(r["doc_id"] for r in chosenpath.one_per_class(make(rows)).collect())
    assert got == [1, 3, 4]


def test_runs_reach_the_recall():
    assert chosenpath.runs_for(0.99, 1) == 5
    assert chosenpath.runs_for(0.999, 4) > chosenpath.runs_for(0.99, 4) > chosenpath.runs_for(0.99, 1)


def test_components(spark):
    rng = random.Random(1)
    chain = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 130)] + [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(40)]
    root = {x: x for e in chain for x in e}
    for _ in root:
        for a, b in chain:
            root[a] = root[b] = min(root[a], root[b])
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {x: r for x, r in root.items() if any(x in e and e[0] != e[1] for e in chain)}


def test_two_stage_sort_orders_all_windows():
    rng = np.random.default_rng(0)
    for _ in range(60):
        parts = [bytes(rng.integers(97, 97 + rng.integers(1, 4), rng.integers(8, 40)).astype(np.uint8)) for _ in range(rng.integers(1, 30))]
        data, at = np.frombuffer(b"".join(parts), np.uint8), np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
        got = suffixes.sorted_windows(data, at, 8)
        assert sorted(got) == [a + i for a, p in zip(at, parts, strict=False) for i in range(len(p) - 7)]
        keys = [data[g : g + 8].tobytes() for g in got]
        assert keys == sorted(keys)


def brute_removal(rows, length):
    first = {}
    raw = [(k, (t or "").encode()) for k, t, *_ in rows]
    for k, b in raw:
        for i in range(len(b) - length + 1):
            w = b[i : i + length]
            first[w] = min(first.get(w, k), k)
    out = []
    for k, b in raw:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1):
            if first[b[i : i + length]] < k:
                gone[i : i + length] = True
        spans = int((gone[:-1] & ~np.concatenate([[False], gone[:-1]])[: len(b)]).sum())
        left = bytes(x for x, g in zip(b, gone, strict=False) if not g)
        out.append((k, len(b), int(gone.sum()), spans, hashlib.sha256(left).hexdigest()))
    return sorted(out)


def test_removed_bytes_equal_brute_force(make, monkeypatch):
    rng = random.Random(2)
    passage = "".join(rng.choice("abcd é") for _ in range(90))
    rows = []
    for i in range(60):
        own = "".join(rng.choice("abcdefgh ü") for _ in range(rng.randint(0, 200)))
        cut = rng.randint(0, 40)
        rows.append((rng.randint(1, 50), own + passage[cut : cut + rng.randint(30, 90)] + own[:30] if i % 3 else own))
    rows += [(7, "ab" * 100), (8, "ab" * 80), (9, "a" * 300), (9, "a" * 100), (60, None), (61, ""), (62, passage), (62, passage), (63, passage), *[(64, passage + "x" * 60)] * 5]
    # long texts in one piece and in many; no anchor, some and all anchors cut into windows; equal rows one by one and as one
    for step, hot, shelf in ((1 << 20, suffixes.HOT, 6 << 20), (97, 6, 6 << 20), (1 << 20, 0, 300)):
        monkeypatch.setattr(suffixes, "_STEP", step)
        monkeypatch.setattr(suffixes, "SHELF_BYTES", shelf)
        got = sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffixes.remove_repeats(make(rows), hot=hot).collect())
        assert got == brute_removal(rows, 50)


def test_fingerprints_follow_their_definition(make, monkeypatch):
    rng = random.Random(4)
    monkeypatch.setattr(imatch, "PART_BYTES", 2000)
    rows = [(i * 3, " ".join(rng.choice(WORDS) for _ in range(rng.randint(0, 80)))) for i in range(90)]
    rows += [(500, rows[10][1]), (501, None), (502, ""), (503, "é" * 10)]
    order = sorted(((k, t or "") for k, t in rows), key=lambda r: -r[0])
    got = {r["doc_id"]: r for r in imatch.fingerprints(make(rows)).collect()}
    assert len(got) == len(rows)
    for i, (k, t) in enumerate(order):
        after = order[(i + 1) % len(order)][1]
        new = t[: len(t) - len(t) // 3] + after[: len(t) // 3]
        assert got[k]["n_chars"] == len(t) and got[k]["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
        assert 0 <= got[k]["near_edited"] <= 1 and 0 <= got[k]["near_next"] <= 1
    assert got[500]["fingerprint"] == got[30]["fingerprint"] and got[501]["fingerprint"] == got[502]["fingerprint"]


def test_ranges_hold_every_row(make, monkeypatch):
    # ids beyond the whole numbers of a double, one id with more rows than a range, equal rows
    monkeypatch.setattr(imatch, "PART_BYTES", 500)
    rng = random.Random(8)
    text = lambda: " ".join(rng.choice(WORDS) for _ in range(20))
    rows = [((1 << 62) + 1_000_003 * i, text()) for i in range(80)] + [(5, text()) for _ in range(60)] + [(7, "same words")] * 9 + [(None, text())]
    frame, _ = imatch.in_order(make(rows))
    parts = frame.rdd.glom().map(lambda part: [(r["guest"], r["doc_id"], r["text"]) for r in part]).collect()
    parts = [p for p in parts if p]
    assert len(parts) > 20 and sum(sum(r[1] == 5 for r in p if not r[0]) > 0 for p in parts) > 3
    assert all(p[-1][0] == 1 and sum(not r[0] for r in p) for p in parts)
    whole = [r[1:] for p in reversed(parts) for r in p if not r[0]]
    assert sorted(whole) == sorted((-(1 << 63) if k is None else k, t) for k, t in rows)
    assert [k for k, _ in whole] == sorted((k for k, _ in whole), reverse=True)
    # every range ends with the document that begins the next one, the last with the first of all
    begin = [p[0][1:] for p in reversed(parts)]
    guest = [next(r[1:] for r in p if r[0]) for p in reversed(parts)]
    assert guest == begin[1:] + begin[:1]
    assert imatch.fingerprints(make(rows)).count() == len(rows)


def test_likeness_tells_edits_from_strangers(spark):
    rows = imatch.fingerprints(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()
    assert np.mean([r["near_edited"] for r in rows]) > 0.3 > 0.05 > np.mean([r["near_next"] for r in rows])
    assert np.mean([r["near_edited"] > r["near_next"] for r in rows]) > 0.9


def test_lexicon_is_the_band(make):
    rows = [(i, "all " + ("half " if i % 2 else "") + ("few " if i < 3 else "") + f"own{i}") for i in range(40)]
    band = set(imatch.lexicon(make(rows), 0.05, 0.6).tolist())

    def code(word):
        return imatch.terms(np.frombuffer(word.encode(), np.uint8), np.array([0, len(word)]))[0][0]

    assert band == {int(code("half")), int(code("few"))}
