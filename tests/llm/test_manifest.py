"""The Merkle manifest against a plain tree, and its odd input."""

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from oracle import compare, connect

from riskloom.llm import merkle
from riskloom.llm.sql import MANIFEST


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h("".join(levels[-1][i : i + 2])) for i in range(0, len(levels[-1]), 2)])
    return levels


def plain_path(levels, i):
    out = []
    for level in levels[:-1]:
        run = level[i // 2 * 2 : i // 2 * 2 + 2]
        out.append((i % 2, [x for k, x in enumerate(run) if k != i % 2]))
        i //= 2
    return out


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain_manifest(rows):
    """(doc_id, text, lang, source, n_chars) rows to the contract's rows."""
    leaves = defaultdict(list)
    for d, text, lang, source, n in rows:
        def leaf(n):
            return h("".join(map(field, (d, source, lang, n, text))))

        hit = d is not None and n is not None and zlib.crc32(str(d).encode()) % 7 == 0
        leaves[lang].append((d, leaf(n), leaf(n + 1) if hit else leaf(n)))
    langs = sorted(leaves, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        leaves[lang].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[lang] = plain_tree([x[1] for x in leaves[lang]])
    top = plain_tree([trees[x][-1][0] for x in langs])
    out = []
    for k, lang in enumerate(langs):
        for i, (d, leaf, changed) in enumerate(leaves[lang]):
            path, node = plain_path(trees[lang], i) + plain_path(top, k), changed
            for right, others in path:
                node = h("".join([*others, node] if right else [node, *others]))
            proof = h("".join(s for _, others in path for s in others))
            out.append((d, leaf, trees[lang][-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return out


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 40), st.data())
def test_versions_share_all_but_ancestors(n, data):
    tree = merkle.Tree([h(str(i)) for i in range(n)])
    i, before, size = data.draw(st.integers(0, n - 1)), tree.nodes[tree.top], len(tree.nodes)
    top = tree.version(i, h("new"))
    assert len(tree.nodes) - size == len(tree.levels)  # the leaf and one copy per level
    assert tree.nodes[top][0] == plain_tree([h("new") if k == i else h(str(k)) for k in range(n)])[-1][0]
    assert tree.nodes[tree.top] == before and tree.nodes[top][0] == merkle.fold(h("new"), tree.path(i))


@pytest.mark.parametrize("block", [16])
def test_equals_sql(spark, block):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert compare(merkle.manifest(docs, merkle.tampered_leaf(), block=block), connect(folder), MANIFEST)[:5] == []


@pytest.mark.parametrize("block", [1024, 4])
def test_hard_rows(make, hard, block):
    rows = [*hard, (20, "a lone leaf", "zz", "a"), *[(i, "one of many", "en", "a") for i in range(100, 160)]]
    docs = make(rows, clash=True)
    got = merkle.manifest(docs, merkle.tampered_leaf(), block=block).collect()
    want = plain_manifest([(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in docs.collect()])
    assert Counter(map(tuple, got)) == Counter(want)
    assert any(not r["verified"] for r in got)


def test_one_row_no_row_and_no_tampering(make):
    assert merkle.manifest(make([]), merkle.tampered_leaf()).count() == 0
    (row,) = merkle.manifest(make([(1, "x", "en", "a")])).collect()
    assert row["leaf"] == row["subroot"] == row["root"] == row["folded_root"] and row["proof_sha256"] == h("") and row["verified"]
