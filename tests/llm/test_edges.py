"""Every operator and stage on empty tables, and on nulls, odd texts, repeated rows and clashing column names."""

from collections import defaultdict

import corpus_pipeline
import public_tokenizers
import pytest

from riskloom.llm import chosenpath, disclosure, divergence, guesscost, imatch, languages, packing, pareto, suffixes, tokenfile


def detect(docs):
    names, model = languages.train(docs.where(~languages.held_out()), docs["lang"])
    return languages.detect(docs, names, model)


OPERATORS = {
    "op1": chosenpath.similarity_classes,
    "op2": packing.best_fit,
    "op3": guesscost.scan_secrets,
    "op4": detect,
    "op5": divergence.judge,
    "op6": disclosure.scan_personal,
    "op7": lambda d: tokenfile.round_trip(d, public_tokenizers.path("word_bpe_49k.json")),
    "op8": suffixes.remove_repeats,
    "op9": imatch.fingerprints,
    "op10": pareto.mix_sources,
}
SAME_FOR_EQUAL_ROWS = ("op1", "op3", "op4", "op5", "op6", "op8", "op10")


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(make, name):
    assert OPERATORS[name](make([])).count() == 0


@pytest.mark.parametrize("name", OPERATORS)
def test_hard_rows(make, hard, name):
    rows = OPERATORS[name](make(hard, clash=True)).collect()
    ids = sorted(str(r["doc_id"]) for r in rows)
    if name == "op2":
        assert set(ids) == {str(r[0]) for r in hard}
    else:
        assert ids == sorted(str(r[0]) for r in hard)
    if name in SAME_FOR_EQUAL_ROWS:
        by = defaultdict(set)
        for r in rows:
            by[r["doc_id"]].add(tuple(map(str, r)))
        assert len(by[4]) == 1


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_on_empty_and_hard_rows(spark, make, hard, stage):
    run = dict(corpus_pipeline.STAGES)[stage]
    assert run(spark, make([]), "").count() == 0
    docs = make(hard, clash=True)
    out = run(spark, docs, "")
    assert out.count() > 0
    if stage != "packing":
        assert out.columns == docs.columns
        assert [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
