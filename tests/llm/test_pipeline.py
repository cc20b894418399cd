"""The pipeline's stages against brute force, each on its own input."""

import pytest

import corpus_pipeline as cp
from prepfold.llm import toxicity
from prepfold.llm.shared import table
from tests.llm.test_decontamination import brute
from tests.llm.test_simhash_dedup import slow_components, slow_fingerprint
from tests.llm.test_tokens_packing import check_packing

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark):
    docs, out = table(spark, SF, "documents"), []
    for _, stage in cp.STAGES:
        out.append([docs, stage(spark, docs, SF)])
        docs = spark.createDataFrame(out[-1][1].collect(), out[-1][1].schema)
        out[-1][1] = docs
    return out


def rows(frame):
    return {r.doc_id: r.text for r in frame.collect()}


def test_columns_and_whole_rows(steps):
    first = {tuple(r) for r in steps[0][0].collect()}
    for given, kept in steps[:-1]:
        assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert {tuple(r) for r in kept.collect()} <= first
        assert 0 < kept.count() <= given.count()


def test_toxicity(spark, steps):
    given, kept = steps[0]
    model = toxicity.fit(given, table(spark, SF, "labels"))
    scores = {r.doc_id: r.score for r in toxicity.scored(given, model).collect()}
    assert set(rows(kept)) == {k for k, s in scores.items() if s < 0.5}


def test_exact_dedup(steps):
    import re
    first = {}
    for k, text in sorted(rows(steps[1][0]).items()):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text or ""), k)
    assert set(rows(steps[1][1])) == set(first.values())


def test_near_dedup(steps):
    given = sorted(rows(steps[2][0]).items())
    found = slow_components([k for k, _ in given], [slow_fingerprint(t) for _, t in given])
    assert set(rows(steps[2][1])) == set(found.values())


def test_decontamination(spark, steps):
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    clean = {d for d, _, hit, _ in brute(list(rows(steps[3][0]).items()), items) if not hit}
    assert set(rows(steps[3][1])) == clean and len(clean) < steps[3][0].count()


def test_packing(steps):
    from tokenizers import Tokenizer
    from prepfold.llm.tokens import vocabulary_path
    library = Tokenizer.from_file(vocabulary_path())
    check_packing(steps[4][1].collect(), rows(steps[4][0]),
                  lambda t: library.encode(t or "", add_special_tokens=False).ids)


def test_run_gives_the_same_documents(spark, steps):
    got = cp.run(spark, SF).collect()
    assert {r.doc_id for r in got} == set(rows(steps[4][0])) and len(got) == steps[4][1].count()


def test_edge_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept int, score double, row long"
    docs = spark.createDataFrame(
        [(1, None, None, None, None, 1, 1.0, 7), (2, "", "en", "s", 0, 1, 1.0, 7), (None, "a text of its own", "en", "s", 9, 0, None, 7),
         (4, "Same words here, all of them", "en", "s", 5, 1, 1.0, 7), (5, "Same  words here,\nall of them", "en", "s", 5, 1, 1.0, 7),
         (5, "Same  words here,\nall of them", "en", "s", 5, 1, 1.0, 7), (6, "x " * 50_000, "en", "s", 5, 1, 1.0, 7)], schema)
    for frame, wanted in ((docs, [0, 1, 4, 6]), (docs.limit(0), [])):
        for _, stage in cp.STAGES[:-1]:
            frame = spark.createDataFrame(stage(spark, frame, SF).collect(), schema)
        assert sorted(r.doc_id or 0 for r in frame.collect()) == wanted
        assert sorted(set(r.doc_id or 0 for r in cp.pack(spark, frame, SF).collect())) == wanted
