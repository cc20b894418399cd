"""op3 and op10: DuckDB on the given tables, plain Python on odd rows."""

import hashlib
import re

import numpy as np
import pytest

from prepfold.llm import exact_dedup as ed
from prepfold.llm import line_dedup as ld
from prepfold.llm.registry import ORACLE_SQL, QUERIES
from tools.oracle_check import compare, duck_connection

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return duck_connection(SF)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_duckdb(spark, duck, name):
    ok, msg = compare(spark, duck, name, QUERIES[name], ORACLE_SQL[name], SF)
    assert ok, msg


def test_every_operator_has_a_query():
    assert [int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES] == list(range(1, 11))


ROWS = [(4, "a  b\tc", 1, "x"), (2, "a b c", 1, "x"), (9, "a b c ", 1, "x"), (3, None, None, None), (8, "", 1, "x"),
        (5, "y" * 300_000 + "1", 1, "x"), (6, "y" * 300_000 + "2", 1, "x"), (7, "y" * 300_000 + "1", 1, "x"),
        (None, "a b c", 1, "x"), (2, "a b c", 1, "x"), (None, "alone é", 1, "x"), (10, "y" * 64, 1, "x"), (11, "y" * 65, 1, "x"),
        (12, "y" * 64, 1, "x"), (13, "Aa b c", 1, "x")]
SCHEMA = "doc_id long, text string, group_size int, kept string"


@pytest.mark.parametrize("digit,growth", [(64, 64), (1, 2), (3, 5)])
def test_exact_groups_of_odd_rows(spark, digit, growth):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    got = ed.exact_groups(docs, first_digit=digit, growth=growth).collect()
    groups = {}
    for k, text, *_ in ROWS:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text or ""), []).append(k)
    named = [(k, text) for text, own in groups.items() for k in own]
    first = {t: min((k for k in own if k is not None), default=None) for t, own in groups.items()}
    wanted = sorted((k or 0, first[t] or 0, len(groups[t]), hashlib.sha256(t.encode()).hexdigest()) for k, t in named)
    assert sorted((r.doc_id or 0, r.keep_id or 0, r.group_size, r.text_sha256) for r in got) == wanted
    assert sum(r.kept for r in got) == len(groups)
    left = ed.deduplicate(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in left.collect()) == sorted((x or 0) for x in first.values())
    assert ed.exact_groups(docs.limit(0)).count() == 0


def plain_lines(rows):
    def key(line):
        k = bytes(line, "utf-8").strip().lower().decode()
        return k if len(k) >= 10 else None
    first, docs = {}, {}
    for doc, text, *_ in rows:
        for line in (text or "").split("\n"):
            if key(line) and doc is not None:
                first[key(line)] = min(doc, first.get(key(line), doc))
                docs.setdefault(key(line), set()).add(doc)
    out = []
    for doc, text, *_ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if doc is None or not key(x) or len(docs[key(x)]) < 2 or first[key(x)] == doc]
        out.append((doc or 0, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("limit", [ld.MAX_FILTER_BYTES, 1])
def test_lines_of_odd_rows(spark, limit):
    rng = np.random.default_rng(0)
    rows = [(2, "One long line\nshort\n one LONG line\x0b\nü" + "é" * 9, 1, "a"), (1, None, 1, "a"), (3, "", 1, "a"),
            (4, "one long line\nshort", 1, "a"), (5, "é" * 9 + "\n" + "Ü" + "é" * 9 + "\r", 1, "a"), (6, "ü" + "é" * 9, 1, "a"),
            (None, "one long line", 1, "a"), (7, "only row seven\nonly row seven", 1, "a"), (7, "only row seven", 1, "a"),
            (8, "\n\n", 1, "a"), (9, "line " * 200_000, 1, "a"), (11, "\nline " * 3 + "line " * 200_000, 1, "a")]
    rows += [(20 + k, "\n".join(f"line number {x}" for x in rng.integers(0, 60, 12)), 1, "a") for k in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key int, n_lines string")
    got = ld.drop_repeated_lines(docs, max_filter_bytes=limit).collect()
    assert sorted((r.doc_id or 0, r.n_lines, r.n_dropped, r.kept_sha256) for r in got) == plain_lines(rows)
    assert all(hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256 for r in got)
    assert ld.drop_repeated_lines(docs.limit(0)).count() == 0


def test_bloom_filters_have_no_false_negatives():
    rng = np.random.default_rng(1)
    own, other = rng.integers(0, 1 << 63, (2, 20_000)).astype(np.uint64)
    seen = ld.Bloom(ld._power(16 * len(own)))
    seen.add(own)
    assert seen.holds(own).all() and seen.holds(other).mean() < 0.01
