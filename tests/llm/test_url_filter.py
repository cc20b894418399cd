"""op2: hosts, paths and rules against plain Python; the trees' accuracy."""

import math
import random

from prepfold.llm import url_filter as uf
from prepfold.llm.shared import table

SF = "/root/testdata/sf0.01"


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host, rest = rest[:end], rest[end:]
    end = min((rest.find(c) for c in "?#" if c in rest), default=len(rest))
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), rest[:end]


def rule(host, path):
    fits = [r for r, _ in uf.RULES
            if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.split("/", 1)[1])]
    return max(fits, key=len, default=None)


def test_whole_table(spark):
    pages = {r.page_id: r.url for r in table(spark, SF, "pages").collect()}
    got = uf.op2_url_filters(spark, SF).collect()
    assert len(got) == len(pages)
    for r in got:
        host, path = split(pages[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule(host, path))
        assert r.verdict == dict(uf.RULES).get(r.rule, "block" if r.score > 0.5 else "allow")
    assert {r.verdict for r in got} == {"allow", "block"}


ODD = [None, "", "no scheme", "http://", "HTTP://WWW.Example.ORG", "http://example.org/es/x", "http://a.example.org/en/12?q=/es/",
       "x://org/", "x://ORG?a://com/de/", "http://orgs/", "http://É.com/fr/#a", "://com/de/\nx", "http://u:p@com:80/de/",
       "http://com/de", "https://a.com/de/" + "y" * 200_000, "http://badexample.org/es/", "http://b.org//en/1"]


def test_odd_urls(spark):
    rows = [(k, u, "clash", "x") for k, u in enumerate(ODD)] + [(None, ODD[5], None, None), (1, "", "r", "s")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, rule string")
    got = uf.judge(pages).collect()
    assert len(got) == len(rows)
    wanted = sorted(((i or 0), *split(u), rule(*split(u)) or "") for i, u, *_ in rows)
    assert sorted(((r.page_id or 0), r.host, r.path, r.rule or "") for r in got) == wanted
    assert all(r.verdict in ("allow", "block") for r in got)
    assert uf.judge(pages.limit(0)).count() == 0
    assert {r.verdict for r in uf.judge(pages, rules=()).collect()} == {"allow"}


def test_trees_learn_from_labelled_urls(spark):
    rng = random.Random(5)

    def one(bad):
        host = rng.choice(["x7-win", "cheap-1", "p0-k3r"] if bad else ["news", "blog", "wiki"]) + rng.choice([".com", ".net", ".org"])
        path = "/".join(rng.choice("abcdef") * rng.randint(2, 6) for _ in range(rng.randint(1, 3)))
        return f"http://{host}/{path}" + ("?" + "&".join(f"k{i}={rng.randint(0, 9999)}" for i in range(3)) if bad else "")

    rows = [(k, one(k % 3 == 0), int(k % 3 == 0)) for k in range(1200)]
    labelled = spark.createDataFrame([r[1:] for r in rows[:800]], "url string, label int")
    pages = spark.createDataFrame([r[:2] for r in rows[800:]], "page_id long, url string")
    got = uf.judge(pages, rules=(), labelled=labelled).collect()
    assert sum((r.verdict == "block") == (r.page_id % 3 == 0) for r in got) > 0.97 * len(got)


def test_features():
    assert uf.suffixes("a.b.example.org", "/en/1") == ["1.org", "2.example.org", "3.b.example.org", "/en"]
    assert uf.suffixes("", "") == ["1.", "2.", "3.", "/"]
    assert uf.entropy("aabb") == 1.0 and uf.entropy("") == 0.0
    own = uf.lexical("https://a-b.org/x1/y.html?a=1&b=2#t", "a-b.org", "/x1/y.html")
    assert own[:6] == [35, 7, 10, 7, 2, 1] and math.isclose(own[6], 3 / 35) and own[11:16] == [2, 2, 1.0, 1.0, 1]
