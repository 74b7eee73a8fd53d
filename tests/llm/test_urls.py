"""The URL filter against one regular expression per glob, and its edge cases."""

import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from brightledger.llm import plans, urls

def fits(glob, text):
    """The tokens one by one: the places in the text that they can have reached."""
    reached = {0}
    for c, wild in urls.tokens(glob):
        if wild and c != urls.ONE:
            for at in sorted(reached):
                while at < len(text) and (c == urls.ANY or text[at] != "/"):
                    at += 1
                    if at in reached:
                        break
                    reached.add(at)
        else:
            reached = {at + 1 for at in reached if at < len(text) and (text[at] != "/" if wild else text[at] == c)}
    return len(text) in reached


def brute(globs, text):
    return [fits(g, text) for g in globs]


@given(st.lists(st.text("ab/*?.é\\", max_size=9), min_size=1, max_size=40), st.lists(st.text("ab/.é🙂", max_size=30), min_size=1, max_size=30))
@settings(max_examples=200, deadline=None)
def test_automaton_is_one_pattern_after_another(globs, texts):
    assert urls.Automaton(globs).matches(texts).tolist() == [brute(globs, t) for t in texts]


def test_many_words_of_states():
    rng = random.Random(1)
    globs = ["".join(rng.choice(["a", "b", "/", "*", "**", "?"]) for _ in range(rng.randrange(1, 90))) for _ in range(60)]
    texts = ["".join(rng.choice("ab/") for _ in range(rng.randrange(60))) for _ in range(300)]
    automaton = urls.Automaton(globs)
    assert automaton.step.shape[1] > 20
    assert automaton.matches(texts).tolist() == [brute(globs, t) for t in texts]
    assert automaton.first(texts) == [next((i for i, hit in enumerate(brute(globs, t)) if hit), None) for t in texts]


def test_bounded_batches(monkeypatch):
    monkeypatch.setattr(urls, "CELLS", 3)
    assert urls.Automaton(["a*", "**"]).first(["abc", "b", "", "a/"]) == [0, 1, 1, 1]
    assert urls.Automaton([]).first(["a"]) == [None]


def by_definition(url, sites):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host, path = re.fullmatch(r"([^/?#]*)([^?#]*).*", rest, re.S).groups()
    host = "".join(c.lower() if c.isascii() else c for c in host)
    fits = [(len(s), s, v) for v, s in sites if (host == s.split("/")[0] or host.endswith("." + s.split("/")[0])) and path.startswith(s[s.index("/"):])]
    best = max(fits, default=(0, None, "allow"))
    return host, path, best[1], best[2]


URLS = [None, "", "net/", "http://", "http://net", "HTTP://NET/", "ftp://a.NET/x?y#z", "x://xnet/", "http://a.example.net/en/1", "http://example.net/en", "http://b.example.com/de/#q", "//example.org/fr/",
        "http://u@h.org/fr/a://b.net/", "http://ÀB.Org/fr/", "http://?/net/", "http://a.net\n/x", "http://a.net/" + "long/" * 50_000, "http://.net/", "http://a.net.org/de/"]


def test_urls_by_definition(spark):
    rows = [(i, u, "x", "y", "z") for i, u in enumerate(URLS + URLS)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, rule string, c0 string")
    out = urls.judge(pages, urls.by_length(plans.SITES))
    assert out.columns == ["page_id", "url", "c0", "host", "path", "rule", "glob", "verdict"]
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in out.collect()}
    assert got == {i: by_definition(u, plans.SITES) for i, u, *_ in rows}
    assert urls.judge(pages.where("false"), urls.by_length(plans.SITES)).count() == 0
    assert urls.judge(pages, [], otherwise="block").where("verdict = 'block' AND rule IS NULL").count() == len(rows)


def test_query_is_its_statement(spark):
    import check

    sf = "/root/testdata/sf0.01"
    assert check.compare(spark, check.duck(sf), sf, "op12_url_filter", plans.op12_url_filter, plans.PAGE_VERDICTS) is None
    assert plans.op12_url_filter(spark, sf).where(F.col("glob").isNotNull()).count() > 0
