"""URL parts and rules one by one, splits against all splits."""

from itertools import combinations

import pytest
from logweir.llm.urls import ALLOW, BLOCK, RULES, Bayes, Splitter, _phrases, url_verdicts, url_words

URLS = [
    (None, "", "", None),
    ("no scheme/x", "", "", None),
    ("HTTP://A.Example.NET/en/x?y://z/", "a.example.net", "/en/x", "example.net/en/"),
    ("http://a.net", "a.net", "", None),
    ("http://net/x#y", "net", "/x", "net/"),
    ("x://example.com/de/", "example.com", "/de/", "example.com/de/"),
    ("http://notexample.com/de/", "notexample.com", "/de/", None),
    ("http://o.org/fr/a", "o.org", "/fr/a", "org/fr/"),
    ("http://o.org?/fr/", "o.org", "", None),
    ("://", "", "", None),
    ("http://É.net/\n?", "É.net", "/\n", "net/"),
    ("http://x.example.net/EN/", "x.example.net", "/EN/", "net/"),
]


def test_parts_and_rules(spark):
    rows = [(i, u, "<p>") for i, (u, *_) in enumerate(URLS)]
    df = spark.createDataFrame([*rows, rows[0], (None, "http://a.net/", None)], "page_id long, url string, html string")
    got = url_verdicts(df, RULES).collect()
    assert len(got) == len(rows) + 2
    verdicts = dict(RULES)
    for r in got:
        want = URLS[r.page_id][1:] if r.page_id is not None else ("a.net", "/", "net/")
        assert (r.host, r.path, r.rule) == want
        assert r.verdict == verdicts.get(r.rule, "allow")


def test_words_decide_without_rule(spark):
    urls = ["http://cheappillsonline.shop/", "http://www.casino-win.example/x", "http://universitylibrary.edu/", "http://qqqq.example/", "http://freecasinobonus.biz/news.html"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: r.verdict for r in url_verdicts(df, []).collect()}
    assert got == {0: "block", 1: "block", 2: "allow", 3: "allow", 4: "block"}
    assert url_verdicts(df.limit(0), RULES).collect() == []


@pytest.mark.parametrize("text", ["thecatsat", "xcat", "catx", "zzz", "acatacat", ""])
def test_best_split(text):
    counts = {"the": 50, "cat": 10, "cats": 2, "sat": 5, "a": 30, "at": 20}
    s = Splitter(counts)
    cost = lambda words: sum(s.cost.get(w, s.total + 2.3 * len(w)) for w in words)
    cuts = [[0, *c, len(text)] for n in range(len(text)) for c in combinations(range(1, len(text)), n)] if text else [[0]]
    best = min(cost([text[a:b] for a, b in zip(c, c[1:])]) for c in cuts)
    assert "".join(s.split(text)) == text and cost(s.split(text)) == pytest.approx(best)


def test_held_out_phrases():
    """Each labelled phrase, scored by a model that was trained without it."""
    sides = _phrases(BLOCK), _phrases(ALLOW)
    words = {w: 5 for side in sides for p in side for w in p}
    right = 0
    for side, wanted in ((0, True), (1, False)):
        for phrase in sides[side]:
            train = [[p for p in s if p != phrase] for s in sides]
            right += (Bayes(*train).score(url_words("".join(phrase), "", Splitter(words))) > 0) == wanted
    assert right / sum(map(len, sides)) > 0.55
