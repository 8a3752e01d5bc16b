"""URL filters against a plain version that enumerates all token combinations."""

import random
import re
from collections import defaultdict
from itertools import combinations

from tickloom.llm import url_filter

RULES = url_filter.LIST_RULES
SCHEMA = "page_id long, url string, host string, _url int"


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3 :]
    host = re.match(r"[^/?#]*", rest).group()
    return lower(host), re.match(r"[^?#]*", rest[len(host) :]).group()


def tokens(url):
    if url is None or "://" not in url:
        return set()
    host, path = parts(url)
    scheme, rest = url.split("://", 1)
    before, _, fragment = rest.partition("#")
    query = before.partition("?")[2]
    labels = host.split(".")
    zero = lambda x: re.sub("[0-9]+", "0", x)
    out = {"s:" + scheme} if scheme else set()
    out |= {"h:" + ".".join(labels[-n:]) for n in range(1, min(len(labels), 4) + 1) if ".".join(labels[-n:])} | ({"h:" + host} if host else set())
    out |= {"p:" + zero(x) for x in path.split("/") if x} | {"q:" + zero(x) for x in query.split("&") if x}
    return out | ({"f:" + zero(fragment)} if fragment else set())


def listed(url):
    host, path = parts(url)
    fits = [(len(h + p), len(h), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[2:] if fits else (None, None)


def plain_rules(labelled, support=10, confidence=0.5, most=10):
    bad = defaultdict(int)
    for url, x in labelled:
        if url is not None:
            bad[url] = max(bad[url], x or 0)
    sets = {u: tokens(u) for u in bad}
    worth = {}
    for token in set().union(*sets.values()):
        of = [bad[u] for u, t in sets.items() if token in t]
        if sum(of) >= support:
            worth[token] = (-sum(of) / len(of), -sum(of), token.encode())
    counted = defaultdict(lambda: [0, 0])
    for u, t in sets.items():
        chosen = sorted((x for x in t if x in worth), key=worth.get)[:most]
        for k in range(1, len(chosen) + 1):
            for items in combinations(sorted(chosen), k):
                counted[items][0] += 1
                counted[items][1] += bad[u]
    sure = {}
    for items, (n, n_bad) in counted.items():
        if n_bad >= support and n_bad / n >= confidence:
            of = [bad[u] for u, t in sets.items() if t >= set(items)]
            if sum(of) >= support and sum(of) / len(of) >= confidence:
                sure[items] = (sum(of) / len(of), sum(of))
    return {i: c for i, c in sure.items() if not any(set(j) < set(i) and d[0] >= c[0] for j, d in sure.items())}


def plain_verdicts(pages, labelled):
    rules = plain_rules(labelled)
    out = []
    for page, url in pages:
        rule, verdict = listed(url)
        hits = [(c, s, " ".join(i)) for i, (c, s) in rules.items() if set(i) <= tokens(url)]
        best = max(hits, default=(None, None, None))
        out.append((page, *parts(url), rule, verdict or ("block" if hits else "allow"), best[2], best[0]))
    return sorted(out, key=str)


def some_pages():
    pick = random.Random(6)
    pages, labelled = [], []
    for i in range(900):
        host = pick.choice(["a.example.org", "Example.ORG", "shop.example.net", "spam.example.net", "x.y.z.deep.host.test", "news.com", "example.com"])
        path = pick.choice(["/es/", "/en/1", "/en/", "/fr/", "/de/", "/", ""]) + str(i) + pick.choice(["", ".html", "/?page=2&ref=x", "#top", "?utm=9"])
        url = f"{pick.choice(['http', 'https', 'HTTP'])}://{host}{path}"
        pages.append((i, url))
        odds = 0.9 if "spam" in url else 0.8 if "deep" in url and "?" in url else 0.15
        labelled.append((url, int(pick.random() < odds)))
    odd = [None, "", "no scheme", "://", "://host", "x://org/", "x://notexample.org/es/1", "http://org", "http://a?b#c://d", "http://example.org/es/?x#y#z", "http://a..b./..//p",
           "http://spam.example.net\n/p q", "http://spam.example.net/" + "p/" * 20_000 + "1", "ftp://example.org/en/1", "ftp://example.org/en/2", "a://b://c/d"]
    pages += [(1000 + i, u) for i, u in enumerate(odd)] + [(3, "http://spam.example.net/9"), (3, "http://spam.example.net/9"), (None, "http://spam.example.net/9")]
    return pages, labelled + [(None, 1), ("http://spam.example.net/9", None), ("http://spam.example.net/9", 1), ("", 1)]


def frame(spark, pages):
    return spark.createDataFrame([(*p, "h", 1) for p in pages], SCHEMA).repartition(3)


def judged(spark, pages, labelled):
    rules = url_filter.mined_rules(spark.createDataFrame(labelled, "url string, bad int"))
    out = url_filter.judge(frame(spark, pages), rules, ["page_id"])
    return sorted((tuple(r) for r in out.collect()), key=str)


def test_equals_plain_version(spark):
    pages, labelled = some_pages()
    want = plain_verdicts(pages, labelled)
    assert len(plain_rules(labelled)) > 3 and any(x[4] == "block" and x[3] is None for x in want)
    assert judged(spark, pages, labelled) == want


def test_rules_of_the_list():
    assert listed("http://sub.EXAMPLE.org/es/1?x") == ("example.org/es/", "block")
    assert listed("http://badexample.org/es/1") == ("org/", "allow")
    assert listed("http://example.org/en/12") == ("example.org/en/1", "block")
    assert listed("http://example.org/en/2") == ("org/", "allow")


def test_no_labels_and_empty_tables(spark):
    pages, labelled = some_pages()
    assert judged(spark, pages, []) == plain_verdicts(pages, [])
    assert judged(spark, pages[:5], [(u, 0) for u, _ in labelled]) == plain_verdicts(pages[:5], [])
    assert judged(spark, [], labelled[:20]) == []


def test_clashing_columns_stay(spark):
    out = url_filter.judge(frame(spark, [(1, "http://org/x")]), url_filter.mined_rules(spark.createDataFrame([], "url string, bad int")), ["page_id", "host", "_url"])
    assert out.columns == ["page_id", "host", "_url", "host_", "path", "rule", "verdict", "mined", "confidence"]
    assert out.first()["host"] == "h" and out.first()["host_"] == "org" and out.first()["rule"] == "org/"


def test_sample_is_thinned_by_hash(spark):
    """Above the bound about so many URLs are taken, and the same ones again."""
    labelled = spark.createDataFrame([(f"http://spam{i % 3}.example.net/{i}", int(i % 3 == 0)) for i in range(3000)], "url string, bad int")
    rules = [url_filter.mined_rules(labelled, most_labelled=600).collect() for _ in range(2)]
    assert rules[0] == rules[1] and [r.rule for r in rules[0]] == ["h:spam0.example.net"]
    assert 120 < rules[0][0].support < 280


def test_labels_of_pages(spark):
    pages = spark.createDataFrame([("http://a/en/12?x=5",), ("http://a/en/13.html",), ("http://a/x",), (None,), ("http://a/" + "9" * 30,)], "url string")
    labels = spark.createDataFrame([(12, 0, 0), (12, 1, 0), (13, 1, 0), (14, 0, 1), (None, 0, 0), (15, None, None)], "doc_id long, quality int, toxic int")
    got = {tuple(r) for r in url_filter.labels_of_pages(pages, labels).collect()}
    assert got == {("http://a/en/12?x=5", 1), ("http://a/en/13.html", 0)}
