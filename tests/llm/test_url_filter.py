import math
import re
from collections import Counter, defaultdict

import pytest

from cdcflow.llm.queries import URL_RULES
from cdcflow.llm.url_filter import _KIND, KINDS, ORDER, calibrated, url_verdicts


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    return lower, re.match(r"[^?#]*", rest[len(host) :])[0]


def ruled(url):
    host, path = parts(url)
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.name), default=None)


def grams(url):
    kinds = [39] * ORDER + [int(_KIND[b]) for b in url.encode()] + [39]
    return [tuple(kinds[i : i + ORDER + 1]) for i in range(len(kinds) - ORDER)]


class Model:
    def __init__(self, urls):
        self.n = defaultdict(Counter)
        for u in urls:
            for g in grams(u):
                for k in range(ORDER + 1):
                    self.n[g[ORDER - k : ORDER]][g[ORDER]] += 1

    def p(self, context, c):
        lower = self.p(context[1:], c) if context else 1 / KINDS
        n = self.n.get(context)
        return (n[c] + len(n) * lower) / (sum(n.values()) + len(n)) if n else lower


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "x", "x") for i, u in enumerate(urls)], "page_id long, url string, host string, rule string")


def test_equals_brute_force_on_given_pages(spark, sf_dir):
    import zlib

    df = spark.read.parquet(f"{sf_dir}/pages.parquet")
    urls = {r.page_id: r.url for r in df.collect()}
    got = {r.page_id: r for r in url_verdicts(df, URL_RULES).collect()}
    fit = lambda v: [u for u in urls.values() if (r := ruled(u)) and r.verdict == v and zlib.crc32(u.encode()) % 5]
    yes, no = Model(fit("allow")), Model(fit("block"))
    score = {i: sum(math.log(yes.p(g[:-1], g[-1]) / no.p(g[:-1], g[-1])) for g in grams(u)) / (len(u.encode()) + 1) for i, u in urls.items()}
    held = Counter((math.floor(score[i] * 100), r.verdict == "allow") for i, u in urls.items() if (r := ruled(u)) and zlib.crc32(u.encode()) % 5 == 0)
    cutoff = calibrated([(s, a, n) for (s, a), n in held.items()])
    assert set(got) == set(urls)
    for i, u in urls.items():
        r = ruled(u)
        assert (got[i].host, got[i].path, got[i].rule) == (*parts(u), r.name if r else None)
        assert got[i].url_score == pytest.approx(score[i], abs=1e-5)
        if r or abs(score[i] - cutoff) > 1e-4:
            assert got[i].verdict == (r.verdict if r else "allow" if score[i] >= cutoff else "block")


def test_rules_and_odd_urls(spark):
    urls = ["http://a.net/x", "http://EXAMPLE.net/en/1", "http://notexample.net/en/", "http://example.com/de/a?b", "http://x.example.com/de", "https://b.org/fr/#x", "http://net", "http://a.net?x/",
            "noscheme.net/x", "", None, "http://ÄB.net/ä/😀", "http://h:80/p", "x://y://a.net/", "http://a.net/" + "z" * 100_000, "http://a.net/x"]
    got = [r for r in url_verdicts(pages(spark, urls), URL_RULES).orderBy("page_id").collect()]
    assert [r.rule for r in got] == [(x.name if (x := ruled(u)) else None) for u in urls]
    assert [(r.host, r.path) for r in got] == [parts(u) for u in urls]
    assert {r.verdict for r in got} <= {"allow", "block"} and got[0].verdict == "block" and got[1].verdict == "allow"


def test_empty_table_and_no_training(spark):
    assert url_verdicts(pages(spark, []), URL_RULES).collect() == []
    assert [r.verdict for r in url_verdicts(pages(spark, ["http://a.de/x", None]), URL_RULES).collect()] == ["allow", "allow"]


def test_calibrated_cutoff():
    assert calibrated([]) == 0.0 and calibrated([(5, True, 3)]) == 0.0
    assert 0.05 >= calibrated([(5, True, 10), (-5, False, 10)]) > -0.05
