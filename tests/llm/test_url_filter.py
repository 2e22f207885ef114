"""URL filter: parsing and rules against plain Python, the model on held-out words."""

import re

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import frame, rows_of
from tracemill.llm import url_filter as U
from tracemill.llm.queries import URL_RULES

URLS = [
    "https://WWW.Example.NET/en/x", "http://example.net/de/", "http://example.net", "http://a.b.example.com/de/1", "http://example.com/dex",
    "https://blog.x.org/fr/9#top", "https://blog.x.org/en/9", "http://notexample.com/de/", "http://net/", "ftp://host.net:80/en/", "no scheme",
    "", None, "http://", "http:///path?x", "a://b://c/d", "http://x.org?u=/fr/", "http://x.org#/fr/", "http://ÄÖ.NET/Ä", "http://org/fr/", "http://example.net/en/?q",
    "http://m.free-bets.example.com/de/216.html", "http://user@x.net/en/", "http://line\nbreak.net/a\nb?c", "http://www.cheap-pills.example.com/fr/176/", "http://x.com/" + "a" * 50_000,
]


def plain(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), re.match(r"[^?#]*", rest[len(host) :])[0]


@pytest.fixture(scope="module")
def model(spark):
    return U.train(U.labelled_urls(spark))


def judged(spark, model, urls):
    return U.judge(frame(spark, list(enumerate(urls)), "page_id long, url string"), model, URL_RULES)


def test_parsing_and_rules(spark, model):
    for r in judged(spark, model, URLS).collect():
        host, path = plain(URLS[r["page_id"]])
        assert (r["host"], r["path"]) == (host, path)
        fitting = []
        for rule in URL_RULES:
            name, _, rest = rule.text.partition("/")
            if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
                fitting.append((len(rule.text), rule))
        if fitting:
            best = max(fitting, key=lambda x: x[0])[1]
            assert (r["rule"], r["verdict"]) == (best.text, best.verdict)
        else:
            assert r["rule"] is None and r["verdict"] == ("block" if r["score"] >= 0.5 else "allow")


def test_model_generalises(spark, model):
    bad = ["https://www.best-casino.example.com/en/5", "http://pills-cheap.example.org/x", "http://xxx-adult.com/", "http://m.poker-bets.example.com/de/1.html"]
    good = ["https://www.ththon.example.com/en/843.html", "https://blog.tionsh.example.org/es/35", "http://city-library.example.com/fr/1", "http://m.thering.example.com/es/22#top"]
    verdicts = [r["verdict"] for r in U.judge(frame(spark, list(enumerate(bad + good)), "page_id long, url string"), model, ()).orderBy("page_id").collect()]
    assert verdicts == ["block"] * 4 + ["allow"] * 4


#: Hosts and paths of everyday pages, and of pages to block, none of which stands in the labelled table.
ORDINARY = """https://www.bbc.co.uk/sport https://www.nytimes.com/2024/05/01/business/ford-profits.html https://www.lemonde.fr/planete/
https://arxiv.org/abs/1706.03762 https://elpais.com/internacional/ https://www.nasa.gov/missions/artemis https://www.nih.gov/about-nih
https://en.wikipedia.org/wiki/Essex https://www.spiegel.de/ausland/ https://www.nature.com/articles/s41586 https://www.mit.edu/admissions
https://stackoverflow.com/questions/11227809 https://www.gov.uk/renew-passport https://www.reuters.com/markets/ https://europa.eu/youth
https://www.who.int/emergencies https://www.cern.ch/accelerators https://www.loc.gov/collections https://www.zeit.de/kultur/ https://www.rtve.es/play""".split()
BLOCKED = """http://pokerstars-bonus.net/ http://www.casinoroyal777.com/play http://megaslots.io/ https://cheapviagra24.info/buy http://live-sexcam.com/
http://pornhd.net/videos http://onlinebetting-tips.com/ http://freecracks.org/keygens http://xxxtube.eu/ http://payday-loans-now.com/apply
http://jackpotcity.de/ http://adult-finder.es/""".split()


def test_accuracy_on_other_hosts(spark, model):
    verdicts = {r["url"]: r["verdict"] for r in U.judge(frame(spark, list(enumerate(ORDINARY + BLOCKED)), "page_id long, url string"), model, ()).collect()}
    wrong = [u for u in ORDINARY if verdicts[u] != "allow"], [u for u in BLOCKED if verdicts[u] != "block"]
    # 18 of 20 and 7 of 12 were right when this was written.
    assert len(wrong[0]) <= 2 and len(wrong[1]) <= 5, wrong


def test_score_equals_a_plain_sum(spark, model):
    import math

    rows = judged(spark, model, URLS[:4]).select("score", U.grams(F.col("host"), F.col("path")).alias("g")).collect()
    for r in rows:
        total = model.bias + sum(model.weights[b] for b in r["g"])
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-total)))


def test_clashing_columns_and_empty_table(spark, model):
    rows = frame(spark, [(1, "http://x.net/", "old", 7), (1, "http://x.net/", "old", 7)], "page_id long, url string, host string, rule int")
    assert rows_of(U.judge(rows, model, URL_RULES), "page_id", "host", "rule", "verdict") == [(1, "x.net", "net/", "block")] * 2
    assert U.judge(rows.limit(0), model, URL_RULES).count() == 0


def test_no_python_in_the_plan(spark, model):
    plan = judged(spark, model, URLS)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
