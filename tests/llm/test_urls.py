import random
import re

from tablexport.llm import urls
from tablexport.llm.queries import URL_RULES
from tests.llm import helpers


def plain(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host):])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = []
    for rule, verdict in URL_RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fits.append((len(rule), rule, verdict))
    return host, path, max(fits)[1:] if fits else None


ODD = [None, "", "example.com/en/", "http://", "http://example.com", "http://EXAMPLE.com/en/x", "https://www.Example.com/en/1?q=1#f", "http://a.example.com/en/",
       "http://notexample.com/en/", "x://y://z.net/es/", "http://net/es/", "http://net/ES/", "http://com#/x", "http://com?/x", "http://a.com:80/", "http://É.com/é/\n/x",
       "http://b.org/" + "9" * 3_000, "http://b.org/a?x=1&y=2&z=3", "http://b.org/a?x=1&y=2&z=3"]


def test_hosts_paths_and_rules(spark):
    rows = [(i, u) for i, u in enumerate(ODD)] + [(None, ODD[5])]
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], "page_id long, url string, html string, host string, suffix string")
    out = urls.judge(df, URL_RULES, trees=2).collect()
    assert len(out) == len(rows)
    for r in out:
        url = ODD[5] if r["page_id"] is None else ODD[r["page_id"]]
        host, path, fit = plain(url)
        assert (r["host"], r["path"]) == (host, path) and r["rule"] == (fit[0] if fit else None)
        assert r["verdict"] == fit[1] if fit else r["verdict"] in ("allow", "block") and r["p_block"] is not None
    assert urls.judge(df.limit(0), URL_RULES).count() == 0
    # nothing to learn from: what no rule covers is allowed
    assert {r["verdict"] for r in urls.judge(df, []).collect()} == {"allow"}


def test_trees_on_held_out_urls(spark):
    rnd = random.Random(14)

    def url(bad):
        host = f"{'m' if bad else 'www'}.{rnd.choice(['site', 'news', 'shop'])}{rnd.randrange(9)}.{'biz' if bad and rnd.random() < 0.7 else 'org'}"
        tail = "".join(rnd.choice("0123456789abcdef") for _ in range(24)) if bad else "/".join(rnd.choice(["about", "story", "blog", "docs"]) for _ in range(3))
        return f"http://{host}/{tail}" + ("?a=1&b=2&c=3" if bad else "")

    rows = [(i, url(i % 2), i % 2) for i in range(1_200)]
    train = spark.createDataFrame([(u, b) for _, u, b in rows[:800]] + [(None, None)], "url string, blocked int")
    out = urls.judge(spark.createDataFrame(rows[800:], "page_id long, url string, blocked int"), [], train).collect()
    truth = {i: b for i, _, b in rows}
    assert sum((r["verdict"] == "block") == truth[r["page_id"]] for r in out) > 0.97 * len(out)


def test_pages(spark):
    pages = spark.read.parquet(f"{helpers.SF}/pages.parquet")
    text = {r["page_id"]: r["url"] for r in pages.collect()}
    for r in urls.judge(pages, URL_RULES, trees=3).collect():
        host, path, fit = plain(text[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, fit[0] if fit else None)
