import re

from pyspark.sql import functions as F

from strata.llm.queries import URL_RULES, op9_url_filter
from strata.llm.url_filter import UrlRules, judge_urls
from tests.llm.cases import rows_of

SMALL = "/root/testdata/sf0.001"
NAMES = ("page_id", "host", "path", "rule", "verdict")


def expected(rows, rules):
    out = []
    for i, url in rows:
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        fits = [
            (len(r), r, v) for v, r in rules.rules
            if (host == (h := r.partition("/")[0]) or host.endswith("." + h)) and path.startswith(r[len(h) :])
        ]
        term = lambda t, s=(host + path).lower(): re.search(rf"(?<![^\W_]){re.escape(t)}(?![^\W_])", s)
        bad = any(map(term, rules.strict)) or sum(map(bool, map(term, rules.soft))) >= rules.soft_needed
        _, rule, verdict = max(fits, default=(0, None, "block" if bad else "allow"))
        out.append((i, host, path, rule, verdict))
    return sorted(out, key=repr)


def test_cases(spark):
    urls = [
        None, "", "no scheme", "http://", "HTTP://WWW.Example.ORG/es/x?q#f", "http://example.org/en/1x", "http://example.org/en/2", "http://notexample.org/es/", "https://a.com/fr/?x",
        "https://a.com/de/", "https://com/de/", "https://a.com", "http://org/", "http://org", "http://x.org:80/", "http://É.net/É#/", "http://a.net/porn/", "http://a.net/pornography", "http://a.net/cheap/free",
        "http://a.net/cheap-cheap", "http://freebets.net/", "http://free.bet.net/", "http://a.net/b://c/d", "http://a.net/\nporn", "http://a..org/x", "http://a.net/" + "p" * 5000,
    ]
    rows = [(n, u) for n, u in enumerate(urls)] + [(None, "http://a.net/xxx"), (3, "http://"), (3, "http://")]
    df = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit("clash")).withColumn("id", F.lit(1))
    assert rows_of(judge_urls(df, rules=URL_RULES), *NAMES) == expected(rows, URL_RULES)
    plain = UrlRules(strict=("a.net",), soft=("b", "c", "d"), soft_needed=3)
    assert rows_of(judge_urls(df, rules=plain), *NAMES) == expected(rows, plain)
    assert rows_of(judge_urls(df, rules=UrlRules(strict=(), soft=())), *NAMES) == expected(rows, UrlRules(strict=(), soft=()))
    assert judge_urls(df.limit(0)).count() == 0


def test_query_over_the_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", "url").collect()]
    assert rows_of(op9_url_filter(spark, SMALL), *NAMES) == expected(rows, URL_RULES)
