import base64
import hashlib

from pyspark.sql import functions as F

from strata.llm.queries import op3_warc_index
from strata.llm.warc import capture_index, read_archives, url_key, write_archives
from strata.session import scratch_path
from tests.llm.cases import rows_of

NAMES = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
SMALL = "/root/testdata/sf0.001"
ROWS = [
    (3, "http://a.b/x?y\r\nz%", "<p>é\r\n\r\nWARC/1.1\r\n"), (1, "http://a.b/x", ""), (2, None, None), (4, "q", "<p>é\r\n\r\nWARC/1.1\r\n"),
    (None, "http://c.d/", "zz"), (5, "http://c.d/", "zz"), (5, "http://c.d/", "zz"), (6, "http://c.d/", "end\n"), (7, "", "x" * 3_000_000),
]


def expected(rows, least=0):
    first = {}
    for i, _, h in rows:
        first[h or ""] = min(first.get(h or "", (True, 0)), (i is None, i or 0))
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        at = None if first[h or ""][0] or len(data) < least else first[h or ""][1]
        same = at is None or at == i
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if same else "revisit", None if same else at))
    return sorted(out, key=repr)


def archived(spark, df, **how):
    path = scratch_path(spark, "warc-test")
    write_archives(df, path, **how)
    return read_archives(spark, path)


def test_round_trip(spark):
    df = spark.createDataFrame(ROWS, "page_id long, url string, html string").withColumn("value", F.lit(1))
    for least in (0, 3):
        read = archived(spark, df, least_bytes=least)
        assert rows_of(read, *NAMES) == expected(ROWS, least)
    kept = {(r["page_id"], r["payload"]) for r in read.where("record_type = 'response'").collect()}
    assert kept <= {(i, h or "") for i, _, h in ROWS}
    assert sorted(r["url"] for r in read.collect()) == sorted(u or "" for _, u, _ in ROWS)


def test_index_is_in_global_order(spark):
    df = spark.createDataFrame([(n, f"http://h{n % 3 and n % 5}.x/", f"{n // 4}") for n in range(200)], "page_id long, url string, html string")
    rows = sorted(capture_index(archived(spark, df.repartition(5)), 4).collect(), key=lambda r: (r["range"], r["place"]))
    order = [(r["url_key"], r["captured"], r["page_id"]) for r in rows]
    assert len(order) == 200 and order == sorted(order) and len({r["range"] for r in rows}) == 4
    assert url_key("https://A.b.C/x/y?z") == "c,b,a)/x/y?z"


def test_empty_table(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert capture_index(archived(spark, df)).count() == 0


def test_query_over_the_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", "url", "html").collect()]
    assert rows_of(op3_warc_index(spark, SMALL), *NAMES) == expected(rows)
