"""Files by their own headers: no value and no line is lost without a trace."""

import json
import os

import pytest
from pyspark.sql import functions as F

from strata.operators.rescue import RESCUED, typed_parse
from strata.session import scratch_path
from strata.sources import loads
from strata.sources.files import land_csv, many_lines, one_line, read_feed
from strata.sources.named import BATCH, HEADERS, by_header, header_names, headers_of, literal_path
from strata.sources.versions import STEP
from strata.streaming import ingest

FEED = "a STRING, b INT"


def _write(folder, files):
    for name, text in files.items():
        path = f"{folder.removeprefix('file:')}/{name}"
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w", newline="") as file:
            file.write(text)


def _load(spark, folder):
    target = loads.load_target(spark, scratch_path(spark, "rows"), FEED)
    loads.load_new_files(target, folder, FEED, "s")
    return target


def _stream(spark, folder):
    target = loads.load_target(spark, scratch_path(spark, "rows"), FEED)
    ingest.stream_rescue(spark, folder, FEED, target, scratch_path(spark, "ck"), "s")
    return target


CASES = {
    f"{BATCH}=1/plain.csv": "a,b\nx,1\n",
    f"{BATCH}=1/turned.csv": "b,a\n2,y\n",
    f"{BATCH}=2/wider.csv": 'b,c,a\n3,"deep, ""end""",z\n4,,w\n',
    f"{BATCH}=2/narrow.csv": "a\nonly\n",
    f"{BATCH}=2/ragged.csv": "a,b\n1,2,3,4\n5\nq,6\n",
    f"{BATCH}=3/types.csv": "a,b\nt,many\n",
    f"{BATCH}=3/a b%20c.csv": "\ufeff a , b \r\nspaced,7\r\n",
    f"{BATCH}=3/header only.csv": "a,b\n",
    f"{BATCH}=3/empty.csv": "",
    f"{BATCH}=3/twice.csv": "a,a,b\nfirst,second,8\n",
    f"{BATCH}=3/blank.csv": "\n\na,b\nafter,9\n",
    "no batch/foreign.csv": "k,v\n1,2\n",
}
ROWS = [
    ("1", 2, {"_corrupt_record": "1,2,3,4"}, 2),
    ("5", None, {"_corrupt_record": "5"}, 2),
    ("after", 9, None, 3),
    ("first", 8, {"a (2)": "second"}, 3),
    ("only", None, None, 2),
    ("q", 6, None, 2),
    ("spaced", 7, None, 3),
    ("t", None, {"b": "many"}, 3),
    ("w", 4, None, 2),
    ("x", 1, None, 1),
    ("y", 2, None, 1),
    ("z", 3, {"c": 'deep, "end"'}, 2),
    (None, None, {"k": "1", "v": "2"}, None),
]


@pytest.mark.parametrize("way", [_load, _stream])
def test_values_land_by_name_and_the_rest_is_kept(spark, way):
    folder = scratch_path(spark, "by-name")
    _write(folder, CASES)
    rows = [(r["a"], r["b"], r[RESCUED] and json.loads(r[RESCUED]), r[BATCH]) for r in way(spark, folder).rows().collect()]
    assert sorted(rows, key=lambda r: (r[0] is None, r[0])) == ROWS


def test_nothing_is_loaded_twice_and_blank_files_count_as_loaded(spark):
    folder = scratch_path(spark, "again")
    # Spark lists no file of length 0; one without a line of text is loaded and has no rows
    _write(folder, {"1/a.csv": "a,b\nx,1\n", "1/blank.csv": "\n \n", "1/empty.csv": ""})
    target = _load(spark, folder)
    assert loads.load_new_files(target, folder, FEED, "s") == 0
    _write(folder, {"2/b.csv": "b,a\n2,y\n"})
    assert loads.load_new_files(target, folder, FEED, "s") == 1
    assert sorted(r["a"] for r in target.rows().collect()) == ["x", "y"]
    assert target.commits().select("file_path").distinct().count() == 3


def test_a_stream_goes_on_where_it_stopped(spark):
    folder, ck = scratch_path(spark, "go-on"), scratch_path(spark, "ck")
    target = loads.load_target(spark, scratch_path(spark, "rows"), FEED)
    for k, text in enumerate(("a,b\nx,1\n", "", "b,a,c\n2,y,z\n")):
        _write(folder, {f"{BATCH}={k}/f.csv": text})
        for _ in range(2):
            ingest.stream_rescue(spark, folder, FEED, target, ck, "s", files_per_trigger=1)
    assert sorted((r["a"], r[BATCH]) for r in target.rows().collect()) == [("x", 0), ("y", 2)]


def test_line_ends_inside_texts(spark):
    folder = scratch_path(spark, "ends")
    _write(folder, {"f.csv": 'b,a\n1,"two\nlines"\n'})
    target = loads.load_target(spark, scratch_path(spark, "rows"), FEED)
    loads.load_new_files(target, folder, FEED, "s", line_ends=True)
    assert [tuple(r) for r in target.rows().select("a", "b", RESCUED).collect()] == [("two\nlines", 1, None)]


def test_headers_are_learnt_from_the_first_block_of_each_file(spark):
    folder = scratch_path(spark, "large")
    _write(folder, {f"{k}.csv": f"a,b{k}\n" + "x,1\n" * 200_000 for k in range(2)})
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        lines = spark.read.text(folder).select("value", "_metadata")
        assert lines.rdd.getNumPartitions() > 8
        assert sorted(h for _, h in headers_of(lines)) == ["a,b0", "a,b1"]
        target = _load(spark, folder)
        counts = {r["n"]: r["rows"] for r in target.rows().groupBy(F.get_json_object(RESCUED, "$.b1").alias("n")).agg(F.count("*").alias("rows")).collect()}
        assert counts == {"1": 200_000, None: 200_000}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_very_many_headers_take_several_steps(spark):
    folder = scratch_path(spark, "many")
    _write(folder, {f"{k}.csv": f"a,b,c{k}\nx,{k},extra\n" for k in range(HEADERS + 6)})
    target = _load(spark, folder)
    assert target.commits().select(STEP).distinct().count() == 2
    rows = target.rows().collect()
    assert all(json.loads(r[RESCUED]) == {f"c{r['b']}": "extra"} for r in rows) and len(rows) == HEADERS + 6


def test_groups_are_bounded():
    files = [(f"p{k}", "a,b" if k % 2 else "b,a") for k in range(25)]
    parts = list(by_header(files, most_files=5))
    assert sorted(p for part in parts for _, paths in part for p in paths) == sorted(p for p, _ in files)
    assert max(sum(len(paths) for _, paths in part) for part in parts) <= 5
    assert header_names('x, "y, z" ,x,x') == ("x", '"y', 'z"', "x (2)", "x (3)") or header_names('x,"y, z",x') == ("x", "y, z", "x (2)")
    assert literal_path("a[1]{b}*?\\") == "a\\[1\\]\\{b\\}\\*\\?\\\\"


def test_a_strict_read_refuses_ragged_lines_and_a_lenient_one_marks_them(spark):
    folder = scratch_path(spark, "strict")
    _write(folder, {"f.csv": "a,b\nx,1\ny\n"})
    with pytest.raises(Exception, match="MALFORMED_RECORD|FAILFAST"):
        read_feed(spark, folder, "a STRING, b STRING").select("a").collect()
    rows = typed_parse(read_feed(spark, folder, "a STRING, b STRING", ragged=True), {"b": "int"}).collect()
    assert sorted((r["a"], r["b"], r[RESCUED]) for r in rows) == [("x", 1, None), ("y", None, '{"_corrupt_record":"y"}')]


def test_a_strict_stream_stops_at_ragged_lines(spark):
    folder = scratch_path(spark, "strict-stream")
    _write(folder, {f"{BATCH}=1/f.csv": "a,b\nx,1,2\n"})
    with pytest.raises(Exception, match="MALFORMED_RECORD|FAILFAST|STREAM_FAILED"):
        ingest.stream_ingest(spark, folder, "a STRING, b STRING", scratch_path(spark, "out"), scratch_path(spark, "ck"), "s")


def test_typed_parse_keeps_what_was_rescued_before(spark):
    df = spark.createDataFrame([("1", '{"c":"x"}'), ("no", '{"c":"x"}'), ("no", None), ("2", None)], f"b STRING, {RESCUED} STRING")
    rows = [(r["b"], r[RESCUED] and json.loads(r[RESCUED])) for r in typed_parse(df, {"b": "int"}).collect()]
    assert rows == [(1, {"c": "x"}), (None, {"b": "no", "c": "x"}), (None, {"b": "no"}), (2, None)]


def test_marked_line_ends_come_back_and_files_are_split(spark):
    texts = ["a\nb", "\\", "\\n\n", "\\\r\\1\\0", "\r\n", "plain", "\\2\r2", None, ' "q",\n']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n INT, t STRING")
    flat = one_line(df)
    assert not any(set(r["t"] or "") & {"\n", "\r"} for r in flat.collect())
    assert many_lines(flat).collect() == df.collect()
    large = spark.range(20_000).selectExpr("cast(id AS INT) AS n", "concat('line ', id, decode(X'0A', 'UTF-8'), 'next ', id) AS t")
    folder = scratch_path(spark, "marked")
    land_csv(large.coalesce(1), folder, marked_ends=True)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        back = read_feed(spark, folder, "n INT, t STRING", marked_ends=True)
        assert len(back.inputFiles()) == 1 and back.rdd.getNumPartitions() > 4
        assert back.exceptAll(large).isEmpty() and large.exceptAll(back).isEmpty()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
