"""One large JSON page, read by byte ranges, equals the whole read."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.sources import json_pages, markets

PAGE = T.StructType([T.StructField("data", T.ArrayType(markets.ANALYTICS_ENTRY_SCHEMA))])
FIELDS = list(markets.ANALYTICS_FIELDS)


def whole_read(spark, path):
    pages = spark.read.schema(PAGE).option("multiLine", "true").json(path)
    return pages.select(F.explode("data").alias("e")).where("e IS NOT NULL").select("e.*")


def comparable(rows):
    """Rows as text; nested values without the page's white space."""
    compact = lambda v: json.dumps(json.loads(v)) if v and v[0] in "[{" and v[-1] in "]}" and not v.startswith("[1]") else v
    return sorted(str([compact(v) for v in r]) for r in rows)


def entries(n, seed=1):
    rng = random.Random(seed)
    odd = ['say "hi"', "back\\slash\\", 'brace } in { text', "[1] ]", "quote\\\" and }", "é ü 漢字  ", "", "tab\tline\nend", '"}', '\\"}', "a,b"]
    return [{"market_id": str(i), "event_tags": rng.choice([["Politics", rng.choice(odd)], [], None, "text"]), "event_title": rng.choice(odd) * rng.randint(0, 4),
             "event_description": {"nested": [{"deep": rng.choice(odd)}, []]} if i % 7 == 0 else rng.choice(odd), "market_volume": rng.choice([1, 2.5, "3", None])} for i in range(n)]


def write(folder, name, text):
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        f.write(text)


@pytest.mark.parametrize("range_bytes", ["200b", "1k", "7k", "64m"])
@pytest.mark.parametrize("indent", [None, 2])
def test_ranges_equal_whole_read(spark, workdir, range_bytes, indent):
    data = entries(120)
    write(workdir, "a.json", json.dumps({"meta": {"n": [{"x": 1}, {"data": [{"market_id": "no"}]}]}, "other": [{"market_id": "no"}], "data": data, "tail": [{"market_id": "no"}]}, indent=indent, ensure_ascii=False))
    write(workdir, "b.json", json.dumps({"data": entries(30, 2)}, indent=indent) + "\n")
    write(workdir, "c.json", json.dumps({"data": []}) + " \n ")
    write(workdir, "d.json", json.dumps({"data": [None, 5, "x", {"market_id": "only"}], "more": {}}))
    spark.conf.set("spark.sql.files.maxPartitionBytes", range_bytes)
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    try:
        got = markets.read_analytics(spark, workdir)
        rows = got.collect()
        parts = json_pages.page_ranges(spark, workdir).rdd.getNumPartitions()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    # a null or scalar entry makes the whole read drop its page
    got_rows = comparable([r[f] for f in FIELDS] for r in rows if r._file != "d.json")
    assert got_rows == comparable(whole_read(spark, f"{workdir}/[abc].json").select(FIELDS).collect())
    assert [r.market_id for r in rows if r._file == "d.json"] == ["only"]
    in_order = [r.market_id for r in sorted(rows, key=lambda r: r._pos) if r._file == "a.json"]
    assert in_order == [str(i) for i in range(120)]
    assert parts > 20 if range_bytes in ("200b", "1k") else True


@pytest.mark.parametrize("text", ['{"data": [{"market_id": "1"}', '{"data": [{"market_id": "1"}]}}', '{"data": [{"market_id": "1}]}', '{"data": [{"market_id": 1 "x"}]}'])
def test_malformed_page_raises(spark, workdir, text):
    write(workdir, "a.json", text)
    with pytest.raises(Exception):
        markets.read_analytics(spark, workdir).collect()


def test_page_without_entries(spark, workdir):
    write(workdir, "a.json", '{"message": "none"}')
    write(workdir, "b.json", "[]")
    assert markets.read_analytics(spark, workdir).collect() == []


def test_pages_of_one_range_are_cut_once(spark, workdir):
    """only pages that are dealt out in ranges are read again for fragments."""
    for n in range(3):
        with open(f"{workdir}/{n}.json", "w") as out:
            out.write('{"data": [{"market_id": "%d"}, {"market_id": "x}"}]}' % n)
    found = markets.read_analytics(spark, workdir)
    assert sorted((r._file, r.market_id) for r in found.collect()) == [(f"{n}.json", m) for n in range(3) for m in (str(n), "x}")]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
