"""What keeps queries whole on grown tables."""

import re
import tracemalloc
import unicodedata

import pyarrow as pa
from pyspark.sql import functions as F

from countryrank.functions import text
from countryrank.operators import attribution
from countryrank.plans import entries, io_entries

SF = "/root/testdata/sf0.001"


def test_places_are_not_broadcast(spark):
    """Tables of places and locations grow; only the phrases, which are counted first, go through the driver."""
    config = spark.createDataFrame([("LK", "alias", "sri lanka", "Sri Lanka", 1), ("LK", "place", "colombo", "Colombo", 1), ("LK", "exact", "lk", "lk", 1)], "code string, kind string, norm string, term string, seq long")
    regions = spark.createDataFrame([("LK", "sri lanka"), ("DE", "germany")], "code string, norm string")
    pairs = spark.createDataFrame([("Colombo", "LK"), ("Colombo, LK", "LK"), ("Berlin, Germany", "LK"), (" ", "LK")], "location string, code string")
    out = attribution.attribute_location(pairs, config, regions)
    keys = re.findall(r"BroadcastHashJoin \[(.*?)\], \[", out._jdf.queryExecution().executedPlan().toString())
    assert keys and all(re.fullmatch(r"norm#\d+", k) for k in keys)
    assert sorted((r[0], r[1].evidence) for r in out.select("location", "attribution").collect()) == [(" ", "missing-location"), ("Berlin, Germany", "foreign-country"), ("Colombo", "recognized-place"), ("Colombo, LK", "country-code-with-place")]


def test_no_certified_country_gives_no_rows(spark, monkeypatch):
    monkeypatch.setattr(io_entries, "_frontier", lambda b, *_: spark.createDataFrame([(10**9,)], "frontier long"))
    assert entries.QUERIES["publish_certified"](spark, SF).collect() == []


def test_marks_are_stripped_in_slices():
    said = ["Zürich", None, "", "plain", "éa", "ﬁn", "กำ", "Ω" * 4000]
    want = [t and unicodedata.normalize("NFC", "".join(c for c in unicodedata.normalize("NFKD", t) if not 0x300 <= ord(c) <= 0x36F)) for t in said]
    assert text.strip_marks.func(pa.array(said)).to_pylist() == want
    assert text.strip_marks.func(pa.array([], pa.string())).to_pylist() == []
    many = pa.array(["é" * 4000] * 1500)
    tracemalloc.start()
    done = text.strip_marks.func(many)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(done) == 1500 and done[1499].as_py() == "e" * 4000 and most < 4 << 20


def test_pages_are_written_once_and_read_apart(spark):
    raw = io_entries._by_page(spark.range(30).select((F.col("id") % 3).cast("int").alias("page"), F.col("id").alias("seq")))
    one = raw.filter("page = 1")
    assert one.count() == 10 and {re.search(r"page=(\d)", f)[1] for f in raw.inputFiles()} == {"0", "1", "2"}
    assert "PartitionFilters: [isnotnull(page" in one._jdf.queryExecution().toString()
