import base64
import collections
import hashlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from flowwarden.llm import warc
from flowwarden.llm.common import ready, table


def want(rows):
    """(bytes, digest, type, refers_to) by hand; rows: key, html."""
    last = collections.defaultdict(list)
    for key, html in rows:
        last[html or ""].append(key)
    out = []
    for key, html in rows:
        data = (html or "").encode()
        keys = [k for k in last[html or ""] if k is not None]
        top = max(keys, default=None)
        again = top is not None and key != top
        out.append((key, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if again else "response", top if again else None))
    return sorted(out, key=str)


def got(spark, df, version):
    back = warc.read_warc(spark, warc.convert_archives(warc.arc_files(df, "page_id", "url", "html", version)))
    return sorted((tuple(r) for r in back.select("key", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


@pytest.mark.parametrize("version", [1, 2])
def test_pages_with_copies(spark, sf, version):
    pages = table(ready(spark), sf, "pages")
    copies = pages.where("page_id % 3 = 0").withColumn("page_id", F.col("page_id") + 1_000_000)
    same = pages.select((F.col("page_id") + 5_000_000).alias("page_id"), "url", F.lit("one html for all").alias("html"))
    df = pages.unionByName(copies).unionByName(same)
    assert got(spark, df, version) == want([(r["page_id"], r["html"]) for r in df.collect()])


@pytest.mark.parametrize("version", [1, 2])
def test_edges(spark, version):
    rows = [
        (1, None, None), (2, "http://a b\n/ ", ""), (3, "u", "\r\n\r\nWARC/1.0\r\n\r\n"), (4, "u", "x\n1 0 y\n"), (None, "u", "lone"),
        (5, "u", "same"), (5, "u", "same"), (6, "u", "same"), (7, "u", "é" * 300_000), (8, "u", "\r\n\r\n"), (9, "u", "ends\r\n"),
    ]
    df = spark.createDataFrame([(*r, "k", "d") for r in rows], "page_id long, url string, html string, key string, payload string")
    assert got(spark, df, version) == want([(r[0], r[2]) for r in rows])
    assert got(spark, df.where("false"), version) == []


def test_fields_of_both_versions():
    one = b"filedesc://x.arc 0.0.0.0 19980101000000 text/plain 76\n1 0 InternetArchive\nURL IP-address Archive-date Content-type Archive-length\n\n" \
        b"http://a/ 1.2.3.4 19990203040506 text/html 5\nhello\n"
    ((own, body),) = warc.arc_records(one)
    assert body == b"hello" and own["URL"] == "http://a/" and warc.iso_date(own["Archive-date"]) == "1999-02-03T04:05:06Z"
    two = warc.arc_start(2, "x.arc", "19980101000000") + b"http://a b/ 1.2.3.4 1999 text/html 404 sum - 0 x.arc 3\nabc\n"
    ((own, body),) = warc.arc_records(two)
    assert (own["URL"], own["Result-code"], body) == ("http://a b/", "404", b"abc")
    assert warc.iso_date("1999") == "1999-01-01T00:00:00Z"


@pytest.mark.parametrize("broken", [b"no length\n", b"filedesc://x 0 0 t 400\nshort", b"http://a 0 0 t 3\n9 0\n", b"line without end"])
def test_broken_archives_raise(broken):
    with pytest.raises(ValueError):
        list(warc.arc_records(broken))


def test_ids_are_unique_and_dates_kept(spark, sf):
    pages = table(spark, sf, "pages")
    records = warc.convert(warc.arc_files(pages, "page_id", "url", "html", 2, "20110309080706"))
    rows = records.select("record_id", "date", "type").collect()
    assert len({r["record_id"] for r in rows}) == len(rows) and {(r["date"], r["type"]) for r in rows} == {("2011-03-09T08:07:06Z", "response")}


def test_files_are_bounded_by_bytes(spark, tmp_path):
    rows = [(i, "u", f"{i}" * 20_000) for i in range(60)] + [(100, "u", "x" * 1_000_000)]
    df = ready(spark).createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    records = warc.convert(warc.arc_files(df, "page_id", "url", "html"))
    warc.write_warc(warc.revisits(records, records), f"{tmp_path}/out", compression="none", limit=200_000)
    files = [f.read_bytes() for f in (tmp_path / "out").glob("part-*")]
    assert len(files) > 5 and all(len(f) < 200_000 + 50_000 or f.count(b"WARC/1.0") <= 7 for f in files)
    for f in files:
        (info, _), *others = warc.warc_records(f)
        assert info["warc-type"] == "warcinfo" and others
        assert all(own["warc-block-digest"] == f"sha1:{warc.digest32(block)}" for own, block in others)
    assert warc.read_warc(spark, f"{tmp_path}/out").count() == len(rows)
    broken = files[0].replace(b"0000", b"0001", 1)
    with pytest.raises(ValueError):
        list(warc._read([pa.RecordBatch.from_arrays([pa.array([broken])], ["content"])]))
