import base64
import gzip
import hashlib
import glob

import pytest
from strata.llm import warc
from strata.llm.queries import op1_warc_index
from strata.session import scratch_path


def expected(pages, min_bytes=0):
    head = {}
    for p, _, h in pages:
        b = (h or "").encode()
        if p is not None and len(b) >= min_bytes:
            head[b] = max(p, head.get(b, p))
    out = []
    for p, _, h in pages:
        b = (h or "").encode()
        again = p is not None and len(b) >= min_bytes and head[b] != p
        out.append((p, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if again else "response",
                    head[b] if again else None))
    return sorted(out, key=repr)


PAGES = [(1, "http://www.a.org:80/x?y#z", "same"), (2, "http://www.a.org/x?y", "same"), (3, "https://b.com:8443/", "x\r\n\r\ny\x00z"),
         (4, None, None), (5, "not a url\nat all é", ""), (6, "http://a.org/é", "é" * 30_000), (6, "http://a.org/é", "é" * 30_000),
         (None, "http://www.a.org/x?y", "same"), (7, "http://www.a.org/x?y", "same"), (8, "http://[bad", "<p>")]


@pytest.mark.parametrize("least", [0, 3, 5])
def test_round_trip(spark, least):
    df = spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, record_type string").repartition(3)
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.round_trip(df, min_bytes=least).collect()]
    assert sorted(got, key=repr) == expected(PAGES, least)


def test_lookup_and_files(spark):
    root = scratch_path(spark, "warc-test")
    rows = [(i, f"http://h{i % 3}.org/p{i % 40}", f"<p>{i}</p>" * (i % 50)) for i in range(600)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    warc.write_archives(df, f"{root}/a", file_bytes=2_000)
    store = warc.build_index(spark, f"{root}/a", f"{root}/i", lines_per_block=8)
    files = glob.glob(f"{root.removeprefix('file:')}/a/part-*")
    assert len(files) > 3
    # any gzip reader opens a file as one stream of records
    assert sum(gzip.open(f).read().count(b"WARC/1.1\r\n") for f in files) == 600
    for url in ("http://h1.org/p1", "http://H1.org:80/p1#frag", "http://none.org/"):
        want = {i: h for i, u, h in rows if warc.capture_key(u) == warc.capture_key(url)}
        got = warc.fetch(spark, store, url)
        assert {g["page_id"] for g in got} == set(want)
        assert all(g["payload"].decode() == want[g["page_id"]] for g in got if g["record_type"] == "response")


def test_query(spark, sf_small):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_small}/pages.parquet").select("page_id", "url", "html").collect()]
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in op1_warc_index(spark, sf_small).collect()]
    assert sorted(got, key=repr) == expected(rows)


def test_no_pages(spark):
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_keys():
    assert warc.capture_key("http://www.a.org:80/x?y#z") == "org,a,www)/x?y"
    assert warc.capture_key("https://b.com:8443") == "com,b:8443)/"
