import base64
import hashlib

import pytest

from tripfold.llm import warc

PAGES = [(1, "http://a/1", "<p>x</p>"), (2, "http://a/2", "<p>x</p>"), (3, None, "<p>é</p>"), (4, "http://a/4", None), (5, "u", ""), (9, "http://a/9", "<p>x</p>"), (9, "http://a/9", "<p>x</p>"),
         (7, "http://b/\r\nX: y", "line\r\n\r\nWARC-Type: response\r\n"), (8, "http://b/8", "z" * 200_000), (None, "http://n", "<p>x</p>"), (None, "http://n", "only null")]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*p, "x", b"y") for p in PAGES], "page_id long, url string, html string, sha256 string, payload binary").repartition(3)


def test_round_trip_matches_brute_force(pages):
    got = warc.round_trip(pages).collect()
    want = []
    for i, _, h in PAGES:
        raw = (h or "").encode()
        top = max((j for j, _, k in PAGES if (k or "") == (h or "") and j is not None), default=None)
        kind = "response" if i == top else "revisit"
        want.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), kind, None if kind == "response" else top))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_records_are_rebuilt_byte_by_byte(spark, pages, tmp_path):
    path = warc.archive(pages, f"file://{tmp_path}/archive")
    assert spark.read.parquet(f"{path}/payloads").count() == len({h or "" for _, _, h in PAGES})
    records = warc.records(spark, path).collect()
    assert len(records) == len(PAGES)
    by_id = {i: (u, h) for i, u, h in PAGES}
    for r in records:
        head, _, rest = bytes(r.record).partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        fields = dict(x.split(": ", 1) for x in lines[1:])
        assert lines[0] == "WARC/1.1" and rest.endswith(b"\r\n\r\n")
        body = rest[:-4]
        assert len(body) == int(fields["Content-Length"])
        if r.page_id is not None and fields["WARC-Type"] == "response":
            assert body.decode() == (by_id[r.page_id][1] or "")
        if fields["WARC-Type"] == "revisit":
            assert not body and "WARC-Refers-To" in fields


def test_small_payloads_are_all_responses(spark, pages, tmp_path):
    path = warc.archive(pages, f"file://{tmp_path}/small", min_bytes=100)
    assert warc.read(spark, path).where("record_type = 'revisit'").count() == 0


def test_damaged_payload_is_an_error(spark, pages, tmp_path):
    path = warc.archive(pages, f"file://{tmp_path}/damaged")
    rows = spark.read.parquet(f"{path}/payloads").selectExpr("concat(substring(sha256, 1, 63), 'g') AS sha256", "member").collect()
    spark.createDataFrame(rows, "sha256 string, member binary").write.mode("overwrite").parquet(f"{path}/payloads")
    with pytest.raises(Exception, match="does not have its digest"):
        warc.verified_payloads(spark, path).collect()


def test_the_query_reads_rebuilt_records(spark, pages, tmp_path):
    path = warc.archive(pages, f"file://{tmp_path}/wrong")
    heads = spark.read.parquet(f"{path}/headers").collect()
    digest = base64.b32encode(hashlib.sha1(b"z" * 200_000).digest()).decode()

    def with_headers(change):
        rows = [(r.page_id, r.sha256, change(bytes(r.header))) for r in heads]
        spark.createDataFrame(rows, "page_id long, sha256 string, header binary").write.mode("overwrite").parquet(f"{path}/headers")
        return warc.read(spark, path)

    with pytest.raises(Exception, match="wrong payload digest in record of page 8"):
        with_headers(lambda h: h.replace(digest.encode(), b"A" * 32)).collect()
    with pytest.raises(Exception, match="not as long as it says"):
        with_headers(lambda h: h.replace(b"Content-Length: 200000", b"Content-Length: 200001")).collect()
    assert with_headers(lambda h: h).count() == len(PAGES)


def test_empty_table(pages):
    assert warc.round_trip(pages.where("false")).count() == 0
