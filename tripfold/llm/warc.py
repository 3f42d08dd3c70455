"""Content-addressed WARC archive (operator 5).

``archive`` writes two tables. ``payloads`` holds every distinct payload once,
under its SHA-256, as a gzip member; ``headers`` holds one row per record: the
exact bytes of its WARC header and the digest. Equal payloads are collapsed by
digest inside each map task before the shuffle, so a payload that a third of
all pages share is shuffled once per task. The record of the largest page_id
is the response, the others are revisits that name it.

``read`` goes back: payloads are unpacked and their digests recomputed (a
mismatch is an error), the headers are parsed, response records are rebuilt
byte by byte by a join on the digest, and revisits find the payload's facts by
the same digest. Only narrow rows join many-to-one; payload bytes join their
one response.

Defined cases: null html is an empty payload; null url is written as an empty
target; a null page_id counts as smaller than any other. Rows that repeat the
largest page_id of a payload are all responses. An empty table makes an empty
archive. Payloads smaller than ``min_bytes`` are all responses.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripfold.llm.shared import prepare, salted_join, shared_dir, stored

MIN_BYTES = 0
VERSION = "WARC/1.1"
#: The generated pages have no fetch time, so records carry this one.
DATE = "2024-01-01T00:00:00Z"
SALTS = 16
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32(hex_digest: Column) -> Column:
    """Upper-case base32 of a hex string whose length is a multiple of five (SHA-1: 40 → 32 characters)."""
    out = []
    for i in range(0, 40, 5):
        part = F.conv(F.substring(hex_digest, i + 1, 5), 16, 10).cast("int")
        out += [F.substring(F.lit(_ALPHABET), F.shiftright(part, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*out)


def _facts(pages: DataFrame, page_id: str, url: str, html: str) -> DataFrame:
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    return pages.select(F.col(page_id).alias("page_id"), F.coalesce(F.col(url), F.lit("")).alias("url"),
                        F.octet_length(payload).cast("long").alias("size"), F.sha2(payload, 256).alias("sha256"), base32(F.sha1(payload)).alias("sha1"))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(sha256, gzip member) of each payload, once per batch."""
    for batch in batches:
        seen: dict[str, bytes] = {}
        for value in batch.column("html"):
            raw = (value.as_py() or "").encode()
            key = hashlib.sha256(raw).hexdigest()
            if key not in seen:
                pack = zlib.compressobj(6, zlib.DEFLATED, 31)
                seen[key] = pack.compress(raw) + pack.flush()
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.binary())], names=["sha256", "member"])


def record_headers(facts: DataFrame, responses: DataFrame) -> DataFrame:
    """page_id, sha256, header: the WARC header block of each record, CRLF lines up to and with the empty line."""
    joined = salted_join(facts, responses, "sha256", SALTS)
    revisit = (F.col("size") >= F.col("min_bytes")) & ~F.col("page_id").eqNullSafe(F.col("response_id"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    record = lambda i: F.concat(F.lit("<urn:page:"), F.coalesce(i.cast("string"), F.lit("")), F.lit(">"))
    header = F.concat(
        F.lit(f"{VERSION}\r\n"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", record(F.col("page_id"))),
        line("WARC-Date", F.lit(DATE)),
        line("WARC-Target-URI", F.translate("url", "\r\n", "")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
                                 line("WARC-Refers-To", record(F.col("response_id"))))).otherwise(F.lit("")),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("size").cast("string"))),
        F.lit("\r\n"),
    )
    return joined.select("page_id", "sha256", header.cast("binary").alias("header"))


def archive(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = MIN_BYTES) -> str:
    """Write ``pages`` as an archive below ``path`` (tables ``payloads`` and ``headers``); returns ``path``."""
    prepare(pages.sparkSession)
    facts = _facts(pages, page_id, url, html)
    responses = facts.groupBy("sha256").agg(F.max("page_id").alias("response_id")).withColumn("min_bytes", F.lit(min_bytes))
    record_headers(facts, responses).write.parquet(f"{path}/headers")
    members = pages.select(F.col(html).alias("html")).mapInArrow(_packed, "sha256 string, member binary")
    members.groupBy("sha256").agg(F.first("member").alias("member")).write.option("compression", "none").parquet(f"{path}/payloads")
    return path


def _verified(with_bytes: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sizes, digests, raws = [], [], [], []
            for key, member in zip(batch.column("sha256").to_pylist(), batch.column("member"), strict=True):
                raw = zlib.decompress(member.as_py(), 31)
                if hashlib.sha256(raw).hexdigest() != key:
                    raise ValueError(f"payload {key} does not have its digest")
                keys.append(key)
                sizes.append(len(raw))
                digests.append(base64.b32encode(hashlib.sha1(raw).digest()).decode())
                raws.append(raw if with_bytes else None)
            cols = [pa.array(keys, pa.string()), pa.array(sizes, pa.int64()), pa.array(digests, pa.string())]
            yield pa.RecordBatch.from_arrays(cols + ([pa.array(raws, pa.binary())] if with_bytes else []), names=["sha256", "size", "sha1"] + ["payload"] * with_bytes)
    return run


def verified_payloads(spark: SparkSession, path: str, with_bytes: bool = False) -> DataFrame:
    """sha256, size, sha1 (and payload) of every stored payload, recomputed from its bytes."""
    prepare(spark)
    kind = "sha256 string, size long, sha1 string" + ", payload binary" * with_bytes
    return spark.read.parquet(f"{path}/payloads").mapInArrow(_verified(with_bytes), kind)


def _field(name: str, pattern: str = "[^\\\\r\\\\n]*") -> Column:
    return F.regexp_extract(F.col("text"), f"\r\n{name}: ({pattern})".replace("\\\\", "\\"), 1)


def parsed_headers(spark: SparkSession, path: str) -> DataFrame:
    """page_id, sha256, header, record_type, refers_to, declared (payload digest) of every record."""
    rows = spark.read.parquet(f"{path}/headers").withColumn("text", F.decode("header", "utf-8"))
    refers = _field("WARC-Refers-To", "<urn:page:-?[0-9]*>")
    number = F.regexp_extract(refers, "-?[0-9]+", 0)
    return rows.select(
        "page_id", "sha256", "header", _field("WARC-Type").alias("record_type"),
        F.when(number != "", number.cast("long")).alias("refers_to"),
        F.regexp_extract(_field("WARC-Payload-Digest"), "^sha1:(.*)$", 1).alias("declared"))


def records(spark: SparkSession, path: str) -> DataFrame:
    """page_id, record: the original bytes of every record (header, block, two empty lines)."""
    heads = parsed_headers(spark, path)
    end = F.lit("\r\n\r\n").cast("binary")
    full = heads.where("record_type = 'response'").join(verified_payloads(spark, path, True), "sha256")
    return full.select("page_id", F.concat("header", "payload", end).alias("record")).unionAll(
        heads.where("record_type = 'revisit'").select("page_id", F.concat("header", end).alias("record")))


_PARSED = "page_id long, record_type string, refers_to long, declared string, block_bytes long, sha1 string"


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fields of whole records, and the digest of their blocks; a record that isn't as long as it says is an error."""
    for batch in batches:
        out = []
        for value in batch.column("record"):
            head, _, rest = bytes(value.as_py()).partition(b"\r\n\r\n")
            fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
            block, end = rest[:-4], rest[-4:]
            if end != b"\r\n\r\n" or len(block) != int(fields["Content-Length"]):
                raise ValueError(f"record {fields['WARC-Record-ID']} is not as long as it says")
            number = lambda name: int(x) if (x := fields.get(name, "<urn:page:>")[len("<urn:page:") : -1]) else None  # noqa: E731, B023
            out.append((number("WARC-Record-ID"), fields["WARC-Type"], number("WARC-Refers-To"), fields["WARC-Payload-Digest"].removeprefix("sha1:"), len(block),
                        base64.b32encode(hashlib.sha1(block).digest()).decode() if fields["WARC-Type"] == "response" else None))
        cols = list(zip(*out, strict=True)) if out else [()] * 6
        types = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], schema=pa.schema(zip(("page_id", "record_type", "refers_to", "declared", "block_bytes", "sha1"), types, strict=True)))


def read(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of the rebuilt records (``records``).

    A response whose payload hasn't the digest that it declares, and a revisit of a payload that no response has, raise an
    error.
    """
    prepare(spark)
    # both uses below need the fields only, and no payload is rebuilt twice
    rows = stored(records(spark, path).select("record").mapInArrow(_parse, _PARSED), "warc-records")
    sizes = rows.where("record_type = 'response'").groupBy("declared").agg(F.max("block_bytes").alias("size"), F.min(F.col("declared") == F.col("sha1")).alias("right"))
    found = salted_join(rows, sizes, "declared", SALTS)
    wrong = F.raise_error(F.concat(F.lit("wrong payload digest in record of page "), F.coalesce(F.col("page_id").cast("string"), F.lit("null"))))
    digest = F.when(F.col("right"), F.col("declared")).otherwise(wrong.cast("string"))
    return found.select("page_id", F.col("size").alias("payload_bytes"), digest.alias("payload_digest"), "record_type", "refers_to")


def round_trip(pages: DataFrame) -> DataFrame:
    """Archive ``pages`` in the shared folder and read the archive."""
    spark = pages.sparkSession
    return read(spark, archive(pages, f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"))


SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS size, sha256(coalesce(html, '')) AS key, sha1(coalesce(html, '')) AS hex FROM pages),
r AS (SELECT key, max(page_id) AS response_id FROM p GROUP BY key),
parts AS (SELECT hex, i, CAST('0x' || substr(hex, 5 * i + 1, 5) AS INTEGER) AS v FROM (SELECT DISTINCT hex FROM p), range(8) AS x(i)),
chars AS (SELECT hex, 4 * i + j AS place, substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> (15 - 5 * j)) & 31) + 1, 1) AS c FROM parts, range(4) AS y(j)),
b32 AS (SELECT hex, string_agg(c, '' ORDER BY place) AS payload_digest FROM chars GROUP BY hex)
SELECT page_id, size::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM response_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM response_id THEN response_id END AS refers_to
FROM p JOIN r USING (key) JOIN b32 USING (hex)
"""
