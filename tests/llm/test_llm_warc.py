"""WARC: archives are re-read record by record, by the sidecar, and through the operator."""

import glob
import gzip
import hashlib
import io

import pytest
from pyspark.sql import functions as F

from tillstream.llm import warc as W

LONG = "<p>" + "z" * 100 + "</p>"
ROWS = [(5, "http://a/", LONG), (3, "http://b/\r\nX: y", LONG), (9, None, LONG), (9, None, LONG), (1, "u", "short"),
        (2, "u", "short"), (4, "u", None), (6, "u", ""), (None, "u", LONG), (7, "u", "é" * 49), (8, "u", "é" * 50),
        (10, "u", "é" * 50), (11, "u", "x" * 3_000_000), (12, "u", "\r\n\r\nWARC/1.1\r\n" + "q" * 100)]


def expected():
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    big = lambda t: len((t or "").encode()) >= 100
    out, seen = [], set()
    for key, _, text in sorted(ROWS, key=lambda r: (r[0] is None, r[0] or 0)):
        firsts = [k for k, _, t in ROWS if t == text and k is not None]
        again = big(text) and key is not None and (sha(text) in seen)
        if key is not None:
            seen.add(sha(text))
        out.append((key, len((text or "").encode()), sha(text), "revisit" if again else "response",
                    min(firsts) if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("archive_bytes", [W.ARCHIVE_BYTES, 500])
def test_round_trip(spark, scratch, monkeypatch, archive_bytes):
    monkeypatch.setattr(W.dump, "__defaults__", (archive_bytes,))
    df = spark.createDataFrame(ROWS, "page_id long, url string, html string").coalesce(2)
    got = W.store_and_read(df, "page_id", "url", "html", f"file://{scratch}")
    assert sorted((tuple(r) for r in got.collect()), key=str) == expected()
    raw = glob.glob(f"{scratch}/raw/*.warc.gz")
    assert len(raw) == (2 if archive_bytes > 500 else len({r for r in raw})) and raw
    for path in glob.glob(f"{scratch}/records/*.warc.gz"):
        data, end = open(path, "rb").read(), 0
        for line in open(path.replace(".warc.gz", ".cdx")):
            offset, length, kind, uri, digest = line.split()
            member = gzip.decompress(data[int(offset):int(offset) + int(length)])
            [(headers, block)] = W.records(io.BytesIO(data[int(offset):int(offset) + int(length)]))
            assert member.startswith(b"WARC/1.1\r\n") and int(offset) == end
            assert (headers["WARC-Type"], headers["WARC-Record-ID"], headers["WARC-Payload-Digest"]) == (kind, uri, digest)
            assert (kind == "revisit") == (not W.split_http(block)[1] and "WARC-Refers-To" in headers)
            end = int(offset) + int(length)
        assert end == len(data)


def test_monolithic_streams(spark):
    """One stream, several members, and a stream cut off."""
    parts = [W.response(str(i), "http://x/", b"p" * (10 ** i), "d") for i in range(7)]
    for raw in (gzip.compress(b"".join(parts)), b"".join(map(gzip.compress, parts))):
        assert [len(W.split_http(b)[1]) for _, b in W.records(io.BytesIO(raw))] == [10 ** i for i in range(7)]
    with pytest.raises(EOFError):
        list(W.records(io.BytesIO(gzip.compress(b"".join(parts))[:-10])))
    assert list(W.records(io.BytesIO(b""))) == []


def test_empty_table_and_extra_columns(spark, scratch):
    df = spark.createDataFrame([(1, "u", "t", "a")], "page_id long, url string, html string, archive string")
    assert W.store_and_read(df.limit(0), "page_id", "url", "html", f"{scratch}/e").count() == 0
    assert W.store_and_read(df, "page_id", "url", "html", f"{scratch}/f").first().payload_bytes == 1


def test_string_ids(spark, scratch):
    df = spark.createDataFrame([("b c", LONG), ("a/é", LONG)], "k string, html string").withColumn("u", F.lit(None).cast("string"))
    got = {r.k: (r.record_type, r.refers_to) for r in W.store_and_read(df, "k", "u", "html", scratch).collect()}
    assert got == {"a/é": ("response", None), "b c": ("revisit", "a/é")}
