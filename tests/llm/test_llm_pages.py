"""URL filter and WARC round trips."""

import base64
import gzip
import hashlib
import io
import re
import tempfile
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tradelake.llm import url_filter, warc

PAGES = [
    (0, "http://a.example.org/es/1?x#y", "<p>x</p>"), (1, "HTTPS://EXAMPLE.org/en/12", "<p>same</p>"),
    (2, "https://sub.Example.ORG/en/2", "<p>same</p>"), (3, "http://x.com/fr/a", "<p>same</p>"),
    (4, "ftp://y.com/de/", ""), (5, "http://com/de/x", ""), (6, "http://xcom/de/x", None), (7, None, "<p>é</p>"),
    (8, "no scheme", "*** " * 30), (9, "http://h.net?q=/de/", "### " * 30), (10, "http://h.net/", "clean"),
    (11, "http://h.net/", "$$$ " * 25), (12, "http://a#b://c/de/", "z" * 300_000), (None, "http://org/", "<p>same</p>"),
    (3, "http://x.com/fr/a", "<p>same</p>"), (13, "http://a b\n/c d", "\x00\x1f"),
]


def pages(spark):
    return spark.createDataFrame([(*p, "extra", "host?") for p in PAGES],
                                 "page_id long, url string, html string, verdict string, host string").repartition(3)


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), re.match(r"[^?#]*", rest[len(host):])[0]


def test_rules_and_listing(spark):
    rules = {"org/": "allow", "example.org/es/": "block", "example.org/en/1": "block", "com/fr/": "allow", "com/de/": "block"}
    junk = {}
    for _, url, html in PAGES:
        key = "".join(split(url))
        junk[key] = junk.get(key, False) or len(re.findall(r"[#*$%&]{3}", html or "")) >= 20
    out = url_filter.judge_urls(pages(spark)).collect()
    assert len(out) == len(PAGES)
    want = []
    for i, url, _ in PAGES:
        host, path = split(url)
        fits = [r for r in rules if path.startswith(r[r.index("/"):]) and ("." + host).endswith("." + r[:r.index("/")])]
        rule = max(fits, key=len, default=None)
        listed = junk[host + path]
        want.append((i, host, path, rule, rules.get(rule) or ("block" if listed else "allow"), listed))
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in out)
    assert url_filter.judge_urls(pages(spark).limit(0)).count() == 0


def test_cascade_is_exact(spark, monkeypatch):
    """Over the whole universe, in several shards and several broadcasts."""
    monkeypatch.setattr(url_filter, "KEYS_PER_SHARD", 3000)
    monkeypatch.setattr(url_filter, "BROADCAST", 2000)
    keys = spark.range(20_000).select(F.concat(F.lit("host"), "id").alias("key"), (F.col("id") % 13 == 0).alias("listed"))
    cascade, shards = url_filter.build_cascade(keys)
    assert shards == 7
    out = url_filter.is_listed(keys.withColumnRenamed("listed", "truth"), "key", cascade, shards, "got")
    assert out.filter("got <> truth OR got IS NULL").count() == 0
    sizes = cascade.agg(F.sum(F.octet_length("bits")).alias("b"), F.max("level").alias("l")).first()
    assert sizes["l"] >= 2 and sizes["b"] * 8 < 14 * 20_000 / 13     # far below the keys themselves


def test_cascade_of_nothing_listed(spark):
    keys = spark.range(100).select(F.col("id").cast("string").alias("key"), F.lit(False).alias("listed"))
    cascade, shards = url_filter.build_cascade(keys)
    assert url_filter.is_listed(keys, "key", cascade, shards, "got").filter("got").count() == 0


def expected():
    out = []
    payload = [(h or "").encode() for _, _, h in PAGES]
    for (i, _, _), p in zip(PAGES, payload):
        group = [j for (j, _, _), q in zip(PAGES, payload) if q == p]
        keeper = max((j for j in group if j is not None), default=None) if len(group) > 1 else None
        response = keeper is None or i == keeper
        out.append((i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "response" if response else "revisit",
                    None if response else keeper))
    return out


def test_round_trip(spark):
    out = warc.round_trip(pages(spark)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted(str(tuple(r)) for r in out.collect()) == sorted(map(str, expected()))


def test_small_ranges_own_each_record_once(spark):
    path = tempfile.mkdtemp(prefix="tl-warc-")
    warc.write_warc(pages(spark), path + "/a")
    for size in (97, 1000, 1 << 20):
        got = warc.read_warc(spark, path + "/a", size=size).collect()
        assert sorted(r["payload_digest"] for r in got) == sorted(e[2] for e in expected())
    payloads = {r["page_id"]: bytes(r["payload"]) for r in got if r["record_type"] == "response"}
    assert payloads[12] == b"z" * 300_000 and payloads[6] == b""
    # every file is a gzip file that other readers take
    whole = b"".join(gzip.decompress(p.read_bytes()) for p in sorted(Path(path, "a").glob("*.txt")))
    assert whole.count(b"WARC/1.1\r\n") == len(PAGES)


def test_empty_table(spark):
    assert warc.round_trip(pages(spark).limit(0)).count() == 0


def test_magic_inside_a_payload_is_no_record():
    """Stored (not compressed) members hold the magic, even a whole record, in their payload."""
    import zlib
    inner = warc.record(1, "http://x/", b"inner", None, False)

    def stored(data):
        c = zlib.compressobj(0, zlib.DEFLATED, 31)
        return c.compress(data) + c.flush()
    junk = warc.MAGIC * 3 + b"\x00" * 40
    full = gzip.decompress(warc.record(2, None, junk, None, False))
    data = stored(full) + warc.record(3, "http://y/", b"last", None, False) + warc.EMPTY_MEMBER
    file = pa.BufferReader(data)
    for size in (7, 50, len(data)):
        found = [f for s in range(0, len(data), size) for f in warc.records_in(file, s, min(s + size, len(data)))]
        assert [f[1][0] for f in found] == [2, 3]
    assert inner.startswith(warc.MAGIC)


def test_record_parses_back():
    rng = np.random.default_rng(0)
    for n in (0, 1, 70_000):
        payload = rng.integers(0, 256, n, dtype=np.uint8).tobytes()
        data = warc.record(5, "http://a/\r\nX: y", payload, None, False)
        page, size, digest, kind, refers, uri, got = warc.parse(gzip.GzipFile(fileobj=io.BytesIO(data)).read())
        assert (page, size, kind, refers, got) == (5, n, "response", None, payload)
        assert uri == "http://a/%0D%0AX:%20y" and digest == warc.digest_of(payload)


def test_long_records_are_read_once():
    """Ten times the record, ten times the bytes read."""
    import gzip
    import io
    import os

    class Counted(io.BytesIO):
        read = 0

        def read_at(self, n, at):
            got = self.getvalue()[at:at + n]
            self.read += len(got)
            return got

    for size in (1 << 20, 10 << 20):
        payload = os.urandom(size)
        http = b"HTTP/1.1 200 OK\r\nContent-Length: %d\r\n\r\n" % size + payload
        head = (b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:7>\r\nWARC-Payload-Digest: sha1:"
                + warc.digest_of(payload).encode() + b"\r\nContent-Length: %d\r\n\r\n" % len(http))
        data = gzip.compress(head + http + b"\r\n\r\n", 1)
        file = Counted(data + warc.EMPTY_MEMBER + data)
        got = [f for s in range(0, len(file.getvalue()), 1 << 19) for f in warc.records_in(file, s, min(s + (1 << 19), len(file.getvalue())))]
        assert [(f[0], f[1]) for _, f in got] == [(7, size)] * 2
        assert file.read < 3.5 * len(file.getvalue())
