"""Exact top-k, WARC archives and URL reputation."""

import gzip
import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from slotplan.llm import exact_topk, url_reputation, warc


def brute_top(rows, k, scale=1024.0):
    """Every usable row is a candidate of every other; each query row has its own ranking."""
    vecs = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for at, (q, x) in enumerate(vecs):
        if q is not None and q % 100 == 0:
            scored = sorted((-sum(a * b for a, b in zip(x, y)), c is None, c or 0, c) for other, (c, y) in enumerate(vecs) if other != at)[:k]
            out += [(q, r + 1, c, -s) for r, (s, _, _, c) in enumerate(scored)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("block,k", [(8192, 10), (7, 3)])
def test_top_k_equals_brute_force(spark, block, k):
    rnd = random.Random(block)
    rows = [(i, [rnd.gauss(0, 1) * (1 + i % 5) for _ in range(6)]) for i in range(150)]
    rows += [(200, rows[3][1]), (201, rows[3][1]), (202, rows[3][1]), (300, [0.0] * 6), (3, [0.5] * 6)]      # ties, zeros, a repeated id
    rows += [(400, None), (401, []), (500, [1.0, None]), (501, [float("nan")] * 6), (502, [float("inf")] * 6), (600, [1.0, -2.0]), (None, [1.0]),
             (None, [9.0] * 6), (600, [1.0, -2.0]), (100, [5.0] * 6)]                     # rows without an id, repeated query rows
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, qb string, rank int")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    got = exact_topk.top_k(df, F.col("vec_id") % 100 == 0, k=k, block_rows=block, query_rows=2)
    assert sorted(map(tuple, got.collect()), key=repr) == brute_top(rows, k)


def test_top_k_of_two_rows_with_one_id(spark):
    df = spark.createDataFrame([(1, [1.0]), (1, [5.0]), (100, [1.0])], "vec_id long, embedding array<float>")
    got = exact_topk.top_k(df, F.col("vec_id") % 100 == 0, k=2)
    assert sorted(map(tuple, got.collect())) == [(100, 1, 1, 5 << 20), (100, 2, 1, 1 << 20)]


def test_top_k_small_tables(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert exact_topk.top_k(df.limit(0), F.lit(True)).count() == 0
    assert exact_topk.top_k(df, F.col("vec_id") > 5).count() == 0
    assert [tuple(r) for r in exact_topk.top_k(df, F.col("vec_id") == 0).collect()] == [(0, 1, 1, 1024 * 2048)]


def test_large_components_stay_exact():
    q = np.array([[2 ** 30 + 1, 3]], dtype=np.int64)
    assert exact_topk._products(q, q)[0, 0] == (2 ** 30 + 1) ** 2 + 9


PAGES = [
    (1, "http://a/x", "é" * 60), (2, None, "é" * 60), (3, "u\r\nv", None), (4, "http://b", (
        warc.MAGIC + "WARC-Type: response\r\nWARC-Record-ID: <urn:page:99>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" + warc.MAGIC + warc.MAGIC + "tail")),
    (5, "z", warc.MAGIC), (6, "z", "x" * 99), (7, "z", "x" * 99), (8, "z", "y" * 100), (9, "z", "y" * 100), (10, "q", "WARC/1.0\r"),
    (None, "q", "n" * 200), (11, "q", "n" * 200), (12, "k", "a" * 50 + warc.MAGIC + "b" * 50), (13, "k", "a" * 50 + warc.MAGIC + "b" * 50),
    (14, "w", "\r\n\r\n" * 50), (9, "z", "y" * 100), (15, "long", "long text " * 20000)]


@pytest.mark.parametrize("split", ["128m", "307b"])
def test_warc_round_trip(spark, split):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    pages = spark.createDataFrame([(*p, "h", 0) for p in PAGES], "page_id long, url string, html string, digest string, off int")
    if split != "128m":
        pages = pages.where("page_id < 15")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = warc.archive_round_trip(pages.repartition(2)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    want = [p for p in PAGES if split == "128m" or (p[0] or 99) < 15]
    first = {}
    for i, _, h in want:
        if h and len(h.encode()) >= 100 and i is not None:
            first[h] = min(first.get(h, i), i)
    expect = []
    for i, u, h in want:
        raw, to = (h or "").encode(), first.get(h)
        other = to is not None and i is not None and i != to
        expect.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if other else "response", to if other else None))
    cols = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r[c] for c in cols) for r in got), key=str) == sorted(expect, key=str)
    assert all(r["verified"] for r in got)


def test_warc_files_are_warc_and_empty_table(spark, tmp_path):
    pages = spark.createDataFrame([p for p in PAGES if p[0]], "page_id long, url string, html string")
    warc.write_archives(pages.coalesce(1), str(tmp_path / "w"))
    (part,) = (tmp_path / "w").glob("part-*")
    data, at, n = part.read_bytes(), 0, 0
    while at < len(data):
        assert data[at:at + 10] == warc.MAGIC.encode()
        head = data.index(b"\r\n\r\n", at)
        length = int(next(x for x in data[at:head].split(b"\r\n") if x.lower().startswith(b"content-length")).split(b":")[1])
        at, n = head + 4 + length + 4, n + 1
        assert data[at - 4:at] == b"\r\n\r\n"
    assert n == pages.count()
    assert warc.archive_round_trip(pages.limit(0)).count() == 0


def record(version, kind, ident, content, block, more=b""):
    return (b"WARC/%s\r\nWARC-Type: %s\r\nWARC-Record-ID: <%s>\r\n%sContent-Type: %s\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n"
            % (version, kind, ident, more, content, len(block), block))


@pytest.mark.parametrize("zipped", [False, True])
def test_warc_files_of_other_writers(spark, tmp_path, zipped):
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n"
    body = b"<p>caf\xc3\xa9</p> WARC/1.1\r\nContent-Length: 4\r\n\r\nfake"
    told = b"WARC-Payload-Digest: sha256:" + hashlib.sha256(body).hexdigest().encode() + b"\r\nWARC-Target-URI: http://x/\r\n"
    info = b"software: x\r\n\r\nformat: y"
    recs = [record(b"1.1", b"warcinfo", b"urn:uuid:a-0", b"application/warc-fields", info),
            record(b"1.1", b"response", b"urn:uuid:a-1", b"application/http; msgtype=response", http + body, told),
            record(b"1.1", b"response", b"urn:uuid:a-2", b"application/http; msgtype=response", http, b"WARC-Payload-Digest: sha1:ABC\r\n")]
    path = tmp_path / ("a.warc.gz" if zipped else "a.warc")
    path.write_bytes(b"".join(gzip.compress(r) if zipped else r for r in recs))
    got = {r["record_id"]: r for r in warc.read_archives(spark, str(tmp_path), version="1.1").collect()}
    assert sorted(got) == ["urn:uuid:a-0", "urn:uuid:a-1", "urn:uuid:a-2"]
    assert [got[f"urn:uuid:a-{i}"]["payload_bytes"] for i in range(3)] == [len(info), len(body), 0]
    assert [got[f"urn:uuid:a-{i}"]["verified"] for i in range(3)] == [None, True, None]
    assert got["urn:uuid:a-1"]["payload_digest"] == hashlib.sha256(body).hexdigest()
    assert got["urn:uuid:a-1"]["url"] == "http://x/" and got["urn:uuid:a-1"]["page_id"] is None
    assert warc.read_archives(spark, str(tmp_path)).count() == 0


RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


def judged(spark, rows, outcomes=(), **kw):
    pages = spark.createDataFrame([(*r, "h", "b", 1.0) for r in rows], "page_id long, url string, host string, bad string, mean double")
    known = spark.createDataFrame(list(outcomes), "page_id long, bad boolean")
    return url_reputation.judge(pages, known, RULES, **kw)


def test_url_rules_and_parts(spark):
    urls = {1: "http://A.Example.NET/en/x?q#f", 2: "https://example.net/EN/", 3: "http://xexample.net/en/", 4: "http://example.net?x/en/",
            5: "http://b.example.com/de/1", 6: "http://example.org/fr/", 7: "http://org/fr/", 8: None, 9: "no scheme", 10: "http://",
            11: "a://b://c/d", 12: "http://net/", 13: "http://x.net", 14: "http://example.com/dex"}
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in judged(spark, list(urls.items())).collect()}
    assert got == {
        1: ("a.example.net", "/en/x", "example.net/en/", "allow"), 2: ("example.net", "/EN/", "net/", "block"),
        3: ("xexample.net", "/en/", "net/", "block"), 4: ("example.net", "", None, "allow"),
        5: ("b.example.com", "/de/1", "example.com/de/", "block"), 6: ("example.org", "/fr/", "org/fr/", "allow"),
        7: ("org", "/fr/", "org/fr/", "allow"), 8: ("", "", None, "allow"), 9: ("", "", None, "allow"), 10: ("", "", None, "allow"),
        11: ("b:", "//c/d", None, "allow"), 12: ("net", "/", "net/", "block"), 13: ("x.net", "", None, "allow"),
        14: ("example.com", "/dex", None, "allow")}


def test_reputation_shrinks_and_blocks(spark):
    rows, known = [], []
    for host, n, bad in [("spam.a.com", 60, 58), ("ok.a.com", 60, 1), ("tiny.a.com", 1, 1), ("none.a.com", 0, 0), ("ok.b.org", 80, 4), ("x.b.org", 0, 0)]:
        for i in range(max(n, 1)):
            rows.append((len(rows), f"http://{host}/p{i}"))
            if n:
                known += [(rows[-1][0], i < bad)] * (1 + i % 2)          # some pages are labelled twice
    df = judged(spark, rows + [rows[0]], [*known, (None, True), (3, None)]).cache()
    by = {r["host"]: r for r in df.collect()}
    assert by["spam.a.com"]["verdict"] == "block" and by["ok.a.com"]["verdict"] == by["none.a.com"]["verdict"] == "allow"
    assert by["none.a.com"]["mean"] < by["tiny.a.com"]["mean"] < by["spam.a.com"]["mean"]
    assert by["ok.a.com"]["mean"] < by["none.a.com"]["mean"] < by["spam.a.com"]["mean"]
    assert by["x.b.org"]["mean"] < by["none.a.com"]["mean"] and by["tiny.a.com"]["mean"] > by["none.a.com"]["mean"]
    assert df.count() == len(rows) + 1
    assert judged(spark, rows[:1]).limit(0).count() == 0
    empty = spark.createDataFrame([], "page_id long, url string")
    assert url_reputation.judge(empty, spark.createDataFrame(known, "page_id long, bad boolean"), RULES).count() == 0


def test_registered_domains(spark):
    want = {"a.b.co.uk": ("b.co.uk", "co.uk"), "b.co.uk": ("b.co.uk", "co.uk"), "co.uk": ("co.uk", "co.uk"), "uk": ("uk", "uk"),
            "x.y.com": ("y.com", "com"), "y.com:8080": ("y.com", "com"), "me@y.com.": ("y.com", "com"), "u.github.io": ("u.github.io", "github.io"),
            "10.1.2.7": ("10.1.2.7", "(address)"), "10.1.2.7:80": ("10.1.2.7", "(address)"), "[::1]:80": ("[::1]", "(address)"),
            "localhost": ("localhost", "localhost"), "": ("", ""), "a.deep.x.y": ("a.deep.x.y", "deep.x.y")}
    hosts = spark.createDataFrame([(h,) for h in want], "host string")
    got = url_reputation.registered(hosts, [*url_reputation.PUBLIC_SUFFIXES, "Deep.x.y", "x.y"])
    assert {r["host"]: (r["domain"], r["suffix"]) for r in got.collect()} == want
    assert url_reputation.registered(hosts.limit(0)).count() == 0
    assert {r["suffix"] for r in url_reputation.registered(hosts, []).where("host = 'b.co.uk'").collect()} == {"uk"}


def test_strangers_under_a_public_suffix_are_apart(spark):
    """A clean registrant of co.uk is not shrunk to the spam of another one, as a host of that other one is."""
    rows, known = [], []
    for host, n, bad in [("a.spam.co.uk", 80, 78), ("b.spam.co.uk", 1, 0), ("c.fine.co.uk", 1, 0), ("d.fine.co.uk", 80, 1)]:
        for i in range(n):
            rows.append((len(rows), f"https://{host}/{i}"))
            known.append((rows[-1][0], i < bad))
    by = {r["host"]: r for r in judged(spark, rows, known).collect()}
    assert by["c.fine.co.uk"]["mean"] < by["b.spam.co.uk"]["mean"]
    flat = {r["host"]: r for r in judged(spark, rows, known, suffixes=()).collect()}
    assert by["c.fine.co.uk"]["mean"] < flat["c.fine.co.uk"]["mean"]
