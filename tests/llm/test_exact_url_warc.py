from __future__ import annotations

import base64
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tabloom.llm.exact_dedup import exact_dedup
from tabloom.llm.url_filter import filter_urls, rules_table
from tabloom.llm.warc_archive import read_archive, read_facts, write_archive


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, kept string, head string")


@pytest.mark.parametrize("keep", ["min", "max"])
@pytest.mark.parametrize("parts", [1, 7])
def test_exact_dedup_against_brute_force(spark, keep, parts):
    rng = random.Random(3)
    texts = ["", None, "a", "b" * 40 + "x", "b" * 40 + "y", "é\n", "hot", "z" * 5000]
    rows = [(i, rng.choice(texts + ["hot"] * 8), "k", "h") for i in range(400)]
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        got = {r.doc_id: r for r in exact_dedup(docs(spark, rows).repartition(3), keep=keep).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    groups = {}
    for i, text, *_ in rows:
        groups.setdefault(text or "", []).append(i)
    assert len(got) == 400
    for text, ids in groups.items():
        best = (min if keep == "min" else max)(ids)
        for i in ids:
            r = got[i]
            assert (r.keep_id, r.group_size, r.kept) == (best, len(ids), i == best)
            assert r.text_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_exact_dedup_splits_a_hot_text(spark):
    """A text that most rows have spreads over partitions and is still one group."""
    df = spark.range(20_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 5 == 0, F.col("id").cast("string")).otherwise("hot").alias("text"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = exact_dedup(df).cache()
        assert out.where("group_size = 16000 and keep_id = 1").count() == 16000
        assert out.where("kept").count() == 4001
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_exact_dedup_nulls_repeats_and_empty_tables(spark):
    rows = [(None, "a", "", ""), (1, "a", "", ""), (1, "a", "", ""), (None, "b", "", ""), (2, None, "", ""), (3, "", "", "")]
    for keep, empty in (("min", 2), ("max", 3)):
        got = exact_dedup(docs(spark, rows), keep=keep).collect()
        assert sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in got if r.doc_id == 1) == [(1, 1, 3, False), (1, 1, 3, True)]
        assert [(r.keep_id, r.group_size) for r in got if r.doc_id in (2, 3)] == [(empty, 2)] * 2
        assert sorted((r.keep_id is None, r.kept) for r in got if r.doc_id is None) == [(False, False), (True, True)]
    assert exact_dedup(docs(spark, [])).count() == 0
    lower = exact_dedup(docs(spark, [(1, "A", "", ""), (2, "a", "", "")]), normalise=F.lower).collect()
    assert {r.group_size for r in lower} == {2}


def brute_verdict(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    best = None
    for h, p, a in rules:
        if host and (host == h or host.endswith("." + h)) and path.startswith(p):
            if best is None or (len(h + p), len(h)) > (len(best[0] + best[1]), len(best[0])):
                best = (h, p, a)
    return host, path, best and best[0] + best[1], best[2] if best else "allow"


RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("a.b.net", "", "block"), ("org", "/x/y", "block"), ("org", "/x/yz/", "allow")]


def test_url_filter_against_brute_force(spark):
    rng = random.Random(5)
    hosts = ["example.com", "WWW.Example.com", "x.www.example.com", "com", "a.b.net", "q.a.b.net", "b.net", "foo.org", "org", "", "notcom", ".com", "a..com"]
    paths = ["", "/", "/en", "/en/", "/en/9", "/es/1?a=/", "/x/y", "/x/yz", "/x/yz/q#f", "?q=/en/", "#/en/", "//en/", "/x" * 50 + "/y"]
    urls = [None, "", "nothing", "http:/x", "ftp://", "://example.com/en/"] + [rng.choice(["http", "https"]) + "://" + rng.choice(hosts) + rng.choice(paths) for _ in range(300)]
    urls += ["https://hot.example.com/en/1"] * 50
    rows = [(i if i % 7 else None, u, "clash", "clash") for i, u in enumerate(urls)]
    pages = spark.createDataFrame(rows, "page_id long, url string, u string, best string")
    got = filter_urls(pages, rules_table(spark, RULES))
    assert got.count() == len(rows)
    for r in got.collect():
        assert (r.judged.host, r.judged.path, r.judged.rule, r.judged.verdict) == brute_verdict(r.row.url, RULES), r.row.url
    plan = got._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "Python" not in plan


def test_url_filter_empty_tables_and_null_rules(spark):
    pages = spark.createDataFrame([(1, "http://a.com/x")], "page_id long, url string")
    none = spark.createDataFrame([], "host string, path string, action string")
    assert filter_urls(pages, none).collect()[0].judged.verdict == "allow"
    assert filter_urls(pages, none, default="block").collect()[0].judged.verdict == "block"
    odd = spark.createDataFrame([(None, "/", "block"), ("", "/", "block"), ("a.com", None, "block"), ("a.com", "", "allow")], "host string, path string, action string")
    assert filter_urls(pages, odd).collect()[0].judged.verdict == "block"
    assert filter_urls(pages.where("false"), odd).count() == 0


def test_warc_round_trip(spark, tmp_path):
    rows = [(1, "http://a/", "same"), (2, "http://b/", "same"), (3, None, None), (4, "http://c/\r\nX: y", ""), (5, "u", "é" * 3000), (6, "u", "\r\n\r\nWARC/1.1"), (7, "u", "x"), (7, "u", "x"), (None, "n", "same"), (None, "n", "alone")]
    pages = spark.createDataFrame([(*r, "h") for r in rows], "page_id long, url string, html string, header string")
    write_archive(pages, str(tmp_path / "a"))
    got = read_facts(spark, str(tmp_path / "a")).collect()
    assert len(got) == len(rows)
    digests = {base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode() for _, _, h in rows}
    assert {r.payload_digest for r in got} == digests
    by = {}
    for r in got:
        by.setdefault(r.page_id, []).append((r.payload_bytes, r.record_type, r.refers_to))
    assert by[1] == [(4, "revisit", 2)] and by[2] == [(4, "response", None)]
    assert by[3] == [(0, "revisit", 4)] and by[4] == [(0, "response", None)]
    assert by[5] == [(6000, "response", None)]
    assert sorted(by[7], key=str) == [(1, "response", None), (1, "revisit", 7)]
    assert sorted(by[None], key=str) == [(4, "revisit", 2), (5, "response", None)]
    whole = {r.id: r for r in read_archive(spark, str(tmp_path / "a")).collect()}
    r = whole[6]
    assert bytes(r.record) == r.header.encode() + b"\r\n\r\nWARC/1.1" + b"\r\n\r\n" and r.header.startswith("WARC/1.1\r\nWARC-Type: response\r\n") and r.header.endswith("\r\n\r\n")
    assert "X: y\r" not in whole[4].header.replace("%0D%0AX: y", "")
    assert spark.read.parquet(str(tmp_path / "a/payloads")).count() == 6


def test_warc_urls_that_look_like_headers(spark, tmp_path):
    breaks = ["\r\n", "\n", "\r", "\x85", "\u2028", "\u2029", "\v", "\f", "\x1e", ""]
    fields = ["Content-Length: 0", "WARC-Refers-To: <urn:page:77>", "WARC-Type: revisit", "WARC-Record-ID: <urn:page:5>", "WARC-Payload-Digest: sha1:AAAA"]
    rows = [(i, f"http://a/{b}{f}{b}{b}x", f"payload {i // 2}") for i, (b, f) in enumerate((b, f) for b in breaks for f in fields)]
    rows.append((1000, fields[1], "alone"))
    write_archive(spark.createDataFrame(rows, "page_id long, url string, html string"), str(tmp_path / "a"))
    got = {r.page_id: (r.payload_bytes, r.record_type, r.refers_to) for r in read_facts(spark, str(tmp_path / "a")).collect()}
    last = {p: i for i, _, p in rows}
    assert got == {i: (len(p), "response" if last[p] == i else "revisit", None if last[p] == i else last[p]) for i, _, p in rows}


def test_warc_small_payloads_and_empty_table(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id long, url string, html string")
    write_archive(pages, str(tmp_path / "a"), min_bytes=3)
    kinds = {r.page_id: (r.record_type, r.refers_to) for r in read_facts(spark, str(tmp_path / "a")).collect()}
    assert kinds == {1: ("response", None), 2: ("response", None), 3: ("revisit", 4), 4: ("response", None)}
    write_archive(pages.where("false"), str(tmp_path / "b"))
    assert read_facts(spark, str(tmp_path / "b")).count() == 0


def test_warc_damaged_payload_is_noticed(spark, tmp_path):
    write_archive(spark.createDataFrame([(1, "u", "ab")], "page_id long, url string, html string"), str(tmp_path / "a"))
    bad = spark.read.parquet(str(tmp_path / "a/payloads")).withColumn("payload", F.lit(b"xx"))
    bad.write.parquet(str(tmp_path / "bad"))
    (tmp_path / "b").mkdir()
    (tmp_path / "b/headers").symlink_to(tmp_path / "a/headers")
    (tmp_path / "b/payloads").symlink_to(tmp_path / "bad")
    with pytest.raises(Exception, match="does not fit"):
        read_facts(spark, str(tmp_path / "b")).collect()
