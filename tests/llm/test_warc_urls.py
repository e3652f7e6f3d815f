"""Archives: round trips and both ARC versions; URL rules against a plain loop, collisions included."""

from __future__ import annotations

import gzip
import io

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from arqueo.llm import queries, url_filter, warc


def arc(version, rows):
    return warc.write_arc([(u, "1.2.3.4", "20230405060708", "text/html", b) for u, b in rows], version)


@pytest.mark.parametrize("version", [1, 2])
def test_arc_records_by_their_declared_length(version):
    rows = [("http://a/1", b"HTTP/1.1 200 OK\r\nX: y\r\n\r\nbody\n\nhttp://b/ 1 2 3 4\n"), ("http://a/b c", b""), ("dns:a", b"x\x00\xff")]
    first, *got = warc.read_arc(arc(version, rows))
    assert first.headers["URL"].startswith("filedesc:") and first.version == version
    assert [(r.headers["URL"], r.block) for r in got] == [(u.replace(" ", "%20"), b) for u, b in rows]
    assert got[0].payload() == b"body\n\nhttp://b/ 1 2 3 4\n"
    assert list(got[0].headers) == warc.FIELDS[version]


def test_broken_arc_raises():
    with pytest.raises(ValueError, match="runs past"):
        list(warc.read_arc(arc(1, [("http://a/", b"abcdef")])[:-4]))
    with pytest.raises(ValueError):
        list(warc.read_arc(b"one two\nx"))


def test_warc_records_say_what_they_are():
    records = list(warc.read_arc(arc(2, [("http://a/", b"HTTP/1.0 200 OK\r\n\r\nhi"), ("dns:a", b"20230405 a 1.2.3.4")])))
    own = [warc.to_warc(r) for r in records]
    assert [r.headers["WARC-Type"] for r in own] == ["warcinfo", "response", "resource"]
    assert own[1].headers["WARC-Date"] == "2023-04-05T06:07:08Z"
    assert own[1].headers["WARC-Record-ID"] == warc.to_warc(records[1]).headers["WARC-Record-ID"]  # repeatable
    assert len({r.headers["WARC-Record-ID"] for r in own}) == 3
    data = b"".join(map(warc.warc_member, own))
    assert [r.block for r in warc.read_warc(io.BufferedReader(gzip.open(io.BytesIO(data))))] == [r.block for r in own]
    spoiled = gzip.decompress(warc.warc_member(own[1])).replace(b"\r\nhi", b"\r\nho")
    with pytest.raises(ValueError, match="digest"):
        list(warc.read_warc(io.BytesIO(spoiled)))


def test_short_dates_are_padded():
    assert warc.timestamp("1999") == "1999-01-01T00:00:00Z"


def test_pages_round_trip(spark):
    big = "<p>" + "é" * 60
    rows = [(5, "http://x/ y%20", big), (3, "http://y", big), (4, None, big), (9, "u", "short"), (8, " ", "short"), (7, "z", None), (None, "n", big),
            (3, "http://y", big)]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id bigint, url string, html string, payload int")
    got = sorted(((r.page_id, r.url, r.record_type, r.refers_to, bytes(r.payload).decode() if r.payload is not None else None, r.payload_bytes)
                  for r in warc.convert_pages(pages, payloads=True).collect()), key=str)
    n = len(big.encode())
    assert got == sorted([(5, "http://x/ y%20", "revisit", 3, None, n), (3, "http://y", "response", None, big, n), (3, "http://y", "response", None, big, n),
                          (4, "urn:page:4", "revisit", 3, None, n), (9, "u", "response", None, "short", 5), (8, "urn:page:8", "response", None, "short", 5),
                          (7, "z", "response", None, "", 0), (None, "n", "revisit", 3, None, n)], key=str)
    assert warc.convert_pages(pages.limit(0)).count() == 0


RULES = queries.URL_RULES


def plain(host, path, rules):
    fits = [(len(k), k.index("/"), k, v) for k, v in rules for h, p in [(k[:k.index("/")], k[k.index("/"):])]
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[2:] if fits else (None, None)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text("abn.t-", max_size=8), st.text("/abe", max_size=5)), max_size=8),
       st.dictionaries(st.tuples(st.text("abn.t", min_size=1, max_size=4), st.text("/abe", max_size=3)).map(lambda x: f"{x[0]}/{x[1]}"),
                       st.sampled_from(["allow", "block"]), max_size=6), st.booleans())
def test_rules_equal_a_plain_loop(tmp_path_factory, urls, rules, collide):
    digest = (lambda b: len(b) % 2) if collide else url_filter.xxhash.xxh64_intdigest
    file = tmp_path_factory.mktemp("rules") / "r.bin"
    file.write_bytes(url_filter.pack_rules(rules.items(), digest))
    hosts, paths = [h for h, _ in urls], [p and "/" + p for _, p in urls]
    got = list(zip(*url_filter.DigestArray(str(file), digest).judge(hosts, paths)))
    assert got == [plain(h, p, list(rules.items())) for h, p in zip(hosts, paths)]


def test_large_ids_beside_a_null_stay_whole(spark):
    big = 2**62 + 1
    pages = spark.createDataFrame([(big, "http://a.net/", "x" * 200), (big + 2, "u", "x" * 200), (None, "v", "w")], "page_id bigint, url string, html string").coalesce(1)
    assert {(r.page_id, r.refers_to) for r in warc.convert_pages(pages).collect()} == {(big, None), (big + 2, big), (None, None)}
    assert {r.page_id for r in url_filter.judge_urls(pages, RULES).collect()} == {big, big + 2, None}


def test_contradicting_rules_raise():
    with pytest.raises(ValueError, match="two verdicts"):
        url_filter.pack_rules([("a/", "allow"), ("a/", "block")])


def test_odd_urls(spark):
    rows = [(1, None), (2, "no scheme"), (3, "http://"), (4, "HTTPS://WWW.A.NET"), (5, "http://a.net/?x://b"), (6, "x://ORG/fr/#/"), (7, "http://É.org/fr/É?q"),
            (8, "http://example.net/en"), (9, "http://m.example.net/en/1"), (None, "http://notnet/"), (8, "http://example.net/en"), (10, "http://a.net\n/x")]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id bigint, url string, host string")
    got = sorted(map(tuple, url_filter.judge_urls(pages, RULES).collect()), key=str)
    assert got == sorted([(1, "", "", None, "allow"), (2, "", "", None, "allow"), (3, "", "", None, "allow"), (4, "www.a.net", "", None, "allow"),
                          (5, "a.net", "/", "net/", "block"), (6, "org", "/fr/", "org/fr/", "allow"), (7, "É.org", "/fr/É", "org/fr/", "allow"),
                          (8, "example.net", "/en", "net/", "block"), (8, "example.net", "/en", "net/", "block"),
                          (9, "m.example.net", "/en/1", "example.net/en/", "allow"), (None, "notnet", "/", None, "allow"), (10, "a.net\n", "/x", None, "allow")], key=str)
    assert url_filter.judge_urls(pages.limit(0), RULES).count() == 0
