"""URL filter and WARC archives."""

import re
from collections import Counter

import pytest

from punctuo.llm import url_filter, warc

PAGES = [(1, "http://Example.COM/en/x?y#z", "<p>é</p>"), (2, "https://www.example.com/en/", "<p>é</p>"), (3, "http://a.net/fr/1", None),
         (4, "http://a.net/fr", ""), (5, None, "x"), (6, "no scheme", "x" * 300_000), (7, "http://", "y"), (8, "ftp://com", "z"),
         (9, "http://xcom/", "<p>é</p>"), (10, "http://b.example.com/en/en/", "q\r\n\r\nq"), (10, "http://b.example.com/en/en/", "q\r\n\r\nq"),
         (None, "http://null.com/a", "<p>é</p>"), (11, "http://a.com:80/", "w"), (12, "http://net/es/?", "w"),
         (13, "http://a.net/es/ a\nb", "v"), (14, "://x.com/#/en", "u")]


def pages(spark, rows=PAGES):
    return spark.createDataFrame([(*r, 1, "h", b"b") for r in rows],
                                 "page_id long, url string, html string, id int, host string, frame binary").repartition(3)


def brute(url, rules, default="allow"):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1].lower(), m[2]) if m and "://" in (url or "") else ("", "")
    fit = [(len(h + p), len(h), v == "block", h + p) for h, p, v in rules
           if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best and best[3], default if best is None else "block" if best[2] else "allow"


MORE = url_filter.RULES + [("com", "/", "block"), ("b.example.com", "/en/e", "allow"), ("example.com", "", "block"), ("a.com:80", "/", "block"),
                           ("x.com", "/en", "block"), ("net", "/es/ a", "allow")]


@pytest.mark.parametrize("rules", [url_filter.RULES, MORE, []])
@pytest.mark.parametrize("limit", [url_filter.RULE_CHARS, 10])
def test_url_filter(spark, rules, limit):
    got = url_filter.url_filter(pages(spark), rules, limit=limit)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    assert Counter(map(tuple, got.collect())) == Counter((i, *brute(u, rules)) for i, u, _ in PAGES)
    assert url_filter.url_filter(pages(spark).limit(0), rules).count() == 0


@pytest.mark.parametrize("kw", [{}, {"records": 3}, {"archive_bytes": 200, "records": 5}, {"least_bytes": 5}])
def test_warc_round_trip(spark, tmp_path, kw):
    path = str(tmp_path / "warc")
    warc.write_warc(pages(spark), path, **kw)
    got = warc.read_warc(spark, path).collect()
    least = kw.get("least_bytes", 0)
    lead = {}
    for i, _, h in PAGES:
        if i is not None:
            lead[h or ""] = max(i, lead.get(h or "", i))
    want = Counter()
    for i, u, h in PAGES:
        data = (h or "").encode()
        revisit = len(data) >= least and i != lead[h or ""]
        want["" if i is None else str(i), "revisit" if revisit else "response", len(data), warc.sha1_32(data),
             str(lead[h or ""]) if revisit else None, None if revisit else data] += 1
    assert all(r.problem is None for r in got)
    assert Counter((r.record_id, r.record_type, r.payload_bytes, r.payload_digest, r.refers_to,
                    None if r.payload is None else bytes(r.payload)) for r in got) == want
    for f in (tmp_path / "warc").glob("part-*"):
        data = f.read_bytes()
        assert not data or int.from_bytes(data[:4], "little") == warc.DICT_MAGIC


def test_warc_empty_table(spark, tmp_path):
    warc.write_warc(pages(spark).limit(0), str(tmp_path / "w"))
    assert warc.read_warc(spark, str(tmp_path / "w")).count() == 0


def test_reader_finds_what_is_wrong():
    import zstandard
    good = warc.record("1", "http://a/", b"payload", warc.sha1_32(b"payload"), None)
    assert warc.parse(good)["problem"] is None and warc.parse(good)["payload"] == b"payload"
    for bad in (good[:-1], good + b"x", good.replace(b"payload", b"pAyload"), good.replace(b"WARC/1.1", b"WARC/9"),
                good.replace(b"WARC-Date", b"Date"), good.replace(b"Content-Length: 7", b"Content-Length: 8"), b"", b"WARC/1.1\r\n\r\n",
                good.replace(b"Content-Type: application", b"Content-Type application")):
        assert warc.parse(bad)["problem"], bad
    data = warc.dictionary([b"payload " * 10])
    press = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(data))
    lead, frame = warc.dictionary_frame(data), press.compress(good)
    assert list(warc.frames(lead + warc.GAP + frame + frame)) == [(good, None)] * 2
    assert [p for _, p in warc.frames(lead + frame[:-3])] != [None]
    assert [p for _, p in warc.frames(lead + frame + b"abc")][-1]
    assert [p for _, p in warc.frames(b"plain text, no frame")][-1]
    assert list(warc.frames(b"")) == []
