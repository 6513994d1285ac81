import gzip
import hashlib
import random
import zlib

import pytest

from calyx.llm import warc
from calyx.session import scratch_path


def pages_frame(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string") \
        .selectExpr("*", "'x' as digest", "cast(1 as long) as bytes", "'y' as run", "'z' as ts")


def want(rows):
    """(page_id, bytes, digest, type, refers_to) by a plain pass."""
    last = {}
    for i, _, html in rows:
        body = (html or "").encode()
        if len(body) >= 1000 and i is not None:
            last[body] = max(last.get(body, i), i)
    out, count = [], {}
    for _, _, html in rows:
        count[html] = count.get(html, 0) + 1
    for i, _, html in rows:
        body = (html or "").encode()
        to = last.get(body) if len(body) >= 1000 and count[html] > 1 else None
        revisit = to is not None and to != i
        out.append((i, len(body), hashlib.sha1(body).hexdigest(), "revisit" if revisit else "response",
                    to if revisit else None))
    return out


@pytest.fixture(scope="module")
def rows():
    r = random.Random(1)
    big = ["<p>" + "é\r\n\r\nWARC/1.0\r\n" * k + "</p>" for k in (70, 80, 90)]
    out = [(i, f"http://{r.choice('abc')}.example.org:80/{r.choice('xyz')}?q={i % 7}#f",
            r.choice([*big, "small", "", f"own {i} " * r.choice([1, 300])])) for i in range(300)]
    return out + [(900, None, None), (901, "no scheme\r\nX: y", big[0]), (902, "http://h/ü", "x" * 300_000),
                  (None, "http://n/", big[0]), (903, "http://d/", big[2]), (903, "http://d/", big[2]),
                  (904, "http://[bad", "x\x00y")]


def test_index_matches_plain_pass(spark, rows):
    got = warc.capture_index(pages_frame(spark, rows), records_per_file=40).collect()
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(((x["page_id"], x["payload_bytes"], x["payload_digest"], x["record_type"], x["refers_to"])
                   for x in got), key=key) == sorted(want(rows), key=key)
    order = [(x["urlkey"], x["ts"], -1 if x["page_id"] is None else x["page_id"]) for x in got]
    assert order == sorted(order)
    assert len({x["run"] for x in got}) > 3
    assert warc.capture_index(pages_frame(spark, [])).count() == 0


def test_records_stand_where_the_index_says(spark, rows):
    path = scratch_path(spark, "warc-test")
    index = warc.capture_index(pages_frame(spark, rows), path, records_per_file=40).collect()
    files = {r["path"].rsplit("/", 1)[-1]: gzip.decompress(bytes(r["content"]))
             for r in spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).collect()}
    html = {i: h or "" for i, _, h in rows}
    for x in index:
        record = files[x["run"]][x["offset"]:x["offset"] + x["length"]]
        assert record.startswith(b"WARC/1.0\r\n") and record.endswith(b"\r\n\r\n")
        if x["record_type"] == "response":
            assert record.split(b"\r\n\r\n", 2)[2][:-4] == html[x["page_id"]].encode()
        else:
            assert f"WARC-Refers-To: <urn:x-page:{x['refers_to']}>".encode() in record


def test_members_and_damage():
    record = (b"WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n")
    content = gzip.compress(record) + gzip.compress(record * 2)
    got = list(warc.records(content))
    assert [(o, n, b) for o, n, _, b in got] == [(k * len(record), len(record), b"hello") for k in range(3)]
    with pytest.raises((ValueError, zlib.error)):
        list(warc.records(gzip.compress(record[:-8])))
    assert list(warc.records(gzip.compress(b""))) == []


def test_loser_tree_merges():
    r = random.Random(2)
    for k in (0, 1, 2, 3, 7, 16):
        runs = [sorted(r.choices(range(50), k=r.randint(0, 40))) for _ in range(k)]
        assert list(warc.LoserTree(runs, lambda x: x)) == sorted(x for run in runs for x in run)


def test_url_keys():
    assert warc.url_key("https://www.Example.org:443/A/b?Q=1#f") == "org,example)/a/b?q=1"
    assert warc.url_key("http://u@h.example.org:8080") == "org,example,h:8080)/"
    assert warc.url_key("nonsense") == "nonsense" and warc.url_key("") == ""
