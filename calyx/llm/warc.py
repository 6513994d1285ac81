"""WARC archives of pages, and a globally ordered capture index merged from sorted runs.

Writing: digests are grouped first, so every page knows whether it is the
response or a revisit of its payload; records are rendered as text and written
by Spark's own file writer, whose line separator is the blank line that ends a
WARC record. Reading back: each archive file is parsed by one task, payload
digests are computed from the bytes read, and the file's captures become one
locally sorted run of the index. Merging: a range partition takes its slice of
every run and merges the runs with a loser tree by URL key, timestamp and page,
so partitions in order hold the capture histories in global order.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from calyx.session import scratch_path

from .common import map_arrow, write_table

LEAST_BYTES = 1000
RANGE_ROWS = 200_000           # rows of the index that one task merges
RECORDS_PER_FILE = 8192
EPOCH = "2024-01-01 00:00:00"
INDEX = ("urlkey string, ts string, page_id long, run string, offset long, length long, "
         "payload_bytes long, payload_digest string, record_type string, refers_to long")
_NAMES = [f.split()[0] for f in INDEX.split(", ")]


# -------------------------------------------------------------------- writing
def captures(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Pages with payload digest, record type and the page that a revisit refers to."""
    page = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").alias("url"),
                        F.coalesce(F.col("html"), F.lit("")).alias("html"))
    page = page.withColumn("bytes", F.octet_length("html").cast("long")).withColumn("digest", F.sha1("html"))
    again = page.filter(F.col("bytes") >= least_bytes).groupBy("digest") \
        .agg(F.max("page_id").alias("last"), F.count("*").alias("n")).filter("n > 1").select("digest", "last")
    found = page.join(again, "digest", "left")
    revisit = F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last"))
    return found.select("page_id", "url", "html", "bytes", "digest",
                        F.when(revisit, "revisit").otherwise("response").alias("type"),
                        F.when(revisit, F.col("last")).alias("refers_to"))


def write_archives(found: DataFrame, path: str, records_per_file: int = RECORDS_PER_FILE) -> None:
    """One gzip-compressed WARC file or more per task, holding a record per capture."""
    end, text = "\r\n", lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    stamp = F.date_format(F.timestamp_seconds(F.unix_timestamp(F.lit(EPOCH)) + F.coalesce("page_id", F.lit(0))),
                          "yyyy-MM-dd'T'HH:mm:ss'Z'")
    url = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20\x7f]", "%20")
    whole = F.col("type") == "response"
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{end}Content-Type: text/html; charset=utf-8{end}Content-Length: "),
                    text("bytes"), F.lit(end + end))
    block = F.concat(http, F.when(whole, F.col("html")).otherwise(""))
    referring = F.concat(
        F.lit(f"WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest{end}"
              "WARC-Refers-To: <urn:x-page:"), text("refers_to"), F.lit(f">{end}"))
    head = F.concat(
        F.lit(f"WARC/1.0{end}WARC-Type: "), F.col("type"),
        F.lit(f"{end}WARC-Record-ID: <urn:x-page:"), text("page_id"), F.lit(f">{end}WARC-Date: "), stamp,
        F.lit(f"{end}WARC-Target-URI: "), url, F.lit(f"{end}WARC-Payload-Digest: sha1:"), F.col("digest"),
        F.lit(end), F.when(whole, "").otherwise(referring),
        F.lit(f"Content-Type: application/http; msgtype=response{end}Content-Length: "),
        F.octet_length(block).cast("string"), F.lit(end + end), block)
    found.select(head.alias("value")).write.option("lineSep", end + end).option("compression", "gzip") \
        .option("maxRecordsPerFile", records_per_file).text(path)


# -------------------------------------------------------------------- reading
_KEY = re.compile(r"^([a-z][a-z0-9+.-]*)://(?:[^/?#@]*@)?([^/?#:]*)(?::(\d+))?([^#]*)", re.I)


def url_key(url: str) -> str:
    """Sort-friendly key: host labels reversed, then port, path and query; the fragment is dropped."""
    m = _KEY.match(url)
    if not m:
        return url.lower()
    host = [x for x in m[2].lower().split(".") if x]
    if host[:1] == ["www"]:
        host = host[1:]
    port = f":{m[3]}" if m[3] and (m[1].lower(), m[3]) not in (("http", "80"), ("https", "443")) else ""
    return ",".join(reversed(host)) + port + ")" + (m[4] or "/").lower()


def records(content: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, header fields, block) of each record; inflates piece by piece."""
    inflate = zlib.decompressobj(31)
    buffer, offset, at, step = bytearray(), 0, 0, 1 << 18

    def more() -> bool:
        nonlocal at, inflate
        while at < len(content) or inflate.unused_data:
            if inflate.eof:                                    # the next gzip member
                rest = inflate.unused_data
                inflate = zlib.decompressobj(31)
                out = inflate.decompress(rest) if rest else b""
            else:
                out = inflate.decompress(content[at:at + step])
                at += step
            if out:
                buffer.extend(out)
                return True
        return False

    while True:
        while (head := buffer.find(b"\r\n\r\n")) < 0:
            if not more():
                if buffer.strip():
                    raise ValueError("truncated WARC record")
                return
        lines = buffer[:head].decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at {offset}")
        fields = dict(x.split(": ", 1) for x in lines[1:])
        body = head + 4
        size = body + int(fields["Content-Length"])
        while len(buffer) < size + 4:
            if not more():
                raise ValueError("truncated WARC record")
        yield offset, size + 4, fields, bytes(buffer[body:size])
        del buffer[:size + 4]
        offset += size + 4


def _number(urn: str) -> int | None:
    digits = urn.removeprefix("<urn:x-page:").removesuffix(">")
    return int(digits) if digits else None


def _runs(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
            run, rows = path.rsplit("/", 1)[-1], []
            for offset, length, fields, block in records(content.as_py()):
                head, _, payload = block.partition(b"\r\n\r\n")
                declared = int(re.search(rb"Content-Length: (\d+)", head)[1])
                digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
                if kind == "response" and (hashlib.sha1(payload).hexdigest() != digest or len(payload) != declared):
                    raise ValueError(f"damaged payload in {path} at {offset}")
                rows.append((url_key(fields["WARC-Target-URI"]), fields["WARC-Date"],
                             _number(fields["WARC-Record-ID"]), run, offset, length, declared, digest, kind,
                             _number(fields["WARC-Refers-To"]) if kind == "revisit" else None))
            rows.sort(key=_order)
            yield _batch(rows)


def _order(row: tuple) -> tuple:
    return row[0], row[1], -1 if row[2] is None else row[2], row[3], row[4]


_SCHEMA = pa.schema([(n, {"string": pa.string(), "long": pa.int64()}[f.split()[1]])
                     for n, f in zip(_NAMES, INDEX.split(", "))])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, t.type) for c, t in zip(zip(*rows) if rows else [[]] * len(_NAMES), _SCHEMA)],
                           schema=_SCHEMA)


# -------------------------------------------------------------------- merging
class LoserTree:
    """k-way merge of sorted iterators: each step replays one path of log2(k) matches."""

    def __init__(self, runs, key):
        self.runs, self.key = [iter(r) for r in runs], key
        self.k = len(self.runs)
        self.head = [next(r, None) for r in self.runs]
        self.rank = [self._rank(i) for i in range(self.k)]
        self.loser = [-1] * max(1, self.k)
        for i in range(self.k):
            self._replay(i)

    def _rank(self, i: int) -> tuple:
        row = self.head[i]
        return (1,) if row is None else (0, self.key(row))

    def _replay(self, winner: int) -> None:
        node = (winner + self.k) // 2
        while node:
            if self.loser[node] == -1:                          # first match at this node while building
                self.loser[node] = winner
                return
            if self.rank[self.loser[node]] < self.rank[winner]:
                self.loser[node], winner = winner, self.loser[node]
            node //= 2
        self.loser[0] = winner

    def __iter__(self):
        while self.k:
            w = self.loser[0]
            if self.head[w] is None:
                return
            yield self.head[w]
            self.head[w] = next(self.runs[w], None)
            self.rank[w] = self._rank(w)
            self._replay(w)


def _merged(batches) -> Iterator[pa.RecordBatch]:
    runs: dict[str, list[tuple]] = {}
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            runs.setdefault(row[3], []).append(row)
    for rows in runs.values():
        if any(_order(x) > _order(y) for x, y in zip(rows, rows[1:])):    # blocks of a shuffle come in any order
            rows.sort(key=_order)
    out: list[tuple] = []
    for row in LoserTree(runs.values(), _order):
        out.append(row)
        if len(out) == 8192:
            yield _batch(out)
            out = []
    yield _batch(out)


def capture_index(pages: DataFrame, path: str | None = None, least_bytes: int = LEAST_BYTES,
                  records_per_file: int = RECORDS_PER_FILE) -> DataFrame:
    """Write the archives to ``path`` (a folder of the shared one by default) and return their index.

    Columns: urlkey, ts, page_id, run, offset, length (place in the inflated
    file), payload_bytes, payload_digest, record_type, refers_to; in order of
    urlkey, ts and page_id. One row per row of ``pages``; a null html is an
    empty payload, a null url an empty one, and control characters and blanks
    in it become %20. Of equal payloads of at least ``least_bytes`` the largest
    page_id is the response (rows that repeat it too), the others revisit it;
    rows with a null page_id revisit it as well and are responses where no
    other has their payload. Pages carry no time: ts is a fixed epoch plus
    page_id seconds. An empty table gives an empty index. Other columns are not
    read. Ranges of the index hold about RANGE_ROWS rows, which bounds what a
    merging task holds; records_per_file bounds a reading task.
    """
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write_archives(captures(pages, least_bytes), path, records_per_file)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content")
    runs = write_table(map_arrow(files, _runs, INDEX), "runs")
    ranges = max(spark.sparkContext.defaultParallelism, -(-runs.count() // RANGE_ROWS))
    return map_arrow(runs.repartitionByRange(ranges, "urlkey", "ts", "page_id", "run", "offset"), _merged, INDEX)
