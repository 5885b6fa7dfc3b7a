"""Operator 7, web archives: pages as WARC files, and an index of captures merged from the runs of the files."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator
from urllib.parse import urlsplit

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.llm.common import quoted, store, table
from wakeline.session import shared_dir

#: The time of a capture that has none, and how times are written: of one width, so that texts sort as times do.
CAPTURED, TIME_FORM = "2024-01-01T00:00:00.000000Z", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
#: Parts that the rows of one payload are joined in.
SALTS = 16
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EOL, BETWEEN = "\r\n", "\r\n\r\n"
INDEX = ("url_key string, captured string, page_id {key}, archive string, offset long, length long, "
         "payload_bytes long, payload_digest string, record_type string, refers_to {key}")


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def header_value(text: object) -> str:
    """A value on one line: control characters and the percent sign are escaped."""
    return re.sub(r"[\x00-\x1f\x7f%]", lambda m: f"%{ord(m[0]):02X}", str(text))


def url_key(url: str | None) -> str:
    """The host's labels from the last to the first, then path and query: captures of a site stand together."""
    try:
        parts = urlsplit((url or "").strip().lower())
        host = (parts.hostname or "").removeprefix("www.")
    except ValueError:
        return url or ""
    return ",".join(reversed(host.split("."))) + ")" + (parts.path or "/") + ("?" + parts.query if parts.query else "")


def record(page_id: object, url: str | None, html: str | None, refers_to: object, is_revisit: bool,
           captured: str = CAPTURED) -> str:
    payload = (html or "").encode()
    http = EOL.join(["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}", "", ""])
    body = len(http.encode()) + (0 if is_revisit else len(payload))
    named = lambda p: "<urn:page:none>" if p is None else f"<urn:page:{p}>"
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if is_revisit else 'response'}", f"WARC-Record-ID: {named(page_id)}",
             f"WARC-Date: {captured}", f"WARC-Payload-Digest: sha1:{digest_of(payload)}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {header_value(url)}")
    if is_revisit:
        lines += [f"WARC-Refers-To: {named(refers_to)}", f"WARC-Profile: {PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {body}", "", ""]
    return EOL.join(lines) + http + ("" if is_revisit else html or "")


def read_records(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes, int, int]]:
    """(headers, content, offset, length) of each record of an uncompressed archive."""
    at = 0
    while line := stream.readline():
        begin, headers = at, {}
        if line.rstrip() != b"WARC/1.1":
            raise ValueError(f"no record at {at}")
        at += len(line)
        while (line := stream.readline()).rstrip():
            at += len(line)
            name, _, value = line.decode().rstrip("\r\n").partition(": ")
            headers[name] = value
        at += len(line)
        size = int(headers["Content-Length"])
        content, gap = stream.read(size), stream.read(len(BETWEEN))
        if len(content) != size or gap != BETWEEN.encode():
            raise ValueError(f"the record at {begin} is cut off")
        at += size + len(gap)
        yield headers, content, begin, at - begin


def write_archives(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html",
                   smallest: int = 0, time: str | None = None) -> None:
    """Write one record for each row into gzipped WARC files under path.

    ``time`` is the column of capture times; without one, or where it is null, the time is a constant.

    Of rows with equal payloads of at least ``smallest`` bytes the one with the largest key is a response with its
    payload, the others are revisits of it. A WARC record of UTF-8 text is text, and every record ends in two line
    ends, so Spark's own text writer makes the files: it commits each task once, on any file system, whatever
    executors are lost. A file holds one task's records; the shuffle before it bounds their size. Rows of one payload
    are spread over SALTS parts on their way to the decision.

    Null html is an empty payload; a null key is smaller than any other; repeated rows are records each. An empty table
    makes files without records.
    """
    k, payload = F.col(quoted(key)), F.coalesce(F.col(quoted(html)), F.lit(""))
    captured = F.lit(CAPTURED) if time is None else F.coalesce(F.date_format(F.col(quoted(time)).cast("timestamp"), TIME_FORM), F.lit(CAPTURED))
    rows = pages.select(k.alias("page_id"), F.col(quoted(url)).alias("url"), payload.alias("html"), F.sha1(payload).alias("sha"),
                        captured.alias("captured"))
    sharing = rows.where(F.octet_length("html") >= smallest).groupBy("sha").agg(
        F.max("page_id").alias("holder"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    dealt = sharing.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url", "captured"), F.lit(SALTS)).cast("int"))
    linked = salted.join(dealt, ["sha", "salt"], "left").select(
        "page_id", "url", "html", "captured", "holder", (F.coalesce(F.octet_length("html") >= smallest, F.lit(False))
                                             & F.col("holder").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("holder"))).alias("again"))

    @F.arrow_udf("string")
    def to_record(page_id: pa.Array, url: pa.Array, html: pa.Array, holder: pa.Array, again: pa.Array, captured: pa.Array) -> pa.Array:
        return pa.array((record(*(x.as_py() for x in row)) for row in zip(page_id, url, html, holder, again, captured)), pa.string())

    linked.select(to_record("page_id", "url", "html", "holder", "again", "captured").alias("value")).write.option(
        "lineSep", BETWEEN).option("compression", "gzip").text(path)


def read_archives(spark: SparkSession, path: str, key_type: str = "bigint") -> DataFrame:
    """The index runs of the archives: a row for each record, in order of URL key, time and page within a file.

    Response payloads are read and their digest is compared with the record's; a revisit has digest and size of the
    full payload in its headers.
    """
    schema = INDEX.format(key=key_type)
    whole = key_type in ("bigint", "int", "smallint", "tinyint")

    def named(text: str | None) -> object:
        found = (text or "")[len("<urn:page:"):-1]
        return None if found in ("", "none") else int(found) if whole else found

    def parse(files: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in files:
            for path, content in zip(batch["path"], batch["content"]):
                rows = []
                with gzip.open(io.BytesIO(content)) as stream:
                    for h, body, offset, length in read_records(stream):
                        http, _, payload = body.partition(BETWEEN.encode())
                        size = int(re.search(rb"Content-Length: (\d+)", http)[1])
                        digest = h["WARC-Payload-Digest"].removeprefix("sha1:")
                        if h["WARC-Type"] == "response" and (len(payload) != size or digest_of(payload) != digest):
                            raise ValueError(f"payload and digest differ at {offset} of {path}")
                        uri = h.get("WARC-Target-URI")
                        uri = None if uri is None else re.sub("%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)) if (
                            int(m[1], 16) < 32 or m[1] in ("7F", "25")) else m[0], uri)
                        rows.append((url_key(uri), h["WARC-Date"], named(h["WARC-Record-ID"]), path.rsplit("/", 1)[-1],
                                     offset, length, size, digest, h["WARC-Type"], named(h.get("WARC-Refers-To"))))
                rows.sort(key=order_of)
                out = pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])
                for c in ("page_id", "refers_to"):
                    out[c] = out[c].astype("Int64" if whole else object)
                yield out

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content")
    return files.mapInPandas(parse, schema)


def order_of(row: tuple) -> tuple:
    """URL key, time, page: a missing page comes first."""
    return row[0], row[1], row[2] is not None, row[2] if row[2] is not None else 0, row[3], row[4]


class LoserTree:
    """Merges sorted runs: every inner node keeps the loser of its match, so a step replays one path only."""

    def __init__(self, runs: list[list[tuple]]):
        self.runs = [iter(r) for r in runs]
        self.heads = [next(r, None) for r in self.runs]
        self.size = len(runs)
        self.losers = [-1] * max(1, self.size)
        winner = [*([-1] * self.size), *range(self.size)]
        for node in range(self.size - 1, 0, -1):
            a, b = winner[2 * node], winner[2 * node + 1]
            winner[node], self.losers[node] = (b, a) if self.beats(b, a) else (a, b)
        if runs:
            self.losers[0] = winner[1]

    def beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return x is not None and (y is None or (x[0], a) < (y[0], b))

    def __iter__(self) -> Iterator[tuple]:
        while self.size and self.heads[best := self.losers[0]] is not None:
            yield self.heads[best]
            self.heads[best] = next(self.runs[best], None)
            node = (best + self.size) // 2
            while node:
                if self.beats(self.losers[node], best):
                    best, self.losers[node] = self.losers[node], best
                node //= 2
            self.losers[0] = best


def merge_runs(index: DataFrame) -> DataFrame:
    """The index in global order of URL key, time and page: partitions in order, and rows in order within each.

    Sampled splitters over all three part the keys into ranges, so one URL with a third of the captures spans several.
    A range holds its stretch of every archive's run; each stretch stays sorted, and a loser tree merges them.
    """
    names = index.columns

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        runs: dict[str, list[tuple]] = {}
        for batch in batches:
            clean = batch.astype(object).where(batch.notna(), None)
            for row in clean.itertuples(index=False, name=None):
                runs.setdefault(row[3], []).append((order_of(row), row))
        merged = [row for _, row in LoserTree(list(runs.values()))]
        if merged:
            yield pd.DataFrame(merged, columns=names).astype({c: t for c, t in types.items()})

    types = {"page_id": "Int64", "refers_to": "Int64"} if "bigint" in dict(index.dtypes)["page_id"] else {}
    ranged = index.repartitionByRange("url_key", "captured", "page_id")
    return ranged.sortWithinPartitions("archive", "url_key", "captured", "page_id", "offset").mapInPandas(merge, ", ".join(
        f"`{c}` {t}" for c, t in index.dtypes))


def capture_histories(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", smallest: int = 0,
                      time: str | None = None) -> DataFrame:
    """Write pages as archives into the shared folder, read them back, and merge their indexes: captures in order of URL
    key, time and page.

    Null html is an empty payload, a null URL leaves the record without a target. A null key is smaller than any
    other; rows with equal key and payload are captures of one kind. Payloads below ``smallest`` bytes are responses
    all. An empty table gives no rows. Other columns are not read. Line ends and control characters in a URL are
    escaped in the record and restored when read.
    """
    spark = pages.sparkSession
    path = f"{shared_dir(spark)}/llm/warc-{uuid.uuid4().hex}"
    write_archives(pages, path, key, url, html, smallest, time)
    kind = pages.select(F.col(quoted(key))).dtypes[0][1]
    return merge_runs(store(read_archives(spark, path, kind), "warc-index"))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = capture_histories(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return merged.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


# Five hexadecimal digits are four letters of base32.
_LETTERS = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(sha1(p), {5 * i + 1}, 5))::BIGINT >> {shift}) & 31)::INT, 1)"
    for i in range(8) for shift in (15, 10, 5, 0))
OP7_SQL = f"""
WITH d AS (SELECT page_id, coalesce(html, '') AS p FROM pages)
SELECT page_id, strlen(p)::BIGINT AS payload_bytes, {_LETTERS} AS payload_digest,
       CASE WHEN page_id = max(page_id) OVER w THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> max(page_id) OVER w THEN max(page_id) OVER w END AS refers_to
FROM d WINDOW w AS (PARTITION BY p)
"""
