"""WARC archives of web pages, and a capture index merged from sorted runs.

Pages with equal payloads share one response record; the others are revisits
that refer to it. Archives are WARC/1.1 files of bounded size, each record a gzip
member of its own, so a record can be read at its offset alone. Spark's text
writer writes them: an empty gzip member stands between two records. Reading
them back parses the bytes record by record, each archive giving a locally
sorted run of captures; runs are dealt into ranges of URL key and time, of a
bounded number of captures, and merged there by a loser tree that holds a few
rows of each run at a time, the rest staying in Arrow buffers.

A null html is an empty payload, which takes part like any other. A null url is
an empty target. Every row makes a record, also where page_ids repeat; rows
that repeat the smallest page_id of a payload are all responses. A null page_id
refers to the payload's smallest page_id, if there is one. An empty table gives
an empty index.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.common import pieces, written
from tidemark.session import shared_dir

RECORDS_PER_ARCHIVE = 4096
ARCHIVE_BYTES = 64 << 20
CAPTURES_PER_RANGE = 1 << 16
MIN_REVISIT_BYTES = 0
# First records of copies that are broadcast at most; a row of a hashed relation is about so long.
BROADCAST_BYTES = 64 << 20
_FIRST_BYTES = 128
# Beyond that, copies of one payload are dealt over so many tasks.
_SALTS = 64
_ROWS_AT_ONCE = 64
_BYTES_AT_ONCE = 16 << 10

# The alphabets of base 32 with the digits first, and of RFC 4648.
_DIGITS_FIRST = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_END = "\r\n"
# A gzip member without content, as Latin-1.
_EMPTY_MEMBER = "\x1f\x8b\x08\0\0\0\0\0\0\xff\x03\0\0\0\0\0\0\0\0\0"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

CAPTURE = (
    "url_key string, captured string, page_id long, url string, record_type string, refers_to long, "
    "payload_bytes long, payload_digest string, archive string, offset long, length long"
)


def base32_sha1(payload: Column) -> Column:
    """SHA-1 as 32 upper-case base32 characters; 20 bits are five hexadecimal digits and four of these."""
    digits = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substr(digits, F.lit(5 * i + 1), F.lit(5)), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), _DIGITS_FIRST, _BASE32)


def _line(name: str, value: Column) -> Column:
    """A header line; white space in a value would end or split it, so it is written as in a URL."""
    value = F.regexp_replace(F.coalesce(value, F.lit("")), r"[\r\n]", "%0A")
    return F.concat(F.lit(f"{name}: "), value, F.lit(_END))


def _record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


def _members(archive_bytes: int):
    """Each record as a gzip member, and which archive of the task it goes to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, size = 0, 0
        for batch in batches:
            for some in pieces(iter([batch]), 0):
                members, parts = [], []
                for record in some.column(0):
                    packer = zlib.compressobj(wbits=31)
                    member = packer.compress(record.as_buffer()) + packer.flush()
                    if size and size + len(member) > archive_bytes:
                        part, size = part + 1, 0
                    size += len(member)
                    members.append(member)
                    parts.append(part)
                yield pa.record_batch({"member": pa.array(members, pa.binary()), "part": pa.array(parts, pa.int32())})

    return run


def _with_first(page: DataFrame, min_bytes: int) -> DataFrame:
    """The pages with ``first``, the smallest page_id of their payload where it has copies."""
    copies = (
        page.where(F.col("bytes") >= min_bytes)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .drop("n")
    )
    copies = written(copies, "copied-payloads")
    # Payloads are dealt out only where the digests with copies are too many to go to them.
    if copies.count() * _FIRST_BYTES <= BROADCAST_BYTES:
        return page.join(F.broadcast(copies), "digest", "left")
    salted = copies.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    page = page.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(_SALTS)).cast("int"))
    return page.join(salted, ["digest", "salt"], "left").drop("salt")


def write_archives(
    pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES, per_archive: int = RECORDS_PER_ARCHIVE, archive_bytes: int = ARCHIVE_BYTES
) -> str:
    """Write a record per page; returns the folder of the archives.

    An archive has at most ``per_archive`` records and ``archive_bytes`` bytes of
    them, or one record. Pages carry no time of capture, so their ids stand in for it, in seconds.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    page = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"))
    page = page.withColumn("digest", base32_sha1(F.col("payload"))).withColumn("bytes", F.octet_length("payload"))
    page = _with_first(page, min_bytes)
    revisit = (F.col("bytes") >= min_bytes) & F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{_END}Content-Type: text/html; charset=utf-8{_END}Content-Length: "),
        F.col("bytes").cast("string"),
        F.lit(_END * 2),
    )
    kept = F.when(revisit, F.lit("").cast("binary")).otherwise(F.col("payload"))
    at = F.date_format(F.timestamp_seconds(F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(2**31))), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    head = F.concat(
        F.lit(f"WARC/1.1{_END}"),
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", _record_id(F.col("page_id"))),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Date", at),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        F.when(
            revisit,
            F.concat(_line("WARC-Profile", F.lit(_PROFILE)), _line("WARC-Refers-To", _record_id(F.col("first")))),
        ).otherwise(""),
        F.lit(f"Content-Type: application/http; msgtype=response{_END}Content-Length: "),
        (F.octet_length(http) + F.octet_length(kept)).cast("string"),
        F.lit(_END * 2),
    )
    folder = shared_dir(pages.sparkSession, "llm-archives")
    record = F.concat(head.cast("binary"), http.cast("binary"), kept, F.lit(_END * 2).cast("binary"))
    members = page.select(record.alias("record")).mapInArrow(_members(archive_bytes), "member binary, part int")
    # The bytes pass through a string column unchanged; nothing validates them on the way.
    members.select(F.col("member").cast("string").alias("value"), "part").write.partitionBy("part").option("encoding", "ISO-8859-1").option(
        "lineSep", _EMPTY_MEMBER
    ).option("maxRecordsPerFile", per_archive).text(folder)
    return folder


def url_key(url: str) -> str:
    """The sort key of an index: host labels reversed, then path and query; no scheme, port, www or fragment."""
    rest = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*://", "", url).split("#", 1)[0]
    host, slash, path = rest.partition("/")
    host = re.sub(r":\d*$", "", host.rpartition("@")[2]).lower().removeprefix("www.")
    return ",".join(reversed(host.split("."))) + ")" + (slash + path if slash else "/")


def members(archive: bytes) -> Iterator[tuple[int, int, bytes]]:
    """Offset, length and content of each gzip member that has content."""
    data, at = memoryview(archive), 0
    while at < len(data):
        opened, begin, content = zlib.decompressobj(31), at, []
        while not opened.eof:
            some = data[at : at + _BYTES_AT_ONCE]
            if not some:
                raise ValueError(f"member at {begin} is cut short")
            content.append(opened.decompress(some))
            at += len(some) - len(opened.unused_data)
        if any(content):
            yield begin, at - begin, b"".join(content)


def record(content: bytes) -> tuple[dict[str, str], bytes]:
    """Header and block of one record."""
    end = content.index(b"\r\n\r\n")
    lines = content[:end].decode("utf-8").split(_END)
    if lines[0] != "WARC/1.1":
        raise ValueError("no record")
    header = dict(line.split(": ", 1) for line in lines[1:])
    stop = end + 4 + int(header["Content-Length"])
    if content[stop:] != b"\r\n\r\n":
        raise ValueError("record is cut short")
    return header, content[end + 4 : stop]


def records(archive: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """Offset, length, header and block of each record of an archive; offset and length are those of its gzip member."""
    for at, length, content in members(archive):
        yield at, length, *record(content)


def _page(urn: str) -> int | None:
    number = urn.removeprefix("<urn:page:").removesuffix(">")
    return None if number == "none" else int(number)


def _capture(archive: str, at: int, length: int, header: dict[str, str], block: bytes) -> tuple:
    http = block[: block.index(b"\r\n\r\n") + 4]
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    kind = header["WARC-Type"]
    if kind == "response" and size != len(block) - len(http):
        raise ValueError(f"payload at {at} of {archive} is cut short")
    url = header["WARC-Target-URI"]
    return (
        url_key(url),
        header["WARC-Date"],
        _page(header["WARC-Record-ID"]),
        url,
        kind,
        _page(header["WARC-Refers-To"]) if kind == "revisit" else None,
        size,
        header["WARC-Payload-Digest"].removeprefix("sha1:"),
        archive,
        at,
        length,
    )


_SCHEMA = pa.schema(
    [
        (name, {"string": pa.string(), "long": pa.int64()}[kind])
        for name, kind in (column.split() for column in CAPTURE.split(", "))
    ]
)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _SCHEMA.types, strict=True)], schema=_SCHEMA)


def _order(row: tuple) -> tuple:
    return row[0], row[1], row[8], row[9]


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            name = "/".join(path.rsplit("/", 2)[1:])  # files of two parts may share a name
            if rows := sorted((_capture(name, *record) for record in records(content.as_py())), key=_order):
                yield _rows(rows)


class LoserTree:
    """Merges sorted runs: a leaf for each run, and in each inner node the loser of the match played there.

    Taking the winner plays only the matches on its path, one comparison a level.
    """

    def __init__(self, runs: list[Iterator[tuple]]):
        self.runs = runs
        self.heads = [next(run, None) for run in runs]
        self.keys = [None if head is None else _order(head) for head in self.heads]
        self.losers = [-1] * len(runs)
        for leaf in range(len(runs)):
            self._play(leaf)

    def _beats(self, a: int, b: int) -> bool:
        if self.keys[a] is None or self.keys[b] is None:
            return self.keys[a] is not None
        return (self.keys[a], a) < (self.keys[b], b)

    def _play(self, leaf: int) -> None:
        winner, node = leaf, (leaf + len(self.runs)) // 2
        while node:
            other = self.losers[node]
            if other < 0:  # still being built: wait here for the other side
                self.losers[node] = winner
                return
            if self._beats(other, winner):
                self.losers[node], winner = winner, other
            node //= 2
        self.losers[0] = winner

    def __iter__(self) -> Iterator[tuple]:
        while self.runs and self.heads[winner := self.losers[0]] is not None:
            yield self.heads[winner]
            self.heads[winner] = head = next(self.runs[winner], None)
            self.keys[winner] = None if head is None else _order(head)
            self._play(winner)


def _reader(slices: list[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows of a run, of which only a few are Python objects at a time."""
    for run in slices:
        for begin in range(0, run.num_rows, _ROWS_AT_ONCE):
            yield from zip(*(c.to_pylist() for c in run.slice(begin, _ROWS_AT_ONCE).columns), strict=True)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge what the runs have in this range; rows come run by run."""
    runs: dict[str, list[pa.RecordBatch]] = {}
    for batch in batches:
        ends = pc.run_end_encode(batch.column(8))
        begin = 0
        for name, end in zip(ends.values.to_pylist(), ends.run_ends.to_pylist(), strict=True):
            runs.setdefault(name, []).append(batch.slice(begin, end - begin))
            begin = end
    some: list[tuple] = []
    for row in LoserTree([_reader(run) for run in runs.values()]):
        some.append(row)
        if len(some) == 4096:
            yield _rows(some)
            some = []
    if some:
        yield _rows(some)


def capture_index(spark: SparkSession, folder: str, per_range: int = CAPTURES_PER_RANGE) -> DataFrame:
    """The captures of all archives in a folder, by URL key and time over all partitions.

    Ranges grow in number with the captures, not in size, so what a merge holds is bounded.
    """
    archives = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).where("length > 0").select("path", "content")
    runs = written(archives.mapInArrow(_runs, CAPTURE), "runs")
    n_ranges = max(1, -(-runs.count() // per_range))
    ranges = runs.repartitionByRange(n_ranges, "url_key", "captured", "archive", "offset")
    return ranges.sortWithinPartitions("archive", "url_key", "captured", "offset").mapInArrow(_merge, CAPTURE)


def archive_and_index(pages: DataFrame, **how) -> DataFrame:
    """Write the pages' archives, read them back, and return their merged capture index."""
    return capture_index(pages.sparkSession, write_archives(pages, **how))
