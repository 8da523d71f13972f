"""Web archives: records written in sorted runs, merged to capture histories, read back.

Each task sorts its captures by URL key and time and writes them as one archive, a run,
with gzip members that can be read alone. The index of all runs is dealt out by ranges of
URL key and time; within a range a loser tree merges the runs' slices, so that the captures
come in one global order. Records are read back in that order, from the archives.

A payload of at least ``REVISIT_BYTES`` that several captures share is stored once, with
the capture of the smallest page_id; the others are revisit records that refer to it.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.store import written
from tickloom.session import fresh_dir
from tickloom.sources.files import locate

REVISIT_BYTES = 100
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
_CONTROL = re.compile(r"[\x00-\x20\x7f]")


def url_key(url: Column) -> Column:
    """Host labels from the last to the first, without a leading www, then path and query; '' for a null URL."""
    whole = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)(?::[0-9]*)?([^#]*)"
    host = F.regexp_replace(F.lower(F.regexp_extract(url, whole, 1)), r"^www\.", "")
    key = F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.regexp_extract(url, whole, 2))
    return F.coalesce(F.when(F.regexp_extract(url, whole, 1) == "", url).otherwise(key), F.lit(""))


def with_originals(pages: DataFrame) -> DataFrame:
    """Adds payload, payload_bytes, payload_digest and refers_to, the page whose payload this one repeats.

    Captures of equal page_id and payload are each a response.
    """
    rows = pages.withColumn("payload", F.coalesce(F.col("html").cast("string"), F.lit("")))
    rows = rows.withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn(
        "payload_digest", F.sha2(F.encode("payload", "UTF-8"), 256)
    )
    shared = (
        rows.where(F.col("payload_bytes") >= REVISIT_BYTES).groupBy("payload_digest")
        .agg(F.min("page_id").alias("original"), F.count("*").alias("captures")).where("captures > 1")
        .select("payload_digest", "original")
    )
    repeats = F.col("original").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("original"))
    return rows.join(shared, "payload_digest", "left").withColumn("refers_to", F.when(repeats, F.col("original")))


def record(page_id: int | None, url: str | None, date: str, payload: str, digest: str, original: int | None) -> bytes:
    """One archive record. Control characters of the URL are percent-encoded."""
    name = lambda page: f"<urn:page:{'' if page is None else page}>"
    revisit = original is not None
    body = payload.encode()
    block = _HTTP.format(len(body)).encode() + (b"" if revisit else body)
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {name(page_id)}",
        f"WARC-Date: {date}", f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url))
    if revisit:
        head += [
            f"WARC-Refers-To: {name(original)}",
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
        ]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(raw: bytes) -> tuple:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of a record.

    A response's size and digest are those of the payload that is there, and must be the
    ones in its header; a revisit's are those in its headers.
    """
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no archive record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    page = lambda name: int(name[len("<urn:page:"):-1]) if len(name) > len("<urn:page:>") else None
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    original = None
    if fields["WARC-Type"] == "revisit":
        original = page(fields["WARC-Refers-To"])
    elif hashlib.sha256(payload).hexdigest() != digest or len(payload) != size:
        raise ValueError("a payload is damaged")
    return page(fields["WARC-Record-ID"]), size, digest, fields["WARC-Type"], original


def write_runs(captures: DataFrame) -> DataFrame:
    """Write (page_id, url, date, payload, payload_digest, refers_to) as archives.

    Returns their index, written: (run, place, url_key, date, page_id, offset, length). A
    task that runs again writes another file; the index names those that count.
    """
    folder = fresh_dir(captures.sparkSession, "archives")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = locate(f"{folder}/{uuid.uuid4().hex}.warc.gz")
        out, offset, place = None, 0, 0
        try:
            for batch in batches:
                rows = []
                for key, page_id, url, date, payload, digest, original in zip(
                    *(c.to_pylist() for c in batch.columns), strict=True
                ):
                    if out is None:
                        store.create_dir(path.rsplit("/", 1)[0], recursive=True)
                        out = store.open_output_stream(path, compression=None)
                    member = gzip.compress(
                        record(page_id, url, date, payload, digest, original), compresslevel=1, mtime=0
                    )
                    out.write(member)
                    rows.append((f"{folder}/{path.rsplit('/', 1)[1]}", place, key, date, page_id, offset, len(member)))
                    offset += len(member)
                    place += 1
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), (
                            pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()
                        ), strict=True)],
                        names=["run", "place", "url_key", "date", "page_id", "offset", "length"],
                    )
        finally:
            if out is not None:
                out.close()

    rows = captures.select(
        url_key(F.col("url")).alias("url_key"), F.col("page_id").cast("long"), "url", "date", "payload",
        "payload_digest", F.col("refers_to").cast("long"),
    )
    runs = rows.sortWithinPartitions("url_key", "date", "page_id").mapInArrow(
        work, "run string, place long, url_key string, date string, page_id long, offset long, length long"
    )
    return written(runs, "capture-index")


class LoserTree:
    """Merges sorted runs: each inner node keeps the loser of its match, the root the winner."""

    _OVER = (1,)

    def __init__(self, runs: Sequence[Iterator]) -> None:
        self.runs = list(runs)
        self.size = max(1, len(self.runs))
        self.heads = [self._next(n) for n in range(self.size)]
        self.losers = [-1] * self.size
        for run in range(self.size):
            self._play(run)

    def _next(self, run: int) -> tuple:
        item = next(self.runs[run], None) if run < len(self.runs) else None
        # Runs that are over lose against all others; equal items come by run.
        return self._OVER if item is None else (0, item, run)

    def _play(self, run: int) -> None:
        """Let a run's head play its way up; a node without a loser yet keeps it."""
        node = (run + self.size) // 2
        while node > 0:
            other = self.losers[node]
            if other < 0:
                self.losers[node] = run
                return
            if self.heads[other] < self.heads[run]:
                self.losers[node], run = run, other
            node //= 2
        self.losers[0] = run

    def __iter__(self) -> Iterator:
        while (head := self.heads[winner := self.losers[0]]) != self._OVER:
            yield head[1]
            self.heads[winner] = self._next(winner)
            self._play(winner)


def merged(index: DataFrame) -> DataFrame:
    """The index in one order by (url_key, date, page_id), over the partitions and within each; a null page_id first.

    ``position`` grows along that order.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A range is about as large as the advisory size of a shuffle partition.
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        runs, start = [], 0
        names = table.column("run").to_pylist()
        keys = list(zip(
            table.column("url_key").to_pylist(), table.column("date").to_pylist(),
            (-1 << 63 if p is None else p for p in table.column("page_id").to_pylist()), range(len(names)),
            strict=True,
        ))
        for place in range(1, len(names) + 1):
            if place == len(names) or names[place] != names[start]:
                runs.append(iter(keys[start:place]))
                start = place
        order = pa.array([key[-1] for key in LoserTree(runs)])
        yield from table.take(order).combine_chunks().to_batches()

    ranges = index.repartitionByRange("url_key", "date", "page_id").sortWithinPartitions("run", "place")
    return ranges.mapInArrow(work, index.schema).withColumn("position", F.monotonically_increasing_id())


def read_records(captures: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, position) of indexed records, from the archives."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            files: dict[str, pa.NativeFile] = {}
            rows = []
            for run, offset, length, position in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if run not in files:
                    if len(files) >= 64:
                        files.pop(next(iter(files))).close()
                    store, path = locate(run)
                    files[run] = store.open_input_file(path)
                raw = zlib.decompress(files[run].read_at(length, offset), wbits=31)
                rows.append((*parsed(raw), position))
            for file in files.values():
                file.close()
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), (
                        pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()
                    ), strict=True)],
                    names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "position"],
                )

    return captures.select("run", "offset", "length", "position").mapInArrow(
        work, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
        "position long",
    )


def archived(pages: DataFrame, date: Column) -> DataFrame:
    """Write a record for each row of pages (page_id, url, html) and read all records back, in capture order.

    ``date`` is the capture time in ISO form. A null html is an empty payload, a null URL
    has the empty key, and a null page_id stays null.
    """
    captures = with_originals(pages.withColumn("date", date))
    return read_records(merged(write_runs(captures)))
