"""Web archives: pages written as WARC records, read back, and their index merged.

Tasks write records to archive files of bounded size, a gzip member for each record, and keep an
index run for each file, sorted by URL key and time. Runs are dealt out by ranges of (URL key,
time, place), and each range is merged by a loser tree: a tree of matches whose inner nodes hold
the losers, so that the next capture costs one match for each level. The ranges in turn are the
globally ordered histories of all captures.

Of records with equal payloads, one is the response and the others revisit it. Files of attempts
that failed are never listed in a run, so they are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, replace
from datetime import UTC, datetime, timedelta
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curbline.llm.common import batch, map_arrow, stored
from curbline.llm.shared_files import located
from curbline.session import fresh_path

# Payloads under so many bytes are never revisited.
LEAST_REVISITED = 1000
FILE_BYTES = 32 << 20
LEVEL = 4
# Captures of a range, about.
RANGE_ROWS = 100_000
# A page without a capture time is taken to be captured this long after FIRST, by its page_id.
FIRST = datetime(2024, 1, 1, tzinfo=UTC)
# The order of captures; nulls come first.
ORDER = ["url_key", "captured", "page_id", "file", "at"]
# Tasks that read archives at most; then each reads several files.
MOST_READERS = 20_000
TIME = pa.timestamp("us", tz="UTC")
RUN_COLUMNS = "url_key string, captured timestamp, page_id long, file string, at long, size long"
RECORD_COLUMNS = (
    "file string, at long, page_id long, record_type string, refers_to long, url string,"
    " captured timestamp, digest string, bytes long, html string"
)
# Fixed values of the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# ---------------------------------------------------------------------------
# Records
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Record:
    """A record as it was read. ``payload`` is None where the record has none of its own."""

    at: int
    size: int
    headers: dict[str, str]
    payload: bytes | None


URL = re.compile(r"[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#]*@)?([^/?#:]*)(:[0-9]*)?([^?#]*)(?:\?([^#]*))?")
WITHOUT_PORT = ("", ":", ":80", ":443")


def url_key(url: str | None) -> str:
    """Host labels from the last to the first, port, path and sorted query, in lower case. The scheme,
    a user, the usual ports, a leading ``www.`` and the fragment don't count. What isn't a URL is its
    own key; null has the empty one."""
    lowered = _ascii_lower(url or "")
    found = URL.match(lowered)
    if not found or not found[1]:
        return lowered
    host = ",".join(reversed(found[1].removeprefix("www.").split(".")))
    port = "" if (found[2] or "") in WITHOUT_PORT else found[2]
    query = "&".join(sorted(found[4].split("&"))) if found[4] else ""
    return f"{host}{port}){found[3] or '/'}" + (f"?{query}" if query else "")


def _ascii_lower(text: str) -> str:
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def _base32(digest: bytes) -> str:
    return f"sha1:{base64.b32encode(digest).decode()}"


def record_id(page_id: int | None, file: str, number: int) -> str:
    return f"<urn:page:{page_id}>" if page_id is not None else f"<urn:page:none:{file}:{number}>"


def _page_of(urn: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(found[1]) if found else None


def record(
    page_id: int | None,
    url: str | None,
    captured: datetime,
    payload: bytes,
    refers_to: int | None,
    name: str,
) -> bytes:
    """A response with its payload, or a revisit of ``refers_to`` with the digest of the payload."""
    digest = hashlib.sha1(payload).digest()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    lines = [
        VERSION,
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {name}",
        f"WARC-Date: {captured:%Y-%m-%dT%H:%M:%S.%fZ}",
        # A URL can't break out of its line.
        f"WARC-Target-URI: {quote(url or '', safe='%/:=&?~#+!$,;@()*[]|<>^`{}')}",
        f"WARC-Payload-Digest: {_base32(digest)}",
        f"WARC-Block-Digest: {_base32(hashlib.sha1(block).digest())}",
    ]
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def warcinfo(file: str) -> bytes:
    block = b"software: curbline\r\nformat: WARC File Format 1.1\r\n"
    lines = [
        VERSION,
        "WARC-Type: warcinfo",
        f"WARC-Record-ID: <urn:file:{file}>",
        f"WARC-Date: {FIRST:%Y-%m-%dT%H:%M:%SZ}",
        f"WARC-Filename: {file}",
        "Content-Type: application/warc-fields",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _header_lines(stream) -> dict[str, str]:
    """Names in lower case with values, up to the empty line; a line that begins with white space
    goes on with the one before."""
    headers, name = {}, ""
    while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
        text = line.decode("utf-8", "replace").rstrip("\r\n")
        if text[:1] in (" ", "\t") and name:
            headers[name] = f"{headers[name]} {text.strip()}".strip()
            continue
        name, _, value = text.partition(":")
        name = name.strip().lower()
        headers[name] = value.strip()
    return headers


def _payload(headers: dict[str, str], block: bytes) -> bytes | None:
    kind = headers.get("warc-type")
    if kind == "revisit":
        return None
    if headers.get("content-type", "").startswith("application/http"):
        head, end, body = block.partition(b"\r\n\r\n")
        return body if end else b""
    return block


def read_records(opened) -> Iterator[Record]:
    """The records of an archive, gzipped by record, gzipped as a whole or plain, in one pass.

    ``at`` and ``size`` are those of the gzip member that holds the record; a plain file counts as one
    member. A record is as long as its header says. An archive that ends too early raises EOFError.
    """
    source = _Source(opened)
    packed = source.peek(2) == b"\x1f\x8b"
    while source.peek(1):
        at, member = source.at, _Member(source, packed)
        stream = io.BufferedReader(member, 1 << 16)
        line = _next_line(stream)
        while line:
            if not line.startswith(b"WARC/"):
                raise ValueError(f"no record where one should begin: {line[:40]!r}")
            headers = _header_lines(stream)
            length = int(headers["content-length"])
            block = stream.read(length)
            if len(block) < length:
                raise EOFError("the archive ends within a record")
            line = _next_line(stream)
            yield Record(at, source.at - at, headers, _payload(headers, block))


def _next_line(stream) -> bytes:
    """The next line that isn't empty, or nothing at the end."""
    while (line := stream.readline()) in (b"\r\n", b"\n"):
        pass
    return line


class _Source:
    """A file read in blocks, of which a reader can give back what it doesn't need."""

    def __init__(self, opened, block: int = 1 << 18):
        self.opened, self.block, self.held, self.at = opened, block, b"", 0

    def take(self) -> bytes:
        found, self.held = self.held or self.opened.read(self.block), b""
        self.at += len(found)
        return found

    def give_back(self, rest: bytes) -> None:
        self.held, self.at = rest, self.at - len(rest)

    def peek(self, n: int) -> bytes:
        if len(self.held) < n:
            self.held += self.opened.read(self.block)
        return self.held[:n]


class _Member(io.RawIOBase):
    """The content of one gzip member, or of a plain file, as it is read."""

    def __init__(self, source: _Source, packed: bool):
        self.source, self.ready = source, b""
        self.machine = zlib.decompressobj(31) if packed else None

    def readable(self) -> bool:
        return True

    def readinto(self, into) -> int:
        while not self.ready and not (self.machine and self.machine.eof):
            block = self.source.take()
            if not self.machine:
                if not block:
                    return 0
                self.ready = block
                continue
            if not block:
                raise EOFError("the archive ends within a gzip member")
            self.ready = self.machine.decompress(block, 1 << 20)
            self.source.give_back(self.machine.unused_data or self.machine.unconsumed_tail)
        size = min(len(into), len(self.ready))
        into[:size], self.ready = self.ready[:size], self.ready[size:]
        return size


# ---------------------------------------------------------------------------
# Writing and reading archives in tasks
# ---------------------------------------------------------------------------


def with_responses(pages: DataFrame) -> DataFrame:
    """page_id, url, captured, html, and refers_to: of the rows with equal payloads of LEAST_REVISITED
    bytes or more, the largest page_id, null for the rows that have it themselves.

    Payloads that occur once stay out of the join's small side. Its large side, with the texts, is
    all that is shuffled; a payload that very many rows share is split over tasks.
    """
    time = F.col("captured") if "captured" in pages.columns else F.lit(None)
    since = F.timestamp_micros(
        F.lit(int(FIRST.timestamp()) * 1_000_000) + F.coalesce("page_id", F.lit(0)) * 1_000_000
    )
    own = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        time.cast("timestamp").alias("captured"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    ).withColumn("captured", F.coalesce("captured", since))
    body = F.col("html").cast("binary")
    keyed = own.withColumn("payload", F.when(F.length(body) >= LEAST_REVISITED, F.sha1(body)))
    groups = keyed.where("payload IS NOT NULL").groupBy("payload")
    groups = groups.agg(F.count("*").alias("n"), F.max("page_id").alias("response"))
    leaders = stored(groups.where("n > 1").select("payload", "response"), "responses")
    found = keyed.join(leaders, "payload", "left")
    refers_to = F.when(~F.col("response").eqNullSafe(F.col("page_id")), F.col("response"))
    return found.select("page_id", "url", "captured", "html", refers_to.alias("refers_to"))


def write_archives(
    rows: DataFrame, folder: str, file_bytes: int = FILE_BYTES, level: int = LEVEL
) -> DataFrame:
    """Write a record for each row (page_id, url, captured, html, refers_to) to archives in ``folder``.

    Returns the index runs: RUN_COLUMNS, those of a file together and sorted by URL key and time.
    """

    def run(batches):
        system, base = located(folder)
        system.create_dir(base, recursive=True)
        name, sink, entries, size = "", None, [], 0

        def closed():
            sink.close()
            keys, times, places, ats, sizes = zip(*sorted(entries), strict=True)
            return batch(
                url_key=pa.array(keys, pa.string()),
                captured=pa.array(times, TIME),
                page_id=pa.array([i if known else None for known, i in places], pa.int64()),
                file=pa.array([name] * len(keys), pa.string()),
                at=pa.array(ats, pa.int64()),
                size=pa.array(sizes, pa.int64()),
            )

        for part in batches:
            for row in part.to_pylist():
                if sink is None:
                    # No two attempts share a file.
                    name, entries = f"{uuid.uuid4().hex}.warc.gz", []
                    sink = system.open_output_stream(f"{base}/{name}", compression=None)
                    size = sink.write(gzip.compress(warcinfo(name), level, mtime=0))
                page_id, captured = row["page_id"], row["captured"].astimezone(UTC)
                content = record(
                    page_id,
                    row["url"],
                    captured,
                    row["html"].encode("utf-8", "surrogatepass"),
                    row["refers_to"],
                    record_id(page_id, name, len(entries)),
                )
                member = gzip.compress(content, level, mtime=0)
                place = (page_id is not None, page_id or 0)
                entries.append((url_key(row["url"]), captured, place, size, len(member)))
                sink.write(member)
                size += len(member)
                if size >= file_bytes:
                    yield closed()
                    sink = None
        if sink is not None:
            yield closed()

    return map_arrow(rows, run, RUN_COLUMNS)


def read_archives(folder: str, files: DataFrame) -> DataFrame:
    """A row for each response or revisit in the ``files`` (column file) of ``folder``.

    file, at, page_id, record_type, refers_to, url, captured, digest (as hex) and, for responses,
    bytes and html. A payload that doesn't have the digest of its header raises ValueError.
    """

    def run(batches):
        system, base = located(folder)
        for part in batches:
            for name in part.column("file").to_pylist():
                with system.open_input_file(f"{base}/{name}") as opened:
                    yield from _read_rows(name, read_records(opened))

    # A file is a task's work, and its name says nothing about its size.
    readers = max(1, min(MOST_READERS, files.count()))
    return map_arrow(files.select("file").repartitionByRange(readers, "file"), run, RECORD_COLUMNS)


def _read_rows(name: str, records: Iterable[Record]) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    held = 0
    for found in records:
        headers, payload = found.headers, found.payload
        kind = headers.get("warc-type")
        if kind not in ("response", "revisit"):
            continue
        digest = base64.b32decode(headers["warc-payload-digest"].partition(":")[2])
        if payload is not None and hashlib.sha1(payload).digest() != digest:
            raise ValueError(f"damaged payload in {name} at {found.at}")
        rows.append(
            (
                name,
                found.at,
                _page_of(headers["warc-record-id"]),
                kind,
                _page_of(headers.get("warc-refers-to")),
                headers.get("warc-target-uri"),
                datetime.fromisoformat(headers["warc-date"]),
                digest.hex(),
                None if payload is None else len(payload),
                None if payload is None else payload.decode("utf-8", "replace"),
            )
        )
        held += len(payload or b"")
        if held >= 1 << 22 or len(rows) >= 1000:
            yield _read_batch(rows)
            rows, held = [], 0
    if rows:
        yield _read_batch(rows)


def _read_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string()]
    types += [TIME, pa.string(), pa.int64(), pa.string()]
    names = "file at page_id record_type refers_to url captured digest bytes html".split()
    columns = zip(*rows, strict=True)
    arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names)


# ---------------------------------------------------------------------------
# The merged index
# ---------------------------------------------------------------------------


class LoserTree:
    """Merges sorted runs. Leaves are runs; an inner node holds the run that lost its match, and the
    winner of all stands above the root. Equal captures come in the order of the runs."""

    def __init__(self, runs: list[Iterator], key: Callable):
        self.runs, self.key = runs, key
        self.heads = [next(r, None) for r in runs]
        self.losers = [-1] * max(1, len(runs))
        for leaf in range(len(runs)):
            self._play(leaf)

    def _before(self, i: int, j: int) -> bool:
        """An exhausted run is after all others."""
        if self.heads[i] is None or self.heads[j] is None:
            return self.heads[j] is None and (self.heads[i] is not None or i < j)
        return (self.key(self.heads[i]), i) < (self.key(self.heads[j]), j)

    def _play(self, run: int) -> None:
        """From the leaf of the run upwards; where nobody waits yet, the run waits itself."""
        node, winner = (run + len(self.runs)) // 2, run
        while node:
            waiting = self.losers[node]
            if waiting < 0:
                self.losers[node] = winner
                return
            if self._before(waiting, winner):
                self.losers[node], winner = winner, waiting
            node //= 2
        self.losers[0] = winner

    def __iter__(self):
        if not self.runs:
            return
        while (head := self.heads[winner := self.losers[0]]) is not None:
            yield head
            self.heads[winner] = next(self.runs[winner], None)
            self._play(winner)


def place_of(row: tuple) -> tuple:
    """The order of a capture (url_key, captured, page_id, file, at, ...)."""
    key, captured, page_id, file, at = row[:5]
    return key, captured, page_id is not None, page_id or 0, file, at


def merge_runs(runs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """All captures in one order: RUN_COLUMNS, ``position`` (gapless from 0), and ``capture_no`` (from 1)
    and ``since_last`` (seconds) within the history of the URL key.

    Rows of a range come run by run as they were written. Where they don't, for example because a
    file of runs was read in two parts, a run that goes back ends and a new one begins, so the order
    of arrival doesn't matter. A URL key of very many captures spans several ranges.
    """
    ranges = max(1, -(-runs.count() // range_rows))
    dealt = runs.select(*ORDER, "size").repartitionByRange(ranges, *ORDER)

    def merge(batches):
        held: dict[str, list[list[tuple]]] = {}
        for part in batches:
            for row in zip(*(c.to_pylist() for c in part.columns), strict=True):
                own = held.setdefault(row[3], [[]])
                if own[-1] and place_of(own[-1][-1]) > place_of(row):
                    own.append([])
                own[-1].append(row)
        tree = LoserTree([iter(run) for own in held.values() for run in own], place_of)
        part, rows, number, last = TaskContext.get().partitionId(), [], 0, None
        for local, row in enumerate(tree):
            same = last is not None and last[0] == row[0]
            number = number + 1 if same else 1
            gap = (row[1] - last[1]) / timedelta(seconds=1) if same else None
            rows.append((*row, part, local, number, gap))
            last = row
            if len(rows) == 5000:
                yield merged_batch(rows)
                rows = []
        if rows:
            yield merged_batch(rows)

    def merged_batch(rows: list[tuple]) -> pa.RecordBatch:
        whole = pa.int64()
        types = [pa.string(), TIME, whole, pa.string(), whole, whole, pa.int32(), whole, whole, pa.float64()]
        columns = zip(*rows, strict=True)
        arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, [*ORDER, "size", "part", "local", "number", "gap"])

    schema = (
        "url_key string, captured timestamp, page_id long, file string, at long, size long,"
        " part int, local long, number long, gap double"
    )
    return with_history(stored(map_arrow(dealt, merge, schema), "merged-index"))


def with_history(merged: DataFrame) -> DataFrame:
    """Carries positions and histories over the borders of ranges, by a row or two for each range."""
    first = F.struct("url_key", "captured")
    last = F.max_by(F.struct("url_key", "captured", "number"), "local")
    borders = merged.groupBy("part").agg(
        F.count("*").alias("rows"), F.min_by(first, "local").alias("first"), last.alias("last")
    )
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before")
    borders = stored(borders.select("part", "rows", "first", "last", before), "range-borders")
    # How much of a key that crosses a border is in each range, and when it was captured last there.
    ends = borders.select("part", "last.*")
    begins = borders.where("first.url_key <> last.url_key").select("part", F.col("first.url_key").alias("url_key"))
    begun = merged.join(begins, ["part", "url_key"]).groupBy("part", "url_key")
    begun = begun.agg(F.max("captured").alias("captured"), F.max("number").alias("number"))
    by_key = Window.partitionBy("url_key").orderBy("part")
    carried = ends.unionByName(begun).select(
        "part",
        F.col("url_key").alias("carried_key"),
        F.sum("number").over(by_key.rowsBetween(Window.unboundedPreceding, -1)).alias("carried"),
        F.lag("captured").over(by_key).alias("carried_time"),
    )
    carried = stored(carried.where("carried IS NOT NULL"), "carried-histories")
    known = borders.select("part", "before", F.col("first.url_key").alias("first_key"))
    known = known.join(carried.withColumnRenamed("part", "of_part"), (F.col("part") == F.col("of_part")) & (F.col("first_key") == F.col("carried_key")), "left")
    goes_on = F.coalesce(F.col("url_key") == F.col("carried_key"), F.lit(False))
    seconds = (F.unix_micros("captured") - F.unix_micros("carried_time")) / 1_000_000
    known = stored(known.drop("of_part", "first_key"), "range-starts")
    return merged.join(known, "part").select(
        *ORDER,
        "size",
        (F.col("before") + F.col("local")).alias("position"),
        (F.col("number") + F.when(goes_on, F.col("carried")).otherwise(0)).alias("capture_no"),
        F.when(goes_on & (F.col("local") == 0), seconds).otherwise(F.col("gap")).alias("since_last"),
    )


@dataclass(frozen=True)
class Archive:
    """``folder`` with the archives, and the index of all captures in order."""

    folder: str
    index: DataFrame

    def records(self) -> DataFrame:
        """What the archives hold, read back; payloads of revisits are in their responses."""
        files = stored(self.index.select("file").distinct(), "archive-files")
        return read_archives(self.folder, files)

    def fetch(self, captures: DataFrame) -> DataFrame:
        """The records of some rows of the index, each read from its place in its file alone."""
        folder = self.folder

        def run(batches):
            system, base = located(folder)
            for part in batches:
                for row in part.to_pylist():
                    with system.open_input_file(f"{base}/{row['file']}") as opened:
                        opened.seek(row["at"])
                        [found] = read_records(io.BytesIO(opened.read(row["size"])))
                    yield from _read_rows(row["file"], [replace(found, at=row["at"])])

        return map_arrow(captures.select("file", "at", "size"), run, RECORD_COLUMNS)


def archive(pages: DataFrame, folder: str | None = None) -> Archive:
    """Archive every row of ``pages`` (page_id, url, html, and captured where there is one).

    A null html is an empty payload, a null url an empty one. Rows without page_id never are what
    others refer to; where no row of a group of equal payloads has one, all are responses. Rows
    that share the largest page_id of a group are all responses. Other columns are ignored.
    """
    spark = pages.sparkSession
    folder = folder or fresh_path(spark, "llm-archives")
    runs = stored(write_archives(with_responses(pages), folder), "index-runs")
    return Archive(folder, merge_runs(runs))


def resolved(records: DataFrame) -> DataFrame:
    """file, at, page_id, record_type, refers_to, and bytes and digest of the full payload: a revisit
    has those of the response that it refers to. A revisit whose digest its response lacks, or
    without a response, has null bytes."""
    own = stored(records.drop("html", "url", "captured"), "archive-rows")
    asked = own.where("refers_to IS NOT NULL").select(
        F.col("refers_to").alias("target"), F.col("digest").alias("wanted")
    ).distinct()
    answers = own.where("record_type = 'response'").select(
        F.col("page_id").alias("target"), F.col("digest").alias("wanted"), F.col("bytes").alias("found")
    )
    answers = stored(answers.join(asked, ["target", "wanted"]).distinct(), "revisited")
    same = (own["refers_to"] == answers["target"]) & (own["digest"] == answers["wanted"])
    return own.join(answers, same, "left").select(
        "file", "at", "page_id", "record_type", "refers_to", F.coalesce("bytes", "found").alias("bytes"), "digest"
    )


def captures(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Archive ``pages``, read the archives back and join each record with its place in the index.

    page_id, payload_bytes, payload_digest, record_type, refers_to, url_key, position, capture_no and
    since_last of every row. An empty table gives no rows.
    """
    made = archive(pages, folder)
    index = made.index.select("file", "at", "url_key", "position", "capture_no", "since_last")
    return resolved(made.records()).join(index, ["file", "at"]).select(
        "page_id",
        F.col("bytes").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        "record_type",
        "refers_to",
        "url_key",
        "position",
        "capture_no",
        "since_last",
    )


SQL = r"""
WITH own AS (
  SELECT CAST(page_id AS BIGINT) AS page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes,
    translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS url
  FROM pages),
parts AS (
  SELECT *, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#]*@)?([^/?#:]*)(:[0-9]*)?([^?#]*)(?:\?([^#]*))?',
    ['host', 'port', 'path', 'query']) AS u
  FROM own),
keyed AS (
  SELECT page_id, html, payload_bytes, CASE WHEN u.host = '' THEN url ELSE
      array_to_string(list_reverse(string_split(regexp_replace(u.host, '^www\.', ''), '.')), ',')
      || CASE WHEN u.port IN ('', ':', ':80', ':443') THEN '' ELSE u.port END || ')'
      || CASE WHEN u.path = '' THEN '/' ELSE u.path END
      || CASE WHEN u.query = '' THEN '' ELSE '?' || array_to_string(list_sort(string_split(u.query, '&')), '&') END
    END AS url_key
  FROM parts),
largest AS (
  SELECT html, max(page_id) AS response FROM own WHERE payload_bytes >= 1000 GROUP BY html HAVING count(*) > 1)
SELECT page_id, payload_bytes, sha1(html) AS payload_digest,
  CASE WHEN response IS NOT NULL AND page_id IS DISTINCT FROM response THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM response THEN response END AS refers_to,
  url_key,
  row_number() OVER (ORDER BY url_key, coalesce(page_id, 0), page_id NULLS FIRST) - 1 AS position,
  row_number() OVER (PARTITION BY url_key ORDER BY coalesce(page_id, 0), page_id NULLS FIRST) AS capture_no
FROM keyed LEFT JOIN largest USING (html)"""
