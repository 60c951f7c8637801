"""WARC archives: written by Spark, read back by a reader that salvages what is left.

Writing: one record per row, payload the html in UTF-8. Of records with equal
payloads of at least `least` bytes the one with the smallest page_id is a
response, the others are revisit records without payload that name it. In a gzip
archive each record is a member of its own, so damage costs the records that it
touches and no later ones. Spark's text writer writes the members, as it writes
any bytes of a string, anywhere Spark can write and with its commits; its line
separator is then an empty member. Without compression, records end in two empty
lines, which is the separator. Rows are written by classes of size, each with as
many records to a file as keep it within FILE_BYTES.

Reading: a record is accepted if its version line, its header, its length, the
separator behind it, the length of its payload and its digest are right. A
record whose header and length hold but whose payload does not is skipped whole,
so that nothing inside a damaged payload is taken for a record. After any other
failed check the reader looks for the next version line (in a compressed archive,
first for the next member that inflates), goes on there, and logs the bytes
between as a quarantined gap, so later records survive damage to earlier ones.

Cases: null html is an empty payload; null urls and ids are left out of the header
and read back as null, as are ids that are no 64-bit numbers; control characters
and % in urls are percent-encoded and decoded again; rows that repeat the smallest
page_id of equal payloads are all responses; further columns of the input, whatever
their names, are not written; no rows give an archive without records.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemart.llm.shared import SMALL, join_hot, stored

VERSION, BREAK = "WARC/1.1", "\r\n\r\n"
#: A gzip member of no content.
EMPTY = gzip.compress(b"", mtime=0)
LEAST = 100
#: Bytes of payload of an archive file at most (a larger record has a file of its own); a file is read as one piece.
FILE_BYTES = 256 << 20
#: Largest payload of each class of sizes but the last, which has no bound.
CLASSES = (1 << 16, 1 << 20, 1 << 24)
FIELDS = "file string, offset long, length long, inner_offset long, kind string, reason string, page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"


def _line(name: str, value: Column) -> Column:
    """A header line; nothing for null."""
    return F.coalesce(F.concat(F.lit(f"\r\n{name}: "), value.cast("string")), F.lit(""))


def records(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """(value, size) the records as text, from (page_id, url, html), and the bytes of the whole payload.

    Pages are hashed once for groups of equal payloads. Groups of more than one
    are joined back: broadcast if they are few, otherwise by a shuffle from which
    pages too short for a group, and groups of a large share of all pages, are kept out.
    """
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"), F.octet_length(html).cast("long").alias("size"), F.sha2(html, 256).alias("digest"))
    long = rows.where(F.col("size") >= least)
    # Partly aggregated before the shuffle, so an often repeated payload is a row for each task.
    alike = stored(long.groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1"), "alike")
    groups, members = alike.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    if groups <= SMALL:
        rows = rows.join(F.broadcast(alike.select("digest", "first_id")), "digest", "left")
    else:
        single = F.lit(None).cast("long")
        unlike = rows.where(F.col("size") < least).withColumn("first_id", single).unionByName(long.join(alike.select("digest"), "digest", "left_anti").withColumn("first_id", single))
        rows = unlike.unionByName(join_hot(long, alike, "digest", "n", members).drop("n"))
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    body = F.when(revisit, "").otherwise(F.col("html"))
    encoded = F.replace(F.replace(F.replace(F.replace("url", F.lit("%"), F.lit("%25")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")), F.lit("\x00"), F.lit("%00"))
    head = F.concat(
        F.lit(VERSION),
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.col("page_id").cast("string"), F.lit(">"))),
        _line("WARC-Target-URI", encoded),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        _line("X-Payload-Length", F.col("size")),
        _line("WARC-Refers-To", F.when(revisit, F.concat(F.lit("<urn:page:"), F.col("first_id").cast("string"), F.lit(">")))),
        _line("Content-Length", F.octet_length(body)),
        F.lit(BREAK),
    )
    return rows.select(F.concat(head, body).alias("value"), "size")


def write(pages: DataFrame, path: str, least: int = LEAST, compression: str = "gzip") -> None:
    """Writes archives of pages (page_id, url, html) into folders under path, one for each class of sizes there is."""
    found = records(pages, least)
    # From the pages themselves, as that reads no more than lengths.
    size = F.coalesce(F.octet_length("html").cast("long"), F.lit(0))
    number = sum((F.when(size > bound, 1).otherwise(0) for bound in CLASSES), F.lit(0))
    classes = {r["c"]: r["most"] for r in pages.groupBy(number.alias("c")).agg(F.max(size).alias("most")).collect()} or {0: 0}
    for c, most in sorted(classes.items()):
        rows, separator, encoding, how = found, BREAK, "UTF-8", compression
        if len(classes) > 1:
            lower, upper = (CLASSES[c - 1] if c else -1), (CLASSES[c] if c < len(CLASSES) else None)
            rows = rows.where(F.col("size") > lower) if upper is None else rows.where((F.col("size") > lower) & (F.col("size") <= upper))
        rows = rows.select("value")
        if compression == "gzip":
            rows = rows.select(F.col("value").cast("binary").alias("value")).mapInArrow(_members, "value binary").select(F.col("value").cast("string").alias("value"))
            separator, encoding, how = EMPTY.decode("latin-1"), "ISO-8859-1", "none"
        per_file = max(1, FILE_BYTES // max(most, CLASSES[0]))
        rows.write.option("lineSep", separator).option("encoding", encoding).option("compression", how).option("maxRecordsPerFile", per_file).text(f"{path}/size-{c}")


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each record, with the empty lines that end it, as a gzip member."""
    for batch in batches:
        for at in range(0, len(batch), 500):
            made = [gzip.compress(v.as_py() + BREAK.encode(), 6, mtime=0) for v in batch.column(0).slice(at, 500)]
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], names=["value"])


def inflated(data: bytes) -> Iterator[tuple[int, int, bytes | None]]:
    """(offset, length, content) of each compressed member; content None for a gap.

    A member that breaks off gives what could be inflated, then a gap.
    """
    at = 0
    while at < len(data):
        member, out, fed = zlib.decompressobj(31), [], at
        try:
            while fed < len(data) and not member.eof:
                piece = data[fed : fed + 65536]
                out.append(member.decompress(piece))
                fed += len(piece)
            whole = member.eof
        except zlib.error:
            whole = False
            out.append(_rest(data, at, fed))
        if whole:
            end = fed - len(member.unused_data)
            yield at, end - at, b"".join(out)
            at = end
            continue
        content = b"".join(out)
        following = next((m.start() for m in re.compile(rb"\x1f\x8b\x08").finditer(data, at + 1) if _inflates(data, m.start())), None)
        end = len(data) if following is None else following
        if content:
            yield at, 0, content
        yield at, end - at, None
        at = end


def _rest(data: bytes, at: int, fed: int) -> bytes:
    """What the member at `at` gives between `fed`, up to where it inflates in large pieces, and its first error."""
    member, out = zlib.decompressobj(31), []
    for i in range(at, fed, 65536):
        member.decompress(data[i : min(i + 65536, fed)])
    try:
        for i in range(fed, len(data)):
            out.append(member.decompress(data[i : i + 1]))
    except zlib.error:
        pass
    return b"".join(out)


def _inflates(data: bytes, at: int) -> bool:
    """Whether a member that starts here inflates to something that starts like a record."""
    try:
        return zlib.decompressobj(31).decompress(data[at : at + 4096], 64).startswith(b"WARC/")
    except zlib.error:
        return False


def parse(data: bytes) -> Iterator[tuple[int, int, str, dict, bytes]]:
    """(offset, length, reason, header, payload) of records; reason is "" for valid ones, else a gap."""
    at, gap, why, stop = 0, None, "", data.find(BREAK.encode())
    while at < len(data):
        # One search serves all places before its finding, so damage costs no second one.
        if 0 <= stop < at:
            stop = data.find(BREAK.encode(), at)
        reason, end, header, body = check(data, at, stop)
        if not reason:
            if gap is not None:
                yield gap, at - gap, why, {}, b""
                gap = None
            yield at, end - at, "", header, body
            at = end
            continue
        if gap is None:
            gap, why = at, reason
        if end > at:  # its own length is right: what is inside is no record
            at = end
            continue
        following = data.find(b"WARC/", at + 1)
        at = len(data) if following < 0 else following
    if gap is not None:
        yield gap, len(data) - gap, why, {}, b""


def check(data: bytes, at: int, stop: int) -> tuple[str, int, dict, bytes]:
    """(reason, end, header, payload) of a record that should begin at `at`; stop is where the next empty line begins, or -1.

    A header may have any length, but a line without a colon, such as a version line, or a field named twice is none of its own.
    With a reason, an end behind `at` is that of a record that is whole but for its payload.
    """
    if not re.compile(rb"WARC/1\.[01]\r\n").match(data, at):
        return "no version line", at, {}, b""
    if stop < 0:
        return "header without end", at, {}, b""
    header, end = {}, data.find(b"\r\n", at)
    while end < stop:
        begin = end + 2
        end = data.find(b"\r\n", begin)
        name, colon, value = data[begin:end].partition(b":")
        if not colon:
            return "header line without colon", at, {}, b""
        field = name.strip().lower().decode("latin-1")
        if field in header and field != "warc-concurrent-to":
            return "header runs into another", at, {}, b""
        header[field] = value.strip().decode("utf-8", "replace")
    length = _whole(header.get("content-length"))
    if length is None:
        return "no content length", at, {}, b""
    first, last = stop + 4, stop + 4 + length
    if data[last : last + 4] != b"\r\n\r\n":
        return "wrong content length", at, {}, b""
    body, digest = data[first:last], header.get("warc-payload-digest", "")
    if header.get("warc-type") != "revisit":
        as_said = "x-payload-length" not in header or _whole(header["x-payload-length"]) == length
        if digest.startswith("sha256:") and hashlib.sha256(body).hexdigest() != digest[7:]:
            # Where the other length disagrees, this one may be what is damaged.
            return "wrong digest", last + 4 if as_said else at, {}, b""
        if not as_said:
            return "wrong payload length", last + 4, {}, b""
    return "", last + 4, header, body


def _whole(value: str | None) -> int | None:
    """A number of at most 18 ASCII digits."""
    return int(value) if re.fullmatch("[0-9]{1,18}", value or "") else None


def _number(value: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?[0-9]{1,19})>", value or "")
    number = int(found[1]) if found else None
    return number if number is not None and -(1 << 63) <= number < 1 << 63 else None


def rows_of(file: str, data: bytes) -> Iterator[tuple]:
    """Rows of FIELDS from one archive.

    offset and length are places in the file: in a compressed archive those of the
    member, and inner_offset is the place in what it inflates to.
    """
    packed = data[:2] == b"\x1f\x8b" or file.endswith(".gz")
    for start, size, content in inflated(data) if packed else [(0, len(data), data)]:
        if content is None:
            yield file, start, size, None, "gap", "broken member", None, None, None, None, None, None, None
            continue
        found = parse(content)
        if packed and not size:
            # Its checksum is not right, which covers headers too. Where members hold a record each, that is this one.
            found = list(found)
            if len(found) == 1:
                continue
        for offset, length, reason, header, body in found:
            place = (start, size, offset) if packed else (offset, length, None)
            if reason:
                yield file, *place, "gap", reason, None, None, None, None, None, None, None
                continue
            url = header.get("warc-target-uri")
            if url is not None:
                url = url.replace("%00", "\x00").replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
            kind = header.get("warc-type")
            payload_bytes = _whole(header.get("x-payload-length")) if kind == "revisit" else len(body)
            yield file, *place, "record", None, _number(header.get("warc-record-id")), url, kind, payload_bytes, header.get("warc-payload-digest", "").removeprefix("sha256:") or None, _number(header.get("warc-refers-to")), body


def read(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """FIELDS of all records (kind record) and quarantined gaps (kind gap) of the archives in path and below it."""
    names = [f.split()[0] for f in FIELDS.split(", ")]
    kinds = [{"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[f.split()[1]] for f in FIELDS.split(", ")]

    def salvage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

        for batch in batches:
            for file, data in zip(*batch.columns, strict=True):
                rows = []
                for row in rows_of(file.as_py(), data.as_py()):
                    rows.append(row if payloads else (*row[:-1], None))
                    if len(rows) >= 500:
                        yield out(rows)
                        rows = []
                if rows:
                    yield out(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", "true").load(path).select("path", "content")
    return files.mapInArrow(salvage, FIELDS)
