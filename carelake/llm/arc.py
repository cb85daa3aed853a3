r"""Legacy ARC archives: writer, reader, converter to WARC, and WARC writer and reader.

An ARC file begins with a version block (``filedesc://``); every record is a header line
and as many bytes as the line declares.  Version 1 lines have five fields (URL, IP
address, 14-digit date, content type, length), version 2 lines have ten (result code,
checksum, location, offset and file name come before the length).  The reader parses the
lines by the version of their file, from the right, so that a blank in a URL does no
harm; a line that is no header is skipped, and a record cut off by the end of its file
is kept as truncated.

The converter makes WARC/1.1 records of them: the id is a name-based UUID of the file
and the place in it (a task that runs again makes the same), the date is ISO 8601, the
type is warcinfo (version block), response (HTTP messages) or resource (all else), digests are
base32 SHA-1 of block and payload.  ``mark_revisits`` keeps the payload of one response of
all with equal payloads; the others become revisit records that hold their HTTP header
and refer to it.

Files are written by Spark's text writer, gzipped, with the record separator as line
separator, into the shared folder, one file a task.  They are read as a stream of lines in
Spark's tasks, so that a task holds a batch of lines and one record, however large the
file.  Spark never splits a gzipped file.  It does split plain ones, at any byte: their lines are brought
together by file and sorted by split and place first.  Payloads are bytes; they need not be UTF-8.

Cases: a null page is an empty payload, a null URL becomes ``http://page.invalid/``,
blanks in URLs are escaped, equal largest ids are settled by the record id, null ids
count as smallest, repeated rows are records of their own, an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm.common import col, shared_path

#: fixed values of the formats
ARC_FIELDS = {1: "URL IP-address Archive-date Content-type Archive-length",
              2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "20240101000000"

ARC_RECORD = ("warc_id string, type string, uri string, ip string, date string, mime string, header binary, "
              "payload binary, payload_bytes long, payload_digest string, block_digest string, "
              "header_digest string, truncated boolean, arc_version int")
WARC_RECORD = ("warc_id string, type string, uri string, date string, refers_to string, header binary, "
               "payload binary, payload_digest string, block_intact boolean")


def text_bytes(*parts: Column) -> Column:
    return F.concat(*[p.cast("binary") for p in parts])


def write_lines(records: Column, df: DataFrame, separator: str, path: str) -> None:
    """One gzipped file a task of the records' bytes, each followed by the separator."""
    df.select(records.cast("string").alias("value")).write.option("lineSep", separator).option(
        "compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(path)


def write_arc(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html") -> None:
    """ARC files of HTTP messages with the pages as payload, in versions 1 and 2 by turns.

    The HTTP header of a message carries the page's id as ``X-Page-Id``.
    """
    src = pages.select(col(page_id).alias("id"), col(url).cast("string").alias("url"),
                       F.coalesce(col(html).cast("string"), F.lit("")).cast("binary").alias("payload"))
    safe = F.regexp_replace(F.when(F.length(F.trim("url")) > 0, F.col("url")).otherwise("http://page.invalid/"),
                            r"[\s\x00-\x20]", "%20")
    header = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: "),
                      F.octet_length("payload").cast("string"),
                      F.coalesce(F.concat(F.lit("\r\nX-Page-Id: "), F.col("id").cast("string")), F.lit("")),
                      F.lit("\r\n\r\n"))
    body = src.withColumn("body", text_bytes(header, F.col("payload"))).withColumn("safe", safe)
    size = F.octet_length("body").cast("string")
    version = F.spark_partition_id() % 2 + 1
    line = F.when(version == 1, F.concat_ws(" ", "safe", F.lit(f"0.0.0.0 {DATE} text/html"), size)).otherwise(
        F.concat_ws(" ", "safe", F.lit(f"0.0.0.0 {DATE} text/html 200 - - 0 pages.arc.gz"), size))
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0

    def block(v: int) -> str:
        said = f"{v} 0 carelake\n{ARC_FIELDS[v]}\n"
        own = f"filedesc://pages.arc.gz 0.0.0.0 {DATE} text/plain"
        return f"{own}{' 200 - - 0 pages.arc.gz' if v == 2 else ''} {len(said)}\n{said}\n"

    opening = F.when(first, F.when(version == 1, F.lit(block(1))).otherwise(F.lit(block(2)))).otherwise(F.lit(""))
    write_lines(text_bytes(opening, line, F.lit("\n"), F.col("body")), body, "\n", path)


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


class Lines:
    """The bytes of one file, line by line, with what is put back and the place reached."""

    def __init__(self, lines: Iterator[bytes]):
        self.lines, self.back, self.at = lines, None, 0

    def next(self) -> bytes | None:
        line = self.back if self.back is not None else next(self.lines, None)
        self.back = None
        if line is not None:
            self.at += len(line) + 1
        return line

    def take(self, n: int) -> bytes:
        """The next n bytes, or fewer at the end of the file."""
        parts, got = [], 0
        while got < n and (line := self.next()) is not None:
            parts += [line, b"\n"]
            got += len(line) + 1
        data = b"".join(parts)
        rest = data[n:]
        if len(rest) > 1:  # the record ends inside a line
            self.back = rest[:-1]
            self.at -= len(rest)
        return data[:n]


def read_files(spark: SparkSession, path: str, parse, schema: str) -> DataFrame:
    """``parse(name, Lines)`` gives the rows of each archive below ``path``."""
    lines = spark.read.option("lineSep", "\n").text(path)
    name, line = F.col("_metadata.file_path").alias("name"), F.col("value").cast("binary").alias("line")
    zipped = F.col("_metadata.file_path").endswith(".gz")
    # ids rise inside a split, also where a task reads several
    plain = lines.where(~zipped).select(name, line, F.col("_metadata.file_block_start").alias("split"),
                                        F.monotonically_increasing_id().alias("place"))
    plain = plain.repartition("name").sortWithinPartitions("name", "split", "place").select("name", "line")
    src = lines.where(zipped).select(name, line)
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flow = ((n, x) for b in batches for n, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
        ahead = [next(flow, None)]
        types = run.types

        def of(name):
            while ahead[0] is not None and ahead[0][0] == name:
                yield ahead[0][1]
                ahead[0] = next(flow, None)

        rows, size = [], 0
        while ahead[0] is not None:
            name = ahead[0][0]
            lines = of(name)
            for row in parse(name, Lines(lines)):
                rows.append(row)
                size += sum(len(x) for x in row if isinstance(x, bytes))
                if size > 8 << 20 or len(rows) >= 5000:
                    yield batch(rows, types, names)
                    rows, size = [], 0
            for _ in lines:  # what follows the last record
                pass
        if rows:
            yield batch(rows, types, names)

    simple = {"string": pa.string(), "binary": pa.binary(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
    run.types = [simple[f.split()[1]] for f in schema.split(", ")]
    return src.mapInArrow(run, schema).unionAll(plain.mapInArrow(run, schema))


def batch(rows: list[tuple], types: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows, strict=True), types, strict=True)],
                                      names=names)


def iso_date(arc_date: str) -> str:
    """ISO 8601 of an ARC date of up to 14 digits; the epoch for anything else."""
    m = re.fullmatch(r"(\d{4})(\d\d)?(\d\d)?(\d\d)?(\d\d)?(\d\d)?", arc_date)
    y, mo, d, h, mi, s = m.groups() if m else ("1970",) + (None,) * 5
    return f"{y}-{mo or '01'}-{d or '01'}T{h or '00'}:{mi or '00'}:{s or '00'}Z"


def parse_arc(name: str, lines: Lines) -> Iterator[tuple]:
    """The records of one ARC file, converted (see ``ARC_RECORD``)."""
    version = 1
    while True:
        at = lines.at
        line = lines.next()
        if line is None:
            return
        head = line.rstrip(b"\r").decode("utf-8", "replace")
        described = head.startswith("filedesc://")
        if described:  # five fields or ten: the line itself tells
            version = 2 if len(head.split(" ")) >= 10 else 1
        fields = head.rsplit(" ", 4 if version == 1 else 9)
        if len(fields) < (5 if version == 1 else 10) or not re.fullmatch(r"\d{1,18}", fields[-1]):
            continue  # the blank line between records, or damage
        url, ip, date, mime = fields[:4]
        block = lines.take(int(fields[-1]))
        truncated = len(block) < int(fields[-1])
        if described:
            said = block.split(b" ", 1)[0]
            version = int(said) if said in (b"1", b"2") else version
        kind, header, payload = "resource", b"", block
        if described:
            kind = "warcinfo"
        elif block.startswith(b"HTTP/"):
            kind = "response"
            end = block.find(b"\r\n\r\n")
            header, payload = (block, b"") if end < 0 else (block[:end + 4], block[end + 4:])
        own = uuid.uuid5(uuid.NAMESPACE_URL, f"arc:{name}#{at}")
        yield (f"urn:uuid:{own}", kind, url, ip, iso_date(date), mime, header, payload, len(payload), digest(payload),
               digest(block), digest(header), truncated, version)


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    """The records of ARC files as what their WARC equivalents need."""
    return read_files(spark, path, parse_arc, ARC_RECORD)


def mark_revisits(records: DataFrame, order: Column, least_bytes: int = 0) -> DataFrame:
    """``records`` with ``refers_to``: for responses whose payload another one keeps, its id.

    The keeper of a payload is the response with the largest ``order``.  Digests are
    reduced before the shuffle; payloads move once, keyed by the unique record id.
    """
    light = records.where((F.col("type") == "response") & (F.col("payload_bytes") >= least_bytes)).select(
        "warc_id", "payload_digest", "payload_bytes", order.alias("o"))
    keeper = light.groupBy("payload_digest", "payload_bytes").agg(
        F.max(F.struct("o", "warc_id"))["warc_id"].alias("keeper"))
    others = light.join(keeper, ["payload_digest", "payload_bytes"]).where("warc_id <> keeper").select(
        F.col("warc_id").alias("id"), F.col("keeper").alias("refers_to"))
    return records.join(others, F.col("warc_id") == F.col("id"), "left").drop("id")


def write_warc(records: DataFrame, path: str) -> None:
    """WARC files of the records of ``mark_revisits``."""
    again = F.col("refers_to").isNotNull()
    kind = F.when(again, "revisit").otherwise(F.col("type"))
    block = F.when(again, F.col("header")).otherwise(F.concat("header", "payload"))
    mime = F.when(F.col("type") == "response", F.lit("application/http; msgtype=response")).when(
        F.col("type") == "warcinfo", F.lit("text/plain")).otherwise(F.col("mime"))

    def field(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))

    filed = F.col("type") == "warcinfo"
    head = F.concat(
        F.lit("WARC/1.1\r\n"), field("WARC-Type", kind),
        field("WARC-Record-ID", F.concat(F.lit("<"), F.col("warc_id"), F.lit(">"))), field("WARC-Date", F.col("date")),
        field("WARC-Target-URI", F.when(~filed, F.col("uri"))), field("WARC-IP-Address", F.when(~filed, F.col("ip"))),
        field("WARC-Payload-Digest", F.when(~filed, F.concat(F.lit("sha1:"), F.col("payload_digest")))),
        field("WARC-Block-Digest", F.concat(F.lit("sha1:"), F.when(again, F.col("header_digest")).otherwise(
            F.col("block_digest")))),
        field("WARC-Profile", F.when(again, F.lit(REVISIT_PROFILE))),
        field("WARC-Refers-To", F.concat(F.lit("<"), F.col("refers_to"), F.lit(">"))),
        field("WARC-Truncated", F.when(F.col("truncated"), F.lit("length"))),
        field("Content-Type", mime), field("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"))
    write_lines(text_bytes(head, block), records, "\r\n\r\n", path)


def parse_warc(name: str, lines: Lines) -> Iterator[tuple]:
    """The records of one WARC file (see ``WARC_RECORD``)."""
    while (line := lines.next()) is not None:
        if not line.startswith(b"WARC/"):
            continue
        fields: dict[str, str] = {}
        while (line := lines.next()) is not None and line.rstrip(b"\r"):
            k, _, v = line.rstrip(b"\r").decode("utf-8", "replace").partition(":")
            fields[k.strip().lower()] = v.strip()
        size = fields.get("content-length", "")
        if not size.isdigit():
            continue
        block = lines.take(int(size))
        header, payload = b"", block
        if fields.get("content-type", "").startswith("application/http"):
            end = block.find(b"\r\n\r\n")
            header, payload = (block, b"") if end < 0 else (block[:end + 4], block[end + 4:])
        bare = lambda k: fields[k].strip("<>") if k in fields else None
        sha = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
        intact = len(block) == int(size) and fields.get("warc-block-digest") == f"sha1:{digest(block)}"
        yield (bare("warc-record-id"), fields.get("warc-type"), fields.get("warc-target-uri"), fields.get("warc-date"),
               bare("warc-refers-to"), header, payload, sha, intact)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    return read_files(spark, path, parse_warc, WARC_RECORD)


def resolve_revisits(records: DataFrame, key: Column) -> DataFrame:
    """Per response or revisit: key, payload_bytes and payload_digest of the full payload,
    record_type, refers_to (the key of the response referred to)."""
    light = records.where(F.col("type").isin("response", "revisit")).select(
        key.alias("key"), "warc_id", "type", "refers_to", F.octet_length("payload").cast("long").alias("n"),
        "payload_digest")
    kept = light.where("type = 'response'").select(F.col("warc_id").alias("id"), F.col("key").alias("kept_key"),
                                                   F.col("n").alias("kept_n"))
    return light.join(kept, F.col("refers_to") == F.col("id"), "left").select(
        "key", F.when(F.col("type") == "response", F.col("n")).otherwise(F.col("kept_n")).alias("payload_bytes"),
        "payload_digest", F.col("type").alias("record_type"), F.col("kept_key").alias("refers_to"))


def page_key(header: Column) -> Column:
    return F.regexp_extract(F.decode(header, "UTF-8"), r"\r\nX-Page-Id: (-?\d+)\r\n", 1).try_cast("long")


def archive_pages(pages: DataFrame, least_bytes: int = 0, **columns) -> DataFrame:
    """Pages written as ARC files, converted to WARC files with revisits, and read back."""
    spark = pages.sparkSession
    arc, warc = shared_path(spark, "arc"), shared_path(spark, "warc")
    write_arc(pages, arc, **columns)
    write_warc(mark_revisits(read_arc(spark, arc), page_key(F.col("header")), least_bytes), warc)
    return resolve_revisits(read_warc(spark, warc), page_key(F.col("header")))
