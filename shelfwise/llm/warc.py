"""WARC archives of pages: payloads kept once, revisit records resolved by payload digest.

Headers (no payloads) are shuffled by payload digest. Of records with one payload the first is the response and
the others become revisit records that refer to it; they carry fresh headers and no payload. Archives are text
files of Spark's own writer, whose line separator is the end of a record, and are read back line by line, so a
task holds one record at a time and a lost executor's files are written anew under the writer's commit protocol.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import checkpointed
from shelfwise.session import shared_folder, staging, stored

# --------------------------------------------------------------------------
# The format's version line, the profile of payload-identical revisits, record end.
# --------------------------------------------------------------------------
VERSION = "WARC/1.1"
IDENTICAL_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_END = "\r\n\r\n"
LEAST_BYTES = 100

RECORD = (
    "record_type string, record_id string, page_id string, target_uri string, date string, payload_digest string, "
    "refers_to string, refers_to_uri string, payload binary"
)
FIELDS = {
    "WARC-Type": "record_type", "WARC-Record-ID": "record_id", "Page-Id": "page_id", "WARC-Target-URI": "target_uri",
    "WARC-Date": "date", "WARC-Payload-Digest": "payload_digest", "WARC-Refers-To": "refers_to",
    "WARC-Refers-To-Target-URI": "refers_to_uri",
}
HEADER_END = re.compile(rb"\r?\n\r?\n")


def placed(pages: DataFrame) -> DataFrame:
    """``pages`` with (file, at): a stable place of each row. What isn't a Parquet scan is stored first."""
    try:
        place = pages.metadataColumn("_metadata")
        return pages.select("*", F.xxhash64(place["file_path"]).alias("file"), place["row_index"].alias("at"))
    except AnalysisException:
        return placed(stored(pages))


def headers_of(pages: DataFrame) -> DataFrame:
    """(file, at, page_id, url, bytes, digest) of placed pages with their ``html``; null payloads are empty."""
    payload = F.encode(F.coalesce("html", F.lit("")), "utf-8")
    return pages.select(
        "file", "at", "page_id", "url", F.octet_length(payload).cast("long").alias("bytes"), F.sha2(payload, 256).alias("digest")
    )


def revisits_of(headers: DataFrame, least_bytes: int) -> DataFrame:
    """Headers of the records that repeat another's payload, with the page_id, url and place of that record.

    The smallest page_id comes first, null ids last, equal ids by place. First ones are aggregated in the map tasks
    and only digests that occur twice are joined back, to headers; a digest of very many is left to skew splitting.
    """
    large = headers.filter(F.col("bytes") >= least_bytes)
    order = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "file", "at")
    first = large.groupBy("digest").agg(
        F.min(order).alias("first"), F.min_by("url", order).alias("first_url"), F.count("*").alias("n")
    )
    repeated = stored(first.filter("n > 1").select("digest", "first", "first_url"))
    return large.join(repeated, "digest").filter((F.col("file") != F.col("first.file")) | (F.col("at") != F.col("first.at")))


def record_id(file: Column, at: Column) -> Column:
    """A URN that is the record's own: its row's place, hashed."""
    digest = F.md5(F.concat_ws(":", F.hex(file), at.cast("string")))
    places = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(digest, a, n) for a, n in places]), F.lit(">"))


def uri(url: Column) -> Column:
    """A URL that fits a header line: blanks, control signs and line ends are percent-encoded."""
    bad = F.regexp_extract_all(url, F.lit(r"([\x00-\x20\x7F])"), F.lit(1))
    return F.aggregate(
        F.array_distinct(bad), url, lambda text, c: F.replace(text, c, F.concat(F.lit("%"), F.lpad(F.hex(c), 2, "0")))
    )


def lines(*fields: tuple[str, Column]) -> Column:
    """Header lines; a field without a value is left out."""
    return F.concat(*[F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n")), F.lit("")) for name, value in fields])


def common_fields(kind: str, date: str) -> list[tuple[str, Column]]:
    return [
        ("WARC-Type", F.lit(kind)), ("WARC-Record-ID", record_id(F.col("file"), F.col("at"))), ("WARC-Date", F.lit(date)),
        ("WARC-Target-URI", uri(F.col("url"))), ("Page-Id", F.col("page_id")),
        ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
    ]


def record(kind: str, date: str, extra: list[tuple[str, Column]], block_type: str, payload: Column) -> Column:
    """A whole record up to its end mark: version, header lines, HTTP head and payload."""
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("bytes").cast("string"), F.lit("\r\n\r\n"),
    )
    length = F.octet_length(http) + F.octet_length(payload)
    fields = [*common_fields(kind, date), *extra, ("Content-Type", F.lit(f"application/http; {block_type}")), ("Content-Length", length)]
    return F.concat(F.lit(f"{VERSION}\r\n"), lines(*fields), F.lit("\r\n"), http, payload)


def write(pages: DataFrame, path: str, least_bytes: int = LEAST_BYTES, date: str = "1970-01-01T00:00:00Z", compression: str = "gzip") -> None:
    """Write one record per row of ``pages`` (``page_id``, ``url``, ``html``; other columns are left out) below ``path``.

    Null payloads are empty, null ids and URLs leave their header out. Of records with equal payloads of at least
    ``least_bytes`` bytes the one with the smallest page_id (null ids last, equal ids by place) is a response, the
    others are revisits; smaller payloads are always responses. An empty table writes no record. Payloads are read
    twice, for digests and for the archive, and move only if the revisits are too many for Spark to send around.
    """
    with staging(pages.sparkSession):
        rows = placed(pages.select("page_id", "url", "html"))
        headers = stored(headers_of(rows))
        revisits = stored(revisits_of(headers, least_bytes))
        html = F.coalesce("html", F.lit(""))
        responses = rows.join(revisits.select("file", "at"), ["file", "at"], "left_anti").select(
            "file", "at", "page_id", "url", html.alias("html"), F.octet_length(html).cast("long").alias("bytes"),
            F.sha2(F.encode(html, "utf-8"), 256).alias("digest"),
        )
        original = [
            ("WARC-Profile", F.lit(IDENTICAL_PAYLOAD)), ("WARC-Refers-To", record_id(F.col("first.file"), F.col("first.at"))),
            ("WARC-Refers-To-Target-URI", uri(F.col("first_url"))), ("WARC-Refers-To-Date", F.lit(date)),
        ]
        records = responses.select(record("response", date, [], "msgtype=response", F.col("html")).alias("value")).unionByName(
            revisits.select(record("revisit", date, original, "msgtype=response", F.lit("")).alias("value"))
        )
        records.write.option("lineSep", RECORD_END).option("compression", compression).text(path)


def parsed(head: bytes) -> dict[str, str]:
    """Known header fields of a record, and its block's length."""
    first, *rest = re.split(rb"\r?\n", head)
    if not first.startswith(b"WARC/"):
        raise ValueError(f"not a WARC record: {first[:40]!r}")
    pairs = (line.split(b":", 1) for line in rest if b":" in line)
    return {name.strip().decode("utf-8", "replace"): value.strip().decode("utf-8", "replace") for name, value in pairs}


def records_in(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Records of a stream of bytes: header fields and block. Never more than a record and a chunk is held."""
    held, at = bytearray(), 0
    more = True
    while more:
        chunk = next(chunks, None)
        more = chunk is not None
        held += chunk or b""
        while True:
            while held[at : at + 1] in (b"\r", b"\n"):
                at += 1
            end = HEADER_END.search(held, at)
            if end is None:
                break
            fields = parsed(bytes(held[at : end.start()]))
            stop = end.end() + int(fields["Content-Length"])
            if len(held) < stop:
                break
            yield fields, bytes(held[end.end() : stop])
            at = stop
        del held[:at]
        at = 0
    if held:
        raise ValueError("a record is cut off at the end of an archive")


def payload_of(block: bytes, content_type: str) -> bytes:
    """The block without its HTTP head."""
    if not content_type.startswith("application/http"):
        return block
    end = HEADER_END.search(block)
    return block[end.end() :] if end else b""


def read(spark: SparkSession, path: str) -> DataFrame:
    """Records of the gzip archives below ``path``: fields of ``RECORD``, null where a record lacks them.

    A compressed archive is read by one task, line by line, so memory follows a record and not the archive.
    Bytes that aren't records, or a record cut off, stop the job.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines = (b"\n".join(batch.column(0).to_pylist()) + b"\n" for batch in batches if batch.num_rows)
        out, size = [], 0
        for fields, block in records_in(lines):
            row = {column: fields.get(name) for name, column in FIELDS.items()}
            row["payload"] = payload_of(block, fields.get("Content-Type", ""))
            out.append(row)
            size += len(block)
            if size > 4_000_000:
                yield pa.RecordBatch.from_pylist(out, schema)
                out, size = [], 0
        yield pa.RecordBatch.from_pylist(out, schema)

    schema = pa.schema([*((c, pa.string()) for c in FIELDS.values()), ("payload", pa.binary())])
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(F.col("value").cast("binary")).mapInArrow(run, RECORD)


def resolved(records: DataFrame) -> DataFrame:
    """Records without payloads: each with bytes and digest of the full payload, and the page a revisit refers to.

    Revisits are joined to the response with the id they name. A response whose payload has another digest than its
    header says, or a revisit without a response of its digest, stops the job.
    """
    digest = F.sha2("payload", 256)
    wrong = (F.col("record_type") == "response") & (F.concat(F.lit("sha256:"), digest) != F.col("payload_digest"))
    heads = stored(
        records.select(
            "record_type", "record_id", "page_id", "refers_to",
            F.octet_length("payload").cast("long").alias("bytes"),
            F.when(wrong, F.raise_error(F.lit("a payload differs from its digest"))).otherwise(F.substring_index("payload_digest", ":", -1)).alias("digest"),
        )
    )
    responses = heads.filter("record_type = 'response'")
    revisits = heads.filter("record_type = 'revisit'").select("page_id", "record_type", "digest", "refers_to")
    named = stored(revisits.select(F.col("refers_to").alias("record_id")).distinct())
    originals = stored(
        responses.join(named, "record_id", "left_semi")
        .select(F.col("record_id").alias("refers_to"), F.col("page_id").alias("first_id"), "bytes", F.col("digest").alias("first_digest"))
    )
    joined = revisits.join(originals, "refers_to", "left").select(
        "page_id", "bytes",
        F.when(F.col("digest") == F.col("first_digest"), F.col("digest")).otherwise(F.raise_error(F.lit("a revisit has no response"))).alias("digest"),
        "record_type", F.col("first_id").alias("refers_to"),
    )
    return responses.select("page_id", "bytes", "digest", "record_type", F.lit(None).cast("string").alias("refers_to")).unionByName(joined)


def report(pages: DataFrame) -> DataFrame:
    """Per page, from archives written and read back: payload bytes and digest, record type, page it refers to.

    Ids are cast back to their type. The archives and tables on the way are removed; the result is checkpointed.
    """
    spark, kind = pages.sparkSession, pages.schema["page_id"].dataType
    with staging(spark) as folder:
        path = f"{folder}/archives"
        write(pages, path)
        rows = resolved(read(spark, path))
        return checkpointed(
            rows.select(
                F.col("page_id").cast(kind), F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
                "record_type", F.col("refers_to").cast(kind),
            )
        )
