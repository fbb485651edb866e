"""WARC: archives written by Spark, and a normaliser of monolithic gzip.

``write_monolithic`` writes one WARC record per page with Spark's text writer:
each part file is one gzip stream over all its records.  ``normalise`` reads
such files, inflates the stream of each once, piece by piece, rewrites every
record as a gzip member of its own, and writes beside the archive a sidecar
index (JSON lines: record id, offset, length, type).  ``read_archives`` reads
the records back by the offsets in the sidecar.

Of records with equal payloads of at least ``MIN_REVISIT`` bytes, that with
the largest page id is a response and the others are revisits of it, which
carry no payload but its length and digest; smaller payloads are always
responses.  Rows that share the largest id are all responses.

Where files go: under the folder that all executors share.  Spark writes and
reads them; only the normalised archives are written through pyarrow's file
systems, to a name of the attempt that is moved into place when complete, so a
task that runs again or twice leaves the same file.

Defined cases: null html is an empty payload; a null page id is written as no
id, is never the response of others, and comes back null; repeated rows give
a record each; an empty table gives no archive and no row; texts are whole.
Further columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.store import discard_folder, shuffles_removed
from strata.session import scratch_path

MIN_REVISIT = 1000
PIECE = 1 << 20  # bytes inflated at once
FILE_BYTES = 1 << 30  # of a monolithic archive's payloads at most (but for one larger than that); more go to a further file
SIZES = (1 << 16, 1 << 21, 1 << 26)  # payloads up to each of these are written together

CRLF = "\r\n"
SCHEMA = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def with_types(pages: DataFrame) -> DataFrame:
    """page_id, html and what a record says of them: payload_bytes,
    payload_digest, and refers_to where the record is a revisit.

    Digests are counted up before they are shuffled; the pages join the
    groups of two and more by digest.  The groups are counted by digest and
    length, so the join deals both sides anew and Spark can split hot keys."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.select("page_id", "html", F.octet_length("html").cast("long").alias("payload_bytes"),
                       F.sha1(F.encode("html", "UTF-8")).alias("payload_digest"))
    groups = (rows.where(F.col("payload_bytes") >= MIN_REVISIT)
              .groupBy(F.col("payload_digest").alias("same"), "payload_bytes").agg(F.max("page_id").alias("first"), F.count("*").alias("n"))
              .where((F.col("n") > 1) & F.col("first").isNotNull()).select("same", "first"))
    revisit = F.when(F.col("page_id").isNull() | (F.col("page_id") != F.col("first")), F.col("first"))
    return (rows.join(groups, (F.col("payload_digest") == F.col("same")) & (F.col("payload_bytes") >= MIN_REVISIT), "left")
            .select("page_id", "html", "payload_bytes", "payload_digest", revisit.alias("refers_to")))


def record_text(page_id, html, payload_bytes, payload_digest, refers_to):
    """Column of a WARC record without its last line end, which the writer
    adds.  A revisit has no block."""
    is_revisit = refers_to.isNotNull()
    text = lambda *parts: F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))
    own = lambda col: F.coalesce(text("<urn:page:", col, ">"), F.lit("<urn:page:>"))
    head = F.concat_ws(
        CRLF, F.lit("WARC/1.1"), text("WARC-Type: ", F.when(is_revisit, "revisit").otherwise("response")),
        text("WARC-Record-ID: ", own(page_id)), text("WARC-Payload-Digest: sha1:", payload_digest),
        text("X-Payload-Length: ", payload_bytes),
        F.when(is_revisit, F.concat_ws(CRLF, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                                       text("WARC-Refers-To: ", own(refers_to)))),
        text("Content-Length: ", F.when(is_revisit, F.lit(0)).otherwise(payload_bytes)))
    return text(head, CRLF, CRLF, F.when(is_revisit, "").otherwise(html), CRLF)


def write_monolithic(pages: DataFrame, folder: str) -> None:
    """One record per page of ``with_types``; every part file is one gzip
    stream.  Pages are written by classes of size, so that a bound of records
    is one of bytes; the usual table has one class."""
    record = record_text(*map(F.col, ("page_id", "html", "payload_bytes", "payload_digest", "refers_to")))
    largest = pages.agg(F.max("payload_bytes")).first()[0]
    largest = 0 if largest is None else largest
    for low, high in zip((-1, *SIZES), (*SIZES, None)):
        if largest > low:
            own = pages.where(F.col("payload_bytes") > low) if high is None else pages.where((F.col("payload_bytes") > low) & (F.col("payload_bytes") <= high))
            (own.select(record.alias("value")).write.mode("append").option("lineSep", CRLF).option("compression", "gzip")
             .option("maxRecordsPerFile", 1 if high is None else FILE_BYTES // high).text(folder))


def inflate(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """What the gzip stream (of one member or more) holds, inflated once, in
    pieces of bounded size."""
    engine, rest, begun = zlib.decompressobj(31), b"", False
    for chunk in chunks:
        rest += chunk
        while rest:
            piece = engine.decompress(rest, PIECE)
            begun, rest = True, engine.unconsumed_tail
            if piece:
                yield piece
            if engine.eof:
                rest = engine.unused_data
                engine, begun = zlib.decompressobj(31), False
            elif not piece and not rest:
                break
    if begun and (tail := engine.flush()):
        yield tail
    if begun and not engine.eof:
        raise ValueError("the gzip stream ends within a member")


def records(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, whole record) of each WARC record in the stream."""
    held = bytearray()

    def more() -> bool:
        for piece in pieces:
            held.extend(piece)
            return True
        return False

    while True:
        while (end := held.find(b"\r\n\r\n")) < 0:
            if not more():
                if held.strip():
                    raise ValueError("the stream ends within a record's header")
                return
        lines = held[:end].decode().split(CRLF)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record: {lines[0][:40]!r}")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        size = end + 4 + int(fields["Content-Length"]) + 4  # a record ends in two line ends
        while len(held) < size:
            if not more():
                raise ValueError("the stream ends within a record")
        yield fields, bytes(held[:size])
        del held[:size]


def member(record: bytes) -> bytes:
    """A record as a gzip member of its own."""
    engine = zlib.compressobj(6, zlib.DEFLATED, 31)
    return engine.compress(record) + engine.flush()


def _chunks(data: bytes) -> Iterator[bytes]:
    for at in range(0, len(data), PIECE):
        yield data[at:at + PIECE]


def normalise(spark, source: str, target: str) -> DataFrame:
    """Rewrite the archives in ``source`` to ``target`` and return one row per
    archive: its path, that of its sidecar, its records and bytes.  A task
    takes whole files, which ``write_monolithic`` bounds."""
    schema = "archive string, sidecar string, records long, bytes long"

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                name = path.as_py().rsplit("/", 1)[1].split(".")[0]
                system, folder = fs.FileSystem.from_uri(target)
                system.create_dir(folder, recursive=True)
                attempt, offset, n = uuid.uuid4().hex, 0, 0
                own = [f"{folder}/.{attempt}.{kind}" for kind in ("warc.gz", "cdxj")]
                with system.open_output_stream(own[0], compression=None) as out, system.open_output_stream(own[1], compression=None) as index:
                    for fields, record in records(inflate(_chunks(content.as_buffer().to_pybytes()))):
                        data = member(record)
                        out.write(data)
                        index.write((json.dumps({"id": fields["WARC-Record-ID"], "offset": offset, "length": len(data),
                                                 "type": fields["WARC-Type"]}) + "\n").encode())
                        offset, n = offset + len(data), n + 1
                for x, kind in zip(own, ("warc.gz", "cdxj")):
                    system.move(x, f"{folder}/{name}.{kind}")
                yield pa.RecordBatch.from_pylist([{"archive": f"{target}/{name}.warc.gz", "sidecar": f"{target}/{name}.cdxj", "records": n, "bytes": offset}])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(source)
    return files.select("path", "content").mapInArrow(rewrite, schema)


def _page(urn: str) -> int | None:
    digits = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def read_record(data: bytes) -> dict:
    """The SCHEMA fields of one gzip member; a payload must have the length
    and digest that its header names."""
    (fields, record), = records(iter([zlib.decompress(data, 31)]))
    digest, revisit = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"] == "revisit"
    if not revisit:
        payload = record[len(record) - 4 - int(fields["Content-Length"]):-4]
        if len(payload) != int(fields["X-Payload-Length"]) or hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError(f"payload of {fields['WARC-Record-ID']} differs from its header")
    return {"page_id": _page(fields["WARC-Record-ID"]), "payload_bytes": int(fields["X-Payload-Length"]), "payload_digest": digest,
            "record_type": fields["WARC-Type"], "refers_to": _page(fields["WARC-Refers-To"]) if revisit else None}


def read_archives(spark, folder: str) -> DataFrame:
    """SCHEMA of every record that the sidecars in ``folder`` name, read from
    the archives at their offsets.  A task takes an archive and opens its
    sidecar itself, so no archive is shuffled."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                            ("record_type", pa.string()), ("refers_to", pa.int64())])
        system, place = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path, archive in zip(batch["path"], batch["content"]):
                name = path.as_py().rsplit("/", 1)[1].removesuffix(".warc.gz")
                with system.open_input_stream(f"{place}/{name}.cdxj") as index:
                    at = map(json.loads, index.read().splitlines())
                data = archive.as_buffer()
                rows = [read_record(data.slice(x["offset"], x["length"]).to_pybytes()) for x in at]
                yield pa.RecordBatch.from_pylist(rows, schema)

    archives = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder)
    return archives.select("path", "content").mapInArrow(read, SCHEMA)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write the pages, normalise the archives, read them back: SCHEMA."""
    spark = pages.sparkSession
    raw, clean = scratch_path(spark, "warc-raw"), scratch_path(spark, "warc")
    with shuffles_removed(spark):
        write_monolithic(with_types(pages), raw)
    done = normalise(spark, raw, clean).agg(F.sum("records").alias("n")).collect()[0]["n"]
    discard_folder(spark, raw)
    return read_archives(spark, clean) if done else spark.createDataFrame([], SCHEMA)
