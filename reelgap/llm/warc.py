"""Web archives: write pages as WARC/1.1 records, read archives back, and put transactions together again.

Spark's text writer makes the files: a record ends with two line breaks, which is the separator between rows. It
compresses a file as one gzip member; the reader takes files of any number of members. Each page gives a response (or, for a payload that another page has already, a revisit), a request and a metadata
record; the latter two name the first as concurrent. Reading walks a file by the records' Content-Length, so a
payload may hold anything, line breaks and record headers included.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelgap.llm import hotkeys
from reelgap.llm.scratch import Scratch

#: Fixed: the base32 alphabet, and the profile of revisits to an identical payload.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: A file has pages of at most so many bytes together, as a reader holds a file at a time; pages above LARGE have files of their own.
FILE, LARGE = 512 << 20, 64 << 10
RECORD = "record_id string, kind string, concurrent_to string, target_uri string, payload_digest string, payload_bytes long, refers_to string, page_id long, intact boolean, payload binary"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: 40 bits at a time."""
    hexed = F.sha1(payload)
    letters = []
    for part in range(4):
        bits = F.conv(F.substring(hexed, 10 * part + 1, 10), 16, 10).cast("long")
        letters += [F.substring(F.lit(BASE32), (F.shiftright(bits, 35 - 5 * k).bitwiseAND(F.lit(31)) + 1).cast("int"), F.lit(1)) for k in range(8)]
    return F.concat(*letters)


def _record(fields: list[Column | str], block: Column) -> Column:
    """Header fields (nulls are left out) and block; Content-Length counts the block's bytes."""
    head = F.concat_ws("\r\n", F.lit("WARC/1.1"), *[F.lit(f) if isinstance(f, str) else f for f in fields], F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")))
    return F.concat(head, F.lit("\r\n\r\n"), block)


def write(pages: DataFrame, folder: str, min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z") -> None:
    """Archive ``pages`` (page_id, url, html) in ``folder``.

    A null html is empty, a null url leaves its field out; repeated rows are archived each; an empty table gives no
    records; other columns are not read. Of pages with equal payloads of at least ``min_bytes`` bytes, those of the
    smallest page_id are responses and the others revisit one of them. Pages of more than LARGE bytes have files of
    their own, with as few records each as keep a file under FILE bytes.
    """
    spark, scratch = pages.sparkSession, Scratch(pages.sparkSession, "warc_rows")
    rows = pages.select(F.col("page_id").cast("long"), F.regexp_replace(F.regexp_replace(F.col("url").cast("string"), "\r", "%0D"), "\n", "%0A").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = scratch.keep(rows.withColumn("size", F.octet_length("html")).withColumn("digest", base32_sha1(F.col("html"))).withColumn("id", F.expr("uuid()")), "rows")
    known = F.col("page_id").isNotNull()
    light = rows.where(F.col("size") >= min_bytes).select("digest", "page_id", "id")
    equal = light.groupBy("digest").agg(F.min(F.when(known, F.struct("page_id", "id"))).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 and first is not null")
    again = hotkeys.joined(light, equal, ["digest"], light.count()).where(~known | (F.col("page_id") != F.col("first.page_id")))
    rows = rows.join(again.select("id", F.col("first.id").alias("first")), "id", "left")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size").cast("string"), F.lit("\r\n\r\n"))
    urn = lambda field, i: F.concat(F.lit(f"{field}: <urn:uuid:"), i, F.lit(">"))
    own, to = urn("WARC-Record-ID", F.col("id")), urn("WARC-Concurrent-To", F.col("id"))
    new_id = lambda: urn("WARC-Record-ID", F.expr("uuid()"))
    common = [f"WARC-Date: {date}", F.concat(F.lit("WARC-Target-URI: "), "url")]
    digest = F.concat(F.lit("WARC-Payload-Digest: sha1:"), "digest")
    reply = "Content-Type: application/http; msgtype=response"
    response = _record(["WARC-Type: response", own, *common, digest, reply], F.concat(http, "html"))
    revisit = _record(["WARC-Type: revisit", own, *common, digest, f"WARC-Profile: {PROFILE}", urn("WARC-Refers-To", F.col("first")), reply], http)
    path = F.coalesce(F.nullif(F.regexp_extract("url", r"^[^/]*://[^/?#]*([^#]*)", 1), F.lit("")), F.lit("/"))
    request = _record(["WARC-Type: request", new_id(), to, *common, "Content-Type: application/http; msgtype=request"], F.concat(F.lit("GET "), path, F.lit(" HTTP/1.1\r\n\r\n")))
    notes = F.concat(F.coalesce(F.concat(F.lit("page-id: "), F.col("page_id").cast("string")), F.lit("page-id:")), F.lit("\r\n"))
    metadata = _record(["WARC-Type: metadata", new_id(), to, *common, "Content-Type: application/warc-fields"], notes)
    largest = spark.read.parquet(scratch.path("rows")).agg(F.max("size")).first()[0] or 0
    for most, part in ((LARGE, rows.where(F.col("size") <= LARGE)), (largest, rows.where(F.col("size") > LARGE)))[: 1 + (largest > LARGE)]:
        records = part.select(F.explode(F.array(F.when(F.col("first").isNotNull(), revisit).otherwise(response), request, metadata)).alias("value"))
        records.write.mode("append").option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", 3 * max(1, FILE // most)).text(folder)
    scratch.drop("rows")


def inflated(data: bytes, piece: int = 1 << 20) -> Iterator[bytes]:
    """The pieces of an archive, uncompressed; of a gzipped one, all its members one after another."""
    if data[:2] != b"\x1f\x8b":
        yield from (data[at : at + piece] for at in range(0, len(data), piece))
        return
    at, member = 0, zlib.decompressobj(31)
    while at < len(data):
        out = member.decompress(member.unconsumed_tail or data[at : at + (piece >> 4)], piece)
        if not member.unconsumed_tail and not member.eof:
            at += piece >> 4
        if out:
            yield out
        if member.eof:
            # what follows the member, and the place it has in the data
            at = min(at + (piece >> 4), len(data)) - len(member.unused_data)
            while data[at : at + 1] == b"\0":
                at += 1
            member = zlib.decompressobj(31)
    if member.unconsumed_tail:
        raise ValueError("an archive ends within a member")


def walk(pieces: Iterable[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of each record of an uncompressed archive, holding one record and one piece at a time."""
    pieces, held, at, begun = iter(pieces), bytearray(), 0, 0

    def upto(n: int) -> bool:
        """Whether ``n`` bytes from here on can be had."""
        while len(held) - at < n:
            if not (more := next(pieces, b"")):
                return False
            held.extend(more)
        return True

    while upto(1):
        searched = at
        while (end := held.find(b"\r\n\r\n", searched)) < 0:
            searched = max(at, len(held) - 3)
            if not upto(len(held) - at + 1):
                raise ValueError(f"a record that begins at byte {begun} ends within its header")
        lines = held[at:end].decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record begins at byte {begun}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        size = int(fields["content-length"])
        whole = end + 4 - at + size
        if not upto(whole):
            raise ValueError(f"a record that begins at byte {begun} ends within its block")
        yield fields, bytes(held[end + 4 : end + 4 + size])
        upto(whole + 4)
        at, begun = at + whole + 4, begun + whole + 4
        if at > 1 << 20 or at >= len(held):
            del held[:at]
            at = 0


def parse(fields: dict[str, str], block: bytes, with_payload: bool) -> tuple:
    """One row of RECORD."""
    import base64
    import hashlib

    kind = fields.get("warc-type")
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
    size = page = payload = None
    intact = True
    if kind in ("response", "revisit"):
        head, _, body = block.partition(b"\r\n\r\n")
        size = next((int(x.split(b":")[1]) for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:")), len(body))
        if kind == "response":
            found = base64.b32encode(hashlib.sha1(body).digest()).decode()
            intact, digest, size, payload = digest in (None, found), found, len(body), body if with_payload else None
    elif kind == "metadata":
        page = next((int(v) for k, _, v in (x.partition(b":") for x in block.split(b"\r\n")) if k == b"page-id" and v.strip()), None)
    return fields.get("warc-record-id"), kind, fields.get("warc-concurrent-to"), fields.get("warc-target-uri"), digest, size, fields.get("warc-refers-to"), page, intact, payload


def read(spark: SparkSession, folder: str, with_payload: bool = False) -> DataFrame:
    """A row for each record of the archives in ``folder``, gzipped (in one member or many) or not; payloads of responses if asked for.

    Archives are files whose names start with ``part-``, of any length that Spark reads as one value (2 GB).
    """

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kinds = [pa.string()] * 5 + [pa.int64(), pa.string(), pa.int64(), pa.bool_(), pa.binary()]
        names = [x.split()[0] for x in RECORD.split(", ")]
        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                for fields, block in walk(inflated(content.as_py())):
                    rows.append(parse(fields, block, with_payload))
                    size += len(block) if with_payload else 0
                    if len(rows) == 1000 or size > FILE >> 4:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return files.select("content").mapInArrow(run, RECORD)


def captures(records: DataFrame) -> DataFrame:
    """One nested row per capture: its response or revisit, its request and its metadata record.

    Records meet under the identifier of the response, which the others name as concurrent. A record whose
    partners are missing gives a row with nulls for them.
    """
    capture = F.coalesce("concurrent_to", "record_id").alias("capture_id")
    whole = lambda *kinds: F.first(F.when(F.col("kind").isin(*kinds), F.struct("record_id", "kind", "target_uri", "payload_digest", "payload_bytes", "refers_to", "intact", "payload")), ignorenulls=True)
    return records.groupBy(capture).agg(
        whole("response", "revisit").alias("response"),
        F.max(F.when(F.col("kind") == "request", F.struct("record_id", "target_uri"))).alias("request"),
        F.max(F.when(F.col("kind") == "metadata", F.struct("record_id", "page_id"))).alias("metadata"),
    )


def with_referred_pages(captures: DataFrame) -> DataFrame:
    """``captures`` with ``refers_to_page``: the page whose capture a revisit names; null if the archives don't have it."""
    refers = captures.where("response.refers_to is not null").withColumn("_to", F.col("response.refers_to"))
    named = refers.groupBy("_to").agg(F.count(F.lit(1)).alias("n"))
    pages = named.join(captures.select(F.col("capture_id").alias("_to"), F.col("metadata.page_id").alias("refers_to_page")), "_to", "left")
    found = hotkeys.joined(refers, pages, ["_to"], refers.count()).drop("_to", "n")
    return found.unionByName(captures.where("response.refers_to is null").withColumn("refers_to_page", F.lit(None).cast("long")))
