"""Operator 13: WARC archives compressed with a dictionary of their own.

An archive begins with a skippable Zstandard frame that holds a dictionary
built from archived records; every record is a frame of its own, compressed
with it, so short pages compress well and each record can be read alone.
Equal payloads are stored once: the other records are revisits of the one with
the largest page id.

Archives are written through Spark's text writer, so they appear at job commit
on any file system Spark knows: a row is a frame, and what the writer puts
after a row is an empty skippable frame, which every Zstandard reader skips.
(The writer names the files ``part-*.txt``; their content is ``.warc.zst``.)
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paydw.llm.common import bounded_batches, cut

# Magic numbers of skippable frames (the first is the dictionary's) and of a record's frame.
DICTIONARY_MAGIC, SKIPPABLE = 0x184D2A5D, range(0x184D2A50, 0x184D2A60)
BETWEEN = struct.pack("<II", 0x184D2A50, 0).decode("ascii")  # an empty skippable frame, as the text writer's line end
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LEAST_REVISIT = 1000
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def build_dictionary(pages: DataFrame, samples: int = 600, sample_bytes: int = 32 << 10, size: int = 64 << 10) -> bytes:
    """A Zstandard dictionary from records as they are archived.

    Fitted on a bounded sample: about ``samples`` of the records of at most
    ``sample_bytes`` bytes, each drawn by a hash of its id and its place in the
    table, so rows that repeat are drawn one by one. Where these are too few or
    too alike to train on, their last ``size`` bytes are the dictionary; without
    any record there is none (no bytes).
    """
    short = pages.where(F.col("payload_bytes") <= sample_bytes)
    unit = F.pmod(F.xxhash64("page_id", F.monotonically_increasing_id()), F.lit(1 << 30)) / float(1 << 30)
    few = short.where(unit < samples / max(pages.count(), 1)).orderBy("page_id", "digest").collect()
    records = [record(r["page_id"], r["url"], (r["payload"] or "").encode(), r["payload_bytes"], r["digest"], None, None)
               for r in few]
    if not records:
        return b""
    try:
        return zstandard.train_dictionary(size, records).as_bytes()
    except zstandard.ZstdError:
        return b"".join(records)[-size:]


def dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


def uri(url: str | None, page_id: int | None) -> str:
    """The page's address without characters that would end a header line; a name by its id if there is none."""
    if not url:
        return f"urn:page:{page_id}"
    return "".join(c if c.isprintable() else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def record(page_id: int | None, url: str | None, payload: bytes, payload_bytes: int, digest: str,
           refers_to: int | None, refers_url: str | None, date: str = "1970-01-01T00:00:00Z") -> bytes:
    """One WARC/1.1 record; a revisit has the HTTP header of the full payload and no body."""
    kind = "response" if refers_to is None else "revisit"
    block = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {payload_bytes}\r\n\r\n"
             .encode() + (payload if kind == "response" else b""))
    name = hashlib.sha1(f"{page_id} {url} {digest}".encode("utf-8", "surrogatepass")).hexdigest()
    head = ["WARC/1.1", f"WARC-Type: {kind}",
            f"WARC-Record-ID: <urn:uuid:{name[:8]}-{name[8:12]}-5{name[13:16]}-8{name[17:20]}-{name[20:32]}>",
            f"WARC-Date: {date}", f"WARC-Target-URI: {uri(url, page_id)}",
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
            f"WARC-Payload-Digest: sha1:{digest}"]
    if page_id is not None:
        head.append(f"Page-Id: {page_id}")
    if kind == "revisit":
        head += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To-Target-URI: {uri(refers_url, refers_to)}",
                 f"WARC-Refers-To-Date: {date}", f"Refers-To-Page-Id: {refers_to}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(data: bytes) -> tuple:
    """``page_id, url, payload_bytes, payload_digest, record_type, refers_to`` of one record.

    What a response says of its payload is checked against the payload.
    """
    head, rest = data.split(b"\r\n\r\n", 1)
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[:int(fields["Content-Length"])]
    if rest[len(block):] != b"\r\n\r\n":
        raise ValueError("a WARC record does not end where its length says")
    http, payload = block.split(b"\r\n\r\n", 1)
    size = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"the payload of {fields['WARC-Record-ID']} is not what its record says")
    number = lambda f: int(fields[f]) if f in fields else None
    return (number("Page-Id"), fields["WARC-Target-URI"], size, digest, fields["WARC-Type"], number("Refers-To-Page-Id"))


def skippable(magic: int, content: bytes) -> bytes:
    return struct.pack("<II", magic, len(content)) + content


def frame_end(data: memoryview, at: int) -> int:
    """Where the frame at ``at`` ends, by the sizes of its blocks."""
    params = zstandard.get_frame_parameters(data[at:at + 18])
    place = at + zstandard.frame_header_size(data[at:at + 18])
    last = False
    while not last:
        block = int.from_bytes(data[place:place + 3], "little")
        last, kind, size = block & 1, block >> 1 & 3, block >> 3
        place += 3 + (1 if kind == 1 else size)  # a block of one repeated byte holds that byte only
    return place + (4 if params.has_checksum else 0)


def records_of(archive: bytes) -> Iterator[bytes]:
    """The records of an archive, one after the other."""
    data, at, reader = memoryview(archive), 0, zstandard.ZstdDecompressor()
    while at < len(data):
        magic = int.from_bytes(data[at:at + 4], "little")
        if magic in SKIPPABLE:
            end = at + 8 + int.from_bytes(data[at + 4:at + 8], "little")
            if magic == DICTIONARY_MAGIC:
                reader = zstandard.ZstdDecompressor(dict_data=dictionary(bytes(data[at + 8:end])))
        else:
            end = frame_end(data, at)
            yield reader.decompress(data[at:end])
        at = end


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
               least_revisit: int = LEAST_REVISIT, hot_share: float = 0.001, level: int = 3, **sampling) -> None:
    """Write one record for every row of ``pages`` to archives below ``path``.

    Of records with equal payloads of at least ``least_revisit`` bytes the one
    with the largest id is a response and the others are its revisits; rows
    that share that id and the payload, too, are responses all, and rows
    without an id are revisits unless all are without. Shorter payloads are
    responses. A null payload counts as empty; other columns are not looked at.
    An empty table gives no archive.

    Payloads that hold at least ``hot_share`` of all rows (so at most
    ``1 / hot_share`` of them) are known beforehand: their revisits lose the
    text before the shuffle and are dealt by id. Other rows meet the table of
    repeated payloads by digest; each text is shuffled once. The dictionary comes from a
    bounded sample (``build_dictionary``, whose parameters ``sampling`` passes).
    """
    spark = pages.sparkSession
    bounded_batches(spark)
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        payload.alias("payload"), F.octet_length(payload).cast("long").alias("payload_bytes"),
                        F.sha1(payload).alias("digest"))
    long_enough = F.col("payload_bytes") >= least_revisit
    found = rows.where(long_enough).groupBy("digest").agg(
        F.count(F.lit(1)).alias("copies"), F.max(F.struct("page_id", "url")).alias("first")) \
        .where("copies > 1").select("digest", "copies", F.col("first.page_id").alias("first_id"),
                                    F.col("first.url").alias("first_url"))
    repeated = cut(found, "repeated-payloads")
    hot = repeated.where(F.col("copies") >= F.lit(hot_share * pages.count())).select(
        "digest", F.lit(True).alias("hot"), F.col("first_id").alias("hot_id"), F.col("first_url").alias("hot_url"))
    # at most 1 / hot_share rows, whatever the size of the table
    marked = rows.join(F.broadcast(hot), "digest", "left")
    revisits = F.col("hot_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("hot_id"))
    # a key that no digest equals, for rows that need no other table
    own_key = F.concat(F.lit("-"), F.pmod(F.xxhash64("page_id", F.monotonically_increasing_id()), F.lit(1 << 16)))
    dealt = marked.withColumn("payload", F.when(~revisits, F.col("payload"))) \
        .withColumn("key", F.when(long_enough & F.col("hot").isNull(), F.col("digest")).otherwise(own_key)) \
        .repartition("key")
    cold = repeated.select(F.col("digest").alias("key"), "first_id", "first_url")
    known = dealt.join(cold, "key", "left")
    first_id = F.coalesce("hot_id", "first_id")
    out = known.select("page_id", "url", "payload", "payload_bytes", "digest",
                       F.when(~F.col("page_id").eqNullSafe(first_id), first_id).alias("refers_to"),
                       F.coalesce("hot_url", "first_url").alias("refers_url"))
    trained = build_dictionary(rows, **sampling)

    def run(batches):
        packer = zstandard.ZstdCompressor(level=level, dict_data=dictionary(trained), write_checksum=True,
                                          write_content_size=True)
        begun = False
        for b in batches:
            frames = [] if begun or not trained or not b.num_rows else [skippable(DICTIONARY_MAGIC, trained)]
            begun = begun or b.num_rows > 0
            columns = [b.column(c) for c in ("page_id", "url", "payload", "payload_bytes", "digest", "refers_to", "refers_url")]
            for page_id, url, text, size, digest, refers_to, refers_url in zip(*(c.to_pylist() for c in columns)):
                frames.append(packer.compress(record(page_id, url, (text or "").encode(), size, digest, refers_to, refers_url)))
            yield pa.RecordBatch.from_arrays([pa.array(frames, pa.binary())], names=["frame"])

    out.mapInArrow(run, "frame binary").select(F.col("frame").cast("string").alias("value")) \
        .write.option("lineSep", BETWEEN).option("compression", "none").text(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row a record of the archives at ``path``: ids, address, size and digest of the full payload, type, reference.

    An archive is read whole by one task (archives are as large as a shuffle partition).
    """
    bounded_batches(spark)

    def run(batches):
        for b in batches:
            for archive in b.column("content"):
                rows = [parsed(r) for r in records_of(archive.as_buffer())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 6, (
                        pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()))],
                    names=[f.split()[0] for f in RECORDS.split(", ")])

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, RECORDS)
