r"""WARC files of pages, and a Merkle fixity audit of their replicas.

Files: one per shard, a shard being the consecutive pages of one input split, cut
at `SHARD_BYTES`. A file is a row of records, each a header, an empty line, the
page, and two line ends (`\r\n\r\n`), stored as a gzip member of its own. Offsets
count bytes of the records before compression. Record ids are made from content, so
repeated rows share theirs; the date is that of `record`, pages have none.

Reading goes through all members of a file, however records are dealt to them. A
member that cannot be read, or whose checksum or length is wrong, is a damaged range:
its length is that of its data or the one its trailer states, so that records behind
it keep their offsets, and its hash that of the stored bytes. So are bytes that are no member.

Audit: each replica is scanned into records, hashed, with their offset ranges; what is
no record up to the next header is a range of its own. Offset, length and hash of a
range are a leaf. Leaves that start in the same 2^RANGE_BITS bytes of a shard, in
order, make a node, 2^FANOUT_BITS neighbouring nodes the next one, up to a root per
shard, and then over the shards to one root per replica. Of two nodes that differ
only the children are compared, down to the ranges that are damaged; nothing is
looked at below nodes that agree.

Defined results: a null url or html is written as empty; a null page_id as an empty
id, and read back as null. Repeated rows are records of their own. A missing or
unreadable file of either replica has no record, so all ranges of the other one count
as damaged. Zero bytes behind the last member are padding. A very long page is one
record and one row. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import itertools
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.llm.common import pieces, reliable, whole

# Production parameters.
SHARD_BYTES = 4 << 20
RANGE_BITS = 16
FANOUT_BITS = 4

# The formats.
VERSION = b"WARC/1.1"
DATE = "1970-01-01T00:00:00Z"
END = b"\r\n\r\n"
LENGTH = re.compile(rb"\r\nContent-Length: (\d+)\r\n")
PAGE = re.compile(rb"\r\nX-Page-Id: (-?\d*)\r\n")
NEXT = b"\r\n\r\n" + VERSION + b"\r\n"
MEMBER = b"\x1f\x8b\x08"
HEADER_BYTES, TRAILER_BYTES = 10, 8
# Deflate makes at most so many bytes of one.
MOST_INFLATED = 1032
READ_BYTES = 1 << 14

# Shards of one input split; the split's number comes first.
SHARDS_PER_SPLIT = 1 << 12


RECORDS = "shard bigint, number bigint, page_id bigint, record binary"


def record(page_id: int | None, url: str | None, html: str | None, date: str = DATE) -> bytes:
    """A record without its closing line ends."""
    block = (html or "").encode("utf-8")
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    digest = hashlib.sha256(block).hexdigest()
    own = "" if page_id is None else page_id
    name = uuid.UUID(hex=hashlib.sha256(f"{own} {uri} {digest}".encode()).hexdigest()[:32])
    head = (
        f"{VERSION.decode()}\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:uuid:{name}>\r\nWARC-Date: {date}\r\n"
        f"WARC-Target-URI: {uri}\r\nWARC-Block-Digest: sha256:{digest}\r\nX-Page-Id: {own}\r\n"
        f"Content-Type: text/html\r\nContent-Length: {len(block)}"
    )
    return head.encode("utf-8") + END + block


def records_of(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(shard, number, page_id, record): the records in their shards, in the order of the input's splits.

    Only a written replica fixes that order: make the next one from its `read_records`.
    """
    rows = pages.select(whole(page_id).cast("bigint").alias("page_id"), whole(url).alias("url"), whole(html).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() * SHARDS_PER_SPLIT
        size = number = 0
        for batch in batches:
            for piece in pieces(batch, 2):
                out = []
                for own, target, text in zip(*(column.to_pylist() for column in piece.columns)):
                    made = record(own, target, text)
                    if size and size + len(made) + len(END) > SHARD_BYTES:
                        shard, size, number = shard + 1, 0, 0
                        if not shard % SHARDS_PER_SPLIT:
                            raise ValueError("an input split holds too many shards")
                    out.append((shard, number, own, made))
                    size, number = size + len(made) + len(END), number + 1
                columns = list(zip(*out)) or [[]] * 4
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, kinds)], names=["shard", "number", "page_id", "record"]
                )

    return rows.mapInArrow(run, RECORDS)


def member(data: bytes) -> bytes:
    """A gzip member; an empty one is added where it would not end in a zero byte (data of 16 MB and more)."""
    packer = zlib.compressobj(wbits=31)
    made = packer.compress(data) + packer.flush()
    return made if not made[-1] else made + member(b"")


def write_warc(records: DataFrame, folder: str) -> None:
    """One file per shard, its records in order, a gzip member each. `records` has a shard's rows in one partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, 2):
                made = [member(content.as_py() + END)[:-1] for content in piece.column(2)]
                yield pa.RecordBatch.from_arrays(
                    [*piece.columns[:2], pa.array(made, pa.binary())], names=["shard", "number", "member"]
                )

    rows = records.select("shard", "number", "record").mapInArrow(run, "shard bigint, number bigint, member binary")
    lines = rows.sortWithinPartitions("shard", "number").select("shard", F.col("member").cast("string").alias("value"))
    # Every member ends in a zero byte, which the text writer adds as the end of a line.
    lines.write.partitionBy("shard").option("lineSep", "\0").text(folder)


def damaged(records: DataFrame, where: Column) -> DataFrame:
    """The records with the last byte flipped where the condition holds (to test an audit)."""
    last = F.octet_length("record")
    other = F.when(F.substring("record", -1, 1) == F.lit(b"!"), F.lit(b"?")).otherwise(F.lit(b"!"))
    flipped = F.concat(F.substring(F.col("record"), F.lit(1), last - 1), other)
    return records.withColumn("record", F.when(where, flipped).otherwise(F.col("record")))


def files_of(spark: SparkSession, folder: str) -> DataFrame:
    """(shard, content) of every file; a file holds SHARD_BYTES or one longer record."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", "true")
    number = F.regexp_extract("path", r"shard=(\d+)", 1).cast("bigint")
    return files.load(folder).select(number.alias("shard"), "content")


def inflated(content: bytes, at: int) -> tuple[bytes, int] | None:
    """The data of the gzip member that begins at `at`, and its end; None if it is not whole and right."""
    stream, parts = zlib.decompressobj(wbits=31), []
    try:
        while not stream.eof and at < len(content):
            parts.append(stream.decompress(content[at : at + READ_BYTES]))
            at += READ_BYTES
    except zlib.error:
        return None
    return (b"".join(parts), min(at, len(content)) - len(stream.unused_data)) if stream.eof else None


def length_of(stored: bytes) -> int:
    """The length before compression of a damaged member: of its data if their checksum is right, else as stated."""
    if len(stored) < HEADER_BYTES + TRAILER_BYTES:
        return len(stored)
    checksum, size = struct.unpack("<2I", stored[-TRAILER_BYTES:])
    stream = zlib.decompressobj(wbits=-15)
    try:
        data = stream.decompress(stored[HEADER_BYTES:-TRAILER_BYTES])
        size = len(data) if zlib.crc32(data) == checksum else size
    except zlib.error:
        pass
    return size if 0 < size <= MOST_INFLATED * len(stored) else len(stored)


def members_of(content: bytes) -> Iterator[tuple[bytes | None, bytes, int]]:
    """(data, stored bytes, length before compression) of each member; data is None for what cannot be read."""
    at = 0
    while at < len(content):
        found = inflated(content, at)
        if found:
            data, end = found
            yield data, content[at:end], len(data)
            at = end
            continue
        end = content.find(MEMBER, at + 1)
        while end >= 0 and not inflated(content, end):
            end = content.find(MEMBER, end + 1)
        stored = content[at:] if end < 0 else content[at:end]
        at += len(stored)
        if end < 0 and not stored.strip(b"\0"):
            return
        yield None, stored, length_of(stored)


def parts_of(content: bytes) -> Iterator[tuple[int, int, int | None, bytes, bool]]:
    """(offset, length, page_id, bytes, readable) of each range of a file, in order.

    Readable members that follow each other are read as one text: records may go over their ends.
    """
    at = 0
    for readable, group in itertools.groupby(members_of(content), lambda own: own[0] is not None):
        if readable:
            text = b"".join(data for data, _, _ in group)
            for start, size, page in ranges_of(text):
                yield at + start, size, page, text[start : start + size], True
            at += len(text)
        else:
            for _, stored, size in group:
                yield at, size, None, stored, False
                at += size


def ranges_of(content: bytes) -> Iterator[tuple[int, int, int | None]]:
    """(offset, length, page_id) of each record, closing line ends included."""
    at = 0
    while at < len(content):
        head = content.find(END, at)
        length = LENGTH.search(content, at, head + 2) if head >= 0 else None
        if content[at : at + len(VERSION)] == VERSION and length:
            end = head + 2 * len(END) + int(length[1])
        else:  # not a header: go on at the next one
            found = content.find(NEXT, at)
            end, head = (found + len(END) if found >= 0 else len(content)), at
        page = PAGE.search(content, at, max(at, head) + 2)
        end = min(end, len(content))
        yield at, end - at, int(page[1]) if page and page[1] else None
        at = end


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """(shard, number, page_id, record) of a replica's readable ranges, as they can be written to another one."""

    def run(batches):
        for batch in batches:
            for shard, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows = [(shard, n, page, data.removesuffix(END))
                        for n, (_, _, page, data, readable) in enumerate(parts_of(content.as_py())) if readable]
                columns = list(zip(*rows)) or [[]] * 4
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, kinds)], names=["shard", "number", "page_id", "record"]
                )

    return files_of(spark, folder).mapInArrow(run, RECORDS)


def scan(spark: SparkSession, folder: str) -> DataFrame:
    """(shard, offset, length, page_id, hash): the records of a replica as hashed offset ranges."""

    def run(batches):
        for batch in batches:
            for shard, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows = [(shard, at, size, page, hashlib.sha256(data).digest())
                        for at, size, page, data, _ in parts_of(content.as_py())]
                columns = list(zip(*rows)) or [[]] * 5
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, kinds)],
                    names=["shard", "offset", "length", "page_id", "hash"],
                )

    schema = "shard bigint, offset bigint, length bigint, page_id bigint, hash binary"
    return files_of(spark, folder).mapInArrow(run, schema)


def pairs(first: DataFrame, second: DataFrame) -> DataFrame:
    """(shard, place, a, b): the leaves of both replicas by offset; null where one has none."""
    leaf = F.unhex(F.sha2(F.concat_ws(":", "offset", "length", F.hex("hash")), 256))
    both = first.select("shard", F.col("offset").alias("place"), leaf.alias("a"), F.lit(None).cast("binary").alias("b"))
    both = both.unionByName(
        second.select("shard", F.col("offset").alias("place"), F.lit(None).cast("binary").alias("a"), leaf.alias("b"))
    )
    return both.groupBy("shard", "place").agg(F.max("a").alias("a"), F.max("b").alias("b"))


def parents(level: DataFrame, key: str, bits: int, keep: list[str]) -> DataFrame:
    """The next level: a node for each range of 2^bits values of `key`, hashed over its children in order."""

    def over(side: str) -> Column:
        children = F.sort_array(F.collect_list(F.when(F.col(side).isNotNull(), F.struct(key, side))))
        text = F.transform(children, lambda child: F.concat_ws(":", child[key], F.hex(child[side])))
        return F.when(F.size(children) > 0, F.unhex(F.sha2(F.array_join(text, ","), 256))).alias(side)

    return level.groupBy(*keep, F.shiftright(key, bits).alias(key)).agg(over("a"), over("b"))


def levels_of(leaves: DataFrame) -> list[tuple[DataFrame, str, int]]:
    """The levels of both trees from the leaves to the root: nodes, and how their key became that of their parents."""
    levels = [reliable(leaves)]
    steps = []
    most_place, most_shard = levels[0].agg(F.max("place"), F.max("shard")).first()
    bits = RANGE_BITS
    while most_place is not None:
        steps.append(("place", bits))
        levels.append(reliable(parents(levels[-1], "place", bits, ["shard"])))
        most_place >>= bits
        bits = FANOUT_BITS
        if not most_place:
            break
    while most_shard:
        steps.append(("shard", FANOUT_BITS))
        levels.append(reliable(parents(levels[-1], "shard", FANOUT_BITS, ["place"])))
        most_shard >>= FANOUT_BITS
    return list(zip(levels, [*steps, (None, 0)]))


def audit(first: DataFrame, second: DataFrame) -> DataFrame:
    """(shard, offset): the ranges that are not the same in both replicas, from two scans.

    Level by level from the root, only children of nodes that differ are looked at;
    a pair of equal roots ends the audit there.
    """
    levels = levels_of(pairs(first, second))[::-1]
    differs = ~F.col("a").eqNullSafe(F.col("b"))
    bad = reliable(levels[0][0].filter(differs).select("shard", "place"))
    for level, (key, bits) in levels[1:]:
        if bad.isEmpty():
            break
        above = {"place": F.shiftright("place", bits) if key == "place" else F.col("place"),
                 "shard": F.shiftright("shard", bits) if key == "shard" else F.col("shard")}
        wanted = bad.select(F.col("shard").alias("of_shard"), F.col("place").alias("of_place"))
        below = level.join(
            wanted, (above["shard"] == F.col("of_shard")) & (above["place"] == F.col("of_place")), "left_semi"
        )
        bad = reliable(below.filter(differs).select("shard", "place"))
    else:
        return bad.select("shard", F.col("place").alias("offset"))
    return leafless(first)


def leafless(scanned: DataFrame) -> DataFrame:
    return scanned.sparkSession.createDataFrame([], "shard bigint, offset bigint")


def check_replicas(spark: SparkSession, first: str, second: str) -> DataFrame:
    """(shard, offset, length, page_id, hash, side, intact): each range of either replica, and whether both agree on it.

    `side` names the replicas with a range at this offset: both, first or second.
    Length and hash are the first's where it has one; so is page_id, if it can be read there.
    """
    own, copy = reliable(scan(spark, first)), reliable(scan(spark, second))
    bad = audit(own, copy).withColumn("bad", F.lit(True))
    other = copy.select("shard", "offset", *(F.col(c).alias(f"other_{c}") for c in ("length", "page_id", "hash")))
    joined = own.join(other, ["shard", "offset"], "full_outer").join(bad, ["shard", "offset"], "left")
    side = F.when(F.col("other_hash").isNull(), "first").when(F.col("hash").isNull(), "second").otherwise("both")
    values = (F.coalesce(c, f"other_{c}").alias(c) for c in ("length", "page_id", "hash"))
    return joined.select("shard", "offset", *values, side.alias("side"), F.col("bad").isNull().alias("intact"))
