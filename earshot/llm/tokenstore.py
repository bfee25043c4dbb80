"""Token ids in binary files of patched frame-of-reference blocks.

A file is a row of frames, each followed by a newline byte. A frame holds up to
`FRAME_IDS` ids of consecutive documents:

    header   magic PFR1, length of the frame, part, number of the frame in the part,
             documents, ids, blocks (u32 each)
    docs     doc_id (i64), ids in this frame (u32), flags (u8: 1 continues a document, 2 null doc_id)
    index    start of each block's planes (u32, bytes) and exceptions (u32, entries), one entry past the end
    blocks   minimum (u32) and width (u8) of each block
    planes   per block `width` planes of BLOCK bits, lowest first: the ids less the minimum
    patches  places in the block (u8) and values less the minimum (u32) of the ids that need more bits

The width is the `PERCENTILE` of the bit lengths in the block; wider ids become
exceptions. Parts are ranges of doc_id in ascending order, one file each, so a
document's place in the whole is the ids of all earlier parts plus its place in
its own part.

Encoding is the tokenizers library's, asked once for each distinct word of many
texts: its pattern never joins characters across white space, save that a space
belongs to the word after it. A batch of texts is split into words and these numbered
by Arrow; only distinct words are looked up, and ids gathered by number. Texts with
other white space than single spaces and newlines are encoded whole.

Defined results: a null or empty text has the end id alone; rows with equal
doc_id are ordered by text; null doc_ids come first. An empty table gives no rows.
"""

from __future__ import annotations

import itertools
import re
import struct
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from earshot.llm.common import byte_letters, kept_in_stage, pieces, reliable, whole, with_results

BLOCK = 128
FRAME_IDS = 1 << 16
PERCENTILE = 0.9
END_ID = 0

MAGIC = b"PFR1"
HEADER = struct.Struct("<4s6I")
DOC = np.dtype([("doc_id", "<i8"), ("ids", "<u4"), ("flags", "u1")])
CONTINUES, NULL_ID = 1, 2

# ---- encoding --------------------------------------------------------------

# A worker's memo has two halves of up to so many words, or bytes of them. When the young
# half is full it becomes the old one, and words of the old one that are not met again go.
MEMO_ENTRIES = 400_000
MEMO_BYTES = 32 << 20

# Texts in which words are kept apart by anything but one space or one newline, and
# controls on which the library and others differ. White space is that of the library's pattern.
UNEVEN = (
    r"^[ \n]|[ \n]$|[ \n][ \n]|[\t\x0b-\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
# Before the first word of a text, and of a line: no space goes with it. (No even text has the former.)
FIRST, NEWLINE = "\r", "\n"
# Latin letters, the same in all Unicode versions, and a mark that may stand behind them.
PLAIN = re.compile("([A-Za-z\xc0-\xd6\xd8-\xf6\xf8-ɏ]+)([.,]?)")


class Words:
    """Word -> its ids as little-endian bytes; a space before it unless it is marked as the first of a line."""

    def __init__(self, library: Tokenizer):
        self.library, self.young, self.old, self.bytes = library, {}, {}, 0
        self.letter_of = str.maketrans({chr(byte): letter for byte, letter in enumerate(byte_letters())})
        self.space = " ".translate(self.letter_of)
        self.newline, self.tails = self.ids(NEWLINE), {tail: self.ids(tail) for tail in ".,"}

    def ids(self, text: str) -> bytes:
        return array("i", self.library.encode(text, add_special_tokens=False).ids).tobytes()

    def piece(self, word: str, spaced: bool) -> bytes:
        """Ids of a word, from the library.

        A word of letters alone is one piece of its pattern, and a mark after a
        letter is another: these go straight to the library's model, as byte letters.
        """
        plain = PLAIN.fullmatch(word)
        if not plain:
            return self.ids(" " + word if spaced else word)
        core, tail = plain.groups()
        ids = (self.young.get(core) or self.old.get(core)) if tail and spaced else None
        if ids is None:
            letters = core if core.isascii() else core.encode().decode("latin-1").translate(self.letter_of)
            tokens = self.library.model.tokenize(self.space + letters if spaced else letters)
            ids = array("i", [token.id for token in tokens]).tobytes()
        return ids + self.tails[tail] if tail else ids

    def look_up(self, words: list[str]) -> list[bytes]:
        young, old, found = self.young, self.old, []
        for word in words:
            ids = young.get(word)
            if ids is None:
                ids = old.get(word)
                if ids is None:
                    if word[:1] == FIRST:
                        ids = self.piece(word[1:], False)
                    elif word[:1] == NEWLINE:
                        ids = self.newline + self.piece(word[1:], False)
                    else:
                        ids = self.piece(word, True)
                young[word] = ids
                self.bytes += len(word)
            found.append(ids)
        if len(young) > MEMO_ENTRIES or self.bytes > MEMO_BYTES:
            self.young, self.old, self.bytes = {}, young, 0
        return found


class Encoder:
    """The library's ids of whole texts, by way of words that its pattern keeps apart."""

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        special = [re.escape(token.content) for token in self.library.get_added_tokens_decoder().values()]
        self.uneven = "|".join([UNEVEN, *special])
        self.words = Words(self.library)

    def _even(self, texts: pa.Array) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray]:
        """(which texts are even, ids of their distinct words, the word at each place, ends of the texts in places)."""
        uneven = pc.match_substring_regex(texts, self.uneven).to_numpy(zero_copy_only=False).astype(bool)
        even = texts.filter(pa.array(~uneven))
        marked = pc.binary_join_element_wise(pa.scalar(FIRST), pc.replace_substring(even, NEWLINE, " " + NEWLINE), "")
        split = pc.split_pattern(marked, " ")
        words = split.flatten().dictionary_encode()
        ids = self.words.look_up(words.dictionary.to_pylist())
        places = words.indices.to_numpy(zero_copy_only=False)
        return ~uneven, ids, places, np.cumsum(np.asarray(split.value_lengths(), np.int64))

    def lengths(self, texts: pa.Array | list[str | None]) -> np.ndarray:
        """Number of ids of each text."""
        texts = _filled(texts)
        even, ids, places, ends = self._even(texts)
        found = np.zeros(len(texts), np.int64)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        total = np.concatenate([[0], np.cumsum(sizes[places])])
        found[even] = np.diff(total[np.concatenate([[0], ends])])
        for at in np.flatnonzero(~even):
            found[at] = len(self.words.ids(texts[int(at)].as_py())) // 4
        return found

    def encode_all(self, texts: pa.Array | list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        texts = _filled(texts)
        even, ids, places, ends = self._even(texts)
        flat = np.frombuffer(b"".join(ids), "<i4")
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        starts = np.cumsum(sizes) - sizes
        of_place = sizes[places]
        upto = np.concatenate([[0], np.cumsum(of_place)])
        # Each word's ids, one place after another.
        content = flat[np.arange(upto[-1]) + np.repeat(starts[places] - upto[:-1], of_place)].tobytes()
        borders = 4 * upto[np.concatenate([[0], ends])]
        made = iter([content[a:b] for a, b in itertools.pairwise(borders.tolist())])
        return [next(made) if own else self.words.ids(texts[at].as_py()) for at, own in enumerate(even.tolist())]

    def encode(self, text: str | None) -> bytes:
        return self.encode_all([text])[0]


def _filled(texts: pa.Array | list[str | None]) -> pa.Array:
    texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
    return texts.fill_null("")


def encoder_of(path: str) -> Encoder:
    """One encoder per worker, stage and tokenizer."""
    return kept_in_stage(("encoder", path), lambda: Encoder(path))


def with_token_count(
    docs: DataFrame, tokenizer: str, text: str = "text", name: str = "n_tokens", carry: list[str] | None = None
) -> DataFrame:
    """`docs` with the number of ids of each text, the end id included."""

    def count(texts: pa.Array) -> list:
        return [pa.array(encoder_of(tokenizer).lengths(texts) + 1)]

    return with_results(docs, text, f"`{name}` bigint", count, carry, arrow=True)


# ---- blocks ----------------------------------------------------------------


def bit_lengths(values: np.ndarray) -> np.ndarray:
    return np.frexp(values.astype(np.float64))[1]


def pack(ids: np.ndarray, percentile: float = PERCENTILE) -> tuple[bytes, bytes, bytes, bytes]:
    """(index, blocks, planes, patches) of unsigned 32-bit ids."""
    blocks = -(-len(ids) // BLOCK)
    grid = np.empty(blocks * BLOCK, np.uint32)
    grid[: len(ids)] = ids
    grid[len(ids) :] = ids[-1] if len(ids) else 0
    grid = grid.reshape(blocks, BLOCK)
    least = grid.min(1) if blocks else np.empty(0, np.uint32)
    rest = grid - least[:, None]
    bits = bit_lengths(rest)
    at = max(0, int(np.ceil(percentile * BLOCK)) - 1)
    widths = np.partition(bits, at, axis=1)[:, at].astype(np.uint8) if blocks else np.empty(0, np.uint8)
    patched = bits > widths[:, None]
    low = np.where(patched, 0, rest)
    most = int(widths.max(initial=0))
    planes = np.empty((blocks, most, BLOCK // 8), np.uint8)
    for bit in range(most):
        planes[:, bit] = np.packbits((low >> np.uint32(bit)).astype(np.uint8) & 1, axis=1, bitorder="little")
    packed = planes[np.arange(most) < widths[:, None]]
    starts = np.zeros((blocks + 1, 2), "<u4")
    np.cumsum(widths.astype(np.uint32) * (BLOCK // 8), out=starts[1:, 0])
    np.cumsum(patched.sum(1), out=starts[1:, 1])
    places = np.nonzero(patched)[1].astype(np.uint8)
    meta = least.astype("<u4").tobytes() + widths.tobytes()
    return starts.tobytes(), meta, packed.tobytes(), places.tobytes() + rest[patched].astype("<u4").tobytes()


def unpack(body: memoryview, blocks: int, count: int, first: int = 0, last: int | None = None) -> np.ndarray:
    """Ids of the blocks first..last-1 (all by default) from the bytes after the document table."""
    last = blocks if last is None else last
    starts = np.frombuffer(body, "<u4", 2 * (blocks + 1)).reshape(-1, 2)
    at = starts.nbytes
    least = np.frombuffer(body, "<u4", blocks, at)[first:last]
    widths = np.frombuffer(body, np.uint8, blocks, at + 4 * blocks)[first:last]
    at += 5 * blocks
    most = int(widths.max(initial=0))
    size = last - first
    planes = np.zeros((size, most, BLOCK // 8), np.uint8)
    own = np.frombuffer(body, np.uint8, int(starts[last, 0] - starts[first, 0]), at + int(starts[first, 0]))
    planes[np.arange(most) < widths[:, None]] = own.reshape(-1, BLOCK // 8)
    values = np.zeros((size, BLOCK), np.uint32)
    for bit in range(most):
        values |= np.unpackbits(planes[:, bit], axis=1, bitorder="little").astype(np.uint32) << np.uint32(bit)
    at += int(starts[-1, 0])
    patches, begin, end = int(starts[-1, 1]), int(starts[first, 1]), int(starts[last, 1])
    places = np.frombuffer(body, np.uint8, end - begin, at + begin)
    rows = np.repeat(np.arange(size), np.diff(starts[first : last + 1, 1].astype(np.int64)))
    values[rows, places] = np.frombuffer(body, "<u4", end - begin, at + patches + 4 * begin)
    values += least[:, None]
    return values.reshape(-1)[: max(0, count - first * BLOCK)]


def frame(part: int, number: int, docs: list[tuple[int | None, int, bool]], ids: np.ndarray) -> bytes:
    table = np.array(
        [(0 if doc is None else doc, n, CONTINUES * goes_on + NULL_ID * (doc is None)) for doc, n, goes_on in docs], DOC
    ).tobytes()
    body = table + b"".join(pack(ids))
    blocks = -(-len(ids) // BLOCK)
    return HEADER.pack(MAGIC, HEADER.size + len(body), part, number, len(docs), len(ids), blocks) + body


def frames_of(content: bytes) -> Iterator[tuple[int, int, np.ndarray, memoryview, int, int]]:
    """(part, number, document table, body, blocks, ids) of each frame of a file."""
    at, view = 0, memoryview(content)
    while at < len(content):
        magic, length, part, number, docs, ids, blocks = HEADER.unpack_from(content, at)
        if magic != MAGIC or content[at + length : at + length + 1] != b"\n":
            raise ValueError(f"no frame at byte {at}")
        table = np.frombuffer(view, DOC, docs, at + HEADER.size)
        yield part, number, table, view[at + HEADER.size + table.nbytes : at + length], blocks, ids
        at += length + 1


# ---- files -----------------------------------------------------------------


def frames(part: int, documents: Iterable[tuple[int | None, bytes]]) -> Iterator[bytes]:
    """Frames of (doc_id, ids as bytes); a document longer than a frame goes on in the next."""
    docs: list = []
    held: list[bytes] = []
    size = number = 0
    for doc_id, ids in documents:
        goes_on = False
        while ids:
            room = 4 * FRAME_IDS - size
            own, ids = ids[:room], ids[room:]
            docs.append((doc_id, len(own) // 4, goes_on))
            held.append(own)
            size += len(own)
            goes_on = True
            if size == 4 * FRAME_IDS:
                yield frame(part, number, docs, np.frombuffer(b"".join(held), "<u4"))
                docs, held, size, number = [], [], 0, number + 1
    if docs:
        yield frame(part, number, docs, np.frombuffer(b"".join(held), "<u4"))


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, doc_id: str = "doc_id", text: str = "text") -> None:
    """Encode every text, add the end id, write the files in ascending doc_id order.

    `tokenizer` is a path every executor has. One range of doc_ids is one file.
    """
    end = array("i", [END_ID]).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokenizer)

        def documents():
            for batch in batches:
                for piece in pieces(batch, 1):
                    for own, ids in zip(piece.column(0).to_pylist(), encoder.encode_all(piece.column(1))):
                        yield own, ids + end

        for content in frames(TaskContext.get().partitionId(), documents()):
            yield pa.RecordBatch.from_arrays([pa.array([content], pa.binary())], names=["frame"])

    # Rows with one doc_id are spread too, by text and then by chance, so that no part is unbounded.
    ordered = docs.select(whole(doc_id).cast("bigint").alias("doc_id"), whole(text).alias("text")).select(
        "doc_id", "text", F.xxhash64("text").alias("by_text"), F.rand(0).alias("by_chance")
    )
    keys = ["doc_id", "by_text", "by_chance"]
    sorted_docs = ordered.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text")
    rows = sorted_docs.mapInArrow(run, "frame binary").select(F.col("frame").cast("string").alias("value"))
    rows.write.option("lineSep", "\n").option("compression", "none").text(folder)


def documents_in(content: bytes) -> Iterator[tuple[int, int, int | None, np.ndarray]]:
    """(part, place in the part, doc_id, ids) of each document of a file."""
    place, open_doc = 0, None
    for part, _, table, body, blocks, count in frames_of(content):
        ids = unpack(body, blocks, count)
        at = 0
        for doc_id, n, flags in table.tolist():
            own, at = ids[at : at + n], at + n
            if flags & CONTINUES:
                open_doc[3].append(own)
                continue
            if open_doc:
                yield *open_doc[:3], np.concatenate(open_doc[3])
                place += sum(map(len, open_doc[3]))
            open_doc = (part, place, None if flags & NULL_ID else doc_id, [own])
    if open_doc:
        yield *open_doc[:3], np.concatenate(open_doc[3])


def read_files(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("content")


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """(part, place, doc_id, ids) of every document, from the files."""

    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                rows = list(documents_in(content.as_py()))
                columns = list(zip(*rows)) or [[]] * 4
                types = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), t) for c, t in zip(columns, types)], names=["part", "place", "doc_id", "ids"]
                )

    return read_files(spark, folder).mapInArrow(run, "part bigint, place bigint, doc_id bigint, ids array<bigint>")


def token_index(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files."""

    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                rows = [(part, place, doc_id, len(ids), zlib.crc32(ids.astype("<u4").tobytes()))
                        for part, place, doc_id, ids in documents_in(content.as_py())]
                columns = list(zip(*rows)) or [[]] * 5
                names = ["part", "place", "doc_id", "n_tokens", "ids_crc32"]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], names=names)

    schema = "part bigint, place bigint, doc_id bigint, n_tokens bigint, ids_crc32 bigint"
    own = reliable(read_files(spark, folder).mapInArrow(run, schema))
    # One row per file: the ids of all parts before it.
    before = F.sum("ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    base = own.groupBy("part").agg(F.sum("n_tokens").alias("ids")).select(
        "part", F.coalesce(before, F.lit(0)).alias("base")
    )
    return own.join(base, "part").select("doc_id", (F.col("base") + F.col("place")).alias("start"), "n_tokens", "ids_crc32")
