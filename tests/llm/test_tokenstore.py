import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from earshot.llm import tokenstore
from earshot.session import scratch_folder
from tests.llm.tables import DOCUMENTS, documents, with_clashes

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def blocks_round_trip(ids):
    body = memoryview(b"".join(tokenstore.pack(ids)))
    blocks = -(-len(ids) // tokenstore.BLOCK)
    assert (tokenstore.unpack(body, blocks, len(ids)) == ids).all()
    return body, blocks


def test_blocks_round_trip():
    rng = np.random.default_rng(0)
    for size in (0, 1, 127, 128, 129, 1000):
        blocks_round_trip(rng.integers(0, 50_000, size).astype(np.uint32))
        blocks_round_trip(np.full(size, 2**32 - 1, np.uint32))
    ids = rng.integers(100, 164, 12_800).astype(np.uint32)
    ids[::20] = 2**32 - 1 - ids[::20]
    body, blocks = blocks_round_trip(ids)
    # six bits for most, the outliers as exceptions
    assert len(body) < len(ids) * (6 / 8 + 5 / 20) + 13 * blocks + 20
    for first, last in ((0, 1), (7, 9), (blocks - 1, blocks)):
        own = tokenstore.unpack(body, blocks, len(ids), first, last)[: (last - first) * tokenstore.BLOCK]
        assert (own == ids[first * tokenstore.BLOCK : last * tokenstore.BLOCK]).all()


def test_frames_round_trip(monkeypatch):
    monkeypatch.setattr(tokenstore, "FRAME_IDS", 10)
    rng = np.random.default_rng(1)
    docs = [(None if i == 0 else i, rng.integers(0, 99, n).astype("<u4")) for i, n in enumerate([1, 10, 35, 9, 1, 60])]
    content = b"".join(f + b"\n" for f in tokenstore.frames(3, [(d, ids.tobytes()) for d, ids in docs]))
    place = 0
    found = list(tokenstore.documents_in(content))
    assert len(found) == len(docs)
    for (part, at, doc_id, ids), (own_id, own) in zip(found, docs):
        assert (part, at, doc_id, ids.tolist()) == (3, place, own_id, own.tolist())
        place += len(own)
    with pytest.raises(ValueError):
        list(tokenstore.documents_in(content[:-1] + b"x"))


def test_ids_are_the_library_s(library):
    rng = random.Random(2)
    letters = "abcde é ñ  .,!?'s19\n\t日😀\r\x1c\xa0 st\n"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(5000)]
    texts += ["a <|endoftext|> b", "x  <|endoftext|>", "we'll.\nI'd, don't.", "é., ,. a.", "x" * 500, "a.,b"]
    encoder = tokenstore.Encoder(PATH)
    for text, own in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(encoder.encode(text), "<i4").tolist() == own.ids, text


def test_files(spark, library):
    folder = scratch_folder(spark, "test")
    docs = with_clashes(documents(spark), ["ids", "part", "value"])
    tokenstore.write_tokens(docs, folder, PATH)
    rows = tokenstore.token_index(spark, folder).orderBy("start").collect()
    ids = {(r["part"], r["place"]): r for r in tokenstore.read_tokens(spark, folder).collect()}
    assert [r["doc_id"] for r in rows] == [None, None, 1, 2, 2, 3, 4, 5, 6, 7, 8] and len(ids) == 11
    texts = {}
    for r in docs.collect():
        texts.setdefault(r["doc_id"], set()).add(r["text"])
    at = 0
    for row in rows:
        assert row["start"] == at
        at += row["n_tokens"]
        options = [library.encode(t or "", add_special_tokens=False).ids + [0] for t in texts[row["doc_id"]]]
        assert (row["n_tokens"], row["ids_crc32"]) in [(len(o), zlib.crc32(np.array(o, "<u4").tobytes())) for o in options]
    counts = {(r["doc_id"], r["text"]): r["n_tokens"] for r in tokenstore.with_token_count(docs, PATH).collect()}
    assert counts[3, None] == counts[4, ""] == 1 and sum(r["n_tokens"] for r in rows) == at


def test_empty_table(spark):
    folder = scratch_folder(spark, "test")
    tokenstore.write_tokens(spark.createDataFrame([], DOCUMENTS), folder, PATH)
    assert tokenstore.token_index(spark, folder).count() == 0
