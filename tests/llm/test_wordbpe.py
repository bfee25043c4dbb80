import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from earshot.llm import wordbpe
from tests.conftest import SF_DIR
from tests.llm.tables import DOCUMENTS, LONG, documents, with_clashes

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(text):
    return np.frombuffer(wordbpe.encode_text(wordbpe.memo_of(PATH), text), "<i4").tolist()


def test_ids_are_the_library_s(library):
    rng = random.Random(5)
    letters = "abcdeéèßñ  .,!?'1239\n\t日σΣ😀stvmrl\x1c İ"
    texts = ["", "a" * 300, "!" * 50, "don't WE'LL 's", "x<|endoftext|>y <|startoftext|>", "é ﬁ ½ Ⅷ"]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(4000)]
    texts += ["a" + chr(c) + "B " + chr(c) for c in range(1, 0x3000, 7)]
    for text, own in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        assert ids_of(text) == own.ids, text
        decoded = wordbpe.decode_ids(wordbpe.strings_of(PATH), np.array(own.ids, int))
        assert decoded == library.decode(own.ids, skip_special_tokens=False)


def test_last_tokens_are_unique():
    """Of the tokens that end at a place, one at most may follow what comes before."""
    vocabulary = wordbpe.Vocabulary(PATH)
    word = b"unbelievablereorganisations"
    atoms = word[:-1].decode("latin-1") + chr(256 + word[-1])
    last = {-1: None}
    for end, (token, length) in vocabulary.automaton.iter(atoms):
        start = end - length
        fits = start < 0 or (last.get(start) is not None and vocabulary.side_by_side(last[start], token))
        if fits:
            assert last.get(end) is None
            last[end] = token
    assert sorted(last) == list(range(-1, len(atoms)))


def test_documents(spark, library):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    encoded = wordbpe.encode_documents(docs, PATH)
    rows = wordbpe.decode_documents(encoded, PATH, digest="sha").collect()
    for row, own in zip(rows, library.encode_batch([r["text"] for r in rows], add_special_tokens=False)):
        assert row["ids"] == own.ids and row["decoded"] == library.decode(own.ids, skip_special_tokens=False)
        assert row["sha"] == hashlib.sha256(np.array(own.ids, "<u4").tobytes()).hexdigest()


def test_awkward_rows_and_clashing_names(spark, library):
    docs = with_clashes(documents(spark), ["ids", "decoded"])
    rows = wordbpe.decode_documents(wordbpe.encode_documents(docs, PATH), PATH).collect()
    assert len(rows) == 11
    for row in rows:
        own = library.encode(row["text"] or "", add_special_tokens=False).ids
        assert row["ids"] == own and row["decoded"] == library.decode(own, skip_special_tokens=False)
    assert any(row["text"] == LONG for row in rows)
    nulls = spark.createDataFrame([(1, None), (2, [7, None, 99_999_999, -1])], "id int, ids array<int>")
    decoded = {r["id"]: r["decoded"] for r in wordbpe.decode_documents(nulls.filter("id = 1"), PATH).collect()}
    assert decoded == {1: ""}
    assert wordbpe.decode_ids(wordbpe.strings_of(PATH), np.array([0, 99_999_999, -1])) == "!"


def test_empty_table(spark):
    encoded = wordbpe.encode_documents(spark.createDataFrame([], DOCUMENTS), PATH)
    assert wordbpe.decode_documents(encoded, PATH).count() == 0
