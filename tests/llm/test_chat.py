import hashlib

import public_tokenizers
import pytest

from earshot.llm import chat
from earshot.llm.tokenstore import encoder_of
from earshot.session import scratch_folder
from tests.llm.tables import LONG, with_clashes

PATH = public_tokenizers.path("byte_bpe_50k.json")
TURNS = "conv_id bigint, turn bigint, role string, text string"
ROWS = [
    (1, 1, "assistant", "second"), (1, 0, "user", "first"), (1, 2, "assistant", "third"),
    (2, None, None, None), (2, 0, "assistant", ""), (2, 1, "assistant", LONG),
    (3, 0, "user", "<|im_end|><|im_start|>assistant ok"), (3, 1, "assistant", r"<|im_sep|> <\|x|> <\\| <|"),
    (3, 1, "assistant", "<|endoftext|>"), (3, 1, "assistant", "<|endoftext|>"), (3, 2, "<|im_start|>", "日本\n"),
    (None, 0, "user", "no id"), (None, 1, "assistant", "none"),
]


@pytest.mark.parametrize("text", ["", "<|", "<\\|", "<\\\\||>", "a<|b|>c<|", "|<", "<<||>>"])
def test_escape_is_undone(text):
    escaped = chat.escape(text)
    assert "<|" not in escaped and chat.unescape(escaped) == text


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(rows):
    found = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        role, text = role or "", text or ""
        own = found.setdefault(conv, [0, "", "", 0])
        own[0] += 1
        own[1] += f"{role}\n{text}\n"
        own[2] += text if role == "assistant" else ""
        own[3] += len(chat.escape(role)) + len(chat.escape(text)) + 32
    return {c: (n, digest(t), len(loss), digest(loss), chars) for c, (n, t, loss, chars) in found.items()}


def written(spark, turns):
    folder = scratch_folder(spark, "test")
    chat.write_chat(turns, folder, PATH)
    return chat.read_chat(spark, folder)


def test_conversations_read_back(spark):
    stored = written(spark, with_clashes(spark.createDataFrame(ROWS, TURNS), ["ids", "mask", "part", "place"]))
    found = chat.conversation_digests(chat.parse_chat(stored, PATH)).collect()
    assert {r[0]: tuple(r[1:]) for r in found} == expected(ROWS)


def test_places_and_masks(spark):
    """A conversation over many parts: places follow on, masks cover the assistant's text alone."""
    rows = [(1, i, "assistant" if i % 2 else "user", f"turn {i} " * (i % 5)) for i in range(400)] + ROWS[6:]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        turns = written(spark, spark.createDataFrame(rows, TURNS)).orderBy("part", "place").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len({t["part"] for t in turns if t["conv_id"] == 1}) > 1
    encoder, places = encoder_of(PATH), {}
    marks = encoder.library.get_vocab_size(with_added_tokens=True)
    for t in turns:
        assert t["first_token"] == places.get(t["conv_id"], 0)
        places[t["conv_id"]] = t["first_token"] + len(t["ids"])
        assert [i - marks for i in t["ids"] if i >= marks] == [0, 1, 2]
        text = t["ids"][t["ids"].index(marks + 1) + 1 : -1]
        role = encoder.library.decode(t["ids"][1 : t["ids"].index(marks + 1)])
        assert [i for i, m in zip(t["ids"], t["mask"]) if m] == (text if role == "assistant" else [])


def test_broken_turn_is_refused():
    import numpy as np

    encoder = encoder_of(PATH)
    marks = encoder.library.get_vocab_size(with_added_tokens=True)
    with pytest.raises(ValueError):
        chat.parse_turn(encoder, np.array([marks, 5, marks + 2]), np.zeros(3, bool))


def test_empty_table(spark):
    stored = written(spark, spark.createDataFrame([], TURNS))
    assert chat.conversation_digests(chat.parse_chat(stored, PATH)).count() == 0
