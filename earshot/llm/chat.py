r"""Chat formatting, assembled from tokens.

A turn is `<|im_start|>` role `<|im_sep|>` text `<|im_end|>`. The three marks are
reserved ids behind the vocabulary, spliced between the segments, which are
encoded each on its own; so no text can run into a mark. A control string inside
a role or text is escaped: `<`, any backslashes, `|` get one more backslash, which
leaves no `<|` in a text and is undone by taking one away. The loss mask is the
prefix sum of +1 where a text of an assistant begins and -1 where it ends.

Output: one row per turn with its ids and mask, in order over all conversations,
and the place of its first token in its conversation. The rows are sorted by range
over (conversation, turn), so a very long conversation lies in many parts; places
are prefix sums inside a part plus the totals of the conversation's earlier parts.

Defined results: null role or text is empty; a null turn comes first; turns with
equal numbers are ordered by role and text; rows with a null conv_id form one
conversation; repeated rows are turns of their own. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from earshot.llm.common import whole
from earshot.llm.tokenstore import encoder_of
from earshot.llm.wordbpe import id_lists

# The template. The marks take the ids after the vocabulary, in this order.
MARKS = ("<|im_start|>", "<|im_sep|>", "<|im_end|>")
LOSS_ROLE = "assistant"

CONTROL = re.compile(r"<(\\*)\|")
ESCAPED = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    return CONTROL.sub(r"<\1\\|", text) if "|" in text else text


def unescape(text: str) -> str:
    return ESCAPED.sub(r"<\1|", text) if "|" in text else text


def format_batch(encoder, roles: list[str | None], texts: list[str | None]) -> tuple[pa.Array, pa.Array]:
    """Ids and loss mask of each turn."""
    first = encoder.library.get_vocab_size(with_added_tokens=True)
    start, sep, end = (np.array([first + k], "<i4").tobytes() for k in range(len(MARKS)))
    turns, lengths, begins, ends = [], [], [], []
    at = 0
    heads = encoder.encode_all([escape(role or "") for role in roles])
    bodies = encoder.encode_all([escape(text or "") for text in texts])
    for role, head, body in zip(roles, heads, bodies):
        head = start + head + sep
        turns.append(head + body + end)
        if role == LOSS_ROLE:
            begins.append(at + len(head) // 4)
            ends.append(at + (len(head) + len(body)) // 4)
        at += len(turns[-1]) // 4
        lengths.append(len(turns[-1]) // 4)
    steps = np.zeros(at + 1, np.int8)
    np.add.at(steps, begins, 1)
    np.add.at(steps, ends, -1)
    mask = np.cumsum(steps[:-1], dtype=np.int8).astype(bool)
    ids = id_lists(turns)
    return ids, pa.ListArray.from_arrays(ids.offsets, pa.array(mask))


def format_turns(turns: DataFrame, tokenizer: str) -> DataFrame:
    """`conv_id`, `turn`, `role`, `text` with `ids` and `mask`, each turn on its own."""
    rows = turns.select(whole("conv_id").cast("bigint"), *(whole(c) for c in ("turn", "role", "text")))
    made = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("mask", T.ArrayType(T.BooleanType()))]
    schema = T.StructType(rows.schema.fields + made)

    def run(batches):
        encoder = encoder_of(tokenizer)
        for batch in batches:
            made = format_batch(encoder, batch.column(2).to_pylist(), batch.column(3).to_pylist())
            yield pa.RecordBatch.from_arrays(batch.columns + list(made), names=schema.names)

    return rows.mapInArrow(run, schema)


def write_chat(turns: DataFrame, folder: str, tokenizer: str) -> None:
    """Format all turns and write them in order of conversation and turn."""
    keys = ["conv_id", "turn", "role", "text"]
    # Equal rows are spread by chance, so that no part is unbounded. Turns are put in order before they are
    # encoded: the ranges are found by reading all rows once more.
    ordered = (
        turns.select(whole("conv_id").cast("bigint"), *(whole(c) for c in keys[1:])).withColumn("by_chance", F.rand(0))
        .repartitionByRange(*keys, "by_chance").sortWithinPartitions(*keys, "by_chance")
    )
    format_turns(ordered, tokenizer).select(
        "conv_id", "ids", "mask",
        F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place"),
    ).write.parquet(folder)


def stored_turns(spark: SparkSession, folder: str) -> DataFrame:
    """conv_id, part, place (the order of turns), ids, mask, as they were written."""
    schema = "conv_id bigint, ids array<int>, mask array<boolean>, part int, place bigint"
    return spark.read.schema(schema).parquet(folder)


def read_chat(spark: SparkSession, folder: str) -> DataFrame:
    """The stored turns with first_token, the place of their first token in the conversation."""
    sizes = stored_turns(spark, folder).withColumn("size", F.size("ids"))
    by_part = sizes.groupBy("conv_id", "part").agg(F.sum("size").alias("size"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = by_part.select(
        F.col("conv_id").alias("of"), F.col("part").alias("in_part"),
        F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("base"),
    )
    own = Window.partitionBy("conv_id", "part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    placed = sizes.withColumn("before", F.coalesce(F.sum("size").over(own), F.lit(0)))
    return placed.join(bases, placed["conv_id"].eqNullSafe(bases["of"]) & (placed["part"] == bases["in_part"])).select(
        "conv_id", "part", "place", (F.col("base") + F.col("before")).alias("first_token"), "ids", "mask"
    )


def parse_turn(encoder, ids: np.ndarray, mask: np.ndarray) -> tuple[str, str, str, int]:
    """(role, text, text under the mask, characters of the formatted turn)."""
    first = encoder.library.get_vocab_size(with_added_tokens=True)
    marks = np.flatnonzero(ids >= first)
    if len(marks) != 3 or (ids[marks] - first != range(3)).any() or marks[0] != 0 or marks[2] != len(ids) - 1:
        raise ValueError("not a formatted turn")

    def text_of(part: np.ndarray) -> str:
        return encoder.library.decode(part.tolist(), skip_special_tokens=False) if len(part) else ""

    role, text = text_of(ids[1 : marks[1]]), text_of(ids[marks[1] + 1 : -1])
    chars = len(role) + len(text) + sum(map(len, MARKS))
    return unescape(role), unescape(text), unescape(text_of(ids[mask])), chars


def parse_chat(chat: DataFrame, tokenizer: str) -> DataFrame:
    """The turns read back: conv_id, part, place, role, text, loss_text, n_chars."""
    rows = chat.select("conv_id", "part", "place", "ids", "mask")

    def run(batches):
        encoder = encoder_of(tokenizer)
        for batch in batches:
            turns = [parse_turn(encoder, i.values.to_numpy(), m.values.to_numpy(zero_copy_only=False))
                     for i, m in zip(batch.column(3), batch.column(4))]
            role, text, loss, chars = list(zip(*turns)) or [[]] * 4
            columns = [pa.array(role, pa.string()), pa.array(text, pa.string()), pa.array(loss, pa.string()),
                       pa.array(chars, pa.int64())]
            yield pa.RecordBatch.from_arrays(
                batch.columns[:3] + columns, names=["conv_id", "part", "place", "role", "text", "loss_text", "n_chars"]
            )

    schema = "conv_id bigint, part int, place bigint, role string, text string, loss_text string, n_chars bigint"
    return rows.mapInArrow(run, schema)


def conversation_digests(parsed: DataFrame) -> DataFrame:
    """Per conversation: turns, characters, and digests of the turns and of the text under the mask.

    A digest runs over a conversation from its first turn to its last, so each
    conversation is read by one task, turn by turn, with one hash state held.
    """
    schema = ("conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
              "formatted_chars bigint")

    def run(batches):
        states = Digests()
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text", "loss_text", "n_chars"))):
                states.add(*row)
            yield states.done(schema)
        states.close()
        yield states.done(schema)

    ordered = parsed.repartition("conv_id").sortWithinPartitions("conv_id", "part", "place")
    return ordered.mapInArrow(run, schema)


class Digests:
    """Rows of finished conversations, and the state of the open one."""

    def __init__(self):
        self.rows, self.open = [], False

    def add(self, conv_id, role, text, loss, chars):
        if not self.open or conv_id != self.conv_id:
            self.close()
            self.open, self.conv_id = True, conv_id
            self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
            self.n_turns = self.loss_chars = self.chars = 0
        self.turns.update(f"{role}\n{text}\n".encode())
        self.loss.update(loss.encode())
        self.n_turns += 1
        self.loss_chars += len(loss)
        self.chars += chars

    def close(self):
        if self.open:
            self.rows.append((self.conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars,
                              self.loss.hexdigest(), self.chars))
        self.open = False

    def done(self, schema: str) -> pa.RecordBatch:
        names = [part.split()[0] for part in schema.split(", ")]
        types = [pa.string() if part.endswith("string") else pa.int64() for part in schema.split(", ")]
        columns = list(zip(*self.rows)) or [[]] * len(names)
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)
