"""BPE encoding by dynamic programming over prefixes, and decoding.

Byte-pair encoding has one property that makes it a table fill instead of a merge
loop: the encoding of a prefix is the encoding of a shorter prefix plus one last
token. For every prefix of a word the automaton over the vocabulary names the
tokens that end there; the one whose left neighbour (the stored last token of the
shorter prefix) may stand beside it is the last token of this prefix. Following
the stored tokens back from the end gives the ids.

Two tokens may stand side by side if, undoing their merges from the latest one
back, no merge across the border would have come first.

Words of a text are independent, so each worker keeps a bounded memo of them.

Vocabulary files are the JSON of the tokenizers library with a BPE model, NFC and
lower-case normalisation, white space dropped, byte-level letters and an
end-of-word suffix. Decoding joins the token strings with a space, as that
library does for a file without a decoder.

Defined results: null and empty texts have no ids and decode to the empty text;
special tokens written in a text are those tokens; ids outside the vocabulary are
left out when decoding. An empty table gives no rows.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
import unicodedata
from array import array

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from earshot.llm.common import PIECE_BYTES, byte_letters, whole, with_results

# A worker's memos hold this many words and pieces of at most this many characters.
MEMO_ENTRIES = 250_000
MEMO_CHARS = 64
MEMO_PAIRS = 300_000

# Beyond these letters Unicode versions differ; the library's own normaliser and
# word pattern are asked there.
UNUSUAL = re.compile("[^\x00-\u024f]")

# White space of the normaliser; `str.split` also splits at these four controls.
MORE_THAN_SPACE = re.compile("[\x1c-\x1f]")
PIECE = re.compile("[^\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")


class Vocabulary:
    """Tokens as strings of atoms (bytes, and bytes that end a word), merges, and the automaton."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model = content["model"]
        ids, suffix = model["vocab"], model["end_of_word_suffix"]
        pattern = content["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pattern = regex.compile(pattern)
        self.library = Tokenizer.from_file(path)
        self.byte_of = {letter: byte for byte, letter in enumerate(byte_letters())}
        self.special = {token["content"]: token["id"] for token in content["added_tokens"]}
        self.special_pattern = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len)[::-1])) + ")")
        size = 1 + max([*ids.values(), *self.special.values()])
        self.strings: list[str | None] = [None] * size
        for string, token in [*ids.items(), *self.special.items()]:
            self.strings[token] = string
        self.atoms: list[str | None] = [None] * size
        self.rank = [-1] * size
        self.halves: list[tuple[int, int] | None] = [None] * size
        self.pair_rank: dict[tuple[int, int], int] = {}
        for letter, byte in self.byte_of.items():
            self.atoms[ids[letter]] = chr(byte)
            self.atoms[ids[letter + suffix]] = chr(256 + byte)
        for rank, (left, right) in enumerate(model["merges"]):
            pair, token = (ids[left], ids[right]), ids[left + right]
            if self.halves[token] is not None:
                raise ValueError(f"two merges make the token {left + right!r}")
            self.halves[token], self.rank[token], self.pair_rank[pair] = pair, rank, rank
            self.atoms[token] = self.atoms[pair[0]] + self.atoms[pair[1]]
        self.pairs: dict[int, bool] = {}
        self.automaton = ahocorasick.Automaton()
        stable: dict[int, bool] = {}
        for token, atoms in enumerate(self.atoms):
            if atoms is None:
                continue
            halves = self.halves[token]
            stable[token] = halves is None or (
                stable.get(halves[0], False) and stable.get(halves[1], False) and self.side_by_side(*halves, joined=True)
            )
            if stable[token]:
                self.automaton.add_word(atoms, (token, len(atoms)))
        self.automaton.make_automaton()

    def side_by_side(self, left: int, right: int, joined: bool = False) -> bool:
        """Whether no merge across the border comes before the merges that made both tokens.

        `joined` leaves out the merge of the two tokens themselves.
        """
        rank, pair_rank, halves = self.rank, self.pair_rank, self.halves
        before = -1 if joined else len(self.pair_rank)
        while True:
            if pair_rank.get((left, right), before) < before:
                return False
            if rank[left] < 0 and rank[right] < 0:
                return True
            # Equal merges run from left to right, so of two equal ones the right one is later.
            if rank[left] > rank[right]:
                before, left = rank[left], halves[left][1]
            else:
                before, right = rank[right] + 1, halves[right][0]

    def may_follow(self, left: int, right: int) -> bool:
        if len(self.pairs) >= MEMO_PAIRS:
            self.pairs.clear()
        fits = self.pairs[left << 32 | right] = self.side_by_side(left, right)
        return fits

    def encode_word(self, word: bytes) -> list[int]:
        """Ids of a word given as its bytes."""
        atoms = word[:-1].decode("latin-1") + chr(256 + word[-1])
        last: list[tuple[int, int] | None] = [None] * len(atoms)
        known = self.pairs.get
        for end, found in self.automaton.iter(atoms):
            if last[end] is None:
                token, length = found
                if length > end:
                    last[end] = found
                elif before := last[end - length]:
                    fits = known(before[0] << 32 | token)
                    if fits or (fits is None and self.may_follow(before[0], token)):
                        last[end] = found
        ids, end = [], len(atoms) - 1
        while end >= 0:
            token, length = last[end]
            ids.append(token)
            end -= length
        return ids[::-1]

    def words(self, piece: str) -> list[bytes]:
        """The words of a piece without white space, as bytes."""
        if not UNUSUAL.search(piece):
            return [word.encode("utf-8") for word in self.pattern.findall(piece)]
        found = self.library.pre_tokenizer.pre_tokenize_str(piece)
        return [bytes([self.byte_of[letter] for letter in word]) for word, _ in found]


class WordMemo(dict):
    """Word -> its ids as little-endian bytes; bounded."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, word: bytes) -> bytes:
        ids = array("i", self.vocabulary.encode_word(word)).tobytes()
        if len(word) <= MEMO_CHARS:
            if len(self) >= MEMO_ENTRIES:
                self.clear()
            self[word] = ids
        return ids


class PieceMemo(dict):
    """Piece without white space -> the ids of its words; bounded."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary, self.of_word = vocabulary, WordMemo(vocabulary)

    def __missing__(self, piece: str) -> bytes:
        of_word = self.of_word
        ids = b"".join([of_word[word] for word in self.vocabulary.words(piece)])
        if len(piece) <= MEMO_CHARS:
            if len(self) >= MEMO_ENTRIES:
                self.clear()
            self[piece] = ids
        return ids


@functools.cache
def memo_of(path: str) -> PieceMemo:
    return PieceMemo(Vocabulary(path))


def normalised_pieces(vocabulary: Vocabulary, text: str) -> list[str]:
    """Pieces between white space, composed and lower-cased letter by letter."""
    if UNUSUAL.search(text):
        text = vocabulary.library.normalizer.normalize_str(text)
    else:
        text = unicodedata.normalize("NFC", text).lower()
    return PIECE.findall(text) if MORE_THAN_SPACE.search(text) else text.split()


def encode_text(memo: PieceMemo, text: str | None) -> bytes:
    """Ids of a text as little-endian 32-bit integers."""
    if not text:
        return b""
    vocabulary = memo.vocabulary
    if "<|" not in text:
        return b"".join([memo[piece] for piece in normalised_pieces(vocabulary, text)])
    parts = []
    for section in vocabulary.special_pattern.split(text):
        if section in vocabulary.special:
            parts.append(array("i", [vocabulary.special[section]]).tobytes())
        else:
            parts += [memo[piece] for piece in normalised_pieces(vocabulary, section)]
    return b"".join(parts)


def id_lists(encoded: list[bytes]) -> pa.Array:
    """Byte strings of ids as an Arrow list column, without an object per id."""
    offsets = np.zeros(len(encoded) + 1, np.int32)
    np.cumsum([len(ids) // 4 for ids in encoded], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(encoded), "<i4")))


def encode_documents(
    docs: DataFrame, vocabulary: str, text: str = "text", ids: str = "ids", carry: list[str] | None = None
) -> DataFrame:
    """`docs` with the column `ids`, an array of token ids. `vocabulary` is a path every executor has."""

    def encode(texts: list[str | None]) -> list:
        memo = memo_of(vocabulary)
        return [id_lists([encode_text(memo, t) for t in texts])]

    return with_results(docs, text, f"`{ids}` array<int>", encode, carry)


@functools.cache
def strings_of(path: str) -> np.ndarray:
    """Token strings by id, None where there is none and at the end."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    by_id = {token: string for string, token in content["model"]["vocab"].items()}
    by_id |= {token["id"]: token["content"] for token in content["added_tokens"]}
    return np.array([by_id.get(token) for token in range(max(by_id) + 2)], dtype=object)


def decode_ids(strings: np.ndarray, ids: np.ndarray) -> str:
    known = np.where((ids >= 0) & (ids < len(strings)), ids, len(strings) - 1)
    return " ".join([s for s in strings[known].tolist() if s is not None])


def decode_documents(
    df: DataFrame, vocabulary: str, ids: str = "ids", text: str = "decoded", digest: str | None = None
) -> DataFrame:
    """`df` with the column `text`, decoded from the array `ids`; null ids decode to the empty text.

    `digest` names one more column for the SHA-256 (lowercase hex) of the ids as
    little-endian unsigned 32-bit integers.
    """
    new = [text] + [digest] * bool(digest)
    kept = [c for c in df.columns if c.lower() not in {name.lower() for name in new}]
    schema = df.select(*map(whole, kept)).schema
    for name in new:
        schema = schema.add(name, "string")
    place = kept.index(ids)

    def run(batches):
        strings = strings_of(vocabulary)
        for batch in batches:
            step = max(1, PIECE_BYTES * batch.num_rows // max(1, batch.column(place).nbytes))
            for start in range(0, batch.num_rows, step):
                piece = batch.slice(start, step)
                own = [x.values.to_numpy(zero_copy_only=False) if x.is_valid else np.empty(0, np.int32)
                       for x in piece.column(place)]
                results = [pa.array([decode_ids(strings, x) for x in own], pa.string())]
                if digest:
                    sums = [hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in own]
                    results.append(pa.array(sums, pa.string()))
                yield pa.RecordBatch.from_arrays(piece.columns + results, names=kept + new)

    return df.select(*map(whole, kept)).mapInArrow(run, schema)
