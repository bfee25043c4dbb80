"""Quality rules, line first: bad lines go, then documents that lost too much.

A line is a piece between newlines; words are `[^\\x20\\x09-\\x0D]+`. A line with
words is removed if one of three rules fails:

* punctuation: more than `MAX_MARK_SHARE` of the line's characters are punctuation and
  symbols (vowel signs and other combining characters are parts of words);
* navigation: items between separators (`|`, `>`, bullets), a short line of menu words, or
  one of `MIN_OPEN_RUN` or more open lines in a row (fewer than `MIN_OPEN_WORDS` words, no
  end mark; lines without a word between them do not count), so that a heading, a
  signature or a line of code next to longer lines stays;
* boilerplate: a short line of which fixed phrases make up `MIN_PHRASE_SHARE` of the
  characters, so that a sentence that only mentions one stays.

A document is kept if the base rules hold and it lost at most `MAX_LOSS` of the
characters in its words. Lines without a word are carried along and count for nothing.

Defined results: a null or empty text has no words, fails the base rules and is
not kept. Very long texts are judged whole. Repeated rows are judged each on its own.
Extra columns, also of the names used here, are carried or left as they are. An
empty table gives no rows.
"""

from __future__ import annotations

import re

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from earshot.llm.common import numbered, with_results

# The contract's base rules.
SYMBOLS = b"#*$%&|<>"
WINDOW_WORDS = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

# Production parameters of the line rules.
MIN_OPEN_WORDS = 4
MIN_OPEN_RUN = 4
MAX_MARK_SHARE = 0.2
LEAST_MARKS = 6
MIN_SEPARATORS = 3
MAX_WORDS_PER_SEPARATOR = 4
MAX_PHRASE_WORDS = 30
MIN_PHRASE_SHARE = 0.3
MAX_MENU_WORDS = 6
MAX_LOSS = 0.5

END_MARKS = (".", "!", "?", "…", ":", ";", '"', "'", "”", "’", "»", ")", "]", "。", "！", "？", "।", "؟", "۔")
MARKS = regex.compile(r"[\p{P}\p{S}]")
SEPARATORS = frozenset({b"|", b">", b"<", b"/", "»".encode(), "›".encode(), "·".encode(), "•".encode(), b"::"})
MENU_WORDS = frozenset(
    b"home menu login logout register search contact about sitemap next previous back top share print "
    b"accueil connexion startseite anmelden inicio buscar".split()
)
PHRASES = re.compile(
    "all rights reserved|privacy policy|terms of (?:use|service)|cookie policy|this (?:web)?site uses cookies|uses cookies|accept cookies|"
    "enable javascript|click here|sign up for|subscribe to our|powered by|skip to content|share this|"
    "back to top|tous droits réservés|alle rechte vorbehalten|todos los derechos reservados"
)

# Odd multipliers for the hash of a window; any will do, hits are compared exactly.
MULTIPLIERS = [np.uint64((0x9E3779B97F4A7C15 * (2 * k + 1)) % 2**64) for k in range(WINDOW_WORDS)]


def repeated_words(words: list[bytes]) -> int:
    """Words inside 8-word windows that stand twice or more in the text, first included."""
    starts = len(words) - WINDOW_WORDS + 1
    if starts < 2:
        return 0
    hashed = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    windows = hashed[:starts] * MULTIPLIERS[0]
    for k in range(1, WINDOW_WORDS):
        windows += hashed[k : k + starts] * MULTIPLIERS[k]
    ordered = np.sort(windows)
    if not (ordered[1:] == ordered[:-1]).any():
        return 0
    _, inverse, counts = np.unique(windows, return_inverse=True, return_counts=True)
    candidates = np.flatnonzero(counts[inverse] > 1).tolist()
    found: dict[tuple, list[int]] = {}
    for at in candidates:
        found.setdefault(tuple(words[at : at + WINDOW_WORDS]), []).append(at)
    steps = np.zeros(len(words) + 1, np.int64)
    for places in found.values():
        if len(places) > 1:
            steps[places] += 1
            steps[np.array(places) + WINDOW_WORDS] -= 1
    return int((np.cumsum(steps[:-1]) > 0).sum())


def is_open(line: bytes, words: list[bytes]) -> bool:
    return len(words) < MIN_OPEN_WORDS and not line.decode("utf-8", "replace").strip().endswith(END_MARKS)


def line_fails(line: bytes, words: list[bytes]) -> str | None:
    """The rule that a line with words fails whatever stands around it, or None."""
    text = line.decode("utf-8", "replace").strip()
    separators = sum(word in SEPARATORS for word in words)
    if separators >= MIN_SEPARATORS and separators * MAX_WORDS_PER_SEPARATOR >= len(words):
        return "navigation"
    if len(words) <= MAX_MENU_WORDS and all(word.lower().strip(b".,:!") in MENU_WORDS for word in words):
        return "navigation"
    chars = sum(len(word.decode("utf-8", "replace")) for word in words)
    marks = len(MARKS.findall(text))
    if marks >= LEAST_MARKS and marks > MAX_MARK_SHARE * chars:
        return "punctuation"
    if len(words) <= MAX_PHRASE_WORDS:
        phrases = PHRASES.findall(text.lower())
        if phrases and sum(len(p.replace(" ", "")) for p in phrases) >= MIN_PHRASE_SHARE * chars:
            return "boilerplate"
    return None


def rules_failed(lines: list[bytes], words: list[list[bytes]]) -> list[str | None]:
    """The rule each line with words fails, or None; `words` holds the words of each line."""
    failed = [line_fails(line, own) for line, own in zip(lines, words)]
    run = 0
    for i in range(len(lines) + 1):
        if i < len(lines) and is_open(lines[i], words[i]):
            run += 1
            continue
        if run >= MIN_OPEN_RUN:
            failed[i - run : i] = ["navigation"] * run
        run = 0
    return failed


def judge(text: str | None) -> tuple:
    """All figures of one text, and the text without its failed lines."""
    if text is None:
        return 0, 0, 0, 0, 0, True, False, 0, 0, 0, None
    raw = text.encode("utf-8")
    words = raw.split()
    continuation = len(raw) - len(text)
    word_chars = sum(map(len, words)) - continuation
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = raw.split(b"\n")
    split = [line.split() for line in lines]
    worded = [i for i, own in enumerate(split) if own]
    rules = rules_failed([lines[i] for i in worded], [split[i] for i in worded])
    gone = {i for i, rule in zip(worded, rules) if rule}
    lost = sum(len(word.decode("utf-8")) for i in gone for word in split[i])
    left = [line for i, line in enumerate(lines) if i not in gone]
    with_words, removed, seen = len(worded), len(gone), {lines[i] for i in worded}
    repeats = repeated_words(words)
    failed = len(words) < MIN_WORDS or 100 * repeats > MAX_REPEAT_PERCENT * len(words)
    kept = not failed and lost <= MAX_LOSS * word_chars
    cleaned = b"\n".join(left).decode("utf-8") if removed else text
    return (len(words), word_chars, symbols, with_words - len(seen), repeats, failed, kept,
            with_words, removed, lost, cleaned)


FIGURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, n_lines long, n_lines_removed long, n_chars_removed long, clean_text string"
)


def judge_all(texts: list[str | None]) -> list:
    return list(zip(*map(judge, texts))) or [[]] * len(T._parse_datatype_string(FIGURES))


def judge_documents(docs: DataFrame, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """`docs` with the figures, the verdict and `clean_text`, the text of the lines that passed."""
    return with_results(docs, text, FIGURES, judge_all, carry)


def keep_good(docs: DataFrame, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """The kept documents with their cleaned text; the columns of `docs`, in their order.

    `n_chars`, where it stands in the input, becomes the length of the cleaned text.
    """
    names = docs.columns
    own = f"c{names.index(text)}"
    frame = numbered(docs)
    judged = with_results(frame, own, FIGURES, judge_all, [c for c in frame.columns if c != own]).filter("kept")

    def value(place: int, name: str):
        if name == text:
            return F.col("clean_text")
        if name == n_chars:
            return F.length("clean_text").cast(docs.schema[name].dataType)
        return F.col(f"c{place}")

    return judged.select(*(value(i, c).alias(c) for i, c in enumerate(names)))
