"""Language of a text: known words first, then shorter and shorter character n-grams.

Model: per language the log frequency of its frequent words, and of the character
n-grams (lengths 4 to 1, with a mark before and behind the word) of all its words.
A word that is known in any language scores its log frequencies; any other takes
the mean log frequency of its known n-grams of the greatest length that has one.
What a language has not seen scores the least of all languages there, so that a
small language gains nothing from words that it does not know. The tables hold only
what was seen, as the gain over that floor.
A word without any known letter says nothing. The language with the largest mean
over all words of the whole text wins, ties go to the first by name; the score is
its share after a softmax over the means times the words counted (`TRUST` at most).

The model is fitted on a bounded sample: all labelled rows if there are at most
`SAMPLE`, else about as many different texts, dealt evenly over the languages and
chosen by a hash of the text. A small language is learned whole, and no language gets
less than `LEAST` texts. Copies count as often as they stand where a language is
learned whole, else once. The tables hold `WORDS` words and `GRAMS` n-grams a length
and language, also those seen once, so that the model can be sent to every executor at
any size of the corpus. A task scores `VALUES` numbers at a time, whatever the
languages and the length of a text.

Defined results: `und` with score 0 for a null text or one without a letter, and
for all texts where nothing was learned. Repeated rows are judged each on its own.
Columns named as the results are replaced by them. An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from earshot.llm.common import kept_in_stage, numbered, reliable, whole, with_results

# Production parameters.
SAMPLE = 20_000
LEAST = 20
WORDS = 20_000
GRAMS = 10_000
LENGTHS = (4, 3, 2, 1)
SMOOTHING = 0.5
TRUST = 12
MIN_SCORE = 0.5
UNKNOWN = "und"

MARK = "_"
WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
# A worker's memo is emptied between batches beyond so many pieces or bytes of them.
MEMO_ENTRIES = 300_000
MEMO_BYTES = 32 << 20
# Numbers (pieces times languages) that are scored or kept at once.
VALUES = 8 << 20


@dataclass
class Model:
    languages: list[str]
    words: dict[str, int]  # word -> row
    grams: dict[str, int]  # n-gram of any length -> row
    starts: np.ndarray  # the cells of row i are starts[i] to starts[i + 1]
    places: np.ndarray  # the language of each cell
    gains: np.ndarray  # its log frequency above the floor


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def grams_of(word: str, length: int) -> list[str]:
    marked = word if length == 1 else MARK + word + MARK
    return [marked[i : i + length] for i in range(len(marked) - length + 1)]


def cut_grams(length: int) -> Column:
    """The same n-grams of the column `entry`, as an array."""
    own = F.col("entry") if length == 1 else F.concat(F.lit(MARK), "entry", F.lit(MARK))
    starts = F.sequence(F.lit(1), F.length(own) - length + 1)
    grams = F.transform(starts, lambda start: F.substring(own, start, F.lit(length)))
    return F.when(F.length(own) >= length, grams)


def model_of(rows: pa.Table, totals: dict[tuple[str, int], int]) -> Model:
    """The model of counted entries (lang, kind, entry, n) and the sums of all counts by language and kind."""
    languages = sorted({language for language, _ in totals})
    place = {language: i for i, language in enumerate(languages)}
    kinds = rows["kind"].to_numpy()
    langs = np.array([place[language] for language in rows["lang"].to_pylist()], np.int32)
    logs = np.log(rows["n"].to_numpy() + SMOOTHING)
    entry_rows, tables, first = np.zeros(len(kinds), np.int64), [], 0
    for own in (kinds == 0, kinds != 0):
        coded = rows["entry"].combine_chunks().filter(pa.array(own)).dictionary_encode()
        entry_rows[own] = coded.indices.to_numpy() + first
        tables.append({entry: first + i for i, entry in enumerate(coded.dictionary.to_pylist())})
        first += len(coded.dictionary)
    for kind in np.unique(kinds):
        own = kinds == kind
        entries = len(np.unique(entry_rows[own]))
        total = np.array([totals.get((language, int(kind)), 0) for language in languages], float)
        sizes = total + SMOOTHING * (1 + entries)
        logs[own] -= np.log(sizes)[langs[own]] + np.log(SMOOTHING / sizes.max())
    order = np.lexsort([langs, entry_rows])
    starts = np.searchsorted(entry_rows[order], np.arange(first + 1))
    return Model(languages, *tables, starts, langs[order], logs[order])


def shares_of(texts: dict[str, int], sample: int) -> dict[str, float]:
    """The share of each language's texts to learn: what small ones leave of their part goes to the others."""
    shares, left = {}, float(sample)
    for place, (language, n) in enumerate(sorted(texts.items(), key=lambda own: (own[1], own[0]))):
        quota = max(LEAST, left / (len(texts) - place))
        shares[language] = min(1.0, quota / max(1, n))
        left = max(0.0, left - min(quota, n))
    return shares


def sample_of(known: DataFrame, sample: int) -> DataFrame:
    """(lang, text, copies): a sample of the labelled rows with every language in it."""
    if known.count() <= sample:
        return known.filter("text is not null").withColumn("copies", F.lit(1))
    known = known.filter("text is not null").withColumn("hashed", F.xxhash64("text"))
    counted = known.groupBy("lang").agg(F.approx_count_distinct("hashed").alias("n")).collect()
    shares = list(shares_of({r["lang"]: r["n"] for r in counted}, sample).items())
    shared = F.broadcast(known.sparkSession.createDataFrame(shares, "lang string, share double"))
    chosen = known.join(shared, "lang").filter(F.pmod("hashed", F.lit(1 << 31)) < F.col("share") * (1 << 31))
    copies = F.when(F.first("share") < 1, 1).otherwise(F.count("*")).alias("copies")
    return chosen.groupBy("lang", "text").agg(copies)


def fit(
    labelled: DataFrame, text: str = "text", lang: str = "lang", sample: int = SAMPLE,
    words: int = WORDS, grams: int = GRAMS,
) -> Model:
    """Learn from the rows of `labelled` with a text and a language.

    Counting runs on Spark; the tables that come to the driver are bounded by
    `words` and `grams` a language and length.
    """
    known = labelled.select(whole(text).alias("text"), whole(lang).alias("lang")).filter("lang is not null")
    found = reliable(
        with_results(sample_of(known, sample), "text", "entries array<string>",
                     lambda texts: [[words_of(t) for t in texts]], ["lang", "copies"])
        .select("lang", "copies", F.explode("entries").alias("entry"))
        .groupBy("lang", "entry").agg(F.sum("copies").alias("n"))
    )
    by_kind = [found.select("lang", F.lit(0).alias("kind"), "entry", "n")]
    for length in LENGTHS:
        cut = found.select("lang", F.lit(length).alias("kind"), F.explode(cut_grams(length)).alias("entry"), "n")
        by_kind.append(cut.groupBy("lang", "kind", "entry").agg(F.sum("n").alias("n")))
    counted = by_kind[0]
    for frame in by_kind[1:]:
        counted = counted.unionByName(frame)
    counted = reliable(counted)
    totals = {(r["lang"], r["kind"]): r["n"] for r in counted.groupBy("lang", "kind").agg(F.sum("n").alias("n")).collect()}
    order = Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "entry")
    limit = F.when(F.col("kind") == 0, words).otherwise(grams)
    kept = counted.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= limit)
    return model_of(kept.select("lang", "kind", "entry", F.col("n").cast("long").alias("n")).toArrow(), totals)


class Scorer(dict):
    """Piece between white space -> row of `sums`: summed word scores per language, and the words; bounded."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model
        self.languages = len(model.languages)
        self.step = max(1, VALUES // (self.languages + 1))
        self.clear()

    def clear(self) -> None:
        super().clear()
        self.sums, self.bytes = np.empty((0, self.languages + 1)), 0

    def rows(self, word: str) -> list[int]:
        """The table rows whose mean a word scores: its own, or those of its longest known n-grams."""
        row = self.model.words.get(word)
        if row is not None:
            return [row]
        grams = self.model.grams
        for length in LENGTHS:
            rows = [row for gram in grams_of(word, length) if (row := grams.get(gram)) is not None]
            if rows:
                return rows
        return []

    def learn(self, pieces: set[str]) -> None:
        """Score all pieces that are not known yet, together."""
        if len(self) > min(MEMO_ENTRIES, self.step) or self.bytes > MEMO_BYTES:
            self.clear()
        new = list(pieces - self.keys())
        rows, counts, owners = [], [], []
        for place, piece in enumerate(new):
            for word in WORD.findall(piece):
                own = self.rows(word)
                if own:
                    rows += own
                    counts.append(len(own))
                    owners.append(place)
        added = np.zeros((len(new), self.languages + 1))
        if rows:
            model, rows = self.model, np.array(rows)
            sizes = model.starts[rows + 1] - model.starts[rows]
            cells = np.arange(sizes.sum()) + np.repeat(model.starts[rows] - np.cumsum(sizes) + sizes, sizes)
            of = np.repeat(np.repeat(owners, counts), sizes)
            shares = np.repeat(np.repeat(1 / np.array(counts), counts), sizes)
            flat = np.bincount(of * self.languages + model.places[cells], model.gains[cells] * shares,
                               minlength=len(new) * self.languages)
            added[:, :-1] = flat.reshape(len(new), self.languages)
            added[:, -1] = np.bincount(owners, minlength=len(new))
        first = len(self.sums)
        self.sums = np.concatenate([self.sums, added])
        self.update(zip(new, range(first, first + len(new))))
        self.bytes += sum(map(len, new))

    def totals_of(self, texts: list[str | None]) -> np.ndarray:
        """The sums of each text's words per language, and its words; pieces of several texts are learned together."""
        totals = np.zeros((len(texts), self.languages + 1))
        waiting, size = [], 0

        def add() -> None:
            self.learn(set().union(*(part for _, part in waiting)))
            for place, part in waiting:
                totals[place] += self.sums[[self[piece] for piece in part]].sum(0)

        for place, text in enumerate(texts):
            pieces = text.lower().split() if text else []
            for at in range(0, len(pieces), self.step):
                waiting.append((place, pieces[at : at + self.step]))
                size += len(waiting[-1][1])
                if size >= self.step:
                    add()
                    waiting, size = [], 0
        add()
        return totals

    def judge_all(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """(language, score) of each text."""
        languages = self.model.languages
        if not languages:
            return [(UNKNOWN, 0.0)] * len(texts)
        found = []
        for text, total in zip(texts, self.totals_of(texts)):
            count = total[-1]
            if not count and not WORD.search(text or ""):
                found.append((UNKNOWN, 0.0))
                continue
            means = total[:-1] / max(count, 1)
            best = int(np.argmax(means))
            shares = np.exp((means - means[best]) * min(count, TRUST))
            found.append((languages[best], float(1.0 / shares.sum())))
        return found


def predict(
    docs: DataFrame, model: Model, text: str = "text", carry: list[str] | None = None,
    name: str = "lang_pred", score: str = "score",
) -> DataFrame:
    """`docs` with the predicted language and its score, from the text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judge(texts: list[str | None]) -> list:
        return list(zip(*scorer_of(shared).judge_all(texts))) or [[], []]

    return with_results(docs, text, f"`{name}` string, `{score}` double", judge, carry)


def scorer_of(shared) -> Scorer:
    """One scorer per worker, stage and model; a worker unpickles a broadcast value once."""
    model = shared.value
    return kept_in_stage(("scorer", id(model)), lambda: Scorer(model))


def held_out(doc_id: str = "doc_id"):
    """Documents never learned from: crc32 of the id's text modulo 4 is 2."""
    return F.coalesce(F.crc32(whole(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def keep_identified(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", min_score: float = MIN_SCORE,
) -> DataFrame:
    """The documents whose language is found with at least `min_score`; the columns of `docs`.

    Learned from the rows of `docs` that are not held out. Where no row is
    labelled nothing is rejected.
    """
    names = docs.columns
    learned = fit(docs.filter(~held_out(doc_id) & whole(doc_id).isNotNull()), text, lang)
    if not learned.languages:
        return docs
    judged = predict(numbered(docs), learned, f"c{names.index(text)}")
    kept = judged.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score))
    return kept.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(names)))
