import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from earshot.llm import langid
from tests.conftest import SF_DIR
from tests.llm.tables import DOCUMENTS, LONG, documents, with_clashes


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet").withColumn("out", langid.held_out())


@pytest.fixture(scope="module")
def model(corpus):
    return langid.fit(corpus.filter("not out"))


def test_held_out_accuracy(corpus, model):
    rows = langid.predict(corpus.filter("out").drop("source"), model).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.98 * len(rows) > 200
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_small_sample_is_enough(corpus):
    small = langid.fit(corpus.filter("not out"), sample=200, words=500, grams=500)
    assert len(small.words) <= 4 * 500 and len(small.grams) <= 4 * 4 * 500
    rows = langid.predict(corpus.filter("out"), small).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.95 * len(rows)


def test_every_language_is_learned_from_a_sample(spark):
    """Rows 3,000 to 1: 20 rows of the small language, and one text as a third of the large one."""
    large = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "the mill and the river").otherwise(F.concat(F.lit("the river number "), "id")).alias("text"),
        F.lit("en").alias("lang"))
    few = spark.range(20).select(F.lit("நதி பழைய ஆலை நதி").alias("text"), F.lit("ta").alias("lang"))
    labelled = large.union(few)
    rows = langid.sample_of(labelled, 200).collect()
    own = [(r["text"], r["copies"]) for r in rows if r["lang"] == "ta"]
    assert own == [("நதி பழைய ஆலை நதி", 20)]
    assert 100 < len(rows) < 300 and all(r["copies"] == 1 for r in rows if r["lang"] == "en")
    assert langid.sample_of(labelled.repartition(5), 200).exceptAll(langid.sample_of(labelled, 200)).count() == 0
    learned = langid.fit(labelled, sample=200)
    assert learned.languages == ["en", "ta"]
    (lang, score), = langid.Scorer(learned).judge_all(["பழைய நதி"])
    assert lang == "ta" and score > langid.MIN_SCORE


def test_shares():
    shares = langid.shares_of({"a": 10**7, "b": 10**6, "c": 500, "d": 0}, 20_000)
    assert shares["c"] == shares["d"] == 1
    assert abs(shares["a"] * 10**7 - 9750) < 1 and abs(shares["b"] * 10**6 - 9750) < 1
    many = langid.shares_of({str(i): 1000 for i in range(5000)}, 20_000)
    assert all(share == langid.LEAST / 1000 for share in many.values())


def test_backoff(model):
    scorer = langid.Scorer(model)
    known = next(iter(model.words))
    assert scorer.rows(known) == [model.words[known]]
    unseen = "zzthe"
    assert unseen not in model.words
    length = next(n for n in langid.LENGTHS if any(g in model.grams for g in langid.grams_of(unseen, n)))
    rows = [model.grams[g] for g in langid.grams_of(unseen, length) if g in model.grams]
    assert scorer.rows(unseen) == rows
    assert scorer.rows("日") == []

    def gains(row):
        cells = slice(model.starts[row], model.starts[row + 1])
        return np.bincount(model.places[cells], model.gains[cells], len(model.languages))

    # a piece of several words sums them; a word of n-grams scores their mean
    scorer.learn({f"{known}-{unseen}", "日"})
    total = scorer.sums[scorer[f"{known}-{unseen}"]]
    assert np.allclose(total[:-1], gains(model.words[known]) + np.mean([gains(row) for row in rows], 0))
    assert total[-1] == 2 and not scorer.sums[scorer["日"]].any()


def plain_fit(labelled):
    """Counts of words and n-grams by language, all of them, by plain Python."""
    counts = {}
    for text, lang in labelled:
        for word in langid.words_of(text or ""):
            cut = [(0, word)] + [(n, g) for n in langid.LENGTHS for g in langid.grams_of(word, n)]
            for key in cut:
                own = counts.setdefault(lang, {})
                own[key] = own.get(key, 0) + 1
    return counts


def plain_predict(counts, text):
    languages = sorted(counts)
    kinds = (0, *langid.LENGTHS)
    known = {key for own in counts.values() for key in own}
    entries = {kind: sum(k == kind for k, _ in known) for kind in kinds}
    sizes = {(lang, kind): sum(n for (k, _), n in counts[lang].items() if k == kind) + 0.5 * (1 + entries[kind])
             for lang in languages for kind in kinds}

    def log(lang, key):
        if key in counts[lang]:
            return math.log((counts[lang][key] + 0.5) / sizes[lang, key[0]])
        return min(math.log(0.5 / sizes[other, key[0]]) for other in languages)

    sums, count = dict.fromkeys(languages, 0.0), 0
    words = langid.words_of(text or "")
    for word in words:
        keys = [(0, word)] if (0, word) in known else next(
            (own for n in langid.LENGTHS if (own := [(n, g) for g in langid.grams_of(word, n) if (n, g) in known])), [])
        count += bool(keys)
        for lang in languages if keys else ():
            sums[lang] += sum(log(lang, key) for key in keys) / len(keys)
    if not words:
        return "und", 0.0
    best = max(languages, key=lambda lang: (sums[lang], -languages.index(lang)))
    far = [(sums[lang] - sums[best]) / max(count, 1) * min(count, langid.TRUST) for lang in languages]
    return best, 1 / sum(map(math.exp, far))


def test_equals_plain_python(spark, corpus, monkeypatch):
    """Fit and prediction by a second implementation, with words seen once and texts cut in steps."""
    rows = [(r["text"], r["lang"]) for r in corpus.orderBy("doc_id").limit(60).select("text", "lang").collect()]
    rows += [("ein einziger kurzer Satz", "once"), ("zwei Sätze", "de"), (None, "de"), ("", "en"), ("allein", None)]
    texts = [text for text, _ in rows[::4]] + ["ein kurzer", "unseenword einzig", "日本", "12 !", None]
    learned = langid.fit(spark.createDataFrame(rows, "text string, lang string"))
    counts = plain_fit([row for row in rows if row[1] is not None])
    wanted = [plain_predict(counts, text) for text in texts]
    for values in (langid.VALUES, 40):
        monkeypatch.setattr(langid, "VALUES", values)
        for (lang, score), (own, own_score) in zip(langid.Scorer(learned).judge_all(texts), wanted, strict=True):
            assert lang == own and abs(score - own_score) < 1e-9
    assert wanted[-5][0] == "once" and "einziger" in learned.words


def test_small_language_gains_nothing_from_words_it_has_not_seen(spark):
    large = [(f"the miller number {i} went to town{i} with word{i}x", "en") for i in range(3000)]
    learned = langid.fit(spark.createDataFrame(large + [("eine Mühle am Fluss", "de")], "text string, lang string"))
    found = langid.Scorer(learned).judge_all(["townfold wordplay", "the miller", "eine Mühle", "Fluss"])
    assert [lang for lang, _ in found] == ["en", "en", "de", "de"]


def test_same_with_a_full_memo(model, monkeypatch):
    texts = [" ".join(["the and of", LONG[:5000], "Straße " * 30]), "und der", None, "les la"]
    whole = langid.Scorer(model).judge_all(texts)
    monkeypatch.setattr(langid, "MEMO_ENTRIES", 2)
    small = langid.Scorer(model)
    again = [small.judge_all([text])[0] for text in texts]
    assert [w[0] for w in whole] == [a[0] for a in again]
    assert all(abs(w[1] - a[1]) < 1e-9 for w, a in zip(whole, again))


def test_only_the_text_counts(corpus, model):
    other = corpus.withColumns({"lang": F.lit("xx"), "source": F.lit(None), "doc_id": F.lit(-1)})
    keep = [[(r["lang_pred"], r["score"]) for r in langid.predict(df, model, carry=["text"]).orderBy("text").collect()]
            for df in (corpus, other)]
    assert keep[0] == keep[1]


def test_awkward_rows_and_clashing_names(spark, model):
    docs = with_clashes(documents(spark), ["lang_pred", "score", "entry", "kind"])
    found = {(r["doc_id"], r["text"]): (r["lang_pred"], r["score"]) for r in langid.predict(docs, model).collect()}
    for key in ((3, None), (4, ""), (5, " \n\t\n "), (8, "1234 5678 !!! ---")):
        assert found[key] == ("und", 0.0)
    assert found[6, LONG][0] in model.languages
    kept = langid.keep_identified(docs)
    assert kept.columns == docs.columns
    assert sorted(r[0] for r in kept.select("doc_id").dropna().collect() if r[0] < 6) == [1, 2, 2]


def test_nothing_learned(spark):
    empty = spark.createDataFrame([], DOCUMENTS)
    model = langid.fit(empty)
    assert model.languages == []
    docs = documents(spark)
    assert {r["lang_pred"] for r in langid.predict(docs, model).collect()} == {"und"}
    assert langid.predict(empty, model).count() == 0 and langid.keep_identified(empty).count() == 0
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert langid.keep_identified(unlabelled).count() == 11
