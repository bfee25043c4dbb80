import random

import pytest

from earshot.llm import quality
from tests.llm.tables import DOCUMENTS, LONG, PROSE, ROWS, documents, rows_of, with_clashes


def plainly(text):
    """Base figures by definition."""
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [line for line in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(8)}
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    duplicates = sum(line in lines[:i] for i, line in enumerate(lines))
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), duplicates, len(covered), failed)


def texts():
    rng = random.Random(3)
    alphabet = ["a", "bb", "é", "日", "#x", "c|", "\n", "\n", " ", "\t", "\x0b", " ", "d."]
    return [None, "", LONG, *("".join(rng.choice(alphabet) + rng.choice(["", " "]) for _ in range(rng.randrange(200)))
                              for _ in range(150))]


def test_base_figures_by_definition():
    for text in texts():
        if text == LONG:
            continue
        assert quality.judge(text)[:6] == plainly(text), text


def test_long_text():
    found = quality.judge(LONG)
    assert found[0] == 60_000 and found[4] == 59_999 and found[5] and not found[6]


@pytest.mark.parametrize("line, rule", [
    ("Home | About | News | Contact", "navigation"),
    ("home about contact", "navigation"),
    ("Home, about, contact, login.", "navigation"),
    ("All rights reserved by the owner of this page.", "boilerplate"),
    ("Please accept cookies to read on with us.", "boilerplate"),
    ("THE!! RIVER!! RUNS!! PAST!! THE!! MILL!!", "punctuation"),
    ("the### river&&& runs*** past### the%%% mill.", "punctuation"),
    ("Three words only", None),
    ("It is.", None),
    ("Copyright 2019 Example Ltd. All rights reserved.", "boilerplate"),
    ("This website uses cookies to improve your experience.", "boilerplate"),
    ("The court found that the terms of service did not bind the widow, who had never read them.", None),
    ("He would click here and there with his tongue to call the dog back from the water.", None),
    ("Licensed under CC BY 4.0.", None),
    (PROSE, None),
])
def test_line_rules(line, rule):
    raw = line.encode()
    assert quality.line_fails(raw, raw.split()) == rule


def test_short_lines_are_judged_by_their_neighbours():
    heading = f"Introduction\n\n{PROSE}\n    return x\n2 large eggs\n{PROSE}x"
    assert quality.judge(heading)[8] == 0 and quality.judge(heading)[-1] == heading
    menu = ["Our shop", "New arrivals", "", "Shoes", "Opening hours today"]
    listed = "\n".join([PROSE, *menu, PROSE + "x", "Jo Marsh"])
    judged = quality.judge(listed)
    assert judged[8] == 4 and judged[-1] == f"{PROSE}\n\n{PROSE}x\nJo Marsh"
    ended = listed.replace("Shoes", "Shoes.")
    assert quality.judge(ended)[8] == 0
    assert quality.judge("\n".join(menu * 8))[8] == 32


def test_short_lines_as_in_sql(tmp_path):
    """The SQL twin on texts of many short lines, phrases and marks."""
    import duckdb

    from earshot.llm.queries import ORACLE

    rng = random.Random(5)
    pieces = ["Shoes", "Our shop", "It is.", "", " ", PROSE, HINDI, "All rights reserved.", "one two three four", "home",
              "See the privacy policy of the mill, which nobody has read in a hundred years.", "a | b | c | d", "x### y!!!"]
    rows = [(i, "\n".join(rng.choice(pieces) for _ in range(rng.randrange(14)))) for i in range(300)]
    session = duckdb.connect()
    session.execute("create table documents (doc_id bigint, text varchar)")
    session.executemany("insert into documents values (?, ?)", rows)
    found = session.execute(f"select doc_id, n_lines, n_lines_removed, n_chars_removed, kept from ({ORACLE['op1_quality_rules']})")
    judged = [(i, *(quality.judge(t)[k] for k in (7, 8, 9, 6))) for i, t in rows]
    assert sorted(found.fetchall()) == judged and sum(r[2] for r in judged) > 300


HINDI = "नदी के किनारे पुरानी चक्की के पास लोग हर शाम बैठकर अपने बचपन की कहानियाँ सुनाते हैं और धीरे धीरे घर लौट जाते हैं।"
TAMIL = "பழைய ஆற்றின் கரையில் உள்ள ஆலையின் அருகில் மக்கள் ஒவ்வொரு மாலையும் அமர்ந்து கதைகள் சொல்லி மெதுவாக வீடு திரும்புகிறார்கள்."
ARABIC = "ذَهَبَ الوَلَدُ إِلَى المَدْرَسَةِ فِي الصَّبَاحِ وَقَرَأَ كِتَابًا جَمِيلًا عَنِ البَحْرِ ثُمَّ عَادَ إِلَى بَيْتِهِ."


@pytest.mark.parametrize("line", [HINDI, TAMIL, ARABIC])
def test_combining_characters_are_parts_of_words(line):
    text = "\n".join(line.replace(" ", f" {i} ", 1) for i in range(4))
    judged = quality.judge(text)
    assert quality.line_fails(line.encode(), line.encode().split()) is None
    assert judged[8] == judged[9] == 0 and judged[-1] == text
    noisy = line.replace(" ", "!! ")
    assert quality.line_fails(noisy.encode(), noisy.encode().split()) == "punctuation"


def test_document_is_rejected_for_what_it_lost():
    junk = "Start | About | Contact | Imprint | Events | Tickets | Matters"
    other = "Nobody remembers who built it or when, but the wheel still turns in spring."
    some, most = f"{PROSE}\n{junk}\n\n{other}", f"{PROSE}\n" + "\n".join([junk.replace("t", f"t{i}") for i in range(4)])
    assert quality.judge(some)[6] and quality.judge(some)[-1] == f"{PROSE}\n\n{other}"
    assert not quality.judge(most)[5] and not quality.judge(most)[6]


def test_awkward_rows_and_clashing_names(spark):
    docs = with_clashes(documents(spark), ["kept", "n_words", "clean_text", "c0", "c1"])
    judged = quality.judge_documents(docs)
    assert judged.columns.count("kept") == 1 and "source" in judged.columns
    verdicts = {(r["doc_id"], r["text"]): r["kept"] for r in judged.collect()}
    assert verdicts[1, PROSE] and verdicts[None, PROSE + " And more of it."]
    assert not any(kept for (_, text), kept in verdicts.items() if text is None or len(text) < 40 or text == LONG)
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert rows_of(kept, "doc_id", "n_chars", "kept") == sorted(
        [(1, len(PROSE), "own kept"), (2, len(PROSE), "own kept"), (2, len(PROSE), "own kept"),
         (None, len(PROSE) + 16, "own kept")], key=repr)


def test_empty_table(spark):
    empty = spark.createDataFrame([], DOCUMENTS)
    assert quality.judge_documents(empty).count() == 0
    assert quality.keep_good(empty).count() == 0 and len(ROWS) == 11
