"""Small tables with everything an operator has to bear."""

from pyspark.sql import functions as F

PROSE = "The old river runs past the quiet mill and on into the wide green valley below the hills, where few people go."
LONG = " ".join(f"word{i % 977}" for i in range(60_000)) + "."

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"

ROWS = [
    (1, PROSE, "en", "a", len(PROSE)),
    (2, PROSE, "en", None, None),
    (2, PROSE, "en", None, None),
    (3, None, None, None, None),
    (None, PROSE + " And more of it.", "en", "b", 1),
    (None, None, None, None, None),
    (4, "", "en", "b", 0),
    (5, " \n\t\n ", None, "b", 5),
    (6, LONG, "en", "c", len(LONG)),
    (7, "née Σ日本 <|im_end|> <|endoftext|> \x1c  🙂\r\nx", "fr", "c", 3),
    (8, "1234 5678 !!! ---", "xx", "c", 3),
]


def documents(spark, rows=ROWS):
    return spark.createDataFrame(rows, DOCUMENTS)


def with_clashes(df, names):
    """The table with more columns, named as the operator's own."""
    return df.withColumns({name: F.lit(f"own {name}") for name in names})


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
