"""CSV and JSON file readers with the leniency the pipeline depends on."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from earshot.functions import null_words_to_null


@contextmanager
def required(dataset: str, path: str) -> Iterator[None]:
    """Turn Spark's missing-path error into one that names the dataset."""
    try:
        yield
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"{dataset}: no input at {path}") from error
        raise


def typed(text: Column, dtype: str) -> Column:
    """Text to a declared type, NULL where it does not fit."""
    if dtype == "string":
        return text
    if dtype == "bigint":  # whole numbers may be written as 12.0, 12.7 is none
        number = text.try_cast("double")
        return F.coalesce(text.try_cast("bigint"), F.when(number == F.floor(number), number.try_cast("bigint")))
    return text.try_cast(dtype)


def apply_types(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Give the declared columns their type; other columns stay text."""
    return df.select(*[typed(F.col(f"`{c}`"), types.get(c, "string")).alias(c) for c in df.columns])


def listing(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Files with path and length; reads no content."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", "length")


def first_file(spark: SparkSession, path: str, glob: str, dataset: str) -> str:
    """The first file by name."""
    with required(dataset, path):
        files = listing(spark, path, glob)
    found = files.agg(F.min("path").alias("path")).first()["path"]
    if found is None:
        raise FileNotFoundError(f"{dataset}: no file {glob} in {path}")
    return found


CSV_OPTIONS = {"quote": '"', "escape": '"'}
BROKEN = "__broken"


def csv_header(spark: SparkSession, path: str, dataset: str) -> list[str]:
    """Column names of a file, however many lines they take: its first record, read by one task."""
    names = spark.read.options(header=True, multiLine=True, **CSV_OPTIONS).csv(path).columns
    if not names:
        raise ValueError(f"{dataset}: no header in {path}")
    return names


def whole_records(rows: DataFrame, names: list[str]) -> DataFrame:
    """Rows of the CSV source without its column of broken records.

    The source marks every record whose number of fields is not that of the header. One of
    blanks is none, one with fewer fields has missing ones; one with a quote that is
    never closed, or with more fields, raises.
    """
    text = F.col(BROKEN)
    quotes = F.length(text) - F.length(F.replace(text, F.lit('"'), F.lit("")))
    more = F.from_csv(text, ", ".join(f"c{i} string" for i in range(len(names) + 1)), CSV_OPTIONS)[f"c{len(names)}"]
    # The first column is named, because the source refuses to be asked for broken records alone.
    where = F.concat(F.lit(" in "), F.col("_metadata.file_path"), F.lit(", record "), F.coalesce(f"`{names[0]}`", F.lit("")))
    kept = (
        F.when(text.isNull(), True)
        .when(F.btrim(text, F.lit(" \t\r\n")) == "", False)
        .when(quotes % 2 == 1, F.raise_error(F.concat(F.lit("unbalanced quote"), where)).cast("boolean"))
        .when(more.isNotNull(), F.raise_error(F.concat(F.lit("more fields than the header"), where)).cast("boolean"))
        .otherwise(True)
    )
    return rows.filter(kept).select(*[F.col(f"`{n}`") for n in names])


def read_csv(
    spark: SparkSession,
    path: str,
    types: Mapping[str, str] | None = None,
    dataset: str = "csv",
    files: str = "all",
    spanning: bool = True,
) -> DataFrame:
    """CSV with a header: quoted newlines, doubled quotes, words for missing.

    `path` is a file or a folder; of a folder every *.csv is read (their headers
    must agree), or the first one by name with files="first". Columns are taken by
    header name and get the type declared in `types`; there is no inference pass.
    Lines of a file end as its first line does, and such an end inside quotes is read as a
    newline; lines of blanks are skipped.

    `spanning` says whether quoted fields may hold line ends. Spark's source then reads
    a file in one task, and many files at once; without it, files are read in splits.
    """
    glob = "*" if path.endswith(".csv") else "*.csv"
    first = first_file(spark, path, glob, dataset)
    if files == "first":
        path, glob = first, "*"
    names = csv_header(spark, first, dataset)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, BROKEN]])
    reader = spark.read.schema(schema).options(
        header=True, enforceSchema=False, multiLine=spanning, pathGlobFilter=glob, columnPruning=False,
        columnNameOfCorruptRecord=BROKEN, **CSV_OPTIONS,
    )
    return _clean(whole_records(reader.csv(path), names), types or {})


def csv_head(
    spark: SparkSession, path: str, types: Mapping[str, str] | None = None, dataset: str = "csv"
) -> DataFrame:
    """The first file in file order, for taking a few rows: it is read from its
    beginning by one task, which stops when it has enough."""
    return read_csv(spark, path, types, dataset, files="first")


def _clean(raw: DataFrame, types: Mapping[str, str]) -> DataFrame:
    words = raw.select(*[null_words_to_null(F.col(f"`{c}`")).alias(c) for c in raw.columns])
    return apply_types(words, types)


def is_json_array(spark: SparkSession, path: str) -> bool:
    """True if the text before the first '{' holds '['. Reads one file's head."""
    head = spark.read.option("lineSep", "{").text(path).first()
    return head is not None and head["value"].strip().startswith("[")


def json_reader(spark: SparkSession, path: str) -> DataFrameReader:
    """Spark's source for a JSON array (a file is one task) or for JSON Lines (read in splits)."""
    return spark.read.options(multiLine=is_json_array(spark, path), mode="FAILFAST")


def json_fields(spark: SparkSession, path: str, dataset: str = "json") -> list[str]:
    """Every field that some object has, sorted by name: one pass, of which the merged schema is kept."""
    with required(dataset, path):
        return sorted(json_reader(spark, path).option("primitivesAsString", True).json(path).columns)


def read_json(
    spark: SparkSession,
    path: str,
    types: Mapping[str, str],
    dataset: str = "json",
    fields: Sequence[str] | None = None,
) -> DataFrame:
    """A JSON array or JSON Lines, whichever the file is.

    Fields are read as text and cast, so a number in quotes is still a number. The
    declared fields come first, NULL where they are missing; all other fields that
    some object has follow by name, as text; a list or object is the text that stands in
    the file. `fields` are those of `json_fields`,
    where they are known already. Malformed input raises.
    """
    found = json_fields(spark, path, dataset) if fields is None else fields
    names = [*types, *(name for name in found if name not in types)]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    with required(dataset, path):
        return apply_types(json_reader(spark, path).schema(schema).json(path), types)


def input_profile(df: DataFrame, dataset: str) -> DataFrame:
    """One row: dataset, row count, column count, column names."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(dataset).alias("dataset"),
        "row_count",
        F.lit(len(df.columns)).cast("bigint").alias("column_count"),
        F.lit(",".join(df.columns)).alias("column_names"),
    )
