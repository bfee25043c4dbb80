"""The batch refresh: source files to raw, raw to staged, staged to marts.

Every step writes a table and the next one reads it, so plans stay short and a
lost executor costs a task of the current step. Tables are replaced as a whole.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from earshot.operators.filters import FIRST_VALUE, Window
from earshot.operators.quality import enforce, quality_report
from earshot.plans import marts
from earshot.plans.staging import STAGED
from earshot.session import prepare
from earshot.sources import datasets
from earshot.sources.tables import (
    RAW_LAYOUT,
    Version,
    create_database,
    load_raw,
    publish,
    raw_form,
    raw_path,
    read_table,
    refresh_partitions,
    write_table,
    write_version,
)


INGEST_REPORT = "ingest_report"
# Databases of the refresh: what was ingested, and the raw, staged and mart tables.
LAKE, RAW, STAGED_TABLES, MARTS = "lake", "raw", "staged", "marts"
REPORT = (
    "dataset string, total_rows bigint, dated_rows bigint, kept_rows bigint, written_rows bigint, "
    "column_count bigint, column_names string"
)


def ingest(
    spark: SparkSession,
    folders: Mapping[str, str],
    lake: str,
    window: Window = Window(),
    layouts: Sequence[str] | str | None = None,
    files: str = "all",
    prefix: str = "",
) -> dict[str, str]:
    """Read the source folders, keep the window, write the raw lake files.

    `folders` names the folder of each source: music_charts,
    music_charts_historical, podcast_reviews (shows, categories and reviews) and
    podcast_charts. `layouts` and `files` are those of the readers. Returns the
    table written per raw dataset; they are in the database `lake` (after `prefix`),
    whose folders below `lake` have the raw layout.

    What was read, had a date, lay in the window and was written is counted as the
    rows pass, and stored as the table `ingest_report`; an input without a
    date window has no dated and kept rows.
    """
    prepare(spark)
    database = create_database(spark, f"{prefix}{LAKE}", f"{lake.rstrip('/')}/raw")
    seen = {name: Observation(name) for name in RAW_LAYOUT}
    charts, history, reviews, podcasts = (
        folders[k] for k in ("music_charts", "music_charts_historical", "podcast_reviews", "podcast_charts")
    )
    frames = {
        "music_charts": datasets.read_music_charts(spark, charts, window, layouts, files, seen["music_charts"]),
        "music_charts_historical": datasets.read_music_charts_historical(
            spark, history, window, layouts, files, seen["music_charts_historical"]
        ),
        "podcast_shows": datasets.read_podcast_shows(spark, reviews, seen["podcast_shows"]),
        "podcast_reviews": datasets.read_podcast_reviews(
            spark, reviews, window, None if layouts == FIRST_VALUE else layouts, seen["podcast_reviews"]
        ),
        "podcast_charts": datasets.read_podcast_charts(
            spark, podcasts, window, layouts, files, seen["podcast_charts"]
        ),
    }
    written, report = {}, []
    for dataset, frame in frames.items():
        written[dataset] = f"{database}.{dataset}"
        out = Observation(f"{dataset} written")
        form = raw_form(frame)
        counted = form.observe(out, F.count(F.lit(1)).alias("rows"))
        write_table(counted, written[dataset], folder=raw_path(lake, dataset))
        counts = seen[dataset].get
        report.append((
            dataset, counts["total_rows"], counts.get("dated_rows"), counts.get("kept_rows"), out.get["rows"],
            len(form.columns), ",".join(form.columns),
        ))
    write_table(spark.createDataFrame(report, REPORT), f"{database}.{INGEST_REPORT}")
    return written


def load_all(spark: SparkSession, out: str, prefix: str = "") -> dict[str, int]:
    """Load every table of the lake into its raw table; returns the rows of each."""
    raw = create_database(spark, f"{prefix}{RAW}", f"{out}/raw")
    return {name: load_raw(spark, f"{prefix}{LAKE}.{name}", f"{raw}.{name}") for name in STAGED}


def store(
    tables: Mapping[str, DataFrame],
    database: str,
    layouts: Mapping[str, tuple] | None = None,
    check: Callable[[Mapping[str, DataFrame]], None] | None = None,
) -> dict[str, DataFrame]:
    """Write tables that do not depend on each other at the same time, so that
    the last tasks of one do not leave the cluster idle; returns them as stored.

    They replace the current tables together, after all are written and `check`
    has seen them: a write or a check that fails leaves every table as it was.
    """
    layouts = layouts or {}

    def write(name: str) -> Version:
        return write_version(tables[name], f"{database}.{name}", *layouts.get(name, ()))

    with ThreadPoolExecutor(len(tables)) as pool:
        versions = dict(zip(tables, pool.map(write, tables)))
    stored = {name: version.frame for name, version in versions.items()}
    if check:
        check(stored)
    publish(*versions.values())
    return stored


def stage(raw: Mapping[str, DataFrame], out: str, prefix: str = "") -> dict[str, DataFrame]:
    """Write the staged tables, check what was written, then put it in place; returns it."""
    spark = next(iter(raw.values())).sparkSession
    database = create_database(spark, f"{prefix}{STAGED_TABLES}", f"{out}/staged")
    built = {name: model.build(raw[name]) for name, model in STAGED.items()}
    layouts = {name: (model.partition_by, model.cluster_by) for name, model in STAGED.items()}

    def check(staged: Mapping[str, DataFrame]) -> None:
        enforce(*[quality_report(staged[name], name, model.checks) for name, model in STAGED.items()])

    return store(built, database, layouts, check)


def refresh_days(raw: DataFrame, name: str, prefix: str = "") -> DataFrame:
    """Stage rows of some days of one input into its staged table, which is partitioned by day.

    Days that the rows hold are replaced, all others stay as they are. The rows are
    checked before any file is put in place.
    """
    model = STAGED[name]
    if not model.partition_by:
        raise ValueError(f"{name}: not partitioned by day")
    built = model.build(raw)
    enforce(quality_report(built, name, model.checks))
    return refresh_partitions(built, f"{prefix}{STAGED_TABLES}.{name}", model.partition_by, model.cluster_by)


def build_monthly(staged: Mapping[str, DataFrame], database: str) -> dict[str, DataFrame]:
    """The tables that read staged facts; everything after them is small."""
    return store(
        {
            "genre_monthly": marts.genre_monthly(staged["music_charts_historical"]),
            "review_monthly": marts.review_monthly(staged["podcast_reviews"]),
            "chart_monthly": marts.chart_monthly(staged["podcast_charts"]),
            "category_totals": marts.category_totals(staged["podcast_shows"]),
            "music_trends": marts.music_trends(staged["music_charts"]),
        },
        database,
    )


def build_marts(staged: Mapping[str, DataFrame], out: str, prefix: str = "") -> dict[str, DataFrame]:
    """Write the monthly tables and the marts from staged tables; returns them."""
    spark = next(iter(staged.values())).sparkSession
    database = create_database(spark, f"{prefix}{MARTS}", f"{out}/marts")
    tables = build_monthly(staged, database)
    genres, reviews, totals = (tables[t] for t in ("genre_monthly", "review_monthly", "category_totals"))
    pairs = {
        "podcast_trends": marts.podcast_trends(reviews, tables["chart_monthly"], totals),
        "genre_category_matrix": marts.genre_category_matrix(genres, reviews, totals),
    }
    tables |= store(pairs, database)
    timeline = marts.ecosystem_timeline(
        genres, reviews, tables["music_trends"], tables["chart_monthly"], totals)
    return tables | store({"ecosystem_timeline": timeline}, database)


def build_all(spark: SparkSession, out: str, prefix: str = "") -> dict[str, DataFrame]:
    """Tables of the lake to raw tables to marts, in order; returns the mart tables.

    They lie below `out`, in the databases `raw`, `staged` and `marts` (after `prefix`).
    """
    prepare(spark)
    load_all(spark, out, prefix)
    raw = {name: read_table(spark, f"{prefix}{RAW}.{name}") for name in STAGED}
    return build_marts(stage(raw, out, prefix), out, prefix)
