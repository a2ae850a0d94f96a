"""The six sources, from landed files to stored fragments and the final dataset."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.operators.ranking import ordered_running
from textloom.operators.reports import fragments_per_source
from textloom.operators.select import pending, wanted_entry, worth_caching
from textloom.plans.corpus import mixed_dataset
from textloom.session import materialised
from textloom.sources import readers, sinks
from textloom.sources import reference_values as ref
from textloom.sources.books import landed_book_fragments
from textloom.sources.store import FragmentStore

PAIR_SCHEMA = "id long, translation map<string, string>, text string"
#: Files of the first wave of a source with a cap; every further wave has twice as many.
FIRST_WAVE = 8
#: Files of a wave at most. Their paths are all that the driver lists at a time.
LARGEST_WAVE = 20_000


@dataclass
class Limits:
    """What a user may leave out, and what was left out by it (`oversized`)."""

    per_repo: int | None = None
    max_entry_bytes: int = ref.MAX_ENTRY_BYTES
    branches: DataFrame | None = None
    oversized: int = 0


def articles(spark: SparkSession, paths: list[str]) -> DataFrame:
    return readers.article_fragments(readers.read_payloads(spark, paths), "path")


def books(spark: SparkSession, paths: list[str]) -> DataFrame:
    return landed_book_fragments(spark, paths)


def archives(
    spark: SparkSession, paths: list[str], per_repo: int | None = None, max_bytes: int = ref.MAX_ENTRY_BYTES, branches: DataFrame | None = None
) -> DataFrame:
    return _archives(spark, paths, Limits(per_repo, max_bytes, branches))


def _archives(spark: SparkSession, paths: list[str], limits: Limits) -> DataFrame:
    """Fragments of the archives; counts the entries that are as wanted but for their size."""
    listed = materialised(readers.archive_index(readers.read_archives(spark, paths)), "archive-index")
    index = readers.first_branches(listed, any_branch=True, branches=limits.branches)
    large = (F.col("size") > limits.max_entry_bytes) & wanted_entry(F.col("path"), F.lit(0))
    limits.oversized += index.filter(large).count()
    chosen = readers.chosen_entries(index, limits.per_repo, limits.max_entry_bytes)
    return readers.archive_fragments(readers.unpacked(materialised(chosen, "archive-entries")))


def local_code(spark: SparkSession, path: str, paths: list[str] | None = None) -> DataFrame:
    files = readers.code_tree_files(readers.read_code_tree(spark, path, judge_root=False, paths=paths), root="")
    return readers.code_tree_fragments(files)


def _pairs(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their id; one without an id is known by its content."""
    lines = spark.read.schema(PAIR_SCHEMA).json(path)
    content = F.md5(F.to_json(F.struct("translation", "text")))
    return lines.withColumn("id", F.coalesce(F.col("id").cast("string"), F.concat(F.lit("md5:"), content)))


def dialogues(spark: SparkSession, path: str) -> DataFrame:
    return readers.dialogue_fragments(_pairs(spark, path), "id")


def subtitles(spark: SparkSession, path: str) -> DataFrame:
    return readers.subtitle_fragments(_pairs(spark, path), "id")


@dataclass(frozen=True)
class Files:
    """A source of landed files: which input a file belongs to, and the fragments of some files."""

    glob: str
    key: Callable[[SparkSession, str, Column], Column]
    read: Callable[[SparkSession, str, list[str], Limits], DataFrame]


FILES = {
    "wikipedia": Files("*", lambda spark, root, path: path, lambda spark, root, paths, limits: articles(spark, paths)),
    "gutenberg": Files(
        "*", lambda spark, root, path: readers.book_number(path).cast("string"), lambda spark, root, paths, limits: books(spark, paths)
    ),
    "codigo_local": Files(
        readers.tree_glob(), lambda spark, root, path: readers.below(spark, root, path),
        lambda spark, root, paths, limits: local_code(spark, root, paths),
    ),
    "codigo_github": Files(
        "*.zip", lambda spark, root, path: F.concat_ws("/", *readers.archive_name(path)[:2]),
        lambda spark, root, paths, limits: _archives(spark, paths, limits),
    ),
}
# Sources of many inputs per file: the inputs are known once the lines are read.
LINES = {"dialogos_naturales": dialogues, "opensubtitles_es": subtitles}
SOURCES = ("wikipedia", "gutenberg", "codigo_local", "dialogos_naturales", "opensubtitles_es", "codigo_github")


def _input(source: str) -> Column:
    """The input that a fragment comes from: a repository, or what its key names."""
    key = F.substring_index("doc_key", "/", 2) if source == "codigo_github" else F.col("doc_key")
    return F.coalesce(key, F.lit(""))


@dataclass
class Outcome:
    """Inputs of a source in one run, and rows or entries that a limit left out."""

    source: str
    succeeded: int = 0
    failed: int = 0
    left_out: int = 0
    pending: int = 0
    oversized: int = 0


REPORT_SCHEMA = "source string, succeeded long, failed long, left_out long, pending long, oversized long"


def _store_inputs(store: FragmentStore, outcome: Outcome, tried: DataFrame, found: DataFrame, room: int | None) -> bool:
    """Store the fragments `found` of the inputs `tried` (`key`), in one commit; True if there is room for more.

    Inputs are stored whole and in the order of their keys, until their rows reach `room`; the last one may exceed it.
    Those behind it are not finished and stay pending.
    """
    source = outcome.source
    found = materialised(found.filter(worth_caching(F.col("text"))).withColumn("_input", _input(source)), "found")
    per_input = found.groupBy(F.col("_input").alias("key")).agg(F.count("*").alias("rows"))
    keys = materialised(tried.join(per_input, "key", "left").fillna(0, ["rows"]), "inputs")
    last, more = None, True
    if room is not None:
        running = ordered_running(keys, [], ["key"], "rows", "total")
        end = running.filter(F.col("total") >= room).agg(F.min("key").alias("key")).first()
        last, more = end["key"], end["key"] is None
    done = keys if last is None else keys.filter(F.col("key") <= last)
    rows = found if last is None else found.filter(F.col("_input") <= last)
    run = store.begin()
    store.write(run, source, rows, done)
    store.commit(run)
    counts = keys.withColumn("done", F.lit(True) if last is None else F.col("key") <= last).agg(
        F.expr("count_if(done AND rows > 0) AS good"), F.expr("count_if(done AND rows = 0) AS bad"), F.expr("count_if(NOT done) AS open"),
        F.sum(F.when(~F.col("done"), F.col("rows"))).alias("left_out"),
    ).first()
    outcome.succeeded += counts["good"]
    outcome.failed += counts["bad"]
    outcome.pending += counts["open"]
    outcome.left_out += counts["left_out"] or 0
    return more


def _store_files(spark: SparkSession, store: FragmentStore, outcome: Outcome, landed: str, cap: int | None, limits: Limits) -> None:
    """Waves of inputs in the order of their keys, until no input or no room is left.

    With a cap the waves begin small and double, so little more is read than is kept; a commit per wave.
    """
    source = FILES[outcome.source]
    paths = readers.landed_paths(spark, landed, source.glob)
    files = paths.withColumn("key", F.coalesce(source.key(spark, landed, F.col("path")), F.lit("")))
    new = materialised(pending(files, store.finished(outcome.source), ["key"]), "new-files")
    counted = new.groupBy("key").agg(F.count("*").alias("files"))
    inputs = materialised(ordered_running(counted, [], ["key"], "files", "total"), "inputs")
    total, number = inputs.agg(F.max("total"), F.count("*")).first()
    start, size = 0, LARGEST_WAVE if cap is None else FIRST_WAVE
    room = None if cap is None else cap - store.count(outcome.source)
    more, tried = room is None or room > 0, 0
    while more and start < (total or 0):
        begin = F.col("total") - F.col("files")
        wave = inputs.filter((begin >= start) & (begin < start + size)).select("key")
        listed = [r["path"] for r in new.join(wave, "key", "left_semi").select("path").collect()]
        tried += wave.count()
        if listed:
            more = _store_inputs(store, outcome, wave, source.read(spark, landed, listed, limits), room)
            room = None if cap is None else cap - store.count(outcome.source)
        start, size = start + size, min(2 * size, LARGEST_WAVE)
    outcome.pending += number - tried
    outcome.oversized = limits.oversized


def _store_lines(spark: SparkSession, store: FragmentStore, outcome: Outcome, landed: str, cap: int | None) -> None:
    room = None if cap is None else cap - store.count(outcome.source)
    found = LINES[outcome.source](spark, landed).withColumn("key", _input(outcome.source))
    new = materialised(pending(found, store.finished(outcome.source), ["key"]).drop("key"), "new-lines")
    tried = new.select(_input(outcome.source).alias("key")).distinct()
    if room is not None and room <= 0:
        outcome.pending = tried.count()
    elif not new.isEmpty():
        _store_inputs(store, outcome, tried, new, room)


def store_sources(
    spark: SparkSession,
    landed: dict[str, str],
    store: str,
    caps: dict[str, int] | None = None,
    per_repo: int | None = None,
    max_entry_bytes: int = ref.MAX_ENTRY_BYTES,
    branches: DataFrame | None = None,
) -> DataFrame:
    """Add the new fragments of every landed source to the `FragmentStore` at `store`, with the inputs they came from.

    An input that is stored, or that yielded nothing, is not read again. Rows and their inputs are committed together,
    so a run that is lost at any point is simply repeated. `caps` bounds the rows of a source over all runs (the
    fixed values of `reference_values` are not applied unless given): inputs are taken whole, in the order of their keys,
    until the cap is reached; inputs behind it stay pending for a run with a larger cap or none, and those that no
    wave reached are not read. `branches` (`owner`, `repo`, `branch`) names the branch that is read if several of a
    repository landed together. Archive entries above `max_entry_bytes` are left out.

    Returns per source the inputs that yielded fragments, those that did not, the rows read but left out by the cap, the
    inputs still pending, and the archive entries left out for their size.
    """
    target, outcomes = FragmentStore(spark, store), []
    for source in landed:
        if source not in SOURCES:
            raise ValueError(f"unknown source {source}")
        outcome, cap = Outcome(source), (caps or {}).get(source)
        if source in FILES:
            _store_files(spark, target, outcome, landed[source], cap, Limits(per_repo, max_entry_bytes, branches))
        else:
            _store_lines(spark, target, outcome, landed[source], cap)
        outcomes.append(tuple(vars(outcome).values()))
    return spark.createDataFrame(outcomes, REPORT_SCHEMA)


def build_corpus(
    spark: SparkSession,
    landed: dict[str, str],
    store: str,
    output: str,
    quotas: dict[str, int] | None = None,
    caps: dict[str, int] | None = None,
    per_repo: int | None = None,
    branches: DataFrame | None = None,
    max_entry_bytes: int = ref.MAX_ENTRY_BYTES,
) -> DataFrame:
    """Landed files to the mixed dataset at `output`, with its keys beside it at `<output>-keyed`.

    Returns per source, and in total, the stored fragments with this run's outcome, as `store_sources`; a source whose
    inputs all failed is there with no fragments. Without `quotas` and `caps` everything is kept but archive entries
    above `max_entry_bytes`, which are counted.
    """
    outcome = store_sources(spark, landed, store, caps, per_repo, max_entry_bytes, branches)
    stored = FragmentStore(spark, store).fragments()
    mixed = mixed_dataset(stored, quotas)
    sinks.replace_table(mixed, f"{output}-keyed", "parquet")
    sinks.write_dataset(spark.read.parquet(f"{output}-keyed"), output)
    counts = fragments_per_source(stored).join(outcome, "source", "full_outer")
    return counts.fillna(0, ["fragments"])
