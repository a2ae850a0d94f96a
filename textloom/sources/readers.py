"""Readers for landed payloads. Each has a step on a DataFrame, so other storage can feed the same step."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from textloom.functions.packing import code_blocks, pack_code, pack_paragraphs
from textloom.functions.text import (
    base_name,
    clean_code,
    clean_prose,
    extension,
    file_header,
    parent_path,
    repo_header,
    strip,
    trim_banner,
)
from textloom.operators import select
from textloom.operators.mix import sample_per_group
from textloom.session import materialised, path_exists, qualified
from textloom.sources import reference_values as ref
from textloom.sources.archives import EntryReader, archive_list

FRAGMENT_SCHEMA = "source string, doc_key string, frag_idx int, text string"


@F.pandas_udf(StringType())
def _decode_dropping(raw: pd.Series) -> pd.Series:
    return raw.map(lambda b: bytes(b).decode("utf-8", errors="ignore"), na_action="ignore")


def decoded(content: Column) -> Column:
    """UTF-8 text of a binary column; bytes that are not UTF-8 are dropped.

    Only invalid contents travel to Python. The UDF is declared nondeterministic so that its result is not
    inlined into the expressions built on it.
    """
    text = content.cast("string")
    invalid = F.when(~F.is_valid_utf8(text), content)
    return F.coalesce(_decode_dropping.asNondeterministic()(invalid), text)


def fragments(df: DataFrame, source: Column | str, key: Column, pieces: Column) -> DataFrame:
    """One row per fragment with the keys that stand in for the order of a file."""
    name = F.lit(source) if isinstance(source, str) else source
    return df.select(
        name.alias("source"), key.cast("string").alias("doc_key"), F.posexplode(pieces).alias("frag_idx", "text")
    )


def landed_paths(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Paths of the files below a folder; their contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
    return files.load(path).select("path")


# --- encyclopedia payloads -------------------------------------------------------------------------

PAYLOAD_SCHEMA = "query struct<pages: map<string, struct<extract: string>>>"


def article_text(payload: Column) -> Column:
    """Text of the first page of a payload; NULL for a missing page or a blank or absent extract."""
    page = F.get(F.map_entries(F.from_json(payload, PAYLOAD_SCHEMA)["query"]["pages"]), F.lit(0))
    extract = page["value"]["extract"]
    return F.when((page["key"] != "-1") & (strip(extract) != ""), extract)


def read_payloads(spark: SparkSession, path: str | list[str]) -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", decoded(F.col("content")).alias("payload"))


def article_fragments(payloads: DataFrame, key: str, payload: str = "payload") -> DataFrame:
    # a NULL text explodes to no row; a filter on it would parse every payload twice
    texts = payloads.withColumn("_text", article_text(F.col(payload)))
    return fragments(texts, "wikipedia", F.col(key), pack_paragraphs(clean_prose(F.col("_text"))))


# --- books -----------------------------------------------------------------------------------------


def book_number(path: Column) -> Column:
    """Number at the start of a file's name, NULL if there is none."""
    return F.regexp_extract(base_name(path), r"^(\d+)", 1).try_cast("int")


def read_books(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Whole text files named `<book id>-<rank>.txt`, one row per landed copy of a book."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    name = base_name(F.col("path"))
    return files.select(
        book_number(F.col("path")).alias("book_id"),
        F.regexp_extract(name, r"^\d+-(\d+)", 1).try_cast("int").alias("url_rank"),
        decoded(F.col("content")).alias("text"),
    )


def book_fragments(books: DataFrame) -> DataFrame:
    """Fragments of the first copy of each book that yields any."""
    bodies = books.select("book_id", "url_rank", trim_banner(F.col("text")).alias("body"))
    packed = bodies.withColumn("pieces", pack_paragraphs(clean_prose(F.col("body")))).drop("body")
    best = select.first_success(packed, "book_id", "url_rank", F.size("pieces") > 0, ["pieces"])
    return fragments(best, "gutenberg", F.col("book_id"), F.col("pieces"))


# --- source trees ----------------------------------------------------------------------------------


def _any_case(ext: str) -> str:
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in ext)


def _wanted_path(root: str | None) -> Column:
    path = F.col("path")
    in_tree = select.wanted_directory(path)
    if root is not None:  # the directory rule is for directories below the root
        in_tree = in_tree | (parent_path(path) == root)
    return select.code_extension(path) & select.wanted_name(path) & in_tree


def tree_glob() -> str:
    """Name pattern of the files of a source tree."""
    return f"*{{{','.join(_any_case(e) for e in ref.CODE_EXTENSIONS)}}}"


def below(spark: SparkSession, root: str, path: Column) -> Column:
    """A listed path without its root."""
    return F.substring(path, F.lit(len(qualified(spark, root)) + 2), F.length(path))


def read_code_tree(spark: SparkSession, root: str, judge_root: bool = True, paths: list[str] | None = None) -> DataFrame:
    """Wanted files below `root`, or those of them in `paths`. The extension is checked while listing, the path before the text is decoded.

    The directory rule looks at whole paths, so a root such as `/tmp/x` rules out all of its directories;
    without `judge_root` it looks at paths relative to the root.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", tree_glob())
        .load(root if paths is None else paths)
    )
    base = qualified(spark, root)
    if not judge_root:
        files = files.withColumn("path", below(spark, root, F.col("path")))
    # files are read in text mode: every kind of line end counts as one line feed
    text = F.regexp_replace(decoded(F.col("content")), "\r\n?", "\n")
    return files.filter(_wanted_path(base if judge_root else "")).select(
        "path", F.col("length").alias("size"), text.alias("content")
    )


def code_tree_files(files: DataFrame, root: str | None = None) -> DataFrame:
    """Files worth packing. Path rules come first, so that they run before the content is looked at."""
    return files.filter(_wanted_path(root)).filter(select.plausible_code(F.col("content")))


def code_tree_fragments(files: DataFrame) -> DataFrame:
    """Fragments of a source tree. Files with the same path are numbered together: by block, then by text."""
    path = F.col("path")
    header = file_header(base_name(path), F.lower(extension(path)))
    blocks = files.select(path.alias("doc_key"), F.inline(code_blocks(F.concat(header, clean_code(F.col("content"))))))
    number = F.row_number().over(W.partitionBy("doc_key").orderBy("at", "text"))
    return blocks.select(F.lit("codigo_local").alias("source"), "doc_key", (number - 1).alias("frag_idx"), "text")


# --- repository archives ---------------------------------------------------------------------------


def read_archives(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Landed zip archives, not opened yet: `owner`, `repo`, `branch` and `file`.

    They are named `<owner>__<repo>.zip` or, for a certain branch, `<owner>__<repo>@<branch>.zip`. Everything behind
    the first `__` is the repository's name. Without a branch in the name `branch` is NULL.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.zip")
        .load(path)
    )
    return files.select(*archive_name(F.col("path")), F.col("path").alias("file"))


def archive_name(path: Column) -> list[Column]:
    """Owner, repository and branch in the name of an archive's file."""
    stem = F.regexp_extract(base_name(path), r"^(.*)\.zip$", 1)
    parts = F.split(stem, "__", 2)
    named = F.get(parts, F.lit(1))
    return [
        F.get(parts, F.lit(0)).alias("owner"),
        F.split(named, "@", 2)[0].alias("repo"),
        F.get(F.split(named, "@", 2), F.lit(1)).alias("branch"),
    ]


INDEX_SCHEMA = "owner string, repo string, branch string, file string, path string, size long, at long, packed long"


def archive_index(archives: DataFrame) -> DataFrame:
    """The archives' own lists of files, one row per entry with its place; a damaged archive gives none.

    The executors read the lists from the ends of the files, so a large archive costs no more than its list.
    """

    def listed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows: list[tuple] = []
        for frame in frames:
            for row in frame.itertuples(index=False):
                for entry in archive_list(row.file):
                    rows.append((row.owner, row.repo, row.branch, row.file, *entry))
                    if len(rows) == INDEX_ROWS:  # many archives with few entries, or part of a large one
                        yield pd.DataFrame(rows, columns=INDEX_COLUMNS)
                        rows = []
        yield pd.DataFrame(rows, columns=INDEX_COLUMNS)

    return archives.select("owner", "repo", "branch", "file").mapInPandas(listed, INDEX_SCHEMA)


#: Entries that a task passes on at a time.
INDEX_ROWS = 10_000
INDEX_COLUMNS = ["owner", "repo", "branch", "file", "path", "size", "at", "packed"]


def first_branches(index: DataFrame, branch: str = "main", any_branch: bool = False, branches: DataFrame | None = None) -> DataFrame:
    """Entries of one archive per repository: of the branches to try, the first whose archive can be read.

    An archive without a branch in its name comes first. `branches` (`owner`, `repo`, `branch`) names the branch
    of a repository, others have `branch`. With `any_branch` archives on other branches come last, by name;
    without it they are not read. Of several files on one branch the first by path is taken.
    """
    tried, wanted = index.select("owner", "repo", "branch", "file").distinct(), F.lit(branch)
    if branches is not None:
        named = branches.groupBy("owner", "repo").agg(F.min("branch").alias("_wanted"))
        tried, wanted = tried.join(named, ["owner", "repo"], "left"), F.coalesce("_wanted", wanted)
    rank = F.coalesce(F.array_position(select.branch_candidates(wanted), F.col("branch")), F.lit(0))
    other = F.col("branch").isNotNull() & (rank == 0)
    order = F.struct(other.alias("other"), F.when(F.col("branch").isNull(), 0).otherwise(rank).alias("rank"), "branch", "file")
    tried = tried.withColumn("_try", order)
    keyed = (tried if any_branch else tried.filter(~F.col("_try.other"))).withColumn("_key", F.struct("owner", "repo"))
    best = select.first_success(keyed, "_key", "_try", F.lit(True), ["file"]).select("file")
    return index.join(best, "file", "left_semi")


def chosen_entries(index: DataFrame, per_repo: int | None = None, max_bytes: int = ref.MAX_ENTRY_BYTES, seed: int = ref.SEED) -> DataFrame:
    """Entries of an index that size, extension and path admit; with `per_repo`, so many of them picked by hash."""
    wanted = index.filter(select.wanted_entry(F.col("path"), F.col("size"), max_bytes))
    return wanted if per_repo is None else sample_per_group(wanted, ["owner", "repo"], ["path"], per_repo, seed)


def unpacked(entries: DataFrame) -> DataFrame:
    """`owner, repo, path, size, content` of the entries of an index; a damaged entry is left out alone.

    Tasks get ranges of entries of about `RANGE_BYTES`, in the order of their files, whatever the sizes of the
    archives are, and go from entry to entry by seeking. `entries` is read more than once: a stored table.
    """
    total = entries.agg(F.sum(F.col("packed") + 1)).first()[0] or 0
    ranges = max(entries.sparkSession.sparkContext.defaultParallelism, 1 + total // RANGE_BYTES)

    def unpack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files = EntryReader()
        for frame in frames:
            rows = []
            for row in frame.itertuples(index=False):
                raw = files.read(row.file, row.at, row.packed, row.size)
                if raw is not None:
                    rows.append((row.owner, row.repo, row.path, row.size, raw.decode("utf-8", errors="ignore")))
            yield pd.DataFrame(rows, columns=["owner", "repo", "path", "size", "content"])
        files.close()

    placed = entries.repartitionByRange(ranges, "file", "at").sortWithinPartitions("file", "at")
    return placed.mapInPandas(unpack, "owner string, repo string, path string, size long, content string")


#: Compressed bytes that a task unpacks.
RANGE_BYTES = 64 << 20


def archive_entries(
    archives: DataFrame,
    per_repo: int | None = None,
    max_bytes: int = ref.MAX_ENTRY_BYTES,
    branch: str = "main",
    seed: int = ref.SEED,
    any_branch: bool = False,
    branches: DataFrame | None = None,
) -> DataFrame:
    """One row per chosen file of each repository: `owner, repo, path, size, content`.

    `archives` comes from `read_archives`. The archives' lists are read once and stored; size, extension and path are
    judged on them. Only chosen entries are unpacked, each from its own place, so no archive is read whole or held
    in a row. A damaged archive gives no rows. `first_branches` chooses a repository's archive.
    """
    index = first_branches(materialised(archive_index(archives), "archive-index"), branch, any_branch, branches)
    return unpacked(materialised(chosen_entries(index, per_repo, max_bytes, seed), "archive-entries"))


def archive_fragments(entries: DataFrame) -> DataFrame:
    header = repo_header(F.col("owner"), F.col("repo"), base_name(F.col("path")))
    kept = entries.filter(select.substantial(F.col("content")))
    key = F.concat_ws("/", "owner", "repo", "path")
    return fragments(kept, "codigo_github", key, pack_code(F.concat(header, clean_code(F.col("content")))))


# --- parallel text ---------------------------------------------------------------------------------


def spanish_side(translation: Column, text: Column) -> Column:
    """Spanish text of a pair, or the plain text of a row without a pair; a pair without Spanish is empty."""
    return F.when(translation.isNotNull(), F.coalesce(translation["es"], F.lit(""))).otherwise(text)


def dialogue_fragments(pairs: DataFrame, key: str) -> DataFrame:
    """Every line of 40 characters or more (measured before cleaning) is one fragment."""
    text = spanish_side(F.col("translation"), F.col("text"))
    kept = pairs.withColumn("_t", text).filter(select.long_enough_raw(F.col("_t")))
    return fragments(kept, "dialogos_naturales", F.col(key), F.array(clean_prose(F.col("_t"))))


def subtitle_fragments(pairs: DataFrame, key: str) -> DataFrame:
    """Every line of 40 stripped characters or more that survives cleaning is one fragment."""
    stripped = strip(F.coalesce(F.col("translation")["es"], F.lit("")))
    kept = pairs.withColumn("_t", stripped).filter(select.long_enough_raw(F.col("_t")))
    # the second condition is applied inside the array, so that the cleaning runs once
    pieces = F.filter(F.array(clean_prose(F.col("_t"))), lambda cleaned: cleaned != "")
    return fragments(kept, "opensubtitles_es", F.col(key), pieces)


# --- line files, catalogues and ledgers ------------------------------------------------------------


STRICT_JSON = {"mode": "PERMISSIVE", "allowSingleQuotes": "false"}


def line_text(line: Column) -> Column:
    """`text` of a JSON object on one line; NULL when the line does not parse or has no such key.

    The line is read as the only element of an array, so that anything after the object is an error.
    """
    alone = F.from_json(
        F.concat(F.lit("["), line, F.lit("]")), "array<struct<text: string>>", STRICT_JSON
    )
    return F.when(F.size(alone) == 1, F.get(alone, F.lit(0))["text"])


def read_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a JSONL file with their text, NULL where the line is to be skipped."""
    return spark.read.text(path).select("value", line_text(F.col("value")).alias("text"))


def read_catalogue(spark: SparkSession, path: str, schema: str, limit: int | None = None) -> DataFrame:
    """A catalogue table (JSON lines with an `ordinal`), or its first `limit` entries."""
    table = spark.read.schema(f"ordinal long, {schema}").json(path)
    return head(table, limit)


def head(catalogue: DataFrame, limit: int | None = None) -> DataFrame:
    """First entries by the stored ordinal: a filter, so it is pushed to the scan."""
    return catalogue if limit is None else catalogue.filter(F.col("ordinal") < limit)


def ledger_keys(contents: DataFrame, value: str = "value") -> DataFrame:
    """Distinct keys of JSON-array ledgers; an empty or corrupt one has none."""
    keys = F.from_json(F.col(value), "array<string>", {"mode": "PERMISSIVE"})
    return contents.select(F.explode(keys).alias("key")).filter("key IS NOT NULL").distinct()


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Keys already done; a missing ledger has none."""
    if path_exists(spark, path):
        return ledger_keys(spark.read.text(path, wholetext=True))
    return spark.createDataFrame([], "key string")


def cache_present(spark: SparkSession, path: str) -> bool:
    """Whether a stored line file exists and is not empty."""
    if not path_exists(spark, path):
        return False
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return not files.filter("length > 0").select("path").isEmpty()
