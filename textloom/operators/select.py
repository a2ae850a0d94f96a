"""Row filters, lookups and label rules. Every predicate is a Column, so it can be pushed to the scan."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.arrays import MIN_TOKENS, SPECIAL_TOKENS, UNK
from textloom.functions.text import base_name, extension, parent_path, strip, title_words
from textloom.sources import reference_values as ref


def long_enough_raw(text: Column, min_chars: int = 40) -> Column:
    """Length of the text as given; dialogues give the raw text, subtitles the stripped one."""
    return F.length(text) >= min_chars


def worth_caching(text: Column) -> Column:
    """Fragments of 50 characters or fewer are not stored."""
    return F.length(strip(text)) > 50


def line_breaks(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))


def plausible_code(content: Column) -> Column:
    """More than 50 and fewer than 100,000 characters, with at least 5 line breaks."""
    size = F.length(content)
    return (size > 50) & (size < 100_000) & (line_breaks(content) >= 5)


def substantial(content: Column, min_chars: int = 100) -> Column:
    return F.length(strip(content)) >= min_chars


def _contains_any(text: Column, terms: list[str]) -> Column:
    """Plain substring tests: compiled with the rest of the stage, and faster than one long pattern."""
    return reduce(or_, [F.contains(text, F.lit(t)) for t in terms])


def code_extension(path: Column) -> Column:
    return F.lower(extension(path)).isin(ref.CODE_EXTENSIONS)


def wanted_directory(path: Column) -> Column:
    """The substring rule runs over the whole directory path, so `layout/` is skipped for its `out`."""
    folder = F.replace(F.lower(parent_path(path)), F.lit("\\"), F.lit("/"))
    return ~_contains_any(folder, ref.SKIPPED_DIRECTORIES)


def wanted_name(path: Column) -> Column:
    return ~_contains_any(base_name(path), ref.SKIPPED_NAMES)


def wanted_entry(path: Column, size: Column, max_bytes: int = ref.MAX_ENTRY_BYTES) -> Column:
    """Archive entries: bounded size, a code extension, and no skipped folder in the path."""
    return (
        (size <= max_bytes)
        & code_extension(path)
        & ~_contains_any(F.lower(path), ref.SKIPPED_ENTRIES)
    )


def enough_tokens(framed_ids: Column) -> Column:
    return F.size(framed_ids) >= MIN_TOKENS


def has_both_roles(text: Column) -> Column:
    return text.contains(ref.HUMAN) & text.contains(ref.ASSISTANT)


def topic(title: Column) -> Column:
    """First category, in priority order, one of whose keywords occurs in the title.

    The keyword table is small and fixed, so it becomes part of the expression instead of a join.
    """
    words = title_words(title)
    named = [F.when(_contains_any(words, keys), F.lit(name)) for name, keys in ref.TOPICS.items()]
    return F.coalesce(*named, F.lit(ref.OTHER_TOPIC))


def pending(catalogue: DataFrame, ledger: DataFrame, keys: list[str], dedupe: bool = False) -> DataFrame:
    """Catalogue rows whose key is not in the ledger; duplicates on the left survive unless `dedupe`."""
    rest = catalogue.join(ledger.select(*keys), keys, "left_anti")
    return rest.dropDuplicates(keys) if dedupe else rest


def branch_candidates(branch: Column) -> Column:
    """Branch names to try for a repository, in order."""
    return (
        F.when(branch == "main", F.array(F.lit("main"), F.lit("master")))
        .when(branch == "master", F.array(F.lit("master"), F.lit("main")))
        .otherwise(F.array(branch, F.lit("main"), F.lit("master")))
    )


def first_success(candidates: DataFrame, key: str, rank: str, ok: Column, keep: list[str]) -> DataFrame:
    """For each key the columns `keep` of the lowest-ranked candidate that succeeded.

    `min_by` combines on the map side, so a key with very many candidates does not gather them. It skips
    NULL ranks, which keeps `ok` out of a filter: a pushed-down filter would compute it a second time.
    """
    best = F.min_by(F.struct(rank, *keep), F.when(ok, F.col(rank))).alias("_best")
    return candidates.groupBy(key).agg(best).filter("_best IS NOT NULL").select(key, "_best.*")


def token_ids(tokens: DataFrame, vocabulary: DataFrame, token: str = "token") -> DataFrame:
    """Attach `id` to every token; an unknown token gets the unknown id."""
    table = vocabulary.select(F.col("token").alias(token), "id")
    return tokens.join(table, token, "left").withColumn("id", F.coalesce("id", F.lit(UNK)))


def special_token_check(vocabulary: DataFrame, tokens: list[str] | None = None) -> DataFrame:
    """Expected against actual id of the reserved tokens; a missing one has the actual id -1."""
    names = tokens if tokens is not None else SPECIAL_TOKENS
    expected = vocabulary.sparkSession.createDataFrame(
        list(enumerate(names)), "expected_id int, token string"
    )
    return (
        expected.join(vocabulary.filter(F.col("token").isin(names)), "token", "left")
        .select("token", "expected_id", F.coalesce("id", F.lit(-1)).alias("actual_id"))
        .withColumn("ok", F.col("expected_id") == F.col("actual_id"))
    )


def require_same_size(left: DataFrame, right: DataFrame, what: str = "vocabulary") -> DataFrame:
    """One row with the common row count; the query fails when the counts differ."""
    both = left.agg(F.count("*").alias("n")).withColumn("side", F.lit("left")).unionByName(
        right.agg(F.count("*").alias("n")).withColumn("side", F.lit("right"))
    )
    sizes = both.agg(
        F.max(F.when(F.col("side") == "left", F.col("n"))).alias("left_size"),
        F.max(F.when(F.col("side") == "right", F.col("n"))).alias("right_size"),
    )
    message = F.concat(
        F.lit(f"{what} sizes differ: "), F.col("left_size"), F.lit(" and "), F.col("right_size")
    )
    return sizes.select(
        F.when(F.col("left_size") == F.col("right_size"), F.col("left_size"))
        .otherwise(F.raise_error(message).cast("long"))
        .alias("size")
    )


