"""Exact dedup: a tree merge of sorted digest runs, in DataFrame operations only.

Rows are dealt to as many runs as a power of `FAN_IN`, whatever their texts are, so equal texts are even over the
runs. A run is sorted by digest and holds every distinct text once. In round `r` the runs whose numbers differ in
digit `r` alone exchange: each entry goes to the run that has the digit of the entry's digest there, and each run
merges the `FAN_IN` sorted pieces it gets. After the last round all entries of a text have met. A text has one entry
per piece, so a text in a third of all rows is no more than `FAN_IN` entries in any merge. Entries are one only if
SHA-256 and length agree, too, at every level. Results go down the way the rows came: to the entries of the first
runs, and from them to the rows of the run.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.scratch import Steps, free_name

_BITS = 3
FAN_IN = 1 << _BITS
#: Rows of a first run that more runs are taken for.
RUN_ROWS = 250_000
_TEXT = ["_digest", "_proof", "_size"]


def _rounds(rows: int, run_rows: int) -> int:
    """Rounds, two at least, such that runs of `run_rows` hold all rows."""
    rounds = 2
    while run_rows * FAN_IN**rounds < rows:
        rounds += 1
    return rounds


def _merge(entries: DataFrame, runs: int, keep: str) -> DataFrame:
    """Entries sent to the partition of their run, and merged there in sorted order."""
    best = (F.max if keep == "largest" else F.min)("_best").alias("_best")
    sorted_run = entries.repartitionById(runs, "_run").sortWithinPartitions("_run", *_TEXT)
    return sorted_run.groupBy("_run", *_TEXT).agg(best, F.sum("_n").alias("_n"))


def _groups(first: DataFrame, runs: int, rounds: int, keep: str) -> DataFrame:
    """`_best` and the number of rows of every distinct text, from the entries of the first runs."""
    entries = first
    for r in range(rounds):
        digit = (FAN_IN - 1) << (_BITS * r)
        stays = F.col("_run").bitwiseAND(F.lit(runs - 1 - digit))
        moved = stays.bitwiseOR(F.col("_digest").bitwiseAND(F.lit(digit)).cast("int"))
        entries = _merge(entries.withColumn("_run", moved), runs, keep)
    return entries


def exact_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    keep: str = "smallest",
    normalise: Callable[[Column], Column] = lambda text: text,
    carry: list[str] | None = None,
    run_rows: int = RUN_ROWS,
) -> DataFrame:
    """`key`, the columns `carry`, `keep_id`, `group_size`, `kept` and `text_sha256` of every row of `docs`.

    Texts are equal if identical after `normalise`, by their 64-bit digest, SHA-256 and length. `keep_id` is the
    `smallest` (or `largest`) key of the rows with the row's text, `group_size` their number, `kept` true in exactly
    one of them, `text_sha256` the digest of the normalised text in lowercase hexadecimal.

    A null text is an empty one. A row with a key goes before rows with a null key; `keep_id` is null only if all
    keys of a group are. Of repeated rows, with the key that stays, one is kept, no matter which. An empty table
    gives no rows, long texts are hashed whole, and columns that are not named here are not read. Carried columns may
    have any name but the four of the result.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is smallest or largest")
    carry = carry or []
    steps = Steps(docs.sparkSession, "exact")
    clean = F.coalesce(normalise(F.col(text)), F.lit(""))
    named = {c: free_name(docs, f"_carried{i}") for i, c in enumerate([key, *carry])}
    read = docs.select(
        *[F.col(c).alias(n) for c, n in named.items()],
        F.monotonically_increasing_id().alias("_row"),
        F.xxhash64(clean).alias("_digest"),
        F.unhex(F.sha2(clean, 256)).alias("_proof"),
        F.octet_length(clean).alias("_size"),
    )
    digests = steps.store(read, "digests")
    rounds = _rounds(digests.count(), run_rows)
    runs = FAN_IN**rounds
    own = F.col(named[key])
    present = own.isNotNull() if keep == "largest" else own.isNull()  # keys go before nulls
    # a row's number is its partition and its place there; both deal the rows evenly
    dealt = (F.col("_row") + F.shiftright("_row", 33)).bitwiseAND(F.lit(runs - 1)).cast("int")
    best = F.struct(present.alias("null"), own.alias("key"), F.col("_row").alias("row"))
    rows = digests.withColumn("_run", dealt)
    entries = rows.select("_run", *_TEXT, best.alias("_best"), F.lit(1).cast("long").alias("_n"))
    first = steps.store(_merge(entries, runs, keep), "first")
    groups = steps.store(_groups(first, runs, rounds, keep).filter("_n > 1").drop("_run"), "groups")
    # only texts that occur twice come back; a text has one entry per run here, and few rows in a run
    found = first.select("_run", *_TEXT).join(groups.hint("merge"), _TEXT)
    found = steps.store(found, "found")
    steps.drop("first", "groups")
    out = rows.join(found.hint("merge"), ["_run", *_TEXT], "left")
    return out.select(
        *[F.col(n).alias(c) for c, n in named.items()],
        F.when(F.col("_n").isNull(), own).otherwise(F.col("_best.key")).alias("keep_id"),
        F.coalesce("_n", F.lit(1)).alias("group_size"),
        F.coalesce(F.col("_best.row") == F.col("_row"), F.lit(True)).alias("kept"),
        F.lower(F.hex("_proof")).alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of `docs`, all columns, one of each text: as `exact_duplicates`, whose options it takes."""
    rest = [c for c in docs.columns if c != key]
    clash = {c: free_name(docs, f"_{c}") for c in rest if c.lower() in ("keep_id", "group_size", "kept", "text_sha256")}
    renamed = docs.withColumnsRenamed(clash)
    found = exact_duplicates(renamed, key, clash.get(text, text), carry=[clash.get(c, c) for c in rest], **options)
    kept = found.filter("kept").select(key, *[clash.get(c, c) for c in rest])
    return kept.withColumnsRenamed({n: c for c, n in clash.items()}).select(*docs.columns)
