"""S, K, F: readers, sinks and filters, fed with payloads that Spark derives from the given tables."""

from __future__ import annotations

import io
import uuid
import zipfile
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.operators import select
from textloom.plans.sources import store_sources
from textloom.plans.tuning import repaired_lines
from textloom.queries import query, table, wide_table
from textloom.queries import sqltext as S
from textloom.session import shared_folder, text_batches
from textloom.sources import readers, sinks
from textloom.sources import reference_values as ref
from textloom.sources.archives import write_file
from textloom.sources.store import FragmentStore


def page_path(url: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""), "^https?://", "")


PAGE_FILES_SQL = f"""SELECT page_id, regexp_replace(regexp_replace(url, '[?#].*$', ''), '^https?://', '') AS path,
    replace(html, '>', '>' || {S.NL}) AS content FROM pages"""


def page_files(spark, sf) -> DataFrame:
    """Pages as files of a source tree, one line per tag."""
    return wide_table(spark, sf, "pages").select(
        "page_id", page_path(F.col("url")).alias("path"), F.replace("html", F.lit(">"), F.lit(">\n")).alias("content")
    )


def history(events: DataFrame) -> DataFrame:
    """One row of run metrics per day of events."""
    loss = F.avg("value") / 10
    held_out = loss + F.sqrt(F.max("value")) / 100
    return events.groupBy(F.dayofmonth("ts").alias("epoch")).agg(
        loss.alias("train_loss"),
        held_out.alias("val_loss"),
        F.exp(F.least(held_out, F.lit(20.0))).alias("val_ppl"),
        F.sqrt(F.max("value")).alias("duration_s"),
    )


# --- S -----------------------------------------------------------------------------------------------

ARTICLES_SQL = f"""SELECT doc_id, CASE WHEN lang = 'es' OR source = 'src1' THEN NULL
    WHEN {S.strip('text')} = '' THEN NULL ELSE text END AS text FROM documents"""


def payloads(spark, sf) -> DataFrame:
    """Each document as the payload of an article: Spanish ones as a missing page, those of one source blank."""
    extract = F.struct(F.when(F.col("source") == "src1", F.lit(" \n ")).otherwise(F.col("text")).alias("extract"))
    page = F.when(F.col("lang") == "es", F.lit("-1")).otherwise(F.col("doc_id").cast("string"))
    pages = F.struct(F.create_map(page, extract).alias("pages"))
    return wide_table(spark, sf, "documents").select("doc_id", F.to_json(F.struct(pages.alias("query"))).alias("payload"))


@query("s1_article_payload", f"SELECT doc_id, text FROM ({ARTICLES_SQL}) WHERE text IS NOT NULL")
def s1(spark, sf):
    text = readers.article_text(F.col("payload"))
    return payloads(spark, sf).select("doc_id", text.alias("text")).filter("text IS NOT NULL")


@query(
    "s1_article_fragments",
    S.prose_of(f"SELECT CAST(doc_id AS VARCHAR) AS k, text AS raw FROM ({ARTICLES_SQL}) WHERE text IS NOT NULL")
    + " SELECT 'wikipedia' AS source, k AS doc_key, frag_idx, text FROM packed",
)
def s1_fragments(spark, sf):
    return readers.article_fragments(payloads(spark, sf), "doc_id")


WANTED_TREE_SQL = (
    f"{S.isin(f'lower({S.EXTENSION})', ref.CODE_EXTENSIONS)} AND NOT {S.any_of(S.BASE_NAME, ref.SKIPPED_NAMES)} "
    f"AND NOT {S.any_of(f'lower({S.PARENT})', ref.SKIPPED_DIRECTORIES)}"
)
PLAUSIBLE_SQL = (
    "length(content) > 50 AND length(content) < 100000 "
    f"AND length(content) - length(replace(content, {S.NL}, '')) >= 5"
)


@query(
    "s3_code_tree",
    S.code_of(
        f"SELECT path AS k, '# Archivo: ' || {S.BASE_NAME} || ' (extension: ' || lower({S.EXTENSION}) || ')' || {S.NL} || {S.NL} AS header, "
        f"content AS raw FROM ({PAGE_FILES_SQL}) WHERE {WANTED_TREE_SQL} AND {PLAUSIBLE_SQL}"
    )
    + " SELECT 'codigo_local' AS source, k AS doc_key, frag_idx, text FROM packed",
)
def s3(spark, sf):
    return readers.code_tree_fragments(readers.code_tree_files(page_files(spark, sf).select("path", "content")))


def land_archives(files: DataFrame, folder: str) -> None:
    """One archive per file, with a folder entry and the file itself, written by the executors below `folder`."""

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                buffer = io.BytesIO()
                with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
                    archive.writestr(zipfile.ZipInfo("src.py/"), "")
                    archive.writestr(row.path, row.content)
                write_file(f"{folder}/{row.owner}__{row.repo}.zip", buffer.getvalue())
            yield pd.DataFrame({"n": [len(frame)]})

    written = files.select("owner", "repo", "path", "content").mapInPandas(pack, "n long")
    written.agg(F.sum("n")).collect()


ENTRIES_SQL = f"""SELECT split_part(path, '/', 1) AS owner, CAST(page_id AS VARCHAR) AS repo, path,
    CAST(octet_length(encode(content)) AS BIGINT) AS size, content FROM ({PAGE_FILES_SQL})
    WHERE octet_length(encode(content)) <= 200000
    AND {S.isin(f'lower({S.EXTENSION})', ref.CODE_EXTENSIONS)} AND NOT {S.any_of('lower(path)', ref.SKIPPED_ENTRIES)}"""


def page_archives(spark, sf) -> DataFrame:
    files = page_files(spark, sf).withColumns(
        {"owner": F.split("path", "/")[0], "repo": F.col("page_id").cast("string")}
    )
    folder = new_path(spark, "archives")
    land_archives(files, folder)
    return readers.read_archives(spark, folder)


@query("s4_archive_entries", f"SELECT * FROM ({ENTRIES_SQL})")
def s4(spark, sf):
    return readers.archive_entries(page_archives(spark, sf))


@query(
    "s4_archive_fragments",
    S.code_of(
        f"SELECT owner || '/' || repo || '/' || path AS k, '# Repo: ' || owner || '/' || repo || ' | Archivo: ' || {S.BASE_NAME} "
        f"|| {S.NL} || {S.NL} AS header, content AS raw FROM ({ENTRIES_SQL}) WHERE length({S.strip('content')}) >= 100"
    )
    + " SELECT 'codigo_github' AS source, k AS doc_key, frag_idx, text FROM packed",
)
def s4_fragments(spark, sf):
    return readers.archive_fragments(readers.archive_entries(page_archives(spark, sf)))


# Pairs from documents: English rows carry no Spanish side, French ones no pair at all, German ones nothing.
PAIRS_SQL = """SELECT doc_id, lang, CASE WHEN lang = 'es' OR source = 'src2' THEN text WHEN lang = 'en' THEN ''
    WHEN lang = 'fr' THEN text END AS spanish FROM documents"""


def pairs(spark, sf) -> DataFrame:
    lang, text = F.col("lang"), F.col("text")
    paired = (
        F.when((lang == "es") | (F.col("source") == "src2"), F.create_map(F.lit("es"), text, F.lit("en"), text))
        .when(lang == "en", F.create_map(F.lit("en"), text))
    )
    return wide_table(spark, sf, "documents").select(
        "doc_id", paired.alias("translation"), F.when(lang == "fr", text).alias("text")
    )


@query("s5_parallel_text", f"SELECT doc_id, spanish FROM ({PAIRS_SQL}) WHERE spanish IS NOT NULL")
def s5(spark, sf):
    side = readers.spanish_side(F.col("translation"), F.col("text"))
    return pairs(spark, sf).select("doc_id", side.alias("spanish")).filter("spanish IS NOT NULL")


@query(
    "f1_raw_length",
    f"SELECT 'dialogos_naturales' AS source, CAST(doc_id AS VARCHAR) AS doc_key, 0 AS frag_idx, "
    f"{S.clean_prose('spanish')} AS text FROM ({PAIRS_SQL}) WHERE length(spanish) >= 40",
)
def f1(spark, sf):
    return readers.dialogue_fragments(pairs(spark, sf), "doc_id")


@query(
    "f2_clean_length",
    f"SELECT 'opensubtitles_es' AS source, CAST(doc_id AS VARCHAR) AS doc_key, 0 AS frag_idx, "
    f"{S.clean_prose(S.strip('spanish'))} AS text FROM ({PAIRS_SQL}) "
    f"WHERE (lang IN ('en', 'es') OR lang IS NOT NULL AND doc_id IN (SELECT doc_id FROM documents WHERE source = 'src2')) "
    f"AND length({S.strip('spanish')}) >= 40 AND {S.clean_prose(S.strip('spanish'))} <> ''",
)
def f2(spark, sf):
    return readers.subtitle_fragments(pairs(spark, sf), "doc_id")


# Line files from documents: valid lines, lines cut short, and objects without the key.
LINES_SQL = """SELECT doc_id, CASE WHEN lang = 'de' THEN left(j, length(j) - 1) WHEN lang = 'es' THEN replace(j, '{"text":', '{"body":')
    ELSE j END AS value FROM (SELECT doc_id, lang, CAST(to_json(struct_pack(text := text)) AS VARCHAR) AS j FROM documents)"""


def text_lines(spark, sf) -> DataFrame:
    line, lang = F.col("j"), F.col("lang")
    value = (
        F.when(lang == "de", F.expr("left(j, length(j) - 1)"))
        .when(lang == "es", F.replace(line, F.lit('{"text":'), F.lit('{"body":')))
        .otherwise(line)
    )
    lines = wide_table(spark, sf, "documents").select("doc_id", "lang", sinks.json_line("text").alias("j"))
    return lines.select("doc_id", value.alias("value"))


PARSED_SQL = f"SELECT doc_id, json_extract_string(TRY_CAST(value AS JSON), '$.text') AS text FROM ({LINES_SQL})"


@query("s6_json_lines", PARSED_SQL)
def s6(spark, sf):
    return text_lines(spark, sf).select("doc_id", readers.line_text(F.col("value")).alias("text"))


@query("s7_catalogue_head", "SELECT doc_id AS ordinal, lang || '/' || source AS title FROM documents WHERE doc_id < 372")
def s7(spark, sf):
    catalogue = table(spark, sf, "documents").select(
        F.col("doc_id").alias("ordinal"), F.concat_ws("/", "lang", "source").alias("title")
    )
    return readers.head(catalogue, 372)


@query("s8_ledger_keys", "SELECT DISTINCT CAST(doc_id AS VARCHAR) AS key FROM documents WHERE lang <> 'de'")
def s8(spark, sf):
    """Each document is a ledger with its key twice; the German ones are corrupt."""
    written = F.to_json(F.array(F.col("doc_id"), F.col("doc_id")))
    value = F.when(F.col("lang") == "de", F.substring(written, 1, 2)).otherwise(written)
    return readers.ledger_keys(table(spark, sf, "documents").select(value.alias("value")))


# --- K -----------------------------------------------------------------------------------------------

STORED_SQL = f"SELECT source, CAST(doc_id AS VARCHAR) AS doc_key, text FROM documents WHERE length({S.strip('text')}) > 50"


def new_path(spark, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query("k1_append_fragments", STORED_SQL)
def k1(spark, sf):
    path = new_path(spark, "store")
    docs = table(spark, sf, "documents").select("source", F.col("doc_id").cast("string").alias("doc_key"), "text", "lang")
    for spanish in (True, False):  # two appends
        sinks.append_fragments(docs.filter((F.col("lang") == "es") == spanish).drop("lang"), path)
    return spark.read.parquet(path).select("source", "doc_key", "text")


@query("k2_final_dataset", "SELECT text FROM documents")
def k2(spark, sf):
    path = new_path(spark, "dataset")
    for _ in range(2):  # the second write replaces the first
        sinks.write_dataset(table(spark, sf, "documents"), path)
    return readers.read_jsonl(spark, path).select("text")


@query("k3_ledger", "SELECT DISTINCT source AS key FROM documents")
def k3(spark, sf):
    path = new_path(spark, "ledger")
    docs = table(spark, sf, "documents")
    sinks.write_ledger(docs.filter("lang = 'en'").select(F.col("source").alias("key")), path)
    sinks.write_ledger(docs.select(F.col("source").alias("key")).unionByName(spark.read.parquet(path)), path)
    return spark.read.parquet(path)


@query(
    "k4_corpus_export",
    f"SELECT line, count(*) AS n, (SELECT count(*) FROM documents) AS fragments FROM "
    f"(SELECT unnest(str_split(text, {S.NL})) AS line FROM documents) GROUP BY line",
)
def k4(spark, sf):
    path = new_path(spark, "corpus")
    written = sinks.export_corpus(table(spark, sf, "documents"), path)
    lines = spark.read.option("lineSep", "\n").text(path).groupBy(F.col("value").alias("line"))
    return lines.agg(F.count("*").alias("n")).withColumn("fragments", F.lit(written).cast("long"))


# Fine-tuning lines from conversations: some with bad escapes, some without marks, some cut short, some blank.
TUNING_LINES_SQL = f"""SELECT id, CASE WHEN role = 'system' THEN '  ' WHEN turn = 2 THEN left(j, length(j) - 2)
    WHEN turn = 3 THEN replace(j, '<human>', '<persona>') ELSE replace(replace(j, '<', '\\<'), '.', '.\\!') END AS value
    FROM (SELECT conv_id * 1000 + turn AS id, role, turn, CAST(to_json(struct_pack(text :=
        '<human>: ' || text || {S.NL} || '<assistant>: ' || role)) AS VARCHAR) AS j FROM conversations)"""


def tuning_lines(spark, sf) -> DataFrame:
    line = F.col("j")
    value = (
        F.when(F.col("role") == "system", "  ")
        .when(F.col("turn") == 2, F.expr("left(j, length(j) - 2)"))
        .when(F.col("turn") == 3, F.replace(line, F.lit("<human>"), F.lit("<persona>")))
        .otherwise(F.replace(F.replace(line, F.lit("<"), F.lit("\\<")), F.lit("."), F.lit(".\\!")))
    )
    text = F.concat(F.lit("<human>: "), "text", F.lit("\n<assistant>: "), "role").alias("text")
    turns = table(spark, sf, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "role", "turn", F.to_json(F.struct(text)).alias("j")
    )
    return turns.select("id", value.alias("value"))


TUNING_PARSED_SQL = f"""SELECT id, json_extract_string(TRY_CAST(regexp_replace({S.strip('value')}, '\\\\([<>!])', '\\1', 'g')
    AS JSON), '$.text') AS text FROM ({TUNING_LINES_SQL}) WHERE {S.strip('value')} <> ''"""


@query("k5_rewrite_tuning_file", f"SELECT text FROM ({TUNING_PARSED_SQL}) WHERE text IS NOT NULL")
def k5(spark, sf):
    path = new_path(spark, "tuning")
    tuning_lines(spark, sf).select("value").write.text(path)
    repaired = repaired_lines(spark.read.text(path)).filter("text IS NOT NULL")
    sinks.replace_table(repaired.select("text"), path)
    return readers.read_jsonl(spark, path).select("text")


@query(
    "k6_history_merge",
    """SELECT epoch, round(train_loss, 6) AS train_loss FROM (
        SELECT CAST(day(ts) AS INTEGER) AS epoch, avg(value) / 10 AS train_loss FROM events GROUP BY 1)
    UNION ALL SELECT epoch + 31, round(train_loss, 6) FROM (
        SELECT CAST(day(ts) AS INTEGER) AS epoch, avg(value) / 10 AS train_loss FROM events GROUP BY 1)""",
)
def k6(spark, sf):
    path = new_path(spark, "history")
    epochs = history(table(spark, sf, "events"))
    sinks.append_history(spark, epochs, path)
    sinks.append_history(spark, epochs.withColumn("epoch", F.col("epoch") + 31), path)
    stored = spark.read.schema(sinks.HISTORY_SCHEMA).json(path)
    return stored.select("epoch", F.round("train_loss", 6).alias("train_loss"))


# --- plans ------------------------------------------------------------------------------------------


#: Bytes of a landed part of a book.
PART_BYTES = 16 << 20


def land_books(spark, sf) -> str:
    """One book per source of the documents, its paragraphs in order, as parts in a folder."""
    docs = table(spark, sf, "documents").filter("text IS NOT NULL").select(F.substring("source", 4, 10).alias("book"), "doc_id", "text")
    folder = new_path(spark, "books")
    text_batches(spark)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made, of, held, size = TaskContext.get().partitionId(), 0, None, [], 0
        for batch in batches:
            for book, text in zip(batch.column("book").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if held and (book != of or size >= PART_BYTES):
                    write_file(f"{folder}/{of}-0.{task:06d}{made:06d}.txt", b"".join(held))
                    made, held, size = made + 1, [], 0
                of = book
                held.append(f"{text}\n\n".encode())
                size += len(held[-1])
        if held:
            write_file(f"{folder}/{of}-0.{task:06d}{made:06d}.txt", b"".join(held))
        yield pa.RecordBatch.from_pydict({"n": pa.array([made + bool(held)], pa.int64())})

    # parts are numbered in the order of the ranges, so a book may be spread over as many tasks as it needs
    placed = docs.repartitionByRange("book", "doc_id").sortWithinPartitions("book", "doc_id", "text")
    placed.mapInArrow(write, "n long").agg(F.sum("n")).collect()
    return folder


@query(
    "e1_capped_then_uncapped",
    S.prose_of(
        f"SELECT substr(source, 4) AS k, string_agg(text, {S.NL} || {S.NL} ORDER BY doc_id) AS raw FROM documents GROUP BY source"
    )
    + f" SELECT 'gutenberg' AS source, k AS doc_key, frag_idx, text FROM packed WHERE length({S.strip('text')}) > 50",
)
def e1_capped(spark, sf):
    """A run with a cap, then one without: nothing that the cap left out is lost, and nothing is stored twice."""
    landed, store = {"gutenberg": land_books(spark, sf)}, new_path(spark, "store")
    store_sources(spark, landed, store, caps={"gutenberg": 60})
    for _ in range(2):  # the third run finds nothing new
        store_sources(spark, landed, store)
    return FragmentStore(spark, store).fragments()


# --- F -----------------------------------------------------------------------------------------------


@query(
    "f3_plausible_code",
    f"SELECT page_id, length(content) - length(replace(content, {S.NL}, '')) AS breaks FROM ({PAGE_FILES_SQL}) WHERE {PLAUSIBLE_SQL}",
)
def f3(spark, sf):
    files = page_files(spark, sf).filter(select.plausible_code(F.col("content")))
    return files.select("page_id", select.line_breaks(F.col("content")).cast("long").alias("breaks"))


@query("f4_extension", f"SELECT page_id FROM ({PAGE_FILES_SQL}) WHERE {S.isin(f'lower({S.EXTENSION})', ref.CODE_EXTENSIONS)}")
def f4(spark, sf):
    return page_files(spark, sf).filter(select.code_extension(F.col("path"))).select("page_id")


@query("f5_directory", f"SELECT page_id FROM ({PAGE_FILES_SQL}) WHERE NOT {S.any_of(f'lower({S.PARENT})', ref.SKIPPED_DIRECTORIES)}")
def f5(spark, sf):
    return page_files(spark, sf).filter(select.wanted_directory(F.col("path"))).select("page_id")


@query(
    "f6_file_name",
    f"SELECT page_id FROM (SELECT page_id, regexp_replace(regexp_replace(url, '[?#].*$', ''), '^https?://', '') || "
    "CASE WHEN contains(url, '#') THEN '-lock' WHEN contains(url, 'page=') THEN '.Lock' WHEN contains(url, 'utm') "
    f"THEN '.min.js' ELSE '' END AS path FROM pages) WHERE NOT {S.any_of(S.BASE_NAME, ref.SKIPPED_NAMES)}",
)
def f6(spark, sf):
    url = F.col("url")
    ending = (
        F.when(url.contains("#"), "-lock").when(url.contains("page="), ".Lock").when(url.contains("utm"), ".min.js")
    )
    path = F.concat(page_path(url), F.coalesce(ending, F.lit("")))
    return table(spark, sf, "pages").select("page_id", path.alias("path")).filter(
        select.wanted_name(F.col("path"))
    ).select("page_id")


@query(
    "f7_archive_entry",
    f"SELECT page_id FROM ({PAGE_FILES_SQL}) WHERE octet_length(encode(content)) <= 200000 AND "
    f"{S.isin(f'lower({S.EXTENSION})', ref.CODE_EXTENSIONS)} AND NOT {S.any_of('lower(path)', ref.SKIPPED_ENTRIES)}",
)
def f7(spark, sf):
    size = F.octet_length("content")
    return page_files(spark, sf).filter(select.wanted_entry(F.col("path"), size)).select("page_id")


@query("f8_substantial", f"SELECT doc_id FROM documents WHERE length({S.strip('text')}) >= 100")
def f8(spark, sf):
    return wide_table(spark, sf, "documents").filter(select.substantial(F.col("text"))).select("doc_id")


@query("f9_enough_tokens", "SELECT conv_id, turn FROM conversations WHERE len(str_split(text, ' ')) + 2 >= 8")
def f9(spark, sf):
    from textloom.functions.arrays import frame

    framed = frame(F.transform(F.split("text", " "), F.length))
    return table(spark, sf, "conversations").filter(select.enough_tokens(framed)).select("conv_id", "turn")


@query("f10_blank_lines", f"SELECT id FROM ({TUNING_LINES_SQL}) WHERE {S.strip('value')} <> ''")
def f10(spark, sf):
    return repaired_lines(tuning_lines(spark, sf)).select("id")


@query(
    "f11_format_check",
    f"SELECT id, CAST(coalesce(contains(text, '<human>:') AND contains(text, '<assistant>:'), false) AS INTEGER) AS well_formed FROM ({TUNING_PARSED_SQL})",
)
def f11(spark, sf):
    return repaired_lines(tuning_lines(spark, sf)).select("id", F.col("well_formed").cast("int").alias("well_formed"))

