"""H: text functions, and the packers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.functions.arrays import cut_closed, cut_head, frame, pad_to, real_tokens, shifted, until_eos
from textloom.functions.packing import pack_code, pack_paragraphs
from textloom.operators.reports import rounded_history
from textloom.operators.scoring import pair_similarity
from textloom.plans.tuning import prompt, question_answer_rows, repaired_lines
from textloom.queries import query, table, wide_table
from textloom.queries import sqltext as S
from textloom.queries.sources import TUNING_LINES_SQL, history, tuning_lines
from textloom.sources.readers import line_text
from textloom.sources.sinks import json_line

# Decomposed accents, zero-width characters, tabs and runs of line breaks put into every document.
DIRT = [("e", "é"), (". ", ".​ \t \n\n\n\n\n \n"), (", ", ",\t  ")]
DIRTY_SQL = (
    "replace(replace(replace(text, 'e', 'e' || chr(769)), '. ', '.' || chr(8203) || ' ' || chr(9) || ' ' || "
    "repeat(chr(10), 5) || ' ' || chr(10)), ', ', ',' || chr(9) || '  ')"
)


def dirty(text: Column) -> Column:
    for clean, soiled in DIRT:
        text = F.replace(text, F.lit(clean), F.lit(soiled))
    return text


@query("h1_nfc", f"SELECT doc_id, nfc_normalize({DIRTY_SQL}) AS text FROM documents")
def h1(spark, sf):
    return wide_table(spark, sf, "documents").select("doc_id", T.nfc(dirty(F.col("text"))).alias("text"))


@query("h2_clean_prose", f"SELECT doc_id, {S.clean_prose(DIRTY_SQL)} AS text FROM documents")
def h2(spark, sf):
    return wide_table(spark, sf, "documents").select("doc_id", T.clean_prose(dirty(F.col("text"))).alias("text"))


@query("h3_clean_code", f"SELECT doc_id, {S.clean_code(DIRTY_SQL)} AS text FROM documents")
def h3(spark, sf):
    return wide_table(spark, sf, "documents").select("doc_id", T.clean_code(dirty(F.col("text"))).alias("text"))


@query(
    "h4_pack_paragraphs",
    S.prose_of("SELECT doc_id AS k, text AS raw FROM documents")
    + " SELECT k AS doc_id, frag_idx, text FROM packed",
)
def h4(spark, sf):
    pieces = pack_paragraphs(T.clean_prose(F.col("text")))
    return wide_table(spark, sf, "documents").select("doc_id", F.posexplode(pieces).alias("frag_idx", "text"))


@query(
    "h4_pack_broken_paragraphs",
    S.prose_of(f"SELECT doc_id AS k, {DIRTY_SQL} AS raw FROM documents")
    + " SELECT k AS doc_id, frag_idx, text FROM packed",
)
def h4_broken(spark, sf):
    pieces = pack_paragraphs(T.clean_prose(dirty(F.col("text"))))
    return wide_table(spark, sf, "documents").select("doc_id", F.posexplode(pieces).alias("frag_idx", "text"))


@query(
    "h4_pack_mixed_paragraphs",
    S.prose_of(f"SELECT doc_id AS k, replace(text, {S.NL}, {S.NL} || {S.NL}) AS raw FROM documents")
    + " SELECT k AS doc_id, frag_idx, text FROM packed",
)
def h4_mixed(spark, sf):
    text = F.replace("text", F.lit("\n"), F.lit("\n\n"))
    pieces = pack_paragraphs(T.clean_prose(text))
    return wide_table(spark, sf, "documents").select("doc_id", F.posexplode(pieces).alias("frag_idx", "text"))


# One line per tag, and a blank line after each list or paragraph: both cut rules of the packer occur.
LINED_SQL = f"replace(replace(html, '>', '>' || {S.NL}), '</p>', '</p>' || {S.NL})"


def lined(html: Column) -> Column:
    return F.replace(F.replace(html, F.lit(">"), F.lit(">\n")), F.lit("</p>"), F.lit("</p>\n"))


@query(
    "h5_pack_code",
    S.code_of(f"SELECT page_id AS k, '' AS header, {LINED_SQL} AS raw FROM pages")
    + " SELECT k AS page_id, frag_idx, text FROM packed",
)
def h5(spark, sf):
    pieces = pack_code(T.clean_code(lined(F.col("html"))))
    return wide_table(spark, sf, "pages").select("page_id", F.posexplode(pieces).alias("frag_idx", "text"))


@query(
    "h6_sentences",
    f"SELECT doc_id, unnest(str_split(regexp_replace(text, '([.!?]){S.WS}+', '\\1' || chr(1), 'g'), chr(1))) AS sentence "
    "FROM documents",
)
def h6(spark, sf):
    return wide_table(spark, sf, "documents").select("doc_id", F.explode(T.sentences(F.col("text"))).alias("sentence"))


@query(
    "h7_headers",
    f"SELECT page_id, '# Archivo: ' || {S.BASE_NAME} || ' (extension: ' || lower({S.EXTENSION}) || ')' || {S.NL} || {S.NL} AS in_tree, "
    f"'# Repo: ' || str_split(path, '/')[1] || '/' || CAST(page_id AS VARCHAR) || ' | Archivo: ' || {S.BASE_NAME} || {S.NL} || {S.NL} AS in_repo "
    "FROM (SELECT page_id, regexp_replace(regexp_replace(url, '[?#].*$', ''), '^https?://', '') AS path FROM pages)",
)
def h7(spark, sf):
    from textloom.queries.sources import page_path

    path = page_path(F.col("url"))
    name = T.base_name(path)
    return table(spark, sf, "pages").select(
        "page_id",
        T.file_header(name, F.lower(T.extension(path))).alias("in_tree"),
        T.repo_header(F.split(path, "/")[0], F.col("page_id").cast("string"), name).alias("in_repo"),
    )


@query(
    "h8_encode_title",
    "SELECT doc_id, replace(replace(replace(replace(replace(url_encode(title), '%5F', '_'), '%3A', ':'), '%28', '('), "
    "'%29', ')'), '%2F', '/') AS encoded FROM (SELECT doc_id, 'Ñ+ (' || lang || '): ~a*b/' || text AS title FROM documents)",
)
def h8(spark, sf):
    # the same title arrives raw or already encoded; both must give the same result
    title = F.concat(F.lit("Ñ+ ("), "lang", F.lit("): ~a*b/"), "text")
    escaped = F.replace(F.replace(title, F.lit("%"), F.lit("%25")), F.lit(" "), F.lit("%20"))
    return wide_table(spark, sf, "documents").select("doc_id", T.encode_title(escaped).alias("encoded"))


def book_text(text: Column, lang: Column) -> Column:
    """A document between the two lines of a digitised book; the spelling and line ends depend on the language."""
    this = F.when(lang == "fr", "THIS").otherwise("THE")
    book = F.concat(
        F.lit("Producido por voluntarios.\n\n*** START OF "), this, F.lit(" PROJECT GUTENBERG EBOOK X ***\n\n\n"), text,
        F.lit("\n\n*** END OF "), this, F.lit(" PROJECT GUTENBERG EBOOK X ***\n\nLicencia"),
    )
    crlf = F.replace(book, F.lit("\n"), F.lit("\r\n"))
    return F.when(lang == "es", text).when(lang == "de", crlf).otherwise(book)


BOOK_SQL = f"""CASE WHEN lang = 'es' THEN text WHEN lang = 'de' THEN replace(book, {S.NL}, chr(13) || {S.NL}) ELSE book END"""
BOOK_ROWS_SQL = f"""SELECT doc_id, lang, text, 'Producido por voluntarios.' || {S.NL} || {S.NL} || '*** START OF ' || this ||
    ' PROJECT GUTENBERG EBOOK X ***' || repeat({S.NL}, 3) || text || {S.NL} || {S.NL} || '*** END OF ' || this ||
    ' PROJECT GUTENBERG EBOOK X ***' || {S.NL} || {S.NL} || 'Licencia' AS book
    FROM (SELECT doc_id, lang, text, CASE WHEN lang = 'fr' THEN 'THIS' ELSE 'THE' END AS this FROM documents)"""
BODY_SQL = f"""
    WITH books AS (SELECT doc_id, {BOOK_SQL} AS t FROM ({BOOK_ROWS_SQL})),
    started AS (SELECT doc_id, t, CASE WHEN strpos(t, '*** START OF THE PROJECT GUTENBERG EBOOK') > 0
        THEN strpos(t, '*** START OF THE PROJECT GUTENBERG EBOOK')
        ELSE strpos(t, '*** START OF THIS PROJECT GUTENBERG EBOOK') END AS s FROM books),
    cut AS (SELECT doc_id, CASE WHEN s > 0 AND strpos(substr(t, s), {S.NL} || {S.NL}) > 0
        THEN {S.strip(f"substr(t, s + strpos(substr(t, s), {S.NL} || {S.NL}) - 1)")} ELSE t END AS t FROM started),
    ended AS (SELECT doc_id, t, CASE WHEN strpos(t, '*** END OF THE PROJECT GUTENBERG EBOOK') > 0
        THEN strpos(t, '*** END OF THE PROJECT GUTENBERG EBOOK')
        ELSE strpos(t, '*** END OF THIS PROJECT GUTENBERG EBOOK') END AS e FROM cut),
    bodies AS (SELECT doc_id, CASE WHEN e > 0 THEN {S.strip('left(t, e - 1)')} ELSE t END AS body FROM ended)"""


@query("h9_trim_banner", BODY_SQL + " SELECT doc_id, body FROM bodies")
def h9(spark, sf):
    return wide_table(spark, sf, "documents").select(
        "doc_id", T.trim_banner(book_text(F.col("text"), F.col("lang"))).alias("body")
    )


@query(
    "s2_books",
    BODY_SQL
    + f", src AS (SELECT CAST(doc_id AS VARCHAR) AS k, {S.clean_prose('body')} AS t FROM bodies),"
    + S.packed_prose("src")
    + " SELECT 'gutenberg' AS source, k AS doc_key, frag_idx, text FROM packed",
)
def s2(spark, sf):
    from textloom.sources.readers import book_fragments

    # two landed copies per book: the first is empty unless the text is German, so the second often wins
    copies = wide_table(spark, sf, "documents").select(
        F.col("doc_id").alias("book_id"), book_text(F.col("text"), F.col("lang")).alias("text"), "lang"
    )
    first = copies.select("book_id", F.lit(0).alias("url_rank"), F.when(F.col("lang") == "de", F.col("text")).otherwise("").alias("text"))
    second = copies.select("book_id", F.lit(1).alias("url_rank"), "text")
    return book_fragments(first.unionByName(second))


@query(
    "h10_extension",
    f"SELECT page_id, {S.BASE_NAME} AS name, {S.EXTENSION} AS ext, {S.PARENT} AS folder FROM "
    "(SELECT page_id, regexp_replace(regexp_replace(url, '[?#].*$', ''), '^https?://', '') AS path FROM pages)",
)
def h10(spark, sf):
    from textloom.queries.sources import page_path

    path = page_path(F.col("url"))
    return table(spark, sf, "pages").select(
        "page_id", T.base_name(path).alias("name"), T.extension(path).alias("ext"), T.parent_path(path).alias("folder")
    )


@query(
    "h11_repair_escapes",
    f"WITH lines AS ({TUNING_LINES_SQL}) SELECT id, regexp_replace(value, '\\\\([<>!])', '\\1', 'g') AS repaired, "
    "json_extract_string(TRY_CAST(regexp_replace(value, '\\\\([<>!])', '\\1', 'g') AS JSON), '$.text') AS text FROM lines",
)
def h11(spark, sf):
    repaired = T.repair_escapes(F.col("value"))
    return tuning_lines(spark, sf).select("id", repaired.alias("repaired"), line_text(repaired).alias("text"))


@query(
    "h12_json_line",
    "SELECT doc_id, text, json_extract_string(to_json(struct_pack(text := text)), '$.text') AS parsed FROM documents",
)
def h12(spark, sf):
    return wide_table(spark, sf, "documents").select("doc_id", "text", line_text(json_line("text")).alias("parsed"))


@query(
    "h13_preview",
    f"""WITH lines AS ({TUNING_LINES_SQL}),
    parsed AS (SELECT id, {S.strip('value')} AS line,
        json_extract_string(TRY_CAST(regexp_replace({S.strip('value')}, '\\\\([<>!])', '\\1', 'g') AS JSON), '$.text') AS text
        FROM lines WHERE {S.strip('value')} <> '')
    SELECT id, left(coalesce(text, line), 200) AS preview FROM parsed
    WHERE NOT coalesce(contains(text, '<human>:') AND contains(text, '<assistant>:'), false)""",
)
def h13(spark, sf):
    return repaired_lines(tuning_lines(spark, sf)).filter(~F.col("well_formed")).select("id", "preview")


@query("h14_title_words", "SELECT doc_id, replace(lower(replace(text, ' ', '_')), '_', ' ') AS words FROM documents")
def h14(spark, sf):
    return wide_table(spark, sf, "documents").select(
        "doc_id", T.title_words(F.replace("text", F.lit(" "), F.lit("_"))).alias("words")
    )


@query(
    "h15_prompt",
    f"SELECT conv_id, turn, '<human>: ' || text || {S.NL} || '<assistant>:' AS prompt FROM conversations WHERE role = 'user'",
)
def h15(spark, sf):
    asked = table(spark, sf, "conversations").filter("role = 'user'")
    return asked.select("conv_id", "turn", prompt(F.col("text")).alias("prompt"))


@query(
    "h15_question_answer",
    f"""SELECT q.conv_id, q.turn, '<human>: ' || q.text || {S.NL} || '<assistant>: ' || a.text AS text
    FROM conversations q JOIN conversations a ON a.conv_id = q.conv_id AND a.turn = q.turn + 1
    WHERE q.role = 'user' AND a.role = 'assistant'""",
)
def h15_pairs(spark, sf):
    return question_answer_rows(table(spark, sf, "conversations"))


# Token ids stand-in that both sides can compute: the length of every space-separated word.
IDS_SQL = "list_transform(str_split(text, ' '), lambda w: length(w))"


def word_lengths(text: Column) -> Column:
    return F.transform(F.split(text, " "), F.length)


def listed(ids: Column) -> Column:
    return F.array_join(ids.cast("array<string>"), ",")


@query("h16_frame", f"SELECT doc_id, array_to_string(list_concat([2], {IDS_SQL}, [3]), ',') AS ids FROM documents")
def h16(spark, sf):
    return wide_table(spark, sf, "documents").select("doc_id", listed(frame(word_lengths(F.col("text")))).alias("ids"))


@query(
    "h17_truncate",
    f"SELECT doc_id, array_to_string(f[1:65], ',') AS head, "
    "array_to_string(CASE WHEN len(f) > 65 THEN list_concat(f[1:64], [3]) ELSE f END, ',') AS closed "
    f"FROM (SELECT doc_id, list_concat([2], {IDS_SQL}, [3]) AS f FROM documents)",
)
def h17(spark, sf):
    framed = wide_table(spark, sf, "documents").select("doc_id", frame(word_lengths(F.col("text"))).alias("f"))
    return framed.select(
        "doc_id", listed(cut_head(F.col("f"), 64)).alias("head"), listed(cut_closed(F.col("f"), 64)).alias("closed")
    )


@query(
    "h18_pad",
    "SELECT doc_id, array_to_string(list_concat(f[1:513], list_transform(range(greatest(0, 513 - len(f))), lambda x: 0)), ',') AS ids "
    f"FROM (SELECT doc_id, list_concat([2], {IDS_SQL}, [3]) AS f FROM documents)",
)
def h18(spark, sf):
    framed = wide_table(spark, sf, "documents").select("doc_id", frame(word_lengths(F.col("text"))).alias("f"))
    return framed.select("doc_id", listed(pad_to(cut_head(F.col("f"), 512), 513)).alias("ids"))


@query(
    "h19_shift",
    "SELECT doc_id, array_to_string(p[1:512], ',') AS input, array_to_string(p[2:513], ',') AS target FROM ("
    "SELECT doc_id, list_concat(f[1:513], list_transform(range(greatest(0, 513 - len(f))), lambda x: 0)) AS p "
    f"FROM (SELECT doc_id, list_concat([2], {IDS_SQL}, [3]) AS f FROM documents))",
)
def h19(spark, sf):
    framed = wide_table(spark, sf, "documents").select("doc_id", frame(word_lengths(F.col("text"))).alias("f"))
    padded = framed.select("doc_id", pad_to(cut_head(F.col("f"), 512), 513).alias("p"))
    source, target = shifted(F.col("p"), 512)
    return padded.select("doc_id", listed(source).alias("input"), listed(target).alias("target"))


@query(
    "h20_until_eos",
    "SELECT doc_id, array_to_string(CASE WHEN list_position(ids, 3) > 0 THEN ids[1:list_position(ids, 3) - 1] ELSE ids END, ',') AS ids "
    f"FROM (SELECT doc_id, {IDS_SQL} AS ids FROM documents)",
)
def h20(spark, sf):
    return wide_table(spark, sf, "documents").select("doc_id", listed(until_eos(word_lengths(F.col("text")))).alias("ids"))


@query(
    "h21_mask_padding",
    "SELECT doc_id, CAST(len(list_filter(p, lambda x: x <> 0)) AS BIGINT) AS real_tokens, "
    "round(len(list_filter(p, lambda x: x <> 0)) / 513.0, 6) AS fill FROM ("
    "SELECT doc_id, list_concat(f[1:513], list_transform(range(greatest(0, 513 - len(f))), lambda x: 0)) AS p "
    f"FROM (SELECT doc_id, list_concat([2], {IDS_SQL}, [3]) AS f FROM documents))",
)
def h21(spark, sf):
    framed = wide_table(spark, sf, "documents").select("doc_id", frame(word_lengths(F.col("text"))).alias("f"))
    real = real_tokens(pad_to(cut_head(F.col("f"), 512), 513))
    return framed.select("doc_id", real.cast("long").alias("real_tokens"), F.round(real / F.lit(513.0), 6).alias("fill"))


@query(
    "h22_cosine",
    "SELECT a.vec_id AS left_id, b.vec_id AS right_id, "
    "round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS similarity "
    "FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1",
)
def h22(spark, sf):
    vectors = table(spark, sf, "embeddings")
    neighbours = vectors.select(F.col("vec_id").alias("left_id"), (F.col("vec_id") + 1).alias("right_id"))
    return pair_similarity(vectors, "vec_id", "embedding", neighbours).withColumn(
        "similarity", F.round("similarity", 6)
    )


HISTORY_SQL = """SELECT CAST(day(ts) AS INTEGER) AS epoch, avg(value) / 10 AS train_loss,
    avg(value) / 10 + sqrt(max(value)) / 100 AS val_loss, exp(least(avg(value) / 10 + sqrt(max(value)) / 100, 20)) AS val_ppl,
    sqrt(max(value)) AS duration_s FROM events GROUP BY 1"""


@query(
    "h23_rounded_history",
    f"SELECT epoch, round_even(train_loss, 4) AS train_loss, round_even(val_loss, 4) AS val_loss, "
    f"round_even(val_ppl, 2) AS val_ppl, round_even(duration_s, 1) AS duration_s FROM ({HISTORY_SQL})",
)
def h23(spark, sf):
    return rounded_history(history(table(spark, sf, "events")))


