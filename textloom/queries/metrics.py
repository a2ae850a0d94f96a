"""A, W9, W10 and O2: corpus reports and run metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.functions.arrays import frame
from textloom.operators import reports, select
from textloom.plans.corpus import prose_fragments
from textloom.plans.tuning import repaired_lines
from textloom.queries import query, table, wide_table
from textloom.queries import sqltext as S
from textloom.queries.mix import TOPIC_SQL
from textloom.queries.sources import (
    PARSED_SQL,
    TUNING_PARSED_SQL,
    history,
    new_path,
    text_lines,
    tuning_lines,
)
from textloom.sources import sinks
from textloom.sources.readers import line_text

PACKED = S.prose_of("SELECT doc_id AS k, text AS raw FROM documents")


@query(
    "a1_fragments_per_source",
    PACKED
    + f" SELECT d.source, count(*) AS fragments FROM packed p JOIN documents d ON d.doc_id = p.k "
    f"WHERE length({S.strip('p.text')}) > 50 GROUP BY ROLLUP (d.source)",
)
def a1(spark, sf):
    return reports.fragments_per_source(prose_fragments(wide_table(spark, sf, "documents")))


@query(
    "a2_outcomes",
    PACKED
    + """ SELECT source, count(*) FILTER (n > 0) AS succeeded, count(*) FILTER (n = 0) AS failed FROM (
        SELECT d.source, d.doc_id, count(p.k) AS n FROM documents d LEFT JOIN packed p ON p.k = d.doc_id GROUP BY ALL)
    GROUP BY source""",
)
def a2(spark, sf):
    from textloom.functions.packing import pack_paragraphs
    from textloom.functions.text import clean_prose

    tried = wide_table(spark, sf, "documents").select(
        "source", "doc_id", F.size(pack_paragraphs(clean_prose(F.col("text")))).alias("n")
    )
    return reports.outcome_counts(tried, "source", "doc_id", F.col("n"))


@query(
    "a3_valid_examples",
    f"SELECT count(*) FILTER (ok) AS valid, count(*) FILTER (NOT ok) AS skipped FROM ("
    f"SELECT coalesce(len(str_split(text, ' ')) + 2 >= 8, false) AS ok FROM ({PARSED_SQL}))",
)
def a3(spark, sf):
    parsed = text_lines(spark, sf).select(line_text(F.col("value")).alias("text"))
    framed = parsed.withColumn("ids", F.when(F.col("text").isNotNull(), frame(F.transform(F.split("text", " "), F.length))))
    return reports.example_counts(framed, select.enough_tokens(F.col("ids")))


@query(
    "a4_tuning_report",
    f"""SELECT count(text) AS processed,
    count(*) FILTER (contains(text, '<human>:') AND contains(text, '<assistant>:')) AS well_formed,
    count(*) FILTER (NOT (contains(text, '<human>:') AND contains(text, '<assistant>:'))) AS malformed,
    count(*) FILTER (text IS NULL) AS unrepairable FROM ({TUNING_PARSED_SQL})""",
)
def a4(spark, sf):
    return reports.tuning_report(repaired_lines(tuning_lines(spark, sf)))


@query(
    "a5_o2_topics",
    f"SELECT {TOPIC_SQL} AS category, count(*) AS n FROM (SELECT replace(lower(text), '_', ' ') AS t FROM ("
    "SELECT unnest(str_split(text, ' ')) AS text FROM documents)) GROUP BY 1 ORDER BY n DESC, category LIMIT 10",
)
def a5(spark, sf):
    titles = wide_table(spark, sf, "documents").select(F.explode(F.split("text", " ")).alias("title"))
    return reports.topic_histogram(titles)




@query(
    "a6_run_summary",
    """SELECT CAST(day(ts) AS INTEGER) AS epoch, round(avg(value / 10), 6) AS mean_loss,
    round(exp(least(avg(value / 10), 20)), 6) AS perplexity,
    round(sum(length(props)) / (epoch_us(max(ts)) - epoch_us(min(ts))) * 1000000, 6) AS tokens_per_s FROM events GROUP BY 1""",
)
def a6(spark, sf):
    steps = table(spark, sf, "events").withColumn("epoch", F.dayofmonth("ts"))
    ts = F.unix_micros(F.col("ts").cast("timestamp"))
    seconds = (F.max(ts) - F.min(ts)) / 1_000_000
    summary = reports.run_summary(steps, ["epoch"], F.col("value") / 10, F.length("props"), seconds)
    return summary.select(
        "epoch", *[F.round(c, 6).alias(c) for c in ("mean_loss", "perplexity", "tokens_per_s")]
    )


@query(
    "a7_mean_of_rank_means",
    """SELECT epoch, round(avg(m), 6) AS loss, count(*) AS ranks FROM (SELECT CAST(day(ts) AS INTEGER) AS epoch, user_id,
    avg(value) AS m FROM events GROUP BY ALL) GROUP BY epoch""",
)
def a7(spark, sf):
    steps = table(spark, sf, "events").withColumn("epoch", F.dayofmonth("ts"))
    return reports.mean_of_rank_means(steps, ["epoch"], "user_id", F.col("value")).withColumn(
        "loss", F.round("loss", 6)
    )


@query("a9_stored_rows", f"SELECT count(*) AS n FROM documents WHERE length({S.strip('text')}) > 50")
def a9(spark, sf):
    path = new_path(spark, "store")
    sinks.append_fragments(table(spark, sf, "documents").select("source", "doc_id", "text"), path)
    return spark.read.parquet(path).agg(F.count("*").alias("n"))


BEST_SQL = """SELECT epoch, avg(value) / 10 + sqrt(max(value)) / 100 AS val_loss FROM (
    SELECT CAST(day(ts) AS INTEGER) AS epoch, value FROM events) GROUP BY epoch"""


@query(
    "w9_running_best",
    f"""SELECT epoch, round(val_loss, 6) AS val_loss, CAST(epoch = max(epoch) OVER () AS INTEGER) AS is_best FROM (
    SELECT epoch, val_loss, min(val_loss) OVER (ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS earlier
    FROM ({BEST_SQL})) WHERE earlier IS NULL OR val_loss < earlier""",
)
def w9(spark, sf):
    best = reports.improvements(history(table(spark, sf, "events")))
    return best.select("epoch", F.round("val_loss", 6).alias("val_loss"), F.col("is_best").cast("int").alias("is_best"))


@query(
    "w10_progress",
    """SELECT user_id, event_id, step, round(total / step, 6) AS running_loss FROM (SELECT user_id, event_id,
    row_number() OVER w AS step, sum(value) OVER (w ROWS UNBOUNDED PRECEDING) AS total FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) WHERE step % 20 = 0""",
)
def w10(spark, sf):
    points = reports.progress_points(table(spark, sf, "events"), "user_id", ["ts", "event_id"], "value", 20)
    return points.select("user_id", "event_id", "step", F.round("running_loss", 6).alias("running_loss"))


