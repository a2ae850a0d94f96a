"""Repair and checking of fine-tuning lines, and building them from conversations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.text import is_blank, repair_escapes, strip
from textloom.operators.select import has_both_roles
from textloom.sources.readers import line_text
from textloom.sources.reference_values import ASSISTANT, HUMAN

PREVIEW = 200


def prompt(question: Column) -> Column:
    """Question in the form the model is asked to continue."""
    return F.concat(F.lit(f"{HUMAN} "), question, F.lit(f"\n{ASSISTANT}"))


def repaired_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """Non-blank lines with their repaired text (NULL beyond repair), format check and preview if bad."""
    line = strip(F.col(value))
    text = line_text(repair_escapes(F.col("line")))
    good = F.coalesce(has_both_roles(F.col("text")), F.lit(False))
    shown = F.left(F.coalesce("text", "line"), F.lit(PREVIEW))
    return (
        lines.filter(~is_blank(F.col(value)))
        .withColumn("line", line)
        .withColumn("text", text)
        .withColumn("well_formed", good)
        .withColumn("preview", F.when(~good, shown))
    )


def question_answer_rows(turns: DataFrame) -> DataFrame:
    """One tuning text per user turn that is answered by the next turn.

    The answer is found by an equi-join on conversation and turn, so a very long conversation is spread
    over the partitions like any other rows.
    """
    asked = turns.filter(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("_q"))
    answered = turns.filter(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("_a")
    )
    text = F.concat(prompt(F.col("_q")), F.lit(" "), F.col("_a"))
    return asked.join(answered, ["conv_id", "turn"]).select("conv_id", "turn", text.alias("text"))
