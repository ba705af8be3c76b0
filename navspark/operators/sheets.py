"""Sheets as text, instrument names, prompts and answers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from navspark.functions.text import strip

# Fixed value: the column that holds instrument names, and its repeated header.
INSTRUMENT = "Name of the Instrument"
#: Input cap of the model, in white-space tokens.
MAX_TOKENS = 512


def sheet_text(rows: DataFrame, key: list[str], order: str, columns: list[str], separator: str = "\t", header: bool = True) -> DataFrame:
    """(``key``, text): the column names and the rows of each sheet in order, one line each; null cells are empty. A sheet is one group."""
    shown = [c for c in columns if c != "Unnamed: 0"]
    line = F.concat_ws(separator, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in shown])
    lines = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), line.alias("line"))))
    text = F.transform(lines, lambda x: x["line"])
    text = F.concat(F.array(F.lit(separator.join(shown))), text) if header else text
    return rows.groupBy(*key).agg(F.array_join(text, "\n").alias("text"))


def instrument_names(rows: DataFrame, column: str = INSTRUMENT, dedup_after_strip: bool = False) -> DataFrame:
    """Distinct names without the header literal; duplicates are dropped before white space, unless asked otherwise."""
    if column not in rows.columns:
        raise ValueError(f"The column {column!r} is missing.")
    names = rows.select(F.col(column).alias("name")).dropna()
    names = names.select(strip(F.col("name")).alias("name")).distinct() if dedup_after_strip else names.distinct().select(strip(F.col("name")).alias("name"))
    return names.where(F.col("name") != column)


def first_tokens(text: Column, n: int = MAX_TOKENS) -> Column:
    return F.array_join(F.slice(F.split(text, r"\s+"), 1, n), " ")


def prompt_render(rows: DataFrame, prompt: str, text: str = "text", max_tokens: int = MAX_TOKENS) -> DataFrame:
    """``rows`` with prompt: the instruction, an empty line and the truncated text."""
    return rows.withColumn("prompt", F.concat(F.lit(prompt), F.lit("\n\n"), first_tokens(F.col(text), max_tokens)))


def answer_to_names(rows: DataFrame, key: list[str], answer: str) -> DataFrame:
    """(``key``, name) for each non-empty comma-separated piece."""
    pieces = rows.select(*key, F.explode(F.split(answer, ",")).alias("name"))
    return pieces.select(*key, strip(F.col("name")).alias("name")).where("name != ''")


def batch_infer(rows: DataFrame, key: list[str], prompt: str, make: Callable[[], Callable[[list[str]], list[str]]]) -> DataFrame:
    """(``key``, answer): ``make`` is called once per task for a function from prompts to answers."""
    kept = rows.select(*key, F.col(prompt).alias("prompt"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema if f.name != "prompt") + ", answer string"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        infer = make()
        for frame in frames:
            answers = infer(frame["prompt"].fillna("").tolist())
            yield frame[key].assign(answer=answers)

    return kept.mapInPandas(run, schema)
