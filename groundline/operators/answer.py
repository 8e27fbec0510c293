"""Answers: an extractive default in column expressions, and a plug for models."""

from collections.abc import Callable, Iterator

import pyarrow as pa

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundline.functions.text import let, strip
from groundline.functions.tokens import tokens
from groundline.operators.prompt import TEMPLATE, prompts

# Generation parameters.
GENERATION = {"temperature": 0.1, "top_p": 0.95, "max_tokens": 1500}

NO_ANSWER = "모르겠습니다."


def sentences(text: Column) -> Column:
    """Non-empty lines, also broken after `.`, `!` or `?` before a space."""
    parts = F.split(F.regexp_replace(text, r"([.!?]) ", "$1\n"), "\n", -1)
    return F.filter(F.transform(parts, strip), lambda s: s != "")


def answer_extractive(retrieved: DataFrame) -> DataFrame:
    """`(qid, answer)`: of the best chunk, the first sentence that shares most tokens with the question."""

    def best(asked: Column) -> Column:
        scored = F.transform(
            sentences(F.get("contents", 0)),
            lambda s, i: F.struct(F.size(F.array_intersect(asked, tokens(s))).alias("shared"), (-i).alias("at"), s.alias("s")),
        )
        return F.array_max(scored)["s"]

    answer = F.coalesce(let(tokens(F.col("query")), best), F.lit(NO_ANSWER))
    return retrieved.select("qid", answer.alias("answer"))


def answer(prompts: DataFrame, load: Callable[[dict], Callable[[list], list]], params: dict | None = None) -> DataFrame:
    """`(qid, answer)` by a model: `load(params)` runs once per task, then maps prompts to answers. A missing prompt has no answer."""
    settings = {**GENERATION, **(params or {})}

    @F.arrow_udf("string")
    def generate(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = load(settings)
        for batch in batches:
            texts = [text for text in batch.to_pylist() if text is not None]
            given = iter(model(texts) if texts else [])
            yield pa.array([next(given) if there else None for there in batch.is_valid().to_pylist()], pa.string())

    return prompts.select("qid", generate("prompt").alias("answer"))


def model_responder(load: Callable[[dict], Callable[[list], list]], params: dict | None = None, template: str = TEMPLATE):
    """What `answer_requests` and `answer_stream` take as `respond`: prompts from the hits, answered by a model."""
    return lambda retrieved: answer(prompts(retrieved, template), load, params)
