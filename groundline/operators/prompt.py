"""Prompts: context from hits, templates, and conversation history."""

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The prompt template.
TEMPLATE = """당신은 IT 소프트웨어(Software; SW) 인력 수요를 조사하는 연구원 입니다. 국내 SW인력 수요와 관련하여 산업에서 SW인력에게 원하는 역할과 요구사항을 답변하고 있습니다. 질문이 이러한 주제 중 하나와 관련이 없는 경우에는 답변을 거부해 주세요. 답을 모른다면 모른다고만 말하고 답을 지어내려고 하지 마세요. 가능한 간결하게 답변하세요. 모든 답변은 한국어로 높임말로 대답해야 합니다. 마지막으로 다음과 같은 문맥(context)을 활용하여 질문에 답하세요:
{context}
Question: {question}
Answer:
"""

# The sample questions.
SAMPLE_QUESTIONS = (
    "자동차 기업인 General Motors가 Microsoft와 협력해 개발중인 생성형AI 서비스는?",
    "헬스케어 시장 내 IT시장의 세계시장규모 성장세에 대해서 세문장 이내로 설명해 주세요.",
    "소프트웨어진흥법 제2조 6의 내용은 무엇인가요?",
    "석사에게 첫번째로 요구되는 SW기술 스택 수요는 무엇인가요?",
    "SW융합산업에서 자동차 산업의 경우 구직자의 근무지는 주로 어디인가요?",
)

# How the previous question and answer are put into the next request.
HISTORY_INTRO = "참고로 이전의 질문과 답변은 다음과 같습니다. 질문 : "
HISTORY_ANSWER = ". 답변 : "

CONTEXT_SEPARATOR = "\n\n"
TURN_BLOCK = 65_536
BLOCKS = 256  # parts of a longer conversation


def question_set(spark) -> DataFrame:
    """The sample questions as `(qid, query)`, numbered -1, -2, .. to stay clear of table ids."""
    numbered = [(-i, text) for i, text in enumerate(SAMPLE_QUESTIONS, start=1)]
    return spark.createDataFrame(numbered, "qid BIGINT, query STRING")


def stuff_context(hits: DataFrame, separator: str = CONTEXT_SEPARATOR) -> DataFrame:
    """`(qid, context)` from `(qid, rank, content)`: all chunks of a query in rank order."""
    ranked = F.sort_array(F.collect_list(F.struct("rank", "content")))  # at most k per group
    return hits.groupBy("qid").agg(F.array_join(ranked["content"], separator).alias("context"))


def fill_template(template: str, **values: Column) -> Column:
    """Put columns in place of `{name}` placeholders; text inside the values is left alone."""
    pieces = re.split(r"\{(" + "|".join(values) + r")\}", template)
    return F.concat(*[values[p] if i % 2 else F.lit(p) for i, p in enumerate(pieces)])


def prompts(retrieved: DataFrame, template: str = TEMPLATE, separator: str = CONTEXT_SEPARATOR) -> DataFrame:
    """`(qid, prompt)` from the retriever's `(qid, query, contents)`."""
    context = F.array_join("contents", separator)
    return retrieved.select("qid", fill_template(template, context=context, question=F.col("query")).alias("prompt"))


def _pairs(turns: DataFrame, window) -> DataFrame:
    """Add `pair`: a user turn's text with that of the assistant turn right after it."""
    after = F.lead(F.struct("role", "text")).over(window)
    complete = (F.col("role") == "user") & (F.col("after.role") == "assistant")
    pair = F.when(complete, F.struct(F.col("text").alias("question"), F.col("after.text").alias("answer")))
    return turns.withColumn("after", after).withColumn("pair", pair).drop("after")


def _last_pair(window) -> Column:
    return F.last("pair", ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, -1))


def _plain(turns: DataFrame) -> DataFrame:
    window = Window.partitionBy("conv_id").orderBy("turn")
    return _pairs(turns, window).withColumn("last_pair", _last_pair(window)).drop("pair")


def _in_blocks(turns: DataFrame, bounds: DataFrame) -> DataFrame:
    """The same for long conversations, in blocks of rows between bounds; what passes from block to block is a row per block."""
    number = F.size(F.filter("bounds", lambda bound: bound <= F.col("turn")))
    placed = turns.join(bounds, "conv_id").withColumn("block", number).drop("bounds")
    inside = Window.partitionBy("conv_id", "block").orderBy("turn")
    rows = _pairs(placed, inside)
    said = F.struct("role", "text")
    ends = rows.groupBy("conv_id", "block").agg(
        F.min_by(said, "turn").alias("first"),
        F.max_by(said, "turn").alias("end"),
        F.max_by("pair", F.when(F.col("pair").isNotNull(), F.col("turn"))).alias("inner"),
    )
    order = Window.partitionBy("conv_id").orderBy("block")
    over_edge = F.when(
        (F.col("end.role") == "user") & (F.col("next.role") == "assistant"),
        F.struct(F.col("end.text").alias("question"), F.col("next.text").alias("answer")),
    )
    ends = ends.withColumn("next", F.lead("first").over(order)).withColumn("pair", F.coalesce(over_edge, "inner"))
    carried = ends.select("conv_id", "block", _last_pair(order).alias("carried"))
    looked = rows.withColumn("own", _last_pair(inside)).join(carried, ["conv_id", "block"])
    return looked.select(*turns.columns, F.coalesce("own", "carried").alias("last_pair"))


def with_history(conversations: DataFrame, extra: str = "", block: int = TURN_BLOCK) -> DataFrame:
    """`(conv_id, turn, query)`: each user turn as a request that carries the last question that was answered, and its answer.

    An answer is the assistant turn right after a user turn of `conversations(conv_id, turn, role, text)`; system turns
    are left out and missing texts count as empty. The first request is `message. extra.`. Conversations of more than
    `block` rows are cut at quantiles of their turns, so that no task sorts one of them whole.
    """
    turns = conversations.filter("role <> 'system'").select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    long = turns.groupBy("conv_id").count().filter(F.col("count") > block).select("conv_id")
    steps = [i / BLOCKS for i in range(1, BLOCKS)]
    bounds = turns.join(long, "conv_id", "left_semi").groupBy("conv_id")
    bounds = bounds.agg(F.array_distinct(F.percentile_approx("turn", steps, 10_000)).alias("bounds"))
    looked = _plain(turns.join(long, "conv_id", "left_anti")).unionByName(_in_blocks(turns, bounds))
    message = F.concat(F.col("text"), F.lit(f". {extra}."))
    history = F.concat(F.lit(f" {HISTORY_INTRO}"), "last_pair.question", F.lit(HISTORY_ANSWER), "last_pair.answer")
    query = F.when(F.col("last_pair").isNotNull(), F.concat(message, history)).otherwise(message)
    return looked.filter("role = 'user'").select("conv_id", "turn", query.alias("query"))
