import random

from pyspark.sql import functions as F

from groundline.operators.answer import NO_ANSWER, answer, answer_extractive
from groundline.operators.prompt import fill_template, prompts, question_set, stuff_context, with_history

CONVERSATION = "conv_id BIGINT, turn BIGINT, role STRING, text STRING"
RETRIEVED = "qid BIGINT, query STRING, contents ARRAY<STRING>"


def test_template_leaves_values_alone(spark):
    df = spark.createDataFrame([("say {question}", "why {context}?")], "c STRING, q STRING")
    filled = fill_template("C={context};Q={question};{other}", context=F.col("c"), question=F.col("q"))
    assert df.select(filled).first()[0] == "C=say {question};Q=why {context}?;{other}"


def test_context_in_rank_order(spark):
    hits = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (2, 1, "z")], "qid BIGINT, rank INT, content STRING")
    assert {r.qid: r.context for r in stuff_context(hits).collect()} == {1: "a\n\nb", 2: "z"}
    retrieved = spark.createDataFrame([(1, "why", ["a", "b"]), (2, "how", [])], RETRIEVED)
    got = {r.qid: r.prompt for r in prompts(retrieved, "{context}|{question}").collect()}
    assert got == {1: "a\n\nb|why", 2: "|how"}


def test_question_set(spark):
    rows = question_set(spark).collect()
    assert len(rows) == 5 and all(r.qid < 0 and r.query for r in rows)


def test_history(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "q1"), (1, 2, "assistant", "a1"), (1, 3, "user", "q2")]
    got = with_history(spark.createDataFrame(rows, CONVERSATION), "be brief").orderBy("turn").collect()
    assert [r.query for r in got] == [
        "q1. be brief.",
        "q2. be brief. 참고로 이전의 질문과 답변은 다음과 같습니다. 질문 : q1. 답변 : a1",
    ]


def by_hand(rows):
    out, last, previous = [], {}, {}
    for conv, turn, role, text in sorted((r for r in rows if r[2] != "system"), key=lambda r: r[:2]):
        text = text or ""
        if role == "user":
            query = f"{text}. x."
            if conv in last:
                query += " 참고로 이전의 질문과 답변은 다음과 같습니다. 질문 : {}. 답변 : {}".format(*last[conv])
            out.append((conv, turn, query))
        elif previous.get(conv, ("", ""))[0] == "user":
            last[conv] = (previous[conv][1], text)
        previous[conv] = (role, text)
    return sorted(out)


def test_history_goes_by_answered_questions(spark):
    rng = random.Random(3)
    rows = []
    for conv in range(12):
        turn = 0
        for n in range(rng.choice([1, 2, 5, 40, 200])):
            turn += rng.choice([1, 1, 1, 2, 9, 1_000_000_007])
            role = rng.choice(["user", "user", "assistant", "assistant", "system"])
            rows.append((conv, turn, role, None if n % 17 == 5 else f"t{conv}.{n}"))
    df = spark.createDataFrame(rows, CONVERSATION)
    for block in (1, 3, 64, 65_536):  # long conversations are cut into blocks
        assert sorted(map(tuple, with_history(df, "x", block=block).collect())) == by_hand(rows)


def test_extractive_answer(spark):
    rows = [
        (1, "Where is the red house?", ["It rains. The red house is here! The house.\nThe red house is there", "x"]),
        (2, "nothing", []),
    ]
    got = {r.qid: r.answer for r in answer_extractive(spark.createDataFrame(rows, RETRIEVED)).collect()}
    assert got == {1: "The red house is here!", 2: NO_ANSWER}


def test_model_answer(spark):
    def load(params):
        return lambda texts: [f"{t}/{params['max_tokens']}/{params['temperature']}" for t in texts]

    df = spark.createDataFrame([(1, "p")], "qid BIGINT, prompt STRING")
    assert answer(df, load, {"temperature": 0.5}).first().answer == "p/1500/0.5"
