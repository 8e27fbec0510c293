import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from groundline.functions.text import WHITESPACE
from groundline.operators.chunk import chunk_by_heading, chunk_by_paragraph, chunk_by_tokens, chunk_json
from groundline.sources.chunk_table import CHUNKS_PER_DOCUMENT, chunk_id


def chunks(spark, text, **options):
    df = spark.createDataFrame([(7, text)], "doc_id BIGINT, text STRING")
    rows = chunk_by_heading(df, **options).orderBy("chunk_no").collect()
    assert [r.chunk_no for r in rows] == list(range(len(rows)))
    return [(r.content, r.headers) for r in rows]


def test_sections_and_paths(spark):
    text = "intro\n# A\na1\n\n a2 \n## B\nb\n### C\nc\n## D\nd\n# E\ne"
    h1, h2, h3 = "Header 1", "Header 2", "Header 3"
    assert chunks(spark, text) == [
        ("intro", {}),
        ("a1\na2", {h1: "A"}),
        ("b", {h1: "A", h2: "B"}),
        ("c", {h1: "A", h2: "B", h3: "C"}),
        ("d", {h1: "A", h2: "D"}),
        ("e", {h1: "E"}),
    ]


def test_heading_resets_deeper_levels(spark):
    assert chunks(spark, "# A\n### x\n# B\nbody", keep_heading_only=False) == [("body", {"Header 1": "B"})]


def test_heading_only_sections_keep_their_text(spark):
    got = chunks(spark, "# A\n### x\n# B\nbody")
    assert [content for content, _ in got] == ["A", "x", "body"]


def test_what_is_a_heading_line(spark):
    assert chunks(spark, "#A\n#### B\n  ## C  \nc\n##") == [("#A\n#### B", {}), ("c", {"Header 2": "C"})]
    assert chunks(spark, "") == []


def test_other_markers(spark):
    assert chunks(spark, "= T\nx", headers=(("=", "Title"),)) == [("x", {"Title": "T"})]


LINES = st.lists(
    st.sampled_from(["# h", "## h2", "### h3", "#", "text", " pad ", "", "##x", "-----", "#### deep", "가 나"]), max_size=12
)


@settings(max_examples=1, deadline=None)
@given(st.lists(LINES, min_size=150, max_size=150))
def test_contents_hold_all_other_lines_in_order(spark, documents):
    """Equal to a plain heading stack over the lines."""
    rows = [(i, "\n".join(lines)) for i, lines in enumerate(documents)]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    got = {}
    for r in chunk_by_heading(df).orderBy("doc_id", "chunk_no").collect():
        got.setdefault(r.doc_id, []).append((r.content, r.headers))
    for i, lines in enumerate(documents):
        expected, stack, body, title = [], {}, [], None

        def close():
            content = "\n".join(body) or title or ""
            if content:
                expected.append((content, {f"Header {k}": v for k, v in stack.items()}))

        for line in (x.strip(WHITESPACE) for x in lines):
            level = next((n for n in (1, 2, 3) if line == "#" * n or line.startswith("#" * n + " ")), None)
            if level:
                close()
                title = line[level:].strip()
                stack = {k: v for k, v in stack.items() if k < level} | {level: title}
                body = []
            elif line:
                body.append(line)
        close()
        assert got.get(i, []) == expected, lines


def test_json_keeps_text_readable(spark):
    df = spark.createDataFrame([(1, '# 가\n"q" it\'s')], "doc_id BIGINT, text STRING").transform(chunk_by_heading)
    row = chunk_json(df).select("json", F.get_json_object("json", "$.content").alias("back")).first()
    assert row.json == '{"content":"\\"q\\" it\'s","headers":{"Header 1":"가"}}'
    assert row.back == "\"q\" it's"


def test_tokens_and_paragraphs(spark):
    df = spark.createDataFrame([(1, " a b\tc　d e\n\n\n f "), (2, " \n ")], "doc_id BIGINT, text STRING")
    assert [tuple(r) for r in chunk_by_tokens(df, 4).collect()] == [(1, 0, "a b c d"), (1, 1, "e f")]
    assert [tuple(r) for r in chunk_by_paragraph(df).collect()] == [(1, 0, "a b\tc　d e"), (1, 1, "f")]


@pytest.mark.parametrize("size,overlap", [(1, 0), (4, 1), (4, 3), (5, 2), (7, 0)])
def test_overlapping_runs(spark, size, overlap):
    rows = [(n, " ".join(map(str, range(n)))) for n in range(20)] + [(99, None)]
    got = chunk_by_tokens(spark.createDataFrame(rows, "doc_id BIGINT, text STRING"), size, overlap=overlap).collect()
    expected = set()
    for n in range(20):
        start = no = 0
        while start < n:
            expected.add((n, no, " ".join(map(str, range(start, min(n, start + size))))))
            if start + size >= n:
                break
            start, no = start + size - overlap, no + 1
    assert {tuple(r) for r in got} == expected and len(got) == len(expected)


def test_an_overlap_is_shorter_than_a_run(spark):
    with pytest.raises(ValueError):
        chunk_by_tokens(spark.createDataFrame([(1, "a")], "doc_id BIGINT, text STRING"), 4, overlap=4)


def test_chunk_ids(spark):
    df = spark.createDataFrame([(3, 0), (3, 999_999), (4, 0)], "d BIGINT, n INT")
    assert [r[0] for r in df.select(chunk_id(F.col("d"), F.col("n"))).collect()] == [3_000_000, 3_999_999, 4_000_000]
    odd = spark.createDataFrame([(3, 1_000_000), (-1, 0), (10**13, 0), (10**18, 5), (-1, 1)], "d BIGINT, n INT")
    ids = [r[0] for r in odd.select(chunk_id(F.col("d"), F.col("n"))).collect()]
    assert all(i < 0 for i in ids) and len(set(ids)) == 5
