"""The registered queries in SQL, for an independent engine to check the results.

Where it matters the SQL takes another way than the Spark code: chunk headings come from running
windows over line rows, scores from a join of term rows, history from window frames.
"""

from groundline.functions.cleaning import SOFT_HYPHEN
from groundline.functions.text import WHITESPACE
from groundline.operators.answer import NO_ANSWER
from groundline.operators.codes import PARTS, SHORTLIST
from groundline.operators.prompt import CONTEXT_SEPARATOR, HISTORY_ANSWER, HISTORY_INTRO, SAMPLE_QUESTIONS, TEMPLATE
from groundline.plans.queries import CENTRE_PROBES, CHUNK_OVERLAP, CHUNK_TOKENS, DIMENSIONS
from groundline.plans.tables import EXTRA

# The whitespace set as an RE2 class body.
SPACES = (
    r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
NEWLINE = "\n"


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"trim({x}, {lit(WHITESPACE)})"


def sub(x: str, pattern: str, replacement: str) -> str:
    return f"regexp_replace({x}, {lit(pattern)}, {lit(replacement)}, 'g')"


def rep(x: str, search: str, replacement: str) -> str:
    return f"replace({x}, {lit(search)}, {lit(replacement)})"


def each(x: str, body) -> str:
    return f"list_transform({x}, lambda p: {body('p')})"


def _list_items(x: str) -> str:
    # RE2 has no lookahead: mark every "- ", then take the mark back where a space or the end follows
    marked = rep(strip(x), "- ", "\x02- ")
    unmarked = sub(marked, rf"\x02- ([{SPACES}]|\z)", r"- \1")
    return rep(unmarked, "\x02", "\n\n")


def _symbols(x: str) -> str:
    for pair in (("ㅇ", "- "), ("→", " 에서 "), ("’", "20"), ("☞", "- ")):
        x = rep(x, *pair)
    return x


CLEAN = (
    lambda x: sub(x, r".*syntax error.*\n?", ""),
    lambda x: f"string_split({x}, '-----')",
    lambda x: each(x, lambda p: strip(sub(p, r"(?s)\p{Nd}+\) .*", ""))),
    lambda x: each(x, lambda p: strip(sub(p, r"\[\p{Nd}+\)\]", ""))),
    lambda x: f"array_to_string({x}, {lit(NEWLINE * 2 + '-----' + NEWLINE)})",
    lambda x: rep(x, "\x01", " "),
    lambda x: sub(x, "####", "#"),
    lambda x: sub(x, r"(?m)^(\p{Nd}+)\. ", r"## \1. "),
    lambda x: sub(x, r"(?m)^□", "### "),
    _symbols,
    lambda x: sub(x, r"[*\[\]▲「」]", ""),
    lambda x: sub(x, r"\([^()]*,[^()]*\)", ""),
    lambda x: rep(x, "-----", ""),
    lambda x: rep(x, "\n\n", ""),
    lambda x: rep(x, "  ", " "),
    lambda x: sub(x, r"(#+)", "\n\n" + r"\1"),
    lambda x: sub(x, rf"C[{SPACES}]*#", "C#"),
    _list_items,
    lambda x: sub(x, r"(표 \p{Nd})", "\n\n" + r"\1"),
    lambda x: sub(x, r"(표 \p{Nd}.*?)(\|)", r"\1" + "\n\n" + r"\2"),
    lambda x: sub(x, f"※[^{SOFT_HYPHEN}]*{SOFT_HYPHEN}", "\n"),
)

MARKED = f"""marked AS (
  SELECT doc_id, array_to_string(list_transform(string_split(text, chr(10)), lambda l, i: CASE (i - 1) % 12
    WHEN 0 THEN '# ' || l
    WHEN 1 THEN '1. ' || l
    WHEN 2 THEN '□ ' || l
    WHEN 3 THEN 'ㅇ ' || l
    WHEN 4 THEN l || ' [3)]'
    WHEN 5 THEN l || ' (A, B)'
    WHEN 6 THEN '표 1 ' || l || ' | a | b |'
    WHEN 7 THEN 'syntax error: ' || l
    WHEN 8 THEN '※ ' || l || {lit(SOFT_HYPHEN)}
    WHEN 9 THEN '-----'
    WHEN 10 THEN '3) ' || l
    ELSE '#### ' || l || ' →’24☞▲「x」'
  END), chr(10)) AS md
  FROM documents)"""


def _clean_ctes(source: str, last: int = len(CLEAN)) -> list[str]:
    """One CTE per step; the last one is `cleaned(doc_id, x)`."""
    ctes = [f"c0 AS (SELECT doc_id, md AS x FROM {source})"]
    for n in range(1, last + 1):
        ctes.append(f"c{n} AS (SELECT doc_id, {CLEAN[n - 1]('x')} AS x FROM c{n - 1})")
    ctes.append(f"cleaned AS (SELECT * FROM c{last})")
    return ctes


def _tag(names: str) -> str:
    return rf"(?i)<(?:{names})(?:[ \t\r\n][^>]*)?>"


def _markdown(x: str) -> str:
    """What SURVEY asks of Markdown, written for RE2: one tag group after the other."""
    for pattern in (r"(?s)<!--.*?-->", r"(?is)<script(?:\s[^>]*)?>.*?</script\s*>", r"(?is)<style(?:\s[^>]*)?>.*?</style\s*>"):
        x = sub(x, pattern, "")
    x = sub(x, r"\s+", " ")
    for level in range(6, 0, -1):
        x = sub(x, _tag(f"h{level}"), NEWLINE * 2 + "#" * level + " ")
    for names, mark in (("b|strong|/b|/strong", "**"), ("i|em|/i|/em", "*"), ("code|/code", "`"), ("br|br/", NEWLINE),
                        ("li", NEWLINE + "- "), ("tr", NEWLINE + "|"), ("td|th", " ")):
        x = sub(x, _tag(names), mark)
    x = sub(x, r"(?i)</(?:td|th)\s*>", " |")
    blocks = "|".join(f"{name}|/{name}" for name in ("p", "div", "ul", "ol", "table", "article", "section"))
    x = sub(x, _tag(blocks + "|/h1|/h2|/h3|/h4|/h5|/h6"), NEWLINE * 2)
    x = sub(sub(x, "<[^>]*>", ""), " ?\n ?", NEWLINE)
    x = sub(x, "\n{3,}", NEWLINE * 2)
    for name, character in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("#39", "'"), ("apos", "'"), ("nbsp", " "), ("amp", "&")):
        x = rep(x, f"&{name};", character)
    return strip(x)


ARTICLE = strip(r"regexp_extract(html, '(?is)<article(?:\s[^>]*)?>.*?</article\s*>')")
MARKDOWN = f"""markdown AS (
  SELECT page_id, {_markdown(ARTICLE)} AS md FROM pages WHERE {ARTICLE} <> '')"""

# The structure before the foot of a page, written out.
STRUCTURE = """3. one
   - two

     more
   - three
4. four

> said
>
> ```
> a
>   b
> ```

| key | url |  |
| --- | --- | --- |
| a\\|b | {url} | *last* cell |"""


def _nested_markdown() -> str:
    """A fixture page with its structure, by what its pages are made of."""
    x = sub(sub("html", r"(?s)<head>.*?</head>|<!--.*?-->", ""), r"[ \t\r\n\f\x{a0}]+", " ")
    x = rep(x, "<footer>", "<p>\x01<p>")
    x = sub(x, r'<li><a href="([^"]*)">([^<]*)</a></li>', NEWLINE + r"- [\2](\1)")
    x = sub(x, "<b>([^<]*?) *<br>", r"**\1**" + NEWLINE)
    x = rep(x, "<h1>", NEWLINE * 2 + "# ")
    x = sub(x, r"</?(?:html|body|nav|ul|div|article|h1|p|footer)(?: [^>]*)?>|<!DOCTYPE html>", NEWLINE * 2)
    x = strip(sub(sub(x, " ?\n ?", NEWLINE), "\n{3,}", NEWLINE * 2))
    for name, character in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("copy", "\u00a9"), ("middot", "\u00b7"), ("amp", "&")):
        x = rep(x, f"&{name};", character)
    before, after = STRUCTURE.split("{url}")
    return f"replace({x}, chr(1), {lit(before)} || url || {lit(after)})"


# (line, level, title) rows, then headings in force by nested running counts.
CHUNKS = [
    "raw_lines AS (SELECT doc_id, unnest(list_zip(string_split(x, chr(10)), range(len(string_split(x, chr(10)))))) AS z FROM cleaned)",
    f"lines AS (SELECT doc_id, z[2] AS pos, {strip('z[1]')} AS l FROM raw_lines)",
    """levels AS (SELECT *, CASE WHEN l = '#' OR starts_with(l, '# ') THEN 1
        WHEN l = '##' OR starts_with(l, '## ') THEN 2
        WHEN l = '###' OR starts_with(l, '### ') THEN 3 END AS level FROM lines WHERE l <> '')""",
    f"titles AS (SELECT *, CASE WHEN level IS NOT NULL THEN {strip('substr(l, level + 1)')} END AS title FROM levels)",
    """counted AS (SELECT *, count(level) OVER w AS sec,
        count(CASE WHEN level = 1 THEN 1 END) OVER w AS g1, count(CASE WHEN level <= 2 THEN 1 END) OVER w AS g2
      FROM titles WINDOW w AS (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING))""",
    """headed AS (SELECT *,
        last_value(CASE WHEN level = 1 THEN title END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS h1,
        last_value(CASE WHEN level = 2 THEN title END IGNORE NULLS) OVER (PARTITION BY doc_id, g1 ORDER BY pos ROWS UNBOUNDED PRECEDING) AS h2,
        last_value(CASE WHEN level = 3 THEN title END IGNORE NULLS) OVER (PARTITION BY doc_id, g2 ORDER BY pos ROWS UNBOUNDED PRECEDING) AS h3
      FROM counted)""",
    """sections AS (SELECT doc_id, sec, max(h1) AS header_1, max(h2) AS header_2, max(h3) AS header_3,
        coalesce(string_agg(l, chr(10) ORDER BY pos) FILTER (WHERE level IS NULL), max(title), '') AS content
      FROM headed GROUP BY doc_id, sec)""",
    """chunks AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY sec) - 1 AS chunk_no, content,
        header_1, header_2, header_3 FROM sections WHERE content <> '')""",
    "indexed AS (SELECT doc_id * 1000000 + chunk_no AS id, * FROM chunks)",
]

TOKEN_SPLIT = r"[^\p{L}\p{N}]+"


def token_list(x: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({x}), {lit(TOKEN_SPLIT)}), lambda t: t <> '')"


def _terms(name: str, key: str, text: str, source: str) -> str:
    return f"""{name} AS (
      SELECT {key}, ('0x' || substr(md5(t), 1, 8))::BIGINT % 1048576 AS bucket, count(*) AS weight
      FROM (SELECT {key}, unnest({token_list(text)}) AS t FROM {source}) GROUP BY ALL)"""


def _norms(name: str, key: str, source: str) -> str:
    return f"{name} AS (SELECT {key}, sum(weight * weight)::BIGINT AS n2 FROM {source} GROUP BY {key})"


QUESTIONS = "questions AS (SELECT item_id AS qid, text AS query FROM benchmark)"
ALL_QUESTIONS = "questions AS (SELECT item_id AS qid, text AS query FROM benchmark UNION ALL VALUES {})".format(
    ", ".join(f"({-i}, {lit(q)})" for i, q in enumerate(SAMPLE_QUESTIONS, start=1))
)

SEARCH = [
    _terms("dterms", "id", "content", "indexed"),
    _terms("qterms", "qid", "query", "questions"),
    _norms("dnorms", "id", "dterms"),
    _norms("qnorms", "qid", "qterms"),
    "dots AS (SELECT qid, id, sum(q.weight * d.weight)::BIGINT AS dot FROM qterms q JOIN dterms d USING (bucket) GROUP BY qid, id)",
    """scored AS (SELECT qid, id, round(dot / sqrt((q.n2 * d.n2)::DOUBLE), 6) AS score
        FROM dots JOIN qnorms q USING (qid) JOIN dnorms d USING (id))""",
    """hits AS (SELECT qid, id, score, row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS rank
        FROM scored QUALIFY rank <= 4)""",
]
CONTEXTS = """contexts AS (SELECT qid, count(*) AS n, list(content ORDER BY rank) AS contents
        FROM hits JOIN indexed USING (id) GROUP BY qid)"""

SNAPSHOTS = [
    "old AS (SELECT doc_id * 1000000 AS id, text AS content FROM documents WHERE doc_id IN (SELECT doc_id FROM labels))",
    """new AS (SELECT doc_id * 1000000 AS id, CASE WHEN quality = 1 THEN text || ' (revised)' ELSE text END AS content
        FROM documents LEFT JOIN labels USING (doc_id) WHERE coalesce(toxic, 0) = 0)""",
]


def _with(ctes: list[str], select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


DOCUMENT_TEXT = [MARKED, *_clean_ctes("marked")]
DOCUMENT_CHUNKS = [*DOCUMENT_TEXT, *CHUNKS]
HEADING_CHUNKS = _with(
    DOCUMENT_CHUNKS, "SELECT doc_id, chunk_no::INT AS chunk_no, content, header_1, header_2, header_3 FROM chunks"
)
PAGE_CHUNKS = [MARKDOWN, "paged AS (SELECT page_id AS doc_id, md FROM markdown)", *_clean_ctes("paged"), *CHUNKS]
DOCUMENT_SEARCH = [*DOCUMENT_CHUNKS, QUESTIONS, *SEARCH]
TEXT_HITS = _with(DOCUMENT_SEARCH, "SELECT qid, rank::INT AS rank, id, content, score FROM hits JOIN indexed USING (id)")
INDEX_SUMMARY = "SELECT id, md5(content) AS content_md5, coalesce(n2, 0) AS norm2 FROM {} LEFT JOIN norms USING (id)"


def _clean_query(step: int) -> str:
    ctes = [MARKED, *_clean_ctes("marked", step)]
    if 2 <= step <= 4:
        return _with(
            [*ctes, "zipped AS (SELECT doc_id, unnest(list_zip(x, range(len(x)))) AS z FROM cleaned)"],
            "SELECT doc_id, z[2]::INT AS page_no, z[1] AS page FROM zipped",
        )
    return _with(ctes, "SELECT doc_id, x AS text FROM cleaned")


def _template(context: str, question: str) -> str:
    before, rest = TEMPLATE.split("{context}")
    between, after = rest.split("{question}")
    return f"{lit(before)} || {context} || {lit(between)} || {question} || {lit(after)}"


def _exploded(list_sql: str, source: str, key: str = "doc_id") -> list[str]:
    return [
        f"listed AS (SELECT {key}, {list_sql} AS x FROM {source})",
        f"zipped AS (SELECT {key}, unnest(list_zip(x, range(len(x)))) AS z FROM listed)",
    ]


def _extractive() -> list[str]:
    sentence_list = f"list_filter({each('string_split(' + sub('contents[1]', '([.!?]) ', chr(92) + '1' + NEWLINE) + ', chr(10))', strip)}, lambda s: s <> '')"
    return [
        f"asked AS (SELECT qid, query, {sentence_list} AS ss FROM questions LEFT JOIN contexts USING (qid))",
        "sentence_rows AS (SELECT qid, query, unnest(list_zip(ss, range(len(ss)))) AS z FROM asked)",
        f"shared AS (SELECT qid, z[1] AS s, z[2] AS pos, len(list_intersect(list_distinct({token_list('query')}), list_distinct({token_list('z[1]')}))) AS n FROM sentence_rows)",
        "best AS (SELECT qid, s FROM shared QUALIFY row_number() OVER (PARTITION BY qid ORDER BY n DESC, pos) = 1)",
        f"answers AS (SELECT qid, query, coalesce(s, {lit(NO_ANSWER)}) AS answer FROM questions LEFT JOIN best USING (qid))",
    ]


PAGE_ANSWERS = [*PAGE_CHUNKS, QUESTIONS, *SEARCH, CONTEXTS]
PROMPT = _template(f"coalesce(array_to_string(contents, {lit(CONTEXT_SEPARATOR)}), '')", "query")


def _history(source: str) -> list[str]:
    """Each user turn, with the newest user turn before it that an assistant turn follows at once."""
    return [
        f"""said AS (SELECT conv_id, turn, role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n
             FROM {source} WHERE role <> 'system')""",
        """answered AS (SELECT u.conv_id, u.n, u.text AS q, a.text AS a FROM said u JOIN said a
             ON a.conv_id = u.conv_id AND a.n = u.n + 1 AND u.role = 'user' AND a.role = 'assistant')""",
        f"""history AS (SELECT u.conv_id, u.turn, u.text || '. {EXTRA}.' || coalesce(
              {lit(' ' + HISTORY_INTRO)} || p.q || {lit(HISTORY_ANSWER)} || p.a, '') AS query
            FROM (SELECT * FROM said WHERE role = 'user') u ASOF LEFT JOIN answered p
              ON u.conv_id = p.conv_id AND u.n > p.n)""",
    ]


HISTORY = _history("conversations")
NO_QUESTIONS = " UNION ALL SELECT -1 - item_id, NULL, NULL, 'no question in the payload' FROM benchmark"
ANSWERS = [*DOCUMENT_SEARCH, CONTEXTS, *_extractive()]
SYNCED = _with(
    [*SNAPSHOTS, _terms("dterms", "id", "content", "new"), _norms("norms", "id", "dterms")], INDEX_SUMMARY.format("new")
)
DIFFERENCE = _with(
    SNAPSHOTS,
    """SELECT id, CASE WHEN o.content IS NULL THEN 'insert' WHEN n.content IS NULL THEN 'delete' ELSE 'update' END AS op
       FROM new n FULL JOIN old o USING (id) WHERE n.content IS DISTINCT FROM o.content""",
)
TOKENS_LIST = f"list_filter(regexp_split_to_array(text, {lit('[' + SPACES + ']+')}), lambda w: w <> '')"

WIDTH = DIMENSIONS // PARTS  # of a piece of a vector

LABEL_MEANS = [
    f"value_rows AS (SELECT label, unnest(list_zip(embedding, range({DIMENSIONS}))) AS z FROM embeddings)",
    "means AS (SELECT label, z[2] AS pos, avg(z[1]::DOUBLE) AS m FROM value_rows GROUP BY ALL)",
]

ORACLES = {
    "rag_prompts": _with(PAGE_ANSWERS, f"SELECT qid, {PROMPT} AS prompt FROM questions LEFT JOIN contexts USING (qid)"),
    "answers_model": _with(
        PAGE_ANSWERS,
        f"SELECT qid, length({PROMPT})::VARCHAR || ' of 1500' AS answer FROM questions LEFT JOIN contexts USING (qid)",
    ),
    "embed_model": _with(
        DOCUMENT_CHUNKS,
        """SELECT id, length(content)::DOUBLE AS v1, (length(content) - length(replace(content, ' ', '')))::DOUBLE AS v2,
             (length(content) - length(replace(content, 'e', '')))::DOUBLE AS v3 FROM indexed""",
    ),
    **{f"clean_t{n:02d}": _clean_query(n) for n in range(1, len(CLEAN) + 1)},
    "clean_all": _with(DOCUMENT_TEXT, "SELECT doc_id, x AS text FROM cleaned"),
    "chunk_heading": HEADING_CHUNKS,
    "chunk_segments": HEADING_CHUNKS,
    "chunk_json": _with(
        DOCUMENT_CHUNKS,
        """SELECT doc_id, chunk_no::INT AS chunk_no, '{"content":' || to_json(content)::VARCHAR || ',"headers":{' ||
             concat_ws(',', '"Header 1":' || to_json(header_1)::VARCHAR, '"Header 2":' || to_json(header_2)::VARCHAR,
               '"Header 3":' || to_json(header_3)::VARCHAR) || '}}' AS json
           FROM chunks""",
    ),
    "chunk_tokens": _with(
        [
            f"words AS (SELECT doc_id, {TOKENS_LIST} AS ws FROM documents)",
            "word_rows AS (SELECT doc_id, unnest(list_zip(ws, range(len(ws)))) AS z FROM words)",
        ],
        f"""SELECT doc_id, (z[2] // {CHUNK_TOKENS})::INT AS chunk_no, string_agg(z[1], ' ' ORDER BY z[2]) AS content
            FROM word_rows GROUP BY doc_id, z[2] // {CHUNK_TOKENS}""",
    ),
    "chunk_overlap": _with(
        [
            f"words AS (SELECT doc_id, {TOKENS_LIST} AS ws FROM documents)",
            "word_rows AS (SELECT doc_id, len(ws) AS n, unnest(list_zip(ws, range(len(ws)))) AS z FROM words)",
            # the runs that hold a word, of those that bring words of their own
            f"""placed AS (SELECT doc_id, z, unnest(range(greatest(0, (z[2] - {CHUNK_OVERLAP}) // {CHUNK_TOKENS - CHUNK_OVERLAP}),
                  least(z[2] // {CHUNK_TOKENS - CHUNK_OVERLAP}, greatest(0, n - {CHUNK_OVERLAP} - 1) // {CHUNK_TOKENS - CHUNK_OVERLAP}) + 1)) AS run
                FROM word_rows)""",
        ],
        f"""SELECT doc_id, run::INT AS chunk_no, string_agg(z[1], ' ' ORDER BY z[2]) AS content FROM placed
            WHERE z[2] < run * {CHUNK_TOKENS - CHUNK_OVERLAP} + {CHUNK_TOKENS} GROUP BY doc_id, run""",
    ),
    "chunk_paragraph": _with(
        [
            MARKED,
            *_clean_ctes("marked", 5),
            *_exploded(
                f"list_filter({each('string_split(x, ' + lit(NEWLINE * 2) + ')', strip)}, lambda p: p <> '')", "cleaned"
            ),
        ],
        "SELECT doc_id, z[2]::INT AS chunk_no, z[1] AS content FROM zipped",
    ),
    "chunk_table": _with(
        DOCUMENT_CHUNKS,
        """SELECT id, doc_id, chunk_no::INT AS chunk_no, content, md5(content) AS content_md5,
             header_1, header_2, header_3 FROM indexed""",
    ),
    "chunk_table_ordered": _with(DOCUMENT_CHUNKS, "SELECT id, content FROM indexed ORDER BY id"),
    "embed_terms": _with(
        [*DOCUMENT_CHUNKS, _terms("dterms", "id", "content", "indexed")],
        "SELECT id, bucket::INT AS bucket, weight FROM dterms",
    ),
    "embed_query_terms": _with(
        [QUESTIONS, _terms("qterms", "qid", "query", "questions")],
        "SELECT qid, bucket::INT AS bucket, weight FROM qterms",
    ),
    "vector_head": "SELECT vec_id AS id, "
    + ", ".join(f"embedding[{i}]::DOUBLE AS v{i}" for i in range(1, 6))
    + " FROM embeddings",
    "index_build": _with(
        [*DOCUMENT_CHUNKS, _terms("dterms", "id", "content", "indexed"), _norms("norms", "id", "dterms")],
        INDEX_SUMMARY.format("indexed"),
    ),
    "index_diff": DIFFERENCE,
    "index_diff_tree": DIFFERENCE,
    "index_sync": SYNCED,
    "index_sync_stream": SYNCED,
    "index_rebuild": SYNCED,
    "index_sync_late": _with(
        [
            *SNAPSHOTS,
            "merged AS (SELECT * FROM new UNION ALL SELECT * FROM old WHERE id NOT IN (SELECT id FROM new))",
            _terms("dterms", "id", "content", "merged"),
            _norms("norms", "id", "dterms"),
        ],
        INDEX_SUMMARY.format("merged"),
    ),
    "index_sync_nulls": _with(
        [
            "kept AS (SELECT doc_id * 1000000 AS id, CASE WHEN lang <> 'es' THEN text END AS content FROM documents)",
            _terms("dterms", "id", "content", "kept"),
            _norms("norms", "id", "dterms"),
        ],
        """SELECT id, md5(content) AS content_md5, CASE WHEN content IS NOT NULL THEN coalesce(n2, 0) END AS norm2
           FROM kept LEFT JOIN norms USING (id)""",
    ),
    "search_text": TEXT_HITS,
    "search_text_postings": TEXT_HITS,
    "search_text_weighted": _with(
        [
            *DOCUMENT_CHUNKS,
            QUESTIONS,
            _terms("dterms", "id", "content", "indexed"),
            _terms("counts", "qid", "query", "questions"),
            "total AS (SELECT count(DISTINCT id) AS n FROM dterms)",
            "frequent AS (SELECT bucket, count(*) AS df FROM dterms GROUP BY bucket)",
            """qterms AS (SELECT qid, bucket, (weight * floor(1000 * ln((2 * n + 2) / (2 * df + 1))))::BIGINT AS weight
                 FROM counts JOIN frequent USING (bucket), total WHERE df <= 0.5 * n)""",
            *SEARCH[2:],
        ],
        "SELECT qid, rank::INT AS rank, id, content, score FROM hits JOIN indexed USING (id)",
    ),
    "search_vector": _with(
        [
            *LABEL_MEANS,
            "q AS (SELECT label::BIGINT AS qid, list(m ORDER BY pos) AS qv FROM means GROUP BY label)",
            "v AS (SELECT vec_id AS id, label, embedding::DOUBLE[] AS dv FROM embeddings)",
            """scored AS (SELECT qid, id, label, round(list_dot_product(qv, dv)
                 / sqrt(list_dot_product(qv, qv) * list_dot_product(dv, dv)), 6) AS score FROM q, v)""",
        ],
        """SELECT qid, row_number() OVER (PARTITION BY qid ORDER BY score DESC, id)::INT AS rank, id, label, score
           FROM scored QUALIFY rank <= 4""",
    ),
    "search_approx_centres": _with(
        [
            *LABEL_MEANS,
            "c AS (SELECT label AS cell, list(m ORDER BY pos) AS cv FROM means GROUP BY label)",
            "v AS (SELECT vec_id AS id, embedding::DOUBLE[] AS dv FROM embeddings)",
            """near AS (SELECT id, dv, cell, row_number() OVER (PARTITION BY id
                 ORDER BY list_dot_product(cv, dv) / sqrt(list_dot_product(cv, cv)) DESC, cell) AS place FROM v, c)""",
            f"""scored AS (SELECT q.id AS qid, r.id AS id, round(list_dot_product(q.dv, r.dv)
                 / sqrt(list_dot_product(q.dv, q.dv) * list_dot_product(r.dv, r.dv)), 6) AS score
                 FROM near q JOIN near r ON q.cell = r.cell
                 WHERE q.id % 100 = 0 AND q.place <= {CENTRE_PROBES} AND r.place = 1)""",
        ],
        """SELECT qid, row_number() OVER (PARTITION BY qid ORDER BY score DESC, id)::INT AS rank, id, score
           FROM scored QUALIFY rank <= 4""",
    ),
    "search_codes": _with(
        [
            *LABEL_MEANS,
            "c AS (SELECT label AS cell, list(m ORDER BY pos) AS cv FROM means GROUP BY label)",
            """v AS (SELECT vec_id AS id, embedding::DOUBLE[] AS dv,
                 list_transform(dv, lambda x: x / sqrt(list_dot_product(dv, dv))) AS uv FROM embeddings)""",
            """near AS (SELECT id, dv, uv, cell, row_number() OVER (PARTITION BY id
                 ORDER BY list_dot_product(cv, dv) / sqrt(list_dot_product(cv, cv)) DESC, cell) AS place FROM v, c)""",
            f"""books AS (SELECT p, cell AS word, list_slice(cv, p * {WIDTH} + 1, (p + 1) * {WIDTH}) AS piece
                 FROM c, range({DIMENSIONS // WIDTH}) t(p))""",
            f"""coded AS (SELECT id, p, piece, row_number() OVER (PARTITION BY id, p ORDER BY
                 list_dot_product(list_slice(uv, p * {WIDTH} + 1, (p + 1) * {WIDTH}), piece) - list_dot_product(piece, piece) / 2 DESC, word) AS place
                 FROM v, books)""",
            f"""coarse AS (SELECT q.id AS qid, r.id AS id, round(sum(list_dot_product(list_slice(q.uv, p * {WIDTH} + 1, (p + 1) * {WIDTH}), piece)), 6) AS score
                 FROM near q JOIN near r ON q.cell = r.cell JOIN coded ON coded.id = r.id AND coded.place = 1
                 WHERE q.id % 100 = 0 AND q.place <= {CENTRE_PROBES} AND r.place = 1 GROUP BY ALL)""",
            f"short AS (SELECT qid, id FROM coarse QUALIFY row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) <= {SHORTLIST})",
            """scored AS (SELECT qid, s.id AS id, round(list_dot_product(q.dv, r.dv)
                 / sqrt(list_dot_product(q.dv, q.dv) * list_dot_product(r.dv, r.dv)), 6) AS score
                 FROM short s JOIN v q ON q.id = qid JOIN v r ON r.id = s.id)""",
        ],
        """SELECT qid, row_number() OVER (PARTITION BY qid ORDER BY score DESC, id)::INT AS rank, id, score
           FROM scored QUALIFY rank <= 4""",
    ),
    "topk": """SELECT source AS qid, doc_id AS id, n_chars AS score,
           row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id)::INT AS rank
         FROM documents QUALIFY rank <= 4""",
    "retrieve": _with(
        [*DOCUMENT_SEARCH, CONTEXTS],
        """SELECT qid, query, coalesce(n, 0) AS n_contents, contents[1] AS content_1, contents[2] AS content_2,
             contents[3] AS content_3, contents[4] AS content_4 FROM questions LEFT JOIN contexts USING (qid)""",
    ),
    "stuff_context": _with(
        [*DOCUMENT_SEARCH, CONTEXTS], f"SELECT qid, array_to_string(contents, {lit(CONTEXT_SEPARATOR)}) AS context FROM contexts"
    ),
    "fill_template": f"SELECT doc_id, {_template('text', 'source')} AS prompt FROM documents",
    "question_set": _with(
        [*DOCUMENT_CHUNKS, ALL_QUESTIONS, *SEARCH], "SELECT qid, rank::INT AS rank, id, score FROM hits"
    ),
    "history_prompts": _with(HISTORY, "SELECT conv_id, turn, query FROM history"),
    "history_gaps": _with(
        [
            """doubled AS (SELECT conv_id, turn * 10 AS turn, role, text FROM conversations
                 UNION ALL SELECT conv_id, turn * 10 + 1, role, text || ' please' FROM conversations WHERE role = 'user')""",
            *_history("doubled"),
        ],
        "SELECT conv_id, turn, query FROM history",
    ),
    "chat_prompts": _with(
        [*DOCUMENT_CHUNKS, *HISTORY, "questions AS (SELECT {conv_id: conv_id, turn: turn} AS qid, query FROM history)",
         *SEARCH, CONTEXTS],
        f"SELECT qid.conv_id AS conv_id, qid.turn AS turn, {PROMPT} AS prompt FROM questions LEFT JOIN contexts USING (qid)",
    ),
    "answers_extractive": _with(ANSWERS, "SELECT qid, answer FROM answers"),
    "first_prediction": "SELECT conv_id, turn, text AS answer FROM conversations WHERE role = 'assistant'",
    "answer_stream": _with(ANSWERS, "SELECT qid AS request_id, query, answer, NULL::VARCHAR AS error FROM answers" + NO_QUESTIONS),
    "answer_stream_model": _with(
        PAGE_ANSWERS,
        f"""SELECT qid AS request_id, query, length({PROMPT})::VARCHAR || ' of 1500' AS answer, NULL::VARCHAR AS error
            FROM questions LEFT JOIN contexts USING (qid)""" + NO_QUESTIONS,
    ),
    "payload_rows": """SELECT item_id AS qid, form, text AS query
         FROM benchmark, (VALUES ('split'), ('inputs')) f(form)""",
    "data_array": _with(
        _exploded("string_split(text, chr(10))", "documents"),
        """SELECT doc_id, z[2] AS line_no, z[1] AS line FROM zipped
           UNION ALL SELECT -1 - doc_id, NULL, NULL FROM documents""",
    ),
    "latest_version": """SELECT source AS name, greatest(1, max(n_chars))::INT AS latest_version
         FROM documents GROUP BY source""",
    "sitemap_urls": "SELECT url FROM pages",
    "page_source": "SELECT page_id, url, html FROM pages UNION ALL SELECT -1 - page_id, url, NULL FROM pages",
    "article_text": f"SELECT page_id, url, nullif({ARTICLE}, '') AS text FROM pages",
    # the block's own text ends at its first closing tag; the nested blocks stand before it
    "article_nested": """SELECT page_id, url, CASE WHEN contains(html, '<div class="ad">') THEN
             '<div class="ad"><div><div>a</div>b</div>' || split_part(split_part(html, '<div class="ad">', 2), '</div>', 1) || '</div>'
           END AS text FROM pages""",
    "nonnull_articles": f"SELECT url, {ARTICLE} AS text FROM pages WHERE {ARTICLE} <> ''",
    "html_markdown": _with([MARKDOWN], "SELECT page_id, md FROM markdown"),
    "markdown_nested": f"SELECT page_id, {_nested_markdown()} AS md FROM pages WHERE html <> ''",
    "page_range": _with(
        [MARKED, *_exploded("string_split(md, '-----')", "marked")],
        "SELECT doc_id, z[2]::INT AS page_no, z[1] AS page FROM zipped WHERE z[2] BETWEEN 5 AND 19",
    ),
}
