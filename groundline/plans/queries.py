"""The registered queries: one per operator, each over whole tables."""

from functools import partial

import numpy as np

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundline.functions.cleaning import STEPS, clean, clean_text, clean_through
from groundline.functions.tokens import squared_norm, vec_head
from groundline.operators import cells, chunk, codes, difftree, embed, index, postings, prompt, search, segments, termstats
from groundline.operators.answer import answer, answer_extractive, model_responder
from groundline.operators.nearest import topk
from groundline.plans import tables as t
from groundline.session import shared_dir
from groundline.sources import chunk_table, documents, pages, payload
from groundline.streaming.answers import answer_stream
from groundline.streaming.sync import sync_stream

DIMENSIONS = 64
CELLS, PROBES = 16, 4
CENTRE_PROBES = 2
EMBED_WAVES = 3
CHUNK_TOKENS, CHUNK_OVERLAP = 64, 16
AD, NESTED = '<div class="ad">', "<div><div>a</div>b</div>"
STRUCTURE = (
    "<ol start=3><li>one<ul><li>two<p>more</p></li><li>three</ul><li>four</ol><blockquote>said<pre>a\n  b</pre></blockquote>"
    "<table><tr><th>key<th>url</tr><tr><td>a|b<td>{url}<td><i>last </i>cell</table>"
)


def clean_step(spark: SparkSession, sf_dir: str, step: int) -> DataFrame:
    """The text after cleaning steps 1..step; pages as rows while the text is split into pages."""
    marked = t.marked_documents(spark, sf_dir)
    cleaned = clean_through(F.col("md"), step)
    if 2 <= step <= 4:
        return marked.select("doc_id", F.posexplode(cleaned).alias("page_no", "page"))
    return marked.select("doc_id", cleaned.alias("text"))


def clean_all(spark, sf_dir):
    return t.marked_documents(spark, sf_dir).select("doc_id", clean_text(F.col("md")).alias("text"))


def _header_columns(chunks: DataFrame) -> DataFrame:
    names = [F.col("headers")[name].alias(f"header_{i}") for i, (_, name) in enumerate(chunk.HEADERS, start=1)]
    return chunks.select(*[c for c in chunks.columns if c != "headers"], *names)


def chunk_heading(spark, sf_dir):
    return _header_columns(t.document_chunks(spark, sf_dir))


def chunk_segments(spark, sf_dir):
    """The same chunks of documents that come as segments of seven lines."""
    cleaned = t.marked_documents(spark, sf_dir).transform(clean, "md")
    lines = cleaned.select("doc_id", F.posexplode(F.split("md", "\n", -1)).alias("line_no", "line"))
    return _header_columns(segments.chunk_segments(segments.to_segments(lines, 7)))


def chunk_json(spark, sf_dir):
    return chunk.chunk_json(t.document_chunks(spark, sf_dir)).select("doc_id", "chunk_no", "json")


def chunk_tokens(spark, sf_dir):
    documents = t.spread(t.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return chunk.chunk_by_tokens(documents, CHUNK_TOKENS)


def chunk_overlap(spark, sf_dir):
    documents = t.spread(t.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return chunk.chunk_by_tokens(documents, CHUNK_TOKENS, overlap=CHUNK_OVERLAP)


def chunk_paragraph(spark, sf_dir):
    marked = t.marked_documents(spark, sf_dir)
    # before pages are joined and blank lines deleted, page breaks are where paragraphs end
    return chunk.chunk_by_paragraph(marked.select("doc_id", clean_through(F.col("md"), 5).alias("text")))


def _write_chunk_table(spark, sf_dir, name):
    chunk_table.write_chunks(t.document_chunks(spark, sf_dir), name, path=shared_dir(spark, name))
    if not chunk_table.table_exists(spark, name):
        raise RuntimeError(f"table {name} was not created")


def chunk_table_rows(spark, sf_dir):
    _write_chunk_table(spark, sf_dir, "groundline_chunks")
    return _header_columns(spark.table("groundline_chunks").drop("created_at"))


def chunk_table_ordered(spark, sf_dir):
    _write_chunk_table(spark, sf_dir, "groundline_chunks_ordered")
    return chunk_table.read_chunks(spark, "groundline_chunks_ordered").select("id", "content")


def embed_terms(spark, sf_dir):
    chunks = t.index_rows(t.document_chunks(spark, sf_dir, EMBED_WAVES))
    return embed.term_rows(embed.embed(chunks, "content", t.EMBEDDER), "id")


def embed_query_terms(spark, sf_dir):
    return embed.term_rows(embed.embed_queries(t.questions(spark, sf_dir), t.EMBEDDER), "qid")


def _load_letter_counts():
    """Stands in for a model: a text's length and its numbers of spaces and of the letter e."""
    return lambda texts: [(len(text), text.count(" "), text.count("e")) for text in texts]


def embed_model(spark, sf_dir):
    """The plug for models over all chunks, with a stand-in whose vectors SQL can check."""
    chunks = t.index_rows(t.document_chunks(spark, sf_dir, EMBED_WAVES))
    embedded = embed.embed(chunks, "content", embed.model_embedder("letter-counts", 3, _load_letter_counts))
    return embedded.select("id", *[F.col("vec")[i].cast("double").alias(f"v{i + 1}") for i in range(3)])


def vector_head(spark, sf_dir):
    vectors = embed.from_vectors(t.table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    head = vectors.select("id", vec_head(F.col("vec"), 5).alias("head"))
    return head.select("id", *[F.col("head")[i].cast("double").alias(f"v{i + 1}") for i in range(5)])


def _index_summary(rows: DataFrame) -> DataFrame:
    return rows.select("id", "content_md5", squared_norm(F.col("vec")).alias("norm2"))


def index_build(spark, sf_dir):
    chunks = t.index_rows(t.document_chunks(spark, sf_dir))
    built = index.build_index(chunks, shared_dir(spark, "index-build"), t.EMBEDDER)
    return _index_summary(built.rows())


def index_diff(spark, sf_dir):
    old = t.old_snapshot(spark, sf_dir).withColumn("content_md5", F.md5("content"))
    return index.index_diff(t.new_snapshot(spark, sf_dir), old)


def index_diff_tree(spark, sf_dir):
    """The same difference by a hash tree over both snapshots, written as tables in id order."""
    snapshots = []
    for name, rows in (("new", t.new_snapshot(spark, sf_dir)), ("old", t.old_snapshot(spark, sf_dir))):
        path = shared_dir(spark, f"diff-{name}")
        rows.withColumn("content_md5", F.md5("content")).repartitionByRange("id").sortWithinPartitions("id").write.parquet(path)
        snapshots.append(spark.read.parquet(path))
    return difftree.index_diff_tree(*snapshots)


def index_sync(spark, sf_dir):
    root = shared_dir(spark, "index-sync")
    index.sync_index(t.old_snapshot(spark, sf_dir), root, t.EMBEDDER)
    return _index_summary(index.sync_index(t.new_snapshot(spark, sf_dir), root, t.EMBEDDER).rows())


def index_sync_stream(spark, sf_dir):
    """The change feed from the old to the new snapshot, applied by two triggered runs."""
    root, feed, checkpoint = (shared_dir(spark, f"sync-{part}") for part in ("index", "feed", "checkpoint"))
    old, new = t.old_snapshot(spark, sf_dir), t.new_snapshot(spark, sf_dir)
    columns = ("seq", "op", "id", "content")
    first = old.withColumns({"seq": F.lit(1).cast("long"), "op": F.lit("insert")})
    first.select(*columns).write.mode("append").parquet(feed)
    sync_stream(spark, feed, root, t.EMBEDDER, checkpoint)
    changed = index.index_diff(new, old.withColumn("content_md5", F.md5("content")))
    second = changed.join(new, "id", "left").withColumn("seq", F.lit(2).cast("long"))
    second.select(*columns).write.mode("append").parquet(feed)
    return _index_summary(sync_stream(spark, feed, root, t.EMBEDDER, checkpoint).rows())


def index_rebuild(spark, sf_dir):
    """The new snapshot over an index of the old one."""
    root = shared_dir(spark, "index-rebuild")
    index.build_index(t.old_snapshot(spark, sf_dir), root, t.EMBEDDER)
    return _index_summary(index.build_index(t.new_snapshot(spark, sf_dir), root, t.EMBEDDER).rows())


def index_sync_late(spark, sf_dir):
    """New rows as changes of a higher number, then the old rows, late: they only add ids that are not there."""
    root = shared_dir(spark, "index-late")

    def changes(rows, seq):
        return rows.withColumns({"seq": F.lit(seq).cast("long"), "op": F.lit("update")})

    index.apply_changes(changes(t.new_snapshot(spark, sf_dir), 3), root, t.EMBEDDER, batch_id=0)
    late = index.apply_changes(changes(t.old_snapshot(spark, sf_dir), 2), root, t.EMBEDDER, batch_id=1)
    return _index_summary(index.compact_index(late).rows())


def index_sync_nulls(spark, sf_dir):
    """All documents, then twice the same with the Spanish texts missing."""
    root = shared_dir(spark, "index-nulls")
    docs = t.table(spark, sf_dir, "documents").select(chunk_table.chunk_id(F.col("doc_id"), F.lit(0)).alias("id"), "lang", "text")
    whole = docs.select("id", F.col("text").alias("content"))
    missing = docs.select("id", F.when(F.col("lang") != "es", F.col("text")).alias("content"))
    for rows in (whole, missing, missing):
        synced = index.sync_index(rows, root, t.EMBEDDER)
    return _index_summary(synced.rows())


def search_text(spark, sf_dir):
    found = t.chunk_index(spark, sf_dir, t.document_chunks)
    return search.search_text(t.questions(spark, sf_dir), found)


def search_text_postings(spark, sf_dir):
    """The same search by inverted lists: only the questions' own buckets are read."""
    found = t.chunk_index(spark, sf_dir, t.document_chunks)
    return postings.search_text_postings(t.questions(spark, sf_dir), found, t.chunk_postings(found))


def search_text_weighted(spark, sf_dir):
    """Questions weighted by document frequencies, without the words of more than half of all chunks."""
    found = t.chunk_index(spark, sf_dir, t.document_chunks)
    return termstats.search_text_weighted(t.questions(spark, sf_dir), found, postings=t.chunk_postings(found))


def search_vector(spark, sf_dir):
    rows = t.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"), "label")
    return search.search_vector(t.label_vectors(spark, sf_dir), rows, DIMENSIONS, ("label",))


def search_approx(spark, sf_dir):
    rows = embed.from_vectors(t.table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    built = cells.build_cells(rows, CELLS, shared_dir(spark, "cells"))
    return search.search_approx(t.label_vectors(spark, sf_dir), built, PROBES)


def search_approx_centres(spark, sf_dir):
    """Cells around given centres, the mean vector of each label; every hundredth vector asks."""
    rows = embed.from_vectors(t.table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    means = t.label_vectors(spark, sf_dir).orderBy("qid").collect()  # a row per label
    centres = np.array([mean.vec for mean in means]).reshape(len(means), DIMENSIONS)
    built = cells.build_cells(rows, len(means), shared_dir(spark, "label-cells"), centres=centres)
    asked = rows.filter("id % 100 = 0").withColumnRenamed("id", "qid")
    return search.search_approx(asked, built, CENTRE_PROBES)


def search_codes(spark, sf_dir):
    """Codes around given codewords, the pieces of the labels' mean vectors; every hundredth vector asks."""
    rows = embed.from_vectors(t.table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    means = t.label_vectors(spark, sf_dir).orderBy("qid").collect()  # a row per label
    centres = np.array([mean.vec for mean in means]).reshape(len(means), DIMENSIONS)
    built = cells.build_cells(rows, len(means), shared_dir(spark, "code-cells"), centres=centres)
    books = centres.reshape(len(means), codes.PARTS, -1).transpose(1, 0, 2)
    coded = codes.build_codes(built, shared_dir(spark, "codes"), books=books)
    asked = rows.filter("id % 100 = 0").withColumnRenamed("id", "qid")
    return codes.search_codes(asked, coded, CENTRE_PROBES)


def topk_hits(spark, sf_dir):
    """Per source, the four longest documents."""
    scored = t.table(spark, sf_dir, "documents").select(
        F.col("source").alias("qid"), F.col("doc_id").alias("id"), F.col("n_chars").alias("score")
    )
    return topk(scored, search.RESULTS)


def retrieve(spark, sf_dir):
    found = t.chunk_index(spark, sf_dir, t.document_chunks)
    retrieved = search.retrieve(t.questions(spark, sf_dir), found)
    return retrieved.select(
        "qid",
        "query",
        F.size("contents").cast("long").alias("n_contents"),
        *[F.get("contents", i).alias(f"content_{i + 1}") for i in range(search.RESULTS)],
    )


def stuff_context(spark, sf_dir):
    return prompt.stuff_context(search_text(spark, sf_dir))


def fill_template(spark, sf_dir):
    """Each document as context, its source as question."""
    filled = prompt.fill_template(prompt.TEMPLATE, context=F.col("text"), question=F.col("source"))
    return t.table(spark, sf_dir, "documents").select("doc_id", filled.alias("prompt"))


def rag_prompts(spark, sf_dir):
    """Pages to prompts: extract, clean, chunk, index, search, fill in."""
    found = t.chunk_index(spark, sf_dir, t.page_chunks)
    return prompt.prompts(search.retrieve(t.questions(spark, sf_dir), found))


def question_set(spark, sf_dir):
    """The sample questions and the table's questions in one batch."""
    asked = prompt.question_set(spark).unionByName(t.questions(spark, sf_dir))
    found = t.chunk_index(spark, sf_dir, t.document_chunks)
    return search.search_text(asked, found, columns=())


def history_prompts(spark, sf_dir):
    return t.chat_questions(spark, sf_dir).select("qid.conv_id", "qid.turn", "query")


def history_gaps(spark, sf_dir):
    """Every question asked twice in a row, so that user and assistant do not take turns."""
    turns = t.table(spark, sf_dir, "conversations").withColumn("turn", F.col("turn") * 10)
    again = turns.filter("role = 'user'").withColumns({"turn": F.col("turn") + 1, "text": F.concat("text", F.lit(" please"))})
    return prompt.with_history(turns.unionByName(again), t.EXTRA)


def chat_prompts(spark, sf_dir):
    """All turns of all conversations: add history, retrieve, fill in.

    The questions are stored, since retrieval reads them several times and each time their history would be shuffled anew.
    """
    found = t.chunk_index(spark, sf_dir, t.document_chunks)
    path = shared_dir(spark, "chat-questions")
    t.chat_questions(spark, sf_dir).write.parquet(path)
    filled = prompt.prompts(search.retrieve(spark.read.parquet(path), found))
    return filled.select("qid.conv_id", "qid.turn", "prompt")


def answers_extractive(spark, sf_dir):
    found = t.chunk_index(spark, sf_dir, t.document_chunks)
    return answer_extractive(search.retrieve(t.questions(spark, sf_dir), found))


def _load_prompt_lengths(params):
    """Stands in for a model: says how long the prompt is and what answer length it may use."""
    return lambda prompts: [f"{len(text)} of {params['max_tokens']}" for text in prompts]


def answers_model(spark, sf_dir):
    """The plug for models over all prompts, with a stand-in whose answers SQL can check."""
    return answer(rag_prompts(spark, sf_dir), _load_prompt_lengths)


def first_prediction(spark, sf_dir):
    """Each assistant turn, wrapped as a response of the endpoint and unwrapped again."""
    turns = t.table(spark, sf_dir, "conversations").filter("role = 'assistant'")
    response = F.to_json(F.struct(F.array("text").alias("predictions")))
    return turns.select("conv_id", "turn", payload.first_prediction(response).alias("answer"))


def _answer_stream(spark, sf_dir, found, **options):
    """All questions as request files, in two request forms; each delivered twice and beside it a request without a question."""
    requests, out, checkpoint = (shared_dir(spark, f"answers-{part}") for part in ("in", "out", "checkpoint"))
    asked = t.questions(spark, sf_dir)
    body = F.when(F.length("query") > 200, payload.encode_split(F.col("query"))).otherwise(
        payload.encode_inputs(F.col("query"))
    )
    good = asked.select(F.col("qid").alias("request_id"), body.alias("payload"))
    bad = asked.select((-1 - F.col("qid")).alias("request_id"), F.col("query").alias("payload"))
    good.union(good).union(bad).write.json(requests)
    return answer_stream(spark, requests, found, out, checkpoint, **options).select("request_id", "query", "answer", "error")


def answer_stream_rows(spark, sf_dir):
    return _answer_stream(spark, sf_dir, t.chunk_index(spark, sf_dir, t.document_chunks))


def answer_stream_model(spark, sf_dir):
    """The stream with a model over prompts from pages, with the stand-in of `answers_model`."""
    found = t.chunk_index(spark, sf_dir, t.page_chunks)
    return _answer_stream(spark, sf_dir, found, respond=model_responder(_load_prompt_lengths))


def payload_rows(spark, sf_dir):
    """Every question in both request forms, decoded."""
    asked = t.questions(spark, sf_dir).select(
        "qid",
        F.explode(
            F.create_map(
                F.lit("split"), payload.encode_split(F.col("query")),
                F.lit("inputs"), payload.encode_inputs(F.col("query")),
            )
        ).alias("form", "payload"),
    )
    return payload.decode_payload(asked).select("qid", "form", "query")


def data_array(spark, sf_dir):
    """Each document as a search response with a row per line; beside each a response without a result."""
    lines = F.transform(F.split("text", "\n", -1), lambda line, i: F.array(i.cast("string"), line))
    result = F.to_json(F.struct(F.struct(lines.alias("data_array")).alias("result")))
    docs = t.table(spark, sf_dir, "documents")
    responses = docs.select("doc_id", result.alias("response"))
    responses = responses.union(docs.select(-1 - F.col("doc_id"), F.lit("{}")))
    return payload.data_array(responses).select(
        "doc_id", F.get("hit", 0).cast("long").alias("line_no"), F.get("hit", 1).alias("line")
    )


def latest_version(spark, sf_dir):
    versions = t.table(spark, sf_dir, "documents").select(
        F.col("source").alias("name"), F.col("n_chars").cast("string").alias("version")
    )
    return index.latest_version(versions)


def sitemap_urls(spark, sf_dir):
    return pages.sitemap_urls(t.sitemaps(spark, sf_dir))


def page_source(spark, sf_dir):
    """All pages as a crawl that reached them, and each again as one that did not."""
    crawl = shared_dir(spark, "crawl")
    reached = t.table(spark, sf_dir, "pages").withColumn("status", F.lit(200))
    failed = reached.withColumns({"page_id": -1 - F.col("page_id"), "status": F.lit(404)})
    reached.union(failed).write.parquet(crawl)
    return pages.read_pages(spark, crawl)


def article_text(spark, sf_dir):
    found = pages.extract_article(t.page_source(spark, sf_dir), "article", None, None, nested=False)
    return found.select("page_id", "url", "text")


def article_nested(spark, sf_dir):
    """The first advertisement block, by tag and attribute, with blocks inside it."""
    inside = F.replace("html", F.lit(AD), F.lit(AD + NESTED))
    found = pages.extract_article(t.page_source(spark, sf_dir).withColumn("html", inside), "div", "class", "ad")
    return found.select("page_id", "url", "text")


def nonnull_articles(spark, sf_dir):
    """All articles, and beside each a page that had none."""
    articles = article_text(spark, sf_dir)
    return pages.nonnull_articles(articles.union(articles.withColumn("text", F.lit(None).cast("string"))))


def html_markdown(spark, sf_dir):
    return pages.html_to_markdown(t.page_source(spark, sf_dir))


def markdown_nested(spark, sf_dir):
    """Whole pages with their structure: the links of the head of the page, and a list, a table and code put before its foot."""
    before, url, after = (F.lit(part) if i != 1 else F.col("url") for i, part in enumerate(STRUCTURE.partition("{url}")))
    structure = F.concat(before, url, after, F.lit("<footer>"))
    whole = t.page_source(spark, sf_dir).withColumn("html", F.replace("html", F.lit("<footer>"), structure))
    return pages.html_to_markdown(whole, tag=None, nested=True)


def page_range(spark, sf_dir):
    return documents.page_range(t.marked_documents(spark, sf_dir), text_col="md")


QUERIES = {
    "rag_prompts": rag_prompts,
    **{f"clean_t{n:02d}": partial(clean_step, step=n) for n in range(1, len(STEPS) + 1)},
    "clean_all": clean_all,
    "chunk_heading": chunk_heading,
    "chunk_segments": chunk_segments,
    "chunk_json": chunk_json,
    "chunk_tokens": chunk_tokens,
    "chunk_overlap": chunk_overlap,
    "chunk_paragraph": chunk_paragraph,
    "chunk_table": chunk_table_rows,
    "chunk_table_ordered": chunk_table_ordered,
    "embed_terms": embed_terms,
    "embed_query_terms": embed_query_terms,
    "embed_model": embed_model,
    "vector_head": vector_head,
    "index_build": index_build,
    "index_diff": index_diff,
    "index_diff_tree": index_diff_tree,
    "index_sync": index_sync,
    "index_sync_stream": index_sync_stream,
    "index_rebuild": index_rebuild,
    "index_sync_late": index_sync_late,
    "index_sync_nulls": index_sync_nulls,
    "search_text": search_text,
    "search_text_postings": search_text_postings,
    "search_text_weighted": search_text_weighted,
    "search_vector": search_vector,
    "search_approx": search_approx,
    "search_approx_centres": search_approx_centres,
    "search_codes": search_codes,
    "topk": topk_hits,
    "retrieve": retrieve,
    "stuff_context": stuff_context,
    "fill_template": fill_template,
    "question_set": question_set,
    "history_prompts": history_prompts,
    "history_gaps": history_gaps,
    "chat_prompts": chat_prompts,
    "answers_extractive": answers_extractive,
    "answers_model": answers_model,
    "first_prediction": first_prediction,
    "answer_stream": answer_stream_rows,
    "answer_stream_model": answer_stream_model,
    "payload_rows": payload_rows,
    "data_array": data_array,
    "latest_version": latest_version,
    "sitemap_urls": sitemap_urls,
    "page_source": page_source,
    "article_text": article_text,
    "article_nested": article_nested,
    "nonnull_articles": nonnull_articles,
    "html_markdown": html_markdown,
    "markdown_nested": markdown_nested,
    "page_range": page_range,
}
