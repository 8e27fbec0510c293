"""Personal data: pattern spans, and terms that reveal them by corpus co-occurrence. Expressions and joins only."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundline.llm.common import let, stored, whole

KINDS = ("email", "ip", "card", "phone")
TERM = "term"

# The base patterns, in forms that take linear time. A run of characters is tried from its start (or from
# the end of the last match) only, and is never given back.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
# What a text must hold to be searched at all.
HINTS = {
    "email": r"@[A-Za-z0-9-]",
    "ip": r"[0-9]\.[0-9]",
    "card": r"[0-9](?:[ -]?[0-9]){12}",
    "phone": r"\+[0-9]",
}
IP_PART = r"0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"

TOKEN = r"[\p{L}\p{N}]+"
NO_TOKEN = r"[^\p{L}\p{N}]+"
MIN_TERM = 3  # characters; one that holds a letter of another script than Latin needs no more than itself
OTHER_LETTER = r"[\p{L}&&[^\p{IsLatin}]]"
CONTEXT = 80  # characters around a span that tests count by hand; co-occurrence has no such bound
THRESHOLD = 0.9  # share of an entity's information that a term may not reach
SUPPORT = 2  # documents that a term and an entity share
BROADCAST_ROWS = 200_000  # findings of documents that are sent to all tasks; more are joined by shuffle
CHUNK = 256  # matches whose positions are summed one by one
BROADCAST_TERMS = 200_000  # terms that are sent to all tasks; more are joined by shuffle

SPAN = "struct<kind:string,start:bigint,end:bigint,value:string>"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the check sum of a string of digits is a multiple of ten."""
    numbers = F.transform(F.split(F.reverse(digits), ""), lambda d: F.try_to_number(d, F.lit("9")).cast("int"))

    def worth(d: Column, i: Column) -> Column:
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when(i % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.transform(F.filter(numbers, lambda d: d.isNotNull()), worth), F.lit(0), lambda a, b: a + b) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    n = F.length(_digits(match))
    if kind == "ip":
        return match.rlike(rf"^{IP_PART}(?:\.{IP_PART}){{3}}$")
    if kind == "card":
        return F.when(n.between(13, 19), _luhn(_digits(match))).otherwise(False)
    if kind == "phone":
        return n.between(9, 15)
    return F.lit(True)


def _placed(kind: str, text: Column, pattern: str, keeps) -> Column:
    """Spans of those matches of a pattern for which `keeps(match)` holds, in order.

    Positions are running sums of the lengths of matches and of the gaps between them, taken in chunks: sums over chunks
    first, then inside each chunk, so that no long array is built element by element.
    """
    both = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("matches"), F.split(text, pattern, -1).alias("gaps"))
    empty = F.array().cast(f"array<{SPAN}>")
    zero = F.lit(0).cast("long")

    def lengths(found: Column) -> Column:
        gap = lambda i: F.length(F.get(found["gaps"], i)).cast("long")
        return F.transform(
            found["matches"], lambda m, i: F.struct(gap(i).alias("gap"), F.length(m).cast("long").alias("own"), m.alias("value"))
        )

    def chunks(xs: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / CHUNK).cast("int"))
        return F.transform(numbers, lambda c: F.slice(xs, c * CHUNK + 1, F.lit(CHUNK)))

    def begins(parts: Column) -> Column:
        """Where each chunk begins in the text."""
        sums = F.transform(parts, lambda part: F.aggregate(part, zero, lambda n, x: n + x["gap"] + x["own"]))
        first = F.array(zero)
        return F.aggregate(sums, first, lambda acc, n: F.concat(acc, F.array(F.get(acc, F.size(acc) - 1) + n)))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["gap"]
        span = F.struct(F.lit(kind).alias("kind"), begin.alias("start"), (begin + x["own"]).alias("end"), x["value"].alias("value"))
        kept = F.when(keeps(x["value"]), F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"])
        return F.struct((begin + x["own"]).alias("at"), kept.alias("spans"))

    def of_chunks(parts: Column) -> Column:
        def one(part: Column, begin: Column) -> Column:
            return F.aggregate(part, F.struct(begin.alias("at"), empty.alias("spans")), step, lambda acc: acc["spans"])

        return let(begins(parts), lambda at: F.flatten(F.transform(parts, lambda part, i: one(part, F.get(at, i)))))

    def place(xs: Column) -> Column:
        return F.when(F.size(xs) > 0, let(chunks(xs), of_chunks)).otherwise(empty)

    return let(let(both, lengths), place)


def spans_of(kind: str, text: Column) -> Column:
    """Valid spans of one kind, leftmost and without overlap, in order. Failing matches are dropped, not tried again."""
    found = _placed(kind, text, PATTERNS[kind], lambda match: _valid(kind, match))
    return F.when(text.rlike(HINTS[kind]), found).otherwise(F.array().cast(f"array<{SPAN}>"))


def base_spans(text: Column) -> Column:
    """All base spans of a text: by kind as listed, then by start. Positions are code points, the end exclusive."""
    return F.concat(*[spans_of(kind, text) for kind in KINDS])


def terms(text: Column) -> Column:
    """Distinct terms of a text: runs of letters and digits in lower case, of MIN_TERM characters or with a letter that is not Latin."""
    listed = lambda t: (F.length(t) >= MIN_TERM) | t.rlike(OTHER_LETTER)
    return F.array_distinct(F.filter(F.split(F.lower(text), NO_TOKEN, -1), listed))


def outside_terms(text: Column, spans: Column) -> Column:
    """Terms of a text without its spans."""
    return terms(_replaced(text, spans, lambda span: F.lit(" ")))


def _keyed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    text = whole(F.col(text_column))
    return docs.select(F.col(id_column).alias("doc_id"), text.alias("text"), F.md5(text.cast("binary")).alias("key"))


def _among(exploded: DataFrame, listed: DataFrame, n: int) -> DataFrame:
    """Rows of `exploded(.., term)` whose term is listed: a broadcast up to a counted number of terms, a shuffle beyond."""
    return exploded.join(F.broadcast(listed) if n <= BROADCAST_TERMS else listed, "term", "left_semi")


def _small(listed: DataFrame, most: int) -> DataFrame:
    """A stored table to join with: sent to all tasks up to a counted number of rows, by shuffle beyond."""
    return F.broadcast(listed) if listed.count() <= most else listed


def disclosing_terms(rows: DataFrame, found: DataFrame, threshold: float = THRESHOLD, support: int = SUPPORT) -> DataFrame:
    """`(term)`: what reveals some protected entity more than the threshold allows.

    `rows(text)` are all documents, `found(doc_id, key, text, base)` those with base spans. An entity is a kind and value.
    With document frequencies f and N documents, a term t discloses an entity e if

        PMI(t; e) = log(N f(t, e) / (f(t) f(e)))  >=  threshold * IC(e),    IC(e) = log(N / f(e)),

    f(t, e) counting documents that hold e, and t outside their base spans, at any distance. Pairs with less than `support`
    documents are no estimate. f(t, e) <= f(e), so a term with f(t) > f(e)^threshold N^(1 - threshold) cannot disclose e:
    frequent terms drop out before pairs are formed, and no pair is lost by it.
    """
    entity = F.transform("base", lambda span: F.xxhash64(span["kind"], span["value"]))
    entities = stored(found.select("doc_id", "key", F.explode(F.array_distinct(entity)).alias("entity")).distinct(), "pii-entities")
    counts = stored(entities.groupBy("entity").agg(F.count("*").alias("f_entity")).filter(F.col("f_entity") >= support), "pii-counts")
    entities = stored(entities.join(_small(counts, BROADCAST_ROWS), "entity"), "pii-shared")
    most = stored(entities.groupBy("doc_id", "key").agg(F.max("f_entity").alias("most")).toDF("of", "of_key", "most"), "pii-most")
    here = F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("key") == F.col("of_key"))
    held = found.select("doc_id", "key", outside_terms(F.col("text"), F.col("base")).alias("terms")).join(_small(most, BROADCAST_ROWS), here)
    held = stored(held.select("doc_id", "key", "most", F.explode("terms").alias("term")).distinct(), "pii-held")
    candidates = held.groupBy("term").agg(F.max("most").alias("most"), F.count("*").alias("n")).filter(F.col("n") >= support).drop("n")
    candidates = stored(candidates, "pii-candidates")
    exploded = rows.select(F.explode(terms(F.col("text"))).alias("term"))
    if (listed := candidates.count()) <= BROADCAST_TERMS:  # else all terms are counted, which are summed in the tasks too
        exploded = _among(exploded, candidates, listed)
    n = rows.count()

    def possible(f_entity: str) -> Column:
        bound = F.pow(F.col(f_entity).cast("double"), F.lit(threshold)) * F.pow(F.lit(float(n)), F.lit(1 - threshold))
        return F.col("f_term") <= bound * (1 + 1e-9)

    frequencies = exploded.groupBy("term").agg(F.count("*").alias("f_term"))
    rare = stored(frequencies.join(candidates, "term").filter(possible("most")).select("term", "f_term"), "pii-rare")
    near = held.select("doc_id", "key", "term").join(_small(rare, BROADCAST_TERMS), "term")
    with_entity = entities.withColumnsRenamed({"doc_id": "of", "key": "of_key"})
    pairs = near.join(with_entity, here & possible("f_entity")).groupBy("entity", "term", "f_entity", "f_term").agg(F.count("*").alias("f_both"))
    pmi = F.log(F.lit(float(n)) * F.col("f_both") / (F.col("f_term") * F.col("f_entity")))
    information = F.log(F.lit(float(n)) / F.col("f_entity"))
    risky = pairs.filter((F.col("f_both") >= support) & (information > 0) & (pmi >= threshold * information))
    return stored(risky.select("term").distinct(), "pii-terms")


def term_spans(text: Column, listed: Column, base: Column) -> Column:
    """Spans of the tokens whose lower case is listed, in order, but those that touch a base span."""
    def free(span: Column) -> Column:
        return ~F.exists(base, lambda b: (b["start"] < span["end"]) & (span["start"] < b["end"]))

    return F.filter(_placed(TERM, text, TOKEN, lambda token: F.array_contains(listed, F.lower(token))), free)


def find(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """`docs` with `base` and `extra`, arrays of spans (kind, start, end, value): pattern spans and disclosing terms.

    Texts are read once for the spans, once for term frequencies and once for the result. A row is known by its id and the
    md5 of its text, so repeated rows and repeated ids get what belongs to their text. A missing text counts as empty; it
    and texts without findings have empty arrays. Only documents that hold a disclosing term are joined; no rows, no rows.
    """
    rows = _keyed(docs, id_column, text_column)
    found = rows.withColumn("base", base_spans(F.col("text"))).filter(F.size("base") > 0)
    found = stored(found, "pii-found")
    listed = disclosing_terms(rows, found, **options)
    exploded = rows.select("doc_id", "key", F.explode(terms(F.col("text"))).alias("term"))
    hits = _among(exploded, listed, listed.count()).groupBy("doc_id", "key").agg(F.collect_set("term").alias("listed"))
    # what is known of the few documents that hold anything: base spans and terms
    known = (
        found.select("doc_id", "key", "base").distinct()
        .join(hits, found["doc_id"].eqNullSafe(hits["doc_id"]) & (found["key"] == hits["key"]), "full")
        .select(
            F.coalesce(found["doc_id"], hits["doc_id"]).alias("of"),
            F.coalesce(found["key"], hits["key"]).alias("of_key"),
            "base",
            "listed",
        )
    )
    known = stored(known, "pii-known")
    names = [c for c in docs.columns if c not in ("base", "extra")]
    text = whole(F.col(text_column))
    row = docs.select(F.struct(*names).alias("row"), F.col(id_column).alias("doc_id"), text.alias("text"), F.md5(text.cast("binary")).alias("key"))
    few = F.broadcast(known) if known.count() <= BROADCAST_ROWS else known
    joined = row.join(few, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("key") == F.col("of_key")), "left")
    empty = F.array().cast(f"array<{SPAN}>")
    base = F.coalesce("base", empty)
    extra = F.when(F.col("listed").isNotNull(), term_spans(F.col("text"), F.col("listed"), base)).otherwise(empty)
    return joined.select("row.*", base.alias("base"), extra.alias("extra"))


def listing(spans: Column) -> Column:
    """`kind:start:end` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _replaced(text: Column, spans: Column, name) -> Column:
    """The text with `name(span)` in place of every span. Spans that overlap are one, named after the first."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["end"], s["kind"])))
    one = "array<struct<start:bigint,end:bigint,kind:string>>"

    def join(acc: Column, s: Column) -> Column:
        last = F.get(acc, F.size(acc) - 1)
        wider = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"), last["kind"].alias("kind"))
        grown = F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(wider))
        return F.when((F.size(acc) > 0) & (s["start"] < last["end"]), grown).otherwise(F.concat(acc, F.array(s)))

    merged = F.aggregate(ordered.cast(one), F.array().cast(one), join)

    def rebuilt(parts: Column) -> Column:
        begin = lambda i: F.coalesce(F.get(parts, i - 1)["end"], F.lit(0).cast("long"))
        cut = F.transform(parts, lambda s, i: F.concat(F.substring(text, (begin(i) + 1).cast("int"), (s["start"] - begin(i)).cast("int")), name(s)))
        tail = F.substring(text, (begin(F.size(parts)) + 1).cast("int"), F.length(text))
        return F.concat(F.array_join(cut, ""), tail)

    return F.when(F.size(spans) > 0, let(merged, rebuilt)).otherwise(text)


def sanitised(text: Column, spans: Column) -> Column:
    """The text with every span generalised to its kind, `<EMAIL>`; a disclosing term is removed as `<REMOVED>`.

    Spans of different kinds that overlap are one, named after the first.
    """
    name = lambda s: F.when(s["kind"] == TERM, F.lit("<REMOVED>")).otherwise(F.concat(F.lit("<"), F.upper(s["kind"]), F.lit(">")))
    return _replaced(text, spans, name)


def n_of(kind: str, spans: Column) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
