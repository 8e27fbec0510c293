"""HTML elements and Markdown as column expressions."""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from groundline.functions.text import let, strip

# Elements that never have a closing tag.
VOID_ELEMENTS = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)

# (pattern, replacement) pairs that turn the tags of an HTML fragment into Markdown, in order.
_ATTRS = r"(?:\s[^>]*)?"
TAG_RULES = (
    *((rf"(?i)<h{n}{_ATTRS}>", "\n\n" + "#" * n + " ") for n in range(1, 7)),
    (r"(?i)</h[1-6]\s*>", "\n\n"),
    (r"(?i)</?(?:b|strong)" + _ATTRS + r">", "**"),
    (r"(?i)</?(?:i|em)" + _ATTRS + r">", "*"),
    (r"(?i)</?code" + _ATTRS + r">", "`"),
    (r"(?i)<br" + _ATTRS + r"/?>", "\n"),
    (r"(?i)<li" + _ATTRS + r">", "\n- "),
    (r"(?i)<tr" + _ATTRS + r">", "\n|"),
    (r"(?i)<t[dh]" + _ATTRS + r">", " "),
    (r"(?i)</t[dh]\s*>", " |"),
    (r"(?i)</?(?:p|div|ul|ol|table|article|section)" + _ATTRS + r">", "\n\n"),
    (r"<[^>]*>", ""),
)
LINE_RULES = ((r" ?\n ?", "\n"), (r"\n\n\n+", "\n\n"))

# Entities, `&amp;` last so that `&amp;lt;` ends as `&lt;`.
ENTITIES = (
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&apos;", "'"),
    ("&nbsp;", " "),
    ("&mdash;", "\u2014"),
    ("&ndash;", "\u2013"),
    ("&hellip;", "\u2026"),
    ("&lsquo;", "\u2018"),
    ("&rsquo;", "\u2019"),
    ("&ldquo;", "\u201c"),
    ("&rdquo;", "\u201d"),
    ("&amp;", "&"),
)


def _split_after_last(text: Column, closer: str, body) -> Column:
    """`body(head, tail)`, where the head ends with the last match of `closer` (NULL if there is none)."""

    def parts(t: Column) -> Column:
        head = F.regexp_substr(t, F.lit(rf"(?is)^.*{closer}"))
        return let(head, lambda h: body(h, F.substring(t, F.length(h) + 1, F.length(t))))

    return let(text, parts)


def _delete_closed(text: Column, opener: str, closer: str) -> Column:
    """Delete from each opener to the next closer. Only text up to the last closer is searched: there, every opener has one."""
    pattern = rf"(?is){opener}.*?{closer}"

    def deleted(t: Column) -> Column:
        cut = _split_after_last(t, closer, lambda head, tail: F.concat(F.regexp_replace(head, pattern, ""), tail))
        return F.coalesce(cut, t)

    return let(text, deleted)


def flat_element(html: Column, tag: str) -> Column:
    """First `<tag>` element with its markup, for a tag that does not nest in itself; else NULL."""
    closer = rf"</{tag}\s*>"
    pattern = F.lit(rf"(?is)<{tag}(?:\s[^>]*)?>.*?{closer}")
    return strip(_split_after_last(html, closer, lambda head, _: F.regexp_substr(head, pattern)))


def _numbered_references(text: Column) -> Column:
    """`&#8217;` and `&#x2019;` as characters; numbers beyond the code space stay as they are."""
    number = F.lit(r"&#([xX][0-9a-fA-F]{1,6}|[0-9]{1,7});")

    def character(reference: Column) -> Column:
        is_hex = F.lower(F.substring(reference, 3, 1)) == "x"
        digits = F.when(is_hex, F.regexp_extract(reference, r"([0-9a-fA-F]+);", 1)).otherwise(F.regexp_extract(reference, r"([0-9]+);", 1))
        code = F.conv(digits, 16, 10).cast("long")
        code = F.when(is_hex, code).otherwise(F.conv(digits, 10, 10).cast("long"))
        valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        point = F.when(valid, code).otherwise(F.lit(63).cast("long"))
        return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32")).otherwise(reference)

    def joined(x: Column) -> Column:
        def woven(characters: Column) -> Column:
            return F.transform(x["between"], lambda part, i: F.concat(part, F.coalesce(F.get(characters, i), F.lit(""))))

        return F.array_join(let(F.transform(x["found"], character), woven), "")

    def replaced(t: Column) -> Column:
        both = F.struct(F.regexp_extract_all(t, number, F.lit(0)).alias("found"), F.split(t, number, -1).alias("between"))
        return F.when(t.contains("&#"), let(both, joined)).otherwise(t)

    return let(text, replaced)


def to_markdown(fragment: Column) -> Column:
    """Headings, emphasis, lists, line breaks and table rows of an HTML fragment as Markdown.

    Linear in the text: what needs a closer is searched only up to the last one, tags only up to the last `>`.
    """
    text = _delete_closed(fragment, "<!--", "-->")
    for tag in ("script", "style"):
        text = _delete_closed(text, rf"<{tag}{_ATTRS}>", rf"</{tag}\s*>")
    text = F.regexp_replace(text, r"[ \t\r\n]+", " ")

    def tags(x: Column) -> Column:
        tail = F.substring_index(x, ">", -1)
        head = F.substring(x, F.lit(1), F.length(x) - F.length(tail))
        return F.concat(reduce(lambda acc, rule: F.regexp_replace(acc, *rule), TAG_RULES, head), tail)

    text = let(text, tags)
    for pattern, replacement in LINE_RULES:
        text = F.regexp_replace(text, pattern, replacement)
    text = _numbered_references(text)
    for entity, character in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(character))
    return strip(text)


# What a piece of a page lies in, as the run over the pieces sees it.
TEXT, TAG, DOUBLE, SINGLE, COMMENT, DECLARATION, RAW = range(7)
RAW_ELEMENTS = ("script", "style")


def _pieces(html: Column, attr: str | None, value: str | None) -> Column:
    """The page cut before every `<`, `>` and quote; for each piece its first character, length and what the run asks of it."""
    mark = F.lit(r"[<>\"'][^<>\"']*+|[^<>\"']++")
    before = r"(?is)[\s/\"']" + _quoted(attr or "") + r"\s*+=\s*+"

    def features(p: Column) -> Column:
        first = F.substring(p, 1, 1)
        name = F.lower(F.regexp_extract(p, r"^<(/?[a-zA-Z][^\s/]*+)", 1))
        kind = (
            F.when(first != "<", TEXT)
            .when(name != "", TAG)
            .when(p.startswith("<!--"), COMMENT)
            .when(p.rlike("^<[!?/]."), DECLARATION)
            .otherwise(TEXT)
        )
        return F.struct(
            first.alias("first"),
            F.length(p).alias("length"),
            name.alias("name"),
            kind.alias("kind"),
            p.rlike(r"=\s*+$").alias("equals"),  # a quote after it begins a value
            p.endswith("/").alias("slash"),
            p.endswith("--").alias("dashes"),
            (F.lit(False) if attr is None else p.rlike(before + "$")).alias("asks"),  # the next quote holds the wanted attribute
            (F.lit(False) if attr is None else p.rlike(before + _quoted(value or "") + r"(?:\s|/?$)")).alias("bare"),  # the value without quotes
            (F.lit(False) if attr is None else F.substring(p, F.lit(2), F.length(p)) == F.lit(value or "")).alias("is_value"),
        )

    return F.transform(F.regexp_extract_all(html, mark, F.lit(0)), features)


def _quoted(text: str) -> str:
    """A text as a pattern that matches itself."""
    return r"\Q" + text.replace(r"\E", r"\E\\E\Q") + r"\E"


def _step(tag: str, any_tag: bool):
    """One piece of the run: a struct of the run so far and a piece to the struct after it."""
    closing = "/" + tag

    def step(run: Column, p: Column) -> Column:
        mode, first = run["mode"], p["first"]
        opens = (mode == TEXT) & (p["kind"] == TAG) | (mode == RAW) & (p["name"] == F.concat(F.lit("/"), run["name"]))
        in_tag = mode == TAG
        closes = in_tag & (first == ">")
        quote = in_tag & run["equals"]
        raw = run["name"].isin(*RAW_ELEMENTS) & ~run["slash"]
        after = (
            F.when(opens, TAG)
            .when(mode == TEXT, p["kind"])
            .when(closes, F.when(raw, RAW).otherwise(TEXT))
            .when(quote & (first == '"'), DOUBLE)
            .when(quote & (first == "'"), SINGLE)
            .when((mode == DOUBLE) & (first == '"') | (mode == SINGLE) & (first == "'"), TAG)
            .when((mode == COMMENT) & (first == ">") & run["dashes"] | (mode == DECLARATION) & (first == ">"), TEXT)
            .otherwise(mode)
        )
        value_ends = (mode == DOUBLE) & (first == '"') | (mode == SINGLE) & (first == "'")
        hit = F.when(opens, p["bare"]).otherwise(run["hit"] | value_ends & run["maybe"] | (in_tag | value_ends) & ~closes & p["bare"])
        begins = closes & (run["name"] == tag) & (run["depth"] == 0) & (F.lit(any_tag) | run["hit"])
        deeper = closes & (run["name"] == tag) & (run["depth"] > 0) & ~run["slash"]
        ends = closes & (run["name"] == closing) & (run["depth"] > 0)
        void = F.lit(tag in VOID_ELEMENTS)
        here = run["at"] + 1  # behind the `>`
        depth = run["depth"] + F.when(begins | deeper, 1).when(ends, -1).otherwise(0)
        changed = F.struct(
            after.alias("mode"),
            (run["at"] + p["length"]).alias("at"),
            F.when(opens, run["at"]).otherwise(run["tag_at"]).alias("tag_at"),
            F.when(opens, p["name"]).otherwise(run["name"]).alias("name"),
            hit.alias("hit"),
            (quote & run["asks"] & p["is_value"]).alias("maybe"),
            p["equals"].alias("equals"),
            p["asks"].alias("asks"),
            p["slash"].alias("slash"),
            p["dashes"].alias("dashes"),
            depth.alias("depth"),
            F.when(begins, run["tag_at"]).otherwise(run["start"]).alias("start"),
            F.when(begins & void | ends & (run["depth"] == 1), here).otherwise(run["stop"]).alias("stop"),
        )
        return F.when(run["stop"] >= 0, run).otherwise(changed)

    return step


def nested_element(html: Column, tag: str, attr: str | None = None, value: str | None = None) -> Column:
    """First element of a tag that may nest in itself, such as `div[itemprop=articleBody]`, with its markup; else NULL.

    The page is cut before every `<`, `>` and quote by one linear pattern, and one run over the pieces carries what they lie
    in (a tag, a quoted value, a comment, a declaration, script or style) and the depth: no Python, and time grows with the
    page, whatever is opened and never closed in it. An element that is never closed reaches to the end of the page, a tag
    without its `>` is none. Attribute values are compared as they stand, without character references.
    """
    tag = tag.lower()
    if attr is not None and set(value or "") & set("<>\"'"):
        raise ValueError("an attribute value with <, > or a quote cannot be asked for")
    start = F.struct(
        F.lit(TEXT).alias("mode"), F.lit(0).alias("at"), F.lit(0).alias("tag_at"), F.lit("").alias("name"),
        *[F.lit(False).alias(c) for c in ("hit", "maybe", "equals", "asks", "slash", "dashes")],
        F.lit(0).alias("depth"), F.lit(-1).alias("start"), F.lit(-1).alias("stop"),
    )

    def cut(x: Column) -> Column:
        end = F.when(x["run"]["stop"] >= 0, x["run"]["stop"]).otherwise(F.length(x["html"]))
        first = x["run"]["start"]
        return F.when(first >= 0, strip(F.substring(x["html"], first + 1, end - first)))

    run = F.aggregate(_pieces(html, attr, value), start, _step(tag, attr is None))
    return F.when(html != "", let(F.struct(html.alias("html"), run.alias("run")), cut))
