"""HTML extraction: page structure first, the host's suffix array for what structure leaves open.

A page is cut into blocks of text at block-level tags. Text under scripts, styles, forms, menus,
headers, footers, sidebars, and under containers whose class, id or role names an advert, notice,
sidebar, comment section or the like is never main text, inside an article or beside it; inside one
a name with words of any other kind (``share-of-market``) names its topic. Layouts bear
such names too: outside an article, names that only say what a wrapper has (``has-sidebar``) don't
count; an ``article`` or ``main`` inside a container named as a sidebar, notice, menu or the like
is still the page's article if no other is marked; and where such menus, headers, widgets (not
adverts, notices, sidebars, comments) hold all the open text, it stays open. Other text inside an ``article`` or ``main`` element that
remains is the article. Articles are copied between pages of one host and share sentences, so in
them only the ranks below take out what most of the host's articles hold.

All other text is open. The open text of a host's pages makes streams of words; equal ones are one
stream, and streams whose sets of ``NEAR_WORDS``-word sequences have a Jaccard of ``NEAR_PERCENT`` or
more (and what they are tied to in turn) count as one page: copies under other ids or with small edits
prove nothing against their text. The suffix ranks of a host's streams (:mod:`suffixes`; the host is
mixed into each symbol, so streams of different hosts never agree) show the word sequences of ``long``
or more that repeat. Of a host with D distinct pages that have ``long`` open words or more, a sequence
is boilerplate if it occurs on ``share`` percent of them (rounded up) and on at least three; with D = 2
on both; with D = 1 nothing is. Words covered by one are no main text. For a page without an article
the open words that are left are its main text; for a page with an article they are dropped, but
its open text still serves as evidence for its host. Open text of hosts whose pages all mark an
article is not ranked, as none of it can be main text.

The ranks judge the articles of every host as well, apart from open text: of a host with D different
articles of ``long`` words or more, a sequence is boilerplate if it occurs on more than ``template``
percent of them and on at least three; near copies are one occurrence, but count one by one in D, so
they prove nothing against their text. Which words can lie in such a sequence at all is told first by
a fixed number of counters of sequences; the ranks then see these words alone. The counters only save
work: a counter is never less than the number of articles with a sequence.

Defined results: null or empty html gives an empty text; a page with null page_id or url is
extracted all the same (its host is ''); pages whose open text is equal or
nearly equal are no evidence against each other; markup that is not closed ends with the page; repeated
rows are extracted each; very long pages are read in one pass, in time linear in their length, one page
in memory at a time; columns other than the three named are not read, whatever their names; an empty
table gives an empty table.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from .op1_ngram_join import ngram_components, sliced, total_counts
from .shared import map_arrow, staged, texts, utf8
from .suffixes import suffix_ranks

# Element names of the HTML standard.
RAW_TEXT = ("script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp", "noembed", "noframes")
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr", "param")
INLINE = ("a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i",
          "ins", "kbd", "label", "mark", "nobr", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike",
          "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "img")
# Elements that never hold main text, and elements that mark it.
ASIDE = ("nav", "footer", "aside", "form", "button", "select", "svg", "dialog", "head", "menu", "object", "canvas",
         "audio", "video", "fieldset", "datalist")
MAIN = ("article", "main")
# Words of class, id and role names that mark what is not the article.
ASIDE_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|cookies?|consent|notice|newsletter|subscri\w+|"
    r"popup|modal|overlay|comments?|respond|replies|disqus|sidebar|related|recommend\w*|share|sharing|social|"
    r"breadcrumbs?|pagination|pager|menu|nav|navbar|navigation|footer|header|masthead|toolbar|widget|login|signup|"
    r"contentinfo|complementary|search)(?:$|[\s_-])", re.I)

# Open streams that agree so far count as one page.
NEAR_WORDS, NEAR_PERCENT = 5, 80
# Hosts that share a slot share the least number of articles that any of them asks for, in the counters' test alone.
HOST_SLOTS = 1 << 16
# Counters of word sequences: a fixed size, whatever the corpus.
COUNTERS = 1 << 21
_MIX = np.uint64(0x9E3779B97F4A7C15)

# Outside an article: of these nothing is main text, not even an article inside; of these an article
# inside may be; of the other names above, also the text if the page has no other.
NEVER_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|cookies?|consent|popup|comments?|respond|replies|disqus|"
    r"related|recommend\w*)(?:$|[\s_-])", re.I)
PANEL_NAMES = re.compile(
    r"(?:^|[\s_-])(?:banner|notice|newsletter|subscri\w+|sidebar|complementary)(?:$|[\s_-])", re.I)
# Names that say what a wrapper has or lacks, not what it is.
WRAPPER_NAMES = re.compile(r"(?:^|[_-])(?:has|with|without|no|hide|show)[_-]", re.I)
# Start tags that end an open paragraph.
ENDS_P = ("address", "article", "aside", "blockquote", "details", "div", "dl", "fieldset", "figure", "footer", "form",
          "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "menu", "nav", "ol", "p", "pre", "section", "table", "ul")

# Words that stand beside those names in the name of a container; any other word says that it is text.
CONTAINER_WORDS = frozenset(
    "area bar block body bottom box btn button buttons card cards col column container content el footer form frame "
    "google grid group head header holder icon icons inline inner item items layout left link links list main module "
    "outer page panel post posts right row section site slot story stories strip tag tags text title top unit view "
    "wrap wrapper articles author form count".split())

# A quote opens a value straight after "=" alone; anywhere else it is a character like any other.
_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)"""
    r"""((?:[^>=]++|=\s*+(?:"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z)|[^\s>"'][^\s>]*+|(?=>|\Z)))*+)(?:>|\Z)""",
    re.S)
_NAMES = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)(?:hidden(?=[\s=/]|$)|aria-hidden\s*=\s*[\"']?true)", re.I)
_SPACE = re.compile(r"\s+")
_HOST = re.compile(r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)")
_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW_TEXT}


def blocks_of(page: str) -> list[tuple[str, str]]:
    """(zone, text) of the page's blocks in order; zone is ``main``, ``aside`` or ``open``."""
    out: list[tuple[str, str]] = []
    parts: list[str] = []
    # open elements, the zone inside them, and how many of them are left without the inline ones on top
    stack: list[tuple[str, str, int]] = []
    still_open: Counter[str] = Counter()
    zone = "open"

    def close_block() -> None:
        if parts:
            text = _SPACE.sub(" ", entities.unescape("".join(parts))).strip()
            parts.clear()
            if text:
                out.append((zone, text))

    at, size = 0, len(page)
    while at < size:
        m = _TOKEN.search(page, at)
        if m is None:
            parts.append(page[at:])
            break
        if m.start() > at:
            parts.append(page[at:m.start()])
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if name in RAW_TEXT and not m[1]:
            end = _END[name].search(page, at)
            at = end.start() if end else size
            continue
        if name not in INLINE:
            close_block()
        if m[1]:
            if still_open[name]:
                while True:
                    ended = stack.pop()[0]
                    still_open[ended] -= 1
                    if ended == name:
                        break
                outside = stack[-1][1] if stack else "open"
                if outside != zone:
                    close_block()
                zone = outside
        elif name not in VOID:
            if name in ENDS_P:
                k = stack[-1][2] if stack else 0
                if k and stack[k - 1][0] == "p":
                    still_open.subtract(x[0] for x in stack[k - 1:])
                    del stack[k - 1:]
                    zone = stack[-1][1] if stack else "open"
            inside = _zone_inside(name, m[3], zone)
            if inside != zone:
                close_block()
            # only what changes the zone, or could close it, need be remembered
            if inside != zone or name in MAIN or name in ASIDE or name in ("div", "section", "header", "span", "ul", "p"):
                above = stack[-1][2] if stack else 0
                stack.append((name, inside, above if name in INLINE else len(stack) + 1))
                still_open[name] += 1
            zone = inside
    close_block()
    zones = {z for z, _ in out}
    # what the zones of named containers come to is known at the page's end
    final = {"inner": "aside" if "main" in zones else "main", "panel": "aside",
             "side": "aside" if zones & {"main", "inner", "open"} else "open"}
    return [(final.get(z, z), text) for z, text in out]


def names_container(name: str) -> bool:
    """Whether one class, id or role says that an element is an aside: it has one of the words, and no other
    words than such ones, numbers and those of containers (``share-buttons``, not ``share-of-market``)."""
    parts = [x for x in re.split(r"[\W_]+", name.lower()) if x]
    found = [bool(ASIDE_NAMES.search(x)) for x in parts]
    return any(found) and all(f or x in CONTAINER_WORDS or x.isdigit() for f, x in zip(found, parts))


def _zone_inside(name: str, attributes: str, zone: str) -> str:
    if zone == "aside":
        return zone
    if name in ASIDE or _HIDDEN.search(attributes):
        return "aside"
    in_article = zone in ("main", "inner")
    if name == "header":
        # a header inside the article holds its title
        return zone if in_article else "aside"
    if name in ("html", "body"):
        return zone
    named = [a or b or c for a, b, c in _NAMES.findall(attributes)] if "=" in attributes else []
    if any(map(ASIDE_NAMES.search, named)):
        if in_article:
            return "aside" if any(names_container(x) for names in named for x in names.split()) else zone
        if name not in ("div", "section", "p", "span"):
            return "aside"
        named = [x for names in named for x in names.split() if not WRAPPER_NAMES.search(x)]
        if any(map(NEVER_NAMES.search, named)):
            return "aside"
        if zone == "panel" or any(map(PANEL_NAMES.search, named)):
            return "panel"
        return "side" if any(map(ASIDE_NAMES.search, named)) else zone
    if name in MAIN and not in_article:
        return "inner" if zone in ("panel", "side") else "main"
    return zone


def split_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                html_col: str = "html") -> DataFrame:
    """(page, copy, url, host, main, open): a page's article, null if it marks none, and its open text."""
    schema = "page long, url string, copy long, host string, main string, open string"

    def cut(batch: pa.RecordBatch):
        main, open_, host = [], [], []
        for page, url in zip(texts(batch.column("html")), texts(batch.column("url"))):
            blocks = blocks_of(page)
            marked = [t for z, t in blocks if z == "main"]
            main.append(" ".join(marked) if marked else None)
            open_.append(" ".join(t for z, t in blocks if z == "open"))
            m = _HOST.match(url)
            host.append(m[1].lower() if m else "")
        keep = {c: batch.column(c) for c in ("page", "url", "copy")}
        yield pa.RecordBatch.from_pydict(
            {**keep, "host": host, "main": pa.array(main, pa.string()), "open": open_})

    rows = pages.select(
        F.col(id_col).cast("long").alias("page"),
        F.col(url_col).cast("string").alias("url"), F.xxhash64(F.col(html_col)).alias("copy"),
        F.col(html_col).cast("string").alias("html"))
    return map_arrow(rows, cut, schema)


def _sequence_slots(host: bytes, text: bytes, long: int) -> np.ndarray:
    """The counters of an article's sequences of ``long`` words, by their first word's place."""
    words = text.split(b" ")
    out, size = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words)), 1
    while size < long:
        ahead = min(size, long - size)
        out = out[:max(len(out) - ahead, 0)] * _MIX + out[ahead:]
        out ^= out >> np.uint64(29)
        size += ahead
    out = (out ^ np.uint64(xxh3_64_intdigest(host))) * _MIX >> np.uint64(32)
    return (out % np.uint64(COUNTERS)).astype(np.int64)


def asked_articles(articles: DataFrame, needs: DataFrame, long: int) -> DataFrame:
    """(stream, host, text, ask): the articles that can hold boilerplate of their host, once each, and the
    places of the words that can lie in it. Input: articles (stream, host, text), needs (host, need)."""
    spark = articles.sparkSession

    def count(batches):
        counters = np.zeros(COUNTERS, np.uint32)
        for batch in batches:
            for host, text in zip(utf8(batch.column("host")), utf8(batch.column("text"))):
                counters[np.unique(_sequence_slots(host, text, long))] += 1
        yield pa.RecordBatch.from_arrays(sliced(counters), names=["slice", "counts"])

    total = total_counts(articles.select("host", "text").mapInArrow(count, "slice int, counts binary"), COUNTERS).astype(np.uint32)
    slot = F.pmod(F.xxhash64("host"), F.lit(HOST_SLOTS)).cast("int").alias("slot")
    found = needs.groupBy(slot).agg(F.min("need").alias("need")).toArrow()
    least = np.full(HOST_SLOTS, np.iinfo(np.int64).max)
    least[found.column("slot").to_numpy()] = found.column("need").to_numpy()
    shared = spark.sparkContext.broadcast((total, least))

    def pick(batch: pa.RecordBatch):
        total, least = shared.value
        columns = [utf8(batch.column("host")), utf8(batch.column("text")), batch.column("slot").to_pylist()]
        ask = []
        for host, text, slot in zip(*columns):
            at = np.flatnonzero(total[_sequence_slots(host, text, long)] >= least[slot])
            ask.append(np.unique(at[:, None] + np.arange(long)).tolist())
        out = batch.select(["stream", "host", "text"]).append_column("ask", pa.array(ask, pa.list_(pa.int32())))
        yield out.filter(pa.array([bool(x) for x in ask], pa.bool_()))

    picked = map_arrow(articles.select("stream", "host", "text", slot), pick,
                       "stream long, host string, text string, ask array<int>")
    return picked.groupBy("stream").agg(*[F.first(c).alias(c) for c in ("host", "text", "ask")])


def article_needs(articles: DataFrame, template: int) -> DataFrame:
    """(host, need): on how many of a host's articles a sequence must occur to be boilerplate in them;
    hosts with fewer articles than that have none. Input: (stream, host), repeats allowed."""
    need = F.greatest(F.lit(3), F.floor(F.col("n") * template / 100) + 1).cast("long")
    counted = articles.select("host", "stream").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("n"))
    return counted.select("host", need.alias("need"), "n").where("n >= need").select("host", "need")


def distinct_pages(streams: DataFrame, needs: DataFrame, long: int, share: int) -> DataFrame:
    """(stream, alike, need): which distinct page of its host a stream counts as, and on how many of
    them a sequence must occur to be boilerplate. Input: (stream, host, article, text), one row per stream;
    streams of fewer than ``long`` words cannot hold one and are left out. ``needs`` has those of articles."""
    able = streams.where(F.size(F.split("text", " ")) >= long)
    # the host goes into each word, so that streams of different hosts share no sequence
    mixed = able.select("stream", F.array_join(F.transform(F.split("text", " "), lambda w: F.concat(
        w, F.lit("@"), F.hex(F.xxhash64("host", "article")))), " ").alias("text"))
    alike = staged(ngram_components(mixed, NEAR_WORDS, NEAR_PERCENT, "stream", "text").select(
        F.col("doc_id").alias("stream"), F.col("component_id").alias("alike")).join(
            able.select("stream", "host", "article"), "stream"), "alike")
    # of three pages and more, one repeat may be a quotation
    least = F.when(F.col("n") < 3, F.lit(2)).otherwise(F.greatest(F.lit(3), F.ceil(F.col("n") * share / 100)))
    hosts = staged(alike.where("NOT article").select("host", "alike").distinct().groupBy("host").agg(
        F.count(F.lit(1)).alias("n")).select(F.col("host"), F.lit(False).alias("article"), least.cast("long").alias("need")).unionByName(
            needs.select("host", F.lit(True).alias("article"), "need")), "hosts")
    return alike.join(hosts, ["host", "article"]).select("stream", "alike", "need")


def boilerplate_words(streams: DataFrame, needs: DataFrame, long: int, share: int) -> DataFrame:
    """(stream, at): positions of a stream's words inside word sequences of ``long`` words that are
    boilerplate of its host. Input: (stream, host, article, text, ask), one row per stream; ``ask``: the
    places that may be (null: all); ``needs`` (host, need) for articles."""
    pages = staged(distinct_pages(streams, needs, long, share), "pages")
    asked = F.coalesce("ask", F.sequence(F.lit(0), F.size("words") - 1))
    symbols = (
        streams.withColumn("words", F.split("text", " "))
        .select("stream", "host", "article", "words", F.explode(asked).alias("pos"))
        .select("stream", "pos", F.xxhash64("host", "article", F.get("words", F.col("pos"))).alias("sym"))
    )
    level = suffix_ranks(symbols, ["stream"], long)
    # an interval of the suffix array counts if its suffixes lie on enough distinct pages
    spread = (
        level.join(pages, "stream").groupBy("rank", "alike").agg(F.max("need").alias("need"))
        .groupBy("rank").agg(F.count(F.lit(1)).alias("n"), F.max("need").alias("need"))
        .where(F.col("n") >= F.col("need")).select("rank")
    )
    return level.join(spread, "rank").groupBy("stream").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(
            F.sequence(F.col("pos"), F.col("pos") + long - 1))))).alias("at"))


def extract_text(pages: DataFrame, long: int = 8, id_col: str = "page_id", url_col: str = "url",
                 html_col: str = "html", share: int = 10, template: int = 50) -> DataFrame:
    """(page_id, url, text, n_chars, from_article) for every row of ``pages``."""
    # pages are read once; their texts are staged, and move only if they may hold boilerplate
    cut = staged(split_pages(pages, id_col, url_col, html_col).select(
        "page", "url", "host", "main", "open", F.xxhash64("host", "main", F.lit("article")).alias("stream")), "cut")
    open_text = cut.where(F.col("open") != "").select(
        "page", "host", "open", "url", F.xxhash64("host", "open").alias("stream"), F.col("main").isNull().alias("unmarked"))
    asking = staged(open_text.where("unmarked").select("host").distinct(), "asking")
    open_streams = open_text.join(asking, "host", "left_semi").groupBy("stream").agg(
        F.first("host").alias("host"), F.first("open").alias("text"))
    articles = cut.where(F.size(F.split("main", " ")) >= long).select("stream", "host", F.col("main").alias("text"))
    needs = staged(article_needs(articles, template), "needs")
    streams = staged(
        open_streams.select("stream", "host", F.lit(False).alias("article"), "text", F.lit(None).cast("array<int>").alias("ask"))
        .unionByName(asked_articles(articles, needs, long).withColumn("article", F.lit(True))), "streams")
    covered = staged(boilerplate_words(streams, needs, long, share), "covered")
    left = _uncovered(open_text.where("unmarked").join(covered, "stream", "left"), "open").select(
        "page", "url", "text", F.lit(False).alias("from_article"))
    marked = _uncovered(cut.where(F.col("main").isNotNull() | (F.col("open") == "")).join(covered, "stream", "left"), "main").select(
        "page", "url", "text", F.col("main").isNotNull().alias("from_article"))
    return marked.unionByName(left).select(
        F.col("page").alias("page_id"), "url", "text", F.length("text").cast("bigint").alias("n_chars"), "from_article")


def _uncovered(pages: DataFrame, column: str) -> DataFrame:
    """``pages`` with ``text``: the words of ``column`` that don't stand at ``at`` (null: all of them)."""
    # the words are split once, before the lambda that looks them up
    split = pages.withColumn("words", F.when(F.col("at").isNotNull(), F.split(column, " ")))
    places = F.array_except(F.sequence(F.lit(0), F.size("words") - 1), "at")
    left = F.array_join(F.transform(places, lambda i: F.get("words", i)), " ")
    return split.withColumn("text", F.when(F.col("at").isNull(), F.coalesce(column, F.lit(""))).otherwise(left))
