"""Main text of web pages, by page structure and the runs of words that a host's pages share.

A page is cut into blocks with the elements they stand in. Blocks inside menus, headers, footers, forms,
adverts, comments and the like are dropped; so is what lies outside the article if a page
marks one. For the rest, a *run* is ``LONG_RUN`` words of one block, or ``MIN_RUN`` words of a block of fewer than
``LONG_RUN``. The runs of a host's pages are counted over all of its pages, by hash. Words in runs that stand on two pages
or more are exactly those in common substrings of at least that length, so no suffixes need sorting.

Words outside an article are boilerplate in a run that stands on two pages whose remaining text differs; words anywhere
are in a run that nearly all pages of the host carry. They are cut from a long block; a short one goes whole.
The remaining text of a page differs if fewer than ``COVERED`` of its words, those that nearly all pages carry aside, are in
repeated runs: a near copy is no evidence against the text it shares, and pages of equal text count once.

All pages are read twice: for the least 4-word hash inside each run (a repeated run has a repeated one, and there are fewer of them), and for
the runs whose least hash repeats. Pages with a repeated run are read twice more: for the pages that are evidence, and for the text. Each count is one aggregate of
partial sums. The most frequent ``BROADCAST_RUNS`` results are broadcast, the others go back to their pages by an equi-join.

Edge cases: null and empty pages have no text; pages without a host form one host; pages of a host of
their own are judged by structure only; repeated rows are repeated pages and count once as evidence.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from precedent.llm.common import Tables, slices
from precedent.session import ship_package

#: Counts of this many runs at most are broadcast.
BROADCAST_RUNS = 1_000_000
#: Words of a run in a block of fewer than ``LONG_RUN`` words, and of the hashes that stand for a longer run.
MIN_RUN = 4
LONG_RUN = 8
#: A short block is boilerplate, and a page no evidence, if this share of the words is in repeated runs.
COVERED = 0.8
#: A run is boilerplate inside an article as well if it stands on this share of the pages, and this many.
SITE_WIDE, SITE_PAGES = 0.8, 5
# Elements by their part in a page.
SILENT = {"script", "style", "noscript", "template", "svg", "title", "iframe", "object", "canvas", "math", "head"}
CHROME = {"nav", "header", "footer", "aside", "form", "button", "select", "menu", "dialog", "textarea", "label", "input"}
BLOCKS = {
    "p", "div", "section", "article", "main", "h1", "h2", "h3", "h4", "h5", "h6", "li", "ul", "ol", "dl", "dt", "dd",
    "table", "tr", "td", "th", "thead", "tbody", "caption", "blockquote", "pre", "figure", "figcaption", "hr", "body",
    "html", "nav", "header", "footer", "aside", "form", "address", "details", "summary", "fieldset",
}
VOID = {"br", "img", "hr", "meta", "link", "input", "area", "base", "col", "embed", "source", "track", "wbr"}
CHROME_PART = (
    r"(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|nav\w*|menu|breadcrumbs?|sidebar|side|footer|header|masthead"
    r"|comments?|disqus|replies|respond|cookie\w*|consent|notices?|newsletter|subscribe|signup|share|sharing|social"
    r"|related|recommend\w*|popup|modal|toolbar|widget|login|search|pagination|pager|skip)"
)
#: Words that name a place or a form, so that a compound of them and a part above is still that part.
PLACE = (
    r"(?:site|global|top|bottom|left|right|main|page|primary|secondary|mobile|desktop|list|area|box|bar|wrap|wrapper|container"
    r"|block|section|links?|buttons?|icons?|slot|unit|form|inner|outer|row|posts|articles|stories|thread|\d+)"
)
#: A class or id as a whole; the head of a page or section holds its title.
CHROME_NAMES = re.compile(
    rf"(?<!\S)(?!(?:main|page|section|block)[_-]header(?!\S))(?:{PLACE}[_-]+)*{CHROME_PART}(?:[_-]+(?:{PLACE}|{CHROME_PART}))*(?!\S)",
    re.I,
)
CHROME_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu"}
#: Comments, and elements whose content is no text of the page; an unclosed one reaches to the end.
RAW = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|textarea|title|noscript|template|svg|iframe)\b[^>]*+>.*?(?:</\1\s*>|\Z)",
    re.I | re.S,
)
TAG = re.compile(r"<[/!?a-zA-Z](?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>")
TAG_BEGIN = re.compile(r"<[/!?a-zA-Z]")
NAME = re.compile(r"</?([a-zA-Z][a-zA-Z0-9-]*)")
NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
ROLE = re.compile(r"\brole\s*=\s*[\"']?([a-z]+)", re.I)


def tokens(page: str) -> Iterator[tuple[str, bool]]:
    """(piece, whether it is a tag) of a page without its raw elements, in time linear in the page.

    A tag with a quote that nothing closes ends at the next ``>``; after the last ``>`` there is text only.
    """
    at, last = 0, page.rfind(">")
    while at < len(page):
        begin = page.find("<", at)
        if begin > at:
            yield page[at:begin], False
        comment = page.startswith("<!--", begin)
        if begin < 0 or (begin > last and not comment):
            yield page[at if begin < 0 else begin :], False
            return
        if raw := RAW.match(page, begin):
            at = raw.end()
        elif TAG_BEGIN.match(page, begin):
            tag = TAG.match(page, begin)
            at = tag.end() if tag else page.index(">", begin) + 1
            yield page[begin:at], True
        else:
            at = begin + 1
            yield "<", False


def blocks_of(page: str) -> list[tuple[str, bool]]:
    """(text, inside an article) of every block that no dropped element encloses.

    An element dropped for its name only stays if it holds an article or most of the page's paragraph text.
    """
    found: list[tuple[str, bool, tuple[int, ...], bool]] = []  # text, article, elements dropped by name, paragraph
    stack: list[tuple[str, bool, bool, int]] = []  # name, dropped, article, number if dropped by name or -1
    holds: list[bool] = []  # whether the element of that number holds an article
    parts: list[str] = []

    def flush() -> None:
        text = " ".join(entities.unescape("".join(parts)).split())
        parts.clear()
        if text and not any(s[1] for s in stack):
            named = tuple(s[3] for s in stack if s[3] >= 0)
            found.append((text, any(s[2] for s in stack), named, any(s[0] == "p" for s in stack)))

    for piece, is_tag in tokens(page):
        if not is_tag:
            parts.append(piece)
            continue
        if piece[1] in "!?":
            continue
        tag = NAME.match(piece)
        if not tag:
            continue
        name = tag[1].lower()
        if name == "br":
            parts.append(" ")
            continue
        closing = piece[1] == "/"
        if name in BLOCKS or name in CHROME or name in SILENT:
            flush()
        if closing:
            for at in range(len(stack) - 1, -1, -1):
                if stack[at][0] == name:
                    del stack[at:]
                    break
        elif name not in VOID and not piece.endswith("/>"):
            if name == "p" or name == "li":  # these end where the next begins
                while stack and stack[-1][0] in (name, "b", "i", "a", "span", "em", "strong"):
                    stack.pop()
            names = " ".join("".join(x) for x in NAMED.findall(piece))
            role = ROLE.search(piece)
            dropped = name in SILENT or (name in CHROME and not (name == "header" and any(s[2] for s in stack)))
            number, article = -1, name in ("article", "main")
            if article:
                for s in stack:
                    if s[3] >= 0:
                        holds[s[3]] = True
            elif name not in ("body", "html"):
                dropped |= bool(role and role[1].lower() in CHROME_ROLES)
                if names and CHROME_NAMES.search(names):
                    number = len(holds)
                    holds.append(False)
            stack.append((name, dropped, article, number))
    flush()
    if holds:
        total, own = 0, [0] * len(holds)
        for text, _, named, paragraph in found:
            if paragraph:
                total += len(text)
                for number in named:
                    own[number] += len(text)
        gone = [not h and 2 * n <= total for h, n in zip(holds, own)]
        found = [f for f in found if not any(gone[number] for number in f[2])]
    out = [(text, article) for text, article, *_ in found]
    if any(article for _, article in out):
        out = [b for b in out if b[1]]
    return out


def suffix_ranks(stream: np.ndarray, length: int) -> np.ndarray:
    """Rank of each suffix by its first ``length`` words (a power of two), by prefix doubling."""
    rank = np.unique(stream, return_inverse=True)[1].astype(np.int64)
    step = 1
    while step < length:
        after = np.full(len(rank), -1, np.int64)
        after[:-step] = rank[step:]
        rank = np.unique(rank * (len(rank) + 1) + after + 1, return_inverse=True)[1].astype(np.int64)
        step *= 2
    return rank


class WordHashes:
    """64-bit hash of each word, the same in every task."""

    def of(self, words: pa.Array) -> np.ndarray:
        """The hash of each word, made once for each distinct one."""
        encoded = words.dictionary_encode()
        distinct = encoded.dictionary.to_numpy(zero_copy_only=False).tolist()
        return np.fromiter(map(xxhash.xxh3_64_intdigest, distinct), np.uint64, len(distinct))[encoded.indices.to_numpy()]


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * np.uint64(0x9E3779B97F4A7C15) + b
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


class Runs(NamedTuple):
    """Runs of the pages of a batch, in order of their first word."""

    words: pa.Array
    page: np.ndarray  # page of each word
    block: np.ndarray  # block of each word
    short: np.ndarray  # whether each word's block is short
    at: np.ndarray  # first word of each run
    length: np.ndarray
    key: np.ndarray
    anchor: np.ndarray  # least hash inside each run


def runs_of(texts: pa.Array | list[str], hosts: np.ndarray, hashes: WordHashes) -> Runs:
    """Runs of texts with a block a line; hashes of different hosts differ."""
    texts = pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "")
    filled = np.nonzero(pc.binary_length(texts).to_numpy(zero_copy_only=False))[0]  # an empty text has no block
    blocks = pc.split_pattern(texts.take(pa.array(filled)), "\n")
    lists = pc.split_pattern(blocks.flatten(), " ")
    words = lists.flatten()
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    lines = pc.list_value_length(blocks).to_numpy(zero_copy_only=False).astype(np.int64)
    page = np.repeat(np.repeat(filled, lines), sizes)
    block = np.repeat(np.arange(len(sizes)), sizes)
    n = len(words)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(n)
    size = np.repeat(sizes, sizes)
    rank = mixed(hashes.of(words), hosts.astype(np.int64).view(np.uint64)[page])
    ranks = {1: rank}
    for step in (1, 2, 4):
        after = np.zeros(n, np.uint64)
        after[:-step] = ranks[step][step:]
        ranks[2 * step] = mixed(ranks[step], after)
    short = size < LONG_RUN
    least = ranks[MIN_RUN].copy()
    for k in range(1, LONG_RUN - MIN_RUN + 1):
        least[:-k] = np.minimum(least[:-k], ranks[MIN_RUN][k:])
    at = np.nonzero(left >= np.where(short, MIN_RUN, LONG_RUN))[0]
    few = short[at]
    key = np.where(few, ranks[MIN_RUN][at], ranks[LONG_RUN][at]).view(np.int64)
    anchor = np.where(few, ranks[MIN_RUN][at], least[at]).view(np.int64)
    return Runs(words, page, block, short, at, np.where(few, MIN_RUN, LONG_RUN), key, anchor)


def covered(runs: Runs, chosen: np.ndarray) -> np.ndarray:
    """Whether each word lies in a chosen run."""
    size, begin = len(runs.words) + 1, runs.at[chosen]
    change = np.bincount(begin, minlength=size) - np.bincount(begin + runs.length[chosen], minlength=size)
    return np.cumsum(change)[:-1] > 0


def once_a_page(runs: Runs, values: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Places in ``runs`` of the chosen values, each once for a page."""
    where = np.nonzero(chosen)[0]
    both = mixed(runs.page[runs.at[where]].astype(np.uint64), values[where].view(np.uint64))
    return where[np.unique(both, return_index=True)[1]]


class Counts:
    """(n, m) of broadcast keys: pages with the run, and those of them that are evidence."""

    def __init__(self, table: pa.Table):
        order = np.argsort(table.column("key").to_numpy())
        self.key, self.n, self.m = (table.column(c).to_numpy()[order] for c in ("key", "n", "m"))

    def of(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """n and m of each key; 1 and 0 if there is none."""
        n, m = np.ones(len(keys), np.int64), np.zeros(len(keys), np.int64)
        if len(self.key):
            place = np.minimum(np.searchsorted(self.key, keys), len(self.key) - 1)
            hit = self.key[place] == keys
            n[hit], m[hit] = self.n[place[hit]], self.m[place[hit]]
        return n, m


class Pages:
    """The stored pages of one run, and passes over their runs."""

    def __init__(self, pages: DataFrame, most: int):
        self.pages, self.most = pages, most

    def sums(self, choose: Callable[[Runs, pa.RecordBatch], np.ndarray], pages: DataFrame) -> DataFrame:
        """(key, n): the pages of each chosen key, a page of repeated text once."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            hashes = WordHashes()
            for batch in slices(batches, "text"):
                runs = runs_of(batch.column("text"), batch.column("host").to_numpy(), hashes)
                yield pa.RecordBatch.from_arrays([pa.array(choose(runs, batch))], names=["key"])

        return pages.where("first").mapInArrow(run, "key long").groupBy("key").agg(F.count("*").alias("n"))

    def joined(self, counts: DataFrame, field: str) -> tuple[DataFrame, Callable[[Runs, pa.RecordBatch], tuple[np.ndarray, np.ndarray]]]:
        """The pages, and a function that gives n and m of each of their runs' ``field``."""
        spark = self.pages.sparkSession
        sizes = dict(counts.groupBy(F.floor(F.log2("n")).alias("k")).count().collect())
        least, total = max(sizes, default=0) + 1, 0
        while least > 0 and total + sizes.get(least - 1, 0) <= self.most:
            least -= 1
            total += sizes.get(least, 0)
        hot = counts.where(F.col("n") >= 2**least).select("key", "n", "m").toArrow()
        sent = spark.sparkContext.broadcast(Counts(hot))
        pages = self.pages
        if least > min(sizes, default=0):
            # No key of these has more than one in ``most`` of the rows.
            rare = counts.where(F.col("n") < 2**least).select("key", "n", "m")

            def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                hashes = WordHashes()
                for batch in slices(batches, "text"):
                    runs = runs_of(batch.column("text"), batch.column("host").to_numpy(), hashes)
                    values = getattr(runs, field)
                    keep = once_a_page(runs, values, sent.value.of(values)[0] < 2)
                    rid = batch.column("rid").to_numpy()[runs.page[runs.at[keep]]]
                    yield pa.RecordBatch.from_arrays([pa.array(rid), pa.array(values[keep])], names=["rid", "key"])

            met = pages.mapInArrow(emit, "rid long, key long").join(rare, "key")
            met = met.groupBy("rid").agg(F.collect_list(F.struct("key", "n", "m")).alias("rare"))
            pages = pages.join(met, "rid", "left")
        else:
            pages = pages.withColumn("rare", F.lit(None).cast("array<struct<key:long,n:long,m:long>>"))

        def find(runs: Runs, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
            values = getattr(runs, field)
            n, m = sent.value.of(values)
            own = batch.column("rare").flatten()
            if len(own):
                table = pa.Table.from_arrays(own.flatten(), names=["key", "n", "m"])
                # A key belongs to one host, so all its pages agree.
                first = np.unique(table.column("key").to_numpy(), return_index=True)[1]
                n_own, m_own = Counts(table.take(pa.array(first))).of(values)
                n, m = np.maximum(n, n_own), np.maximum(m, m_own)
            return n, m

        return pages, find


def wide_runs(runs: Runs, n: np.ndarray, batch: pa.RecordBatch) -> np.ndarray:
    """Whether nearly all pages of its host carry each run."""
    least = np.maximum(SITE_PAGES, SITE_WIDE * batch.column("site").to_numpy())
    return n >= least[runs.page[runs.at]]


TEXTS = "page_id long, url string, text string, n_chars long"
STORED = "rid long, page_id long, url string, host long, page long, text string, article boolean"


def main_texts(pages: DataFrame, most: int = BROADCAST_RUNS) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages`` (page_id, url, html)."""
    spark = pages.sparkSession
    ship_package(spark)
    tables = Tables(spark, "html")
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1))
    rows = pages.select(
        F.monotonically_increasing_id().alias("rid"), F.col("page_id").cast("long").alias("page_id"), "url", "html", F.xxhash64(host).alias("host")
    )

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            blocks = [blocks_of(h or "") for h in batch.column("html").to_pylist()]
            texts = ["\n".join(t for t, _ in own) for own in blocks]
            seeds = batch.column("host").to_pylist()
            names = [
                int.from_bytes(hashlib.blake2b(f"{s} {t}".encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)
                for s, t in zip(seeds, texts)
            ]
            # A page that marks an article keeps only blocks inside of one.
            article = [bool(own) and own[0][1] for own in blocks]
            columns = [batch.column(c) for c in ("rid", "page_id", "url", "host")]
            columns += [pa.array(names, pa.int64()), pa.array(texts, pa.string()), pa.array(article, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names=["rid", "page_id", "url", "host", "page", "text", "article"])

    parsed = tables.store(rows.mapInArrow(parse, STORED), "parsed", "zstd")
    distinct = tables.store(
        parsed.where("text != ''").groupBy("host", "page").agg(F.min("rid").alias("lead"), F.count("*").alias("copies")), "distinct"
    )
    sites = distinct.groupBy("host").agg(F.count("*").alias("site"))
    again = distinct.where("copies > 1").select("page", "lead")
    # The texts are not shuffled for small tables.
    few = [t.limit(most + 1).count() <= most for t in (again, sites)]
    every = (
        parsed.join(F.broadcast(again) if few[0] else again, "page", "left")
        .join(F.broadcast(sites) if few[1] else sites, "host", "left")
        .select(
            "rid", "page_id", "url", "host", "text", "article", F.coalesce("site", F.lit(0)).alias("site"),
            F.coalesce(F.col("lead") == F.col("rid"), F.lit(True)).alias("first"),
        )
    )
    if not all(few):
        every = tables.store(every, "every", "zstd")
        tables.drop("parsed")
    whole = Pages(every, most)

    def anchors(runs: Runs, batch: pa.RecordBatch) -> np.ndarray:
        return runs.anchor[once_a_page(runs, runs.anchor, np.ones(len(runs.at), bool))]

    zero = F.lit(0).cast("long").alias("m")
    found = tables.store(whole.sums(anchors, every.where("site > 1")).where("n > 1").select("key", "n", zero), "anchors")
    candidates, anchor_counts = whole.joined(found, "anchor")

    def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(rid, first, key) of the pages' runs whose least hash repeats."""
        hashes = WordHashes()
        for batch in slices(batches, "text"):
            runs = runs_of(batch.column("text"), batch.column("host").to_numpy(), hashes)
            at = once_a_page(runs, runs.key, anchor_counts(runs, batch)[0] > 1)
            page = pa.array(runs.page[runs.at[at]])
            columns = [batch.column("rid").take(page), batch.column("first").take(page), pa.array(runs.key[at])]
            yield pa.RecordBatch.from_arrays(columns, names=["rid", "first", "key"])

    hits = tables.store(candidates.mapInArrow(repeated, "rid long, first boolean, key long"), "hits")
    counts = hits.where("first").groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    counts = tables.store(counts.select("key", "n", zero), "runs")
    # Only pages with a repeated run are looked at again.
    touched = tables.store(hits.join(counts, "key", "left_semi").select("rid").distinct().withColumn("touched", F.lit(True)), "touched")
    tables.drop("hits")
    marked = every.join(F.broadcast(touched) if touched.limit(most + 1).count() <= most else touched, "rid", "left")
    untouched = marked.where("touched is null").select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
    whole = Pages(marked.where("touched").drop("touched"), most)
    judged, run_counts = whole.joined(counts, "key")

    def evidence(runs: Runs, batch: pa.RecordBatch) -> np.ndarray:
        n, _ = run_counts(runs, batch)
        rest = ~covered(runs, wide_runs(runs, n, batch))
        own = ~covered(runs, n > 1)
        size = batch.num_rows
        total = np.bincount(runs.page[rest], minlength=size)
        alone = np.bincount(runs.page[own], minlength=size)
        differs = (alone > 0) & (alone > (1 - COVERED) * total)
        return runs.key[once_a_page(runs, runs.key, (n > 1) & differs[runs.page[runs.at]])]

    seen = whole.sums(evidence, judged).select("key", F.col("n").alias("seen"))
    both = counts.drop("m").join(seen, "key", "left").select("key", "n", F.coalesce("seen", F.lit(0)).cast("long").alias("m"))
    last, all_counts = whole.joined(tables.store(both, "evidence"), "key")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in slices(batches, "text"):
            texts = batch.column("text").to_pylist()
            runs = runs_of(batch.column("text"), batch.column("host").to_numpy(), hashes)
            n, m = all_counts(runs, batch)
            inside = batch.column("article").to_numpy(zero_copy_only=False)[runs.page[runs.at]]
            cut = covered(runs, wide_runs(runs, n, batch) | ((m > 1) & ~inside))
            blocks = runs.block[-1] + 1 if len(runs.block) else 0
            share = np.bincount(runs.block[cut], minlength=blocks) / np.bincount(runs.block, minlength=blocks)
            cut = np.where(runs.short, (share >= COVERED)[runs.block], cut) if blocks else cut
            for row in np.unique(runs.page[cut]).tolist():
                begin, end = np.searchsorted(runs.page, [row, row + 1])
                lines: dict[int, list[str]] = {}
                left = begin + np.nonzero(~cut[begin:end])[0]
                for line, word in zip(runs.block[left].tolist(), runs.words.take(pa.array(left)).to_pylist()):
                    lines.setdefault(line, []).append(word)
                texts[row] = "\n".join(map(" ".join, lines.values()))
            columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])

    return last.mapInArrow(finish, TEXTS).union(untouched)
