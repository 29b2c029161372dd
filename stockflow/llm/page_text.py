"""Main text of web pages: structure first, then what a host's pages repeat."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.llm import words as W
from stockflow.storage import stored

# Tokens of a repeat worth removing.
DEPTH = 8
# Different pages of a host that must share it.
MIN_PAGES = 3

# Elements by what they mean for the text.
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol "
    "optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
HIDDEN = set(
    "script style noscript template iframe object embed applet svg math canvas audio video "
    "title select textarea button datalist".split()
)
BOILERPLATE = set("nav aside footer form menu dialog".split())
VOID = set("area base br col embed hr img input link meta source track wbr".split())
ROLES = set(
    "navigation banner contentinfo complementary search form menu menubar alert dialog alertdialog".split()
)
RAW = set("script style textarea title iframe noscript".split())
# Words of a class or an id that name what is not the article.
NAMES = re.compile(
    r"(?<![a-z])(?:ad|ads|advert|adverts|advertisement|advertising|adsense|sponsor|sponsored|promo|promotion"
    r"|nav|navbar|navigation|menu|menus|breadcrumb|breadcrumbs|pagination|pager|sidebar|side-bar|widget|widgets"
    r"|footer|site-header|page-header|masthead|topbar|banner|cookie|cookies|consent|gdpr|notice|notices|alert|popup|modal"
    r"|overlay|newsletter|subscribe|subscription|signup|login|share|sharing|social|related|recommended"
    r"|comment|comments|commentlist|disqus|respond|reply|replies|discussion|toolbar|skip-link|copyright|legal"
    r"|disclaimer|header)(?![a-z])"
)
# Parts of a class name that tell how the element is set, not what it is, and
# names of which a header is the article's own.
_SETTINGS_FIRST = set("has no not with without is are show hide enable js".split())
_SETTINGS_LAST = set("open closed enabled disabled on off visible active layout ready".split())
_OWN_HEADER = re.compile(r"(?:article|post|entry|content|story|main)[-_]+header")
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden|itemprop)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
# Elements whose open tag ends an open paragraph or item.
_CLOSES = {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option"}
KEEP, DROP, OPEN = 2, 0, 1
# States that the whole page decides: an article in something a class word names, and a form.
MAYBE, FORM = 3, 4


def _named(value: str) -> bool:
    """Whether a class or an id names what is not the article."""
    for token in value.split():
        parts = re.split("[-_]+", token)
        if parts[0] in _SETTINGS_FIRST or parts[-1] in _SETTINGS_LAST:
            continue
        if NAMES.search(token) and not _OWN_HEADER.fullmatch(token):
            return True
    return False


def _verdict(name: str, attributes: str, inside: bool) -> tuple[int | None, bool]:
    """What an element says about its content: DROP, KEEP, FORM or nothing; if by its name.

    Class words do not speak against an article, main part or article body itself.
    """
    if name in HIDDEN or name in BOILERPLATE:
        return (FORM if name == "form" else DROP), True
    if name == "header":
        return (None if inside else DROP), True
    found, named = KEEP if name in ("article", "main") else None, False
    for key, *values in _ATTRIBUTE.findall(attributes or ""):
        key, value = key.lower(), next((v for v in values if v), "").lower()
        if key == "hidden" or key == "aria-hidden" and value == "true":
            return DROP, True
        if key == "role" and value in ROLES:
            return DROP, True
        if key == "role" and value in ("main", "article") or key == "itemprop" and value == "articlebody":
            found = KEEP
        if key in ("class", "id") and name not in ("html", "body"):
            named = named or _named(value)
    return (DROP if named and found is None else found), False


def _next(state: int, verdict: int | None, soft: bool) -> int:
    """The state inside an element; ``soft`` is whether only class words and forms dropped."""
    if verdict is None:
        return state
    if state in (DROP, FORM):
        return MAYBE if verdict == KEEP and soft else state
    if verdict == FORM:
        return FORM if state == OPEN else DROP
    if state == MAYBE:
        return DROP if verdict == DROP else MAYBE
    return verdict


def _decided(page: list[tuple[str, int]]) -> list[tuple[str, int]]:
    """The blocks with the states that the whole page decides.

    An article within something a class word or a form dropped counts if the page has no
    other, and a form's content if the page has nothing else.
    """
    states = {state for _, state in page}
    maybe = DROP if KEEP in states else KEEP
    form = OPEN if not states & {KEEP, MAYBE, OPEN} else DROP
    return [(text, {MAYBE: maybe, FORM: form}.get(state, state)) for text, state in page]


def blocks(source: str) -> list[tuple[str, int]]:
    """(text, state) of each block in page order; hidden content is left out.

    KEEP stands in an article, DROP in an element that says it is none, OPEN elsewhere.
    """
    out: list[tuple[str, int]] = []
    stack: list[tuple[str, int, bool, bool, bool]] = []
    opened: dict[str, int] = {}
    parts: list[str] = []
    state, inside, mute, soft, at, size = OPEN, False, False, True, 0, len(source)

    def flush():
        if parts:
            text = " ".join(re.split(r"\s+", html.unescape("".join(parts)))).strip()
            parts.clear()
            if text:
                out.append((text, state))

    while at < size:
        tag = _TAG.search(source, at)
        stop = tag.start() if tag else size
        if stop > at and not mute:
            parts.append(source[at:stop])
        if not tag:
            break
        at = tag.end()
        close, name, attributes = (tag[1], tag[2], tag[3]) if tag[2] else (tag[4], tag[5], tag[6])
        if not name:
            continue
        name = name.lower()
        if close:
            if opened.get(name):
                if name in BLOCKS:
                    flush()
                while stack:
                    open_name, old, was, muted, softly = stack.pop()
                    opened[open_name] -= 1
                    if old != state or open_name in BLOCKS:
                        flush()
                    state, inside, mute, soft = old, was, muted, softly
                    if open_name == name:
                        break
            elif name in BLOCKS:
                flush()
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name in BLOCKS:
            flush()
            ends = _CLOSES.get(name, "").split()
            if ends and stack and stack[-1][0] in ends or stack and stack[-1][0] == "p":
                open_name, state, inside, mute, soft = stack.pop()
                opened[open_name] -= 1
        if name in VOID:
            continue
        if attributes.rstrip().endswith("/") and name in HIDDEN - RAW:
            continue
        verdict, certain = _verdict(name, attributes, inside)
        if name in RAW:
            end = re.compile(rf"</{name}\s*>", re.I).search(source, at)
            at = end.end() if end else size
            continue
        stack.append((name, state, inside, mute, soft))
        opened[name] = opened.get(name, 0) + 1
        # What goes inside a line leaves the line whole.
        if verdict == DROP and (name in HIDDEN or name not in BLOCKS):
            mute = True
            continue
        new = _next(state, verdict, soft)
        if new != state:
            flush()
        soft = soft and not (verdict == DROP and certain)
        inside = inside or new in (KEEP, MAYBE)
        state = new
    flush()
    return _decided(out)


def suffix_heads(streams: list[list[str]]) -> list[np.ndarray]:
    """For every suffix of the streams that is ``DEPTH`` tokens long, a key of its head.

    Equal keys are neighbours in the suffix array of the concatenated streams, with that
    many tokens in common.
    """
    values = [" ".join(s).encode() for s in streams]
    data, offsets = W.joined(values, lower=False)
    starts, ends = W.spans(data)
    hashed = W.hashes(data, starts, ends)
    first = np.searchsorted(starts, offsets)
    out = []
    factors = W.mix(np.arange(1, DEPTH + 1, dtype=np.uint64)) | np.uint64(1)
    for low, high in zip(first, first[1:], strict=False):
        count = max(0, high - low - DEPTH + 1)
        total = np.zeros(count, np.uint64)
        for k in range(DEPTH):
            total += hashed[low + k : low + k + count] * factors[k]
        out.append(W.mix(total).view(np.int64))
    return out


def _parsed(pages: DataFrame) -> DataFrame:
    """(…, blocks, keys): the blocks of each page, and keys of the suffixes in doubt.

    The stream of a page is what stands outside its articles and main part.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [blocks(text or "") for text in batch.column("html").to_pylist()]
            streams, doubt = [], []
            for page in found:
                kept = any(state == KEEP for _, state in page)
                # Beside an article nothing else is the article.
                if kept:
                    page[:] = [(text, DROP if state == OPEN else state) for text, state in page]
                doubt.append(any(state == OPEN for _, state in page))
                streams.append([w for text, state in page if state != KEEP for w in text.split()])
            keys = suffix_heads(streams)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("url"),
                    batch.column("content"),
                    pa.array([[t for t, s in p if s != DROP or d] for p, d in zip(found, doubt, strict=True)], pa.list_(pa.string())),
                    pa.array([[s for _, s in p if s != DROP or d] for p, d in zip(found, doubt, strict=True)], pa.list_(pa.int32())),
                    pa.array(list(keys), pa.list_(pa.int64())),
                    pa.array(doubt),
                ],
                ["id", "url", "content", "texts", "states", "keys", "doubt"],
            )

    kind = pages.schema["id"].dataType.simpleString()
    schema = f"id {kind}, url string, content bigint, texts array<string>, states array<int>, keys array<bigint>, doubt boolean"
    return pages.mapInArrow(parse, schema)


def unique_text(texts: list[str], states: list[int], keys: np.ndarray, repeated: set[int]) -> str:
    """The page's blocks without what is covered by repeats of its host.

    Blocks in an article stay whole; of blocks in doubt the runs of tokens that no
    repeat covers stay.
    """
    tokens = [text.split() for text, state in zip(texts, states, strict=True) if state != KEEP]
    size = sum(map(len, tokens))
    covered = np.zeros(size + 1, np.int64)
    for at, key in enumerate(keys.tolist()):
        if key in repeated:
            covered[at] += 1
            covered[at + DEPTH] -= 1
    gone, at, out = np.cumsum(covered) > 0, 0, []
    for text, state in zip(texts, states, strict=True):
        if state == KEEP:
            out.append(text)
            continue
        parts = text.split()
        kept = [w for w, lost in zip(parts, gone[at : at + len(parts)], strict=True) if not lost]
        at += len(parts)
        if state == OPEN and kept:
            out.append(" ".join(kept))
    return "\n\n".join(out)


def host(url):
    """Host of a URL in lower case; the URL itself if it has none, null stays null."""
    found = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return F.when(found != "", found).otherwise(url)


def extract(pages: DataFrame, id_column: str = "page_id", url_column: str = "url",
            html_column: str = "html") -> DataFrame:
    """(id, url, text): the main text of each page, blocks joined by an empty line.

    Elements that say what they are decide first: scripts, styles, menus, footers, forms
    and the like go, articles and main parts stay. Where a page has neither article nor
    main part, its host decides: the page's tokens outside are suffixes of the host's
    token stream, and those whose first ``DEPTH`` tokens occur on ``MIN_PAGES``
    different pages of the host mark those tokens as boilerplate. A longer repeat
    is a chain of such heads, so the array needs no deeper order, and grouping heads
    replaces a sort of all suffixes of a host in one task. Unique runs stay.

    Null pages and pages without text give an empty text; a null URL is a host of its
    own; copies of a page on a host count once and get the same text. Columns not named are not read. An
    empty table gives no rows.
    """
    rows = pages.select(
        F.col(id_column).alias("id"),
        F.col(url_column).cast("string").alias("url"),
        F.col(html_column).cast("string").alias("html"),
        F.xxhash64(F.col(html_column).cast("string")).alias("content"),
    )
    parsed = _parsed(rows).withColumn("host", F.coalesce(host(F.col("url")), F.lit("")))
    parsed = stored(parsed.withColumn("row", F.monotonically_increasing_id()), "pages")
    # Copies of a page are one page: of each content of a host one row is counted.
    first = parsed.groupBy("host", "content").agg(F.min("row").alias("counted"))
    once = parsed.join(first.select("counted"), F.col("row") == F.col("counted"), "left_semi")
    heads = once.select("host", F.explode(F.array_distinct("keys")).alias("key"))
    shared = heads.groupBy(F.col("host").alias("of"), F.col("key").alias("head")).count()
    shared = shared.where(F.col("count") >= MIN_PAGES).drop("count")
    in_doubt = parsed.where("doubt").select("row", "host", F.explode(F.array_distinct("keys")).alias("key"))
    marks = in_doubt.join(shared, (F.col("host") == F.col("of")) & (F.col("key") == F.col("head")))
    marks = marks.groupBy(F.col("row").alias("at")).agg(F.collect_set("key").alias("repeated"))
    open_pages = parsed.where("doubt").join(marks, F.col("row") == F.col("at"), "left")
    open_pages = open_pages.select("id", "url", "texts", "states", "keys", "repeated")

    def cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                unique_text(r["texts"], r["states"], np.array(r["keys"] or [], np.int64), set(r["repeated"] or ()))
                for r in batch.select(["texts", "states", "keys", "repeated"]).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("url"), pa.array(texts, pa.string())], ["id", "url", "text"]
            )

    kind = parsed.schema["id"].dataType.simpleString()
    judged = open_pages.mapInArrow(cleaned, f"id {kind}, url string, text string")
    certain = parsed.where("not doubt").select("id", "url", F.array_join("texts", "\n\n").alias("text"))
    return certain.union(judged)
