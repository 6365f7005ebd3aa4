"""Main text of web pages: structure first, then a suffix array per host for what structure leaves open.

Pages are dealt by host into parts of bounded size. In a part the pages' token streams are joined,
their suffixes ordered by as many tokens as a long repeat has, and neighbours that agree on all of
them in several distinct pages mark boilerplate. An article element says by itself what the main
text is, so repeats inside it (a copied article) stay; text in menus, footers and the like never
counts; text that is in neither is kept where it is unique and dropped where it is covered.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaylake.llm.words import Words, mix, words_of
from assaylake.session import materialize, small_side

PART_PAGES = 256
REPEAT = 8  # tokens of a long substring; a power of two
MIN_PAGES = 3  # distinct pages that make it boilerplate

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|<[!?][^>]*>|<(?=[a-zA-Z/!?])[^>]*\Z""", re.S)
_ATTRIBUTE = re.compile(r"""(class|id|role|itemprop|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_SPACE = re.compile(r"\s+")
# fixed names of HTML elements
RAW = {"script", "style", "template", "noscript", "iframe", "textarea", "svg", "math", "title", "object", "audio", "video", "canvas"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "div", "dl", "dt", "fieldset", "figcaption",
         "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hr", "html", "li", "main", "menu", "nav", "ol", "p", "pre",
         "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
FURNITURE = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "select", "head"}
MAIN = {"article", "main"}
_FURNITURE_ROLE = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "menu", "form"}
_FURNITURE_NAME = (r"(?:nav|navbar|navigation|menu|header|masthead|footer|sidebar|aside|ads?|advert\w*|banner|sponsor\w*|promo\w*|cookies?|consent|"
                   r"notices?|alert|popup|modal|comments?|disqus|replies|share|social|subscribe|newsletter|signup|login|breadcrumbs?|related|widget)")
# parts of a compound name that say where or as what furniture stands, not what has or holds it
_PLACE = r"(?:site|page|global|top|bottom|left|right|main|primary|secondary|bar|box|block|slot|unit|list|links?|icons?|buttons?|section|area|form|wrapper|container|\d+)"
_FURNITURE_TOKEN = re.compile(rf"(?:{_PLACE}[_-]+)*{_FURNITURE_NAME}(?:[_-]+(?:{_FURNITURE_NAME}|{_PLACE}))*", re.I)


def _kind(name: str, attributes: str, within: bool) -> str:
    """'main', 'furniture', 'named' (furniture by class or id only) or '' for an element; a header ``within`` an article is its headline."""
    if name in FURNITURE and not (within and name == "header"):
        return "furniture"
    found = {m[0].lower(): (m[1] or m[2] or m[3]) for m in _ATTRIBUTE.findall(attributes)} if "=" in attributes else {}
    role = found.get("role", "").lower()
    if role in _FURNITURE_ROLE:
        return "furniture"
    if name in MAIN or role in ("main", "article") or found.get("itemprop", "").lower() == "articlebody":
        return "main"
    tokens = [t for a in ("class", "id") for t in found.get(a, "").split() if not (within and t.lower() == "header")]
    return "named" if name not in ("html", "body") and any(_FURNITURE_TOKEN.fullmatch(t) for t in tokens) else ""


def _zone(above: str, name: str, attributes: str) -> str:
    """The zone of an element below the zone ``above``."""
    kind = _kind(name, attributes, above in ("main", "inner"))
    if above in ("furniture", "tagged"):
        return "tagged" if kind == "main" or (above == "tagged" and not kind) else "furniture"
    if above == "named":
        if kind == "main":
            return "main" if name == "main" else "inner"
        return kind or above
    return kind or above


def page_blocks(page: str) -> list[tuple[str, str]]:
    """(zone, text) of each block in page order; the zone is 'main', 'furniture' or '' for neither.

    Furniture by class or id only is 'named', an article below it 'inner', and one below other furniture 'tagged'.
    """
    out: list[tuple[str, str]] = []
    stack: list[tuple[str, str]] = []  # element and its zone
    pieces: list[str] = []
    zone, at, n = "", 0, len(page)

    def close_block() -> None:
        if pieces:
            text = _SPACE.sub(" ", html.unescape("".join(pieces))).strip()
            if text:
                out.append((zone, text))
            pieces.clear()

    while at < n:
        m = _TAG.search(page, at)
        if m is None:
            pieces.append(page[at:])
            break
        if m.start() > at:
            pieces.append(page[at:m.start()])
        at = m.end()
        name = (m.group(2) or "").lower()
        if not name:
            continue
        if m.group(1):
            if name in BLOCK:
                close_block()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    if stack[i][1] != (stack[-1][1]) or (stack[i - 1][1] if i else "") != zone:
                        close_block()
                    del stack[i:]
                    break
        elif name in RAW:
            if not m.group(3).endswith("/"):
                end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
                at = end.end() if end else n
        elif name in VOID:
            if name == "hr":
                close_block()
            elif name == "br":
                pieces.append(" ")
        else:
            if name in BLOCK:
                close_block()
                for i in range(len(stack) - 1, -1, -1):  # a block ends an open paragraph, an item the item before
                    if stack[i][0] == "p" or stack[i][0] == name == "li":
                        del stack[i:]
                        break
                    if stack[i][0] in BLOCK:
                        break
            above = stack[-1][1] if stack else ""
            new = _zone(above, name, m.group(3))
            if new != above:
                zone = above
                close_block()
            stack.append((name, new))
        zone = stack[-1][1] if stack else ""
    close_block()
    return out


def _suffixes(streams: list[str], length: int) -> tuple[Words, np.ndarray, np.ndarray]:
    """Words, the suffix array without suffixes of fewer than ``length`` tokens, and all suffixes' ranks by so many tokens."""
    w = words_of(pa.array(streams, pa.string()))
    first, row, n = w.first, w.row(), len(w.start)
    if n < length:
        return w, np.zeros(0, dtype=np.int64), np.zeros(n, dtype=np.int64)
    rank = np.unique(w.hashes(), return_inverse=True)[1].astype(np.int64) + 1
    step = 1
    while step < length:  # suffixes in the order of their first 2, 4, … tokens
        ahead = np.zeros(n, dtype=np.int64)
        ahead[:n - step] = np.where(row[step:] == row[:n - step], rank[step:], 0)
        key = rank * (int(rank.max()) + 1) + ahead
        rank, step = np.unique(key, return_inverse=True)[1].astype(np.int64) + 1, step * 2
    full = np.flatnonzero(first[row + 1] - np.arange(n) >= length)
    return w, full[np.argsort(rank[full], kind="stable")], rank


def _keys(w: Words, at: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit hash of the ``length`` tokens from each of these on, equal in every part."""
    h = w.hashes()
    key = np.zeros(len(at), dtype=np.uint64)
    for j in range(length):
        key = key * np.uint64(0xD6E8FEB86659FD93) + h[at + j]
    return mix(key).view(np.int64)


def part_keys(streams: list[str], length: int = REPEAT, min_pages: int = MIN_PAGES) -> tuple[np.ndarray, np.ndarray]:
    """(key, page): each substring of ``length`` tokens with its ``min_pages`` least page hashes, all that a count up to there needs."""
    w, order, _ = _suffixes(streams, length)
    page = np.array([xxhash.xxh3_64_intdigest(s.encode("utf-8", "surrogatepass")) for s in streams], dtype=np.uint64).view(np.int64)
    pair = np.unique(np.column_stack([_keys(w, order, length), page[w.row()[order]]]), axis=0)
    begin = np.flatnonzero(np.concatenate([[True], pair[1:, 0] != pair[:-1, 0]])[:len(pair)])
    within = np.arange(len(pair)) - np.repeat(begin, np.diff(np.append(begin, len(pair))))
    return pair[within < min_pages, 0], pair[within < min_pages, 1]


def repeated_tokens(streams: list[str], length: int = REPEAT, min_pages: int = MIN_PAGES, keys: np.ndarray | None = None) -> list[np.ndarray]:
    """For each stream which of its tokens lie in a substring of ``length`` tokens that ``min_pages`` different streams share.

    With ``keys`` these are the substrings that so many pages of the whole host share.
    """
    w, order, rank = _suffixes(streams, length)
    first, row, n = w.first, w.row(), len(w.start)
    if not len(order):
        return [np.zeros(c, dtype=bool) for c in w.count]
    if keys is None:
        _, same = np.unique(np.array(streams, dtype=object).astype(str), return_inverse=True)  # equal pages are one page
        pair = np.unique(rank[order] * len(streams) + same[row[order]])
        ranks, pages = np.unique(pair // len(streams), return_counts=True)
        often = order[np.isin(rank[order], ranks[pages >= min_pages])]
    else:
        often = order[np.isin(_keys(w, order, length), keys)]
    change = np.zeros(n + 1, dtype=np.int64)
    np.add.at(change, often, 1)
    np.add.at(change, np.minimum(often + length, n), -1)
    covered = np.cumsum(change[:-1]) > 0
    return [covered[a:b] for a, b in zip(first, first[1:], strict=False)]


def _streams(parsed: list[list[tuple[str, str]]]) -> list[str]:
    return ["\n".join(t for _, t in blocks) for blocks in parsed]


def main_texts(pages: list[str | None], keys: np.ndarray | None = None) -> list[str]:
    """Main text of each page of one part of a host; ``keys`` has the repeats of the host where it has other parts."""
    parsed = [page_blocks(p) if p else [] for p in pages]
    covered = repeated_tokens(_streams(parsed), keys=keys)
    out = []
    for blocks, cover in zip(parsed, covered, strict=True):
        # an article below a name is a comment or a teaser where the page has another one
        main = [t for zone, t in blocks if zone == "main"] or [t for zone, t in blocks if zone == "inner"]
        if not main:
            at, unique = 0, []
            for zone, text in blocks:
                count = int(words_of(pa.array([text])).count[0])
                share = cover[at:at + count].mean() if count else 0.0
                at += count
                if zone == "":
                    unique.append((text, share <= 0.5))
            # a page that repeats others as a whole is a copy, not boilerplate
            main = [t for t, keep in unique if keep] or [t for t, _ in unique] or [t for zone, t in blocks if zone == "tagged"]
        out.append("\n\n".join(main))
    return out


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _part_keys(part: pa.Table) -> pa.Table:
    key, page = part_keys(_streams([page_blocks(p) if p else [] for p in part.column("html").to_pylist()]))
    return pa.table({"host": pa.array([part.column("host")[0].as_py()] * len(key), pa.string()),
                     "part": pa.array(np.full(len(key), part.column("part")[0].as_py(), dtype=np.int64)), "key": key, "page": page})


def _extract(part: pa.Table, often: pa.Table) -> pa.Table:
    part = part.combine_chunks()
    alone = not part.num_rows or part.column("parts")[0].as_py() == 1
    texts = main_texts(part.column("html").to_pylist(), None if alone else np.asarray(often.column("key"), dtype=np.int64))
    return pa.table({"row": part.column("row"), "text": pa.array(texts, pa.string())})


def extract_main_text(pages: DataFrame, keep: list[Column], url_col: str = "url", html_col: str = "html", part_pages: int = PART_PAGES) -> DataFrame:
    """(row, text): ``row`` is a struct of the ``keep`` columns of each page, ``text`` its main text.

    Blocks are trimmed, white space inside a block is one space, character references are decoded and
    blocks joined by an empty line. Pages of a host are dealt by a hash into parts of about
    ``part_pages``, so a host of any size is many tasks; where there are several, the pages that share a
    substring are counted over all parts. Null and empty pages, and pages without text, give ''. A null url, or one
    without a host, belongs to the host ''. Repeated rows are separate pages that count as one when
    repeats are counted. An empty table gives no rows; other columns do not matter.
    """
    rows = pages.select(F.struct(*keep).alias("row"), host_of(F.col(url_col)).alias("host"), F.col(html_col).cast("string").alias("html"))
    sizes = rows.groupBy("host").agg(F.ceil(F.count(F.lit(1)) / part_pages).cast("int").alias("parts"))
    # hosts of one part need no number; a short table of the others keeps the pages out of a shuffle by host
    dealt = rows.join(small_side(sizes.filter("parts > 1")), "host", "left").withColumn("parts", F.coalesce("parts", F.lit(1))).withColumn(
        "part", F.pmod(F.xxhash64("html", "row"), F.col("parts")).cast("bigint"))
    keys = materialize(dealt.filter("parts > 1").select("host", "part", "html").groupBy("host", "part").applyInArrow(
        _part_keys, "host string, part bigint, key bigint, page bigint"), "host_keys")
    often = keys.groupBy("host", "key").agg(F.countDistinct("page").alias("pages")).filter(F.col("pages") >= MIN_PAGES)
    often = materialize(keys.select("host", "part", "key").distinct().join(often.select("host", "key"), ["host", "key"]), "host_repeats")
    schema = dealt.select("row", F.lit("").alias("text")).schema
    return dealt.select("host", "part", "parts", "row", "html").groupBy("host", "part").cogroup(
        often.groupBy("host", "part")).applyInArrow(_extract, schema)


def extraction_report(pages: DataFrame) -> DataFrame:
    found = extract_main_text(pages, [F.col("page_id"), F.col("url")])
    return found.select("row.page_id", "row.url", "text", F.char_length("text").cast("bigint").alias("n_chars"))
