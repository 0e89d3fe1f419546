"""Main text of web pages: text blocks, minus what the nearest page of the same host has in common."""

from __future__ import annotations

import html
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerlight.llm.common import slices
from peerlight.sources.snapshots import materialize

# Elements whose content is never read, elements that are page furniture, and elements within a line.
RAW_TAGS = frozenset("script style noscript template iframe object svg math canvas textarea title xmp".split())
FURNITURE_TAGS = frozenset("nav aside footer form button select dialog menu head".split())
INLINE_TAGS = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span "
    "strike strong sub sup time tt u var wbr input".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ARTICLE_TAGS = frozenset(["article", "main"])
# Words of a class, id or role that name page furniture.
FURNITURE_WORDS = frozenset(
    "ad ads advert adverts advertisement banner sponsor sponsored promo nav navbar navigation menu breadcrumb breadcrumbs "
    "sidebar footer masthead cookie cookies consent notice notices gdpr popup modal newsletter subscribe signup login "
    "comment comments disqus reply replies share sharing social related recommended pagination pager widget".split()
)

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)>?", re.S)
_NAMED = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[a-z]+")

# Pages of a host that one task compares, about: larger hosts are cut along the order of their paths. A hash of the page
# says where a cut may fall, so nothing has to be sorted to find them; one in EVERY of these becomes a cut, for even pieces.
HOST_PAGES = 500
EVERY = 4
# Cuts known to every task (some 100 bytes each): more pages than HOST_PAGES times this make larger pieces, not more.
CUTS = 50_000


def _is_furniture(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in FURNITURE_TAGS or tag == "header" and not in_article:
        return True
    if tag in ARTICLE_TAGS or tag in ("body", "html") or "=" not in attributes:
        return False
    named = set(_WORD.findall(" ".join("".join(m) for m in _NAMED.findall(attributes)).lower()))
    return not FURNITURE_WORDS.isdisjoint(named) or "header" in named and not in_article


def text_lines(page: str) -> tuple[list[str], list[bool]]:
    """Text blocks of a page outside its furniture, in page order, and whether each lies in an article.

    A block ends where an element starts or ends that is not part of a line. Character references are
    decoded, white space becomes single spaces, blocks without text are left out. Pages may be cut off anywhere.
    """
    lines: list[str] = []
    inside: list[bool] = []
    parts: list[str] = []
    # Open elements as (tag, begins furniture, begins an article).
    stack: list[tuple[str, bool, bool]] = []
    hidden = articles = 0

    def end_block() -> None:
        if parts:
            line = " ".join(html.unescape("".join(parts)).split())
            parts.clear()
            if line:
                lines.append(line)
                inside.append(articles > 0)

    at = 0
    while at < len(page):
        found = _TOKEN.search(page, at)
        if not hidden:
            parts.append(page[at : found.start() if found else len(page)])
        if not found:
            break
        at, tag = found.end(), (found[2] or "").lower()
        if not tag:
            continue
        if tag in INLINE_TAGS:
            if tag == "br" and not hidden:
                parts.append(" ")
            if tag in VOID_TAGS or not _is_furniture(tag, found[3], articles > 0):
                # Inline elements are tracked only if they begin furniture.
                if not (found[1] and any(entry[0] == tag for entry in stack[-1:])):
                    continue
        end_block()
        if tag == "body":
            # Ends an open head, and with it everything else.
            stack.clear()
            hidden = articles = 0
        if found[1]:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == tag:
                    for _, furniture, article in stack[depth:]:
                        hidden -= furniture
                        articles -= article
                    del stack[depth:]
                    break
        elif tag in RAW_TAGS:
            close = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(page, at)
            at = page.find(">", close.start()) + 1 or len(page) if close else len(page)
        elif tag not in VOID_TAGS and not found[3].rstrip().endswith("/"):
            if tag in ("p", "li") and stack and stack[-1][0] == tag:
                # These end where the next of their kind begins.
                _, furniture, article = stack.pop()
                hidden -= furniture
                articles -= article
            furniture, article = _is_furniture(tag, found[3], articles > 0), tag in ARTICLE_TAGS
            if tag != "p" or furniture:
                stack.append((tag, furniture, article))
                hidden += furniture
                articles += article
    end_block()
    return lines, inside


def common_lines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Marks the lines of `a` (as numbers) that a longest common subsequence with `b` holds.

    Common ends are matched first; between them, lines that only one side has are left out, and the rest
    is aligned by Hunt and Szymanski's method, whose work grows with the matches.
    """
    shared = np.zeros(len(a), bool)
    least = min(len(a), len(b))
    differ = np.flatnonzero(a[:least] != b[:least])
    head = int(differ[0]) if len(differ) else least
    tail_differ = np.flatnonzero(a[len(a) - least + head :][::-1] != b[len(b) - least + head :][::-1])
    tail = int(tail_differ[0]) if len(tail_differ) else least - head
    shared[:head] = True
    shared[len(a) - tail :] = True
    where: dict[int, list[int]] = {}
    for j in range(len(b) - tail - 1, head - 1, -1):
        where.setdefault(int(b[j]), []).append(j)
    ends: list[int] = []
    links: list[tuple] = []
    for i in range(head, len(a) - tail):
        for j in where.get(int(a[i]), ()):
            at = bisect_left(ends, j)
            link = (i, links[at - 1] if at else None)
            if at == len(ends):
                ends.append(j)
                links.append(link)
            else:
                ends[at], links[at] = j, link
    chain = links[-1] if links else None
    while chain:
        shared[chain[0]] = True
        chain = chain[1]
    return shared


def _own_lines(lines: list[str], inside: list[bool], others: list[list[str]]) -> list[str]:
    """Lines of a page without furniture.

    The first of the `others` that is no copy decides: lines shared with it go, but within a declared article
    only those of the shared runs at the page's start and end, as an article may well repeat a sentence.
    A page that shares more than half of either's characters is a copy and tells nothing about templates.
    """
    declared = any(inside)
    if not lines:
        return []
    for other in others:
        numbers = dict(zip(dict.fromkeys(lines + other), count()))
        shared = common_lines(np.array([numbers[x] for x in lines]), np.array([numbers[x] for x in other], int))
        same = sum(len(x) for x, s in zip(lines, shared) if s)
        if 2 * same > min(sum(map(len, lines)), sum(map(len, other))):
            continue
        head = int(np.argmin(shared)) if not shared.all() else len(lines)
        tail = int(np.argmin(shared[::-1])) if not shared.all() else len(lines)
        edge = [i < head or i >= len(lines) - tail for i in range(len(lines))]
        gone = [s and (not x or e) for s, x, e in zip(shared, inside, edge)]
        lines = [x for x, g in zip(lines, gone) if not g]
        inside = [x for x, g in zip(inside, gone) if not g]
        break
    return [x for x, i in zip(lines, inside) if i or not declared]


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host in lower case and path of a URL, without query, fragment, final slash and `.htm(l)`."""
    rest = F.regexp_replace(F.regexp_replace(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://", ""), r"[?#].*$", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/]*(/.*)$", 1), r"(\.html?)?/*$", "")
    return F.lower(F.substring_index(rest, "/", 1)), path


def _nearness(a: str, b: str) -> tuple[int, int]:
    """How near two paths lie: common leading characters, then likeness in length."""
    common = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return common, -abs(len(a) - len(b))


def _place(path: str, page_id: int | None) -> tuple[str, bool, int]:
    """Where a page stands among those of its host; pages of equal place stand in the order of their lines."""
    return path, page_id is None, page_id or 0


def _cuts(places: DataFrame, host_pages: int) -> tuple[dict[str, list[tuple]], dict[str, dict[int, tuple]]]:
    """Per host of more than `host_pages` pages, the first place of every piece but piece 0, and the last place of each piece.

    `places` holds the host, path and page_id of all pages. Only cuts come to the driver.
    """
    crowded = materialize(places.groupBy("host").count().filter((F.col("count") > host_pages) & (F.col("host") != "")))
    pages = crowded.agg(F.coalesce(F.sum("count"), F.lit(0))).scalar()
    step = F.greatest(F.lit(host_pages), F.ceil(pages / CUTS))
    # Hosts smaller than a piece stay whole.
    large = crowded.filter(F.col("count") > step).select("host")
    step = F.greatest(F.floor(step / EVERY), F.lit(1))
    inside = places.join(large, "host", "left_semi")
    chosen = F.pmod(F.xxhash64("host", "path", "page_id"), step) == 0
    firsts: dict[str, list[tuple]] = {}
    for row in inside.filter(chosen).distinct().toLocalIterator():
        firsts.setdefault(row["host"], []).append(_place(row["path"], row["page_id"]))
    firsts = {host: cuts for host, found in firsts.items() if (cuts := sorted(found)[EVERY - 1 :: EVERY])}
    if not firsts:
        return {}, {}

    def piece(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pydict()
            number = [bisect_right(firsts.get(h, ()), _place(p, i)) for h, p, i in zip(*(rows[c] for c in ("host", "path", "page_id")))]
            yield batch.append_column("piece", pa.array(number, pa.int32()))

    numbered = inside.mapInArrow(piece, "host string, path string, page_id long, piece int")
    last = F.max(F.struct("path", F.col("page_id").isNull().alias("unknown"), F.coalesce("page_id", F.lit(0)).alias("id")))
    lasts: dict[str, dict[int, tuple]] = {}
    for row in numbered.groupBy("host", "piece").agg(last.alias("last")).toLocalIterator():
        lasts.setdefault(row["host"], {})[row["piece"]] = tuple(row["last"])
    return firsts, lasts


def extract_main_text(pages: DataFrame, host_pages: int = HOST_PAGES) -> DataFrame:
    """(page_id, url, text, n_chars): the article of every page, its blocks joined by blank lines.

    Pages of a host are put in order of their paths; each is compared with the nearer of its two neighbours,
    or with the other one where that is a copy, and loses the lines both share (longest common subsequence).
    Menus, notices and the like that HTML names (by element, class, id or role) go in any case, and so does
    what lies outside an `article` or `main` element on pages that have one. Only extracted lines are
    shuffled, once. A host with more than `host_pages` pages is cut into pieces along that order, so no host ends up in
    one task; the pages at the ends of a piece are also sent to the piece beside it, so that every page meets the
    neighbours it has in its whole host. `host_pages` steers placement only: results do not depend on it.

    Every row comes back, repeated ones too. NULL or empty html and pages of nothing but furniture have an
    empty text. Pages without a URL or host have no neighbours. Other columns are ignored.
    """
    host, path = url_parts(F.col("url"))
    known = F.coalesce(host, F.lit("")) != ""
    place = [
        F.when(known, host).otherwise("").alias("host"),
        F.coalesce(path, F.lit("")).alias("path"),
        F.col("page_id").cast("long").alias("page_id"),
    ]
    firsts, lasts = _cuts(pages.select(*place), host_pages)

    def pieces(host: str, path: str, page_id: int | None) -> list[int]:
        """The page's own piece, and the pieces that it stands beside."""
        cuts = firsts.get(host)
        if not cuts:
            return [0]
        at = _place(path, page_id)
        own = bisect_right(cuts, at)
        before = [own - 1] if own and cuts[own - 1] == at else []
        after = [own + 1] if own < len(cuts) and lasts[host][own] == at else []
        return [own, *before, *after]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "html"):
                found = [text_lines(text or "") for text in batch.column("html").to_pylist()]
                places = [pieces(*p) for p in zip(*(batch.column(c).to_pylist() for c in ("host", "path", "page_id")))]
                kept = {c: batch.column(c) for c in ("page_id", "url", "host", "path")}
                kept["lines"] = pa.array([x[0] for x in found], pa.list_(pa.string()))
                kept["inside"] = pa.array([x[1] for x in found], pa.list_(pa.bool_()))
                rows = pa.array([i for i, p in enumerate(places) for _ in p], pa.int32())
                spread = pa.record_batch(kept).take(rows)
                spread = spread.append_column("piece", pa.array([x for p in places for x in p], pa.int32()))
                yield spread.append_column("beside", pa.array([n > 0 for p in places for n in range(len(p))], pa.bool_()))

    def compare(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: (*_place(r["path"], r["page_id"]), r["lines"]))
        own, texts = [], []
        for i, row in enumerate(rows):
            if row["beside"]:
                continue
            near = [rows[j] for j in (i - 1, i + 1) if row["host"] and 0 <= j < len(rows)]
            near.sort(key=lambda r: _nearness(row["path"], r["path"]), reverse=True)
            texts.append("\n\n".join(_own_lines(row["lines"], row["inside"], [r["lines"] for r in near])))
            own.append(row)
        return pa.table(
            {
                "page_id": pa.array([r["page_id"] for r in own], pa.int64()),
                "url": pa.array([r["url"] for r in own], pa.string()),
                "text": pa.array(texts, pa.string()),
            }
        )

    parsed = pages.select(*place, "url", "html").mapInArrow(
        parse, "page_id long, url string, host string, path string, lines array<string>, inside array<boolean>, piece int, beside boolean"
    )
    # Pages of no host are not compared and may go anywhere.
    group = F.when(F.col("host") == "", F.pmod(F.xxhash64("path", "page_id"), F.lit(1 << 20))).otherwise(F.col("piece"))
    dealt = parsed.withColumn("piece", group)
    texts = dealt.groupBy("host", "piece").applyInArrow(compare, "page_id long, url string, text string")
    return texts.withColumn("n_chars", F.length("text").cast("long"))
