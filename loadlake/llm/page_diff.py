"""Main text of HTML pages by differencing each page with its neighbour in URL order on the same host.

Markup is cut into blocks of text, each with what the markup says about it: inside the article, inside a part that is
never the article (menus, headers, footers, asides, forms, scripts, comments by readers, adverts, notices), or open.
Pages are sorted by host and path over the cluster, so that neighbours meet without gathering a host in one task. The
blocks of a page are aligned with its nearest neighbour's by a longest common subsequence; shared ones are template and
deleted, unless the markup puts them inside the article.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Element names of HTML.
SKIPPED = frozenset("script style iframe title textarea".split())  # raw text up to their end tag
DROPPED = frozenset("noscript template svg object head select button math canvas".split())  # end with their parent
IN_HEAD = frozenset("base basefont bgsound link meta title style script noscript template".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
OUTSIDE = frozenset("nav header footer aside form dialog menu fieldset".split())
INSIDE = frozenset("article main".split())
#: Words in class, id or role that mark parts which are not the article.
OUTSIDE_WORDS = frozenset(
    "ad ads adv advert advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice alert popup modal "
    "overlay newsletter subscribe subscription signup login nav navbar navigation navi menu menubar breadcrumb breadcrumbs header masthead "
    "topbar footer foot bottom sidebar side aside rail related recommended recommendations teaser widget share sharing social comment comments "
    "commentlist reply replies respond discussion disqus form search searchbox pagination pager toolbar copyright legal disclaimer tags skip "
    "complementary contentinfo dialog alertdialog".split()
)
INSIDE_WORDS = frozenset("article story post content entry main".split())
#: Elements that loose words may take out as a whole, and the words that are clear inside an article too.
CONTAINERS = frozenset("div section ul ol dl table tbody tr td span".split())
CLEAR_WORDS = frozenset(
    "ad ads adv advert advertisement advertising sponsor sponsored promo comments commentlist share sharing newsletter".split()
)
TITLED = frozenset("article story post entry".split())

_PIECE = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)(?:>|\Z)", re.S
)
_MARKS = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORDS = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")

OPEN, IN, OUT = 0, 1, 2


def _mark(tag: str, attributes: str, around: int = OPEN) -> int:
    """What an element says about the text inside it; ``around`` is the mark of its surroundings.

    Ids and loose words count outside the article and on containers only; inside it only clear classes do.
    """
    if tag in OUTSIDE:
        return OUT
    words: set[str] = set()
    named: set[str] = set()
    if attributes:
        for name, a, b, c in _MARKS.findall(attributes):
            some = _WORDS.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", " ", a or b or c).lower())
            words.update(some)
            if name.lower() != "id":
                named.update(some)
    away = named & CLEAR_WORDS if around == IN else words & OUTSIDE_WORDS
    if away == {"header"} and words & TITLED:  # of an article, as in class="post-header"
        away = set()
    if away and tag in CONTAINERS:
        return OUT
    return IN if tag in INSIDE or (words & INSIDE_WORDS and tag in ("div", "section", "td")) else OPEN


def blocks(page: str | None) -> list[tuple[str, int]]:
    """The page's blocks in order: text with white space settled and references decoded, and its mark.

    A header inside an article is part of it. End tags close the nearest open element of their name; unclosed ones end
    with their parent.
    """
    page = page or ""
    out: list[tuple[str, int]] = []
    held: list[str] = []
    stack: list[tuple[str, int]] = []
    marked = OPEN
    dropping = 0  # open elements of DROPPED

    def flush() -> None:
        text = _SPACE.sub(" ", html.unescape("".join(held))).strip()
        if text:
            out.append((text, marked))
        held.clear()

    at = 0
    while True:
        m = _PIECE.search(page, at)
        if not dropping:
            held.append(page[at : m.start()] if m else page[at:])
        if not m:
            break
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if any(name == tag for name, _ in stack):
                depth = max(k for k, (name, _) in enumerate(stack) if name == tag)
                if tag in BLOCKS and not (dropping and any(name in DROPPED for name, _ in stack[:depth])):
                    flush()
                while stack:
                    name, marked = stack.pop()
                    dropping -= name in DROPPED
                    if name == tag:
                        break
            elif tag in BLOCKS and not dropping:
                flush()
            continue
        if stack and (stack[-1][0] == "head" and tag not in IN_HEAD or tag == "body"):  # its end tag may be left out
            while any(name == "head" for name, _ in stack):
                name, marked = stack.pop()
                dropping -= name in DROPPED
        if tag in SKIPPED:
            end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
            held.append(" ")
            continue
        if tag == "br":
            held.append(" ")
        if tag in BLOCKS and not dropping:
            flush()
            if tag in ("p", "li", "td", "th", "tr", "dt", "dd"):  # closes an open one of its kind
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == tag:
                        marked = stack[k][1]
                        del stack[k:]
                        break
                    if stack[k][0] in BLOCKS and stack[k][0] not in ("p", "li", "td", "th", "dt", "dd"):
                        break
        if tag in EMPTY or m[3].rstrip().endswith("/") and tag not in BLOCKS:
            continue
        stack.append((tag, marked))
        if tag in DROPPED:
            held.append(" ")
            dropping += 1
        own = _mark(tag, m[3], marked) if not dropping else OPEN
        if own == OUT and tag == "header" and marked == IN:
            own = OPEN
        if own == OUT or own == IN and marked == OPEN:
            if own != marked:
                flush()
            marked = own
    flush()
    return out


def common_lines(own: list[int], other: list[int]) -> list[bool]:
    """Which of the own lines are in a longest common subsequence of both.

    Each line may match any equal line of the other page; the matches, by descending place within a line, are an
    increasing subsequence over the other page's places.
    """
    where: dict[int, list[int]] = {}
    for j, line in enumerate(other):
        where.setdefault(line, []).append(j)
    tails: list[int] = []
    ends: list[int] = []
    nodes: list[tuple[int, int]] = []  # own line, node before
    for i, line in enumerate(own):
        for j in reversed(where.get(line, ())):
            t = bisect_left(tails, j)
            nodes.append((i, ends[t - 1] if t else -1))
            if t == len(tails):
                tails.append(j)
                ends.append(len(nodes) - 1)
            else:
                tails[t], ends[t] = j, len(nodes) - 1
    shared = [False] * len(own)
    k = ends[-1] if ends else -1
    while k >= 0:
        i, k = nodes[k]
        shared[i] = True
    return shared


def closeness(a: str, b: str) -> int:
    """Leading path parts in common."""
    n = 0
    for x, y in zip(a.split("/"), b.split("/"), strict=False):
        if x != y:
            break
        n += 1
    return n


def settled(marks: list[int], shared: list[bool], lines: list[str]) -> str:
    """The kept lines in page order: those inside the article and the open lines that the neighbour does not share.

    A page all of whose open lines are shared is a copy, which says nothing about template, so they stay.
    """
    kept = [line for line, m, s in zip(lines, marks, shared, strict=True) if m == IN or m == OPEN and not s]
    return "\n".join(kept or [line for line, m in zip(lines, marks, strict=True) if m == OPEN])


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text``: the main text of every row. Null html is an empty page, a null URL is its own host.

    The neighbour is the page before or after in the order of host and path, whichever shares more of the path; pages
    with equal open lines are passed over. Rows at the ends of a task's range have one neighbour.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [blocks(x) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([[t for t, _ in b] for b in found], pa.list_(pa.string())),
                    pa.array([[m for _, m in b] for b in found], pa.list_(pa.int32())),
                ],
                ["page_id", "url", "lines", "marks"],
            )

    def differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

        def told(before: tuple | None, row: tuple, after: tuple | None) -> tuple:
            page_id, url, lines, marks, host, path = row
            own = [hash(x) for x in lines]
            known = [hash(x) for x, m in zip(lines, marks, strict=True) if m == OPEN]
            near = []
            for other in (before, after):
                if other is not None and other[4] == host and [hash(x) for x, m in zip(other[2], other[3], strict=True) if m == OPEN] != known:
                    near.append((-closeness(path, other[5]), other))
            shared = common_lines(own, [hash(x) for x in min(near, key=lambda x: x[0])[1][2]]) if near else [False] * len(own)
            return page_id, url, settled(marks, shared, lines)

        out: list[tuple] = []
        before = row = None
        for after in rows():
            if row is not None:
                out.append(told(before, row, after))
                if len(out) >= 500:
                    yield batch_of(out)
                    out = []
            before, row = row, after
        if row is not None:
            out.append(told(before, row, None))
        if out:
            yield batch_of(out)

    kind = pages.schema["page_id"].dataType
    id_type = pa.int64() if kind.simpleString() in ("bigint", "int") else pa.string()

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in out], id_type), pa.array([x[1] for x in out], pa.string()), pa.array([x[2] for x in out], pa.string())],
            ["page_id", "url", "text"],
        )

    known = pages.select(F.col("page_id").cast("long" if id_type == pa.int64() else "string").alias("page_id"), "url", "html")
    id_name = "long" if id_type == pa.int64() else "string"
    cut = known.mapInArrow(parse, f"page_id {id_name}, url string, lines array<string>, marks array<int>")
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))
    path = F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    placed = cut.withColumns({"host": host, "path": path})
    ordered = placed.repartitionByRange("host", "path", "page_id").sortWithinPartitions("host", "path", "page_id", "url")
    return ordered.mapInArrow(differ, f"page_id {id_name}, url string, text string")
