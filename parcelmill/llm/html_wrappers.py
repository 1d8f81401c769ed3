"""Main text of web pages by wrappers: union-free regular expressions over the tokens of a host's pages.

Each page becomes a sequence of items (elements with their items inside, and text slots); neighbours that
repeat become one repeated group. The wrapper of a host starts as its first page and is aligned with each
further one: where items match they are merged, with texts that differ becoming variable slots; what has no
partner becomes optional; what appears several times in a row, repeated. Tasks align their own pages first, and
partial wrappers are aligned again by host and salt, then by host, so a host with a third of all pages is
never in one task.

The wrapper says where a host keeps its articles, and which slots hold the same text on every page. Pages
meet their host's wrapper in a join on the host. What decides in practice are the lists of tags and marks below.
"""

import html as entities
import json
import re
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import reduce
from typing import NamedTuple
from zlib import crc32

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from parcelmill.llm.common import written

#: Partial wrappers of a host meet by salt first.
SALTS = 32
#: Hosts and distinct page shapes that a task holds before it hands its partial wrappers on.
HELD_SHAPES = 5000
#: Blocks that stand in each other, as wrappers see them: what is nested deeper counts as part of the block at this depth.
#: Its text stays, in blocks of its own; only its place in the wrapper is that of its ancestor.
DEEPEST = 200

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes template noscript svg math object audio video canvas select".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td "
    "tfoot th thead tr ul".split()
)
#: Elements that never belong to an article.
OUTSIDE = frozenset("head nav footer aside form dialog menu button fieldset".split())
#: Words in class, id or role that mark what is not the article.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs contentinfo consent cookie cookies footer "
    "gdpr header login masthead menu modal nav navbar navigation newsletter notice notices notification pager pagination paywall popup "
    "promo promotion recommended related search share sharing sidebar signup skip social sponsor sponsored subscribe subscription "
    "tags teaser toolbar widget complementary alert".split()
)
COMMENTS = frozenset("comment comments commentlist disqus discussion respond replies reactions".split())
ARTICLES = frozenset("article main".split())
#: What an opening tag closes, if it is open above the nearest border.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
    "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}), "tfoot": ({"tbody", "tr", "td", "th"}, {"table"}), "body": ({"head"}, {"html"}),
}
_P_BORDERS = frozenset({"td", "th", "table", "button", "object", "caption"})
_P_CLOSES = (frozenset("p"), _P_BORDERS)
_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|([^<]++|<)""", re.S
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_PIECE = re.compile(r"[a-z]+|[0-9]+")


class Tag(NamedTuple):
    """An open element: its name, its path of block elements, that of its innermost block, and how its texts count."""

    name: str
    path: str
    block: str
    out: bool
    soft: bool
    comment: bool
    link: bool


def _marks(attributes: str) -> tuple[str, bool, bool]:
    """Label suffix of an element, and whether it is marked as no article, or as reader comments."""
    found = {}
    for m in _ATTRIBUTE.finditer(attributes):
        name = m[1].lower()
        if name in ("class", "id", "role", "itemprop") and name not in found:
            found[name] = entities.unescape(m[2] or m[3] or m[4] or "").lower()
    if not found:
        return "", False, False
    names = [n for key in ("class", "id", "role") for n in found.get(key, "").split()]
    words = {w for n in names if not n.startswith(("has-", "no-", "with-", "is-")) for w in _PIECE.findall(n)}
    label = "".join(f".{n}" for n in sorted(set(names)) if not any(c.isdigit() for c in n))
    if found.get("role") == "main" or found.get("itemprop") == "articlebody":
        label += "!main"
    return label, bool(words & MARKS), bool(words & COMMENTS)


_ROOT = Tag("", "", "", False, False, False, False)


def tokens(page: str) -> Iterator[tuple[str | None, Tag]]:
    """(text or None, innermost element) of a page in order; None marks the border of a block."""
    stack: list[Tag] = [_ROOT]
    opened: dict[tuple[int, str, str], Tag] = {}
    at, size = 0, len(page)
    while at < size:
        m = _TOKEN.match(page, at)
        at = m.end()
        if m[7]:
            yield (entities.unescape(m[7]) if "&" in m[7] else m[7]), stack[-1]
            continue
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        if m[1] or m[4]:
            if stack[-1].name == name or any(t.name == name for t in stack):
                while stack[-1].name != name:
                    stack.pop()
                stack.pop()
                if name in BLOCK:
                    yield None, stack[-1]
            continue
        if name in BLOCK:
            _close(stack, name)
            yield None, stack[-1]
        if name == "br":
            yield " ", stack[-1]
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\b[^>]*>?", re.I).search(page, at)
            at = end.end() if end else size
            continue
        attributes = m[3] or m[6] or ""
        if name in VOID or attributes.endswith("/") and name not in BLOCK:
            continue
        top = stack[-1]
        known = opened.get((id(top), name, attributes))
        if known is not None:
            stack.append(known)
            continue
        label, marked, comment = _marks(attributes) if "=" in attributes else ("", False, False)
        main = name in ARTICLES or "!main" in label
        if main or name in ("html", "body"):
            marked = False
        out, soft = top.out or name in OUTSIDE or name == "header" and "article" not in top.path, (top.soft or marked) and not main
        path = f"{top.path}/{name}{label}" if (name in BLOCK or label) and top.path.count("/") < DEEPEST else top.path
        tag = Tag(name, path, path if name in BLOCK or main else top.block, out, soft, top.comment or comment and name not in ("html", "body", "main"), top.link or name == "a")
        opened[id(top), name, attributes] = tag
        stack.append(tag)


def _close(stack: list[Tag], name: str) -> None:
    """Close what the opening tag of a block ends: an open paragraph, and items of the same list or row."""
    for names, limits in (_P_CLOSES, CLOSES[name]) if name in CLOSES else (_P_CLOSES,):
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].name in limits:
                break
            if stack[k].name in names:
                del stack[k:]
                break


def dropped(tag: Tag) -> bool:
    return tag.out or tag.soft or tag.comment


# --- wrappers -----------------------------------------------------------------------------------------
# An item is [key, optional, repeated, pages, items, text hash or None, characters, characters in links].
# The key is an element's label, "#" for a text slot, or "(a b)" for a group.


def skeleton(page: str) -> tuple[str, list]:
    """The shape of a page, and per text slot in order [hash, characters, characters in links]."""
    root: list = ["", False, False, 1, [], None, 0, 0]
    open_items: dict[str, list] = {"": root}
    path, text, links = "", [], 0

    def flush() -> None:
        nonlocal text, links
        block = " ".join("".join(text).split())
        if block:
            parent = open_items[path]
            parent[4].append(["#", False, False, 1, [], crc32(block.encode("utf-8", "replace")), len(block), min(links, len(block))])
        text, links = [], 0

    for piece, tag in tokens(page):
        if piece is None or tag.path != path:
            flush()
            path = tag.path
            _enter(open_items, path, piece is None)
        if piece is not None:
            text.append(piece)
            links += len(piece) * tag.link
    flush()
    items = _folded(root[4])
    slots: list = []
    return json.dumps(_shape(items, slots)), slots


def _enter(open_items: dict[str, list], path: str, fresh: bool) -> None:
    """Make sure that the element of a path is there; elements that ended are entered anew."""
    if path in open_items:
        for deeper in [p for p in open_items if p.startswith(path + "/")] if fresh else ():
            del open_items[deeper]
        return
    parent, _, label = path.rpartition("/")
    _enter(open_items, parent, False)
    item = [label, False, False, 1, [], None, 0, 0]
    open_items[parent][4].append(item)
    open_items[path] = item


def _shape(items: list, slots: list) -> list:
    out = []
    for key, optional, repeated, _, inner, text, chars, links in items:
        if key == "#":
            slots.append([text, chars, links])
        out.append([key, optional, repeated, _shape(inner, slots)])
    return out


def _filled(shape: list, slots: Iterator[list], pages: int) -> list:
    out = []
    for key, optional, repeated, inner in shape:
        text, chars, links = next(slots) if key == "#" else (None, 0, 0)
        out.append([key, optional, repeated, pages, _filled(inner, slots, pages), text, chars, links])
    return out


def _folded(items: list) -> list:
    """Neighbours of equal key become one repeated item, then repeated pairs a repeated group."""
    for item in items:
        item[4] = _folded(item[4])
    out: list = []
    for item in items:
        if out and out[-1][0] == item[0]:
            out[-1] = _merged(out[-1], item, item[3])
            out[-1][2] = True
        else:
            out.append(item)
    k, grouped = 0, []
    while k < len(out):
        n = 1
        while k + 2 * n + 1 < len(out) and all(out[k + j][0] == out[k + 2 * n + j][0] for j in (0, 1)) and out[k][0] != out[k + 1][0]:
            n += 1
        if n > 1:
            pair = reduce(lambda a, b: [_merged(x, y, x[3]) for x, y in zip(a, b, strict=True)], [out[k + 2 * j : k + 2 * j + 2] for j in range(n)])
            grouped.append([f"({pair[0][0]} {pair[1][0]})", False, True, pair[0][3], pair, None, 0, 0])
            k += 2 * n
        else:
            grouped.append(out[k])
            k += 1
    return grouped


def _merged(a: list, b: list, pages: int) -> list:
    """Two items of equal key as one; texts that differ leave a variable slot."""
    same = a[5] if a[5] == b[5] else None
    return [a[0], a[1] or b[1], a[2] or b[2], pages, aligned(a[4], b[4]) if a[4] or b[4] else [], same, a[6] + b[6], a[7] + b[7]]


def aligned(a: list, b: list) -> list:
    """The sequence that covers both: items without a partner become optional, neighbours of equal key repeated."""
    if [x[0] for x in a] == [x[0] for x in b]:
        return [_merged(x, y, x[3] + y[3]) for x, y in zip(a, b, strict=True)]
    out: list = []
    for kind, a0, a1, b0, b1 in SequenceMatcher(None, [x[0] for x in a], [x[0] for x in b], autojunk=False).get_opcodes():
        if kind == "equal":
            out += [_merged(x, y, x[3] + y[3]) for x, y in zip(a[a0:a1], b[b0:b1], strict=True)]
        else:
            out += [[x[0], True, *x[2:]] for x in (*a[a0:a1], *b[b0:b1])]
    folded: list = []
    for item in out:
        if folded and folded[-1][0] == item[0]:
            last = folded[-1]
            folded[-1] = _merged(last, item, max(last[3], item[3]))
            folded[-1][2] = True
        else:
            folded.append(item)
    return folded


def _partial_wrappers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per host of a task its pages' wrapper: pages of equal shape are counted, distinct shapes aligned."""
    held: dict[str, dict[str, list]] = {}
    shapes = 0
    for batch in batches:
        for host, page in zip(batch["host"], batch["html"], strict=True):
            shape, slots = skeleton(page or "")
            own = held.setdefault(host, {})
            if shape not in own:
                own[shape] = [1, slots]
                shapes += 1
            else:
                own[shape][0] += 1
                for s, (text, chars, links) in zip(own[shape][1], slots, strict=True):
                    s[0], s[1], s[2] = (s[0] if s[0] == text else None), s[1] + chars, s[2] + links
        if shapes >= HELD_SHAPES:
            yield _handed(held)
            held, shapes = {}, 0
    if held:
        yield _handed(held)


def _handed(held: dict[str, dict[str, list]]) -> pd.DataFrame:
    rows = []
    for host, own in held.items():
        wrapper = reduce(aligned, [_filled(json.loads(shape), iter(slots), n) for shape, (n, slots) in sorted(own.items())])
        rows.append((host, crc32(json.dumps(wrapper).encode()) % SALTS, sum(n for n, _ in own.values()), json.dumps(wrapper)))
    return pd.DataFrame(rows, columns=["host", "salt", "pages", "wrapper"])


def _align(rows: pd.DataFrame) -> pd.DataFrame:
    wrapper = reduce(aligned, map(json.loads, sorted(rows["wrapper"])))
    return pd.DataFrame({"host": [rows["host"].iloc[0]], "salt": [0], "pages": [int(rows["pages"].sum())], "wrapper": [json.dumps(wrapper)]})


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """Per `host` of `host, html` rows its wrapper as JSON and the number of its pages."""
    shape = "host string, salt int, pages long, wrapper string"
    partial = pages.select("host", "html").mapInPandas(_partial_wrappers, shape)
    by_salt = partial.groupBy("host", "salt").applyInPandas(_align, shape)
    return by_salt.groupBy("host").applyInPandas(_align, shape).select("host", "pages", "wrapper")


# --- extraction ---------------------------------------------------------------------------------------


def _names(key: str) -> str:
    return re.split(r"[.!]", key, maxsplit=1)[0]


def reading(wrapper: list, pages: int) -> dict:
    """What a wrapper says: paths of its article elements, and the text of slots that never vary."""
    articles: list[str] = []
    mains: list[str] = []
    fixed: dict[str, int] = {}

    def walk(items: list, path: str, inside: bool) -> None:
        for key, _, repeated, count, inner, text, _, _ in items:
            if key.startswith("("):
                walk(inner, path, inside)
                continue
            if key == "#":
                if text is not None and not repeated and pages >= 3 and 2 * count > pages:
                    fixed[path] = text
                continue
            own, name = f"{path}/{key}", _names(key)
            if name == "article" and not inside:
                articles.append(own)
            elif (name == "main" or "!main" in key) and not inside:
                mains.append(own)
            walk(inner, own, inside or name == "article")

    walk(wrapper, "", False)
    return {"articles": sorted(set(articles)), "mains": sorted(set(mains)), "fixed": fixed}


def extract(page: str | None, told: dict) -> str:
    """The article's blocks. Where a page has none of its host's article elements, its main elements; else all
    text that is not marked, is not mostly links and does not stand on all pages of the host."""
    places = (tuple(told.get("articles", ())), tuple(told.get("mains", ())))
    found: list[list[str]] = [[], [], []]
    text: list[str] = []
    links, slot, own = 0, _ROOT, ""  # `own`: path of the block in which the text begins, which an opening tag's border does not give

    def flush() -> None:
        nonlocal text, links
        block = " ".join("".join(text).split())
        if block and not dropped(slot):
            for k, paths in enumerate(places):
                if any(own == p or own.startswith(p + "/") for p in paths):
                    found[k].append(block)
            if 2 * links <= len(block) and told.get("fixed", {}).get(slot.path) != crc32(block.encode("utf-8", "replace")):
                found[2].append(block)
        text, links = [], 0

    block_path = ""
    for piece, tag in tokens(page or ""):
        if piece is None or dropped(tag) != dropped(slot):
            flush()
            slot, block_path = tag, tag.path
        if piece is not None:
            if not text:
                own = tag.block
                slot = tag if not tag.path.startswith(block_path + "/") else slot
            text.append(piece)
            links += len(piece.strip()) * tag.link
    flush()
    return "\n".join(next((f for f in found if f), []))


def host_of(url: Column) -> Column:
    """The host of an address in lower case; without one, the empty text."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def _readings(wrappers: pd.Series, pages: pd.Series) -> pd.Series:
    return pd.Series([json.dumps(reading(json.loads(w), int(n))) for w, n in zip(wrappers, pages, strict=True)])


def _texts(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    known: dict[str, dict] = {}
    for pages, readings in parts:
        out = []
        for page, told in zip(pages, readings, strict=True):
            if told not in known:
                if len(known) >= HELD_SHAPES:
                    known.clear()
                known[told] = json.loads(told) if told else {}
            out.append(extract(page, known[told]))
        yield pd.Series(out, dtype="object")


def extract_pages(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Per row `page_id, url, text, n_chars`.

    A null or empty page has the empty text; pages without an address share one wrapper. Repeated rows each get
    a row; other columns are left out; no rows give no rows. What wrappers say is small and is stored, so the
    join broadcasts it only when its size is known to allow that; else adaptive execution splits large hosts.
    """
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"), host_of(F.col(url)).alias("host"))
    told = pandas_udf(_readings, "string")
    readings = written(infer_wrappers(rows).select("host", told("wrapper", "pages").alias("told")), "page-wrappers")
    texts = pandas_udf(_texts, "string").asNondeterministic()
    return (
        rows.join(readings, "host", "left")
        .select("page_id", "url", texts("html", "told").alias("text"))
        .withColumn("n_chars", F.length("text").cast("long"))
    )
