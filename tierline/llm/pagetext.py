"""Main text of web pages, by their markup and by what repeats on a host.

The blocks outside menus, footers and the like are weighed against the host's other pages: the suffixes of all
the host's token streams are grouped by their first tokens, and runs that stand on several different pages are
boilerplate. Repetition alone cannot tell: copies of an article repeat like a footer does, and an advert can be
unique. So a page that marks its article gives at most that article's blocks, and a run in an article is a vote
against its being boilerplate, there and on the host's other pages.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import by_size, cut, small_batches, text_of

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>?|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>"']|"[^"]*+"|'[^']*+'|["'])*?)(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden|style)\b\s*(?:=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
#: Elements whose content is not text of the page.
_RAW = {"script", "style", "template", "noscript", "iframe", "svg", "textarea", "title", "object", "canvas", "math", "xmp"}
#: Elements that hold a site's frame or its controls.
_FRAME = {"nav", "footer", "aside", "form", "head", "button", "select", "dialog", "menu", "datalist", "fieldset", "audio", "video"}
_BLOCKS = set(
    "address article blockquote body caption center dd details div dl dt figcaption figure h1 h2 h3 h4 h5 h6 header hr html li main ol p pre "
    "section summary table tbody td tfoot th thead tr ul nav footer aside form".split()
)
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu", "menubar", "toolbar"}
#: Words of a class or id that say what a container holds: adverts and controls for sharing, what others wrote, a site's frame.
_ADVERT = "ads ad adverts advert advertisement advertising sponsored sponsor promotion promo sharing share".split()
_OTHERS = "comments comment replies reply disqus teasers teaser related recommended".split()
_SITE = (
    "banner cookies cookie consent gdpr notices notice newsletter subscribe popup modal overlay sidebar menu navigation navbar nav breadcrumbs "
    "breadcrumb social footer masthead pagination pager toolbar"
).split()
#: Words that may stand beside them; with any other word a name says something else ("related-work").
_BESIDE = (
    "site page post posts article articles story stories blog news main global top bottom left right inner outer upper lower user reader box block "
    "list section container wrapper wrap area bar row column col panel pane group items item links link buttons button icons icon text content body "
    "title heading label header module component widget unit slot zone region strip cards card tree thread form signup email mobile desktop sticky "
    "primary secondary message info count"
).split()
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
_KINDS = {
    kind: re.compile(
        rf"(?:(?:{'|'.join(_BESIDE + _ADVERT + _OTHERS + _SITE)}|(?<![a-z])[a-z](?![a-z])|\d+)[_-]*)*?(?:{'|'.join(words)})"
        rf"(?:[_-]*(?:{'|'.join(_BESIDE + _ADVERT + _OTHERS + _SITE)}|(?<![a-z])[a-z](?![a-z])|\d+))*"
    )
    for kind, words in {"advert": _ADVERT, "others": _ADVERT + _OTHERS, "any": _ADVERT + _OTHERS + _SITE}.items()
}
#: Elements that a class or id can make a frame; a paragraph or a stretch of one is left out as an advert only, a heading never.
_CONTAINERS = set("div section ul ol li dl dd table tr td th tbody header details figure center address hgroup search summary".split())
_ARTICLE = re.compile(r"""<article\b((?:[^>"']|"[^"]*"|'[^']*')*)""", re.I)
#: What HTML says of tags that may be left out: elements that a tag's search for an open one does not go past.
_SCOPE = {"caption", "table", "td", "th", "marquee", "template"}
_P_SCOPE = _SCOPE | {"button"}
_SPECIAL = _BLOCKS | _SCOPE | {"button", "select", "colgroup", "dir", "hgroup", "menu", "fieldset", "search"}
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
_ENDS_P = _HEADINGS | set(
    "address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer form header hgroup hr li main menu nav "
    "ol p pre search section summary table ul".split()
)
_ROW = {"tr", "td", "th", "caption", "colgroup"}
_SECTIONS = {"tbody", "thead", "tfoot"}
_LIST = _SPECIAL - {"address", "div", "p"}
#: By opening tag: the open elements it ends, and those it does not look past.
_ENDS = {
    "li": ({"li"}, _LIST - {"li"}), "dt": ({"dt", "dd"}, _LIST - {"dt", "dd"}), "dd": ({"dt", "dd"}, _LIST - {"dt", "dd"}),
    "tr": (_ROW, _SECTIONS | {"table"}), "td": ({"td", "th"}, _SECTIONS | {"table", "tr"}), "th": ({"td", "th"}, _SECTIONS | {"table", "tr"}),
    **dict.fromkeys(_SECTIONS, (_ROW | _SECTIONS, {"table"})), "a": ({"a"}, _SPECIAL), "button": ({"button"}, _SCOPE),
    "option": ({"option"}, {"optgroup", "select", "datalist"}), "optgroup": ({"option", "optgroup"}, {"select"}),
}
_IN_HEAD = {"base", "basefont", "bgsound", "link", "meta", "noframes", "head", "html"}


def _lowest(stack: list[str], opened: Counter, ended: set[str], limits: set[str]) -> int:
    """The place of the outermost of the ``ended`` elements above any of ``limits``, or the stack's length."""
    found = len(stack)
    if not any(opened[e] for e in ended):
        return found
    for i in range(len(stack) - 1, -1, -1):
        if stack[i] in ended:
            found = i
        elif stack[i] in limits:
            break
    return found


def _left_after_opening(stack: list[str], opened: Counter, name: str) -> int:
    """How many open elements an opening tag leaves open."""
    keep = len(stack)
    if name not in _IN_HEAD and stack[:1] == ["head"]:
        keep = 0
    if name in _ENDS:
        keep = min(keep, _lowest(stack, opened, *_ENDS[name]))
    if name in _ENDS_P:
        keep = min(keep, _lowest(stack, opened, {"p"}, _P_SCOPE))
    if name in _HEADINGS and keep and stack[keep - 1] in _HEADINGS:
        keep -= 1
    return keep


def _left_after_closing(stack: list[str], opened: Counter, name: str, outside: int) -> int:
    """How many open elements a closing tag leaves open. Of the first ``outside``, an article ends by its own tag only."""
    ended = _HEADINGS if name in _HEADINGS else {name}
    if not any(opened[e] for e in ended):
        return len(stack)
    if name == "form":
        limits: set[str] = set()
    elif name in _ROW | _SECTIONS | {"table"}:
        limits = {"table"}
    elif name in _SPECIAL or name in _FRAME:
        limits = _SCOPE | ({"ol", "ul"} if name == "li" else {"button"} if name == "p" else set())
    else:
        limits = _SPECIAL
    for i in range(len(stack) - 1, -1, -1):
        if stack[i] in ended:
            return i
        if stack[i] in limits or i < outside and stack[i] in ("article", "main"):
            break
    return len(stack)


@lru_cache(1 << 14)
def _says(names: str, kind: str) -> bool:
    """Whether any of the names of a class or id is made of a frame's words, joined or not, and words that go with them."""
    return any(len(n) <= 80 and _KINDS[kind].fullmatch(_CAMEL.sub("-", n).lower()) for n in names.split())


def _attributes(rest: str) -> list[tuple[str, str]]:
    return [(a.lower(), v.strip("\"'")) for a, v in _ATTRIBUTE.findall(rest)]


def _of_others(rest: str) -> bool:
    """Whether an article's class says that it is a comment, a teaser of another story or an advert."""
    return any(a == "class" and _says(v, "others") for a, v in _attributes(rest))


def _is_frame(name: str, rest: str, inside: bool, plain: bool) -> bool:
    """Whether an element is left out, ``inside`` an article or not; ``plain`` if an article of the page is no comment or the like."""
    if name in _FRAME or (name == "header" and not inside) or "-" in name and _says(name, "any"):
        return True
    if not rest or name in ("html", "body", "main"):
        return False
    if name == "article":
        return plain and _of_others(rest)
    for attribute, value in _attributes(rest):
        if attribute in ("class", "id"):
            if name in _CONTAINERS or "-" in name:
                said = _says(value, "any")
            else:
                said = attribute == "class" and name not in _HEADINGS and _says(value, "advert")
            if said:
                return True
        value = value.lower()
        if attribute == "role" and value in _ROLES or attribute == "hidden" or attribute == "aria-hidden" and value == "true":
            return True
        if attribute == "style" and "display:none" in value.replace(" ", ""):
            return True
    return False


def blocks(page: str) -> tuple[list[str], bool]:
    """The blocks outside frames, in page order, and whether the page marks them as its article.

    Blocks in ``article`` elements if there are any, else in ``main``, else all.
    """
    found, inside, marked = all_blocks(page)
    return [t for t, own in zip(found, inside) if own or not marked], marked


def all_blocks(page: str) -> tuple[list[str], list[bool], bool]:
    """All blocks outside frames, in page order, whether each is in the article, and whether the page marks one.

    The article is the ``article`` elements if there are any, else ``main``. White space in a block is one
    space and character references are decoded.
    """
    found: list[tuple[str, str]] = []
    parts: list[str] = []
    inside = {"article": 0, "main": 0}
    marked = {"article": False, "main": False}
    stack: list[str] = []
    opened: Counter = Counter()
    plain = any(not _of_others(a) for a in _ARTICLE.findall(page))
    skip, at = -1, 0  # the place in the stack of the frame that is left out, if one is

    def end_block() -> None:
        text = " ".join(html.unescape("".join(parts)).split())
        parts.clear()
        if text:
            found.append(("article" if inside["article"] else "main" if inside["main"] else "", text))

    def leave(keep: int) -> None:
        nonlocal skip
        for i, name in enumerate(stack[keep:], keep):
            opened[name] -= 1
            if name in inside and (skip < 0 or i < skip):
                inside[name] -= 1
        del stack[keep:]
        if keep <= skip:
            skip = -1

    while at < len(page):
        tag = _TAG.search(page, at)
        text = page[at : tag.start() if tag else len(page)]
        if skip >= 0 and stack[-1] == "head" and text.strip():
            leave(len(stack) - 1)
        if skip < 0:
            parts.append(text)
        if not tag:
            break
        at = max(tag.end(), tag.start() + 1)
        name = (tag["name"] or "").lower()
        if not name:
            continue
        opens, closed = not tag["close"], tag["rest"].endswith("/")
        if name in _RAW:
            if opens and not closed:
                end = re.compile(rf"</{re.escape(name)}\b[^>]*>?", re.I).search(page, at)
                at = end.end() if end else len(page)
            continue
        if skip < 0 and name in _BLOCKS:
            end_block()
        elif skip < 0 and name == "br":
            parts.append(" ")
        if not opens:
            leave(_left_after_closing(stack, opened, name, skip if skip >= 0 else len(stack)))
            continue
        leave(_left_after_opening(stack, opened, name))
        if name in _VOID or name in ("html", "body"):
            continue
        if skip < 0 and _is_frame(name, tag["rest"], bool(inside["article"]), plain):
            end_block()
            if closed:
                continue
            skip = len(stack)
        elif skip < 0 and name in inside:
            marked[name] = True
            inside[name] += 1
        elif closed:
            continue
        stack.append(name)
        opened[name] += 1
    end_block()
    for container in ("article", "main"):
        if marked[container]:
            return [t for _, t in found], [where == container or where == "article" for where, _ in found], True
    return [t for _, t in found], [False] * len(found), False


def token_hashes(tokens: list[str], known: dict[str, int]) -> np.ndarray:
    """64-bit hashes of tokens; ``known`` keeps those already hashed."""
    if len(known) > 1 << 19:
        known.clear()
    for t in tokens:
        if t not in known:
            known[t] = int.from_bytes(hashlib.blake2b(t.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
    return np.fromiter((known[t] for t in tokens), np.uint64, len(tokens))


def run_hashes(tokens: np.ndarray, least: int, seed: int) -> np.ndarray:
    """The hash of the first ``least`` tokens of each suffix that has as many."""
    room = max(0, len(tokens) - least + 1)
    factors = np.random.default_rng(1).integers(0, 1 << 63, least, np.uint64) * np.uint64(2) + np.uint64(1)
    out = np.full(room, seed & 0xFFFFFFFFFFFFFFFF, np.uint64)
    for i, factor in enumerate(factors):
        out += tokens[i : i + room] * factor
    out ^= out >> np.uint64(32)
    out *= np.uint64(0x9FB21C651E98DF25)
    return out ^ (out >> np.uint64(29))


def covered(starts: np.ndarray, least: int, size: int) -> np.ndarray:
    """Which of ``size`` tokens lie in a run of ``least`` that begins at one of ``starts``."""
    marks = np.zeros(size + 1, np.int64)
    np.add.at(marks, starts, 1)
    np.add.at(marks, starts + least, -1)
    return np.cumsum(marks[:-1]) > 0


def repeated_tokens(streams: list[list[str]], least: int, pages: int) -> list[np.ndarray]:
    """Which tokens of each stream lie in a run of ``least`` tokens that stands in ``pages`` different streams.

    For streams in memory; ``extract`` counts the same runs over a table. Equal streams count as one.
    """
    known: dict[str, int] = {}
    runs = [run_hashes(token_hashes(s, known), least, 0) for s in streams]
    different = {tuple(s): r for s, r in zip(streams, runs)}
    found, n = np.unique(np.concatenate([np.unique(r) for r in different.values()] or [np.zeros(0, np.uint64)]), return_counts=True)
    often = found[n >= pages]
    return [covered(np.flatnonzero(np.isin(r, often)), least, len(s)) for s, r in zip(streams, runs)]


def repeated_blocks(starts: np.ndarray, sizes: list[int], least: int) -> list[int]:
    """The places of the blocks, of ``sizes`` tokens, most of whose tokens lie in the runs that begin at ``starts``."""
    edges = np.cumsum([0, *sizes])
    before = np.concatenate([[0], np.cumsum(covered(starts, least, int(edges[-1])))])
    return np.flatnonzero(2 * (before[edges[1:]] - before[edges[:-1]]) > np.diff(edges)).tolist()


#: Buckets of the filter that spares most runs the second count. It is of one size for any table, and only saves work.
_BUCKETS = 1 << 24


def extract(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = 8, on_pages: int = 3,
    share: float = 0.1,
) -> DataFrame:
    """One row per page: ``id_col``, ``url_col``, text, n_chars.

    Blocks are joined by an empty line. A run of ``least`` tokens is boilerplate if it stands outside articles on
    ``on_pages`` different pages of a host, and on ``share`` of the host's at least, and on more than have it in their
    article; pages with equal blocks count as one. Blocks mostly of such runs go, and of a page with an article also those outside it. A null page
    is empty, and so is its text; a null url's host is empty; null and repeated ids are allowed. Other columns are
    left out, whatever their names; an empty table gives no rows.
    """
    spark = pages.sparkSession
    kind = pages.schema[id_col].dataType.simpleString()

    def parse(batches):
        for block in by_size(batches, "html", 1 << 22):
            hosts = block.column("host").to_pylist()
            found = [all_blocks(p) for p in block.column("html").to_pylist()]
            names = [hashlib.blake2b(repr((h, b, inside)).encode(), digest_size=8).digest() for h, (b, inside, _) in zip(hosts, found)]
            columns = [
                pa.array([b for b, _, _ in found], pa.list_(pa.string())),
                pa.array([inside for _, inside, _ in found], pa.list_(pa.bool_())),
                pa.array([[len(t.split()) for t in b] for b, _, _ in found], pa.list_(pa.int32())),
                pa.array([marked for _, _, marked in found], pa.bool_()),
                pa.array(np.frombuffer(b"".join(names), np.int64)),
            ]
            yield pa.RecordBatch.from_arrays(
                [block.column("id"), block.column("url"), block.column("site"), *columns],
                ["id", "url", "site", "blocks", "inside", "sizes", "marked", "stream"],
            )

    def runs(batches, chosen: np.ndarray | None):
        """Runs by page and place: those outside articles, or all of a bucket in ``chosen``."""
        known: dict[str, int] = {}
        parts: list[tuple] = []
        waiting = 0

        def batch() -> pa.RecordBatch:
            columns = [np.concatenate(c) for c in zip(*parts)]
            parts.clear()
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["run", "site", "stream", "place", "inside"])

        for block in batches:
            site, stream, own, marks, sizes = (block.column(c) for c in ("site", "stream", "blocks", "inside", "sizes"))
            for i in range(len(block)):
                within = np.repeat(np.array(marks[i].as_py(), bool), np.array(sizes[i].as_py(), np.int64))
                if len(within) < least or (within.all() if chosen is None else not chosen.any()):
                    continue
                keys = run_hashes(token_hashes([t for b in own[i].as_py() for t in b.split()], known), least, site[i].as_py())
                # a run is in one part of the page
                edges = np.concatenate([[0], np.cumsum(within[1:] != within[:-1])])
                at = np.flatnonzero(edges[least - 1 :] == edges[: len(keys)])
                if chosen is None:
                    at = at[~within[at]]
                    at = at[np.unique(keys[at], return_index=True)[1]]
                else:
                    bucket = keys[at] & np.uint64(_BUCKETS - 1)
                    at = at[(chosen[bucket >> np.uint64(3)] >> (7 - (bucket & np.uint64(7)).astype(np.uint8))) & 1 > 0]
                if len(at):
                    waiting += len(at)
                    of = (np.full(len(at), c[i].as_py(), np.int64) for c in (site, stream))
                    parts.append((keys[at].view(np.int64), *of, at.astype(np.int32), within[at]))
                if waiting >= 1 << 17:
                    yield batch()
                    waiting = 0
        if parts:
            yield batch()

    def weigh(batches):
        for batch in batches:
            starts, sizes = batch.column("places").to_pylist(), batch.column("sizes").to_pylist()
            gone = [repeated_blocks(np.unique(np.array(p, np.int64)), n, least) for p, n in zip(starts, sizes)]
            yield pa.RecordBatch.from_arrays([batch.column("stream"), pa.array(gone, pa.list_(pa.int32()))], ["stream", "gone"])

    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").cast("string").alias("url"), text_of(html_col).alias("html"))
    rows = rows.withColumn("host", host).withColumn("site", F.xxhash64("host"))
    shape = f"id {kind}, url string, site long, blocks array<string>, inside array<boolean>, sizes array<int>, marked boolean, stream long"
    parsed = cut(rows.mapInArrow(parse, shape), "pages")

    found = "run long, site long, stream long, place int, inside boolean"
    content = parsed.select("site", "stream", "blocks", "inside", "sizes")
    outside = content.mapInArrow(lambda b: runs(b, None), found).select("run", "stream").distinct()
    often = outside.groupBy("run").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= on_pages)
    with small_batches(spark):
        buckets = often.select(F.col("run").bitwiseAND(F.lit(_BUCKETS - 1)).cast("int").alias("bucket")).distinct().toArrow().column(0).to_numpy()
    bits = np.zeros(_BUCKETS, bool)
    bits[buckets] = True
    chosen = np.packbits(bits)

    likely = cut(content.mapInArrow(lambda b: runs(b, chosen), found).distinct(), "runs")
    votes = likely.select("run", "site", "stream", "inside").distinct().groupBy("run", "site")
    votes = votes.agg(F.count_if(~F.col("inside")).alias("against"), F.count_if("inside").alias("for"))
    votes = votes.where((F.col("against") >= on_pages) & (F.col("against") > F.col("for")))
    hosts = parsed.select("site", "stream").distinct().groupBy("site").agg(F.count(F.lit(1)).alias("streams"))
    frames = votes.join(hosts, "site").where(F.col("against") >= share * F.col("streams")).select("run").distinct()
    places = likely.join(frames, "run").groupBy("stream").agg(F.collect_set("place").alias("places"))
    sizes = parsed.groupBy("stream").agg(F.min("sizes").alias("sizes"))
    gone = cut(places.join(sizes, "stream").mapInArrow(weigh, "stream long, gone array<int>"), "repeated")

    weighed = parsed.join(gone, "stream", "left")
    kept = F.filter("blocks", lambda b, i: (~F.col("marked") | F.get("inside", i)) & ~F.array_contains(F.coalesce("gone", F.array().cast("array<int>")), i))
    texts = weighed.select(F.col("id").alias(id_col), F.col("url").alias(url_col), F.array_join(kept, "\n\n").alias("text"))
    return texts.select("*", F.char_length("text").cast("long").alias("n_chars"))
