"""Main text of pages by the containers that the pages of a host agree on.

First every page scores its containers and names them by a generalised path of
tags and classes; the scores of a path are added up per host. Then every page is
read again with the paths that won on its host, from the article around the winner,
and with the text around it that the host's pages don't share.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vertexmill.llm.tables import join_by, written

#: Paths of a host that its pages are read by, best first.
PATHS = 5

#: Paths of a host that are known to hold the same text on its pages, those of most pages first.
SHARED = 1000

#: What a block adds to the containers around it, from the nearest outwards.
SHARES = (1.0, 0.5, 0.25)

#: Fixed sets of the markup language.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg object select annotation annotation-xml".split())
#: Of these, what holds nothing but text, which a slash in the tag doesn't end; without an end tag code runs to the end.
PLAIN, CODE = frozenset("script style textarea title".split()), frozenset("script style".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer"
    " form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table"
    " tbody td tfoot th thead tr ul".split()
)
CONTAINER = frozenset("article main section div td body html center blockquote".split())
#: Containers of the whole article, and those that also hold what is not part of it.
WHOLE, OUTER = frozenset(["article", "main"]), frozenset(["", "body", "html"])
#: What an opening tag closes when it is still open, up to the nearest of the second set.
CLOSES = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["table", "tr"])),
    "th": (frozenset(["td", "th"]), frozenset(["table", "tr"])),
}
#: Elements that are never part of the main text.
ASIDE = frozenset("nav footer aside form button dialog menu head".split())
#: Of these, what may hold the whole page.
WRAPPERS = frozenset(["form"])
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form".split())
#: Words that say the same as the last word of a class or id (``reader-comments``, ``googleAd``), but for words of the
#: last two sets after them; the second set only alone, or after words of these sets.
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo banner cookie cookies consent gdpr"
    " sidebar nav navbar navigation breadcrumb breadcrumbs footer masthead topbar comment comments disqus replies"
    " sharing newsletter subscribe subscription signup login popup modal overlay widget pagination pager toolbar".split()
)
ASIDE_ALONE = frozenset(
    "notice notices alert side menu discussion reply respond share social related recommended tags skip".split()
)
PLACES = frozenset("site page main global top bottom left right primary secondary post entry blog article".split())
PARTS = frozenset(
    "box list item items container wrapper wrap inner outer area block section slot unit bar button buttons link links"
    " panel holder row col column posts stories form icons thread title text".split()
)
#: Words before it that say that a name is about something else.
ABOUT = frozenset("with without no not has have hide show is of the content".split())

#: A form that holds this share of the page's text outside links is the page's own wrapper.
FORM_TEXT = 0.8

_TAG = re.compile(
    r"<(/?)([a-zA-Z][^\s/>]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+)>|<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|</?[a-zA-Z][^>]*\Z",
    re.S,
)
_ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SELF_CLOSED = re.compile(r"(?:[\"']|(?:^|\s)[^\s=]*)/\s*\Z")
_GENERAL = re.compile(r"[0-9]+")


def named_aside(names: dict[str, str]) -> bool:
    """Whether a class or the id says that an element is not part of the main text."""
    for name in (names.get("class", "") + " " + names.get("id", "")).split():
        said = [w.lower() for w in _WORDS.findall(name)]
        while len(said) > 1 and (said[-1] in PARTS or said[-1] in PLACES):
            said.pop()
        if not said or ABOUT.intersection(said):
            continue
        if said[-1] in ASIDE_WORDS:
            return True
        if said[-1] in ASIDE_ALONE and all(w in PLACES or w in ASIDE_WORDS or w in ASIDE_ALONE for w in said[:-1]):
            return True
    return False


class Node:
    """An open element: where it stands, whether its text counts, and the wrapper that may be aside."""

    __slots__ = ("tag", "path", "aside", "container", "link", "wrapper")

    def __init__(self, tag: str, path: str, aside: bool, container: int, link: bool, wrapper: int):
        self.tag, self.path, self.aside, self.container, self.link = tag, path, aside, container, link
        self.wrapper = wrapper


class Page:
    """Blocks of a page, ``(text, link characters, containers around it from the nearest)``.

    ``paths`` are those of the containers, by number, ``parents`` the container around each.
    """

    def __init__(self, source: str):
        self.paths: list[str] = []
        self.parents: list[int] = []
        self.blocks: list[tuple[str, int, int]] = []
        self._read(source)

    def _read(self, source: str) -> None:
        root = Node("", "", False, -1, False, -1)
        around: list[int] = []  # the wrapper around each wrapper
        forms: list[bool] = []  # whether it is a form
        wrapped: list[int] = []  # that of each block
        texts: list[tuple[str, int]] = []  # article and main, and the wrapper of each
        endless: set[str] = set()
        stack = [root]
        parts: list[str] = []
        linked: list[str] = []
        at, end = 0, len(source)

        def text(piece: str) -> None:
            top = stack[-1]
            if piece and not top.aside:
                parts.append(piece)
                if top.link:
                    linked.append(piece)

        def close_block(node: Node) -> None:
            if parts:
                whole = " ".join(references.unescape("".join(parts)).split())
                if whole:
                    links = len(" ".join(references.unescape("".join(linked)).split()))
                    self.blocks.append((whole, links, node.container))
                    wrapped.append(node.wrapper)
                parts.clear()
                linked.clear()

        while at < end:
            found = _TAG.search(source, at)
            if found is None:
                text(source[at:])
                break
            text(source[at : found.start()])
            at = found.end()
            tag = found[2] or found[5]
            if tag is None:
                continue
            tag = tag.lower()
            if found[1] or found[4]:
                if tag == "br":
                    text(" ")
                depth = next((k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == tag), 0)
                if depth:
                    # an inline end tag does not close blocks opened after it
                    if tag in BLOCK or not any(n.tag in BLOCK for n in stack[depth:]):
                        if any(n.tag in BLOCK for n in stack[depth:]):
                            close_block(stack[-1])
                        del stack[depth:]
                elif tag == "p":
                    close_block(stack[-1])
                continue
            attributes = found[3] if found[2] else found[6]
            if tag in RAW:
                if tag not in PLAIN and _SELF_CLOSED.search(attributes):
                    continue
                stop = None if tag in endless else re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(source, at)
                if stop:
                    at = stop.end()
                elif tag in CODE:
                    at = end
                else:
                    # without an end tag it is empty, or ends at the next tag
                    endless.add(tag)
                    if tag in PLAIN:
                        at = (source.find("<", at) + 1 or end + 1) - 1
                continue
            if tag in VOID:
                if tag == "br":
                    text(" ")
                elif tag in BLOCK:
                    close_block(stack[-1])
                continue
            if tag in BLOCK:
                close_block(stack[-1])
                # inline elements and a paragraph left open end here
                while stack[-1].tag and (stack[-1].tag not in BLOCK or stack[-1].tag == "p"):
                    stack.pop()
            if tag in CLOSES:
                ends, bounds = CLOSES[tag]
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag in bounds:
                        break
                    if stack[k].tag in ends:
                        del stack[k:]
                        break
            top = stack[-1]
            names: dict[str, str] = {}
            if attributes.strip():
                for a in _ATTRIBUTE.finditer(attributes):
                    names.setdefault(a[1].lower(), a[2] or a[3] or a[4] or "")
            label = names.get("class", "").lower().split()
            path = top.path
            container = top.container
            if tag in BLOCK:
                name = tag + ("." + _GENERAL.sub("#", label[0]) if label else "")
                path = f"{path}>{name}"
            role = names.get("role", "").lower()
            aside = top.aside or (tag in ASIDE and tag not in WRAPPERS) or (role in ASIDE_ROLES and role not in WRAPPERS)
            if not aside and tag == "header":
                aside = not any(n.tag in ("article", "main") for n in stack)
            wrapper = top.wrapper
            if not aside and tag in ("article", "main"):
                texts.append((tag, wrapper))
            elif not aside and tag not in ("html", "body"):
                form = tag in WRAPPERS or role in WRAPPERS
                if form or (names and named_aside(names)):
                    around.append(wrapper)
                    forms.append(form)
                    wrapper = len(around) - 1
            if tag in CONTAINER and not aside:
                self.paths.append(path)
                self.parents.append(container)
                container = len(self.paths) - 1
            stack.append(Node(tag, path, aside, container, top.link or tag == "a", wrapper))
        close_block(stack[-1])
        if around:
            self._without_wrappers(around, forms, wrapped, texts)

    def _without_wrappers(
        self, around: list[int], forms: list[bool], wrapped: list[int], texts: list[tuple[str, int]]
    ) -> None:
        """Drop the blocks inside wrappers that are aside.

        A wrapper isn't when it holds ``main``, or an ``article`` where none and no ``main``
        stands outside wrappers. Nor is a form that holds nearly all the text of such a page;
        what a name says is never outweighed by the length of the text.
        """
        held = [0] * len(around)
        total = 0
        for (whole, links, _), wrapper in zip(self.blocks, wrapped, strict=True):
            value = max(0, len(whole) - 2 * links)
            total += value
            while wrapper >= 0:
                held[wrapper] += value
                wrapper = around[wrapper]
        free = any(wrapper < 0 for _, wrapper in texts)
        kept = [form and not free and total > 0 and n >= FORM_TEXT * total for form, n in zip(forms, held, strict=True)]
        for tag, wrapper in texts:
            while wrapper >= 0 and (tag == "main" or not free):
                kept[wrapper] = True
                wrapper = around[wrapper]
        for k, outer in enumerate(around):
            kept[k] = kept[k] and (outer < 0 or kept[outer])
        self.blocks = [b for b, w in zip(self.blocks, wrapped, strict=True) if w < 0 or kept[w]]

    def scores(self) -> dict[str, float]:
        """Score by path: characters outside links, shared by the nearest containers."""
        out: dict[str, float] = {}
        for whole, links, container in self.blocks:
            value = max(0, len(whole) - 2 * links)
            for share in SHARES:
                if container < 0:
                    break
                path = self.paths[container]
                out[path] = out.get(path, 0.0) + share * value
                container = self.parents[container]
        return out

    def own_texts(self) -> dict[str, int]:
        """Hash of the text outside links right in the containers of a path, digits as ``#``."""
        found: dict[str, list[str]] = {}
        for whole, links, container in self.blocks:
            if 2 * links < len(whole):
                found.setdefault(self.path_of(container), []).append(_GENERAL.sub("#", whole))
        return {
            p: int.from_bytes(blake2b("\n".join(t).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)
            for p, t in found.items()
        }

    def path_of(self, container: int) -> str:
        return self.paths[container] if container >= 0 else ""

    def tag_of(self, container: int) -> str:
        return self.path_of(container).rsplit(">", 1)[-1].split(".", 1)[0]

    def inside(self, tops: set[int]) -> list[bool]:
        """Which blocks lie in one of these containers."""
        within = [False] * len(self.paths)
        for k, parent in enumerate(self.parents):
            within[k] = k in tops or (parent >= 0 and within[parent])
        return [c >= 0 and within[c] for _, _, c in self.blocks]

    def text_of(self, path: str, shared: frozenset[str]) -> str:
        """Blocks of the article that the containers of a path belong to.

        It is the nearest ``article`` or ``main`` around them. Text right in what lies
        further out belongs to it too, unless it is links or ``shared``; where there is
        no ``article`` or ``main`` so do containers beside it, up to the first that adds
        only such text.
        """
        tops: set[int] = set()
        for k, own in enumerate(self.paths):
            if own == path:
                at = k
                while at >= 0 and self.tag_of(at) not in WHOLE:
                    at = self.parents[at]
                tops.add(at if at >= 0 else k)
        take = self.inside(tops)
        if not any(take):
            return ""
        # copies share everything, which says nothing of what is around the article
        if all(self.path_of(c) in shared for (_, _, c), t in zip(self.blocks, take, strict=True) if t):
            shared = frozenset()
        own = [2 * links < len(whole) and self.path_of(c) not in shared for whole, links, c in self.blocks]
        seen: set[tuple[int, bool]] = set()
        for top in sorted(tops):
            at, beside = top, self.tag_of(top) not in WHOLE
            while at >= 0:
                at = self.parents[at]
                beside = beside and self.tag_of(at) not in OUTER
                if (at, beside) in seen:
                    break
                seen.add((at, beside))
                here = self.inside({at}) if beside else [c == at for _, _, c in self.blocks]
                more = [h and not t for h, t in zip(here, take, strict=True)]
                take = [t or (m and o) for t, m, o in zip(take, more, own, strict=True)]
                beside = beside and (not any(more) or any(m and o for m, o in zip(more, own, strict=True)))
        return "\n".join(w for (w, _, _), t in zip(self.blocks, take, strict=True) if t)

    def extract(self, paths: list[str], shared: frozenset[str] = frozenset()) -> str:
        """Main text by the first path that the page has text under; else by its own best."""
        known = set(self.paths)
        for path in paths:
            if path in known and (found := self.text_of(path, shared)):
                return found
        scores = self.scores()
        own = max(sorted(scores), key=scores.get, default=None)
        return (own is not None and self.text_of(own, shared)) or "\n".join(w for w, _, _ in self.blocks)


VOTES = "host string, path string, score double, pages bigint, low bigint, high bigint"


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(host, path, score, pages, low, high)``, added up per batch: every page has one vote, shared by score.

    ``low`` and ``high`` are the least and largest hash of the path's own text on a page.
    """
    for batch in batches:
        found: dict[tuple, list] = {}
        for host, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
            page = Page(source or "")
            scores, own = page.scores(), page.own_texts()
            total = sum(scores.values())
            for path in scores.keys() | own.keys():
                score, h = scores.get(path, 0.0), own.get(path)
                if score > 0 or h is not None:
                    mine = found.setdefault((host, path), [0.0, 0, None, None])
                    mine[0] += score / total if score > 0 else 0.0
                    if h is not None:
                        mine[1] += 1
                        mine[2] = h if mine[2] is None else min(mine[2], h)
                        mine[3] = h if mine[3] is None else max(mine[3], h)
        if found:
            score, pages, low, high = zip(*found.values(), strict=True)
            yield pa.RecordBatch.from_pydict(
                {
                    "host": pa.array([h for h, _ in found], type=pa.string()),
                    "path": pa.array([p for _, p in found], type=pa.string()),
                    "score": pa.array(score, type=pa.float64()),
                    "pages": pa.array(pages, type=pa.int64()),
                    "low": pa.array(low, type=pa.int64()),
                    "high": pa.array(high, type=pa.int64()),
                }
            )


def host_paths(pages: DataFrame, most: int = PATHS) -> DataFrame:
    """``(host, paths, shared)``: the paths with most votes on each host, and those of equal text on its pages."""
    votes = pages.select("host", "html").mapInArrow(_votes, VOTES)
    # votes are rounded so that the order in which they are added up can't decide
    per_path = votes.groupBy("host", "path").agg(
        F.round(F.sum("score"), 6).alias("score"),
        F.sum("pages").alias("pages"),
        (F.min("low").eqNullSafe(F.max("high")) & (F.sum("pages") > 1)).alias("same"),
    )
    place = F.row_number().over(Window.partitionBy("host").orderBy(F.desc("score"), "path"))
    rank = F.row_number().over(Window.partitionBy("host").orderBy(F.desc("same"), F.desc("pages"), "path"))
    wins = (F.col("place") <= most) & (F.col("score") > 0)
    same = F.col("same") & (F.col("rank") <= SHARED)
    best = per_path.withColumn("place", place).withColumn("rank", rank).filter(wins | same)
    ordered = F.array_sort(F.collect_list(F.when(wins, F.struct("place", "path"))))
    return best.groupBy("host").agg(
        F.transform(ordered, lambda p: p["path"]).alias("paths"),
        F.array_sort(F.collect_list(F.when(same, F.col("path")))).alias("shared"),
    )


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("html", "paths", "shared")]
        texts = [
            Page(source or "").extract(paths or [], frozenset(shared or []))
            for source, paths, shared in zip(*columns, strict=True)
        ]
        yield pa.RecordBatch.from_pydict(
            {
                "page_id": batch.column("page_id"),
                "url": batch.column("url"),
                "text": pa.array(texts, type=pa.string()),
                "n_chars": pa.array(np.array([len(t) for t in texts], dtype=np.int64)),
            }
        )


def main_text(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)`` for every row of ``pages(page_id, url, html)``.

    Null or empty html gives an empty text. Pages with a null url, or one without
    a host, share the host ``''``. Repeated rows vote as often as they stand and
    get equal texts. An empty table gives no rows.
    """
    host = F.regexp_extract(F.lower(F.coalesce("url", F.lit(""))), r"^[a-z][a-z0-9+.\-]*://([^/?#]*)", 1)
    rows = pages.select(
        F.col("page_id").cast("bigint"), F.col("url").cast("string"), F.col("html").cast("string"), host.alias("host")
    )
    winners = written(host_paths(rows), "host-paths")
    known = join_by(rows, winners, ["host"], spread="page_id")
    return known.select("page_id", "url", "html", "paths", "shared").mapInArrow(
        _extract, "page_id bigint, url string, text string, n_chars bigint"
    )
