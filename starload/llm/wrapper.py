"""Main text of pages by wrapper induction (operator 9).

1. Each page's DOM tree is cut down to its block elements, and like siblings become
   one repeated node, so a page's skeleton is small however long the page.
2. Pages of a host with equal skeletons are one; the most frequent skeleton of a
   host is its reference, and every other skeleton is aligned to it by simple tree
   matching. Aligned nodes share a slot; nodes without a partner get slots of their
   own below their parent's.
3. For each slot of a host it is counted on how many pages it stands, whether its text
   is always the same, and whether the rest of these pages is not (least and greatest
   hashes of both). A slot with one text over at least ``CONSTANT_PAGES`` pages that
   differ otherwise is template, a varying one is content. As a slot is compared with
   the pages that have it, each of several layouts of a host has its own template.
4. On pages without a marked main element (article, main) single blocks are judged as
   well, because like siblings share a slot: a block is template if it stands on
   ``CONSTANT_PAGES`` pages or more that differ otherwise and on half of those that have
   its slot; and a slot is (rotating adverts, notices) if half of what stands in it
   recurs so on pages of any host whose longest other blocks differ too, and it holds
   less than half of the host's text. Copies of one page are no template: nothing
   else differs on them.
5. Each page is aligned to its host's reference again; the blocks of its content
   slots, in page order, are its text. On a page with marked main elements
   only slots within them count.

Menus, headers, footers and forms by element name are never main text. Marks (class, id,
role) that name such things rule an element out only if it holds no more than half of the
page's text, comments always; marks like 'has-sidebar' and those around a main element
say nothing; within a main element a mark that may be a topic ('related-work') counts only
with links or a constant text. Constants within main elements count only where the
other text of main elements differs, and a main element's h1 is never one.

The wrapper is one row for each host, aggregated from counts before any shuffle;
pages meet it by a join that Spark may split or broadcast by its size.

Cases: a null or empty html gives an empty text; a null or odd url belongs to the
host ''; a host with one page has no constants and keeps all slots not ruled out;
repeated rows and equal page_ids give a row each; a page of any length and depth is taken
whole; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import workers_import, written
from .dom import INLINE, Node, parse

#: Pages on which a slot must be the same to count as template.
CONSTANT_PAGES = 3
HOST = r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)"
#: Elements, and words in class, id or role, that are never main text.
CHROME_TAGS = frozenset("head nav header footer aside form button select option input textarea label menu dialog svg canvas object audio video title".split())
CHROME_WORDS = frozenset(
    """ad ads advert adverts advertisement advertising adbox banner banners sponsor sponsored promo promotion
    nav navbar navigation menu menubar breadcrumb breadcrumbs header masthead footer sidebar side aside widget widgets
    notice notices cookie cookies consent gdpr popup modal overlay newsletter subscribe subscription signup login search
    share sharing social related recommended comment comments commentlist disqus respond reply replies discussion
    pagination pager toc skip form contentinfo complementary alert""".split()
)
#: Of these, the words that rule out a part of a main element whatever it holds; a
#: section of an article may bear any other one as its topic.
SURE_WORDS = frozenset("ad ads advert adverts adbox sponsored nav navbar breadcrumb breadcrumbs sidebar share sharing comment comments commentlist disqus respond reply replies pagination pager".split())
#: Marks with these words rule out an element of any size.
COMMENT_WORDS = frozenset("comment comments commentlist disqus respond reply replies".split())
#: In a mark, words behind these tell what stands beside or is missing.
BESIDE_WORDS = frozenset("with without has have no not hide".split())
MAIN_TAGS = frozenset(("article", "main"))
_WORD = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")


@lru_cache(maxsize=4096)
def _label(tag: str, marks: str) -> str:
    marks = re.sub(r"[/.+]", "-", re.sub(r"\d+", "", marks)).strip()
    tag = re.sub(r"[/.+]", "-", tag)
    return f"{tag} {marks}" if marks else tag


def label(node: Node) -> str:
    """What must agree for two nodes to match: tag and marks without numbers."""
    return _label(node.tag, node.marks)


def _marked(marks: str) -> Iterator[str]:
    """The chrome words that marks name as what the element is."""
    for m in marks.split():
        own = re.search("article|post|entry|content", m) is not None
        for w in _WORD.findall(m):
            if w in BESIDE_WORDS:
                break
            if w in CHROME_WORDS and not (own and w in ("header", "masthead", "side")):
                yield w


@contextmanager
def deep_trees():
    """Trees are walked by recursion: as deep as pages are nested."""
    before = sys.getrecursionlimit()
    sys.setrecursionlimit(max(before, 5_000_000))
    try:
        yield
    finally:
        sys.setrecursionlimit(before)


@lru_cache(maxsize=4096)
def chrome(lab: str, inside_main: bool = False, around_main: bool = False) -> str:
    """'out' if a label is no main text by its tag, 'mark' if by its marks, 'doubt' if its
    marks may also be a topic, else ''. A header within an article belongs to it; marks
    say nothing of an element around a main one."""
    tag, _, marks = lab.partition(" ")
    if tag in CHROME_TAGS and not (inside_main and tag == "header"):
        return "out"
    if tag in ("html", "body", "article", "main") or around_main:
        return ""
    found = set(_marked(marks))
    if not inside_main:
        return "out" if found & COMMENT_WORDS else "mark" if found else ""
    found -= {"header", "masthead", "side"}
    return "out" if found & SURE_WORDS else "doubt" if found else ""


# A skeleton is (label, [children]); like siblings are one repeated node.
Skeleton = tuple


def blocks(node: Node) -> list[Node]:
    """Block elements directly below, seen through inline ones."""
    out: list[Node] = []
    for x in node.inside:
        if isinstance(x, Node):
            if x.tag in INLINE:
                out += blocks(x)
            else:
                out.append(x)
    return out


def straight(root: Node) -> Node:
    """Nested elements of one label with nothing else between them become one."""
    stack = [root]
    while stack:
        node = stack.pop()
        while True:
            own = [x for x in node.inside if not isinstance(x, str) or x.strip()]
            if len(own) != 1 or not isinstance(own[0], Node) or own[0].tag in INLINE or label(own[0]) != label(node):
                break
            node.inside = own[0].inside
        stack += [x for x in node.inside if isinstance(x, Node)]
    return root


def skeleton(node: Node) -> Skeleton:
    return (label(node), _shapes_below([node]))


def _shapes_below(nodes: list[Node]) -> list[Skeleton]:
    """Children of like nodes, those with one label together, in order of their first."""
    like: dict[str, list[Node]] = {}
    for n in nodes:
        for x in blocks(n):
            like.setdefault(label(x), []).append(x)
    return [(lab, _shapes_below(of)) for lab, of in like.items()]


def tree_match(a: Skeleton, b: Skeleton, known: dict | None = None) -> int:
    """Simple tree matching: the most nodes that can be paired in order, roots first."""
    if a[0] != b[0]:
        return 0
    known = {} if known is None else known
    key = (id(a), id(b))
    if key not in known:
        known[key] = 1 + matching(a[1], b[1], known)[0]
    return known[key]


def matching(a: list[Skeleton], b: list[Skeleton], known: dict | None = None) -> tuple[int, list[tuple[int, int]]]:
    """Best ordered pairing of two lists of trees: its size and its pairs. Only trees whose
    label stands in both lists can be paired; ``known`` remembers sizes of pairs."""
    known = {} if known is None else known
    both = {x[0] for x in a} & {x[0] for x in b}
    rows, columns = [i for i, x in enumerate(a) if x[0] in both], [j for j, x in enumerate(b) if x[0] in both]
    if not both:
        return 0, []
    w = [[tree_match(a[i], b[j], known) for j in columns] for i in rows]
    best = [[0] * (len(columns) + 1) for _ in range(len(rows) + 1)]
    for i in range(1, len(rows) + 1):
        for j in range(1, len(columns) + 1):
            best[i][j] = max(best[i - 1][j], best[i][j - 1], best[i - 1][j - 1] + w[i - 1][j - 1])
    pairs, i, j = [], len(rows), len(columns)
    while i and j:
        if w[i - 1][j - 1] and best[i][j] == best[i - 1][j - 1] + w[i - 1][j - 1]:
            pairs.append((rows[i - 1], columns[j - 1]))
            i, j = i - 1, j - 1
        elif best[i][j] == best[i - 1][j]:
            i -= 1
        else:
            j -= 1
    return best[-1][-1], pairs[::-1]


def _steps(children: list[Skeleton], at: str) -> list[str]:
    turn: dict[str, int] = {}
    out = []
    for c in children:
        turn[c[0]] = turn.get(c[0], -1) + 1
        out.append(f"{at}/{c[0]}.{turn[c[0]]}")
    return out


def aligned(tree: Skeleton, reference: Skeleton) -> dict[str, str]:
    """Slot of each path of ``tree``: the path of its partner in the reference, or
    for a node without one its own path below its parent's slot, marked with +."""
    out: dict[str, str] = {}
    known: dict = {}

    def alone(t: Skeleton, path: str, slot: str) -> None:
        out[path] = slot
        for c, p, s in zip(t[1], _steps(t[1], path), _steps(t[1], slot), strict=True):
            alone(c, p, s)

    def both(t: Skeleton, path: str, r: Skeleton, slot: str) -> None:
        out[path] = slot
        pairs = dict(matching(t[1], r[1], known)[1])
        own, theirs = _steps(t[1], path), _steps(r[1], slot)
        for i, c in enumerate(t[1]):
            if i in pairs:
                both(c, own[i], r[1][pairs[i]], theirs[pairs[i]])
            else:
                alone(c, own[i], f"{slot}/+{own[i].rpartition('/')[2]}")

    if tree[0] == reference[0]:
        both(tree, "", reference, "")
    else:
        alone(tree, "", "+")
    return out


def _pack(tree: Skeleton) -> str:
    """One line for each node in page order: depth and label (which has no line breaks)."""
    out, stack = [], [(0, tree)]
    while stack:
        depth, (lab, below) = stack.pop()
        out.append(f"{depth} {lab}")
        stack += [(depth + 1, c) for c in reversed(below)]
    return "\n".join(out)


@lru_cache(maxsize=256)
def _tree(packed: str) -> Skeleton:
    open_: list[Skeleton] = []
    for line in packed.split("\n"):
        depth, _, lab = line.partition(" ")
        del open_[int(depth) :]
        node = (lab, [])
        if open_:
            open_[-1][1].append(node)
        open_.append(node)
    return open_[0]


def texts_of(root: Node, tree: Skeleton) -> list[tuple[str, str, int]]:
    """(path in the skeleton, text, characters in links) of each block of text, in page order."""
    out: list[tuple[str, str, int]] = []

    def visit(node: Node, path: str, shape: Skeleton) -> None:
        steps = dict(zip((c[0] for c in shape[1]), zip(_steps(shape[1], path), shape[1], strict=True), strict=True))
        text: list[str] = []
        linked = 0

        def flush() -> None:
            nonlocal linked
            if text:
                line = _SPACE.sub(" ", "".join(text)).strip()
                if line:
                    out.append((path, line, linked))
                text.clear()
            linked = 0

        def walk(x: Node, link: bool) -> None:
            nonlocal linked
            for y in x.inside:
                if isinstance(y, str):
                    text.append(y)
                    if link:
                        linked += len(y)
                elif y.tag == "br":
                    text.append(" ")
                elif y.tag in INLINE:
                    walk(y, link or y.tag == "a")
                else:
                    flush()
                    visit(y, *steps[label(y)])

        walk(node, False)
        flush()

    visit(root, "", tree)
    return out


def _hash(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)


def _rest(hashes: dict[str, int], counted: set[str], path: str) -> int:
    """A hash of the texts of the other counted paths."""
    total = sum(hashes[p] for p in counted if p != path)
    return (total + (1 << 63)) % (1 << 64) - (1 << 63)


@lru_cache(maxsize=65536)
def standing(path: str) -> tuple[bool, str, bool, bool]:
    """Of a path: whether it lies in a main element; the path of the outermost element
    whose marks rule it out, if any; whether an element's name (or comments) does; and
    whether marks do so if its slot is constant or holds links."""
    main = doubt = False
    marked = ""
    steps = path.split("/")[1:]
    labels = [step.removeprefix("+").rpartition(".")[0] for step in steps]
    last = max((i for i, lab in enumerate(labels) if lab.partition(" ")[0] == "main"), default=-1)
    for i, lab in enumerate(labels):
        kind = chrome(lab, main, i < last)
        if kind == "out":
            return main, marked, True, doubt
        if kind == "mark" and not marked:
            marked = "/" + "/".join(steps[: i + 1])
        doubt = doubt or kind == "doubt"
        main = main or lab.partition(" ")[0] in MAIN_TAGS
    return main, marked, False, doubt


def readable(found: list[tuple[str, str, int]]) -> list[tuple[str, str, int]]:
    """The blocks that neither an element's name nor marks rule out. What is marked counts
    as ruled out unless it holds more than half of the text outside named elements."""
    open_ = [x for x in found if not standing(x[0])[2]]
    total = sum(len(t) for _, t, _ in open_)
    held: dict[str, int] = {}
    for path, text, _ in open_:
        steps = path.split("/")
        for i in range(2, len(steps) + 1):
            at = "/".join(steps[:i])
            held[at] = held.get(at, 0) + len(text)

    def out(path: str) -> bool:
        at = standing(path)[1]
        if not at or 2 * held[at] <= total:
            return bool(at)
        # The outermost marked element is the page's body: look at those within it.
        inner = path.split("/")
        for i in range(at.count("/") + 2, len(inner) + 1):
            step = "/".join(inner[:i])
            if chrome(inner[i - 1].rpartition(".")[0]) == "mark" and 2 * held[step] <= total:
                return True
        return False

    return [x for x in open_ if not out(x[0])]


def _block_contexts(lengths: dict[int, int]) -> Iterator[tuple[int, int, int]]:
    """(block, longest other block, hash of all others) of a page's block hashes and lengths."""
    longest = sorted(lengths, key=lambda h: (-lengths[h], h))[:2]
    total = sum(lengths)
    for h in lengths:
        yield h, next((x for x in longest if x != h), 0), (total - h + (1 << 63)) % (1 << 64) - (1 << 63)


def _shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each host, skeleton and path with text: pages, least and greatest hash of the text,
    characters, characters in links, least and greatest hash of the rest. On pages
    without a main element also one row for each block of a path, with the least and
    greatest hashes of the longest other block and of all others."""
    with deep_trees():
        for b in batches:
            seen: dict[tuple, list] = {}

            def count(key: tuple, a: int, c: int, chars: int = 0, links: int = 0, seen=seen) -> None:
                s = seen.setdefault(key, [0, a, a, 0, 0, c, c])
                s[:] = s[0] + 1, min(s[1], a), max(s[2], a), s[3] + chars, s[4] + links, min(s[5], c), max(s[6], c)

            for host, page in zip(b["host"].to_pylist(), b["html"].to_pylist(), strict=True):
                root = straight(parse(page or ""))
                tree = skeleton(root)
                packed = _pack(tree)
                found = readable(texts_of(root, tree))
                held: dict[str, list] = {"": [[], 0]}
                for path, text, links in found:
                    have = held.setdefault(path, [[], 0])
                    have[0].append(text)
                    have[1] += links
                hashes = {p: _hash("\n".join(t)) for p, (t, _) in held.items()}
                main = {p: standing(p)[0] for p in held}
                counted = {m: {p for p in held if main[p] == m and not _title(p) and held[p][0]} for m in (False, True)}
                for p, (text, links) in held.items():
                    count((host, packed, p, None), hashes[p], _rest(hashes, counted[main[p]], p), sum(map(len, text)), links)
                if not any(main.values()):
                    places = {(p, _hash(t)): len(t) for p, t, _ in found}
                    contexts = {h: (x, y) for h, x, y in _block_contexts({h: n for (_, h), n in places.items()})}
                    for p, h in places:
                        count((host, packed, p, h), *contexts[h])
            if seen:
                rows = [(*k, *v) for k, v in seen.items()]
                kinds = [pa.string()] * 3 + [pa.int64()] * 8
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["host", "skeleton", "path", "block", *_COUNTED])


def _title(path: str) -> bool:
    """Whether a path is the h1 of a main element."""
    return standing(path)[0] and path.rpartition("/")[2].startswith("h1")


@lru_cache(maxsize=256)
def _slots(packed: str, reference: str) -> dict[str, str]:
    return aligned(_tree(packed), _tree(reference))


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    with deep_trees():
        for b in batches:
            out = []
            for page, reference, template, fixed in zip(*[b[c].to_pylist() for c in ("html", "reference", "template", "blocks")], strict=True):
                root = straight(parse(page or ""))
                tree = skeleton(root)
                found = [(p, t) for p, t, _ in readable(texts_of(root, tree))]
                main = any(standing(p)[0] for p, _ in found)
                if template or fixed:
                    slots, whole = _slots(_pack(tree), reference), set(template or ())
                    single = set() if main else {(x["slot"], x["block"]) for x in fixed or ()}
                    found = [(p, t) for p, t in found if slots[p] not in whole and not (single and (slots[p], _hash(t)) in single)]
                inside = [t for p, t in found if standing(p)[0]]
                out.append(" ".join(inside or [t for _, t in found]))
            n = [len(t) for t in out]
            yield pa.RecordBatch.from_arrays([b["page_id"], b["url"], pa.array(out, pa.string()), pa.array(n, pa.int64())], names=["page_id", "url", "text", "n_chars"])


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each path's slot, whether it is in a main element, and whether it may be template."""
    with deep_trees():
        for b in batches:
            own = b["path"].to_pylist()
            slots = [_slots(s, r)[p] for s, r, p in zip(b["skeleton"].to_pylist(), b["reference"].to_pylist(), own, strict=True)]
            kept = ["host", "block", *_COUNTED]
            new = {"slot": pa.array(slots, pa.string()), "main": pa.array([standing(p)[0] for p in own]), "title": pa.array([_title(p) for p in own]), "doubt": pa.array([standing(p)[3] for p in own])}
            yield pa.RecordBatch.from_arrays([b[c] for c in kept] + list(new.values()), names=[*kept, *new])


_COUNTED = ("pages", "least", "most", "chars", "links", "rest_least", "rest_most")
_COUNTS = ", ".join(f"{c} long" for c in _COUNTED)


def _counted(df: DataFrame, *keys: str) -> DataFrame:
    how = dict.fromkeys(_COUNTED, F.sum) | {"least": F.min, "rest_least": F.min, "most": F.max, "rest_most": F.max}
    return df.groupBy(*keys).agg(*[f(c).alias(c) for c, f in how.items()])


def wrappers(hosted: DataFrame) -> DataFrame:
    """``host, reference, template, blocks``: the host's reference skeleton, the slots that
    hold template, and single blocks (slot and hash) that are."""
    shape = hosted.mapInArrow(_shapes, f"host string, skeleton string, path string, block long, {_COUNTS}")
    shape = written(_counted(shape, "host", "skeleton", "path", "block"), "page-shapes")
    reference = shape.where("path = '' and block is null").groupBy("host").agg(F.max_by("skeleton", F.struct("pages", "skeleton")).alias("reference"))
    slots = shape.join(reference, "host").mapInArrow(_aligned, f"host string, block long, {_COUNTS}, slot string, main boolean, title boolean, doubt boolean")
    slots = written(slots.where("slot <> ''"), "page-slots")
    judged = _counted(slots.where("block is null"), "host", "slot", "main", "title", "doubt")
    often, differ = F.col("pages") >= CONSTANT_PAGES, F.col("rest_least") != F.col("rest_most")
    constant = often & (F.col("least") == F.col("most")) & differ & ~F.col("title")
    only_links = (~F.col("main") | F.col("doubt")) & (F.col("links") > 0) & (10 * F.col("links") >= 9 * F.col("chars"))
    blocks_ = _counted(slots.where("block is not null"), "host", "slot", "block")
    recur = often & differ
    strict = recur & (F.col("least") != F.col("most"))
    of_slot = judged.groupBy("host", "slot").agg(F.sum("pages").alias("slot_pages"), F.sum("chars").alias("slot_chars"))
    of_host = of_slot.groupBy("host").agg(F.sum("slot_chars").alias("host_chars"))
    single = blocks_.where(recur).join(of_slot, ["host", "slot"]).where(2 * F.col("pages") >= F.col("slot_pages"))
    anywhere = _counted(blocks_, "block").where(strict).select("block", F.lit(True).alias("again"))
    pooled = blocks_.join(anywhere, "block", "left").groupBy("host", "slot").agg(F.sum("pages").alias("n"), F.sum(F.when(F.col("again"), F.col("pages")).otherwise(0)).alias("n_again"))
    pooled = pooled.where(2 * F.col("n_again") >= F.col("n")).join(of_slot, ["host", "slot"]).join(of_host, "host")
    pooled = pooled.where((F.col("slot_pages") >= CONSTANT_PAGES) & (2 * F.col("slot_chars") < F.col("host_chars")))
    fixed = judged.where(constant | only_links).select("host", "slot").unionByName(pooled.select("host", "slot"))
    fixed = fixed.groupBy("host").agg(F.sort_array(F.collect_set("slot")).alias("template"))
    single = single.groupBy("host").agg(F.sort_array(F.collect_set(F.struct("slot", "block"))).alias("blocks"))
    return written(reference.join(fixed, "host", "left").join(single, "host", "left"), "wrappers")


def main_texts(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for each row."""
    workers_import(pages.sparkSession)
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    given = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"))
    hosted = given.withColumn("host", F.coalesce(F.lower(F.regexp_extract("url", HOST, 1)), F.lit("")))
    return hosted.join(wrappers(hosted.select("host", "html")), "host", "left").mapInArrow(_extracted, "page_id long, url string, text string, n_chars long")
