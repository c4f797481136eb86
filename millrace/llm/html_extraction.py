"""Main text of web pages by tag-path ratios.

A page is read as a sequence of text blocks, each with the path of block tags from the root to it. For
every path the characters and punctuation marks of its blocks are divided by the number of its blocks;
the ratios are smoothed over the paths with the same parent and fused. Paths that reach a share of the
page's best are strong, and the lowest path that holds nearly all text of strong paths is the content region; every block
in it is kept, however short. What a page marks as an article or a main part counts more, so that text beside it must be
both strong and much to be content too; but an article that only teases doesn't hide the text. Subtrees that say what
they are (menus, adverts, forms, comments and the like, by tag or by the words of class, id and role) don't count. But a
main part always does, and one that is a form or noise by its words alone is only a wrapper where it holds blocks and more
than half of the text (of comments: nine tenths) or there is no other: then its children are judged.

Null and empty html give an empty text. Unclosed tags end where their block does, and embedded objects that nothing closes
with their tag. Pages are independent, so ties and repeated rows are passed through, other columns are ignored, and no pages
give no rows. The time for a page is linear in its length, whatever is nested, left open or closed without having been opened.
"""

from __future__ import annotations

import html as markup
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from millrace.llm.common import slices, table

SHARE = 0.2  # of the best path's score that a path must reach to say where the content is
HELD = 0.85  # share of the strong paths' text that the content region holds
MARKED = 3  # how much more text counts that is marked as an article or a main part

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+'){0,400}+)>"""
                 r"""|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[!?/][^>]*+(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*+)"|'([^']*+)'|([^\s>"']++))""", re.I)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
RAW = frozenset("script style template textarea title iframe object svg math noscript noframes xmp".split())
EMBEDDED = frozenset("iframe object svg math noscript".split())  # of RAW, those that end with their tag if nothing closes them
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("""html head body p div section article main header footer nav aside h1 h2 h3 h4 h5 h6 ul ol li dl dt
    dd table thead tbody tfoot tr td th caption blockquote pre figure figcaption form fieldset address details
    summary hr center option select""".split())
NOISE_TAGS = frozenset("head nav footer aside button select dialog menu fieldset canvas audio video".split())
NOISE_WORDS = frozenset("""ad ads advert adverts advertisement advertising adsense adslot banner sponsor sponsored promo promotion
    cookie cookies consent gdpr notice alert sidebar comment comments reply replies respond disqus menu nav
    navbar navigation breadcrumb breadcrumbs footer share sharing social related recommended newsletter subscribe
    subscription signup login search popup modal overlay widget pagination pager toolbar""".split())
COMMENT_WORDS = frozenset("comment comments reply replies respond disqus".split())
WRAPPER, COMMENTS_WRAPPER = 0.5, 0.9  # share of the page's text above which noise by words is only a wrapper
NEVER_NOISE = frozenset(("html", "body", "article", "main"))
# What a new block ends: (the tags, the tags beyond which they stay open). A block that is not named ends a paragraph.
CLOSES = [(("p",), ("td", "th", "li", "button")), (("li",), ("ul", "ol")), (("dt", "dd"), ("dl",)), (("tr",), ("table",)),
          (("td", "th"), ("tr", "table")), (("option",), ("select",))]
KIND = {tag: k for k, (tags, _) in enumerate(CLOSES) for tag in tags}
STOPS = {tag: [k for k, (_, stops) in enumerate(CLOSES) if tag in stops] for _, stops in CLOSES for tag in stops}
INSIDE = frozenset("""p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption blockquote pre figure figcaption
    details summary""".split())  # blocks that are a part of some content and no region of their own
PUNCTUATION = re.compile(r"[.,;:!?…。，、！？؟।]")


def _noise_share(tag: str, attributes: str, in_article: bool) -> float | None:
    """None if no noise, 2 if noise by its tag, else the share of the page's text above which it is only a wrapper."""
    if tag in NOISE_TAGS or tag == "header" and not in_article:
        return 2
    if tag in NEVER_NOISE:
        return None
    words = {w.lower() for found in ATTRIBUTE.findall(attributes) for w in WORD.findall(" ".join(found[1:]))} if attributes else set()
    if words & COMMENT_WORDS:
        return COMMENTS_WRAPPER
    return WRAPPER if tag == "form" or words & NOISE_WORDS or not in_article and "header" in words else None


def _counted(wrappers: list[tuple[int, float]], owners: list[int], sizes: list[int], plain: list[bool]) -> set[int]:
    """The subtrees of noise by words that are only wrappers, and 0. ``plain`` ones hold no block and are none."""
    own = [0] * len(wrappers)
    for owner, size in zip(owners, sizes):
        own[owner] += size
    held, inner = own.copy(), [[] for _ in wrappers]
    for k in range(len(wrappers) - 1, 0, -1):  # one's number is larger than that of the one around it
        held[wrappers[k][0]] += held[k]
        inner[wrappers[k][0]].append(k)
    counted, seen, next_ = {0}, own[0], inner[0]
    while next_:
        found = [k for k in next_ if held[k] > wrappers[k][1] * held[0] and not plain[k]]
        if not found and not seen:  # nothing else is there
            found = [k for k in next_ if wrappers[k][1] == WRAPPER and held[k]] or next_
        counted.update(found)
        seen += sum(own[k] for k in found)
        next_ = [j for k in found for j in inner[k]]
    return counted


def blocks_of(html: str) -> tuple[list[tuple[int, int, bool, str]], dict[int, tuple[int, str]]]:
    """(path, parent path, inside an article or main part, text) of each block outside known noise; parent and tag of each path."""
    paths: dict[tuple[int, str], int] = {}
    # tag, path, noise by tag, in article, wrapper, and for each entry of CLOSES where on the stack its element is open, or 0
    stack: list[tuple[str, int, bool, bool, int, tuple[int, ...]]] = [("", 0, False, False, 0, (0,) * len(CLOSES))]
    open_at: dict[str, list[int]] = {}  # where on the stack each tag is open
    open_blocks = [0]
    blocks: list[tuple[int, int, bool, str]] = []
    owners: list[int] = []  # of each block, the innermost subtree that is noise by its words; 0 is none
    wrappers: list[tuple[int, float]] = [(0, 0)]  # the one around it, and the share above which it is a wrapper
    plain = [False]  # whether it holds no block
    unclosed: set[str] = set()  # embedded tags that nothing further on closes
    parents = {0: 0}
    text: dict[int, list[str]] = {}  # by wrapper, so that noise inside a line is a block of its own

    def flush():
        for owner, parts in text.items():
            words = " ".join(markup.unescape("".join(parts)).split())
            if words:
                _, path, _, in_article, _, _ = stack[open_blocks[-1]]
                blocks.append((path, parents[path], in_article, words))
                owners.append(owner)
        text.clear()

    def pop(keep: int):
        if open_blocks[-1] >= keep:
            flush()
            while open_blocks[-1] >= keep:
                open_blocks.pop()
        while len(stack) > keep:
            open_at[stack.pop()[0]].pop()

    at, end = 0, html.rfind(">") + 1  # no tag ends after that
    while at < end:
        found = TAG.search(html, at, end)
        if not stack[-1][2]:
            text.setdefault(stack[-1][4], []).append(html[at:found.start() if found else end])
        at = found.end() if found else end
        if not found:
            break
        closing, tag, attributes = (found[1], found[2], found[3]) if found[2] else (found[4], found[5], found[6])
        if not tag:
            if found.group().startswith("<!--") and not found.group().endswith("-->"):
                at = len(html)  # a comment that nothing ends
            continue
        tag = tag.lower()
        if closing:
            where = open_at.get(tag)
            if where and (tag in BLOCKS or where[-1] > open_blocks[-1]):
                pop(where[-1])
            continue
        if tag in RAW and not (tag in ("svg", "math") and attributes.endswith("/")):
            close = None if tag in unclosed else re.compile(f"</{re.escape(tag)}[^>]*(?:>|\\Z)", re.I).search(html, at)
            if close is None:
                unclosed.add(tag)
            at = close.end() if close else at if tag in EMBEDDED else len(html)
            text.setdefault(stack[-1][4], []).append(" ")
            continue
        if tag == "br":
            text.setdefault(stack[-1][4], []).append(" ")
            continue
        if tag in VOID and tag != "hr":
            continue
        if tag in BLOCKS:
            flush()
            ends = stack[-1][5][KIND.get(tag, 0)] or stack[-1][5][0]
            if ends:
                pop(ends)
        if tag == "hr" or attributes.endswith("/") and tag not in BLOCKS:
            continue
        _, path, noise, in_article, owner, scope = stack[-1]
        if tag in BLOCKS:
            path = paths.setdefault((path, tag), len(paths) + 1)
            parents[path] = stack[-1][1]
            plain[owner] = False
        share = None if noise else _noise_share(tag, attributes, in_article)
        if tag == "main":
            noise, owner = False, 0
        elif share == 2:
            noise = True
        elif share is not None:
            wrappers.append((owner, share))
            plain.append(True)
            owner = len(wrappers) - 1
        place = len(stack)
        if tag in KIND or tag in STOPS:
            scope = tuple(place if KIND.get(tag) == k else 0 if k in STOPS.get(tag, ()) else s for k, s in enumerate(scope))
        stack.append((tag, path, noise, in_article or tag in ("article", "main"), owner, scope))
        open_at.setdefault(tag, []).append(place)
        if tag in BLOCKS:
            open_blocks.append(place)
    if at < len(html) and not stack[-1][2]:  # text after the last tag; what begins there and doesn't end is none
        text.setdefault(stack[-1][4], []).append(re.sub(r"<[!?/a-zA-Z].*", "", html[at:], flags=re.S))
    flush()
    if len(wrappers) > 1:
        counted = _counted(wrappers, owners, [len(b[3]) * (MARKED if b[2] else 1) for b in blocks], plain)
        blocks = [b for b, owner in zip(blocks, owners) if owner in counted]
    return blocks, {path: at for at, path in paths.items()}


def path_scores(blocks: list[tuple[int, int, bool, str]]) -> dict[int, float]:
    """Characters and punctuation marks per block of each path, smoothed with those of all paths of the same parent, and fused."""
    totals: dict[int, list[float]] = {}
    siblings: dict[int, list[float]] = {}
    facts: dict[int, tuple[int, bool]] = {}
    for path, parent, marked, text in blocks:
        facts[path] = (parent, marked)
        marks = len(PUNCTUATION.findall(text))
        for sums in (totals.setdefault(path, [0, 0, 0]), siblings.setdefault(parent, [0, 0, 0])):
            sums[0] += 1
            sums[1] += len(text)
            sums[2] += marks
    scores = {}
    for path, (n, chars, marks) in totals.items():
        parent, marked = facts[path]
        all_n, all_chars, all_marks = siblings[parent]
        length, punctuation = (chars / n + all_chars / all_n) / 2, (marks / n + all_marks / all_n) / 2
        scores[path] = length * (1 + punctuation) ** 0.5 * (MARKED if marked else 1)
    return scores


def content_region(blocks: list[tuple[int, int, bool, str]], above: dict[int, tuple[int, str]]) -> int:
    """The lowest path, no list, table or other part of some content, that holds HELD of the strong paths' text; 0 is the root."""
    scores = path_scores(blocks)
    least = SHARE * max(scores.values())
    held = [0] * (max(above, default=0) + 1)
    for path, _, marked, text in blocks:
        if scores[path] >= least:
            held[path] += len(text) * (MARKED if marked else 1)
    total = sum(held)
    for path in range(len(held) - 1, 0, -1):  # a path's number is larger than its parent's
        held[above[path][0]] += held[path]
    return max((p for p in above if above[p][1] not in INSIDE and held[p] >= HELD * total), default=0)


def main_text(html: str) -> str:
    blocks, above = blocks_of(html)
    if not blocks:
        return ""
    inside = {content_region(blocks, above)}
    for path in sorted(above):
        if above[path][0] in inside:
            inside.add(path)
    return "\n".join(text for path, _, _, text in blocks if path in inside)


def extracted(pages: DataFrame, html: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, length in slices(batch.column(2)):
                part = batch.slice(start, length)
                texts = [main_text(h or "") for h in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()),
                                                  pa.array([len(t) for t in texts], pa.int64())],
                                                 names=["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", html).mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages"))
