"""Main text of web pages by composite text density.

Every node of the page's tree has a density: characters per tag, lowered for text in links. The node
whose children's densities sum up highest holds the article, with all of the article or main element
around it. The threshold is the least density on the path from it up to the body: of every node below
the body that reaches it, the node with the highest sum below it belongs to the article as well.

Formatting tags (b, span, a ...) are no nodes of their own, so a paragraph is a leaf. Menus, footers,
side bars, scripts and styles are cut off first, by tag. Forms, headers and elements with a telling
class, id or role are cut off unless they are wrappers: they hold all article and main elements that they
are not in themselves, or in a page without one most of the text outside links. Sections of comments, notices,
adverts and hidden elements go whatever they hold otherwise; other named elements and headers of an
article go only if most of their text is in links.

A page is read in one forward pass, and each step of it looks at the innermost open element of a kind
by its place, so the time is in proportion to the page's length whatever it holds.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackflow.llm import text as tx

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section summary"
    " table tbody td tfoot th thead tr ul caption".split()
)
# A start tag on the left ends open elements on the right, up to the element that bounds them.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dd": ({"dd", "dt"}, {"dl"}),
    "dt": ({"dd", "dt"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}
CUT_TAGS = frozenset(
    "head script style noscript template nav footer aside button select textarea iframe object svg"
    " canvas dialog menu search title xmp noembed noframes".split()
)
ADVERT_NAMES = frozenset("ad ads advert adverts advertisement advertising banner sponsor sponsored promo".split())
CUT_NAMES = frozenset(
    "sidebar menu nav navbar navigation breadcrumb breadcrumbs footer header masthead cookie cookies consent notice"
    " notices popup modal overlay comment comments disqus replies share sharing social related recommended"
    " newsletter subscribe signup login pagination pager toolbar widget".split()
)
# Of these any part of a name tells, as in comment-list or cookie_banner.
APART_NAMES = frozenset("comment comments disqus cookie cookies gdpr".split())
NOTICES = frozenset("consent notice notices popup modal replies newsletter".split())
LEAVES = frozenset("p li dd dt td th h1 h2 h3 h4 h5 h6 blockquote pre".split())
KEPT_TAGS = frozenset("html body main article".split())
WHOLE = frozenset("article main".split())

_START = re.compile(r"<(?=[a-zA-Z!?]|/[a-zA-Z])")
_ASIDE = re.compile(r"<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)", re.S)
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_MARK = re.compile(r"=\s*+[\"']|>")
_PARTS = re.compile(r"[-_]+")
_LABEL = re.compile(r"[\s/](?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"[\s/]hidden(?=[\s=/>])|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)


def is_cut(tag: str, source: str) -> bool:
    """Whether an element is no part of an article whatever it holds, by its start tag."""
    if tag in CUT_TAGS:
        return True
    if tag in KEPT_TAGS or len(source) < len(tag) + 5:
        return False
    return bool(_HIDDEN.search(source))


def names_of(source: str) -> set[str]:
    """Class names, id and role of a start tag, in lower case."""
    return {x for m in _LABEL.finditer(source) for x in "".join(m.groups("")).lower().split()}


def apart(names: set[str]) -> bool:
    """Whether a name tells of comments or cookies."""
    return any(p in APART_NAMES for n in names for p in _PARTS.split(n))


def doubt(tag: str, source: str, in_article: bool) -> int:
    """0 for an element that stays, 1 for one to be cut unless it is a wrapper, 2 if its links decide as well."""
    if tag == "form":
        return 1
    if tag == "header":
        return 2 if in_article else 1
    if tag in ("html", "body", "main") or len(source) < len(tag) + 5:
        return 0
    names = names_of(source)
    if tag == "article":
        return 1 if names & {"comment", "comments"} else 0
    if names & ADVERT_NAMES or "hidden" in names or apart(names):
        return 1
    if names & NOTICES:
        return 2 if tag in LEAVES else 1
    return 2 if names & CUT_NAMES else 0


class Page:
    """Blocks of a page in preorder, and its text runs and block breaks in page order."""

    def __init__(self, source: str) -> None:
        self.tag, self.parent, self.cut = ["#root"], [-1], [False]
        self.chars, self.links, self.link_tags, self.doubts = [0], [0], [0], [0]
        # (block, text), or (block, None) where a block begins or ends.
        self.runs: list[tuple[int, str | None]] = []
        self.stack: list[tuple[str, int]] = [("#root", 0)]  # open elements and the block they are in
        self.places: dict[str, list[int]] = {}  # places of open elements in the stack, by tag
        self.open_blocks: list[int] = []  # and of open block elements
        self.anchors = self.articles = 0
        self.endless: set[int] = set()  # quotes from which no tag ends
        self.read(source)

    def read(self, source: str) -> None:
        at, size = 0, len(source)
        last = source.rfind(">") + 1  # no tag ends after it
        while at < size:
            found = _START.search(source, at)
            if found is None:
                self.text(source[at:])
                return
            begin = found.start()
            aside = source[begin + 1] in "!?"
            end = _ASIDE.match(source, begin).end() if aside else self.tag_end(source, begin) if begin < last else -1
            if end < 0:
                self.text(source[at:])
                return
            if begin > at:
                self.text(source[at:begin])
            at = end
            if aside:
                continue
            tag = _NAME.match(source, begin).group(1).lower()
            if source[begin + 1] == "/":
                self.close(tag)
                continue
            self.open(tag, source[begin:end])
            if tag in RAW:
                over = re.compile(f"</{re.escape(tag)}(?=[\\s/>])[^>]*>", re.I).search(source, at, last)
                self.close(tag)
                at = over.end() if over else size

    def tag_end(self, source: str, begin: int) -> int:
        """Where the tag that begins there ends, quoted values passed over; -1 if nowhere.

        If no end is found past the quotes, they count for nothing. Such quotes are remembered, and a
        later search that comes to one of them ends there."""
        at, passed = begin, []
        while True:
            mark = _MARK.search(source, at)
            if mark is None or mark.end() in self.endless:
                break
            if mark.group() == ">":
                return mark.end()
            passed.append(mark.end())
            at = source.find(mark.group()[-1], mark.end()) + 1
            if not at:
                break
        self.endless.update(passed)
        return source.find(">", begin) + 1 or -1

    def text(self, run: str) -> None:
        run = html.unescape(run) if "&" in run else run
        block = self.stack[-1][1]
        self.runs.append((block, run))
        if not self.cut[block]:
            n = len(run.strip())
            self.chars[block] += n
            if self.anchors:
                self.links[block] += n

    def open(self, tag: str, source: str) -> None:
        if tag in BLOCKS and self.open_blocks and self.stack[self.open_blocks[-1]][0] == "p":
            self.end_up_to({"p"}, {"button"})
        if tag in ENDS:
            self.end_up_to(*ENDS[tag])
        block = self.stack[-1][1]
        if tag == "br":
            self.runs.append((block, " "))
        elif tag == "a":
            self.link_tags[block] += 1
        cut = self.cut[block] or is_cut(tag, source)
        doubted = 0 if cut else doubt(tag, source, self.articles > 0)
        if tag in BLOCKS or cut != self.cut[block] or doubted:
            self.doubts.append(doubted)
            self.tag.append(tag)
            self.parent.append(block)
            self.cut.append(cut)
            self.chars.append(0)
            self.links.append(0)
            self.link_tags.append(0)
            block = len(self.tag) - 1
            if tag in BLOCKS:
                self.runs.append((block, None))
        if tag not in VOID:
            self.places.setdefault(tag, []).append(len(self.stack))
            if tag in BLOCKS:
                self.open_blocks.append(len(self.stack))
            self.stack.append((tag, block))
            self.anchors += tag == "a"
            self.articles += tag in WHOLE

    def pop(self) -> None:
        tag, block = self.stack.pop()
        self.places[tag].pop()
        self.anchors -= tag == "a"
        self.articles -= tag in WHOLE
        if tag in BLOCKS:
            self.open_blocks.pop()
            self.runs.append((block, None))

    def innermost(self, tags: set[str]) -> int:
        """Place of the innermost open element of these, 0 if there is none."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def end_up_to(self, tags: set[str], bounds: set[str]) -> None:
        """End the innermost of tags, if it is open inside the bounds."""
        place = self.innermost(tags)
        if place > self.innermost(bounds):
            while len(self.stack) > place:
                self.pop()

    def close(self, tag: str) -> None:
        place = self.innermost({tag})
        # A formatting element does not end across a block.
        if place and (tag in BLOCKS or not self.open_blocks or self.open_blocks[-1] < place):
            while len(self.stack) > place:
                self.pop()

    def settle(self) -> None:
        """Cut the doubted elements that do not hold the article."""
        n = len(self.tag)
        chars, links = list(self.chars), list(self.links)
        # Articles in each element, and around it; a comment that is an article is none of them.
        whole = [int(t in WHOLE and not c and not d) for t, c, d in zip(self.tag, self.cut, self.doubts, strict=True)]
        inside, around = list(whole), [0] * n
        for i in range(n - 1, 0, -1):
            up = self.parent[i]
            chars[up] += chars[i]
            links[up] += links[i]
            inside[up] += inside[i]
        text = chars[0] - links[0]
        for i in range(1, n):
            up = self.parent[i]
            around[i] = around[up] + whole[up]
            holds = inside[i] and inside[i] + around[i] == inside[0]
            # Most of the text tells the article only where no element says so.
            most = not inside[0] and 2 * (chars[i] - links[i]) > text
            if self.doubts[i] and not holds and not most:
                self.cut[i] = self.cut[i] or self.doubts[i] == 1 or 2 * links[i] > chars[i]
            if self.cut[up]:
                self.cut[i] = True
        for i in range(n):
            if self.cut[i]:
                self.chars[i] = self.links[i] = 0


def main_text(source: str | None) -> str:
    """Text of the page's article; empty if it has none."""
    if not source:
        return ""
    page = Page(source)
    if any(page.doubts):
        page.settle()
    n = len(page.tag)
    chars, links, link_tags = list(page.chars), list(page.links), list(page.link_tags)
    tags, last = [0] * n, list(range(n))
    for i in range(n - 1, 0, -1):
        up = page.parent[i]
        last[up] = max(last[up], last[i])
        if not page.cut[i]:
            chars[up] += chars[i]
            links[up] += links[i]
            link_tags[up] += link_tags[i]
            tags[up] += tags[i] + 1
    body = next((i for i in range(n) if page.tag[i] == "body"), 0)
    if not chars[body]:
        body = 0
    share = links[body] / max(chars[body], 1)

    density, sums = [0.0] * n, [0.0] * n
    for i in range(n - 1, 0, -1):
        if page.cut[i] or not chars[i]:
            continue
        c, t, lc, lt = chars[i], max(tags[i], 1), max(links[i], 1), max(link_tags[i], 1)
        base = math.log(c / max(c - links[i], 1) * links[i] + share * c + math.e)
        density[i] = c / t * max(math.log(c / lc * t / lt + 1) / base, 0.0)
        sums[page.parent[i]] += density[i]
    best = max(range(body, last[body] + 1), key=lambda i: (0.0 if page.cut[i] else sums[i], -i))
    if not sums[best]:
        best = body

    steps = [0] * (n + 1)  # where chosen subtrees begin and end

    def choose(i: int) -> None:
        steps[i] += 1
        steps[last[i] + 1] -= 1

    path = [best]
    while path[-1] > body:
        path.append(page.parent[path[-1]])
    whole = [i for i in path if page.tag[i] in WHOLE]
    choose(whole[-1] if whole else best)
    if best != body:
        # The node with the highest sum in each subtree, of equal ones the first.
        top = list(range(n))
        for i in range(n - 1, body, -1):
            up = page.parent[i]
            if not page.cut[i] and (sums[top[i]], -top[i]) > (sums[top[up]], -top[up]):
                top[up] = top[i]
        threshold = min(density[i] for i in path[:-1])
        for i in range(body + 1, last[body] + 1):
            if density[i] and density[i] >= threshold:
                choose(top[i])

    chosen = [depth > 0 for depth in accumulate(steps)]
    blocks: list[str] = []
    open_run: list[str] = []
    for block, run in page.runs:
        if not chosen[block]:
            continue
        if run is not None:
            if not page.cut[block]:
                open_run.append(run)
        elif open_run:
            blocks.append(" ".join("".join(open_run).split()))
            open_run = []
    blocks.append(" ".join("".join(open_run).split()))
    return "\n".join(b for b in blocks if b)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars; a row per input row.

    A null or empty page and a page without an article have an empty text. Repeated rows stay; other
    columns of the input are not carried. A page is handled on its own, whatever its length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tx.chunks(batch, "html"):
                texts = [main_text(x) for x in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_pydict(
                    {
                        "page_id": part.column("page_id"),
                        "url": part.column("url"),
                        "text": pa.array(texts, pa.string()),
                        "n_chars": pa.array([len(t) for t in texts], pa.int64()),
                    }
                )

    id_type = pages.schema["page_id"].dataType.simpleString()
    slim = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return slim.mapInArrow(run, f"page_id {id_type}, url string, text string, n_chars long")
