"""Main text of web pages by composite text density.

For each DOM node: the characters per tag, lowered by the share of characters and tags that belong to links. The node whose
children have the largest sum of densities holds the article. Everything inside the chosen subtree is kept, however short,
linked headlines and lists of sources too. Where the chosen node stands inside an article or main element, the subtree is
that of the element, so that headings beside the text body are kept. Elsewhere an article may be spread over containers:
the smallest density on the way from the chosen node up to the body is the page's threshold, and of the parts beside that
way only those containers go that consist mainly of links, are less dense than the threshold and hold no h1. Headings,
paragraphs and running text there are kept.

Parts that are boilerplate by their element, role, class or id never enter the tree. Outside of articles any word of a class
counts, inside them a class counts only if it is made of such words and of words for parts of a page ("social-share", not
"share-price"); an id counts as a whole only, and not at a heading or at a section of an article, where it may be made from
a title (comments excepted). A header or label inside an article or main belongs to it. A form is boilerplate unless it holds an article or main, or most of the page's text.

Defined results: null, empty or tagless-but-blank html has an empty text; html without tags is one block; a page cut off in
a tag loses only that tag; repeated rows are extracted one by one; pages are read to their end at any length; columns other
than page_id, url and html are not looked at.
"""

from __future__ import annotations

import html as references
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from wirelake.llm.arrays import map_batches, text_slices

#: Elements of the HTML standard.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CONTAINERS = BLOCKS - frozenset("h1 h2 h3 h4 h5 h6 p blockquote pre".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes svg math".split())
DROPPED = frozenset("nav footer aside head button select dialog menu object option optgroup".split())
DROPPED_OUTSIDE = frozenset("header label".split())  # outside of articles and main
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar toolbar".split())
#: An element closes open ones of these kinds, up to the first of the others.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"table"}), "th": ({"td", "th"}, {"table"}), "tr": ({"tr"}, {"table"}),
    "tbody": ({"tbody", "thead", "tfoot"}, {"table"}), "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}),
}
WHOLE = frozenset("html body main article".split())

#: Words in a class that mark boilerplate.
HINTS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner nav navbar navigation menu "
    "breadcrumb breadcrumbs masthead footer sidebar widget widgets cookie cookies consent gdpr notice notices alert popup modal "
    "overlay newsletter subscribe subscription signup login share sharing social related recommended pagination pager toolbar "
    "copyright disclaimer skip search comment comments disqus replies reply respond discussion reactions commentlist".split()
)
COMMENT_HINTS = frozenset("comment comments disqus replies reply respond discussion reactions commentlist".split())
WRAPPER = frozenset("has with no without".split())
#: Words that may stand beside those in an id. Any other word makes it the slug of a heading, which says nothing of the part.
LAYOUT = frozenset("site page main global primary secondary top bottom left right inner outer container wrapper wrap box bar slot block".split())
#: Words that stand beside a hint in the classes of boilerplate inside an article.
PARTS = LAYOUT | frozenset("list lists item items area areas button buttons icon icons link links articles posts stories unit units header title".split())
NAMED_BY_TITLE = frozenset("h1 h2 h3 h4 h5 h6 section".split())

# A quote opens a value only after an equals sign, so a stray one does not swallow the page.
TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*(?:"[^"]*"|'[^']*')?|[^>=])*+)(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
MARKS = re.compile("class|id|role|hidden", re.I)
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


def _attributes(text: str) -> dict[str, str]:
    """Values by name in lower case; of equal names the first counts."""
    found: dict[str, str] = {}
    for name, *values in ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), "".join(values))
    return found


def _words(value: str) -> set[str]:
    return {name.lower() for name in NAME.findall(value)}


def _class_marks(value: str, hints: frozenset[str] | set[str], in_text: bool) -> bool:
    """Whether a class, taken by itself, names boilerplate: by any of its words, inside an article or main by all of them.

    A class with a word like "has" or "no" tells something of the part that it stands at, not what the part is."""
    for token in value.split():
        words = _words(token)
        if words & hints and not words & WRAPPER and (not in_text or words <= hints | PARTS):
            return True
    return False


def _is_boilerplate(tag: str, attributes: str, in_text: bool) -> bool:
    """in_text: inside an article or main."""
    if tag in DROPPED or tag in DROPPED_OUTSIDE and not in_text:
        return True
    if not attributes or not MARKS.search(attributes):
        return False
    given = _attributes(attributes)
    if "hidden" in given or given.get("aria-hidden", "").strip().lower() == "true":
        return True
    if given.get("role", "").strip().lower() in ROLES:
        return True
    hints = COMMENT_HINTS if tag in WHOLE else HINTS if in_text else HINTS | {"header"}
    if _class_marks(given.get("class", ""), hints, in_text):
        return True
    # an id counts as a whole only: all its words are hints, and outside of articles also places of the layout
    name = {word for word in _words(given.get("id", "")) if not word.isdigit()}
    if tag in NAMED_BY_TITLE and (in_text or tag != "section"):
        return tag == "section" and name <= {"comment", "comments", "disqus", "commentlist"} and bool(name)
    return bool(name & hints) and name <= hints | (set() if in_text else LAYOUT)


def _is_form(tag: str, attributes: str) -> bool:
    return tag == "form" or "role" in attributes.lower() and _attributes(attributes).get("role", "").strip().lower() == "form"


class Tree:
    """Elements in page order, without boilerplate, and the texts between their tags."""

    def __init__(self, page: str):
        self.tags, self.parents = ["#"], [-1]
        self.texts: list[tuple[int, str | None]] = []  # (node, text), None where a block begins or ends
        self.links, self.inside = [False], [False]  # inside a link; inside an article or main
        self.forms: list[int] = []
        self._read(page)
        self._drop_forms()

    def _read(self, page: str) -> None:
        stack: list[tuple[str, int]] = [("#", 0)]  # dropped elements have node -1, as have all inside them
        place, size = 0, len(page)
        while place < size:
            cut = page.find("<", place)
            while cut >= 0 and cut + 1 < size and not (page[cut + 1].isalpha() or page[cut + 1] in "/!?"):
                cut = page.find("<", cut + 1)
            if cut < 0:
                cut = size
            if cut > place:
                self._text(stack[-1][1], page[place:cut])
            if cut >= size:
                break
            found = TOKEN.match(page, cut)
            if found is None:  # "</" before something else than a name: a comment by the standard
                place = page.find(">", cut) + 1 or size
                continue
            place = found.end()
            slash, name, attributes = found.groups()
            if name is None:
                continue
            tag = name.lower()
            if slash:
                if self._close(stack, tag):
                    self._break(stack[-1][1])
                continue
            if tag in RAW:
                end = re.compile(f"</{re.escape(tag)}[^>]*(?:>|\\Z)", re.I).search(page, place)
                if tag not in ("svg", "math") or not attributes.endswith("/"):
                    place = end.end() if end else size
                self._text(stack[-1][1], " ")
                continue
            if tag in BLOCKS:
                self._close(stack, "p", within=True)
                if tag in CLOSES:
                    self._close_kinds(stack, *CLOSES[tag])
                self._break(stack[-1][1])
            node = stack[-1][1]
            if tag in VOID:
                self._text(node, " ")
                if tag == "hr" and node >= 0:
                    self._add(tag, node)
                continue
            if node >= 0:
                if _is_boilerplate(tag, attributes, self.inside[node]):
                    node = -1
                else:
                    node = self._add(tag, node)
                    if _is_form(tag, attributes):
                        self.forms.append(node)
            stack.append((tag, node))

    def _add(self, tag: str, parent: int) -> int:
        self.tags.append(tag)
        self.parents.append(parent)
        self.links.append(tag == "a" or self.links[parent])
        self.inside.append(tag in ("article", "main") or self.inside[parent])
        return len(self.tags) - 1

    def _text(self, node: int, text: str) -> None:
        if node >= 0:
            self.texts.append((node, references.unescape(text) if "&" in text else text))

    def _break(self, node: int) -> None:
        """A block begins or ends here, a dropped one too."""
        if node >= 0:
            self.texts.append((node, None))

    def _drop_forms(self) -> None:
        """Takes out the forms, but for those that hold an article or main, or most of the page's text."""
        if not self.forms:
            return
        n = len(self.tags)
        chars, holds = [0] * n, [tag in ("article", "main") for tag in self.tags]
        for node, text in self.texts:
            chars[node] += len(text.strip()) if text else 0
        for node in range(n - 1, 0, -1):
            chars[self.parents[node]] += chars[node]
            holds[self.parents[node]] |= holds[node]
        gone = {node for node in self.forms if not holds[node] and 2 * chars[node] <= chars[0]}
        if not gone:
            return
        new = [0] * n  # numbers of the nodes that stay; -1 for the others
        stay = [0]
        for node in range(1, n):
            if node in gone or new[self.parents[node]] < 0:
                new[node] = -1
            else:
                new[node] = len(stay)
                stay.append(node)
        self.texts = [(new[node], text) for node, text in self.texts if new[node] >= 0]
        self.parents = [new[self.parents[node]] if node else -1 for node in stay]
        self.tags, self.links, self.inside = ([values[node] for node in stay] for values in (self.tags, self.links, self.inside))

    @staticmethod
    def _close(stack: list[tuple[str, int]], tag: str, within: bool = False) -> bool:
        """Closes the innermost ``tag``; whether a block was closed. within: not beyond the innermost block."""
        for at in range(len(stack) - 1, 0, -1):
            if stack[at][0] == tag:
                blocks = any(t in BLOCKS for t, _ in stack[at:])
                del stack[at:]
                return blocks
            if within and stack[at][0] in BLOCKS:
                return False
        return False

    @staticmethod
    def _close_kinds(stack: list[tuple[str, int]], kinds: set[str], within: set[str]) -> None:
        for at in range(len(stack) - 1, 0, -1):
            if stack[at][0] in within:
                return
            if stack[at][0] in kinds:
                del stack[at:]
                return

    def densities(self) -> tuple[list[float], list[float], list[float]]:
        """Composite density, sum of the children's densities, and share of characters in links, of each node."""
        n = len(self.tags)
        chars, link_chars, tags, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
        for node, text in self.texts:
            size = len(text.strip()) if text else 0
            chars[node] += size
            if self.links[node]:
                link_chars[node] += size
        for node in range(n - 1, 0, -1):
            up = self.parents[node]
            chars[up] += chars[node]
            link_chars[up] += link_chars[node]
            tags[up] += tags[node] + 1
            link_tags[up] += link_tags[node] + (self.tags[node] == "a")
        ratio = link_chars[0] / max(chars[0], 1)
        density, sums, share = [0.0] * n, [0.0] * n, [0.0] * n
        for node in range(n - 1, -1, -1):
            c, lc, t, lt = chars[node], link_chars[node], max(tags[node], 1), max(link_tags[node], 1)
            if c:
                base = math.log(c / max(c - lc, 1) * lc + ratio * c + math.e)
                density[node] = max(c / t * math.log(c / max(lc, 1) * t / lt + 1e-9) / max(math.log(base), 1.0), 0.0)
                share[node] = lc / c
            if node:
                sums[self.parents[node]] += density[node]
        return density, sums, share

    def blocks(self) -> list[str]:
        density, sums, share = self.densities()
        best = max(range(len(sums)), key=lambda i: (sums[i], -i))
        path, node = [], best
        while node > 0:
            path.append(node)
            node = self.parents[node]
        threshold = min((density[i] for i in path if self.tags[i] not in ("html", "body")), default=0.0)
        top = next((i for i in path if self.tags[i] in ("article", "main")), 0)
        way = set() if top else {0, *path} - {best}  # above the chosen node; what hangs there is kept or dropped as a whole
        headed = [tag == "h1" for tag in self.tags]
        for i in range(len(self.tags) - 1, 0, -1):
            headed[self.parents[i]] |= headed[i]
        kept, kin = [False] * len(self.tags), [0] * len(self.tags)  # kin: the innermost block around a node
        for i in range(len(self.tags)):
            up = self.parents[i]
            kept[i] = i == top or up >= 0 and kept[up]
            if up in way and i not in way and i != best and self.tags[i] in CONTAINERS and not headed[i]:
                kept[i] = kept[i] and not (share[i] > 0.5 and density[i] < threshold)
            kin[i] = i if self.tags[i] in BLOCKS or up < 0 else kin[up]
        out: list[str] = []
        last, parts = -1, []
        for node, text in self.texts:
            if not kept[node]:
                continue
            if kin[node] != last or text is None:
                out.append("".join(parts))
                last, parts = kin[node], []
            parts.append(text or "")
        out.append("".join(parts))
        return [block for block in (" ".join(part.split()) for part in out) if block]


def main_text(page: str | None) -> str:
    return "\n\n".join(Tree(page).blocks()) if page else ""


def extract_main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text of the article (blocks joined by a blank line) and its n_chars, for each row of pages."""

    def extract(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for row, end, _, _ in text_slices(batch.column(2)):
            texts = [main_text(page) for page in batch.column(2).slice(row, end - row).to_pylist()]
            ids, urls = (batch.column(i).slice(row, end - row) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([ids, urls, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return map_batches(pages.select("page_id", "url", "html"), extract, f"page_id {kind}, url string, text string, n_chars long")
