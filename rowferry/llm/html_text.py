"""Main text of web pages by composite text density."""

from __future__ import annotations

import html
import math
import re
from bisect import bisect_left
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowferry.llm.common import bounded_batches

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
BROKEN_TAG = re.compile(r"</?[a-zA-Z][^<>]*(?:>|\Z)", re.S)
MARKS = re.compile(r"\b(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template title textarea iframe svg math select object".split())
# of these, what runs to the end of the page without an end tag
TO_END = set("script style textarea title".split())
HEAD_VOID = set("base link meta".split())
BLOCK = set(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hr html li main nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
# an opening tag of the key ends what is open of the value, up to the nearest of BOUNDS
ENDS = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
    "tbody": {"thead", "tbody", "tr", "td", "th"},
    "tfoot": {"thead", "tbody", "tr", "td", "th"},
}
LISTED = set("ul ol li dl dt dd option fieldset".split())
BOUNDS = set("article aside body div dl footer form header main nav ol section table td th ul blockquote".split())
# elements that never hold article text, and those that hold none unless they are wrapped around the page
ASIDE_TAGS = set("nav footer aside button input menu".split())
WRAP_TAGS = set("form dialog".split())
ARTICLE_TAGS = {"article", "main"}
HEADING = re.compile("h[1-6]")
ASIDE_NAMES = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar menu nav navbar "
    "navigation breadcrumb breadcrumbs footer header masthead comment comments disqus respond reply replies notice notices "
    "cookie cookies consent gdpr popup modal overlay subscribe newsletter signup login share sharing social related "
    "recommended widget toolbar search pagination pager".split()
)
# words that turn a name of them into a mark of the layout or the topic, before and behind it
LAYOUT = set("has no not with without hide show is".split())
TOPIC = set("work works research literature studies".split())
# of a page's unlinked text, the share from which a named element is a wrapper and no aside; readers may write more
WRAPPER = 2 / 3
# a wrapper leaves no more than this share of its own text outside it, or holds so many blocks and is no notice or advert
OUTSIDE, BLOCKS = 0.02, 4
NOTICE_NAMES = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion notice notices cookie cookies consent "
    "gdpr popup modal overlay subscribe newsletter signup login".split()
)
ANY_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)[^>]*>", re.S)
COMMENT_NAMES = set("comment comments disqus respond reply replies".split())
ASIDE_ROLES = set("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())


def aside_names(tag: str, attributes: str) -> set[str]:
    """The words in an element's class and id that name something beside an article; none for headings."""
    found: set[str] = set()
    if not attributes or tag in ("body", "html", "article", "main") or HEADING.fullmatch(tag):
        return found
    for name, *values in MARKS.findall(attributes):
        if name.lower() in ("class", "id"):
            for compound in next((v for v in values if v), "").lower().split():
                parts = [part for part in re.split(r"[^a-z0-9]+", compound) if part]
                for i, part in enumerate(parts):
                    layout = not LAYOUT.isdisjoint(parts[:i]) or not TOPIC.isdisjoint(parts[i + 1 :])
                    if part in ASIDE_NAMES and not layout:
                        found.add(part)
    return found


def is_aside(tag: str, attributes: str, in_article: bool) -> bool:
    """Whether an element is known by its tag, role or marks not to be part of an article."""
    if tag in ASIDE_TAGS or (tag == "header" and not in_article):
        return True
    for name, *values in MARKS.findall(attributes) if attributes else ():
        name, value = name.lower(), next((v for v in values if v), "").lower()
        if name == "aria-hidden" and value == "true":
            return True
        if name == "role" and value in ASIDE_ROLES:
            return True
    return False


def wrap_names(tag: str, attributes: str) -> set[str]:
    """What makes an element an aside unless the page stands in it, as forms and containers hidden for scripts may do."""
    if tag in ("body", "html", *ARTICLE_TAGS) or HEADING.fullmatch(tag):
        return set()
    hidden = attributes and any(name.lower() == "hidden" for name, *_ in MARKS.findall(attributes))
    return ({tag} if tag in WRAP_TAGS else set()) | ({"hidden"} if hidden else set())


class Ends:
    """Where the elements of a source end and its articles begin, by one pass over its tags."""

    def __init__(self, source: str):
        self.behind: dict[int, int] = {}
        self.articles: list[int] = []
        waiting: dict[str, list[int]] = {}
        for found in ANY_TAG.finditer(source):
            if not found[2]:
                continue
            tag = found[2].lower()
            if not found[1]:
                waiting.setdefault(tag, []).append(found.start())
                if tag in ARTICLE_TAGS:
                    self.articles.append(found.start())
            elif waiting.get(tag):
                self.behind[waiting[tag].pop()] = found.end()

    def article(self, at: int) -> int | None:
        """The next article from a place on."""
        i = bisect_left(self.articles, at)
        return self.articles[i] if i < len(self.articles) else None


class Page:
    """The elements of a page in page order with what they hold: characters, tags, linked characters, linked tags."""

    def __init__(self, source: str):
        self.tag, self.parent = ["html"], [-1]
        self.own = [0]
        self.linked, self.in_article = [False], [False]
        self.named: dict[int, set[str]] = {}  # elements that their names call asides
        self.texts: list[tuple[int, int, str]] = []  # element, block, text
        self.stack, self.block = [0], 0
        self.ends = Ends(source)
        endless: set[str] = set()  # raw elements that have no end tag any more
        at, in_head = 0, False
        while at < len(source):
            found = TOKEN.search(source, at)
            self.add(source[at : found.start() if found else len(source)])
            if not found:
                break
            at = found.end()
            if found[2]:
                tag = found[2].lower()
                # a head ends with the first tag that may not stand in it, its end tag or not
                in_head = tag == "head" and not found[1] or in_head and tag in HEAD_VOID | RAW
                if tag == "head" or in_head and tag in HEAD_VOID:
                    continue
                if found[1]:
                    self.close(tag)
                elif tag in RAW and not found[3].endswith("/"):
                    end = None
                    if tag not in endless:
                        end = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(source, at)
                    endless.update(() if end else (tag,))
                    at = end.end() if end else len(source) if tag in TO_END else self.level_end(source, at)
                elif is_aside(tag, found[3], self.in_article[self.stack[-1]]):
                    self.block += 1
                    at = at if tag in VOID else self.skip(source, at, tag, found.start())
                elif tag == "br":
                    self.texts.append((self.stack[-1], self.block, " "))
                else:
                    names = aside_names(tag, found[3]) | wrap_names(tag, found[3])
                    if tag == "hr" or names and tag not in VOID:
                        self.block += 1
                    if names and tag not in VOID and found.start() not in self.ends.behind:
                        article = self.ends.article(at)
                        at = at if article is None else article
                        continue
                    self.open(tag, found[3].endswith("/"))
                    if names:
                        self.named[len(self.tag) - 1] = names

    def skip(self, source: str, at: int, tag: str, start: int) -> int:
        """The place behind an element whose opening tag stands from `start` to `at`.

        Without an end tag it ends before the next article; if there is none, sections end as `level_end` says and
        what stands in other elements stays.
        """
        if start in self.ends.behind:
            return self.ends.behind[start]
        article = self.ends.article(at)
        return article if article is not None else self.level_end(source, at) if tag in ASIDE_TAGS else at

    def level_end(self, source: str, at: int) -> int:
        """Where an element without an end tag ends: before the next block or the end tag of an element around it.

        A list is not such a block, as menus consist of them.
        """
        around = {self.tag[i] for i in self.stack}
        for found in TOKEN.finditer(source, at):
            tag = (found[2] or "").lower()
            if (tag in around) if found[1] else (tag in BLOCK - LISTED):
                return found.start()
        return len(source)

    def add(self, text: str) -> None:
        text = BROKEN_TAG.sub(" ", text) if "<" in text else text
        text = html.unescape(text)
        if not text:
            return
        node = self.stack[-1]
        self.own[node] += len(" ".join(text.split()))
        self.texts.append((node, self.block, text))

    def open(self, tag: str, closed: bool) -> None:
        if tag in BLOCK:
            self.block += 1
            self.end({"p"}, BOUNDS) if tag not in ("html", "body") else None
        if tag in ENDS:
            self.end(ENDS[tag], set("ul ol dl table select".split()))
        up = self.stack[-1]
        self.tag.append(tag)
        self.parent.append(up)
        self.own.append(0)
        self.linked.append(self.linked[up] or tag == "a")
        self.in_article.append(self.in_article[up] or tag in ARTICLE_TAGS)
        if tag not in VOID and not closed:
            self.stack.append(len(self.tag) - 1)

    def end(self, tags: set[str], bounds: set[str]) -> None:
        """Close the outermost open element of `tags` that stands below the nearest bound."""
        for depth in range(len(self.stack) - 1, 0, -1):
            tag = self.tag[self.stack[depth]]
            if tag in tags:
                del self.stack[depth:]
            elif tag in bounds:
                return

    def close(self, tag: str) -> None:
        if tag in BLOCK:
            self.block += 1
        for depth in range(len(self.stack) - 1, 0, -1):
            if self.tag[self.stack[depth]] == tag:
                del self.stack[depth:]
                return
            if tag not in BLOCK and self.tag[self.stack[depth]] in BLOCK:
                return

    def cut(self) -> list[bool]:
        """Whether each element is in one that its name calls an aside.

        A name does not count for an element that holds the page's only articles, or is a wrapper: it holds most of the
        unlinked text, and either hardly any stands outside it and other such elements, or it has several blocks and is not
        named for a notice or an advert. What is only named for comments is no wrapper.
        """
        n = len(self.tag)
        out = [False] * n
        if not self.named:
            return out
        free = [0 if self.linked[i] else self.own[i] for i in range(n)]
        holds, within = [tag in ARTICLE_TAGS for tag in self.tag], [i in self.named for i in range(n)]
        for i in range(1, n):
            within[i] = within[i] or within[self.parent[i]]
        apart = any(holds[i] and not within[i] for i in range(n))
        outside = sum(f for f, w in zip(free, within, strict=True) if not w)
        held: dict[int, set[int]] = {i: set() for i in self.named}
        owner = [0] * n  # the innermost named element around each
        for i in range(1, n):
            owner[i] = i if i in held else owner[self.parent[i]]
        for node, block, text in self.texts:
            if owner[node] and text.strip() and not self.linked[node]:
                held[owner[node]].add(block)
        for i in range(n - 1, 0, -1):
            free[self.parent[i]] += free[i]
            holds[self.parent[i]] = holds[self.parent[i]] or holds[i]
        for i in range(1, n):
            out[i] = out[self.parent[i]]
            if i in self.named and not out[i]:
                most = free[i] >= WRAPPER * free[0] and not self.named[i] <= COMMENT_NAMES
                several = len(held[i]) >= BLOCKS and self.named[i].isdisjoint(NOTICE_NAMES)
                wrapper = most and (outside <= OUTSIDE * free[i] or several)
                only = holds[i] and not apart and not (self.named[i] <= COMMENT_NAMES and free[i] < free[0] / 2)
                out[i] = not (wrapper or only)
        return out

    def chosen(self) -> list[bool]:
        """Whether each element is in a subtree that is selected.

        The element with the largest sum of its children's densities is the centre; the least density on its way up to
        the body is the threshold. Every element as dense as that gives the element with the largest sum below it. An
        article around a selected element is taken whole.
        """
        n, cut = len(self.tag), self.cut()
        chars = [0 if cut[i] else self.own[i] for i in range(n)]
        tags, link_tags = [int(not x) for x in cut], [int(x and not y) for x, y in zip(self.linked, cut, strict=True)]
        link_chars = [chars[i] if self.linked[i] else 0 for i in range(n)]
        for i in range(n - 1, 0, -1):
            up = self.parent[i]
            for count in (chars, tags, link_chars, link_tags):
                count[up] += count[i]
        root = next((i for i in range(n) if self.tag[i] == "body"), 0)
        share = link_chars[root] / max(chars[root], 1)
        density = [0.0] * n
        for i in range(n):
            if chars[i]:
                free = max(chars[i] - link_chars[i], 1)
                base = math.log(chars[i] / free * link_chars[i] + share * chars[i] + math.e)
                odds = chars[i] / max(link_chars[i], 1) * tags[i] / max(link_tags[i], 1)
                density[i] = chars[i] / tags[i] * max(math.log(max(odds, 1e-9)) / math.log(max(base, 1.000001) + 1e-9), 0)
        total = [0.0] * n
        for i in range(1, n):
            total[self.parent[i]] += density[i]
        best = list(range(n))  # of each subtree
        for i in range(n - 1, 0, -1):
            up = self.parent[i]
            if total[best[i]] > total[best[up]] or (total[best[i]] == total[best[up]] and best[up] != up):
                best[up] = best[i]
        centre = best[root]
        threshold, i = math.inf, centre
        while i >= 0:
            threshold = min(threshold, density[i])
            i = self.parent[i] if i != root else -1
        taken, article = [False] * n, [-1] * n  # article: the outermost around each element
        for i in range(n):
            up = article[self.parent[i]] if i else -1
            article[i] = up if up >= 0 else i if self.tag[i] in ARTICLE_TAGS else -1
        for i in range(n):
            if chars[i] and density[i] >= threshold:
                taken[article[best[i]] if article[best[i]] >= 0 else best[i]] = True
        for i in range(1, n):
            taken[i] = (taken[i] or taken[self.parent[i]]) and not cut[i]
        return taken

    def text(self) -> str:
        taken = self.chosen()
        blocks: dict[int, list[str]] = {}
        for node, block, text in self.texts:
            if taken[node]:
                blocks.setdefault(block, []).append(text)
        lines = (" ".join("".join(parts).split()) for parts in blocks.values())
        return "\n".join(line for line in lines if line)


def main_text(source: str | None) -> str:
    return Page(source).text() if source else ""


def extract_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars for every row of `pages` (page_id long, url, html).

    text: the article in blocks of one line each, without navigation, headers, footers, asides, forms, adverts, notices,
    scripts, styles and comments; empty for null, empty or textless pages. Broken markup is read as browsers roughly
    do; a cut-off tag is dropped. Repeated rows stay; other columns are ignored.
    """
    import pyarrow as pa

    bounded_batches(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(source) for source in batch.column(2).to_pylist()]
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
