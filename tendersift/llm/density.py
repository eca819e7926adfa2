"""Main text of HTML pages by composite text density.

Every DOM node gets its characters per tag, adjusted by how much of it is link text; a node's density sum
is that of its children. The subtree with the greatest sum below the body is the article: a winner inside
a paragraph stands for the block around it, and one inside `article` or `main` for that element. Without
such an element, blocks beside the path from the body to the winner belong to the text if they are no less
dense than the thinnest node of that path and not mostly links. Menus, headers, footers, sidebars, notices,
adverts, forms, scripts, styles and reader comments are taken out first, by element or by class, id and role.
A class or id counts by its last word, once nouns of place (`-area`, `-left`) are off; names of a state or a subject
(`ad-free`, `no-ads`, `comments-open`, `category-promotion`) do not count.

A wrapper stays whatever its name: an element named so, or a form, that holds more than half of the characters where no
text but headings and links is left beside such elements (then the same holds inside it). Only reader comments go even so. Beyond
that, comments, adverts and notices go however long; another class or a form also stays on an element with more than half of the
remaining characters if, without all such elements, no `article` or `main` is left and either the element holds
one or no paragraph is left; a form also if its paragraphs are most of the page and at least `LEAST_PROSE` characters. Inside a
form that stays, its controls and their labels go.

Cases: null, empty and text-free pages give an empty text; plain text without tags is its own text;
unclosed, crossing and stray tags (a text or a tag that no head can hold ends an open head), unknown character references and any depth of nesting are accepted;
repeated rows are extracted alike; other columns are ignored; no rows, no rows.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tendersift.llm.texts import read

MARKUP = re.compile(r"""<!--(?:.*?--!?>|.*\Z)|<!\[CDATA\[(?P<data>.*?)\]\]>|<[!?][^>]*+>
    |<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>
    |<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*+)(?P<attrs2>[^>]*+)>""", re.S | re.X)
UNENDED = re.compile(r"</?[a-zA-Z]")
ATTRIBUTE = re.compile(r"""(?:^|[\s"'])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong "
                   "sub sup time tt u var wbr img".split())
PARAGRAPH = INLINE | frozenset("p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre figcaption ul ol dl tr td th tbody thead table".split())
BOILERPLATE = frozenset("nav footer aside label legend script style noscript iframe button select option textarea svg canvas object template dialog "
                        "menu head title input fieldset audio video".split())
BOILER_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
BOILER_WORDS = frozenset("""ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu
    menubar breadcrumb breadcrumbs header masthead footer sidebar aside widget widgets related recommended comment comments
    disqus respond cookie cookies consent gdpr notice notification alert popup modal overlay newsletter subscribe subscription signup login share
    sharing social toolbar pagination pager""".split())
ALWAYS_OUT = frozenset("""ad ads advert adverts advertisement advertising sponsor sponsored promo promotion comment comments disqus respond
    cookie cookies consent gdpr notice notification alert popup modal overlay""".split())
NAMED_ANYWHERE = frozenset("advert adverts advertisement advertising sponsored disqus cookie cookies consent gdpr newsletter".split())
COMMENTS = frozenset("comment comments disqus respond".split())
PLACES = frozenset("""area section sections list lists item items box boxes wrap wrapper container holder block slot unit bar panel inner outer left
    right top bottom primary secondary content body row col column columns group module region zone frame posts articles stories links
    buttons icons form thread text title""".split())
STATES = frozenset("no non not without free has with open closed enabled disabled allowed category cat tag tags topic format type status".split())
MAIN = frozenset(["article", "main"])
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSES = {   # an opening tag ends these open elements, up to the nearest of the scope
    "li": (frozenset(["li"]), frozenset("ul ol menu".split())),
    "dt": (frozenset("dt dd".split()), frozenset(["dl"])), "dd": (frozenset("dt dd".split()), frozenset(["dl"])),
    "tr": (frozenset("tr td th".split()), frozenset(["table"])), "td": (frozenset("td th".split()), frozenset("tr table".split())),
    "th": (frozenset("td th".split()), frozenset("tr table".split())), "option": (frozenset(["option"]), frozenset(["select"])),
}
SCOPE = frozenset("html body article main section aside nav table td th div".split())
IN_HEAD = frozenset("title meta link base script style noscript template".split())
ENDS_P = frozenset("""address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6
    header hgroup hr main menu nav ol p pre search section summary table ul""".split())
MOST_LINKS = 0.5
LEAST_PROSE = 500   # characters in paragraphs of a form that is more than a form


def named(value: str) -> set[str]:
    """The words of a class or id that name what its element is."""
    out = set()
    for name in value.split():
        words = [w.lower() for w in WORD.findall(name) if len(w) > 1]
        if not STATES.isdisjoint(words):
            continue
        out |= NAMED_ANYWHERE.intersection(words)
        whole = "".join(words)
        if whole in BOILER_WORDS:
            out.add(whole)
        while len(words) > 1 and words[-1] in PLACES:
            words.pop()
        out.update(words[-1:])
        out.add("".join(words[-2:]))     # navBar, bread-crumb
    return out & BOILER_WORDS


class Page:
    """Nodes of a page in document order, so a subtree is a range; `events` are the texts and breaks in order."""

    def __init__(self, source: str):
        self.tag, self.parent, self.end = ["#root"], [-1], [0]
        self.out, self.word_out = [False], [False]   # taken out whatever its size; unless it is a wrapper
        self.always, self.comments = [False], [False]   # of word_out: whatever its size but for a wrapper of all; even then
        self.events: list[tuple[int, str]] = []
        self._parse(source)
        self.size = len(self.tag)

    def _open(self, tag: str, parent: int, attrs: str) -> int:
        i = len(self.tag)
        self.tag.append(tag)
        self.parent.append(parent)
        self.end.append(i + 1)
        out, names = tag in BOILERPLATE, set()
        if attrs and not attrs.isspace():
            for m in ATTRIBUTE.finditer(attrs):
                name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
                if name in ("class", "id"):
                    names |= named(value)
                elif name == "role":
                    out |= not BOILER_ROLES.isdisjoint(value.lower().split())
                elif name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and HIDDEN.search(value):
                    out = True
        if tag == "header" and not any(self.tag[j] in MAIN for j in self._above(parent)):
            out = True
        if tag in ("html", "body", "article", "main"):
            out, names = False, set()
        self.out.append(out)
        self.word_out.append(bool(names) or tag == "form")
        self.always.append(not ALWAYS_OUT.isdisjoint(names))
        self.comments.append(not COMMENTS.isdisjoint(names))
        return i

    def _above(self, i: int) -> Iterator[int]:
        while i > 0:
            yield i
            i = self.parent[i]

    def _parse(self, s: str) -> None:
        stack, at, n, events = [0], 0, len(s), self.events
        head = 0   # the latest head, while it may be open
        tags, shut = self.tag, s.rfind(">")   # a tag that begins behind the last ">" never ends and is no text
        while at < n:
            i = s.find("<", at)
            if i < 0:
                i = n
            if i > at:
                if head and not s[at:i].isspace():
                    del stack[stack.index(head) if head in stack else len(stack):]
                    head = 0
                events.append((stack[-1], s[at:i]))
            if i == n:
                break
            if i > shut and UNENDED.match(s, i):
                break
            m = MARKUP.match(s, i)
            if not m:
                events.append((stack[-1], "<"))
                at = i + 1
                continue
            at = m.end()
            if m["data"] is not None:
                events.append((stack[-1], m["data"].replace("&", "&amp;")))
                continue
            tag = m["tag"] or m["tag2"]
            if tag is None:
                continue
            tag = tag.lower()
            if m["end"] or m["end2"]:
                if tag == "br":
                    events.append((stack[-1], " "))
                    continue
                k = len(stack) - 1
                while k > 0 and tags[stack[k]] != tag and not (tag in INLINE and tags[stack[k]] in SCOPE):
                    k -= 1
                if k > 0 and tags[stack[k]] == tag:
                    del stack[k:]
                if tag not in INLINE:
                    events.append((stack[-1], " "))
                continue
            attrs = m["attrs"] if m["tag"] else m["attrs2"]
            if head and tag not in IN_HEAD:
                del stack[stack.index(head) if head in stack else len(stack):]
                head = 0
            if tag in ENDS_P:
                k = len(stack) - 1
                while k > 0 and tags[stack[k]] != "p" and tags[stack[k]] not in SCOPE:
                    k -= 1
                if k > 0 and tags[stack[k]] == "p":
                    del stack[k:]
            if tag in CLOSES:
                ended, scope = CLOSES[tag]
                k = len(stack) - 1
                while k > 0 and tags[stack[k]] not in scope and tags[stack[k]] not in ended:
                    k -= 1
                while k > 0 and tags[stack[k]] in ended:
                    del stack[k:]
                    k -= 1
            if tag not in INLINE:
                events.append((stack[-1], " "))
            node = self._open(tag, stack[-1], attrs)
            if tag in VOID or attrs.endswith("/") and tag in ("svg", "path", "circle", "rect", "use"):
                continue
            if tag in RAW:
                m = re.compile("</" + re.escape(tag) + r"(?=[\s/>])[^>]*>", re.I).search(s, at)
                at = m.end() if m else n
                continue
            stack.append(node)
            if tag == "head":
                head = node
        for i in range(len(tags) - 1, 0, -1):
            p = self.parent[i]
            if self.end[i] > self.end[p]:
                self.end[p] = self.end[i]
        self.end[0] = len(tags)

    def _gone(self, own: list[int]) -> list[bool]:
        """Which nodes are taken out; see the module. `own` has the characters that stand in a node itself."""
        n, parent = self.size, self.parent
        gone = [False] * n
        for i in range(1, n):
            gone[i] = gone[parent[i]] or self.out[i]
        total = [0 if g else c for g, c in zip(gone, own)]
        free, prose, aside = total[:], [0] * n, [False] * n   # text beside named elements, but headings and links; in paragraphs
        for i in range(1, n):
            aside[i] = aside[parent[i]] or self.tag[i] in HEADINGS or self.tag[i] == "a"
            if aside[i]:
                free[i] = 0
        for i in range(n - 1, 0, -1):
            p = parent[i]
            if self.tag[i] == "p":
                prose[i] = total[i]
            total[p] += total[i]
            prose[p] += prose[i]
            free[p] += 0 if self.word_out[i] else free[i]
        inside, wrapper, most = [False] * n, [False] * n, [0] * n    # nothing else around; how many characters there are around
        inside[0], most[0] = not free[0], total[0]
        for i in range(1, n):
            p = parent[i]
            inside[i], most[i] = inside[p], most[p]
            if self.word_out[i]:
                wrapper[i] = inside[p] and not self.comments[i] and 2 * total[i] > most[p]
                inside[i], most[i] = wrapper[i] and not free[i], total[i]
        for i in range(1, n):   # adverts, comments and notices go first
            gone[i] = gone[parent[i]] or self.out[i] or self.always[i] and not wrapper[i]
        total = [0 if g else c for g, c in zip(gone, own)]
        marked, has_main, has_p = [w and not x for w, x in zip(self.word_out, wrapper)], [False] * n, False
        for i in range(1, n):
            marked[i] |= marked[parent[i]]
        for i in range(n - 1, 0, -1):
            has_main[i] |= self.tag[i] in MAIN and total[i] > 0
            has_main[parent[i]] |= has_main[i]
            has_p |= self.tag[i] == "p" and total[i] > 0 and not marked[i]
            total[parent[i]] += total[i]
        main_left = any(self.tag[i] in MAIN and total[i] and not marked[i] for i in range(1, n))
        for i in range(1, n):
            if self.word_out[i] and not self.always[i]:
                wrapper[i] |= 2 * total[i] > total[0] and not main_left and (has_main[i] or not has_p)
                wrapper[i] |= self.tag[i] == "form" and prose[i] >= LEAST_PROSE and 2 * prose[i] > total[0]
            gone[i] = gone[parent[i]] or self.out[i] or self.word_out[i] and not wrapper[i]
        return gone

    def text(self) -> str:
        """The main text; see the module."""
        n, parent, end = self.size, self.parent, self.end
        own = [0] * n
        for i, t in self.events:
            if t != " ":
                own[i] += len("".join(t.split()))
        gone = self._gone(own)
        chars, tags, link, links = [0 if g else c for g, c in zip(gone, own)], [0] * n, [0] * n, [0] * n
        for i in range(n - 1, 0, -1):
            if gone[i]:
                continue
            p = parent[i]
            if self.tag[i] == "a":
                link[i] = chars[i]
                links[i] += 1
            chars[p] += chars[i]
            tags[p] += tags[i] + 1
            link[p] += link[i]
            links[p] += links[i]
        body = next((i for i in range(n) if self.tag[i] == "body"), 0)
        if not chars[body]:
            body = 0
        if not chars[body]:
            return ""
        share = link[body] / chars[body]
        density = [0.0] * n
        for i in range(body, end[body]):
            c = chars[i]
            if not c or gone[i]:
                continue
            t, lc, lt = max(tags[i], 1), max(link[i], 1), max(links[i], 1)
            base = math.log(c / max(c - link[i], 1) * link[i] + share * c + math.e)
            density[i] = c / t * (math.log(max(c / lc * t / lt, 1.0) + 1) / math.log(base + 1))
        sums = [0.0] * n
        for i in range(body + 1, end[body]):
            sums[parent[i]] += density[i]
        best = max(range(body, end[body]), key=lambda i: (sums[i], -i))
        while best != body and self.tag[best] in PARAGRAPH:
            best = parent[best]
        main = [i for i in self._above(best) if self.tag[i] in MAIN and i >= body]
        if main:
            chosen = [main[-1]]
        else:
            path = [i for i in self._above(best) if i >= body]
            least = min([density[i] for i in path], default=0.0)
            chosen, on_path = [best], set(path)
            for p in path[1:]:
                i = p + 1
                while i < end[p]:
                    if i not in on_path and not gone[i] and density[i] >= least and link[i] <= MOST_LINKS * chars[i] \
                            and self.tag[i] not in INLINE:
                        chosen.append(i)
                    i = end[i]
        chosen = sorted((i, end[i]) for i in chosen)
        parts = [t for i, t in self.events if not gone[i] and any(a <= i < b for a, b in chosen)]
        return " ".join("".join(html.unescape(t) if "&" in t else t for t in parts).split())


def main_text(source: str | None) -> str:
    return Page(source).text() if source else ""


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        last = whole.num_columns - 1
        for at in range(0, whole.num_rows, 64):
            b = whole.slice(at, 64)
            texts = [main_text(s) for s in b.column(last).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:last], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             [*b.schema.names[:last], "text", "n_chars"])


def extracted(pages: DataFrame, page_id: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) per row."""
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(source).cast("string").alias("html"))
    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("page_id", "url"))
    return rows.mapInArrow(_texts, f"{kinds}, text string, n_chars long")


def op5_text_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(read(spark, sf_dir, "pages"))
