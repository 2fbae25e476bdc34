"""Pages as trees of blocks, and what can be measured on their nodes."""

import re
from collections import Counter
from functools import lru_cache
from html import unescape

import numpy as np

# fixed values: elements by the part they play
BLOCK = frozenset(
    "#root html body header footer nav aside main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody "
    "tfoot tr td th caption form fieldset legend label select option button blockquote pre figure figcaption address "
    "details summary dialog center menu hgroup search optgroup".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr keygen".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes svg math head".split())
FOREIGN = frozenset("svg math".split())  # complete where the start tag ends in a slash
CLOSES_P = BLOCK - frozenset("html body #root tr td th thead tbody tfoot caption option optgroup label select button legend".split())
# an element, those it closes when it begins, and those where the search for them ends
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}), "tfoot": ({"thead", "tbody"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
P_SCOPE = {"table", "td", "th", "caption", "button", "blockquote", "#root"}
# fixed values: attribute tokens by what they tend to mark
TOKENS = {
    "body": "article content post entry story body main text prose copy markdown richtext articlebody maincontent",
    "nav": "nav navbar navigation menu breadcrumb breadcrumbs pager pagination toc tabs toolbar sitemap links",
    "ad": "ad ads advert advertisement adslot sponsor sponsored promo promotion banner dfp outbrain taboola commercial",
    "notice": "notice cookie cookies consent gdpr alert warning popup modal overlay disclaimer announcement paywall toast",
    "comment": "comment comments reply replies respond discussion disqus feedback review reviews thread responses",
    "side": "sidebar side aside related recommended widget rail trending popular more also teaser secondary",
    "form": "form login signin signup register search subscribe subscription newsletter input checkout contact",
    "foot": "footer foot copyright legal colophon credits bottom contentinfo",
    "head": "header head masthead topbar logo branding site top hero",
    "share": "share sharing social follow tweet facebook twitter tags meta byline author",
}
GROUPS = {word: i for i, words in enumerate(TOKENS.values()) for word in words.split()}
KINDS = {
    tag: i
    for i, tags in enumerate((
        "nav menu", "header hgroup", "footer", "aside dialog", "form fieldset legend label select option button search",
        "article main", "section div center details", "p", "h1 h2 h3 h4 h5 h6", "ul ol dl", "li dt dd",
        "table thead tbody tfoot tr td th caption", "blockquote pre figure figcaption", "#text", "address summary",
    ))
    for tag in tags.split()
}
N_GROUPS, N_KINDS, N_ABOVE = len(TOKENS), max(KINDS.values()) + 1, 6
# a tag ends before the next "<" outside quotes, so that looking for its end costs no more than its length
TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^<>]*+>|</([a-zA-Z][^\s/<>]*+)[^<>]*+>|<([a-zA-Z][^\s/<>]*+)((?:[^<>"']++|"[^"]*+"|'[^']*+'|["'])*+)>""", re.S
)
DEEPEST = 512  # elements inside each other; what is deeper stands where the deepest one does
UNQUOTED = re.compile(r"""=\s*[^\s"'>]*/\Z""")  # a last slash that belongs to a value
MARKS = re.compile(r"""\b(?:class|id|role|aria-label|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
PIECES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
LONG = sorted((w for w in GROUPS if len(w) >= 5), key=len, reverse=True)
LABEL = re.compile(r'data-main="([01])"')


@lru_cache(maxsize=65536)
def groups_of(value: str) -> tuple[int, ...]:
    """The groups that an attribute's value names, in pieces or within words run together."""
    found = set()
    for piece in PIECES.findall(value):
        word = piece.lower()
        known = word if word in GROUPS else next((w for w in LONG if word.startswith(w) or word.endswith(w)), None)
        if known:
            found.add(GROUPS[known])
    return tuple(sorted(found))


class Page:
    """The blocks of one page in order: tag, parent, attributes; texts with the block they stand in.

    Any text is a page. Tags that never end are text; elements nested beyond ``DEEPEST``
    keep their text, but are no blocks of their own. The time is in proportion to the length.
    """

    def __init__(self, html: str):
        self.tag, self.parent, self.attrs = ["#root"], [-1], [""]
        self.inner, self.inputs = [0], [0]  # elements and form fields right inside
        self.texts: list[tuple[int, str, float]] = []  # node, text, part of it in links
        self._read(html)
        self._leaves()

    def _read(self, html: str) -> None:
        stack: list[tuple[str, int]] = [("#root", 0)]
        open_: dict[str, int] = {"#root": 1}
        buffer: list[str] = []
        linked = [0, 0]  # characters in links, and all

        def flush() -> None:
            text = " ".join(unescape("".join(buffer)).split())
            if text:
                self.texts.append((stack[-1][1], text, linked[0] / max(1, linked[1])))
            buffer.clear()
            linked[:] = 0, 0

        def pop_to(depth: int) -> None:
            if any(name in BLOCK for name, _ in stack[depth:]):
                flush()
            for name, _ in stack[depth:]:
                open_[name] -= 1
            del stack[depth:]

        def close(names: set[str], scope: set[str]) -> None:
            if any(open_.get(n) for n in names):
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth][0] in names:
                        pop_to(depth)
                        return
                    if stack[depth][0] in scope:
                        return

        endless: set[str] = set()  # elements whose end was looked for in vain; it is not further on either
        over: dict[str, int] = {}  # open elements that are too deep
        at = 0
        while found := TOKEN.search(html, at):
            if found.start() > at:
                piece = html[at : found.start()]
                buffer.append(piece)
                linked[1] += len(piece)
                if open_.get("a"):
                    linked[0] += len(piece)
            at = found.end()
            ended, name = (found[1] or "").lower(), (found[2] or "").lower()
            if ended:
                if ended == "br":
                    buffer.append(" ")
                elif over.get(ended):
                    over[ended] -= 1
                    if ended in BLOCK:
                        flush()
                elif open_.get(ended):
                    for depth in range(len(stack) - 1, 0, -1):
                        if stack[depth][0] == ended:
                            pop_to(depth)
                            break
                        if ended not in BLOCK and stack[depth][0] in BLOCK:
                            break
                continue
            if not name:
                continue
            here = stack[-1][1]
            if name in FOREIGN and found[3].endswith("/") and not UNQUOTED.search(found[3]):
                continue
            if name in RAW:
                end = None if name in endless else re.compile(rf"</{re.escape(name)}(?=[\s/>])[^<>]*+>", re.I).search(html, at)
                if not end:
                    endless.add(name)
                if name == "head" and not end:
                    end = None if "body" in endless else re.compile(r"<body\b", re.I).search(html, at)
                    if not end:
                        endless.add("body")
                    at = end.start() if end else at
                else:
                    at = end.end() if end else len(html)
                self.inputs[here] += name == "textarea"
            elif name in VOID:
                if name == "hr":
                    flush()
                buffer.append(" " if name == "br" else "")
                self.inputs[here] += name == "input"
                self.inner[here] += 1
            elif name in BLOCK:
                if name in ("html", "body"):
                    continue
                if len(stack) > DEEPEST:
                    flush()
                    self.inner[here] += 1
                    over[name] = over.get(name, 0) + 1
                    continue
                if name in CLOSES_P:
                    close({"p"}, P_SCOPE)
                if name in IMPLIED:
                    close(*IMPLIED[name])
                flush()
                self.tag.append(name)
                self.parent.append(stack[-1][1])
                self.attrs.append(found[3] or "")
                self.inner.append(0)
                self.inputs.append(0)
                stack.append((name, len(self.tag) - 1))
                open_[name] = open_.get(name, 0) + 1
            else:
                if name == "a" and open_.get("a"):
                    close({"a"}, BLOCK)
                self.inner[here] += 1
                if len(stack) > DEEPEST:
                    over[name] = over.get(name, 0) + 1
                    continue
                stack.append((name, here))
                open_[name] = open_.get(name, 0) + 1
        if at < len(html):
            buffer.append(html[at:])
            linked[1] += len(html) - at
        pop_to(1)
        flush()

    def _leaves(self) -> None:
        """Texts that stand beside blocks become nodes of their own."""
        mixed = set(self.parent)
        texts = []
        for node, text, linked in self.texts:
            if node in mixed:
                self.tag.append("#text")
                self.parent.append(node)
                self.attrs.append("")
                self.inner.append(0)
                self.inputs.append(0)
                node = len(self.tag) - 1
            texts.append((node, text, linked))
        self.texts = texts

    def features(self) -> np.ndarray:
        """One row a node: size, density, links, place among siblings, tokens and kinds, its own and above."""
        n = len(self.tag)
        # parents come before their children, except that leaves of text were added last
        depth, groups, kinds = [0] * n, [0] * n, [0] * n
        own = np.zeros((n, 8))  # characters, in links, sentence ends, texts, elements, fields, paragraphs, words
        own[:, 4] = self.inner
        own[:, 4] += 1
        own[:, 5] = self.inputs
        for node, text, linked in self.texts:
            row = own[node]
            row[0] += len(text)
            row[1] += linked * len(text)
            row[2] += text.count(".") + text.count("!") + text.count("?")
            row[3] += 1
            row[7] += text.count(" ") + 1
        children: list[list[int]] = [[] for _ in range(n)]
        x = np.zeros((n, 17 + 2 * N_GROUPS + N_KINDS + N_ABOVE))
        for i in range(n):
            up, kind = self.parent[i], KINDS.get(self.tag[i], 6)
            marks = np.zeros(N_GROUPS)
            if self.attrs[i]:
                for found in MARKS.finditer(self.attrs[i]):
                    for g in groups_of(found[1] or found[2] or found[3] or ""):
                        marks[g] = 1
            x[i, 17 : 17 + N_GROUPS] = marks
            x[i, 17 + 2 * N_GROUPS + kind] = 1
            own[i, 6] = kind == 7
            if up >= 0:
                children[up].append(i)
                depth[i] = depth[up] + 1
                a = 17 + N_GROUPS
                x[i, a : a + N_GROUPS] = np.maximum(x[up, a : a + N_GROUPS], x[up, 17 : 17 + N_GROUPS])
                b = 17 + 2 * N_GROUPS
                x[i, b + N_KINDS :] = np.maximum(x[up, b + N_KINDS :], x[up, b : b + N_ABOVE])
        total = own.copy()
        order = sorted(range(1, n), key=lambda i: -depth[i])
        for i in order:
            total[self.parent[i]] += total[i]
        chars, linked, ends, texts, tags, fields, paragraphs, words = total.T
        x[:, 0] = depth
        x[:, 1] = np.log1p(chars)
        x[:, 2] = np.log1p(tags)
        x[:, 3] = np.log1p(chars / tags)
        x[:, 4] = linked / np.maximum(chars, 1)
        x[:, 5] = 100 * ends / np.maximum(chars, 1)
        x[:, 6] = np.log1p(words / np.maximum(texts, 1))
        x[:, 7] = np.minimum(fields, 5)
        x[:, 14] = np.log1p(paragraphs)
        x[:, 15] = chars / max(1.0, chars[0])
        for up, kids in enumerate(children):
            if not kids:
                continue
            k = len(kids)
            sizes = np.log1p(chars[kids])
            same = [self.tag[i] for i in kids]
            count = Counter(same)
            x[kids, 8] = np.arange(k) / k
            x[kids, 9] = np.log1p(k)
            x[kids, 10] = [count[t] / k for t in same]
            x[kids, 11] = chars[kids] / max(1.0, chars[up])
            x[kids, 12] = np.concatenate([[0], sizes[:-1]])
            x[kids, 13] = np.concatenate([sizes[1:], [0]])
            x[kids, 16] = x[up, 3]
        return x

    def labels(self) -> np.ndarray:
        """1 for nodes that hold main text, by the marks that made pages carry; -1 for those without any text."""
        own = [None] * len(self.tag)
        for i, attrs in enumerate(self.attrs):
            mark = LABEL.search(attrs)
            own[i] = mark[1] == "1" if mark else (own[self.parent[i]] if i else False)
        found = np.full(len(self.tag), -1)
        for node, _, _ in self.texts:
            while node >= 0:
                found[node] = max(found[node], int(own[node] if self.tag[node] != "#text" else own[self.parent[node]]), 0)
                if own[node] and found[node] == 1:
                    up = self.parent[node]
                    while up >= 0 and found[up] != 1:
                        found[up] = 1
                        up = self.parent[up]
                node = self.parent[node]
        return found
