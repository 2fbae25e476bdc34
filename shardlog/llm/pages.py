"""Main text of web pages: boosted trees judge the nodes of a page, and a tree-wide decoding settles them.

The trees are fitted here, on pages made from the corpus's own paragraphs: known parts
(article, menu, advert, comments and so on) are put together under many different tags,
attribute names and orders, so which node holds main text is known.
"""

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardlog.llm.common import lowest, text_of
from shardlog.llm.dom import TOKENS, Page

SAMPLE = 300  # pages whose paragraphs the made pages are built from, at most
PARAGRAPHS = 40  # taken from one of them, each cut to LONGEST characters
LONGEST = 1500
MADE = 1600  # pages made
PAGES_AT_ONCE, BYTES_AT_ONCE = 500, 8 << 20  # read by a task, the latter unless one page has more
TREES, DEPTH, RATE, BINS, LEAST = 120, 5, 0.2, 32, 5
PART = 0.4  # of the features, tried by a tree


# fixed values: tags that tell a part without any attribute
MEANT = {"nav": ("nav",), "side": ("aside",), "foot": ("footer",), "head": ("header",), "form": ("form",), "body": ("article", "main")}


def _cuts(values: np.ndarray) -> np.ndarray:
    """Where bins meet: between the values if they are few, else at their quantiles, so rare marks keep a bin."""
    own = np.unique(values)
    return (own[1:] + own[:-1]) / 2 if len(own) <= BINS else np.unique(np.quantile(values, np.linspace(0, 1, BINS + 1)[1:-1]))


class Boosted:
    """Gradient-boosted trees of one depth for a yes-or-no answer, grown level by level on histograms."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        k = x.shape[1]
        self.cuts = [_cuts(x[:, j]) for j in range(k)]
        binned = self._bins(x)
        share = (y.sum() + 1) / (len(y) + 2)
        self.base = float(np.log(share / (1 - share)))
        inner, leaves = (1 << DEPTH) - 1, 1 << DEPTH
        self.feature, self.cut = np.zeros((TREES, inner), np.int64), np.full((TREES, inner), BINS)
        self.value = np.zeros((TREES, leaves))
        z, rng = np.full(len(y), self.base), np.random.default_rng(11)
        for tree in range(TREES):
            tried = np.flatnonzero(rng.random(k) < PART)
            p = 1 / (1 + np.exp(-z))
            g, h, place = y - p, p * (1 - p), np.zeros(len(y), np.int64)
            for level in range(DEPTH):
                self._grow(tree, level, binned, g, h, place, tried)
                place = self._down(tree, level, binned, place)
            sums = [np.bincount(place, w, minlength=leaves) for w in (g, h)]
            self.value[tree] = RATE * sums[0] / (sums[1] + 1)
            z += self.value[tree][place]

    def _bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(self.cuts)], axis=1).astype(np.int64)

    def _grow(self, tree, level, binned, g, h, place, tried) -> None:
        nodes, first = 1 << level, (1 << level) - 1
        best = np.full(nodes, 1e-6)
        for j in tried:
            at = place * BINS + binned[:, j]
            left = [np.cumsum(np.bincount(at, w, minlength=nodes * BINS).reshape(nodes, BINS), axis=1) for w in (g, h, None)]
            (gl, hl, nl), (ga, ha, na) = left, (c[:, -1:] for c in left)
            gain = gl**2 / (hl + 1) + (ga - gl) ** 2 / (ha - hl + 1) - ga**2 / (ha + 1)
            gain = np.where((nl >= LEAST) & (na - nl >= LEAST), gain, 0.0)
            cut = gain.argmax(axis=1)
            found = gain[np.arange(nodes), cut]
            better = found > best
            best = np.where(better, found, best)
            self.feature[tree, first : first + nodes][better] = j
            self.cut[tree, first : first + nodes][better] = cut[better]

    def _down(self, tree, level, binned, place) -> np.ndarray:
        node = (1 << level) - 1 + place
        right = binned[np.arange(len(place)), self.feature[tree, node]] > self.cut[tree, node]
        return 2 * place + right

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """The log odds of each row."""
        if not len(x):
            return np.zeros(0)
        binned, z = self._bins(x), np.full(len(x), self.base)
        for tree in range(TREES):
            place = np.zeros(len(x), np.int64)
            for level in range(DEPTH):
                place = self._down(tree, level, binned, place)
            z += self.value[tree][place]
        return z


def made_page(rng: random.Random, material: list[list[str]]) -> str:
    """A page of known parts: main text under ``data-main="1"``, all else under ``data-main="0"``."""

    def marked(kind: str, tags: str, often: float = 0.85) -> tuple[str, str]:
        tag = rng.choice(tags.split())
        words = TOKENS[kind].split()
        name = rng.choice(["", "", "site-", "page-", "x_"]) + rng.choice(words) + rng.choice(["", "", "", "-box", "-wrap", "2"])
        if tag in MEANT.get(kind, ()):  # the tag says it all
            often = 0.4
        attrs = f' {rng.choice(["class", "id", "class", "role"])}="{name}"' if rng.random() < often else ""
        return tag, attrs

    def sentence(short: bool = True) -> str:
        text = rng.choice(rng.choice(material))
        return " ".join(text.split()[: rng.choice([1, 2, 4, 8, 14])]) if short else text

    def links(n: int) -> str:
        items = [f'<a href="/{i}">{sentence()}</a>' if rng.random() < 0.5 else f'<a href="/{i}">{sentence().split(" ")[0]}</a>' for i in range(n)]
        form = rng.random()
        if form < 0.6:
            return "<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>"
        return " | ".join(items) if form < 0.8 else "".join(f"<div>{i}</div>" for i in items)

    def aside(kind: str) -> str:
        if kind in ("nav", "share"):
            tag, attrs = marked(kind, "nav div ul section" if kind == "nav" else "div ul section", 0.8)
            attrs = attrs or (f' class="{kind}"' if tag != "nav" else "")
            body = links(rng.randint(2, 9)) if rng.random() < 0.8 else sentence()
        elif kind == "form":
            tag, attrs = marked(kind, "form form div section")
            body = f"<label>{sentence()}</label><input name=q><button>{sentence()}</button>" + (f"<p>{sentence()}</p>" if rng.random() < 0.6 else "")
            body = body if tag == "form" else f"<form>{body}</form>"
        elif kind == "comment":
            tag, attrs = marked(kind, "div section ol ul", 1.0)
            each = [rng.choice(["<p>{}</p>", "{}"]).format(sentence(rng.random() < 0.3)) for _ in range(rng.randint(1, 6))]
            inner, ia = ("li", "") if tag in ("ol", "ul") else marked(kind, "div article div", 0.7)
            body = (f"<h3>{sentence()}</h3>" if rng.random() < 0.6 and tag not in ("ol", "ul") else "") + "".join(f"<{inner}{ia}>{c}</{inner}>" for c in each)
        elif kind == "side":
            tag, attrs = marked(kind, "aside div section")
            attrs = attrs or (' class="sidebar"' if tag != "aside" else "")
            body = rng.choice([f"<h4>{sentence()}</h4>", ""]) + rng.choice([links(rng.randint(2, 7)), f"<p>{sentence(False)}</p>", sentence(False), f"<p>{sentence()}</p>"])
        elif kind == "foot":
            tag, attrs = marked(kind, "footer footer div")
            attrs = attrs or (' class="footer"' if tag != "footer" else "")
            body = rng.choice(["&copy; ", "", "(c) "]) + sentence() + rng.choice(["", f"<p>{sentence(False)}</p>", links(3), "\n" + sentence()])
        elif kind == "head":
            tag, attrs = marked(kind, "header header div")
            attrs = attrs or (' class="header"' if tag != "header" else "")
            body = rng.choice([sentence(), f"<p>{sentence()}</p>", f"<h1>{sentence()}</h1><p>{sentence(False)}</p>", f"<h1>{sentence()}</h1>", f"<div>{sentence()}</div>"]) + rng.choice(["", links(4)])
        else:  # adverts and notices
            tag, attrs = marked(kind, "div div section p aside", 1.0)
            text = sentence(rng.random() < 0.4)
            body = text if tag == "p" else rng.choice([text, f"<p>{text}</p>", f"{text}<a href=x>{sentence()}</a>", f"<p>{text}</p><button>{sentence()}</button>"])
        return f'<{tag}{attrs} data-main="0">{body}</{tag}>'

    def some(kinds: str, most: int) -> list[str]:
        return [aside(rng.choice(kinds.split())) for _ in range(rng.randint(0, most))]

    parts = []
    texts = rng.choice(material)[: rng.choice([1, 1, 2, 3, 5, PARAGRAPHS])]
    if rng.random() < 0.15:
        texts = [sentence() for _ in texts[:3]]
    plain = rng.random() < 0.4
    for text in texts:
        form = rng.random() * (0.8 if plain else 1)
        if form < 0.80:
            parts.append(f"<p>{text}</p>" if rng.random() < 0.8 else f"<p><b>{text}<br>")
        elif form < 0.85:
            parts.append("<ul>" + "".join(f"<li>{sentence()}</li>" for _ in range(rng.randint(1, 5))) + "</ul>")
        elif form < 0.88:
            parts.append(f"<blockquote>{rng.choice([text, f'<p>{text}</p>'])}</blockquote>")
        elif form < 0.91:
            parts.append("<table>" + "".join(f"<tr><td>{sentence()}</td><td>{sentence()}</td></tr>" for _ in range(rng.randint(1, 4))) + "</table>")
        elif form < 0.95:
            parts.append(f"<h2>{sentence()}</h2><p>{text}</p>")
        elif form < 0.97:
            parts.append(f"<figure><img src=x><figcaption>{sentence()}</figcaption></figure>")
        else:
            parts.append(rng.choice([f"<div>{text}</div>", f"<p>{text} <a href=y>{sentence()}</a> {sentence()}</p>", f"<section><h3>{sentence()}</h3><p>{text}</p></section>"]))
    for extra in some("ad ad share notice side side form nav comment head foot", 0 if plain else 3):
        parts.insert(rng.randint(0, len(parts)), extra)
    if rng.random() < 0.75:
        title = " ".join(texts[0].split()[:12]) if rng.random() < 0.5 else sentence()
        parts.insert(0, f"<h1>{title}</h1>")
    tag, attrs = marked("body", "article article main div div section", 0.6)
    main = f'<{tag}{attrs} data-main="1">{"".join(parts)}{aside("comment") if rng.random() < 0.2 else ""}</{tag}>'
    if rng.random() < 0.3:
        outer, more = marked("body", "div main section", 0.5)
        main = f"<{outer}{more}>{main}{''.join(some('side ad comment share', 2))}</{outer}>"
    before = some("nav head notice ad side form", 4)
    after = some("foot comment side ad form notice nav share", 4)
    whole = "".join(before) + main + "".join(after)
    return f"<html><body>{whole if rng.random() < 0.7 else f'<div>{whole}</div>'}</body></html>"


def fitted(material: list[list[str]], seed: int = 7) -> Boosted:
    """Trees fitted on ``MADE`` pages from ``material``, the paragraphs of some pages."""
    rng = random.Random(seed)
    pages = [Page(made_page(rng, material)) for _ in range(MADE)]
    y = np.concatenate([p.labels() for p in pages])
    x = np.concatenate([p.features() for p in pages])
    return Boosted(x[y >= 0], y[y >= 0].astype(float))


def decoded(page: Page, odds: np.ndarray) -> list[bool]:
    """Which nodes stay: the likeliest choice in which whatever is under a dropped node goes too.

    And a node that has others below it only stays with at least one of them.
    """
    n = len(page.tag)
    keep, drop = -np.logaddexp(0, -odds), -np.logaddexp(0, odds)
    children: list[list[int]] = [[] for _ in range(n)]
    depth = [0] * n
    for i in range(1, n):
        children[page.parent[i]].append(i)
        depth[i] = depth[page.parent[i]] + 1
    holds = [False] * n
    for node, _, _ in page.texts:
        while node >= 0 and not holds[node]:
            holds[node] = True
            node = page.parent[node]
    stay, gone = np.zeros(n), np.zeros(n)
    chosen: list[list[int]] = [[] for _ in range(n)]
    for i in sorted(range(n), key=lambda i: -depth[i]):
        kids = [c for c in children[i] if holds[c]]
        gone[i] = drop[i] + sum(gone[c] for c in kids)
        chosen[i] = [c for c in kids if stay[c] > gone[c]]
        if kids and not chosen[i]:
            chosen[i] = [max(kids, key=lambda c: stay[c] - gone[c])]
        taken = set(chosen[i])
        stay[i] = keep[i] + sum(stay[c] if c in taken else gone[c] for c in kids)
    kept, todo = [False] * n, [0] if holds[0] and (stay[0] > gone[0]) else []
    while todo:
        kept[i := todo.pop()] = True
        todo.extend(chosen[i])
    return kept


def main_text(page: Page, odds: np.ndarray) -> str:
    kept = decoded(page, odds)
    return "\n\n".join(text for node, text, _ in page.texts if kept[node])


def paragraphs(html: str) -> list[str]:
    texts = [t[:LONGEST].replace("<", " ").replace("&", " ") for _, t, linked in Page(html).texts if linked < 0.5]
    return texts[:PARAGRAPHS]


def _stretches(column: pa.Array) -> Iterator[tuple[int, int]]:
    """Where some pages of a column begin and how many they are: ``PAGES_AT_ONCE``, or fewer long ones."""
    ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(column), 0), np.int64))
    start = 0
    while start < len(column):
        before = ends[start - 1] if start else 0
        end = int(np.searchsorted(ends, before + BYTES_AT_ONCE, side="right"))
        end = max(start + 1, min(end, start + PAGES_AT_ONCE))
        yield start, end - start
        start = end


def extracted(pages: DataFrame, html: str = "html", url: str = "url", key: str = "page_id") -> DataFrame:
    """One row a page: ``page_id``, ``url``, ``text``, ``n_chars``.

    Null html counts as empty and has an empty text. The sample that made pages are built
    from is ``SAMPLE`` pages, those with the smallest hashes of their numbers and html, in
    pieces of bounded length; every page is read whole, some megabytes of pages at a time.
    Repeated rows are read each.
    """
    rows = pages.select(pages[key].alias("page_id"), pages[url].alias("url"), text_of(pages[html]).alias("html"))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [paragraphs(h.as_py()) for h in batch.column("html")]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.string()))], names=["pieces"])

    # equal pages count once, and are taken together where they lie; what meets in one task are hashes only
    hashed = rows.select("html", F.xxhash64("page_id", "html").alias("h"))
    chosen = lowest(hashed.select("h").distinct(), SAMPLE, "h")
    some = hashed.join(F.broadcast(chosen), "h").groupBy("h").agg(F.min("html").alias("html")).select("html")
    material = sorted(r.pieces for r in some.mapInArrow(pieces, "pieces array<string>").collect() if r.pieces)
    model = fitted(material or [["text"]])
    schema = T.StructType([rows.schema["page_id"], rows.schema["url"]]).add("text", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, n in _stretches(batch.column("html")):
                part = batch.slice(start, n)
                read = [Page(h.as_py()) for h in part.column("html")]
                odds = model(np.concatenate([p.features() for p in read]))
                ends = np.cumsum([len(p.tag) for p in read])[:-1]
                texts = [main_text(p, o) for p, o in zip(read, np.split(odds, ends), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"]
                )

    texts = rows.mapInArrow(run, schema)
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
