"""HTML extraction: a linear-chain conditional random field over DOM leaf blocks.

A page is a chain of blocks, each content or boilerplate. A block's features
are its ancestors' tags, pairs of nested tags and class, id and role words,
and properties of its text (length, share of links, punctuation, place). The
transition weights depend on how two blocks lie to each other (same element,
like or unlike children of one parent, or neither). The field
is trained with numpy on labelled pages and decoded by Viterbi; the main text
is the content blocks in page order.

The labelled pages are written by :func:`labelled_pages` from page layouts: a
random page is put together from an article and the furniture around and
inside it, and every block knows which of the two it belongs to. The text is
random syllables, so no language is learned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatehouse.llm.html_blocks import ROOT, Block, blocks

PAGES = 500             # labelled pages written for training
EPOCHS = 7
BONDS = 4
SEED = 5
MARK = "\u2063"         # marks the content blocks of a labelled page

# Words that class, id and role attributes use, by what they stand for.
CONTENT_NAMES = "content article post entry story main body text page news blog single hentry prose document".split()
FURNITURE = {
    "header": "header masthead top branding logo site banner tagline".split(),
    "nav": "nav menu navigation navbar breadcrumb breadcrumbs links topnav tabs toc pagination pager".split(),
    "aside": "sidebar aside side rail widget related recommended popular trending recent archive tags more".split(),
    "footer": "footer bottom copyright legal colophon credits sitemap".split(),
    "notice": "notice cookie cookies consent alert message gdpr banner popup modal overlay privacy warning".split(),
    "ad": "ad ads advert advertisement sponsored sponsor promo promotion banner adsense commercial".split(),
    "form": "form newsletter subscribe signup search login contact subscription email".split(),
    "comments": "comment comments reply replies discussion responses respond thread disqus reviews feedback".split(),
    "share": "share social sharing buttons follow author bio byline meta".split(),
}
NEUTRAL = "wrapper container inner row col box block section clearfix layout grid left right center x item".split()


# ---------------------------------------------------------------- features

def features(found: list[Block]) -> list[list[str]]:
    """The feature names of each block of a page."""
    out = []
    n = len(found)
    title = next((i for i, b in enumerate(found) if b.leaf and b.leaf.tag == "h1"), None)
    around: dict[int, set[str]] = {}                # by element: what its blocks have in common
    for i, b in enumerate(found):
        e = b.leaf or ROOT
        base = around.get(id(e))
        if base is None:
            base = {"bias", "tag:" + (e.own or "body"), "outer:" + (e.outer or "body"), "depth:%d" % min(8, e.depth)}
            base.update("in:" + t for t in e.inside)
            base.update("pair:" + p for p in e.pairs)
            base.update("name:" + w for w in e.names)
            if e.hidden:
                base.add("hidden")
            around = {id(e): base}
        f = set(base)
        words = b.text.count(" ") + 1
        f.add("words:%d" % min(6, words.bit_length()))
        share = b.link_chars / len(b.text)
        f.add("links:%d" % (0 if share == 0 else 1 if share < 0.34 else 2 if share < 0.9 else 3))
        if b.text[-1] in ".!?…。":
            f.add("sentence")
        if "©" in b.text:
            f.add("copyright")
        f.add("third:%d" % (3 * i // n))
        f.add("title:" + ("none" if title is None else "before" if i < title else "at" if i == title else "after"))
        out.append(sorted(f))
    return out


def bonds(found: list[Block]) -> np.ndarray:
    """For each pair of neighbours: 0 other parents, 1 alike elements of one parent, 2 the same
    element, 3 unlike elements of one parent (by tag or names)."""
    out = []
    for a, b in zip(found, found[1:]):
        ea, eb = a.leaf, b.leaf
        if ea is eb:
            out.append(2)
        elif ea is None or eb is None or ea.parent is not eb.parent:
            out.append(0)
        else:
            out.append(1 if (ea.tag, ea.words) == (eb.tag, eb.words) else 3)
    return np.array(out, np.int64)


# ---------------------------------------------------------------- the field

class ChainCRF:
    """Two labels; one weight for each feature (towards content) and a 2 x 2 table for each kind of bond."""

    def __init__(self):
        self.index: dict[str, int] = {}
        self.weight = np.zeros(0)
        self.move = np.zeros((BONDS, 2, 2))

    def known_names(self) -> set[str]:
        """The class, id and role words that have a weight."""
        return {f[5:] for f in self.index if f.startswith("name:")}

    def encode(self, names: list[list[str]], learn: bool = False) -> list[np.ndarray]:
        if learn:
            for f in names:
                for x in f:
                    self.index.setdefault(x, len(self.index))
        get = self.index.get
        return [np.array([k for k in map(get, f) if k is not None], np.int64) for f in names]

    def potentials(self, enc: list[np.ndarray]) -> np.ndarray:
        u = np.zeros((len(enc), 2))
        u[:, 1] = [self.weight[e].sum() for e in enc]
        return u

    def marginals(self, u: np.ndarray, bond: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Posterior of each block's label and of each neighbouring pair (forward-backward)."""
        n = len(u)
        move = self.move[bond]
        a, b = np.zeros((n, 2)), np.zeros((n, 2))
        a[0] = u[0]
        for i in range(1, n):
            s = a[i - 1][:, None] + move[i - 1]
            a[i] = u[i] + np.logaddexp(s[0], s[1])
        for i in range(n - 2, -1, -1):
            s = move[i] + (u[i + 1] + b[i + 1])
            b[i] = np.logaddexp(s[:, 0], s[:, 1])
        z = np.logaddexp(*a[-1])
        pair = np.exp(a[:-1, :, None] + move + (u[1:] + b[1:])[:, None, :] - z)
        return np.exp(a + b - z), pair

    def fit(self, pages: list[tuple[list[Block], np.ndarray]], epochs: int = EPOCHS, seed: int = SEED) -> None:
        """Adagrad on the conditional log-likelihood with an L2 penalty."""
        data = [(self.encode(features(f), learn=True), bonds(f), y) for f, y in pages if f]
        self.weight = np.zeros(len(self.index))
        gw, gm = np.full(len(self.index), 1e-3), np.full((BONDS, 2, 2), 1e-3)
        rng = np.random.default_rng(seed)
        for _ in range(epochs):
            for k in rng.permutation(len(data)):
                enc, bond, y = data[k]
                post, pair = self.marginals(self.potentials(enc), bond)
                d = post[:, 1] - y
                flat = np.concatenate(enc)
                rows, back = np.unique(flat, return_inverse=True)
                g = np.zeros(len(rows))
                np.add.at(g, back, np.repeat(d, [len(e) for e in enc]))
                g += 2e-3 * self.weight[rows]
                gw[rows] += g * g
                self.weight[rows] -= 0.2 * g / np.sqrt(gw[rows])
                if len(bond):
                    true = np.zeros_like(pair)
                    true[np.arange(len(bond)), y[:-1], y[1:]] = 1
                    m = 2e-3 * self.move
                    np.add.at(m, bond, pair - true)
                    gm += m * m
                    self.move -= 0.2 * m / np.sqrt(gm)

    def viterbi(self, found: list[Block]) -> np.ndarray:
        """The most probable labels of a page's blocks."""
        n = len(found)
        if not n:
            return np.zeros(0, np.int64)
        u = [self.weight[e].sum() for e in self.encode(features(found))]
        move = self.move[bonds(found)].tolist()
        s0, s1, back = 0.0, float(u[0]), []
        for x, ((m00, m01), (m10, m11)) in zip(u[1:], move):
            to0, to1 = s1 + m10 > s0 + m00, s1 + m11 > s0 + m01
            back.append((to0, to1))
            s0, s1 = (s1 + m10 if to0 else s0 + m00), (s1 + m11 if to1 else s0 + m01) + float(x)
        out = np.zeros(n, np.int64)
        out[-1] = s1 > s0
        for i in range(n - 2, -1, -1):
            out[i] = back[i][out[i + 1]]
        return out


# ---------------------------------------------------------------- labelled pages

class Writer:
    """Writes one random page; content blocks begin with ``MARK``."""

    SYLLABLES = "ba ce di fo gu ka le mi no pu ra se ti vo zu an el is or un".split()

    def __init__(self, seed: int):
        self.r = np.random.default_rng(seed)

    def pick(self, *items):
        return items[int(self.r.integers(len(items)))]

    def chance(self, p: float) -> bool:
        return bool(self.r.random() < p)

    def text(self, low: int, high: int, stop: float = 0.9) -> str:
        n = int(np.exp(self.r.uniform(np.log(low), np.log(high + 1))))
        ws = ["".join(self.r.choice(self.SYLLABLES, int(self.r.integers(1, 4)))) for _ in range(max(1, n))]
        return " ".join(ws).capitalize() + ("." if self.chance(stop) else "")

    def named(self, words: list[str], p: float) -> str:
        """An attribute with one of ``words``, at times among neutral ones, or none at all."""
        if not self.chance(p):
            return f' class="{self.pick(*NEUTRAL)}"' if self.chance(0.3) else ""
        name = self.pick(*words)
        if self.chance(0.3):
            name = self.pick(f"{name}-{self.pick(*NEUTRAL)}", f"{self.pick(*NEUTRAL)}_{name}", f"{name} {self.pick(*NEUTRAL)}")
        return f' {self.pick("class", "class", "id")}="{name}"'

    def links(self, low: int, high: int) -> str:
        items = [f'<a href="#">{self.text(1, 4, 0.1)}</a>' for _ in range(int(self.r.integers(low, high)))]
        if self.chance(0.7):
            return "<ul>" + "".join(f"<li>{a}" + ("</li>" if self.chance(0.8) else "") for a in items) + "</ul>"
        return self.pick(" | ", " ", "<br>").join(items)

    def prose(self, mark: str, low: int = 1, high: int = 90) -> str:
        t = mark + self.text(low, high)
        if self.chance(0.25):
            t += f' <a href="#">{self.text(1, 5, 0.2)}</a> {self.text(1, 20)}'
        if self.chance(0.15):
            t = f"<b>{t}" + ("</b>" if self.chance(0.5) else "")
        return t

    def body(self) -> list[str]:
        """The blocks of an article."""
        out = []
        if self.chance(0.85):
            h = f"<h1>{MARK}{self.text(1, 14, 0.4)}</h1>"
            out.append(f"<header>{h}</header>" if self.chance(0.12) else h)
        plain = self.pick("p", "p", "p", "div")
        for _ in range(int(self.r.integers(1, 14))):
            kind = self.r.random()
            if kind < 0.72:
                out.append(f"<{plain}>{self.prose(MARK)}" + (f"</{plain}>" if plain == "div" or self.chance(0.9) else ""))
            elif kind < 0.8:
                out.append(f"<h{self.pick(2, 3)}>{MARK}{self.text(1, 9, 0.2)}</h{self.pick(2, 3)}>")
            elif kind < 0.87:
                items = "".join(f"<li>{self.prose(MARK, 1, 25)}</li>" for _ in range(int(self.r.integers(1, 6))))
                out.append(f"<{(t := self.pick('ul', 'ol'))}>{items}</{t}>")
            elif kind < 0.9:
                out.append(f"<blockquote><p>{self.prose(MARK)}</p></blockquote>")
            elif kind < 0.92:
                out.append(f"<figure><figcaption>{MARK}{self.text(2, 15)}</figcaption></figure>")
            elif kind < 0.96:
                wide = int(self.r.integers(2, 5))
                rows = ("".join(f"<td>{MARK}{self.text(1, 6, 0.2)}</td>" for _ in range(wide)) for _ in range(int(self.r.integers(1, 5))))
                out.append("<table>" + "".join(f"<tr>{cells}</tr>" for cells in rows) + "</table>")
                if self.chance(0.6):            # what stands under a table
                    out.append(f"<p>{MARK}{self.text(1, 8)}</p>")
            else:
                out.append(f"<pre>{MARK}{self.text(3, 30)}</pre>")
        return out

    def furniture(self, kind: str) -> str:
        names = FURNITURE[kind]
        tag = {"header": "header", "nav": "nav", "aside": "aside", "footer": "footer", "form": "form",
               "comments": "section"}.get(kind, "div")
        real = self.chance(0.6) or tag == "div"
        attr = self.named(names, 0.9 if not real or tag in ("div", "section") else 0.4)
        if tag in ("div", "section") and "class" not in attr and "id" not in attr:
            attr = f' class="{self.pick(*names)}"'
        if not real:
            tag = "div"
            attr = f' {self.pick("class", "id")}="{self.pick(*names)}"'
        if kind == "nav":
            inner = self.links(2, 9)
        elif kind == "header":
            inner = self.pick(f'<a href="/">{self.text(1, 3, 0)}</a>', f"<h1>{self.text(1, 4, 0.1)}</h1>", f"<div>{self.text(1, 4, 0)}</div>")
            inner += self.pick("", f"<p>{self.text(2, 10)}</p>", self.links(2, 7))
        elif kind == "footer":
            inner = self.pick(f"&copy; {self.text(1, 12)}", f"<p>&copy; {self.text(1, 20)}</p>", f"<p>{self.text(2, 30)}</p>", self.text(2, 30))
            inner += self.pick("", self.links(2, 7))
        elif kind == "aside":
            inner = f"<h{self.pick(2, 3, 4)}>{self.text(1, 4, 0.1)}</h3>" + self.pick(self.links(2, 8), f"<p>{self.text(3, 40)}</p>", f"<p>{self.text(3, 25)}</p>" + self.links(2, 5))
        elif kind == "notice":
            inner = self.pick(f"<p>{self.text(4, 30)}</p>", self.text(4, 30)) + self.pick("", "<button>Ok</button>", f'<a href="#">{self.text(1, 2, 0)}</a>')
        elif kind == "ad":
            inner = self.pick(self.text(2, 20), f"<p>{self.text(2, 25)}</p>", f'<a href="#">{self.text(2, 9)}</a>')
        elif kind == "form":
            inner = f"<label>{self.text(1, 4, 0.1)}</label><input name=q>" + self.pick("", f"<p>{self.text(3, 20)}</p>")
            inner += self.pick("", "<select><option>" + self.text(1, 2, 0) + "<option>" + self.text(1, 2, 0) + "</select>")
            inner += f"<button>{self.text(1, 2, 0)}</button>"
        elif kind == "comments":
            one = self.pick("div", "li", "article")
            inner = f"<h3>{self.text(1, 4, 0.2)}</h3>" + "".join(
                f'<{one} class="comment"><{self.pick("b", "div")}>{self.text(1, 3, 0)}</div><p>{self.text(2, 60)}</p></{one}>'
                for _ in range(int(self.r.integers(1, 6))))
        else:
            inner = self.pick(self.links(2, 5), f"<p>{self.text(2, 9, 0.3)}</p>", f"<span>{self.text(1, 5, 0.2)}</span>")
        return f"<{tag}{attr}>{inner}</{tag}>"

    def page(self) -> str:
        body = self.body()
        for kind, p in (("ad", 0.4), ("share", 0.25), ("aside", 0.2), ("form", 0.2), ("notice", 0.2), ("nav", 0.1)):
            if self.chance(p):
                body.insert(int(self.r.integers(0, len(body) + 1)), self.furniture(kind))
        if self.chance(0.25):
            body.append(self.furniture("comments"))
        holder = self.pick("article", "article", "article", "main", "div", "div", "section", "td", "")
        if holder == "td":
            main = "<table><tr>" + (f"<td>{self.links(2, 6)}</td>" if self.chance(0.6) else "") + "<td>" + "".join(body) + "</td></tr></table>"
        elif holder:
            attr = self.named(CONTENT_NAMES, 0.85 if holder in ("div", "section") else 0.3)
            main = f"<{holder}{attr}>" + "".join(body) + f"</{holder}>"
        else:
            main = "".join(body)
        if self.chance(0.3):
            t = self.pick("div", "main", "section")
            main = f"<{t}{self.named([*CONTENT_NAMES, *NEUTRAL], 0.7)}>{main}</{t}>"
        before = [self.furniture(k) for k, p in (("header", 0.5), ("nav", 0.7), ("notice", 0.3), ("ad", 0.4), ("form", 0.15)) if self.chance(p)]
        after = [self.furniture(k) for k, p in (("share", 0.2), ("comments", 0.3), ("aside", 0.4), ("form", 0.2), ("ad", 0.2), ("nav", 0.15)) if self.chance(p)]
        if self.chance(0.3):
            before.append(self.furniture("aside"))
        self.r.shuffle(after)
        end = [self.furniture("footer")] if self.chance(0.8) else []
        return ("<!DOCTYPE html><html><head><title>" + self.text(1, 9) + "</title></head><body>"
                + "".join(before) + main + "".join(after) + "".join(end) + self.pick("</body></html>", ""))


def labelled_pages(count: int = PAGES, seed: int = SEED) -> list[tuple[list[Block], np.ndarray]]:
    """(blocks, 0/1 labels) of ``count`` written pages."""
    out = []
    for i in range(count):
        found = blocks(Writer(seed * 1_000_003 + i).page())
        y = np.array([MARK in b.text for b in found], np.int64)
        for b in found:
            b.text = b.text.replace(MARK, "") or "."
        out.append((found, y))
    return out


def train(count: int = PAGES, seed: int = SEED) -> ChainCRF:
    crf = ChainCRF()
    crf.fit(labelled_pages(count, seed), seed=seed)
    return crf


def main_text(crf: ChainCRF, page: str, known: set[str] | None = None) -> str:
    found = blocks(page, crf.known_names() if known is None else known)
    return "\n".join(b.text for b, y in zip(found, crf.viterbi(found)) if y)


def extract(pages: DataFrame, html: str = "html", carry: list[str] | None = None, crf: ChainCRF | None = None) -> DataFrame:
    """``carry`` columns (default: all but the html) and ``text``, the main text of the whole page.

    Null and empty pages, and pages without a content block, have the empty
    text; repeated rows give equal texts; an empty table gives an empty result.
    """
    import pyarrow as pa
    carry = carry if carry is not None else [c for c in pages.columns if c not in (html, "text")]
    src = pages.select(*(F.col(f"`{c}`") for c in carry), F.col(html).cast("string").alias("_html"))
    schema = src.drop("_html").withColumn("text", F.lit("")).schema
    crf = crf or train()
    held = pages.sparkSession.sparkContext.broadcast((crf.index, crf.weight, crf.move))     # some hundred weights
    n = len(carry)

    def run(batches: Iterator) -> Iterator:
        field = ChainCRF()
        field.index, field.weight, field.move = held.value
        known = field.known_names()
        for batch in batches:
            texts = [main_text(field, h or "", known) for h in batch.column(n).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(n)), pa.array(texts, pa.string())],
                                             names=[*carry, "text"])

    return src.mapInArrow(run, schema)
