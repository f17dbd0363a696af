"""Main text of web pages by a recurrent block labeller.

A page is the sequence of its leaf blocks. A block is read as two hashed vectors, of its tag path
(names, and words of class, id and role) and of its words, with its length and share of links. A
bidirectional LSTM, in numpy, runs over the whole page, so a block is judged with everything before
and after it; blocks labelled as article are joined by one blank, in page order.

Training is here too, on two bounded sources: ``SAMPLE`` pages of the table, by hash of the id,
whose own semantic tags say what is article and what is not; and ``MADE`` pages laid out at random
from the parts pages have (menus, notices, side bars, forms, adverts, comments and so on, with the
usual names), filled with the words of the sample. The made pages teach what a given table may not
show.

A null, empty or text-free page has an empty text. Empty tables give no rows, repeated rows a row
each; other columns of the input are ignored.
"""

from __future__ import annotations

import random
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.arrays import column, map_rows, slices
from tidemark.llm.html_blocks import Block, Path, blocks
from tidemark.llm.registry import register, table

PATH, WORDS, PLAIN = 256, 32, 4
SIZE = PATH + WORDS + PLAIN
HIDDEN = 16
SAMPLE, MADE = 150, 600
#: Pages of more characters are not learned from; words that the made pages use.
LONGEST, VOCABULARY = 200_000, 20_000
#: Blocks whose vectors are held at once.
TOGETHER = 8192


def _hash(text: str, size: int) -> int:
    return zlib.crc32(text.encode("utf-8", "surrogatepass")) % size


_PATHS: dict[int, np.ndarray] = {}


def _hashed(bits: int, marks: tuple[str, ...]) -> int:
    for mark in marks:
        bits |= 1 << _hash(mark, PATH)
    return bits


def _path_vector(path: Path) -> np.ndarray:
    """Which hashes occur among the path's marks; the last mark has one more."""
    bits = path.fold("hashed", 0, _hashed)
    if path.marks:
        bits |= 1 << _hash("leaf " + path.marks[-1], PATH)
    got = _PATHS.get(bits)
    if got is None:
        got = np.unpackbits(np.frombuffer(bits.to_bytes(PATH // 8, "little"), np.uint8), bitorder="little").astype(np.float32)
        if len(_PATHS) > 20_000:
            _PATHS.clear()
        _PATHS[bits] = got
    return got


def vectors(page: list[Block]) -> np.ndarray:
    out = np.zeros((len(page), SIZE), np.float32)
    for row, b in zip(out, page):
        row[:PATH] = _path_vector(b.above)
        said = b.text.lower().split()
        count = np.bincount([_hash(w, WORDS) for w in said], minlength=WORDS)
        row[PATH : PATH + WORDS] = count / len(said)
        row[-4:] = (np.log1p(len(said)) / 5, b.linked / len(b.text), b.text[-1] in ".!?…:\"”", b.above.size / 10)
    return out


@dataclass
class Labeller:
    """Weights of both directions and of the output."""

    w: np.ndarray  # (2, SIZE, 4 * HIDDEN)
    u: np.ndarray  # (2, HIDDEN, 4 * HIDDEN)
    b: np.ndarray  # (2, 4 * HIDDEN)
    v: np.ndarray  # (2 * HIDDEN)
    c: np.ndarray  # (1)

    def run(self, x: np.ndarray, sizes: np.ndarray, keep: bool = False):
        """Logits of a padded batch, (pages, blocks), and what training needs."""
        pages, steps, _ = x.shape
        turn = _reversal(sizes, steps)
        rows = np.arange(pages)[:, None]
        tapes, hidden = [], []
        for d in (0, 1):
            seen = x if d == 0 else x[rows, turn]
            fed = seen.reshape(-1, SIZE) @ self.w[d] + self.b[d]
            fed = fed.reshape(pages, steps, -1)
            h, c = np.zeros((pages, HIDDEN), np.float32), np.zeros((pages, HIDDEN), np.float32)
            all_h, tape = np.zeros((pages, steps, HIDDEN), np.float32), []
            for t in range(steps):
                z = fed[:, t] + h @ self.u[d]
                gates = 1 / (1 + np.exp(-z[:, : 3 * HIDDEN]))
                i, f, o = np.split(gates, 3, axis=1)
                g = np.tanh(z[:, 3 * HIDDEN :])
                before_h, before_c = h, c
                c = f * c + i * g
                squashed = np.tanh(c)
                h = o * squashed
                all_h[:, t] = h
                if keep:
                    tape.append((before_h, before_c, i, f, o, g, squashed))
            hidden.append(all_h if d == 0 else all_h[rows, turn])
            tapes.append((seen, tape))
        both = np.concatenate(hidden, axis=2)
        return both @ self.v + self.c[0], (tapes, both, turn)

    def read(self, page: list[Block], step: int = TOGETHER) -> np.ndarray:
        """Logits of one page, whose vectors are made ``step`` blocks at a time; for long pages."""
        out = np.full(len(page), self.c[0], np.float32)
        for d in (0, 1):
            h, c = np.zeros(HIDDEN, np.float32), np.zeros(HIDDEN, np.float32)
            begins = range(0, len(page), step)
            for begin in begins if d == 0 else reversed(begins):
                fed = vectors(page[begin : begin + step]) @ self.w[d] + self.b[d]
                for t in range(len(fed)) if d == 0 else range(len(fed) - 1, -1, -1):
                    z = fed[t] + h @ self.u[d]
                    i, f, o = np.split(1 / (1 + np.exp(-z[: 3 * HIDDEN])), 3)
                    c = f * c + i * np.tanh(z[3 * HIDDEN :])
                    h = o * np.tanh(c)
                    out[begin + t] += h @ self.v[d * HIDDEN : (d + 1) * HIDDEN]
        return out


def _reversal(sizes: np.ndarray, steps: int) -> np.ndarray:
    """Positions that turn each page around and leave its padding where it is."""
    at = np.arange(steps)[None, :]
    return np.where(at < sizes[:, None], sizes[:, None] - 1 - at, at)


def _gradients(net: Labeller, x: np.ndarray, sizes: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    logits, (tapes, both, turn) = net.run(x, sizes, keep=True)
    pages, steps, _ = x.shape
    real = np.arange(steps)[None, :] < sizes[:, None]
    error = np.where(real, 1 / (1 + np.exp(-logits)) - y, 0).astype(np.float32) / max(1, real.sum())
    gv, gc = np.einsum("pt,pth->h", error, both), np.array([error.sum()], np.float32)
    gw, gu, gb = np.zeros_like(net.w), np.zeros_like(net.u), np.zeros_like(net.b)
    rows = np.arange(pages)[:, None]
    for d in (0, 1):
        down = error[:, :, None] * net.v[None, None, d * HIDDEN : (d + 1) * HIDDEN]
        down = down if d == 0 else down[rows, turn]
        seen, tape = tapes[d]
        dh, dc = np.zeros((pages, HIDDEN), np.float32), np.zeros((pages, HIDDEN), np.float32)
        dz_all = np.zeros((pages, steps, 4 * HIDDEN), np.float32)
        for t in range(steps - 1, -1, -1):
            before_h, before_c, i, f, o, g, squashed = tape[t]
            dh = dh + down[:, t]
            dc = dc + dh * o * (1 - squashed**2)
            dz = np.concatenate([dc * g * i * (1 - i), dc * before_c * f * (1 - f), dh * squashed * o * (1 - o), dc * i * (1 - g**2)], axis=1)
            dz_all[:, t] = dz
            gu[d] += before_h.T @ dz
            dh, dc = dz @ net.u[d].T, dc * f
        flat = dz_all.reshape(-1, 4 * HIDDEN)
        gw[d] = seen.reshape(-1, SIZE).T @ flat
        gb[d] = flat.sum(axis=0)
    return [gw, gu, gb, gv, gc]


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(p) for p in pages])
    x = np.zeros((len(pages), int(sizes.max()), SIZE), np.float32)
    for row, p in zip(x, pages):
        row[: len(p)] = p
    return x, sizes


def train(pages: list[np.ndarray], labels: list[np.ndarray], epochs: int = 7, rate: float = 0.01, seed: int = 1) -> Labeller:
    """Cross entropy, Adam, minibatches of pages of like length."""
    rng = np.random.default_rng(seed)
    draw = lambda *shape: (rng.normal(size=shape) * 0.1).astype(np.float32)
    net = Labeller(draw(2, SIZE, 4 * HIDDEN), draw(2, HIDDEN, 4 * HIDDEN), np.zeros((2, 4 * HIDDEN), np.float32), draw(2 * HIDDEN), np.zeros(1, np.float32))
    net.b[:, HIDDEN : 2 * HIDDEN] = 1  # remember by default
    weights = [net.w, net.u, net.b, net.v, net.c]
    first, second, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    order = np.argsort([len(p) for p in pages], kind="stable")
    batches = [order[i : i + 32] for i in range(0, len(order), 32)]
    for epoch in range(epochs):
        for k in rng.permutation(len(batches)):
            x, sizes = _padded([pages[i] for i in batches[k]])
            y = np.zeros(x.shape[:2], np.float32)
            for row, i in zip(y, batches[k]):
                row[: len(labels[i])] = labels[i]
            step += 1
            for w, g, m, s in zip(weights, _gradients(net, x, sizes, y), first, second):
                m += 0.1 * (g - m)
                s += 0.01 * (g * g - s)
                w -= rate * (1 - epoch / epochs) * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
    return net


# Names that pages commonly give to their parts; what the made pages are laid out from.
REST = {
    "nav": ["nav", "menu", "navbar", "navigation", "breadcrumb", "topbar"],
    "header": ["header", "masthead", "banner", "site-header", "logo"],
    "footer": ["footer", "site-footer", "copyright", "legal", "colophon"],
    "aside": ["sidebar", "aside", "related", "widget", "trending", "recommended", "tags", "popular"],
    "ad": ["ad", "ads", "advert", "advertisement", "sponsored", "promo"],
    "notice": ["notice", "cookie", "consent", "alert", "popup", "newsletter", "subscribe", "gdpr", "modal", "paywall"],
    "form": ["form", "search", "login", "signup", "contact"],
    "comments": ["comments", "comment", "replies", "discussion", "respond", "disqus"],
    "share": ["share", "social", "pagination", "pager", "byline", "meta"],
}
MAIN = ["content", "article", "post", "story", "main", "entry", "body", "text", "article-body", "post-content"]
FRAME = ["container", "wrapper", "page", "row", "col", "layout", "inner", "grid"]


def made_page(rng: random.Random, words: list[str]) -> list[tuple[str, int]]:
    """A page as (html, label) pieces; the label tells of the text in the piece."""
    out: list[tuple[str, int]] = []

    def say(low: int, high: int, stop: bool = True) -> str:
        got = [rng.choice(words) for _ in range(rng.randint(low, high))]
        return " ".join(got).capitalize() + ("." if stop and rng.random() < 0.9 else "")

    def put(html: str, label: int = 0):
        out.append((html, label))

    def attribute(name: str) -> str:
        return f' {rng.choice(["class", "class", "id"])}="{name}"'

    def rest(kind: str):
        names, tag = REST[kind], {"nav": "nav", "header": "header", "footer": "footer", "aside": "aside", "form": "form"}.get(kind)
        if tag and rng.random() < 0.6:
            open_, close = f"<{tag}{attribute(rng.choice(names)) if rng.random() < 0.3 else ''}>", f"</{tag}>"
        else:
            t = rng.choice(["div", "div", "section", "ul" if kind == "nav" else "div"])
            open_, close = f"<{t}{attribute(rng.choice(names))}>", f"</{t}>"
        put(open_)
        if kind in ("nav", "share") or kind == "aside" and rng.random() < 0.5:
            if rng.random() < 0.3:
                put(f"<h{rng.randint(2, 4)}>{say(1, 4, False)}</h2>")
            put("<ul>")
            for _ in range(rng.randint(2, 9)):
                put(f'<li><a href="/x">{say(1, 3, False)}</a></li>')
            put("</ul>")
        elif kind == "form":
            for _ in range(rng.randint(1, 4)):
                put(f"<label>{say(1, 3, False)}</label><input name=q>" if rng.random() < 0.6 else f"<p>{say(3, 20)}</p>")
            put(f"<button>{say(1, 2, False)}</button>")
        elif kind == "comments":
            put(f"<h3>{say(1, 3, False)}</h3>")
            for _ in range(rng.randint(1, 6)):
                put(f'<div class="{rng.choice(["comment", "reply", "author", "item"])}"><p>{say(3, 60)}</p></div>')
        else:
            for _ in range(rng.randint(1, 3)):
                put(rng.choice(["<p>%s</p>", "%s<br>", "<div>%s</div>", "<span>%s</span> ", "<a href=/>%s</a> "]) % say(2, 30))
        put(close)

    def story():
        put(f"<h1>{say(3, 12)}</h1>", 1)
        for _ in range(rng.randint(1, 14)):
            kind = rng.random()
            if kind < 0.72:
                put(f"<p>{'<b>' if rng.random() < 0.15 else ''}{say(1, 90)}{'<br>' if rng.random() < 0.1 else ''}{'</p>' if rng.random() < 0.9 else ''}", 1)
            elif kind < 0.8:
                put(f"<h{rng.randint(2, 4)}>{say(1, 8, False)}</h2>", 1)
            elif kind < 0.86:
                put("<ul>" + "".join(f"<li>{say(2, 15)}</li>" for _ in range(rng.randint(2, 5))) + "</ul>", 1)
            elif kind < 0.9:
                put(f"<blockquote>{say(5, 40)}</blockquote>", 1)
            elif kind < 0.93:
                put(f"<figure><img src=x><figcaption>{say(3, 12)}</figcaption></figure>", 1)
            elif kind < 0.95:
                put("<table><tr>" + "".join(f"<td>{say(1, 4, False)}</td>" for _ in range(4)) + "</tr></table>", 1)
            else:
                rest(rng.choice(["ad", "share", "aside", "notice", "form"]))

    put("<html><head><title>x</title></head><body>")
    framed = rng.random() < 0.4
    if framed:
        put(f"<div{attribute(rng.choice(FRAME))}>")
    before = ["nav", "header", "notice", "ad", "form", "share", "aside"]
    for kind in rng.sample(before, rng.randint(0, 5)):
        rest(kind)
    shape = rng.random()
    if shape < 0.5:
        open_, close = "<article>", "</article>"
    elif shape < 0.65:
        open_, close = "<main>", "</main>"
    else:
        t = rng.choice(["div", "section", "article", "main"])
        open_, close = f"<{t}{attribute(rng.choice(MAIN))}>", f"</{t}>"
    put(open_)
    story()
    if rng.random() < 0.15:
        rest("comments")
    put(close)
    for kind in rng.sample(["footer", "aside", "comments", "ad", "form", "share", "notice", "nav"], rng.randint(0, 5)):
        rest(kind)
    if framed:
        put("</div>")
    put("</body></html>")
    return out


def labelled_made(rng: random.Random, words: list[str]) -> tuple[list[Block], np.ndarray]:
    """A made page's blocks and labels: article words are marked in the markup, then unmarked."""
    flag = ""
    html = "".join(_flagged(p, flag) if label else p for p, label in made_page(rng, words))
    page = blocks(html)
    labels = np.array([flag in b.text for b in page], np.float32)
    for b in page:
        b.text = b.text.replace(flag, "") or "x"
        b.linked = min(b.linked, len(b.text))
    return page, labels


def _flagged(piece: str, flag: str) -> str:
    """Put ``flag`` before every stretch of text in the piece."""
    out, inside = [], False
    for a, b in zip(" " + piece, piece):
        out.append(flag + b if not inside and b != "<" and (a == ">" or a == " " and not out) else b)
        inside = b == "<" or inside and b != ">"
    return "".join(out)


BAD = {"nav", "header", "footer", "aside", "form"} | {"." + n for names in REST.values() for name in names for n in name.split("-")}


def semantic_labels(page: list[Block]) -> np.ndarray | None:
    """Labels from the page's own article or main tag; None if it has none."""
    within = [b.above.fold("article", False, lambda seen, marks: seen or "article" in marks or "main" in marks) for b in page]
    beside = [b.above.fold("beside", False, lambda seen, marks: seen or not BAD.isdisjoint(marks)) for b in page]
    return np.array([w and not o for w, o in zip(within, beside)], np.float32) if any(within) else None


def fit(pages: DataFrame, sample: int = SAMPLE, made: int = MADE, seed: int = 11, longest: int = LONGEST, words: int = VOCABULARY) -> Labeller:
    """Train on a bounded sample of ``pages`` and on ``made`` pages.

    The sample is at most ``sample`` pages, first by hash of the id; those of over ``longest`` characters
    teach nothing (they are labelled like all others). The made pages use the first ``words`` of its words,
    in order of their hashes. Of rows that share an id, the one with the smallest html counts.
    """
    # Ids are drawn first: what each task offers for the sample is ids, not pages.
    drawn = pages.where("page_id is not null").select("page_id").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(sample)
    chosen = pages.join(F.broadcast(drawn), "page_id").where(F.length("html") <= longest).groupBy("page_id").agg(F.min("html").alias("html"))
    real = [blocks(r["html"]) for r in sorted(chosen.select("html").collect())]
    spoken = sorted({w for page in real for b in page for w in b.text.split()}, key=lambda w: (_hash(w, 1 << 32), w))[:words] or ["text"]
    data = [(vectors(p), y) for p in real if p and (y := semantic_labels(p)) is not None]
    rng = random.Random(seed)
    for _ in range(made):
        page, y = labelled_made(rng, spoken)
        if page:
            data.append((vectors(page), y))
    return train([x for x, _ in data], [y for _, y in data])


def label(net: Labeller, pages: list[list[Block]]) -> list[np.ndarray]:
    """Which blocks are article, for each page; pages of like length go together, long ones alone."""
    out = [net.read(p) > 0 if len(p) > TOGETHER else np.zeros(0, bool) for p in pages]
    order = sorted((i for i, p in enumerate(pages) if 0 < len(p) <= TOGETHER), key=lambda i: len(pages[i]))
    at = 0
    while at < len(order):
        size = 1
        while at + size < len(order) and (size + 1) * len(pages[order[at + size]]) <= TOGETHER:
            size += 1
        group = order[at : at + size]
        x, sizes = _padded([vectors(pages[i]) for i in group])
        logits, _ = net.run(x, sizes)
        for i, row in zip(group, logits):
            out[i] = row[: len(pages[i])] > 0
        at += size
    return out


def main_text(pages: DataFrame, net: Labeller) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    held = pages.sparkSession.sparkContext.broadcast(net)

    def run(batch: pa.RecordBatch):
        html = column(batch, "html")
        for begin, end in slices(html):
            cut = [blocks(h) for h in html.slice(begin, end - begin).to_pylist()]
            texts = [" ".join(b.text for b, good in zip(p, y) if good) for p, y in zip(cut, label(held.value, cut))]
            yield pa.RecordBatch.from_arrays(
                [*(column(batch, c).slice(begin, end - begin) for c in ("page_id", "url")), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return pages.select("page_id", "url", "html").mapInArrow(map_rows(run), "page_id long, url string, text string, n_chars long")


@register("op6_html_extraction")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return main_text(pages, fit(pages))
