"""Main text of HTML pages by a recurrent block labeller.

A page is a sequence of leaf blocks.  Each block becomes a vector of its hashed
tag path (tags, words of class, id and role), its hashed words and a few shares;
a bidirectional LSTM in numpy reads the whole sequence both ways and labels every
block main or not.  It is trained here, once per driver process, on generated pages
of many templates, whose labels are known.
"""

from __future__ import annotations

import functools
import random
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firnline.llm.html_parse import Block, blocks_of

PATHS, WORDS, SHARES, HIDDEN = 96, 32, 10, 20
WIDTH = PATHS + WORDS + SHARES
#: Generated pages to train on, passes over them, pages of a step.
PAGES, PASSES, STEP = 900, 6, 30


@functools.lru_cache(maxsize=200_000)
def _slot(word: str, slots: int) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % slots


@functools.lru_cache(maxsize=20_000)
def _path_vector(path: tuple) -> np.ndarray:
    v = np.zeros(PATHS, np.float32)
    for tag, names in path:
        if tag not in ("html", "body"):
            v[_slot("<" + tag, PATHS)] = 1
            for name in names:
                v[_slot("." + name, PATHS)] = 1
    return v


def vectors(blocks: list[Block]) -> np.ndarray:
    """One row per block."""
    out = np.zeros((len(blocks), WIDTH), np.float32)
    total = len(blocks)
    for k, b in enumerate(blocks):
        out[k, :PATHS] = _path_vector(b.path)
        words = b.text.lower().split()
        slots = np.fromiter((_slot(w, WORDS) for w in words), np.int64, len(words))
        out[k, PATHS : PATHS + WORDS] = np.bincount(slots, minlength=WORDS)[:WORDS] / len(words)
        tags = [t for t, _ in b.path]
        last = tags[-1] if tags else ""
        n = len(b.text)
        out[k, PATHS + WORDS :] = (
            min(n, 2000) ** 0.5 / 20, b.linked / n, last == "p", last in ("h1", "h2", "h3", "h4"), last in ("li", "td", "dd", "a"),
            k / total, 1 / total, len(tags) / 10, sum(b.text.count(c) for c in ".,;") / max(1, len(words)), 1,
        )
    return out


class Labeller:
    """Bidirectional LSTM with a logistic output per block."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = weights

    @classmethod
    def fresh(cls, seed: int = 1) -> Labeller:
        rng = np.random.default_rng(seed)
        w = {}
        for side in "fb":
            w["x" + side] = (rng.normal(size=(WIDTH, 4 * HIDDEN)) * 0.15).astype(np.float32)
            w["h" + side] = (rng.normal(size=(HIDDEN, 4 * HIDDEN)) * 0.2).astype(np.float32)
            w["c" + side] = np.zeros(4 * HIDDEN, np.float32)
            w["c" + side][HIDDEN : 2 * HIDDEN] = 1
        w["o"] = (rng.normal(size=2 * HIDDEN + WIDTH) * 0.1).astype(np.float32)
        w["z"] = np.zeros(1, np.float32)
        return cls(w)

    def _pass(self, x: np.ndarray, side: str, keep: bool):
        """States over time (axis 1) of one direction; x is right for it already."""
        n, steps, _ = x.shape
        h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        pre = x.reshape(n * steps, WIDTH) @ self.w["x" + side] + self.w["c" + side]
        pre = pre.reshape(n, steps, 4 * HIDDEN)
        out, tape = np.empty((n, steps, HIDDEN), np.float32), []
        for t in range(steps):
            a = pre[:, t] + h @ self.w["h" + side]
            gates = 1 / (1 + np.exp(-np.clip(a[:, : 3 * HIDDEN], -30, 30)))
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            g = np.tanh(a[:, 3 * HIDDEN :])
            before, c = (h, c), f * c + i * g
            th = np.tanh(c)
            h = o * th
            out[:, t] = h
            if keep:
                tape.append((before, i, f, o, g, th))
        return out, tape

    @staticmethod
    def _flip(x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Each sequence reversed within its own length."""
        steps = x.shape[1]
        at = np.arange(steps)[None, :]
        at = np.where(at < lengths[:, None], lengths[:, None] - 1 - at, at)
        return np.take_along_axis(x, at[:, :, None], 1)

    def forward(self, x: np.ndarray, lengths: np.ndarray, keep: bool = False):
        hf, tf = self._pass(x, "f", keep)
        xb = self._flip(x, lengths)
        hb, tb = self._pass(xb, "b", keep)
        both = np.concatenate([hf, self._flip(hb, lengths), x], axis=2)
        score = both @ self.w["o"] + self.w["z"]
        return score, (x, xb, both, tf, tb)

    def step(self, x, lengths, y, mask):
        """Gradients of the mean logistic loss."""
        score, (xf, xb, both, tf, tb) = self.forward(x, lengths, True)
        p = 1 / (1 + np.exp(-np.clip(score, -30, 30)))
        ds = ((p - y) * mask / mask.sum()).astype(np.float32)
        grad = {"o": np.einsum("nt,ntk->k", ds, both), "z": np.array([ds.sum()], np.float32)}
        dh = ds[:, :, None] * self.w["o"][None, None, : 2 * HIDDEN]
        for side, tape, xs, d in (("f", tf, xf, dh[:, :, :HIDDEN]), ("b", tb, xb, self._flip(dh[:, :, HIDDEN:], lengths))):
            grad.update(self._back(side, tape, xs, d))
        return grad

    def _back(self, side, tape, x, dout):
        n, steps, _ = x.shape
        da_all = np.empty((n, steps, 4 * HIDDEN), np.float32)
        gh = np.zeros_like(self.w["h" + side])
        dh, dc = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        for t in range(steps - 1, -1, -1):
            (h0, c0), i, f, o, g, th = tape[t]
            dh = dh + dout[:, t]
            dc = dc + dh * o * (1 - th * th)
            da = np.concatenate([dc * g * i * (1 - i), dc * c0 * f * (1 - f), dh * th * o * (1 - o), dc * i * (1 - g * g)], axis=1)
            da_all[:, t] = da
            gh += h0.T @ da
            dh, dc = da @ self.w["h" + side].T, dc * f
        flat = da_all.reshape(n * steps, -1)
        return {"x" + side: x.reshape(n * steps, WIDTH).T @ flat, "h" + side: gh, "c" + side: flat.sum(0)}

    def labels(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Main or not for the blocks of each page; pages of like length run together."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = sorted((k for k in range(len(pages)) if len(pages[k])), key=lambda k: len(pages[k]))
        at = 0
        while at < len(order):
            end = at + 1
            while end < len(order) and end - at < 128 and len(pages[order[end]]) * (end - at + 1) <= 20_000:
                end += 1
            x, lengths = padded([pages[k] for k in order[at:end]])
            score, _ = self.forward(x, lengths)
            for row, k in enumerate(order[at:end]):
                out[k] = score[row, : lengths[row]] > 0
            at = end
        return out


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(p) for p in pages])
    x = np.zeros((len(pages), int(lengths.max()), WIDTH), np.float32)
    for k, p in enumerate(pages):
        x[k, : len(p)] = p
    return x, lengths


class Generator:
    """Pages of many templates with known main blocks."""

    SYLLABLES = "th an er on re in ed es en ou ti ha st nd ar le de ing qu ion ci os ra ue sch ver ge ein pf au oi eau".split()

    def __init__(self, seed: int):
        self.r = random.Random(seed)
        self.main: set[str] = set()

    def word(self) -> str:
        w = "".join(self.r.choice(self.SYLLABLES) for _ in range(self.r.randint(1, 4)))
        return w

    def say(self, lo: int, hi: int, flavour: tuple = ()) -> str:
        words = [self.word() for _ in range(self.r.randint(lo, hi))]
        for f in flavour:
            words[self.r.randrange(len(words))] = f
        words[0] = words[0].title()
        return " ".join(w + self.r.choice(["", "", "", "", ",", "."]) for w in words) + self.r.choice([".", "", "."])

    def names(self, *options: str) -> str:
        kind = self.r.random()
        if kind < 0.15:
            return ""
        name = self.r.choice(options) if kind < 0.85 else "c" + str(self.r.randint(1, 99))
        return f' {self.r.choice(["class", "class", "id"])}="{name}"'

    def text(self, lo: int, hi: int, main: bool, junk: bool = False, flavour: tuple = ()) -> str:
        s = self.say(lo, hi, flavour)
        if junk:
            s = " ".join(w + self.r.choice(["%%%", "###", "***", "&amp;&amp;"]) for w in s.split())
        if main:
            self.main.add(" ".join(s.replace("&amp;", "&").split()))
        return s

    def listing(self, main: bool) -> str:
        link = not main or self.r.random() < 0.2
        item = lambda: self.text(1, 4 if link else 15, main)
        return "<ul>" + "".join(f'<li><a href="/x">{item()}</a></li>' if link else f"<li>{item()}</li>" for _ in range(self.r.randint(2, 7))) + "</ul>"

    def paragraph(self, main: bool, junk: bool) -> str:
        t = self.text(1, 70, main, junk)
        form = self.r.random()
        if form < 0.6:
            return f"<p>{t}</p>"
        if form < 0.75:
            return f"<p><b>{t}<br>"
        if form < 0.82:
            return f"<p>{t}"
        if form < 0.88:
            return f"<div>{t}</div>"
        if form < 0.94:
            return f"<blockquote>{t}</blockquote>"
        return f"<p><em>{t}</em></p>" if form < 0.97 else f'<object data="{self.word()}">{t}</object>'

    def aside(self) -> str:
        """A block that is not main, of any kind."""
        r, n = self.r, self.names
        prose = lambda lo, hi, *f: self.text(lo, hi, False, flavour=f)
        return r.choice([
            lambda: f"<nav{n('menu', 'nav')}>{self.listing(False)}</nav>",
            lambda: f"<div{n('menu', 'navbar', 'nav', 'navigation', 'breadcrumbs', 'toc')}>{self.listing(False)}</div>",
            lambda: f'<div class="{r.choice(["ad", "ads", "advert", "advertisement", "sponsored", "promo", "banner"])}">{prose(2, 30)}</div>',
            lambda: f'<div class="{r.choice(["ad", "advert", "sponsor"])}"><p>{prose(5, 40)}</p><a href="/b">{prose(1, 3)}</a></div>',
            lambda: f'<div class="{r.choice(["cookie-banner", "cookies", "notice", "consent", "gdpr", "alert", "popup", "newsletter"])}"><p>{prose(4, 25, "cookies")}</p></div>',
            lambda: f"<aside{n('sidebar', 'related', 'widget')}><h3>{prose(1, 4)}</h3>{r.choice([self.listing(False), '<p>' + prose(4, 40) + '</p>'])}</aside>",
            lambda: f'<div class="{r.choice(["sidebar", "related", "widget", "rail", "side", "recommended"])}"><h3>{prose(1, 4)}</h3>{self.listing(False)}<p>{prose(3, 30)}</p></div>',
            lambda: f"<form{n('search', 'subscribe', 'login')}><label>{prose(1, 4)}</label><input name=q><p>{prose(2, 15)}</p></form>",
            lambda: f'<div class="{r.choice(["share", "social", "tags", "meta"])}"><a href="/s">{prose(1, 2)}</a> <a href="/t">{prose(1, 2)}</a></div>',
            lambda: f'<button{n("btn", "share", "more")}>{prose(1, 5)}</button>',
            lambda: "<select name=s>" + "".join(f"<option>{prose(1, 3)}</option>" for _ in range(r.randint(1, 6))) + "</select>",
        ])()

    def comments(self) -> str:
        one = lambda: f'<div class="comment"><p>{self.text(2, 60, False)}</p></div>'
        two = lambda: f"<li><b>{self.word()}</b><p>{self.text(2, 60, False)}</p></li>"
        name = self.r.choice(["comments", "comment-list", "discussion", "replies", "responses"])
        head = f"<h3>{self.text(1, 3, False)}</h3>" if self.r.random() < 0.6 else ""
        count = self.r.randint(1, 6)
        if self.r.random() < 0.5:
            return f'<section {self.r.choice(["class", "id"])}="{name}">{head}' + "".join(one() for _ in range(count)) + "</section>"
        return f'<div {self.r.choice(["class", "id"])}="{name}">{head}<ol>' + "".join(two() for _ in range(count)) + "</ol></div>"

    def page(self) -> tuple[str, set[str]]:
        r, n = self.r, self.names
        self.main = set()
        junk = r.random() < 0.15
        body = []
        title = self.say(2, 9)
        if r.random() < 0.5:
            body.append(f"<header{n('header', 'masthead', 'top')}><div{n('logo', 'brand', 'title')}>{self.text(1, 5, False)}</div></header>")
        body += [self.aside() for _ in range(r.randint(0, 3))]
        inside = []
        if r.random() < 0.85:
            inside.append(f"<h1>{self.text(1, 10, True, junk)}</h1>")
        for _ in range(r.choice([0, 1, 2, 4, 8, 14, 25])):
            kind = r.random()
            if kind < 0.75:
                inside.append(self.paragraph(True, junk))
            elif kind < 0.83:
                inside.append(f"<h{r.randint(2, 4)}>{self.text(1, 8, True)}</h2>".replace("</h2>", f"</h{2}>"))
            elif kind < 0.89:
                inside.append(self.listing(True))
            elif kind < 0.92:
                inside.append(f"<table><tr><td>{self.text(1, 5, True)}</td><td>{self.text(1, 5, True)}</td></tr></table>")
            else:
                inside.append(self.aside())
        late = self.comments() if r.random() < 0.3 else ""
        shut = r.random()
        open_, close = (
            ("<article>", "</article>") if shut < 0.45 else (f"<article{n('post', 'story')}>", "</article>") if shut < 0.6
            else (f"<main{n('main')}>", "</main>") if shut < 0.7
            else (f'<div class="{r.choice(["content", "post", "entry-content", "story", "article-body", "article", "post-content", "main"])}">', "</div>")
        )
        within = r.random() < 0.5
        body.append(open_ + "".join(inside) + (late if within else "") + close + ("" if within else late))
        body += [self.aside() for _ in range(r.choice([0, 0, 0, 1, 2]))]
        if r.random() < 0.85:
            mark = r.choice(["&copy; ", "Copyright ", "&copy; x.example.com &middot; ", ""])
            text = self.text(2, 20, False)
            body.append(f"<footer{n('footer')}>{mark}{text}</footer>" if r.random() < 0.7 else f'<div class="{r.choice(["footer", "copyright", "site-footer"])}">{mark}{text}</div>')
        page = f"<!DOCTYPE html><html><head><title>{title}</title></head><body>{''.join(body)}</body></html>"
        if r.random() < 0.1:
            page = page[: r.randint(len(page) // 2, len(page))]
        return page, self.main


def examples(count: int, seed: int) -> list[tuple[np.ndarray, np.ndarray]]:
    made, g = [], Generator(seed)
    for _ in range(count):
        page, main = g.page()
        blocks = blocks_of(page)
        if blocks:
            # a block cut off at the end of a truncated page is judged by its start
            y = [any(m.startswith(b.text) for m in main) if k == len(blocks) - 1 else b.text in main for k, b in enumerate(blocks)]
            made.append((vectors(blocks), np.array(y, np.float32)))
    return made


@functools.lru_cache(maxsize=1)
def trained(pages: int = PAGES, passes: int = PASSES, seed: int = 11) -> Labeller:
    """The labeller, fitted with Adam on ``pages`` generated pages."""
    data = examples(pages, seed)
    model = Labeller.fresh()
    rng = np.random.default_rng(seed)
    m = {k: np.zeros_like(v) for k, v in model.w.items()}
    s = {k: np.zeros_like(v) for k, v in model.w.items()}
    turn = 0
    for epoch in range(passes):
        order = sorted(rng.permutation(len(data)), key=lambda k: len(data[k][0]) + rng.random() * 4)
        groups = [order[k : k + STEP] for k in range(0, len(order), STEP)]
        rng.shuffle(groups)
        for group in groups:
            x, lengths = padded([data[k][0] for k in group])
            y = np.zeros(x.shape[:2], np.float32)
            mask = np.zeros(x.shape[:2], np.float32)
            for row, k in enumerate(group):
                y[row, : lengths[row]] = data[k][1]
                mask[row, : lengths[row]] = 1
            grad = model.step(x, lengths, y, mask)
            size = sum(float((g * g).sum()) for g in grad.values()) ** 0.5
            turn += 1
            rate = 0.01 * (1 - 0.8 * epoch / passes)
            for k, g in grad.items():
                g = g * min(1.0, 5 / (size + 1e-9))
                m[k] += 0.1 * (g - m[k])
                s[k] += 0.01 * (g * g - s[k])
                model.w[k] -= rate * (m[k] / (1 - 0.9**turn)) / (np.sqrt(s[k] / (1 - 0.99**turn)) + 1e-8)
    return model


def main_texts(model: Labeller, pages: list[str | None]) -> list[str]:
    parsed = [blocks_of(p) for p in pages]
    marks = model.labels([vectors(b) for b in parsed])
    return [" ".join(b.text for b, keep in zip(blocks, mark) if keep) for blocks, mark in zip(parsed, marks)]


def extract_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per page: ``page_id, url, text`` (main text of the whole page, blocks
    joined by one space, empty if none) and ``n_chars``.

    Null and empty pages give an empty text; ids and urls may be null or repeated,
    each row is answered; an empty table gives no rows; other columns are not read.
    """
    model = pages.sparkSession.sparkContext.broadcast(trained().w)
    kinds = dict(pages.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(model.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [t.encode("utf-8", "replace").decode() for t in main_texts(labeller, part.column(2).to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )

    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    return rows.mapInArrow(run, f"page_id {kinds[page_id]}, url {kinds[url]}, text string, n_chars long")
