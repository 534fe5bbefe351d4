"""Main text of web pages: a page becomes its sequence of text blocks, and a recurrent labeller keeps the article's.

Each block has a vector of its tag path (names, classes and ids of the elements around it, hashed and added up; logs of
the sums), a vector of its words (signs from each word's hash, averaged), and a few shares. A bidirectional LSTM in numpy reads the whole sequence, so
that a block is judged by what stands before and behind it. It is trained on pages that this module makes up.
"""

from __future__ import annotations

import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .common import bytes_of, small_batches, table, words_of

#: Places of hashed names and of hashed words in a block's vector, and of its shares.
NAME_SIZE, WORD_SIZE, SHARES = 128, 16, 4
HIDDEN, PAGES, ROUNDS, SEED = 16, 900, 8, 11
#: Step of the fit in its first and last round.
RATES = 0.02, 0.002
#: Pages labelled together, and their blocks.
BATCH_PAGES, BATCH_BLOCKS = 256, 1 << 14
CACHED_NAMES = 1 << 14

BLOCK = set("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is never text of the page.
HIDDEN_TAGS = set("head script style noscript template title svg iframe object textarea select button datalist".split())
#: A start tag here closes an open element of the second set, up to the third.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
_tokens = re.compile(r"[a-z]+").findall


@dataclass
class Block:
    path: np.ndarray
    text: str
    linked: int


#: Places of the path vector: a tag around the block, the tag that it stands in, the path's length, hashed names.
TAG_PLACE = {t: i for i, t in enumerate(sorted(BLOCK))}
DEPTHS = 9
PATH_SIZE = 2 * len(BLOCK) + DEPTHS + NAME_SIZE


def _name_mark(name: str) -> tuple[int, int]:
    h = zlib.crc32(name.encode())
    return PATH_SIZE - NAME_SIZE + h % NAME_SIZE, 1 if h >> 31 else -1


@lru_cache(maxsize=CACHED_NAMES)
def marks_of(tag: str, names: str) -> tuple[tuple[int, int], ...]:
    """Places and signs that an element adds to the path vector of all blocks within."""
    return (TAG_PLACE[tag], 1), *(_name_mark(t) for t in _tokens(names.lower()))


def own_marks(tags: list[str]) -> Iterator[int]:
    """Places that only the block itself adds to."""
    if tags:
        yield len(BLOCK) + TAG_PLACE[tags[-1]]
    yield 2 * len(BLOCK) + min(len(tags), DEPTHS - 1)


class BlockReader(HTMLParser):
    """Blocks of a page in order. Tags may be unclosed, crossed or unknown; character references are decoded once.

    An open element is found by its name and closed once, and the path vector is kept up to date, so work follows the
    page's length however deep its elements lie.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[Block] = []
        self.stack: list[tuple[str, tuple]] = []
        self.open: dict[str, list[int]] = {}
        self.block_tags: list[str] = []
        self.vector = [0] * PATH_SIZE
        self.parts: list[str] = []
        self.linked = self.links = self.hidden = 0
        self.path = np.zeros(PATH_SIZE)

    def flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                self.blocks.append(Block(self.path, text, self.linked))
            self.parts, self.linked = [], 0

    def _pop_to(self, depth: int) -> None:
        while len(self.stack) > depth:
            tag, marks = self.stack.pop()
            self.open[tag].pop()
            self.links -= tag == "a"
            self.hidden -= tag in HIDDEN_TAGS
            if tag in BLOCK:
                self.block_tags.pop()
                for at, sign in marks:
                    self.vector[at] -= sign

    def _last(self, tags) -> int:
        return max((self.open[t][-1] for t in tags if self.open.get(t)), default=-1)

    def _close(self, tags: set[str], until: set[str]) -> None:
        at = self._last(tags)
        if at > self._last(until):
            self._pop_to(at)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in BLOCK:
            self.flush()
            if tag == "body":
                self._close({"head"}, set())
            if self.block_tags and self.block_tags[-1] == "p":
                self._pop_to(self.open["p"][-1])
        if tag in CLOSES:
            self._close(*CLOSES[tag])
        if tag == "br":
            if self.parts:
                self.parts.append(" ")
            return
        if tag in VOID:
            return
        marks: tuple = ()
        if tag in BLOCK:
            marks = marks_of(tag, " ".join(v for k, v in attrs if k in ("class", "id", "role") and v))
            self.block_tags.append(tag)
            for at, sign in marks:
                self.vector[at] += sign
        self.open.setdefault(tag, []).append(len(self.stack))
        self.stack.append((tag, marks))
        self.links += tag == "a"
        self.hidden += tag in HIDDEN_TAGS

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCK:
            self.flush()
        if self.open.get(tag):
            self._pop_to(self.open[tag][-1])

    def handle_data(self, data: str) -> None:
        if self.hidden:
            return
        if not self.parts:
            self.path = np.array(self.vector, np.float32)
            for at in own_marks(self.block_tags):
                self.path[at] += 1
        self.parts.append(data)
        if self.links:
            self.linked += len(data)


def blocks_of(html: str) -> list[Block]:
    reader = BlockReader()
    reader.feed(html)
    reader.close()
    reader.flush()
    return reader.blocks


def features(blocks: list[Block]) -> np.ndarray:
    """One row a block."""
    if not blocks:
        return np.zeros((0, PATH_SIZE + WORD_SIZE + SHARES), np.float32)
    texts = pa.array([b.text for b in blocks], pa.large_string())
    raw, places = bytes_of(texts)
    _, _, owner, h = words_of(raw, places)
    count = np.bincount(owner, minlength=len(blocks))
    signs = np.stack([np.bincount(owner, ((h >> np.uint64(k)) & np.uint64(1)).astype(np.float64) * 2 - 1, len(blocks)) for k in range(WORD_SIZE)], 1)
    chars = np.array([len(b.text) for b in blocks])
    linked = np.array([b.linked for b in blocks])
    stops = np.array([b.text.count(".") + b.text.count(",") for b in blocks])
    shares = np.stack([np.log1p(chars) / 6, np.log1p(count) / 4, np.minimum(linked / chars, 1), np.minimum(stops / np.maximum(count, 1), 1)], 1)
    paths = np.stack([b.path for b in blocks])
    return np.concatenate([np.sign(paths) * np.log1p(np.abs(paths)), signs / np.maximum(count, 1)[:, None], shares], 1).astype(np.float32)


@dataclass
class Labeller:
    """Weights of one LSTM a direction and of the output."""

    weights: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def start(cls, size: int, seed: int) -> Labeller:
        rng = np.random.default_rng(seed)
        w = {"out": rng.normal(size=(2 * HIDDEN, 1)) * 0.3, "bias": np.zeros(1)}
        for d in "fb":
            w[f"{d}x"] = rng.normal(size=(size, 4 * HIDDEN)) / np.sqrt(size)
            w[f"{d}h"] = rng.normal(size=(HIDDEN, 4 * HIDDEN)) / np.sqrt(HIDDEN)
            w[f"{d}0"] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])
        return cls({k: v.astype(np.float32) for k, v in w.items()})

    def _run(self, d: str, x: np.ndarray, mask: np.ndarray, keep: list | None) -> np.ndarray:
        """Hidden states of one direction; x is (steps, pages, size) and in that direction's order."""
        w = self.weights
        given = x @ w[f"{d}x"] + w[f"{d}0"]
        h = np.zeros((x.shape[1], HIDDEN), np.float32)
        c = np.zeros_like(h)
        out = np.zeros((len(x), *h.shape), np.float32)
        for t in range(len(x)):
            z = given[t] + h @ w[f"{d}h"]
            gates = 1 / (1 + np.exp(-z[:, : 3 * HIDDEN]))
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            g = np.tanh(z[:, 3 * HIDDEN :])
            m = mask[t][:, None]
            now = f * c + i * g
            s = np.tanh(now)
            if keep is not None:
                keep.append((h, c, i, f, o, g, s, m))
            c = np.where(m, now, c)
            h = np.where(m, o * s, h)
            out[t] = h
        return out

    def _back(self, d: str, x: np.ndarray, keep: list, grad: np.ndarray, sums: dict) -> None:
        w = self.weights[f"{d}h"]
        dh = np.zeros((x.shape[1], HIDDEN), np.float32)
        dc = np.zeros_like(dh)
        dz = np.zeros((len(x), x.shape[1], 4 * HIDDEN), np.float32)
        dw = np.zeros_like(w)
        for t in range(len(x) - 1, -1, -1):
            h, c, i, f, o, g, s, m = keep[t]
            dh = dh + grad[t]
            live = dh * m
            dn = (dc + live * o * (1 - s * s)) * m
            dz[t] = np.concatenate([dn * g * i * (1 - i), dn * c * f * (1 - f), live * s * o * (1 - o), dn * i * (1 - g * g)], 1)
            dw += h.T @ dz[t]
            dh = dz[t] @ w.T + dh * ~m
            dc = dn * f + dc * ~m
        sums[f"{d}h"] = dw
        sums[f"{d}x"] = np.tensordot(x, dz, ((0, 1), (0, 1)))
        sums[f"{d}0"] = dz.sum((0, 1))

    def logits(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        ahead = self._run("f", x, mask, None)
        behind = self._run("b", x[::-1], mask[::-1], None)[::-1]
        return (np.concatenate([ahead, behind], 2) @ self.weights["out"])[..., 0] + self.weights["bias"]

    def step(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the mean log loss."""
        kept_f: list = []
        kept_b: list = []
        ahead = self._run("f", x, mask, kept_f)
        behind = self._run("b", x[::-1], mask[::-1], kept_b)[::-1]
        both = np.concatenate([ahead, behind], 2)
        z = (both @ self.weights["out"])[..., 0] + self.weights["bias"]
        error = (1 / (1 + np.exp(-z)) - y) * mask / mask.sum()
        sums = {"out": np.tensordot(both, error, ((0, 1), (0, 1)))[:, None], "bias": np.array([error.sum()], np.float32)}
        grad = (error[..., None] * self.weights["out"][:, 0]).astype(np.float32)
        self._back("f", x, kept_f, grad[..., :HIDDEN], sums)
        self._back("b", x[::-1], kept_b, grad[::-1][..., HIDDEN:], sums)
        return sums


def padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    longest = max(map(len, rows))
    x = np.zeros((longest, len(rows), rows[0].shape[1]), np.float32)
    mask = np.zeros((longest, len(rows)), bool)
    for i, r in enumerate(rows):
        x[: len(r), i], mask[: len(r), i] = r, True
    return x, mask


class PageMaker:
    """Made-up pages of many layouts; text of the article stands between marks that tell it from the rest."""

    MARK = "\ue000"

    def __init__(self, seed: int):
        self.r = random.Random(seed)
        letters = "etaoinshrdlucmfwypvbgkjqxzéèüßñóäö"
        self.words = ["".join(self.r.choices(letters, range(len(letters), 0, -1), k=self.r.randint(1, 9))) for _ in range(3000)]

    def text(self, low: int, high: int) -> str:
        words = self.r.choices(self.words, k=self.r.randint(low, high))
        words = [w + self.r.choice(["", "", "", "", "", ",", "."]) for w in words]
        if self.r.random() < 0.15:
            words = [w + self.r.choice(["***", "%%%", "&amp;&amp;", "###", " |"]) for w in words]
        return " ".join(words).capitalize() + self.r.choice([".", ".", ""])

    def good(self, low: int, high: int) -> str:
        return self.MARK + self.text(low, high)

    def menu(self) -> str:
        links = [f'<a href="/x">{self.text(1, 3)}</a>' for _ in range(self.r.randint(2, 12))]
        return self.r.choice(["<ul><li>" + "</li><li>".join(links) + "</li></ul>"] * 3 + [" | ".join(links), "<p>" + "</p><p>".join(links) + "</p>", "<div>" + "</div><div>".join(links) + "</div>"])

    def some(self, low: int, high: int) -> str:
        """Text within an element, in any of the usual ways."""
        text = self.text(low, high)
        return self.r.choice([text, f"<p>{text}</p>", f"<p>{text}</p>", f"<div>{text}</div>", f"<div><p>{text}</p></div>", f"<p>{text}<br>{self.text(1, 8)}</p>", f"<p>{text}</p><p>{self.text(1, 12)}</p>", f"<span>{text}</span>"])

    def boilerplate(self) -> str:
        r, t = self.r, self.some
        link = f'<a href="#">{self.text(1, 4)}</a>'
        h = r.choice(["<h2>{}</h2>", "<h3>{}</h3>", "<h4>{}</h4>"]).format(self.text(1, 5))
        return r.choice(
            [
                f"<nav>{self.menu()}</nav>",
                f'<div class="{r.choice(["menu", "navbar", "nav", "breadcrumb", "topnav"])}">{self.menu()}</div>',
                f"<header>{r.choice([f'<h1>{self.text(1, 5)}</h1>', ''])}{t(2, 8)}{r.choice(['', self.menu()])}</header>",
                f'<div class="{r.choice(["header", "banner", "site-header"])}">{t(1, 8)}{link}</div>',
                f"<footer>{r.choice(['&copy; ', ''])}{t(1, 14)}{r.choice(['', link, self.menu()])}</footer>",
                f'<div {r.choice(["id", "class"])}="{r.choice(["footer", "copyright", "legal", "site-footer"])}">{t(3, 30)}{link}</div>',
                f'<div class="{r.choice(["ad", "ads", "advert", "sponsored", "promo", "ad banner"])}">{t(2, 40)}</div>',
                f"<aside>{h}{r.choice([self.menu(), ''])}{t(4, 40)}</aside>",
                f'<div class="{r.choice(["sidebar", "related", "widget", "share social"])}">{h}{r.choice([self.menu(), t(3, 30)])}</div>',
                f'<div class="{r.choice(["cookie notice", "cookie-banner", "consent", "notice", "popup"])}">{t(5, 40)}</div>',
                f'<form class="{r.choice(["newsletter", "search", "login", "subscribe"])}"><label>{self.text(1, 6)}</label>{t(2, 15)}<input name="x"></form>',
                self.comments(),
            ]
        )

    def comments(self) -> str:
        name = self.r.choice(['section class="comments"', 'div id="comments"', 'div class="comment-list"', 'ol class="commentlist"', 'div class="replies discussion"'])
        inner = "".join(f'<div class="{self.r.choice(["comment", "reply"])}">{self.some(3, 60)}</div>' for _ in range(self.r.randint(1, 6)))
        return f"<{name}><h3>{self.text(1, 3)}</h3>{inner}</{name.split()[0]}>"

    def name(self) -> str:
        """A class or id that says nothing."""
        r = self.r
        return "".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=r.randint(2, 9))) + r.choice(["", "", f"-{r.randint(1, 999)}", f" {r.choice(self.words)}"])

    def wrapped(self, inner: str) -> str:
        r = self.r
        kind = r.random()
        if kind < 0.35:
            open_, close = r.choice([("<article>", "</article>"), ("<main>", "</main>"), ("<main><article>", "</article></main>"), ('<div class="content">', "</div>"), ('<div id="content"><div class="post">', "</div></div>"), ('<div class="article-body">', "</div>"), ('<section class="entry">', "</section>"), ('<div class="main">', "</div>")])
        elif kind < 0.6:
            open_, close = "", ""
        elif kind < 0.72:
            open_, close = "<div>", "</div>"
        else:
            open_, close = r.choice([(f'<div class="{self.name()}">', "</div>"), (f'<div id="{self.name()}">', "</div>"), (f'<section id="{self.name()}">', "</section>"), (f'<table><tr><td class="{self.name()}">', "</td></tr></table>"), (f'<div class="{r.choice(["story", "post", "text", "body"])}">', "</div>")])
        return open_ + inner + (close if r.random() < 0.95 else "")

    def article(self) -> str:
        r, out = self.r, [f"<{h}>{self.good(1, 14)}</{h}>" for h in [self.r.choice(["h1", "h1", "h1", "h2"])] if self.r.random() < 0.9]
        short = r.random() < 0.25
        for _ in range(r.randint(1, 3) if short else r.randint(1, 16)):
            kind = r.random()
            if kind < 0.72:
                words = r.choice([(1, 3), (3, 20)]) if short else r.choice([(1, 4), (4, 40), (10, 140)])
                out.append(f"<p>{self.good(*words)}" + ("</p>" if r.random() < 0.7 else "") if r.random() < 0.85 else f"<p><b>{self.good(2, 30)}<br>")
            elif kind < 0.80:
                out.append(f"<h2>{self.good(1, 8)}</h2>")
            elif kind < 0.85:
                out.append("<ul>" + "".join(f"<li>{self.good(2, 20)}</li>" for _ in range(r.randint(2, 6))) + "</ul>")
            elif kind < 0.89:
                out.append(f"<blockquote>{self.good(5, 60)}</blockquote>")
            elif kind < 0.92:
                out.append(f"<table><tr><td>{self.good(1, 6)}</td><td>{self.good(1, 6)}</td></tr></table>")
            elif kind < 0.94:
                out.append(f"<pre>{self.good(3, 40)}</pre>")
            else:
                out.append(r.choice([f'<div class="ad">{self.text(2, 40)}</div>', f"<aside><p>{self.text(3, 40)}</p></aside>", f'<div class="share">{self.menu()}</div>', f"<form><p>{self.text(2, 12)}</p></form>"]))
        if r.random() < 0.1:
            out.append(self.comments())
        return self.wrapped("".join(out))

    def page(self) -> str:
        r = self.r
        parts = [self.boilerplate() for _ in range(r.randint(0, 4))] + ([self.article()] if r.random() < 0.97 else []) + [self.boilerplate() for _ in range(r.randint(0, 4))]
        inner = "".join(parts)
        for _ in range(r.choice([0, 0, 0, 1, 2])):
            inner = f'<div {r.choice(["id", "class"])}="{r.choice([self.name(), "wrapper", "container", "page"])}">{inner}</div>'
        return f"<html><head><title>{self.text(2, 6)}</title></head><body>{inner}</body></html>"

    def labelled(self) -> tuple[np.ndarray, np.ndarray]:
        blocks = blocks_of(self.page())
        y = np.array([self.MARK in b.text for b in blocks], np.float32)
        for b in blocks:
            b.text = b.text.replace(self.MARK, "").strip() or "."
        return features(blocks), y


@lru_cache(maxsize=2)
def trained(pages: int = PAGES, rounds: int = ROUNDS, seed: int = SEED) -> Labeller:
    """The labeller, fitted with Adam on made-up pages; the same weights each time."""
    maker = PageMaker(seed)
    data = [d for d in (maker.labelled() for _ in range(pages)) if len(d[0])]
    model = Labeller.start(PATH_SIZE + WORD_SIZE + SHARES, seed)
    first = {k: np.zeros_like(v) for k, v in model.weights.items()}
    second = {k: np.zeros_like(v) for k, v in model.weights.items()}
    rng, n = np.random.default_rng(seed), 0
    for rate in np.geomspace(*RATES, rounds):
        order = rng.permutation(len(data))
        for at in range(0, len(order), 16):
            batch = [data[i] for i in order[at : at + 16]]
            x, mask = padded([b[0] for b in batch])
            y, _ = padded([b[1][:, None] for b in batch])
            n += 1
            for k, g in model.step(x, mask, y[..., 0]).items():
                g = np.clip(g, -1, 1)
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.01 * (g * g - second[k])
                model.weights[k] = model.weights[k] - (rate * (first[k] / (1 - 0.9**n)) / (np.sqrt(second[k] / (1 - 0.99**n)) + 1e-8)).astype(np.float32)
    return model


def main_texts(pages: list[str], model: Labeller) -> list[str]:
    """The article of each page: blocks that the labeller keeps, joined by spaces."""
    read = [blocks_of(p) for p in pages]
    out = [""] * len(pages)
    order = sorted((i for i in range(len(pages)) if read[i]), key=lambda i: len(read[i]))
    at = 0
    while at < len(order):
        to = at + 1
        while to < len(order) and (to - at + 1) * len(read[order[to]]) <= BATCH_BLOCKS:
            to += 1
        group = order[at:to]
        x, mask = padded([features(read[i]) for i in group])
        keep = model.logits(x, mask) > 0
        for k, i in enumerate(group):
            out[i] = " ".join(b.text for b, kept in zip(read[i], keep[:, k], strict=False) if kept)
        at = to
    return out


def extract_text(pages: DataFrame, html_col: str = "html", out: str = "main_text") -> DataFrame:
    """pages with the article's text added (a column of that name is replaced). Null and empty pages have an empty text.

    White space inside a block becomes one space, blocks stand in page order with a space between. No shuffle; a
    page's work and memory follow its own length, however deep its elements lie. Repeated rows give the same text again;
    an empty table gives no rows. Other columns stay as they are, whatever their names.
    """
    pages = pages.drop(out)
    schema = StructType.fromJson(pages.schema.jsonValue()).add(out, "string")
    shared = pages.sparkSession.sparkContext.broadcast(trained())
    arrow = to_arrow_schema(schema)
    at = pages.columns.index(html_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, BATCH_PAGES):
                batch = whole.slice(k, BATCH_PAGES)
                texts = main_texts([h or "" for h in batch.column(at).to_pylist()], shared.value)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], arrow.names)

    small_batches(pages.sparkSession)
    return pages.mapInArrow(run, schema)


def op7_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.selectExpr("page_id", "url", "main_text AS text", "cast(length(main_text) AS bigint) AS n_chars")
