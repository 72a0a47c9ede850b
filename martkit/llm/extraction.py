"""Main text of web pages by a recurrent block labeller.

A bidirectional LSTM in numpy reads a page's blocks - vectors of the hashed tag path and of the hashed words, and some
numbers - and labels each as article or not with the whole page in view. It is trained here on a bounded sample of pages
(``train_pages``, by the order of a hash of the page id). Their blocks are labelled by the page's own landmarks (article,
main, and elements that never hold an article), and each page is also laid out anew in other ways, with menus, notices,
forms, adverts, side columns and comments around and inside its article, so that the model learns layouts that the sample
lacks.

Cases: null or empty pages, and pages without blocks, give an empty text. Repeated rows and ids are rows of their own.
Without any page there is nothing to train and nothing to label. Clashing extra columns are ignored.
"""

from __future__ import annotations

import html
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkit.llm.common import need
from martkit.llm.html_blocks import NUMBERS, TAGS, WORDS, Block, blocks, features

TRAIN_PAGES, EPOCHS, LEAST_STEPS, RATE = 400, 6, 150, 0.01
WIDTH, HIDDEN = 12, 16

TEXT = "page_id long, url string, text string, n_chars long"

#: Elements that hold an article, and elements and class words that never do.
ARTICLE = {"<article", "<main", ".main"}
NEVER = {"<nav", "<header", "<footer", "<aside", "<form", "<head", "<title", "<menu", "<button", "<select", "<label"}
NEVER_NAMED = {"." + w for w in "ad ads advert advertisement sponsored promo nav menu sidebar footer comment comments cookie notice banner share social related newsletter breadcrumb".split()}


def labels(found: list[Block]) -> np.ndarray:
    """Which blocks are article, by landmarks; without any, long blocks outside the elements that never hold one."""
    outside = [bool(NEVER & set(b.path) or NEVER_NAMED & set(b.path)) for b in found]
    inside = [bool(ARTICLE & set(b.path)) for b in found]
    if not any(inside):
        inside = [len(b.text.split()) >= 20 for b in found]
    return np.array([i and not o for i, o in zip(inside, outside)], np.float32)


def lay_out(article: list[str], other: list[str], prose: list[str], draw: random.Random) -> tuple[str, list[bool]]:
    """A page made of these texts in a layout drawn at random, and the label of each of its blocks in order."""
    out, marks = [], []
    some = lambda pool, low, high: [draw.choice(pool) for _ in range(draw.randint(low, high))] if pool else []

    def put(texts, mark, before, after):
        out.append(before)
        for t in texts:
            tag = draw.choice(("p", "p", "p", "p", "div", "li", "blockquote", "h2", "dd", "td")) if mark else draw.choice(("p", "p", "div", "li", "h2", "h3"))
            # an article has lists, quotations, headings and tables, too
            left, right = {"li": ("<ol>", "</ol>"), "dd": ("<dl>", "</dl>"), "td": ("<table><tr>", "</tr></table>")}.get(tag, ("", "")) if mark else ("", "")
            out.append(f"{left}<{tag}>{html.escape(t)}</{tag}>{right}")
            marks.append(mark)
        out.append(after)

    def around(kinds):
        for kind in kinds:
            if kind == "menu":
                tag, name = draw.choice((("nav", ""), ("ul", "menu"), ("div", "nav"), ("div", "breadcrumb"), ("div", "topbar")))
                texts = [f"{' '.join(t.split()[:3])}" for t in some(other or prose, 2, 7)]
                out.append(f'<{tag} class="{name}">' + "".join(f'<li><a href="/x">{html.escape(t)}</a></li>' for t in texts) + f"</{tag}>")
                marks.extend([False] * len(texts))
            elif kind == "form":
                put([" ".join(t.split()[:4]) for t in some(other or prose, 1, 2)], False, draw.choice(('<form class="search">', '<div class="newsletter"><form>')), "</form>")
            elif kind == "comments":
                before, after = draw.choice((('<section class="comments">', "</section>"), ('<div id="comments">', "</div>"), ('<ul class="comment-list">', "</ul>"), ('<div class="comment">', "</div>")))
                put(some(prose, 1, 4), False, before, after)
            else:
                before, after = draw.choice({
                    "header": (("<header>", "</header>"), ('<div class="header">', "</div>"), ('<div id="masthead">', "</div>")),
                    "notice": (('<div class="cookie-notice">', "</div>"), ('<div class="banner" role="alert">', "</div>"), ('<div class="notice">', "</div>")),
                    "ad": (('<div class="ad">', "</div>"), ('<aside class="promo">', "</aside>"), ('<div class="sponsored">', "</div>"), ('<div class="advert">', "</div>")),
                    "side": (("<aside>", "</aside>"), ('<div class="sidebar">', "</div>"), ('<div class="related">', "</div>"), ('<div class="widget">', "</div>")),
                    "footer": (("<footer>", "</footer>"), ('<div id="footer">', "</div>"), ('<div class="site-footer">', "</div>")),
                }[kind])
                put(some(other + prose, 1, 3), False, before, after)

    pick = lambda pool, high: draw.sample(pool, draw.randint(0, min(high, len(pool))))
    out.append("<html><body>")
    around(pick(["header", "menu", "notice", "ad", "form"], 4))
    box, end = draw.choice((
        ("<article>", "</article>"), ("<main>", "</main>"), ("<main><article>", "</article></main>"), ('<div class="content">', "</div>"), ('<div id="content">', "</div>"),
        ('<div class="post">', "</div>"), ('<div class="entry-content">', "</div>"), ('<div id="main"><div class="story">', "</div></div>"), ('<section class="article-body">', "</section>"),
    ))
    out.append(box)
    if draw.random() < 0.3:
        around(pick(["menu", "ad", "notice"], 1))
    cut = draw.randint(0, len(article))
    if article:
        out.append(f"<h1>{html.escape(article[0])}</h1>")
        marks.append(True)
    put(article[1 : max(1, cut)], True, "", "")
    if draw.random() < 0.4:
        around([draw.choice(("ad", "side", "form"))])
    put(article[max(1, cut) :], True, "", "")
    if draw.random() < 0.3:
        around(["comments"])
    out.append(end)
    around(pick(["comments", "side", "ad", "form", "menu"], 3) + pick(["footer"], 1))
    return "".join(out), marks


def new_model(draw: np.random.Generator) -> dict[str, np.ndarray]:
    wide = 2 * WIDTH + NUMBERS
    model = {"tags": draw.normal(0, 0.3, (TAGS, WIDTH)), "words": draw.normal(0, 0.1, (WORDS, WIDTH)), "out": draw.normal(0, 0.2, 2 * HIDDEN), "out_b": np.zeros(1)}
    for way in "fb":
        model[f"{way}x"] = draw.normal(0, wide**-0.5, (wide, 4 * HIDDEN))
        model[f"{way}h"] = draw.normal(0, HIDDEN**-0.5, (HIDDEN, 4 * HIDDEN))
        model[f"{way}c"] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])  # input, forget, output, cell
    return {k: v.astype(np.float32) for k, v in model.items()}


def _means(table: np.ndarray, lists: list[np.ndarray]) -> np.ndarray:
    """The mean of the table's rows for each list; zero for an empty one."""
    sizes = np.array([len(x) for x in lists], np.int64)
    out = np.zeros((len(lists), table.shape[1]), np.float32)
    some = np.flatnonzero(sizes)
    if len(some):
        rows = table[np.concatenate([lists[k] for k in some])]
        out[some] = np.add.reduceat(rows, np.cumsum(sizes[some]) - sizes[some], axis=0) / sizes[some][:, None]
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _pack(model: dict, pages: list) -> tuple[np.ndarray, np.ndarray]:
    """Inputs as (steps, pages, width) with zeros behind short pages, and the mask of real blocks."""
    longest = max(len(p[2]) for p in pages)
    x = np.zeros((longest, len(pages), 2 * WIDTH + NUMBERS), np.float32)
    mask = np.zeros((longest, len(pages)), np.float32)
    for k, (paths, words, numbers) in enumerate(pages):
        n = len(numbers)
        x[:n, k] = np.concatenate([_means(model["tags"], paths), _means(model["words"], words), numbers], axis=1)
        mask[:n, k] = 1
    return x, mask


def _run(model: dict, way: str, x: np.ndarray, mask: np.ndarray, keep: list | None) -> np.ndarray:
    """One direction over all steps. Behind a short page's end the state stands still, so backward runs start clean."""
    steps, many, _ = x.shape
    h = np.zeros((many, HIDDEN), np.float32)
    c = np.zeros((many, HIDDEN), np.float32)
    fed = x @ model[f"{way}x"] + model[f"{way}c"]
    out = np.empty((steps, many, HIDDEN), np.float32)
    for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
        z = fed[t] + h @ model[f"{way}h"]
        gates = _sigmoid(z[:, : 3 * HIDDEN])
        i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
        g = np.tanh(z[:, 3 * HIDDEN :])
        m = mask[t][:, None]
        after = f * c + i * g
        th = np.tanh(after)
        if keep is not None:
            keep.append((t, h, c, i, f, o, g, th, m))
        c = m * after + (1 - m) * c
        h = m * (o * th) + (1 - m) * h
        out[t] = h
    return out


def score(model: dict, pages: list) -> list[np.ndarray]:
    """Probability of being article for each block of each page; pages of like length are run together."""
    out = [np.zeros(0, np.float32)] * len(pages)
    order = sorted((k for k in range(len(pages)) if len(pages[k][2])), key=lambda k: len(pages[k][2]))
    for at in range(0, len(order), 64):
        some = order[at : at + 64]
        x, mask = _pack(model, [pages[k] for k in some])
        both = np.concatenate([_run(model, "f", x, mask, None), _run(model, "b", x, mask, None)], axis=2)
        p = _sigmoid(both @ model["out"] + model["out_b"])
        for j, k in enumerate(some):
            out[k] = p[: len(pages[k][2]), j]
    return out


def _gradient(model: dict, pages: list, marks: list) -> tuple[float, dict[str, np.ndarray]]:
    x, mask = _pack(model, pages)
    kept = {"f": [], "b": []}
    both = np.concatenate([_run(model, w, x, mask, kept[w]) for w in "fb"], axis=2)
    p = _sigmoid(both @ model["out"] + model["out_b"])
    y = np.zeros_like(mask)
    for k, m in enumerate(marks):
        y[: len(m), k] = m
    total = mask.sum()
    loss = float(-(mask * (y * np.log(p + 1e-7) + (1 - y) * np.log(1 - p + 1e-7))).sum() / total)
    d = mask * (p - y) / total
    grad = {k: np.zeros_like(v) for k, v in model.items()}
    grad["out"] = np.einsum("tn,tnh->h", d, both)
    grad["out_b"][0] = d.sum()
    dx = np.zeros_like(x)
    for k, w in enumerate("fb"):
        from_out = d[:, :, None] * model["out"][k * HIDDEN : (k + 1) * HIDDEN]
        dh = np.zeros((x.shape[1], HIDDEN), np.float32)
        dc = np.zeros_like(dh)
        for t, h, c, i, f, o, g, th, m in reversed(kept[w]):
            dh = dh + from_out[t]
            live = dh * m
            dafter = dc * m + live * o * (1 - th * th)
            dz = np.concatenate([dafter * g * i * (1 - i), dafter * c * f * (1 - f), live * th * o * (1 - o), dafter * i * (1 - g * g)], axis=1)
            grad[f"{w}x"] += x[t].T @ dz
            grad[f"{w}h"] += h.T @ dz
            grad[f"{w}c"] += dz.sum(axis=0)
            dx[t] += dz @ model[f"{w}x"].T
            dh = dz @ model[f"{w}h"].T + dh * (1 - m)
            dc = dafter * f + dc * (1 - m)
    for k, (paths, words, numbers) in enumerate(pages):
        for name, lists, low in (("tags", paths, 0), ("words", words, WIDTH)):
            for t, places in enumerate(lists):
                if len(places):
                    np.add.at(grad[name], places, dx[t, k, low : low + WIDTH] / len(places))
    return loss, grad


def train(pages: list[str], epochs: int = EPOCHS, seed: int = 7, at_once: int = 32) -> dict[str, np.ndarray] | None:
    """A model from these pages, each as it is and laid out anew; None without a page that has blocks."""
    draw, choose = random.Random(seed), np.random.default_rng(seed)
    read = [(b, labels(b)) for b in map(blocks, pages) if b]
    if not read:
        return None
    # where some pages have landmarks, the others' labels would be guesses
    read = [(b, m) for b, m in read if any(ARTICLE & set(x.path) for x in b)] or read
    prose = [x.text for b, m in read for x, mark in zip(b, m) if mark and len(x.text.split()) > 5][:5000] or [x.text for b, _ in read for x in b]
    sample = []
    for b, m in read:
        sample.append((features(b), m))
        article, other = [x.text for x, mark in zip(b, m) if mark], [x.text for x, mark in zip(b, m) if not mark]
        for _ in range(2):
            page, marks = lay_out(article, other, prose, draw)
            again = blocks(page)
            if len(again) == len(marks):
                sample.append((features(again), np.array(marks, np.float32)))
    model = new_model(choose)
    first, second = ({k: np.zeros_like(v) for k, v in model.items()} for _ in range(2))
    step = 0
    for _ in range(max(epochs, LEAST_STEPS * at_once // len(sample))):
        order = choose.permutation(len(sample))
        order = sorted(order, key=lambda k: len(sample[k][1]) // 8)
        batches = [order[a : a + at_once] for a in range(0, len(order), at_once)]
        for k in choose.permutation(len(batches)):
            _, grad = _gradient(model, [sample[j][0] for j in batches[k]], [sample[j][1] for j in batches[k]])
            norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
            step += 1
            for name, g in grad.items():
                g = g * min(1.0, 1.0 / (norm + 1e-9))
                first[name] += 0.1 * (g - first[name])
                second[name] += 0.01 * (g * g - second[name])
                model[name] -= RATE * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.99**step)) + 1e-6)
    return model


def text_of(found: list[Block], probability: np.ndarray) -> str:
    return "\n\n".join(b.text for b, p in zip(found, probability) if p > 0.5)


def fit(pages: DataFrame, train_pages: int = TRAIN_PAGES, id_col: str = "page_id", html_col: str = "html") -> dict[str, np.ndarray] | None:
    """A model from the ``train_pages`` pages that come first by a hash of their id."""
    need(pages, id_col, html_col)
    turn = F.pmod(F.xxhash64(F.col(f"`{id_col}`")), F.lit(1 << 31))
    first = pages.select(turn.alias("turn"), F.col(f"`{html_col}`").alias("html")).where("html IS NOT NULL")
    # four times the sample is looked through, else every task would send its first pages to the driver
    first = first.where(F.col("turn") <= min(1.0, 4 * train_pages / max(1, pages.count())) * (1 << 31))
    return train([r.html for r in first.orderBy("turn", "html").limit(train_pages).collect()])


def extract(pages: DataFrame, train_pages: int = TRAIN_PAGES, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    need(pages, id_col, url_col, html_col)
    model = fit(pages, train_pages, id_col, html_col)

    def work(batches):
        for b in batches:
            for at in range(0, b.num_rows, 256):
                some = b.slice(at, 256)
                found = [blocks(p) for p in some.column("html").to_pylist()]
                read = [features(x) for x in found]
                texts = [text_of(x, p) for x, p in zip(found, score(model, read))] if model else [""] * len(found)
                sizes = pa.array([len(t) for t in texts], pa.int64())
                yield pa.RecordBatch.from_arrays([some.column("page_id"), some.column("url"), pa.array(texts, pa.string()), sizes], names=["page_id", "url", "text", "n_chars"])

    plain = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").alias("url"), F.col(f"`{html_col}`").alias("html"))
    return plain.mapInArrow(work, TEXT)
