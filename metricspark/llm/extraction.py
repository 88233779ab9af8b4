"""Main text of HTML pages by a linear-chain conditional random field over leaf blocks."""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricspark.llm.html_blocks import NAMES, Block, blocks

OTHER, MAIN = 0, 1


def features(block: Block, first: bool, last: bool) -> list[str]:
    """Ancestor-tag features and text features of a leaf block."""
    place = block.place
    out = {f"in:{tag}" for tag in place.tags}
    out.add(f"own:{place.own}")
    # Names of the page's own body say little of a block.
    out.update(f"name:{k}" for k in place.kinds)
    if place.hidden:
        out.add("hidden")
    home = bool({"article", "main"} & place.tags) or "main" in place.kinds
    out.add(f"home:{home}:boiler:{place.boiler}")
    n = len(block.text)
    out.add(f"length:{min(7, n.bit_length() // 2)}")
    linked = block.linked / max(1, n)
    out.add("linked:" + ("none" if not block.links else "some" if linked < 0.35 else "most"))
    out.add("ends:" + ("stop" if block.text[-1] in ".!?…\"”'" else "other"))
    if block.text[0] in "©®":
        out.add("mark")
    out.add(f"words:{min(6, block.text.count(' ').bit_length())}")
    if block.boxes:
        out.add("input")
    if first:
        out.add("first")
    if last:
        out.add("last")
    out.add("bias")
    return sorted(out)


def page_features(found: list[Block]) -> list[list[str]]:
    return [features(b, i == 0, i == len(found) - 1) for i, b in enumerate(found)]


@dataclass
class Chain:
    """Weights of features per label, of label pairs, and of the first label."""

    number: dict[str, int]
    emit: np.ndarray
    step: np.ndarray
    start: np.ndarray

    def decode(self, rows: list[list[str]]) -> list[int]:
        """The likeliest labels (Viterbi); ties go to OTHER."""
        if not rows:
            return []
        number, emit = self.number, self.by_feature
        a, b = self.first
        (oo, om), (mo, mm) = self.steps
        back: list[tuple[int, int]] = []
        for at, row in enumerate(rows):
            e0 = e1 = 0.0
            for f in row:
                i = number.get(f)
                if i is not None:
                    e0 += emit[i][0]
                    e1 += emit[i][1]
            if at == 0:
                s0, s1 = a + e0, b + e1
                continue
            from0, from1 = s0 + oo, s1 + mo
            to0 = from0 if from0 >= from1 else from1
            via0 = OTHER if from0 >= from1 else MAIN
            from0, from1 = s0 + om, s1 + mm
            to1 = from0 if from0 >= from1 else from1
            via1 = OTHER if from0 >= from1 else MAIN
            back.append((via0, via1))
            s0, s1 = to0 + e0, to1 + e1
        label = OTHER if s0 >= s1 else MAIN
        out = [label]
        for via in reversed(back):
            label = via[label]
            out.append(label)
        return out[::-1]

    def decode_some(self, rows: list[list[str]], allowed: list[bool]) -> list[int]:
        """The likeliest labels of which one at least is MAIN, at allowed blocks only: Viterbi over
        before, in and behind. All are OTHER if no block is allowed."""
        if not any(allowed):
            return [OTHER] * len(rows)
        (oo, om), (mo, mm) = self.steps
        before, inside, behind = 0.0, float("-inf"), float("-inf")
        back: list[tuple[int, int]] = []
        for at, (row, may) in enumerate(zip(rows, allowed)):
            weights = [self.by_feature[i] for f in row if (i := self.number.get(f)) is not None]
            e0, e1 = sum(w[0] for w in weights), sum(w[1] for w in weights) if may else float("-inf")
            if at == 0:
                before, inside = self.first[0] + e0, self.first[1] + e1
                continue
            to_inside = max((before + om, 0), (inside + mm, 1), (behind + om, 2))
            to_behind = max((inside + mo, 1), (behind + oo, 2))
            back.append((to_inside[1], to_behind[1]))
            before, inside, behind = before + oo + e0, to_inside[0] + e1, to_behind[0] + e0
        state = 1 if inside >= behind else 2
        out = [state]
        for via in reversed(back):
            state = via[state - 1] if state else 0
            out.append(state)
        return [MAIN if state == 1 else OTHER for state in reversed(out)]

    def __post_init__(self) -> None:
        self.by_feature = self.emit.tolist()
        self.first = self.start.tolist()
        self.steps = self.step.tolist()


def fit_chain(pages: list[tuple[list[list[str]], list[int]]], rounds: int = 150, penalty: float = 0.05) -> Chain:
    """Maximum likelihood with an L2 penalty: gradients by forward-backward over all pages at
    once (padded), steps by Adam."""
    pages = [p for p in pages if p[0]]
    names = sorted({f for rows, _ in pages for row in rows for f in row})
    number = {f: i for i, f in enumerate(names)}
    n, longest = len(pages), max((len(r) for r, _ in pages), default=1)
    x = np.zeros((n, longest, len(names)), dtype=np.float32)
    y = np.zeros((n, longest), dtype=np.int64)
    on = np.zeros((n, longest), dtype=bool)
    for p, (rows, labels) in enumerate(pages):
        on[p, : len(rows)] = True
        y[p, : len(rows)] = labels
        for t, row in enumerate(rows):
            x[p, t, [number[f] for f in row]] = 1
    flat = x[on]
    want_emit = np.stack([flat[y[on] == k].sum(axis=0) for k in (0, 1)], axis=1).astype(float)
    pairs = on[:, 1:] & on[:, :-1]
    want_step = np.array([[(pairs & (y[:, :-1] == a) & (y[:, 1:] == b)).sum() for b in (0, 1)] for a in (0, 1)], dtype=float)
    want_start = np.array([(y[:, 0] == k).sum() for k in (0, 1)], dtype=float)
    emit, step, start = np.zeros((len(names), 2)), np.zeros((2, 2)), np.zeros(2)
    moments = [[np.zeros_like(v), np.zeros_like(v)] for v in (emit, step, start)]
    for k in range(1, rounds + 1):
        scores = np.full((n, longest, 2), 0.0)
        scores[on] = flat @ emit
        forward = np.zeros((n, longest, 2))
        backward = np.zeros((n, longest, 2))
        forward[:, 0] = scores[:, 0] + start
        for t in range(1, longest):
            reach = np.logaddexp.reduce(forward[:, t - 1, :, None] + step[None], axis=1) + scores[:, t]
            forward[:, t] = np.where(on[:, t, None], reach, forward[:, t - 1])
        for t in range(longest - 2, -1, -1):
            reach = np.logaddexp.reduce(step[None] + (scores[:, t + 1] + backward[:, t + 1])[:, None, :], axis=2)
            backward[:, t] = np.where(on[:, t + 1, None], reach, backward[:, t + 1])
        total = np.logaddexp.reduce(forward[:, -1], axis=1)
        single = np.exp(forward + backward - total[:, None, None])
        double = np.exp(
            forward[:, :-1, :, None] + step + (scores[:, 1:] + backward[:, 1:])[:, :, None, :] - total[:, None, None, None]
        )
        slopes = (
            flat.T @ single[on] - want_emit + penalty * emit,
            (double * pairs[:, :, None, None]).sum(axis=(0, 1)) - want_step + penalty * step,
            single[:, 0].sum(axis=0) - want_start + penalty * start,
        )
        for value, slope, (m, v) in zip((emit, step, start), slopes, moments):
            m += 0.1 * (slope - m)
            v += 0.001 * (slope * slope - v)
            value -= 0.1 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-8)
    return Chain(number, emit, step, start)


# --- labelled pages ------------------------------------------------------------------


def sample_pages(number: int, seed: int = 7, bare: bool = False) -> list[tuple[list[list[str]], list[int]]]:
    """Labelled pages made by rule: an article amid boxes drawn at random, in several styles
    of markup, or bare pages, which mark nothing. The label of a block is known from the box
    it was put into."""
    draw = random.Random(seed)
    pages = []
    while len(pages) < number:
        page = _bare_page(draw) if bare else _made_page(draw)
        found = blocks(page)
        labels = [MAIN if b.text.startswith("MAIN") else OTHER for b in found]
        for b in found:
            b.text = b.text.removeprefix("MAIN").strip() or "x"
        if MAIN in labels:
            pages.append((page_features(found), labels))
    return pages


def _words(draw: random.Random, least: int, most: int, stop: bool = True) -> str:
    n = draw.randint(least, most)
    text = " ".join("".join(draw.choice("abdeilmnorstu") for _ in range(draw.randint(2, 9))) for _ in range(n))
    return text.capitalize() + ("." if stop else "")


def _box(draw: random.Random, kind: str) -> str:
    """A box that is no article, with a tag or a name of its kind."""
    name = draw.choice(NAMES[kind].split())
    tag = {"menu": "nav", "frame": draw.choice(["header", "footer"]), "side": "aside", "form": "form"}.get(kind, "div")
    tag = tag if draw.random() < 0.6 else draw.choice(["div", "section", "ul", "div"])
    label = f' {draw.choice(["class", "id"])}="{name}"' if tag in ("div", "section", "ul") or draw.random() < 0.4 else ""
    if kind == "menu" or draw.random() < 0.2:
        inner = "".join(f'<li><a href="/x">{_words(draw, 1, 3, False)}</a></li>' for _ in range(draw.randint(2, 7)))
        inner = inner if tag == "ul" else f"<ul>{inner}</ul>"
    elif kind == "form":
        inner = f"<label>{_words(draw, 1, 3, False)}</label><input name=q><button>{_words(draw, 1, 1, False)}</button>"
    elif kind == "reader":
        inner = "".join(f"<div><p>{_words(draw, 3, 60)}</p></div>" for _ in range(draw.randint(1, 5)))
        inner = f"<h3>{_words(draw, 1, 3, False)}</h3>{inner}" if draw.random() < 0.6 else inner
    else:
        mark = "&copy; " if kind == "frame" and draw.random() < 0.5 else ""
        text = mark + _words(draw, 2, 40 if kind in ("notice", "advert", "side") else 15, draw.random() < 0.7)
        inner = f"<p>{text}</p>" if draw.random() < 0.5 else text
    return f"<{tag}{label}>{inner}</{tag}>"


def _article(draw: random.Random) -> str:
    """Headings, paragraphs, lists and quotes of an article, now and then with a box inside."""
    out = [f"<h1>MAIN {_words(draw, 2, 10, draw.random() < 0.5)}</h1>"]
    for _ in range(draw.randint(1, 12)):
        kind = draw.random()
        text = f"MAIN {_words(draw, 1, 90)}"
        if kind < 0.72:
            link = f' <a href="/y">{_words(draw, 1, 3, False)}</a>' if draw.random() < 0.15 else ""
            out.append(f"<p>{'<b>' if draw.random() < 0.1 else ''}{text}{link}</p>")
        elif kind < 0.8:
            out.append(f"<h{draw.randint(2, 4)}>MAIN {_words(draw, 1, 6, False)}</h2>")
        elif kind < 0.88:
            out.append("<ul>" + "".join(f"<li>MAIN {_words(draw, 1, 20)}</li>" for _ in range(draw.randint(1, 4))) + "</ul>")
        elif kind < 0.92:
            out.append(f"<blockquote>{text}</blockquote>")
        elif kind < 0.95:
            out.append(f"<pre>MAIN {_words(draw, 2, 20, False)}</pre>")
        elif kind < 0.97:
            out.append(f"<table><tr><td>MAIN {_words(draw, 1, 4)}</td><td>MAIN {_words(draw, 1, 4)}</td></tr></table>")
        else:
            out.append(_box(draw, draw.choice(["advert", "share", "notice", "side"])))
    style = draw.random()
    body = "".join(out)
    if style < 0.55:
        return f"<article>{body}</article>"
    if style < 0.75:
        return f'<main><div class="{draw.choice(["content", "post", "entry"])}">{body}</div></main>'
    return f'<div {draw.choice(["class", "id"])}="{draw.choice(["content", "article", "post", "story", "main"])}">{body}</div>'


def _made_page(draw: random.Random) -> str:
    before = [_box(draw, k) for k in ("menu", "frame", "notice", "advert", "form", "menu") if draw.random() < 0.45]
    after = [_box(draw, k) for k in ("share", "reader", "side", "advert", "form", "frame", "notice") if draw.random() < 0.4]
    draw.shuffle(before)
    return f"<!DOCTYPE html><html><head><title>x</title></head><body>{''.join(before)}{_article(draw)}{''.join(after)}</body></html>"


def _bare_page(draw: random.Random) -> str:
    """A page that marks nothing by names or telling tags: plain text, paragraphs, boxes without
    names, or a layout by table, with a line of links or a closing line in some."""
    links = lambda sep: sep.join(f'<a href="/x">{_words(draw, 1, 3, False)}</a>' for _ in range(draw.randint(2, 7)))
    title = f"<h{draw.randint(1, 2)}>MAIN {_words(draw, 2, 9, False)}</h2>" if draw.random() < 0.5 else ""
    body = title + "".join(f"<p>MAIN {_words(draw, 6, 80)}</p>" for _ in range(draw.choice([1, 1, 2, 3, 5, 8])))
    closing = draw.choice(["&copy; ", ""]) + _words(draw, 2, 6, False)
    style = draw.choice(["plain", "paragraphs", "main", "boxes", "table", "table"])
    if style == "plain":
        return f"MAIN {_words(draw, 3, 120)}"
    if style == "paragraphs":
        return body
    if style == "main":
        return f"<main>{body}</main><p>{closing}</p>"
    if style == "boxes":
        return f"<body><div>{links(' | ')}</div><div>{body}</div><div>{closing}</div></body>"
    menu = links("<br>") if draw.random() < 0.5 else f"<ul><li>{links('</li><li>')}</li></ul>"
    return f"<table><tr><td>{menu}</td><td>{body}</td></tr><tr><td>{closing}</td></tr></table>"


def trusted_labels(found: list[Block]) -> list[int] | None:
    """Labels of a page that marks its article as such, from its tags; None for other pages."""
    if not any(b.place.article for b in found):
        return None
    return [MAIN if b.place.article and not b.place.apart and not b.place.kinds - {"main"} else OTHER for b in found]


def train(pages: DataFrame, made: int = 400, rows: int = 200, blocks_of: int = 200) -> Chain:
    """Fit the chain on ``made`` pages labelled by rule, half as many bare ones, and at most ``rows`` pages of the
    table, taken in the order of a hash of page_id, whose own tags label them. Of a page
    with more than ``blocks_of`` blocks, the fit (not the extraction) takes the first."""
    drawn = pages.where(F.col("html").isNotNull()).select("page_id", "html").orderBy(F.xxhash64("page_id"), "page_id").limit(rows)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = []
            for page in batch.column(0):
                found = blocks(page.as_py())[:blocks_of]
                labels = trusted_labels(found)
                if labels is not None:
                    held.append((page_features(found), labels))
            lists = pa.list_(pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([h[0] for h in held], lists), pa.array([h[1] for h in held], pa.list_(pa.int32()))], ["rows", "labels"]
            )

    labelled = drawn.select("html").mapInArrow(label, "rows array<array<string>>, labels array<int>").collect()
    learned = sample_pages(made) + sample_pages(made // 2, bare=True) + [([list(r) for r in p["rows"]], list(p["labels"])) for p in sorted(labelled)]
    return fit_chain(learned)


def _may_be_text(block: Block) -> bool:
    """Not marked as something else, and not made of links or fields."""
    return not (block.place.boiler or block.place.hidden or block.boxes or block.links and block.linked * 2 > len(block.text))


def page_labels(found: list[Block], chain: Chain) -> list[int]:
    """The likeliest labels of a page. If none is MAIN, the likeliest with one at least: a page
    has some text unless all of its blocks are marked as something else, links or fields."""
    rows = page_features(found)
    labels = chain.decode(rows)
    return labels if MAIN in labels else chain.decode_some(rows, [_may_be_text(b) for b in found])


def main_text(page: str | None, chain: Chain) -> str:
    """The blocks that the chain labels as the article, in page order, joined by one blank."""
    found = blocks(page)
    return " ".join(b.text for b, label in zip(found, page_labels(found, chain)) if label == MAIN)


def extract_main_text(pages: DataFrame, chain: Chain) -> DataFrame:
    """``pages`` with columns text, the main text of the whole html, and n_chars, its length.

    Null, empty and text-free pages, and pages whose every block is marked as something else, give
    an empty text. Time grows with the length of a page, not with its depth. Every row and column of ``pages``
    comes back; columns named text or n_chars are replaced. No shuffle; the chain, some
    hundred weights, goes to the tasks with the function.
    """

    @F.arrow_udf("string")
    def extract(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([main_text(page.as_py(), chain) for page in batch], pa.string())

    out = pages.withColumn("text", extract(F.col("html").cast("string")))
    return out.withColumn("n_chars", F.length("text").cast("bigint"))
