"""HTML extraction: a linear-chain conditional random field over the leaf blocks of a page.

A page is cut into its leaf blocks, the runs of text between block-level tags. A block's
features are its ancestors' tags, what their class, id and role names tell, its length, link
density, punctuation and place, the share of the page's text around it, and the blocks before
and after it. A telling name counts the less the more of the page's text its element holds, and
not at all on the page itself: a wrapper called "with-sidebar" is no sidebar. The field is trained on
labelled pages (``html_pages``) and labels all blocks of a page by Viterbi; the blocks of main
text are joined in page order.

Null pages count as empty. Pages without main text give an empty text; tags without an end,
unclosed comments and cut pages are read as far as they go; null and repeated ids and rows
give a row each; an empty table gives no row; further columns are ignored.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playpulse.llm.common import ship_code, slices, text_of
from playpulse.llm.crf import Crf, fit
from playpulse.llm.html_blocks import HINTS, Block, Element, parse
from playpulse.llm.html_pages import labelled_pages

TRAIN_PAGES = 500
JOIN = "\n\n"

ANCESTORS = "head nav header footer aside form article main section ul ol li table figure blockquote dl pre button select noscript".split()
OWN = "p h1 h2 h3 h4 li td th div section article body button option label figcaption title pre".split()
ANCESTOR_AT = {t: i for i, t in enumerate(ANCESTORS)}
OWN_AT = {t: len(ANCESTORS) + i for i, t in enumerate(OWN)}
HINT_AT = {h: i for i, h in enumerate(HINTS)}
FORM = 21  # features of length, links, punctuation and place
ENDS = tuple(".!?…。！？:;\"'»”)")


def told(e: Element, page_text: int) -> np.ndarray:
    """What an element's own names tell, each hint by the share of the page's text that is not in it."""
    out = np.zeros(len(HINTS))
    if e.hints:
        least = 1 - e.text / page_text
        for h in e.hints:
            out[HINT_AT[h]] = 1.0 if h in ("main", "meta") else least * (0.3 if e.holds else 1.0)
    return out


class Told:
    """Of a page's elements: hints near (the element and its parent) and far (further up), and tags around."""

    def __init__(self, page_text: int):
        self.page_text = page_text
        self.known: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        self.none = np.zeros(len(HINTS))

    def of(self, e: Element | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(own, all, tags) of an element; its ancestors are worked out first, each once."""
        if e is None:
            return self.none, self.none, np.zeros(len(ANCESTORS))
        way = []
        while e is not None and id(e) not in self.known:
            way.append(e)
            e = e.parent
        last = self.known[id(e)] if e is not None else (self.none, self.none, np.zeros(len(ANCESTORS)))
        for e in reversed(way):
            own = told(e, self.page_text) if e.hints else self.none
            every = np.maximum(last[1], own) if e.hints else last[1]
            tags = last[2]
            if e.tag in ANCESTOR_AT:
                tags = tags.copy()
                tags[ANCESTOR_AT[e.tag]] = 1
            last = self.known[id(e)] = (own, every, tags)
        return last


def block_features(blocks: list[Block]) -> np.ndarray:
    """A row of features for each block of one page."""
    n, hints = len(blocks), len(HINTS)
    own = np.zeros((n, len(ANCESTORS) + len(OWN) + 2 * hints + FORM))
    near_at = len(ANCESTORS) + len(OWN)
    base = near_at + 2 * hints
    page_text = max(1, sum(max(0, b.size - b.linked) for b in blocks))
    told_of = Told(page_text)
    articles = [any(told_of.of(b.at)[2][ANCESTOR_AT[t]] for t in ("article", "main")) for b in blocks]
    some_article = any(articles)
    for i, b in enumerate(blocks):
        row, e = own[i], b.at
        over = e.parent if e is not None else None
        mine, _, tags = told_of.of(e)
        row[: len(ANCESTORS)] = tags
        if e is not None and e.tag in OWN_AT:
            row[OWN_AT[e.tag]] = 1
        row[near_at : near_at + hints] = np.maximum(mine, told_of.of(over)[0])
        row[near_at + hints : base] = told_of.of(over.parent if over is not None else None)[1]
        text, size = b.text, max(1, b.size)
        spaces, linked = text.count(" "), min(1.0, b.linked / max(1, b.size))
        row[base:] = (
            np.log1p(len(text)), np.log1p(spaces), linked, text.endswith(ENDS), "," in text, "©" in text or "opyright" in text,
            sum(map(str.isdigit, text)) / len(text), i / n, i == 0, i == n - 1, min(e.depth if e is not None else 0, 40) / 8, len(text) > 200, b.linked >= size,
            linked * np.log1p(spaces), linked * (spaces < 4), (over.text if over is not None else page_text) / page_text,
            (e.text if e is not None else page_text) / page_text, some_article and not articles[i], not some_article, 1 / n, np.log1p(n),
        )
    before, behind = np.zeros((n, 4)), np.zeros((n, 4))
    near = own[:, [base, base + 2, OWN_AT["p"], base + 17]]
    before[1:], behind[:-1] = near[:-1], near[1:]
    return np.hstack([own, before, behind])


def matrices(pages: list[list[Block]]) -> tuple[np.ndarray, np.ndarray]:
    begins = np.concatenate(([0], np.cumsum([len(p) for p in pages]))).astype(np.int64)
    return np.vstack([block_features(p) for p in pages]), begins


@lru_cache(maxsize=2)
def trained(n: int = TRAIN_PAGES, seed: int = 1) -> Crf:
    """The field for ``n`` labelled pages, a fixed amount of work."""
    pages = [parse(p) for p in labelled_pages(n, seed)]
    x, begins = matrices(pages)
    return fit(x, np.array([int(b.marked) for p in pages for b in p]), begins)


def main_texts(htmls: list[str], crf: Crf) -> list[str]:
    """The main text of each page."""
    pages = [parse(h) for h in htmls]
    x, begins = matrices(pages)
    labels = crf.decode(x, begins)
    return [JOIN.join(b.text for b, y in zip(p, labels[a : a + len(p)], strict=True) if y) for p, a in zip(pages, begins.tolist(), strict=False)]


def extract_text(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", crf: Crf | None = None
) -> DataFrame:
    """(page_id, url, text, n_chars) of every row."""
    ship_code(pages.sparkSession)
    model = crf or trained()

    def extracted(batches):
        for part in slices(batches, "html"):
            texts = pa.array(main_texts(part.column(2).to_pylist(), model), pa.string())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), texts, pc.utf8_length(texts).cast(pa.int64())], ["page_id", "url", "text", "n_chars"]
            )

    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").alias("url"), text_of(html_col).alias("html"))
    return rows.mapInArrow(extracted, "page_id long, url string, text string, n_chars long")
