"""Main text of web pages by a conditional random field over the leaf blocks of the page.

Method: a page is read into its leaf blocks (`dom.py`). A linear-chain conditional random field
(`crf.py`) labels the sequence of blocks as main text or not, from features of the ancestors'
tags and names and of the text itself, with edge weights that depend on whether two neighbours
have the same parent, and Viterbi gives the best labels. It is fitted once on the driver, on
`PAGES` labelled pages (`labelled_pages.py`), and its weights travel with the tasks.

One narrow pass over the pages, without a shuffle.

Cases: a null or empty page, and one without main text, gives an empty text. Unclosed tags,
comments and quotes are read as browsers roughly do; what cannot be a tag is text. A drawing (svg)
is part of its line, and what is inside a canvas, object or template is read like the rest. Blocks
are looked at whole, however long, and pages of any depth are read in time that grows with their
length. Rows with null ids or urls and repeated rows are handled one by one. An empty table gives no
rows. Other columns are ignored.
"""

from __future__ import annotations

import functools
import re

from pyspark.sql import DataFrame

from reelhouse.llm import crf, labelled_pages
from reelhouse.llm.dom import Block, leaf_blocks
from reelhouse.llm.rows import chosen, over_batches

#: What notices, adverts and footers say of themselves, in lower case.
PHRASES = ("©", "cookie", "subscribe", "newsletter", "advertisement", "sponsored", "comments", "reply")
_SAID = re.compile("|".join(map(re.escape, PHRASES)))
_ENDS = (".", "!", "?", "…", '."', ".”", ":", "。")
SAME, OTHER_PARENT = 0, 1


def _step(n: int, steps: tuple[int, ...]) -> int:
    return sum(n > s for s in steps)


def features(block: Block, first: bool, last: bool) -> list[str]:
    """The names of a block's binary features."""
    text, n = block.text, len(block.text)
    words = text.count(" ") + 1
    out = [*block.marks, f"tag:{block.tag}", f"words:{_step(words, (1, 2, 4, 8, 15, 30, 60))}"]
    out.append(f"links:{_step(100 * block.linked // n, (0, 25, 60, 90))}")
    out.append("ends" if text.endswith(_ENDS) else "open")
    out.append(f"commas:{_step(text.count(','), (0, 2, 5))}")
    out += [f"says:{p}" for p in sorted(set(_SAID.findall(text.lower())))]
    if not any("name:" in m or m in _SECTIONS for m in block.marks):
        out.append("unmarked")
    if first:
        out.append("first")
    if last:
        out.append("last")
    return out


_SECTIONS = frozenset(f"in:{t}" for t in "nav header footer aside form article main section".split())


def sequence(blocks: list[Block]) -> tuple[list[list[str]], list[int]]:
    last = len(blocks) - 1
    names = [features(b, i == 0, i == last) for i, b in enumerate(blocks)]
    kinds = [SAME if i and b.parent == blocks[i - 1].parent else OTHER_PARENT for i, b in enumerate(blocks)]
    return names, kinds


@functools.lru_cache(maxsize=1)
def model(pages: int = labelled_pages.PAGES) -> crf.Model:
    """The field, fitted on made-up labelled pages; the same on every call."""
    made = [(leaf_blocks(html), labels) for html, labels in labelled_pages.pages(pages)]
    made = [(blocks, labels) for blocks, labels in made if blocks]
    names, kinds = zip(*(sequence(blocks) for blocks, _ in made), strict=True)
    return crf.fit(list(names), list(kinds), [labels for _, labels in made], n_kinds=2)


def main_blocks(page: str, field: crf.Model) -> list[str]:
    """The texts of the blocks labelled as main text."""
    blocks = leaf_blocks(page)
    labels = field.decode(*sequence(blocks))
    return [b.text for b, label in zip(blocks, labels, strict=True) if label == labelled_pages.MAIN]


def extract_text(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    field: crf.Model | None = None,
) -> DataFrame:
    """page_id, url, text (blocks joined by an empty line) and n_chars of every row."""
    field = field or model()

    def make():
        def run(ids, urls, pages):
            texts = ["\n\n".join(main_blocks(p, field)) if p else "" for p in pages.to_pylist()]
            return ids, urls, texts, list(map(len, texts))

        return run

    schema = "page_id long, url string, text string, n_chars long"
    return over_batches(chosen(pages, page_id=id_col, url=url_col, html=html_col), make, schema)
