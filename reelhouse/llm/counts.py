"""Token counts, with huge texts encoded in overlapping windows that are spliced exactly.

Method: a piece of text longer than a window is cut into windows that overlap. Each window is
encoded by the tokenizers library, which gives the offset of every token. Two neighbours are
spliced where both have a token boundary at the same offset, if it is a chunk boundary in both as
well. Such a boundary is proven stable: tokens never cross a chunk boundary; the left window starts
at a true one and the pattern looks at nothing beyond the character after a chunk, so each of its
chunk boundaries before the window's end is true; and the pattern has no memory, so a scan of the
right window that reaches a true boundary is the true scan from there on. The tokens before the
splice are counted in the left window, those behind it in the right one, of which the next
neighbour is the left one. Where the overlap holds no such boundary, it is widened to the left, in
the end to the whole left window; where that has none, the window itself is widened.

Texts of at most one window are split into chunks, and each distinct chunk is encoded once; the sum
is what the library gives for the whole text.

One narrow pass, without a shuffle. Memory: one batch of texts, two windows, and a bounded number
of known chunks. A text without any chunk boundary is one window in the end.

Cases: a null or empty text has 0 bytes and 0 tokens. Rows with a null id and repeated rows are
counted like any other. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from reelhouse.llm.chunks import CHUNK, Chunks, library_counts, library_offsets
from reelhouse.llm.rows import chosen, over_batches

WINDOW = 65_536
OVERLAP = 512
LIMIT = 1024


class Window:
    """A stretch of a text with the offsets in it at which tokens begin."""

    def __init__(self, text: str, start: int, end: int, encode: Callable[[str], np.ndarray]):
        self.start, self.end = start, end
        self.tokens = encode(text[start:end]) + start

    def boundaries(self, text: str, begin: int) -> set[int]:
        """Offsets from `begin` on at which both a chunk and a token begin.

        The last chunk may go on behind the window, and is left out. `begin` must be a chunk's
        first offset, or nothing before the first boundary that is found counts as one.
        """
        chunks = [m.start() for m in CHUNK.finditer(text, begin, self.end)]
        return set(chunks[1:]).intersection(self.tokens.tolist())

    def before(self, at: int) -> int:
        return int(np.searchsorted(self.tokens, at))

    def behind(self, at: int) -> None:
        """Forget the tokens before an offset."""
        self.tokens, self.start = self.tokens[self.before(at) :], at


def spliced_count(
    text: str,
    encode: Callable[[str], np.ndarray],
    window: int = WINDOW,
    overlap: int = OVERLAP,
    widened: Callable[[], None] = lambda: None,
) -> int:
    """Number of tokens of a text, encoded window by window.

    `encode` gives the offsets of a text's tokens; `widened` is called whenever an overlap or a
    window had to be widened.
    """
    total, size, n = 0, window, len(text)
    left = Window(text, 0, min(n, size), encode)
    while left.end < n:
        back, at = overlap, None
        stable = left.boundaries(text, left.start)
        # the last chunk of the left window is no true one
        while at is None:
            begin = max(left.start, left.end - back)
            right = Window(text, begin, min(n, begin + max(size, 2 * back)), encode)
            common = {p for p in stable if p > begin}.intersection(right.boundaries(text, begin))
            if common:
                at = max(common)
            elif begin == left.start:
                break
            else:
                widened()
                back *= 2
        if at is None:
            widened()
            size *= 2
            left = Window(text, left.start, min(n, left.start + size), encode)
            continue
        total += left.before(at)
        right.behind(at)
        left, size = right, window
    return total + len(left.tokens)


def count(
    text: str, known: Chunks, encode: Callable[[str], np.ndarray], window: int = WINDOW, overlap: int = OVERLAP
) -> int:
    """Number of ids of a text longer than a window; special strings in it are one id each."""
    return sum(
        1 if i % 2 else spliced_count(piece, encode, window, overlap)
        for i, piece in enumerate(known.pieces(text))
    )


def token_counts(
    docs: DataFrame,
    path: str,
    limit: int = LIMIT,
    window: int = WINDOW,
    overlap: int = OVERLAP,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than `limit` tokens) of every row.

    `path`: a byte-level tokenizer file of the tokenizers library, readable on every executor.
    """

    def make():
        known, encode = library_counts(path), library_offsets(path)

        def counted(texts: list[str]) -> list[int]:
            cut = [known.cut(t) if len(t) <= window else None for t in texts]
            known.learn(chain.from_iterable(c for c in cut if c is not None))
            get = known.made.__getitem__
            short = [None if c is None else sum(map(get, c)) for c in cut]
            return [
                count(t, known, encode, window, overlap) if s is None else s
                for t, s in zip(texts, short, strict=True)
            ]

        def run(ids, texts):
            texts = pc.fill_null(texts, "")
            found = []
            for i in range(0, len(texts), 1000):
                found += counted(texts[i : i + 1000].to_pylist())
            return ids, pc.binary_length(texts), found, [n > limit for n in found]

        return run

    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    return over_batches(chosen(docs, doc_id=id_col, text=text_col), make, schema)
