"""Texts cut where byte-level tokenizers always cut, and encoded once per distinct chunk.

The byte-level pre-tokenizer never joins characters across the end of a run of non-space
characters, so a text's ids are the ids of its chunks in order. A chunk is a run of non-space
characters with at most one space before it, or a run of white space without the space that
belongs to the next chunk. Special strings are taken out of a text before anything else.
"""

from __future__ import annotations

import functools
import os
import re
from array import array
from itertools import chain

import numpy as np

#: What the tokenizer's pattern counts as white space.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WHITE = "".join(c for c in map(chr, range(0x3001)) if re.match(f"[{SPACE}]", c))
CHUNK = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]")


@functools.lru_cache(maxsize=2)
def library(path: str):
    """The tokenizer of a file, once per worker, on one thread."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(path)
    made.no_truncation()
    made.no_padding()
    return made


@functools.lru_cache(maxsize=2)
def library_offsets(path: str):
    """A function that gives the offset of each token of a text without special strings.

    Offsets are those of the whole token, white space included.
    """
    from tokenizers import processors

    made = type(library(path)).from_str(library(path).to_str())
    made.post_processor = processors.ByteLevel(trim_offsets=False)

    def offsets(text: str) -> np.ndarray:
        found = made.encode(text, add_special_tokens=False).offsets
        return np.fromiter((a for a, _ in found), np.int64, len(found))

    return offsets


def special_ids(tokenizer) -> dict[str, int]:
    return {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items()}


class Chunks:
    """What `make` gives for each chunk, kept for chunks that come again.

    `make` takes a list of distinct chunks and returns the value of each. Values that were not
    asked for while `limit` others came are forgotten, so the memory does not grow with the corpus.
    """

    def __init__(self, specials: dict[str, int], make, limit: int = 350_000):
        self.made: dict[str, object] = {}
        self.old: dict[str, object] = {}
        self.make, self.limit = make, limit
        escaped = "|".join(map(re.escape, specials))
        self.special = re.compile(f"({escaped})") if specials else None
        self.names = specials

    def pieces(self, text: str) -> list[str]:
        """Ordinary pieces at even places, special strings at odd ones."""
        return self.special.split(text) if self.special else [text]

    def learn(self, chunks) -> None:
        """Make the values that are missing for an iterable of chunks."""
        if len(self.made) > self.limit:
            self.made, self.old = {}, self.made
        missing = set(chunks).difference(self.made)
        known = missing.intersection(self.old)
        self.made.update({c: self.old[c] for c in known})
        self.made.update(self.make(list(missing - known)))

    def cut(self, text: str) -> list[str]:
        """The chunks of a text; special strings are chunks of their own."""
        if self.special is None or not self.special.search(text):
            return CHUNK.findall(text)
        parts = self.pieces(text)
        return list(
            chain.from_iterable(
                ([p] if i % 2 else CHUNK.findall(p)) for i, p in enumerate(parts) if p
            )
        )

    def joined(self, texts: list[str]) -> list[bytes]:
        """The values of each text's chunks, joined; values must be bytes."""
        cut = [self.cut(t) for t in texts]
        self.learn(chain.from_iterable(cut))
        get = self.made.__getitem__
        return [b"".join(map(get, chunks)) for chunks in cut]


def little(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    packed = array("I", ids)
    if packed.itemsize != 4 or os.sys.byteorder != "little":
        return b"".join(i.to_bytes(4, "little") for i in ids)
    return packed.tobytes()


def encoded(tokenizer, chunks: list[str], at_once: int = 500):
    """Groups of chunks, all ids of a group in one array, and where each chunk's ids lie.

    Chunks that hold a word are encoded together with line feeds between them: a line feed
    between words is always cut off, and its one id occurs in no chunk without one.
    """
    separator = tokenizer.encode("\n", add_special_tokens=False).ids
    apart = [c for c in chunks if "\n" in c or not c.strip(WHITE)] if len(separator) == 1 else chunks
    alone = set(apart)
    together = [c for c in chunks if c not in alone] if len(apart) < len(chunks) else []
    for i in range(0, len(together), at_once):
        group = together[i : i + at_once]
        ids = tokenizer.encode("\n".join(group), add_special_tokens=False).ids
        ids = np.fromiter(ids, "<u4", len(ids))
        ends = np.append(np.flatnonzero(ids == separator[0]), len(ids))
        yield group, ids, np.append(0, ends[:-1] + 1), ends
    for chunk in apart:
        ids = tokenizer.encode(chunk, add_special_tokens=False).ids
        yield [chunk], np.array(ids, "<u4"), np.array([0]), np.array([len(ids)])


@functools.lru_cache(maxsize=2)
def library_ids(path: str) -> Chunks:
    """Chunk to id bytes, as the library encodes it."""
    tokenizer = library(path)

    def make(chunks: list[str]) -> dict[str, bytes]:
        made = {}
        for group, ids, starts, ends in encoded(tokenizer, chunks):
            packed = ids.tobytes()
            places = zip(group, (4 * starts).tolist(), (4 * ends).tolist(), strict=True)
            made.update({c: packed[a:b] for c, a, b in places})
        return made

    return Chunks(special_ids(tokenizer), make)


@functools.lru_cache(maxsize=2)
def library_counts(path: str) -> Chunks:
    """Chunk to number of ids, as the library encodes it."""
    tokenizer = library(path)

    def make(chunks: list[str]) -> dict[str, int]:
        made = {}
        for group, _, starts, ends in encoded(tokenizer, chunks):
            made.update(zip(group, (ends - starts).tolist(), strict=True))
        return made

    return Chunks(special_ids(tokenizer), make)
