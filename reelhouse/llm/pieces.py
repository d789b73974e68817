"""The ids of many texts at once: texts cut with numpy, each distinct piece encoded once.

The byte-level pattern cuts before white space that follows something else, before the last white
space before a word and, unless that is a space, behind it, and between ASCII letters, digits and
other signs. Texts are cut there and nowhere else, so every piece is cut by the library as it would
be inside its text. An apostrophe stays with the letters behind it, and the white space beyond
ASCII with what lies beside it.
"""

from __future__ import annotations

import functools
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from reelhouse.llm.chunks import SPACE, WHITE, library, special_ids

#: Bytes of text that are cut together, and whose pieces are looked up together; a longer text alone.
AT_ONCE, LOOKED_UP = 1 << 21, 1 << 24
#: Bytes of pieces and ids that a worker keeps.
LIMIT = 1 << 26
_SPACE, _WHITE, _LETTER, _DIGIT, _SIGN, _QUOTE, _OTHER, _WIDE_WHITE = range(8)
#: A piece between line feeds keeps its ids if no white space beyond one space before it is in it.
_PLAIN = rf"^ ?[^{SPACE}]+$"


def _classes() -> np.ndarray:
    kinds = np.full(256, _OTHER, np.uint8)
    for code in range(0x20, 0x7F):
        c = chr(code)
        kinds[code] = _LETTER if c.isalpha() else _DIGIT if c.isdigit() else _SIGN
    kinds[ord("'")] = _QUOTE
    kinds[ord(" ")] = _SPACE
    kinds[[ord(c) for c in WHITE if c.isascii() and c != " "]] = _WHITE
    return kinds


def _cuts() -> np.ndarray:
    """Whether a class, times 8, plus the class behind it have a cut between them."""
    cut = np.zeros((8, 8), bool)
    cut[_LETTER : _OTHER + 1, :_LETTER] = True
    cut[_LETTER, [_DIGIT, _SIGN, _QUOTE]] = True
    cut[_DIGIT, [_LETTER, _SIGN, _QUOTE]] = True
    cut[_SIGN, [_LETTER, _DIGIT]] = True
    cut[_QUOTE, _DIGIT] = True
    return cut.ravel()


CLASSES, CUTS = _classes(), _cuts()
_WIDE = [int.from_bytes(c.encode(), "big") for c in WHITE if not c.isascii()]


def byte_classes(data: np.ndarray) -> np.ndarray:
    """The class of every byte of UTF-8 texts."""
    kinds = CLASSES[data]
    if data.max(initial=0) >= 0x80:
        lead = np.flatnonzero((data == 0xC2) | ((data >= 0xE1) & (data <= 0xE3)))
        behind = np.append(data, np.zeros(2, np.uint8)).astype(np.uint32)
        code = behind[lead] << 8 | behind[lead + 1]
        three = data[lead] != 0xC2
        code[three] = code[three] << 8 | behind[lead[three] + 2]
        wide = np.isin(code, _WIDE)
        for k in range(3):
            kinds[lead[wide & (three | (k < 2))] + k] = _WIDE_WHITE
    return kinds


def piece_starts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where pieces begin in UTF-8 bytes; `bounds`: where texts begin, and the end of the last."""
    kinds = byte_classes(data)
    cut = np.zeros(len(data) + 1, bool)
    cut[1:-1] = CUTS[kinds[:-1] << 3 | kinds[1:]]
    # white space with something else behind it in the same text
    white, word = kinds <= _WHITE, (kinds >= _LETTER) & (kinds <= _OTHER)
    last = np.append(white[:-1] & word[1:], False)
    last[bounds[1:][bounds[1:] > 0] - 1] = False
    cut[1:-1] |= last[1:] & white[:-1]
    lone = last & (kinds == _WHITE)
    lone[1:] &= kinds[:-1] != _WIDE_WHITE
    cut[1:] |= lone
    cut[bounds] = True
    return np.flatnonzero(cut[:-1])


def cut_texts(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All pieces of texts without nulls, and the number of pieces before each text and in all."""
    texts = texts.cast(pa.large_string())
    _, places, held = texts.buffers()
    bounds = np.frombuffer(places, np.int64, len(texts) + 1, 8 * texts.offset)
    data = np.frombuffer(held or b"", np.uint8)[bounds[0] : bounds[-1]]
    bounds = bounds - bounds[0]
    starts = piece_starts(data, bounds)
    ends = pa.py_buffer(np.append(starts, len(data)).astype(np.int64))
    pieces = pa.LargeStringArray.from_buffers(len(starts), ends, pa.py_buffer(data))
    return pieces, np.searchsorted(starts, bounds)


def runs(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches of values behind each other, and where each of these ends."""
    ends = np.cumsum(sizes)
    places = np.repeat(starts - (ends - sizes), sizes)
    places += np.arange(len(places))
    return values[places], ends


class TextIds:
    """Texts to ids, as the library encodes them.

    The ids of distinct pieces are kept for pieces that come again, up to `limit` bytes: beyond
    that, those go that were not met for longest, so the memory does not grow with the corpus.
    """

    def __init__(self, path: str, limit: int = LIMIT):
        self.tokenizer, self.limit = library(path), limit
        names = special_ids(self.tokenizer)
        self.specials = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        self.names = list(names)
        self.separator = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.known, self.ids = pa.array([], pa.large_string()), np.zeros(0, "<u4")
        self.starts = self.sizes = self.met = np.zeros(0, np.int64)
        self.now = 0

    def encode(self, text: str) -> np.ndarray:
        made = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return np.fromiter(made, "<u4", len(made))

    def make(self, pieces: pa.Array, at_once: int = 500) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct pieces, and how many each has. Plain pieces are encoded together with
        line feeds between them, whose one id occurs in no piece without one."""
        plain = pc.match_substring_regex(pieces, _PLAIN).to_numpy(zero_copy_only=False)
        if len(self.separator) != 1:
            plain = np.zeros(len(pieces), bool)
        pieces, sizes, made = pieces.to_numpy(zero_copy_only=False), np.empty(len(pieces), np.int64), []
        order = np.append(np.flatnonzero(plain), np.flatnonzero(~plain))
        n = int(plain.sum())
        for i in range(0, n, at_once):
            group = order[i : min(i + at_once, n)]
            ids = self.encode("\n".join(pieces[group]))
            between = np.append(np.flatnonzero(ids == self.separator[0]), len(ids))
            sizes[group] = np.diff(between, prepend=-1) - 1
            made.append(np.delete(ids, between[:-1]))
        for i in order[n:]:
            made.append(self.encode(pieces[i]))
            sizes[i] = len(made[-1])
        taken = sizes[order]
        starts = np.empty(len(order), np.int64)
        starts[order] = np.cumsum(taken) - taken
        return runs(np.concatenate([np.zeros(0, "<u4"), *made]), starts, sizes)[0], sizes

    def forget(self) -> None:
        """Keep half of the pieces, those met last."""
        cut = np.partition(self.met, len(self.met) // 2)[len(self.met) // 2]
        kept = np.flatnonzero(self.met > cut)
        self.known, self.met = self.known.take(pa.array(kept)), self.met[kept]
        self.ids, ends = runs(self.ids, self.starts[kept], self.sizes[kept])
        self.sizes = self.sizes[kept]
        self.starts = ends - self.sizes

    def places(self, distinct: pa.Array) -> np.ndarray:
        """Where distinct pieces are among the known ones, which they all are then."""
        if self.known.nbytes + self.ids.nbytes + 3 * self.met.nbytes > self.limit:
            self.forget()
        found = pc.index_in(distinct, value_set=self.known)
        new, places = distinct.filter(found.is_null()), pc.fill_null(found, -1).to_numpy().astype(np.int64)
        places[places < 0] = len(self.known) + np.arange(len(new))
        if len(new):
            ids, sizes = self.make(new)
            self.starts = np.append(self.starts, len(self.ids) + np.cumsum(sizes) - sizes)
            self.sizes, self.ids = np.append(self.sizes, sizes), np.append(self.ids, ids)
            self.known = pa.concat_arrays([self.known, new])
            self.met = np.append(self.met, np.zeros(len(new), np.int64))
        self.now += 1
        self.met[places] = self.now
        return places

    def cut(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Pieces of texts, and how many lie before each; special strings are pieces of their own."""
        if not any(pc.any(pc.match_substring(texts, s)).as_py() for s in self.names):
            return cut_texts(texts)
        parts = [self.specials.split(t) for t in texts.to_pylist()]
        pieces, before = cut_texts(pa.array(chain.from_iterable(parts), pa.large_string()))
        # a special string is one piece, whatever cuts it holds
        special = np.concatenate([np.arange(len(p)) % 2 == 1 for p in parts])
        inside = np.zeros(len(pieces) + 1, bool)
        for a, b in zip(before[:-1][special].tolist(), before[1:][special].tolist(), strict=True):
            inside[a + 1 : b] = True
        kept = np.flatnonzero(~inside)
        _, ends, data = pieces.buffers()
        ends = pa.py_buffer(np.frombuffer(ends, np.int64)[kept])
        pieces = pa.LargeStringArray.from_buffers(len(kept) - 1, ends, data)
        return pieces, np.searchsorted(kept, before[np.cumsum([0, *map(len, parts)])])

    def __call__(self, texts: pa.Array, at_once: int = AT_ONCE, looked_up: int = LOOKED_UP):
        """For stretches of texts, one after the other: the ids of their texts behind each other,
        and how many each text has. Null texts have none. Texts are cut `at_once` bytes at a time,
        and the pieces of `looked_up` bytes are looked up together."""
        for group in stretches(pc.fill_null(texts, ""), looked_up):
            cuts = [self.cut(t) for t in stretches(group, at_once)]
            coded = pa.chunked_array([pieces for pieces, _ in cuts], pa.large_string()).dictionary_encode()
            # stretches without pieces have no chunk
            places = self.places(coded.chunk(0).dictionary) if len(coded) else self.met
            chunks = iter(coded.chunks)
            for pieces, before in cuts:
                which = places[next(chunks).indices.to_numpy()] if len(pieces) else places[:0]
                ids, ends = runs(self.ids, self.starts[which], self.sizes[which])
                yield ids, np.diff(np.append(0, ends)[before])


def stretches(texts: pa.Array, at_once: int):
    """Texts in stretches of about so many bytes, one text at least."""
    behind = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(texts):
        so_far = int(behind[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(behind, so_far + at_once, side="right")))
        yield texts[at:to]
        at = to


@functools.lru_cache(maxsize=2)
def text_ids(path: str) -> TextIds:
    """The encoder of a tokenizer file, once per worker."""
    return TextIds(path)
