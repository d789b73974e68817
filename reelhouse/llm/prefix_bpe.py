"""Exact byte-pair encoding by dynamic programming over prefixes, and decoding.

Method: of a word's bytes, every prefix has one encoding, so it is enough to store the last
token of each prefix. An automaton over the vocabulary, with suffix links, gives all tokens that
end at a position, longest first. A token may be the last one if it covers the whole prefix, or
if it is compatible with the last token of the prefix before it: two tokens are compatible when
merging their joined bytes gives back exactly these two. Exactly one candidate passes; following
the stored tokens back from the end of the word gives its ids.

Compatibility is decided without merging anything: the right edge of the left token and the left
edge of the right token are taken apart step by step, the part formed last first, and the pair
fails if a merge across the border would come before the merge that consumes either edge.

Words come from the file's byte-level pattern. Which characters it takes for letters or digits
is asked from the library, since its Unicode tables may be older than Python's.

One narrow pass, without a shuffle; per task an automaton of the vocabulary and a bounded number
of known chunks. Cases: a null or empty text has no ids and decodes to an empty text. Special
strings in a text become their ids, and are decoded to the strings. Texts are taken whole, however
long; a long word takes one step a byte. Rows with a null id and repeated rows are encoded like any
other. An empty table gives no rows. Extra columns are ignored. A vocabulary with a token that no
merge forms is refused.
"""

from __future__ import annotations

import functools
import hashlib
import json
import math
import re
from itertools import chain

import ahocorasick
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from reelhouse.llm.chunks import SPACE, Chunks, library, little, special_ids
from reelhouse.llm.rows import chosen, over_batches

#: The word pattern of byte-level tokenizers, for text whose unusual characters
#: have been replaced by one of their class.
WORDS = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+|"
    rf" ?(?:[^\w{SPACE}]|_)+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)
#: Characters whose class is asked from the library: all but ASCII and Latin-1 letters.
_UNUSUAL = re.compile("[^\x00-\x7f\xc0-\xd6\xd8-\xf6\xf8-\xff]")


def byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary: itself if
    it is printable and no space in Latin-1, else the next one from 256 up."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}


class PrefixEncoder:
    """Words to ids for one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        stands = {letter: byte for byte, letter in byte_letters().items()}
        self.ids = {bytes(stands[c] for c in t): i for t, i in model["vocab"].items()}
        self.bytes = {i: t for t, i in self.ids.items()}
        vocab = model["vocab"]
        size = max(vocab.values()) + 1
        self.merges: dict[int, int] = {}  # left << 32 | right: when the pair is merged
        self.formed = [-1] * size  # when a token is formed; single bytes never are
        self.left_part, self.right_part = [0] * size, [0] * size
        for when, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            made = vocab[left + right]
            self.merges[vocab[left] << 32 | vocab[right]] = when
            if self.formed[made] < 0:
                self.formed[made] = when
                self.left_part[made], self.right_part[made] = vocab[left], vocab[right]
        # a token is taken for its own encoding, which holds only for what merges form
        specials = set(special_ids(library(path)).values())
        odd = [t for t, i in self.ids.items() if len(t) > 1 and self.formed[i] < 0 and i not in specials]
        if odd:
            raise ValueError(f"{path}: no merge forms the token {odd[0]!r}")
        self.automaton = ahocorasick.Automaton()
        for token, i in self.ids.items():
            self.automaton.add_word(token.decode("latin-1"), (len(token), i))
        self.automaton.make_automaton()
        self.tokenizer = library(path)
        self.special = special_ids(self.tokenizer)
        self.bytes |= {i: name.encode() for name, i in self.special.items()}
        self.compatible = functools.lru_cache(maxsize=500_000)(self._compatible)
        self.known: dict[str, bytes] = {}
        self.limit = 300_000
        self.plain = functools.lru_cache(maxsize=100_000)(self._plain)

    def _compatible(self, left: int, right: int) -> bool:
        across, formed = self.merges.get, self.formed
        left_used = right_used = math.inf
        while True:
            merged = across(left << 32 | right)
            if merged is not None and merged < left_used and merged <= right_used:
                return False
            a, b = formed[left], formed[right]
            if a > b:
                left, left_used = self.right_part[left], a
            elif b >= 0:
                right, right_used = self.left_part[right], b
            else:
                return True

    def encode_word(self, word: bytes) -> list[int]:
        """The ids of one word of the pattern."""
        whole = self.ids.get(word)
        if whole is not None:
            return [whole]
        last, length = [0] * len(word), [0] * len(word)
        compatible = self.compatible
        done = -1
        for end, (size, token) in self.automaton.iter(word.decode("latin-1")):
            if done == end:
                continue  # the prefix that ends here has its token
            if end < size or compatible(last[end - size], token):
                last[end], length[end] = token, size
                done = end
        out, at = [], len(word) - 1
        while at >= 0:
            out.append(last[at])
            at -= length[at]
        out.reverse()
        return out

    def _plain(self, char: str) -> str:
        """An ASCII character of the class the library gives to a character."""
        cut = self.tokenizer.pre_tokenizer.pre_tokenize_str
        for like in "a1!":
            if len(cut(like + char)) == 1:
                return like
        return " "

    def words(self, chunk: str) -> list[str]:
        if not _UNUSUAL.search(chunk):
            return WORDS.findall(chunk)
        masked = _UNUSUAL.sub(lambda m: self.plain(m[0]), chunk)
        if chunk.isspace():
            masked = chunk
        return [chunk[m.start() : m.end()] for m in WORDS.finditer(masked)]

    def known_word(self, word: str) -> bytes:
        """The id bytes of a word of the pattern."""
        self.known[word] = made = little(self.encode_word(word.encode()))
        return made

    def encode_chunks(self, chunks: list[str]) -> dict[str, bytes]:
        """The id bytes of chunks."""
        if len(self.known) > self.limit:
            self.known.clear()
        out, get, make, special = {}, self.known.get, self.known_word, self.special
        for chunk in chunks:
            if chunk in special:
                out[chunk] = little([special[chunk]])
                continue
            words = self.words(chunk)
            if len(words) == 1:
                out[chunk] = get(chunk) or make(chunk)
            else:
                out[chunk] = b"".join([get(word) or make(word) for word in words])
        return out


class Decoded(dict):
    """Id bytes to the bytes they stand for."""

    def __init__(self, table: dict[int, bytes]):
        super().__init__()
        self.table = table

    def __missing__(self, ids: bytes) -> bytes:
        self[ids] = made = b"".join(map(self.table.__getitem__, memoryview(ids).cast("I")))
        return made


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> tuple[Chunks, Decoded]:
    made = PrefixEncoder(path)
    return Chunks(made.special, made.encode_chunks, limit=250_000), Decoded(made.bytes)


def encode(texts: list[str], path: str):
    """Id bytes of each text and the text they decode to."""
    known, decoded = encoder(path)
    if len(decoded) > 2 * known.limit:
        decoded.clear()
    cut = [known.cut(t) for t in texts]
    known.learn(chain.from_iterable(cut))
    get, back = known.made.__getitem__, decoded.__getitem__
    for chunks in cut:
        parts = list(map(get, chunks))
        yield b"".join(parts), b"".join(map(back, parts)).decode("utf-8", "replace")


def _encoded(docs: DataFrame, path: str, id_col: str, text_col: str, schema: str, finish):
    def make():
        def run(ids, texts):
            rows = []
            for i in range(0, len(texts), 500):
                part = pc.fill_null(texts[i : i + 500], "").to_pylist()
                rows += [finish(*made) for made in encode(part, path)]
            columns = zip(*rows, strict=True) if rows else [[] for _ in schema.split(",")[1:]]
            return ids, *columns

        return run

    return over_batches(chosen(docs, doc_id=id_col, text=text_col), make, schema)


def encode_texts(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit integers) and decoded of every row.

    `path`: a byte-level tokenizer file, readable on every executor.
    """
    schema = "doc_id long, ids binary, decoded string"
    return _encoded(docs, path, id_col, text_col, schema, lambda ids, decoded: (ids, decoded))


def encode_digests(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row; ids stay in the task."""

    def finish(ids: bytes, decoded: str):
        return (
            len(ids) // 4,
            hashlib.sha256(ids).hexdigest(),
            hashlib.sha256(decoded.encode()).hexdigest(),
        )

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _encoded(docs, path, id_col, text_col, schema, finish)
