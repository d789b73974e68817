"""Token counts, exact encoding, token files and class-model scores against the library or plain versions."""

from __future__ import annotations

import hashlib
import json
import math
import os
import random
import zlib
from array import array
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from brute import LONG, ODD_DOCUMENTS, SMALL, base_scores, odd, ordered

from reelhouse.llm import chunks, class_lm, counts, pieces, prefix_bpe, repair
from reelhouse.llm.queries import QUERIES

os.environ["TOKENIZERS_PARALLELISM"] = "false"
PATH = public_tokenizers.path("byte_bpe_50k.json")
PIECES = [
    "a", "b", " ", "  ", "\n", "\t", "\x85", "'", "s", "<|endoftext|>", "<|end", "é", "9", "!", "\x1c", "中",
    "x" * 30, "'re", "'LL", "'ll", "_", "²", "½", "Ⅷ", "　", "the", "ing", " \n ", "́", "🙂", "ࢹ",
]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def random_text(rnd: random.Random) -> str:
    def piece():
        if rnd.random() < 0.85:
            return rnd.choice(PIECES)
        return chr(rnd.choice([rnd.randint(0, 0x2FFF), rnd.randint(0x3000, 0xD7FF), rnd.randint(0xE000, 0x10FFFF)]))

    return "".join(piece() for _ in range(rnd.randint(0, 60)))


def rows_of(spark, name):
    df = odd(spark) if name == "odd" else spark.read.parquet(f"{SMALL}/documents.parquet")
    return df, [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_white_space_is_that_of_the_library(library):
    cut = library.pre_tokenizer.pre_tokenize_str
    for c in [*range(0x3100), 0xFEFF, 0x1F600]:
        splits = [span for _, span in cut("!" + chr(c) + "!")] != [(0, 3)]
        space = splits and len(cut("a" + chr(c))) == 2 and len(cut("1" + chr(c))) == 2
        assert space == bool(chunks.CHUNK.fullmatch(chr(c)) and chr(c) in chunks.WHITE), hex(c)


def test_every_way_to_encode_agrees_with_the_library(library):
    rnd = random.Random(11)
    for _ in range(1500):
        text = random_text(rnd)
        want = ids_of(library, text)
        known = chunks.library_ids(PATH)
        assert known.joined([text]) == [chunks.little(want)]
        (ids, decoded), = prefix_bpe.encode([text], PATH)
        assert ids == chunks.little(want)
        assert decoded == library.decode(want, skip_special_tokens=False)
        window, overlap = rnd.choice([1, 2, 5, 17, 40]), rnd.choice([1, 2, 7])
        known, encode = chunks.library_counts(PATH), chunks.library_offsets(PATH)
        assert counts.count(text, known, encode, window, overlap) == len(want)


def test_every_token_is_its_own_encoding(library):
    """By the library, for every token that is a text and one word of the pattern."""
    made, compared = prefix_bpe.PrefixEncoder(PATH), 0
    cut = library.pre_tokenizer.pre_tokenize_str
    for token, i in made.ids.items():
        try:
            text = token.decode()
        except UnicodeDecodeError:
            continue
        if len(cut(text)) == 1:
            assert library.encode(text, add_special_tokens=False).ids == [i] == made.encode_word(token)
            compared += 1
    assert compared > 49_000


def test_a_vocabulary_with_tokens_that_no_merge_forms_is_refused(tmp_path):
    with open(PATH, encoding="utf-8") as file:
        told = json.load(file)
    told["model"]["merges"] = told["model"]["merges"][:-1]
    path = tmp_path / "t.json"
    path.write_text(json.dumps(told), encoding="utf-8")
    with pytest.raises(ValueError, match="no merge forms"):
        prefix_bpe.PrefixEncoder(str(path))


def test_known_chunks_stay_bounded():
    known = chunks.Chunks({}, lambda new: dict.fromkeys(new, b"."), limit=50)
    for i in range(40):
        known.joined([" ".join(f"w{i}.{k}" for k in range(20)) + " the"])
    assert len(known.made) + len(known.old) < 200
    assert " the" in known.made


SPLICED = {
    "words": ("one  two\n\n three" * 300, False),
    "no white space": ("y" * 700 + "é1-" * 300, True),
    "white space alone": (" \n" * 900, True),
    "a long word": ("one two " * 40 + "y" * 500 + " end" * 40, True),
    "one window": ("one two", False),
    "nothing": ("", False),
}


@pytest.mark.parametrize("name", SPLICED)
def test_windows_are_spliced_and_widened(library, name):
    text, widens = SPLICED[name]
    encode, made, widened = chunks.library_offsets(PATH), [], []

    def spy(part):
        made.append(len(part))
        return encode(part)

    got = counts.spliced_count(text, spy, window=128, overlap=16, widened=lambda: widened.append(1))
    assert got == len(ids_of(library, text))
    assert bool(widened) == widens
    if not widens and len(text) > 128:  # only the overlaps are encoded twice
        assert len(made) > 10 and len(text) < sum(made) < 1.3 * len(text)
    if name == "no white space":  # in the end one window, by doubling
        assert max(made) == len(text) and sum(made) < 40 * len(text)


def test_offsets_are_those_of_whole_tokens(library):
    text = "one  two\n\n thrée🙂 \t end "
    offsets = chunks.library_offsets(PATH)(text)
    assert len(offsets) == len(ids_of(library, text)) and offsets[0] == 0
    assert (np.diff(offsets) >= 0).all() and text[offsets[-1] :].strip() == ""


@pytest.mark.parametrize("name", ["odd", "table"])
def test_counts(spark, library, name):
    df, rows = rows_of(spark, name)
    got = counts.token_counts(df, PATH, window=2000, overlap=16)
    want = [(d, len((t or "").encode()), len(ids_of(library, t)), len(ids_of(library, t)) > 1024) for d, t in rows]
    assert ordered(map(tuple, got.collect())) == ordered(want)


@pytest.mark.parametrize("name", ["odd", "table"])
def test_exact_encoding(spark, library, name):
    df, rows = rows_of(spark, name)
    want = []
    for d, t in rows:
        ids = ids_of(library, t)
        decoded = library.decode(ids, skip_special_tokens=False).encode()
        want.append((d, len(ids), hashlib.sha256(array("I", ids)).hexdigest(), hashlib.sha256(decoded).hexdigest()))
    assert ordered(map(tuple, prefix_bpe.encode_digests(df, PATH).collect())) == ordered(want)
    full = prefix_bpe.encode_texts(df, PATH).collect()
    assert ordered((r.doc_id, r.decoded) for r in full) == ordered((d, t or "") for d, t in rows)


def test_nothing_to_encode(spark):
    empty = odd(spark, [])
    assert counts.token_counts(empty, PATH).collect() == []
    assert prefix_bpe.encode_digests(empty, PATH).collect() == []


# token files


def test_grammars_give_the_ids_back():
    rnd = np.random.default_rng(3)
    for i in range(200):
        ids = rnd.integers(0, rnd.integers(1, 6), rnd.integers(0, 200)).astype(np.uint32)
        ids = np.tile(ids, 1 + i % 4)
        symbols, rules, lengths = repair.compress(ids, 10, min_pairs=2, min_gain=0)
        assert (repair.expand(symbols, rules, 10) == ids).all()
        for k, rule in enumerate(range(len(rules))):
            assert lengths[k] == len(repair.expand(np.array([10 + rule]), rules, 10))
        if len(ids):
            start = int(rnd.integers(0, len(ids)))
            n = int(rnd.integers(1, len(ids) - start + 1))
            assert (repair.stretch(symbols, rules, lengths, 10, start, n) == ids[start : start + n]).all()


@pytest.mark.parametrize("least", [0, 2**31 - 60, 2**32 - 60])
def test_rounds_and_blocks_give_the_ids_back(least):
    rnd = np.random.default_rng(5)
    for i in range(60):
        ids = (least + rnd.integers(0, 2 + i % 4, 300)).astype(np.uint32)
        shorter, made = repair.replace_pairs(ids, least + 5, 8)
        assert len(shorter) < len(ids) and (made >= least).all()
        for expand in (repair.expand, repair.expand_block):
            assert (expand(shorter, made, least + 5) == ids).all()
        symbols, rules, _ = repair.compress(ids, least + 5, min_gain=0)
        assert (repair.expand_block(symbols, rules, least + 5) == ids).all()
    none = np.zeros(0, np.uint32)
    assert repair.expand_block(ids, none.reshape(0, 2), least + 5).tolist() == ids.tolist()


def all_ids(encode, texts, *sizes):
    made = []
    for ids, n in encode(texts, *sizes):
        made += [part.tolist() for part in np.split(ids, np.cumsum(n)[:-1])]
    return made


def test_ids_of_cut_texts_are_those_of_the_library(library):
    rnd, encode = random.Random(12), pieces.TextIds(PATH, limit=100_000)
    more = ["a\n\n b", "\n", " ", "\n\nb", "x \u00a0\n b", "\u00a0 b", "a,b 'll9 ''s,1'", "\u3000", "e\u0301 ", "\r\n\r\nA"]
    for k in range(150):
        texts = [random_text(rnd) for _ in range(rnd.choice([1, 20, 60]))] + more + [None, ""]
        if k % 2:
            texts = [t and t.replace("<|endoftext|>", "") for t in texts]
        rnd.shuffle(texts)
        rows = pa.array(texts, rnd.choice([pa.string(), pa.large_string()]))[1:]
        got = all_ids(encode, rows, rnd.choice([1, 50, 1 << 21]), rnd.choice([1, 300, 1 << 24]))
        assert got == [ids_of(library, t) for t in texts[1:]]
    assert len(encode.known) < 2000  # what was not met for long has gone
    assert all_ids(encode, pa.array([], pa.string())) == []


def test_a_word_is_encoded_once_whatever_sign_follows(library):
    encode, made = pieces.TextIds(PATH), []
    make = encode.make
    encode.make = lambda new: (made.extend(new.to_pylist()), make(new))[1]
    texts = [f"qwrtz{a} plmok{b}\nvbnxy{a}9{b}" for a in ".,;!?" for b in ",)]|"]
    assert all_ids(encode, pa.array(texts), 40, 40) == [ids_of(library, t) for t in texts]
    assert sorted(made) == sorted({"qwrtz", " plmok", "vbnxy", "\n", "9", *".,;!?)]|"})


def test_repetition_is_compressed():
    ids = np.tile(np.arange(50, dtype=np.uint32), 200)
    symbols, rules, _ = repair.compress(ids, 100)
    assert len(symbols) + 3 * len(rules) < len(ids) / 5


@pytest.mark.parametrize("block", [1, 300, 1 << 20])
def test_files_hold_the_ids_in_order(spark, library, tmp_path, block):
    df = spark.read.parquet(f"{SMALL}/documents.parquet")
    repair.write_token_files(df, PATH, str(tmp_path / "t"), end_id=2, block=block)
    start, want = 0, []
    for r in df.select("doc_id", "text").orderBy("doc_id").collect():
        ids = [*ids_of(library, r.text), 2]
        want.append((r.doc_id, start, len(ids), zlib.crc32(array("I", ids))))
        start += len(ids)
    assert sorted(map(tuple, repair.read_digests(spark, str(tmp_path / "t")).collect())) == want


def test_files_of_odd_documents(spark, library, tmp_path):
    repair.write_token_files(odd(spark), PATH, str(tmp_path / "t"), end_id=2, block=500)
    got = repair.read_token_files(spark, str(tmp_path / "t")).orderBy("start").collect()
    ids_by_doc = [(r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in got]
    want = [(d, [*ids_of(library, t), 2]) for d, t, *_ in ODD_DOCUMENTS]
    assert ordered(ids_by_doc) == ordered(want)
    docs = [r.doc_id for r in got]
    assert docs == sorted(docs, key=lambda d: (d is not None, d or 0))
    ends = np.cumsum([len(i) for _, i in ids_by_doc]).tolist()
    assert [r.start for r in got] == [0, *ends[:-1]]


def test_stretches_of_files(spark, library, tmp_path, monkeypatch):
    monkeypatch.setattr(repair, "AT_ONCE", 3)
    df, folder, rnd = spark.read.parquet(f"{SMALL}/documents.parquet"), str(tmp_path / "t"), random.Random(8)
    repair.write_token_files(df, PATH, folder, end_id=2, block=5000)
    ids = {r.doc_id: [*ids_of(library, r.text), 2] for r in df.collect()}
    wanted = [(d, rnd.randrange(len(x)), rnd.randint(1, 60)) for d, x in ids.items() for _ in range(2)]
    wanted += [(0, 0, 10**6), (0, 10**6, 5), (1, 2, 0), (None, 0, 1), (-7, 0, 1), (1, 0, 3), (1, 0, 3)]
    asked = spark.createDataFrame(wanted, "doc_id long, start long, n long")
    got = repair.read_stretches(spark, folder, asked).collect()
    want = [(d, a, ids[d][a : a + n]) for d, a, n in wanted if d in ids]
    assert ordered((r.doc_id, r.start, np.frombuffer(r.ids, "<u4").tolist()) for r in got) == ordered(want)
    assert all(r.n == len(r.ids) // 4 for r in got)
    assert repair.read_stretches(spark, folder, asked.limit(0)).collect() == []


def test_blocks_are_read_without_a_shuffle(spark, tmp_path, conf):
    conf(autoBroadcastJoinThreshold="-1")
    repair.write_token_files(odd(spark), PATH, str(tmp_path / "t"), end_id=2, block=500)
    plan = repair.read_digests(spark, str(tmp_path / "t"))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_files_of_nothing(spark, tmp_path):
    repair.write_token_files(odd(spark, []), PATH, str(tmp_path / "t"), end_id=2)
    assert repair.read_digests(spark, str(tmp_path / "t")).collect() == []


# class model


def check_scores(rows, got):
    want = ordered((*r[:5], round(r[5], 6)) for r in base_scores(rows))
    columns = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score")
    assert ordered(tuple(round(r[c], 6) if c == "base_score" else r[c] for c in columns) for r in got) == want


def test_scores_of_the_table_beat_the_base(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = QUERIES["op6_brown_scores"](spark, SMALL).collect()
    check_scores([(r.doc_id, r.text) for r in docs.collect()], got)
    for held in (True, False):
        part = [r for r in got if r.held_out == held]
        assert sum(r.score for r in part) > sum(r.base_score for r in part)


def bucket_rows(lists, contexts):
    """The rows of one bucket: (chunk, hashes, counts), and (chunk, neighbours of each, classes)."""
    rows = []
    for chunk, hashes, n in lists:
        columns = {"hash": np.array(hashes, np.uint64), "count": np.array(n, np.uint32)}
        rows.append((chunk, 0, class_lm._WORDS, class_lm.WORDS.pack(columns), None))
    for chunk, n, cells in contexts:
        rows.append((chunk, 0, class_lm._CONTEXTS, class_lm.squeezed(np.array(n)), cells.tobytes()))
    names = ["chunk", "bucket", "kind", "words", "ids"]
    kinds = [pa.int64(), pa.int32(), pa.int8(), pa.binary(), pa.binary()]
    return pa.table({c: pa.array(v, k) for c, v, k in zip(names, zip(*rows, strict=True), kinds, strict=True)})


def test_counts_beyond_32_bits():
    most = 2**32 - 1
    table = bucket_rows([(c, [5, 9], [most, 1]) for c in range(3)], [])
    head, of = np.array([5], np.uint64), np.array([0, 2])
    made = class_lm._answer(head, of, np.zeros((6, 3)))(table).to_pylist()
    for row in made:
        assert class_lm.expanded(row["counts"], "<i8").tolist() == [3 * most, 3]
    assert np.frombuffer(made[0]["totals"], np.int64).tolist()[2] == 3 * most
    counted = class_lm._count_words(2)(table).to_pylist()
    assert [(r["hash"], r["count"]) for r in counted[1:]] == [(5, 3 * most), (9, 3)]
    assert counted[0]["n"] == 3 * most + 3


def test_votes_beyond_24_bits():
    """One neighbour more decides, where single precision stops adding ones."""
    n = 2**24
    cells = np.concatenate([np.full(n, 1, np.uint8), np.full(n + 2, 2, np.uint8)])
    table = bucket_rows([(0, [9], [2 * n + 2])], [(0, [2 * n + 2], cells)])
    weights = np.zeros((6, 3))
    weights[1, 1] = weights[2, 2] = 1.0
    made = class_lm._answer(np.zeros(0, np.uint64), np.zeros(1, np.int64), weights)(table).to_pylist()
    assert made[0]["classes"] == bytes([2])


def plain_scores(rows, classes=class_lm.CLASSES):
    """The score of each row, with words and classes in dictionaries."""
    tokens = [[*(t or "").encode().lower().split(), None] for _, t in rows]
    train = [ts for ts, (d, _) in zip(tokens, rows, strict=True) if not class_lm.held_out(d)]
    count = Counter(w for ts in train for w in ts)
    hashed = {w: xxhash.xxh3_64_intdigest(w) or 1 for w in count if w is not None}
    by_count = sorted(hashed, key=lambda w: (-count[w], np.uint64(hashed[w]).view(np.int64)))[: class_lm.HEAD]
    place = {None: 0} | {w: i + 1 for i, w in enumerate(by_count)}
    pairs = np.zeros((len(place), len(place)))
    for ts in train:
        for a, b in zip([None, *ts], ts, strict=False):
            if a in place and b in place:
                pairs[place[a], place[b]] += 1
    of = class_lm.exchange(pairs, classes)
    weights = class_lm.joining_weights(class_lm.class_table(pairs, of, classes))
    votes = {w: np.zeros(len(weights)) for w in hashed if w not in place}
    for ts in train:
        for a, b in zip([None, *ts], ts, strict=False):
            if b in votes and a in place:
                votes[b][of[place[a]]] += 1
            if a in votes and b in place:
                votes[a][classes + 1 + of[place[b]]] += 1
    cls = {w: int(of[i]) for w, i in place.items()}
    cls |= {w: 1 + int(np.argmax((v @ weights)[1:])) for w, v in votes.items()}
    size = Counter()
    for w, n in count.items():
        size[cls[w]] += n
    unknown = classes + 1
    table = np.zeros((classes + 2, classes + 2))
    for ts in train:
        before, rare = None, False
        for w in ts:
            once = count[w] == 1 and w is not None
            table[cls[before], cls[w]] += 1
            if once:
                table[cls[before], unknown] += 1
            if rare:
                table[unknown, cls[w]] += 1
            if once and rare:
                table[unknown, unknown] += 1
            before, rare = w, once
    logs = class_lm.transitions(table)
    out = []
    for ts in tokens:
        total, before = 0.0, 0
        for w in ts:
            c = cls[w] if count[w] else unknown
            total += logs[before, c]
            if 0 < c < unknown:
                total += math.log10(count[w] / size[c])
            before = c
        out.append(total)
    return out


@pytest.mark.parametrize("source", ["odd", "table"])
def test_scores_are_those_of_plain_classes(spark, source):
    docs = odd(spark) if source == "odd" else spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = sorted((repr(d), round(s, 6)) for (d, _), s in zip(rows, plain_scores(rows), strict=True))
    got = sorted((repr(r.doc_id), round(r.score, 6)) for r in class_lm.text_scores(docs).collect())
    assert [d for d, _ in got] == [d for d, _ in want]
    assert [s for _, s in got] == pytest.approx([s for _, s in want], abs=1e-5)


def plain_rounds(rows, head=class_lm.HEAD, classes=class_lm.CLASSES):
    """The score of each row after rounds over all words, the rounds, and each word's class."""
    texts = [[*(t or "").encode().lower().split(), None] for _, t in rows]
    held = [class_lm.held_out(d) for d, _ in rows]
    number = {w: i for i, w in enumerate(dict.fromkeys([None, *(w for ts in texts for w in ts)]))}
    hashes = np.array([0 if w is None else xxhash.xxh3_64_intdigest(w) or 1 for w in number], np.uint64)
    now = np.array([number[w] for ts in texts for w in ts])
    before = np.array([number[w] for ts in texts for w in [None, *ts[:-1]]])
    train = np.repeat(~np.array(held), [len(ts) for ts in texts])
    left, right = before[train], now[train]
    count, side = np.bincount(right, minlength=len(number)), classes + 1
    order = np.lexsort((hashes.view(np.int64), -count))
    order = order[(count[order] > 0) & (order > 0)][:head]
    place = np.full(len(number), -1)
    place[[0, *order]] = np.arange(len(order) + 1)
    pairs = np.zeros((len(order) + 1, len(order) + 1))
    both = (place[left] >= 0) & (place[right] >= 0)
    np.add.at(pairs, (place[left[both]], place[right[both]]), 1)
    of = class_lm.exchange(pairs, classes)
    cls = np.where(place >= 0, of[place], -1)

    def moved(cls, weights):
        votes = np.zeros((len(number), 2 * side))
        known = cls[left] >= 0
        np.add.at(votes, (right[known], cls[left[known]]), 1)
        known = cls[right] >= 0
        np.add.at(votes, (left[known], side + cls[right[known]]), 1)
        likeliest = 1 + np.argmax(np.round(votes @ weights, 6)[:, 1:], axis=1)
        return np.where(votes.any(axis=1), likeliest, class_lm._dealt(hashes, classes))

    def bigrams(cls):
        table = np.zeros((side, side))
        np.add.at(table, (cls[left], cls[right]), 1)
        return table

    start = moved(cls, class_lm.joining_weights(class_lm.class_table(pairs, of, classes)))
    cls, kept, best, rounds = np.where(place >= 0, cls, start), None, -np.inf, 0
    while True:
        value = class_lm.likelihood(bigrams(cls))
        kept = cls if value > best else kept
        if value <= best + class_lm.TOLERANCE * train.sum():
            break
        best = value
        for half in (0, 1):
            turn = (hashes >> np.uint64(40)) % np.uint64(2) == half
            turn[0] = False
            cls = np.where(turn, moved(cls, class_lm.joining_weights(bigrams(cls))), cls)
        rounds += 2
    cls = np.where(count > 0, kept, classes + 1)
    table = np.zeros((classes + 2, classes + 2))
    once = (count == 1) & (np.arange(len(count)) > 0)
    for a, b in zip(left, right, strict=True):
        table[cls[a], cls[b]] += 1
        table[cls[a], -1] += once[b]
        table[-1, cls[b]] += once[a]
        table[-1, -1] += once[a] and once[b]
    logs = class_lm.transitions(table)
    size = np.bincount(cls, count, classes + 2)
    emission = np.zeros(len(count))
    inside = (count > 0) & (cls > 0)
    emission[inside] = np.log10(count[inside] / size[cls[inside]])
    each = logs[cls[before], cls[now]] + emission[now]
    ends = np.cumsum([len(ts) for ts in texts])
    totals = [part.sum() for part in np.split(each, ends[:-1])]
    return totals, rounds, dict(zip(number, cls.tolist(), strict=True))


@pytest.mark.parametrize("source", ["odd", "table"])
def test_scores_after_rounds_over_all_words(spark, conf, monkeypatch, source):
    """In several chunks and buckets; rounds shuffle no chunks, and leave no table behind."""
    conf(shuffle__partitions=3)
    docs = odd(spark) if source == "odd" else spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    totals, rounds, _ = plain_rounds(rows)
    assert rounds >= 2
    plans, exchanged = [], class_lm._exchanged

    def spy(chunks, classes, folder):
        moved = spark.createDataFrame([], class_lm.MOVED_DDL).groupBy("chunk")
        met = chunks.groupBy("chunk").cogroup(moved).applyInArrow(class_lm._meet(0, classes + 1), class_lm.MET_DDL)
        plans.append(met._jdf.queryExecution().executedPlan().toString())
        return exchanged(chunks, classes, folder)

    monkeypatch.setattr(class_lm, "_exchanged", spy)
    tables = spark.catalog.listTables()
    got = class_lm.text_scores(docs.repartition(4), every_word=True).collect()
    assert plans[0].count("Exchange") <= 1 and "Bucketed: true" in plans[0]
    assert spark.catalog.listTables() == tables
    check_scores(rows, got)
    want = sorted((repr(d), round(s, 6)) for (d, _), s in zip(rows, totals, strict=True))
    got = sorted((repr(r.doc_id), round(r.score, 6)) for r in got)
    assert [d for d, _ in got] == [d for d, _ in want]
    assert [s for _, s in got] == pytest.approx([s for _, s in want], abs=1e-5)


def test_bigrams_of_rare_words_take_part_in_the_classes(spark, conf):
    """Rare words of two kinds that stand in turn, with one frequent word at the ends."""
    conf(shuffle__partitions=2)
    rnd, rows = random.Random(5), []
    for d in range(300):
        kinds = [f"{'xy'[i % 2]}{rnd.randrange(300)}" for i in range(rnd.randrange(20, 40))]
        rows.append((d, " ".join(["the the", *kinds, "the the"])))
    totals, _, cls = plain_rounds(rows, head=1, classes=4)
    kinds = [{c for w, c in cls.items() if w and w.startswith(k)} for k in (b"x", b"y")]
    assert not kinds[0] & kinds[1]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = class_lm.text_scores(df, 1, 4, every_word=True).collect()
    assert sum(r.score for r in got) == pytest.approx(sum(totals))


def test_rounds_without_training_texts(spark, conf):
    conf(shuffle__partitions=2)
    held = [d for d in range(500) if class_lm.held_out(d)][:5]
    df = spark.createDataFrame([(d, "a b") for d in held], "doc_id long, text string")
    assert {round(r.score, 9) for r in class_lm.text_scores(df, every_word=True).collect()} == {0}


def test_scores_of_odd_documents(spark):
    got = class_lm.text_scores(odd(spark)).collect()
    check_scores([(d, t) for d, t, *_ in ODD_DOCUMENTS], got)
    assert all(r.score <= 0 for r in got)
    assert class_lm.text_scores(odd(spark, [])).collect() == []


def test_scores_without_training_texts(spark):
    held = [d for d in range(500) if class_lm.held_out(d)][:5]
    df = spark.createDataFrame([(d, "a b") for d in held], "doc_id long, text string")
    assert {(r.n_tokens, r.n_known, r.train_tokens, r.base_score, round(r.score, 9)) for r in class_lm.text_scores(df).collect()} == {(3, 0, 0, 0.0, 0.0)}


def test_scores_do_not_depend_on_chunks(spark, monkeypatch):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    whole = {r.doc_id: r.score for r in class_lm.text_scores(docs).collect()}
    parts = {r.doc_id: r.score for r in class_lm.text_scores(docs.repartition(5)).collect()}
    assert whole == pytest.approx(parts)


def test_transitions_add_up_to_one():
    rnd = np.random.default_rng(4)
    pairs = rnd.integers(0, 50, (6, 6))
    pairs[3] = 0
    assert np.allclose((10 ** class_lm.transitions(pairs)).sum(axis=1), 1)


def likelihood(pairs, of, classes):
    table = class_lm.class_table(pairs, of, classes)
    f = class_lm._flog
    return f(table).sum() - f(table.sum(axis=0)).sum() - f(table.sum(axis=1)).sum()


def test_exchange_ends_where_no_single_move_helps():
    rnd = np.random.default_rng(6)
    pairs = rnd.poisson(rnd.choice([0.2, 3], size=(13, 13))).astype(float)
    of = class_lm.exchange(pairs, 3)
    assert of[0] == 0 and set(of[1:]) <= {1, 2, 3}
    best = likelihood(pairs, of, 3)
    for w in range(1, 13):
        for c in (1, 2, 3):
            moved = of.copy()
            moved[w] = c
            assert likelihood(pairs, moved, 3) <= best + 1e-6


def test_exchange_raises_the_likelihood():
    """Words of one kind mostly follow words of the other."""
    rnd = np.random.default_rng(2)
    kind = np.array([0, *rnd.integers(1, 3, 40)])
    pairs = rnd.poisson(np.where(kind[:, None] != kind[None, :], 6.0, 0.3))
    of = class_lm.exchange(pairs, 4)
    dealt = np.array([0, *(1 + np.arange(40) % 4)])
    assert likelihood(pairs, of, 4) > likelihood(pairs, dealt, 4)
    for c in range(1, 5):  # each class holds words of one kind
        assert len(set(kind[of == c])) <= 1


def test_long_texts_fill_chunks(spark):
    rows = [(i, LONG) for i in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    check_scores(rows, class_lm.text_scores(df).collect())
