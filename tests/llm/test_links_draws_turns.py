"""SimHash groups, importance resampling and conversation repair against plain versions."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import oracle
import pytest
import xxhash
from brute import ODD_DOCUMENTS, SMALL, odd, ordered

from reelhouse.llm import conversations, resampling, simhash
from reelhouse.llm.queries import ORACLES, QUERIES

# simhash


def plain_print(text):
    w = (text or "").encode().lower().split()
    made = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [b" ".join(w)] * bool(w)
    h = [xxhash.xxh64_intdigest(s, 42) for s in made]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(prints):
    """(id, print) rows to the smallest id that each print reaches."""
    parent = {p: p for _, p in prints}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(parent), 2):
        if (a ^ b).bit_count() <= 3:
            parent[root(a)] = root(b)
    least = {}
    for d, p in prints:
        if d is not None:
            least[root(p)] = min(least.get(root(p), d), d)
    return [(d, f"{p:016x}", least.get(root(p))) for d, p in prints]


def found(df):
    return ordered(tuple(r) for r in simhash.near_duplicates(df).select("doc_id", "fingerprint", "component_id").collect())


def test_simhash_of_odd_documents(spark):
    want = plain_components([(d, plain_print(t)) for d, t, *_ in ODD_DOCUMENTS])
    assert found(odd(spark)) == ordered(want)
    assert found(odd(spark, [])) == []


def test_simhash_of_the_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op11_simhash_dedup"](spark, SMALL)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    want = plain_components([(d, plain_print(t)) for d, t in docs])
    assert ordered(map(tuple, got.collect())) == ordered(want)


def test_shingles_of_long_texts_are_counted_in_pieces(monkeypatch):
    text = " ".join(f"w{i * i % 97}" for i in range(1000))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "AT_ONCE", 7)
    assert simhash.fingerprint(text) == whole == plain_print(text)


def near_prints(seed, families, each, edits):
    """Fingerprints around some centres, with up to `edits` bits changed, within few or all bits."""
    rnd = random.Random(seed)
    out = set()
    for f in range(families):
        centre = rnd.getrandbits(64)
        bits = rnd.sample(range(64), 64 if f % 2 else 9)
        for _ in range(each):
            p = centre
            for b in rnd.sample(bits, rnd.randint(0, edits)):
                p ^= 1 << b
            out.add(p)
    return sorted(out)


def grouped(nodes, links):
    parent = {p: p for p in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        assert (a ^ b).bit_count() <= 3
        parent[root(a)] = root(b)
    return Counter(frozenset(g) for g in groups_of(nodes, root))


def groups_of(nodes, root):
    out = defaultdict(list)
    for p in nodes:
        out[root(p)].append(p)
    return out.values()


@pytest.mark.parametrize("direct", [2, 8, 1024])
def test_links_join_what_is_linked(spark, monkeypatch, tmp_path, direct):
    """Also where meetings are split by quarters, and looked up by masks."""
    monkeypatch.setattr(simhash, "DIRECT", direct)
    nodes = near_prints(direct, 8, 60, 6)
    df = spark.createDataFrame([(int(np.uint64(p).view(np.int64)),) for p in nodes], "fingerprint long")
    got = [(a % 2**64, b % 2**64) for a, b in simhash.links(df, str(tmp_path / "run")).collect()]
    every = [(a, b) for a, b in itertools.combinations(nodes, 2) if (a ^ b).bit_count() <= 3]
    want = grouped(nodes, every)
    assert 8 < len(want) < len(nodes)
    assert grouped(nodes, got) == want


def test_masks_find_what_comparing_finds():
    rnd = random.Random(3)
    for _ in range(20):
        free = sorted(rnd.sample(range(64), 18))
        base = rnd.getrandbits(64)
        members = {base ^ sum(1 << b for b in free if rnd.random() < 0.5) for _ in range(150)}
        members = np.array(sorted(members), np.uint64)
        nodes = members.tolist()
        name = lambda pairs: [(nodes[x], nodes[y]) for x, y in pairs]
        direct = grouped(nodes, name(simhash.links_directly(members)))
        assert grouped(nodes, name(simhash.links_by_masks(members, free))) == direct


def test_neighbours_differ_in_one_bit(spark):
    rnd = random.Random(5)
    values = {rnd.getrandbits(32) for _ in range(40)} | {0, 2**32 - 1}
    values |= {v ^ 1 << rnd.randrange(32) for v in values}
    rows = [(h, v, 0, 1) for h in (0, 1) for v in values]
    df = spark.createDataFrame(rows, "half int, value long, one long, size long")
    got = {tuple(r) for r in simhash.neighbours(df).collect()}
    want = {(h, w, a, a | 1 << w) for h in (0, 1) for w in range(32) for a in values if not a >> w & 1 and a | 1 << w in values}
    assert got == want and len(want) > 80


# importance resampling


def plain_draw(docs, target, percent=10, least=20, max_run=1):
    def words(t):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)

    def buckets(t):
        w = words(t)
        runs = [" ".join(w[i : i + n]) for n in range(1, max_run + 1) for i in range(len(w) - n + 1)]
        return [zlib.crc32(r.encode()) % 10_000 for r in runs]

    have = [(d, len(words(t)), buckets(t)) for d, t in docs]
    s, t = Counter(b for *_, bs in have for b in bs), Counter(b for x in target for b in buckets(x))
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (s_all + 10_000) / ((s[b] + 1) * (t_all + 10_000)))) for b in s}
    rows = []
    for d, n, bs in have:
        weight = sum(gain[b] for b in bs) // len(bs) if bs else 0
        h = int(hashlib.sha256(f"2024:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        rows.append([d, len(bs), weight, score, None, n])
    able = sorted(
        (r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2])
    )
    for i, r in enumerate(able[: percent * len(able) // 100]):
        r[4] = i + 1
    return [tuple(r[:5]) for r in rows]


def test_draw_equals_its_sql(spark):
    got = QUERIES["op12_importance_resampling"](spark, SMALL)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert oracle.difference(got, oracle.connect(SMALL), ORACLES["op12_importance_resampling"]) is None


@pytest.mark.parametrize("percent", [10, 60, 100])
def test_draw_of_odd_documents(spark, monkeypatch, percent):
    monkeypatch.setattr(resampling, "COPIES", 3)
    rows = [(d, t) for d, t, *_ in ODD_DOCUMENTS] + [(20, "Some words of 20 " * 6)] * 10
    target = ["some words", None, "", "of the ones that ARE here 7"]
    df = odd(spark, [(d, t, "en", "a", 1) for d, t in rows])
    against = spark.createDataFrame([(t, i) for i, t in enumerate(target)], "text string, key long")
    got = resampling.resampled(df, against, percent=percent).collect()
    assert ordered(map(tuple, got)) == ordered(plain_draw(rows, target, percent))
    assert sum(r.rank is not None for r in got) > (0 if percent == 10 else 5)


def test_draw_of_nothing_and_towards_nothing(spark):
    df = odd(spark, [])
    assert resampling.resampled(df, df).collect() == []
    some = odd(spark)
    got = resampling.resampled(some, df).collect()
    assert ordered(map(tuple, got)) == ordered(plain_draw([(d, t) for d, t, *_ in ODD_DOCUMENTS], []))


@pytest.mark.parametrize("max_run", [1, 2, 3])
def test_long_texts_are_cut_between_words(max_run):
    rnd = random.Random(max_run)
    text = "".join(rnd.choice(["a", "B", "é9", "z0", " ", ", ", "\n", "日本"]) for _ in range(2000))
    known = resampling.FeatureBuckets(10_000)
    n, whole = resampling.feature_buckets(text, known, max_run)
    for size in (1, 5, 64):
        m, made = resampling.feature_buckets(text, known, max_run, size)
        assert m == n and Counter(made.tolist()) == Counter(whole.tolist())


# conversation repair

EDIT_COST = {"D": 3, "I": 2, "R": 2, "K": 0}


def plain_repair(rows):
    """(cost, edits, repaired rows) by trying all edits; rows: (role, text, truncated, must go)."""
    best = [(math.inf, "", ())]

    def go(i, cost, audit, made):
        initials = "".join(r[:1] for r, _ in made)
        if cost > best[0][0] or not re.fullmatch(r"s?((ua)*u?)", initials):
            return
        if i == len(rows):
            if re.fullmatch(r"(s?(ua)+)?", initials):
                best[0] = min(best[0], (cost, audit, made))
        else:
            role, text, truncated, must_go = rows[i]
            go(i + 1, cost + 3, audit + "D", made)
            if not must_go:
                if role:
                    go(i + 1, cost + truncated, audit + "K", (*made, (role, text)))
                for new in ("user", "assistant"):
                    go(i + 1, cost + 2 + truncated, audit + "R", (*made, (new, text)))
        if not audit.endswith("II"):
            for new in ("user", "assistant"):
                go(i, cost + 2, audit + "I", (*made, (new, "")))

    go(0, 0, "", ())
    return best[0]


def random_rows(rnd, n):
    roles = ["user", "assistant", "system", "tool", " ", "", "usher"]
    return [(rnd.choice(roles), f"t{i}", rnd.random() < 0.3, rnd.random() < 0.15) for i in range(n)]


def test_repair_is_the_cheapest_and_first():
    rnd = random.Random(1)
    for _ in range(400):
        rows = random_rows(rnd, rnd.randint(0, 5))
        cost, audit, _ = plain_repair(rows)
        kinds = bytes(conversations.kind(r, t, g) for r, _, t, g in rows)
        for block in (1, 2, 3, 256):
            assert conversations.repair(kinds, block) == (cost, audit), (rows, block)


def test_blocks_of_long_conversations_agree():
    rnd = random.Random(2)
    for n in (40, 301, 900):
        kinds = bytes(conversations.kind(r, t, g) for r, _, t, g in random_rows(rnd, n))
        whole = conversations.repair(kinds, n)
        assert "I" in whole[1]
        for block in (1, 7, 64, 256):
            assert conversations.repair(kinds, block) == whole


def plain_digests(rows):
    """The contract, row by row: (conv_id, turn, role, text)."""
    kept = defaultdict(list)
    for conv, turn, role, text in rows:
        kept[conv]
        spelled = (" " if x is None else str(x) for x in (conv, turn))
        harm = zlib.crc32(":".join(spelled).encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if harm == 0:
            continue
        text = "" if harm == 1 else re.sub("[.!?]", "", text) if harm == 2 else text
        kept[conv] += [(turn, "user" if harm == 4 else role, text)] * (2 if harm == 3 else 1)
    out = []
    for conv, left in kept.items():
        left.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, faults, judged = set(), Counter(), []
        for _, role, text in left:
            solid = re.sub(r"[\x20\x09-\x0D]", "", text)
            fault = "blank" if not solid else "duplicate" if (role, text) in seen else ""
            fault = fault or ("truncated" if solid[-1] not in ".!?" else "")
            seen.add((role, text))
            faults[fault] += 1
            judged.append((role, text, fault == "truncated", fault in ("blank", "duplicate")))
        turns = {t for t, *_ in left if t is not None}
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(left))
        cost, audit, made = plain_repair(judged)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest()
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out.append((conv, gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, digest))
    return out


CONVERSATION_DDL = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def odd_conversations(spark, rows):
    df = spark.createDataFrame(rows, CONVERSATION_DDL)
    return df.selectExpr("*", *(f"{i} AS {c}" for i, c in enumerate(["same", "copy", "gone", "fault", "number", "harm", "audit"])))


def test_digests_of_odd_conversations(spark):
    rnd = random.Random(4)
    roles = ["user", "assistant", "system", None, "", "tool"]
    texts = ["Yes.", "No!", "and so", " \n\t", None, "", "Well?\r\n", "é", "a\x85", "q" * 50_000 + ". "]
    rows = [
        (c, rnd.choice([None, *range(7)]), rnd.choice(roles), rnd.choice(texts))
        for c in [None, *range(60)]
        for _ in range(rnd.randint(1, 6))
    ]
    # ties that are not equal would need the digest's order
    rows = list({(c, t): (c, t, r, x) for c, t, r, x in rows}.values())
    rows += [(100, 1, "user", "Same?"), (100, 1, "user", "Same?"), (100, 2, "assistant", "Yes.")]
    df = conversations.damaged(odd_conversations(spark, rows))
    got = conversations.repair_digests(df, block=2)
    assert got.columns == COLUMNS
    assert ordered(map(tuple, got.collect())) == ordered(plain_digests(rows))


def test_digests_of_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select(*COLUMNS[:1], "turn", "role", "text").collect()]
    got = QUERIES["op13_conversation_repair"](spark, SMALL)
    assert got.columns == COLUMNS
    assert ordered(map(tuple, got.collect())) == ordered(plain_digests(rows))


def test_digests_of_nothing(spark):
    assert conversations.repair_digests(conversations.damaged(odd_conversations(spark, []))).collect() == []


def test_repaired_rows_have_the_pattern(spark, tmp_path):
    rows = conversations.damaged(spark.read.parquet(f"{SMALL}/conversations.parquet"))
    planned = conversations.plans(conversations.judged(rows, str(tmp_path)))
    made = conversations.repaired_rows(spark.read.parquet(str(tmp_path / "rows")), planned).collect()
    by_conv = defaultdict(dict)
    for r in made:
        by_conv[r.conv_id][r.place] = (r.role, r.text)
    assert len(by_conv) > 10
    want = {r.conv_id: r.repaired_sha256 for r in QUERIES["op13_conversation_repair"](spark, SMALL).collect()}
    for conv, got in by_conv.items():
        inside = [got[i] for i in range(len(got))]
        assert re.fullmatch(r"s?(ua)+", "".join(r[0] for r, _ in inside))
        assert hashlib.sha256("\n".join(f"{r}:{t}" for r, t in inside).encode()).hexdigest() == want[conv]
