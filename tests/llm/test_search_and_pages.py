"""Nearest neighbours against brute force, extraction against labelled pages, and the registry."""

from __future__ import annotations

import html
import random
import re
import time

import numpy as np
import pytest
from brute import SMALL, ordered
from pyspark.sql import functions as F

import oracle
from reelhouse.llm import crf, dom, extract, labelled_pages, nearest
from reelhouse.llm.dom import leaf_blocks
from reelhouse.llm.queries import ORACLES, QUERIES

VECTOR_DDL = "vec_id long, embedding array<float>, label int"


def brute_nearest(rows, k):
    """(query, rank, id) by looking at all rows."""
    good = {
        (i, tuple(v))
        for i, v in rows
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    }
    out = []
    for q, x in good:
        if q % 20:
            continue
        scores = [
            (-sum(float(a) * float(b) for a, b in zip(x, y, strict=True)), i)
            for i, y in good
            if i != q and len(x) == len(y)
        ]
        out += [(q, n + 1, i) for n, (_, i) in enumerate(sorted(scores)[:k])]
    return ordered(out)


def found(df, **options):
    got = nearest.search(df, F.col("vec_id") % 20 == 0, **options)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    return ordered((r.query_id, r["rank"], r.vec_id) for r in got.collect())


def test_search_of_the_table(spark):
    con = oracle.connect(SMALL)
    assert oracle.difference(QUERIES["op4_rabitq_search"](spark, SMALL), con, nearest.SQL) is None


def test_recall_over_several_blocks(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float64)
    queries = np.flatnonzero(ids % 20 == 0)
    scores = x[queries] @ x.T
    scores[np.arange(len(queries)), queries] = -np.inf
    want = {(ids[q], ids[c]) for q, s in zip(queries, scores, strict=True) for c in np.argsort(-s)[:20]}
    got = nearest.search(vectors, F.col("vec_id") % 20 == 0, block=300, batch=30).collect()
    hits = want & {(r.query_id, r.vec_id) for r in got}
    assert len(hits) >= 0.99 * len(want)


def test_search_of_odd_vectors(spark):
    rnd = np.random.default_rng(8)
    same = rnd.standard_normal(8).astype(np.float32).tolist()
    rows = [(i, same) for i in range(0, 300, 4)]  # ties, one very common vector
    rows += [(1000 + i, rnd.standard_normal(8).astype(np.float32).tolist()) for i in range(60)]
    rows += [(1003, rows[-1][1]), (1001, rows[-2][1]), (1001, rows[-2][1])]  # shared ids, repeated rows
    rows += [(2000, None), (2020, []), (2040, [0.0] * 8), (2060, [1.0, None] + [0.0] * 6)]
    rows += [(2080, [float("nan")] * 8), (2100, [float("inf")] + [0.0] * 7), (None, same)]
    rows += [(1100 + i, [3e38 - i * 1e36] * 8) for i in range(8)]  # too large for single precision
    rows += [(3000, [1.0, 2.0]), (3001, [2.0, 1.0]), (3020, [-1.0])]  # other dimensions
    df = spark.createDataFrame([(i, v, None) for i, v in rows], VECTOR_DDL).withColumn("block", F.lit(1))
    # components that are not exact in single precision make scores differ in the last place
    want = brute_nearest(rows, 5)
    assert found(df, k=5) == want
    assert found(df, k=5, block=40, batch=3) == want


def test_search_of_nothing(spark):
    df = spark.createDataFrame([], VECTOR_DDL)
    assert found(df) == []


def test_estimates_keep_their_bounds():
    rnd = np.random.default_rng(9)
    x = rnd.standard_normal((2000, 64))
    block = nearest.pa.table({"block": [0] * 2000, "vec_id": range(2000), "embedding": x.tolist()})
    index = nearest.BlockIndex(nearest._build(block).to_pylist()[0])
    q = rnd.standard_normal((50, 64))
    estimate = (q @ nearest.rotation(64).T).astype(np.float32) @ index.signs * index.scale
    error = np.abs(estimate + (q @ index.centre)[:, None] - q @ x.T)
    bound = nearest.CONFIDENCE * np.linalg.norm(q, axis=1)[:, None] * index.bound
    assert (error <= bound).mean() > 0.98


# pages


def test_blocks_of_labelled_pages_match_their_labels():
    for page, labels in labelled_pages.pages(200, seed=5):
        assert len(leaf_blocks(page)) == len(labels)


def test_held_out_pages():
    field, wrong, total = extract.model(), 0, 0
    for page, labels in labelled_pages.pages(200, seed=321):
        got = field.decode(*extract.sequence(leaf_blocks(page)))
        wrong += sum(a != b for a, b in zip(got, labels, strict=True))
        total += len(labels)
    assert wrong <= 0.01 * total


def article_of(page: str) -> str:
    inside = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = [re.sub(r"<[^>]*>", "", b.replace("<br>", " ")) for b in re.split(r"</?(?:p|h1)>", inside)]
    texts = [" ".join(html.unescape(b).split()) for b in blocks]
    return "\n\n".join(t for t in texts if t)


def test_articles_of_the_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    got = {r.page_id: r for r in QUERIES["op7_crf_extract"](spark, "/root/testdata/sf0.01").collect()}
    assert len(got) == len(pages)
    for p in pages:
        assert got[p.page_id].text == article_of(p.html)
        assert got[p.page_id].n_chars == len(got[p.page_id].text)


ODD_PAGES = [
    (1, None, None),
    (2, "u", ""),
    (None, "u", "<p>" + "A plain sentence, with some words in it. " * 3),
    (4, "u", "<!-- never closed <p>text</p>"),
    (5, "u", "<article><p>One &amp; two&nbsp;&lt;three&gt; " + "and more words, " * 20 + "end.<script>if (a<b) x('</p>')"),
    (6, "u", "a < b and c > d <"),
    (7, "u", '<div class="unclosed quote><p>Text</p>' * 50),
    (8, "u", "<p>" * 5000 + "deep" + "</p>" * 10),
    (9, "u", "<article>" + "<p>A long paragraph, of many words that go on. " * 4000),
    (1, None, None),
]


def test_odd_pages(spark):
    df = spark.createDataFrame(ODD_PAGES, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = extract.extract_text(df).collect()
    assert [(r.page_id, r.url) for r in got] == [(p, u) for p, u, _ in ODD_PAGES]
    assert [r.text for r in got[:2]] == ["", ""] and got[3].text == ""
    assert got[4].text.startswith("One & two <three> and more words,") and got[4].text.endswith("end.")
    assert got[8].text.count("\n\n") == 3999
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert extract.extract_text(empty).collect() == []


SENTENCE = "A plain sentence, with some more words in it, that goes on for a while. "
ARTICLE = "<article><h1>A heading</h1>" + f"<p>{SENTENCE * 3}</p>" * 5 + "</article>"


@pytest.mark.parametrize("sentences", [6, 10, 15, 60])
@pytest.mark.parametrize("opening", ["<div><p>", "<p>", '<div class="notice"><p>', "<section>"])
def test_notices_that_name_themselves_late(sentences, opening):
    """After 430 characters and more, in front of the article and behind it."""
    field = extract.model()
    want = extract.main_blocks(f"<body>{ARTICLE}</body>", field)
    assert len(want) == 6
    notice = f"{opening}{SENTENCE * sentences}We use cookies, subscribe to our newsletter."
    notice += "".join(f"</{t}>" for t in reversed(re.findall(r"<(\w+)", opening)))
    assert extract.main_blocks(f"<body>{notice}{ARTICLE}</body>", field) == want
    assert extract.main_blocks(f"<body>{ARTICLE}{notice}</body>", field) == want


def test_articles_may_speak_of_cookies_and_comments():
    article = ARTICLE.replace(SENTENCE * 3, SENTENCE * 9 + "She left comments and a reply about the cookie.")
    assert len(extract.main_blocks(f"<body>{article}</body>", extract.model())) == 6


N = 60_000
DEEP_PAGES = [
    "<b>" * N + "</i>" * N,
    "<div>" * N + "</section>" * N,
    "<svg>" * N + "</g>" * N,
    "<i><div>" + "<b>" * N + "</i>" * N,
    "<b>" * N + "x</section>" * N,
    "<li>" * N + "<p>" * N,
    "<td><b>" * N + "<td>" * N,
    "<p><b>" * N + "</p>" * N,
    "<!" * 2 * N,
    "<a " * 2 * N,
    "<script>" + "</script" * N,
    "<!--" * N,
]


@pytest.mark.parametrize("page", DEEP_PAGES, ids=[p[:12] for p in DEEP_PAGES])
def test_deep_pages_are_read_in_linear_time(page):
    """Pages of 300 KB; each took minutes or more where tags walked over all open elements."""
    begun = time.process_time()
    leaf_blocks("<p>One</p>" + page)
    assert time.process_time() - begun < 2


def plain_end_tags(tags):
    """Open elements after each tag, by walking over all of them."""
    stack, out = [], []
    for tag in tags:
        if tag[0] != "/":
            for i in range(len(stack) - 1, -1, -1):
                if stack[i] in dom.CLOSES.get(tag, ()):
                    del stack[i:]
                    break
                if stack[i] in dom._STOPS:
                    break
            stack.append(tag)
        else:
            tag = tag[1:]
            for i in range(len(stack) - 1, -1, -1):
                if stack[i] == tag:
                    del stack[i:]
                    break
                if tag in dom.INLINE and stack[i] not in dom.INLINE:
                    break
        out.append(list(stack))
    return out


def test_open_elements_are_those_of_a_walk():
    rnd = random.Random(3)
    names = ["p", "li", "ul", "td", "tr", "table", "b", "i", "a", "div", "dd", "dt", "section"]
    for _ in range(200):
        tags = [rnd.choice(["", "/"]) + rnd.choice(names) for _ in range(60)]
        opened, got = dom._Open(), []
        for tag in tags:
            if tag[0] == "/":
                opened.close(tag[1:])
            else:
                if tag in dom.CLOSES:
                    opened.make_room(dom.CLOSES[tag])
                opened.push((tag, frozenset(), 0, 0))
            got.append([e[0] for e in opened.elements[1:]])
            assert opened.holder()[0] == next((t for t in reversed(got[-1]) if t not in dom.INLINE), "")
        assert got == plain_end_tags(tags)


ICONS = [
    '<svg class="icon" viewBox="0 0 9 9"/>',
    "<SVG width=9 height=9 />",
    '<svg viewBox="0 0 9 9"><title>Icon</title><desc/><g><path d="M0 0h9"/><use href="#a"></use></g></svg>',
    "<svg><style>path{fill:red}</style><metadata>made by hand</metadata><circle r=4></circle></svg>",
]


@pytest.mark.parametrize("icon", ICONS)
def test_icons_do_not_change_a_page(icon):
    """In front of the page's parts, at the beginning of its blocks and inside their lines."""
    field = extract.model()
    for page, labels in labelled_pages.pages(25, seed=11):
        marked = re.sub(r"<(p|h1|h2|article|main|li|body)([^>]*)>", lambda m: f"{m[0]}{icon}", page)
        marked = re.sub(r"<(article|main|section|div)", lambda m: icon + m[0], marked)
        marked = marked.replace(". ", f".{icon} ")
        assert marked.count(icon) > len(labels) / 4
        assert [b.text for b in leaf_blocks(marked)] == [b.text for b in leaf_blocks(page)]
        assert extract.main_blocks(marked, field) == extract.main_blocks(page, field)


@pytest.mark.parametrize(
    "opening", ["<object data=x>", "<canvas id=c>", "<template>", "<svg class=x>", "<svg><title>", "<object data=x />"]
)
def test_unclosed_elements_keep_the_rest_of_the_page(opening):
    field, sentence = extract.model(), "A plain sentence, with some more words in it. "
    article = "<article><h1>A heading of some words</h1>" + f"<p>{sentence * 3}</p>" * 4 + "</article>"
    want = extract.main_blocks(f"<body>{article}</body>", field)
    assert len(want) == 5
    assert extract.main_blocks(f"<body>{opening}{article}</body>", field) == want
    assert extract.main_blocks(f"<body>{article.replace('<p>', opening + '<p>', 1)}</body>", field) == want
    inside = leaf_blocks("<p>One</p><object><p>Two</p></object><canvas>Three</canvas><template><p>Four</template>")
    assert [b.text for b in inside] == ["One", "Two", "Three", "Four"]
    assert ["in:object" in b.marks for b in inside] == [False, True, False, False]


def test_text_of_a_drawing_is_kept():
    drawn = "<div>See <svg><a href=x><text>one</text><text>two</text></a></svg>.</div><svg><foreignObject><p>three</p></foreignObject></svg>"
    assert [b.text for b in leaf_blocks(drawn)] == ["See one two .", "three"]


def test_viterbi_and_gradients():
    rnd = random.Random(7)
    sequences = [[[rnd.choice("abc")] for _ in range(rnd.randint(1, 6))] for _ in range(40)]
    kinds = [[rnd.randint(0, 1) for _ in s] for s in sequences]
    labels = [[int(f[0] == "a" or (i > 0 and s[i - 1][0] == "b")) for i, f in enumerate(s)] for s in sequences]
    field = crf.fit(sequences, kinds, labels, 2, rounds=40)

    def score(s, k, y):
        state = field.scores(s)
        total = field.start[y[0]] + sum(state[i, v] for i, v in enumerate(y))
        return total + sum(field.edge[k[i], y[i - 1], y[i]] for i in range(1, len(y)))

    for s, k in zip(sequences, kinds, strict=True):
        every = [[(n >> i) & 1 for i in range(len(s))] for n in range(2 ** len(s))]
        best = max(score(s, k, y) for y in every)
        assert score(s, k, field.decode(s, k)) == pytest.approx(best)
    right = sum(a == b for s, k, y in zip(sequences, kinds, labels, strict=True) for a, b in zip(field.decode(s, k), y, strict=True))
    assert right > 0.8 * sum(map(len, labels))


def test_the_registry():
    import __spark_entry__ as entry

    names = entry.queries()
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(names)
    assert set(ORACLES) <= set(QUERIES)
