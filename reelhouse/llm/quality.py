"""Quality rules, line first: lines that fail go, and a document that loses too much goes whole.

Method: every line of a document is judged on its own by punctuation, navigation and
boilerplate rules. The lines that fail are removed. The document is rejected if the removed
lines hold more than a fixed share of its words, or if it fails the base rules (too short, or
mostly repeated three-word windows). One narrow pass over the texts, without a shuffle.

Cases: a null or empty text has no words, fails the base rules and keeps no line. Repeated rows
are judged one by one. Lines without a word are neither judged nor counted. Rows with a null id
are judged like any other. Texts and lines of any length are judged whole. An empty table gives no
rows. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from reelhouse.llm.rows import WORD, chosen, over_batches

#: Characters that count as symbols, words that separate menu items, phrases of
#: notices that repeat on many documents (compared in lower case).
SYMBOLS = "#*$%&|<>"
SEPARATORS = ("|", "»", "›", "•", "·", "::", ">>")
BOILERPLATE = (
    "all rights reserved",
    "licensed under",
    "released under",
    "terms of service",
    "terms of use",
    "privacy policy",
    "cookie policy",
    "accept cookies",
    "click here",
    "sign up for our newsletter",
    "enable javascript",
    "lorem ipsum",
)
_PHRASES = re.compile("|".join(map(re.escape, BOILERPLATE)))


@dataclass(frozen=True)
class QualityRules:
    """Shares are whole percentages, so that other engines can repeat the comparisons."""

    min_words: int = 50
    max_repeat_pct: int = 50
    max_symbol_pct: int = 10
    min_separator_pct: int = 20
    min_shout_pct: int = 50
    max_lost_pct: int = 30


RESULT = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, base_failed boolean, kept boolean, n_lost_words long, cleaned string"
)


def count_symbols(text: str) -> int:
    return sum(map(text.count, SYMBOLS))


def repeated_window_words(words: list[str]) -> int:
    """Words inside three-word windows that occur at least twice in the text."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    seen = Counter(windows)
    total, covered_to = 0, 0
    for i, window in enumerate(windows):
        if seen[window] > 1:
            total += i + 3 - max(i, covered_to)
            covered_to = i + 3
    return total


def line_fails(line: str, words: list[str], rules: QualityRules) -> bool:
    """Whether a line with words breaks a punctuation, navigation or boilerplate rule."""
    n = len(words)
    if 100 * count_symbols(line) > rules.max_symbol_pct * sum(map(len, words)):
        return True
    if 100 * sum(map(words.count, SEPARATORS)) >= rules.min_separator_pct * n:
        return True
    if "!!" in line and 100 * sum(w.endswith("!!") for w in words) >= rules.min_shout_pct * n:
        return True
    return _PHRASES.search(line.lower()) is not None


def clean_lines(text: str, rules: QualityRules) -> tuple[str, int, int]:
    """The text without failed and repeated lines, the words lost, and the repeated lines."""
    kept, seen, lost, repeated = [], set(), 0, 0
    for line in text.split("\n"):
        words = WORD.findall(line)
        if not words:
            kept.append(line)
            continue
        again = line in seen
        seen.add(line)
        repeated += again
        if again or line_fails(line, words, rules):
            lost += len(words)
        else:
            kept.append(line)
    return "\n".join(kept), lost, repeated


def judge(text: str | None, rules: QualityRules) -> tuple:
    """The measures of one text, in the order of `RESULT` after the id."""
    text = text or ""
    words = WORD.findall(text)
    n = len(words)
    repeats = repeated_window_words(words)
    cleaned, lost, dup_lines = clean_lines(text, rules)
    failed = n < rules.min_words or 100 * repeats > rules.max_repeat_pct * n
    kept = not failed and 100 * lost <= rules.max_lost_pct * n
    chars = sum(map(len, words))
    return n, chars, count_symbols(text), dup_lines, repeats, failed, kept, lost, cleaned


def quality_verdicts(
    docs: DataFrame, rules: QualityRules | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row of `RESULT` per row of `docs`; `cleaned` is the text without the removed lines."""
    rules = rules or QualityRules()

    def make():
        def run(ids, texts):
            rows = [judge(t, rules) for t in texts.to_pylist()]
            return [ids, *(list(zip(*rows, strict=True)) if rows else [[] for _ in range(9)])]

        return run

    return over_batches(chosen(docs, doc_id=id_col, text=text_col), make, RESULT)


def cleaned_documents(
    docs: DataFrame,
    rules: QualityRules | None = None,
    text_col: str = "text",
    length_col: str | None = "n_chars",
) -> DataFrame:
    """The rows that pass, with all their columns, the cleaned text, and its length in
    `length_col` if the rows have that column."""
    rules = rules or QualityRules()
    struct = docs.schema

    def run(batches):
        for batch in batches:
            judged = [judge(t, rules) for t in batch.column(text_col).to_pylist()]
            keep = pa.array([j[6] for j in judged], pa.bool_())
            texts = [j[8] for j in judged if j[6]]
            batch = batch.filter(keep)
            made = {text_col: texts, length_col: list(map(len, texts))}
            yield pa.RecordBatch.from_arrays(
                [pa.array(made[f.name], f.type) if f.name in made else batch.column(f.name) for f in batch.schema],
                schema=batch.schema,
            )

    return docs.mapInArrow(run, struct)


def digest(docs: DataFrame) -> DataFrame:
    """The columns of the registered query."""
    return quality_verdicts(docs).drop("cleaned")


#: The same in SQL, over `documents`.
SQL = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) > 1 AS again FROM (
    SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d))
), repeats AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (
    SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM windows WHERE again) GROUP BY doc_id
), raw_lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS k FROM d
), worded AS (
  SELECT doc_id, line, k, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS w FROM raw_lines
), lines AS (
  SELECT doc_id, len(w) AS n,
         row_number() OVER (PARTITION BY doc_id, line ORDER BY k) > 1 AS again,
         100 * len(regexp_extract_all(line, '[#*$%&|<>]'))
           > {QualityRules.max_symbol_pct} * length(array_to_string(w, ''))
         OR 100 * len(list_filter(w, lambda x: x IN ({", ".join(f"'{s}'" for s in SEPARATORS)})))
           >= {QualityRules.min_separator_pct} * len(w)
         OR (contains(line, '!!') AND 100 * len(list_filter(w, lambda x: ends_with(x, '!!')))
           >= {QualityRules.min_shout_pct} * len(w))
         OR {" OR ".join(f"contains(lower(line), '{p}')" for p in BOILERPLATE)} AS bad
  FROM worded WHERE len(w) > 0
), lost AS (
  SELECT doc_id, sum(again::int) AS dup, sum(CASE WHEN again OR bad THEN n ELSE 0 END) AS n
  FROM lines GROUP BY doc_id
), measured AS (
  SELECT d.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
         coalesce(l.dup, 0) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
         coalesce(l.n, 0) AS n_lost_words
  FROM d LEFT JOIN repeats r ON d.doc_id = r.doc_id LEFT JOIN lost l ON d.doc_id = l.doc_id
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars,
       n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
       n_repeat_words::BIGINT AS n_repeat_words,
       n_words < {QualityRules.min_words}
         OR 100 * n_repeat_words > {QualityRules.max_repeat_pct} * n_words AS base_failed,
       NOT (n_words < {QualityRules.min_words}
         OR 100 * n_repeat_words > {QualityRules.max_repeat_pct} * n_words)
         AND 100 * n_lost_words <= {QualityRules.max_lost_pct} * n_words AS kept,
       n_lost_words::BIGINT AS n_lost_words
FROM measured
"""
