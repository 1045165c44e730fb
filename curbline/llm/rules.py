"""Quality rules as a short-circuit cascade of built-in expressions.

Each rule rejects some texts. On a sample, every rule's cost and the share that it rejects are
measured; rules then run in the order of rejections per cost, and a text that one of them
rejects is not tried on the others. The order changes the work, never the verdict.

Statistics that every text is reported with are there for rules to compare, and cost them nothing more.
The other rules read the text itself, and only of what the rules before them let through.
"""

from __future__ import annotations

import statistics
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbline.llm.common import stored

# Texts that costs and selectivities are measured on.
SAMPLE = 2000
# Times that the cost of each rule is measured; the median counts.
TIMINGS = 5
WINDOW = 5
HAS_WORD = r"[^\x20\x09-\x0D]"


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, although ``use`` names it several times."""
    return F.transform(F.array(value), use)[0]


def word_list(text: Column) -> Column:
    """Runs of anything but a space, tab, LF, VT, FF or CR."""
    for blank in "\t\n\x0b\x0c\r":
        text = F.replace(text, F.lit(blank), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def repeated_window_words(words: Column) -> Column:
    """Words in windows of WINDOW words that the text has twice or more, the first included.

    Windows are compared by 64-bit hashes. Texts without a repeat, most of them, end at the count
    of distinct windows; of the others, windows are sorted and the words that repeated ones
    cover are counted once.
    """
    size = WINDOW

    def windows(h: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(h) - size)
        return F.transform(starts, lambda i: F.xxhash64(*(F.get(h, i + k) for k in range(size))))

    def covered(at: Column) -> Column:
        """Words that the windows beginning at the ascending places ``at`` cover."""
        steps = F.transform(
            F.sequence(F.lit(1), F.size(at)),
            lambda k: F.coalesce(F.least(F.get(at, k) - F.get(at, k - 1), F.lit(size)), F.lit(size)),
        )
        return F.aggregate(steps, F.lit(0).cast("bigint"), lambda a, x: a + x)

    def repeats(w: Column) -> Column:
        pairs = F.sort_array(F.transform(w, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def twice(p: Column) -> Column:
            same = F.filter(
                p,
                lambda s, j: F.coalesce(
                    (j > 0) & (F.get(p, j - 1)["h"] == s["h"]), F.lit(False)
                )
                | F.coalesce(F.get(p, j + 1)["h"] == s["h"], F.lit(False)),
            )
            return F.sort_array(F.transform(same, lambda s: s["i"]))

        return bound(bound(pairs, twice), covered)

    def count(w: Column) -> Column:
        return F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("bigint")).otherwise(
            repeats(w)
        )

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) < size + 1, F.lit(0).cast("bigint")).otherwise(
        bound(hashes, lambda h: bound(windows(h), count))
    )


def with_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, text and the statistics that rules ask for. A null text is an empty one."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(HAS_WORD))
    listed = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"), word_list(text).alias("words"),
        lines.alias("lines"),
    )
    return listed.select(
        "doc_id",
        "text",
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        repeated_window_words(F.col("words")).alias("n_repeat_words"),
    )


@dataclass(frozen=True)
class Rule:
    """``rejects`` is true for a text to reject; null counts as false."""

    name: str
    rejects: Column


def base_rules() -> list[Rule]:
    n_words, repeated = F.col("n_words"), F.col("n_repeat_words")
    return [Rule("few_words", n_words < 10), Rule("repetition", 100 * repeated > 20 * n_words)]


def default_rules() -> list[Rule]:
    """The rules beside the base rules. Limits are per cent of words, characters or lines.

    The first three compare statistics. The others have costs of their own.
    """
    n_words, chars, text = F.col("n_words"), F.col("word_chars"), F.col("text")

    def count_of(pattern: str) -> Column:
        return F.regexp_count("text", F.lit(pattern))

    distinct = F.size(F.array_distinct(F.split(F.lower("text"), "")))
    return [
        Rule("symbols", 100 * F.col("n_symbols") > 8 * chars),
        Rule("duplicate_lines", 100 * F.col("n_dup_lines") > 30 * F.col("n_lines")),
        Rule("word_length", (chars < 2 * n_words) | (chars > 20 * n_words)),
        Rule("shouting", 100 * count_of("!!") > 30 * n_words),
        Rule("digits", 100 * count_of("[0-9]") > 60 * chars),
        Rule("open_brackets", 100 * F.abs(count_of("[(]") - count_of("[)]")) > 50 * n_words),
        Rule("endless_word", text.rlike(r"[^\x20\x09-\x0D]{1000}")),
        Rule("few_characters", distinct < 8),
    ]


def measured(sample: DataFrame, rules: list[Rule]) -> list[tuple[Rule, float, float]]:
    """Each rule with its cost in seconds and the share that it rejects, on a sample that is stored
    with its statistics: the cost is the rule's own, net of reading and of what rules share."""

    def once(condition: Column) -> tuple[float, float]:
        began = time.perf_counter()
        rejected, n = sample.agg(F.count_if(condition & (F.length("text") >= 0)), F.count("*")).first()
        return time.perf_counter() - began, rejected / max(1, n)

    def run(condition: Column) -> tuple[float, float]:
        timed = [once(condition) for _ in range(TIMINGS)]
        return statistics.median(t for t, _ in timed), timed[0][1]

    once(F.lit(False))  # so that no rule pays for the first reading
    base = run(F.col("n_words") < 0)[0]
    out = []
    for rule in rules:
        cost, share = run(rule.rejects)
        out.append((rule, max(cost - base, 1e-4), share))
    return out


def ordered(measures: list[tuple[Rule, float, float]]) -> list[Rule]:
    """By rejections per cost, the highest first; ties by name."""
    return [m[0] for m in sorted(measures, key=lambda m: (-m[2] / m[1], m[0].name))]


def passes(rules: list[Rule]) -> Column:
    """True for what no rule rejects, each rule tried only on what those before it let through."""
    verdict = F.lit(True)
    for rule in reversed(rules):
        verdict = F.when(F.coalesce(rule.rejects, F.lit(False)), F.lit(False)).otherwise(verdict)
    return verdict


def judge(docs: DataFrame, rules: list[Rule] | None = None, sample: int = SAMPLE) -> DataFrame:
    """Statistics, base_failed, and kept: whether no base rule and no rule of the cascade rejects.

    Null and empty texts have no words and fail the base. Repeated rows are judged alike; an empty
    table gives no rows; columns besides doc_id and text are not read.
    """
    base, rules = base_rules(), default_rules() if rules is None else rules
    texts = docs.select("doc_id", "text")
    n = texts.count()
    chance = F.pmod(F.xxhash64("doc_id", F.lit(6)), F.lit(1 << 30))
    some = texts.where(chance < int(min(1.0, sample / max(1, n)) * (1 << 30)))
    measures = measured(stored(with_statistics(some), "rule-sample"), rules)
    failed = ~passes(base)
    return with_statistics(texts).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & passes(ordered(measures))).alias("kept"),
    )


SQL = r"""
WITH texts AS (
  SELECT row_number() OVER () AS r, CAST(doc_id AS BIGINT) AS doc_id, coalesce(text, '') AS text
  FROM documents),
listed AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM texts),
windows AS (
  SELECT r, i, array_to_string(words[i:i + 4], ' ') AS w
  FROM (SELECT r, words, unnest(range(1, len(words) - 3)) AS i FROM listed)),
repeated AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w) AS n FROM windows) WHERE n > 1),
covered AS (
  SELECT r, count(DISTINCT i + k) AS n
  FROM repeated, (SELECT unnest(range(0, 5)) AS k) GROUP BY r),
counted AS (
  SELECT doc_id, text, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) AS BIGINT) AS n_lines,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words
  FROM listed LEFT JOIN covered USING (r)),
judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
    100 * n_symbols > 8 * word_chars OR 100 * n_dup_lines > 30 * n_lines
      OR word_chars < 2 * n_words OR word_chars > 20 * n_words
      OR 100 * len(regexp_extract_all(text, '!!')) > 30 * n_words
      OR 100 * len(regexp_extract_all(text, '[0-9]')) > 60 * word_chars
      OR 100 * abs(len(regexp_extract_all(text, '[(]')) - len(regexp_extract_all(text, '[)]'))) > 50 * n_words
      OR regexp_matches(text, '[^\x20\x09-\x0D]{1000}')
      OR len(list_distinct(string_split(lower(text), ''))) < 8 AS rejected
  FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT rejected AS kept
FROM judged"""
