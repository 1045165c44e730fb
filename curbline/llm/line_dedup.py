"""Removal of repeated lines over all documents, by an exact set-similarity join.

A line is the set of its words. Words are ordered by rarity (their count in a table of fixed
size, then their hash), and a line is known by the first few of that order, its prefix: similar lines
share two words of theirs, so a line is indexed under all words of its prefix but the last. Pairs that
differ too much in size, or share a word too late in the order or too few words of their prefixes to
have enough in common, go; for the others the Jaccard similarity is computed. A line that
is similar to an earlier one (by document, then place) is removed.

Equal lines collapse first. Where many lines share a word, all are compared with the earliest of
them; only those that this leaves are compared with the others. An entry of the index brings along what
follows its word in the prefix, in 16 bits a word: at the first word that two similar lines share,
these must have enough in common. A large group of near copies thus costs one comparison for each
member. All steps are built-in expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbline.llm.common import discard, free_shuffles, intermediates, outcome, stored, whole_rows
from curbline.llm.rules import HAS_WORD, bound, word_list

# Similar: 10 * intersection >= 9 * union.
NUMERATOR, DENOMINATOR = 9, 10
# All lines with a word take part; a caller can leave out those of fewer distinct words.
LEAST_WORDS = 1
# Of prefixes of up to so many words, the rest travels with each entry of the index. Pairs with a
# longer one are compared by whole prefixes.
LISTED = 64
SLOTS = 1 << 21
HASH_BITS = 56
BITMAP = 1 << 23
PLACE = ["doc_id", "line_no"]


def lines_of(docs: DataFrame) -> DataFrame:
    """doc_id, line_no (from 0) and line of every line that has a word."""
    lines = docs.where("doc_id IS NOT NULL").select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.posexplode(F.split("text", "\n")).alias("line_no", "line"),
    )
    return lines.where(F.col("line").rlike(HAS_WORD))


def word_set(line: Column) -> Column:
    return F.array_distinct(word_list(line))


def word_hashes(line: Column) -> Column:
    """64-bit hashes of the distinct words."""
    return F.array_distinct(F.transform(word_list(line), lambda w: F.xxhash64(w)))


def rarities(docs: DataFrame) -> DataFrame:
    """One row with an array of SLOTS small numbers: the logarithm of how often the words of a slot
    occur. It is 0 for a word that occurs once, which no two lines share."""
    texts = docs.where("doc_id IS NOT NULL")
    slot = F.pmod(F.xxhash64("word"), F.lit(SLOTS)).cast("int").alias("slot")
    found = texts.select(F.explode(word_list(F.col("text"))).alias("word")).groupBy(slot)
    found = found.agg(F.count("*").alias("n"))
    spark = docs.sparkSession
    every = spark.range(SLOTS).select(F.col("id").cast("int").alias("slot"))
    rank = F.least(F.lit(127), F.floor(6 * F.log2(F.coalesce("n", F.lit(1))))).cast("tinyint")
    pairs = every.join(found, "slot", "left").select(F.struct("slot", rank.alias("r")).alias("x"))
    ranks = F.transform(F.sort_array(F.collect_list("x")), lambda x: x["r"])
    return stored(pairs.agg(ranks.alias("ranks")), "rarities")


def least_shared(n: Column) -> Column:
    """The smallest intersection of a line of n words with a similar one."""
    return F.floor((NUMERATOR * n + DENOMINATOR - 1) / DENOMINATOR)


def keyed_lines(lines: DataFrame, ranks: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """Place, size, identity (two hashes of the whole set) and prefix of every line that takes part.
    Two similar lines share two words at least of their prefixes.

    A set so small that one more word is too much difference is similar to equal ones only. Those
    share its identity, so it has an empty prefix and is not indexed.
    """
    mask = F.lit((1 << HASH_BITS) - 1)

    def keys(table: Column) -> Column:
        """Hashes of the words, rarest first: the rank in the upper bits."""
        return F.transform(
            word_hashes(F.col("line")),
            lambda h: F.shiftleft(
                F.get(table, F.pmod(h, F.lit(SLOTS)).cast("int")).cast("bigint"), HASH_BITS
            ).bitwiseOR(h.bitwiseAND(mask)),
        )

    # A scalar subquery: read once, then a constant of every task.
    ranked = lines.withColumn("ranks", ranks.scalar())
    keyed = ranked.select(*PLACE, F.sort_array(bound(F.col("ranks"), keys)).alias("keys"))
    keyed = keyed.where(F.size("keys") >= least_words)
    n = F.size("keys")
    length = F.when(DENOMINATOR * n >= NUMERATOR * (n + 1), n - least_shared(n) + 2).otherwise(0)
    return keyed.select(
        *PLACE,
        n.alias("n"),
        F.xxhash64("keys").alias("h1"),
        F.xxhash64(F.lit(7), "keys").alias("h2"),
        F.slice("keys", F.lit(1), length.cast("int")).alias("prefix"),
    )


def may_be_similar(n: Column, at: Column, m: Column, other_at: Column) -> Column:
    """Length filter, and the positional one: what follows the shared word must suffice."""
    needed = F.ceil(NUMERATOR * (n + m) / (NUMERATOR + DENOMINATOR))
    return (DENOMINATOR * F.least(n, m) >= NUMERATOR * F.greatest(n, m)) & (
        F.least(n - at, m - other_at) >= needed
    )


def least_of_prefixes(n: Column, m: Column) -> Column:
    """How many words the prefixes of similar lines of n and m words share at least.

    At most n less the least intersection of a line's words are not in the other line; the rest
    of the prefix that ends first in the order of words is in the other prefix as well.
    """
    shared = F.ceil(NUMERATOR * (n + m) / (NUMERATOR + DENOMINATOR))
    return shared + 2 - F.greatest(least_shared(n), least_shared(m))


def index_of(classes: DataFrame) -> DataFrame:
    """An entry for every word of each prefix but the last: key, place, n, at and ``rest``, 16 bits of
    each word that follows in the prefix (null where that is long)."""
    short = F.transform("prefix", lambda k: (k.bitwiseAND(F.lit(65535)) - 32768).cast("smallint"))
    listed = classes.withColumn("short", F.when(F.size("prefix") <= LISTED, short))
    words = F.slice("prefix", F.lit(1), F.greatest(F.size("prefix") - 1, F.lit(0)))
    entries = listed.select(*PLACE, "n", "short", F.posexplode(words).alias("at", "key"))
    # The rank is in the upper bits: words that occur once are left out.
    entries = entries.where(F.col("key") >= F.lit(1 << HASH_BITS))
    return entries.select(
        "key", *PLACE, "n", "at", F.slice("short", F.col("at") + 2, F.lit(LISTED)).alias("rest")
    )


def may_meet(n: Column, at: Column, rest: Column, m: Column, other_at: Column, other_rest: Column) -> Column:
    """Whether the word that two entries share can be the first that two similar lines do.

    What follows holds all other words that their prefixes share. Words that 16 bits do not tell
    apart can only add to those.
    """
    shared = 1 + F.size(rest) - F.size(F.array_except(rest, other_rest))
    enough = rest.isNull() | other_rest.isNull() | (shared >= least_of_prefixes(n, m))
    return may_be_similar(n, at, m, other_at) & enough


def enough_in_common(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """``pairs``, of which those that are not ``sure`` are held against their whole prefixes."""
    sure = pairs.where("sure").drop("sure").distinct()
    open_ = pairs.where("NOT sure").drop("sure").distinct()
    if open_.isEmpty():
        return sure
    own = classes.select(*PLACE, "n", "prefix")
    other = classes.select(
        F.col("doc_id").alias("a_doc"),
        F.col("line_no").alias("a_line"),
        F.col("n").alias("m"),
        F.col("prefix").alias("a_prefix"),
    )
    both = open_.join(own, PLACE).join(other, ["a_doc", "a_line"])
    shared = F.size(F.array_intersect("prefix", "a_prefix"))
    found = both.where(shared >= least_of_prefixes(F.col("n"), F.col("m")))
    return sure.unionByName(found.select(sure.columns))


def similar_pairs(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """Of the pairs (doc_id, line_no, a_doc, a_line), the later places of those that are similar.

    The words are read again, of the lines that a bitmap of fixed size does not rule out.
    """
    wanted = pairs.select(*PLACE).unionByName(
        pairs.select(F.col("a_doc").alias("doc_id"), F.col("a_line").alias("line_no"))
    )
    wanted = stored(wanted.distinct(), "wanted-lines")
    bits = bitmap_of(F.xxhash64(*PLACE), wanted, "line-bitmap")
    lines = lines_of(docs).withColumn("bits", bits.scalar())
    lines = lines.where(is_set(F.col("bits"), F.xxhash64(*PLACE)))
    texts = stored(
        lines.join(wanted, PLACE, "left_semi").select(*PLACE, word_set(F.col("line")).alias("words")),
        "line-words",
    )
    first = texts.select(
        F.col("doc_id").alias("a_doc"), F.col("line_no").alias("a_line"), F.col("words").alias("a_words")
    )
    both = pairs.join(texts, PLACE).join(first, ["a_doc", "a_line"])
    shared = F.size(F.array_intersect("words", "a_words"))
    union = F.size("words") + F.size("a_words") - shared
    found = both.where(DENOMINATOR * shared >= NUMERATOR * union)
    found = stored(found.select(*PLACE).distinct(), "similar-lines")
    for done in (wanted, bits, texts):
        discard(done)
    free_shuffles(docs.sparkSession)
    return found


def bitmap_of(hashes: Column, rows: DataFrame, name: str) -> DataFrame:
    """One row with an array of BITMAP bits in all, of which those of ``hashes`` are set."""
    bit = F.pmod(hashes, F.lit(BITMAP))
    masks = rows.select(F.floor(bit / 64).cast("int").alias("at"), (bit % 64).cast("int").alias("b"))
    masks = masks.groupBy("at").agg(F.bit_or(F.expr("shiftleft(1L, b)")).alias("mask"))
    every = rows.sparkSession.range(BITMAP // 64).select(F.col("id").cast("int").alias("at"))
    cell = F.struct("at", F.coalesce("mask", F.lit(0).cast("bigint")).alias("mask")).alias("x")
    cells = every.join(masks, "at", "left").select(cell)
    bits = F.transform(F.sort_array(F.collect_list("x")), lambda x: x["mask"])
    return stored(cells.agg(bits.alias("bits")), name)


def is_set(bits: Column, hashes: Column) -> Column:
    bit = F.pmod(hashes, F.lit(BITMAP))
    cell = F.get(bits, F.floor(bit / 64).cast("int"))
    return F.getbit(cell, (bit % 64).cast("int")) == 1


def removed_lines(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """doc_id and line_no of the lines to remove, of those with ``least_words`` distinct words."""
    ranks = rarities(docs)
    keyed = stored(keyed_lines(lines_of(docs), ranks, least_words), "keyed-lines")
    discard(ranks)
    place = F.struct(*PLACE)
    classes = keyed.groupBy("h1", "h2").agg(
        F.min(place).alias("place"),
        F.count("*").alias("lines"),
        F.first("n").alias("n"),
        F.first("prefix").alias("prefix"),
    )
    classes = stored(classes.select("h1", "h2", "place.*", "lines", "n", "prefix"), "line-classes")
    places = stored(keyed.select(*PLACE, "h1", "h2"), "line-places")
    discard(keyed)
    free_shuffles(docs.sparkSession)

    index = index_of(classes)
    earliest = F.min(F.struct(*PLACE, "n", "at", "rest")).alias("first")
    keys = index.groupBy("key").agg(earliest, F.count("*").alias("lines")).where("lines > 1")
    entry = [F.col(c) for c in ("n", "at", "rest")]
    is_first = F.struct(*PLACE) == F.struct("first.doc_id", "first.line_no")
    meets = may_meet(*entry, *(F.col(f"first.{c}") for c in ("n", "at", "rest")))
    sure = F.col("rest").isNotNull() & F.col("first.rest").isNotNull()
    star = F.when(meets, F.struct("first.doc_id", "first.line_no", sure.alias("sure"))).alias("star")
    joined = index.join(keys, "key").where(~is_first & (meets | (F.col("lines") > 2)))
    index = stored(joined.select("key", *PLACE, "n", "at", "rest", "lines", star), "line-index")
    free_shuffles(docs.sparkSession)
    pairs = index.where("star IS NOT NULL").select(
        *PLACE, F.col("star.doc_id").alias("a_doc"), F.col("star.line_no").alias("a_line"), "star.sure"
    )
    pairs = stored(enough_in_common(pairs, classes), "close-line-pairs")
    found = similar_pairs(pairs, docs)
    discard(pairs)

    open_ = index.where("lines > 2").select("key", *PLACE, "n", "at", "rest")
    left = open_.join(found, PLACE, "left_anti")
    earlier = open_.select(
        "key",
        F.col("doc_id").alias("a_doc"),
        F.col("line_no").alias("a_line"),
        F.col("n").alias("m"),
        F.col("at").alias("a_at"),
        F.col("rest").alias("a_rest"),
    )
    before = F.struct("a_doc", "a_line") < F.struct(*PLACE)
    more = left.join(earlier, "key").where(
        before & may_meet(*entry, *(F.col(c) for c in ("m", "a_at", "a_rest")))
    )
    sure = F.col("rest").isNotNull() & F.col("a_rest").isNotNull()
    open_pairs = stored(more.select(*PLACE, "a_doc", "a_line", sure.alias("sure")).distinct(), "open-line-pairs")
    discard(index)
    free_shuffles(docs.sparkSession)
    more = stored(enough_in_common(open_pairs, classes), "more-line-pairs")
    discard(open_pairs)
    if not more.isEmpty():
        again = similar_pairs(more, docs)
        discard(more)
        both = stored(found.unionByName(again).distinct(), "found-lines")
        for done in (found, again):
            discard(done)
        found = both
        free_shuffles(docs.sparkSession)
    else:
        discard(more)

    near = found.select(*PLACE, F.lit(True).alias("near"))
    # Of a line that comes once and resembles none nothing goes.
    named = classes.join(near, PLACE, "left").where("near OR lines > 1").select(
        "h1", "h2", F.struct(*PLACE).alias("first"), F.coalesce("near", F.lit(False)).alias("near")
    )
    all_lines = places.join(named, ["h1", "h2"])
    return all_lines.where(F.col("near") | (place != F.col("first"))).select(*PLACE).distinct()


def removed_by_document(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """doc_id and the sorted places of its removed lines, stored, for documents that have any."""
    places = F.sort_array(F.collect_set("line_no")).alias("removed")
    with intermediates(docs.sparkSession):
        return outcome(removed_lines(docs, least_words).groupBy("doc_id").agg(places), "removed-lines")


def dedup_lines(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """``docs`` with the text that is left. Documents of which no word is left, and that had some,
    are dropped; null and empty texts, and rows without doc_id, stay as they are.

    Rows with one doc_id are one document: a line goes from the same place of all of them. Columns
    besides doc_id and text are passed on. An empty table gives no rows.
    """
    removed = removed_by_document(docs, least_words)
    same = F.col("row.doc_id").cast("bigint") == F.col("doc_id")
    joined = whole_rows(docs).join(removed, same, "left")
    parts = F.filter(
        F.split("row.text", "\n"), lambda x, i: ~F.array_contains("removed", i)
    )
    whole = F.col("removed").isNull()
    text = F.when(whole, F.col("row.text")).otherwise(F.array_join(parts, "\n"))
    joined = joined.withColumn("left_text", text)
    return joined.where(whole | F.col("left_text").rlike(HAS_WORD)).select(
        *(
            (F.col("left_text") if c == "text" else F.col(f"row.`{c}`")).alias(c)
            for c in docs.columns
        )
    )


def report(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """doc_id, n_lines (with a word), n_removed and removed_lines (places, joined by commas) of every
    document."""
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(HAS_WORD))
    counted = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.size(lines), F.lit(0)).cast("bigint").alias("n_lines"),
    ).withColumn("n_lines", F.greatest("n_lines", F.lit(0)))
    removed = removed_by_document(docs, least_words)
    return counted.join(removed, "doc_id", "left").select(
        "doc_id",
        "n_lines",
        F.coalesce(F.size("removed"), F.lit(0)).cast("bigint").alias("n_removed"),
        F.coalesce(F.array_join(F.col("removed").cast("array<string>"), ","), F.lit("")).alias(
            "removed_lines"
        ),
    )


SQL = r"""
WITH lines AS (
  SELECT doc_id, CAST(unnest(range(len(parts))) AS INTEGER) AS line_no, unnest(parts) AS line
  FROM (SELECT CAST(doc_id AS BIGINT) AS doc_id, string_split(text, chr(10)) AS parts
        FROM documents WHERE doc_id IS NOT NULL)),
worded AS (
  SELECT doc_id, line_no, CAST(doc_id AS HUGEINT) * 4294967296 + line_no AS spot,
    list_sort(list_distinct(regexp_extract_all(line, '[^\x20\x09-\x0D]+'))) AS words
  FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
sets AS (SELECT words, len(words) AS n, min(spot) AS place FROM worded GROUP BY words),
-- A smaller set has no similar one but itself.
members AS (SELECT place, n, unnest(words) AS word FROM sets WHERE n >= 9),
pairs AS (
  SELECT b.place AS later, a.place AS earlier, a.n + b.n AS both_n, count(*) AS shared
  FROM members a JOIN members b ON a.word = b.word AND a.place < b.place
    AND 10 * least(a.n, b.n) >= 9 * greatest(a.n, b.n)
  GROUP BY 1, 2, 3),
near AS (SELECT DISTINCT later FROM pairs WHERE 10 * shared >= 9 * (both_n - shared)),
removed AS (
  SELECT doc_id, line_no
  FROM worded JOIN sets USING (words) LEFT JOIN near ON later = place
  WHERE later IS NOT NULL OR place <> spot),
listed AS (
  SELECT doc_id, count(*) AS n, string_agg(line_no, ',' ORDER BY line_no) AS removed_lines
  FROM removed GROUP BY doc_id),
counted AS (
  SELECT CAST(d.doc_id AS BIGINT) AS doc_id, coalesce(w.n, 0) AS n_lines
  FROM documents d LEFT JOIN (SELECT doc_id, count(*) AS n FROM worded GROUP BY doc_id) w USING (doc_id))
SELECT counted.doc_id, n_lines, coalesce(n, 0) AS n_removed, coalesce(removed_lines, '') AS removed_lines
FROM counted LEFT JOIN listed ON counted.doc_id = listed.doc_id"""
