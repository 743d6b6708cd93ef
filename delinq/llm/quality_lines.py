"""Quality rules from the frequency of lines across documents.

Lines are normalised (lower case, digit runs to 0, white space runs to one blank) and hashed together
with their host (``source``). For each host and line the distinct documents are counted by a hash of their whole
text, so exact copies count once; the documents of the host are counted by the same key. Lines above the host's
limit are removed from every document; documents that lose more than ``max_lost`` of their words are depleted and
rejected.

Only DataFrame functions are used. Line rows carry 8-byte keys, counts are pre-aggregated per task, and the
frequent lines are spread over ``SALTS`` copies of their key before they meet the lines again, so a line that
stands in every document is dealt out.

Defined results: null text is empty (no words, fails the base rule); null source is a host of its own; lines
without a word are never counted or removed; repeated rows get the same result each; an empty table gives an
empty table. Extra columns pass through ``filter_documents`` untouched, whatever their names. A text of any length is
one row of line keys while it is read; its words are held as one array.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delinq.llm.common import BLANK, WORD, let, packed, words_of, written

#: Characters counted as symbols.
SYMBOLS = "#*$%&|<>"
WINDOW = 8  # words; _repeat_words doubles up to it
SALTS = 16


@dataclass(frozen=True)
class Limits:
    """A line is frequent in a host above max(min_docs, share * distinct documents of the host) documents."""

    min_docs: int = 10
    share: float = 0.005
    max_lost: float = 0.5
    min_words: int = 20
    max_repeat_percent: int = 30


def _lines(text: Column) -> Column:
    """Lines that hold a word, as written."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: line.rlike(WORD))


def _normalised(line: Column) -> Column:
    flat = F.regexp_replace(line, f"[{BLANK}]{{2,}}|[\\x09-\\x0D]", " ")
    return F.lower(F.trim(F.regexp_replace(flat, "[0-9]+", "0")))


def _host(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def _row_key(doc_id: Column, text: Column) -> Column:
    return F.xxhash64(doc_id, text)


def _doc_key(text: Column) -> Column:
    """Equal for exact copies only."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _line_key(host: Column, line: Column) -> Column:
    return F.xxhash64(host, _normalised(line))


def _repeat_words(words: Column) -> Column:
    """Words inside windows of WINDOW words that occur at least twice."""

    def joined(hashes, step):
        """Hash of each entry with the one ``step`` further; the last ones have none and are cut off below."""
        return F.transform(hashes, lambda x, i: F.xxhash64(x, F.get(hashes, i + step)))

    def checked(h):
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h))

    def covered(hashes):
        ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twice = let(
            ordered,
            lambda s: F.filter(
                s,
                lambda e, j: F.coalesce(F.get(s, j - 1)["h"] == e["h"], F.lit(False))
                | F.coalesce(F.get(s, j + 1)["h"] == e["h"], F.lit(False)),
            ),
        )
        starts = F.sort_array(F.transform(twice, lambda e: e["i"]))
        return F.aggregate(
            starts,
            F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("total")),
            lambda acc, x: F.struct(x.alias("last"), (acc["total"] + F.least(F.lit(WINDOW), x - acc["last"])).alias("total")),
            lambda acc: acc["total"],
        )

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    for step in (1, 2, 4):  # windows of 2, 4 and 8 words
        hashes = let(hashes, lambda h, step=step: joined(h, step))
    full = F.greatest(F.size(words) - WINDOW + 1, F.lit(0))
    return let(F.slice(hashes, 1, full), checked)


def _measures(text: Column) -> Column:
    """The base measures of one text as a struct."""
    return let(
        words_of(text),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            _symbols(text).alias("n_symbols"),
            let(_lines(text), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            _repeat_words(w).cast("long").alias("n_repeat_words"),
        ),
    )


def _symbols(text: Column) -> Column:
    """Most texts have none, which plain searches show fastest."""
    some = reduce(lambda a, b: a | b, [text.contains(c) for c in SYMBOLS])
    return F.when(some, F.regexp_count(text, F.lit(f"[{SYMBOLS}]"))).otherwise(0).cast("long")


def _failed(n_words: Column, n_repeat_words: Column, limits: Limits) -> Column:
    return (n_words < limits.min_words) | (100 * n_repeat_words > limits.max_repeat_percent * n_words)


def base_measures(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Per row: doc_id, _row_key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    rows = docs.select(
        "doc_id",
        _row_key(F.col("doc_id"), F.col("text")).alias("_row_key"),
        _measures(F.coalesce("text", F.lit(""))).alias("_facts"),
    )
    return rows.select("doc_id", "_row_key", "_facts.*").withColumn(
        "base_failed", _failed(F.col("n_words"), F.col("n_repeat_words"), limits)
    )


def frequent_lines(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Lines to remove: _row_key, _line_key, line_no, line_words, one row per line of a document."""
    host = _host(F.col("source"))
    per_doc = docs.select(
        _row_key(F.col("doc_id"), F.col("text")).alias("_row_key"),
        host.alias("_host"),
        let(
            _lines(F.col("text")),
            lambda lines: F.struct(
                F.transform(
                    lines,
                    lambda line: F.struct(
                        _line_key(host, line).alias("key"), F.regexp_count(line, F.lit(WORD)).cast("long").alias("words")
                    ),
                ).alias("lines"),
                _doc_key(F.col("text")).alias("doc_key"),
            ),
        ).alias("_d"),
    )
    lines = per_doc.select("_row_key", "_host", "_d.doc_key", F.posexplode("_d.lines").alias("line_no", "line")).select(
        "_row_key", "_host", "doc_key", "line_no", F.col("line.key").alias("_line_key"), F.col("line.words").alias("line_words")
    )
    lines = written(lines, "lines")  # used twice; a few numbers a line
    counts = lines.groupBy("_host", "_line_key").agg(F.count_distinct("doc_key").alias("_docs"))
    keys = docs.select(host.alias("_host"), _doc_key(F.col("text")).alias("doc_key"))
    hosts = keys.groupBy("_host").agg(F.count_distinct("doc_key").alias("_host_docs"))
    over = (
        counts.where(F.col("_docs") > limits.min_docs)
        .join(hosts, "_host")
        .where(F.col("_docs") > F.col("_host_docs") * limits.share)
        .select("_line_key", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    )
    salted = lines.withColumn("_salt", F.pmod("_row_key", F.lit(SALTS)).cast("int"))
    return salted.join(over, ["_line_key", "_salt"]).select("_row_key", "_line_key", "line_no", "line_words")


def assess(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """base_measures and removed_words, kept for every row."""
    lost = (
        frequent_lines(docs, limits)
        .groupBy("_row_key", "line_no")
        .agg(F.max("line_words").alias("line_words"))  # a repeated row has each line once
        .groupBy("_row_key")
        .agg(F.sum("line_words").alias("removed_words"))
    )
    rows = base_measures(docs, limits).join(lost, "_row_key", "left")
    removed = F.coalesce("removed_words", F.lit(0)).cast("long")
    return (
        rows.withColumn("removed_words", removed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("removed_words") <= limits.max_lost * F.col("n_words")))
        .drop("_row_key")
    )


def filter_documents(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Kept documents without their frequent lines; n_chars follows the text. Columns as given."""
    removed = (
        frequent_lines(docs, limits)
        .groupBy(F.col("_row_key").alias("key"))
        .agg(F.collect_set("_line_key").alias("gone"))  # bounded by the lines of one document
    )
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        packed(docs).alias("given"),
        _row_key(F.col("doc_id"), F.col("text")).alias("key"),
        text.alias("old"),
        _host(F.col("source")).alias("host"),
        _measures(text).alias("facts"),
    )
    good = rows.where(~_failed(F.col("facts.n_words"), F.col("facts.n_repeat_words"), limits))
    keep = F.filter(
        F.split("old", "\n"),
        lambda line: ~(line.rlike(WORD) & F.array_contains(F.col("gone"), _line_key(F.col("host"), line))),
    )
    cleaned = good.join(removed, "key", "left").withColumn(
        "new", F.when(F.col("gone").isNull(), F.col("old")).otherwise(F.array_join(keep, "\n"))
    )
    lost = F.col("facts.n_words") - F.regexp_count("new", F.lit(WORD))
    changed = F.col("given").withField("text", F.col("new"))
    if "n_chars" in docs.columns:
        changed = changed.withField("n_chars", F.length("new").cast(docs.schema["n_chars"].dataType))
    return cleaned.where(lost <= limits.max_lost * F.col("facts.n_words")).select(changed.alias("given")).select("given.*")
