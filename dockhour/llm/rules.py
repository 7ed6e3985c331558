"""Quality rules: text statistics and cross-document line frequency, in SQL functions only."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, WS_CHARS, WS_RUN, let, words, written

SYMBOLS = "#*$%&|<>"
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def repeated_words(w: Column) -> Column:
    """Words covered by 3-word windows that occur at least twice in the array ``w``.

    Windows are sorted by fingerprint with their positions, so equal ones are neighbours; the
    positions, sorted again, give the covered length as a sum of steps of at most three.
    """
    windows = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.struct(
        F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("p")))

    def twice(s: Column) -> Column:
        same = F.filter(s, lambda x, i: F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False))
                        | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)))
        return F.sort_array(F.transform(same, lambda x: x["p"]))

    def covered(p: Column) -> Column:
        steps = F.aggregate(F.sequence(F.lit(1), F.size(p) - 1), F.lit(3), lambda acc, i:
                            acc + F.least(F.lit(3), F.get(p, i) - F.get(p, i - 1)))
        return F.when(F.size(p) >= 2, steps).otherwise(F.lit(0))

    found = let(let(F.sort_array(windows), twice), covered)
    return F.when(F.size(w) >= 4, found).otherwise(F.lit(0)).cast("long")


def normal_line(line: Column) -> Column:
    """A line in lower case (A-Z), trimmed, with one space for each white-space run."""
    low = F.translate(line, ASCII_UPPER, ASCII_UPPER.lower())
    return F.regexp_replace(F.btrim(low, F.lit(WS_CHARS)), WS_RUN, " ")


def worded_lines(text: Column) -> Column:
    """Lines of a text that have a word."""
    return F.filter(F.split(text, "\n", -1), lambda x: F.rlike(x, F.lit(WORD)))


def line_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               host_col: str = "source", min_docs: int = 20, max_share: float = 0.02,
               min_left_share: float = 0.3, min_words: int = 50,
               with_text: bool = False, distinct: bool = False) -> DataFrame:
    """Statistics and verdict for each document.

    A line (normalised, by fingerprint) is too frequent on a host when at least ``min_docs``
    distinct documents and a share ``max_share`` of the host's documents have it.  Such lines are
    removed; a document is depleted when less than ``min_left_share`` of its words is left.
    ``base_failed`` is the rule on length and repeated 3-word windows.  ``with_text`` adds
    ``clean_text`` without the removed lines.

    Null and blank texts have no words and fail the base rule.  A null host is a host of its own.
    Each input row gives one row; rows with the same id, host and text get the same result.  With
    ``distinct`` they are one document for the counts of lines and hosts, else each row counts.  An empty table gives no rows; other columns are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).alias("host"),
                    text.alias("text"))
    # The key has no nulls and tells an id's different texts apart.
    key = [F.coalesce("doc_id", F.lit(0)).alias("key_id"),
           F.xxhash64("doc_id", "host", "text").alias("key_text")]
    solid = F.char_length(F.translate("text", WS_CHARS, ""))
    symbols = F.char_length("text") - F.char_length(F.translate("text", SYMBOLS, ""))
    stats = d.select(
        *key, "doc_id",
        let(words(F.col("text")), lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"), repeated_words(w).alias("n_repeat_words")))
        .alias("of_words"),
        solid.cast("long").alias("word_chars"), symbols.cast("long").alias("n_symbols"),
        let(worded_lines(F.col("text")), lambda x: F.size(x) - F.size(F.array_distinct(x)))
        .cast("long").alias("n_dup_lines")).select("*", "of_words.*").drop("of_words")
    lines = d.select(*key, "host", F.explode(F.transform(
        worded_lines(F.col("text")), lambda x: F.struct(
            F.xxhash64(normal_line(x)).alias("print"),
            F.regexp_count(x, F.lit(WORD)).alias("n")))).alias("line")).select(
        "key_id", "key_text", "host", "line.*")
    frequent = frequent_lines(d, min_docs, max_share, distinct)

    f = frequent.select(F.col("host").alias("_host"), F.col("print").alias("_print"))
    cut = lines.join(f, F.col("host").eqNullSafe(F.col("_host")) & (
        F.col("print") == F.col("_print")))
    removed = cut.groupBy("key_id", "key_text").agg(F.sum("n").alias("removed_all_rows"))
    rows = stats.groupBy("key_id", "key_text", "doc_id", "n_words", "word_chars", "n_symbols",
                         "n_dup_lines", "n_repeat_words").agg(F.count(F.lit(1)).alias("times"))
    out = rows.join(removed, ["key_id", "key_text"], "left")
    left = F.col("n_words") - F.coalesce(F.col("removed_all_rows") / F.col("times"), F.lit(0))
    failed = (F.col("n_words") < min_words) | (
        100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    out = out.select("key_id", "key_text", "doc_id", "n_words", "word_chars", "n_symbols",
                     "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
                     left.cast("long").alias("n_words_left"),
                     (~failed & (left >= F.lit(min_left_share) * F.col("n_words"))).alias("kept"),
                     F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("_time"))
    out = out.drop("_time")
    if with_text:
        prints = cut.groupBy("key_id", "key_text").agg(F.collect_set("print").alias("prints"))
        kept_lines = F.filter(F.split("text", "\n", -1), lambda x: ~F.coalesce(
            F.array_contains("prints", F.xxhash64(normal_line(x))), F.lit(False)))
        texts = (d.select(*key, "text").join(prints, ["key_id", "key_text"], "left")
                 .select("key_id", "key_text",
                         F.array_join(kept_lines, "\n").alias("clean_text"))
                 .dropDuplicates(["key_id", "key_text"]))
        out = out.join(texts, ["key_id", "key_text"])
    return out.drop("key_id", "key_text")


def frequent_lines(d: DataFrame, min_docs: int, max_share: float,
                   distinct: bool = False) -> DataFrame:
    """Line fingerprints (``host``, ``print``, ``n_docs``) above the limits of their host.

    With ``distinct``, what the further rows of a document add to its lines is taken off again, so
    only documents that have several rows are dealt out by their key.
    """
    prints = F.array_distinct(F.transform(worded_lines(F.col("text")),
                                          lambda x: F.xxhash64(normal_line(x))))
    lines = d.select("doc_id", "host", "text").select("host", F.explode(prints).alias("print"),
                                                      F.lit(1).cast("long").alias("n"))
    rows = d.select("host", F.lit(1).cast("long").alias("n"))
    if distinct:
        keyed = d.select("host", "text", F.coalesce("doc_id", F.lit(0)).alias("key_id"),
                         F.xxhash64("doc_id", "host", "text").alias("key_text"))
        again = written(keyed.groupBy("key_id", "key_text").agg(
            F.count(F.lit(1)).alias("times")).filter("times > 1"), "line-repeated")
        if not again.isEmpty():
            more = written(keyed.join(again, ["key_id", "key_text"]).dropDuplicates(
                ["key_id", "key_text"]).select("host", prints.alias("prints"),
                                               (1 - F.col("times")).alias("n")), "line-surplus")
            lines = lines.unionByName(more.select("host", F.explode("prints").alias("print"), "n"))
            rows = rows.unionByName(more.select("host", "n"))
    counts = (lines.groupBy("host", "print").agg(F.sum("n").alias("n_docs"))
              .filter(F.col("n_docs") >= min_docs))
    hosts = written(rows.groupBy(F.col("host").alias("_host")).agg(
        F.sum("n").alias("host_docs")), "line-hosts")
    return written(counts.join(hosts, F.col("host").eqNullSafe(F.col("_host")))
                   .filter(F.col("n_docs") >= F.col("host_docs") * max_share)
                   .select("host", "print", "n_docs"), "frequent-lines")
