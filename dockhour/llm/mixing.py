"""Mix sources to target weights: whole epochs first, then weighted draws without replacement."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import word_count, written
from .prefix import running


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3),
                   most_epochs: int = 3) -> DataFrame:
    """Targets of sources (``source``, ``source_size``): shares of all sizes by weight, capped.

    Sources are ordered by code point with null last and take the weights in turn.  No target is
    above ``most_epochs`` times its source's size; what is above is shared again by weight among
    the others until none is above.  That end state is target = min(cap, level * weight) for one
    level: sources fill up in ascending order of cap / weight, so running sums in that order find
    it in one pass.  A null size counts as 0.
    """
    cycle = F.array(*[F.lit(w) for w in weights])
    turn = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    s = sizes.select("source", F.coalesce("source_size", F.lit(0)).cast("long")
                     .alias("source_size"), F.get(cycle, turn % len(weights)).alias("weight"))
    s = s.withColumn("cap", F.col("source_size") * most_epochs)
    fill = Window.orderBy((F.col("cap") / F.col("weight")), F.col("source").isNull(), "source")
    every = Window.partitionBy()
    ahead = fill.rowsBetween(Window.unboundedPreceding, -1)
    s = s.select("*", F.sum("source_size").over(every).alias("all_size"),
                 F.sum("weight").over(every).alias("all_weight"),
                 F.coalesce(F.sum("cap").over(ahead), F.lit(0)).alias("cap_ahead"),
                 F.coalesce(F.sum("weight").over(ahead), F.lit(0)).alias("weight_ahead"))
    level = (F.col("all_size") - F.col("cap_ahead")) / (F.col("all_weight") - F.col("weight_ahead"))
    s = s.withColumn("level", level).withColumn(
        "open", F.col("level") * F.col("weight") <= F.col("cap"))
    # The level that holds is that of the first source which does not fill up.
    held = F.min(F.when(F.col("open"), F.struct("cap_ahead", "level"))).over(every)["level"]
    target = F.when(held.isNull(), F.col("cap").cast("double")).otherwise(
        F.least(F.col("cap").cast("double"), held * F.col("weight")))
    return s.select("source", "source_size", target.alias("target"))


def letter_share(text: Column) -> Column:
    """Quality weight in [0.05, 1]: share of the text's characters that are not symbols."""
    body = F.coalesce(text, F.lit(""))
    n = F.char_length(body)
    plain = F.char_length(F.translate(body, "#*$%&|<>", ""))
    return F.when(n > 0, F.greatest(F.lit(0.05), plain / n)).otherwise(F.lit(0.05))


def exponential_key(doc_id: Column, weight: Column) -> Column:
    """-ln(u) / weight with u in (0, 1] from the id's digest, so that reruns agree."""
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")))
    u = (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 1) / float(2 ** 48)
    return -F.ln(u) / weight


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most_epochs: int = 3,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        quality: Column | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """How many words the mix takes of each document; ``copies`` says how often it is taken.

    ``carry`` names further columns of ``docs`` to hand through.

    A source whose target is e whole epochs and a rest takes every document e times, then, in
    ascending order of exponential keys scaled by quality, documents until their sizes fill the
    rest; the document at the edge is taken when more than half of it fits.  Keys depend on ids
    alone, so reruns agree.

    Every input row gives one row.  Null texts and blank texts have size 0 and are taken 0 words;
    null sources are a source of their own, last in order; equal keys are ordered by id and size,
    repeated rows share a key and are drawn next to each other.  An empty table gives no rows.
    """
    quality = letter_share(F.col(text_col)) if quality is None else quality
    sized = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                        word_count(F.col(text_col)).alias("size"), quality.alias("quality"), *carry)
    keyed = sized.select("doc_id", "source", "size", *carry,
                         exponential_key(F.col("doc_id"), F.col("quality")).alias("draw"))
    drawn = running(keyed, ["source"], ["draw", "doc_id", "size"], ["size"], "mix-rows")
    drawn = written(drawn, "mix-drawn")
    targets = written(source_targets(drawn.groupBy("source").agg(
        F.sum("size").alias("source_size"))), "mix-targets").withColumnRenamed("source", "_source")
    d = drawn.join(targets, F.col("source").eqNullSafe(F.col("_source")), "left")
    epochs = F.when(F.col("source_size") > 0,
                    F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    d = d.withColumn("epochs", epochs.cast("long"))
    rest = F.col("target") - F.col("epochs") * F.col("source_size")
    extra = (F.col("size_before") + F.col("size") / 2 < rest).cast("long")
    return d.select("doc_id", "size", "source_size", "target",
                    ((F.col("epochs") + extra) * F.col("size")).alias("taken"), "source",
                    (F.col("epochs") + extra).alias("copies"), *carry)
