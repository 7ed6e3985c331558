"""Fixtures of the operator tests: small tables with every awkward case, and plain Python rules."""
from __future__ import annotations

import random
import re

from pyspark.sql import DataFrame, SparkSession

WORD = re.compile(r"[^\x20\x09-\x0D]+")
WS = re.compile(r"[\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
# Extra columns whose names the operators use inside.
CLASH = ("size int, shard int, kept string, node long, n int, key string, host string, draw int, "
         "_part int, variant int, times int, name string, copies int, scores int, kind int")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def make(spark: SparkSession, rows: list[tuple], clash: bool = True) -> DataFrame:
    """(doc_id, text, source) rows as a documents table, with clashing extra columns."""
    full = [(i, t, "en", s, len(t) if t is not None else None) for i, t, s in rows]
    if not clash:
        return spark.createDataFrame(full, SCHEMA)
    extra = (1, 2, "x", 3, 4, "k", "h", 5, 6, 7, 8, "nm", 9, 10, 11)
    return spark.createDataFrame([f + extra for f in full], f"{SCHEMA}, {CLASH}")


def prose(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def corpus(seed: int = 3) -> list[tuple]:
    """Copies, near copies, shared passages, nulls, blanks, ties, a long text, a hot source."""
    rng = random.Random(seed)
    passage = prose(rng, 60, 5000)
    rows = []
    for i in range(40):
        rows.append((i, prose(rng, rng.randrange(3, 180), 3000), f"s{i % 3}" if i % 2 else "hot"))
    base = rows[5][1]
    for i in range(40, 46):
        rows.append((i, base, "hot"))
    long = prose(rng, 6000, 20000)
    rows.append((46, long, "s1"))
    for i in range(47, 60):  # near copies of the long text, more and more edited
        w = long.split()
        for j in rng.sample(range(len(w)), 12 * (i - 46)):
            w[j] = f"e{i}x{j}"
        rows.append((i, " ".join(w), "hot"))
    for i in range(60, 66):
        rows.append((i, f"{prose(rng, 50, 9000)} {passage} {prose(rng, 30, 9000)}", "s2"))
    rows += [(66, None, "hot"), (67, "", "s0"), (68, " \t\n ", None), (69, "one", None),
             (70, "One  two\tthree", "s0"), (71, "one two three", "s0"), (72, "one two three", "s1"),
             (73, "Ünï cödé ß 😀 words", "ü"), (74, "a\x1cb  c d e", "s0"),
             (75, "x # % x # % x # %\nline\nline\n\n line\nother", "s0"),
             (None, "no id here at all", "s0"), (None, base, None),
             (76, passage, "s0"), (77, "tie tie tie tie tie tie", "s1")]
    rows += [rows[1], rows[1]]  # rows listed again
    return rows
