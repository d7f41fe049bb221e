"""Spelling variant grouping: words one edit apart, found by PartEnum signatures over letter multisets.

A word is read as a binary vector with one dimension per (letter, occurrence): "level" has (l,1), (e,1), (v,1), (e,2),
(l,2).  Two words one insertion, deletion or replacement apart differ in at most two dimensions.  PartEnum finds every such
pair: the dimensions are dealt by a fixed hash into ``PARTS`` partitions of ``SUBPARTS`` subpartitions; two vectors within
Hamming distance k agree on some partition in all but ``k2 = ceil((k + 1) / PARTS) - 1`` subpartitions, so each word emits,
for every partition, its projection on every choice of ``SUBPARTS - k2`` subpartitions.  One edit also leaves a half of the words
alone: with m the shorter one's length, their first ``m div 2`` code points are equal or their last ``m - m div 2``.  So words are
paired by an equi-join on signature, m and half, in which a word is the shorter one at its own length and the longer one at its
length and one less.  The pairs are verified by Spark's bounded Levenshtein distance and made distinct.

The runs, the deletions, the counts, the join, the choice of a form and the roots (pointer doubling) are DataFrame
operations; only the signatures are computed in Python, one row at a time, in Arrow batches.

Contract (``variants``):

* runs ``[A-Za-z\\u00C0-\\u00FF]+`` of whole texts (null: none), A-Z lower-cased; h the unsigned CRC-32 of UTF-8
  ``<doc_id>:<run>`` (a null doc_id is written as nothing); where 31 divides h the code point ``h % length`` goes.
* words: distinct results of at least ``LEAST_CHARS`` code points found at least ``LEAST_COUNT`` times (n).
* form: the near word (one edit) of largest n, ties the smallest in code-point order, if its n >= ``FORM_RATIO`` times the
  word's, else null; root: the last word of the chain of forms (the word itself without a form).  n grows tenfold along a
  chain, so chains end.  n_near counts near words; form_n is the form's n or null.  No words: no rows.
"""

from __future__ import annotations

import itertools

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitlens.llm.support import saved, ship

#: Fixed values of the contract: runs, least length and count, and the ratio that makes a form.
RUN = "[A-Za-z\\u00C0-\\u00FF]+"
LEAST_CHARS = 7
LEAST_COUNT = 2
FORM_RATIO = 10

#: PartEnum: Hamming distance, partitions and subpartitions of the dimensions.
DISTANCE = 2
PARTS = 1
SUBPARTS = 3
SEED = 0x1E77E25

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def choices(parts: int = PARTS, subparts: int = SUBPARTS, distance: int = DISTANCE) -> list[tuple[int, tuple[int, ...]]]:
    """(partition, subpartitions) of every signature."""
    k2 = -(-(distance + 1) // parts) - 1
    return [(p, chosen) for p in range(parts) for chosen in itertools.combinations(range(subparts), subparts - k2)]


def dimensions(word: str) -> list[tuple[str, int]]:
    """(letter, occurrence) for every code point of ``word``."""
    seen: dict[str, int] = {}
    out = []
    for c in word:
        seen[c] = seen.get(c, 0) + 1
        out.append((c, seen[c]))
    return out


def _cell(dim: tuple[str, int], cells: int) -> int:
    return xxhash.xxh3_64_intdigest(f"{dim[0]}\x00{dim[1]}".encode(), seed=SEED) % cells


def signatures(word: str, parts: int = PARTS, subparts: int = SUBPARTS, distance: int = DISTANCE) -> list[int]:
    """One 64-bit signature per choice: the hash of the word's dimensions in the chosen subpartitions.

    Equal projections give equal signatures; a collision only adds a pair that the verification removes.
    """
    cells: dict[int, list[tuple[str, int]]] = {}
    for dim in dimensions(word):
        cells.setdefault(_cell(dim, parts * subparts), []).append(dim)
    out = []
    for k, (p, chosen) in enumerate(choices(parts, subparts, distance)):
        inside = sorted(d for s in chosen for d in cells.get(p * subparts + s, ()))
        text = f"{k}|" + "|".join(f"{c}{j}" for c, j in inside)
        out.append(xxhash.xxh3_64_intdigest(text.encode(), seed=SEED) - (1 << 63))
    return out


def _signed(batches):
    for batch in batches:
        words = batch.column("word").to_pylist()
        yield pa.RecordBatch.from_arrays([batch.column("word"), pa.array([signatures(w) for w in words], pa.list_(pa.int64()))], names=["word", "sigs"])


def counted(docs: DataFrame) -> DataFrame:
    """(word, n): the words after the contract's deletions, with their counts, of at least the least length and count."""
    lowered = F.translate(F.coalesce(F.col("text"), F.lit("")), UPPER, LOWER)
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(lowered, F.lit(RUN), 0)).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    runs = runs.select("run", h.alias("h"), F.char_length("run").alias("len"))
    cut = F.expr("substring(run, 1, cast(h % len as int))"), F.expr("substring(run, cast(h % len as int) + 2)")
    word = F.when(F.col("h") % 31 == 0, F.concat(*cut)).otherwise(F.col("run"))
    words = runs.select(word.alias("word")).where(F.char_length("word") >= LEAST_CHARS)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST_COUNT)


def joinable(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(a, la, key) of every word as the shorter one of a pair and (b, lb, key) as the longer one or one of equal length.

    A key is a hash of signature, the shorter one's length and a half; a collision only adds a pair that the verification removes.
    """
    ship(words.sparkSession)
    signed = words.select("word").mapInArrow(_signed, "word string, sigs array<bigint>")

    def halves(m: str) -> list:
        return [F.xxhash64(F.lit(0), F.expr(m), F.expr(f"left(word, ({m}) div 2)")), F.xxhash64(F.lit(1), F.expr(m), F.expr(f"right(word, {m} - ({m}) div 2)"))]

    signed = signed.withColumn("len", F.char_length("word"))
    signed = saved(signed.select("word", "len", "sigs", F.array(*halves("len"), *halves("len - 1")).alias("halves")), "variants-signed")

    def rows(taken, word: str, length: str) -> DataFrame:
        each = signed.select("word", "len", "halves", F.explode("sigs").alias("sig"))
        return each.select(F.col("word").alias(word), F.col("len").alias(length), "sig", F.explode(taken).alias("half")).select(word, length, F.xxhash64("sig", "half").alias("key"))

    return rows(F.slice("halves", 1, 2), "a", "la"), rows(F.col("halves"), "b", "lb")


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, b) for every two words one edit apart, each pair once with a < b in length, then code-point order."""
    left, right = joinable(words)
    joined = left.join(right, "key").where(F.col("lb") - F.col("la") <= 1)
    ordered = (F.col("la") < F.col("lb")) | ((F.col("la") == F.col("lb")) & (F.col("a") < F.col("b")))
    # A pair that shares several keys is verified at each; the verified pairs are few and made distinct.
    return joined.where(ordered).where(F.levenshtein("a", "b", 1) == 1).select("a", "b").distinct()


def variants(docs: DataFrame) -> DataFrame:
    """Rows (word, form, root, n, n_near, form_n) as the module's docstring states."""
    words = saved(counted(docs), "variants-words")
    pairs = saved(near_pairs(words), "variants-pairs")
    n_of = words.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other")).unionByName(pairs.select(F.col("b").alias("word"), F.col("a").alias("other")))
    best = both.join(n_of, "other").groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("neg"), F.col("other").alias("other"))).alias("best")
    )
    chosen = words.join(best, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("best.neg") >= FORM_RATIO * F.col("n"), F.col("best.other")).alias("form"),
        F.when(-F.col("best.neg") >= FORM_RATIO * F.col("n"), -F.col("best.neg")).cast("long").alias("form_n"),
    )
    chosen = saved(chosen, "variants-forms")
    return chosen.join(roots(chosen), "word").select("word", "form", "root", F.col("n").cast("long").alias("n"), "n_near", "form_n")


def roots(chosen: DataFrame) -> DataFrame:
    """(word, root) by pointer doubling over the forms: each round doubles the length of chain that a pointer jumps."""
    jump = chosen.select("word", F.coalesce("form", "word").alias("to"))
    while True:
        step = jump.alias("x").join(jump.alias("y"), F.col("x.to") == F.col("y.word")).select(F.col("x.word").alias("word"), F.col("y.to").alias("to"))
        step = saved(step, "variants-roots")
        if step.join(jump, ["word", "to"], "left_anti").isEmpty():
            return step.select("word", F.col("to").alias("root"))
        jump = step
