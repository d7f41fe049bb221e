"""Document fingerprints from spot signatures, on DataFrame functions only.

A common word (an anchor) starts a spot: the chain of the next two words that are no common words.  The distinct chains of a text
are its signature set, kept as sorted hashes.  Where ``BARREN`` words follow each other without an anchor (lists, tables, repeated words), each pair of words that starts
such a stretch is a spot too.  A text with fewer than ``LEAST_SPOTS`` distinct spots also takes all its pairs of neighbouring words, and
one without any of these its whole self.  Two texts are as alike as the Jaccard similarity of their sets.

``similar_pairs`` compares the distinct sets of a table: they are partitioned by length so that a similar pair lies in the same or the
next partition, of each set only the rarest hashes of which a partner must share one are looked up, and a pair is compared only if
``shorter >= least * longer``.

Defined results: null and empty texts have the empty fingerprint; two empty ones are alike (1), an empty and another one are not (0).
Equal texts have equal fingerprints.  Case and punctuation are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Common words that start a spot.
ANCHORS = ["a", "an", "and", "at", "by", "das", "de", "del", "den", "der", "des", "die", "el", "en", "et", "in", "is", "la", "las", "le", "les", "los", "of", "on", "que", "that", "the", "to", "un", "una", "und", "une", "von", "was", "with", "y", "zu"]
LEAST_SPOTS = 8
BARREN = 6
#: Common words skipped before each word of a chain at most; a bound keeps the pattern's stack small.
SKIPPED = 4

_BY_LETTER = {c: [w[1:] for w in ANCHORS if w[0] == c] for c in sorted({w[0] for w in ANCHORS})}
ANCHOR = "(?<= )(?:" + "|".join(f"{c}(?:{'|'.join(rest)})" for c, rest in _BY_LETTER.items()) + ")(?= )"
#: Stands for a common word once they are marked; other words have letters and digits only.
MARK = "_"
_WORD = f"[^ {MARK}][^ ]*"
_NEXT = f"(?: {MARK}){{0,{SKIPPED}}}+ {_WORD}"
SPOT = f"(?<= ){MARK}(?=({_NEXT}{_NEXT}))"
STRETCH = f"(?<= )(?=({_WORD} {_WORD} )(?:{_WORD} ){{{BARREN - 2}}})"
PAIR = "(?<= )(?=([^ ]+ [^ ]+))"


def with_signatures(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with ``name``: the sorted distinct 32-bit hashes of the spots of column ``text``.

    Each step is a column of its own, so that no pattern is run twice.
    """
    plain = F.concat(F.lit(" "), F.regexp_replace(F.lower(text), "[^\\p{L}\\p{N}]+", " "), F.lit(" "))
    found = lambda pattern: F.regexp_extract_all(F.col("_plain"), F.lit(pattern), F.lit(1))
    df = df.withColumn("_plain", F.regexp_replace(plain, ANCHOR, MARK)).withColumn("_spots", F.array_distinct(F.concat(found(SPOT), found(STRETCH))))
    # A chain starts with a space and the pair of a stretch ends with one, so they never meet other pairs.
    few = F.size("_spots") < LEAST_SPOTS
    df = df.withColumn("_spots", F.when(few, F.array_distinct(F.concat(F.col("_spots"), found(PAIR)))).otherwise(F.col("_spots")))
    nothing = F.coalesce(F.length(text), F.lit(0)) == 0
    chosen = F.when(nothing, F.array().cast("array<string>")).when(F.size("_spots") > 0, F.col("_spots")).otherwise(F.array(text))
    return df.withColumn(name, F.array_sort(F.array_distinct(F.transform(chosen, lambda x: F.xxhash64(x).bitwiseAND(F.lit(0xFFFFFFFF)))))).drop("_plain", "_spots")


def fingerprint(found: Column) -> Column:
    """A signature set as a string: its hashes in hexadecimal."""
    return F.array_join(F.transform(found, lambda x: F.lower(F.hex(x))), " ")


def likeness(a: Column, b: Column, least: float = 0.0) -> Column:
    """Jaccard similarity of two sets; 0 without looking if their lengths alone keep it under ``least``."""
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    shared = F.size(F.array_intersect(a, b)).cast("double")
    return F.when(large == 0, F.lit(1.0)).when((small == 0) | (small < least * large), F.lit(0.0)).otherwise(shared / (F.size(a) + F.size(b) - shared))


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, the signature set ``spots`` and ``fingerprint``."""
    return with_signatures(docs.select("doc_id", "text"), "text", "spots").select("doc_id", "spots", fingerprint(F.col("spots")).alias("fingerprint"))


def _count_below(borders: list[int], value: Column, equal: bool) -> Column:
    """How many of the ascending ``borders`` are below ``value`` (or equal to it), found in two steps."""
    if not borders:
        return F.lit(0)
    step = max(1, int(len(borders) ** 0.5))
    groups = [borders[k : k + step] for k in range(0, len(borders), step)]
    under = (lambda x: x <= value) if equal else (lambda x: x < value)
    whole = F.size(F.filter(F.array(*(F.lit(g[0]) for g in groups)), under))
    inner = F.get(F.array(*(F.array(*(F.lit(x) for x in g)) for g in groups)), whole - 1)
    return F.when(whole == 0, 0).otherwise((whole - 1) * step + F.size(F.filter(inner, under)))


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, spots and, of the next document in descending doc_id, ``next_text`` and ``next_spots``; after the last: the first.

    Rows are dealt by ranges of doc_id (rows that share one doc_id by their text's hash), one shuffle of the texts.  Each range
    gets a copy of the first row of the range that follows, so the window never looks beyond its own range.  Null ids are last.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("id", F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))).withColumn("hash", F.xxhash64("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = [k / parts for k in range(1, parts)]
    borders = rows.agg(F.percentile_approx("id", wanted, 10 * parts).alias("b")).first().b if wanted else None
    borders = sorted(borders or [])
    low, high = _count_below(borders, F.col("id"), False), _count_below(borders, F.col("id"), True)
    share = F.floor((F.col("hash") / F.lit(2.0**64) + 0.5) * (high - low + 1)).cast("int")
    rows = rows.withColumn("tile", low + F.least(share, high - low))
    firsts = rows.groupBy("tile").agg(F.max(F.struct("id", "hash")).alias("top"))
    everything = Window.orderBy("tile").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # As many rows as there are ranges.
    goes_to = firsts.select("tile", F.col("top.id").alias("id"), F.col("top.hash").alias("hash"), F.coalesce(F.lead("tile").over(Window.orderBy("tile")), F.min("tile").over(everything)).alias("to"))
    copies = rows.join(F.broadcast(goes_to), ["tile", "id", "hash"]).dropDuplicates(["tile"])
    both = rows.withColumn("copy", F.lit(False)).unionByName(copies.drop("tile").withColumnRenamed("to", "tile").withColumn("copy", F.lit(True)))
    dealt = with_signatures(both.repartition(parts, "tile"), "text", "spots")
    order = Window.partitionBy("tile").orderBy("copy", F.col("id").desc(), F.col("hash").desc())
    seen = dealt.withColumn("next_text", F.lead("text").over(order)).withColumn("next_spots", F.lead("spots").over(order))
    return seen.where(~F.col("copy")).select("doc_id", "text", "spots", "next_text", "next_spots")


def edited_likeness(docs: DataFrame) -> DataFrame:
    """Each document beside its edited text (second half taken from the next document) and the next document."""
    half = F.floor(F.char_length("text") / 2).cast("int")
    edited = F.concat(F.expr("substring(text, 1, char_length(text) - cast(floor(char_length(text) / 2) as int))"), F.substring(F.col("next_text"), F.lit(1), half))
    rows = with_signatures(with_next(docs).withColumn("edited", edited), "edited", "edited_spots")
    return rows.select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("spots")).alias("fingerprint"),
        fingerprint(F.col("edited_spots")).alias("edited_fingerprint"),
        likeness(F.col("spots"), F.col("edited_spots")).alias("near_edited"),
        likeness(F.col("spots"), F.col("next_spots")).alias("near_next"),
    )


def similar_pairs(found: DataFrame, least: float = 0.8) -> DataFrame:
    """Pairs of different signature sets with likeness of at least ``least``: a, b (smallest doc_id of each set) and likeness.

    ``found`` has doc_id and spots, as ``fingerprints`` gives them.  Rows with one set are one class; empty sets join nothing.
    """
    classes = found.where(F.size("spots") > 0).groupBy("spots").agg(F.min("doc_id").alias("id"))
    sets = classes.select("id", "spots", F.size("spots").alias("n"))
    postings = sets.select("id", "n", F.explode("spots").alias("spot"))
    ranked = postings.join(postings.groupBy("spot").agg(F.count("*").alias("df")), "spot")
    rare = ranked.groupBy("id", "n").agg(F.array_sort(F.collect_list(F.struct("df", "spot"))).alias("by_df"))
    prefix = rare.select("id", "n", F.explode(F.slice("by_df", 1, (F.col("n") - F.ceil(least * F.col("n")) + 1).cast("int"))).alias("p"))
    level = F.floor(F.log("n") / F.log(F.lit(1 / least)) + 1e-9).cast("int") if least < 1 else F.col("n")
    prefix = prefix.select("id", "n", F.col("p.spot").alias("spot"), level.alias("level"))
    probe = prefix.select(F.col("id").alias("a"), F.col("n").alias("n_a"), "spot", F.explode(F.array(F.col("level"), F.col("level") + 1)).alias("level"))
    pairs = probe.join(prefix.select(F.col("id").alias("b"), F.col("n").alias("n_b"), "spot", "level"), ["spot", "level"])
    first = (F.col("n_a") < F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("a") < F.col("b")))
    pairs = pairs.where(first & (F.col("n_a") >= least * F.col("n_b"))).select("a", "b").distinct()
    pairs = pairs.join(sets.select(F.col("id").alias("a"), F.col("spots").alias("spots_a")), "a").join(sets.select(F.col("id").alias("b"), F.col("spots").alias("spots_b")), "b")
    return pairs.withColumn("likeness", likeness(F.col("spots_a"), F.col("spots_b"), least)).where(F.col("likeness") >= least).select("a", "b", "likeness")
