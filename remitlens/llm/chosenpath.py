"""Near-duplicate documents by a chosen-path set similarity join.

Documents are sets of word shingles; rows with equal sets are one class.  Each class has minwise tokens: for ``TOKENS`` hash functions the
smallest value over its set.  A tree starts with all classes in one node and branches: a node draws one or two of the
tokens (1 / threshold on average) and sends each class to the children named by its values there, so similar sets go the same
way more often.  The draw depends on the node alone, so a class finds its own nodes without looking at others.  Independent trees are
branched to a depth that makes nodes of unrelated sets small.  The deeper they are, the more of them lose a pair at the threshold, so their
number follows from the depth (``trees``): all of them miss it with a chance of about one in a million.

A node is worked in two steps, so that a group of near copies never yields all its pairs.  First every class is compared with the
smallest class of each of its nodes, the smallest of these first and the others if that left them apart; the links found make components.  Then only nodes that still hold several components matter:
the classes outside the node's largest component are compared with all classes of other components there, as pairs while that is
a bounded number for each class of the node, and by blocks of full sets without any screen otherwise.  No node is branched further: each level
would lose links.  Comparisons as pairs are screened by set sizes and, but for
sets of up to 16 shingles, by 128-bit sketches and by the share of equal tokens (a pair at the threshold fails with a chance of about
one in twenty thousand), and every link is confirmed on the full sets.

Components come from repeated contraction: every component takes the smallest of its neighbours, chains are shortened, and links are
renamed until none is left.  All steps are joins and aggregations written to the shared folder once.

Defined results: a text with fewer words than a shingle is one shingle of all its words; texts without words or null have no shingles, are
linked with nothing and keep themselves.  Repeated rows are copies.  Rows of one doc_id with different texts are linked.  A null
doc_id is never the smallest of a component that has another.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from remitlens.llm.support import LOWER_ASCII, Hasher, mix, saved, ship, slices, text_bytes, word_spans

TOKENS = 128
#: Chance that all trees miss a pair at the threshold; it sets their number.
MISSED = 1e-6
#: Sets of up to so many shingles are not screened but go to the confirmation.
FEW = 16
#: Bits of two sketches that may differ: 0.1 of 128 are expected at a similarity of 0.8, the rest is over four deviations.
SKETCH_OFF = 28
#: Deviations that the share of equal tokens may lie under the threshold.
DEVIATIONS = 4.2
#: Unrelated sets share a token with about this chance; it sets the first depth.
UNRELATED = 0.05
#: Comparisons for each class of a node that are made as pairs; nodes with more are compared in blocks, where no pair is a row and a set
#: goes to a task once for each block it meets instead of once for each class.
WIDTH = 8
#: Classes and set items of a block that is compared at once on full sets.
BLOCK, BLOCK_ITEMS = 1024, 1 << 18
#: Bits for each id in the bitmap that finds the documents whose sets are needed, and bits of a bitmap at most (8 MB).
BITS_EACH, MOST_BITS = 256, 1 << 26

_RNG = np.random.Generator(np.random.PCG64(5))
_LOW, _HIGH, _ADD = (_RNG.integers(1, 1 << 32, TOKENS, dtype=np.uint64).astype(np.uint32) for _ in range(3))
_LOW |= 1
_HIGH |= 1


def shingle_sets(texts: pa.Array, words: int, first_doc: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text of a slice, ascending, and where each text's set begins."""
    docs = len(texts)
    data, starts = text_bytes(texts)
    first, end = word_spans(data)
    hashes = Hasher(LOWER_ASCII[data]).spans(first, end)
    doc = np.searchsorted(starts, first, "right") - 1
    counts = np.bincount(doc, minlength=docs)
    begins = np.cumsum(counts) - counts
    keys, owner = [], []
    n = len(hashes)
    if n >= words:
        at = np.flatnonzero(doc[: n - words + 1] == doc[words - 1 :])
        key = np.zeros(len(at), np.uint64)
        for k in range(words):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + hashes[at + k])
        keys.append(key)
        owner.append(doc[at])
    for k in range(1, words):  # texts with fewer words than a shingle
        short = np.flatnonzero(counts == k)
        key = np.full(len(short), k, np.uint64)
        for j in range(k):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + hashes[begins[short] + j])
        keys.append(key)
        owner.append(short)
    key, owner = np.concatenate(keys), np.concatenate(owner)
    order = np.lexsort((key, owner))
    key, owner = key[order], owner[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
    key, owner = key[new], owner[new]
    return key, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=docs))])


def set_keys(sets: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 128-bit name for each set, as two integers; 0 for empty ones."""
    sizes = np.diff(begins).astype(np.uint64)
    out = []
    for salt in (0x1234567, 0x89ABCDEF):
        total = np.zeros(len(sets) + 1, np.uint64)
        np.cumsum(mix(sets + np.uint64(salt)), out=total[1:])
        out.append(mix((total[begins[1:]] - total[begins[:-1]]) + sizes).view(np.int64))
    return out[0], out[1]


def tokens_of(sets: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """The minwise tokens of non-empty sets, one row each."""
    low, high = sets.astype(np.uint32), (sets >> np.uint64(32)).astype(np.uint32)
    at = begins[:-1]
    out = np.empty((len(at), TOKENS), np.uint32)
    for k in range(TOKENS):
        out[:, k] = np.minimum.reduceat(low * _LOW[k] + high * _HIGH[k] + _ADD[k], at)
    return out


def described(docs: DataFrame, words: int) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, set name (k1, k2), sketch, and minwise tokens, a byte each (null for empty sets).

    A byte of the mixed token is enough: equal tokens stay equal, and others agree by chance in one of 256.
    """
    ship(docs.sparkSession)

    def run(batches):
        for batch in batches:
            for first, end in slices(batch.column(1)):
                sets, begins = shingle_sets(batch.column(1).slice(first, end - first), words)
                n = np.diff(begins)
                k1, k2 = set_keys(sets, begins)
                full = n > 0
                sketches, tokens = np.zeros((len(n), 2), np.int64), [None] * len(n)
                if full.any():
                    found = tokens_of(sets, np.concatenate([begins[:-1][full], begins[-1:]]))
                    # The lowest bits of tokens hang together, as the multipliers are odd; mixed ones do not.
                    found = (mix(found.astype(np.uint64)) >> np.uint64(56)).astype(np.uint8)
                    sketches[full] = np.packbits(found >> 7, axis=1).view(np.int64)
                    for at, row in zip(np.flatnonzero(full).tolist(), found, strict=True):
                        tokens[at] = row.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, end - first), pa.array(n, pa.int64()), pa.array(k1), pa.array(k2), pa.array(sketches[:, 0]), pa.array(sketches[:, 1]), pa.array(tokens, pa.binary())],
                    ["doc_id", "n_shingles", "k1", "k2", "sketch", "sketch2", "tokens"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, k1 long, k2 long, sketch long, sketch2 long, tokens binary")


def missed(depth: int, trees: int, threshold: float) -> float:
    """The chance that ``trees`` trees of ``depth`` levels all miss a pair at the threshold.

    The trees draw from the same tokens, so the share of equal ones is held in common; shares that the screen drops anyway do not count.
    """
    least, total = threshold - DEVIATIONS * (threshold * (1 - threshold) / TOKENS) ** 0.5, 0.0
    twice = min(1, 1 / threshold - 1)
    for equal in range(TOKENS + 1):
        share = equal / TOKENS
        if share >= least:
            lost = 0.0
            for _ in range(depth):
                one = 1 - share + share * lost
                lost = (1 - twice) * one + twice * one * one
            total += comb(TOKENS, equal) * threshold**equal * (1 - threshold) ** (TOKENS - equal) * lost**trees
    return total


def trees(depth: int, threshold: float) -> int:
    """The fewest trees of ``depth`` levels that miss a pair at the threshold with a chance of at most ``MISSED``."""
    n = 1
    while missed(depth, n, threshold) > MISSED:
        n += 1
    return n


def _children(node: np.ndarray, owner: np.ndarray, tokens: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """The child nodes of (class row, node): each node draws its tokens from its own name."""
    draw = mix(node + np.uint64(0x51ED27))
    twice = (draw >> np.uint64(40)).astype(np.float64) / (1 << 24) < 1 / threshold - 1
    one = (draw & np.uint64(0xFFFF)).astype(np.int64) % TOKENS
    step = 1 + ((draw >> np.uint64(16)) & np.uint64(0xFFFF)).astype(np.int64) % (TOKENS - 1)
    name = lambda at, which: mix(mix(node[at] + which[at].astype(np.uint64)) + tokens[owner[at], which[at]])
    every, some = np.arange(len(node)), np.flatnonzero(twice)
    return np.concatenate([name(every, one), name(some, (one + step) % TOKENS)]), np.concatenate([owner, owner[some]])


def branched(rows: DataFrame, levels: int, threshold: float) -> DataFrame:
    """Nodes (node, cid) of classes after ``levels`` levels from the roots of all trees."""
    ship(rows.sparkSession)
    roots = trees(levels, threshold)

    def run(batches):
        for batch in batches:
            for at in range(0, len(batch), 2000):
                part = batch.slice(at, 2000)
                tokens = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint8).reshape(-1, TOKENS).astype(np.uint64)
                owner = np.repeat(np.arange(len(part)), roots)
                node = np.tile(mix(np.arange(1, roots + 1, dtype=np.uint64)), len(part))
                for _ in range(levels):
                    node, owner = _children(node, owner, tokens, threshold)
                yield pa.RecordBatch.from_arrays([pa.array(node.view(np.int64)), part.column(0).take(pa.array(owner))], ["node", "cid"])

    return rows.select("cid", "tokens").mapInArrow(run, "node long, cid long")


def _plausible(threshold: float):
    """Whether sizes and sketches of ``x`` and ``y`` leave the similarity possible; sketches only of larger sets."""
    small, large = F.least("x.n", "y.n"), F.greatest("x.n", "y.n")
    off = [F.bit_count(F.col(f"x.{c}").bitwiseXOR(F.col(f"y.{c}"))) for c in ("sketch", "sketch2")]
    return (small >= F.lit(threshold) * large) & ((small <= FEW) | (off[0] + off[1] <= SKETCH_OFF))


def _pairs(x: DataFrame, y: DataFrame, threshold: float) -> DataFrame:
    """Distinct plausible pairs (a < b) of rows of ``x`` and ``y`` in one node and in different components."""
    found = x.alias("x").join(y.alias("y"), (F.col("x.node") == F.col("y.node")) & (F.col("x.cid") != F.col("y.cid")) & (F.col("x.comp") != F.col("y.comp")) & _plausible(threshold))
    return found.select(F.least("x.cid", "y.cid").alias("a"), F.greatest("x.cid", "y.cid").alias("b")).distinct()


def _parts(rows: DataFrame, key: str) -> DataFrame:
    """Per ``key``: its classes, those of its largest component, and that component."""
    parts = rows.groupBy(key, "comp").agg(F.count("*").alias("n_comp"))
    return parts.groupBy(key).agg(F.sum("n_comp").alias("size"), F.max("n_comp").alias("largest"), F.max(F.struct("n_comp", "comp"))["comp"].alias("major"))


def _shared(x: list, y: list) -> np.ndarray:
    """The number of items that each set of ``x`` shares with each of ``y``."""
    flat = [(np.frombuffer(b"".join(sets), np.uint64), np.repeat(np.arange(len(sets)), [len(v) // 8 for v in sets])) for sets in (x, y)]
    common = np.intersect1d(flat[0][0], flat[1][0])
    out = np.zeros((len(x), len(y)), np.int64)
    if not len(common):
        return out
    at = []
    for values, owner in flat:
        column = np.minimum(np.searchsorted(common, values), len(common) - 1)
        held = common[column] == values
        column, owner = column[held], owner[held]
        order = np.argsort(column, kind="stable")
        at.append((column[order], owner[order]))
    for first in range(0, len(common), 4096):
        ones = []
        for (column, owner), sets in zip(at, (x, y), strict=True):
            i, j = np.searchsorted(column, [first, first + 4096])
            held = np.zeros((len(sets), 4096), np.float32)
            held[owner[i:j], column[i:j] - first] = 1
            ones.append(held)
        out += (ones[0] @ ones[1].T).astype(np.int64)
    return out


def _block_links(table: pa.Table, percent: int) -> pa.Table:
    """A spanning forest (a, b) of the links between classes of different components in two blocks, or in one."""
    right = table.column("right").to_numpy(zero_copy_only=False)
    cid, comp = (table.column(c).to_numpy() for c in ("cid", "comp"))
    items = table.column("items").to_pylist()
    x = np.flatnonzero(~right)
    y = np.flatnonzero(right) if right.any() else x
    size = np.array([len(v) // 8 for v in items])
    shared = _shared([items[k] for k in x], [items[k] for k in y])
    linked = (100 * shared >= percent * (size[x][:, None] + size[y] - shared)) & (comp[x][:, None] != comp[y])
    near = np.zeros((len(cid), len(cid)), bool)
    near[np.ix_(x, y)] = linked
    near |= near.T
    a, b, new = [], [], near.any(1)
    while new.any():
        front = np.flatnonzero(new)[:1]
        new[front] = False
        while len(front):
            reached = np.flatnonzero(near[front].any(0) & new)
            a.append(cid[front[near[np.ix_(front, reached)].argmax(0)]] if len(reached) else cid[:0])
            b.append(cid[reached])
            new[reached] = False
            front = reached
    ends = [np.concatenate([cid[:0], *c]) for c in (a, b)]
    return pa.table({"a": pa.array(ends[0], pa.int64()), "b": pa.array(ends[1], pa.int64())})


class Join:
    """One run over ``docs`` (doc_id, text)."""

    def __init__(self, docs: DataFrame, words: int, percent: int):
        self.docs, self.words, self.percent = docs.select("doc_id", "text"), words, percent
        self.threshold = percent / 100
        rows = described(self.docs, words).withColumn("rid", F.monotonically_increasing_id())
        self.rows = saved(rows, "shingled")
        full = self.rows.where(F.col("n_shingles") > 0)
        # A class is named by the smallest number of its rows.
        self.classes = saved(full.groupBy("k1", "k2").agg(F.min("rid").alias("cid"), F.min("doc_id").alias("rep")), "classes")
        self.members = full.select("doc_id", "rid", "k1", "k2").join(self.classes, ["k1", "k2"]).select("doc_id", "rid", "cid")
        tops = self.classes.select(F.col("cid").alias("rid"))
        self.tops = saved(full.join(tops, "rid", "left_semi").select(F.col("rid").alias("cid"), F.col("n_shingles").alias("n"), "sketch", "sketch2", "tokens"), "tops")

    def likely(self, pairs: DataFrame) -> DataFrame:
        """The ``pairs`` whose share of equal tokens is near the threshold or above, and all of small sets."""
        least = self.threshold - DEVIATIONS * (self.threshold * (1 - self.threshold) / TOKENS) ** 0.5

        def compare(batches):
            for batch in batches:
                x, y = (np.frombuffer(b"".join(c.to_pylist()), np.uint8).reshape(-1, TOKENS) for c in batch.columns[2:4])
                few = batch.column(4).to_numpy() <= FEW
                yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(few | ((x == y).mean(1) >= least)))

        tokens = lambda c: self.tops.select(F.col("cid").alias(c), F.col("tokens").alias(f"tokens_{c}"), F.col("n").alias(f"n_{c}"))
        both = pairs.join(tokens("a"), "a").join(tokens("b"), "b").select("a", "b", "tokens_a", "tokens_b", F.least("n_a", "n_b").alias("n"))
        return both.mapInArrow(compare, "a long, b long")

    def texts(self, ids: DataFrame) -> DataFrame:
        """The texts of all documents with an id of ``ids`` (rep) and of a few others.

        The ids are marks in a bitmap of bounded size, so that no text is shuffled; beyond that size more others come along.
        """
        bits = min(MOST_BITS, max(1, ids.count()) * BITS_EACH)
        place = lambda c: F.pmod(F.xxhash64(c), F.lit(bits)) + 1
        marks = ids.select(F.bitmap_bucket_number(place("rep")).alias("bucket"), F.bitmap_bit_position(place("rep")).alias("at")).repartition("bucket")
        marks = marks.groupBy("bucket").agg(F.bitmap_construct_agg("at").alias("bits"))
        docs = self.docs.withColumn("bucket", F.bitmap_bucket_number(place("doc_id"))).withColumn("at", F.bitmap_bit_position(place("doc_id")))
        marked = F.expr("getbit(cast(conv(hex(substring(bits, cast(at div 8 as int) + 1, 1)), 16, 10) as int), cast(at % 8 as int)) = 1")
        return docs.join(F.broadcast(marks), "bucket").where(marked).select("text")

    def sets(self, cids: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The places (cid, place) of the classes ``cids`` in a table of full sets, and that table (place, items), which may hold others."""
        words = self.words
        wanted = saved(cids.join(self.classes, "cid"), "wanted")

        def sets_of(batches):
            for batch in batches:
                for first, end in slices(batch.column(0)):
                    sets, begins = shingle_sets(batch.column(0).slice(first, end - first), words)
                    k1, k2 = set_keys(sets, begins)
                    data, b = sets.tobytes(), (begins * 8).tolist()
                    yield pa.RecordBatch.from_arrays([pa.array(k1), pa.array(k2), pa.array([data[i:j] for i, j in zip(b[:-1], b[1:], strict=True)], pa.binary())], ["k1", "k2", "items"])

        found = self.texts(wanted.select("rep")).mapInArrow(sets_of, "k1 long, k2 long, items binary")
        found = saved(found.withColumn("place", F.monotonically_increasing_id()), "sets")
        places = found.groupBy("k1", "k2").agg(F.min("place").alias("place")).join(wanted, ["k1", "k2"]).select("cid", "place")
        return saved(places, "places"), found.select("place", "items")

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """The links among ``pairs`` (a, b), by their full sets."""
        percent = self.percent
        pairs = saved(self.likely(pairs), "likely")
        places, sets = self.sets(pairs.select(F.col("a").alias("cid")).union(pairs.select(F.col("b").alias("cid"))).distinct())

        def compare(batches):
            for batch in batches:
                a, b, keep = batch.column(2), batch.column(3), np.zeros(len(batch), bool)
                for k in range(len(batch)):
                    x, y = (np.frombuffer(c[k].as_buffer(), np.uint64) for c in (a, b))
                    both = np.sort(np.concatenate([x, y]))
                    shared = int((both[1:] == both[:-1]).sum())
                    keep[k] = 100 * shared >= percent * (len(x) + len(y) - shared)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep))

        for c in "ab":
            pairs = pairs.join(places.select(F.col("cid").alias(c), F.col("place").alias(f"at_{c}")), c)
        left = pairs.join(sets.select(F.col("place").alias("at_a"), F.col("items").alias("items_a")), "at_a")
        both = left.join(sets.select(F.col("place").alias("at_b"), F.col("items").alias("items_b")), "at_b")
        return saved(both.select("a", "b", "items_a", "items_b").mapInArrow(compare, "a long, b long"), "links")

    def labelled(self, nodes: DataFrame, labels: DataFrame) -> DataFrame:
        """``nodes`` with the component of each class; one that has no link is its own."""
        return nodes.join(labels, "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))

    def exact(self, rows: DataFrame) -> DataFrame:
        """Links between components among the classes (node, first, cid, n, comp) of large nodes, all of them up to those that others imply.

        No screen is used: a node's classes are cut into blocks of similar set sizes, and blocks are compared on the full sets.
        """
        spark, percent = self.docs.sparkSession, self.percent
        # Nodes that overlap are worked as one where that is no more to compare.
        edges = rows.select(F.col("first").alias("a"), F.col("cid").alias("b")).where("a <> b").distinct()
        groups = contracted(unlabelled(spark), edges).select("cid", F.col("comp").alias("grp"))
        rows = saved(rows.join(groups, "cid").select("node", "grp", "cid", "n", "comp"), "large")
        effort = F.sum(F.col("size") * (F.col("size") - F.col("largest")))
        apart = _parts(rows, "node").join(rows.groupBy("node").agg(F.first("grp").alias("grp")), "node").groupBy("grp").agg(effort.alias("apart"))
        whole = _parts(rows.select("grp", "cid", "comp").distinct(), "grp").groupBy("grp").agg(effort.alias("whole")).join(apart, "grp").where("whole <= apart")
        rows = rows.join(whole.select("grp", "whole"), "grp", "left").select(F.when(F.col("whole").isNotNull(), F.col("grp")).otherwise(F.col("node")).alias("node"), "cid", "n", "comp").distinct()
        # Set sizes of a link lie in one band or in two neighbouring ones.
        band = F.floor(F.log("n") * ((1 - 1e-9) / max(-np.log(self.threshold), 1e-6)))
        rows = saved(rows.withColumn("band", band), "banded")
        rows = rows.join(_parts(rows, "node").where("size > largest").select("node", "major"), "node").withColumn("inner", F.col("comp") == F.col("major"))
        key = ["node", "inner", "band"]
        blocks = rows.groupBy(key).agg(F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / BLOCK_ITEMS)).alias("blocks"))
        rows = saved(rows.join(blocks, key).withColumn("block", F.pmod(F.xxhash64("cid"), "blocks")).select(*key, "block", "cid", "comp"), "blocked")
        key += ["block"]
        blocks = saved(rows.select(key).distinct(), "blocks")
        once = F.col("y.inner") | (F.struct("x.band", "x.block") <= F.struct("y.band", "y.block"))
        pairs = blocks.where("not inner").alias("x").join(blocks.alias("y"), (F.col("x.node") == F.col("y.node")) & (F.abs(F.col("x.band") - F.col("y.band")) <= 1) & once)
        pairs = saved(pairs.select(F.struct("x.*").alias("x"), F.struct("y.*").alias("y")).withColumn("pair", F.monotonically_increasing_id()), "block_pairs")
        sides = pairs.select("pair", F.lit(False).alias("right"), "x.*").unionByName(pairs.where("x <> y").select("pair", F.lit(True).alias("right"), "y.*"))
        places, sets = self.sets(rows.select("cid").distinct())
        full = saved(rows.join(places.join(sets, "place").select("cid", "items"), "cid"), "block_sets")
        both = full.join(sides, key).select("pair", "right", "cid", "comp", "items")
        ship(spark)

        def compare(table):
            return _block_links(table, percent)

        return saved(both.groupBy("pair").applyInArrow(compare, "a long, b long"), "links")

    def components(self) -> DataFrame:
        """cid and comp of every class with a link."""
        spark = self.docs.sparkSession
        n = max(1, self.tops.count())
        depth = max(2, int(np.ceil(np.log(n / 4 + 1) / np.log(1 / UNRELATED))))
        node = Window.partitionBy("node")
        nodes = branched(self.tops, depth, self.threshold).withColumn("size", F.count("*").over(node)).withColumn("first", F.min("cid").over(node))
        nodes = saved(nodes.where("size > 1").drop("size").join(self.tops.drop("tokens"), "cid"), "nodes")
        own = nodes.withColumn("comp", F.col("cid"))
        # The smallest class of a node is ``a`` of its pairs.
        stars = saved(_pairs(own, own.where("cid = first"), self.threshold), "stars")
        links = self.confirmed(stars.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"))
        # Rows of one doc_id in different classes belong together.
        twice = self.members.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("cid").alias("a"), F.max("cid").alias("b")).where("a < b")
        if not twice.isEmpty():
            every = self.members.join(twice.select("doc_id", "a"), "doc_id").where("a < cid").select("a", F.col("cid").alias("b")).distinct()
            links = saved(links.unionByName(every), "links")
        labels = contracted(unlabelled(spark), links)
        ends = [labels.select(F.col("cid").alias(c), F.col("comp").alias(f"comp_{c}")) for c in "ab"]
        apart = stars.join(ends[0], "a", "left").join(ends[1], "b", "left").where(F.coalesce("comp_a", "a") != F.coalesce("comp_b", "b"))
        labels = contracted(labels, self.confirmed(saved(apart.select("a", "b"), "apart")))
        rows = self.labelled(nodes, labels)
        rows = saved(rows.join(_parts(rows, "node").where("size > largest"), "node"), "mixed")
        small = F.col("size") - F.col("largest") <= WIDTH
        minor = rows.where(small & (F.col("comp") != F.col("major")))
        labels = contracted(labels, self.confirmed(_pairs(minor, rows.where(small), self.threshold)))
        large = rows.where(~small).select("node", "first", "cid", "n")
        if not large.isEmpty():
            labels = contracted(labels, self.exact(self.labelled(large, labels)))
        return labels

    def result(self) -> DataFrame:
        labels = self.components()
        named = self.members.join(labels, "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))
        smallest = named.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
        found = named.join(smallest, "comp").select("rid", "component_id")
        rows = self.rows.select("doc_id", "n_shingles", "rid").join(found, "rid", "left")
        component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
        return rows.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def unlabelled(spark: SparkSession) -> DataFrame:
    """No labels (cid, comp).  An empty Python list would be read by Python workers of their own, which then stay in memory."""
    return spark.range(0).select(F.col("id").alias("cid"), F.col("id").alias("comp"))


def contracted(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (cid, comp) after joining the components of the linked classes (a, b): each takes the smallest name among them."""
    renamed = lambda edges, names, key: edges.join(names.select(F.col("cid").alias(key), F.col("comp").alias(f"{key}_to")), key, "left").withColumn(key, F.coalesce(f"{key}_to", key)).drop(f"{key}_to")
    edges = saved(renamed(renamed(links.select("a", "b"), labels, "a"), labels, "b").where("a <> b").distinct(), "edges")
    seen = links.select(F.col("a").alias("cid")).union(links.select(F.col("b").alias("cid"))).distinct()
    labels = seen.join(labels, "cid", "left").select("cid", F.coalesce("comp", "cid").alias("comp")).unionByName(labels.join(seen, "cid", "left_anti"))
    labels = saved(labels, "labels")
    while not edges.isEmpty():
        ends = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = saved(ends.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("comp")).select(F.col("a").alias("cid"), "comp"), "parents")
        for _ in range(2):  # a parent's parent, twice
            above = parent.select(F.col("cid").alias("comp"), F.col("comp").alias("top"))
            parent = parent.join(above, "comp", "left").select("cid", F.coalesce("top", "comp").alias("comp"))
        parent = saved(parent, "parents")
        edges = saved(renamed(renamed(edges, parent, "a"), parent, "b").where("a <> b").distinct(), "edges")
        labels = labels.withColumnRenamed("comp", "old").join(parent.select(F.col("cid").alias("old"), "comp"), "old", "left")
        labels = saved(labels.select("cid", F.coalesce("comp", "old").alias("comp")), "labels")
    return labels


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id and kept (the smallest doc_id of its component).

    Sets of ``words``-word shingles are linked where 100 * intersection >= percent * union.
    """
    return Join(docs, words, percent).result()
