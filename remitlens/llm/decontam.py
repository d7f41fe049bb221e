"""Benchmark decontamination: which document words lie inside an occurrence of a benchmark window.

A prefix-filtered set join between the windows of the benchmark (the stated query set) and every position of every document:

1. Windows: ``WINDOW`` consecutive words of an item, or the whole item if it is shorter (and not empty); equal windows are
   one, with the set of their items.  Each window is cut into shingles of two words (one for a one-word window).
2. Rarity: every shingle of every window is counted over all documents (a task counts its documents' positions whose shingle
   is a window's, a partial aggregate adds them).  A window occurs only where all its shingles do, so its rarest shingle is
   a necessary prefix of length one; a window whose rarest shingle never occurs is dropped.
3. Join: each document position whose shingle is some window's prefix gives (window, start = position - offset) candidates,
   kept only inside the positional and length bounds (0 <= start, start + window length <= words of the document), and
   verified by comparing the window's words with the document's at ``start`` exactly.

Words are numbered by the windows' vocabulary, so shingle keys are exact integers (not hashes) and a word outside the
vocabulary can never match.  The windows, their prefixes and the vocabulary are broadcast after their size is measured; a
benchmark beyond ``BROADCAST_BYTES`` is taken in blocks of windows, each block one pass, and the blocks' hit intervals are
united per document by Spark.  Documents are never shuffled.

Contract (``contamination``): A-Z lower-cased, words ``WORD``; null text has no words; an item without words has no window.
Per document row, in input order of nothing in particular: its columns, n_words, n_hit (words inside any occurrence), n_items
(items with an occurring window), items_sha256 (SHA-256 of those item_ids sorted as strings and comma-joined; of '' when
none), contaminated (n_hit > 0).  Repeated rows give repeated results; an empty table gives no rows.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from remitlens.llm.support import saved, ship

#: Fixed values of the contract: the word pattern and the window length.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Its complement: words are the pieces between runs of these.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10

#: The most bytes of windows broadcast at once.
BROADCAST_BYTES = 256 << 20

_WORD = re.compile(WORD)
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
OUTPUTS = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.translate(_LOWER)) if text else []


def windows(benchmark: DataFrame) -> DataFrame:
    """(window array<string>, items array<long>): every distinct window of the benchmark with the items holding it."""
    words = F.regexp_extract_all(F.translate(F.coalesce(F.col("text"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(WORD), 0)
    items = benchmark.select("item_id", words.alias("w")).where(F.size("w") > 0)
    cut = F.when(
        F.size("w") >= WINDOW, F.transform(F.sequence(F.lit(0), F.size("w") - WINDOW), lambda i: F.slice("w", i + 1, WINDOW))
    ).otherwise(F.array(F.col("w")))
    return items.select("item_id", F.explode(cut).alias("window")).groupBy("window").agg(F.array_sort(F.collect_set("item_id")).alias("items"))


def _keys(ids: np.ndarray, width: int, same: np.ndarray | None = None) -> np.ndarray:
    """Exact keys of the shingles of ``width`` words at every position (-1 where a word is outside the vocabulary, or, when
    ``same`` marks which neighbouring positions belong to one document, where a pair would cross two)."""
    if width == 1:
        return np.where(ids >= 0, ids + 1, -1)
    if len(ids) < 2:
        return np.zeros(0, np.int64)
    ok = (ids[:-1] >= 0) & (ids[1:] >= 0)
    if same is not None:
        ok &= same
    return np.where(ok, ((ids[:-1] + 1) << 32) | (ids[1:] + 1), -1)


def _member(keys: np.ndarray, sorted_keys: np.ndarray) -> np.ndarray:
    """Which ``keys`` are in ``sorted_keys``, by binary search (the sorted side is never sorted again)."""
    if len(sorted_keys) == 0 or len(keys) == 0:
        return np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return sorted_keys[at] == keys


class Block:
    """The windows of one block: vocabulary, word ids, and, once counted, the prefix of each window."""

    def __init__(self, rows: list[tuple[list[str], list[int]]]):
        self.vocab: dict[str, int] = {}
        self.windows = [np.array([self.vocab.setdefault(w, len(self.vocab)) for w in words], np.int64) for words, _ in rows]
        self.items = [items for _, items in rows]
        self.widths = sorted({min(2, len(w)) for w in self.windows})
        shingles = [_keys(w, min(2, len(w))) for w in self.windows]
        self.shingles = shingles
        self.all_keys = np.unique(np.concatenate(shingles)) if shingles else np.zeros(0, np.int64)
        self.prefix: dict[int, list[tuple[int, int]]] = {}
        self.prefix_keys = np.zeros(0, np.int64)
        self.vocab_array: pa.Array | None = None

    def __getstate__(self):
        return {**self.__dict__, "vocab_array": None}

    def choose_prefixes(self, counts: dict[int, int]) -> None:
        """Each window's rarest shingle (ties: the first); windows whose rarest shingle never occurs are left out."""
        for k, keys in enumerate(self.shingles):
            seen = np.array([counts.get(int(x), 0) for x in keys])
            at = int(np.argmin(seen))
            if seen[at] > 0:
                self.prefix.setdefault(int(keys[at]), []).append((k, at))
        self.prefix_keys = np.array(sorted(self.prefix), np.int64)

    def ids(self, text: str | None) -> np.ndarray:
        return np.array([self.vocab.get(w, -1) for w in words_of(text)], np.int64)

    def batch_ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Word ids of a whole column of texts (-1 outside the vocabulary) and each text's word offsets, tokenized and looked
        up by Arrow's kernels: A-Z lower-cased, split at separator runs, empty pieces of the ends dropped."""
        if self.vocab_array is None:
            self.vocab_array = pa.array(list(self.vocab), pa.string())
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        pieces = pc.split_pattern_regex(pc.ascii_lower(texts), pattern=SEPARATORS)
        flat = pieces.flatten()
        parents = np.asarray(pieces.value_parent_indices(), np.int64)
        real = np.asarray(pc.greater(pc.binary_length(flat), 0).fill_null(False), bool)
        ids = np.asarray(pc.index_in(flat.filter(pa.array(real)), value_set=self.vocab_array).cast(pa.int64()).fill_null(-1), np.int64)
        counts = np.bincount(parents[real], minlength=len(texts))
        return ids, np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)

    def batch_keys(self, ids: np.ndarray, offsets: np.ndarray, width: int) -> np.ndarray:
        """Keys of every position of the concatenated ids, pairs never crossing from one text into the next."""
        if width == 1:
            return _keys(ids, 1)
        same = np.ones(max(len(ids) - 1, 0), bool)
        ends = offsets[1:-1] - 1
        same[ends[(ends >= 0) & (ends < len(same))]] = False
        return _keys(ids, 2, same)


def _counts(block_value):
    def run(batches):
        block = block_value.value
        found = np.zeros(len(block.all_keys), np.int64)
        for batch in batches:
            ids, offsets = block.batch_ids(batch.column("text"))
            for width in block.widths:
                keys = block.batch_keys(ids, offsets, width)
                keys = keys[_member(keys, block.all_keys)]
                found += np.bincount(np.searchsorted(block.all_keys, keys), minlength=len(block.all_keys))
        seen = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(block.all_keys[seen], pa.int64()), pa.array(found[seen], pa.int64())], names=["key", "count"])

    return run


def _hits(block_value, carried: list[str]):
    def run(batches):
        block = block_value.value
        for batch in batches:
            ids, offsets = block.batch_ids(batch.column("text"))
            n_docs = batch.num_rows
            spans: list[list[tuple[int, int]]] = [[] for _ in range(n_docs)]
            held: list[set[int]] = [set() for _ in range(n_docs)]
            for width in block.widths:
                keys = block.batch_keys(ids, offsets, width)
                for g in np.flatnonzero(_member(keys, block.prefix_keys)):
                    doc = int(np.searchsorted(offsets, g, side="right")) - 1
                    first, n = int(offsets[doc]), int(offsets[doc + 1] - offsets[doc])
                    for k, offset in block.prefix[int(keys[g])]:
                        window = block.windows[k]
                        if min(2, len(window)) != width:
                            continue
                        start = int(g) - first - offset
                        if start < 0 or start + len(window) > n:
                            continue
                        if np.array_equal(ids[first + start : first + start + len(window)], window):
                            spans[doc].append((start, start + len(window)))
                            held[doc].update(block.items[k])
            for doc_spans in spans:
                doc_spans.sort()
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in carried]
                + [
                    pa.array(np.diff(offsets), pa.int64()),
                    pa.array([[s for s, _ in d] for d in spans], pa.list_(pa.int64())),
                    pa.array([[e for _, e in d] for d in spans], pa.list_(pa.int64())),
                    pa.array([sorted(h) for h in held], pa.list_(pa.int64())),
                ],
                names=[*carried, "_n_words", "_starts", "_ends", "_items"],
            )

    return run


def _blocks(found: DataFrame) -> list[list[tuple[list[str], list[int]]]]:
    """The windows in blocks of at most ``BROADCAST_BYTES`` (measured as words' bytes plus a fixed cost a word and item)."""
    sized = found.select("window", "items", (F.aggregate("window", F.lit(0), lambda acc, w: acc + F.length(w) + 64) + 16 * F.size("items")).alias("bytes"))
    blocks: list[list] = [[]]
    filled = 0
    for r in sized.toLocalIterator():
        if blocks[-1] and filled + r["bytes"] > BROADCAST_BYTES:
            blocks.append([])
            filled = 0
        blocks[-1].append((list(r["window"]), list(r["items"])))
        filled += r["bytes"]
    return [b for b in blocks if b]


def _covered(starts, ends):
    """Words inside the union of [start, end) intervals given sorted by start."""
    spans = F.arrays_zip(starts.alias("s"), ends.alias("e"))
    merged = F.aggregate(
        F.array_sort(spans),
        F.struct(F.lit(0).cast("long").alias("total"), F.lit(0).cast("long").alias("reach")),
        lambda acc, x: F.struct(
            (acc["total"] + F.greatest(F.lit(0).cast("long"), x["e"] - F.greatest(x["s"], acc["reach"]))).alias("total"),
            F.greatest(acc["reach"], x["e"]).alias("reach"),
        ),
    )
    return merged["total"]


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Every row of ``docs`` with the contract's columns (those names in ``docs`` are replaced)."""
    spark = docs.sparkSession
    ship(spark)
    carried = [c for c in docs.columns if c not in OUTPUTS]
    found = saved(windows(benchmark), "decontam-windows")
    blocks = _blocks(found)
    rid = "_decontam_row"
    many = len(blocks) > 1
    base = saved(docs.select(*carried).withColumn(rid, F.monotonically_increasing_id()), "decontam-docs") if many else docs.select(*carried)
    keep = [*carried, rid] if many else carried
    parts = []
    for rows in blocks or [[]]:
        block = Block(rows)
        shared = spark.sparkContext.broadcast(block)
        counts = {r["key"]: r["count"] for r in base.select(F.col("text")).mapInArrow(_counts(shared), "key long, count long").groupBy("key").agg(F.sum("count").alias("count")).toLocalIterator()}
        block.choose_prefixes(counts)
        shared = spark.sparkContext.broadcast(block)
        schema = StructType(
            [*base.select(*keep).schema.fields, StructField("_n_words", LongType())]
            + [StructField(c, ArrayType(LongType())) for c in ("_starts", "_ends", "_items")]
        )
        parts.append(base.select(*keep).mapInArrow(_hits(shared, keep), schema))
    hits = parts[0]
    for p in parts[1:]:
        hits = hits.unionByName(p)
    if many:
        hits = hits.groupBy(rid).agg(
            *(F.first(c).alias(c) for c in carried),
            F.first("_n_words").alias("_n_words"),
            F.flatten(F.collect_list("_starts")).alias("_starts"),
            F.flatten(F.collect_list("_ends")).alias("_ends"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("_items")))).alias("_items"),
        )
    n_hit = _covered(F.col("_starts"), F.col("_ends"))
    listed = F.array_join(F.array_sort(F.transform("_items", lambda i: i.cast("string"))), ",")
    return hits.select(
        *carried,
        F.col("_n_words").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size("_items").cast("long").alias("n_items"),
        F.sha2(listed, 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


#: The same rows in DuckDB: every document position against every window by its first word, then the whole window.
SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
starts AS (SELECT item_id, w, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM b WHERE len(w) > 0),
win AS (SELECT item_id, CASE WHEN len(w) >= 10 THEN list_slice(w, i, i + 9) ELSE w END AS win FROM starts),
pos AS (SELECT rid, generate_subscripts(w, 1) AS p, unnest(w) AS word FROM d),
occ AS (SELECT pos.rid, pos.p, win.item_id, len(win.win) AS l
        FROM pos JOIN win ON pos.word = win.win[1] JOIN d ON d.rid = pos.rid
        WHERE list_slice(d.w, pos.p, pos.p + len(win.win) - 1) = win.win),
hit AS (SELECT DISTINCT rid, unnest(range(p, p + l)) AS q FROM occ),
hc AS (SELECT rid, count(*) AS n_hit FROM hit GROUP BY rid),
ic AS (SELECT rid, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS items FROM occ GROUP BY rid)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(hc.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(len(ic.items), 0) AS BIGINT) AS n_items,
       sha256(coalesce(list_aggr(ic.items, 'string_agg', ','), '')) AS items_sha256,
       coalesce(hc.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hc USING (rid) LEFT JOIN ic USING (rid)
"""
