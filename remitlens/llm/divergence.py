"""Source divergence audit: how far each source's term counts lie from its language's and from the other sources'.

Pass 1, exact frequency filtering: the distinct terms of every document are counted per lang by a partial aggregate; a lang
keeps the terms found in at least ``LEAST_DOCS`` of its documents.

Perfect hashes: the kept (lang, term) keys are dealt into shards of about ``SHARD_KEYS`` by a seeded 128-bit hash.  Each shard
builds a minimal perfect hash (hash and displace: buckets by size, one pilot each) in its own task and stores every key at
its slot, so that a look-up verifies the key it lands on.  The shards are broadcast in rounds whose measured size stays
under ``BROADCAST_BYTES``; more kept terms only mean more rounds, never a larger broadcast.

Pass 2, recount: each task counts the terms of its documents by (lang, source), looks each distinct term up once, adds up the
kept ones over its slices, and emits (lang, source, slot, count); a partial aggregate adds them.  A slot is ``shard << 32 | place``: dense within
its shard, so that the counts of a group are an array over slots.

The scores are exact integer arithmetic.  Part ``term`` is Spark functions over the non-zero counts.  Part ``pair`` needs f
over every kept term for every two sources: each (lang, shard) is one task holding a dense matrix of the lang's sources by the
shard's terms (p0 where a source lacks a term), which numpy sums for every pair; Spark adds the partial sums of the shards.
No (pair, term) row is ever shuffled.  The sources of all langs are broadcast after their size is measured; more than
``BROADCAST_BYTES`` of them raise.  Contract (``divergences``):

* null text, lang and source are ''; terms are runs of ``TERM`` after A-Z is lower-cased; repeated rows are documents each.
* every (lang, source) group that occurs, and every lang, gives each kept term of the lang ``p = 1 + floor(1e9 (count + 2) /
  (N + 2V))``, N the group's (lang's) count summed over the kept terms, V their number; ``f = floor((p - q)² / (p + q))``.
* part ``pair``: item each other source of the lang, value the sum of f against that source's p over all kept terms (0 where
  V = 0), all ranks.  Part ``term``: item each kept term with count > 0 in the group and p above the lang's, value f, ranks
  up to ``TOP_TERMS``.  Rank from 1 per (lang, source, part), value descending, item ascending in UTF-8.
* an empty table gives no rows; a group whose lang keeps no term gives pair rows of value 0 and no term rows.
"""

from __future__ import annotations

import collections
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from remitlens.llm.support import LOWER_ASCII, saved, ship, slices, text_bytes

#: Fixed values of the contract: the term pattern, the least document count, the scale of p and the term ranks reported.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
LEAST_DOCS = 10
SCALE = 1_000_000_000
TOP_TERMS = 10

#: Keys a shard holds on average, the mean bucket size of its perfect hash, and the most bytes broadcast at once.
SHARD_KEYS = 4096
BUCKET_KEYS = 4
BROADCAST_BYTES = 256 << 20
SEED = 0x5EED
#: Pilots tried at once by a bucket.
TRIES = 64

#: Bytes of UTF-8 that are part of a term: those that ``TERM`` does not exclude, and all of code points beyond ASCII.
IN_TERM = np.array([b > 127 or re.fullmatch(TERM, chr(b)) is not None for b in range(256)])
_MASK = (1 << 32) - 1
_MASK64 = (1 << 64) - 1
#: Constants of the place mix (a 64-bit finaliser) and the pilot's spread.
_GOLDEN, _MIX1, _MIX2 = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xCA5A826395121157
_KEYS = "lang string, source string, text string"


def key_bytes(lang: str, term: str) -> bytes:
    """A (lang, term) key as bytes: the lang's length first, so that no two keys run together."""
    head = lang.encode()
    return len(head).to_bytes(4, "little") + head + term.encode()


def _hash(key: bytes) -> int:
    return xxhash.xxh3_128_intdigest(key, seed=SEED)


def shard_of(h: int, shards: int) -> int:
    return (h >> 96) % shards


def _place(h: int, pilot: int, m: int) -> int:
    """The place of a key under a pilot: the low 64 bits of its hash and the pilot, mixed (every pilot gives fresh places)."""
    x = (h & _MASK64) ^ ((pilot * _GOLDEN) & _MASK64)
    x = ((x ^ (x >> 32)) * _MIX1) & _MASK64
    x = ((x ^ (x >> 29)) * _MIX2) & _MASK64
    return (x ^ (x >> 32)) % m


def _places(low: np.ndarray, pilots: np.ndarray, m: int) -> np.ndarray:
    """``_place`` of every key (rows, low 64 hash bits as uint64) under every pilot (columns)."""
    return _mixed(low[:, None] ^ (pilots.astype(np.uint64) * np.uint64(_GOLDEN))[None, :], np.uint64(m))


def _mixed(x: np.ndarray, m: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(_MIX1)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(_MIX2)
    return ((x ^ (x >> np.uint64(32))) % m).astype(np.int64)


def build_shard(keys: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """Pilots of a minimal perfect hash over ``keys`` and the keys in slot order.

    Buckets are placed largest first; a bucket takes the first pilot whose places are distinct and free.  Every pilot mixes
    the key's hash afresh, so each try succeeds with the chance of a random placement and the search ends.
    """
    m = len(keys)
    n_buckets = max(1, -(-m // BUCKET_KEYS))
    hashes = [_hash(k) for k in keys]
    members: dict[int, list[int]] = collections.defaultdict(list)
    for i, h in enumerate(hashes):
        members[((h >> 64) & _MASK) % n_buckets].append(i)
    pilots = np.zeros(n_buckets, np.int64)
    taken = np.zeros(m, bool)
    by_slot: list[bytes] = [b""] * m
    low = np.array([h & _MASK64 for h in hashes], np.uint64)
    for bucket, inside in sorted(members.items(), key=lambda kv: (-len(kv[1]), kv[0])):
        # The places of every key of the bucket under TRIES pilots at once, as ``_place`` computes them.
        first = 0
        while True:
            tried = np.arange(first, first + TRIES, dtype=np.int64)
            places = _places(low[inside], tried, m)
            ordered = np.sort(places, axis=0)
            fits = ~taken[places].any(axis=0) & (np.diff(ordered, axis=0) != 0).all(axis=0)
            if fits.any():
                at = int(np.argmax(fits))
                break
            first += TRIES
        pilots[bucket] = first + at
        for i, p in zip(inside, places[:, at]):
            taken[p] = True
            by_slot[int(p)] = keys[i]
    return pilots, by_slot


class Lookup:
    """The broadcast shards of one round: a key's slot, or -1 where the key is not kept or lies in another round."""

    def __init__(self, shards: int, tables: dict[int, tuple[np.ndarray, list[bytes]]]):
        self.shards = shards
        self.tables = tables

    def slot(self, key: bytes) -> int:
        h = _hash(key)
        shard = shard_of(h, self.shards)
        table = self.tables.get(shard)
        if table is None:
            return -1
        pilots, by_slot = table
        m = len(by_slot)
        place = _place(h, int(pilots[((h >> 64) & _MASK) % len(pilots)]), m)
        return (shard << 32) | place if by_slot[place] == key else -1

    def slots(self, keys: list[bytes]) -> np.ndarray:
        """``slot`` of every key."""
        if not hasattr(self, "flat"):
            held = [self.tables.get(k, (np.zeros(0, np.int64), [])) for k in range(self.shards)]
            pilots, sizes = (np.array([len(t[i]) for t in held], np.int64) for i in (0, 1))
            self.flat = pilots, np.cumsum(pilots) - pilots, np.concatenate([t[0] for t in held]), sizes, np.cumsum(sizes) - sizes, [k for t in held for k in t[1]]
        buckets, first_pilot, pilots, sizes, first_key, by_slot = self.flat
        high, low = np.frombuffer(b"".join(xxhash.xxh3_128_digest(k, seed=SEED) for k in keys), ">u8").astype(np.uint64).reshape(-1, 2).T
        shard = ((high >> np.uint64(32)) % np.uint64(self.shards)).astype(np.int64)
        out = np.full(len(keys), -1, np.int64)
        at = np.flatnonzero(sizes[shard])
        shard = shard[at]
        pilot = pilots[first_pilot[shard] + ((high[at] & np.uint64(_MASK)) % buckets[shard].astype(np.uint64)).astype(np.int64)]
        place = _mixed(low[at] ^ (pilot.astype(np.uint64) * np.uint64(_GOLDEN)), sizes[shard].astype(np.uint64))
        same = np.array([by_slot[i] == keys[j] for i, j in zip((first_key[shard] + place).tolist(), at.tolist())], bool)
        out[at[same]] = (shard[same] << 32) | place[same]
        return out


def terms_of(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The terms of a slice of raw texts (null: none), and the row of each."""
    data, starts = text_bytes(texts)
    inside = IN_TERM[data]
    # Every text ends in a line feed, so the edges alternate between the first byte of a term and the one after its last.
    edges = np.flatnonzero(np.diff(inside, prepend=False))
    first, end = edges[0::2], edges[1::2]
    offsets = np.concatenate([[0], np.cumsum(end - first)]).astype(np.int64)
    terms = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(offsets.tobytes()), pa.py_buffer(LOWER_ASCII[data[inside]].tobytes()))
    return np.searchsorted(starts, first, "right") - 1, terms


def _distinct(keys: np.ndarray, total: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys (all below ``total``), ascending, and how often each occurs."""
    if total > max(4 * len(keys), 1 << 16):
        return np.unique(keys, return_counts=True)
    counts = np.bincount(keys, minlength=1)
    found = np.flatnonzero(counts)
    return found, counts[found]


def _document_counts(batches):
    """(lang, term, count): in how many documents of a slice each term occurs."""
    for batch in batches:
        for first, end in slices(batch.column("text")):
            part = batch.slice(first, end - first)
            row, terms = terms_of(part.column("text"))
            coded, langs = terms.dictionary_encode(), part.column("lang").dictionary_encode()
            width = max(1, len(coded.dictionary))
            once = np.unique(row * width + np.asarray(coded.indices, np.int64))
            lang = np.asarray(langs.indices, np.int64)[once // width]
            keys, counts = _distinct(lang * width + once % width, len(langs.dictionary) * width)
            yield pa.RecordBatch.from_arrays(
                [langs.dictionary.take(pa.array(keys // width)), coded.dictionary.take(pa.array(keys % width)).cast(pa.string()), pa.array(counts, pa.int64())],
                names=["lang", "term", "count"],
            )


def _recount(lookup_value, flush: int = 1 << 20, cached: int = 1 << 19):
    """(lang, source, slot, count) of the kept terms of a task's documents; about ``flush`` to
    twice as many rows and ``cached`` looked-up keys are held at once."""
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("slot", pa.int64()), ("count", pa.int64())])

    def run(batches):
        lookup = lookup_value.value
        slots: dict[str, dict[str, int]] = {}
        groups: dict[tuple[str, str], int] = {}
        held: list[tuple[np.ndarray, ...]] = []

        def merged() -> tuple[np.ndarray, ...]:
            group, slot, count = (np.concatenate(c) for c in zip(*held))
            order = np.lexsort((slot, group))
            group, slot, count = group[order], slot[order], count[order]
            new = np.flatnonzero(np.concatenate([[True], (group[1:] != group[:-1]) | (slot[1:] != slot[:-1])]))
            return group[new], slot[new], np.add.reduceat(count, new)

        def out() -> pa.RecordBatch:
            group, slot, count = merged()
            names = pa.array([lang for lang, _ in groups], pa.string()), pa.array([source for _, source in groups], pa.string())
            return pa.RecordBatch.from_arrays([*(n.take(pa.array(group)) for n in names), pa.array(slot), pa.array(count)], schema=schema)

        for batch in batches:
            # A batch is read in slices of about SLICE_BYTES of text, so a task holds the terms of one slice at a time.
            for first, end in slices(batch.column("text")):
                part = batch.slice(first, end - first)
                row, terms = terms_of(part.column("text"))
                # Counted per (group, term), a group being the row's (lang, source) as one integer; only the distinct terms
                # of the slice reach Python, each (lang, term) looked up once a task.
                coded = terms.dictionary_encode()
                langs, sources = (part.column(c).dictionary_encode() for c in ("lang", "source"))
                lang_names, source_names = langs.dictionary.to_pylist(), sources.dictionary.to_pylist()
                group = np.asarray(langs.indices, np.int64) * len(source_names) + np.asarray(sources.indices, np.int64)
                width = max(1, len(coded.dictionary))
                keys, counts = _distinct(group[row] * width + np.asarray(coded.indices, np.int64), len(lang_names) * len(source_names) * width)
                group, code = keys // width, keys % width
                words = coded.dictionary.to_numpy(zero_copy_only=False)
                slot = np.full(len(keys), -1, np.int64)
                for k, lang in enumerate(lang_names):
                    at = np.flatnonzero(group // len(source_names) == k)
                    mine, inverse = np.unique(code[at], return_inverse=True)
                    known = slots.setdefault(lang, {})
                    terms_here = words[mine].tolist()
                    new = [term for term in terms_here if term not in known]
                    if new:
                        head = key_bytes(lang, "")
                        known.update(zip(new, lookup.slots([head + term.encode() for term in new]).tolist()))
                    slot[at] = np.array([known[term] for term in terms_here], np.int64)[inverse]
                kept = slot >= 0
                number = np.zeros(len(lang_names) * len(source_names), np.int64)
                for g in np.unique(group[kept]).tolist():
                    number[g] = groups.setdefault((lang_names[g // len(source_names)], source_names[g % len(source_names)]), len(groups))
                held.append((number[group[kept]], slot[kept], counts[kept]))
                if sum(len(c) for _, _, c in held) >= 2 * flush:
                    held = [merged()]
                    if len(held[0][0]) >= flush:
                        yield out()
                        held, groups = [], {}
                if sum(map(len, slots.values())) >= cached:
                    slots = {}
        if held:
            yield out()

    return run


def _with_shard(shards: int):
    def run(batches):
        for batch in batches:
            cols = batch.to_pydict()
            keys = [key_bytes(lang, term) for lang, term in zip(cols["lang"], cols["term"])]
            shard = [shard_of(_hash(k), shards) for k in keys]
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), batch.column("term"), pa.array(keys, pa.binary()), pa.array(shard, pa.int32())],
                names=["lang", "term", "key", "shard"],
            )

    return run


def _built(frame):
    import pandas as pd

    keys = list(frame["key"])
    pilots, by_slot = build_shard(keys)
    where = {k: i for i, k in enumerate(keys)}
    order = [where[k] for k in by_slot]
    return pd.DataFrame({
        "shard": [int(frame["shard"].iloc[0])],
        "pilots": [pilots.tobytes()],
        "keys": [by_slot],
        "terms": [[frame["term"].iloc[i] for i in order]],
    })


def normalised(docs: DataFrame) -> DataFrame:
    """lang, source and text, nulls read as ''."""
    return docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")))


def kept_terms(docs: DataFrame) -> DataFrame:
    """(lang, term) of the terms in at least ``LEAST_DOCS`` documents of their lang: pass 1."""
    ship(docs.sparkSession)
    terms = docs.select("lang", "text").mapInArrow(_document_counts, "lang string, term string, count long")
    return terms.groupBy("lang", "term").agg(F.sum("count").alias("count")).where(F.col("count") >= LEAST_DOCS).select("lang", "term")


def perfect_hashes(kept: DataFrame) -> tuple[int, DataFrame]:
    """The number of shards and one row per shard: shard, pilots (int64 bytes), keys in slot order."""
    spark = kept.sparkSession
    ship(spark)
    total = kept.count()
    shards = max(1, -(-total // SHARD_KEYS))
    keyed = kept.mapInArrow(_with_shard(shards), "lang string, term string, key binary, shard int")
    built = keyed.groupBy("shard").applyInPandas(_built, "shard int, pilots binary, keys array<binary>, terms array<string>")
    return shards, built


def recounted(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, source, slot, count) over all documents, and (slot, lang, term): pass 2 through the broadcast perfect hashes."""
    spark = docs.sparkSession
    shards, built = perfect_hashes(kept)
    built = saved(built, "divergence-hashes")
    named = built.select("shard", F.posexplode("terms").alias("place", "term")).select(
        (F.col("shard").cast("long") * F.lit(1 << 32) + F.col("place")).alias("slot"), "term"
    )
    sizes = built.select("shard", (F.length("pilots") + F.aggregate("keys", F.lit(0), lambda acc, k: acc + F.length(k) + 48)).alias("bytes"))
    rounds: list[list[int]] = [[]]
    filled = 0
    for row in sizes.orderBy("shard").toLocalIterator():
        if rounds[-1] and filled + row["bytes"] > BROADCAST_BYTES:
            rounds.append([])
            filled = 0
        rounds[-1].append(row["shard"])
        filled += row["bytes"]
    schema = "lang string, source string, slot long, count long"
    counts = None
    for shard_ids in rounds:
        if not shard_ids:
            continue
        tables = {
            r["shard"]: (np.frombuffer(r["pilots"], np.int64).copy(), [bytes(k) for k in r["keys"]])
            for r in built.where(F.col("shard").isin(shard_ids)).toLocalIterator()
        }
        lookup = spark.sparkContext.broadcast(Lookup(shards, tables))
        part = docs.select("lang", "source", "text").mapInArrow(_recount(lookup), schema)
        part = part.groupBy("lang", "source", "slot").agg(F.sum("count").alias("count"))
        counts = part if counts is None else counts.unionByName(part)
    if counts is None:
        counts = spark.createDataFrame([], schema)
    return counts, named


def _p(count: str, n: str, v: str):
    """1 + floor(SCALE (count + 2) / (n + 2 v)) in exact integers; null where the lang keeps no term."""
    return F.expr(
        f"CASE WHEN {v} > 0 THEN 1 + (CAST({count} + 2 AS DECIMAL(20,0)) * {SCALE}) div CAST({n} + 2 * {v} AS DECIMAL(20,0)) END"
    )


def _f(p: str, q: str):
    """floor((p - q)² / (p + q)); p and q are at most SCALE + 1, so the square fits a long."""
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def _pair_sums(known):
    import pandas as pd

    def run(frame):
        names, p0 = known.value[frame["lang"].iloc[0]]
        where = {name: i for i, name in enumerate(names)}
        slots, column = np.unique(frame["slot"].to_numpy(), return_inverse=True)
        p = np.repeat(p0[:, None], len(slots), axis=1)
        p[frame["source"].map(where).to_numpy(), column] = frame["p"].to_numpy()
        sources, items, values = [], [], []
        for i, name in enumerate(names):
            d = p[i] - p
            values.append(((d * d) // (p[i] + p)).sum(axis=1))
            sources.extend([name] * len(names))
            items.extend(names)
        return pd.DataFrame({"lang": frame["lang"].iloc[0], "source": sources, "item": items, "value": np.concatenate(values)})

    return run


def pair_sums(entries: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value): f summed over all kept terms for every two sources of a lang (and a source with itself).

    Each (lang, shard) of entries is one task; the sources of every lang and their p0 are broadcast after their size is
    measured.  Beyond ``BROADCAST_BYTES`` the (lang, shard) tasks get the sources of their lang by a join instead.
    """
    spark = entries.sparkSession
    size = groups.where(F.col("v") > 0).agg(F.sum(F.length("lang") + F.length("source") + 64).alias("b")).first()["b"] or 0
    if size > BROADCAST_BYTES:
        raise NotImplementedError("more sources than one broadcast holds")
    known: dict[str, tuple[list[str], np.ndarray]] = {}
    for r in groups.where(F.col("v") > 0).orderBy("lang", "source").toLocalIterator():
        names, values = known.setdefault(r["lang"], ([], []))
        names.append(r["source"])
        values.append(r["p0"])
    known = {k: (names, np.array(values, np.int64)) for k, (names, values) in known.items()}
    shared = spark.sparkContext.broadcast(known)
    keyed = entries.select("lang", "source", "slot", "p", F.shiftright("slot", 32).alias("shard"))
    partial = keyed.groupBy("lang", "shard").applyInPandas(_pair_sums(shared), "lang string, source string, item string, value long")
    return partial.where(F.col("source") != F.col("item")).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def divergences(docs: DataFrame) -> DataFrame:
    """Rows (lang, source, part, item, value, rank) as the module's docstring states."""
    base = normalised(docs)
    kept = kept_terms(base)
    kept = saved(kept, "divergence-kept")
    counts, named = recounted(base, kept)
    counts = saved(counts, "divergence-counts")

    groups = base.select("lang", "source").distinct()
    v = groups.select("lang").distinct().join(kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v")), "lang", "left").select(
        "lang", F.coalesce("v", F.lit(0)).cast("long").alias("v")
    )
    n = counts.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    groups = groups.join(n, ["lang", "source"], "left").join(v, "lang").select(
        "lang", "source", "v", F.coalesce("n", F.lit(0)).cast("long").alias("n")
    )
    groups = groups.withColumn("p0", _p("0", "n", "v"))
    entries = counts.join(groups, ["lang", "source"]).select("lang", "source", "slot", "count", _p("count", "n", "v").alias("p"))

    # Pairs: every kept term is counted in some group of its lang, so the terms of a (lang, shard) with all the lang's
    # sources form a dense matrix of p (p0 where a source has none of the term); a task sums f over it for every pair.
    a, b = groups.alias("a"), groups.alias("b")
    pairs = a.join(b, (F.col("a.lang") == F.col("b.lang")) & (F.col("a.source") != F.col("b.source"))).select(
        F.col("a.lang").alias("lang"), F.col("a.source").alias("source"), F.col("b.source").alias("item")
    )
    sums = pair_sums(entries, groups)
    pair_part = pairs.join(sums, ["lang", "source", "item"], "left").select(
        "lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).cast("long").alias("value")
    )

    # Terms: a group's p against its lang's.
    by_lang = counts.groupBy("lang", "slot").agg(F.sum("count").alias("count"))
    lang_n = by_lang.groupBy("lang").agg(F.sum("count").alias("n_lang"))
    q = by_lang.join(lang_n, "lang").join(v, "lang").select("lang", "slot", _p("count", "n_lang", "v").alias("q"))
    term_part = (
        entries.join(q, ["lang", "slot"])
        .where(F.col("p") > F.col("q"))
        .join(named.select("slot", "term"), "slot")
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _f("p", "q").alias("value"))
    )
    order = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), F.col("item").cast("binary").asc())
    ranked = pair_part.unionByName(term_part).withColumn("rank", F.row_number().over(order).cast("int"))
    return ranked.where((F.col("part") == "pair") | (F.col("rank") <= TOP_TERMS))


#: The same rows in DuckDB: the full (group, kept term) grid, counted by brute force.
SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
occ AS (SELECT rid, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term FROM (SELECT DISTINCT rid, lang, term FROM occ) GROUP BY lang, term HAVING count(*) >= 10),
groups AS (SELECT DISTINCT lang, source FROM d),
vl AS (SELECT l.lang, count(k.term) AS v FROM (SELECT DISTINCT lang FROM d) l LEFT JOIN kept k USING (lang) GROUP BY l.lang),
gc AS (SELECT o.lang, o.source, o.term, count(*) AS c FROM occ o JOIN kept k USING (lang, term) GROUP BY ALL),
grid AS (SELECT g.lang, g.source, k.term, coalesce(gc.c, 0) AS c
         FROM groups g JOIN kept k USING (lang) LEFT JOIN gc USING (lang, source, term)),
gn AS (SELECT g.lang, g.source, coalesce(sum(grid.c), 0) AS n FROM groups g LEFT JOIN grid USING (lang, source) GROUP BY ALL),
gp AS (SELECT grid.lang, grid.source, grid.term, grid.c,
              1 + (1000000000::HUGEINT * (grid.c + 2)) // (gn.n + 2 * vl.v) AS p
       FROM grid JOIN gn USING (lang, source) JOIN vl USING (lang)),
lc AS (SELECT lang, term, sum(c) AS c FROM grid GROUP BY ALL),
ln AS (SELECT lang, sum(c) AS n FROM lc GROUP BY lang),
lp AS (SELECT lc.lang, lc.term, 1 + (1000000000::HUGEINT * (lc.c + 2)) // (ln.n + 2 * vl.v) AS q
       FROM lc JOIN ln USING (lang) JOIN vl USING (lang)),
pair AS (SELECT g.lang, g.source, 'pair' AS part, o.source AS item,
                coalesce(sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)), 0) AS value
         FROM groups g JOIN groups o ON g.lang = o.lang AND g.source <> o.source
         LEFT JOIN gp a ON a.lang = g.lang AND a.source = g.source
         LEFT JOIN gp b ON b.lang = o.lang AND b.source = o.source AND b.term = a.term
         GROUP BY ALL),
term AS (SELECT a.lang, a.source, 'term' AS part, a.term AS item, (a.p - l.q) * (a.p - l.q) // (a.p + l.q) AS value
         FROM gp a JOIN lp l USING (lang, term) WHERE a.c > 0 AND a.p > l.q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item ASC) AS rank
           FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 10
"""
