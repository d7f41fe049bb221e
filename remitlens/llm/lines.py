"""Line deduplication across documents, on DataFrame functions only.

Each line has a key (stripped, A-Z lower-cased) and the key a 128-bit hash.  The hashes are range-partitioned with the document as
second key and sorted by hash, document (largest first) and position, so a key that a third of all documents share simply spans
many partitions.  A window streams over each partition: a row repeats a key if the row before has the same hash, and the key is in
three documents if the row before that or the row after has it too.  Only the rows at the ends of the partitions need a
neighbour from the next one; those few (four for each partition) are streamed once more among themselves.

The result for a document is a run-length bitmap: the runs of its lines that go.  Texts are not shuffled to find it, only to apply it.

Defined results: a null or empty text is one empty line and keeps it.  A document is a doc_id: rows that repeat one count once, and
each row loses its own lines.  Rows with a null doc_id take no part and keep all lines.  Keys under ``least_chars`` are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from remitlens.llm.support import BLANKS, saved

LEAST_CHARS = 20
#: The streaming rule looks at the two rows before and the one after, which is what three documents need.
LEAST_DOCS = 3
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lines_of(text: Column) -> Column:
    """The lines of a text; null is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def text_hash(text: Column) -> Column:
    """Tells rows of one doc_id with different texts apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def line_keys(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """One row per line that can be dropped: hash (h1, h2), doc_id, text hash and position."""
    lines = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select(
        "doc_id", text_hash(F.col("text")).alias("text_hash"), F.posexplode(lines_of(F.col("text"))).alias("pos", "line")
    )
    bare = lines.select("doc_id", "text_hash", "pos", F.btrim("line", F.lit(BLANKS)).alias("line")).where(F.char_length("line") >= least_chars)
    key = F.translate("line", UPPER, LOWER)
    return bare.select(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("second"), key).alias("h2"), "doc_id", "text_hash", "pos")


def _tiles(keys: DataFrame) -> DataFrame:
    """The keys range-partitioned and sorted: one row per key and document, with the number of its partition."""
    parts = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = keys.repartitionByRange(parts, F.col("h1"), F.col("h2"), F.col("doc_id").desc())
    # Rows of one key and document are in one partition, so this needs no further exchange.
    grouped = ordered.groupBy("h1", "h2", "doc_id").agg(F.collect_list(F.struct("text_hash", "pos")).alias("places"))
    return saved(grouped.withColumn("tile", F.spark_partition_id()).sortWithinPartitions("h1", "h2", F.col("doc_id").desc()), "line-keys")


def _same(how, n: int, window) -> Column:
    return F.coalesce((how("h1", n).over(window) == F.col("h1")) & (how("h2", n).over(window) == F.col("h2")), F.lit(False))


def dropped_lines(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """doc_id, text_hash and pos of every line that goes."""
    tiles = _tiles(line_keys(docs, least_chars))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("h1"), F.col("h2"), F.col("doc_id").desc()]
    within = Window.partitionBy("tile").orderBy(*order)
    among = Window.orderBy("tile", *order)
    marked = tiles.repartitionByRange(parts, "tile").select(
        "*",
        _same(F.lag, 1, within).alias("before"),
        _same(F.lag, 2, within).alias("second_before"),
        _same(F.lead, 1, within).alias("after"),
        F.lag("h1", 2).over(within).isNull().alias("opens"),
        F.lead("h1", 1).over(within).isNull().alias("closes"),
        F.lead("h1", 2).over(within).isNull().alias("near_end"),
    )
    goes = F.col("before") & (F.col("second_before") | F.col("after"))
    inner = marked.where(~F.col("opens") & ~F.col("closes")).where(goes).select("doc_id", "places")
    ends = marked.where(F.col("opens") | F.col("near_end")).select("tile", "h1", "h2", "doc_id", "places", "before", "second_before", "after", "opens", "closes")
    joined = ends.select(
        "doc_id",
        "places",
        F.when(F.col("opens"), _same(F.lag, 1, among)).otherwise(F.col("before")).alias("before"),
        F.when(F.col("opens"), _same(F.lag, 2, among)).otherwise(F.col("second_before")).alias("second_before"),
        F.when(F.col("closes"), _same(F.lead, 1, among)).otherwise(F.col("after")).alias("after"),
        (F.col("opens") | F.col("closes")).alias("edge"),
    )
    outer = joined.where(F.col("edge") & goes).select("doc_id", "places")
    return inner.unionByName(outer).select("doc_id", F.explode("places").alias("place")).select("doc_id", "place.text_hash", "place.pos")


def drop_bitmaps(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """Per document with lines to drop: doc_id, text_hash, and ``runs``, the sorted (start, length) of its dropped lines."""
    owner = ["doc_id", "text_hash"]
    # Rows repeated as a whole list their positions several times.
    places = dropped_lines(docs, least_chars).groupBy(*owner, "pos").agg(F.lit(1).alias("one"))
    islands = places.withColumn("island", F.col("pos") - F.row_number().over(Window.partitionBy(*owner).orderBy("pos")))
    runs = islands.groupBy(*owner, "island").agg(F.min("pos").alias("start"), F.count("*").cast("int").alias("length"))
    return runs.groupBy(*owner).agg(F.sort_array(F.collect_list(F.struct("start", "length"))).alias("runs"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``docs`` with n_lines (before), n_dropped, and the kept lines joined as ``kept_text``.

    Columns of ``docs`` with one of these names are replaced.
    """
    docs = docs.drop("n_lines", "n_dropped", "kept_text", "_m_doc", "_m_hash", "_m_runs", "_m_lines")
    maps = bitmaps.select(F.col("doc_id").alias("_m_doc"), F.col("text_hash").alias("_m_hash"), F.col("runs").alias("_m_runs"))
    found = docs.join(maps, (docs["doc_id"] == F.col("_m_doc")) & (text_hash(docs["text"]) == F.col("_m_hash")), "left")
    found = found.withColumn("_m_lines", lines_of(docs["text"]))
    runs, lines = F.col("_m_runs"), F.col("_m_lines")
    # Between the dropped runs lie the kept ones: from the end of a run to the start of the next.
    kept = F.transform(
        F.sequence(F.lit(0), F.size(runs)),
        lambda k: F.slice(
            lines,
            F.when(k == 0, 1).otherwise(F.get(runs, k - 1)["start"] + F.get(runs, k - 1)["length"] + 1),
            F.coalesce(F.get(runs, k)["start"], F.size(lines)) - F.when(k == 0, 0).otherwise(F.get(runs, k - 1)["start"] + F.get(runs, k - 1)["length"]),
        ),
    )
    dropped = F.aggregate(runs, F.lit(0).cast("long"), lambda a, r: a + r["length"])
    return found.select(
        *(docs[c] for c in docs.columns),
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(dropped, F.lit(0).cast("long")).alias("n_dropped"),
        F.when(runs.isNull(), F.coalesce(docs["text"], F.lit(""))).otherwise(F.array_join(F.flatten(kept), "\n")).alias("kept_text"),
    )


def deduplicated(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """``docs`` (doc_id, text) with n_lines, n_dropped and kept_text."""
    return apply_bitmaps(docs, drop_bitmaps(docs, least_chars))


#: DuckDB's statement of the contract.
SQL = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), shared AS (
  SELECT key, max(doc_id) AS holder FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), judged AS (
  SELECT k.*, s.holder IS NOT NULL AND s.holder <> k.doc_id AS goes FROM keyed k LEFT JOIN shared s ON s.key = k.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE goes) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT goes), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
