"""Language identification with hyperdimensional profiles.

Every letter has a fixed random vector of +1 and -1.  A letter n-gram is the product of its letters' vectors, each rotated by its
place, so order counts; a word's start and end are letters of their own.  A text is the sum of its n-grams, and a language the sum
of its texts' vectors at equal weight.  A text gets the language whose vector has the largest cosine with its own.

Learning takes one pass over all labelled rows: each task sums its texts as integers, the sums meet by language and dimension,
and only languages x dimensions numbers come to the driver.  Prediction is one pass without a shuffle.

Defined results: null texts and texts without a letter are ``und`` with score 0; so is every text if nothing was learned.  Of equal
cosines the first language in order of name wins.  Null languages are not learned from.  A null doc_id counts as the text ''.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from remitlens.llm.bpe import LETTER, point_classes
from remitlens.llm.support import beside_text, ship, slices

DIMENSIONS = 1024
GRAM = 3
SEED = 11
EDGE = 0x20
#: N-gram vectors remembered by a worker at most.
REMEMBERED = 30_000
#: Fixed point of the summed vectors.
SCALE = 1 << 20
#: More labels than this are no languages.
MOST_LANGUAGES = 10_000
UNKNOWN = "und"


class Profiles:
    """Turns texts into vectors; n-gram vectors are made when first seen."""

    def __init__(self, dimensions: int, gram: int):
        self.dimensions, self.gram = dimensions, gram
        self.letter = point_classes() == LETTER
        self.letters: dict[int, np.ndarray] = {}
        self.rows: dict[int, int] = {}
        # One byte a dimension: 30,000 n-grams are 31 MB in each worker.
        self.vectors = np.zeros((1024, dimensions), np.int8)

    def _letter(self, point: int) -> np.ndarray:
        if point not in self.letters:
            bits = np.random.Generator(np.random.PCG64([SEED, point])).integers(0, 2, self.dimensions, dtype=np.int8)
            self.letters[point] = 2 * bits - 1
        return self.letters[point]

    def _rows(self, grams: np.ndarray) -> np.ndarray:
        """Rows of ``vectors`` for distinct n-grams (columns: code points)."""
        keys = [tuple(g) for g in grams.tolist()]
        if len(self.rows) + len(keys) > REMEMBERED:
            self.rows.clear()
        for key in keys:
            if key not in self.rows:
                at = self.rows[key] = len(self.rows)
                if at >= len(self.vectors):
                    self.vectors = np.concatenate([self.vectors, np.zeros_like(self.vectors)])
                v = np.ones(self.dimensions, np.int8)
                for place, point in enumerate(reversed(key)):
                    v = v * np.roll(self._letter(point), place)
                self.vectors[at] = v
        return np.array([self.rows[k] for k in keys], np.int64)

    def vectors_of(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """A vector for each text, and the number of its n-grams (0: no letter)."""
        out, counts = np.zeros((len(texts), self.dimensions), np.float32), np.zeros(len(texts), np.int64)
        lowered = [(t or "").lower() for t in texts]
        joined = "\n" + "\n".join(lowered) + "\n"
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        is_letter = self.letter[points]
        # One edge before and after each word.
        keep = is_letter | np.append(is_letter[1:], False) | np.append(False, is_letter[:-1])
        keep &= is_letter | ~(np.append(False, is_letter[:-1]) & np.append(False, ~is_letter[:-1]))
        at = np.flatnonzero(keep)
        symbol = np.where(is_letter[at], points[at], EDGE).astype(np.int64)
        text_start = np.cumsum([1, *(len(t) + 1 for t in lowered)])
        g = self.gram
        if len(at) < g:
            return out, counts
        windows = np.lib.stride_tricks.sliding_window_view(symbol, g)
        inner = (windows[:, 1:-1] != EDGE).all(1) & (windows != EDGE).any(1)
        windows, middle = windows[inner], at[1 : len(at) - g + 2][inner]
        if not len(windows):
            return out, counts
        owner = np.searchsorted(text_start, middle, "right") - 1
        code = windows[:, 0]
        for k in range(1, g):
            code = code * 0x1FFFFF + windows[:, k]
        _, sample, gram = np.unique(code, return_index=True, return_inverse=True)
        rows = self._rows(windows[sample])
        width = len(rows)
        cells, times = np.unique(owner * width + gram, return_counts=True)
        borders = np.searchsorted(cells, np.arange(len(texts) + 1) * width)
        times = times.astype(np.float32)
        for k in range(len(texts)):
            lo, hi = borders[k], borders[k + 1]
            if hi > lo:
                out[k] = times[lo:hi] @ self.vectors[rows[cells[lo:hi] - k * width]].astype(np.float32)
                counts[k] = times[lo:hi].sum()
        return out, counts


_profiles: dict[tuple, Profiles] = {}


def profiles(dimensions: int, gram: int) -> Profiles:
    """The vectors of a worker process."""
    key = (dimensions, gram)
    if key not in _profiles:
        _profiles[key] = Profiles(*key)
    return _profiles[key]


def unit(vectors: np.ndarray) -> np.ndarray:
    length = np.sqrt((vectors * vectors).sum(1, keepdims=True))
    return vectors / np.where(length > 0, length, 1)


def learn(labelled: DataFrame, dimensions: int = DIMENSIONS, gram: int = GRAM) -> dict[str, np.ndarray]:
    """Unit vectors of the languages in ``labelled`` (text, lang); all its rows with a language and a letter count alike."""
    ship(labelled.sparkSession)

    def sums(batches):
        made, total = profiles(dimensions, gram), {}
        for batch in batches:
            for first, end in slices(batch.column(0)):
                vectors, counts = made.vectors_of(batch.column(0).slice(first, end - first).to_pylist())
                whole = np.rint(unit(vectors) * SCALE).astype(np.int64)
                for row, lang in enumerate(batch.column(1).slice(first, end - first).to_pylist()):
                    if counts[row]:
                        total[lang] = total.get(lang, 0) + whole[row]
        for lang, v in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * dimensions, pa.string()), pa.array(range(dimensions), pa.int32()), pa.array(v)], ["lang", "place", "total"])

    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang").mapInArrow(sums, "lang string, place int, total long")
    found = rows.groupBy("lang", "place").agg(F.sum("total").alias("total")).limit(MOST_LANGUAGES * dimensions + 1).collect()
    if len(found) > MOST_LANGUAGES * dimensions:
        raise ValueError("too many different values of lang")
    out: dict[str, np.ndarray] = {}
    for r in found:
        out.setdefault(r.lang, np.zeros(dimensions))[r.place] = r.total
    return {k: unit(out[k][None])[0] for k in sorted(out)}


def predict(docs: DataFrame, learned: dict[str, np.ndarray], dimensions: int = DIMENSIONS, gram: int = GRAM, carry=("doc_id",), prefix: str = "") -> DataFrame:
    """Per row of ``docs`` (text): the language ``lang_pred`` and its cosine ``score``, between 0 and 1.

    The columns ``carry`` go along; ``prefix`` keeps the new names apart from theirs.
    """
    ship(docs.sparkSession)
    carry, names = [*carry], [*learned]
    sent, at, begin = beside_text(docs, carry)
    languages = np.array([learned[k] for k in names], np.float32).reshape(len(names), dimensions)

    def run(batches):
        made = profiles(dimensions, gram)
        for batch in batches:
            for first, end in slices(batch.column(at)):
                part = batch.slice(first, end - first)
                vectors, counts = made.vectors_of(part.column(at).to_pylist())
                if names:
                    cosines = unit(vectors) @ languages.T
                    best = cosines.argmax(1)
                    score = np.clip(cosines[np.arange(len(best)), best].astype(np.float64), 0, 1)
                    lang = [names[b] if n else UNKNOWN for b, n in zip(best.tolist(), counts.tolist(), strict=True)]
                    score[counts == 0] = 0
                else:
                    lang, score = [UNKNOWN] * len(counts), np.zeros(len(counts))
                yield pa.RecordBatch.from_arrays([*part.columns[begin:], pa.array(lang, pa.string()), pa.array(score)], [*carry, prefix + "lang_pred", prefix + "score"])

    schema = StructType([*docs.select(*carry).schema.fields, StructField(prefix + "lang_pred", StringType()), StructField(prefix + "score", DoubleType())])
    return sent.mapInArrow(run, schema)


def is_held_out(doc_id):
    """The third of the rows that nothing is learned from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3 == 1


def identify(docs: DataFrame) -> DataFrame:
    """Learn from the rows of ``docs`` (doc_id, text, lang) that are not held out, and predict all."""
    learned = learn(docs.where(~is_held_out(F.col("doc_id"))))
    found = predict(docs, learned)
    return found.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def in_known_language(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, lang) whose language is known, with the columns they have.

    A text without letters is rejected.  A weak cosine alone is no reason: short clean texts have it too.
    """
    learned = learn(docs.where(~is_held_out(F.col("doc_id"))))
    return predict(docs, learned, carry=docs.columns, prefix="_l_").where(F.col("_l_lang_pred") != UNKNOWN).select(*docs.columns)
