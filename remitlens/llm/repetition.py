"""Quality rules from repetition: the share of a text's characters inside repeated word n-grams and repeated lines.

Each text is read as bytes; one prefix pass gives a rolling hash of any word, a second one of any window of words.  For each
window length the windows of a text that occur twice or more are found by sorting their 64-bit hashes, and the characters
of the words they cover are counted once.  Repeated lines are found in the same way.  A task works on slices of about a
megabyte; nothing is shuffled and nothing depends on other documents.

Defined results: null, empty and blank texts have zero words and fail the base rule; repeated rows give repeated results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from remitlens.llm.support import Hasher, beside_text, mix, ship, slices, text_bytes, word_spans

SYMBOLS = b"#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED = 50  # per cent of words in repeated three-word windows
#: Windows of so many words, and the largest share of characters inside repeated ones.
LIMITS = {5: 0.35, 7: 0.30, 10: 0.20}
#: The largest share of characters in lines that repeat an earlier line, and of repeated lines.
LINE_CHARS = 0.30
#: The most symbols for each word.
SYMBOL_RATE = 0.30

_BASE = 0xA24BAED4963EE407
_BACK = pow(_BASE, -1, 1 << 64)


def repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key whether it occurs twice or more, and whether it is a repetition of an earlier one."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    any_, later = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    later[order[1:]] = same
    any_[order[1:]] = same
    any_[order[:-1]] |= same
    return any_, later


class Windows:
    """Rolling hashes over the words of many texts."""

    def __init__(self, words: np.ndarray, doc: np.ndarray):
        n = len(words)
        up = np.full(n + 1, _BASE, np.uint64)
        down = np.full(n + 1, _BACK, np.uint64)
        up[0] = down[0] = 1
        self.down = np.multiply.accumulate(down)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(words * np.multiply.accumulate(up)[:n], out=self.sums[1:])
        self.doc = doc

    def covered(self, n: int) -> np.ndarray:
        """Which words stand in an ``n``-word window that occurs twice or more in their text."""
        words = len(self.doc)
        out = np.zeros(words, bool)
        if words < n:
            return out
        first = np.flatnonzero(self.doc[: words - n + 1] == self.doc[n - 1 :])
        keys = mix((self.sums[first + n] - self.sums[first]) * self.down[first]) + mix(self.doc[first].astype(np.uint64) + np.uint64(1))
        change = np.zeros(words + 1, np.int64)
        hit = first[repeated(keys)[0]]
        np.add.at(change, hit, 1)
        np.add.at(change, hit + n, -1)
        return np.cumsum(change[:-1]) > 0


def measure(texts: pa.Array, lengths) -> dict[str, np.ndarray]:
    """The counts of each text of a slice."""
    docs = len(texts)
    data, starts = text_bytes(texts)
    hasher = Hasher(data)
    lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # code points before each byte
    first, end = word_spans(data)
    doc = np.searchsorted(starts, first, "right") - 1
    chars = lead[end] - lead[first]
    per_doc = lambda values: np.bincount(doc, values, docs).astype(np.int64)
    out = {"n_words": np.bincount(doc, minlength=docs), "word_chars": per_doc(chars)}
    is_symbol = np.zeros(256, bool)
    is_symbol[list(SYMBOLS)] = True
    at = np.flatnonzero(is_symbol[data])
    out["n_symbols"] = np.bincount(np.searchsorted(starts, at, "right") - 1, minlength=docs)

    feed = np.flatnonzero(data == 10)
    line_first = np.concatenate([[0], feed[:-1] + 1])
    words_before = np.searchsorted(first, np.append(line_first, len(data)))
    full = words_before[1:] > words_before[:-1]
    line_first, line_end = line_first[full], feed[full]
    line_doc = np.searchsorted(starts, line_first, "right") - 1
    later = repeated(hasher.spans(line_first, line_end) + mix(line_doc.astype(np.uint64) + np.uint64(1)))[1]
    out["n_lines"] = np.bincount(line_doc, minlength=docs)
    out["n_dup_lines"] = np.bincount(line_doc[later], minlength=docs)
    upto = np.concatenate([[0], np.cumsum(chars)])
    lo, hi = words_before[:-1][full], words_before[1:][full]
    out["dup_line_chars"] = np.bincount(line_doc[later], (upto[hi] - upto[lo])[later], docs).astype(np.int64)

    windows = Windows(hasher.spans(first, end), doc)
    out["n_repeat_words"] = per_doc(windows.covered(3))
    for n in lengths:
        out[f"dup_{n}gram_chars"] = per_doc(chars * windows.covered(n))
    return out


def repetition(docs: DataFrame, lengths=tuple(LIMITS), carry=("doc_id",), prefix: str = "") -> DataFrame:
    """Counts per row of ``docs`` (text): words, symbols, repeated lines, characters in repeated windows.

    The columns ``carry`` go along; ``prefix`` keeps the counts' names apart from theirs.
    """
    ship(docs.sparkSession)
    carry = [*carry]
    sent, at, begin = beside_text(docs, carry)
    names = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "dup_line_chars", "n_repeat_words", *(f"dup_{n}gram_chars" for n in lengths)]

    def run(batches):
        for batch in batches:
            for first, end in slices(batch.column(at)):
                part = batch.slice(first, end - first)
                found = measure(part.column(at), lengths)
                yield pa.RecordBatch.from_arrays([*part.columns[begin:], *(pa.array(found[k], pa.int64()) for k in names)], [*carry, *(prefix + k for k in names)])

    schema = StructType([*docs.select(*carry).schema.fields, *(StructField(prefix + k, LongType()) for k in names)])
    return sent.mapInArrow(run, schema)


def judged(docs: DataFrame, limits: dict[int, float] | None = None, line_chars: float = LINE_CHARS, symbol_rate: float = SYMBOL_RATE, carry=("doc_id",), prefix: str = "") -> DataFrame:
    """The counts of ``repetition`` with ``base_failed`` and ``kept``."""
    limits = LIMITS if limits is None else limits
    c = lambda name: F.col(prefix + name)
    base = (c("n_words") < LEAST_WORDS) | (100 * c("n_repeat_words") > MOST_REPEATED * c("n_words"))
    good = (c("dup_line_chars") <= line_chars * c("word_chars")) & (c("n_symbols") <= symbol_rate * c("n_words"))
    for n, limit in limits.items():
        good &= c(f"dup_{n}gram_chars") <= limit * c("word_chars")
    counts = repetition(docs, tuple(limits), carry, prefix)
    return counts.withColumn(prefix + "base_failed", base).withColumn(prefix + "kept", ~base & good)


def of_good_quality(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with the columns they have."""
    return judged(docs, carry=docs.columns, prefix="_q_").where("_q_kept").select(*docs.columns)
