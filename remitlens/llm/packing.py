"""Packing token streams into fixed windows by order-preserving dynamic programming.

The documents of a partition follow each other in the order read.  A window may end at a document's end, after a sentence, or,
where no such place is near, at a hard cut.  The cost of a packing is the padding of its windows plus a penalty for each
window end inside a document (small after a sentence, larger at a hard cut) and a little for each window.  ``best[i] = penalty[i] + min over j of best[j] +
padding(i - j)``; padding falls with the distance, so the minimum over the reachable ``j`` is a sliding-window minimum of
``best[j] + position[j]``, kept in a monotone queue.  A window whose length is a power of two is not padded, which adds one
transition for each power.

A task holds about ``BLOCK`` tokens at a time; all windows of a block but the last are final, and the last one's tokens begin
the next block.  Only the last window of a partition is closed early.  Nothing is shuffled.

Defined results: a null or empty text is the end id alone; repeated rows are packed once each; a document longer than a window
goes on in the next ones; an empty table gives no rows.  Sequence ids are the partition's number times 2**33 plus a counter, so a
task that runs again gives the same ids.
"""

from __future__ import annotations

import zlib
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from remitlens.llm.bpe import encoded_slices, loaded
from remitlens.llm.support import ship

WINDOW = 2048
#: Tokens of a block.
BLOCK = 1 << 20
#: Penalties in tokens of padding for a window that ends after a sentence inside a document, or anywhere else.
AFTER_SENTENCE = 4
HARD_CUT = 32
#: What a window costs by itself, so that many short unpadded windows do not replace a long one.
PER_WINDOW = 8
#: Hard cuts are offered at this distance where a document has no sentence end.
HARD_STEP = 64
SENTENCE_ENDS = ".!?"

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def candidates(ends: np.ndarray, sentences: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Where windows may end, and the penalty of each place.

    ``ends`` are the document ends and ``sentences`` the positions after sentences, both ascending.
    """
    stops = np.union1d(ends, sentences)
    before = np.concatenate([[0], stops[:-1]])
    gaps = (stops - before - 1) // step
    hard = np.repeat(before, gaps) + step * (np.arange(gaps.sum()) - np.repeat(np.cumsum(gaps) - gaps, gaps) + 1)
    places = np.sort(np.concatenate([stops, hard]))
    penalty = np.full(len(places), HARD_CUT, np.int64)
    penalty[np.searchsorted(places, sentences)] = AFTER_SENTENCE
    penalty[np.searchsorted(places, ends)] = 0
    return places, penalty


def cut(places: np.ndarray, penalty: np.ndarray, window: int) -> list[int]:
    """The window ends of the cheapest packing of ``[0, places[-1])``; consecutive places are at most ``window`` apart."""
    position = np.concatenate([[0], places])
    n = len(position)
    exact: list[list[int]] = [[] for _ in range(n)]
    size = 1
    while size <= window:
        at = np.searchsorted(position, position - size)
        hit = np.flatnonzero((position >= size) & (position[np.minimum(at, n - 1)] == position - size))
        for i, j in zip(hit.tolist(), at[hit].tolist(), strict=True):
            exact[i].append(j)
        size *= 2
    p, pen = position.tolist(), [0, *penalty.tolist()]
    best, came = [0] * n, [0] * n
    queue: deque[tuple[int, int]] = deque([(0, 0)])  # (best + position, index), values ascending
    for i in range(1, n):
        at = p[i]
        while p[queue[0][1]] < at - window:
            queue.popleft()
        value, j = queue[0]
        value += window - at
        for k in exact[i]:
            if best[k] < value:
                value, j = best[k], k
        value += pen[i] + PER_WINDOW
        best[i], came[i] = value, j
        value += at
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, i))
    out, i = [], n - 1
    while i:
        out.append(p[i])
        i = came[i]
    return out[::-1]


class Packer:
    """Packs the documents handed to it, block by block, and gives the pieces of finished windows."""

    def __init__(self, window: int, step: int, first_sequence: int):
        self.window, self.step, self.sequence = window, min(step, window), first_sequence
        self.ids: list[np.ndarray] = []
        self.docs: list[tuple] = []  # doc_id, tokens of the document, its tokens that are already packed
        self.held = 0

    def add(self, doc_id, ids: np.ndarray) -> None:
        self.ids.append(ids)
        self.docs.append((doc_id, len(ids), 0))
        self.held += len(ids)

    def pack(self, sentence_end: np.ndarray, last: bool) -> list[tuple]:
        """Pieces of all windows of the held documents, but for the last one unless ``last``."""
        if not self.held:
            return []
        stream = np.concatenate(self.ids)
        doc_ends = np.cumsum([n - done for _, n, done in self.docs])
        sentences = np.flatnonzero(sentence_end[stream]) + 1
        ends = cut(*candidates(doc_ends, sentences[sentences < len(stream)], self.step), self.window)
        if not last:
            ends = ends[:-1]
        packed = ends[-1] if ends else 0
        borders = np.union1d(np.array(ends, np.int64), doc_ends[doc_ends < packed])
        begins = np.concatenate([[0], borders[:-1]]).astype(np.int64)[: len(borders)]
        doc = np.searchsorted(doc_ends, begins, "right")
        doc_begin = np.concatenate([[0], doc_ends[:-1]])
        win = np.searchsorted(np.array(ends, np.int64), begins, "right")
        win_begin = np.concatenate([[0], np.array(ends, np.int64)])
        data = memoryview(stream.astype("<u4")).cast("B")
        out = []
        for b, e, d, w in zip(begins.tolist(), borders.tolist(), doc.tolist(), win.tolist(), strict=True):
            doc_id, n, done = self.docs[d]
            out.append((doc_id, b - int(doc_begin[d]) + done, e - b, zlib.crc32(data[4 * b : 4 * e]), n, self.sequence + w, b - int(win_begin[w])))
        self.sequence += len(ends)
        first = int(np.searchsorted(doc_ends, packed, "right"))
        if first < len(self.docs):
            doc_id, n, done = self.docs[first]
            self.docs = [(doc_id, n, done + max(0, packed - int(doc_begin[first]))), *self.docs[first + 1 :]]
        else:
            self.docs = []
        self.ids = [stream[packed:]] if self.docs else []
        self.held = len(stream) - packed
        return out


def sentence_ends(names: list[str]) -> np.ndarray:
    """Which tokens end a sentence: punctuation alone, at a word's end, with a full stop, question or exclamation mark."""
    bare = [x.removesuffix("</w>") for x in names]
    return np.array([x.endswith("</w>") and any(c in SENTENCE_ENDS for c in b) and not any(c.isalnum() for c in b) for x, b in zip(names, bare, strict=True)])


def pack(docs: DataFrame, path: str, end_id: int = 1, window: int = WINDOW, block: int = BLOCK, step: int = HARD_STEP) -> DataFrame:
    """Pieces of ``docs`` (doc_id, text) in windows of ``window`` tokens; see the module's text."""
    ship(docs.sparkSession)

    def run(batches):
        bpe = loaded(path)
        stops = sentence_ends(bpe.names)
        packer = Packer(window, step, TaskContext.get().partitionId() << 33)
        end = np.array([end_id], bpe.kind)
        names = [f.split(" ")[0] for f in PIECES.split(", ")]

        def rows(pieces):
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*pieces) if pieces else [()] * len(names))], names)

        for batch, first, all_ids in encoded_slices(batches, path):
            for doc_id, ids in zip(batch.column(0).slice(first, len(all_ids)).to_pylist(), all_ids, strict=True):
                packer.add(doc_id, np.concatenate([ids, end]))
                if packer.held >= block:
                    yield rows(packer.pack(stops, False))
        yield rows(packer.pack(stops, True))

    return docs.select("doc_id", "text").mapInArrow(run, PIECES)
