"""Byte-pair encoding by backtracking over longest matches, and decoding through an offset table.

A text is normalised and cut into words as the vocabulary file says.  An Aho-Corasick automaton over the reversed tokens
reads each word once from its end and gives the longest token that starts at every position.  The encoder takes that token,
keeps it if it is compatible with the token before, and otherwise goes to the next shorter token or back.  Two neighbours
are compatible if no merge across their border comes before the merges that build them; a sequence of compatible tokens is
the sequence that merging in rank order gives, and every prefix has only one, so a position that failed is never tried
again and the time is linear in the word.  The words of a slice take their steps together, as numpy arrays.

Defined results: a null text is empty; an empty or blank text has no ids.  Repeated rows give repeated results.
Chunks between blanks are remembered in a bounded table, which changes the time only.
"""

from __future__ import annotations

import hashlib
import json
import sys
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from remitlens.llm.support import ship, slices

END = 256  # after the last byte of a word
SUFFIX = "</w>"
#: Chunks remembered by a worker at most; beyond it the table is emptied.
REMEMBERED = 300_000
LONGEST_REMEMBERED = 32
#: Words of at most so many symbols take their steps as rows of one array; longer ones are encoded one at a time.
LONGEST_ROW = 48
#: Compatible and incompatible pairs remembered at most.
PAIRS = 2_000_000
#: Ids decoded at once, and bytes of text whose new words are encoded together: their chunks take ten times as much while they are strings.
DECODED_AT_ONCE = 1 << 16
TOGETHER = 2 << 20
#: What Python's str.split() takes for a blank and the vocabulary's pattern does not.
SEPARATORS = ("\x1c", "\x1d", "\x1e", "\x1f")
BLANK_POINTS = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
UNICODE_BLANK = regex.compile("[" + "".join(map(chr, BLANK_POINTS)) + "]+")
BLANK, LETTER, NUMBER, OTHER = range(4)
#: The endings that the vocabulary's pattern cuts off after an apostrophe.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def printable_bytes() -> list[str]:
    """The character that byte-level vocabularies show for each byte: itself if printable, else one from 256 up."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    names = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}
    return [names[b] for b in range(256)]


def point_classes() -> np.ndarray:
    """The class of every code point: blank, letter, number or other."""
    first = [unicodedata.category(chr(c))[0] for c in range(sys.maxunicode + 1)]
    classes = np.full(sys.maxunicode + 1, OTHER, np.uint8)
    classes[np.array([c == "L" for c in first])] = LETTER
    classes[np.array([c == "N" for c in first])] = NUMBER
    classes[BLANK_POINTS] = BLANK
    return classes


class KeyTable:
    """Open-addressing map of non-negative 64-bit keys to integers; many keys are looked up at once."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, room: int = 4):
        bits = max(10, int(np.ceil(np.log2(max(1, len(keys)) * room))))
        self.shift = np.uint64(64 - bits)
        self.mask = (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.values = np.full(1 << bits, -1, np.int32)
        self.count = 0
        self.add(np.asarray(keys, np.int64), np.asarray(values, np.int32))

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Add keys that are distinct and not yet in the table."""
        self.count += len(keys)
        slot = self._slot(keys)
        while len(keys):
            free = self.keys[slot] < 0
            self.keys[slot[free]] = keys[free]  # of several keys for one slot the last stays
            placed = free & (self.keys[slot] == keys)
            self.values[slot[placed]] = values[placed]
            keys, values, slot = keys[~placed], values[~placed], (slot[~placed] + 1) & self.mask

    def get(self, keys: np.ndarray) -> np.ndarray:
        """Values, -1 where a key is missing."""
        slot = self._slot(keys)
        found = self.keys[slot]
        out = np.where(found == keys, self.values[slot], -1)
        rest = np.flatnonzero((found != keys) & (found >= 0))
        while len(rest):
            slot[rest] = (slot[rest] + 1) & self.mask
            found = self.keys[slot[rest]]
            same = found == keys[rest]
            out[rest[same]] = self.values[slot[rest[same]]]
            rest = rest[~same & (found >= 0)]
        return out


class WordBpe:
    """Encoder and decoder for one vocabulary file whose words end in ``</w>``."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("end_of_word_suffix") != SUFFIX or spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] != PATTERN:
            raise ValueError(f"{path} is not a BPE vocabulary with word ends of the known pattern")
        vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"] if not t["normalized"]}
        size = 1 + max([*vocab.values(), *self.special.values()])
        self.kind = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")

        byte_of = {c: b for b, c in enumerate(printable_bytes())}
        symbols = {}
        for token, i in vocab.items():
            last = token.endswith(SUFFIX)
            symbols[i] = tuple(map(byte_of.__getitem__, token[: -len(SUFFIX)] if last else token)) + (END,) * last
        self._merges(vocab, model["merges"], size)
        self._automaton(symbols, size)
        self.pairs = KeyTable(np.zeros(0), np.zeros(0))
        self.classes = point_classes()
        self.known: dict[str, bytes] = {}

        names = [""] * size
        for token, i in [*vocab.items(), *self.special.items()]:
            names[i] = token
        self.names = names
        shown = [(x + " ").encode() for x in names]
        self.offsets = np.zeros(size + 1, np.int64)
        np.cumsum([len(x) for x in shown], out=self.offsets[1:])
        self.pool = np.frombuffer(b"".join(shown), np.uint8)

    def _merges(self, vocab: dict, merges: list, size: int) -> None:
        """The merge table, and for each token the symbols at its edges while it is built, with the merge that ends each."""
        keys, made, parts, before = [], [], {}, -1
        for left, right in (m if isinstance(m, list) else m.split(" ") for m in merges):
            a, b, ab = vocab[left], vocab[right], vocab[left + right]
            if ab <= before or ab <= max(a, b):
                raise ValueError("token ids must grow with the rank of their merge")
            before, parts[ab] = ab, (a, b)
            keys.append(a << 32 | b)
            made.append(ab)
        self.merged = KeyTable(np.array(keys), np.array(made))
        self.edges = []
        for side in (1, 0):
            rows = [[] for _ in range(size)]
            for token in vocab.values():
                ends, x = 1 << 30, token
                while True:
                    rows[token].append((x, ends))
                    if x not in parts:
                        break
                    ends, x = x, parts[x][side]
            edge = np.full((size, max(map(len, rows)), 2), -1, np.int64)
            for token, row in enumerate(rows):
                if row:
                    edge[token, : len(row)] = row
            self.edges.append(edge)

    def _automaton(self, symbols: dict[int, tuple], size: int) -> None:
        """Aho-Corasick over the reversed tokens; ``found`` is the longest token that ends the reading of a state."""
        step, whole, depth = {}, [-1], [0]
        for token, text in symbols.items():
            at = 0
            for s in reversed(text):
                key = at * 257 + s
                at = step.get(key, -1)
                if at < 0:
                    at = step[key] = len(whole)
                    whole.append(-1)
            whole[at] = token
        n = len(whole)
        parent, by = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for key, child in step.items():
            parent[child], by[child] = divmod(key, 257)
        self.step = KeyTable(np.fromiter(step.keys(), np.int64, len(step)), np.fromiter(step.values(), np.int64, len(step)))
        self.fail = np.zeros(n, np.int64)
        self.found = np.array(whole, np.int64)
        level = np.flatnonzero(parent == 0)[1:] if n > 1 else np.zeros(0, np.int64)
        children_of = np.argsort(parent, kind="stable")
        sorted_parent = parent[children_of]
        while len(level):
            lo, hi = np.searchsorted(sorted_parent, level, "left"), np.searchsorted(sorted_parent, level, "right")
            counts = hi - lo
            below = children_of[np.repeat(lo - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())]
            if len(below):
                self.fail[below] = self._next(self.fail[parent[below]], by[below])
                lacking = below[self.found[below] < 0]
                self.found[lacking] = self.found[self.fail[lacking]]
            level = below
        self.length = np.zeros(size, np.int64)
        self.shorter = np.full(size, -1, np.int64)  # the longest token that is a proper prefix
        id_of = {text: token for token, text in symbols.items()}
        for text, token in id_of.items():
            self.length[token] = len(text)
            self.shorter[token] = next((id_of[text[:k]] for k in range(len(text) - 1, 0, -1) if text[:k] in id_of), -1)

    def _next(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """The automaton's states after reading one more symbol each."""
        out = self.step.get(state * 257 + symbol)
        rest = np.flatnonzero((out < 0) & (state > 0))
        at = state[rest]
        while len(rest):
            at = self.fail[at]
            to = self.step.get(at * 257 + symbol[rest])
            out[rest] = to
            more = (to < 0) & (at > 0)
            rest, at = rest[more], at[more]
        return np.maximum(out, 0).astype(np.int64)

    def _fits(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether each ``a`` before its ``b`` stays as it is: no merge across comes first.  Of equal merges the left is first."""
        ok = np.ones(len(a), bool)
        right, left = self.edges[0][a], self.edges[1][b]
        for i in range(right.shape[1]):
            for j in range(left.shape[1]):
                at = np.flatnonzero(ok & (right[:, i, 0] >= 0) & (left[:, j, 0] >= 0))
                if len(at):
                    m = self.merged.get(right[at, i, 0] << 32 | left[at, j, 0])
                    ok[at[(m >= 0) & (m < right[at, i, 1]) & (m <= left[at, j, 1])]] = False
        return ok

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The pair-compatibility table's entries; pairs that are not in it yet are worked out and added."""
        keys = a << 32 | b
        found = self.pairs.get(keys)
        if len(new := np.unique(keys[found < 0])):
            fits = self._fits(new >> 32, new & 0xFFFFFFFF).astype(np.int32)
            if self.pairs.count + len(new) > PAIRS:
                self.pairs = KeyTable(new, fits)
            elif (self.pairs.count + len(new)) * 2 > self.pairs.mask:
                old = self.pairs.keys >= 0
                self.pairs = KeyTable(np.concatenate([self.pairs.keys[old], new]), np.concatenate([self.pairs.values[old], fits]))
            else:
                self.pairs.add(new, fits)
            at = found < 0
            found[at] = fits[np.searchsorted(new, keys[at])]
        return found > 0

    def _rows(self, symbols: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many words and their number in each word.  ``symbols`` holds bytes and, after each word, END."""
        n, width = len(starts), int(lengths.max())
        order = np.argsort(-lengths, kind="stable")
        starts, lengths = starts[order], lengths[order]
        longest = np.full((n, width), -1, np.int64)
        state = np.zeros(n, np.int64)
        for k in range(width):  # the k-th symbol from the end
            m = int(np.searchsorted(-lengths, -k, "left"))
            at = lengths[:m] - 1 - k
            state[:m] = self._next(state[:m], symbols[starts[:m] + at])
            longest[np.arange(m), at] = self.found[state[:m]]
        stack = np.zeros((n, width), np.int64)
        dead = np.zeros((n, width + 1), bool)
        pos, depth, token = np.zeros(n, np.int64), np.zeros(n, np.int64), longest[:, 0].copy()
        active = np.arange(n)
        while len(active):
            t = token[active]
            back = active[t < 0]
            if len(back):
                dead[back, pos[back]] = True
                depth[back] -= 1
                last = stack[back, depth[back]]
                pos[back] -= self.length[last]
                token[back] = self.shorter[last]
                active_now, t = active[t >= 0], t[t >= 0]
            else:
                active_now = active
            end = pos[active_now] + self.length[t]
            ok = ~dead[active_now, end]
            check = np.flatnonzero(ok & (depth[active_now] > 0))
            if len(check):
                w = active_now[check]
                ok[check] = self.compatible(stack[w, depth[w] - 1], t[check])
            no = active_now[~ok]
            token[no] = self.shorter[t[~ok]]
            w, end = active_now[ok], end[ok]
            stack[w, depth[w]] = t[ok]
            depth[w] += 1
            pos[w] = end
            going = end < lengths[w]
            token[w[going]] = longest[w[going], end[going]]
            done = np.zeros(n, bool)
            done[w[~going]] = True
            active = active[~done[active]]
        back_order = np.empty(n, np.int64)
        back_order[order] = np.arange(n)
        stack, depth = stack[back_order], depth[back_order]
        return stack[np.arange(width) < depth[:, None]].astype(self.kind), depth

    def _one(self, symbols: np.ndarray) -> np.ndarray:
        """Ids of one long word, step by step."""
        n, state, longest = len(symbols), np.zeros(1, np.int64), [-1] * len(symbols)
        for k in range(n - 1, -1, -1):
            state = self._next(state, symbols[k : k + 1])
            longest[k] = int(self.found[state[0]])
        pos, out, dead, token, seen = 0, [], set(), longest[0], {}
        while True:
            if token < 0:
                dead.add(pos)
                last = out.pop()
                pos -= int(self.length[last])
                token = int(self.shorter[last])
                continue
            end = pos + int(self.length[token])
            ok = end not in dead
            if ok and out:
                pair = (out[-1], token)
                if pair not in seen:
                    seen[pair] = bool(self.compatible(np.array([pair[0]]), np.array([pair[1]]))[0])
                ok = seen[pair]
            if not ok:
                token = int(self.shorter[token])
                continue
            out.append(token)
            pos = end
            if pos == n:
                return np.array(out, self.kind)
            token = longest[pos]

    def _words(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """First and end code points of the pattern's words in a normalised text."""
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        kind = self.classes[points]
        new = np.ones(len(kind), bool)
        new[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == NUMBER)
        for at in np.flatnonzero(new & (points == 0x27)).tolist():
            for ending in ENDINGS:
                if text.startswith(ending, at + 1):
                    new[at + 1] = False
                    if at + 1 + len(ending) < len(new):
                        new[at + 1 + len(ending)] = True
                    break
        first = np.flatnonzero(new)
        end = np.append(first[1:], len(kind))
        word = kind[first] != BLANK
        return first[word], end[word]

    def learn(self, chunks: list[str]) -> None:
        """Encode chunks (texts without blanks) together and remember them."""
        text = " ".join(chunks)
        first, end = self._words(text)
        data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
        byte_at = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))  # of each code point
        lengths = byte_at[end] - byte_at[first] + 1
        starts = np.cumsum(lengths) - lengths
        symbols = np.full(int(lengths.sum()), END, np.int64)
        body = np.ones(len(symbols), bool)
        body[starts + lengths - 1] = False
        symbols[body] = data[np.repeat(byte_at[first] - starts + np.arange(len(first)), lengths - 1) + np.flatnonzero(body) - np.repeat(np.arange(len(first)), lengths - 1)]
        rows = lengths <= LONGEST_ROW
        counts = np.zeros(len(first), np.int64)
        if rows.any():
            ids, counts[rows] = self._rows(symbols, starts[rows], lengths[rows])
        if not rows.all():
            long = {int(w): self._one(symbols[starts[w] : starts[w] + lengths[w]]) for w in np.flatnonzero(~rows)}
            for w, x in long.items():
                counts[w] = len(x)
            short_ids, ids = (ids if rows.any() else None), np.zeros(int(counts.sum()), self.kind)
            where = np.repeat(rows, counts)
            if short_ids is not None:
                ids[where] = short_ids
            ids[~where] = np.concatenate(list(long.values()))
        # The words of a chunk are neighbours: where each chunk's words end.
        chunk_end = np.cumsum([len(c) + 1 for c in chunks]) - 1
        total = np.concatenate([[0], np.cumsum(counts)])
        ends = total[np.searchsorted(first, chunk_end)] * self.kind.itemsize
        data, at = ids.tobytes(), 0
        for chunk, to in zip(chunks, ends.tolist(), strict=True):
            self.known[chunk] = data[at:to]
            at = to

    def _parts(self, text: str) -> list:
        """A text as a list of lists of chunks and of special ids."""
        out = []
        for part in self.cut.split(text) if any(s in text for s in self.special) else (text,):
            if part in self.special:
                out.append(self.special[part])
                continue
            if not part.isascii():
                part = unicodedata.normalize("NFC", part).replace("Σ", "σ")
            part = part.lower()
            out.append([c for c in UNICODE_BLANK.split(part) if c] if any(c in part for c in SEPARATORS) else part.split())
        return out

    def encode_all(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of whole texts; null is empty.  Special tokens written in a text are their ids."""
        parts = [self._parts(t or "") for t in texts]
        chunks = set().union(*(c for p in parts for c in p if not isinstance(c, int)))
        new = chunks.difference(self.known)
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = chunks
        if new := sorted(new, key=len):
            self.learn(new)
        get, size = self.known.__getitem__, self.kind.itemsize
        out = [np.frombuffer(b"".join(x.to_bytes(size, "little") if isinstance(x, int) else b"".join(map(get, x)) for x in p), self.kind) for p in parts]
        for c in reversed(new):
            if len(c) <= LONGEST_REMEMBERED:
                break
            del self.known[c]
        return out

    def encode(self, text: str | None) -> np.ndarray:
        return self.encode_all([text])[0]

    def decoded(self, ids: np.ndarray):
        """Yield the UTF-8 bytes of the decoded text: the tokens with a space between."""
        for first in range(0, len(ids), DECODED_AT_ONCE):
            part = ids[first : first + DECODED_AT_ONCE].astype(np.int64)
            starts = self.offsets[part]
            lengths = self.offsets[part + 1] - starts
            ends = np.cumsum(lengths)
            out = self.pool[np.arange(ends[-1]) + np.repeat(starts - ends + lengths, lengths)]
            yield out if first + len(part) < len(ids) else out[:-1]

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(x.tobytes() for x in self.decoded(ids)).decode()


_loaded: dict[str, WordBpe] = {}


def loaded(path: str) -> WordBpe:
    """The encoder of a file, built once a worker process."""
    if path not in _loaded:
        _loaded[path] = WordBpe(path)
    return _loaded[path]


def encoded_slices(batches, path: str, limit: int = TOGETHER):
    """Yield (batch, first row, list of id arrays) for slices of Arrow batches of (doc_id, text)."""
    bpe = loaded(path)
    for batch in batches:
        for first, end in slices(batch.column(1), limit):
            yield batch, first, bpe.encode_all(batch.column(1).slice(first, end - first).to_pylist())


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id and ids as an array of integers.  No shuffle."""
    ship(docs.sparkSession)

    def run(batches):
        for batch, first, ids in encoded_slices(batches, path):
            column = pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(ids)), column], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """Per row of ``encoded`` (doc_id, ids): doc_id and the decoded text.  Null ids give a null text."""
    ship(encoded.sparkSession)

    def run(batches):
        bpe = loaded(path)
        for batch in batches:
            texts = [None if x is None else bpe.decode(np.array(x, np.int64)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Encode and decode every text in one pass and return the digests of both (SHA-256)."""
    ship(docs.sparkSession)

    def run(batches):
        bpe = loaded(path)
        for batch, first, all_ids in encoded_slices(batches, path, TOGETHER // 2):
            hashes, decoded = [], []
            for ids in all_ids:
                hashes.append(hashlib.sha256(ids.astype("<u4")).hexdigest())
                back = hashlib.sha256()
                for part in bpe.decoded(ids):
                    back.update(part)
                decoded.append(back.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(first, len(hashes)), pa.array(map(len, all_ids), pa.int64()), pa.array(hashes, pa.string()), pa.array(decoded, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, DIGESTS)
