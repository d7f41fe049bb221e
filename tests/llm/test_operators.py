"""Each operator beside a brute-force version, on rows with nulls, empty and long texts, ties, repeats and extra columns."""

from __future__ import annotations

import collections
import gzip
import hashlib
import random
import re
import tracemalloc
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from remitlens.llm import bpe, chosenpath, language, lines, packing, repetition, sharding, spots, urls, warc
from remitlens.llm.queries import URL_RULES, word_vocabulary
from remitlens.llm.support import saved, scratch, slices

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SHARED = "This line stands in many documents."
LONG = " ".join(f"word{k % 977} the other{k % 1009}" for k in range(6000))


def texts() -> list[str | None]:
    rnd = random.Random(4)
    some = ["".join(rnd.choice("ab éT'.,|\n\t#") for _ in range(rnd.randint(0, 120))) for _ in range(30)]
    base = " ".join(rnd.choice(["the", "of", "Haus", "été", "red.", "blue", "ninety", "x"]) + str(rnd.randint(0, 60)) for _ in range(120))
    near = [base, base.replace("x", "y", 1), base + " more", base.upper().lower(), base]
    lined = [f"{SHARED}\nown {k}\n  {SHARED.upper()} " for k in range(5)]
    return [None, "", " ", "\n\n", "one", "<|endoftext|> it's", LONG, LONG + " tail", *near, *lined, *some, some[0], None]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, "en" if k % 2 else None, "src", 7, 8, "x") for k, t in enumerate(texts())]
    # Columns with the names that the operators make.
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_lines long, slot long, kept string").repartition(3).cache()


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.limit(0)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_encoder_matches_the_library():
    mine, library = bpe.WordBpe(word_vocabulary()), Tokenizer.from_file(word_vocabulary())
    rnd = random.Random(1)
    cases = [t or "" for t in texts()] + ["a" * 3000, "'s's ''s !'s 'sfoo", "ΑΣ ΣΣ", "don't\x1cstop\u3000a\xa0b", "ﬁ́ İK 中文字 😀😀", "<|startoftext|>x<|ENDOFTEXT|>"]
    cases += ["".join(rnd.choice("abcdefghiklmnorstuvz'!., é0") for _ in range(rnd.randint(1, 70))) for _ in range(500)]
    for text, ids in zip(cases, mine.encode_all(cases), strict=True):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == want, text[:60]
        assert mine.decode(ids) == library.decode(want, skip_special_tokens=False)


def test_encode_decode_documents(docs, nothing):
    library = Tokenizer.from_file(word_vocabulary())
    got = by_id(bpe.digests(docs, word_vocabulary()))
    for k, t in enumerate(texts()):
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert got[k]["n_tokens"] == len(ids)
        assert got[k]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[k]["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    ids = bpe.encode_documents(docs, word_vocabulary())
    back = by_id(bpe.decode_documents(ids, word_vocabulary()))
    assert back[4]["text"] == "one</w>" and back[0]["text"] == ""
    assert bpe.digests(nothing, word_vocabulary()).count() == 0


def repetition_by_hand(t: str | None) -> dict[str, int]:
    t = t or ""
    w, seen, dup, dup_chars, full = WORD.findall(t), set(), 0, 0, 0
    for line in t.split("\n"):
        if WORD.search(line):
            full += 1
            if line in seen:
                dup += 1
                dup_chars += sum(map(len, WORD.findall(line)))
            seen.add(line)

    def covered(n):
        c = collections.Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
        return {j for i in range(len(w) - n + 1) if c[tuple(w[i : i + n])] > 1 for j in range(i, i + n)}

    out = {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in t), "n_lines": full, "n_dup_lines": dup, "dup_line_chars": dup_chars, "n_repeat_words": len(covered(3))}
    return out | {f"dup_{n}gram_chars": sum(len(w[i]) for i in covered(n)) for n in repetition.LIMITS}


def test_repetition(docs, nothing):
    got = by_id(repetition.judged(docs))
    for k, t in enumerate(texts()):
        want = repetition_by_hand(t)
        assert {c: got[k][c] for c in want} == want
        assert got[k]["base_failed"] == (want["n_words"] < 50 or 100 * want["n_repeat_words"] > 50 * want["n_words"])
        assert not (got[k]["base_failed"] and got[k]["kept"])
    kept = repetition.of_good_quality(docs)
    assert kept.columns == docs.columns and kept.where("slot <> 8").count() == 0
    assert {r["doc_id"] for r in kept.collect()} == {k for k, r in got.items() if r["kept"]}
    assert repetition.judged(nothing).count() == 0


def components_by_hand(rows, words, percent):
    sets = {}
    for k, t in rows:
        w = WORD.findall((t or "").translate(LOWER))
        sets[k] = {tuple(w[i : i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set())
    top = {k: k for k in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                top[y] = x
    return {k: (len(s), find(k)) for k, s in sets.items()}


def test_chosen_path(spark, docs, nothing):
    rnd = random.Random(9)
    chain = [" ".join(f"w{j}" for j in range(9 * k, 9 * k + 100)) for k in range(4)]  # only neighbours are linked
    rows = list(enumerate(texts() + chain + [" ".join(rnd.choices("abcdefgh", k=60)) for _ in range(40)]))
    more = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for words in (2, 5):
        want = components_by_hand(rows, words, 80)
        got = by_id(chosenpath.near_duplicates(more, words, 80))
        assert {k: (r["n_shingles"], r["component_id"]) for k, r in got.items()} == want
        assert all(r["kept"] == (r["component_id"] == k) for k, r in got.items())
    assert chosenpath.near_duplicates(nothing).count() == 0


def test_chosen_path_repeated_and_null_ids(spark):
    a, b = "a b c d e f", "g h i j k l"
    rows = [(3, a), (5, a), (5, b), (9, b), (None, a), (None, "alone here"), (7, None), (9, b)]
    got = chosenpath.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 2, 80).collect()
    found = sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in got), key=str)
    assert found == sorted([(3, 3, True), (5, 3, False), (5, 3, False), (9, 3, False), (9, 3, False), (None, 3, False), (None, None, True), (7, 7, True)], key=str)


def test_large_group_of_near_copies(spark):
    rnd = random.Random(2)
    base = [f"w{k}" for k in range(200)]
    rows = []
    for k in range(400):
        words = [*base]
        for _ in range(6):
            words[rnd.randrange(200)] = f"v{rnd.randrange(1000)}"
        rows.append((k, " ".join(words)))
    got = chosenpath.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 2, 80).collect()
    want = components_by_hand(rows, 2, 80)
    assert {r["doc_id"]: r["component_id"] for r in got} == {k: c for k, (_, c) in want.items()}


def dense_group(texts: int, pairs: int) -> list[tuple[int, str]]:
    """Texts of one template at 0.786, and ``pairs`` of them planted at 0.802."""
    rows = []
    for k in range(texts):
        own = [f"own{k}x{j}" for j in range(24)]
        if k < 2 * pairs:
            own[:2] = [f"pair{k // 2}x{j}" for j in range(2)]
        rows.append((k, " ".join([f"w{j}" for j in range(176)] + own)))
    return rows


def test_dense_group_under_the_threshold(spark):
    rows = dense_group(600, 200)
    got = chosenpath.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 1, 80).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {k: k // 2 * 2 if k < 400 else k for k, _ in rows}


def test_trees_keep_their_recall_at_every_depth():
    assert [chosenpath.trees(d, 0.8) for d in (2, 3, 4, 5, 6, 7)] == [12, 17, 21, 26, 32, 39]
    assert chosenpath.missed(4, 16, 0.8) > 1e-5 and chosenpath.trees(3, 1.0) == 1
    rnd, depth, lost = np.random.default_rng(3), 4, 0
    few, pairs = 4, 3000  # the formula beside the branching itself, with few trees
    tokens = rnd.integers(0, 1 << 32, (pairs, chosenpath.TOKENS)).astype(np.uint64)
    other = np.where(rnd.random(tokens.shape) < 0.8, tokens, tokens ^ np.uint64(1))
    for x, y in zip(tokens, other, strict=True):
        roots = rnd.integers(0, 1 << 63, few).astype(np.uint64)
        nodes = []
        for t in (x, y):
            node, owner = roots, np.zeros(few, int)
            for _ in range(depth):
                node, owner = chosenpath._children(node, owner, t[None], 0.8)
            nodes.append(node)
        lost += not np.isin(*nodes).any()
    assert lost / pairs == pytest.approx(chosenpath.missed(depth, few, 0.8), abs=0.015)


def test_links_of_short_texts(spark):
    rows = []
    for k in range(600):
        words = [f"w{k}x{j}" for j in range(6)]
        rows += [(2 * k, " ".join(words[:5])), (2 * k + 1, " ".join(words))]  # 4 and 5 shingles of two words, exactly 0.8
    got = chosenpath.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 2, 80).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {k: k // 2 * 2 for k, _ in rows}


def test_blocks_of_a_large_node(spark, monkeypatch):
    monkeypatch.setattr(chosenpath, "BLOCK", 20)
    monkeypatch.setattr(chosenpath, "WIDTH", 2)
    rnd = random.Random(6)
    base = [f"w{k}" for k in range(60)]
    rows = [(k, " ".join(rnd.sample(base, rnd.randint(40, 58)))) for k in range(150)] + [(150 + k, " ".join([*base, f"x{k}"])) for k in range(40)]
    got = chosenpath.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 1, 80).collect()
    want = components_by_hand(rows, 1, 80)
    assert {r["doc_id"]: r["component_id"] for r in got} == {k: c for k, (_, c) in want.items()}


def test_classes_just_under_the_threshold_are_not_all_paired(spark, monkeypatch):
    rnd = random.Random(9)
    base = [f"b{k}" for k in range(300)]

    def changed(name, n):
        words = list(base)
        for k in rnd.sample(range(300), n):
            words[k] = f"{name}x{k}"
        return " ".join(words)

    rows = [(k, changed(f"n{k}", 3)) for k in range(80)] + [(k, changed(f"f{k}", 34)) for k in range(80, 125)]
    made, pairs = [], chosenpath._pairs

    def counted(x, y, threshold):
        found = pairs(x, y, threshold).cache()
        made.append(found.count())
        return found

    monkeypatch.setattr(chosenpath, "_pairs", counted)
    got = chosenpath.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 1, 80).collect()
    assert {r.doc_id: r.component_id for r in got} == {k: 0 if k < 80 else k for k, _ in rows}
    assert made[1] < 800, made


def test_encoder_holds_little_besides_its_table(monkeypatch):
    path = word_vocabulary()
    encoder = bpe.loaded(path)
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3, 4]), pa.array(["some words again " * 60_000] * 4)], ["doc_id", "text"])
    tracemalloc.start()
    try:
        found = [len(x) for _, _, ids in bpe.encoded_slices([batch], path) for x in ids]
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert found == [180_000] * 4 and most < 48e6, most
    # A table that has room for what is new is not emptied.
    encoder.known.clear()
    monkeypatch.setattr(bpe, "REMEMBERED", 4)
    one = encoder.encode("some words again")
    learned, learn = [], encoder.learn
    monkeypatch.setattr(encoder, "learn", lambda chunks: (learned.append(chunks), learn(chunks)))
    assert np.array_equal(encoder.encode("again some words"), np.roll(one, 1)) and not learned
    encoder.encode("other words anew")
    assert len(learned) == 1 and set(learned[0]) == set(encoder.known) == {"other", "words", "anew"}


def test_no_text_is_shuffled_and_large_nodes_are_not_joined_with_themselves(spark, monkeypatch):
    plans, merged = [], []
    saved, contracted = chosenpath.saved, chosenpath.contracted

    def seen(df, name):
        if name == "sets":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return saved(df, name)

    def joined(labels, links):
        merged.append(links._jdf.queryExecution().optimizedPlan().toString())
        return contracted(labels, links)

    monkeypatch.setattr(chosenpath, "saved", seen)
    monkeypatch.setattr(chosenpath, "contracted", joined)
    monkeypatch.setattr(chosenpath, "WIDTH", 2)
    monkeypatch.setattr(chosenpath, "MOST_BITS", 64)  # nearly all ids share a mark
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = [(None if k == 7 else k, t) for k, t in dense_group(60, 15)]
        got = chosenpath.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 1, 80).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    want = sorted((k, k // 2 * 2 if k < 30 else k) for k, _ in rows if k is not None)
    assert sorted((r.doc_id, r.component_id) for r in got if r.doc_id is not None) == want
    assert [r.component_id for r in got if r.doc_id is None] == [6]
    assert plans and not any("SortMergeJoin" in p for p in plans)
    assert len(merged) > 3 and not any("Join" in p for p in merged)


def test_components_start_without_python_workers_of_their_own(spark, monkeypatch):
    plans, contracted = [], chosenpath.contracted

    def seen(labels, links):
        plans.append(labels._jdf.queryExecution().optimizedPlan().toString())
        return contracted(labels, links)

    monkeypatch.setattr(chosenpath, "contracted", seen)
    rows = spark.createDataFrame([(1, "a b c d"), (2, "a b c d"), (3, "e f g")], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in chosenpath.near_duplicates(rows, 2, 80).collect()} == {1: 1, 2: 1, 3: 3}
    assert plans and not any("RDD" in p for p in plans), plans


def test_tokens_take_a_byte_each(spark):
    found = chosenpath.described(spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id long, text string"), 2)
    assert {r.doc_id: r.tokens and len(r.tokens) for r in found.collect()} == {1: chosenpath.TOKENS, 2: None}


def test_spots(spark, docs, nothing):
    rows = sorted(enumerate(texts()), reverse=True)
    got = by_id(spots.edited_likeness(docs))
    by_text = {}
    for at, (k, t) in enumerate(rows):
        t, after = t or "", rows[(at + 1) % len(rows)][1] or ""
        edited = t[: len(t) - len(t) // 2] + after[: len(t) // 2]
        r = got[k]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert by_text.setdefault(t, r["fingerprint"]) == r["fingerprint"]
        a, b = set(r["fingerprint"].split()), set(r["edited_fingerprint"].split())
        assert r["near_edited"] == pytest.approx(len(a & b) / len(a | b) if a | b else 1.0)
        assert 0 <= r["near_next"] <= 1 and (r["fingerprint"] == "") == (t == "")
    assert spots.edited_likeness(nothing).count() == 0
    one = spots.edited_likeness(spark.createDataFrame([(1, "ab")], "doc_id long, text string")).first()
    assert one["edited_sha256"] == hashlib.sha256(b"aa").hexdigest() and one["near_next"] == 1
    ties = spark.createDataFrame([(None, "a b"), (2, "c d"), (2, "c d"), (2, None)], "doc_id long, text string")
    assert spots.edited_likeness(ties).count() == 4


def test_similar_pairs(docs):
    found = spots.fingerprints(docs)
    sets = collections.defaultdict(list)
    for r in found.collect():
        if r["spots"]:
            sets[tuple(r["spots"])].append(r["doc_id"])
    reps = {min(v): set(s) for s, v in sets.items()}
    for least in (0.8, 0.4):
        want = {(min(x, y), max(x, y)) for x in reps for y in reps if x < y and len(reps[x] & reps[y]) / len(reps[x] | reps[y]) >= least}
        assert {(min(r["a"], r["b"]), max(r["a"], r["b"])) for r in spots.similar_pairs(found, least).collect()} == want


def test_lines(spark, docs, nothing):
    con = duckdb.connect()
    table = pa.table({"doc_id": pa.array(range(len(texts())), pa.int64()), "text": pa.array(texts(), pa.string())})
    con.register("documents", table)
    want = {r[0]: r[1:] for r in con.sql(f"SELECT doc_id, n_lines, n_dropped, kept_sha256 FROM ({lines.SQL})").fetchall()}
    out = lines.deduplicated(docs)
    got = {k: (r["n_lines"], r["n_dropped"], hashlib.sha256(r["kept_text"].encode()).hexdigest()) for k, r in by_id(out).items()}
    assert got == want and any(x[1] for x in got.values())
    assert lines.deduplicated(nothing).count() == 0
    rows = [(1, SHARED), (1, SHARED), (2, SHARED), (None, SHARED), (2, "x\n" + SHARED), (3, SHARED)]
    found = lines.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r["doc_id"], r["kept_text"]) for r in found), key=str) == sorted([(1, ""), (1, ""), (2, ""), (2, "x"), (3, SHARED), (None, SHARED)], key=str)


def test_lines_over_many_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        rows = [(k, "\n".join([SHARED, f"a line that only {k} has it", f"a line that pairs share {k // 2}", f"a line of three docs {k // 3}"])) for k in range(60)]
        got = by_id(lines.deduplicated(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for k, t in rows:
        own = t.split("\n")
        keep = [x for j, x in enumerate(own) if not (j == 0 and k < 59) and not (j == 3 and k % 3 < 2)]
        assert got[k]["kept_text"] == "\n".join(keep)


def test_cut_is_the_cheapest():
    rnd = random.Random(3)
    for _ in range(150):
        window = rnd.choice([8, 16, 21, 64])
        n = rnd.randint(1, 200)
        ends = sorted({*rnd.choices(range(1, n + 1), k=5), n})
        places, penalty = packing.candidates(np.array(ends), np.array(sorted(set(rnd.choices(range(1, n + 1), k=9)))), rnd.randint(1, window))
        position, best = [0, *places.tolist()], [0]
        for i in range(1, len(position)):
            cost = lambda d: (0 if d & (d - 1) == 0 else window - d) + packing.PER_WINDOW
            best.append(min(best[j] + cost(position[i] - position[j]) for j in range(i) if position[i] - position[j] <= window) + int(penalty[i - 1]))
        total, begin, price = 0, 0, dict(zip(places.tolist(), penalty.tolist(), strict=True))
        for end in packing.cut(places, penalty, window):
            d = end - begin
            assert 0 < d <= window
            total, begin = total + (0 if d & (d - 1) == 0 else window - d) + packing.PER_WINDOW + price[end], end
        assert begin == n and total == best[-1]


def test_packing(docs, nothing):
    library = Tokenizer.from_file(word_vocabulary())
    ids = {k: np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for k, t in enumerate(texts())}
    got = packing.pack(docs, word_vocabulary(), block=5000).collect()
    pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert zlib.crc32(part.tobytes()) == r["ids_crc32"] and r["doc_tokens"] == len(ids[r["doc_id"]])
        pieces[r["doc_id"]].append((r["start"], r["length"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in [*pieces.values(), *sequences.values()]:
        at = 0
        for start, length in sorted(parts):
            assert start == at
            at += length
    assert {k: sum(n for _, n in v) for k, v in pieces.items()} == {k: len(v) for k, v in ids.items()}
    assert max(sum(n for _, n in v) for v in sequences.values()) <= packing.WINDOW
    assert packing.pack(nothing, word_vocabulary()).count() == 0


def test_warc(spark):
    a, big = "é" * 80, "x" * (17 << 20)
    rows = [(1, "http://a/\r\nb", None), (2, None, ""), (3, "u", a), (4, "u", a), (4, "u", a), (None, "n", a), (7, "b", big), (9, "c", "short"), (10, "c", "short"), (3, "u", a), (11, "z", "WARC/1.0\r\n\r\n\r\n\r\nx")]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, payload long").repartition(3)
    raw, path = scratch(spark, "raw"), scratch(spark, "warc")
    warc.write_monolithic(pages, raw)
    warc.normalise(spark, raw, path)
    got = [(r["page_id"], bytes(r["payload"]).decode() if r["payload"] is not None else None, r["record_type"], r["refers_to"]) for r in warc.read_archives(spark, path).collect()]
    want = [(1, "", "response", None), (10, "short", "response", None), (11, rows[10][2], "response", None), (2, "", "response", None), (3, a, "response", None), (3, a, "response", None)]
    want += [(4, None, "revisit", 3), (4, None, "revisit", 3), (7, big, "response", None), (9, "short", "response", None), (None, None, "revisit", 3)]
    assert sorted(got, key=str) == sorted(want, key=str)
    index = warc.read_index(spark, path).collect()
    assert len(index) == len(rows)
    for r in spark.read.format("binaryFile").load(f"{path}/kind=archive").collect():
        mine = sorted((x["start"], x["length"]) for x in index if r["path"].rsplit("/", 1)[1].startswith(x["archive"]))
        assert mine[-1][0] + mine[-1][1] == len(r["content"])
        for start, length in mine:
            assert gzip.decompress(bytes(r["content"][start : start + length])).startswith(b"WARC/1.0\r\n")
    assert {(r["page_id"], r["payload_bytes"]) for r in warc.look_up(spark, path, spark.createDataFrame([(7,), (9,)], "page_id long")).collect()} == {(7, 17 << 20), (9, 5)}
    assert warc.round_trip(pages.limit(0), scratch(spark, "raw"), scratch(spark, "warc")).count() == 0


def test_damaged_archives_raise():
    whole = gzip.compress(b"WARC/1.0\r\nContent-Length: 1\r\n\r\nx\r\n\r\n")
    assert len(list(warc.records(warc.inflated(whole + whole)))) == 2
    with pytest.raises(ValueError):
        list(warc.records(warc.inflated(whole[:-3])))
    with pytest.raises(ValueError):
        list(warc.records(warc.inflated(gzip.compress(b"WARC/1.0\r\nContent-Length: 9\r\n\r\nx"))))


def test_urls(spark):
    cases = [None, "", "no scheme", "http://", "http://A.example.NET/en/x?q#f", "http://example.net/en", "https://net/", "http://net", "http://b.org/fr/1", "http://example.com/de/", "http://x.example.com/de", "http://myexample.com/de/1", "http://u@h.net:80/", "a://b://c/d"]
    want = {}
    for k, url in enumerate(cases):
        rest = url.partition("://")[2] if url else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = host.translate(LOWER)
        fits = [(len(h), len(p), h + p, v) for v, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        want[k] = (host, path, max(fits)[2] if fits else None, max(fits)[3] if fits else "allow")
    pages = spark.createDataFrame([(k, u, "x") for k, u in enumerate(cases)], "page_id long, url string, host string")
    got = urls.judged(pages, URL_RULES)
    assert {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in got.collect()} == want
    trie = urls.build([("block", "a.com", "/x"), ("allow", "a.com", "/x"), ("allow", "a.com", "/xy/z"), ("block", "com", "")])
    assert urls.match(trie, "b.a.com", "/xq") == ("a.com/x", "block")
    assert urls.match(trie, "a.com", "/xy/zz") == ("a.com/xy/z", "allow")
    assert urls.match(trie, "a.com", "/q") == ("com", "block")
    assert urls.judged(pages.limit(0), URL_RULES).count() == 0


def test_sharding(spark, docs, nothing):
    repeated = docs.unionByName(docs.where("doc_id < 3"))
    out = sharding.sharded(repeated, scratch(spark, "shards"), 8, bucket_bytes=20_000)
    rows = out.collect()
    assert sorted((r["doc_id"], r["text"] or "") for r in rows) == sorted((r["doc_id"], r["text"] or "") for r in repeated.collect())
    slots = collections.defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    sizes = [len(slots[k]) for k in range(8)]
    assert max(sizes) - min(sizes) <= 1
    assert sharding.sharded(nothing, scratch(spark, "shards"), 8).count() == 0


def test_languages(spark, nothing):
    rnd = random.Random(6)
    stems = {"en": ["the", "ing", "shou", "ght"], "fr": ["eau", "que", "é", "oi"], "xx": ["zk", "vr", "ostr", "iz"]}
    rows = [(k, " ".join("".join(rnd.choices(stems[lang], k=3)) for _ in range(20)), lang) for k in range(150) for lang in [rnd.choice([*stems])]]
    rows += [(1000, None, "en"), (1001, " 12 !", "en"), (1002, "", None), (1003, "the ing shou", None)]
    found = by_id(language.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)))
    assert [found[k]["lang_pred"] for k in (1000, 1001, 1002, 1003)] == ["und", "und", "und", "en"]
    assert all(found[k]["lang_pred"] == lang for k, t, lang in rows[:150])
    assert all(r["held_out"] == (zlib.crc32(str(k).encode()) % 3 == 1) and 0 <= r["score"] <= 1 for k, r in found.items())
    assert language.identify(nothing).count() == 0
    kept = language.in_known_language(spark.createDataFrame([(*r, 1.5) for r in rows], "doc_id long, text string, lang string, score double"))
    assert kept.columns == ["doc_id", "text", "lang", "score"] and kept.count() == 151


def test_slices_cover_all_rows():
    column = pa.array([None, "", "x" * 50, "y", "", None, "z" * 10])
    for limit in (1, 10, 1000):
        parts = list(slices(column, limit))
        assert [k for a, b in parts for k in range(a, b)] == list(range(len(column)))


def test_a_carried_text_goes_to_python_once(spark):
    rows = spark.createDataFrame([(1, "the cat sat", "en"), (2, None, "en")], "doc_id long, text string, lang string")
    for kept in (language.in_known_language(rows), repetition.of_good_quality(rows)):
        assert "AS _text" not in kept._jdf.queryExecution().analyzed().toString()
    alone = {r["doc_id"]: r["_l_lang_pred"] for r in language.predict(rows, language.learn(rows), prefix="_l_").collect()}
    beside = {r["doc_id"]: r["_l_lang_pred"] for r in language.predict(rows, language.learn(rows), carry=["lang", "text", "doc_id"], prefix="_l_").collect()}
    assert alone == beside == {1: "en", 2: "und"}
    counts = [repetition.repetition(rows, carry=c, prefix="q_").select("doc_id", "q_n_words").collect() for c in (["doc_id"], ["lang", "text", "doc_id"])]
    assert sorted(counts[0]) == sorted(counts[1])


def test_language_vectors_are_bytes():
    made = language.Profiles(64, 3)
    made.vectors_of(["some words of a text"])
    assert made.vectors.itemsize == 1 and made.rows


def test_saved_sends_small_batches(spark):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["n", "size"])

    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(limit)
    texts = spark.range(0, 3000, 1, 1).selectExpr("repeat('abcdefghij', 1000) AS text")
    rows = saved(texts.mapInArrow(sizes, "n long, size long"), "sizes").collect()
    assert sum(r["n"] for r in rows) == 3000 and max(r["size"] for r in rows) < 10 << 20
    assert spark.conf.get(limit) == before
