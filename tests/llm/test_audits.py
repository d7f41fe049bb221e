"""Divergence audit, spelling variants and decontamination beside DuckDB or a brute-force version, on rows with nulls,
empty and long texts, repeats, ties and clashing column names."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import zlib

import duckdb
import pytest

from remitlens.llm import decontam, divergence, variants


def rows_of(df):
    return collections.Counter(tuple(r) for r in df.collect())


def duck_rows(sql: str, **tables):
    con = duckdb.connect()
    for name, frame in tables.items():
        con.register(name, frame)
    return collections.Counter(tuple(r) for r in con.sql(sql).fetchall())


# -- op11 ----------------------------------------------------------------------------------------------------------------


def audit_docs():
    rnd = random.Random(11)
    words = ["Haus", "été", "the", "of", "Rot", "blue", "x", "über", "Straße", "naïve", "a1b", "zz"]
    out = []
    for k in range(160):
        lang = [None, "de", "en", "en", ""][k % 5]
        source = [None, "s1", "s2", "s3"][k % 4] if k % 7 else "hot"
        text = None if k % 13 == 0 else " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 40)))
        out.append((k, text, lang, source, 9))
    out += [out[3], out[3], (999, "lonely words only", "xx", "only", 1)]
    return out


def test_perfect_hash_is_a_bijection_and_verifies():
    keys = [divergence.key_bytes("en", f"w{i}") for i in range(5000)]
    pilots, by_slot = divergence.build_shard(keys)
    assert sorted(by_slot) == sorted(keys)
    look = divergence.Lookup(1, {0: (pilots, by_slot)})
    assert [look.slot(k) for k in keys] == [by_slot.index(k) for k in keys]
    assert look.slot(divergence.key_bytes("en", "missing")) == -1
    tables = {k: divergence.build_shard([x for x in keys if divergence.shard_of(divergence._hash(x), 3) == k]) for k in (0, 2)}
    several, asked = divergence.Lookup(3, tables), keys + [divergence.key_bytes("de", f"w{i}") for i in range(99)]
    assert several.slots(asked).tolist() == [several.slot(k) for k in asked]
    assert divergence.key_bytes("a", "bc") != divergence.key_bytes("ab", "c")


def test_divergence_equals_sql(spark):
    import pandas as pd

    rows = audit_docs()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    frame = pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source", "n_chars"])
    got = rows_of(divergence.divergences(docs).select("lang", "source", "part", "item", "value", "rank"))
    want = duck_rows(divergence.SQL, documents=frame)
    assert got == want and any(r[2] == "term" for r in got)
    # The lang that keeps no term: pair rows of value 0 only where it has two sources; here it has one, so none.
    assert not any(r[0] == "xx" for r in got)


def test_recount_adds_up_the_slices_of_a_task(spark, monkeypatch):
    import pyarrow as pa

    import remitlens.llm.support as support

    texts = ["Éa b, B", "b\x00c b", None, "", "é b"] * 40
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 200), pa.array(["s", "t"] * 100), pa.array(texts)], names=["lang", "source", "text"])
    pilots, by_slot = divergence.build_shard([divergence.key_bytes("en", t) for t in ("b", "Éa", "é")])
    lookup = type("Value", (), {"value": divergence.Lookup(1, {0: (pilots, by_slot)})})
    monkeypatch.setattr(support.slices, "__defaults__", (64,))
    for flush in (1 << 18, 2):
        rows = [tuple(r.values()) for out in divergence._recount(lookup, flush)([batch]) for r in out.to_pylist()]
        got = collections.Counter()
        for lang, source, slot, n in rows:
            got[source, by_slot[slot]] += n
        want = collections.Counter((s, divergence.key_bytes("en", t)) for k, text in enumerate(texts) for s in ["st"[k % 2]] for t in re.findall(divergence.TERM, (text or "").replace("B", "b")) if t in ("b", "Éa", "é"))
        assert got == want
        if flush > 2:
            assert len(rows) == len(want)
    once = collections.Counter()
    for out in divergence._document_counts([batch.select(["lang", "text"])]):
        once.update({(r["lang"], r["term"]): r["count"] for r in out.to_pylist()})
    assert once == {("en", "b"): 120, ("en", "Éa"): 40, ("en", "c"): 40, ("en", "é"): 40}


def test_divergence_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert divergence.divergences(docs).count() == 0


# -- op12 ----------------------------------------------------------------------------------------------------------------

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a: str, b: str) -> bool:
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    s, t = (a, b) if len(a) < len(b) else (b, a)
    return any(t[:i] + t[i + 1 :] == s for i in range(len(t)))


def variants_by_hand(rows):
    count = collections.Counter()
    for doc_id, text in rows:
        for run in RUN.findall((text or "").translate(LOW)):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                i = h % len(run)
                run = run[:i] + run[i + 1 :]
            if len(run) >= 7:
                count[run] += 1
    words = {w: n for w, n in count.items() if n >= 2}
    near = {w: [o for o in words if one_edit(w, o)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda o: (-words[o], o)) if near[w] else None
        form[w] = best if best is not None and words[best] >= 10 * n else None
    out = {}
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), words[form[w]] if form[w] else None)
    return out


def variant_rows():
    rnd = random.Random(12)
    base = ["language", "Straßenbahn", "colourful", "reference", "wonderful", "abcdefgh"]
    out = []
    for k in range(300):
        w = rnd.choice(base)
        if rnd.random() < 0.08:
            i = rnd.randrange(len(w))
            w = w[:i] + rnd.choice("xyzé") + w[i + 1 :]
        if rnd.random() < 0.04:
            w = w + "s"
        out.append((None if k % 50 == 0 else k % 97, f"The {w.upper() if k % 9 == 0 else w}, and {rnd.choice(base)}; 12ab"))
    return out + [(5, None), (6, ""), (7, "x" * 5000), (7, "x" * 5000)]


def test_variants_equal_brute_force(spark):
    rows = variant_rows()
    docs = spark.createDataFrame([(d, t, "clash") for d, t in rows], "doc_id long, text string, form string").repartition(3)
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in variants.variants(docs).collect()}
    want = variants_by_hand(rows)
    assert got == want and any(v[0] for v in got.values())


def test_signatures_find_every_pair_within_two():
    rnd = random.Random(3)
    for _ in range(300):
        a = "".join(rnd.choice("abcde") for _ in range(rnd.randint(7, 12)))
        i = rnd.randrange(len(a))
        b = rnd.choice([a[:i] + a[i + 1 :], a[:i] + "q" + a[i + 1 :], a[:i] + "q" + a[i:]])
        assert set(variants.signatures(a)) & set(variants.signatures(b))


def test_few_words_of_the_same_letters_are_compared(spark):
    rnd = random.Random(4)
    words = sorted({"".join(rnd.sample("abcdefghij", 10)) for _ in range(300)})
    words += [w[:i] + w[i + 1 :] for w in words[:40] for i in (0, 4, 5, 9)]
    left, right = variants.joinable(spark.createDataFrame([(w,) for w in words], "word string"))
    assert left.join(right, "key").where("a <> b").select("a", "b").distinct().count() < 3000
    got = {(r.a, r.b) for r in variants.near_pairs(spark.createDataFrame([(w,) for w in words], "word string")).collect()}
    assert got == {(a, b) for a in words for b in words if (len(a), a) < (len(b), b) and one_edit(a, b)} and len(got) >= 160


def test_variants_of_nothing(spark):
    assert variants.variants(spark.createDataFrame([], "doc_id long, text string")).count() == 0


# -- op13 ----------------------------------------------------------------------------------------------------------------


def decontam_tables():
    rnd = random.Random(13)
    vocab = [f"w{i}" for i in range(30)] + ["été", "Ünïcode", "the"]
    items = [(i, " ".join(rnd.choice(vocab) for _ in range(rnd.randint(1, 25)))) for i in range(12)]
    items += [(50, None), (51, "!!! ..."), (52, "The the THE"), (53, items[0][1])]
    docs = []
    for k in range(60):
        parts = [" ".join(rnd.choice(vocab) for _ in range(rnd.randint(0, 30)))]
        if k % 3 == 0:
            parts.append(rnd.choice(items)[1] or "")
        if k % 5 == 0:
            parts.append(" ".join(rnd.choice(vocab) for _ in range(8)))
        docs.append((k if k % 17 else None, ", ".join(parts).upper() if k % 4 == 0 else "; ".join(parts), 3))
    docs += [(100, None, 3), (101, "", 3), docs[3], docs[3], (102, " ".join(["the"] * 3000), 3)]
    return docs, items


def test_decontam_equals_sql(spark):
    import pandas as pd

    rows, items = decontam_tables()
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_hit long").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontam.contamination(docs, bench)
    assert found.columns == ["doc_id", "text", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    got = rows_of(found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"))
    want = duck_rows(
        decontam.SQL,
        documents=pd.DataFrame(rows, columns=["doc_id", "text", "n_hit"]),
        benchmark=pd.DataFrame(items, columns=["item_id", "text"]),
    )
    assert got == want and sum(n for r, n in got.items() if r[5]) > 5


def test_decontam_in_blocks(spark, monkeypatch):
    rows, items = decontam_tables()
    docs = spark.createDataFrame(rows, "doc_id long, text string, other long")
    bench = spark.createDataFrame(items, "item_id long, text string")
    whole = rows_of(decontam.contamination(docs, bench))
    monkeypatch.setattr(decontam, "BROADCAST_BYTES", 2000)
    assert rows_of(decontam.contamination(docs, bench)) == whole


def test_decontam_of_nothing(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    bench = spark.createDataFrame([], "item_id long, text string")
    (row,) = decontam.contamination(docs, bench).collect()
    assert (row.n_words, row.n_hit, row.n_items, row.items_sha256, row.contaminated) == (3, 0, 0, hashlib.sha256(b"").hexdigest(), False)
    assert decontam.contamination(docs.limit(0), bench).count() == 0
