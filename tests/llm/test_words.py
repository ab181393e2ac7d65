"""Language, spelling variants and conversation tries against brute force."""

import hashlib
import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from atrium.llm import langid, trie, variants
from atrium.llm.q_langid import held_out, op11_language_id
from atrium.llm.q_trie import rebuilt
from atrium.llm.q_variants import MODULUS

from .cases import ODD, empty_documents, odd_documents


def brute_words(rows, modulus):
    found = Counter()
    for doc_id, text in rows:
        run = ""
        for c in (text or "") + " ":
            if c.isascii() and c.isalpha() or "À" <= c <= "ÿ":
                run += c
                continue
            if run:
                low = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in run)
                h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{low}".encode())
                found[low if h % modulus else low[: h % len(low)] + low[h % len(low) + 1 :]] += 1
                run = ""
    return {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(rows, modulus):
    words = brute_words(rows, modulus)
    out = {}
    for w, n in words.items():
        others = [x for x in words if abs(len(x) - len(w)) <= 1 and near(x, w)]
        best = min(others, key=lambda x: (-words[x], x), default=None)
        form = best if best is not None and words[best] >= 10 * n else None
        out[w] = [n, len(others), form, words.get(form)]
    for w, row in out.items():
        root = w
        while out[root][2]:
            root = out[root][2]
        row.append(root)
    return {w: tuple(row) for w, row in out.items()}


def spelling_rows():
    rng = random.Random(5)
    bases = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(7, 13))) for _ in range(40)]
    bases += [b[:4] + "x" + b[4:] for b in bases[:10]] + ["aaaaaaa", "aaaaaaaa", "abababab", "babababa", "ÀÀÀÀÀÀÀ", "x" * 300, "x" * 301]
    rows = []
    for i in range(60):
        words = []
        for b in rng.choices(bases, weights=[1 + 60 // (1 + k % 13) for k in range(len(bases))], k=120):
            at = rng.randrange(len(b))
            words.append(rng.choice([b, b, b, b.upper(), b[:at] + b[at + 1 :], b[:at] + "z" + b[at:], b[:at] + rng.choice("abc") + b[at + 1 :]]))
        rows.append((i, rng.choice((" ", "-", "1")).join(words)))
    return rows + [(None, rows[0][1]), (3, None), (4, ""), (5, rows[5][1])] + list(enumerate(ODD))


@pytest.mark.parametrize("list_words", [20_000, 2])
def test_variants_equal_brute_force(spark, monkeypatch, list_words):
    monkeypatch.setattr(variants, "LIST_WORDS", list_words)
    monkeypatch.setattr(variants, "FEWEST", 5)
    rows = spelling_rows()
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, word string, n int")
    got = {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in variants.group_variants(docs, MODULUS).collect()}
    assert got == brute_variants(rows, MODULUS) and any(r[2] for r in got.values())


def test_variants_of_odd_rows(spark):
    assert variants.group_variants(empty_documents(spark), MODULUS).count() == 0
    rows = [(r.doc_id, r.text) for r in odd_documents(spark).collect()]
    assert {r.word: r.n for r in variants.group_variants(odd_documents(spark), MODULUS).collect()} == brute_words(rows, MODULUS)


def test_an_edit_affects_no_more_grams_than_the_bound():
    rng = random.Random(1)
    for _ in range(3000):
        a = "".join(rng.choice("abc") for _ in range(rng.randint(7, 14)))
        at = rng.randrange(len(a) + 1)
        b = rng.choice([a[:at] + rng.choice("abc") + a[at:], a[:at] + a[at + 1 :], a[:at] + rng.choice("abc") + a[at + 1 :]])
        frequent = {"".join(g): 99 for q in range(3, 7) for g in itertools.product("abc\x02\x03", repeat=q) if rng.random() < 0.4}
        (x, bound_a), (y, bound_b) = variants.decompose(a, frequent), variants.decompose(b, frequent)
        common = sum((Counter(x) & Counter(y)).values())
        assert common >= max(len(x) - bound_a, len(y) - bound_b) > 0 or len(b) < 7
        if a != b and len(b) >= 7:
            assert {g[1:] for g in variants.first_grams(a, frequent)} & {g[1:] for g in variants.first_grams(b, frequent)}


def test_long_texts_are_cut_between_words(monkeypatch):
    monkeypatch.setattr(variants, "PIECE", 10)
    text = "abcdefgh ijklmnopqrstuv,wxyz " * 20 + "tail" * 30
    assert "".join(variants.pieces(text)) == text
    assert [r for p in variants.pieces(text) for r in variants.RUN.findall(p)] == variants.RUN.findall(text)


def brute_trie(turns, members):
    """turns: conv_id to its list of (digest, words)."""
    prefixes = defaultdict(list)
    for c in members:
        for d in range(len(turns.get(c, [])) + 1):
            prefixes[tuple(x for x, _ in turns.get(c, [])[:d])].append((c, turns[c][d - 1][1] if d else 0))
    out = set()
    for p, at in prefixes.items():
        below = [q for q in prefixes if q[: len(p)] == p]
        ends = ",".join(map(str, sorted(c for c, _ in at if len(turns.get(c, [])) == len(p))))
        parent = min(c for c, _ in prefixes[p[:-1]]) if p else None
        kids = lambda q: sum(len(x) == len(q) + 1 and x[:-1] == q for x in prefixes)
        out.add((min(c for c, _ in at), len(p), parent, len(at), kids(p), sum(not kids(q) for q in below), sum((len(prefixes[q]) - 1) * prefixes[q][0][1] for q in below), hashlib.sha256(ends.encode()).hexdigest()))
    return out


COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def conversations():
    rng = random.Random(2)
    rows = [(7, t, "user", f"turn {t % 3} of a long one") for t in range(70)]
    for c in [*range(12), *range(20, 45), 61, 100]:
        rows += [(c, t, rng.choice(("user", "assistant")), rng.choice(("a b", "c", "", None, "d e f"))) for t in range(rng.randint(1, 7))]
    return rows + [(9, None, None, "first"), (9, None, None, "first"), (9, 2, "user", "tie"), (None, 1, "user", "nobody's"), (62, 0, "user", "alone"), (-5, 1, "user", "x y")]


def test_trie_equals_brute_force(spark):
    rows = conversations()
    table = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, depth int").repartition(7)
    by = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            digest = hashlib.md5(f"{len(role or '')}:{role or ''}{text or ''}".encode()).hexdigest()
            by[c].append((t is not None, t or 0, role or "", digest, len((text or "").split())))
    own = {c: [(x[3], x[4]) for x in sorted(v)] for c, v in by.items()}
    made = {}
    for c in own:
        h, base = zlib.crc32(str(c).encode()) % 4, c - (c % 20 if c >= 0 else -(-c % 20))
        made[c] = own.get(base, [])[:h] + own[c][h:]
    turns, members = rebuilt(table)
    got = trie.prefix_trie(turns, members, ("own", "at"))
    assert got.columns == list(COLUMNS)
    assert {tuple(r) for r in got.collect()} == brute_trie(made, list(own))
    assert any(not v for v in made.values())


def test_trie_of_no_conversations(spark):
    turns, members = rebuilt(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))
    assert trie.prefix_trie(turns, members, ("own", "at")).count() == 0


def test_members_are_hashed_in_parts(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK_IDS", 3)
    ends = spark.createDataFrame([((k % 2, 0), c) for k, c in enumerate(random.Random(3).sample(range(500), 100))], "id struct<a: long, b: long>, conv_id long")
    want = {r.id.a: hashlib.sha256(",".join(map(str, sorted(r.c))).encode()).hexdigest() for r in ends.groupBy("id").agg(F.collect_list("conv_id").alias("c")).collect()}
    assert {r.id.a: r.ends_sha256 for r in trie.digests(ends).collect()} == want


def test_features_count_each_gram():
    settings = langid.Settings(dimensions=1 << 20)
    places, n = langid.counts("Abc abcÀ", settings)
    text = " abc abcà "
    want = Counter(text[i : i + q] for q in (1, 2, 3) for i in range(len(text) - q + 1))
    assert sorted(n) == sorted(want.values()) and len(places) == len(want)


def test_long_texts_count_as_whole_ones(monkeypatch):
    text = "".join(random.Random(4).choices("abc défg", k=5000))
    whole = langid.counts(text, langid.Settings())
    monkeypatch.setattr(langid, "PIECE", 97)
    parts = langid.counts(text, langid.Settings())
    assert all(np.array_equal(a, b) for a, b in zip(whole, parts))


def test_language_of_unseen_documents(spark):
    rows = op11_language_id(spark, "/root/testdata/sf0.01").collect()
    truth = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    assert len(rows) == len(truth) and {r.doc_id for r in rows if r.held_out} == {i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0}
    unseen = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in unseen) >= 0.99 * len(unseen)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_odd_rows(spark):
    known = spark.createDataFrame([(i, t, lang) for i, (t, lang) in enumerate([("the cat and the dog", "en"), ("der Hund und die Katze", "de"), (None, "en"), ("le chat", None)] * 8)], "doc_id long, text string, lang string")
    usable = langid.learnable(known, F.lit(True))
    idf = langid.document_frequencies(usable)
    model = langid.fit(langid.sample(usable), idf)
    assert model["languages"] == ["de", "en"]
    docs = odd_documents(spark).withColumn("LANG_PRED", F.lit("clash"))
    got = langid.predict(docs, model, idf)
    assert got.columns == ["doc_id", "text", "grp", "block", "lang_pred", "score"]
    for r in got.collect():
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred in ("de", "en") and 0 < r.score <= 1) if letters else (r.lang_pred, r.score) == ("und", 0.0)
    assert langid.predict(empty_documents(spark), model, idf).count() == 0
    none = langid.fit(langid.sample(usable.limit(0)), idf)
    assert {r.lang_pred for r in langid.predict(docs, none, idf).collect()} == {"und"}
    assert [r.x for r in spark.sql("SELECT CAST(NULL AS BIGINT) AS doc_id").select(held_out().alias("x")).collect()] == [True]


def test_temperature_tells_the_share_of_errors():
    rng = np.random.default_rng(0)
    said = rng.integers(0, 2, 4000)
    truth = np.where(rng.random(4000) < 0.9, said, 1 - said)
    raw = np.zeros((4000, 2))
    raw[np.arange(4000), said] = 30.0
    p = langid.softmax(np.array([30.0, 0.0]) / langid.temperature(raw, truth))
    assert abs(p[0] - 0.9) < 0.02
    assert langid.temperature(raw[:0], truth[:0]) == 1.0
