import hashlib
import itertools
import math
import os
import re
import tarfile
import zlib

import numpy as np
import pytest

from atrium.llm import ctw, licenses, media, neardup, quality, toxicity
from atrium.llm.common import open_fs
from atrium.llm.components import components
from atrium.llm.q_licenses import op3_license_scan
from atrium.llm.q_media import op6_media
from atrium.llm.q_toxicity import sample
from atrium.llm.shingles import circulant_signatures

from .cases import ODD, empty_documents, odd_documents


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_components(spark):
    edges = spark.createDataFrame([(9, 8), (8, 7), (7, 6), (6, 5), (1, 2), (2, 2), (2, 1), (10, 5), (20, 21)], "a long, b long")
    got = {r.node: r.component for r in components(edges).collect()}
    assert got == {**dict.fromkeys((5, 6, 7, 8, 9, 10), 5), 1: 1, 2: 1, 20: 20, 21: 20}
    assert components(edges.limit(0)).count() == 0


def near_corpus():
    rng = np.random.default_rng(1)
    vocabulary = [f"w{i}" for i in range(3000)]
    texts = []
    for base in range(12):
        one = rng.choice(vocabulary, 60 + 40 * base).tolist()
        for copy in range(14):
            other = list(one)
            for at in rng.integers(0, len(one), copy * len(one) // 220):
                other[at] = rng.choice(vocabulary)
            texts.append(" ".join(other))
    return texts


def brute_components(texts, width, percent):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for t in texts:
        w = words((t or "").translate(lower))
        n = min(width, len(w))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set())
    home = list(range(len(texts)))
    for a, b in itertools.combinations(range(len(texts)), 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            low, high = sorted((home[a], home[b]))
            home = [low if h == high else h for h in home]
    return home, [len(s) for s in sets]


@pytest.mark.parametrize("width,percent", [(3, 85), (5, 80)])
def test_near_duplicates_equal_brute_force(spark, width, percent):
    texts = [*near_corpus(), *ODD]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    home, sizes = brute_components(texts, width, percent)
    got = neardup.near_duplicates(docs, neardup.Settings(width, percent)).collect()
    assert {r.doc_id: (r.component_id, r.n_shingles, r.kept) for r in got} == {i: (h, n, h == i) for i, (h, n) in enumerate(zip(home, sizes))}


def test_large_groups_in_blocks_equal_brute_force(spark, monkeypatch):
    whole = neardup.links_of
    monkeypatch.setattr(neardup, "links_of", lambda d, c, s: whole(d, c, s, block_docs=3))
    texts = near_corpus()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = neardup.near_duplicates(docs, neardup.Settings(3, 85)).collect()
    assert {r.doc_id: r.component_id for r in got} == dict(enumerate(brute_components(texts, 3, 85)[0]))


def test_near_duplicates_of_odd_rows(spark):
    rows = neardup.near_duplicates(odd_documents(spark)).collect()
    assert len(rows) == 14 and {r.doc_id: r.component_id for r in rows}[9] == 8
    assert [(r.component_id, r.kept) for r in rows if r.doc_id is None] == [(None, True)]
    kept = neardup.keep_one(odd_documents(spark))
    assert kept.columns == ["doc_id", "text", "grp", "block", "score"] and kept.count() == 12
    # One doc_id with two texts: both stay, whatever else is like one of them; equal rows are one.
    long = [" ".join(f"{p}{i}" for i in range(30)) for p in "abc"]
    rows = [(1, long[0], "y"), (1, long[1], "x"), (1, long[0], "w"), (2, long[1], "x"), (0, long[2], "x"), (0, long[0] + " end", "x"), (None, long[0], "x")]
    for order in (rows, rows[::-1]):
        got = neardup.keep_one(spark.createDataFrame(order, "doc_id long, text string, node string")).collect()
        texts = sorted((r.text, r.node) for r in got if r.doc_id is not None)
        assert sum(r.doc_id is None for r in got) == 1
        assert len(texts) == 3 and {t[:2] for t, _ in texts} == {"a0", "b0", "c0"}
    assert neardup.near_duplicates(empty_documents(spark)).count() == 0


def test_circulant_signatures_estimate_similarity():
    rng = np.random.default_rng(0)
    for share in (0.5, 0.85):
        common = rng.integers(0, 1 << 63, int(2000 * share), np.uint64)
        rest = [rng.integers(0, 1 << 63, int(2000 * (1 - share) / 2), np.uint64) for _ in range(2)]
        a, b = circulant_signatures([np.concatenate([common, r]) for r in rest], 512)
        assert abs((a == b).mean() - share) < 0.08


def brute_quality(text):
    w = words(text)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    repeated = {x for x in windows if windows.count(x) > 1}
    covered = {i + k for i, x in enumerate(windows) if x in repeated for k in range(3)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def brute_threshold(known):
    """Scores and labels of documents that pass the rules; the cut with the least sum of both error shares."""
    steps = sorted({math.floor(x / quality.SCORE_STEP) for x, _ in known})
    good = [math.floor(x / quality.SCORE_STEP) for x, q in known if q == 1]
    junk = [math.floor(x / quality.SCORE_STEP) for x, q in known if q != 1]
    errors = {s: sum(x < s for x in good) * len(junk) + sum(x >= s for x in junk) * len(good) for s in steps}
    last = max(s for s in steps if errors[s] == min(errors.values()))
    before = max((s + 1 for s in steps if s < last), default=last)
    return (before + last) / 2 * quality.SCORE_STEP


def test_quality_counts_and_ratios_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    clean = [" ".join(f"good{i}" for i in rng.integers(0, 300, 90)) for _ in range(24)]
    junk = [" ".join(f"bad{i}##" for i in rng.integers(0, 300, 90)) for _ in range(24)]
    texts = [*ODD, "a b c d a b c x y\na b\na b\n#|<>", *clean, *junk, " ".join(f"good{i % 70}" for i in range(5000)), clean[0]]
    first = len(ODD) + 1
    labels = {first + i: 1 for i in range(12)} | {first + 24 + i: 0 for i in range(12)} | {first + 23: None, 0: 1}
    docs = spark.createDataFrame([*((i, t, "x", 1) for i, t in enumerate(texts)), (None, clean[1], "x", 1)], "doc_id long, text string, words string, fold int")
    verdicts = spark.createDataFrame(list(labels.items()), "doc_id long, quality int")
    rows = quality.judge(docs, verdicts, buckets=512).collect()
    assert len(rows) == len(texts) + 1
    got = {r.doc_id: r for r in rows if r.doc_id is not None}
    good, every = np.zeros((quality.FOLDS, 512)), np.zeros(512)

    def grams(text):
        crc = [zlib.crc32(w.encode()) for w in words(text)]
        return [c % 512 for c in crc] + [(31 * a + b) % 512 for a, b in zip(crc, crc[1:])]

    folds = [hashlib.md5((t or "").encode()).digest()[0] % quality.FOLDS for t in texts]
    np.add.at(every, grams(clean[1]), 1)
    for i, t in enumerate(texts):
        np.add.at(every, grams(t), 1)
        if labels.get(i) == 1:
            np.add.at(good[folds[i]], grams(t), 1)
    scores, failed = {}, {}
    for i, t in enumerate(texts):
        n = brute_quality(t) if len(t or "") < 2000 else None
        r = got[i]
        if n:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == n
        failed[i] = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        others = good.sum(0) - good[folds[i]]
        ratios = np.log((others + others.sum() / every.sum()) / (every + 1) / (others.sum() / every.sum()))
        scores[i] = 0.0 if failed[i] else float(np.mean(ratios[grams(t)]))
        assert r.base_failed == failed[i] and abs(r.score - scores[i]) < 1e-9
    threshold = brute_threshold([(scores[i], q) for i, q in labels.items() if q is not None and not failed[i]])
    assert all(r.kept == (not failed[i] and scores[i] >= threshold) for i, r in got.items())


def test_quality_without_labels_or_rows(spark):
    docs = odd_documents(spark)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.judge(empty_documents(spark), none, buckets=512).count() == 0
    rows = quality.judge(docs, none, buckets=512).collect()
    assert len(rows) == docs.count() and all(r.kept == (not r.base_failed) and r.score == 0 for r in rows)


def exclusive(n=2400):
    """Texts that are toxic with exactly one of two words: no sum of single weights tells them apart."""
    rng, rows = np.random.default_rng(2), []
    for i in range(n):
        a, b = i % 2, i // 2 % 2
        filler = " ".join(f"f{j}" for j in rng.integers(0, 40, 12))
        rows.append((i, f"{filler} {'clodpate' if a else 'gentle'} {'martians' if b else 'people'}", int(a != b)))
    return rows


def test_toxicity_learns_pairs_that_single_weights_miss(spark):
    rows = exclusive()
    docs = spark.createDataFrame([(i, t, 9.0) for i, t, _ in rows], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    accuracy = {}
    for factors in (4, 0):
        settings = toxicity.Settings(factors=factors)
        model = toxicity.fit(sample(docs, labels, rows=1600), settings)
        got = {r.doc_id: r.score for r in toxicity.score(docs, model, settings).collect()}
        accuracy[factors] = np.mean([(got[i] >= 0.5) == bool(y) for i, _, y in rows])
    assert accuracy[4] > 0.97 and accuracy[0] < 0.6


def brute_score(model, settings, text):
    """The machine's sum over all single terms and all pairs, one by one."""
    at = toxicity.Terms(settings.dimensions).of(text).tolist()
    w = dict(zip(model["places"], model["weights"]))
    v = dict(zip(model["places"], np.array(model["factors"]).reshape(-1, settings.factors)))
    raw = model["w0"] + sum(w.get(i, 0.0) for i in at) + sum(float(v[i] @ v[j]) for i, j in itertools.combinations([i for i in at if i in v], 2))
    return 1 / (1 + math.exp(-raw))


def test_toxicity_scores_equal_brute_force_and_keep_columns(spark):
    settings = toxicity.Settings()
    labelled = [(t, y) for _, t, y in exclusive(800)]
    model = toxicity.fit(spark.createDataFrame([*labelled, (None, 0), ("unlabelled", None)], "text string, label int"), settings)
    got = toxicity.score(odd_documents(spark).union(spark.createDataFrame([(50, labelled[0][0], "g", 1, 1.0)], odd_documents(spark).schema)), model, name="found")
    assert got.columns == ["doc_id", "text", "grp", "block", "score", "found"]
    rows = got.collect()
    assert len(rows) == 15 and all(abs(r.found - brute_score(model, settings, r.text)) < 1e-9 for r in rows)
    assert toxicity.score(empty_documents(spark), model).count() == 0
    nothing = toxicity.fit(spark.createDataFrame([], "text string, label int"))
    assert toxicity.score(spark.createDataFrame([(1, "x")], "doc_id long, text string"), nothing).first().score == 0.5


def plain_words(text):
    return [w for w in (x.lower().strip(licenses.PUNCTUATION) for x in (text or "").split()) if w]


def brute_licenses(text):
    """Templates whose pairs of neighbouring words a stretch of at most half again their length holds by four fifths."""
    w, found = plain_words(text), set()
    for name, template in licenses.TEMPLATES.items():
        t = plain_words(template)
        pairs = set(zip(t, t[1:]))
        places = [i for i, p in enumerate(zip(w, w[1:])) if p in pairs]
        for i in places:
            near = {(w[j], w[j + 1]) for j in places if i <= j < i + len(t) + len(t) // 2}
            if len(near) >= 0.8 * len(pairs) and set(plain_words(" ".join(licenses.REQUIRED.get(name, ())))) <= set(w[i : i + 2 * len(t)]):
                found.add(name)
    return found


def test_licenses_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    prose = lambda n: " ".join(f"word{i}" for i in rng.integers(0, 500, n))
    texts = [*ODD, None]
    for name, template in sorted(licenses.TEMPLATES.items()):
        texts.append(f"{prose(int(rng.integers(0, 30)))}\n{template}\n{prose(20)}")
        changed = template.split()
        changed[len(changed) // 2] = "altered"
        texts.append(f"{prose(12)} {' '.join(changed).upper()}, {prose(5)}")
        texts.append(f"{prose(6000)} {template} {prose(3000)}")
        texts.append(f"{prose(5)} {' '.join(template.split()[: len(template.split()) // 2])} {prose(5)}")
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, matches string")
    docs = docs.union(spark.createDataFrame([(None, texts[-1], "x"), (0, None, "x")], docs.schema))
    rows = licenses.scan(docs).collect()
    assert len(rows) == len(texts) + 2
    for r in rows:
        if r.doc_id is None or not texts[r.doc_id]:
            continue
        text, want = texts[r.doc_id], brute_licenses(texts[r.doc_id])
        got = {m.license for m in r.matches}
        # Of overlapping templates one is reported, so what is found is among those that a full search finds, and none is missed.
        assert got <= want and bool(got) == bool(want), (text[:80], got, want)
        for m in r.matches:
            assert brute_licenses(text[m.start : m.end]) >= {m.license}
    for k, (name, template) in enumerate(sorted(licenses.TEMPLATES.items())):
        whole = next(r for r in rows if r.doc_id == len(ODD) + 1 + 4 * k)
        assert name in {m.license for m in whole.matches} and any(whole.doc_id is not None and texts[whole.doc_id][m.start : m.end] in template + "." for m in whole.matches), name
    assert licenses.scan(empty_documents(spark)).count() == 0


def test_licenses_tell_versions_apart(spark, tmp_path):
    others = [
        "This work is licensed under the GNU General Public License, version 2.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
        "Licensed under the Apache License, Version 1.1.",
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "Licensed under the Apache License, Version 3.0.",
    ]
    two = "Released under the MIT License. Licensed under the Apache License, Version 2.0."
    spark.createDataFrame(list(enumerate([*others, two])), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in op3_license_scan(spark, str(tmp_path)).collect()}
    assert [got[i].licenses for i in range(5)] == ["GPL-2.0", "CC-BY-NC-4.0-notice", "Apache-1.1", "LGPL-3.0", ""]
    assert [(s.license, two[s.start : s.end]) for s in got[5].spans] == [("MIT", two[:31]), ("Apache-2.0", two[32:])]


def test_media_digests_equal_the_archives(spark, tmp_path):
    """op6's columns against tar, PNG scanlines and digests taken apart by the standard library alone."""
    docs = odd_documents(spark)
    docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).write.parquet(f"{tmp_path}/documents.parquet")
    before = set(os.listdir(root)) if (root := (spark.conf.get("spark.checkpoint.dir", None) or "").removeprefix("file://")) else set()
    got = {r.doc_id: r for r in op6_media(spark, str(tmp_path)).collect()}
    root = spark.conf.get("spark.checkpoint.dir").removeprefix("file://")
    (folder,) = [f for f in os.listdir(root) if f.startswith("media-") and f not in before and any(x.endswith(".tar") for x in os.listdir(f"{root}/{f}"))]
    seen = 0
    for name in os.listdir(f"{root}/{folder}"):
        if not name.endswith(".tar") or name.startswith("."):
            continue
        with tarfile.open(f"{root}/{folder}/{name}") as tar:
            for member in tar:
                image = tar.extractfile(member).read()
                doc_id = int(member.name.split("-")[1].split(".")[0])
                data, at = b"", 8
                while at < len(image):
                    n = int.from_bytes(image[at : at + 4], "big")
                    data += image[at + 8 : at + 8 + n] if image[at + 4 : at + 8] == b"IDAT" else b""
                    at += 12 + n
                lines = zlib.decompress(data)
                payload = b"".join(lines[i + 1 : i + 65] for i in range(0, len(lines), 65))
                raw = (ODD[doc_id] or "").encode()
                assert payload == raw + bytes(len(payload) - len(raw)) and len(payload) == 64 * max(1, -(-len(raw) // 64))
                x, r = np.frombuffer(payload, np.uint8), got[doc_id]
                assert (r.n_bytes, r.payload_bytes, r.media_bytes, r.error) == (len(raw), len(payload), len(image), None)
                assert (r.payload_sha256, r.media_sha256) == (hashlib.sha256(payload).hexdigest(), hashlib.sha256(image).hexdigest())
                assert r.tail_crc32 == zlib.crc32(payload[-64:])
                bins = [int(((x >= 16 * b) & (x < 16 * b + 16)).sum()) * 1000 // len(x) for b in range(16)]
                assert r.feature == f"64x{len(x) // 64};mean={sum(x.tolist()) * 1000 // len(x)};hist={','.join(map(str, bins))}"
                seen += 1
    assert seen == len(got) == len(ODD)


def test_media_round_trip_and_retry(spark, monkeypatch):
    docs = odd_documents(spark)
    folder = media.write_archives(docs.repartition(3))
    read = media.read_archives(spark, folder, rangeBytes=2048)
    assert read.rdd.getNumPartitions() > 3
    want = sorted((r.doc_id or -1, (r.text or "").encode()) for r in docs.collect())
    assert sorted((r.doc_id or -1, (lambda s: s[0][: s[1]])(media.decode_image(bytes(r.media)))) for r in read.collect()) == want
    described = {r.doc_id: r for r in media.describe(read).collect()}
    assert described[1].payload_bytes == 64 and described[7].n_bytes == 70_000 and described[8].media_sha256 == described[9].media_sha256
    assert media.read_archives(spark, media.write_archives(empty_documents(spark))).count() == 0
    # One member is damaged: it alone is reported, the others of its range are read.
    system, path = open_fs(folder)
    archive = next(p.path for p in system.get_file_info(media.fs.FileSelector(path)) if p.base_name.endswith(".tar"))
    index = np.frombuffer(system.open_input_file(archive.replace(".tar", ".idx")).readall(), media.ENTRY)
    data = bytearray(system.open_input_file(archive).readall())
    data[int(index["offset"][0]) + 20] ^= 255
    with system.open_output_stream(archive) as out:
        out.write(bytes(data))
    rows = media.read_archives(spark, folder).collect()
    assert sum(r.error is not None for r in rows) == 1 and len(rows) == 14


def brute_ctw(keys, counts, depth):
    """Sequential context-tree weighting over single decisions, with recursion over dictionaries."""
    seen: dict = {}
    prefix, bit = ctw.decisions(keys)
    for k, n, p, b in zip(keys.tolist(), counts.tolist(), prefix.tolist(), bit.tolist()):
        context = [(k >> 8 * (depth - d)) & 255 for d in range(depth)]
        for j in range(8):
            for d in range(depth + 1):
                seen.setdefault((p[j], *context[:d]), [0, 0])[b[j]] += n

    def kt(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def weighted(node):
        if len(node) == depth + 1:
            return kt(*seen[node])
        below = sum(weighted(c) for c in seen if len(c) == len(node) + 1 and c[: len(node)] == node)
        return np.logaddexp(math.log(0.5) + kt(*seen[node]), math.log(0.5) + below)

    out = []
    for k, p, b in zip(keys.tolist(), prefix.tolist(), bit.tolist()):
        context, total = [(k >> 8 * (depth - d)) & 255 for d in range(depth)], 0.0
        for j in range(8):
            q = None
            for d in range(depth, -1, -1):
                node = (p[j], *context[:d])
                own = (seen[node][b[j]] + 0.5) / (sum(seen[node]) + 1)
                if q is None:
                    q = own
                else:
                    stop = math.exp(math.log(0.5) + kt(*seen[node]) - weighted(node))
                    q = stop * own + (1 - stop) * q
            total += math.log(q)
        out.append(total)
    return out


def test_context_tree_weighting_equals_brute_force(spark):
    depth, texts = 3, ["abra cadabra abra", "abra", "xyz abrac", None, "abra cadabra abra"]
    train = [True, True, False, True, True]
    docs = spark.createDataFrame([(i, r, t, 1) for i, (r, t) in enumerate(zip(train, texts))], "doc_id long, train boolean, text string, shard int")
    got = {r.doc_id: r for r in ctw.score(docs, depth=depth, shards=3, block_bytes=20).collect()}
    streams = [ctw.stream_of(words(t) and [w.encode() for w in words(t)]) for t in texts]
    keys, counts = ctw.counted([ctw.strings_of(s, depth) for s in streams], train)
    logs = brute_ctw(keys, counts, depth)
    tokens = [[*words(t), ""] for t in texts]
    learnt = [w for t, r in zip(tokens, train) if r for w in t]
    for i, stream in enumerate(streams):
        score = sum(logs[np.searchsorted(keys, k)] for k in ctw.strings_of(stream, depth)) / math.log(10)
        base = sum(math.log10((learnt.count(w) + 1) / (len(learnt) + len(set(learnt)) + 1)) for w in tokens[i])
        r = got[i]
        assert abs(r.score - score) < 1e-8 and abs(r.base_score - base) < 1e-9
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens[i]), sum(w in learnt for w in tokens[i]), len(learnt))
    odd = odd_documents(spark).selectExpr("*", "doc_id % 2 = 0 AS train")
    assert ctw.score(odd, shards=3).count() == 14
    assert ctw.score(empty_documents(spark).selectExpr("*", "true AS train")).count() == 0
