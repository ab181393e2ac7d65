import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from atrium.llm import bpe, packing, tokenfile
from atrium.llm.common import WordIds

from .cases import ODD, empty_documents, odd_documents

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def direct():
    tokenizer = Tokenizer.from_file(WORDS)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def random_texts(n=300):
    parts = [" ", "\n", ", ", ". ", "don't", "I'M", "the", "İstanbul", "é", "é", "!!", "%%%", "<|endoftext|>", "<|ENDOFTEXT|>.", "x,y", "1,234.5", "ΣΑΣ,", " ", "\t", "word."]
    rng = random.Random(5)
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(n)]


def test_word_ids_equal_the_library(direct):
    for keep in (400_000, 5):
        encode = WordIds(WORDS, keep=keep)
        texts = [*ODD, *random_texts()]
        for text, raw in zip(texts, encode(texts)):
            assert np.frombuffer(raw, encode.dtype).tolist() == direct(text), text


def test_first_fit_decreasing_equals_brute_force():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 3, 500):
        lengths = rng.integers(1, 101, n)
        where, offset = packing.first_fit_decreasing(lengths, 100)
        free: list[int] = []
        for i in sorted(range(n), key=lambda i: -lengths[i]):
            bin_ = next((b for b, f in enumerate(free) if f >= lengths[i]), len(free))
            if bin_ == len(free):
                free.append(100)
            assert (where[i], offset[i]) == (bin_, 100 - free[bin_])
            free[bin_] -= lengths[i]


def test_packing_covers_every_id_once(spark, direct):
    docs = odd_documents(spark)
    for run in (packing.RUN, 4):
        pieces = packing.cut_documents(docs, WORDS, 64)
        rows = packing.pack(pieces, 2, 64, run).collect()
        sequences: dict[int, list] = {}
        for r in rows:
            sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        for spans in sequences.values():
            at = 0
            for offset, length in sorted(spans):
                assert offset == at and length > 0
                at += length
            assert at <= 64
        ids = [*direct(ODD[5]), 1]
        mine = sorted((r for r in rows if r.doc_id == 5), key=lambda r: r.start)
        assert [r.start for r in mine] == list(range(0, len(ids), 64)) and mine[0].doc_tokens == len(ids)
        assert mine[1].ids_crc32 == zlib.crc32(np.array(ids[64:128], "<u4").tobytes())
        assert sum(r.length for r in rows) == sum(len(direct(r.text)) + 1 for r in docs.collect())
    assert packing.pack_documents(empty_documents(spark), WORDS).count() == 0


def test_token_files_round_trip(spark, direct):
    docs = odd_documents(spark)
    rows = tokenfile.read_ids(spark, tokenfile.write_ids(docs, WORDS, files=3)).orderBy("start").collect()
    want = sorted(((r.doc_id is not None, r.doc_id or 0, tuple([*direct(r.text), 1])) for r in docs.collect()), key=lambda r: r[:2])
    assert [r.doc_id for r in rows] == [w[1] if w[0] else None for w in want]
    at = 0
    for r, w in zip(rows, want):
        assert r.start == at and tuple(np.frombuffer(r.ids, "<u4").tolist()) == w[2]
        at += r.n_tokens
    assert tokenfile.read_ids(spark, tokenfile.write_ids(empty_documents(spark), WORDS)).count() == 0


def test_bpe_equals_the_library_and_decodes(spark):
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(BYTES), special_tokens={})
    texts = [*random_texts(120), "  two   spaces ", "\n\n x", "٣٤ ²Ⅷ", "a\x85b"]
    docs = odd_documents(spark).select("doc_id", "text", "block").union(spark.createDataFrame([(100 + i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, block long"))
    want = sorted(((r.doc_id or -1, tuple(encoding.encode_ordinary(r.text or "")), (r.text or "").encode()) for r in docs.collect()))
    decoded = bpe.decode(bpe.encode(docs, BYTES, public_tokenizers.PATTERN, shards=5), BYTES)
    assert sorted((r.doc_id or -1, tuple(r.ids), bytes(r.bytes)) for r in decoded.collect()) == want
    assert bpe.encode(empty_documents(spark), BYTES, public_tokenizers.PATTERN).count() == 0
