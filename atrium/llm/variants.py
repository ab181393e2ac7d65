"""Spelling variants: words that differ by one code point, found by an index of variable-length grams.

The dictionary of grams is a frequency-pruned trie over all words: a gram of LEAST code points or more is
extended by the next code point while it is frequent, up to MOST. A word, between two marks, has one gram from
each of its places, and a gram is decided by its own code points alone, so that an edit affects exactly the
grams that hold its place. The most that any place has is the word's bound of affected grams: two near words
share all grams of either but so many. In an order of all grams, rarest first, near words therefore share one
of the first bound + 1 grams of both (repeated grams are numbered), and only those lists are merged. Words of
one list are verified exactly. With marks a word of 7 code points or more has more grams than its bound.

Lists of grams known to be in more than LIST_WORDS words are split by what is left of a word without one code
point, so that no list exceeds the larger of LIST_WORDS and the frequency from which grams are extended.

Words are counted, never sampled. Null and empty texts have no words, a null doc_id counts as empty text,
repeated rows count each, ties go to the smaller word in code-point order, other columns of the input are not
read, and an empty table gives no words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atrium.llm.common import materialize, slices, tidy

#: Words of fewer code points are not grouped, nor words that occur less often.
SHORTEST, OCCURRENCES = 7, 2
#: A form occurs so many times as often as its variant.
TIMES = 10
LEAST, MOST = 3, 6
#: Grams of at least a share of 1 / SHARE of the words are frequent, and of at least FEWEST words. So there are at most
#: SHARE times as many as a word has grams of all lengths on average.
SHARE, FEWEST = 4_096, 64
#: Longer lists are split.
LIST_WORDS = 20_000
#: A task sends on what it has counted beyond so many entries.
HELD = 200_000
#: Longer texts are cut between words.
PIECE = 1 << 20
#: Lists of up to so many words are compared word by word.
SMALL = 10

RUN = re.compile("[A-Za-zÀ-ÿ]{%d,}" % SHORTEST)
NO_RUN = re.compile("[^A-Za-zÀ-ÿ]")
ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def pieces(text: str) -> Iterator[str]:
    at = 0
    while len(text) - at > PIECE:
        cut = NO_RUN.search(text, at + PIECE)
        end = cut.end() if cut else len(text)
        yield text[at:end]
        at = end
    yield text[at:]


def altered(run: str, seed: int, modulus: int) -> str:
    """The run without one code point if its crc32, begun from `seed`, is a multiple of modulus."""
    h = zlib.crc32(run.encode(), seed)
    return run if h % modulus else run[: h % len(run)] + run[h % len(run) + 1 :]


def counts(rows: Iterator[Counter]) -> Iterator[pa.RecordBatch]:
    """Sums of counters as (key, n) rows, sent on in parts."""
    held: Counter = Counter()

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["key", "n"])

    for counter in rows:
        held.update(counter)
        if len(held) > HELD:
            yield batch()
            held = Counter()
    if held:
        yield batch()


def words_of(documents: DataFrame, modulus: int | None = None) -> DataFrame:
    """(word, n) of all words of SHORTEST code points or more that occur OCCURRENCES times or more in all texts.

    With a modulus, a run of the texts whose crc32 after `<doc_id>:` it divides loses one code point first.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def texts():
            for batch in slices(batches, 200):
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                    seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                    for piece in pieces(text or ""):
                        found: Counter = Counter()
                        for run, n in Counter(RUN.findall(piece)).items():
                            low = run.lower() if run.isascii() else run.translate(ASCII_LOWER)
                            word = altered(low, seed, modulus) if modulus else low
                            if len(word) >= SHORTEST:
                                found[word] += n
                        yield found

        tidy()
        yield from counts(texts())

    rows = documents.select("doc_id", "text").mapInArrow(each, "key string, n long")
    return rows.groupBy(F.col("key").alias("word")).agg(F.sum("n").alias("n")).where(F.col("n") >= OCCURRENCES)


def marked(word: str) -> str:
    return f"\x02{word}\x03"


def frequent_grams(words: DataFrame) -> dict[str, int]:
    """Grams that are frequent, with the number of words that hold them; counted over all words."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def grams():
            for batch in batches:
                for word in batch.column("word").to_pylist():
                    text = marked(word)
                    yield Counter({text[a : a + q] for q in range(LEAST, MOST + 1) for a in range(len(text) - q + 1)})

        tidy()
        yield from counts(grams())

    least = max(FEWEST, -(-words.count() // SHARE))
    found = words.select("word").mapInArrow(each, "key string, n long").groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    return {r.key: r.n for r in found.collect()}


def decompose(word: str, frequent: dict[str, int]) -> tuple[list[str], int]:
    """The word's variable grams, one from each place, and the most of them that one edit affects."""
    text, grams = marked(word), []
    change = [0] * (len(text) + 1)
    for a in range(len(text) - LEAST + 1):
        b = a + LEAST
        while b < len(text) and b - a < MOST and text[a:b] in frequent:
            b += 1
        grams.append(text[a:b])
        change[a] += 1
        change[b] -= 1
    over, bound = 0, 0
    for i, c in enumerate(change[:-2]):  # the last mark isn't edited, and the first begins no run of more
        over += c
        bound = max(bound, over)
    return grams, bound


def first_grams(word: str, frequent: dict[str, int]) -> list[tuple[int, str, int]]:
    """(words that hold it, or 0 if rare; gram; its number among equal grams): the first bound + 1, rarest first."""
    grams, bound = decompose(word, frequent)
    seen: Counter = Counter()
    out = []
    for gram in grams:
        out.append((frequent.get(gram, 0), gram, seen[gram]))
        seen[gram] += 1
    return sorted(out)[: bound + 1]


def lists(words: DataFrame, frequent: dict[str, int]) -> DataFrame:
    """(list, longer, word, n): the lists to merge, by gram and by the longer word's length; list is a hash."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy()
        for batch in slices(batches, 2_000):
            keys, longer, at = [], [], []
            for i, word in enumerate(batch.column("word").to_pylist()):
                for held, gram, number in first_grams(word, frequent):
                    for size in (len(word), len(word) + 1):
                        seed = f"{gram}{number}:{size}"
                        if held <= LIST_WORDS:
                            ends = {seed}
                        elif size > len(word):
                            ends = {f"{seed}:{word}"}
                        else:
                            ends = {f"{seed}:{word[:j]}{word[j + 1 :]}" for j in range(len(word))}
                        for end in ends:
                            keys.append(xxhash.xxh64_intdigest(end.encode()) - (1 << 63))
                            longer.append(size)
                            at.append(i)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(longer, pa.int32()), batch.column("word").take(at := pa.array(at, pa.int32())), batch.column("n").take(at)], names=["list", "longer", "word", "n"])

    return words.select("word", "n").mapInArrow(each, "list long, longer int, word string, n long")


def near(a: str, b: str) -> bool:
    """Whether one inserted, deleted or replaced code point makes one the other."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def verified(words: list[str], longer: int) -> set[tuple[int, int]]:
    """Places of near words, the longer of which has `longer` code points."""
    full = [i for i, w in enumerate(words) if len(w) == longer]
    short = {w: i for i, w in enumerate(words) if len(w) == longer - 1}
    if len(words) <= SMALL:
        found = {(i, j) for k, i in enumerate(full) for j in full[:k] if near(words[i], words[j])}
        return found | {(i, j) for i in full for w, j in short.items() if near(words[i], w)}
    found, left = set(), defaultdict(list)
    for i in full:
        word = words[i]
        for j in range(longer):
            rest = word[:j] + word[j + 1 :]
            if rest in short:
                found.add((i, short[rest]))
            others = left[j, rest]
            found.update((i, other) for other in others)
            others.append(i)
    return found


def near_pairs(words: DataFrame, frequent: dict[str, int]) -> DataFrame:
    """(word, n, other, other_n), once each: all near words."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy()
        key, held, out = None, {}, []

        def close():
            names = list(held)
            for i, j in verified(names, key[1]) if len(names) > 1 else ():
                a, b = sorted((names[i], names[j]))
                out.append((a, held[a], b, held[b]))

        def flush():
            cols = list(zip(*out))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.string(), pa.int64()))], names=["word", "n", "other", "other_n"])

        for batch in slices(batches, 10_000):
            for now, size, word, n in zip(*(c.to_pylist() for c in batch.columns)):
                if (now, size) != key:
                    close()
                    key, held = (now, size), {}
                held[word] = n
            if out:
                yield flush()
                out = []
        close()
        if out:
            yield flush()

    rows = lists(words, frequent).repartition("list", "longer").sortWithinPartitions("list", "longer")
    return rows.mapInArrow(each, "word string, n long, other string, other_n long").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words that have a form: the last of the forms from word to word.

    Counts grow tenfold from form to form, so that chains are short; each round doubles what is followed.
    """
    now = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        followed = materialize(now.join(on, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "roots")
        now = followed.select("word", "root")
        if followed.where("moved").isEmpty():
            return now


def group_variants(documents: DataFrame, modulus: int | None = None) -> DataFrame:
    """word, n, n_near, form, form_n, root of all words (see `words_of`)."""
    words = materialize(words_of(documents, modulus), "words")
    pairs = materialize(near_pairs(words, frequent_grams(words)), "near")
    both = pairs.union(pairs.select("other", "other_n", "word", "n"))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form"))).alias("best"))
    known = materialize(words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n")), "best")
    common = F.col("form_n") >= TIMES * F.col("n")
    known = known.withColumns({"form": F.when(common, F.col("form")), "form_n": F.when(common, F.col("form_n"))})
    found = roots(known.where("form IS NOT NULL"))
    return known.join(found, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
