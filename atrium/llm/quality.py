"""Quality rules: counted rules and a hashed n-gram likelihood ratio, in DataFrame functions alone.

Every document's words and pairs of neighbouring words fall into `buckets` hash buckets. Two multinomials
over the buckets are counted, one from the documents that a label trusts and one from the whole corpus, the
trusted one smoothed towards the corpus. A document's score is the mean over its n-grams of
log(p_trusted / p_corpus); it is kept if it passes the counted rules and its score reaches the threshold.

No document is scored with trusted counts of its own text, and the threshold is fitted to the scores of all
labelled documents. So a score doesn't depend on being labelled, nor the threshold on one corpus.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atrium.llm.common import SPACES, broadcast_if_small, fresh, materialize, text_or_empty

BUCKETS = 1 << 16
#: Mixes the hashes of two neighbouring words.
PAIR_FACTOR = 31
SYMBOLS = "[#*$%&|<>]"
#: Parts of the trusted documents, dealt by text; a document's score leaves its own part out.
FOLDS = 8
#: Labelled scores are counted in steps of this width.
SCORE_STEP = 0.01
FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACES), "")


def with_buckets(rows: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """rows with `grams`, the buckets of `words` and of their pairs: crc32 modulo buckets, a pair mixes both.

    The words' hashes are a column of their own: inside a lambda, they would be made again for each word.
    """
    hashed = rows.withColumn("crc", F.transform("words", lambda w: F.crc32(w.cast("binary"))))
    ones = F.transform("crc", lambda c: (c % buckets).cast("int"))
    pairs = F.zip_with("crc", F.slice("crc", F.lit(2), F.greatest(F.size("crc") - 1, F.lit(0))), lambda a, b: ((a * PAIR_FACTOR + b) % buckets).cast("int"))
    return hashed.withColumn("grams", F.concat(ones, F.filter(pairs, lambda p: p.isNotNull()))).drop("crc")


def with_counts(rows: DataFrame, text: str = "text") -> DataFrame:
    """rows with `words` and the counted features; null texts have none of anything."""
    t = text_or_empty(text)
    whole = rows.withColumn("words", words_of(t))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    windows = F.transform(
        F.slice("words", F.lit(1), F.greatest(F.size("words") - 2, F.lit(0))),
        lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2)),
    )
    whole = whole.withColumns({"lines": lines, "windows": windows})
    # Most texts repeat no window; only the others are sorted, so that equal windows are neighbours.
    ordered = F.when(
        F.size(F.array_distinct("windows")) < F.size("windows"),
        F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    )
    whole = whole.withColumn("ordered", ordered)
    same = lambda e, k: F.coalesce(F.get("ordered", k).getField("h") == e.getField("h"), F.lit(False))
    starts = F.sort_array(F.transform(F.filter("ordered", lambda e, k: same(e, k - 1) | same(e, k + 1)), lambda e: e.getField("i")))
    whole = whole.withColumn("starts", starts)
    covered = F.aggregate(
        F.transform("starts", lambda s, k: F.least(F.lit(3), F.coalesce(F.get("starts", k + 1) - s, F.lit(3)))),
        F.lit(0),
        lambda a, x: a + x,
    )
    return whole.withColumns(
        {
            "n_words": F.size("words").cast("long"),
            "word_chars": F.length(F.array_join("words", "")).cast("long"),
            "n_symbols": (F.length(t) - F.length(F.regexp_replace(t, SYMBOLS, ""))).cast("long"),
            "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
            "n_repeat_words": F.coalesce(covered, F.lit(0)).cast("long"),
        }
    ).drop("lines", "windows", "ordered", "starts")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def crossed_ratios(documents: DataFrame, trusted: DataFrame, folds: int = FOLDS, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, ratios) for every bucket: per fold, the log of how much more often its grams are trusted than all grams are.

    The share is (good + share of all) / (every + 1), with the trusted counts of the other folds: a gram that
    the corpus hardly has stays near 0 at any size, one that is common and never trusted falls far below.
    All documents and all trusted ids count; a fold whose others trust nothing has ratio 0.
    """
    marked = broadcast_if_small(trusted.select(F.col("doc_id").alias("trusted_id")))
    texts = documents.select("doc_id", "text").join(marked, F.col("doc_id") == F.col("trusted_id"), "left")
    rows = texts.select(F.when(F.col("trusted_id").isNotNull(), fold_of(text_or_empty(), folds)).alias("fold"), words_of(text_or_empty()).alias("words"))
    grams = with_buckets(rows, buckets).select("fold", F.explode("grams").alias("bucket"))
    parts = [F.count_if(F.col("fold") == f).alias(f"good{f}") for f in range(folds)]
    counted = materialize(grams.groupBy("bucket").agg(F.count("*").alias("every"), *parts), "ngram-counts")
    total, *goods = counted.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("every", *(f"good{f}" for f in range(folds))))).first()
    filled = documents.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket")).join(F.broadcast(counted), "bucket", "left").na.fill(0)
    whole = sum((F.col(f"good{f}") for f in range(folds)), F.lit(0))

    def ratio(f: int) -> Column:
        share = (sum(goods) - goods[f]) / max(total, 1)
        return F.log((whole - F.col(f"good{f}") + share) / (F.col("every") + 1.0) / share) if share else F.lit(0.0)

    return filled.select("bucket", F.array(*map(ratio, range(folds))).alias("ratios"))


def fold_of(text: Column, folds: int = FOLDS) -> Column:
    """The part that a text belongs to, by two hex digits of its md5; equal texts are in one part."""
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 2), 16, 10).cast("int") % folds).cast("int")


def fit_threshold(scored: DataFrame, verdicts: DataFrame) -> float:
    """The score that parts labelled good documents from labelled junk with the least sum of both error shares.

    scored has (doc_id, base_failed, score), verdicts (doc_id, quality); what fails the rules doesn't count.
    Of equally good scores it is the middle; without labelled junk the least score of a good document, and
    without good documents no score is too low.
    """
    labels = verdicts.select(F.col("doc_id").alias("labelled_id"), "quality").where("quality IS NOT NULL")
    known = scored.where(~F.col("base_failed")).join(labels, F.col("doc_id") == F.col("labelled_id"))
    steps = known.groupBy(F.floor(F.col("score") / SCORE_STEP).alias("step")).agg(F.count_if(F.col("quality") == 1).alias("good"), F.count_if(F.col("quality") != 1).alias("junk"))
    counts = sorted((r.step, r.good, r.junk) for r in steps.collect())
    n_good, n_junk = sum(c[1] for c in counts), sum(c[2] for c in counts)
    if not n_good:
        return -math.inf
    if not n_junk:
        return next(step for step, good, _ in counts if good) * SCORE_STEP
    # Errors are compared as whole numbers; what a cut loses and keeps is the same between two steps that occur.
    rejected, kept, errors = 0, n_junk, {}
    for step, good, junk in counts:
        errors[step] = rejected * n_junk + kept * n_good
        rejected, kept = rejected + good, kept - junk
    at = [step for step, _, _ in counts]
    last = min(reversed(at), key=errors.__getitem__)
    before = max((step + 1 for step in at if step < last), default=last)
    return (before + last) / 2 * SCORE_STEP


def scores(documents: DataFrame, ratios: DataFrame, ratio: Column, buckets: int = BUCKETS, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Each document's counted features, base_failed and score, the mean of `ratio` over its n-grams, with the columns in `carry`."""
    rows = with_counts(documents.select(*dict.fromkeys((*carry, "text"))).withColumn("row_", F.monotonically_increasing_id()))
    rows = rows.withColumn("base_failed", base_failed())
    kept_columns = [*carry, *FEATURES, "base_failed"]
    # The rules' verdict stands without the ratio, so only the other documents' n-grams are looked up.
    rows = with_buckets(rows.withColumn("words", F.when(~F.col("base_failed"), F.col("words"))), buckets)
    grams = rows.select("row_", *kept_columns, F.explode_outer("grams").alias("bucket"))
    looked = grams.join(F.broadcast(ratios), "bucket", "left")
    return looked.groupBy("row_", *kept_columns).agg(F.coalesce(F.avg(ratio), F.lit(0.0)).alias("score")).drop("row_")


def judge(documents: DataFrame, verdicts: DataFrame, folds: int = FOLDS, buckets: int = BUCKETS, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Each document's counted features, base_failed, score and kept, with the columns in `carry`.

    verdicts has (doc_id, quality), each doc_id once: 1 trusts a document, any other number calls it junk, null
    says nothing. Null texts count as empty; a document without words fails the rules and has score 0. Repeated
    rows are judged each by itself; columns beside doc_id, text and `carry` are ignored. Any text is judged
    whole, and an empty table gives an empty result. The ratios, one row per bucket, are broadcast.
    """
    ratios = crossed_ratios(documents, verdicts.where("quality = 1").select("doc_id"), folds, buckets)
    rows = documents.select(*dict.fromkeys(("doc_id", "text", *carry)))
    fold = fresh(rows, "fold")
    keyed = rows.withColumn(fold, fold_of(text_or_empty(), folds))
    columns = tuple(dict.fromkeys(("doc_id", *carry, fold)))
    scored = materialize(scores(keyed, ratios, F.get("ratios", F.col(fold)), buckets, columns), "scores")
    kept = ~F.col("base_failed") & (F.col("score") >= fit_threshold(scored, verdicts))
    return scored.withColumn("kept", kept).select(*carry, *FEATURES, "base_failed", "score", "kept")
