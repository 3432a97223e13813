"""Quality rules with DataFrame functions only: counted base rules, and a log-likelihood ratio of
hashed n-grams between a trusted target and the raw corpus.

Words and word pairs of every text are hashed to buckets. Their counts over all documents and over
the trusted ones give two multinomials; a bucket's weight is the logarithm of the ratio of its
smoothed probabilities, in whole millionths. A document's score is the mean weight of its n-grams. A
few foreign words do not move the mean of a long text, so a second mean takes only what weights fall
below a floor: it tells how much of a text is all but unknown to the target. Sums of whole numbers do
not depend on their order, so the thresholds are the same everywhere.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidebook.session import materialize

BUCKETS = 1 << 20
PAIR_FACTOR = 31
# Added to a bucket's count in the target, and to the count expected from the raw corpus.
SMOOTHING = 1.0
SCALE = 1_000_000
# Least mean log-likelihood ratio, in millionths. Chosen on labels that were held back: good documents
# of which the target holds no copy score lower than trusted ones.
LEAST_SCORE = -380_000
# Weights below the floor count for the second mean, by as much as they are below it, and the least
# mean. Chosen on held-back labels too: a word in fifty that the target never has is too much.
FLOOR = -2_000_000
LEAST_FOREIGN = -12_000
# The trusted target: at most so many labelled documents, by the hash of their ids (broadcast).
TRUSTED_DOCUMENTS = 100_000
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
SYMBOLS = "#*$%&|<>"
BLANKS = r"[\x20\x09-\x0D]+"
A_WORD = r"[^\x20\x09-\x0D]"

# A position of a word and the upper bits of a window's hash share a long up to this many words.
POSITION_BITS = 20


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS), "")


def _grams(docs: DataFrame, *keep: str) -> DataFrame:
    """One line for each of ``words``: kept columns, ``word`` and ``pair``, the buckets of the word and
    of it with the next one; a row without words has one line of nulls.

    The next word is read from the row's own array, so neither pairs nor hashes are put into arrays.
    """
    each = docs.select("words", *keep, F.posexplode_outer("words").alias("i", "this"))
    this, following = (F.crc32(w.cast("binary")) for w in (F.col("this"), F.get("words", F.col("i") + 1)))
    return each.select(*keep, _bucket(this).alias("word"), _bucket(this * PAIR_FACTOR + following).alias("pair"))


def _bucket(gram: Column) -> Column:
    return (gram % BUCKETS).cast("int")


def trusted_ids(labels: DataFrame, limit: int = TRUSTED_DOCUMENTS) -> DataFrame:
    """Ids of documents labelled good and not toxic."""
    good = labels.filter("quality = 1 AND toxic = 0 AND doc_id IS NOT NULL").select("doc_id").distinct()
    return good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def bucket_weights(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """(bucket, weight) of the buckets whose weight is not 0, at most BUCKETS rows. Counts cover all
    documents and are written, so that their totals and the weights need one pass over the texts."""
    flagged = docs.select("doc_id", "text").join(F.broadcast(trusted.withColumn("good", F.lit(1))), "doc_id", "left")
    worded = flagged.select(_words(F.col("text")).alias("words"), F.coalesce("good", F.lit(0)).alias("good"))
    grams = _grams(worded, "good").select("good", F.explode(F.array("word", "pair")).alias("bucket"))
    counted = grams.filter("bucket IS NOT NULL").groupBy("bucket").agg(F.count("*").alias("raw"), F.sum("good").alias("target"))
    counts = materialize(counted, "bucket_counts")
    n_raw, n_target = counts.agg(F.coalesce(F.sum("raw"), F.lit(0)), F.coalesce(F.sum("target"), F.lit(0))).first()
    expected = F.col("raw").cast("double") * F.lit(float(n_target)) / F.lit(float(max(n_raw, 1)))
    weight = F.round(F.log((F.col("target") + SMOOTHING) / (expected + SMOOTHING)) * SCALE).cast("long")
    return counts.select("bucket", weight.alias("weight")).filter("weight != 0")


def _repeated_words(words: str, windows: str) -> Column:
    """Words in 3-word windows whose hash is found twice or more; both are column names."""
    mask = (1 << POSITION_BITS) - 1

    def covered(places: Column) -> Column:
        start = F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n"))
        return F.aggregate(
            places, start,
            lambda s, p: F.struct(p.alias("last"), (s["n"] + F.least(F.lit(3), p - s["last"])).alias("n")),
            lambda s: s["n"],
        )

    def places(ordered: Column, same, place) -> Column:
        both = F.zip_with(
            ordered, F.slice(ordered, 2, F.size(windows)),
            lambda a, b: F.when(b.isNotNull() & same(a, b), F.array(place(a), place(b))),
        )
        return F.array_sort(F.array_distinct(F.flatten(F.filter(both, lambda x: x.isNotNull()))))

    packed = F.array_sort(
        F.transform(windows, lambda h, i: h.bitwiseAND(F.lit(~mask)).bitwiseOR(i.cast("long")))
    )

    def at(x: Column) -> Column:
        return x.bitwiseAND(F.lit(mask)).cast("int")

    def alike(a: Column, b: Column) -> Column:
        return (F.shiftright(a, POSITION_BITS) == F.shiftright(b, POSITION_BITS)) & (F.get(windows, at(a)) == F.get(windows, at(b)))

    listed = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    short = covered(places(packed, alike, at))
    long = covered(places(listed, lambda a, b: a["h"] == b["h"], lambda x: x["i"]))
    repeats = F.size(F.array_distinct(windows)) < F.size(windows)
    return F.when(~repeats, 0).when(F.size(windows) <= mask, short).otherwise(long).cast("long")


def _base(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with words and the counted columns."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(A_WORD))
    windows = F.transform(
        F.when(F.size("words") > 2, F.sequence(F.lit(0), F.size("words") - 3)).otherwise(F.array().cast("array<int>")),
        lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)),
    )
    counted = docs.withColumn("words", _words(F.col("text"))).withColumn("lines", lines).withColumn("windows", windows)
    return counted.select(
        "doc_id",
        "words",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeated_words("words", "windows").alias("n_repeat_words"),
    )


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, n_grams, score, foreign, kept.

    Words are runs without blanks, unchanged; a null or empty text has none and fails the base
    rules, as every text of fewer than 50 words does, or with more than half of its words in
    repeated 3-word windows. ``score`` is the mean log-likelihood ratio, 0 without n-grams or
    without trusted documents; ``foreign`` is the mean of what weights fall below -2. ``kept`` needs
    a score of at least -0.38 and at least -0.012 of ``foreign``. Repeated rows are judged alike;
    labels that are null, repeated or of unknown ids are harmless. Other columns are ignored.
    """
    # At most BUCKETS weights, whatever the corpus. The n-grams of a row are added up in the task
    # that reads it; one line per row is shuffled, with the columns counted before.
    weights = bucket_weights(docs, trusted_ids(labels))
    base = _base(docs.select("doc_id", "text")).withColumn("row", F.monotonically_increasing_id())
    keys = [c for c in base.columns if c != "words"]
    weighed = _grams(base, *keys)
    for gram in ("word", "pair"):
        weighed = weighed.join(F.broadcast(weights.toDF(gram, f"{gram}_weight")), gram, "left")

    def both(value: Callable[[Column], Column]) -> Column:
        return F.sum(sum(F.coalesce(value(F.col(f"{gram}_weight")), F.lit(0)) for gram in ("word", "pair")))

    scored = weighed.groupBy(*keys).agg(
        (F.count("word") + F.count("pair")).alias("n_grams"),
        both(lambda w: w).alias("total"),
        both(lambda w: F.least(w - FLOOR, F.lit(0))).alias("foreign"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    enough = (F.col("total") >= LEAST_SCORE * F.col("n_grams")) & (F.col("foreign") >= LEAST_FOREIGN * F.col("n_grams"))

    def mean(sums: str) -> Column:
        return F.when(F.col("n_grams") > 0, F.col(sums) / (F.col("n_grams") * float(SCALE))).otherwise(F.lit(0.0))

    return scored.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"),
        "n_grams",
        mean("total").alias("score"),
        mean("foreign").alias("foreign"),
        (~failed & enough).alias("kept"),
    )
