"""Quality rules: base statistics, then a hashed n-gram log-likelihood ratio.

Two multinomials over hashed word n-grams (words and pairs of neighbours) are
compared: one of trusted target documents, one of the whole raw corpus. A
document's score is the mean over its n-grams of ln(target / raw), so long and
short texts meet one threshold. Every document is judged by that threshold alone;
nothing is drawn at random.

Counting and scoring are column expressions. The corpus passes once through
partial sums into ``BUCKETS`` counters; the two multinomials, of that fixed size,
return to the scan as one constant array.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicksieve.functions.unfold import bind, unfold
from clicksieve.llm.common import replace_columns, words_of

SYMBOLS = "#*$%&|<>"  # fixed value
BUCKETS = 1 << 16
TRUSTED_DOCS = 20_000  # labelled documents the target multinomial is counted on, by least hash of their id
SMOOTH = 1.0
THRESHOLD = -0.08
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
SPAN = 5


def repeat_words(hashes: Column, span: int = SPAN) -> Column:
    """Words inside windows of ``span`` words that occur twice or more in the text.

    Equal windows are neighbours once their hashes are sorted. Only texts that
    have some are sorted; the union of their windows is counted along the text.
    """
    windows = F.when(F.size(hashes) >= span, F.transform(
        F.sequence(F.lit(0), F.size(hashes) - span), lambda i: F.xxhash64(*[hashes[i + k] for k in range(span)])))

    def covered(starts: Column) -> Column:
        gaps = F.transform(starts, lambda s, k: F.least(
            F.lit(span), F.coalesce(F.try_element_at(starts, k + 2) - s, F.lit(span))))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, g: a + g)

    def repeated(pairs: Column) -> Column:
        same = lambda e, k: (e["h"] == F.try_element_at(pairs, k + 2)["h"]) | (
            (k > 0) & (e["h"] == F.try_element_at(pairs, F.greatest(k, F.lit(1)))["h"]))
        found = F.filter(pairs, lambda e, k: F.coalesce(same(e, k), F.lit(False)))
        return bind(F.array_sort(F.transform(found, lambda e: e["at"])), covered)

    def count(w: Column) -> Column:
        pairs = F.array_sort(F.transform(w, lambda h, k: F.struct(h.alias("h"), k.alias("at"))))
        return F.when(w.isNull() | (F.size(F.array_distinct(w)) == F.size(w)), F.lit(0).cast("long")) \
            .otherwise(bind(pairs, repeated))

    return bind(windows, count)


def base_columns(text: Column, hashes: Column) -> dict[str, Column]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed of a text."""
    plain = F.coalesce(text, F.lit(""))
    blanks = " \t\n\x0b\x0c\r"
    lines = F.filter(F.split(plain, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return {
        "n_words": F.size(hashes).cast("long"),
        "word_chars": F.length(F.translate(plain, blanks, "")).cast("long"),
        "n_symbols": (F.length(plain) - F.length(F.translate(plain, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": bind(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")),
        "n_repeat_words": repeat_words(hashes),
    }


def word_hashes(text: Column) -> Column:
    return F.transform(words_of(text), lambda w: F.xxhash64(w))


def _pair(hashes: Column, i: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(hashes[i], hashes[i + 1]), F.lit(buckets)).cast("int")


def n_grams(hashes: Column, buckets: int = BUCKETS) -> Column:
    """Bucket of each word, then of each pair of neighbours."""
    words = F.transform(hashes, lambda h: F.pmod(h, F.lit(buckets)).cast("int"))
    pairs = F.when(F.size(hashes) > 1, F.transform(
        F.sequence(F.lit(0), F.size(hashes) - 2), lambda i: _pair(hashes, i, buckets))).otherwise(F.array().cast("array<int>"))
    return F.concat(words, pairs)


def trusted_ids(labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", limit: int = TRUSTED_DOCS) -> DataFrame:
    """At most ``limit`` ids of documents labelled 1, by least hash."""
    return labels.filter((F.col(label_col) == 1) & F.col(id_col).isNotNull()).select(F.col(id_col).alias("__trusted")) \
        .distinct().orderBy(F.xxhash64("__trusted"), "__trusted").limit(limit)


def fit_ratio(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              buckets: int = BUCKETS, smooth: float = SMOOTH) -> np.ndarray:
    """ln(target / raw) of each bucket.

    ``trusted`` holds a bounded number of ids, hence the broadcast; raw counts
    cover all documents. Partial sums leave a task as one row per bucket at most,
    and ``buckets`` rows reach the driver.
    """
    marked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")) \
        .join(F.broadcast(trusted), F.col("id") == F.col("__trusted"), "left")
    grams = unfold(marked.select(F.when(F.col("__trusted").isNotNull(), 1).otherwise(0).alias("mine"),
                                 bind(word_hashes(F.col("text")), lambda h: n_grams(h, buckets)).alias("grams")),
                   ["mine"], F.col("grams"), "gram")
    sums = grams.groupBy("gram").agg(F.count("*").alias("raw"), F.sum("mine").alias("target")).toArrow()
    raw, target = np.zeros(buckets), np.zeros(buckets)
    at = sums.column("gram").to_numpy()
    raw[at], target[at] = sums.column("raw").to_numpy(), sums.column("target").to_numpy()
    if not target.sum():
        return np.zeros(buckets)
    share = lambda c: (c + smooth) / (c.sum() + smooth * buckets)
    return np.log(share(target)) - np.log(share(raw))


def constant_array(values: np.ndarray) -> Column:
    """One constant array column; the optimizer folds it before any row is read."""
    return F.split(F.lit(",".join(f"{v:.5f}" for v in values)), ",").cast("array<float>")


def ratio_score(hashes: Column, weights: Column, buckets: int) -> Column:
    """Mean weight of a text's n-grams; 0 without words."""
    total = F.aggregate(hashes, F.lit(0.0), lambda a, h: a + weights[F.pmod(h, F.lit(buckets)).cast("int")])
    pairs = F.when(F.size(hashes) > 1, F.aggregate(
        F.sequence(F.lit(0), F.size(hashes) - 2), F.lit(0.0), lambda a, i: a + weights[_pair(hashes, i, buckets)])).otherwise(F.lit(0.0))
    return F.when(F.size(hashes) > 0, (total + pairs) / (2 * F.size(hashes) - 1)).otherwise(F.lit(0.0))


def judge(docs: DataFrame, ratio: np.ndarray, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Documents with their base statistics, base_failed, ratio_score and kept.

    A null text has no words and fails the base rules, as every text under
    ``MIN_WORDS`` words does. Input columns named as the results are replaced.
    """
    text, weights = F.col(text_col), constant_array(ratio)

    def all_of(h: Column) -> Column:
        return F.struct(*[c.alias(n) for n, c in base_columns(text, h).items()],
                        ratio_score(h, weights, len(ratio)).alias("ratio_score"))

    out = docs.withColumn("__rules", bind(word_hashes(text), all_of))
    get = lambda n: F.col(f"__rules.{n}")
    failed = (get("n_words") < MIN_WORDS) | (100 * get("n_repeat_words") > MAX_REPEAT_PERCENT * get("n_words"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "ratio_score"]
    return replace_columns(out, {n: get(n) for n in names} | {
        "base_failed": failed, "kept": ~failed & (get("ratio_score") >= threshold)}).drop("__rules")
