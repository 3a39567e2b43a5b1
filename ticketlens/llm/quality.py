"""Quality rules: hashed n-gram log-likelihood ratio (DataFrame functions only).

Word 1- and 2-grams are hashed into cells.  One multinomial is counted over the
whole corpus, two over a trusted target, one for either half of its ids; a
document's score is the mean log-ratio of its n-grams' cells by the target half
that it is not in, so no document is held against its own words.  Every
document is held against one threshold, which is taken from the scores of the
labelled documents.

Texts meet ids once, for the target counts: a bitmap of fixed size keeps most
other rows out of that join's exchange.  Scores meet ids as narrow rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketlens.llm.common import written

#: Cells of 1- and 2-grams, the same at every size (a number per half and cell travels in the plan).
CELLS = 1 << 17
#: Halves of the target, by the id's hash.
FOLDS = 2
#: Bits of the bitmap of trusted ids: 8 MB at most, however many ids there are.
ID_BITS = 1 << 26
#: Weights are whole numbers of this part of a nat, so sums do not depend on their order.
GRAIN = 1024
#: Documents are kept from this mean log-ratio on (natural logarithm) where no labelled one has a score.
THRESHOLD = -0.08
SMOOTHING = 1.0
MIN_WORDS = 50
_LONG_LIST = 16
_BITS_A_ROW = 8 * 4096  # of Spark's bitmap functions


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), "[ \\t-\\r]+"), "")


def _pairs(left: Column, right: Column, f: Callable[[Column, Column], Column]) -> Column:
    """f over neighbours; a lambda sees its two elements only, so nothing is evaluated again for each of them."""
    return F.zip_with(left, right, f)


def _tail(array: Column, start: int) -> Column:
    return F.slice(array, start, F.size(array))


def with_repeated_words(rows: DataFrame, grams: str, to: str, width: int = 3) -> DataFrame:
    """Adds ``to``: words in windows (their hashes by position: ``grams``) that occur twice or more in the row.

    Rows without a repeat are told by a hash set; rows with a few repeated
    windows look them up, the others sort (window, position), so the cost
    stays near-linear in the length of the text.
    """
    ordered = F.array_sort(F.col(grams))
    repeats = F.array_distinct(F.array_compact(_pairs(ordered, _tail(ordered, 2), lambda a, b: F.when(a == b, a))))
    none = F.array().cast("array<bigint>")
    rows = rows.withColumn("__twice", F.when(F.size(F.array_distinct(grams)) == F.size(grams), none).otherwise(repeats))
    few = F.array_compact(F.transform(grams, lambda x, i: F.when(F.array_contains("__twice", x), i)))
    placed = F.array_sort(F.transform(grams, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    rows = rows.withColumn("__sorted", F.when(F.size("__twice") > _LONG_LIST, placed))
    p = F.col("__sorted")
    next_same = _pairs(p, _tail(p, 2), lambda a, b: F.coalesce(a["x"] == b["x"], F.lit(False)))
    last_same = F.slice(F.concat(F.array(F.lit(False)), next_same), 1, F.size(p))
    hit = _pairs(next_same, last_same, lambda a, b: a | b)
    many = F.array_sort(F.array_compact(_pairs(p, hit, lambda x, h: F.when(h, x["i"]))))

    def covered(at: Column) -> Column:
        """Words under windows that start at the ascending positions."""
        return F.aggregate(
            at,
            F.struct(F.lit(0).alias("n"), F.lit(-width).alias("last")),
            lambda a, p: F.struct((a["n"] + F.least(F.lit(width), p - a["last"])).alias("n"), p.alias("last")),
            lambda a: a["n"],
        )

    found = F.when(F.size("__twice") == 0, F.lit(0)).when(F.size("__twice") <= _LONG_LIST, covered(few)).otherwise(covered(many))
    return rows.withColumn(to, found.cast("long")).drop("__twice", "__sorted")


def _cells(hashes: str, n: int = CELLS) -> Column:
    """Cell of every 1- and 2-gram; the last word's 2-gram ends with the text."""
    half, h = n // 2, F.col(hashes)
    one = F.transform(h, lambda x: F.pmod(x, F.lit(half)).cast("int"))
    two = _pairs(h, _tail(h, 2), lambda a, b: (F.pmod(F.xxhash64(a, b), F.lit(half)) + half).cast("int"))
    return F.concat(one, two)


def fold_of(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(FOLDS)).cast("int")


def rows_of(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The rows whose ``key`` is among the ids (column __t, distinct, not null).

    The ids' hashes as a bitmap of ID_BITS bits go to every task, so few other
    rows are exchanged; with very many ids the bitmap lets more of them through.
    """

    def place(k: Column) -> Column:
        return F.pmod(F.xxhash64(k), F.lit(ID_BITS)) + 1

    at = place(F.col("__t"))
    bits = ids.select(F.bitmap_bucket_number(at).alias("__row"), F.bitmap_bit_position(at).alias("p")).groupBy("__row").agg(F.bitmap_construct_agg("p").alias("__bits"))
    bit = F.pmod(place(F.col(key)) - 1, F.lit(_BITS_A_ROW)).cast("int")
    byte = F.conv(F.hex(F.substring(F.col("__bits"), F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    near = rows.join(F.broadcast(bits), F.bitmap_bucket_number(place(F.col(key))) == F.col("__row"))
    near = near.where(F.call_function("shiftright", byte, F.pmod(bit, F.lit(8))).bitwiseAND(F.lit(1)) == 1).select(*rows.columns)
    # not a semi join, which the optimizer would move below the bitmap's
    return near.join(ids.hint("shuffle_hash"), near[key] == ids["__t"]).select(*rows.columns)


def log_ratios(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> list[int]:
    """log(target share / corpus share) of every cell, in 1 / GRAIN nats, for documents of each fold in turn.

    Corpus counts are taken over all documents, target counts over all whose
    id is trusted (column doc_id) and of another fold; the driver gets one
    number per cell and count.
    """
    ids = trusted.select(F.col("doc_id").alias("__t")).where("__t is not null").distinct()
    given = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))

    def counted(rows: DataFrame) -> DataFrame:
        hashed = rows.select(fold_of(F.col("__id")).alias("fold"), F.transform(words(F.col("__text")), lambda w: F.xxhash64(w)).alias("hashes"))
        return hashed.select("fold", F.explode(_cells("hashes")).alias("cell"))

    def numbers(rows: DataFrame, *keys: str) -> dict[str, np.ndarray]:
        found = rows.groupBy(*keys).count().toArrow()
        return {c: found[c].to_numpy() for c in found.column_names}

    target = np.zeros((FOLDS, CELLS))
    found = numbers(counted(rows_of(given, ids, "__id")), "fold", "cell")
    target[found["fold"], found["cell"]] = found["count"]
    if not target.any():
        return [0] * (FOLDS * CELLS)
    corpus = np.zeros(CELLS)
    found = numbers(counted(given), "cell")
    corpus[found["cell"]] = found["count"]

    def share(counts: np.ndarray) -> np.ndarray:
        return np.log((counts + SMOOTHING) / (counts.sum() + SMOOTHING * CELLS))

    weights: list[int] = []
    for fold in range(FOLDS):
        others = target.sum(axis=0) - target[fold]
        weights += np.rint(GRAIN * (share(others) - share(corpus))).astype(int).tolist() if others.any() else [0] * CELLS
    return weights


def _score(ones: str, twos: str, base: str, weights: list[int]) -> Column:
    """Mean weight of the text's 1- and 2-grams (their hashes), in nats; 0 without words.  base: the fold's first weight of each half."""
    half = CELLS // 2

    def total(hashes: str, first: int) -> Column:
        """Of one half of every fold's cells; ``first`` is that half's first cell."""
        mine = [w for fold in range(FOLDS) for w in weights[fold * CELLS + first :][:half]]
        of = F.split(F.lit(",".join(map(str, mine))), ",").cast("array<int>")
        return F.aggregate(hashes, F.lit(0).cast("long"), lambda a, x: a + F.get(of, (F.pmod(x, F.lit(half)) + F.col(base)).cast("int")))

    n = F.size(ones)
    return F.when(n > 0, (total(ones, 0) + total(twos, half)) / (n * (2 * GRAIN))).otherwise(F.lit(0.0))


def between(good: dict[int, int], low: dict[int, int]) -> float | None:
    """The cut with the smallest sum of both classes' error rates, from rows counted by score (1 / GRAIN nats).

    It is the middle of the gap between two scores that occur, of equal cuts
    the one in the widest gap.  With one class only all its rows are on their
    side, None without any.
    """
    if not good or not low:
        return min(good) / GRAIN if good else (max(low) + 1) / GRAIN if low else None
    n_good, n_low = sum(good.values()), sum(low.values())
    at = sorted({*good, *low})
    lost, passed, best = 0, n_low, None
    for a, b in zip(at, at[1:]):
        lost, passed = lost + good.get(a, 0), passed - low.get(a, 0)
        cut = (lost * n_low + passed * n_good, a - b, a)
        best = min(best or cut, cut)
    return (2 * best[2] - best[1]) / (2 * GRAIN) if best else at[0] / GRAIN


def threshold_of(scored: DataFrame, trusted: DataFrame, rejected: DataFrame | None) -> float:
    """The threshold between the labelled rows of ``scored`` (id, n, score) that are long enough for the base rules.

    Only ids and whole-numbered scores meet the labels; the driver gets one row per score.
    """
    labels = trusted.select(F.col("doc_id").alias("__t"), F.lit(1).alias("good"))
    if rejected is not None:
        labels = labels.union(rejected.select("doc_id", F.lit(0)))
    at = scored.where(F.col("n") >= MIN_WORDS).select("id", F.floor(F.col("score") * GRAIN).alias("at"))
    found: tuple[dict, dict] = ({}, {})
    for r in at.join(labels.distinct(), F.col("id") == F.col("__t")).groupBy("good", "at").count().collect():
        found[r["good"]][r["at"]] = r["count"]
    cut = between(found[1], found[0])
    return THRESHOLD if cut is None else cut


def judge(
    docs: DataFrame,
    trusted: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float | None = None,
    to: str = "quality",
    rejected: DataFrame | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """The input's ``columns`` (all of them) with the struct ``to``: counts, base_failed, score and kept.

    A null or empty text has no words (all counts 0) and fails the base rules.
    The score of a text without words is 0.  Without trusted documents every
    score is 0 and the base rules alone decide.  Rows that repeat an id and a
    text are judged alike.  The threshold lies between the trusted rows and the
    ``rejected`` ones (ids of low quality, column doc_id); without these it is
    the lowest trusted score.  Where it is not given, the scored rows are
    written in the shared checkpoint folder, as both the threshold and the
    verdict follow from them.
    """
    columns = [c for c in (docs.columns if columns is None else columns) if c != to]
    weights = log_ratios(docs, trusted, id_col, text_col)
    # the caller's columns travel in a struct, so none of them meets a helper's name
    rows = docs.select(F.struct(F.lit(0).alias("any"), *columns).alias("given"), F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), (fold_of(F.col(id_col)) * (CELLS // 2)).alias("base"))
    lines = F.filter(F.split("text", "\\n"), lambda x: F.regexp_like(x, F.lit("[^ \\t-\\r]")))
    rows = rows.withColumn("w", words(F.col("text"))).withColumn("l", lines).withColumn("n", F.size("w"))
    rows = rows.withColumn("h", F.transform("w", lambda w: F.xxhash64(w)))
    h = F.col("h")
    rows = rows.withColumn("two", _pairs(h, _tail(h, 2), lambda a, b: F.xxhash64(a, b)))
    grams = F.slice(_pairs(F.col("two"), _tail(h, 3), lambda a, b: F.xxhash64(a, b)), 1, F.greatest(F.col("n") - 2, F.lit(0)))
    rows = with_repeated_words(rows.withColumn("g", grams), "g", "r")
    scored = rows.select(
        "given",
        "id",
        "n",
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        "r",
        _score("h", "two", "base", weights).alias("score") if any(weights) else F.lit(0.0).alias("score"),
    )
    if threshold is None and any(weights):
        scored = written(scored, "quality")
        threshold = threshold_of(scored, trusted, rejected)
    elif threshold is None:
        threshold = THRESHOLD
    failed = (F.col("n") < MIN_WORDS) | (F.col("r") * 100 > F.col("n") * 50)
    judged = F.struct(
        F.col("n").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        F.col("r").alias("n_repeat_words"),
        failed.alias("base_failed"),
        "score",
        (~failed & (F.col("score") >= threshold)).alias("kept"),
    )
    return scored.select(*[F.col("given")[c].alias(c) for c in columns], judged.alias(to))


def keep(docs: DataFrame, trusted: DataFrame, **options: object) -> DataFrame:
    """The documents whose verdict is "kept"; same columns.

    The filter also asks for a row number, which keeps the optimizer from
    moving it below the verdict's steps and computing them again in each other.
    """
    verdict = "__verdict"
    while verdict in docs.columns:
        verdict += "_"
    judged = judge(docs, trusted, to=verdict, **options).select("*", F.monotonically_increasing_id().alias(verdict + "_row"))
    return judged.where((F.col(verdict)["kept"]) & (F.col(verdict + "_row") >= 0)).select(*docs.columns)
