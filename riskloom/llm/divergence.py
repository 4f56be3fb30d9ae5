"""Quality rules: repetition and length guards, and the divergence of a document from its language.

A document's histograms of character classes and of its language's most common words are compared with those
of the whole language by Jensen-Shannon distance (square root of the divergence to base 2, 0 to 1). Documents
under a minimum length are judged by the base rules alone, since short histograms are noise.

Everything is DataFrame functions. Words are handled in arrays inside the row, so that no word is shuffled but
for the count of common words, which is summed up before its exchange. Repeated three-word windows are found by
sorting numbers that hold the window's hash above its place; those that meet are then compared word by word.

Defined results: null and empty texts have no words and fail the base rule; very long texts are judged whole, in one
row's arrays; equal texts of one language get equal results; a null language counts as the empty string; words of equal count are taken in their order; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import WORD, small, text_or_empty
from riskloom.session import checkpointed

COMMON, MIN_WORDS, MIN_CHARS = 16, 100, 400
MAX_CHAR_DISTANCE, MAX_WORD_DISTANCE = 0.3, 0.45
CLASSES = ("lower", "upper", "digit", "space", "symbol", "other")
SPACE = "[\\x20\\x09-\\x0D]+"


def only(pattern: str) -> Column:
    """Number of characters of a class, given by a pattern of the runs of all others."""
    return F.char_length(F.regexp_replace("t", pattern, "")).cast("long")


def repeated_words(df: DataFrame) -> DataFrame:
    """n_repeat_words: words in three-word windows that occur twice or more. Needs the array ``words``.

    Each step is a projection of its own: arrays that a function looks into by place must be finished columns.
    """
    df = df.withColumn("h", F.transform("words", lambda w: F.xxhash64(w)))
    df = df.withColumn("n", F.size("h")).withColumn("low", (F.pow(F.lit(2.0), F.ceil(F.log2(F.col("n") + 2))) - 1).cast("long"))
    heads = F.slice("h", 1, F.greatest(F.col("n") - 2, F.lit(0)))
    df = df.withColumn("k", F.transform(heads, lambda x, i: F.xxhash64(x, F.get("h", i + 1), F.get("h", i + 2)).bitwiseAND(F.bitwise_not("low")).bitwiseOR(i.cast("long"))))
    df = df.withColumn("k", F.sort_array("k")).drop("h")
    high = lambda x: x.bitwiseAND(F.bitwise_not("low"))
    near = lambda x, i, d: F.coalesce(high(F.get("k", i + d)) == high(x), F.lit(False))
    df = df.withColumn("at", F.filter("k", lambda x, i: near(x, i, -1) | near(x, i, 1))).withColumn("at", F.transform("at", lambda x: x.bitwiseAND(F.col("low")).cast("int"))).drop("k")
    # windows that share a hash are compared by their words, which hold no space
    same = F.transform("at", lambda p: F.struct(F.concat_ws(" ", F.get("words", p), F.get("words", p + 1), F.get("words", p + 2)).alias("w"), p.alias("p")))
    df = df.withColumn("at", F.sort_array(same))
    equal = lambda x, i, d: F.coalesce(F.get("at", i + d)["w"] == x["w"], F.lit(False))
    df = df.withColumn("at", F.filter("at", lambda x, i: equal(x, i, -1) | equal(x, i, 1))).withColumn("at", F.sort_array(F.transform("at", lambda x: x["p"].cast("long"))))
    step = F.transform("at", lambda p, i: F.least(F.lit(3).cast("long"), F.coalesce(F.get("at", i + 1) - p, F.lit(3).cast("long"))))
    return df.withColumn("n_repeat_words", F.aggregate(step, F.lit(0).cast("long"), lambda a, x: a + x)).drop("at", "low", "n")


def with_words(docs: DataFrame) -> DataFrame:
    df = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("language"), text_or_empty().alias("t"))
    return df.withColumn("words", F.array_remove(F.split("t", SPACE), ""))


def common_words(docs: DataFrame, count: int) -> DataFrame:
    """The most frequent words of each language: one row per language."""
    words = with_words(docs).select("language", F.explode("words").alias("word")).groupBy("language", "word").agg(F.count(F.lit(1)).alias("n"))
    top = Window.partitionBy("language").orderBy(F.col("n").desc(), "word")
    words = words.withColumn("place", F.row_number().over(top)).where(F.col("place") <= count)
    return words.groupBy("language").agg(F.transform(F.sort_array(F.collect_list(F.struct("place", "word"))), lambda x: x["word"]).alias("common"))


def counted(docs: DataFrame, common: DataFrame, count: int) -> DataFrame:
    """Base columns and both histograms of every document."""
    df = repeated_words(with_words(docs).join(common, "language", "left"))
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(WORD))
    df = df.withColumns({
        "n_words": F.size("words").cast("long"),
        "word_chars": F.char_length(F.array_join("words", "")).cast("long"),
        "n_chars": F.char_length("t").cast("long"),
        "n_symbols": only("[^#*$%&|<>]+"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "lower": only("\\P{Ll}+"),
        "upper": only("\\P{Lu}+"),
        "digit": only("[^0-9]+"),
        # the place of each word among the common ones, in order; 0 for all others
        "places": F.sort_array(F.transform("words", lambda w: F.coalesce(F.array_position("common", w), F.lit(0).cast("long")))),
    }).drop("words", "t", "common")
    first = F.array(*[F.array_position("places", k) for k in range(1, count + 1)])
    df = df.withColumn("first", first)
    # a word's count reaches from its first place to that of the next word there is
    here = []
    for k in range(1, count + 1):
        rest = F.array_min(F.filter(F.slice("first", k + 1, count), lambda x: x > 0)) if k < count else F.lit(None).cast("long")
        mine = F.get("first", F.lit(k - 1))
        here.append(F.when(mine > 0, F.coalesce(rest, F.col("n_words") + 1) - mine).otherwise(F.lit(0).cast("long")))
    df = df.withColumn("word_counts", F.array(*here)).drop("places", "first")
    spaces = F.col("n_chars") - F.col("word_chars")
    known = F.col("lower") + F.col("upper") + F.col("digit") + F.col("n_symbols") + spaces
    df = df.withColumn("char_counts", F.array(F.col("lower"), F.col("upper"), F.col("digit"), spaces, F.col("n_symbols"), F.col("n_chars") - known)).drop("lower", "upper", "digit")
    return df.withColumn("word_counts", F.concat("word_counts", F.array(F.col("n_words") - F.aggregate("word_counts", F.lit(0).cast("long"), lambda a, x: a + x))))


def shares(counts: str) -> Column:
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)
    return F.transform(counts, lambda x: F.when(total > 0, x / total).otherwise(F.lit(0.0)))


def js_distance(p: str, q: str) -> Column:
    """Jensen-Shannon distance of two histograms of shares."""
    part = lambda x, m: F.when((x > 0) & (m > 0), x * F.log2(x / m)).otherwise(F.lit(0.0))
    terms = F.zip_with(p, q, lambda x, y: part(x, (x + y) / 2) + part(y, (x + y) / 2))
    return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda a, x: a + x) / 2, F.lit(0.0)))


def judge(
    docs: DataFrame, *, common: int = COMMON, min_words: int = MIN_WORDS, min_chars: int = MIN_CHARS, max_char: float = MAX_CHAR_DISTANCE, max_word: float = MAX_WORD_DISTANCE
) -> DataFrame:
    """Base columns, base_failed, kept and both distances of every document."""
    lists = small(checkpointed(common_words(docs, common)))
    rows = checkpointed(counted(docs, lists, common))
    reference = rows.groupBy("language").agg(
        F.array(*[F.sum(F.get("char_counts", F.lit(k))) for k in range(len(CLASSES))]).alias("all_chars"), F.array(*[F.sum(F.get("word_counts", F.lit(k))) for k in range(common + 1)]).alias("all_words")
    )
    reference = small(checkpointed(reference.select("language", shares("all_chars").alias("ref_chars"), shares("all_words").alias("ref_words"))))
    rows = rows.join(reference, "language").withColumns({"p_chars": shares("char_counts"), "p_words": shares("word_counts")})
    rows = rows.withColumns({"char_distance": js_distance("p_chars", "ref_chars"), "word_distance": js_distance("p_words", "ref_words")})
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    long_enough = (F.col("n_words") >= min_words) & (F.col("n_chars") >= min_chars)
    far = long_enough & ((F.col("char_distance") > max_char) | (F.col("word_distance") > max_word))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & ~far).alias("kept"), F.round("char_distance", 6).alias("char_distance"), F.round("word_distance", 6).alias("word_distance")
    )
