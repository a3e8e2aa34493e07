"""Quality rules by distribution divergence, in DataFrame functions only.

Words are runs without ASCII white space. The base rules (see
``base_features``) count words, symbols, repeated lines and words in repeated
5-word windows of the whole text. The method then compares two histograms of
each document with those of its language, by Jensen-Shannon distance (base 2,
so 0 to 1):

* character classes: symbols, upper case, digits, other ASCII punctuation,
  ASCII white space, and the rest;
* common words: the ``COMMON`` most frequent lower-cased words of the language's
  documents (ties by word), and all other words together.

A language's reference sums over all its documents (a null language is one of
its own). A document is rejected where a distance exceeds its limit and the
text is long enough to tell: at least ``LEAST_CHARS`` characters, or
``LEAST_WORDS`` words. 5-word windows are compared by a 64-bit hash.

A null text has no words and fails the base rules. Null ids and languages,
repeated rows and rows that share an id are judged one by one; other columns
pass through ``filtered``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

COMMON = 24
LEAST_CHARS = 200
LEAST_WORDS = 50
CLASS_LIMIT = 0.25
WORD_LIMIT = 0.45
REPEATED = 5  # words of a window
MOST_LANGUAGES = 10_000  # of references that are broadcast (24 words and 31 numbers each)

SPACE = r"[\x20\x09-\x0D]+"
_LETTERS = "".join(chr(ord("0") + k) for k in range(COMMON + 1))  # 0: no common word
_BLANK = " \t\n\x0b\x0c\r"
_CLASSES = (r"[#*$%&|<>]", r"\p{Lu}", r"[0-9]", r"[!\x22'()+,\-./:;=?@\[\\\]^_`{}~]")
_MARKED = r"[^#*$%&|<>\p{Lu}0-9!\x22'()+,\-./:;=?@\[\\\]^_`{}~]+"


def words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(_BLANK))
    return F.when(trimmed != "", F.split(trimmed, SPACE)).otherwise(F.array().cast("array<string>"))


def common_words(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """(lang, common): the most frequent words of each language. Tasks count words
    before the shuffle, and Spark keeps each task's first COMMON of a language before
    the ranks are taken (the filter on a row number)."""
    word = docs.select(F.coalesce(lang_col, F.lit("")).alias("lang"), F.explode_outer(words(F.col(text_col))).alias("word"))
    counted = word.where("word IS NOT NULL").groupBy("lang", F.lower("word").alias("word")).agg(F.count(F.lit(1)).alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    top = counted.withColumn("rank", rank).where(F.col("rank") <= COMMON)
    ordered = F.array_sort(F.collect_list(F.struct("rank", "word")))
    return top.groupBy("lang").agg(F.transform(ordered, lambda x: x["word"]).alias("common"))


def _repeat_words(df: DataFrame) -> DataFrame:
    """Adds n_repeat_words to a frame with ``_words``."""
    span = REPEATED - 1
    df = df.withColumn("_h", F.transform("_words", lambda w: F.xxhash64(w)))
    window = lambda x, i: F.xxhash64(x, *(F.get("_h", i + j) for j in range(1, REPEATED)))
    df = df.withColumn("_h", F.when(F.size("_h") > span, F.transform(F.slice("_h", 1, F.size("_h") - span), window)).otherwise(F.array().cast("array<long>")))
    # sorted by hash only where some window occurs twice
    ranked = F.array_sort(F.transform("_h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    df = df.withColumn("_s", F.when(F.size(F.array_distinct("_h")) < F.size("_h"), ranked))
    same = lambda x, k: (F.get("_s", k - 1)["h"] == x["h"]) | (F.get("_s", k + 1)["h"] == x["h"])
    places = F.sort_array(F.transform(F.filter("_s", lambda x, k: F.coalesce(same(x, k), F.lit(False))), lambda x: x["i"]))
    start = F.struct(F.lit(-REPEATED).alias("at"), F.lit(0).cast("long").alias("n"))
    step = lambda a, i: F.struct(i.alias("at"), (a["n"] + F.least(F.lit(REPEATED), i - a["at"])).alias("n"))
    return df.withColumn("n_repeat_words", F.coalesce(F.aggregate(places, start, step, lambda a: a["n"]), F.lit(0).cast("long"))).drop("_h", "_s")


def base_features(df: DataFrame, text: Column) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and
    base_failed; and for the method ``_words`` and ``_classes`` (counts)."""
    whole = F.coalesce(text, F.lit(""))
    df = df.withColumn("_words", words(whole)).withColumn("_marked", F.regexp_replace(whole, _MARKED, ""))
    lines = F.filter(F.split(whole, "\n", -1), lambda x: F.btrim(x, F.lit(_BLANK)) != "")
    df = df.withColumn("_lines", lines).withColumn("_chars", F.length(whole).cast("long"))
    df = df.withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long")).drop("_lines")
    df = df.withColumn("n_words", F.size("_words").cast("long")).withColumn("word_chars", F.length(F.array_join("_words", "")).cast("long"))
    marked = [F.regexp_count("_marked", F.lit(c)).cast("long") for c in _CLASSES]
    df = df.withColumn("_classes", F.array(*marked, F.col("_chars") - F.col("word_chars"), F.col("word_chars") - F.length("_marked"))).drop("_marked", "_chars")
    df = _repeat_words(df.withColumn("n_symbols", F.col("_classes")[0]))
    return df.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))


def _normalised(df: DataFrame, column: str) -> DataFrame:
    """The counts of ``column`` as shares of their sum (zeros stay zeros)."""
    df = df.withColumn("_total", F.aggregate(column, F.lit(0).cast("long"), lambda a, y: a + y))
    return df.withColumn(column, F.transform(column, lambda x: F.when(F.col("_total") > 0, x / F.col("_total")).otherwise(F.lit(0.0)))).drop("_total")


def _divergence(a: Column, b: Column) -> Column:
    """Jensen-Shannon distance of two arrays of shares."""
    part = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))
    bins = F.zip_with(a, b, lambda x, y: part(x, (x + y) / 2) + part(y, (x + y) / 2))
    return F.sqrt(F.greatest(F.aggregate(bins, F.lit(0.0), lambda s, x: s + x) / 2, F.lit(0.0)))


def _beside(df: DataFrame, small: DataFrame) -> DataFrame:
    """``df`` joined with one row for each language: broadcast where few."""
    few = small.limit(MOST_LANGUAGES + 1).count() <= MOST_LANGUAGES
    return df.join(F.broadcast(small) if few else small, "lang", "left")


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row for each of ``docs``: id, lang ('' for null), mark (xxhash64 of the
    text), the base features, class_distance, word_distance, base_failed, kept."""
    common = C.stored(common_words(docs, text_col, lang_col), "common")
    df = docs.select(F.col(id_col).alias("id"), F.coalesce(lang_col, F.lit("")).alias("lang"), F.xxhash64(text_col).alias("mark"), F.col(text_col).alias("_text"))
    df = base_features(_beside(df, common), F.col("_text")).drop("_text")
    # a letter for each common word (the others: ''), joined: counting a letter is one pass over short strings
    # no word shrinks in lower case, so longer ones than the longest common word are none
    longest = F.array_max(F.transform("common", F.length))
    able = F.filter("_words", lambda w: F.length(w) <= F.col("_longest"))
    df = df.withColumn("_longest", longest).withColumn("_able", able).drop("_longest")
    letter = F.transform("_able", lambda w: F.substring(F.lit(_LETTERS), F.array_position("common", F.lower(w)).cast("int") + 1, F.lit(1)))
    df = df.withColumn("_at", F.coalesce(F.array_join(letter, ""), F.lit(""))).withColumn("_at", F.replace("_at", F.lit(_LETTERS[0]), F.lit(""))).drop("common", "_able")
    counts = [(F.length("_at") - F.length(F.replace("_at", F.lit(c), F.lit("")))).cast("long") for c in _LETTERS[1:]]
    df = df.withColumn("_hist", F.array(*counts, F.col("n_words") - F.length("_at"))).drop("_words", "_at")
    df = C.stored(df, "features")
    sums = lambda column, n: F.array(*(F.sum(F.col(column)[i]) for i in range(n)))
    reference = df.groupBy("lang").agg(sums("_classes", len(_CLASSES) + 2).alias("_ref_classes"), sums("_hist", COMMON + 1).alias("_ref_hist"))
    reference = C.stored(_normalised(_normalised(reference, "_ref_classes"), "_ref_hist"), "reference")
    chars = F.aggregate("_classes", F.lit(0).cast("long"), lambda a, x: a + x)
    df = _normalised(_normalised(_beside(df.withColumn("_chars", chars), reference), "_classes"), "_hist")
    df = df.withColumn("class_distance", _divergence(F.col("_classes"), F.col("_ref_classes"))).withColumn("word_distance", _divergence(F.col("_hist"), F.col("_ref_hist")))
    strange = ((F.col("_chars") >= LEAST_CHARS) & (F.col("class_distance") > CLASS_LIMIT)) | ((F.col("n_words") >= LEAST_WORDS) & (F.col("word_distance") > WORD_LIMIT))
    return df.withColumn("kept", ~F.col("base_failed") & ~strange).drop("_classes", "_hist", "_ref_classes", "_ref_hist", "_chars")


def filtered(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``docs`` without the rows that the rules reject."""
    found = judged(docs, id_col, text_col, lang_col).where(~F.col("kept"))
    gone = C.stored(found.select(F.col("id").alias("_wl_id"), F.col("lang").alias("_wl_lang"), F.col("mark").alias("_wl_mark")).distinct(), "rejected")
    same = docs[id_col].eqNullSafe(gone["_wl_id"]) & (F.xxhash64(docs[text_col]) == gone["_wl_mark"]) & (F.coalesce(docs[lang_col], F.lit("")) == gone["_wl_lang"])
    return docs.join(C.few(gone), same, "left_anti")
