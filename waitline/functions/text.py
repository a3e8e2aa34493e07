"""Text column functions.

All are JVM-side expressions or MLlib transformers; no Python runs per row.
Patterns avoid look-around so the same text works in Java regex and RE2.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .stopwords import ENGLISH

# default word pattern of the reference's vectoriser: two or more word
# characters (letters, digits, underscore)
WORD_PATTERN = r"[\p{L}\p{N}_]{2,}"
# word tokeniser for lemmatised text: word runs, or one other non-space char
WORD_OR_PUNCT = r"[\p{L}\p{N}_]+|[^\s\p{L}\p{N}_]"
WORD_CHAR_CLASS = r"\p{L}\p{N}_"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def clean_tags(tags) -> Column:
    """``<c#><.net>`` -> `` c#  .net `` (H4); null stays null."""
    return F.regexp_replace(_c(tags), "<|>", " ")


def split_whitespace(text) -> Column:
    """Whitespace split without empty pieces, like ``str.split()`` (H5)."""
    return F.filter(F.split(_c(text), r"\s+"), lambda t: t != "")


def word_tokens(text, pattern: str = WORD_PATTERN, lowercase: bool = True) -> Column:
    """Tokens matching ``pattern`` in the lower-cased text (H9, word form)."""
    t = F.lower(_c(text)) if lowercase else _c(text)
    return F.regexp_extract_all(t, F.lit(pattern), 0)


def tag_tokens(text, lowercase: bool = True) -> Column:
    r"""Tokens of ``(?u)\b\S+\b`` (H9, tag form).

    Equivalent without ``\b``: split on whitespace, then trim non-word
    characters from both ends of each piece and drop what becomes empty
    (`` c#  .net  c++ `` -> ``c``, ``net``, ``c``).
    """
    t = F.lower(_c(text)) if lowercase else _c(text)
    trimmed = F.transform(
        split_whitespace(t),
        lambda p: F.regexp_replace(p, f"^[^{WORD_CHAR_CLASS}]+|[^{WORD_CHAR_CLASS}]+$", ""),
    )
    return F.filter(trimmed, lambda p: p != "")


def english_stop_words() -> tuple[str, ...]:
    """Spark's own English stop-word list (181 words), a constant of this
    package: needs neither a jar nor a JVM.

    The reference used another library's list (318 words); the list is a
    parameter everywhere it is used.
    """
    return ENGLISH


def remove_stop_words(
    df: DataFrame, input_col: str, output_col: str, words: Sequence[str] | None = None
) -> DataFrame:
    """Drop stop words from an array column (H11) with MLlib's hash-set
    remover (one lookup per token, not a scan of the list)."""
    from pyspark.ml.feature import StopWordsRemover

    r = StopWordsRemover(
        inputCol=input_col,
        outputCol=output_col,
        stopWords=list(words if words is not None else english_stop_words()),
        caseSensitive=True,
    )
    return r.transform(df)


def explode_array(df: DataFrame, keys, arr, out: str = "token", pos: str | None = None) -> DataFrame:
    """Rows of a computed array, one per element (optionally with a 1-based
    position).

    Uses the ``_outer`` generators plus a null filter on the output: with a
    plain ``explode`` Catalyst infers a ``size(arr) > 0`` filter *below* the
    generator, which re-evaluates the whole array expression (regex, stop
    words, n-grams) a second time per row.
    """
    a = F.col(arr) if isinstance(arr, str) else arr
    if pos is None:
        g = df.select(*keys, F.explode_outer(a).alias(out))
    else:
        g = df.select(*keys, F.posexplode_outer(a).alias(pos, out)).withColumn(
            pos, (F.col(pos) + 1).cast("bigint")
        )
    return g.where(F.col(out).isNotNull())


def _gram_at(t: Column, n: int):
    def at(i: Column) -> Column:
        return F.array_join(F.slice(t, i, n), " ")

    return at


def ngrams(tokens, n_min: int = 1, n_max: int = 1) -> Column:
    """All n-grams for n in [n_min, n_max], grouped by n then position, words
    joined by a space (H12), as the reference's vectoriser lists them."""
    t = _c(tokens)
    parts = []
    for n in range(n_min, n_max + 1):
        if n == 1:
            parts.append(t)
            continue
        idx = F.sequence(F.lit(1), F.greatest(F.size(t) - n + 1, F.lit(0)))
        grams = F.transform(idx, _gram_at(t, n))
        # sequence(1, 0) counts down; keep only grams made of n words
        parts.append(F.when(F.size(t) >= n, grams).otherwise(F.array().cast("array<string>")))
    return parts[0] if len(parts) == 1 else F.concat(*parts)


# fixed values: noun detachment rules of the WordNet morphology (suffix,
# replacement), in their published order
NOUN_SUFFIX_RULES = (
    ("s", ""),
    ("ses", "s"),
    ("xes", "x"),
    ("zes", "z"),
    ("ches", "ch"),
    ("shes", "sh"),
    ("men", "man"),
    ("ies", "y"),
)


def lemma_candidates(form) -> Column:
    """Candidate base forms of a noun by the suffix rules (null where a rule
    does not apply)."""
    f = _c(form)
    out = []
    for suffix, repl in NOUN_SUFFIX_RULES:
        cand = F.concat(f.substr(F.lit(1), F.length(f) - len(suffix)), F.lit(repl))
        out.append(F.when(f.endswith(suffix) & (F.length(f) > len(suffix)), cand))
    return F.array(*out)


def lemma_table(
    tokens: DataFrame, token_col: str = "token", exceptions: DataFrame | None = None, distinct: bool = False
):
    """``(form, lemma)`` for every distinct token (H10); ``distinct`` says that
    ``tokens`` has each once.

    The lexicon is the corpus vocabulary itself: a rule's candidate counts
    only if it occurs as a token somewhere, and the shortest accepted form
    wins (the form itself always qualifies). ``exceptions`` (form, lemma)
    overrides, e.g. irregular plurals. Everything is distinct / explode /
    join / aggregate over the vocabulary, not over the token stream.
    """
    vocab = tokens.select(F.col(token_col).alias("form")).where(F.col("form").isNotNull())
    if not distinct:
        vocab = vocab.distinct()
    cands = vocab.select(
        "form", F.explode(F.array_compact(lemma_candidates(F.col("form")))).alias("cand")
    )
    accepted = cands.join(vocab.select(F.col("form").alias("cand")), "cand", "left_semi")
    options = accepted.unionByName(vocab.select("form", F.col("form").alias("cand")))
    best = options.groupBy("form").agg(
        F.min(F.struct(F.length("cand").alias("len"), F.col("cand").alias("c"))).alias("b")
    )
    table = best.select("form", F.col("b.c").alias("lemma"))
    if exceptions is not None:
        ex = exceptions.select("form", F.col("lemma").alias("_ex"))
        table = table.join(ex, "form", "left").select(
            "form", F.coalesce("_ex", "lemma").alias("lemma")
        )
    return table
