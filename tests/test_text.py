from waitline.functions import html as H
from waitline.functions import text as T


def _one(spark, col, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).first().r


def test_clean_and_tag_tokens(spark):
    from pyspark.sql import functions as F

    assert _one(spark, T.clean_tags(F.col("x")), "<c#><.net>") == " c#  .net "
    toks = _one(spark, T.tag_tokens(F.col("x")), " c#  .net  c++  asp.net-mvc ")
    assert toks == ["c", "net", "c", "asp.net-mvc"]
    assert _one(spark, T.split_whitespace(F.col("x")), " a  b\tc ") == ["a", "b", "c"]


def test_word_tokens_and_ngrams(spark):
    from pyspark.sql import functions as F

    assert _one(spark, T.word_tokens(F.col("x")), "Hello, a World_2 x9") == ["hello", "world_2", "x9"]
    grams = _one(spark, T.ngrams(F.array(F.lit("a"), F.lit("b"), F.lit("c")), 1, 3), "")
    assert grams == ["a", "b", "c", "a b", "b c", "a b c"]
    one = _one(spark, T.ngrams(F.array(F.lit("a")), 1, 3), "")
    assert one == ["a"]


def test_stop_words_list():
    w = T.english_stop_words()
    assert len(w) == 181 and "the" in w


def test_html_fixture_strings(spark):
    from pyspark.sql import functions as F

    cases = {
        "<p>a &amp; b</p>": ("a & b", None),
        '<p class="x">c</p>': ("c", None),
        "<pre><code>d</code></pre>": ("", "d"),
        "<p>e <code>f</code></p>": ("e f", "f"),
        '<script>var t="</p>"</script>': ("", None),
        "<!-- <p>no</p> -->": ("", None),
        "<p><b>g<br><p>h</p>": ("g\nh", None),
        "plain": ("", None),
    }
    for html, (para, code) in cases.items():
        got_p = _one(spark, H.element_text(F.col("x"), "p"), html)
        got_c = _one(spark, H.element_text(F.col("x"), "code", null_if_none=True), html)
        assert (got_p, got_c) == (para, code), html


def test_lemma_table_uses_corpus_vocabulary(spark):
    toks = spark.createDataFrame(
        [(t,) for t in ["dogs", "dog", "glasses", "glass", "this", "boxes", "box", "cities"]], "token string"
    )
    got = {r.form: r.lemma for r in T.lemma_table(toks).collect()}
    assert got["dogs"] == "dog" and got["glasses"] == "glass" and got["boxes"] == "box"
    assert got["this"] == "this"  # 'thi' is not in the vocabulary
    assert got["cities"] == "cities"  # 'city' absent, so unchanged
