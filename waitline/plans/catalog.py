"""Registered queries over the test tables and their DuckDB oracle SQL.

Each query is a function ``(spark, sf_dir) -> DataFrame`` built from the
library operators on the proxy roles (``proxies``). ``ORACLE`` holds, per
query, an independent SQL statement over the raw tables; column names match.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import ONE_DAY_MINUTES, ONE_WEEK_MINUTES
from ..operators import history, profile, response, tables
from . import proxies

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

# proxy parameters (dates in the test tables are whole days)
SINCE = "1995-06-17"
LOOKUP_ID = 7
RECENT = "2024-01-15"
BOUND_HI = 365 * ONE_DAY_MINUTES
HIST_BINS = 50


def _el(a: str, b: str) -> str:
    return f"CAST(floor(date_diff('microsecond', {a}, {b}) / 60000000.0) AS BIGINT)"


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def _qa(spark, d):
    return proxies.questions(spark, d), proxies.answers(spark, d)


# ---------------------------------------------------------------- sources / scans


@register(
    "posts_scan",
    f"""
    SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'F' THEN o_orderkey END AS acceptedanswerid,
           CAST(NULL AS BIGINT) AS parentid, o_orderdate AS creationdate, CAST(NULL AS VARCHAR) AS body,
           CAST(NULL AS VARCHAR) AS tags, o_orderpriority AS title, 1 AS posttypeid
    FROM orders WHERE o_orderdate > TIMESTAMP '{SINCE}'
    UNION ALL
    SELECT l_orderkey * 100 + l_linenumber, NULL, l_orderkey, l_shipdate, NULL, NULL, NULL, 2
    FROM lineitem WHERE l_shipdate > TIMESTAMP '{SINCE}'
    """,
)
def posts_scan(spark, d):
    from ..sources.files import scan_posts

    return scan_posts(proxies.posts(spark, d), SINCE)


@register(
    "adhoc_recent_limit",
    f"SELECT * FROM events WHERE ts > TIMESTAMP '{RECENT}' ORDER BY ts, event_id LIMIT 10",
)
def adhoc_recent_limit(spark, d):
    from ..sources.files import adhoc_sql

    return adhoc_sql(
        spark,
        {"waitline_events": proxies.table(spark, d, "events")},
        f"SELECT * FROM waitline_events WHERE ts > TIMESTAMP_NTZ '{RECENT}' ORDER BY ts, event_id LIMIT 10",
    )


LOOKUP_USER = 7


@register(
    "user_badges_lookup",
    f"""SELECT event_id AS id, user_id AS userid, event_type AS name, ts AS date
        FROM events WHERE event_type <> 'purchase' AND user_id = {LOOKUP_USER}""",
)
def user_badges_lookup(spark, d):
    """All badges of one user (the reference's ``WHERE userid = k`` query)."""
    from ..sources.files import adhoc_sql

    return adhoc_sql(
        spark,
        {"waitline_badges": proxies.badges(spark, d)},
        f"SELECT * FROM waitline_badges WHERE userid = {LOOKUP_USER}",
    )


@register(
    "point_lookup",
    f"""SELECT o_orderkey AS id, 1 AS posttypeid, o_orderdate AS creationdate, o_custkey AS owneruserid,
        CASE WHEN o_orderstatus = 'F' THEN o_orderkey END AS acceptedanswerid, o_orderpriority AS title
        FROM orders WHERE o_orderkey = {LOOKUP_ID}""",
)
def point_lookup(spark, d):
    return proxies.questions(spark, d).where(F.col("id") == LOOKUP_ID)


# ---------------------------------------------------------------- response times


@register(
    "question_answers",
    f"""SELECT o_orderkey AS id, o_orderdate AS question_date, l_shipdate AS answer_date,
               l_linenumber, l_partkey, {_el('o_orderdate', 'l_shipdate')} AS elapsed
        FROM orders JOIN lineitem ON l_orderkey = o_orderkey""",
)
def question_answers(spark, d):
    q, a = _qa(spark, d)
    return response.question_answers(q, a, keep_a=["l_linenumber", "l_partkey"])


@register(
    "shortest_elapsed",
    f"""SELECT o_orderkey AS id, min({_el('o_orderdate', 'l_shipdate')}) AS min_elapsed
        FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey""",
)
def shortest_elapsed(spark, d):
    return response.shortest_elapsed(*_qa(spark, d))


@register(
    "late_questions",
    f"""SELECT o_orderkey AS id FROM orders JOIN lineitem ON l_orderkey = o_orderkey
        GROUP BY o_orderkey HAVING min({_el('o_orderdate', 'l_shipdate')}) > {ONE_DAY_MINUTES}""",
)
def late_questions(spark, d):
    return response.late_questions(*_qa(spark, d), deadline=ONE_DAY_MINUTES)


@register(
    "answered_questions",
    """SELECT o_orderkey AS id, o_orderdate AS creationdate FROM orders
       WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""",
)
def answered_questions(spark, d):
    return response.answered_questions(*_qa(spark, d)).select("id", "creationdate")


@register(
    "unanswered_questions",
    """SELECT o_orderkey AS id, o_orderdate AS creationdate FROM orders
       WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""",
)
def unanswered_questions(spark, d):
    return response.unanswered_questions(*_qa(spark, d)).select("id", "creationdate")


@register(
    "failed_questions",
    f"""SELECT o_orderkey AS id FROM orders
        WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
        UNION ALL
        SELECT o_orderkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey
        GROUP BY o_orderkey HAVING min({_el('o_orderdate', 'l_shipdate')}) > {ONE_DAY_MINUTES}""",
)
def failed_questions(spark, d):
    return response.failed_questions(*_qa(spark, d), deadline=ONE_DAY_MINUTES)


def _success_sql(deadline: int) -> str:
    return f"""SELECT o_orderkey AS id, o_orderpriority AS title,
               CASE WHEN {_el('o_orderdate', 'f.first_date')} <= {deadline} THEN 1 ELSE 0 END AS success
        FROM orders LEFT JOIN (SELECT l_orderkey, min(l_shipdate) AS first_date FROM lineitem GROUP BY 1) f
          ON f.l_orderkey = o_orderkey"""


@register("success_day", _success_sql(ONE_DAY_MINUTES))
def success_day(spark, d):
    return response.success_label(*_qa(spark, d), deadline=ONE_DAY_MINUTES, keep=["title"])


@register("success_week", _success_sql(ONE_WEEK_MINUTES))
def success_week(spark, d):
    return response.success_label(*_qa(spark, d), deadline=ONE_WEEK_MINUTES, keep=["title"])


@register(
    "answer_rate",
    """SELECT count(*) AS n_questions, count(f.l_orderkey) AS n_answered,
              round(count(f.l_orderkey) / count(*), 6) AS answered_share
       FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey FROM lineitem) f ON f.l_orderkey = o_orderkey""",
)
def answer_rate(spark, d):
    return response.answer_rate(*_qa(spark, d))


@register(
    "response_any",
    f"""SELECT o_orderpriority AS title, {_el('o_orderdate', 'l_shipdate')} AS elapsed, o_orderkey AS id
        FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F'""",
)
def response_any(spark, d):
    return response.response_time(*_qa(spark, d), keep=["title"])


_TIES = ", ".join(proxies.ANSWER_TIE_COLS)
_FIRST_ACCEPTED = f"""
    SELECT o_orderkey AS id, o_orderpriority AS title, l_shipdate AS first_answer_date,
           l_linenumber AS first_l_linenumber, {_el('o_orderdate', 'l_shipdate')} AS elapsed
    FROM orders JOIN (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, {_TIES}) AS rn
        FROM lineitem) l ON l.l_orderkey = o_orderkey AND l.rn = 1
    WHERE o_orderstatus = 'F'"""


def _first(spark, d) -> DataFrame:
    """The one first-answer aggregate shared by every query of a plan."""
    return response.first_answers(proxies.answers(spark, d), proxies.ANSWER_TIE_COLS)


def _first_accepted(spark, d, first: DataFrame | None = None) -> DataFrame:
    q, a = _qa(spark, d)
    return response.first_response_time(
        q, a, tie_cols=proxies.ANSWER_TIE_COLS, accepted="acceptedanswerid", keep=["title"],
        first=first,
    ).select("id", "title", "first_answer_date", "first_l_linenumber", "elapsed")


@register("response_accepted", _FIRST_ACCEPTED)
def response_accepted(spark, d):
    return _first_accepted(spark, d)


@register(
    "first_response",
    f"""WITH a AS (
            SELECT l_orderkey AS parentid, l_shipdate AS creationdate, l_orderkey * 100 + l_linenumber AS aid,
                   row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_orderkey * 100 + l_linenumber) AS rn
            FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders))
        SELECT o_orderkey AS id, o_orderdate AS question_date, a.creationdate AS first_answer_date,
               a.aid AS first_id, {_el('o_orderdate', 'a.creationdate')} AS elapsed
        FROM orders JOIN a ON a.parentid = o_orderkey AND a.rn = 1""",
)
def first_response(spark, d):
    posts = proxies.posts(spark, d)
    questions = response.questions_by_parent(posts)
    answers = posts.where(F.col("parentid").isNotNull())
    return response.first_response_time(questions, answers, tie_cols=["id"])


# ---------------------------------------------------------------- prior badges

_PRIOR = """
    SELECT a.event_id AS id, a.user_id AS userid,
           coalesce(string_agg(b.event_type, ' ' ORDER BY b.ts, b.event_id), '') AS badges,
           count(b.event_id) AS n_badges
    FROM events a {join} JOIN events b
      ON b.user_id = a.user_id AND b.ts < a.ts AND b.event_type <> 'purchase'
    WHERE a.event_type = 'purchase'
    GROUP BY a.event_id, a.user_id"""


@register("prior_badges_left", _PRIOR.format(join="LEFT"))
def prior_badges_left(spark, d):
    return history.prior_events(proxies.asks(spark, d), proxies.badges(spark, d), how="left")


@register("prior_badges_inner", _PRIOR.format(join="INNER"))
def prior_badges_inner(spark, d, wanted: DataFrame | None = None):
    """wanted: the asks' ids, if not all of them are."""
    a = proxies.asks(spark, d)
    if wanted is not None:
        a = a.join(wanted.select("id"), "id", "left_semi")
    return history.prior_events(a, proxies.badges(spark, d), how="inner")


# ---------------------------------------------------------------- label and history tables

_BADGES_INNER = _PRIOR.format(join="INNER")


@register(
    "badge_success",
    f"""WITH s AS ({_success_sql(ONE_DAY_MINUTES)}), b AS ({_BADGES_INNER})
        SELECT s.success, coalesce(s.id, b.id) AS id, b.badges
        FROM s FULL OUTER JOIN b ON s.id = b.id""",
)
def badge_success(spark, d):
    s = success_day(spark, d).select("success", "id")
    b = prior_badges_inner(spark, d).select("id", "badges")
    return tables.outer_by_id(s, b).select("success", "id", "badges")


def _badge_time_sql() -> str:
    return f"""WITH t AS ({_FIRST_ACCEPTED}), b AS ({_BADGES_INNER})
        SELECT coalesce(t.id, b.id) AS id, t.elapsed, b.badges
        FROM t FULL OUTER JOIN b ON t.id = b.id"""


@register("badge_time", _badge_time_sql())
def badge_time(spark, d):
    t = _first_accepted(spark, d).select("id", "elapsed")
    b = prior_badges_inner(spark, d).select("id", "badges")
    return tables.outer_by_id(t, b).select("id", "elapsed", "badges")


@register(
    "content_with_badges",
    f"""WITH s AS ({_success_sql(ONE_DAY_MINUTES)}), bt AS ({_badge_time_sql()})
        SELECT coalesce(s.id, bt.id) AS id, s.title, s.success, bt.elapsed, coalesce(bt.badges, '') AS badges
        FROM s FULL OUTER JOIN bt ON s.id = bt.id""",
)
def content_with_badges(spark, d):
    first = _first(spark, d)
    s = response.success_label(*_qa(spark, d), deadline=ONE_DAY_MINUTES, keep=["title"], first=first)
    t = _first_accepted(spark, d, first).select("id", "elapsed")
    b = prior_badges_inner(spark, d).select("id", "badges")
    bt = tables.outer_by_id(t, b).select("id", "elapsed", "badges")
    return tables.outer_by_id(s, bt, fill={"badges": ""}).select(
        "id", "title", "success", "elapsed", "badges"
    )


@register(
    "elapsed_bounded",
    f"""WITH t AS ({_FIRST_ACCEPTED}), b AS ({_BADGES_INNER})
        SELECT t.id, t.title, t.elapsed, coalesce(b.badges, '') AS badges
        FROM t LEFT JOIN b ON t.id = b.id
        WHERE t.elapsed > 0 AND t.elapsed < {BOUND_HI}""",
)
def elapsed_bounded(spark, d):
    t = _first_accepted(spark, d).select("id", "title", "elapsed")
    b = prior_badges_inner(spark, d).select("id", "badges")
    return tables.bounded_with_history(t, b, "elapsed", 0, BOUND_HI).select(
        "id", "title", "elapsed", "badges"
    )


# ---------------------------------------------------------------- profiles


@register(
    "type_counts",
    """SELECT posttypeid, count(*) AS n FROM (
         SELECT 1 AS posttypeid FROM orders UNION ALL SELECT 2 FROM lineitem) GROUP BY posttypeid""",
)
def type_counts(spark, d):
    return profile.value_counts(proxies.posts(spark, d), "posttypeid")


def _hist_sql(expr: str) -> str:
    return f"""WITH t AS ({_FIRST_ACCEPTED}),
        x AS (SELECT {expr} AS v FROM t WHERE elapsed > 0 AND elapsed < {BOUND_HI}),
        s AS (SELECT min(v) AS lo, max(v) AS hi FROM x)
        SELECT CAST(CASE WHEN s.hi = s.lo THEN 0
                    ELSE least(floor((x.v - s.lo) * {HIST_BINS} / (s.hi - s.lo)), {HIST_BINS - 1}) END AS INTEGER) AS bin,
               count(*) AS n
        FROM x, s GROUP BY 1"""


@register("elapsed_hist", _hist_sql("CAST(elapsed AS DOUBLE)"))
def elapsed_hist(spark, d):
    t = _first_accepted(spark, d)
    x = t.where((F.col("elapsed") > 0) & (F.col("elapsed") < BOUND_HI))
    return profile.histogram(x, F.col("elapsed").cast("double"), HIST_BINS)


@register("log_elapsed_hist", _hist_sql("ln(elapsed)"))
def log_elapsed_hist(spark, d):
    t = _first_accepted(spark, d)
    x = t.where((F.col("elapsed") > 0) & (F.col("elapsed") < BOUND_HI))
    return profile.histogram(x, F.ln("elapsed"), HIST_BINS)


# ---------------------------------------------------------------- text

from ..functions import html as H  # noqa: E402
from ..functions import text as T  # noqa: E402


def _sq(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _duck_list(words) -> str:
    return "[" + ", ".join(_sq(w) for w in words) + "]"


_PART_TAGS = "('<' || p_brand || '><' || p_type || '>')"


def _duck_split_ws(x: str) -> str:
    return f"list_filter(string_split_regex({x}, '\\s+'), lambda t: t <> '')"


def _duck_unnest_pos(keys: str, lst: str, src: str) -> str:
    return f"""SELECT {keys}, unnest(generate_series(1, len(l))) AS pos, unnest(l) AS token
               FROM (SELECT {keys}, {lst} AS l FROM {src})"""


def _explode_pos(df: DataFrame, keys, arr: str, out: str = "token") -> DataFrame:
    return T.explode_array(df, keys, arr, out=out, pos="pos")


@register(
    "tags_clean",
    f"SELECT p_partkey, regexp_replace({_PART_TAGS}, '<|>', ' ', 'g') AS tags FROM part",
)
def tags_clean(spark, d):
    return proxies.part_tags(spark, d).select("p_partkey", T.clean_tags("tags").alias("tags"))


@register(
    "tag_baskets",
    _duck_unnest_pos(
        "p_partkey", _duck_split_ws(f"regexp_replace({_PART_TAGS}, '<|>', ' ', 'g')"), "part"
    ),
)
def tag_baskets(spark, d):
    p = proxies.part_tags(spark, d).select(
        "p_partkey", T.split_whitespace(T.clean_tags("tags")).alias("toks")
    )
    return _explode_pos(p, ["p_partkey"], "toks")


# the SQL has its own literals, so a wrong pattern in the code shows
_WC = r"\p{L}\p{N}_"
_SQL_WORD = r"[\p{L}\p{N}_]{2,}"
_SQL_WORD_OR_PUNCT = r"[\p{L}\p{N}_]+|[^\s\p{L}\p{N}_]"
_SQL_SUFFIXES = {"s": "", "ses": "s", "xes": "x", "zes": "z", "ches": "ch", "shes": "sh", "men": "man", "ies": "y"}
_SQL_NOISE = r"(?is)<!--.*?-->|<script[^>]*>.*?</script>|<style[^>]*>.*?</style>"
_SQL_END = {
    "p": r"(?i)</(p|div|article|section|body|nav|footer|ul|ol|li|table|blockquote)\s*>"
    r"|<(h1|h2|h3|h4|h5|h6|pre|hr|div|ul|ol|table|blockquote|form|header|footer|section|article|nav|aside|main)(\s[^>]*)?/?>",
}
_SQL_ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&apos;": "'", "&nbsp;": "\u00a0", "&copy;": "\u00a9", "&middot;": "\u00b7", "&amp;": "&"}


@register(
    "tokens_tags",
    _duck_unnest_pos(
        "p_partkey",
        f"""list_filter(list_transform({_duck_split_ws(f"lower(regexp_replace({_PART_TAGS}, '<|>', ' ', 'g'))")},
                lambda p: regexp_replace(p, '^[^{_WC}]+|[^{_WC}]+$', '', 'g')), lambda p: p <> '')""",
        "part",
    ),
)
def tokens_tags(spark, d):
    p = proxies.part_tags(spark, d).select(
        "p_partkey", T.tag_tokens(T.clean_tags("tags")).alias("toks")
    )
    return _explode_pos(p, ["p_partkey"], "toks")


def _duck_words_nostop(text: str) -> str:
    return (
        f"list_filter(regexp_extract_all(lower({text}), '{_SQL_WORD}'), "
        f"lambda t: NOT list_contains({_duck_list(T.english_stop_words())}, t))"
    )


def _words_nostop(df: DataFrame, text: str = "text") -> DataFrame:
    w = df.withColumn("_w", T.word_tokens(text))
    return T.remove_stop_words(w, "_w", "_ws").drop("_w")


@register("tokens_words", _duck_unnest_pos("doc_id", _duck_words_nostop("text"), "documents"))
def tokens_words(spark, d):
    docs = proxies.table(spark, d, "documents").select("doc_id", "text")
    return _explode_pos(_words_nostop(docs), ["doc_id"], "_ws")


def _ngram_sql(n_max: int) -> str:
    grams = ["l0"] + [
        f"[array_to_string(l0[i:i + {n - 1}], ' ') for i in range(1, len(l0) - {n - 2})]"
        for n in range(2, n_max + 1)
    ]
    cat = "list_concat(" + ", ".join(grams) + ")" if len(grams) > 1 else grams[0]
    return f"""SELECT conv_id, turn, unnest(generate_series(1, len(g))) AS pos, unnest(g) AS gram
        FROM (SELECT conv_id, turn, {cat} AS g
              FROM (SELECT conv_id, turn, {_duck_words_nostop('text')} AS l0 FROM conversations))"""


@register("ngrams", _ngram_sql(3))
def ngrams(spark, d):
    c = proxies.table(spark, d, "conversations").select("conv_id", "turn", "text")
    g = _words_nostop(c).select("conv_id", "turn", T.ngrams("_ws", 1, 3).alias("_g"))
    return _explode_pos(g, ["conv_id", "turn"], "_g", out="gram")


def _duck_rules(col: str) -> str:
    sel = []
    for suffix, repl in _SQL_SUFFIXES.items():
        sel.append(
            f"SELECT {col} AS form, substr({col}, 1, length({col}) - {len(suffix)}) || {_sq(repl)} AS c "
            f"FROM vocab WHERE suffix({col}, {_sq(suffix)}) AND length({col}) > {len(suffix)}"
        )
    return " UNION ALL ".join(sel)


@register(
    "lemma_terms",
    f"""WITH tok AS (SELECT unnest(regexp_extract_all(lower(text), '{_SQL_WORD_OR_PUNCT}')) AS form FROM documents),
        vocab AS (SELECT DISTINCT form FROM tok),
        cand AS ({_duck_rules('form')}),
        ok AS (SELECT cand.form, cand.c FROM cand WHERE cand.c IN (SELECT form FROM vocab)
               UNION ALL SELECT form, form FROM vocab),
        best AS (SELECT form, c, row_number() OVER (PARTITION BY form ORDER BY length(c), c) AS rn FROM ok)
        SELECT b.form, b.c AS lemma, n.n FROM best b
        JOIN (SELECT form, count(*) AS n FROM tok GROUP BY form) n ON n.form = b.form
        WHERE b.rn = 1""",
)
def lemma_terms(spark, d):
    docs = proxies.table(spark, d, "documents").select("doc_id", "text")
    tok = T.explode_array(docs, [], T.word_tokens("text", T.WORD_OR_PUNCT))
    # the filter (always true) keeps n in every branch: one exchange for all
    counts = tok.groupBy(F.col("token").alias("form")).agg(F.count(F.lit(1)).alias("n")).where("n > 0 AND form IS NOT NULL")
    table = T.lemma_table(counts, "form", distinct=True)
    return table.join(counts, "form").select("form", "lemma", "n")


# ---------------------------------------------------------------- HTML


def _duck_texts(html: str, tag: str) -> str:
    """DuckDB list of the decoded texts of every ``tag`` element (same
    pattern constants as ``functions.html``)."""
    h = f"regexp_replace({html}, {_sq(_SQL_NOISE)}, '', 'g')"
    h = f"regexp_replace({h}, {_sq(rf'(?i)<{tag}([ \t\n\r\f][^>]*)?>')}, chr(2), 'g')"
    h = f"regexp_replace({h}, {_sq(_SQL_END.get(tag) or f'(?i)</{tag}[ \t\n\r\f]*>')}, chr(3), 'g')"
    h = f"regexp_replace({h}, {_sq('(?s)<[^>]*>')}, '', 'g')"
    dec = "split_part(p, chr(3), 1)"
    for ent, ch in _SQL_ENTITIES.items():
        dec = f"replace({dec}, {_sq(ent)}, {_sq(ch)})"
    return f"list_transform(string_split({h}, chr(2))[2:], lambda p: {dec})"


def _duck_element_text(html: str, tag: str) -> str:
    return f"CASE WHEN {html} IS NOT NULL THEN array_to_string({_duck_texts(html, tag)}, chr(10)) END"


@register(
    "html_paragraphs",
    f"SELECT page_id, {_duck_element_text('html', 'p')} AS paragraphs FROM pages",
)
def html_paragraphs(spark, d):
    p = proxies.table(spark, d, "pages")
    return p.select("page_id", H.element_text("html", "p").alias("paragraphs"))


_LIST_TAG = "li"


@register(
    "html_codes",
    f"""SELECT page_id, CASE WHEN len(x) > 0 THEN array_to_string(x, chr(10)) END AS codes
        FROM (SELECT page_id, {_duck_texts('html', _LIST_TAG)} AS x FROM pages)""",
)
def html_codes(spark, d):
    p = proxies.table(spark, d, "pages")
    return p.select("page_id", H.element_text("html", _LIST_TAG, null_if_none=True).alias("codes"))


@register(
    "has_codes",
    f"""SELECT page_id, CASE WHEN len(x) > 0 THEN 1 ELSE 0 END AS hascodes
        FROM (SELECT page_id, {_duck_texts('html', _LIST_TAG)} AS x FROM pages)""",
)
def has_codes(spark, d):
    p = proxies.table(spark, d, "pages")
    codes = p.select("page_id", H.element_text("html", _LIST_TAG, null_if_none=True).alias("codes"))
    return codes.select("page_id", response.has_codes("codes").alias("hascodes"))


def _duck_title() -> str:
    t = "regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)"
    t = f"regexp_replace({t}, {_sq('(?s)<[^>]*>')}, '', 'g')"
    for ent, ch in _SQL_ENTITIES.items():
        t = f"replace({t}, {_sq(ent)}, {_sq(ch)})"
    return t


@register(
    "extract_posts",
    f"""SELECT page_id AS id, {_duck_title()} AS title, {_duck_element_text('html', 'p')} AS paragraphs,
               CAST(NULL AS VARCHAR) AS tags,
               CASE WHEN len(x) > 0 THEN array_to_string(x, chr(10)) END AS codes,
               CASE WHEN len(x) > 0 THEN 1 ELSE 0 END AS hascodes
        FROM (SELECT *, {_duck_texts('html', 'code')} AS x FROM pages) WHERE html IS NOT NULL""",
)
def extract_posts(spark, d):
    from ..operators.extract import extract_posts as _extract

    p = proxies.table(spark, d, "pages").select(F.col("page_id").alias("id"), F.col("html").alias("body"))
    good, _bad = _extract(p, body="body", tags=None, title=None)
    return good.select("id", "title", "paragraphs", "tags", "codes", "hascodes")


# ---------------------------------------------------------------- features

from . import features as FE  # noqa: E402
from ..operators import evaluate as EV  # noqa: E402
from ..operators import itemsets as IS  # noqa: E402
from ..operators import sampling as SP  # noqa: E402

MIN_DF = 2
MAX_DF = 0.6
UNION_WEIGHT = 0.33


def _duck_tfidf(src: str, toks: str, min_df, max_df, key: str = "doc_id") -> str:
    lo = f"{min_df}" if isinstance(min_df, int) else f"{min_df} * n.n"
    hi = f"{max_df}" if isinstance(max_df, int) else f"{max_df} * n.n"
    return f"""
        docs AS (SELECT {key} AS doc, {toks} AS toks FROM {src}),
        n AS (SELECT count(*) AS n FROM {src}),
        tf AS (SELECT doc, term, count(*) AS tf FROM (SELECT doc, unnest(toks) AS term FROM docs) GROUP BY doc, term),
        dfq AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
        v AS (SELECT term, df FROM dfq, n WHERE df >= {lo} AND df <= {hi}),
        w AS (SELECT tf.doc, tf.term, tf.tf * (ln((1.0 + n.n) / (1.0 + v.df)) + 1) AS weight
              FROM tf JOIN v ON v.term = tf.term, n),
        wn AS (SELECT doc, term, weight / sqrt(sum(weight * weight) OVER (PARTITION BY doc)) AS weight FROM w)"""


_DOC_WORDS = f"regexp_extract_all(lower(text), '{_SQL_WORD}')"


@register(
    "tfidf_weights",
    f"WITH {_duck_tfidf('documents', _DOC_WORDS, MIN_DF, MAX_DF)} "
    "SELECT doc AS doc_id, term, round(weight, 4) AS weight FROM wn",
)
def tfidf_weights(spark, d):
    docs = proxies.table(spark, d, "documents").select("doc_id", "text")
    w = FE.tfidf_long(docs, "doc_id", T.word_tokens("text"), MIN_DF, MAX_DF)
    return w.select(F.col("doc").alias("doc_id"), "term", F.round("weight", 4).alias("weight"))


@register(
    "df_filtered_vocab",
    f"WITH {_duck_tfidf('documents', _DOC_WORDS, MIN_DF, MAX_DF)} SELECT term, df FROM v",
)
def df_filtered_vocab(spark, d):
    docs = proxies.table(spark, d, "documents").select("doc_id", "text")
    return FE.filtered_vocabulary(docs, "doc_id", T.word_tokens("text"), MIN_DF, MAX_DF)


_PART_TAG_TOKENS = f"""list_filter(list_transform({_duck_split_ws(f"lower(regexp_replace({_PART_TAGS}, '<|>', ' ', 'g'))")},
                lambda p: regexp_replace(p, '^[^{_WC}]+|[^{_WC}]+$', '', 'g')), lambda p: p <> '')"""


@register(
    "weighted_union",
    f"""WITH a AS (WITH {_duck_tfidf('part', f"regexp_extract_all(lower(p_name), '{_SQL_WORD}')", 1, 1.0, 'p_partkey')}
                   SELECT doc, 'name' AS block, term, weight FROM wn),
             b AS (WITH {_duck_tfidf('part', _PART_TAG_TOKENS, 1, 1.0, 'p_partkey')}
                   SELECT doc, 'tags' AS block, term, weight FROM wn)
        SELECT doc AS p_partkey, block, term, round(weight * {UNION_WEIGHT}, 6) AS weight
        FROM (SELECT * FROM a UNION ALL SELECT * FROM b)""",
)
def weighted_union(spark, d):
    parts = proxies.part_tags(spark, d, "p_name")
    name = FE.tfidf_long(parts, "p_partkey", T.word_tokens("p_name"), 1, 1.0)
    tags = FE.tfidf_long(parts, "p_partkey", T.tag_tokens(T.clean_tags("tags")), 1, 1.0)
    u = FE.weighted_union_long({"name": name, "tags": tags}, {"name": UNION_WEIGHT, "tags": UNION_WEIGHT})
    return u.select(F.col("doc").alias("p_partkey"), "block", "term", F.round("weight", 6).alias("weight"))


@register(
    "l2_norm",
    """SELECT vec_id, unnest(generate_series(1, len(embedding))) AS idx,
              round(unnest(list_transform(embedding, lambda x: CAST(x AS DOUBLE)
                 / sqrt(list_sum(list_transform(embedding, lambda y: CAST(y AS DOUBLE) * CAST(y AS DOUBLE)))))), 6) AS value
       FROM embeddings""",
)
def l2_norm(spark, d):
    from pyspark.ml.feature import Normalizer
    from pyspark.ml.functions import array_to_vector, vector_to_array

    e = proxies.table(spark, d, "embeddings").select(
        "vec_id", array_to_vector("embedding").alias("v")
    )
    n = Normalizer(inputCol="v", outputCol="nv", p=2.0).transform(e)
    out = n.select("vec_id", F.posexplode(vector_to_array("nv")).alias("idx", "value"))
    return out.select(
        "vec_id", (F.col("idx") + 1).cast("bigint").alias("idx"), F.round("value", 6).alias("value")
    )


@register(
    "class_weights",
    """SELECT quality, count(*) AS n,
              round(sum(count(*)) OVER () / (count(*) OVER () * count(*)), 6) AS weight
       FROM labels GROUP BY quality""",
)
def class_weights(spark, d):
    lab = proxies.table(spark, d, "labels")
    w = FE.class_weights(lab, "quality")
    return w.select("quality", "n", F.round("weight", 6).alias("weight"))


# ---------------------------------------------------------------- item sets

MIN_SUPPORT = 15


@register(
    "tag_itemsets",
    f"""WITH RECURSIVE b AS (SELECT DISTINCT l_orderkey AS k, p_brand AS it FROM lineitem JOIN part ON p_partkey = l_partkey),
        l AS (SELECT k, list_sort(list(it)) AS its FROM b GROUP BY k),
        sub(k, its, items, last, size) AS (
            SELECT k, its, '', 0, 0 FROM l
            UNION ALL
            SELECT k, its, CASE WHEN size = 0 THEN its[i] ELSE items || ' ' || its[i] END, i, size + 1
            FROM (SELECT *, unnest(generate_series(last + 1, len(its))) AS i FROM sub WHERE last < len(its)))
        SELECT items, count(*) AS freq, size FROM sub WHERE size > 0 GROUP BY items, size HAVING count(*) >= {MIN_SUPPORT}""",
)
def tag_itemsets(spark, d):
    li = proxies.table(spark, d, "lineitem").select("l_orderkey", "l_partkey")
    part = proxies.table(spark, d, "part").select("p_partkey", "p_brand")
    lines = li.join(part, li["l_partkey"] == part["p_partkey"])
    b = IS.baskets(lines, "l_orderkey", F.col("p_brand"))
    sets = IS.frequent_itemsets(b, MIN_SUPPORT)
    return sets.select(F.array_join("items", " ").alias("items"), "freq", "size")


# ---------------------------------------------------------------- samples and splits

SAMPLE_N = 100
SEED = 42
TEST_SIZE = 0.33
N_FOLDS = 3


def _duck_hash8(key: str, seed: int) -> str:
    return f"substr(md5(CAST({key} AS VARCHAR) || ':{seed}'), 1, 8)"


@register(
    "sample_n",
    f"""SELECT o_orderkey AS id, o_orderdate AS creationdate FROM orders
        ORDER BY md5(CAST(o_orderkey AS VARCHAR) || ':{SEED}'), o_orderkey LIMIT {SAMPLE_N}""",
)
def sample_n(spark, d):
    q = proxies.questions(spark, d).select("id", "creationdate")
    return profile.sample_n(q, "id", SAMPLE_N, SEED)


@register(
    "half_split",
    f"""SELECT o_orderkey AS id, CASE WHEN {_duck_hash8('o_orderkey', SEED)} < '80000000'
               THEN 'train' ELSE 'test' END AS part FROM orders""",
)
def half_split(spark, d):
    q = proxies.questions(spark, d).select("id")
    return q.withColumn("part", F.when(SP.in_fraction("id", 0.5, SEED), "train").otherwise("test"))


@register(
    "train_test_split",
    f"""SELECT doc_id, CASE WHEN {_duck_hash8('doc_id', SEED)} < '547ae147'
               THEN 1 ELSE 0 END AS is_test FROM documents JOIN labels USING (doc_id)""",
)
def train_test_split(spark, d):
    docs = proxies.labelled_documents(spark, d).select("doc_id")
    return docs.withColumn("is_test", SP.in_fraction("doc_id", TEST_SIZE, SEED).cast("int"))


@register(
    "stratified_folds",
    f"""SELECT doc_id, quality, ntile({N_FOLDS}) OVER (PARTITION BY quality ORDER BY doc_id) AS fold
        FROM documents JOIN labels USING (doc_id)""",
)
def stratified_folds(spark, d):
    docs = proxies.labelled_documents(spark, d).select("doc_id", "quality")
    f = SP.stratified_folds(docs, "quality", "doc_id", N_FOLDS)
    return f.withColumn("fold", F.col("fold").cast("bigint"))


# ---------------------------------------------------------------- evaluation

PRED_MIN_CHARS = 1500


def _scored(spark, d) -> DataFrame:
    docs = proxies.labelled_documents(spark, d)
    return docs.select(
        "doc_id",
        F.col("quality").alias("label"),
        F.col("n_chars").cast("double").alias("score"),
        (F.col("n_chars") >= PRED_MIN_CHARS).cast("int").alias("prediction"),
    )


def _duck_report(pred_sql: str) -> str:
    return f"""WITH p AS ({pred_sql}),
        a AS (SELECT label AS class, count(*) AS support FROM p GROUP BY 1),
        pp AS (SELECT prediction AS class, count(*) AS pp FROM p GROUP BY 1),
        tp AS (SELECT label AS class, count(*) AS tp FROM p WHERE label = prediction GROUP BY 1),
        j AS (SELECT coalesce(a.class, pp.class) AS class, coalesce(support, 0) AS support,
                     coalesce(pp.pp, 0) AS pp FROM a FULL OUTER JOIN pp ON a.class = pp.class),
        m AS (SELECT j.class, j.support,
                     CASE WHEN j.pp > 0 THEN coalesce(tp.tp, 0) / j.pp ELSE 0.0 END AS precision,
                     CASE WHEN j.support > 0 THEN coalesce(tp.tp, 0) / j.support ELSE 0.0 END AS recall
              FROM j LEFT JOIN tp ON tp.class = j.class)
        SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall,
               round(CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END, 6) AS f1,
               support
        FROM m"""


def _round_report(df: DataFrame) -> DataFrame:
    return df.select(
        "class",
        F.round("precision", 6).alias("precision"),
        F.round("recall", 6).alias("recall"),
        F.round("f1", 6).alias("f1"),
        "support",
    )


_SCORED_SQL = f"""SELECT doc_id, quality AS label, CAST(n_chars AS DOUBLE) AS score,
                  CASE WHEN n_chars >= {PRED_MIN_CHARS} THEN 1 ELSE 0 END AS prediction
                  FROM documents JOIN labels USING (doc_id)"""


@register("classification_report", _duck_report(_SCORED_SQL))
def classification_report(spark, d):
    return _round_report(EV.classification_report(_scored(spark, d), "label", "prediction"))


GUESS_SEED = 7


@register(
    "random_baseline",
    _duck_report(
        f"""SELECT quality AS label,
                   CASE WHEN {_duck_hash8('doc_id', GUESS_SEED)} < printf('%08x', CAST(floor(
                        (SELECT avg(CAST(quality AS DOUBLE)) FROM documents JOIN labels USING (doc_id)) * 4294967296) AS BIGINT))
                   THEN 1 ELSE 0 END AS prediction
            FROM documents JOIN labels USING (doc_id)"""
    ),
)
def random_baseline(spark, d):
    s = _scored(spark, d).drop("prediction")
    g = EV.random_guess(s, "label", "doc_id", GUESS_SEED)
    return _round_report(EV.classification_report(g, "label", "prediction"))


@register(
    "permuted_baseline",
    _duck_report(
        f"""WITH s AS (SELECT doc_id, quality AS label FROM documents JOIN labels USING (doc_id)),
            t AS (SELECT label, row_number() OVER (ORDER BY doc_id, label) AS pos FROM s),
            g AS (SELECT label AS prediction, row_number() OVER (
                      ORDER BY md5(CAST(doc_id AS VARCHAR) || ':{GUESS_SEED}'), doc_id, label) AS pos FROM s)
            SELECT label, prediction FROM t JOIN g USING (pos)"""
    ),
)
def permuted_baseline(spark, d):
    s = _scored(spark, d).select("doc_id", "label")
    g = EV.permuted_guess(s, "label", "doc_id", GUESS_SEED)
    return _round_report(EV.classification_report(g, "label", "prediction"))


@register(
    "roc_curve",
    f"""WITH c AS (SELECT score AS threshold, count(*) FILTER (WHERE label = 1) AS pos,
                          count(*) FILTER (WHERE label <> 1) AS neg FROM ({_SCORED_SQL}) GROUP BY 1),
        r AS (SELECT threshold, sum(pos) OVER (ORDER BY threshold DESC) AS tps,
                     sum(neg) OVER (ORDER BY threshold DESC) AS fps FROM c),
        t AS (SELECT sum(pos) AS p, sum(neg) AS n FROM c)
        SELECT threshold, CAST(tps AS BIGINT) AS tps, CAST(fps AS BIGINT) AS fps,
               round(tps / t.p, 6) AS tpr, round(fps / t.n, 6) AS fpr FROM r, t""",
)
def roc_curve(spark, d):
    r = EV.roc_curve(_scored(spark, d), "label", "score")
    return r.select(
        "threshold", "tps", "fps", F.round("tpr", 6).alias("tpr"), F.round("fpr", 6).alias("fpr")
    )


@register(
    "roc_auc",
    f"""WITH c AS (SELECT score, count(*) FILTER (WHERE label = 1) AS pos,
                          count(*) FILTER (WHERE label <> 1) AS neg FROM ({_SCORED_SQL}) GROUP BY 1),
        r AS (SELECT pos, neg, sum(pos) OVER (ORDER BY score DESC) - pos AS above FROM c)
        SELECT round(sum(neg * (above + pos / 2.0)) / (sum(pos) * sum(neg)), 6) AS auc,
               CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg FROM r""",
)
def roc_auc(spark, d):
    a = EV.roc_auc(_scored(spark, d), "label", "score")
    return a.select(F.round("auc", 6).alias("auc"), "n_pos", "n_neg")


@register(
    "mae",
    f"""WITH t AS ({_FIRST_ACCEPTED}),
        p AS (SELECT elapsed, avg(elapsed) OVER (PARTITION BY title) AS pred FROM t)
        SELECT round(avg(abs(elapsed - pred)), 4) AS mae, count(*) AS n FROM p""",
)
def mae(spark, d):
    t = _first_accepted(spark, d)
    means = t.groupBy("title").agg(F.avg("elapsed").alias("prediction"))
    p = t.join(means, "title")
    m = EV.mean_absolute_error(p, "elapsed", "prediction")
    return m.select(F.round("mae", 4).alias("mae"), "n")


@register(
    "predicted_pairs",
    f"""SELECT id, round(avg(elapsed) OVER (PARTITION BY title), 4) AS prediction, elapsed AS label FROM ({_FIRST_ACCEPTED})""",
)
def predicted_pairs(spark, d):
    """K6: the pairs behind the scatter figures, for the mean wait per title."""
    t = _first_accepted(spark, d)
    p = t.join(t.groupBy("title").agg(F.avg("elapsed").alias("prediction")), "title")
    pairs = profile.predicted_vs_actual(p, "elapsed", "prediction", keep=["id"])
    return pairs.select("id", F.round("prediction", 4).alias("prediction"), "label")


@register(
    "keep_first_event",
    """SELECT user_id AS userid, date, id, name FROM (
           SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY date, id) AS rn FROM (
               SELECT event_id AS id, user_id, event_type AS name, ts AS date FROM events WHERE event_type <> 'purchase'))
       WHERE rn = 1""",
)
def keep_first_event(spark, d):
    """The first badge of each user."""
    return response.keep_first(proxies.badges(spark, d), "userid", ["date", "id"])


@register(
    "attach_owner",
    f"""SELECT o_orderkey AS id, min({_el('o_orderdate', 'l_shipdate')}) AS min_elapsed, any_value(o_custkey) AS owneruserid
        FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey""",
)
def attach_owner(spark, d):
    """Shortest waits with the question's asker."""
    q, a = _qa(spark, d)
    from ..operators import history

    return history.attach_owner(response.shortest_elapsed(q, a), q.select("id", "owneruserid"))


@register(
    "typed_rows",
    """WITH raw AS (SELECT CASE WHEN event_id % 7 = 0 THEN 'n/a' ELSE CAST(event_id AS VARCHAR) END AS id,
                    CAST(user_id AS VARCHAR) AS userid FROM events)
       SELECT CASE WHEN try_cast(id AS BIGINT) IS NULL THEN 'bad value: id' ELSE 'ok' END AS reason, count(*) AS n
       FROM raw GROUP BY 1""",
)
def typed_rows(spark, d):
    """A4: rows of strings typed, the others quarantined with a reason."""
    from .. import schemas
    from ..sources.dump import type_rows

    ev = proxies.table(spark, d, "events")
    names = [n for n, _ in schemas.DUMP_TABLES["badges"]]
    given = {
        "id": F.when(F.col("event_id") % 7 == 0, "n/a").otherwise(F.col("event_id").cast("string")),
        "userid": F.col("user_id").cast("string"),
        "name": F.col("event_type"),
    }
    raw = ev.select(*[given.get(n.lower(), F.lit(None)).cast("string").alias(n) for n in names])
    good, bad = type_rows(raw, "badges")
    reasons = good.select(F.lit("ok").alias("reason")).unionByName(bad.select("reason"))
    return reasons.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- models (rows-only checks)

from . import models as MD  # noqa: E402
from . import tuning as TU  # noqa: E402
from . import timemodels as TIMES  # noqa: E402

SVD_K = 8


def _labelled(spark, d) -> DataFrame:
    docs = proxies.labelled_documents(spark, d)
    return docs.select("doc_id", "text", F.col("quality").cast("double").alias("label"))


def _split(df: DataFrame, key: str):
    return SP.train_test_split(df, key, TEST_SIZE, SEED)


def _text_block(min_df=MIN_DF, max_df=MAX_DF, ngram_max=1, weight=1.0):
    return {"text": MD.TextBlock("text", "words", min_df, max_df, ngram_max, None, weight)}


def _predict_classifier(spark, d, estimator, svd_k=None, weighted=False) -> DataFrame:
    train, test = _split(_labelled(spark, d), "doc_id")
    if weighted:  # balanced on what is fitted; the test half's labels play no part
        train = FE.with_class_weight(train, "label", "weight")
    spec = MD.ModelSpec("content", _text_block(), estimator(train.count()), svd_k=svd_k)
    model = spec.fit(train)
    out = model.transform(test)
    cols = ["doc_id", "label", "prediction"]
    if "probability" in out.columns:
        return out.select(*cols, EV.positive_probability("probability").alias("score"))
    from pyspark.ml.functions import vector_to_array

    return out.select(*cols, vector_to_array("rawPrediction")[1].alias("score"))


@register("contiguous_folds", "SELECT o_orderkey AS id, ntile(3) OVER (ORDER BY o_orderkey)::INTEGER AS fold FROM orders")
def contiguous_folds(spark, d):
    """I4 for regressors: three folds of adjacent questions."""
    q = proxies.questions(spark, d).select("id")
    return SP.contiguous_folds(q, "id", 3)


@register("svd_project")
def svd_project(spark, d):
    from pyspark.ml.functions import array_to_vector, vector_to_array

    e = proxies.table(spark, d, "embeddings").select(
        "vec_id", array_to_vector("embedding").alias("v")
    )
    m = MD.TruncatedSvd("v", "p", SVD_K, algorithm="exact").fit(e)
    return m.transform(e).select("vec_id", vector_to_array("p").alias("components"))


@register("model_logistic")
def model_logistic(spark, d):
    return _predict_classifier(spark, d, lambda n: MD.logistic(1.0, n), svd_k=20)


@register("model_svc")
def model_svc(spark, d):
    return _predict_classifier(spark, d, lambda n: MD.linear_svc(1.0, n, weight_col="weight"), weighted=True)


@register("model_rf_class")
def model_rf_class(spark, d):
    return _predict_classifier(
        spark, d, lambda n: MD.forest_classifier(20, 10, weight_col="weight"), svd_k=20, weighted=True
    )


def _time_rows(spark, d) -> DataFrame:
    """Cached: models read their rows several times. An ask's list of badges is made
    only where a wait takes it."""
    t = _first_accepted(spark, d).select("id", "title", "elapsed")
    t = t.where((F.col("elapsed") > 0) & (F.col("elapsed") < BOUND_HI)).persist()
    b = prior_badges_inner(spark, d, t).select("id", "badges")
    rows = tables.bounded_with_history(t, b, "elapsed", 0, BOUND_HI)
    rows = rows.select("id", "title", "badges", F.col("elapsed").cast("double").alias("elapsed")).persist()
    rows.count()
    t.unpersist()
    return rows


def _time_blocks():
    return {
        "title": MD.TextBlock("title", "words", 1, 1.0),
        "badges": MD.TextBlock("badges", "words", 1, 1.0),
    }


@register("model_rf_reg")
def model_rf_reg(spark, d):
    df = _time_rows(spark, d).withColumn("label", F.col("elapsed"))
    train, test = _split(df, "id")
    spec = MD.ModelSpec("time_forest", _time_blocks(), MD.forest_regressor(30, 10))
    out = spec.fit(train).transform(test)
    return out.select("id", "label", "prediction")


@register("model_rf_unlimited")
def model_rf_unlimited(spark, d):
    """Random forest of the wait whose trees have no depth limit."""
    df = _time_rows(spark, d).withColumn("label", F.col("elapsed"))
    train, test = _split(df, "id")
    spec = MD.ModelSpec("time_forest_unlimited", _time_blocks(), MD.forest_regressor(10, None))
    out = spec.fit(train).transform(test)
    return out.select("id", "label", "prediction")


@register("model_linear_time")
def model_linear_time(spark, d):
    """Linear regression on log10(wait), predictions mapped back by 10**x."""
    df = _time_rows(spark, d).withColumn("label", F.log10("elapsed"))
    train, test = _split(df, "id")
    spec = MD.ModelSpec("time_linear", _time_blocks(), MD.linear_regression())
    out = spec.fit(train).transform(test)
    return out.select(
        "id", F.col("elapsed").alias("label"), F.pow(F.lit(10.0), "prediction").alias("prediction")
    )


@register("numeric_append")
def numeric_append(spark, d):
    """Text features with a numeric column beside them."""
    docs = proxies.labelled_documents(spark, d).withColumn("n_chars", F.col("n_chars").cast("double"))
    stages = MD.union_stages(_text_block(), ["n_chars"], out="features")
    out = MD.fit_staged(stages, docs).transform(docs)
    size, last = MD.size_and_last("features")
    return out.select("doc_id", size.alias("size"), last.alias("last"))


@register("cv_topk")
def cv_topk(spark, d):
    """Grid search in the shape of the reference's logistic variants:
    TF-IDF -> truncated SVD -> logistic regression, 3 stratified folds, a
    2 x 2 grid (min_df x C); the three best candidates by mean AUC."""
    df = SP.stratified_folds(_labelled(spark, d), "label", "doc_id", N_FOLDS)

    def features(p):
        stages = MD.union_stages(_text_block(p["min_df"], MAX_DF), out="features_raw", tokenize=False)
        return [*stages, MD.TruncatedSvd("features_raw", "features", p["svd_k"])]

    res = TU.grid_search(
        df,
        feature_stages=features,
        estimator=lambda p, n_train: MD.logistic(p["C"], n_train),
        feature_grid={"min_df": [2, 4], "svd_k": [20]},
        estimator_grid={"C": [0.1, 1.0]},
        kind="classification",
        parallelism=4,
        prepare=MD.tokenize_stages(_text_block()),
    )
    return TU.top_k(res, 3)


@register("time_model_eval")
def time_model_eval(spark, d):
    """M14 on title, and badges in place of paragraphs and tags: the proxy questions
    have neither. The forest is MLlib's deepest."""
    rows = _time_rows(spark, d)
    out = TIMES.evaluate(rows, _time_blocks(), seed=SEED, depth=MD.MAX_TREE_DEPTH)
    rows.unpersist()
    return out
