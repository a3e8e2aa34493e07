from datetime import datetime

from pyspark.sql import functions as F

from fixtures import BADGES, BADGES_SCHEMA, POSTS, POSTS_SCHEMA
from waitline.functions.time import elapsed_minutes
from waitline.operators import history, response, tables


def _posts(spark):
    return spark.createDataFrame(POSTS, POSTS_SCHEMA)


def _qa(spark):
    p = _posts(spark)
    return response.split_posts(p)


def test_elapsed_floors(spark):
    df = spark.createDataFrame(
        [(datetime(2016, 2, 1, 10), datetime(2016, 2, 1, 9, 58, 30)),
         (datetime(2016, 2, 1, 10), datetime(2016, 2, 1, 10, 30, 59)),
         (datetime(2016, 2, 1, 10), datetime(2016, 2, 1, 10))],
        "a timestamp_ntz, b timestamp_ntz",
    )
    got = [r[0] for r in df.select(elapsed_minutes("a", "b")).collect()]
    assert got == [-2, 30, 0]


def test_success_label_day_and_week(spark):
    q, a = _qa(spark)
    day = {r.id: r.success for r in response.success_label(q, a, 1440).collect()}
    week = {r.id: r.success for r in response.success_label(q, a, 10080).collect()}
    # 1: first answer 5 min; 2: none; 3: exactly 1440; 4: 1441; 5: -2; 7: none
    assert day == {1: 1, 2: 0, 3: 1, 4: 0, 5: 1, 7: 0}
    assert week == {1: 1, 2: 0, 3: 1, 4: 1, 5: 1, 7: 0}


def test_question_answers_drop_orphans(spark):
    q, a = _qa(spark)
    qa = response.question_answers(q, a)
    ids = sorted(r.id for r in qa.collect())
    assert ids == [1, 1, 3, 4, 5]  # answer 61 has no question in the extract
    waits = {r.elapsed for r in qa.where("id = 1").collect()}
    assert waits == {5, 30}


def test_semi_anti_failed(spark):
    q, a = _qa(spark)
    ans = sorted(r.id for r in response.answered_questions(q, a).collect())
    un = sorted(r.id for r in response.unanswered_questions(q, a).collect())
    failed = sorted(r.id for r in response.failed_questions(q, a, 1440).collect())
    assert ans == [1, 3, 4, 5]
    assert un == [2, 7]
    assert failed == [2, 4, 7]


def test_first_response_and_keep_first(spark):
    q, a = _qa(spark)
    f = response.first_response_time(q, a, tie_cols=["id"])
    got = {r.id: (r.first_id, r.elapsed) for r in f.collect()}
    assert got[1] == (12, 5)
    acc = response.first_response_time(q, a, tie_cols=["id"], accepted="acceptedanswerid")
    assert sorted(r.id for r in acc.collect()) == [1, 3]
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (1, 1, "b"), (2, 5, "z")], "k int, o int, v string")
    kept = {r.k: (r.o, r.v) for r in response.keep_first(df, "k", ["o"]).collect()}
    assert kept == {1: (1, "a"), 2: (5, "z")}


def test_answer_rate(spark):
    q, a = _qa(spark)
    r = response.answer_rate(q, a).first()
    assert (r.n_questions, r.n_answered) == (6, 4)


def test_prior_badges_strict_and_ordered(spark):
    p = _posts(spark)
    asks = response.split_posts(p)[0]
    b = spark.createDataFrame(BADGES, BADGES_SCHEMA)
    left = {r.id: r.badges for r in history.prior_events(asks, b, how="left").collect()}
    inner = {r.id: r.badges for r in history.prior_events(asks, b, how="inner").collect()}
    assert left[1] == "Student Teacher"
    assert left[2] == "" and left[3] == ""  # no badges; null owner
    assert inner == {1: "Student Teacher"}


def test_prior_badges_split_path_equals_single_range(spark):
    """Force every user into many ranges; the result must not change."""
    from waitline.plans import proxies

    d = "/root/testdata/sf0.001"
    asks, badges = proxies.asks(spark, d), proxies.badges(spark, d)
    whole = history.prior_events(asks, badges, how="left")
    split = history.prior_events(asks, badges, how="left", rows_per_split=3)
    a = sorted(tuple(r) for r in whole.collect())
    b = sorted(tuple(r) for r in split.collect())
    assert a == b and len(a) > 100
    assert any(r[3] > 5 for r in a)


def test_outer_join_and_fill(spark):
    s = spark.createDataFrame([(1, 1), (2, 0)], "id bigint, success int")
    b = spark.createDataFrame([(2, "x"), (3, "y")], "id bigint, badges string")
    out = {r.id: (r.success, r.badges) for r in tables.outer_by_id(s, b, fill={"badges": ""}).collect()}
    assert out == {1: (1, ""), 2: (0, "x"), 3: (None, "y")}


def test_bounded_filter_is_open(spark):
    w = spark.createDataFrame([(1, 0), (2, 1), (3, 1439), (4, 1440), (5, -2)], "id bigint, elapsed bigint")
    h = spark.createDataFrame([(2, "a")], "id bigint, badges string")
    got = {r.id: r.badges for r in tables.bounded_with_history(w, h, "elapsed", 0, 1440).collect()}
    assert got == {2: "a", 3: ""}


def test_scan_pushes_filters(spark):
    from waitline.plans import proxies
    from waitline.sources.files import scan_posts

    df = scan_posts(proxies.posts(spark, "/root/testdata/sf0.001"), "1995-06-17")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThan(o_orderdate" in plan
    assert "l_comment" not in plan
    assert F is not None


def test_attach_owner_drops_unowned(spark):
    posts = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, title string")
    owners = spark.createDataFrame([(1, 100)], "id bigint, owneruserid bigint")
    got = [(r.id, r.owneruserid) for r in history.attach_owner(posts, owners).collect()]
    assert got == [(1, 100)]


def test_prior_badges_one_hot_user_matches_brute_force(spark):
    import random
    from datetime import datetime, timedelta

    rnd = random.Random(5)
    t0 = datetime(2024, 1, 1)
    events = []
    for i in range(900):
        user = 0 if i % 3 == 0 else rnd.randint(1, 40)  # user 0 holds a third
        kind = "ask" if rnd.random() < 0.3 else rnd.choice(["gold", "silver", "bronze"])
        events.append((i, user, t0 + timedelta(minutes=rnd.randint(0, 5000)), kind))
    df = spark.createDataFrame(events, "id bigint, userid bigint, date timestamp_ntz, name string")
    asks = df.where("name = 'ask'").select("id", F.col("userid").alias("owneruserid"), F.col("date").alias("creationdate"))
    badges = df.where("name != 'ask'")
    got = {r.id: r.badges for r in history.prior_events(asks, badges, how="left", rows_per_split=40).collect()}
    want = {}
    for i, u, ts, k in events:
        if k != "ask":
            continue
        prior = sorted((b_ts, b_id, b_name) for b_id, b_u, b_ts, b_name in events
                       if b_name != "ask" and b_u == u and b_ts < ts)
        want[i] = " ".join(p[2] for p in prior)
    assert got == want


def test_success_label_as_of_drops_unsettled(spark):
    from datetime import datetime

    q, a = _qa(spark)
    # at 2016-02-02 00:00 every fixture question is 14 h old: younger than one day
    assert response.success_label(q, a, 1440, as_of=datetime(2016, 2, 2)).count() == 0
    settled = response.success_label(q, a, 1440, as_of=datetime(2016, 2, 3))
    assert settled.count() == 6


def test_histogram_edges(spark):
    from waitline.operators import profile

    df = spark.createDataFrame([(float(x),) for x in [0, 1, 2, 3, 10]], "v double")
    h = {r.bin: r.n for r in profile.histogram(df, F.col("v"), 5).collect()}
    assert h == {0: 2, 1: 2, 4: 1}  # width 2; the maximum falls in the last bin
    flat = spark.createDataFrame([(2.0,), (2.0,)], "v double")
    assert [(r.bin, r.n) for r in profile.histogram(flat, F.col("v"), 5).collect()] == [(0, 2)]
    assert profile.bin_edges(0.0, 10.0, 5) == [0.0, 2.0, 4.0, 6.0, 8.0, 10.0]
