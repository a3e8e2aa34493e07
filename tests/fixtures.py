"""Literal rows from FIXTURES.md section 3."""

from datetime import datetime, timedelta

from pyspark.sql import types as T

D = datetime(2016, 2, 1)


def at(h, m=0, s=0, day=0):
    return D + timedelta(days=day, hours=h, minutes=m, seconds=s)


POSTS_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("posttypeid", T.IntegerType()),
        T.StructField("parentid", T.LongType()),
        T.StructField("acceptedanswerid", T.LongType()),
        T.StructField("creationdate", T.TimestampNTZType()),
        T.StructField("owneruserid", T.LongType()),
        T.StructField("tags", T.StringType()),
        T.StructField("body", T.StringType()),
        T.StructField("title", T.StringType()),
    ]
)

BODY1 = "<p>Why <code>x</code> fails?</p><p>second</p><pre><code>print(1)</code></pre>"

POSTS = [
    (1, 1, None, 11, at(10), 100, "<c#><.net>", BODY1, "q1"),
    (11, 2, 1, None, at(10, 30, 59), 200, None, "<p>a</p>", None),
    (12, 2, 1, None, at(10, 5), 201, None, "<p>b</p>", None),
    (2, 1, None, None, at(10), 101, "<python>", "<p>q2</p>", "q2"),
    (3, 1, None, 31, at(10), None, "<a><a>", "<p>q3</p>", "q3"),
    (31, 2, 3, None, at(10, day=1), 202, None, "<p>c</p>", None),
    (4, 1, None, None, at(10), 102, None, "<p>q4</p>", "q4"),
    (41, 2, 4, None, at(10, 1, day=1), 203, None, "<p>d</p>", None),
    (5, 1, None, None, at(10), 103, "<x>", "<p>q5</p>", "q5"),
    (51, 2, 5, None, at(9, 58, 30), 204, None, "<p>e</p>", None),
    (61, 2, 999, None, at(10), 205, None, "<p>f</p>", None),
    (7, 1, None, None, at(10), 104, "<y>", None, "q7"),
    (8, 4, None, None, at(10), 105, None, "<p>wiki</p>", None),
]

BADGES_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("userid", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("date", T.TimestampNTZType()),
    ]
)

BADGES = [
    (900, 100, "Teacher", at(9)),
    (901, 100, "Student", at(8)),
    (902, 100, "Late", at(10)),
    (903, 100, "After", at(11)),
]
