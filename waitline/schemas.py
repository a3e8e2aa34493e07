"""Table schemas of the Q&A dump and the stage tables (A2).

Column names are lower case, as the SQL store returned them to the
reference. Ids are ``bigint``, codes ``int``, times ``timestamp_ntz`` (the
dump carries no zone). ``users.displayname`` is a string: the reference
declared it a date by mistake.
"""

from __future__ import annotations

from pyspark.sql import types as T

L, I, S, TS = T.LongType(), T.IntegerType(), T.StringType(), T.TimestampNTZType()

# fixed values: the dump's tables and columns
DUMP_TABLES: dict[str, list[tuple[str, T.DataType]]] = {
    "badges": [("id", L), ("userid", L), ("name", S), ("date", TS)],
    "comments": [("id", L), ("postid", L), ("score", I), ("text", S), ("creationdate", TS), ("userid", L)],
    "posts": [
        ("id", L), ("posttypeid", I), ("parentid", L), ("acceptedanswerid", L), ("creationdate", TS),
        ("score", I), ("viewcount", I), ("body", S), ("owneruserid", L), ("lasteditoruserid", L),
        ("lasteditordisplayname", S), ("lasteditdate", TS), ("lastactivitydate", TS),
        ("communityowneddate", TS), ("title", S), ("tags", S), ("answercount", I),
        ("commentcount", I), ("favoritecount", I), ("closeddate", TS),
    ],
    "votes": [("id", L), ("postid", L), ("userid", L), ("votetypeid", I), ("creationdate", TS)],
    "users": [
        ("id", L), ("reputation", I), ("creationdate", TS), ("displayname", S), ("lastaccessdate", TS),
        ("websiteurl", S), ("location", S), ("age", I), ("aboutme", S), ("views", I),
        ("upvotes", I), ("downvotes", I),
    ],
    "tags": [("id", L), ("tagname", S), ("count", I), ("excerptpostid", L), ("wikipostid", L)],
}

KEYS = {t: "id" for t in DUMP_TABLES}

# fixed values: post types
POST_TYPES = {1: "Question", 2: "Answer"}

# fixed values: vote types
VOTE_TYPES = {
    1: "AcceptedByOriginator", 2: "UpMod", 3: "DownMod", 4: "Offensive", 5: "Favorite",
    6: "Close", 7: "Reopen", 8: "BountyStart", 9: "BountyClose", 10: "Deletion",
    11: "Undeletion", 12: "Spam", 13: "InformModerator", 15: "ModeratorReview",
    16: "ApproveEditSuggestion",
}


def struct(table: str) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in DUMP_TABLES[table]])


def string_struct(table: str) -> T.StructType:
    """Every column as a string: the raw read before typed casts."""
    return T.StructType([T.StructField(n, S, True) for n, _ in DUMP_TABLES[table]])


STAGES: dict[str, list[tuple[str, T.DataType]]] = {
    "posts_extracted": [
        ("title", S), ("paragraphs", S), ("id", L), ("posttypeid", I), ("acceptedanswerid", L),
        ("creationdate", TS), ("tags", S), ("parentid", L), ("codes", S),
    ],
    "questioner": [("id", L), ("owneruserid", L)],
    "earned_badges": [("badges", S), ("userid", L), ("id", L)],
    "content": [("title", S), ("paragraphs", S), ("tags", S), ("hascodes", I), ("id", L), ("success", I)],
    "time": [("title", S), ("paragraphs", S), ("tags", S), ("hascodes", I), ("elapsed", L), ("id", L)],
    "badge_success": [("success", I), ("id", L), ("badges", S)],
    "badge_time": [("id", L), ("elapsed", L), ("badges", S)],
}


def stage_struct(name: str) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in STAGES[name]])
