"""Question/answer response times.

Inputs are a questions frame and an answers frame; column names are
parameters. Every wait is in whole minutes, floored like the reference.

Scale notes: answers are reduced to one row per question (``min`` of the
answer time, a partial + final hash aggregate) *before* any join, since the
minimum of floored waits is the floored wait of the earliest answer. A hot
question with a third of all answers is therefore combined map-side and never
lands whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.time import ONE_DAY_MINUTES, elapsed_minutes


def split_posts(posts: DataFrame, type_col: str = "posttypeid") -> tuple[DataFrame, DataFrame]:
    """(questions, answers) by post type 1 / 2."""
    return posts.where(F.col(type_col) == 1), posts.where(F.col(type_col) == 2)


def questions_by_parent(posts: DataFrame, parent: str = "parentid") -> DataFrame:
    """The notebook rule: a post without a parent is a question."""
    return posts.where(F.col(parent).isNull())


def has_codes(codes: str = "codes"):
    """1 when the extracted code text is present, else 0."""
    return F.col(codes).isNotNull().cast("int")


def question_answers(
    questions: DataFrame,
    answers: DataFrame,
    q_id: str = "id",
    a_parent: str = "parentid",
    created: str = "creationdate",
    keep_q: Sequence[str] = (),
    keep_a: Sequence[str] = (),
) -> DataFrame:
    """Every (question, answer) pair with the wait in minutes.

    Output: ``id, question_date, answer_date, elapsed`` plus kept columns.
    """
    q = questions.select(
        F.col(q_id).alias("id"), F.col(created).alias("question_date"), *keep_q
    )
    a = answers.select(
        F.col(a_parent).alias("_parent"), F.col(created).alias("answer_date"), *keep_a
    )
    return (
        q.join(a, q["id"] == a["_parent"], "inner")
        .drop("_parent")
        .withColumn("elapsed", elapsed_minutes("question_date", "answer_date"))
    )


def first_answer_time(
    answers: DataFrame, a_parent: str = "parentid", created: str = "creationdate"
) -> DataFrame:
    """One row per question: ``(_parent, first_answer_date)``."""
    return answers.groupBy(F.col(a_parent).alias("_parent")).agg(
        F.min(created).alias("first_answer_date")
    )


def first_answers(
    answers: DataFrame,
    tie_cols: Sequence[str] = (),
    a_parent: str = "parentid",
    created: str = "creationdate",
) -> DataFrame:
    """One row per question with its earliest answer (argmin of
    ``(created, *tie_cols)``): ``_parent, first_answer_date, _f``.

    Pass the same frame as ``first=`` to ``success_label`` and
    ``first_response_time`` when a plan needs both: the answers are then
    scanned and shuffled once and the exchange is reused.
    """
    agg = answers.groupBy(F.col(a_parent).alias("_parent")).agg(
        F.min(F.struct(F.col(created).alias("d"), *[F.col(c) for c in tie_cols])).alias("_f")
    )
    return agg.withColumn("first_answer_date", F.col("_f.d"))


def shortest_elapsed(
    questions: DataFrame,
    answers: DataFrame,
    q_id: str = "id",
    a_parent: str = "parentid",
    created: str = "creationdate",
) -> DataFrame:
    """Minimum wait per answered question (D1): ``id, min_elapsed``."""
    first = first_answer_time(answers, a_parent, created)
    q = questions.select(F.col(q_id).alias("id"), F.col(created).alias("_qd"))
    return q.join(first, q["id"] == first["_parent"], "inner").select(
        "id", elapsed_minutes("_qd", "first_answer_date").alias("min_elapsed")
    )


def late_questions(
    questions: DataFrame, answers: DataFrame, deadline: int = ONE_DAY_MINUTES, **cols
) -> DataFrame:
    """Answered questions whose first answer came after the deadline."""
    return (
        shortest_elapsed(questions, answers, **cols)
        .where(F.col("min_elapsed") > deadline)
        .select("id")
    )


def answered_questions(
    questions: DataFrame, answers: DataFrame, q_id: str = "id", a_parent: str = "parentid"
) -> DataFrame:
    """Questions with at least one answer (C7, semi join). Parent ids are
    de-duplicated map-side first, so only distinct keys are shuffled."""
    a = answers.select(F.col(a_parent).alias("_parent")).distinct()
    return questions.join(a, questions[q_id] == a["_parent"], "left_semi")


def unanswered_questions(
    questions: DataFrame, answers: DataFrame, q_id: str = "id", a_parent: str = "parentid"
) -> DataFrame:
    """Questions without any answer (C8, anti join; never ``NOT IN``)."""
    a = answers.select(F.col(a_parent).alias("_parent")).distinct()
    return questions.join(a, questions[q_id] == a["_parent"], "left_anti")


def failed_questions(
    questions: DataFrame,
    answers: DataFrame,
    deadline: int = ONE_DAY_MINUTES,
    q_id: str = "id",
    a_parent: str = "parentid",
    created: str = "creationdate",
) -> DataFrame:
    """Unanswered ids union all late ids (G1)."""
    un = unanswered_questions(questions, answers, q_id, a_parent).select(F.col(q_id).alias("id"))
    late = late_questions(
        questions, answers, deadline, q_id=q_id, a_parent=a_parent, created=created
    )
    return un.unionByName(late)


def success_label(
    questions: DataFrame,
    answers: DataFrame,
    deadline: int = ONE_DAY_MINUTES,
    q_id: str = "id",
    a_parent: str = "parentid",
    created: str = "creationdate",
    keep: Sequence[str] = (),
    as_of=None,
    first: DataFrame | None = None,
) -> DataFrame:
    """Success = first answer within ``deadline`` minutes.

    Unanswered and late questions get 0 (the reference's failed list). A
    negative wait (answer stamped before the question) counts as success,
    as in the reference. ``as_of`` (a timestamp) optionally drops questions
    younger than the deadline at the snapshot, which the reference labels
    failed by default (right-censoring).
    Output: kept columns, ``id``, ``success``. ``first`` is an optional
    precomputed ``first_answers`` frame.
    """
    if first is None:
        first = first_answer_time(answers, a_parent, created)
    first = first.select("_parent", "first_answer_date")
    q = questions.select(F.col(q_id).alias("id"), F.col(created).alias("_qd"), *keep)
    if as_of is not None:
        q = q.where(elapsed_minutes("_qd", F.lit(as_of).cast("timestamp_ntz")) >= deadline)
    j = q.join(first, q["id"] == first["_parent"], "left")
    wait = elapsed_minutes("_qd", "first_answer_date")
    return j.select(
        *keep,
        "id",
        F.when(wait <= deadline, F.lit(1)).otherwise(F.lit(0)).alias("success"),
    )


def answer_rate(
    questions: DataFrame, answers: DataFrame, q_id: str = "id", a_parent: str = "parentid"
) -> DataFrame:
    """Answered / total questions in one pass."""
    first = answers.select(F.col(a_parent).alias("_parent")).distinct()
    j = questions.select(F.col(q_id).alias("id")).join(
        first, F.col("id") == F.col("_parent"), "left"
    )
    return j.agg(
        F.count(F.lit(1)).alias("n_questions"),
        F.count_if(F.col("_parent").isNotNull()).alias("n_answered"),
    ).withColumn(
        "answered_share", F.round(F.col("n_answered") / F.col("n_questions"), 6)
    )


def response_time(
    questions: DataFrame,
    answers: DataFrame,
    q_id: str = "id",
    a_parent: str = "parentid",
    created: str = "creationdate",
    accepted: str = "acceptedanswerid",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Waits of all answers of questions that have an accepted answer (M4).

    The filter is on the *question's* accepted id, as in the reference, so
    every answer of such a question is listed. Output: kept, ``elapsed``, ``id``.
    """
    q = questions.where(F.col(accepted).isNotNull())
    qa = question_answers(q, answers, q_id, a_parent, created, keep_q=keep)
    return qa.select(*keep, "elapsed", "id")


def first_response_time(
    questions: DataFrame,
    answers: DataFrame,
    tie_cols: Sequence[str] = (),
    q_id: str = "id",
    a_parent: str = "parentid",
    created: str = "creationdate",
    accepted: str | None = None,
    keep: Sequence[str] = (),
    first: DataFrame | None = None,
) -> DataFrame:
    """Earliest answer per question and its wait (D3, C3, M11; D7 keep-first).

    The first answer is the argmin of ``(created, *tie_cols)``, taken with
    ``min(struct)`` in a partial + final aggregate, so a question with many
    answers never needs its answers in one task. ``accepted`` restricts to
    questions that have an accepted answer (B5).
    Output: kept, ``id, question_date, first_answer_date, elapsed`` and
    ``first_<tie>`` for each tie column.
    """
    q = questions
    if accepted is not None:
        q = q.where(F.col(accepted).isNotNull())
    q = q.select(F.col(q_id).alias("id"), F.col(created).alias("question_date"), *keep)
    if first is None:
        first = first_answers(answers, tie_cols, a_parent, created)
    first = first.select("_parent", "_f")
    j = q.join(first, q["id"] == first["_parent"], "inner")
    return j.select(
        *keep,
        "id",
        "question_date",
        F.col("_f.d").alias("first_answer_date"),
        *[F.col(f"_f.{c}").alias(f"first_{c}") for c in tie_cols],
        elapsed_minutes("question_date", F.col("_f.d")).alias("elapsed"),
    )


def keep_first(df: DataFrame, key: str, order_cols: Sequence[str]) -> DataFrame:
    """One row per key, the first by ``order_cols`` then all other columns.

    ``dropDuplicates`` keeps an arbitrary row; this keeps a defined one. It is
    a ``min(struct)`` aggregate, so a hot key is combined map-side instead of
    being sorted whole in one window task.
    """
    rest = [c for c in df.columns if c != key and c not in order_cols]
    packed = F.struct(*[F.col(c) for c in [*order_cols, *rest]])
    return df.groupBy(key).agg(F.min(packed).alias("_first")).select(
        key, *[F.col(f"_first.{c}").alias(c) for c in [*order_cols, *rest]]
    )
