"""School analyses on `student`, `course`, `teacher` and `score` tables.

`score` has one row per student and course. Sorted results break ties by id, so
that a repeated run gives the same order and equal values do not pile up in one
range partition.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import count_if, first_char
from tidemark.operators.groups import all_rows, equal_scores, has_all, has_any, has_none, join_on, pivot_sum

NAMED = ["stu_id", "stu_name"]


# -- filters and counts -------------------------------------------------------


def name_contains(rows: DataFrame, column: str, text: str) -> DataFrame:
    return rows.filter(F.col(column).contains(text))


def prefix_count(rows: DataFrame, column: str, prefix: str) -> DataFrame:
    return rows.filter(F.col(column).startswith(prefix)).agg(F.count("*").alias("num"))


def course_scores_below(score: DataFrame, course_id: object, limit: int) -> DataFrame:
    low = score.filter((F.col("course_id") == course_id) & (F.col("score") < limit))
    return low.select("stu_id", "course_id", "score").orderBy(F.desc("score"), "stu_id")


def failed_in_course(
    student: DataFrame, course: DataFrame, score: DataFrame, course_name: str, limit: int
) -> DataFrame:
    named = course.filter(F.col("course_name") == course_name).select("course_id")
    low = score.filter(F.col("score") < limit).join(named, "course_id")
    return student.join(low, "stu_id").select(*NAMED, "score").orderBy("stu_id")


# -- aggregates ---------------------------------------------------------------


def course_total(score: DataFrame, course_id: object) -> DataFrame:
    return score.filter(F.col("course_id") == course_id).agg(F.sum("score").alias("sum_score"))


def distinct_takers(score: DataFrame) -> DataFrame:
    return score.agg(F.count_distinct("stu_id").alias("stu_num"))


def course_max_min(score: DataFrame) -> DataFrame:
    return score.groupBy("course_id").agg(F.max("score").alias("max_score"), F.min("score").alias("min_score"))


def course_takers(score: DataFrame) -> DataFrame:
    return score.groupBy("course_id").agg(F.count_distinct("stu_id").alias("stu_num"))


def two_way_count(student: DataFrame, male: str, female: str) -> DataFrame:
    sex = F.col("sex")
    return pivot_sum(student, [], {"male_num": sex == male, "female_num": sex == female})


def students_averaging_over(score: DataFrame, limit: float) -> DataFrame:
    averages = score.groupBy("stu_id").agg(F.avg("score").alias("avg_score"))
    return averages.filter(F.col("avg_score") > limit)


def students_with_courses(score: DataFrame, at_least: int) -> DataFrame:
    counts = score.groupBy("stu_id").agg(F.count("course_id").alias("n"))
    return counts.filter(F.col("n") >= at_least).select("stu_id")


def shared_first_char(rows: DataFrame, column: str, min_count: int = 2) -> DataFrame:
    firsts = rows.groupBy(first_char(F.col(column)).alias("first_name"))
    return firsts.agg(F.count(F.col(column)).alias("name_num")).filter(F.col("name_num") >= min_count)


def course_averages(score: DataFrame) -> DataFrame:
    averages = score.groupBy("course_id").agg(F.avg("score").alias("avg_score"))
    return averages.orderBy(F.asc("avg_score"), F.desc("course_id"))


def courses_with_takers(score: DataFrame, at_least: int) -> DataFrame:
    return score.groupBy("course_id").agg(F.count("*").alias("num")).filter(F.col("num") >= at_least)


def student_sums(score: DataFrame) -> DataFrame:
    totals = score.groupBy("stu_id").agg(F.sum("score").alias("sum_score"))
    return totals.orderBy(F.desc("sum_score"), "stu_id")


def score_pivot(course: DataFrame, score: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """One column per named course, then the number of courses and their average.

    ``columns`` maps the wanted column name to the course name.
    """
    rows = score.join(course.select("course_id", "course_name"), "course_id")
    sums = [
        F.sum(F.when(F.col("course_name") == name, F.col("score")).otherwise(0)).alias(column)
        for column, name in columns.items()
    ]
    wide = rows.groupBy("stu_id").agg(
        *sums, F.count("course_id").alias("course_cnt"), F.avg("score").alias("avg_score")
    )
    return wide.orderBy(F.desc("avg_score"), "stu_id")


def students_with_n_courses(student: DataFrame, score: DataFrame, n: int, including: object | None = None) -> DataFrame:
    """Students with exactly n courses, one of them a given course if there is one."""
    counts = score.groupBy("stu_id").agg(
        F.count("course_id").alias("n"),
        (F.lit(True) if including is None else F.bool_or(F.col("course_id") == including)).alias("has"),
    )
    return _named(student, counts.filter((F.col("n") == n) & F.col("has")))


# -- conditions over all rows of a student ------------------------------------


def all_below(student: DataFrame, score: DataFrame, limit: int) -> DataFrame:
    """A missing result counts against the student, a student without results is left out."""
    return _named(student, all_rows(score, "stu_id", F.col("score") < limit))


def not_all_courses(student: DataFrame, course: DataFrame, score: DataFrame) -> DataFrame:
    """Students with fewer courses than there are, also those with none."""
    offered = course.agg(F.count("course_id")).scalar()
    counts = score.groupBy("stu_id").agg(F.count("course_id").alias("n"))
    return student.join(counts, "stu_id", "left").filter(F.coalesce("n", F.lit(0)) < offered).select(*NAMED)


def all_above_listing(student: DataFrame, course: DataFrame, score: DataFrame, limit: int) -> DataFrame:
    """All results of the students who are above the limit everywhere; a missing result passes."""
    good = all_rows(score, "stu_id", F.col("score") > limit, null_passes=True)
    rows = _with_course(score.join(student.join(good, "stu_id", "left_semi"), "stu_id"), course)
    return rows.select("stu_name", "course_name", "score").orderBy("score", "stu_name", "course_name")


# -- joined listings ----------------------------------------------------------


def failing_averages(student: DataFrame, score: DataFrame, limit: int, at_least: int = 2) -> DataFrame:
    """Average over all courses of students who fail several."""
    totals = score.groupBy("stu_id").agg(
        F.avg("score").alias("avg_score"), count_if(F.col("score") < limit).alias("fails")
    )
    weak = totals.filter(F.col("fails") >= at_least).select("stu_id", "avg_score")
    return weak.join(student, "stu_id", "left_semi")


def student_totals(student: DataFrame, score: DataFrame) -> DataFrame:
    """Course count and total of every student; without results the total is null."""
    totals = score.groupBy("stu_id").agg(F.count("course_id").alias("n"), F.sum("score").alias("sum_score"))
    return student.join(totals, "stu_id", "left").select(
        *NAMED, F.coalesce("n", F.lit(0)).alias("course_count"), "sum_score"
    )


def averages_above(student: DataFrame, score: DataFrame, limit: float) -> DataFrame:
    return student.join(students_averaging_over(score, limit), "stu_id").select(*NAMED, "avg_score")


def enrolment(student: DataFrame, course: DataFrame, score: DataFrame) -> DataFrame:
    return score.join(course, "course_id").join(student, "stu_id").select(*NAMED, "course_id", "course_name")


def pass_fail_counts(course: DataFrame, score: DataFrame, limit: int) -> DataFrame:
    counts = pivot_sum(
        score, "course_id", {"pass_cnt": F.col("score") >= limit, "fail_cnt": F.col("score") < limit}
    )
    return course.join(counts, "course_id").select("course_id", "course_name", "pass_cnt", "fail_cnt")


def course_above(student: DataFrame, course: DataFrame, score: DataFrame, course_id: object, limit: int) -> DataFrame:
    good = score.filter((F.col("course_id") == course_id) & (F.col("score") > limit))
    rows = good.join(student, "stu_id").join(course, "course_id")
    return rows.select(*NAMED, "course_id", "course_name", "score")


def course_below_students(student: DataFrame, score: DataFrame, course_id: object, limit: int) -> DataFrame:
    low = score.filter((F.col("course_id") == course_id) & (F.col("score") < limit)).select("stu_id", "score")
    return student.join(low, "stu_id").select(*student.columns, "score").orderBy(F.desc("score"), "stu_id")


def same_score_in_courses(score: DataFrame, repeat: bool = False, tasks: int = 0) -> DataFrame:
    """Results a student also has in another course, with the number of those courses.

    ``repeat`` lists a result once per such course instead.
    """
    return equal_scores(score, "stu_id", "course_id", "score", repeat, tasks)


def course_beats(score: DataFrame, better: object, worse: object) -> DataFrame:
    """Students with a higher result in one course than in the other, in one aggregate."""
    course, result = F.col("course_id"), F.col("score")
    both = score.filter(course.isin(better, worse)).groupBy("stu_id")
    ends = both.agg(
        F.max(F.when(course == better, result)).alias("high"), F.min(F.when(course == worse, result)).alias("low")
    )
    return ends.filter(F.col("high") > F.col("low")).select("stu_id")


# -- set logic on courses -----------------------------------------------------


def took_both(student: DataFrame, score: DataFrame, a: object, b: object) -> DataFrame:
    """By semi-join: students of one course who also appear in the other."""
    first = score.filter(F.col("course_id") == a).select("stu_id")
    second = score.filter(F.col("course_id") == b).select("stu_id")
    return _named(student, first.join(second, "stu_id", "left_semi"))


def took_both_by_count(student: DataFrame, score: DataFrame, a: object, b: object) -> DataFrame:
    """The same by counting distinct courses."""
    return _named(student, has_all(score, "stu_id", "course_id", [a, b]))


def courses_of(course: DataFrame, teacher: DataFrame, tea_name: str) -> DataFrame:
    named = teacher.filter(F.col("tea_name") == tea_name)
    return course.join(named, "tea_id", "left_semi").select("course_id")


def took_all_of(
    student: DataFrame, course: DataFrame, teacher: DataFrame, score: DataFrame, tea_name: str
) -> DataFrame:
    return _named(student, has_all(score, "stu_id", "course_id", courses_of(course, teacher, tea_name)))


def took_any_of(
    student: DataFrame, course: DataFrame, teacher: DataFrame, score: DataFrame, tea_name: str
) -> DataFrame:
    """By semi-joins from the students down to the teacher."""
    return _named(student, has_any(score, "stu_id", "course_id", courses_of(course, teacher, tea_name)))


def took_any_of_by_join(
    student: DataFrame, course: DataFrame, teacher: DataFrame, score: DataFrame, tea_name: str
) -> DataFrame:
    """The same by joining through and removing repeats."""
    taught = course.join(teacher.filter(F.col("tea_name") == tea_name), "tea_id")
    return score.join(taught, "course_id").select("stu_id").distinct().join(student, "stu_id").select(*NAMED)


def took_none_of(
    student: DataFrame, course: DataFrame, teacher: DataFrame, score: DataFrame, tea_name: str
) -> DataFrame:
    """Also students without any result."""
    return has_none(student, score, "stu_id", "course_id", courses_of(course, teacher, tea_name)).select(*NAMED)


def shares_course_with(student: DataFrame, score: DataFrame, stu_id: object) -> DataFrame:
    """Other students with at least one course in common with the given one."""
    theirs = score.filter(F.col("stu_id") == stu_id).select("course_id")
    others = score.filter(F.col("stu_id") != stu_id)
    return _named(student, has_any(others, "stu_id", "course_id", theirs))


def scores_with_average(student: DataFrame, course: DataFrame, score: DataFrame) -> DataFrame:
    """Every result beside the student's average, best average first.

    The averages join the students first, so that the results are shuffled by student once.
    """
    averages = score.groupBy("stu_id").agg(F.avg("score").alias("avg_score"))
    rows = _with_course(score.join(student.join(averages, "stu_id"), "stu_id"), course)
    return rows.select(*NAMED, "course_id", "course_name", "score", "avg_score").orderBy(
        F.desc("avg_score"), "stu_id", "course_id"
    )


def _with_course(rows: DataFrame, course: DataFrame) -> DataFrame:
    """Join the course of a result, where the results are also used without courses.

    A plain join would add a null filter to this use of the results only; both
    uses would then be read and shuffled apart. The null-safe join leaves them alike.
    """
    return join_on(rows, course.filter(F.col("course_id").isNotNull()), "course_id")


def _named(student: DataFrame, chosen: DataFrame, *more: Column) -> DataFrame:
    return student.join(chosen, "stu_id", "left_semi").select(*NAMED, *more)
