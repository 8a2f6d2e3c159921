from datetime import datetime

from lms import BIG, mart, records
from pyspark.sql import functions as F

from coursemart.plans import TABLES, sql_table
from coursemart.plans.courses import courses
from coursemart.plans.registry import SPARK_TYPES, conform, parse_columns
from coursemart.plans.requirements import REQUIREMENTS, requirement_flags

EXCLUDED = BIG + 4

ENROLLED = dict(
    role_dim=[{"id": 1, "name": "StudentEnrollment"}, {"id": 2, "name": "TeacherEnrollment"},
              {"id": 3, "name": "TaEnrollment"}, {"id": 4, "name": "Grader"}],
    user_dim=[{"id": 10, "name": "Ann"}, {"id": 11, "name": "Bob"}, {"id": 12, "name": "Cy"}],
    enrollment_dim=[
        {"id": 1, "user_id": 10, "role_id": 1, "course_id": 100, "type": "StudentEnrollment", "workflow_state": "active"},
        {"id": 2, "user_id": 10, "role_id": 1, "course_id": 101, "type": "StudentEnrollment", "workflow_state": "active"},
        {"id": 3, "user_id": 11, "role_id": 2, "course_id": 100, "type": "TeacherEnrollment", "workflow_state": "active"},
        {"id": 4, "user_id": 12, "role_id": 2, "course_id": 100, "type": "TeacherEnrollment", "workflow_state": "deleted"},
        {"id": 5, "user_id": 12, "role_id": 3, "course_id": 100, "type": "TaEnrollment", "workflow_state": "active"},
        {"id": 6, "user_id": 13, "role_id": 1, "course_id": 100, "type": "OddEnrollment", "workflow_state": "active"},
        {"id": 7, "user_id": 12, "role_id": 2, "course_id": 100, "type": "TeacherEnrollment", "workflow_state": "active"},
        {"id": 8, "user_id": 11, "role_id": 2, "course_id": 102, "type": "TeacherEnrollment", "workflow_state": "active"},
    ],
    account_dim=[{"id": 7, "name": "Music"}],
    enrollment_term_dim=[
        {"id": 1, "name": "Fall 2015", "date_start": datetime(2015, 9, 1), "date_end": datetime(2015, 11, 30)},
        {"id": 2, "name": "Default Term"},
        {"id": EXCLUDED, "name": "Winter 2016"},
    ],
    course_dim=[
        {"id": 100, "account_id": 7, "enrollment_term_id": 1, "name": "Song", "code": "S1", "workflow_state": "available"},
        {"id": 101, "account_id": 7, "enrollment_term_id": 2, "name": "Choir", "code": "C1", "workflow_state": "claimed"},
        {"id": 102, "account_id": 7, "enrollment_term_id": EXCLUDED, "name": "Opera", "workflow_state": "available"},
        {"id": 103, "account_id": 7, "enrollment_term_id": None, "name": "Empty", "workflow_state": "available"},
        {"id": 104, "account_id": 8, "enrollment_term_id": 1, "name": "Lost", "workflow_state": "available"},
        {"id": 105, "account_id": 7, "enrollment_term_id": 1, "name": "Gone", "workflow_state": "deleted"},
    ],
)


def test_declared_types_are_known():
    for spec in TABLES.values():
        for _, declared in spec.columns:
            assert declared.split("(")[0] in SPARK_TYPES


def test_conform_fills_missing_columns_and_cuts_text_on_request(spark):
    df = spark.createDataFrame([("abcdef", 3)], "a string, b int")
    columns = parse_columns("b bigint, a varchar(4), c timestamp, d text")
    out = conform(df, columns)
    assert out.columns == ["b", "a", "c", "d"]
    assert tuple(out.first()) == (3, "abcdef", None, None)
    assert tuple(conform(df, columns, cut_text=True).first()) == (3, "abcd", None, None)


def test_people(spark):
    m = mart(spark, **ENROLLED)
    assert records(m.aux("Students"), "user_id", "student_name") == [(10, "Ann"), (13, None)]
    assert records(m.aux("Instructors"), "user_id", "instructor_name") == [(11, "Bob"), (12, "Cy")]
    # 'TAEnrollment' is looked for, 'TaEnrollment' is what the data says.
    assert records(m.aux("TeachingAssistants"), "user_id", "ta_name") == [(12, "Cy")]
    assert records(m.aux("Graders"), "user_id") == []
    everyone = records(m.aux("AllUsers"), "seq_num", "user_id", "name", "role")
    assert len(everyone) == 8
    assert everyone[0] == (1, 10, "Ann", "student")
    assert everyone[5] == (6, 13, None, None)


def test_courses(spark):
    m = mart(spark, **ENROLLED)
    found = records(m.aux("Courses"), "course_id", "quarter_name_canvas", "term_name", "account_name", "enrollment")
    assert found == [
        (100, "Fall 2015", "Fall 2015", "Music", 6),
        # The name of the default term is excluded, so the columns keep their NULL.
        (101, None, None, "Music", 1),
        (102, "Winter 2016", "Winter 2016", "Music", 1),
        # No enrolment at all still counts 1.
        (103, None, None, "Music", 1),
    ]
    exact = conform(courses(m, exact_enrollment=True), TABLES["Courses"].columns)
    assert records(exact, "course_id", "enrollment") == [(100, 6), (101, 1), (102, 1), (103, 0)]
    assert len(m.aux("Courses").columns) == 22


def test_who_teaches_and_takes_courses(spark):
    m = mart(spark, **ENROLLED)
    assert records(m.aux("CourseInstructor"), "user_id", "course_id", "instructor_name", "enrollment_term_name") == [
        (11, 100, "Bob", "Fall 2015"), (12, 100, "Cy", "Fall 2015"),
    ]
    assert records(m.aux("CourseInstructorTeams"), "course_id", "enrollment_term_id", "instructor_team") == [
        (100, 1, "Bob, Cy")
    ]
    taken = records(m.aux("CourseEnrollment"), "enrollmentid", "course_id", "enrollment_term_name", "instructor_team")
    # Course 101 is not available, 102 lies in an excluded term, and a NULL term is neither in nor out of the list.
    assert taken == [(i, 100, "Fall 2015", "Bob, Cy") for i in (1, 3, 5, 6, 7)]


def test_student_units_keep_accounts_without_courses(spark):
    m = mart(spark, account_dim=[{"id": 1, "name": "A"}, {"id": 2, "name": "B"}],
             course_dim=[{"id": 5, "account_id": 1, "name": "x", "workflow_state": "claimed"}])
    assert records(m.aux("StudentUnits"), "account_id", "course_id", "enrollment") == [(1, 5, 1), (2, None, None)]


def test_submissions_use_the_group_id_unless_fixed(spark):
    tables = dict(
        submission_dim=[
            {"id": 1, "assignment_id": 50, "user_id": 10, "published_grade": "A"},
            {"id": 2, "assignment_id": 51, "user_id": 11},
            {"id": 3, "assignment_id": 52, "user_id": 11},
        ],
        submission_fact=[
            {"submission_id": 1, "assignment_id": 50, "course_id": 100, "enrollment_term_id": 1, "published_score": 0.5},
            {"submission_id": 2, "assignment_id": 51, "course_id": 100, "enrollment_term_id": EXCLUDED},
            {"submission_id": 3, "assignment_id": 99, "course_id": 100, "enrollment_term_id": 1},
        ],
        assignment_fact=[{"assignment_id": 50, "course_id": 100, "points_possible": 9.5}],
        assignment_dim=[
            {"id": 50, "assignment_group_id": 7, "title": "right"},
            {"id": 61, "assignment_group_id": 50, "title": "later"},
            {"id": 60, "assignment_group_id": 50, "title": "zz first by id"},
        ],
        course_dim=[{"id": 100, "enrollment_term_id": 1, "name": "Song"}, {"id": 100, "enrollment_term_id": 2, "name": "x"}],
        enrollment_term_dim=[{"id": 1, "name": "Fall 2015"}],
    )
    columns = ("submission_id", "course_name", "term_name", "assignment_name", "points_possible", "grade_numeric")
    assert records(mart(spark, **tables).aux("AssignmentSubmissions"), *columns) == [
        (1, "Song", "Fall 2015", "zz first by id", 9.5, 0.5)
    ]
    fixed = mart(spark, key_fix=True, **tables).aux("AssignmentSubmissions")
    assert records(fixed, *columns) == [(1, "Song", "Fall 2015", "right", 9.5, 0.5)]


def test_course_assignments(spark):
    m = mart(
        spark,
        assignment_dim=[
            {"id": 1, "course_id": 100, "assignment_group_id": 20, "title": "essay", "workflow_state": "published"},
            {"id": 2, "course_id": 100, "assignment_group_id": 21, "title": "other course", "workflow_state": "published"},
            {"id": 3, "course_id": 100, "assignment_group_id": 20, "title": "draft", "workflow_state": "unpublished"},
            {"id": 4, "course_id": 105, "assignment_group_id": 22, "title": "deleted", "workflow_state": "published"},
        ],
        assignment_group_dim=[
            {"id": 20, "course_id": 100, "name": "Group"}, {"id": 21, "course_id": 101}, {"id": 22, "course_id": 105},
        ],
        quiz_dim=[
            {"id": 9, "name": "second", "workflow_state": "published"},
            {"id": 8, "name": "first", "workflow_state": "published"},
            {"id": 7, "name": "hidden", "workflow_state": "deleted"},
            {"id": 6, "name": "no assignment", "workflow_state": "published"},
            {"id": 5, "name": "no fact", "workflow_state": "published"},
        ],
        quiz_fact=[
            {"quiz_id": 9, "course_id": 100}, {"quiz_id": 8, "course_id": 100, "time_limit": 30},
            {"quiz_id": 7, "course_id": 100}, {"quiz_id": 6, "course_id": 101, "points_possible": 4.0},
        ],
        assignment_group_score_fact=[
            {"score_id": 2, "assignment_group_id": 20, "course_id": 100, "current_score": 1.0},
            {"score_id": 1, "assignment_group_id": 20, "course_id": 100, "current_score": 2.0},
        ],
        assignment_group_fact=[{"assignment_group_id": 1, "group_weight": 0.25}],
        course_dim=[
            {"id": 100, "account_id": 7, "name": "Song", "workflow_state": "available"},
            {"id": 101, "account_id": 7, "name": "Choir", "workflow_state": "available"},
            {"id": 105, "account_id": 7, "name": "Gone", "workflow_state": "deleted"},
        ],
    )
    columns = ("assignment_id", "course_id", "course_name", "quiz_id", "quiz_name", "points_possible", "current_score",
               "group_assignment_weight")
    assert records(m.aux("CourseAssignments"), *columns) == [
        (1, 100, "Song", 8, "first", None, 2.0, 0.25),
        (None, 101, "Choir", 6, "no assignment", 4.0, None, None),
        (None, None, None, 5, "no fact", None, None, None),
    ]


def test_discussions(spark):
    tables = dict(
        discussion_topic_dim=[
            {"id": 1, "course_id": 100, "title": "t" * 300, "type": None, "workflow_state": "active"},
            {"id": 2, "course_id": 999, "title": "lone", "type": "Announcement", "workflow_state": "active"},
            {"id": 3, "course_id": 100, "title": "dead", "workflow_state": "deleted"},
        ],
        discussion_topic_fact=[{"discussion_topic_id": 1, "user_id": 10, "message_length": 40}],
        discussion_entry_fact=[
            {"discussion_entry_id": 77, "topic_id": 1, "user_id": 11}, {"discussion_entry_id": 78, "topic_id": 1, "user_id": 10},
            {"discussion_entry_id": 1, "topic_id": 5, "user_id": 12},
        ],
        **ENROLLED,
    )
    m = mart(spark, **tables)
    columns = ("disc_topic_id", "disc_topic_author_name", "disc_topic_author_role", "disc_topic_type", "disc_topic_num_contribs")
    assert records(m.aux("DiscussionTopics"), *columns) == [
        (1, "Ann", "student", "Discussion", 2),
        (2, None, None, "Announcement", None),
    ]
    assert records(m.aux("DiscussionTopics"), F.length("disc_topic_title").alias("n")) == [(300,), (4,)]
    by_entry = ("disc_id", "disc_author_id", "disc_author_role", "disc_course_name")
    assert records(m.aux("DiscussionMessages"), *by_entry) == [(1, 12, "TeacherEnrollment", "Song"), (2, None, None, None)]
    fixed = mart(spark, key_fix=True, **tables).aux("DiscussionMessages")
    assert records(fixed, *by_entry) == [(1, 11, "TeacherEnrollment", "Song"), (2, None, None, None)]


def test_modules_and_wikis(spark):
    m = mart(
        spark,
        module_dim=[{"id": 1, "course_id": 5, "name": "M", "workflow_state": "active"}, {"id": 2, "workflow_state": "deleted"}],
        module_fact=[{"module_id": 1, "wiki_id": 3, "enrollment_term_id": 4}],
        enrollment_term_dim=[{"id": 4, "name": "A term with a very long name"}],
        wiki_dim=[{"id": 3, "title": "W", "parent_type": "Course and more"}],
        wiki_fact=[{"wiki_id": 3, "enrollment_term_id": 4}, {"wiki_id": 9}],
        wiki_page_dim=[{"id": 1, "title": "P", "workflow_state": "active"}, {"id": 2, "workflow_state": "deleted"}],
        wiki_page_fact=[{"wiki_page_id": 1, "view_count": 2}, {"wiki_page_id": 2}, {"wiki_page_id": 3}],
        module_item_dim=[
            {"id": 1, "module_id": 1, "workflow_state": "active"}, {"id": 2, "module_id": 8, "workflow_state": "active"},
        ],
        module_progression_completion_requirement_dim=[
            {"id": 1, "module_item_id": 1, "requirement_type": "a"}, {"id": 2, "module_item_id": 1, "requirement_type": "b"},
        ],
        module_progression_dim=[
            {"id": 1, "module_id": 1, "workflow_state": "started"}, {"id": 2, "module_id": 1, "workflow_state": "started"},
            {"id": 3, "module_id": 1, "workflow_state": "locked"},
        ],
        module_progression_fact=[{"module_progression_id": 1}, {"module_progression_id": 1}],
    )
    assert records(m.aux("Modules"), "id", "term_name", "wiki_title") == [(1, "A term with a very long name", "W")]
    assert records(m.aux("Wikis"), "wiki_id", "wiki_title", "wiki_type") == [(3, "W", "Course and more"), (9, None, None)]
    assert records(m.aux("WikiPages"), "wiki_page_id", "wiki_page_title", "view_count") == [(1, "P", 2)]
    items = records(m.aux("ModuleItems"), "id", "requirement_type", "num_started", "num_completed")
    assert items == [(1, "a", 3, None), (1, "b", 3, None), (2, None, None, None)]


def test_requirements(spark):
    m = mart(spark, **ENROLLED)
    flags = list(REQUIREMENTS)
    assert records(m.aux("RequirementsFill"), "course_id", *flags) == [
        (i, *[0] * 23) for i in (100, 101, 102, 103)
    ]
    # The catalog id is unknown for all courses, so none of them can be a near-duplicate of another.
    assert m.aux("RequirementsFillUniq").count() == 4
    lists = spark.createDataFrame([("THINK, WAY-ER,Writing 1",), (None,)], "gers string")
    marked = [r.asDict() for r in lists.select("gers", *requirement_flags("gers")).collect()]
    assert {f for f in flags if marked[0][f]} == {"THINK", "WAY_ER"}
    assert {f for f in flags if marked[1][f]} == set()


def test_a_table_of_your_own_in_sql(spark):
    sql_table(
        "Openings",
        "course_id bigint, account_name varchar(3)",
        "SELECT d.id AS course_id, a.account_name FROM {course_dim} d JOIN {Accounts} a ON d.account_id = a.account_id",
    )
    try:
        found = records(mart(spark, **ENROLLED).aux("Openings"), "course_id", "account_name")
        assert found == [(i, "Music") for i in (100, 101, 102, 103, 105)]
    finally:
        del TABLES["Openings"]
