"""The auxiliary tables, each against the join-by-join SQL that defines it."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession

from coursemart.plans import TABLES
from coursemart.plans.requirements import REQUIREMENTS
from verification.registry import check, first_row
from verification.views import mart


def _people(role: str, name: str, active: bool) -> str:
    return f"""
        SELECT DISTINCT e.user_id, u.name AS {name}
          FROM enrollment_dim e JOIN role_dim r ON e.role_id = r.id LEFT JOIN user_dim u ON e.user_id = u.id
         WHERE lower(r.name) = lower('{role}') {"AND e.workflow_state = 'active'" if active else ""}"""


_FLAGS = ", ".join(
    f"CASE WHEN list_contains(string_split(lower(replace(ger_fulfillment, ' ', '')), ','), lower('{tag}')) "
    f"THEN 1 ELSE 0 END AS {flag}"
    for flag, tag in REQUIREMENTS.items()
)

_TOPIC_BASE = """
    SELECT t.id AS topic_id, t.title, t.type, t.posted_at, t.course_id, c.name AS course_name, c.code AS course_code,
           c.start_at AS course_start, c.enrollment_term_id, c.account_id
      FROM discussion_topic_dim t LEFT JOIN course_dim c ON t.course_id = c.id
     WHERE t.workflow_state = 'active'"""

# Each step is one table (or a stage of one), as SQL over the raw views and the steps before it.
STEPS = {
    "Accounts": "SELECT id AS account_id, name AS account_name FROM account_dim",
    "Terms": "SELECT DISTINCT id AS term_id, name AS term_name, date_start AS start_date FROM enrollment_term_dim",
    "AllUsers": f"""
        SELECT CAST(row_number() OVER (ORDER BY e.id) AS BIGINT) AS seq_num, e.user_id, u.name, e.type,
               CASE e.type WHEN 'TeacherEnrollment' THEN 'instructor' WHEN 'StudentEnrollment' THEN 'student'
                           WHEN 'TaEnrollment' THEN 'TA' WHEN 'DesignerEnrollment' THEN 'designer'
                           WHEN 'ObserverEnrollment' THEN 'observer' END AS role,
               e.workflow_state
          FROM enrollment_dim e LEFT JOIN {first_row("user_dim", "id", "name")} u ON e.user_id = u.id""",
    "Students": _people("StudentEnrollment", "student_name", True),
    "Instructors": _people("TeacherEnrollment", "instructor_name", False),
    "TeachingAssistants": _people("TAEnrollment", "ta_name", True),
    "Graders": _people("Grader", "grader_name", True),
    "courses_base": """
        SELECT a.id AS account_id, c.id AS course_id, c.enrollment_term_id, c.name AS course_name, c.code,
               c.workflow_state
          FROM account_dim a JOIN course_dim c ON a.id = c.account_id
         WHERE c.workflow_state IN ('claimed', 'available')""",
    "term_names": """
        SELECT d.id, d.name, d.date_end, t.term_name FROM enrollment_term_dim d JOIN Terms t ON d.id = t.term_id
         WHERE t.term_name NOT IN ('Default Term')""",
    "enrollment_counts": """
        SELECT b.course_id, count(b.course_id) AS enrollment
          FROM courses_base b LEFT JOIN enrollment_dim e ON b.course_id = e.course_id GROUP BY b.course_id""",
    "Courses": f"""
        SELECT b.account_id, b.course_id, b.enrollment_term_id, q.term_name, a.name AS account_name, b.course_name,
               CAST(NULL AS INTEGER) AS stanford_course_id, b.code, q.date_end, q.name AS quarter_name_canvas,
               CAST(NULL AS VARCHAR) AS quarter_name_peoplesoft, CAST(NULL AS VARCHAR) AS acad_year,
               CAST(NULL AS VARCHAR) AS course_code, CAST(NULL AS VARCHAR) AS subject,
               CAST(NULL AS INTEGER) AS units_max, CAST(NULL AS VARCHAR) AS ger_fulfillment,
               CAST(NULL AS VARCHAR) AS acad_group, CAST(NULL AS VARCHAR) AS department,
               CAST(NULL AS VARCHAR) AS acad_career, CAST(NULL AS VARCHAR) AS instructors,
               CAST(n.enrollment AS BIGINT) AS enrollment, b.workflow_state
          FROM courses_base b
          LEFT JOIN {first_row("term_names", "id", "name, date_end, term_name")} q ON b.enrollment_term_id = q.id
          LEFT JOIN {first_row("account_dim", "id", "name")} a ON b.account_id = a.id
          LEFT JOIN enrollment_counts n ON b.course_id = n.course_id""",
    "CourseInstructor": f"""
        SELECT e.user_id, c.id AS course_id, c.enrollment_term_id, i.instructor_name, n.name AS course_name,
               t.name AS enrollment_term_name
          FROM course_dim c JOIN enrollment_dim e ON c.id = e.course_id
          LEFT JOIN Instructors i ON e.user_id = i.user_id
          LEFT JOIN {first_row("course_dim", "id", "name")} n ON c.id = n.id
          LEFT JOIN {first_row("enrollment_term_dim", "id", "name")} t ON c.enrollment_term_id = t.id
         WHERE c.workflow_state = 'available' AND e.workflow_state = 'active'
           AND c.enrollment_term_id NOT IN (19953, 20002) AND e.type = 'TeacherEnrollment'""",
    "CourseInstructorTeams": """
        SELECT course_id, enrollment_term_id,
               string_agg(DISTINCT instructor_name, ', ' ORDER BY instructor_name) AS instructor_team
          FROM CourseInstructor GROUP BY course_id, enrollment_term_id""",
    "CourseEnrollment": f"""
        SELECT c.id AS course_id, c.account_id, e.id AS enrollmentid, c.enrollment_term_id, i.enrollment_term_name,
               c.name AS course_name, c.code AS course_code, e.course_section_id, c.start_at,
               e.type AS enrollment_type, e.user_id, t.instructor_team
          FROM course_dim c JOIN enrollment_dim e ON c.id = e.course_id
          LEFT JOIN {first_row("CourseInstructor", "course_id, enrollment_term_id", "enrollment_term_name")} i
            ON c.id = i.course_id AND c.enrollment_term_id = i.enrollment_term_id
          LEFT JOIN CourseInstructorTeams t
            ON c.id = t.course_id AND c.enrollment_term_id = t.enrollment_term_id
         WHERE c.workflow_state = 'available' AND e.workflow_state = 'active'
           AND c.enrollment_term_id NOT IN (19953, 20002)""",
    "QuizDimFact": """
        SELECT d.id, d.quiz_type, d.name, d.due_at, d.assignment_id, f.points_possible, f.time_limit,
               f.allowed_attempts, f.course_id
          FROM quiz_dim d LEFT JOIN quiz_fact f ON d.id = f.quiz_id WHERE d.workflow_state = 'published'""",
    "published_assignments": f"""
        SELECT a.course_id, a.id AS assignment_id, a.assignment_group_id, a.title AS assignment_name,
               a.submission_types, a.points_possible, a.grading_type, q.due_at, q.id AS quiz_id, q.quiz_type,
               q.name AS quiz_name, q.assignment_id AS quiz_assignment_id, q.time_limit AS quiz_time_limit,
               q.allowed_attempts AS quiz_allowed_attempts, g.name AS group_assignment_name
          FROM assignment_dim a
          JOIN assignment_group_dim g ON a.assignment_group_id = g.id AND a.course_id = g.course_id
          LEFT JOIN {first_row("QuizDimFact", "course_id", "id")} q ON a.course_id = q.course_id
         WHERE a.workflow_state = 'published'""",
    "assignments_and_quizzes": """
        SELECT * FROM published_assignments
        UNION ALL
        SELECT q.course_id, NULL, NULL, NULL, NULL, q.points_possible, NULL, q.due_at, q.id, q.quiz_type, q.name, NULL,
               q.time_limit, q.allowed_attempts, NULL
          FROM QuizDimFact q LEFT JOIN published_assignments p ON q.course_id = p.course_id
         WHERE p.quiz_id IS NULL""",
    "wiki_titles": first_row("wiki_dim", "id", "title").strip("()"),
    "topic_base": _TOPIC_BASE,
    "topic_counts": """
        SELECT e.topic_id, count(*) AS num_entries
          FROM topic_base b LEFT JOIN discussion_entry_fact e ON b.topic_id = e.topic_id GROUP BY e.topic_id""",
    "course_terms": f"SELECT course_id, term_name FROM {first_row('Courses', 'course_id', 'term_name')} AS x",
    "course_names": f"SELECT course_id, course_name FROM {first_row('Courses', 'course_id', 'course_name')} AS x",
    "first_terms": f"SELECT term_id, term_name FROM {first_row('Terms', 'term_id', 'term_name')} AS x",
    "Modules": """
        SELECT d.id, d.course_id, c.course_name, d.name AS module_name, f.account_id, f.enrollment_term_id,
               t.term_name AS term_name, f.wiki_id, w.title AS wiki_title
          FROM module_dim d LEFT JOIN module_fact f ON d.id = f.module_id
          LEFT JOIN course_names c ON d.course_id = c.course_id
          LEFT JOIN wiki_titles w ON f.wiki_id = w.id
          LEFT JOIN first_terms t ON f.enrollment_term_id = t.term_id
         WHERE d.workflow_state = 'active'""",
    "started_counts": """
        SELECT d.module_id, count(*) AS n FROM module_progression_dim d
          LEFT JOIN module_progression_fact f ON d.id = f.module_progression_id
         WHERE d.workflow_state = 'started' GROUP BY d.module_id""",
    "completed_counts": """
        SELECT d.module_id, count(*) AS n FROM module_progression_dim d
          LEFT JOIN module_progression_fact f ON d.id = f.module_progression_id
         WHERE d.workflow_state = 'completed' GROUP BY d.module_id""",
    "ModuleItems": """
        SELECT i.id, i.title, i.course_id, i.module_id, i.content_type, r.requirement_type, r.completion_status,
               CAST(s.n AS BIGINT) AS num_started, CAST(c.n AS BIGINT) AS num_completed
          FROM module_item_dim i
          LEFT JOIN module_progression_completion_requirement_dim r ON i.id = r.module_item_id
          LEFT JOIN started_counts s ON i.module_id = s.module_id
          LEFT JOIN completed_counts c ON i.module_id = c.module_id
         WHERE i.workflow_state = 'active'""",
    "Wikis": """
        SELECT f.wiki_id, f.account_id, f.parent_course_id AS course_id, c.course_name, f.enrollment_term_id,
               t.term_name AS term_name, d.title AS wiki_title, d.parent_type AS wiki_type
          FROM wiki_fact f LEFT JOIN wiki_dim d ON f.wiki_id = d.id
          LEFT JOIN course_names c ON f.parent_course_id = c.course_id
          LEFT JOIN first_terms t ON f.enrollment_term_id = t.term_id""",
    "WikiPages": """
        SELECT f.wiki_page_id, f.wiki_id, f.parent_course_id AS course_id, c.course_name, d.title AS wiki_page_title,
               f.view_count, d.editing_roles
          FROM wiki_page_fact f JOIN wiki_page_dim d ON f.wiki_page_id = d.id
          LEFT JOIN course_names c ON f.parent_course_id = c.course_id
         WHERE d.workflow_state = 'active'""",
    "StudentUnits": """
        SELECT a.account_id, a.account_name, c.enrollment_term_id, c.quarter_name_canvas, c.quarter_name_peoplesoft,
               CAST(NULL AS TIMESTAMP) AS term_start, c.course_id, c.course_name, c.instructors, c.units_max,
               c.enrollment
          FROM Accounts a LEFT JOIN Courses c ON a.account_id = c.account_id""",
    "RequirementsFill": f"""
        SELECT course_name, course_id, stanford_course_id, quarter_name_canvas, {_FLAGS} FROM Courses""",
    "RequirementsFillUniq": """
        SELECT t1.* FROM RequirementsFill t1 LEFT JOIN RequirementsFill t2
            ON t1.stanford_course_id = t2.stanford_course_id AND t1.quarter_name_canvas = t2.quarter_name_canvas
           AND t1.course_id > t2.course_id
         WHERE t2.stanford_course_id IS NULL""",
}


def _submissions(title_key: str) -> str:
    return f"""
        SELECT f.account_id, f.course_id, c.name AS course_name, t.term_name, d.id AS submission_id, d.assignment_id,
               a.title AS assignment_name, a.description AS assignment_description, d.quiz_submission_id, d.grader_id,
               d.user_id, f.enrollment_term_id, f.assignment_group_id, d.published_grade AS grade_letter,
               f.published_score AS grade_numeric, p.points_possible, d.submitted_at, d.graded_at, d.grade_state,
               d.excused, s.student_name
          FROM submission_dim d
          JOIN submission_fact f ON f.submission_id = d.id AND f.assignment_id = d.assignment_id
          LEFT JOIN {first_row("course_dim", "enrollment_term_id, id", "name")} c
            ON f.enrollment_term_id = c.enrollment_term_id AND f.course_id = c.id
          LEFT JOIN {first_row("assignment_fact", "assignment_id, course_id", "points_possible")} p
            ON d.assignment_id = p.assignment_id AND f.course_id = p.course_id
          LEFT JOIN first_terms t ON f.enrollment_term_id = t.term_id
          LEFT JOIN {first_row("assignment_dim", title_key, "id")} a ON d.assignment_id = a.{title_key}
          LEFT JOIN {first_row("Students", "user_id", "student_name")} s ON d.user_id = s.user_id
         WHERE f.enrollment_term_id NOT IN (19953, 20002)"""


def _assignments(weight_key: str) -> str:
    return f"""
        SELECT c.account_id, x.course_id, c.name AS course_name, t.term_name, x.assignment_id, x.assignment_group_id,
               x.assignment_name, x.submission_types, x.points_possible, x.grading_type, x.due_at, x.quiz_id,
               x.quiz_type, x.quiz_name, x.quiz_assignment_id, x.quiz_time_limit, x.quiz_allowed_attempts,
               x.group_assignment_name, w.group_weight AS group_assignment_weight, s.current_score, s.final_score
          FROM assignments_and_quizzes x
          LEFT JOIN {first_row("(SELECT * FROM course_dim WHERE workflow_state = 'available')", "id", "name, account_id")} c
            ON x.course_id = c.id
          LEFT JOIN {first_row("assignment_group_score_fact", "assignment_group_id, course_id", "score_id")} s
            ON x.assignment_group_id = s.assignment_group_id AND x.course_id = s.course_id
          LEFT JOIN {first_row("assignment_group_fact", "assignment_group_id", "group_weight")} w
            ON x.{weight_key} = w.assignment_group_id
          LEFT JOIN course_terms t ON x.course_id = t.course_id
         WHERE NOT EXISTS (SELECT 1 FROM course_dim bad
                            WHERE bad.id = x.course_id AND bad.workflow_state <> 'available')"""


def _messages(author_key: str) -> str:
    return f"""
        SELECT b.title AS disc_title, e.user_id AS disc_author_id, r.type AS disc_author_role,
               b.posted_at AS disc_posted_at, b.course_id AS disc_course_id, b.course_name AS disc_course_name,
               b.course_code AS disc_course_code, b.course_start AS disc_course_start_date, b.topic_id AS disc_id,
               b.type AS disc_type
          FROM topic_base b
          LEFT JOIN {first_row("discussion_entry_fact", author_key, "discussion_entry_id, user_id")} e
            ON b.topic_id = e.{author_key}
          LEFT JOIN {first_row("enrollment_dim", "user_id", "id, type")} r ON e.user_id = r.user_id"""


_TOPICS = f"""
    SELECT b.topic_id AS disc_topic_id, f.user_id AS disc_topic_author_id, u.name AS disc_topic_author_name,
           u.role AS disc_topic_author_role, b.title AS disc_topic_title,
           b.enrollment_term_id AS course_enrollment_term_id, b.account_id AS course_account_id,
           f.message_length AS disc_topic_msg_length, b.posted_at AS disc_topic_posted_at, b.course_id, b.course_name,
           b.course_code, c.course_code AS catnbr, b.course_start AS disc_topic_course_start_date,
           coalesce(b.type, 'Discussion') AS disc_topic_type, 
           CAST(n.num_entries AS BIGINT) AS disc_topic_num_contribs
      FROM topic_base b
      LEFT JOIN {first_row("discussion_topic_fact", "discussion_topic_id", "user_id, message_length")} f
        ON b.topic_id = f.discussion_topic_id
      LEFT JOIN {first_row("AllUsers", "user_id", "seq_num")} u ON f.user_id = u.user_id
      LEFT JOIN {first_row("Courses", "course_id", "course_code")} c ON b.course_id = c.course_id
      LEFT JOIN topic_counts n ON b.topic_id = n.topic_id"""

# Query key, table, SQL (default: the step of that name).
_TABLE_CHECKS = [
    ("tbl_accounts", "Accounts", None),
    ("tbl_terms", "Terms", None),
    ("tbl_all_users", "AllUsers", None),
    ("tbl_students", "Students", None),
    ("tbl_instructors", "Instructors", None),
    ("tbl_teaching_assistants", "TeachingAssistants", None),
    ("tbl_graders", "Graders", None),
    ("tbl_courses", "Courses", None),
    ("tbl_course_instructor", "CourseInstructor", None),
    ("tbl_course_instructor_teams", "CourseInstructorTeams", None),
    ("tbl_course_enrollment", "CourseEnrollment", None),
    ("tbl_assignment_submissions", "AssignmentSubmissions", _submissions("assignment_group_id")),
    ("tbl_course_assignments", "CourseAssignments", _assignments("assignment_id")),
    ("tbl_quiz_dim_fact", "QuizDimFact", None),
    ("tbl_discussion_messages", "DiscussionMessages", _messages("discussion_entry_id")),
    ("tbl_discussion_topics", "DiscussionTopics", _TOPICS),
    ("tbl_modules", "Modules", None),
    ("tbl_module_items", "ModuleItems", None),
    ("tbl_wikis", "Wikis", None),
    ("tbl_wiki_pages", "WikiPages", None),
    ("tbl_student_units", "StudentUnits", None),
    ("tbl_requirements_fill", "RequirementsFill", None),
    ("tbl_requirements_fill_uniq", "RequirementsFillUniq", None),
]


def _aux(spark: SparkSession, sf_dir: str, table: str, **settings) -> DataFrame:
    return mart(spark, sf_dir, **settings).aux(table)


for _key, _table, _sql in _TABLE_CHECKS:
    assert _table in TABLES
    check(_key, _sql or f"SELECT * FROM {_table}", STEPS)(partial(_aux, table=_table))

# The same tables with the lookups that compare ids of different kinds put right.
check("tbl_assignment_submissions_key_fix", _submissions("id"), STEPS)(
    partial(_aux, table="AssignmentSubmissions", key_fix=True)
)
check("tbl_course_assignments_key_fix", _assignments("assignment_group_id"), STEPS)(
    partial(_aux, table="CourseAssignments", key_fix=True)
)
check("tbl_discussion_messages_key_fix", _messages("topic_id"), STEPS)(
    partial(_aux, table="DiscussionMessages", key_fix=True)
)
