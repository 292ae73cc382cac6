"""Rules for tertiary-student records in weekly batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from riskloom.functions.expr import col, number
from riskloom.operators.scenarios import Scenario
from riskloom.operators.trajectory import Period
from riskloom.plans.rules import (
    BINARY,
    CODE,
    CONTINUOUS,
    COUNT,
    FILL_RULES,
    Check,
    Treatment,
    RuleSet,
)

# Column names, groups and kinds.
TARGET = "Target"
CLASSES = ("Dropout", "Enrolled", "Graduate")
TARGET_LABELS = {
    "0": "Dropout",
    "1": "Enrolled",
    "2": "Graduate",
    "Dropout": "Dropout",
    "Enrolled": "Enrolled",
    "Graduate": "Graduate",
}
TARGET_ORDINAL = {"Dropout": 0, "Enrolled": 1, "Graduate": 2}

SEMESTER_PARTS = ("credited", "enrolled", "evaluations", "approved", "grade", "without evaluations")


def semester_columns(semester: str) -> list[str]:
    return [f"Curricular units {semester} sem ({part})" for part in SEMESTER_PARTS]


SEM1 = semester_columns("1st")
SEM2 = semester_columns("2nd")

GROUPS = {
    "Outcome": [TARGET],
    "Demographics": [
        "Age at enrollment",
        "Gender",
        "Marital status",
        "Nacionality",
        "International",
        "Educational special needs",
        "Displaced",
    ],
    "Family background": [
        "Mother's qualification",
        "Father's qualification",
        "Mother's occupation",
        "Father's occupation",
    ],
    "Financial / administrative": ["Debtor", "Tuition fees up to date", "Scholarship holder"],
    "Admissions & pathway": [
        "Admission grade",
        "Previous qualification (grade)",
        "Application mode",
        "Application order",
        "Previous qualification",
        "Course",
        "Daytime/evening attendance",
    ],
    "Academic signals (Sem 1)": SEM1,
    "Academic signals (Sem 2)": SEM2,
    "Macro context": ["Unemployment rate", "Inflation rate", "GDP"],
}

CODES = frozenset(
    [
        "Course",
        "Application mode",
        "Previous qualification",
        "Application order",
        "Marital status",
        "Nacionality",
        *GROUPS["Family background"],
        "Daytime/evening attendance",
    ]
)
FLAGS = frozenset(
    [
        "Gender",
        "International",
        "Educational special needs",
        "Displaced",
        *GROUPS["Financial / administrative"],
    ]
)
GRADES = frozenset(c for c in SEM1 + SEM2 if c.endswith("(grade)"))
MEASURES = frozenset(
    ["Age at enrollment", "Admission grade", "Previous qualification (grade)", *GRADES, *GROUPS["Macro context"]]
)
COUNTS = frozenset(SEM1 + SEM2) - GRADES

KINDS = {
    **dict.fromkeys(FLAGS, BINARY),
    **dict.fromkeys(CODES, CODE),
    **dict.fromkeys(MEASURES, CONTINUOUS),
    **dict.fromkeys(COUNTS, COUNT),
}

# Rule buckets in their order of precedence, outlier treatments and their wording.
BUCKETS = (
    ("critical_academic", frozenset(SEM1 + SEM2)),
    ("finance", frozenset(GROUPS["Financial / administrative"])),
    ("parent", frozenset(GROUPS["Family background"])),
    ("demographic", frozenset(GROUPS["Demographics"])),
    ("coded_categorical", CODES),
    ("macro", frozenset(GROUPS["Macro context"])),
)

MACRO_NOISE = Treatment("winsorize", "Macroeconomic extremes are external noise")
OUTLIER_POLICIES = {
    "Age at enrollment": Treatment(
        "flag_only", "High age represents non-traditional students (Risk Signal)"
    ),
    "Previous qualification (grade)": Treatment(
        "flag_only", "Low prior grades indicate preparedness gaps (Risk Signal)"
    ),
    "Admission grade": Treatment(
        "flag_only", "Extremes in admission grades serve as stratification signals"
    ),
    "GDP": MACRO_NOISE,
    "Inflation rate": MACRO_NOISE,
    "Unemployment rate": MACRO_NOISE,
}

# Code lists.
EDUCATION = {
    1: "Secondary Education", 2: "Bachelor's Degree", 3: "Degree", 4: "Master's",
    5: "Doctorate", 6: "Freq. Higher Ed", 9: "12th Year (Incomplete)",
    10: "11th Year (Incomplete)", 11: "7th Year (Old)", 12: "Other (11th Year)",
    14: "10th Year", 18: "General Commerce", 19: "Basic Ed 3rd Cycle",
    22: "Tech-Professional", 26: "7th Year", 27: "2nd Cycle Gen High School",
    29: "9th Year (Incomplete)", 30: "8th Year", 34: "Unknown", 35: "Illiterate",
    36: "Can Read/No Schooling", 37: "Basic Ed 1st Cycle", 38: "Basic Ed 2nd Cycle",
    39: "Tech Specialization", 40: "Degree (1st Cycle)", 41: "Specialized Higher Studies",
    42: "Prof. Higher Tech", 43: "Master (2nd Cycle)", 44: "Doctorate (3rd cycle)",
}
OCCUPATION = {
    0: "Student", 1: "Directors/Execs", 2: "Scientists/Intellectuals",
    3: "Intermediate Techs", 4: "Admin Staff", 5: "Service/Security/Sales",
    6: "Agri/Fishery Workers", 7: "Industry/Construction", 8: "Machine Operators",
    9: "Unskilled Workers", 10: "Armed Forces", 90: "Other Situation", 99: "Blank",
    122: "Health Professionals", 123: "Teachers", 125: "ICT Specialists",
    131: "Science/Eng Techs", 132: "Health Techs", 134: "Legal/Social/Cultural Techs",
    141: "Office/Secretaries", 143: "Data/Finance Operators", 144: "Other Admin Support",
    151: "Personal Service", 152: "Sellers", 153: "Personal Care",
    171: "Skilled Construction", 173: "Precision/Arts Workers", 175: "Food/Wood/Clothing",
    191: "Cleaning Workers", 192: "Unskilled Agri", 193: "Unskilled Industry", 194: "Meal Prep Assistants",
}
YES_NO = {1: "Yes", 0: "No"}
LABELS = {
    "Marital status": {
        1: "Single", 2: "Married", 3: "Widower", 4: "Divorced", 5: "Facto Union", 6: "Legally Separated",
    },
    "Application mode": {
        1: "1st Phase (General)", 2: "Ord. 612/93", 5: "1st Phase (Azores)", 7: "Holders Other Higher",
        10: "Ord. 854-B/99", 15: "International Student", 16: "1st Phase (Madeira)", 17: "2nd Phase (General)",
        18: "3rd Phase (General)", 26: "Ord. 533-A/99 (Diff Plan)", 27: "Ord. 533-A/99 (Other Inst)",
        39: "Over 23 Years Old", 42: "Transfer", 43: "Change of Course", 44: "Tech Diploma",
        51: "Change Inst/Course", 53: "Short Cycle Diploma", 57: "Change Inst/Course (Intl)",
    },
    "Course": {
        33: "Biofuel Production", 171: "Animation/Multimedia", 8014: "Social Service (Eve)", 9003: "Agronomy",
        9070: "Comm. Design", 9085: "Vet Nursing", 9119: "Informatics Eng.", 9130: "Equinculture",
        9147: "Management", 9238: "Social Service", 9254: "Tourism", 9500: "Nursing",
        9556: "Oral Hygiene", 9670: "Ad/Marketing Mgmt", 9773: "Journalism", 9853: "Basic Ed",
        9991: "Management (Eve)",
    },
    "Daytime/evening attendance": {1: "Daytime", 0: "Evening"},
    "Previous qualification": EDUCATION,
    "Nacionality": {
        1: "Portuguese", 2: "German", 6: "Spanish", 11: "Italian", 13: "Dutch", 14: "English",
        17: "Lithuanian", 21: "Angolan", 22: "Cape Verdean", 24: "Guinean", 25: "Mozambican",
        26: "Santomean", 32: "Turkish", 41: "Brazilian", 62: "Romanian", 100: "Moldova",
        101: "Mexican", 103: "Ukrainian", 105: "Russian", 108: "Cuban", 109: "Colombian",
    },
    "Mother's qualification": EDUCATION,
    "Father's qualification": EDUCATION,
    "Mother's occupation": OCCUPATION,
    "Father's occupation": OCCUPATION,
    "Displaced": YES_NO,
    "Educational special needs": YES_NO,
    "Debtor": YES_NO,
    "Tuition fees up to date": YES_NO,
    "Gender": {1: "Male", 0: "Female"},
    "Scholarship holder": YES_NO,
    "International": YES_NO,
}
COURSE_NAMES = {
    33: "Biofuel Production Technologies", 171: "Animation and Multimedia Design",
    8014: "Social Service (evening)", 9003: "Agronomy", 9070: "Communication Design",
    9085: "Veterinary Nursing", 9119: "Informatics Engineering", 9130: "Equinculture",
    9147: "Management", 9238: "Social Service", 9254: "Tourism", 9500: "Nursing",
    9556: "Oral Hygiene", 9670: "Advertising and Marketing Management",
    9773: "Journalism and Communication", 9853: "Basic Education", 9991: "Management (evening)",
}

# Column lists of the reports.
SLICE_COLUMNS = (
    "Gender",
    "Scholarship holder",
    "Tuition fees up to date",
    "Debtor",
    "International",
    "Age at enrollment",
    "Admission grade",
    "Curricular units 1st sem (approved)",
    "Curricular units 1st sem (grade)",
)
SENSITIVE_COLUMNS = (
    "Gender",
    "Scholarship holder",
    "Displaced",
    "International",
    "Nacionality",
    "Debtor",
    "Educational special needs",
)
STATIC_CORRELATION = (
    "Age at enrollment",
    "Admission grade",
    "Previous qualification (grade)",
    "Gender",
    "International",
    "Scholarship holder",
    "Debtor",
    "Tuition fees up to date",
    "Curricular units 1st sem (grade)",
    "Curricular units 2nd sem (grade)",
    "Unemployment rate",
    "Inflation rate",
    "GDP",
)
TRAJECTORY_CORRELATION = (
    "Curricular units 1st sem (grade)",
    "Curricular units 2nd sem (grade)",
    "Curricular units 1st sem (approved)",
    "Curricular units 2nd sem (approved)",
    "Age at enrollment",
    "Admission grade",
    "Delta_Grade",
    "Grade_Improvement",
    "CR_Sem1",
    "CR_Sem2",
    "Delta_CR",
    "Completion_Collapse",
    "Fail_Crossing",
    "EvalPressure_Sem2",
    "Delta_EvalPressure",
    "GhostRate_Sem2",
    "Delta_GhostRate",
)
SIGNAL_CORRELATION = (
    "Delta_Grade",
    "Delta_CR",
    "Completion_Collapse",
    "Fail_Crossing",
    "Delta_EvalPressure",
    "Delta_GhostRate",
    "Ghost_Worsening",
    "Academic_Stress",
    "Home_Support_Risk",
    "Subject_Difficulty_Score",
)
RADAR_DIMENSIONS = {
    "Academic Prep": ("Admission grade", "Previous qualification (grade)"),
    "Current Success": ("Curricular units 2nd sem (approved)", "Curricular units 2nd sem (grade)"),
    "Engagement": ("Curricular units 2nd sem (evaluations)", "Curricular units 2nd sem (enrolled)"),
    "Financial Stress": ("Debtor", "Tuition fees up to date"),
    "Stability": ("Age at enrollment", "Displaced"),
}
RADAR_INVERTED = ("Debtor", "Displaced")
RADAR_GROUPS = ("Scholarship holder", "Gender", "International")

MIN_AGE, MAX_AGE = 16, 80

RULES = RuleSet(
    target=TARGET,
    groups=GROUPS,
    kinds=KINDS,
    buckets=BUCKETS,
    fill_rules=FILL_RULES,
    outlier_policies=OUTLIER_POLICIES,
    labels=LABELS,
)


def semester(name: str) -> Period:
    """Names of one semester's measures."""

    def part(x: str) -> str:
        return f"Curricular units {name} sem ({x})"

    return Period(part("grade"), part("approved"), part("enrolled"), part("evaluations"), part("without evaluations"))


FIRST, SECOND = semester("1st"), semester("2nd")


def checks(min_age: int = MIN_AGE, max_age: int = MAX_AGE) -> Sequence[Check]:
    """Integrity checks, in report order."""

    def num(name: str) -> Column:
        return number(col(name))

    def over_enrolled(name: str, p: Period, which: int) -> Check:
        return Check(
            name,
            "FAIL",
            (p.approved, p.enrolled),
            num(p.approved) > num(p.enrolled),
            f"Approved units must not exceed enrolled units in Semester {which}",
        )

    age, tuition, grant = "Age at enrollment", "Tuition fees up to date", "Scholarship holder"
    jobless, prices, output = GROUPS["Macro context"]
    return (
        Check("age_too_low", "WARN", (age,), num(age) < min_age, f"Age < {min_age}"),
        Check("age_too_high", "WARN", (age,), num(age) > max_age, f"Age > {max_age}"),
        over_enrolled("approved_le_enrolled_sem1", FIRST, 1),
        over_enrolled("approved_le_enrolled_sem2", SECOND, 2),
        Check(
            "tuition_vs_scholarship_review",
            "INFO",
            (tuition, grant),
            (num(tuition) == 0) & (num(grant) == 1),
            "Scholarship=1 but tuition=0. Review: partial scholarship or payment timing?",
        ),
        Check("gdp_negative", "WARN", (output,), num(output) < 0, "GDP < 0 (data quality issue)"),
        Check(
            "inflation_negative", "WARN", (prices,), num(prices) < 0, "Inflation rate < 0 (deflation or data issue)"
        ),
        Check(
            "unemployment_negative", "WARN", (jobless,), num(jobless) < 0, "Unemployment rate < 0 (data quality issue)"
        ),
        Check("unemployment_extreme", "WARN", (jobless,), num(jobless) > 50, "Unemployment rate > 50% (check data)"),
    )


SUPPORT_WORDS = ("stress", "support", "sentiment")


def what_if_scenarios(features: Sequence[str], support_factor: float = 1.2) -> tuple[Scenario, ...]:
    """Academic, financial and socio-emotional help, each for a single row."""
    support = [f for f in features if any(w in f.lower() for w in SUPPORT_WORDS)]
    return (
        Scenario(
            "Academic Support",
            {SECOND.grade: col(SECOND.grade) + 10, SECOND.evaluations: col(SECOND.evaluations) + 5},
            "Increase 2nd semester grade by +10 and evaluations by +5",
        ),
        Scenario(
            "Financial Support",
            {"Tuition fees up to date": F.lit(1), "Debtor": F.lit(0)},
            "Set tuition fees up to date and clear debtor status",
        ),
        Scenario(
            "Socio-emotional Support",
            {f: col(f) * support_factor for f in support},
            f"Scale stress and support features by {support_factor}",
        ),
    )


def policies(high_risk: Column) -> tuple[Scenario, ...]:
    """Financial aid for indebted high-risk rows, and an engagement nudge for all high-risk rows."""
    best_grade = 20.0
    grade = col(SECOND.grade).cast("double") + 5
    return (
        Scenario(
            "Financial Aid Program",
            {"Debtor": F.lit(0), "Tuition fees up to date": F.lit(1)},
            "Clear debt of high-risk debtors",
            high_risk & (col("Debtor") == 1),
            unit_cost=2000,
        ),
        Scenario(
            "Engagement Nudge System",
            {
                SECOND.evaluations: F.bround(col(SECOND.evaluations).cast("double") + 6, 0),
                SECOND.approved: F.bround(col(SECOND.approved).cast("double") + 4, 0),
                SECOND.grade: F.bround(F.when(grade > best_grade, best_grade).otherwise(grade), 0),
            },
            "Raise engagement and achievement of all high-risk rows",
            high_risk,
            flat_cost=500,
        ),
    )
