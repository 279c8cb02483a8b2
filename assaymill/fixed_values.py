"""They decide results, so they are stated here plainly and in one place.

Nothing in this module is derived; change a value only to change what the engine computes.
"""

# --- fixed values: texts a CSV scan reads as null -------------------------------------------
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# --- fixed values: allowed values and key columns -------------------------------------------
DETECTED_VALUES = ("Yes", "No")
STATUS_VALUES = ("Running", "Finished", "Failed", "InProgress", "Completed", "Error")
FINISHED_WORDS = ("finished", "completed")
PROJECT_KEYS = ("project_code", "study_code", "study_cohort_code")
SUBJECT_KEYS = PROJECT_KEYS + ("subject_id", "sample_id")
RESULT_KEYS = ("sample_id",)
JOIN_KEYS = SUBJECT_KEYS

# --- fixed values: output columns of the merged table, in order ------------------------------
MERGED_COLUMNS = (
    "project_code", "study_code", "study_cohort_code",
    "project_name", "study_name", "study_cohort_name",
    "project_manager_name", "disease_name",
    "subject_id", "sample_id", "sample_type", "type",
    "detection_value", "cancer_detected", "sample_status",
    "sample_quality", "sample_quality_threshold", "fail_reason", "date_of_run",
)

# --- fixed values: default cleaning configuration ---------------------------------------------
COLUMN_MAPPINGS = {
    "projects": {},
    "subjects": {"type": "sample_type"},
    "results": {
        " detection_value ": "detection_value",
        "cancer_detected_(yes_no)": "cancer_detected",
        "sample_status(running/finished/failed)": "sample_status",
        "fail_reason(technical/quality)": "fail_reason",
        "sample_quality_minimum_threshold": "sample_quality_threshold",
        "date of run": "date_of_run",
    },
}
VALUE_MAPPINGS = {
    "results": {
        "sample_status": {
            "finished": "Finished", "running": "Running", "failed": "Failed",
            "completed": "Completed", "error": "Error", "inprogress": "InProgress",
        },
        "detection_value": {
            "  ": None, " ": None, "": None, "N/A": None, "NA": None, "nan": None, "null": None,
        },
        "cancer_detected": {
            "Yes": "Yes", "No": "No", "Y": "Yes", "N": "No", "True": "Yes", "False": "No",
            "1": "Yes", "0": "No", "NA": None, "nan": None, "N/A": None,
        },
    },
}
CONSTRAINTS = {
    "results": {
        "detection_value": {"min_value": 0.0, "max_value": 1.0},
        "sample_quality": {"min_value": 0.0, "max_value": 1.0},
        "sample_quality_threshold": {"min_value": 0.0, "max_value": 1.0},
        "cancer_detected": {"allowed_values": list(DETECTED_VALUES)},
        "sample_status": {"allowed_values": list(STATUS_VALUES)},
    },
}

# --- fixed values: quality gate ----------------------------------------------------------------
MAX_NULL_RATIO = 0.2

# --- fixed values: texts of reports where an event says nothing ------------------------------------
NO_MESSAGE_PROVIDED = "No message provided"
NO_MESSAGE = "No message"
NO_DESCRIPTION = "No description provided"
NO_VALUE = "Not specified"
DEFAULT_FIX = "Manual review required"
ISSUE_SEVERITY = "Medium"

# --- fixed values: report vocabulary -------------------------------------------------------------
# (substring of the error type, severity), first match wins; anything else is LOW
SEVERITIES = (
    ("MissingColumn", "CRITICAL"), ("SchemaError", "CRITICAL"),
    ("TypeMismatch", "HIGH"), ("ValueError", "HIGH"),
    ("FormatError", "MEDIUM"), ("ConstraintError", "MEDIUM"),
)
SEVERITY_PRIORITY = {"CRITICAL": 5, "HIGH": 4, "MEDIUM": 3, "LOW": 2}
ERROR_ACTIONS = (
    ("MissingColumn", "Add missing column to data source or update schema"),
    ("TypeMismatch", "Convert data type or clean invalid values"),
    ("ValueError", "Clean or replace invalid values"),
    ("ConstraintError", "Fix constraint violations in data"),
)
DEFAULT_ACTION = "Review and fix data quality issues"
TYPE_PRIORITIES = (("MissingColumn", 5), ("TypeMismatch", 4), ("ValueError", 3))
DEFAULT_TYPE_PRIORITY = 2
TYPE_FIXES = (
    ("MissingColumn", "Add missing columns to data source"),
    ("TypeMismatch", "Implement data type conversion and cleaning"),
    ("ValueError", "Clean invalid values and implement validation"),
)
DEFAULT_TYPE_FIX = "Review data quality and implement appropriate fixes"
# %d is the number of errors of the type
TYPE_EFFORTS = (
    ("MissingColumn", "High - requires schema changes"),
    ("TypeMismatch", "Medium - %d type conversions needed"),
    ("ValueError", "Medium - %d values to clean"),
)
DEFAULT_TYPE_EFFORT = "Low to Medium - depends on specific issues"
# (lowest success rate, band), first match wins; anything below is CRITICAL
OVERVIEW_BANDS = ((95, "EXCELLENT"), (80, "GOOD"), (50, "POOR"))
EXECUTIVE_BANDS = ((95, "EXCELLENT"), (90, "GOOD"), (80, "FAIR"), (70, "POOR"))
LOWEST_BAND = "CRITICAL"
PASS_RATE, FAIL_RATE = 90, 70
HIGHLIGHT_SCORE = 95
DATA_QUALITY_TYPES = ("DataQualityError", "ValidationError")
# (all of these substrings in the message, title), first match wins
ISSUE_TITLES = (
    (("detection_value",), "DETECTION_VALUE TYPE COERCION FAILURE"),
    (("float64", "object"), "DETECTION_VALUE DATA TYPE MISMATCH"),
    ((">=", "str"), "DETECTION_VALUE RANGE VALIDATION FAILURE"),
    (("<=", "str"), "DETECTION_VALUE UPPER BOUND VALIDATION FAILURE"),
)
REPORTS_KEPT_PER_TYPE = 3
# (error type that triggers it, priority, category, recommendation, impact)
COARSE_RECOMMENDATIONS = (
    ("SchemaViolation", "HIGH", "Schema Compliance",
     "Review and update data to match schema requirements", "Critical for data quality"),
    ("DataQualityError", "MEDIUM", "Data Quality",
     "Implement data cleaning processes", "Improve overall data quality"),
)
STEPS_AFTER_ERRORS = (
    "Review technical report for detailed error analysis",
    "Implement data cleaning processes for identified issues",
    "Re-run validation after data cleaning",
)
STEPS_AFTER_SUCCESSES = (
    "Monitor data quality metrics for successful tables",
    "Implement automated validation checks",
)
