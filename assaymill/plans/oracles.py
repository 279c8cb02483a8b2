"""The registered queries once more, as SQL written independently of the operators.

Only the raw shapes are shared with the Spark side, so that both start from the same rows.
"""

from __future__ import annotations

from .. import fixed_values as fixed
from . import shapes

ORACLES: dict[str, str] = {}

_STD = r"lower(trim(regexp_replace({0}, '\s+', ' ', 'g')))"
_TIDY = r"trim(regexp_replace({0}, '\s+', ' ', 'g'))"
_NUM = (r"CASE WHEN regexp_full_match({0}, '\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*') "
        r"THEN try_cast(trim({0}) AS double) END")


def std(x: str) -> str:
    return _STD.format(x)


def tidy(x: str) -> str:
    return _TIDY.format(x)


def num(x: str) -> str:
    return _NUM.format(x)


def _shape(shape: dict[str, str], names: dict[str, str] | None = None) -> str:
    return ", ".join(f"{e} AS {(names or {}).get(c, c)}" for c, e in shape.items())


# --- common table expressions ---------------------------------------------------------------------------

_RESULT_NAMES = dict(zip(shapes.RESULTS, (
    "sample_id", "detection_value", "cancer_detected", "sample_status", "fail_reason",
    "sample_quality", "sample_quality_threshold", "date_of_run")))
RAW_RESULTS = f"""raw_results AS (
  SELECT {_shape(shapes.RESULTS, _RESULT_NAMES)}, {', '.join(shapes.RESULT_ORDER)},
         {shapes.RESULT_ROW} AS row_name
  FROM lineitem)"""
_ORDERS = "orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"
RAW_SUBJECTS = f"""raw_subjects AS (
  SELECT {_shape(shapes.SUBJECTS, {'type': 'sample_type'})}, o_orderkey FROM {_ORDERS})"""
RAW_PROJECTS = f"""raw_projects AS (
  SELECT {_shape(shapes.PROJECTS)}, o_orderkey
  FROM {_ORDERS} JOIN region ON n_regionkey = r_regionkey)"""

_MAPPED_STATUS = """CASE lower(sample_status) WHEN 'finished' THEN 'Finished'
  WHEN 'running' THEN 'Running' WHEN 'failed' THEN 'Failed' WHEN 'completed' THEN 'Completed'
  WHEN 'error' THEN 'Error' WHEN 'inprogress' THEN 'InProgress' ELSE sample_status END"""
_MAPPED_CANCER = """CASE WHEN lower(cancer_detected) IN ('yes', 'y', 'true', '1') THEN 'Yes'
  WHEN lower(cancer_detected) IN ('no', 'n', 'false', '0') THEN 'No'
  WHEN lower(cancer_detected) IN ('na', 'nan', 'n/a') THEN NULL ELSE cancer_detected END"""
_MAPPED_VALUE = """CASE WHEN lower(detection_value) IN ('  ', ' ', '', 'n/a', 'na', 'nan', 'null')
  THEN NULL ELSE detection_value END"""
_STATUSES = "('Running', 'Finished', 'Failed', 'InProgress', 'Completed', 'Error')"
TYPED_RESULTS = f"""mapped_results AS (
  SELECT sample_id, {_MAPPED_VALUE} AS detection_value, {_MAPPED_CANCER} AS cancer_detected,
    {_MAPPED_STATUS} AS sample_status, fail_reason, sample_quality, sample_quality_threshold,
    date_of_run, {', '.join(shapes.RESULT_ORDER)}
  FROM raw_results),
standard_results AS (
  SELECT {std('sample_id')} AS sample_id, detection_value,
    {tidy('cancer_detected')} AS cancer_detected, {tidy('sample_status')} AS sample_status,
    {std('fail_reason')} AS fail_reason, sample_quality, sample_quality_threshold, date_of_run,
    {', '.join(shapes.RESULT_ORDER)}
  FROM mapped_results),
typed_results AS (
  SELECT sample_id, {num('detection_value')} AS detection_value,
    cancer_detected, sample_status, fail_reason, {num('sample_quality')} AS sample_quality,
    {num('sample_quality_threshold')} AS sample_quality_threshold,
    cast(cast(try_strptime(date_of_run, '%d/%m/%Y') AS date) AS varchar) AS date_of_run,
    {', '.join(shapes.RESULT_ORDER)}
  FROM standard_results)"""


def _kept(null_rows: str) -> str:
    unit = " AND ".join(
        f"({c} BETWEEN 0 AND 1 OR {c} IS NULL)"
        for c in ("detection_value", "sample_quality", "sample_quality_threshold"))
    return (f"{unit} AND (cancer_detected IN ('Yes', 'No'){null_rows.format('cancer_detected')}) "
            f"AND (sample_status IN {_STATUSES}{null_rows.format('sample_status')})")


_RESULT_COLUMNS = ("sample_id, detection_value, cancer_detected, sample_status, fail_reason, "
                   "sample_quality, sample_quality_threshold, date_of_run")


def _deduplicated(source: str, where: str, columns: str, keys: str, order: str) -> str:
    return (f"SELECT {columns} FROM (SELECT *, row_number() OVER (PARTITION BY {keys} "
            f"ORDER BY {order}) AS rn FROM {source} WHERE {where}) WHERE rn = 1")


def _cleaned(source: str, where: str, columns: str, keys: str, order: str) -> str:
    """Of rows with a whole key the first; rows that miss a part of it all stay."""
    missing = " OR ".join(f"{k} IS NULL" for k in keys.split(", "))
    return _deduplicated(source, where, columns, keys, order) + f" OR {missing}"


def _clean_results(null_rows: str = "") -> str:
    return _cleaned("typed_results", _kept(null_rows), _RESULT_COLUMNS, "sample_id",
                         ", ".join(shapes.RESULT_ORDER))


CLEAN_RESULTS = f"{RAW_RESULTS}, {TYPED_RESULTS}, clean_results AS ({_clean_results()})"
_SUBJECT_COLUMNS = ("project_code", "study_code", "study_cohort_code", "subject_id", "sample_id",
                    "sample_type")
CLEAN_SUBJECTS = f"""{RAW_SUBJECTS}, standard_subjects AS (
  SELECT {', '.join(f"{std(c)} AS {c}" for c in _SUBJECT_COLUMNS[:5])},
    coalesce({std('sample_type')}, '') AS sample_type, o_orderkey
  FROM raw_subjects),
clean_subjects AS ({_cleaned('standard_subjects', 'true', ', '.join(_SUBJECT_COLUMNS),
                                  ', '.join(_SUBJECT_COLUMNS[:5]), 'o_orderkey')})"""
_PROJECT_KEYS = ("project_code", "study_code", "study_cohort_code")
CLEAN_PROJECTS = f"""{RAW_PROJECTS}, standard_projects AS (
  SELECT {', '.join(f"{std(c)} AS {c}" for c in _PROJECT_KEYS)},
    {', '.join(f"coalesce({std(c)}, '') AS {c}" for c in shapes.PROJECTS if c not in _PROJECT_KEYS)}, o_orderkey
  FROM raw_projects),
clean_projects AS ({_cleaned('standard_projects', 'true', ', '.join(shapes.PROJECTS),
                                  'project_code, study_code, study_cohort_code', 'o_orderkey')})"""
MERGED = f"""{CLEAN_RESULTS}, {CLEAN_SUBJECTS}, {CLEAN_PROJECTS}, merged AS (
  SELECT project_code, study_code, study_cohort_code, project_name, study_name, study_cohort_name,
    project_manager_name, disease_name, subject_id, sample_id, sample_type, detection_value,
    cancer_detected, sample_status, sample_quality, sample_quality_threshold, fail_reason,
    date_of_run
  FROM clean_subjects JOIN clean_results USING (sample_id)
  JOIN clean_projects USING (project_code, study_code, study_cohort_code))"""
_CODE = "project_code || '-' || study_code || '-' || study_cohort_code"
SUMMARY = f"""{MERGED}, summary AS (
  SELECT project_code, study_code, study_cohort_code, {_CODE} AS Code,
    count(*) AS Total_Samples,
    round_even(count(*) FILTER (WHERE regexp_matches(sample_status, '(?i)Finished|Completed'))
      / count(*) * 100, 2) AS Finished_Percentage,
    min(detection_value) AS Lowest_Detection
  FROM merged GROUP BY project_code, study_code, study_cohort_code)"""

ORACLES["clean_results"] = f"WITH {CLEAN_RESULTS} SELECT * FROM clean_results"
ORACLES["clean_results_null_kept"] = (
    f"WITH {RAW_RESULTS}, {TYPED_RESULTS} {_clean_results(' OR {0} IS NULL')}")
ORACLES["clean_subjects"] = f"WITH {CLEAN_SUBJECTS} SELECT * FROM clean_subjects"
ORACLES["clean_projects"] = f"WITH {CLEAN_PROJECTS} SELECT * FROM clean_projects"
ORACLES["merge_full"] = f"WITH {MERGED} SELECT * FROM merged"
ORACLES["cohort_summary"] = f"WITH {SUMMARY} SELECT * FROM summary"

# --- column functions -----------------------------------------------------------------------------------

ORACLES["column_mapping"] = (
    "SELECT s_suppkey, s_name AS supplier_name, s_nationkey, s_acctbal AS balance FROM supplier")
ORACLES["value_mapping"] = """SELECT CASE l_returnflag WHEN 'R' THEN 'Yes' WHEN 'A' THEN 'No'
  WHEN 'N' THEN NULL ELSE l_returnflag END AS mapped, count(*) AS row_count
  FROM lineitem GROUP BY 1"""
ORACLES["value_mapping_chain"] = """SELECT o_orderstatus, CASE o_orderstatus WHEN 'F' THEN 'Closed'
  WHEN 'O' THEN 'Open' WHEN 'P' THEN 'f' ELSE o_orderstatus END AS mapped, count(*) AS row_count
  FROM orders GROUP BY 1, 2"""
_WIDE_SPACE = (r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}"
               r"\x{202F}\x{205F}\x{3000}]+")
ORACLES["string_standardize"] = f"""SELECT doc_id, md5(t) AS text_md5, length(t) AS text_length
  FROM (SELECT doc_id, lower(trim(regexp_replace(text, '{_WIDE_SPACE}', ' ', 'g'))) AS t
        FROM documents)"""
ORACLES["missing_fill"] = """SELECT CASE WHEN o_orderpriority = '5-LOW' THEN ''
  ELSE lower(o_orderpriority) END AS priority, count(*) AS row_count FROM orders GROUP BY 1"""
ORACLES["type_convert"] = f"""SELECT t AS source_text, {num('t')} AS as_double,
    CASE WHEN {num('t')} = floor({num('t')}) THEN cast({num('t')} AS bigint) END AS as_long,
    count(*) AS row_count
  FROM (SELECT CASE l_linenumber
      WHEN 1 THEN cast(cast(l_quantity AS bigint) AS varchar) || '.0' WHEN 2 THEN '1,000'
      WHEN 3 THEN '0.5d' WHEN 4 THEN ' 12 ' WHEN 5 THEN '1e3' WHEN 6 THEN 'abc'
      ELSE cast(l_partkey AS varchar) || '.5' END AS t FROM lineitem) GROUP BY 1, 2, 3"""
ORACLES["date_parse"] = """SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 3 THEN NULL
  ELSE cast(cast(o_orderdate AS date) AS varchar) END AS parsed FROM orders"""
ORACLES["date_shapes"] = """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') ||
  CASE WHEN o_orderkey % 5 = 4 THEN ' 13:05:00' ELSE ' 00:00:00' END AS parsed FROM orders"""
ORACLES["composite_keys"] = f"""WITH {RAW_PROJECTS}
  SELECT concat_ws('-', project_code, study_code, study_cohort_code) AS code, count(*) AS row_count
  FROM raw_projects GROUP BY 1"""
ORACLES["finished_flag"] = """SELECT status,
    coalesce(regexp_matches(status, '(?i)Finished|Completed'), false) AS finished,
    count(*) AS row_count
  FROM (SELECT CASE o_orderstatus WHEN 'F' THEN 'UnFINISHED' WHEN 'O' THEN 'completed early'
      ELSE CASE WHEN o_orderkey % 2 = 0 THEN 'Failed' END END AS status FROM orders)
  GROUP BY 1, 2"""

# --- constraints ------------------------------------------------------------------------------------------

_LINES = """(SELECT l_orderkey, l_linenumber, l_partkey,
  CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE l_quantity END AS l_quantity,
  CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE l_returnflag END AS l_returnflag FROM lineitem)"""
ORACLES["constraint_allowed"] = (
    f"SELECT * FROM {_LINES} WHERE l_returnflag IN ('A', 'R') OR l_returnflag IS NULL")
ORACLES["constraint_range"] = (
    f"SELECT * FROM {_LINES} WHERE l_quantity BETWEEN 10 AND 40 OR l_quantity IS NULL")
ORACLES["constraint_open"] = (
    f"SELECT * FROM {_LINES} WHERE l_quantity > 10 AND l_quantity < 40 OR l_quantity IS NULL")
ORACLES["constraint_drop_counts"] = f"""WITH b AS (SELECT CASE
    WHEN l_returnflag IS NULL OR l_returnflag NOT IN ('A', 'R') THEN 1
    WHEN l_quantity < 10 THEN 2 WHEN l_quantity > 40 THEN 3 WHEN l_partkey <= 100 THEN 4 END AS n
  FROM {_LINES})
  SELECT r.rule_number, r.column_name, r.rule, (SELECT count(*) FROM b) AS rows_in,
    (SELECT count(*) FROM b WHERE b.n = r.rule_number) AS rows_removed
  FROM (VALUES (1, 'l_returnflag', 'allowed_values'), (2, 'l_quantity', 'min_value'),
    (3, 'l_quantity', 'max_value'), (4, 'l_partkey', 'greater_than'))
    AS r(rule_number, column_name, rule)"""

# --- duplicates ---------------------------------------------------------------------------------------------

_LINE_COLUMNS = ("l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, "
                 "l_discount, l_tax, l_returnflag, l_linestatus")
_ASC = ", ".join(c for c in shapes.RESULT_ORDER if c != "l_orderkey")
ORACLES["dedup_keep_first"] = _deduplicated("lineitem", "true", _LINE_COLUMNS, "l_orderkey", _ASC)
ORACLES["dedup_keep_last"] = _deduplicated(
    "lineitem", "true", _LINE_COLUMNS, "l_orderkey",
    ", ".join(f"{c} DESC" for c in _ASC.split(", ")))
ORACLES["dedup_keep_none"] = f"""SELECT {_LINE_COLUMNS} FROM (SELECT *, count(*) OVER (
  PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem) WHERE n = 1"""
ORACLES["duplicate_keys"] = """SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem
  GROUP BY 1, 2 HAVING count(*) > 1"""
ORACLES["duplicate_count"] = """SELECT cast(sum(n) AS bigint) AS rows_in, count(*) AS distinct_keys,
  cast(sum(n - 1) AS bigint) AS duplicate_rows
  FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)"""

# --- joins --------------------------------------------------------------------------------------------------

ORACLES["merge_inner"] = """SELECT l_orderkey AS sample_id, l_linenumber AS line,
  l_extendedprice AS price, o_totalprice AS price_results, o_orderstatus AS status
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
ORACLES["merge_null_safe"] = """WITH o AS (
  SELECT nullif(o_orderpriority, '5-LOW') AS priority, o_orderkey, o_orderstatus FROM orders)
  SELECT o.priority, o_orderkey, o_orderstatus, row_count FROM o JOIN
  (SELECT priority, count(*) AS row_count FROM o GROUP BY 1) t
  ON o.priority IS NOT DISTINCT FROM t.priority"""
ORACLES["failure_cases_unique"] = """SELECT cast(l_linenumber AS varchar) AS row_id, NULL AS column_name,
    'unique([''l_orderkey''])' AS check_name, 'ValidationError' AS error_type,
    cast(l_orderkey AS varchar) AS failure_case
  FROM (SELECT *, rank() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS n FROM lineitem)
  WHERE n > 1"""
ORACLES["merge_skewed"] = """WITH o AS (
  SELECT CASE WHEN o_orderkey % 8 = 0 THEN 'hot' ELSE 'k' || o_custkey END AS k, o_orderkey FROM orders)
  SELECT k, o_orderkey, count(*) OVER (PARTITION BY k) AS row_count FROM o"""
ORACLES["csv_mixed_encodings"] = "SELECT c_custkey, c_name || ' ' || chr(233) || chr(252) AS c_name FROM customer"
ORACLES["na_tokens"] = f"""SELECT o_orderkey, CASE WHEN o_orderkey % {len([t for t in fixed.NA_TOKENS if t]) + 1}
  = {len([t for t in fixed.NA_TOKENS if t])} THEN 'kept' END AS token FROM orders"""
ORACLES["merge_key_intersection"] = f"""WITH {CLEAN_SUBJECTS}
  SELECT s.*, n_name AS project_name, r_name AS disease_name FROM clean_subjects s
  JOIN nation ON project_code = lower(n_name) JOIN region ON n_regionkey = r_regionkey"""
ORACLES["merge_dedup_right"] = f"""WITH {RAW_SUBJECTS}, {RAW_PROJECTS}, u AS ({_deduplicated(
    'raw_projects', 'true', '*', 'project_code, study_code, study_cohort_code', 'o_orderkey')})
  SELECT u.project_code, u.study_code, u.study_cohort_code, subject_id, sample_id,
    sample_type AS type, project_name, study_name, study_cohort_name, project_manager_name,
    disease_name
  FROM raw_subjects s JOIN u ON trim(s.project_code) = u.project_code
    AND s.study_code = u.study_code AND s.study_cohort_code = u.study_cohort_code"""
ORACLES["merge_union_fallback"] = """SELECT s_suppkey AS sample_id, s_name FROM supplier
  UNION ALL BY NAME SELECT c_name AS project_code, c_mktsegment AS study_code FROM customer"""
ORACLES["merge_orphans"] = f"""WITH {CLEAN_RESULTS}, {CLEAN_SUBJECTS}
  SELECT 'subjects_without_results' AS relation, count(*) AS lost_rows FROM clean_subjects s
  WHERE NOT EXISTS (SELECT 1 FROM clean_results r WHERE r.sample_id = s.sample_id)
  UNION ALL SELECT 'results_without_subjects', count(*) FROM clean_results r
  WHERE NOT EXISTS (SELECT 1 FROM clean_subjects s WHERE r.sample_id = s.sample_id)
  UNION ALL SELECT 'subjects_without_project', count(*) FROM clean_subjects
  WHERE project_code NOT IN (SELECT lower(n_name) FROM nation WHERE n_regionkey <> 0)"""
ORACLES["merge_orphan_rows"] = """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
  o_orderpriority FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)"""
ORACLES["summary_by_project"] = """SELECT priority, priority AS Code,
    round_even(count(*) FILTER (WHERE o_orderstatus = 'F') / count(*) * 100, 2)
      AS Finished_Percentage,
    min(CASE WHEN o_orderkey % 3 <> 0 THEN cast(o_custkey AS double) END) AS Lowest_Detection
  FROM (SELECT *, nullif(o_orderpriority, '5-LOW') AS priority FROM orders)
  WHERE priority IS NOT NULL GROUP BY priority"""

# --- profile and gate -----------------------------------------------------------------------------------------

_LABELLED = "(SELECT d.*, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"
_LABELLED_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars", "quality", "toxic")
ORACLES["null_profile"] = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count, "
    f"(count(*) - count({c})) / count(*) AS null_ratio FROM {_LABELLED}"
    for c in _LABELLED_COLUMNS)
_NULLS = " + ".join(f"(count(*) - count({c}))" for c in _LABELLED_COLUMNS)
ORACLES["null_ratio"] = f"""SELECT count(*) AS row_count, {_NULLS} AS null_cells,
  ({_NULLS}) / (count(*) * {len(_LABELLED_COLUMNS)}) AS null_ratio FROM {_LABELLED}"""
ORACLES["value_census"] = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, cast({c} AS varchar) AS value, count(*) AS row_count "
    f"FROM {_LABELLED} GROUP BY {c}" for c in ("lang", "source", "quality", "toxic"))
ORACLES["sample_values"] = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, rn AS value_rank, v AS value FROM (SELECT {e} AS v, "
    f"row_number() OVER (ORDER BY event_id) AS rn FROM events WHERE {e} IS NOT NULL) WHERE rn <= 3"
    for c, e in (("event_type", "nullif(event_type, 'view')"), ("props", "props"),
                 ("user_id", "CASE WHEN user_id % 2 = 0 THEN cast(user_id AS varchar) END")))
ORACLES["table_row_counts"] = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in (
        "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
        "documents", "pages", "labels", "conversations", "benchmark", "embeddings"))


def _cells(columns: tuple[str, ...]) -> str:
    return (f"({' + '.join(f'(count(*) - count({c}))' for c in columns)}) "
            f"/ (count(*) * {len(columns)})")


_GATE = """SELECT 'projects' AS table_name, '{1}' AS rule, '{0}' AS column_name,
  cast({2} AS double) AS measured, cast(0 AS double) AS threshold, {2} <= 0 AS passed"""
ORACLES["gate_result"] = f"""WITH {RAW_RESULTS}, {RAW_SUBJECTS}, {RAW_PROJECTS}
  {_GATE.format('project_code', 'missing_key_column', 0)}
  UNION ALL {_GATE.format('project_code', 'null_key', 'count(*) - count(project_code)')}
    FROM raw_projects
  UNION ALL {_GATE.format('study_code', 'missing_key_column', 0)}
  UNION ALL {_GATE.format('study_code', 'null_key', "count(*) FILTER (study_code = 'BUILDING' OR study_code IS NULL)")}
    FROM raw_projects
  UNION ALL {_GATE.format('study_cohort_code', 'missing_key_column', 1)}
  UNION ALL SELECT 'subjects', 'null_ratio', NULL, {_cells(_SUBJECT_COLUMNS)}, 0.2,
    {_cells(_SUBJECT_COLUMNS)} <= 0.2 FROM raw_subjects
  UNION ALL SELECT 'results', 'null_ratio', NULL, {_cells(tuple(_RESULT_NAMES.values()))}, 0.2,
    {_cells(tuple(_RESULT_NAMES.values()))} <= 0.2 FROM raw_results"""

# --- validation -------------------------------------------------------------------------------------------------

_GE0, _LE1 = "greater_than_or_equal_to(0.0)", "less_than_or_equal_to(1.0)"
_FLOAT, _DATE = "coerce_dtype('float64')", "coerce_dtype('datetime64[ns]')"
_T, _V = "TypeMismatch", "ValidationError"


def _number_rules(column: str, raw: bool) -> list[tuple[str, str, str, str]]:
    value = f"({num(column)})" if raw else column
    rules = [(column, _FLOAT, _T, f"{column} IS NOT NULL AND {value} IS NULL")] if raw else []
    return rules + [(column, _GE0, _V, f"{value} < 0"), (column, _LE1, _V, f"{value} > 1")]


def _result_rules(raw: bool) -> list[tuple[str, str, str, str]]:
    parsed = "try_strptime(date_of_run, '%d/%m/%Y')"
    return [
        ("sample_id", "not_nullable", _V, "sample_id IS NULL"),
        *_number_rules("detection_value", raw),
        ("cancer_detected", "isin(['Yes', 'No'])", _V, "cancer_detected NOT IN ('Yes', 'No')"),
        ("sample_status",
         "isin(['Running', 'Finished', 'Failed', 'InProgress', 'Completed', 'Error'])", _V,
         f"sample_status NOT IN {_STATUSES}"),
        *_number_rules("sample_quality", raw),
        *_number_rules("sample_quality_threshold", raw),
        *([("date_of_run", _DATE, _T, f"date_of_run IS NOT NULL AND {parsed} IS NULL")]
          if raw else []),
    ]


def _not_null_rules(columns) -> list[tuple[str, str, str, str]]:
    return [(c, "not_nullable", _V, f"{c} IS NULL") for c in columns]


def quoted(text: str | None) -> str:
    return "NULL" if text is None else "'" + text.replace("'", "''") + "'"


def _count_rows(table: str, stage: str, source: str, rules) -> str:
    return " UNION ALL ".join(
        f"SELECT {n} AS rule_number, '{table}' AS table_name, '{stage}' AS stage, "
        f"'{c}' AS column_name, {quoted(check)} AS check_name, '{kind}' AS error_type, "
        f"count(*) FILTER (WHERE {failed}) AS failed_cells, "
        f"min(cast({c} AS varchar)) FILTER (WHERE {failed}) AS example FROM {source}"
        for n, (c, check, kind, failed) in enumerate(rules, 1))


_RULES = {
    "projects": ("raw_projects", _not_null_rules(shapes.PROJECTS)),
    "subjects": ("raw_subjects", _not_null_rules(_SUBJECT_COLUMNS)),
    "results": ("raw_results", _result_rules(True)),
}
_KEY_CHECK = "unique(['project_code', 'study_code', 'study_cohort_code'])"
RULE_COUNTS = f"""{CLEAN_RESULTS}, {RAW_SUBJECTS}, {RAW_PROJECTS}, before_counts AS (
  {' UNION ALL '.join(_count_rows(t, 'before_cleaning', s, r) for t, (s, r) in _RULES.items())}
  UNION ALL SELECT {len(shapes.PROJECTS) + 1}, 'projects', 'before_cleaning', NULL,
    {quoted(_KEY_CHECK)}, '{_V}',
    count(*) - count(DISTINCT (project_code, study_code, study_cohort_code)), NULL
  FROM raw_projects),
after_counts AS ({_count_rows('results', 'after_cleaning', 'clean_results', _result_rules(False))}),
counts AS (SELECT * FROM before_counts UNION ALL SELECT * FROM after_counts)"""
ORACLES["rule_counts"] = f"WITH {RULE_COUNTS} SELECT * FROM before_counts"

_FAILURES = " UNION ALL ".join(
    f"SELECT 'results' AS table_name, 'before_cleaning' AS stage, row_name AS row_id, "
    f"'{c}' AS column_name, {quoted(check)} AS check_name, '{kind}' AS error_type, "
    f"cast({c} AS varchar) AS failure_case FROM raw_results WHERE {failed}"
    for c, check, kind, failed in _result_rules(True))
_MESSAGE = "'Column ''' || {0} || ''' failed check ''' || check_name || ''': ' || {1}"
ORACLES["failure_cases"] = f"""WITH {RAW_RESULTS}, f AS ({_FAILURES})
  SELECT *, {_MESSAGE.format('column_name', "coalesce(failure_case, 'null')")} AS error_message
  FROM f"""
ORACLES["first_n_errors"] = f"""WITH {RAW_RESULTS}, f AS ({_FAILURES})
  SELECT table_name, stage, row_number() OVER (PARTITION BY table_name, stage
    ORDER BY row_id, column_name, check_name) AS error_rank, row_id, column_name, check_name,
    failure_case
  FROM f QUALIFY error_rank <= 10"""
ORACLES["first_errors_per_rule"] = f"""WITH {RAW_RESULTS}, f AS ({_FAILURES})
  SELECT column_name, check_name, row_number() OVER (PARTITION BY column_name, check_name
    ORDER BY row_id) AS error_rank, row_id, failure_case FROM f QUALIFY error_rank <= 5"""
_STATUS = """SELECT c.table_name, c.column_name, n IS NULL AS is_valid,
    coalesce(n, 0) AS error_count, f.error_type,
    'Column ''' || c.column_name || ''' failed check ''' || f.check_name || ''': '
      || coalesce(f.example, 'null') AS error_message,
    f.check_name, CASE WHEN n IS NULL THEN 'SUCCESS' ELSE 'VALIDATION_FAILED' END AS error_code
  FROM (SELECT DISTINCT table_name, column_name FROM {0} WHERE column_name IS NOT NULL) c
  LEFT JOIN (SELECT column_name, cast(sum(failed_cells) AS bigint) AS n,
      min(rule_number) AS first_rule
    FROM {0} WHERE failed_cells > 0 GROUP BY 1) b ON b.column_name = c.column_name
  LEFT JOIN {0} f ON f.column_name = c.column_name AND f.rule_number = b.first_rule"""
_FAIL_REASON = """UNION ALL SELECT 0, 'results', 'before_cleaning', 'fail_reason', '', '', 0, NULL"""
ORACLES["column_status"] = f"""WITH {RULE_COUNTS}, r AS (
  SELECT * FROM before_counts WHERE table_name = 'results' {_FAIL_REASON})
  {_STATUS.format('r')}"""
ORACLES["column_status_strict"] = f"""WITH {RAW_PROJECTS}, n AS (
  SELECT count(*) AS n FROM raw_projects WHERE project_code = 'NATION_3')
  SELECT 'projects' AS table_name, v.* FROM (VALUES
    ('project_code', true, 0, NULL, NULL, NULL, 'SUCCESS'),
    ('study_cohort_code', true, 0, NULL, NULL, NULL, 'SUCCESS'),
    ('study_name', false, 1, 'TypeMismatch',
      'Column ''study_name'' failed check ''dtype(''str'')'': int', 'dtype(''str'')',
      'VALIDATION_FAILED'),
    ('study_cohort_name', true, 0, NULL, NULL, NULL, 'SUCCESS'),
    ('project_manager_name', true, 0, NULL, NULL, NULL, 'SUCCESS'),
    ('disease_name', false, 1, 'MissingColumn',
      'Column ''disease_name'' not found in dataframe', 'ColumnExists', 'COLUMN_MISSING'),
    ('budget', false, 1, 'ExtraColumn',
      'Unexpected column ''budget'' found in dataframe', 'ColumnExists', 'EXTRA_COLUMN'))
    AS v(column_name, is_valid, error_count, error_type, error_message, check_name, error_code)
  UNION ALL SELECT 'projects', 'project_name', n = 0, n,
    CASE WHEN n > 0 THEN 'ValidationError' END,
    CASE WHEN n > 0 THEN 'Column ''project_name'' failed check ''not_nullable'': null' END,
    CASE WHEN n > 0 THEN 'not_nullable' END,
    CASE WHEN n > 0 THEN 'VALIDATION_FAILED' ELSE 'SUCCESS' END FROM n
  UNION ALL SELECT 'projects', 'study_code', n = 0, n,
    CASE WHEN n > 0 THEN 'ValidationError' END,
    CASE WHEN n > 0 THEN 'Column ''study_code'' failed check ''not_nullable'': null' END,
    CASE WHEN n > 0 THEN 'not_nullable' END,
    CASE WHEN n > 0 THEN 'VALIDATION_FAILED' ELSE 'SUCCESS' END
    FROM (SELECT count(*) AS n FROM raw_projects WHERE study_code IS NULL)"""


def _score(table: str, stage: str, source: str, rules) -> str:
    bad = " OR ".join(f"coalesce({failed}, false)" for *_, failed in rules)
    return (f"SELECT '{table}' AS table_name, '{stage}' AS stage, count(*) AS total_rows, "
            f"count(*) - count(*) FILTER (WHERE {bad}) AS valid_rows, "
            f"count(*) FILTER (WHERE {bad}) AS invalid_rows, "
            f"(count(*) - count(*) FILTER (WHERE {bad})) / count(*) * 100 AS data_quality_score "
            f"FROM {source}")


SCORES = " UNION ALL ".join(
    [_score(t, "before_cleaning", s, r) for t, (s, r) in _RULES.items()]
    + [_score("results", "after_cleaning", "clean_results", _result_rules(False))])
ORACLES["table_score"] = f"WITH {CLEAN_RESULTS}, {RAW_SUBJECTS}, {RAW_PROJECTS} {SCORES}"
ORACLES["table_checks"] = f"""SELECT n AS rule_number, 'lines' AS table_name, 'check' AS stage,
    c AS column_name, k AS check_name, '{_V}' AS error_type, f AS failed_cells,
    cast(NULL AS varchar) AS example
  FROM (
    SELECT 1 AS n, 'l_orderkey' AS c, 'not_nullable' AS k,
      count(*) FILTER (WHERE l_orderkey IS NULL) AS f FROM lineitem
    UNION ALL SELECT 2, 'l_quantity', 'not_nullable',
      count(*) FILTER (WHERE l_quantity IS NULL) FROM lineitem
    UNION ALL SELECT 3, NULL, 'enough rows', cast(NOT count(*) > 10 AS bigint) FROM lineitem
    UNION ALL SELECT 4, NULL, 'small total', cast(NOT sum(l_linenumber) < 10 AS bigint)
      FROM lineitem
    UNION ALL SELECT 5, NULL, 'unique([''l_orderkey'', ''l_linenumber''])',
      count(*) - count(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem
    UNION ALL SELECT 6, NULL, 'no big orders', count(*) FROM (
      SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) > 6))"""
ORACLES["merged_validation"] = f"WITH {MERGED} " + _count_rows(
    "merged", "after_cleaning", "merged",
    [*_not_null_rules(_SUBJECT_COLUMNS[:5]), *_number_rules("detection_value", False)])
ORACLES["summary_validation"] = f"WITH {SUMMARY} " + _count_rows("summary", "validation", "summary", [
    ("Code", "not_nullable", _V, "Code IS NULL"),
    ("Total_Samples", "not_nullable", _V, "Total_Samples IS NULL"),
    ("Total_Samples", "greater_than_or_equal_to(0)", _V, "Total_Samples < 0"),
    ("Finished_Percentage", "not_nullable", _V, "Finished_Percentage IS NULL"),
    ("Finished_Percentage", _GE0, _V, "Finished_Percentage < 0"),
    ("Finished_Percentage", "less_than_or_equal_to(100.0)", _V, "Finished_Percentage > 100"),
    ("Lowest_Detection", _GE0, _V, "Lowest_Detection < 0"),
    ("Lowest_Detection", _LE1, _V, "Lowest_Detection > 1")])

# --- reports over the validation of the raw tables -----------------------------------------------------------------

_ERROR_MESSAGE = _MESSAGE.format(
    "coalesce(column_name, table_name)",
    "cast(failed_cells AS varchar) || ' cases, e.g. ' || coalesce(example, 'null')")
EVENTS = f"""{RULE_COUNTS}, errors AS (
  SELECT *, {_ERROR_MESSAGE} AS error_message FROM counts WHERE failed_cells > 0),
scores AS ({SCORES}),
results_of AS (SELECT s.*, coalesce(e.n, 0) AS n FROM scores s LEFT JOIN (
  SELECT table_name, stage, count(*) AS n FROM errors GROUP BY 1, 2) e
  USING (table_name, stage))"""
ORACLES["error_by_type"] = (
    f"WITH {EVENTS} SELECT error_type, count(*) AS error_count FROM errors GROUP BY 1")
ORACLES["error_by_table"] = (
    f"WITH {EVENTS} SELECT table_name, count(*) AS error_count FROM errors GROUP BY 1")
ORACLES["top_error_types"] = ORACLES["error_by_type"] + " ORDER BY 2 DESC, 1 LIMIT 5"
ORACLES["top_error_columns"] = f"""WITH {EVENTS} SELECT coalesce(column_name, 'Unknown') AS
  column_name, count(*) AS error_count FROM errors GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5"""
_SEVERITY = """CASE WHEN {0} LIKE '%MissingColumn%' OR {0} LIKE '%SchemaError%' THEN 'CRITICAL'
  WHEN {0} LIKE '%TypeMismatch%' OR {0} LIKE '%ValueError%' THEN 'HIGH'
  WHEN {0} LIKE '%FormatError%' OR {0} LIKE '%ConstraintError%' THEN 'MEDIUM' ELSE 'LOW' END"""
_PRIORITY = """CASE {0} WHEN 'CRITICAL' THEN 5 WHEN 'HIGH' THEN 4 WHEN 'MEDIUM' THEN 3 ELSE 2 END"""
ORACLES["error_details"] = f"""WITH {EVENTS}, s AS (
    SELECT *, {_SEVERITY.format('error_type')} AS severity FROM errors)
  SELECT table_name, coalesce(column_name, 'Unknown') AS column_name, stage, check_name,
    error_type, error_message, coalesce(example, 'Not specified') AS failed_value, failed_cells,
    severity, {_PRIORITY.format('severity')} AS fix_priority,
    CASE error_type WHEN 'TypeMismatch' THEN 'Convert data type or clean invalid values'
      ELSE 'Review and fix data quality issues' END AS recommended_action
  FROM s"""
_NUMBERED = "printf('{0}_%04d', row_number() OVER (ORDER BY table_name, stage, rule_number))"
_TYPE_OF = """CASE WHEN column_name IS NULL THEN NULL
  WHEN column_name IN ('detection_value', 'sample_quality', 'sample_quality_threshold')
    THEN 'float64' WHEN column_name = 'date_of_run' THEN 'datetime64[ns]' ELSE 'str' END"""
ORACLES["error_ids"] = f"""WITH {EVENTS} SELECT {_NUMBERED.format('ERR')} AS error_id, table_name,
  coalesce(column_name, 'Unknown') AS column_name, error_type, check_name, failed_cells,
  {_TYPE_OF} AS expected_type FROM errors"""
ORACLES["data_quality_issues"] = f"""WITH {EVENTS} SELECT {_NUMBERED.format('DQ')} AS issue_id,
  table_name, coalesce(column_name, 'Unknown') AS column_name, error_type AS issue_type,
  'Medium' AS severity, failed_cells AS affected_rows
  FROM errors WHERE error_type IN ('DataQualityError', 'ValidationError')"""
_RECOMMEND = """SELECT error_type, count(*) AS error_count,
    string_agg(DISTINCT table_name, ',' ORDER BY table_name) AS affected_tables,
    CASE error_type WHEN 'MissingColumn' THEN 5 WHEN 'TypeMismatch' THEN 4 WHEN 'ValueError' THEN 3
      ELSE 2 END AS priority,
    CASE error_type WHEN 'MissingColumn' THEN 'Add missing columns to data source'
      WHEN 'TypeMismatch' THEN 'Implement data type conversion and cleaning'
      WHEN 'ValueError' THEN 'Clean invalid values and implement validation'
      ELSE 'Review data quality and implement appropriate fixes' END AS recommended_fix,
    CASE error_type WHEN 'MissingColumn' THEN 'High - requires schema changes'
      WHEN 'TypeMismatch' THEN 'Medium - ' || count(*) || ' type conversions needed'
      WHEN 'ValueError' THEN 'Medium - ' || count(*) || ' values to clean'
      ELSE 'Low to Medium - depends on specific issues' END AS estimated_effort
  FROM {0} GROUP BY error_type"""
ORACLES["recommendations"] = f"WITH {EVENTS} {_RECOMMEND.format('errors')}"
ORACLES["critical_issues"] = f"""WITH {EVENTS} SELECT table_name, column_name, stage, check_name,
  CASE WHEN error_message LIKE '%detection_value%' THEN 'DETECTION_VALUE TYPE COERCION FAILURE'
    WHEN error_message LIKE '%float64%' AND error_message LIKE '%object%'
      THEN 'DETECTION_VALUE DATA TYPE MISMATCH'
    WHEN error_message LIKE '%>=%' AND error_message LIKE '%str%'
      THEN 'DETECTION_VALUE RANGE VALIDATION FAILURE'
    WHEN error_message LIKE '%<=%' AND error_message LIKE '%str%'
      THEN 'DETECTION_VALUE UPPER BOUND VALIDATION FAILURE'
    ELSE upper(error_type) || ' IN ' || upper(table_name) END AS issue,
  substr(error_message, 1, 100) || CASE WHEN length(error_message) > 100 THEN '...' ELSE '' END
    AS error, error_message,
  'Affects ' || table_name || '.' || coalesce(column_name, 'Unknown') AS impact FROM errors"""
ORACLES["table_analysis"] = f"""WITH {EVENTS} SELECT table_name, stage,
  CASE WHEN n = 0 THEN 'PASSED' ELSE 'FAILED' END AS validation_status, total_rows, valid_rows,
  invalid_rows, data_quality_score FROM results_of"""
_LIST = """coalesce(string_agg(DISTINCT column_name, ',' ORDER BY column_name)
  FILTER (WHERE error_type = '{0}'), '')"""
ORACLES["schema_violations"] = f"""WITH {EVENTS} SELECT table_name, stage,
  count(*) AS violation_count, {_LIST.format('MissingColumn')} AS missing_columns,
  {_LIST.format('ExtraColumn')} AS extra_columns,
  {_LIST.format('TypeMismatch')} AS data_type_violations,
  {_LIST.format('ValidationError')} AS constraint_violations FROM errors GROUP BY 1, 2"""
_STORED_VALID = """stored AS (
  SELECT 'orders' AS table_name, count(*) FILTER (WHERE o_orderkey IS NULL OR o_totalprice IS NULL OR o_totalprice < 0
    OR coalesce(o_orderstatus NOT IN ('F', 'O', 'P'), true)) AS bad FROM orders
  UNION ALL SELECT 'nation', count(*) - count(DISTINCT n_nationkey) + count(*) FILTER (WHERE n_nationkey IS NULL OR n_name IS NULL) FROM nation
  UNION ALL SELECT 'events', count(*) FILTER (WHERE event_id IS NULL OR event_type IS NULL OR value IS NULL OR value < 0) FROM events
  UNION ALL SELECT 'customer', count(*) FILTER (WHERE c_custkey IS NULL OR c_acctbal IS NULL OR c_acctbal < 0) FROM customer)"""
ORACLES["success_summary"] = f"""WITH {EVENTS}, {_STORED_VALID} SELECT table_name, stage, count(*) AS success_count
  FROM results_of WHERE n = 0 GROUP BY 1, 2
  UNION ALL SELECT table_name, 'after_cleaning', 1 FROM stored WHERE bad = 0"""
ORACLES["quality_highlights"] = f"""WITH {EVENTS}, {_STORED_VALID} SELECT table_name, stage,
  'Excellent data quality in ' || table_name || ' table' AS highlight
  FROM results_of WHERE n = 0 AND data_quality_score >= 95
  UNION ALL SELECT table_name, 'after_cleaning', 'Excellent data quality in ' || table_name || ' table' FROM stored WHERE bad = 0"""
_TOTALS = """totals AS (SELECT (SELECT count(*) FROM errors) AS e,
  (SELECT count(*) FROM results_of WHERE n = 0) AS s)"""
ORACLES["quick_overview"] = f"""WITH {EVENTS}, {_TOTALS} SELECT e AS total_errors,
  s AS total_successes, round_even(s / (s + e) * 100, 1) AS success_rate_percentage,
  CASE WHEN e = 0 THEN 'PASSED' ELSE 'FAILED' END AS overall_status,
  CASE WHEN s / (s + e) >= 0.95 THEN 'EXCELLENT' WHEN s / (s + e) >= 0.8 THEN 'GOOD'
    WHEN s / (s + e) >= 0.5 THEN 'POOR' ELSE 'CRITICAL' END AS data_quality_status FROM totals"""
ORACLES["next_steps"] = f"""WITH {EVENTS}, {_TOTALS} SELECT v.i AS step_number, v.t AS next_step
  FROM totals, (VALUES
    (1, 'Review technical report for detailed error analysis', true),
    (2, 'Implement data cleaning processes for identified issues', true),
    (3, 'Re-run validation after data cleaning', true),
    (4, 'Monitor data quality metrics for successful tables', false),
    (5, 'Implement automated validation checks', false)) AS v(i, t, for_errors)
  WHERE CASE WHEN for_errors THEN e > 0 ELSE s > 0 END"""

# --- reports over the event log ----------------------------------------------------------------------------------------

LOG = """log AS (SELECT user_id, ts, event_type = 'purchase' AS ok,
  'table_' || cast(user_id % 3 AS varchar) AS table_name,
  CASE event_type WHEN 'error' THEN 'MissingColumn' WHEN 'click' THEN 'TypeMismatch'
    WHEN 'view' THEN 'ValueError' WHEN 'signup' THEN 'DataQualityError' END AS error_type
  FROM events), bad AS (SELECT * FROM log WHERE NOT ok)"""
_BANDS = """CASE WHEN rate >= 95 THEN 'EXCELLENT' WHEN rate >= 90 THEN 'GOOD'
  WHEN rate >= 80 THEN 'FAIR' WHEN rate >= 70 THEN 'POOR' ELSE 'CRITICAL' END"""
_EXECUTIVE = "CASE WHEN rate >= 90 THEN 'PASSED' WHEN rate < 70 THEN 'FAILED' ELSE 'WARNING' END"
ORACLES["success_rate_bands"] = f"""WITH {LOG}, r AS (SELECT user_id, count(*) AS validations,
    count(*) FILTER (WHERE ok) / count(*) * 100 AS rate FROM log GROUP BY 1)
  SELECT user_id, validations, round_even(rate, 1) AS success_rate_percentage,
    CASE WHEN rate >= 95 THEN 'EXCELLENT' WHEN rate >= 80 THEN 'GOOD' WHEN rate >= 50 THEN 'POOR'
      ELSE 'CRITICAL' END AS overview_band,
    {_BANDS} AS executive_band, {_EXECUTIVE} AS executive_status FROM r"""
ORACLES["severity_ladder"] = f"""WITH {LOG}, s AS (
    SELECT error_type, {_SEVERITY.format('error_type')} AS severity FROM bad)
  SELECT error_type, severity, {_PRIORITY.format('severity')} AS priority, count(*) AS row_count
  FROM s GROUP BY 1, 2, 3"""
ORACLES["log_recommendations"] = f"WITH {LOG} {_RECOMMEND.format('bad')}"
ORACLES["coarse_recommendations"] = f"""WITH {LOG} SELECT DISTINCT 'MEDIUM' AS priority,
  'Data Quality' AS category, 'Implement data cleaning processes' AS recommendation,
  'Improve overall data quality' AS impact FROM bad WHERE error_type = 'DataQualityError'"""
_LOG_TOTALS = """t AS (SELECT count(*) FILTER (WHERE NOT ok) AS e, count(*) FILTER (WHERE ok) AS s,
  count(*) FILTER (WHERE ok) / count(*) * 100 AS rate, min(ts) AS a, max(ts) AS z FROM log)"""
ORACLES["run_summary"] = f"""WITH {LOG}, {_LOG_TOTALS} SELECT 0 AS total_tables,
  e AS total_errors, s AS total_successes, round_even(rate, 6) AS success_rate,
  round_even((epoch_us(z) - epoch_us(a)) / 1e6, 3) AS duration_seconds FROM t"""
ORACLES["executive_summary"] = f"""WITH {LOG}, {_LOG_TOTALS} SELECT {_EXECUTIVE} AS overall_status,
  0 AS total_tables, e AS total_errors, s AS total_successes,
  round_even(rate, 1) AS success_rate_percentage, {_BANDS} AS data_quality_status,
  CASE WHEN e = 0 THEN 'All tables passed validation successfully'
    WHEN s = 0 THEN 'All tables failed validation - immediate attention required'
    ELSE 'Mixed validation results: ' || s || ' successes, ' || e || ' errors' END AS key_finding
  FROM t"""
ORACLES["top_error_tables"] = f"""WITH {LOG} SELECT table_name, count(*) AS error_count FROM bad
  GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5"""
_LATEST = """SELECT {0}event_id, user_id FROM (SELECT *, row_number() OVER (
  PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS report_rank FROM events)
  WHERE report_rank <= {1}"""
ORACLES["report_retention"] = _LATEST.format("event_type, report_rank, ", 3)
ORACLES["report_latest"] = _LATEST.format("event_type, ", 1)
ORACLES["report_stats"] = (
    "SELECT event_type, count(*) AS report_count FROM events GROUP BY event_type")

# --- metrics ------------------------------------------------------------------------------------------------------------

ORACLES["table_metrics"] = f"""WITH {MERGED}, m AS (
  SELECT 'projects' AS table_name, (SELECT count(*) FROM raw_projects) AS input_rows,
    (SELECT count(*) FROM clean_projects) AS output_rows
  UNION ALL SELECT 'subjects', (SELECT count(*) FROM raw_subjects),
    (SELECT count(*) FROM clean_subjects)
  UNION ALL SELECT 'results', (SELECT count(*) FROM raw_results),
    (SELECT count(*) FROM clean_results)
  UNION ALL SELECT 'merged', NULL, (SELECT count(*) FROM merged))
  SELECT *, input_rows - output_rows AS filtered_rows,
    round_even(output_rows / input_rows * 100, 1) AS success_rate FROM m"""


def _steps() -> str:
    rows = []

    def add(number, step, column, rule, cells, removed):
        rows.append(
            f"SELECT {number} AS step_number, '{step}' AS step_name, {quoted(column)} AS column_name, "
            f"{quoted(rule)} AS rule, {cells} AS cells_changed, {removed} AS rows_removed")

    def changed(source, new, old):
        return f"(SELECT count(*) FROM {source} WHERE ({new}) IS DISTINCT FROM ({old}))"

    for c, e in (("sample_status", _MAPPED_STATUS), ("detection_value", _MAPPED_VALUE),
                 ("cancer_detected", _MAPPED_CANCER)):
        add(3, "value_mapping", c, None, changed("raw_results", e, c), 0)
    for c in ("sample_id", "cancer_detected", "sample_status", "fail_reason"):
        e = tidy(c) if c in ("cancer_detected", "sample_status") else std(c)
        add(4, "string_standardization", c, None, changed("mapped_results", e, c), 0)
    for c in _RESULT_NAMES.values():
        if c in ("detection_value", "sample_quality", "sample_quality_threshold"):
            lost = f"{c} IS NOT NULL AND ({num(c)}) IS NULL"
        elif c == "date_of_run":
            lost = f"{c} IS NOT NULL AND try_strptime({c}, '%d/%m/%Y') IS NULL"
        else:
            lost = "false"
        add(6, "type_conversion", c, None,
            f"(SELECT count(*) FROM standard_results WHERE {lost})", 0)
    number = 0
    cases = []
    for c in ("detection_value", "cancer_detected", "sample_status", "sample_quality",
              "sample_quality_threshold"):
        if c in ("cancer_detected", "sample_status"):
            allowed = "('Yes', 'No')" if c == "cancer_detected" else _STATUSES
            checks = [("allowed_values", f"{c} IS NULL OR {c} NOT IN {allowed}")]
        else:
            checks = [("min_value", f"{c} < 0"), ("max_value", f"{c} > 1")]
        for rule, broken in checks:
            number += 1
            cases.append(f"WHEN {broken} THEN {number}")
            add(7, "constraint_application", c, rule, 0,
                f"(SELECT count(*) FROM broken WHERE n = {number})")
    body = " UNION ALL ".join(rows)
    return f"""WITH {CLEAN_RESULTS}, broken AS (
        SELECT CASE {' '.join(cases)} END AS n, sample_id FROM typed_results),
      steps AS ({body})
      SELECT 'results' AS table_name, *, (SELECT count(*) FROM raw_results) AS rows_in FROM steps
      UNION ALL BY NAME
      SELECT 'results' AS table_name, 8 AS step_number, 'duplicate_removal' AS step_name,
        NULL AS column_name, NULL AS rule, 0 AS cells_changed,
        count(sample_id) - count(DISTINCT sample_id) AS rows_removed, count(*) AS rows_in
      FROM broken WHERE n IS NULL"""


ORACLES["step_metrics"] = _steps()
_ENTRIES = [
    ("sample_status", old, new) for old, new in (
        ("finished", "Finished"), ("running", "Running"), ("failed", "Failed"),
        ("completed", "Completed"), ("error", "Error"), ("inprogress", "InProgress"))
] + [("detection_value", old, None) for old in ("  ", " ", "", "N/A", "NA", "nan", "null")] + [
    ("cancer_detected", old, new) for old, new in (
        ("Yes", "Yes"), ("No", "No"), ("Y", "Yes"), ("N", "No"), ("True", "Yes"), ("False", "No"),
        ("1", "Yes"), ("0", "No"), ("NA", None), ("nan", None), ("N/A", None))]
ORACLES["mapping_effects"] = f"WITH {RAW_RESULTS} " + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {quoted(old)} AS from_value, {quoted(new)} AS to_value, "
    f"count(*) FILTER (WHERE lower({c}) = lower({quoted(old)})) AS rows_affected FROM raw_results"
    for c, old, new in _ENTRIES)
ORACLES["stage_delta"] = f"""WITH {CLEAN_RESULTS}, b AS (SELECT count(*) AS n FROM raw_results),
  a AS (SELECT count(*) AS n FROM clean_results)
  SELECT 'results' AS table_name, b.n AS rows_before, a.n AS rows_after, 8 AS columns_before,
    8 AS columns_after, b.n - a.n AS rows_removed, 0 AS columns_added FROM a, b"""

# --- sources and sinks -----------------------------------------------------------------------------------------------------

ORACLES["csv_round_trip"] = """SELECT o_orderkey, o_orderstatus,
  nullif(o_orderpriority, '5-LOW') AS o_orderpriority,
  'say "' || o_orderpriority || '", ' || o_orderstatus AS note FROM orders"""
ORACLES["parquet_round_trip"] = "SELECT * FROM customer"
ORACLES["report_round_trip"] = """SELECT 'value_census' AS report_type, 'run-1' AS run_id,
  'o_orderstatus' AS column_name, o_orderstatus AS value, count(*) AS row_count
  FROM orders GROUP BY o_orderstatus"""

ORACLES["csv_quarantine"] = """SELECT o_orderkey,
  CASE WHEN outcome = 'row' THEN o_orderstatus END AS o_orderstatus,
  CASE WHEN outcome = 'row' THEN o_orderpriority || ', "kept"' END AS note, outcome
  FROM (SELECT *, CASE WHEN o_orderkey % 13 = 0 THEN 'undecodable' WHEN o_orderkey % 17 = 0 THEN 'unclosed quote'
    WHEN o_orderkey % 11 = 0 THEN 'too many fields' WHEN o_orderkey % 7 = 0 THEN 'too few fields' ELSE 'row' END AS outcome
    FROM orders)"""

# --- counts from footers ---------------------------------------------------------------------------------------------------

_STORED = {
    "orders": ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"),
    "lineitem": ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
                 "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"),
    "events": ("event_id", "ts", "user_id", "event_type", "value", "props"),
    "documents": ("doc_id", "text", "lang", "source", "n_chars"),
    "embeddings": ("vec_id", "embedding", "label"),
}
ORACLES["footer_null_profile"] = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count, "
    f"(count(*) - count({c})) / count(*) AS null_ratio FROM {t}" for t, names in _STORED.items() for c in names)
_GATE_ROW = """SELECT '{0}' AS table_name, '{1}' AS rule, {2} AS column_name, cast({3} AS double) AS measured,
  cast({4} AS double) AS threshold, {3} <= {4} AS passed FROM {0}"""
ORACLES["footer_gate"] = " UNION ALL ".join([
    _GATE_ROW.format("orders", rule, f"'{c}'", e, 0)
    for c in ("o_orderkey", "o_custkey") for rule, e in (("missing_key_column", "count(*) * 0"), ("null_key", f"count(*) - count({c})"))
] + [_GATE_ROW.format("orders", "missing_key_column", "'o_batch'", "count(*) * 0 + 1", 0)] + [
    _GATE_ROW.format(t, "null_ratio", "CAST(NULL AS varchar)", _cells(names), 0.2) for t, names in {
        "customer": ("c_custkey", "c_name", "c_nationkey", "c_mktsegment", "c_acctbal"),
        "conversations": ("conv_id", "turn", "role", "text"), "pages": ("page_id", "url", "html")}.items()])

# --- the log of runs -------------------------------------------------------------------------------------------------------

_KEPT_RUNS = f"""WITH {LOG}, runs AS (SELECT 'run:' || cast(user_id % 6 AS varchar) AS run_id, * FROM log),
  ranked AS (SELECT run_id, row_number() OVER (ORDER BY max(ts) DESC, run_id DESC) AS r FROM runs GROUP BY run_id)"""
ORACLES["event_log"] = f"""{_KEPT_RUNS} SELECT run_id, CASE WHEN ok THEN 'success' ELSE 'error' END AS kind, error_type,
  count(*) AS n_events FROM runs JOIN ranked USING (run_id) WHERE r <= 3 GROUP BY ALL"""
ORACLES["event_log_retention"] = f"""{_KEPT_RUNS} SELECT 'validation_events' AS report_type,
  count(*) FILTER (WHERE r <= 3) AS kept, count(*) FILTER (WHERE r > 3) AS cleaned FROM ranked"""
ORACLES["report_documents"] = f"""{_KEPT_RUNS} SELECT run_id, 'by_type' AS section, error_type AS item,
    cast(count(*) AS varchar) AS value, string_agg(DISTINCT table_name, ',' ORDER BY table_name) AS detail
    FROM runs WHERE NOT ok GROUP BY run_id, error_type
  UNION ALL SELECT run_id, 'rates', 'validations', cast(count(*) AS varchar),
    CASE WHEN avg(cast(ok AS integer)) * 100 >= 95 THEN 'EXCELLENT' WHEN avg(cast(ok AS integer)) * 100 >= 80 THEN 'GOOD'
      WHEN avg(cast(ok AS integer)) * 100 >= 50 THEN 'POOR' ELSE 'CRITICAL' END FROM runs GROUP BY run_id"""

# --- kept profiles and bitmaps -----------------------------------------------------------------------------------------------

_PROFILED = ("event_type", "user_id", "value")
ORACLES["merged_profile"] = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count, "
    f"(count(*) - count({c})) / count(*) AS null_ratio, min(cast({c} AS varchar)) AS least, "
    f"max(cast({c} AS varchar)) AS greatest FROM events" for c in _PROFILED)
ORACLES["frequent_values"] = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, cast({c} AS varchar) AS value, count(*) AS row_count FROM events WHERE {c} IS NOT NULL "
    f"GROUP BY {c} HAVING count(*) >= 0.01 * (SELECT count(*) FROM events)" for c in _PROFILED)
ORACLES["bitmap_duplicates"] = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS rows_in, count(DISTINCT {k}) AS distinct_keys, "
    f"count(*) - count(DISTINCT {k}) AS duplicate_rows FROM {t}"
    for t, k in (("lineitem", "l_orderkey"), ("orders", "o_custkey"), ("events", "user_id"), ("conversations", "conv_id")))
_ORPHAN_KEYS = """SELECT '{0}' AS relation, (SELECT count(*) FROM ({1})) AS left_keys, (SELECT count(*) FROM ({2})) AS right_keys,
  (SELECT count(*) FROM ({1} INTERSECT {2})) AS common, (SELECT count(*) FROM ({1} EXCEPT {2})) AS left_only,
  (SELECT count(*) FROM ({2} EXCEPT {1})) AS right_only"""
ORACLES["bitmap_orphan_keys"] = " UNION ALL ".join([
    _ORPHAN_KEYS.format("customer-orders", "SELECT DISTINCT c_custkey FROM customer", "SELECT DISTINCT o_custkey FROM orders"),
    _ORPHAN_KEYS.format("orders-lineitem", "SELECT DISTINCT o_orderkey FROM orders WHERE o_orderkey % 3 > 0",
                        "SELECT DISTINCT l_orderkey FROM lineitem")])
ORACLES["bitmap_orphan_rows"] = """SELECT nullif(l_orderkey, 7) AS l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity
  FROM lineitem WHERE l_orderkey = 7 OR l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 5 > 0)"""

# --- stored by key -----------------------------------------------------------------------------------------------------------

ORACLES["merge_copartitioned"] = ORACLES["merge_full"]
ORACLES["dedup_copartitioned"] = ORACLES["clean_subjects"]

# --- sources of one's own, SQL functions, matched columns ----------------------------------------------------------------------

ORACLES["arrow_round_trip"] = "SELECT * FROM orders"
ORACLES["sql_functions"] = f"""WITH {RAW_RESULTS}, {TYPED_RESULTS}
  SELECT sample_id, detection_value, cancer_detected, sample_status, date_of_run, count(*) AS row_count
  FROM typed_results GROUP BY ALL"""
ORACLES["column_matching"] = """SELECT l_returnflag AS returnflag, l_linestatus AS line_status,
  cast(sum(l_partkey) AS bigint) AS part_keys, cast(sum(l_orderkey) AS bigint) AS order_keys,
  cast(sum(cast(l_quantity AS bigint)) AS bigint) AS pieces FROM lineitem GROUP BY 1, 2"""

# --- extraction, recipes, specs, reports ----------------------------------------------------------------------------------------

_RAW_TABLES = f"{RAW_PROJECTS}, {RAW_SUBJECTS}, {RAW_RESULTS}"
ORACLES["extract_tables"] = f"""WITH {_RAW_TABLES}
  SELECT 'projects' AS source, count(*) AS row_count, count(study_code) AS key_count, CAST(NULL AS varchar) AS error FROM raw_projects
  UNION ALL SELECT 'subjects', count(*), count(sample_id), NULL FROM raw_subjects
  UNION ALL SELECT 'results', count(*), count(sample_id), NULL FROM raw_results
  UNION ALL SELECT 'absent', NULL, NULL, 'Failed to extract results'"""
_RECIPE_STEPS = {
    "projects": ("pre_validation", "column_mapping", "string_standardization", "missing_value_handling", "type_conversion",
                 "duplicate_removal", "post_validation"),
    "subjects": ("pre_validation", "column_mapping", "string_standardization", "missing_value_handling", "type_conversion",
                 "duplicate_removal", "post_validation"),
    "results": ("pre_validation", "column_mapping", "value_mapping", "string_standardization", "missing_value_handling",
                "type_conversion", "constraint_application", "duplicate_removal", "post_validation"),
}
ORACLES["recipe_output"] = f"WITH {_RAW_TABLES} " + " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, {i} AS step_number, '{s}' AS step_name, true AS enabled, count(*) AS input_rows FROM raw_{t}"
    for t, steps in _RECIPE_STEPS.items() for i, s in enumerate(steps, 1))
ORACLES["type_convert_strict"] = """SELECT l_orderkey, l_linenumber, cast(l_quantity AS double) AS quantity,
  cast(l_partkey AS bigint) AS part_key FROM lineitem"""
_COLUMNS_OF = {
    "projects": [(c, "str") for c in shapes.PROJECTS],
    "subjects": [(c, "str") for c in ("project_code", "study_code", "study_cohort_code", "subject_id", "sample_id", "sample_type")],
    "results": list(zip(_RESULT_NAMES.values(), ("str", "float64", "str", "str", "str", "float64", "float64", "datetime64[ns]"))),
}
_NOT_NULLABLE = {"projects": None, "subjects": None, "results": ("sample_id",)}  # None: every column
ORACLES["schema_metadata"] = f"WITH {_RAW_TABLES} " + " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, {i} AS position, '{c}' AS column_name, '{k}' AS data_type, "
    f"{str(_NOT_NULLABLE[t] is not None and c not in _NOT_NULLABLE[t]).lower()} AS nullable, count(*) AS row_count, "
    f"count(*) - count({c}) AS null_count FROM raw_{t}" for t, columns in _COLUMNS_OF.items() for i, (c, k) in enumerate(columns))
ORACLES["rule_lint"] = f"WITH {_RAW_TABLES} " + " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, 'string_validation' AS rule_type, count(*) - count({c}) AS null_count FROM raw_{t}"
    for t, columns in (("projects", ("project_name", "study_name", "study_cohort_name", "project_manager_name", "disease_name")),
                       ("subjects", ("sample_type",))) for c in columns)
_REPORT_ROWS = {
    "run_summary": "1", "quick_overview": "1", "executive_summary": "1",
    "table_analysis": "(SELECT count(*) FROM results_of)",
    "schema_violations": "(SELECT count(*) FROM (SELECT DISTINCT table_name, stage FROM errors))",
    "detailed_errors": "(SELECT count(*) FROM errors)", "error_details": "(SELECT count(*) FROM errors)",
    "critical_issues": "(SELECT count(*) FROM errors)",
    "data_quality_issues": "(SELECT count(*) FROM errors WHERE error_type IN ('DataQualityError', 'ValidationError'))",
    "error_by_type": "(SELECT count(DISTINCT error_type) FROM errors)", "error_by_table": "(SELECT count(DISTINCT table_name) FROM errors)",
    "top_error_types": "least(5, (SELECT count(DISTINCT error_type) FROM errors))",
    "top_error_tables": "least(5, (SELECT count(DISTINCT table_name) FROM errors))",
    "recommendations": "(SELECT count(DISTINCT error_type) FROM errors)",
    "success_summary": "(SELECT count(*) FROM results_of WHERE n = 0)",
    "quality_highlights": "(SELECT count(*) FROM results_of WHERE n = 0 AND stage = 'after_cleaning' AND data_quality_score >= 95)",
    "coarse_recommendations": "(SELECT count(DISTINCT error_type) FROM errors WHERE error_type IN ('SchemaViolation', 'DataQualityError'))",
    "next_steps": "(SELECT CASE WHEN count(*) FILTER (WHERE n > 0) > 0 THEN 3 ELSE 0 END + CASE WHEN count(*) FILTER (WHERE n = 0) > 0 THEN 2 ELSE 0 END "
                  "FROM results_of WHERE stage = 'after_cleaning')",
}
ORACLES["all_reports"] = f"WITH {EVENTS} " + " UNION ALL ".join(
    f"SELECT '{name}' AS report, cast({rows} AS bigint) AS row_count" for name, rows in _REPORT_ROWS.items())
