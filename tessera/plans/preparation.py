"""Queries of the general data-preparation problems (1, 3, 4, 5) over the project's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import drift, failed_rows, packed, units
from ..session import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """raw_line_id and failure_code of each line that is not a valid record."""
    _, failed = failed_rows.export_outcome(table(spark, d, "raw_line"), table(spark, d, "artifact"))
    return failed.select("raw_line_id", "failure_code")


def p1_failures(spark: SparkSession, d: str) -> DataFrame:
    """Failed lines with the edit operations that state the reason."""
    return failed_rows.export_outcome(table(spark, d, "raw_line"), table(spark, d, "artifact"))[1]


def p1_valid(spark: SparkSession, d: str) -> DataFrame:
    """Valid lines, typed."""
    return failed_rows.export_outcome(table(spark, d, "raw_line"), table(spark, d, "artifact"))[0]


def _drift(spark: SparkSession, d: str) -> drift.Drift:
    return drift.Drift(drift.staged_values(table(spark, d, "raw_field"), table(spark, d, "artifact")))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Every change of a path between a file and the data set's previous one."""
    return _drift(spark, d).changes()


def p3_lifespans(spark: SparkSession, d: str) -> DataFrame:
    """First and last edition number of each unbroken run of a path, with the last name of its chain of renames."""
    return _drift(spark, d).aliases()


def p3_table(spark: SparkSession, d: str) -> DataFrame:
    """All editions in one consistent, typed table."""
    return _drift(spark, d).consistent(absences=True)


def _claims(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return table(spark, d, "parsed_value"), table(spark, d, "metric"), table(spark, d, "unit_reference")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of claims about the same thing whose amounts agree in the base unit."""
    return units.agreeing_claims(*_claims(spark, d)).pairs()


def p4_classes(spark: SparkSession, d: str) -> DataFrame:
    """Every claim with an amount: its class of equal amounts, the rows of the class and the number of claims it agrees with."""
    return units.agreeing_claims(*_claims(spark, d)).counted()


def p4_amounts(spark: SparkSession, d: str) -> DataFrame:
    """Every claim with its amount in the metric's base unit, or the reason it has none."""
    columns = ["parsed_value_id", "dataset_code", "source_key", "metric_code", "reference_year", "base_amount", "base_unit", "read_unit", "amount_reason"]
    return units.normalise(*_claims(spark, d)).select(*columns)


def _lists(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "raw_field").where(F.col("field_name").isin(*packed.LIST_FIELDS))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Members of the lists with two or more members."""
    return packed.explode_labels(_lists(spark, d), ["field_value_id"], "raw_text", least=2)


def p5_members(spark: SparkSession, d: str) -> DataFrame:
    """Members of all lists with note, amount and error flag."""
    return packed.explode_members(_lists(spark, d), ["field_value_id", "source_key", "field_name"], "raw_text")


QUERIES = {
    "p1_found": p1_found, "p1_failures": p1_failures, "p1_valid": p1_valid, "p3_found": p3_found, "p3_lifespans": p3_lifespans, "p3_table": p3_table,
    "p4_found": p4_found, "p4_classes": p4_classes, "p4_amounts": p4_amounts, "p5_found": p5_found, "p5_members": p5_members,
}
_LINES = r"""
WITH f AS (SELECT artifact_id, max(delimiter) AS delimiter FROM artifact GROUP BY artifact_id),
l AS (SELECT raw_line_id, coalesce(line_text, '') AS t, coalesce(delimiter, ',') AS d FROM raw_line LEFT JOIN f USING (artifact_id) WHERE line_no > 1),
x AS (SELECT *, CASE d WHEN '|' THEN '\|' ELSE d END AS e FROM l),
c AS (SELECT raw_line_id, regexp_full_match(t, '(?s)(?:"(?:[^"]|"")*"|[^"' || e || ']*)(?:' || e || '(?:"(?:[^"]|"")*"|[^"' || e || ']*))*') AS quoted_well,
  regexp_extract_all(t || d, '(?s)("(?:[^"]|"")*"|[^"' || e || ']*)' || e, 1) AS raw_cells FROM x),
v AS (SELECT raw_line_id, quoted_well, list_transform(raw_cells, lambda z: CASE WHEN starts_with(z, '"') THEN replace(substr(z, 2, length(z) - 2), '""', '"') ELSE trim(z, ' ') END) AS k FROM c)
SELECT raw_line_id, CASE WHEN NOT quoted_well THEN 'broken_quoting' WHEN len(k) <> 9 THEN 'wrong_column_count' ELSE 'invalid_value' END AS failure_code FROM v
WHERE NOT quoted_well OR len(k) <> 9 OR NOT (
  regexp_full_match(k[1], '[a-z]{2}') AND regexp_full_match(k[2], '[0-9]{4}') AND coalesce(try_cast(k[2] AS INT), 0) BETWEEN 1980 AND 2030 AND regexp_full_match(k[4], '[0-9]+')
  AND regexp_full_match(k[6], '(-?([0-9]+|[0-9]{1,3}(,[0-9]{3})+)(\.[0-9]+)?)?') AND k[7] IN ('parsed_exact', 'parsed_with_qualifier', 'parsed_partial', 'unparsed')
  AND k[8] IN ('', 'empty', 'explanatory_note_not_a_value', 'no_number_found', 'number_unparseable', 'out_of_range') AND regexp_full_match(k[9], '[0-9]{4}-[0-9]{2}-[0-9]{2}') AND try_cast(k[9] AS DATE) IS NOT NULL)
"""

_CHANGES = r"""
WITH f AS (SELECT DISTINCT artifact_id, dataset_code, edition_year FROM artifact WHERE parser_family IS DISTINCT FROM 'delimited_export' AND dataset_code IS NOT NULL AND edition_year IS NOT NULL),
v AS (SELECT dataset_code, edition_year, source_key, coalesce(section_name,'')||'|'||coalesce(field_name,'')||'|'||coalesce(subfield_name,'') AS path, raw_text,
  raw_text IS NOT NULL AND trim(lower(raw_text)) NOT IN ('','na','n/a','n.a.','negl','-','none reported','not available','unknown') AS stated,
  trim(regexp_replace(raw_text, '(\s*(\([^()]*\)|\[[^\[\]]*\]))+\s*$', '')) AS t
  FROM raw_field JOIN f USING (artifact_id)),
k AS (SELECT *, CASE WHEN NOT stated THEN NULL
  WHEN regexp_full_match(t, '[-+]?([0-9]+|[0-9]{1,3}(,[0-9]{3})+)') THEN 'whole'
  WHEN regexp_full_match(t, '[-+]?([0-9]+|[0-9]{1,3}(,[0-9]{3})+)?\.[0-9]+') THEN 'decimal'
  WHEN regexp_full_match(t, '[-+]?([0-9]+|[0-9]{1,3}(,[0-9]{3})+)(\.[0-9]+)? ?%') THEN 'percentage'
  WHEN regexp_full_match(t, '[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2} [A-Z][a-z]+ [0-9]{4}|[A-Z][a-z]+ [0-9]{1,2}, [0-9]{4}') THEN 'date' ELSE 'text' END AS kind FROM v),
n AS (SELECT dataset_code, edition_year, path, kind, count(*) AS c FROM k GROUP BY ALL),
p AS (SELECT dataset_code, edition_year, path, arg_min(kind, (-c, CASE kind WHEN 'whole' THEN 1 WHEN 'decimal' THEN 2 WHEN 'percentage' THEN 3 WHEN 'date' THEN 4 ELSE 5 END)) FILTER (WHERE kind IS NOT NULL) AS kind FROM n GROUP BY ALL),
e AS (SELECT dataset_code, edition_year, lag(edition_year) OVER (PARTITION BY dataset_code ORDER BY edition_year) AS before FROM (SELECT DISTINCT dataset_code, edition_year FROM p)),
started AS (SELECT e.dataset_code, e.edition_year, e.before, b.path FROM e JOIN p b USING (dataset_code, edition_year) WHERE e.before IS NOT NULL AND NOT EXISTS (SELECT 1 FROM p a WHERE a.dataset_code = e.dataset_code AND a.edition_year = e.before AND a.path = b.path)),
ended AS (SELECT e.dataset_code, e.edition_year, e.before, a.path FROM e JOIN p a ON a.dataset_code = e.dataset_code AND a.edition_year = e.before WHERE NOT EXISTS (SELECT 1 FROM p b WHERE b.dataset_code = e.dataset_code AND b.edition_year = e.edition_year AND a.path = b.path)),
s AS (SELECT DISTINCT dataset_code, edition_year, path, source_key, raw_text FROM v WHERE stated AND source_key IS NOT NULL),
r AS (SELECT o.dataset_code, o.edition_year, o.path AS old_path, w.path AS new_path
  FROM ended o JOIN started w ON o.dataset_code = w.dataset_code AND o.edition_year = w.edition_year
  JOIN s x ON x.dataset_code = o.dataset_code AND x.edition_year = o.before AND x.path = o.path
  JOIN s y ON y.dataset_code = o.dataset_code AND y.edition_year = o.edition_year AND y.path = w.path AND y.source_key = x.source_key
  GROUP BY ALL HAVING 2 * count(DISTINCT CASE WHEN x.raw_text = y.raw_text THEN x.source_key END) > count(DISTINCT x.source_key))
SELECT dataset_code, edition_year, 'renamed' AS change_kind, old_path, new_path FROM r
UNION ALL SELECT dataset_code, edition_year, 'added', '', path FROM started t WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.dataset_code = t.dataset_code AND r.edition_year = t.edition_year AND r.new_path = t.path)
UNION ALL SELECT dataset_code, edition_year, 'removed', path, '' FROM ended t WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.dataset_code = t.dataset_code AND r.edition_year = t.edition_year AND r.old_path = t.path)
UNION ALL SELECT e.dataset_code, e.edition_year, 'type_changed', a.path, a.path FROM e JOIN p a ON a.dataset_code = e.dataset_code AND a.edition_year = e.before JOIN p b ON b.dataset_code = e.dataset_code AND b.edition_year = e.edition_year AND a.path = b.path WHERE a.kind <> b.kind
"""

SQL: dict[str, str] = {"p1_found": _LINES, "p3_found": _CHANGES}
