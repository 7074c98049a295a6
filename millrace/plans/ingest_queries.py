"""Queries over the tolerant loader and the schema drift operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.schema_drift import profiles, schema_changes, unified_table
from millrace.session import table
from millrace.sources.delimited import failed_in_files, failed_lines, load_lines


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return failed_lines(table(spark, sf_dir, "testdata_lines"), table(spark, sf_dir, "layouts")).select("line_id")


def p1_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid lines as typed columns, failed ones with _load_error, _line_b64encoded and row."""
    return load_lines(table(spark, sf_dir, "testdata_lines"), table(spark, sf_dir, "layouts"))


def p1_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many lines of each layout fail for which reason."""
    failed = failed_lines(table(spark, sf_dir, "testdata_lines"), table(spark, sf_dir, "layouts"))
    return failed.groupBy("layout_id", "_load_error").agg(F.count("*").alias("n"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema_changes(table(spark, sf_dir, "testdata_json")).select("file_id", "change_kind", "field_name", "new_name")


def p5_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every change with the types before and after."""
    return schema_changes(table(spark, sf_dir, "testdata_json"))


def p5_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All records in one table under the fields' first names."""
    return unified_table(table(spark, sf_dir, "testdata_json"))


def p1_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What fails when the lines of a file are put together and read as a whole, with recovery after broken quoting."""
    return failed_in_files(table(spark, sf_dir, "testdata_lines"), table(spark, sf_dir, "layouts")).select("line_id")


def p5_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every field of every file with its type and how many records have it."""
    return profiles(table(spark, sf_dir, "testdata_json")).select("file_id", "field", "kind", "n")


QUERIES = {"p1_files": p1_files, "p5_profiles": p5_profiles, "p1_found": p1_found, "p1_loaded": p1_loaded, "p1_errors": p1_errors, "p5_found": p5_found, "p5_changes": p5_changes, "p5_table": p5_table}
#: The same rules as a regular expression for each layout, put together from its columns. Real days are spelt out.
_DAY = (
    "(?:[0-9]{4}-(?:(?:0[13578]|1[02])-(?:0[1-9]|[12][0-9]|3[01])|(?:0[469]|11)-(?:0[1-9]|[12][0-9]|30)|02-(?:0[1-9]|1[0-9]|2[0-8]))"
    "|(?:[0-9]{2}(?:0[48]|[2468][048]|[13579][26])|(?:[02468][048]|[13579][26])00)-02-29)"
)
SQL: dict[str, str] = {
    "p1_found": rf"""
        WITH c AS (
            SELECT layout_id, pos, col_type, required, regexp_escape(sep) AS s, quotechar AS q,
                CASE WHEN length(sep) = 1 THEN '[^' || regexp_escape(sep) || ']' ELSE '(?:[^|]|\|[^|])' END AS any_sign,
                CASE WHEN length(sep) = 1 THEN '[^' || quotechar || regexp_escape(sep) || ']' ELSE '(?:[^' || quotechar || '|]|\|[^|])' END AS first_sign,
                CASE WHEN length(sep) = 1 THEN '[^ ' || quotechar || regexp_escape(sep) || ']' ELSE '(?:[^ ' || quotechar || '|]|\|[^|])' END AS first_letter,
                CASE WHEN length(sep) = 1 THEN '[^ ' || regexp_escape(sep) || ']' ELSE '(?:[^ |]|\|[^|])' END AS letter,
                CASE col_type WHEN 'bigint' THEN '[+-]?0*[0-9]{{1,18}}' WHEN 'decimal' THEN '[+-]?[0-9]+(?:\.[0-9]+)?' WHEN 'boolean' THEN '(?i:true|false)' WHEN 'date' THEN '{_DAY}' END AS v
            FROM layouts),
        cells AS (
            SELECT layout_id, pos, s, CASE
                WHEN v IS NULL AND required THEN '(?:' || q || ' *(?:[^ ' || q || ']|' || q || q || ')(?:[^' || q || ']|' || q || q || ')*' || q || '|' || first_letter || any_sign || '*| +' || letter || any_sign || '*)'
                WHEN v IS NULL THEN '(?:' || q || '(?:[^' || q || ']|' || q || q || ')*' || q || '|' || first_sign || any_sign || '*)?'
                WHEN required THEN '(?:' || q || ' *' || v || ' *' || q || '| *' || v || ' *)'
                ELSE '(?:' || q || ' *(?:' || v || ')? *' || q || '| *(?:' || v || ')? *)' END AS cell
            FROM c),
        patterns AS (SELECT layout_id, string_agg(CASE WHEN pos > 1 THEN s ELSE '' END || cell, '' ORDER BY pos) AS pattern FROM cells GROUP BY layout_id)
        SELECT line_id FROM testdata_lines LEFT JOIN patterns USING (layout_id)
        WHERE NOT coalesce(regexp_full_match(regexp_replace(line, '\r$', ''), pattern, 's'), false)""",
    "p5_profiles": """
        WITH latest AS (
            SELECT feed_id, file_id, row, arg_max(line, {'a': arrived_at, 'l': line_id}) AS line FROM testdata_json GROUP BY feed_id, file_id, row),
        objects AS (SELECT feed_id, file_id, row, CAST(line AS JSON) AS j FROM latest WHERE json_valid(line) AND json_type(CAST(line AS JSON)) = 'OBJECT'),
        names AS (SELECT feed_id, file_id, j, unnest(json_keys(j)) AS name FROM objects),
        kinds AS (SELECT feed_id, file_id, lower(name) AS field, json_type(j -> ('$."' || name || '"')) AS t FROM names),
        typed AS (SELECT *, CASE t WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'ARRAY' THEN 'array' WHEN 'OBJECT' THEN 'object' ELSE 'number' END AS kind FROM kinds WHERE t <> 'NULL'),
        counted AS (SELECT feed_id, file_id, field, kind, count(*) AS k FROM typed GROUP BY ALL)
        SELECT file_id, field, arg_min(kind, {'a': -k, 'b': kind}) AS kind, CAST(sum(k) AS BIGINT) AS n FROM counted GROUP BY feed_id, file_id, field""",
}
SQL["p1_files"] = SQL["p1_found"]
