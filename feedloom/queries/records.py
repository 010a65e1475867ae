"""Row-level work: conversion, rules, filling, routing, redaction, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions import rules as R
from feedloom.functions.records import error_line, json_text, json_value, redacted_record
from feedloom.functions.text import is_uuid, utf16_length
from feedloom.operators import route
from feedloom.operators.prepare import add_metadata, fill_missing
from feedloom.operators.reconcile import stage_counters
from feedloom.plans.employee import EMPLOYEE
from feedloom.queries.raw_feed import FEED_CTES, checked_feed, table, typed_feed
from feedloom.schema import Feed, Field

RUN = "00000000-0000-4000-8000-000000000001"


def reject_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rejected record with all its errors in rule order."""
    rejected = route.failed(checked_feed(spark, sf_dir))
    return rejected.select("record_number", "error_type", "error_message")


def typed_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text to numbers, booleans, lists and structs, with one parse error at most."""
    return typed_feed(spark, sf_dir).selectExpr(
        "record_number", "parse_error", "employee_id", "salary", "is_active",
        "array_join(skills, '|') AS skills", "address.street AS street", "emergency_contact.phone AS contact_phone",
    )


def route_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters per stage of the run."""
    checked = route.check_constraints(checked_feed(spark, sf_dir), EMPLOYEE)
    return stage_counters(checked.withColumn("execution_id", F.lit(RUN)))


def errors_by_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each message occurs, from the list of errors of every record."""
    listed = typed_feed(spark, sf_dir).where("parse_error IS NULL").selectExpr(f"{R.errors_of(EMPLOYEE.rules)} AS errors")
    # explode_outer: for explode, Catalyst would add a filter with a second copy of all the rules.
    messages = listed.selectExpr("explode_outer(errors) AS message").where("message IS NOT NULL")
    return messages.groupBy("message").agg(F.count("*").alias("n"))


def length_in_utf16(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length rules count UTF-16 units, over whole conversation texts."""
    turns = table(spark, sf_dir, "conversations")
    feed = Feed("turns", "conv_id", (Field("text"), Field("role")), (R.Length("text", 1, 120), R.Required("role")))
    return route.validate(turns, feed).selectExpr(
        "conv_id", "turn", f"{utf16_length('text')} AS units", "error_message"
    )


def skills_total_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A list's joined length, over the parts every supplier ships."""
    shipped = table(spark, sf_dir, "part").selectExpr("p_partkey", "array(p_name, p_type, p_brand) AS words")
    rule = R.JoinedLength("words", 26, ";")
    return shipped.selectExpr("p_partkey", f"{rule.error()} AS problem")


def missing_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing texts become one space, also inside nested fields; numbers and dates do not."""
    feed = typed_feed(spark, sf_dir).where("parse_error IS NULL")
    filled = fill_missing(feed, EMPLOYEE)
    return filled.selectExpr(
        "record_number", "first_name", "last_name", "email", "salary", "hire_date", "size(skills) AS n_skills",
        "address.city AS city", "address.state AS state", "emergency_contact.relationship AS relationship",
    )


def lineage_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run id and load time on every row."""
    rows = add_metadata(table(spark, sf_dir, "orders"), RUN)
    return rows.selectExpr(
        "o_orderkey", "execution_id", f"{is_uuid('execution_id')} AS valid_id", "ingestion_timestamp IS NOT NULL AS stamped"
    )


def redacted_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected records as JSON, sensitive values hidden where there are any."""
    rejected = route.failed(checked_feed(spark, sf_dir)).where("error_type = 'VALIDATION_ERROR'")
    raw = rejected.selectExpr("record_number", f"{redacted_record(EMPLOYEE)} AS raw_record")
    return raw.selectExpr(
        "record_number",
        f"{json_text('raw_record', '$.employee_id')} AS employee_id",
        f"{json_text('raw_record', '$.phone_number')} AS phone_number",
        f"{json_text('raw_record', '$.salary')} AS salary",
        f"{json_text('raw_record', '$.emergency_contact.phone')} AS contact_phone",
        f"{json_text('raw_record', '$.emergency_contact.name')} AS contact_name",
        "cast(contains(raw_record, '\"last_name\":null') AS boolean) AS null_kept",
    )


# Orders as a second feed, with its own rules and target constraints.
_ORDER_FEED = Feed(
    "orders",
    "o_orderkey",
    (Field("o_orderkey", "long"), Field("o_orderstatus"), Field("o_orderpriority"), Field("o_totalprice", sensitive=True)),
    (R.Matches("o_orderstatus", "[OF]", "o_orderstatus must be O or F"), R.Length("o_orderpriority", 5, 13)),
    (R.MaxLength("o_orderpriority", 8), R.OneOf("o_orderstatus", ("F",)), R.NotNull("o_orderkey")),
)


def dead_letter_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parse, validation and load failures in one bag, told apart in one pass."""
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS record_number",
        "'orders' AS source_file",
        "if(o_custkey % 50 = 0, 'row has 5 column(s) but the header has 6', NULL) AS parse_error",
        "o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice",
    )
    checked = route.check_constraints(route.validate(orders, _ORDER_FEED), _ORDER_FEED)
    bag = route.combine(route.failure_rows(checked, _ORDER_FEED, RUN))
    return bag.selectExpr(
        "record_number", "source_file", "execution_id", "error_type", "error_message", "o_orderkey",
        f"{json_text('raw_record', '$.o_totalprice')} AS shown_price",
    )


def error_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text report; separators and line breaks inside values become spaces."""
    rejected = route.failed(checked_feed(spark, sf_dir)).selectExpr(
        "record_number", "error_type", "concat(error_message, '|\\r\\n', record_number) AS error_message", "employee_id",
        "source_file", "cast(NULL AS string) AS execution_id",
    )
    return rejected.selectExpr("record_number", f"{error_line('employee_id')} AS line")


def load_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows the target table would refuse, by its declared widths and checks."""
    parts = table(spark, sf_dir, "part").selectExpr("*", "cast(NULL AS string) AS error_type", "'' AS error_message")
    feed = Feed(
        "part",
        "p_partkey",
        (),
        (),
        (
            R.MaxLength("p_name", 10),
            R.NotNull("p_brand"),
            R.OneOf("p_type", ("ECONOMY", "STANDARD", "PROMO")),
            R.MaxLength("p_brand", 7),
        ),
    )
    checked = route.check_constraints(parts, feed)
    return checked.select("p_partkey", "error_type", F.when(F.col("error_type").isNotNull(), F.col("error_message")).alias("message"))


def sqlstate_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Database errors of a load log: the row's fault or the database's."""
    log = table(spark, sf_dir, "events").selectExpr(
        "event_type",
        "CASE event_id % 5 WHEN 0 THEN '22001' WHEN 1 THEN '23505' WHEN 2 THEN '08006' WHEN 3 THEN '40001' END AS state",
    )
    return log.selectExpr("event_type", f"{R.is_row_level('state')} AS row_level").groupBy("event_type", "row_level").agg(
        F.count("*").alias("n")
    )


def json_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A member of a JSON column as text and as a number."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id", f"{json_text('props', '$.k')} AS k_text", f"{json_value('props', '$.k', 'bigint')} AS k"
    )


QUERIES = {
    "reject_report": reject_report,
    "typed_parse": typed_parse,
    "route_counts": route_counts,
    "errors_by_rule": errors_by_rule,
    "length_in_utf16": length_in_utf16,
    "skills_total_length": skills_total_length,
    "missing_fill": missing_fill,
    "lineage_columns": lineage_columns,
    "redacted_rejects": redacted_rejects,
    "dead_letter_union": dead_letter_union,
    "error_lines": error_lines,
    "load_constraints": load_constraints,
    "sqlstate_classes": sqlstate_classes,
    "json_extract": json_extract,
}

ORACLE = {
    "reject_report": f"""{FEED_CTES} SELECT c_custkey AS record_number, error_type, error_message
        FROM checked WHERE error_type IS NOT NULL""",
    "typed_parse": f"""{FEED_CTES} SELECT c_custkey AS record_number, parse_error,
        CASE WHEN parse_error IS NULL THEN employee_id END AS employee_id,
        CASE WHEN parse_error IS NULL THEN try_cast(salary AS bigint) END AS salary,
        CASE WHEN parse_error IS NULL THEN CASE lower(is_active) WHEN 'true' THEN true WHEN 'false' THEN false END END
          AS is_active,
        CASE WHEN parse_error IS NULL THEN array_to_string(skill_list, '|') END AS skills,
        CASE WHEN parse_error IS NULL THEN address_street END AS street,
        CASE WHEN parse_error IS NULL THEN emergency_contact_phone END AS contact_phone FROM typed""",
    "route_counts": f"""{FEED_CTES} SELECT '{RUN}' AS execution_id,
        count(*) FILTER (WHERE parse_error IS NULL) AS records_parsed,
        count(*) FILTER (WHERE error_type = 'PARSE_ERROR') AS parse_errors,
        count(*) FILTER (WHERE error_type = 'VALIDATION_ERROR') AS validation_errors,
        count(*) FILTER (WHERE error_type IS NULL) AS records_loaded, cast(0 AS bigint) AS load_errors FROM checked""",
    "errors_by_rule": f"""{FEED_CTES} SELECT message, count(*) AS n FROM (
        SELECT unnest(string_split(error_message, '; ')) AS message FROM checked WHERE error_type = 'VALIDATION_ERROR')
        GROUP BY message""",
    "length_in_utf16": """WITH u AS (SELECT *, length(text) + length(regexp_replace(text, '[^\\x{10000}-\\x{10FFFF}]', '', 'g'))
          AS units FROM conversations)
        SELECT conv_id, turn, units, nullif(concat_ws('; ',
          CASE WHEN text IS NULL OR regexp_full_match(text, '\\s*') THEN 'text is required'
            WHEN units NOT BETWEEN 1 AND 120 THEN 'text must be between 1 and 120 characters (found ' || units || ')' END,
          CASE WHEN role IS NULL OR trim(role) = '' THEN 'role is required' END), '') AS error_message FROM u""",
    "skills_total_length": """SELECT p_partkey, CASE WHEN length(concat_ws(';', p_name, p_type, p_brand)) > 26
        THEN 'words must not exceed 26 characters in total' END AS problem FROM part""",
    "missing_fill": f"""{FEED_CTES} SELECT c_custkey AS record_number, coalesce(first_name, ' ') AS first_name,
        coalesce(last_name, ' ') AS last_name, coalesce(email, ' ') AS email, try_cast(salary AS bigint) AS salary,
        hire_date, cast(len(skill_list) AS integer) AS n_skills, coalesce(address_city, ' ') AS city,
        coalesce(address_state, ' ') AS state, coalesce(emergency_contact_relationship, ' ') AS relationship
        FROM typed WHERE parse_error IS NULL""",
    "lineage_columns": f"SELECT o_orderkey, '{RUN}' AS execution_id, true AS valid_id, true AS stamped FROM orders",
    "redacted_rejects": f"""{FEED_CTES} SELECT c_custkey AS record_number, employee_id,
        CASE WHEN phone_number IS NOT NULL THEN '[REDACTED]' END AS phone_number,
        CASE WHEN salary IS NOT NULL THEN '[REDACTED]' END AS salary,
        CASE WHEN emergency_contact_phone IS NOT NULL THEN '[REDACTED]' END AS contact_phone,
        emergency_contact_name AS contact_name, last_name IS NULL AS null_kept
        FROM checked WHERE error_type = 'VALIDATION_ERROR'""",
    "dead_letter_union": f"""WITH c AS (SELECT *,
          CASE WHEN o_custkey % 50 = 0 THEN 'row has 5 column(s) but the header has 6' END AS p,
          nullif(concat_ws('; ',
            CASE WHEN o_orderstatus NOT IN ('O', 'F') THEN 'o_orderstatus must be O or F' END,
            CASE WHEN length(o_orderpriority) NOT BETWEEN 5 AND 13
              THEN 'o_orderpriority must be between 5 and 13 characters (found ' || length(o_orderpriority) || ')' END
          ), '') AS v,
          coalesce(CASE WHEN length(o_orderpriority) > 8
              THEN 'value too long for column "o_orderpriority" of type character varying(8)' END,
            CASE WHEN o_orderstatus <> 'F' THEN 'value of column "o_orderstatus" violates check constraint' END) AS l
          FROM orders)
        SELECT o_orderkey AS record_number, 'orders' AS source_file, '{RUN}' AS execution_id,
          CASE WHEN p IS NOT NULL THEN 'PARSE_ERROR' WHEN v IS NOT NULL THEN 'VALIDATION_ERROR' ELSE 'LOAD_ERROR' END AS error_type,
          coalesce(p, v, l) AS error_message, CASE WHEN p IS NULL THEN o_orderkey END AS o_orderkey,
          CASE WHEN p IS NULL THEN '[REDACTED]' END AS shown_price
        FROM c WHERE coalesce(p, v, l) IS NOT NULL""",
    "error_lines": f"""{FEED_CTES} SELECT c_custkey AS record_number,
        'record_number=' || c_custkey || '|error_type=' || error_type || '|error_message=' || error_message || '   ' ||
        c_custkey || '|employee_id=' || CASE WHEN parse_error IS NULL THEN coalesce(employee_id, '') ELSE '' END ||
        '|source_file=customer|execution_id=' AS line FROM checked WHERE error_type IS NOT NULL""",
    "load_constraints": """WITH m AS (SELECT p_partkey, coalesce(
          CASE WHEN length(p_name) > 10 THEN 'value too long for column "p_name" of type character varying(10)' END,
          CASE WHEN p_brand IS NULL THEN 'null value in column "p_brand" violates not-null constraint' END,
          CASE WHEN p_type NOT IN ('ECONOMY', 'STANDARD', 'PROMO') THEN 'value of column "p_type" violates check constraint' END,
          CASE WHEN length(p_brand) > 7 THEN 'value too long for column "p_brand" of type character varying(7)' END) AS message
          FROM part)
        SELECT p_partkey, CASE WHEN message IS NOT NULL THEN 'LOAD_ERROR' END AS error_type, message FROM m""",
    "sqlstate_classes": """SELECT event_type, event_id % 5 < 2 AS row_level, count(*) AS n FROM events
        GROUP BY event_type, event_id % 5 < 2""",
    "json_extract": """SELECT event_id, json_extract_string(props, '$.k') AS k_text,
        cast(json_extract_string(props, '$.k') AS bigint) AS k FROM events""",
}
