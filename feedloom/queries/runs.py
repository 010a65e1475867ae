"""Merging, counting, run states and the whole job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.operators.ledger import Ledger, current_runs, fail_unfinished, run_gate, run_status
from feedloom.operators.lookup import decrypted_view
from feedloom.operators.merge import TargetTable, latest_per_key, upsert
from feedloom.operators.reconcile import check_count, check_count_per
from feedloom.operators.route import good, write_error_table
from feedloom.plans.employee import EMPLOYEE
from feedloom.plans.ingest import (
    ERROR_SCHEMA, RecordCountMismatch, Warehouse, errors, files, ingest, new_execution_id, status, target_schema,
)
from feedloom.queries.raw_feed import (
    COLUMNS, FEED_CTES, RAW_FEED, checked_feed, numbered_batches, raw_columns, raw_feed, sql_on, table,
)
from feedloom.queries.secrets import KEY
from feedloom.session import new_path, stage
from feedloom.sources.files import list_files


MANIFEST_ROWS = 1000  # consecutive keys per file of a feed with a manifest
_ID = "cast(conv(substr(employee_id, 2), 36, 10) AS bigint)"


def _order_changes(orders: DataFrame) -> DataFrame:
    """Changes to orders, some keys more than once, and the orders that the base lacks."""
    changed = orders.where("o_orderkey % 3 = 0 OR o_orderkey % 10 >= 7").selectExpr(
        "o_orderkey", "'X' AS o_orderstatus", "o_totalprice + 1 AS o_totalprice", "'a' AS source_file", "o_orderkey AS record_number"
    )
    again = orders.where("o_orderkey % 9 = 0").selectExpr(
        "o_orderkey", "'Y' AS o_orderstatus", "o_totalprice + 2 AS o_totalprice", "'b' AS source_file", "1L AS record_number"
    )
    return changed.unionByName(again)


def upsert_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replace by key what is there, add what is not; the last of repeated keys wins."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    base = orders.where("o_orderkey % 10 < 7")
    return upsert(base, _order_changes(orders), "o_orderkey", ["source_file", "record_number"])


def upsert_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through a stored table, merged twice: a re-run changes nothing."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    target = TargetTable(spark, new_path(spark, "orders"), orders.schema, "o_orderkey")
    target.publish(orders.where("o_orderkey % 10 < 7"))
    for _ in range(2):
        target.merge(_order_changes(orders), ["source_file", "record_number"])
    return target.read()


def lookup_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a stored table by their keys: many at once, one alone, and one that is not there."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    stored = TargetTable(spark, new_path(spark, "orders"), orders.schema, "o_orderkey")
    stored.publish(orders)
    asked = table(spark, sf_dir, "lineitem").where("l_quantity > 25").selectExpr("l_orderkey AS o_orderkey")
    many = stored.find_all(asked).withColumn("asked", F.lit("many"))
    last = orders.agg(F.max("o_orderkey")).first()[0] or 0
    alone = stored.find(last).union(stored.find(last + 1)).withColumn("asked", F.lit("alone"))
    return many.unionByName(alone)


def latest_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last event of every user, whatever the number of events a user has."""
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type", "value")
    return latest_per_key(events, "user_id", ["ts", "event_id"]).select("user_id", "event_id", "event_type", "value")


def count_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loaded rows, repeated keys included, against a wrong and a right number."""
    loaded = table(spark, sf_dir, "lineitem").select("l_orderkey")
    expected = [table(spark, sf_dir, name).count() for name in ("orders", "lineitem")]
    checks = [check_count(loaded, n).select("expected", "actual", "matched", "status", "failure_message") for n in expected]
    return checks[0].union(checks[1])


def count_check_per_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every source of a manifest against its own expected number; one source is missing, one is off."""
    manifest = sql_on(
        spark,
        sf_dir,
        "SELECT o_orderpriority AS source_file, count(*) + if(o_orderpriority = '2-HIGH', 1, 0) AS expected"
        " FROM orders GROUP BY o_orderpriority UNION ALL SELECT 'absent', 0 UNION ALL SELECT 'lost', 7",
        "orders",
    )
    loaded = table(spark, sf_dir, "orders").selectExpr("o_orderpriority AS source_file")
    return check_count_per(loaded, manifest, "source_file").select(
        "source_file", "expected", "actual", "matched", "status", "failure_message"
    )


_EVENTS = """
SELECT cast(user_id AS varchar(20)) AS execution_id, 'feed-' || cast(user_id % 10 AS varchar(20)) AS source_file,
  CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'purchase' THEN 'SUCCESS' WHEN 'click' THEN 'RUNNING'
    ELSE 'STARTED' END AS status,
  event_id AS expected_record_count,
  CASE WHEN event_type = 'purchase' THEN event_id END AS actual_loaded_record_count,
  ts AS started_at, ts AS completed_at,
  CASE WHEN event_type = 'error' THEN 'reason ' || cast(event_id AS varchar(20)) END AS failure_reason,
  event_id AS sequence
FROM events
"""
# Rejected records: one per order of a customer, keyed like the runs.
_ERRORS = "SELECT cast(o_custkey AS varchar(20)) AS execution_id, o_orderkey AS record_number FROM orders"
_STATUS_COLUMNS = [
    "execution_id", "source_file", "status", "expected_record_count", "actual_loaded_record_count", "failure_reason",
    "error_count",
]


def _ledger(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return sql_on(spark, sf_dir, _EVENTS, "events"), sql_on(spark, sf_dir, _ERRORS, "orders")


def run_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State and number of rejects of every run."""
    return run_status(*_ledger(spark, sf_dir)).select(*_STATUS_COLUMNS)


def runs_marked_failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crashed runs become FAILED unless they had already ended, and a late FAILED changes no ended run."""
    events, _ = _ledger(spark, sf_dir)
    late = sql_on(spark, sf_dir, _EVENTS, "events").selectExpr(
        "* EXCEPT (status, failure_reason, sequence)", "'FAILED' AS status", "'late' AS failure_reason", "sequence + 1000000000000 AS sequence"
    ).where("actual_loaded_record_count IS NOT NULL")
    events = events.unionByName(late)
    requests = table(spark, sf_dir, "customer").where("c_custkey % 2 = 0").selectExpr(
        "cast(c_custkey AS string) AS execution_id", "'worker lost' AS failure_reason",
        "current_timestamp() AS completed_at", "9000000000000000000 AS sequence",
    )
    changed = fail_unfinished(current_runs(events), requests.withColumn("completed_at", F.expr("cast(completed_at AS timestamp_ntz)")))
    return current_runs(events.unionByName(changed)).select("execution_id", "status", "expected_record_count", "failure_reason")


def ledger_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ledger of many files, compacted with events appended before and after: one event a run and all states kept."""
    events, _ = _ledger(spark, sf_dir)
    ledger = Ledger(spark, new_path(spark, "ledger"))
    events = events.withColumns({name: F.col(name).cast("timestamp") for name in ("started_at", "completed_at")})
    early = F.col("sequence") % 2 == 0
    events.where(early).repartition(16).write.mode("append").parquet(ledger.path)
    ledger.compact()
    events.where(~early).repartition(16).write.mode("append").parquet(ledger.path)
    ledger.compact()
    states = ledger.events()  # one a run
    return states.select("execution_id", "source_file", "status", "expected_record_count", "actual_loaded_record_count", "failure_reason")


def errors_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failures of many runs, written twice: the error table holds them once, under the same ids."""
    failures = table(spark, sf_dir, "orders").selectExpr(
        "concat('run-', o_orderkey % 5) AS execution_id", "'f.csv' AS source_file", "o_orderkey AS record_number",
        "'PARSE_ERROR' AS error_type", "concat('bad ', o_orderpriority) AS error_message", "cast(NULL AS string) AS raw_record",
    )
    path = new_path(spark, "errors")
    write_error_table(failures, path)
    first = stage(spark.read.schema(ERROR_SCHEMA).parquet(path).select("id"), "first-ids")
    write_error_table(failures, path)
    again = spark.read.schema(ERROR_SCHEMA).parquet(path)
    known = again.join(first.groupBy("id").agg(F.count("*").alias("n_first")), "id")
    return known.select("execution_id", "source_file", "record_number", "error_type", "error_message", "n_first")


def run_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What follows for every requested run: pass, warn or fail; unknown runs fail."""
    requested = table(spark, sf_dir, "customer").selectExpr("cast(c_custkey AS string) AS execution_id")
    return run_gate(run_status(*_ledger(spark, sf_dir)), requested)


def ingest_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job over many files, each against its own count of a manifest; some counts are off."""
    rows = raw_feed(spark, sf_dir).selectExpr(
        f"c_custkey DIV {MANIFEST_ROWS} AS batch", "c_custkey AS place", f"to_csv(struct({', '.join(COLUMNS)}), map('escape', '\"')) AS line"
    )
    source = numbered_batches(rows, new_path(spark, "manifest-feed"), ",".join(COLUMNS))
    batch = r"cast(regexp_extract(path, r'batch=(\d+)', 1) AS bigint) AS batch"
    found = list_files(spark, f"{source}/*/part-*").selectExpr(batch, "path AS source_file")
    counts = good(checked_feed(spark, sf_dir)).groupBy(F.expr(f"{_ID} DIV {MANIFEST_ROWS}").alias("batch")).agg(F.count("*").alias("n"))
    manifest = found.join(counts, "batch", "left").selectExpr("source_file", "coalesce(n, 0) + if(batch % 3 = 2, 1, 0) AS expected")
    manifest = stage(manifest, "manifest")
    control = new_path(spark, "control")
    counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).selectExpr("concat('record_count=', n) AS line").coalesce(1).write.text(control)
    control = list_files(spark, f"{control}/part-*").where("size > 0").first()["path"]
    house, run = Warehouse(new_path(spark, "house")), new_execution_id()
    try:
        ingest(spark, EMPLOYEE, source, "csv", control, house, KEY, run, manifest=manifest, numbered=True)
    except RecordCountMismatch:
        pass  # stored as the run's status
    checked = files(spark, house).where(F.col("execution_id") == run)
    checked = checked.selectExpr(batch.replace("path", "source_file"), "expected", "actual", "matched", "problem")
    return checked.withColumn("status", F.lit(status(spark, house, run).first()["status"]))


def _run_job(spark: SparkSession, sf_dir: str, counted: DataFrame | None = None) -> tuple[Warehouse, str]:
    """Write the feed and its control file, and load it; bad records make the count differ.

    The control file counts the rows of ``counted`` where given.
    """
    feed = raw_columns(spark, sf_dir)
    source, control = new_path(spark, "feed"), new_path(spark, "control")
    feed.write.options(header=True, escape='"').csv(source)
    counts = (feed if counted is None else counted).agg(F.count("*").alias("n"))
    counts.selectExpr("concat('record_count=', n) AS line").write.text(control)
    control = list_files(spark, f"{control}/part-*").where("size > 0").first()["path"]
    house, run = Warehouse(new_path(spark, "house")), new_execution_id()
    try:
        ingest(spark, EMPLOYEE, source, "csv", control, house, KEY, run)
    except RecordCountMismatch:
        pass  # stored as the run's status
    return house, run


def ingest_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job, then the run's status beside its rejects by kind."""
    house, run = _run_job(spark, sf_dir)
    kinds = errors(spark, house).groupBy("execution_id").agg(
        F.count_if(F.col("error_type") == "PARSE_ERROR").alias("parse_errors"),
        F.count_if(F.col("error_type") == "VALIDATION_ERROR").alias("validation_errors"),
        F.count_if(F.expr("contains(raw_record, '\"phone_number\":\"[REDACTED]\"')")).alias("redacted"),
    )
    return status(spark, house, run).join(kinds, "execution_id").select(
        "status", "expected_record_count", "actual_loaded_record_count", "error_count", "failure_reason", "parse_errors",
        "validation_errors", "redacted",
    )


def ingest_success(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job with a control file that counts the good records: what was loaded, and that it passed with rejects."""
    house, run = _run_job(spark, sf_dir, good(checked_feed(spark, sf_dir)))
    return run_gate(status(spark, house, run)).select("verdict", "reason", "expected", "loaded", "error_records")


def ingest_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job, then the target table with its fields in clear."""
    house, _ = _run_job(spark, sf_dir)
    stored = TargetTable(spark, house.table, target_schema(EMPLOYEE), EMPLOYEE.key).read()
    return decrypted_view(stored, EMPLOYEE, KEY).selectExpr(
        "employee_id", "first_name", "last_name", "email", "phone_number", "salary", "is_active",
        "array_join(skills, '|') AS skills", "address.street AS street", "emergency_contact.phone AS contact_phone",
    )


QUERIES = {
    "upsert_orders": upsert_orders,
    "upsert_published": upsert_published,
    "lookup_by_key": lookup_by_key,
    "latest_per_user": latest_per_user,
    "count_check": count_check,
    "count_check_per_file": count_check_per_file,
    "run_states": run_states,
    "runs_marked_failed": runs_marked_failed,
    "run_verdicts": run_verdicts,
    "ledger_compacted": ledger_compacted,
    "errors_repeated": errors_repeated,
    "ingest_status": ingest_status,
    "ingest_success": ingest_success,
    "ingest_target": ingest_target,
    "ingest_manifest": ingest_manifest,
}

_UPSERT = """WITH incoming AS (SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN 'Y' ELSE 'X' END AS s,
      o_totalprice + CASE WHEN o_orderkey % 9 = 0 THEN 2 ELSE 1 END AS p
      FROM orders WHERE o_orderkey % 3 = 0 OR o_orderkey % 10 >= 7),
    base AS (SELECT * FROM orders WHERE o_orderkey % 10 < 7)
    SELECT coalesce(i.o_orderkey, b.o_orderkey) AS o_orderkey, coalesce(i.s, b.o_orderstatus) AS o_orderstatus,
      coalesce(i.p, b.o_totalprice) AS o_totalprice
    FROM base b FULL OUTER JOIN incoming i ON b.o_orderkey = i.o_orderkey"""
_RUN_CTES = f"""WITH ledger AS ({_EVENTS}), rejects AS ({_ERRORS}),
    latest AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY execution_id
      ORDER BY status IN ('SUCCESS', 'FAILED') DESC, CASE WHEN status IN ('SUCCESS', 'FAILED') THEN -sequence ELSE sequence END DESC)
      AS rn FROM ledger) WHERE rn = 1),
    states AS (SELECT l.*, (SELECT count(*) FROM rejects r WHERE r.execution_id = l.execution_id) AS error_count FROM latest l)"""

ORACLE = {
    "upsert_orders": _UPSERT,
    "upsert_published": _UPSERT,
    "latest_per_user": """SELECT user_id, event_id, event_type, value FROM (SELECT *,
        row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""",
    "lookup_by_key": """SELECT o_orderkey, o_orderstatus, o_totalprice, 'many' AS asked FROM orders
        WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 25)
        UNION ALL SELECT o_orderkey, o_orderstatus, o_totalprice, 'alone' FROM orders
        WHERE o_orderkey = (SELECT max(o_orderkey) FROM orders)""",
    "count_check": """WITH n AS (SELECT count(*) AS actual FROM lineitem),
        e AS (SELECT count(*) AS expected FROM orders UNION ALL SELECT count(*) FROM lineitem)
        SELECT expected, actual, actual = expected AS matched,
          CASE WHEN actual = expected THEN 'SUCCESS' ELSE 'FAILED' END AS status,
          CASE WHEN actual <> expected THEN 'Record count mismatch: control file expected ' || expected ||
            ' record(s) but ' || actual || ' record(s) were loaded' END AS failure_message FROM n, e""",
    "count_check_per_file": """WITH m AS (SELECT o_orderpriority AS source_file, count(*) AS actual,
          count(*) + CASE WHEN o_orderpriority = '2-HIGH' THEN 1 ELSE 0 END AS expected FROM orders GROUP BY o_orderpriority
          UNION ALL SELECT 'absent', 0, 0 UNION ALL SELECT 'lost', 0, 7)
        SELECT source_file, expected, actual, expected = actual AS matched,
          CASE WHEN expected = actual THEN 'SUCCESS' ELSE 'FAILED' END AS status,
          CASE WHEN expected <> actual THEN 'Record count mismatch: control file expected ' || expected ||
            ' record(s) but ' || actual || ' record(s) were loaded' END AS failure_message FROM m""",
    "run_states": f"{_RUN_CTES} SELECT {', '.join(_STATUS_COLUMNS)} FROM states",
    "runs_marked_failed": f"""{_RUN_CTES}, hit AS (SELECT l.*, l.status IN ('STARTED', 'RUNNING')
          AND try_cast(execution_id AS bigint) % 2 = 0
          AND try_cast(execution_id AS bigint) IN (SELECT c_custkey FROM customer) AS crashed FROM latest l)
        SELECT execution_id, CASE WHEN crashed THEN 'FAILED' ELSE status END AS status, expected_record_count,
          CASE WHEN crashed THEN 'worker lost' ELSE failure_reason END AS failure_reason FROM hit""",
    "run_verdicts": f"""{_RUN_CTES}, asked AS (SELECT cast(c_custkey AS varchar) AS execution_id FROM customer)
        SELECT a.execution_id,
          CASE WHEN s.status IS NULL OR s.status <> 'SUCCESS' THEN 'FAIL' WHEN error_count > 0 THEN 'WARN' ELSE 'PASS' END AS verdict,
          CASE WHEN s.status IS NULL THEN 'No ingestion_execution row found for this run'
            WHEN s.status <> 'SUCCESS' THEN 'Ingestion ended with status ' || s.status || ': ' || coalesce(failure_reason, 'None')
            WHEN error_count > 0 THEN error_count || ' record(s) were rejected' END AS reason,
          CASE WHEN s.status = 'SUCCESS' THEN expected_record_count END AS expected,
          CASE WHEN s.status = 'SUCCESS' THEN actual_loaded_record_count END AS loaded,
          CASE WHEN s.status = 'SUCCESS' THEN error_count END AS error_records
        FROM asked a LEFT JOIN states s ON a.execution_id = s.execution_id""",
    "ledger_compacted": f"""{_RUN_CTES} SELECT execution_id, source_file, status, expected_record_count,
        actual_loaded_record_count, failure_reason FROM latest""",
    "errors_repeated": """SELECT 'run-' || (o_orderkey % 5) AS execution_id, 'f.csv' AS source_file, o_orderkey AS record_number,
        'PARSE_ERROR' AS error_type, 'bad ' || o_orderpriority AS error_message, cast(1 AS bigint) AS n_first FROM orders""",
    "ingest_manifest": f"""{FEED_CTES}, counts AS (SELECT c_custkey // {MANIFEST_ROWS} AS batch,
          count(*) FILTER (WHERE error_type IS NULL) AS actual FROM checked GROUP BY ALL),
        compared AS (SELECT batch, actual + CASE WHEN batch % 3 = 2 THEN 1 ELSE 0 END AS expected, actual FROM counts)
        SELECT batch, expected, actual, expected = actual AS matched,
          CASE WHEN expected <> actual THEN 'Record count mismatch: control file expected ' || expected || ' record(s) but ' ||
            actual || ' record(s) were loaded' END AS problem,
          CASE WHEN (SELECT bool_and(expected = actual) FROM compared) THEN 'SUCCESS' ELSE 'FAILED' END AS status
        FROM compared""",
    "ingest_status": f"""{FEED_CTES}, n AS (SELECT count(*) AS e, count(*) FILTER (WHERE error_type IS NULL) AS a,
          count(*) FILTER (WHERE error_type = 'PARSE_ERROR') AS p, count(*) FILTER (WHERE error_type = 'VALIDATION_ERROR') AS v,
          count(*) FILTER (WHERE error_type = 'VALIDATION_ERROR' AND phone_number IS NOT NULL) AS r FROM checked)
        SELECT 'FAILED' AS status, e AS expected_record_count, a AS actual_loaded_record_count, p + v AS error_count,
          'Record count mismatch: control file expected ' || e || ' record(s) but ' || a || ' record(s) were loaded'
            AS failure_reason, p AS parse_errors, v AS validation_errors, r AS redacted FROM n""",
    "ingest_success": f"""{FEED_CTES}, n AS (SELECT count(*) FILTER (WHERE error_type IS NULL) AS a,
          count(*) FILTER (WHERE error_type IS NOT NULL) AS e FROM checked)
        SELECT CASE WHEN e > 0 THEN 'WARN' ELSE 'PASS' END AS verdict,
          CASE WHEN e > 0 THEN e || ' record(s) were rejected' END AS reason, a AS expected, a AS loaded, e AS error_records
        FROM n""",
    "ingest_target": f"""{FEED_CTES} SELECT employee_id, first_name, coalesce(last_name, ' ') AS last_name, email,
        phone_number, try_cast(salary AS bigint) AS salary, lower(is_active) = 'true' AS is_active,
        array_to_string(skill_list, '|') AS skills, address_street AS street, emergency_contact_phone AS contact_phone
        FROM checked WHERE error_type IS NULL""",
}
