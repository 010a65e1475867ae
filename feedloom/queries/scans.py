"""Reading feeds: CSV and JSON written from the tables, then read back."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedloom.functions.records import value_json
from feedloom.functions.text import name, part_count
from feedloom.operators.convert import convert_json
from feedloom.operators.rewrite import split_feed, write_csv_parts
from feedloom.plans.employee import EMPLOYEE
from feedloom.queries.raw_feed import (
    COLUMNS, FEED_CTES, RAW_FEED, by_batch, numbered_batches, raw_columns, raw_feed, sql_on, table,
)
from feedloom.schema import LONG, STRUCT, Field
from feedloom.session import new_path, stage
from feedloom.sources.control import with_count
from feedloom.sources.csv_feed import open_csv, read_csv, scanned
from feedloom.sources.files import check_files, inside, list_files, needs_split, normalized, plain_path
from feedloom.sources.json_feed import read_json
from feedloom.sources.reader import read_feed

BATCH = 100_000  # consecutive keys per file
_BATCH_OF = r"cast(regexp_extract(source_file, r'batch=(\d+)', 1) AS bigint) AS batch"
_TRIMMED = ", ".join(f"nullif(trim({c}), '') AS {c}" for c in COLUMNS)


def _write_csv(df: DataFrame, name_: str) -> str:
    path = new_path(df.sparkSession, name_)
    df.write.options(header=True, escape='"').csv(path)
    return path


def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers, quoted commas, doubled quotes, trimming, blank to NULL, many files."""
    path = _write_csv(raw_columns(spark, sf_dir), "csv-scan")
    return read_csv(spark, path, COLUMNS).select(*COLUMNS)


def csv_reordered_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of one feed with different column orders; one lacks columns, one has an extra one."""
    feed = raw_feed(spark, sf_dir)
    wanted = ["employee_id", "email", "department", "currency"]
    first = _write_csv(feed.where("c_custkey % 2 = 0").select("currency", "employee_id", "email"), "csv-order")
    second = _write_csv(
        feed.where("c_custkey % 2 = 1").select("department", "email", "job_title", "currency", "employee_id"), "csv-order"
    )
    return read_csv(spark, [first, second], wanted).select(*wanted)


def csv_ragged_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with a cell too few or too many, numbered like the good ones."""
    lines = table(spark, sf_dir, "customer").selectExpr(
        f"c_custkey DIV {BATCH} AS batch",
        "c_custkey AS place",
        "CASE c_custkey % 10 WHEN 3 THEN concat(c_custkey, ',', c_name)"
        " WHEN 7 THEN concat(c_custkey, ',\"a, \"\"b\"\"\",', c_mktsegment, ',', c_nationkey, ',more')"
        " ELSE concat(c_custkey, ',\"', c_name, ', esq\",', c_mktsegment, ',', c_nationkey) END AS line",
    )
    path = numbered_batches(lines, new_path(spark, "csv-ragged"), "key,name,segment,nation")
    rows = read_csv(spark, path, ["key", "name", "segment", "nation"])
    return rows.selectExpr(_BATCH_OF, "record_number", "parse_error", "key", "name", "segment", "nation")


def csv_multi_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents with line breaks and quotes inside CSV cells, read by many tasks."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "text", "source")
    path = new_path(spark, "csv-documents")
    documents.write.options(header=True, escape='"', quoteAll=True).csv(path)
    rows = read_csv(spark, path, ["doc_id", "text", "source", "lang"])
    return rows.selectExpr(
        "cast(doc_id AS bigint) AS doc_id", "md5(text) AS text_md5", "cast(length(text) AS bigint) AS n", "source", "lang"
    )


def _json_record() -> str:
    """The feed row as the JSON object it stands for."""
    members = []
    for f in EMPLOYEE.fields:
        if f.kind == "struct":
            inner = ", ".join(f"'{c}', {f.name}_{c}" for c in f.children)
            members.append(f"'{f.name}', named_struct({inner})")
        elif f.kind == "list":
            members.append(f"'{f.name}', if({f.name} IS NULL, NULL, split(trim({f.name}), ';'))")
        else:
            members.append(f"'{f.name}', {name(f.name)}")
    return "named_struct('unknown', c_custkey, " + ", ".join(members) + ")"


_FLAT = [
    "employee_id", "first_name", "salary", "is_active", "array_join(skills, '|') AS skills",
    "address.street AS street", "address.city AS city", "emergency_contact.phone AS contact_phone",
]


def json_lines_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One object per line, unknown members ignored, nested members restored."""
    path = new_path(spark, "json-lines")
    raw_feed(spark, sf_dir).selectExpr(f"{value_json(_json_record())} AS line").write.text(path)
    return read_feed(spark, path, EMPLOYEE, "json").selectExpr("parse_error", *_FLAT)


def json_array_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pretty-printed arrays, one per file, cut into elements in parallel."""
    pretty = _json_record()
    feed = raw_feed(spark, sf_dir)
    elements = feed.selectExpr(
        f"c_custkey DIV {BATCH} AS batch",
        "c_custkey AS place",
        f"concat(if(c_custkey % {BATCH} = 0, '[', ','),"
        f" to_json({pretty}, map('pretty', 'true', 'ignoreNullFields', 'false'))) AS line",
    )
    closing = feed.selectExpr(f"c_custkey DIV {BATCH} AS batch").distinct().selectExpr(
        "batch", "9223372036854775807 AS place", "']' AS line"
    )
    path = numbered_batches(elements.unionByName(closing), new_path(spark, "json-array"))
    rows = read_feed(spark, path, EMPLOYEE, "JSON")
    return rows.selectExpr(_BATCH_OF, "record_number", "parse_error", *_FLAT)


def json_type_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A wrongly typed member rejects its own record only."""
    feed = raw_feed(spark, sf_dir)
    line = (
        "concat('{\"employee_id\": ', CASE c_custkey % 9 WHEN 1 THEN concat('{\"x\": ', c_custkey, '}')"
        " WHEN 2 THEN concat('\"{', c_custkey, '}\"') ELSE concat('\"', c_custkey, '\"') END,"
        " ', \"salary\": ', CASE c_custkey % 9 WHEN 3 THEN '\"plenty\"' WHEN 4 THEN concat('\"', c_custkey, '\"')"
        " ELSE cast(c_custkey AS string) END,"
        " ', \"is_active\": ', CASE c_custkey % 9 WHEN 5 THEN '\"maybe\"' ELSE 'true' END,"
        " ', \"skills\": ', CASE c_custkey % 9 WHEN 6 THEN '[\"a\", null]' WHEN 7 THEN '[\"a\", {\"b\": 1}]'"
        " ELSE '[\"{a\", \"b\"]' END,"
        " ', \"address\": ', CASE c_custkey % 9 WHEN 8 THEN '\"{}\"' ELSE '{\"city\": \"{c}\"}' END, '}')"
    )
    path = new_path(spark, "json-types")
    feed.selectExpr(f"{line} AS line").write.text(path)
    rows = convert_json(read_json(spark, path, EMPLOYEE.fields), EMPLOYEE)
    return rows.groupBy("parse_error").agg(
        F.count("*").alias("n"),
        F.sum("salary").alias("salaries"),
        F.count_if(F.expr("array_join(skills, '|') = '{a|b' AND address.city = '{c}'")).alias("kept"),
        F.count_if(F.expr("employee_id LIKE '{%'")).alias("braced"),
    )


def json_broken_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text behind an object and single quotes are error rows; objects on one line are records of their own."""
    lines = table(spark, sf_dir, "events").selectExpr(
        "CASE event_id % 4 WHEN 0 THEN concat('{\"id\": \"', event_id, '\"}')"
        " WHEN 1 THEN concat('{\"id\": \"', event_id, '\"} junk {\"id\": \"9\"}')"
        r" WHEN 2 THEN concat('{\'id\': \'', event_id, '\'}')"
        " ELSE concat('{\"id\": \"', event_id, '\"}{\"id\": \"x', event_id, '\"}') END AS line"
    )
    path = new_path(spark, "json-broken")
    lines.write.text(path)
    return read_json(spark, path, ["id"], on_broken="dead_letter").select("parse_error", "id")


def record_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers 1, 2, 3... in every file of a feed whose files are read in some twenty blocks each."""
    lines = table(spark, sf_dir, "orders").selectExpr(
        f"o_orderkey DIV {BATCH} AS batch",
        "o_orderkey AS place",
        "concat(o_orderkey, ',', o_orderstatus, ',', o_orderpriority) AS line",
    )
    path = numbered_batches(lines, new_path(spark, "csv-numbers"), "o_orderkey,o_orderstatus,o_orderpriority")
    with _in_blocks(spark, path):
        rows = read_csv(spark, path, ["o_orderkey", "o_orderstatus"])
        rows = rows.selectExpr(_BATCH_OF, "record_number", "cast(o_orderkey AS bigint) AS o_orderkey", "o_orderstatus")
        return stage(rows, "record-numbers")  # read while the setting holds


@contextmanager
def _in_blocks(spark: SparkSession, path: str) -> Iterator[None]:
    """Read each file of a folder of batches in some twenty blocks."""
    largest = list_files(spark, f"{path}/*/part-*").agg(F.max("size")).first()[0] or 0
    setting = "spark.sql.files.maxPartitionBytes"
    usual = spark.conf.get(setting)
    spark.conf.set(setting, str(max(64, min(128 << 20, largest // 20))))
    try:
        yield
    finally:
        spark.conf.set(setting, usual)


def json_one_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrays that are one line each, read in some twenty blocks; brackets and quotes stand in strings too."""
    orders = by_batch(table(spark, sf_dir, "orders").withColumn("batch", F.expr(f"o_orderkey DIV {BATCH}")))
    elements = orders.selectExpr(
        "batch",
        "o_orderkey AS place",
        "row_number() OVER (PARTITION BY batch ORDER BY o_orderkey) AS n",
        "to_json(named_struct('key', o_orderkey, 'note', concat('}, {\"', o_orderstatus, '\\\\\": ]'),"
        " 'parts', named_struct('priority', o_orderpriority, 'customer', o_custkey))) AS object",
    )
    lines = elements.selectExpr("batch", "place", "concat(if(n = 1, '[', ','), object) AS line")
    closing = elements.groupBy("batch").agg(F.max("place").alias("place")).selectExpr("batch", "place + 1 AS place", "']' AS line")
    path = numbered_batches(lines.unionByName(closing), new_path(spark, "json-line"), line_end=" ")
    with _in_blocks(spark, path):
        rows = read_json(spark, path, [Field("key", LONG), "note", Field("parts", STRUCT, children=("priority", "customer"))])
        rows = rows.selectExpr(
            _BATCH_OF, "record_number", "cast(key AS bigint) AS o_orderkey", "note", "parts.priority", "parts.customer"
        )
        return stage(rows, "one-line")  # read while the setting holds


def split_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A CSV feed rewritten into balanced files and read back, cells as they are, padded ones too."""
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_custkey", "o_orderstatus", "concat('  ', o_orderpriority, ', \"', o_orderstatus, '\" ') AS note"
    )
    source, out = new_path(spark, "split-in"), new_path(spark, "split-out")
    write_csv_parts(orders, source, 4)
    split_feed(spark, source, "CSV", out, 10_000)
    rows = scanned(open_csv(spark, out), ["o_orderkey", "o_custkey", "o_orderstatus", "note"], clean=False)
    return rows.selectExpr(
        "cast(o_orderkey AS bigint) AS o_orderkey", "cast(o_custkey AS bigint) AS o_custkey", "o_orderstatus", "note"
    )


SPLIT_RECORDS = 700


def split_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed of several files cut anew: each record's file and place there follow from its place in the feed."""
    lines = table(spark, sf_dir, "orders").selectExpr(
        f"o_orderkey DIV {BATCH} AS batch", "o_orderkey AS place", "concat(o_orderkey, ',', o_orderstatus) AS line"
    )
    source, out = numbered_batches(lines, new_path(spark, "order-in"), "o_orderkey,o_orderstatus"), new_path(spark, "order-out")
    split_feed(spark, f"{source}/*/part-*", "CSV", out, SPLIT_RECORDS)
    rows = read_csv(spark, out, ["o_orderkey", "o_orderstatus"])
    in_order = Window.orderBy(F.regexp_extract("source_file", r"part-(\d+)", 1), F.regexp_extract("source_file", r"-c(\d+)", 1))
    files = rows.select("source_file").distinct().select("source_file", F.row_number().over(in_order).cast("long").alias("file"))
    return rows.join(files, "source_file").selectExpr(
        "file", "record_number AS place", "cast(o_orderkey AS bigint) AS o_orderkey", "o_orderstatus"
    )


def split_rewrite_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A JSON feed rewritten as one object per line: number of files, records and their content."""
    source, out = new_path(spark, "split-in"), new_path(spark, "split-out")
    table(spark, sf_dir, "events").selectExpr(
        "to_json(named_struct('event_id', event_id, 'event_type', event_type, 'none', cast(NULL AS string), 'props', props),"
        " map('ignoreNullFields', 'false')) AS line"
    ).write.text(source)
    split_feed(spark, source, "JSON", out, 2_000)
    rows = read_json(spark, out, ["event_id", "event_type", "none", "props"])
    return rows.agg(
        F.countDistinct("source_file").alias("files"),
        F.count("*").alias("records"),
        F.sum(F.expr("cast(event_id AS bigint)")).alias("ids"),
        F.countDistinct("event_type").alias("types"),
        F.count("none").alias("nones"),
        F.sum(F.expr("cast(get_json_object(props, '$.k') AS bigint)")).alias("k"),
    )


def split_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which sources are split and into how many files, from their counts."""
    counts = sql_on(
        spark,
        sf_dir,
        "SELECT o_orderpriority AS source, count(*) AS records FROM orders GROUP BY o_orderpriority"
        " UNION ALL SELECT 'nation', count(*) FROM nation UNION ALL SELECT 'lineitem', count(*) FROM lineitem",
        "orders",
        "nation",
        "lineitem",
    )
    return counts.select(
        "source",
        "records",
        needs_split(F.col("records"), 1000).alias("split"),
        F.expr(part_count("records", "1000")).alias("files"),
    )


def control_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Control files of many feeds, some faulty: the expected count or what is wrong."""
    contents = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS batch",
        "0L AS place",
        "CASE c_custkey % 8 WHEN 0 THEN concat('record_count=', c_custkey)"
        " WHEN 1 THEN concat('# made by hand\\n  record_count =  ', c_custkey, '  \\n')"
        " WHEN 2 THEN concat('record_count: ', c_custkey, '\\nrecord_count=', c_custkey + 1)"
        " WHEN 3 THEN concat('other=1\\n#record_count=', c_custkey)"
        " WHEN 4 THEN 'record_count=ten' WHEN 5 THEN concat('record_count=-', c_custkey)"
        " WHEN 6 THEN 'record_count=' ELSE 'record_count=1.5' END AS content",
    )
    return with_count(contents, "content").selectExpr("batch AS feed", "expected", "problem")


def manifest_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requested files against a listing: present, right ending, not empty, inside the root."""
    suppliers = table(spark, sf_dir, "supplier")
    listing = suppliers.where("s_suppkey % 5 <> 0").selectExpr(
        "concat('/feeds/s', s_suppkey, if(s_suppkey % 3 = 0, '.json', '.CSV')) AS path",
        "if(s_suppkey % 7 = 0, 0L, 10L * s_suppkey) AS size",
    )
    requests = suppliers.select(
        "s_suppkey",
        normalized(
            F.expr(
                "concat(CASE s_suppkey % 4 WHEN 0 THEN 's' WHEN 1 THEN '/feeds/./s' WHEN 2 THEN 'x/../s'"
                " ELSE if(s_suppkey % 11 = 0, '../s', '/feeds/y/../s') END,"
                " s_suppkey, if(s_suppkey % 3 = 0, '.json', '.CSV'))"
            ),
            "/feeds",
        ).alias("path"),
        F.expr("CASE s_suppkey % 13 WHEN 0 THEN 'xml' WHEN 1 THEN 'json' ELSE if(s_suppkey % 3 = 0, 'Json', 'csv') END").alias(
            "file_type"
        ),
    )
    checked = check_files(requests, listing, root="/feeds")
    return checked.select("s_suppkey", plain_path(F.col("path")).alias("path"), "size", "problem")


def paths_inside_root(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a path stays inside a root once ``..`` is resolved, over all page addresses."""
    pages = table(spark, sf_dir, "pages").selectExpr(
        "page_id",
        "concat(CASE page_id % 3 WHEN 0 THEN 'in/' WHEN 1 THEN '../' ELSE '/data/root/a/../../' END,"
        " url) AS path",
    )
    return pages.select(
        "page_id", normalized(F.col("path"), "/data/root").alias("path"), inside(F.col("path"), "/data/root").alias("inside")
    )


QUERIES = {
    "csv_scan": csv_scan,
    "csv_reordered_header": csv_reordered_header,
    "csv_ragged_rows": csv_ragged_rows,
    "csv_multi_line": csv_multi_line,
    "json_lines_scan": json_lines_scan,
    "json_array_scan": json_array_scan,
    "json_one_line": json_one_line,
    "json_type_errors": json_type_errors,
    "json_broken_parts": json_broken_parts,
    "record_numbers": record_numbers,
    "split_rewrite": split_rewrite,
    "split_in_order": split_in_order,
    "split_rewrite_json": split_rewrite_json,
    "split_plan": split_plan,
    "control_counts": control_counts,
    "manifest_checks": manifest_checks,
    "paths_inside_root": paths_inside_root,
}

_JSON_VALUES = """
  CASE WHEN parse_error IS NULL THEN employee_id END AS employee_id,
  CASE WHEN parse_error IS NULL THEN first_name END AS first_name,
  CASE WHEN parse_error IS NULL THEN try_cast(salary AS bigint) END AS salary,
  CASE WHEN parse_error IS NULL THEN CASE lower(is_active) WHEN 'true' THEN true WHEN 'false' THEN false END END AS is_active,
  CASE WHEN parse_error IS NULL THEN replace(trim(skills), ';', '|') END AS skills,
  CASE WHEN parse_error IS NULL THEN address_street END AS street,
  CASE WHEN parse_error IS NULL THEN address_city END AS city,
  CASE WHEN parse_error IS NULL THEN emergency_contact_phone END AS contact_phone
"""
_JSON_CTES = f"""WITH raw_feed AS ({RAW_FEED}), parsed AS (
  SELECT * REPLACE (nullif(trim(is_active), '') AS is_active, nullif(salary, '') AS salary),
    coalesce(CASE WHEN salary <> '' AND try_cast(salary AS bigint) IS NULL THEN 'invalid value for field ''salary''' END,
             CASE WHEN is_active = 'yes' THEN 'invalid value for field ''is_active''' END) AS parse_error
  FROM raw_feed)"""

ORACLE = {
    "csv_scan": f"WITH raw_feed AS ({RAW_FEED}) SELECT {_TRIMMED} FROM raw_feed",
    "csv_reordered_header": f"""{FEED_CTES} SELECT employee_id, email,
        CASE WHEN c_custkey % 2 = 1 THEN department END AS department, currency FROM cells""",
    "csv_ragged_rows": f"""SELECT c_custkey // {BATCH} AS batch,
        row_number() OVER (PARTITION BY c_custkey // {BATCH} ORDER BY c_custkey) AS record_number,
        CASE c_custkey % 10 WHEN 3 THEN 'row has 2 column(s) but the header has 4'
          WHEN 7 THEN 'row has 5 column(s) but the header has 4' END AS parse_error,
        CASE WHEN c_custkey % 10 NOT IN (3, 7) THEN cast(c_custkey AS varchar) END AS key,
        CASE WHEN c_custkey % 10 NOT IN (3, 7) THEN c_name || ', esq' END AS name,
        CASE WHEN c_custkey % 10 NOT IN (3, 7) THEN c_mktsegment END AS segment,
        CASE WHEN c_custkey % 10 NOT IN (3, 7) THEN cast(c_nationkey AS varchar) END AS nation
        FROM customer""",
    "csv_multi_line": r"""SELECT doc_id, md5(trim(text, E' \t\n\r')) AS text_md5,
        length(trim(text, E' \t\n\r')) AS n, source, lang FROM documents""",
    "json_lines_scan": f"{_JSON_CTES} SELECT parse_error, {_JSON_VALUES} FROM parsed",
    "json_array_scan": f"""{_JSON_CTES} SELECT c_custkey // {BATCH} AS batch,
        row_number() OVER (PARTITION BY c_custkey // {BATCH} ORDER BY c_custkey) AS record_number,
        parse_error, {_JSON_VALUES} FROM parsed""",
    "json_one_line": f"""SELECT o_orderkey // {BATCH} AS batch,
        row_number() OVER (PARTITION BY o_orderkey // {BATCH} ORDER BY o_orderkey) AS record_number, o_orderkey,
        '}}, {{"' || o_orderstatus || '\\": ]' AS note, o_orderpriority AS priority, cast(o_custkey AS varchar) AS customer FROM orders""",
    "json_type_errors": """WITH kinds AS (SELECT c_custkey, CASE c_custkey % 9
          WHEN 1 THEN 'invalid value for field ''employee_id''' WHEN 3 THEN 'invalid value for field ''salary'''
          WHEN 5 THEN 'invalid value for field ''is_active''' WHEN 6 THEN 'invalid value for field ''skills'''
          WHEN 7 THEN 'invalid value for field ''skills.[1]''' WHEN 8 THEN 'invalid value for field ''address'''
          END AS parse_error FROM customer)
        SELECT parse_error, count(*) AS n,
          cast(sum(CASE WHEN parse_error IS NULL THEN c_custkey END) AS bigint) AS salaries,
          count(*) FILTER (WHERE parse_error IS NULL) AS kept,
          count(*) FILTER (WHERE c_custkey % 9 = 2) AS braced
        FROM kinds GROUP BY parse_error""",
    "json_broken_parts": """SELECT CASE WHEN event_id % 4 IN (1, 2) THEN 'record has an invalid structure' END AS parse_error,
          CASE WHEN event_id % 4 IN (0, 3) THEN cast(event_id AS varchar) END AS id FROM events
        UNION ALL SELECT NULL, 'x' || event_id FROM events WHERE event_id % 4 = 3""",
    "record_numbers": f"""SELECT o_orderkey // {BATCH} AS batch,
        row_number() OVER (PARTITION BY o_orderkey // {BATCH} ORDER BY o_orderkey) AS record_number,
        o_orderkey, o_orderstatus FROM orders""",
    "split_rewrite": """SELECT o_orderkey, o_custkey, o_orderstatus,
        '  ' || o_orderpriority || ', "' || o_orderstatus || '" ' AS note FROM orders""",
    "split_in_order": f"""SELECT (n - 1) // {SPLIT_RECORDS} + 1 AS file, (n - 1) % {SPLIT_RECORDS} + 1 AS place, o_orderkey, o_orderstatus
        FROM (SELECT *, row_number() OVER (ORDER BY cast(o_orderkey // {BATCH} AS varchar), o_orderkey) AS n FROM orders)""",
    "split_rewrite_json": """SELECT cast(greatest(1, ceil(count(*) / 2000.0)) AS bigint) AS files,
        count(*) AS records, cast(sum(event_id) AS bigint) AS ids, count(DISTINCT event_type) AS types,
        cast(0 AS bigint) AS nones, cast(sum(cast(json_extract_string(props, '$.k') AS bigint)) AS bigint) AS k
        FROM events""",
    "split_plan": """WITH counts AS (
        SELECT o_orderpriority AS source, count(*) AS records FROM orders GROUP BY o_orderpriority
        UNION ALL SELECT 'nation', count(*) FROM nation UNION ALL SELECT 'lineitem', count(*) FROM lineitem)
        SELECT source, records, records > 1000 AS split, cast(greatest(1, ceil(records / 1000.0)) AS bigint) AS files
        FROM counts""",
    "control_counts": """SELECT c_custkey AS feed,
        CASE c_custkey % 8 WHEN 0 THEN c_custkey WHEN 1 THEN c_custkey WHEN 2 THEN c_custkey + 1
          WHEN 5 THEN CASE WHEN c_custkey = 0 THEN 0 END END AS expected,
        CASE c_custkey % 8 WHEN 3 THEN 'Control file is missing required property: record_count'
          WHEN 4 THEN 'record_count must be a whole number but was: ten'
          WHEN 5 THEN 'record_count must not be negative: -' || c_custkey
          WHEN 6 THEN 'Control file is missing required property: record_count'
          WHEN 7 THEN 'record_count must be a whole number but was: 1.5' END AS problem
        FROM customer""",
    "manifest_checks": """WITH r AS (SELECT s_suppkey,
          CASE WHEN s_suppkey % 3 = 0 THEN '.json' ELSE '.CSV' END AS ending,
          CASE WHEN s_suppkey % 4 = 3 AND s_suppkey % 11 = 0 THEN '/s' ELSE '/feeds/s' END || s_suppkey ||
            CASE WHEN s_suppkey % 3 = 0 THEN '.json' ELSE '.CSV' END AS path,
          CASE s_suppkey % 13 WHEN 0 THEN 'xml' WHEN 1 THEN 'json'
            ELSE CASE WHEN s_suppkey % 3 = 0 THEN 'Json' ELSE 'csv' END END AS file_type,
          NOT (s_suppkey % 4 = 3 AND s_suppkey % 11 = 0) AS inside,
          CASE WHEN s_suppkey % 5 <> 0 AND NOT (s_suppkey % 4 = 3 AND s_suppkey % 11 = 0)
            THEN CASE WHEN s_suppkey % 7 = 0 THEN 0 ELSE 10 * s_suppkey END END AS size FROM supplier)
        SELECT s_suppkey, path, size, CASE
          WHEN NOT inside THEN 'path must be inside /feeds'
          WHEN file_type = 'xml' THEN 'Unsupported fileType xml; expected CSV or JSON'
          WHEN size IS NULL THEN 'Data file does not exist: ' || path
          WHEN lower(ending) <> '.' || lower(file_type) THEN 'Data file must end with .' || lower(file_type) ||
            ' for fileType ' || upper(file_type) || ': s' || s_suppkey || ending
          WHEN size = 0 THEN 'Data file is empty: ' || path END AS problem
        FROM r""",
    "paths_inside_root": """SELECT page_id,
        CASE page_id % 3 WHEN 0 THEN '/data/root/in/' WHEN 1 THEN '/data/' ELSE '/data/' END ||
          rtrim(replace(url, '://', ':/'), '/') AS path, page_id % 3 = 0 AS inside FROM pages""",
}
