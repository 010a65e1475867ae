"""Encryption, decryption and the decrypted view."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions.protect import decrypt_failed, decrypt_if_present, decrypted, encrypt_columns, encrypt_numbered
from feedloom.operators.lookup import decrypted_view, find_all
from feedloom.operators.route import good
from feedloom.plans.employee import EMPLOYEE
from feedloom.plans.ingest import outcomes
from feedloom.queries.raw_feed import FEED_CTES, key36, table, typed_feed
from feedloom.session import stage

# Keys for the registered queries only; a job is given its own.
KEY = "0123456789abcdef0123456789abcdef"
OTHER_KEY = "abcdef0123456789abcdef0123456789"
RUN = "00000000-0000-4000-8000-000000000002"


def encrypt_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored form: version, IV of 12 bytes, ciphertext of the plain length plus 16, never the same twice."""
    segments = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    sealed = stage(encrypt_columns(segments, {"sealed": "if(c_custkey % 9 = 0, '  ', c_mktsegment)"}, KEY), "sealed")
    shape = sealed.selectExpr(
        "c_mktsegment",
        "split_part(sealed, ':', 1) AS version",
        "octet_length(unbase64(split_part(sealed, ':', 2))) AS iv_bytes",
        "octet_length(unbase64(split_part(sealed, ':', 3))) - octet_length(c_mktsegment) AS extra_bytes",
        "sealed",
    )
    return shape.groupBy("c_mktsegment", "version", "iv_bytes", "extra_bytes").agg(
        F.count("*").alias("n"), F.countDistinct("sealed").alias("ciphertexts")
    )


def encrypt_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encrypting, storing and decrypting gives the plain values back."""
    plain = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_custkey")
    sealed = stage(encrypt_columns(plain, {"a": "o_orderpriority", "b": "o_custkey"}, KEY), "sealed")
    return sealed.select(
        "o_orderkey",
        decrypt_if_present("a", KEY).alias("o_orderpriority"),
        decrypt_if_present("b", KEY, strict=True).try_cast("bigint").alias("o_custkey"),
        decrypted("a", OTHER_KEY).alias("with_other_key"),
    )


def encrypt_by_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values encrypted by their place: read back in clear, none under a pair of key and IV that another one has."""
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderpriority AS source_file", "o_orderkey AS record_number", "o_orderstatus", "o_totalprice"
    )
    targets = {"one": "o_orderstatus", "two": "o_totalprice", "none": "if(record_number % 2 = 0, ' ', NULL)"}
    sealed = stage(encrypt_numbered(orders, targets, KEY), "numbered")
    pairs = F.explode(F.array(*(F.regexp_extract(c, "^v2:([^:]*:[^:]*):", 1) for c in ("one", "two"))))
    used = sealed.select(pairs.alias("pair")).groupBy("pair").agg(F.count("*").alias("times"))
    times = used.agg(F.coalesce(F.max("times"), F.lit(0))).first()[0]
    return sealed.select(
        "source_file", "record_number", decrypted("one", KEY).alias("one"),
        decrypted("two", KEY).cast("double").alias("two"), "none", F.lit(times).cast("bigint").alias("uses_of_a_pair"),
    )


def decrypt_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Malformed, tampered and foreign values are told from good and from blank ones."""
    base = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    sealed = stage(encrypt_columns(base, {"s": "c_name"}, KEY), "sealed")
    damaged = sealed.selectExpr(
        "c_custkey",
        "CASE c_custkey % 10 WHEN 0 THEN s WHEN 1 THEN replace(s, 'v1:', 'v2:')"
        " WHEN 2 THEN concat(left(s, length(s) - 8), if(substr(s, length(s) - 7, 1) = 'A', 'B', 'A'), right(s, 7))"
        " WHEN 3 THEN concat(s, ':x') WHEN 4 THEN 'v1:AAAA:BBBB' WHEN 5 THEN '' WHEN 6 THEN NULL WHEN 7 THEN '  '"
        " WHEN 8 THEN concat(left(s, 4), '*', substr(s, 6)) ELSE 'plain' END AS s",
    )
    return damaged.select(
        "c_custkey", decrypt_if_present("s", KEY).alias("value"), decrypt_failed("s", KEY).alias("failed")
    )


def employee_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored rows looked up by many keys at once, fields in clear again."""
    stored = stage(
        good(outcomes(typed_feed(spark, sf_dir).withColumn("source_creation_time", F.current_timestamp()), EMPLOYEE, RUN, KEY)),
        "stored",
    )
    keys = table(spark, sf_dir, "orders").selectExpr(f"'E' || {key36('o_custkey')} AS employee_id")
    view = decrypted_view(find_all(stored, keys, "employee_id"), EMPLOYEE, KEY)
    return view.selectExpr(
        "employee_id", "last_name", "phone_number", "date_format(hire_date, 'yyyy-MM-dd') AS hire_date", "salary",
        "is_active", "array_join(skills, '|') AS skills", "address.city AS city", "address.street AS street",
        "emergency_contact.phone AS contact_phone", "emergency_contact.name AS contact_name", "execution_id",
    )


QUERIES = {
    "encrypt_shape": encrypt_shape,
    "encrypt_round_trip": encrypt_round_trip,
    "encrypt_by_number": encrypt_by_number,
    "decrypt_failures": decrypt_failures,
    "employee_view": employee_view,
}

ORACLE = {
    "encrypt_shape": """SELECT c_mktsegment, CASE WHEN c_custkey % 9 <> 0 THEN 'v1' END AS version,
        CASE WHEN c_custkey % 9 <> 0 THEN 12 END AS iv_bytes, CASE WHEN c_custkey % 9 <> 0 THEN 16 END AS extra_bytes,
        count(*) AS n, count(CASE WHEN c_custkey % 9 <> 0 THEN 1 END) AS ciphertexts
        FROM customer GROUP BY ALL""",
    "encrypt_round_trip": """SELECT o_orderkey, o_orderpriority, o_custkey, cast(NULL AS varchar) AS with_other_key
        FROM orders""",
    "encrypt_by_number": """SELECT o_orderpriority AS source_file, o_orderkey AS record_number, o_orderstatus AS one,
        o_totalprice AS two, cast(NULL AS varchar) AS none, cast(1 AS bigint) AS uses_of_a_pair FROM orders""",
    "decrypt_failures": """SELECT c_custkey, CASE c_custkey % 10 WHEN 0 THEN c_name WHEN 5 THEN '' WHEN 7 THEN '  ' END AS value,
        c_custkey % 10 IN (1, 2, 3, 4, 8, 9) AS failed FROM customer""",
    "employee_view": f"""{FEED_CTES} SELECT employee_id, coalesce(last_name, ' ') AS last_name, phone_number, hire_date,
        try_cast(salary AS bigint) AS salary, lower(is_active) = 'true' AS is_active,
        array_to_string(skill_list, '|') AS skills, coalesce(address_city, ' ') AS city, address_street AS street,
        emergency_contact_phone AS contact_phone, emergency_contact_name AS contact_name, '{RUN}' AS execution_id
        FROM checked WHERE error_type IS NULL
          AND employee_id IN (SELECT 'E' || {key36('o_custkey')} FROM orders)""",
}
