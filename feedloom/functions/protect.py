"""Field encryption and redaction.

Stored form: ``v1:<base64 IV>:<base64 ciphertext and tag>``, AES-256-GCM, with a random IV, or
``v2:<base64 context>:<base64 IV>:<base64 ciphertext and tag>``. In ``v2`` the context is drawn from the call's salt and
the record's file, the key is derived from it, and the IV is made of the record's number and the field's: no two values
share a key and an IV, however many there are. Random IVs of 96 bits under one key are good for some 2^32 values.

The IV of ``v1`` is a column of its own, drawn by a nondeterministic function: Catalyst
folds and duplicates an ``aes_encrypt`` without one, because it takes the call
for deterministic. The key is a literal of the plan, never part of SQL text;
plans of these jobs are only printed redacted (see ``session.configure``).
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.text import is_blank, quoted
from feedloom.session import configure

# Fixed values ---------------------------------------------------------------
VERSION = "v1"
NUMBERED = "v2"
KEY_BYTES = 32
IV_BYTES = 12
CONTEXT_BYTES = 16
REDACTED = "[REDACTED]"
# ----------------------------------------------------------------------------


def check_key(key: str | None) -> bytes:
    """The key as bytes; it must be exactly 32 of them. Fails when the job is set up."""
    if key is None or not key.strip():
        raise ValueError("Encryption key must not be blank")
    raw = key.encode("utf-8")
    if len(raw) != KEY_BYTES:
        raise ValueError(f"Encryption key must be exactly {KEY_BYTES} bytes but is {len(raw)}")
    return raw


def encrypt_columns(df: DataFrame, targets: Mapping[str, str], key: str) -> DataFrame:
    """Add one encrypted column per entry of ``targets`` (new name: SQL of the plain value).

    NULL or blank values are not encrypted, they become NULL. Every value gets
    its own IV. Write the result once and read it from there: that fixes the
    IVs for all later readers.
    """
    raw = F.lit(check_key(key))
    configure(df.sparkSession)
    salt = uuid.uuid4().hex
    names = list(targets)
    df = df.withColumns(
        {
            f"__iv_{i}": F.expr(f"substr(unhex(sha2(concat(uuid(), '{salt}'), 256)), 1, {IV_BYTES})")
            for i in range(len(names))
        }
        | {f"__plain_{i}": F.expr(f"cast({targets[n]} AS string)") for i, n in enumerate(names)}
    )
    # aes_encrypt returns the IV, the ciphertext and the tag, in this order.
    df = df.withColumns(
        {
            f"__sealed_{i}": F.when(
                ~F.expr(is_blank(f"__plain_{i}")),
                F.aes_encrypt(F.col(f"__plain_{i}"), raw, F.lit("GCM"), F.lit("DEFAULT"), F.col(f"__iv_{i}")),
            )
            for i in range(len(names))
        }
    )
    # Spark may break long base64 text into lines, depending on a setting: translate undoes it.
    stored = {
        n: F.expr(
            f"concat('{VERSION}:', base64(__iv_{i}), ':',"
            f" translate(base64(substr(__sealed_{i}, {IV_BYTES + 1})), '\\r\\n', ''))"
        )
        for i, n in enumerate(names)
    }
    helpers = [f"__{kind}_{i}" for kind in ("iv", "plain", "sealed") for i in range(len(names))]
    return df.withColumns(stored).drop(*helpers)


def encrypt_numbered(df: DataFrame, targets: Mapping[str, str], key: str, file: str = "source_file", number: str = "record_number") -> DataFrame:
    """As ``encrypt_columns``, in form ``v2``; (``file``, ``number``) must tell the records apart.

    The values follow from the call's salt, the record's place and the field,
    so a task that runs again writes the same ones.
    """
    raw = F.lit(check_key(key))
    configure(df.sparkSession)
    salt = uuid.uuid4().hex
    context = F.expr(f"substr(unhex(sha2(concat('{salt}', coalesce({file}, '')), 256)), 1, {CONTEXT_BYTES})")
    missing = F.raise_error(F.lit(f"a record without {number}")).cast("bigint")
    df = df.withColumns({"__context": context, "__number": F.coalesce(F.col(number).cast("bigint"), missing)})
    df = df.withColumn("__key", _derived(raw, "__context"))
    stored, helpers = {}, ["__context", "__number", "__key"]
    for i, (column, plain) in enumerate(targets.items()):
        iv = F.unhex(F.concat(F.lpad(F.hex("__number"), 16, "0"), F.lit(f"{i:08X}")))
        df = df.withColumns({f"__iv_{i}": iv, f"__plain_{i}": F.expr(f"cast({plain} AS string)")})
        sealed = F.aes_encrypt(F.col(f"__plain_{i}"), F.col("__key"), F.lit("GCM"), F.lit("DEFAULT"), F.col(f"__iv_{i}"))
        df = df.withColumn(f"__sealed_{i}", F.when(~F.expr(is_blank(f"__plain_{i}")), sealed))
        stored[column] = F.expr(
            f"concat('{NUMBERED}:', base64(__context), ':', base64(__iv_{i}), ':',"
            f" translate(base64(substr(__sealed_{i}, {IV_BYTES + 1})), '\\r\\n', ''))"
        )
        helpers += [f"__{kind}_{i}" for kind in ("iv", "plain", "sealed")]
    return df.withColumns(stored).drop(*helpers)


def _derived(raw: Column, context: str) -> Column:
    """The key of a context: keyed twice, so that one derived key says nothing of another."""
    inner = F.unhex(F.sha2(F.concat(raw, F.col(context)), 256))
    return F.unhex(F.sha2(F.concat(raw, inner), 256))


def decrypted(c: str, key: str) -> Column:
    """The plain text, or NULL when the value is malformed, tampered with or of another key."""
    raw = F.lit(check_key(key))
    # 12 bytes are exactly 16 base64 characters, and 16 bytes 24, so the parts sit at fixed places.
    start, size, context = len(VERSION) + 2, IV_BYTES * 4 // 3, -(-CONTEXT_BYTES // 3) * 4

    def opened(at: int, own_key: Column) -> Column:
        sealed = f"concat(unbase64(substr({c}, {at}, {size})), try_to_binary(substr({c}, {at + size + 1}), 'base64'))"
        return F.try_aes_decrypt(F.expr(sealed), own_key, F.lit("GCM"), F.lit("DEFAULT")).cast("string")

    derived_inner = F.unhex(F.sha2(F.concat(raw, F.expr(f"unbase64(substr({c}, {start}, {context}))")), 256))
    derived = F.unhex(F.sha2(F.concat(raw, derived_inner), 256))
    part = f"[A-Za-z0-9+/]{{{size}}}"
    return F.when(F.expr(rf"{c} RLIKE r'\A{VERSION}:{part}:[^:]*\z'"), opened(start, raw)).when(
        F.expr(rf"{c} RLIKE r'\A{NUMBERED}:[A-Za-z0-9+/]{{{context - 2}}}==:{part}:[^:]*\z'"), opened(start + context + 1, derived)
    )


def decrypt_if_present(c: str, key: str, strict: bool = False) -> Column:
    """NULL and blank values were never encrypted and come back unchanged.

    A value that cannot be decrypted gives NULL, or fails the job when ``strict``.
    """
    plain = decrypted(c, key)
    if strict:
        failure = F.raise_error(F.lit("Value could not be decrypted (wrong format or wrong key)")).cast("string")
        plain = F.coalesce(plain, failure)
    return F.when(F.expr(is_blank(c)), F.expr(c)).otherwise(plain)


def decrypt_failed(c: str, key: str) -> Column:
    """True for a value that is there but cannot be decrypted."""
    return ~F.expr(is_blank(c)) & decrypted(c, key).isNull()


def redacted(c: str) -> str:
    """``[REDACTED]`` in place of any value, NULL stays NULL."""
    return f"if({c} IS NULL, NULL, {quoted(REDACTED)})"
