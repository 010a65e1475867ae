"""Mixing sources to target weights by thresholds on document hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from feedloom.llm.common import Scratch, exact, salted

WEIGHTS = (5, 2, 1)
MOST = 3
SEED = "mix:"
#: Levels of nested budgets.
ROUNDS = 4
_BITS, _STEP = 60, 12
_WORD = r"[^\x20\x09-\x0D]+"


def words(text: str) -> Column:
    """The number of words of a text column; 0 for NULL."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(_WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, target) of ``sizes`` (source, size).

    Sources by code point, NULL last, have the weights in turn and share the sum
    of all sizes by weight. A target stops at ``most`` times its source's size;
    what is above is shared by weight among the others until none is above.
    With sources in order of size by weight the stopped ones come first, so the
    common share of a weight is found in one pass over one row per source.
    """
    places = Window.orderBy(F.col("source").isNull(), "source")
    turn = F.array(*(F.lit(weight) for weight in weights))
    per_source = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("weight", F.get(turn, (F.row_number().over(places) - 1) % len(weights)))
        .withColumn("cap", F.lit(most) * F.col("source_size"))
    )
    by_room = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").isNull(), "source")
    all_rows = Window.partitionBy()
    before = F.coalesce(F.sum("cap").over(by_room.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shared = (
        per_source.withColumn("place", F.row_number().over(by_room))
        .withColumn("left", F.sum("source_size").over(all_rows) - before)
        .withColumn("share", F.col("left") / F.sum("weight").over(by_room.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("fits", F.expr("CASE WHEN share * weight <= cap THEN place END"))
        .withColumn("first", F.min("fits").over(all_rows))
        .withColumn("chosen", F.max(F.expr("CASE WHEN place = first THEN share END")).over(all_rows))
    )
    target = F.expr("CASE WHEN place < first THEN double(cap) ELSE chosen * weight END")
    return shared.select("source", "source_size", target.alias("target"))


def thresholds(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, rounds: int = ROUNDS) -> DataFrame:
    """(source, source_size, target, whole, levels) of ``sizes`` (source, size, hash), in the shared folder.

    Every document of a source is taken ``whole`` times, and once more if one of
    the ``levels`` (start, below, fits) holds its hash and size. The rest of the
    target is a budget for the documents in hash order. Sums by source and hash
    bucket show the bucket in which the budget ends; only that one is cut into
    finer buckets, until it holds one hash: the first level ends below it. What
    is then left of the budget is a nested budget for the documents behind that
    hash which are no larger than what is left, and so on for ``rounds`` levels.

    A pass is one partial sum over (source, size, hash); a level takes at most
    ``60 / 12`` of them. Only sums are sorted, 4096 to a source.
    """
    scratch = Scratch(sizes.sparkSession)
    state = targets(sizes, weights, most).select(
        "*",
        F.expr("CASE WHEN source_size > 0 THEN bigint(floor(target / source_size)) ELSE 0L END").alias("whole"),
        F.lit(0).cast("long").alias("start"),
        F.col("source_size").alias("fits"),
        F.expr("CAST(array() AS array<struct<start: bigint, below: bigint, fits: bigint>>)").alias("levels"),
    )
    state = state.select("*", (F.col("target") - F.col("whole") * F.col("source_size")).alias("budget"))
    state = scratch.write(state, "mix")
    for _ in range(rounds):
        found = _boundary(scratch, sizes, state)
        left = F.col("budget") - F.col("sum_before")
        level = F.struct("start", F.coalesce("hash", F.lit(1 << _BITS)).alias("below"), "fits")
        following = found.select(
            "source",
            "source_size",
            "target",
            "whole",
            F.coalesce(F.col("hash") + 1, F.lit(1 << _BITS)).alias("start"),
            F.floor(left).alias("fits"),
            F.concat("levels", F.array(level)).alias("levels"),
            left.alias("budget"),
        )
        following = scratch.write(following, "mix")
        scratch.drop(state)
        scratch.drop(found)
        state = following
    return state.select("source", "source_size", "target", "whole", "levels")


def _boundary(scratch: Scratch, sizes: DataFrame, state: DataFrame) -> DataFrame:
    """``state`` with the ``hash`` at which each source's budget ends (NULL: not at all) and the ``sum_before`` it."""
    state = state.select(
        "*", *(F.lit(0).cast("long").alias(name) for name in ("prefix", "sum_before")), F.lit(None).cast("long").alias("hash")
    )
    for bits in range(_STEP, _BITS + 1, _STEP):
        refined = scratch.write(_refine(sizes, state, bits), "mix")
        if bits > _STEP:
            scratch.drop(state)
        state = refined
        if state.where("hash < greatest").isEmpty():
            break
    return state


def _refine(sizes: DataFrame, state: DataFrame, bits: int) -> DataFrame:
    """The bucket of ``bits`` leading hash bits in which each source's budget ends."""
    kept = [name for name in state.columns if name not in ("source", "prefix", "sum_before", "hash", "greatest")]
    known = state.select(F.col("source").alias("of"), "prefix", "sum_before", *kept)
    bucket = F.shiftright("hash", _BITS - bits)
    inside = (F.shiftright(bucket, _STEP) == F.col("prefix")) & F.expr("hash >= start AND size <= fits")
    sums = (
        sizes.join(known, sizes["source"].eqNullSafe(known["of"]))
        .where(inside)
        .groupBy("source", bucket.alias("bucket"))
        .agg(F.sum("size").alias("size"), F.min("hash").alias("least"), F.max("hash").alias("greatest"))
    )
    running = Window.partitionBy("source").orderBy("bucket")
    ends = (
        sums.withColumn("up_to", F.sum("size").over(running))
        .join(known, F.col("source").eqNullSafe(F.col("of")))
        .where("sum_before + up_to > budget")
        .groupBy("source")
        .agg(F.min(F.struct("bucket", "up_to", "size", "least", "greatest")).alias("end"))
        .select(F.col("source").alias("end_of"), "end.*")
    )
    return known.join(ends, F.col("of").eqNullSafe(F.col("end_of")), "left").select(
        F.col("of").alias("source"),
        *kept,
        F.coalesce("bucket", F.lit(-1)).alias("prefix"),
        (F.col("sum_before") + F.coalesce(F.col("up_to") - F.col("size"), F.lit(0))).alias("sum_before"),
        F.col("least").alias("hash"),
        "greatest",
    )


def row_hash(id_column: str, text_column: str) -> Column:
    """The hash of a row's id and text, so that rows with one id, or none, are still dealt out one by one."""
    text = F.md5(F.coalesce(F.col(text_column), F.lit("")))
    return salted(F.concat(F.coalesce(F.col(id_column).cast("string"), F.lit("")), F.lit(":"), text), SEED)


def sized(docs: DataFrame, id_column: str, text_column: str, source_column: str) -> DataFrame:
    docs = exact(docs, id_column, text_column, source_column).toDF("doc", "text", "source")
    return docs.select("doc", "source", words("text").alias("size"), row_hash("doc", "text").alias("hash"))


def copies() -> Column:
    """How often a row (size, hash) is taken, beside its source's thresholds."""
    return F.col("whole") + F.expr("int(exists(levels, x -> hash >= x.start AND hash < x.below AND size <= x.fits))")


def mix(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source") -> DataFrame:
    """What a mix of the sources takes of every row.

    Columns: the id, ``size`` (words of the text), ``source_size`` and ``target``
    of its source, ``taken`` (words that the mix takes, repeats counted). See
    ``targets`` and ``thresholds``; a document is taken whole or not, up to 3
    times. A NULL text has size 0; NULL sources are one source, the last one;
    rows equal in id and text are taken alike. A source
    of size 0 has target 0. Reruns agree, whatever the order of the rows. No
    row gives no row; further columns are not read.
    """
    sizes = Scratch(docs.sparkSession).write(sized(docs, id_column, text_column, source_column), "sizes")
    found = thresholds(sizes).withColumnRenamed("source", "of")
    return sizes.join(found, sizes["source"].eqNullSafe(found["of"])).select(
        F.col("doc").alias(id_column), "size", "source_size", "target", (F.col("size") * copies()).alias("taken")
    )


def mixed(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source") -> DataFrame:
    """The rows that the mix takes, as often as it takes them, with all their columns."""
    sizes = Scratch(docs.sparkSession).write(sized(docs, id_column, text_column, source_column), "sizes")
    found = thresholds(sizes).select(F.col("source").alias("of"), "whole", "levels")
    rows = docs.select(
        F.struct("*").alias("row"),
        docs[source_column].alias("from"),
        words(text_column).alias("size"),
        row_hash(id_column, text_column).alias("hash"),
    )
    taken = rows.join(found, F.col("from").eqNullSafe(F.col("of"))).select("row", copies().cast("int").alias("copies"))
    return taken.where("copies > 0").select("row", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")


_LEVEL_SQL = """
summed{n} AS (
    SELECT of AS source, hash, sum(size) AS here, sum(sum(size)) OVER (PARTITION BY of ORDER BY hash) AS up_to
    FROM sized JOIN state{n} ON source IS NOT DISTINCT FROM of WHERE hash >= start AND size <= fits GROUP BY of, hash),
ends{n} AS (
    SELECT of, min(CASE WHEN up_to > budget THEN hash END) AS below,
           coalesce(max(CASE WHEN up_to <= budget THEN up_to END), 0) AS taken
    FROM state{n} LEFT JOIN summed{n} ON source IS NOT DISTINCT FROM of GROUP BY of),
state{m} AS (
    SELECT s.* REPLACE (
        coalesce(below + 1, 1152921504606846976) AS start, CAST(floor(budget - taken) AS BIGINT) AS fits, budget - taken AS budget,
        list_append(levels, {{'start': start, 'below': coalesce(below, 1152921504606846976), 'fits': fits}}) AS levels)
    FROM state{n} s JOIN ends{n} e ON s.of IS NOT DISTINCT FROM e.of)"""
MIX_SQL = (
    r"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
           CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))), 1, 15) AS BIGINT) AS hash
    FROM documents),
weighed AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
           list_value(5, 2, 1)[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
    FROM sized GROUP BY source),
placed AS (
    SELECT *, 3 * source_size AS cap, row_number() OVER room AS place,
           (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (room ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
           / sum(weight) OVER (room ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS share
    FROM weighed WINDOW room AS (ORDER BY source_size / weight, source NULLS LAST)),
shared AS (
    SELECT min(place) AS first, min_by(share, place) AS share FROM placed WHERE share * weight <= cap),
targets AS (
    SELECT source, source_size, CASE WHEN place < first THEN CAST(cap AS DOUBLE) ELSE shared.share * weight END AS target
    FROM placed, shared),
wholes AS (
    SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM targets),
state0 AS (
    SELECT source AS of, source_size, target, whole, CAST(0 AS BIGINT) AS start, source_size AS fits,
           target - whole * source_size AS budget, CAST([] AS STRUCT("start" BIGINT, below BIGINT, fits BIGINT)[]) AS levels
    FROM wholes),"""
    + ",".join(_LEVEL_SQL.format(n=n, m=n + 1) for n in range(ROUNDS))
    + f"""
SELECT doc_id, size, source_size, target,
       CAST(size * (whole + CASE WHEN len(list_filter(levels, lambda x: hash >= x.start AND hash < x.below AND size <= x.fits)) > 0
                                 THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM sized JOIN state{ROUNDS} ON source IS NOT DISTINCT FROM of
"""
)
