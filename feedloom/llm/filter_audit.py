"""What each filter of a chain removes, for every order of the filters, from one count of the documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.common import Scratch, exact

_SPACE = "[\\x20\\x09-\\x0D]+"


def standard_filters(text: Column) -> dict[str, Column]:
    """Failure conditions by letter, of a text that is not NULL; each is true or false.

    A: under 200 words. B: fewer distinct words than half the words. C: over 2 %
    capital letters A-Z. D: one of ``#$%&*|``. Words are parted by ASCII white space.
    """
    words = F.array_remove(F.split(text, _SPACE), "")
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": F.size(words) < 200,
        "B": F.size(F.array_distinct(words)) * 100 < F.size(words) * 50,
        "C": capitals * 100 > F.length(text) * 2,
        "D": text.rlike("[#$%&*|]"),
    }


def mask_cells(
    docs: DataFrame,
    labels: DataFrame,
    filters=standard_filters,
    duplicates: str | None = "E",
    id_column: str = "doc_id",
    text_column: str = "text",
    part_column: str = "source",
) -> tuple[DataFrame, str]:
    """Rows (``part``, ``cells``) and the letters; ``cells`` counts the documents of a part by the set of filters they fail.

    A cell has ``mask`` (bit i: letter i fails), ``n``, ``good`` and ``toxic``.
    ``duplicates`` names a further filter: the text is that of a smaller id,
    wherever that row is. A part has at most 2^letters cells. One narrow pass
    over the texts gives a row of fixed size for each document; all shuffles
    work on those. Repeated texts are counted per (text, part, labels) before
    their rows meet, so a text of a third of all rows is a few rows there.
    """
    scratch = Scratch(docs.sparkSession)
    rows = exact(docs, id_column, text_column, part_column).toDF("doc", "text", "part")
    rows = rows.select("doc", F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.col("part").cast("string"), F.lit("")).alias("part"))
    conditions = filters(F.col("text"))
    letters = "".join(conditions)
    bits = [F.when(fails, F.lit(1 << i)).otherwise(F.lit(0)) for i, fails in enumerate(conditions.values())]
    mask = bits[0]
    for bit in bits[1:]:
        mask = mask + bit
    rows = rows.select("doc", "part", mask.alias("mask"), F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"))
    rows = scratch.write(rows.groupBy("doc", "part", "mask", "digest").agg(F.count("*").alias("n")), "filter-masks")

    known = exact(labels, id_column, "quality", "toxic").toDF("doc", "quality", "toxic").where("doc IS NOT NULL")
    known = known.groupBy("doc").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")
    )
    off = F.lit(False)
    with_id = rows.where("doc IS NOT NULL").join(known, "doc", "left").select(
        "doc", "part", "mask", "digest", "n", F.coalesce("good", off).alias("good"), F.coalesce("toxic", off).alias("toxic")
    )
    # Rows without an id have no label and no smaller id; they stay out of the join, so they are no hot key.
    without_id = rows.where("doc IS NULL").select("doc", "part", "mask", "digest", "n", off.alias("good"), off.alias("toxic"))
    same = with_id.union(without_id).groupBy("digest", "part", "mask", "good", "toxic", F.col("doc").isNull().alias("no_id")).agg(
        F.sum("n").alias("n"), F.min("doc").alias("first"), F.min_by("n", "doc").alias("n_first")
    )
    least = F.min("first").over(Window.partitionBy("digest"))
    kept = F.when(F.col("no_id"), F.col("n")).when(F.col("first") == least, F.col("n_first")).otherwise(F.lit(0))
    if duplicates:
        sides = F.array(
            F.struct(F.col("mask"), kept.alias("n")),
            F.struct((F.col("mask") + F.lit(1 << len(letters))).alias("mask"), (F.col("n") - kept).alias("n")),
        )
        letters += duplicates
    else:
        sides = F.array(F.struct("mask", "n"))
    counts = same.select("part", "good", "toxic", sides.alias("sides")).select("part", "good", "toxic", F.inline("sides"))
    counts = counts.where("n > 0").groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"),
    )
    cells = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    return scratch.write(cells, "filter-cells"), letters


def _total(field: str, condition: str) -> str:
    return f"aggregate(c.cells, 0L, (sum, x) -> sum + if({condition}, x.{field}, 0L))"


def steps(cells: DataFrame, letters: str) -> DataFrame:
    """A row for each part and each sequence of unlike letters, with the metrics of its last filter.

    A recursive query extends every sequence by every letter that its bits
    ``applied`` do not hold and joins the part's mask cells; the level's rows
    are that step's metrics. Five letters make 325 sequences a part.
    """
    spark = cells.sparkSession
    all_letters = ", ".join(f"named_struct('letter', '{letter}', 'bit', {1 << i})" for i, letter in enumerate(letters))
    alive, fails = "(x.mask & l.applied) = 0", "(x.mask & l.bit) <> 0"
    setting = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, "-1")  # the recursion ends by itself; its rows grow with the parts
    try:
        found = spark.sql(
            f"""WITH RECURSIVE steps(part, prefix, letter, step, applied, kept, removed, redundant, unique_fails, good_lost, toxic_lost) AS (
              SELECT part, '', '', 0, 0, 0L, 0L, 0L, 0L, 0L, 0L FROM {{cells}}
              UNION ALL
              SELECT l.part, concat(l.prefix, l.letter), l.letter, l.step + 1, l.applied | l.bit,
                {_total("n", "(x.mask & (l.applied | l.bit)) = 0")}, {_total("n", f"{alive} AND {fails}")},
                {_total("n", f"NOT {alive} AND {fails}")}, {_total("n", "x.mask = l.bit")},
                {_total("good", f"{alive} AND {fails}")}, {_total("toxic", f"{alive} AND {fails}")}
              FROM (SELECT part, prefix, step, applied, inline(filter(array({all_letters}), x -> (x.bit & applied) = 0))
                      AS (letter, bit) FROM steps) l
                JOIN {{cells}} c ON l.part = c.part
            ) SELECT * FROM steps WHERE step > 0""",
            cells=cells,
        )
        return Scratch(spark).write(found, "filter-steps")
    finally:
        if before is None:
            spark.conf.unset(setting)
        else:
            spark.conf.set(setting, before)


def audit(docs: DataFrame, labels: DataFrame, filters=standard_filters, duplicates: str | None = "E", **columns: str) -> DataFrame:
    """For each part, order of the filters and step: what the step's filter does there.

    Columns: ``part``, ``filter_order``, ``step`` (from 1; its filter is that letter of the order), and counts of the
    part's documents: ``kept`` after the step, ``removed`` by it, ``redundant`` (failing it, but removed before),
    ``unique_fails`` (failing it alone), ``good_lost`` and ``toxic_lost`` (removed here, labelled quality or toxic 1),
    ``shapley`` (what the filter removes, summed over all orders). Every combination has a row, zeros included.

    A NULL text is empty; NULL and empty parts are one. Every row counts, repeated ones too; equal rows share an id,
    none of which is smaller, so they are no duplicates of each other. A row without an id is unlabelled and no
    duplicate, and makes none. Repeated labels of an id: 1 if any is. Empty tables give no rows; other columns are not
    read. What is enumerated are the cells, 325 sequences a part, whatever the number of documents.
    """
    cells, letters = mask_cells(docs, labels, filters, duplicates, **columns)
    taken = steps(cells, letters)
    orders = taken.where(F.col("step") == len(letters)).select("part", F.col("prefix").alias("filter_order"))
    orders = orders.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(letters)))))
    orders = orders.withColumn("prefix", F.expr("substring(filter_order, 1, step)"))
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]
    joined = orders.join(taken.select("part", "prefix", "letter", *names), ["part", "prefix"])
    return joined.select(
        "part", "filter_order", "step", *names, F.sum("removed").over(Window.partitionBy("part", "letter")).alias("shapley")
    )


AUDIT_SQL = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '') AS part,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
known AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS bad
  FROM labels GROUP BY doc_id),
masks AS (
  SELECT t.part, coalesce(k.good, 0) AS good, coalesce(k.bad, 0) AS bad,
    CASE WHEN len(words) < 200 THEN 1 ELSE 0 END
    + CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END
    + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN t.doc_id > min(t.doc_id) OVER (PARTITION BY text) THEN 16 ELSE 0 END AS mask
  FROM texts t LEFT JOIN known k ON t.doc_id = k.doc_id),
cells AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(bad) AS bad FROM masks GROUP BY part, mask),
orders(filter_order, applied) AS (
  SELECT '', 0 UNION ALL SELECT filter_order || substr('ABCDE', i + 1, 1), applied | (1 << i)
  FROM orders, (SELECT unnest([0, 1, 2, 3, 4]) AS i) WHERE applied & (1 << i) = 0),
steps AS (
  SELECT filter_order, step, 1 << (instr('ABCDE', substr(filter_order, step, 1)) - 1) AS bit,
    list_sum([1 << (instr('ABCDE', substr(filter_order, j, 1)) - 1) FOR j IN range(1, step)]) AS earlier
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step) WHERE length(filter_order) = 5),
counts AS (
  SELECT part, filter_order, step, bit,
    sum(CASE WHEN mask & (coalesce(earlier, 0)::INTEGER | bit) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mask & coalesce(earlier, 0)::INTEGER = 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & coalesce(earlier, 0)::INTEGER <> 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & coalesce(earlier, 0)::INTEGER = 0 AND mask & bit <> 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN mask & coalesce(earlier, 0)::INTEGER = 0 AND mask & bit <> 0 THEN bad ELSE 0 END) AS toxic_lost
  FROM steps, cells GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
  unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
  (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM counts"""
