"""Allow or block URLs: rules first, else naive Bayes on the words of host and path."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from feedloom.llm.common import Scratch, exact, in_python

# (verdict, host, path)
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: Letters of a word by which it is looked up; longer ones are looked up by their first letters and then compared.
KEY_LETTERS = 20
WINDOW = 64
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: str) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?`` or ``#``, A-Z in lower case; else empty."""
    return F.translate(F.regexp_extract(_behind_scheme(url), "^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: str) -> Column:
    """What follows the host up to ``?`` or ``#``."""
    return F.regexp_extract(_behind_scheme(url), "^[^/?#]*([^?#]*)", 1)


def _behind_scheme(url: str) -> Column:
    place = F.instr(F.col(url), "://")
    return F.when(place > 0, F.substring(F.col(url), place + 3, F.length(F.col(url)))).otherwise(F.lit(""))


def rule_of(rules: tuple[tuple[str, str, str], ...], host: Column, path: Column) -> Column:
    """The longest rule (verdict, rule) that fits: its host or a subdomain, and a path that starts with its path."""
    found = F.lit(None).cast("struct<verdict: string, rule: string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda rule: (len(rule[1] + rule[2]), rule)):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        found = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule_host + rule_path).alias("rule"))).otherwise(found)
    return found


def word_counts(html: DataFrame, column: str) -> DataFrame:
    """(word, n): how often each word stands in the readable text of all pages."""
    # What is not closed reaches to the end, and a tag ends before the next one, so no stretch is searched twice.
    hidden = r"(?is)<!--.*?(?:-->|\z)|<(script|style)\b.*?(?:</\1\s*+>|\z)|<[^<>]*+>|&\w++;"
    text = F.lower(F.regexp_replace(F.col(column), hidden, " "))
    words = html.select(F.explode(F.regexp_extract_all(text, F.lit(r"\p{L}+"), F.lit(0))).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n"))


def best_split(label: str, known: list[tuple[int, int, float]], unknown: float) -> list[str]:
    """The words of the most probable split of a label, ties by the later start of the last word.

    ``known`` has the places and log probabilities of the dictionary's words in
    the label. Any other stretch is a word that costs ``unknown`` and a tenth
    of its probability for each letter.
    """
    ending: dict[int, list[tuple[int, float]]] = {}
    for start, end, score in known:
        ending.setdefault(end, []).append((start, score))
    places = {(start, end) for start, end, _ in known}
    letter = math.log(10)
    best, cut = [0.0], [0]
    # The best beginnings of a stretch that is no word: its price grows with its letters, wherever it begins.
    open_from: list[int] = []
    for end in range(1, len(label) + 1):
        start = end - 1
        while open_from and best[open_from[-1]] + open_from[-1] * letter <= best[start] + start * letter:
            open_from.pop()
        open_from.append(start)
        unknown_start = next((x for x in open_from if (x, end) not in places), None)
        choices = [(best[start] + score, start) for start, score in ending.get(end, ())]
        if unknown_start is not None:
            choices.append((best[unknown_start] + unknown - (end - unknown_start) * letter, unknown_start))
        score, start = max(choices)
        best.append(score)
        cut.append(start)
    words, end = [], len(label)
    while end:
        words.append(label[cut[end] : end])
        end = cut[end]
    return words[::-1]


def split_labels(labels: DataFrame, words: DataFrame) -> DataFrame:
    """(label, words) of distinct ``labels``: unigram Viterbi with the counts of ``words`` (word, n).

    The dictionary may be of any size and its words of any length. The stretches
    of a label up to ``KEY_LETTERS`` letters are joined with it; longer words
    are joined by their first letters and kept where the label goes on like
    them. Only what is a word comes back to the label, whose row is then split.
    """
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    base = math.log(max(total, 1))
    # In windows of some letters, each with the beginning of the next one, since places far into a long text cost a search.
    pieces = labels.select("label", F.regexp_extract_all("label", F.lit(f"(?s).{{1,{WINDOW}}}"), F.lit(0)).alias("pieces"))
    behind = lambda i: F.left(F.coalesce(F.get("pieces", i + 1), F.lit("")), F.lit(KEY_LETTERS - 1))
    windows = pieces.select("label", F.posexplode(F.transform("pieces", lambda piece, i: F.struct(piece.alias("piece"), F.concat(piece, behind(i)).alias("text")))))
    starts = windows.select("label", "pos", "col.text", F.explode(F.sequence(F.lit(1), F.length("col.piece"))).alias("at"))
    lengths = F.sequence(F.lit(1), F.least(F.lit(KEY_LETTERS), F.length("text") - F.col("at") + 1))
    stretches = starts.select("label", "pos", "text", "at", F.explode(lengths).alias("length"))
    stretches = stretches.select(
        "label", (F.col("pos") * WINDOW + F.col("at")).alias("start"), "length", F.col("text").substr(F.col("at"), F.col("length")).alias("word")
    )
    short = stretches.join(words, "word").select("label", "start", "length", "n")
    longer = words.where(F.length("word") > KEY_LETTERS).withColumn("key", F.left("word", F.lit(KEY_LETTERS)))
    keyed = stretches.where(F.col("length") == KEY_LETTERS).withColumnRenamed("word", "key").drop("length")
    goes_on = F.col("label").substr(F.col("start"), F.length("word")) == F.col("word")
    long = keyed.join(longer, "key").where(goes_on).select("label", "start", F.length("word").alias("length"), "n")
    score = (F.log(F.col("n").cast("double")) - base).alias("score")
    places = short.union(long).select(
        "label", F.struct((F.col("start") - 1).alias("a"), (F.col("start") - 1 + F.col("length")).alias("b"), score).alias("place")
    )
    known = places.groupBy("label").agg(F.collect_list("place").alias("known"))  # the words in one label
    joined = labels.join(known, "label", "left").select("label", "known")
    schema = StructType([StructField("label", StringType()), StructField("words", ArrayType(StringType()))])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for label, known in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                places = sorted((place["a"], place["b"], place["score"]) for place in known or [])
                found.append(best_split(label, places, -base))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.string()))], schema.names)

    return in_python(joined, split, schema)


def _tokens(texts: DataFrame, column: str, pattern: str) -> DataFrame:
    """(``column``, part, n) of distinct texts: their parts that match a pattern, in lower case."""
    found = F.regexp_extract_all(F.lower(F.col(column)), F.lit(pattern), F.lit(0))
    return texts.select(column, F.explode(found).alias("part")).groupBy(column, "part").agg(F.count("*").alias("n"))


def judged(
    pages: DataFrame,
    html: DataFrame,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
    rules: tuple[tuple[str, str, str], ...] = RULES,
) -> DataFrame:
    """A verdict for every URL.

    Columns: the id, ``host``, ``path``, ``rule`` (that fits, else NULL),
    ``verdict``, ``host_words`` (the host's words, a space between) and
    ``log_odds`` (of allow, NULL beside a rule).

    Where no rule fits, a multinomial naive Bayes decides on the words of the
    host, its labels split by unigram Viterbi, and on the tokens of the path.
    It learns from all URLs that the rules judge; its word counts come from the
    text of all of ``html``. Odds are smoothed by one, tokens that no judged
    URL has say nothing, and even odds allow. A URL that is NULL or has no
    ``://`` has an empty host and path, no rule and the odds of the classes.
    Rows with repeated or no ids are rows; no row gives no row; further columns
    are not read. Letters of other scripts stay as they are.

    Everything is counted for distinct hosts and distinct paths, weighted by
    their rows, so a hot host is one row in the joins with its words.
    """
    spark, scratch = pages.sparkSession, Scratch(pages.sparkSession)
    rows = exact(pages, id_column, url_column).toDF("id", "url")
    rows = rows.select("id", host_of("url").alias("host"), path_of("url").alias("path"))
    rows = rows.select("*", rule_of(rules, F.col("host"), F.col("path")).alias("by")).select("id", "host", "path", "by.*")
    rows = scratch.write(rows, "urls")
    shares = [F.count(F.when(F.col("verdict") == verdict, 1)).alias(verdict) for verdict in ("allow", "block")]
    hosts, paths = rows.groupBy("host").agg(*shares), rows.groupBy("path").agg(*shares)
    hosts, paths = scratch.write(hosts, "hosts"), scratch.write(paths, "paths")

    runs = _tokens(hosts, "host", r"\p{L}+|\p{N}+").withColumnRenamed("part", "label")
    runs = scratch.write(runs, "host-labels")
    words = word_counts(exact(html, html_column), html_column)
    split = scratch.write(split_labels(runs.select("label").distinct(), scratch.write(words, "words")), "split-labels")
    of_host = runs.join(split, "label").select("host", F.explode("words").alias("token"), "n")
    of_host = scratch.write(of_host.groupBy("host", "token").agg(F.sum("n").alias("n")), "host-words")
    of_path = scratch.write(_tokens(paths, "path", r"[\p{L}\p{N}]+").withColumnRenamed("part", "token"), "path-tokens")

    seen = of_host.join(hosts, "host").select("token", "n", *("allow", "block"))
    seen = seen.union(of_path.join(paths, "path").select("token", "n", "allow", "block"))
    counts = seen.groupBy("token").agg(
        F.sum(F.col("n") * F.col("allow")).alias("allow"), F.sum(F.col("n") * F.col("block")).alias("block")
    )
    counts = scratch.write(counts.where("allow + block > 0"), "token-counts")
    size, allowed, blocked = counts.agg(F.count("*"), F.coalesce(F.sum("allow"), F.lit(0)), F.coalesce(F.sum("block"), F.lit(0))).first()
    for_class = math.log((blocked + max(size, 1)) / (allowed + max(size, 1)))
    weight = F.log((F.col("allow") + 1) / (F.col("block") + 1)) + for_class
    weights = counts.select("token", weight.alias("weight"))

    def odds(tokens: DataFrame, of: str) -> DataFrame:
        return tokens.join(weights, "token").groupBy(of).agg(F.sum(F.col("n") * F.col("weight")).alias(f"{of}_odds"))

    n_allow, n_block = hosts.agg(F.coalesce(F.sum("allow"), F.lit(0)), F.coalesce(F.sum("block"), F.lit(0))).first()
    places = _in_order(hosts, split)
    of_hosts = scratch.write(places.join(odds(of_host, "host"), "host", "left"), "host-odds")
    of_paths = scratch.write(odds(of_path, "path"), "path-odds")
    prior = math.log((n_allow + 1) / (n_block + 1))
    known = rows.join(of_hosts, "host", "left").join(of_paths, "path", "left")
    log_odds = F.round(F.coalesce("host_odds", F.lit(0.0)) + F.coalesce("path_odds", F.lit(0.0)) + prior, 9)
    return known.select(
        F.col("id").alias(id_column),
        "host",
        "path",
        "rule",
        F.coalesce("verdict", F.when(log_odds >= 0, "allow").otherwise("block")).alias("verdict"),
        F.coalesce("host_words", F.lit("")).alias("host_words"),
        F.when(F.col("rule").isNull(), log_odds).alias("log_odds"),
    )


def _in_order(hosts: DataFrame, split: DataFrame) -> DataFrame:
    """(host, host_words) with the words of each host's runs where they stand."""
    runs = hosts.select("host", F.posexplode(F.regexp_extract_all(F.lower("host"), F.lit(r"\p{L}+|\p{N}+"), F.lit(0))))
    placed = runs.join(split, runs["col"] == split["label"]).groupBy("host")
    in_order = F.sort_array(F.collect_list(F.struct("pos", "words")))  # the labels of one host
    return placed.agg(F.array_join(F.flatten(F.transform(in_order, lambda x: x["words"])), " ").alias("host_words"))
