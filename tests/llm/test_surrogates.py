"""What becomes of mentions, and that surrogates keep entities apart."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from feedloom.llm import surrogates

SCHEMA = "doc_id bigint, text string, place int, kind string, n_entities int"


def replaced(spark, texts, key="k"):
    docs = spark.createDataFrame([(i, text, 0, "", 0) for i, text in enumerate(texts)], SCHEMA)
    return {r["doc_id"]: (r["text"], r["n_entities"]) for r in surrogates.pseudonymized(docs, key).collect()}


def luhn(digits):
    return sum(n if i % 2 == 0 else 2 * n - 9 * (n > 4) for i, n in enumerate(map(int, reversed(digits)))) % 10 == 0


def test_kinds(spark):
    texts = [
        "Mr John Smith met Mrs Smith. JOHN? +1 (974) 555-3436 or +19745553436.",
        "Foo.Bar@Mail7.Example.com and foo.bar@mail7.example.com, a@b.co!",
        "4111 1111 1111 1111 and 4111111111111111, not 4111111111111112",
        "192.168.1.7 300.1.1.1 8.8.8.8 1.2.3.4.5 v1.2.3.4 123-45-6789",
        "Госпожа Анна Белова, Monsieur DUPONT, Maria Weber, Κύριος Νίκος Ιωάννου",
        None, "", "nothing here 12345 a@b", "john smith", "x@y.org " * 3000,
    ]
    found = replaced(spark, texts)
    first = found[0][0]
    name = re.fullmatch(r"Mr (\w+) ([\w-]+) met Mrs ([\w-]+)\. JOHN\? (\+1 \(\d{3}\) \d{3}-\d{4}) or (\+1\d{10})\.", first)
    assert name and name[2] == name[3] and name[1] in surrogates.GIVEN["latin", "m"] and re.sub(r"[^+\d]", "", name[4]) == name[5]
    assert found[0][1] == 5 and "Smith" not in first and "555-3436" not in first
    one, two = re.fullmatch(r"(\S+) and (\S+), \w@\w\.co!", found[1][0]).groups()
    assert one.lower() == two and re.fullmatch(r"[A-Z][a-z]{2}\.[A-Z][a-z]{2}@[A-Z][a-z]{3}\d\.[A-Z][a-z]{6}\.com", one)
    card, bare = re.fullmatch(r"(\d{4} \d{4} \d{4} \d{4}) and (\d{16}), not 4111111111111112", found[2][0]).groups()
    assert card.replace(" ", "") == bare and luhn(bare) and bare[0] == "4" and bare != "4111111111111111"
    parts = found[3][0].split()
    assert parts[0].startswith("192.168.") and parts[0] != "192.168.1.7" and parts[1] == "300.1.1.1" and parts[3:5] == ["1.2.3.4.5", "v1.2.3.4"]
    assert all(int(x) < 256 for x in parts[2].split(".")) and parts[5].startswith("9") and len(parts[5]) == 11
    other = re.fullmatch(r"Госпожа (\w+) (\S+), Monsieur (\S+), (\w+) (\S+), Κύριος (\w+) (\S+)", found[4][0])
    assert other[1] in surrogates.GIVEN["cyrillic", "f"] and other[3].isupper() and other[4] in surrogates.GIVEN["latin", "f"]
    assert other[6] in surrogates.GIVEN["greek", "m"] and found[4][1] == 7
    assert [found[i] for i in range(5, 9)] == [(None, 0), ("", 0), ("nothing here 12345 a@b", 0), ("john smith", 0)]
    assert found[9][1] == 3000 and len(set(found[9][0].split())) == 1
    assert replaced(spark, texts) == found and replaced(spark, texts, "other")[2] != found[2]


def test_forms_of_numbers(spark):
    shaped = [
        "555 123 4567", "1-800-555-0199", "1 (800) 555-0199", "0171 1234567", "030/1234567", "(0171) 123 4567", "020 7946 0958",
        "03-1234-5678", "01 23 45 67 89", "01.23.45.67.89", "01711234567", "+298 123456", "+290 1234", "+33 1 23 45 67 89",
        "+44 (0)20 7946 0958", "3782 822463 10005", "3782-822463-10005",
    ]
    left = ["on 01-02-2003 12:30", "01.02.2003", "3782 822463 10006", "1 000 000", "10 000 000 000", "1 012 345 678", "+12 34", "007", "0.1234567", "2024-01-05"]
    found = replaced(spark, [f"call {number}, now" for number in shaped] + left)
    for i, number in enumerate(shaped):
        new = re.fullmatch(r"call (.*), now", found[i][0])[1]
        assert found[i][1] == 1 and new != number and re.sub(r"\d", "0", new) == re.sub(r"\d", "0", number), (number, new)
        assert number[0] not in "0+(" or re.sub(r"\D", "", new)[0] == re.sub(r"\D", "", number)[0], (number, new)
    assert [found[len(shaped) + i] for i in range(len(left))] == [(text, 0) for text in left]
    card = found[shaped.index("3782 822463 10005")][0]
    assert luhn(re.sub(r"\D", "", card)) and re.sub(r"\D", "", card) == re.sub(r"\D", "", found[len(shaped) - 1][0])


def test_different_entities_stay_different(spark):
    # 26 one-letter names at a domain cannot all get another one; all 30 listed surnames are in use.
    names = [f"Mr {name}" for name in surrogates.SURNAMES["latin"]] + [f"Mr Xa{chr(97 + i)}" for i in range(26)]
    texts = [f"{chr(97 + i)}@site.org" for i in range(26)] + names
    found = replaced(spark, texts)
    new = [found[i][0] for i in range(len(texts))]
    assert len(set(new)) == len(new) and not set(new) & set(texts) and all(found[i][1] == 1 for i in found)


def test_used_up_kinds_are_an_error(spark):
    docs = spark.createDataFrame([("ssn", f"{i:09d}") for i in range(5)], "kind string, same string")
    used = docs.withColumn("kind", F.lit("card")).withColumn("same", F.concat(F.lit("4"), F.substring("same", 9, 1)))
    assert surrogates.surrogates(docs, "k").select("surrogate").distinct().count() == 5
    with pytest.raises(ValueError, match="no surrogates are left"):
        surrogates.surrogates(used, "k").count()


def test_rows(spark):
    docs = spark.createDataFrame([(None, "a@b.co", 0, "", 0), (1, "a@b.co", 0, "", 0), (1, "a@b.co", 0, "", 0)], SCHEMA)
    rows = surrogates.pseudonymized(docs, "k").collect()
    assert len(rows) == 3 and len({r["text"] for r in rows}) == 1 and rows[0]["text"] != "a@b.co"
    assert surrogates.pseudonymized(docs.limit(0), "k").count() == 0


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "a@b.co", 0, "", 0)], SCHEMA)
    plan = surrogates.pseudonymized(docs, "k")._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


INSIDES = ["a.", "a", "1 ", "12-", "1234 ", "+1 ", "(1) ", "0.", "a@", "a-", "a@b.", "1.1.1.", "Mr ", "Mr A", "Ä", "_+-.", "030/", "@.", "4111-"]


def test_no_text_is_too_long(spark):
    """Thousands of turns of what the patterns repeat: no stack ends, and what follows is still found."""
    texts = [f"1 {inside * 6_000}{end} \n x.y@z.org" for inside in INSIDES for end in ("b", "@b.org")]
    found = replaced(spark, texts)
    assert len(found) == len(texts) and all("x.y@z.org" not in text for text, _ in found.values())


def test_whole_private_networks(spark):
    """More than half of a network's addresses are in the corpus: all get others of it, each another one."""
    addresses = spark.range(60_000).selectExpr("'ip' AS kind", "concat('192.168.', id DIV 256, '.', id % 256) AS same")
    more = spark.range(2_000).selectExpr("'ip' AS kind", "concat(if(id % 2 = 0, '10.', '172.16.'), if(id % 2 = 0, '1.', ''), id DIV 256, '.', id % 256) AS same")
    found = surrogates.surrogates(addresses.union(more), "k").collect()
    assert len(found) == 62_000 == len({r["surrogate"] for r in found}) and all(r["same"] != r["surrogate"] for r in found)
    network = re.compile(r"(10|192\.168|172\.16)((?:\.(?:25[0-5]|2[0-4]\d|1?\d?\d)){2,3})")
    for row in found:
        a, b = network.fullmatch(row["same"]), network.fullmatch(row["surrogate"])
        assert a[1] == b[1] and a[2].count(".") == b[2].count(".")
