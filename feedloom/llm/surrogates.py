"""Personal data in texts replaced by surrogates of the same kind; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import Scratch, exact

# Titles and given names by gender, surnames by script. Surrogates are drawn from the same lists.
TITLES = {
    "m": ("Mr", "Mister", "Herr", "Monsieur", "Señor", "Господин", "Κύριος"),
    "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Señora", "Госпожа", "Κυρία"),
}
GIVEN = {
    ("latin", "m"): (
        "Adrian", "Arthur", "Benjamin", "Charles", "Christian", "Daniel", "David", "Edward", "Felix", "Frank", "Georg",
        "Hector", "James", "Jean", "John", "Jorge", "Lucas", "Luis", "Martin", "Michael", "Oscar", "Paul", "Peter",
        "Philippe", "Robert", "Stefan", "Thomas", "Victor", "Walter", "William",
    ),
    ("latin", "f"): (
        "Alice", "Amelie", "Barbara", "Beatriz", "Carmen", "Charlotte", "Clara", "Diana", "Elena", "Elizabeth", "Emma",
        "Franziska", "Hannah", "Helen", "Ingrid", "Isabel", "Jane", "Julia", "Katharina", "Laura", "Louise", "Maria",
        "Marta", "Mary", "Nicole", "Patricia", "Sarah", "Sophie", "Susanne", "Teresa",
    ),
    ("cyrillic", "m"): ("Алексей", "Андрей", "Борис", "Виктор", "Дмитрий", "Иван", "Михаил", "Николай", "Павел", "Сергей"),
    ("cyrillic", "f"): ("Анна", "Вера", "Елена", "Ирина", "Мария", "Наталья", "Ольга", "Светлана", "Софья", "Татьяна"),
    ("greek", "m"): ("Αλέξανδρος", "Ανδρέας", "Γιώργος", "Δημήτρης", "Κώστας", "Μιχάλης", "Νίκος", "Παύλος"),
    ("greek", "f"): ("Αγγελική", "Άννα", "Βασιλική", "Ειρήνη", "Ελένη", "Κατερίνα", "Μαρία", "Σοφία"),
}
SURNAMES = {
    "latin": (
        "Abbott", "Bauer", "Blanc", "Castillo", "Clarke", "Dubois", "Ellis", "Fischer", "Garnier", "Gomez", "Harris",
        "Hoffmann", "Iglesias", "Jensen", "Keller", "Lambert", "Lehmann", "Marin", "Morgan", "Navarro", "Olsen", "Parker",
        "Perrin", "Quinn", "Richter", "Romero", "Schuster", "Taylor", "Vidal", "Weber",
    ),
    "cyrillic": ("Белов", "Волков", "Зайцев", "Козлов", "Лебедев", "Морозов", "Новиков", "Орлов", "Петров", "Соколов"),
    "greek": ("Αγγελίδης", "Βασιλείου", "Γεωργίου", "Δημητρίου", "Ιωάννου", "Κωνσταντίνου", "Νικολάου", "Παπαδάκης"),
}

#: Rounds of drawing after which a kind's surrogates count as used up, which is an error.
ROUNDS = 64
# A group that repeats without a bound must be possessive, or a long text takes a frame of the stack for each turn. The
# labels of a domain need to be given back, so they have the bound that names have: 127 labels.
_EMAIL = r"[\p{L}\p{N}_+-]++(?:\.[\p{L}\p{N}_+-]++)*+@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++){0,125}\.\p{L}{2,24}"
#: International; North American, with or without its trunk 1; with a trunk 0, each grouping with one kind of separator.
_PHONE = "|".join(
    (
        r"\+\d{1,3}[ .-]?(?:\(0\) ?)?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){1,4}",
        r"(?:1[ .-]?)?\(\d{3}\) ?\d{3}[ .-]\d{4}",
        r"(?:1[ .-])?\d{3}[ .-]\d{3}[ .-]\d{4}",
        r"(?<!\d )0[1-9](?:(?: \d{2}){4}|(?:\.\d{2}){4}|(?:-\d{2}){4})",
        r"(?<!\d )(?:0[1-9]\d{0,3}|\(0[1-9]\d{0,3}\))(?:(?: \d{3,4}){2}|(?:-\d{3,4}){2})",
        r"(?<!\d )(?:0[1-9]\d{1,3}[ /-]|\(0[1-9]\d{0,3}\) ?)(?:\d{5,8}|\d{2,4}(?: \d{2}){2}|\d{3,4}[ -]\d{3,4})",
        r"0[1-9]\d{8,9}",
    )
)
_CARD = r"\d{4}(?:[ -]?\d{4}){2}[ -]?\d{1,7}|\d{4}[ -]\d{6}[ -]\d{4,5}|\d{13,19}"
_SSN = r"\d{3}-\d{2}-\d{4}"
_IP = r"\d{1,3}(?:\.\d{1,3}){3}"
_LONGEST_NAME = 24


def _names() -> dict[str, str]:
    """Patterns of name parts: after a title, from the lists, or after either; look-behind only at a capital letter."""
    titles = {gender: "|".join(words) for gender, words in TITLES.items()}
    given = {gender: "|".join(x for key, words in GIVEN.items() if key[1] == gender for x in words) for gender in "mf"}
    any_title, any_given = "|".join(titles.values()), "|".join(given.values())
    rest, more = rf"\p{{L}}{{1,{_LONGEST_NAME}}}(?!\p{{L}})", r"(?=[  ]\p{Lu}\p{Ll})"
    patterns = {
        f"given_{gender}": rf"\p{{Lu}}(?<=(?<!\p{{L}})(?:{titles[gender]})\.?[  ].){rest}{more}"
        rf"|(?<!\p{{L}})(?:{given[gender]})(?!\p{{L}}){more}"
        for gender in "mf"
    }
    name = rf"\p{{Lu}}\p{{L}}{{1,{_LONGEST_NAME}}}"
    patterns["surname"] = (
        rf"\p{{Lu}}(?<=(?<!\p{{L}})(?:{any_title})\.?[  ](?:{name}[  ])?.){rest}"
        rf"|\p{{Lu}}(?<=(?<!\p{{L}})(?:{any_given})[  ].){rest}"
    )
    return patterns


_NAMES = _names()
_NUMBER = rf"(?<![\w.+-])(?:{_PHONE}|{_SSN}|{_CARD}|{_IP})(?![\w-]|\.\d)"
#: Any mention; its groups 1 to 3 are the kinds of name parts.
MENTION = "|".join([rf"(?<![\p{{L}}\p{{N}}_.+-]){_EMAIL}(?![\p{{L}}\p{{N}}_-])", _NUMBER, *(f"({p})" for p in _NAMES.values())])


#: What every text with a mention has, found far faster than a mention.
_HINT = rf"[0-9@]|(?=\p{{Lu}})(?<!\p{{L}})(?:{'|'.join(x for words in (*TITLES.values(), *GIVEN.values()) for x in words)})(?!\p{{L}})"


def has_mention(text: str) -> Column:
    return F.coalesce(F.col(text).rlike(_HINT) & F.col(text).rlike(MENTION), F.lit(False))


def _luhn(digits: str, first: int) -> str:
    """SQL for the Luhn sum of a digit string; its last digit counts as it is if ``first`` is 0, doubled if 1."""
    digit = f"int(substr({digits}, length({digits}) - i, 1))"
    doubled = f"if({digit} > 4, 2 * {digit} - 9, 2 * {digit})"
    return f"aggregate(sequence(0, length({digits}) - 1), 0, (sum, i) -> sum + if((i + {first}) % 2 = 1, {doubled}, {digit}))"


_DIGITS = r"regexp_replace(surface, '[^0-9]', '')"
_KIND = rf"""
CASE WHEN given_m <> '' THEN 'given_m' WHEN given_f <> '' THEN 'given_f' WHEN surname <> '' THEN 'surname'
     WHEN surface LIKE '%@%' THEN 'email'
     WHEN surface RLIKE r'^{_SSN}$' THEN 'ssn'
     WHEN surface RLIKE r'^{_IP}$' THEN
        CASE WHEN forall(split(surface, '[.]'), x -> int(x) <= 255) THEN 'ip' END
     WHEN surface RLIKE r'^(?:{_PHONE})$' AND surface LIKE '+%' AND length({_DIGITS}) BETWEEN 7 AND 9 THEN 'short_phone'
     WHEN surface RLIKE r'^(?:{_PHONE})$' AND length({_DIGITS}) BETWEEN if(surface RLIKE '^[(]?0', 9, 10) AND 15 THEN 'phone'
     WHEN surface RLIKE r'^(?:{_CARD})$' AND length({_DIGITS}) BETWEEN 13 AND 19 THEN
        CASE WHEN {_luhn(_DIGITS, 0)} % 10 = 0 THEN 'card' END
END"""
_SCRIPT = r"CASE WHEN surface RLIKE '\\p{IsCyrillic}' THEN 'cyrillic' WHEN surface RLIKE '\\p{IsGreek}' THEN 'greek' ELSE 'latin' END"
_SAME = f"CASE WHEN kind IN ('phone', 'short_phone', 'card', 'ssn') THEN {_DIGITS} ELSE lower(surface) END"


def mentions(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """(text_key, place, surface, kind, same) of the mentions in each different text that has any.

    ``kind`` is NULL where a match is not personal data after all: numbers that
    are no card number by their check digit, addresses above 255. ``same`` is
    equal for mentions of the same thing, however they are written.
    """
    texts = docs.select(F.col(text_column).alias("text")).where(has_mention("text"))
    every = [F.regexp_extract_all("text", F.lit(MENTION), F.lit(i)) for i in range(4)]
    found = texts.select(F.md5("text").alias("text_key"), *(x.alias(f"g{i}") for i, x in enumerate(every)))
    found = found.groupBy("text_key").agg(*(F.first(f"g{i}").alias(f"g{i}") for i in range(4)))
    zipped = F.arrays_zip(*(F.col(f"g{i}") for i in range(4)))
    rows = found.select("text_key", F.posexplode(zipped).alias("place", "hit"))
    rows = rows.select(
        "text_key", "place", *(F.col("hit")[f"g{i}"].alias(name) for i, name in enumerate(("surface", *_NAMES)))
    )
    rows = rows.withColumn("kind", F.expr(_KIND))
    kind = F.when(F.col("kind").isin(*_NAMES), F.concat_ws("_", "kind", F.expr(_SCRIPT))).otherwise(F.col("kind"))
    return rows.select("text_key", "place", "surface", "kind", F.expr(_SAME).alias("same")).withColumn("kind", kind)


def _pick(i: str, n: str) -> str:
    """SQL for a keyed number below ``n``: byte ``i`` of the digest, and the next one."""
    return f"int(conv(substr(digest, 1 + 2 * (({i}) % 31), 4), 16, 10)) % {n}"


def _letters(text: str, salt: int = 0) -> str:
    """SQL that maps a text letter for letter and digit for digit, within its script."""
    i = f"i + {salt}"
    return f"""array_join(transform(split({text}, ''), (c, i) -> CASE
        WHEN c RLIKE '[0-9]' THEN string({_pick(i, '10')})
        WHEN c RLIKE '\\\\p{{IsCyrillic}}' THEN substr('абвгдежзиклмнопрстуфхцчшэюя', 1 + {_pick(i, '27')}, 1)
        WHEN c RLIKE '\\\\p{{IsGreek}}' THEN substr('αβγδεζηθικλμνξοπρστυφχψω', 1 + {_pick(i, '24')}, 1)
        WHEN c RLIKE '\\\\p{{L}}' THEN substr('abcdefghijklmnopqrstuvwxyz', 1 + {_pick(i, '26')}, 1)
        ELSE c END), '')"""


def _drawn_digits(kept: str, low: str) -> str:
    """SQL: the digits of ``same``, the first ``kept`` as they are, the next one from 2 on, all others drawn."""
    return f"""array_join(transform(split({low}, ''), (c, i) -> CASE
        WHEN i < {kept} THEN c WHEN i = {kept} THEN string(2 + {_pick('i', '8')}) ELSE string({_pick('i', '10')}) END), '')"""


def _listed(words: tuple[str, ...]) -> str:
    """SQL: a word of a list; from the sixth round on two, from the twelfth on three, and so on."""
    array = "array(" + ", ".join(f"'{word}'" for word in words) + ")"
    pick = _pick("3 * j", str(len(words)))
    return f"array_join(transform(sequence(0, int(round / 6)), j -> {array}[{pick}]), '-')"


def _surrogate() -> Column:
    """What an entity (kind, same, digest, round, domain_digest) gets in a round."""
    payload = f"substr({_drawn_digits('1', 'same')}, 1, length(same) - 1)"
    card = f"concat({payload}, string((10 - {_luhn(payload, 1)} % 10) % 10))"
    octets = f"""concat_ws('.', string(11 + {_pick('0', '116')}), string({_pick('2', '256')}), string({_pick('6', '256')}),
        string({_pick('8', '256')}))"""
    local = "substring_index(same, '@', 1)"
    longer = _letters("repeat('a', int(round / 8))", 7)
    domain = "substring_index(same, '@', -1)"
    name = f"substr({domain}, 1, length({domain}) - length(substring_index({domain}, '.', -1)) - 1)"
    email = f"""concat({_letters(local)}, {longer}, '@', {_letters(name).replace('digest', 'domain_digest')}, '.',
        substring_index({domain}, '.', -1))"""
    names = {f"given_{gender}_{script}": _listed(words) for (script, gender), words in GIVEN.items()}
    names |= {f"surname_{script}": _listed(words) for script, words in SURNAMES.items()}
    listed = " ".join(f"WHEN '{kind}' THEN lower({sql})" for kind, sql in names.items())
    return F.expr(
        f"""CASE kind WHEN 'email' THEN {email} WHEN 'card' THEN {card} WHEN 'ip' THEN {octets}
        WHEN 'phone' THEN {_drawn_digits("if(length(same) > 10 OR same LIKE '0%', 1, 0)", 'same')}
        WHEN 'short_phone' THEN {_drawn_digits('1', 'same')}
        WHEN 'ssn' THEN concat('9', substr({_drawn_digits('0', 'same')}, 2)) {listed} END"""
    )


#: Private networks: what stays of an address; the rest, 16 or 24 bits, is permuted.
_PRIVATE = r"^(?:(10|127)[.]|(192[.]168|172[.](?:1[6-9]|2[0-9]|3[01]))[.])"


def _permuted(addresses: DataFrame, key: str) -> DataFrame:
    """(kind, same, surrogate) of private addresses: another address of the same network, by a keyed permutation.

    Networks are closed: an address can only get one of its network, of which
    the corpus may hold all. So these are not drawn: four rounds of a Feistel
    cipher number the addresses of a network, and each gets the one that has
    the next number, which is never itself. Different addresses get different
    ones, whatever else is in the corpus.
    """
    prefix = F.concat(*(F.regexp_extract("same", _PRIVATE, i) for i in (1, 2)))
    octets = F.transform(F.slice(F.split("same", "[.]"), -3, 3), lambda x: x.cast("int"))
    rows = addresses.select("kind", "same", prefix.alias("prefix"), octets.alias("o"), F.expr("if(same RLIKE '^(10|127)[.]', 12, 8)").alias("half"))
    number = F.expr("if(half = 12, o[0] * 65536 + o[1] * 256 + o[2], o[1] * 256 + o[2])")
    rows = rows.withColumn("size", F.expr("shiftleft(1, half)")).withColumn("number", number)
    rows = rows.withColumns({"left": F.expr("number DIV size"), "right": F.expr("number % size")})

    def mixed(side: str, n: int):
        digest = F.sha2(F.concat_ws("\x1f", F.lit(key), F.lit("network"), "prefix", F.lit(str(n)), F.col(side).cast("string")), 256)
        return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % F.col("size")

    for n in range(4):
        rows = rows.withColumns({"left": F.col("right"), "right": F.col("left").bitwiseXOR(mixed("right", n))})
    rows = rows.withColumn("next", F.expr("(left * size + right + 1) % (size * size)"))
    rows = rows.withColumns({"left": F.expr("next DIV size"), "right": F.expr("next % size")})
    for n in reversed(range(4)):
        rows = rows.withColumns({"right": F.col("left"), "left": F.col("right").bitwiseXOR(mixed("left", n))})
    found = F.expr("left * size + right")
    parts = [F.when(F.col("half") == 12, F.expr("(left * size + right) DIV 65536").cast("string"))]
    parts += [F.expr("(left * size + right) DIV 256 % 256").cast("string"), (found % 256).cast("string")]
    return rows.select("kind", "same", F.concat_ws(".", "prefix", *parts).alias("surrogate"))


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(kind, same, surrogate) of distinct ``entities`` (kind, same), in the shared folder.

    A surrogate is drawn by a keyed digest of the entity and the round. It is
    accepted if no other entity of the kind has it or was accepted with it and
    no entity of the corpus is written so; of several that draw the same, the
    first in order of ``same`` gets it. The others draw again, so all end with
    different surrogates. Each round joins only what is left. Private addresses
    are permuted instead.
    """
    scratch = Scratch(entities.sparkSession)
    entities = scratch.write(entities, "entities")
    private = F.coalesce((F.col("kind") == "ip") & F.col("same").rlike(_PRIVATE), F.lit(False))
    permuted = scratch.write(_permuted(entities.where(private), key), "permuted")
    left, accepted = entities.where(~private), []
    for n in range(ROUNDS):
        keyed = F.concat_ws("\x1f", F.lit(key), "kind", "same", F.lit(str(n)))
        domain = F.concat_ws("\x1f", F.lit(key), F.lit("domain"), F.substring_index("same", "@", -1))
        drawn = left.select(
            "kind",
            "same",
            F.sha2(F.concat(F.lit(key), F.sha2(keyed, 256)), 256).alias("digest"),
            F.sha2(F.concat(F.lit(key), F.sha2(domain, 256)), 256).alias("domain_digest"),
            F.lit(n).alias("round"),
        )
        drawn = scratch.write(drawn.select("kind", "same", _surrogate().alias("surrogate")), "drawn")
        taken = entities.select("kind", F.col("same").alias("surrogate"))
        for earlier in accepted:
            taken = taken.union(earlier.select("kind", "surrogate"))
        free = drawn.join(taken, ["kind", "surrogate"], "left_anti")
        good = free.groupBy("kind", "surrogate").agg(F.min("same").alias("same")).select("kind", "same", "surrogate")
        accepted.append(scratch.write(good, "surrogates"))
        left = scratch.write(drawn.select("kind", "same").join(accepted[-1], ["kind", "same"], "left_anti"), "entities")
        if left.isEmpty():
            break
    else:
        raise ValueError(f"no surrogates are left for some kind of entity after {ROUNDS} rounds")
    result = permuted
    for further in accepted:
        result = result.union(further)
    return result


# The surrogate in the format of the mention: digits poured into its punctuation, letters in its case.
_WRITTEN = """
CASE WHEN surrogate IS NULL THEN surface
     WHEN kind IN ('phone', 'short_phone', 'card', 'ssn') THEN
        aggregate(split(surface, ''), struct('' AS out, 1 AS k),
            (s, c) -> if(c RLIKE '[0-9]', struct(concat(s.out, substr(surrogate, s.k, 1)) AS out, s.k + 1 AS k),
                                          struct(concat(s.out, c) AS out, s.k AS k)), s -> s.out)
     WHEN kind = 'email' THEN
        array_join(transform(split(surrogate, ''), (c, i) -> if(substr(surface, i + 1, 1) RLIKE '\\\\p{Lu}', upper(c), c)), '')
     WHEN kind = 'ip' THEN surrogate
     WHEN surface = upper(surface) THEN upper(surrogate)
     ELSE array_join(transform(split(surrogate, '-'), x -> concat(upper(substr(x, 1, 1)), substr(x, 2))), '-') END
"""


def pseudonymized(docs: DataFrame, key: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Every row's id, its text with surrogates, and ``n_entities``, the number of mentions replaced.

    Kinds: e-mail addresses, phone numbers, payment cards (with a right check
    digit), social security numbers, IPv4 addresses, and given and family names
    after a title or from the lists. A surrogate has the kind, format, script,
    gender, country zone, card brand digit and private range of what it stands
    for, and a right check digit. With one key, the same entity has the same
    surrogate in all texts, however it is written, and different ones have
    different ones; no surrogate is an entity of the corpus, but that private
    addresses get others of their network, all of which may be there.

    A NULL text stays NULL with 0 entities; texts without a mention stay as they
    are. Rows with repeated ids or none are rows; no row gives no row; further
    columns are not read. Only texts with mentions are shuffled, by digest, and
    equal ones are searched once. Only DataFrame functions are used.
    """
    rows = exact(docs, id_column, text_column).toDF("id", "text")
    scratch = Scratch(docs.sparkSession)
    found = scratch.write(mentions(rows), "mentions")
    entities = found.where("kind IS NOT NULL").select("kind", "same").distinct()
    known = surrogates(entities, key).withColumnsRenamed({"kind": "of", "same": "entity"})
    joined = found.join(known, (found["kind"] == known["of"]) & (found["same"] == known["entity"]), "left")
    written = joined.select("text_key", "place", F.expr(_WRITTEN).alias("new"), F.col("surrogate").isNotNull().alias("replaced"))
    per_text = written.groupBy("text_key").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("place", "new"))), lambda x: x["new"]).alias("new"),
        F.count(F.when(F.col("replaced"), 1)).alias("n_entities"),
    )
    per_text = scratch.write(per_text, "replacements")
    has = has_mention("text")
    pieces = F.split("text", MENTION, -1)
    between = F.zip_with(pieces, "new", lambda piece, new: F.concat(piece, F.coalesce(new, F.lit(""))))
    changed = rows.where(has).join(per_text, F.md5("text") == F.col("text_key"))
    changed = changed.select("id", F.array_join(between, "").alias("text"), "n_entities")
    return changed.union(rows.where(~has).select("id", "text", F.lit(0).cast("long"))).toDF(id_column, text_column, "n_entities")
