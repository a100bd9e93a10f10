"""Surrogates for personal data: keyed, type-consistent, distinct and consistent.

Entities are found by patterns: e-mail addresses, telephone and card numbers, IPv4 and
IPv6 addresses, social security and bank account numbers, and first names of a lexicon with
the surnames that follow them or a form of address. Each distinct (kind, canonical value)
of the corpus gets one surrogate, so all mentions of a value agree in all documents:

* digits stay digits, in the places and with the separators of each mention; card numbers
  keep their first digit and a valid check digit, and numbers without one are left alone;
* a ten-digit telephone number that starts with 2-9 is the same value as with +1 before it;
  a leading 0 stays;
* IPv6 addresses become full ones below 2001:db8;
* e-mail addresses become addresses below the reserved name ``example``;
* first names become names of the same gender and script, by a keyed rotation of the
  lexicon, which cannot collide; surnames are built from syllables of their script; the
  case of each mention is kept.

Surrogates are drawn from SHA-512 of key, kind, value and attempt. A draw that equals a
value of the corpus, or a surrogate given before, is drawn again with the next attempt;
of several equal draws the least value keeps it. The loop ends when every value has its
own surrogate, and raises an error rather than let two values share one.

All of it is built-in functions. Only values are shuffled for the drawing; the texts that
hold an entity meet their surrogates by one join, the others are not moved. Mentions are
counted per value in map tasks, and Spark splits the join where one value is very common.

Defined cases: null texts stay null, texts without entities stay as they are. Rows are
told apart by document id and text, and repeated rows come out alike. Extra columns are
kept; ``text`` is replaced and ``n_entities`` added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotcast.llm.common import fresh, staged

ATTEMPTS = 64
KEY = "surrogates"

#: First names by script and gender, fixed values; each row is rotated by the key.
FIRST_NAMES = {
    ("latin", "f"): (
        "Alice", "Barbara", "Carmen", "Catherine", "Deborah", "Elisabeth", "Emma", "Françoise",
        "Gabriela", "Hannah", "Heike", "Isabella", "Jennifer", "Karen", "Laura", "Linda",
        "Margaret", "Mary", "Natalie", "Olivia", "Patricia", "Rebecca", "Sandra", "Susanne",
        "Teresa", "Ursula", "Valérie", "Yolanda",
    ),
    ("latin", "m"): (
        "Alexander", "Andreas", "Antonio", "Benjamin", "Carlos", "Charles", "Daniel", "David",
        "Edward", "François", "Gerhard", "Henry", "Hubert", "James", "Javier", "John",
        "Klaus", "Michael", "Nicholas", "Oliver", "Patrick", "Richard", "Robert", "Stephen",
        "Thomas", "Ulrich", "Walter", "William",
    ),
    ("cyrillic", "f"): ("Анна", "Валентина", "Екатерина", "Елена", "Ирина", "Мария", "Наталья", "Ольга"),
    ("cyrillic", "m"): ("Александр", "Алексей", "Андрей", "Владимир", "Дмитрий", "Иван", "Михаил", "Сергей"),
    ("greek", "f"): ("Αικατερίνη", "Βασιλική", "Ελένη", "Μαρία"),
    ("greek", "m"): ("Γεώργιος", "Δημήτριος", "Ιωάννης", "Κωνσταντίνος"),
}
ADDRESSES = ("Mr", "Mrs", "Ms", "Dr", "Herr", "Frau", "Señor", "Señora", "Monsieur", "Madame")
SYLLABLES = {
    "latin": ("ba", "del", "fen", "gar", "hol", "ker", "lin", "mor", "nes", "pol", "ras", "tev", "vin", "wal", "zan", "dor"),
    "cyrillic": ("ба", "дел", "фен", "гар", "хол", "кер", "лин", "мор", "нес", "пол", "рас", "тев", "вин", "вал", "зан", "дор"),
    "greek": ("βα", "δελ", "φεν", "γαρ", "χολ", "κερ", "λιν", "μορ", "νες", "πολ", "ρας", "τεβ", "βιν", "βαλ", "ζαν", "δορ"),
}

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IP = rf"(?<![0-9.]){OCTET}(?:\.{OCTET}){{3}}(?![0-9]|\.[0-9])"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
HEXTET = "[0-9A-Fa-f]{1,4}"
#: Eight groups, or a shortened address of an assigned range (2000::/3, fc00::/6).
IP6 = (
    rf"(?<![0-9A-Za-z:.])(?:{HEXTET}(?::{HEXTET}){{7}}"
    rf"|(?:[23][0-9A-Fa-f]{{3}}|[Ff][C-Fc-f][0-9A-Fa-f]{{2}})(?::{HEXTET}){{0,5}}::(?:{HEXTET}(?::{HEXTET}){{0,5}})?)"
    r"(?![0-9A-Za-z:])"
)
CARD = (
    r"(?<![0-9A-Za-z.+-])(?:[2-6][0-9]{3}(?:[ -]?[0-9]{4}){2}[ -]?[0-9]{3,4}|3[47][0-9]{2}[ -]?[0-9]{6}[ -]?[0-9]{5})"
    r"(?![0-9A-Za-z]|[.-][0-9])"
)
PHONE = (
    r"(?<![0-9A-Za-z.])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{3}[ .-])"
    r"[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z])"
    r"|(?<![0-9A-Za-z.])\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,4}(?![0-9A-Za-z])"
    r"|(?<![0-9A-Za-z.])0[0-9](?:[ .-][0-9]{2}){4}(?![0-9A-Za-z]|[.-][0-9])"
    r"|(?<![0-9A-Za-z.-])0[0-9]{1,4}[ /-][0-9]{5,8}(?![0-9A-Za-z]|[.-][0-9])"
)
SSN = r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"
_NAMES = "|".join(n for names in FIRST_NAMES.values() for x in names for n in (x, x.upper()))
FIRST = rf"(?<!\p{{L}})(?:{_NAMES})(?!\p{{L}})"
SURNAME = (
    rf"(?<=(?<!\p{{L}})(?:{_NAMES}|(?:{'|'.join(ADDRESSES)})\.?)\h{{1,3}})\p{{Lu}}\p{{L}}{{2,}}(?!\p{{L}})"
)
NUMBERS = "|".join((EMAIL, IP, IP6, IBAN, SSN, CARD, PHONE))
EVERYTHING = f"{NUMBERS}|{FIRST}|{SURNAME}"
#: A text that neither of these finds holds no entity.
HAS_NUMBER = "[0-9@]|::"
HAS_NAME = rf"(?<!\p{{L}})(?:{_NAMES}|{'|'.join(ADDRESSES)})(?!\p{{L}})"


def kind_of(value: Column) -> Column:
    """The kind of a whole mention; the order of the patterns decides between them.

    Null for a number that looks like a card's but fails its check digit.
    """
    kinds = (("email", EMAIL), ("ip", IP), ("ip6", IP6), ("iban", IBAN), ("ssn", SSN), ("card", CARD), ("phone", PHONE), ("first", FIRST))
    kind = F.lit("last")
    for name, pattern in reversed(kinds):
        kind = F.when(value.rlike(f"^(?:{pattern})$"), name).otherwise(kind)
    digits = F.regexp_replace(value, "[^0-9]", "")
    invalid = (kind == "card") & (F.pmod(luhn_sum(digits), F.lit(10)) != 0)
    return F.when(~invalid, kind)


def _full_ip6(value: Column) -> Column:
    """All eight groups of four digits of an IPv6 address."""
    groups = lambda i: F.filter(F.split(F.split_part(F.lower(value), F.lit("::"), F.lit(i)), ":"), lambda x: x != "")
    missing = F.array_repeat(F.lit("0"), 8 - F.size(groups(1)) - F.size(groups(2)))
    return F.array_join(F.transform(F.concat(groups(1), missing, groups(2)), lambda x: F.lpad(x, 4, "0")), ":")


def canonical(kind: Column, value: Column) -> Column:
    """What all mentions of one entity share: lower case, or digits and capitals alone."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    national = (kind == "phone") & value.rlike("^[^+]") & digits.rlike("^[2-9][0-9]{9}$")
    return F.when(national, F.concat(F.lit("1"), digits)).when(
        kind.isin("card", "phone", "ssn"), digits
    ).when(kind == "iban", F.regexp_replace(value, " ", "")).when(kind == "ip", value).when(
        kind == "ip6", _full_ip6(value)
    ).otherwise(F.lower(value))


def _draw(stream: Column, i: Column, sides: int) -> Column:
    """The i-th throw of a die from hexadecimal digits of a hash."""
    at = F.pmod(i, F.lit(32)) * 4 + 1
    return F.pmod(F.conv(F.substr(stream, at, F.lit(4)), 16, 10).cast("int"), F.lit(sides))


def _alike(value: Column, stream: Column) -> Column:
    """Every digit and letter replaced by one of its class."""

    def swap(ch: Column, i: Column) -> Column:
        pick = lambda letters: F.substr(F.lit(letters), _draw(stream, i, len(letters)) + 1, F.lit(1))
        return (
            F.when(ch.rlike("[0-9]"), pick("0123456789"))
            .when(ch.rlike("[a-z]"), pick("abcdefghijklmnopqrstuvwxyz"))
            .when(ch.rlike("[A-Z]"), pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
            .otherwise(ch)
        )

    return F.array_join(F.transform(F.split(value, ""), swap), "")


def luhn_sum(digits: Column) -> Column:
    """Sum of a digit string whose last digit counts once, the one before twice, and so on."""

    def worth(ch: Column, i: Column) -> Column:
        d = ch.cast("int")
        return F.when(F.pmod(i, F.lit(2)) == 0, d).otherwise(
            F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        )

    places = F.transform(F.split(F.reverse(digits), ""), worth)
    return F.aggregate(places, F.lit(0), lambda s, x: s + x)


def _rotated(name: Column, key: str) -> Column:
    """The next first name of the same gender and script in the order of the key."""
    import hashlib

    def mark(n: str) -> str:
        return hashlib.sha256(f"{key}|{n}".encode()).hexdigest()

    new = F.lit(None).cast("string")
    for names in FIRST_NAMES.values():
        turn = sorted(names, key=mark)
        for old, nxt in zip(turn, turn[1:] + turn[:1], strict=True):
            new = F.when(name == old.lower(), nxt.lower()).otherwise(new)
    return new


def drawn(kind: Column, value: Column, attempt: Column, key: str) -> Column:
    """The surrogate of a canonical value at an attempt, itself canonical."""
    stream = F.sha2(F.concat_ws("|", F.lit(key), kind, value, attempt.cast("string")), 512)
    alike = _alike(value, stream)
    local = F.rpad(F.split_part(value, F.lit("@"), F.lit(1)), 10, "a")
    # the places of the domain's draws follow those of the local part
    domain = _alike(F.lit("aaaaaa"), F.sha2(stream, 512))
    card = F.concat(F.substr(value, F.lit(1), F.lit(1)), F.substr(alike, F.lit(2), F.length(value) - 2))
    check = F.pmod(10 - F.pmod(luhn_sum(F.concat(card, F.lit("0"))), F.lit(10)), F.lit(10))
    octet = lambda i: (_draw(stream, F.lit(i), 254) + 1).cast("string")
    surname = F.lit(None).cast("string")
    for script, pattern in (("greek", r"\p{IsGreek}"), ("cyrillic", r"\p{IsCyrillic}"), ("latin", "")):
        syllables = F.array(*map(F.lit, SYLLABLES[script]))
        parts = [F.get(syllables, _draw(stream, F.lit(i), len(SYLLABLES[script]))) for i in range(4)]
        # further attempts get longer names, so that the supply never ends
        tail = F.when(attempt > 3, F.concat(*[F.get(syllables, _draw(stream, F.lit(i), 16)) for i in range(4, 8)])).otherwise("")
        built = F.concat(*parts, tail)
        surname = F.coalesce(surname, F.when(value.rlike(pattern), built) if pattern else built)
    return (
        F.when(kind == "email", F.concat(_alike(local, stream), F.lit("@"), domain, F.lit(".example")))
        .when(kind == "ip", F.concat_ws(".", *map(octet, range(4))))
        .when(kind == "card", F.concat(card, check.cast("string")))
        .when(kind == "ip6", F.concat(F.lit("2001:0db8:"), F.regexp_replace(F.substr(stream, F.lit(1), F.lit(24)), "(.{4})(?=.)", "$1:")))
        .when(kind == "phone", (
            # a leading 1 is the country code where eleven digits are given; the area code
            # after it starts with 2-9, so that no ten digits of it are another value
            F.when(value.rlike("^1[0-9]{10}$"), F.concat(
                F.lit("1"), F.translate(F.substr(alike, F.lit(2), F.lit(1)), "01", "23"), F.substr(alike, F.lit(3), F.lit(9))
            ))
            .when((F.length(value) == 11) | value.startswith("0"), F.concat(
                F.substr(value, F.lit(1), F.lit(1)), F.substr(alike, F.lit(2), F.length(value) - 1)
            ))
            .otherwise(alike)
        ))
        .when(kind == "iban", F.concat(F.substr(value, F.lit(1), F.lit(2)), F.substr(alike, F.lit(3), F.length(value) - 2)))
        .when(kind == "first", _rotated(value, key))
        .when(kind == "last", surname)
        .otherwise(alike)
    )


def assign(values: DataFrame, key: str = KEY) -> DataFrame:
    """(kind, value, surrogate) for distinct (kind, value): no two share a surrogate.

    A surrogate also differs from every value, except among first names, where the
    rotation keeps the set of names.
    """
    taken = staged(values.select("kind", F.col("value").alias("surrogate")).where("kind <> 'first'"), "values")
    open_, done = staged(values.select("kind", "value"), "open"), None
    for attempt in range(ATTEMPTS):
        tried = open_.withColumn(
            "surrogate", drawn(F.col("kind"), F.col("value"), F.lit(attempt), key)
        )
        free = tried.join(taken, ["kind", "surrogate"], "left_anti")
        won = staged(
            free.groupBy("kind", "surrogate").agg(F.min("value").alias("value")), "won"
        ).select("kind", "value", "surrogate")
        done = won if done is None else done.union(won)
        open_ = staged(open_.join(won, ["kind", "value"], "left_anti"), "open")
        if open_.isEmpty():
            return done
        taken = taken.union(won.select("kind", "surrogate"))
    raise RuntimeError(f"no distinct surrogates after {ATTEMPTS} attempts")


def rendered(kind: Column, mention: Column, surrogate: Column) -> Column:
    """The surrogate in the format and case of a mention."""
    body = F.when(kind == "iban", "[A-Z0-9]").otherwise("[0-9]")
    # a mention without the country code takes the digits after it
    given = F.length(F.regexp_replace(mention, "[^0-9]", ""))
    skip = F.when(kind == "phone", F.length(surrogate) - given).otherwise(0)

    def fill(ch: Column, i: Column) -> Column:
        before = F.regexp_replace(F.substr(mention, F.lit(1), i), F.when(kind == "iban", "[^A-Z0-9]").otherwise("[^0-9]"), "")
        return F.when(F.regexp_like(ch, body), F.substr(surrogate, skip + F.length(before) + 1, F.lit(1))).otherwise(ch)

    filled = F.array_join(F.transform(F.split(mention, ""), fill), "")
    cased = F.when(mention == F.upper(mention), F.upper(surrogate)).when(
        mention == F.initcap(mention), F.initcap(surrogate)
    ).otherwise(surrogate)
    return (
        F.when(kind.isin("card", "phone", "ssn", "iban"), filled)
        .when(kind.isin("first", "last"), F.when(mention == F.upper(mention), F.upper(surrogate)).otherwise(F.initcap(surrogate)))
        .when(kind == "email", F.when(mention == F.upper(mention), cased).otherwise(surrogate))
        .otherwise(surrogate)
    )


def mentions_of(text: Column) -> tuple[Column, Column]:
    """The mentions of a text in order, and the pieces of text around them."""
    named, numbered = text.rlike(HAS_NAME), text.rlike(HAS_NUMBER)
    found = (
        F.when(named, F.regexp_extract_all(text, F.lit(EVERYTHING), F.lit(0)))
        .when(numbered, F.regexp_extract_all(text, F.lit(NUMBERS), F.lit(0)))
        .otherwise(F.array().cast("array<string>"))
    )
    pieces = F.when(named, F.split(text, EVERYTHING, -1)).otherwise(F.split(text, NUMBERS, -1))
    return F.coalesce(found, F.array().cast("array<string>")), pieces


def replace_entities(docs: DataFrame, key: str = KEY) -> DataFrame:
    """``docs`` with surrogates in ``text``, and ``n_entities``, the mentions replaced."""
    docs = docs.drop("n_entities")
    names = {x: fresh(x, docs.columns) for x in ("_found", "_id", "_hash", "_new")}
    found, id_, hash_, new = names.values()
    mentions, pieces = mentions_of(F.col("text"))
    marked = docs.withColumn(found, mentions)
    keyed = marked.where(F.size(found) > 0).withColumns(
        {id_: F.col("doc_id").cast("long"), hash_: F.xxhash64("text")}
    )
    each = staged(
        keyed.select(F.col(id_).alias("_i"), F.col(hash_).alias("_h"), F.posexplode(found).alias("_at", "mention"))
        .withColumn("kind", kind_of(F.col("mention")))
        .withColumn("value", canonical(F.col("kind"), F.col("mention"))),
        "mentions",
    )
    given = staged(assign(each.where("kind is not null").select("kind", "value").distinct(), key), "surrogates")
    put = (
        each.join(given, ["kind", "value"], "left")
        .withColumn("_put", rendered(F.col("kind"), F.col("mention"), F.col("surrogate")))
        .withColumn("_hit", F.col("kind").isNotNull())
        .withColumn("_put", F.when(F.col("_hit"), F.col("_put")).otherwise(F.col("mention")))
        .groupBy("_i", "_h")
        .agg(F.sort_array(F.collect_set(F.struct("_at", "_put", "_hit"))).alias("_puts"))
    )
    side = {x: fresh(x, keyed.columns) for x in ("_i", "_h", "_puts")}
    put = put.withColumnsRenamed(side)
    same = F.col(id_).eqNullSafe(F.col(side["_i"])) & (F.col(hash_) == F.col(side["_h"]))
    puts = F.col(side["_puts"])
    replaced = keyed.join(put, same).withColumn(
        new,
        F.array_join(
            F.zip_with(pieces, puts["_put"], lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), ""
        ),
    )
    columns = [F.col(new).alias("text") if c == "text" else F.col(c) for c in docs.columns]
    none = F.lit(0).cast("long").alias("n_entities")
    count = F.size(F.filter(puts, lambda x: x["_hit"])).cast("long").alias("n_entities")
    untouched = marked.where(F.size(found) == 0).select(*docs.columns, none)
    return untouched.union(replaced.select(*columns, count))
