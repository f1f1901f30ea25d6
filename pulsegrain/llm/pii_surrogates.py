"""Personal data replaced by keyed surrogates of the same kind and format.

Entities are found by patterns. An entity is known by its kind and its plain
form (mail addresses in lower case, numbers as digits alone, names without the
title), so all spellings of one entity get one surrogate. A keyed hash of kind
and plain form drives the replacement: digits become digits and letters become
letters of their case at the same places, separators stay, addresses keep their
parts in range, and names keep the title and come from a list that matches its
gender and the name's script. Two entities must not share a surrogate and no
surrogate may be an entity of the corpus; those that clash are keyed anew with
the next attempt until none does. From attempt LONGER on, a surrogate made of
digits or letters also gets a keyed tail that grows with the attempts, so masks
(``********``), letters of scripts that are not poured and shapes with fewer
surrogates than entities come to an end too. Only entities with a later attempt
are kept in a table; all others need none.

Defined cases: null text stays null, and text without entities stays as it is;
repeated rows are treated alike; ids may be null or repeat; an empty table gives
an empty result. Other columns are never looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrain.session import written

KEY = "surrogates-1"  # give a secret of your own
#: The attempt from which surrogates get longer.
LONGER = 3

# Titles by gender, and the lists that surrogate names come from.
MALE_TITLES = ["Mr", "Herr", "Monsieur", "Señor", "Господин"]
FEMALE_TITLES = ["Mrs", "Ms", "Miss", "Frau", "Madame", "Señora", "Госпожа"]
NAMES = {
    ("latin", "male"): ["Adam", "Bruno", "Carl", "Daniel", "Emil", "Frank", "George", "Hugo", "Ivan", "Jonas", "Karl", "Leon", "Martin", "Noah", "Oscar", "Paul"],
    ("latin", "female"): ["Anna", "Bella", "Clara", "Diana", "Emma", "Flora", "Greta", "Helen", "Irene", "Julia", "Karin", "Laura", "Maria", "Nora", "Olivia", "Paula"],
    ("latin", "family"): ["Abel", "Berger", "Costa", "Dahl", "Ebert", "Falk", "Garcia", "Holm", "Ibsen", "Jansen", "Keller", "Lange", "Moreau", "Novak", "Olsen", "Petit"],
    ("cyrillic", "male"): ["Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Иван", "Кирилл", "Лев", "Максим", "Никита", "Олег", "Павел", "Роман", "Семён", "Тимур"],
    ("cyrillic", "female"): ["Анна", "Вера", "Галина", "Дарья", "Елена", "Жанна", "Зоя", "Ирина", "Ксения", "Лидия", "Мария", "Нина", "Ольга", "Полина", "Римма", "Софья"],
    ("cyrillic", "family"): ["Антоненко", "Бондарь", "Вороненко", "Гончар", "Дорошенко", "Ефименко", "Жук", "Зинченко", "Исаенко", "Коваленко", "Лысенко", "Мельник", "Никитенко", "Остапенко", "Петренко", "Руденко"],
}

#: A name with inner capitals, apostrophes and hyphens.
NAME = r"\p{Lu}(?:[\p{L}\p{M}]++|(?=['’]\p{L}))(?:['’-][\p{L}\p{M}]++)*+"

PATTERNS = {
    "mail": r"(?<![\w.%+-])[\w.%+-]{1,64}+@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+",
    "secret": r"(?<=password=|passwd=|secret=|token=|api_key=)[^\s\"',;]{6,}+|(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|(?=[a-f]*+[0-9])(?=[0-9]*+[a-f])[0-9a-f]{16,}+|(?:sk|pk|ghp)_[A-Za-z0-9_]{16,}+)(?![A-Za-z0-9])",
    "address": r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\.?\d)",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "phone": r"(?<![\w+])\+?\d{1,3}[ .-]?\(\d{2,4}\)[ .-]?\d{3}[ .-]?\d{3,4}(?!\d)|(?<![\w+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,4}(?!\d)|(?<![\w-])\d{3}-\d{3}-\d{4}(?![\w-])",
    "card": r"(?<![\w.-])\d(?:[ -]?\d){12,18}(?![\w-])",
    "social": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "person": r"(?<!\p{L})(?:" + "|".join(MALE_TITLES + FEMALE_TITLES) + r")\.? " + NAME + "(?: " + NAME + "){0,2}+",
}
PATTERN = "(?U)" + "|".join(PATTERNS.values())
_QUICK = r"[0-9@]|password=|passwd=|secret=|token=|api_key=|" + "|".join(MALE_TITLES + FEMALE_TITLES)


def kind_of(entity: Column) -> Column:
    """The first kind whose pattern the whole entity matches; secrets are what is left."""
    kind = F.when(entity.contains("@") & entity.rlike(r"\.[A-Za-z0-9-]+$"), "mail")
    kind = kind.when(entity.rlike("^(?:" + "|".join(MALE_TITLES + FEMALE_TITLES) + r")\.? \p{Lu}"), "person")
    kind = kind.when(entity.rlike(r"^(?:\d{1,3}\.){3}\d{1,3}$"), "address")
    kind = kind.when(entity.rlike(r"^[A-Z]{2}\d{2}[A-Z0-9 ]+$"), "iban")
    kind = kind.when(entity.rlike(r"^(?:\+[\d ().-]+|\d{1,3}[ .-]?\([\d ().-]+|\d{3}-\d{3}-\d{4})$"), "phone")
    kind = kind.when(entity.rlike(r"^\d{3}-\d{2}-\d{4}$"), "social").when(entity.rlike(r"^[\d -]+$"), "card")
    return kind.otherwise("secret")


def plain_form(kind: Column, entity: Column) -> Column:
    """What stays the same in all spellings of an entity."""
    return (F.when(kind == "mail", F.lower(entity)).when(kind.isin("phone", "card", "social"), F.regexp_replace(entity, r"\D", ""))
            .when(kind == "iban", F.regexp_replace(entity, " ", "")).when(kind == "person", F.regexp_replace(entity, r"^\S+ ", "")).otherwise(entity))


def _byte(stream: Column, place: Column) -> Column:
    """The byte at a place of the hash stream, beginning anew after its end."""
    return F.conv(F.substring(stream, (place % 128) * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _stream(key: str, kind: Column, plain: Column, attempt: Column) -> Column:
    """256 hex digits that key, kind, plain form and attempt decide."""
    seed = F.concat_ws("\u0001", F.lit(key), kind, plain, attempt.cast("string"))
    return F.concat(F.sha2(seed, 512), F.sha2(F.concat(seed, F.lit("\u0001more")), 512))


def _poured(entity: Column, stream: Column) -> Column:
    """Every digit and letter replaced by one of its class; the n-th takes the n-th byte, so separators do not matter."""
    chars = F.split(entity, "")

    def step(state: Column, char: Column) -> Column:
        byte = _byte(stream, state["n"])
        small, capital, digit = char.rlike("^[a-z]$"), char.rlike("^[A-Z]$"), char.rlike("^[0-9]$")
        new = F.when(digit, (byte % 10).cast("string")).when(small, F.char(byte % 26 + 97)).when(capital, F.char(byte % 26 + 65)).otherwise(char)
        return F.struct(F.concat(state["out"], new).alias("out"), (state["n"] + (digit | small | capital).cast("int")).alias("n"))

    return F.aggregate(chars, F.struct(F.lit("").alias("out"), F.lit(0).alias("n")), step, lambda s: s["out"])


def _person(entity: Column, stream: Column, attempt: Column) -> Column:
    """Title, first and family name. Later attempts add family names, so there is no end of names."""
    title, name = F.regexp_extract(entity, r"^(\S+) ", 1), F.regexp_replace(entity, r"^\S+ ", "")
    bare = F.regexp_replace(title, r"\.$", "")
    cyrillic = name.rlike(r"\p{IsCyrillic}")

    def pick(what: str, place: int | Column) -> Column:
        place = F.lit(place) if isinstance(place, int) else place
        one, other = (F.array(*[F.lit(x) for x in NAMES[script, what]]) for script in ("cyrillic", "latin"))
        return F.element_at(F.when(cyrillic, one).otherwise(other), _byte(stream, place) % 16 + 1)

    first = F.when(bare.isin(FEMALE_TITLES), pick("female", 0)).otherwise(pick("male", 0))
    family = F.concat_ws("-", F.transform(F.sequence(F.lit(1), attempt + 1), lambda i: pick("family", i)))
    return F.when(name.contains(" "), F.concat_ws(" ", title, first, family)).otherwise(F.concat_ws(" ", title, family))


def surrogate(key: str, entity: Column, kind: Column, plain: Column, attempt: Column) -> Column:
    """The replacement of one spelling of an entity."""
    stream = _stream(key, kind, plain, attempt)
    mail = F.concat(_poured(F.lower(F.regexp_extract(entity, "^(.*)@", 1)), stream), F.lit("@"),
                    F.lower(F.substring(stream, 201, 8)), F.lit(".example.com"))
    octets = [(_byte(stream, F.lit(0)) % 223 + 1), *(_byte(stream, F.lit(i)) for i in (1, 2)), _byte(stream, F.lit(3)) % 254 + 1]
    address = F.concat_ws(".", *[o.cast("string") for o in octets])
    # Whatever the spelling, a phone number keeps its plus and the first digit after it, an account its country.
    kept = r"^(\+\d|[A-Z]{2}(?=\d\d)|)"
    numbered = F.concat(F.regexp_extract(entity, kept, 1), _poured(F.regexp_replace(entity, kept, ""), stream))
    tail = F.substring(stream, F.lit(129), F.least((attempt - LONGER + 1) * 4, F.lit(64)))
    digits = F.translate(tail, "abcdef", "012345")
    later = F.when(attempt < LONGER, F.lit("")).when(kind.isin("phone", "card", "social", "iban"), digits).otherwise(tail)
    poured = F.concat(F.when(kind.isin("phone", "iban"), numbered).otherwise(_poured(entity, stream)), later)
    return F.when(kind == "mail", mail).when(kind == "address", address).when(kind == "person", _person(entity, stream, attempt)).otherwise(poured)


def found_entities(text: Column) -> Column:
    """All entities of a text in order; texts without a sign of any are not searched."""
    return F.when(text.rlike(_QUICK), F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))).otherwise(F.array().cast("array<string>"))


def _entities(found: DataFrame) -> DataFrame:
    """_entity, kind and plain of every distinct entity."""
    each = found.select(F.explode("_entities").alias("_entity")).distinct()
    return each.withColumn("kind", kind_of(F.col("_entity"))).withColumn("plain", plain_form(F.col("kind"), F.col("_entity")))


def later_attempts(found: DataFrame, key: str = KEY) -> DataFrame:
    """kind, plain and attempt of the entities whose first surrogate clashes.

    One spelling stands for all of an entity. Each round settles those whose
    surrogate is theirs alone; the table shrinks until no clash is left.
    """
    known = written(_entities(found).groupBy("kind", "plain").agg(F.min("_entity").alias("spelling")), "entities")
    attempts = known.select("kind", "plain", "spelling", F.lit(0).alias("attempt"))
    while True:
        made = attempts.withColumn("new", surrogate(key, F.col("spelling"), F.col("kind"), F.col("plain"), F.col("attempt")))
        made = made.withColumn("shape", plain_form(F.col("kind"), F.col("new")))
        first = made.groupBy("kind", "shape").agg(F.min(F.struct("attempt", "plain")).alias("owner"))
        taken = known.select("kind", F.col("plain").alias("shape"), F.lit(True).alias("real"))
        judged = made.join(first, ["kind", "shape"]).join(taken, ["kind", "shape"], "left")
        clash = (F.col("owner.plain") != F.col("plain")) | F.col("real").isNotNull()
        judged = written(judged.select("kind", "plain", "spelling", (F.col("attempt") + clash.cast("int")).alias("attempt"), clash.alias("clash")), "attempts")
        attempts = judged.drop("clash")
        if judged.where("clash").isEmpty():
            return attempts.where("attempt > 0").select("kind", "plain", "attempt")


def replace_entities(docs: DataFrame, id: str = "doc_id", text: str = "text", key: str = KEY) -> DataFrame:
    """id, text with surrogates, and n_entities of every row."""
    rows = docs.select(F.col(id).alias("_id"), F.col(text).alias("_text"))
    found = rows.withColumn("_entities", found_entities(F.col("_text")))
    later = later_attempts(found, key)
    some = found.where(F.size("_entities") > 0).withColumn("_row", F.sha2("_text", 256))
    one = some.select("_row", F.explode(F.array_distinct("_entities")).alias("_entity")).distinct()
    one = one.withColumn("kind", kind_of(F.col("_entity"))).withColumn("plain", plain_form(F.col("kind"), F.col("_entity")))
    special = one.join(later, ["kind", "plain"]).groupBy("_row").agg(
        F.map_from_entries(F.collect_list(F.struct("_entity", "attempt"))).alias("_later"))
    joined = some.join(special, "_row", "left")

    def new(entity: Column) -> Column:
        kind = kind_of(entity)
        attempt = F.coalesce(F.col("_later")[entity], F.lit(0))
        return surrogate(key, entity, kind, plain_form(kind, entity), attempt)

    parts = F.split(F.col("_text"), PATTERN, -1)
    # The text between entities and the new entities in turn; there is one part more.
    woven = F.zip_with(parts, F.transform("_entities", new), lambda part, value: F.concat(part, F.coalesce(value, F.lit(""))))
    changed = joined.select(F.col("_id").alias(id), F.concat_ws("", woven).alias("text"), F.size("_entities").cast("long").alias("n_entities"))
    same = found.where(F.coalesce(F.size("_entities") <= 0, F.lit(True))).select(F.col("_id").alias(id), F.col("_text").alias("text"), F.lit(0).cast("long").alias("n_entities"))
    return same.unionByName(changed)


def op2_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace_entities(spark.read.parquet(f"{sf_dir}/documents.parquet"))
