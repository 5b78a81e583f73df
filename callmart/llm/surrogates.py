"""Private data replaced by keyed surrogates of the same kind, in DataFrame functions only.

Each entity found gets a surrogate that looks like it: the same type, script, length and punctuation, a title's
gender, a card's check digit. It is derived from a secret key, the type and the normal form of the entity, so all mentions of
one entity, however written, change alike everywhere, and nobody without the key can go back.

Two entities must not become one, and no surrogate may be an entity that the corpus itself mentions.
Surrogates are checked over the distinct entities of the whole corpus: whoever collides derives another one, from the
next attempt number, until none collides. What is left after many rounds (a type with too few
values) gets a tag. Only entities move for this; texts without any are never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callmart.session import stage

#: Rounds of the collision check; later ones also lengthen names.
ROUNDS = 12

# Scripts whose letters are replaced by letters of the same script, as (first, last, letters).
SCRIPTS = [
    ("a-z", "abcdefghijklmnopqrstuvwxyz"),
    ("A-Z", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("à-öø-ÿ", "àáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"),
    ("À-ÖØ-Þ", "ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ"),
    ("α-ω", "αβγδεζηθικλμνξοπρστυφχψω"),
    ("Α-Ω", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ"),
    ("а-я", "абвгдежзийклмнопрстуфхцчшщъыьэюя"),
    ("А-Я", "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ"),
]
# Forms of address by gender, and first names and syllables by script and gender.
MALE_TITLES = ["Mr", "Sir", "Herr", "Monsieur", "Señor", "Господин", "Κύριος"]
FEMALE_TITLES = ["Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mademoiselle", "Señora", "Señorita", "Госпожа", "Κυρία"]
#: Forms of address that tell no gender.
NEUTRAL_TITLES = ["Dr", "Doctor", "Prof", "Professor", "Mx"]
FIRST_NAMES = {
    ("latin", "m"): ["Adam", "Bruno", "David", "Erik", "Felix", "Hugo", "Ivan", "Jonas", "Karl", "Leon", "Martin", "Oscar"],
    ("latin", "f"): ["Alice", "Berta", "Clara", "Diana", "Elena", "Greta", "Helen", "Irene", "Julia", "Laura", "Maria", "Nora"],
    ("cyrillic", "m"): ["Борис", "Виктор", "Глеб", "Денис", "Егор", "Иван", "Лев", "Марк", "Олег", "Павел", "Роман", "Фёдор"],
    ("cyrillic", "f"): ["Алла", "Вера", "Галина", "Дарья", "Елена", "Жанна", "Инна", "Лидия", "Нина", "Ольга", "Раиса", "София"],
    ("greek", "m"): ["Αλέξης", "Γιώργος", "Δήμος", "Ηλίας", "Θωμάς", "Κώστας", "Λουκάς", "Μάρκος", "Νίκος", "Πέτρος", "Σταύρος", "Φώτης"],
    ("greek", "f"): ["Άννα", "Δάφνη", "Ελένη", "Ζωή", "Ήρα", "Θάλεια", "Ιρις", "Κατερίνα", "Λίνα", "Μαρία", "Νίκη", "Σοφία"],
}
SYLLABLES = {
    "latin": ["ba", "den", "fel", "gor", "han", "kel", "lim", "mar", "nes", "por", "rin", "sol", "tam", "ver", "wil", "zan"],
    "cyrillic": ["ба", "вер", "гор", "дан", "жел", "зим", "кол", "лам", "мир", "нов", "пет", "рам", "сол", "тим", "фед", "чер"],
    "greek": ["βα", "γαλ", "δημ", "ζαν", "θεο", "καλ", "λαμ", "μαρ", "νικ", "παπ", "ραλ", "σαρ", "ταμ", "φιλ", "χαρ", "ψαρ"],
}

_TITLE = "|".join(sorted(MALE_TITLES + FEMALE_TITLES + NEUTRAL_TITLES, key=len, reverse=True))
#: One word of a name, with inner capitals, apostrophes and hyphens, or an initial; it ends where its letters end.
_TAIL = r"[\p{L}\p{M}\p{N}]"
_WORD = rf"(?:\p{{Lu}}\.(?= \p{{Lu}})|\p{{Lu}}(?:['’]\p{{Lu}})?{_TAIL}++(?:['’-]\p{{Lu}}{_TAIL}*+)*+)"
_PARTICLE = "(?:de|del|della|der|den|di|da|dos|du|la|le|van|von|bin|ibn|al)"
#: What may stand between two digits of a phone number.
_GAP = r"(?:[ .-]?\(|\)[ .-]?|[ .-])?"
#: Phone numbers without a country's code: of ten digits, or with a 0 before the area.
_NATIONAL = "|".join(
    [
        r"(?:1[ .-]?)?\([0-9]{3}\)[ .-]?[0-9]{3}[ .-]?[0-9]{4}",
        *(rf"(?:1{gap})?[2-9][0-9]{{2}}{gap}[2-9][0-9]{{2}}{gap}[0-9]{{4}}" for gap in (" ", r"\.", "-")),
        r"\(0[0-9]{1,4}\)[ .-]?[0-9]{2,4}(?:[ -]?[0-9]{2,4}){1,2}",
        *(rf"0[1-9](?:{gap}[0-9]{{2}}){{4}}" for gap in (" ", r"\.", "-")),
        r"0[1-9][0-9]{1,3}[ /-](?:[0-9]{6,8}|[0-9]{3,4}[ -][0-9]{3,5})",
    ]
)
#: Where each type begins and ends. Nothing is tried twice inside one run of characters, so long runs cost no more.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+",
    "secret": r"(?<![\p{L}\p{N}])(?:[0-9a-f]{32,128}+|[0-9A-F]{32,128}+)(?![\p{L}\p{N}])",
    "ip": r"(?<![\p{L}\p{N}.])(?:[0-9]{1,3}+\.){3}[0-9]{1,3}+(?!\.?[\p{L}\p{N}])",
    # Numbers of the codes 1 and 7 have ten digits more, others 15 at most in all.
    "phone": r"(?<![\p{L}\p{N}+])\+(?:[17](?:" + _GAP + r"[0-9]){10}|[0-9](?:" + _GAP + r"[0-9]){6,14})(?![\p{L}\p{N}])"
    r"|(?<![\p{L}\p{N}+.-])(?:" + _NATIONAL + r")(?![\p{L}\p{N}]|[.-][0-9])",
    "card": r"(?<![\p{L}\p{N}.-])(?:[0-9]{13,19}+|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5})(?![\p{L}\p{N}])",
    "name": r"(?<![\p{L}\p{N}])(?:" + _TITLE + r")\.? " + _WORD + "(?: (?:" + _PARTICLE + " ){0,2}" + _WORD + "){0,3}",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: Cheaper than the patterns, and found in whatever one of them fits.
_HINT = r"[0-9]{2}|@|[0-9]\.[0-9]|\+[0-9]|[0-9a-f]{32}|[0-9A-F]{32}|(?:" + _TITLE + r")\.? \p{Lu}"


def _type(entity: Column) -> Column:
    """The type that a found entity has: one pattern fits it as a whole, tried in their order."""
    kind = F.when(entity.contains("@"), "email")
    kind = kind.when(entity.rlike(r"^\p{L}++\.? \p{Lu}"), "name")
    kind = kind.when(entity.startswith("+"), "phone")
    kind = kind.when(entity.rlike(r"^[0-9]{1,3}(?:\.[0-9]{1,3}){3}$"), "ip")
    number = entity.rlike(r"^[0-9() ./-]+$")
    kind = kind.when(number & (F.length(F.regexp_replace(entity, "[^0-9]", "")) < 13), "phone")
    kind = kind.when(entity.rlike(r"^[0-9]{13,19}$") | entity.rlike(r"[ -]"), "card")
    return kind.otherwise("secret")


def _normal(kind: Column, entity: Column) -> Column:
    """What mentions of one entity share: letter case, spaces and punctuation of numbers do not count."""
    digits = F.regexp_replace(entity, "[^0-9]", "")
    octets = F.array_join(F.transform(F.split(entity, "\\."), lambda x: F.regexp_replace(x, "^0+(?=[0-9])", "")), ".")
    return (
        F.when(kind.isin("phone", "card"), digits)
        .when(kind == "ip", octets)
        # A title is not part of the name, its gender is.
        .when(kind == "name", F.concat(_gender(entity), F.lit(":"), F.lower(F.translate(F.regexp_replace(entity, r"^\p{L}++\.? ", ""), "’", "'"))))
        .otherwise(F.lower(entity))
    )


def _gender(name: Column) -> Column:
    title = F.regexp_extract(name, r"^(\p{L}++)", 1)
    return F.when(title.isin(*MALE_TITLES), "m").when(title.isin(*NEUTRAL_TITLES), "n").otherwise("f")


def _script(name: Column) -> Column:
    return F.when(name.rlike(r"[Ѐ-ӿ]"), "cyrillic").when(name.rlike(r"[Ͱ-Ͽἀ-῿]"), "greek").otherwise("latin")


def _drawn(seed: Column, i: Column, below) -> Column:
    """A number from 0 to below - 1 for place ``i``."""
    digest = F.sha2(F.concat_ws("|", seed, i.cast("string")), 256)
    return F.pmod(F.conv(F.substring(digest, 1, 12), 16, 10).cast("long"), F.lit(below)).cast("int")


def _letter(c: Column, seed: Column, i: Column) -> Column:
    """A character of the same class; other characters stay."""
    out = F.when(c.rlike("^[0-9]$"), _drawn(seed, i, 10).cast("string"))
    for span, letters in SCRIPTS:
        out = out.when(c.rlike(f"^[{span}]$"), F.substring(F.lit(letters), _drawn(seed, i, len(letters)) + 1, F.lit(1)))
    return out.otherwise(c)


def _shuffled(text: Column, seed: Column) -> Column:
    """Each letter and digit replaced by one of its class, everything else in place."""
    return F.array_join(F.transform(F.split(text, ""), lambda c, i: _letter(c, seed, i)), "")


def _digits(count: Column, first: Column, seed: Column) -> Column:
    """``first`` and drawn digits, ``count`` in all."""
    drawn = F.array_join(F.transform(F.sequence(F.lit(1), count), lambda i: _drawn(seed, i, 10).cast("string")), "")
    return F.concat(first, F.substring(drawn, F.lit(1), count - F.length(first)))


def _luhn(digits: Column) -> Column:
    """The sum that a card number's check digit makes a multiple of ten."""
    n = F.length(digits)

    def added(total: Column, i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), added)


def _pick(values: list[str], number: Column) -> Column:
    return F.get(F.array([F.lit(v) for v in values]), number)


#: The country's code that a number begins with.
_CODE = "^(?:[017]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"


def _candidate(kind: Column, normal: Column, key: str, attempt: Column) -> Column:
    """The surrogate, in normal form, that an entity derives on an attempt."""
    seed = F.sha2(F.concat_ws("|", F.lit(key), kind, normal, attempt.cast("string")), 256)
    # Of a phone number the country's code stays, of a card the first digit; both as they are written.
    card = _digits(F.length(normal), F.substring(normal, 1, 1), seed)
    body = F.substring(card, F.lit(1), F.length(card) - 1)
    check = F.pmod(-_luhn(F.concat(body, F.lit("0"))), F.lit(10)).cast("string")
    card = F.when(_luhn(normal) % 10 == 0, F.concat(body, check)).otherwise(card)
    code = F.length(F.regexp_extract(normal, _CODE, 0))
    whole = F.concat(
        F.substring(normal, F.lit(1), code),
        (_drawn(seed, F.lit("area"), 800) + 200).cast("string"),
        _digits(F.lit(7), F.lit(""), seed),
    )
    phone = F.when(F.length(normal) == code + 10, whole)
    kept = F.when(F.length(normal) > 10, code + 1).otherwise(F.lit(1))
    phone = phone.otherwise(_digits(F.length(normal), F.substring(normal, F.lit(1), kept), seed))
    octets = [(_drawn(seed, F.lit(f"o{i}"), 254) + 1).cast("string") for i in range(4)]
    # A domain of its own for each domain, under the names reserved for examples.
    local, domain = F.substring_index(normal, "@", 1), F.substring_index(normal, "@", -1)
    host_seed = F.sha2(F.concat_ws("|", F.lit(key), F.lit("domain"), domain), 256)
    host = F.concat(
        F.translate(F.substring(host_seed, 1, 10), "0123456789", "ghijklmnop"),
        F.lit(".example."),
        F.when(domain.endswith(".org"), "org").when(domain.endswith(".net"), "net").otherwise("com"),
    )
    email = F.concat(_shuffled(local, seed), F.lit("@"), host)
    secret = F.concat(*[F.sha2(F.concat(seed, F.lit(str(i))), 256) for i in range(2)])
    secret = F.substring(secret, F.lit(1), F.length(normal))
    return (
        F.when(kind == "email", email)
        .when(kind == "phone", phone)
        .when(kind == "card", card)
        .when(kind == "ip", F.concat_ws(".", *octets))
        .when(kind == "name", _name(normal, seed, attempt))
        .otherwise(secret)
    )


def _drawn_from(values: list[str], seed: Column):
    return lambda i: _pick(values, _drawn(seed, i, len(values)))


def _name(normal: Column, seed: Column, attempt: Column) -> Column:
    """Gender, and a name of one or two words of the same script; later attempts have longer surnames."""
    gender, name = F.substring(normal, 1, 1), F.substring_index(normal, ":", -1)
    script = _script(name)
    first = F.lit(None).cast("string")
    surname = F.lit(None).cast("string")
    for s, syllables in SYLLABLES.items():
        parts = F.transform(F.sequence(F.lit(1), attempt + 3), _drawn_from(syllables, seed))
        surname = F.when(script == s, F.array_join(parts, "")).otherwise(surname)
        for g in "mfn":
            own = [x.lower() for h in ("mf" if g == "n" else g) for x in FIRST_NAMES[s, h]]
            first = F.when((script == s) & (gender == g), _pick(own, _drawn(seed, F.lit("first"), len(own)))).otherwise(first)
    return F.concat(gender, F.lit(":"), F.when(name.contains(" "), F.concat_ws(" ", first, surname)).otherwise(surname))


def _written(kind: Column, mention: Column, surrogate: Column) -> Column:
    """The surrogate in the way that the mention is written: its punctuation, title and letter case."""

    def filled(digits: Column) -> Column:
        marks = F.split(mention, "")
        step = lambda a, c: F.when(
            c.rlike("^[0-9]$"),
            F.struct(F.concat(a["out"], F.substring(digits, a["at"], F.lit(1))).alias("out"), (a["at"] + 1).alias("at")),
        ).otherwise(F.struct(F.concat(a["out"], c).alias("out"), a["at"].alias("at")))
        return F.aggregate(marks, F.struct(F.lit("").alias("out"), F.lit(1).alias("at")), step)["out"]

    capitals = F.upper(surrogate)
    title = F.regexp_extract(mention, r"^(\p{L}++\.? )", 1)
    written = (
        F.when(kind.isin("phone", "card"), filled(surrogate))
        .when(kind == "ip", surrogate)
        .when(kind == "name", F.concat(title, F.initcap(F.substring_index(surrogate, ":", -1))))
        .when((mention == F.upper(mention)) & (mention != F.lower(mention)), capitals)
        .otherwise(surrogate)
    )
    return F.when(surrogate.startswith("["), surrogate).otherwise(written)


def surrogate_table(entities: DataFrame, key: str, rounds: int = ROUNDS) -> DataFrame:
    """kind, normal and surrogate of distinct entities, all surrogates of a kind distinct and none an entity.

    In each round those without a surrogate propose one. A proposal falls if it is an entity, was granted before, or
    if an entity of smaller hash proposes it too. What is granted never changes, so a round
    works on the rest only.
    """
    entities = stage(entities.select("kind", "normal").distinct(), "entities")
    todo, granted = entities, None
    for attempt in range(rounds):
        number = F.lit(attempt)
        # Drawing is slow for the few bytes it reads; a given number of partitions is not coalesced.
        spread = todo.repartition(int(todo.sparkSession.conf.get("spark.sql.shuffle.partitions")), "kind", "normal")
        proposed = spread.withColumn("surrogate", _candidate(F.col("kind"), F.col("normal"), key, number))
        proposed = stage(proposed.withColumn("order", F.sha2(F.concat_ws("|", F.lit(key), "normal"), 256)), "proposed")
        taken = entities.select("kind", F.col("normal").alias("surrogate"))
        if granted is not None:
            taken = taken.unionByName(granted.select("kind", "surrogate"))
        free = proposed.join(taken, ["kind", "surrogate"], "left_anti")
        first = free.groupBy("kind", "surrogate").agg(F.min(F.struct("order", "normal")).alias("first"))
        new = stage(first.select("kind", F.col("first.normal").alias("normal"), "surrogate"), "granted")
        granted = new if granted is None else granted.unionByName(new)
        todo = stage(todo.join(new, ["kind", "normal"], "left_anti"), "left")
        if todo.isEmpty():
            return granted
    # 128 bits of the key's digest: as distinct as the entities.
    tag = F.concat(
        F.lit("["), F.upper("kind"), F.lit("-"), F.substring(F.sha2(F.concat_ws("|", F.lit(key), "kind", "normal"), 256), 1, 32), F.lit("]")
    )
    return granted.unionByName(todo.withColumn("surrogate", tag))


def replace_private(docs: DataFrame, key: str, rounds: int = ROUNDS) -> DataFrame:
    """``docs`` with surrogates in ``text`` for emails, phones, cards, addresses, secrets and titled names, and n_entities.

    Missing texts stay missing and empty ones empty; texts without entities are not touched. Rows without doc_id and
    repeated rows are rewritten like others. n_chars, where it is a column, is counted again for changed
    texts. A column of the name n_entities is replaced; other columns may have any names.
    """
    own = {"_text_key", "_of", "_new"}
    clashing = [c for c in docs.columns if c.lower() in own]
    if clashing:
        # Columns with names that are used below travel under longer ones.
        away = {c: c + "_" * max(map(len, docs.columns)) for c in clashing}
        done = replace_private(docs.withColumnsRenamed(away), key, rounds)
        return done.withColumnsRenamed({new: old for old, new in away.items()})
    names = [c for c in docs.columns if c.lower() != "n_entities"]
    spans = docs.schema["text"].name
    text = F.col(spans)
    found = F.filter(F.regexp_extract_all(text, F.lit(ANY), F.lit(0)), lambda x: x != "")
    has_any = F.coalesce(text.rlike(_HINT) & text.rlike(ANY), F.lit(False))
    clean = docs.where(~has_any).select(*names, F.lit(0).alias("n_entities"))
    # Texts decide their entities, so rows of one text share them.
    key_of = F.struct(F.xxhash64(text).alias("a"), F.sha2(text, 256).alias("b"))
    dirty = docs.where(has_any).select(*names).withColumn("_text_key", key_of)
    mentions = stage(
        dirty.select("_text_key", F.posexplode(found).alias("place", "mention"))
        .withColumn("kind", _type(F.col("mention")))
        .withColumn("normal", _normal(F.col("kind"), F.col("mention")))
        .groupBy("_text_key", "place")
        .agg(F.first("mention").alias("mention"), F.first("kind").alias("kind"), F.first("normal").alias("normal")),
        "mentions",
    )
    table = surrogate_table(mentions, key, rounds)
    written = mentions.join(table, ["kind", "normal"]).select(
        F.col("_text_key").alias("_of"), "place", _written(F.col("kind"), F.col("mention"), F.col("surrogate")).alias("new")
    )
    # Read from a table, so that Spark can split the join where one text is very frequent.
    lists = stage(written.groupBy("_of").agg(F.array_sort(F.collect_list(F.struct("place", "new"))).alias("_new")), "lists")
    between = F.split(text, ANY, -1)
    whole = F.array_join(
        F.zip_with(between, F.col("_new"), lambda a, b: F.concat(a, F.coalesce(b["new"], F.lit("")))), ""
    )
    changed = (
        dirty.join(lists, F.col("_text_key") == F.col("_of"))
        .withColumn("n_entities", F.size("_new"))
        .withColumn(spans, whole)
    )
    if "n_chars" in names:
        changed = changed.withColumn("n_chars", F.length(spans).cast(docs.schema["n_chars"].dataType))
    return clean.unionByName(changed.select(*names, "n_entities"))
