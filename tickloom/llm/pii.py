"""Surrogates for personal data, in DataFrame operations.

Found are e-mail addresses, phone numbers, card, account and social security numbers, IPv4
addresses, keys and passwords with a name in front, and names of people after a title. An
entity is a type and a canonical value: letters in lower case for e-mail, digits only for
numbers that can be written in several ways, one word of a name.

1. All distinct entities get a surrogate from a keyed hash: letters become letters of the same
   case, digits digits, hexadecimal digits such; a card number stays valid if it was; addresses
   move to reserved ranges; given names keep gender, names their script and, where it shows,
   the gender of the ending.
2. Collision check: of the entities that a surrogate has been made for twice, and of surrogates
   that are an entity of the corpus themselves, all but one try the next hash, until none is
   left. So different entities stay different, and one entity is the same everywhere. From
   attempt `TAGGED` on a surrogate is lengthened by one more digit each time, so that entities
   that fill their whole form (all six-digit tokens) find one, too.
3. Texts are cut at the matches and put together with surrogates written in the format of
   each match. Name words found in a text are replaced in the rest of it, too.

Null texts stay null and empty ones empty. Rows are known by a hash of id and text, so rows
that agree in both get the same result; a null id is an id like others. Columns other than id
and text are not read. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.session import stage

# Titles before names.
TITLES_F = "Mrs|Ms|Miss|Frau|Madame|Mme|Mademoiselle|Señora|Sra|Госпожа|госпожа"
TITLES_M = "Mr|Mister|Herr|Monsieur|Señor|Sr|Господин|господин"
NAME = r"\p{Lu}(?:[\p{Ll}'’-]|(?<=[\p{Ll}'’-])\p{Lu})+"
# The length of an account number in each country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK|FI|FK|FO|GL|NL|SD", 19: "MK|SI", 20: "AT|BA|EE|KZ|LT|LU|MN|XK", 21: "CH|HR|LI|LV",
    22: "BG|BH|CR|DE|GB|GE|IE|ME|RS|VA", 23: "AE|GI|IL|IQ|OM|SO|TL", 24: "AD|CZ|ES|MD|PK|RO|SA|SE|SK|TN|VG", 25: "AO|CV|GW|LY|MZ|PT|ST",
    26: "DZ|IR|IS|TR", 27: "BI|CF|CG|CM|DJ|FR|GA|GQ|GR|IT|KM|MC|MG|MR|SM|TD",
    28: "AL|AZ|BF|BJ|BY|CI|CY|DO|GT|HN|HU|LB|MA|ML|NE|NI|PL|SN|SV|TG", 29: "BR|EG|PS|QA|UA", 30: "JO|KW|MU|YE", 31: "MT|SC", 32: "LC", 33: "RU",
}
SECRET = r"(?i:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)\s*[=:]\s*[\"']?"
#: Of a known country its length, the last group being what is left; else whole groups of four.
IBAN = "|".join(
    [rf"(?:{c})\d{{2}}(?: ?[A-Z0-9]{{4}}){{{(n - 4) // 4}}}" + (rf" ?[A-Z0-9]{{{n % 4}}}" if n % 4 else "") + r"\b" for n, c in IBAN_LENGTHS.items()] + [r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}\b"]
)
#: Type and pattern; the first that a match fits names its type.
PATTERNS = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"),
    ("secret", SECRET + r"[^\s\"']{6,}"),
    ("cloud_key", r"\bAKIA[0-9A-Z]{16}\b"),
    ("ip", r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\.?\d)"),
    ("card", r"(?<!\d)\d{4}[ -]?\d{4}[ -]?\d{4}[ -]?\d{4}(?!\d)"),
    ("phone", r"\+\d{1,3}[ .-]?\(?\d{2,4}\)?(?:[ .-]?\d{2,4}){2,4}(?!\d)|\(\d{3}\) ?\d{3}-\d{4}(?!\d)|(?<![\d.-])\d{3}[-.]\d{3}[-.]\d{4}(?!\d)"),
    ("ssn", r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"),
    ("iban", rf"\b(?=[A-Z]{{2}}\d{{2}})(?:{IBAN})"),
    ("woman", rf"\b(?:{TITLES_F})\.? {NAME}(?: {NAME})?"),
    ("man", rf"\b(?:{TITLES_M})\.? {NAME}(?: {NAME})?"),
)
ANY = "|".join(f"(?:{p})" for _, p in PATTERNS)
LEAD = {"secret": f"^{SECRET}", "woman": rf"^(?:{TITLES_F})\.? ", "man": rf"^(?:{TITLES_M})\.? "}
TAGGED = 6
#: Letters of a kind, by the class that a letter is in; the first that fits counts.
ALPHABETS = (
    (r"\p{IsCyrillic}&&\p{Lu}", "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ"), (r"\p{IsCyrillic}", "абвгдежзиклмнопрстуфхцчшэюя"),
    (r"\p{IsGreek}&&\p{Lu}", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ"), (r"\p{IsGreek}", "αβγδεζηθικλμνξοπρστυφχψω"),
    (r"\p{IsHan}", "山水火木金土日月田中大小上下人口"), (r"\p{Lu}", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), (r"\p{L}", "abcdefghijklmnopqrstuvwxyz"), (r"\p{N}", "0123456789"),
)
DIGITS_ONLY = ("card", "phone", "ssn")
LATIN = ("ba", "de", "fi", "go", "lu", "ma", "ne", "ri", "so", "tu", "va", "we", "ka", "le", "mi", "no")
CYRILLIC = ("ба", "де", "фи", "го", "лу", "ма", "не", "ри", "со", "ту", "ва", "ви", "ка", "ле", "ми", "но")
#: Endings: kind of name, for Latin and for Cyrillic letters.
ENDINGS = {"given_f": ("na", "на"), "given_m": ("n", "н"), "surname": ("ler", "лер"), "surname_f": ("lova", "лова"), "surname_m": ("lov", "лов")}


def chars(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def byte(stream: Column, i: Column) -> Column:
    """The i-th number (0 to 255) of a stream of 256 hexadecimal digits, round and round."""
    return F.conv(F.substring(stream, (i % 128) * 2 + 1, F.lit(2)), 16, 10).cast("int")


def pick(letters: str, n: Column) -> Column:
    return F.substring(F.lit(letters), n % len(letters) + 1, F.lit(1))


def alike(value: Column, stream: Column, hexa: Column | None = None) -> Column:
    """Each letter or digit replaced by one of its kind, in whatever script; signs stay."""
    def one(c: Column, i: Column) -> Column:
        n = byte(stream, i)
        kinds = [F.when(c.rlike(f"[{kind}]"), pick(letters, n)) for kind, letters in ALPHABETS]
        plain = F.coalesce(*kinds, c)
        return plain if hexa is None else F.when(hexa & c.rlike("[0-9a-f]"), pick("0123456789abcdef", n)).otherwise(plain)

    return F.array_join(F.transform(chars(value), one), "")


def generated(value: Column, stream: Column) -> Column:
    """Letters and digits in place of a value that has none, such as a masked password."""
    size = F.least(F.greatest(F.length(value), F.lit(8)), F.lit(128))
    return F.array_join(F.transform(F.sequence(F.lit(1), size), lambda i: pick("abcdefghjkmnpqrstuvwxyz23456789", byte(stream, i))), "")


def luhn(digits: Column, skip: int) -> Column:
    """The Luhn sum of a number whose last digits number `skip` are left out."""
    double = lambda d: F.when(d * 2 > 9, d * 2 - 9).otherwise(d * 2)
    value = lambda c, i: F.when((i + skip) % 2 == 1, double(c.cast("int"))).otherwise(c.cast("int"))
    return F.aggregate(F.transform(F.reverse(chars(digits)), value), F.lit(0), lambda a, x: a + x)


def made_name(kind: Column, value: Column, stream: Column, attempt: Column) -> Column:
    """A name of syllables; longer with each attempt."""
    cyrillic = value.rlike(r"\p{IsCyrillic}")
    syllables = lambda parts: F.array_join(F.transform(F.sequence(F.lit(0), attempt + 2), lambda i: F.element_at(F.array(*map(F.lit, parts)), byte(stream, i) % len(parts) + 1)), "")
    end = lambda k: F.coalesce(*(F.when(kind == x, F.lit(e[k])) for x, e in ENDINGS.items()))
    return F.initcap(F.when(cyrillic, F.concat(syllables(CYRILLIC), end(1))).otherwise(F.concat(syllables(LATIN), end(0))))


def surrogate(kind: Column, value: Column, attempt: Column, key: str) -> Column:
    """The surrogate of a canonical value at an attempt."""
    stream = F.concat(*(F.sha2(F.concat_ws("\x01", F.lit(key), kind, value, attempt.cast("string"), F.lit(str(i))), 256) for i in range(4)))
    number = lambda i: byte(stream, F.lit(i))
    address = F.concat_ws(".", (240 + number(0) % 15).cast("string"), *(number(i).cast("string") for i in (1, 2, 3)))
    local, size = F.substring_index(value, "@", 1), F.length(value)
    email = F.concat(alike(local, stream), F.lit("@mail"), (number(120) * 256 + number(121)).cast("string"), F.lit(".example.net"))
    most = F.concat(F.substring(value, 1, 1), alike(F.substring(value, F.lit(2), size - 2), stream))
    check = pick("0123456789", (10 - luhn(most, 1) % 10) % 10)
    valid = luhn(value, 0) % 10 == 0
    card = F.concat(most, F.when(valid, check).otherwise(pick("0123456789", number(60))))
    hexa = (kind == "secret") & value.rlike("^[0-9a-f]+$") & value.rlike("[a-f]")
    first = (
        F.when(kind == "email", email)
        .when(kind == "ip", address)
        .when(kind == "card", card)
        .when(kind == "phone", F.concat(F.substring(value, 1, 1), pick("23456789", number(61)), alike(F.substring(value, F.lit(3), size), stream)))
        .when(kind == "cloud_key", F.concat(F.lit("AKIA"), alike(F.substring(value, F.lit(5), size), stream)))
        .when(kind == "iban", F.concat(F.substring(value, 1, 2), alike(F.substring(value, F.lit(3), size), stream)))
        .when(kind.startswith("given") | kind.startswith("surname"), made_name(kind, value, stream, attempt))
        .when(value.rlike(r"[\p{L}\p{N}]"), alike(value, stream, hexa))
        .otherwise(generated(value, stream))
    )
    # One more digit with each attempt: a tenth of the clashes at most is left each time.
    digits = F.substring(F.translate(stream, "abcdef", "012345"), F.lit(200), attempt - (TAGGED - 1))
    return F.when(attempt < TAGGED, first).when(kind == "email", F.concat(digits, first)).when(kind == "ip", F.concat(first, F.lit(":"), digits)).otherwise(F.concat(first, digits))


def parts_of(match: Column) -> Column:
    """What stays in front of a match, and its entities as type, value and canonical value."""
    kind = F.coalesce(*(F.when(match.rlike(f"^(?:{p})$"), F.lit(k)) for k, p in PATTERNS), F.lit("secret"))
    lead = F.coalesce(*(F.when(kind == k, F.regexp_extract(match, p, 0)) for k, p in LEAD.items()), F.lit(""))
    value = F.substring(match, F.length(lead) + 1, F.length(match))
    words = F.split(value, " ")
    person = kind.isin("woman", "man")
    family = lambda w: F.when(w.rlike(r"\p{IsCyrillic}"), F.when(w.rlike("[ая]$"), "surname_f").otherwise("surname_m")).otherwise("surname")
    given = F.when(kind == "woman", "given_f").otherwise("given_m")
    names = F.transform(words, lambda w, i: F.struct(F.when((F.size(words) > 1) & (i == 0), given).otherwise(family(w)).alias("kind"), w.alias("value"), w.alias("canon")))
    canon = F.when(kind.isin(*DIGITS_ONLY), F.regexp_replace(value, r"\D", "")).when(kind == "email", F.lower(value)).when(kind == "iban", F.replace(value, F.lit(" "), F.lit(""))).otherwise(value)
    return F.struct(lead.alias("lead"), F.when(person, names).otherwise(F.array(F.struct(kind.alias("kind"), value.alias("value"), canon.alias("canon")))).alias("entities"))


def in_format(kind: Column, value: Column, made: Column) -> Column:
    """A surrogate's characters in the places that the entity's have in the text."""
    step = lambda acc, c: F.when(c.rlike("[0-9A-Za-z]"), F.struct(F.concat(acc["s"], F.substring(made, acc["i"], F.lit(1))).alias("s"), (acc["i"] + 1).alias("i"))).otherwise(F.struct(F.concat(acc["s"], c).alias("s"), acc["i"].alias("i")))
    # What a lengthened surrogate has beyond the places comes last.
    rest = lambda acc: F.concat(acc["s"], F.substring(made, acc["i"], F.length(made)))
    spread = F.aggregate(chars(value), F.struct(F.lit("").alias("s"), F.lit(1).alias("i")), step, rest)
    return F.when(kind.isin(*DIGITS_ONLY, "iban"), spread).otherwise(made)


def row_key(row_id: Column, text: Column) -> Column:
    return F.unhex(F.md5(F.concat(F.coalesce(row_id.cast("string"), F.lit("-")), F.lit(":"), F.coalesce(text, F.lit("")))))


def mapping(entities: DataFrame, key: str) -> DataFrame:
    """A surrogate for each distinct `kind`, `canon`. Rounds end when no two agree; each round
    decides all surrogates that came up once, so few entities go on. They do end, as the forms
    grow with the attempts."""
    made = lambda rows: rows.withColumn("made", surrogate(F.col("kind"), F.col("canon"), F.col("attempt"), key))
    family = F.regexp_replace("kind", "_.$", "")
    entities = stage(entities.select("kind", "canon").distinct(), "entities")
    taken = entities.select(family.alias("family"), F.col("canon").alias("made"))
    settled, open_ = None, entities.withColumn("attempt", F.lit(0))
    while True:
        tried = made(open_).withColumn("family", family)
        nth = Window.partitionBy("family", "made").orderBy("kind", "canon")
        tried = stage(tried.withColumn("nth", F.row_number().over(nth)), "tried")
        good = tried.where("nth = 1").join(taken, ["family", "made"], "left_anti")
        settled = stage(good.select("kind", "canon", "made") if settled is None else settled.union(good.select("kind", "canon", "made")), "settled")
        open_ = tried.join(settled, ["kind", "canon"], "left_anti").select("kind", "canon", (F.col("attempt") + 1).alias("attempt"))
        if open_.isEmpty():
            return settled
        taken = stage(taken.union(good.select("family", "made")), "taken")


def surrogates(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: id, `text` with surrogates, `n_entities` and `kinds` (the types
    found, sorted). `key` keys the hash: keep it secret, and the same to get the same surrogates."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    keyed = rows.withColumn("key", row_key(F.col("id"), F.col("text")))
    matches = keyed.select("key", F.posexplode(F.regexp_extract_all("text", F.lit(ANY), F.lit(0))).alias("pos", "match"))
    hits = matches.distinct().select("key", "pos", parts_of(F.col("match")).alias("p"))
    hits = stage(hits.select("key", "pos", F.col("p.lead").alias("lead"), F.posexplode("p.entities").alias("word", "e")).select("key", "pos", "lead", "word", "e.*"), "hits")
    found = hits.join(mapping(hits, key), ["kind", "canon"])
    named = F.col("kind").startswith("given") | F.col("kind").startswith("surname")
    word = F.struct("word", in_format(F.col("kind"), F.col("value"), F.col("made")).alias("made"))
    found = found.groupBy("key", "pos", "lead").agg(F.array_sort(F.collect_list(word)).alias("words"), F.collect_set("kind").alias("kinds"), F.collect_set(F.when(named, F.struct("value", "made"))).alias("names"))
    whole = F.concat("lead", F.array_join(F.transform("words", lambda w: w["made"]), " "))
    found = found.groupBy("key").agg(
        F.array_sort(F.collect_list(F.struct("pos", whole.alias("made")))).alias("made"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("kinds")))).alias("kinds"),
        F.array_distinct(F.flatten(F.collect_list("names"))).alias("names"), F.sum(F.size("words")).alias("n_entities"),
    )
    found = stage(found, "replacements")
    # One kind of join at every size: replacements grow with the texts.
    both = keyed.join(found.hint("merge"), "key", "left")
    # Bare mentions are replaced between the matches, where no surrogate stands yet.
    name = lambda text, x: F.call_function("regexp_replace", text, F.concat(F.lit(r"(?<!\p{L})\Q"), x["value"], F.lit(r"\E(?!\p{L})")), x["made"])
    between = F.transform(F.split("text", ANY, -1), lambda t: F.aggregate("names", t, name))
    text = F.array_join(F.transform(between, lambda t, i: F.concat(t, F.coalesce(F.get("made", i)["made"], F.lit("")))), "")
    none = F.array().cast("array<string>")
    return both.select(
        F.col("id").alias(id_col), F.when(F.col("made").isNull(), F.col("text")).otherwise(text).alias("text"),
        F.coalesce("n_entities", F.lit(0)).cast("long").alias("n_entities"), F.coalesce("kinds", none).alias("kinds"),
    )
