"""Surrogates for personal data, in DataFrame functions only.

Entities are found by patterns. Each distinct entity gets a replacement of its own type, drawn from a keyed hash of its
normalised form, so the same entity has the same surrogate wherever it occurs (coreference) and nobody without the key can
draw it again. Format is kept: letters become letters of the same case and script, digits digits, separators stay; phone
numbers keep their country code, card numbers their issuer digit, grouping and check digit, addresses their range. Names after
a title keep its gender and their script; given names and surnames are replaced one by one, so a person named in full and by
surname only stays one person.

Collision checks preserve distinctness: in the table of distinct entities (one row each, however often they occur) no two may
have the same surrogate and no surrogate may be an entity of the corpus; those that clash draw again with the next attempt.
A format may have fewer surrogates than the corpus has entities, so every few attempts widen it: names gain a syllable,
addresses other lengths and then other ranges, numbers, mail boxes and secrets a digit.
"""

from __future__ import annotations

import hashlib
import secrets

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.llm.common import Scratch, fits, table

#: The session's setting that holds the key.
KEY = "spark.tidewheel.pii.key"
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
#: Patterns by type, first match first (Java syntax); possessive bounds keep long runs linear.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}_%+-][\p{L}\p{N}._%+-]{0,63}+@(?:[\p{L}\p{N}-]{1,63}\.){1,8}\p{L}{2,24}(?![\p{L}\p{N}])",
    "aws_key": r"(?<![A-Za-z0-9])A[KS]IA[0-9A-Z]{16}(?![A-Za-z0-9])",
    "secret": r"(?i:(?<=\b(?:password|passwd|pwd|token|secret|api_key|apikey|api-key)[ ]{0,2}[=:][ ]{0,2}[\"']{0,1}))[^\s\"',;!=:]{6,}+",
    "ip": rf"(?<![0-9.]){_OCTET}(?:\.{_OCTET}){{3}}(?![0-9]|\.[0-9])",
    # eight groups, or a run of zero groups left out; the latter with a digit, as names in code are written so too
    "ipv6": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])"
    r"|(?=[0-9A-Fa-f]{0,4}:)(?<![\p{L}\p{N}_:])(?=[A-Fa-f:]*+[0-9])(?!(?:[0-9A-Fa-f]{0,4}:){9})(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})?::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})?(?![\p{L}\p{N}_:]|\.[0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]{4}){3,7}(?:[ ]?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "phone": r"(?<![\p{L}0-9+])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}|\([0-9]{3}\)[ .-]?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})(?![0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "card": r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])",
    "person": r"(?<![\p{L}])(?:Mr|Mrs|Ms|Miss|Herr|Frau|Monsieur|Madame|Mme|Señor|Señora|Sr|Sra|Signor|Signora|Г-н|Г-жа|Господин|Госпожа)\.?[ ]\p{Lu}[\p{L}'-]{1,30}(?:[ ]\p{Lu}[\p{L}'-]{1,30}){0,2}",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: What a text with any entity has; spares most texts the patterns. Each alternative begins with a class, so most places cost one look.
HINT = r"[0-9@=:]|[MHFSГ](?:rs?|iss|s|onsieur|adame|me|err|rau|eñora?|ra?|ignora?|-н|-жа|осподин|оспожа)\.?[ ]\p{Lu}"
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Signora", "Г-жа", "Госпожа")
#: Given names by gender and script (fixed values).
GIVEN = {
    "f latin": ("Anna", "Clara", "Elena", "Emma", "Greta", "Hanna", "Ida", "Julia", "Laura", "Lea", "Maria", "Marta", "Nina", "Nora", "Olga", "Paula", "Rosa", "Sara", "Sofia", "Vera"),
    "m latin": ("Adam", "Anton", "Bruno", "Carl", "David", "Emil", "Felix", "Georg", "Hugo", "Ivan", "Jonas", "Leo", "Lukas", "Marco", "Martin", "Oscar", "Paul", "Peter", "Simon", "Victor"),
    "f cyrillic": ("Анна", "Вера", "Дарья", "Елена", "Ирина", "Мария", "Нина", "Ольга", "Софья", "Юлия"),
    "m cyrillic": ("Антон", "Борис", "Виктор", "Глеб", "Денис", "Иван", "Максим", "Олег", "Павел", "Роман"),
}
#: Syllables of surnames by script.
SYLLABLES = {
    "latin": ("ba", "be", "bo", "da", "de", "do", "fa", "fe", "ga", "go", "ha", "he", "ka", "ke", "ko", "la", "le", "li", "lo", "ma", "me", "mi", "mo", "na", "ne", "no", "ra", "re", "ri", "ro", "sa", "ta"),
    "cyrillic": ("ба", "бе", "во", "га", "го", "да", "де", "до", "за", "ка", "ко", "ла", "ле", "ло", "ма", "ми", "мо", "на", "не", "но", "па", "по", "ра", "ре", "ро", "са", "си", "та", "то", "фа", "ха", "че"),
}

#: Attempts before a format is widened by one more step.
PATIENCE = 3


def let(value: Column, body) -> Column:
    """body(value) with value computed once a row."""
    return F.transform(F.array(value), body)[0]


def kind_of(entity: Column) -> Column:
    """Type of a found entity by its shape; what matches no other pattern was found as a secret."""
    found = F.lit("secret")
    for name in reversed([n for n in PATTERNS if n != "secret"]):
        found = F.when(entity.rlike(f"^(?:{PATTERNS[name]})$"), name).otherwise(found)
    return found


def normal(kind: Column, entity: Column) -> Column:
    """What makes two spellings the same entity."""
    return F.when(kind.isin("phone", "card", "ssn"), F.regexp_replace(entity, r"[^0-9+]", "")).when(kind.isin("email", "ipv6"), F.lower(entity)).when(kind == "iban", F.replace(entity, F.lit(" "), F.lit(""))).otherwise(entity)


def digest(key: str, *parts: Column) -> Column:
    """128 hexadecimal digits of a keyed hash: HMAC-SHA256 of the parts and 1, then of the parts and 2."""
    padded = (hashlib.sha256(key.encode()).digest() if len(key.encode()) > 64 else key.encode()).ljust(64, b"\0")
    inner, outer = (F.lit(bytes(b ^ x for b in padded)) for x in (0x36, 0x5C))
    message = F.concat_ws("\x1f", *parts)
    half = lambda k: F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, F.concat(message, F.lit(f"\x1f{k}")).cast("binary")), 256))), 256)
    return F.concat(half(1), half(2))


def drawn(bits: Column, at: Column, below: int) -> Column:
    """A number below `below` from four digits of the hash, by position."""
    return F.conv(F.substr(bits, F.pmod(at * 4, F.lit(124)) + 1, F.lit(4)), 16, 10).cast("int") % below


def reshaped(text: Column, bits: Column, hexadecimal: Column) -> Column:
    """Letters become letters of the same case and script, digits digits; a first digit that isn't 0 stays so; the rest stays."""
    pick = lambda letters, c, k: F.substr(F.lit(letters), drawn(bits, k, len(letters)) + 1, F.lit(1))

    def one(c: Column, k: Column) -> Column:
        lower = F.when(c.rlike(r"\p{IsCyrillic}"), pick("абвгдезиклмнопрстуфхчшэюя", c, k)).when(hexadecimal, pick("abcdef", c, k)).otherwise(pick("abcdefghijklmnopqrstuvwxyz", c, k))
        digit = F.when((k == 0) & (c != "0"), pick("123456789", c, k)).otherwise(pick("0123456789", c, k))
        return F.when(c.between("0", "9"), digit).when(c.rlike(r"\p{Ll}"), lower).when(c.rlike(r"\p{L}"), F.upper(lower)).otherwise(c)

    return F.array_join(F.transform(F.split(text, ""), one), "")


def luhn_sum(digits: Column) -> Column:
    """Luhn sum of a string of digits whose check digit is last."""
    values = F.reverse(F.split(digits, ""))
    doubled = F.transform(values, lambda d, k: F.when(k % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0)))


def new_card(norm: Column, bits: Column) -> Column:
    """Digits only: issuer digit kept; the check digit is right if it was."""
    body = F.concat(F.substring(norm, 1, 1), F.substr(reshaped(norm, bits, F.lit(False)), F.lit(2), F.length(norm) - 2))
    right = let(body, lambda b: F.concat(b, ((10 - luhn_sum(F.concat(b, F.lit("0"))) % 10) % 10).cast("string")))
    wrong = let(right, lambda r: F.concat(F.substr(r, F.lit(1), F.length(r) - 1), ((F.substring(r, -1, 1).cast("int") + 1 + drawn(bits, F.lit(30), 9)) % 10).cast("string")))
    return F.when(luhn_sum(norm) % 10 == 0, right).otherwise(wrong)


def wider(attempt: Column) -> Column:
    """By how many steps the format of a surrogate is widened."""
    return F.floor(attempt / PATIENCE).cast("int")


def more(bits: Column, steps: Column, letters=tuple("0123456789")) -> Column:
    """So many more letters of the given ones, '' for 0 steps. From the hash's end, which short texts leave alone."""
    table_ = F.array(*map(F.lit, letters))
    found = F.transform(F.sequence(F.lit(1), F.greatest(steps, F.lit(1))), lambda k: F.get(table_, drawn(bits, 31 - k, len(letters))))
    return F.when(steps > 0, F.array_join(found, "")).otherwise("")


def new_ip(norm: Column, bits: Column, steps: Column) -> Column:
    """Octets of as many digits; private ranges stay private. Then octets of any length, then private ones anywhere in 10.*, then any address."""
    parts = F.split(norm, r"\.")

    def octet(value: Column, k: Column) -> Column:
        size = F.length(value)
        return F.when(steps > 0, 1 + drawn(bits, k, 254)).when(size == 1, 1 + drawn(bits, k, 9)).when(size == 2, 10 + drawn(bits, k, 90)).otherwise(100 + drawn(bits, k, 155)).cast("string")

    kept = F.when(steps > 5, 0).when(parts[0].isin("10", "127"), 1).when((parts[0] == "192") & (parts[1] == "168"), F.when(steps > 2, 1).otherwise(2)).otherwise(0)
    return F.array_join(F.transform(parts, lambda v, k: F.when(k < kept, F.when(steps > 2, "10").otherwise(v)).otherwise(octet(v, k))), ".")


def new_ipv6(norm: Column, bits: Column, steps: Column) -> Column:
    """Hexadecimal digits where they stood; then eight groups, of which the first stays."""
    first = F.substring_index(norm, ":", 1)
    groups = F.transform(F.sequence(F.lit(1), F.lit(7)), lambda k: F.substr(bits, 4 * k + 1, F.lit(4)))
    return F.when(steps > 0, F.concat(F.when(first == "", "fd00").otherwise(first), F.lit(":"), F.array_join(groups, ":"))).otherwise(reshaped(norm, bits, F.lit(True)))


def new_phone(norm: Column, bits: Column) -> Column:
    """Digits with the country code; a fictional exchange (555) stays one."""
    code = F.regexp_extract(norm, r"^(\+1|\+7|\+[0-9]{2})?", 1)
    rest = F.substr(norm, F.length(code) + 1, F.length(norm))
    fresh = let(rest, lambda r: reshaped(r, bits, F.lit(False)))
    fictional = (F.length(rest) == 10) & (F.substring(rest, 4, 3) == "555")
    return F.concat(code, F.when(fictional, F.concat(F.substring(fresh, 1, 3), F.lit("555"), F.substring(fresh, 7, 4))).otherwise(fresh))


def new_email(norm: Column, bits: Column, steps: Column) -> Column:
    """Local part reshaped, the domain's host names too; the last two labels become example.<same ending>."""
    local, domain = F.substring_index(norm, "@", 1), F.substring_index(norm, "@", -1)
    hosts = F.regexp_extract(domain, r"^((?:.*\.)?)[^.]+\.[^.]+$", 1)
    return F.concat(reshaped(local, bits, F.lit(False)), more(bits, steps), F.lit("@"), reshaped(hosts, F.reverse(bits), F.lit(False)), F.lit("example."), F.substring_index(domain, ".", -1))


def script_of(text: Column) -> Column:
    return F.when(text.rlike(r"\p{IsCyrillic}"), "cyrillic").otherwise("latin")


def new_name(kind: Column, norm: Column, bits: Column, steps: Column) -> Column:
    """A given name of the same gender and script, or a surname of syllables of the script. Each step of widening adds a syllable."""
    script = script_of(norm)
    found = F.lit(None).cast("string")
    for name, letters in SYLLABLES.items():
        table_ = F.array(*map(F.lit, letters))
        surname = F.initcap(F.concat(*(F.get(table_, drawn(bits, F.lit(4 + k), len(letters))) for k in range(4))))
        given = F.lit(None).cast("string")
        for gender in "fm":
            names = F.array(*map(F.lit, GIVEN[f"{gender} {name}"]))
            given = F.when(kind == f"given_{gender}", F.concat(F.get(names, drawn(bits, F.lit(1), len(GIVEN[f"{gender} {name}"]))), F.get(table_, drawn(bits, F.lit(9), len(letters))))).otherwise(given)
        found = F.when(script == name, F.concat(F.coalesce(given, surname), more(bits, steps, letters))).otherwise(found)
    return found


def surrogate(key: str, kind: Column, norm: Column, attempt: Column) -> Column:
    """The normalised surrogate of a normalised entity."""

    steps = wider(attempt)

    def of(bits: Column) -> Column:
        hexadecimal = norm.rlike(r"^[0-9a-f]+$") | norm.rlike(r"^[0-9A-F]+$")
        return (
            F.when(kind == "email", new_email(norm, bits, steps))
            .when(kind == "ip", new_ip(norm, bits, steps))
            .when(kind == "ipv6", new_ipv6(norm, bits, steps))
            .when(kind == "phone", F.concat(new_phone(norm, bits), more(bits, steps)))
            .when(kind == "card", new_card(norm, bits))
            .when(kind == "ssn", F.concat(F.lit("9"), F.substr(reshaped(norm, bits, F.lit(False)), F.lit(2), F.length(norm)), more(bits, steps)))
            .when(kind == "iban", F.concat(F.substring(norm, 1, 2), F.substr(reshaped(norm, bits, F.lit(False)), F.lit(3), F.length(norm))))
            .when(kind == "aws_key", F.concat(F.substring(norm, 1, 4), F.substr(reshaped(norm, bits, F.lit(False)), F.lit(5), F.length(norm))))
            .when(kind.isin("given_f", "given_m", "surname"), new_name(kind, norm, bits, steps))
            .otherwise(F.concat(reshaped(norm, bits, hexadecimal), F.when(kind == "secret", more(bits, steps)).otherwise("")))
        )

    return let(digest(key, kind, norm, attempt.cast("string")), of)


def dressed(kind: Column, entity: Column, fresh: Column) -> Column:
    """A normalised surrogate in the spelling of the occurrence: separators of numbers where they stood, capitals of an address in capitals. Digits that the surrogate has more come last."""

    def stands(c: Column) -> Column:
        return F.when(kind == "iban", c != " ").otherwise(c.rlike("[0-9+]"))

    def spaced(chars: Column) -> Column:
        rest = F.substr(fresh, F.size(F.filter(chars, stands)) + 1, F.length(fresh))
        return F.concat(F.array_join(F.transform(chars, lambda c, k: F.when(stands(c), F.substr(fresh, F.size(F.filter(F.slice(chars, F.lit(1), k + 1), stands)), F.lit(1))).otherwise(c)), ""), rest)

    capitals = (kind == "email") & (F.upper(entity) == entity)
    return F.when(kind.isin("phone", "card", "ssn", "iban"), let(F.split(entity, ""), spaced)).when(capitals, F.upper(fresh)).otherwise(fresh)


def units_of(entity: Column) -> Column:
    """The parts of an entity that are replaced: struct(kind, norm, raw). A person gives one for each name."""
    kind = kind_of(entity)
    parts = F.split(entity, " ")
    gender = F.when(F.regexp_replace(parts[0], r"\.$", "").isin(*FEMALE), "given_f").otherwise("given_m")
    names = F.transform(
        F.slice(parts, 2, F.size(parts)), lambda name, k: F.struct(F.when(k < F.size(parts) - 2, gender).otherwise("surname").alias("kind"), name.alias("norm"), name.alias("raw"))
    )
    single = F.array(F.struct(kind.alias("kind"), normal(kind, entity).alias("norm"), entity.alias("raw")))
    return F.when(kind == "person", names).otherwise(single)


def assign(entities: DataFrame, key: str, scratch: Scratch, rounds: int = 60) -> DataFrame:
    """(kind, norm) to (kind, norm, fresh) without collisions.

    Each round those that clash with another entity's surrogate (all but the first) or with an entity draw again. Rounds end
    when none clash; every few attempts widen the space. An entity without a surrogate after all rounds is an error, not a silent repeat.
    """
    now = scratch.keep(entities.select("kind", "norm", F.lit(0).alias("attempt"), surrogate(key, F.col("kind"), F.col("norm"), F.lit(0)).alias("fresh")), "assigned-0")
    known = entities.select(F.col("norm").alias("fresh")).distinct()
    for step in range(1, rounds + 1):
        first = now.groupBy("fresh").agg(F.min(F.struct("attempt", "kind", "norm")).alias("first"), F.count("*").alias("n")).where("n > 1")
        repeated = now.join(first, "fresh").where(F.struct("attempt", "kind", "norm") != F.col("first")).select("kind", "norm")
        taken = now.join(known, "fresh", "left_semi").select("kind", "norm")
        again = repeated.union(taken).distinct().withColumn("clash", F.lit(True))
        if again.isEmpty():
            return now
        bumped = now.join(again, ["kind", "norm"], "left").withColumn("attempt", F.col("attempt") + F.coalesce(F.col("clash").cast("int"), F.lit(0)))
        fresh = F.when(F.col("clash"), surrogate(key, F.col("kind"), F.col("norm"), F.col("attempt"))).otherwise(F.col("fresh"))
        now = scratch.keep(bumped.select("kind", "norm", "attempt", fresh.alias("fresh")), f"assigned-{step}")
        scratch.drop(f"assigned-{step - 1}")
    raise ValueError("some entities found no surrogate of their own; their format leaves too few")


def replace_pii(docs: DataFrame, key: str) -> DataFrame:
    """Documents with surrogates: all columns of docs, text replaced, and n_replaced long; one row for each row of docs.

    The same key gives the same surrogates, also for other tables; whoever has it can draw them again, so it must be secret.
    docs needs text; other columns pass through whatever their names (n_replaced is replaced if there). Null texts stay null
    and empty ones empty; a repeated row is replaced the same way; an empty table gives an empty table.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "pii")
    columns = [c for c in docs.columns if c != "n_replaced"]
    hits = F.when(F.col("text").rlike(HINT), F.regexp_extract_all(F.col("text"), F.lit(ANY), F.lit(0)))
    hits = F.when(F.size(hits) > 0, hits)
    searched = docs.select(*columns).withColumn("__hits", hits)
    numbered = scratch.keep(searched.where("__hits is not null").withColumn("__row", F.monotonically_increasing_id()), "touched")
    spots = numbered.select(F.explode(F.array_distinct("__hits")).alias("entity")).distinct()  # one row for an entity of the corpus
    units = spots.select("entity", F.posexplode(units_of(F.col("entity"))).alias("at", "unit")).select("entity", "at", "unit.*")
    units = scratch.keep(units, "units")
    fresh = assign(units.select("kind", "norm").distinct(), key, scratch)
    spelled = units.join(fresh.select("kind", "norm", "fresh"), ["kind", "norm"]).select("entity", "at", dressed(F.col("kind"), F.col("raw"), F.col("fresh")).alias("new"), "kind")
    whole = spelled.groupBy("entity").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "new"))), lambda s: s["new"]), " ").alias("new"), F.max("kind").alias("kind"))
    person = F.col("kind").isin("given_f", "given_m", "surname")
    whole = scratch.keep(whole.select("entity", F.when(person, F.concat(F.substring_index("entity", " ", 1), F.lit(" "), F.col("new"))).otherwise(F.col("new")).alias("new")), "mapping")
    scratch.drop("units")

    pieces = F.split(F.col("text"), ANY, -1)
    own = numbered.select("__row", F.explode(F.array_distinct("__hits")).alias("entity"))
    small = fits(whole, "entity", "new")
    maps = own.join(F.broadcast(whole) if small else whole, "entity").groupBy("__row").agg(F.map_from_entries(F.collect_list(F.struct("entity", "new"))).alias("__map"))
    filled = numbered.join(maps, "__row").withColumn("__pieces", pieces)
    glued = F.array_join(F.transform("__pieces", lambda p, k: F.concat(p, F.coalesce(F.element_at(F.col("__map"), F.get(F.col("__hits"), k)), F.lit("")))), "")
    done = filled.withColumn("text", glued).withColumn("n_replaced", F.size("__hits").cast("long")).select(*columns, "n_replaced")
    rest = searched.where("__hits is null").select(*columns).withColumn("n_replaced", F.lit(0).cast("long"))
    return rest.unionByName(done)


def op2_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Surrogates under the session's key; without one, under a key that is drawn for this query and kept nowhere."""
    key = spark.conf.get(KEY, None) or secrets.token_hex(32)
    return replace_pii(table(spark, sf_dir, "documents").select("doc_id", "text"), key).select("doc_id", "text", "n_replaced")
