"""Personal data replaced by surrogates, with DataFrame functions only.

Entities are found by one regular expression. Each distinct entity of the table gets one surrogate, drawn character by
character from SHA-256 of a secret key, the kind, the entity and an attempt number, so the same entity has the same
surrogate in all texts (coreference): phones, cards and numbers of accounts by their digits and letters, however they are
spaced, names word by word, so that Mr. Smith and Mr. John Smith share the family name. Surrogates keep what makes the
kind: digits stay digits, letters stay letters of their script, separators, calling codes, countries, prefixes of keys,
top-level domains, the first digit and the Luhn sum of card numbers and the check digits of IBANs stay right; a person's
surrogate keeps the title and takes given names of the title's gender in the script of the name, initials stay initials. Surrogates that two
entities share, or that are entities of the table themselves, are found by grouping and drawn again with the next
attempt, until all are distinct.

The key is the setting spark.plumbline.pii.key. Where it is unset, an application draws a random key of its own: then
surrogates agree within the application only, but no one can draw them again.

Texts without a digit, an @, a title or a key's prefix pass through without a shuffle. The others are joined with their
replacements by a digest of the text, so copies are replaced alike and very common texts or entities are plain skewed
joins between two exchanges, which adaptive execution splits.

Numbers as long as a card's whose Luhn sum doesn't fit stay, as do card numbers next to a letter.

Not detected: persons without a title (a bare Smith stays), names of more than three words beside initials, particles of names
in small letters (van, de), street addresses, dates of birth, phones without + in other
forms than those of `national`, and secrets of other forms than those of `secret` and `key`. A phone's national and
international forms are two entities, as is a name under titles of different gender.
"""

from __future__ import annotations

import secrets

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._spark import free, written

KEY_SETTING = "spark.plumbline.pii.key"
_drawn: dict[str, str] = {}
# Titles by gender, and given names and family-name syllables by script.
FEMALE = ["Mrs", "Ms", "Miss", "Frau", "Señora", "Señorita", "Madame", "Mme", "г-жа"]
MALE = ["Mr", "Herr", "Señor", "Monsieur", "г-н"]
NEUTRAL = ["Dr", "Prof"]
GIVEN = {
    ("latin", "f"): ["Anna", "Clara", "Elena", "Greta", "Irene", "Julia", "Laura", "Maria", "Nora", "Paula", "Rosa", "Sofia", "Teresa", "Vera"],
    ("latin", "m"): ["Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Georg", "Hugo", "Ivan", "Jonas", "Leon", "Martin", "Oscar", "Paul"],
    ("cyrillic", "f"): ["Анна", "Вера", "Дарья", "Елена", "Ирина", "Мария", "Нина", "Ольга"],
    ("cyrillic", "m"): ["Антон", "Борис", "Виктор", "Глеб", "Иван", "Максим", "Олег", "Павел"],
}
GIVEN |= {(s, "n"): GIVEN[s, "f"] + GIVEN[s, "m"] for s in ("latin", "cyrillic")}
SYLLABLES = {
    "latin": ["ba", "den", "far", "gol", "hem", "jor", "kal", "lin", "mar", "nov", "pel", "ran", "sor", "tav", "ul", "ven", "wes", "zan"],
    "cyrillic": ["ба", "вол", "гра", "ден", "жук", "зим", "кал", "лев", "мор", "нов", "пет", "рос", "сол", "тар", "фед", "чер"],
}
LETTERS = {
    "latin": "abcdefghijklmnopqrstuvwxyz",
    "accented": "áàâäçéèêëíîïñóôöúùûü",
    "cyrillic": "абвгдежзиклмнопрстуфхцчшэюя",
    "greek": "αβγδεζηθικλμνξοπρστυφχψω",
}
FEMALE, MALE, NEUTRAL = ([*names, *(n.upper() for n in names)] for names in (FEMALE, MALE, NEUTRAL))
_TITLE = "|".join(sorted(FEMALE + MALE + NEUTRAL, key=len, reverse=True))
#: One title, or several as in Prof. Dr.
_TITLES = rf"(?:{_TITLE})\.?(?: (?:{'|'.join(NEUTRAL)})\.?)*"
#: A word of a name: McDonald, O'Neill, Smith-Jones, SMITH; the 's of a genitive isn't part of it. Initials have a point.
_WORD = r"\p{Lu}(?:\p{L}++|(?=['’]\p{L}{2}))(?:-\p{L}++|['’]\p{L}{2,}+)*+"
_NAME = rf"(?:\p{{Lu}}\. ){{0,3}}{_WORD}(?: (?:\p{{Lu}}\. ){{0,2}}{_WORD}){{0,2}}"
#: Calling codes with one or two digits; all others have three.
_CALLING = r"\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"
#: A host has 127 labels at most and a label 63 characters, so no match goes deeper than that.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+\-])[\p{L}\p{N}._%+\-]++@(?:[\p{L}\p{N}\-]{1,63}+\.){1,126}\p{L}{2,24}(?![\p{L}\p{N}])",
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![\p{L}\p{N}])",
    "key": r"(?<![\p{L}\p{N}_\-])(?:(?:sk|pk|rk)_(?:live|test)_[0-9A-Za-z]{16,}+|gh[opsu]_[0-9A-Za-z]{36}|xox[abp]-[0-9A-Za-z\-]{10,}+|A[KS]IA[0-9A-Z]{16})(?![\p{L}\p{N}])",
    "secret": r"(?<![0-9A-Za-z])(?:[0-9A-Fa-f]{32,64}|(?=\d{0,63}[A-Fa-f])[0-9A-Fa-f]{65,}+)(?![0-9A-Za-z])",
    "ipv6": r"(?<![\p{L}\p{N}:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?=[0-9A-Fa-f:]{0,38}\d)(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![\p{L}\p{N}:])",
    "phone": r"(?<![\d+])\+\d{1,3}[ .\-]?(?:(?:\(\d{2,4}\)|\d{2,4})[ .\-]?\d{3,4}[ .\-]?\d{3,4}|\d(?:[ .\-]\d{2}){4})(?!\d)",
    "card": r"(?<![\p{L}\d.\-])(?:\d{13,19}|\d{4}[ \-]\d{4}[ \-]\d{4}[ \-]\d{4}|\d{4}[ \-]\d{6}[ \-]\d{5})(?![\p{L}\d\-]|\.\d)",
    "ssn": r"(?<![\d\-])\d{3}(?:-\d{2}-| \d{2} )\d{4}(?![\d\-])",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\d|\.\d)",
    "national": r"(?<![\d+.\-])(?:(?:1[ \-])?(?:\(\d{3}\) ?\d{3}[ .\-]\d{4}|\d{3}-\d{3}-\d{4}|\d{3}\.\d{3}\.\d{4})|0\d{2,4}[ \-]\d{3,4}[ \-]\d{4}|0\d(?:[ .\-]\d{2}){4})(?![\d\-]|\.\d)",
    "person": rf"(?<![\p{{L}}\p{{N}}\-]){_TITLES} {_NAME}",
}
ENTITY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: From this attempt on a surrogate gets a suffix, so that kinds with few possible values end as well.
WIDEN = 12


def key_of(spark: SparkSession) -> str:
    """The secret key: the setting, or a random one for this application."""
    return spark.conf.get(KEY_SETTING, None) or _drawn.setdefault(spark.sparkContext.applicationId, secrets.token_hex(32))


def _maybe(text: Column) -> Column:
    """Whether a text can hold an entity."""
    out = text.rlike("[0-9@]|_(?:live|test)_|gh[opsu]_|xox[abp]-|A[KS]IA")
    for title in FEMALE + MALE + NEUTRAL:
        out = out | F.contains(text, F.lit(title + " ")) | F.contains(text, F.lit(title + ". "))
    return F.coalesce(out, F.lit(False))


def _kind(surface: Column) -> Column:
    is_ = lambda name: surface.rlike(f"^(?:{PATTERNS[name]})$")
    return (
        F.when(F.contains(surface, F.lit("@")), "email")
        .when(surface.startswith("+"), "phone")
        .when(surface.rlike("^[0-9A-Fa-f]{32,}$"), "secret")
        .when(surface.rlike(r"^\d+\.\d+\.\d+\.\d+$"), "ip")
        .when(surface.rlike("^[0-9A-Fa-f:]+$") & F.contains(surface, F.lit(":")), "ipv6")
        .when(surface.rlike(r"^\d{3}(?:-\d{2}-| \d{2} )\d{4}$"), "ssn")
        .when(is_("national"), "phone")
        .when(surface.rlike(r"^[\d \-]+$"), F.when(_luhn(F.regexp_replace(surface, r"\D", "")) == 0, "card").otherwise(PLAIN))
        .when(is_("iban"), "iban")
        .when(is_("key"), "key")
        .otherwise("person")
    )


#: What the expression finds and is none: numbers as long as a card's without its check digit. They stay.
PLAIN = "plain"
#: Kinds that are known by their digits and letters alone, so that their separators are the surface's.
SPACED = ("phone", "card", "ssn", "iban")


def _title(surface: Column) -> Column:
    """The titles before a name, with the space after them; none for other kinds."""
    return F.regexp_extract(surface, rf"^({_TITLES} )\p{{Lu}}", 1)


def _parts(surface: Column, kind: Column) -> Column:
    """What each place's surface is known by: structs (kind, canonical, surface, before), one for each word of a name and one for all else.

    The last word of a name is the family's, hyphens divide words, so Smith-Jones shares a part with Smith; `before` is what stands before the part.
    Case doesn't count in addresses, secrets and names, titles not in names, separators not in numbers.
    """
    canonical = F.when(kind.isin("email", "secret", "ipv6"), F.lower(surface)).when(kind.isin(*SPACED), F.regexp_replace(surface, r"[^\p{L}\d+]", "")).otherwise(surface)
    sex = F.when(surface.rlike(rf"^(?:{'|'.join(FEMALE)})\.? "), "f").when(surface.rlike(rf"^(?:{'|'.join(NEUTRAL)})\.? "), "n").otherwise("m")
    words = F.split(F.substring(surface, F.length(_title(surface)) + 1, F.length(surface)), " ")
    part = lambda k, c, s, b: F.struct(k.alias("kind"), c.alias("canonical"), s.alias("surface"), b.alias("before"))
    plain = lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, F.lit(2), F.length(w))))

    def name(w: Column, i: Column) -> Column:
        of = F.when(w.rlike(r"^\p{Lu}\.$"), "initial").when(i == F.size(words) - 1, "family").otherwise(F.concat(F.lit("given "), sex))
        return F.transform(F.split(w, "-"), lambda p, j: part(of, plain(p), p, F.when(j > 0, "-").when(i > 0, " ").otherwise("")))

    return F.when(kind != "person", F.array(part(kind, canonical, surface, F.lit("")))).otherwise(F.flatten(F.transform(words, name)))


def _draw(seed: Column, at, below: int) -> Column:
    """A number below `below` from the seed and a place."""
    digest = F.sha2(F.concat_ws("|", seed, at.cast("string") if isinstance(at, Column) else F.lit(str(at))), 256)
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("bigint") % below).cast("int")


def _pick(values: list[str], seed: Column, at) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), _draw(seed, at, len(values)) + 1)


def _letters(canonical: Column, seed: Column, until: Column) -> Column:
    """Letters and digits up to the place `until` drawn anew, each of its own sort; the rest stays."""

    def one(i: Column) -> Column:
        c = F.substring(canonical, i, F.lit(1))
        of = lambda name: F.substring(F.lit(LETTERS[name]), _draw(seed, i, len(LETTERS[name])) + 1, F.lit(1))
        return (
            F.when(i > until, c)
            .when(c.rlike("[0-9]"), _draw(seed, i, 10).cast("string"))
            .when(c.rlike("[a-z]"), of("latin"))
            .when(c.rlike(r"\p{IsCyrillic}"), of("cyrillic"))
            .when(c.rlike(r"\p{IsGreek}"), of("greek"))
            .when(c.rlike(r"\p{IsLatin}"), of("accented"))
            .when(c.rlike(r"[\p{L}\p{N}]"), of("latin"))
            .otherwise(c)
        )

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(canonical)), one), "")


def _digits(canonical: Column, seed: Column, kept: Column) -> Column:
    """Digits after the first `kept` characters drawn anew."""
    one = lambda i: F.when((i <= kept) | ~F.substring(canonical, i, F.lit(1)).rlike(r"\d"), F.substring(canonical, i, F.lit(1))).otherwise(_draw(seed, i, 10).cast("string"))
    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(canonical)), one), "")


def _luhn(digits: Column) -> Column:
    """The Luhn sum modulo 10 of a text of digits."""
    n = F.length(digits)
    value = lambda i: F.substring(digits, i, F.lit(1)).cast("int")
    twice = lambda i: F.when((n - i) % 2 == 1, F.when(value(i) > 4, value(i) * 2 - 9).otherwise(value(i) * 2)).otherwise(value(i))
    return F.aggregate(F.transform(F.sequence(F.lit(1), n), twice), F.lit(0), lambda a, x: a + x) % 10


def _card(canonical: Column, seed: Column) -> Column:
    new = _digits(canonical, seed, F.lit(1))
    old_sum, new_sum = _luhn(F.regexp_replace(canonical, r"\D", "")), _luhn(F.regexp_replace(new, r"\D", ""))
    last = F.substring(new, -1, 1).cast("int")
    fixed = F.concat(F.substring(new, F.lit(1), F.length(new) - 1), F.pmod(last - new_sum, F.lit(10)).cast("string"))
    return F.when(old_sum == 0, fixed).otherwise(new)


def _given(canonical: Column, sex: str, seed: Column, attempt: int) -> Column:
    """A given name of the sex: one of the list, from the next attempt on one of syllables with the sex's ending."""
    end = {"latin": {"f": "a", "m": "o", "n": ""}, "cyrillic": {"f": "а", "m": "ий", "n": ""}}
    of = lambda s: _pick(GIVEN[s, sex], seed, 0) if not attempt else F.initcap(F.concat(*[_pick(SYLLABLES[s], seed, k) for k in range(1 + attempt)], F.lit(end[s][sex])))
    return F.when(canonical.rlike(r"\p{IsCyrillic}"), of("cyrillic")).otherwise(of("latin"))


def _family(canonical: Column, seed: Column, syllables: int) -> Column:
    of = lambda s: F.initcap(F.concat(*[_pick(SYLLABLES[s], seed, k) for k in range(1, 1 + syllables)]))
    return F.when(canonical.rlike(r"\p{IsCyrillic}"), of("cyrillic")).otherwise(of("latin"))


def _iban(canonical: Column, seed: Column) -> Column:
    """The country stays, digits stay digits and letters capital letters, and the check digits fit (ISO 13616)."""
    letters = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    digit = lambda c: c.rlike("[0-9]")

    def one(i: Column) -> Column:
        c = F.substring(canonical, i, F.lit(1))
        return F.when(digit(c), _draw(seed, i, 10).cast("string")).otherwise(F.substring(letters, _draw(seed, i, 26) + 1, F.lit(1)))

    body = F.array_join(F.transform(F.sequence(F.lit(5), F.length(canonical)), one), "")
    country = F.substring(canonical, 1, 2)
    value = lambda c: F.when(digit(c), F.array(c.cast("int"))).otherwise(F.array(F.floor((F.ascii(c) - 55) / 10).cast("int"), F.pmod(F.ascii(c) - 55, F.lit(10)).cast("int")))
    line = F.concat(body, country, F.lit("00"))
    digits = F.flatten(F.transform(F.sequence(F.lit(1), F.length(line)), lambda i: value(F.substring(line, i, F.lit(1)))))
    check = 98 - F.aggregate(digits, F.lit(0), lambda a, d: (a * 10 + d) % 97)
    return F.concat(country, F.lpad(check.cast("string"), 2, "0"), body)


def _token(canonical: Column, seed: Column) -> Column:
    """A key's prefix stays; digits, small and capital letters after it are drawn anew."""
    kept = F.length(F.regexp_extract(canonical, r"^(?:\w\w_(?:live|test)_|gh._|xox.-|A.IA)", 0))

    def one(c: Column, at: Column) -> Column:
        i = at + 1
        letter = lambda alphabet: F.substring(F.lit(alphabet), _draw(seed, i, 26) + 1, F.lit(1))
        new = F.when(c.rlike("[0-9]"), _draw(seed, i, 10).cast("string")).when(c.rlike("[a-z]"), letter(LETTERS["latin"])).when(c.rlike("[A-Z]"), letter(LETTERS["latin"].upper())).otherwise(c)
        return F.when(i <= kept, c).otherwise(new)

    return F.array_join(F.transform(F.split(canonical, ""), one), "")


def _surrogate(kind: Column, canonical: Column, attempt: int, key: str, syllables: int) -> Column:
    """syllables: of family names at the first attempt."""
    seed = F.sha2(F.concat_ws("|", F.lit(key), kind, canonical, F.lit(str(attempt))), 256)
    hexed = F.array_join(F.transform(F.sequence(F.lit(1), F.length(canonical)), lambda i: F.when(F.substring(canonical, i, F.lit(1)) == ":", ":").otherwise(F.substring(F.lit("0123456789abcdef"), _draw(seed, i, 16) + 1, F.lit(1)))), "")
    # digests one after another, as many as the secret is long
    stream = F.array_join(F.transform(F.sequence(F.lit(0), F.floor(F.length(canonical) / 64).cast("int")), lambda k: F.sha2(F.concat_ws("|", seed, k.cast("string")), 256)), "")
    ip = F.concat_ws(".", *[(_draw(seed, k, 254) + 1).cast("string") for k in range(4)])
    # everything up to the top-level domain, which stays
    top = F.length(canonical) - F.length(F.substring_index(canonical, ".", -1))
    letters = _letters(canonical, seed, top)
    out = (
        F.when(kind == "email", letters if attempt < WIDEN else F.concat(F.lit(f"{attempt}."), letters))
        .when(kind == "secret", F.substring(stream, F.lit(1), F.length(canonical)))
        .when(kind == "ipv6", hexed)
        .when(kind == "ip", ip)
        .when(kind == "card", _card(canonical, seed))
        .when(kind == "phone", _digits(canonical, seed, F.length(F.regexp_extract(canonical, f"^{_CALLING}|^0|^1(?=[0-9]{{10}}$)", 0))))
        .when(kind == "ssn", _digits(canonical, seed, F.lit(0)))
        .when(kind == "iban", _iban(canonical, seed))
        .when(kind == "key", _token(canonical, seed))
    )
    for sex in "fmn":
        out = out.when(kind == f"given {sex}", _given(canonical, sex, seed, attempt))
    out = out.otherwise(_family(canonical, seed, syllables + attempt))
    return out if attempt < WIDEN else F.when(kind == "email", out).otherwise(F.concat(out, F.lit(f"-{attempt}")))


def _initial(canonical: Column, key: str) -> Column:
    """Another initial of the script. Initials aren't kept apart, as there are few: family names tell persons apart."""
    seed = F.sha2(F.concat_ws("|", F.lit(key), F.lit("initial"), canonical), 256)
    of = lambda name: F.upper(F.substring(F.lit(LETTERS[name]), _draw(seed, 0, len(LETTERS[name])) + 1, F.lit(1)))
    return F.concat(F.when(canonical.rlike(r"\p{IsCyrillic}"), of("cyrillic")).otherwise(of("latin")), F.lit("."))


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """Distinct (kind, canonical) to (kind, canonical, surrogate): a surrogate belongs to one entity and is none of the table.

    Family names begin with as many syllables as give twenty times as many names as there are, so few are drawn twice.
    """
    spark = entities.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    many = entities.where("kind = 'family'").count()
    syllables = next(k for k in range(3, 20) if min(len(x) for x in SYLLABLES.values()) ** k > 20 * many)
    attempt = 0
    taken = None
    left = entities
    while True:
        # a fixed number of tasks: rows are small, but each takes many digests
        dealt = left.repartition(tasks, "kind", "canonical")
        drawn = dealt.withColumn("surrogate", _surrogate(F.col("kind"), F.col("canonical"), attempt, key, syllables))
        first = drawn.groupBy("kind", "surrogate").agg(F.min("canonical").alias("canonical"))
        real = entities.select("kind", F.col("canonical").alias("surrogate"))
        good = first.join(real, ["kind", "surrogate"], "left_anti")
        if taken is not None:
            good = good.join(taken.select("kind", "surrogate"), ["kind", "surrogate"], "left_anti")
        good = written(good.select("kind", "canonical", "surrogate"), "surrogates")
        taken = good if taken is None else taken.unionByName(good)
        left = written(left.join(good, ["kind", "canonical"], "left_anti").select("kind", "canonical"), "again")
        if not left.limit(1).count():
            return taken
        attempt += 1


def _spaced(surface: Column, surrogate: Column) -> Column:
    """The surrogate's digits and letters in the places of the surface's; a suffix stays at the end."""
    signs = F.regexp_extract(surrogate, r"^\+?([\p{L}\d]+)", 1)

    def one(i: Column) -> Column:
        c = F.substring(surface, i, F.lit(1))
        place = F.length(F.regexp_replace(F.substring(surface, F.lit(1), i), r"[^\p{L}\d]", ""))
        return F.when(c.rlike(r"[\p{L}\d]"), F.substring(signs, place, F.lit(1))).otherwise(c)

    woven = F.array_join(F.transform(F.sequence(F.lit(1), F.length(surface)), one), "")
    return F.concat(woven, F.regexp_extract(surrogate, r"-\d+$", 0))


def _as_surface(surface: Column, kind: Column, surrogate: Column) -> Column:
    """The surrogate with the surface's case or separators."""
    shouted = (surface == F.upper(surface)) & (surface != F.lower(surface))
    capital = F.substring(surface, 1, 1) != F.lower(F.substring(surface, 1, 1))
    cased = F.when(shouted, F.upper(surrogate)).when(capital, F.concat(F.upper(F.substring(surrogate, 1, 1)), F.substring(surrogate, F.lit(2), F.length(surrogate)))).otherwise(surrogate)
    named = F.when(shouted & (F.length(surface) > 2), F.upper(surrogate)).otherwise(surrogate)
    return F.when((kind == "family") | kind.startswith("given"), named).when(kind.isin("email", "secret", "ipv6"), cased).when(kind.isin(*SPACED), _spaced(surface, surrogate)).otherwise(surrogate)


def replace(docs: DataFrame, text_col: str = "text", key: str | None = None, kinds: str | None = None) -> DataFrame:
    """The rows of docs with the entities of their texts replaced, and with `kinds`, under that name the kinds of what was replaced, in order.

    Null texts stay null and empty ones empty, with no kinds. Copies and repeated rows are replaced alike. Whole texts are
    searched. docs may have any other columns; an empty table gives no rows.
    """
    key = key or key_of(docs.sparkSession)
    may, sha, new_, kinds_ = (free(docs, c) for c in ("may", "sha", "new", "kinds"))
    rows = docs.withColumn(may, _maybe(F.col(text_col)))
    maybe = rows.where(may).drop(may).withColumn(sha, F.sha2(F.col(text_col), 256))
    found = maybe.select(F.col(sha).alias("sha"), F.regexp_extract_all(F.col(text_col), F.lit(ENTITY), F.lit(0)).alias("found")).where(F.size("found") > 0)
    found = written(found.groupBy("sha").agg(F.first("found").alias("found")), "found")
    found = found.select("sha", F.posexplode("found").alias("pos", "whole")).withColumn("kind", _kind(F.col("whole")))
    plain = found.where(F.col("kind") == PLAIN).select("sha", "pos", F.col("kind").alias("of"), F.col("whole").alias("new"))
    places = found.where(F.col("kind") != PLAIN).select("sha", "pos", F.when(F.col("kind") == "person", _title(F.col("whole"))).otherwise("").alias("title"), F.col("kind").alias("of"), F.posexplode(_parts(F.col("whole"), F.col("kind"))).alias("word", "x"))
    places = written(places.select("sha", "pos", "title", "of", "word", "x.*"), "places")
    entities = written(places.groupBy("kind", "canonical").agg(F.count(F.lit(1)).alias("n")).drop("n"), "entities")
    initials = F.col("kind") == "initial"
    known = surrogates(entities.where(~initials), key).unionByName(entities.where(initials).withColumn("surrogate", _initial(F.col("canonical"), key)))
    new = places.join(known, ["kind", "canonical"])
    text = F.concat(F.when(F.col("word") == 0, F.col("title")).otherwise(F.col("before")), _as_surface(F.col("surface"), F.col("kind"), F.col("surrogate")))
    new = new.select("sha", "pos", "of", F.struct("word", text.alias("text")).alias("x")).repartition("sha")
    new = new.groupBy("sha", "pos", "of").agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["text"]), "").alias("new")).unionByName(plain)
    new = written(new.groupBy(F.col("sha").alias(sha)).agg(F.array_sort(F.collect_list(F.struct("pos", F.col("of").alias("kind"), "new"))).alias(new_)), "replacements")
    held = maybe.join(new, sha, "left").drop(sha)
    # a part more than entities; both lists are made once for each text
    woven = F.array_join(F.zip_with(F.split(F.col(text_col), ENTITY, -1), F.col(new_), lambda p, x: F.concat(p, F.coalesce(x["new"], F.lit("")))), "")
    held = held.withColumn(text_col, F.when(F.col(new_).isNotNull(), woven).otherwise(F.col(text_col)))
    none = F.array().cast("array<string>")
    held = held.withColumn(kinds_, F.coalesce(F.transform(F.filter(new_, lambda x: x["kind"] != PLAIN), lambda x: x["kind"]), none)).drop(new_)
    out = held.unionByName(rows.where(~F.col(may)).drop(may).withColumn(kinds_, none))
    return out.withColumnRenamed(kinds_, kinds) if kinds else out.drop(kinds_)
