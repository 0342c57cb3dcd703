"""Personal data replaced by keyed, type-consistent surrogates, in built-in functions only.

One pattern finds the entities; the text between them is left byte for byte, but for names that a title
gave away elsewhere in the document. Each distinct entity of the corpus (type and canonical form) gets one
surrogate, derived from a secret key, so mentions that corefer still do. Candidates that collide with each
other or with an entity of the corpus, of whatever type, are drawn again until every entity has a surrogate
of its own. The surrogate then takes the form of each mention: separators, capitals and script stay, names
keep their gender, cards and IBANs valid check digits, IBANs their country.

Within a document a family name after a title is the first person there of that family whose gender does not
contradict it, and gets the family part of that person's surrogate.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtally.session import saved

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
#: Titles of either gender; they may follow one that tells it.
NEUTRAL = ("Dr", "Doctor", "Prof", "Professor")
_PART = r"(?:\p{Lu}')?\p{Lu}[\p{L}\p{M}]+"
_NAME = rf"(?!(?:{'|'.join(NEUTRAL)})\b){_PART}(?:[- ]{_PART}){{0,2}}"
MALE = ("Mr", "Herr", "Herrn", "Señor", "Monsieur", "господин", "κύριος")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Señora", "Señorita", "Madame", "Mademoiselle", "госпожа", "κυρία")

#: All patterns start at the beginning of a word; looking there first keeps the scan short.
_START = r"(?<![\p{L}\p{N}_])(?=[\p{L}\p{N}+(])"
_SPELL = r"[\p{L}\p{N}._%+\-]"
#: Types in the order in which they are tried at a place.
PATTERNS = {
    "secret": r"(?=[A-Za-z0-9_/+\-]{16})(?<=(?i:token|secret|password|passwd|api.?key) {0,2}[=:] {0,2}[\"']?)[A-Za-z0-9_/+\-]++",
    "email": rf"(?<!{_SPELL}){_SPELL}++@[\p{{L}}\p{{N}}\-]+(?:\.[\p{{L}}\p{{N}}\-]+)*\.\p{{L}}{{2,}}",
    "iban": r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w)",
    "card": r"(?<!\.)\d(?:[ \-]?\d){12,18}(?!\w)",
    "ssn": r"(?<!-)\d{3}-\d{2}-\d{4}(?![\w\-])",
    "ip": rf"(?<!\.)(?:{_OCTET}\.){{3}}{_OCTET}(?!\w|\.\d)",
    "phone": r"(?<!\+)(?:\+\d{1,3}[ .\-]?|1[ .\-])?(?:\(\d{2,4}\) ?|\d{2,4}[ .\-])\d{3,4}[ .\-]\d{3,4}(?!\w)"
    r"|\+\d{1,3}(?:[ .\-]?\d{2,4}){3,4}(?!\w)",
    "male": rf"(?=\p{{Lu}})(?<=(?<!\p{{L}})(?:{'|'.join(MALE)})\.? ){_NAME}",
    "female": rf"(?=\p{{Lu}})(?<=(?<!\p{{L}})(?:{'|'.join(FEMALE)})\.? ){_NAME}",
    "person": rf"(?=\p{{Lu}})(?<=(?<!\p{{L}})(?:{'|'.join(NEUTRAL)})\.? ){_NAME}",
}
NAMES = ("male", "female", "person")
ANY = f"{_START}(?:{'|'.join(f'(?:{p})' for p in PATTERNS.values())})"

# Names by script and gender: given names, then family names. Invented pools, freely extended.
GIVEN = {
    ("latin", "male"): ("Adam", "Bruno", "Carl", "Daniel", "Emil", "Felix", "Georg", "Hugo", "Ivan", "Jonas", "Karl", "Leo", "Marco", "Nils", "Oscar", "Paul"),
    ("latin", "female"): ("Alma", "Berta", "Clara", "Dora", "Elsa", "Flora", "Greta", "Helena", "Irene", "Julia", "Karla", "Laura", "Marta", "Nora", "Olga", "Paula"),
    ("cyrillic", "male"): ("Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Захар", "Иван", "Кирилл", "Лев", "Максим", "Олег"),
    ("cyrillic", "female"): ("Анна", "Вера", "Галина", "Дарья", "Елена", "Жанна", "Зоя", "Ирина", "Ксения", "Лидия", "Мария", "Ольга"),
    ("greek", "male"): ("Αλέξης", "Βασίλης", "Γιώργος", "Δημήτρης", "Ηλίας", "Κώστας", "Λουκάς", "Νίκος"),
    ("greek", "female"): ("Άννα", "Βασιλική", "Γεωργία", "Δήμητρα", "Ελένη", "Κατερίνα", "Μαρία", "Σοφία"),
}
FAMILY = {
    "latin": ("Abel", "Bauer", "Conti", "Duval", "Engel", "Ferro", "Garnier", "Holm", "Iglesias", "Jansen", "Keller", "Lopez", "Marin", "Novak", "Ortega", "Petit"),
    "cyrillic": ("Белко", "Гончар", "Дорош", "Живко", "Зозуля", "Клименко", "Лысенко", "Мороз", "Назаренко", "Остапенко", "Панченко", "Савченко"),
    "greek": ("Αγγελή", "Βλάχου", "Γαλάνη", "Δούκα", "Ζώη", "Κοντού", "Λάμπρου", "Μελά"),
}

_ALPHABETS = {"latin": ("a", 26), "cyrillic": ("а", 32), "greek": ("α", 17)}
#: First and second letters of the syllables that make up further family names.
_SYLLABLES = {"latin": ("bdfghklmnprstvz", "aeiou"), "cyrillic": ("бвгджзклмнпрстх", "аеиоу"), "greek": ("βγδζθκλμνπρστφχ", "αειοω")}


def _script(text: Column) -> Column:
    return F.when(text.rlike(r"\p{IsCyrillic}"), "cyrillic").when(text.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def _draw(seed: Column, place: Column | str, below: Column | int) -> Column:
    """A number under ``below`` for a place, from the keyed hash."""
    digest = F.sha2(F.concat(seed, F.lit("/"), place.cast("string") if isinstance(place, Column) else F.lit(place)), 256)
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("long") % below


def _characters(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def _respelled(text: Column, seed: Column, hexadecimal: Column) -> Column:
    """Digits for digits and letters for letters, of the same script where it has an alphabet here.

    Other scripts get Latin letters. ASCII signs stay, unless the text has nothing else.
    """
    signs_only = ~text.rlike(r"[\p{L}\p{N}]")

    def spell(c: Column, i: Column) -> Column:
        out = F.when(c.rlike(r"\p{N}"), _draw(seed, i, 10).cast("string"))
        out = out.when(hexadecimal, F.when(c.rlike("[a-f]"), F.char(97 + _draw(seed, i, 6))).otherwise(c))
        for script, (first, size) in _ALPHABETS.items():
            letters = F.array(*[F.lit(chr(ord(first) + k)) for k in range(size)])
            of = r"\p{IsLatin}" if script == "latin" else rf"\p{{Is{script.capitalize()}}}"
            letter = F.get(letters, _draw(seed, i, size).cast("int"))
            out = out.when(c.rlike(of), F.when(c == F.lower(c), letter).otherwise(F.upper(letter)))
        return out.when(signs_only | ~c.rlike(r"^\p{ASCII}"), F.char(97 + _draw(seed, i, 26))).otherwise(c)

    return F.array_join(F.transform(_characters(text), spell), "")


def _pick(pool: tuple[str, ...], seed: Column, place: str) -> Column:
    return F.get(F.array(*map(F.lit, pool)), _draw(seed, place, len(pool)).cast("int"))


def _name(kind: Column, canonical: Column, seed: Column, attempt: Column) -> Column:
    """A name of the same script and gender, given name and family or family alone; later attempts spell longer families."""
    whole = canonical.contains(" ")
    out = F.lit(None).cast("string")
    for script in FAMILY:
        male, female = (_pick(GIVEN[script, gender], seed, "given") for gender in ("male", "female"))
        either = F.when(_draw(seed, "gender", 2) == 0, male).otherwise(female)
        given = F.when(kind == "male", male).when(kind == "female", female).otherwise(either)
        first, second = _SYLLABLES[script]
        syllables = [_pick(tuple(a + b for a in first for b in second), seed, f"s{k}") for k in range(8)]
        family = (
            F.when(attempt >= 6, F.initcap(F.concat(*syllables)))
            .when(attempt >= 4, F.initcap(F.concat(*syllables[:4])))
            .when(attempt >= 2, F.initcap(F.concat(*syllables[:3])))
            .otherwise(_pick(FAMILY[script], seed, "family"))
        )
        out = F.when(_script(canonical) == script, F.when(whole, F.concat_ws(" ", given, family)).otherwise(family)).otherwise(out)
    return out


def _iban(canonical: Column) -> Column:
    """The respelled account under its country, with check digits modulo 97."""
    country, account = F.substring(canonical, 1, 2), F.expr("substring(spelled, 5, length(spelled))")
    value = F.aggregate(
        _characters(F.concat(account, country, F.lit("00"))),
        F.lit(0),
        lambda sum_, c: F.when(c.rlike("[0-9]"), sum_ * 10 + F.ascii(c) - 48).otherwise(sum_ * 100 + F.ascii(c) - 55) % 97,
    )
    return F.concat(country, F.lpad((98 - value).cast("string"), 2, "0"), account)


def _ssn(seed: Column) -> Column:
    """Nine digits in ranges that are given out: no area 000, 666 or 900 and above, no group 00, no serial 0000."""
    area = _draw(seed, "area", 898) + 1
    area = F.when(area >= 666, area + 1).otherwise(area)
    parts = [(area, 3), (_draw(seed, "group", 99) + 1, 2), (_draw(seed, "serial", 9999) + 1, 4)]
    return F.concat(*[F.lpad(n.cast("string"), width, "0") for n, width in parts])


def _phone(canonical: Column, seed: Column) -> Column:
    """Ten digits are area, exchange and line, the first two from 2 up; other numbers keep a leading zero or none."""
    spelled = F.col("spelled")
    area, exchange = ((_draw(seed, place, 8) + 2).cast("string") for place in ("area", "exchange"))
    ten = F.concat(area, F.substring(spelled, 2, 2), exchange, F.substring(spelled, 5, 6))
    lead = F.when(canonical.startswith("0"), "0").otherwise((_draw(seed, "lead", 9) + 1).cast("string"))
    return F.when(F.length(canonical) == 10, ten).otherwise(F.concat(lead, F.expr("substring(spelled, 2, length(spelled))")))


def _surrogate(key: str, kind: Column, canonical: Column, attempt: Column) -> tuple[Column, Column]:
    """The respelled canonical form, and the candidate built from it as column ``spelled``."""
    seed = F.sha2(F.concat_ws("|", F.lit(key), kind, canonical, attempt.cast("string")), 256)
    spelled = _respelled(canonical, seed, (kind == "secret") & ~canonical.rlike("[^0-9a-f]"))
    body = F.concat(F.substring(canonical, 1, 1), F.expr("substring(spelled, 2, length(spelled) - 2)"))
    check = F.get(F.filter(F.array(*[F.lit(str(d)) for d in range(10)]), lambda d: F.call_function("luhn_check", F.concat(body, d))), 0)
    local = F.regexp_replace("spelled", r"\.[^.]*$", "")
    # A text of few letters has few spellings; later attempts are told apart by what is added.
    added = F.when(attempt >= 4, F.substring(F.sha2(F.concat(seed, F.lit("/added")), 256), 1, 12)).otherwise("")
    octets = F.concat_ws(".", *[_draw(seed, f"octet{k}", 254) + 1 for k in range(4)])
    chosen = (
        F.when(kind == "card", F.concat(body, check))
        .when(kind == "email", F.concat(local, added, F.lit(".example")))
        .when(kind == "ip", octets)
        .when(kind == "iban", _iban(canonical))
        .when(kind == "ssn", _ssn(seed))
        .when(kind == "phone", _phone(canonical, seed))
        .when(kind.isin(*NAMES), _name(kind, canonical, seed, attempt))
        .when(kind == "secret", F.concat("spelled", added))
        .otherwise(F.col("spelled"))
    )
    return spelled, chosen


def _with_candidates(entities: DataFrame, key: str) -> DataFrame:
    spelled, chosen = _surrogate(key, F.col("kind"), F.col("canonical"), F.col("attempt"))
    return entities.withColumn("spelled", spelled).withColumn("surrogate", chosen).drop("spelled")


def _told(kind: str, value: str) -> Column:
    """What tells an entity from others in a text: a name's family, since a title may stand before it alone."""
    return F.when(F.col(kind).isin(*NAMES), F.regexp_extract(value, r"[^ ]+$", 0)).otherwise(F.col(value))


def assign(entities: DataFrame, key: str) -> DataFrame:
    """(kind, canonical, surrogate) for distinct (kind, canonical): no two alike, none equal to an entity of any kind.

    Names count as alike if their families are. Colliding candidates are drawn again with the next attempt,
    all but one of each. Settled rows never change, so the rounds end when the last collision is gone.
    """
    known = saved(entities.select(_told("kind", "canonical").alias("told")).unionByName(entities.select(F.col("canonical").alias("told"))).distinct(), "known")
    waiting = entities.withColumn("attempt", F.lit(0))
    settled: list[DataFrame] = []
    while True:
        drawn = saved(_with_candidates(waiting, key).withColumn("told", _told("kind", "surrogate")), "candidates")
        free = drawn
        for taken in [known, *[s.select("told") for s in settled]]:
            free = free.join(taken, "told", "left_anti")
        won = free.groupBy("told").agg(F.min(F.struct("kind", "canonical", "surrogate")).alias("won"))
        settled.append(saved(won.select("told", "won.*"), "settled"))
        waiting = drawn.join(settled[-1], ["kind", "canonical"], "left_anti").select("kind", "canonical", (F.col("attempt") + 1).alias("attempt"))
        waiting = saved(waiting, "waiting")
        if waiting.isEmpty():
            return reduce(DataFrame.unionByName, settled).drop("told")


def _after(titles: tuple[str, ...]) -> str:
    """Matches where a text ends with one of the titles, a neutral one between or not."""
    return rf"(?<!\p{{L}})(?:{'|'.join(titles)})\.? (?:(?:{'|'.join(NEUTRAL)})\.? )?$"


def _kind(entity: Column, before: Column) -> Column:
    """The type of a mention; null for a number that is no card. What stands before it tells a name and its gender."""
    digits = F.regexp_replace(entity, r"\D", "")
    out = F.when(entity.rlike(f"^(?:{PATTERNS['email']})$"), "email")
    out = out.when(entity.rlike(f"^(?:{PATTERNS['iban']})$"), "iban")
    out = out.when(entity.rlike(f"^(?:{PATTERNS['card']})$"), F.when(F.call_function("luhn_check", digits), "card"))
    for name in ("ssn", "ip", "phone"):
        out = out.when(entity.rlike(f"^(?:{PATTERNS[name]})$"), name)
    named = entity.rlike(f"^(?:{_NAME})$")
    for name, titles in (("female", FEMALE), ("male", MALE), ("person", NEUTRAL)):
        out = out.when(named & before.rlike(_after(titles)), name)
    return out.otherwise("secret")


def _canonical(kind: Column, surface: Column) -> Column:
    digits = F.regexp_replace(surface, r"\D", "")
    return (
        F.when(kind.isin("card", "ssn"), digits)
        .when(kind == "phone", F.regexp_replace(digits, r"^1(?=\d{10}$)", ""))  # with or without its country code
        .when(kind == "email", F.lower(surface))
        .when(kind == "iban", F.regexp_replace(surface, " ", ""))
        .when(kind.isin(*NAMES), F.initcap(surface))
        .otherwise(surface)
    )


def _poured(kind: Column, surface: Column, surrogate: Column) -> Column:
    """The surrogate in the form of a mention: its separators and its capitals."""
    whole = _characters(surface)
    known = F.length(F.regexp_replace(surface, r"\D", "")) - F.length(surrogate)
    surrogate = F.when((kind == "phone") & (known > 0), F.concat(F.left(F.regexp_replace(surface, r"\D", ""), known), surrogate)).otherwise(surrogate)
    letters = F.when(kind == "iban", r"[^0-9A-Z]").otherwise(r"[^0-9]")
    filled = F.array_join(
        F.transform(
            whole,
            lambda c, i: F.when(c.rlike(r"[0-9A-Z]"), F.substring(surrogate, F.length(F.regexp_replace(F.array_join(F.slice(whole, 1, i + 1), ""), letters, "")), F.lit(1))).otherwise(c),
        ),
        "",
    )
    shouted = (surface == F.upper(surface)) & (surface != F.lower(surface))
    return (
        F.when(kind.isin("card", "phone", "ssn", "iban"), filled)
        .when(kind.isin("email", *NAMES) & shouted, F.upper(surrogate))
        .otherwise(surrogate)
    )


def _has(text: Column) -> Column:
    return F.coalesce(text.rlike(ANY), F.lit(False))


def _name_key(text: str, doc_id: str) -> Column:
    """Names a row by content; equal rows are replaced alike."""
    return F.struct(F.xxhash64(F.col(f"`{doc_id}`"), F.col(f"`{text}`")).alias("a"), F.xxhash64(F.col(f"`{text}`"), F.lit(1)).alias("b"))


def found_in(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, d, surfaces, between) of every row with a match: what matched and the texts around, written to the shared folder."""
    body = F.col(f"`{text}`")
    return saved(
        docs.filter(_has(body)).select(
            F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), _name_key(text, doc_id).alias("d"),
            F.regexp_extract_all(body, F.lit(ANY), F.lit(0)).alias("surfaces"), F.split(body, ANY, -1).alias("between"),
        ),
        "found",
    )


def _coreferent(names: DataFrame) -> DataFrame:
    """Names with the person of their document that they mean: kind, canonical, and whether they are its family alone."""
    names = names.withColumn("family", F.element_at(F.split("canonical", " "), -1))
    gender = F.when(F.col("kind") != "person", F.col("kind"))
    of_name = names.groupBy("d", "canonical").agg(F.min(gender).alias("own"))
    of_family = names.groupBy("d", "family").agg(F.when(F.min(gender) == F.max(gender), F.min(gender)).alias("shared"))
    names = names.join(of_name, ["d", "canonical"]).join(of_family, ["d", "family"])
    names = names.withColumn("kind", F.when(F.col("kind") == "person", F.coalesce("own", "shared", "kind")).otherwise(F.col("kind")))

    whole = F.col("canonical").contains(" ")
    person = F.struct("place", "kind", "canonical")
    first = names.filter(whole).groupBy("d", "family").agg(*[F.min(F.when(F.col("kind") == k, person)).alias(k) for k in NAMES])
    meant = (
        F.when(whole, F.lit(None))
        .when(F.col("kind") == "male", F.coalesce("male", "person"))
        .when(F.col("kind") == "female", F.coalesce("female", "person"))
        .otherwise(F.coalesce("person", F.least("male", "female")))
    )
    return names.join(first, ["d", "family"], "left").withColumn("meant", meant).select(
        "d", "place", "surface", F.coalesce("meant.kind", "kind").alias("kind"),
        F.coalesce("meant.canonical", "canonical").alias("canonical"), F.col("meant").isNotNull().alias("family_alone"),
    )


def mentions(found: DataFrame) -> DataFrame:
    """(d, place, surface, kind, canonical, family_alone): every match, kind null where it is left alone."""
    each = found.select("d", F.posexplode(F.arrays_zip("surfaces", "between")).alias("place", "m"))
    # Only the end of what stands before tells a name; a title that is cut off tells none.
    each = each.filter("m.surfaces is not null").select("d", "place", F.col("m.surfaces").alias("surface"), F.expr("right(m.between, 40)").alias("before"))
    each = each.withColumn("kind", _kind(F.col("surface"), F.col("before")))
    each = each.withColumn("canonical", _canonical(F.col("kind"), F.col("surface"))).drop("before").dropDuplicates(["d", "place"])
    each = saved(each, "mentions")
    named = F.coalesce(F.col("kind").isin(*NAMES), F.lit(False))
    return each.filter(~named).withColumn("family_alone", F.lit(False)).unionByName(_coreferent(each.filter(named)))


def _without_title(piece: Column, names: Column) -> tuple[Column, Column]:
    """A text between matches with the document's whole names replaced, and the kinds of those, in order."""
    any_of = F.concat(F.lit(r"(?<![\p{L}\p{N}_])(?:"), F.array_join(F.transform(names, lambda n: n["surface"]), "|"), F.lit(r")(?![\p{L}\p{N}_])"))
    hits = F.transform(F.regexp_extract_all(piece, any_of, F.lit(0)), lambda m: F.get(F.filter(names, lambda n: n["surface"] == m), 0))
    rest = F.split(piece, any_of, -1)
    whole = F.array_join(F.zip_with(rest, hits, lambda a, b: F.concat(a, F.coalesce(b["new"], F.lit("")))), "")
    return whole, F.transform(hits, lambda h: h["kind"])


def replace(docs: DataFrame, key: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, text, kinds): each row of ``docs`` as a struct, its text with surrogates, and the types replaced.

    Null and empty texts, and texts without entities, come through as they are; long ones are read whole. Rows
    that repeat a document are replaced alike, with or without an id. Of candidates that collide the entity that
    comes first by type and canonical form keeps its own. An empty table gives no rows. Columns of any name may
    be present; only the two named are read.

    Names are found after a title; a name of several parts that was found so is replaced in the rest of its
    document too. Names that no title ever precedes stay.
    """
    body = F.col(f"`{text}`")
    found = found_in(docs, doc_id, text)
    seen = saved(mentions(found), "coreferent")
    entities = seen.filter("kind is not null").select("kind", "canonical").distinct()
    chosen = assign(saved(entities, "entities"), key)
    own = F.when(F.col("family_alone"), F.regexp_extract("surrogate", "[^ ]+$", 0)).otherwise(F.col("surrogate"))
    replaced = seen.join(chosen, ["kind", "canonical"], "left").select(
        "d", "place", "kind", "surface", F.coalesce(_poured(F.col("kind"), F.col("surface"), own), F.col("surface")).alias("new")
    )
    # Lists per document, no longer than the document; of two names the longer is tried first.
    name = F.struct((-F.length("surface")).alias("n"), "surface", "new", "kind")
    per_document = replaced.groupBy("d").agg(
        F.array_sort(F.collect_list(F.struct("place", "new", "kind"))).alias("new"),
        F.array_sort(F.collect_set(F.when(F.col("kind").isin(*NAMES) & F.col("surface").contains(" "), name))).alias("names"),
    )
    bare = F.size("names") == 0
    around = F.transform("between", lambda p: F.struct(*[c.alias(n) for c, n in zip(_without_title(p, F.col("names")), ("text", "kinds"))]))
    plain = F.transform("between", lambda p: F.struct(p.alias("text"), F.array().cast("array<string>").alias("kinds")))
    touched = found.join(per_document, "d").withColumn("around", F.when(bare, plain).otherwise(around))
    whole = F.array_join(F.zip_with("around", F.col("new.new"), lambda a, b: F.concat(a["text"], F.coalesce(b, F.lit("")))), "")
    kinds = F.concat(F.filter("new.kind", lambda k: k.isNotNull()), F.flatten("around.kinds"))
    touched = touched.select("row", whole.alias("text"), kinds.alias("kinds"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return docs.filter(~_has(body)).select(row, body.alias("text"), F.array().cast("array<string>").alias("kinds")).unionByName(touched)


def summary(docs: DataFrame, key: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, the number of entities, their types, and the replaced text, a row per row of ``docs``."""
    out = replace(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")), key)
    return out.select("row.doc_id", F.size("kinds").cast("long").alias("n_entities"), F.array_join(F.array_sort(F.array_distinct("kinds")), ",").alias("kinds"), "text")
