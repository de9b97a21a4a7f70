"""Surrogates for private data (operator 3). DataFrame functions only.

Entities are found by patterns in one search of each text, and normalised (letter case, separators), so that all
mentions of one entity share one surrogate everywhere: coreference. Names are found after titles and after words that
announce them, and where a common given name stands before another capitalised word; names of two or three words found
anywhere are then looked up among the runs of capitalised words of all texts, so that mentions without a title are
found as well. A name of one word is found only where something announces it.

A surrogate comes from a keyed hash and keeps the entity's type, length and format: digits stay digits, letters stay
letters of the same case and script, punctuation and country codes stay, card numbers that pass the check digit still
do. Names are replaced word by word, each word by one of the same script, so that `Mr Smith` and `John Smith` still
share a surname; given names end by gender (told by title or name; the more frequent one, m if equal). The dictionary of
distinct entities is checked as it is rendered: two entities of a type never share a surrogate, and no surrogate is an
entity that occurs; those that collide are drawn again with the next attempt number, which also makes names longer.

Defined cases: null text stays null; texts without entities are returned unchanged; texts of any length are searched
whole; repeated rows and entities that tie in any respect get equal results; an empty table gives an empty result; other
columns are kept, but for `n_private`, which is added.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, small

# Types in order of precedence, and their patterns (Java regular expressions).
# Repeated groups are possessive: Java's greedy ones take stack for every repeat, and a text with a thousand of them would
# end the executor. So an address's last part (the last one that starts with two letters) is found by looking ahead.
_OTHERS = r"(?:\.(?![A-Za-z]{2})[A-Za-z0-9-]++)*+"
EMAIL = (
    r"(?<![A-Za-z0-9])[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]++"
    rf"(?:{_OTHERS}\.[A-Za-z]{{2}}[A-Za-z0-9-]*+(?={_OTHERS}\.[A-Za-z]{{2}}))*+{_OTHERS}\.[A-Za-z]{{2,}}"
)
IP = r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\d|\.\d)"
IPV6 = r"(?<![\w:])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![\w:])"
CARD = r"(?<![\d-])(?:\d{4}([ -]?)\d{4}\1\d{4}\1\d{4}|3\d{3}([ -]?)\d{6}\2\d{5}|\d{13,19})(?![\d-])"
IBAN = r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b"
SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
PHONE = r"(?<![\d+.-])(?:\+\d{1,3}[ .-]?|\d{1,3}[ .-])?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]\d{3,4}(?!\d)|(?<![\w+])\+\d{8,15}(?!\d)"
LABEL = r"(?:token|secret|password|passwd|api_key|apikey|api-key)\s{0,2}[:=]\s{0,2}[\"']?"
SECRET = rf"(?<![A-Za-z0-9+/_-])(?=[A-Za-z0-9+/_-]{{16}})(?<={LABEL})[A-Za-z0-9+/_-]+"
MALE = ("Mr", "Mister", "Sir", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "Don", "господин", "г-н")
FEMALE = ("Mrs", "Ms", "Miss", "Madam", "Lady", "Frau", "Madame", "Mme", "Mademoiselle", "Mlle", "Señora", "Sra", "Señorita", "Srta", "Doña", "госпожа", "г-жа")
NEUTRAL = ("Dr", "Prof", "Doctor", "Professor", "Professeur", "Docteur", "Doktor", "Doctora", "Dra")
ANNOUNCED = ("[Mm]y name is", "[Mm]ein Name ist", "[Ii]ch heiße", "[Jj]e m'appelle", "[Mm]e llamo", "[Mm]i nombre es")
GIVEN_MALE = (
    "James John Robert Michael William David Richard Joseph Thomas Charles Christopher Daniel Matthew Anthony Steven Paul Andrew Kevin Brian George Edward "
    "Peter Hans Klaus Wolfgang Jürgen Stefan Andreas Matthias Uwe Jean Pierre Michel Philippe Nicolas Laurent José Juan Carlos Luis Miguel Antonio Javier Pedro "
    "Иван Сергей Алексей Дмитрий Андрей Николай"
).split()
GIVEN_FEMALE = (
    "Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Nancy Margaret Lisa Betty Sandra Ashley Emily Donna Michelle Laura Anna Ursula "
    "Monika Petra Sabine Renate Katrin Heike Marie Nathalie Isabelle Sylvie Catherine Françoise Carmen Josefa Dolores Pilar Lucía Isabel "
    "Мария Елена Ольга Наталья Татьяна Ирина"
).split()
_CAP = r"\p{Lu}[\p{L}'-]+"
_TITLES = "|".join([*MALE, *FEMALE, *NEUTRAL])
#: What stands before an announced name; the longest is shorter than 20 characters.
BEFORE = r"\b(?:(?:" + _TITLES + r")\.?|" + "|".join(ANNOUNCED) + r") "
NAME = rf"(?=\p{{Lu}})(?<={BEFORE}){_CAP}(?: {_CAP}){{0,2}}"
#: Two capitalised words or more, none of them a title, the start of an address or a part of a longer token.
_PLAIN = rf"(?!(?:{_TITLES})\b|[\w.%+-]*@){_CAP}(?![\p{{L}}\p{{N}}'-])"
SEQUENCE = rf"(?<![\p{{L}}\p{{N}}'-]){_PLAIN}(?: {_PLAIN})++"
TYPES = {"email": EMAIL, "ip": IP, "ipv6": IPV6, "iban": IBAN, "card": CARD, "ssn": SSN, "phone": PHONE}
LATIN = "ba be bi bo da de di do fa fe ga ge la le li lo ma me mi mo na ne ni no ra re ri ro sa se so ta te ti to va ve vi vo za".split()
CYRILLIC = "ба бе би бо да де ди до га ле ли ло ма ме ми мо на не ни но ра ре ри ро са се со та те ти то ва ве ви во за".split()
#: Only the card's pattern has capturing groups, so its back references hold in the joined pattern too.
#: What starts with a letter starts a word, which spares most places the patterns; order is that of precedence.
ANY = "|".join(
    f"{where}(?:" + "|".join(f"(?:{p})" for p in patterns) + ")"
    for where, patterns in ((r"(?<![A-Za-z0-9])(?=\p{L})", (EMAIL, IPV6, IBAN, SECRET, NAME, SEQUENCE)), ("(?=[0-9+(])", (EMAIL, IP, IPV6, CARD, SSN, PHONE, SECRET)), ("(?=[/_-])", (SECRET,)))
)
#: Attempts from which a surrogate grows by a character each, as its format may be full.
GROW = 4
_ROUNDS = 60
_MARK = "\u0001"
#: Parts into which copies of one text are dealt where texts meet their surrogates.
SALT = 8


def _hint(text: F.Column) -> F.Column:
    """False for texts that can't have an entity or a run of capitalised words, which spares them the search."""
    found = text.rlike("[0-9@:=]") | text.rlike(rf"\p{{Lu}}[\p{{L}}'-]+ \p{{Lu}}")
    short = [f"{t}. " for t in (*MALE, *FEMALE, *NEUTRAL) if t[0].isupper() and len(t) <= 4]
    for words in (*short, *[t for t in (*MALE, *FEMALE) if t[0].islower()], *[a.split("]", 1)[1] for a in ANNOUNCED]):
        found = found | text.contains(words)
    return F.coalesce(found, F.lit(False))


def pieces(text: F.Column) -> F.Column:
    """A text cut at its entities and runs of capitalised words: these are the pieces of odd index (from 0).

    One search marks them; texts that hold the mark themselves are searched twice instead.
    """
    marked = F.split(F.regexp_replace(text, ANY, f"{_MARK}$0{_MARK}"), _MARK, -1)
    ends = F.concat(F.regexp_extract_all(text, F.lit(ANY), F.lit(0)), F.array(F.lit("")))
    twice = F.slice(F.flatten(F.zip_with(F.split(text, ANY, -1), ends, lambda p, r: F.array(p, r))), 1, F.size(ends) * 2 - 1)
    return F.when(text.contains(_MARK), twice).otherwise(marked)


def kind(raw: F.Column, before: F.Column) -> F.Column:
    """Type of a piece by what stands before it or by the first pattern that fits all of it; else a sequence."""
    out = F.when(before.rlike(rf"{BEFORE}$") & raw.rlike(rf"^{_CAP}(?: {_CAP}){{0,2}}$"), "name").when(before.rlike(f"{LABEL}$") & ~raw.contains(" "), "secret").otherwise("sequence")
    for name, p in reversed(TYPES.items()):
        out = F.when(raw.rlike(f"^(?:{p})$"), name).otherwise(out)
    return out


def _norm(raw: F.Column, kind_: F.Column) -> F.Column:
    return (
        F.when(kind_.isin("card", "ssn", "phone"), F.regexp_replace(raw, r"\D", ""))
        .when(kind_.isin("email", "ipv6"), F.lower(raw))
        .when(kind_ == "iban", F.regexp_replace(raw, " ", ""))
        .otherwise(raw)
    )


def _pick(seed: F.Column, i: F.Column, n: int) -> F.Column:
    return F.pmod(F.xxhash64(seed, i), F.lit(n)).cast("int")


def _alike(norm: F.Column, seed: F.Column) -> F.Column:
    """Every digit and ASCII letter drawn anew, all else kept."""

    hexadecimal = norm.rlike("^(?=.*[a-f])[0-9a-f]{16,}$") | norm.contains(":")

    def one(c: F.Column, i: F.Column) -> F.Column:
        return (
            F.when(hexadecimal & c.rlike("[0-9a-f]"), F.lower(F.hex(_pick(seed, i, 16))))
            .when(c.rlike("[0-9]"), _pick(seed, i, 10).cast("string"))
            .when(c.rlike("[a-z]"), F.char(_pick(seed, i, 26) + 97))
            .when(c.rlike("[A-Z]"), F.char(_pick(seed, i, 26) + 65))
            .otherwise(c)
        )

    return F.array_join(F.transform(F.split(norm, ""), one), "")


def _luhn(digits: F.Column) -> F.Column:
    """Luhn sum of a string of digits, modulo 10."""
    d = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(i % 2 == 0, c.try_cast("int")).otherwise(F.element_at(F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), c.try_cast("int") + 1)))
    return F.aggregate(d, F.lit(0), lambda a, x: a + x) % 10


def _mod97(account: F.Column) -> F.Column:
    """An IBAN's number modulo 97, its first four characters moved to the end: 1 if its check digits are right."""

    def step(a: F.Column, c: F.Column) -> F.Column:
        return F.when(c.rlike("[0-9]"), (a * 10 + c.try_cast("int")) % 97).when(c.rlike("[A-Z]"), (a * 100 + F.ascii(c) - 55) % 97).otherwise(a)

    turned = F.concat(F.substr(account, F.lit(5)), F.substring(account, 1, 4))
    return F.aggregate(F.split(F.upper(turned), ""), F.lit(0), step)


def _grown(k: F.Column, surrogate: F.Column, attempt: F.Column, seed: F.Column) -> F.Column:
    """A surrogate of a format that is full: letters before an address's @, a group after an IPv6 address, else digits
    at the end. Names grow by syllables, and IPv4 addresses are too many to fill."""
    more = F.sequence(F.lit(GROW), F.greatest(attempt, F.lit(GROW)))
    letters = F.array_join(F.transform(more, lambda i: F.char(_pick(seed, i + 1000, 26) + 97)), "")
    digits = F.array_join(F.transform(more, lambda i: _pick(seed, i + 1000, 10).cast("string")), "")
    group = F.concat(F.lit(":"), F.lower(F.hex(_pick(seed, F.lit(2000), 61440) + 4096)))
    longer = F.when(k == "email", F.regexp_replace(surrogate, F.lit("@"), F.concat(letters, F.lit("@")))).when(k == "ipv6", F.concat(surrogate, group)).otherwise(F.concat(surrogate, digits))
    return F.when((attempt >= GROW) & ~k.isin("name", "ip"), longer).otherwise(surrogate)


def _word(norm: F.Column, gender: F.Column, seed: F.Column, attempt: F.Column) -> F.Column:
    """Syllables of the word's script, more of them with each attempt; given names end by gender."""

    def build(pool: list[str], male: str, female: str) -> F.Column:
        syllables = F.array(*[F.lit(s) for s in pool])
        drawn = F.transform(F.sequence(F.lit(0), F.lit(2) + F.least(attempt, F.lit(9))), lambda k: F.element_at(syllables, _pick(seed, k, len(pool)) + 1))
        return F.initcap(F.concat(F.array_join(drawn, ""), F.when(gender == "f", female).when(gender == "m", male).otherwise("")))

    return F.when(norm.rlike(r"\p{IsCyrillic}"), build(CYRILLIC, "н", "на")).otherwise(build(LATIN, "n", "na"))


def _surrogate(key: str) -> F.Column:
    """From the columns kind, norm, gender, lead and attempt."""
    k, norm = F.col("kind"), F.col("norm")
    seed = F.sha2(F.concat_ws("\x1f", F.lit(key), k, norm, F.col("attempt").cast("string")), 256)
    alike = _alike(norm, seed)
    octet = F.array_join(F.transform(F.split(norm, r"\."), lambda c, i: (_pick(seed, i, 254) + 1).cast("string")), ".")
    # card: the first digit (its network) stays; a valid check digit stays valid
    card = F.concat(F.substring(norm, 1, 1), F.expr("substring(alike, 2)"))
    body = F.expr("substring(card0, 1, length(card0) - 1)")
    check = ((F.lit(10) - _luhn(F.concat(body, F.lit("0")))) % 10).cast("string")
    return F.when(k == "ip", octet).when(k == "name", _word(norm, F.col("gender"), seed, F.col("attempt"))).when(k == "card", F.lit(None)).otherwise(alike), alike, card, body, check


def _draw(entities: DataFrame, key: str) -> DataFrame:
    """entities(kind, norm, gender, lead, attempt) with surrogate."""
    other, alike, card, body, check = _surrogate(key)
    x = entities.withColumn("alike", alike).withColumn("card0", card)
    fixed = F.when(_luhn(F.col("norm")) == 0, F.concat(body, check)).otherwise(F.col("card0"))
    x = x.withColumn("surrogate", F.when(F.col("kind") == "card", fixed).otherwise(other))
    seed = F.sha2(F.concat_ws("\x1f", F.lit(key), "kind", "norm", F.col("attempt").cast("string")), 256)
    domain = F.regexp_extract("norm", r"@(.*)$", 1)
    shown = F.regexp_extract("surrogate", r"^(.*)@", 1)
    # reserved example domains say nothing of a person and stay
    x = x.withColumn("surrogate", F.when((F.col("kind") == "email") & domain.rlike(r"(^|\.)example\.(com|net|org)$"), F.concat(shown, F.lit("@"), domain))
                     .when(F.col("kind") == "email", F.concat(F.regexp_extract("surrogate", r"^(.*)\.[^.]*$", 1), F.lit("."), F.regexp_extract("norm", r"([^.]*)$", 1)))
                     .when(F.col("kind") == "iban", F.concat(F.substring("norm", 1, 2), F.expr("substring(surrogate, 3)")))
                     .when(F.col("kind") == "phone", F.concat(F.expr("substring(norm, 1, lead)"), F.expr("substring(surrogate, lead + 1)"))).otherwise(F.col("surrogate")))
    x = x.withColumn("surrogate", _grown(F.col("kind"), F.col("surrogate"), F.col("attempt"), seed))
    # an account whose check digits are right gets right ones
    bare = F.concat(F.substring("surrogate", 1, 2), F.lit("00"), F.expr("substring(surrogate, 5)"))
    digits = F.lpad((F.lit(98) - _mod97(bare)).cast("string"), 2, "0")
    account = F.concat(F.substring("surrogate", 1, 2), digits, F.expr("substring(surrogate, 5)"))
    x = x.withColumn("surrogate", F.when((F.col("kind") == "iban") & (_mod97(F.col("norm")) == 1), account).otherwise(F.col("surrogate")))
    return x.select("kind", "norm", "gender", "lead", "attempt", "surrogate")


def dictionary(entities: DataFrame, key: str) -> DataFrame:
    """Distinct entities(kind, norm, gender, lead) with their surrogates, free of collisions. lead: digits of a phone
    number's country code, which stay."""
    now = cut(_draw(entities.withColumn("attempt", F.lit(0)), key))
    for _ in range(_ROUNDS):
        first = now.groupBy("kind", "surrogate").agg(F.min("norm").alias("first"), F.count("*").alias("n"))
        taken = now.select("kind", F.col("norm").alias("surrogate"), F.lit(True).alias("occurs"))
        seen = now.join(first, ["kind", "surrogate"]).join(taken, ["kind", "surrogate"], "left")
        again = F.col("occurs").isNotNull() | ((F.col("n") > 1) & (F.col("norm") != F.col("first")))
        marked = cut(seen.withColumn("again", again))
        if marked.where("again").isEmpty():
            return now
        held = marked.where("not again").select(*now.columns)
        fresh = marked.where("again").select("kind", "norm", "gender", "lead", (F.col("attempt") + 1).alias("attempt"))
        now = cut(held.unionByName(_draw(fresh, key)))
    raise RuntimeError("surrogates still collide: the format leaves too few values")


def _render(raw: F.Column, surrogate: F.Column) -> tuple[F.Column, F.Column]:
    """The surrogate in the mention's own format: its separators, or its letter case. What it is longer follows."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))

    def fill(a: F.Column, c: F.Column) -> F.Column:
        hit = c.rlike("[A-Z0-9]")
        return F.struct(F.concat(a["out"], F.when(hit, F.substring(surrogate, a["at"], F.lit(1))).otherwise(c)).alias("out"), F.when(hit, a["at"] + 1).otherwise(a["at"]).alias("at"))

    filled = F.aggregate(F.split(raw, ""), start, fill, lambda a: F.concat(a["out"], F.substr(surrogate, a["at"])))
    cased = F.array_join(F.transform(F.split(raw, ""), lambda c, i: F.when(c.rlike("[A-Z]"), F.upper(F.substring(surrogate, i + 1, F.lit(1)))).otherwise(F.substring(surrogate, i + 1, F.lit(1)))), "")
    cased = F.concat(cased, F.substr(surrogate, F.length(raw) + 1))
    return filled, cased


def _windows(words: F.Column, n: int) -> F.Column:
    """All runs of n words."""
    last = F.size(words) - n
    return F.when(last >= 0, F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(0)) + 1), lambda i: F.array_join(F.slice(words, i, n), " "))).otherwise(F.array().cast("array<string>"))


def _gender(before: F.Column) -> F.Column:
    title = F.regexp_extract(F.regexp_replace(before, r"\.? $", ""), r"(\S+)$", 1)
    return F.when(title.isin(*FEMALE), "f").when(title.isin(*MALE), "m").otherwise("")


def find(hits: DataFrame) -> DataFrame:
    """(doc, raw, kind, gender) of all mentions in hits(doc, pieces)."""
    at = F.filter(F.sequence(F.lit(0), F.size("pieces") - 1), lambda i: i % 2 == 1)
    each = F.transform(at, lambda i: F.struct(F.get("pieces", i).alias("raw"), F.substring(F.get("pieces", i - 1), -20, 20).alias("before")))
    seen = hits.select("doc", F.explode(each).alias("m")).select("doc", "m.raw", "m.before").distinct()
    typed = cut(seen.withColumn("kind", kind(F.col("raw"), F.col("before"))).withColumn("gender", F.when(F.col("kind") == "name", _gender(F.col("before"))).otherwise("")).drop("before").distinct())
    direct = typed.where("kind <> 'sequence'")
    words = F.split("raw", " ")
    runs = typed.where("kind = 'sequence'").select("doc", F.explode(F.concat(_windows(words, 3), _windows(words, 2))).alias("raw")).distinct()
    first, two = F.substring_index("raw", " ", 1), F.size(F.split("raw", " ")) == 2
    given = runs.where(two & first.isin(*GIVEN_MALE, *GIVEN_FEMALE)).select("doc", "raw", F.lit("name").alias("kind"), F.when(first.isin(*GIVEN_FEMALE), "f").otherwise("m").alias("gender"))
    known = cut(direct.where("kind = 'name' and raw like '% %'").select("raw").unionAll(given.select("raw")).distinct())
    again = runs.join(small(known), "raw").select("doc", "raw", F.lit("name").alias("kind"), F.lit("").alias("gender"))
    return cut(direct.unionByName(given).unionByName(again).distinct())


def replace(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """docs with private data in `text` replaced, and n_private: how many mentions were."""
    columns = [c for c in docs.columns if c != "n_private"]
    names = {c: f"__c{i}" for i, c in enumerate(columns)}
    own = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    body = F.col(names[text])
    hint = _hint(body)
    others = [n for c, n in names.items() if c != text]
    cutted = own.where(hint).select(*others, F.md5(body.cast("binary")).alias("doc"), pieces(body).alias("pieces"))
    hits = cut(cutted)
    some = hits.where(F.size("pieces") > 1)
    found = find(some.select("doc", "pieces"))
    # entities: a name's words, all others whole
    plain = found.where("kind <> 'name'").withColumn("norm", _norm(F.col("raw"), F.col("kind"))).withColumn("lead", F.length(F.regexp_replace(F.regexp_extract("raw", r"^\+\d{1,3}(?=[ .(-])", 0), r"\D", "")))
    words = found.where("kind = 'name'").select("raw", "gender", F.posexplode(F.split("raw", " ")).alias("nth", "norm"))
    lone = F.when(F.col("nth") == 0, F.col("gender")).otherwise("")
    words_ = words.select(F.lit("name").alias("kind"), "norm", lone.alias("gender"), F.lit(0).alias("lead"))
    sex = F.when(F.count_if(F.col("gender") == "f") > F.count_if(F.col("gender") == "m"), "f").when(F.count_if(F.col("gender") == "m") > 0, "m").otherwise("")
    entities = plain.select("kind", "norm", "gender", "lead").unionAll(words_).groupBy("kind", "norm").agg(sex.alias("gender"), F.max("lead").alias("lead"))
    drawn = cut(dictionary(entities, key).select("kind", "norm", "surrogate"))
    filled, cased = _render(F.col("raw"), F.col("surrogate"))
    out = F.when(F.col("kind").isin("card", "ssn", "iban", "phone"), filled).when(F.col("kind").isin("email", "ipv6"), cased).otherwise(F.col("surrogate"))
    whole = plain.select("raw", "kind", "norm").distinct().join(drawn, ["kind", "norm"]).select("raw", out.alias("shown"))
    parts = words.select("raw", "nth", F.lit("name").alias("kind"), "norm").distinct().join(drawn, ["kind", "norm"])
    parts = parts.groupBy("raw").agg(F.sort_array(F.collect_list(F.struct("nth", "surrogate"))).alias("w")).select("raw", F.array_join(F.transform("w", lambda w: w["surrogate"]), " ").alias("shown"))
    shown = cut(whole.unionAll(parts).groupBy("raw").agg(F.min("shown").alias("shown")))
    told = found.select("doc", "raw").distinct().join(small(shown), "raw").groupBy("doc").agg(F.map_from_entries(F.collect_list(F.struct("raw", "shown"))).alias("map"))
    told = told.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    j = some.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALT)).cast("int")).join(told, ["doc", "salt"], "left")

    def sequence(piece: F.Column) -> F.Column:
        ws = F.split(piece, " ")
        start = F.struct(F.array().cast("array<string>").alias("out"), F.lit(0).alias("skip"))

        def step(a: F.Column, i: F.Column) -> F.Column:
            three, two = (F.when(i + n <= F.size(ws) + 1, F.element_at(F.col("map"), F.array_join(F.slice(ws, i, n), " "))) for n in (3, 2))
            word = F.coalesce(three, two, F.get(ws, i - 1))
            skip = F.when(three.isNotNull(), 2).when(two.isNotNull(), 1).otherwise(0)
            return F.struct(F.when(a["skip"] > 0, a["out"]).otherwise(F.array_append(a["out"], word)).alias("out"), F.when(a["skip"] > 0, a["skip"] - 1).otherwise(skip).alias("skip"))

        return F.array_join(F.aggregate(F.sequence(F.lit(1), F.size(ws)), start, step, lambda a: a["out"]), " ")

    def one(piece: F.Column, i: F.Column) -> F.Column:
        return F.when(i % 2 == 1, F.coalesce(F.element_at(F.col("map"), piece), F.when(piece.contains(" "), sequence(piece)), piece)).otherwise(piece)

    new = j.withColumn("new", F.when(F.col("map").isNull(), F.col("pieces")).otherwise(F.transform("pieces", one)))
    count = F.aggregate(F.zip_with("pieces", "new", lambda a, b: (a != b).cast("int")), F.lit(0), lambda a, x: a + x)
    made = lambda n: names[text] == n
    order = lambda body_, n: [(body_ if made(k) else F.col(k)).alias(c) for c, k in names.items()] + [n.alias("n_private")]
    changed = new.select(*order(F.array_join("new", ""), count))
    same = hits.where(F.size("pieces") <= 1).select(*order(F.array_join("pieces", ""), F.lit(0)))
    none = own.where(~hint).select(*order(body, F.lit(0)))
    return changed.unionAll(same).unionAll(none)
