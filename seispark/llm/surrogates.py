"""Personal data replaced by keyed surrogates of the same kind."""

import hashlib

from pyspark.sql import functions as F

from seispark.llm.text import row_key, with_fields
from seispark.session import materialise

# Common given names by script and gender, and titles.
GIVEN = {
    "latin_female": "Anna Emma Sofia Maria Julia Laura Clara Elena Marta Alice Sarah Emily Jane Mary Linda Susan Karen Camille Chloe Ines Lucia Carmen Greta Heidi".split(),
    "latin_male": "James John Robert Michael William David Thomas Daniel Peter Paul Mark George Lukas Felix Jonas Hans Pierre Louis Antoine Jules Carlos Diego Javier Pablo".split(),
    "cyrillic_female": "Анна Мария Елена Ольга Татьяна Наталья Ирина Светлана Екатерина Юлия".split(),
    "cyrillic_male": "Иван Алексей Дмитрий Сергей Андрей Николай Павел Михаил Олег Виктор".split(),
}
TITLES = "Mr Mrs Ms Miss Dr Prof Herr Frau Monsieur Madame Señor Señora Г-н Г-жа".split()

# Characters a letter or digit may become, by the class it belongs to; the first class that holds it counts.
ALPHABETS = [
    ("[0-9]", "0123456789"),
    ("[aeiouy]", "aeiou"),
    ("[a-z]", "bcdfghjklmnprstvwz"),
    ("[AEIOUY]", "AEIOU"),
    ("[A-Z]", "BCDFGHJKLMNPRSTVWZ"),
    ("[аеёиоуыэюя]", "аеиоу"),
    ("[а-я]", "бвгдзклмнпрстфх"),
    ("[АЕЁИОУЫЭЮЯ]", "АЕИОУ"),
    ("[А-Я]", "БВГДЗКЛМНПРСТФХ"),
    ("[αεηιουω]", "αεηιου"),
    ("[α-ω]", "βγδκλμνπρστφχ"),
    ("[Α-Ω]", "ΒΓΔΚΛΜΝΠΡΣΤΦΧ"),
    ("\\p{Lu}", "ÁÉÍÓÚ"),
    ("\\p{Ll}", "áéíóú"),
]

_NAMES = "|".join(x for pool in GIVEN.values() for n in pool for x in (n, n.upper()))
_OCTET = "(?:25[0-5]|2[0-4]\\d|1\\d\\d|[1-9]?\\d)"
EMAIL = "(?<![\\w.%+-])[\\w.%+-]++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)+"
ASSIGNED = "(?i:password|passwd|pwd|secret|token|api[_-]?key)\\s{0,3}[=:]\\s{0,3}[\"']?(?=[A-Za-z+/_-]*\\d)[A-Za-z0-9+/_-]{8,}"
ACCESS_KEY = "(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])"
IPV4 = f"(?<![\\d.])(?:{_OCTET}\\.){{3}}{_OCTET}(?!\\d|\\.\\d)"
PHONE = "(?<![\\w.])(?:\\+\\d{1,3}[ -]?)?(?:\\(\\d{3}\\) ?|\\d{3}[ -])\\d{3}[ -]\\d{4}(?!\\d)"
ABROAD = "(?<![\\w.])\\+\\d{1,3}(?:[ -]\\d{2,4}){2,5}(?![\\d])"
#: 8 to 15 digits behind a plus, with or without separators; the last group has two digits or more.
INTERNATIONAL = "(?<![\\w.])\\+\\d(?:(?:[ ./-]?\\(|\\)[ ./-]?|[ ./-])?\\d){7,14}(?<=\\d\\d)(?!\\d)"
#: Groups parted by dots, longer groups behind an area code, and pairs.
DOTTED = "(?<![\\w.])(?:\\+?\\d{1,3}\\.)?(?:\\(\\d{3}\\)[ .]?|\\d{3}\\.)\\d{3}\\.\\d{4}(?!\\d|\\.\\d)"
AREA = "(?<![\\w.])(?:(?:\\(0\\d{1,5}\\)|\\(\\d{3}\\)(?=[ ./-]?\\d{7}(?!\\d)))[ ./-]?(?:\\d{2,4}(?:[ /-]\\d{2,5}){1,3}|\\d{5,8})|0\\d{2,4}[ /-]\\d{6,8})(?!\\d)"
PAIRS = "(?<![\\w.])0\\d(?:(?: \\d{2}){4}|(?:\\.\\d{2}){4}|(?:-\\d{2}){4})(?!\\d|[ .-]\\d)"
SOCIAL = "(?<![\\w-])\\d{3}-\\d{2}-\\d{4}(?![\\w-])"
CARD = "(?<![\\d.])(?:\\d{13,19}|\\d{4}(?:[ -]\\d{4}){3}|\\d{4}[ -]\\d{6}[ -]\\d{5})(?!\\d)"
_TITLE = f"(?:{'|'.join(TITLES)})\\.?"
_WORD = "\\p{Lu}\\p{L}++"
_MORE = f"(?=\\s(?:{_NAMES})\\s{_WORD})"
#: A title with one or two names, or a given name with one; single names elsewhere are too often plain words.
#: A match ends before a further given name with a name behind it, which is the next match: no number of given names is too many.
NAME = f"(?=\\p{{Lu}})(?<!\\p{{L}})(?:{_TITLE}\\s{_WORD}(?:{_MORE}|(?:\\s{_WORD})?)|(?:{_NAMES})(?:{_MORE}|\\s{_WORD}))(?!\\p{{L}})"
PATTERN = "|".join([EMAIL, ASSIGNED, ACCESS_KEY, f"(?=[\\d(+])(?:{'|'.join([IPV4, PHONE, ABROAD + '(?![ ./-]\\d)', INTERNATIONAL, ABROAD, DOTTED, AREA, PAIRS, SOCIAL, CARD])})", NAME])
#: What every match but a name holds; texts without it are searched for names alone.
SIGN = "[0-9@]|AKIA"
#: Words of a name at most.
WORDS = 3

LAST = 64


def _characters(text):
    return F.transform(F.sequence(F.lit(1), F.char_length(text)), lambda i: F.substring(text, i, F.lit(1)))


def _digits(text):
    return F.regexp_replace(text, r"\D", "")


def _luhn(digits):
    """Sum of the digits, every second one from the right doubled and its digits added; the last digit counts once."""
    each = F.transform(F.sequence(F.lit(1), F.char_length(digits)), lambda i: F.substring(F.reverse(digits), i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1))
    return F.aggregate(each, F.lit(0), lambda total, d: total + F.when(d > 9, d - 9).otherwise(d))


def mentions(rows):
    """(_id, _h, _place, _mention, _kind, _canon) of every match, names word by word; kind is null for what stays.

    A place is WORDS + 1 times the number of the match and the number of the word in it. The canonical form is the
    same for all spellings of one entity: an email in lower case, the last ten digits of a phone number, the digits
    of a card or social number, the value of a secret without its name, a name's word in lower case.
    """
    may = F.col("_text").rlike(SIGN) | F.col("_text").rlike(NAME)
    found = rows.where(may).select("_id", "_h", F.posexplode(F.regexp_extract_all("_text", F.lit(PATTERN), F.lit(0))).alias("_pos", "_match"))
    found = found.withColumn("_name", F.col("_match").rlike(f"^(?:{NAME}|{_NAMES})$"))
    parts = F.when(F.col("_name"), F.regexp_extract_all("_match", F.lit(r"\S+\s?"), F.lit(0))).otherwise(F.array("_match"))
    found = found.select("_id", "_h", "_pos", "_name", F.posexplode(parts).alias("_sub", "_mention"))
    m, word = F.col("_mention"), F.regexp_replace("_mention", r"\s", "")

    def whole(pattern):
        return m.rlike(f"^(?:{pattern})$")

    digits = _digits(m)
    kind = F.when(F.col("_name") & (F.col("_sub") == 0) & word.rlike(f"^{_TITLE}$"), F.lit(None).cast("string"))
    for pool, names in GIVEN.items():
        kind = kind.when(F.col("_name") & F.lower(word).isin([n.lower() for n in names]), pool)
    kind = kind.when(F.col("_name"), "surname").when(whole(EMAIL), "email").when(whole(ASSIGNED) | whole(ACCESS_KEY), "secret")
    kind = kind.when(whole(IPV4), "ip").when(whole(SOCIAL), "social").when(whole(CARD), F.when(_luhn(digits) % 10 == 0, "card")).otherwise("phone")
    found = found.withColumn("_kind", kind)
    k = F.col("_kind")
    value = F.when(whole(ACCESS_KEY), m).otherwise(F.regexp_extract(m, "[=:]\\s*[\"']?([^\"'\\s=:]+)$", 1))
    canon = F.when(k == "secret", value).when(k == "phone", F.substring(digits, F.greatest(F.char_length(digits) - 9, F.lit(1)), F.lit(10)))
    canon = canon.when(k.isin("social", "card"), digits).when(k == "ip", m).otherwise(F.lower(word))
    place = F.col("_pos") * (WORDS + 1) + F.col("_sub")
    return found.select("_id", "_h", place.alias("_place"), "_mention", "_kind", canon.alias("_canon"))


def _stream(key, kind, canon, attempt):
    """Hex digits drawn from the key for one entity, two for each of its characters and some more."""
    parts = F.sequence(F.lit(0), F.floor(F.char_length(canon) / 32 + 1).cast("int"))
    return F.array_join(F.transform(parts, lambda n: F.sha2(F.concat_ws("\x1f", F.lit(key), kind, canon, attempt.cast("string"), n.cast("string")), 256)), "")


def _draw(stream, i, base):
    return F.conv(F.substring(stream, 2 * i - 1, F.lit(2)), 16, 10).cast("int") % base


def _same_shape(text, stream):
    """Each letter or digit replaced by one of its class, everything else as it is."""

    def one(i):
        c = F.substring(text, i, F.lit(1))
        new = F.when(F.lit(False), c)
        for pattern, alphabet in ALPHABETS:
            new = new.when(c.rlike(pattern), F.substring(F.lit(alphabet), _draw(stream, i, len(alphabet)) + 1, F.lit(1)))
        return new.otherwise(c)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.char_length(text)), one), "")


def _surrogate(key):
    """Canonical surrogate of (_kind, _canon) at its ``_attempt``."""
    kind, canon, attempt = F.col("_kind"), F.col("_canon"), F.col("_attempt")
    stream = F.col("_stream")
    shaped = _same_shape(canon, stream)
    hexed = F.array_join(F.transform(F.sequence(F.lit(1), F.char_length(canon)), lambda i: F.substring(F.lit("0123456789abcdef"), _draw(stream, i, 16) + 1, F.lit(1))), "")
    local, domain = F.substring_index(canon, "@", 1), F.substring_index(canon, "@", -1)
    # letters of the last label stay: .com remains .com; once short names run out, the local part grows
    last = F.substring_index(domain, ".", -1)
    mapped = F.substring(shaped, F.lit(1), F.char_length(canon) - F.char_length(last))
    longer = F.when(attempt >= 8, F.substring(F.reverse(stream), F.lit(1), F.lit(4))).otherwise("")
    email = F.concat(longer, mapped, last)
    octets = F.transform(F.sequence(F.lit(1), F.lit(4)), lambda i: (_draw(stream, i, F.when(i == 1, 223).otherwise(254)) + 1).cast("string"))
    private = F.regexp_extract(canon, "^(10\\.|192\\.168\\.|127\\.|172\\.(?:1[6-9]|2\\d|3[01])\\.)", 1)
    dots = F.size(F.split(private, "\\.")) - 1
    ip = F.concat(private, F.array_join(F.slice(octets, dots + 1, 4 - dots), "."))
    first = F.concat(F.substring(F.lit("23456789"), _draw(stream, F.lit(1), 8) + 1, F.lit(1)), F.substring(shaped, F.lit(2), F.char_length(canon)))
    body = F.concat(F.substring(canon, F.lit(1), F.lit(1)), F.substring(shaped, F.lit(2), F.char_length(canon) - 2))
    card = F.concat(body, ((F.lit(10) - _luhn(F.concat(body, F.lit("0"))) % 10) % 10).cast("string"))
    secret = F.when(canon.rlike("^AKIA"), F.concat(F.lit("AKIA"), F.substring(shaped, F.lit(5), F.char_length(canon)))).when(canon.rlike("^[0-9a-f]+$"), hexed).otherwise(F.concat(shaped, longer))
    surname = F.concat(shaped, F.when(attempt >= 8, F.substring(shaped, F.lit(1), F.lit(3))).otherwise(""))
    return (
        F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "phone", first).when(kind == "social", first)
        .when(kind == "card", card).when(kind == "secret", secret).otherwise(surname)
    )


def assign(entities, key):
    """(_kind, _canon, _surrogate) with surrogates that differ from one another and from every entity of their kind.

    All entities draw a surrogate; those whose draw is another's as well (all but the least of them) or is
    an entity of the corpus draw anew, with the next attempt number, until no collision is left. The check is a
    count by surrogate, summed before the shuffle. An error is raised if a kind has no free surrogates.
    """
    drawn = entities.select("_kind", "_canon", F.lit(0).alias("_attempt"))
    for _ in range(LAST):
        drawn = drawn.withColumn("_stream", _stream(key, F.col("_kind"), F.col("_canon"), F.col("_attempt")))
        drawn = materialise(drawn.withColumn("_surrogate", _surrogate(key)).drop("_stream"), "surrogates")
        claims = drawn.groupBy("_kind", "_surrogate").agg(F.min(F.struct("_attempt", "_canon")).alias("_winner"))
        real = entities.select("_kind", F.col("_canon").alias("_surrogate"), F.lit(True).alias("_real"))
        judged = claims.join(real, ["_kind", "_surrogate"], "left").select("_kind", "_surrogate", F.when(F.col("_real").isNull(), F.col("_winner._canon")).alias("_holder"))
        lost = drawn.join(judged, ["_kind", "_surrogate"]).withColumn("_lost", ~F.col("_canon").eqNullSafe(F.col("_holder")))
        lost = materialise(lost.drop("_holder"), "judged")
        if lost.where("_lost").isEmpty():
            return lost.select("_kind", "_canon", "_surrogate")
        drawn = lost.select("_kind", "_canon", (F.col("_attempt") + F.col("_lost").cast("int")).alias("_attempt"))
    raise ValueError("a kind of personal data has more values than surrogates")


def given_names(key):
    """Literal map from a given name in lower case to the next one of its pool in keyed order: no two share one, none is its own."""
    pairs = []
    for pool in GIVEN.values():
        order = sorted(pool, key=lambda n: hashlib.sha256(f"{key}\x1f{n}".encode()).hexdigest())
        pairs += [(a.lower(), b.lower()) for a, b in zip(order, order[1:] + order[:1])]
    return F.create_map(*[F.lit(x) for pair in pairs for x in pair])


def _dressed(mention, surrogate, kind):
    """The surrogate as the mention was written: prefix, separators, country code and capitals."""
    digits, n = _digits(mention), F.char_length(surrogate)
    line = F.concat(F.substring(digits, F.lit(1), F.char_length(digits) - n), surrogate)
    numbers = F.array_join(F.transform(
        F.sequence(F.lit(1), F.char_length(mention)),
        lambda i: F.when(F.substring(mention, i, F.lit(1)).rlike(r"\d"), F.substring(line, F.char_length(_digits(F.substring(mention, F.lit(1), i))), F.lit(1))).otherwise(F.substring(mention, i, F.lit(1))),
    ), "")
    shown = F.transform(F.sequence(F.lit(1), n), lambda i: F.when(F.substring(mention, i, F.lit(1)).rlike(r"\p{Lu}"), F.upper(F.substring(surrogate, i, F.lit(1)))).otherwise(F.substring(surrogate, i, F.lit(1))))
    word, blank = F.regexp_replace(mention, r"\s", ""), F.regexp_extract(mention, r"(\s?)$", 1)
    loud = (F.upper(word) == word) & (F.char_length(word) > 1)
    name = F.when(loud, F.upper(surrogate)).otherwise(F.concat(F.upper(F.substring(surrogate, F.lit(1), F.lit(1))), F.substring(surrogate, F.lit(2), n)))
    prefix = F.when(mention.rlike(f"^(?:{ACCESS_KEY})$"), "").otherwise(F.regexp_extract(mention, "^(.*?[=:]\\s*[\"']?)[^\"'\\s=:]+$", 1))
    return (
        F.when(kind.isin("phone", "social", "card"), numbers).when(kind == "email", F.array_join(shown, ""))
        .when(kind == "ip", surrogate).when(kind == "secret", F.concat(prefix, surrogate)).otherwise(F.concat(name, blank))
    )


def replace_personal_data(docs, key, id_col="doc_id", text_col="text"):
    """(_row, replaced, n_entities) of every row: the text with keyed surrogates for all personal data found.

    Kinds: email, phone, social and card numbers (with valid check digit), IPv4 addresses, assigned secrets and access
    keys, and names behind a title or a known given name, word by word, given names by script and gender. A surrogate has the kind, length,
    script, capitals, separators, check digit and country code of what it replaces; one entity has one surrogate in all
    documents and spellings, two entities have two, none is an entity of the corpus, and the same key gives the same draws.

    Only matches leave their document, distinct entities are drawn once, and surrogates come back by place; an entity
    in a third of all documents is one row of the drawing and a split partition of the join. Null and empty texts
    have none and come back empty; equal rows come back alike, each once; null ids are one id.
    Card-like numbers with a wrong check digit and numbers of no known form stay.
    """
    ident, h, text = row_key(id_col, text_col)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), ident, h, text)
    found = materialise(mentions(rows.select("_id", "_h", "_text")).distinct(), "mentions")
    names = F.col("_kind").isin(list(GIVEN))
    drawn = assign(found.where(F.col("_kind").isNotNull() & ~names).select("_kind", "_canon").distinct(), key)
    joined = found.join(drawn, ["_kind", "_canon"], "left")
    joined = joined.withColumn("_surrogate", F.when(names, given_names(key)[F.col("_canon")]).otherwise(F.col("_surrogate")))
    shown = joined.withColumn("_shown", F.coalesce(_dressed(F.col("_mention"), F.col("_surrogate"), F.col("_kind")), F.col("_mention")))
    places = shown.groupBy("_id", "_h").agg(
        F.map_from_entries(F.collect_set(F.struct("_place", "_shown"))).alias("_places"), F.count("_surrogate").alias("_count")
    )
    out = rows.join(places, ["_id", "_h"], "left")
    parts = F.transform(
        F.split("_text", PATTERN, -1),
        lambda gap, i: F.concat(gap, *[F.coalesce(F.col("_places")[i * (WORDS + 1) + k], F.lit("")) for k in range(WORDS)]),
    )
    replaced = F.when(F.col("_places").isNull(), F.col("_text")).otherwise(F.array_join(parts, ""))
    return out.select("_row", replaced.alias("replaced"), F.coalesce("_count", F.lit(0)).alias("n_entities"))


def without_personal_data(docs, key, id_col="doc_id", text_col="text"):
    """The documents with surrogates in their texts, columns as they were."""
    return replace_personal_data(docs, key, id_col, text_col).select(with_fields("_row", docs.columns, **{text_col: F.col("replaced")}))
