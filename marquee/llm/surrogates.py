"""Surrogates for personal data, in DataFrame expressions only.

Detected entities are replaced by keyed surrogates of the same type and format: an address
for an address, a card number that passes its check digit for a card number, a name of the
same gender and script for a name.  Equal entities get equal surrogates everywhere in the
corpus (coreference), different ones different surrogates: every distinct entity is drawn by a
keyed hash, draws that collide with each other or with an entity of the corpus are drawn anew,
and the resulting table is joined back.  Texts without an entity are never shuffled.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import written

# Titles by gender, particles inside names, and name syllables by script.
TITLES_M = ("Mr", "Mister", "Sir", "Herr", "Monsieur", "Señor", "Господин", "Κύριος")
TITLES_ANY = ("Dr", "Doctor", "Prof", "Professor")
TITLES_F = ("Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mademoiselle", "Señora", "Señorita", "Госпожа", "Κυρία")
PARTICLES = ("van", "von", "der", "den", "de", "da", "di", "du", "del", "la", "le", "al", "bin", "ibn")
SYLLABLES = {
    "latin": ("ba be bo da de do fa fe ga go ha ka ke ko la le li lo ma me mi mo na ne ni no pa ra re ri ro sa se so ta te to va ve vi", "n", "a"),
    "cyrillic": ("ба бе бо да де до га ка ко ла ле ли ло ма ме ми мо на не ни но па ра ре ри ро са се со та те то ва ве ви", "н", "а"),
    "greek": ("βα βε γα δα δε κα κο λα λε λι λο μα με μι μο να νε νι νο πα πε ρα ρε ρι ρο σα σε σο τα τε το φα φι χα", "ς", "α"),
}

_TITLE = "(?:" + "|".join(TITLES_M + TITLES_F + TITLES_ANY) + ")"
_HEAD = rf"(?:{_TITLE}\.? ){{1,3}}"  # one title or several, as in "Frau Dr."
_WORD = r"\p{Lu}(?:\p{L}++|['’]\p{Lu}\p{L}++)"
_INNER = r"(?:(?:\p{Lu}\.){1,4} ){0,4}(?:(?:" + "|".join(PARTICLES) + r") ){0,3}"  # initials and particles stay
_SECRET = r"[^\s\"'&<>,;]"
# Country codes of telephone numbers: the one-digit ones, the two-digit ones, all others have three.
_COUNTRY = r"^(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
PATTERNS = {
    "pem": r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----[\w+/=\s:,.\\-]*?-----END [A-Z ]{0,30}PRIVATE KEY-----",
    "password": rf"(?<![A-Za-z0-9])(?i:passw(?:or)?d|passphrase|pwd)(?:=[\"']?(?={_SECRET}*[\p{{L}}\d]){_SECRET}{{3,}}+|: ?[\"']?(?={_SECRET}*\d){_SECRET}{{6,}}+)",
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2}(?: ?\d{4}){1,5}(?: ?\d{1,3})?(?![A-Za-z0-9])",
    # after a plus sign 7 to 15 digits in any grouping; else an area code in brackets, three-three-four, or a leading zero and groups
    "phone": r"(?<![\w+])(?:\+\d{1,3}[ .-]?(?:\(\d{2,4}\)|\d{2,4})[ .-]?\d{3}[ .-]?\d{4}(?!\w)|\+[1-9](?:[ .()/-]{0,2}\d){6,14}|\(\d{2,5}\) ?\d(?:[ .-]?\d){5,9}|\d{3}[-. ]\d{3}[-. ]\d{4}"
             r"|(?=0(?: ?\d){8,13}(?![\d ]*\d))0\d{1,4}(?: \d{2,8}){1,5})(?!\w)",
    "ipv6": r"(?<![\w:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}"
            r"|(?=[0-9A-Fa-f:]*::)(?=[A-Fa-f:]*\d)[0-9A-Fa-f]{3,4}(?::[0-9A-Fa-f]{0,4}){1,6}:[0-9A-Fa-f]{1,4})(?![\w:])",
    "ip": rf"(?<![\w.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\w|\.\d)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "card": r"(?<!\w)[2-6]\d{3}(?:(?: \d{4}){3}|(?:-\d{4}){3}|\d{9,12})(?!\w)",
    "secret": r"(?<!\w)(?:(?=[a-f]*+\d)(?=\d*+[a-f])[0-9a-f]{32,}+|(?=[A-F]*+\d)(?=\d*+[A-F])[0-9A-F]{32,}+"
              r"|AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9]{20,}+)(?!\w)",
    "name": rf"(?<!\p{{L}}){_HEAD}{_INNER}{_WORD}(?:[ -](?!{_TITLE}(?!\p{{L}})){_INNER}{_WORD}){{0,7}}(?!\p{{L}})",
}
# The characters a match can start with, looked at before the rest of its pattern.
STARTS = {"password": "[pP]", "iban": "[A-Z]", "phone": r"[+(\d]", "ipv6": "[0-9A-Fa-f]{1,4}:", "ip": r"\d", "ssn": r"\d", "card": "[2-6]",
          "secret": "[0-9A-Fa-fgs]", "name": "[" + "".join(sorted({t[0] for t in TITLES_M + TITLES_F + TITLES_ANY})) + "]"}
ANY = "|".join(f"(?:(?={STARTS[k]}){p})" if k in STARTS else f"(?:{p})" for k, p in PATTERNS.items())
# What a text with an entity cannot lack: cheap to look for, before the patterns themselves.
HINT = r"[@\d]|PRIVATE KEY|(?i:passw|passphrase|pwd)|" + "|".join(TITLES_M + TITLES_F + TITLES_ANY)


def matches(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"({ANY})"), F.lit(1))


def type_of(match: Column) -> Column:
    """The first pattern that fits the whole match; a card number must pass its check digit,
    what fits nothing is NULL."""
    out = F.lit(None).cast("string")
    for name, p in reversed(PATTERNS.items()):
        fits = F.rlike(match, F.lit(f"^(?:{p})$"))
        if name == "card":
            fits = fits & F.call_function("luhn_check", F.regexp_replace(match, "[ -]", ""))
        out = F.when(fits, F.lit(name)).otherwise(out)
    return out


def parts_of(match: Column, i: Column) -> Column:
    """The entities of a match as ``(i, k, kind, norm)``: one, or for a name one per name;
    the norm is equal for spellings of the same entity."""
    kind = type_of(match)
    digits = F.regexp_replace(match, "[^0-9]", "")
    norm = (F.when(kind.isin("email", "ipv6"), F.lower(match))
             .when(kind.isin("card", "ssn"), digits)
             # the country code stays, so it is part of the entity
             .when(kind == "phone", F.concat(F.when(F.startswith(match, F.lit("+")), F.concat(F.lit("+"), F.regexp_extract(digits, _COUNTRY, 0)))
                                              .otherwise(F.lit("")), F.lit(":"), digits))
             .when(kind == "password", F.regexp_replace(match, F.lit(_BEFORE_PASSWORD), F.lit("")))
             .when(kind == "iban", F.regexp_replace(match, " ", "")).otherwise(match))
    one = F.array(F.struct(i.alias("i"), F.lit(0).alias("k"), kind.alias("kind"), norm.alias("norm")))
    words = F.filter(_words(match), _is_name)
    female = F.rlike(match, F.lit("^(?:" + "|".join(TITLES_F) + r")(?!\p{L})"))
    either = F.rlike(match, F.lit("^(?:" + "|".join(TITLES_ANY) + r")(?!\p{L})"))
    names = F.transform(words, lambda w, k: F.struct(
        i.alias("i"), k.alias("k"),
        F.concat(F.when(k + 1 == F.size(words), F.lit("family")).when(female, F.lit("given_f")).when(either, F.lit("given_x"))
                  .otherwise(F.lit("given_m")), F.lit("_"), _script(w)).alias("kind"), F.lower(w).alias("norm")))
    return F.when(kind == "name", names).when(kind.isNotNull(), one).otherwise(F.array().cast(
        "array<struct<i:int,k:int,kind:string,norm:string>>"))


_BEFORE_PASSWORD = "^[^=:]*[=:] ?[\"']?"


def _words(match: Column) -> Column:
    """What follows the titles of a name, word by word."""
    return F.split(F.regexp_replace(match, F.lit("^" + _HEAD), F.lit("")), "[ -]")


def _is_name(word: Column) -> Column:
    """Not an initial or a particle."""
    return F.rlike(word, F.lit(f"^{_WORD}$"))


def _script(word: Column) -> Column:
    return (F.when(F.rlike(word, F.lit(r"^\p{IsCyrillic}")), F.lit("cyrillic"))
             .when(F.rlike(word, F.lit(r"^\p{IsGreek}")), F.lit("greek")).otherwise(F.lit("latin")))


def _hex(key: str, kind: Column, norm: Column, attempt: Column, n: int) -> Column:
    """64 * n keyed hexadecimal digits of an entity and attempt."""
    return F.concat(*[F.sha2(F.concat_ws("\x1f", F.lit(key), kind, norm, attempt.cast("string"), F.lit(str(i))), 256) for i in range(n)])


def _long_hex(key: str, kind: Column, norm: Column, attempt: Column) -> Column:
    """As many keyed hexadecimal digits as ``norm`` has characters, or more."""
    return F.array_join(F.transform(F.sequence(F.lit(0), F.floor(F.length(norm) / 64).cast("int")), lambda i: F.sha2(
        F.concat_ws("\x1f", F.lit(key), kind, norm, attempt.cast("string"), i.cast("string")), 256)), "")


_HEX = "0123456789abcdef"


def _shaped(norm: Column, stream: Column) -> Column:
    """``norm`` with each letter and digit replaced by one of its kind from the stream."""
    letters, digits = F.translate(stream, _HEX, "bcdfghjklmnprstv"), F.translate(stream, _HEX, "0123456789012345")

    def char(i):
        c = F.substr(norm, i, F.lit(1))
        low, digit = F.substr(letters, i, F.lit(1)), F.substr(digits, i, F.lit(1))
        return (F.when(F.rlike(c, F.lit(r"^[a-z]$")), low).when(F.rlike(c, F.lit(r"^[A-Z]$")), F.upper(low))
                 .when(F.rlike(c, F.lit(r"^\d$")), digit)
                 .when(F.rlike(c, F.lit(r"^\p{L}$")), low).otherwise(c))
    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(norm)), char), "")


def draw(key: str, kind: Column, norm: Column, attempt: Column) -> Column:
    """The keyed draw for an entity: same type, same format, another value per attempt.
    Attempts after the first widen the space where the format allows it."""
    stream = _hex(key, kind, norm, attempt, 2)
    digits = F.translate(stream, _HEX, "0123456789012345")
    extra = F.when(attempt > 0, F.substr(digits, F.lit(60), F.least(attempt, F.lit(9)))).otherwise(F.lit(""))
    local = F.regexp_extract(norm, "^([^@]*)@", 1)
    email = F.concat(_shaped(F.substr(local, F.lit(1), F.lit(60)), stream), extra, F.lit("@mail"), F.substr(digits, F.lit(100), F.lit(1)),
                     F.lit(".example."), F.element_at(F.array(*map(F.lit, ("com", "net", "org"))),
                                                      (F.conv(F.substr(stream, F.lit(101), F.lit(4)), 16, 10).cast("int") % 3 + 1)))
    code = F.coalesce(F.nullif(F.regexp_extract(norm, r"^\+(\d*):", 1), F.lit("")), F.regexp_extract(norm, "^:(0?)", 1))
    own = F.length(F.regexp_extract(norm, r":(\d*)$", 1)) - F.length(code)
    phone = F.concat(code, F.substr(digits, F.lit(1), own))
    # the body of a card number, then the digit that makes it pass
    body = F.concat(F.substr(norm, F.lit(1), F.lit(1)), F.substr(digits, F.lit(1), F.length(norm) - 2))
    total = F.aggregate(F.sequence(F.lit(1), F.length(body)), F.lit(0), lambda acc, i: acc + _luhn_value(body, i))
    card = F.concat(body, ((10 - total % 10) % 10).cast("string"))
    octet = lambda k: (F.conv(F.substr(stream, F.lit(k), F.lit(6)), 16, 10).cast("int") % 254 + 1).cast("string")
    ip = F.concat_ws(".", octet(1), octet(9), octet(17), octet(25))
    long = F.when(F.length(norm) > 128, _long_hex(key, kind, norm, attempt)).otherwise(stream)
    secret = F.when(F.rlike(norm, F.lit("^[0-9a-f]+$")), F.substr(long, F.lit(1), F.length(norm))) \
              .when(F.rlike(norm, F.lit("^[0-9A-F]+$")), F.upper(F.substr(long, F.lit(1), F.length(norm)))) \
              .otherwise(F.concat(F.regexp_extract(norm, "^(AKIA|gh[a-z]_|sk-)", 1),
                                  _shaped(F.regexp_replace(norm, "^(AKIA|gh[a-z]_|sk-)", ""), long)))
    country, account = F.substr(norm, F.lit(1), F.lit(2)), _shaped(F.substr(norm, F.lit(5)), stream)
    iban = F.concat(country, F.lpad((98 - _mod97(F.concat(account, country, F.lit("00")))).cast("string"), 2, "0"), account)
    # an address of the range kept for documents
    ipv6 = F.concat(F.lit("2001:db8"), *[F.concat(F.lit(":"), F.substr(stream, F.lit(4 * k + 1), F.lit(4))) for k in range(6)])
    head, tail = F.regexp_extract(norm, "^-----BEGIN [A-Z ]*-----", 0), F.regexp_extract(norm, "-----END [A-Z ]*-----$", 0)
    pem = F.concat(head, _shaped(F.substr(norm, F.length(head) + 1, F.length(norm) - F.length(head) - F.length(tail)), long), tail)
    out = (F.when(kind == "email", email).when(kind == "phone", phone).when(kind == "card", card).when(kind == "ip", ip)
            .when(kind == "ssn", F.concat(F.lit("9"), F.substr(digits, F.lit(1), F.lit(8)))).when(kind == "iban", iban)
            .when(kind == "secret", secret).when(kind == "ipv6", ipv6).when(kind == "pem", pem)
            .when(kind == "password", F.concat(_shaped(norm, long), extra)))
    for script, (syllables, male, female) in SYLLABLES.items():
        pool = F.array(*map(F.lit, syllables.split()))
        pick = functools.partial(_syllable, pool, len(syllables.split()), stream)
        name = F.array_join(F.transform(F.sequence(F.lit(0), 2 + F.least(attempt, F.lit(12))), pick), "")
        out = out.when(kind == f"given_m_{script}", F.concat(name, F.lit(male))) \
                 .when(kind == f"given_f_{script}", F.concat(name, F.lit(female))) \
                 .when(kind.isin(f"family_{script}", f"given_x_{script}"), name)
    return out


def _syllable(pool: Column, n: int, stream: Column, i: Column) -> Column:
    return F.element_at(pool, F.conv(F.substr(stream, i * 4 + 1, F.lit(4)), 16, 10).cast("int") % n + 1)


def _mod97(text: Column) -> Column:
    """The remainder of digits and capitals (A is 10) read as one decimal number."""
    def step(acc, i):
        c = F.substr(text, i, F.lit(1))
        return F.when(F.rlike(c, F.lit("[A-Z]")), acc * 100 + F.ascii(c) - 55).otherwise(acc * 10 + F.ascii(c) - 48) % 97
    return F.aggregate(F.sequence(F.lit(1), F.length(text)), F.lit(0), step)


def _luhn_value(body: Column, i: Column) -> Column:
    """What digit i of a number without its check digit adds: every other one, from the
    right, doubled with its digits summed."""
    d = F.substr(body, i, F.lit(1)).cast("int")
    twice = (F.length(body) - i) % 2 == 0
    return F.when(twice, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d)


ROUNDS = 100  # draws of an entity


def assign(entities: DataFrame, key: str) -> DataFrame:
    """``(kind, norm)`` rows with a surrogate each: distinct within a kind and equal to no
    entity of that kind.

    Every round draws for the entities still open; of those that drew the same value the
    least keeps it, and one that drew a value taken before, or a real entity's, draws anew.
    A round is two aggregates and joins over the open entities, its table is written.  Kinds of
    fixed length have a space of fixed size: entities without a surrogate after ``ROUNDS`` rounds
    (their kind fills about nine tenths of its space) raise a ``ValueError``."""
    open_ = written(entities.select("kind", "norm").distinct(), "entities")
    real = open_.select("kind", _compared(F.col("kind"), F.col("norm")).alias("s")).distinct()
    done = None
    for attempt in range(ROUNDS):
        drawn = open_.withColumn("surrogate", draw(key, F.col("kind"), F.col("norm"), F.lit(attempt)))
        drawn = drawn.withColumn("s", F.lower("surrogate"))
        least = drawn.groupBy("kind", "s").agg(F.min("norm").alias("norm"))
        won = least.join(real, ["kind", "s"], "left_anti")
        if done is not None:
            won = won.join(done.select("kind", F.lower("surrogate").alias("s")), ["kind", "s"], "left_anti")
        won = written(drawn.join(won, ["kind", "s", "norm"], "left_semi").select("kind", "norm", "surrogate"), "surrogates")
        done = won if done is None else done.unionByName(won)
        open_ = written(open_.join(won, ["kind", "norm"], "left_anti"), "entities")
        if open_.isEmpty():
            return done
    full = sorted(r.kind for r in open_.select("kind").distinct().collect())  # kinds are few
    raise ValueError(f"no free surrogate after {ROUNDS} rounds for entities of: {', '.join(full)}")


def _compared(kind: Column, norm: Column) -> Column:
    """A real entity in the form of a surrogate of its kind."""
    return F.lower(F.when(kind == "phone", F.regexp_extract(norm, r":(\d*)$", 1)).otherwise(norm))


def written_like(match: Column, surrogate: Column) -> Column:
    """The surrogate in the spelling of the match: its separators, and its capitals."""
    digits_of = F.regexp_replace(surrogate, "[^0-9A-Za-z]", "")

    def refill(keep: str):
        def char(i):
            c = F.substr(match, i, F.lit(1))
            at = F.length(F.regexp_replace(F.substr(match, F.lit(1), i), keep, ""))
            return F.when(F.rlike(c, F.lit(r"^[0-9A-Za-z]$")), F.substr(digits_of, at, F.lit(1))).otherwise(c)
        return F.array_join(F.transform(F.sequence(F.lit(1), F.length(match)), char), "")
    kind = type_of(match)
    spelled = F.when(kind.isin("phone", "card", "ssn", "iban"), refill("[^0-9A-Za-z]"))
    spelled = spelled.when(kind == "password", F.concat(F.regexp_extract(match, _BEFORE_PASSWORD, 0), surrogate)).otherwise(surrogate)
    all_caps = F.rlike(match, F.lit(r"\p{Lu}")) & ~F.rlike(match, F.lit(r"\p{Ll}"))
    return F.when(kind.isin("email", "ipv6") & all_caps, F.upper(spelled)).otherwise(spelled)


def _renamed(match: Column, names: Column) -> Column:
    """A titled name with new names, capitalised as the old ones were; titles, initials,
    particles and separators stay."""
    head = F.regexp_extract(match, "^" + _HEAD, 0)
    words, between = _words(match), F.regexp_extract_all(F.substr(match, F.length(head) + 1), F.lit("([ -])"), F.lit(1))

    def one(old, k):
        name = F.element_at(names, F.size(F.filter(F.slice(words, F.lit(1), k + 1), _is_name)))
        caps = (F.length(old) > 1) & (F.upper(old) == old)
        new = F.when(~_is_name(old), old).when(caps, F.upper(name)).otherwise(F.initcap(name))
        return F.concat(F.when(k == 0, F.lit("")).otherwise(F.try_element_at(between, k)), new)
    return F.concat(head, F.array_join(F.transform(words, one), ""))


def replace_entities(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``df`` with every entity of ``text`` replaced and ``n_replaced`` added.

    NULL and empty texts stay as they are; repeated rows stay and read alike; surrogates
    depend on ``key`` and the corpus's entities, not on the order or placing of rows; card
    numbers that fail their check digit are no entities; a name has a title before it and up to
    eight words (initials and particles stay as they are); an empty table stays empty; a column
    named ``n_replaced`` is replaced.
    """
    keep = [c for c in df.columns if c != "n_replaced"]
    base = df.select(*keep)
    hinted = F.coalesce(F.rlike(F.col(text), F.lit(HINT)), F.lit(False)) & (F.size(matches(F.col(text))) > 0)
    flagged = base.withColumn("__hit", F.coalesce(hinted, F.lit(False)))
    plain = flagged.filter(~F.col("__hit")).drop("__hit").withColumn("n_replaced", F.lit(0).cast("long"))
    hit = flagged.filter("__hit").drop("__hit").withColumn("__digest", F.sha2(F.col(text), 256))

    found = hit.groupBy("__digest").agg(F.any_value(matches(F.col(text))).alias("m"))  # copies meet as one text
    found = written(found.withColumn("parts", F.flatten(F.transform("m", parts_of))).select("__digest", "parts"), "entities")
    parts = found.select("__digest", F.explode("parts").alias("p")).select("__digest", "p.i", "p.k", "p.kind", "p.norm")
    table = assign(parts, key)
    mapped = parts.join(table, ["kind", "norm"]).groupBy("__digest").agg(
        F.array_sort(F.collect_list(F.struct("i", "k", "surrogate"))).alias("__new"))
    joined = hit.join(mapped, "__digest", "left")

    def piece(match, i):
        own = F.transform(F.filter("__new", lambda n: n["i"] == i), lambda n: n["surrogate"])
        return (F.when(F.coalesce(F.size(own), F.lit(0)) <= 0, match).when(type_of(match) == "name", _renamed(match, own))
                 .otherwise(written_like(match, F.element_at(own, F.lit(1)))))
    between = F.split(F.col(text), ANY, -1)
    joined = joined.withColumn("__between", between).withColumn("__m", F.transform(matches(F.col(text)), piece))
    whole = F.concat(F.element_at("__between", F.lit(1)), F.array_join(F.zip_with(
        "__m", F.slice("__between", F.lit(2), F.size("__between")), lambda m, b: F.concat(m, b)), ""))
    count = F.size(F.array_distinct(F.transform(F.coalesce("__new", F.array().cast("array<struct<i:int,k:int,surrogate:string>>")),
                                                lambda n: n["i"])))
    done = joined.withColumn(text, whole).withColumn("n_replaced", count.cast("long")).select(*keep, "n_replaced")
    return plain.unionByName(done)
