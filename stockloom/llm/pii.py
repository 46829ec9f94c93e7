"""Personal data and secrets: surrogates instead of masks.

Every detected entity is replaced by a made-up one of its type. The surrogate is drawn from a keyed hash of
the entity, so an entity has the same surrogate wherever it occurs (coreference), and without the key the
original cannot be found again. It keeps the format: separators, lengths, letter case, a valid or invalid
check digit, octets of an address, the script of a name, the gender its title tells. Surrogates of a type
are checked against each other and against every entity found in the input; on a collision all but one
entity draw again, until all differ (distinctness).

Everything is column expressions and joins. Texts with entities are stored once and meet the surrogates of
their own entities only; texts without entities are not moved at all. An entity or a text that makes up much of the table is an ordinary
skewed join key, which adaptive execution splits; surrogates are drawn once per different entity.

Defined results: null and empty texts stay as they are. Texts are searched whole. Repeated rows are treated
alike. Rows need no id. An empty table gives no rows. All columns pass through; `n_replaced` is added and
takes the place of an input column of that name.
"""

from __future__ import annotations

import hashlib
import unicodedata
from dataclasses import dataclass
from functools import cache, reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockloom.llm.common import col, stored

# How each type is recognised. All patterns are linear in the text: runs are possessive and
# start only where a run of that class can start.
EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)+"
KEY_ID = r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[0-9A-Z]{16}(?![0-9A-Za-z])"
SECRET_NAME = (
    r"(?:(?i:passwords?|passwd|pwd|tokens?|secrets?|api[_-]?keys?)\s{0,3}[=:]\s{0,3}[\"']?"
    r"|(?i:passwords?|passwd|pwd|passphrase)\sis:?\s[\"']?(?=[^\s\"'<>]*\d)"
    r"|(?i:bearer)\s(?=[A-Za-z0-9._~+/=-]{16})(?=[A-Za-z0-9._~+/=-]*\d))"
)
# Beginnings of keys that services give out; what follows is replaced.
TOKEN = (
    r"(?<![\p{L}\p{N}_-])(?:gh[pousr]_[A-Za-z0-9]{20,}+|sk-[A-Za-z0-9_-]{16,}+|xox[abprs]-[A-Za-z0-9-]{10,}+"
    r"|eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+)"
)
SCHEME = r"[A-Za-z][A-Za-z0-9+.-]{1,20}+://"
LOGIN = r"(?<![\p{L}\p{N}])" + SCHEME + r"[^\s:/@<>\"']{1,64}+:[^\s/@<>\"']{1,64}+@"
SECRET = r"(?<![\p{L}\p{N}])" + SECRET_NAME + r"[^\s\"'<>]{6,}+"
IBAN = r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])"
ADDRESS = r"(?<![\p{N}.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\d|\.\d)"
SOCIAL = r"(?<![\p{N}-])\d{3}-\d{2}-\d{4}(?![\d-])"
ADDRESS_6 = (
    r"(?<![\p{L}\p{N}:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}"
    r"|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![\p{L}\p{N}:])"
)
# The groupings cards are printed in, or all digits together; other digits side by side are dates and numbers.
CARD = (
    r"(?<![\p{N}+.])(?:\d{4}(?:[ -]\d{4}){3}(?:[ -]\d{1,3})?|\d{4}[ -]\d{6}[ -]\d{4,5}|\d{4}(?:[ -]\d{3}){3}|\d{13,19})(?!\d)"
)
PHONE = (
    r"\+\d{1,3}(?:[ .-]?\(\d{1,4}\)|[ .-]\d{1,4}|\d{2,4}){2,5}(?!\d)"
    r"|(?<![\p{N}+])(?<![\p{N}+][.-])(?:1[ .-]|1(?=\())?(?:\(?\d{3}\)?[ .-]|\(\d{3}\))\d{3}[ .-]\d{4}(?!\d)"
)
TITLE_HE = r"Mr|Herr|Monsieur|Señor|Sr|Signor|господин|г-н"
TITLE_SHE = r"Mrs|Ms|Miss|Frau|Madame|Mme|Señora|Sra|Signora|госпожа|г-жа"
TITLE_ANY = r"Dr|Doctor|Prof|Professor"
TITLES = rf"(?:(?:{TITLE_HE}|{TITLE_SHE}|{TITLE_ANY})\.?\s)"
# A word of a name: capitals inside it, parts joined by apostrophes or hyphens (a possessive s is none), a short
# beginning in lower case (d', al-). Initials and particles stand before a word.
JOINT, LETTERS = r"['’ʼ‐‑-]", r"[\p{L}\p{M}]"
JOINED = rf"(?:{JOINT}(?!(?i:s)(?!{LETTERS}))\p{{L}}{LETTERS}*+)"
WORD = rf"(?:\p{{Ll}}{{1,3}}{JOINT})?\p{{Lu}}(?:{LETTERS}++{JOINED}*+|{JOINED}++)"
INITIAL = rf"(?:\p{{Lu}}\.(?:{JOINT}(?=\p{{Lu}}\.)|\s)?|\p{{Lu}}\s)"
PARTICLE = r"(?:(?:van|von|vom|zu|zum|zur|der|den|dem|ter|ten|de|del|della|di|da|do|dos|das|du|des|la|las|le|los|el|al|bin|ibn|ben|bint|abu|af|av|y|e)\s)"
WORDS = rf"(?:{INITIAL}|{PARTICLE})*+{WORD}"
NAME = rf"(?<![\p{{L}}\p{{N}}]){TITLES}++(?:{WORDS}(?:\s{WORDS})*+|\p{{Lu}}(?:\.\s?\p{{Lu}}(?!{LETTERS}))*+(?!{LETTERS}))"
# What of a name is replaced: each capitalised or joined piece.
PIECE = rf"(?:\p{{Lu}}|(?<={LETTERS}{JOINT})\p{{L}}){LETTERS}*+"
# A text with none of these signs has no entity; most texts need no more than this look.
SIGNS = r"[@0-9=:]|AKIA|ASIA|gh[pousr]_|sk-|xox|eyJ"
# Beginnings of the titles.
TITLE_SIGNS = ("Mr", "Ms", "Miss", "Mme", "Madame", "Monsieur", "Herr", "Frau", "Señor", "Sr", "Signor", "госп", "г-", "Dr", "Doctor", "Prof")
# Syllables of made-up names, per script.
LATIN = "ba be bi bo da de di do fa fe ga ge ka ke ki ko la le li lo ma me mi mo na ne no ra re ri ro sa se ta te to va ve vi za".split()
CYRILLIC = "ба бе бо ва ве ви да де ди до жа за зе ка ки ко ла ле ли ло ма ме ми мо на не но па по ра ре ро са се та те то фа фе".split()
GREEK = "βα βε βο γα γε δα δε δι θα θε κα κε κι κο λα λε λι λο μα με μι μο να νε νο πα πε πο ρα ρε ρο σα σε τα τε το φα φι χα".split()
NAME_END = {"he": {"latin": "n", "cyrillic": "н", "greek": "ς"}, "she": {"latin": "a", "cyrillic": "я", "greek": "α"}, "any": {"latin": "l", "cyrillic": "й", "greek": "ω"}, "family": {"latin": "r", "cyrillic": "в", "greek": "ου"}}


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str


# In order of precedence where two could start at the same place.
KINDS = (
    Kind("secret", SECRET), Kind("token", TOKEN), Kind("login", LOGIN), Kind("email", EMAIL), Kind("key_id", KEY_ID),
    Kind("iban", IBAN), Kind("address", ADDRESS), Kind("address_6", ADDRESS_6),
    Kind("social", SOCIAL), Kind("phone", PHONE), Kind("card", CARD), Kind("name", NAME),
)
ANY = "|".join(f"(?:{k.pattern})" for k in KINDS)
#: After this many draws the format is let go a little, since a short format may have too few values; from then on
#: values get one character longer with every draw, so that there are enough in the end, however many entities.
STRICT_DRAWS = 6


def _kind(found: Column) -> Column:
    """The type of a matched string."""
    kind = F.when(F.regexp_like(found, F.lit(f"^(?:{KINDS[0].pattern})$")), KINDS[0].name)
    for k in KINDS[1:]:
        kind = kind.when(F.regexp_like(found, F.lit(f"^(?:{k.pattern})$")), k.name)
    return kind.otherwise("card")


def _part(before: Column, kind: Column, value: Column) -> Column:
    return F.struct(before.alias("before"), kind.alias("kind"), value.alias("value"))


def _script(word: Column) -> Column:
    return (
        F.when(F.regexp_like(word, F.lit(r"\p{IsCyrillic}")), "cyrillic")
        .when(F.regexp_like(word, F.lit(r"\p{IsGreek}")), "greek").otherwise("latin")
    )


def _parts(found: Column) -> Column:
    """What is to be replaced in a matched string: pieces (text before, type, value).

    The name of a secret, the scheme of an address, the titles of a person, particles and the separators of names stay."""
    kind = _kind(found)
    label, scheme = F.regexp_extract(found, "^" + SECRET_NAME, 0), F.regexp_extract(found, "^" + SCHEME, 0)
    title = F.regexp_extract(found, rf"^{TITLES}+", 0)
    he, she = (F.regexp_like(title, F.lit(rf"(?:^|\s)(?:{t})\.?\s")) for t in (TITLE_HE, TITLE_SHE))
    names = F.substring(found, F.length(title) + 1, F.length(found))
    pieces, gaps = F.regexp_extract_all(names, F.lit(PIECE), F.lit(0)), F.split(names, PIECE, -1)
    # The pieces of the last word are the family's.
    own = F.size(pieces) - F.size(F.regexp_extract_all(F.regexp_extract(names, r"(\S+)$", 1), F.lit(PIECE), F.lit(0)))
    role = lambda i: F.when(i >= own, "family:").when(she, "she:").when(he, "he:").otherwise("any:")
    person = F.transform(pieces, lambda x, i: _part(
        F.concat(F.when(i == 0, title).otherwise(""), F.get(gaps, i)),
        F.when(F.length(x) == 1, "initial").otherwise(F.concat(role(i), _script(x))), x,
    ))
    return (
        F.when(kind == "secret", F.array(_part(label, kind, F.substring(found, F.length(label) + 1, F.length(found)))))
        .when(kind == "login", F.array(_part(scheme, kind, F.substring(found, F.length(scheme) + 1, F.length(found)))))
        .when(kind == "name", person)
        .otherwise(F.array(_part(F.lit(""), kind, found)))
    )


DIGIT_KINDS = ("card", "phone", "social")


def _canonical(kind: Column, value: Column) -> Column:
    """Spellings of one entity in one form: digits only, lower case, or as it is."""
    return (
        F.when(kind.isin(*DIGIT_KINDS), F.regexp_replace(value, r"\D", ""))
        .when(kind == "iban", F.replace(value, F.lit(" "), F.lit("")))
        .when(kind.isin("email", "address_6") | kind.contains(":"), F.lower(value))
        .otherwise(value)
    )


def _characters(value: Column) -> Column:
    return F.split(value, r"(?s)(?<=.)(?=.)")


def _hash_byte(i: Column) -> Column:
    """Byte i of the keyed stream in `__stream` (hex)."""
    return F.conv(F.substring(F.col("__stream"), (i * 2 + 1).cast("int"), F.lit(2)), 16, 10).cast("int")


def _pick(alphabet: str, i: Column) -> Column:
    return F.substring(F.lit(alphabet), F.pmod(_hash_byte(i), F.lit(len(alphabet))) + 1, F.lit(1))


LOWER, UPPER, HEX = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789abcdef"


def _same_class(value: Column, hexadecimal: Column | None = None) -> Column:
    """Each letter or digit by another of its class, everything else as it is."""
    def one(c: Column, i: Column) -> Column:
        plain = (
            F.when(c.rlike("^[0-9]$"), _pick("0123456789", i)).when(c.rlike("^[A-Z]$"), _pick(UPPER, i))
            .when(c.rlike("^[a-z]$"), _pick(LOWER, i)).when(c.rlike(r"^\p{IsCyrillic}$"), _pick("абвгдежзиклмнопрстуфх", i))
            .when(c.rlike(r"^\p{IsGreek}$"), _pick("αβγδεζηθικλμνξοπρστυφχ", i)).when(c.rlike(r"^\p{L}$"), _pick(LOWER, i)).otherwise(c)
        )
        return plain if hexadecimal is None else F.when(hexadecimal & c.rlike("^[0-9a-f]$"), _pick(HEX, i)).otherwise(plain)

    return F.array_join(F.transform(_characters(value), one), "")


def _luhn(digits: Column) -> Column:
    """The Luhn sum of a string of digits, modulo 10."""
    n = F.length(digits)
    doubled = lambda d, i: F.when(F.pmod(n - i, F.lit(2)) == 1, d).otherwise(F.when(d < 5, d * 2).otherwise(d * 2 - 9))
    values = F.transform(_characters(digits), lambda c, i: doubled(c.try_cast("int"), i))
    return F.pmod(F.aggregate(values, F.lit(0), lambda s, d: s + d), F.lit(10))


def _remainder_97(account: Column) -> Column:
    """An account number, letters read as 10 to 35, modulo 97."""
    value = lambda c: F.when(c.rlike("^[0-9]$"), c.try_cast("int")).otherwise(F.ascii(c) - 55)
    return F.aggregate(
        _characters(account), F.lit(0),
        lambda s, c: F.pmod(s * F.when(c.rlike("^[0-9]$"), F.lit(10)).otherwise(F.lit(100)) + value(c), F.lit(97)),
    )


def _longer(value: Column, extra: Column) -> Column:
    """`extra` further digits from the stream, behind the bytes that `value` uses."""
    more = F.transform(F.sequence(F.lit(1), F.greatest(extra, F.lit(1))), lambda i: _pick("0123456789", F.length(value) + i))
    return F.when(extra < 1, F.lit("")).otherwise(F.array_join(more, ""))


def _digits(value: Column) -> Column:
    """Other digits; the first one keeps its place in 1-9, so that no number starts with a zero it did not have."""
    return F.array_join(F.transform(
        _characters(value),
        lambda c, i: F.when((i == 0) & (c != "0"), _pick("123456789", i)).otherwise(_pick("0123456789", i)),
    ), "")


def _octet(old: Column, i: Column, strict: Column) -> Column:
    b = _hash_byte(i * 2) * 256 + _hash_byte(i * 2 + 1)
    kept = (
        F.when(F.length(old) == 1, F.pmod(b, F.lit(10))).when(F.length(old) == 2, 10 + F.pmod(b, F.lit(90)))
        .otherwise(100 + F.pmod(b, F.lit(156)))
    )
    return F.when(strict, kept).otherwise(F.pmod(b, F.lit(256))).cast("string")


def _syllables(table: list[str], n: Column) -> Column:
    all_of = F.array(*[F.lit(x) for x in table])
    return F.array_join(F.transform(F.sequence(F.lit(1), n), lambda i: F.element_at(all_of, F.pmod(_hash_byte(i), F.lit(len(table))) + 1)), "")


def _draw(key: str) -> Column:
    """The surrogate of (`kind`, `value`) at draw number `draw`, in canonical form."""
    kind, value, draw = F.col("kind"), F.col("value"), F.col("draw")
    strict = draw < STRICT_DRAWS
    # Past the strict draws, characters are added where the type allows any length.
    past = draw - STRICT_DRAWS
    more = F.when(strict, F.lit("")).otherwise(F.substring(F.col("__stream"), F.lit(-8) - past, F.lit(8) + past))
    country = F.when((kind == "phone") & strict, F.lit(1)).otherwise(F.lit(0))
    digits = F.concat(F.substring(value, F.lit(1), country), _digits(F.substring(value, country + 1, F.length(value))), _longer(value, past))
    card = F.concat(F.substring(value, 1, 1), F.substring(_digits(value), F.lit(2), F.length(value) - 2), _longer(value, past))
    check = F.pmod(F.lit(10) - _luhn(F.concat(card, F.lit("0"))), F.lit(10))
    # An invalid number stays invalid: any other last digit.
    last = F.when(_luhn(value) == 0, check).otherwise(F.pmod(check + 1 + F.pmod(_hash_byte(F.lit(31)), F.lit(9)), F.lit(10)))
    local, domain = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
    top = F.when(F.substring_index(domain, ".", -1).isin("com", "net", "org"), F.substring_index(domain, ".", -1)).otherwise("com")
    label = F.substring(F.translate(F.sha2(F.concat(F.lit(f"{key}|domain|"), domain), 256), "0123456789", "ghijkmnpqr"), F.lit(1), F.lit(8))
    octets = F.array_join(F.transform(F.split(value, r"\."), lambda o, i: _octet(o, i, strict)), ".")
    octets = F.concat(octets, _longer(value, past - STRICT_DRAWS))
    hexadecimal = value.rlike("^[0-9a-f]+$")
    body = F.concat(_same_class(F.substring(value, F.lit(5), F.length(value))), F.upper(more))
    rest = lambda v: F.concat(F.substring(v, F.lit(5), F.length(v)), F.substring(v, 1, 4))
    right = 98 - _remainder_97(F.concat(body, F.substring(value, 1, 2), F.lit("00")))
    given = F.when(_remainder_97(rest(value)) == 1, right).otherwise(F.pmod(right + 1, F.lit(97)) + 2)
    iban_check = F.lpad(given.cast("string"), 2, "0")
    out = (
        F.when(kind == "card", F.concat(card, last.cast("string")))
        .when(kind.isin("phone", "social"), digits)
        .when(kind == "email", F.concat(_same_class(local), more, F.lit("@"), label, F.lit(".example."), top))
        .when(kind == "address", octets)
        .when(kind == "iban", F.concat(F.substring(value, 1, 2), iban_check, body))
        .when(kind == "address_6", F.concat(_same_class(value, F.lit(True)), more))
        .when(kind == "token", F.concat(F.substring(value, 1, 4), _same_class(F.substring(value, F.lit(5), F.length(value))), more))
        .when(kind == "key_id", F.concat(F.substring(value, 1, 4), _same_class(F.substring(value, F.lit(5), F.length(value))), F.upper(more)))
    )
    for script, table in (("latin", LATIN), ("cyrillic", CYRILLIC), ("greek", GREEK)):
        for part, ends in NAME_END.items():
            n = F.lit(3) + F.when(strict, F.lit(0)).otherwise(F.lit(3) + past)
            out = out.when(kind == f"{part}:{script}", F.concat(_syllables(table, n), F.lit(ends[script])))
    return out.otherwise(F.concat(_same_class(value, hexadecimal), more))


@cache
def _initials(key: str) -> tuple[str, str]:
    """Capitals and what stands for each: the next one of its alphabet in a keyed order, so never itself and no
    other's. An initial has too few values for one that occurs nowhere in the input."""
    alphabets: dict[str, list[str]] = {}
    for c in filter(str.isupper, map(chr, range(0x20000))):
        if unicodedata.category(c) == "Lu":
            alphabets.setdefault("ascii" if c.isascii() else unicodedata.name(c).split(" ")[0], []).append(c)
    of, to = [], []
    for letters in alphabets.values():
        order = sorted(letters, key=lambda c: hashlib.sha256(f"{key}|initial|{c}".encode()).digest())
        of, to = of + order, to + order[1:] + order[:1]
    return "".join(of), "".join(to)


def _stream(key: str) -> Column:
    """Hex digits of keyed hashes of the entity and the draw, two for each character it may need."""
    blocks = F.sequence(F.lit(0), F.floor((F.length("value") + 8 + F.col("draw")) / 32).cast("int") + 1)
    return F.array_join(F.transform(blocks, lambda b: F.sha2(F.concat_ws("|", F.lit(key), "kind", F.col("draw").cast("string"), b.cast("string"), "value"), 256)), "")


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """Rows (`kind`, `value`, `surrogate`) for the rows (`kind`, `value`) given.

    Surrogates of a kind differ from each other and from all values of that kind. Each round draws for the
    entities still without one; a drawn string that is taken, or is some entity's own value, counts for
    nobody, and of several entities that draw the same one the smallest keeps it.
    """
    entities = stored(entities.select("kind", "value").distinct(), "entities")
    # Two passes over one character each can collide only within a kind; spellings never mix kinds.
    pending, done, draw = entities, None, 0
    while True:
        drawn = pending.withColumn("draw", F.lit(draw)).withColumn("__stream", _stream(key))
        drawn = drawn.withColumn("surrogate", _draw(key)).select("kind", "value", "surrogate")
        drawn = stored(drawn, "drawn")
        free = drawn.join(entities.select("kind", F.col("value").alias("surrogate")), ["kind", "surrogate"], "left_anti")
        if done is not None:
            free = free.join(done.select("kind", "surrogate"), ["kind", "surrogate"], "left_anti")
        settled = stored(free.groupBy("kind", "surrogate").agg(F.min("value").alias("value")).select("kind", "value", "surrogate"), "settled")
        done = settled if done is None else done.unionByName(settled)
        pending = stored(pending.join(settled.select("kind", "value"), ["kind", "value"], "left_anti"), "pending")
        if pending.isEmpty():
            return done
        draw += 1


def _has_capital(value: Column) -> Column:
    return value.rlike(r"^\p{Lu}")


def _in_format(kind: Column, value: Column, surrogate: Column) -> Column:
    """A canonical surrogate in the spelling of this occurrence: its separators and its letter case."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("used"))
    spaced = F.aggregate(
        _characters(value), start,
        lambda s, c: F.when(
            c.rlike(r"^[0-9A-Za-z]$"),
            F.struct(F.concat(s["out"], F.substring(surrogate, s["used"] + 1, F.lit(1))).alias("out"), (s["used"] + 1).alias("used")),
        ).otherwise(F.struct(F.concat(s["out"], c).alias("out"), s["used"].alias("used"))),
        lambda s: F.concat(s["out"], F.substring(surrogate, s["used"] + 1, F.length(surrogate))),
    )
    local, made = F.substring_index(value, "@", 1), F.substring_index(surrogate, "@", 1)
    domain = F.concat(F.lit("@"), F.substring_index(surrogate, "@", -1))
    like = lambda new, old: F.when((old == F.upper(old)) & (old != F.lower(old)), F.upper(new))
    mailed = F.concat(like(made, local).when(_has_capital(local), F.initcap(made)).otherwise(made), domain)
    return (
        F.when(kind.isin(*DIGIT_KINDS, "iban"), spaced)
        .when(kind == "email", mailed)
        .when(kind.contains(":"), like(F.upper(surrogate), value).when(_has_capital(value), F.initcap(surrogate)).otherwise(surrogate))
        .otherwise(surrogate)
    )


def replace_entities(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """The documents with surrogates in their texts, and `n_replaced`, the number of replaced strings.

    `key` must be kept secret: with it, guesses at the originals can be tried out. There is no default."""
    if not key:
        raise ValueError("surrogates need a key")
    own = [c for c in docs.columns if c.lower() != "n_replaced"]
    names = {c: f"c{i}" for i, c in enumerate(own)}
    rows = docs.select(*[col(c).alias(n) for c, n in names.items()])
    body = F.col(names[text])
    signs = reduce(or_, [body.contains(t) for t in TITLE_SIGNS], body.rlike(SIGNS))
    found = F.regexp_extract_all(body, F.lit(ANY), F.lit(0))
    clean = rows.filter(body.isNull() | ~signs | (F.size(found) == 0)).withColumn("n_replaced", F.lit(0))
    # An explode, not a filter on the result: a filter would be moved below and search the text twice.
    some = rows.filter(signs).withColumn("found", F.explode(F.filter(F.array(found), lambda x: F.size(x) > 0)))
    marked = stored(some.withColumn("at", F.sha2(body, 256)), "marked").withColumn("parts", F.transform("found", _parts))

    each = marked.select("at", F.explode(F.array_distinct(F.flatten("parts"))).alias("p"))
    each = each.select("at", F.col("p.kind").alias("kind"), _canonical(F.col("p.kind"), F.col("p.value")).alias("value"))
    each = stored(each.filter("kind != 'initial'").distinct(), "occurrences")
    table = surrogates(each.select("kind", "value"), key)
    entry = F.struct(F.concat_ws("|", "kind", "value"), F.col("surrogate"))
    maps = each.join(table, ["kind", "value"]).groupBy("at").agg(F.map_from_entries(F.collect_list(entry)).alias("named"))
    met = marked.join(maps, "at", "left")  # a text may have initials only
    letters = _initials(key)

    def written(p: Column) -> Column:
        new = F.element_at(F.col("named"), F.concat_ws("|", p["kind"], _canonical(p["kind"], p["value"])))
        spelled = F.when(p["kind"] == "initial", F.translate(p["value"], *letters)).otherwise(_in_format(p["kind"], p["value"], new))
        return F.concat(p["before"], spelled)

    replaced = F.transform("parts", lambda ps: F.array_join(F.transform(ps, written), ""))
    between = F.split(body, ANY, -1)  # the text around the matches, one piece more than there are matches
    whole = F.array_join(F.transform(between, lambda piece, i: F.concat(piece, F.coalesce(F.get(F.col("replaced"), i), F.lit("")))), "")
    met = met.withColumn("replaced", replaced).withColumn("whole", whole).withColumn("n_replaced", F.size("found"))
    changed = met.select(*[(F.col("whole") if c == text else F.col(n)).alias(n) for c, n in names.items()], "n_replaced")
    out = clean.select(*names.values(), "n_replaced").unionByName(changed)
    return out.select(*[F.col(n).alias(c) for c, n in names.items()], "n_replaced")
