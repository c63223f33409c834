"""Operator 2: surrogates for personal data and secrets.

Detected entities (e-mail addresses, phone, card, social security and account numbers, IP addresses, access keys and
tokens, names after a title and, in the same document, without it) are replaced by keyed surrogates of the same kind:
character classes, punctuation, case, country code, card scheme and check digit stay; names keep gender and script.
Surrogate e-mail domains are reserved ones. Spelling variants of an entity (case, separators, a national number with
and without its country code, a short and a full IPv6 address) have one canonical form and so one surrogate, in every
document: coreference is kept. A given name is male or female if the corpus has it after titles of one kind only, and
neutral otherwise, so it has one surrogate too.

Keyed: candidates come from HMAC-SHA-512 under the caller's key, which stands in the plan as a literal: plans and event
logs of such jobs are as secret as the key.

Distinctness: a candidate that equals an entity of the corpus, or one already given, or that two entities claim, is
refused but for the smallest claimant; the others try again, ``ROUNDS`` times in all. Who is left then (forms that are
nearly full) gets the free values of the form in order, by rank; a full form grows by digits. So different entities never
share a surrogate, and surrogates never run out.

DataFrame expressions only. A text is searched once: the entities are marked in it, and it is written cut at the marks.
Entities are distinct before any shuffle (partial aggregation), mentions are joined to the entity table by (kind,
canonical form) with no grouping on that key, so Spark may split an entity that a third of all mentions share; only
documents with a mention are shuffled. Ranks are counted by bucket, so no task holds a form.

Defined results: null texts stay null; texts without an entity stay as they are; repeated rows get equal results;
rows with a null doc_id are treated like any other; an empty table gives an empty result; other columns are kept by
``pseudonymize`` whatever their names (the count is named ``n_entities``, with a line appended while the name is used).
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lensmill.llm.common import fresh, let, materialize, numbered

#: For the registered query only, where the session names no key of its own in ``KEY_SETTING``.
DEMO_KEY = "a key for demonstrations"
KEY_SETTING = "spark.lensmill.surrogate.key"
ROUNDS = 5
SLOTS = 1 << 16

OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
HEX4 = "[0-9A-Fa-f]{1,4}"
MALE = ("Mr", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "Signor", "Господин")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Señorita", "Signora", "Госпожа")
NEUTRAL = ("Dr", "Prof")
TITLES = "|".join(sorted((*MALE, *FEMALE, *NEUTRAL), key=len, reverse=True))
#: A capital word; a possessive ending is not part of it.
NAME_WORD = r"\p{Lu}(?:\p{L}+|(?=['’-]\p{Lu}))(?:['’-]\p{Lu}\p{L}+)*"
INITIALS = r"(?:\p{Lu}\. ?){0,3}"
TITLED = rf"(?<![\p{{L}}\p{{N}}])(?=[MHSDPFГ])(?:{TITLES})\.? {INITIALS}"
#: Before each of these stands no ASCII letter or digit. In the order in which they are tried at one place of a text.
PATTERNS = (
    r"(?<![\p{L}\p{N}])[\p{L}\p{N}][\p{L}\p{N}._%+-]{0,63}+@(?:[\p{L}\p{N}-]{1,63}\.){1,8}\p{L}{2,24}",
    r"(?:(?:AKIA|ASIA)[A-Z0-9]{16}|(?:akia|asia)(?=[a-z]*\d)[a-z0-9]{16})(?![A-Za-z0-9])",
    r"(?:sk-|ghp_|xox[abp]-)[A-Za-z0-9-]{16,64}(?![A-Za-z0-9])",
    r"(?=[A-Fa-f]*\d)[0-9A-Fa-f]{32,64}(?![A-Za-z0-9])",
    r"[A-Z]{2}\d{2}[A-Z0-9]{4}\d{7}[A-Z0-9]{0,16}(?![A-Za-z0-9])",
    r"[A-Z]{2}\d{2} [A-Z0-9]{4} \d{4} \d{3}[A-Z0-9](?: (?=[A-Z]*\d)[A-Z0-9]{4}){0,5}(?: (?=[A-Z]*\d)[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    r"\d{4}(?:[ -]?\d{4}){3}(?![A-Za-z0-9])",
    r"3[47]\d{2}[ -]?\d{6}[ -]?\d{5}(?![A-Za-z0-9])",
    r"\+1[ .-]?\(?\d{3}\)?[ .-]?\d{3}[ .-]?\d{4}(?!\d)",
    r"\+(?!1[ .(-])\d{2,3}[ .-]?\(?\d{1,4}\)?(?:[ .-]?\d{2,4}){2,3}(?!\d)",
    r"\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)",
    r"(?<![.-])\d{3}[.-]\d{3}[.-]\d{4}(?![0-9-])",
    r"(?<!-)\d{3}-\d{2}-\d{4}(?![0-9-])",
    rf"(?<!:)(?:{HEX4}:){{7}}{HEX4}(?![0-9A-Za-z:])",
    rf"(?<!:)(?=[0-9A-Fa-f:]*\d){HEX4}(?::{HEX4}){{0,6}}::(?:{HEX4}(?::{HEX4}){{0,5}})?(?![0-9A-Za-z:])",
    rf"(?<!\.)(?:{OCTET}\.){{3}}{OCTET}(?![A-Za-z0-9]|\.\d)",
    rf"{TITLED}{NAME_WORD}(?: {NAME_WORD})?",
)
ENTITY = rf"(?<![A-Za-z0-9])(?:{'|'.join(PATTERNS)})"
#: A text without these holds no entity; cheaper to find than the entities.
HINT = rf"[0-9@]|{TITLED}\p{{Lu}}|sk-|xox|ghp_|AKIA|ASIA"
#: What marks an entity in a text: END, one FILL more than stand together anywhere in the text, END.
END, FILL = "\uf8f1", "\uf8f2"

#: Surrogate names, plain fixed values of this package.
GIVEN = {
    "latin:m": "Adam Boris Carlo David Edgar Felix Georg Henri Ivan Jonas Karl Lukas Martin Noel Oscar Paul Rafael Simon Thomas Victor".split(),
    "latin:f": "Alma Berta Clara Diana Elena Flora Greta Helen Irene Julia Karin Laura Maria Nora Olga Paula Rosa Sara Teresa Vera".split(),
    "latin:n": "Alex Charlie Dominique Jamie Jordan Kim Luca Morgan Noa Robin Sacha Sam Taylor Toni Valery Yael".split(),
    "cyrillic:m": "Алексей Борис Виктор Григорий Денис Егор Иван Кирилл Максим Николай Олег Павел Роман Сергей Фёдор Юрий".split(),
    "cyrillic:f": "Алла Вера Галина Дарья Елена Жанна Зоя Ирина Клара Лидия Марина Нина Ольга Полина Раиса Софья".split(),
    "cyrillic:n": "Валя Женя Саша Паша Слава Шура Митя Тоня".split(),
}
FAMILY = {
    "latin": "Abel Berger Castel Dorn Elster Fabre Gallo Haller Imhof Jansen Keller Lambert Moreno Navarro Olsen Perrin Quist Rossi Santos Tanner Urban Vidal Weber Zeller".split(),
    "cyrillic": "Абрамов Белов Волков Громов Дёмин Ершов Жуков Зимин Ильин Котов Лосев Морозов Носов Орлов Попов Рыбин Седов Титов Ушаков Фомин".split(),
}
SYLLABLES = {"latin": "ba ce di fo gu la me ni po ru sa te vi zo na ro".split(), "cyrillic": "ба ве ди го лу ма не ри по са те ви зо на ру ко".split()}


def _names(text: Column) -> Column:
    """The names after a title, without it: ``John Smith`` or ``Smith``."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(rf"{TITLED}({NAME_WORD}(?: {NAME_WORD})?)"), F.lit(1)))


def _words(names: Column) -> Column:
    """Each name, and its words; the longest first."""
    every = F.array_distinct(F.flatten(F.transform(names, lambda n: F.concat(F.array(n), F.split(n, " ")))))
    return F.transform(F.sort_array(F.transform(every, lambda w: F.struct((-F.length(w)).alias("n"), w.alias("w")))), lambda s: s["w"])


def cut(text: Column) -> Column:
    """A struct of ``parts``, the text cut at its entities (these stand at 1, 3, ...), and ``families``, the surnames of
    its titled names; null if it has no entity.

    No part of a text has a run of FILL as long as in a mark, so the text is cut at the marks and nowhere else.
    """
    longest = F.when(F.contains(text, F.lit(FILL)), F.array_max(F.transform(F.split(text, f"[^{FILL}]"), F.length))).otherwise(0)

    def found(names: Column) -> Column:
        families = F.transform(names, lambda n: F.element_at(F.split(n, " "), -1))
        mark = F.concat(F.lit(END), F.repeat(F.lit(FILL), longest + 1), F.lit(END))

        def parts(m: Column) -> Column:
            new = F.concat(m, F.lit("$0"), m)
            own = F.concat(F.lit(ENTITY + r"|(?<![\p{L}\p{N}])(?:"), F.array_join(_words(names), "|"), F.lit(r")(?![\p{L}\p{N}])"))
            marked = F.when(F.size(names) == 0, F.regexp_replace(text, F.lit(ENTITY), new)).otherwise(F.regexp_replace(text, own, new))
            return F.split(marked, m, -1)

        return let(let(mark, parts), lambda p: F.when(F.size(p) > 1, F.struct(p.alias("parts"), families.alias("families"))))

    names = F.when(text.rlike(TITLED), _names(text)).otherwise(F.array().cast("array<string>"))
    return F.when(text.rlike(HINT), let(names, found))


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def kind_of(e: Column) -> Column:
    """The kind of one detected entity, by its form."""
    n = F.length(_digits(e))
    return (
        F.when(F.contains(e, F.lit("@")), "email")
        .when(e.rlike("^(?:AKIA|ASIA|akia|asia)[A-Za-z0-9]{16}$"), "aws")
        .when(e.rlike("^(?:sk-|ghp_|xox[abp]-)"), "key")
        .when(e.rlike("^[0-9A-Fa-f]{32,64}$"), "hex")
        .when(e.rlike(r"^[A-Z]{2}\d{2}"), "iban")
        .when(e.rlike(r"^\d[\d -]*$") & n.isin(15, 16), "card")
        .when(e.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn")
        .when(e.rlike(r"^[+(]|^\d{3}[.-]\d{3}[.-]\d{4}$"), "phone")
        .when(e.rlike("^[0-9A-Fa-f]{1,4}:"), "ipv6")
        .when(e.rlike(r"^[0-9.]+$"), "ip")
        .otherwise("name")
    )


def _full_ipv6(e: Column) -> Column:
    """All eight groups of four digits."""
    groups = lambda s: F.transform(F.filter(F.split(s, ":"), lambda g: g != ""), lambda g: F.lpad(F.lower(g), 4, "0"))
    short = F.contains(e, F.lit("::"))
    left, right = groups(F.when(short, F.substring_index(e, "::", 1)).otherwise(e)), groups(F.when(short, F.substring_index(e, "::", -1)).otherwise(F.lit("")))
    zeros = F.array_repeat(F.lit("0000"), F.greatest(8 - F.size(left) - F.size(right), F.lit(0)))
    return F.array_join(F.concat(left, zeros, right), ":")


def canonical(kind: Column, e: Column) -> Column:
    digits = _digits(e)
    phone = F.when(e.startswith("+1") & (F.length(digits) == 11), F.substring(digits, 2, 10)).when(e.startswith("+"), F.concat(F.lit("+"), digits)).otherwise(digits)
    return (
        F.when(kind.isin("card", "ssn"), digits)
        .when(kind == "phone", phone)
        .when(kind == "iban", F.regexp_replace(e, " ", ""))
        .when(kind == "ipv6", _full_ipv6(e))
        .when(kind.isin("key", "ip"), e)
        .otherwise(F.lower(e))
    )


def _piece(kind: Column, canon: Column, raw: Column, title: Column | None = None) -> Column:
    male, female = (F.coalesce(title.isin(*t), F.lit(False)) if title is not None else F.lit(False) for t in (MALE, FEMALE))
    return F.struct(kind.alias("kind"), canon.alias("canon"), raw.alias("raw"), male.alias("male"), female.alias("female"))


def pieces_of(e: Column, families: Column) -> Column:
    """A mention as pieces in order: what has a kind is replaced, the rest (titles, initials, spaces) is kept."""
    none = F.lit(None).cast("string")
    kept = lambda s: _piece(none, none, s)
    script = lambda s: F.when(s.rlike(r"\p{IsCyrillic}"), "cyrillic").otherwise("latin")

    def name(head: Column) -> Column:
        title = F.regexp_extract(head, rf"^({TITLES})", 1)

        def of(words: Column) -> Column:
            given = lambda w: _piece(F.concat(F.lit("given:"), script(w)), F.lower(w), w, title)
            family = lambda w: _piece(F.concat(F.lit("family:"), script(w)), F.lower(w), w)
            first = words[0]
            one = F.when((head != "") | F.array_contains(families, first), family(first)).otherwise(given(first))
            return F.when(F.size(words) > 1, F.array(kept(head), given(first), kept(F.lit(" ")), family(words[1]))).otherwise(F.array(kept(head), one))

        return let(F.split(F.substring(e, F.length(head) + 1, F.length(e)), " "), of)

    plain = let(kind_of(e), lambda k: F.array(_piece(k, canonical(k, e), e)))
    return F.when(kind_of(e) == "name", let(F.regexp_extract(e, rf"^(?:(?:{TITLES})\.? {INITIALS})?", 0), name)).otherwise(plain)


def _hmac(key: str, *message: Column) -> Column:
    """HMAC-SHA-512 in hex of the parts of a message."""
    k = key.encode()
    k = (k if len(k) <= 128 else hashlib.sha512(k).digest()).ljust(128, b"\0")
    inner, outer = (F.lit(bytes(x ^ pad for x in k)) for pad in (0x36, 0x5C))
    data = F.encode(F.concat_ws("\n", *message), "UTF-8")
    return F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, data), 512))), 512)


def _byte(h: Column, i: Column) -> Column:
    """Byte ``i`` (from 0, repeating after 64) of a hex digest."""
    return F.conv(F.substring(h, (i % 64) * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _number(h: Column, i: int) -> Column:
    return F.conv(F.substring(h, 8 * i + 1, 8), 16, 10).cast("bigint")


ALPHABETS = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
HEX = "0123456789abcdef"


def _alphabet(kind: Column, c: Column) -> Column:
    """What may stand for a character of a body; empty: itself."""
    digit, small, capital = (F.lit(a) for a in ALPHABETS)
    hexed = F.when(c.rlike("[0-9a-f]"), F.lit(HEX)).otherwise("")
    own = F.when(c.rlike("[0-9]"), digit).when(c.rlike("[a-z]"), small).when(c.rlike("[A-Z]"), capital).when(c.rlike(r"\p{L}"), small).otherwise("")
    return F.when(kind.isin("hex", "ip", "ipv6"), hexed).otherwise(own)


def _at(alphabet: Column, i: Column, c: Column) -> Column:
    return F.when(alphabet == "", c).otherwise(F.substring(alphabet, (i % F.greatest(F.length(alphabet), F.lit(1))).cast("int") + 1, F.lit(1)))


def _spelled(kind: Column, body: Column, n: Column) -> Column:
    """The ``n``-th string of the form of ``body``; past the last one, digits are appended. Different n, different strings."""

    def one(a: Column, c: Column) -> Column:
        def put(alphabet: Column) -> Column:
            radix = F.greatest(F.length(alphabet), F.lit(1)).cast("bigint")
            return F.struct(F.floor(a["n"] / radix).cast("bigint").alias("n"), F.concat(_at(alphabet, a["n"], c), a["s"]).alias("s"))

        return let(_alphabet(kind, c), put)

    start = F.struct(n.cast("bigint").alias("n"), F.lit("").alias("s"))
    more = lambda a: F.concat(a["s"], F.when(a["n"] > 0, a["n"].cast("string")).otherwise(""))
    return F.aggregate(F.reverse(F.split(body, "")), start, one, more)


def _luhn(digits: Column) -> Column:
    """Sum of the Luhn test of a digit string: a multiple of 10 if it holds."""

    def one(c: Column, i: Column) -> Column:
        d = c.cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when((F.length(digits) - i) % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.transform(F.split(digits, ""), one), F.lit(0), lambda a, x: a + x)


def _dotted(h: Column) -> Column:
    """Octets of a string of eight hex digits, and what stands after them."""
    octets = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.conv(F.substring(h, i * 2 + 1, F.lit(2)), 16, 10)), ".")
    return F.concat(octets, F.when(F.length(h) > 8, F.concat(F.lit("."), F.substring(h, F.lit(9), F.length(h)))).otherwise(""))


def formed(entities: DataFrame, key: str) -> DataFrame:
    """``entities`` (kind, canon, male, female) with their form: what stays (head, tail) and the body to be replaced."""
    kind, canon = F.col("kind"), F.col("canon")
    h = _hmac(key, F.lit("form"), kind, canon)
    rest = lambda n: F.substring(canon, F.lit(n + 1) if isinstance(n, int) else n + 1, F.length(canon))
    country = F.when(canon.startswith("+"), 3).otherwise(0)
    lead = (_byte(h, F.lit(0)) % 8 + 2).cast("string")
    prefix = F.regexp_instr(canon, F.lit("[-_]"))
    domain = let(_hmac(key, F.lit("domain"), F.substring_index(canon, "@", -1)), lambda d: F.concat(F.lit("@x"), F.substring(d, 1, 10), F.lit(".example."), F.get(F.array(*map(F.lit, ("com", "net", "org"))), (_number(d, 2) % 3).cast("int"))))
    valid = (kind == "card") & (_luhn(canon) % 10 == 0)
    script = F.substring_index(kind, ":", -1)
    gender = F.when(F.col("male") & ~F.col("female"), "m").when(F.col("female") & ~F.col("male"), "f").otherwise("n")
    parts = [
        ("email", F.lit(""), F.substring_index(canon, "@", 1), domain),
        ("card", F.substring(canon, 1, 1), F.when(valid, F.substring(canon, F.lit(2), F.length(canon) - 2)).otherwise(rest(1)), F.when(valid, "check").otherwise("")),
        ("phone", F.concat(F.substring(canon, F.lit(1), country), lead), rest(country + 1), F.lit("")),
        ("ssn", F.lit("9"), rest(1), F.lit("")),
        ("aws", F.substring(canon, 1, 4), rest(4), F.lit("")),
        ("key", F.substring(canon, F.lit(1), prefix), rest(prefix), F.lit("")),
        ("iban", F.substring(canon, 1, 2), rest(2), F.lit("")),
        ("hex", F.lit(""), canon, F.lit("")),
        ("ip", F.lit(""), F.lit("00000000"), F.lit("")),
        # the leading zeros of a group are no digits of its body
        ("ipv6", F.lit(""), F.array_join(F.transform(F.split(canon, ":"), lambda g: F.lpad(F.regexp_replace(g, "^0+", ""), 4, "o")), ":"), F.lit("")),
    ]
    out = [F.lit(None).cast("string")] * 3
    for name, *p in parts:
        out = [F.when(kind == name, x).otherwise(o) for o, x in zip(out, p, strict=True)]
    named = kind.rlike("^(?:given|family):")
    group = F.when(kind.startswith("given:"), F.concat(script, F.lit(":"), gender)).when(named, script)
    mask = F.regexp_replace(F.regexp_replace(F.regexp_replace(out[1], "[0-9]", "0"), "[a-z]", "a"), "[A-Z]", "A")
    hexed = F.regexp_replace(out[1], "[0-9a-f]", "0")
    form = F.when(named, group).otherwise(F.concat_ws("|", out[0], F.when(kind.isin("hex", "ip", "ipv6"), hexed).otherwise(mask), out[2]))
    return entities.select("kind", "canon", out[0].alias("head"), out[1].alias("body"), out[2].alias("tail"), group.alias("names"), form.alias("form"))


def _rendered(kind: Column, body: Column) -> Column:
    card = F.concat(F.col("head"), body)
    check = (10 - _luhn(F.concat(card, F.lit("0"))) % 10) % 10
    return (
        F.when(F.col("tail") == "check", F.concat(card, check.cast("string")))
        .when(kind == "ip", _dotted(body))
        .when(kind == "ipv6", F.regexp_replace(body, "o", "0"))
        .otherwise(F.concat(F.col("head"), body, F.col("tail")))
    )


def _name(pick, syllables) -> Column:
    """A name of the group; ``pick`` takes the size of its list, ``syllables`` a script."""
    out = F.lit(None).cast("string")
    for group, values in (*FAMILY.items(), *GIVEN.items()):
        first = F.get(F.array(*map(F.lit, values)), pick(len(values)).cast("int"))
        out = F.when(F.col("names") == group, F.lower(F.concat(first, syllables(SYLLABLES[group.split(":")[0]])))).otherwise(out)
    return out


def candidate(key: str) -> Column:
    """The ``attempt``-th candidate of a formed entity. A name grows by one syllable at each attempt."""
    kind, body, attempt = F.col("kind"), F.col("body"), F.col("attempt")

    def of(h: Column) -> Column:
        tail = lambda s: F.array_join(F.transform(F.slice(F.sequence(F.lit(0), attempt), F.lit(2), attempt), lambda i: F.get(F.array(*map(F.lit, s)), _byte(h, i + 16) % len(s))), "")
        spelled = F.array_join(F.transform(F.split(body, ""), lambda c, i: _at(_alphabet(kind, c), _byte(h, i), c)), "")
        return F.when(F.col("names").isNotNull(), _name(lambda n: _number(h, 0) % n, tail)).otherwise(_rendered(kind, spelled))

    return let(_hmac(key, kind, F.col("canon"), attempt.cast("string")), of)


def value_at(n: Column) -> Column:
    """The ``n``-th value of a form (kind, head, body, tail, names)."""

    def tail(size: int):
        def of(s: list[str]) -> Column:
            digits = F.conv(F.floor(n / size).cast("bigint").cast("string"), 10, len(s))
            return F.when(n < size, "").otherwise(F.array_join(F.transform(F.split(digits, ""), lambda c: F.get(F.array(*map(F.lit, s)), F.conv(c, 16, 10).cast("int"))), ""))

        return of

    out = F.lit(None).cast("string")
    for group, values in (*FAMILY.items(), *GIVEN.items()):
        first = F.get(F.array(*map(F.lit, values)), (n % len(values)).cast("int"))
        out = F.when(F.col("names") == group, F.lower(F.concat(first, tail(len(values))(SYLLABLES[group.split(":")[0]])))).otherwise(out)
    return F.when(F.col("names").isNotNull(), out).otherwise(let(_spelled(F.col("kind"), F.col("body"), n), lambda b: _rendered(F.col("kind"), b)))


FORM = ["kind", "form"]
GIVEN_ROW = ["kind", "canon", "new"]


def deal(todo: DataFrame, given: DataFrame, real: DataFrame, key: str, spare: int) -> DataFrame:
    """(kind, canon, new) for entities that the free ones among the first values of their form suffice for.

    Twice as many values are looked at as the form has entities to be served or served already, and ``spare`` more.
    """
    used = given.join(real.select("kind", "canon", "form"), ["kind", "canon"]).groupBy(*FORM).agg(F.count("*").alias("used"))
    one = [F.first(c).alias(c) for c in ("head", "tail", "names", "body")]
    forms = todo.groupBy(*FORM).agg(F.count("*").alias("todo"), *one).join(used, FORM, "left")
    forms = forms.withColumn("n", 2 * (F.col("todo") + F.coalesce("used", F.lit(0))) + spare)
    blocks = forms.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n") - 1) / SLOTS).cast("bigint"))).alias("block")).repartition(*FORM, "block")
    slots = blocks.select("*", F.explode(F.sequence(F.col("block") * SLOTS, F.least(F.col("n"), (F.col("block") + 1) * SLOTS) - 1)).alias("slot"))
    values = slots.withColumn("new", value_at(F.col("slot"))).groupBy("kind", "new").agg(F.min(F.struct("form", "slot", "block")).alias("v")).select("kind", "new", "v.*")
    taken = real.select("kind", F.col("canon").alias("new")).unionByName(given.select("kind", "new"))
    free = materialize(values.join(taken, ["kind", "new"], "left_anti"), "free")
    turn = _hmac(key, F.lit("turn"), F.col("kind"), F.col("canon"))
    asked = materialize(todo.select(*FORM, "canon", turn.alias("turn"), F.substring(turn, 1, 4).alias("block")), "asked")
    a = numbered(asked, FORM, "block", ["turn", "canon"], "rank").select(*FORM, "canon", "rank")
    b = numbered(free, FORM, "block", ["slot"], "rank").select(*FORM, "new", "rank")
    return materialize(a.join(b, [*FORM, "rank"]).select(*GIVEN_ROW), "given")


def assign(entities: DataFrame, key: str) -> DataFrame:
    """``entities`` (kind, canon, male, female), distinct -> (kind, canon, new): no two of a kind share ``new``, and none is an entity."""
    real = materialize(formed(entities, key), "entities")
    given = entities.sparkSession.createDataFrame([], "kind string, canon string, new string")
    todo, none = real, F.lit(None).cast("string")
    attempt = 0
    while not todo.isEmpty():
        if attempt < ROUNDS:
            tried = todo.withColumn("attempt", F.lit(attempt)).select("kind", "canon", candidate(key).alias("new"))
            # what is an entity or given already has no claimant: the smallest is null
            taken = real.select("kind", none.alias("canon"), F.col("canon").alias("new")).unionByName(given.select("kind", none.alias("canon"), "new"))
            claims = tried.unionByName(taken).groupBy("kind", "new").agg(F.min("canon").alias("canon"), F.bool_or(F.col("canon").isNull()).alias("taken"))
            won = materialize(claims.filter("NOT taken").select(*GIVEN_ROW), "given")
        else:
            won = deal(todo, given, real, key, 64 << 2 * (attempt - ROUNDS))
        given = given.unionByName(won)
        todo = materialize(todo.join(won, ["kind", "canon"], "left_anti"), "refused")
        attempt += 1
    return given


def dressed(kind: Column, raw: Column, new: Column) -> Column:
    """A surrogate in the mention's own format: its separators for numbers, its groups, its case for the rest."""

    def place(characters: Column) -> Column:
        """Characters instead of the alphanumeric ones of the mention, and those it has no place for at the end."""
        before = lambda i: F.length(F.regexp_replace(F.substring(raw, F.lit(1), i), "[^0-9A-Za-z]", ""))
        own = F.array_join(F.transform(F.split(raw, ""), lambda c, i: F.when(c.rlike("[0-9A-Za-z]"), F.substring(characters, before(i) + 1, F.lit(1))).otherwise(c)), "")
        return F.concat(own, F.substring(characters, F.length(F.regexp_replace(raw, "[^0-9A-Za-z]", "")) + 1, F.length(characters)))

    def groups(full: Column) -> Column:
        """The groups of a full IPv6 address that the mention shows, each as long as there."""
        tokens = F.split(raw, ":")
        left = F.size(F.split(F.substring_index(raw, "::", 1), ":"))
        short = F.contains(raw, F.lit("::"))
        which = lambda i: F.when(short & (i >= left), 8 - F.size(tokens) + i).otherwise(i)
        shown = F.transform(tokens, lambda t, i: F.when(t == "", "").otherwise(F.right(F.get(full, which(i).cast("int")), F.length(t))))
        return F.when(F.size(full) == 8, F.array_join(shown, ":")).otherwise(new)

    upper = raw == F.upper(raw)
    country = F.when(raw.startswith("+1") & ~new.startswith("+"), F.concat(F.lit("1"), new)).otherwise(new)
    return (
        F.when(kind.isin("card", "phone", "ssn"), let(_digits(country), place))
        .when(kind == "iban", let(new, place))
        .when(kind == "ipv6", let(F.split(F.when(raw.rlike("[A-F]") & upper, F.upper(new)).otherwise(new), ":"), groups))
        .when(kind.isin("key", "ip"), new)
        .when(upper, F.upper(new))
        .when(kind.rlike("^(?:given|family):"), F.initcap(new))
        .otherwise(new)
    )


def pseudonymize(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with its text replaced, plus the number of mentions replaced (``n_entities``)."""
    found, row, count, new = (fresh(docs.columns, n) for n in ("found", "row", "n_entities", "new"))
    cuts = docs.withColumn(found, cut(F.col(text))).withColumn(text, F.when(F.col(found).isNull(), F.col(text)))
    stored = materialize(cuts.withColumn(row, F.monotonically_increasing_id()), "cut")
    marked = stored.filter(F.col(found).isNotNull())
    mentions = marked.select(F.col(row).alias("row"), F.col(found)["families"].alias("families"), F.posexplode(F.col(found)["parts"]).alias("m", "mention")).filter("m % 2 = 1")
    parts = mentions.select("row", "m", F.posexplode(pieces_of(F.col("mention"), F.col("families"))).alias("p", "piece")).select("row", "m", "p", "piece.*")
    parts = materialize(parts, "mentions")
    entities = parts.filter("kind IS NOT NULL").groupBy("kind", "canon").agg(F.bool_or("male").alias("male"), F.bool_or("female").alias("female"))
    table = assign(entities, key)
    named = parts.join(table, ["kind", "canon"], "left").select("row", "m", "p", F.coalesce(dressed(F.col("kind"), F.col("raw"), F.col("new")), F.col("raw")).alias("s"))
    # a document's mentions are gathered with it, as its text is; both aggregations use one shuffle
    ordered = lambda *c: F.sort_array(F.collect_list(F.struct(*c)))
    by_mention = named.repartition("row").groupBy("row", "m").agg(F.array_join(F.transform(ordered("p", "s"), lambda x: x["s"]), "").alias("s"))
    per_doc = by_mention.groupBy("row").agg(F.transform(ordered("m", "s"), lambda x: x["s"]).alias(new)).withColumnRenamed("row", row)
    gaps = F.filter(F.col(found)["parts"], lambda _, i: i % 2 == 0)
    rebuilt = F.array_join(F.zip_with(gaps, F.col(new), lambda g, n: F.concat(g, F.coalesce(n, F.lit("")))), "")
    done = marked.join(per_doc, row).withColumn(text, rebuilt).withColumn(count, F.size(new).cast("bigint"))
    plain = stored.filter(F.col(found).isNull()).withColumn(count, F.lit(0).cast("bigint"))
    return plain.select(*docs.columns, count).unionByName(done.select(*docs.columns, count))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key is the session's; ``DEMO_KEY`` stands in where none is set, as in tests."""
    from lensmill.llm.common import table

    return pseudonymize(table(spark, sf_dir, "documents").select("doc_id", "text"), spark.conf.get(KEY_SETTING, DEMO_KEY))
