"""Personal data replaced by keyed surrogates of the same type and format.

An entity's surrogate depends on the caller's key, its type and its own value in normal
form (a phone, card or account number without separators, mail addresses and names in
lower case), so the same entity has the same surrogate in every document, however it is
written, and mapping needs no lookup. A check over the distinct entities finds surrogates
that two entities share, or that are themselves an entity of the corpus; all but one of them
draw again, until every surrogate is distinct: given names among given names, whatever their
gender, family names among family names, all other values across types. Only these few
are looked up when texts are rewritten.

Kept: letters stay letters of their case, digits digits, hexadecimal stays
hexadecimal, separators and lengths stay (an address's octets may differ in length);
a card keeps its first digit and its valid check digit, a phone number its country
code, an access key its prefix, a mail address the reserved domain. A person after a
title keeps the title; the given name gets one of the same gender and script. After a
title of either gender it gets that which the name has after another title, if there is one.
Family and given names are replaced one by one, so "Mr. A B" and "Mr. B" stay related. Digits
are a card only if their check digit holds, and a secret has a digit; such a number or
word stays. Not found: names without one of the titles below, which no pattern tells from
other words, and secrets that nothing beside them names.

Defined results: a null text stays null, an empty one empty; texts without entities
are returned as they are; repeated rows are rewritten alike; columns other than the text are
never read. No pattern repeats a group without bound, so texts of any length and content are safe. An empty table gives an empty result. The table is read more than once
and must give the same rows in the same order then, as a stored table does.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accountwatch.llm.text import unused, whole

# Titles by gender and script, and the names that replace others.
TITLES = {
    ("m", "latin"): ("Mr", "Herr", "Monsieur", "Señor", "Sir"),
    ("f", "latin"): ("Mrs", "Ms", "Miss", "Frau", "Madame", "Señora", "Lady"),
    ("m", "cyrillic"): ("Господин", "Г-н"),
    ("f", "cyrillic"): ("Госпожа", "Г-жа"),
    ("n", "latin"): ("Dr", "Prof"),
}
GIVEN = {
    ("m", "latin"): "Adam Bruno Carl David Erik Felix Georg Hugo Ivan Jonas Karl Leo Max Nils Oscar Paul".split(),
    ("f", "latin"): "Ada Berta Clara Dora Emma Frida Greta Hanna Ida Julia Klara Lina Maria Nora Olga Paula".split(),
    ("m", "cyrillic"): "Антон Борис Виктор Глеб Денис Егор Иван Кирилл".split(),
    ("f", "cyrillic"): "Анна Вера Галина Дарья Елена Ирина Лидия Мария".split(),
}
# A title of either gender.
GIVEN["n", "latin"] = GIVEN["m", "latin"] + GIVEN["f", "latin"]
SYLLABLES = {
    "latin": "ba be bo da de do fa fe ga go ha he ka ke la le lo ma me mo na ne no pa pe ra re ro sa se ta te".split(),
    "cyrillic": "ба бе бо да де до га го ка ке ла ле ло ма ме мо на не но па пе ра ре ро са се та те ва ве зо ми ни".split(),
}
_NAME = r"\p{Lu}[\p{L}'’\-]*+"
#: Titles as listed and in capitals.
_TITLES = {kind: tuple(dict.fromkeys(t for title in group for t in (title, title.upper()))) for kind, group in TITLES.items()}
_ALL_TITLES = "|".join(t for group in _TITLES.values() for t in group)
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_IP = rf"(?:{_OCTET}\.){{3}}{_OCTET}"
_HEX = r"[0-9A-Fa-f]{1,4}"
# Eight groups, or fewer around one "::".
_IP6 = rf"(?:(?:{_HEX}:){{7}}{_HEX}|(?:{_HEX}:){{1,7}}:(?:{_HEX}(?::{_HEX}){{0,5}})?|::(?:{_HEX}:){{1,6}}{_HEX})"
# In one piece, or in groups of four of which the last has a digit.
_IBAN = r"[A-Z]{2}\d{2}(?:[A-Z0-9]{11,30}+|(?:[ \-][A-Z0-9]{4}){2,7}(?:[ \-][A-Z0-9]{1,3})?(?<=\d[A-Z]{0,3}))"
_SSN = r"\d{3}-\d{2}-\d{4}"
_CARD = r"(?:\d{4}[ \-]\d{4}[ \-]\d{4}[ \-]\d{4}|\d{4}[ \-]\d{6}[ \-]\d{4,5}|\d{13,19}+)"
_LOCAL_PHONE = r"\(\d{3}\) ?\d{3}[.\-]\d{4}|\d{3}[.\-]\d{3}[.\-]\d{4}"
# A phone number ends where its next group begins another entity.
_GROUP = rf"(?! (?:{_IP}|{_SSN}|{_CARD}|{_LOCAL_PHONE})(?!\d))[ .\-]?\d{{2,4}}"

_SECRET = r"(?=[A-Za-z_+/\-]*\d)[0-9A-Za-z_+/\-]{8,}+"

#: Type and pattern, the first that fits wins. Patterns start at a token's edge and do not backtrack over words.
PATTERNS = {
    # No name has more labels, or longer ones.
    "email": r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]++@(?:[A-Za-z0-9\-]{1,63}\.){1,126}[A-Za-z]{2,63}",
    "secret": rf"(?<=(?i:password|passwd|token|secret|api_key|apikey)[\"']?[ ]{{0,2}}[=:][ ]{{0,2}}[\"']?){_SECRET}"
    rf"|(?<=(?i:password|passwd) is ){_SECRET}|(?<=(?i:bearer) )(?=[A-Za-z_+/.~\-]*\d)[0-9A-Za-z_+/.~\-]{{16,}}+"
    r"|(?<=PRIVATE KEY-----)[A-Za-z0-9+/=\s]{16,}+",
    "access_key": r"(?<![0-9A-Za-z_])(?:AKIA|ASIA|ghp_|sk-)[0-9A-Za-z]{16,}+(?![0-9A-Za-z_])",
    "iban": rf"(?<![0-9A-Za-z]){_IBAN}(?![0-9A-Za-z])",
    "ip": rf"(?<![\w.]){_IP}(?!\w|\.\d)",
    "ip6": rf"(?<![\w:.])(?=[A-Fa-f:]*\d){_IP6}(?![\w:]|\.\d)",
    "phone": rf"(?<![\w+])(?:\+\d{{1,3}}[ .\-]?(?:\(\d{{1,4}}\)|\d{{1,4}})[ .\-]?\d{{2,4}}(?:{_GROUP}){{0,3}}|{_LOCAL_PHONE})(?!\w)",
    "ssn": rf"(?<![\w\-]){_SSN}(?![\w\-])",
    "card": rf"(?<![\w.\-]){_CARD}(?![\w\-])",
    "person": rf"(?<![\p{{L}}\p{{N}}])(?:{_ALL_TITLES})\.? {_NAME}(?: {_NAME})?",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
MOST_ROUNDS = 64


@dataclass(frozen=True)
class Key:
    """What surrogates are drawn with; who has it can draw them again."""

    secret: str

    def __post_init__(self) -> None:
        if not self.secret:
            raise ValueError("surrogates need a key")


def _bound(body: Callable[[Column], Column], **values: Column) -> Column:
    """``body`` of a struct of values that are computed once, however often it uses them."""
    return F.element_at(F.transform(F.array(F.struct(*[v.alias(k) for k, v in values.items()])), body), 1)


def found(text: Column) -> Column:
    """The matches of a text in order: ``kind`` and ``match`` as written. Digits in the shape of a card that are none have no kind."""
    none = F.array().cast("array<struct<kind:string,match:string>>")
    # Every entity has a digit, an at sign, a title or a secret's sign; most texts end here.
    likely = whole(text).rlike(r"[0-9@=:]")
    for titles in _TITLES.values():
        for title in titles:
            likely = likely | whole(text).contains(f"{title} ") | whole(text).contains(f"{title}. ")
    return F.when(likely | whole(text).contains("sk-") | whole(text).contains("ghp_"), F.transform(F.regexp_extract_all(whole(text), F.lit(ANY), F.lit(0)), _with_kind)).otherwise(none)


def _with_kind(match: Column) -> Column:
    def checked(s: Column) -> Column:
        none = (s["kind"] == "card") & (_check_sum(s["match"]) % 10 != 0)
        return F.struct(F.when(~none, s["kind"]).alias("kind"), s["match"].alias("match"))

    return _bound(checked, kind=kind_of(match), match=match)


def kind_of(entity: Column) -> Column:
    """The type of a match, by its own shape: what stands around it is gone here."""
    shapes = [
        ("email", entity.contains("@")),
        ("person", entity.rlike(rf"^(?:{_ALL_TITLES})\.? ")),
        ("access_key", entity.rlike(r"^(?:AKIA|ASIA|ghp_|sk-)[0-9A-Za-z]{16,}$")),
        ("iban", entity.rlike(rf"^{_IBAN}$")),
        ("ip", entity.rlike(rf"^{_IP}$")),
        ("ip6", entity.rlike(rf"^{_IP6}$")),
        ("ssn", entity.rlike(rf"^{_SSN}$")),
        ("card", entity.rlike(rf"^{_CARD}$")),
        ("phone", entity.rlike(r"^[+(\d][\d ().\-]+$") & entity.rlike(r"[ ().+\-]")),
    ]
    out = F.lit("secret")
    for name, test in reversed(shapes):
        out = F.when(test, F.lit(name)).otherwise(out)
    return out


def _normal(kind: Column, value: Column) -> Column:
    """What an entity is whichever way it is written."""
    return (
        F.when(kind.isin("email", "ip6") | kind.startswith("given ") | kind.startswith("family "), F.lower(value))
        .when(kind.isin("phone", "card"), F.regexp_replace(value, r"[^+0-9]", ""))
        .when(kind == "iban", F.regexp_replace(value, r"[ \-]", ""))
        .otherwise(value)
    )


def is_entity(hit: Column) -> Column:
    return hit["kind"].isNotNull()


def parts(hit: Column) -> Column:
    """What gets a surrogate of its own: an entity as a whole, of a person each name. ``value`` is the normal form of ``shown``.

    A name carries the gender and script of its title if it is a given name.
    """

    def part(kind: Column, shown: Column) -> Column:
        return F.struct(kind.alias("kind"), _normal(kind, shown).alias("value"), shown.alias("shown"))

    def names(s: Column) -> Column:
        pieces = s["pieces"]
        given, family = F.concat(F.lit("given "), s["sort"]), F.concat(F.lit("family "), F.split(s["sort"], " ")[1])
        last = _bound(lambda n: part(n["kind"], n["shown"]), kind=family, shown=F.element_at(pieces, -1))
        first = _bound(lambda n: part(n["kind"], n["shown"]), kind=given, shown=F.get(pieces, F.lit(1)))
        return F.when(F.size(pieces) >= 3, F.array(first, last)).otherwise(F.array(last))

    title = F.regexp_replace(F.split(hit["match"], " ")[0], r"\.$", "")
    sort = F.lit("m latin")
    for (gender, script), titles in _TITLES.items():
        sort = F.when(title.isin(*titles), F.lit(f"{gender} {script}")).otherwise(sort)
    person = _bound(names, pieces=F.split(hit["match"], " "), sort=sort)
    return F.when(hit["kind"] == "person", person).otherwise(F.array(part(hit["kind"], hit["match"])))


def _shown(s: Column) -> Column:
    """A surrogate ``new`` in normal form as the entity ``shown`` was written: its separators, its capitals."""
    kind, shown, new = s["kind"], s["shown"], s["new"]

    def placed(c: Column, i: Column) -> Column:
        at = F.length(F.regexp_replace(F.substring(shown, F.lit(1), i + 1), r"[^+0-9A-Za-z]", ""))
        return F.when(c.rlike(r"[+0-9A-Za-z]"), F.substring(new, at, F.lit(1))).otherwise(c)

    # A local part keeps its length, the domain need not.
    at = F.instr(shown, "@")

    def cased(c: Column, i: Column) -> Column:
        own = F.substring(new, i + 1, F.lit(1))
        return F.when((i + 1 < at) & c.rlike("[A-Z]"), F.upper(own)).otherwise(own)

    characters = F.filter(F.split(shown, ""), lambda c: c != "")
    capitals = (F.length(shown) > 1) & (shown == F.upper(shown))
    return (
        F.when(kind.isin("phone", "card", "iban"), F.array_join(F.transform(characters, placed), ""))
        .when(
            (kind == "email") & shown.rlike("[A-Z].*@"),
            F.concat(F.array_join(F.transform(F.slice(characters, 1, at), cased), ""), F.substring(new, at + 1, F.length(new))),
        )
        .when((kind == "ip6") & (shown != F.lower(shown)), F.upper(new))
        .when((kind.startswith("given ") | kind.startswith("family ")) & capitals, F.upper(new))
        .otherwise(new)
    )


def _draw(digest: Column, at: Column, below: int) -> Column:
    """A number below ``below`` from two bytes of a hexadecimal digest, in a cycle of 32 places."""
    return (F.conv(F.substring(digest, (at % 32) * 4 + 1, F.lit(4)), 16, 10).cast("int") % below).cast("int")


def _pick(alphabet: str, at: Column) -> Column:
    return F.substring(F.lit(alphabet), at + 1, F.lit(1))


def _same_format(value: Column, digest: Column, fixed: Column, lead: bool = False, hexadecimal: Column | None = None) -> Column:
    """Each character drawn from its own class; the first ``fixed`` stay. ``lead``: no digit 0 or 1 begins a group of three."""
    hexadecimal = F.lit(False) if hexadecimal is None else hexadecimal

    def drawn(c: Column, i: Column) -> Column:
        digit = _pick("0123456789", _draw(digest, i, 10))
        if lead:
            digit = F.when((i - fixed) % 3 != 0, digit).otherwise(_pick("23456789", _draw(digest, i, 8)))
        lower, upper = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
        return (
            F.when(i < fixed, c)
            .when(c.rlike(r"\d"), digit)
            .when(c.rlike("[a-f]") & hexadecimal, _pick("abcdef", _draw(digest, i, 6)))
            .when(c.rlike("[A-F]") & hexadecimal, _pick("ABCDEF", _draw(digest, i, 6)))
            .when(c.rlike("[a-z]"), _pick(lower, _draw(digest, i, 26)))
            .when(c.rlike("[A-Z]"), _pick(upper, _draw(digest, i, 26)))
            .otherwise(c)
        )

    characters = F.filter(F.split(value, ""), lambda c: c != "")
    return F.array_join(F.transform(characters, drawn), "")


def _check_sum(digits: Column) -> Column:
    """The card check sum: from the right, every second digit doubled, its own digits added."""
    cells = F.filter(F.split(F.reverse(digits), ""), lambda c: c.rlike(r"\d"))

    def weight(c: Column, i: Column) -> Column:
        d = c.cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.transform(cells, weight), F.lit(0), lambda a, b: a + b)


def _card(value: Column, digest: Column) -> Column:
    """All but the last digit drawn anew, and the check digit that fits them."""
    new = F.substring(_same_format(value, digest, F.lit(1)), F.lit(1), F.length(value) - 1)

    def checked(s: Column) -> Column:
        last = (10 - _check_sum(F.concat(s["kept"], F.lit("0"))) % 10) % 10
        return F.concat(s["kept"], last.cast("string"))

    return _bound(checked, kept=new)


def _email(value: Column, digest: Column) -> Column:
    local, domain = F.split(value, "@")[0], F.lower(F.split(value, "@")[1])
    host = F.regexp_replace(domain, r"\.[a-z]+$", "")
    tld = F.regexp_extract(domain, r"[a-z]+$", 0)
    reserved = domain.rlike(r"(?:^|\.)example\.(?:com|org|net)$")
    # Some other domain becomes one of the same top level below a reserved name.
    elsewhere = F.concat(_same_format(host, F.reverse(digest), F.lit(0)), F.lit(".example."), tld)
    return F.concat(_same_format(local, digest, F.lit(0)), F.lit("@"), F.when(reserved, domain).otherwise(elsewhere))


def _ip(digest: Column) -> Column:
    return F.concat_ws(".", *[(_draw(digest, F.lit(k), 223 if k == 0 else 254) + 1).cast("string") for k in range(4)])


def _name(kind: Column, attempt: Column, digest: Column) -> Column:
    """A given name of the kind's pool, with a second part from the second draw on; a family name of three syllables and more."""
    out = F.lit(None).cast("string")
    for script, syllables in SYLLABLES.items():
        pool = F.array(*[F.lit(s) for s in syllables])
        places = F.sequence(F.lit(0), F.least(attempt, F.lit(20)) + 2)
        made = F.initcap(F.array_join(F.transform(places, lambda i: F.get(pool, _draw(digest, i, len(syllables)))), ""))
        out = F.when(kind == f"family {script}", made).otherwise(out)
        for gender in "mfn":
            if (gender, script) not in GIVEN:
                continue
            given = F.array(*[F.lit(g) for g in GIVEN[gender, script]])
            first = F.get(given, _draw(digest, F.lit(31), len(GIVEN[gender, script])))
            second = F.when(attempt > 0, F.concat(F.lit("-"), made)).otherwise(F.lit(""))
            out = F.when(kind == f"given {gender} {script}", F.concat(first, second)).otherwise(out)
    return out


def surrogate(kind: Column, value: Column, attempt: Column, key: Key) -> Column:
    """The replacement of an entity's part on its ``attempt``-th draw, from 0."""
    digest = F.sha2(F.concat_ws("\x1f", F.lit(key.secret), kind, value, attempt.cast("string")).cast("binary"), 512)
    hexadecimal = value.rlike(r"^(?:[0-9a-f]+|[0-9A-F]+)$")
    return _bound(_drawn, kind=kind, value=value, attempt=attempt, digest=digest, hexadecimal=hexadecimal)


def _drawn(s: Column) -> Column:
    kind, value, digest = s["kind"], s["value"], s["digest"]
    # Country codes that begin with 1 or 7 have one digit; of the others two are kept.
    country = F.when(value.rlike(r"^\+[17]"), 2).when(value.startswith("+"), 3).otherwise(0)
    prefix = F.length(F.regexp_extract(value, r"^(?:AKIA|ASIA|ghp_|sk-)", 0))
    return (
        F.when(kind == "email", _email(value, digest))
        .when(kind == "ip", _ip(digest))
        .when(kind == "ip6", _same_format(value, digest, F.lit(0), hexadecimal=F.lit(True)))
        .when(kind == "card", _card(value, digest))
        .when(kind == "phone", _same_format(value, digest, country, lead=True))
        .when(kind == "access_key", _same_format(value, digest, prefix, hexadecimal=s["hexadecimal"]))
        .when(kind == "iban", _same_format(value, digest, F.lit(2)))
        .when(kind.isin("ssn", "secret"), _same_format(value, digest, F.lit(0), hexadecimal=s["hexadecimal"]))
        .otherwise(_name(kind, s["attempt"], digest))
    )


def surrogate_table(docs: DataFrame, key: Key, text: str = "text") -> DataFrame:
    """kind, value, ``attempt`` and ``surrogate`` of every distinct part, in normal form; all surrogates of a space distinct.

    Distinct values only leave a map task once. A given name after a title of either gender
    is the one that stands after another title, if there is one; then its row repeats that one's.
    """
    matches = F.filter(found(F.col(text)), is_entity)
    values = docs.select(F.explode(F.flatten(F.transform(matches, parts))).alias("p")).select("p.kind", "p.value").distinct().checkpoint()
    gendered = values.where(F.col("kind").rlike("^given [mf] ")).groupBy("value", F.split("kind", " ")[2].alias("_script"))
    twins = gendered.agg(F.min("kind").alias("_twin"))
    either = values.where("kind like 'given n %'").withColumn("_script", F.split("kind", " ")[2])
    same = either.join(twins, ["value", "_script"]).select("kind", "value", "_twin").checkpoint()
    own = values.join(same.select("kind", "value"), ["kind", "value"], "left_anti")
    settled = _distinct_surrogates(own, values, key)
    repeated = settled.select(F.col("kind").alias("_twin"), "value", "attempt", "surrogate")
    repeated = same.join(repeated, ["_twin", "value"]).select("kind", "value", F.greatest("attempt", F.lit(1)).alias("attempt"), "surrogate")
    return settled.unionByName(repeated)


def _space() -> Column:
    """Among what surrogates must differ."""
    return F.when(F.col("kind").startswith("given "), "given").when(F.col("kind").startswith("family "), "family").otherwise("value")


def _distinct_surrogates(own: DataFrame, values: DataFrame, key: Key) -> DataFrame:
    table = own.withColumn("attempt", F.lit(0)).withColumn("surrogate", surrogate(F.col("kind"), F.col("value"), F.col("attempt"), key))
    originals = values.select(_space().alias("_space"), F.col("value").alias("_normal")).distinct().withColumn("_taken", F.lit(True))
    for _ in range(MOST_ROUNDS):
        table = table.checkpoint()
        # The longest settled keeps a shared surrogate; at most two rows of one matter, so groups stay small.
        first = Window.partitionBy("_space", "_normal").orderBy("attempt", "kind", "value")
        judged = (
            table.withColumns({"_space": _space(), "_normal": _normal(F.col("kind"), F.col("surrogate"))})
            .withColumn("_rank", F.row_number().over(first))
            .join(originals, ["_space", "_normal"], "left")
            .withColumn("_again", (F.col("_rank") > 1) | F.col("_taken").isNotNull())
        )
        if judged.where("_again").isEmpty():
            return table
        drawn = F.col("attempt") + F.col("_again").cast("int")
        table = judged.select("kind", "value", drawn.alias("attempt"), "_again", F.col("surrogate").alias("_old")).select(
            "kind",
            "value",
            "attempt",
            F.when(F.col("_again"), surrogate(F.col("kind"), F.col("value"), F.col("attempt"), key)).otherwise(F.col("_old")).alias("surrogate"),
        )
    raise ValueError(f"surrogates still collide after {MOST_ROUNDS} draws")


def _rewritten(text: Column, matches: Column, others: Column | None, key: Key) -> Column:
    """The text with every match replaced: the pieces between matches, and the new matches."""

    def part(p: Column) -> Column:
        new = surrogate(p["kind"], p["value"], F.lit(0), key)
        if others is not None:
            new = F.coalesce(F.try_element_at(others, F.concat_ws("\x1f", p["kind"], p["value"])), new)
        return _bound(_shown, kind=p["kind"], shown=p["shown"], new=new)

    def renamed(m: Column) -> Column:
        new = F.array_join(F.transform(parts(m), part), " ")
        title = F.when(m["kind"] == "person", F.concat(F.split(m["match"], " ")[0], F.lit(" "))).otherwise("")
        return F.when(is_entity(m), F.concat(title, new)).otherwise(m["match"])

    pieces = F.split(text, ANY, -1)
    filled = F.concat(F.transform(matches, renamed), F.array(F.lit("")))
    return F.when(F.size(matches) == 0, text).otherwise(F.array_join(F.zip_with(pieces, filled, lambda a, b: F.concat(a, b)), ""))


def replace_entities(docs: DataFrame, key: Key, text: str = "text", counted: str | None = None) -> DataFrame:
    """``docs`` with surrogates in the text, and with the number of entities as ``counted`` if that is named.

    Rows are joined only if some surrogate was drawn again.
    """
    redrawn = surrogate_table(docs, key, text).where("attempt > 0")
    row, held, hits = (unused(docs, n) for n in ("row_number", "redrawn_names", "entities_found"))
    rows = docs.withColumn(hits, found(F.col(text)))
    out = [F.col(c) for c in docs.columns]
    if counted is not None:
        out.append(F.size(F.filter(F.col(hits), is_entity)).cast("bigint").alias(counted))
    if redrawn.isEmpty():
        return rows.withColumn(text, _rewritten(F.col(text), F.col(hits), None, key)).select(*out)
    rows = rows.withColumn(row, F.monotonically_increasing_id())
    names = redrawn.select(F.concat_ws("\x1f", "kind", "value").alias("name"), "surrogate")
    uses = rows.select(row, F.explode(F.array_distinct(F.flatten(F.transform(F.filter(hits, is_entity), parts)))).alias("p"))
    per_row = (
        uses.select(row, F.concat_ws("\x1f", "p.kind", "p.value").alias("name"))
        .distinct()
        .join(names, "name")
        .groupBy(row)
        .agg(F.map_from_entries(F.collect_list(F.struct("name", "surrogate"))).alias(held))
    )
    return rows.join(per_row, row, "left").withColumn(text, _rewritten(F.col(text), F.col(hits), F.col(held), key)).select(*out)
