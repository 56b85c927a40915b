"""Personal data replaced by keyed surrogates of the same type and form.

Everything here is DataFrame functions; no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.functions.columns import free_name
from tripmart.llm.common import release, stored

MARK, ESCAPE = "\x01", "\x02"
WIDER = 8  # attempts after which a surrogate may leave the original's exact form

# fixed values: forms of address before a name
MALE = ("Mr", "Sir", "Herr", "Monsieur", "Señor", "Signor", "Господин", "Κύριος")
FEMALE = ("Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Señora", "Signora", "Госпожа", "Κυρία")

_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_TITLES = "|".join(sorted((*MALE, *FEMALE), key=lambda t: (-len(t), t)))
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9])",
    "card": r"(?<![0-9A-Za-z])(?:[0-9]{16}|(?:[0-9]{4} ){3}[0-9]{4}|(?:[0-9]{4}-){3}[0-9]{4})(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z])",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "ip": rf"(?<![0-9A-Za-z.]){_OCTET}(?:\.{_OCTET}){{3}}(?![0-9A-Za-z]|\.[0-9])",
    "name": rf"(?<!\p{{L}})(?:{_TITLES})\.? \p{{Lu}}[\p{{L}}'-]+(?: \p{{Lu}}[\p{{L}}'-]+)?",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())

# parts of made-up names in lower case, by script
_SYLLABLES = {
    "latin": "ba be bo da de do fa fe ga ka ke la le lo ma me mi na ne no ra re ri ro sa se ta te to va ve vi".split(),
    "cyrillic": "ба бе да де ка ке ла ле ло ма ме ми на не но ра ре ри ро са се та те то ва ве ви".split(),
    "greek": "βα βε δα δε κα κε λα λε λο μα με μι να νε νο ρα ρε ρι ρο σα σε τα τε το".split(),
}
_ENDINGS = {
    "latin": {"m": "n r k rd nd l".split(), "f": "na lia ra nia tta lla".split(), "family": "ner son man ling well ham".split()},
    "cyrillic": {"m": "н р к м л в".split(), "f": "на лия ра ния та ла".split(), "family": "нов ров кин лин мов вин".split()},
    "greek": {"m": "νης ρης κος λος μος τος".split(), "f": "να ρα λια νια τα λη".split(), "family": "ιδης ακης ογλου ατος ινος εας".split()},
}


def _matches(value: Column, kind: str) -> Column:
    return value.rlike(f"^(?:{PATTERNS[kind]})$")


def kind_of(raw: Column) -> Column:
    """The first kind, in the order of ``PATTERNS``, whose form the whole string has."""
    return F.coalesce(*[F.when(_matches(raw, k), F.lit(k)) for k in PATTERNS])


def canonical_of(kind: Column, raw: Column) -> Column:
    """What two mentions of one entity share: digits of a number, the lower-case rest.

    A phone number is the same with and without the country code 1.
    """
    digits = F.regexp_replace(raw, "[^0-9]", "")
    national = F.regexp_replace(digits, "^1(?=[0-9]{10}$)", "")
    return F.when(kind == "phone", national).when(kind.isin("card", "ssn"), digits).when(kind == "ip", raw).otherwise(F.lower(raw))


def _digest(key: str, *parts: Column) -> Column:
    base = F.concat_ws("|", F.lit(key), *parts)
    return F.concat(F.sha2(F.concat(base, F.lit("|0")), 256), F.sha2(F.concat(base, F.lit("|1")), 256))


def _number(digest: Column, i: Column | int) -> Column:
    """The i-th number below 65,536 of a digest; after 64 they repeat."""
    at = (F.lit(i) if isinstance(i, int) else i) % 32 * 4 + 1
    return F.conv(F.substr(digest, at.cast("int"), F.lit(4)), 16, 10).cast("int")


def _characters(value: Column, change) -> Column:
    """The string with each character replaced by ``change(character, place from 0)``."""
    places = F.sequence(F.lit(1), F.greatest(F.length(value), F.lit(1)))
    return F.array_join(
        F.transform(places, lambda p: change(F.substr(value, p, F.lit(1)), p - 1)), ""
    )


def _pick(choices: str, number: Column) -> Column:
    return F.substr(F.lit(choices), (number % len(choices) + 1).cast("int"), F.lit(1))


def _of_list(items: list[str], number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in items]), (number % len(items) + 1).cast("int"))


def _shaped(value: Column, digest: Column) -> Column:
    """Letters for letters and digits for digits; everything else stays."""
    return _characters(
        value,
        lambda c, i: F.when(c.rlike("[a-z]"), _pick("abcdefghijklmnopqrstuvwxyz", _number(digest, i)))
        .when(c.rlike("[0-9]"), _pick("0123456789", _number(digest, i)))
        .otherwise(c),
    )


def _luhn(fifteen: Column) -> Column:
    """The check digit of a 16-digit number."""
    def worth(p: Column) -> Column:
        digit = F.substr(fifteen, p, F.lit(1)).cast("int")
        twice = digit * 2
        return F.when(p % 2 == 1, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(digit)

    total = F.aggregate(F.transform(F.sequence(F.lit(1), F.lit(15)), worth), F.lit(0), lambda a, x: a + x)
    return ((10 - total % 10) % 10).cast("string")


def _email(value: Column, key: str, attempt: Column) -> Column:
    local, domain = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
    own = _digest(key, F.lit("local"), value, attempt)
    top = F.substring_index(domain, ".", -1)
    labels = F.substr(domain, F.lit(1), F.length(domain) - F.length(top) - 1)
    extra = F.when(attempt >= WIDER, _shaped(F.lit("aaaaaaaa"), _digest(key, F.lit("extra"), value, attempt))).otherwise("")
    # a domain always becomes the same domain, so colleagues stay colleagues
    return F.concat(
        _shaped(local, own), extra, F.lit("@"), _shaped(labels, _digest(key, F.lit("domain"), domain)), F.lit("."), top
    )


def _phone(value: Column, digest: Column) -> Column:
    code = F.length(value) - 10
    return _characters(
        value,
        lambda c, i: F.when(i < code, c)
        .when((i == code) | (i == code + 3), _pick("23456789", _number(digest, i)))
        .otherwise(_pick("0123456789", _number(digest, i))),
    )


def _card(value: Column, digest: Column) -> Column:
    fifteen = _characters(
        F.substr(value, F.lit(1), F.lit(15)),
        lambda c, i: F.when(i == 0, c).otherwise(_pick("0123456789", _number(digest, i))),
    )
    return F.concat(fifteen, _luhn(fifteen))


def _ip(value: Column, digest: Column, attempt: Column) -> Column:
    def octet(o: Column, i: Column) -> Column:
        n = _number(digest, i)
        same_length = (
            F.when(F.length(o) == 1, n % 9 + 1).when(F.length(o) == 2, n % 90 + 10).otherwise(n % 100 + 100)
        )
        return F.when(attempt >= WIDER, n % 254 + 1).otherwise(same_length).cast("string")

    return F.array_join(F.transform(F.split(value, r"\."), octet), ".")


def _name_words(value: Column) -> Column:
    """The words of a name after its form of address, each with the kind of word that it is.

    The last one is the family name, one before it a given name of the gender that the title tells.
    """
    title = F.substring_index(value, " ", 1)
    words = F.slice(F.split(value, " "), 2, 2)
    female = F.regexp_replace(title, r"\.", "").isin([t.lower() for t in FEMALE])
    given = F.when(female, F.lit("word f")).otherwise(F.lit("word m"))
    return F.transform(
        words,
        lambda w, i: F.struct(F.when(i == F.size(words) - 1, F.lit("word family")).otherwise(given).alias("kind"), w.alias("value")),
    )


def _word(kind: Column, word: Column, key: str, attempt: Column) -> Column:
    """A made-up word of a name, of the script and gender of the original."""
    digest = _digest(key, F.lit("word"), word, F.replace(kind, F.lit("word "), F.lit("")), attempt)

    def made(script: str) -> Column:
        syllables, endings = _SYLLABLES[script], _ENDINGS[script]
        end = (
            F.when(kind == "word family", _of_list(endings["family"], _number(digest, 3)))
            .when(kind == "word f", _of_list(endings["f"], _number(digest, 3)))
            .otherwise(_of_list(endings["m"], _number(digest, 3)))
        )
        return F.concat(
            _of_list(syllables, _number(digest, 0)), _of_list(syllables, _number(digest, 1)),
            _of_list(syllables, _number(digest, 2)),
            F.when(attempt >= 2, _of_list(syllables, _number(digest, 4))).otherwise(""), end,
        )

    return (
        F.when(word.rlike(r"\p{IsCyrillic}"), made("cyrillic"))
        .when(word.rlike(r"\p{IsGreek}"), made("greek"))
        .otherwise(made("latin"))
    )


def surrogate(kind: Column, value: Column, attempt: Column, key: str) -> Column:
    """The canonical surrogate of a canonical value; another one for each attempt."""
    attempt = attempt.cast("int")
    digest = _digest(key, kind, value, attempt.cast("string"))
    return (
        F.when(kind == "email", _email(value, key, attempt))
        .when(kind == "phone", _phone(value, digest))
        .when(kind == "card", _card(value, digest))
        .when(kind == "ssn", F.concat(F.lit("9"), _shaped(F.substr(value, F.lit(2), F.lit(8)), digest)))
        .when(kind == "ip", _ip(value, digest, attempt))
        .otherwise(_word(kind, value, key, attempt))
    )


def in_form_of(kind: Column, raw: Column, made: Column) -> Column:
    """A canonical surrogate written as the original was: separators, capitals, country code."""
    code = F.length(F.regexp_replace(raw, "[^0-9]", "")) - F.length(made)

    def digit(c: Column, i: Column) -> Column:
        before = F.length(F.regexp_replace(F.substr(raw, F.lit(1), (i + 1).cast("int")), "[^0-9]", ""))
        at = before - code
        return F.when(c.rlike("[0-9]") & (at > 0), F.substr(made, at, F.lit(1))).otherwise(c)

    def capital(_c: Column, i: Column) -> Column:
        ours = F.substr(made, (i + 1).cast("int"), F.lit(1))
        return F.when(F.substr(raw, (i + 1).cast("int"), F.lit(1)).rlike("[A-Z]"), F.upper(ours)).otherwise(ours)

    words = F.split(made, " ")
    raw_words = F.split(raw, " ")
    name = F.array_join(
        F.transform(
            words,
            lambda w, i: F.when(i == 0, F.element_at(raw_words, (i + 1).cast("int")))
            .when(
                (F.length(F.element_at(raw_words, (i + 1).cast("int"))) > 1)
                & (F.element_at(raw_words, (i + 1).cast("int")) == F.upper(F.element_at(raw_words, (i + 1).cast("int")))),
                F.upper(w),
            )
            .otherwise(F.initcap(w)),
        ),
        " ",
    )
    return (
        F.when(kind.isin("phone", "card", "ssn"), _characters(raw, digit))
        .when(kind == "email", _characters(made, capital))
        .when(kind == "name", name)
        .otherwise(made)
    )


def distinct_surrogates(values: DataFrame, key: str, rounds: int = 64) -> DataFrame:
    """``values`` (kind, value) with a surrogate that no other value has and that is no value itself.

    Names are made of the surrogates of their words, which are distinct by themselves. So a family
    name stays the same with and without a given name, also where a word had to be tried again.
    """
    in_names = stored(
        values.where("kind = 'name'").select("value", F.posexplode(_name_words(F.col("value"))).alias("at", "part")),
        "names",
    )
    words = in_names.select("part.kind", "part.value").distinct()
    made = _distinct(stored(values.where("kind <> 'name'").select("kind", "value").union(words), "plain"), key, rounds)
    own = made.where(F.col("kind").startswith("word ")).toDF("word_kind", "word", "made")
    joined = in_names.join(own, (F.col("part.kind") == F.col("word_kind")) & (F.col("part.value") == F.col("word")))
    names = joined.groupBy("value").agg(F.sort_array(F.collect_list(F.struct("at", "made"))).alias("words")).select(
        F.lit("name").alias("kind"),
        "value",
        F.concat_ws(" ", F.substring_index("value", " ", 1), F.col("words.made")).alias("made"),
    )
    return made.where(~F.col("kind").startswith("word ")).select("kind", "value", "made").union(names)


def _distinct(values: DataFrame, key: str, rounds: int) -> DataFrame:
    """Distinct surrogates of plain values and of the words of names.

    All values start with their first surrogate. Of those that share one, the earliest attempt and
    then the least value keeps it; the others, and those that hit an original, try their next.
    """
    current, before = values.withColumn("attempt", F.lit(0)), None
    for _ in range(rounds):
        made = stored(
            current.select(
                "kind", "value", "attempt",
                surrogate(F.col("kind"), F.col("value"), F.col("attempt"), key).alias("made"),
            ),
            "surrogates",
        )
        if before is not None:
            release(before)
        owners = made.groupBy("kind", "made").agg(
            F.min(F.struct("attempt", "value")).alias("owner")
        )
        originals = values.select("kind", F.col("value").alias("made"), F.lit(True).alias("is_original"))
        judged = (
            made.join(owners, ["kind", "made"])
            .join(originals, ["kind", "made"], "left")
            .withColumn("again", (F.col("owner.value") != F.col("value")) | F.col("is_original").isNotNull())
        )
        before = stored(judged.select("kind", "value", "attempt", "made", "again"), "judged")
        release(made)
        if before.where("again").limit(1).count() == 0:
            return before.select("kind", "value", "made")
        current = before.withColumn("attempt", F.col("attempt") + F.col("again").cast("int"))
    raise RuntimeError(f"surrogates did not become distinct in {rounds} rounds")


def _escaped(text: Column) -> Column:
    """The text without the mark; reversible by :func:`_restored`."""
    changed = F.replace(F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE + "\x03")), F.lit(MARK), F.lit(ESCAPE + "\x04"))
    return F.when(text.contains(MARK) | text.contains(ESCAPE), changed).otherwise(text)


def _restored(text: Column) -> Column:
    changed = F.replace(F.replace(text, F.lit(ESCAPE + "\x04"), F.lit(MARK)), F.lit(ESCAPE + "\x03"), F.lit(ESCAPE))
    return F.when(text.contains(ESCAPE), changed).otherwise(text)


def _parts(text: Column) -> Column:
    """The text cut at entities; every other part, beginning with the second, is one."""
    return F.split(F.regexp_replace(_escaped(text), ANY, f"{MARK}$0{MARK}"), MARK)


def replace_personal_data(
    docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text", found_col: str | None = None
) -> DataFrame:
    """``docs`` with every entity in the text replaced; other columns, and other rows, as they are.

    Entities are e-mail addresses, payment cards, phone and social security numbers, network
    addresses, and names after a form of address. The same entity gets the same surrogate in all
    documents, however it is written; different entities get different ones. Surrogates follow
    from ``key`` (keep it secret), so a second run gives the same text. ``found_col``, when given,
    lists (kind, surrogate) in the order of the text.

    A null text stays null, an empty one empty. Repeated rows are all replaced alike; a null id is
    an id like others. An empty table gives no rows. Extra columns may have any name.
    """
    names = ("__id_key", "__text_key", "__found")
    id_name, text_name, found_name = (free_name(name, docs.columns) for name in names)
    id_key = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    text_key = F.xxhash64(F.col(text_col))
    found = stored(
        docs.select(id_key.alias("id_key"), text_key.alias("text_key"), F.col(text_col).alias("text"))
        .where(F.col("text").isNotNull())
        .select("id_key", "text_key", F.posexplode(_parts(F.col("text"))).alias("at", "raw"))
        .where(F.col("at") % 2 == 1)
        .dropDuplicates(["id_key", "text_key", "at"])
        .withColumn("kind", kind_of(F.col("raw")))
        .withColumn("value", canonical_of(F.col("kind"), F.col("raw"))),
        "entities",
    )
    values = stored(found.select("kind", "value").distinct(), "values")
    made = distinct_surrogates(values, key)
    forms = stored(
        found.select("kind", "value", "raw")
        .distinct()
        .join(made, ["kind", "value"])
        .select("kind", "raw", in_form_of(F.col("kind"), F.col("raw"), F.col("made")).alias("new")),
        "forms",
    )
    release(values)
    replaced = (
        found.join(forms, ["kind", "raw"])
        .groupBy("id_key", "text_key")
        .agg(F.sort_array(F.collect_list(F.struct("at", "kind", "new"))).alias("found"))
        .toDF(id_name, text_name, found_name)
    )
    rebuilt = _restored(
        F.array_join(
            F.transform(
                _parts(F.col(text_col)),
                lambda part, i: F.when(
                    i % 2 == 1, F.element_at(found_name, ((i + 1) / 2).cast("int"))["new"]
                ).otherwise(part),
            ),
            "",
        )
    )
    keyed = docs.withColumns({id_name: id_key, text_name: text_key})
    joined = keyed.join(replaced, [id_name, text_name], "left")
    columns = [
        F.when(F.col(found_name).isNotNull(), rebuilt).otherwise(F.col(text_col)).alias(text_col)
        if c == text_col
        else F.col(f"`{c}`")
        for c in docs.columns
        if c != found_col
    ]
    if found_col:
        none = F.array().cast("array<struct<kind:string,new:string>>")
        listed = F.transform(found_name, lambda e: F.struct(e["kind"].alias("kind"), e["new"].alias("new")))
        columns.append(F.coalesce(listed, none).alias(found_col))
    return joined.select(*columns)
