"""Surrogates for personal data: keyed, type-consistent and collision-checked.

Entities are found by one pattern and reduced to a canonical form (case, blanks
and separators do not matter), so that all mentions of an entity share a
surrogate: digits for digits, letters for letters, a given name of the same
gender and script, a card number that passes the Luhn check if and only if the
original does. A surrogate comes from a keyed hash of type, form and attempt; if
two entities draw the same one, or one draws a real entity of the corpus, the
later draws again. Mentions get the surrogate in their own format.

Only built-in functions are used.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestream.llm.shared import cut, whole

KEY = "lodestream"

TITLES = {
    "m": ["Mr", "Herr", "Señor", "Monsieur", "Господин"],
    "f": ["Mrs", "Ms", "Miss", "Frau", "Señora", "Madame", "Госпожа"],
}
GIVEN = {
    ("m", "latin"): "James John Robert Michael David William Thomas Daniel Paul Peter Hans Klaus Jürgen Pierre Jean Luc Carlos José Miguel Juan".split(),
    ("f", "latin"): "Mary Anna Elizabeth Susan Sarah Laura Emma Julia Claire Marie Ursula Sabine Heike Camille Sophie Carmen María Lucía Elena Isabel".split(),
    ("m", "cyrillic"): "Иван Сергей Андрей Дмитрий Алексей Николай Павел Михаил".split(),
    ("f", "cyrillic"): "Анна Мария Ольга Елена Наталья Татьяна Ирина Светлана".split(),
    ("m", "greek"): "Γιώργος Νίκος Κώστας Δημήτρης Γιάννης Παύλος".split(),
    ("f", "greek"): "Μαρία Ελένη Κατερίνα Σοφία Άννα Δήμητρα".split(),
}
SYLLABLES = {
    "latin": "ba ke li mo nu ra se ti vo da fe gi lo mu na pe ri so ta ve".split(),
    "cyrillic": "ба ке ли мо ну ра се ти во да фе ги ло му на пе ри со та ве".split(),
    "greek": "βα κε λι μο νυ ρα σε τι φο δα φε γι λο μυ να πε ρι σο τα βε".split(),
}

_PART = r"\p{Lu}[\p{L}'’\-]{1,30}"
_TITLE = "|".join(t for ts in TITLES.values() for t in ts)
_NAMED = "|".join(n for ns in GIVEN.values() for n in ns)
PATTERN = "|".join(
    [
        r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]{1,64}@[A-Za-z0-9\-]{1,63}(?:\.[A-Za-z0-9\-]{1,63}){0,6}\.[A-Za-z]{2,24}",
        r"(?<![0-9A-Za-z])(?:[0-9a-f]{32,64}|[0-9A-F]{32,64})(?![0-9A-Za-z])",
        r"(?<![0-9A-Za-z])(?:(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9]{20,64})(?![0-9A-Za-z])",
        r"(?<![\d.\-])\d(?:[ \-]?\d){12,18}(?![\d])",
        r"(?<![\d\-])\d{3}-\d{2}-\d{4}(?![\d\-])",
        r"(?<![\w+])\+\d{1,3}[ .\-]?(?:\(\d{1,4}\)|\d{1,4})[ .\-]?\d{2,4}(?:[ .\-]?\d{2,4}){1,3}(?!\d)",
        r"(?<![\w(])\(\d{3}\) ?\d{3}-\d{4}(?!\d)",
        r"(?<![\d\-])\d{3}[\-.]\d{3}[\-.]\d{4}(?![\d\-])",
        r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\d|\.\d)",
        rf"(?<!\p{{L}})(?:(?:{_TITLE})\.? {_PART}(?: {_PART})?|(?:{_NAMED}) {_PART})(?!\p{{L}})",
    ]
)


def kind(mention: Column) -> Column:
    """Type of a mention that the pattern found."""
    return (
        F.when(mention.contains("@"), "email")
        .when(mention.rlike(r"^[0-9a-fA-F]{32,64}$"), "secret")
        .when(mention.rlike(r"^(AKIA|ASIA|gh[pousr]_|sk-)"), "key")
        .when(mention.rlike(r"^(\d{1,3}\.){3}\d{1,3}$"), "ipv4")
        .when(mention.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn")
        .when(mention.rlike(r"^[+(]|^\d{3}[\-.]\d{3}[\-.]\d{4}$"), "phone")
        .when(mention.rlike(r"^\d"), "card")
        .otherwise("name")
    )


def _script(text: Column) -> Column:
    return F.when(text.rlike(r"\p{IsCyrillic}"), "cyrillic").when(text.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def parts(mention: Column, what: Column) -> Column:
    """Array of (type, form): one entity, or given and family name of a name."""
    bare = F.regexp_replace(mention, rf"^(?:{_TITLE})\.? ", "")
    title = F.regexp_extract(mention, rf"^({_TITLE})\.? ", 1)
    family, given = F.element_at(F.split(bare, " "), -1), F.element_at(F.split(bare, " "), 1)
    female = F.when(title != "", title.isin(TITLES["f"])).otherwise(given.isin([n for (g, _), ns in GIVEN.items() if g == "f" for n in ns]))
    gender = F.when(female, "f").otherwise("m")

    def entity(type_: Column, form: Column) -> Column:
        return F.struct(type_.alias("type"), form.alias("form"))

    last = entity(F.concat(F.lit("family:"), _script(family)), F.lower(family))
    first = entity(F.concat_ws(":", F.lit("given"), gender, _script(given)), F.lower(given))
    digits = F.regexp_replace(mention, r"\D", "")
    form = F.when(what.isin("phone", "card", "ssn"), digits).when(what.isin("email", "secret"), F.lower(mention)).otherwise(mention)
    return F.when((what == "name") & bare.contains(" "), F.array(first, last)).when(what == "name", F.array(last)).otherwise(F.array(entity(what, form)))


def _number(draw: Column, i: Column | int) -> Column:
    """The i-th number 0..65535 of a keyed draw of 128 hex digits, repeating."""
    i = F.lit(i) if isinstance(i, int) else i
    at = i % 31 * 4 + F.floor(i / 31).cast("int") % 4 + 1
    return F.conv(F.substring(draw, at, F.lit(4)), 16, 10).cast("int")


def _pick(options: list[str], number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(o) for o in options]), (number % len(options) + 1).cast("int"))


def _shaped(form: Column, draw: Column, hexadecimal: bool = False) -> Column:
    """Letters for letters and digits for digits, other characters as they are."""

    def one(c: Column, i: Column) -> Column:
        n = _number(draw, i)
        if hexadecimal:
            return F.substring(F.lit("0123456789abcdef"), (n % 16 + 1), F.lit(1))
        return (
            F.when(c.rlike("[0-9]"), (n % 10).cast("string"))
            .when(c.rlike("[a-z]"), F.chr(n % 26 + 97))
            .when(c.rlike("[A-Z]"), F.chr(n % 26 + 65))
            .otherwise(c)
        )

    return F.array_join(F.transform(F.split(form, ""), one), "")


def luhn_sum(digits: Column) -> Column:
    """Luhn sum of a digit string, the last digit counting once."""

    def add(c: Column, i: Column) -> Column:
        d = c.cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when(i % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), add), F.lit(0), lambda a, x: a + x)


def candidate(type_: Column, form: Column, attempt: Column, key: str) -> tuple[Column, Column]:
    """The surrogate form that an entity draws at an attempt, given its second
    value as column ``_shape``: the form with its letters and digits replaced."""
    seed = F.concat_ws("\x1f", F.lit(key), type_, form, attempt.cast("string"))
    draw = F.concat(F.sha2(seed, 256), F.sha2(F.concat(seed, F.lit("\x1f+")), 256))
    script = F.substring_index(type_, ":", -1)

    def spoken(options: list[str], count: int) -> Column:
        return F.concat(*[_pick(options, _number(draw, k)) for k in range(count)])

    def by_script(make) -> Column:
        out = make("latin")
        for other in ("cyrillic", "greek"):
            out = F.when(script == other, make(other)).otherwise(out)
        return out

    # Later attempts draw longer names, so that there are always free ones.
    family = by_script(lambda s: F.when(attempt < 3, spoken(SYLLABLES[s], 4)).otherwise(spoken(SYLLABLES[s], 8)))
    female = type_.startswith("given:f")
    listed = by_script(lambda s: F.when(female, _pick(GIVEN["f", s], _number(draw, 9))).otherwise(_pick(GIVEN["m", s], _number(draw, 9))))
    endings = {"latin": ("na", "n"), "cyrillic": ("на", "н"), "greek": ("να", "ς")}
    made = by_script(lambda s: F.concat(F.when(attempt < 4, spoken(SYLLABLES[s], 2)).otherwise(spoken(SYLLABLES[s], 8)), F.when(female, endings[s][0]).otherwise(endings[s][1])))
    given = F.when(attempt < 2, F.lower(listed)).otherwise(made)

    stem, end = F.regexp_extract(form, r"^(.*)\.([^.]*)$", 1), F.regexp_extract(form, r"^(.*)\.([^.]*)$", 2)
    longer = F.when(attempt < 2, F.lit("")).otherwise(F.concat(*[F.chr(_number(draw, 20 + k) % 26 + 97) for k in range(8)]))
    email = F.concat(longer, _shaped(stem, draw), F.lit("."), end)
    ip = F.concat_ws(".", *[(_number(draw, k) % 254 + 1).cast("string") for k in range(4)])
    numbers = F.concat(F.substring(form, 1, 1), F.expr("substring(_shape, 2)"))
    head = F.concat(F.substring(form, 1, 1), F.expr("substring(_shape, 2, length(_shape) - 2)"))
    check = (10 - luhn_sum(F.concat(head, F.lit("0"))) % 10) % 10
    off = F.when(luhn_sum(form) % 10 == 0, 0).otherwise(_number(draw, 30) % 9 + 1)
    card = F.concat(head, ((check + off) % 10).cast("string"))
    key_form = F.concat(F.regexp_extract(form, r"^(AKIA|ASIA|gh[pousr]_|sk-)", 1), _shaped(F.regexp_replace(form, r"^(AKIA|ASIA|gh[pousr]_|sk-)", ""), draw))
    choice = (
        F.when(type_ == "email", email).when(type_ == "secret", _shaped(form, draw, True)).when(type_ == "key", key_form).when(type_ == "ipv4", ip)
        .when(type_ == "card", card).when(type_ == "phone", numbers).when(type_ == "ssn", F.col("_shape")).when(type_.startswith("given"), given).otherwise(family)
    )
    return choice, _shaped(form, draw)


def assign(entities: DataFrame, key: str = KEY) -> DataFrame:
    """(type, form, surrogate) for distinct (type, form); surrogates of a type are
    distinct from each other and from all forms of the type."""
    waiting = cut(entities.select("type", "form").distinct().withColumn("attempt", F.lit(0)))
    real = waiting.select("type", F.col("form").alias("surrogate"))
    done: list[DataFrame] = []
    while not waiting.isEmpty():
        choice, shape = candidate(F.col("type"), F.col("form"), F.col("attempt"), key)
        drawn = waiting.withColumn("_shape", shape).withColumn("surrogate", choice).drop("_shape")
        drawn = drawn.join(real, ["type", "surrogate"], "left_anti")
        for earlier in done:
            drawn = drawn.join(earlier.select("type", "surrogate"), ["type", "surrogate"], "left_anti")
        won = cut(drawn.groupBy("type", "surrogate").agg(F.min("form").alias("form")).select("type", "form", "surrogate"))
        done.append(won)
        waiting = cut(waiting.join(won, ["type", "form"], "left_anti").withColumn("attempt", F.col("attempt") + 1))
    return reduce(DataFrame.union, done) if done else real.withColumn("form", F.col("surrogate")).select("type", "form", "surrogate")


def _in_format(mention: Column, what: Column, got: Column) -> Column:
    """The surrogates of a mention's parts, written as the mention is."""
    one = F.element_at(got, 1)
    between = F.split(mention, "[0-9]", -1)
    digits = F.array_join(F.zip_with(between, F.concat(F.split(one, ""), F.array(F.lit(""))), lambda a, b: F.concat(a, b)), "")
    same_case = F.when(mention == F.upper(mention), F.upper(one)).otherwise(one)
    title = F.regexp_extract(mention, rf"^((?:{_TITLE})\.? )?", 0)
    name = F.concat(title, F.array_join(F.transform(got, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substring(p, F.lit(2), F.length(p)))), " "))
    return F.when(what.isin("phone", "card", "ssn"), digits).when(what.isin("email", "secret"), same_case).when(what == "name", name).otherwise(one)


def mentions(docs: DataFrame) -> DataFrame:
    """(_key, i, mention, what, parts): found entities of each distinct document."""
    found = docs.select(_document().alias("_key"), F.posexplode(F.regexp_extract_all(whole(), F.lit(PATTERN), F.lit(0))).alias("i", "mention"))
    found = found.withColumn("what", kind(F.col("mention")))
    return found.withColumn("parts", parts(F.col("mention"), F.col("what")))


def _document() -> Column:
    return F.struct(F.col("doc_id").alias("id"), F.xxhash64(whole()).alias("text"), F.crc32(whole().cast("binary")).alias("check"))


def anonymised(docs: DataFrame, key: str = KEY) -> DataFrame:
    """(_row, n_entities): whole rows with surrogates in their text.

    A null text stays null. Rows equal in doc_id and text count once. Texts are
    searched whole; everything outside the mentions is kept as it is.
    """
    found = cut(mentions(docs).dropDuplicates(["_key", "i"]))
    flat = found.select("_key", "i", "mention", "what", F.posexplode("parts").alias("k", "part")).select("*", "part.type", "part.form").drop("part")
    table = assign(flat.select("type", "form"), key)
    met = flat.join(table, ["type", "form"])
    whole_mentions = met.groupBy("_key", "i", "mention", "what").agg(F.sort_array(F.collect_list(F.struct("k", "surrogate"))).alias("got"))
    new = whole_mentions.select("_key", F.struct("i", _in_format(F.col("mention"), F.col("what"), F.col("got.surrogate")).alias("new")).alias("m"))
    by_document = new.groupBy("_key").agg(F.sort_array(F.collect_list("m")).alias("_new"))
    rows = docs.select(F.struct("*").alias("_row"), _document().alias("_key")).join(by_document, "_key", "left")
    between = F.split("_row.text", PATTERN, -1)
    text = F.array_join(F.zip_with(between, F.concat(F.col("_new.new"), F.array(F.lit(""))), lambda a, b: F.concat(a, b)), "")
    text = F.when(F.col("_new").isNull(), F.col("_row.text")).otherwise(text)
    return rows.select(F.col("_row").withField("text", text).alias("_row"), F.coalesce(F.size("_new"), F.lit(0)).alias("n_entities"))


def anonymise(docs: DataFrame, key: str = KEY) -> DataFrame:
    """``docs`` with surrogates in the text, same columns and rows."""
    return anonymised(docs, key).select("_row.*").select(*docs.columns)
