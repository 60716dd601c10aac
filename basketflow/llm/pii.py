"""Surrogates for personal data: keyed, consistent with type, gender, script and format.

Mentions are e-mail addresses, telephone numbers (after a plus; in national form with an area
code in brackets or set off, or behind a leading 0), payment cards (13 to 19 digits with a valid
check digit, or 16 digits from 3, 4, 5 or 6), IPv4 addresses and names after titles.  A name runs over all
capitalised parts that follow, with initials, hyphens and particles such as "von".  A mention
is reduced to units: the digits of a number, the local part and the domain of an address in lower case,
each capitalised part of a name; parts of the last word are surnames, an initial gets a whole name.  Every
distinct unit of the corpus gets one surrogate derived from a secret key, so the same unit is replaced alike
everywhere (coreference), also when it is written in another format.  A given name behind a title without
gender takes the surrogate it has behind a title with one.  Surrogates keep the length and
punctuation of the mention, the country code, the top-level domain, a valid check digit, the
gender of the title, the script and the case of the letters.

Collision checks: a surrogate must differ from every real unit of its kind and from every other
surrogate; units that fail get another candidate until none is left, so distinct
units stay distinct.  From the attempt GROWS on every candidate is longer by one character than the one
before, so there are ten times as many or more at each attempt and the rounds end, also where a
format has fewer values than the corpus has units.  All of it is DataFrame code.

Defined results: a null text stays null; empty texts and texts without mentions are
unchanged; repeated rows are replaced alike; other columns, also with clashing names, pass
through; an empty table gives an empty result.  No pattern recurses with the length of a text or begins
anew inside a word; a domain has at most 127 labels, further ones are text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketflow.llm.text import unused
from basketflow.session import scratch_dir

# Titles by gender, and the syllables and endings of surrogate names by script.
TITLES = {"m": ("Mr", "Herr", "Monsieur", "Señor", "Господин", "Sir", "Sr"),
          "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Señora", "Госпожа", "Señorita", "Sra", "Mme", "Mlle"),
          "n": ("Mx", "Dr", "Prof", "Professor", "Doctor", "Doktor", "Rev", "Доктор", "Профессор")}
PARTICLES = "von van der den de del della di da dos du la le zu zur ter ten bin ibn al el".split()
SYLLABLES = {
    "latin": "ba de fi go lu ma ne ri so ta ve zo ka le mi no".split(),
    "cyrillic": "ба де фи го лу ма не ри со та ве зо ка ле ми но".split(),
    "greek": "βα δε φι γο λυ μα νε ρι σο τα βε ζο κα λε μι νο".split(),
}
ENDINGS = {
    "latin": {"given_m": "n", "given_f": "na", "given_n": "l", "surname": "rt"},
    "cyrillic": {"given_m": "н", "given_f": "на", "given_n": "л", "surname": "рт"},
    "greek": {"given_m": "ς", "given_f": "να", "given_n": "ξ", "surname": "ρης"},
}
SCRIPTS = {"cyrillic": r"\p{IsCyrillic}", "greek": r"\p{IsGreek}"}

# The calling codes of two digits; 1 and 7 have one digit, all others three.
TWO_DIGIT_CODES = "^(?:2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
# Attempts at a surrogate in the format of the unit, before surrogates grow.
GROWS = 4

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_TITLE = "|".join(t for g in ("f", "m", "n") for t in TITLES[g])
_NAME = r"(?:\p{Lu}[\p{L}'’]++|\p{Lu}(?!\p{L})\.?)"
_CARD = (r"(?<![0-9])(?:[3-6][0-9]{3}(?:[ -]?[0-9]{4}){3}|[1-9][0-9]{12,18}|[1-9][0-9]{3}(?:[ -][0-9]{4}){3}(?:[ -][0-9]{1,3})?"
         r"|[1-9][0-9]{3}[ -][0-9]{6}[ -][0-9]{4,5})(?![0-9])")
PATTERNS = {
    "email": r"(?<![A-Za-z0-9])(?<![A-Za-z0-9][._%+-]{1,8})[A-Za-z0-9][A-Za-z0-9._%+-]*+@"
             r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+){0,125}\.[A-Za-z]{2,}",
    "phone": r"\+[0-9]{1,3}(?:[ .-]?\(?[0-9]{2,4}\)?){2,5}(?![0-9])",
    "ip": rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9]|\.[0-9])",
    "card": _CARD,
    "national": r"(?<![0-9.,:/+-])(?:(?:1[ .-])?(?:\([0-9]{3}\)[ .-]?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}"
                r"|\(?0[1-9][0-9]{1,3}\)?(?:[ ./-]?[0-9]){6,8}|0[1-9](?:[ .-][0-9]{2}){4}"
                r"|\(?0[1-9]\)?[ .-][0-9]{4}[ .-]?[0-9]{4})(?![0-9])",
    "person": rf"(?<!\p{{L}})(?=\p{{Lu}})(?:(?:{_TITLE})\.? ){{1,8}}{_NAME}(?:[ -](?:(?:{'|'.join(PARTICLES)}) ){{0,3}}{_NAME})*+(?!\p{{L}})",
}
MENTION = "|".join(PATTERNS.values())


def _kind(raw: Column) -> Column:
    return (F.when(raw.contains("@"), "email").when(raw.startswith("+"), "phone")
            .when(raw.rlike(rf"^(?:{_OCTET}\.){{3}}{_OCTET}$"), "ip").when(raw.rlike(rf"^(?:{_CARD})$"), "card")
            .when(raw.rlike(r"^[(0-9]"), "national").otherwise("person"))


def _digits(raw: Column) -> Column:
    return F.regexp_replace(raw, "[^0-9]", "")


def _luhn_sum(digits: Column, odd: int) -> Column:
    """Sum of the digits from the right, those at places of the parity ``odd`` doubled."""
    def value(c: Column, i: Column) -> Column:
        digit = c.cast("int")
        return F.when(i % 2 == odd, F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)).otherwise(digit)

    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), value), F.lit(0), lambda a, x: a + x)


def mentions(text: Column) -> Column:
    """All candidates of a text, from left to right; numbers like a card's are yet to be checked."""
    return F.regexp_extract_all(text, F.lit(MENTION), F.lit(0))


def _parsed(raws: DataFrame) -> DataFrame:
    """(raw, kind, parts) of distinct mentions; a part is (text, kind, unit), the unit null where it stays."""
    raw = F.col("raw")
    digits = _digits(raw)
    checked = digits.rlike("^[3-6][0-9]{15}$") | (F.when(F.col("kind") == "card", _luhn_sum(digits, 1)) % 10 == 0)
    raws = raws.select("raw", _kind(raw).alias("kind")).where((F.col("kind") != "card") | checked)
    kind = F.col("kind")
    title = F.regexp_extract(raw, rf"^(?:(?:{_TITLE})\.? ){{1,8}}(?=\p{{Lu}})", 0)
    names = F.substr(raw, F.char_length(title) + 1)
    before = F.substr(names, F.lit(1), F.char_length(names) - F.char_length(F.substring_index(names, " ", -1)))

    def gender(g: str) -> Column:
        return title.rlike(rf"(?<!\p{{L}})(?:{'|'.join(TITLES[g])})\.? ")

    given = F.when(gender("f"), "given_f").when(gender("m"), "given_m").otherwise("given_n")

    def part(text: Column, kind: Column, unit: Column) -> Column:
        return F.struct(text.alias("text"), kind.alias("kind"), unit.alias("unit"))

    def parts(text: Column, kind: Column) -> Column:
        return F.transform(F.regexp_extract_all(text, F.lit(r"[\p{L}'’]+|[^\p{L}'’]+"), F.lit(0)),
                           lambda t: part(t, kind, F.when(t.rlike(r"^\p{Lu}"), F.lower(t))))

    person = F.concat(F.array(part(title, F.lit("title"), F.lit(None).cast("string"))), parts(before, given),
                      parts(F.substr(names, F.char_length(before) + 1), F.lit("surname")))
    local, top = F.substring_index(raw, "@", 1), F.regexp_extract(raw, r"\.[A-Za-z]+$", 0)
    domain = F.substr(raw, F.char_length(local) + 2, F.char_length(raw) - F.char_length(local) - F.char_length(top) - 1)
    email = F.array(part(local, F.lit("local"), F.lower(local)), part(F.lit("@"), F.lit("at"), F.lit(None).cast("string")),
                    part(domain, F.lit("domain"), F.lower(domain)), part(top, F.lit("top"), F.lit(None).cast("string")))
    unit = F.when(kind == "ip", raw).otherwise(digits)
    return raws.select("raw", "kind", F.when(kind == "person", person).when(kind == "email", email)
                       .otherwise(F.array(part(raw, kind, unit))).alias("parts"))


def _parts(parsed: DataFrame) -> DataFrame:
    """(raw, at, text, kind, unit): the parts of the mentions, given names without gender as those with one."""
    flat = parsed.select("raw", F.posexplode("parts").alias("at", "part")).select("raw", "at", "part.*")
    known = (flat.where(F.col("kind").isin("given_f", "given_m") & F.col("unit").isNotNull()).groupBy("unit")
             .agg(F.min("kind").alias("known")).withColumn("kind", F.lit("given_n")))
    return flat.join(known, ["kind", "unit"], "left").select(
        "raw", "at", "text", F.coalesce("known", "kind").alias("kind"), "unit")


def _byte(code: Column, at: Column) -> Column:
    place = F.pmod(at, F.lit(96)) * 2 + 1
    return F.conv(F.substr(code, place, F.lit(2)), 16, 10).cast("int")


def _luhn(digits: Column) -> Column:
    """The check digit to put behind the digits."""
    return F.pmod(10 - _luhn_sum(digits, 0) % 10, F.lit(10)).cast("string")


def _letters(code: Column, at: Column) -> Column:
    return F.substr(F.lit("abcdefghijklmnopqrstuvwxyz"), _byte(code, at) % 26 + 1, F.lit(1))


def _candidate(units: DataFrame, key: str) -> DataFrame:
    """``units`` (kind, unit, attempt) plus ``surrogate``."""
    code = F.concat(*[F.sha2(F.concat_ws("|", F.lit(key), "kind", "unit", F.col("attempt").cast("string"), F.lit(str(b))), 256)
                      for b in range(3)])
    coded = units.withColumn("_code", code)
    code, unit = F.col("_code"), F.col("unit")
    chars = F.split(unit, "")

    def other(c: Column, i: Column) -> Column:
        return F.when(c.rlike("[a-z]"), _letters(code, i)).when(c.rlike("[0-9]"), (_byte(code, i) % 10).cast("string")).otherwise(c)

    address = F.array_join(F.transform(chars, other), "")
    country = F.when(unit.rlike("^[17]"), 1).when(unit.rlike(TWO_DIGIT_CODES), 2).otherwise(3)
    number = F.transform(chars, lambda c, i: F.when(i < country, c).when(i == country, (_byte(code, i) % 8 + 2).cast("string"))
                         .otherwise((_byte(code, i) % 10).cast("string")))
    # a number without country code keeps its leading 0 or 1
    national = F.transform(chars, lambda c, i: F.when((i == 0) & c.isin("0", "1"), c).when(i < 2, (_byte(code, i) % 8 + 2).cast("string"))
                           .otherwise((_byte(code, i) % 10).cast("string")))
    body = F.array_join(F.transform(F.slice(chars, F.lit(1), F.greatest(F.size(chars) - 1, F.lit(1))), lambda c, i: F.when(i == 0, c).otherwise(
        (_byte(code, i) % 10).cast("string"))), "")
    octets = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: (_byte(code, i) % 254 + 1).cast("string")), ".")

    def name(script: str) -> Column:
        table = F.array(*[F.lit(s) for s in SYLLABLES[script]])
        parts = F.transform(F.sequence(F.lit(0), F.lit(3) + F.least("attempt", F.lit(90))),
                            lambda i: F.element_at(table, _byte(code, i) % len(SYLLABLES[script]) + 1))
        end = F.create_map(*[F.lit(x) for kv in ENDINGS[script].items() for x in kv])
        return F.concat(F.array_join(parts, ""), end[F.col("kind")])

    names = name("latin")
    for script, letters in SCRIPTS.items():
        names = F.when(unit.rlike(letters), name(script)).otherwise(names)
    kind = F.col("kind")
    # longer candidates once the format's own have failed too often
    more = F.greatest(F.col("attempt") - GROWS + 1, F.lit(0))
    places = F.filter(F.sequence(F.lit(0), more), lambda i: i < more)
    letters = F.array_join(F.transform(places, lambda i: _letters(code, i + 50)), "")
    figures = F.array_join(F.transform(places, lambda i: (_byte(code, i + 50) % 10).cast("string")), "")
    return coded.withColumn("_body", body).withColumn(
        "surrogate", F.when(kind.isin("local", "domain"), F.concat(letters, address))
        .when(kind == "phone", F.concat(F.array_join(number, ""), figures))
        .when(kind == "national", F.concat(F.array_join(national, ""), figures))
        .when(kind == "card", F.concat("_body", F.when(kind == "card", _luhn(F.col("_body"))), figures))
        .when(kind == "ip", F.concat(octets, F.when(more > 0, F.concat(F.lit("."), figures)).otherwise(""))).otherwise(names)
    ).drop("_code", "_body")


def surrogates(units: DataFrame, key: str, root: str) -> DataFrame:
    """(kind, unit, surrogate) of the distinct units, without collisions."""
    spark = units.sparkSession
    units.write.parquet(f"{root}/units")
    real = spark.read.parquet(f"{root}/units")
    pending, done, step = real.withColumn("attempt", F.lit(0)), None, 0
    while True:
        tried = _candidate(pending, key)
        free = tried.join(real.select("kind", F.col("unit").alias("surrogate")), ["kind", "surrogate"], "left_anti")
        if done is not None:
            free = free.join(done, ["kind", "surrogate"], "left_anti")
        first = Window.partitionBy("kind", "surrogate").orderBy("unit")
        (free.withColumn("_n", F.row_number().over(first)).where("_n = 1").select("kind", "unit", "surrogate")
         .write.parquet(f"{root}/done/step={step}"))
        done = spark.read.schema("kind string, unit string, surrogate string").parquet(f"{root}/done")
        pending.join(done, ["kind", "unit"], "left_anti").withColumn("attempt", F.lit(step + 1)).write.parquet(f"{root}/pending{step}")
        pending = spark.read.schema("kind string, unit string, attempt int").parquet(f"{root}/pending{step}")
        if not pending.take(1):
            return done
        step += 1


def _written(raw: Column, digits: Column) -> Column:
    """``raw`` with its digits replaced, one after the other; digits left over follow."""
    inside = F.array_join(F.transform(F.split(raw, ""), lambda c, i: F.when(c.rlike("[0-9]"), F.substr(
        digits, F.char_length(_digits(F.substr(raw, F.lit(1), i + 1))), F.lit(1))).otherwise(c)), "")
    return F.concat(inside, F.substr(digits, F.char_length(_digits(raw)) + 1))


def _cased(like: Column, name: Column) -> Column:
    return F.when((F.char_length(like) > 1) & (F.upper(like) == like), F.upper(name)).otherwise(F.initcap(name))


def _replacements(parts: DataFrame, chosen: DataFrame) -> DataFrame:
    """(raw, new) of every distinct mention."""
    raw, kind, text, unit = F.col("raw"), F.col("kind"), F.col("text"), F.col("s")
    rows = parts.join(chosen.withColumnRenamed("surrogate", "s"), ["kind", "unit"], "left")
    shouted = (F.upper(text) == text) & (F.lower(text) != text)
    new = (F.when(F.col("unit").isNull(), text).when(kind.isin("local", "domain"), F.when(shouted, F.upper(unit)).otherwise(unit))
           .when(kind.isin("phone", "national", "card"), _written(raw, unit)).when(kind == "ip", unit)
           .otherwise(_cased(text, unit)))
    ordered = F.array_sort(F.collect_list(F.struct("at", new.alias("new"))))
    return rows.groupBy("raw").agg(F.array_join(F.transform(ordered, lambda p: p["new"]), "").alias("new"))


def replace_mentions(docs: DataFrame, key: str, text: str = "text", n_mentions: str = "n_mentions") -> DataFrame:
    """``docs`` with every mention replaced, plus the number of mentions."""
    spark = docs.sparkSession
    root = scratch_dir(spark, "pii")
    names = [c for c in docs.columns if c != n_mentions]
    body = docs[text]
    has = F.coalesce(body.rlike(MENTION), F.lit(False))
    row_key = F.sha2(body, 256)
    own_key, new_of = unused("text_key", docs.columns), unused("new_of", docs.columns)
    hits_of = unused("hits_of", docs.columns)
    # Rows with candidates are written once with all they are read for, so that the patterns, which are nearly the
    # whole cost, meet every text twice only: here and where the rows without candidates are passed on.
    empty = [c for c, kind in docs.dtypes if kind == "void"]  # not a type of Parquet
    (docs.where(has).select(*[F.col(c) for c in names if c not in empty], row_key.alias(own_key), mentions(body).alias(hits_of))
     .write.parquet(f"{root}/some"))
    some = spark.read.parquet(f"{root}/some")
    found = some.select(F.col(own_key).alias("key"), F.explode(F.array_distinct(hits_of)).alias("raw")).distinct()
    found.write.parquet(f"{root}/found")
    found = spark.read.parquet(f"{root}/found")
    _parsed(found.select("raw").distinct()).write.parquet(f"{root}/parsed")
    parsed = spark.read.parquet(f"{root}/parsed")
    _parts(parsed).write.parquet(f"{root}/parts")
    parts = spark.read.parquet(f"{root}/parts")
    units = parts.where("unit is not null").select("kind", "unit").distinct()
    _replacements(parts, surrogates(units, key, root)).write.parquet(f"{root}/new")
    new = spark.read.parquet(f"{root}/new")
    maps = (found.join(new, "raw").groupBy("key")
            .agg(F.map_from_entries(F.collect_list(F.struct("raw", "new"))).alias(new_of)))
    # written, so that the join has no aggregation in its stage and can split a frequent text
    maps.write.parquet(f"{root}/maps")
    maps = spark.read.parquet(f"{root}/maps").withColumnRenamed("key", own_key)
    joined = some.join(maps, own_key, "left")
    pieces, hits = F.split(F.col(text), MENTION, -1), F.col(hits_of)
    filled = F.array_join(F.zip_with(pieces, F.transform(hits, lambda m: F.coalesce(F.element_at(F.col(new_of), m), m)),
                                     lambda piece, m: F.concat(piece, F.coalesce(m, F.lit("")))), "")
    count = F.size(F.filter(hits, lambda m: F.element_at(F.col(new_of), m).isNotNull())).cast("long").alias(n_mentions)
    changed = joined.select(*[filled.alias(c) if c == text else F.lit(None).alias(c) if c in empty else F.col(c) for c in names], count)
    plain = docs.where(~has).select(*[F.col(c) for c in names], F.lit(0).cast("long").alias(n_mentions))
    return plain.unionByName(changed)
