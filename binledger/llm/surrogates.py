"""Personal data replaced by keyed surrogates, in built-in functions only.

Each different entity of the corpus gets one surrogate of its kind; every mention of
it, however written, gets that surrogate in the mention's own format.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from binledger.llm.staging import free_name, staged

# Titles that tell no gender are among the male ones.
_NEUTRAL = ["Dr", "Prof", "Professor", "Доктор", "Профессор"]
MALE = ["Mr", "Herr", "Herrn", "Monsieur", "M", "Señor", "Sr", "Don", "Sir", "Lord", "Господин", "Г-н", *_NEUTRAL]
FEMALE = ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mademoiselle", "Mlle", "Señora", "Sra", "Señorita", "Srta", "Doña", "Lady", "Госпожа", "Г-жа"]
# Not another title: in "Herr Dr. Weiß" the name comes behind the second.
_NAME = r"(?!(?:" + "|".join(_NEUTRAL) + r")(?!\p{L}))\p{Lu}[\p{L}'’-]+(?: \p{Lu}[\p{L}'’-]+){0,3}"


def _after(titles):
    """Names behind a title. What is cheap to see comes first: most places have no
    capital letter."""
    return r"(?=\p{Lu})(?<= )(?<=" + "|".join(rf"(?<!\p{{L}}){t}\.? " for t in titles) + f")({_NAME})"


# Groups 1 and 2 are names behind a title; the rest of an entity has no group.
PATTERN = "|".join(
    [
        _after(MALE),
        _after(FEMALE),
        r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)++",
        r"(?=[A-Z]{2}[0-9]{2})(?<![\p{L}\p{N}])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
        r"(?<![A-Za-z0-9])(?=[A-Za-z]*+[0-9])(?=[0-9]*+[A-Za-z])[A-Za-z0-9]{16,}+",
        r"(?<![\p{L}\p{N}:])(?=[A-Fa-f:]{0,38}+[0-9])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6}::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})?)(?![\p{L}\p{N}:])",
        r"(?=[0-9(+])(?:(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\.?[0-9])",
        r"\+[0-9]{1,3}(?:[ .-]?\(?[0-9]{2,4}\)?){2,5}(?![0-9])",
        r"(?<![0-9])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])",
        r"(?<![0-9])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9])",
        r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])",
        r"(?<![0-9])[0-9]{9,12}(?![0-9]))",
    ]
)
_TITLED = "(?=[" + "".join(sorted({t[0] for t in [*MALE, *FEMALE]})) + "])(?:" + "|".join([*MALE, *FEMALE]) + r")\.? \p{Lu}"
_MOST_ROUNDS = 64


def _kind(mention, male, female):
    """What an entity is, from its text."""
    return (
        F.when(male != "", F.when(male.rlike(r"\p{IsCyrillic}"), "male_cyrillic").otherwise("male"))
        .when(female != "", F.when(female.rlike(r"\p{IsCyrillic}"), "female_cyrillic").otherwise("female"))
        .when(mention.contains("@"), "email")
        .when(mention.rlike(r"^([0-9]{1,3}\.){3}[0-9]{1,3}$"), "ip")
        .when(mention.contains(":"), "ip6")
        .when(mention.rlike(r"^[A-Z]{2}[0-9]{2}[A-Z0-9 ]+$") & mention.rlike(r"^.{15,42}$"), "account")
        .when(mention.rlike("^[0-9A-Fa-f]{16,}$") & mention.rlike("[A-Fa-f]"), "hex")
        .when(mention.rlike("[A-Za-z]"), "secret")
        .otherwise("number")
    )


def _canonical(kind, mention):
    """The same for all ways to write one entity: digits of a number, lower case of an
    address or name, an account without its blanks."""
    return (
        F.when(kind == "number", F.regexp_replace(mention, "[^0-9]+", ""))
        .when(kind == "account", F.regexp_replace(mention, " ", ""))
        .when(kind.isin("secret", "hex"), mention)
        .otherwise(F.lower(mention))
    )


def _stream(secret, kind, name, attempt, length):
    """Keyed hashes in hexadecimal digits, two digits for each character wanted."""
    seed = F.concat_ws("|", F.lit(secret), kind, name, attempt.cast("string"))
    return F.transform(
        F.sequence(F.lit(0), F.floor(length / 32).cast("int")), lambda i: F.sha2(F.concat(F.lit(secret), seed, F.lit("|"), i.cast("string")), 256)
    )


def _once(value, body):
    """``body`` of a value that is worked out once, not anew for each element inside."""
    return F.transform(F.array(value), body)[0]


def _pick(stream, i, n):
    """Number below ``n`` for place ``i`` of a stream."""
    digits = F.substr(F.element_at(stream, F.floor(i / 32).cast("int") + 1), 2 * (i % 32) + 1, F.lit(2))
    return (F.conv(digits, 16, 10).cast("int") % n).cast("int")


def _letter(alphabet, stream, i):
    return F.substr(F.lit(alphabet), _pick(stream, i, len(alphabet)) + 1, F.lit(1))


_LATIN, _CYRILLIC, _GREEK = "abcdefghijklmnopqrstuvwxyz", "абвгдежзиклмнопрстуфхцчшэюя", "αβγδεζηθικλμνξοπρστυφχψω"


def _like(char, stream, i):
    """A character of the class and script of ``char``."""
    lower = (
        F.when(char.rlike(r"\p{IsCyrillic}"), _letter(_CYRILLIC, stream, i))
        .when(char.rlike(r"\p{IsGreek}"), _letter(_GREEK, stream, i))
        .otherwise(_letter(_LATIN, stream, i))
    )
    return (
        F.when(char.rlike("[0-9]"), _letter("0123456789", stream, i))
        .when(char.rlike(r"\p{Lu}"), F.upper(lower))
        .when(char.rlike(r"\p{L}"), lower)
        .otherwise(char)
    )


def _chars(text):
    return F.filter(F.split(text, ""), lambda c: c != "")


def _luhn(digits):
    """Luhn sum of a string of digits, last digit not doubled."""
    size = F.length(digits)

    def value(i):
        d = F.substr(digits, i, F.lit(1)).cast("int")
        twice = F.when(2 * d > 9, 2 * d - 9).otherwise(2 * d)
        return F.when((size - i) % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), size), F.lit(0), lambda a, i: a + value(i)) % 10


def _name(stream, attempt, syllables, endings):
    """A name built of syllables; later attempts have longer ones, so names never run out."""
    parts = F.transform(F.sequence(F.lit(0), 1 + F.floor(attempt / 4).cast("int")), lambda i: F.element_at(F.array(*map(F.lit, syllables)), _pick(stream, i, len(syllables)) + 1))
    end = F.element_at(F.array(*map(F.lit, endings)), _pick(stream, F.lit(2) + F.floor(attempt / 4).cast("int"), len(endings)) + 1)
    return F.concat(F.array_join(parts, ""), end)


_SYLLABLES = ["ba", "be", "do", "du", "fa", "ge", "ka", "ki", "lo", "lu", "ma", "mi", "no", "pa", "ro", "ru", "sa", "te", "vi", "zo"]
_SYLLABLES_CYRILLIC = ["ба", "во", "га", "до", "за", "ка", "ли", "мо", "ни", "ра", "со", "ту"]


def _surrogate(secret):
    """Surrogate of the columns kind, canonical and attempt, in canonical form."""
    kind, name, attempt = F.col("kind"), F.col("canonical"), F.col("attempt")
    length = F.length(name)
    stream = _stream(secret, kind, name, attempt, F.greatest(length, F.lit(64)))
    spelled = _once(stream, lambda s: F.array_join(F.transform(_chars(name), lambda c, i: _like(c, s, i)), ""))
    # The first digit of a number stays: it tells country codes and card kinds.
    number = F.concat(F.substr(name, F.lit(1), F.lit(1)), F.substr(spelled, F.lit(2), length))
    head = F.substr(number, F.lit(1), length - 1)
    checked = F.concat(head, F.pmod(10 - _luhn(F.concat(head, F.lit("0"))), F.lit(10)).cast("string"))
    digit = lambda c, s, i: (
        F.when(c.rlike("[A-F]"), _letter("ABCDEF", s, i))
        .when(c.rlike("[a-f]"), _letter("abcdef", s, i))
        .when(c == ":", c)
        .otherwise(_letter("0123456789", s, i))
    )
    hexadecimal = _once(stream, lambda s: F.array_join(F.transform(_chars(name), lambda c, i: digit(c, s, i)), ""))
    last_dot = length - F.locate(".", F.reverse(name))
    # Private addresses, then reserved ones, then any, so that they never run out.
    first = F.when(attempt < 4, F.lit(10)).when(attempt < 16, 240 + _pick(stream, F.lit(3), 16)).otherwise(1 + _pick(stream, F.lit(3), 254))
    octets = F.concat_ws(".", first.cast("string"), *[_pick(stream, F.lit(i), 256).cast("string") for i in range(3)])
    return (
        F.when(kind == "email", F.concat(F.substr(spelled, F.lit(1), last_dot), F.substr(name, last_dot + 1, length)))
        .when(kind == "ip", octets)
        .when(kind.isin("hex", "ip6"), hexadecimal)
        .when(kind == "account", F.concat(F.substr(name, F.lit(1), F.lit(2)), F.substr(spelled, F.lit(3), length)))
        .when((kind == "number") & (length >= 13) & (_luhn(name) == 0), checked)
        .when(kind == "number", number)
        .when(kind == "surname", _name(stream, attempt, _SYLLABLES, ["son", "berg", "ier", "ez", "mann", "ley"]))
        .when(kind == "surname_cyrillic", _name(stream, attempt, _SYLLABLES_CYRILLIC, ["енко", "ян", "ук", "их"]))
        .when(kind == "male", _name(stream, attempt, _SYLLABLES, ["o", "us", "rd", "n"]))
        .when(kind == "female", _name(stream, attempt, _SYLLABLES, ["a", "ia", "ine", "elle"]))
        .when(kind == "male_cyrillic", _name(stream, attempt, _SYLLABLES_CYRILLIC, ["н", "р", "слав", "мир"]))
        .when(kind == "female_cyrillic", _name(stream, attempt, _SYLLABLES_CYRILLIC, ["на", "лия", "ра", "вета"]))
        .otherwise(spelled)
    )


def assign_surrogates(entities: DataFrame, secret: str) -> DataFrame:
    """kind, canonical and surrogate of different (kind, canonical): no two of a kind get
    the same one, and none gets one that is itself an entity of its kind.

    Keyed hashes propose; where a proposal is taken, the entity that was first served, or
    else sorts first, keeps it, and the others try again, names with more syllables.
    """
    entities = staged(entities.select("kind", "canonical").distinct(), "entities")
    pending, done = entities.withColumn("attempt", F.lit(0)), None
    for _ in range(_MOST_ROUNDS):
        # Hashing is the work, and a written table of few bytes would be one task.
        tasks = pending.sparkSession.sparkContext.defaultParallelism * 4
        proposed = pending.repartition(tasks, "kind", "canonical").withColumn("surrogate", _surrogate(secret))
        real = entities.select(F.col("kind").alias("_kind"), F.col("canonical").alias("_real"))
        clash = (F.col("kind") == F.col("_kind")) & (F.col("surrogate") == F.col("_real"))
        free = proposed.join(real, clash, "left_anti")
        best = free.groupBy("kind", "surrogate").agg(F.min("canonical").alias("canonical"))
        if done is not None:
            best = best.join(done.select("kind", "surrogate"), ["kind", "surrogate"], "left_anti")
        served = best.select("kind", "canonical", "surrogate")
        done = staged(served if done is None else done.unionByName(served), "surrogates")
        rest = pending.join(done, ["kind", "canonical"], "left_anti").withColumn("attempt", F.col("attempt") + 1)
        pending = staged(rest, "entities-pending")
        if pending.isEmpty():
            return done
    raise RuntimeError(f"no free surrogates after {_MOST_ROUNDS} rounds")


def _written(kind, mention, surrogate):
    """The surrogate in the format of one mention."""
    filled = F.aggregate(
        _chars(mention),
        F.struct(F.lit("").alias("out"), F.lit(1).alias("at")),
        lambda a, c: F.struct(
            F.concat(a["out"], F.when(c.rlike("[0-9]"), F.substr(surrogate, a["at"], F.lit(1))).otherwise(c)).alias("out"),
            F.when(c.rlike("[0-9]"), a["at"] + 1).otherwise(a["at"]).alias("at"),
        ),
        lambda a: a["out"],
    )
    spaced = F.aggregate(
        _chars(mention),
        F.struct(F.lit("").alias("out"), F.lit(1).alias("at")),
        lambda a, c: F.struct(
            F.concat(a["out"], F.when(c == " ", c).otherwise(F.substr(surrogate, a["at"], F.lit(1)))).alias("out"),
            F.when(c == " ", a["at"]).otherwise(a["at"] + 1).alias("at"),
        ),
        lambda a: a["out"],
    )
    cased = F.array_join(
        F.zip_with(_chars(mention), _chars(surrogate), lambda c, x: F.when(c.rlike(r"\p{Lu}"), F.upper(x)).otherwise(x)), ""
    )
    shouted = F.when(mention == F.upper(mention), F.upper(surrogate)).otherwise(F.initcap(surrogate))
    return (
        F.when(kind == "number", filled)
        .when(kind == "account", spaced)
        .when(kind == "email", cased)
        .when(kind.isin("ip", "ip6", "secret", "hex"), surrogate)
        .otherwise(shouted)
    )


def _last_word(name):
    return F.element_at(F.split(name, " "), -1)


def _with_later_names(hits, value, own, row):
    """``hits`` with the untitled mentions of the full names and surnames that a title
    introduces in the same text, and the pattern of each text that finds them all."""
    given = lambda c: F.array_distinct(F.filter(c, lambda x: x != ""))
    wanted = lambda c: F.array_distinct(F.concat(given(c), F.transform(given(c), _last_word)))
    hits = hits.select(*own, "_mentions", "_male", "_female", row, wanted("_male").alias("_men"), wanted("_female").alias("_women"))
    longest = F.array_sort(F.array_union("_men", "_women"), lambda x, y: F.length(y) - F.length(x))
    names = F.concat(F.lit(PATTERN + r"|(?=\p{Lu})(?<![\p{L}\p{N}])("), F.array_join(longest, "|"), F.lit(r")(?![\p{L}\p{N}])"))
    named = F.size("_men") + F.size("_women") > 0
    hits = hits.select(*hits.columns, F.when(named, names).otherwise(F.lit(PATTERN)).alias("_pattern"), named.alias("_named"))
    again = [F.when(F.col("_named"), F.regexp_extract_all(value, F.col("_pattern"), F.lit(g))) for g in range(4)]
    hits = hits.select(*hits.columns, *[c.alias(f"_{g}") for g, c in enumerate(again)])
    man = lambda x: F.array_contains("_men", x)
    male = F.zip_with("_1", "_3", lambda t, x: F.when(t != "", t).when((x != "") & man(x), x).otherwise(""))
    female = F.zip_with("_2", "_3", lambda t, x: F.when(t != "", t).when((x != "") & ~man(x), x).otherwise(""))
    pick = lambda new, old: F.when(F.col("_named"), new).otherwise(F.col(old)).alias(old)
    return hits.select(*own, pick(F.col("_0"), "_mentions"), pick(male, "_male"), pick(female, "_female"), row, "_pattern")


def replace_entities(df: DataFrame, secret: str, text: str = "text") -> DataFrame:
    """``df`` with surrogates for the entities in ``text``, and n_entities (mentions).

    Found are names behind a title and, in the same text, their full name and surname without
    one, mail and network addresses, account numbers, tokens of 16 or more letters and digits, phone numbers and other long numbers. A surrogate has the
    kind, length, script, case and separators of the mention, a name the gender of its
    title; a number with a valid check digit gets a valid one. Mentions of one entity get
    one surrogate, in all documents; different entities never share one. The same
    ``secret`` and entities give the same surrogates.

    Missing texts stay missing with none; texts without entities are not shuffled and
    unchanged; copies, ties and missing keys make no difference. Other columns pass by; a
    column named n_entities is replaced; ``text`` keeps its place.
    """
    value, own = F.col(f"`{text}`"), [c for c in df.columns if c != "n_entities"]
    row = free_name("_row", df)
    passed = [F.col(f"`{c}`") for c in own]
    may_have = value.rlike("[0-9@]") | value.rlike(_TITLED)
    found = F.when(may_have, F.regexp_extract_all(value, F.lit(PATTERN), F.lit(0)))
    # A generator's output: filters on it are not worked out anew below.
    mentions = F.struct(F.coalesce(found, F.array().cast("array<string>")).alias("_mentions"))
    listed = df.select(*passed, F.inline(F.array(mentions)))
    clean = listed.filter(F.size("_mentions") == 0).select(*passed, F.lit(0).alias("n_entities"))
    none = F.array_repeat(F.lit(""), F.size("_mentions"))
    groups = [F.when(value.rlike(_TITLED), F.regexp_extract_all(value, F.lit(PATTERN), F.lit(g))).otherwise(none) for g in (1, 2)]
    hits = listed.filter(F.size("_mentions") > 0).select(
        *passed, "_mentions", groups[0].alias("_male"), groups[1].alias("_female"), F.monotonically_increasing_id().alias(row)
    )
    hits = staged(_with_later_names(hits, value, passed, row), "entity-texts")
    each = hits.select(row, F.posexplode(F.arrays_zip("_mentions", "_male", "_female")).alias("_at", "_m")).select(
        row, "_at", F.col("_m._mentions").alias("mention"), F.col("_m._male").alias("male"), F.col("_m._female").alias("female")
    )
    kinds = each.withColumn("kind", _kind(F.col("mention"), F.col("male"), F.col("female")))
    # The last name is a surname, those before it are given names.
    is_name = (F.col("male") != "") | (F.col("female") != "")
    words = F.when(is_name, F.split("mention", " ")).otherwise(F.array("mention"))
    parts = kinds.select(row, "_at", "kind", is_name.alias("is_name"), F.size(words).alias("n"), F.posexplode(words).alias("part", "mention"))
    surname = F.when(F.col("kind").endswith("cyrillic"), "surname_cyrillic").otherwise("surname")
    parts = parts.withColumn("kind", F.when(F.col("is_name") & (F.col("part") == F.col("n") - 1), surname).otherwise(F.col("kind")))
    parts = parts.withColumn("canonical", _canonical(F.col("kind"), F.col("mention")))
    known = assign_surrogates(parts, secret)
    written = parts.join(known, ["kind", "canonical"]).select(row, "_at", "part", _written(F.col("kind"), F.col("mention"), F.col("surrogate")).alias("new"))
    places = written.groupBy(row, "_at").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part", "new"))), lambda x: x["new"]), " ").alias("new"))
    # A text's own mentions are what a list can hold at most.
    lists = places.groupBy(row).agg(F.transform(F.sort_array(F.collect_list(F.struct("_at", "new"))), lambda x: x["new"]).alias("_new"))
    gaps = F.split(value, F.col("_pattern"), -1)
    woven = F.array_join(F.flatten(F.zip_with(gaps, F.col("_new"), lambda gap, new: F.array(gap, F.coalesce(new, F.lit(""))))), "")
    done = hits.join(lists, row).select(
        *[woven.alias(text) if c == text else F.col(f"`{c}`") for c in own], F.size("_mentions").alias("n_entities")
    )
    return clean.unionByName(done)
