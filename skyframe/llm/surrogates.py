"""Personal data and secrets replaced by keyed surrogates of the same type and form, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyframe.llm.common import packed
from skyframe.session import written

#: Forms of address and the gender that they tell.
MALE = ["Mr", "Herr", "Monsieur", "Señor", "Sr", "Don", "Signor", "Господин", "Κύριος"]
FEMALE = ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Doña", "Signora", "Госпожа", "Κυρία"]
EITHER = ["Dr", "Prof"]

TITLES = "|".join([*MALE, *FEMALE, *EITHER])
OCTET = r"(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
# A group under an open repeat is matched by recursion unless the repeat is possessive, and a long value would exhaust the
# stack: such repeats are possessive here, or bounded by the form itself (a domain has at most 127 labels).
NAME_WORD = r"\p{Lu}(?:-?\p{L}|['’](?!s(?!\p{L}))\p{L})++"
INITIAL = r"\p{Lu}\."
#: Every kind's form. Earlier ones win where several would start at one place.
FORMS = {
    "secret": r"""(?<=(?i:password|passwd|pwd|secret|token|api_key|apikey)["']{0,1}\s{0,2}[=:]\s{0,2}["']{0,1})"""
              r"""(?:(?<=")(?:[^"\\\r\n]|\\.){6,}+(?=")|(?<=')(?:[^'\\\r\n]|\\.){6,}+(?=')|[^\s"']{5,}[^\s"',;:.!?)\]}])""",
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]+\.){1,126}[A-Za-z]{2,}",
    "key": r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "ip": rf"(?<![0-9A-Za-z.])(?:{OCTET}\.){{3}}{OCTET}(?!\.?[0-9A-Za-z])",
    "card": r"(?<![0-9A-Za-z])(?:[0-9]{13,19}|[0-9]{4}(?: [0-9]{4}){3}|[0-9]{4}(?:-[0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z])(?:\+(?=(?:[ .()-]{0,3}[0-9]){7})[0-9]{1,3}(?:[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})){2,6}|(?:\([0-9]{2,4}\)[ .-]?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-][0-9]{4})(?![0-9A-Za-z])",
    "name": rf"(?<!\p{{L}})(?:(?:{TITLES})\.? ){{1,8}}(?:{INITIAL} )*+{NAME_WORD}(?: (?:{INITIAL} )*+{NAME_WORD})*+",
}
ANY = "|".join(f"(?:{form})" for form in FORMS.values())
#: How the numbers of card issuers begin.
ISSUERS = r"^(?:4|5[1-5]|2(?:22[1-9]|2[3-9]|[3-6]|7[01]|720)|3(?:[47]|0[0-5]|[689])|6(?:011|5|4[4-9]|22))"
#: What a text must have to be worth the whole pattern: a digit, an @, an assignment, or a title.
HINT = rf"[0-9@=:]|(?:{TITLES})\.? \p{{Lu}}"

SYLLABLES = ["ba", "be", "bo", "da", "de", "do", "fa", "fe", "ga", "go", "ka", "ke", "la", "le", "li", "lo", "ma", "me", "mi", "mo",
             "na", "ne", "ni", "no", "pa", "pe", "ra", "re", "ri", "ro", "sa", "se", "so", "ta", "te", "to", "va", "ve", "vi", "za"]
LATIN, CYRILLIC, GREEK = "abdefgiklmnoprstvz", "абдефгиклмнопрствз", "αβδεφγικλμνοπρστυζ"
ENDINGS = {"latin": {"m": "n", "f": "ana", "surname": "rt", "surname_m": "rt", "surname_f": "rt"},
           "cyrillic": {"m": "н", "f": "на", "surname": "енко", "surname_m": "ов", "surname_f": "ова"},
           "greek": {"m": "ος", "f": "να", "surname": "ίδη", "surname_m": "ίδης", "surname_f": "ίδου"}}

ROUNDS = 100  # attempts at surrogates that differ from each other and from all real values
WIDER = 8  # attempts after which an address of the small private network gets a surrogate in the large one


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn_sum(digits: Column, first: int) -> Column:
    """Luhn's sum; ``first`` is the place of the last digit, counted from the right."""
    def weigh(c, i):
        d = c.cast("int")
        twice = d * 2
        return F.when((i + first) % 2 == 1, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(d)

    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), weigh), F.lit(0), lambda s, x: s + x)


def kind_of(value: Column) -> Column:
    """The kind of a found value; null for a long number that is no card (by issuer and check digit)."""
    digits = digits_of(value)
    is_card = value.rlike(f"^{FORMS['card']}$")
    out = F.when(value.contains("@") & value.rlike(f"^{FORMS['email']}$"), "email").when(value.rlike(rf"^(?:{TITLES})\.? "), "name")
    for kind in ("key", "ssn", "ip"):
        out = out.when(value.rlike(f"^(?:{FORMS[kind]})$"), kind)
    out = out.when(value.rlike(f"^{FORMS['iban']}$") & ~value.rlike("^AKIA"), "iban")
    return out.when(is_card & (luhn_sum(digits, 0) % 10 == 0) & digits.rlike(ISSUERS), "card").when(is_card, F.lit(None)).when(value.rlike(f"^{FORMS['phone']}$"), "phone").otherwise("secret")


def title_of(value: Column) -> Column:
    """The forms of address that a name begins with, and the space behind them."""
    return F.regexp_extract(value, rf"^((?:(?:{TITLES})\.? ){{1,8}})", 1)


def words_of(value: Column) -> Column:
    """The words of a name behind its forms of address."""
    return F.split(F.substr(value, F.length(title_of(value)) + 1), " ")


def gender_of(value: Column) -> Column:
    titles = F.split(F.replace(F.trim(title_of(value)), F.lit("."), F.lit("")), " ")
    told = [F.arrays_overlap(titles, F.array(*map(F.lit, kind))) for kind in (MALE, FEMALE)]
    return F.when(told[0], "m").when(told[1], "f").otherwise("")


def script_of(word: Column) -> Column:
    return F.when(word.rlike(r"\p{IsCyrillic}"), "cyrillic").when(word.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def units_of(value: Column, kind: Column) -> Column:
    """What the surrogates of a value hang on: (kind, canonical form); the words of a name one by one, all else as one."""
    gender, words = gender_of(value), words_of(value)
    # The last word is the surname, keyed without gender, so that a family keeps one name; its form follows the gender.
    named = F.transform(words, lambda w, i: F.struct(
        F.concat(F.when(i == F.size(words) - 1, "surname").otherwise(F.concat(F.lit("first_"), gender)), F.lit(":"), script_of(w)).alias("unit"), F.lower(w).alias("canon")))
    digits = digits_of(value)
    canon = F.when(kind == "phone", F.when(F.length(digits) > 10, F.substring(digits, -10, 10)).otherwise(digits)).when(
        kind.isin("card", "ssn"), digits).when(kind == "iban", F.replace(value, F.lit(" "), F.lit(""))).when(kind == "email", F.lower(value)).otherwise(value)
    return F.when(kind == "name", named).otherwise(F.array(F.struct(kind.alias("unit"), canon.alias("canon"))))


def keyed(key: str, what: Column, again: Column) -> Column:
    """Hex digits of a keyed digest of a value, another for every attempt."""
    return F.sha2(F.concat_ws("\x1f", F.lit(key), what, again.cast("string"), F.lit(key)), 512)


def byte(digest: Column, i: Column) -> Column:
    """The i-th byte of a digest in hex, around its end again with a shift."""
    at = (i % 64) * 2 + 1
    return F.conv(F.substr(digest, at.cast("int"), F.lit(2)), 16, 10).cast("int") + (i / 64).cast("int") * 7


def one_of(letters: str, n: Column) -> Column:
    return F.substr(F.lit(letters), (n % len(letters) + 1).cast("int"), F.lit(1))


def same_form(value: Column, digest: Column, start: int = 0) -> Column:
    """Every letter and digit replaced by a keyed one of its class; what looks like hex stays hex."""
    hexed = value.rlike("^[0-9a-f]+$") & value.rlike("[0-9]") & value.rlike("[a-f]")

    def swap(c, i):
        n = byte(digest, i + start)
        return F.when(hexed, one_of("0123456789abcdef", n)).when(c.rlike("[0-9]"), one_of("0123456789", n)).when(
            c.rlike("[a-z]"), one_of("abcdefghijklmnopqrstuvwxyz", n)).when(c.rlike("[A-Z]"), one_of("ABCDEFGHIJKLMNOPQRSTUVWXYZ", n)).otherwise(c)

    return F.when(value == "", value).otherwise(F.array_join(F.transform(F.split(value, ""), swap), ""))


def iban_check(body: Column, country: Column) -> Column:
    """Check digits of an IBAN: 98 less the remainder by 97 of the number that its letters and digits spell."""
    def step(rest, c):
        n = F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55)
        return F.when(n > 9, rest * 100 + n).otherwise(rest * 10 + n) % 97

    return F.lpad((F.lit(98) - F.aggregate(F.split(F.concat(body, country, F.lit("00")), ""), F.lit(0), step)).cast("string"), 2, "0")


def surrogate(key: str, unit: Column, canon: Column, again: Column) -> Column:
    """The surrogate of a canonical value at an attempt. Later attempts may be longer where the form has little room."""
    digest = keyed(key, F.concat(unit, F.lit("\x1f"), canon), again)
    form = same_form(canon, digest)
    issuer = F.length(F.regexp_extract(canon, ISSUERS, 0))  # the issuer's digits stay
    body = F.concat(F.substr(canon, F.lit(1), issuer), F.substr(form, issuer + 1, F.length(canon) - 1 - issuer))
    card = F.concat(body, ((F.lit(10) - luhn_sum(body, 1) % 10) % 10).cast("string"))
    ssn = F.concat(one_of("12345", byte(digest, F.lit(60))), F.substr(form, F.lit(2)))
    phone = F.concat(one_of("23456789", byte(digest, F.lit(60))), F.substr(form, F.lit(2)))
    wide = (again >= WIDER) & canon.rlike(r"^192\.168\.")  # the small private network is full: the surrogate comes from the large one
    octets = F.transform(F.split(canon, r"\."), lambda o, i: F.when((i == 0) & wide, F.lit("10")).when(
        ((i == 0) & canon.rlike(r"^(?:10|127|192\.168)\.")) | ((i == 1) & canon.rlike(r"^192\.168\.") & ~wide), o).otherwise((byte(digest, i * 2) * 256 + byte(digest, i * 2 + 1)).cast("int") % 254 + 1))
    local, domain = F.substring_index(canon, "@", 1), F.substring_index(canon, "@", -1)
    reserved = domain.rlike(r"(^|\.)example\.(com|org|net)$")  # names that belong to nobody stay
    host = F.regexp_extract(domain, r"^(.*)\.[a-z]+$", 1)
    shifted = F.concat(same_form(host, keyed(key, F.concat(F.lit("domain\x1f"), domain), F.lit(0))), F.lit("."), F.substring_index(domain, ".", -1))
    more = F.substr(F.translate(digest, "0123456789", "ghijklmnop"), F.lit(1), F.greatest(F.lit(0), again - 3).cast("int"))
    email = F.concat(same_form(local, digest), more, F.lit("@"), F.when(reserved, domain).otherwise(shifted))
    country = F.substring(canon, 1, 2)
    account = F.substr(form, F.lit(5))
    iban = F.concat(country, iban_check(account, country), account)
    aws = F.concat(F.lit("AKIA"), F.substr(form, F.lit(5)))
    count = F.lit(2) + (again / 2).cast("int")
    stem = F.array_join(F.transform(F.sequence(F.lit(1), count), lambda i: F.element_at(F.array(*map(F.lit, SYLLABLES)), (byte(digest, i) % len(SYLLABLES) + 1).cast("int"))), "")
    script = F.substring_index(unit, ":", -1)
    spelled = F.when(script == "cyrillic", F.translate(stem, LATIN, CYRILLIC)).when(script == "greek", F.translate(stem, LATIN, GREEK)).otherwise(stem)
    names = unit.contains(":")
    secret = F.when(F.length(form) == 0, form).otherwise(F.concat(form, more))
    return F.when(unit == "card", card).when(unit == "ssn", ssn).when(unit == "phone", phone).when(unit == "ip", F.array_join(octets.cast("array<string>"), ".")).when(
        unit == "email", email).when(unit == "iban", iban).when(unit == "key", aws).when(names, spelled).otherwise(secret)


def finished(unit: Column, stem: Column) -> Column:
    """All spellings, in lower case, that a surrogate can have in a text: a name's stem with every ending of its place."""
    out = F.array(stem)
    for script, forms in ENDINGS.items():
        surnames = dict.fromkeys(forms[k] for k in ("surname", "surname_m", "surname_f"))
        out = F.when(unit == f"surname:{script}", F.array(*[F.concat(stem, F.lit(e)) for e in surnames])).when(
            unit == f"first_f:{script}", F.array(F.concat(stem, F.lit(forms["f"])))).when(
            unit.startswith("first_") & unit.endswith(f":{script}"), F.array(F.concat(stem, F.lit(forms["m"])))).otherwise(out)
    return out


def distinct_surrogates(units: DataFrame, key: str) -> DataFrame:
    """``unit``, ``canon``, ``surrogate`` of all distinct values: no two of a kind share a surrogate, and none is a value that
    occurs in the corpus itself. A name counts as it is written, stem and ending, against all real words of names.

    All values are tried at once; of those that share a surrogate the smallest keeps it, the others and those that hit a
    real value try again with the next digest. The driver sees one number a round; the table has one row per value.
    E-mail addresses, secrets and names grow from attempt to attempt, addresses of 192.168 go over to 10; where a form of
    fixed length has no room left after ``ROUNDS`` attempts, a ValueError says which.
    """
    rows = written(units.select("unit", "canon").distinct().withColumn("again", F.lit(0)), "values")
    space = F.when(F.col("unit").contains(":"), F.lit("name")).otherwise(F.col("unit"))
    real = rows.select(space.alias("_space"), F.col("canon").alias("_form")).distinct()
    for _ in range(ROUNDS):
        tried = rows.withColumn("surrogate", surrogate(key, F.col("unit"), F.col("canon"), F.col("again")))
        hit = tried.select("unit", "canon", space.alias("_space"), F.explode(finished(F.col("unit"), F.col("surrogate"))).alias("_form"))
        hit = hit.join(real, ["_space", "_form"]).select("unit", "canon").distinct().withColumn("_real", F.lit(True))
        place = F.row_number().over(Window.partitionBy("unit", "surrogate").orderBy("again", "canon"))
        checked = tried.withColumn("_place", place).join(hit, ["unit", "canon"], "left")
        checked = written(checked.select("unit", "canon", "again", "surrogate", ((F.col("_place") > 1) | F.col("_real").isNotNull()).alias("_taken")), "surrogates")
        open_ = checked.filter("_taken").select("unit").limit(1).collect()
        if not open_:
            return checked.select("unit", "canon", "surrogate")
        rows = checked.select("unit", "canon", (F.col("again") + F.col("_taken").cast("int")).alias("again"))
    raise ValueError(f"No room for distinct surrogates of kind {open_[0].unit!r} after {ROUNDS} attempts")


def filled(value: Column, digits: Column) -> Column:
    """The value with its last digits replaced, in order; its form and what comes before them stay."""
    own = F.length(digits_of(value))
    keep = own - F.length(digits)

    def put(c, i):
        at = F.length(digits_of(F.substr(value, F.lit(1), (i + 1).cast("int"))))
        return F.when(c.rlike("[0-9]") & (at > keep), F.substr(digits, (at - keep).cast("int"), F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.split(value, ""), put), "")


def named(value: Column, parts: Column) -> Column:
    """A title and its surrogate names, in the case of the original words and, in Cyrillic and Greek, the title's gender."""
    title, gender, words = title_of(value), gender_of(value), words_of(value)

    def ending(script, last):
        forms = ENDINGS[script]
        family = F.when(gender == "m", forms["surname_m"]).when(gender == "f", forms["surname_f"]).otherwise(forms["surname"])
        return F.when(last, family).otherwise(F.when(gender == "f", forms["f"]).otherwise(forms["m"]))

    def word(w, i):
        last = i == F.size(words) - 1
        script = script_of(w)
        whole = F.concat(F.element_at(parts, (i + 1).cast("int")), F.when(script == "cyrillic", ending("cyrillic", last)).when(script == "greek", ending("greek", last)).otherwise(ending("latin", last)))
        initial = F.concat(F.upper(F.substring(whole, 1, 1)), F.lit("."))
        return F.when(w.endswith("."), initial).when((F.length(w) > 1) & (F.upper(w) == w), F.upper(whole)).otherwise(F.initcap(whole))

    return F.concat(title, F.array_join(F.transform(words, word), " "))


def rendered(value: Column, kind: Column, parts: Column) -> Column:
    """The replacement in the original's form: its separators, its case, its spaces."""
    one = F.element_at(parts, 1)
    spaced = F.array_join(F.transform(F.split(value, ""), lambda c, i: F.when(c == " ", c).otherwise(
        F.substr(one, F.length(F.replace(F.substr(value, F.lit(1), (i + 1).cast("int")), F.lit(" "), F.lit(""))).cast("int"), F.lit(1)))), "")
    return F.when(kind.isin("phone", "card", "ssn"), filled(value, one)).when(kind == "name", named(value, parts)).when(kind == "iban", spaced).when(
        (kind == "email") & (F.upper(value) == value), F.upper(one)).otherwise(one)


def with_surrogates(docs: DataFrame, key: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``rest`` (a struct of the other columns), ``text`` with every entity replaced, ``entities`` (kind, value and
    surrogate, in order of place).

    Entities: e-mail and IP addresses, phone, card, account and social security numbers, access keys, assigned secrets, and
    names behind a form of address, with the bare repeats of their surnames in the same document. One value has one surrogate in the whole corpus, however it is written (digits of a
    phone number, case of an address, a surname by itself), two values never share one, and no surrogate is a real value.
    Surrogates keep type and form: separators, letter case, check digits, country codes, private networks, reserved
    domains, script, and the gender of the address. Long numbers that are no cards stay.

    Null texts stay null, empty ones empty, both without entities. Null and repeated doc_ids are treated like any other;
    whole texts are searched. An empty table gives no rows. The same key gives the same surrogates in every run over the
    same values.
    """
    rows = packed(docs, text, id)
    found = F.col("text").rlike(HINT) & F.col("text").rlike(ANY)
    clean = rows.filter(~F.coalesce(found, F.lit(False)))
    kept = F.struct("kind", "value", "surrogate")
    none = F.array().cast("array<struct<kind:string,value:string,surrogate:string>>")
    # Only texts with entities are cut up, written and shuffled; the others pass through.
    # A surname that stands behind a form of address is looked for in its whole document, by a pattern of the document's own.
    titled = F.filter(F.regexp_extract_all("text", F.lit(ANY), F.lit(0)), lambda v: title_of(v) != "")
    surnames = F.transform(titled, lambda v: F.struct(F.element_at(words_of(v), -1).alias("word"), title_of(v).alias("title")))
    seen = rows.filter(found).select("doc_id", "rest", "text", surnames.alias("_surnames"))
    spelled = F.array_distinct(F.flatten(F.transform("_surnames", lambda n: F.array(n.word, F.upper(n.word), F.initcap(n.word)))))
    bare = F.concat(F.lit(ANY + r"|(?<!\p{L})(?:"), F.array_join(spelled, "|"), F.lit(r")(?!\p{L})"))
    seen = seen.withColumn("_form", F.when(F.size("_surnames") > 0, bare).otherwise(ANY))
    cut = seen.select("doc_id", "rest", F.xxhash64("doc_id", "text").alias("_row"), "_surnames", F.split("text", F.col("_form"), -1).alias("_between"),
                      F.regexp_extract_all("text", F.col("_form"), F.lit(0)).alias("_found"))
    cut = written(cut, "entities")
    one = cut.dropDuplicates(["_row"]).select("_row", "_surnames", F.posexplode("_found").alias("_at", "value"))
    # A bare surname is read as if the title of its first bearer stood before it.
    bearer = F.filter("_surnames", lambda n: F.lower(n.word) == F.lower("value"))
    one = one.select("_row", "_at", "value", F.when(F.size(bearer) > 0, F.element_at(bearer, 1).title).otherwise("").alias("_title"))
    one = one.withColumn("_whole", F.concat("_title", "value")).withColumn("kind", kind_of(F.col("_whole")))
    units = one.filter("kind is not null").select("*", F.posexplode(units_of(F.col("_whole"), F.col("kind"))).alias("_unit_at", "u")).select(
        "_row", "_at", "value", "_title", "kind", "_unit_at", "u.unit", "u.canon")
    units = written(units, "units")
    known = distinct_surrogates(units, key)
    per = units.join(known, ["unit", "canon"]).groupBy("_row", "_at", "value", "_title", "kind").agg(F.array_sort(F.collect_list(F.struct("_unit_at", "surrogate"))).alias("_parts"))
    per = per.withColumn("surrogate", F.substr(rendered(F.concat("_title", "value"), F.col("kind"), F.col("_parts.surrogate")), F.length("_title") + 1))
    swaps = per.groupBy("_row").agg(F.map_from_entries(F.collect_list(F.struct("_at", kept))).alias("_swaps"))  # bounded by the text's own entities
    joined = cut.join(swaps, "_row", "left")
    whole = F.array_join(F.flatten(F.transform("_found", lambda v, i: F.array(F.element_at("_between", (i + 1).cast("int")), F.coalesce(F.col("_swaps")[i]["surrogate"], v)))), "")
    text_out = F.concat(whole, F.element_at("_between", -1))
    entities = F.filter(F.transform("_found", lambda v, i: F.col("_swaps")[i]), lambda e: e.isNotNull())
    changed = joined.select("doc_id", "rest", text_out.alias("text"), F.coalesce(entities, none).alias("entities"))
    return clean.select("doc_id", "rest", "text", none.alias("entities")).unionByName(changed)
