"""Surrogate generation for personal data (operator 10), in DataFrame functions only.

Detected entities are replaced by keyed, type-consistent surrogates: digits stay digits, letters
keep their case, separators stay, card numbers keep their first digit and a valid check digit,
IP addresses stay valid (in the unassigned block 240/4), e-mail hosts end in a reserved example
domain, secrets keep their shape, and names after a form of address keep gender, script, case,
particles and number of words (the surrogate depends on each name word, so "Mr Ann Lee" and "Ms
Lee" still share their last name; initials become other initials). A given name after a form of
address without gender ("Dr Anna Weber") takes the gender that the corpus shows for it elsewhere,
if that is one only. Capitalised mentions of a name word elsewhere in the same document get its
surrogate too. The same value gets the same surrogate in every document.

All distinct values of the corpus form one table. Surrogates are checked there: two values with
one surrogate, or a surrogate that is itself a value of the corpus, get the next attempt of the
keyed function until nothing collides. Names and e-mail hosts get longer with every attempt, the
other kinds from attempt ``WIDER`` on, so that a format with fewer values than the corpus ends too.
Texts are then rebuilt from their parts between entities.

Defined cases: null text stays null, empty text stays empty; texts without entities are
unchanged; numbers of card length with a wrong check digit are not card numbers and stay; equal
texts get equal results; all other columns pass as they are, whatever their names.
"""

from __future__ import annotations

import hashlib
import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazelake.llm.arrays import unused
from hazelake.session import materialize

DEMO_KEY = "surrogates-demo-key"  # production passes its own secret
WIDER = 20  # from this attempt on a surrogate gets digits that its format does not have

_MALE = "Mr|Herr|Monsieur|Señor|Sr|Don|Signor|Господин|Г-н|Κύριος"
_FEMALE = "Mrs|Ms|Miss|Frau|Madame|Mme|Mlle|Señora|Sra|Señorita|Doña|Signora|Господжа|Госпожа|Г-жа|Κυρία"
_NEUTRAL = "Dr|Prof"
_TITLES = "|".join(t for title in f"{_MALE}|{_FEMALE}|{_NEUTRAL}".split("|") for t in dict.fromkeys((title, title.upper())))
_MORE = "|".join(t for title in _NEUTRAL.split("|") for t in (title, title.upper()))
_PARTICLE = "von|vom|van|de|del|della|di|da|do|dos|das|du|des|zu|zur|af|av|ter|ten|bin|ibn|al|el|la|le|y|e|фон|ван|де"
_AFTER = "der|den|dem|la|las|los|het"  # only after another particle
#: A name word without a possessive s; prefixes like d’ and al- belong to it.
_TAIL = r"(?:[’'-](?![sS](?![\p{L}\p{M}]))[\p{L}\p{M}]+)"
_NAME_WORD = rf"(?:[dl][’']|(?:al|el)-)?\p{{Lu}}(?:[\p{{L}}\p{{M}}]+{_TAIL}*+|{_TAIL}++)"
_PARTICLES = rf"(?:(?:{_PARTICLE})(?: (?:{_AFTER}))? ){{0,2}}"
_INITIALS = rf"(?:(?:\p{{Lu}}\p{{M}}*+\.(?:-(?=\p{{Lu}}\p{{M}}*+\.))?)++(?!\p{{L}})|\p{{Lu}}\p{{M}}*(?= {_PARTICLES}{_NAME_WORD}))"
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"

EMAIL = r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@(?:[A-Za-z0-9-]{1,63}+\.){1,10}[A-Za-z]{2,24}"
SECRET_MARK = r"(?i:token|secret|password|passwd|pwd|api[_-]?key)[ ]{0,2}[=:][ ]{0,2}[\"']?"
#: To white space, a quote, a bracket or a separator; the punctuation that ends a sentence stays out.
SECRET = SECRET_MARK + r"[!-~&&[^\"'`,;&<>(){}\[\]|\\]]{7,}[A-Za-z0-9+/_=-]"
CLOUD_KEY = r"AKIA[0-9A-Z]{16}(?![A-Za-z0-9])"
IPV4 = rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9]|\.[0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
PHONE = r"(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){2,4}|\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}|[0-9]{3}-[0-9]{3}-[0-9]{4})(?![0-9])"
CARD = r"[0-9](?:[ -]?[0-9]){12,18}(?![0-9])"
NAME = rf"(?<!\p{{L}})(?:{_TITLES})\.?(?: (?:{_MORE})\.?(?= ))*+(?: (?:{_PARTICLES}{_NAME_WORD}|{_INITIALS}))++"
MENTION = rf"(?<![\p{{L}}\p{{M}}]){_NAME_WORD}"
KINDS = (("email", EMAIL), ("cloud_key", CLOUD_KEY), ("secret", SECRET), ("ipv4", IPV4), ("ssn", SSN), ("phone", PHONE), ("card", CARD), ("name", NAME))
#: Entities start where no ASCII letter or digit stands before; the first character picks the kinds to try.
ANY = (rf"(?<![A-Za-z0-9])(?:(?=[A-Za-z0-9])(?:{EMAIL}|{CLOUD_KEY})|(?=[TtSsPpAa]){SECRET}"
       rf"|(?=[0-9+(])(?:{IPV4}|{SSN}|{PHONE}|{CARD})|(?=\p{{Lu}}){NAME})")

_SYLLABLES = {"latin": "ba be bi bo da de di do ka ke ki ko la le li lo ma me mi mo na ne ni no ra re ri ro ta te ti to",
              "cyrillic": "ба бе би бо да де ди до ка ке ки ко ла ле ли ло ма ме ми мо на не ни но ра ре ри ро та те ти то",
              "greek": "βα βε βι βο δα δε δι δο κα κε κι κο λα λε λι λο μα με μι μο να νε νι νο ρα ρε ρι ρο τα τε τι το"}
_ENDINGS = {("latin", "m"): "n", ("latin", "f"): "na", ("latin", "n"): "le", ("latin", "last"): "rsen",
            ("cyrillic", "m"): "н", ("cyrillic", "f"): "на", ("cyrillic", "n"): "ль", ("cyrillic", "last"): "енко",
            ("greek", "m"): "ς", ("greek", "f"): "να", ("greek", "n"): "λι", ("greek", "last"): "κης"}
_LETTERS = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ",
            "ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞĆČĎĐĘĚĞĽŁŃŇŐŒŘŚŞŠŤŮŰŹŻŽ")


def kind_of(value: Column) -> Column:
    """Type of a matched value."""
    out = F.lit("name")
    for kind, pattern in reversed(KINDS):
        out = F.when(value.rlike(f"^(?:{pattern})$"), kind).otherwise(out)
    return out


def mark_of(kind: Column, value: Column) -> Column:
    """What stays before the private part of a match: the words that mark a secret."""
    return F.when(kind == "secret", F.regexp_extract(value, f"^{SECRET_MARK}", 0)).otherwise("")


def luhn_sum(digits: Column, doubled: int) -> Column:
    """Luhn sum of a digit string; of the places counted from the right, those that are
    ``doubled`` modulo 2 count twice."""
    backwards = F.reverse(digits)

    def step(total, i):
        d = F.substring(backwards, i + 1, F.lit(1)).cast("int")
        return total + F.when(i % 2 == doubled, 2 * d - F.when(d > 4, 9).otherwise(0)).otherwise(d)
    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), step)


def real(kind: Column, value: Column) -> Column:
    """False for matches that are no entity: card-like numbers with a wrong check digit."""
    return (kind != "card") | (luhn_sum(F.regexp_replace(value, "[^0-9]", ""), 1) % 10 == 0)


def keyed_bytes(key: str, kind: Column, value: Column, attempt: Column) -> Column:
    """128 keyed bytes as hex text."""
    seed = F.concat_ws("\u0001", F.lit(key), kind, attempt.cast("string"), value)
    return F.concat(F.sha2(F.concat(F.lit("0"), seed), 512), F.sha2(F.concat(F.lit("1"), seed), 512))


def byte_at(stream: Column, i: Column) -> Column:
    """Byte i of a hex stream, as a number (the stream repeats after 128)."""
    return F.conv(F.substring(stream, (2 * (i % 128) + 1).cast("int"), F.lit(2)), 16, 10).cast("int")


def same_shape(value: Column, stream: Column) -> Column:
    """Every ASCII letter and digit replaced by another of its class; the rest stays. A value of
    hexadecimal digits only stays one."""
    hexa = value.rlike("^[0-9a-f]+$") | value.rlike("^[0-9A-F]+$")
    letters = F.when(hexa, 6).otherwise(26)

    def char(c, i):
        b = byte_at(stream, i)
        pick = lambda first: F.char(b % letters + ord(first))
        return (F.when(c.between("0", "9"), (b % 10).cast("string")).when(c.between("a", "z"), pick("a"))
                .when(c.between("A", "Z"), pick("A")).otherwise(c))
    return F.array_join(F.transform(F.split(value, ""), char), "")


def name_word(script: Column, role: Column, stream: Column, attempt: Column) -> Column:
    """A name of four syllables, one more with each attempt, and an ending for its role: m, f, n (given names) or last."""
    def stem_of(pool):
        return F.array_join(F.transform(F.sequence(F.lit(0), 3 + attempt), lambda i: F.get(pool, byte_at(stream, i) % 32)), "")
    out = F.lit(None).cast("string")
    for s, syllables in _SYLLABLES.items():
        stem = stem_of(F.array(*[F.lit(x) for x in syllables.split()]))
        for r in ("m", "f", "n", "last"):
            out = F.when((script == s) & (role == r), F.concat(stem, F.lit(_ENDINGS[s, r]))).otherwise(out)
    return out


def with_surrogate(values: DataFrame, key: str) -> DataFrame:
    """Adds the surrogate of (kind, value, attempt). Name words have kinds like ``name/latin/f``."""
    steps = values.withColumn("__stream", keyed_bytes(key, F.col("kind"), F.col("value"), F.col("attempt")))
    steps = steps.withColumn("__shaped", same_shape(F.col("value"), F.col("__stream")))
    steps = steps.withColumn("__payload", F.concat(F.substring("value", 1, 1), F.expr("substring(__shaped, 2, length(value) - 2)")))
    steps = steps.withColumn("__check", (10 - luhn_sum(F.regexp_replace("__payload", "[^0-9]", ""), 0) % 10) % 10)
    return steps.withColumn("surrogate", _surrogate()).drop("__stream", "__shaped", "__payload", "__check")


def _surrogate() -> Column:
    kind, value, stream, shaped, attempt = (F.col(c) for c in ("kind", "value", "__stream", "__shaped", "attempt"))
    card = F.concat("__payload", F.col("__check").cast("string"))  # a card number ends in its check digit
    local = F.substring_index(value, "@", 1)
    host = F.substring_index(value, "@", -1)
    tld = F.element_at(F.array(F.lit("com"), F.lit("net"), F.lit("org")), byte_at(stream, F.lit(127)) % 3 + 1)
    label = F.concat(F.lit("h"), F.substring(stream, F.lit(121), F.greatest(F.lit(3), F.least(F.lit(10), F.length(F.substring_index(host, ".", 1)) - 1)) + attempt))
    email = F.concat(same_shape(local, stream), F.lit("@"), label, F.lit(".example."), tld)
    octet = lambda i: byte_at(stream, F.lit(i)).cast("string")
    ip = F.concat_ws(".", (240 + byte_at(stream, F.lit(0)) % 16).cast("string"), octet(1), octet(2), octet(3))
    country = F.regexp_extract(value, r"^\+[0-9]{1,3}(?=[ .(-])", 0)
    phone = F.concat(country, F.substring(shaped, F.length(country) + 1, F.length(value)))
    part = F.split(kind, "/")
    by_shape = (F.when(kind == "ipv4", ip).when(kind == "card", card).when(kind == "phone", phone)
                .when(kind == "ssn", F.concat(F.lit("9"), F.substring(shaped, F.lit(2), F.length(value))))
                .when(kind == "cloud_key", F.concat(F.lit("AKIA"), F.substring(shaped, F.lit(5), F.length(value)))).otherwise(shaped))
    digits = F.translate(F.substring(stream, F.lit(1), F.greatest(F.lit(0), attempt - (WIDER - 1))), "abcdef", "012345")
    return (F.when(kind == "email", email).when(kind.startswith("name/"), name_word(F.get(part, F.lit(1)), F.get(part, F.lit(2)), stream, attempt))
            .otherwise(F.concat(by_shape, digits)))


def script_of(word: Column) -> Column:
    return F.when(word.rlike(r"\p{IsCyrillic}"), "cyrillic").when(word.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def initials(word: Column, key: str) -> Column:
    """Every initial turned by a keyed step in its alphabet, so that different ones stay different;
    capitals outside these alphabets become some Latin letter."""
    steps = hashlib.sha256(f"{key}\u0001initials".encode()).digest()
    turned = "".join(x[(k := 1 + steps[i] % (len(x) - 1)):] + x[:k] for i, x in enumerate(_LETTERS))
    known = "".join(_LETTERS)
    return F.translate(F.regexp_replace(word, rf"[\p{{Lu}}&&[^{known}]]\p{{M}}*", "X"), known, turned)


def is_initials(word: Column) -> Column:
    return word.rlike(r"^(?:\p{Lu}\p{M}*+|(?:\p{Lu}\p{M}*+\.-?)++)$")


def is_name_word(word: Column) -> Column:
    return ~(is_initials(word) | word.rlike(rf"^(?:(?:{_MORE})\.?|{_PARTICLE}|{_AFTER})$"))


def with_name_words(kinds: DataFrame) -> DataFrame:
    """Adds the words of names, the place of the last name and the gender of the form of address."""
    name = F.col("kind") == "name"
    title = F.regexp_replace(F.substring_index("value", " ", 1), r"\.$", "")
    gender = F.when(title.rlike(f"^(?i:{_MALE})$"), "m").when(title.rlike(f"^(?i:{_FEMALE})$"), "f").otherwise("n")
    words = F.split("value", " ")
    last = F.array_max(F.transform(words, lambda w, i: F.when((i > 0) & is_name_word(w), i)))
    return kinds.select("*", F.md5("value").alias("id"), F.when(name, words).alias("words"), F.when(name, last).alias("last"), F.when(name, gender).alias("gender"))


def name_parts(names: DataFrame) -> DataFrame:
    """(id, pos, word, kind) of every name's words, from stored columns of ``with_name_words``: a
    name may be long. Forms of address (one comes first), particles and initials have no kind."""
    return names.select("id", "last", "gender", F.posexplode("words").alias("pos", "word")).select(
        "id", "pos", "word",
        F.when((F.col("pos") > 0) & is_name_word(F.col("word")),
               F.concat(F.lit("name/"), script_of(F.col("word")), F.lit("/"), F.when(F.col("pos") == F.col("last"), "last").otherwise(F.col("gender")))).alias("kind"))


def with_gender(parts: DataFrame) -> DataFrame:
    """Given names of unknown gender take the one that the corpus shows for their word, if it is one only."""
    gender = F.element_at(F.split("kind", "/"), -1)
    shown = parts.where(gender.isin("m", "f")).groupBy(F.lower("word").alias("__word")).agg(F.min("kind").alias("__low"), F.max("kind").alias("__high"))
    one = shown.where("__low = __high").select("__word", F.col("__low").alias("__kind"))
    is_open = F.coalesce(gender == "n", F.lit(False))
    settled = parts.where(is_open).join(one, F.lower("word") == F.col("__word"), "left").select("id", "pos", "word", F.coalesce("__kind", "kind").alias("kind"))
    return parts.where(~is_open).unionByName(settled)


def settle(values: DataFrame, key: str) -> DataFrame:
    """(kind, value, surrogate) without collisions, for distinct (kind, value). A surrogate stays
    with the value that has it at the lowest attempt (then the smallest value)."""
    now = materialize(with_surrogate(values.select("kind", "value", F.lit(0).alias("attempt")), key), "pii-values")
    taken = values.select(F.lower("value").alias("__taken")).distinct()
    for _ in itertools.count():
        first = now.groupBy("surrogate").agg(F.min(F.struct("attempt", "kind", "value")).alias("__first"), F.count("*").alias("__n")).join(
            taken, F.lower("surrogate") == F.col("__taken"), "left").where((F.col("__n") > 1) | F.col("__taken").isNotNull())
        first = materialize(first.select(F.col("surrogate").alias("__s"), "__first", F.col("__taken").isNotNull().alias("__used")), "pii-collisions")
        if first.isEmpty():
            return now.drop("attempt")
        again = F.coalesce(F.col("__used") | (F.struct("attempt", "kind", "value") != F.col("__first")), F.lit(False))
        marked = now.join(first, F.col("surrogate") == F.col("__s"), "left").select("kind", "value", "attempt", "surrogate", again.alias("__again"))
        moved = with_surrogate(marked.where("__again").select("kind", "value", (F.col("attempt") + 1).alias("attempt")), key)
        now = materialize(marked.where("not __again").drop("__again").unionByName(moved), "pii-values")


def surrogate_table(matches: DataFrame, key: str) -> DataFrame:
    """(value, surrogate, words) of all distinct matches (column value) that are entities; words
    are a name's words with their surrogates, last names first."""
    kinds = matches.select("value").distinct().withColumn("kind", kind_of(F.col("value")))
    kinds = kinds.where(real(F.col("kind"), F.col("value"))).withColumn("mark", mark_of(F.col("kind"), F.col("value")))
    kinds = materialize(with_name_words(kinds.withColumn("core", F.expr("substring(value, length(mark) + 1)"))), "pii-kinds")
    parts = with_gender(materialize(name_parts(kinds.where(F.col("kind") == "name")), "pii-parts"))
    words = parts.where(F.col("kind").isNotNull()).select("kind", F.lower("word").alias("value")).distinct()
    cores = kinds.where(F.col("kind") != "name").select("kind", F.col("core").alias("value")).distinct()
    settled = settle(cores.unionByName(words), key)
    w = settled.select(F.col("kind").alias("__k"), F.col("value").alias("__w"), F.col("surrogate").alias("__s"))
    named = parts.join(w, (F.col("kind") == F.col("__k")) & (F.lower("word") == F.col("__w")), "left")
    initial = (F.col("pos") > 0) & F.col("kind").isNull() & is_initials(F.col("word"))
    new = F.when(initial, initials(F.col("word"), key)).when(F.col("__s").isNull(), F.col("word")).otherwise(cased(F.col("word"), F.col("__s")))
    word = F.when(F.col("__s").isNotNull(), F.struct(F.col("__w").alias("word"), (~F.col("kind").endswith("/last")).alias("given"), F.col("__s").alias("s")))
    names = named.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("pos", new.alias("w")))).alias("__ws"), F.collect_list(word).alias("words"))
    names = kinds.where(F.col("kind") == "name").select("id", "value").join(names, "id").select(
        "value", F.array_join(F.col("__ws.w"), " ").alias("surrogate"), "words")
    others = kinds.where(F.col("kind") != "name").join(w, (F.col("kind") == F.col("__k")) & (F.col("core") == F.col("__w")))
    none = F.lit(None).cast("array<struct<word:string,given:boolean,s:string>>")
    return others.select("value", F.concat("mark", "__s").alias("surrogate"), none.alias("words")).unionByName(names)


def cased(word: Column, surrogate: Column) -> Column:
    return F.when((word == F.upper(word)) & (F.length(word) > 1), F.upper(surrogate)).otherwise(F.initcap(surrogate))


def mentions(part: Column, words: Column) -> Column:
    """Pieces (text, n) of a text part; n is the number of name words that the piece replaces."""
    def one(word):
        return cased(word, words[F.lower(word)])

    def swap(token):
        whole = F.map_contains_key(words, F.lower(token))
        some = F.filter(F.split(token, "-"), lambda x: F.map_contains_key(words, F.lower(x)))
        by_part = F.array_join(F.transform(F.split(token, "-"), lambda x: F.coalesce(one(x), x)), "-")
        return F.struct(F.when(whole, one(token)).otherwise(by_part).alias("t"), F.when(whole, 1).otherwise(F.size(some)).alias("n"))
    between = F.transform(F.split(part, MENTION, -1), lambda x: F.struct(x.alias("t"), F.lit(0).alias("n")))
    tokens = F.transform(F.regexp_extract_all(part, F.lit(MENTION), F.lit(0)), swap)
    return F.flatten(F.zip_with(between, tokens, lambda x, y: F.array(x, F.coalesce(y, F.struct(F.lit("").alias("t"), F.lit(0).alias("n"))))))


def replace(docs: DataFrame, key: str = DEMO_KEY, text: str = "text", out_count: str | None = None) -> DataFrame:
    """``docs`` with surrogates in ``text``; ``out_count`` names an added column of replaced entities,
    mentions of name words included."""
    names = docs.columns
    c_text, c_map, c_words, c_parts = unused([*names, out_count or ""], "text_id", "surrogate_of", "name_words", "text_parts")
    docs = docs.withColumn(text, F.col(text).cast("string"))
    body = F.col(f"`{text}`")
    found = F.regexp_extract_all(body, F.lit(ANY), F.lit(0))
    marked = docs.where(F.coalesce(body.rlike(ANY), F.lit(False)))
    clean = docs.where(~F.coalesce(body.rlike(ANY), F.lit(False)))
    per_text = marked.select(F.md5(body).alias("text_id"), F.array_distinct(found).alias("found"))
    pairs = materialize(per_text.select("text_id", F.explode("found").alias("value")).distinct(), "pii-matches")
    table = materialize(surrogate_table(pairs, key), "pii-surrogates")
    maps = pairs.join(table, "value").groupBy("text_id").agg(
        F.map_from_entries(F.collect_list(F.struct("value", "surrogate"))).alias("map"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("words")))).alias("every"))
    every = F.col("every")
    chosen = F.filter(every, lambda x, i: (i == 0) | (F.get(every, i - 1)["word"] != x["word"]))  # a last name before a given name
    maps = maps.select(F.col("text_id").alias(c_text), F.col("map").alias(c_map),
                       F.map_from_entries(F.transform(chosen, lambda x: F.struct(x["word"], x["s"]))).alias(c_words))
    joined = marked.withColumn(c_text, F.md5(body)).join(maps, c_text, "left")
    between = F.split(body, ANY, -1)
    joined = joined.withColumn(c_parts, F.when(F.coalesce(F.size(c_words), F.lit(0)) > 0, F.transform(between, lambda p: mentions(p, F.col(c_words)))))
    parts = F.coalesce(F.transform(c_parts, lambda p: F.array_join(p["t"], "")), between)
    again = F.coalesce(F.aggregate(F.flatten(c_parts), F.lit(0), lambda n, p: n + p["n"]), F.lit(0))
    new = F.transform(found, lambda v: F.coalesce(F.col(c_map)[v], v))
    rebuilt = F.array_join(F.flatten(F.zip_with(parts, new, lambda p, s: F.array(p, F.coalesce(s, F.lit(""))))), "")
    replaced = F.size(F.filter(found, lambda v: F.map_contains_key(c_map, v)))
    count = (replaced + again).cast("long")
    keep = [F.col(f"`{c}`") for c in names]
    changed = joined.select(*[rebuilt.alias(text) if c == text else k for c, k in zip(names, keep, strict=True)], *([count.alias(out_count)] if out_count else []))
    same = clean.select(*keep, *([F.lit(0).cast("long").alias(out_count)] if out_count else []))
    return changed.unionByName(same)


def digests(docs: DataFrame, key: str = DEMO_KEY) -> DataFrame:
    """The query's columns: doc_id, n_entities replaced, and the text with surrogates."""
    return replace(docs.select("doc_id", "text"), key, out_count="n_entities").select("doc_id", "n_entities", "text")
