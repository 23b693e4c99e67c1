"""Personal data replaced by surrogates that keep type, script and format.

Detection. One alternation of patterns finds email addresses, IPv4 addresses,
phone, payment card, bank account (IBAN) and social security numbers, secret
tokens, and names of persons after a title or a common given name: runs of
capitalised words with their particles. In the same text, later bare repeats
of a surname or of a listed given name are mentions too. Letters of scripts
without spaces between words may stand right beside a mention.

Surrogates. A keyed hash (SHA-256 over key, type, entity and attempt) drives
the replacement: letters become letters and digits digits at their places,
with case, script and separators kept; an IP address stays a valid one, a
card number passes the check-digit test again, a hexadecimal token stays one;
name parts become invented names of syllables in the part's script, with an
ending that matches the gender told by the title or the given name.

Coreference. An entity is its canonical form (lower case; digits only;
a single name part and its role), so every mention in the corpus, however
written, gets the same surrogate, and "Mr. Brown" matches "Alan Brown".

Distinctness. Distinct entities are gathered into one table (partial sums
first). Entities of one type whose surrogates agree, and surrogates that equal
a real entity of the corpus, are found by grouping and joining; all but one
try again with the next attempt, until no collision is left. The table grows
with the entities, and is joined to the mentions by shuffles.

DataFrame operations only; texts are shuffled only where they hold mentions.

Defined cases: null texts stay null and have no mentions; empty texts are
unchanged; very long texts are processed whole; equal texts get equal results
(mentions are gathered once per distinct text); all columns pass through
(``n_entities`` replaces one of that name); an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetscope.llm.common import staged

# Fixed word lists of the detector.
TITLES_M = ("Mr", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "Sir", "Signor", "г-н", "господин", "κύριος")
TITLES_F = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mademoiselle", "Señora", "Sra", "Señorita", "Signora", "г-жа", "госпожа", "κυρία")
TITLES_N = ("Dr", "Prof", "Professor")
GIVEN_M = ("James", "John", "Robert", "Michael", "William", "David", "Thomas", "Charles", "Daniel", "Peter", "Paul", "Hans", "Klaus",
           "Jürgen", "Pierre", "Jean", "Carlos", "José", "Juan", "Luis", "Иван", "Сергей", "Алексей", "Νίκος", "Γιώργος")
GIVEN_F = ("Mary", "Patricia", "Jennifer", "Linda", "Elizabeth", "Susan", "Sarah", "Karen", "Anna", "Emma", "Julia", "Laura", "Ingrid",
           "Ursula", "Marie", "Claire", "Sophie", "María", "Carmen", "Ana", "Елена", "Ольга", "Наталья", "Μαρία", "Ελένη")
# Fixed syllables of invented names, per script, and endings per gender.
SYLLABLES = {
    "latin": ("ba", "cor", "da", "fel", "gar", "hol", "ke", "lan", "mar", "nel", "or", "pa", "quin", "ros", "sel", "tam", "ul", "ver", "wen", "yar", "zan", "bri", "dro", "fen"),
    "cyrillic": ("ба", "вор", "га", "дел", "жан", "зор", "ки", "лан", "мар", "нел", "ор", "па", "рин", "сал", "там", "ул", "фен", "хол", "чар", "шел", "юр", "яр", "бри", "дро"),
    "greek": ("βα", "γορ", "δα", "ζελ", "θαν", "κορ", "λαν", "μαρ", "νελ", "ορ", "πα", "ριν", "σελ", "ταμ", "φεν", "χολ", "ψαρ", "ωρ", "βρι", "δρο", "κλε", "μιν", "περ", "τρα"),
}
ENDINGS = {
    ("latin", "m"): "on", ("latin", "f"): "ina", ("latin", "u"): "is", ("latin", "s"): "er",
    ("cyrillic", "m"): "ин", ("cyrillic", "f"): "ина", ("cyrillic", "u"): "ий", ("cyrillic", "s"): "ов",
    ("greek", "m"): "ος", ("greek", "f"): "ινα", ("greek", "u"): "ις", ("greek", "s"): "ιδης",
}

_TITLE = "(?:" + "|".join(TITLES_M + TITLES_F + TITLES_N) + r")\.?"
_GIVEN = "(?:" + "|".join(GIVEN_M + GIVEN_F) + ")"
# Letters as ranges: far cheaper per character than Unicode properties. Every
# pattern starts with a look at its first character, which rejects nearly all
# places of a text at once. Only scripts that write spaces between words are
# in: next to a Chinese, Japanese, Korean or Thai letter a mention may begin.
_L = r"A-Za-z\u00C0-\u0DFF\u10A0-\u10FF\u1200-\u177F\u1800-\u194F\u1C80-\u1FFF\u2C00-\u2DFF\uA640-\uA69F\uA720-\uA7FF\uAB30-\uABBF"
_W = _L + "0-9"
# Letters of the other scripts, without their punctuation.
_C = r"\u0E00-\u109F\u1100-\u11FF\u1780-\u17FF\u1950-\u1C7F\u2E80-\u2FDF\u3005-\u3007\u3021-\u3029\u3031-\uA4CF\uA960-\uA97F\uAC00-\uD7FF"
_FIRST = r"(?=[A-Z\u00C0-\u00DE\u0370-\u04FF])"
# A name word, without a possessive 's; then any number of them, each with its
# particles, up to the next title.
_NAME = rf"\p{{Lu}}[{_L}]*+(?:[’'-](?!s(?![{_L}]))[{_L}]++)*+"
_PARTICLE = "(?:de|del|della|di|da|do|dos|das|du|des|la|las|le|les|los|van|von|vom|zu|zum|zur|der|den|dem|ter|ten|y)"
_ONE = rf"(?:(?!y {_GIVEN}(?![{_L}]))(?:{_PARTICLE} ){{1,3}})?+(?:[dl][’'])?{_NAME}"
_RUN = rf"{_ONE}(?: (?!{_TITLE} ){_ONE})*+"
PATTERNS = {
    # Letters of _C belong to an address only where they touch the at sign.
    "email": rf"(?:(?<![{_W}._%+-])[{_W}._%+-]++|(?=[{_C}])(?<![{_C}{_W}._%+-])[{_C}{_W}._%+-]++(?<=[{_C}]))@(?:[{_W}-]++(?:\.[{_W}-]++)+|[{_C}{_W}-]++(?:\.[{_C}{_W}-]++)+)",
    "ip": rf"(?=[0-9])(?<![{_W}.])(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{{2}}|[1-9]?[0-9])\.){{3}}(?:25[0-5]|2[0-4][0-9]|1[0-9]{{2}}|[1-9]?[0-9])(?![{_W}]|\.[0-9])",
    "iban": rf"(?=[A-Z]{{2}}[0-9])(?<![{_W}])[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{3,7}}(?: ?[A-Z0-9]{{1,3}})?(?![{_W}])",
    "card": rf"(?=[0-9]{{4}})(?<![{_W}+])[0-9]{{4}}(?:[ -]?[0-9]{{4}}){{2}}[ -]?[0-9]{{1,7}}(?![{_W}])",
    "ssn": rf"(?=[0-9]{{3}}-)(?<![{_W}-])[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}(?![{_W}-])",
    "phone": rf"(?=[0-9+(])(?<![{_W}+])(?:\+[0-9]{{1,3}}[ .-]?)?(?:\([0-9]{{2,4}}\)[ .-]?[0-9]{{3}}[ .-]?[0-9]{{3,4}}|[0-9]{{3}}[ .-][0-9]{{3}}[ .-][0-9]{{4}})(?![{_W}])"
             rf"|(?=\+[0-9])(?<![{_W}+])\+[0-9]{{1,3}}(?:[ .-]?[0-9]{{2,4}}){{2,5}}(?![{_W}])",
    "secret": rf"(?=[0-9a-fspgxA])(?<![{_W}_])(?:(?:sk|pk|ghp|gho|xox[bp])[_-][A-Za-z0-9_-]{{16,}}+|AKIA[A-Z0-9]{{16}}"
              rf"|(?=[0-9a-f]{{16,}}+(?![{_W}]))(?=[a-f]*+[0-9])(?=[0-9]*+[a-f])[0-9a-f]{{16,}}+)",
    "person": rf"{_FIRST}(?<![{_L}]){_TITLE} {_RUN}|{_FIRST}(?<![{_L}]){_GIVEN} {_RUN}",
}
# No mention starts inside a word. Each pattern says so itself; said once in
# front, it spares most places of a text all of them.
DETECTOR = rf"(?<![{_L}])(?:" + "|".join(f"(?:{p})" for p in PATTERNS.values()) + ")"
# What every mention holds: an at sign, a digit, or a title or given name (a
# key without digits holds its prefix). One cheap pass spares most texts the
# full patterns; all its words start with a letter of the first class.
SIGN = rf"[@0-9]|(?=[A-Z\u00C0-\u00DE\u0370-\u04FFspgx])(?<![{_L}])(?:{_FIRST}(?:{_TITLE}|{_GIVEN}) |(?:sk|pk|ghp|gho|xox[bp])[_-][A-Za-z0-9_-]{{16}}|AKIA)"
# A capitalised word alone: a repeat, where its text names a person so.
BARE = rf"(?=\p{{Lu}})(?<![{_L}]){_NAME}"
STREAM = 256                        # hexadecimal digits drawn per entity and attempt


def mentions(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(DETECTOR), 0)


def mention_type(m: Column) -> Column:
    """Type of a mention, by the first pattern that matches all of it."""
    out = F.lit("person")
    for name in reversed([n for n in PATTERNS if n != "person"]):
        out = F.when(m.rlike(f"^(?:{PATTERNS[name]})$"), F.lit(name)).otherwise(out)
    return out


def _in(c: Column, names) -> Column:
    return c.isin(*names)


def units_of(found: DataFrame) -> DataFrame:
    """One row per entity mention: (d1, d2, pos, sub, type, entity, raw,
    before): persons are split into name parts; ``before`` is text that stays
    (a space, an elided particle), as do whole units without a type."""
    rows = found.select("d1", "d2", F.posexplode("mentions").alias("pos", "mention")).withColumn("kind", mention_type(F.col("mention")))
    digits = F.regexp_replace("mention", "[^0-9]", "")
    plain = rows.filter("kind <> 'person'").select(
        "d1", "d2", "pos", F.lit(0).alias("sub"), F.col("kind").alias("type"),
        F.when(F.col("kind").isin("phone", "card", "ssn"), digits)
         .when(F.col("kind") == "iban", F.regexp_replace("mention", " ", ""))
         .when(F.col("kind") == "email", F.lower("mention")).otherwise(F.col("mention")).alias("entity"),
        F.col("mention").alias("raw"), F.lit("").alias("before"))
    words = F.split("mention", " ")
    person = rows.filter("kind = 'person'").select("d1", "d2", "pos", words.alias("words"), F.posexplode(words).alias("i", "word"))
    first = F.regexp_replace(F.element_at("words", 1), r"\.$", "")
    titled = _in(first, TITLES_M + TITLES_F + TITLES_N)
    given = F.element_at("words", F.when(titled, 2).otherwise(1))
    gender = (F.when(_in(first, TITLES_M), F.lit("m")).when(_in(first, TITLES_F), F.lit("f"))
               .when(_in(given, GIVEN_M), F.lit("m")).when(_in(given, GIVEN_F), F.lit("f")).otherwise(F.lit("u")))
    last = F.col("i") == F.size("words") - 1
    # An elided particle stays in front of its name.
    elided = F.regexp_extract("word", "^[dl][’']", 0)
    raw = F.substr(F.col("word"), F.length(elided) + 1, F.length("word"))
    # A given name's type holds its gender; the last part is the surname.
    known = F.when(_in(raw, GIVEN_M), F.lit("m")).when(_in(raw, GIVEN_F), F.lit("f")).otherwise(gender)
    kind = F.when(last, F.lit("name_s")).otherwise(F.concat(F.lit("name_"), known))
    # Titles and particles stay: their type is null.
    stays = ((F.col("i") == 0) & titled) | F.col("word").rlike(f"^{_PARTICLE}$")
    parts = person.select(
        "d1", "d2", "pos", F.col("i").alias("sub"), F.when(~stays, kind).alias("type"), F.when(~stays, F.lower(raw)).alias("entity"),
        F.when(stays, F.col("word")).otherwise(raw).alias("raw"),
        F.concat(F.when(F.col("i") == 0, F.lit("")).otherwise(F.lit(" ")), F.when(stays, F.lit("")).otherwise(elided)).alias("before"))
    return plain.unionByName(parts)


def _stream(key: str) -> Column:
    """Hexadecimal digits for (type, entity, attempt)."""
    seed = F.concat_ws("|", F.lit(key), F.col("type"), F.col("entity"), F.col("attempt").cast("string"))
    return F.concat(*[F.sha2(F.concat(seed, F.lit(f"|{i}")), 256) for i in range(STREAM // 64)])


def _byte(stream: Column, i: Column) -> Column:
    """The i-th byte of a hexadecimal stream, as an integer."""
    at = (2 * F.pmod(i, F.lit(STREAM // 2)) + 1).cast("int")
    return F.conv(F.substr(stream, at, F.lit(2)), 16, 10).cast("int")


def _pick(letters: str, n: Column) -> Column:
    return F.substr(F.lit(letters), (n % len(letters) + 1).cast("int"), F.lit(1))


def _shape(entity: Column, stream: Column, hexa: Column) -> Column:
    """Every letter and digit replaced within its class, all else kept."""
    def one(c: Column, i: Column) -> Column:
        n = _byte(stream, i)
        return (F.when(c.rlike("[0-9]"), _pick("0123456789", n))
                 .when(hexa & c.rlike("[a-f]"), _pick("abcdef", n))
                 .when(c.rlike("[a-z]"), _pick("abcdefghijklmnopqrstuvwxyz", n))
                 .when(c.rlike("[A-Z]"), _pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ", n))
                 .when(c.rlike(r"\p{IsCyrillic}"), _pick("абвгдежзиклмнопрстуфхцчшэюя", n))
                 .when(c.rlike(r"\p{IsGreek}"), _pick("αβγδεζηθικλμνξοπρστυφχψω", n))
                 .when(c.rlike(r"\p{L}"), _pick("àáâäèéêëìíîïòóôöùúûüñç", n)).otherwise(c))
    return F.array_join(F.transform(F.split(entity, ""), one), "")


def _email(stream: Column) -> Column:
    """Local part and domain reshaped, the top-level domain kept."""
    top = F.regexp_extract("entity", r"(\.[^.]+)$", 1)
    rest = F.substr(F.col("entity"), F.lit(1), (F.length("entity") - F.length(top)).cast("int"))
    return F.concat(_shape(rest, stream, F.lit(False)), top)


def _card(stream: Column) -> Column:
    """First digit kept, the rest drawn, the last one the check digit."""
    n = F.length("entity")
    body = F.concat(F.substring("entity", 1, 1), _shape(F.substr(F.col("entity"), F.lit(2), (n - 2).cast("int")), stream, F.lit(False)))
    # From the right, the digit beside the check digit is doubled, then every
    # second one; two-digit products count their digits' sum.
    def worth(c: Column, i: Column) -> Column:
        d = c.cast("int")
        doubled = F.when(2 * d > 9, 2 * d - 9).otherwise(2 * d)
        return F.when((F.length(body) - i) % 2 == 1, doubled).otherwise(d)
    total = F.aggregate(F.transform(F.split(body, ""), worth), F.lit(0), lambda s, v: s + v)
    return F.concat(body, (F.pmod(10 - total % 10, F.lit(10))).cast("string"))


def _name(stream: Column) -> Column:
    """Syllables and an ending in the part's script, for its role; later
    attempts take more syllables, so the names cannot run out."""
    role = F.substring("type", 6, 1)
    script = (F.when(F.col("entity").rlike(r"\p{IsCyrillic}"), F.lit("cyrillic"))
               .when(F.col("entity").rlike(r"\p{IsGreek}"), F.lit("greek")).otherwise(F.lit("latin")))
    count = (F.lit(3) + F.floor(F.col("attempt") / 2)).cast("int")
    out = F.lit("")
    for s, syllables in SYLLABLES.items():
        table = F.array(*[F.lit(x) for x in syllables])
        body = F.array_join(F.transform(F.sequence(F.lit(1), count), lambda i: F.element_at(table, (_byte(stream, i) % len(syllables) + 1).cast("int"))), "")
        ending = F.lit("")
        for r in "mfus":
            ending = F.when(role == r, F.lit(ENDINGS[s, r])).otherwise(ending)
        out = F.when(script == s, F.concat(body, ending)).otherwise(out)
    return out


def candidate(key: str) -> Column:
    """Surrogate of the row's (type, entity, attempt), in canonical form."""
    stream = F.col("stream")
    octets = F.concat_ws(".", *[(_byte(stream, F.lit(i)) % 254 + 1).cast("string") for i in range(4)])
    kind = F.col("type")
    return (F.when(kind == "email", _email(stream)).when(kind == "ip", octets).when(kind == "card", _card(stream))
             .when(kind.startswith("name_"), _name(stream))
             .when(kind == "iban", F.concat(F.substring("entity", 1, 2), _shape(F.substr(F.col("entity"), F.lit(3), F.length("entity")), stream, F.lit(False))))
             .when(kind == "secret", _shape(F.col("entity"), stream, F.col("entity").rlike("^[0-9a-f]+$")))
             .otherwise(_shape(F.col("entity"), stream, F.lit(False))))


def surrogate_map(entities: DataFrame, key: str, max_rounds: int = 60) -> DataFrame:
    """(type, entity, surrogate), one-to-one within a type and never equal to
    an entity of that type. ``entities(type, entity)`` are distinct."""
    def drawn(rows: DataFrame) -> DataFrame:
        return rows.withColumn("stream", _stream(key)).withColumn("surrogate", candidate(key)).drop("stream")

    now = staged(drawn(entities.withColumn("attempt", F.lit(0))), "surrogates")
    names = entities.select("type", F.col("entity").alias("surrogate"))
    for _ in range(max_rounds):
        first = Window.partitionBy("type", "surrogate").orderBy("attempt", "entity")
        real = names.withColumn("real", F.lit(True))
        marked = (now.join(real, ["type", "surrogate"], "left")
                  .withColumn("again", F.col("real").isNotNull() | (F.row_number().over(first) > 1)).drop("real"))
        marked = staged(marked, "collisions")
        if marked.filter("again").limit(1).count() == 0:
            return now.select("type", "entity", "surrogate")
        retry = marked.filter("again").select("type", "entity", (F.col("attempt") + 1).alias("attempt"))
        now = staged(marked.filter("NOT again").drop("again").unionByName(drawn(retry)), "surrogates")
    raise RuntimeError(f"surrogates still collide after {max_rounds} attempts")


def cased_name(raw: Column, surrogate: Column) -> Column:
    return F.when((F.upper(raw) == raw) & (F.length(raw) > 1), F.upper(surrogate)).otherwise(F.initcap(surrogate))


def rendered() -> Column:
    """The surrogate in the mention's own format."""
    raw, surrogate, kind = F.col("raw"), F.col("surrogate"), F.col("type")
    # Digits of the surrogate at the mention's digits; separators stay.
    spread = F.array_join(F.transform(F.split(raw, ""), lambda c, i: F.when(
        c.rlike("[0-9]"), F.substr(surrogate, F.length(F.regexp_replace(F.substr(raw, F.lit(1), (i + 1).cast("int")), "[^0-9]", "")), F.lit(1))).otherwise(c)), "")
    spaced = F.array_join(F.transform(F.split(raw, ""), lambda c, i: F.when(
        c == " ", c).otherwise(F.substr(surrogate, F.length(F.regexp_replace(F.substr(raw, F.lit(1), (i + 1).cast("int")), " ", "")), F.lit(1)))), "")
    cased = F.array_join(F.transform(F.split(surrogate, ""), lambda c, i: F.when(
        F.substr(raw, (i + 1).cast("int"), F.lit(1)).rlike(r"\p{Lu}"), F.upper(c)).otherwise(c)), "")
    named = cased_name(raw, surrogate)
    return (F.when(kind.isin("phone", "card", "ssn"), spread).when(kind == "iban", spaced).when(kind == "email", cased)
             .when(kind.startswith("name_"), named).otherwise(surrogate))


def replace_entities(docs: DataFrame, key: str = "surrogate-key") -> DataFrame:
    """``docs`` with surrogates in ``text`` and the count ``n_entities``."""
    columns = [c for c in docs.columns if c != "n_entities"]
    d1, d2 = F.xxhash64("text"), F.xxhash64(F.lit(7), "text")
    has = F.coalesce(F.col("text").rlike(SIGN) & F.col("text").rlike(DETECTOR), F.lit(False))
    with_some = docs.filter(has).select(*[F.col(f"`{c}`") for c in columns], d1.alias("__d1"), d2.alias("__d2"))
    found = staged(with_some.select(F.col("__d1").alias("d1"), F.col("__d2").alias("d2"), mentions(F.col("text")).alias("mentions"))
                   .dropDuplicates(["d1", "d2"]), "mentions")
    units = staged(units_of(found), "units")
    entities = staged(units.filter("type IS NOT NULL").groupBy("type", "entity").agg(F.count(F.lit(1)).alias("n")).select("type", "entity"), "entities")
    table = surrogate_map(entities, key)
    known = staged(units.join(table, ["type", "entity"]).select("d1", "d2", "pos", "sub", "type", "entity", "surrogate", F.concat("before", rendered()).alias("out")), "known")
    done = known.select("d1", "d2", "pos", "sub", "out").unionByName(
        units.filter("type IS NULL").select("d1", "d2", "pos", "sub", F.concat("before", "raw").alias("out")))
    per_mention = done.groupBy("d1", "d2", "pos").agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("sub", "out"))), lambda u: u["out"]), "").alias("out"))
    outs = per_mention.groupBy("d1", "d2").agg(F.transform(
        F.sort_array(F.collect_list(F.struct("pos", "out"))), lambda m: m["out"]).alias("outs"))
    # Surnames and listed given names of a text, for their bare repeats in it;
    # a word that is both counts as the surname.
    again = known.filter((F.col("type") == "name_s") | (F.col("type").startswith("name_") & F.col("entity").isin([n.lower() for n in GIVEN_M + GIVEN_F])))
    again = again.groupBy("d1", "d2", "entity").agg(F.max_by("surrogate", F.struct(F.col("type") == "name_s", "type")).alias("surrogate"))
    again = again.groupBy("d1", "d2").agg(F.map_from_entries(F.collect_list(F.struct("entity", "surrogate"))).alias("names"))
    per_text = staged(outs.join(again, ["d1", "d2"], "left"), "replacements")
    gaps = F.split("text", DETECTOR, -1)
    bare = F.transform("gaps", lambda g: F.regexp_extract_all(g, F.lit(BARE), 0))
    fresh = lambda w: F.element_at("names", F.lower(w))
    swapped = F.zip_with("gaps", "bare", lambda g, ws: F.array_join(F.zip_with(
        F.split(g, BARE, -1), F.transform(ws, lambda w: F.coalesce(cased_name(w, fresh(w)), w)), lambda p, w: F.concat(p, F.coalesce(w, F.lit("")))), ""))
    pieces = F.zip_with(F.when(F.col("names").isNull(), F.col("gaps")).otherwise(swapped), "outs", lambda g, o: F.concat(g, F.coalesce(o, F.lit(""))))
    repeats = F.coalesce(F.size(F.filter(F.flatten("bare"), lambda w: fresh(w).isNotNull())), F.lit(0))
    per_text = per_text.select(F.col("d1").alias("__d1"), F.col("d2").alias("__d2"), "outs", "names")
    texts = (with_some.join(per_text, ["__d1", "__d2"])
             .select("__d1", "__d2", F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), "outs", "names", gaps.alias("gaps"))
             .withColumn("bare", F.when(F.col("names").isNotNull(), bare)))
    texts = texts.select("row", F.array_join(pieces, "").alias("text"),
                         (F.size("outs") + F.when(F.col("names").isNull(), 0).otherwise(repeats)).cast("long").alias("n_entities"))
    replaced = texts.select(*[F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in columns], "n_entities")
    return docs.filter(~has).select(*[F.col(f"`{c}`") for c in columns], F.lit(0).cast("long").alias("n_entities")).unionByName(replaced)
