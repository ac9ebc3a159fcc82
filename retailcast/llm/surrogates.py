"""Surrogates for personal data, DataFrame functions only.

Emails, phone numbers, card numbers, IPv4 addresses, social-security numbers and
titled person names are found by one pattern. Each distinct entity of the corpus
gets one keyed replacement of its type (digits for digits, letters for letters,
valid octets, a Luhn digit where the original has one, names of the title's
gender, if it has one, in the name's script); mentions that differ in letter case or punctuation
share it. A collision check over all entities redraws replacements that equal
another's or a real value, so distinct entities stay distinct.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailcast.session import materialize

# ---- fixed values: entity patterns, titles by gender and script, name parts ----
OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
EMAIL = r"[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
IPV4 = rf"(?<![0-9.])(?:{OCTET}\.){{3}}{OCTET}(?![0-9]|\.[0-9])"
PHONE = (r"\+[0-9]{1,3}[ .-]?\([0-9]{2,4}\)[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}(?![0-9])"
         r"|\+[0-9]{1,3}(?:[ .-][0-9]{2,4}){2,4}(?![0-9])"
         r"|\+[0-9]{1,3}[ .-][0-9]{2,4}[ .-][0-9]{5,8}(?![0-9])"
         r"|(?<![0-9])\+[0-9]{7,15}(?![0-9])"
         r"|(?:(?<![0-9-])1[ .-]?)?\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}(?![0-9])"
         r"|(?<![0-9-])(?:1-)?[0-9]{3}-[0-9]{3}-[0-9]{4}(?![0-9-])"
         r"|(?<![0-9.])(?:1\.)?[0-9]{3}\.[0-9]{3}\.[0-9]{4}(?![0-9]|\.[0-9])"
         r"|(?<![0-9])(?<![0-9] )(?:1 )?[0-9]{3} [0-9]{3} [0-9]{4}(?![0-9]| [0-9])")
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
CARD = r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])"
MALE = ["Mr", "Sir", "Herr", "Monsieur", "Señor", "Sr", "господин"]
FEMALE = ["Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Señorita", "госпожа"]
NEUTRAL = ["Dr", "Doctor", "Doktor", "Prof", "Professor"]
TITLE = rf"(?:{'|'.join(sorted(MALE + FEMALE + NEUTRAL, key=len, reverse=True))})"
TITLES = rf"(?:{TITLE}\.? )+"
PERSON = rf"(?<![\p{{L}}]){TITLES}\p{{Lu}}\p{{Ll}}+(?: \p{{Lu}}\p{{Ll}}+)?(?![\p{{L}}])"
KINDS = {"email": EMAIL, "ip": IPV4, "phone": PHONE, "ssn": SSN, "card": CARD, "person": PERSON}
LATIN = ["ba", "de", "fi", "go", "lu", "ma", "ne", "ri", "so", "tu", "va", "ke", "li", "mo", "ra", "te"]
CYRILLIC = ["ба", "де", "фи", "го", "лу", "ма", "не", "ри", "со", "ту", "ва", "ке", "ли", "мо", "ра", "те"]
ENDINGS = {"m": (["n", "s", "ldo", "rt"], ["н", "с", "рт", "л"]), "f": (["na", "lia", "rine", "sa"], ["на", "лия", "рина", "са"])}
ANY = "|".join(KINDS.values())
#: What every entity holds (an @, two digits at most one separator apart, or a title); texts without it are left as they are.
HINT = rf"@|[0-9][ .-]?[0-9]|{TITLES}\p{{Lu}}"
MAX_ROUNDS = 40
#: So many attempts make names a syllable, local parts a letter and phone numbers a digit longer.
GROW = 2


def kind_of(mention: Column) -> Column:
    """The kind whose pattern matches the mention whole."""
    order = ["email", "ip", "ssn", "phone", "card"]
    return reduce(lambda c, k: c.when(mention.rlike(f"^(?:{KINDS[k].replace('(?<![0-9.])', '').replace('(?<![0-9-])', '')})$"), k),
                  order[1:], F.when(mention.rlike(f"^{EMAIL}$"), "email")).otherwise("person")


def _letters(seed: Column, alphabet: str, i: Column) -> Column:
    return F.substr(F.lit(alphabet), F.pmod(F.xxhash64(seed, i), F.lit(len(alphabet))).cast("int") + 1, F.lit(1))


def _scramble(value: Column, seed: Column) -> Column:
    """Letters become letters and digits digits; other characters stay."""
    return F.array_join(F.transform(F.split(value, ""), lambda c, i: F.when(c.rlike("^[a-z]$"), _letters(seed, "abcdefghijklmnopqrstuvwxyz", i))
                                    .when(c.rlike("^[0-9]$"), _letters(seed, "0123456789", i)).otherwise(c)), "")


def _digits(count: Column, seed: Column) -> Column:
    return F.when(count <= 0, "").otherwise(F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(count, F.lit(1))), lambda i: _letters(seed, "0123456789", i)), ""))


def _more(attempt: Column) -> Column:
    return F.floor(attempt / GROW).cast("int")


def _email(norm: Column, seed: Column, attempt: Column, secret: str) -> Column:
    """The local part gains a letter every ``GROW`` attempts; the host depends on the domain alone."""
    local, domain = F.substring_index(norm, "@", 1), F.substring_index(norm, "@", -1)
    top = F.substring_index(domain, ".", -1)
    host = F.expr("substr(substring_index(norm, '@', -1), 1, length(substring_index(norm, '@', -1)) - length(substring_index(norm, '.', -1)))")
    tail = F.substr(F.lit("a" * MAX_ROUNDS), F.lit(1), _more(attempt))
    return F.concat(_scramble(local, seed), _scramble(tail, F.concat(seed, F.lit("+"))), F.lit("@"), _scramble(host, F.sha2(F.concat(F.lit(secret), domain), 256)), top)


def _card(norm: Column, seed: Column) -> Column:
    body = F.concat(F.substr(norm, F.lit(1), F.lit(1)), _digits(F.length(norm) - 2, seed))
    last = F.filter(F.transform(F.sequence(F.lit(0), F.lit(9)), lambda d: d.cast("string")), lambda d: F.call_function("luhn_check", F.concat(body, d)))
    return F.concat(body, F.when(F.call_function("luhn_check", norm), last[0]).otherwise(_digits(F.lit(1), F.concat(seed, F.lit("x")))))


def _ip(norm: Column, seed: Column, attempt: Column) -> Column:
    """Octets of as many digits; after some attempts any octets."""
    def octet(part, i):
        h = F.xxhash64(seed, i)
        return (F.when(_more(attempt) > 2, F.pmod(h, F.lit(256))).when(F.length(part) == 1, F.pmod(h, F.lit(10))).when(F.length(part) == 2, F.pmod(h, F.lit(90)) + 10)
                .otherwise(F.pmod(h, F.lit(156)) + 100)).cast("string")
    return F.array_join(F.transform(F.split(norm, r"\."), octet), ".")


def _name(norm: Column, seed: Column, attempt: Column, part: str) -> Column:
    """``norm``: script:gender:name. A given name ends by gender; a family name is three
    syllables, and one more every ``GROW`` attempts."""
    def pick(words, i):
        return F.get(F.array(*map(F.lit, words)), F.pmod(F.xxhash64(seed, i), F.lit(len(words))).cast("int"))
    gender = F.split(norm, ":")[1]

    def build(script, syllables):
        name = F.array_join(F.transform(F.sequence(F.lit(0), _more(attempt) + (2 if part == "last" else 1)), lambda i: pick(syllables, i)), "")
        if part == "first":
            name = F.concat(name, F.when(gender == "f", pick(ENDINGS["f"][script], F.lit(99))).when(gender == "m", pick(ENDINGS["m"][script], F.lit(99)))
                            .otherwise(pick(ENDINGS["f"][script] + ENDINGS["m"][script], F.lit(99))))
        return F.initcap(name)
    return F.when(norm.startswith("c:"), build(1, CYRILLIC)).otherwise(build(0, LATIN))


def surrogate(kind: Column, norm: Column, attempt: Column, secret: str) -> Column:
    seed = F.sha2(F.concat_ws("|", F.lit(secret), kind, norm, attempt.cast("string")), 256)
    country = F.when(norm.startswith("+"), F.regexp_extract(norm, r"^\+([0-9]+):", 1)).otherwise("")
    rest = F.regexp_replace(norm, r"^\+[0-9]+:", "")
    return (F.when(kind == "email", _email(norm, seed, attempt, secret)).when(kind == "ip", _ip(norm, seed, attempt))
            .when(kind == "phone", F.concat(country, _digits(F.length(rest) + _more(attempt), seed)))
            .when(kind == "ssn", F.concat(F.lit("9"), _digits(F.lit(8), seed))).when(kind == "card", _card(norm, seed))
            .when(kind == "first", _name(norm, seed, attempt, "first")).otherwise(_name(norm, seed, attempt, "last")))


def _real(kind: Column, norm: Column) -> Column:
    """An entity in the form of a replacement, to keep replacements off real values."""
    return F.when(kind.isin("first", "last"), F.initcap(F.split(norm, ":")[2])).when(kind == "phone", F.translate(norm, "+:", "")).otherwise(norm)


def _parts(mentions: DataFrame) -> DataFrame:
    """(mention, kind, i, part, norm): the entities that a mention names."""
    m, only = F.col("mention"), F.regexp_replace("mention", "[^0-9]", "")
    # a leading 1 is the country code of ten digits, with or without +
    code = F.when(m.rlike(r"^(?:\+1[0-9]{10}|1[ .(-].*)$"), "1").otherwise(F.regexp_extract(m, r"^\+([0-9]{1,3})(?=[ .(-])", 1))
    phone = F.when(code != "", F.concat(F.lit("+"), code, F.lit(":"), F.substr(only, F.length(code) + 1, F.length(only)))).otherwise(only)
    simple = F.array(F.struct(F.col("kind").alias("part"), F.when(F.col("kind") == "email", F.lower(m)).when(F.col("kind") == "ip", m)
                              .when(F.col("kind") == "phone", phone).otherwise(only).alias("norm")))
    words = F.split(F.regexp_replace(m, f"^{TITLES}", ""), " ")
    titled = lambda titles: F.regexp_extract(m, f"^{TITLES}", 0).rlike(rf"(?:^| )(?:{'|'.join(titles)})\.? ")
    gender = F.when(titled(FEMALE), "f").when(titled(MALE), "m").otherwise("x")
    script = F.when(words[0].rlike(r"^\p{IsCyrillic}"), "c").otherwise("l")
    # family names are shared by both genders: the same family keeps one name
    last = lambda w: F.struct(F.lit("last").alias("part"), F.concat_ws(":", script, F.lit("x"), F.lower(w)).alias("norm"))
    first = F.struct(F.lit("first").alias("part"), F.concat_ws(":", script, gender, F.lower(words[0])).alias("norm"))
    person = F.when(F.size(words) == 2, F.array(first, last(words[1]))).otherwise(F.array(last(words[0])))
    return (mentions.withColumn("kind", kind_of(m))
            .select("mention", "kind", F.posexplode(F.when(F.col("kind") == "person", person).otherwise(simple)).alias("i", "x"))
            .select("mention", "kind", "i", "x.part", "x.norm"))


def entity_surrogates(entities: DataFrame, secret: str) -> DataFrame:
    """(part, norm) -> (part, norm, replacement): distinct for distinct entities
    of a part and never equal to a real value of the corpus."""
    real = materialize(entities.select("part", "norm").distinct(), "entities")
    taken = real.select("part", _real(F.col("part"), F.col("norm")).alias("replacement")).distinct()
    settled, left = None, real.withColumn("attempt", F.lit(0))
    for _ in range(MAX_ROUNDS):
        drawn = left.withColumn("replacement", surrogate(F.col("part"), F.col("norm"), F.col("attempt"), secret))
        winner = drawn.groupBy("part", "replacement").agg(F.min("norm").alias("w"))
        free = winner.join(taken, ["part", "replacement"], "left_anti")
        if settled is not None:
            free = free.join(settled, ["part", "replacement"], "left_anti")
        state = materialize(drawn.join(free, ["part", "replacement"], "left").withColumn("ok", F.coalesce(F.col("w") == F.col("norm"), F.lit(False))).drop("w"), "drawn")
        new = state.filter("ok").select("part", "norm", "replacement")
        settled = new if settled is None else settled.unionByName(new)
        left = state.filter("not ok").select("part", "norm", (F.col("attempt") + 1).alias("attempt"))
        if left.isEmpty():
            return settled
    raise RuntimeError("entities are left without a distinct replacement")


def _render(kind: Column, mention: Column, parts: Column) -> Column:
    """The replacement in the mention's own format (punctuation, letter case, title)."""
    sur = parts[0]
    digits = F.aggregate(F.split(mention, ""), F.struct(F.lit("").alias("out"), F.lit(0).alias("i")),
                         lambda acc, c: F.when(c.rlike("^[0-9]$"), F.struct(F.concat(acc.out, F.substr(sur, acc.i + 1, F.lit(1))).alias("out"), (acc.i + 1).alias("i")))
                         .otherwise(F.struct(F.concat(acc.out, c).alias("out"), acc.i.alias("i"))), lambda acc: F.concat(acc.out, F.substr(sur, acc.i + 1, F.length(sur))))
    # letters that the replacement has more stand before the @
    local, more = F.instr(mention, "@") - 1, F.length(sur) - F.length(mention)
    same = lambda i: F.substr(sur, i + 1 + F.when(i > local, more).otherwise(0), F.when(i == local, more + 1).otherwise(1))
    cased = F.array_join(F.transform(F.split(mention, ""), lambda c, i: F.when(c.rlike("^[A-Z]$"), F.upper(same(i))).otherwise(same(i))), "")
    return (F.when(kind == "email", cased).when(kind == "ip", sur)
            .when(kind == "person", F.concat(F.regexp_extract(mention, f"^{TITLES}", 0), F.array_join(parts, " "))).otherwise(digits))


def replace_entities(docs: DataFrame, secret: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, n_entities, kinds) of every row of ``docs``: the text with each
    entity replaced, and the kinds replaced in order.

    Texts without an entity, empty and null ones come back as they are with 0 and
    no kinds. Rows with null ids and repeated rows are kept; other columns are ignored.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    hinted = docs.withColumn("found", F.when(F.col("text").rlike(HINT), F.regexp_extract_all("text", F.lit(f"({ANY})"), F.lit(1))))
    has = F.coalesce(F.size("found"), F.lit(0)) > 0
    mentions = materialize(hinted.filter(has).select("doc_id", F.xxhash64("text").alias("version"), "found").distinct(), "mentions")
    rows = mentions.select("doc_id", "version", F.posexplode("found").alias("at", "mention"))
    parts = materialize(_parts(rows.select("mention").distinct()), "parts")
    names = entity_surrogates(parts, secret)
    table = (parts.join(names, ["part", "norm"]).groupBy("mention", "kind")
             .agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "replacement"))), lambda x: x.replacement).alias("parts"))
             .select("mention", "kind", _render(F.col("kind"), F.col("mention"), F.col("parts")).alias("replacement")))
    per_doc = (rows.join(table, "mention").groupBy(F.col("doc_id").alias("_d"), F.col("version").alias("_v"))
               .agg(F.array_sort(F.collect_list(F.struct("at", "kind", "replacement"))).alias("_new")))
    between = F.split("text", ANY, -1)
    changed = (docs.filter(F.col("text").rlike(HINT)).join(per_doc, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.xxhash64("text") == F.col("_v")), "left")
               .withColumn("_rest", F.when(F.col("_new").isNotNull(), between))
               .select("doc_id", F.when(F.col("_new").isNull(), F.col("text")).otherwise(F.array_join(F.transform(
                   "_rest", lambda piece, i: F.concat(piece, F.coalesce(F.get(F.col("_new"), i)["replacement"], F.lit("")))), "")).alias("text"),
                   F.coalesce(F.size("_new"), F.lit(0)).cast("long").alias("n_entities"),
                   F.coalesce(F.transform("_new", lambda x: x.kind), F.array().cast("array<string>")).alias("kinds")))
    same = docs.filter(~F.coalesce(F.col("text").rlike(HINT), F.lit(False))).select(
        "doc_id", "text", F.lit(0).cast("long").alias("n_entities"), F.array().cast("array<string>").alias("kinds"))
    return changed.unionByName(same)
