"""Operator 2, surrogates for personal data.

Detected entities get keyed replacements of the same type: digits stay
digits, letters stay letters of their script and case, separators stay where
they are, a card number keeps its check-digit status, an address part keeps
its number of digits where the type allows, and a name after a title gets
a name of the title's gender in its own script.

An entity is a type and a normal form (digits of a number, lower case of an
address or secret), so every mention of it, in any document and format, gets
the same surrogate.  A phone number of ten digits is one of country code 1.
A name has two entities: its last word, keyed without the title, and what
stands before it, keyed with the last word and the gender; a title that tells
no gender takes that of the one gender the same name has elsewhere.  Surrogates come from HMAC-SHA256 of key, type, normal
form and attempt.  Collision checks run over all entities of the corpus: two
entities never share a surrogate and no surrogate is a value that occurs; the
entity with the lower attempt (then the smaller form) keeps its surrogate,
the other takes the next attempt, until none collides.

Keyed secrets are found in any text: 6 characters or more after a password
keyword, 16 or more after another.  Phone numbers are those of 3, 3 and 4
digits in brackets, dotted, dashed, spaced or (from area code 200) bare, and
those of 8 to 15 digits after a plus sign.

Jobs: texts give their distinct entities under a hash of the text (equal
texts count once); entities are assigned; replacements are gathered per text
hash; only texts that have entities move to meet them.

Defined cases: a null text stays null, an empty one empty; ids are not used,
so null and repeated ids are fine; equal texts give equal results; all columns
are kept; names of columns do not matter but that of the text.  A text
without entities is not changed by a byte.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorry.llm import graph
from lorry.llm import textvec as tv
from lorry.session import stage

MALE = {"mr", "herr", "herrn", "sr", "m", "г-н"}
FEMALE = {"mrs", "ms", "frau", "sra", "srta", "mme", "mlle", "г-жа"}
#: titles that count only with their full stop
WITH_STOP = {"m", "sr", "sra", "srta", "prof"}
#: first names by script and gender (n: not told by the title)
FIRST = {
    ("latin", "m"): "Adam Bruno Carl Daniel Edgar Felix Gustav Henri Ivan Jonas Kevin Leon Marco Noel Oskar Paul Rafael Simon Tomas Victor".split(),
    ("latin", "f"): "Alice Berta Clara Diana Elena Flora Greta Hanna Irene Julia Karla Laura Marta Nadia Olivia Paula Rosa Sofia Teresa Vera".split(),
    ("latin", "n"): "Alex Andrea Chris Dominique Eden Francis Gabriel Jean Kim Lou Maxime Nicola Robin Sacha Toni".split(),
    ("cyrillic", "m"): "Антон Борис Виктор Глеб Денис Егор Иван Кирилл Лев Максим".split(),
    ("cyrillic", "f"): "Анна Вера Дарья Елена Зоя Инна Лидия Мария Нина Ольга".split(),
    ("cyrillic", "n"): "Саша Женя Валя".split(),
}
SYLLABLES = {
    "latin": [c + v for c in "bdfgklmnprstvz" for v in "aeiou"],
    "cyrillic": [c + v for c in "бвгдклмнпрст" for v in "аеиоу"],
}

_TITLES = "|".join(sorted((re.escape(t.capitalize()) + (r"(?=\.)" if t in WITH_STOP else r"\b") for t in MALE | FEMALE | {"dr", "prof"}),
                          key=lambda t: (-len(t), t)))
#: a capitalised word that is no title
_WORD = rf"(?!(?:{_TITLES}))[^\W\d_a-zß-öø-ÿа-яё](?:[^\W\d_]|[’'-](?=[^\W\d_]))*"
_SEP = r"[ \u00a0./-]"
#: type, what the pattern cannot do without and pattern, in order of preference where two begin at one place; group "v" is the value where there is one
PATTERNS = [
    ("email", "@", r"[\w.%+-]+@[^\W_](?:[\w-]*[^\W_])?(?:\.[^\W_](?:[\w-]*[^\W_])?)+"),
    ("secret", "", r"(?i:\b(?:token|secret|api[_-]?key|access[_-]?key))[\"']?\s*[=:]\s*[\"']?(?P<v>[A-Za-z0-9+/_-]{16,})"),
    ("secret", "", r"(?i:(?:\b|_)(?:password|passwd|passphrase|pwd))[\"']?\s*[=:]\s*[\"']?(?P<v>[^\s\"'<>,;]{5,}[^\s\"'<>,;.:!?()\[\]{}])"),
    ("secret", "digit", r"(?<![0-9A-Za-z])(?=[A-Fa-f]*\d)[0-9A-Fa-f]{32,128}(?![0-9A-Za-z])"),
    ("phone", "digit", rf"(?<![\w+])(?:\+1{_SEP}?\(?\d{{3}}\)?{_SEP}?\d{{3}}{_SEP}?\d{{4}}(?!\d)|\+[1-9](?:{_SEP}?\(?\d\)?){{7,14}}(?!\d))"),
    ("phone", "digit", r"(?<![\w+])(?:1[ .-])?(?:\(\d{2,4}\)[ .-]?|\d{3}[.-])\d{3}[ .-]?\d{4}(?!\d)"),
    ("phone", "digit", r"(?<![\w+$€£])(?<!\d[.,])(?:(?:1[ \u00a0])?[2-9]\d{2}[ \u00a0]\d{3}[ \u00a0.-]?\d{4}|[2-9]\d{9})(?!\w|[.,]\d)"),
    ("ip", "digit", r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\.?\d)"),
    ("iban", "digit", r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b"),
    ("ssn", "digit", r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"),
    ("card", "digit", r"(?<![\w.])\d(?:[ -]?\d){12,18}(?!\d)"),
    ("name", "title", rf"\b(?P<t>{_TITLES})\.?[ \u00a0](?P<v>{_WORD}(?:[ \u00a0]{_WORD}){{0,2}})"),
]


#: country codes of two digits; 1 and 7 have one, the others three
CODES = set("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())


def phone_form(mention: str) -> str:
    """Plus sign, country code and digits of a phone number (digits only where no code is told)."""
    own = "".join(c for c in (mention.replace("(0)", "") if mention[0] == "+" else mention) if c.isdigit())
    if mention[0] == "+":
        return "+" + own
    return "+1" + own if len(own) == 10 else "+" + own if len(own) == 11 and own[0] == "1" else own


def detector():
    """A function from a text to its entities ``(start, stop, type, normal form)``, in order, without overlap."""
    compiled = [(kind, needs, re.compile(p)) for kind, needs, p in PATTERNS]
    digits = re.compile(r"\d")
    title = re.compile(rf"\b(?:{_TITLES})\.?[ \u00a0]")

    def detect(text: str) -> list[tuple[int, int, str, str]]:
        found = []
        has = {"": True, "@": "@" in text, "digit": digits.search(text), "title": title.search(text)}
        for order, (kind, needs, p) in enumerate(compiled):
            if not has[needs]:
                continue
            for m in p.finditer(text):
                start, stop = m.span("v") if "v" in p.groupindex else m.span()
                form = text[start:stop]
                if kind == "name":
                    t = m["t"].lower()
                    form = ("m" if t in MALE else "f" if t in FEMALE else "n") + ":" + form.replace("\u00a0", " ").casefold()
                elif kind == "phone":
                    form = phone_form(form)
                elif kind in ("card", "ssn"):
                    form = "".join(c for c in form if c.isdigit())
                elif kind == "iban":
                    form = form.replace(" ", "")
                else:
                    form = form.lower()
                found.append((start, -(stop - start), order, kind, form))
        out, end = [], 0
        for start, minus, _, kind, form in sorted(found):
            if start >= end:
                end = start - minus
                out.append((start, end, kind, form))
        return out

    return detect


class _Stream:
    """Numbers drawn from HMAC-SHA256 in counter mode."""

    def __init__(self, key: bytes, name: str):
        self.key, self.name, self.at, self.left = key, name.encode("utf-8", "surrogatepass"), 0, b""

    def below(self, n: int) -> int:
        if len(self.left) < 4:
            self.left = hmac.new(self.key, self.at.to_bytes(4, "big") + self.name, hashlib.sha256).digest()
            self.at += 1
        x, self.left = int.from_bytes(self.left[:4], "big"), self.left[4:]
        return x % n


def _luhn(digits: str) -> bool:
    total = sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits)))
    return total % 10 == 0


def _letter(c: str, s: _Stream) -> str:
    """A letter of the same script and case (scripts by blocks of letters)."""
    if "a" <= c <= "z":
        return chr(97 + s.below(26))
    if "A" <= c <= "Z":
        return chr(65 + s.below(26))
    for lo, hi in ((0xDF, 0xF6), (0xC0, 0xD6), (0x3B1, 0x3C1), (0x391, 0x3A1), (0x430, 0x44F), (0x410, 0x42F), (0x5D0, 0x5EA),
                   (0x3042, 0x3093), (0x30A2, 0x30F3), (0x4E00, 0x9FA5), (0xAC00, 0xD7A3)):
        if lo <= ord(c) <= hi:
            return chr(lo + s.below(hi - lo + 1))
    return c


def _script(name: str) -> str:
    return "cyrillic" if any("а" <= c <= "я" or c == "ё" for c in name) else "latin"


def surrogate(kind: str, form: str, attempt: int, key: bytes) -> str:
    """The normal form of the surrogate of an entity."""
    s = _Stream(key, f"{kind}\0{form}\0{attempt}")
    if kind == "name":
        last = form[2:].rpartition(" ")[2]
        given = surrogate("given", form, attempt, key).rpartition(" ")[0]
        return f"{form[0]}:{given} ".replace(": ", ":") + surrogate("surname", last, attempt, key)
    if kind == "surname":
        syllables = SYLLABLES[_script(form)]
        return "".join(syllables[s.below(len(syllables))] for _ in range(3 + attempt // 8))
    if kind == "given":  # with the real last word: given names differ among those who share it
        *given, last = form[2:].split(" ")
        first = FIRST[_script("".join(given)), form[0]] if given else ()
        # too few first names: joined ones
        return " ".join([*("-".join(first[s.below(len(first))].casefold() for _ in range(1 + attempt // 4)) for _ in given), last])
    if kind == "ip":
        parts = []
        for p in form.split("."):
            n = len(p) if attempt < 8 else 1 + s.below(3)
            parts.append(str(s.below(10) if n == 1 else 10 + s.below(90) if n == 2 else 100 + s.below(156)))
        return ".".join(parts)
    if kind == "email":
        local, _, domain = form.partition("@")
        if attempt >= 8:  # too few of this length: longer ones
            local += "x" * (attempt // 8)
        host, dot, top = domain.rpartition(".")
        turn = lambda t: "".join(str(s.below(10)) if c.isdigit() else _letter(c, s) if c.isalpha() else c for c in t)
        return turn(local) + "@" + turn(host) + dot + top
    if kind == "iban":
        return form[:2] + "".join(str(s.below(10)) if c.isdigit() else _letter(c, s) for c in form[2:])
    if kind == "secret":
        if attempt >= 8:  # too few of this length: longer ones
            form += "x" * (attempt // 8)
        hexadecimal = all(c in "0123456789abcdef" for c in form)
        return "".join((str(s.below(10)) if c.isdigit() else "abcdef"[s.below(6)] if hexadecimal else _letter(c, s) if c.isalpha() else c) for c in form)
    own = [str(s.below(10)) for _ in form]
    if kind == "phone" and form[0] == "+":
        code = 2 if form[1] in "17" else 3 if form[1:3] in CODES else 4
        own[:code] = form[:code]
    if kind == "card":
        own[0] = form[0]
        valid = _luhn(form)
        while _luhn("".join(own)) != valid:
            own[-1] = str((int(own[-1]) + 1) % 10)
    return "".join(own)


def render(kind: str, mention: str, form: str) -> str:
    """A surrogate's normal form in the format of a mention: its separators and case."""
    if kind == "name":
        words = re.split(r"([ \u00a0])", mention)
        given = form[2:].split(" ")
        for i, w in enumerate(given):
            words[2 * i] = w.upper() if words[2 * i].isupper() else "-".join(x.capitalize() for x in w.split("-"))
        return "".join(words)
    if kind == "phone":
        trunk = mention.find("(0)") if mention[0] == "+" else -1  # is no digit of the form
        places = [i for i, c in enumerate(mention) if c.isdigit() and not (trunk >= 0 and i == trunk + 1)]
        own = dict(zip(reversed(places), reversed(form), strict=False))  # a mention may lack the country code
        return "".join(own.get(i, c) for i, c in enumerate(mention))
    if kind in ("card", "ssn", "iban"):
        it = iter(form)
        return "".join(next(it) if c.isalnum() else c for c in mention)
    if kind in ("email", "secret"):
        if mention.isupper():
            return form.upper()
        if len(mention) == len(form):
            return "".join(f.upper() if m.isupper() and len(f.upper()) == 1 else f for m, f in zip(mention, form, strict=True))
    return form


def entities(docs: DataFrame, text: str = "text") -> DataFrame:
    """``key, kind, form``: the distinct entities of every text, under a hash of the text."""

    def task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        detect = detector()
        for b in it:
            rows = {(k, kind, form) for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) if t
                    for _, _, kind, form in detect(t)}
            out = sorted(rows)
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.string()),
                                              pa.array([r[2] for r in out], pa.string())], ["key", "kind", "form"])

    return docs.select(F.xxhash64(text).alias("key"), text).mapInArrow(tv.tidy(task), "key long, kind string, form string").distinct()


def _parts(found: DataFrame) -> DataFrame:
    """``form, given, surname`` of every name: the forms of its two entities
    (null where nothing stands before the last word)."""
    names = found.where("kind = 'name'").select("form").distinct()
    name, gender = F.substring("form", 3, 1 << 30), F.substring("form", 1, 1)
    told = names.groupBy(name.alias("name")).agg(F.collect_set(F.when(gender != "n", gender)).alias("told"))  # at most two
    only = F.when((gender == "n") & (F.size("told") == 1), F.col("told")[0]).otherwise(gender)
    return names.withColumn("name", name).join(told, "name").select(
        "form", F.when(F.col("name").contains(" "), F.concat(only, F.lit(":"), "name")).alias("given"),
        F.substring_index("name", " ", -1).alias("surname"))


def assign(found: DataFrame, key: bytes) -> DataFrame:
    """``kind, form, surrogate`` of every entity, without collisions."""
    parts = stage(_parts(found), "names")
    own = (found.where("kind <> 'name'").select("kind", "form")
           .union(parts.select(F.lit("surname"), "surname")).union(parts.where("given is not null").select(F.lit("given"), "given")))
    given = _without_collisions(own.distinct(), key)
    first = given.where("kind = 'given'").select(F.col("form").alias("given"), F.regexp_replace("surrogate", "[^ ]+$", "").alias("first"))
    last = given.where("kind = 'surname'").select(F.col("form").alias("surname"), F.col("surrogate").alias("last"))
    names = parts.join(last, "surname").join(first, "given", "left").select(
        F.lit("name").alias("kind"), "form", F.concat(F.substring("form", 1, 2), F.coalesce("first", F.lit("")), "last").alias("surrogate"))
    return given.where("kind not in ('given', 'surname')").union(names)


def _without_collisions(own: DataFrame, key: bytes) -> DataFrame:
    """``kind, form, surrogate``; values are compared as written, a given name's without its gender."""

    @F.arrow_udf("string")
    def named(kind: pa.Array, form: pa.Array, attempt: pa.Array) -> pa.Array:
        return pa.array([surrogate(a, b, c, key) for a, b, c in zip(kind.to_pylist(), form.to_pylist(), attempt.to_pylist(), strict=True)], pa.string())

    given = stage(own.withColumn("attempt", F.lit(0)).withColumn("surrogate", named("kind", "form", "attempt")), "surrogates")
    while True:
        keeper = given.groupBy("kind", "surrogate").agg(F.min(F.struct("attempt", "form")).alias("first"), F.count("*").alias("n")).where("n > 1")
        real = given.select("kind", F.when(F.col("kind") == "given", F.substring("form", 3, 1 << 30)).otherwise(F.col("form")).alias("surrogate"))
        twice = given.join(keeper, ["kind", "surrogate"]).where("form <> first.form").select("kind", "form")
        taken = given.join(real, ["kind", "surrogate"], "left_semi").select("kind", "form")
        moved = stage(twice.union(taken).distinct(), "moved")
        if not moved.take(1):
            return given.select("kind", "form", "surrogate")
        if given.agg(F.max("attempt")).first()[0] > 200:
            raise ValueError("no surrogates left of some type")
        again = given.join(moved, ["kind", "form"], "left_semi").select("kind", "form", (F.col("attempt") + 1).alias("attempt"))
        given = stage(given.join(moved, ["kind", "form"], "left_anti").union(
            again.withColumn("surrogate", named("kind", "form", "attempt")).select(*given.columns)), "surrogates")


def replace_entities(docs: DataFrame, key: bytes, text: str = "text", count: str = "n_entities") -> DataFrame:
    """``docs`` with surrogates in the text, and in the column ``count`` (in
    place of one of that name) the mentions replaced."""
    docs = docs.drop(count)
    found = stage(entities(docs, text), "entities")
    named = stage(assign(found, key), "assigned")
    # few and bounded by one text: its own distinct entities
    per_text = stage(found.join(named, ["kind", "form"]).groupBy("key")
                     .agg(F.collect_list(F.struct("kind", "form", "surrogate")).alias("own")), "replacements")
    free = "_" * (1 + max((len(c) for c in docs.columns), default=0))  # no name of the input
    keyed = docs.withColumn(free, F.xxhash64(text))
    clear, rest = graph.split_by(keyed, per_text, "key", free)
    met = rest.join(per_text.select(F.col("key").alias(free), F.col("own").alias(free + "_")), free, "left")
    columns = docs.columns
    place = columns.index(text)

    def task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        detect = detector()
        for b in it:
            texts, counts = [], []
            for t, own in zip(b.column(place).to_pylist(), b.column(len(columns)).to_pylist(), strict=True):
                names = {(x["kind"], x["form"]): x["surrogate"] for x in own or ()}
                parts, end, n = [], 0, 0
                for start, stop, kind, form in detect(t) if t and names else ():
                    parts += [t[end:start], render(kind, t[start:stop], names[kind, form])]
                    end, n = stop, n + 1
                texts.append("".join(parts) + t[end:] if n else t)
                counts.append(n)
            arrays = [b.column(i) for i in range(len(columns))]
            arrays[place] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(counts, pa.int64())], [*columns, count])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + f", `{count}` long"
    changed = met.select(*columns, free + "_").mapInArrow(tv.tidy(task), schema)
    return clear.select(*columns, F.lit(0).cast("long").alias(count)).union(changed)
