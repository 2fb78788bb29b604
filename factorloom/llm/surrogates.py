"""Personal data: keyed surrogates of the same type, gender, script and format.

Detected entities are reduced to a type and a canonical form (digits of a number, lower-case address, one name word), so
that all mentions of an entity in the whole table get one surrogate. A person is announced by a title; further mentions of
the names so found are looked for in the same text, with or without a title. A name word has one surrogate whether given
or family name; its gender is taken over all of its titled mentions. A surrogate comes from an HMAC of type, form and
attempt. Distinctness is checked over the table: of entities that drew the same surrogate one keeps it, and a surrogate
that is itself somebody's real form or taken already is drawn again, later from a larger space, so that rounds end however
crowded a type is. Texts that can hold an entity are read for entities once and written; all others pass by.
"""

from __future__ import annotations

import bisect
import functools
import hashlib
import hmac
import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, stored, whole_text

#: Attempts after which a number or address may leave its length or range; every few more make the space larger.
CROWDED = 24

# fixed values: titles that announce a person, by gender
TITLES = {
    "m": ("Mr", "Herr", "Herrn", "Sr", "Señor", "Don", "Monsieur", "Signor", "Господин", "господин", "Κύριος"),
    "f": ("Mrs", "Ms", "Miss", "Frau", "Sra", "Señora", "Doña", "Madame", "Mme", "Mlle", "Signora", "Госпожа", "госпожа", "Κυρία"),
    "u": ("Dr", "Prof"),
}
GENDER = {t: g for g, titles in TITLES.items() for t in titles}
_TITLE = "|".join(sorted(GENDER, key=len, reverse=True))
_NAME = r"[^\W\d_a-zß-öø-ÿа-яα-ω][^\W\d_]+(?:[-'’](?![sS](?!\w))[^\W\d_]+)*"  # a genitive's s is not of the name
_WORD = re.compile(r"(?<!\w)[^\W\d_]+(?:[-'’](?![sS](?!\w))[^\W\d_]+)*(?!\w)")

OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
PATTERNS = (
    ("email", re.compile(r"(?<![\w.%+-])[\w.%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}")),
    ("ip", re.compile(rf"(?<![\w.])(?:{OCTET}\.){{3}}{OCTET}(?![\w]|\.[0-9])")),
    ("ssn", re.compile(r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])")),
    ("card", re.compile(r"(?<![\w.-])(?:[0-9]{4}[ -]){3}[0-9]{1,7}(?![\w-])|(?<![\w.-])[0-9]{13,19}(?!\w)")),
    ("phone", re.compile(r"(?<![\w.])(?:\+[0-9]{1,3}[ .-]?)?\([0-9]{2,4}\)[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}(?!\w)"
                         r"|(?<![\w.])\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,4}(?!\w)"
                         r"|(?<![\w.-])[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}(?![\w-])")),
    ("name", re.compile(rf"(?<!\w)({_TITLE})(?:\.|(?!\w))[  ]({_NAME}(?: {_NAME}){{0,2}})")),
)
#: A text that does not match this holds no entity: what each pattern needs, behind a look at the first character.
MAYBE = (rf"(?=[@0-9(+{''.join(sorted({t[0] for t in GENDER}))}])(?:@|[0-9]{{1,3}}(?:\.[0-9]{{1,3}}){{3}}|[0-9]-[0-9]{{2}}-[0-9]{{4}}"
         r"|[0-9]{13}|[0-9]{4}[ -][0-9]{4}[ -]|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}|\([0-9]{2,4}\)|\+[0-9]"
         rf"|(?:{_TITLE})\.?[  ])")


def find(text: str) -> list[tuple[int, int, str, str]]:
    """(start, stop, kind, canonical form) of all entities, by start, none overlapping; earlier patterns go first.

    A word of a titled name is ``given_m``, ``given_f``, ``given_u`` or ``surname``; a later or earlier capitalised mention
    of such a word in the text is a ``name``. A word that the text also writes in lower case (Mr White, white paint) is not
    taken for the name where it starts a sentence.
    """
    found = []
    for kind, pattern in PATTERNS:
        for m in pattern.finditer(text):
            if kind != "name":
                form = m[0].lower() if kind in ("email", "ip") else re.sub(r"\D", "", m[0])
                found.append((m.start(), m.end(), kind, form))
                continue
            words = list(re.finditer(_NAME, m[2]))
            for i, w in enumerate(words):
                last = i == len(words) - 1
                found.append((m.start(2) + w.start(), m.start(2) + w.end(),
                              "surname" if last else "given_" + GENDER[m[1]], w[0].casefold()))
    order = {kind: i for i, (kind, _) in enumerate(PATTERNS)}
    starts, chosen = [], []

    def free(start, stop):
        at = bisect.bisect(starts, start)
        return (not at or chosen[at - 1][1] <= start) and (at == len(starts) or stop <= starts[at])

    for entity in sorted(found, key=lambda e: order.get(e[2], len(order))):
        if free(*entity[:2]):
            at = bisect.bisect(starts, entity[0])
            starts.insert(at, entity[0])
            chosen.insert(at, entity)
    names = {e[3] for e in chosen if type_of(e[2]) == "name"}
    return sorted(chosen + _mentions(text, names, free)) if names else chosen


def type_of(kind: str) -> str:
    """What surrogates are told apart by: all words of names are of one type."""
    return "name" if kind.startswith(("given", "surname", "name")) else kind


def _mentions(text: str, names: set[str], free: Callable[[int, int], bool]) -> list[tuple[int, int, str, str]]:
    """The capitalised words of a text that are one of ``names``, also as parts of a hyphenated word, in free places."""
    capital, common = [], set()
    for word in _WORD.finditer(text):
        whole = word[0].casefold() in names
        for part in (word,) if whole else re.finditer(r"[^-]+", word[0]) if "-" in word[0] else ():
            form, at = part[0].casefold(), part.start() if whole else word.start() + part.start()
            if form in names and free(at, at + len(part[0])):
                if part[0][0].islower():
                    common.add(form)
                else:
                    capital.append((at, at + len(part[0]), "name", form))
    return [m for m in capital if m[3] not in common or not _starts_sentence(text, m[0])]


def _starts_sentence(text: str, at: int) -> bool:
    while at and text[at - 1] in " \t\u00a0\"'“„«(":
        at -= 1
    return not at or text[at - 1] in ".!?\r\n\u2028"


class _Stream:
    """Numbers drawn from the HMAC of a message, extended by a counter."""

    def __init__(self, key: bytes, message: str):
        self.key, self.message, self.block, self.rest = key, message, 0, b""

    def below(self, n: int) -> int:
        if len(self.rest) < 4:
            self.rest = hmac.digest(self.key, f"{self.block}|{self.message}".encode(), hashlib.sha256)
            self.block += 1
        value, self.rest = int.from_bytes(self.rest[:4], "big"), self.rest[4:]
        return value % n


# fixed values: sounds that names are made of, by script: consonants, vowels, endings for m, f and any
SOUNDS = {
    "LATIN": ("b c d f g h k l m n p r s t v w z br dr gr kr st tr".split(), "a e i o u".split(),
              {"m": "an en on us or ik".split(), "f": "a ia ina elle ara".split(), "u": "er in ow ek".split()}),
    "CYRILLIC": ("б в г д ж з к л м н п р с т в".split(), "а е и о у".split(),
                 {"m": "ан ен ор ей".split(), "f": "а ия ина".split(), "u": "ен ук ар".split()}),
    "GREEK": ("β γ δ κ λ μ ν π ρ σ τ φ".split(), "α ε η ο ι".split(),
              {"m": "ος ης ας".split(), "f": "α η ια".split(), "u": "ου ιδι".split()}),
}


def _script(word: str) -> str:
    first = ord(word[0])
    return "CYRILLIC" if 0x400 <= first < 0x530 else "GREEK" if 0x370 <= first < 0x400 else (
        "LATIN" if first < 0x250 or 0x1E00 <= first < 0x1F00 else "OTHER")


def _luhn(digits: str) -> int:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10


def surrogate(key: bytes, kind: str, form: str, attempt: int) -> str:
    """A canonical form of the same kind. A number keeps its length and whether it passes the Luhn test; an address its
    letters, digits and marks as such and its top domain; a name (``name_m``, ``name_f`` or ``name_u``) its script and gender.
    Attempts beyond ``CROWDED`` add digits to a number, letters to a mail address and take other private networks, then any."""
    draw = _Stream(key, f"{kind}|{attempt}|{form}")
    extra = max(0, attempt - CROWDED + 4) // 4
    if kind in ("phone", "card", "ssn"):
        digits = [str(draw.below(10)) for _ in range(len(form) + extra)]
        digits[0] = str(1 + draw.below(9))
        if kind == "card" and _luhn(form) == 0:
            digits[-1] = next(d for d in "0123456789" if _luhn("".join(digits[:-1]) + d) == 0)
        return "".join(digits)
    if kind == "ip":
        parts = form.split(".")
        if form.startswith("192.168.") and extra:
            parts[0] = "10"
        kept = 0 if extra > 2 else 1 if parts[0] in ("10", "127") else 2 if form.startswith("192.168.") else 0
        return ".".join(parts[:kept] + [str(1 + draw.below(254)) for _ in parts[kept:]])
    if kind == "email":
        at = form.rindex(".")
        letters, vowels = "bcdfghklmnprstvwz", "aeiou"
        out = []
        for i, c in enumerate(form[:at]):
            if c.isdigit():
                out.append(str(draw.below(10)))
            elif c.isalpha():
                out.append((vowels if i % 2 else letters)[draw.below(5 if i % 2 else 17)])
            else:
                out.append(c)
        longer = "".join((vowels if i % 2 else letters)[draw.below(5 if i % 2 else 17)] for i in range(extra))
        return longer + "".join(out) + form[at:]
    script = _script(form)
    if script == "OTHER":  # letters of the neighbourhood; more of them if need be
        return "".join(chr(ord(c) // 64 * 64 + draw.below(64)) if c.isalpha() else c for c in form + form[-1] * (attempt // 8))
    consonants, vowels, ends = SOUNDS[script]
    gender = kind[-1]
    syllables = max(1, min(4, len(form) // 3)) + attempt // 4
    body = "".join(consonants[draw.below(len(consonants))] + vowels[draw.below(len(vowels))] for _ in range(syllables))
    return body + consonants[draw.below(len(consonants))] + ends[gender][draw.below(len(ends[gender]))]


def dressed(form: str, mention: str, kind: str) -> str:
    """A surrogate in the format of the mention: its marks between digits, its capitals."""
    if kind in ("phone", "card", "ssn"):
        digits = iter(form)
        return "".join(next(digits) if c.isdigit() else c for c in mention) + "".join(digits)
    if mention.isupper() and len(mention) > 1:
        return form.upper()
    if kind == "email":
        return "".join(f.upper() if m.isupper() else f for f, m in zip(form, mention)) if len(form) == len(mention) else form
    return form if kind == "ip" else form[:1].upper() + form[1:]


def assign(entities: DataFrame, key: bytes) -> DataFrame:
    """(type, form, surrogate) for the distinct ``type`` and ``form`` of ``entities`` (type, form, kind): one surrogate
    each, no two of a type alike, none of them a form of that type that occurs. A name is male or female if the titled
    given names of that form are of one gender only."""
    gender = F.when(F.bool_or(F.col("kind") == "given_m") & ~F.bool_or(F.col("kind") == "given_f"), "m").when(
        F.bool_or(F.col("kind") == "given_f") & ~F.bool_or(F.col("kind") == "given_m"), "f").otherwise("u")
    kind = F.when(F.col("type") == "name", F.concat(F.lit("name_"), gender)).otherwise(F.col("type"))
    real = stored(entities.groupBy("type", "form").agg(kind.alias("kind")), "entities")

    @F.pandas_udf("string")
    def draw(kind: pd.Series, form: pd.Series, attempt: pd.Series) -> pd.Series:
        return pd.Series([surrogate(key, k, f, a) for k, f, a in zip(kind, form, attempt)], dtype=object)

    won, pending, attempt = [], real, 0
    while not won or not pending.isEmpty():
        drawn = stored(pending.withColumn("surrogate", draw("kind", "form", F.lit(attempt))), "drawn")
        taken = functools.reduce(DataFrame.union, [w.select("type", "surrogate") for w in won],
                                 real.select("type", F.col("form").alias("surrogate")))
        free = drawn.join(taken, ["type", "surrogate"], "left_anti")
        won.append(stored(free.groupBy("type", "surrogate").agg(F.min("form").alias("form")), "won"))
        pending = stored(drawn.drop("surrogate").join(won[-1], ["type", "form"], "left_anti"), "pending")
        attempt += 1
    return functools.reduce(DataFrame.union, won)


def replace(docs: DataFrame, key: bytes) -> DataFrame:
    """The rows and columns of ``docs`` with each entity in ``text`` replaced, and ``entities`` (a taken name gets an
    underscore): an array of (kind, start, stop, surrogate) with code points of the old text, empty if there are none.

    ``n_chars``, if there, is counted anew where the text changed. A null text stays null. Rows of the same text get the
    same result whatever their ids, null ones too. Very long texts are read whole. An empty table gives an empty result.
    """
    row, entities = (free_name(docs, n) for n in ("row_", "entities"))
    found_, known_, out = "found of " + row, "known of " + row, "out of " + row
    span = "array<struct<kind:string,start:int,stop:int,{}:string>>"

    @F.pandas_udf(span.format("form"))
    def found(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [{"kind": k, "start": a, "stop": b, "form": f} for a, b, k, f in find(t)])

    @F.pandas_udf(f"text string, entities {span.format('surrogate')}")
    def change(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
        new, all_ = [], []
        for text, known in zip(texts, spans):
            parts, at, put = [], 0, []
            for e in known:
                as_ = dressed(e["surrogate"], text[e["start"]:e["stop"]], e["kind"])
                parts += [text[at:e["start"]], as_]
                put.append({"kind": e["kind"], "start": e["start"], "stop": e["stop"], "surrogate": as_})
                at = e["stop"]
            new.append("".join(parts) + text[at:])
            all_.append(put)
        return pd.DataFrame({"text": new, "entities": all_})

    maybe = F.coalesce(F.col("text").rlike(MAYBE), F.lit(False))
    read = stored(docs.where(maybe).withColumn(found_, found(whole_text())).withColumn(row, F.monotonically_increasing_id()), "read")
    each = read.select(row, F.explode(found_).alias("e")).select(row, "e.*").withColumn("type", F.when(
        F.col("kind").rlike("^(given|surname|name)"), "name").otherwise(F.col("kind")))
    known = (each.join(assign(each, key), ["type", "form"]).groupBy(row)
             .agg(F.array_sort(F.collect_list(F.struct("start", "stop", "kind", "surrogate"))).alias(known_)))
    joined = read.join(known, row, "left").withColumn(out, F.when(F.col(known_).isNotNull(), change(
        whole_text(), F.coalesce(known_, F.array().cast("array<struct<start:int,stop:int,kind:string,surrogate:string>>")))))
    none = F.array().cast(span.format("surrogate"))
    if "n_chars" in docs.columns:
        count = F.length(F.col(out)["text"]).cast(docs.schema["n_chars"].dataType)
        joined = joined.withColumn("n_chars", F.coalesce(count, F.col("n_chars")))
    changed = joined.withColumn(entities, F.coalesce(F.col(out)["entities"], none)).withColumn(
        "text", F.coalesce(F.col(out)["text"], F.col("text")))
    columns = [*docs.columns, entities]
    return changed.select(*columns).union(docs.where(~maybe).withColumn(entities, none).select(*columns))
