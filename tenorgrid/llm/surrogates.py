"""Personal data by surrogate generation.

Entities are found by their shapes: mail addresses (also of international domains), phone numbers, IPv4 and IPv6 addresses
(also compressed), card, account and social security numbers, numbers behind a word for telephone, and names behind a form of
address or a phrase that introduces one. Each distinct entity gets a replacement of its own type and
format from a keyed hash: digits stay digits at their places, check digits are valid where they were, names keep the
gender of their form of address (in Latin and Cyrillic, which have lists of first names), the script and the capitals,
and initials follow the name behind them. One entity has one replacement in the whole corpus,
however it is written (coreference), and two entities never share one: claims to a replacement are counted over all
distinct entities, the first keeps it, the others draw again, and no replacement may be an entity of the corpus. Settled
claims leave the loop. Formats widen after some draws (longer words and labels, another range of numbers), and after
``LAST`` draws a replacement is a label with a hash of 128 bits, so the loop always ends: all but the largest corpora see
none of these.

Replacing is distributed: entities of a document are joined to their replacements and only documents that may have
entities, by a bitmap of bounded size, are shuffled; all others pass through unread by Python code. An entity that a
third of the documents have is one row in the table of entities, and its many occurrences are rows of a join.

Texts are named by their SHA-256. Null text stays null. Repeated rows are replaced alike. Extra columns stay, whatever they
are called; where one is ``n_entities``, the number of entities is ``_n_entities``. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenorgrid.llm.common import Sheltered, free, keep, mark_maybe

DEMO_KEY = b"replace-this-key"  # a parameter: name a secret of your own in production
LAST = 32
LABEL = re.compile(r"[a-z0-9]+-[0-9a-f]{32}")

# Forms of address with the gender they show, first names of the replacements by script and gender.
ADDRESS = {"Mr": "m", "Mister": "m", "Sir": "m", "Herr": "m", "Monsieur": "m", "Señor": "m", "Sr": "m", "Господин": "m",
           "Mrs": "f", "Ms": "f", "Miss": "f", "Madam": "f", "Frau": "f", "Madame": "f", "Mme": "f", "Mlle": "f", "Señora": "f",
           "Sra": "f", "Госпожа": "f", "Dr": "n", "Prof": "n"}
FIRST = {
    ("latin", "m"): "Adam Arthur Bruno David Edgar Felix Hugo Jonas Leo Marco Martin Oscar Paul Peter Robert Simon Thomas Victor".split(),
    ("latin", "f"): "Alice Anna Clara Diana Elena Emma Helen Irene Julia Laura Lucia Maria Nora Olivia Paula Rosa Sara Vera".split(),
    ("latin", "n"): "Alex Andrea Charlie Dominique Kim Luca Robin Sascha".split(),
    ("cyrillic", "m"): "Антон Борис Виктор Глеб Иван Марк Олег Павел Роман Фёдор".split(),
    ("cyrillic", "f"): "Анна Вера Галина Дарья Елена Ирина Мария Нина Ольга Софья".split(),
    ("cyrillic", "n"): "Саша Женя Валя Шура".split(),
}
SYLLABLES = {"latin": "ba be bo da de di fa fi ga ge ha he ka ke ki la le li lo ma me mi mo na ne no pa pe ra re ri ro sa se si so ta te ti to va ve vi".split(),
             "cyrillic": "ба бе бо ва ве ви га го да де ди ка ке ко ла ле ли ло ма ме ми на не но па пе ра ре ри ро са се та те ти то".split()}

def _ranges(categories: tuple[str, ...]) -> str:
    """The letters of these categories as the inside of a character class."""
    runs: list[list[int]] = []
    for c in range(sys.maxunicode + 1):
        if unicodedata.category(chr(c)) in categories:
            if runs and runs[-1][1] == c - 1:
                runs[-1][1] = c
            else:
                runs.append([c, c])
    return "".join(f"{chr(a)}-{chr(b)}" for a, b in runs)


# A name word starts with a letter that is not a small one and goes on to where its letters end; apostrophes and
# hyphens count between letters, but for a possessive s. Forms of address and suffixes are no name words.
_TITLES = "|".join(sorted(ADDRESS, key=len, reverse=True))
_LETTER, _MARK, _START = r"[^\W\d_]", "[\u0300-\u036f]*", f"[{_ranges(('Lu', 'Lt', 'Lo'))}]"
_NAME = (rf"(?!(?:{_TITLES}|Jr|I|II|III|IV)(?![\w'’-]))(?:[dl]['’]|[ae]l-)?{_START}{_MARK}"
         rf"(?:{_LETTER}{_MARK}|['’ʼ](?![sS](?!{_LETTER}))(?={_LETTER})|[-‐‑](?={_LETTER}))*(?!{_LETTER})")
_INITIALS = rf"(?:{_START}{_MARK}\.\x20?(?={_START}))*"
_PARTICLES = r"(?:(?:van|von|vom|der|den|de|del|della|di|da|do|dos|das|du|la|le|el|al|bin|ibn|ben|zu|zur|ter|ten|af|av|y)\x20){0,3}"
_WORDS = rf"{_INITIALS}{_NAME}(?:\x20{_PARTICLES}{_INITIALS}{_NAME})*"
_ONE_WORD = re.compile(rf"(?<!\w)(?P<initials>{_INITIALS})(?P<word>{_NAME})")
# Words for a telephone before its number, and phrases that introduce a name.
_CALL = "|".join(f"{w}|{w.capitalize()}|{w.upper()}" for w in "telephone telefon tel phone fon mobile mobil fax".split())
_INTRO = "|".join(("[Mm]y name is", "[Mm]ein Name ist", "[Ii]ch heiße", "[Jj]e m['’]appelle", "[Mm]e llamo", "[Mm]i nombre es", "[Мм]еня зовут"))
ENTITY = re.compile(
    r"(?P<email>(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]*@[^\W_](?:[\w-]*[^\W_])?(?:\.[^\W_](?:[\w-]*[^\W_])?)*\.[^\W\d_]{2,})"
    r"|(?P<ip6>(?<![\w:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}"
    r"|(?=[0-9A-Fa-f:]*[0-9])(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5})?::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5})?)(?![\w:]))"
    r"|(?P<ip>(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\w|\.\d))"
    r"|(?P<iban>(?<!\w)[A-Z]{2}\d{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?!\w))"
    r"|(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))"
    r"|(?P<card>(?<!\w)(?<!\d[.+-])[3-6]\d{3}(?:[\x20-]?\d{4}){2}[\x20-]?\d{1,7}(?!\w))"
    r"|(?P<phone>(?<![\w.])\+1[\x20.-]?(?:\(\d{3}\)|\d{3})[\x20.-]?\d{3}[\x20.-]?\d{4}(?!\d)|(?<![\w.])(?:\+\d{1,3}[\x20.-]?)(?:\(\d{1,4}\)[\x20.-]?)?\d{1,5}(?:[\x20.-]\d{1,5}){0,5}(?!\w)"
    r"|(?<![\w.])\(\d{3}\)\x20?\d{3}[-.\x20]\d{4}(?!\w)|(?<![\w.-])\d{3}[-.]\d{3}[-.]\d{4}(?![\w-])"
    r"|(?<![\w.,+/-])0[1-9]\d{1,3}[\x20/-]\d{5,8}(?![\w,.-]*\d))"
    rf"|(?<!\w)(?:{_CALL})[.:]{{0,2}}\x20?(?P<called>\d(?:[\x20./-]?\d){{4,12}})(?!\w)"
    rf"|(?P<name>(?<!\w)(?:(?P<title>{_TITLES})\.?|(?P<intro>{_INTRO}))\x20{_PARTICLES}(?P<words>{_WORDS}))")
# Holds for every text with an entity.
SCREEN = "@|[0-9]{2}|[0-9A-Fa-f]::?[0-9A-Fa-f]|::[0-9A-Fa-f]|[0-9A-Fa-f]::|[0-9][\\x20./-][0-9]|(?:" + "|".join(ADDRESS) + rf")\.?\x20|(?:{_INTRO})\x20"


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _script(word: str) -> str:
    name = unicodedata.name(word[0], "LATIN").split()[0].split("-")[0].lower()
    return "latin" if name in ("fullwidth", "modifier") else name


@lru_cache(maxsize=4096)
def _letters(c: str) -> str:
    """The letters of ``c``'s script and kind near it."""
    near = map(chr, range(ord(c) & ~0xFF, (ord(c) | 0xFF) + 1))
    return "".join(x for x in near if unicodedata.category(x) == unicodedata.category(c) and _script(x) == _script(c) and x.casefold() == x) or c


def _name_key(word: str) -> str:
    """A name in one form, however its capitals, accents, apostrophes and hyphens are written."""
    return unicodedata.normalize("NFC", unicodedata.normalize("NFC", word).casefold()).translate(str.maketrans("’ʼ‐‑", "''--"))


def _number(written: str) -> str:
    """The digits of a telephone number; one of ten digits without a country is its +1 number."""
    digits = re.sub(r"\D", "", written)
    return "1" + digits if len(digits) == 10 and not written.startswith(("+", "0")) else digits


def find(text: str) -> list[tuple[int, int, str, str]]:
    """Entities in order: start, end, kind, canonical form. A name gives one entity per word."""
    out, names = [], {}
    for m in ENTITY.finditer(text):
        value = m[0]
        if m["name"]:
            gender = ADDRESS[m["title"]] if m["title"] else "n"
            words = list(_ONE_WORD.finditer(text, m.start("words"), m.end("words")))
            for k, w in enumerate(words):
                kind = f"first_{gender}" if k < len(words) - 1 else "last"
                if len(w["word"]) > 1:
                    names[w["word"]] = kind
                out.append((w.start(), w.end(), kind, _name_key(w["word"])))
            continue
        if m["called"]:
            out.append((m.start("called"), m.end("called"), "phone", _number(m["called"])))
            continue
        kind = next(k for k in ("email", "ip6", "ip", "iban", "ssn", "card", "phone") if m[k])
        if kind == "email":
            value = value.lower()
        elif kind in ("card", "phone", "ssn"):
            value = _number(m[0]) if kind == "phone" else re.sub(r"\D", "", value)
            if kind == "phone" and not 7 <= len(value) <= 15 or kind == "card" and not 13 <= len(value) <= 19:
                continue
        elif kind == "iban":
            value = value.replace(" ", "")
        elif kind == "ip6":
            try:
                value = ipaddress.IPv6Address(value).exploded
            except ValueError:  # too many groups for an address
                continue
        out.append((m.start(), m.end(), kind, value))
    if names:  # later mentions of a name that a form of address has introduced
        taken = [(a, b) for a, b, _, _ in out]
        mention = re.compile(r"(?<!\w)(?:" + "|".join(map(re.escape, sorted(names, key=len, reverse=True))) + r")(?!\w)")
        for m in mention.finditer(text):
            if not any(a < m.end() and m.start() < b for a, b in taken):
                out.append((m.start(), m.end(), names[m[0]], _name_key(m[0])))
        out.sort()
    return out


class Stream:
    """Numbers from a keyed hash of what is replaced and the number of the draw."""

    def __init__(self, key: bytes, kind: str, value: str, attempt: int):
        self.seed, self.n, self.left = hmac.new(key, f"{kind}\x00{value}\x00{attempt}".encode(), hashlib.sha256).digest(), 0, b""

    def below(self, n: int) -> int:
        if len(self.left) < 8:
            self.left = hashlib.sha256(self.seed + self.n.to_bytes(4, "big")).digest()
            self.n += 1
        value, self.left = int.from_bytes(self.left[:8], "big"), self.left[8:]
        return value % n

    def digits(self, shape: str) -> str:
        return "".join(str(self.below(10)) if c.isdigit() else c for c in shape)


def surrogate(key: bytes, kind: str, value: str, attempt: int) -> str:
    """A replacement, in canonical form, of the same type and format as ``value``."""
    s = Stream(key, kind, value, attempt)
    if attempt >= LAST:
        return f"{kind.removeprefix('first_').rstrip('mfn') or 'name'}-{s.seed.hex()[:32]}"
    if kind == "email":
        local, _, domain = value.partition("@")
        letters = "abcdefghijklmnopqrstuvwxyz"
        local = "".join(letters[s.below(26)] if c.isalpha() else str(s.below(10)) if c.isdigit() else c for c in local)
        local += "".join(letters[s.below(26)] for _ in range(attempt // 3))
        label = "".join(letters[s.below(26)] for _ in domain.split(".")[-2][: 20] + "x" * (attempt // 3))
        return f"{local}@{label}.example.{('com', 'net', 'org')[s.below(3)]}"
    if kind == "ip":
        def octet(o: str) -> str:
            low, high = ((0, 9), (10, 99), (100, 254))[len(str(int(o))) - 1] if attempt < 16 else (1, 254)
            return str(low + s.below(high - low + 1))
        return ".".join(octet(o) for o in value.split("."))
    if kind == "ip6":  # groups keep their length, so an address stays as short as it was, until that has too few values
        def group(g: str) -> str:
            n = len(g.lstrip("0")) if attempt < 8 else 4
            return "".join("0123456789abcdef"[s.below(16) if k else 1 + s.below(15)] for k in range(n)).rjust(4, "0")
        return ":".join(map(group, value.split(":")))
    if kind == "ssn":
        return "9" + s.digits(value[1:])  # numbers from 900 are not given out
    if kind == "card":
        body = value[0] + s.digits(value[1:-1])
        if not _luhn(value):
            return body + str(s.below(10))
        return next(body + str(d) for d in range(10) if _luhn(body + str(d)))
    if kind == "phone":
        lead = 1 if value.startswith("1") and len(value) == 11 else 2 if len(value) > 10 else 0
        if attempt >= 16:  # a range of its own, behind a country code that is not given out
            return "999" + "".join(str(s.below(10)) for _ in range(12))
        return value[:lead] + s.digits(value[lead:])
    if kind == "iban":
        body = "".join(str(s.below(10)) if c.isdigit() else "ABCDEFGHIJKLMNOPQRSTUVWXYZ"[s.below(26)] for c in value[4:])
        number = int("".join(str(int(c, 36)) for c in body + value[:2] + "00"))
        return f"{value[:2]}{98 - number % 97:02d}{body}"
    script = _script(value)
    if script not in SYLLABLES:
        new = "".join(pool[s.below(len(pool))] if len(pool := _letters(c)) > 1 else c for c in value)
        return new + "".join((pool := _letters(value[-1]))[s.below(len(pool))] for _ in range(attempt // 8))
    if kind.startswith("first_"):
        pool = FIRST[script, kind[-1]]
        name = pool[s.below(len(pool))]
        # Beyond the list's length a name gets a second part, still of its gender.
        return (name if attempt < 4 else name + "-" + pool[s.below(len(pool))] if attempt < 12 else
                name + "-" + _word(s, script, 3 + (attempt - 12) // 4)).casefold()
    return _word(s, script, max(2, min(6, (len(value) + 1) // 2)) + attempt // 8).casefold()


def _word(s: Stream, script: str, n: int) -> str:
    return "".join(SYLLABLES[script][s.below(len(SYLLABLES[script]))] for _ in range(n)).capitalize()


def written(original: str, kind: str, canonical: str) -> str:
    """The canonical replacement in the form in which the original is written."""
    if LABEL.fullmatch(canonical) or kind == "phone" and canonical.startswith("999") and len(canonical) == 15:
        return canonical if LABEL.fullmatch(canonical) else "+" + canonical
    if kind in ("card", "phone", "ssn", "iban"):
        # a national number is written without its leading 1
        rest = iter(canonical[max(0, len(canonical) - sum(c.isalnum() for c in original)):] if kind == "phone" else canonical)
        return "".join(next(rest, "") if c.isalnum() else c for c in original)
    if kind == "ip6":
        groups = canonical.split(":")
        padded = any(len(g) == 4 and g[0] == "0" for g in original.split(":"))
        short = ipaddress.IPv6Address(canonical).compressed if "::" in original else ":".join(groups if padded else (g.lstrip("0") or "0" for g in groups))
        return short.upper() if original.isupper() else short
    if kind == "email" and original.isupper():
        return canonical.upper()
    if kind == "last" or kind.startswith("first_"):
        m = _ONE_WORD.fullmatch(original)
        initials, word = (m["initials"], m["word"]) if m else ("", original)
        new = canonical.upper() if len(word) > 1 and word.isupper() else "-".join(p.capitalize() for p in canonical.split("-"))
        letters = iter([c.upper() for c in canonical if c.isalpha()] * len(initials))
        return "".join(next(letters) if c.isalpha() else c for c in unicodedata.normalize("NFC", initials)) + new
    return canonical


def _detect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("value", pa.string())]))
    for batch in batches:
        found = [sorted({(k, v) for _, _, k, v in find(t)}) for t in batch.column(1).to_pylist()]
        rows = [k for k, f in enumerate(found) if f]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(rows, pa.int64())), pa.array([[{"kind": k, "value": v} for k, v in found[r]] for r in rows], kind)],
            names=["rid", "found"])


def _draw(key: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, values, attempts = (batch.column(k).to_pylist() for k in range(3))
            new = [surrogate(key, k, v, a) for k, v, a in zip(kinds, values, attempts)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(new, pa.string())],
                                             names=["kind", "value", "attempt", "new"])
    return run


def _family(kind: str):
    """First names of all genders are one family of names, as they are written alike and may name one person."""
    return F.when(F.col(kind).startswith("first_"), F.lit("first")).otherwise(F.col(kind))


def distinct_entities(found: DataFrame) -> DataFrame:
    """``(kind, value)`` once per entity: a first name has one gender, a stated one before none or two stated ones."""
    def stated(kind: str) -> Column:
        return F.max(F.col("kind") == kind)

    m, f = F.col("m"), F.col("f")
    return (found.groupBy(_family("kind").alias("family"), "value").agg(stated("first_m").alias("m"), stated("first_f").alias("f"))
            .select(F.when(F.col("family") != "first", F.col("family")).when(m & ~f, F.lit("first_m"))
                    .when(f & ~m, F.lit("first_f")).otherwise(F.lit("first_n")).alias("kind"), "value"))


def draw_surrogates(entities: DataFrame, key: bytes = DEMO_KEY) -> DataFrame:
    """``(kind, value, new)`` for distinct entities: replacements all different, and none of them an entity.

    A round judges the open claims only: of equal ones the least wins unless the replacement is taken or is an entity.
    What has settled is a table that later rounds read for the replacements of the few that are open.
    """
    shape = "kind string, value string, attempt int, new string"
    claims = ["family", "new"]
    drawn = keep(entities.select("kind", "value", F.lit(0).alias("attempt")).mapInArrow(_draw(key), shape))
    taken = keep(entities.select(_family("kind").alias("family"), F.col("value").alias("new")).distinct())
    settled = None
    while True:
        first = drawn.withColumn("family", _family("kind"))
        mine = first.groupBy(*claims).agg(F.min(F.struct("kind", "value")).alias("owner"))
        lost = taken.join(mine.select(*claims), claims).select(*claims).distinct().withColumn("clash", F.lit(True))
        judged = first.join(mine, claims).join(lost, claims, "left").withColumn(
            "good", F.col("clash").isNull() & (F.col("owner.kind") == F.col("kind")) & (F.col("owner.value") == F.col("value")))
        judged = keep(judged.select("kind", "value", "attempt", "family", "new", "good"))
        good = judged.where("good").select("kind", "value", "family", "new")
        settled = good if settled is None else settled.union(good)
        again = judged.where("NOT good").select("kind", "value", (F.col("attempt") + 1).alias("attempt"))
        if not again.limit(1).count():
            return settled.select("kind", "value", "new")
        taken = taken.union(good.select(*claims))
        drawn = keep(again.mapInArrow(_draw(key), shape))


def _replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, counts = [], []
        for text, names in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            new, out, at = {(n["family"], n["value"]): n["new"] for n in names}, [], 0
            found = find(text)
            for start, end, kind, value in found:
                out += [text[at:start], written(text[start:end], kind, new["first" if kind.startswith("first_") else kind, value])]
                at = end
            texts.append("".join(out) + text[at:])
            counts.append(len(found))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(counts, pa.int64())],
                                         names=["rid", "clean", "n"])


def replace_entities(docs: DataFrame, text: str = "text", key: bytes = DEMO_KEY) -> DataFrame:
    """``docs`` with the entities in ``text`` replaced, and ``n_entities``, their number, as a further column."""
    inside = Sheltered(docs)
    t, count = inside[text], free(docs.columns, "n_entities")[0]
    marks = inside.df.withColumn("rid", F.sha2(t, 256))
    found = keep(marks.where(F.col(t).rlike(SCREEN)).select("rid", t).mapInArrow(
        _detect, "rid string, found array<struct<kind:string,value:string>>").dropDuplicates(["rid"]))
    each = found.select("rid", F.explode("found").alias("e")).select("rid", "e.kind", "e.value")
    new = draw_surrogates(keep(distinct_entities(each)), key).select(_family("kind").alias("family"), "value", "new")
    per_text = keep(each.select("rid", _family("kind").alias("family"), "value").join(new, ["family", "value"])
                    .groupBy("rid").agg(F.collect_list(F.struct("family", "value", "new")).alias("names")))
    marked = mark_maybe(marks, F.col("rid"), per_text, "rid")
    once = marked.where("_maybe").groupBy("rid").agg(F.max(t).alias("whole")).join(per_text, "rid").select("rid", "whole", "names")
    clean = keep(once.mapInArrow(_replace, "rid string, clean string, n bigint"))
    none = F.lit(0).cast("long")
    plain = marked.where("NOT _maybe").select(*inside.inner, none.alias("n"))
    changed = (marked.where("_maybe").join(clean, "rid", "left").withColumn(t, F.coalesce("clean", F.col(t)))
               .select(*inside.inner, F.coalesce("n", none).alias("n")))
    return plain.union(changed).toDF(*docs.columns, count)


def op5_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with personal data replaced."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return replace_entities(docs).select("doc_id", "n_entities", "text")
