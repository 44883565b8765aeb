"""Keyed surrogates for personal data (operator 3).

Entities are found in the whole text:

* e-mail addresses, IPv4 and IPv6 addresses, payment card numbers, IBANs with
  a right checksum, US social security numbers, access keys;
* street addresses in English: house number, capitalised words, kind of street;
* telephone numbers with a country code, with an area code in brackets, as
  3-3-4 digits or with a trunk 0, and any of 7 digits or more after a word such
  as ``tel``;
* passwords and tokens after their keyword, which may end a longer word: what is
  quoted there, else all up to the next space, digits or not;
* all name words after a title or an introduction such as ``my name is``, in any
  script, with initials and particles such as ``van`` between them, and every
  other mention of those words in the same document.

Dates, of birth too, are no entities: their formats have too few values for
distinct surrogates that occur nowhere in a large corpus.

Each is replaced by a surrogate of the same type, format and script:

* characters are permuted within their class (digits, hexadecimal digits,
  letters or marks of one script, case kept) by a keyed Feistel permutation over
  all strings of that format, so different entities of a format get different
  surrogates and an entity gets the same one wherever it occurs;
* card numbers keep their first digit and their checksum, IBANs their country
  and a right checksum, telephone numbers their country code or the digits that
  mark a national number, and a fictional 555 exchange, social security numbers
  valid parts, IP addresses valid ones, streets their kind;
* an e-mail's domain has a surrogate of its own, the same in all addresses, its
  last label kept;
* given names known for the title's gender are permuted within the names of
  that gender, other name words within the letters of their script; the last
  letter is kept in Latin, Cyrillic and Greek, where it often marks the gender.

The key is the caller's, and a secret: whoever has it can undo the surrogates.

Collision check: a surrogate may not equal any entity of the whole corpus, nor
the surrogate of another entity. Entities for which it does take their next
attempt, round by round, until none is left; a format too small for that is
made longer by a character every ATTEMPTS attempts. Documents with such entities
are rewritten with the attempts joined to them.

Rows: a null text stays null and an empty one empty, both with 0 entities;
repeated rows are rewritten alike; null ids are carried; extra columns are not
read; an empty table gives an empty result. Texts without entities are
unchanged, byte for byte.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
import unicodedata
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parlance.llm.common import store

ATTEMPTS = 8
DIGITS, HEX = "0123456789", "0123456789abcdef"
LOWER = "abcdefghijklmnopqrstuvwxyz"
#: Lower-case letters of the commonest scripts; others are permuted within their script's letters on the same page of 256.
SCRIPTS = (LOWER, "àáâãäåæçèéêëìíîïñòóôõöøùúûüýÿœ", "абвгдежзийклмнопрстуфхцчшщыэюя", "αβγδεζηθικλμνξοπρστυφχψω")
#: Titles by gender.
TITLES = {"m": ("Mr", "Herr", "Sr", "Monsieur", "Señor", "г-н", "Κος"), "f": ("Mrs", "Ms", "Miss", "Frau", "Sra", "Mme", "Madame", "Señora", "г-жа", "Κα")}
#: Given names by gender and script.
GIVEN = {
    "m": (("james", "john", "robert", "michael", "david", "thomas", "peter", "paul", "hans", "klaus", "pierre", "jean", "louis", "carlos", "juan", "luis"), ("иван", "пётр", "олег", "сергей", "андрей", "павел", "михаил", "юрий")),
    "f": (("mary", "anna", "linda", "susan", "karen", "lisa", "emma", "julia", "ursula", "petra", "marie", "claire", "sophie", "carmen", "maria", "lucia"), ("анна", "мария", "ольга", "елена", "ирина", "наталья", "светлана", "татьяна")),
}

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_TITLES = tuple(t for g in TITLES.values() for t in g)
_TITLE = "|".join(_TITLES)
_KEYWORDS = ("password", "passwd", "token", "secret", "apikey", "api_key")
_TELEPHONES = ("tel", "telephone", "phone", "mobile", "fax")
_ASSIGNED = rf"(?:{'|'.join(_KEYWORDS)})[\"']?\s*(?:=>|:=|=+|:)\s*"
#: A word of a name, and the next one of the same name with what may stand between.
_MARKS = "".join(re.escape(c) for c in map(chr, range(0x300, 0xFFFF)) if unicodedata.category(c)[0] == "M")
_WORD = rf"(?:[^\W\d_]++[{_MARKS}]*+)++"
_WORDS = re.compile(_WORD)
_NEXT = re.compile(rf"(?:[ '’-]|(?<=\b[^\W\d_])\. ?)(?P<e>{_WORD})")
_PARTICLES = frozenset("van von der den de del della di da dos du la le bin ibn al ter ten zu zur".split())
_INTRODUCTIONS = ("name is", "full name:", "signed by", "sincerely,")
_STREETS = ("Street", "Avenue", "Road", "Lane", "Drive", "Boulevard", "Square", "Court")
#: Needs that are looked for in lower case.
_ANY_CASE = (_KEYWORDS, _TELEPHONES, _INTRODUCTIONS)
_DATE = r"\d{1,2}(?P<d>[ ./-])\d{1,2}(?P=d)\d{4}(?!\d)|\d{4}-\d{2}-\d{2}(?!\d)"
#: (kind, one of these occurs in the text, for keywords in any case, pattern); the entity is the group named e. All but secrets, names and e-mail addresses need a digit.
PATTERNS = tuple(
    (kind, needs, re.compile(pattern))
    for kind, needs, pattern in (
        ("email", ("@",), r"(?<![A-Za-z0-9._%+-])(?P<e>[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,24})"),
        ("secret", _KEYWORDS, rf"(?i:{_ASSIGNED})(?P<q>[\"'`])(?P<e>(?:\\.|(?!(?P=q))[^\\\n])+)(?P=q)"),
        ("secret", _KEYWORDS, rf"(?i:{_ASSIGNED})[\"'`]?(?P<e>(?:(?![&,;][\w.-]+\s*[=:])[^\s\"'`<>])+)"),
        ("key", ("AKIA",), r"\b(?P<e>AKIA[A-Z0-9]{16})\b"),
        ("ip", (".",), rf"(?<![\d.])(?P<e>(?:{_OCTET}\.){{3}}{_OCTET})(?!\.?\d)"),
        ("ssn", ("-",), r"(?<![\w.+-])(?P<e>(?!000|666|9)\d{3}-(?!00)\d{2}-(?!0000)\d{4})(?![\w-]|\.\d)"),
        ("phone", ("+",), r"(?<![\w+])(?P<e>\+\d{1,3}(?:[ .-]?\(\d{2,4}\))?(?:[ .-]?\d{2,5}){2,4})(?![\w-])"),
        ("phone", ("(",), r"(?P<e>(?:(?<![\w+.-])1[ .-]?)?\((?!(?:19|20)\d\d\))\d{2,5}\)(?:[ ./-]?\d{2,5}){2,4})(?![\w-])"),
        ("phone", ("",), r"(?<![\w+.,/-])(?P<e>(?:1[ .-])?[2-9]\d\d(?P<s>[ .-])[2-9]\d\d(?P=s)\d{4})(?![\w-]|\.\d)"),
        ("phone", ("0",), rf"(?<![\w+.,/-])(?!{_DATE})(?P<e>0[1-9]\d{{7,9}}|0[1-9]\d{{0,3}}[ ./-]\d{{2,8}}(?:[ .-]\d{{2,5}}){{0,4}})(?![\w-]|\.\d)"),
        ("phone", _TELEPHONES, rf"(?i:\b(?P<tel>{'|'.join(_TELEPHONES)})\b)\.?[ :]{{0,3}}(?!{_DATE})(?P<e>\(?\d(?:[ ()./-]{{0,2}}\d){{6,14}})(?![\w-]|\.\d)"),
        ("card", ("",), r"(?<![\w.+-])(?P<e>\d{4}(?P<s>[ -]?)\d{4}(?P=s)\d{4}(?P=s)\d{1,7})(?![\w-]|\.\d)"),
        ("iban", ("",), r"(?<!\w)(?P<e>[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)(?!\w)"),
        ("ipv6", (":",), r"(?<![\w:.])(?P<e>(?=[0-9A-Fa-f]*:[0-9A-Fa-f]*:)[0-9A-Fa-f:]{5,39})(?![\w:])"),
        ("street", _STREETS, rf"(?<![\w.,-])(?P<e>[1-9]\d{{0,4}} (?:[A-Z][a-z]+ ){{1,3}}(?:{'|'.join(_STREETS)}))(?!\w)"),
        ("name", _TITLES, rf"\b(?P<t>{_TITLE})(?:\.|(?<=Miss|Herr|Frau|г-жа)|(?<=Mme)|(?<=г-н)|(?<=Madame|Señora)|(?<=Señor)|(?<=Monsieur)|(?<=Κα)|(?<=Κος)) (?P<e>{_WORD})"),
        ("name", _INTRODUCTIONS, rf"(?i:\b(?:my name is|full name:|signed by|sincerely,))\s(?P<e>{_WORD})"),
    )
)
_DIGIT = re.compile("[0-9]")
#: Area code and exchange of a national number of 3-3-4 digits.
_NATIONAL = re.compile(r"(?:1[ .-]?)?\(?(?P<a>[2-9])\d\d\)?[ ./-]?(?P<b>[2-9])\d\d[ ./-]?\d{4}")


def luhn(digits: str) -> int:
    """Checksum of a card number; 0 if valid."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10


def _mod97(iban: str) -> int:
    """Remainder of an IBAN, country and check digits moved to its end; 1 if valid."""
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def _is_ipv6(text: str) -> bool:
    """A whole address, or one cut short that has three groups or more."""
    try:
        ipaddress.IPv6Address(text)
    except ValueError:
        return False
    return sum(map(bool, text.split(":"))) > 2


def _named_alike(word: str) -> str:
    """Gender for which a given name is known, ``n`` if none."""
    return next((g for g, lists in GIVEN.items() if any(word.lower() in names for names in lists)), "n")


def _name_words(m: re.Match):
    """(start, word) of the name whose first word is ``m["e"]``: up to a title or a word in lower or upper case that is no particle between others.

    In scripts without case, where no capital tells the end, a name has two words at most.
    """
    particles, first, caseless = 0, True, 0
    while m:
        w = m["e"]
        caseless += w[0].title() == w[0] == w[0].lower()
        if w[0].title() == w[0] and (len(w) == 1 or not w.isupper()) and caseless < 3 and w not in _TITLES:
            yield m.start("e"), w
            particles, first = 0, False
        elif first or w not in _PARTICLES or particles == 3:
            return
        else:
            particles += 1
        m = _NEXT.match(m.string, m.end("e"))


def mentions(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, entity) without overlaps, in order; names word by word, kind ``name m``, ``name f`` or, introduced without a title and unknown, ``name n``."""
    found, named = [], {}
    digits = _DIGIT.search(text) is not None
    low = text.lower()
    for kind, needs, pattern in PATTERNS:
        if not (digits or kind in ("name", "email", "secret")) or not any(x in (low if needs in _ANY_CASE else text) for x in needs):
            continue
        for m in pattern.finditer(text):
            e = m["e"]
            if kind == "card" and luhn(re.sub(r"\D", "", e)):
                continue
            if kind == "iban" and _mod97(e.replace(" ", "")) != 1 or kind == "ipv6" and not _is_ipv6(e):
                continue
            if kind == "phone" and len(re.sub(r"\D", "", e)) < (7 if "tel" in pattern.groupindex else 9 if e[0] == "0" else 8):
                continue
            if kind == "secret":
                e = e if "q" in pattern.groupindex else e.rstrip(".,;:)]}")
                if not any(c.isalnum() for c in e):
                    continue
            if kind == "name":
                titled = "t" in pattern.groupindex
                gender = ("m" if m["t"] in TITLES["m"] else "f") if titled else _named_alike(m["e"])
                for at, w in _name_words(m):
                    if not titled and w in named:
                        continue  # another mention of a titled name
                    found.append((at, at + len(w), f"name {gender}", w))
                    if len(w) > 1:
                        named.setdefault(w, {})[at] = f"name {gender}"
            else:
                found.append((m.start("e"), m.start("e") + len(e), kind, e))
    if named:
        last = {w: next(iter(at.values())) for w, at in named.items()}  # the kind of a mention without title is that of the title before it
        for w in _WORDS.finditer(text):
            if w[0] in last:
                last[w[0]] = named[w[0]].get(w.start(), last[w[0]])
                found.append((w.start(), w.end(), last[w[0]], w[0]))
    out, end = [], 0
    for x in sorted(found, key=lambda x: (x[0], -x[1])):
        if x[0] >= end:
            out.append(x)
            end = x[1]
    return out


def permuted(x: int, size: int, key: bytes, tweak: str) -> int:
    """A keyed permutation of range(size): Feistel rounds, walking on until inside the range."""
    half = (max(size - 1, 1).bit_length() + 1) // 2
    low = (1 << half) - 1
    while True:
        left, right = x >> half, x & low
        for r in range(6):
            h = hmac.new(key, f"{tweak}|{size}|{r}|{right}".encode(), hashlib.sha256).digest()
            left, right = right, left ^ (int.from_bytes(h, "big") & low)
        x = left << half | right
        if x < size:
            return x


@cache
def _class(c: str) -> tuple[str, str]:
    """Kind (letter, mark, number) and script of a character."""
    return unicodedata.category(c)[0], unicodedata.name(c, "").split(" ")[0]


@cache
def _alphabet(page: int, kind: str, script: str) -> str:
    """The characters of a class among 256, capitals left out."""
    return "".join(c for c in map(chr, range(page << 8, (page + 1) << 8)) if _class(c) == (kind, script) and c.lower() == c)


def _format_preserving(text: str, keep: set[int], key: bytes, tweak: str, hexadecimal: bool = False, every: bool = False) -> str:
    """``text`` with the characters outside ``keep`` permuted within their classes, case kept; with ``every`` those of all scripts."""
    alphabets = {}
    for i, c in enumerate(text):
        for letters in (HEX,) if hexadecimal else (DIGITS, *SCRIPTS):
            if i not in keep and c.lower() in letters and len(c.lower()) == 1:
                alphabets[i] = letters
        if every and i not in keep and i not in alphabets and len(c.lower()) == 1 and _class(c)[0] in "LMN":
            letters = _alphabet(ord(c.lower()) >> 8, *_class(c.lower()))
            if c.lower() in letters:
                alphabets[i] = letters
    rank, size = 0, 1
    for i, letters in alphabets.items():
        rank, size = rank * len(letters) + letters.index(text[i].lower()), size * len(letters)
    if size == 1:
        return text
    shape = "".join("." if i not in alphabets else str(len(alphabets[i])) + "," for i in range(len(text)))
    rank = permuted(rank, size, key, f"{tweak}|{shape}|{''.join(c for i, c in enumerate(text) if i not in alphabets)}")
    out = list(text)
    for i in reversed(alphabets):
        rank, c = divmod(rank, len(alphabets[i]))
        c = alphabets[i][c]
        out[i] = c.upper() if text[i].isupper() and len(c.upper()) == 1 else c
    return "".join(out)


def surrogate(kind: str, entity: str, attempt: int, key: bytes) -> str:
    """The attempt-th surrogate of an entity."""
    longer, attempt = divmod(attempt, ATTEMPTS)
    tweak = f"{kind}|{attempt}|{longer}"
    if kind == "email":
        local, _, domain = entity.partition("@")
        local = _format_preserving(local, set(), key, f"{tweak}|{domain.lower()}") + "x" * longer
        host, dot, last = domain.rpartition(".")
        return f"{local}@{_format_preserving(host, set(), key, f'domain|{last.lower()}')}{dot}{last}"
    if kind == "iban":
        out = _format_preserving(f"{entity[:2]}00{entity[4:]}{'0' * longer}", set(range(4)), key, tweak)
        return f"{out[:2]}{98 - _mod97((out).replace(' ', '')):02d}{out[4:]}"
    if kind == "ipv6":
        whole = ipaddress.IPv6Address(entity).exploded if longer else entity
        return _format_preserving(whole, set(), key, tweak, True)
    if kind == "ssn":
        area, group, serial = map(int, entity.split("-"))
        rank = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
        rank, serial = divmod(permuted(rank, 898 * 99 * 9999, key, tweak), 9999)
        area, group = divmod(rank, 99)
        return f"{area + 1 + (area >= 665):03d}-{group + 1:02d}-{serial + 1:04d}" + "0" * longer
    if kind == "street":
        return "1" * longer + _format_preserving(entity, {0, *range(entity.rindex(" "), len(entity))}, key, tweak)
    if kind == "ip":
        n = 0
        for part in entity.split("."):
            n = n * 256 + int(part)
        n = permuted(n, 1 << 32, key, tweak)
        return ".".join(str(n >> s & 255) for s in (24, 16, 8, 0))
    if kind == "phone":
        if entity[0] == "+":
            code = re.match(r"\+\d+", entity).end() if re.match(r"\+\d{1,3}[^\d]", entity) else 2
            keep = set(range(code))
        elif m := _NATIONAL.fullmatch(entity):
            keep = {*range(m.end("a")), m.start("b")}
        else:
            keep = {i for i, c in enumerate(entity) if c == "0" and not entity[:i].strip("(")}
        if m := re.search(r"\b555(?=[ .-]?\d{4}$)", entity):
            keep |= set(range(*m.span()))
        return _format_preserving(entity, keep, key, tweak) + "0" * longer
    if kind == "card":
        at = [i for i, c in enumerate(entity) if c.isdigit()]
        out = list(_format_preserving(entity, {at[0], at[-1]}, key, tweak))
        out[at[-1]] = "0"
        out[at[-1]] = str((10 - luhn("".join(c for c in out if c.isdigit()))) % 10)
        return "".join(out)
    if kind == "key":
        return _format_preserving(entity, set(range(4)), key, tweak) + "A" * longer
    if kind == "secret":
        plain = set(entity) <= set(HEX)
        return _format_preserving(entity, set(), key, tweak, plain, True) + "0" * longer
    word, gender = entity.lower(), kind[-1]
    for names in GIVEN.get(gender, ()):
        if word in names and not longer:
            return names[permuted(names.index(word), len(names), key, tweak)].title()
    ending = len(entity) > 3 and _class(entity[-1])[1] in ("LATIN", "CYRILLIC", "GREEK")
    return _format_preserving(entity, {len(entity) - 1} if ending else set(), key, tweak, every=True) + entity[-1] * longer


def _identity(kind: str, entity: str) -> str:
    """What is the same for all spellings of an entity."""
    return entity.lower() if kind in ("email", "ipv6") or kind.startswith("name") else entity


def _detect(batches):
    for batch in batches:
        found = set()
        for text in batch.column(0).to_pylist():
            if text:
                found.update((k[:4] if k.startswith("name") else k, k, _identity(k, e)) for _, _, k, e in mentions(text))
        if found:
            cols = list(zip(*sorted(found), strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in cols], ["family", "kind", "entity"])


def _assign(key: bytes):
    def run(batches):
        for batch in batches:
            family, kind, entity, attempt = (c.to_pylist() for c in batch.columns)
            out = [_identity(k, surrogate(k, e, a, key)) for k, e, a in zip(kind, entity, attempt, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], ["family", "kind", "entity", "attempt", "surrogate"])

    return run


def assign(docs: DataFrame, key: bytes) -> DataFrame:
    """(family, kind, entity, attempt, surrogate) of all entities: surrogates are distinct and no entity of the corpus.

    A surrogate of an entity's kind is compared with those of its family, so a
    man's and a woman's name words differ too.
    """
    schema = "family string, kind string, entity string, attempt int, surrogate string"
    names = [x.split()[0] for x in schema.split(", ")]
    entities = store(
        docs.select("text").mapInArrow(_detect, "family string, kind string, entity string").distinct(), "entities"
    )
    taken = entities.select("family", "kind", "entity", F.lit(-1).alias("attempt"), F.col("entity").alias("surrogate"))
    first = Window.partitionBy("family", "surrogate").orderBy("held", "kind", "entity")
    todo, done, attempt = entities, None, 0
    while not todo.isEmpty():
        tried = todo.select("family", "kind", "entity", F.lit(attempt).alias("attempt")).mapInArrow(_assign(key), schema)
        both = taken.withColumn("held", F.lit(0)).unionByName(tried.withColumn("held", F.lit(1)))
        both = both.withColumn("free", F.row_number().over(first) == 1).where("held = 1")
        both = store(both.select(*names, "free"), "tried")
        free = both.where("free").select(*names)
        done = free if done is None else done.unionByName(free)
        todo = both.where("not free").select("family", "kind", "entity")
        taken = taken.unionByName(free)
        attempt += 1
    return done if done is not None else docs.sparkSession.createDataFrame([], schema)


def _affected(batches):
    for batch in batches:
        rows, kinds, entities = [], [], []
        for i, text in enumerate(batch.column(2).to_pylist()):
            for k, e in sorted({(k, _identity(k, e)) for _, _, k, e in mentions(text or "")}):
                rows.append(i)
                kinds.append(k)
                entities.append(e)
        if rows:
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(c.take(at) for c in batch.columns[:2]), pa.array(kinds, pa.string()), pa.array(entities, pa.string())],
                ["fix_id", "fix_text", "kind", "entity"],
            )


def _rewrite(key: bytes):
    def run(batches):
        for batch in batches:
            texts, counts, kinds = [], [], []
            fixes = batch.column(2).to_pylist() if batch.num_columns > 2 else [None] * batch.num_rows
            for text, fix in zip(batch.column(1).to_pylist(), fixes, strict=True):
                found = mentions(text) if text else []
                attempts = {(f["kind"], f["entity"]): f["attempt"] for f in fix or ()}
                parts, end = [], 0
                for start, stop, kind, entity in found:
                    parts += [text[end:start], surrogate(kind, entity, attempts.get((kind, _identity(kind, entity)), 0), key)]
                    end = stop
                texts.append("".join([*parts, text[end:]]) if found else text)
                counts.append(len(found))
                kinds.append([k.split()[0] for _, _, k, _ in found])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string()), pa.array(counts, pa.int64()), pa.array(kinds, pa.list_(pa.string()))],
                ["doc_id", "text", "n_entities", "kinds"],
            )

    return run


def pseudonymize(docs: DataFrame, key: bytes) -> DataFrame:
    """(doc_id, text, n_entities, kinds): every document with its entities replaced."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text")
    later = store(assign(docs, key).where("attempt > 0").select("kind", "entity", "attempt"), "later")
    if not later.isEmpty():
        which = rows.select("doc_id", F.xxhash64("text").alias("h"), "text").mapInArrow(
            _affected, f"fix_id {kind}, fix_text long, kind string, entity string"
        )
        fixes = which.join(later, ["kind", "entity"]).groupBy("fix_id", "fix_text").agg(
            F.collect_set(F.struct("kind", "entity", "attempt")).alias("fix")
        )  # at most the entities of one document
        fixes = store(fixes, "fixes")
        same = F.col("doc_id").eqNullSafe(F.col("fix_id")) & (F.xxhash64("text") == F.col("fix_text"))
        rows = rows.join(fixes, same, "left").select("doc_id", "text", "fix")
    return rows.mapInArrow(_rewrite(key), f"doc_id {kind}, text string, n_entities long, kinds array<string>")
