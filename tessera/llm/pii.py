"""PII surrogates: detected entities receive keyed, type-consistent replacements.

Kinds: email, phone (international, American, French, German and Spanish national forms), card or account number, IPv4, IPv6
(full or compressed), MAC, SSN, IBAN, secret token, and names after a title or a label with all their other mentions in the same
document. A surrogate is a keyed permutation of the entity within its own format (a Feistel network over the mixed radix of its signs, so
digits stay digits, hexadecimal stays hexadecimal, letters keep script, case and, in names, vowel or consonant); given names
of the known lists go to names of the same gender and script, wherever in a name they stand. x -> P^-1(P(x) + 1) moves every value of a format with more than
one, and two entities of a format never meet. Luhn remainders, IBAN check digits, phone country codes and top-level domains
stay valid. The same entity, however written (case, separators), has the same surrogate in every document.

Collision checks: the distinct entities of the corpus are gathered (pre-aggregated), and a surrogate that is a real entity of
its kind (listed given names and all other names are one), or another's surrogate, is drawn anew with the next attempt number. From attempt LEAVE on a listed given name leaves its list for
made-up names of its gender's ending and script; from attempt WIDER on names and mail addresses grow by letters, more with every
attempt, so that a format which the corpus fills is left too. Numbers can't grow: if one is not settled after ATTEMPTS, all entities
of its format take the plain permutation, which keeps them distinct and moved though some surrogates are real there. The exceptions
travel with the tasks while they are at most EXCEPTIONS; beyond that they are joined to the texts.

The key is an argument, or the session's setting spark.tessera.pii.key; with neither, a published key serves, with a warning.

Defined cases: null text stays null with 0 entities; empty text stays empty; where spans overlap the first and longest wins;
repeated rows give repeated results; all other columns pass through unchanged.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
import warnings
from collections.abc import Iterator
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, materialize

KEY_SETTING, PUBLISHED_KEY = "spark.tessera.pii.key", b"replace this key in production"
EXCEPTIONS = 100_000
ATTEMPTS, LEAVE, WIDER = 32, 8, 16
ROUNDS = 6
#: Signs that are permuted together.
CHUNK = 256

# Letters by script, vowels first where names need them.
VOWELS, CONSONANTS = "aeiouy", "bcdfghjklmnpqrstvwxz"
ACCENTED_VOWELS, ACCENTED_CONSONANTS = "àáâãäåæèéêëìíîïòóôõöøùúûüý", "çñß"
CYRILLIC_VOWELS, CYRILLIC_CONSONANTS = "аеиоуыэюя", "бвгджзйклмнпрстфхцчшщъь"
GREEK_VOWELS, GREEK_CONSONANTS = "αεηιουω", "βγδζθκλμνξπρστφχψ"
#: First and last letter of runs without case.
RANGES = (("א", "ת"), ("ا", "غ"), ("ف", "ي"), ("अ", "ह"), ("ぁ", "ゖ"), ("ァ", "ヶ"), ("一", "鿋"), ("가", "힣"))
TITLES = {
    "m": "Mr Mister Sir Lord Herr Herrn Monsieur Señor Sr Don Signor Господин господин Κύριος".split(),
    "f": "Mrs Ms Miss Madam Lady Frau Madame Mme Mlle Señora Sra Doña Signora Госпожа госпожа Κυρία".split(),
    "": "Dr Prof Doctor Professor".split(),
}
GIVEN = {
    "m": ["james john robert michael william david thomas charles peter paul hans karl jean pierre luis carlos juan pedro marco antonio".split(), "иван пётр сергей андрей николай дмитрий".split(), "γιώργος νίκος πέτρος κώστας".split()],
    "f": ["mary anna linda susan sarah karen emma julia laura maria marie claire sophie greta heidi carmen lucia elena rosa paula".split(), "анна мария ольга елена наталья ирина".split(), "ελένη σοφία κατερίνα άννα".split()],
}
#: Ends of made-up given names, in the order of the lists.
ENDINGS = {"m": ("o", "н", "ος"), "f": ("a", "а", "α")}
HEX = "0123456789abcdef"

NAME = r"[^\W\d_]*(?:[^\W\d_a-zß-öø-ÿа-яα-ω])[^\W\d_]*(?:[-'’][^\W\d_]+)*"
GROUP, QUAD = "[0-9A-Fa-f]{1,4}", r"(?:\d{1,3}\.){3}\d{1,3}"
FRENCH = r"0[1-9](?:[ .\u00a0-]?\d{2}){4}"
GERMAN = r"(?:\(0\d{2,4}\)[ \u00a0]?|0\d{2,4}(?: ?[/-] ?|[ \u00a0]))\d{3,4}(?:[ -]?\d{2,5}){1,2}|01[5-7]\d{8,9}"
SPANISH = r"[6-9]\d{2}([ \u00a0-])(?:\d{3}\1\d{3}|\d{2}\1\d{2}\1\d{2})"
PATTERNS = [
    ("email", re.compile(r"(?<![\w.+%-])[\w.+%-]+@[\w-]+(?:\.[\w-]+)+"), "@"),
    ("secret", re.compile(r"(?<!\w)(?:[0-9a-f]{32,}|[0-9A-F]{32,})(?!\w)|(?<!\w)(?:AKIA|ghp_|gho_|sk-|xox[abp]-)[A-Za-z0-9-]{16,}"), None),
    ("iban", re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)"), None),
    ("ipv6", re.compile(rf"(?<![\w:.])(?:(?:{GROUP}:){{7}}{GROUP}|(?:{GROUP}:){{6}}{QUAD}|(?:{GROUP}(?::{GROUP}){{0,6}})?::(?:(?:{GROUP}:){{0,5}}{QUAD}|{GROUP}(?::{GROUP}){{0,6}})?)(?![\w:]|\.\d)"), ":"),
    ("mac", re.compile(r"(?<![\w:-])(?:[0-9A-Fa-f]{2}[:-]){5}[0-9A-Fa-f]{2}(?![\w:-])"), None),
    ("ip", re.compile(r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\.?\w)"), "."),
    ("ssn", re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"), "-"),
    ("phone", re.compile(r"(?<![\w])\+?\d{1,3}[^\w+]{1,5}\(?\d{3}\)?[^\w+]{1,5}\d{3}[-. ]\d{4}(?!\w)|(?<![\w(])\(?\d{3}\)?[-. ]{1,2}\d{3}[-. ]\d{4}(?!\w)|(?<!\w)\+\d{1,3}(?:[-. ]?\d){8,12}(?!\w)"), None),
    ("phone", re.compile(rf"(?<![\w+])(?<![\d.,/-][ .,/-])(?<![.,/-])(?:{FRENCH}|{GERMAN}|{SPANISH})(?![ .,/-]?\d|\w)"), None),
    ("card", re.compile(r"(?<![\w])\d(?:[ -]?\d){12,18}(?!\w)"), None),
]
TITLE = re.compile(rf"(?<!\w)({'|'.join(t for ts in TITLES.values() for t in ts)})\b\.?[ \u00a0]((?:{NAME}[ \u00a0]){{0,2}}{NAME})")
TITLE_WORDS = tuple(t for ts in TITLES.values() for t in ts)
LABEL = re.compile(rf"(?i:\b(?:full name|name|nombre|nom)\s?:\s?)((?:{NAME} ){{0,2}}{NAME})")


def luhn(digits: str) -> int:
    """The check digit that completes the digits."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 - i % 2)
        total += d - 9 if d > 9 else d
    return -total % 10


def iban_check(country: str, bban: str) -> str:
    return f"{98 - int(''.join(str(int(c, 36)) for c in bban + country + '00')) % 97:02d}"


def letters_of(c: str, kind: str) -> str:
    """The signs that may stand for a lower-case sign in this kind of entity; itself only if it stays."""
    named = kind.startswith("name")
    at = c, kind == "hex", named
    if at not in LETTERS:
        LETTERS[at] = found_letters(c, kind == "hex", named)
    return LETTERS[at]


class Cache(dict):
    """Travels empty."""

    def __reduce__(self):
        return Cache, ()


#: At most three entries a sign.
LETTERS = Cache()


def found_letters(c: str, hexed: bool, named: bool) -> str:
    if hexed:
        return HEX if c in HEX else c
    if "0" <= c <= "9":
        return "0123456789"
    for vowels, consonants in ((VOWELS, CONSONANTS), (ACCENTED_VOWELS, ACCENTED_CONSONANTS), (CYRILLIC_VOWELS, CYRILLIC_CONSONANTS), (GREEK_VOWELS, GREEK_CONSONANTS)):
        if c in vowels:
            return vowels if named else vowels + consonants
        if c in consonants:
            return consonants if named else vowels + consonants
    for a, b in RANGES:
        if a <= c <= b:
            return "".join(map(chr, range(ord(a), ord(b) + 1)))
    return c


def wider(text: str, by: int) -> str:
    """text and by more letters of its script, vowels and consonants in turn."""
    for _ in range(by):
        c = text[-1]
        pairs = ((VOWELS, CONSONANTS), (CYRILLIC_VOWELS, CYRILLIC_CONSONANTS), (GREEK_VOWELS, GREEK_CONSONANTS))
        sets = next((p for p in pairs if c in p[0] + p[1]), None)
        if sets:
            text += sets[c in sets[0]][0]
        else:
            text += c if len(letters_of(c, "name")) > len(ACCENTED_VOWELS) else "a"
    return text


def format_of(kind: str, norm: str) -> str:
    """Entities of a kind with different formats never meet, whatever the attempt."""
    hexed = kind in ("secret", "ipv6", "mac") and all(c in HEX + ":-" for c in norm)
    return kind if kind == "ip" else "".join(letters_of(c, "hex" if hexed else kind)[0] for c in lower(norm))


class Surrogates:
    """The keyed replacement of normal forms."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()
        self.cache: dict[tuple[str, str, int], str] = {}

    def draw(self, tweak: str, round_: int, x: int, below: int) -> int:
        wide = (below.bit_length() + 7) // 8 + 8
        out = b""
        while len(out) < wide:
            out += hashlib.blake2b(f"{tweak}|{round_}|{x:x}|{len(out)}".encode("utf-8", "replace"), key=self.key, digest_size=64).digest()
        return int.from_bytes(out[:wide], "big") % below

    def permute(self, tweak: str, x: int, n: int) -> int:
        """x -> P^-1(P(x) + 1 mod n), P a keyed permutation of range(n): a permutation that moves every value if n > 1."""
        if n < 2:
            return x
        a = isqrt(n - 1) + 1
        b = -(-n // a)

        def forth(v: int) -> int:
            while True:
                left, right = divmod(v, b)
                for r in range(ROUNDS):
                    if r % 2:
                        right = (right + self.draw(tweak, r, left, b)) % b
                    else:
                        left = (left + self.draw(tweak, r, right, a)) % a
                v = left * b + right
                if v < n:
                    return v

        def back(v: int) -> int:
            while True:
                left, right = divmod(v, b)
                for r in reversed(range(ROUNDS)):
                    if r % 2:
                        right = (right - self.draw(tweak, r, left, b)) % b
                    else:
                        left = (left - self.draw(tweak, r, right, a)) % a
                v = left * b + right
                if v < n:
                    return v

        return back((forth(x) + 1) % n)

    def spell(self, text: str, kind: str, attempt: int) -> str:
        """text with each sign moved within its letters, all signs together as one number; a long text in parts of CHUNK signs, each
        moved by the form of all."""
        if len(text) > CHUNK:
            form = hashlib.blake2b("".join(letters_of(c, kind)[0] for c in text).encode("utf-8", "replace")).hexdigest()
            return "".join(self.spell_part(text[at : at + CHUNK], kind, f"{attempt}|{form}|{at}") for at in range(0, len(text), CHUNK))
        return self.spell_part(text, kind, str(attempt))

    def spell_part(self, text: str, kind: str, attempt: str) -> str:
        sets = [letters_of(c, kind) for c in text]
        x, n = 0, 1
        for c, s in zip(text, sets, strict=True):
            x, n = x * len(s) + s.index(c), n * len(s)
        form = "".join(s[0] if len(s) > 1 else c for c, s in zip(text, sets, strict=True))
        y = self.permute(f"{kind}|{attempt}|{form}", x, n)
        out = []
        for s in reversed(sets):
            y, i = divmod(y, len(s))
            out.append(s[i])
        return "".join(reversed(out))

    def of(self, kind: str, norm: str, attempt: int = 0) -> str:
        at = (kind, norm, attempt)
        if at not in self.cache:
            if len(self.cache) > 100_000:
                self.cache.clear()
            self.cache[at] = self._of(kind, norm, attempt)
        return self.cache[at]

    def _of(self, kind: str, norm: str, attempt: int) -> str:
        if kind == "email":
            local, domain = norm.split("@", 1)
            host, _, top = domain.rpartition(".")
            local = wider(local, max(0, attempt - WIDER + 1))
            return f"{self.spell(local, 'local', attempt)}@{self.spell(host, 'host', 0)}.{top}"
        if kind == "ip":
            x = 0
            for part in norm.split("."):
                x = x * 256 + int(part)
            y = self.permute(f"ip|{attempt}", x, 1 << 32)
            return ".".join(str(y >> s & 255) for s in (24, 16, 8, 0))
        if kind == "card":
            body = self.spell(norm[:-1], "card", attempt)
            return body + str((luhn(body) + int(norm[-1]) - luhn(norm[:-1])) % 10)
        if kind == "iban":
            body = self.spell(norm[4:].lower(), "iban", attempt).upper()
            return norm[:2] + iban_check(norm[:2], body) + body
        if kind in ("secret", "ipv6", "mac") and all(c in HEX + ":-" for c in norm):
            return self.spell(norm, "hex", attempt)
        if kind in ("name.m", "name.f"):
            for names, ending in zip(GIVEN[kind[-1]], ENDINGS[kind[-1]], strict=True):
                if norm in names and attempt < LEAVE:
                    return names[self.permute(f"{kind}|{attempt}", names.index(norm), len(names))]
                if norm in names:
                    return self.spell(wider(norm, max(0, attempt - WIDER + 1)), kind, attempt) + ending
        if kind.startswith("name"):
            norm = wider(norm, max(0, attempt - WIDER + 1))
        return self.spell(norm, kind, attempt)


def lower(text: str) -> str:
    return "".join(low if len(low := c.lower()) == 1 else c for c in text)


def normal(kind: str, found: str) -> str:
    """What the ways to write one entity share."""
    if kind == "phone":
        digits = "".join(c for c in found if c.isdigit())
        national = (len(digits) == 11 and found.startswith("+") and digits[:2] in ("33", "34")) or re.fullmatch(FRENCH, found)
        return digits[-9:] if national else digits[-10:]
    if kind == "card":
        return "".join(c for c in found if c.isdigit())
    if kind == "ip":
        return ".".join(str(int(p)) for p in found.split("."))
    if kind == "iban":
        return found.replace(" ", "")
    if kind == "ipv6":
        return ipaddress.IPv6Address(found).exploded
    if kind == "mac":
        return lower(found).replace("-", ":")
    return lower(found)


def render(kind: str, found: str, surrogate: str) -> str:
    """The surrogate written as found was: its separators, country code and case."""
    if kind == "ip":
        return surrogate
    if kind == "ipv6":  # in full, as a compressed form only holds zeros
        return surrogate if any(map(str.islower, found)) or not any(map(str.isupper, found)) else surrogate.upper()
    if kind in ("phone", "card", "iban"):
        keep = [i for i, c in enumerate(found) if c.isalnum()][-len(surrogate) :]
    elif kind == "mac":
        keep, surrogate = [i for i, c in enumerate(found) if c not in ":-"], surrogate.replace(":", "")
    else:
        keep = list(range(len(found)))
        if len(surrogate) != len(found):  # a listed given name, or one that has grown
            return surrogate.upper() if found.isupper() and len(found) > 1 else surrogate.capitalize() if found[0].isupper() else surrogate
    out = list(found)
    for i, c in zip(keep, surrogate, strict=True):
        up = c.upper()
        out[i] = up if found[i].isupper() and len(up) == 1 else c
    if kind in ("secret", "mac") and not any(map(str.islower, found)):  # letters may stand where digits were
        return "".join(out).upper()
    return "".join(out)


def spans(text: str) -> list[tuple[int, int, str]]:
    """(from, to, kind) of the entities, in order, without overlap."""
    found = []
    if any(c in text for c in "0123456789"):
        for kind, pattern, sign in PATTERNS:
            if sign is None or sign in text:
                for m in pattern.finditer(text):
                    s, e = m.span()
                    if kind == "email":
                        s += len(m[0]) - len(m[0].lstrip(".-%+"))
                    if kind == "iban" and iban_check(m[0][:2], m[0].replace(" ", "")[4:]) != m[0][2:4]:
                        continue
                    if kind == "ipv6" and not is_ipv6(m[0]):
                        continue
                    found.append((s, e, kind))
    elif "@" in text:
        found += [(m.start(), m.end(), "email") for m in PATTERNS[0][1].finditer(text)]
    if any(t in text for t in TITLE_WORDS):
        for m in TITLE.finditer(text):
            found += name_parts(m.start(2), m[2])
    if ":" in text:
        for m in LABEL.finditer(text):
            found += name_parts(m.start(1), m[1])
    found += mentions(text, [x for x in found if x[2].startswith("name")])
    found.sort(key=lambda x: (x[0], -x[1]))
    out, end = [], -1
    for s, e, kind in found:
        if s >= end:
            out.append((s, e, kind))
            end = e
    return out


def is_ipv6(found: str) -> bool:
    try:
        ipaddress.IPv6Address(found)
    except ValueError:
        return False
    return any(c.isdigit() for c in found)


def mentions(text: str, names: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """The words of found names wherever else they stand, capitalised or without case; a single letter only before a found name."""
    if not names:
        return []
    kinds: dict[str, str] = {}
    for s, e, kind in sorted(names):
        kinds.setdefault(lower(text[s:e]), kind)
    words = "|".join(re.escape(w) for w in sorted(kinds, key=lambda w: (-len(w), w)))
    out = []
    at = {(s, e) for s, e, _ in names}
    hits = [m for m in re.finditer(rf"(?<!\w)(?:{words})(?!\w)", text, re.IGNORECASE) if not m[0][0].islower() and lower(m[0]) in kinds]
    for i, m in enumerate(hits):
        if m.span() in at:
            continue
        if len(m[0]) == 1 and not (i + 1 < len(hits) and re.fullmatch(r"\.?[ \u00a0]?", text[m.end() : hits[i + 1].start()])):
            continue
        out.append((*m.span(), kinds[lower(m[0])]))
    return out


def name_parts(at: int, name: str) -> list[tuple[int, int, str]]:
    """The words of a name. The kind follows from the word alone, so that a person has one surrogate whatever the title."""
    return [(m.start() + at, m.end() + at, kind_of_name(lower(m[0]))) for m in re.finditer(r"[^\s\u00a0]+", name)]


def kind_of_name(word: str) -> str:
    return next((f"name.{g}" for g in "mf" if any(word in names for names in GIVEN[g])), "name")


def replace(text: str, surrogates: Surrogates, exceptions: dict[tuple[str, str], int]) -> tuple[str, int]:
    out, end, n = [], 0, 0
    for s, e, kind in spans(text):
        norm = normal(kind, text[s:e])
        out += [text[end:s], render(kind, text[s:e], surrogates.of(kind, norm, exceptions.get((kind, norm), 0)))]
        end, n = e, n + 1
    return "".join([*out, text[end:]]) if n else text, n


def entities(docs: DataFrame) -> DataFrame:
    """Distinct (kind, norm) of all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = sorted({(k, normal(k, t[s:e])) for t in batch["text"].to_pylist() if t for s, e, k in spans(t)})
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.string())], ["kind", "norm"])

    return docs.select("text").mapInArrow(run, "kind string, norm string").distinct()


def session_key(spark: SparkSession) -> bytes:
    set_key = spark.conf.get(KEY_SETTING, None)
    if not set_key:
        warnings.warn(f"{KEY_SETTING} is not set: surrogates are drawn by a published key", stacklevel=2)
    return set_key.encode() if set_key else PUBLISHED_KEY


def collisions(docs: DataFrame, key: bytes) -> DataFrame:
    """Rows (kind, norm, attempt) of the entities whose first surrogate doesn't do, with the attempt that does."""
    all_ = materialize(entities(docs), "entities")
    among = F.substring_index("kind", ".", 1).alias("among")  # the kinds of names share their signs, so they share their checks
    real = all_.select(among, F.col("norm").alias("surrogate"), F.lit(True).alias("real"))

    def drawn(rows: DataFrame) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            s = Surrogates(key)
            for b in batches:
                new = [s.of(k, n, a) for k, n, a in zip(b["kind"].to_pylist(), b["norm"].to_pylist(), b["attempt"].to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(new, pa.string())], [*b.schema.names, "surrogate"])

        return rows.select("kind", "norm", "attempt").mapInArrow(run, "kind string, norm string, attempt int, surrogate string")

    now = materialize(drawn(all_.withColumn("attempt", F.lit(0))), "surrogates")
    can_grow = (F.col("kind") == "email") | F.col("kind").startswith("name")
    attempts = 0
    while True:
        # of equal surrogates the one with the fewest attempts stays: a settled entity never moves again
        now = now.select("*", among)
        first = now.groupBy("among", "surrogate").agg(F.min(F.struct("attempt", "norm")).alias("first"))
        judged = now.join(first, ["among", "surrogate"]).join(real, ["among", "surrogate"], "left")
        # an entity whose format has no other value stays as it is
        alone = (F.col("surrogate") == F.col("norm")) & (F.col("attempt") > 0)
        bad = (F.coalesce("real", F.lit(False)) | (F.col("first.norm") != F.col("norm"))) & ~alone
        judged = materialize(judged.select("kind", "norm", "attempt", "surrogate", bad.alias("bad")), "judged")
        again = judged.where("bad")
        attempts += 1
        if attempts > ATTEMPTS:
            again = again.where(can_grow)  # what can grow has a larger space each time, so this ends
        if again.isEmpty():
            break
        rest = judged.where("not bad" if attempts <= ATTEMPTS else ~(F.col("bad") & can_grow)).drop("bad")
        now = materialize(rest.unionByName(drawn(again.withColumn("attempt", F.col("attempt") + 1))), "surrogates")
    if judged.where("bad").isEmpty():
        return judged.where("attempt > 0").select("kind", "norm", "attempt")
    # a format that is too full: all its entities go by the permutation of attempt 0
    form = F.udf(format_of, "string")("kind", "norm")
    judged = judged.withColumn("form", form)
    full = judged.where("bad").select("kind", "form").distinct()
    return judged.where("attempt > 0").join(full, ["kind", "form"], "left_anti").select("kind", "norm", "attempt")


def surrogate_pii(docs: DataFrame, key: bytes | None = None, count_column: str | None = None) -> DataFrame:
    """docs with entities in text replaced; count_column, if given, is added with the number of replaced spans."""
    key = session_key(docs.sparkSession) if key is None else key
    odd = collisions(docs, key)
    few = odd.limit(EXCEPTIONS + 1).collect()
    travel = {(r.kind, r.norm): r.attempt for r in few} if len(few) <= EXCEPTIONS else None
    out = T.StructType([f for f in docs.schema.fields if f.name != count_column])
    names = out.names
    if count_column:
        out = T.StructType([*out.fields, T.StructField(count_column, T.IntegerType())])
    own_name = fresh(docs, "exceptions")
    if travel is None:
        docs = with_own_exceptions(docs, odd, own_name)
    text_type = docs.schema["text"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Surrogates(key)
        for b in batches:
            own = b[own_name].to_pylist() if travel is None else None
            new, n = [], []
            for i, t in enumerate(b["text"].to_pylist()):
                known = travel if own is None else {(x["kind"], x["norm"]): x["attempt"] for x in own[i] or ()}
                t, k = (None, 0) if t is None else replace(t, s, known)
                new.append(t)
                n.append(k)
            columns = [pa.array(new, b.schema.field("text").type) if c == "text" else b[c] for c in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n, pa.int32())][: len(out)], [*names, count_column][: len(out)])

    assert isinstance(text_type, T.StringType)
    return docs.mapInArrow(run, out)


def with_own_exceptions(docs: DataFrame, odd: DataFrame, name: str) -> DataFrame:
    """docs and, as name, the exceptions among the entities of each text. Equal texts are one, whatever their ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(i, k, n) for i, t in enumerate(b["text"].to_pylist()) if t for k, n in sorted({(k, normal(k, t[s:e])) for s, e, k in spans(t)})]
            at = pa.array([r[0] for r in rows], pa.int64())
            yield pa.RecordBatch.from_arrays([b["of"].take(at), pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.string())], ["of", "kind", "norm"])

    held = docs.select(F.sha2("text", 256).alias("of"), "text").mapInArrow(run, "of string, kind string, norm string").distinct()
    of = fresh(docs, "of")
    held = held.join(odd, ["kind", "norm"]).groupBy(F.col("of").alias(of)).agg(F.collect_list(F.struct("kind", "norm", "attempt")).alias(name))
    return docs.withColumn(of, F.sha2("text", 256)).join(held, of, "left").drop(of)
