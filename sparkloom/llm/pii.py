"""Format-preserving pseudonyms for personal data by keyed Feistel permutations.

A value that its kind's validity rule accepts is mapped to another valid value
of the same kind and written in the same format: separators, letter case and
leading marks stay. The permutation depends on the key, the kind and the size of
the domain only, so equal values get equal pseudonyms in all documents, however
they are written, and different values different ones.

Kinds: email (letters and digits of the local part, each within its alphabet),
card (13 to 19 digits with a valid Luhn digit; a valid one is written), iban (mod
97), ssn (valid area, group and serial), phone (international, whose country code
stays, or North American with separators; a code that may begin an area or an
exchange becomes one that may), ip (four octets, but not after a word like
"version"), date (a day that exists, permuted within its era), secret
(hexadecimal of 32 digits or more) and token (access keys with a known prefix,
which stays). Numbers that fail their kind's rule, such as a 16-digit number with
a wrong check digit, are left alone.

The key comes from the setting ``spark.sparkloom.pii.secret`` or the variable
SPARKLOOM_PII_SECRET. Without either each driver process makes a random one: its
pseudonyms link the documents of its own runs, and nobody can reverse them.

Defined results: null stays null and empty stays empty; texts without personal
data come back unchanged; repeated rows get equal results.
"""

from __future__ import annotations

import hashlib
import hmac
import math
import os
import re
import secrets
import string
from collections.abc import Callable, Iterator
from datetime import date
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm.common import text_batches

ROUNDS = 8
_random: list[bytes] = []


def key_of(spark: SparkSession) -> bytes:
    """The session's key: the setting, the variable, or this process's random key."""
    given = spark.conf.get("spark.sparkloom.pii.secret", None) or os.environ.get("SPARKLOOM_PII_SECRET")
    if given:
        return given.encode()
    if not _random:
        _random.append(secrets.token_bytes(32))
    return _random[0]


class Feistel:
    """A keyed permutation of 0 .. size-1: an alternating Feistel network over
    a * b >= size values, walked until it is back in range."""

    def __init__(self, key: bytes, kind: str, size: int):
        self.size = size
        self.a = math.isqrt(max(0, size - 1)) + 1
        self.b = -(-size // self.a)
        # The prefix keyed once; each round hashes a copy.
        self.base = hmac.new(key, f"{kind}/{size}/".encode(), hashlib.sha256)

    def _round(self, i: int, value: int) -> int:
        h = self.base.copy()
        h.update(b"%d/%d" % (i, value))
        return int.from_bytes(h.digest()[:16], "big")

    def _once(self, x: int) -> int:
        left, right = divmod(x, self.b)
        for i in range(0, ROUNDS, 2):
            left = (left + self._round(i, right)) % self.a
            right = (right + self._round(i + 1, left)) % self.b
        return left * self.b + right

    def _back(self, x: int) -> int:
        left, right = divmod(x, self.b)
        for i in range(ROUNDS - 2, -1, -2):
            right = (right - self._round(i + 1, left)) % self.b
            left = (left - self._round(i, right)) % self.a
        return left * self.b + right

    def encrypt(self, x: int) -> int:
        x = self._once(x)
        while x >= self.size:
            x = self._once(x)
        return x

    def decrypt(self, x: int) -> int:
        x = self._back(x)
        while x >= self.size:
            x = self._back(x)
        return x


def luhn_digit(payload: str) -> int:
    """The check digit that makes payload and digit valid."""
    total = 0
    for i, c in enumerate(reversed(payload)):
        v = int(c) * (2 if i % 2 == 0 else 1)
        total += v - 9 if v > 9 else v
    return -total % 10


def mod97(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text)) % 97


ERAS = tuple((date(a, 1, 1).toordinal(), date(b, 12, 31).toordinal()) for a, b in ((1000, 1899), (1900, 2099), (2100, 9999)))

#: One scan finds what may be a value of some kind; the kind's rule decides.
CANDIDATE = re.compile(
    r"(?<!\w)(?P<email>\w[\w.%+-]{0,127}@(?:[\w-]{1,63}\.){1,8}[^\W\d_]{2,24})"
    r"|(?<![\w-])(?P<token>(?:AKIA|ASIA)[0-9A-Z]{16}|gh[opsru]_[A-Za-z0-9]{36,255}|github_pat_\w{22,255}|xox[abprs]-[\w-]{10,255}|AIza[\w-]{35}|sk-[\w-]{20,255}|[sr]k_(?:live|test)_\w{16,255})(?![\w-])"
    r"|(?<![\w.])(?P<ip>\d{1,3}(?:\.\d{1,3}){3})(?![\w]|\.\d)"
    r"|(?<!\w)(?P<date>\d{4}-\d\d-\d\d|\d\d?[./]\d\d?[./]\d{4})(?![\w]|[./-]\d)"
    r"|(?<![\w-])(?P<ssn>\d{3}-\d\d-\d{4})(?![\w]|-\d)"
    r"|(?P<phone>(?<!\w)\+\d(?:[ .()-]{0,2}\d){7,14}(?!\d)|(?<!\w)\(?\d{3}\)?[ .-]\d{3}[ .-]\d{4}(?![\w]|-\d))"
    r"|(?<!\w)(?P<iban>[A-Z]{2}\d\d(?: ?[A-Z0-9]){11,30})(?!\w)"
    r"|(?<![\w.])(?P<secret>(?=[0-9A-Fa-f]*\d)(?:[0-9a-f]{32,128}|[0-9A-F]{32,128}))(?!\w)"
    r"|(?<![\w-])(?P<card>\d{13,19}|\d{4}(?:[ -]\d{4}){3}(?:[ -]\d{1,3})?|\d{4}[ -]\d{6}[ -]\d{4,5})(?!\w|-\d)"
)
#: Texts without any of these hold no candidate.
HINT = re.compile(r"@|\d[ .()/-]{0,2}\d|[0-9A-Fa-f]{32}|AKIA|ASIA|gh[opsru]_|_pat_|xox|AIza|sk-|k_live|k_test")
#: What stands before four numbers that are no address.
RELEASE = re.compile(r"(?:\bv|\bver|version|release|build|firmware|revision)[. :#-]*\Z", re.I)
#: The prefix of a token, which stays.
PREFIX = re.compile(r"AKIA|ASIA|gh[opsru]_|github_pat_|xox[abprs]-|AIza|sk-|[sr]k_(?:live|test)_")

# Country codes of one and two digits; all others have three.
COUNTRIES = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())
#: Letters that are permuted among each other; in upper case alike.
ALPHABETS = (string.ascii_lowercase, "".join(chr(c) for c in range(0xE0, 0xFF) if c != 0xF7), "".join(map(chr, range(0x430, 0x450))), "αβγδεζηθικλμνξοπρστυφχψω")
AMONG = {c: letters for letters in (string.digits, *ALPHABETS) for c in letters}


class Pseudonyms:
    """The pseudonyms of one key."""

    def __init__(self, key: bytes):
        self.key = key
        self.network: Callable[[str, int], Feistel] = lru_cache(4096)(lambda kind, size: Feistel(key, kind, size))

    def digits(self, kind: str, value: str) -> str:
        return str(self.network(kind, 10 ** len(value)).encrypt(int(value))).zfill(len(value))

    def classes(self, kind: str, value: str, alphabets: list[str | None]) -> str:
        """``value`` with each sign permuted within its alphabet, all signs together;
        signs without one stay."""
        n, x = 1, 0
        for c, letters in zip(value, alphabets, strict=True):
            if letters:
                n, x = n * len(letters), x * len(letters) + letters.index(c)
        shape = "".join(letters[0] if letters else c for c, letters in zip(value, alphabets, strict=True))
        x, made = self.network(kind + shape, n).encrypt(x), []
        for c, letters in zip(reversed(value), reversed(alphabets), strict=True):
            if letters:
                x, at = divmod(x, len(letters))
                c = letters[at]
            made.append(c)
        return "".join(reversed(made))

    def email(self, value: str) -> str | None:
        local, domain = value.split("@")
        if len(local) > 64:
            return None
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in local)
        made = self.classes("email", low, [AMONG.get(c) for c in low])
        return "".join(m.upper() if c.isupper() and len(m.upper()) == 1 else m for c, m in zip(local, made, strict=True)) + "@" + domain

    def token(self, value: str) -> str:
        head = PREFIX.match(value)[0]
        body = value[len(head) :]
        kinds = (string.digits, string.ascii_lowercase, string.ascii_uppercase)
        return head + self.classes("token" + head, body, [next((k for k in kinds if c in k), None) for c in body])

    def ip(self, value: str) -> str | None:
        parts = [int(x) for x in value.split(".")]
        if max(parts) > 255:
            return None
        x = self.network("ip", 1 << 32).encrypt(int.from_bytes(bytes(parts), "big"))
        return ".".join(map(str, x.to_bytes(4, "big")))

    def date(self, value: str) -> str | None:
        mark = next(c for c in value if not c.isdigit())
        parts = value.split(mark)
        if len(parts) != 3:
            return None
        iso = mark == "-"
        year, month, day = (int(x) for x in (parts if iso else reversed(parts)))
        # 4/13/2020 has its month first: both orders are read, the written one is kept.
        flip = not iso and month > 12
        try:
            was = date(year, day, month) if flip else date(year, month, day)
        except ValueError:
            return None
        low, high = next(((a, b) for a, b in ERAS if a <= was.toordinal() <= b), (0, 0))
        if not low:
            return None
        new = date.fromordinal(low + self.network(f"date{low}", high - low + 1).encrypt(was.toordinal() - low))
        if iso:
            return new.isoformat()
        first, second = (new.month, new.day) if flip else (new.day, new.month)
        wide = len(parts[0]) == 2 and parts[0][0] == "0" or len(parts[0]) == len(parts[1]) == 2
        return f"{first:02d}{mark}{second:02d}{mark}{new.year:04d}" if wide else f"{first}{mark}{second}{mark}{new.year:04d}"

    def ssn(self, value: str) -> str | None:
        number = value.replace("-", "")
        if not self._ssn(number):
            return None
        while True:
            number = self.digits("ssn", number)
            if self._ssn(number):
                return f"{number[:3]}-{number[3:5]}-{number[5:]}"

    @staticmethod
    def _ssn(number: str) -> bool:
        return number[:3] not in ("000", "666") and number[0] != "9" and number[3:5] != "00" and number[5:] != "0000"

    def phone(self, value: str) -> str | None:
        number = re.sub(r"\D", "", value)
        if not 8 <= len(number) <= 15:
            return None
        kept = ""
        if value[0] == "+":
            kept = next((number[:n] for n in (1, 2) if number[:n] in COUNTRIES), number[:3])
        national = number[len(kept) :]
        # What may begin an area or an exchange becomes what may, what may not what may not.
        area = lambda c: "23456789" if c in "23456789" else "01"
        american = len(national) == 10 and kept in ("", "1")
        alphabets = [string.digits] * len(national)
        if american:
            alphabets[0], alphabets[3] = area(national[0]), area(national[3])
        elif national[:1] != "0":
            alphabets[:1] = ["123456789"]
        else:
            alphabets[:1] = [None]
        services = lambda x: (x[1:3] == "11", x[4:6] == "11") if american else ()
        made = self.classes("phone", national, alphabets)
        while services(made) != services(national):
            made = self.classes("phone", made, alphabets)
        return _fill(value, kept + made)

    def iban(self, value: str) -> str | None:
        bare = value.replace(" ", "")
        if not 15 <= len(bare) <= 34 or mod97(bare[4:] + bare[:4]) != 1:
            return None
        n, x, shape = 1, 0, ""
        for c in bare[4:]:
            size = 10 if c.isdigit() else 26
            n, x, shape = n * size, x * size + (int(c) if size == 10 else ord(c) - 65), shape + ("9" if size == 10 else "A")
        x, made = self.network(f"iban{bare[:2]}{shape}", n).encrypt(x), []
        for c in reversed(shape):
            x, at = divmod(x, 10 if c == "9" else 26)
            made.append(str(at) if c == "9" else chr(65 + at))
        body = "".join(reversed(made))
        return _fill(value, f"{bare[:2]}{98 - mod97(body + bare[:2] + '00'):02d}{body}")

    def secret(self, value: str) -> str:
        number = self.network("secret", 16 ** len(value)).encrypt(int(value, 16))
        out = f"{number:x}".zfill(len(value))
        return out.upper() if value.upper() == value else out

    def card(self, value: str) -> str | None:
        number = re.sub(r"\D", "", value)
        if len(number) < 13:
            return None
        if luhn_digit(number[:-1]) != int(number[-1]):
            return None
        payload = self.digits("card", number[:-1])
        return _fill(value, payload + str(luhn_digit(payload)))

    def spans(self, text: str | None) -> list[tuple[int, int, str, str]]:
        """(start, end, kind, pseudonym) of the personal data of a text."""
        if not text or not HINT.search(text):
            return []
        out, at = [], 0
        while m := CANDIDATE.search(text, at):
            kind = m.lastgroup
            release = kind == "ip" and RELEASE.search(text[max(0, m.start() - 16) : m.start()])
            made = None if release else getattr(self, kind)(m[kind])
            if made is None and kind in ("iban", "card") and " " in m[0]:
                # The greedy match may have run on into the next words.
                cut = m[0].rfind(" ")
                while made is None and cut > 0:
                    short = m[0][:cut]
                    made, cut = getattr(self, kind)(short), short.rfind(" ")
                if made is not None:
                    out.append((m.start(), m.start() + len(made), kind, made))
                    at = m.start() + len(made)
                    continue
            if made is not None:
                out.append((m.start(), m.end(), kind, made))
            at = m.end()
        return out

    def replace(self, text: str | None, spans: list[tuple[int, int, str, str]] | None = None) -> str | None:
        """The text with its pseudonyms; ``spans`` where they are known."""
        spans = self.spans(text) if spans is None else spans
        if not spans:
            return text
        out, at = [], 0
        for start, end, _, made in spans:
            out += [text[at:start], made]
            at = end
        return "".join([*out, text[at:]])


def _fill(shape: str, signs: str) -> str:
    """``shape`` with its letters and digits taken from ``signs`` in order."""
    it = iter(signs)
    return "".join(next(it) if c.isalnum() else c for c in shape)


KINDS = ("email", "token", "ip", "date", "ssn", "phone", "iban", "secret", "card")


def pseudonymised(docs: DataFrame, key_bytes: bytes | None = None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, ``text`` with pseudonyms, and spans (start, end, kind, pseudonym) in the original text.
    Without ``key_bytes`` the session's key is used."""
    key_bytes = key_bytes or key_of(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Pseudonyms(key_bytes)
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("pseudonym", pa.string())]))
        for part, texts in text_batches(batches, "text"):
            found = [own.spans(x) for x in texts]
            made = [own.replace(x, f) for x, f in zip(texts, found, strict=True)]
            lists = [[dict(zip(("start", "end", "kind", "pseudonym"), s, strict=True)) for s in f] for f in found]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(made, pa.string()), pa.array(lists, span)], ["key", "text", "spans"])

    rows = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))
    out = rows.mapInArrow(run, "key bigint, text string, spans array<struct<start:bigint,end:bigint,kind:string,pseudonym:string>>")
    return out.withColumnsRenamed({"key": key, "text": text})


def pseudonymise(text: str | Column, key_bytes: bytes) -> Column:
    """A whole text column with pseudonyms; key_of() gives the session's key."""
    held: dict[int, Pseudonyms] = {}

    @F.arrow_udf("string")
    def made(texts: pa.Array) -> pa.Array:
        if not held:
            held[0] = Pseudonyms(key_bytes)
        return pa.array([held[0].replace(x) for x in texts.to_pylist()], pa.string())

    return made(F.col(text) if isinstance(text, str) else text)
