"""PII: format-preserving pseudonyms by a keyed Feistel network.

A value is read as a number within the set of values of its format, and that number is
permuted: the result has the same format and passes the same validation, and equal values get
equal pseudonyms in all documents. Nothing is stored and nothing is shuffled; who holds the
key can undo it.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterator
from datetime import date, timedelta

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from railyard.llm.common import LOWER, UPPER, in_worker, lean, small_batches

KEY = "spark.railyard.pii.key"
ROUNDS = 10
TO_LOWER = str.maketrans(UPPER, LOWER)


def session_key(spark: SparkSession) -> bytes:
    """The key in hexadecimal that the session names. Where it names none, a random one that
    lasts as long as the session, so that no key is ever part of the code."""
    if not spark.conf.get(KEY, None):
        spark.conf.set(KEY, os.urandom(32).hex())
    return bytes.fromhex(spark.conf.get(KEY))


# ---------------------------------------------------------------- the permutation
def permute(value: int, size: int, key: bytes, use: str) -> int:
    """A keyed permutation of range(size): Feistel over two halves, walking the cycle until
    the result is within range. ``use`` separates the formats from each other."""
    a = max(1, int(size**0.5)) if size < 1 << 52 else 1 << (size.bit_length() // 2)
    b = -(-size // a)

    def mix(i: int, half: int) -> int:
        text = f"{use}|{size}|{i}|{half}".encode()
        return int.from_bytes(hashlib.blake2b(text, key=key, digest_size=64).digest())

    while True:
        left, right = value % a, value // a
        for i in range(0, ROUNDS, 2):
            left = (left + mix(i, right)) % a
            right = (right + mix(i + 1, left)) % b
        value = right * a + left
        if value < size:
            return value


def permute_where(value: int, size: int, key: bytes, use: str, fits: Callable[[int], bool]) -> int:
    """The permutation within the values that fit; ``value`` must be one of them."""
    while True:
        value = permute(value, size, key, use)
        if fits(value):
            return value


def permute_characters(text: str, key: bytes, use: str) -> str:
    """Letters and digits permuted within their classes; other characters stay. The value is
    read in lower case and gets its case back, so its spellings stay linked."""
    low = text.translate(TO_LOWER)  # letters beyond ASCII stay, so places stay
    kinds = ["0123456789abcdef"] if re.fullmatch("[0-9a-f]+", low) and not re.fullmatch("[0-9]+", low) else [
        "0123456789", "abcdefghijklmnopqrstuvwxyz"
    ]
    at = [(i, k) for i, c in enumerate(low) for k in kinds if c in k]
    size, number = 1, 0
    for i, k in at:
        size, number = size * len(k), number * len(k) + k.index(low[i])
    if size == 1:
        return text
    form = "".join("x" if any(c in k for k in kinds) else c for c in low)
    out, number = list(text), permute(number, size, key, f"{use}|{form}|{len(kinds)}")
    for i, k in reversed(at):
        number, r = divmod(number, len(k))
        out[i] = k[r] if text[i] == low[i] else k[r].upper()
    return "".join(out)


# ---------------------------------------------------------------- formats
def _with_digits(form: str, digits: str) -> str:
    """The digits of ``form`` replaced in order."""
    new = iter(digits)
    return re.sub(r"[0-9]", lambda _: next(new), form)


def _luhn(digits: str) -> int:
    """The check digit that follows these digits."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


def card(text: str, key: bytes) -> str | None:
    digits = re.sub(r"[^0-9]", "", text)
    if not 13 <= len(digits) <= 19 or len(set(digits)) == 1 or _luhn(digits[:-1]) != int(digits[-1]):
        return None
    n = len(digits) - 1
    body = str(permute(int(digits[:-1]), 10**n, key, "card")).zfill(n)
    return _with_digits(text, body + str(_luhn(body)))


def _iban_check(country: str, body: str) -> int:
    number = "".join(str(int(c, 36)) for c in body + country + "00")
    return 98 - int(number) % 97


def iban(text: str, key: bytes) -> str | None:
    packed = re.sub(r"\s", "", text)
    country, check, body = packed[:2], packed[2:4], packed[4:]
    if not 11 <= len(body) <= 30 or _iban_check(country, body) != int(check):
        return None
    body = permute_characters(body, key, f"iban {country}")
    out = iter(f"{country}{_iban_check(country, body):02d}{body}")
    return "".join(c if c.isspace() else next(out) for c in text)


def social_number(text: str, key: bytes) -> str | None:
    def fits(v: int) -> bool:
        area, group, serial = v // 1_000_000, v // 10_000 % 100, v % 10_000
        return 0 < area < 900 and area != 666 and group > 0 and serial > 0

    value = int(text.replace("-", ""))
    if not fits(value):
        return None
    return _with_digits(text, str(permute_where(value, 10**9, key, "social", fits)).zfill(9))


def address(text: str, key: bytes) -> str | None:
    parts = [int(x) for x in text.split(".")]
    if max(parts) > 255 or any(len(x) > 1 and x[0] == "0" for x in text.split(".")):
        return None
    value = permute(int.from_bytes(bytes(parts)), 1 << 32, key, "address")
    return ".".join(map(str, value.to_bytes(4)))


# country codes of two digits; 1 and 7 have one, all others three
TWO = frozenset(
    "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 "
    "65 66 81 82 84 86 90 91 92 93 94 95 98".split()
)
# most digits after the code, where the numbering plan is a fixed one; others have up to 14
MOST_DIGITS = {"1": 10, "7": 10, "31": 9, "33": 9, "34": 9, "41": 9, "44": 10, "45": 8, "47": 8,
               "48": 9, "61": 9, "86": 11, "91": 10, "351": 9}
FURTHER = re.compile(
    r" (?:[0-9]{1,3}(?:\.[0-9]{1,3}){3}|[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}|[0-9]{1,2}([./])[0-9]{1,2}\1[0-9]{4}"
    r"|[0-9]{3}-[0-9]{2}-[0-9]{4}|[0-9]{4}([ -])[0-9]{4}\2[0-9]{4}\2[0-9]{1,4})(?![\w-])"
)


def _country(digits: str) -> str:
    return digits[: 1 if digits[0] in "17" else 2 if digits[:2] in TWO else 3]


def _number(text: str) -> tuple[str, str]:
    """Country code and the digits after it, without a (0). Forms without + are of code 1."""
    digits = re.sub(r"[^0-9]", "", text.replace("(0)", ""))
    code = _country(digits) if text[0] == "+" else "1"
    return code, digits[len(code) :] if text[0] == "+" else digits


def phone_end(text: str, start: int, end: int) -> int:
    """Where the phone number ends that starts at ``start`` and has its groups up to ``end``:
    before a further number, date or address, and before a group that its plan has no room for."""
    if text[start] != "+":
        return end
    best = None
    for m in re.finditer(r"[0-9]+", text[start:end]):
        at = start + m.end()
        code, rest = _number(text[start:at])
        most = MOST_DIGITS.get(code, 14)
        if len(code) + len(rest) < 8 or text[at : at + 1] == ")":
            continue
        if best is None or len(rest) <= most:
            best = at
        whole = len(m[0]) >= 6 and len(code) + len(rest) >= 11 and text[at : at + 1] == " "
        if len(rest) >= most or whole or FURTHER.match(text, at):
            break
    return best or end


def phone(text: str, key: bytes) -> str | None:
    """All digits but the country code. Every notation of a number gets the same digits."""
    code, digits = _number(text)
    if len(code) + len(digits) < 8 or len(digits) > 14:
        return None
    new = str(permute(int(digits), 10 ** len(digits), key, f"phone {code}")).zfill(len(digits))
    put = iter((code if text[0] == "+" else "") + new)
    return re.sub(r"\(0\)|[0-9]", lambda m: m[0] if m[0] == "(0)" else next(put), text)


FIRST, LAST = date(1900, 1, 1), date(2099, 12, 31)


def calendar_date(text: str, key: bytes) -> str | None:
    """Dates of 1900 to 2099 as y-m-d, d.m.y or d/m/y (m/d/y where only that is a date)."""
    a, sep, b, _, c = re.fullmatch(r"([0-9]+)([-/.])([0-9]+)([-/.])([0-9]+)", text).groups()
    orders = ["ymd"] if len(a) == 4 else ["dmy", "mdy"]
    for order in orders:
        part = dict(zip(order, (a, b, c)))
        try:
            day = date(int(part["y"]), int(part["m"]), int(part["d"]))
        except ValueError:
            continue
        if not FIRST <= day <= LAST:
            continue
        days = permute((day - FIRST).days, (LAST - FIRST).days + 1, key, "date")
        new = FIRST + timedelta(days)
        put = {"y": f"{new.year:04d}", "m": f"{new.month:02d}", "d": f"{new.day:02d}"}
        return sep.join(put[p] for p in order)
    return None


def mail(text: str, key: bytes) -> str:
    """The name and each part of the domain but the last."""
    name, domain = text.rsplit("@", 1)
    labels, top = domain.rsplit(".", 1)
    hidden = ".".join(permute_characters(x, key, "domain") for x in labels.split("."))
    return f"{permute_characters(name, key, 'mail')}@{hidden}.{top}"


def secret(text: str, key: bytes) -> str | None:
    """A plain word, of one case but for its first letter and maybe with a full stop, is none."""
    if re.fullmatch(r"[^\W\d_]?(?:[^\W\d_A-Z]*|[^\W\d_a-z]*)[.-]?", text):
        return None
    return permute_characters(text, key, "secret")


# name, what is replaced (its group 1 if it has one), how
FORMATS = (
    ("mail", r"(?<![\w.+%-])[\w.+%-]+@(?:[\w-]+\.)+[^\W\d_]{2,}", mail),
    ("secret", r"(?i:\b(?:token|secret|passw(?:or)?d|pwd|api[ _-]?key|access[ _-]?key|auth|bearer)\b"
               r"\s*[:=]\s*[\"']?)([\w+/=.-]{8,})", secret),
    ("secret", r"\b(?:AKIA[0-9A-Z]{16}|gh[opsur]_[0-9A-Za-z]{36}|sk-[0-9A-Za-z]{20,}|[0-9a-f]{40}|[0-9A-F]{40})\b", secret),
    ("iban", r"\b[A-Z]{2}[0-9]{2}(?:[ \xa0\u202f]?[0-9A-Z]{4}){2,7}(?:[ \xa0\u202f]?[0-9A-Z]{1,3})?\b", iban),
    ("phone", r"(?<![\w+])\+[0-9]{1,3}[ \xa0\u202f.-]?(?:\([0-9]{1,4}\)[ \xa0\u202f.-]?)?[0-9]{1,4}(?:[ \xa0\u202f.-]?[0-9]{2,4}){1,4}(?![0-9])", phone),
    ("phone", r"(?<![\w+])\([0-9]{3}\)[ \xa0\u202f]?[0-9]{3}[-.\xa0\u202f ][0-9]{4}(?![0-9])", phone),
    ("phone", r"(?<![\w.+-])[0-9]{3}([-.])[0-9]{3}\1[0-9]{4}(?![\w-])", phone),
    ("address", r"(?<![\w.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\w|\.[0-9])", address),
    ("date", r"(?<![\w./-])(?:[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4})(?![\w/-])", calendar_date),
    ("social", r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])", social_number),
    ("number", r"(?<![\w.,-])[0-9]{4}(?:[ \xa0\u202f-][0-9]{4}){2,3}(?:[ \xa0\u202f-][0-9]{1,3})?(?![\w-])", card),
    ("number", r"(?<![0-9.,])[0-9]{13,19}(?![0-9])", card),
)
HINT = re.compile(r"[0-9@:=]")


class Pseudonyms:
    def __init__(self, key: bytes):
        self.key = key
        self.formats = [(name, re.compile(p), f) for name, p, f in FORMATS]

    def of_text(self, text: str) -> tuple[str, list[str]]:
        """The text with its pseudonyms, and the kinds found, once for each value."""
        if not HINT.search(text):
            return text, []
        kinds, done = [], []  # done: what is replaced already, and by what
        # two characters that the text has not got mark what is replaced
        free = (c for c in map(chr, (2, 3, *range(0xE000, 0xF900))) if c not in text)
        left, right = next(free), next(free)
        for name, pattern, change in self.formats:

            def replace(m: re.Match, name=name, change=change) -> str:
                group = 1 if name == "secret" and m.re.groups else 0
                value = m[group]
                if name == "phone":
                    value = value[: phone_end(m.string, m.start(), m.end()) - m.start()]
                if left in value:
                    return m[0]
                new = change(value, self.key)
                if new is None or (new == value and not re.search("[0-9A-Za-z]", value)):
                    return m[0]
                kinds.append(name)
                done.append(new)
                at = m.start(group) - m.start()
                return f"{m[0][:at]}{left}{len(done) - 1}{right}{m[0][at + len(value) :]}"

            text = pattern.sub(replace, text)
        if done:
            text = re.sub(f"{left}([0-9]+){right}", lambda m: done[int(m[1])], text)
        return text, kinds


def pseudonymise(documents: DataFrame, key: bytes, column: str = "text") -> DataFrame:
    """``documents`` with its text changed, and pii, an array of the kinds found.

    Null stays null and an empty text empty. A text without findings stays as it is, byte for
    byte. Rows keep their other columns; one named pii is replaced.
    """
    keep = [c for c in documents.columns if c not in (column, "pii")]
    source = small_batches(documents).select(*keep, column)

    def change(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = in_worker(f"pii {hashlib.blake2b(key).hexdigest()}", lambda: Pseudonyms(key))
        for batch in batches:
            texts, kinds = [], []
            for text in batch.column(batch.num_columns - 1).to_pylist():
                new, found = by.of_text(text) if text else (text, [])
                texts.append(new)
                kinds.append(found)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(texts, pa.string()), pa.array(kinds, pa.list_(pa.string()))],
                [*batch.schema.names, "pii"],
            )

    schema = StructType([*source.schema.fields, StructField("pii", ArrayType(StringType()))])
    changed = source.mapInArrow(lean(change), schema)
    return changed.select(*documents.drop("pii").columns, "pii")
