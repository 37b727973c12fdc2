"""Format-preserving pseudonyms: validated numbers and dates are permuted by a keyed Feistel network in their format."""

from __future__ import annotations

import bisect
import datetime as dt
import hashlib
import ipaddress
import itertools
import math
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from telemill.llm.common import map_slices

ROUNDS = 10

#: Dates in this range are permuted, others are left as they are.
FIRST_DAY, LAST_DAY = dt.date(1900, 1, 1), dt.date(2099, 12, 31)


class Permutation:
    """A keyed permutation of 0 ... size - 1 without fixed points."""

    def __init__(self, key: bytes, name: str, size: int):
        self.size = size
        self.left = math.isqrt(size - 1) + 1
        self.right = -(-size // self.left)
        seed = hashlib.blake2b(f"{name}:{size}".encode(), key=hashlib.sha256(key).digest(), digest_size=32).digest()
        self.seed = seed
        self.bytes = min(64, (self.left.bit_length() + 7) // 8 + 8)

    def _round(self, i: int, value: int) -> int:
        data = i.to_bytes(1, "big") + value.to_bytes((value.bit_length() + 7) // 8, "big")
        return int.from_bytes(hashlib.blake2b(data, key=self.seed, digest_size=self.bytes).digest(), "big")

    def _feistel(self, value: int, inverse: bool = False) -> int:
        sign = -1 if inverse else 1
        while True:  # what leaves the domain goes round again
            a, b = divmod(value, self.right)
            for i in reversed(range(ROUNDS)) if inverse else range(ROUNDS):
                if i % 2:
                    b = (b + sign * self._round(i, a)) % self.right
                else:
                    a = (a + sign * self._round(i, b)) % self.left
            value = a * self.right + b
            if value < self.size:
                return value

    def __call__(self, value: int, step: int = 1) -> int:
        """The pseudonym of a value; with step -1 the value of a pseudonym."""
        if self.size < 2:
            return value
        return self._feistel((self._feistel(value) + step) % self.size, inverse=True)


def luhn(digits: str) -> int:
    """The sum that is a multiple of 10 for a valid number."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) << (i & 1)
        total += d - 9 if d > 9 else d
    return total


def iban_sum(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97


def _refill(shape: str, digits: Iterable[str]) -> str:
    """`shape` with its digits replaced in order."""
    new = iter(digits)
    return "".join(next(new) if c in "0123456789" else c for c in shape)


def _spliced(text: str, parts: list[tuple[int, int, str]]) -> str:
    """`text` with other strings at sorted places."""
    out, last = [], 0
    for start, end, new in parts:
        out += text[last:start], new
        last = end
    return "".join([*out, text[last:]])


class Pseudonymizer:
    """Finds values in a text and replaces them. Step -1 restores what step 1 has replaced."""

    #: What begins with a digit or a plus sign, but cards; the longest forms first. A comma may join values, as in tables.
    NUMBERS = re.compile(
        r"[+0-9](?:(?<=\+)(?P<phone>[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4})(?![0-9])"
        r"|(?<=[0-9])(?<![0-9][0-9])(?<![0-9]\.[0-9])(?:"
        r"(?P<iso>[0-9]{3}-[0-9]{2}-[0-9]{2})(?![0-9-])"
        r"|(?P<day>[0-9](?P<mark>[./-])[0-9]{2}(?P=mark)[0-9]{4})(?![0-9]|[./-][0-9])"
        r"|(?P<ssn>[0-9]{2}-[0-9]{2}-[0-9]{4})(?![0-9-])"
        r"|(?P<ip>[0-9]{0,2}(?:\.[0-9]{1,3}){3})(?![0-9]|\.[0-9])"
        r"))"
    )
    #: Groups of digits in which cards may lie.
    RUN = re.compile(r"[0-9](?:[ -]?[0-9]){12,}")
    IBAN = re.compile(r"[A-Z][A-Z][0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
    LOCAL = re.compile(r"[A-Za-z0-9](?:[A-Za-z0-9._%+-]{0,62}[A-Za-z0-9])?\Z")
    HOST = re.compile(r"@(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?\.)+[A-Za-z]{2,24}(?![A-Za-z0-9-])")
    SECRET = re.compile(
        r"(?i:token|secret|password|passwd|key)[\"']?\s{0,3}[:=]\s{0,3}[\"']?"
        r"([0-9a-f]{32,}|[0-9A-F]{32,})(?![0-9A-Za-z])"
    )
    SECRET_WORDS = ("token", "secret", "passw", "key")

    def __init__(self, key: bytes, step: int = 1):
        self.key, self.step, self.known = key, step, {}

    def permuted(self, name: str, size: int, value: int) -> int:
        got = self.known.get((name, size))
        if got is None:
            got = self.known[name, size] = Permutation(self.key, name, size)
        return got(value, self.step)

    def characters(self, name: str, text: str) -> str:
        """`text` with letters and digits permuted, each within its class and case."""
        size = value = 0
        sizes = []
        for c in text:
            n = 10 if c in "0123456789" else 26 if c.isascii() and c.isalpha() else 1
            sizes.append(n)
            value = value * n + (0 if n == 1 else int(c, 36) - (10 if n == 26 else 0))
        size = math.prod(sizes)
        value = self.permuted(name, size, value)
        out = []
        for c, n in zip(reversed(text), reversed(sizes)):
            value, d = divmod(value, n)
            out.append(c if n == 1 else str(d) if n == 10 else chr(ord("A" if c.isupper() else "a") + d))
        return "".join(reversed(out))

    # Each gives the pseudonym of a value of its format, or None if the value is not valid.

    def card(self, digits: str) -> str:
        """Keeps the sum that the digits have before an odd number of others, so that these stay no part of the card."""
        n, before = len(digits) - 1, luhn(digits + "0") % 10
        while True:
            body = str(self.permuted("card", 10**n, int(digits[:-1]))).zfill(n)
            digits = body + str(-luhn(body + "0") % 10)
            if luhn(digits + "0") % 10 == before:
                return digits

    def cards(self, text: str) -> Iterator[tuple[int, int, str]]:
        """Start, end and pseudonym of the cards in a text.

        In a run of groups of digits, a card begins at the first group from which 13 to 19 digits of whole groups, with
        one kind of mark between them, have a right Luhn digit; it is the longest. Groups that were no card must not
        become one, else a text could not be restored: a pseudonym with which they would is permuted again.
        """
        for run in self.RUN.finditer(text):
            groups = [m.span() for m in re.finditer("[0-9]+", run[0])]
            digits = re.sub("[^0-9]", "", run[0])
            ends = list(itertools.accumulate(b - a for a, b in groups))
            decimals = re.search(r"[0-9]\.\Z", text[max(0, run.start() - 2) : run.start()])
            found, others = [], []  # groups from and to, and digits from and to of what is not valid
            i = 1 if decimals else 0
            while i < len(groups):
                start, fits = ends[i - 1] if i else 0, []
                for j in range(i, len(groups)):
                    if ends[j] - start > 19 or j > i + 1 and run[0][groups[j][0] - 1] != run[0][groups[i + 1][0] - 1]:
                        break
                    if ends[j] - start >= 13:
                        fits.append(j)
                for j in reversed(fits):
                    if luhn(digits[start : ends[j]]) % 10 == 0:
                        found.append((i, j))
                        break
                    others.append((start, ends[j]))
                i = found[-1][1] + 1 if found and found[-1][0] == i else i + 1
            now = list(digits)
            for i, j in found[:: self.step]:
                start, end = ends[i - 1] if i else 0, ends[j]
                near = others[bisect.bisect(others, (start - 19,)) : bisect.bisect(others, (end,))]
                near = [(a, b) for a, b in near if b > start]
                value = digits[start:end]
                while True:
                    value = self.card(value)
                    # from 19 digits before the card to 19 after it
                    low = max(0, start - 19)
                    there = "".join(now[low:start]) + value + "".join(now[end : end + 19])
                    if all(luhn(there[a - low : b - low]) % 10 for a, b in near):
                        break
                now[start:end] = value
            for i, j in found:
                a, b = groups[i][0], groups[j][1]
                new = _refill(run[0][a:b], now[ends[i - 1] if i else 0 : ends[j]])
                yield run.start() + a, run.start() + b, new

    def phone(self, text: str) -> str | None:
        head = re.match(r"\+(?:[0-9]{1,3}(?=[ .(-])|[0-9])", text).end()
        digits = re.sub("[^0-9]", "", text[head:])
        if not 8 <= len(digits) + head - 1 <= 15:
            return None
        new = str(self.permuted("phone", 10 ** len(digits), int(digits))).zfill(len(digits))
        return text[:head] + _refill(text[head:], new)

    def ip(self, text: str) -> str | None:
        try:
            value = int(ipaddress.IPv4Address(text))
        except ValueError:
            return None
        return str(ipaddress.IPv4Address(self.permuted("ip", 1 << 32, value)))

    def ssn(self, text: str) -> str | None:
        area, group, serial = map(int, text.split("-"))
        if area in (0, 666) or area > 899 or not group or not serial:
            return None
        value = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
        value, serial = divmod(self.permuted("ssn", 898 * 99 * 9999, value), 9999)
        area, group = divmod(value, 99)
        return f"{area + 1 + (area >= 665):03d}-{group + 1:02d}-{serial + 1:04d}"

    def _date(self, year: str, month: str, day: str) -> dt.date | None:
        try:
            date = dt.date(int(year), int(month), int(day))
        except ValueError:
            return None
        if not FIRST_DAY <= date <= LAST_DAY:
            return None
        days = self.permuted("date", (LAST_DAY - FIRST_DAY).days + 1, (date - FIRST_DAY).days)
        return FIRST_DAY + dt.timedelta(days)

    def iso(self, text: str) -> str | None:
        date = self._date(*text.split("-"))
        return date and date.isoformat()

    def day(self, text: str) -> str | None:
        mark = text[2]
        date = self._date(*reversed(text.split(mark)))
        return date and date.strftime(f"%d{mark}%m{mark}%Y")

    def iban(self, text: str) -> str | None:
        plain = text.replace(" ", "")
        if not 15 <= len(plain) <= 34 or iban_sum(plain) != 1 or not 2 <= int(plain[2:4]) <= 98:
            return None
        body = self.characters("iban", plain[4:])
        check = 98 - iban_sum(plain[:2] + "00" + body)
        new = iter(f"{plain[:2]}{check:02d}{body}")
        return "".join(c if c == " " else next(new) for c in text)

    def email(self, text: str) -> str:
        local, host = text.rsplit("@", 1)
        return f"{self.characters('email', local)}@{host}"

    def secret(self, text: str) -> str:
        new = f"{self.permuted('secret', 16 ** len(text), int(text, 16)):0{len(text)}x}"
        return new.upper() if text.isupper() else new

    def secrets(self, text: str) -> Iterator[tuple[int, int, str]]:
        low = text.lower()
        if len(low) == len(text) and any(word in low for word in self.SECRET_WORDS) or len(low) != len(text):
            for m in self.SECRET.finditer(text):
                yield *m.span(1), "secret"

    def emails(self, text: str) -> Iterator[tuple[int, int, str]]:
        at = text.find("@")
        while at >= 0:
            host = self.HOST.match(text, at)
            local = host and self.LOCAL.search(text[max(0, at - 64) : at])
            if local:
                yield at - len(local[0]), host.end(), "email"
            at = text.find("@", at + 1)

    def ibans(self, text: str) -> Iterator[tuple[int, int, str]]:
        for m in self.IBAN.finditer(text):
            if m.start() == 0 or not text[m.start() - 1].isalnum():
                yield *m.span(), "iban"

    def numbers(self, text: str) -> Iterator[tuple[int, int, str]]:
        for m in self.NUMBERS.finditer(text):
            yield *m.span(), m.lastgroup if m.lastgroup != "mark" else "day"

    def replace(self, text: str) -> tuple[str, list[str]]:
        """The text with pseudonyms, and their kinds in order of place.

        The surest kinds go first. What they replace is hidden from the others, which so find the same in the new text.
        """
        changes: list[tuple[int, int, str, str]] = []
        rest = text
        for find in (self.secrets, self.emails, self.ibans, self.numbers, None):
            made: list[tuple[int, int, str, str]] = []
            if find is None:
                made = [(start, end, "card", new) for start, end, new in self.cards(rest)]
            else:
                for start, end, kind in find(rest):
                    new = getattr(self, kind)(rest[start:end]) if not made or start >= made[-1][1] else None
                    if new is not None:
                        made.append((start, end, kind, new))
            if made:
                rest = _spliced(rest, [(start, end, "\0" * (end - start)) for start, end, _, _ in made])
                changes += made
        if not changes:
            return text, []
        changes.sort()
        return _spliced(text, [(start, end, new) for start, end, _, new in changes]), [kind for _, _, kind, _ in changes]


def pseudonymize(docs: DataFrame, key: bytes, step: int = 1) -> DataFrame:
    """`docs` with values in `text` replaced, and the kinds of the replaced values, in order, as `pii_kinds`.

    Kinds: card numbers (13 to 19 digits with a right Luhn digit, also in groups), international phone numbers, IPv4
    addresses, US social security numbers, IBANs with right check digits, calendar dates (`yyyy-mm-dd`, `dd.mm.yyyy`,
    `dd/mm/yyyy`, `dd-mm-yyyy`) from 1900 to 2099, the names in e-mail addresses, and long hexadecimal secrets after
    `token =` and the like. A value becomes another valid value of the same format. Equal values have equal pseudonyms
    under one key, in all documents; numbers that are not valid stay. `step=-1` and the key restore the texts.

    A value may follow a comma or a plus sign at once, but not a digit, or a digit and a full stop, which makes it part of
    a longer number. A card may have other groups of digits beside it: among many short numbers in a row some are right
    by chance and are replaced too. Where groups that are no card reach into a card and its pseudonym would make them
    one, this card alone has another pseudonym, so that the text can be restored.

    A null text stays null and an empty one empty, with no kinds; all other columns pass through unchanged, but for an
    earlier column `pii_kinds`, which is replaced. Rows are independent of each other, so repeated rows and ids do not
    matter; an empty frame gives an empty frame.
    """
    docs = docs.drop("pii_kinds")
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), "pii_kinds array<string>"])
    tools: dict[int, Pseudonymizer] = {}

    def run(piece: pa.RecordBatch) -> dict:
        tool = tools.setdefault(step, Pseudonymizer(key, step))
        texts, kinds = [], []
        for text in piece.column("text").to_pylist():
            new, kind = (text, []) if not text else tool.replace(text)
            texts.append(new)
            kinds.append(kind)
        return dict(zip(piece.schema.names, piece.columns)) | {"text": texts, "pii_kinds": kinds}

    return map_slices(docs, "text", schema, run)
