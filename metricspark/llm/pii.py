"""Format-preserving pseudonyms for personal numbers, dates and addresses by Feistel permutations."""

from __future__ import annotations

import datetime
import hashlib
import hmac
import ipaddress
import re
import string
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricspark.llm.text import free_name

#: Rounds of the Feistel network.
ROUNDS = 8
#: First and last day that dates are permuted among, as proleptic ordinals.
FIRST_DAY = datetime.date(1900, 1, 1).toordinal()
LAST_DAY = datetime.date(2099, 12, 31).toordinal()
#: Months as dates in words name them. Fixed values.
MONTHS = "January February March April May June July August September October November December".split()
#: Entries a worker keeps of what it has permuted.
REMEMBERED = 100_000
#: Calling codes of two digits; 1 and 7 are the only ones of one digit, the others have three.
_CODES_OF_TWO = frozenset(
    "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 "
    "90 91 92 93 94 95 98".split()
)


class Feistel:
    """A keyed permutation of 0 … n-1, by a balanced network over the next even number of
    bits and walking until the value is back in range."""

    def __init__(self, key: bytes, tweak: str, n: int) -> None:
        if n < 1:
            raise ValueError("an empty range has no permutation")
        self.n = n
        self.half = max(1, ((n - 1).bit_length() + 1) // 2)
        self.mask = (1 << self.half) - 1
        self.bytes = (self.half + 7) // 8
        self.key = hmac.new(key, f"{tweak}:{n}".encode(), hashlib.sha256).digest()

    def _round(self, number: int, value: int) -> int:
        out, block = b"", 0
        while len(out) < self.bytes:
            data = bytes([number, block]) + value.to_bytes(self.bytes, "big")
            out += hashlib.blake2b(data, key=self.key, digest_size=32).digest()
            block += 1
        return int.from_bytes(out[: self.bytes], "big") & self.mask

    def _once(self, value: int, back: bool) -> int:
        left, right = value >> self.half, value & self.mask
        for number in reversed(range(ROUNDS)) if back else range(ROUNDS):
            if back:
                left, right = right ^ self._round(number, left), left
            else:
                left, right = right, left ^ self._round(number, right)
        return left << self.half | right

    def __call__(self, value: int, back: bool = False) -> int:
        value = self._once(value, back)
        while value >= self.n:
            value = self._once(value, back)
        return value


def luhn_digit(digits: str) -> str:
    """The check digit that belongs behind ``digits``."""
    total = sum(int(d) if i % 2 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits)))
    return str(-total % 10)


def iban_check(country: str, body: str) -> str:
    number = "".join(str(int(c, 36)) for c in body + country + "00")
    return f"{98 - int(number) % 97:02d}"


def _code_digits(number: str) -> int:
    """Digits of the country code that an international number begins with."""
    return 1 if number[0] in "17" else 2 if number[:2] in _CODES_OF_TWO else 3


def _refill(template: str, symbols: str, keep: Callable[[str], bool]) -> str:
    """``template`` with the characters that ``keep`` selects replaced in order."""
    it = iter(symbols)
    return "".join(next(it) if keep(c) else c for c in template)


def _is_digit(c: str) -> bool:
    return "0" <= c <= "9"


def _is_alnum(c: str) -> bool:
    return _is_digit(c) or "A" <= c <= "Z" or "a" <= c <= "z"


def _cased(symbols: str, like: str) -> str:
    """Small letters of ``symbols`` in the case of the characters at their places."""
    return "".join(new.upper() if "A" <= old <= "Z" else new for new, old in zip(symbols, like, strict=True))


class Pseudonyms:
    """Permutations of each kind under one key. Equal values get equal pseudonyms, however
    they are separated or cased: separators, the case of letters by their place and what is no
    letter or digit of ASCII stay as they stand."""

    def __init__(self, key: bytes) -> None:
        self.key = key
        self.networks: dict[tuple[str, int], Feistel] = {}
        self.held: dict[tuple[str, str], str] = {}

    def _permute(self, kind: str, value: int, n: int, back: bool) -> int:
        network = self.networks.get((kind, n))
        if network is None:
            network = self.networks[kind, n] = Feistel(self.key, kind, n)
        return network(value, back)

    def _digits(self, kind: str, digits: str, back: bool) -> str:
        n = len(digits)
        return f"{self._permute(f'{kind}{n}', int(digits), 10**n, back):0{n}d}" if n else ""

    def card(self, text: str, back: bool) -> str | None:
        """Both Luhn sums stay, so that a card tells itself from numbers beside it before
        and after alike."""
        digits = "".join(filter(_is_digit, text))
        if luhn_digit(digits[:-1]) != digits[-1]:
            return None
        other, body = luhn_digit(digits), digits[:-1]
        while True:
            body = self._digits("card", body, back)
            new = body + luhn_digit(body)
            if luhn_digit(new) == other:
                return _refill(text, new, _is_digit)

    def ssn(self, text: str, back: bool) -> str | None:
        area, group, serial = text[:3], text[4:6], text[7:]
        if not (0 < int(area) < 900 and area != "666" and int(group) and int(serial)):
            return None
        # Valid numbers in order: area 1-899 without 666, group 1-99, serial 1-9999.
        at = ((int(area) - 1 - (int(area) > 666)) * 99 + int(group) - 1) * 9999 + int(serial) - 1
        at, serial_at = divmod(self._permute("ssn", at, 898 * 99 * 9999, back), 9999)
        area_at, group_at = divmod(at, 99)
        area_at += 1 + (area_at >= 665)
        return f"{area_at:03d}{text[3]}{group_at + 1:02d}{text[6]}{serial_at + 1:04d}"

    def phone(self, text: str, back: bool) -> str | None:
        """The country code stays."""
        digits = "".join(filter(_is_digit, text))
        code = _code_digits(digits) if text.startswith("+") else 0
        return _refill(text, digits[:code] + self._digits("phone", digits[code:], back), _is_digit)

    def address(self, text: str, back: bool) -> str | None:
        """An IPv4 address."""
        parts = text.split(".")
        if any(int(p) > 255 for p in parts):
            return None
        value = int.from_bytes(bytes(map(int, parts)), "big")
        return ".".join(map(str, self._permute("ipv4", value, 1 << 32, back).to_bytes(4, "big")))

    def address6(self, text: str, back: bool) -> str | None:
        """An IPv6 address, in full or with a run of zeros left out.

        Groups of zeros stay, and the others keep their number of digits without leading zeros,
        so spellings of one address stay linked and each keeps its form. Digits and letters stay
        in it if there are any, for it to be found and its case known; letters of both cases
        become small."""
        groups = text.split(":")
        short = "::" in text
        try:
            ipaddress.IPv6Address(text)
        except ValueError:
            return None
        if not any(map(_is_digit, text)):
            return None
        own = full = [g.lstrip("0").lower() for g in groups]
        before = after = 0
        if short:
            before = groups.index("")
            after = sum(map(bool, groups[before:]))
            full = own[:before] + [""] * (8 - before - after) + own[len(own) - after :]
        sizes = [15 * 16 ** (len(g) - 1) if g else 1 for g in full]
        n, value = 1, 0
        for g, size in zip(full, sizes):
            n, value = n * size, value * size + (int(g, 16) - 16 ** (len(g) - 1) if g else 0)
        if n == 1:
            return None
        kind = "ipv6" + "".join(str(len(g)) for g in full)
        kinds = {_is_digit(c) for c in "".join(full)}
        while True:
            value = rest = self._permute(kind, value, n, back)
            new = []
            for g, size in zip(reversed(full), reversed(sizes)):
                rest, at = divmod(rest, size)
                new.append(f"{at + 16 ** (len(g) - 1):x}" if g else "")
            new.reverse()
            if kinds == {_is_digit(c) for c in "".join(new)}:
                break
        if short:
            new = new[:before] + [""] * (len(groups) - before - after) + new[8 - after :]
        out = ":".join(g[: len(g) - len(o)] + x for g, o, x in zip(groups, own, new, strict=True))
        return out.upper() if text.upper() == text else out

    def _letters(self, kind: str, letters: str, back: bool) -> str:
        """Small letters for small letters."""
        if not letters:
            return ""
        value = 0
        for c in letters:
            value = value * 26 + ord(c) - 97
        value = self._permute(kind, value, 26 ** len(letters), back)
        out = []
        for _ in letters:
            value, c = divmod(value, 26)
            out.append(chr(97 + c))
        return "".join(reversed(out))

    def iban(self, text: str, back: bool) -> str | None:
        written = text.replace(" ", "")
        plain = written.upper()
        country, body = plain[:2], plain[4:]
        if not 11 <= len(body) <= 30 or iban_check(country, body) != plain[2:4]:
            return None
        # Digits stay digits and letters letters.
        digits = self._digits("iban" + country, "".join(filter(_is_digit, body)), back)
        letters = "".join(c for c in body if not _is_digit(c)).lower()
        letters = self._letters("ibanletters" + country, letters, back).upper()
        new = _refill(_refill(body, digits, _is_digit), letters, lambda c: not _is_digit(c))
        return _refill(text, _cased((country + iban_check(country, new) + new).lower(), written), _is_alnum)

    def email(self, text: str, back: bool) -> str | None:
        """Name and host: digits and letters are each permuted together, the last label stays."""
        at = text.rindex(".")
        head = text[:at]
        old = "".join(filter(_is_alnum, head))
        digits = "".join(filter(_is_digit, old))
        letters = "".join(c for c in old if not _is_digit(c)).lower()
        new = _refill(old, self._digits(f"email{len(letters)}-", digits, back), _is_digit)
        new = _refill(new, self._letters(f"email{len(digits)}letters", letters, back), lambda c: not _is_digit(c))
        return _refill(head, _cased(new, old), _is_alnum) + text[at:]

    def access_key(self, text: str, back: bool) -> str | None:
        """An access key of a cloud account: its prefix stays."""
        symbols = string.ascii_uppercase + "234567"
        body = text[4:]
        value = 0
        for c in body:
            value = value * 32 + symbols.index(c)
        value = self._permute("access_key", value, 32 ** len(body), back)
        out = []
        for _ in body:
            value, c = divmod(value, 32)
            out.append(symbols[c])
        return text[:4] + "".join(reversed(out))

    def secret(self, text: str, back: bool) -> str | None:
        """A run of hexadecimal digits, in the case it is written in."""
        value = self._permute("hex", int(text, 16), 16 ** len(text), back)
        new = f"{value:0{len(text)}x}"
        return new.upper() if text.upper() == text else new

    def _day(self, day: datetime.date, back: bool, order: str) -> datetime.date | None:
        days = LAST_DAY - FIRST_DAY + 1
        at = day.toordinal() - FIRST_DAY
        if not 0 <= at < days:
            return None
        while True:
            at = self._permute("date", at, days, back)
            new = datetime.date.fromordinal(FIRST_DAY + at)
            # A date with strokes and the day first keeps a day that cannot be a month.
            if order != "dmy/" or new.day > 12:
                return new

    def date(self, text: str, back: bool) -> str | None:
        """Year first as Y-M-D or Y/M/D, else D.M.Y and D-M-Y, or M/D/Y and where that is no
        date D/M/Y. Parts of one digit get a second only if they need it."""
        a, mark, b, c = re.fullmatch(r"(\d+)([-./])(\d+)[-./](\d+)", text).groups()
        for order in ("ymd",) if len(a) == 4 else ("mdy", "dmy") if mark == "/" else ("dmy",):
            given = dict(zip(order, (a, b, c)))
            try:
                day = datetime.date(int(given["y"]), int(given["m"]), int(given["d"]))
            except ValueError:
                continue
            new = self._day(day, back, order + mark)
            if new is None:
                return None
            parts = {"y": f"{new.year:04d}", "m": f"{new.month:0{len(given['m'])}d}", "d": f"{new.day:0{len(given['d'])}d}"}
            return mark.join(parts[k] for k in order)
        return None

    def date_words(self, text: str, back: bool) -> str | None:
        """Day, name of the month and year, linked with the same date in digits. A short name
        stays short, but May is both, so what became May goes back to a full name."""
        day, gap, name, other_gap, year = re.fullmatch(r"(\d+)( +)([A-Za-z]+)( +)(\d+)", text).groups()
        month = [m[:3].lower() for m in MONTHS].index(name[:3].lower()) + 1
        try:
            old = datetime.date(int(year), month, int(day))
        except ValueError:
            return None
        new = self._day(old, back, "dmy")
        if new is None:
            return None
        word = MONTHS[new.month - 1] if len(name) == len(MONTHS[month - 1]) else MONTHS[new.month - 1][:3]
        word = word.upper() if name.isupper() else word.lower() if name.islower() else word
        return f"{new.day:0{len(day)}d}{gap}{word}{other_gap}{new.year:04d}"

    def __call__(self, kind: str, text: str, back: bool = False) -> str | None:
        """The pseudonym, or None if ``text`` is not valid for its kind."""
        if back:
            return getattr(self, kind)(text, True)
        key = (kind, text)
        if key not in self.held:
            if len(self.held) >= REMEMBERED:
                self.held.clear()
            self.held[key] = getattr(self, kind)(text, False)
        return self.held[key]


#: What is looked for, by kind, in this order at each place. Number formats.
KINDS = {
    "email": r"(?<![.+%-])(?<!(?u:\w))(?u:[^\W_])(?u:[\w.%+-])*@(?u:[^\W_]|-)+(?:\.(?u:[^\W_]|-)+)*\.[A-Za-z]{2,}",
    "iban": (
        r"(?<![A-Za-z0-9])(?:[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?"
        r"|[a-z]{2}\d{2}(?: ?[a-z0-9]{4}){2,7}(?: ?[a-z0-9]{1,3})?)(?![A-Za-z0-9])"
    ),
    "address6": (
        r"(?<![0-9A-Za-z:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}"
        r"|[0-9A-Fa-f]{3,4}(?::[0-9A-Fa-f]{1,4}){0,6}::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5})?)(?![0-9A-Za-z:])"
    ),
    "date_words": r"(?i:(?<![\w./-])\d{1,2} {1,3}(?:" + "|".join(f"{m}|{m[:3]}" for m in MONTHS) + r") {1,3}\d{4}(?![\w-]|\.\d))",
    "date": r"(?<![\w./-])(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{1,2}\.\d{1,2}\.\d{4}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}-\d{1,2}-\d{4})(?!(?![Tt]\d{2}(?!\w)|[Tt]\d{2}:?\d{2})[\w/-]|\.\d)",
    "address": r"(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?!\w|\.\d)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "card": r"(?<![\w.-])\d(?:[ -]?\d){12,18}(?!\w|-\d)",
    "phone": (
        r"(?<![\w.])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}(?!\w|-\d)"
        r"|(?<![\w.])\(\d{3}\) ?\d{3}[-. ]\d{4}(?!\w)"
        r"|(?<![\w.-])\d{3}[-.]\d{3}[-.]\d{4}(?![\w-])"
    ),
    "access_key": r"(?<![0-9A-Za-z])A[KS]IA[A-Z2-7]{16}(?![0-9A-Za-z])",
    "secret": r"(?<![0-9A-Za-z])(?=[0-9A-Fa-f]*\d)(?:[0-9a-f]{32,128}|[0-9A-F]{32,128})(?![0-9A-Za-z])",
}
_FIND = {kind: re.compile(pattern, re.ASCII) for kind, pattern in KINDS.items()}
_ANY = re.compile("|".join(f"(?P<{kind}>{pattern})" for kind, pattern in KINDS.items()), re.ASCII)
#: Each value begins in a word with one of these.
_HINT = re.compile(r"[0-9@]|A[KS]IA")
_SPACE = re.compile(r"\s")
#: What stands before a secret.
_NAMED = re.compile(r"""(?:token|key|secret|passw(?:or)?d|auth\w*)["']?\s*[=:]\s*["']?\Z""", re.IGNORECASE)
_ORDER = list(KINDS)
#: Characters of an IBAN by country. The IBAN registry.
_IBAN_LENGTH = {
    country: length
    for length, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
        21: "CH CR HR LI LV", 22: "BG BH DE GB GE IE ME RS", 23: "AE GI IL IQ OM SO TL",
        24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
        28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}
#: Digits of the groups cards are written in, besides one group.
_CARD_GROUPS = {(4, 4, 4, 4), (4, 6, 5)}
_RUN = re.compile(r"[0-9A-Za-z]+")


def _iban_ends(text: str, own: re.Match) -> list[int]:
    """Where an IBAN may end that begins with this match: at its country's length, at the
    end of the match, and of an unknown country at each group. Small letters need a known
    country and its length."""
    borders = [run.end() for run in _RUN.finditer(text, own.start(), own.end())]
    small = own.group()[0].islower()
    length = _IBAN_LENGTH.get(own.group()[:2].upper())
    if length is None:
        return [] if small else borders[::-1]
    fixed = [b for b in borders if len(text[own.start() : b].replace(" ", "")) == length]
    return fixed if small else list(dict.fromkeys([*fixed, own.end()]))


def _card_ends(text: str, own: re.Match) -> list[int]:
    """Where a card may end that begins with this match, the end of the match first. No end
    if another part of the match looks more like the card."""
    runs = list(_RUN.finditer(text, own.start(), own.end()))
    # The first numbers of dates, addresses and phone numbers belong to those.
    other = [(run.start(), m.end()) for run in runs[1:] for k in ("date", "address", "phone") if (m := _FIND[k].match(text, run.start()))]
    sizes = [len(run.group()) for run in runs]
    found = []
    for i in range(len(runs)):
        for j in range(i, len(runs)):
            at, end = runs[i].start(), runs[j].end()
            digits = "".join(run.group() for run in runs[i : j + 1])
            if not 13 <= len(digits) <= 19 or any(a < end < b for a, b in other) or luhn_digit(digits[:-1]) != digits[-1]:
                continue
            usual = i == j or tuple(sizes[i : j + 1]) in _CARD_GROUPS
            found.append((i > 0 or end != own.end(), not usual, -len(digits), at, end))
    best = min(found, default=None)
    return [best[-1]] if best and best[-2] == own.start() else []


def _ends(kind: str, text: str, own: re.Match) -> list[int]:
    """The ends to try. Only cards and IBANs can run on into what follows them."""
    return _card_ends(text, own) if kind == "card" else _iban_ends(text, own) if kind == "iban" else [own.end()]


def _value_at(text: str, at: int, names: Pseudonyms, back: bool) -> tuple[int, int, str, str] | None:
    """The first kind that fits at this place and is valid."""
    first = _ANY.match(text, at)
    for kind in _ORDER[_ORDER.index(first.lastgroup) :] if first else ():
        own = _FIND[kind].match(text, at)
        if own and (kind != "secret" or _NAMED.search(text[max(0, at - 40) : at])):
            for end in _ends(kind, text, own):
                new = names(kind, text[at:end], back)
                if new is not None:
                    return at, end, kind, new
    return None


def spans(text: str, names: Pseudonyms, back: bool = False) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, pseudonym) of each valid value, from left to right.

    Only words with a digit or an at sign are looked at, each place of them once.
    """
    found, at = [], 0
    while hint := _HINT.search(text, at):
        start = hint.start()
        while start > at and not text[start - 1].isspace():
            start -= 1
        space = _SPACE.search(text, hint.end())
        at, end = start, space.start() if space else len(text)
        while at < end:
            value = _value_at(text, at, names, back)
            if value:
                found.append(value)
                at = value[1]
            else:
                at += 1
    return found


def rewrite(text: str, found: list[tuple[int, int, str, str]]) -> str:
    out, at = [], 0
    for start, end, _, new in found:
        out += (text[at:start], new)
        at = end
    return "".join((*out, text[at:]))


def pseudonymize(docs: DataFrame, key: str, text: str = "text", back: bool = False) -> DataFrame:
    """``docs`` with the personal values of ``text`` replaced, and where they are.

    Every row and column of ``docs`` comes back; ``text`` is rewritten, and pii_spans, an
    array of (start, end, kind, value) with places in the old text and the new value, is
    added (a column of that name is replaced). A null text stays null with no spans. Only
    values whose check digits or calendar hold are touched; a card or IBAN that a number or
    word follows ends where its check digits hold. Equal values get equal
    pseudonyms in all documents, because a pseudonym depends on key, kind and value alone;
    ``back`` undoes it. There is no shuffle, and equal rows give equal rows.
    """
    fields = "struct<start: int, end: int, kind: string, value: string>"
    made = pa.struct([("text", pa.string()), ("spans", pa.list_(pa.struct(
        [("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("value", pa.string())])))])

    @F.arrow_udf(f"struct<text: string, spans: array<{fields}>>")
    def replace(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        names = Pseudonyms(key.encode())
        for batch in batches:
            rows = []
            for value in (v.as_py() for v in batch):
                found = spans(value, names, back) if value else []
                new = rewrite(value, found) if found else value
                rows.append({"text": new, "spans": [dict(zip(("start", "end", "kind", "value"), s)) for s in found]})
            yield pa.array(rows, made)

    columns = [c for c in docs.columns if c != "pii_spans"]
    made_here = free_name(docs, "_pii")
    out = docs.withColumn(made_here, replace(F.col(text)))
    return out.select(
        *(F.col(f"{made_here}.text").alias(text) if c == text else F.col(f"`{c}`") for c in columns),
        F.col(f"{made_here}.spans").alias("pii_spans"),
    )
