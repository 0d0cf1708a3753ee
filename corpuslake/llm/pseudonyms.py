"""Format-preserving pseudonyms for personal numbers, dates and addresses.

A validated value is read as a number below the size of its format's domain, sent
through a keyed Feistel network with cycle walking, and written back in the same
layout: cards keep a right check digit, dates stay dates, octets keep their length.
The permutation depends only on key, kind and value, so equal values stay linked in
all documents and two different ones never become equal.  Each round draws as many bits
as half the domain has, so no part of a long value stays.  Letters and digits beyond
``CHUNK`` follow in chunks of their own, each permuted under what became of those before.

All layouts of a date share one permutation of days.  A date that is readable only with
the day first stays so if its new day allows it, and else is written month first.

Not found: dates with one-digit days or months, two-digit years, names of months or
years outside 1900 to 2099; phones without a plus sign other than 3-3-4; cards in
groups other than 4-4-4-n and 4-6-4 or 4-6-5.
"""

import hmac
import re
from bisect import bisect_left, bisect_right
from datetime import date
from functools import lru_cache
from hashlib import sha256, shake_256
from math import isqrt

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "phone", "card", "ip", "ssn", "iban", "date")
ROUNDS = 8
CHUNK = 64  # letters and digits that are permuted as one number
KEY = b"documented default key; pass your own"

_EMAIL_AT = re.compile(r"@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}(?![A-Za-z0-9-])")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_NUMBER = re.compile(
    r"(?<![\w@])(?:"
    r"(?P<ip>\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})(?![\d]|\.\d)"
    r"|(?P<card>\d{4}(?P<gap>[ -])\d{4}(?P=gap)\d{4}(?P=gap)\d{1,7}|\d{4}(?P<gap2>[ -])\d{6}(?P=gap2)\d{4,5}|\d{13,19})(?!\w)"
    r"|(?P<ssn>\d{3}-\d{2}-\d{4})(?!\w|-\d)"
    r"|(?P<date>\d{4}(?P<mark>[-/.])\d{2}(?P=mark)\d{2}|\d{2}(?P<mark2>[-/.])\d{2}(?P=mark2)\d{4})(?![\d])"
    r"|(?P<phone>(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4})(?!\w)"
    r"|(?P<iban>[A-Z]{2}\d{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?))(?!\w)"
    r")"
)
_PHONE_LEAD = re.compile(r"(?<![\w@])\+\d{1,3}[ .-]?\(?\d{3}\)?[ .-]?\d{3}[ .-]?\d{4}(?!\w)")
# Any grouping of 8 to 15 digits behind a plus sign.
_PHONE_ABROAD = re.compile(r"(?<![\w@])\+[1-9](?:[ .-]?(?:\(\d{1,4}\)|\d)){4,14}(?!\w)")
# Country codes of one and two digits; all others have three.
_COUNTRY = re.compile(r"[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3}")
_DAY_ONE, _DAY_LAST = date(1900, 1, 1).toordinal(), date(2099, 12, 31).toordinal()


def permute(key: bytes, kind: str, value: int, size: int) -> int:
    """Keyed permutation of ``0 .. size - 1``: Feistel over two near-equal digits, walked back into the domain."""
    if size < 2:
        return value
    side = isqrt(size - 1) + 1
    wide = (side.bit_length() + 64 + 7) // 8  # 64 bits more than the side has, so that the remainder is even
    while True:
        left, right = divmod(value, side)
        for turn in range(ROUNDS):
            mixed = hmac.digest(key, f"{kind}|{size}|{turn}|{right}".encode(), "sha256")
            drawn = mixed[:16] if wide <= 16 else shake_256(mixed).digest(wide)
            left, right = right, (left + int.from_bytes(drawn, "big")) % side
        value = left * side + right
        if value < size:
            return value


def _permute_where(key, kind, value, size, fits):
    """Walks on until ``fits``; a permutation of the fitting values as ``value`` itself fits."""
    while True:
        value = permute(key, kind, value, size)
        if fits(value):
            return value


def _refill(layout: str, digits: str) -> str:
    """``layout`` with its digits replaced in order."""
    rest = iter(digits)
    return "".join(next(rest) if c.isdigit() else c for c in layout)


def luhn_digit(digits: str) -> str:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (2 if k % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def _card(key, text):
    digits = re.sub(r"\D", "", text)
    if not 13 <= len(digits) <= 19 or luhn_digit(digits[:-1]) != digits[-1]:
        return None
    width = len(digits) - 2
    body = digits[0] + str(permute(key, f"card{digits[0]}", int(digits[1:-1]), 10**width)).zfill(width)
    return _refill(text, body + luhn_digit(body))


def _ip(key, text):
    parts = text.split(".")
    if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts):
        return None
    bounds = [{1: (0, 10), 2: (10, 90), 3: (100, 156)}[len(p)] for p in parts]
    value, size = 0, 1
    for p, (low, span) in zip(parts, bounds):
        value, size = value * span + int(p) - low, size * span
    shape = "".join(str(len(p)) for p in parts)
    value = permute(key, f"ip{shape}", value, size)
    out = []
    for low, span in reversed(bounds):
        value, digit = divmod(value, span)
        out.append(str(low + digit))
    return ".".join(reversed(out))


def _ssn(key, text):
    area, group, serial = text.split("-")

    def fits(v):
        a, g, s = v // 10**6, v // 10**4 % 100, v % 10**4
        return 0 < a < 900 and a != 666 and g and s

    value = int(area + group + serial)
    if not fits(value):
        return None
    return _refill(text, str(_permute_where(key, "ssn", value, 10**9, fits)).zfill(9))


def _read_date(text):
    """(order of year, month, day; the date); day first only where month first is no date."""
    numbers = [int(x) for x in re.findall(r"\d+", text)]
    orders = ("ymd",) if text[4] in "-/." else ("dmy",) if text[2] == "." else ("mdy", "dmy")
    for order in orders:
        by = dict(zip(order, numbers))
        try:
            found = date(by["y"], by["m"], by["d"])
        except ValueError:
            continue
        return (order, found) if _DAY_ONE <= found.toordinal() <= _DAY_LAST else None
    return None


def _date(key, text):
    known = _read_date(text)
    if known is None:
        return None
    order, found = known
    new = _DAY_ONE + permute(key, "date", found.toordinal() - _DAY_ONE, _DAY_LAST - _DAY_ONE + 1)
    new = date.fromordinal(new)
    if order == "dmy" and text[2] in "/-" and new.day <= 12:
        order = "mdy"  # month first is how such a date is read
    by = {"y": f"{new.year:04d}", "m": f"{new.month:02d}", "d": f"{new.day:02d}"}
    return _refill(text, "".join(by[x] for x in order))


def _phone(key, text):
    digits = re.sub(r"\D", "", text)
    if text[0] == "+" and len(digits) <= 10:
        if len(digits) < 8:
            return None
        country = _COUNTRY.match(digits)[0]
        width = len(digits) - len(country)
        new = permute(key, f"phone{country}", int(digits[len(country) :]), 10**width)
        return _refill(text, country + str(new).zfill(width))
    if len(digits) > 15:
        return None
    country, national = digits[:-10], digits[-10:]
    fits = (lambda v: v // 10**9 > 1 and v // 10**6 % 10 > 1) if national[0] > "1" and national[3] > "1" else (
        lambda v: not (v // 10**9 > 1 and v // 10**6 % 10 > 1)
    )
    new = str(_permute_where(key, "phone", int(national), 10**10, fits)).zfill(10)
    return _refill(text, country + new)


def _iban_check(country: str, body: str) -> int:
    return 98 - int("".join(str(int(c, 36)) for c in body + country + "00")) % 97


def _iban(key, text):
    plain = text.replace(" ", "")
    country, check, body = plain[:2], plain[2:4], plain[4:]
    if not 15 <= len(plain) <= 34 or int(check) != _iban_check(country, body):
        return None
    new = _by_class(key, f"iban{country}", body)
    rest = iter(country + f"{_iban_check(country, new):02d}" + new)
    return "".join(" " if c == " " else next(rest) for c in text)


def _by_class(key: bytes, kind: str, text: str) -> str:
    """Permutes digits, small and capital letters within their classes, other characters stay."""
    new, begun = [], sha256()
    for at in range(0, len(text), CHUNK):
        # The first chunk of a short text has the plain name of its kind.
        name = kind if len(text) <= CHUNK else f"{kind}{len(text)}:{at}:{begun.hexdigest()}:"
        new.append(_chunk_by_class(key, name, text[at : at + CHUNK]))
        begun.update(new[-1].encode())
    return "".join(new)


def _chunk_by_class(key: bytes, kind: str, text: str) -> str:
    classes = [(10, "0") if c.isdigit() else (26, "a") if "a" <= c <= "z" else (26, "A") if "A" <= c <= "Z" else (1, c) for c in text]
    value, size = 0, 1
    for c, (span, base) in zip(text, classes):
        value, size = value * span + ord(c) - ord(base), size * span
    shape = "".join(base for _, base in classes)
    value = permute(key, f"{kind}{shape}", value, size)
    out = []
    for span, base in reversed(classes):
        value, digit = divmod(value, span)
        out.append(chr(ord(base) + digit))
    return "".join(reversed(out))


def _email(key, text):
    """Local part and host labels change letter for letter; the last label and the signs stay."""
    local, host = text.split("@")
    labels, top = host.rsplit(".", 1)
    return _by_class(key, "email", f"{local}@{labels}") + f".{top}"


_WRITERS = {"email": _email, "phone": _phone, "card": _card, "ip": _ip, "ssn": _ssn, "iban": _iban, "date": _date}


@lru_cache(maxsize=50_000)
def pseudonym(key: bytes, kind: str, text: str) -> str | None:
    """The pseudonym, or None if the value is not valid for its kind."""
    return _WRITERS[kind](key, text)


def _free(taken: list, start: int, end: int) -> bool:
    """Whether ``start`` to ``end`` overlaps none of the spans, which are in order and apart."""
    at = bisect_left(taken, (end,))
    return not at or taken[at - 1][1] <= start


def _found(text: str) -> list[tuple[int, int, str]]:
    """Spans that look like a kind, in order and without overlap; mail addresses first."""
    spans = []
    if "@" in text:
        done = 0
        for at in _EMAIL_AT.finditer(text):
            start = at.start()
            while start > done and text[start - 1] in _LOCAL:
                start -= 1
            while start < at.start() and text[start] in ".%+-":
                start += 1
            if start < at.start():
                spans.append((start, at.end(), "email"))
            done = at.end()
    for pattern in (_NUMBER, _PHONE_LEAD):
        more = []
        for m in pattern.finditer(text):
            if _free(spans, m.start(), m.end()):
                kind = "phone" if pattern is _PHONE_LEAD else next(k for k in KINDS[1:] if m[k])
                more.append((m.start(), m.end(), kind))
        spans = sorted(spans + more)
    if "+" in text:
        ends, more = [b for _, b, _ in spans], []
        for m in _PHONE_ABROAD.finditer(text):
            # Ends before what another pattern has taken.
            after = bisect_right(ends, m.start())
            if after < len(spans) and spans[after][0] < m.end():
                m = _PHONE_ABROAD.match(text, m.start(), spans[after][0])
            if m:
                more.append((m.start(), m.end(), "phone"))
        spans = sorted(spans + more)
    return spans


_SOME = re.compile(r"[0-9@]")


def pseudonymise_text(text: str | None, key: bytes = KEY):
    """``(text, spans)``; spans are ``(start, end, kind)`` in the new text, whole and in order.  Null stays null."""
    if not text or not _SOME.search(text):
        return text, []
    parts, spans, done, shift = [], [], 0, 0
    for start, end, kind in _found(text):
        new = pseudonym(key, kind, text[start:end])
        if new is None:
            continue
        parts += [text[done:start], new]
        spans.append((start + shift, start + shift + len(new), kind))
        shift += len(new) - (end - start)
        done = end
    return "".join([*parts, text[done:]]), spans


def pseudonymise(docs: DataFrame, key: bytes = KEY, spans: str | None = "pii_spans") -> DataFrame:
    """``docs`` with ``text`` pseudonymised and, if named, a column ``spans`` of what was replaced.

    ``n_chars`` follows the new text where there is such a column.  Null text stays
    null and has no spans; all other columns, rows and repeats stay.
    """

    @F.pandas_udf("struct<text: string, spans: array<struct<start: int, stop: int, kind: string>>>")
    def run(texts):
        rows = [pseudonymise_text(None if text is None else text, key) for text in texts]
        return pd.DataFrame(
            {"text": [t for t, _ in rows], "spans": [[{"start": a, "stop": b, "kind": k} for a, b, k in s] for _, s in rows]}
        )

    # The row travels as one value, so no column of it can clash with those used here.
    row = F.struct(*[docs[c] for c in docs.columns])
    found = docs.select(row.alias("_row"), run.asNondeterministic()(docs["text"]).alias("_new"))
    own = {c: F.col("_row").getField(c) for c in docs.columns}
    if "n_chars" in own:
        length = F.length("_new.text").cast(dict(docs.dtypes)["n_chars"])
        own["n_chars"] = F.when(own["n_chars"].isNotNull(), length)
    own["text"] = F.col("_new.text")
    extra = [F.col("_new.spans").alias(spans)] if spans else []
    return found.select(*[own[c].alias(c) for c in docs.columns], *extra)
