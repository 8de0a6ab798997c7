"""Personal data: format-preserving Feistel pseudonyms.

Numbers and dates are found by pattern, validated (check digits, issuer prefixes, octets, calendar), and permuted within their format under a
key: the pseudonym of a card number is a card number of the same issuer digit and layout with a right check digit, that of a date is a date. The
permutation is a Feistel network over digit strings with a keyed hash as its round function, walked until the result is in the format again. It's a
permutation, so equal values get equal pseudonyms in every document, and different ones different pseudonyms. Strings that look alike but
don't validate stay. Which texts are scanned is decided by a wider pattern, which every text with a value matches.

Kinds: e-mail addresses (their local part), payment cards, IBANs, IPv4 addresses, telephone numbers, US social security numbers, dates
(year-month-day, and day or month first with four-digit years; every day of the years 1 to 9999), and secrets assigned to a name: hexadecimal ones of 32 digits or more
in quotes (``token = "..."``), and others of 20 or more letters, digits and ``_+/.=~-`` with a letter and a digit, quoted or not (``api_key: sk_live_...``).

What stays in clear: dates with two-digit years, without leading zeros or with names of months; telephone numbers of fewer than eight digits, or in layouts other than those below;
secrets that no name such as token, secret, key, password or auth stands before, that are shorter, or that have no digit or no letter; the domain of an e-mail address, local parts in quotes or with
other signs than ``._%+-`` (only what follows such a sign is replaced), and combining marks, numerals that aren't decimal digits and letters alone in their script's alphabet of one; names, streets and other free text.

Nulls: a null text stays null and has nothing found; other columns are carried along whatever their names, except that results replace
columns of their own names. Repeated rows are treated alike. An empty table gives an empty result. Very long texts are scanned whole, by patterns
that don't backtrack over more than a value's length. No part of a value that has letters or digits to change comes back unchanged; a single one is moved by a keyed step.

Telephone numbers are found with an area code in brackets, in groups of three, three and four digits with hyphens or points between, or with spaces where the area code and the next
group begin with 2 to 9, after a leading 1, or after a plus sign, with or without a (0) after the country code. Validation of telephone numbers is by their length (and, with spaces, these digits) only.
"""

from __future__ import annotations

import datetime
import hashlib
import re
import sys
import unicodedata
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

ROUNDS = 8
#: The key of the registered query, for reproducible results; a real run passes its own secret.
QUERY_KEY = b"not a secret: the registered query's key"
KINDS = ("email", "secret", "iban", "ip", "date", "ssn", "phone", "card")
#: The two centuries from DAY_ONE on are permuted among themselves, and all other days of the calendar (years 1 to 9999) among themselves.
DAY_ONE, DAYS, ALL_DAYS = datetime.date(1900, 1, 1).toordinal(), 73_049, datetime.date.max.toordinal()
#: Secrets are permuted in blocks of so many symbols.
BLOCK = 128

PATTERN = re.compile(
    r"""(?P<email>(?<![\w\u0300-\u036f.%+-])\w[\w\u0300-\u036f.%+-]{0,127}@(?:[\w\u0300-\u036f-]{1,63}\.){1,8}[^\W\d_]{2,24}(?![\w-]))
    |(?P<assigned>(?:[Tt][Oo][Kk][Ee][Nn]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Kk][Ee][Yy]|[Pp][Aa][Ss][Ss][Ww][Oo]?[Rr]?[Dd]|[Pp][Ww][Dd]|[Aa][Uu][Tt][Hh])\w{0,20}["']?\s{0,3}[=:]\s{0,3}["']?(?P<assignee>[A-Za-z0-9_+/.=~-]{20,}+)(?!@))
    |(?P<secret>(?<=["'])[0-9A-Fa-f]{32,}+(?=["']))
    |(?P<iban>(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?:\ ?[A-Z0-9]{4}){2,7}(?:\ ?[A-Z0-9]{1,3})?(?![A-Za-z0-9]))
    |(?P<ip>(?<![\d.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?![\d]|\.\d))
    |(?P<date>(?<![\d.\-/])(?:\d{4}-\d\d-\d\d|\d{4}/\d\d/\d\d|\d\d/\d\d/\d{4}|\d\d\.\d\d\.\d{4})(?![\d\-/]))
    |(?P<ssn>(?<![\d-])\d{3}-\d\d-\d{4}(?![\d-]))
    |(?P<phone>(?<![\d+.-])(?<!\d[ ])1[ .-]\d{3}[ .-]\d{3}[ .-]\d{4}(?![\d-]|[ .]\d)|(?<![\d+.-])(?<!\d[ ])[2-9]\d\d[ ][2-9]\d\d[ ]\d{4}(?![\d-]|[ .]\d)|(?<![\d+])\+\d{1,3}[ .-]?\(0\)(?:[ .-]?\d{2,4}){2,5}(?!\d)|(?<![\d+])(?:\+\d{1,3}[ .-]?)?\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}(?!\d)|(?<![\d+.-])\d{3}-\d{3}-\d{4}(?![\d-])|(?<![\d+.-])\d{3}\.\d{3}\.\d{4}(?![\d.])|(?<![\d+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?!\d))
    |(?P<card>(?<![\d.-])\d(?:[ -]?\d){12,18}(?![\d]|[.-]\d))""",
    re.VERBOSE,
)
#: In every text that PATTERN matches, in Arrow's RE2, kind by kind: an e-mail address has @; a secret 32 hexadecimal digits; an IBAN its country,
#: check digits and first group; an IP address digit, point, digit; a date, an SSN and a phone number without + four digits in
#: a row; any other phone number + and a digit; an assigned secret a name and = or : soon after; a card 13 digits with at most one space or hyphen between two. \d in PATTERN is any script's digit (Nd).
ANY_VALUE = r"@|[0-9A-Fa-f]{32}|[A-Z]{2}\p{Nd}{2} ?[A-Z0-9]{4}|\p{Nd}\.\p{Nd}|\p{Nd}{4}|\+\p{Nd}|\p{Nd}(?:[ -]?\p{Nd}){12}|(?i:token|secret|key|passw|pwd|auth)[^=:]{0,30}[=:]"
#: PATTERN without its first three kinds.
OTHER = re.compile(PATTERN.pattern[PATTERN.pattern.index("(?P<iban>") :], re.VERBOSE)
NEAR_SECRET = re.compile(r"(?i)(?:token|secret|key|password|passwd|pwd|auth)\w{0,20}\s{0,3}[=:]\s{0,3}[\"']$")


DIGITS, ASCII_LETTERS = "0123456789", "abcdefghijklmnopqrstuvwxyz"


class Feistel:
    """Keyed permutations of digit strings in any radix up to 36."""

    def __init__(self, key: bytes, rounds: int = ROUNDS):
        self.key, self.rounds = hashlib.blake2b(key, digest_size=32).digest(), rounds

    def number(self, x: int, tweak: str, radix: int, digits: int) -> int:
        """A permutation of 0 .. radix**digits - 1 that leaves nothing where it is, another one for each tweak, radix and number of digits.

        The network puts the numbers in a keyed order, and each goes to the next one in it: one cycle through all of them. A single digit moves by a keyed step.
        """
        low = digits // 2
        a_size, b_size = radix ** (digits - low), radix**low
        head = f"{tweak}/{radix}/{digits}/".encode()

        def f(i: int, half: int) -> int:
            return int.from_bytes(hashlib.blake2b(head + b"%d/%d" % (i, half), key=self.key, digest_size=32).digest(), "big")

        if low == 0:
            return (x + 1 + f(0, 0) % (a_size - 1)) % a_size
        a, b = divmod(x, b_size)
        for i in range(0, self.rounds, 2):
            a = (a + f(i, b)) % a_size
            b = (b + f(i + 1, a)) % b_size
        a, b = divmod((a * b_size + b + 1) % (a_size * b_size), b_size)
        for i in reversed(range(0, self.rounds, 2)):
            b = (b - f(i + 1, a)) % b_size
            a = (a - f(i, b)) % a_size
        return a * b_size + b

    def below(self, x: int, n: int, tweak: str) -> int:
        """A permutation of 0 .. n - 1: the one of enough digits, walked until it comes back below n."""
        digits = max(2, len(str(n - 1)))
        while True:
            x = self.number(x, tweak, 10, digits)
            if x < n:
                return x

    def string(self, s: str, tweak: str, alphabet: str = "0123456789") -> str:
        if not s:
            return s
        radix, x = len(alphabet), 0
        for c in s:
            x = x * radix + alphabet.index(c)
        x, out = self.number(x, tweak, radix, len(s)), []
        for _ in s:
            x, d = divmod(x, radix)
            out.append(alphabet[d])
        return "".join(reversed(out))


def check_digit(payload: str) -> str:
    total = sum(d if i % 2 else d * 2 - 9 * (d > 4) for i, d in enumerate(int(c) for c in reversed(payload)))
    return str(-total % 10)


def issued(number: str) -> bool:
    """Whether a number has an issuer's prefix and one of its lengths (fixed values)."""
    n, two, three, four = len(number), int(number[:2]), int(number[:3]), int(number[:4])
    return (
        (number[0] == "4" and n in (13, 16, 19))
        or (n == 16 and (51 <= two <= 55 or 2221 <= four <= 2720))
        or (n == 15 and two in (34, 37))
        or (16 <= n <= 19 and (four == 6011 or 644 <= three <= 649 or two in (62, 65) or 3528 <= four <= 3589))
        or (14 <= n <= 19 and (300 <= three <= 305 or two in (36, 38, 39)))
    )


def country_code(digits: str) -> str:
    """The calling code that an international number begins with: 1 and 7 stand alone, the others listed have two digits, the rest three (fixed values)."""
    two = "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split()
    return digits[: 1 if digits[0] in "17" else 2 if digits[:2] in two else 3]


def iban_number(country_check: str, account: str) -> int:
    return int("".join(str(int(c, 36)) for c in account + country_check))


def laid_out(shape: str, symbols: str) -> str:
    """shape with its letters and digits replaced in turn."""
    it = iter(symbols)
    return "".join(next(it) if c.isalnum() else c for c in shape)


def blocks(s: str, tweak: str, alphabet: str, feistel: Feistel) -> str:
    """s permuted block by block, as a number of all its digits would cost time with their square."""
    return "".join(feistel.string(s[i : i + BLOCK], f"{tweak}/{i}" if i else tweak, alphabet) for i in range(0, len(s), BLOCK))


def small(c: str) -> str:
    """The lower case of a letter if it's one letter that leads back."""
    low = c.lower()
    return low if len(low) == 1 and low.upper() == c else c


def script(c: str) -> str:
    """The first word of a letter's name, which tells its script."""
    return unicodedata.name(c, "OTHER").split()[0]


@cache
def letters_of(name: str) -> str:
    """The letters beyond ASCII of a script, without capitals, in the order of their codes; scripts of fewer than ten such letters share one alphabet, named OTHER."""
    found: dict[str, list[str]] = {}
    for code in range(128, sys.maxunicode + 1):
        c = chr(code)
        if c.isalpha() and small(c) == c:
            found.setdefault(script(c), []).append(c)
    if name != "OTHER":
        return "".join(found.get(name, ())) if len(found.get(name, ())) >= 10 else ""
    return "".join(sorted(c for n, x in found.items() if len(x) < 10 or n == "OTHER" for c in x))


def local_part(local: str, domain: str, feistel: Feistel) -> str:
    """The local part with its letters permuted script by script, and its digits; signs stay."""
    classes: list[str] = []
    for c in local:
        if c in DIGITS:
            classes.append("0")
        elif c.isascii() and c.isalpha():
            classes.append("a")
        elif c.isalpha():
            classes.append(script(c) if letters_of(script(c)) else "OTHER")
        else:
            classes.append("")
    new = {}
    for k in set(classes) - {""}:
        alphabet = DIGITS if k == "0" else ASCII_LETTERS if k == "a" else letters_of(k)
        new[k] = iter(feistel.string("".join(c if k == "0" else small(c) for c, of in zip(local, classes, strict=True) if of == k), f"email/{domain}/{k}", alphabet))
    out = []
    for c, k in zip(local, classes, strict=True):
        x = next(new[k]) if k else c
        out.append(x.upper() if k and small(c) != c and small(x.upper()) == x else x)
    return "".join(out)


def pseudonym(kind: str, value: str, feistel: Feistel) -> str | None:
    """The pseudonym of a value, or None if it doesn't validate. Digits of any script count as the same ones of ASCII, which the pseudonym has."""
    if not value.isascii():
        value = "".join(str(int(c)) if c.isdecimal() else c for c in value)
    digits = "".join(c for c in value if c in DIGITS)
    if kind == "card":
        if not issued(digits) or check_digit(digits[:-1]) != digits[-1]:
            return None
        keep = 1 if digits[0] == "4" else 4
        payload = digits[:keep] + feistel.string(digits[keep:-1], f"card/{digits[:keep]}")
        return laid_out(value, payload + check_digit(payload))
    if kind == "phone":
        if len(digits) < 8:
            return None
        # all layouts of a number, with its country code or (in the North American plan) without, share one permutation of what follows the code
        at = value.find("(0)")
        if at >= 0:  # the zero dialled at home is no part of the number
            value, digits = value.replace("(0)", "(\0)"), "".join(c for c in value[:at] + value[at + 3 :] if c.isdigit())
        code = country_code(digits) if value[0] == "+" else "1" if len(digits) == 11 and value[0] == "1" else ""
        own = feistel.string(digits[len(code) :], f"phone/{code or 1}")
        return laid_out(value, code + own).replace("\0", "0")
    if kind == "ip":
        octets = [int(x) for x in value.split(".")]
        if max(octets) > 255 or any(len(x) > 1 and x[0] == "0" for x in value.split(".")):
            return None
        x = feistel.number(int.from_bytes(bytes(octets), "big"), "ip", 256, 4)
        return ".".join(map(str, x.to_bytes(4, "big")))
    if kind == "ssn":
        valid = lambda s: s[:3] not in ("000", "666") and s[0] != "9" and s[3:5] != "00" and s[5:] != "0000"
        if not valid(digits):
            return None
        digits = feistel.string(digits, "ssn")
        while not valid(digits):
            digits = feistel.string(digits, "ssn")
        return laid_out(value, digits)
    if kind == "date":
        parts = re.split(r"[-/.]", value)
        for order in [(0, 1, 2)] if len(parts[0]) == 4 else [(2, 1, 0), (2, 0, 1)]:  # day first where both are possible
            try:
                day = datetime.date(*(int(parts[i]) for i in order)).toordinal() - DAY_ONE
            except ValueError:
                continue
            # all layouts of a date share one permutation, so that they stay linked
            if 0 <= day < DAYS:
                new = datetime.date.fromordinal(DAY_ONE + feistel.below(day, DAYS, "date"))
            else:  # ordinals without the two centuries, from 0
                x = feistel.below(day + DAY_ONE - 1 if day < 0 else day + DAY_ONE - 1 - DAYS, ALL_DAYS - DAYS, "date/other")
                new = datetime.date.fromordinal(x + 1 if x + 1 < DAY_ONE else x + 1 + DAYS)
            field = {0: f"{new.year:04d}", 1: f"{new.month:02d}", 2: f"{new.day:02d}"}
            return laid_out(value, "".join(field[order.index(i)] for i in range(3)))
        return None
    if kind == "iban":
        flat = value.replace(" ", "")
        if not 15 <= len(flat) <= 34 or iban_number(flat[:4], flat[4:]) % 97 != 1:
            return None
        letters, alphabet = [c for c in flat[4:] if c.isalpha()], "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
        own = iter(feistel.string("".join(c for c in flat[4:] if c.isdigit()), f"iban/{flat[:2]}"))
        named = iter(feistel.string("".join(letters), f"iban/{flat[:2]}/a", alphabet))
        account = "".join(next(own) if c.isdigit() else next(named) for c in flat[4:])
        return laid_out(value, f"{flat[:2]}{98 - iban_number(flat[:2] + '00', account) % 97:02d}{account}")
    if kind == "secret":
        new = blocks(value.lower(), "secret", "0123456789abcdef", feistel)
        return new.upper() if value.isupper() else new
    if kind == "assigned":
        if not any(c.isdigit() for c in value) or not any(c.isalpha() for c in value):
            return None
        letters = iter(blocks("".join(c for c in value.lower() if c.isalpha()), "secret/a", ASCII_LETTERS, feistel))
        own = iter(blocks(digits, "secret/0", "0123456789", feistel))
        return "".join((next(letters).upper() if c.isupper() else next(letters)) if c.isalpha() else next(own) if c.isdigit() else c for c in value)
    if kind == "email":
        local, domain = value.rsplit("@", 1)
        return f"{local_part(local, domain.lower(), feistel)}@{domain}"
    raise ValueError(kind)


def replaced(text: str, feistel: Feistel) -> tuple[str, dict[str, int]]:
    """text with its validated values replaced, and how many of each kind there were."""
    found: dict[str, int] = {}

    def one(m: re.Match) -> str:
        kind = m.lastgroup
        if kind == "secret" and not NEAR_SECRET.search(text, max(0, m.start() - 40), m.start()):
            return m[0]
        if kind == "assigned":
            value, kind = m["assignee"], "secret"
            whole = OTHER.fullmatch(value)  # a value of another kind that stands after such a name stays linked to its like
            new = pseudonym(whole.lastgroup, value, feistel) if whole else None
            if new is not None:
                kind = whole.lastgroup
            else:
                new = pseudonym("secret" if len(value) >= 32 and not value.strip("0123456789abcdefABCDEF") else "assigned", value, feistel)
            if new is None:
                new = OTHER.sub(one, value)
                return m[0][: m.start("assignee") - m.start()] + new
            new = m[0][: m.start("assignee") - m.start()] + new
        else:
            new = pseudonym(kind, m[0], feistel)
        if new is None:
            return m[0]
        found[kind] = found.get(kind, 0) + 1
        return new

    return PATTERN.sub(one, text), found


def pseudonymised(docs: DataFrame, key: bytes) -> DataFrame:
    """docs with the text's values replaced, and n_email, n_card and so on: how many were replaced."""
    carried = [c for c in docs.columns if c not in ("text", *(f"n_{k}" for k in KINDS))]
    schema = docs.select(*carried, "text").schema
    for k in KINDS:
        schema = schema.add(f"n_{k}", "long")

    def run(batches):
        feistel = Feistel(key)
        for b in batches:
            texts = b.column("text")
            # only texts that can have a value are looked at one by one
            some = pa.compute.fill_null(pa.compute.match_substring_regex(texts, ANY_VALUE), False)
            at = pa.compute.indices_nonzero(some).to_pylist()
            new, counts = [], {k: [0] * len(b) for k in KINDS}
            for i, text in zip(at, texts.take(pa.array(at, pa.int64())).to_pylist(), strict=True):
                text, found = replaced(text, feistel)
                new.append(text)
                for k, n in found.items():
                    counts[k][i] = n
            if at:
                texts = pa.compute.replace_with_mask(texts, some, pa.array(new, texts.type))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in carried), texts, *(pa.array(counts[k], pa.int64()) for k in KINDS)], [*carried, "text", *(f"n_{k}" for k in KINDS)])

    return docs.select(*carried, "text").mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymised(table(spark, sf_dir, "documents").select("doc_id", "text"), QUERY_KEY)
