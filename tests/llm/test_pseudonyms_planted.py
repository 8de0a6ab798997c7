"""Values of every kind and layout planted in random text: none stays in clear, nothing else changes, and layouts stay linked."""

import datetime
import random
import string

import pytest

from gridstone.llm import pseudonyms
from gridstone.llm.pseudonyms import DAY_ONE, DAYS, Feistel, check_digit, iban_number, replaced

LETTERS = "abcdefghijklmnopqrstuvwxyz"


def some(rng, alphabet, n):
    return "".join(rng.choice(alphabet) for _ in range(n))


def email(rng):
    local = rng.choice(["jürgen.x", "Анна", "李小龙99", "ÉLOÏSE", "o_ß.7", "jürgen", "عمر", "a", "x²y"]) if rng.random() < 0.6 else some(rng, LETTERS + string.digits, rng.randint(2, 20))
    return "email", local + "@" + rng.choice(["b.de", "mail.example.co.uk", "bücher.example", "x-y.org"]), None


def secret(rng):
    value = rng.choice([some(rng, "0123456789abcdef", rng.choice([32, 128, 129, 300])), "sk_live_" + some(rng, LETTERS + string.ascii_uppercase, 20) + "4x", "A1" + some(rng, string.ascii_letters + string.digits + "+/", 40) + "=="])
    name, q = rng.choice(["token", "api_key", "X-Auth-Token", "client_secret", "PASSWORD"]), rng.choice(["", '"', "'"])
    return "secret", f"{name}{rng.choice(['=', ': ', ' = '])}{q}{value}{q}", value


def date(rng):
    day = datetime.date.fromordinal(rng.choice([rng.randint(1, DAY_ONE - 1), rng.randint(DAY_ONE, DAY_ONE + DAYS - 1), rng.randint(DAY_ONE + DAYS, datetime.date.max.toordinal())]))
    return "date", rng.choice(["{0:04d}-{1:02d}-{2:02d}", "{0:04d}/{1:02d}/{2:02d}", "{2:02d}/{1:02d}/{0:04d}", "{2:02d}.{1:02d}.{0:04d}"]).format(day.year, day.month, day.day), None


def phone(rng):
    a, b, c = f"{rng.randint(200, 999)}", f"{rng.randint(200, 999)}", f"{rng.randint(0, 9999):04d}"
    layouts = ["1-{a}-{b}-{c}", "{a} {b} {c}", "1 {a} {b} {c}", "1.{a}.{b}.{c}", "{a}-{b}-{c}", "{a}.{b}.{c}", "({a}) {b}-{c}", "+1 {a} {b} {c}", "+1 ({a}) {b}-{c}", "+49 (0)30 12{c}", "+44 (0) {a} {b} {c}", "+49 30 12{c}"]
    return "phone", rng.choice(layouts).format(a=a, b=b, c=c), None


def card(rng):
    number = "4" + some(rng, string.digits, 14)
    number += check_digit(number)
    return "card", rng.choice(["", " ", "-"]).join(number[i : i + 4] for i in range(0, 16, 4)), None


def iban(rng):
    account = "WEST" + some(rng, string.digits, 14)
    whole = f"GB{98 - iban_number('GB00', account) % 97:02d}{account}"
    return "iban", rng.choice(["", " "]).join(whole[i : i + 4] for i in range(0, len(whole), 4)), None


def address(rng):
    return "ip", ".".join(str(rng.randint(0, 255)) for _ in range(4)), None


def social(rng):
    return "ssn", f"{rng.randint(100, 665)}-{rng.randint(10, 99)}-{rng.randint(1000, 9999)}", None


def shape(value):
    return "".join("a" if c.isalnum() else c for c in value)


@pytest.mark.parametrize("seed", range(8))
def test_nothing_planted_stays(spark, seed):
    rng, rows = random.Random(seed), []
    for i in range(60):
        words = [[some(rng, LETTERS, rng.randint(1, 9)) for _ in range(rng.randint(0, 8))] for _ in range(6)]
        planted = [rng.choice([email, secret, date, phone, card, iban, address, social])(rng) for _ in range(5)]
        text = "".join(" ".join(w) + f"\t<{p[1]}>\t" for w, p in zip(words, planted, strict=False)) + " ".join(words[5])
        rows.append((i, text, planted, words))
    out = {r.doc_id: r for r in pseudonyms.pseudonymised(spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"), b"k").collect()}
    for i, text, planted, words in rows:
        new = out[i].text
        want = {k: sum(p[0] == k for p in planted) for k in pseudonyms.KINDS}
        assert {k: out[i][f"n_{k}"] for k in pseudonyms.KINDS} == want, text
        pieces = new.split("\t")
        assert pieces[::2] == [" ".join(w) for w in words]
        for (kind, value, inner), piece in zip(planted, pieces[1::2], strict=True):
            hidden = inner or ("<" + value.split("@")[0] + "@" if kind == "email" else value)
            assert hidden not in piece, (kind, value, piece)
            if kind != "ip":  # the octets of an address have one to three digits
                assert shape(piece[1:-1]) == shape(value)


def test_layouts_of_a_number_are_linked():
    f, digits = Feistel(b"k"), lambda v: "".join(c for c in replaced(v, Feistel(b"k"))[0] if c.isdigit())
    forms = ["1-555-223-4567", "555 223 4567", "1 555 223 4567", "555-223-4567", "+1 555 223 4567", "(555) 223-4567"]
    assert len({digits(x)[-10:] for x in forms}) == 1 and digits(forms[0])[0] == "1"
    assert digits("+49 (0)30 123456") == "490" + digits("+49 30 123456")[2:]
    assert replaced("key: 4111111111111111", f)[0][5:] == replaced("4111111111111111", f)[0]
    assert replaced("key=GB82WEST12345698765432", f) == ("key=" + replaced("GB82WEST12345698765432", f)[0], {"iban": 1})
    assert replaced("auth=10.0.0.25/10.0.0.26/10.0.0.27", f)[1] == {"ip": 3}
    x = "0123456789abcdef" * 2
    assert replaced(f"token={x}", f)[0][6:] == replaced(f"token = '{x}'", f)[0][9:-1]


def test_look_alikes_stay():
    for text in ("100 200 3000", "12 555 223 4567", "555 123 4567 89 12", "password: internationalisation", "the key: a-plain-hyphenated-word", "tokens: 12345678901234567890", "a @ b.de", "1850-13-05", "0000-01-01", "2-555-223-4567"):
        assert replaced(text, Feistel(b"k")) == (text, {}), text


def test_days_are_permuted():
    f, days = Feistel(b"k"), [datetime.date(y, 3, 1) for y in range(1, 10000, 7)]
    new = [pseudonyms.pseudonym("date", d.isoformat(), f) for d in days]
    assert len(set(new)) == len(days) and all(a != d.isoformat() for a, d in zip(new, days, strict=True))
    assert all((1900 <= d.year < 2100) == (1900 <= int(a[:4]) < 2100) for a, d in zip(new, days, strict=True))


def test_long_secrets_end_quickly():
    value = "a1" * 500_000
    new, found = replaced(f"token = '{value}'", Feistel(b"k"))
    assert found == {"secret": 1} and len(new) == len(value) + 10 and value[:64] not in new
