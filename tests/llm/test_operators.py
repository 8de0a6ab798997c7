"""Each operator against a brute-force version on a small corpus with nulls, empty, long, tied and repeated texts and odd columns."""

import collections
import hashlib
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from gridstone.llm import best_fit, chat_format, decontaminate, jaccard_join, lattice_lm, line_dedup, pseudonyms, quality_rules, substring_dedup, suffix_dedup
from gridstone.llm.common import components

SCHEMA = "doc_id long, text string, row_ string, drop_ long, n_deleted long, c long"


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "").encode().split()


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(7)
    vocabulary = [f"w{i}é" if i % 7 == 0 else f"W{i}" for i in range(400)]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    base, passage, item = say(120), say(70), say(30)
    texts = [None, "", "  \n\t", "one", "one", "a b c d", "aaaa " * 200, "x" * 900, base, base, base + " End", base.replace("W3 ", "W4 ", 1), say(3000)]
    texts += [f"{say(40)} {passage} {say(30)}" for _ in range(5)] + [f"{say(60)}\x0b{item} {say(5)} {say(60)}", f"{say(50)} {re.sub('[a-z]+', lambda m: m[0].upper(), item)} {say(50)}"]
    texts += ["\n".join([say(6), "L1", "L2", "L3", say(5)]) for _ in range(3)] + ["L1\nL2\nL3\nL1\nL2\nL3", "### $$$ %%% " * 30]
    rows = [(i * 3 + 1, t, f"r{i}", i, None, i) for i, t in enumerate(texts)]
    return [*rows, rows[8], (None, base, None, None, None, None)], item


@pytest.fixture(scope="module")
def docs(spark, corpus):
    return spark.createDataFrame(corpus[0], SCHEMA).repartition(3).cache()


def texts_of(corpus):
    return sorted({(r[0], r[1]) for r in corpus[0] if r[0] is not None}, key=lambda r: r[0])


def test_jaccard_join(docs, corpus):
    sets = {}
    for i, t in texts_of(corpus):
        w = lower(t)
        sets[i] = {tuple(w[j : j + 5]) for j in range(len(w) - 4)} or ({tuple(w)} if w else set())
    linked = {i: {j for j in sets if j != i and sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])} for i in sets}
    component = {i: i for i in sets}
    for _ in sets:
        component = {i: min([component[i], *(component[j] for j in linked[i])]) for i in sets}
    got = {(r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in jaccard_join.near_duplicates(docs, count_links=True).collect() if r.doc_id is not None}
    assert got == {(i, len(s), component[i], len(linked[i])) for i, s in sets.items()}
    plain = jaccard_join.near_duplicates(docs)
    assert plain.columns == ["doc_id", "n_shingles", "component_id"] and {tuple(r) for r in plain.collect() if r.doc_id is not None} == {x[:3] for x in got}
    kept = jaccard_join.one_of_each(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {None, *component.values()}


def test_jaccard_join_of_slices_without_shingles(spark):
    rows = [(1, None), (2, "")]
    assert sorted(map(tuple, jaccard_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect())) == [(1, 0, 1), (2, 0, 2)]
    rows += [(3, "a b c d e f g"), (4, "a b c d e f g"), (5, " \n")]
    got = jaccard_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartitionByRange(5, "doc_id"))
    assert sorted(map(tuple, got.collect())) == [(1, 0, 1), (2, 0, 2), (3, 3, 3), (4, 3, 3), (5, 0, 5)]


def test_jaccard_join_of_large_groups(spark, monkeypatch):
    """Near copies of near copies, a passage in every text and copies of all kinds, on many partitions, with salted shingles."""
    monkeypatch.setattr(jaccard_join, "SALTED", 8)
    rng = random.Random(2)
    say = lambda n: [f"w{rng.randrange(50_000)}" for _ in range(n)]
    passage, texts = say(30), []
    for size in (60, 8, 3, 1):
        chain = say(80)
        for _ in range(size):
            chain = list(chain)
            chain[rng.randrange(len(chain))] = f"x{rng.randrange(50_000)}"
            texts.append(chain + passage)
    texts += [passage + say(n % 9) for n in range(40)] + [texts[5]] * 20 + [say(4)] * 3
    rows = [(i * 7 % 997, " ".join(w)) for i, w in enumerate(texts)]
    sets = {i: {tuple(w[j : j + 5]) for j in range(len(w) - 4)} or {tuple(w)} for i, w in ((i, t.split()) for i, t in rows)}
    component = {i: i for i in sets}
    while True:
        new = {i: min(component[j] for j in sets if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])) for i in sets}
        if new == component:
            break
        component = new
    got = jaccard_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(7))
    assert {tuple(r) for r in got.collect()} == {(i, len(s), component[i]) for i, s in sets.items()}


def test_decontamination(spark, docs, corpus):
    bench = spark.createDataFrame([(5, corpus[1]), (6, None), (None, corpus[1]), (7, "one")], "item_id long, text string")
    got = {r.doc_id: r["items"] for r in decontaminate.leaking(docs, bench).collect()}
    held = {i for i, t in texts_of(corpus) if b" ".join(lower(corpus[1])) in b" ".join(lower(t))}
    ones = {i for i, t in texts_of(corpus) if b"one" in lower(t)}
    assert {i for i, x in got.items() if 5 in x} == held and {i for i, x in got.items() if 7 in x} == ones
    assert {r.doc_id for r in decontaminate.clean(docs, bench).collect()} == {r[0] for r in corpus[0]} - set(got)
    assert decontaminate.leaking(docs, bench.limit(0)).count() == 0


def test_simhash_blocks_find_all_within_the_radius():
    rng = random.Random(1)
    width = 64 // decontaminate.BLOCKS
    for _ in range(200):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), decontaminate.RADIUS):
            b ^= 1 << bit
        assert any(bin((a ^ b) >> width * i & (1 << width) - 1).count("1") <= 1 for i in range(decontaminate.BLOCKS))


def test_substring_dedup(docs, corpus):
    seen, want = {}, {}
    for i, t in texts_of(corpus):
        w = (t or "").encode().split()
        drop = [False] * len(w)
        for j in range(len(w) - 19):
            if tuple(w[j : j + 20]) in seen:
                drop[j : j + 20] = [True] * 20
            seen.setdefault(tuple(w[j : j + 20]), i)
        want[i] = (len(w), sum(drop), b" ".join(x for x, d in zip(w, drop) if not d).decode())
    got = substring_dedup.kept_words(docs, substring_dedup.factors(docs)).collect()
    assert len(got) == docs.count()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in got if r.doc_id is not None} == want
    assert [r.n_removed for r in got if r.doc_id is None] == [0]


def test_suffix_dedup(docs, corpus):
    count, want = collections.Counter(), {}
    for _, t in texts_of(corpus):
        b = (t or "").encode()
        count.update(b[j : j + 400] for j in range(len(b) - 399))
    for i, t in texts_of(corpus):
        b = (t or "").encode()
        drop = bytearray(len(b))
        for j in range(len(b) - 399):
            if count[b[j : j + 400]] > 1:
                drop[j : j + 400] = b"\1" * 400
        want[i] = (len(b), sum(drop), len(re.findall(b"\1+", bytes(drop))), bytes(x for x, d in zip(b, drop) if not d))
    got = suffix_dedup.kept_bytes(docs, suffix_dedup.repeated_ranges(docs)).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got if r.doc_id is not None} == want


def test_suffix_dedup_of_a_passage_in_a_third_of_all_documents(spark):
    """The rows don't depend on which documents share a slice, and equal brute force; whole copies and repeats within a document included."""
    rng = random.Random(5)
    say = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    passage, n = say(700), 400
    texts = [say(300) + (passage if i % 3 == 0 else "") + say(300) for i in range(45)] + [passage + passage[:450], passage, passage, None, ""]
    data = [(i, x) for i, x in enumerate(texts)]
    raw = [(x or "").encode() for x in texts]
    where = {}
    for i, b in enumerate(raw):
        for at in range(len(b) - n + 1):
            where.setdefault(b[at : at + n], []).append((i, at))
    gone = {i: set() for i in range(len(raw))}
    for places in where.values():
        for i, at in places if len(places) > 1 else ():
            gone[i].update(range(at, at + n))
    expected = [(i, len(gone[i]), bytes(c for at, c in enumerate(b) if at not in gone[i])) for i, b in enumerate(raw)]
    for parts in (1, 5, 25):
        docs = spark.createDataFrame(data, "doc_id long, text string").repartition(parts)
        got = suffix_dedup.kept_bytes(docs, suffix_dedup.repeated_ranges(docs)).collect()
        assert sorted((r.doc_id, r.n_removed, bytes(r.kept)) for r in got) == expected


def test_different_windows_of_one_gram_are_told_apart(spark):
    """Windows of 400 bytes and of 20 words that share the gram they meet by and whose hashes agree in the upper 32 bits. No two are equal, so nothing goes."""
    rng = random.Random(3)
    head, words = "".join(rng.choice("abcdefgh") for _ in range(392)), " ".join(f"w{i}" for i in range(19))
    ends = [377462, 395589, 121139, 198143, 15671, 35572]
    docs = spark.createDataFrame([(i, f"{head}{x:08d}") for i, x in enumerate(ends)], "doc_id long, text string").repartition(3)
    got = suffix_dedup.kept_bytes(docs, suffix_dedup.repeated_ranges(docs)).collect()
    assert [r.n_removed for r in got] == [0] * len(ends)
    ends = [282313, 285567, 184917, 365213, 226170, 256461]
    docs = spark.createDataFrame([(i, f"{words} {x}") for i, x in enumerate(ends)], "doc_id long, text string").repartition(3)
    got = substring_dedup.kept_words(docs, substring_dedup.factors(docs)).collect()
    assert [r.n_removed for r in got] == [0] * len(ends)


def test_line_dedup(docs, corpus):
    run, seen, want = line_dedup.RUN_LINES, {}, {}
    for i, t in texts_of(corpus):
        x = (t or "").split("\n")
        drop = set()
        for j in range(len(x) - run + 1):
            if seen.setdefault(tuple(x[j : j + run]), (i, j)) != (i, j):
                drop |= set(range(j, j + run))
        want[i] = None if t is None else "\n".join(y for j, y in enumerate(x) if j not in drop)
    out = line_dedup.dedup_lines(docs)
    assert out.columns == docs.columns
    assert {r.doc_id: r.text for r in out.collect() if r.doc_id is not None} == want


def test_line_dedup_of_long_short_runs(spark, docs, corpus):
    say = lambda k, n: " ".join(f"v{k}x{i}" for i in range(n))
    long, half, other, chars, short = say(1, 60), say(2, 30), say(3, 30), "\u5b57" * 400, say(4, 49)
    texts = [long, long, f"{half}\n{other}", f"{half}\n{other}\n{say(5, 9)}", f"{other}\n{half}", f"a\n{chars}", f"b\n{chars}\nc\nd", short, short, f"{long}\n{long}", f"{long}\nx\n{half}\n{other}\ny"]
    rows = [*((i, t) for i, t in enumerate(texts, 1000)), *texts_of(corpus)]
    run, seen, want = line_dedup.RUN_LINES, {}, {}
    for i, t in sorted(rows):
        x = (t or "").split("\n")
        drop = set()
        for n in range(1, run + 1):
            for j in range(len(x) - n + 1):
                passage = tuple(x[j : j + n])
                if n < run and sum(len(y.split()) for y in passage) < 50 and sum(map(len, passage)) < 400:
                    continue
                if seen.setdefault(passage, (i, j)) != (i, j):
                    drop |= set(range(j, j + n))
        want[i] = None if t is None else "\n".join(y for j, y in enumerate(x) if j not in drop)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(frame, long=line_dedup.LONG).collect()}
    assert got == want
    assert got[1001] == got[1009] == "" and got[1003] == say(5, 9) and got[1004] == f"{other}\n{half}" and got[1006] == "b\nc\nd" and got[1008] == short and got[1010] == "x\ny"


def test_quality_rules(docs, corpus):
    got = {r.doc_id: r for r in quality_rules.judged(docs).collect()}
    for i, t in texts_of(corpus):
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        c = collections.Counter(zip(w, w[1:], w[2:]))
        repeated = {j + k for j in range(len(w) - 2) if c[w[j], w[j + 1], w[j + 2]] > 1 for k in range(3)}
        lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(repeated))
        assert r.base_failed == (len(w) < 50 or 100 * len(repeated) > 50 * len(w)) and not (r.kept and r.base_failed)
    assert quality_rules.keep_quality(docs).columns == docs.columns
    a, b = quality_rules.judged(docs, quality_rules.RULES), quality_rules.judged(docs, quality_rules.RULES[::-1])
    assert a.select("doc_id", "kept").exceptAll(b.select("doc_id", "kept")).count() == 0


def test_chat_round_trip(spark):
    said = ["</s>[INST] ok [/INST]", "[\\INST] <\\\\s> [/ROLE", "plain", "", None, "a\n[ROLE]x[/ROLE]", "\\", "[[INST]]", "<s"]
    rows = [(k, i, role, text) for k, role in enumerate(["user", "assistant", "system", "tool", "[INST]", None]) for i, text in enumerate(said)]
    rows += [(50, 1, "user", "tie"), (50, 1, "user", "tie"), (None, 0, "user", "x")]
    conv = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    formatted = chat_format.format_conversations(conv)
    assert formatted.where("not round_trip").count() == 0
    back = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in formatted.withColumn("turns", chat_format.parsed(F.col("formatted"))).collect()}
    for k in {r[0] for r in rows}:
        assert back[k] == [(role or "", text or "") for c, _, role, text in rows if c == k]


def test_packing(docs, corpus):
    from tokenizers import Tokenizer

    import public_tokenizers

    tk = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tk.encode_special_tokens = True
    rows = best_fit.pack(docs).collect()
    by_doc = collections.defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
    for i, t in texts_of(corpus):
        ids = [*tk.encode(t or "", add_special_tokens=False).ids, 0]
        for r in by_doc[i]:
            assert r.ids_crc32 == zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids[r.start : r.start + r.length]))
        starts = sorted({(r.start, r.length) for r in by_doc[i]})
        assert sum(n for _, n in starts) == len(ids) and all(n == 2048 for s, n in starts if s)
    used = collections.defaultdict(list)
    for r in rows:
        used[r.sequence_id].append((r.offset, r.length))
    for parts in used.values():
        end = 0
        for offset, n in sorted(parts):
            assert offset == end
            end += n
        assert end <= 2048
    assert len(used) <= -(-sum(r.length for r in rows) // 2048) + 1


def test_packing_maps_added_tokens_in_texts(spark):
    from tokenizers import Tokenizer

    import public_tokenizers

    tk = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>\n\n  y", " \n<|endoftext|> \u00e9 <|endoftext|", "<|endoftext|>s 12", "word <|endoftext|> " * 1500]
    rows = best_fit.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for i, t in enumerate(texts):
        ids = [*tk.encode(t, add_special_tokens=False).ids, 0]
        assert 50256 in ids
        mine = [r for r in rows if r.doc_id == i]
        assert sum(r.length for r in mine) == len(ids)
        for r in mine:
            assert r.ids_crc32 == zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids[r.start : r.start + r.length]))


def test_packing_plan_uses_all_pieces():
    rng = random.Random(3)
    counts = collections.Counter(rng.randint(1, 100) for _ in range(5000))
    bins = best_fit.plan(dict(counts), 100)
    used = collections.Counter()
    for lengths, times in bins:
        assert sum(lengths) <= 100
        for n in lengths:
            used[n] += times
    assert used == counts


def test_pseudonyms(spark):
    text = 'Card 4111 1111 1111 1111, 4111111111111112, ann.b7@example.com, +1 (705) 555-1902, 10.0.0.256 10.0.0.25, 2024-02-29 2023-02-29 29.02.2024, GB82 WEST 1234 5698 7654 32, 078-05-1120, token = "' + "0a" * 20 + '"'
    rows = [(1, text, 9), (2, text, 9), (3, None, 9), (4, "", 9)]
    out = {r.doc_id: r for r in pseudonyms.pseudonymised(spark.createDataFrame(rows, "doc_id long, text string, n_card int"), b"k").collect()}
    new = out[1].text
    assert new == out[2].text and out[3].text is None and out[4].text == ""
    for gone in ("4111 1111 1111 1111", "ann.b7@", "555-1902", "10.0.0.25,", "2024-02-29", "29.02.2024", "WEST 1234", "078-05-1120", "0a" * 20):
        assert gone not in new
    for stays in ("4111111111111112", "10.0.0.256", "2023-02-29", "@example.com", "+1 ("):
        assert stays in new
    card = "".join(re.search(r"Card ([\d ]{19})", new)[1].split())
    assert card[0] == "4" and pseudonyms.check_digit(card[:-1]) == card[-1]
    iban = re.search(r"GB\d\d [A-Z]{4} \d{4} \d{4} \d{4} \d\d", new)[0].replace(" ", "")
    assert pseudonyms.iban_number(iban[:4], iban[4:]) % 97 == 1
    iso, dotted = re.search(r"\d{4}-\d\d-\d\d", new)[0], re.search(r"\d\d\.\d\d\.\d{4}", new)[0]
    assert iso.split("-") == dotted.split(".")[::-1]  # one date, two layouts


def test_pseudonyms_of_values_alone_in_a_text(spark):
    account = "WESTABCDEFGHJK"
    iban = f"GB{98 - pseudonyms.iban_number('GB00', account) % 97:02d}{account}"
    arabic = str.maketrans("0123456789", "".join(chr(0x660 + i) for i in range(10)))
    values = {
        "email": ["a@b.co"],
        "secret": ["key='" + "a" * 32 + "'"],
        "iban": [iban, " ".join(iban[i : i + 4] for i in range(0, len(iban), 4)), "GB82 WEST 1234 5698 7654 32"],
        "ip": ["1.2.3.4"],
        "date": ["2024-02-29", "2024/02/29", "29/02/2024", "29.02.2024", "2024-02-29".translate(arabic)],
        "ssn": ["078-05-1120", "078-05-1120".translate(arabic)],
        "phone": ["+49 30 123 456", "+44 20 794 609 58", "+49.30.123.456", "+1 (705) 555-1902", "(705) 555-1902", "+49 30 123 456".translate(arabic), "(705) 555-1902".translate(arabic)],
        "card": ["4111 1111 1111 1111", "4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1", "411-111-111-111-111-1", "4111111111111111", "4111 1111 1111 1111".translate(arabic)],
    }
    rows = [(i, kind, value) for i, (kind, value) in enumerate((k, v) for k in pseudonyms.KINDS for v in values[k])]
    out = {r.doc_id: r for r in pseudonyms.pseudonymised(spark.createDataFrame(rows, "doc_id long, kind string, text string"), b"k").collect()}
    for i, kind, value in rows:
        assert out[i].text != value and {k: out[i][f"n_{k}"] for k in pseudonyms.KINDS} == {k: int(k == kind) for k in pseudonyms.KINDS}, value
    new = {value: out[i].text for i, _, value in rows}
    assert new["+49 30 123 456".translate(arabic)] == new["+49 30 123 456"] and new["078-05-1120".translate(arabic)] == new["078-05-1120"]
    assert pseudonyms.replaced("2024: +49 30 123 456", pseudonyms.Feistel(b"k"))[0] == f"2024: {new['+49 30 123 456']}"


def test_pseudonyms_link_layouts_and_change_everything():
    f = pseudonyms.Feistel(b"k")
    digits = lambda v: "".join(c for c in v if c.isdigit())
    forms = ["+1 555 123 4567", "+15551234567", "(555) 123-4567", "555-123-4567", "555.123.4567", "+1 (555) 123-4567"]
    new = [pseudonyms.replaced(f"call {x} now", f) for x in forms]
    assert all(found == {"phone": 1} for _, found in new) and len({digits(t)[-10:] for t, _ in new}) == 1 and digits(new[0][0])[-10:] != "5551234567"
    assert [digits(t)[:-10] for t, _ in new] == ["1", "1", "", "", "", "1"]
    a, b = (digits(pseudonyms.replaced(x, f)[0]) for x in ("+49 30 123 456", "+4930123456"))
    assert a == b and a[:2] == "49" and a != "4930123456"
    for radix, n in ((26, 1), (10, 1), (10, 2), (26, 2), (10, 3)):
        assert all(f.number(i, "t", radix, n) != i for i in range(radix**n))
    for i in range(300):
        assert pseudonyms.replaced(f"a@d{i}.com", f)[0] != f"a@d{i}.com"


def test_feistel_permutes():
    f = pseudonyms.Feistel(b"k")
    for digits in (1, 2, 3):
        assert sorted(f.number(i, "t", 10, digits) for i in range(10**digits)) == list(range(10**digits))
    assert sorted(f.below(i, 137, "t") for i in range(137)) == list(range(137))


def test_lattice_sums_all_segmentations():
    import numpy as np

    pieces = [b" a", b"b", b"ab", b" ab", b"a", b" ", b"bb"]
    scores = np.log(np.array([0.2, 0.1, 0.1, 0.2, 0.2, 0.1, 0.1]))
    lattice = lattice_lm.Lattice(pieces)

    def brute(s):
        return 1.0 if not s else sum(math.exp(scores[i]) * brute(s[len(p) :]) for i, p in enumerate(pieces) if s.startswith(p))

    for word in (b" abb", b" bab", b" aabbab"):
        text = np.frombuffer(word, np.uint8)[None, :]
        assert math.isclose(math.exp(lattice.forward(text, scores)[-1, 0]), brute(word))
        # expected counts cover the word
        assert math.isclose(sum(n * len(p) for n, p in zip(lattice.expected(text, np.ones(1), scores), pieces)), len(word))


def test_document_scores(docs, corpus):
    got = lattice_lm.scored(docs, hot_words=50).collect()
    assert len(got) == docs.count()
    c, ends = collections.Counter(), 0
    for r in corpus[0]:
        if r[0] is None or zlib.crc32(str(r[0]).encode()) % 5 != 1:
            c.update(lower(r[1]))
            ends += 1
    n, v = sum(c.values()) + ends, len(c) + 1
    text = {r[0]: r[1] for r in corpus[0]}
    for r in got:
        w = lower(text[r.doc_id])
        base = sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w) + math.log10((ends + 0.5) / (n + 0.5 * (v + 1)))
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w) + 1, sum(c[x] > 0 for x in w) + 1, n)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and r.score < 0


def test_empty_tables(docs, spark):
    none = docs.limit(0)
    bench = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert jaccard_join.near_duplicates(none).count() == 0
    assert decontaminate.clean(none, bench).count() == 0
    assert substring_dedup.kept_words(none, substring_dedup.factors(none)).count() == 0
    assert suffix_dedup.kept_bytes(none, suffix_dedup.repeated_ranges(none)).count() == 0
    assert line_dedup.dedup_lines(none).count() == 0 and quality_rules.judged(none).count() == 0
    assert best_fit.pack(none).count() == 0 and lattice_lm.scored(none).count() == 0
    assert pseudonyms.pseudonymised(none, b"k").count() == 0
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string, c int")
    assert chat_format.read_back(chat_format.format_conversations(turns)).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40) if i % 10] + [(100, 7), (200, 201), (201, 200)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(1, 11)} | {got[100]} == {1} and got[201] == got[200] == 200 and got[35] == 31


def test_pipeline_stages(spark, tmp_path):
    """Nulls, empty and very long texts, repeated rows and columns with clashing names, stage by stage."""
    import corpus_pipeline

    rng = random.Random(4)
    vocabulary = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 9))) for _ in range(2000)]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    item, base = say(40), say(90)
    texts = [None, "", " \n\t", "one", base, base, f"{base} end", " ".join("".join(rng.choice("abcdefghijklm") for _ in range(6)) for _ in range(60_000)), f"{say(50)} {item} {say(50)}", say(70), say(70)]
    rows = [(i, t, f"r{i}", i, None, i, f"{i}", None if t is None else len(t)) for i, t in enumerate(texts)]
    rows += [rows[-1], (None, say(80), None, None, None, None, None, 7)]
    clashing = "doc_id long, text string, row_ string, drop_ long, n_deleted long, c long, words string, n_chars long"
    spark.createDataFrame(rows, clashing).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(5, item), (None, None), (6, "")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept.append(sorted((-1 if r.doc_id is None else r.doc_id) for r in docs.collect()))
    assert kept == [[-1, 4, 5, 6, 7, 8, 9, 10, 10], [-1, 4, 5, 6, 7, 8, 9, 10, 10], [-1, 4, 5, 7, 8, 9, 10, 10], [-1, 4, 5, 7, 9, 10, 10]]
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in rows} == {None, 4, 5, 7, 9, 10} and sum(r.start == 0 for r in rows) == 7
    none = spark.createDataFrame([], clashing)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, str(tmp_path)).count() == 0, name


def test_pipeline_stages_one_after_another(spark, tmp_path):
    from tokenizers import Tokenizer

    import corpus_pipeline
    import public_tokenizers

    rng = random.Random(11)
    vocabulary = sorted({"".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 9))) for _ in range(3000)})
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    changed = lambda t, at: " ".join("changed" if k == at else w for k, w in enumerate(t.split(" ")))
    item, near, three, paragraph = say(60), say(200), "\n".join(say(4) for _ in range(3)), say(60)
    texts = {
        "clean": say(80), "clean of two sequences": say(2500),
        "few words": say(49), "symbols": f"{say(60)} {'# ' * 20}", "no letters": " ".join(str(rng.randint(100, 999)) for _ in range(60)),
        "three lines": f"{say(60)}\n{three}\n{say(60)}", "three lines again": f"{say(70)}\n{three}\n{say(50)}",
        "paragraph": f"{paragraph}\n{say(80)}", "paragraph again": f"{say(90)}\n{paragraph}",
        "near": near, "near copy": changed(near, 100), "near copy that the lines make": f"{paragraph}\n{changed(near, 60)}",
        "leak": f"{say(60)} {item.upper()} {say(60)}", "near leak": f"{say(60)} {changed(item, 30)} {say(60)}", "half an item": f"{say(60)} {' '.join(item.split()[:30])} {say(60)}",
        "added token": f"{say(60)} <|endoftext|> {say(60)}",
    }
    names = {i: name for i, name in enumerate(texts, 1)}
    rows = [*((i, texts[name], len(texts[name])) for i, name in names.items()), (None, say(90), 1), (90, None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, n_chars long").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(5, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    def shingles(t):
        w = lower(t)
        return [tuple(w[j : j + 5]) for j in range(len(w) - 4)] or [tuple(w)]

    def similar(a, b):
        a, b = collections.Counter(a), collections.Counter(b)
        return 100 * (a & b).total() >= 80 * (a | b).total()

    def quality(docs):
        def kept(t):
            w, lines = (t or "").split(), [x for x in (t or "").split("\n") if x.strip()]
            c = collections.Counter(zip(w, w[1:], w[2:]))
            chars, repeated = sum(map(len, w)), {j + k for j in range(len(w) - 2) if c[w[j], w[j + 1], w[j + 2]] > 1 for k in range(3)}
            return not (
                len(w) < 50 or 2 * len(repeated) > len(w) or len(re.findall(r"[#*$%&|<>]", t)) > 0.1 * len(w) or not 2 * len(w) <= chars <= 20 * len(w) or len(lines) - len(set(lines)) > 0.3 * len(lines)
                or len(set(w)) < 0.2 * len(w) or sum(x.isupper() for x in t) > 0.5 * chars or sum(x.isalpha() for x in t) < 0.5 * chars
            )

        return [r for r in docs if kept(r[1])]

    def lines(docs):
        seen, out = {}, []
        for i, t, n in docs:
            x, drop = t.split("\n"), set()
            for n_lines in (1, 2, 3) if i is not None else ():
                for j in range(len(x) - n_lines + 1):
                    passage = tuple(x[j : j + n_lines])
                    if n_lines == 3 or sum(len(y.split()) for y in passage) >= 50 or sum(map(len, passage)) >= 400:
                        if seen.setdefault(passage, (i, j)) != (i, j):
                            drop |= set(range(j, j + n_lines))
            t = "\n".join(y for j, y in enumerate(x) if j not in drop)
            out.append((i, t, len(t) if drop else n))
        return out

    def near_copies(docs):
        sets = {i: set(shingles(t)) for i, t, _ in docs if i is not None}
        component = {i: i for i in sets}
        for _ in sets:
            component = {i: min(component[j] for j in sets if similar(sets[i], sets[j])) for i in sets}
        return [r for r in docs if r[0] is None or component[r[0]] == r[0]]

    def decontaminated(docs):
        size, want = len(item.split()), shingles(item)
        return [r for r in docs if r[0] is None or not any(similar(shingles(" ".join(r[1].split()[j : j + size])), want) for j in range(len(r[1].split()) - size + 1))]

    order = lambda rows: sorted(((r[0], r[1], r[2]) for r in rows), key=lambda r: (r[0] is None, r[0] or 0))
    docs, gone = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for k, ((_, stage), plain) in enumerate(zip(corpus_pipeline.STAGES, (quality, lines, near_copies, decontaminated), strict=False)):
        before = order(docs.collect())
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        after = order(docs.collect())
        assert after == plain(before)
        gone.append({names.get(r[0], r[0]) for r in before} - {names.get(r[0], r[0]) for r in after})
        if plain is lines:
            assert {names[a[0]] for a, b in zip(before, after) if a != b} == {"three lines again", "paragraph again", "near copy that the lines make"}
    assert gone == [{"few words", "symbols", "no letters", 90}, set(), {"near copy", "near copy that the lines make"}, {"leak", "near leak"}]

    tk = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    want = collections.Counter()
    for i, t, _ in docs.collect():
        ids = [*tk.encode(t, add_special_tokens=False).ids, 0]
        first = len(ids) % 2048 or 2048
        for start, end in zip([0, *range(first, len(ids), 2048)], range(first, len(ids) + 1, 2048)):
            want[i, start, end - start, zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids[start:end]))] += 1
    assert collections.Counter((r.doc_id, r.start, r.length, r.ids_crc32) for r in rows) == want
    used = collections.defaultdict(list)
    for r in rows:
        used[r.sequence_id].append((r.offset, r.length))
    for parts in map(sorted, used.values()):
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))] and sum(n for _, n in parts) <= 2048


def test_decontamination_of_near_passages(spark):
    rng = random.Random(5)
    say = lambda n: [f"w{rng.randrange(100_000)}" for _ in range(n)]
    items, texts = {}, {}
    for i in range(400):
        items[i] = say(rng.randint(40, 120))
        near = list(items[i])
        for at in rng.sample(range(len(near)), rng.randint(1, 3)):
            near[at] = "changed"
        texts[i] = say(20) + near + say(20)
    shingles = lambda w: collections.Counter(tuple(w[j : j + 5]) for j in range(len(w) - 4))
    best = {}
    for i, w in texts.items():
        a, n = shingles(items[i]), len(items[i])
        windows = [shingles(w[j : j + n]) for j in range(len(w) - n + 1)]
        best[i] = max((a & b).total() / (a | b).total() for b in windows)
    frame = lambda rows, name: spark.createDataFrame([(i, " ".join(w)) for i, w in rows.items()], f"{name} long, text string")
    found = {r.doc_id: r for r in decontaminate.leaking(frame(texts, "doc_id"), frame(items, "item_id")).collect()}
    due = {i for i, x in best.items() if x >= 0.8}
    assert set(found) <= due and all(r["items"] == [i] and 0.8 <= r.similarity <= best[i] + 1e-12 for i, r in found.items())
    low = {i for i in due if best[i] < 0.9}
    print("0.8 to 0.9:", len(low & set(found)), "of", len(low), "0.9 on:", len(set(found) - low), "of", len(due - low))
    assert len(low) > 50 and len(low & set(found)) >= 0.95 * len(low) and due - low <= set(found)
