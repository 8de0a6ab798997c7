"""Phrase graph, conversation repair and piecewise hashing against brute force, with nulls, ties, repeated rows, empty tables, clashing names and long texts."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from gridstone.llm import dialog_repair, phrase_graph, piecewise_hash

DOCS = "doc_id long, text string, lang string, phrase string, n long, size int, part int, ahead boolean"


def with_odd_columns(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, 3, True) for r in rows], DOCS)


# --- phrases ------------------------------------------------------------------------------------------------------


def plain_collocations(rows, least, top):
    """Every gram counted one by one; the drop rule against all longer candidates."""
    f, n = collections.defaultdict(int), collections.Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    often = {g: a for g, a in f.items() if len(g[1]) > 1 and a >= least}
    inside = lambda c, d: len(d[1]) > len(c[1]) and c[0] == d[0] and any(d[1][i : i + len(c[1])] == c[1] for i in range(len(d[1]) - len(c[1]) + 1))
    out = collections.defaultdict(list)
    for (lang, words), a in often.items():
        if any(inside((lang, words), d) and 100 * b >= 100 * a for d, b in often.items()):
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, words[:k]] * f[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        out[lang].append((-score, -a, " ".join(words).encode(), f[lang, words[:k]], f[lang, words[k:]]))
    return {(lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for lang, found in out.items() for i, (s, a, p, left, right) in enumerate(sorted(found)[:top])}


@pytest.fixture(scope="module")
def prose():
    rng = random.Random(3)
    words = ["Der", "die", "zum", "é", "É", "new", "york", "stock", "a b", "\U0001f600", "x\x00y", *[f"w{i}" for i in range(30)]]
    say = lambda n: "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\r\n", "\x0b"]) for _ in range(n))
    texts = [None, "", " \t", "...", "new york stock exchange " * 9, *[say(rng.randrange(1, 200)) + "New york  stock exchange today" + say(20) for _ in range(60)]]
    rows = [(i, t, rng.choice(["en", "de", None, "und"])) for i, t in enumerate(texts)]
    return [*rows, rows[7], rows[7], (None, texts[8], None)]


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 0])
def test_collocations(spark, prose, broadcast_bytes):
    docs = with_odd_columns(spark, prose).repartition(3)
    for least, top in ((3, 2000), (4, 5)):
        got = [tuple(r) for r in phrase_graph.collocations(docs, least, top, broadcast_bytes).collect()]
        assert len(got) == len(set(got)) and set(got) == plain_collocations(prose, least, top)


def test_flows_give_the_counts_of_shorter_phrases(spark, prose):
    """Counts of nodes from the longest grams and the pieces' ends equal counts one by one."""
    docs = with_odd_columns(spark, prose).select("text", "lang")
    grams = phrase_graph.summed(docs.mapInArrow(phrase_graph.edge_counts(None, None), phrase_graph.COUNTS))
    pairs = docs.mapInArrow(phrase_graph.pair_counts(None), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    up = grams.where("size = 5")
    for size in (4, 3, 2):
        up = phrase_graph.flows(up, grams, size)
    assert sorted(r.n for r in up.collect()) == sorted(r.n for r in pairs.collect())


def test_collocations_of_empty_tables_and_long_texts(spark):
    assert phrase_graph.collocations(with_odd_columns(spark, []).select("text", "lang")).collect() == []
    assert phrase_graph.collocations(with_odd_columns(spark, [(1, None, None), (2, "a", "x")])).collect() == []
    long = [(1, "one two " * 400_000 + "x" * 300_000, "en"), (2, "one two.", "en")]
    got = [(r.phrase, r.a, r.l, r.r, r.n) for r in phrase_graph.collocations(with_odd_columns(spark, long)).collect()]
    # "two one", both phrases of three words and "two one two one" go whole through a longer one
    assert sorted(got) == [("one two", 400_001, 400_001, 400_001, 800_003), ("one two one two", 399_999, 400_001, 400_001, 800_003), *[(f"{x} {y} {x} {y} {x}", 399_998, 400_001, 399_999, 800_003) for x, y in (("one", "two"), ("two", "one"))]]


def test_exact_scores_beyond_64_bits(spark):
    big = 10**15
    phrases = spark.createDataFrame([("en", 2, "a b", big)], "lang string, size int, phrase string, n long")
    counts = spark.createDataFrame([("en", "a", big + 1), ("en", "b", big + 3)], "lang string, phrase string, n long")
    r = phrase_graph.scored(phrases, counts, spark.createDataFrame([("en", 7 * big)], "lang string, total long")).first()
    assert r.score == 1000 * big * 7 * big // ((big + 1) * (big + 3))


# --- conversations ------------------------------------------------------------------------------------------------


def every_script(rows, most):
    """All scripts of up to most insertions for rows (initial, must it go, cost of keeping it) that end in the grammar: the cheapest, least one."""
    best = None
    for inserts in range(most + 1):
        for letters in set(itertools.permutations("I" * inserts + "x" * len(rows))):
            for chosen in itertools.product("KRD", repeat=len(rows)):
                left, cost, options = iter(zip(chosen, rows, strict=True)), 0, [""]
                script = ""
                for x in letters:
                    if x == "I":
                        script, cost, options = script + "I", cost + 2, [o + y for o in options for y in "ua"]
                        continue
                    edit, (initial, must_go, extra) = next(left)
                    script, cost = script + edit, cost + {"K": extra, "R": 2 + extra, "D": 3}[edit]
                    if edit != "D" and must_go:
                        options = []
                    options = {"K": [o + (initial or "?") for o in options], "R": [o + y for o in options for y in "ua"], "D": options}[edit]
                if any(re.fullmatch("(s?(ua)+)?", o) for o in options) and (best is None or (cost, script) < best):
                    best = cost, script
    return best


def test_cheapest_scripts_against_all_of_them():
    rng = random.Random(5)
    for _ in range(150):
        rows = [(rng.choice(["s", "u", "u", "a", "a", "t", ""]), rng.random() < 0.2, int(rng.random() < 0.3)) for _ in range(rng.randrange(0, 5))]
        assert dialog_repair.cheapest(rows) == every_script(rows, 3)


def lattice_in_order(rows):
    """The same by one pass over the rows, with whole scripts."""
    best = {0: (0, "")}
    after = {0: (2, "u"), 1: (2, "u"), 2: (3, "a"), 3: (2, "u")}

    def put(into, state, cost, script):
        into[state] = min(into.get(state, (cost, script)), (cost, script))

    for row in [*rows, None]:
        for _ in range(4):
            for state, (cost, script) in list(best.items()):
                put(best, after[state][0], cost + 2, script + "I")
        if row is None:
            break
        initial, must_go, extra = row
        then = {}
        for state, (cost, script) in best.items():
            put(then, state, cost + 3, script + "D")
            if not must_go:
                put(then, after[state][0], cost + 2 + extra, script + "R")
                if initial == after[state][1]:
                    put(then, after[state][0], cost + extra, script + "K")
                if state == 0 and initial == "s":
                    put(then, 1, cost + extra, script + "K")
        best = then
    return min(best[s] for s in (0, 3) if s in best)


def plain_repair(rows):
    """rows: (conv_id, turn, role, text). The contract, step by step."""
    left = {}
    for conv, turn, role, text in rows:
        sp = lambda x: " " if x is None else str(x)
        fate = zlib.crc32(f"{sp(conv)}:{sp(turn)}".encode()) % 20
        row = (turn, "user" if fate == 4 else sp(role), "" if fate == 1 else re.sub("[.!?]", "", sp(text)) if fate == 2 else sp(text))
        left.setdefault(conv, []).extend([row] * (0 if fate == 0 else 2 if fate == 3 else 1))
    out = set()
    for conv, turns in left.items():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, lattice, counts = set(), [], collections.Counter()
        for _, role, text in turns:
            end = re.findall(r"[^\x20\x09-\x0D]", text)[-1:]
            fault = "b" if not end else "d" if (role, text) in seen else "t" if end[0] not in ".!?" else ""
            seen.add((role, text))
            counts[fault] += 1
            lattice.append((role[:1], fault in ("b", "d"), int(fault == "t")))
        known = {t[0] for t in turns if t[0] is not None}
        pairs = [a[0] + b[0] for a, b in zip(lattice, lattice[1:], strict=False)]
        cost, script = lattice_in_order(lattice)
        made, state, source = [], "", iter(turns)
        for x in script:
            turn = None if x == "I" else next(source)
            if x == "D":
                continue
            role = turn[1] if x == "K" else "assistant" if state == "u" else "user"
            made.append(f"{role}:{'' if x == 'I' else turn[2]}")
            state = role[:1]
        digest = hashlib.sha256("\n".join(made).encode()).hexdigest()
        out.add((conv, max(known) - min(known) + 1 - len(known) if known else 0, counts["b"], counts["d"], counts["t"], sum(p not in ("su", "ua", "au") for p in pairs), cost, script, digest))
    return out


def test_conversation_repair(spark, tmp_path):
    rng = random.Random(11)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "tool", None, "", "User"]), rng.choice(["Yes.", "no", "Ok!", " \n", "", None, "é?", "x" * 50])) for c in range(60) for t in range(rng.randrange(1, 9))]
    rows += [(c, t, "user" if t % 2 == 0 else "assistant", f"Turn {t}.") for c in range(60, 80) for t in range(6)]
    rows += [(None, None, None, None), (None, 3, "user", "Hi."), (7, None, "system", "Be kind."), (7, None, "system", "Be kind."), rows[0], rows[0], (900, 5, "assistant", "y" * 2_000_000), *[(901, t, "ua"[t % 2] + "x", "t.") for t in range(3000)]]
    odd = spark.createDataFrame([(*r, 1, "k") for r in rows], "conv_id long, turn long, role string, text string, present long, rows_ string")
    odd.repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    found = dialog_repair.query(spark, str(tmp_path))
    assert found.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len({r[0] for r in rows}) and set(got) == plain_repair(rows)
    assert dialog_repair.repair(odd.limit(0)).collect() == []


def test_repaired_turns(spark):
    rows = [(1, 0, "system", "Hi."), (1, 1, "assistant", "Ok."), (1, 2, "user", "Go"), (2, 0, "tool", " ")]
    got = {r.conv_id: (r.audit, [tuple(t) for t in r.turns]) for r in dialog_repair.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    # two scripts cost 5: deleting comes before keeping
    assert got == {1: ("KIKD", [("system", "Hi."), ("user", ""), ("assistant", "Ok.")]), 2: ("D", [])}


# --- fingerprints -------------------------------------------------------------------------------------------------


def plain_fingerprint(text):
    """Byte by byte, with a window that is hashed anew at each place."""
    m64, data = (1 << 64) - 1, text.encode()

    def mixed(h):
        for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            h = ((h ^ h >> shift) * by) & m64
        return h ^ h >> 31

    def poly(part):
        return sum((b + 1) * pow(piecewise_hash.BASE_A, i, 1 << 64) for i, b in enumerate(part)) & m64

    zeros = []
    for end in range(7, len(data) + 1):
        h = mixed(sum((b + 1) * pow(piecewise_hash.BASE_A, 7 - i, 1 << 64) for i, b in enumerate(data[end - 7 : end])) & m64)
        zeros.append((end, 64 if h == 0 else (h & -h).bit_length() - 1))
    level = max(0, max(1, len(data) - 1).bit_length() - 6)
    while level and sum(z >= level for _, z in zeros) < 24:
        level -= 1
    letters, out = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", []
    for k in (level, level + 1):
        ends = [e for e, z in zeros if z >= k][:63]
        ends += [len(data)] if data and ends[-1:] != [len(data)] else []
        out.append("".join(letters[mixed((poly(data[a:b]) + 0x51 * (b - a)) & m64) >> 58] for a, b in zip([0, *ends], ends, strict=False)))
    return f"{level}:{out[0]}:{out[1]}"


def plain_likeness(f, g):
    if f == g:
        return 1.0

    def alike(a, b):
        run = min(4, len(a), len(b))
        if not run or not {a[i : i + run] for i in range(len(a) - run + 1)} & {b[i : i + run] for i in range(len(b) - run + 1)}:
            return 0.0
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            row, before = [i + 1], row
            for j, y in enumerate(b):
                row.append(before[j] if x == y else min(before[j + 1], row[j]) + 1)
        return 1 - row[-1] / (len(a) + len(b))

    (i, a, a2), (j, b, b2) = ((int(x[0]), *x[1:]) for x in (f.split(":"), g.split(":")))
    pairs = {0: [(a, b), (a2, b2)], 1: [(a2, b)], -1: [(a, b2)]}.get(j - i, [])
    return max([alike(x, y) for x, y in pairs], default=0.0)


def test_fingerprints_beside_the_next_document(spark):
    rng = random.Random(2)
    say = lambda n: " ".join(rng.choice(["the", "Öl", "of", "gas\n", "\U0001f600", "water", "w" + str(rng.randrange(99))]) for _ in range(n))
    base = say(700)
    texts = [None, "", "a", "abc", "abcdefg", base, base, base[:2000] + say(40), say(30), say(5), "ab" * 3000, "\x00" * 100, *[say(rng.randrange(200)) for _ in range(40)]]
    rows = [(i * 7 - 50, t, "en") for i, t in enumerate(texts)]
    got = sorted(tuple(r) for r in piecewise_hash.against_next(with_odd_columns(spark, rows).repartition(5)).collect())
    whole = ["" if t is None else t for t in texts]
    expected = []
    for (i, _, _), text, after in zip(rows, whole, whole[1:] + whole[:1], strict=True):
        q = len(text) // 4
        new = text[: len(text) - q] + after[:q]
        own, other = plain_fingerprint(text), plain_fingerprint(new)
        expected.append((i, len(text), hashlib.sha256(new.encode()).hexdigest(), own, other, plain_likeness(own, other), plain_likeness(own, plain_fingerprint(after))))
    assert [r[:5] for r in got] == [r[:5] for r in sorted(expected)]
    assert [r[5:] for r in got] == [pytest.approx(r[5:]) for r in sorted(expected)]
    by = {r[0]: r for r in got}
    assert by[5 * 7 - 50][6] == 1.0 and by[6 * 7 - 50][6] > 0.5 > by[8 * 7 - 50][6]


def test_fingerprints_of_odd_tables(spark):
    assert piecewise_hash.against_next(with_odd_columns(spark, [])).collect() == []
    one = piecewise_hash.against_next(with_odd_columns(spark, [(5, "abcdefgh", "x")])).collect()
    assert [(r.doc_id, r.near_next) for r in one] == [(5, 1.0)] and one[0].edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest()
    rows = [(None, "n", "x"), (1, "a", "x"), (1, "b", "x"), (1, "a", "x"), (2**62, None, "x"), (-(2**62), "z" * 3_000_000, "x"), (3, "q " * 900_000, "x")]
    got = piecewise_hash.against_next(with_odd_columns(spark, rows).repartition(3)).collect()
    assert sorted((str(r.doc_id), r.n_chars) for r in got) == sorted((str(i), len(t or "")) for i, t, _ in rows)
    long = next(r for r in got if r.doc_id == -(2**62))
    # the next document is one of those with doc_id 1, in the order of their hashes
    assert long.edited_sha256 in {hashlib.sha256(b"z" * 2_250_000 + t).hexdigest() for t in (b"a", b"b")}


def test_columns_of_fingerprints(spark):
    df = piecewise_hash.with_fingerprint(spark.createDataFrame([("same text of some words",), (None,), ("same text of some words",)], "text string"))
    fps = [r.fingerprint for r in df.collect()]
    assert fps[0] == fps[2] and len(set(fps)) == 2
    both = df.select(piecewise_hash.likeness_of(F.col("fingerprint"), F.lit(fps[0])).alias("x"), piecewise_hash.likeness_of(F.lit(None).cast("string"), F.col("fingerprint")).alias("none"))
    assert sorted((r.x, r.none) for r in both.collect()) == [(0.0, None), (1.0, None), (1.0, None)]
