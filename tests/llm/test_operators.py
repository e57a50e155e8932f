"""The ten operators against brute force on small tables: nulls, empty and long texts, ties, repeats, clashing columns, empty tables."""

import hashlib
import random
import re
import zlib
from collections import Counter
from itertools import combinations
from math import log10

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import chat, gif, near_dup, packing, repeats, toxicity, urls
from tidemark.llm.chunks import runs
from tidemark.llm.decontaminate import benchmark_leaks
from tidemark.llm.lm import learn_weights, lm_scores
from tidemark.llm.near_dup import near_duplicates
from tidemark.llm.token_store import token_file_round_trip
from tidemark.llm.tokens import encoder, resolve

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
SCHEMA = "doc_id long, text string, id long, kept string, sequence_id string, chunk int"


def words(t):
    return WORD.findall((t or "").translate(LOWER))


def table(spark, rows):
    """Documents with extra columns whose names clash with those the operators use."""
    return spark.createDataFrame([(i, t, 7, "x", "y", 1) for i, t in rows], SCHEMA)


def some_texts(n=60, seed=3):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(80)] + ["Ünï", "ÀB", "end."]
    texts = [" ".join(rnd.choice(vocab) for _ in range(rnd.choice([0, 1, 2, 5, 40, 90]))) for _ in range(n // 2)]
    while len(texts) < n:
        w = rnd.choice(texts).split(" ")
        for _ in range(rnd.randint(0, 6)):
            w[rnd.randrange(len(w))] = rnd.choice(vocab)
        texts.append(" ".join(w))
    texts += ["A b", "a\tB ", "", None, "   ", "one", "one", texts[-1], "x y z " * 700]
    return list(enumerate(texts))


# --- op1 ----------------------------------------------------------------------


def test_near_duplicates_match_brute_force(spark):
    rows = some_texts()
    rnd = random.Random(9)
    base = [f"t{i}" for i in range(60)]
    for k in range(40):  # a group whose members lie on both sides of the limit
        w = base[:]
        for _ in range(rnd.randint(0, 9)):
            w[rnd.randrange(60)] = f"q{rnd.randrange(400)}"
        rows.append((1000 + k, " ".join(w)))
    sets = {}
    for i, t in rows:
        w = words(t)
        sets[i] = {tuple(w[k : k + 2]) for k in range(max(1, len(w) - 1))} if w else set()
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        n = len(sets[a] & sets[b])
        if n and 100 * n >= 80 * len(sets[a] | sets[b]):
            p, q = find(a), find(b)
            parent[max(p, q)] = min(p, q)
    for options in ({}, {"block_shingles": 300, "block_rows": 7, "most_broadcast": 0}):
        got = near_duplicates(table(spark, rows).repartition(5), width=2, **options).collect()
        assert {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got} == {(i, len(s), find(i), find(i) == i) for i, s in sets.items()}


def test_near_duplicates_of_odd_tables(spark):
    assert near_duplicates(table(spark, []), width=2).count() == 0
    got = near_duplicates(table(spark, [(None, "a b c"), (5, "a b c"), (5, "x y z"), (4, "x y z")]), width=2).collect()
    assert Counter((r.doc_id, r.component_id, r.kept) for r in got) == Counter({(None, None, False): 1, (5, 4, False): 2, (4, 4, True): 1})


def test_near_duplicates_of_equally_large_texts_of_one_id(spark):
    rnd = random.Random(8)
    texts = [" ".join(f"v{rnd.randrange(10**6)}" for _ in range(60)) for _ in range(12)]
    rows = [(5, t) for t in texts] + [(100 + k, t.rsplit(" ", 1)[0] + " changed") for k, t in enumerate(texts)]
    got = near_duplicates(table(spark, rows), width=2).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(5, 5)} | {(100 + k, 5) for k in range(12)}


def test_words_that_one_polynomial_hash_confuses_stay_apart(spark):
    word = "a"
    while len(word) < 1024:
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    got = near_duplicates(table(spark, [(1, word), (2, other), (3, word)]), width=2).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(1, 1), (2, 2), (3, 1)}


def test_words_made_to_collide_stay_apart(spark):
    """Two words that the mixing function confuses under a fixed beginning."""
    one, other = "documentlanguage", "s$.-p75i?2<x3k}9"
    got = near_duplicates(table(spark, [(1, one), (2, other), (3, one)]), width=2).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(1, 1), (2, 2), (3, 1)}
    ids = {f: [i for i in range(1, 90) if zlib.crc32(str(i).encode()) % 7 == f] for f in range(7)}
    got = lm_scores(table(spark, [(ids[0][0], other), (ids[2][0], one)])).where("held_out").first()
    assert (got.n_tokens, got.n_known) == (2, 1)


def test_hash_ranges_cost_nothing_where_no_hash_is():
    keys = np.sort(np.random.default_rng(1).integers(0, 2**64, 500, dtype=np.uint64, endpoint=False))
    keys[-1] = np.uint64(2**64 - 1)
    for parts in (1, 3, 8, 1000, 10**6, 10**9):
        number, begin, end = runs(keys, parts)
        assert (np.repeat(number, end - begin) == np.minimum(keys // np.uint64(2**64 // max(parts, 2)), np.uint64(parts - 1)).astype(int)).all()
        assert begin[0] == 0 and end[-1] == 500 and len(number) <= 500
    assert all(len(x) == 0 for x in runs(keys[:0], 10))


def test_buckets_of_any_size_find_all_likely_members():
    rnd = np.random.default_rng(3)
    base = rnd.integers(0, 1 << 63, 6, dtype=np.uint64)
    bits = np.tile(base, (90, 1))
    bits[::2] ^= rnd.integers(0, 1 << 63, (45, 6), dtype=np.uint64)
    col = {
        "key": np.repeat([1, 2, 3], [80, 8, 2]), "i": np.zeros(90, int), "j": np.zeros(90, int), "x": np.zeros(90, int),
        "n": np.full(90, 50), "c": np.arange(90) % 7
    }
    far = lambda p, q: np.bitwise_count(bits[p] ^ bits[q]).sum() > 74
    want = {p for p in range(90) for q in range(90) if col["key"][p] == col["key"][q] and col["c"][p] != col["c"][q] and not far(p, q)}
    assert set(near_dup._near(col, bits, 80, 74).tolist()) == want


def test_sketches_fill_and_estimate(spark):
    codes = np.arange(1, 301, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    both = np.concatenate([codes[:1], codes[:200], codes[40:240]])
    made = near_dup.sketch(both, np.array([0, 1, 201, 401]), 400)
    assert (made != np.uint64(2**64 - 1)).all()
    assert abs((made[1] == made[2]).mean() - 160 / 240) < 0.12


# --- op2 ----------------------------------------------------------------------

ITEM = "A train leaves Paris at 9 and covers 120 km in 2 hours while Anna reads 30 pages of a long book, how far does the train go each hour?"


def test_leaks(spark):
    moved = ITEM.replace("120", "450").replace("Paris", "Oslo").replace("Anna", "Peter Smith").replace("30", "77")
    clash = "Item 5 costs 5 dollars and box 5 weighs 5 kg so the whole pile of goods in the shop must stay below the given weight for 5 days"
    rows = [
        (1, f"Before this. {ITEM} After that."), (2, moved),
        (3, "Nothing like it at all, only some other words that nobody needs to read here."), (4, None), (5, ""), (None, ITEM),
        (1, f"Before this. {ITEM} After that."),
        (6, clash.replace("Item 5", "Item 1").replace("box 5", "box 2").replace("for 5", "for 9")), (7, "word " * 30_000 + ITEM)
    ]
    bench = spark.createDataFrame(
        [(10, ITEM), (11, clash), (12, None), (13, "too short"), (None, "x"), (14, "exactly these five words match")],
        "item_id long, text string"
    )
    got = benchmark_leaks(table(spark, rows), bench).collect()
    assert {(r.doc_id, r.item_id, r.verbatim) for r in got} == {(1, 10, True), (2, 10, False), (7, 10, True)}
    short = benchmark_leaks(table(spark, [(1, "we found that exactly these five words match, yes")]), bench).collect()
    assert [(r.doc_id, r.item_id, r.share) for r in short] == [(1, 14, 1.0)]
    assert benchmark_leaks(table(spark, []), bench).count() == 0
    assert benchmark_leaks(table(spark, rows), bench.limit(0)).count() == 0


def test_leaks_of_items_without_literal_windows(spark):
    items = [
        "12 + 7 = 19, 19 * 3 = 57, 57 - 8 = 49, 49 / 7 = 7, 7 + 1 = 8, 8 * 8 = 64", "THE CAPITAL OF FRANCE IS PARIS",
        "Anna Berta Clara Dora Emma Frieda Greta Hanna Ida Jutta Klara Lena", "yes", "Answer 42", "48.8566 N 2.3522 E", "?!"
    ]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    rows = [(i, f"we looked it up and {t} is what was found there") for i, t in enumerate(items)]
    rows += [
        (20, items[0].replace("7", "6")), (21, "they said yes and yes again"), (22, "the capital of france is not paris"),
        (23, f"5 {items[0]}"), (24, f"Then Zora {items[2]} Zita left")
    ]
    got = benchmark_leaks(table(spark, rows), bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(i, i) for i in range(6)} | {(21, 3), (23, 0), (24, 2)}
    assert all(r.verbatim and r.share == 1 for r in got)


def test_leaks_of_mixed_items_count_all_their_words(spark):
    item = "please compute the sum of these for the whole year 1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16 17 18 19 20 21 22 23 24 25 26 27 28"
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = [(1, item), (2, item.replace("please compute the sum", "please print the list")), (3, item[:50])]
    assert {(r.doc_id, r.verbatim) for r in benchmark_leaks(table(spark, rows), bench).collect()} == {(1, True), (2, True)}


def test_planted_leaks_are_found_and_nothing_else(spark):
    rnd = random.Random(31)
    vocab = ["".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(4, 9))) for _ in range(900)]
    names = ["".join(rnd.choice("abcdefghijklmnop") for _ in range(6)).capitalize() for _ in range(60)]
    units_ = ["km", "kg", "hours", "dollars", "cm"]
    items, moved = [], []
    for k in range(60):
        dense = k % 3 == 0  # half numbers
        plan = [rnd.choice("wwwwnNu" if not dense else "wwnNu") for _ in range(rnd.randint(24, 40))]
        first, second, values = [], [], {}
        for kind in plan:
            if kind == "w":
                w = rnd.choice(vocab)
                first.append(w)
                second.append(w)
            elif kind == "N":
                n = rnd.choice(names)
                first.append(n)
                second.append(values.setdefault(n, names[(names.index(n) + 7) % 60]))
            else:
                n = str(rnd.randrange(2, 90))
                unit = [rnd.choice(units_)] if kind == "u" else []
                first += [n, *unit]
                second += [values.setdefault(n, str(int(n) + 100)), *unit]
        items.append("Given " + " ".join(first) + "?")
        moved.append("Given " + " ".join(second) + "?")
    prose = lambda: " ".join(rnd.choice(vocab) for _ in range(60)).capitalize() + "."
    rows = [(k, f"{prose()} {t} {prose()}") for k, t in enumerate(items)] + [
        (100 + k, f"{prose()} {t} {prose()}") for k, t in enumerate(moved)
    ] + [(200 + k, f"{prose()} {prose()}") for k in range(60)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = benchmark_leaks(table(spark, rows), bench).collect()
    found = {(r.doc_id, r.item_id) for r in got}
    assert found <= {(k, k) for k in range(60)} | {(100 + k, k) for k in range(60)}
    assert {(k, k) for k in range(60)} <= found
    assert len(found) >= 60 + 0.95 * 60
    assert all(r.verbatim for r in got if r.doc_id < 100) and not any(r.verbatim for r in got if r.doc_id >= 100)


def test_names_that_open_sentences_are_slots(spark):
    item = "Anna buys some apples at the market near her house. Anna gives a few of them to the children next door."
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = [(1, item.replace("Anna", "Maria")), (2, item.replace("Anna buys", "Maria buys")), (3, "so " + item.replace("house. ", "house, "))]
    got = {r.doc_id: r.verbatim for r in benchmark_leaks(table(spark, rows), bench).collect()}
    assert got == {1: False, 2: False, 3: True}


def test_windows_match_nested_loops():
    from tidemark.llm.decontaminate import templates, window_hashes
    import pyarrow as pa

    rnd = random.Random(5)
    texts = [" ".join(rnd.choice(["aa", "bb", "Cc", "7", "km", "dd"]) for _ in range(rnd.randint(0, 30))) for _ in range(30)]
    code, slot, bounds, *_ = templates(pa.array(texts))
    h, doc, at = window_hashes(code, slot, bounds, 6)
    want = []
    for i in range(len(texts)):
        for k in range(bounds[i], bounds[i + 1] - 5):
            if sum(slot[k + j] == 0 for j in range(6)) >= 0.3 * 6:
                want.append((i, int(k), tuple(code[k : k + 6].tolist())))
    assert [(d, a) for d, a, _ in want] == list(zip(doc.tolist(), at.tolist(), strict=True))
    by = {}
    for x, (_, _, w) in zip(h.tolist(), want, strict=True):
        assert by.setdefault(w, x) == x
    assert len(set(by.values())) == len(by)


# --- op3 ----------------------------------------------------------------------


def brute_repeats(rows, length):
    seen, out = set(), {}
    for i, t in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            s = b[k : k + length]
            if s in seen:
                gone[k : k + length] = b"\1" * length
            seen.add(s)
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out[i] = (len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest())
    return out


def test_repeats_match_brute_force(spark):
    rnd = random.Random(4)
    make = lambda n: "".join(rnd.choice("abcdé ") for _ in range(n))
    shared = [make(rnd.randint(90, 260)) for _ in range(6)]
    rows = [(0, None), (1, ""), (2, "x" * 700), (3, "ab" * 130), (4, "ab" * 130), (5, make(99)), (6, make(40))]
    rows += [(10 + k, make(rnd.randint(0, 150)) + rnd.choice(shared)[rnd.randint(0, 30) :] + make(rnd.randint(0, 80)) + rnd.choice(shared)) for k in range(80)]
    want = brute_repeats(rows, 100)
    small = {"block_bytes": 4000, "chunk_bytes": 3000, "part_bytes": 10_000}
    for options in ({}, small | {"shard_bytes": 1 << 30}, {"most_kinds": 1, "chunk_bytes": 2000}, small | {"most_kinds": 5}):
        got = repeats.repeated_bytes(table(spark, rows).repartition(3), length=100, **options).collect()
        assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == want
    texts = repeats.repeated_bytes(table(spark, rows), length=100, whole_chars=True, with_text=True).where("n_removed > 0").collect()
    assert texts and all(bytes(r.kept).decode() is not None for r in texts)
    assert repeats.repeated_bytes(table(spark, []), length=100).count() == 0
    assert [r.n_removed for r in repeats.repeated_bytes(table(spark, [(None, "y" * 300)]), length=100).collect()] == [0]


def test_repeats_around_one_anchor_in_all_documents(spark):
    rnd = random.Random(14)
    make = lambda n: "".join(rnd.choice("abcdefgh") for _ in range(n))
    for core in (make(60), make(130), "z" * 120):
        rows = [(k, make(rnd.randint(0, 70)) + core + make(rnd.choice([0, 1, 30, 70]))) for k in range(120)]
        want = brute_repeats(rows, 100)
        for options in ({"block_bytes": 2500, "chunk_bytes": 1500}, {"most_kinds": 3, "chunk_bytes": 1500}):
            got = repeats.repeated_bytes(table(spark, rows).repartition(3), length=100, **options).collect()
            assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == want


def test_words_of_one_polynomial_hash_differ():
    from tidemark.llm.words import equal_spans, span_hashes

    word = "a"
    while len(word) < 1024:
        word += word.translate(str.maketrans("ab", "ba"))
    both = word + word.translate(str.maketrans("ab", "ba"))
    data = np.frombuffer((both + "xy" + "xy" + "q" * 3000 + "q" * 3000).encode(), np.uint8)
    start = np.array([0, 1024, 2048, 2050, 2052, 5052])
    end = np.append(start[1:], len(data))
    h = span_hashes(data, start, end)
    assert h[0] != h[1] and h[2] == h[3] and h[4] == h[5] and (h != span_hashes(data, start, end, 1)).all()
    assert equal_spans(data, start[::2], start[1::2], (end - start)[::2]).tolist() == [False, True, True]


def test_suffix_arrays():
    rnd = random.Random(5)
    for _ in range(200):
        a = np.array([rnd.randint(0, rnd.choice([1, 2, 256])) for _ in range(rnd.randint(1, 90))], np.uint16)
        a = np.concatenate([a, a[: len(a) // 2]])
        t, depth = tuple(a.tolist()), rnd.choice([5, 40])
        order = repeats.suffix_array(a, depth)
        assert [t[i : i + depth] for i in order] == sorted(t[i : i + depth] for i in range(len(t)))
        shared = [0] + [
            next(
                (k for k in range(depth) if i + k >= len(t) or j + k >= len(t) or t[i + k] != t[j + k]), depth
            ) for i, j in zip(order[:-1].tolist(), order[1:].tolist(), strict=True)
        ]
        assert repeats.common_prefixes(a, order, depth).tolist() == shared


# --- op4 ----------------------------------------------------------------------


def test_urls(spark):
    good = [f"http://site{i}.example.net/en/{i}" for i in range(40)]
    bad = [f"http://www.pills{i}.net/buy/{i}" for i in range(40)]
    odd = [None, "", "no scheme", "HTTP://A.Example.COM/de/x?y#z", "x://net/", "x://net", "x://h/p#/q?r", "a://b://c/d"]
    rows = list(enumerate(good + bad + odd + ["https://www.pills99.example.com/buy/1", "https://site5.example.com/en/77", good[0]]))
    df = spark.createDataFrame([(i, u, "h", "host") for i, u in rows], "page_id long, url string, html string, host string")
    got = {r.page_id: r for r in urls.judge_urls(df).collect()}
    for i, u in rows:
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        host = re.split("[/?#]", rest, maxsplit=1)[0]
        path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0]
        host = host.translate(LOWER)
        fit = [(len(h + p), h + p, k) for k, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule = max(fit)[1:] if fit else (None, None)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule[0])
        assert rule[1] in (None, got[i].verdict)
    n = len(rows)
    assert (got[n - 3].verdict, got[n - 2].verdict) == ("block", "allow")
    assert urls.judge_urls(df.limit(0)).count() == 0


def brute_chars(urls_, order, text):
    """Witten-Bell log-likelihood of a text by dictionaries, character for character."""
    grams, contexts, kinds = Counter(), Counter(), {}
    padded = lambda u: b"\x02" * order + u.encode() + b"\x03"
    for u in urls_:
        p = padded(u)
        for k in range(order, len(p)):
            for n in range(order + 1):
                ctx = p[k - n : k]
                grams[ctx, p[k]] += 1
                contexts[ctx] += 1
                kinds.setdefault(ctx, set()).add(p[k])
    total, p = 0.0, padded(text)
    for k in range(order, len(p)):
        q = 1 / 256
        for n in range(order + 1):
            ctx = p[k - n : k]
            if contexts[ctx]:
                q = (grams[ctx, p[k]] + len(kinds[ctx]) * q) / (contexts[ctx] + len(kinds[ctx]))
        total += np.log(q)
    return total


def test_url_verdicts_match_brute_force(spark):
    rnd = random.Random(17)
    good = [f"http://s{rnd.randrange(99)}.example.net/en/{rnd.choice(['news', 'guide', 'book'])}/{rnd.randrange(50)}" for _ in range(60)]
    bad = [f"http://w{rnd.randrange(99)}.net/{rnd.choice(['win', 'pills', 'bet'])}?{rnd.randrange(50)}" for _ in range(60)]
    rest = [f"https://q{k}.example.org/{rnd.choice(['news', 'guide', 'win', 'pills', 'bet'])}/{rnd.choice(['en/', ''])}{k}" for k in range(40)]
    rows = list(enumerate(good + bad + rest))
    got = {r.page_id: r for r in urls.judge_urls(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    known = spark.createDataFrame([(u,) for u in sorted({*good, *bad})], "u string").orderBy(F.xxhash64("u"), "u").collect()
    order = [r.u for r in known]
    accepted, rejected = ([u for u in order if u in set(some)] for some in (good, bad))
    score = lambda u, a, b: (brute_chars(a, 5, u) - brute_chars(b, 5, u)) / (len(u.encode()) + 1)
    (a, a_held), (b, b_held) = (([u for i, u in enumerate(x) if i % 4], x[::4]) for x in (accepted, rejected))
    g, d = ([score(u, a, b) for u in x] for x in (a_held, b_held))
    cuts = sorted({*g, *d, 0.0})
    error = [sum(x < cut for x in g) / len(g) + sum(x >= cut for x in d) / len(d) for cut in cuts]
    limit = float(np.median([cut for cut, e in zip(cuts, error, strict=True) if e <= min(error) + 1e-12]))
    for i, u in rows:
        want = score(u, accepted, rejected)
        assert got[i].score == pytest.approx(want)
        if got[i].rule is None and abs(want - limit) > 1e-9:
            assert got[i].verdict == ("allow" if want >= limit else "block")


def test_char_model_is_a_distribution():
    import pyarrow as pa

    m = urls.train(["abcab", "abd", "b"], 3)
    end = []
    for c in range(1, 128):
        codes, size = urls._codes(pa.array(["ab" + chr(c)]), 3)
        end.append(np.exp(m.log_likelihoods(codes)[2]))
    assert 0.4 < sum(end) <= 1.0 + 1e-9


# --- op5 and op8 --------------------------------------------------------------


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_equals_the_tokenizer(name):
    e, rnd = encoder(resolve(name)), random.Random(1)
    odd = [
        "", " ", "a   b", " \n x", "x\n\ny z ", "é́ foo\tbar \x1c y", "<|endoftext|> a<|startoftext|>b", "it's I'll", "１２ ß İ ΑΣ",
        "\n", "a \n b", "ǅ ﬁ　b", "中文 字"
    ]
    for t in odd + ["".join(rnd.choice("ab.,'  \n\tÉé1 s't") for _ in range(30)) for _ in range(800)]:
        assert e.encode(t).tolist() == e.whole.encode(t, add_special_tokens=False).ids, t


def test_token_files(spark):
    rows = some_texts(20) + [(500, "long " * 20_000)]
    e, at = encoder(resolve("word_bpe_49k.json")), 0
    got = {r.doc_id: r for r in token_file_round_trip(table(spark, rows + [(None, "lost")]).repartition(4)).collect()}
    for i, t in sorted(rows):
        ids = e.whole.encode(t or "", add_special_tokens=False).ids + [2]
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert got[None].n_tokens is None
    assert token_file_round_trip(table(spark, [])).count() == 0


def test_token_stores_hold_only_listed_files(spark, tmp_path):
    from pyarrow import fs

    from tidemark.llm.token_store import RemoteArray, _sweep, store_of

    got = token_file_round_trip(table(spark, some_texts(20)), root=f"file://{tmp_path / 'store'}")
    [root] = (tmp_path / "store").iterdir()
    (root / "lost.bin").write_bytes(b"123")  # of an attempt that was lost
    listed = spark.createDataFrame([(str(p)[:-4],) for p in root.glob("*.bin") if p.name != "lost.bin"], "path string")
    _sweep(listed, f"file://{root}")
    assert got.count() == 29 and not (root / "lost.bin").exists() and len(list(root.glob("*.bin"))) >= 1
    whole = np.fromfile(next(root.glob("*.bin")), "<u2")
    ranged = RemoteArray(fs.LocalFileSystem(), str(next(root.glob("*.bin"))), np.dtype("<u2"))
    assert len(ranged) == len(whole) and (ranged[3:9] == whole[3:9]).all() and len(ranged[5:5]) == 0
    with pytest.raises(ValueError, match="pyarrow"):
        store_of("nosuch://a/b")


def test_packing(spark):
    rows = some_texts(30) + [(500, "long " * 5000), (500, "again"), (None, "no id")]
    got = packing.pack(table(spark, rows).repartition(3), capacity=128, group_rows=5).collect()
    e = encoder(resolve("byte_bpe_50k.json"))
    total = sum(len(e.whole.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in rows)
    assert sum(r.length for r in got) == total
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append(r)
        assert r.piece == 0 or r.length == 128
    for some in by.values():
        at = 0
        for r in sorted(some, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 128
    rooms = []
    for n in sorted((r.length for r in got), reverse=True):  # first fit, longest first
        k = next((k for k, room in enumerate(rooms) if room >= n), None)
        if k is None:
            rooms.append(128 - n)
        else:
            rooms[k] -= n
    assert len(by) <= len(rooms)
    assert packing.pack(table(spark, [])).count() == 0


def test_plans_place_every_piece():
    rnd = np.random.default_rng(2)
    for capacity in (1, 7, 64, 200):
        histogram = rnd.integers(0, 30, capacity + 1)
        histogram[0] = 0
        runs = packing.plan(histogram, grid=4)
        filled = Counter()
        for length in range(1, capacity + 1):
            ranks = sorted((int(a), int(b)) for k, a, b, _, _ in runs if k == length)
            assert [a for a, _ in ranks] == [0, *(b for _, b in ranks[:-1])][: len(ranks)] and (ranks[-1][1] if ranks else 0) == histogram[length]
        for k, a, b, s, o in runs.tolist():
            for i in range(b - a):
                filled[s + i] += k
        assert max(filled.values(), default=0) <= capacity


def test_token_stores_leave_other_files_alone(spark, tmp_path):
    (tmp_path / "notes.txt").write_text("keep")
    root = f"file://{tmp_path}"
    first = token_file_round_trip(table(spark, [(1, "a b"), (2, None)]), root=root)
    rows = first.collect()
    token_file_round_trip(table(spark, [(3, "c")]), root=root).collect()
    assert (tmp_path / "notes.txt").read_text() == "keep"
    assert first.collect() == rows and len(rows) == 2


# --- op6 ----------------------------------------------------------------------


def test_gif_round_trip(spark):
    rows = some_texts(10) + [(600, "é" * 30_000), (None, "n")]
    got = gif.gif_features(gif.encode_gifs(table(spark, rows))).collect()
    want = Counter()
    for i, t in rows:
        p = (t or "").encode()
        n = len(p)
        p += b"\xff" * ((-n) % 576 or (0 if n else 576))
        want[(i, n, len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-32:]))] += 1
    assert Counter((r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in got) == want
    timed = gif.gif_frames(gif.encode_gifs(table(spark, [(1, "a" * 1200)]))).orderBy("frame").collect()
    assert [(r.start_ms, r.ms, sum(r.histogram)) for r in timed] == [(0, 100, 576), (100, 100, 576), (200, 100, 576)]
    assert gif.gif_features(gif.encode_gifs(table(spark, []))).count() == 0


def lzw_by_the_book(data, min_bits):
    """One code after the other."""
    clear, bits, out = 1 << min_bits, int.from_bytes(data, "little"), b""
    table, width, last, left = None, min_bits + 1, None, 8 * len(data)
    while left >= width:
        code, bits, left = bits & (1 << width) - 1, bits >> width, left - width
        if code == clear or table is None:
            table, width, last = [bytes([i]) if i < clear else b"" for i in range(clear + 2)], min_bits + 1, None
            if code == clear:
                continue
        if code == clear + 1:
            break
        found = table[code] if code < len(table) else last + last[:1]
        if last is not None and len(table) < 4096:
            table.append(last + found[:1])
            if len(table) == 1 << width and width < 12:
                width += 1
        out, last = out + found, found
    return out


def test_lzw_streams():
    rnd = random.Random(8)
    many = [bytes(rnd.randrange(min(a, 256)) for _ in range(n)) for n in (0, 1, 2, 5, 576, 3000, 9000) for a in (2, 20, 256)] + [b"a" * 700, b"ab" * 400]
    streams = gif.lzw_encode_all(many)
    assert gif.lzw_decode_all(streams, 8) == many and [lzw_by_the_book(s, 8) for s in streams] == many
    few = [bytes(b % 4 for b in m) for m in many]
    assert gif.lzw_decode_all(gif.lzw_encode_all(few, 2), 2) == few
    for s in streams[3:]:  # cut short, and without the first clear code
        short = s[: len(s) // 2]
        assert gif.lzw_decode_all([short], 8) == [lzw_by_the_book(short, 8)]
    assert len(gif.lzw_encode_all([b"tide and time " * 41])[0]) < 576 / 2
    bad = np.packbits(np.array([[c >> k & 1 for k in range(9)] for c in (256, 65, 300, 257)], np.uint8).ravel(), bitorder="little").tobytes()
    assert gif.lzw_decode_all([bad, streams[0]], 8) == [None, b""]


def test_a_full_table_that_is_not_cleared():
    rnd = random.Random(12)
    data = bytes(rnd.randrange(256) for _ in range(12_000))
    clear, table, word, codes, free = 256, {}, b"", [], 258
    for b in data:
        longer = word + bytes([b])
        if len(longer) == 1 or longer in table:
            word = longer
            continue
        codes.append(word[0] if len(word) == 1 else table[word])
        if free < 4096:
            table[longer] = free
            free += 1
        word = bytes([b])
    codes.append(word[0] if len(word) == 1 else table[word])
    widths = gif._widths(8, len(codes) + 1).tolist()
    bits, at = clear, 9
    for c, w in zip([*codes, 257], widths, strict=True):
        bits, at = bits | c << at, at + w
    stream = bits.to_bytes(at // 8 + 1, "little")
    assert lzw_by_the_book(stream, 8) == data and gif.lzw_decode_all([stream, stream], 8) == [data, data]


def test_features_are_those_of_the_texts(spark):
    text = "Tide and time. " * 60
    got = gif.gif_features(gif.encode_gifs(table(spark, [(1, text)]))).first()
    data = text.encode() + b"\xff" * (-len(text) % 576)
    bins = Counter(((b >> 5) * 255 // 7 >> 6) << 4 | ((b >> 2 & 7) * 255 // 7 >> 6) << 2 | (b & 3) * 255 // 3 >> 6 for b in data)
    assert got.feature == "24x24 frames=2 ms=200 colours=" + " ".join(f"{b}:{n}" for b, n in sorted(bins.items()))
    assert got.media_bytes < len(data) + 13 + 768 + 19 + 1


def test_damaged_media(spark):
    good = gif.write_gif(gif.lzw_encode_all([bytes(576)]), 24, gif.palette(), 10)
    media = [None, b"", b"PNG", good[:40], good[:-30], good]
    df = spark.createDataFrame([(i, 1, m) for i, m in enumerate(media)], "id long, n_bytes long, media binary")
    got = {r.doc_id: (r.payload_bytes, r.error is None) for r in gif.gif_features(df).collect()}
    assert got[5] == (576, True) and all(got[i] == (None, False) for i in range(4))
    assert {r.id for r in gif.gif_frames(df).collect()} <= {4, 5}


def test_disposal_and_transparency():
    red, part = bytes([0] * 16), bytes([1, 2, 2, 1])
    colours = np.array([[255, 0, 0], [0, 255, 0], [0, 0, 255], [9, 9, 9]], np.uint8)
    head = b"GIF89a" + bytes([4, 0, 4, 0, 0xF1, 0, 0]) + colours.tobytes()

    def frame(left, top, side, samples, disposal, clear=None, interlaced=False):
        flags = disposal << 2 | (clear is not None)
        control = b"\x21\xf9\x04" + bytes([flags, 5, 0, clear or 0, 0])
        return control + b"\x2c" + bytes([left, 0, top, 0, side, 0, side, 0, 0x40 * interlaced]) + b"\x02" + gif._blocked(gif.lzw_encode_all([samples], 2)[0])

    data = head + frame(0, 0, 4, red, 1) + frame(1, 1, 2, part, 3, clear=2) + frame(2, 2, 2, part, 2) + frame(
        0, 0, 4, red[:0] + bytes([3] * 4 + [0] * 4 + [1] * 4 + [2] * 4), 0, interlaced=True
    ) + b"\x3b"
    w, h, frames = gif.parse_gif(data)
    gif.decode_frames(frames)
    shown = [p.copy().view(np.uint8).reshape(h, w, 4) for p, _ in gif.compose(w, h, frames)]
    assert shown[1][1, 1, :3].tolist() == [0, 255, 0] and shown[1][1, 2, :3].tolist() == [255, 0, 0]
    assert shown[2][1, 1, :3].tolist() == [255, 0, 0] and shown[2][2, 3, :3].tolist() == [0, 0, 255]
    assert [int(r[0][0]) for r in shown[3]] == [9, 0, 255, 0] and [int(r[0][2]) for r in shown[3]] == [9, 0, 0, 255]


# --- op7 ----------------------------------------------------------------------


def test_tool_calls(spark):
    calls = spark.createDataFrame(
        [
            (1, "a", None, "add", '{"y": 2, "x":1}'), (1, "b", "a", "add", '{"x":"1"}'), (1, "c", "b", "none", "{}"),
            (1, "d", "e", "add", "[1]"), (1, "e", "d", "add", "{"), (1, "f", "z", "add", '{"x":1,"x":2}'),
            (1, "a", None, "add", '{"y": 2, "x":1}'), (None, "g", None, "add", "{}"), (2, "h", "a", "add", '{"x":99,"q":null}')
        ],
        "conv_id long, call_id string, parent_id string, tool string, arguments string"
    )
    results = spark.createDataFrame(
        [(1, "a", 3, 'later "x"'), (1, "a", 2, "first\n"), (1, "zz", 1, None), (None, "a", 1, "r")],
        "conv_id long, call_id string, turn long, content string"
    )
    schemas = spark.createDataFrame([("add", "x", "integer", True, 0.0, 9.0), ("add", "y", "number", False, None, None)], chat.SCHEMA_COLUMNS)
    rows = {(r.conv_id, r.call_id, r.status): r for r in chat.link_tool_calls(calls, results, schemas).collect()}
    a = rows[(1, "a", "linked")]
    assert (a.level, a.n_results, a.valid, a.record) == (0, 2, True, '{"arguments":{"x":1,"y":2},"id":"a","result":"first\\n","tool":"add"}')
    assert (rows[(1, "b", "missing")].level, rows[(1, "b", "missing")].errors) == (1, "x isn't integer")
    assert (rows[(1, "c", "missing")].level, rows[(1, "c", "missing")].errors) == (2, "unknown tool")
    assert rows[(1, "d", "cycle")].errors == "not an object" and rows[(1, "e", "cycle")].errors == "not JSON"
    assert rows[(1, "f", "missing")].level == 0
    assert rows[(2, "h", "missing")].errors == "unknown q; x out of bounds"
    assert rows[(1, "zz", "orphan")].record == '{"id":"zz","result":null}'
    assert (None, "a", "orphan") in rows and (None, "g", "missing") in rows
    assert chat.link_tool_calls(calls.limit(0), results.limit(0), schemas).count() == 0


# --- op9 ----------------------------------------------------------------------


def test_maximal_segments():
    rnd = random.Random(6)
    for _ in range(300):
        s = [rnd.choice([-3, -2, -1, 1, 2, 3]) for _ in range(rnd.randint(0, 14))]

        def split(a, b):
            best = max(((sum(s[i:j]), -(j - i), -i, i, j) for i in range(a, b) for j in range(i + 1, b + 1)), default=None)
            if not best or best[0] <= 0:
                return []
            _, _, _, i, j = best
            return [*split(a, i), (i, j, sum(s[i:j])), *split(j, b)]

        # Of equally good ones the shortest, then the first: then Ruzzo and Tompa's definition has one answer.
        assert [(a, b, round(v)) for a, b, v in toxicity.maximal_segments(s)] == split(0, len(s))


def test_toxicity(spark):
    rnd = random.Random(11)
    plain = [f"p{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(600):
        w = [rnd.choice(plain) for _ in range(rnd.randint(20, 60))]
        if i % 6 == 0:
            at = rnd.randrange(len(w))
            w[at:at] = rnd.sample(["vile", "nasty", "rotten", "awful"], 2)
        rows.append((i, " ".join(w) + "."))
        labels.append((i, 1, int(i % 6 == 0)))
    rows += [(None, "vile nasty"), (9001, None), (9002, "")]
    lab = spark.createDataFrame([*labels, (None, 1, 1), (9001, 0, None)], "doc_id long, quality int, toxic int")
    docs = table(spark, rows)
    model = toxicity.learn_toxicity(docs, lab)
    got = toxicity.score_toxicity(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.doc_id is not None and r.doc_id < 600 and zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert sum((r.score >= 0.3) == (r.doc_id % 6 == 0) for r in held) >= 0.97 * len(held)
    text = dict(rows)
    hit = next(r for r in held if r.doc_id % 6 == 0)
    assert any(w in text[hit.doc_id][hit.passages[0].start : hit.passages[0].end] for w in ("vile", "nasty", "rotten", "awful"))
    none = toxicity.learn_toxicity(docs, lab.limit(0))
    assert toxicity.score_toxicity(docs.limit(3), none).count() == 3


# --- op10 ---------------------------------------------------------------------


def test_lm_scores(spark):
    rows = some_texts(80)
    got = {r.doc_id: r for r in lm_scores(table(spark, rows + [(None, "lost")]).repartition(3)).collect()}
    tokens = {i: [*words(t), None] for i, t in rows}
    fold = {i: zlib.crc32(str(i).encode()) % 7 for i in tokens}
    counts = Counter(w for i, t in tokens.items() if fold[i] != 2 for w in t)
    n, v = sum(counts.values()), len(counts)
    for i, t in tokens.items():
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (fold[i] == 2, len(t), sum(w in counts for w in t), n)
        assert r.base_score == pytest.approx(sum(log10((counts[w] + 1) / (n + v + 1)) for w in t))
    assert got[None].score is None and got[None].held_out
    for i, want in brute_mixture(tokens, fold).items():
        assert got[i].score == pytest.approx(want, rel=1e-9)
    held = [i for i in tokens if fold[i] == 2]
    assert sum(got[i].score for i in held) > sum(got[i].base_score for i in held)
    assert lm_scores(table(spark, [])).count() == 0


def brute_mixture(tokens, fold, rounds=60):
    """Scores by counting pairs one by one and learning the weights from each held-out token."""

    def counted(folds):
        pairs, heads, words_, total = Counter(), Counter(), Counter(), 0
        for i, t in tokens.items():
            if fold[i] in folds:
                for a, b in zip(["start", *t[:-1]], t, strict=True):
                    pairs[a, b] += 1
                    heads[a] += 1
                    words_[b] += 1
                    total += 1
        return pairs, heads, words_, total

    bucket = lambda n: min(23, int(np.log2(n + 1)))
    rough = lambda p: 2.0 ** -((np.clip(np.rint(-8 * np.log2(p)) + 1, 1, 399) - 1) / 8) if p > 0 else 0.0
    every = counted({0, 1, 3, 4, 5, 6})
    pairs, heads, words_, total = counted({0, 1, 4, 5, 6})
    types = len(every[2])
    weights = np.tile([0.5, 0.4, 0.1], (24, 1))
    seen = []
    for i, t in tokens.items():
        if fold[i] == 3:
            for a, b in zip(["start", *t[:-1]], t, strict=True):
                seen.append((bucket(heads[a]), rough(pairs[a, b] / max(heads[a], 1)), rough(words_[b] / total), 1 / (types + 1)))
    for _ in range(rounds if seen else 0):
        total_share = np.full((24, 3), 0.5)
        for b, *estimates in seen:
            share = weights[b] * np.array(estimates)
            total_share[b] += share / share.sum()
        weights = total_share / total_share.sum(axis=1, keepdims=True)
    weights[0, 0] = 0
    weights[0] /= weights[0].sum()
    pairs, heads, words_, total = every
    out = {}
    for i, t in tokens.items():
        out[i] = sum(
            log10(
                weights[bucket(heads[a])] @ [pairs[a, b] / max(heads[a], 1), words_[b] / total, 1 / (types + 1)]
            ) for a, b in zip(["start", *t[:-1]], t, strict=True)
        )
    return out


def test_mixture_weights_sum_to_one_and_follow_the_counts():
    w = learn_weights(np.zeros(0, np.int64), np.zeros(0), 10)
    assert np.allclose(w.sum(axis=1), 1) and w[0, 0] == 0
    side = 400
    code = np.array([5 * side * side + 2 * side + 90, 5 * side * side + 0 * side + 90])
    strong = learn_weights(code, np.array([900.0, 100.0]), 10**9)
    weak = learn_weights(code, np.array([100.0, 900.0]), 10**9)
    assert strong[5, 0] > 0.8 > 0.3 > weak[5, 0]
