"""Operators 11 to 13 against brute force: nulls, ties, repeats, hot groups, odd and empty tables, damaged archives."""

import base64
import gzip
import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import hard_negatives, warc
from tidemark.llm.hard_negatives import best_of_rows, fitted, mine_hard_negatives, quantised
from tidemark.llm.prefix_trie import id_list_hashes, numbered_turns, prefix_trie, spliced_trie
from tidemark.llm.scratch import Scratch

# --- op11 ---------------------------------------------------------------------


def trie_of(convs):
    """Nodes of {conv: [(role, text)]} by brute force."""
    members = defaultdict(set)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].add(c)
    out = []
    for k, m in members.items():
        under = [x for x in members if x[: len(k)] == k]
        child = lambda x: [y for y in members if len(y) == len(x) + 1 and y[: len(x)] == x]
        ends = ",".join(str(c) for c in sorted(c for c in m if len(convs[c]) == len(k)))
        out.append(
            (
                min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(child(k)), sum(not child(x) for x in under),
                sum((len(members[x]) - 1) * len(x[-1][1].encode()) for x in under if x), hashlib.sha256(ends.encode()).hexdigest()
            )
        )
    return Counter(out)


def rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own[c].append(((turn is not None, turn or 0, digest), (role, text)))
    own = {c: [t for _, t in sorted(x, key=lambda y: y[0])] for c, x in own.items()}
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + own[c][h:]
    return out


NODE = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
TURNS = "conv_id long, turn long, role string, text string, digest string, conv int, pos string"


def some_conversations(seed, n=60, longest=12):
    rnd = random.Random(seed)
    rows = []
    for c in rnd.sample(range(200), n):
        rows += [(c, t if rnd.random() < 0.9 else None, rnd.choice(["user", "assistant", None]), rnd.choice(["a", "ü b", "", None])) for t in range(rnd.randint(1, longest))]
    rows += rows[:5]  # repeated rows
    rows += [(None, 1, "user", "x"), (300, 0, "user", "y" * 100_000)]
    return rows


@pytest.mark.parametrize("fan", [3, 4096])
def test_trie_matches_brute_force(spark, fan):
    rows = some_conversations(4)
    turns = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], TURNS)
    got = Counter(tuple(r) for r in spliced_trie(turns, fan).select(NODE).collect())
    assert got == trie_of(rebuilt(rows))


def test_trie_of_a_long_conversation_and_turnless_ones(spark):
    """Chains of blocks of blocks: 90 turns in blocks of 3, which several conversations share in part."""
    rnd = random.Random(1)
    base = [("user", rnd.choice("abc")) for _ in range(90)]
    convs = {7: base, 8: base[:81], 9: base[:40] + [("user", "z")], 10: base, 11: base[:27], 12: []}
    rows = [(c, t, *x) for c, turns in convs.items() for t, x in enumerate(turns)]
    scratch = Scratch(spark, "test")
    turns = numbered_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), scratch)
    found = prefix_trie(turns, spark.createDataFrame([(c,) for c in convs], "conv long"), scratch, fan=3)
    assert Counter(tuple(r) for r in found.select(NODE).collect()) == trie_of(convs)


def test_trie_of_odd_tables(spark):
    assert spliced_trie(spark.createDataFrame([], TURNS)).count() == 0
    only = [(3, None, None, None, "x", 1, "y")]
    [root, *rest] = spliced_trie(spark.createDataFrame(only, TURNS)).orderBy("depth").select(NODE).collect()
    h = zlib.crc32(b"3") % 9  # conversation 0 isn't there, so the turn stays only if h is 0
    assert (root.conv_id, root.n_convs, root.parent_conv_id, len(rest)) == (3, 1, None, int(h == 0))


def test_places_hold_across_partitions(spark):
    """One conversation in many partitions, in order of turn."""
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        rows = [(1, t, "user", str(t)) for t in range(2000)] + [(2, 5, "user", "a"), (0, 5, "user", "b")]
        random.Random(2).shuffle(rows)
        df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
        got = numbered_turns(df, Scratch(spark, "test")).where("conv = 1").orderBy("pos").collect()
        assert [r.pos for r in got] == list(range(1, 2001))
        assert [bytes(r.leaf) for r in got] == [hashlib.sha256(f"4:user{t}".encode()).digest() for t in range(2000)]
        many = spark.range(5000).select(F.lit(b"k").alias("digest"), F.col("id").alias("conv"))
        [one] = id_list_hashes(many).collect()
        assert one.ends_sha256 == hashlib.sha256(",".join(map(str, range(5000))).encode()).hexdigest()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


# --- op12 ---------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int, row string, list int, score long"


def mined(rows):
    """Brute force over (vec_id, embedding, label), in Python integers."""
    rows = [r for r in dict.fromkeys((i, None if v is None else tuple(v), y) for i, v, y in rows)]
    items = []
    for i, v, y in rows:
        if i is None or y is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        items.append((i, (y + 1) % 10 if i % 7 == 0 else y, [math.floor(256 * x) for x in v]))
    out = []
    for a in items:
        if a[0] % 100:
            continue
        scored = sorted(((-sum(p * q for p, q in zip(a[2], b[2], strict=False)), b[0], b[1]) for b in items if b is not a), key=lambda x: x[:2])
        for s, pos, _ in [x for x in scored if x[2] == a[1]][:5]:
            fit = [x for x in scored if x[2] != a[1] and 80 * -s <= 100 * -x[0] <= 100 * -s][:5]
            out += [(a[0], pos, k, x[1], -s, -x[0]) for k, x in enumerate(fit, 1)]
    return sorted(out)


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, y, "x", 1, 2) for i, v, y in rows], VECTORS)


def some_vectors(n, seed, dim=6):
    rnd = np.random.default_rng(seed)
    rows = [(i, [float(np.float32(x)) for x in rnd.normal(0, 0.3, dim)], int(rnd.integers(10))) for i in range(n)]
    hot = rows[3][1]
    return rows + [(n + i, hot, int(i % 3)) for i in range(n // 2)]  # a third of all rows have one vector: ties everywhere


def test_hard_negatives_match_brute_force(spark, monkeypatch):
    rows = some_vectors(420, 1)
    monkeypatch.setattr(hard_negatives, "ROUNDS", (2, 5, 1024))
    monkeypatch.setattr(hard_negatives, "BLOCK", 50)
    got = sorted(tuple(r) for r in mine_hard_negatives(quantised(vectors(spark, rows))).collect())
    assert got == mined(rows)
    assert len(got) > 50


def test_hard_negatives_of_odd_rows(spark):
    rows = some_vectors(230, 5)
    rows += [(100, None, 1), (200, [0.1] * 6, None), (None, [0.1] * 6, 1), (300, [0.1, None] + [0.2] * 4, 2), (400, [float("nan")] * 6, 2)]
    rows += [(500, [float("inf")] * 6, 2), (600, [0.5, 0.25], 3), (601, [], 3), (602, [2e4] * 6, 3), (700, [-0.5] * 6, 3)]
    rows += rows[:40]  # alike: once
    got = sorted(tuple(r) for r in mine_hard_negatives(quantised(vectors(spark, rows))).collect())
    assert got == mined(rows)
    assert mine_hard_negatives(quantised(vectors(spark, []))).count() == 0
    assert mine_hard_negatives(quantised(vectors(spark, [(1, [0.5], 1), (2, [0.5], 1)]))).count() == 0


def test_best_of_rows_breaks_ties_to_the_left():
    rnd = np.random.default_rng(0)
    for scale in (3, 1 << 61):
        scores = rnd.integers(-2, 3, (20, 30)) * scale
        allowed = rnd.random((20, 30)) < 0.5
        i, j = best_of_rows(scores, allowed, 5)
        for r in range(20):
            want = sorted((c for c in range(30) if allowed[r, c]), key=lambda c: (-int(scores[r, c]), c))[:5]
            assert sorted(j[i == r].tolist()) == sorted(want)


def test_bounds_let_queries_stop(spark):
    """On clustered vectors most lists are never visited."""
    rnd = np.random.default_rng(2)
    centres = rnd.normal(0, 200, (40, 8))
    rows = (centres[rnd.integers(0, 40, 4000)] + rnd.normal(0, 2, (4000, 8))).astype(np.int64)
    cents = fitted(rows[:1000], 40)
    near = hard_negatives.nearest(rows.astype(float), cents)
    far = np.sqrt(((rows - cents[near]) ** 2).sum(1))
    radius = np.array([far[near == c].max(initial=-1) for c in range(len(cents))])
    q = rows[0].astype(float)
    kth = np.sort(rows @ rows[0])[-5]
    up = q @ cents.T + np.sqrt(q @ q) * radius
    assert (up >= kth).sum() < 10
    assert ((rows @ rows[0]) <= up[near] + 1e-6).all()


# --- op13 ---------------------------------------------------------------------

PAGES = "page_id long, url string, html string, key string, kind string, refers_to int"


def archived(rows, least=0):
    """Pages by brute force: (page_id, bytes, digest, type, refers_to)."""
    groups = defaultdict(list)
    for i, _, html in rows:
        groups[html or ""].append(i)
    out = []
    for i, _, html in rows:
        body = (html or "").encode()
        top = max(groups[html or ""], key=lambda x: (x is not None, x or 0))
        again = len(body) >= least and i != top
        out.append((i, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "revisit" if again else "response", top if again else None))
    return Counter(out)


def pages(spark, rows):
    return spark.createDataFrame([(*r, "k", "x", 5) for r in rows], PAGES)


FIELDS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


@pytest.mark.parametrize("least", [0, 3])
def test_archives_match_brute_force(spark, least, monkeypatch):
    monkeypatch.setattr(warc, "ROLL", 2000)
    rnd = random.Random(3)
    html = ["", None, "é", "x" * 200_000, "<p>WARC/1.1\r\n\r\nContent-Length: 3</p>", "ab"] + [f"page {k}" for k in range(10)]
    rows = [(i, rnd.choice(["http://a.example/x y?q=1", None, "no scheme", "http://[bad", "a\r\nWARC-Type: fake"]), rnd.choice(html)) for i in range(80)]
    rows += [(100 + i, "http://hot.example/", "the same") for i in range(60)]
    found = warc.warc_round_trip(pages(spark, rows).repartition(5), least=least)
    assert Counter(tuple(r) for r in found.select(FIELDS).collect()) == archived(rows, least)
    assert found.where("error is not null").count() == 0


def test_archives_of_odd_tables(spark):
    assert warc.warc_round_trip(pages(spark, [])).count() == 0
    rows = [(None, "u", "same"), (4, "u", "same"), (4, "v", "same"), (4, "v", "other"), (None, None, None)]
    got = Counter(tuple(r) for r in warc.warc_round_trip(pages(spark, rows)).select(FIELDS).collect())
    sha = lambda t: base64.b32encode(hashlib.sha1(t.encode()).digest()).decode()
    assert got == Counter(
        [
            (4, 4, sha("same"), "response", None), (4, 4, sha("same"), "revisit", 4), (None, 4, sha("same"), "revisit", 4),
            (4, 5, sha("other"), "response", None), (None, 0, sha(""), "response", None)
        ]
    )


def plain_record(kind, rid, block, *headers):
    head = [f"WARC/1.0\r\nWARC-Type: {kind}", f"WARC-Record-ID: {rid}", *headers, f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def test_records_meet_through_identifiers_either_way(spark, tmp_path):
    http = "Content-Type: application/http"
    body = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n4\r\nWiki\r\n5;x=1\r\npedia\r\n0\r\n\r\n"
    data = plain_record("response", "<r1>", body, http, "WARC-Concurrent-To: <q1>")  # names its request
    data += plain_record("request", "<q1>", b"GET / HTTP/1.1\r\n\r\n", http)
    data += plain_record("metadata", "<m1>", b"a: 1\r\nb: 2\r\n", "Content-Type: application/warc-fields", "WARC-Concurrent-To: <q1>")  # names the request alone
    data += plain_record("request", "<q2>", b"GET / HTTP/1.1\r\n\r\n", http, "WARC-Concurrent-To: <none>")  # of no capture
    data += plain_record("resource", "<s1>", b"bytes")
    data += plain_record("request", "<q4>", b"", http, "WARC-Concurrent-To: <s1>") + plain_record("request", "<q3>", b"", http, "WARC-Concurrent-To: <s1>")
    files = []
    for name, content in {"plain.warc": data, "whole.warc.gz": gzip.compress(data)}.items():
        (tmp_path / name).write_bytes(content)
        files.append((f"file://{tmp_path / name}",))
    for f in files:
        found = warc.read_records(spark.createDataFrame([f], "path string"), with_payload=True)
        rows = warc.transactions(found, Scratch(spark, "test")).collect()
        by = {r.record_id: r for r in rows if r.record_id}
        assert (bytes(by["<r1>"].payload), by["<r1>"].request.record_id, by["<r1>"].metadata.record_id) == (b"Wikipedia", "<q1>", "<m1>")
        assert {x.key: x.value for x in by["<r1>"].metadata.fields} == {"a": "1", "b": "2"}
        assert (by["<s1>"].request.record_id, by["<s1>"].n_requests, by["<s1>"].n_metadata, by["<s1>"].payload_bytes) == ("<q3>", 2, 0, 5)
        assert [r.request.record_id for r in rows if not r.record_id] == ["<q2>"]


def test_damaged_archives_say_so(spark, tmp_path):
    good = b"".join(warc.page_records(1, 1, "http://a.example/", b"text", None, "2024-01-01T00:00:00Z"))
    wrong = gzip.compress(plain_record("response", "<w>", b"HTTP/1.1 200 OK\r\n\r\nabc", "Content-Type: application/http", f"WARC-Payload-Digest: sha1:{warc.digest(b'abd')}"))
    cases = {"cut.warc.gz": good + good[:-150], "junk.warc": b"no archive at all\r\n\r\n", "wrong.warc.gz": wrong + good, "empty.warc.gz": b"", "bits.warc.gz": good + b"\x1f\x8bxxxx"}
    for name, content in cases.items():
        (tmp_path / name).write_bytes(content)
    rows = warc.read_records(spark.createDataFrame([(f"file://{tmp_path / n}",) for n in cases], "path string")).collect()
    by = defaultdict(list)
    for r in sorted(rows, key=lambda r: r.number):
        by[r.path.rpartition("/")[2]].append((r.kind, r.error))
    fine = [("request", None), ("response", None), ("metadata", None)]
    assert by["cut.warc.gz"][:3] == fine
    assert by["cut.warc.gz"][-1][1] is not None
    assert by["junk.warc"] == [(None, "not a record header")]
    assert by["wrong.warc.gz"] == [("response", "the payload isn't that of its digest"), *fine]
    assert "empty.warc.gz" not in by
    assert by["bits.warc.gz"][:3] == fine
    assert "unpacked" in by["bits.warc.gz"][-1][1]
    broken = warc.transactions(warc.read_records(spark.createDataFrame([(f"file://{tmp_path / 'junk.warc'}",)], "path string")), Scratch(spark, "test")).collect()
    assert [r.error for r in broken] == ["not a record header"]
