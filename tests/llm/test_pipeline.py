"""The corpus pipeline stage by stage on planted cases."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import queries

NASTY = ["vile", "nasty", "rotten", "awful"]


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    rnd = random.Random(21)
    vocab = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(3, 8))) for _ in range(2500)]
    prose = lambda n: " ".join(rnd.choice(vocab) for _ in range(n)).capitalize() + "."
    rows, labels, kind = [], [], {}
    for i in range(400):
        t = prose(rnd.randint(30, 90))
        if i % 5 == 0:
            w = t.split(" ")
            w[7:7] = rnd.sample(NASTY, 3)
            t, kind[i] = " ".join(w), "toxic"
        rows.append((i, t))
        labels.append((i, 1, int(i % 5 == 0)))
    shared, item = prose(60), prose(40)
    base = prose(120)
    for k in range(6):
        w = base.split(" ")
        w[20 + k] = vocab[k]
        rows.append((1000 + k, " ".join(w)))
        kind[1000 + k] = "near"
    for k in range(5):
        rows.append((2000 + k, f"{prose(50)} {shared} {prose(50)}"))
        kind[2000 + k] = "shared"
    rows += [(3000, f"{prose(60)} {item} {prose(60)}"), (3001, ""), (3002, None)]
    d = tmp_path_factory.mktemp("planted")
    spark.createDataFrame(
        [(i, t, "en", "src0", len(t or "")) for i, t in rows],
        "doc_id long, text string, lang string, source string, n_chars long"
    ).write.parquet(str(d / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(d / "labels.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(d / "benchmark.parquet"))
    return str(d), dict(rows), kind, shared


def test_stages(spark, planted, tmp_path):
    sf_dir, text, kind, shared = planted
    docs, seen = spark.read.parquet(f"{sf_dir}/documents.parquet"), {}
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "suffix_array_dedup", "decontamination", "packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == columns
        seen[name] = {r.doc_id: r.text for r in docs.collect()}
    toxic = {i for i, k in kind.items() if k == "toxic"}
    clean = set(text) - toxic
    assert len(toxic & set(seen["toxicity"])) <= 0.03 * len(toxic) and len(clean - set(seen["toxicity"])) <= 0.01 * len(clean)
    near = {i for i, k in kind.items() if k == "near"}
    assert near & set(seen["near_dedup"]) == {1000} and set(seen["toxicity"]) - set(seen["near_dedup"]) <= near | {3002, 3001}
    cut = seen["suffix_array_dedup"]
    assert shared in cut[2000] and not any(shared[40:-40] in cut[i] for i in range(2001, 2005))
    assert all(cut[i] == text[i] for i in cut if i not in kind)
    assert set(cut) - set(seen["decontamination"]) == {3000}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == set(seen["decontamination"])


def test_repeated_rows_are_cut_by_row(spark, tmp_path):
    rnd = random.Random(5)
    long = lambda: "".join(rnd.choice("abcdefghij ") for _ in range(300))
    twice, first, second, tail, lone = long(), long(), long(), long(), long()
    rows = [(7, twice), (7, twice), (1, first), (2, second), (9, f"{first} one"), (9, f"{second} two"), (None, tail), (None, f"{tail} more"), (8, lone)]
    docs = spark.createDataFrame([(i, t, "en", "src0", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.repeat_removal(spark, docs.repartition(4), str(tmp_path))
    assert got.columns == docs.columns
    found = [(r.doc_id, r.text, r.n_chars) for r in got.collect()]
    assert sorted((i, t) for i, t, _ in found if i is not None) == sorted([(7, twice), (1, first), (2, second), (8, lone), (9, " one"), (9, " two")])
    assert sorted(len(t) for i, t, _ in found if i is None) in ([5, 300], [305]) and all(n == len(t) for _, t, n in found)


def test_stages_judge_rows_of_null_and_repeated_ids(spark, planted, tmp_path):
    sf_dir, text, kind, _ = planted
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").first().text
    vile = " ".join(NASTY * 5)
    clean, base, far = text[1], text[1000], text[2]

    def left(stage, rows):
        more = spark.createDataFrame([(i, t, "en", "src0", len(t)) for i, t in rows], docs.schema)
        some = docs.where("doc_id < 400").union(more) if stage is corpus_pipeline.toxicity else more
        got = stage(spark, some, sf_dir)
        assert got.columns == docs.columns
        return sorted((r.doc_id or -1, r.text) for r in got.where("doc_id is null or doc_id >= 5000").collect())

    assert left(corpus_pipeline.toxicity, [(None, vile), (None, clean), (5000, vile), (5000, clean)]) == [(-1, clean), (5000, clean)]
    assert left(
        corpus_pipeline.near_dedup, [(None, base), (5000, base), (5000, base), (5000, far), (5001, far), (None, clean)]
    ) == sorted([(5000, base), (5000, far), (-1, clean)])
    assert left(corpus_pipeline.decontamination, [(None, item), (None, clean), (5000, f"{far} {item}"), (5000, far)]) == [(-1, clean), (5000, far)]


def test_odd_tables(spark, planted):
    sf_dir = planted[0]
    schema = "doc_id long, text string, lang string, source string, n_chars long, _row string, _kept string, kept int"
    rnd = random.Random(3)
    long = " ".join(f"w{rnd.randrange(10**6)}" for _ in range(30_000))
    rows = [(1, long), (1, long), (2, None), (3, ""), (None, None), (None, ""), (4, "one"), (4, "one")]
    odd = spark.createDataFrame([(i, t, "en", "s", None, "r", "k", 5) for i, t in rows], schema)
    for docs in (odd, odd.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            got = stage(spark, docs, sf_dir)
            assert got.columns == docs.columns, name
            found = sorted(((r.doc_id is None, r.doc_id, r.text is None, len(r.text or ""), r._row, r._kept, r.kept) for r in got.collect()), key=str)
            if docs is odd and name in ("near_dedup", "suffix_array_dedup"):
                assert sum(not no_id and i == 1 for no_id, i, *_ in found) == 1, name  # of equal rows one stays
            if docs is odd:
                assert sum(no_id for no_id, *_ in found) == 2 and all(x[-3:] == ("r", "k", 5) for x in found)
        packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
        assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0


def test_run_equals_its_stages(spark, planted):
    sf_dir = planted[0]
    got = corpus_pipeline.run(spark, sf_dir)
    assert got.agg(F.max("offset")).first()[0] < 2048 and got.count() > 300


def test_queries_are_registered():
    import __spark_entry__ as e

    found = set(e.queries())
    assert {f"op{n}_" for n in range(1, 11)} <= {q.split("_")[0] + "_" for q in found} and "pipeline" in found
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)
