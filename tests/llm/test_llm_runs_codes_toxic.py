"""Periodic runs, vector codes and toxic spans against plain versions, and on edge rows."""

import itertools
import random

import numpy as np
import pytest

import brute
from conftest import DATA
from pressloom.llm import codebooks, periodic, queries, toxicity


def plain(rows):
    return sorted((tuple(r) for r in rows), key=str)


def some_words(r):
    x = [r.randrange(r.choice([1, 2, 2, 3, 5, 50])) for _ in range(r.choice([0, 1, 5, 12, 30, 80, 150, 300]))]
    for _ in range(r.randrange(3)):
        if len(x) > 5:
            a, p = r.randrange(len(x)), r.randrange(1, 6 + len(x) // 5)
            for i in range(a, min(len(x), a + r.randrange(len(x)))):
                x[i] = x[a + (i - a) % p]
    return x


def test_runs_of_groups():
    r = random.Random(3)
    for _ in range(150):
        texts = [some_words(r) for _ in range(r.randrange(1, 6))]
        texts += texts[:r.randrange(3)]
        sizes = np.array([len(t) for t in texts])
        start, end, q = periodic.group_runs(np.array([v for t in texts for v in t], np.int64), sizes)
        want, at = [], 0
        for t in texts:
            want += [(s + at, s + n + at, p) for s, n, p in brute.periodic_runs(t)]
            at += len(t)
        assert list(zip(start.tolist(), end.tolist(), q.tolist())) == sorted(want, key=lambda w: (w[0], w[2]))


def test_runs_survive_wrong_hashes(monkeypatch):
    """With a tiny modulus most hashes collide; the comparison word by word asks for another one."""
    used = []
    real = periodic.Hashes

    def weak(symbols, seed):
        used.append(seed)
        if seed < 3:
            monkeypatch.setattr(periodic, "_PRIME", 3)
            made = real.__new__(real)
            made.powers, made.sums = np.ones(len(symbols) + 1, np.int64), np.zeros(len(symbols) + 1, np.int64)
            return made
        monkeypatch.setattr(periodic, "_PRIME", (1 << 31) - 1)
        return real(symbols, seed)

    monkeypatch.setattr(periodic, "Hashes", weak)
    x = [1, 2, 3] * 5 + list(range(10, 40)) + [1, 7] * 8
    start, end, q = periodic.group_runs(np.array(x), np.array([len(x)]))
    assert list(zip(start.tolist(), (end - start).tolist(), q.tolist())) == brute.periodic_runs(x)
    assert used[-1] == 3


def test_grammar_texts():
    """Fibonacci, Thue-Morse and unary words, with very many and very long runs."""
    a, b = [0], [0, 1]
    while len(b) < 400:
        a, b = b, b + a
    for x in (b, [bin(i).count("1") & 1 for i in range(512)], [4] * 500, [1, 2, 3] * 150 + [9] + [1, 2, 3] * 150):
        start, end, q = periodic.group_runs(np.array(x), np.array([len(x)]))
        assert list(zip(start.tolist(), (end - start).tolist(), q.tolist())) == brute.periodic_runs(x)


EDGE = [(None, "a b " * 20), (90001, None), (90002, ""), (90003, " \n\t"), (90004, "one"), (90005, "x " * 11), (90006, "x " * 12), (90007, "a b c d e f " * 2),
        (90008, "A a " * 9), (90009, "é ß　c " * 7), (90009, "é ß　c " * 7), (90010, "long " + "x y z " * 300), (90011, "a" * 20000)]


def test_periodic_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()]
    short = [d for d in docs if len(d[1] or "") < 6000]
    got = {r.doc_id: tuple(r) for r in queries.op11(spark, DATA).collect()}
    assert len(got) == len(docs)
    for want in brute.periodic(short):
        assert got[want[0]] == want


def test_periodic_edges(spark):
    rows = EDGE + EDGE[:3]
    df = spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id long, text string, runs int, start string").repartition(3)
    assert plain(periodic.report(df).collect()) == plain(brute.periodic(rows))
    assert periodic.report(df.limit(0)).collect() == []
    found = {r.doc_id: r for r in periodic.find_runs(df).collect()}
    assert found[90001].collapsed is None and found[90007].collapsed == "a b c d e f"


def test_periodic_groups(spark, monkeypatch):
    """Groups of texts and copies in one group do not change the result."""
    rows = [(i, " ".join(map(str, some_words(random.Random(i % 7))))) for i in range(40)]
    texts = [t.encode().split() for _, t in rows]
    whole = periodic._solve(texts)
    parts = [periodic._solve(texts[i:i + 3]) for i in range(0, 40, 3)]
    for k in range(3):
        assert whole[k].to_pylist() == [v for part in parts for v in part[k].to_pylist()]


def test_trees_assign_like_brute_force():
    rng = np.random.default_rng(0)
    for _ in range(40):
        dim, k, most = int(rng.integers(1, 5)), int(rng.integers(1, 17)), int(rng.choice([2, 5, 1000]))
        blocks = [rng.integers(-most, most, (int(rng.integers(1, 400)), dim)) for _ in range(int(rng.integers(1, 4)))]
        entries = rng.integers(-most, most, (k, dim))
        trees = [(b, codebooks.Tree(b, codebooks.depth(len(b), codebooks.LEAF))) for b in blocks]
        forest = codebooks.Forest([(b[t.order], t.levels) for b, t in trees])
        want = ((forest.points[:, None] - entries[None]) ** 2).sum(2).argmin(1)
        assert (codebooks.codes(forest, entries) == want).all()
        counts, sums = codebooks.totals(forest, entries)
        assert (counts == np.bincount(want, minlength=k)).all()
        assert all((sums[e] == forest.points[want == e].sum(0)).all() for e in range(k))


def test_trees_prune():
    """On points in tight groups most of them go to their entry as whole nodes."""
    rng = np.random.default_rng(1)
    centres = rng.integers(-4000, 4000, (16, 8))
    points = np.repeat(centres, 64, 0) + rng.integers(-20, 20, (1024, 8))
    tree = codebooks.Tree(points, codebooks.depth(len(points), codebooks.LEAF))
    forest = codebooks.Forest([(points[tree.order], tree.levels)])
    whole = sum(int((forest.end[i] - forest.start[i]).sum()) for kind, _, i in codebooks.traverse(forest, centres) if kind)
    assert whole > 900


def vectors(spark, rows):
    return spark.createDataFrame([(*r, 1, "k") for r in rows], "vec_id long, embedding array<float>, label int, x int, codes string")


def test_codes_edges(spark):
    r = random.Random(2)
    rows = [(i, [r.choice([-1.0, 0.0, 0.25, 1.5]) for _ in range(16)], r.choice([None, 0, 1])) for i in range(60)]
    rows += rows[:9] + [(None, [0.5] * 16, 3), (None, [0.5] * 16, 3), (3, [0.125] * 16, None), (100, None, 1), (101, [None] + [0.0] * 15, 1),
                        (102, [float("nan")] * 16, 1), (-5, [float("inf")] + [0.0] * 15, None), (-4, [-0.0001] * 16, 1)]
    assert plain(codebooks.report(vectors(spark, rows).repartition(3)).collect()) == plain(brute.codebooks(rows))
    few = rows[:5]
    assert plain(codebooks.report(vectors(spark, few)).collect()) == plain(brute.codebooks(few))
    assert codebooks.report(vectors(spark, rows).limit(0)).collect() == []
    assert codebooks.report(vectors(spark, [(1, None, 1)])).collect() == []


def test_codes_query(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").select("vec_id", "embedding", "label").collect()][:200]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(2)
    assert plain(codebooks.report(df).collect()) == plain(brute.codebooks(rows))
    with pytest.raises(Exception, match="agree in length"):
        codebooks.report(vectors(spark, [(1, [0.5] * 16, 1), (2, [0.5] * 8, 1)]).coalesce(1)).collect()


def test_recursions_are_exact():
    rng = np.random.default_rng(1)
    for _ in range(40):
        n = int(rng.integers(1, 7))
        energy, tags = rng.normal(0, 3, n), np.array([0, *rng.normal(0, 2, 4)])
        total = np.zeros((n, 2))
        for ys in itertools.product([0, 1], repeat=n):
            w = sum(energy[i] for i in range(n) if ys[i]) + (tags[1] if ys[0] else 0)
            w += sum({(0, 0): 0, (0, 1): tags[2], (1, 0): tags[3], (1, 1): tags[4]}[pair] for pair in zip(ys, ys[1:]))
            for i in range(n):
                total[i, ys[i]] += np.exp(w)
        forward, backward = toxicity.recursions(np.tile(energy, 2), np.tile([True] + [False] * (n - 1), 2), tags)
        assert np.allclose(forward + backward, np.tile(np.log(total[:, 1] / total[:, 0]), 2), atol=1e-7)


def test_toxicity_held_out(spark):
    """On the documents that no label was read for; labels of some documents are wrong, as not all toxic ones hold a toxic word."""
    path = DATA.rsplit("/", 1)[0] + "/sf0.1"
    got = {r.doc_id: r for r in queries.op13(spark, path).collect()}
    labels = [(r.doc_id, r.toxic) for r in spark.read.parquet(f"{path}/labels.parquet").where("toxic IS NOT NULL").collect()]
    held = [(got[d], y) for d, y in labels if d in got and got[d].held_out]
    assert len(held) > 500
    caught = [r.predicted for r, y in held if y == 1]
    wrong = [r.predicted for r, y in held if y == 0]
    assert sum(caught) >= 0.88 * len(caught) and sum(wrong) <= 0.01 * len(wrong)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    assert all(r.held_out == (brute.zlib.crc32(str(d).encode()) % 4 == 2) for d, r in got.items())


def test_toxicity_reads_no_held_out_label(spark):
    docs, labels = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")
    flipped = labels.selectExpr("doc_id", "quality", "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 4 = 2 THEN 1 - toxic ELSE toxic END AS toxic")
    one, two = (toxicity.held_out_report(docs, x).select("doc_id", "score").collect() for x in (labels, flipped))
    assert plain(one) == plain(two)


def test_toxicity_spans_and_edges(spark):
    r = random.Random(4)
    plain_words = [f"w{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(600):
        words = [r.choice(plain_words) for _ in range(40)]
        if i % 4 == 0:
            for _ in range(4):
                words[r.randrange(40)] = r.choice(["rotter", "knave,", "Scoundrel"])
        rows.append((i, " ".join(words)))
        labels += [(i, int(i % 4 == 0), 1)]
    labels += [(None, 1, 1), (5000, None, 1), (0, None, 0), (0, 0, 0)]
    edge = [(None, "w1 rotter"), (9001, None), (9002, ""), (9003, " \n"), (9004, "ein  Rotter, knave w2\né scoundrel!"), (9004, "w1 w2"), (9005, "w5 " * 30000), (9006, "w" * 50000)]
    df = spark.createDataFrame([(*x, 1.0, "k") for x in rows + edge], "doc_id long, text string, score double, spans string").repartition(3)
    marks = spark.createDataFrame(labels, "doc_id long, toxic int, y int")
    model = toxicity.learn(*toxicity.draw(df, marks))
    found = {(x.doc_id, x.score): x for x in toxicity.score(df, model).collect()}
    by = {}
    for x in found.values():
        by.setdefault(x.doc_id, []).append(x)
    text = edge[4][1]
    hit = max(by[9004], key=lambda x: x.score)
    assert [text[s.start:s.end] for s in hit.spans] == ["Rotter, knave", "scoundrel!"]
    assert hit.score > 0.3 and min(x.score for x in by[9004]) < 0.3
    assert by[9001][0].score == by[9002][0].score == by[9003][0].score < 0.3
    assert by[9005][0].score < 0.3 and by[9006][0].spans == []
    assert toxicity.held_out_report(df.limit(0), marks).collect() == []
    # Without labels of both classes the score is the share of toxic ones.
    for only, want in (([(1, 0, 1)], 0.0), ([(1, 1, 1)], 1.0), ([], 0.0)):
        some = toxicity.held_out_report(df, spark.createDataFrame(only, "doc_id long, toxic int, y int")).collect()
        assert len(some) == len(rows + edge) and all(abs(x.score - want) < 1e-9 for x in some)
