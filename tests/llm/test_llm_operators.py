"""Every operator against its plain version, on the smallest tables and on edge rows."""

import collections
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from conftest import DATA
from pressloom.llm import components, decontaminate, hmm, langid, mixing, neardup, pii, quality, queries, secrets, spans, warc
from pressloom.llm.boosting import fit, fit_rows, threshold, thresholds

EDGE = [
    (90001, None), (90002, ""), (90003, " \n"), (90004, "a b"), (90005, "A  B"), (90006, "a b c a b c"), (90007, "x y z " * 20000),
    (90008, "x y z " * 19999), (None, "a b"), (None, "nothing else is like it"), (None, None), (90009, "a a a a a"), (90010, "é😀 ß"),
]


def plain(rows):
    return sorted((tuple(r) for r in rows), key=str)


@pytest.fixture(scope="module")
def docs(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def bench(spark):
    return [(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]


@pytest.fixture(scope="module")
def mixed(spark, docs):
    """Documents, edge rows and repeated rows, with columns whose names clash with results."""
    rows = docs[:120] + EDGE + docs[:5]
    named = spark.createDataFrame([(d, t, 1, "k") for d, t in rows], "doc_id long, text string, n_words int, kept string")
    return rows, named.repartition(3)


def test_contamination(spark, docs, bench):
    assert plain(queries.op2(spark, DATA).collect()) == plain(brute.contamination(docs, bench))


@pytest.mark.parametrize("block", [2 << 20, 1500])
def test_contamination_edges(spark, mixed, bench, block):
    items = bench + [(None, "nothing else"), (77, "x y"), (78, "z"), (79, None), (80, ".."), (81, bench[0][1])]
    rows, df = mixed
    rows = rows + [(91000, "begin " + bench[0][1] + " end")]
    df = df.unionByName(spark.createDataFrame([(*rows[-1], 1, "k")], df.schema))
    table = spark.createDataFrame(items, "item_id long, text string")
    want = brute.contamination(rows, items)
    assert plain(decontaminate.report(df, table, block_bytes=block).collect()) == plain(want)
    clean = decontaminate.drop_contaminated(df, table, block_bytes=block)
    assert clean.columns == df.columns and clean.count() == sum(not w[-1] for w in want)


def test_wu_manber_finds_all():
    random.seed(5)
    for _ in range(200):
        items = [(i, " ".join(random.choices("abcd", k=random.randint(1, 9))).encode()) for i in range(4)]
        text = " ".join(random.choices("abcde", k=80))
        got = decontaminate.search(decontaminate.build_searches(items, 4), text.encode().split())
        want = brute.contamination([(0, text)], [(i, t.decode()) for i, t in items], 4)[0]
        assert (sum(e - s for s, e in got[0]), len(got[1])) == want[2:4]


def test_archives(spark):
    pages = [(r.page_id, r.html) for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()]
    assert plain(queries.op3(spark, DATA).collect()) == plain(brute.archive(pages))


@pytest.mark.parametrize("chunk", [1 << 20, 777])
def test_archive_edges(spark, chunk):
    big = "é<p>" * 30000
    rows = [(1, "a\nb", None), (2, None, ""), (3, "u", "same"), (4, "u", "same"), (5, "u", "same"), (5, "u", "same"), (None, "u", "same"),
            (None, "v", "alone"), (6, "w", big), (7, "w", big), (8, "x", big + "!"), (9, "y", "\r\n\r\nWARC/1.1\r\n")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, sha1 string").repartition(2)
    assert plain(warc.report(df, chunk=chunk).collect()) == plain(brute.archive([(p, h) for p, _, h in rows]))
    assert warc.report(df.limit(0)).count() == 0


def test_archive_chunks_carry_running_digests(spark):
    import hashlib
    body = "0123456789" * 100
    df = spark.createDataFrame([(1, "u", body), (2, "u", "z")], "page_id long, url string, html string")
    listed = warc.write_archives(warc.chunk_rows(df, chunk=64), warc.archive_folder(spark), roll=1)
    assert listed.agg({"records": "sum"}).collect()[0][0] == 2
    found = warc.read_archives(listed, chunk=64).where("record_id = '<urn:page:1>'").orderBy("chunk_no").collect()
    assert b"".join(r.data for r in found) == body.encode()
    assert [r.sha1_so_far for r in found] == [hashlib.sha1(body.encode()[:r.bytes_so_far]).hexdigest() for r in found]


def test_mix(spark):
    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    size, target = brute.targets(rows)
    source = {d: s for d, _, s in rows}
    found = queries.op4(spark, DATA).collect()
    taken = collections.Counter()
    for r in found:
        s = source[r.doc_id]
        assert r.source_size == size[s] and r.target == pytest.approx(target[s])
        assert r.taken <= 2 * r["size"] and (r["size"] == 0 or r.taken % r["size"] == 0)
        taken[s] += r.taken
    assert sum(taken.values()) == pytest.approx(1.5 * sum(size.values()), rel=0.1)
    assert plain(found) == plain(queries.op4(spark, DATA).collect())


def test_mix_edges(spark):
    rows = [(i, "w " * (i % 7), None if i % 3 == 0 else "s" if i % 3 == 1 else "null", 5) for i in range(300)]
    rows += [(None, "a b c", "null", 1), (None, None, "empty", 1), (1000, "", "empty", None)] + rows[:4]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, copies int").repartition(3)
    size, target = brute.targets([r[:3] for r in rows])
    found = mixing.mix_report(df).collect()
    assert len(found) == len(rows)
    assert {(r.source_size, round(r.target, 6)) for r in found} == {(size[s], round(target[s], 6)) for s in size}
    out = mixing.mix(df)
    assert out.columns == ["doc_id", "text", "source", "copies", "copy_no"]
    assert sum(len((r.text or "").split()) for r in out.collect()) == sum(r.taken for r in found)
    assert mixing.mix_report(df.limit(0)).count() == 0
    taken = df.select("doc_id", "text", "source", *[F.lit(7).alias(n) for n in ("_rt", "_salt", "_SS", "_tg", "_key", "_rate", "_total", "_target", "rate", "size", "copies", "Copy_No")])
    named = mixing.mix(taken)
    assert named.columns == [*taken.columns, "copy_no_"] and named.count() == out.count()
    assert named.select("_rt", "_salt", "_SS").distinct().collect() == [(7, 7, 7)]


def test_personal_data(spark, docs):
    for r in queries.op5(spark, DATA).collect():
        want = brute.personal(dict(docs)[r.doc_id])
        assert r.base_sha256 == brute.sha(want) and set(want.split(",")) <= set(r.spans.split(",")) | {""}


def test_personal_data_fuzz():
    random.seed(1)
    for _ in range(4000):
        text = "".join(random.choices("ab1.@+-9 0(:)%é", k=random.randint(0, 60)))
        assert pii.listed(sorted(pii.base_spans(text))) == brute.personal(text), text


def test_pii_very_long_digit_runs(spark):
    """Numbers of thousands of digits are compared without being read as numbers."""
    texts = ["1.2.3." + "0" * 5000 + "1", "1.2.3." + "9" * 5000, "000.00.0." + "0" * 9000, "4" * 20000, "+" + "1" * 20000, "a" * 20000 + "@b.c"]
    for text in texts:
        assert pii.listed(sorted(pii.base_spans(text))) == brute.personal(text)
    found = pii.report(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert [r.n_ip for r in sorted(found, key=lambda r: r.doc_id)] == [1, 0, 1, 0, 0, 0]

def test_personal_data_edges(spark, mixed):
    rows, df = mixed
    found = pii.report(df).collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(d) for d, _ in rows)
    assert sum(r.n_email for r in found) == sum(brute.personal(t).count("email") for _, t in rows)
    assert pii.report(df.limit(0)).count() == 0


def test_personal_data_method_adds(spark):
    random.seed(2)
    texts = []
    for i in range(400):
        number = f"({random.randint(200, 999)}) 555-{random.randint(1000, 9999)}"
        texts.append((i, f"call phone +1 {number} please"))
        texts.append((1000 + i, f"part {random.randint(1, 99)}.{random.randint(1, 99)} of {random.randint(100, 999)}-{random.randint(10, 99)}-{random.randint(1000, 99999)}"))
    df = spark.createDataFrame([*texts, (5000, "phone 1 (222) 555-1234 please")], "doc_id long, text string")
    found = {r.doc_id: r for r in pii.report(df).collect()}
    assert found[5000].n_phone == 0 and all(found[i].n_phone == 1 for i in range(400))
    assert all(not found[1000 + i].spans for i in range(400))


def test_boosting_separates():
    random_ = np.random.default_rng(3)
    x = random_.normal(size=(600, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    scores = fit(x[:300], y[:300]).score(x[300:])
    assert ((scores > 0.5) == y[300:]).mean() > 0.9
    cut = threshold(scores, y[300:], 0.95)
    assert y[300:][scores >= cut].mean() >= 0.95
    assert threshold(scores, np.zeros(300), 0.95) == float("inf")


def test_near_groups(spark, docs):
    assert plain(queries.op6(spark, DATA).collect()) == plain(brute.groups(docs, 4))


def test_near_groups_edges(spark, mixed):
    random.seed(3)
    names = [f"w{i}" for i in range(3000)]
    base, copies = random.choices(names, k=120), []
    for i in range(150):
        one = list(base)
        for _ in range(random.randint(0, 9)):
            one[random.randrange(len(one))] = random.choice(names)
        copies.append((50000 + i, " ".join(one)))
    copies += [(70000 + i, "same same text of words here") for i in range(40)]
    rows, df = mixed
    rows = rows + copies
    df = df.unionByName(spark.createDataFrame([(*r, 1, "k") for r in copies], df.schema))
    want = brute.groups(rows, 4)
    assert plain(neardup.near_groups(df, size=4).collect()) == plain(want)
    left = neardup.drop_near_duplicates(df, size=4)
    assert left.columns == df.columns
    # Of rows that agree in id and text one stays, unless they have no words.
    kept = {(*r, w[1]) for r, w in zip(rows, want) if w[3] and w[0] is not None}
    bare = sum(1 for w in want if w[0] is not None and not w[1])
    assert left.where("doc_id IS NOT NULL").count() == sum(1 for k in kept if k[2]) + bare
    assert neardup.near_groups(df.limit(0)).count() == 0


def test_near_duplicate_rows_go_one_by_one(spark):
    """A clean text keeps its row although its id has another text that goes; one of equal rows stays."""
    a, other, x, lone = ("first text with quite a few words " * 3, "a second text that nobody else has got at all", "x y z u v w", "only without an id here, in copies")
    rows = [(1, a, "k1"), (5, a, "k2"), (5, other, "k3"), (7, x, "k4"), (7, x, "k5"), (None, a, "k6"), (None, lone, "k7"), (None, lone, "k8"), (8, None, "k9"), (8, "", "k0"), (9, a.upper(), "kk")]
    df = spark.createDataFrame(rows, "doc_id long, text string, a string").repartition(3)
    left = neardup.drop_near_duplicates(df)
    assert left.columns == df.columns
    found = sorted((r.a for r in left.collect()))
    assert [k for k in found if k not in ("k4", "k5", "k7", "k8")] == ["k0", "k1", "k3", "k9"]
    assert len([k for k in found if k in ("k4", "k5")]) == len([k for k in found if k in ("k7", "k8")]) == 1


def test_components(spark):
    random.seed(4)
    edges = [(random.randint(0, 400), random.randint(0, 400)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1100)] + [(2000, 2000 + i) for i in range(1, 300)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    found = {r.a: r.b for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {x: root(x) for x in parent if root(x) != x}


def test_trees_of_all_rows(spark):
    """The jobs grow the trees that one process grows of the same rows, values beyond the common ones too, and no
    base span of a text is left out of the examples."""
    rng = random.Random(5)
    x = [[rng.randrange(8), rng.choice([0, 3, 300, 70000]), rng.randrange(2)] for _ in range(600)]
    y = [float(a + (b > 200) * 4 + rng.random() * 2 > 6) for a, b, _ in x]
    rows = spark.createDataFrame([(i % 2, b, a) for i, (a, b) in enumerate(zip(x, y))], "kind int, label double, x array<int>").repartition(3)
    grown, plain = fit_rows(rows, trees=3), fit(np.array(x, float), np.array(y), trees=3)
    assert np.abs(grown.score(np.array(x, float)) - plain.score(np.array(x, float))).max() < 1e-6
    scores, labels, even = grown.score(np.array(x, float)), np.array(y), np.arange(600) % 2 == 0
    found = thresholds(rows, grown, 0.9)
    for k, part in enumerate((even, ~even)):
        want = threshold(scores[part], labels[part], 0.9)
        assert want - 1.1e-4 <= found[k] <= want
    assert fit_rows(rows.where("label = 0")) is None

    text = " ".join(f"10.{i // 250}.{i % 250}.7 and" for i in range(400))
    spans, places = pii.base_spans(text), collections.Counter()
    original = pii.rewritten
    try:
        pii.rewritten = lambda kind, value, r: places.update([value]) or original(kind, value, r)
        list(pii.examples(text, random.Random(1), copies=1))
    finally:
        pii.rewritten = original
    assert len(spans) == 400 and set(places) == {text[s:e] for _, s, e in spans}


def test_personal_data_that_the_patterns_miss(spark):
    """On table data, with the defaults: forms that no base pattern matches are found where they are set into documents that
    the model has not seen, and what only looks like them is left alone."""
    docs = spark.read.parquet(DATA.replace("sf0.001", "sf0.1") + "/documents.parquet").where("text IS NOT NULL")
    finder = pii.train(docs)
    rng = random.Random(3)
    host = [t for t in (r.text for r in docs.where("doc_id % 40 = 7").collect()) if not pii.base_spans(t) and not pii.candidates(t)]
    forms = {
        "email": lambda: f"{rng.choice(['ann', 'j.doe', 'kim_99'])}{rng.choice([' (at) ', '[at]'])}{rng.choice(['post.example.org', 'mail (dot) com'])}",
        "ip": lambda: rng.choice(["[.]", " dot ", "(.)"]).join(str(rng.randrange(1, 256)) for _ in range(4)),
        "card": lambda: grouped(pii.with_check(str(rng.randrange(4 * 10**14, 5 * 10**14))), rng.choice("./")),
        "phone": lambda: rng.choice([f"({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}", f"{rng.randrange(200, 999)}.{rng.randrange(200, 999)}.{rng.randrange(1000, 9999)}"]),
    }
    clean = ["in 2024-03-18 10:30", "on 18.03.2026", "version 10.4.2", "1,234,567 of them", "pages 1990-1995", "number 4556737586899851", "at 10:30:59", "id 123456789012"]

    def grouped(digits, sign):
        return sign.join(digits[i:i + 4] for i in range(0, len(digits), 4))

    def insert(t, one):
        at = t.find(" ", len(t) // 2) + 1
        return t[:at] + one + " " + t[at:], at

    hits = collections.Counter()
    for kind, make in forms.items():
        for t in rng.choices(host, k=40):
            one = make()
            text, at = insert(t, one)
            base, spans = finder.spans(text)
            assert set(base) <= set(spans)
            hits[kind] += (pii.KINDS.index(kind), at, at + len(one)) in spans
    wrong = sum(finder.spans(insert(t, rng.choice(clean))[0])[1] != [] for t in rng.choices(host, k=200))
    assert all(hits[k] >= 30 for k in forms) and wrong <= 2, (hits, wrong, finder.thresholds)


def test_secrets(spark, docs):
    for r in queries.op7(spark, DATA).collect():
        want = brute.secret_spans(dict(docs)[r.doc_id])
        assert r.base_sha256 == brute.sha(",".join(want)) and set(want) <= set(r.spans.split(",")) | {""}


def test_secret_edges(spark, docs):
    rows = docs[:100] + EDGE + [
        (80001, "😀 password = \"abcdef\" TOKEN:'x.y=z/1' token=password:abcdefgh"), (80002, "secret=abc token=token:abcdefgh"),
        (80003, "AKIA" * 5 + " AKIAxAKIA" + "A" * 16), (80004, "0123456789abcdef01234567 " * 700), (80005, "é" * 20 + "ghp_aB3dE5fG7hJ9kL1mN3pQ5rS7tU9vW1xY3z end of-the-ordinary-title-2024 x"),
        (80006, "api_key==abcdef+/ apikey : \"q\" a" + "f" * 30), (None, "passwd=hunter22")]
    random.seed(6)
    rows += [(2000 + i, "the token=" + "".join(random.choices(secrets.ALPHABET[:62], k=30)) + " stands here") for i in range(60)]
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, found string").repartition(3)
    found = secrets.report(df, least=0.3).collect()  # a small sample gives small ratios
    assert sorted((str(r.doc_id), r.base_sha256) for r in found) == sorted((str(d), brute.sha(",".join(brute.secret_spans(t)))) for d, t in rows)
    assert {r.doc_id: r.spans for r in found}[80005] == "random:20:58"
    clean = {r.doc_id: r for r in secrets.redact(df, least=0.3).collect()}
    assert clean[80001].text == "😀 [SECRET]\" [SECRET]' [SECRET]:abcdefgh" and clean[80001].found == "x" and clean[90001].text is None
    assert clean[80004].text == "[SECRET] " * 700 and clean[80002].text == dict(rows)[80002]
    assert secrets.report(df.limit(0)).count() == 0


def test_spans_of_texts_full_of_secrets(spark):
    """Overlaps and redaction against plain loops, on texts of up to 20,000 spans."""
    rng = random.Random(12)
    words = ["token=", "secret: ", "AKIA" + "B7" * 9, "0123456789abcdef" * 2, "Zx9Qw8Er7Ty6Ui5Op", "-", " ", "é😀 ", "plain ", "\n", "x" * 1500]
    texts = ["".join(rng.choices(words, k=n)) for n in (1, 3, 8, 30, 200, 1000) for _ in range(12)] + ["", "0123456789abcdef01234567 Zx9Qw8Er7Ty6Ui5Op " * 10_000]
    model = secrets.Markov((1.0,) * len(secrets.ALPHABET) ** 2, 0.0)  # every candidate is a secret
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    run = re.compile(secrets.RUN)
    found = {r.doc_id: [(s.start, s.kind, s.end) for s in r.found] for r in secrets.scan(df, model).collect()}
    spans = F.col("found")
    cut = secrets.scan(df, model).join(df, "doc_id").select("doc_id", secrets.replace_spans(F.col("text"), spans, "[S]").alias("text"))
    masked = {r.doc_id: r.text for r in cut.collect()}
    for i, text in enumerate(texts):
        kinds = ("assign", "access", "hex")
        base = [(int(s), kinds.index(k), int(e)) for k, s, e in (one.split(":") for one in brute.secret_spans(text))]
        covered = bytearray(len(text))
        for s, _, e in base:
            covered[s:e] = b"1" * (e - s)
        more = [(m.start(), 3, m.end()) for m in run.finditer(text) if re.search("[0-9]", m[0]) and re.search("[A-Za-z]", m[0]) and not any(covered[m.start():m.end()])]
        assert found[i] == sorted(base + more)
        out, end = [], 0
        for s, _, e in found[i]:
            if s >= end:
                out += [text[end:s], "[S]"]
            end = max(end, e)
        assert masked[i] == "".join(out) + text[end:]


@pytest.mark.parametrize("n", [60, 200])
def test_random_strings_of_every_alphabet(spark, docs, n):
    """With the defaults, on tables of any size, random strings are found and ordinary identifiers are not."""
    rng, upper, lower, digits = random.Random(8), secrets.ALPHABET[26:52], secrets.ALPHABET[:26], "0123456789"
    kinds = {"base62": lower + upper + digits, "lower36": lower + digits, "upper36": upper + digits, "base32": upper + "234567", "upper_hex": "ABCDEF" + digits}
    known = {r for _, t in docs for r in (t or "").split()}
    lines = [(k, p + "".join(rng.choices(a, k=24))) for k, a in kinds.items() for p in ("", "ghp_", "sk_live_") for _ in range(20) if not (p and k != "base62")]
    names = [w.lower() for w in sorted(known) if 6 <= len(w) <= 12 and w.isascii() and w.isalpha()][::40]
    lines += [("plain", f"{a}{s}{b}{s}{2024 + i % 3}") for i, (a, b) in enumerate(zip(names, names[1:])) for s in "-_" if len(a + b) > 11]
    rows = docs[:n] + [(2_000_000 + i, "é see " + v + " there") for i, (_, v) in enumerate(lines)]
    found = {r.doc_id: r.spans for r in secrets.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    hits = collections.defaultdict(list)
    for i, (k, v) in enumerate(lines):
        if any(c.isdigit() for c in v) and any(c.isalpha() for c in v):
            hits[k].append(found[2_000_000 + i] != "")
    share = {k: sum(h) / len(h) for k, h in hits.items()}
    assert all(share[k] >= 0.9 for k in kinds) and share["plain"] <= 0.02, share


def test_quality(spark, docs):
    found = queries.op8(spark, DATA).collect()
    assert plain(r[:7] for r in found) == plain((d, *brute.quality(t)) for d, t in docs)
    assert not any(r.kept and r.base_failed for r in found)


def test_quality_edges(spark, mixed):
    rows, df = mixed
    found = quality.profile(df).collect()
    assert plain(r[:7] for r in found) == plain((d, *brute.quality(t)) for d, t in rows)
    kept = quality.keep_good(df)
    assert kept.columns == df.columns and kept.count() == sum(r.kept for r in found)
    assert quality.profile(df.limit(0)).count() == 0


def test_quality_order_changes_no_verdict(spark, mixed):
    from pyspark.sql import functions as F
    _, df = mixed
    rules = quality.BASE_RULES + quality.MORE_RULES
    both = df.select(quality.verdict(F.col("text"), rules).isNull().alias("a"), quality.verdict(F.col("text"), rules[::-1]).isNull().alias("b"))
    assert both.where("a != b").count() == 0


def test_quality_against_labels(spark):
    found = {r.doc_id: r for r in queries.op8(spark, DATA).collect()}
    labels = spark.read.parquet(f"{DATA}/labels.parquet").collect()
    good = [found[r.doc_id] for r in labels if r.quality == 1 and not found[r.doc_id].base_failed]
    bad = [found[r.doc_id] for r in labels if r.quality == 0]
    assert all(r.kept for r in good) and not any(r.kept for r in bad)


def test_language_model(spark, docs):
    found = queries.op9(spark, DATA).collect()
    want = {w[0]: w for w in brute.unigram(docs)}
    for r in found:
        assert tuple(r)[:5] == want[r.doc_id][:5] and r.base_score == pytest.approx(want[r.doc_id][5])
    held = [r for r in found if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_language_model_edges(spark, mixed):
    rows, df = mixed
    found = hmm.held_out_report(df, head_words=50, own_classes=10, warm_rounds=2, rounds=1).collect()
    assert plain(r[:5] for r in found) == plain(w[:5] for w in brute.unigram(rows))
    assert all(r.score < 0 for r in found)
    assert hmm.held_out_report(df.limit(0), warm_rounds=1, rounds=1).count() == 0


def test_likelihood_is_exact():
    r, s = np.random.default_rng(0), 4
    m = hmm.Model(r.dirichlet(np.ones(s)), r.dirichlet(np.ones(s)), r.dirichlet(np.ones(s), s), r.dirichlet(np.ones(30), s).T)
    texts = [r.integers(0, 30, n).astype(np.int32) for n in (1, 2, 255, 256, 257, 1000, 5, 512)]

    def forward(t):
        a, log = m.start * m.emit[t[0]], 0.0
        for x in t[1:]:
            a = (a @ m.move) * m.emit[x]
            log, a = log + np.log10(a.sum()), a / a.sum()
        return log + np.log10(a.sum())

    assert hmm.log_likelihoods(texts, m) == pytest.approx([forward(t) for t in texts])


def test_expected_counts_match_enumeration():
    """One piece, all state paths."""
    import itertools
    r, s = np.random.default_rng(1), 2
    m = hmm.Model(r.dirichlet(np.ones(s)), r.dirichlet(np.ones(s)), r.dirichlet(np.ones(s), s), r.dirichlet(np.ones(5), s).T)
    text = np.array([0, 3, 1, 1], np.int32)
    counts = hmm.Expected(m)
    counts.add([text])
    total, move, emit = 0.0, np.zeros((s, s)), np.zeros((5, s))
    for path in itertools.product(range(s), repeat=4):
        p = m.start[path[0]] * m.emit[text[0], path[0]]
        for i in range(1, 4):
            p *= m.move[path[i - 1], path[i]] * m.emit[text[i], path[i]]
        total += p
        for i in range(4):
            emit[text[i], path[i]] += p
            if i:
                move[path[i - 1], path[i]] += p
    assert counts.move == pytest.approx(move / total) and counts.emit == pytest.approx(emit / total)


def test_words_of_all_classes_sum_to_one(spark, docs):
    counts = hmm.count_words(spark.createDataFrame(docs[:50], "doc_id long, text string"), "text").cache()
    v = hmm.build_vocabulary(counts, 20, 200)
    assert v.total == sum(len((t or "").split()) + 1 for _, t in docs[:50])
    head = {w for w in v.head}
    mass = collections.Counter()
    for r in counts.collect():
        word = bytes(r.word)
        ids, index, _ = v.encode([word])
        own = ids[0] < v.size - hmm.GROUPS
        mass[int(ids[0])] += 1.0 if own else (r.n + 1) / 10 ** v.group_log[ids[0] - (v.size - hmm.GROUPS)]
        assert (index[0] >= 0) == (word in head)
    assert all(m <= 1 + 1e-9 for m in mass.values())


def test_language(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    found = queries.op10(spark, DATA).collect()
    assert all(r.held_out == (brute.remainder(r.doc_id, 3) == 1) and 0 <= r.score <= 1 for r in found)
    held = [r for r in found if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.95 * len(held)


def test_language_edges(spark, mixed):
    rows, df = mixed
    from pyspark.sql import functions as F
    labelled = df.withColumn("lang", F.when(F.pmod(F.col("doc_id"), F.lit(2)) == 0, "even").when(F.col("doc_id") < 90000, "odd"))
    found = langid.held_out_report(labelled).collect()
    assert len(found) == len(rows) and {r.lang_pred for r in found} <= {"even", "odd", "und"}
    assert all(r.lang_pred == "und" and r.score == 0 for r in found if r.doc_id in (90001, 90002, 90003))
    assert {r.lang_pred for r in langid.held_out_report(df.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert langid.held_out_report(labelled.limit(0)).count() == 0


def test_code_lengths_are_a_distribution():
    trees = langid.ContextTrees([("a", b" th", 3), ("a", b"th", 3), ("a", b"h", 3), ("a", b" t", 5), ("a", b"t", 9), ("a", b"e", 4)], 3)
    for context in (b"", b" ", b" t", b"t", b"q"):
        assert sum(2 ** -trees.bits(trees.trees[0], context + bytes([b])) for b in range(256)) == pytest.approx(1)
    assert trees.text("The hat " + "ht" * 100)[0] == pytest.approx(trees.words([b"the", b"hat", b"ht" * 100])[:, 0].sum())
    slow = sum(trees.bits(trees.trees[0], gram) for w in (b"the", b"hat") for gram in langid.steps(w, 3))
    assert trees.text("the hat the")[0] == pytest.approx(slow + trees.words([b"the"])[0, 0])


def test_span_dedup(spark, docs, mixed):
    long = "Alpha beta gamma delta. Epsilon zeta eta theta iota kappa. Lambda mu nu xi omicron pi rho sigma. Tau upsilon phi chi psi omega."
    more = [(1_000_001, long), (1_000_002, "Other text here " + long + " tail words"), (None, long), (None, "x " + long), (1_000_003, long + " " + long)]
    rows, df = mixed
    rows = rows + more
    df = df.unionByName(spark.createDataFrame([(*r, 1, "k") for r in more], df.schema))
    gone = brute.removed_sentences(rows, spans.sentences)
    want = collections.Counter()
    for doc in rows:
        parts = spans.sentences(doc[1] or "")
        left = " ".join(w for i, p in enumerate(parts) if i not in gone[doc] for w in p)
        want[str((doc[0], len(gone[doc]), None if doc[1] is None else left))] += 1
    found = spans.dedup_spans(df).collect()
    assert collections.Counter(str((r.doc_id, r.n_removed, None if r.text is None else " ".join(r.text.split()))) for r in found) == want
    texts = collections.Counter(map(str, rows))
    assert all(str((r.doc_id, r.text)) in texts for r in found if not r.n_removed)
    assert spans.dedup_spans(df.limit(0)).count() == 0
    assert len(queries.op1(spark, DATA).collect()) == len(docs)


@pytest.mark.parametrize("kind", ["bare", "stops", "wide"])
def test_span_dedup_passage_at_every_offset(kind):
    """A passage of 51 words holds a repeated run wherever it is set."""
    rng = random.Random(4)
    glue = "" if kind == "wide" else " "

    def draw(n):
        if kind == "wide":
            return [chr(0x4E00 + rng.randrange(3000)) for _ in range(n)]
        out = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 8))) for _ in range(n)]
        return [w + "." if kind == "stops" and rng.random() < 0.1 else w for w in out]

    powers, shares = spans.Powers(), []
    for offset in range(64):
        passage = draw(51)
        hosts = [glue.join(draw(a) + passage + draw(40)) for a in (40, offset)]
        first, second = (spans.runs(t, powers) for t in hosts)
        known = set(zip(first[1], first[2]))
        parts = spans.sentences(hosts[1])
        assert max(map(len, parts)) <= spans.LONGEST
        hit = [int(s) for s, h, g in zip(*second) if (h, g) in known]
        assert hit, offset
        gone = spans.covered(parts, hit)
        left = spans.remove(hosts[1], parts, gone)
        assert glue.join(w for i, p in enumerate(parts) if not any(a <= i < b for a, b in gone) for w in p).split() == left.split()
        shares.append(sum(len(parts[i]) for a, b in gone for i in range(a, b)) / 51)
    assert sum(shares) / len(shares) > 0.7


def test_rules_sample_is_drawn_by_hash(spark):
    """The sample does not hang on partitions or on the first rows, and copies count once."""
    texts = [f"word{i} " * (i % 60) for i in range(300)] + ["copy of one text"] * 500 + [None, "", "long " * 20000]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    one, two = (quality.draw_sample(df.repartition(n), sample=40) for n in (1, 7))
    assert one == two and len(one) == 40 == len(set(one)) and "long " * 20000 not in quality.draw_sample(df, sample=9999)
    assert "long " * 20000 in quality.draw_sample(df, sample=9999, longest=1 << 20)
    assert quality.draw_sample(df.limit(0)) == []


def test_any_order_of_rules_gives_one_verdict(spark, docs, monkeypatch):
    df = spark.createDataFrame(docs + EDGE, "doc_id long, text string")
    want = sorted(map(str, quality.profile(df).collect()))
    monkeypatch.setattr(quality, "order_rules", lambda d, rules, *a, **k: rules[::-1])
    assert sorted(map(str, quality.profile(df).collect())) == want
    assert [r.kept for r in quality.profile(df).orderBy("doc_id").collect()] == [
        r.ok for r in df.select("doc_id", quality.verdict(F.col("text"), quality.BASE_RULES + quality.MORE_RULES).isNull().alias("ok")).orderBy("doc_id").collect()]
