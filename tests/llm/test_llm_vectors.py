"""Whitening, quality classifier and centroid clusters against plain versions."""

import hashlib
import math
import zlib

import numpy as np
import pytest

import __spark_entry__ as E
from listingkit.llm import kmeans, subword, whitening

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


# ---------------------------------------------------------------- op11

def plain_whitening(rows, components=4):
    x = [(i, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v in rows]
    fit = np.array(sorted({tuple(v) for _, v in x}), float)
    n, s = len(fit), [int(t) for t in fit.sum(0)]
    centred = fit - fit.mean(0)
    v = centred.T @ centred / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:components], u[:, ::-1][:, :components]
    out = {}
    for i, vec in x:
        dev = sum((n * a - b) ** 2 for a, b in zip(vec, s))
        out[i] = (n, dev, (np.array(vec) - np.array(s) / n) @ u / np.sqrt(e), e / np.trace(v))
    return out


def same_up_to_sign(got, want):
    got, want = np.array(got), np.array(want)
    for k in range(want.shape[1]):
        sign = np.sign(got[:, k] @ want[:, k])
        assert np.abs(sign * got[:, k] - want[:, k]).max() < 1e-9


def by_vector(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.vec_id, r.component)):
        out.setdefault(r.vec_id, []).append(r)
    return out


def test_op11_equals_the_eigenvectors(spark):
    rows = E.queries()["op11_whitening"](spark, SF).collect()
    table = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    want = plain_whitening([(r.vec_id, r.embedding) for r in table])
    got = by_vector(rows)
    assert set(got) == set(want) and all([r.component for r in v] == [1, 2, 3, 4] for v in got.values())
    ids = sorted(want)
    same_up_to_sign([[r.whitened for r in got[i]] for i in ids], [want[i][2] for i in ids])
    for i in ids:
        assert all(r.n == want[i][0] and r.deviation == want[i][1] for r in got[i])
        assert np.allclose([r.explained for r in got[i]], want[i][3], rtol=1e-10)
    errors = {r.identity_error for r in rows}
    assert len(errors) == 1 and 0 <= errors.pop() < 1e-10


def test_op11_edges(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [float(a), float(b), float(a * b)]) for i, (a, b) in enumerate([(1, 2), (3, -1), (0, 0), (2, 2), (1, 2)])]
    bad = [(90, None), (91, [1.0, None, 2.0]), (92, [nan, 1.0, 2.0]), (93, [inf, 1.0, 2.0]), (94, []), (95, [1.0, 2.0]),
           (96, [1e30, 0.0, 0.0])]
    df = frame(spark, good + bad + [good[3]])
    got = by_vector(whitening.whiten(df.selectExpr("*", "1 as x", "2 as component", "3 as n")).collect())
    want = plain_whitening(good)
    assert set(got) == set(want) and got[0][0].n == 4          # equal vectors fit once
    assert len(got[3]) == 2 * 3                                # a repeated row is returned twice
    same_up_to_sign([[r.whitened for r in got[i]] for i in (0, 1, 2, 4)], [want[i][2][:3] for i in (0, 1, 2, 4)])
    assert [r.whitened for r in got[0]] == [r.whitened for r in got[4]]
    assert whitening.whiten(frame(spark, [])).collect() == []
    assert whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []      # nothing varies
    null_id = whitening.whiten(frame(spark, [(None, [1.0]), (2, [3.0])])).collect()
    assert {r.vec_id for r in null_id} == {None, 2} and len(null_id) == 2


def test_op11_deviation_beyond_a_long(spark):
    big = 3e12
    df = spark.createDataFrame([(i, [big * (i % 3), 1.0 * i]) for i in range(40)], "vec_id long, embedding array<double>")
    rows = whitening.whiten(df).where("component = 1").collect()
    x = {i: [math.floor(256 * big * (i % 3)), 256 * i] for i in range(40)}
    s = [sum(v[k] for v in x.values()) for k in (0, 1)]
    assert all(int(r.deviation) == sum((40 * a - b) ** 2 for a, b in zip(x[r.vec_id], s)) for r in rows)
    assert max(int(r.deviation) for r in rows) > 1 << 63


@pytest.mark.parametrize("kind", ["random", "graded", "deficient", "double", "axes"])
def test_qd_solver(kind):
    rng = np.random.default_rng(3)
    x = {"random": lambda: rng.normal(size=(300, 24)), "graded": lambda: rng.normal(size=(300, 12)) * 10.0 ** -np.arange(12),
         "deficient": lambda: rng.normal(size=(10, 24)), "axes": lambda: np.concatenate([np.eye(6), -np.eye(6)]),
         "double": lambda: np.kron(np.array([[1.0, 0], [0, 1], [-1, 0], [0, -1]]), rng.normal(size=(50, 6)))}[kind]()
    r = np.zeros((x.shape[1],) * 2)
    own = np.linalg.qr(x, mode="r")
    r[:len(own)] = own
    a, b, w = whitening.bidiagonal(r)
    values = np.array(whitening.qd_values((a * a).tolist(), (b * b).tolist()))
    want = np.linalg.svd(r, compute_uv=False)
    big = want > want[0] * 1e-10
    assert np.allclose(np.sqrt(values)[big], want[big], rtol=1e-10)
    assert np.abs(w.T @ w - np.eye(len(a))).max() < 1e-12
    u, e, share = whitening.solve(r, len(x), x.shape[1])
    assert np.abs(u.T @ u - np.eye(len(e))).max() < 1e-9
    assert np.abs(x.T @ (x @ u) / len(x) - u * e).max() < 1e-9 * e[0]
    assert share.sum() == pytest.approx(1)


def test_qd_keeps_digits_of_small_values():
    """Squared singular values far under rounding of the largest stay exact."""
    q, e = [1.0, 1e-9, 1e-18, 1e-27], [1e-4, 1e-14, 1e-24]
    got = whitening.qd_values(q, e)
    from fractions import Fraction
    for v in got:                                       # residual of the exact characteristic polynomial, relative
        fq, fe, x = [Fraction(t) for t in q], [Fraction(t) for t in e], Fraction(v)
        def sign(x):
            d, s = fq[0] - x, []
            for i in range(3):
                s.append(d)
                d = fq[i + 1] + fe[i] - x - fq[i] * fe[i] / d if d else Fraction(-1)
            return sum(t < 0 for t in [*s, d])
        assert sign(x * (1 - Fraction(1, 10**11))) + 1 == sign(x * (1 + Fraction(1, 10**11)))


# ---------------------------------------------------------------- op12

def crc(i):
    return zlib.crc32(str(i).encode())


def test_op12_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    rows = E.queries()["op12_quality_classifier"](spark, sf).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (crc(r.doc_id) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and labels.get(r.doc_id) is not None]
    assert np.mean([p == y for p, y in held]) > 0.95
    assert len({r.score for r in rows if r.score < 0.3}) > 10


def test_op12_scores_do_not_read_held_out_labels(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet").selectExpr("doc_id", "quality as label")
    train = labels.where("crc32(cast(cast(doc_id as string) as binary)) % 5 != 0")
    a = subword.classify(docs, subword.learn_classifier(docs, train, rounds=2)).collect()
    query = {r.doc_id: r.score for r in E.queries()["op12_quality_classifier"](spark, SF).collect()}
    assert set(query) == {r.doc_id for r in a}
    flipped = labels.selectExpr("doc_id", "case when crc32(cast(cast(doc_id as string) as binary)) % 5 = 0 "
                                "then 1 - label else label end as label")
    keep = flipped.where("crc32(cast(cast(doc_id as string) as binary)) % 5 != 0")
    b = subword.classify(docs, subword.learn_classifier(docs, keep, rounds=2)).collect()
    assert {r.doc_id: r.score for r in a} == {r.doc_id: r.score for r in b}


def plain_features(text):
    """Counts of features, by name."""
    words = [w.decode() for w in text.encode().split()]
    out = {}
    def add(x):
        out[x] = out.get(x, 0) + 1
    for w in words:
        add(("word", w))
        marked = f" {w} "
        for n in subword.GRAMS:
            for i in range(len(marked) - n + 1):
                add((n, marked[i:i + n]))
    for a, b in zip(words, words[1:]):
        add(("pair", a, b))
        add(("same", a == b))
    return sorted(out.values())


@pytest.mark.parametrize("piece", [1 << 18, 16])
def test_op12_features_are_those_of_the_words(monkeypatch, piece):
    monkeypatch.setattr(subword, "PIECE", piece)
    text = "Der Der rote  Fuchs\nläuft läuft, 漢字 𝔘 a b\x0bder Fuchs " + "x" * 40 + " ende"
    ids, share = subword.sparse_features(text, 1 << 30 if piece > 16 else 1 << 16)
    want = plain_features(text)
    n = sum(want)
    assert sorted(np.rint(share * (n + subword.PRIOR)).astype(int).tolist()) == want
    assert all(len(subword.sparse_features(t)[0]) == 0 for t in (None, "", " \n\t"))


def test_op12_long_text_equals_its_pieces(monkeypatch):
    text = "some words that come again and again\n" * 2000 + "z" * 5000
    a = subword.sparse_features(text)
    monkeypatch.setattr(subword, "PIECE", 500)
    b = subword.sparse_features(text)
    assert (a[0] == b[0]).all() and np.allclose(a[1], b[1])


def test_op12_edges(spark):
    schema = "doc_id long, text string, score int, row string"
    docs = frame(spark, [(1, None, 1, "a"), (2, "", 1, None), (3, "good words here", 2, "c"), (3, "good words here", 2, "c"),
                         (None, "good", 3, "d"), (4, "x" * 300_000, 4, "e")], schema)
    none = frame(spark, [], "doc_id long, label int")
    out = subword.classify(docs, subword.learn_classifier(docs, none), keep=["doc_id", "row"]).collect()
    assert len(out) == 6 and {r.score for r in out} == {0.5}
    one = frame(spark, [(3, 1), (None, 0), (1, None)], "doc_id long, label int")
    assert {r.score for r in subword.classify(docs, subword.learn_classifier(docs, one)).collect()} == {1.0}
    both = frame(spark, [(3, 1), (3, 1), (4, 0)], "doc_id long, label int")
    got = {r.doc_id: r.score for r in subword.classify(docs, subword.learn_classifier(docs, both)).collect()}
    assert got[1] == got[2] and 0 <= min(got.values()) and max(got.values()) <= 1
    empty = docs.limit(0)
    assert subword.classify(empty, subword.learn_classifier(empty, both)).collect() == []


def test_op12_sample_keeps_the_true_odds(spark):
    """A bounded sample of either label does not change what is likely without evidence."""
    docs = spark.createDataFrame([(i, "") for i in range(200)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 10 > 0)) for i in range(200)], "doc_id long, label int")
    score = subword.classify(docs, subword.learn_classifier(docs, labels, sample=20)).first().score
    assert 0.7 < score < 0.99


# ---------------------------------------------------------------- op13

def plain_clusters(rows, k, rounds, scale, seed="3"):
    x = [(i, [math.floor(scale * float(c)) for c in v]) for i, v in rows]
    start = sorted(x, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))[:k]
    c = [list(v) for _, v in start]
    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, w)), j) for j, w in enumerate(c))
    for _ in range(rounds):
        own = {}
        for _, v in x:
            own.setdefault(near(v)[1], []).append(v)
        for j, vs in own.items():
            c[j] = [sum(t) // len(vs) for t in zip(*vs)]
    last = [(i, *near(v)[::-1]) for i, v in x]
    inertia = {}
    for _, j, d in last:
        inertia[j] = inertia.get(j, 0) + d
    sha = [hashlib.sha256(",".join(map(str, v)).encode()).hexdigest() for v in c]
    return sorted(((i, j, d, inertia[j], sum(inertia.values()), sha[j]) for i, j, d in last), key=str)


@pytest.mark.parametrize("kind", ["grid", "blobs", "copies"])
def test_op13_equals_plain_rounds(spark, kind):
    rng = np.random.default_rng(5)
    if kind == "grid":                                     # many ties
        rows = [(i, [float(i % 4), float(i // 4 % 4), float(-(i % 3))]) for i in range(60)]
    elif kind == "blobs":
        rows = [(i, (rng.normal(size=3) * 0.05 + 3 * (i % 4)).tolist()) for i in range(120)]
    else:
        rows = [(i, [1.0, 2.0, 3.0] if i % 3 else [float(i), 0.0, 1.0]) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [tuple(r) for r in kmeans.cluster(df, 5, 4, 16, 3).collect()]
    assert sorted(got, key=str) == plain_clusters(rows, 5, 4, 16)


def test_op13_edges(spark):
    nan = float("nan")
    good = [(1, [0.5, -0.5]), (2, [3.0, 1.0]), (2, [3.0, 1.0]), (None, [0.0, 0.0])]
    bad = [(5, None), (6, [1.0]), (7, [1.0, None]), (8, [nan, 1.0]), (9, [float("inf"), 1.0]), (10, [1e9, 0.0]), (11, [])]
    df = frame(spark, good + bad).selectExpr("*", "1 as cluster", "2 as x", "3 as p")
    got = [tuple(r) for r in kmeans.cluster(df, 8, 3, 16, 2).collect()]
    assert sorted(got, key=str) == plain_clusters(good, 8, 3, 16)
    assert kmeans.cluster(frame(spark, [])).collect() == []


def test_op13_bounds_hold_and_prune():
    rng = np.random.default_rng(6)
    x = np.floor(rng.normal(size=(4000, 8)) * 20 + 400 * rng.integers(0, 3, (4000, 1))).astype(np.int64)
    pivots, centroids = x[:6], x[10:18]
    a = kmeans.Assigner(centroids.tolist(), pivots)
    p = np.sqrt(np.stack([kmeans._squares(x, c) for c in pivots], 1).astype(float))
    exact = np.stack([kmeans._squares(x, c) for c in centroids], 1)
    assert (a.bounds(p) <= exact).all()
    own, d, checked = a.assign(x, p)
    assert (own == exact.argmin(1)).all() and (d == exact.min(1)).all()
    assert checked < 0.7 * exact.size
