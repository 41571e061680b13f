"""Toxicity, packing, neighbours, language and the hidden Markov model."""

import itertools
import math
import random
import struct
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from listingkit.llm import common, hmm, language, neighbours, packing, textarrays, toxicity
from listingkit.llm.toxicity import Lexicon


def held(i, folds, rest):
    return zlib.crc32(str(i).encode()) % folds == rest


# ------------------------------------------------------------------ toxicity

def test_folding_and_matching():
    lex = Lexicon({"idiot": 4.0, "vile*": 5.0}, {"vilecorn", "not an idiot"}, 0.0, 1.0)
    found = lex.automaton()
    for text, hits in [("an idiot.", 1), ("IDIOT", 1), ("1d10t", 1), ("іdіоt", 1), ("ｉｄｉｏｔ", 1), ("id​iot", 1), ("idiots", 0),
                       ("superidiot", 0), ("vileness vilecorn", 1), ("he is not an idiot", 0), ("v1le5", 1), ("", 0), (None, 0)]:
        assert lex.strength(text, found)[1] == hits, text
    short, long = (lex.strength("idiot " + "fine " * n, found)[0] for n in (1, 5000))
    assert 0 < long < short
    assert lex.score(long) < lex.score(short) <= 1


def toxic_tables(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(900):
        w = [f"word{rng.randrange(3000)}" for _ in range(rng.randrange(5, 60))]
        bad = i % 6 == 0
        if bad:
            w[rng.randrange(len(w))] = rng.choice(["grump", "g7ump", "slorp" + rng.choice("abcde"), "Grump!"])
        elif i % 6 == 1:
            w.append("slorpless")                       # a harmless word with the same beginning
        rows.append((i, " ".join(w).replace("g7ump", "grumр")))
        if i % 5:
            labels.append((i, 1, int(bad)))
    rows += [(2000, None), (2001, ""), (None, "grump"), (2002, "x " * 100_000 + "grump"), (3, rows[3][1])]
    return (spark.createDataFrame(rows, "doc_id long, text string").withColumn("toxic", F.lit(7)),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), rows)


def test_toxicity_learns_and_holds_out(spark):
    docs, labels, rows = toxic_tables(spark)
    lexicon = toxicity.learn_lexicon(docs, labels)
    got = toxicity.score_toxicity(docs, lexicon).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    verdict = {r.doc_id: r.predicted for r in got}
    right = [verdict[i] == (i % 6 == 0) for i in range(900) if held(i, 3, 1)]
    assert sum(right) / len(right) > 0.98
    assert verdict[2000] == verdict[2001] == 0 and verdict[None] == 1
    # labels of held-out rows have no say
    other = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1,
                                              1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.learn_lexicon(docs, other) == lexicon


def test_toxicity_without_labels_or_rows(spark):
    docs, labels, _ = toxic_tables(spark)
    empty = toxicity.learn_lexicon(docs, labels.limit(0))
    assert {r.predicted for r in toxicity.score_toxicity(docs, empty).collect()} == {0}
    assert toxicity.score_toxicity(docs.limit(0), empty).count() == 0


def test_rare_sure_terms_are_learned_from_large_samples():
    toxic = {"grump": 4000, "slorp": 79, "odd": 3}
    lexicon = toxicity._choose(toxic, {"grump": 2}, 8000, 8000)
    assert set(lexicon.weights) == {"grump", "slorp"}


# ------------------------------------------------------------------ packing

def test_packing_round_trip(spark):
    import public_tokenizers
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rng = random.Random(9)
    odd = [None, "", "  \n", "it's 12 ok... <|endoftext|> x", "ΣΑΣ İ é ́ ﬁ ² \x1c y", "日本 語", "a,b. c!! d***", "née É,"]
    rows = [(i, odd[i] if i < len(odd) else " ".join(rng.choice(["alpha", "Beta,", "zqx12", "éàü.", "!!"]) for _ in range(
        rng.choice([1, 30, 400, 5000])))) for i in range(120)] + [(None, "same row"), (5, odd[5]), (5, odd[5])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("length", F.lit("clash")).withColumn("offset", F.lit(1))
    got = packing.pack_documents(docs.repartition(3)).collect()
    by_doc, by_sequence = {}, {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert sum(r.piece == 0 for r in got) == len(rows)
    for i, text in rows[:120]:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        want = [ids[k:k + 4096] for k in range(0, len(ids), 4096)]
        mine = sorted(by_doc[i], key=lambda r: r.piece)[::3 if i == 5 else 1]
        assert [(r.start, r.length, r.ids_crc32) for r in mine] == [
            (4096 * k, len(p), zlib.crc32(struct.pack(f"<{len(p)}I", *p))) for k, p in enumerate(want)]
    for rs in by_sequence.values():
        end = 0
        for r in sorted(rs, key=lambda r: r.offset):
            assert r.offset == end
            end += r.length
        assert end <= 4096
    total = sum(r.length for r in got)
    assert len(by_sequence) <= -(-total // 4096) * 1.1 + 3
    assert packing.pack_documents(docs.limit(0)).count() == 0


def test_tokenizing_workers_stay_small(monkeypatch):
    """Tables of ids are bounded, and what a batch took goes back to the system."""
    import public_tokenizers
    table = packing.WordIds(public_tokenizers.path("word_bpe_49k.json"))
    for k in range(12):
        table.encode(pa.array([" ".join(f"{chr(97 + k)}{i:x}" for i in range(40_000))]))
        assert len(table) + len(table.old) <= 300_000
    table.rest()
    assert len(table) <= 50_000 and not table.old
    trims = []
    monkeypatch.setattr(textarrays, "_TRIM", trims.append)
    batch = pa.RecordBatch.from_arrays([pa.array(["abc"] * 10)], names=["text"])
    assert sum(p.num_rows for p in textarrays.slices(batch, 0, 6)) == 10 and trims == [0]


def test_open_bins_choose_the_least_room():
    bins = packing.OpenBins(10, 2)
    assert [bins.put(n) for n in (6, 7, 3, 4)] == [(0, 0), (1, 0), (1, 7), (0, 6)]
    bins = packing.OpenBins(10, 1)
    assert [bins.put(n) for n in (4, 8, 2, 6)] == [(0, 0), (1, 0), (0, 4), (2, 0)]     # the fullest, 1, was closed


# ------------------------------------------------------------------ neighbours

def test_hilbert_curve_is_continuous():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        grid = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
        key = neighbours.hilbert_key(grid, bits)
        walk = grid[np.argsort(key)]
        assert sorted(key) == list(range(len(grid)))
        assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def brute_neighbours(rows, k=10):
    fine = {i: np.array(v, float) for i, v in rows if i is not None and v and None not in v
            and np.isfinite(np.array(v, float)).all() and np.any(np.array(v, float))}
    out = {}
    for q in fine:
        if q % 100 == 0:
            d = sorted((float(np.sqrt(((fine[q] - x) ** 2).sum())), i) for i, x in fine.items() if i != q)
            out[q] = d[:k]
    return out


@pytest.mark.parametrize("clusters", [0, 30])
def test_neighbours_recall(spark, clusters):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(6000, 16))
    if clusters:
        x = rng.normal(size=(clusters, 16))[rng.integers(0, clusters, 6000)] + 0.1 * x
    x = x.astype(np.float32).astype(float)
    x[4000:4700] = x[100]                               # many equal vectors, a query among them
    rows = [(int(i), v.tolist()) for i, v in enumerate(x)]
    rows += [(9000, None), (9100, [0.0] * 16), (9200, [float("nan")] + [1.0] * 15), (9300, [None] + [1.0] * 15), (None, [1.0] * 16),
             (9400, [float("inf")] * 16), (100, rows[100][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit("clash"))
    got = {}
    for r in neighbours.nearest(df.repartition(4), F.col("vec_id") % 100 == 0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    want = brute_neighbours(rows)
    assert set(got) == set(want)
    hits = 0
    for q, best in want.items():
        mine = sorted(got[q])
        assert [r for r, _, _ in mine] == list(range(1, 11))
        assert [(s, i) for _, i, s in mine] == sorted((s, i) for _, i, s in mine)
        hits += len({i for _, i in best} & {i for _, i, _ in mine})
        for _, i, s in mine:
            assert abs(s - math.dist(x[q], x[i])) < 1e-12
    assert hits >= 0.9 * 10 * len(want)
    assert [i for _, i, _ in sorted(got[100])] == list(range(4000, 4010))


def test_few_neighbours(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.0]), (3, [5.0])], "vec_id long, embedding array<float>")
    got = [(r["rank"], r.vec_id, r.score) for r in neighbours.nearest(df, F.col("vec_id") == 0).orderBy("rank").collect()]
    assert got == [(1, 2, 0.0), (2, 1, math.sqrt(2))]
    assert neighbours.nearest(df.limit(0), F.col("vec_id") == 0).count() == 0


# ------------------------------------------------------------------ language

def test_language(spark):
    rng = random.Random(4)
    parts = {"aa": ["bla", "ki", "ru", "mo"], "bb": ["zen", "tor", "wix", "ug"], "cc": ["éa", "où", "çi", "mo"]}
    rows = []
    for i in range(300):
        lang = rng.choice(list(parts))
        rows.append((i, " ".join("".join(rng.choices(parts[lang], k=rng.randrange(1, 5))) for _ in range(12)).capitalize() + ".", lang))
    rows += [(1000, None, "aa"), (1001, "", "bb"), (1002, "12 ... !", "cc"), (None, rows[0][1], rows[0][2]), (1003, rows[1][1], None),
             (1004, "torzenwixugtorzen " * 20_000, None), (0, rows[0][1], rows[0][2])]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("clash"))
    train = df.where(F.col("lang").isNotNull() & (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0))
    model = language.learn(train)
    assert model.langs == ["aa", "bb", "cc"]
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(df, model).collect()}
    assert all(got[i][0] == lang for i, _, lang in rows[:300])
    assert got[1000] == got[1001] == got[1002] == ("und", 0.0) and got[1004][0] == "bb"
    assert all(0 <= s <= 1 for _, s in got.values())
    counts = Counter(w for i, t, lang in rows if t and lang and i is not None and not held(i, 5, 0)
                     for x in t.split() for w in language.letters(x))
    word, n = counts.most_common(1)[0]
    by = Counter(lang for i, t, lang in rows if t and lang and i is not None and not held(i, 5, 0)
                 for x in t.split() for w in language.letters(x) if w == word)
    size = Counter(lang for i, t, lang in rows if t and lang and i is not None and not held(i, 5, 0)
                   for x in t.split() for _ in language.letters(x))
    assert np.allclose(model.scores([word])[0], [math.log((by[x] + 0.5) / (size[x] + 1)) for x in model.langs])
    nothing = language.learn(train.limit(0))
    assert {r.lang_pred for r in language.identify(df, nothing).collect()} == {"und"}
    assert language.identify(df.limit(0), model).count() == 0


def test_a_language_of_one_short_document_takes_no_others(spark):
    rng = random.Random(14)
    parts = {"aa": ["bla", "ki", "ru", "mo"], "bb": ["zen", "tor", "wix", "ug"]}
    text = lambda p, n: " ".join("".join(rng.choices(p, k=rng.randrange(1, 6))) for _ in range(n))
    train = [(i, text(parts[x], 40), x) for i in range(300) for x in [rng.choice(list(parts))]]
    test = [(i, text(parts[x], 40), x) for i in range(1000, 1100) for x in [rng.choice(list(parts))]]
    for words in (60, 2000):
        odd = [(5000, text(["jol", "quy", "hef"], words), "xx")]
        schema = "doc_id long, text string, lang string"
        model = language.learn(spark.createDataFrame(train + odd, schema))
        assert model.langs == ["aa", "bb", "xx"]
        got = {r.doc_id: r.lang_pred for r in language.identify(spark.createDataFrame(test + odd, schema), model).collect()}
        assert all(got[i] == x for i, _, x in test + odd)


# ------------------------------------------------------------------ hidden Markov model

def test_recursions_equal_the_sum_over_all_paths():
    rng = np.random.default_rng(6)
    k, v = 3, 4
    model = hmm.Hmm(rng.dirichlet(np.ones(k)), rng.dirichlet(np.ones(k), k), rng.dirichlet(np.ones(v), k).T)
    texts = [[0, 1, 3], [3], [2, 2, 1, 0, 3]]
    code, first = np.concatenate(texts), np.array([0, 3, 4, 9])
    start, move, emit = np.zeros(k), np.zeros((k, k)), np.zeros((v, k))
    likely = []
    for t in texts:
        paths = {}
        for p in itertools.product(range(k), repeat=len(t)):
            w = model.start[p[0]] * model.emit[t[0], p[0]]
            for a, b, x in zip(p, p[1:], t[1:]):
                w *= model.move[a, b] * model.emit[x, b]
            paths[p] = w
        total = sum(paths.values())
        likely.append(math.log10(total))
        for p, w in paths.items():
            start[p[0]] += w / total
            for a, b in zip(p, p[1:]):
                move[a, b] += w / total
            for x, s in zip(t, p):
                emit[x, s] += w / total
    assert np.allclose(hmm.log10_likelihood(model, code, first), likely)
    for got, want in zip(hmm.expected_counts(model, code, first), (start, move, emit)):
        assert np.allclose(got, want, atol=1e-4)


def test_hmm_scores(spark):
    rng = random.Random(7)
    rows = []
    for i in range(250):
        pool = [f"a{k}" for k in range(30)] if i % 2 else [f"B{k}" for k in range(30)]
        rows.append((i, " ".join(rng.choice(pool) if rng.random() < 0.9 else f"r{rng.randrange(400)}" for _ in range(rng.randrange(1, 60)))))
    rows += [(900, None), (901, ""), (None, "a1 new"), (5, rows[5][1]), (902, "a1 " * 60_000), (903, "ALLNEW ÀÉ x")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row", F.lit("clash"))
    df = df.withColumn("held_out", F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False)))
    got = hmm.score_texts(df.repartition(3), states=4, own=40, counted=100).collect()
    assert len(got) == len(rows)
    lower = {c: chr(c + 32) for c in range(65, 91)}
    text = {i: (t or "").translate(lower).split(" ") for i, t in rows}
    text = {i: [w for w in t if w] + ["\n"] for i, t in text.items()}
    count = Counter()
    for i, _ in rows:
        if i is None or not held(i, 7, 2):
            count.update(text[i])
    n, v = sum(count.values()), len(count)
    better = 0
    for r in got:
        w = text[r.doc_id]
        assert r.held_out == (r.doc_id is not None and held(r.doc_id, 7, 2))
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(x in count for x in w), n)
        assert r.base_score == pytest.approx(sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w))
        assert r.score < 0
        better += r.score > r.base_score
    assert better > 0.9 * len(got)
    assert hmm.score_texts(df.limit(0)).count() == 0
    first = {(r.doc_id, r.n_tokens): r.score for r in got}
    for r in hmm.score_texts(df, states=4, own=40, counted=100).collect():
        assert r.score == pytest.approx(first[r.doc_id, r.n_tokens], rel=1e-3)


def test_hmm_driver_gets_no_row_for_each_word(spark, monkeypatch):
    """Words and their emissions come as Arrow tables: a row object for each took the driver's memory."""
    df = spark.createDataFrame([(i, " ".join(f"w{k}" for k in range(i, i + 40)), i % 7 == 0) for i in range(900)],
                               "doc_id long, text string, held_out boolean")
    seen, kind = [], type(df)
    collect = kind.collect
    monkeypatch.setattr(kind, "collect", lambda self: seen.append(collect(self)) or seen[-1])
    got = hmm.score_texts(df, states=2, rounds=1, own=2000, counted=2000)
    assert max(map(len, seen)) < 300
    assert {r.n_tokens for r in got.collect()} == {41}


def test_hmm_scores_do_not_depend_on_held_out_texts(spark):
    rows = [(i, " ".join(["a", "b", "a", f"r{i}"][:2 + i % 3]), False) for i in range(30)] + [(50, "a b a", True)]
    seen = []
    for other in ("a", "zz " * 500 + "yy " * 400):
        df = spark.createDataFrame(rows + [(51, other, True)], "doc_id long, text string, held_out boolean")
        seen.append({r.doc_id: r.score for r in hmm.score_texts(df, states=2, rounds=1, own=2, counted=50).collect() if r.doc_id != 51})
    assert seen[0] == pytest.approx(seen[1], rel=1e-4)


@pytest.mark.parametrize("rows,keep,want", [
    ([(f"w{i}", 7) for i in range(1000)], 500, 500),                     # all counts equal
    ([(f"w{i}", 7) for i in range(1000)], 1000, 1000), ([(f"w{i}", 7) for i in range(1000)], 0, 0),
    ([(f"w{i}", 1 + i % 3 * 100) for i in range(900)], 450, 450), ([("a", 1)], 5, 1), ([], 5, 0)])
def test_most_frequent_fills_up(spark, rows, keep, want):
    df = spark.createDataFrame(rows, "word string, n long")
    got = [tuple(r) for r in common.most_frequent(df, "n", keep).collect()]
    assert len(got) == len(set(got)) == want and set(got) <= set(rows)
    if got:
        dropped = [n for _, n in set(rows) - set(got)]
        assert min(n for _, n in got) >= max(dropped, default=0)
    assert sorted(got) == sorted(tuple(r) for r in common.most_frequent(df.repartition(7), "n", keep).collect())


def test_op7_scores_do_not_see_other_held_out_texts(spark):
    """Few words are counted in the broadcast; held-out texts full of other words change no score."""
    rng = random.Random(31)
    train = [(i, " ".join(f"t{rng.randrange(30)}" for _ in range(40)), False) for i in range(30)]
    held = [(50, "t1 t2 t3 nowhere t29 t28", True)]
    def scores(other):
        df = spark.createDataFrame([*train, *held, (51, other, True)], "doc_id long, text string, held_out boolean").coalesce(1)
        return {r.doc_id: (r.score, r.base_score) for r in
                hmm.score_texts(df, states=3, rounds=2, own=6, counted=4).collect() if r.doc_id != 51}
    first = scores("x " * 500 + "y " * 400 + "nowhere")
    for other in ("t28 " * 900 + "t29 " * 800, "", "z1 z2 z3 z4 z5 " * 300):
        again = scores(other)
        assert all(a == pytest.approx(b, abs=1e-9) for i in first for a, b in zip(first[i], again[i]))
