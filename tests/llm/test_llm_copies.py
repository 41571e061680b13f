"""Near duplicates, repeated passages, components and the pipeline."""

import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from listingkit.llm import jaccard, mixing, sentences
from listingkit.llm.components import components


def words(rng, n, pool=5000):
    return [f"w{rng.randrange(pool)}" for _ in range(n)]


def shingles(text):
    w = (text or "").lower().split()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_components(rows):
    """Smallest id reachable by links, by comparing all pairs."""
    sets, root = {i: shingles(t) for i, t in rows}, {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[n + 1:]:
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}, sets


def near_copies(seed):
    rng = random.Random(seed)
    texts = []
    passage = words(rng, 60)
    for g in range(12):
        base = words(rng, rng.choice([6, 12, 40, 200, 600]))
        for _ in range(rng.choice([1, 2, 5, 40])):
            w = list(base)
            for _ in range(rng.randrange(0, max(2, len(w) // 25))):
                w[rng.randrange(len(w))] = f"x{rng.randrange(10 ** 6)}"
            if rng.random() < 0.2:
                w = w[:int(len(w) * rng.uniform(0.7, 1))]
            texts.append(" ".join(w))
    for _ in range(30):
        texts.append(" ".join(words(rng, 90) + passage))
        texts.append(" ".join(passage + words(rng, rng.randrange(5, 40))))
    texts += ["a b c", "A B C", "a b c d", "one", "", " ", "a b c d e", "a b c d e f", texts[0], texts[3].upper(), "long " * 50_000]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("seed,block", [(1, 4_000_000), (2, 3_000)])
def test_join_equals_all_pairs(spark, seed, block, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", block)
    monkeypatch.setattr(jaccard, "PART_MEMBERS", 7)
    rows = near_copies(seed)
    want, sets = brute_components(rows)
    assert len(set(want.values())) < len(rows) - 30
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit(1)).withColumn("class", F.lit("clash"))
    got = jaccard.near_duplicates(df.repartition(6)).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert {r.doc_id: r.n_shingles for r in got} == {i: len(s) for i, s in sets.items()}
    assert sum(r.first for r in got) == len(set(want.values()))


def test_join_nulls_and_repeated_rows(spark):
    t = "a b c d e f g h"
    rows = [(None, t), (5, t), (5, t), (3, t.upper()), (9, None), (None, None), (None, "z z"), (8, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id or -1), r.n_shingles, r.component_id or -1, r.first) for r in jaccard.near_duplicates(df).collect())
    assert got == [(-1, 0, -1, True), (-1, 1, -1, True), (-1, 4, 3, False), (3, 4, 3, True), (5, 4, 3, False), (5, 4, 3, False),
                   (8, 0, 8, True), (9, 0, 9, True)]
    assert jaccard.near_duplicates(df.limit(0)).count() == 0


def test_tree_finds_every_linked_pair():
    rng = np.random.default_rng(4)
    sets = []
    for _ in range(40):
        base = rng.integers(0, 2 ** 63, rng.integers(3, 120)).astype(np.uint64)
        for _ in range(4):
            keep = base[rng.random(len(base)) < 0.93]
            sets.append(np.unique(np.concatenate([keep, rng.integers(0, 2 ** 63, 2).astype(np.uint64)])))
    links = {(i, j) for i in range(len(sets)) for j in range(i) if jaccard.linked(sets[i], sets[j])}
    assert links
    keys = [str(i).encode() for i in range(len(sets))]
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a, b in jaccard.join_members(keys, keys, sets):
        assert (max(int(a), int(b)), min(int(a), int(b))) in links
        root[find(int(a))] = find(int(b))
    assert all(find(i) == find(j) for i, j in links)
    raw = [jaccard.bitmap(s, jaccard._width(len(s))).tobytes() for s in sets]
    hit = jaccard.possible_members(keys, [len(s) for s in sets], raw)
    assert all(hit[i] and hit[j] for i, j in links)


def test_bitmaps_pass_every_link_and_few_others(spark):
    """Only pairs (head, ref) whose bitmaps allow a link have their texts sent."""
    rng = np.random.default_rng(8)
    sets, best, links = [], [], []
    for i in range(60):
        head = np.unique(rng.integers(0, 2 ** 63, rng.integers(60, 140)).astype(np.uint64))
        near = np.concatenate([head[rng.random(len(head)) < 0.9], rng.integers(0, 2 ** 63, rng.integers(0, 30)).astype(np.uint64)])
        apart = np.concatenate([head[:len(head) // 3], rng.integers(0, 2 ** 63, len(head)).astype(np.uint64)])
        for other in (np.unique(near), np.unique(apart)):
            common = len(np.intersect1d(head, other))
            bits = [jaccard.bitmap(s, jaccard._width(len(s))).tobytes() for s in (head, other)]
            assert common <= jaccard.most_common(len(head), bits[0], len(other), bits[1]) == jaccard.most_common(
                len(other), bits[1], len(head), bits[0])
            best.append((len(sets), len(sets) + 1))
            sets += [head, other]
            if jaccard.linked(head, other):
                links.append(best[-1])
    assert len({jaccard._width(len(s)) for s in sets}) > 1 and links
    classes = spark.createDataFrame([(i, len(s), jaccard.bitmap(s, jaccard._width(len(s))).tobytes()) for i, s in enumerate(sets)],
                                    "ref long, n long, bits binary")
    got = {tuple(r) for r in jaccard._may_link(spark.createDataFrame(best, "head long, ref long"), classes).collect()}
    assert set(links) <= got and len(got) <= len(links) + 20


def test_components_of_paths_and_stars(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1001 + i) for i in range(50)] + [(7, 7)]
    edges += [(2000 + rng.randrange(30), 2000 + rng.randrange(30)) for _ in range(15)]
    rng.shuffle(edges)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i
    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    assert all(got.get(i, i) == find(i) for i in list(root))


def sentence(rng, n):
    w = words(rng, n)
    return " ".join([w[0].capitalize(), *w[1:]]) + "."


def test_passages_are_cut_but_for_the_first(spark):
    rng = random.Random(6)
    passage = " ".join(sentence(rng, rng.randrange(3, 20)) for _ in range(8))
    caps = "!! ".join(w.upper() for w in words(rng, 70)) + "!!"
    rows = []
    for i in range(40):
        own = [" ".join(sentence(rng, rng.randrange(2, 30)) for _ in range(4)) for _ in range(2)]
        middle = passage if i % 4 == 1 else caps if i % 4 == 2 else ""
        cut_at = own[0].rfind(" ")                     # the passage is pasted inside a sentence
        rows.append((i, (own[0][:cut_at] + " " + middle + " " + own[1]) if middle else " ".join(own), "en", i))
    rows += [(100, None, "en", 0), (101, "", "en", 0), (None, rows[0][1], "x", 1), (50, rows[3][1], "en", 2), (50, rows[3][1], "en", 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_removed int")
    got = {}
    for r in sentences.dedup_sentences(df.repartition(4)).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert got[1][0].text == rows[1][1] and got[2][0].text == rows[2][1]     # the first places stay
    for i in range(40):
        r, text = got[i][0], rows[i][1]
        if i % 4 == 1 and i > 1:
            assert passage[20:-20] not in r.text and r.removed_words >= 32
            assert r.text.startswith(text[:text.index(passage)].rsplit(" ", 3)[0])
        elif i % 4 == 2 and i > 2:
            assert caps not in r.text
        elif i not in (0,):
            assert r.text == text and r.n_removed == 0
    assert got[100][0].text is None and got[101][0].text == ""
    assert got[None][0].text == rows[0][1] and got[0][0].text == ""          # null ids come first
    assert len(got[50]) == 2 and got[50][0].text == got[50][1].text == ""
    assert sentences.dedup_sentences(df.limit(0)).count() == 0


def plain_sentences(text):
    """Tokens of a text and the first tokens of its sentences, by plain loops."""
    unspaced = "[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\ua4cf\uf900-\ufaff\U00020000-\U0003ffff]"
    tokens, ends = [], []
    for line in (text or "").split("\n"):
        line = re.sub(f"({unspaced})", r" \1 ", line)
        for w in line.split():
            tokens.append(w)
            ends.append(bool(re.search("[.!?\u2026\u3002\uff0e\uff01\uff1f\u061f\u06d4\u0964\u0965]+[\"'\u00bb\u201d\u2019)\\]\u300d\u300f\uff09]*$", w)))
        if tokens:
            ends[-1] = True
    return tokens, ends


def units_of(text):
    t = sentences.Tokens(pa.array([text], pa.string()))
    return [(int(a), int(b)) for a, b in zip(t.units, t.units[1:])]


def plain_dedup(rows, min_passage):
    """Texts' kept tokens: every run of sentences against every other document."""
    runs, where = {}, {}
    for i, text in rows:
        tokens = plain_sentences(text)[0]
        units = units_of(text)
        found = set()
        for k in range(len(units)):
            m = k + sentences.SENTENCES                   # from this sentence on, and up to it
            while m <= len(units) and units[m - 1][1] - units[k][0] < sentences.TOKENS:
                m += 1
            b = k + 1 - sentences.SENTENCES
            while b >= 0 and units[k][1] - units[b][0] < sentences.TOKENS:
                b -= 1
            found |= ({(k, m)} if m <= len(units) else set()) | ({(b, k + 1)} if b >= 0 else set())
        for k, m in sorted(found):
            run = tuple(tuple(tokens[a:b]) for a, b in units[k:m])
            runs.setdefault(run, set()).add(i)
            where.setdefault((i, run), []).append((units[k][0], units[m - 1][1]))
    out = {}
    for i, text in rows:
        tokens = plain_sentences(text)[0]
        covered = [False] * len(tokens)
        for (j, run), places in where.items():
            if j == i and min(runs[run]) != i:
                for a, b in places:
                    covered[a:b] = [True] * (b - a)
        left, at = [], 0
        for flag, group in itertools.groupby(covered):
            n = len(list(group))
            left += [] if flag and n >= min_passage else tokens[at:at + n]
            at += n
        out[i] = left
    return out


def test_sentences_end_where_they_should():
    text = "One two. Three!\n\nfour five, \u4e00\u4e8c\u3002\u4e09 \u0939\u0964 six?\u201d seven\n"
    tokens, ends = plain_sentences(text)
    t = sentences.Tokens(pa.array([text, None, "", " \n ", "a"]))
    assert [w for w in t.split[0].as_py() if w and w != sentences._LINE] == tokens and len(t.hashes) == len(tokens) + 1
    cuts = set((t.units[1:] - 1).tolist())
    assert {i for i, e in enumerate(ends) if e} <= cuts
    assert np.diff(t.first).tolist() == [len(tokens), 0, 0, 0, 1] and np.diff(t.first_unit)[1:].tolist() == [0, 0, 0, 1]


def test_cuts_depend_on_few_tokens_around():
    rng = random.Random(4)
    middle = words(rng, 200, 10 ** 6)
    a, b = (units_of(" ".join(words(rng, n, 10 ** 6) + middle + words(rng, 9, 10 ** 6))) for n in (17, 50))
    a, b = ({x - shift for x, _ in u if 8 <= x - shift < 192} for u, shift in ((a, 17), (b, 50)))
    assert a == b and 25 < len(a) < 80


def test_runs_equal_the_plain_version(spark):
    """Sentence spans against brute force: stops, none, few words, lines, Han text, one very long text."""
    rng = random.Random(21)
    han = lambda n: "".join(chr(rng.randrange(0x4e00, 0x9000)) for _ in range(n))        # noqa: E731
    rows = []
    for k in range(60):
        n = rng.choice([20, 35, 51, 60, 90])
        passage = words(rng, n, 10 ** 6)
        if k % 3 == 0:
            passage = [w + "." * (rng.random() < 0.1) for w in passage]
        if k % 5 == 0:
            passage = [rng.choice(["la", "di", "dum", "tralala"]) for _ in range(n)]      # few words
        if k % 7 == 0:
            passage = [han(9) + "\u3002" + han(14) + "\u3002" for _ in range(4)]
        if k % 11 == 0:
            passage = ["And"] * n
        for i in (3 * k, 3 * k + 1, 3 * k + 2):
            sep = rng.choice([" ", "  ", "\n"]) if k % 4 == 0 else " "
            rows.append((i, sep.join(words(rng, rng.randrange(0, 60), 10 ** 6) + passage + words(rng, rng.randrange(1, 60), 10 ** 6))))
    rows.append((500, " ".join(words(rng, 30_000, 10 ** 6) + rows[4][1].split() + words(rng, 30_000, 10 ** 6))))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r for r in sentences.dedup_sentences(df).collect()}
    want = plain_dedup(rows, sentences.MIN_PASSAGE)
    for i, t in rows:
        assert plain_sentences(got[i].text)[0] == want[i], i
        assert got[i].removed_words == len(plain_sentences(t)[0]) - len(want[i])
    assert got[500].removed_words > 0 and sum(r.removed_words > 0 for r in got.values()) > 60


def test_passages_of_51_words_are_caught_over_many_seeds(spark):
    """With and without stops, in varied surroundings: what stays is under half of it, and nothing else goes."""
    rng = random.Random(11)
    rows, passages = [], []
    for k in range(600):
        passage = words(rng, 51, 10 ** 6)
        if k % 2:
            passage = [w + "." * (rng.random() < 0.1) for w in passage]
        passages.append(passage)
        for i in (2 * k, 2 * k + 1):
            rows.append((i, " ".join(words(rng, rng.randrange(0, 40), 10 ** 6) + passage + words(rng, rng.randrange(0, 40), 10 ** 6))))
    got = {r.doc_id: r for r in sentences.dedup_sentences(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    stay = []
    for k, passage in enumerate(passages):
        assert got[2 * k].text == rows[2 * k][1]
        left = got[2 * k + 1].text.split()
        stay.append(len(set(passage) & set(left)))
        assert len(set(rows[2 * k + 1][1].split()) - set(passage) - set(left)) == 0
    assert np.mean([s < 51 for s in stay]) >= 0.99 and np.mean(stay) < 15


def test_scripts_without_spaces_are_deduplicated(spark):
    rng = random.Random(6)
    sentence_ = lambda: "".join(chr(rng.randrange(0x4e00, 0x9000)) for _ in range(rng.randrange(6, 20))) + "\u3002"
    shared, lines = "".join(sentence_() for _ in range(40)), "\n".join(sentence_()[:-1] for _ in range(20))
    rows = [(i, sentence_() + shared + sentence_()) for i in range(6)] + [(i, sentence_() + "\n" + lines + "\n" + sentence_()) for i in range(6, 10)]
    got = {r.doc_id: r for r in sentences.dedup_sentences(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0].text == rows[0][1] and got[6].text == rows[6][1]
    for i, t in rows:
        if i not in (0, 6):
            assert len(got[i].text) < 60 and got[i].n_removed > 15


def test_short_covered_sentences_go(spark):
    """Three shared sentences of 15 words: all of them go, whatever stands around; with ``min_passage`` they stay."""
    rng = random.Random(15)
    shared = " ".join(" ".join(words(rng, 5, 10 ** 6)) + "." for _ in range(3))
    own = [" ".join(" ".join(words(rng, 9, 10 ** 6)) + "." for _ in range(4)) for _ in range(6)]
    rows = [(i, f"{own[2 * i]} {shared} {own[2 * i + 1]}") for i in range(3)] + [(3, shared), (4, "\n".join(shared.split(". ")))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in sentences.dedup_sentences(df).collect()}
    assert got[0].text == rows[0][1] and got[0].n_removed == 0
    for i in (1, 2):
        assert got[i].text == f"{own[2 * i]} {own[2 * i + 1]}" and got[i].removed_words == 15 and got[i].n_removed >= 3
    assert got[3].text == "" and got[3].removed_words == 15
    assert got[4].text == rows[4][1]                      # other words: the stops of two are missing
    assert {r.doc_id: r.text for r in sentences.dedup_sentences(df, min_passage=16).collect()} == dict(rows)


def test_repeats_within_a_document(spark):
    rng = random.Random(9)
    passage = " ".join(" ".join(words(rng, 8, 10 ** 6)) + "." for _ in range(6))
    text = f"start of it. {passage} between them. {passage} the end."
    df = spark.createDataFrame([(1, text), (2, "alone here.")], "doc_id long, text string")
    got = {r.doc_id: r for r in sentences.dedup_sentences(df).collect()}
    assert got[1].text == text                            # no other document holds it
    got = {r.doc_id: r for r in sentences.dedup_sentences(df, within=True).collect()}
    assert got[1].text.startswith(f"start of it. {passage}") and len(got[1].text) < len(text) - len(passage) / 2


def plain_once(rows):
    """Texts' kept tokens: every run of three sentences against all places before, in its own text as well."""
    first, spans = {}, {i: [] for i, _ in rows}
    for i, text in sorted(rows):
        tokens, units = plain_sentences(text)[0], units_of(text)
        for k in range(len(units) - sentences.SENTENCES + 1):
            a, b = units[k][0], units[k + sentences.SENTENCES - 1][1]
            run = tuple(tuple(tokens[x:y]) for x, y in units[k:k + sentences.SENTENCES])
            if first.setdefault(run, (i, a)) != (i, a):
                spans[i].append((a, b))
    return {i: [w for k, w in enumerate(plain_sentences(t)[0]) if not any(a <= k < b for a, b in spans[i])] for i, t in rows}


def test_every_run_of_three_sentences_is_left_once(spark):
    """Short runs and those a document repeats itself go from text_once; ``text`` stays as it was."""
    rng = random.Random(31)
    short = ["Yes it is. No. So be it.", "Why? Why not? Who asks?", "Ja. Nein. Doch."]
    own = lambda: " ".join(sentence(rng, rng.randrange(1, 9)) for _ in range(rng.randrange(1, 7)))        # noqa: E731
    rows = []
    for i in range(60):
        parts = [own() for _ in range(3)]
        parts += [rng.choice(short)] * (i % 3 == 0) + [parts[0]] * (i % 4 == 1) + ["La la. " * 5] * (i % 10 == 2)
        rng.shuffle(parts)
        rows.append((i, rng.choice([" ", "\n"]).join(parts)))
    rows += [(70, None), (71, ""), (72, "Ja. Nein."), (73, " ".join(words(rng, 40, 20) * 3))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in sentences.dedup_sentences(df.repartition(4), once=True).collect()}
    want, before = plain_once(rows), plain_dedup(rows, sentences.MIN_PASSAGE)
    for i, t in rows:
        assert plain_sentences(got[i].text_once)[0] == want[i], i
        assert plain_sentences(got[i].text)[0] == before[i], i
        assert (got[i].n_repeated == 0) == (len(want[i]) == len(plain_sentences(t)[0]))
    assert got[70].text_once is None and got[71].text_once == ""
    assert sum(r.n_repeated > r.n_removed for r in got.values()) > 20
    twice = spark.createDataFrame([(1, "Ja. Nein. Doch."), (1, "Ja. Nein. Doch."), (None, "Doch. Ja. Nein. Doch.")], "doc_id long, text string")
    got = {r.doc_id: r.text_once for r in sentences.dedup_sentences(twice, once=True).collect()}
    assert got == {None: "Doch. Ja. Nein. Doch.", 1: ""}


def test_op9_query_leaves_no_run_twice(spark, tmp_path):
    text = "One here. Two there. Three now. "
    rows = [(1, text + "Other words follow. " + text), (2, "Before it. " + text), (3, "Nothing. Else.")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in sentences.op9_sentence_dedup(spark, str(tmp_path)).collect()}
    assert got[1].text_once == text + "Other words follow. " and got[2].text_once == "Before it. "
    assert (got[1].n_repeated, got[2].n_repeated, got[3].n_repeated) == (3, 3, 0) and got[3].text_once == rows[2][1]


def test_plans_stay_small(spark, capsys):
    """What is read several times is written before, so that the driver plans it once."""
    def shuffles(df):
        capsys.readouterr()
        df.explain()
        return capsys.readouterr().out.count("Exchange ")
    rng = random.Random(2)
    docs = spark.createDataFrame([(i, " ".join(words(rng, 40)), "ab"[i % 2]) for i in range(20)], "doc_id long, text string, source string")
    copies = mixing.whole_copies(mixing.taken_words(docs))
    assert shuffles(copies) < 20 and copies.count() > 0
    members = spark.createDataFrame([(1, i, 10 + i % 3) for i in range(30)], "head long, ref long, n long")
    dealt = jaccard._blocks(members.select("head", "ref"), members)
    assert shuffles(dealt) < 12 and sorted(r.ref for r in dealt.collect()) == list(range(30))


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Every stage's input and output, as pandas, and the tables' folder."""
    rng = random.Random(8)
    folder = tmp_path_factory.mktemp("corpus")
    base = " ".join(sentence(rng, 12) for _ in range(10))
    passage = " ".join(sentence(rng, 10) for _ in range(7))
    rows, labels = [], []
    for i in range(400):
        text = " ".join(sentence(rng, rng.randrange(5, 25)) for _ in range(rng.randrange(2, 9)))
        if i % 8 == 0:
            text += " you vilescum horrid"
            labels.append((i, 1, 1))
        else:
            labels.append((i, 1, 0))
        if i % 10 == 3:
            text = base.replace("w1", "q", i % 3)
        if i % 10 == 5:
            text += " " + passage
        rows.append((i, text, "en", rng.choice("aab"), len(text)))
    rows += [(900, None, "en", "a", 0), (901, "", None, None, 0), (None, "lonely words here", "en", "b", 5)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumn("row_key", F.lit("clash"))
    seen = [docs.toPandas()]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, str(folder)).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        seen.append(docs.toPandas())
    return seen, str(folder)


def test_pipeline_stages(stages):
    seen, _ = stages
    for df in seen[1:-1]:
        assert list(df.columns) == corpus_pipeline.COLUMNS
    start, clean, single, cut, mixed, packed = seen
    toxic = start[start.text.fillna("").str.contains("vilescum")]
    assert set(start.doc_id.dropna()) - set(clean.doc_id.dropna()) == set(toxic.doc_id)
    rows = [(int(i) if i == i else -1, t) for i, t in zip(clean.doc_id, clean.text)]
    want, _ = brute_components(rows)
    assert sorted(single.doc_id.fillna(-1)) == sorted(set(want.values()))
    # sentences: every run against every other document
    rows = [(int(i) if i == i else -1, t) for i, t in zip(single.doc_id, single.text)]
    want = plain_dedup(rows, sentences.MIN_PASSAGE)
    left = {int(i) if i == i else -1: t for i, t in zip(cut.doc_id, cut.text)}
    assert {i: plain_sentences(t)[0] for i, t in left.items()} == {i: want[i] for i, t in rows if want[i] or not (t or "").split()}
    assert sum(len(v) for v in want.values()) < sum(len((t or "").split()) for _, t in rows)
    # the mix: sources' words near their targets (to about a document), no document over 3 times, texts unchanged
    sizes = cut.assign(n=cut.text.fillna("").str.split().str.len())
    total = sizes.groupby("source", dropna=False).n.sum()
    weights = dict(zip(sorted(x for x in total.index if x == x and x is not None), (5, 2, 1)))
    goal, open_, rest = {}, set(weights), total.sum()
    while open_:                                            # shares stop at three times their source
        full = {s for s in open_ if rest * weights[s] / sum(weights[x] for x in open_) > 3 * total[s]}
        if not full:
            goal |= {s: rest * weights[s] / sum(weights[x] for x in open_) for s in open_}
            break
        goal |= {s: 3 * total[s] for s in full}
        rest -= sum(3 * total[s] for s in full)
        open_ -= full
    m = mixed.assign(n=mixed.text.fillna("").str.split().str.len()).groupby("source", dropna=False).n.sum()
    assert all(abs(m[s] - goal[s]) <= sizes.n.max() * 1.5 for s in goal)
    assert mixed.groupby("doc_id").size().max() <= 3
    texts = dict(zip(cut.doc_id.fillna(-1), cut.text.fillna("")))
    assert all(texts[i] == t for i, t in zip(mixed.doc_id.fillna(-1), mixed.text.fillna("")))
    assert (packed.groupby("sequence_id").length.sum() <= 4096).all()
    assert sorted(packed[packed.piece == 0].doc_id.fillna(-1)) == sorted(mixed.doc_id.fillna(-1))


def test_run_is_the_stages_in_turn(spark, stages):
    seen, folder = stages
    got = corpus_pipeline.run(spark, folder).toPandas()
    key = ["doc_id", "piece", "length", "ids_crc32"]
    a, b = (x[key].fillna(-1).sort_values(key).reset_index(drop=True) for x in (got, seen[-1]))
    assert a.equals(b)
