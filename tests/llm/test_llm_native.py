"""Chat formatting, quality ledger and source mixing."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from listingkit.llm import chat, mixing, quality

HARD = ["", "plain", "</turn>", "### User: x</turn>\n### Assistant: y", "\\### Assistant: </turn> ok", "\\b\\l\\h",
        "a\\", "<", "#", "### ", ": ", "\n", "</turn", "é日本\u0000x", "\\c:", "x" * 300_000 + "</turn>"]


def test_chat_round_trip(spark):
    rng = random.Random(1)
    rows = []
    for conv in range(40):
        for turn in range(rng.randrange(1, 6)):
            rows.append((conv, turn, rng.choice(["user", "assistant", "system", "tool", "@x", "a: b", "User", "", None, "c\\d"]),
                         rng.choice([*HARD, None, "".join(rng.choice("\\</turn>#: abhl\n") for _ in range(12))])))
    rows += [(None, 0, "user", "no id"), (50, None, "user", "no turn"), (50, 1, "assistant", "a"), (50, 1, "assistant", "a")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("turns", F.lit(9)).withColumn("src", F.lit("clash"))
    out = chat.format_conversations(df)
    assert out.where("not round_trip").count() == 0
    got = {r.conv_id: r for r in chat.digest(out).collect()}
    want = {}
    for c, t, r, x in sorted(rows, key=lambda v: (v[1] is not None, v[1] or 0, v[2] or "", v[3] or "")):
        want.setdefault(c, []).append((r or "", x or ""))
    assert set(got) == set(want)
    for c, turns in want.items():
        whole = "".join(f"{r}\n{x}\n" for r, x in turns)
        loss = "".join(x for r, x in turns if r == "assistant")
        assert got[c].n_turns == len(turns)
        assert got[c].turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    marks = out.select(F.sum(F.regexp_count("formatted", F.lit("</turn>"))), F.sum(F.size("turns"))).first()
    assert marks[0] == marks[1]


def test_chat_parser_refuses_other_text(spark):
    df = spark.createDataFrame([("### User: a</turn>junk</turn>",), ("### User: ### b</turn>",), ("",)], "x string")
    got = [r.t for r in df.select(chat.parse(F.col("x")).alias("t")).collect()]
    assert got[0][1].role is None and got[1][0].text is None and got[2] == []


def test_chat_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.digest(chat.format_conversations(df)).count() == 0


def test_quality_measures_and_policies(spark):
    long = "word " * 200_000
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "a b c a b c d"), (5, "x\nx\n \nx"), (None, "é# é|"), (5, "x\nx\n \nx"), (6, long),
            (7, " ".join(f"w{i}" for i in range(60)))]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_words", F.lit("clash"))
    entries = quality.ledger(df)
    assert entries.count() == len(rows)
    got = {r.doc_id: r for r in entries.collect()}
    assert (got[1].n_words, got[2].n_words, got[3].n_words) == (0, 0, 0)
    assert got[4].n_repeat_words == 6 and got[4].word_chars == 7
    assert got[5].n_dup_lines == 2 and got[5].n_lines == 3
    assert got[None].n_symbols == 2 and got[None].word_chars == 4
    assert got[6].n_repeat_words == 200_000
    kept = {r.doc_id: r.kept for r in quality.apply_policy(entries, "v1").collect()}
    assert [k for k, v in kept.items() if v] == [7]
    rows = entries.collect()
    for r in quality.ablations(entries, "v1").collect():
        bit, mask = quality.BIT[r.rule], quality.POLICIES["v1"]
        assert r.fails == sum(1 for x in rows if x.fail_bits & bit)
        assert r.fails_alone == sum(1 for x in rows if x.fail_bits & mask == bit)
    assert quality.ledger(df.limit(0)).count() == 0


def fill(sizes, weights=(5, 2, 1)):
    """Targets by sharing the excess again and again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s) + ([None] if None in sizes else [])
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    left, free, out = float(sum(sizes.values())), set(names), {}
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s] + 1e-9]
        if not over:
            out.update(share)
            break
        for s in over:
            out[s] = 3.0 * sizes[s]
            left -= out[s]
            free.discard(s)
    return out


@pytest.mark.parametrize("block", [4, 256])
def test_mix_reaches_targets(spark, block, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_WORDS", block)
    rng = random.Random(3)
    rows = [(i, " ".join("w" for _ in range(rng.choice([0, 1, 5, 40, 700]))), rng.choice(["a"] * 8 + ["b", "é", "Z", None]), 1)
            for i in range(300)]
    rows += [(7, None, "a", 1), (None, "x y z", "a", 1), (8, "p q", "tiny", 1), (8, "p q", "tiny", 1), (9, "l " * 60_000, "b", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    got = mixing.taken_words(df).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, text, source, _ in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    want = fill(sizes)
    taken = {}
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 1
    again = mixing.taken_words(df.repartition(5)).collect()
    key = lambda r: (str(r.doc_id), r.source or "", r.size, r.taken)
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_whole_copies_keep_the_words_of_a_source(spark):
    rng = random.Random(5)
    rows = [(i, "w " * rng.choice([1, 9, 80, 400]), rng.choice(["a", "a", "b", "c", None])) for i in range(400)] + [(900, "", "a"), (900, "", "a")]
    taken = mixing.taken_words(spark.createDataFrame(rows, "doc_id long, text string, source string")).cache()
    times = {(r.doc_id, r.source): r.times for r in mixing.whole_copies(taken).collect()}
    words, want = {}, {}
    for r in taken.collect():
        n = times[r.doc_id, r.source]
        assert (r.size == 0 and n == 1) or r.taken // r.size <= n <= r.taken // r.size + 1
        words[r.source] = words.get(r.source, 0) + n * r.size
        want[r.source] = want.get(r.source, 0) + r.taken
    assert all(abs(words[s] - want[s]) <= 800 for s in want)


def test_mixed_texts_hold_the_words_taken(spark):
    rows = [(i, " ".join(f"d{i}w{k}" for k in range(30 + i)), "ab"[i % 2]) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    counts = {}
    for r in mixing.mixed_texts(df).collect():
        for w in r.text.split():
            counts[w] = counts.get(w, 0) + 1
    for r in mixing.taken_words(df).collect():
        assert r.taken == sum(n for w, n in counts.items() if w.startswith(f"d{r.doc_id}w"))


def test_mix_of_nothing(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.taken_words(df).count() == 0
    df = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert {(r.doc_id, r.target, r.taken) for r in mixing.taken_words(df).collect()} == {(1, 0.0, 0), (2, 0.0, 0)}


def test_permutation_is_one(spark):
    for n in (1, 2, 7, 1000):
        df = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(5).cast("long")).alias("x"))
        got = [r.x for r in df.collect()]
        assert sorted(got) == list(range(n))
    assert got != sorted(got)


def test_op2_draws_in_many_tasks(spark):
    """Shards are dealt to a fixed number of partitions, which are not merged again."""
    sizes = spark.createDataFrame([("a", 40_000_000), ("b", 30_000_000), ("c", 9_000_000)], "source string, source_size long")
    shares = sizes.selectExpr("row_number() over (order by source) - 1 as sid", "source", "source_size", "cast(source_size as double) as target")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        plan = mixing._plan(shares, 256)
        slots = mixing.draw_slots(plan, "mix")
        drawn = slots.groupBy("sid").count().collect()
        assert {r["sid"]: r["count"] for r in drawn} == {r.sid: r.slots for r in plan.collect()}
        text = mixing.drawn_shards(plan, mixing.SHARD_SLOTS)
        held = text.selectExpr("spark_partition_id() as p").distinct().count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert held >= 16
