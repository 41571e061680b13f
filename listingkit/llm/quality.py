"""Quality rules as a bitmask ledger (operator 10).

Every rule is evaluated once per document.  The ledger keeps the measurements
and one ``fail_bits`` integer; a policy is a named, versioned mask over those
bits, so applying another policy, or asking what a rule alone removes, reads
the ledger and never the texts again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listingkit.llm.common import table

SYMBOLS = b"#*$%&|<>"
_SPACE = np.frombuffer(b" \t\n\v\f\r", np.uint8)
_SYMBOL = np.frombuffer(SYMBOLS, np.uint8)

MEASURES = ("n_words", "word_chars", "n_symbols", "n_caps", "n_lines", "n_dup_lines",
            "n_repeat_words", "n_distinct")


def _repeat_words(ids: np.ndarray, distinct: int) -> int:
    """Words inside 3-word windows that are found at least twice."""
    n = len(ids)
    if n < 4:
        return 0
    pair = np.unique(ids[:-2] * distinct + ids[1:-1], return_inverse=True)[1]
    _, place, count = np.unique(pair * distinct + ids[2:], return_inverse=True, return_counts=True)
    again = count[place] > 1
    covered = np.zeros(n, bool)
    for s in range(3):
        covered[s:n - 2 + s] |= again
    return int(covered.sum())


def measure_text(text: str | None) -> tuple[int, ...]:
    """Measurements of one whole text, in the order of ``MEASURES``."""
    raw = (text or "").encode()
    words = raw.split()
    if not words:
        return (0,) * len(MEASURES)
    seen: dict[bytes, int] = {}
    ids = np.array([seen.setdefault(w, len(seen)) for w in words], np.int64)
    count = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    points = len(raw) - int(count[0x80:0xC0].sum())
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return (len(words), points - int(count[_SPACE].sum()), int(count[_SYMBOL].sum()),
            int(count[65:91].sum()), len(lines), len(lines) - len(set(lines)),
            _repeat_words(ids, len(seen)), len(seen))


def _c(name: str) -> Column:
    return F.col(name)


#: Rule name -> condition under which it fails, over the measurements.  The
#: position is the bit: append only, never reorder.
RULES: list[tuple[str, Callable[[], Column]]] = [
    ("few_words", lambda: _c("n_words") < 50),
    ("repeated_windows", lambda: 100 * _c("n_repeat_words") > 50 * _c("n_words")),
    ("symbols", lambda: 10 * _c("n_symbols") > _c("n_words")),
    ("capitals", lambda: 10 * _c("n_caps") > 3 * _c("word_chars")),
    ("duplicate_lines", lambda: 2 * _c("n_dup_lines") > _c("n_lines")),
    ("short_words", lambda: _c("word_chars") < 2 * _c("n_words")),
    ("long_words", lambda: _c("word_chars") > 15 * _c("n_words")),
    ("few_distinct", lambda: 20 * _c("n_distinct") < _c("n_words")),
]
BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}
BASE = BIT["few_words"] | BIT["repeated_windows"]
#: Versioned policies: the rules whose failure rejects a document.
POLICIES = {
    "base": BASE,
    "v1": BASE | BIT["symbols"] | BIT["capitals"] | BIT["duplicate_lines"],
    "v2": BASE | BIT["symbols"] | BIT["capitals"] | BIT["duplicate_lines"] | BIT["short_words"] | BIT["long_words"],
}


def ledger(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, the measurements and ``fail_bits``, one row per input row.

    Null and blank texts have no words: all measurements are 0 and the
    ``few_words`` bit is set.  Repeated rows and null ids keep a row each."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = zip(*map(measure_text, b.column(1).to_pylist())) if b.num_rows else [()] * len(MEASURES)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, pa.int64()) for c in cols)],
                                             names=["doc_id", *MEASURES])

    measured = rows.mapInArrow(measure, f"doc_id {kind}, " + ", ".join(f"{m} long" for m in MEASURES))
    bits = F.lit(0).cast("long")
    for name, fails in RULES:
        bits = bits.bitwiseOR(F.when(fails(), F.lit(BIT[name])).otherwise(F.lit(0)).cast("long"))
    return measured.withColumn("fail_bits", bits)


def apply_policy(entries: DataFrame, policy: str = "v1") -> DataFrame:
    """Adds ``kept``: no rule of the policy failed."""
    return entries.withColumn("kept", F.col("fail_bits").bitwiseAND(F.lit(POLICIES[policy])) == 0)


def ablations(entries: DataFrame, policy: str = "v1") -> DataFrame:
    """Per rule of the policy: rows it fails, rows only it fails (what dropping
    the rule would bring back), and rows the whole policy rejects.

    Rows are first counted by ``fail_bits`` (at most 2^rules groups)."""
    mask = POLICIES[policy]
    hit = F.col("fail_bits").bitwiseAND(F.lit(mask))
    groups = entries.groupBy(hit.alias("hit")).agg(F.count("*").alias("n"))
    names = [n for n, _ in RULES if BIT[n] & mask]
    one = F.explode(F.array(*(F.struct(F.lit(n).alias("rule"), F.lit(BIT[n]).cast("long").alias("bit"))
                              for n in names))).alias("r")
    g = groups.select("hit", "n", one).select("hit", "n", "r.rule", "r.bit")
    fails = F.col("hit").bitwiseAND(F.col("bit")) != 0
    return g.groupBy("rule").agg(
        F.sum(F.when(fails, F.col("n")).otherwise(0)).alias("fails"),
        F.sum(F.when(F.col("hit") == F.col("bit"), F.col("n")).otherwise(0)).alias("fails_alone"),
        F.sum(F.when(F.col("hit") != 0, F.col("n")).otherwise(0)).alias("policy_rejects"))


def op10_quality_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of all documents with the verdict of policy v1."""
    entries = apply_policy(ledger(table(spark, sf_dir, "documents")), "v1")
    base = F.col("fail_bits").bitwiseAND(F.lit(BASE)) != 0
    return entries.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                          base.alias("base_failed"), "kept", "fail_bits", "n_caps", "n_lines", "n_distinct")


OP10_SQL = r"""
with w as (
  select row_number() over () as r, doc_id, coalesce(text, '') as text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents),
win as (
  select r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] as k
  from (select r, words, unnest(generate_series(1, len(words) - 2)) as i from w where len(words) >= 3)),
rep as (select r, i from (select r, i, count(*) over (partition by r, k) as n from win) where n > 1),
cov as (select r, count(distinct i + s) as n from rep, (values (0), (1), (2)) as o(s) group by r),
lines as (
  select r, count(*) as n_lines, count(*) - count(distinct l) as n_dup
  from (select r, unnest(string_split(text, chr(10))) as l from w)
  where regexp_matches(l, '[^\x20\x09-\x0D]') group by r),
m as (
  select doc_id, len(words) as n_words, length(array_to_string(words, '')) as word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as n_symbols,
    coalesce(lines.n_dup, 0) as n_dup_lines, coalesce(cov.n, 0) as n_repeat_words,
    length(regexp_replace(text, '[^A-Z]', '', 'g')) as n_caps, coalesce(lines.n_lines, 0) as n_lines,
    len(list_distinct(words)) as n_distinct
  from w left join cov using (r) left join lines using (r)),
b as (
  select *, (n_words < 50)::int + 2 * (100 * n_repeat_words > 50 * n_words)::int
    + 4 * (10 * n_symbols > n_words)::int + 8 * (10 * n_caps > 3 * word_chars)::int
    + 16 * (2 * n_dup_lines > n_lines)::int + 32 * (word_chars < 2 * n_words)::int
    + 64 * (word_chars > 15 * n_words)::int + 128 * (20 * n_distinct < n_words)::int as bits from m)
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols,
  n_dup_lines::bigint as n_dup_lines, n_repeat_words::bigint as n_repeat_words,
  (bits & 3) <> 0 as base_failed, (bits & 31) = 0 as kept, bits::bigint as fail_bits,
  n_caps::bigint as n_caps, n_lines::bigint as n_lines, n_distinct::bigint as n_distinct
from b"""
