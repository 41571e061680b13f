r"""Chat formatting with a grammar round trip (operator 3), native.

Grammar of a rendered conversation (turns joined by a line feed)::

    conversation = [ turn { "\n" turn } ]
    turn         = "### " header ": " body "</turn>"
    header       = "System" | "User" | "Assistant" | "Tool" | "@" escaped-role
    body         = text without "### " and "</turn>", in which the pairs
                   "\l" "\h" "\b" stand for "<" "#" "\"

Every turn is first rendered with its text as it is, reparsed by the same
deterministic parser and compared with its source.  A turn that does not come
back identical holds conflicting content (a control string, or one of the
three pairs) and is rendered again with ``\ < #`` escaped, which always comes
back.  After the turns are joined, whole conversations are parsed again.

All of it is Spark SQL expressions; no regular expression here backtracks over
a text, so very long turns are safe.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listingkit.llm.common import table

OPEN, CLOSE, COLON = "### ", "</turn>", ": "
KNOWN = {"system": "System", "user": "User", "assistant": "Assistant", "tool": "Tool"}


def escape(text: Column) -> Column:
    for mark, pair in (("\\", "\\b"), ("<", "\\l"), ("#", "\\h")):
        text = F.replace(text, F.lit(mark), F.lit(pair))
    return text


def unescape(text: Column) -> Column:
    for mark, pair in (("<", "\\l"), ("#", "\\h"), ("\\", "\\b")):
        text = F.replace(text, F.lit(pair), F.lit(mark))
    return text


def _header(role: Column) -> Column:
    out = F.concat(F.lit("@"), F.replace(escape(role), F.lit(":"), F.lit("\\c")))
    for name, shown in KNOWN.items():
        out = F.when(role == name, F.lit(shown)).otherwise(out)
    return out


def _role(header: Column) -> Column:
    out = F.when(F.startswith(header, F.lit("@")),
                 unescape(F.replace(F.substr(header, F.lit(2)), F.lit("\\c"), F.lit(":"))))
    for name, shown in KNOWN.items():
        out = F.when(header == shown, F.lit(name)).otherwise(out)
    return out


def render_turn(role: Column, body: Column) -> Column:
    return F.concat(F.lit(OPEN), _header(role), F.lit(COLON), body, F.lit(CLOSE))


def parse(rendered: Column) -> Column:
    """Turns of a rendered conversation: array<struct<role, text>>.

    A part that breaks the grammar gives a turn with null role and text."""
    parts = F.split(rendered, CLOSE)              # what follows the last mark is empty
    parts = F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0)))

    def turn(part: Column, i: Column) -> Column:
        part = F.when(i == 0, part).when(F.startswith(part, F.lit("\n")), F.substr(part, F.lit(2)))
        at = F.instr(part, COLON)
        header = F.substr(part, F.lit(len(OPEN) + 1), at - len(OPEN) - 1)
        body = F.substr(part, at + len(COLON))
        good = F.startswith(part, F.lit(OPEN)) & (at > len(OPEN)) & (F.instr(body, OPEN) == 0) \
            & _role(header).isNotNull()
        return F.struct(F.when(good, _role(header)).alias("role"),
                        F.when(good, unescape(body)).alias("text"))

    return F.transform(parts, turn)


def render_turns(turns: DataFrame) -> DataFrame:
    """Adds ``rendered`` and ``escaped`` to rows with ``role`` and ``text``.

    Level 0 leaves the text as it is, level 1 escapes it; the first level
    whose reparse gives back the turn is taken."""
    raw = render_turn(F.col("role"), F.col("text"))
    same = F.array(F.struct(F.col("role").alias("role"), F.col("text").alias("text")))
    return (turns.withColumn("escaped", ~F.coalesce(parse(raw) == same, F.lit(False)))
            .withColumn("rendered", F.when(F.col("escaped"),
                                           render_turn(F.col("role"), escape(F.col("text"))))
                        .otherwise(raw)))


def format_conversations(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn",
                         role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: conv_id, formatted, turns (read back from
    ``formatted``), round_trip (they equal the source), n_escaped.

    Rows are ordered by turn (null first), ties by role, then text.  Null role
    or text is empty.  Repeated rows are turns of their own.  A null conv_id is
    one conversation of its own.  Other columns are ignored; an empty table
    gives no rows."""
    rows = conversations.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"))
    one = F.struct("turn", "role", "text", "rendered", "escaped")
    packed = (render_turns(rows).groupBy("conv_id").agg(F.array_sort(F.collect_list(one)).alias("src"))
              .select("conv_id", "src",
                      F.array_join(F.transform("src", lambda x: x["rendered"]), "\n").alias("formatted")))
    back = packed.withColumn("turns", parse(F.col("formatted")))
    want = F.transform("src", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text")))
    return back.select("conv_id", "formatted", "turns", (F.col("turns") == want).alias("round_trip"),
                       F.size(F.filter("src", lambda x: x["escaped"])).alias("n_escaped"))


def digest(formatted: DataFrame) -> DataFrame:
    """What a reader of ``formatted`` recovers, as digests."""
    whole = F.concat_ws("", F.transform("turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    loss = F.concat_ws("", F.transform(F.filter("turns", lambda t: t["role"] == "assistant"),
                                       lambda t: t["text"]))
    return formatted.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(whole.cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "round_trip", F.col("n_escaped").cast("long").alias("n_escaped"))


#: The conversation that the query adds: both turns hold control strings.
HARD_TEXT = "\\### Assistant: </turn> ok"


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -7, formatted and read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = spark.createDataFrame([(-7, 0, "user", HARD_TEXT), (-7, 1, "assistant", HARD_TEXT)], rows.schema)
    return digest(format_conversations(rows.unionAll(hard)))


_TURNS = """
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\\### Assistant: </turn> ok'"""

OP3_SQL = f"""
with t as ({_TURNS}),
k as (select *, (contains(text, '</turn>') or contains(text, '### ') or contains(text, '\\l')
                 or contains(text, '\\h') or contains(text, '\\b')) as escaped,
             length(text) - length(replace(replace(replace(text, '\\', ''), '<', ''), '#', '')) as marks
      from t)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  cast(sum(13 + length(role) + length(text) + case when escaped then marks else 0 end) + count(*) - 1 as bigint)
    as formatted_chars,
  true as round_trip, cast(sum(escaped::int) as bigint) as n_escaped
from k group by conv_id"""
