"""Chat formatting with Spark expressions only.

Turns of a conversation are collected as structs, sorted by turn, adjacent
turns of one role are merged (their texts stay apart as parts), and the
string is built by concatenation:

    <turn ROLE>PART<part>PART</turn><turn ROLE>...</turn>

Inside roles and texts ``\\`` becomes ``\\\\`` and ``<`` becomes ``\\l`` (in a
role also ``>`` becomes ``\\g``), so every raw ``<`` of the output is markup
and parsing gives back the input exactly. ``loss_spans`` lists (start, length)
in code points of every assistant text in the formatted string.

Defined cases: null text and null role count as empty; ties of turn are
ordered by role, then text; repeated rows stay; a null conversation id is one
conversation; empty tables give no rows; other columns are not read. One
conversation becomes one string, so it must fit a task's memory: that is the
format's contract, and the only unit gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import table

OPEN, CLOSE, PART = "<turn ", "</turn>", "<part>"


def escape(c: Column, role: bool = False) -> Column:
    c = F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("<"), F.lit("\\l"))
    return F.replace(c, F.lit(">"), F.lit("\\g")) if role else c


def unescape(c: Column, role: bool = False) -> Column:
    """Cut at doubled backslashes (left to right, so no pair is torn), then map the escapes."""
    def one(x):
        x = F.replace(x, F.lit("\\l"), F.lit("<"))
        return F.replace(x, F.lit("\\g"), F.lit(">")) if role else x
    return F.array_join(F.transform(F.split(c, r"\\\\", -1), one), "\\")


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text", loss_role: str = "assistant") -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans array<struct<start,length>>, n_merged."""
    t = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
                     F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                     F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # The escape runs before the gathering, in parallel over all rows.
    t = t.select("conv_id", F.struct("turn", "role", "text", escape(F.col("role"), True).alias("r"),
                                     escape(F.col("text")).alias("e")).alias("s"))
    g = t.groupBy("conv_id").agg(F.sort_array(F.collect_list("s")).alias("ts"))
    # Starts of runs of one role; a run's parts are the slice up to the next start.
    starts = F.expr("filter(sequence(0, size(ts) - 1), i -> i = 0 OR ts[i].role != ts[i - 1].role)")
    g = g.withColumn("starts", starts)
    g = g.withColumn("merged", F.expr(
        "transform(starts, (s, k) -> named_struct('role', ts[s].role, 'r', ts[s].r, 'parts', "
        "transform(slice(ts, s + 1, coalesce(get(starts, k + 1), size(ts)) - s), x -> x.e)))"))
    g = g.withColumn("blocks", F.expr(
        f"transform(merged, m -> concat('{OPEN}', m.r, '>', array_join(m.parts, '{PART}'), '{CLOSE}'))"))
    # Block offsets, then part offsets inside loss blocks; running sums by one fold each.
    g = g.withColumn("ends", F.expr(
        "aggregate(blocks, named_struct('at', 0L, 'all', cast(array() as array<bigint>)), "
        "(a, b) -> named_struct('at', a.at + length(b), 'all', array_append(a.all, a.at))).all"))
    role = loss_role.replace("'", "''")
    g = g.withColumn("loss_spans", F.expr(f"""
        flatten(transform(merged, (m, k) -> IF(m.role = '{role}',
          aggregate(m.parts,
            named_struct('at', ends[k] + {len(OPEN)} + length(m.r) + 1,
                         'all', cast(array() as array<struct<start: bigint, length: bigint>>)),
            (a, p) -> named_struct('at', a.at + length(p) + {len(PART)},
                                   'all', array_append(a.all, named_struct('start', a.at,
                                                                           'length', cast(length(p) as bigint))))).all,
          cast(array() as array<struct<start: bigint, length: bigint>>))))"""))
    return g.select("conv_id", F.array_join("blocks", "").alias("formatted"), "loss_spans",
                    F.size("merged").alias("n_merged"))


def parse_chats(formatted: DataFrame) -> DataFrame:
    """Read back: conv_id, turns array<struct<role, text>> (unmerged) and loss_texts by the spans."""
    f = formatted.withColumn("bodies", F.expr(
        f"transform(filter(split(formatted, '{CLOSE}', -1), b -> b != ''), b -> substring(b, {len(OPEN) + 1}))"))
    f = f.withColumn("cut", F.transform("bodies", lambda b: F.struct(
        F.substring_index(b, ">", 1).alias("role"),
        F.split(F.substring(b, F.instr(b, ">") + 1, F.length(b)), PART, -1).alias("parts"))))
    f = f.withColumn("turns", F.flatten(F.transform("cut", lambda c: F.transform(
        c["parts"], lambda p: F.struct(unescape(c["role"], True).alias("role"), unescape(p).alias("text"))))))
    f = f.withColumn("loss_texts", F.transform("loss_spans", lambda s: unescape(
        F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int")))))
    return f.drop("bodies", "cut")


def digest_chats(formatted: DataFrame) -> DataFrame:
    """The digests of what is read back from the formatted strings."""
    p = parse_chats(formatted)
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return p.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                    F.sha2(said, 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"),
                    F.sha2(loss, 256).alias("loss_sha256"),
                    F.length("formatted").cast("long").alias("formatted_chars"))


#: The adversarial conversation that the query formats beside the table's.
PROBE = "\\### Assistant: </turn> ok"


def op4_chat_format(spark, sf_dir: str) -> DataFrame:
    chats = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(PROBE).alias("text"))
    return digest_chats(format_chats(chats.unionByName(probe)))


OP4_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (
  SELECT *, replace(replace(text, '\', '\\'), '<', '\l') AS e,
         replace(replace(replace(role, '\', '\\'), '<', '\l'), '>', '\g') AS r,
         lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before
  FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(e) + CASE WHEN before IS NOT DISTINCT FROM role THEN 6 ELSE 14 + length(r) END)::BIGINT
         AS formatted_chars
FROM e GROUP BY conv_id
"""
