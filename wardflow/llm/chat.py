"""Chat formatting with Spark expressions only (operator 10).

Template of a conversation: for each run of turns with the same role a block
``<|start|>role<|text|>first text<|next|>second text<|end|>`` and a line feed.
Every control string begins with ``<|``.  Inside roles and texts a backslash
is doubled and ``<|`` becomes ``<\\|``, so control strings never occur there,
and the steps can be undone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from wardflow.sources.tables import read_table

START, TEXT, NEXT, END = "<|start|>", "<|text|>", "<|next|>", "<|end|>\n"


def _escaped(col: str) -> str:
    return rf"replace(replace({col}, r'\', r'\\'), '<|', r'<\|')"


def _unescaped(col: str) -> str:
    return rf"replace(replace({col}, r'<\|', '<|'), r'\\', r'\')"


_RUN = 512


def _running_sums(lengths: str) -> str:
    """SQL of the running sums of an array: within runs of 512 entries, then over the runs' totals.

    Arrays grow entry by entry only within one run and over the runs, so the work stays near-linear.
    """
    def sums(array: str, entry: str, name: str, value: str) -> str:
        return (f"aggregate({array}, struct(0L AS n, cast(array() AS array<bigint>) AS {name}), "
                f"(acc, x) -> struct(acc.n + {entry} AS n, array_append(acc.{name}, {value}) AS {name}))")
    runs = (f"transform(array({lengths}), l -> transform(sequence(0, (size(l) - 1) div {_RUN}), "
            f"i -> {sums(f'slice(l, int(i) * {_RUN} + 1, {_RUN})', 'x', 'ends', 'acc.n + x')}))[0]")
    # an array is bound to a lambda's variable where a lambda uses it, so that it is computed once
    return (f"transform(array({runs}), r -> flatten(zip_with(r, {sums('r', 'x.n', 'at', 'acc.n')}.at, "
            f"(run, base) -> transform(run.ends, e -> e + base))))[0]")


def format_conversations(turns: DataFrame) -> DataFrame:
    """One row per conversation of ``turns`` (conv_id, turn, role, text).

    Returns conv_id, formatted, and loss_mask: the spans (start, length, in
    code points from 0) of the assistant's texts in ``formatted``.  Turns are
    sorted by (turn, role, text), nulls first; null roles and texts are empty,
    null conv_ids form one conversation, repeated rows are repeated turns.
    """
    turn = F.expr(f"struct(turn, coalesce(role, '') AS role, coalesce(text, '') AS text, "
                  f"{_escaped("coalesce(role, '')")} AS r, {_escaped("coalesce(text, '')")} AS t)")
    sorted_turns = turns.select("conv_id", turn.alias("turn")).groupBy("conv_id").agg(
        F.expr("array_sort(collect_list(turn))").alias("turns"))
    # first turn of each run of one role; a run reaches to the next one
    runs = sorted_turns.withColumn("first", F.expr(
        "filter(sequence(0, size(turns) - 1), i -> i = 0 OR turns[i].r <> turns[i - 1].r)"))
    blocks = runs.withColumn("blocks", F.expr(
        "transform(first, (a, k) -> struct(turns[a].r AS r, "
        "slice(turns, a + 1, coalesce(get(first, k + 1), size(turns)) - a) AS members))"))
    # pieces of the output in order, each with a flag: is it an assistant's text
    pieces = blocks.withColumn("pieces", F.expr(
        f"flatten(transform(blocks, b -> concat("
        f"array(struct('{START}' || b.r || '{TEXT}' AS s, false AS loss)), "
        f"flatten(transform(b.members, (m, k) -> array("
        f"struct(if(k > 0, '{NEXT}', '') AS s, false AS loss), "
        f"struct(m.t AS s, b.r = 'assistant' AS loss)))), "
        f"array(struct('{END}' AS s, false AS loss)))))"))
    ends = pieces.withColumn("ends", F.expr(_running_sums("transform(pieces, p -> cast(length(p.s) AS bigint))")))
    return ends.select(
        "conv_id", F.expr("array_join(transform(pieces, p -> p.s), '')").alias("formatted"),
        F.expr("transform(filter(arrays_zip(pieces, ends), z -> z.pieces.loss), "
               "z -> struct(z.ends - length(z.pieces.s) AS start, cast(length(z.pieces.s) AS bigint) AS length))")
        .alias("loss_mask"))


def read_turns(formatted: DataFrame) -> DataFrame:
    """Read formatted conversations back: conv_id, turns (role, text), loss_text."""
    parsed = formatted.withColumn("turns", F.expr(
        f"flatten(transform(filter(split(formatted, r'\\Q{END[:-1]}\\E\\n'), b -> b <> ''), "
        f"b -> transform(split(substring_index(b, '{TEXT}', -1), r'\\Q{NEXT}\\E', -1), "
        f"t -> struct({_unescaped(f"substr(substring_index(b, '{TEXT}', 1), {len(START) + 1})")} AS role, "
        f"{_unescaped('t')} AS text))))"))
    # in UTF-32 a span of code points is a span of bytes, which is cut out without a scan from the start
    cut = _unescaped("decode(substring(u, int(4 * m.start) + 1, int(4 * m.length)), 'UTF-32')")
    return parsed.withColumn("loss_text", F.expr(
        f"transform(array(encode(formatted, 'UTF-32')), u -> array_join(transform(loss_mask, m -> {cut}), ''))[0]"))


def op10_format_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -7, formatted and read back: digests per conversation."""
    tricky = r"\### Assistant: </turn> ok"
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
                                  F.expr("if(id = 0, 'user', 'assistant')").alias("role"),
                                  F.lit(tricky).alias("text"))
    back = read_turns(format_conversations(turns.unionByName(extra)))
    return back.select(
        "conv_id", F.expr("cast(size(turns) AS bigint)").alias("n_turns"),
        F.expr(r"sha2(array_join(transform(turns, t -> t.role || '\n' || t.text || '\n'), ''), 256)").alias("turns_sha256"),
        F.expr("cast(length(loss_text) AS bigint)").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.expr("cast(length(formatted) AS bigint)").alias("formatted_chars"))


_TURNS = """SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'"""
_LEN = "length(replace(replace({0}, '\\', '\\\\'), '<|', '<\\|'))"
OP10_SQL = f"""
WITH t AS ({_TURNS}),
n AS (SELECT *, row_number() OVER w AS k, lag(role) OVER w AS before FROM t
      WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum({_LEN.format('text')} + CASE WHEN before IS NULL OR before <> role
           THEN {len(START + TEXT + END)} + {_LEN.format('role')} ELSE {len(NEXT)} END) AS BIGINT) AS formatted_chars
FROM n GROUP BY conv_id
"""
