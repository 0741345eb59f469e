"""Chat formatting with a grammar round trip (DataFrame functions only).

A conversation is rendered as one text, a turn after the other::

    ### role: text</turn>

followed by a newline. A deterministic parser reads it back. A conversation whose recovered
turns differ from the source is rendered again with its conflicting turns escaped, then with
every turn escaped; the last form always parses back, and the job fails if it should not.

Escapes: a backslash becomes ``\\b``, ``</turn>`` becomes ``\\l/turn>``, ``### `` becomes
``\\h## ``; in roles also ``:`` becomes ``\\c`` and a newline ``\\n``. Every backslash of an
escaped text starts a code, so replacing the codes in turn, ``\\b`` last, restores the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm.common import stored

END = "</turn>"
HEAD = "### "
#: SQL text of one backslash.
_B = "chr(92)"
#: A text that needs escapes: a control string, or a backslash that reads as a code.
_CONFLICT = f"(contains(t.text, '{END}') or contains(t.text, '{HEAD}') or t.text rlike '[\\\\\\\\][blh]')"


def _escape(x: str) -> str:
    return (f"replace(replace(replace({x}, {_B}, {_B} || 'b'), '{END}', {_B} || 'l/turn>'),"
            f" '{HEAD}', {_B} || 'h## ')")


def _unescape(x: str) -> str:
    return f"replace(replace(replace({x}, {_B} || 'l', '<'), {_B} || 'h', '#'), {_B} || 'b', {_B})"


def _escape_role(x: str) -> str:
    return f"replace(replace({_escape(x)}, ':', {_B} || 'c'), chr(10), {_B} || 'n')"


def _unescape_role(x: str) -> str:
    return _unescape(f"replace(replace({x}, {_B} || 'c', ':'), {_B} || 'n', chr(10))")


def render(turns: str, text: str) -> Column:
    """The rendered form of an array of (turn, role, text) structs; ``text`` is the SQL of a turn's body."""
    return F.expr(f"array_join(transform({turns}, t -> '{HEAD}' || {_escape_role('t.role')} || ': ' || {text}"
                  f" || '{END}' || chr(10)), '')")


def parse(formatted: str) -> Column:
    """The (role, text) structs read back from a rendered conversation; null fields where the text
    does not follow the grammar. Bodies are the pieces between end marks; each begins with a head."""
    pieces = f"split({formatted}, '{END}', -1)"
    body = "if(i = 0, p, substring(p, 2))"
    at = "locate(': ', x, 5)"
    fits = f"(i = 0 or startswith(p, chr(10))) and startswith(x, '{HEAD}') and {at} > 0 and not contains(substring(x, 5), '{HEAD}')"
    return F.expr(
        f"transform(slice({pieces}, 1, size({pieces}) - 1), (p, i) -> transform(array({body}), x -> "
        f"if({fits}, struct({_unescape_role(f'substring(x, 5, {at} - 5)')} as role, {_unescape(f'substring(x, {at} + 2)')} as text),"
        f" struct(cast(null as string) as role, cast(null as string) as text)))[0])")


def format_chats(rows: DataFrame) -> DataFrame:
    """One row a conversation: ``conv_id, formatted, level`` (0 verbatim, 1 conflicting turns escaped,
    2 all turns escaped).

    Defined cases: turns are ordered by turn (null first), then role and text, so ties and repeated
    rows have one order and each row is a turn; a null text or role is empty; rows with a null conv_id form one
    conversation; an empty table gives no rows; other columns are ignored. A conversation's text is
    one value, so its turns meet in one task.
    """
    turns = (rows.groupBy(F.col("conv_id"))
             .agg(F.array_sort(F.collect_list(F.struct(
                 "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")))).alias("turns"))
             .withColumn("source", F.expr("transform(turns, t -> struct(t.role as role, t.text as text))")))
    some = f"if({_CONFLICT}, {_escape('t.text')}, t.text)"
    tried = turns.withColumn("form0", render("turns", "t.text")).withColumn("back0", parse("form0"))
    tried = tried.withColumn("form1", F.when(F.expr("back0 = source"), F.lit(None)).otherwise(render("turns", some)))
    tried = tried.withColumn("back1", F.when(F.col("form1").isNotNull(), parse("form1")))
    tried = tried.withColumn("form2", F.when(F.expr("form1 is null or back1 = source"), F.lit(None))
                             .otherwise(render("turns", _escape("t.text"))))
    tried = tried.withColumn("back2", F.when(F.col("form2").isNotNull(), parse("form2")))
    checked = F.when(F.expr("form2 is null"), F.coalesce("form1", "form0")).when(
        F.expr("back2 = source"), F.col("form2")).otherwise(
        F.raise_error(F.lit("a conversation did not parse back")).cast("string"))
    return tried.select("conv_id", checked.alias("formatted"),
                        F.expr("if(form1 is null, 0, if(form2 is null, 1, 2))").alias("level"))


def read_chats(formatted: DataFrame) -> DataFrame:
    """Adds ``turns`` (role, text), ``loss_text`` (the assistant texts, in order, joined without a gap)."""
    return (formatted.withColumn("turns", parse("formatted"))
            .withColumn("loss_text", F.expr("array_join(transform(filter(turns, t -> t.role = 'assistant'), t -> t.text), '')")))


#: A conversation whose texts hold the template's own control strings.
PLANTED = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    rows = given.unionByName(spark.createDataFrame(PLANTED, given.schema))
    back = read_chats(stored(format_chats(rows), "chats"))
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.expr("array_join(transform(turns, t -> t.role || chr(10) || t.text || chr(10)), '')").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "level")


OP3_SQL = r"""
with rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
parts as (
  select *, contains(text, '</turn>') or contains(text, '### ') or regexp_matches(text, '\\[blh]') as clash,
    replace(replace(replace(text, '\', '\b'), '</turn>', '\l/turn>'), '### ', '\h## ') as escaped,
    replace(replace(replace(replace(replace(role, '\', '\b'), '</turn>', '\l/turn>'), '### ', '\h## '), ':', '\c'), chr(10), '\n') as head
  from rows)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  cast(sum(length(head) + length(case when clash then escaped else text end) + 14) as bigint) as formatted_chars,
  cast(max(case when clash then 1 else 0 end) as integer) as level
from parts group by conv_id
"""
