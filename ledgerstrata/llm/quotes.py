"""Quotation linking: reply-ordered conversations without quotes, in DataFrame functions only.

A line that starts with ``>`` marks is quoted; the number of marks is its level. All lines
of one level in a message form a passage, and so does each contiguous block of them (lines without
text part blocks). Passages, blocks and lines are normalised (one blank for white space, lower
case) and hashed. Messages offer the same hashes of what they say themselves: all of it, each
paragraph between blank, quoted or announcing lines, and each line. A quoted hash leads to the
first message of the conversation that offers it, if that is earlier than the quoting one. A
message replies to the latest message that its level 1 quotes lead to; deeper levels are
listed as links only. The SQL knows no blocks and paragraphs: it agrees where they add no link.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerstrata.config import cut_lineage

MARKS = r"^[ \t]{0,3}((?:>[ \t]?)+)"
MARKS_OF_LINE = r"^[ \t]{0,3}(?:>[ \t]?)+"
#: A line that announces a quote; dropped where the next line is quoted.
ANNOUNCES = r"(?i)^.{0,200}\bwrote:[ \t]*$"


def _normal(text: str) -> str:
    return f"lower(trim(regexp_replace({text}, '\\\\s+', ' ')))"


def parsed(messages: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with ``own`` (unquoted lines) and ``quoted`` (level, line)."""
    m = messages.select("conv_id", "turn", "role", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    m = m.withColumn("line", F.split(F.regexp_replace("text", "\r\n?", "\n"), "\n"))
    m = m.withColumn("level", F.transform("line", lambda x: F.length(F.regexp_replace(F.regexp_extract(x, MARKS, 1), "[^>]", ""))))
    m = m.withColumn("lines", F.arrays_zip("line", "level"))
    own = f"(x.level = 0 and not (coalesce(get(level, i + 1), 0) > 0 and x.line rlike r'{ANNOUNCES}'))"
    m = m.withColumn("own", F.expr(f"transform(filter(lines, (x, i) -> {own}), x -> x.line)"))
    m = m.withColumn("quoted", F.expr("transform(filter(lines, x -> x.level > 0), x -> struct(x.level as level, "
                                      f"regexp_replace(x.line, r'{MARKS_OF_LINE}', '') as line))"))
    # Every line as its owner (level, or -1 for an announcing one) and words; a form feed line, which no line can be, parts blocks.
    m = m.withColumn("spoken", F.expr(f"transform(lines, (x, i) -> struct(if(x.level > 0, x.level, if({own}, 0, -1)) as level, "
                                      f"{_normal(f"regexp_replace(x.line, r'{MARKS_OF_LINE}', '')")} as line))"))
    return m.drop("line", "level", "lines")


def _blocks(level: str) -> str:
    """SQL: the contiguous runs of lines of one level in ``spoken``, each as one normal text."""
    joined = f"array_join(transform(spoken, s -> if(s.level = {level} and s.line <> '', s.line, chr(12))), ' ')"
    return f"transform(split({joined}, chr(12)), t -> trim(t))"


def _hashes(lines: str, blocks: str) -> str:
    """SQL: hashes of an array of lines, as a whole and one by one, and of its blocks; blank ones give none."""
    normal = _normal("l")
    return (f"transform(filter(array_union(array_union(array({_normal(f'array_join({lines}, chr(10))')}), transform({lines}, l -> {normal})), {blocks}), "
            "l -> l <> ''), l -> md5(l))")


def link_quotes(messages: DataFrame) -> DataFrame:
    """One row per message: ``conv_id, thread, turn, role, content, reply_to, n_quoted, links``.

    ``content`` has no quoted line and no line that announces one; ``reply_to`` is a turn of
    the same conversation or null; ``thread`` is the turn that the chain of replies starts
    from, so ordering by ``conv_id, thread, turn`` gives each reply after its original.
    ``n_quoted`` counts quoted lines, ``links`` lists ``level:turn`` of all quotes found.

    Repeated messages are each returned; where several messages share a turn, their replies
    lead to the earliest of them. A null text is empty. Messages without a conversation or turn
    stay, link to nothing and are not linked to. Other columns are not read; an empty
    table gives no rows. Only messages that quote take part in a shuffle by hash, and the
    offers are reduced to one row per hash before they are joined.
    """
    m = parsed(messages).withColumn("key", F.md5("text"))
    quoting = m.where(F.size("quoted") > 0)
    asked = quoting.select("conv_id", "turn", "key", F.expr(
        "explode(transform(array_distinct(quoted.level), v -> struct(v as level, "
        "transform(filter(quoted, q -> q.level = v), q -> q.line) as lines, "
        f"{_blocks('v')} as blocks)))").alias("p"))
    asked = asked.select("conv_id", "turn", "key", "p.level", F.expr(f"explode({_hashes('p.lines', 'p.blocks')})").alias("hash"))
    talks = quoting.select("conv_id").distinct()
    offered = (m.join(talks, "conv_id", "left_semi").where("turn is not null")
               .select("conv_id", "turn", F.expr(f"explode({_hashes('own', _blocks('0'))})").alias("hash"))
               .groupBy("conv_id", "hash").agg(F.min("turn").alias("origin")))
    found = asked.join(offered, ["conv_id", "hash"]).where("origin < turn")
    linked = cut_lineage(found.groupBy("conv_id", "turn", "key").agg(
        F.max(F.expr("if(level = 1, origin, null)")).alias("reply_to"),
        F.array_join(F.array_sort(F.collect_set(F.concat_ws(":", F.col("level").cast("string"), F.col("origin").cast("string")))), ",").alias("links")))
    threads = _threads(linked)
    out = m.join(linked, ["conv_id", "turn", "key"], "left").join(threads, ["conv_id", "turn"], "left")
    return out.select("conv_id", F.coalesce("thread", "turn").alias("thread"), "turn", "role",
                      F.array_join("own", "\n").alias("content"), "reply_to",
                      F.size("quoted").cast("long").alias("n_quoted"), F.coalesce("links", F.lit("")).alias("links"))


def _threads(linked: DataFrame) -> DataFrame:
    """``conv_id, turn, thread`` of turns that reply, by doubling the length of the jumps."""
    up = linked.where("reply_to is not null").groupBy("conv_id", "turn").agg(F.min("reply_to").alias("thread"))
    up = cut_lineage(up)
    while True:
        over = up.select("conv_id", F.col("turn").alias("thread"), F.col("thread").alias("next"))
        up = cut_lineage(up.join(over, ["conv_id", "thread"], "left").select("conv_id", "turn", F.coalesce("next", "thread").alias("thread"), F.col("next").isNotNull().alias("moved")))
        moved, up = not up.where("moved").isEmpty(), up.drop("moved")
        if not moved:
            return up


def formatted(messages: DataFrame) -> DataFrame:
    """:func:`link_quotes` with ``chat``: the message between role marks, as a chat template has it."""
    return link_quotes(messages).withColumn(
        "chat", F.concat(F.lit("<|"), F.coalesce("role", F.lit("unknown")), F.lit("|>\n"), "content", F.lit("\n<|end|>\n")))


ORACLE_SQL = r"""
WITH RECURSIVE m AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text,
         string_split(regexp_replace(coalesce(text, ''), '\r\n?', chr(10), 'g'), chr(10)) AS line
  FROM conversations),
l AS (SELECT *, [length(regexp_replace(regexp_extract(x, '^[ \t]{0,3}((?:>[ \t]?)+)', 1), '[^>]', '', 'g')) FOR x IN line] AS level FROM m),
p AS (
  SELECT conv_id, turn, role, md5(text) AS key, len(line) AS n,
    [line[i] FOR i IN range(1, len(line) + 1) IF level[i] = 0 AND NOT (coalesce(level[i + 1], 0) > 0 AND regexp_matches(line[i], '(?i)^.{0,200}\bwrote:[ \t]*$'))] AS own,
    [{'level': level[i], 'line': regexp_replace(line[i], '^[ \t]{0,3}(?:>[ \t]?)+', '')} FOR i IN range(1, len(line) + 1) IF level[i] > 0] AS quoted
  FROM l),
qlines AS (SELECT conv_id, turn, key, unnest(quoted, recursive := true), generate_subscripts(quoted, 1) AS pos FROM (SELECT DISTINCT conv_id, turn, key, quoted FROM p) WHERE len(quoted) > 0),
ask AS (
  SELECT conv_id, turn, key, level, lower(trim(regexp_replace(string_agg(line, chr(10) ORDER BY pos), '\s+', ' ', 'g'))) AS t FROM qlines GROUP BY ALL
  UNION SELECT conv_id, turn, key, level, lower(trim(regexp_replace(line, '\s+', ' ', 'g'))) FROM qlines),
offer AS (
  SELECT conv_id, t, min(turn) AS origin FROM (
    SELECT conv_id, turn, lower(trim(regexp_replace(array_to_string(own, chr(10)), '\s+', ' ', 'g'))) AS t FROM p
    UNION ALL SELECT conv_id, turn, lower(trim(regexp_replace(unnest(own), '\s+', ' ', 'g'))) FROM p)
  WHERE turn IS NOT NULL GROUP BY ALL),
linked AS (
  SELECT conv_id, turn, key, max(origin) FILTER (level = 1) AS reply_to, string_agg(DISTINCT level || ':' || origin, ',' ORDER BY level || ':' || origin) AS links
  FROM ask JOIN offer USING (conv_id, t) WHERE t <> '' AND origin < turn GROUP BY ALL),
up AS (SELECT conv_id, turn, min(reply_to) AS up FROM linked WHERE reply_to IS NOT NULL GROUP BY ALL),
walk AS (SELECT conv_id, turn, up AS thread FROM up
         UNION ALL SELECT w.conv_id, w.turn, u.up FROM walk w JOIN up u ON u.conv_id = w.conv_id AND u.turn = w.thread),
threads AS (SELECT conv_id, turn, min(thread) AS thread FROM walk GROUP BY ALL)
SELECT p.conv_id, coalesce(t.thread, p.turn) AS thread, p.turn, p.role, array_to_string(p.own, chr(10)) AS content, k.reply_to,
       CAST(len(p.quoted) AS BIGINT) AS n_quoted, coalesce(k.links, '') AS links,
       '<|' || coalesce(p.role, 'unknown') || '|>' || chr(10) || array_to_string(p.own, chr(10)) || chr(10) || '<|end|>' || chr(10) AS chat
FROM p LEFT JOIN linked k ON k.conv_id = p.conv_id AND k.turn = p.turn AND k.key = p.key
LEFT JOIN threads t ON t.conv_id = p.conv_id AND t.turn = p.turn
"""
