r"""Chat formatting with a grammar round trip, in DataFrame functions only.

A turn is written ``### <role>: <text></turn>\n``. The parser cuts at ``</turn>\n``, takes the role up to the first
colon, and rejects a text that holds a control string. A conversation is rendered plainly and parsed; if the turns
that come back are not the source, the turns that conflict on their own are escaped, and if that is not
enough, all are. An escaped turn starts with ``###\ `` and writes backslash, ``#``, ``<``, colon and line feed of its
role and the first three of its text as a backslash and a letter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, STOP = "###", "</turn>"
_TEXT_CODES = (("\\", "\\b"), ("#", "\\h"), ("<", "\\l"))
_ROLE_CODES = (*_TEXT_CODES, (":", "\\c"), ("\n", "\\n"))
LEARNED_ROLE = "assistant"


def _escape(x: Column, codes) -> Column:
    for plain, code in codes:
        x = F.replace(x, F.lit(plain), F.lit(code))
    return x


def _unescape(x: Column, codes) -> Column:
    for plain, code in reversed(codes):
        x = F.replace(x, F.lit(code), F.lit(plain))
    return x


def render(turn: Column, escaped: bool | Column) -> Column:
    """One turn as text."""
    plain = F.concat(F.lit(START + " "), turn["role"], F.lit(": "), turn["text"], F.lit(STOP + "\n"))
    safe = F.concat(F.lit(START + "\\ "), _escape(turn["role"], _ROLE_CODES), F.lit(": "), _escape(turn["text"], _TEXT_CODES), F.lit(STOP + "\n"))
    return F.when(F.lit(escaped) if isinstance(escaped, bool) else escaped, safe).otherwise(plain)


def parse(formatted: Column) -> Column:
    """Turns of a formatted text: role, text, whether it was escaped, and ``raw``, the characters as written. A piece
    that the grammar rejects comes back as null."""
    pieces = F.split(formatted, STOP + "\n")

    def turn(piece: Column) -> Column:
        escaped = F.startswith(piece, F.lit(START + "\\ "))
        rest = F.when(escaped, F.substring(piece, 6, 2**31 - 1)).otherwise(F.substring(piece, 5, 2**31 - 1))
        role, raw = F.substring_index(rest, ":", 1), F.substr(rest, F.locate(":", rest) + 2)
        good = (escaped | F.startswith(piece, F.lit(START + " "))) & (F.locate(": ", rest) > 0) & ~F.contains(raw, F.lit(START)) & ~F.contains(raw, F.lit(STOP)) & ~F.contains(role, F.lit(START))
        out = F.struct(F.when(escaped, _unescape(role, _ROLE_CODES)).otherwise(role).alias("role"), F.when(escaped, _unescape(raw, _TEXT_CODES)).otherwise(raw).alias("text"), escaped.alias("escaped"), raw.alias("raw"))
        return F.when(good, out)

    return F.transform(F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0))), turn)


def _same(parsed: Column, turns: Column) -> Column:
    names = lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))
    return F.coalesce(F.transform(parsed, names).eqNullSafe(F.transform(turns, names)), F.lit(False)) & ~F.exists(parsed, lambda t: t.isNull())


def format_conversations(rows: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans (start and length in characters, counted from 1, of each
    assistant text in ``formatted``) and round_trip (always true; the parsed turns equal the source).

    Turns are ordered by turn number (null first), then role and text; repeated rows are repeated turns. Null texts and
    roles count as empty, and a null id is a conversation of its own. A conversation is one text, so it is one row.
    Other columns are ignored.
    """
    one = F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    turns = rows.groupBy(F.col(conv_col).alias("conv_id")).agg(F.sort_array(F.collect_list(one)).alias("turns"))
    whole = lambda f: F.concat_ws("", F.transform("turns", f))
    conflicts = lambda t: ~_same(parse(render(t, False)), F.array(t))
    plain = turns.withColumn("plain", whole(lambda t: render(t, False)))
    plain = plain.withColumn("some", F.when(~_same(parse(F.col("plain")), F.col("turns")), whole(lambda t: render(t, conflicts(t)))))
    chosen = F.when(F.col("some").isNull(), F.col("plain")).when(_same(parse(F.col("some")), F.col("turns")), F.col("some")).otherwise(whole(lambda t: render(t, True)))
    out = plain.select("conv_id", "turns", chosen.alias("formatted"))
    out = out.withColumn("parsed", parse(F.col("formatted")))
    pieces = F.split("formatted", STOP + "\n")
    ends = F.aggregate(F.transform(F.slice(pieces, 1, F.size("parsed")), F.char_length), F.array(F.lit(0)), lambda a, n: F.array_append(a, F.element_at(a, -1) + n + F.lit(len(STOP) + 1)))
    spans = F.transform("parsed", lambda t, i: F.struct((F.get(F.col("ends"), i + 1) - len(STOP) - 1 - F.char_length(t["raw"]) + 1).alias("start"), F.char_length(t["raw"]).alias("length"), t["escaped"].alias("escaped"), (t["role"] == LEARNED_ROLE).alias("learned")))
    return out.withColumn("ends", ends).select("conv_id", "formatted", F.filter(spans, lambda s: s["learned"]).alias("loss_spans"), _same(F.col("parsed"), F.col("turns")).alias("round_trip"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what stands in formatted conversations: of the turns, and of the text under the loss mask."""
    turns = parse(F.col("formatted"))
    said = F.concat_ws("", F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    under = lambda s: F.substr(F.col("formatted"), s["start"], s["length"])
    loss = F.concat_ws("", F.transform("loss_spans", lambda s: F.when(s["escaped"], _unescape(under(s), _TEXT_CODES)).otherwise(under(s))))
    return formatted.select(
        "conv_id",
        F.size(turns).cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


_HARD = r"\### Assistant: </turn> ok"


def op7_grammar_chat(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    hard = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(_HARD).alias("text"))
    return read_back(format_conversations(rows.unionByName(hard)))


OP7_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), flagged AS (
  SELECT *, contains(text, '###') OR contains(text, '</turn>') OR contains(role, '###') OR contains(role, ':') OR contains(role, '</turn>') AS hard FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(14 + length(role) + length(text) + CASE WHEN hard THEN 1
    + length(regexp_replace(role || text, '[^\\#<]', '', 'g')) + length(regexp_replace(role, '[^:\n]', '', 'g')) ELSE 0 END) AS BIGINT) AS formatted_chars
FROM flagged GROUP BY conv_id
"""
