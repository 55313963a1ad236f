"""Chat formatting with prefix-target expansion, in DataFrame functions only.

A conversation's turns, by turn number, become one text: each turn is TURN_START, the
role, a line end, the turn's text and TURN_END. Control strings inside texts and roles
are broken up by an escape that is undone exactly when reading back, so that only the
template's own marks remain as marks. Every assistant turn is an example of its own: all
turns before it are the context and only its own text is trained. An example is kept as
character spans of the conversation's text (context end, loss start, loss length), since
copies of the context would grow with the square of a conversation's turns; `examples`
cuts the texts out.

Null texts and roles count as empty, and a null conv_id is a conversation of its own.
Rows with equal turn numbers go by role and text; repeated rows are repeated turns.
Conversations without assistant turns have a formatted text and no examples. A
conversation is one value, as its digest needs it whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scorebook.llm.frames import table

TURN_START, TURN_END, TRAINED = "<|im_start|>", "<|im_end|>", "assistant"
ESC = "␛"
#: Control strings of common chat templates, each cut after its first character.
CONTROL = r"(<)(/?s>|/?<SYS>>|</SYS>>|\|[a-z_]+\|>)|(\[)(/?INST\])"


def escape(text: Column) -> Column:
    twice = F.replace(text, F.lit(ESC), F.lit(ESC + ESC))
    return F.regexp_replace(twice, CONTROL, f"$1$3{ESC}.$2$4")


def escape_line(text: Column) -> Column:
    return F.replace(escape(text), F.lit("\n"), F.lit(ESC + "l"))


def unescape(text: Column) -> Column:
    def part(p):
        return F.replace(F.replace(p, F.lit(ESC + "l"), F.lit("\n")), F.lit(ESC + "."), F.lit(""))

    return F.array_join(F.transform(F.split(text, ESC + ESC), part), ESC)


def format_conversations(rows: DataFrame) -> DataFrame:
    """conv_id, text, spans (context_end, loss_start, loss_chars per assistant turn, in order) from rows of
    (conv_id, turn, role, text)."""
    role, said = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    head = F.concat(F.lit(TURN_START), escape_line(role), F.lit("\n"))
    turns = rows.select("conv_id", "turn", role.alias("role"), said.alias("said"), head.alias("head"),
                        escape(said).alias("body"))
    piece = F.concat("head", "body", F.lit(TURN_END + "\n"))
    turns = turns.select("conv_id", "turn", "role", "said", piece.alias("piece"),
                         F.char_length(piece).cast("bigint").alias("n"), F.char_length("head").alias("head_n"),
                         F.char_length("body").alias("body_n"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "said")
    placed = turns.select("conv_id", "role", "piece", F.row_number().over(order).alias("at"), "head_n", "body_n",
                          (F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("start"))
    span = F.when(F.col("role") == TRAINED, F.struct(F.col("start").alias("context_end"),
                                                     (F.col("start") + F.col("head_n")).alias("loss_start"),
                                                     F.col("body_n").cast("bigint").alias("loss_chars")))
    whole = placed.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("at", "piece"))).alias("pieces"),
        F.array_sort(F.collect_list(span)).alias("spans"))
    return whole.select("conv_id", F.array_join("pieces.piece", "").alias("text"), "spans")


def expand(formatted: DataFrame) -> DataFrame:
    """One row per example: conv_id, example (1, 2, ...), text (of the whole conversation) and the example's span."""
    return formatted.select("conv_id", "text", F.posexplode("spans").alias("at", "s")).select(
        "conv_id", (F.col("at") + 1).alias("example"), "text", "s.context_end", "s.loss_start", "s.loss_chars")


def loss_text(text: Column | str = "text") -> Column:
    """The text under an example's loss mask; `text` is the whole conversation, or context and target."""
    return F.substring(text, F.col("loss_start") + 1, F.col("loss_chars"))


def examples(rows: DataFrame) -> DataFrame:
    """conv_id, example, context (all turns before, formatted), target (the reply with its marks), and loss_start and
    loss_chars of the trained text within context || target."""
    e = expand(format_conversations(rows))
    turn_n = F.col("loss_start") - F.col("context_end") + F.col("loss_chars") + len(TURN_END) + 1
    return e.select("conv_id", "example", F.substring("text", F.lit(1), F.col("context_end")).alias("context"),
                    F.substring("text", F.col("context_end") + 1, turn_n).alias("target"), "loss_start", "loss_chars")


def read_turns(text: Column) -> Column:
    """Array of (role, text) read back from a formatted conversation."""
    segments = F.filter(F.split(text, r"<\|im_start\|>"), lambda _, i: i > 0)  # nothing comes before the first mark

    def turn(s):
        head = F.substring_index(s, "\n", 1)
        body = F.substring(s, F.char_length(head) + 2,
                           F.char_length(s) - F.char_length(head) - F.lit(len(TURN_END) + 2))
        return F.struct(unescape(head).alias("role"), unescape(body).alias("text"))

    return F.transform(segments, turn)


def chat_report(rows: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, read back from the formatted texts
    and, for the loss, from the expanded examples with their whole contexts."""
    formatted = format_conversations(rows)
    turns = F.element_at(F.transform(F.array(read_turns(F.col("text"))), lambda ts: F.struct(
        F.size(ts).cast("bigint").alias("n"),
        F.sha2(F.array_join(F.transform(ts, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""),
               256).alias("digest"))), 1)
    whole = formatted.select("conv_id", turns.alias("t"), F.char_length("text").cast("bigint").alias("formatted_chars"))
    replies = examples(rows).select("conv_id", "example", unescape(loss_text(F.concat("context", "target"))).alias("reply"))
    loss = replies.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("example", "reply"))).alias("r"))
    loss = loss.select(F.col("conv_id").alias("id"), F.array_join("r.reply", "").alias("loss"))
    both = whole.join(loss, whole["conv_id"].eqNullSafe(loss["id"]), "left")
    text = F.coalesce("loss", F.lit(""))
    return both.select("conv_id", F.col("t.n").alias("n_turns"), F.col("t.digest").alias("turns_sha256"),
                       F.char_length(text).cast("bigint").alias("loss_chars"), F.sha2(text, 256).alias("loss_sha256"),
                       "formatted_chars")


PROBE = "</s>[INST] ok [/INST]"


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.range(2).select(F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
                                F.when(F.col("id") == 0, "user").otherwise(TRAINED).alias("role"),
                                F.lit(PROBE).alias("text"))
    return chat_report(rows.union(own))


QUERIES = {"op8_chat_format": op8_chat_format}

ORACLE = {"op8_chat_format": r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, regexp_replace(regexp_replace(replace(text, '␛', '␛␛'), '(<)(/?s>|/?<SYS>>|</SYS>>|\|[a-z_]+\|>)',
                                          '\1␛.\2', 'g'), '(\[)(/?INST\])', '\1␛.\2', 'g') AS body FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(role) + length(body) + 24)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""}
