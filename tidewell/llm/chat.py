r"""Chat formatting with a grammar round trip.

A conversation is rendered as ``<|im_start|>role\ntext<|im_end|>\n`` for each
turn. The rendered text is parsed again by a deterministic grammar: a turn
ends at ``<|im_end|>`` and a line break, begins with ``<|im_start|>``, its
role goes up to the first line break, and no other ``<|`` may come in it. Each
recovered turn is compared with its source; a conversation whose plain
rendering does not come back identical has its conflicting content escaped
and is rendered and parsed again, and one that still differs is an error.

The escape puts a backslash behind the ``<`` of ``<|`` and one more into
``<\|``, ``<\\|`` and so on; the parser takes one away. In roles it treats
``<n>``, the escaped line break, alike. Content without such strings stays as
it is.

DataFrame functions only. A conversation becomes one string, so it has to fit
a row; its turns are gathered by their conversation's id and sorted by turn,
then role, then text.

Defined results: null texts and roles are empty; a null conversation id is a
conversation of its own, a null turn comes first; repeated turns are all
rendered. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import computed

START = "<|im_start|>"
END = "<|im_end|>\n"
TRAINED_ROLE = "assistant"


def escape_text(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape_text(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(role, r"<(\\*)(\||n>)", r"<\\$1$2"), "\n", "<n>")


def unescape_role(role: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(role, "<n>", "\n"), r"<\\(\\*)(\||n>)", r"<$1$2")


def rendered(turns: Column, escaped: bool) -> Column:
    def turn(t: Column) -> Column:
        role, text = (escape_role(t["role"]), escape_text(t["text"])) if escaped else (t["role"], t["text"])
        return F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(END))

    return F.array_join(F.transform(turns, turn), "")


def parsed(text: Column) -> Column:
    """The turns (role, text, the text's characters as rendered) of a rendered conversation; null where the grammar fails."""
    parts = F.split(text, r"<\|im_end\|>\n")  # the last part is what follows the last turn: nothing

    def turn(part: Column) -> Column:
        body = F.substr(part, F.lit(len(START) + 1))
        role = F.substring_index(body, "\n", 1)
        content = F.substr(body, F.length(role) + 2)
        fits = F.startswith(part, F.lit(START)) & F.contains(body, F.lit("\n")) & ~F.contains(body, F.lit("<|"))
        return F.when(fits, F.struct(unescape_role(role).alias("role"), unescape_text(content).alias("text"),
                                     (F.length(role) + len(START) + 1).alias("before"),
                                     F.length(content).alias("chars")))

    return F.transform(F.slice(parts, 1, F.size(parts) - 1), turn)


def _attempt(df: DataFrame, escaped: bool) -> DataFrame:
    """``df(conv, turns)`` with ``formatted``, ``back`` and whether the round trip is ``same``."""
    df = computed(df, "conv", "turns", rendered(F.col("turns"), escaped).alias("formatted"))
    df = computed(df, "conv", "turns", "formatted", parsed(F.col("formatted")).alias("back"))
    plain = F.transform("back", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    whole = F.forall("back", lambda t: t.isNotNull())
    return df.withColumn("same", whole & (plain == F.col("turns")))


def format_conversations(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text",
                         trained_role: str = TRAINED_ROLE) -> DataFrame:
    """``(conv_col, formatted, turns, loss_text)``, a row for each conversation.

    ``turns`` holds the recovered role and text, how many characters of the
    formatted text come before the text, how many it has there, and whether
    they are under the loss mask. ``loss_text`` is the text under the mask.
    """
    narrow = conversations.select(F.col(conv_col).alias("conv"), F.struct(
        F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text")).alias("t"))
    sources = narrow.groupBy("conv").agg(F.sort_array(F.collect_list("t")).alias("sorted"))
    sources = sources.select("conv", F.transform("sorted", lambda t: F.struct(
        t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))
    plain = _attempt(sources, escaped=False)
    plain = computed(plain, "conv", "turns", "same", F.when(F.col("same"), F.col("formatted")).alias("formatted"))
    escaped = F.coalesce(F.col("formatted"), rendered(F.col("turns"), True))
    final = computed(plain, "conv", "turns", escaped.alias("formatted"))
    final = computed(final, "conv", "turns", "formatted", parsed(F.col("formatted")).alias("back"))
    recovered = F.transform("back", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    checked = F.when(F.forall("back", lambda t: t.isNotNull()) & (recovered == F.col("turns")), F.col("back")).otherwise(
        F.raise_error(F.lit("a conversation does not come back from its formatted text")))
    final = computed(final, "conv", "formatted", checked.alias("back"))
    out = F.transform("back", lambda t: F.struct(
        t["role"].alias("role"), t["text"].alias("text"), t["before"].alias("before"), t["chars"].alias("chars"),
        (t["role"] == trained_role).alias("loss")))
    final = computed(final, "conv", "formatted", out.alias("turns"))
    loss = F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: t["text"])
    return final.select(F.col("conv").alias(conv_col), "formatted", "turns", F.array_join(loss, "").alias("loss_text"))


def digests(formatted: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Counts and digests of ``format_conversations``, read back from its output."""
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return formatted.select(conv_col, F.size("turns").cast("long").alias("n_turns"),
                            F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
                            F.length("loss_text").cast("long").alias("loss_chars"),
                            F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
                            F.length("formatted").cast("long").alias("formatted_chars"))
