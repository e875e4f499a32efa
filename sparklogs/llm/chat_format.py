"""Chat formatting by schema fingerprints, with DataFrame functions only.

A record's nested field paths are hashed; the hash selects a declarative mapping
that turns the record into canonical turns. Turns of a conversation are rendered
with marked, reversibly escaped texts and a loss mask over assistant texts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparklogs.llm.common import table

#: The marks of the template.
OPEN, CLOSE, ROLE_END = "<|turn|>", "<|end|>", "\n"
#: Control strings (ours and those of other templates) and what stands for them, the escape sign first.
ESCAPES = [
    ("~", "~0"),
    ("<|", "~1"),
    ("|>", "~2"),
    ("<s>", "~3"),
    ("</s>", "~4"),
    ("[INST]", "~5"),
    ("[/INST]", "~6"),
]
ROLE_ESCAPES = [*ESCAPES, ("\n", "~7")]

#: Layouts: an example of the fingerprinted paths, then turns as (role, path of the text), or ("*", path of a list, role field, text field).
MAPPINGS = {
    "turn row": ("OBJECT<conv_id, role, text, turn>", [("$.role", "$.text", "$.turn")]),
    "messages": ("OBJECT<messages: ARRAY<OBJECT<content, role>>>", [("*", "$.messages", "role", "content")]),
    "shared chat": ("OBJECT<conversations: ARRAY<OBJECT<from, value>>>", [("*", "$.conversations", "from", "value")]),
    "instruction with input": ("OBJECT<input, instruction, output>", [("user", ["$.instruction", "$.input"]), ("assistant", ["$.output"])]),
    "instruction": ("OBJECT<instruction, output>", [("user", ["$.instruction"]), ("assistant", ["$.output"])]),
    "instruction with system": (
        "OBJECT<input, instruction, output, system>",
        [("system", ["$.system"]), ("user", ["$.instruction", "$.input"]), ("assistant", ["$.output"])],
    ),
    "completion": ("OBJECT<completion, prompt>", [("user", ["$.prompt"]), ("assistant", ["$.completion"])]),
    "response": ("OBJECT<prompt, response>", [("user", ["$.prompt"]), ("assistant", ["$.response"])]),
    "question": ("OBJECT<answer, question>", [("user", ["$.question"]), ("assistant", ["$.answer"])]),
}
#: Role names of lists of turns in other layouts; a record that is one turn keeps its own.
ROLES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
_TURN = "array<struct<turn: bigint, role: string, text: string>>"


def field_paths(record: Column) -> Column:
    """The nested field names of a variant, without leaf types: `OBJECT<prompt, response>`."""
    kinds = F.schema_of_variant(record)
    return F.regexp_replace(kinds, ": (?!ARRAY|OBJECT)[A-Z_]+(?:\\(\\d+,\\s*\\d+\\))?", "")


def fingerprint(paths: Column) -> Column:
    return F.xxhash64(paths)


def _text(record: Column, path: str) -> Column:
    return F.coalesce(F.try_variant_get(record, path, "string"), F.lit(""))


def _mapped(record: Column, turns: list[tuple]) -> Column:
    role_of = lambda r: reduce(lambda c, kv: F.when(r == kv[0], kv[1]).otherwise(c), ROLES.items(), r)
    if turns[0][0] == "*":
        _, path, role, text = turns[0]
        items = F.try_variant_get(record, path, f"array<struct<{role}: string, {text}: string>>")
        return F.transform(
            items,
            lambda x, i: F.struct(
                i.cast("long").alias("turn"),
                role_of(F.coalesce(x[role], F.lit(""))).alias("role"),
                F.coalesce(x[text], F.lit("")).alias("text"),
            ),
        )
    if len(turns[0]) == 3:
        role, text, turn = turns[0]
        return F.array(
            F.struct(
                F.try_variant_get(record, turn, "long").alias("turn"),
                _text(record, role).alias("role"),
                _text(record, text).alias("text"),
            )
        )
    made = [
        F.struct(
            F.lit(i).cast("long").alias("turn"),
            F.lit(role).alias("role"),
            F.array_join(F.filter(F.array(*[_text(record, p) for p in paths]), lambda t: t != ""), "\n").alias("text"),
        )
        for i, (role, paths) in enumerate(turns)
    ]
    return F.array(*made)


def canonical_turns(records: DataFrame, id_col: str, record_col: str, mappings: dict = MAPPINGS) -> DataFrame:
    """(conv_id, layout, turn, role, text): one row per turn of the variant column `record_col`.

    The hash of a record's nested field paths selects the mapping. A record of an
    unknown layout, or a null one, gives one row whose layout, turn, role and text
    are null, so that nothing is lost silently; a known layout with an empty list
    of turns gives none. Null texts and roles are empty strings. Ids may be null
    or repeat. Other columns of `records` are not read.
    """
    rows = records.select(F.col(id_col).alias("conv_id"), F.col(record_col).alias("record"))
    rows = rows.withColumn("mark", fingerprint(field_paths(F.col("record"))))
    layout = turns = None
    for name, (paths, how) in mappings.items():
        hit = F.col("mark") == fingerprint(F.lit(paths))
        made = _mapped(F.col("record"), how).cast(_TURN)
        layout = F.when(hit, name) if layout is None else layout.when(hit, name)
        turns = F.when(hit, made) if turns is None else turns.when(hit, made)
    unknown = F.array(F.struct(F.lit(None).alias("turn"), F.lit(None).alias("role"), F.lit(None).alias("text"))).cast(_TURN)
    rows = rows.select("conv_id", layout.alias("layout"), turns.alias("turns"))
    rows = rows.select("conv_id", "layout", F.explode(F.when(F.col("layout").isNull(), unknown).otherwise(F.col("turns"))).alias("t"))
    return rows.select("conv_id", "layout", "t.turn", "t.role", "t.text")


def escaped(text: Column, pairs: list[tuple[str, str]] = ESCAPES) -> Column:
    return reduce(lambda c, p: F.replace(c, F.lit(p[0]), F.lit(p[1])), pairs, text)


def unescaped(text: Column, pairs: list[tuple[str, str]] = ESCAPES) -> Column:
    """Undoes `escaped`: the sign itself comes last, so `~01` is `~1` and never a control string."""
    return reduce(lambda c, p: F.replace(c, F.lit(p[1]), F.lit(p[0])), reversed(pairs), text)


def format_chat(turns: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_spans) from (conv_id, turn, role, text) rows.

    Turns are in the order of turn (nulls first), role, text; repeated rows are
    repeated turns. Null roles and texts are empty. `loss_spans` are code point
    ranges [start, end) of `formatted`, one for each assistant text, in order.
    Rows with a null conv_id are one conversation. A conversation is one string,
    so its own length is the bound of a row.
    """
    rows = turns.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    body = escaped(F.col("text"))
    head = F.concat(F.lit(OPEN), escaped(F.col("role"), ROLE_ESCAPES), F.lit(ROLE_END))
    rows = rows.select("conv_id", "turn", "role", "text", head.alias("head"), body.alias("body"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, 0)
    size = F.length("head") + F.length("body") + len(CLOSE)
    rows = rows.withColumn("n", F.row_number().over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    rows = rows.withColumn("stop", F.sum(size.cast("long")).over(order) - len(CLOSE))
    span = F.struct((F.col("stop") - F.length("body")).alias("start"), F.col("stop").alias("end"))
    piece = F.struct("n", F.concat("head", "body", F.lit(CLOSE)).alias("piece"), F.when(F.col("role") == "assistant", span).alias("span"))
    rows = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(piece)).alias("pieces"))
    return rows.select(
        "conv_id",
        F.array_join(F.col("pieces.piece"), "").alias("formatted"),
        F.filter(F.col("pieces.span"), lambda s: s.isNotNull()).alias("loss_spans"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) that a formatted string holds."""
    parts = F.split(formatted, "<\\|end\\|>", -1)
    parts = F.slice(parts, 1, F.size(parts) - 1)

    def turn(part: Column) -> Column:
        inner = F.substr(part, F.lit(len(OPEN) + 1))
        cut = F.instr(inner, ROLE_END)
        return F.struct(
            unescaped(F.substr(inner, F.lit(1), cut - 1), ROLE_ESCAPES).alias("role"),
            unescaped(F.substr(inner, cut + 1)).alias("text"),
        )

    return F.transform(parts, turn)


def read_loss(formatted: Column, spans: Column) -> Column:
    """The unescaped texts under the loss mask, joined with nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescaped(F.substr(formatted, (s.start + 1).cast("int"), (s.end - s.start).cast("int")))), "")


_PROBE = "</s>[INST] ok [/INST]"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = [spark.range(1).select(F.lit(-7).cast("long"), F.lit(i).cast("long"), F.lit(r), F.lit(_PROBE)) for i, r in enumerate(("user", "assistant"))]
    rows = rows.union(probe[0]).union(probe[1])
    records = rows.select("conv_id", F.to_variant_object(F.struct("conv_id", "turn", "role", "text")).alias("record"))
    done = format_chat(canonical_turns(records, "conv_id", "record"))
    read = done.select("conv_id", F.length("formatted").alias("formatted_chars"), read_turns(F.col("formatted")).alias("turns"), read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    lines = F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long").alias("formatted_chars"),
    )


def _sql_escape(column: str, pairs: list[tuple[str, str]]) -> str:
    return reduce(lambda c, p: f"replace({c}, '{p[0]}', '{p[1]}')" if p[0] != "\n" else f"replace({c}, chr(10), '{p[1]}')", pairs, column)


SQL = f"""
WITH r AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-7, 0, 'user', '{_PROBE}'), (-7, 1, 'assistant', '{_PROBE}')),
     g AS (SELECT conv_id, count(*) AS n_turns,
                  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
                  coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
                  sum(length({_sql_escape("role", ROLE_ESCAPES)}) + length({_sql_escape("text", ESCAPES)}) + {len(OPEN) + len(ROLE_END) + len(CLOSE)}) AS n
           FROM r GROUP BY conv_id)
SELECT conv_id, n_turns, turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, CAST(n AS BIGINT) AS formatted_chars FROM g
"""
