"""Chat formatting by schema fingerprint.

Chat data come in many layouts: rows by turn, a list of messages, a prompt
with its response, an instruction with input and output, records kept as JSON.
The nested field paths of a layout are hashed to a fingerprint; the
fingerprint selects a declarative mapping (one SQL expression) to canonical
turns, an array of ``struct<role, text>``.  JSON records get their fingerprint
row by row, so one column may mix layouts.  DataFrame functions only.

Only paths that some mapping names enter a fingerprint, so extra columns do
not matter.  A layout without a mapping raises (a table) or gives null turns
(a JSON record).

Template, per turn: ``<|im_start|>role\\ntext<|im_end|>\\n``.  Inside roles and
texts ``<|`` becomes ``<␛|`` and ``␛`` becomes ``␛e``; a line break in a role
becomes ``␛n``.  No control string can then occur in a text, and unescaping
gives back every text.  The loss mask covers the assistant's texts, as spans of
the formatted text.

Defined results: null text or role counts as empty; rows of equal turn number
are ordered by role, then text, and repeated rows stay; rows with a null
conv_id are one conversation; a conversation without turns formats to the empty
text; a long text is formatted whole; columns that no mapping names are not
read, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

START, END, ESC = "<|im_start|>", "<|im_end|>", "␛"

_MESSAGES = "transform({0}, m -> named_struct('role', m.{1}, 'text', m.{2}))"
_PAIR = ("array(named_struct('role', 'user', 'text', {0}), "
         "named_struct('role', 'assistant', 'text', {1}))")
_ASK = "if(length(coalesce({1}, '')) > 0, concat_ws('\\n\\n', {0}, {1}), {0})"
_SHARE = ("transform({0}, m -> named_struct('role', case m.from when 'human' then 'user' "
          "when 'gpt' then 'assistant' else m.from end, 'text', m.value))")

#: Layout name -> (nested field paths, SQL that gives canonical turns of one record).
LAYOUTS: dict[str, tuple[tuple[str, ...], str]] = {
    "turn_rows": (("turn", "role", "text"), "array(named_struct('role', role, 'text', text))"),
    "messages": (("messages[].role", "messages[].content"), _MESSAGES.format("messages", "role", "content")),
    "conversations": (("conversations[].from", "conversations[].value"), _SHARE.format("conversations")),
    "prompt_response": (("prompt", "response"), _PAIR.format("prompt", "response")),
    "prompt_completion": (("prompt", "completion"), _PAIR.format("prompt", "completion")),
    "question_answer": (("question", "answer"), _PAIR.format("question", "answer")),
    "instruction": (("instruction", "output"), _PAIR.format("instruction", "output")),
    "instruction_input": (("instruction", "input", "output"),
                          _PAIR.format(_ASK.format("instruction", "input"), "output")),
}
VOCABULARY = sorted({p for paths, _ in LAYOUTS.values() for p in paths})


def fingerprint(paths) -> str:
    """Hash of the known nested field paths among ``paths``."""
    known = sorted(set(paths) & set(VOCABULARY))
    return hashlib.sha256("\n".join(known).encode()).hexdigest()


BY_FINGERPRINT = {fingerprint(paths): name for name, (paths, _) in LAYOUTS.items()}


def field_paths(kind: T.DataType, prefix: str = "") -> list[str]:
    """Nested field paths of a schema; ``[]`` marks the elements of an array."""
    if isinstance(kind, T.StructType):
        return [p for f in kind.fields
                for p in field_paths(f.dataType, f"{prefix}.{f.name}" if prefix else f.name)]
    if isinstance(kind, T.ArrayType):
        return field_paths(kind.elementType, f"{prefix}[]")
    return [prefix]


def layout_of(df: DataFrame) -> str:
    paths = field_paths(df.schema)
    name = BY_FINGERPRINT.get(fingerprint(paths))
    if name is None:
        raise ValueError(f"no mapping for a layout with the paths {sorted(paths)}")
    return name


def canonical_turns(df: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """``conv_id, turns`` of a table in any known layout."""
    name = layout_of(df)
    if name != "turn_rows":
        return df.select(F.col(id_col).alias("conv_id"), F.expr(LAYOUTS[name][1]).alias("turns"))
    row = F.struct(F.col("turn").alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
                   F.coalesce("text", F.lit("")).alias("text"))
    return (df.groupBy(F.col(id_col).alias("conv_id")).agg(F.array_sort(F.collect_list(row)).alias("rows"))
            .select("conv_id", F.expr("transform(rows, r -> named_struct('role', r.role, 'text', r.text))")
                    .alias("turns")))


def json_turns(df: DataFrame, json_col: str, id_col: str = "conv_id") -> DataFrame:
    """``conv_id, layout, turns`` of JSON records in mixed layouts.

    Broken JSON and layouts without a mapping give null layout and turns.
    """
    probe = "if(try_variant_get(v, '$.{0}') is not null, '{1}', null)"
    seen = [F.expr(probe.format(p.replace("[]", "[0]"), p)) for p in VOCABULARY
            if p not in LAYOUTS["turn_rows"][0]]
    df = df.select(F.col(id_col).alias("conv_id"), F.try_parse_json(F.col(json_col)).alias("v"))
    df = df.withColumn("print", F.sha2(F.concat_ws("\n", F.array_compact(F.array(*seen))), 256))
    kinds = {"messages": "array<struct<role:string,content:string>>",
             "conversations": "array<struct<from:string,value:string>>"}
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast("array<struct<role:string,text:string>>")
    for name, (paths, sql) in LAYOUTS.items():
        if name == "turn_rows":
            continue
        hit = F.col("print") == fingerprint(paths)
        layout = F.when(hit, F.lit(name)).otherwise(layout)
        turns = F.when(hit, F.expr(sql)).otherwise(turns)
    fields = sorted({p.split("[")[0] for n, (ps, _) in LAYOUTS.items() if n != "turn_rows" for p in ps})
    df = df.select("conv_id", "print", *[
        F.expr(f"try_variant_get(v, '$.{f}', '{kinds.get(f, 'string')}')").alias(f) for f in fields])
    return df.select("conv_id", layout.alias("layout"), turns.alias("turns"))


def escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit(ESC), F.lit(f"{ESC}e")), F.lit("<|"), F.lit(f"<{ESC}|"))


def unescape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit(f"<{ESC}|"), F.lit("<|")), F.lit(f"{ESC}e"), F.lit(ESC))


def escape_role(c: Column) -> Column:
    return F.replace(escape(c), F.lit("\n"), F.lit(f"{ESC}n"))


def unescape_role(c: Column) -> Column:
    return unescape(F.replace(c, F.lit(f"{ESC}n"), F.lit("\n")))


def format_chat(turns: DataFrame) -> DataFrame:
    """``conv_id, formatted, loss_mask`` of canonical turns.

    ``loss_mask`` holds the spans of ``formatted`` under the loss, each as
    ``struct<turn, start, length>``: the number of the turn's block in
    ``formatted`` (blocks end with END and a line break), and code points
    within it.  Cutting a span so takes one block, not the whole text.
    """
    blank = F.lit("")
    given = F.coalesce(F.col("turns"), F.array().cast("array<struct<role:string,text:string>>"))
    role, text = (lambda t: F.coalesce(t["role"], blank)), (lambda t: F.coalesce(t["text"], blank))
    head = lambda t: F.concat(F.lit(START), escape_role(role(t)), F.lit("\n"))
    block = lambda t: F.concat(head(t), escape(text(t)), F.lit(f"{END}\n"))
    spans = F.transform(given, lambda t, i: F.when(role(t) == "assistant", F.struct(
        i.alias("turn"), F.length(head(t)).alias("start"), F.length(escape(text(t))).alias("length"))))
    return turns.select("conv_id", F.array_join(F.transform(given, block), "").alias("formatted"),
                        F.filter(spans, lambda s: s.isNotNull()).alias("loss_mask"))


def read_back(formatted: DataFrame) -> DataFrame:
    """``conv_id, turns, loss, formatted_chars``: turns parsed from the formatted
    text, and the texts cut from it under the loss mask, in order, unescaped."""
    parts = F.filter(F.split("formatted", r"\Q" + END + r"\E\n"), lambda p: F.length(p) > 0)

    def turn(p: Column) -> Column:
        # the role ends at the first line break; a part starts with START
        role_end = F.instr(p, "\n")
        return F.struct(unescape_role(p.substr(F.lit(len(START) + 1), role_end - F.lit(len(START) + 1)))
                        .alias("role"), unescape(p.substr(role_end + 1, F.length(p))).alias("text"))

    blocks = formatted.select("conv_id", "formatted", "loss_mask", parts.alias("parts"))
    cut = lambda m: unescape(F.substring(F.get("parts", m["turn"]), m["start"] + 1, m["length"]))
    return blocks.select("conv_id", F.transform("parts", turn).alias("turns"), F.transform("loss_mask", cut).alias("loss"),
                         F.length("formatted").cast("long").alias("formatted_chars"))
