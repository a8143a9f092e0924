"""Chat formatting: conversations rendered by a compiled template, with a loss mask."""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seamfold.llm.core import prepare
from seamfold.llm.template import Template

OPEN, BREAK, CLOSE = "<|turn|>", "<|text|>", "<|end|>\n"
#: Strings that may mean something to a model or a reader; none stands in an escaped text.
CONTROL = ("<|turn|>", "<|text|>", "<|end|>", "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")

TEMPLATE = "{% for m in messages %}{{ '" + OPEN + "' + (m.role|escape) + '" + BREAK + "' }}{% if m.role == 'assistant' %}{% generation %}{{ m.text|escape }}{% endgeneration %}{% else %}{{ m.text|escape }}{% endif %}{{ '<|end|>\\n' }}{% endfor %}"

_CONTROL = re.compile("|".join(map(re.escape, sorted(CONTROL, key=len, reverse=True))))


def escape(text: str) -> str:
    """Backslashes doubled, then one put behind the first character of each control string."""
    text = text.replace("\\", "\\\\")
    return _CONTROL.sub(lambda m: f"{m[0][0]}\\{m[0][1:]}", text)


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted conversation."""
    turns = []
    for part in formatted.split(CLOSE)[:-1]:
        role, _, text = part.removeprefix(OPEN).partition(BREAK)
        turns.append((unescape(role), unescape(text)))
    return turns


def format_chats(chats: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """(conv_id, n_turns, formatted, spans) for each conversation of (conv_id, turn, role, text).

    Turns are ordered by turn, then role, then text, nulls first; repeated rows are
    repeated turns. A null role or text counts as empty; rows with a null conv_id are
    one conversation. spans are the [start, end) characters that the model is to learn.
    Other columns are ignored; no rows give no rows. A conversation is one value of the
    result, so it has to fit in memory, and its rows meet in one task.
    """
    prepare(chats.sparkSession)
    turn = F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    grouped = chats.select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t")).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    def render(batches):
        compiled = Template(template, {"escape": escape})
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            n, formatted, spans = [], [], []
            for turns in batch.column(1).to_pylist():
                text, marks = compiled.render(messages=turns)
                n.append(len(turns))
                formatted.append(text)
                spans.append([{"start": a, "end": b} for a, b in marks])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(formatted, pa.string()), pa.array(spans, span)], names=["conv_id", "n_turns", "formatted", "spans"])

    return grouped.mapInArrow(render, "conv_id long, n_turns long, formatted string, spans array<struct<start: long, end: long>>")


def digests(formatted: DataFrame) -> DataFrame:
    """What can be read back from the output of format_chats under the default template."""

    def read(batches):
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for text, spans in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                turns = read_back(text)
                loss = "".join(unescape(text[s["start"] : s["end"]]) for s in spans)
                row = (len(turns), _sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), _sha(loss), len(text))
                for x, v in zip(out, row, strict=True):
                    x.append(v)
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, k) for x, k in zip(out, kinds, strict=True))], names=names)

    return formatted.mapInArrow(read, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
