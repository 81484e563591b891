"""Chat formatting: conversations to training text with a loss mask, by a compiled template, and back.

The turns of a conversation are gathered in their order, then each task compiles the template once (``caseloom.llm.template``) and
renders conversation after conversation; ``generation`` blocks of the template become the loss mask, as stretches of code
points.  The filter ``guard`` keeps control strings apart from text: a backslash is doubled, and every place where a control string
would begin gets one backslash after its first character, so no control string is left in a text and ``unguard`` gives the
text back exactly.

A conversation is one training example, hence one row: its turns, not its neighbours', set the memory a task needs.

Defined cases: a NULL text or role is empty; NULL turns come last; equal turns go by role, then text, and repeated rows stay
repeated; rows with a NULL conv_id form one conversation with a NULL id; an empty table gives no conversation; only the four
columns named are read, whatever others the table has.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.llm.common import map_batches
from caseloom.llm.template import compile_template

CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|role|>", "<|text|>")

# Every turn stands between <s> and what closes it; other roles are written out, so each turn can be read back.
TEMPLATE = """
{%- for m in messages -%}
  {{ '<s>' }}
  {%- if m.role == 'user' %}{{ '[INST] ' ~ (m.text | guard) ~ ' [/INST]' }}
  {%- elif m.role == 'assistant' %}{% generation %}{{ m.text | guard }}{% endgeneration %}{{ '</s>' }}
  {%- elif m.role == 'system' %}{{ '<<SYS>>' ~ (m.text | guard) ~ '<</SYS>>' }}
  {%- else %}{{ '<|role|>' ~ (m.role | guard) ~ '<|text|>' ~ (m.text | guard) ~ '</s>' }}
  {%- endif -%}
{%- endfor -%}
"""
_TURN = re.compile(
    r"<s>(?:\[INST\] (?P<user>.*?) \[/INST\]|<<SYS>>(?P<system>.*?)<</SYS>>|<\|role\|>(?P<role>.*?)<\|text\|>(?P<text>.*?)</s>|(?P<assistant>.*?)</s>)",
    re.S,
)
FORMATTED = "conv_id long, formatted string, loss_from array<int>, loss_to array<int>"
DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def guard_for(controls: tuple[str, ...]) -> Callable[[object], str]:
    """The reversible escape for a set of control strings of two characters at least, none with a backslash."""
    if any(len(c) < 2 or "\\" in c for c in controls):
        raise ValueError("a control string has two characters at least and no backslash")
    starts = re.compile("|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in controls))

    def guard(value: object) -> str:
        text = "" if value is None else str(value)
        if "\\" in text:
            text = text.replace("\\", "\\\\")
        return starts.sub(lambda m: m.group() + "\\", text)

    return guard


_BACKSLASH = re.compile(r"\\(\\?)")


def unguard(text: str) -> str:
    return _BACKSLASH.sub(r"\1", text) if "\\" in text else text


def conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns of each conversation in order."""
    turn = F.col("turn").cast("long")
    row = F.struct(
        turn.isNull().alias("late"), turn.alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    return turns.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(F.sort_array(F.collect_list(row)).alias("turns"))


def format_conversations(turns: DataFrame, template: str = TEMPLATE, controls: tuple[str, ...] = CONTROLS) -> DataFrame:
    """One row per conversation: its text and the stretches under the loss mask (code points, end excluded).

    The template sees ``messages``, a list of turns with ``role`` and ``text``, and the filter ``guard``."""
    compile_template(template, {"guard": guard_for(controls)})  # a faulty template fails here, not in the tasks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template, {"guard": guard_for(controls)})
        for batch in batches:
            lists = batch.column("turns")
            edges = lists.offsets.to_pylist()
            roles, texts = (lists.values.field(name).to_pylist() for name in ("role", "text"))
            out = [
                render(messages=[{"role": r, "text": t} for r, t in zip(roles[a:b], texts[a:b])]) for a, b in zip(edges, edges[1:])
            ]
            yield pa.record_batch(
                [
                    batch.column("conv_id"),
                    pa.array(["".join(o.pieces) for o in out], pa.string()),
                    pa.array([[a for a, _ in o.marked] for o in out], pa.list_(pa.int32())),
                    pa.array([[b for _, b in o.marked] for o in out], pa.list_(pa.int32())),
                ],
                ["conv_id", "formatted", "loss_from", "loss_to"],
            )

    return map_batches(conversations(turns), run, FORMATTED)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a text that ``TEMPLATE`` made."""
    found, at = [], 0
    while at < len(formatted):
        turn = _TURN.match(formatted, at)
        if not turn:
            raise ValueError(f"no turn at {at}: {formatted[at : at + 40]!r}")
        at = turn.end()
        parts = turn.groupdict()
        if parts["role"] is not None:
            found.append((unguard(parts["role"]), unguard(parts["text"])))
        else:
            found.append(next((role, unguard(parts[role])) for role in ("user", "system", "assistant") if parts[role] is not None))
    return found


def digest(formatted: DataFrame) -> DataFrame:
    """Per conversation what its text, read back, holds: turns, text under the loss mask, size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            columns = (batch.column(n).to_pylist() for n in ("conv_id", "formatted", "loss_from", "loss_to"))
            for conv_id, text, starts, ends in zip(*columns):
                turns = read_turns(text)
                whole = "".join(f"{role}\n{said}\n" for role, said in turns)
                loss = "".join(unguard(text[a:b]) for a, b in zip(starts, ends))
                rows.append((conv_id, len(turns), _sha256(whole), len(loss), _sha256(loss), len(text)))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            yield pa.record_batch([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names)

    return map_batches(formatted, run, DIGEST)


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
