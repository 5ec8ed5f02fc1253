"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are context, and only
its reply is trainable (``expand_examples``). The examples of a conversation are prefixes of one
another, so their size grows with the square of a conversation; ``format_conversations`` is the
compact form, in which an example's row holds just what it adds to the one before
(``addition``), how many code points of context stand before that, and its loss span. Turns
after the last reply form a last row without a loss span, so that nothing is lost.

A turn is ``<|im_start|>role<|im_sep|>text<|im_end|>`` and a newline. Whatever looks like a
control string inside a role or text gets a backslash after its first character, and such a
string that already has backslashes there gets one more; taking one away restores the text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The marks of the template, and the strings that common templates treat as control.
START, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
#: No alternative holds "<" or "[", so that two matches never overlap.
CONTROL = r"([<\[])(\\*)(\|(?:im_start|im_sep|im_end|system|user|assistant|endoftext|startoftext|eot_id|begin_of_text|end_of_text)\|>|/?s>|/?(?:INST|SYS)[\]>]|pad>|unk>|bos>|eos>)"
_ESCAPED = re.compile(CONTROL.replace(r"(\\*)", r"\\(\\*)"))
_TURN = re.compile(rf"{re.escape(START)}((?s:.*?)){re.escape(SEPARATOR)}((?s:.*?)){re.escape(END)}\n")


def escape(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), CONTROL, r"$1$2\\$3")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def format_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, example, context_chars, addition, loss_start, loss_end), the rows of a
    conversation together and in order.

    ``loss_start`` and ``loss_end`` are code points of the whole example; both are null in the
    last row of a conversation that doesn't end with a reply. Rows go by turn, ties by role and
    text; repeated rows are turns of their own. Null text or role counts as empty; null
    conversation ids are one conversation. An empty table gives an empty result; other columns
    are ignored. A conversation is read as a stream; at most one addition is held.
    """
    head = F.concat(F.lit(START), escape(F.col(role_col)), F.lit(SEPARATOR))
    rows = turns.select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col) == "assistant", F.lit(False)).alias("reply"),
        F.length(head).alias("head"),
        F.concat(head, escape(F.col(text_col)), F.lit(END + "\n")).alias("segment"),
    )
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "segment").drop("turn")
    tail = len(END) + 1

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv: int | None = None
        example, context, held = 0, 0, []
        begun = False

        def close(out: list[tuple]) -> None:
            if held:
                out.append((conv, example, context, "".join(held), None, None))

        for batch in batches:
            out: list[tuple] = []
            for c, reply, head, segment in zip(*(batch.column(x).to_pylist() for x in ("conv_id", "reply", "head", "segment"))):
                if not begun or c != conv:
                    close(out)
                    conv, example, context, held, begun = c, 0, 0, [], True
                held.append(segment)
                if reply:
                    addition = "".join(held)
                    end = context + len(addition)
                    out.append((conv, example, context, addition, end - len(segment) + head, end - tail))
                    example, context, held = example + 1, end, []
            if out:
                yield _batch(out, _COMPACT)
        out = []
        close(out)
        if out:
            yield _batch(out, _COMPACT)

    return rows.mapInArrow(run, _COMPACT)


_COMPACT = "conv_id long, example long, context_chars long, addition string, loss_start long, loss_end long"
_EXAMPLE = "conv_id long, example long, text string, loss_start long, loss_end long"


def in_order(rows: DataFrame) -> DataFrame:
    """The rows of a conversation in one task, example after example; one shuffle."""
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "example")


def expand_examples(formatted: DataFrame, ordered: bool = False) -> DataFrame:
    """(conv_id, example, text, loss_start, loss_end): every example in full, context first.

    A last row without a reply has null for its loss span. ``formatted`` may come in any order,
    from a written table too; ``ordered`` says that it comes straight from ``format_conversations``
    or ``in_order``, and saves a shuffle. A row whose context isn't what stands before it is an error,
    never a shorter context. A task holds the text of one conversation.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, text, begun, out, size = None, "", False, [], 0
        for batch in batches:
            for row in batch.to_pylist():
                if not begun or row["conv_id"] != conv:
                    conv, text, begun = row["conv_id"], "", True
                if row["context_chars"] != len(text):
                    raise ValueError(f"example {row['example']} of conversation {conv} comes without its context")
                text += row["addition"]
                out.append((conv, row["example"], text, row["loss_start"], row["loss_end"]))
                size += len(text)
                if size > 1 << 22:
                    yield _batch(out, _EXAMPLE)
                    out, size = [], 0
        if out:
            yield _batch(out, _EXAMPLE)

    return (formatted if ordered else in_order(formatted)).mapInArrow(run, _EXAMPLE)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [x.split() for x in schema.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string()}
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(zip(*rows), fields)], [n for n, _ in fields])


def read_back(examples: DataFrame, ordered: bool = False) -> DataFrame:
    """What the whole examples of each conversation hold, parsed and unescaped:
    conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    Every example must begin with the whole text of the one before, its context; what it adds is
    parsed. ``formatted_chars`` is the length of the longest example (or the last row). Order: see
    ``expand_examples``. A missing or repeated example is an error.
    """
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: list | None = None

        def total() -> tuple:
            conv, n, turns, chars, loss, text, _ = state
            return conv, n, turns.hexdigest(), chars, loss.hexdigest(), len(text)

        for batch in batches:
            out: list[tuple] = []
            for conv, example, text, start, end in zip(*(batch.column(x).to_pylist() for x in ("conv_id", "example", "text", "loss_start", "loss_end"))):
                if state is None or conv != state[0]:
                    if state is not None:
                        out.append(total())
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), "", 0]
                if example != state[6] or not text.startswith(state[5]):
                    raise ValueError(f"example {example} of conversation {conv} comes without its context")
                at = len(state[5])
                state[5], state[6] = text, example + 1
                for m in _TURN.finditer(text, at):
                    if m.start() != at:
                        break
                    at = m.end()
                    state[1] += 1
                    state[2].update(f"{unescape(m[1])}\n{unescape(m[2])}\n".encode("utf-8", "surrogatepass"))
                if at != len(text):
                    raise ValueError(f"conversation {conv} can't be read back")
                if start is not None:
                    reply = unescape(text[start:end])
                    state[3] += len(reply)
                    state[4].update(reply.encode("utf-8", "surrogatepass"))
            if out:
                yield _batch(out, schema)
        if state is not None:
            yield _batch([total()], schema)

    return (examples if ordered else in_order(examples)).mapInArrow(run, schema)
