"""Chat formatting: layouts by schema fingerprint, canonical turns, a reversible template.

A record's fingerprint is the hash of its sorted nested field paths. It selects one of the declared
layouts, which say where roles and texts are; no code is specific to a layout.
"""

from __future__ import annotations

import hashlib
import itertools
import json
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityforge.llm.columns import Columns, as_columns, map_columns, names


@dataclass(frozen=True)
class Layout:
    """Where a layout keeps its turns.

    `fixed`: (role, path) of single texts, in order. `rows`: (array path, role key, text key) of a
    list of turns; an empty array path: the record itself is one turn. `optional`: paths that may be
    missing. `also`: further paths that may be there and hold no turn.
    """

    name: str
    fixed: tuple[tuple[str, str], ...] = ()
    rows: tuple[str, str, str] | None = None
    optional: tuple[str, ...] = ()
    also: tuple[str, ...] = ()

    def paths(self) -> tuple[set[str], set[str]]:
        """Paths that a record must have, and that it may have."""
        own = {p for _, p in self.fixed}
        if self.rows:
            array, *keys = self.rows
            own |= {f"{array}[].{k}" if array else k for k in keys}
        return own - set(self.optional), set(self.optional) | set(self.also)


LAYOUTS = (
    Layout("turn", rows=("", "role", "text")),
    Layout("messages", (("system", "system"),), ("messages", "role", "content"), ("system",), ("id",)),
    Layout("conversations", (("system", "system"),), ("conversations", "from", "value"), ("system",), ("id",)),
    Layout("prompt_response", (("system", "system"), ("user", "prompt"), ("assistant", "response")), None, ("system",), ("id",)),
    Layout("prompt_completion", (("system", "system"), ("user", "prompt"), ("assistant", "completion")), None, ("system",), ("id",)),
    Layout("instruction", (("user", "instruction"), ("user", "input"), ("assistant", "output")), None, ("input",), ("id",)),
    Layout("question_answer", (("user", "question"), ("assistant", "answer")), None, (), ("id",)),
    Layout("nested", (("user", "prompt.text"), ("assistant", "response.text")), None, (), ("id",)),
)
#: Role names of list layouts that mean a canonical role.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def _key(name: str) -> str:
    """A field name as a step of a path: its own backslashes, full stops and brackets never read as structure."""
    for c in "\\.[]\n":
        name = name.replace(c, f"\\{ord(c):x};" if c == "\n" else f"\\{c}")
    return name or "\\0;"


def field_paths(value: object, at: str = "") -> set[str]:
    """Nested field paths of a parsed record; list elements share the path `[]`."""
    if isinstance(value, dict) and value:
        return set().union(*(field_paths(v, f"{at}.{_key(k)}" if at else _key(k)) for k, v in value.items()))
    if isinstance(value, list) and value:
        return set().union(*(field_paths(v, f"{at}[]") for v in value))
    return {at}


def fingerprint(paths: set[str]) -> str:
    """Hash of the sorted paths."""
    return hashlib.blake2b("\n".join(sorted(paths)).encode(), digest_size=8).hexdigest()


def mapping_table(layouts: tuple[Layout, ...] = LAYOUTS) -> dict[str, Layout]:
    """Every fingerprint that a declared layout allows."""
    table: dict[str, Layout] = {}
    for layout in layouts:
        must, may = layout.paths()
        for n in range(len(may) + 1):
            for some in itertools.combinations(sorted(may), n):
                table.setdefault(fingerprint(must | set(some)), layout)
                if layout.rows and layout.rows[0]:  # an empty list of turns
                    table.setdefault(fingerprint({layout.rows[0], *some}), layout)
    return table


def _at(record: object, path: str) -> object:
    for key in path.split("."):
        record = record.get(key) if isinstance(record, dict) else None
    return record


def _text(value: object) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def turns_of(record: object, layout: Layout) -> list[tuple[str, str]]:
    """(role, text) of a record in a layout; an optional text that is missing or empty is no turn."""
    out = []
    for role, path in layout.fixed:
        value = _text(_at(record, path))
        if value or path not in layout.optional:
            out.append((role, value))
    if layout.rows:
        array, role_key, text_key = layout.rows
        for row in (_at(record, array) or []) if array else [record]:
            role = _text(row.get(role_key))
            out.append((ROLES.get(role, role) if array else role, _text(row.get(text_key))))
    return out


TURNS = "conv_id long, turn long, step int, role string, text string, layout string"


def canonical_turns(records: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """Canonical turns of `records` (conv_id, turn, record as JSON text).

    A record gives one row per turn it holds, numbered by `step`. `turn` orders the records of a
    conversation. A record of no declared layout, or that is no JSON object, is kept as one row with
    null layout and role and its raw text. Null texts are empty, texts of any length are whole, and
    repeated records are kept. Names of fields may hold the marks of paths. An empty table gives no
    rows; other columns are not read, whatever their names.
    """
    table = mapping_table(layouts)

    def run(batches: Iterator[Columns]) -> Iterator[Columns]:
        for batch in batches:
            rows = []
            for conv_id, turn, raw in zip(batch["conv_id"], batch["turn"], batch["record"]):
                try:
                    record = json.loads(raw) if raw is not None else None
                except ValueError:
                    record = None
                layout = table.get(fingerprint(field_paths(record))) if isinstance(record, dict) else None
                if layout is None:
                    rows.append((conv_id, turn, 0, None, raw, None))
                else:
                    rows += [(conv_id, turn, i, role, text, layout.name) for i, (role, text) in enumerate(turns_of(record, layout))]
            yield as_columns(rows, names(TURNS))

    slim = records.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "record")
    return map_columns(slim, run, TURNS)


#: The template: `### role:`, a line feed, the text, a line feed, `</turn>`, a line feed.
OPEN, CLOSE = "### ", "</turn>"


def escape(text: Column) -> Column:
    """Breaks both control strings with backslashes; a backslash is doubled. `\\c` always reads back as `c`."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    out = F.replace(out, F.lit(CLOSE), F.lit("<\\/turn>"))
    return F.replace(out, F.lit(OPEN), F.lit("\\#\\#\\# "))


def unescape(text: str) -> str:
    """The text that `escape` was given."""
    if "\\" not in text:
        return text
    out, i = [], 0
    while (j := text.find("\\", i)) >= 0 and j + 1 < len(text):
        out += [text[i:j], text[j + 1]]
        i = j + 2
    return "".join([*out, text[i:]])


def format_turns(turns: DataFrame, trained: str = "assistant") -> DataFrame:
    """One formatted segment per turn; a conversation's output is its segments in order.

    Returns conv_id, turn, step, segment, loss_start and loss_length: the code points of the segment
    under the loss mask, which covers the texts of `trained` and nothing else. Segments rather than
    whole conversations, so that a conversation of any length is never one value.
    """
    role = F.replace(F.replace(F.coalesce("role", F.lit("")), F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A"))
    head = F.concat(F.lit(OPEN), role, F.lit(":\n"))
    body = escape(F.coalesce("text", F.lit("")))
    return turns.select(
        "conv_id", "turn", "step", F.concat(head, body, F.lit(f"\n{CLOSE}\n")).alias("segment"),
        F.length(head).alias("loss_start"), F.when(F.col("role") == trained, F.length(body)).otherwise(0).alias("loss_length"),
    )


DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of every conversation, from its formatted segments alone.

    Segments are streamed in order (turn, null first; step; then the segment itself), so a task holds
    one batch and one open conversation's hash state, however long that conversation is. The hash of
    a conversation is sequential by definition; all formatting before it is spread row by row. Null
    ids are one conversation, null turns come first, repeated turns count each, and equal places are
    ordered by the segment. An empty table gives no rows; other columns are not read.
    """

    def run(batches: Iterator[Columns]) -> Iterator[Columns]:
        now, state, out = None, None, []
        for batch in batches:
            for conv_id, segment, start, size in zip(*(batch[k] for k in ("conv_id", "segment", "loss_start", "loss_length"))):
                if state is None or conv_id != now:
                    if state is not None:
                        out.append(_closed(now, state))
                    now, state = conv_id, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                head, _, rest = segment.partition("\n")
                role = head.removeprefix(OPEN).removesuffix(":").replace("%0A", "\n").replace("%25", "%")
                text = unescape(rest.removesuffix(f"\n{CLOSE}\n"))
                under = unescape(segment[start : start + size])
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                state[2] += len(under)
                state[3].update(under.encode("utf-8", "surrogatepass"))
                state[4] += len(segment)
            if out:
                yield as_columns(out, names(DIGEST))
                out = []
        if state is not None:
            yield as_columns([_closed(now, state)], names(DIGEST))

    # conversations in order within partitions
    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "step", "segment")
    return map_columns(ordered.select("conv_id", "segment", "loss_start", "loss_length"), run, DIGEST)


def _closed(conv_id: object, state: list) -> tuple:
    return conv_id, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]

