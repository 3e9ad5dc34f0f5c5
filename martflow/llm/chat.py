"""Chat formatting by schema fingerprints.

A record's layout is the sorted set of its nested field paths (``messages[].role``);
the hash of that set selects a declarative mapping, which says where turns,
roles and texts lie and how role names translate. Records of any mix of known
layouts become canonical turns; a record whose fingerprint is unknown is kept,
with its fingerprint and no turns, so that a mapping can be added.

Turns are rendered by a template with marks for the turn's start, role and end.
Control strings inside a text are escaped reversibly, so parsing the output
gives back exactly the turns, and the loss mask is the list of code point spans
of assistant texts in the output.

Conversations kept as one row per turn are formatted turn by turn (a turn's
output depends on nothing else), so a conversation of any length never has to
fit one row; digests over a conversation stream through its sorted rows.

Defined results: a null text is an empty one; a null role is an empty one;
turns are ordered by turn number, then role, then text (ties and repeated rows
are all kept); an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# -- layouts ------------------------------------------------------------------


def paths(value, at: str = "") -> set[str]:
    """Leaf field paths of a parsed record; list elements share ``[]``."""
    if isinstance(value, dict):
        return set().union(*(paths(v, f"{at}.{k}" if at else k) for k, v in value.items())) if value else {at}
    if isinstance(value, list):
        return set().union(*(paths(v, at + "[]") for v in value)) if value else {at + "[]"}
    return {at}


def fingerprint(field_paths) -> str:
    return hashlib.sha256("\n".join(sorted(field_paths)).encode()).hexdigest()[:16]


@dataclass(frozen=True)
class Mapping:
    """``listed``: path of a list of turns with ``role`` and ``text`` fields; or
    ``single``: (role, path) of each turn in order, a list of paths being joined
    by a blank line with empty ones left out. ``roles`` renames roles."""

    paths: tuple[str, ...]
    listed: str | None = None
    role: str = "role"
    text: str = "content"
    single: tuple[tuple[str, tuple[str, ...]], ...] = ()
    roles: dict = field(default_factory=dict)

    def turns(self, record) -> list[tuple[str, str]]:
        if self.single:
            out = []
            for role, places in self.single:
                if role == "=":  # the role is a field of the record itself
                    out.append((self._role(_get(record, self.role)), _text(_get(record, places[0]))))
                    continue
                got = [_text(_get(record, p)) for p in places]
                if any(got) or role != "system":
                    out.append((role, "\n\n".join(x for x in got if x)))
            return out
        return [(self._role(_get(x, self.role)), _text(_get(x, self.text))) for x in _get(record, self.listed) or []]

    def _role(self, name) -> str:
        name = _text(name)
        return self.roles.get(name, name)


def _get(value, path: str):
    for key in path.split(".") if path else []:
        value = value.get(key) if isinstance(value, dict) else None
    return value


def _text(value) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


SPEAKERS = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
MAPPINGS = (
    Mapping(("role", "text"), role="role", single=(("=", ("text",)),)),
    Mapping(("messages[].content", "messages[].role"), listed="messages", roles=SPEAKERS),
    Mapping(("conversations[].from", "conversations[].value"), listed="conversations", role="from", text="value", roles=SPEAKERS),
    Mapping(("completion", "prompt"), single=(("user", ("prompt",)), ("assistant", ("completion",)))),
    Mapping(("prompt", "response"), single=(("user", ("prompt",)), ("assistant", ("response",)))),
    Mapping(("instruction", "output"), single=(("user", ("instruction",)), ("assistant", ("output",)))),
    Mapping(("input", "instruction", "output"), single=(("user", ("instruction", "input")), ("assistant", ("output",)))),
    Mapping(("input", "instruction", "output", "system"),
            single=(("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",)))),
    Mapping(("answer", "question"), single=(("user", ("question",)), ("assistant", ("answer",)))),
)


class Registry:
    def __init__(self, mappings=MAPPINGS):
        self.by_print = {fingerprint(m.paths): m for m in mappings}

    def turns(self, record) -> tuple[str, list[tuple[str, str]] | None]:
        mark = fingerprint(paths(record))
        m = self.by_print.get(mark)
        return mark, None if m is None else m.turns(record)


# -- template -----------------------------------------------------------------

ESCAPE = "\\"


@dataclass(frozen=True)
class Template:
    """Output of a turn: ``open`` role ``mid`` text ``close``. Inside roles and
    texts every control string gets a backslash after its first character, as
    does every backslash; un-escaping drops a backslash and keeps what follows."""

    open: str = "<s>[TURN] "
    mid: str = " [/TURN]\n"
    close: str = "</s>\n"
    #: Further strings that must not appear in the output outside the marks.
    control: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[TURN]", "[/TURN]",
                                "<|im_start|>", "<|im_end|>", "<|endoftext|>")

    def escape(self, text: str) -> str:
        text = text.replace(ESCAPE, ESCAPE + ESCAPE)
        for c in self.control:
            if c in text:
                text = text.replace(c, c[0] + ESCAPE + c[1:])
        return text

    def unescape(self, text: str) -> str:
        if ESCAPE not in text:
            return text
        out, i = [], 0
        while (j := text.find(ESCAPE, i)) >= 0:
            out += [text[i:j], text[j + 1:j + 2]]
            i = j + 2
        return "".join(out) + text[i:]

    def render(self, turns: list[tuple[str, str]], learn: str = "assistant") -> tuple[str, list[tuple[int, int]]]:
        """(output, loss mask): spans [start, end) of the escaped texts of ``learn``."""
        out, at, mask = [], 0, []
        for role, text in turns:
            head, body = self.open + self.escape(role) + self.mid, self.escape(text)
            out += [head, body, self.close]
            at += len(head)
            if role == learn:
                mask.append((at, at + len(body)))
            at += len(body) + len(self.close)
        return "".join(out), mask

    def parse(self, output: str) -> list[tuple[str, str]]:
        """The turns of an output, exactly."""
        turns, i = [], 0
        while i < len(output):
            if not output.startswith(self.open, i):
                raise ValueError(f"no turn at {i}")
            m = output.index(self.mid, i + len(self.open))
            c = output.index(self.close, m + len(self.mid))
            turns.append((self.unescape(output[i + len(self.open):m]), self.unescape(output[m + len(self.mid):c])))
            i = c + len(self.close)
        return turns


def format_records(records: DataFrame, record: str = "record", keep: tuple[str, ...] = (),
                   mappings=MAPPINGS, template: Template = Template()) -> DataFrame:
    """One row per JSON record: the ``keep`` columns, ``fingerprint``,
    ``formatted`` string and ``mask`` array<struct<start, end>>; the last two
    are null where no mapping fits or the record is no JSON (fingerprint null)."""
    def task(batches):
        registry = Registry(mappings)
        for b in batches:
            marks, texts, masks = [], [], []
            for x in b.column(b.num_columns - 1).to_pylist():
                try:
                    mark, turns = registry.turns(json.loads(x)) if x is not None else (None, None)
                except ValueError:
                    mark, turns = None, None
                text, mask = template.render(turns) if turns is not None else (None, None)
                marks.append(mark)
                texts.append(text)
                masks.append(None if mask is None else [{"start": s, "end": e} for s, e in mask])
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(marks, pa.string()), pa.array(texts, pa.string()),
                 pa.array(masks, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                names=[*keep, "fingerprint", "formatted", "mask"])

    src = records.select(*[F.col(c) for c in keep], F.col(record).cast("string").alias("__record"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema[:-1])
    return src.mapInArrow(task, (kept + ", " if kept else "")
                          + "fingerprint string, formatted string, mask array<struct<start: bigint, end: bigint>>")


def format_turns(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text", **options) -> DataFrame:
    """Conversations of one row per turn: (conv_id, turn, fingerprint,
    formatted, mask), each row a one-turn record of the flat layout. A
    conversation's output is its rows' outputs in order of turn."""
    rows = turns.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"),
        F.to_json(F.struct(F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
                           F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))).alias("record"))
    return format_records(rows, "record", ("conv_id", "turn"), **options)


def digest(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """Read back from :func:`format_turns`' output, per conversation: n_turns,
    turns_sha256, loss_chars, loss_sha256, formatted_chars.

    Rows are dealt by conversation and sorted; a task streams through them with
    running hashes, so a conversation's length costs no memory.
    """
    def task(batches: Iterator[pa.RecordBatch]):
        now, out = None, []
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

        def close():
            out.append((now[0], now[1], now[2].hexdigest(), now[3], now[4].hexdigest(), now[5]))

        def flush(kind):
            cols = list(zip(*out)) or [[]] * 6
            b = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()])], names=names)
            out.clear()
            return b

        kind = pa.int64()
        for b in batches:
            kind = b.schema.field(0).type
            for conv, text, mask in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                if now is None or now[0] != conv:
                    if now is not None:
                        close()
                    now = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, body in template.parse(text):
                    now[1] += 1
                    now[2].update(f"{role}\n{body}\n".encode())
                for m in mask:
                    learned = template.unescape(text[m["start"]:m["end"]])
                    now[3] += len(learned)
                    now[4].update(learned.encode())
                now[5] += len(text)
            if out:
                yield flush(kind)
        if now is not None:
            close()
            yield flush(kind)

    rows = formatted.select("conv_id", "formatted", "mask", "turn")
    kind = rows.schema["conv_id"].dataType.simpleString()
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "formatted") \
        .select("conv_id", "formatted", "mask") \
        .mapInArrow(task, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
