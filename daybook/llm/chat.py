"""Chat formatting: records of many layouts become turns by the fingerprint of their fields, turns become marked text.

A record is a JSON document. Its fingerprint is a hash of the paths of its nested fields, sorted, list places left out,
whatever the values. Each layout declares which paths hold roles and texts, and its fingerprints, with or without its
optional fields, are known beforehand, so a record finds its layout by one lookup. A fingerprint that no layout declares
is resolved once, to the layout whose fields it holds most of; without one the record stays whole, as a turn of its own.

A template marks where turns begin, their role ends, and they end. Control strings inside texts get a backslash after
their first character, and one more if they have some, so texts hold no control string and are read back exactly. Turns
are ordered by range partitions, which split a conversation that holds many rows, and written in chunks of whole
turns with the spans of the loss mask. Reading back parses the chunks; conversations that lie in one chunk are done
where they are, and only the chunks of the others are brought together, in order, a chunk at a time.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain, combinations

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from daybook.llm.common import ship, spread, written

CHUNK = 1 << 20


@dataclass(frozen=True)
class Layout:
    """Where a record's turns are.

    ``turns``: the path of the list that holds them, empty if the record itself is one, or None if there is a turn per
    entry of ``parts``. ``role`` and ``text`` are fields of a turn. ``parts``: (role, paths of the texts that are joined
    by an empty line). ``optional``: paths that may be missing. ``names``: the roles that values stand for.
    """

    name: str
    turns: str | None = None
    role: str = ""
    text: str = ""
    parts: tuple[tuple[str, tuple[str, ...]], ...] = ()
    optional: tuple[str, ...] = ()
    names: dict = field(default_factory=dict, hash=False)

    def paths(self) -> set[str]:
        """The paths of all fields that the layout reads."""
        if self.turns is None:
            return {p for _, paths in self.parts for p in paths}
        head = f"{self.turns}[]." if self.turns else ""
        return {head + self.role, head + self.text} | {p for _, paths in self.parts for p in paths}


_SPOKEN = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
LAYOUTS = (
    Layout("row", turns="", role="role", text="text"),
    Layout("row content", turns="", role="role", text="content"),
    Layout("messages", turns="messages", role="role", text="content", parts=(("system", ("system",)),), optional=("system",)),
    Layout("conversations", turns="conversations", role="from", text="value", parts=(("system", ("system",)),),
           optional=("system",), names=_SPOKEN),
    Layout("nested messages", turns="data.messages", role="author.role", text="content.text", names=_SPOKEN),
    Layout("instruction", parts=(("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",))),
           optional=("input", "system")),
    Layout("instruction response", parts=(("user", ("instruction", "context")), ("assistant", ("response",))), optional=("context",)),
    Layout("prompt completion", parts=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("completion",))), optional=("system",)),
    Layout("prompt response", parts=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",))), optional=("system",)),
    Layout("question answer", parts=(("user", ("context", "question")), ("assistant", ("answer",))), optional=("context",)),
)
#: The role of a record that no layout fits.
UNMAPPED = "unmapped"


def field_paths(record) -> frozenset[str]:
    """The paths of all fields that hold no further fields; the places of a list have one path."""
    found, rest = set(), [("", record)]
    while rest:
        path, value = rest.pop()
        if isinstance(value, dict) and value:
            rest += [(f"{path}.{k}" if path else k, v) for k, v in value.items()]
        elif isinstance(value, list) and any(isinstance(v, (dict, list)) for v in value):
            rest += [(path + "[]", v) for v in value]
        else:
            found.add(path)
    return frozenset(found)


def fingerprint(paths: frozenset[str]) -> int:
    """A 64-bit hash of the sorted paths."""
    return int.from_bytes(hashlib.blake2b("\n".join(sorted(paths)).encode(), digest_size=8).digest(), "big", signed=True)


class Mappings:
    """Layouts by fingerprint."""

    def __init__(self, layouts: tuple[Layout, ...] = LAYOUTS):
        self._layouts, self._known = layouts, {}
        for layout in layouts:
            every = layout.paths()
            for left_out in chain.from_iterable(combinations(layout.optional, k) for k in range(len(layout.optional) + 1)):
                self._known.setdefault(fingerprint(frozenset(every - set(left_out))), layout)

    def find(self, record) -> tuple[int, Layout | None]:
        """A record's fingerprint and its layout."""
        paths = field_paths(record)
        print_ = fingerprint(paths)
        if print_ not in self._known:
            fits = [(len(lay.paths() & paths), -i, lay) for i, lay in enumerate(self._layouts)
                    if lay.paths() - set(lay.optional) <= paths]
            if len(self._known) > 100_000:
                return print_, max(fits)[2] if fits else None
            self._known[print_] = max(fits)[2] if fits else None
        return print_, self._known[print_]

    def turns(self, body: str | None) -> tuple[int | None, str | None, list[tuple[str, str]]]:
        """(fingerprint, name of the layout, turns) of a record; one that isn't JSON or fits no layout is one turn."""
        try:
            record = json.loads(body) if body is not None else None
        except (ValueError, RecursionError):
            return None, None, [(UNMAPPED, body)]
        print_, layout = self.find(record)
        if layout is None:
            return print_, None, [(UNMAPPED, body or "")]
        out = []
        for role, paths in layout.parts:
            values = [v for v in (_at(record, p) for p in paths) if v is not None]
            texts = [_text(v) for v in values]
            if values and (layout.turns is None or any(texts)):
                out.append((role, "\n\n".join(t for t in texts if t)))
        if layout.turns is not None:
            items = _at(record, layout.turns) if layout.turns else [record]
            for item in items if isinstance(items, list) else [items]:
                role = _text(_at(item, layout.role))
                out.append((layout.names.get(role, role), _text(_at(item, layout.text))))
        return print_, layout.name, out


def _at(value, path: str):
    for step in path.split("."):
        value = value.get(step) if isinstance(value, dict) else None
    return value


def _text(value) -> str:
    """Null is empty, and what isn't text is its JSON."""
    if value is None:
        return ""
    return value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def canonical_turns(records: DataFrame, conv_col: str = "conv", nth_col: str = "nth", body_col: str = "body",
                    layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """(conv, nth, place, role, text, fingerprint, layout): the turns of all records.

    A conversation is made of its records by ``nth``, and of a record's turns by ``place``. Null roles and texts are
    empty. A record of an unknown layout, one that isn't JSON or is null, is a turn of the role ``UNMAPPED`` with the
    whole record as text and no layout. Lone surrogates, which UTF-8 can't hold, become question marks.
    """
    ship(records.sparkSession)
    kinds = [records.schema[c].dataType.simpleString() for c in (conv_col, nth_col)]

    def mapped(batches):
        from daybook.llm import chat as own

        mappings = own.Mappings(layouts)
        for batch in batches:
            at, place, columns = [], [], ([], [], [], [])
            for i, body in enumerate(batch.column(2)):
                print_, name, turns = mappings.turns(body.as_py())
                for j, (role, text) in enumerate(turns):
                    at.append(i)
                    place.append(j)
                    for column, value in zip(columns, (role, text, print_, name)):
                        column.append(value.encode("utf-8", "replace") if isinstance(value, str) else value)
            types = (pa.string(), pa.string(), pa.int64(), pa.string())
            known = batch.select([0, 1]).take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([*known.columns, pa.array(place, pa.int32()), *[pa.array(c, t) for c, t in zip(columns, types)]],
                                             names=["conv", "nth", "place", "role", "text", "fingerprint", "layout"])

    return records.select(conv_col, nth_col, body_col).mapInArrow(
        mapped, f"conv {kinds[0]}, nth {kinds[1]}, place int, role string, text string, fingerprint long, layout string")


def layouts_met(turns: DataFrame) -> DataFrame:
    """(fingerprint, layout, n_turns) of ``canonical_turns``: what a collection holds, unknown layouts included."""
    return turns.groupBy("fingerprint", "layout").agg(F.count(F.lit(1)).alias("n_turns"))


#: The control strings of public chat templates.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>",
            "<|system|>", "<|user|>", "<|assistant|>", "<|eot_id|>", "<|start_header_id|>", "<|end_header_id|>")


class Template:
    """Marks turns as ``start`` role ``middle`` text ``end`` and escapes ``controls`` in roles and texts."""

    def __init__(self, start: str = "<|im_start|>", middle: str = "\n", end: str = "<|im_end|>\n", controls: tuple[str, ...] = CONTROLS):
        self.start, self.middle, self.end = start, middle, end
        for mark in (start, end):
            if not any(c in mark for c in controls):
                raise ValueError(f"the mark {mark!r} holds no control string")
        for one in controls:
            for two in controls:
                if any(one.endswith(two[:k]) for k in range(1, min(len(one), len(two)))):
                    raise ValueError(f"control strings {one!r} and {two!r} can overlap")
        heads = {}
        for c in controls:
            heads.setdefault(c[0], []).append(re.escape(c[1:]))
        some = "|".join(f"{re.escape(h)}(\\\\*)(?:{'|'.join(sorted(tails, key=len, reverse=True))})" for h, tails in heads.items())
        self._escaped = re.compile(some)
        self._parts = re.compile(f"{re.escape(start)}(.*?){re.escape(middle)}(.*?){re.escape(end)}", re.S)

    def escape(self, text: str) -> str:
        return self._escaped.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)

    def unescape(self, text: str) -> str:
        return self._escaped.sub(lambda m: m[0][0] + m[0][2:] if m[0][1] == "\\" else m[0], text)

    def turn(self, role: str, text: str) -> tuple[str, int, int]:
        """A turn's formatted text and where its own text begins and ends in it."""
        head = self.start + self.escape(role.replace("\\", "\\\\").replace("\n", "\\n")) + self.middle
        own = self.escape(text)
        return head + own + self.end, len(head), len(head) + len(own)

    def parse(self, formatted: str) -> Iterator[tuple[str, str]]:
        """(role, text) of each turn."""
        for m in self._parts.finditer(formatted):
            role = re.sub(r"\\(.)", lambda e: "\n" if e[1] == "n" else e[1], self.unescape(m[1]))
            yield role, self.unescape(m[2])


def formatted_chunks(turns: DataFrame, template: Template | None = None, learnt: str = "assistant", chunk: int = CHUNK) -> DataFrame:
    """(conv, part, nth_chunk, whole, n_turns, formatted, loss): conversations as marked text, in chunks of whole turns.

    Turns of a conversation are in the order of their record and place, ties by role, then text. ``loss`` lists the
    (start, stop) code points of the texts of the role ``learnt``. A conversation's chunks are in the order of ``part``
    and ``nth_chunk``; ``whole`` tells that there are no others. A chunk ends after the turn that brings it to ``chunk``
    code points.
    """
    ship(turns.sparkSession)
    used, kind = template or Template(), turns.schema["conv"].dataType.simpleString()
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = turns.select("conv", "nth", "place", "role", "text").repartitionByRange(parts, "conv", "nth", "place")
    placed = placed.sortWithinPartitions("conv", "nth", "place", "role", "text")

    def chunks(batches):
        from pyspark import TaskContext

        part, names = TaskContext.get().partitionId(), [f.split()[0] for f in schema.split(", ")]
        done: list[tuple] = []
        size, number, spans, pieces, n = 0, 0, [], [], 0
        now, first = None, True

        def packed(rows):
            convs, nths, wholes, ns, texts, losses = zip(*rows)
            return pa.RecordBatch.from_arrays(
                [pa.array(convs, batch.schema.field(0).type), pa.array([part] * len(rows)), pa.array(nths), pa.array(wholes),
                 pa.array(ns), pa.array(texts), pa.array(losses, pa.list_(pa.list_(pa.int64())))], names=names)

        held, begun = 0, False
        for batch in batches:
            for conv, role, text in zip(*[batch.column(k).to_pylist() for k in (0, 3, 4)]):
                if not begun or conv != now:
                    if begun:
                        # The first and the last conversation of a task may go on in others.
                        done.append((now, number, number == 0 and not first, n, "".join(pieces), spans))
                        held, first = held + size, False
                    now, begun, size, number, spans, pieces, n = conv, True, 0, 0, [], [], 0
                elif size >= chunk:
                    done.append((now, number, False, n, "".join(pieces), spans))
                    held, number = held + size, number + 1
                    size, spans, pieces, n = 0, [], [], 0
                if held >= 4 * chunk or len(done) >= 5000:
                    yield packed(done)
                    done, held = [], 0
                marked, start, stop = used.turn(role or "", text or "")
                if role == learnt:
                    spans.append([size + start, size + stop])
                pieces.append(marked)
                size, n = size + len(marked), n + 1
        if begun:
            done.append((now, number, False, n, "".join(pieces), spans))
            yield packed(done)

    schema = f"conv {kind}, part long, nth_chunk long, whole boolean, n_turns long, formatted string, loss array<array<bigint>>"
    return placed.mapInArrow(chunks, schema)


def digests(chunks: DataFrame, template: Template | None = None) -> DataFrame:
    """(conv, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) read back from ``formatted_chunks``.

    The turns are parsed from the marked text, and the learnt texts cut out by the loss mask and unescaped.
    """
    ship(chunks.sparkSession)
    used, kind = template or Template(), chunks.schema["conv"].dataType.simpleString()

    def read(batches):
        now, totals = None, None
        rows: list[tuple] = []
        names = [c.split()[0] for c in schema.split(", ")]

        def packed():
            columns = list(zip(*[(t[0], t[1].hexdigest(), t[2], t[3].hexdigest(), t[4]) for _, t in rows]))
            convs = pa.array([c for c, _ in rows], batch.schema.field(0).type)
            return pa.RecordBatch.from_arrays([convs, *map(pa.array, columns)], names=names)

        for batch in batches:
            for conv, formatted, loss in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                if totals is None or conv != now:
                    now, totals = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                    if len(rows) >= 5000:
                        yield packed()
                        rows.clear()
                    rows.append((conv, totals))
                text = formatted.as_py()
                for role, own in used.parse(text):
                    totals[0] += 1
                    totals[1].update(f"{role}\n{own}\n".encode())
                for start, stop in loss:
                    own = used.unescape(text[start:stop])
                    totals[2] += len(own)
                    totals[3].update(own.encode())
                totals[4] += len(text)
        if rows:
            yield packed()

    schema = f"conv {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    columns = ["conv", "formatted", "loss"]
    alone = chunks.filter("whole").select(columns).mapInArrow(read, schema)
    others = spread(chunks.filter("not whole"), "conv").sortWithinPartitions("conv", "part", "nth_chunk")
    return alone.unionByName(others.select(columns).mapInArrow(read, schema))


def formatted_conversations(records: DataFrame, conv_col: str = "conv", nth_col: str = "nth", body_col: str = "body",
                            template: Template | None = None) -> DataFrame:
    """The records' conversations written as marked text in the shared folder, and what is read back of each (as
    ``digests``). Records without a conversation are one of their own, the null one. An empty table gives an empty result."""
    turns = canonical_turns(records, conv_col, nth_col, body_col)
    return digests(written(formatted_chunks(turns, template), "chat-formatted"), template)
