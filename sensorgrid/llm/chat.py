"""Chat formatting with typed content parts.

A turn's content is a list of parts: text, image, audio, document (which may hold parts of its
own). :class:`Flattener` visits them in order and writes text as it is and every other part as
a numbered placeholder, recording the attachment's reference and how many tokens the
placeholder stands for once expanded. A turn without a ``content`` column is one text part.

Template, one segment for each turn; a conversation is its segments in order::

    user       [INST] text [/INST]
    assistant  <space>text </s>          (its text is under the loss mask)
    system     <<SYS>> text <</SYS>>
    any other  [ROLE:name] text [/ROLE]

Control strings and placeholders inside texts and role names are escaped: a backslash is
doubled, and every place where a control string starts gets a backslash after its first
character. :func:`unescape` takes them out again; :func:`parse` reads a segment back.

Scale: segments are made row by row, without a shuffle. Reading back shuffles segments by
conversation and streams them in order with running digests, so a conversation of any length
takes constant memory; its digest is sequential by nature.

Defined cases: null text is empty; a null role is the empty name; a null turn comes first, and
equal turns are ordered by role, then text; a null conv_id is a conversation of its own; an
empty table gives an empty result; other columns are not carried.
"""

from __future__ import annotations

import hashlib
import json
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorgrid.llm.common import small_batches, stash

CONTROLS = ("[INST]", "[/INST]", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[ROLE:", "[/ROLE]", "<|image:", "<|audio:", "<|document:")
_START = re.compile("(?=" + "|".join(map(re.escape, CONTROLS)) + ")(.)", re.S)
#: Token prices of attachments: image patch side in pixels, audio tokens a second, tokens a page.
PATCH, AUDIO_RATE, PAGE_TOKENS = 14, 25, 600


def escape(text: str) -> str:
    return _START.sub(r"\1\\", text.replace("\\", "\\\\")) if "\\" in text or "[" in text or "<" in text else text


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S) if "\\" in text else text


class Flattener:
    """Visits content parts in order; a kind of part is a method ``visit_<kind>``."""

    def __init__(self):
        self.out: list[str] = []
        self.pending = ""  # texts in a row are escaped as one: a control string may span them
        self.attachments: list[tuple[int, str, str, int]] = []

    def visit(self, part) -> None:
        if part is None:
            return
        if isinstance(part, str):
            part = {"type": "text", "text": part}
        kind = part.get("type") or "text"
        method = getattr(self, f"visit_{kind}", None)
        if method is None:
            raise ValueError(f"unknown content part: {kind}")
        method(part)

    def visit_text(self, part) -> None:
        self.pending += part.get("text") or ""

    def finish(self) -> str:
        self.out.append(escape(self.pending))
        self.pending = ""
        return "".join(self.out)

    def _attach(self, kind: str, part, tokens: int) -> None:
        self.finish()
        n = len(self.attachments)
        self.attachments.append((n, kind, part.get("ref") or "", tokens))
        self.out.append(f"<|{kind}:{n}|>")

    def visit_image(self, part) -> None:
        across, down = (math.ceil(max(0, part.get(k) or 0) / PATCH) for k in ("width", "height"))
        self._attach("image", part, across * down)

    def visit_audio(self, part) -> None:
        self._attach("audio", part, math.ceil(max(0, part.get("seconds") or 0) * AUDIO_RATE))

    def visit_document(self, part) -> None:
        self._attach("document", part, PAGE_TOKENS * max(0, part.get("pages") or 0))
        for p in part.get("parts") or []:
            self.visit(p)


def flatten(text: str | None, content: str | None = None) -> tuple[str, list[tuple[int, str, str, int]]]:
    """Escaped text with placeholders, and the attachments (place, kind, ref, tokens).
    ``content`` is a JSON list of parts and goes before ``text``."""
    f = Flattener()
    for part in json.loads(content) if content is not None else [text or ""]:
        f.visit(part)
    return f.finish(), f.attachments


def segment(role: str | None, body: str) -> tuple[str, int, int]:
    """The turn's segment and where the text under the loss mask starts and ends in it."""
    if role == "assistant":
        return f" {body} </s>", 1, 1 + len(body)
    if role == "user":
        return f"[INST] {body} [/INST]", 0, 0
    if role == "system":
        return f"<<SYS>> {body} <</SYS>>", 0, 0
    return f"[ROLE:{escape(role or '').replace(']', chr(92) + ']')}] {body} [/ROLE]", 0, 0


_OTHER = re.compile(r"\[ROLE:((?:[^\]\\]|\\.)*)\] (.*) \[/ROLE\]", re.S)


def parse(text: str) -> tuple[str, str]:
    """Role and body (escaped, with placeholders) of a segment."""
    for role, head, tail in (("user", "[INST] ", " [/INST]"), ("system", "<<SYS>> ", " <</SYS>>"), ("assistant", " ", " </s>")):
        if text.startswith(head) and text.endswith(tail):
            return role, text[len(head):len(text) - len(tail)]
    m = _OTHER.fullmatch(text)
    if not m:
        raise ValueError("not a segment")
    return unescape(m[1]), m[2]


SEGMENT = ("conv_id long, turn long, segment string, loss_start long, loss_end long, "
           "attachments array<struct<place:int,kind:string,ref:string,tokens:long>>, expanded_tokens long")
_ATTACHED = pa.list_(pa.struct([("place", pa.int32()), ("kind", pa.string()), ("ref", pa.string()), ("tokens", pa.int64())]))


def format_turns(turns: DataFrame) -> DataFrame:
    """One row a turn: its segment, the code points under the loss mask, its attachments and
    the tokens that they expand to. ``turns``: conv_id, turn, role, text and maybe content."""
    small_batches(turns.sparkSession)
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text",
                        F.col("content") if "content" in turns.columns else F.lit(None).cast("string").alias("content"))

    def run(batches):
        for b in batches:
            got = []
            for role, text, content in zip(*(b.column(i).to_pylist() for i in (2, 3, 4))):
                body, attached = flatten(text, content)
                got.append((*segment(role, body), [dict(zip(("place", "kind", "ref", "tokens"), a)) for a in attached], sum(a[3] for a in attached)))
            s, a, z, refs, tokens = zip(*got) if got else [()] * 5
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(s, pa.string()), pa.array(a, pa.int64()), pa.array(z, pa.int64()), pa.array(refs, _ATTACHED), pa.array(tokens, pa.int64())],
                                             ["conv_id", "turn", "segment", "loss_start", "loss_end", "attachments", "expanded_tokens"])

    return rows.mapInArrow(run, SEGMENT)


def read_back(segments: DataFrame) -> DataFrame:
    """Conversations read from their segments: conv_id, n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars, expanded_tokens."""
    small_batches(segments.sparkSession)

    def parsed(batches):
        for b in batches:
            role, text, loss = [], [], []
            for s, a, z in zip(*(b.column(i).to_pylist() for i in (2, 3, 4))):
                r, body = parse(s)
                role.append(r), text.append(unescape(body)), loss.append(unescape(s[a:z]) if z > a else "")
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(role, pa.string()), pa.array(text, pa.string()), pa.array(loss, pa.string()),
                                              pa.array(map(len, b.column(2).to_pylist()), pa.int64()), b.column(5)],
                                             ["conv_id", "turn", "role", "text", "loss", "chars", "expanded"])

    def digests(batches):
        key, state = None, None
        done: list = []

        def rows():
            cols = list(zip(*done))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
            batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                               ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "expanded_tokens"])
            done.clear()
            return batch

        def close():
            done.append((key, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4], state[5]))

        for b in batches:
            for conv, _, role, text, loss, chars, expanded in zip(*(c.to_pylist() for c in b.columns)):
                if state is None or conv != key:
                    if state is not None:
                        close()
                    key, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                state[2] += len(loss)
                state[3].update(loss.encode())
                state[4] += chars
                state[5] += expanded
            if done:
                yield rows()
        if state is not None:
            close()
            yield rows()

    rows = segments.select("conv_id", "turn", "segment", "loss_start", "loss_end", "expanded_tokens").mapInArrow(
        parsed, "conv_id long, turn long, role string, text string, loss string, chars long, expanded long")
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text"]
    return rows.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(
        digests, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, expanded_tokens long")


def format_conversations(turns: DataFrame) -> DataFrame:
    """Write the segments of ``turns`` to the shared folder and read the conversations back."""
    return read_back(stash(format_turns(turns), "chat-segments"))
