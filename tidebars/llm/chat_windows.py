"""Chat formatting in budgeted windows.

A conversation becomes windows of whole turns. Prefix sums of the turns' tokens tell how far a window reaches; every window
after the first begins with the system turn and the last few turns before its own, as far as they fit in their share of the
budget. Loss lies on assistant turns, each in the one window that has it first; what a window repeats is masked.

Template, with control strings in texts escaped by a backslash, so that it can be read back:

    ### role:
    text
    </turn>
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidebars.llm.common import bounded_batches, name, tidy
from tidebars.llm.tokens import encoder

OPEN, CLOSE = "### ", "\n</turn>\n"
EXTRA = 8  # tokens of a turn's marks
_CONTROL = re.compile(r"\\|###|</turn>")
_ROLE_CONTROL = re.compile(r"\\|###|</turn>|:|\n")
_ESCAPED = re.compile(r"\\(\\|###|</turn>|:|\n)")
_TURN = re.compile(r"### ((?:[^\\:\n]|\\.)*+):\n((?:[^\\<]|\\.|<(?!/turn>))*+)</turn>\n", re.DOTALL)


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """A turn in the template, and where its text begins and ends in it."""
    head = OPEN + _ROLE_CONTROL.sub(lambda m: "\\" + m[0], role) + ":\n"
    body = escape(text)
    return head + body + CLOSE, len(head), len(head) + len(body)


def read_turns(text: str) -> list[tuple[str, str]]:
    """``role, text`` of each turn of a formatted window; anything else in it is an error."""
    out, at = [], 0
    while at < len(text):
        m = _TURN.match(text, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        out.append((unescape(m[1]), unescape(m[2][:-1])))
        at = m.end()
    return out


class _Windows:
    """The windows of one conversation, as its turns come."""

    def __init__(self, budget: int, history: int, share: float):
        self.budget, self.history, self.limit = budget, history, budget * share
        self.system: tuple | None = None
        self.number = self.seen = 0
        self.repeated: list[tuple] = []
        self.own: list[tuple] = []
        self.sums = [0]  # of the tokens of own turns; the first: of the repeated ones

    def add(self, role: str, text: str, tokens: int) -> tuple | None:
        """Take a turn; a window, if it had to be closed before."""
        turn, done = (role, text, tokens + EXTRA), None
        if self.own and self.sums[-1] + turn[2] > self.budget:
            done = self.close()
            before = ([self.system] if self.system else []) + self.tail
            while len(before) > bool(self.system) and sum(t[2] for t in before) + turn[2] > self.budget:
                before.pop(bool(self.system))
            self.repeated, self.own = before, []
            self.sums = [sum(t[2] for t in before)]
        if self.seen == 0 and role == "system":
            self.system = turn
        self.seen += 1
        self.own.append(turn)
        self.sums.append(self.sums[-1] + turn[2])
        return done

    def close(self) -> tuple:
        """The window so far: number, text, repeated turns, loss spans, tokens."""
        parts, spans, at = [], [], 0
        for k, (role, text, _) in enumerate(self.repeated + self.own):
            whole, begin, end = format_turn(role, text)
            if role == "assistant" and k >= len(self.repeated):
                spans.append({"start": at + begin, "end": at + end})
            parts.append(whole)
            at += len(whole)
        kept = [t for t in (self.repeated[1 if self.system and self.repeated else 0:] + self.own)[-self.history or len(self.own) + 99:]
                if t is not self.system]
        while kept and sum(t[2] for t in kept) > self.limit:
            kept.pop(0)
        self.tail = kept
        out = (self.number, "".join(parts), len(self.repeated), spans, self.sums[-1])
        self.number += 1
        return out


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def format_windows(turns: DataFrame, tokenizer: str, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                   text_col: str = "text", budget: int = 1024, history: int = 2, history_share: float = 0.25) -> DataFrame:
    """``id, window, text, n_repeated, loss, n_tokens``: the formatted windows of each conversation.

    ``loss`` are spans of ``text`` in code points; the first ``n_repeated`` turns of a window are repeats. Windows hold at most
    ``budget`` tokens unless a single turn and its system turn are longer: turns are never cut. ``history``: turns repeated at most,
    in ``history_share`` of the budget at most; a system turn counts as such when it comes first.

    Null roles and texts are empty. Turns come in order of ``turn_col`` (nulls first), equal ones by role and text, repeated
    rows one after the other. Rows of null id are one conversation. An empty table gives no rows; other columns are not read.

    Conversations are sorted, not gathered: a task keeps a window of the one at hand, so a single conversation may have any length.
    """
    bounded_batches(turns.sparkSession)
    rows = turns.select(
        name(id_col).alias("id"), name(turn_col).alias("turn"), F.coalesce(name(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(name(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.repartition("id").sortWithinPartitions("id", "turn", "role", "text").select("id", "role", "text")
    kind = rows.schema["id"].dataType.simpleString()

    @tidy
    def work(batches):
        conv, windows, key_type = None, None, None

        def batch_of(done: list) -> pa.RecordBatch:
            key, number, text, repeated, loss, tokens = zip(*done)
            return pa.RecordBatch.from_arrays(
                [pa.array(key, key_type), pa.array(number, pa.int64()), pa.array(text, pa.string()), pa.array(repeated, pa.int64()),
                 pa.array(loss, _SPANS), pa.array(tokens, pa.int64())],
                names=["id", "window", "text", "n_repeated", "loss", "n_tokens"])

        with encoder(tokenizer) as counter:
            for batch in batches:
                key_type, done = batch.column(0).type, []
                counts = [len(ids) - 1 for ids, _ in counter.ids(batch.column(2), 0)]
                for key, role, text, n in zip(*(c.to_pylist() for c in batch.columns), counts):
                    if windows is None or key != conv:
                        if windows is not None:
                            done.append((conv, *windows.close()))
                        conv, windows = key, _Windows(budget, history, history_share)
                    if (closed := windows.add(role, text, n)) is not None:
                        done.append((conv, *closed))
                if done:
                    yield batch_of(done)
            if windows is not None:
                yield batch_of([(conv, *windows.close())])

    schema = f"id {kind}, window bigint, text string, n_repeated bigint, loss array<struct<start:int,end:int>>, n_tokens bigint"
    return rows.mapInArrow(work, schema)


def read_back(windows: DataFrame) -> DataFrame:
    """Per conversation what its windows say: ``id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``.

    Turns are parsed from the texts and repeats skipped; ``turns_sha256`` is over role, newline, text, newline of each; loss is
    the text under the spans, without escapes.
    """
    rows = windows.select("id", "window", "text", "n_repeated", "loss").repartition("id").sortWithinPartitions("id", "window")
    kind = rows.schema["id"].dataType.simpleString()

    @tidy
    def work(batches):
        conv, state, key_type = None, None, None

        def batch_of(done: list) -> pa.RecordBatch:
            keys = pa.array([k for k, _ in done], key_type)
            cols = list(zip(*((s["n"], s["turns"].hexdigest(), s["chars"], s["loss"].hexdigest(), s["all"]) for _, s in done)))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays(
                [keys, *(pa.array(c, k) for c, k in zip(cols, kinds))],
                names=["id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        for batch in batches:
            key_type, done = batch.column(0).type, []
            for key, _, text, repeated, loss in zip(*(c.to_pylist() for c in batch.columns)):
                if state is None or key != conv:
                    if state is not None:
                        done.append((conv, state))
                    conv, state = key, {"n": 0, "turns": hashlib.sha256(), "chars": 0, "loss": hashlib.sha256(), "all": 0}
                for role, said in read_turns(text)[repeated:]:
                    state["n"] += 1
                    state["turns"].update(f"{role}\n{said}\n".encode())
                for span in loss:
                    learnt = unescape(text[span["start"]:span["end"]])
                    state["chars"] += len(learnt)
                    state["loss"].update(learnt.encode())
                state["all"] += len(text)
            if done:
                yield batch_of(done)
        if state is not None:
            yield batch_of([(conv, state)])

    return rows.mapInArrow(
        work, f"id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")
