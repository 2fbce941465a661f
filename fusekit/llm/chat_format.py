"""Chat formatting by incremental black-box rendering.

A template is anything with ``render(turns) -> str``, ``escape`` and
``unescape``; the operator knows nothing else about it.  It renders each
prefix of a conversation and compares consecutive outputs: if the longer one
starts with the shorter one, what was added is the new turn's span; if not, the
template has rewritten history and the conversation is marked.  Inside the
span the turn's escaped text is looked up; where it does not stand there exactly
once, rendering the last turn with two different probes in its place shows which
part is framing (what both share at its ends), and the rest is the text.

A conversation is one row of the result, so its text is held by one task, and
its prefixes are rendered in turn: the work grows with the square of its
turns.  Conversations are spread by id and stream through a task one by one.

Defined cases: turns are ordered by turn (null first), then role, then text;
a null text or role is empty; rows with a null conversation id form one
conversation; repeated rows are turns of their own; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare

Turn = tuple[str, str]


class InstTemplate:
    """Turns in [INST] framing.  Control strings inside a text get a backslash
    after their opening sign (one more if backslashes stand there already), so
    that unescaping takes exactly one away."""

    _PLAIN = re.compile(r"(<<|<|\[)(\\*)(/?SYS>>|/?ROLE>>|/?s>|/?INST\])")
    _ESCAPED = re.compile(r"(<<|<|\[)(\\*)\\(/?SYS>>|/?ROLE>>|/?s>|/?INST\])")
    FRAMES = {"user": ("[INST] ", " [/INST]"), "assistant": (" ", " </s>"), "system": ("<<SYS>>\n", "\n<</SYS>>\n")}

    def escape(self, text: str) -> str:
        return _escaped(text) if "<" in text or "[" in text else text

    def unescape(self, text: str) -> str:
        return self._ESCAPED.sub(r"\1\2\3", text) if "\\" in text else text

    def frame(self, role: str) -> tuple[str, str]:
        return self.FRAMES.get(role) or (f"<<ROLE>>{self.escape(role)}<</ROLE>>", "</s>")

    def render(self, turns: list[Turn]) -> str:
        out = ["<s>"]
        for role, text in turns:
            before, after = self.frame(role)
            out += [before, self.escape(text), after]
        return "".join(out)

    def role_of(self, before: str, after: str) -> str:
        """The role that a turn's framing stands for."""
        before = before.removeprefix("<s>")
        for role, frame in self.FRAMES.items():
            if frame == (before, after):
                return role
        named = re.fullmatch(r"<<ROLE>>(.*)<</ROLE>>", before, re.S)
        if not named:
            raise ValueError(f"no turn has the framing {before!r} ... {after!r}")
        return self.unescape(named[1])


@functools.lru_cache(maxsize=512)
def _escaped(text: str) -> str:
    """Each turn is rendered again in every longer prefix; its escaping is not."""
    return InstTemplate._PLAIN.sub(r"\1\2\\\3", text)


#: Probe texts: private-use characters, so that no framing shares their ends.
PROBES = ("\ue000", "\ue001")


def _shared(a: str, b: str) -> int:
    """Characters that both start with."""
    return len(os.path.commonprefix([a, b]))


def spans(template, turns: list[Turn]) -> tuple[str, list[tuple[int, int, int, int]], list[int]]:
    """(output, spans, rewritten): for each turn (start, text start, text end,
    end) in the output, and the turns whose rendering changed what was
    rendered before them (their spans and all before are empty)."""
    before = template.render([])
    found, rewritten = [], []
    for n, (role, text) in enumerate(turns):
        head = turns[:n]
        after = template.render([*head, (role, text)])
        shown = template.escape(text)
        if shown and after.startswith(before) and after.count(shown, len(before)) == 1:
            lead = after.index(shown, len(before))
            tail = len(after) - lead - len(shown)
        else:  # the text is empty, or stands in its framing too, or was changed
            probe, other = (template.render([*head, (role, p)]) for p in PROBES)
            lead = _shared(probe, other)
            tail = _shared(probe[lead:][::-1], other[lead:][::-1])
        if not after.startswith(before) or lead > len(after) - tail:
            rewritten.append(n)
            found = [(0, 0, 0, 0)] * (n + 1)
        else:
            start = len(before) if n else 0
            found.append((start, lead, len(after) - tail, len(after)))
        before = after
    return before, found, rewritten


_OUT = "conv_id long, formatted string, spans array<struct<role:string,start:int,text_start:int,text_end:int,end:int>>, rewritten array<int>"


def _format(template):
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string
    schema = to_arrow_schema(_parse_datatype_string(_OUT))

    def one(conv, turns):
        text, found, rewritten = spans(template, turns)
        marks = [{"role": r, "start": a, "text_start": b, "text_end": c, "end": d} for (r, _), (a, b, c, d) in zip(turns, found)]
        return {"conv_id": conv, "formatted": text, "spans": marks, "rewritten": rewritten}

    def run(batches):
        conv, turns = None, []
        for batch in batches:
            done = []
            for c, role, text in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "role", "text"))):
                if turns and c != conv:
                    done.append(one(conv, turns))
                    turns = []
                conv = c
                turns.append((role, text))
                if len(done) == 256:
                    yield pa.RecordBatch.from_pylist(done, schema=schema)
                    done = []
            yield pa.RecordBatch.from_pylist(done, schema=schema)
        if turns:
            yield pa.RecordBatch.from_pylist([one(conv, turns)], schema=schema)
    return run


def format_chats(turns: DataFrame, template=None, conv_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: conv_id, formatted, spans (role and places of
    each turn) and rewritten (numbers of turns that changed history)."""
    prepare(turns.sparkSession)
    rows = turns.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"),
                        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return (rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .select("conv_id", "role", "text").mapInArrow(_format(template or InstTemplate()), _OUT))


def read_back(formatted: str, marks: list[dict], template=None) -> list[Turn]:
    """The turns that a formatted conversation says it holds."""
    template = template or InstTemplate()
    return [(template.role_of(formatted[m["start"]:m["text_start"]], formatted[m["text_end"]:m["end"]]),
             template.unescape(formatted[m["text_start"]:m["text_end"]])) for m in marks]


_DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, rewritten boolean"


def digests(chats: DataFrame, template=None) -> DataFrame:
    """Digests of the turns and of the text under the loss mask (assistant
    turns), read back from the rows of ``format_chats``."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string
    schema = to_arrow_schema(_parse_datatype_string(_DIGESTS))

    def one(row):
        if row["rewritten"]:
            return {"conv_id": row["conv_id"], "n_turns": len(row["spans"]), "formatted_chars": len(row["formatted"]), "rewritten": True}
        turns = read_back(row["formatted"], row["spans"], template)
        loss = "".join(t for r, t in turns if r == "assistant")
        whole = hashlib.sha256()
        for role, text in turns:
            whole.update(f"{role}\n{text}\n".encode())
        return {"conv_id": row["conv_id"], "n_turns": len(turns), "turns_sha256": whole.hexdigest(), "loss_chars": len(loss),
                "loss_sha256": hashlib.sha256(loss.encode()).hexdigest(), "formatted_chars": len(row["formatted"]), "rewritten": False}

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pylist([one(r) for r in batch.to_pylist()], schema=schema)

    return chats.mapInArrow(run, _DIGESTS)


ORACLE = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, length(regexp_replace(text, '(<<|<|\[)(\\*)(/?SYS>>|/?ROLE>>|/?s>|/?INST\])', '\1\2\\\3', 'g')) + CASE role
  WHEN 'user' THEN 15 WHEN 'assistant' THEN 6 WHEN 'system' THEN 18
  ELSE 21 + length(regexp_replace(role, '(<<|<|\[)(\\*)(/?SYS>>|/?ROLE>>|/?s>|/?INST\])', '\1\2\\\3', 'g')) END AS chars FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  (3 + sum(chars))::BIGINT AS formatted_chars, FALSE AS rewritten
FROM e GROUP BY conv_id
"""
