"""Chat formatting by incremental black-box rendering."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salvor.llm.common import arrow_batches, table

Turn = tuple[str, str]
PROBE = (-7, r"\### Assistant: </turn> ok")
_CONTROL = re.compile(r"\\|### |</turn>")
_ESCAPED = re.compile(r"\\(\\|### |</turn>|:)")
_TURN = re.compile(r"### ((?:[^\\:]|\\.)*): ((?:[^\\<]|\\.|<(?!/turn>))*)</turn>\n", re.S)


class TurnTemplate:
    """``### role: text</turn>`` for each turn. A backslash stands before each control string and
    backslash inside a text, so texts are read back exactly."""

    def render(self, turns: list[Turn]) -> str:
        return "".join(f"### {self.escape(role).replace(':', chr(92) + ':')}: {self.escape(text)}</turn>\n" for role, text in turns)

    def escape(self, text: str) -> str:
        return _CONTROL.sub(lambda m: "\\" + m[0], text)

    def unescape(self, text: str) -> str:
        return _ESCAPED.sub(lambda m: m[1], text)

    def parse(self, out: str) -> list[Turn]:
        turns, at = [], 0
        while at < len(out):
            m = _TURN.match(out, at)
            if not m:
                raise ValueError(f"no turn at {at}")
            turns.append((self.unescape(m[1]), self.unescape(m[2])))
            at = m.end()
        return turns


#: Private-use characters, from which a mark is taken.
_PRIVATE = (range(0xE000, 0xF900), range(0xF0000, 0xFFFFE), range(0x100000, 0x10FFFE))


def _mark(texts: list[str]) -> str:
    """A string that none of the texts has, to be found again in a rendering: a private-use
    character, or a longer run of one than any text has where they hold them all."""
    used = set().union(*texts)
    free = next((chr(c) for part in _PRIVATE for c in part if chr(c) not in used), None)
    first = chr(_PRIVATE[0][0])
    return free or first * (1 + max(len(run) for t in texts for run in re.findall(f"{first}*", t)))


def spans(turns: list[Turn], render: Callable[[list[Turn]], str]) -> tuple[str, list[tuple[int, int, int, int] | None], bool]:
    """Render ``turns`` with a black box. Returns the output; for each turn its span and its
    text's span in it, or None where it can't be told; and whether the template rewrites history.

    Successive prefixes are rendered. While each output begins with the one before, the added
    part is the turn's span; its text lies where a mark in its place shows. A template that
    changes what it wrote for earlier turns is told by an output that doesn't; then each text is
    located in the whole output by a mark, and turns have no span beyond it.
    """
    mark = _mark([x for t in turns for x in t] + [""])

    def place(marked: str, whole: str, start: int) -> tuple[int, int] | None:
        """Where the text lies in ``whole`` whose mark is in ``marked``; None unless it stands there
        once and all around it is alike."""
        head, tail = marked.find(mark, start), len(marked) - marked.find(mark, start) - len(mark)
        alike = head >= 0 and marked.rfind(mark) == head and head + tail <= len(whole)
        return (head, len(whole) - tail) if alike and whole.startswith(marked[:head]) and whole.endswith(marked[head + len(mark) :]) else None

    before, out, found, rewrites = render([]), render(turns), [], False
    for k, (role, _) in enumerate(turns):
        now = out if k + 1 == len(turns) else render(turns[: k + 1])
        marked = render([*turns[:k], (role, mark)])
        if not now.startswith(before) or not marked.startswith(before):
            rewrites = True
            break
        at = place(marked, now, len(before))
        found.append((len(before), len(now), *at) if at else None)
        before = now
    if rewrites:
        at = [place(render([*turns[:k], (role, mark), *turns[k + 1 :]]), out, 0) for k, (role, _) in enumerate(turns)]
        found = [(*x, *x) if x else None for x in at]
    return out, found, rewrites


def formatted(conversations: DataFrame, template=None) -> DataFrame:
    """One row per conversation: conv_id, n_turns, its formatted text, the spans of its turns
    (role, start, end, text_start, text_end; in code points) and whether the template rewrites
    history.

    Turns stand in the order of turn (null first), then role and text; null role and text are
    empty; repeated rows are turns of their own; a null conv_id is a conversation; an empty
    table gives no rows. A conversation is rendered in one task, whose memory it must fit, as
    its turns must fit the model that reads it.
    """
    arrow_batches(conversations.sparkSession)
    template = template or TurnTemplate()
    text = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    turns = F.array_sort(F.collect_list(F.struct("turn", text("role"), text("text"))))
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").groupBy("conv_id").agg(turns.alias("turns"))
    span = pa.struct([("role", pa.string())] + [(x, pa.int64()) for x in ("start", "end", "text_start", "text_end")])
    schema = "conv_id long, n_turns long, formatted string, spans array<struct<role: string, start: long, end: long, text_start: long, text_end: long>>, rewrites boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [[], [], [], []]
            for value in batch.column(1):
                own = [(t["role"], t["text"]) for t in value.as_py()]
                out, found, rewrites = spans(own, template.render)
                told = [dict(zip(("role", "start", "end", "text_start", "text_end"), (r, *(s or (None,) * 4)), strict=True)) for (r, _), s in zip(own, found, strict=True)]
                for c, x in zip(cols, (len(own), out, told, rewrites), strict=True):
                    c.append(x)
            types = (pa.int64(), pa.string(), pa.list_(span), pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))], ["conv_id", "n_turns", "formatted", "spans", "rewrites"])

    return rows.mapInArrow(run, schema)


def digests(out: DataFrame, template=None, trained: str = "assistant") -> DataFrame:
    """Read formatted conversations back: their turns from the text, and what the loss mask (the
    text spans of ``trained`` turns) covers, as digests. A turn whose place in the output is
    unknown masks nothing; ``unlocated`` counts such ``trained`` turns. Rows are those of
    ``formatted``, so nulls are empty there already; an empty table gives no rows; a text that
    the template can't read has null for n_turns and turns_sha256."""
    template = template or TurnTemplate()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, told in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                try:
                    turns = template.parse(text)
                    read = len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
                except ValueError:
                    read = None, None
                own = [s for s in told if s["role"] == trained]
                loss = "".join(template.unescape(text[s["text_start"] : s["text_end"]]) for s in own if s["text_start"] is not None)
                rows.append((*read, len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text), sum(s["text_start"] is None for s in own)))
            names = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "unlocated"]
            types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            cols = list(zip(*rows, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))], ["conv_id", *names])

    return out.select("conv_id", "formatted", "spans").mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, unlocated long")


def op3_chat_rendering(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    conv, text = PROBE
    probe = spark.createDataFrame([(conv, 0, "user", text), (conv, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    return digests(formatted(rows.unionByName(probe)))


#: formatted_chars: "### ", ": ", "</turn>" and a line end for each turn, and a backslash for each escape.
ORACLE = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(14 + length(role) + length(text) + len(regexp_extract_all(role || ' ' || text, '\\|### |</turn>')) + len(regexp_extract_all(role, ':'))) AS BIGINT) AS formatted_chars,
       CAST(0 AS BIGINT) AS unlocated
FROM t GROUP BY conv_id
"""
