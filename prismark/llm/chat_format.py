"""Operator 12: training sequences from conversations, with an offset-aligned loss mask.

A whole conversation is rendered to one string, encoded once with offsets, and the
sorted character spans of the trained turns are intersected with the sorted token
spans by binary search.

Every turn is ``<|turn|>`` role ``<|text|>`` text ``<|end|>``.  The three marks are
added to the tokenizer as tokens of their own, after the vocabulary's last id, so a
token never crosses from a mark into a text and spans meet token borders exactly.
Inside roles and texts every ``<|``, also one that has backslashes between its two
signs, gets one more backslash (``<|`` to ``<\\|``, ``<\\|`` to ``<\\\\|``), so no
text holds a mark or another control string of that form, and reading takes the
backslash off again.

Rows are dealt by conversation and sorted by turn inside a task; a task reads them
as a stream and holds one block of conversations.  A conversation is one sequence
by definition, so it is the unit that has to fit; nothing else grows with the data.

Defined cases: null text and null role count as empty; rows with equal turns are
ordered by role, then text, a null turn comes first; repeated rows are turns of their
own; rows with a null conversation form one conversation with a null id; a
conversation without a trained turn has an empty mask; an empty text of a trained
turn trains nothing; an empty table gives no rows; other columns, whatever their names,
are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, functions as F

from prismark.llm.runtime import worker_cached

#: The marks of a turn: before the role, between role and text, after the text.
MARKS = ("<|turn|>", "<|text|>", "<|end|>")
#: Characters of rendered text that are encoded at once.
CALL_CHARS = 1 << 21

_OPENS = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")

OUTPUT = "conv_id {id}, n_turns long, formatted string, input_ids binary, loss_mask binary"


def escape(text: str) -> str:
    """Reversible: no ``<|`` is left in the result."""
    return _OPENS.sub(r"<\\\1|", text) if "|" in text else text


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text) if "|" in text else text


def render(turns: list[tuple[str, str]], trained: frozenset[str]) -> tuple[str, list[tuple[int, int]]]:
    """The string of a conversation and the sorted spans (start, end) of the texts of trained roles."""
    turn, text, end = MARKS
    out, spans, at = [], [], 0
    for role, said in turns:
        said = escape(said)
        head = f"{turn}{escape(role)}{text}"
        if role in trained and said:
            spans.append((at + len(head), at + len(head) + len(said)))
        out += (head, said, end)
        at += len(head) + len(said) + len(end)
    return "".join(out), spans


def chat_tokenizer(path: str):
    """The vocabulary at ``path`` with the marks as further tokens; one per worker."""

    def build():
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import AddedToken, Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.add_special_tokens([AddedToken(m, normalized=False, special=True) for m in MARKS])
        return tokenizer

    return worker_cached(("chat_tokenizer", path), build)


def loss_mask(offsets, spans):
    """One byte a token: 1 where the token lies in a span.  Both are sorted, so each border is a binary search."""
    import numpy as np

    mask = np.zeros(len(offsets), np.uint8)
    if spans:
        starts, ends = np.asarray(offsets, np.int64).reshape(-1, 2).T
        cuts = np.asarray(spans, np.int64)
        # tokens of one character that is cut into bytes share its span
        first = np.searchsorted(starts, cuts[:, 0], "left")
        last = np.searchsorted(starts, cuts[:, 1], "left")
        if (starts[first] != cuts[:, 0]).any() or (ends[last - 1] != cuts[:, 1]).any():
            raise ValueError("a turn does not begin and end at token borders")
        for a, b in zip(first.tolist(), last.tolist()):
            mask[a:b] = 1
    return mask


def _formatter(path: str, trained: frozenset[str], id_type: str):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        tokenizer = chat_tokenizer(path)
        ids, counts, texts, spans = [], [], [], []
        held = 0

        def emitted():
            got = tokenizer.encode_batch(texts, add_special_tokens=False)
            columns = [
                pa.array(ids, id_type), pa.array(counts, pa.int64()), pa.array(texts, pa.string()),
                pa.array([np.array(e.ids, "<u4").tobytes() for e in got], pa.binary()),
                pa.array([loss_mask(e.offsets, s).tobytes() for e, s in zip(got, spans)], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(columns, ["conv_id", "n_turns", "formatted", "input_ids", "loss_mask"])

        def close():
            text, cuts = render(turns, trained)
            ids.append(conv)
            counts.append(len(turns))
            texts.append(text)
            spans.append(cuts)
            return len(text)

        turns, conv = [], None
        for batch in batches:
            for one, role, said in zip(*(c.to_pylist() for c in batch.columns)):
                if turns and one != conv:
                    held += close()
                    turns = []
                    if held > CALL_CHARS:
                        yield emitted()
                        ids, counts, texts, spans = [], [], [], []
                        held = 0
                conv = one
                turns.append((role, said))
        if turns:
            close()
            yield emitted()

    return run


def format_chats(
    conversations: DataFrame,
    path: str,
    trained_roles: tuple[str, ...] = ("assistant",),
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """One row per conversation: ``formatted`` text, ``input_ids`` (little-endian unsigned 32-bit) and ``loss_mask``.

    ``loss_mask`` has one byte per token, 1 where the token is trained on: the texts of ``trained_roles``.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    kind = conversations.schema[id_col].dataType
    rows = conversations.select(
        F.col(id_col).alias("conv_id"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    return dealt.mapInArrow(
        _formatter(path, frozenset(trained_roles), to_arrow_type(kind)), OUTPUT.format(id=kind.simpleString())
    )


def token_bytes(path: str) -> list[bytes]:
    """The bytes of each id, marks included."""
    from prismark.llm.tokens import _byte_letters

    tokenizer = chat_tokenizer(path)
    back = {ord(c): b for b, c in _byte_letters().items()}
    table = [b""] * tokenizer.get_vocab_size(with_added_tokens=True)
    for token, k in tokenizer.get_vocab(with_added_tokens=True).items():
        table[k] = token.encode() if token in MARKS or not set(map(ord, token)) <= back.keys() else bytes(back[ord(c)] for c in token)
    return table


def read_back(input_ids: bytes, mask: bytes, table: list[bytes]) -> tuple[str, list[tuple[str, str]], list[str]]:
    """From the stored tokens alone: the formatted text, its turns, and the texts under the mask."""
    import numpy as np

    pieces = [table[k] for k in np.frombuffer(input_ids, "<u4").tolist()]
    formatted = b"".join(pieces).decode()
    turn, text, end = MARKS
    turns = []
    for part in formatted.split(turn)[1:]:
        role, said = part.split(text)
        turns.append((unescape(role), unescape(said.removesuffix(end))))
    edges = np.flatnonzero(np.diff(np.frombuffer(b"\0" + mask + b"\0", np.uint8)))
    trained = [unescape(b"".join(pieces[a:b]).decode()) for a, b in zip(edges[::2].tolist(), edges[1::2].tolist())]
    return formatted, turns, trained


def _reader(path: str):
    def run(batches):
        import hashlib

        import pyarrow as pa

        table = worker_cached(("token_bytes", path), lambda: token_bytes(path))
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        for batch in batches:
            out = []
            for ids, mask in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                formatted, turns, trained = read_back(ids, mask, table)
                said, learned = "".join(f"{r}\n{t}\n" for r, t in turns), "".join(trained)
                digests = (hashlib.sha256(x.encode()).hexdigest() for x in (said, learned))
                out.append((len(turns), next(digests), len(learned), next(digests), len(formatted)))
            n, a, b, c, d = zip(*out) if out else ((),) * 5
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, (n, a, b, c, d), kinds)], names)

    return run


def summary(formatted: DataFrame, path: str) -> DataFrame:
    """Digests per conversation, read back from ``input_ids`` and ``loss_mask``."""
    kind = formatted.schema["conv_id"].dataType.simpleString()
    return formatted.select("conv_id", "input_ids", "loss_mask").mapInArrow(
        _reader(path),
        f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )


ORACLE_SQL = r"""
with c as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e as (select *, regexp_replace(role, '<(\\*)\|', '<\\\1|', 'g') as er, regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') as et from c)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  sum(case when role = 'assistant' then length(text) else 0 end)::bigint as loss_chars,
  sha256(coalesce(string_agg(case when role = 'assistant' then text end, '' order by turn nulls first, role, text), '')) as loss_sha256,
  sum(length('<|turn|><|text|><|end|>') + length(er) + length(et))::bigint as formatted_chars
from e group by conv_id
"""
