"""Exact byte-level BPE encoding of whole columns of texts.

The split pattern of byte-level BPE never lets a match cross from one
space-separated piece into the next: a match is an optional single space and a
run of letters, digits or other signs, and a lone line break is a match of its
own.  A text without two neighbouring white-space characters can therefore be
cut before every space and around every line break.  Pieces repeat, so a batch
is dictionary-encoded with Arrow, only its different pieces are looked at in
Python, and the ids are laid out by Arrow.  Texts with neighbouring
white-space characters are split by the pattern as a whole; texts that spell a
special token of the vocabulary go to the library as a whole.
"""

from __future__ import annotations

import struct

import numpy as np

from prismark.llm.runtime import worker_cached

#: Matches and pieces kept per worker before the cache starts anew (about 200 bytes each).
CACHE_MATCHES = 700_000
#: Longer pieces are encoded each time they occur.
LONG_PIECE = 64
#: Characters of text that are laid out at once.
CALL_CHARS = 1 << 23


def white_space_pattern(pattern: str) -> str:
    """The split pattern for the ``regex`` module with Unicode's white space, as the tokenizer libraries read it."""
    return pattern.replace(r"\S", r"\P{White_Space}").replace(r"\s", r"\p{White_Space}")


class BatchEncoder:
    """Texts to ids; ``encode_match`` gives the ids of one match of the split pattern.

    Texts that hold one of ``marks`` (tokens that the library looks for before it
    splits) are given to ``encode_whole`` as they are.
    """

    def __init__(self, encode_match, pattern: str, cache_matches: int = CACHE_MATCHES, marks=(), encode_whole=None):
        import regex

        self.encode_match, self.marks, self.encode_whole = encode_match, marks, encode_whole
        self.find = regex.compile(white_space_pattern(pattern)).findall
        self.cache_matches = cache_matches
        self.matches: dict[str, bytes] = {}

    def _split(self, text: str) -> list[str]:
        """The matches of the split pattern; the two commonest shapes without a search."""
        core = text[1:] if text[:1] == " " else text
        if core.isalpha():
            return [text]
        if core[-1:] in (".", ",") and core[:-1].isalpha():
            return [text[:-1], text[-1]]
        return self.find(text)

    def piece(self, text: str) -> bytes:
        """Ids (little-endian, 32 bits) of any text, match by match."""
        known = self.matches
        if (one := known.get(text)) is not None:
            return one
        if len(text) <= LONG_PIECE and text.lstrip(" ").isalpha() and text[1:2] != " ":  # one match
            got = self.encode_match(text)
            ids = known[text] = struct.pack(f"<{len(got)}I", *got)
            return ids
        out = []
        for m in self._split(text):
            ids = known.get(m)
            if ids is None:
                got = self.encode_match(m)
                ids = known[m] = struct.pack(f"<{len(got)}I", *got)
            out.append(ids)
        ids = b"".join(out)
        if len(text) <= LONG_PIECE:
            known[text] = ids
        return ids

    def _whole(self, text: str) -> bytes:
        if any(m in text for m in self.marks):
            return np.array(self.encode_whole(text), "<u4").tobytes()
        return self.piece(text)

    def _plain(self, texts):
        """Which texts have no two neighbouring white-space characters and no mark (never true for one that has)."""
        import pyarrow.compute as pc

        odd = pc.match_substring_regex(texts, "[\\x{fffe}\\x{ffff}\\x00\\t\\x0b-\\r\\x1c-\\x1f\\x85\\xa0\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]")
        for two in ("  ", " \n", "\n ", "\n\n", *self.marks):
            odd = pc.or_(odd, pc.match_substring(texts, two))
        return pc.invert(odd)

    def _block(self, texts) -> tuple[np.ndarray, np.ndarray]:
        import pyarrow as pa
        import pyarrow.compute as pc

        arr = pa.array(texts, pa.large_string())
        plain = self._plain(arr)
        marked = pc.replace_substring(pc.replace_substring(arr, "\n", "\0\n\0"), " ", "\0 ")
        # a text that cannot be cut stays one piece; no plain text is equal to it, as none holds U+FFFE or U+FFFF
        pieces = pc.split_pattern(pc.if_else(plain, marked, pc.replace_substring(arr, "\0", "￾￿")), "\0")
        whole = {}
        for k in np.flatnonzero(~plain.to_numpy(zero_copy_only=False)).tolist():
            whole[k] = self._whole(texts[k])
        coded = pieces.flatten().dictionary_encode()
        codes = coded.indices.to_numpy()
        offsets = pieces.offsets.to_numpy()
        words = coded.dictionary.to_pylist()
        parts = list(map(self.matches.get, words))
        for i in () if not whole else set(codes[offsets[list(whole)]].tolist()):
            parts[i] = b""
        for i in [i for i, ids in enumerate(parts) if ids is None]:
            parts[i] = self.piece(words[i])
        bounds = np.zeros(len(parts) + 1, np.int64)
        np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) // 4, out=bounds[1:])
        base = pa.LargeListArray.from_arrays(bounds, pa.array(np.frombuffer(b"".join(parts), "<u4")))
        laid = base.take(coded.indices)
        ids = laid.flatten().to_numpy()
        ends = laid.offsets.to_numpy()[offsets]
        if whole:  # put the texts that stayed whole in their places
            rows = [ids[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
            for k, raw in whole.items():
                rows[k] = np.frombuffer(raw, "<u4")
            ids = np.concatenate(rows) if rows else ids
            ends = np.concatenate(([0], np.cumsum([len(r) for r in rows])))
        return ids, ends

    def encode(self, texts) -> list[np.ndarray]:
        """An array of unsigned 32-bit ids per text; null counts as empty."""
        out, block, size = [], [], 0
        for k, text in enumerate(texts):
            block.append(text or "")
            size += len(block[-1])
            if size >= CALL_CHARS or k == len(texts) - 1:
                ids, ends = self._block(block)
                out += np.split(ids, ends[1:-1]) if len(block) > 1 else [ids]
                block, size = [], 0
                if len(self.matches) > self.cache_matches:
                    self.matches = {}
        return out


def _byte_letters() -> dict[int, str]:
    """Byte value to the character that stands for it in a byte-level vocabulary file."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


def library_encoder(path: str, cache_matches: int = CACHE_MATCHES) -> BatchEncoder:
    """Encoder whose matches are encoded by the ``tokenizers`` library's model of a byte-level BPE file."""

    def build():
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        model, letters = tokenizer.model, _byte_letters()
        space = letters[32]

        def encode_match(text: str) -> list[int]:
            if text.isascii() and text.isprintable():
                return [t.id for t in model.tokenize(text.replace(" ", space))]
            return [t.id for t in model.tokenize(text.encode().decode("latin-1").translate(letters))]

        marks = tuple(t.content for t in tokenizer.get_added_tokens_decoder().values())
        return BatchEncoder(
            encode_match, public_tokenizers.PATTERN, cache_matches, marks,
            lambda text: tokenizer.encode(text, add_special_tokens=False).ids,
        )

    return worker_cached(("library_encoder", path, cache_matches), build)
