"""Byte-level BPE ids of many texts, with the tokenizers library and a bounded cache of chunks."""

from __future__ import annotations

import re
from array import array

import numpy as np

from commentscope.llm.common import tokenizer

#: Blank runs that the tokenizer may cut otherwise than at each single space.
_RUNS = re.compile(r"\s \s|  ")
_BLANKS = [" " + chr(c) for c in range(0x3001) if chr(c).isspace()]

#: Chunks that a worker remembers per table (about 100 MB); beyond that the table starts again.
CACHE_CHUNKS = 500_000
#: Characters of a chunk that is remembered, at most.
LONGEST = 64

_caches: dict[str, _Cache] = {}


def _bytes(ids: list[int]) -> bytes:
    return array("H", ids).tobytes()


def _byte_letters() -> dict[int, int]:
    """The letters by which a byte-level vocabulary writes bytes: printable ones as they are, the others from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: b for b in printable} | {b: 256 + i for i, b in enumerate(others)}


_LETTERS = _byte_letters()
#: Signs that may follow a word: the tokenizer always cuts between a letter and these, and keeps a run of them whole.
_SIGNS = ".,;:!?\"()[]{}*#%&$|<>"


class _Chunks(dict):
    """Ids of chunks that follow a space, or that start a line; a chunk is encoded when it is first asked for.

    What the tokenizer's cutting rules make of a Latin word and of signs after a letter or digit is known,
    so the library's model is asked for a word at once; other chunks are encoded by its pipeline.
    """

    def __init__(self, before: str, whole, signs: dict[str, bytes]):
        super().__init__()
        self.before, self.mark = before, "\u0120" if before else ""
        self.whole, self.model, self.signs = whole, whole.model, signs

    def encoded(self, s: str) -> bytes:
        return _bytes(self.whole.encode(s, add_special_tokens=False).ids)

    def __missing__(self, chunk: str) -> bytes:
        if chunk.isalpha():
            if chunk.isascii():
                ids = _bytes([t.id for t in self.model.tokenize(self.mark + chunk)])
            elif max(chunk) <= "\u024f":
                ids = _bytes([t.id for t in self.model.tokenize((self.before + chunk).encode().decode("latin-1").translate(_LETTERS))])
            else:
                ids = self.encoded(self.before + chunk)
        else:
            word = chunk.rstrip(_SIGNS)
            if len(word) < len(chunk) and word[-1:].isalnum():
                tail = chunk[len(word):]
                if tail not in self.signs:
                    self.signs[tail] = self.encoded(tail)
                ids = self[word] + self.signs[tail]
            else:
                ids = self.encoded(self.before + chunk) if self.before or chunk else b""
        if len(chunk) <= LONGEST:
            self[chunk] = ids
        return ids


class _Cache:
    def __init__(self, path: str):
        self.whole = tokenizer(path)
        if self.whole.get_vocab_size() > 1 << 16:
            raise ValueError("ids of this tokenizer need more than 16 bits")
        signs: dict[str, bytes] = {}
        self.first, self.later = (_Chunks(before, self.whole, signs) for before in ("", " "))
        self.line_end = self.first.encoded("\n")

    def bounded(self) -> None:
        for table in (self.first, self.later, self.first.signs):
            if len(table) > CACHE_CHUNKS:
                table.clear()


def _lines(text: str) -> list[list[str]] | None:
    """The chunks of each line; None for a text that has to be encoded as one piece. A line end is cut off
    on both sides when the next line starts with other than white space; else it stays in its chunk."""
    if "<|" in text or any(b in text for b in _BLANKS) and _RUNS.search(text):
        return None
    lines = text.split("\n")
    if any(not x or x[0].isspace() for x in lines[1:-1]) or len(lines) > 1 and lines[-1][:1].isspace():
        lines = [text]
    return [x.split(" ") for x in lines]


def encode_all(texts: list[str], path: str) -> list[np.ndarray]:
    """The ids of each whole text, without special tokens added, as unsigned 16-bit values.

    A byte-level BPE never joins a character other than white space with a space after it, nor with a line
    end between two such characters: the text is cut there, and a chunk is
    encoded when it is first met. Texts with runs of white space around a space, or with the marker of an added
    token, are encoded as one piece.
    """
    cache = _caches.get(path) or _caches.setdefault(path, _Cache(path))
    cache.bounded()
    cut = [_lines(t) for t in texts]
    first, later = cache.first, cache.later.__getitem__
    out = []
    for text, lines in zip(texts, cut):
        if lines is None:
            data = cache.first.encoded(text)
        else:
            data = cache.line_end.join([first[x[0]] + b"".join(map(later, x[1:])) for x in lines])
        out.append(np.frombuffer(data, "<u2"))
    return out
