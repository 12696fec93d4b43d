"""Ids of whole texts under a vocabulary of words with end marks, through a bounded cache of chunks."""

from __future__ import annotations

import re
from array import array

import numpy as np

from commentscope.llm.common import tokenizer
from commentscope.llm.tokens import _LETTERS

#: Blanks at which a text is cut. The tokenizer drops white space and joins nothing across it.
_BLANKS = re.compile("[ \t\n\r\x0b\x0c]+")
#: Signs after a word: a run of them is one piece of its own. The apostrophe is none: it may start a piece with letters.
_SIGNS = ".,;:!?\"()[]{}*#%&$|<>"
#: Up to here letters are written in one way only, so that composing leaves them alone.
_LAST = "\u024f"

#: Chunks that a worker remembers (about 150 MB); beyond that the table starts again.
CACHE_CHUNKS = 1_000_000
#: Characters of a chunk that is remembered, at most: texts without blanks are one chunk each.
LONGEST = 64

_caches: dict[str, _Cache] = {}


class _Cache(dict):
    """Ids of chunks; a chunk is encoded when it is first asked for. A word of plain letters goes to the
    library's model at once, in lower case; signs after it are looked up on their own; every other chunk goes
    through the library's whole pipeline."""

    def __init__(self, path: str):
        super().__init__()
        self.whole = tokenizer(path)
        if self.whole.get_vocab_size() > 1 << 16:
            raise ValueError("ids of this tokenizer need more than 16 bits")
        self.model = self.whole.model

    def __missing__(self, chunk: str) -> bytes:
        word = chunk.rstrip(_SIGNS)
        low = word.lower()
        if len(word) < len(chunk) and low[-1:].isalnum() and "<|" not in chunk and "|>" not in chunk:
            ids = self[word] + self[chunk[len(word):]]
        elif word == chunk and low.isalpha() and max(low) <= _LAST:
            written = low if low.isascii() else low.encode().decode("latin-1").translate(_LETTERS)
            ids = array("H", [t.id for t in self.model.tokenize(written)]).tobytes()
        else:
            ids = array("H", self.whole.encode(chunk, add_special_tokens=False).ids).tobytes()
        if len(chunk) <= LONGEST:
            self[chunk] = ids
        return ids


def encode_words(texts: list[str], path: str) -> list[np.ndarray]:
    """The ids of each whole text, without special tokens added, as unsigned 16-bit values."""
    cache = _caches.get(path) or _caches.setdefault(path, _Cache(path))
    if len(cache) > CACHE_CHUNKS:
        cache.clear()
    ids = cache.__getitem__
    return [np.frombuffer(b"".join(map(ids, _BLANKS.split(t))), "<u2") for t in texts]
