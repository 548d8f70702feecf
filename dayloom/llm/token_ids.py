"""Token ids of whole texts by the tokenizers library, each distinct word merged once per Python worker.

A byte-level BPE splits a text into words before it merges, and a single space between two non-blank characters
always starts a new word. So a text can be cut at such spaces and the ids of the parts joined: the result is the
library's own for the whole text. Parts repeat: texts are encoded in blocks of about ``BLOCK`` characters, Arrow names the
distinct parts of a block, and only those are looked up; numpy lays their ids out by text. A worker keeps the ids of parts it
has met, up to ``MAX_KEPT`` of them (a third as many single words) and ``LONGEST_KEPT`` characters; others are computed once a
block. ``let_go`` empties what is kept, for stages that run in the same workers later.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MAX_KEPT = 300_000
BLOCK = 8_000_000  # characters encoded at once; a longer text is a block of its own
LONGEST_KEPT = 14  # characters; longer parts seldom come again
_CUT = re.compile(r"(?<=\S) (?=\S)")
_CLOSING = frozenset(".,;:!?")
_LATIN_END = "\u0250"  # letters below it are letters to every version of Unicode
# a byte-level vocabulary spells bytes that do not print as the characters from U+0100 on, in order
_SILENT = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174)]
_SPELLED = {b: 256 + i for i, b in enumerate(_SILENT)}
_ENCODERS: dict[str, Encoder] = {}


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def piece_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def let_go() -> None:
    """Drop the encoders of this worker, and with them the ids they keep."""
    _ENCODERS.clear()


def _spelled(part: str) -> str:
    """A word of Latin letters as the vocabulary spells it; empty for anything else."""
    if not part.isalpha():
        return ""
    if part.isascii():
        return part
    return part.encode().decode("latin-1").translate(_SPELLED) if max(part) < _LATIN_END else ""


class _Words(dict):
    """Ids of a word as the library's own splitter writes it."""

    def __init__(self, owner: Encoder) -> None:
        self.merge, self.pack = owner.merge, owner.pack

    def __missing__(self, word: str) -> bytes:
        ids = self.pack([t.id for t in self.merge(word)])
        if len(self) < MAX_KEPT // 3:
            self[word] = ids
        return ids


class _Parts(dict):
    """Ids of what stands between two cuts, with the space before it."""

    def __init__(self, owner: Encoder) -> None:
        self.owner, self.words = owner, owner.words
        self.merge, self.pack = owner.merge, owner.pack

    def __missing__(self, part: str) -> bytes:
        spelled = _spelled(part)
        if spelled:
            ids = self.pack([t.id for t in self.merge("Ġ" + spelled)])
        elif part[-1:] in _CLOSING and part[:-1].isalpha():
            return self[part[:-1]] + self.words[part[-1]]  # two look-ups; not kept a second time
        else:
            line, _, rest = part.partition("\n")
            spelled = _spelled(rest)
            if spelled and line and not line[-1].isspace():  # the end of a line between two words
                return self[line] + self.words["Ċ"] + self.words[spelled]
            ids = self.owner.split(" " + part)
        if len(part) <= LONGEST_KEPT and len(self) < MAX_KEPT:
            self[part] = ids
        return ids


class Encoder:
    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        self._code = "H" if self.dtype.itemsize == 2 else "I"
        self._added = [str(t) for t in self.library.get_added_tokens_decoder().values()]
        self.merge = self.library.model.tokenize
        self.words = _Words(self)
        self.parts = _Parts(self)

    def pack(self, ids: list[int]) -> bytes:
        return array(self._code, ids).tobytes()

    def split(self, text: str) -> bytes:
        if any(a in text for a in self._added):
            return self.pack(self.library.encode(text, add_special_tokens=False).ids)
        return b"".join([self.words[w] for w, _ in self.library.pre_tokenizer.pre_tokenize_str(text)])

    def encode(self, text: str) -> bytes:
        """The ids of a text as packed little-endian ``dtype``."""
        parts = _CUT.split(text) if _has_odd_blanks(text) else text.split(" ")
        return self.split(parts[0]) + b"".join(map(self.parts.__getitem__, parts[1:]))

    def encode_all(self, texts: Iterable[str]) -> Iterator[bytes]:
        """``encode`` of each text, in order."""
        block: list[str] = []
        size = 0
        for text in texts:
            if block and size + len(text) > BLOCK:
                yield from self._block(block)
                block, size = [], 0
            block.append(text)
            size += len(text)
        if block:
            yield from self._block(block)

    def _block(self, texts: list[str]) -> Iterator[bytes]:
        split = pc.split_pattern(pa.array(texts, pa.string()), " ")
        named = split.values.dictionary_encode()
        part, parts = named.indices.to_numpy(), named.dictionary.to_numpy(zero_copy_only=False).tolist()
        odd = np.fromiter((not p or p[0].isspace() or p[-1].isspace() for p in parts), bool, len(parts))
        ends = split.offsets.to_numpy()
        firsts = ends[:-1]
        # the first part has no space before it; texts with odd blanks are cut otherwise
        alone = np.add.reduceat(odd[part], firsts) > 0
        inner = np.ones(len(part), bool)
        inner[firsts] = False
        inner &= ~np.repeat(alone, np.diff(ends))
        wanted = np.zeros(len(parts), bool)
        wanted[part[inner]] = True
        ids = [self.parts[p] if w else b"" for p, w in zip(parts, wanted.tolist())]
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // self.dtype.itemsize
        starts = np.cumsum(lengths) - lengths
        known = np.frombuffer(b"".join(ids), self.dtype)
        n = np.where(inner, lengths[part], 0)
        after = np.concatenate(([0], np.cumsum(n)))[ends]
        del split, named, ids, odd, inner, wanted
        for i, text in enumerate(texts):
            if alone[i]:
                yield self.encode(text)
                continue
            mine = slice(ends[i], ends[i + 1])
            shift = np.cumsum(n[mine]) - n[mine]
            at = np.repeat(starts[part[mine]] - shift, n[mine]) + np.arange(after[i + 1] - after[i])
            yield self.split(parts[part[ends[i]]]) + known[at].tobytes()

    def ids(self, text: str) -> np.ndarray:
        return np.frombuffer(self.encode(text), self.dtype)


def _has_odd_blanks(text: str) -> bool:
    """Whether some space has a blank or an end of the text beside it."""
    if text[:1] == " " or text[-1:] == " " or "  " in text:
        return True
    if text.isascii() and not any(c in text for c in "\t\r\x0b\x0c\x1c\x1d\x1e\x1f"):
        return " \n" in text or "\n " in text
    return _BESIDE.search(text) is not None


_BESIDE = re.compile(r" \s|(?<=\s) ")
