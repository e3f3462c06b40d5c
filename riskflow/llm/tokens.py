"""Exact and fast encoding of whole texts with the byte-level BPE vocabulary of the tokenizers library.

The library cuts a text into pre-tokens and merges inside each alone. A text is cut here at places that are certain
to be edges of pre-tokens, equal pieces of a slice are put together, and the library encodes each distinct piece once;
a bounded cache keeps pieces over slices. Ids are the same as those of `encode` on the whole text.
"""

from __future__ import annotations

import os
from itertools import repeat

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

import numpy as np  # noqa: E402
import public_tokenizers  # noqa: E402
import pyarrow as pa  # noqa: E402
import regex  # noqa: E402
from tokenizers import Tokenizer, pre_tokenizers  # noqa: E402

from riskflow.llm.common import text_bytes  # noqa: E402

VOCABULARY = "byte_bpe_50k.json"
MAX_CACHED = 400_000
# Up to this letter all Unicode versions agree on what is a letter, a digit or white space.
LAST_PLAIN = "\u024f"
# The model's letter for a space.
SPACE = "\u0120"

_SPACE, _BREAK, _LETTER, _DIGIT, _MARK, _QUOTE, _OTHER = range(7)


def _byte_kinds() -> np.ndarray:
    kinds = np.full(256, _OTHER, np.uint8)
    kinds[0x21:0x7F] = _MARK
    kinds[0x27] = _QUOTE
    kinds[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = _LETTER
    kinds[0x30:0x3A] = _DIGIT
    kinds[0x0A] = _BREAK
    kinds[0x20] = _SPACE
    return kinds


def _edge_rule() -> np.ndarray:
    """For the kinds of a byte and the next: is the place between them certain to be an edge of pre-tokens?"""
    rule = np.zeros((7, 7), bool)
    rule[[_LETTER, _DIGIT, _MARK, _QUOTE], _SPACE] = True  # a run of white space starts
    rule[[_LETTER, _DIGIT, _MARK, _QUOTE], _BREAK] = True
    rule[[_LETTER, _DIGIT], _MARK] = True
    rule[_LETTER, _QUOTE] = rule[_DIGIT, _QUOTE] = True
    rule[_MARK, [_LETTER, _DIGIT]] = True  # after ' a contraction may go on
    rule[_LETTER, _DIGIT] = rule[_DIGIT, _LETTER] = True
    return rule


_VISIBLE = np.array([k in (_LETTER, _DIGIT, _MARK, _QUOTE) for k in range(7)])
_KINDS, _EDGES = _byte_kinds(), _edge_rule().ravel()


class Encoder:
    """Encodes slices of texts. One per Python worker; see `encoder`."""

    def __init__(self, path: str) -> None:
        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        # The 256 characters that stand for bytes inside the model, in the library's own mapping.
        self.letters = {i: self._letter(i) for i in range(256)}
        self.cache: dict[str, int] = {}
        self.flat, self.lengths, self.size = np.zeros(1 << 16, np.uint32), np.zeros(1 << 14, np.int32), 0
        self.starts = np.zeros(1 << 14, np.int64)

    @staticmethod
    def _letter(value: int) -> str:
        """The character for a byte: itself where it is printable Latin-1, else the next free one from U+0100 on."""
        printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        return chr(value) if value in printable else chr(0x100 + value - sum(p < value for p in printable))

    def piece(self, text: str) -> list[int]:
        """The ids of one piece. Pieces with rarer characters go through the library's own cuts."""
        core = text[1:] if text[0] == " " else text
        if core.isalpha() and len(text) <= 64 and max(core) <= LAST_PLAIN:
            words = [text]
        elif max(text) > LAST_PLAIN or len(text) > 64 or ("<" in text and any(s in text for s in self.special)):
            return self.library.encode(text, add_special_tokens=False).ids
        else:
            words = self.pattern.findall(text)
        ids: list[int] = []
        for word in words:
            spelled = word.replace(" ", SPACE) if word.isascii() and word.isprintable() else word.encode().decode("latin-1").translate(self.letters)
            ids += [t.id for t in self.model.tokenize(spelled)]
        return ids

    def _add(self, words: list[str]) -> None:
        """Encode new pieces and keep their ids. Plain words are spelled all at once; each goes through the model alone."""
        plain = [w for w in words if w.isascii() and len(w) <= 64 and (w.isalpha() or (w[0] == " " and w[1:].isalpha()))]
        tokenize, ids, sizes = self.model.tokenize, [], []
        for spelled in "\n".join(plain).replace(" ", SPACE).split("\n") if plain else ():
            tokens = tokenize(spelled)
            sizes.append(len(tokens))
            ids += [t.id for t in tokens]
        if len(plain) < len(words):
            done = set(plain)
            rest = [w for w in words if w not in done]
            for word in rest:
                own = self.piece(word)
                sizes.append(len(own))
                ids += own
            plain += rest
        self._keep(plain, np.array(ids, np.uint32), np.array(sizes, np.int64))

    def _keep(self, words: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        """Enter the words with their ids, which lie one after another."""
        known, need = len(self.cache), self.size + len(ids)
        count = known + len(words)
        if need > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(max(need - len(self.flat), len(self.flat)), np.uint32)])
        if count > len(self.starts):
            grow = max(count - len(self.starts), len(self.starts))
            self.starts = np.concatenate([self.starts, np.zeros(grow, np.int64)])
            self.lengths = np.concatenate([self.lengths, np.zeros(grow, np.int32)])
        self.flat[self.size : need] = ids
        self.lengths[known:count] = lengths
        self.starts[known:count] = self.size + np.cumsum(lengths) - lengths
        self.cache.update(zip(words, range(known, count), strict=True))
        self.size = need

    def _look_up(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.cache.get, words, repeat(-1)), np.int64, len(words))

    def _shrink(self, words: list[str]) -> None:
        """Forget all pieces but these."""
        index = self._look_up(words)
        kept = [words[i] for i in np.flatnonzero(index >= 0).tolist()]
        index = index[index >= 0]
        lengths = self.lengths[index].astype(np.int64)
        ends = np.cumsum(lengths)
        ids = self.flat[np.arange(lengths.sum()) + np.repeat(self.starts[index] - ends + lengths, lengths)]
        self.cache.clear()
        self.size = 0
        self._keep(kept, ids, lengths)

    def _pieces(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """For each piece its cache index; for each text the index of its first piece."""
        data, ends = text_bytes(texts)
        if not len(data):
            return np.zeros(0, np.int64), np.zeros(len(ends), np.int64)
        kinds = _KINDS[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[1:-1] = _EDGES[kinds[:-1] * np.uint8(7) + kinds[1:]]
        # A single line break ends; only a space would join what follows.
        after = np.flatnonzero((kinds[1:-1] == _BREAK) & _VISIBLE[kinds[:-2]] & _VISIBLE[kinds[2:]]) + 2
        edge[after] = True
        # A two-byte letter (lead byte C3-DF; no white space is among them) before a space.
        space = np.flatnonzero(kinds[2:] == _SPACE) + 2
        edge[space[(data[space - 2] >= 0xC3) & (data[space - 2] <= 0xDF) & (data[space - 1] >= 0x80)]] = True
        raw = data.tobytes() if self.special else b""
        for word in map(str.encode, self.special):
            at = raw.find(word)
            while at >= 0:  # no cut inside a special token
                edge[at + 1 : at + len(word)] = False
                at = raw.find(word, at + 1)
        edge[ends] = True
        bounds = np.flatnonzero(edge)
        pieces = pa.Array.from_buffers(
            pa.large_string(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
        ).dictionary_encode()
        words = pieces.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.cache) + len(words) > MAX_CACHED:
            self._shrink(words)
        index = self._look_up(words)
        new = np.flatnonzero(index < 0)
        if len(new):
            added = [words[i] for i in new.tolist()]
            self._add(added)
            index[new] = self._look_up(added)
        return index[pieces.indices.to_numpy()], np.searchsorted(bounds, ends)

    def counts(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text (null: none)."""
        pieces, first = self._pieces(texts)
        return np.diff(np.concatenate([[0], np.cumsum(self.lengths[pieces], dtype=np.int64)])[first])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in one array, and where each text begins and ends in it."""
        pieces, first = self._pieces(texts)
        lengths = self.lengths[pieces].astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(lengths)])
        place = np.arange(ends[-1]) + np.repeat(self.starts[pieces] - ends[:-1], lengths)
        return self.flat[place], ends[first]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This worker's encoder for a vocabulary file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def vocabulary_size(path: str) -> int:
    """One more than the greatest id."""
    return max(Tokenizer.from_file(path).get_vocab().values()) + 1


def check_byte_level(path: str) -> None:
    """Raise unless the file is a byte-level BPE vocabulary with the usual pattern, which the cuts rely on."""
    library = Tokenizer.from_file(path)
    if not isinstance(library.pre_tokenizer, pre_tokenizers.ByteLevel) or library.normalizer is not None:
        raise ValueError(f"{path} is not a byte-level BPE vocabulary")
