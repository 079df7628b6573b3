"""Token ids of many texts with a ``tokenizers`` file.

A text is cut into pieces that the tokenizer never joins, and each distinct piece is encoded once.

Byte-level BPE never joins the end of a word to the white space that follows: every token holds
white space at its start only, or nothing else, so a piece is a word with the white space before it.
Texts with white space beyond ASCII are encoded whole, so the cut never has to tell such characters
from letters. Tokenizers that drop white space take plain words (``spaces=False``). An added token
of the file holds no white space, so it lies in one piece.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np

_OTHER_SPACE = re.compile("[\x1c-\x1f\x85\xa0  -     　]")
_WITH_SPACE = re.compile(rb"\s*\S+|\s+")
#: Behind a letter or digit and before a sign of ASCII tokens always end.
_SIGNS = re.compile(rb"(?<=[A-Za-z0-9])(?=[!-/:-@\[-`{-~])")
#: ASCII and Latin letters whose normal form and lower case have as many bytes as they have.
_STABLE = re.compile(rb"(?:[\x00-\x7f]|\xc3[\x80-\xbf]|\xc4[\x80-\xaf\xb1-\xbf]|\xc5[\x80-\xbf])+")
_WORD_END = re.compile(rb"[^\x20\x09-\x0D](?=[\x20\x09-\x0D])")
#: Bytes of text whose pieces are looked up at once.
SEGMENT_BYTES = 1 << 19


class Encoder:
    """Encodes with one tokenizer file and remembers the ids of the last ``slots`` pieces (or ``most``
    ids) that were met, and of as many before them; pieces met again outlast those met once. With
    ``added`` the file's added tokens in a text get their own ids, as an unchanged tokenizer gives
    them; without, special ones are plain text. ``spaces``: whether white space counts for the
    tokenizer."""

    def __init__(self, path: str, slots: int = 1 << 20, most: int = 1 << 23, added: bool = False, spaces: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added
        self.slots, self.most, self.spaces = slots, most, spaces
        tokens = [re.escape(t.content.encode()) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile(b"|".join(tokens) if tokens else b"(?!)").search
        words = self.tokenizer.get_vocab(with_added_tokens=True)
        #: bytes that a token stands for (a character of a byte-level token is a byte)
        self.width = np.zeros(max(words.values()) + 1, np.int64)
        self.width[list(words.values())] = [len(w.removesuffix("</w>")) for w in words]
        # a piece's bytes are the key: unlike pieces never meet
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.used = 0

    def _segments(self, text: bytes) -> Iterator[bytes]:
        """``text`` in runs of about ``SEGMENT_BYTES``, cut behind words."""
        at = 0
        while len(text) - at > SEGMENT_BYTES and (end := _WORD_END.search(text, at + SEGMENT_BYTES)):
            yield text[at:end.end()]
            at = end.end()
        yield text[at:] if at else text

    def _learn(self, missing: set[bytes]) -> None:
        """Make all pieces known."""
        again = [p for p in missing if p in self.older]
        self.known.update((p, self.older[p]) for p in again)
        missing.difference_update(again)
        # words with signs behind letters: the letters are often known
        parts = {p: _SIGNS.split(p) for p in missing if _SIGNS.search(p) and not self.added(p)}
        self._encode(missing.difference(parts).union(chain.from_iterable(parts.values())).difference(self.known))
        for p, x in parts.items():
            self.known[p] = b"".join([self.known[y] for y in x])

    def _encode(self, new: Iterable[bytes]) -> None:
        if self.spaces:     # a piece that begins a text would grow together with the one before it
            joined = [p for p in new if p[0] in b" \t\n\x0b\x0c\r" and not p.isspace()]
        else:
            joined = [p for p in new if p.isascii() or _STABLE.fullmatch(p)]
        if not self._learn_joined(joined):
            joined = []
        alone = list(set(new).difference(joined))
        for p, e in zip(alone, self.tokenizer.encode_batch_fast([p.decode() for p in alone], add_special_tokens=False)):
            ids = e.ids
            self.known[p] = struct.pack(f"<{len(ids)}I", *ids)
            self.used += len(ids)

    def _learn_joined(self, pieces: list[bytes]) -> bool:
        """Learn pieces from one call: tokens belong to the piece whose bytes they stand for. False, and
        nothing learned, if a token does not end where its piece does."""
        if not pieces:
            return True
        text = (b"" if self.spaces else b" ").join(pieces).decode()
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        token_ends = np.cumsum(self.width[ids])
        piece_ends = np.cumsum([len(p) for p in pieces])
        last = np.searchsorted(token_ends, piece_ends)
        if last[-1] != len(ids) - 1 or (token_ends[last] != piece_ends).any():
            return False
        raw, at = ids.tobytes(), 0
        for p, end in zip(pieces, (4 * last + 4).tolist()):
            self.known[p] = raw[at:end]
            at = end
        self.used += len(ids)
        return True

    def _groups(self, texts: list[bytes | None]) -> Iterator[list[tuple[int, bytes]]]:
        """The texts' segments with their texts' indexes, in runs of about ``SEGMENT_BYTES``."""
        group, size = [], 0
        for i, t in enumerate(texts):
            for segment in self._segments(t or b""):
                group.append((i, segment))
                size += len(segment)
                if size >= SEGMENT_BYTES:
                    yield group
                    group, size = [], 0
        if group:
            yield group

    def _pieces(self, segment: bytes) -> list[bytes]:
        return _WITH_SPACE.findall(segment) if self.spaces else segment.split()

    def encode(self, texts: list[bytes | None]) -> list[np.ndarray]:
        """Ids of every text (null: none), as ``tokenizers`` gives them without special tokens."""
        found: list[list[bytes]] = [[] for _ in texts]
        if self.spaces:
            texts = list(texts)
            for i, t in enumerate(texts):
                if t and not t.isascii() and _OTHER_SPACE.search(t.decode()):
                    ids = self.tokenizer.encode(t.decode(), add_special_tokens=False).ids
                    found[i], texts[i] = [np.array(ids, "<u4").tobytes()], None
        for group in self._groups(texts):
            for (i, _), ids in zip(group, self._look_up([self._pieces(segment) for _, segment in group])):
                found[i].append(ids)
        return [np.frombuffer(b"".join(x), "<u4") for x in found]

    def _look_up(self, pieces: list[list[bytes]]) -> list[bytes]:
        """The ids of lists of pieces, each list's joined."""
        if len(self.known) > self.slots or self.used > self.most:
            self.known, self.older, self.used = {}, self.known, 0
        get = self.known.get
        out, lacking, missing = [], [], set()
        for k, own in enumerate(pieces):
            values = list(map(get, own))
            try:
                out.append(b"".join(values))
            except TypeError:       # a piece is not known: None
                out.append(b"")
                lacking.append((k, values))
                missing.update([p for p, x in zip(own, values) if x is None])
        if missing:
            self._learn(missing)
            for k, values in lacking:
                out[k] = b"".join([self.known[p] if x is None else x for p, x in zip(pieces[k], values)])
        return out


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(path: str, spaces: bool = True, slots: int = 1 << 20) -> Encoder:
    """This Python worker's encoder for a tokenizer file, with added tokens' own ids. Only the last one
    used stays in memory."""
    key = (path, spaces, slots)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(path, slots, 8 * slots, added=True, spaces=spaces)
    return _ENCODERS[key]
