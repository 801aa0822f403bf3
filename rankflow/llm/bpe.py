"""Token ids of whole texts with the tokenizers library, piece by piece.

A byte-level tokenizer with the usual pattern always ends a piece before a
single space that stands between two other non-space characters, on either
side of a single line break, and between a letter, a digit and a mark next to
one another (an apostrophe belongs to what follows).  So a text is cut there,
each distinct piece is encoded once by the library, and the ids are joined.
Letters are A-Z and those of Latin-1; no cut is made next to other characters
beyond ASCII.  A piece of one kind of characters is one word of the library's
model; any other piece goes through the library's whole call.  A text with
other white space (doubled, leading, trailing) is encoded as a whole, and so
is one that contains an added token, unless these are ordinary text, and every
text of a tokenizer of another kind.

Pieces are found, hashed and looked up as arrays (no Python object for a piece
that is known already).  A piece is known by 128 bits of hash.
"""

from __future__ import annotations

import json
import os

from rankflow.llm.common import mixed, ship, task_cache

PIECES = 1_000_000     # most remembered pieces, about 60 bytes each
_LONG = 4096           # bytes of a piece that is hashed by itself
STRETCH = 1 << 21      # most characters of a text that are cut up at once
# classes of characters: other, letter, digit, mark, apostrophe, separator
_OTHER, _LETTER, _DIGIT, _MARK, _QUOTE, _GAP = range(6)
# what stands before a piece: nothing, a space, a line break
_PLAIN, _SPACED, _LINE = range(3)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_chars() -> dict:
    """The character that a byte-level vocabulary has for each byte: itself
    where it is printable, else the next one from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {**{b: chr(b) for b in printable}, **{b: chr(256 + k) for k, b in enumerate(others)}}


def _classes():
    import numpy as np

    kind = np.zeros(256, np.uint8)
    kind[33:127] = _MARK
    kind[48:58] = _DIGIT
    kind[65:91] = kind[97:123] = _LETTER
    kind[39] = _QUOTE
    kind[[32, 10]] = _GAP
    return kind


def _borders():
    """Whether a piece ends between two classes, by 8 * left + right."""
    import numpy as np

    cut = np.zeros((8, 8), bool)
    for a in (_LETTER, _DIGIT, _MARK):
        for b in (_LETTER, _DIGIT, _MARK, _QUOTE):
            cut[a, b] = a != b and (a, b) != (_MARK, _QUOTE)
    cut[_GAP, :] = cut[:, _GAP] = True
    return cut.ravel()


def _hashes(joined: bytes, data, start, size, lead):
    """Two 64-bit hashes of each piece and of what stands before it."""
    import numpy as np
    import xxhash

    eight = np.lib.stride_tricks.as_strided(data[:8].view(np.uint64), (len(data) - 7,), (1,), writeable=False)
    seed = size.astype(np.uint64) * np.uint64(4) + lead.astype(np.uint64) + np.uint64(1)
    h, g = mixed(seed * np.uint64(0x9E3779B97F4A7C15)), mixed(seed * np.uint64(0xA0761D6478BD642F))
    todo = np.flatnonzero(size <= _LONG)
    at, left = start[todo], size[todo]
    while len(todo):
        some = eight[at] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(8) * (8 - np.minimum(left, 8)).astype(np.uint64)))
        h[todo] = mixed((h[todo] ^ some) * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(0x165667B19E3779F9))
        g[todo] = mixed((g[todo] ^ some) * np.uint64(0xE7037ED1A0B428DB) + np.uint64(0x8EBC6AF09C88C6E3))
        more = left > 8
        todo, at, left = todo[more], at[more] + 8, left[more] - 8
    for k in np.flatnonzero(size > _LONG).tolist():
        d = xxhash.xxh3_128_intdigest(joined[start[k]:start[k] + size[k]], int(lead[k]))
        h[k], g[k] = d & 0xFFFFFFFFFFFFFFFF, d >> 64
    return h, g


def _stretches(text: str, size: int = STRETCH):
    """A long text in parts of about ``size`` that begin at its separators."""
    at = 0
    while len(text) - at > size:
        k = max(text.rfind(" ", at + 1, at + size), text.rfind("\n", at + 1, at + size))
        if k < 0:    # one word longer than that
            k = min([x for x in (text.find(" ", at + size), text.find("\n", at + size)) if x >= 0], default=len(text))
        yield text[at:k]
        at = k
    if at < len(text):
        yield text[at:]


class Encoder:
    """Texts to little-endian unsigned ids (``dtype``) as bytes.  With
    ``added_as_text`` the string of an added token in a text is ordinary text,
    else it becomes that token, as in the library's plain call.  ``pieces``
    bounds the memory of what is remembered, not the result."""

    def __init__(self, path: str, dtype: str, added_as_text: bool = True, pieces: int = PIECES):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = added_as_text
        self.added = [] if added_as_text else [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        made = json.loads(self.tokenizer.to_str())
        cut = made.get("pre_tokenizer") or {}
        # the ways of a tokenizer for which the cuts above hold
        self.cuts = (cut.get("type") == "ByteLevel" and cut.get("use_regex") and not cut.get("add_prefix_space")
                     and made.get("normalizer") is None and made["model"]["type"] == "BPE")
        self.dtype, self.pieces = dtype, pieces
        self.kind, self.borders = _classes(), _borders()
        self.chars = _byte_chars()
        self.chars[10] = "\n"    # separates pieces here; no piece holds it
        self.forget()
        if self.cuts:
            (self.break_id,) = self.tokenizer.encode("\n", add_special_tokens=False).ids

    def forget(self) -> None:
        """Start with no piece known: both hashes of each, where its ids are in
        ``ids``, and ``slots``, an open-addressed table of the pieces' numbers."""
        import numpy as np

        self.h, self.g = np.zeros(1 << 12, np.uint64), np.zeros(1 << 12, np.uint64)
        self.at, self.n = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int32)
        self.ids, self.used, self.count = np.zeros(1 << 16, self.dtype), 0, 0
        self.slots = np.full(1 << 13, -1, np.int32)

    def _find(self, h, g):
        """The number of each piece, -1 for one that is not known."""
        import numpy as np

        last = len(self.slots) - 1
        slot = (h & np.uint64(last)).astype(np.int64)
        out = self.slots[slot]
        todo = np.flatnonzero((out >= 0) & ((self.h[out] != h) | (self.g[out] != g)))
        while len(todo):    # another piece is there: look on in the next slots
            slot[todo] = (slot[todo] + 1) & last
            got = out[todo] = self.slots[slot[todo]]
            todo = todo[(got >= 0) & ((self.h[got] != h[todo]) | (self.g[got] != g[todo]))]
        return out

    def _enter(self, first: int) -> None:
        """Put the pieces from number ``first`` on into the slots."""
        import numpy as np

        if 2 * self.count > len(self.slots):
            self.slots, first = np.full(4 * len(self.slots), -1, np.int32), 0
            return self._enter(first)
        last = len(self.slots) - 1
        todo = np.arange(first, self.count, dtype=np.int32)
        slot = (self.h[first:self.count] & np.uint64(last)).astype(np.int64)
        while len(todo):    # of several that want a free slot one gets it
            free = self.slots[slot] < 0
            self.slots[slot[free]] = todo[free]
            out = self.slots[slot] != todo
            todo, slot = todo[out], (slot[out] + 1) & last

    def _whole(self, texts: list) -> list:
        import numpy as np

        return [np.array(e.ids, self.dtype).tobytes()
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, pieces: list, lead: list) -> list:
        """Ids of pieces of one kind of characters: words of the model."""
        word = self.tokenizer.model.tokenize
        space = self.chars[32]
        named = b"\n".join(pieces).decode("latin-1").translate(self.chars).split("\n")
        return [[t.id for t in word(space + p if k == _SPACED else p)] for p, k in zip(named, lead)]

    def _mixtures(self, pieces: list, lead: list) -> list:
        """Ids of other pieces: many are encoded as one text, each on a line
        of its own, and cut at the ids of the line breaks."""
        out = []
        for k in range(0, len(pieces), 4096):
            text = "\n".join([" " + p.decode() if s == _SPACED else p.decode()
                              for p, s in zip(pieces[k:k + 4096], lead[k:k + 4096])])
            line = []
            for i in self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids:
                if i == self.break_id:
                    out.append(line)
                    line = []
                else:
                    line.append(i)
            out.append(line)
        return out

    def _learn(self, h, g, pieces: list, lead, plain) -> None:
        """Remember new pieces."""
        import numpy as np

        got = [None] * len(pieces)
        for some, encode in ((np.flatnonzero(plain), self._words), (np.flatnonzero(~plain), self._mixtures)):
            some = some.tolist()
            if some:
                for k, ids in zip(some, encode([pieces[k] for k in some], [lead[k] for k in some])):
                    got[k] = [self.break_id, *ids] if lead[k] == _LINE else ids
        n = np.array([len(x) for x in got], np.int64)
        first, self.count = self.count, self.count + len(got)
        start, self.used = self.used, self.used + int(n.sum())

        def put(known, at, new):
            while at + len(new) > len(known):
                known = np.concatenate([known, np.zeros_like(known)])
            known[at:at + len(new)] = new
            return known

        self.ids = put(self.ids, start, np.array([i for x in got for i in x], self.dtype))
        self.h, self.g, self.n = put(self.h, first, h), put(self.g, first, g), put(self.n, first, n)
        self.at = put(self.at, first, start + np.cumsum(n) - n)
        self._enter(first)

    def _cut(self, texts: list) -> list:
        """Ids of texts with single spaces and line breaks only; a text may
        begin with one of these."""
        import numpy as np

        raw = [t.encode() for t in texts]
        joined = b"\n" + b"\n".join(raw) + b"\n" * 9
        data = np.frombuffer(joined, np.uint8)
        kind = self.kind[data]
        c3 = np.flatnonzero(data == 0xC3)        # letters of Latin-1, but for two signs
        c3 = c3[(data[c3 + 1] != 0x97) & (data[c3 + 1] != 0xB7)]
        kind[c3] = kind[c3 + 1] = _LETTER
        edge = np.flatnonzero(self.borders[(kind[:-1] << 3) | kind[1:]]) + 1
        inside = kind[edge] != _GAP
        start = edge[inside]
        end = edge[np.flatnonzero(inside) + 1]
        size = end - start
        lead = np.where(data[start - 1] == 32, _SPACED, np.where(data[start - 1] == 10, _LINE, _PLAIN)).astype(np.uint8)
        firsts = np.cumsum([1] + [len(t) + 1 for t in raw])
        first = np.searchsorted(start, firsts)
        lead[first[:-1][kind[firsts[:-1]] != _GAP]] = _PLAIN    # the line break before a text is not its own
        h, g = _hashes(joined, data, start, size, lead)
        place = self._find(h, g)
        missing = np.flatnonzero(place < 0)
        if len(missing):
            if self.count > self.pieces:
                self.forget()
                missing = np.arange(len(h))
            names, some, which = np.unique(h[missing], return_index=True, return_inverse=True)
            new = missing[some]
            if (g[new][which] != g[missing]).any():    # two pieces that differ in the second hash only
                return self._whole(texts)
            strange = np.flatnonzero((kind == _OTHER) | (kind == _QUOTE))
            plain = np.searchsorted(strange, start[new]) == np.searchsorted(strange, end[new])
            pieces = [joined[s:e] for s, e in zip(start[new].tolist(), end[new].tolist())]
            first_new = self.count
            self._learn(names, g[new], pieces, lead[new].tolist(), plain)
            place[missing] = first_new + which
        n = self.n[place]
        to = np.concatenate([[0], np.cumsum(n)])
        out = self.ids[np.repeat(self.at[place] - to[:-1], n) + np.arange(to[-1])].tobytes()
        ends = (to[first] * np.dtype(self.dtype).itemsize).tolist()
        return [out[s:e] for s, e in zip(ends, ends[1:])]

    def _odd(self, texts: list) -> list:
        """Whether each text is encoded as a whole."""
        import numpy as np

        if not self.cuts:
            return [True] * len(texts)
        raw = [t.encode() for t in texts]
        data = np.frombuffer(b"\n" + b"\n".join(raw) + b"\n" * 3, np.uint8)
        gap = self.kind[data] == _GAP
        firsts = np.cumsum([1] + [len(t) + 1 for t in raw])
        # two separators together, one at either end of a text, other white space of ASCII
        bad = [np.flatnonzero(gap[:-1] & gap[1:]) + 1, np.flatnonzero((data < 32) & (data > 8) & (data != 10))]
        odd = np.bincount(np.searchsorted(firsts, np.concatenate(bad), "right") - 1, minlength=len(texts))[:len(texts)] > 0
        # a character beyond ASCII may be white space: then the split text lacks more than the separators
        high = np.flatnonzero((data == 0xC2) | (data == 0xE1) | (data == 0xE2) | (data == 0xE3))
        maybe = np.zeros(len(texts) + 1, bool)
        maybe[np.searchsorted(firsts, high, "right") - 1] = True
        odd = odd.tolist()
        for k in np.flatnonzero(maybe[:-1]).tolist():
            t = texts[k]
            odd[k] = odd[k] or len("".join(t.split())) + t.count(" ") + t.count("\n") != len(t)
        return [o or any(a in t for a in self.added) for o, t in zip(odd, texts)]

    def __call__(self, texts: list) -> list:
        """The ids of each text (null: none)."""
        out = [b""] * len(texts)
        some = [k for k, t in enumerate(texts) if t]
        odd, even = [], []
        for k, whole in zip(some, self._odd([texts[k] for k in some])):
            (odd if whole else even).append(k)
        for k in [k for k in even if len(texts[k]) > STRETCH]:
            even.remove(k)
            out[k] = b"".join(self._cut([x])[0] for x in _stretches(texts[k]))
        for some, encode in ((odd, self._whole), (even, self._cut)):
            if some:
                for k, ids in zip(some, encode([texts[k] for k in some])):
                    out[k] = ids
        return out


def encoder(path: str, dtype: str = "<u2", added_as_text: bool = True, pieces: int = PIECES) -> Encoder:
    """The encoder of ``path``, kept for the life of the worker process."""
    cache = task_cache()
    key = ("bpe", path, dtype, added_as_text, pieces)
    if key not in cache:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for every core
        cache[key] = Encoder(path, dtype, added_as_text, pieces)
    return cache[key]


def id_type(path: str) -> str:
    """The smallest id type that holds the tokenizer's vocabulary."""
    from tokenizers import Tokenizer

    return "<u2" if Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"


ship(__name__)
