"""Token ids of a BPE vocabulary with word ends, word by word.

White space never survives into a token of that vocabulary, so the ids of a text are those of its
white-space separated pieces one after another. Pieces repeat, so each worker keeps the ids of pieces it
has seen, up to ``CACHE`` of them. A piece of Latin letters, with ASCII punctuation behind it or not, goes
straight to the BPE model; any other piece goes through the whole tokenizer.
"""

from __future__ import annotations

import re
import struct

CACHE = 300_000
SAMPLES = ("The", "river", "Éau", "señorita,", "STRASSE!", "über.", "it;", "a", "naïve?!", 'dit"),', "Ÿ")
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
MARKS = '.,!?;:()"%$#&*|+-'
PLAIN = re.compile(rf"([{LETTERS}]+)([{re.escape(MARKS)}]*)")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class _Pieces(dict):
    """Bytes of a piece -> its ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        super().__init__()
        self.full = Tokenizer.from_file(path)
        self.model = self.full.model
        self.words: dict[str, bytes] = {}
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        letters = [chr(c) for c in range(0x100) if re.fullmatch(f"[{LETTERS}]", chr(c))]
        self.table = {ord(c): level.pre_tokenize_str(c.lower())[0][0] for c in letters}

        # a vocabulary that reads a sample, a letter or a mark otherwise gets no short way; what is not plain never takes it
        self.short = all(self._split(w) in (None, self._whole(w)) for w in (*SAMPLES, *letters, *("a" + c for c in MARKS)))

    def _whole(self, text: str) -> bytes:
        found = self.full.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(found)}I", *found)

    def _split(self, text: str) -> bytes | None:
        plain = PLAIN.fullmatch(text)
        return self._word(plain[1].translate(self.table)) + (self._word(plain[2]) if plain[2] else b"") if plain else None

    def _word(self, word: str) -> bytes:
        ids = self.words.get(word)
        if ids is None:
            if len(self.words) >= CACHE:
                self.words.clear()
            found = [x.id for x in self.model.tokenize(word)]
            ids = self.words[word] = struct.pack(f"<{len(found)}I", *found)
        return ids

    def __missing__(self, piece: bytes) -> bytes:
        if len(self) >= CACHE:
            self.clear()
        text = piece.decode("utf-8", "replace")
        ids = self._split(text) if self.short and len(text) < 200 else None
        if ids is None:
            ids = self._whole(text)
        self[piece] = ids
        return ids


_CACHES: dict[str, _Pieces] = {}


def token_bytes(text: bytes, path: str) -> bytes:
    """The ids of a UTF-8 text, four bytes each."""
    pieces = _CACHES.get(path)
    if pieces is None:
        pieces = _CACHES[path] = _Pieces(path)
    return b"".join(map(pieces.__getitem__, text.split()))
