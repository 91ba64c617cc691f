"""Token ids of whole texts, with a bounded cache of chunks.

A public tokenizer splits a text into pieces before it merges inside each of
them, so a text's ids are its chunks' ids one after another when the text is
cut where the tokenizer always cuts: at white space (tokenizers that drop
it) or before a space that a non-space follows (byte-level tokenizers, where
the space belongs to the next word). Chunks recur, so each is encoded once
per worker by the tokenizers library and then looked up.

By default the strings of special tokens become those tokens, as the library
does it: a text that holds one goes through the whole tokenizer. With
``plain`` they are ordinary text.
"""

from __future__ import annotations

import os
import re
import sys
import unicodedata
from array import array

CACHE = 300_000
_WHITE = "\t\n\x0b\x0c\r"
_ODD = re.compile(r"\s\s")
_CUT = re.compile(r"(?= \S)")
#: below this, Python's and the library's lower case and letters agree but for one letter
_PLAIN_BELOW, _DOTTED_I = "ɐ", "İ"

_loaded: dict[tuple[str, bool], ChunkEncoder] = {}


def encoder(path: str, plain: bool = False) -> ChunkEncoder:
    """One encoder, and so one cache, per worker process and vocabulary."""
    if (path, plain) not in _loaded:
        _loaded[path, plain] = ChunkEncoder(path, plain=plain)
    return _loaded[path, plain]


class ChunkEncoder:
    def __init__(self, path: str, cache: int = CACHE, plain: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self._added = None if plain or not added else re.compile("|".join(map(re.escape, added)), re.IGNORECASE)
        self.dtype = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.width = int(self.dtype[2])
        self.drops_space = not self.ids(" ")
        self.lowers = self.drops_space and self.ids("A") == self.ids("a")
        self._bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self._letters: dict[str, str] = {}
        self._space = "".join(p for p, _ in self._bytes.pre_tokenize_str(" "))
        self._cache: dict[str, bytes] = {"": b""}
        self._older: dict[str, bytes] = {}
        self._most = cache
        self._model = self.tokenizer.model
        self.word = self._probe()

    def ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _probe(self) -> bool:
        """Whether single words may go straight to the merge model: it must
        agree with the whole tokenizer."""
        words = ["there", "keit", "ção", "Über", "xqzv", "naïveté"]
        return all(self._merge(lead + w) == self.ids(lead + w)
                   for w in words for lead in ([""] if self.drops_space else ["", " "]))

    def _merge(self, chunk: str) -> list[int]:
        """Ids of one letters-only word, with or without a leading space."""
        plain = chunk.isascii()
        if self.lowers:
            chunk = chunk.lower() if plain else unicodedata.normalize("NFC", chunk).lower()
        letters = self._letters
        if plain:  # ASCII letters stand for themselves; only the space has another sign
            chunk = chunk.replace(" ", self._space)
        else:
            for c in set(chunk).difference(letters):
                letters[c] = "".join(p for p, _ in self._bytes.pre_tokenize_str(c))
            chunk = "".join([letters[c] for c in chunk])
        return [t.id for t in self._model.tokenize(chunk)]

    def chunks(self, text: str) -> list[str]:
        if self.drops_space:
            for c in _WHITE:
                if c in text:
                    text = text.replace(c, " ")
            return text.split(" ")
        if _ODD.search(text):
            return _CUT.split(text)
        out: list[str] = []
        for line in text.split("\n"):  # a lone line break is a piece of its own
            words = (" " + line.replace(" ", "\n ")).split("\n")
            words[0] = line[:len(words[0]) - 1]
            out += words
            out.append("\n")
        out.pop()
        return out

    def _learn(self, missing: set[str]) -> None:
        """Put the ids of chunks into the cache. A full cache becomes the older
        one, from which chunks that come up again are taken over."""
        cache, hard = self._cache, []
        for chunk in missing:
            if chunk in self._older:
                cache[chunk] = self._older[chunk]
        missing = missing.difference(self._older)
        word_only, spaced = self.word, not self.drops_space
        for chunk in missing:
            end = chunk[-1] if chunk[-1] in ".," else ""
            body = chunk[:-1] if end else chunk
            word = body[1:] if spaced and body[:1] == " " else body
            if not (word_only and word.isalpha()
                    and (word.isascii() or max(word) < _PLAIN_BELOW and _DOTTED_I not in word)):
                hard.append(chunk)
            elif end:
                if end not in cache:
                    cache[end] = self.pack(self.ids(end))
                if body not in cache:
                    cache[body] = self.pack(self._merge(body))
                cache[chunk] = cache[body] + cache[end]
            else:
                cache[chunk] = self.pack(self._merge(chunk))
        if hard:
            for chunk, e in zip(hard, self.tokenizer.encode_batch_fast(hard, add_special_tokens=False)):
                cache[chunk] = self.pack(e.ids)

    def pack(self, ids: list[int]) -> bytes:
        packed = array("H" if self.width == 2 else "I", ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()

    def encode(self, text: str) -> bytes:
        """Little-endian ids of a whole text, ``dtype`` each."""
        if self._added and self._added.search(text):
            return self.pack(self.ids(text))
        chunks = self.chunks(text)
        out = []
        for at in range(0, len(chunks), 50_000):  # a very long text must not outgrow the cache
            part = chunks[at:at + 50_000]
            got = list(map(self._cache.get, part))
            if None in got:
                missing = {c for c, ids in zip(part, got) if ids is None}
                self._learn(missing)
                got = map(self._cache.__getitem__, part)
            out.append(b"".join(got))
            if len(self._cache) > self._most:
                self._older, self._cache = self._cache, {"": b""}
        return out[0] if len(out) == 1 else b"".join(out)
