"""Token ids of texts by a public tokenizer whose pre-tokens never cross white space."""

from __future__ import annotations

import functools
import os
import unicodedata
from array import array

#: Bytes of words and ids that a task keeps; beyond it the table starts anew.
TABLE_BYTES = 96 << 20
#: What an entry takes besides its word and its ids.
_ENTRY = 180
#: Type codes of little-endian ids of two and of four bytes.
NARROW, WIDE = "H", "I"


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if printable, else the next from 256 on."""
    plain = {b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174}
    others = iter(range(256, 512))
    return {b: chr(b) if b in plain else chr(next(others)) for b in range(256)}


@functools.lru_cache(maxsize=1)
def loaded(path: str):
    """The tokenizer of a file, about 30 MB for 50,000 entries; a worker keeps the one it used last."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def code_for(path: str, *ids: int) -> str:
    """The narrowest type code that holds the tokenizer's ids and the given ones."""
    return NARROW if max(loaded(path).get_vocab_size(), 1 + max(ids, default=0)) <= 1 << 16 else WIDE


class WordIds(dict):
    """Ids of white-space separated words, as little-endian numbers.

    A word of letters, with or without ASCII punctuation behind it, is split as the tokenizer would split it, and its parts are
    merged by the tokenizer's model alone; all other words, those that hold special tokens among them, go through the whole
    tokenizer. The table belongs to one task and is bounded by bytes.
    """

    TAIL = ".,;:!?*&$#%()-\""

    def __init__(self, path: str, code: str = WIDE, table_bytes: int = TABLE_BYTES):
        self.encoder = loaded(path)
        self.merge = self.encoder.model.tokenize
        self.letters = _byte_letters()
        self.specials = [t.content.encode().lower() for t in self.encoder.get_added_tokens_decoder().values()]
        self.tails = self.TAIL.encode()
        self.code, self.limit, self.size = code, table_bytes, 0

    def _part(self, name: bytes) -> bytes:
        found = self.get(name)
        if found is None:
            # Printable ASCII stands for itself.
            named = name.decode() if name.isascii() else name.decode("latin-1").translate(self.letters)
            self[name] = found = array(self.code, [t.id for t in self.merge(named)]).tobytes()
            self.size += len(name) + len(found) + _ENTRY
        return found

    def _lowered(self, text: bytes) -> bytes:
        """The text with A-Z lower-cased, as the tokenizer does it, unless a special token might change or arise by that."""
        low = text.lower()
        return text if any(s in low for s in self.specials) else low

    def _letters(self, word: bytes) -> tuple[bytes, bytes] | None:
        """Lower-cased letters and the punctuation behind them, unless the word is something else."""
        core = word.rstrip(self.tails)
        if core.isalpha():  # ASCII letters
            return core.lower(), word[len(core) :]
        if core.isascii():
            return None
        text = core.decode("utf-8", "replace")
        low = text.lower()
        whole = text.isalpha() and low.isalpha() and "\u03a3" not in text
        if whole and unicodedata.is_normalized("NFC", text) and unicodedata.is_normalized("NFC", low):
            return low.encode(), word[len(core) :]
        return None

    def __missing__(self, word: bytes) -> bytes:
        """The ids of a word that is not in the table yet, which afterwards is."""
        core = word.rstrip(self.tails)
        if core.islower() and core.isalpha():  # ASCII letters in small: most words
            ids = self.get(core)
            if ids is None:
                self[core] = ids = array(self.code, [t.id for t in self.merge(core.decode())]).tobytes()
                self.size += len(core) + len(ids) + _ENTRY
            if len(core) == len(word):
                return ids
            tail = word[len(core) :]
            ids += self.get(tail) or self._part(tail)
        elif parts := self._letters(word):
            low, tail = parts
            ids = self._part(low)
            if tail:
                ids += self._part(tail)
            if low == word:
                return ids
        else:
            ids = array(self.code, self.encoder.encode(word.decode("utf-8", "replace"), add_special_tokens=False).ids).tobytes()
        self[word] = ids
        self.size += len(word) + len(ids) + _ENTRY
        return ids

    def texts(self, texts: list[bytes | None]) -> list[bytes]:
        """The ids of each text."""
        if self.size > self.limit:
            self.clear()
            self.size = 0
        return [b"".join(map(self.__getitem__, self._lowered(t).split())) if t else b"" for t in texts]
