"""Token ids of whole texts by a public byte-level BPE vocabulary.

The vocabulary's split pattern never joins characters across a white-space character other than
the one blank before a word.  So where every white space is one blank or one line feed, a text's
ids are those of its words, each with the blank before it, and the ids of words are remembered
(a bounded number of them); any other text is encoded at once.  The string of the special token in a
text is that token, as the tokenizer's own library reads it; the text around it is encoded piece by piece.
"""

from __future__ import annotations

import base64
from array import array

#: Two generations of so many words are remembered.
CACHED_WORDS = 250_000
TOKENIZER = "byte_bpe_50k.tiktoken"
#: The vocabulary's only special token, which its rank file leaves out.
SPECIAL, SPECIAL_ID = "<|endoftext|>", 50256


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def plain(text: str) -> bool:
    """Whether all white space is single blanks and line feeds between words."""
    if text[:1] in ("", " ", "\n") or text[-1] in " \n":
        return False
    if "  " in text or "\n\n" in text or " \n" in text or "\n " in text:
        return False
    # All other white space is unprintable; so are a few other characters, which is no harm.
    return text.replace("\n", " ").isprintable()


class Encoder(dict):
    """Ids by word, as bytes: a word stands for itself with a blank before it, or with its line feed."""

    def __init__(self, path: str) -> None:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self._encoding = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self._old: dict[str, bytes] = {}
        self._marks = {mark: self._encode(mark) for mark in ".,"}
        self._newline = len(self._encode("\n"))

    def _encode(self, text: str) -> bytes:
        return array("H", self._encoding.encode_ordinary(text)).tobytes()

    def _word_ids(self, word: str) -> bytes:
        if word[-1] in ".," and word[:-1].isalpha():
            return self[word[:-1]] + self._marks[word[-1]]
        return self._encode(word if word[0] == "\n" else " " + word)

    def __missing__(self, word: str) -> bytes:
        ids = self._old.get(word)
        if ids is None:
            ids = self._word_ids(word)
        if len(self) >= CACHED_WORDS:
            self._old = dict(self)
            self.clear()
        self[word] = ids
        return ids

    def ids(self, text: str) -> bytes:
        """The ids, two little-endian bytes each."""
        if SPECIAL in text:
            mark = array("H", [SPECIAL_ID]).tobytes()
            return mark.join([self.ids(part) if part else b"" for part in text.split(SPECIAL)])
        if not plain(text):
            return self._encode(text)
        first, *rest = text.replace("\n", " \n").split(" ")
        return b"".join([self["\n" + first][self._newline :], *map(self.__getitem__, rest)])


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
