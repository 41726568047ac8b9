"""Ids of a word-level BPE file for whole texts.

The tokenizer file drops white space and never merges across it, nor across the
pieces that its pattern cuts, and the last character of a piece carries an end mark.
With a blank as the end mark the merges are byte ranks: every piece of a text is
followed by one blank and the whole text goes to the public byte-rank encoder in one
call, whose ranks are the ids of the file.

That holds for Latin-1 text, where lower case and character classes are tables.  Words
with other characters go to the file's own library, all new ones of a text in one call,
and are remembered in a bounded memory.  Where splitting first could change a result (a
combining mark next to a letter, or the text of a special token) the whole text does.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable
from functools import lru_cache
from itertools import groupby

import numpy as np
import tiktoken

KNOWN = 32 << 20  # bytes of remembered words; beyond that the memory starts anew
ENTRY = 160  # bytes of an entry beside its word and its ids

_MARK = re.compile("[̀-ͯ]")
_WORD = re.compile("[^\\t-\\r ]+")
# Lower-case Latin-1 letters, numbers and white space, as the tokenizer's pattern has them.
_LETTER, _NUMBER, _SPACE = "a-zªµºß-öø-ÿ", "0-9²³¹¼-¾", "\\t-\\r \\x85\\xa0"
_SUFFIX = "'s|'t|'re|'ve|'m|'ll|'d"
_PIECES = re.compile(
    f"{_SUFFIX}|[{_LETTER}]+|[{_NUMBER}]|[^{_SPACE}{_LETTER}{_NUMBER}]+"
)
_HAS_SUFFIX = re.compile(_SUFFIX.encode())
BLANK, LETTER, NUMBER, OTHER = range(4)


def _byte_letters() -> dict[int, int]:
    """The code point by which byte-level vocabularies write each byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: b for b in shown} | {b: 256 + k for k, b in enumerate(hidden)}


def _latin_tables() -> tuple[bytes, np.ndarray]:
    """Lower case with plain blanks, and the class, of each Latin-1 character."""
    lower, classes = bytearray(range(256)), np.full(256, OTHER, np.uint8)
    for k in range(256):
        small = chr(k).lower()
        if re.fullmatch(f"[{_SPACE}]", small):
            small, classes[k] = " ", BLANK
        elif re.fullmatch(f"[{_LETTER}]", small):
            classes[k] = LETTER
        elif re.fullmatch(f"[{_NUMBER}]", small):
            classes[k] = NUMBER
        lower[k] = ord(small)
    return bytes(lower), classes


class WordTokens:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        byte_of = {chr(letter): b for b, letter in _byte_letters().items()}
        added = self.tokenizer.get_added_tokens_decoder().values()
        names = {t.content for t in added}
        ranks = {
            bytes(byte_of[c] for c in token.removesuffix("</w>"))
            + (b" " if token.endswith("</w>") else b""): k
            for token, k in self.tokenizer.get_vocab(with_added_tokens=False).items()
            if token not in names
        }
        self.ranks = tiktoken.Encoding(
            "words", pat_str="[^ ]+ ", mergeable_ranks=ranks, special_tokens={}
        )
        self.specials = [name.encode().lower() for name in names]
        self.lower, self.classes = _latin_tables()
        self.words: dict[str, list[int]] = {}
        self.held = 0

    def of_texts(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text, from the library alone."""
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [e.ids for e in found]

    def of_latin(self, text: bytes) -> list[int]:
        """Ids of a Latin-1 text without special tokens."""
        plain = text.translate(self.lower)
        if b"'" in plain and _HAS_SUFFIX.search(plain):
            spaced = " ".join(_PIECES.findall(plain.decode("latin-1")))
        else:
            letters = np.frombuffer(plain, np.uint8)
            kinds = self.classes[letters]
            left, right = kinds[:-1], kinds[1:]
            cut = ((left != right) | (right == NUMBER)) & (left != BLANK) & (right != BLANK)
            places = np.flatnonzero(cut) + 1
            if len(places):
                plain = np.insert(letters, places, 32).tobytes()
            spaced = plain.decode("latin-1")
        return self.ranks.encode_ordinary(spaced + " ")

    def learn(self, words: set[str]) -> None:
        """Bring words with characters beyond Latin-1 into the memory."""
        if self.held > KNOWN:
            self.words, self.held = {}, 0
        new = list(words.difference(self.words))
        for word, ids in zip(new, self.of_texts(new), strict=True):
            self.words[word] = ids
            self.held += 4 * len(word) + 8 * len(ids) + ENTRY

    def of_mixed(self, text: str) -> list[int]:
        """Ids of a text in which some words have characters beyond Latin-1."""
        runs = []
        for odd, run in groupby(_WORD.findall(text), key=lambda w: ord(max(w)) > 255):
            runs.append((odd, list(run)))
        self.learn({w for odd, run in runs if odd for w in run})
        ids: list[int] = []
        for odd, run in runs:
            if odd:
                for word in run:
                    ids += self.words[word]
            else:
                ids += self.of_latin(" ".join(run).encode("latin-1"))
        return ids

    def ids(self, text: str) -> list[int]:
        try:
            latin = text.encode("latin-1")
        except UnicodeEncodeError:
            latin = None
        # Of a special token the library knows its own case only, a lowered word would be it.
        plain = (text.encode() if latin is None else latin).lower()
        if any(s in plain for s in self.specials) or (latin is None and _MARK.search(text)):
            return self.of_texts([text])[0]
        return self.of_mixed(text) if latin is None else self.of_latin(latin)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return np.array(self.ids(text), "<u4").tobytes()

    def encode_all(self, texts: Iterable[str]) -> Iterable[bytes]:
        return map(self.encode, texts)


@lru_cache(maxsize=2)
def word_tokens(path: str) -> WordTokens:
    return WordTokens(path)
