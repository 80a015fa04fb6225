"""Fast whole-text encoding with the tokenizers library.

Byte-pair encoders spend nearly all their time on the same words again and again.  A text of plain
characters is cut into the words that the tokenizer's own pattern finds in it; words are remembered,
and only new ones go to the model.  In any other text the pieces between single spaces are taken one by one, if the
tokenizer surely cuts there, and a piece of other characters is encoded by one library call; texts
in which a cut at a space could matter, and texts that hold an added token, are encoded whole.  So the ids always
equal those of one call on the whole text.
"""

from __future__ import annotations

import json
import os
import re
import sys
from array import array
from collections.abc import Callable, Iterable, Iterator

#: White space, in the broadest sense, other than the space and the newline.
_RARE = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]
#: Latin letters up to U+024F, and those of them that lower-casing Latin-1 leaves; ASCII marks.
_LETTERS, _SMALL, _MARKS = "A-Za-zÀ-ÖØ-öø-ɏ", "a-zß-öø-ÿ", r"!-/:-@\[-`{-~"
#: The tokenizers' patterns over those characters and ASCII white space: contractions, letters, digits, marks, spaces.
_WHITE = r" \t\n\r\f\v"
_KEEPING = re.compile(rf"'(?:[stmd]|re|ve|ll)| ?[{_LETTERS}]+| ?[0-9]+| ?[{_MARKS}]+|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]+")
_DROPPING = re.compile(rf"'(?:[stmd]|re|ve|ll)|[{_SMALL}]+|[0-9]|[{_MARKS}]+")
_KEEPING_JSON = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
_DROPPING_REGEX = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: The byte-level scheme's characters: printable bytes stand for themselves, the others follow 255.
_PLAIN = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
BYTE_CHARS = {b: 256 + n for n, b in enumerate(b for b in range(256) if b not in _PLAIN)}
#: Marks a piece that begins its text.
FIRST = "\x00"
#: Bytes that a generation of a cache may take, an entry's own cost, and the longest key that is kept.
CACHE_BYTES, ENTRY_BYTES, LONG = 96 << 20, 200, 64
assert sys.byteorder == "little" and array("I").itemsize == 4
_ENCODERS: dict[tuple[str, bool, int], "PieceEncoder"] = {}


def _parts_at_spaces(text: str) -> bool:
    """Whether each space stands alone between characters that are no white space."""
    if text[:1] == " " or text[-1:] == " " or "  " in text or "\n " in text or FIRST in text:
        return False
    return not any(c in text and c + " " in text for c in _RARE)


def _lowered(text: str) -> str:
    """The text in lower case if the tokenizer's own lower-casing surely gives the same."""
    if not text.isascii():
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return text
    return text.lower()


class Generations(dict):
    """A cache of what ``make`` gives for a key, bounded in bytes: the younger of two generations.

    ``turned`` gives the cache to go on with: when this one is full it becomes the older generation,
    and the one before it goes, so frequent keys stay.
    """

    __slots__ = ("make", "older", "spent")

    def __init__(self, make: Callable[[str], bytes], older: dict[str, bytes] | None = None):
        super().__init__()
        self.make, self.older, self.spent = make, older or {}, 0

    def __missing__(self, key: str) -> bytes:
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= LONG:
            self.spent += ENTRY_BYTES + len(key) + len(value)
            self[key] = value
        return value

    def turned(self, limit: int) -> "Generations":
        if self.spent <= limit:
            return self
        self.older = {}
        return Generations(self.make, self)


class PieceEncoder:
    """Encodes texts to little-endian uint32 ids, with bounded caches of pieces and of words.

    ``keeps_space``: the tokenizer joins a space to the word after it (byte-level BPE); otherwise
    white space only separates and letter case is dropped.  ``cache_bytes`` bounds each generation of
    each cache.
    """

    def __init__(self, path: str, keeps_space: bool, cache_bytes: int = CACHE_BYTES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.keeps_space, self.cache_bytes = keeps_space, cache_bytes
        kind = json.loads(self.tokenizer.to_str())
        #: Strings that the tokenizer takes for added tokens wherever they stand.
        self.added = [t["content"] for t in kind["added_tokens"]]
        #: Whether the words of a piece are those of the patterns above and can go to the model directly.
        first, *more = kind["pre_tokenizer"].get("pretokenizers", [kind["pre_tokenizer"]])
        if keeps_space:
            self.direct = not more and first == _KEEPING_JSON and kind["normalizer"] is None
        else:
            self.direct = first.get("pattern") == {"Regex": _DROPPING_REGEX} and [m["type"] for m in more] == ["ByteLevel"] and not more[0]["use_regex"]
        self.direct = self.direct and kind["model"]["type"] == "BPE" and kind["post_processor"] is None
        self.find = (_KEEPING if keeps_space else _DROPPING).findall
        self.words = Generations(self._word)
        self.pieces = Generations(self._piece)

    def whole(self, texts: list[str]) -> list[bytes]:
        """Ids of each text from one library call on the whole texts."""
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def _word(self, word: str) -> bytes:
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(BYTE_CHARS)
        elif word[0] <= " ":  # white space, of which only a space can stand before a word
            word = "\u0120" + word[1:] if word[0] == " " and len(word.rstrip()) > 0 else word.translate(BYTE_CHARS)
        return array("I", [t.id for t in self.tokenizer.model.tokenize(word)]).tobytes()

    def _words(self, text: str) -> list[str] | None:
        """The words that the tokenizer's pattern finds, or None if the text has characters beyond the pattern above."""
        words = self.find(text) if self.direct else []
        white = 0 if self.keeps_space else sum(map(text.count, " \n\t\r\f\v"))
        return words if sum(map(len, words)) + white == len(text) else None

    def _piece(self, piece: str) -> bytes:
        if self.keeps_space:  # a piece that begins a text is marked; the others follow a space
            piece = piece[1:] if piece[:1] == FIRST else " " + piece
        words = self._words(piece)
        return self.whole([piece])[0] if words is None else b"".join(map(self.words.__getitem__, words))

    def _text(self, text: str) -> bytes:
        if any(t in text for t in self.added):
            return self.whole([text])[0]
        text = text if self.keeps_space else _lowered(text)
        words = self._words(text)
        if words is not None:
            return b"".join(map(self.words.__getitem__, words))
        if not self.keeps_space:
            parts = text.split(" ")
        elif _parts_at_spaces(text):
            parts = (FIRST + text).split(" ")
        else:
            return self.whole([text])[0]
        return b"".join(map(self.pieces.__getitem__, parts))

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """Ids of each text (None counts as empty) as little-endian uint32 bytes, in order."""
        for text in texts:
            yield self._text(text or "")
            self.words, self.pieces = self.words.turned(self.cache_bytes), self.pieces.turned(self.cache_bytes)


def strings(column: Iterable) -> Iterator[str | None]:
    """The texts of an Arrow column, one at a time."""
    return (x.as_py() for x in column)


def encoder(path: str, keeps_space: bool, cache_bytes: int = CACHE_BYTES) -> PieceEncoder:
    """The worker's encoder for a vocabulary file; kept, with its caches, between the tasks of a Python worker."""
    key = (path, keeps_space, cache_bytes)
    if key not in _ENCODERS:
        _ENCODERS[key] = PieceEncoder(path, keeps_space, cache_bytes)
    return _ENCODERS[key]
