"""Token ids of whole texts by the ``tokenizers`` library, with ids of repeated words remembered.

A byte-level BPE vocabulary first cuts a text into pieces by a fixed pattern and never merges across pieces, so the ids of
a text are those of its pieces one after the other. A single space between two words belongs to the piece after it,
so a text may as well be cut at its spaces: the ids of ``" word"`` do not depend on what stands around it. The only
exception is a space that has white space before it and white space or nothing after it, as runs of white space are
pieces of their own. Words repeat a lot; each worker keeps the ids of the last ``words`` to twice as many words and of
some pieces, which is about 200 MB at most for ``WORDS``. Texts with such spaces are cut by the pattern. Pieces go straight to the
vocabulary's merges, spelled in its alphabet of bytes. Texts with characters on which regular expression libraries could disagree, or with the text of a special token, and all texts if
the vocabulary cuts in another way, go to the library as a whole.
"""

from __future__ import annotations

import functools
import json
import re
import string
import struct

WORDS = 500_000
PIECES_KEPT = 20_000
LONGEST_REMEMBERED = 32
END_ID = 2
# The cutting pattern of a byte-level vocabulary.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
ASCII_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+"  # the same where all is ASCII
PLAIN = "[\\t\\n\\r\\x20-\\x7e¡-¬®-ȳ‐-‧‰-⁞]*"
RUN = re.compile(r"\s (?:\s|\Z)")  # a space that is not simply the first character of the next word's piece


# A byte is spelled by the Latin-1 character of its number if that is visible, else by the next letter from U+0100 on.
_VISIBLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
SPACE = "\u0120"
BYTE_LETTERS = {b: 0x100 + n for n, b in enumerate(b for b in range(0x100) if b not in _VISIBLE)}


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


_PACKS = [struct.Struct(f"<{n}I").pack for n in range(16)]


def _pack(ids: list[int]) -> bytes:
    return _PACKS[len(ids)](*ids) if len(ids) < 16 else struct.pack(f"<{len(ids)}I", *ids)


def _spelled(piece: str) -> str:
    """The piece's bytes in the vocabulary's alphabet."""
    return piece.encode().decode("latin-1").translate(BYTE_LETTERS)


class _Remembered(dict):
    """Packed ids by text; what is not there is made, and kept unless it is long.

    When full, it becomes the older generation, from which texts come back when they are met again.
    """

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most, self.older = make, most, {}

    def __missing__(self, text: str) -> bytes:
        packed = self.older.get(text)
        if packed is None:
            packed = self.make(text)
        return self.keep(text, packed)

    def keep(self, text: str, packed: bytes) -> bytes:
        if len(text) <= LONGEST_REMEMBERED:
            if len(self) >= self.most:
                self.older = dict(self)
                self.clear()
            self[text] = packed
        return packed


class _Words(_Remembered):
    """Words by what follows the space before them.

    Marks at the end of a word are a piece of their own, so such a word is put together from two parts. It is kept only if
    the bare word has been met before, and a word with white space in it is not kept at all: most of them never return. A line
end between two words is a piece of its own.
    """

    def __init__(self, make, merge, pieces: _Remembered, most: int):
        super().__init__(make, most)
        self.merge, self.pieces = merge, pieces

    def __missing__(self, text: str) -> bytes:
        if text.isalpha():
            packed = self.older.get(text)
            if packed is None:
                ids = [t.id for t in self.merge(SPACE + text if text.isascii() else _spelled(" " + text))]
                packed = _pack(ids)
            if len(text) <= LONGEST_REMEMBERED:
                if len(self) >= self.most:
                    self.older = dict(self)
                    self.clear()
                self[text] = packed
            return packed
        head = text.rstrip(string.punctuation)
        if head != text and head.isalpha():
            known, marks = self.get(head), self.pieces[text[len(head):]]
            return self[head] + marks if known is None else self.keep(text, known + marks)
        if "\n" in text:
            before, _, after = text.partition("\n")
            if before and after and not before[-1].isspace() and after.isalpha():
                return self[before] + self.pieces["\n"] + self.pieces[after]
            return self.make(text)
        return super().__missing__(text)


def cuts_by_pattern(tokenizer) -> bool:
    """Does the vocabulary cut by the byte-level pattern, with nothing before or after that looks past a piece?"""
    said = json.loads(tokenizer.to_str())
    cut, model = said["pre_tokenizer"] or {}, said["model"]
    return (
        said["normalizer"] is None and cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space") and cut.get("use_regex", True)
        and model["type"] == "BPE" and not model.get("dropout") and not said.get("truncation") and not said.get("padding")
    )


class Encoder:
    """Packed little-endian unsigned 32-bit ids of texts."""

    def __init__(self, vocabulary: str, words: int = WORDS):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(vocabulary)
        self._by_pieces = cuts_by_pattern(self._tokenizer)
        self._cut = regex.compile(PIECES).findall
        self._cut_ascii = re.compile(ASCII_PIECES).findall
        self._plain = re.compile(PLAIN).fullmatch
        self._specials = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._merge = self._tokenizer.model.tokenize
        self._pieces = _Remembered(self._piece, PIECES_KEPT)
        self._words = _Words(lambda word: self._in_pieces(" " + word), self._merge, self._pieces, words)

    def _whole(self, text: str) -> bytes:
        return _pack(self._tokenizer.encode(text, add_special_tokens=False).ids)

    def _piece(self, piece: str) -> bytes:
        return _pack([t.id for t in self._merge(_spelled(piece))])

    def _in_pieces(self, text: str) -> bytes:
        cut = self._cut_ascii if text.isascii() else self._cut
        return b"".join([self._pieces[piece] for piece in cut(text)])

    def packed(self, text: str | None, end_id: int | None = END_ID) -> bytes:
        """Ids of ``text`` (None: empty), then ``end_id`` unless that is None."""
        end = b"" if end_id is None else struct.pack("<I", end_id)
        if not text:
            return end
        if not self._by_pieces or not self._plain(text) or any(special in text for special in self._specials):
            return self._whole(text) + end
        if RUN.search(text):
            return self._in_pieces(text) + end
        first, *words = text.split(" ")
        return self._in_pieces(first) + b"".join(map(self._words.__getitem__, words)) + end


@functools.cache
def encoder(vocabulary: str, words: int = WORDS) -> Encoder:
    """One encoder per worker process and number of words it remembers."""
    return Encoder(vocabulary, words)
