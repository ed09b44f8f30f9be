"""Token ids of whole texts, by a public tokenizer, with the ids of frequent words kept."""

from __future__ import annotations

import re
from array import array
from functools import cache

# White space next to white space, and the places before a blank that follows another character.
NEXT_TO_EACH_OTHER = re.compile(r"\s\s")
BEFORE_BLANK = re.compile(r"(?<=\S)(?= )")

# Letters that any version of Unicode has, and marks, without the apostrophe, which
# may start a token of letters.
LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
SPECIAL = re.compile(r"<\|.*\|>")

LONGEST = 64  # characters of a string that is held
ENTRY_BYTES = 160  # of memory that an entry takes besides its characters and ids


def byte_letters() -> dict[int, int]:
    """The characters that stand for bytes in a byte-level vocabulary: a byte that prints in
    Latin-1 for itself, the others, in order, from 256 on."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in prints]
    return {b: 256 + i for i, b in enumerate(others)}


class _Encoded(dict):
    """Ids by string, as little-endian unsigned 32-bit bytes.

    What is held takes at most about twice ``most`` bytes: when that much is new since the last time, what
    was not looked up in between is forgotten.  Strings longer than ``LONGEST`` are never held: in
    text without blanks they are whole lines, or texts, which seldom come again.
    """

    def __init__(self, tokenizer, before: str, most: int, marks: _Encoded | None = None):
        super().__init__()
        self.encode, self.model, self.letters = tokenizer.encode, tokenizer.model, byte_letters()
        self.before, self.most, self.older, self.bytes = before, most, {}, 0
        self.blank = chr(self.letters[ord(" ")])
        self.marks = self if marks is None else marks

    def __missing__(self, part: str) -> bytes:
        if len(part) > LONGEST:
            return self._encoded(part)
        if self.bytes >= self.most:
            self.older, self.bytes = dict(self), 0
            self.clear()
        found = self.older.get(part)
        if found is None:
            found = self._encoded(part)
        self[part] = found
        self.bytes += ENTRY_BYTES + 4 * len(part) + len(found)
        return found

    def _encoded(self, part: str) -> bytes:
        if LETTERS.fullmatch(part):
            # Letters, with a blank before them or not, are one piece for the model.
            piece = self.before + part
            if piece.isascii():
                piece = piece.replace(" ", self.blank)
            else:
                piece = piece.encode().decode("latin-1").translate(self.letters)
            return array("I", [token.id for token in self.model.tokenize(piece)]).tobytes()
        word = part.rstrip(MARKS)
        if word != part and LETTERS.fullmatch(word) and not SPECIAL.search(part):
            return self[word] + self.marks[part[len(word) :]]  # they never share a token
        ids = self.encode(self.before + part, add_special_tokens=False).ids
        return array("I", ids).tobytes()


class ByteBpe:
    """A byte-level BPE tokenizer from a ``tokenizers`` file.

    Such a tokenizer first cuts a text by a pattern none of whose matches goes on from
    another character into white space.  So a text may be cut before each blank that
    follows another character, and each part encoded on its own, or looked up.  Where
    single blanks and line breaks are the only white space between words, plain splitting
    finds the parts.  The result is that of encoding the whole text.
    """

    def __init__(self, path: str, most: int = 56_000_000):
        """``most`` bytes of strings and ids are held, for words behind a blank, and an eighth for others."""
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.first = _Encoded(tokenizer, "", most // 8)
        self.after_blank = _Encoded(tokenizer, " ", most, self.first)

    def ids(self, text: str | None) -> bytes:
        """The ids of ``text`` as little-endian unsigned 32-bit integers; none for None."""
        if not text:
            return b""
        if NEXT_TO_EACH_OTHER.search(text):
            return b"".join(map(self.first.__getitem__, BEFORE_BLANK.split(text)))
        found, line_break, after_blank = [], self.first["\n"], self.after_blank.__getitem__
        for line in text.split("\n"):
            words = line.split(" ")
            found.append(self.first[words[0]])
            del words[0]
            found.extend(map(after_blank, words))
            found.append(line_break)
        found.pop()
        return b"".join(found)


@cache
def byte_bpe(path: str) -> ByteBpe:
    """One for each Python process and file."""
    return ByteBpe(path)
