"""Pre-tokens of a tokenizers definition whose words end in a mark: lower case, white space dropped.

The definition's own normaliser and pre-tokenizer are the rule. Where they are the ones below, as in
the public vocabulary, texts of common characters take a shorter way to the same pre-tokens;
of any other definition every text goes through the library.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

# The normaliser and the pre-tokenizer that _PIECES stands for.
NORMALISERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
               {"type": "Lowercase"}]
SPLITTERS = [
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
     "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]

# The pattern as it reads for lower-case text of the characters in _PLAIN: printable ASCII,
# blanks, line ends and Latin-1 letters.
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^ \na-z0-9ß-öø-ÿ]+")
_PLAIN = re.compile(r"[ \n!-~À-ÖØ-öø-ÿ]*")


def byte_letters() -> dict[int, str]:
    """The byte alphabet of byte-level BPE: printable bytes stand for themselves, the
    others for the characters from 256 on, in order."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in kept]
    return {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Splitter:
    """Cuts texts at added tokens and into lower-case words, and words into pre-tokens."""

    def __init__(self, definition: str) -> None:
        from tokenizers import Tokenizer

        rules = json.loads(definition)
        self.library = Tokenizer.from_str(definition)
        self.added = {t["content"]: t["id"] for t in rules["added_tokens"]}
        # added tokens that the library looks for in the raw text, as whole strings
        self.raw = all(not (t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"])
                  for t in rules["added_tokens"])
        self.known = (self.raw and (rules["normalizer"] or {}).get("normalizers") == NORMALISERS
                      and (rules["pre_tokenizer"] or {}).get("pretokenizers") == SPLITTERS)
        names = sorted(map(re.escape, self.added), key=len, reverse=True)
        self.marks = re.compile("(" + "|".join(names) + ")") if names else None
        self.letters = byte_letters()

    def spelled(self, piece: str) -> str:
        """A pre-token in the byte alphabet."""
        return piece if piece.isascii() else "".join(map(self.letters.__getitem__, piece.encode()))

    def parts(self, text: str) -> Iterator[tuple[int | None, str]]:
        """(id, string) of each added token and (None, text) of what is between them."""
        if self.marks is None:
            yield None, text
            return
        for i, part in enumerate(self.marks.split(text)):
            if part:
                yield (self.added[part] if i % 2 else None), part

    def plain_words(self, text: str) -> list[str] | None:
        """The words of a text (some may be empty) if all of it is plain and holds no added token."""
        if not self.known or not _PLAIN.fullmatch(text) or (self.marks and self.marks.search(text)):
            return None
        return text.lower().replace("\n", " ").split(" ")

    def words(self, text: str) -> Iterator[tuple[bool, str]]:
        """The words of a text without added tokens; the flag says that a word is plain and in lower
        case. No pre-token crosses a blank or a line end, and normalisation neither. By other rules
        the whole text is one word."""
        if not self.known:
            yield False, text
            return
        if _PLAIN.fullmatch(text):
            for word in text.lower().replace("\n", " ").split(" "):
                if word:
                    yield True, word
            return
        for word in text.replace("\n", " ").split(" "):
            if word:
                plain = _PLAIN.fullmatch(word) is not None
                yield plain, word.lower() if plain else word

    def pieces(self, plain: bool, word: str) -> list[str]:
        """The pre-tokens of a word in the byte alphabet."""
        if plain:
            return [self.spelled(p) for p in _PIECES.findall(word)]
        made = self.library.normalizer.normalize_str(word) if self.library.normalizer else word
        if self.library.pre_tokenizer is None:
            return [made]
        return [p for p, _ in self.library.pre_tokenizer.pre_tokenize_str(made)]
