"""Encode texts word by word, with a bounded memory of the words that keep coming."""

from __future__ import annotations

import re
import string
from functools import lru_cache

#: A space before which a match of the splitting pattern never goes on: one that a non-space follows.
INNER_SPACE = re.compile(r" (?=\s|$)")
SAFE_SPACE = re.compile(r" (?=\S)")
#: Characters of a chunk that is remembered, and hashes of chunks that have come once.
LONGEST, SEEN = 64, (1 << 21) - 1
#: ASCII that is neither letter, digit nor white space.
PUNCTUATION = string.punctuation


def space_chunks(text: str) -> list[str]:
    """The text cut before each space that a non-space follows; the chunks join to the text."""
    if INNER_SPACE.search(text):
        cuts = [m.start() for m in SAFE_SPACE.finditer(text)]
        return [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)]) if a < b]
    first, *rest = text.split(" ")
    chunks = [" " + c for c in rest]
    return [first, *chunks] if first else chunks


def spaced_words(text: str) -> tuple[str, list[str]]:
    """What is before the first such space, and what is behind each of them up to the next."""
    if INNER_SPACE.search(text):
        cuts = [*(m.start() for m in SAFE_SPACE.finditer(text)), len(text)]
        return text[: cuts[0]], [text[a + 1 : b] for a, b in zip(cuts[:-1], cuts[1:])]
    first, *rest = text.split(" ")
    return first, rest


def lone_line_feeds(lines: list[str]) -> bool:
    """Whether the line feeds between the lines have no white space beside them."""
    return all(lines) and not any(x[-1].isspace() for x in lines) and not any(x[0].isspace() for x in lines[1:])


class WordMemory:
    """Ids of texts, packed, for tokenizers that end a piece before each space that a non-space follows.

    ``letters`` encodes one piece of letters, with or without a space before them; ``other`` any
    text. Where ``plain`` holds, the tokenizer also makes one piece of the punctuation behind
    letters, and one of a line feed between other characters: such chunks are put together from
    their parts. Chunks that come a second time are remembered, in two generations, under what is
    behind their space; those without one under a NUL and themselves.
    """

    def __init__(self, most: int, letters, other, plain: bool, cut=spaced_words):
        self.most, self.letters, self.other, self.plain, self.cut = most, letters, other, plain, cut
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.seen = bytearray(SEEN + 1)
        self.short = lru_cache(10_000)(other)

    def encode(self, text: str) -> bytes:
        if len(self.known) > self.most:
            # Chunks that keep coming move over from the older generation.
            self.known, self.older, self.seen = {}, self.known, bytearray(SEEN + 1)
        get, rare = self.known.get, self.rare
        first, rest = self.cut(text)
        ids = b"".join([get(c) or rare(c) for c in rest])
        return self.bare(first) + ids if first else ids

    def rare(self, chunk: str) -> bytes:
        """Ids of a space and a chunk that is not in the present generation."""
        ids = self.older.get(chunk)
        if ids is not None:
            self.known[chunk] = ids
            return ids
        if self.plain:
            word = chunk.rstrip(PUNCTUATION)
            if word.isalpha():
                if len(word) == len(chunk):
                    return self.kept(chunk, self.letters(" " + chunk))
                ids = self.known.get(word) or self.older.get(word) or self.kept(word, self.letters(" " + word))
                return ids + self.short(chunk[len(word) :])
            lines = chunk.split("\n")
            if len(lines) > 1 and lone_line_feeds(lines):
                first = self.known.get(lines[0]) or self.rare(lines[0])
                return self.short("\n").join([first, *map(self.bare, lines[1:])])
        return self.kept(chunk, self.other(" " + chunk))

    def bare(self, chunk: str) -> bytes:
        """Ids of a chunk without a space before it."""
        key = "\0" + chunk
        ids = self.known.get(key) or self.older.get(key)
        if ids is not None:
            return ids
        if self.plain:
            word = chunk.rstrip(PUNCTUATION)
            if word.isalpha():
                if len(word) == len(chunk):
                    return self.kept(key, self.letters(chunk))
                return self.bare(word) + self.short(chunk[len(word) :])
            lines = chunk.split("\n")
            if len(lines) > 1 and lone_line_feeds(lines):
                return self.short("\n").join(map(self.bare, lines))
        return self.kept(key, self.other(chunk))

    def kept(self, chunk: str, ids: bytes) -> bytes:
        """Remember the ids if the chunk has come before, or shares the hash of one that has."""
        place = hash(chunk) & SEEN
        if not self.seen[place]:
            self.seen[place] = 1
        elif len(chunk) <= LONGEST:
            self.known[chunk] = ids
        return ids
