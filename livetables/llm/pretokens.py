"""Encoding whole texts through a bounded cache of their words.

The tokenizers used here split a text by a pattern before they merge, and no
pre-token holds a space or a line break except at its start or within a run of
white space. So a text may be cut before a single space between two non-space
characters, around a single line break between two of them, and between letters
and the marks that close them, without changing any id. The cut pieces repeat a lot;
each distinct one of many texts is looked up once, and encoded once per worker, many
texts' new pieces in one call. Texts with other white space are encoded whole.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pyarrow as pa
import pyarrow.compute as pc

#: Encodes several strings, each to little-endian unsigned 32-bit ids.
EncodeMany = Callable[[Sequence[str]], list[bytes]]

# Fixed value: marks that stay together after a letter (an apostrophe may go with the letters behind it).
_MARKS = ".,;:!?\"#$%&()*+-/<=>@[\\]^_`{|}~"


class _Known(dict):
    """Ids of pieces in two generations: what is still used moves on when the older one is dropped."""

    def __init__(self) -> None:
        self.older: dict[str, bytes] = {}
        self.new: list[str] = []

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            self.new.append(piece)
            return b""
        self[piece] = ids
        return ids


class WordCache:
    """Ids of whole texts.

    Holds at most about 2 * `max_words` pieces. `encode_words` may encode words
    of letters faster, each with the space before it, and `encode_lines` words without one
    at the start of a line; without them `encode_many` does.
    """

    def __init__(self, encode_many: EncodeMany, encode_words: EncodeMany | None = None, max_words: int = 600_000,
                 encode_lines: EncodeMany | None = None):
        self.encode_many, self.max_words = encode_many, max_words
        self.encode_words = encode_words or (lambda words: encode_many([" " + w for w in words]))
        self.encode_lines = encode_lines or encode_many
        self.marks = {"": b""}       # closing marks
        self.ids = _Known()          # words after a space, without it; line starts after a line break

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        """Ids of each text."""
        if len(self.ids) > self.max_words:
            fresh = _Known()
            fresh.older = dict(self.ids)
            self.ids = fresh
        cut = [self._marked(t) for t in texts]
        out = self._joined([c for c in cut if c is not None])
        if len(out) < len(cut):
            whole = [i for i, c in enumerate(cut) if c is None]
            for i, ids in zip(whole, self.encode_many([texts[i] for i in whole])):
                out.insert(i, ids)
        return out

    def _joined(self, marked: list[str]) -> list[bytes]:
        """Ids of each marked text. Each distinct piece of all of them is looked up once."""
        if not marked:
            return []
        cut = pc.split_pattern(pa.array(marked, pa.large_string()), " ")
        found = cut.values.dictionary_encode()
        pieces = found.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = list(map(self.ids.__getitem__, pieces))
        if self.ids.new:
            made = self._learn(self.ids.new)
            self.ids.new.clear()
            ids = [x or made[p] for x, p in zip(ids, pieces)]
        parts, ends = list(map(ids.__getitem__, found.indices.to_numpy().tolist())), cut.offsets.to_numpy().tolist()
        return [b"".join(parts[a:b]) for a, b in zip(ends, ends[1:])]

    @staticmethod
    def _marked(text: str) -> str | None:
        """A text with a space before each piece but the first; None if it can't be cut.

        Line starts keep their line break, the text's start a zero byte.
        """
        line = text.replace("\n", " ")
        if not line or line[0] == " " or line[-1] == " " or "  " in line:
            return None
        # printable: no white space but spaces, no zero byte; other texts are compared in full
        if not line.isprintable() and (" ".join(line.split()) != line or "\0" in line):
            return None
        return "\0" + text.replace("\n", " \n")

    def _learn(self, new: Sequence[str]) -> dict[str, bytes]:
        """Take in pieces that differ and are not known; their ids."""
        ids, older = self.ids, self.ids.older
        words, lines, marked, others = set(), set(), [], []
        for piece in new:
            word = piece.rstrip(_MARKS)
            if word.isalpha():
                if word is piece or word not in ids and word not in older:           # a new piece is in neither
                    words.add(word)
                if word is not piece:
                    marked.append((piece, word))
            elif word[1:].isalpha() and word[0] in "\n\0":
                lines.add(word[1:])
                marked.append((piece, word))
            else:
                others.append(piece)
        made = dict(zip(words, self.encode_words(list(words)))) if words else {}
        # line breaks stand by themselves, and a word at the start of a line or text has no space
        starts = {"\n": self.encode_many(["\n"])[0], "\0": b""}
        begun = dict(zip(lines, self.encode_lines(list(lines)))) if lines else {}
        if marked:
            if len(self.marks) > self.max_words:
                self.marks = {"": b""}
            asked = list({p[len(w):] for p, w in marked} - self.marks.keys())
            self.marks.update(zip(asked, self.encode_many(asked) if asked else ()))
            for piece, word in marked:
                start = starts.get(word[0])
                own = start + begun[word[1:]] if start is not None else made[word] if word in made else ids[word]
                made[piece] = own + self.marks[piece[len(word):]]
        if others:
            told = self.encode_many([p[1:] if p[0] in starts else " " + p for p in others])
            made.update((p, starts.get(p[0], b"") + x) for p, x in zip(others, told))
        ids.update(made)
        return made
