"""Forward states of byte-pair encodings.

Neighbouring symbols merge by rank, lowest first, then leftmost.  Piece t may
follow piece s iff merging s + t gives just [s, t]; a sequence all of whose
neighbours may follow each other is the encoding of its text, and each text
has one.  So the last piece of a prefix's encoding follows from the last
pieces of shorter prefixes, and a word's states serve every word that begins
alike.
"""

from __future__ import annotations

from functools import lru_cache

PAIRS = 1 << 18


class MergeStates:
    """``pieces``: the symbols that merging may give; ``rank(a, b)``: rank of merging two neighbours, or None.

    Texts may be str or bytes.  Symbols outside ``pieces`` merge with nothing."""

    def __init__(self, pieces, rank):
        self.pieces, self.rank = pieces, rank
        self.longest = max(map(len, pieces))
        self.follows = lru_cache(PAIRS)(self._follows)

    def merged(self, text) -> list:
        parts = [text[i:i + 1] for i in range(len(text))]
        while True:
            best, at = None, 0
            for i in range(len(parts) - 1):
                r = self.rank(parts[i], parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def _follows(self, s, t) -> bool:
        return self.merged(s + t if s else t) == ([s, t] if s else [t])

    def extend(self, word, last: list) -> None:
        """Appends the last pieces of the prefixes of ``word`` that ``last`` doesn't have yet; last[0] is None."""
        pieces, follows, longest = self.pieces, self.follows, self.longest
        for end in range(len(last), len(word) + 1):
            if word[end - 1:end] in pieces:
                for start in range(end - longest if end > longest else 0, end):
                    piece = word[start:end]
                    if piece in pieces:
                        before = last[start]
                        if follows(before if before in pieces else None, piece):
                            last.append(piece)
                            break
                else:
                    raise AssertionError(f"no encoding of {word[:end]!r}")
            else:
                last.append(word[end - 1:end])

    def walk(self, words):
        """(word, last pieces of its prefixes) of distinct words, depth first over their trie."""
        path, last = words[0][:0] if (words := sorted(words)) else None, [None]
        for word in words:
            most, shared = min(len(path), len(word)), 0
            while shared < most and path[shared] == word[shared]:
                shared += 1
            del last[shared + 1:]
            self.extend(word, last)
            yield word, last
            path = word


class Remembered:
    """Results by word in two generations of ``size`` words; forgetting only costs time."""

    def __init__(self, size: int, learn):
        self.size, self.learn = size, learn
        self.young: dict = {}
        self.old: dict = {}

    def of(self, wanted: list[list]):
        """A lookup that knows all words of the lists."""
        new = set().union(*wanted) - self.young.keys()
        if new and len(self.young) + len(new) > self.size:
            self.old, self.young = self.young, {}
            new = set().union(*wanted)
        known = {w: self.old[w] for w in new if w in self.old}
        self.young |= known
        self.young |= self.learn(new - known.keys())
        return self.young.__getitem__
