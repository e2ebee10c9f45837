"""Byte-pair encoding by a table over prefixes.

The encoding of a string's prefix ends in exactly one token, and that token fits the last
token of the prefix before it: the two stay apart when their joint text is encoded. Going
left to right, the table keeps for every prefix its last token, found among the
vocabulary entries that end there (an automaton names them) by testing the pair. Ids come
out backwards from the end, and the number of tokens of every prefix adds up on the way.

A pair is tested by merging its text in the order the vocabulary prescribes. Whatever
merges first across a token boundary in a whole text would do so in the pair alone, since
all that precede it stay within tokens; so tokens that fit pairwise fit as a whole.
"""

from __future__ import annotations

from collections.abc import Callable

import ahocorasick

#: Entries of a memory of words or pairs in one Python worker.
MEMORY = 300_000


class PrefixTable:
    """``tokens`` maps a token's text to its id, ``rank(a, b)`` gives the priority of
    merging two adjacent texts (lower first, leftmost on a tie) or None. A character in
    no token is a token of its own, with the id None."""

    def __init__(self, tokens: dict[str, int], rank: Callable[[str, str], float | None]):
        self.tokens = tokens
        self.rank = rank
        self.tested = 0
        #: token -> which tokens fit after it, as far as tested
        self.after: dict[str, dict[str, bool]] = {}
        self.automaton = ahocorasick.Automaton()
        for text in tokens:
            if len(text) == 1 or self.merged(text) == [text]:
                self.automaton.add_word(text, (text, len(text), self.after.setdefault(text, {})))
        self.automaton.make_automaton()

    def merged(self, text: str) -> list[str]:
        """The text's tokens by merging in order; for short texts."""
        parts = list(text)
        rank = self.rank
        ranks = [rank(a, b) for a, b in zip(parts, parts[1:])]
        while True:
            best, at = None, -1
            for i, r in enumerate(ranks):
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del ranks[at]
            if at:
                ranks[at - 1] = rank(parts[at - 1], parts[at])
            if at < len(ranks):
                ranks[at] = rank(parts[at], parts[at + 1])

    def fits(self, left: str, right: str) -> bool:
        if self.tested >= MEMORY:
            self.tested = 0
            for tests in self.after.values():
                tests.clear()
        self.tested += 1
        known = self.merged(left + right) == [left, right]
        self.after.setdefault(left, {})[right] = known
        return known

    def last_tokens(self, text: str) -> list[str]:
        """For every prefix but the empty one, the last token of its encoding."""
        last: list[str | None] = [None] * len(text)
        after: list[dict[str, bool] | None] = [None] * len(text)
        for end, (token, length, own) in self.automaton.iter(text):
            if last[end] is None:
                before = end - length
                if before >= 0:
                    tests = after[before]
                    if tests is None:  # a character in no token
                        last[before] = text[before]
                        tests = after[before] = self.after.setdefault(text[before], {})
                    fits = tests.get(token)
                    if fits is None:
                        fits = self.fits(last[before], token)
                    if not fits:
                        continue
                last[end] = token
                after[end] = own
        return [text[i] if t is None else t for i, t in enumerate(last)] if None in last else last

    def encode(self, text: str) -> list[str]:
        """Tokens read backwards from the table."""
        last, at, out = self.last_tokens(text), len(text), []
        while at:
            out.append(last[at - 1])
            at -= len(out[-1])
        out.reverse()
        return out

    def counts(self, text: str) -> list[int]:
        """Number of tokens of every prefix, the empty one first."""
        out = [0]
        for i, token in enumerate(self.last_tokens(text)):
            out.append(out[i + 1 - len(token)] + 1)
        return out


class Memory:
    """What was met lately, in two generations: when the new one is full it becomes the
    old one, and what is still asked for moves over, so common words stay."""

    def __init__(self, make: Callable[[str], object], size: int = MEMORY):
        self.make, self.size = make, size
        self.new: dict[str, object] = {}
        self.old: dict[str, object] = {}

    def missed(self, word: str):
        found = self.old.get(word)
        if found is None:
            found = self.make(word)
        if len(word) <= 64:
            if len(self.new) >= self.size:
                self.old, self.new = self.new, {}
            self.new[word] = found
        return found
