"""Minimised acceptors of word lists, and pairs at one edit by composing them with a one-edit transducer."""

from __future__ import annotations

from collections.abc import Iterator, Sequence


def common_start(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


class Acceptor:
    """The smallest acyclic acceptor of sorted distinct words, built word by word.

    States that accept the same endings are one state; a state's number exceeds those it leads to.
    """

    def __init__(self, words: Sequence[str]) -> None:
        self.arcs: list[dict[str, int]] = []
        self.final: list[bool] = []
        self.lengths: list[tuple[int, int]] = []  # of the shortest and the longest ending
        known: dict[tuple[object, ...], int] = {}
        path: list[dict[str, int]] = [{}]
        ends: list[bool] = [False]
        previous = ""

        def settle(depth: int) -> None:
            while len(path) > depth:
                arcs, end = path.pop(), ends.pop()
                key = (end, *arcs.items())
                state = known.get(key)
                if state is None:
                    state = known[key] = len(self.arcs)
                    below = [self.lengths[s] for s in arcs.values()]
                    least = 0 if end else 1 + min((b[0] for b in below), default=-1)
                    self.arcs.append(arcs)
                    self.final.append(end)
                    self.lengths.append((least, max((1 + b[1] for b in below), default=0)))
                if path:
                    path[-1][previous[len(path) - 1]] = state
                else:
                    self.start = state

        for word in words:
            same = common_start(previous, word)
            settle(same + 1)
            for _ in range(len(word) - same):
                path.append({})
                ends.append(False)
            ends[-1] = True
            previous = word
        settle(0)

    def endings(self, state: int, length: int) -> Iterator[str]:
        """The endings of this length that a state accepts."""
        stack = [(state, "")]
        while stack:
            at, read = stack.pop()
            rest = length - len(read)
            low, high = self.lengths[at]
            if not low <= rest <= high:
                continue
            if not rest:
                yield read
            else:
                stack.extend((to, read + c) for c, to in self.arcs[at].items())

    def shared_endings(self, a: int, b: int, length: int) -> Iterator[str]:
        """The endings of this length that both states accept."""
        stack = [(a, b, "")]
        while stack:
            x, y, read = stack.pop()
            rest = length - len(read)
            (low, high), (low_y, high_y) = self.lengths[x], self.lengths[y]
            if not (low <= rest <= high and low_y <= rest <= high_y):
                continue
            if x == y:
                yield from (read + tail for tail in self.endings(x, rest))
            elif not rest:
                yield read
            else:
                arcs = self.arcs[y]
                stack.extend((to, arcs[c], read + c) for c, to in self.arcs[x].items() if c in arcs)


def one_edit_pairs(words: Sequence[str], length: int, least: int) -> Iterator[tuple[str, str]]:
    """Pairs at one edit of sorted distinct words of ``length`` or one more, that agree in their first ``least`` letters.

    The shorter word of a pair has ``length`` letters. Composed with the transducer's state before
    its edit, both acceptors are in one and the same state, so only a walk over single states is
    needed up to the edit, and what can follow it depends on that state and the letters left alone.
    Of the places where a letter can be inserted with one result the last is taken, so no pair comes
    twice and the edit follows the longest common start.
    """
    accept = Acceptor(words)
    after: dict[tuple[int, int], list[tuple[str, str]]] = {}

    def edits(state: int, rest: int) -> list[tuple[str, str]]:
        arcs = list(accept.arcs[state].items())
        found = []
        for i, (c, to) in enumerate(arcs):
            if rest:
                for other, there in arcs[i + 1 :]:
                    found += [(c + t, other + t) for t in accept.shared_endings(to, there, rest - 1)]
            found += [(t, c + t) for t in accept.shared_endings(state, to, rest) if t[:1] != c]
        return found

    letters: list[str] = []
    stack = [(accept.start, 0, "")]
    while stack:
        state, depth, letter = stack.pop()
        del letters[max(0, depth - 1) :]
        letters.append(letter)
        rest = length - depth
        if depth >= least and rest >= 0:
            key = (state, rest)
            pairs = after.get(key)
            if pairs is None:
                pairs = after[key] = edits(state, rest)
            if pairs:
                start = "".join(letters)
                for x, y in pairs:
                    yield start + x, start + y
        stack.extend((to, depth + 1, c) for c, to in accept.arcs[state].items())
