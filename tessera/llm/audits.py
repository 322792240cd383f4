"""Persistent edit strings and the repair DP over them.

A string is a node: its last letter, its parent, a rolling hash of the whole and its
ancestors 1, 2, 4, ... letters up.  Strings share their prefixes, so a step of the DP
adds a node and copies nothing.  Two strings are compared by a search for their
longest common prefix over the ancestors' hashes; nodes whose hashes agree are
walked letter by letter before they count as equal.
"""

from __future__ import annotations

from collections.abc import Iterator

_MOD = (1 << 61) - 1
_BASE = 1_000_003


class Strings:
    def __init__(self, base: int = _BASE, mod: int = _MOD):
        self.base, self.mod = base, mod
        self.parent, self.letter, self.depth = [0], [""], [0]
        self.digest: list[int] = [0]
        self.up: list[list[int]] = [[]]

    def add(self, node: int, letter: str) -> int:
        """The string of ``node`` and one letter more."""
        self.parent.append(node)
        self.letter.append(letter)
        self.depth.append(self.depth[node] + 1)
        self.digest.append((self.digest[node] * self.base + ord(letter)) % self.mod)
        above, k, a = [node], 0, node
        while k < len(self.up[a]):
            a = self.up[a][k]
            above.append(a)
            k += 1
        self.up.append(above)
        return len(self.parent) - 1

    def prefix(self, node: int, depth: int) -> int:
        """The ancestor of ``depth`` letters."""
        rest = self.depth[node] - depth
        while rest:
            k = rest.bit_length() - 1
            node = self.up[node][k]
            rest -= 1 << k
        return node

    def equal(self, a: int, b: int) -> bool:
        """Whether two strings of one length are equal: hashes first, then letters."""
        if a == b:
            return True
        if self.digest[a] != self.digest[b]:
            return False
        while a != b:
            if self.letter[a] != self.letter[b]:
                return False
            a, b = self.parent[a], self.parent[b]
        return True

    def less(self, x: int, y: int) -> bool:
        depth = min(self.depth[x], self.depth[y])
        a, b = self.prefix(x, depth), self.prefix(y, depth)
        if self.equal(a, b):
            return self.depth[x] < self.depth[y]
        for k in range(depth.bit_length() - 1, -1, -1):
            if k < len(self.up[a]) and not self.equal(self.up[a][k], self.up[b][k]):
                a, b = self.up[a][k], self.up[b][k]
        return self.letter[a] < self.letter[b]

    def common(self, x: int, y: int) -> int:
        """The last node that two strings share."""
        depth = min(self.depth[x], self.depth[y])
        a, b = self.prefix(x, depth), self.prefix(y, depth)
        if a == b:
            return a
        for k in range(depth.bit_length() - 1, -1, -1):
            if k < len(self.up[a]) and self.up[a][k] != self.up[b][k]:
                a, b = self.up[a][k], self.up[b][k]
        return self.parent[a]

    def letters(self, node: int, above: int = 0) -> str:
        """What follows the ancestor ``above`` in the string of ``node``."""
        out = []
        while node != above:
            out.append(self.letter[node])
            node = self.parent[node]
        return "".join(reversed(out))


#: States of ``(s?(ua)+)?``: nothing yet, after s, after u, after a.
_EMPTY, _S, _U, _A = range(4)
_KEEP = {(_EMPTY, "s"): _S, (_EMPTY, "u"): _U, (_S, "u"): _U, (_U, "a"): _A, (_A, "u"): _U}
_NEXT = {_EMPTY: _U, _S: _U, _U: _A, _A: _U}
_INSERT, _DELETE, _REROLE, _TRUNCATED = 5, 2, 1, 5


class Repair:
    """The cheapest edits of one conversation, row by row.

    Holds the best edit string for each state.  Every ``settle`` rows the prefix
    that all of them share is given out with its rows and forgotten, so that memory
    follows the open part of a conversation and not its length.
    """

    def __init__(self, settle: int = 1024):
        self.settle = settle
        self.strings = Strings()
        self.best: dict[int, tuple[int, int]] = {_EMPTY: (0, 0)}
        self.open: list[tuple[str, str]] = []
        self.state = _EMPTY

    def _offer(self, best: dict, state: int, cost: int, node: int, letter: str) -> None:
        held = best.get(state)
        if held is not None and cost > held[0]:
            return
        new = self.strings.add(node, letter)
        if held is None or cost < held[0] or self.strings.less(new, held[1]):
            best[state] = (cost, new)

    def _inserted(self) -> dict:
        """States reached by Inserts as well: one leads to u, one more to a; a third
        would come back to u at a higher cost."""
        best = dict(self.best)
        for state in (_EMPTY, _S, _A):
            if state in self.best:
                cost, node = self.best[state]
                self._offer(best, _U, cost + _INSERT, node, "I")
        if _U in best:
            cost, node = best[_U]
            self._offer(best, _A, cost + _INSERT, node, "I")
        return best

    def _forget(self) -> None:
        """Drops states that cannot win any more: what may follow nothing or s may follow
        a too, at no more cost but for the Delete of an s that nothing would have kept."""
        at_a = min((self.best[q][0] + more for q, more in ((_A, 0), (_U, _INSERT)) if q in self.best),
                   default=None)
        for state, more in ((_EMPTY, _DELETE), (_S, 0)):
            if at_a is not None and state in self.best and self.best[state][0] > at_a + more:
                del self.best[state]

    def add(self, role: str, text: str, fault: str | None) -> Iterator[tuple[str, str, str]]:
        """Takes a row; gives out the edits (letter, role, text) that are settled."""
        after: dict[int, tuple[int, int]] = {}
        for state, (cost, node) in self._inserted().items():
            self._offer(after, state, cost + _DELETE, node, "D")
            if fault in ("blank", "duplicate"):
                continue
            cost += _TRUNCATED * (fault == "truncated")
            kept = _KEEP.get((state, role[:1]))
            if kept is not None:
                self._offer(after, kept, cost, node, "K")
            self._offer(after, _NEXT[state], cost + _REROLE, node, "R")
        self.best = after
        self._forget()
        self.open.append((role, text))
        if len(self.open) >= self.settle:
            shared = None
            for _, node in after.values():
                shared = node if shared is None else self.strings.common(shared, node)
            yield from self._give(self.strings.letters(shared))
            old, self.strings = self.strings, Strings()
            made = {"": 0}
            for state, (cost, node) in after.items():
                tail = old.letters(node, shared)
                for k in range(len(tail)):
                    if tail[:k + 1] not in made:
                        made[tail[:k + 1]] = self.strings.add(made[tail[:k]], tail[k])
                self.best[state] = (cost, made[tail])
            self.settle = max(self.settle, 2 * len(self.open))

    def _give(self, edits: str) -> Iterator[tuple[str, str, str]]:
        at = 0
        for e in edits:
            if e == "I":
                self.state = _NEXT[self.state]
                yield e, "user" if self.state == _U else "assistant", ""
                continue
            role, text = self.open[at]
            at += 1
            if e == "K":
                self.state = _KEEP[self.state, role[:1]]
            elif e == "R":
                self.state = _NEXT[self.state]
                role = "user" if self.state == _U else "assistant"
            yield e, role, text
        del self.open[:at]

    def finish(self) -> tuple[int, list[tuple[str, str, str]]]:
        """The cost of all edits, and those not given out before."""
        best = self._inserted()
        cost, node = best[_EMPTY] if _EMPTY in best else best[_A]
        if _EMPTY in best and _A in best and (
                best[_A][0] < cost or best[_A][0] == cost and self.strings.less(best[_A][1], node)):
            cost, node = best[_A]
        return cost, list(self._give(self.strings.letters(node)))
