"""Cheapest edits that give a conversation the role order ``(s?(ua)+)?``, as a dynamic program over persistent audits.

A turn is one character: ``u``, ``a``, ``s`` or ``x`` (any other role) if it may be kept, the upper-case letter
if it is truncated (5 more unless deleted) and ``d`` if it must go. Edits are K(eep) 0, R(erole to user or
assistant) 1, D(elete) 2 and I(nsert user or assistant) 5. The place in the role order is one of four states,
so an audit (the edits' letters in order) settles which role every rerole and insert gives.

An edit prefix is a node linked to the prefix it extends; states and candidates share their common part. Nodes
hold binary-lifting ancestors and a rolling hash of the whole prefix, so equally cheap audits are ordered by a
search for their longest common prefix; equal hashes are then verified letter by letter up to the shared node.
Equally cheap audits of the same turns never extend each other (the longer would hold more inserts), which is
why the least prefix per state stays the least.
"""

from __future__ import annotations

from functools import lru_cache

START, SYSTEM, USER, ASSISTANT = range(4)
AFTER_USER = {START: USER, SYSTEM: USER, ASSISTANT: USER}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
_PRIME, _BASE = (1 << 61) - 1, 0x1F3D5B79A7C9E
Best = dict[int, tuple[int, int]]


def role_step(state: int, initial: str) -> int | None:
    """The state after a turn with this role initial, if the role order allows it."""
    if initial == "u":
        return AFTER_USER.get(state)
    if initial == "a":
        return ASSISTANT if state == USER else None
    return SYSTEM if initial == "s" and state == START else None


def next_role(state: int) -> str:
    """The only one of user and assistant that may follow."""
    return "assistant" if state == USER else "user"


class Audits:
    """A growing tree of edit prefixes; node 0 is the empty one."""

    def __init__(self) -> None:
        self.letter, self.depth, self.hash = [""], [0], [0]
        self.up: list[list[int]] = [[]]

    def add(self, parent: int, letter: str) -> int:
        up, k = [parent], 0
        while k < len(self.up[up[k]]):
            up.append(self.up[up[k]][k])
            k += 1
        self.letter.append(letter)
        self.depth.append(self.depth[parent] + 1)
        self.hash.append((self.hash[parent] * _BASE + ord(letter)) % _PRIME)
        self.up.append(up)
        return len(self.letter) - 1

    def lift(self, node: int, steps: int) -> int:
        k = 0
        while steps:
            if steps & 1:
                node = self.up[node][k]
            steps >>= 1
            k += 1
        return node

    def divide(self, a: int, b: int) -> tuple[int, int] | None:
        """The first differing nodes below the shared node of two equally long prefixes, letter by letter."""
        found = None
        while a != b:
            if self.letter[a] != self.letter[b]:
                found = a, b
            a, b = self.up[a][0], self.up[b][0]
        return found

    def before(self, a: int, b: int) -> bool:
        """Whether the letters of ``a`` sort before those of ``b``."""
        n = min(self.depth[a], self.depth[b])
        x, y = self.lift(a, self.depth[a] - n), self.lift(b, self.depth[b] - n)
        if self.hash[x] == self.hash[y]:
            split = self.divide(x, y)  # equal unless the hashes collide
            if split is None:
                return self.depth[a] < self.depth[b]
            x, y = split
        else:
            for k in range(len(self.up[x]) - 1, -1, -1):
                if k < len(self.up[x]) and self.hash[self.up[x][k]] != self.hash[self.up[y][k]]:
                    x, y = self.up[x][k], self.up[y][k]
            x, y = self.divide(self.up[x][0], self.up[y][0]) or (x, y)
        return self.letter[x] < self.letter[y]

    def text(self, node: int) -> str:
        out = []
        while node:
            out.append(self.letter[node])
            node = self.up[node][0]
        return "".join(reversed(out))

    def offer(self, best: Best, state: int, cost: int, parent: int, letter: str) -> bool:
        """Take this extension for the state if it is cheaper, or as cheap and least."""
        held = best.get(state)
        if held is not None and held[0] < cost:
            return False
        node = self.add(parent, letter)
        if held is not None and held[0] == cost and not self.before(node, held[1]):
            return False
        best[state] = cost, node
        return True

    def inserts(self, best: Best) -> None:
        again = True
        while again:
            again = False
            for state in sorted(best):
                cost, node = best[state]
                again |= self.offer(best, USER if state != USER else ASSISTANT, cost + INSERT, node, "I")

    def turn(self, best: Best, code: str) -> Best:
        """Every state after one more turn, with inserts before it."""
        self.inserts(best)
        out: Best = {}
        initial, more = code.lower(), TRUNCATED if code.isupper() else 0
        for state, (cost, node) in sorted(best.items()):
            self.offer(out, state, cost + DELETE, node, "D")
            if code == "d":
                continue
            kept = role_step(state, initial)
            if kept is not None:
                self.offer(out, kept, cost + KEEP + more, node, "K")
            self.offer(out, ASSISTANT if state == USER else USER, cost + REROLE + more, node, "R")
        return out


def paths(codes: str, start: int, last: bool) -> dict[int, tuple[int, str]]:
    """Cost and least audit to every state from one state; inserts after the last turn only where it is the last."""
    audits, best = Audits(), {start: (0, 0)}
    for code in codes:
        best = audits.turn(best, code)
    if last:
        audits.inserts(best)
    return {state: (cost, audits.text(node)) for state, (cost, node) in best.items()}


def _cheapest(codes: str) -> tuple[int, str]:
    ends = paths(codes, START, True)
    return min(ends[s] for s in (START, ASSISTANT) if s in ends)


_remembered = lru_cache(1 << 16)(_cheapest)


def cheapest(codes: str) -> tuple[int, str]:
    """Cost and least audit of a whole conversation; short ones are remembered, as many are alike."""
    return _remembered(codes) if len(codes) <= 64 else _cheapest(codes)


Table = dict[tuple[int, int], tuple[int, str]]


def segment(codes: str, last: bool) -> Table:
    """Cost and least audit of a run of turns between every two states."""
    return {(start, end): found for start in range(4) for end, found in paths(codes, start, last).items()}


def joined(left: Table, right: Table) -> Table:
    """The table of two runs that follow each other; whole audits decide between equally cheap ones."""
    out: Table = {}
    for (start, middle), (cost, audit) in left.items():
        for (entered, end), (more, rest) in right.items():
            if entered != middle:
                continue
            held = out.get((start, end))
            if held is None or (cost + more, audit + rest) < held:
                out[start, end] = cost + more, audit + rest
    return out


class Replay:
    """Applies an audit to turns that come one at a time, in order."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.state = audit, 0, START

    def _inserted(self):
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            role = next_role(self.state)
            self.state, self.at = role_step(self.state, role[0]), self.at + 1
            yield role, ""

    def turn(self, role: str, text: str):
        """The turns that this turn becomes, inserted ones before it first."""
        yield from self._inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "D":
            return
        if edit == "R":
            role = next_role(self.state)
        self.state = role_step(self.state, role[:1])
        yield role, text

    def end(self):
        yield from self._inserted()
