"""Generalised LR repair of role sequences over a graph-structured stack.

The parser follows all stacks at once.  A stack is its top state and the stack below, so stacks
share their tails, and equal stacks are one entry of the frontier with the least (cost, audit).
Besides shifting, a step may delete a row, give it another role, or insert a role.

Comparing (cost, audit) early is exact: of two audits of equal cost over the same rows none begins
with the other (the longer one would hold more insertions and cost more), so what follows cannot
change their order.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import takewhile

#: (s?(ua)+)? with the first letters of system, user and assistant.
GRAMMAR = [
    ("Chat", ()),
    ("Chat", ("Open", "Pairs")),
    ("Open", ()),
    ("Open", ("s",)),
    ("Pairs", ("Pair",)),
    ("Pairs", ("Pairs", "Pair")),
    ("Pair", ("u", "a")),
]
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 3, 4, 3, 3
#: From any stack two insertions lead to a whole number of pairs, and from there any rest another
#: stack can take costs at most one deletion more (of a system row).  Dearer stacks cannot win.
SLACK = 2 * INSERT_COST + DELETE_COST
#: Row codes: the first letter of the role ("x" for others), in capitals if truncated, "-" if it must go.
MUST_GO = "-"
CHUNK = 64


def _tables() -> tuple[dict, dict]:
    """Moves (state, symbol) -> state and complete productions of each state, from the LR(0) items."""

    def closure(items: frozenset) -> frozenset:
        found = set(items)
        work = list(found)
        while work:
            rule, dot = work.pop()
            body = GRAMMAR[rule][1] if rule >= 0 else ("Chat",)
            for i, (head, _) in enumerate(GRAMMAR):
                if dot < len(body) and body[dot] == head and (i, 0) not in found:
                    found.add((i, 0))
                    work.append((i, 0))
        return frozenset(found)

    states = [closure(frozenset({(-1, 0)}))]
    moves, complete = {}, {}
    for number, items in enumerate(states):  # grows while it is read
        complete[number] = sorted(r for r, dot in items if r >= 0 and dot == len(GRAMMAR[r][1]))
        after: dict[str, set] = {}
        for rule, dot in items:
            body = GRAMMAR[rule][1] if rule >= 0 else ("Chat",)
            if dot < len(body):
                after.setdefault(body[dot], set()).add((rule, dot + 1))
        for symbol, kernel in sorted(after.items()):
            target = closure(frozenset(kernel))
            if target not in states:
                states.append(target)
            moves[number, symbol] = states.index(target)
    return moves, complete


_MOVES, _COMPLETE = _tables()
#: The accepting stack and the first frontier: entries are (stack, cost, audit).
_BOTTOM = (0, None)
_ACCEPTED = (_MOVES[0, "Chat"], _BOTTOM)
START = ((_BOTTOM, 0, ""),)


def _offer(frontier: dict, stack: tuple, cost: int, audit: str) -> bool:
    """Merge a stack into the frontier; whether it is better than what stood there."""
    held = frontier.get(stack)
    if held is None or (cost, audit) < held:
        frontier[stack] = (cost, audit)
        return True
    return False


def _settle(frontier: dict, at_end: bool) -> None:
    """All reductions and insertions that are possible before the next row."""
    work = list(frontier)
    while work:
        stack = work.pop()
        cost, audit = frontier[stack]
        for rule in _COMPLETE[stack[0]]:
            head, body = GRAMMAR[rule]
            if head == "Chat" and not at_end:
                continue
            below = stack
            for _ in body:
                below = below[1]
            reduced = (_MOVES[below[0], head], below)
            if _offer(frontier, reduced, cost, audit):
                work.append(reduced)
        for role in "ua":
            target = _MOVES.get((stack[0], role))
            if target is not None and _offer(frontier, (target, stack), cost + INSERT_COST, audit + INSERT):
                work.append((target, stack))


def _consume(frontier: dict, code: str) -> dict:
    """The frontier after one row: deleted, kept or given another role."""
    after: dict = {}
    role, extra = code.lower(), TRUNCATED_COST if code.isupper() else 0
    for stack, (cost, audit) in frontier.items():
        _offer(after, stack, cost + DELETE_COST, audit + DELETE)
        if code == MUST_GO:
            continue
        for other in "sua":
            target = _MOVES.get((stack[0], other))
            if target is None:
                continue
            if other == role:
                _offer(after, (target, stack), cost + extra, audit + KEEP)
            elif other != "s":
                _offer(after, (target, stack), cost + REROLE_COST + extra, audit + REROLE)
    return after


@lru_cache(maxsize=1 << 16)
def advance(frontier: tuple, codes: str, at_end: bool) -> tuple[str, tuple]:
    """Edits that are certain after these rows, and the frontier that is left.

    Costs in the frontier are relative to the least.  At the end all edits are certain and nothing is left.
    """
    held = {stack: (cost, audit) for stack, cost, audit in frontier}
    _settle(held, at_end and not codes)
    for i, code in enumerate(codes, 1):
        held = _consume(held, code)
        _settle(held, at_end and i == len(codes))
        least = min(cost for cost, _ in held.values())
        held = {s: v for s, v in held.items() if v[0] <= least + SLACK or s == _ACCEPTED}
    if at_end:
        return held[_ACCEPTED][1], ()
    least = min(cost for cost, _ in held.values())
    audits = [audit for _, audit in held.values()]
    common = sum(1 for _ in takewhile(lambda letters: len(set(letters)) == 1, zip(*audits)))
    rest = sorted((s, cost - least, audit[common:]) for s, (cost, audit) in held.items())
    return audits[0][:common], tuple(rest)
