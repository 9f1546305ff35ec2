"""A grammar over role and fault sequences, with the cheapest repair of each rule.

Terminals are one letter a row: the role's class ``s u a o`` (``o``: any
other role), in upper case for a truncated text, or ``d`` for a row that has
to go.  A repair walks four states: nothing kept yet, after a system row,
after a user row, after an assistant row.

``matrix[i][j]`` holds the cheapest edits that lead from state i to state j
over a terminal or rule, as (cost, rope): among equal costs the rope whose text
is least.  Two edits of one cost between the same states consume the same rows, so neither
text is a prefix of the other, and the least of a whole is made of the least
of its parts.  A rope is a string or a pair of ropes that rules share.
"""

from __future__ import annotations

STATES = range(4)
START, SYSTEM, USER, ASSISTANT = STATES
TERMINALS = "suaoSUAOd"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3

#: States from which a role may follow, and the state it leads to.
_NEXT = {"s": ((START,), SYSTEM), "u": ((START, SYSTEM, ASSISTANT), USER), "a": ((USER,), ASSISTANT)}


def text_of(rope) -> str:
    """The edits of a rope."""
    if isinstance(rope, str):
        return rope
    out, todo = [], [rope]
    while todo:
        r = todo.pop()
        if isinstance(r, str):
            out.append(r)
        else:
            todo += (r[1], r[0])
    return "".join(out)


def better(a, b):
    """The cheaper of two entries (None: no way), of equal ones the one whose edits come first."""
    if a is None or b is None:
        return a or b
    if a[0] != b[0]:
        return a if a[0] < b[0] else b
    return a if text_of(a[1]) <= text_of(b[1]) else b


def _then(a, b):
    return (a[0] + b[0], (a[1], b[1]) if a[1] and b[1] else a[1] or b[1]) if a and b else None


def product(a, b):
    """Min-plus product: ``a``'s rows, then ``b``'s."""
    out = []
    for i in STATES:
        row = []
        for j in STATES:
            best = None
            for k in STATES:
                best = better(best, _then(a[i][k], b[k][j]))
            row.append(best)
        out.append(row)
    return out


def _inserts():
    """Rows put in between: the fewest that lead from one state to another."""
    out = [[(0, "") if i == j else None for j in STATES] for i in STATES]
    for role in "ua":
        for i in _NEXT[role][0]:
            out[i][_NEXT[role][1]] = (INSERT, "I")
    for k in STATES:
        for i in STATES:
            for j in STATES:
                out[i][j] = better(out[i][j], _then(out[i][k], out[k][j]))
    return out


INSERTS = _inserts()


def terminal(letter: str):
    """The matrix of one row: rows put in before it, then what becomes of it."""
    edit = [[(DELETE, "D") if i == j else None for j in STATES] for i in STATES]
    if letter != "d":
        more = TRUNCATED if letter.isupper() else 0
        for role, cost, name in ((letter.lower(), KEEP, "K"), ("u", REROLE, "R"), ("a", REROLE, "R")):
            before, after = _NEXT.get(role, ((), None))
            for i in before:
                edit[i][after] = better(edit[i][after], (cost + more, name))
    return product(INSERTS, edit)


def ending(state: int):
    """The cost and edits of the rows to put in at the end."""
    if state == START:
        return 0, ""
    cost, rope = INSERTS[state][ASSISTANT]
    return cost, text_of(rope)


class Grammar:
    """Re-Pair rules, made in rounds; a round's pairs are replaced from left to right."""

    def __init__(self):
        self.rounds: list[dict[tuple[int, int], int]] = []
        self.matrices = [terminal(t) for t in TERMINALS]

    def add(self, counted: list[tuple[int, int]]) -> int:
        """A round of rules for some of the pairs given, most frequent first: those that cannot overlap each other."""
        lefts, rights, made = set(), set(), {}
        for a, b in counted:
            if a in rights or b in lefts or (a == b and (a in lefts or a in rights)):
                continue
            lefts.add(a)
            rights.add(b)
            made[a, b] = len(self.matrices)
            self.matrices.append(product(self.matrices[a], self.matrices[b]))
        self.rounds.append(made)
        return len(made)

    def parse(self, letters: str) -> list[int]:
        """The symbols of a sequence under the rules so far."""
        symbols = [TERMINALS.index(c) for c in letters]
        for rules in self.rounds:
            if len(symbols) == 1:
                break
            out, i, n = [], 0, len(symbols)
            while i < n:
                rule = rules.get((symbols[i], symbols[i + 1])) if i + 1 < n else None
                out.append(symbols[i] if rule is None else rule)
                i += 1 if rule is None else 2
            symbols = out
        return symbols

    def matrix(self, letters: str):
        """The matrix of a sequence, folded from those of its symbols."""
        symbols = self.parse(letters)
        out = self.matrices[symbols[0]]
        for s in symbols[1:]:
            out = product(out, self.matrices[s])
        return out
