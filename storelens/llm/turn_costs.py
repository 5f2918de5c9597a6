"""Costs of making the roles of a conversation read `(s?(ua)+)?`, for many stretches of rows at once.

The states are what has been read: nothing, a system turn, a user turn last, an assistant turn last.
A vector holds the least cost from each state to the end of the conversation; a row turns the vector
behind it into the one before it by a matrix of the (min, +) algebra. Adding a constant to a vector
adds it to all vectors before it, so vectors are kept with zero as their smallest number.
"""

from __future__ import annotations

import numpy as np

NOTHING, SYSTEM, USER, ASSISTANT = range(4)  # states
FORCED = 8  # code of a row that has to go; else the role (s, u, a, other) and 4 if it is truncated
NEVER = 1 << 20
KEEP_COST, REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 0, 2, 3, 2, 1

NEXT = np.array([USER, USER, ASSISTANT, USER])  # the state behind the turn that may come next
NEXT_ROLE = "uuau"
KEPT = np.full((9, 4), -1)  # per code and state: the state behind a row that is kept
KEPT[[0, 4], NOTHING] = SYSTEM
for _state in (NOTHING, SYSTEM, ASSISTANT):
    KEPT[[1, 5], _state] = USER
KEPT[[2, 6], USER] = ASSISTANT
STAYS = np.array([KEEP_COST] * 4 + [TRUNCATED_COST] * 4 + [NEVER])  # what a row costs that is not deleted


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """(min, +) product of matrices, or of one with vectors as its columns."""
    return np.minimum((a[..., :, :, None] + b[..., None, :, :]).min(axis=-2), NEVER)


def _inserts() -> np.ndarray:
    once = np.full((4, 4), NEVER)
    np.fill_diagonal(once, 0)
    once[np.arange(4), NEXT] = INSERT_COST
    return times(times(once, once), once)


def _rows() -> np.ndarray:
    rows = np.full((9, 4, 4), NEVER)
    for code in range(9):
        for state in range(4):
            options = [(state, DELETE_COST)]
            if code != FORCED:
                options.append((NEXT[state], REROLE_COST + STAYS[code]))
                if KEPT[code, state] >= 0:
                    options.append((KEPT[code, state], STAYS[code]))
            for behind, cost in options:
                rows[code, state, behind] = min(rows[code, state, behind], cost)
    return rows


INSERTS = _inserts()
ROWS = times(INSERTS, _rows())
END = np.array([0, 4, 2, 0])  # turns that are missing at the end are inserted


def norm(vectors: np.ndarray) -> np.ndarray:
    return vectors - vectors.min(axis=-1, keepdims=True)


class Stretches:
    """Codes of stretches of rows, padded, longest first; results are in the order given."""

    def __init__(self, codes: list[bytes]):
        lengths = np.array([len(c) for c in codes])
        self.order = np.argsort(-lengths, kind="stable")
        self.back = np.argsort(self.order)
        self.lengths = lengths[self.order]
        self.codes = np.zeros((len(codes), int(lengths.max())), np.uint8)
        self.codes[np.arange(self.codes.shape[1]) < self.lengths[:, None]] = np.frombuffer(
            b"".join(codes[i] for i in self.order), np.uint8
        )
        # how many stretches reach each place
        self.reach = np.searchsorted(-self.lengths, -np.arange(self.codes.shape[1]))

    def costs(self, ends: np.ndarray) -> np.ndarray:
        """Vectors (stretch, place, state) from those behind each stretch."""
        n, width = self.codes.shape
        out = np.zeros((n, width + 1, 4), np.int32)
        out[np.arange(n), self.lengths] = ends[self.order]
        for at in range(width - 1, -1, -1):
            m = self.reach[at]
            out[:m, at] = (ROWS[self.codes[:m, at]] + out[:m, at + 1, None, :]).min(axis=2)
        return out

    def before(self, ends: np.ndarray) -> np.ndarray:
        """The vectors in front of the stretches, smallest number zero."""
        return norm(self.costs(ends)[self.back, 0])

    def refit(self, ends: np.ndarray, old_ends: np.ndarray, old: np.ndarray) -> np.ndarray:
        """As `before`, where `old` came from `old_ends`: stops at the place from which on, towards
        the front, all vectors differ from the old ones by constants only."""
        n, width = self.codes.shape
        vectors = np.stack([ends[self.order], old_ends[self.order]])
        for at in range(width - 1, -1, -1):
            m = self.reach[at]
            vectors[:, :m] = (ROWS[self.codes[:m, at]] + vectors[:, :m, None, :]).min(axis=3)
            apart = vectors[0] - vectors[1]
            if m == n and (apart == apart[:, :1]).all():
                return old
        return norm(vectors[0][self.back])

    def matrices(self) -> np.ndarray:
        """Per stretch the matrix from the vector behind it to the one in front of it."""
        n, width = self.codes.shape
        out = np.full((n, 4, 4), NEVER)
        out[:, np.arange(4), np.arange(4)] = 0
        for at in range(width - 1, -1, -1):
            m = self.reach[at]
            out[:m] = times(ROWS[self.codes[:m, at]], out[:m])
        return out[self.back]

    def trace(self, ends: np.ndarray, starts: np.ndarray):
        """The cheapest edits from the states `starts`, of equal ones the first of D, I, K, R at
        every step: per place the state, the number of inserts and the edit, and the state behind."""
        costs = self.costs(ends)
        n, width = self.codes.shape
        state = starts[self.order].copy()
        states, inserts, edits = (np.zeros((n, width), np.int8) for _ in range(3))
        for at in range(width):
            m = self.reach[at]
            who, code = np.arange(m), self.codes[:m, at]
            states[:m, at] = state[:m]
            for _ in range(3):
                now = costs[who, at, state[:m]]
                stays = DELETE_COST + costs[who, at + 1, state[:m]] != now
                grows = stays & (INSERT_COST + costs[who, at, NEXT[state[:m]]] == now)
                if not grows.any():
                    break
                inserts[:m, at] += grows
                state[:m] = np.where(grows, NEXT[state[:m]], state[:m])
            kept = KEPT[code, state[:m]]
            keeps = stays & (kept >= 0) & (STAYS[code] + costs[who, at + 1, kept] == now)
            edits[:m, at] = np.where(~stays, 0, np.where(keeps, 1, 2))
            state[:m] = np.where(~stays, state[:m], np.where(keeps, kept, NEXT[state[:m]]))
        inside = np.arange(width) < self.lengths[:, None]
        return [[v[i, inside[i]] for i in self.back] for v in (states, inserts, edits)], state[self.back]


def _labels() -> tuple[list[str], list[str]]:
    edits, roles = [], []
    for state in range(4):
        for inserts in range(4):
            for edit in "DKR":
                for closing in ("", "a", "ua"):
                    at, given = state, ""
                    for _ in range(inserts):
                        given += NEXT_ROLE[at]
                        at = NEXT[at]
                    own = {"D": "-", "K": "=", "R": NEXT_ROLE[at]}[edit]
                    edits.append("I" * inserts + edit + "I" * len(closing))
                    roles.append(given + own + closing)
    return edits, roles


# by label(): a row's edits, and the role that each gives ("=" its own, "-" none)
EDITS, ROLES = _labels()
CLOSING = np.array([0, 2, 1, 0])  # inserts behind the last row, by the state


def label(states: np.ndarray, inserts: np.ndarray, edits: np.ndarray, closing: int) -> np.ndarray:
    out = ((states.astype(np.int32) * 4 + inserts) * 3 + edits) * 3
    out[-1] += closing
    return out
