"""The best few of many, kept for many owners at once."""

from __future__ import annotations

import numpy as np

NONE = np.iinfo(np.int64).min       # the score of an empty place; no entry has it
LAST = np.iinfo(np.int64).max


class Best:
    """For each of ``owners`` the ``k`` entries of highest score, equal scores by ascending key."""

    def __init__(self, owners: int, k: int):
        self.k = k
        self.scores = np.full((owners, k), NONE, dtype=np.int64)
        self.keys = np.full((owners, k), LAST, dtype=np.int64)

    @property
    def worst(self) -> np.ndarray:
        """Each owner's last score: an entry below it is not wanted any more."""
        return self.scores[:, -1]

    def wanted(self, owner: np.ndarray, score: np.ndarray, key: np.ndarray) -> np.ndarray:
        """Whether entries of (at most) these scores can be among the best."""
        worst = self.worst[owner]
        return (score > worst) | ((score == worst) & (key < self.keys[owner, -1]))

    def merge(self, owner: np.ndarray, score: np.ndarray, key: np.ndarray) -> None:
        good = np.flatnonzero(self.wanted(owner, score, key))
        if not len(good):
            return
        touched = np.unique(owner[good])
        owner = np.concatenate([owner[good], np.repeat(touched, self.k)])
        score = np.concatenate([score[good], self.scores[touched].ravel()])
        key = np.concatenate([key[good], self.keys[touched].ravel()])
        order = np.lexsort((key, ~score, owner))
        first = np.searchsorted(owner[order], touched)
        chosen = order[(first[:, None] + np.arange(self.k))]
        self.scores[touched], self.keys[touched] = score[chosen], key[chosen]

    def entries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Owner, score and key of all that is held."""
        owner, place = np.nonzero(self.scores != NONE)
        return owner, self.scores[owner, place], self.keys[owner, place]
