"""SuperMinHash signatures of many sets at once.

Every element is given, from its own hash, a random permutation of the ``m`` signature
slots (a lazy Fisher-Yates shuffle) and one uniform number per step. At step j it offers
``j + u`` to the j-th slot of its permutation; a slot keeps its least offer. The ranks of
one element are correlated (each slot exactly once), which lowers the variance against
independent permutations. Offers of step j are at least j, so once every slot of a set
holds an offer from an earlier step no later one can change it: that set stops early.
Sets go through the steps side by side, which is the same as element by element.
"""

from __future__ import annotations

import numpy as np

from haulmark.llm.words import mix

_U = np.uint64
#: Elements handled side by side; the slots table of later steps has this many rows.
ELEMENTS = 1 << 17


def signatures(elements: np.ndarray, offsets: np.ndarray, m: int) -> np.ndarray:
    """Signature values (rows by ``m``, uint64) of the sets ``elements[offsets[i]:offsets[i+1]]``.

    A value holds the step in its upper bits and the random number below, so two sets
    agree in a slot with a probability equal to their Jaccard similarity. An empty set
    has the largest value everywhere.
    """
    n = len(offsets) - 1
    out = np.full((n, m), np.iinfo(_U).max, _U)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + ELEMENTS, "right")) - 1)
        if offsets[b] - offsets[a] > ELEMENTS:  # one large set: parts of it, slot-wise least
            for c in range(int(offsets[a]), int(offsets[b]), ELEMENTS):
                part = elements[c:min(c + ELEMENTS, offsets[b])]
                out[a] = np.minimum(out[a], _block(part, np.array([0, len(part)]), m)[0])
        else:
            out[a:b] = _block(elements[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], m)
        a = b
    return out


def _block(elements: np.ndarray, offsets: np.ndarray, m: int) -> np.ndarray:
    n = len(offsets) - 1
    out = np.full(n * m, np.iinfo(_U).max, _U)
    row = np.repeat(np.arange(n), np.diff(offsets))
    state = elements.copy()
    slots = None
    for j in range(m):
        if not len(row):
            break
        state = mix(state)
        pick = (j + (state >> _U(32)) % _U(m - j)).astype(np.int64)
        value = (_U(j) << _U(48)) | ((state & _U(0xFFFFFFFF)) << _U(16))
        if slots is None and j:  # the second step: the first one swapped slot 0 with `before`
            slots = np.empty((len(row), m), np.uint8 if m <= 256 else np.uint16)
            slots[:] = np.arange(m)
            at = np.arange(len(row))
            slots[at, before], slots[at, 0] = 0, before
        if slots is None:
            slot, before = pick, pick
        else:
            at = np.arange(len(row))
            slot = slots[at, pick].astype(np.int64)
            slots[at, pick] = slots[at, j]
            slots[at, j] = slot
        np.minimum.at(out, row * m + slot, value)
        open_row = (out.reshape(n, m).max(axis=1) == np.iinfo(_U).max)[row]
        if not open_row.all():
            row, state = row[open_row], state[open_row]
            if slots is None:
                before = before[open_row]
            else:
                slots = slots[open_row]
    return out.reshape(n, m)
