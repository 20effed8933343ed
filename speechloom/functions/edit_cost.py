"""Word edit counts for a whole Arrow batch at once.

The cost of a deletion or insertion is B and of a substitution B + 1, with B above any possible
number of substitutions. So the minimum over all alignments orders by (number of edits, number of
substitutions) and both can be read back from one integer. Pairs of similar size are stacked into a matrix, one dynamic-programming row per step, so
the Python overhead is paid per step of a stack and not per utterance.

Long pairs, such as whole recordings, are aligned one by one in a band around the diagonal, which is
doubled until the result proves that no better alignment leaves it. So work and memory follow the
number of errors and not the square of the length.
"""

from __future__ import annotations

import numpy as np
import pandas as pd

CELLS = 1 << 16  # matrix entries per stack, small enough for a core's cache
LONG_CELLS = 1 << 22  # words times words from which a pair is aligned in a band
BAND = 64  # places on either side of the diagonal to begin with
COUNTS = ["substitutions", "deletions", "insertions", "hits"]


def edit_counts(references: list, hypotheses: list) -> pd.DataFrame:
    """Counts per pair of word lists."""
    pairs = len(references)
    n = np.array([len(r) for r in references], np.int64)
    m = np.array([len(h) for h in hypotheses], np.int64)
    ref_ids, hyp_ids = _word_ids(references, hypotheses, n, m)
    edits = np.zeros(pairs, np.int64)
    subs = np.zeros(pairs, np.int64)
    longest = np.maximum(n, m)
    is_long = n * m > LONG_CELLS
    for i in np.flatnonzero(is_long):
        edits[i], subs[i] = banded_cost(ref_ids[i], hyp_ids[i])
    order = np.argsort(-longest, kind="stable")
    order = order[~is_long[order]]
    at = 0
    while at < len(order):
        take = max(1, CELLS // (int(longest[order[at]]) + 1))
        stack = order[at : at + take]
        stack = stack[np.argsort(-n[stack], kind="stable")]
        edits[stack], subs[stack] = _stack_cost(
            [ref_ids[i] for i in stack], [hyp_ids[i] for i in stack], n[stack], m[stack]
        )
        at += take
    deletions = (edits - subs - (m - n)) // 2
    insertions = deletions + m - n
    hits = n - subs - deletions
    return pd.DataFrame(dict(zip(COUNTS, (subs, deletions, insertions, hits))))


def _word_ids(references, hypotheses, n, m):
    flat = [w for side in (references, hypotheses) for row in side for w in row]
    codes = pd.factorize(np.array(flat, dtype=object))[0] if flat else np.zeros(0, np.int64)
    cuts = np.cumsum(np.concatenate([n, m]))[:-1]
    parts = np.split(codes, cuts) if len(n) else []
    return parts[: len(n)], parts[len(n) :]


def _stack_cost(refs, hyps, n, m):
    """Edits and substitutions of each pair; ``n`` is in descending order."""
    pairs, height, width = len(refs), int(n.max()), int(m.max())
    b = max(height, width) + 1
    kind = np.int32 if (height + width + 2) * (b + 1) < 2**31 else np.int64
    ref = np.full((pairs, height), -1, np.int32)
    hyp = np.full((pairs, width), -2, np.int32)
    for p in range(pairs):
        ref[p, : n[p]] = refs[p]
        hyp[p, : m[p]] = hyps[p]
    ramp = np.arange(width + 1, dtype=kind) * kind(b)
    row = np.tile(ramp, (pairs, 1))
    active = np.searchsorted(-n, -np.arange(1, height + 1), side="right")
    for i, k in enumerate(active):
        old = row[:k]
        new = old + kind(b)
        changed = (hyp[:k] != ref[:k, i : i + 1]).astype(kind)
        changed *= kind(b + 1)
        changed += old[:, :-1]
        np.minimum(new[:, 1:], changed, out=new[:, 1:])
        new -= ramp
        np.minimum.accumulate(new, axis=1, out=new)
        new += ramp
        row[:k] = new
    best = row[np.arange(pairs), m].astype(np.int64)
    return best // b, best % b


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the common beginning."""
    k = min(len(a), len(b))
    differ = np.flatnonzero(a[:k] != b[:k])
    return int(differ[0]) if len(differ) else k


def banded_cost(ref: np.ndarray, hyp: np.ndarray) -> tuple[int, int]:
    """Edits and substitutions of one pair.

    What both begin and end with is matched in some cheapest alignment and left out. An alignment that
    leaves a band of ``k`` places beyond the corners' diagonals needs at least ``2 k + 2`` insertions and
    deletions more than the lengths differ by, so a result with fewer edits is the best of all.
    """
    k = _shared(ref, hyp)
    ref, hyp = ref[k:], hyp[k:]
    k = _shared(ref[::-1], hyp[::-1])
    ref, hyp = ref[:len(ref) - k], hyp[:len(hyp) - k]
    gap, wide = abs(len(hyp) - len(ref)), max(len(ref), len(hyp))
    k = min(BAND, wide)
    while True:
        edits, subs = _in_band(ref, hyp, k)
        if edits < gap + 2 * k + 2 or k >= wide:
            return edits, subs
        k = min(2 * k, wide)


def _in_band(ref: np.ndarray, hyp: np.ndarray, k: int) -> tuple[int, int]:
    """The cheapest alignment whose places j - i stay within ``k`` of those of both corners."""
    n, m = len(ref), len(hyp)
    low, high = min(0, m - n) - k, max(0, m - n) + k
    width = high - low + 1
    b = max(n, m) + 1
    # hyp[j - 1] for all places of a row; outside of the words nothing is equal
    words = np.full(n + m + 2 * width, -2, np.int64)
    words[width:width + m] = hyp
    ramp = np.arange(width, dtype=np.int64) * b
    # a cost that no alignment has: places before the first word of the row
    never = np.int64((n + m + 2) * (b + 1) * 2)
    row = np.where(np.arange(low, high + 1) >= 0, np.arange(low, high + 1) * b, never)
    for i in range(1, n + 1):
        at = width + i + low - 1
        new = row + (words[at:at + width] != ref[i - 1]) * np.int64(b + 1)
        if i + low <= 0 <= i + high:
            new[-i - low] = never  # the first column has nothing to its left
        np.minimum(new[:-1], row[1:] + b, out=new[:-1])
        new -= ramp
        np.minimum.accumulate(new, out=new)
        new += ramp
        row = new
    best = int(row[m - n - low])
    return best // b, best % b
