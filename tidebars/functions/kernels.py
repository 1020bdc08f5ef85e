"""Moving-average arithmetic on the rows of one Arrow batch.

``pos`` is the 1-based position of a row in its run, so ``pos > k`` says that the row ``k`` back
belongs to the same run. Only sums of same-signed terms occur: prefix differences would cancel.
"""

from __future__ import annotations

import numpy as np


def _append_older(newer, older, pos):
    """Trailing sums over ``a + b`` rows from those over the newest ``a`` and the ``b`` before them.

    Each entry is (rows, plain sum, sum weighted 1..k from oldest to newest).
    """
    a, s_new, w_new = newer
    b, s_old, w_old = older
    back_s = np.zeros_like(s_old)
    back_w = np.zeros_like(w_old)
    back_s[a:] = s_old[:-a]
    back_w[a:] = w_old[:-a]
    reach = pos > a
    extra = np.clip(pos - a, 0, b)
    return (a + b, s_new + np.where(reach, back_s, 0.0),
            w_new + extra * s_new + np.where(reach, back_w, 0.0))


def trailing_sums(x, pos, periods):
    """{period: (plain sum, weighted sum)} over trailing frames, shorter at the start of a run."""
    doubled = [(1, x, x)]
    while doubled[-1][0] * 2 <= max(periods):
        doubled.append(_append_older(doubled[-1], doubled[-1], pos))
    out = {}
    for period in periods:
        total = None
        for piece in reversed(doubled):
            if (total[0] if total else 0) + piece[0] <= period:
                total = piece if total is None else _append_older(total, piece, pos)
        out[period] = total[1:]
    return out


def sma(sums, pos, period):
    return sums[period][0] / np.minimum(pos, period)


def wma(sums, pos, period):
    n = np.minimum(pos, period)
    return sums[period][1] / (n * (n + 1) / 2.0)


def ema(x, pos, period, carry, known=None):
    """Exponential average seeded by each run's first value; ``carry`` continues an open run.

    ``known`` holds values that are settled already, NaN elsewhere; later rows go on from them.
    Solves ``e[n] = decay * e[n-1] + u[n]`` for the whole batch by doubling the reach of every row.
    """
    alpha = 2.0 / (period + 1.0)
    decay = 1.0 - alpha
    first = pos == 1
    e = np.where(first, x, alpha * x)
    link = np.where(first, 0.0, decay)
    if known is not None:
        settled = ~np.isnan(known)
        e = np.where(settled, known, e)
        link = np.where(settled, 0.0, link)
    if link[0]:
        e[0] += decay * carry
        link[0] = 0.0
    reach = 1
    while reach < len(x) and link.any():
        # where, not a product: a row of another run may hold NaN, and 0 * NaN is NaN
        e[reach:] += np.where(link[reach:] != 0.0, link[reach:] * e[:-reach], 0.0)
        shifted = np.zeros_like(link)
        shifted[reach:] = link[:-reach]
        link = link * shifted
        reach *= 2
    return e
