"""Token counts under a unigram model, by dynamic programming over a trie of distinct pre-tokens.

The cost of a token is -ln of a Zipf weight by its rank in the vocabulary, in whole millionths; a pre-token is cut into the
tokens of the least total cost, of equals those that are fewest. The pre-tokens of a batch are inserted in a trie; the least
cost of a prefix is computed once for its node, whatever number of pre-tokens share it, and the node where a pre-token ends
gives its count. A pre-token of over ``LONG`` bytes shares little and is counted by the same costs without nodes, with only the
costs that a token can reach. Counts of recent pre-tokens are remembered, so a text costs a look-up for each word.

Null and empty texts have no tokens; repeated rows are counted each on its own. All single bytes are tokens, so every text has a count.
"""

from __future__ import annotations

import base64
import functools
import math
from collections import deque

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidebars.llm.frames import prepare, with_results
from tidebars.llm.pieces import Memo, keys, part, pieces

#: Nodes that a trie may have before a new one is begun.
MOST_NODES = 300_000
#: Bytes of a pre-token that is not inserted.
LONG = 10_000
#: A cost holds the sum of the tokens' costs above, and their number in the lowest bits.
COUNT_BITS = 40

_RESULT = "struct<n_pieces: bigint, n_tokens: bigint>"


def read_ranks(path: str) -> dict[bytes, int]:
    """Token ranks of a file with a token in base64 and its rank on each line."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def costs(ranks: dict[bytes, int]) -> dict[bytes, int]:
    """By token: -ln of its share in a Zipf distribution over the ranks, in millionths, and a count of one."""
    total = math.log(sum(1 / (r + 1) for r in ranks.values()))
    return {t: round(1_000_000 * (math.log(r + 1) + total)) << COUNT_BITS | 1 for t, r in ranks.items()}


class PieceTrie:
    """Distinct pre-tokens by their bytes, with the least cost of each prefix."""

    def __init__(self, ranks: dict[bytes, int], most_nodes: int = MOST_NODES):
        self.costs, self.longest, self.most_nodes = costs(ranks), max(map(len, ranks)), most_nodes
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"bytes that are no tokens: {missing[:5]}")
        self.clear()

    def clear(self) -> None:
        self.child: dict[int, int] = {}
        self.least = [0]

    def count(self, piece: bytes) -> int:
        """Insert a pre-token; the number of its tokens."""
        if len(piece) > LONG:
            return self._count_long(piece)
        if len(self.least) > self.most_nodes:
            self.clear()
        node, path, child, least, cost = 0, [0], self.child, self.least, self.costs
        for end, byte in enumerate(piece, 1):
            edge = node << 8 | byte
            node = child.get(edge, -1)
            if node < 0:
                best = None
                for start in range(max(0, end - self.longest), end):
                    own = cost.get(piece[start:end])
                    if own is not None and (best is None or path[start] + own < best):
                        best = path[start] + own
                node = child[edge] = len(least)
                least.append(best)
            path.append(least[node])
        return path[-1] & ((1 << COUNT_BITS) - 1)

    def _count_long(self, piece: bytes) -> int:
        cost, path = self.costs, deque([0], maxlen=self.longest)
        for end in range(1, len(piece) + 1):
            best = None
            for start, before in enumerate(path, end - len(path)):
                own = cost.get(piece[start:end])
                if own is not None and (best is None or before + own < best):
                    best = before + own
            path.append(best)
        return path[-1] & ((1 << COUNT_BITS) - 1)


class Counter:
    """(pieces, tokens) of texts."""

    def __init__(self, path: str):
        self.trie = PieceTrie(read_ranks(path))
        self.known = Memo(self._part, limit=300_000)

    def _part(self, key: str) -> int:
        own = sorted(pieces(part(key)))
        return len(own) << 40 | sum(self.trie.count(p.encode()) for p in own)

    def count(self, text: str | None) -> tuple[int, int]:
        found = keys(text) if text else []
        if found is None:
            found = ["\n" + p if p != "\n" else p for p in pieces(text)]
        total = sum(map(self.known.__getitem__, found))
        return total >> 40, total & ((1 << 40) - 1)


@functools.lru_cache(maxsize=1)
def _counter(path: str) -> Counter:
    """One for each Python worker."""
    return Counter(path)


def count_tokens(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``n_pieces`` and ``n_tokens``. ``path``: the rank file, at the same place on every machine."""
    prepare(docs.sparkSession)

    @F.arrow_udf(_RESULT)
    def count(texts: pa.Array) -> pa.Array:
        counter = _counter(path)
        rows = [counter.count(t.as_py()) for t in texts]
        return pa.StructArray.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in (0, 1)], names=["n_pieces", "n_tokens"])

    return with_results(docs, [text], lambda t: count(t), ["n_pieces", "n_tokens"])
