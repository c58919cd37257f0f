"""A keyed bijection on positions: a shuffle that is computed, not sorted.

Positions 0 .. n - 1 are pairs (left, right) of an a x b grid with fewer than a cells too many. Rounds add to one half
a number that key, round and the other half decide (a Feistel network over mixed radices), which can be undone; a result
beyond n - 1 goes through the rounds again (cycle walking). Where a position goes, and what a place holds, needs neither the other
rows nor a shuffle, so any batch of any epoch is known at once.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

ROUNDS = 8
PRIME = 2**31 - 1
MOST = 1 << 58  # positions, so that no product leaves 64 bits


class Permutation:
    def __init__(self, n: int, seed: int) -> None:
        if not 0 <= n <= MOST:
            raise ValueError("number of positions out of range")
        self.n = n
        self.a = max(1, math.isqrt(max(n - 1, 0)) + 1)
        self.b = max(1, -(-n // self.a))
        word = lambda k: int.from_bytes(hashlib.sha256(f"{seed}:{k}".encode()).digest()[:8], "big") % (PRIME - 1) + 1
        self.keys = [(word(3 * k), word(3 * k + 1), word(3 * k + 2)) for k in range(ROUNDS)]
        self.walks = self._walks()

    def _mix(self, x: np.ndarray, k: int) -> np.ndarray:
        m, c, d = self.keys[k]
        x = (x * m + c) % PRIME
        x = (x ^ (x >> 13)) * d % PRIME
        x = (x ^ (x >> 11)) * m % PRIME
        return x ^ (x >> 15)

    def _rounds(self, x: np.ndarray, back: bool) -> np.ndarray:
        left, right = x // self.b, x % self.b
        for k in reversed(range(ROUNDS)) if back else range(ROUNDS):
            if k % 2:
                right = (right + (-1 if back else 1) * (self._mix(left, k) % self.b)) % self.b
            else:
                left = (left + (-1 if back else 1) * (self._mix(right, k) % self.a)) % self.a
        return left * self.b + right

    def _walks(self) -> int:
        """Most times that a position goes through the rounds: one more than the longest run of cells beyond n - 1, of which there are fewer than a."""
        at = np.arange(self.n, self.a * self.b, dtype=np.int64)
        longest = 1
        while len(at):
            at = self._rounds(at, False)
            left = at[at >= self.n]
            if len(left) == len(at):  # no run ends here, so what is left are cycles, which no position enters
                break
            at, longest = left, longest + 1
        return longest

    def _walked(self, x: np.ndarray, back: bool) -> np.ndarray:
        x = np.asarray(x, np.int64)
        if len(x) and (x.min() < 0 or x.max() >= self.n):
            raise IndexError("position out of range")
        out = self._rounds(x, back)
        while (beyond := out >= self.n).any():
            out[beyond] = self._rounds(out[beyond], back)
        return out

    def held_at(self, places: np.ndarray) -> np.ndarray:
        """Old positions of what stands at these places of the shuffled order."""
        return self._walked(places, False)

    def place_of(self, positions: np.ndarray) -> np.ndarray:
        """Places in the shuffled order of these old positions."""
        return self._walked(positions, True)

    def place_column(self, position: Column) -> Column:
        """``place_of`` as an expression of SQL functions; null outside 0 .. n - 1."""
        inside = F.aggregate(F.sequence(F.lit(1), F.lit(self.walks)), position.cast("long"), lambda x, i: F.when((i > 1) & (x < self.n), x).otherwise(self._pass(x)))
        return F.when((position >= 0) & (position < self.n), inside)

    def _pass(self, x: Column) -> Column:
        """One pass of the inverse rounds: a fold over the rounds, so the expression stays small."""
        keys = F.array(*[F.struct(*[F.lit(v).cast("long").alias(c) for c, v in zip("mcd", key, strict=True)], F.lit(k % 2 == 1).alias("odd")) for k, key in reversed(list(enumerate(self.keys)))])
        start = F.struct(F.call_function("div", x, F.lit(self.b)).alias("left"), (x % self.b).alias("right"))

        def step(s: Column, key: Column) -> Column:
            y = F.when(key["odd"], s["left"]).otherwise(s["right"])
            y = (y * key["m"] + key["c"]) % PRIME
            y = y.bitwiseXOR(F.shiftright(y, 13)) * key["d"] % PRIME
            y = y.bitwiseXOR(F.shiftright(y, 11)) * key["m"] % PRIME
            y = y.bitwiseXOR(F.shiftright(y, 15))
            left = F.when(key["odd"], s["left"]).otherwise(F.pmod(s["left"] - y % self.a, F.lit(self.a)))
            right = F.when(key["odd"], F.pmod(s["right"] - y % self.b, F.lit(self.b))).otherwise(s["right"])
            return F.struct(left.alias("left"), right.alias("right"))

        return F.aggregate(keys, start, step, lambda s: s["left"] * self.b + s["right"])

