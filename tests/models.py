"""Sequential pure-Python referees: one record at a time, in arrival order."""

from __future__ import annotations

import hashlib
import hmac
import math


class SequentialReplay:
    """Replay window as a set of seen sequence numbers plus the highest one."""

    def __init__(self, size: int = 128):
        self.size = size
        self.max_seen = -1
        self.seen: set[int] = set()

    def accept(self, seq: int) -> bool:
        if seq < 0:
            return False
        if self.max_seen >= 0 and seq <= self.max_seen - self.size:
            return False
        if seq > self.max_seen:
            self.max_seen = seq
            self.seen = {x for x in self.seen if x > seq - self.size}
            self.seen.add(seq)
            return True
        if seq in self.seen:
            return False
        self.seen.add(seq)
        return True


def sequential_bound(rows, limit):
    """rows: iterable of (user, payload) in arrival order -> kept payloads."""
    counts: dict = {}
    kept = []
    for user, payload in rows:
        if user is None:
            kept.append(payload)
            continue
        counts[user] = counts.get(user, 0) + 1
        if counts[user] <= limit:
            kept.append(payload)
    return kept


def keyed_gauss(secret: str, stream: str, key: str, node: int) -> float:
    msg = f"{stream}|{len(key)}|{key}|{node}".encode()
    h = hmac.new(secret.encode(), msg, hashlib.sha256).hexdigest()
    u, v = int(h[:12], 16), int(h[12:24], 16)
    return math.sqrt(-2.0 * math.log((u + 1) / (2 ** 48 + 1))) * math.cos(2 * math.pi * v / 2 ** 48)


class HeapTree:
    """Complete binary tree over L = 2^H leaves in a level-order list, with a recursive range query."""

    def __init__(self, horizon: int, node_value):
        self.h = int(math.ceil(math.log(horizon) / math.log(2)))
        self.leaves = 2 ** self.h
        self.nodes = [node_value(j) for j in range(2 * self.leaves - 1)]

    def add(self, i: int, c: float) -> None:
        j = self.leaves - 1 + i
        while True:
            self.nodes[j] += c
            if j == 0:
                break
            j = (j - 1) // 2

    def prefix(self, i: int) -> float:
        """Sum of the canonical (maximal dyadic) nodes covering [0, i]."""

        def go(j, lo, hi):
            if hi <= i:
                return self.nodes[j]
            if lo > i:
                return 0.0
            mid = (lo + hi) // 2
            return go(2 * j + 1, lo, mid) + go(2 * j + 2, mid + 1, hi)

        return go(0, 0, self.leaves - 1)
