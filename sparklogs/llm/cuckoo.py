"""Cuckoo filters over 16-byte keys, many keys at a time: membership with deletion in two bytes a slot."""

from __future__ import annotations

import numpy as np

SLOTS = 4
#: Share of slots that a filter of a chosen size fills.
LOAD = 0.8
#: Rounds of eviction after which a filter counts as full.
ROUNDS = 200


def key_words(keys: list[bytes] | bytes) -> np.ndarray:
    """Keys of 16 bytes as pairs of 64-bit words."""
    raw = keys if isinstance(keys, bytes) else b"".join(keys)
    return np.frombuffer(raw, "<u8").reshape(-1, 2)


class CuckooFilter:
    """A table of buckets of four 16-bit fingerprints; 0 is a free slot.

    A key lies in one of two buckets, each of which follows from the other and the
    fingerprint, so that keys can be moved and removed without being known. What
    has been added is always found; a key that hasn't is found with a chance of
    about 8 in 65,536. A key must be added once only, and only removed if it is in.
    """

    def __init__(self, buckets: int = 1, table: bytes | None = None):
        self.table = np.zeros((buckets, SLOTS), np.uint16) if table is None else np.frombuffer(table, "<u2").reshape(-1, SLOTS).copy()

    @classmethod
    def of(cls, words: np.ndarray) -> CuckooFilter:
        """A filter of the right size for some keys, with these in it."""
        buckets = 1 << max(0, int(np.ceil(len(words) / (SLOTS * LOAD))) - 1).bit_length()
        while not (made := cls(buckets)).add(words):
            buckets *= 2
        return made

    def _places(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        print_ = (words[:, 0] & np.uint64(0xFFFF)).astype(np.uint16)
        print_[print_ == 0] = 1
        first = (words[:, 0] >> np.uint64(16)).astype(np.int64) & (len(self.table) - 1)
        return print_, first, self._other(first, print_)

    def _other(self, bucket: np.ndarray, print_: np.ndarray) -> np.ndarray:
        """The second bucket of a fingerprint, from either."""
        return bucket ^ ((print_.astype(np.int64) * 0x5BD1E995 >> 7) & (len(self.table) - 1))

    def __len__(self) -> int:
        return int(np.count_nonzero(self.table))

    def tobytes(self) -> bytes:
        return self.table.astype("<u2").tobytes()

    def contains(self, words: np.ndarray) -> np.ndarray:
        print_, first, second = self._places(words)
        return (self.table[first] == print_[:, None]).any(1) | (self.table[second] == print_[:, None]).any(1)

    def add(self, words: np.ndarray) -> bool:
        """Adds keys that aren't in; False, with the filter as it was, if they don't fit."""
        before = self.table.copy()
        print_, bucket, _ = self._places(words)
        for turn in range(ROUNDS):
            if not len(print_):
                return True
            order = np.argsort(bucket, kind="stable")
            print_, bucket = print_[order], bucket[order]
            start = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            rank = np.arange(len(bucket)) - np.repeat(start, np.diff(np.append(start, len(bucket))))
            free = self.table[bucket] == 0
            fits = rank < free.sum(1)
            # the rank-th free slot of the bucket
            slot = np.argmax(np.cumsum(free[fits], axis=1) == rank[fits, None] + 1, axis=1)
            self.table[bucket[fits], slot] = print_[fits]
            print_, bucket = print_[~fits], bucket[~fits]
            if turn % 2:  # neither bucket has room: one a bucket takes the place of another fingerprint
                _, lead = np.unique(bucket, return_index=True)
                slot = (turn // 2 + bucket[lead]) % SLOTS
                out = self.table[bucket[lead], slot]
                self.table[bucket[lead], slot] = print_[lead]
                print_[lead] = out
                gone = print_ == 0  # the slot was free
                print_, bucket = print_[~gone], bucket[~gone]
            bucket = self._other(bucket, print_)
        self.table = before
        return not len(words)

    def remove(self, words: np.ndarray) -> None:
        """Removes keys that are in; `KeyError` if one isn't."""
        print_, first, second = self._places(words)
        while len(print_):
            slots = np.concatenate([self.table[first] == print_[:, None], self.table[second] == print_[:, None]], axis=1)
            if not slots.any(1).all():
                raise KeyError("a key to remove isn't in the filter")
            at = np.argmax(slots, axis=1)
            bucket, slot = np.where(at < SLOTS, first, second), at % SLOTS
            _, lead = np.unique(bucket * SLOTS + slot, return_index=True)
            self.table[bucket[lead], slot[lead]] = 0
            rest = np.ones(len(print_), bool)
            rest[lead] = False
            print_, first, second = print_[rest], first[rest], second[rest]
