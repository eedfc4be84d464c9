"""Texts to ids by a table of words, many words at a time.

A run of texts is one byte array. Its words are cut at blanks, and marks at a word's end are cut off, as arrays of spans;
a span of up to 16 bytes is exactly two 64-bit numbers and a length, which are looked up together in an open-addressing
table of numpy arrays. Only spans that the table lacks become Python bytes, once each, and are encoded by the tokenizer.
An entry costs about 40 bytes, so that a bounded table holds most words that come again.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from marketlens.llm.textops import lower_ascii, mix64, word_spans

#: Longer spans are kept in a dictionary. Entries and long spans that a table holds before it starts anew.
LANES, ENTRIES, LONG_ENTRIES = 16, 400_000, 20_000
_MARK = np.zeros(256, bool)
_MARK[[b for b in range(33, 127) if not chr(b).isalnum()]] = True
_ALNUM = np.zeros(256, bool)
_ALNUM[[b for b in range(128) if chr(b).isalnum()]] = True
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)


def parts(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, owner) of each word's body and of the marks at its end, in order. A word is cut where its marks follow an
    ASCII letter or digit or a letter of two bytes (U+00C0 to U+023F but U+0130, which ends in a mark in lower case); others
    are left whole."""
    body = ends.copy()
    live = np.arange(len(ends))
    while len(live):
        live = live[_MARK[data[body[live] - 1]]]
        body[live] -= 1
        live = live[body[live] > starts[live]]
    cut = np.flatnonzero((body < ends) & (body > starts))
    last = data[body[cut] - 1]
    lead = data[np.maximum(body[cut] - 2, 0)]
    latin = (lead == 0xC3) & (last != 0x97) & (last != 0xB7) | (lead >= 0xC4) & (lead <= 0xC8) & ((lead != 0xC4) | (last != 0xB0))
    two = (last >= 0x80) & (body[cut] - starts[cut] >= 2) & latin
    whole = cut[~(_ALNUM[last] | two)]
    body[whole] = ends[whole]
    s, e = np.stack([starts, body], 1).ravel(), np.stack([body, ends], 1).ravel()
    keep = e > s
    return s[keep], e[keep], np.repeat(owner, 2)[keep]


def _key(low: np.ndarray, high: np.ndarray, length: np.ndarray) -> np.ndarray:
    return mix64(low ^ mix64(high + length.astype(np.uint64) * _STEP))


class WordTable:
    """Ids of spans; ``encode`` turns distinct spans into packed ids of ``width``."""

    def __init__(self, encode: Callable[[list[bytes]], list[bytes]], width: str):
        self.encode, self.width = encode, np.dtype(width)
        self._empty()

    def _empty(self) -> None:
        self.size, self.n_ids = 0, 0
        self.slots = np.full(1 << (2 * ENTRIES - 1).bit_length(), -1, np.int32)
        self.low, self.high = np.zeros(1024, np.uint64), np.zeros(1024, np.uint64)
        self.length, self.count, self.first = np.zeros(1024, np.uint8), np.zeros(1024, np.uint16), np.zeros(1024, np.int32)
        self.ids = np.zeros(4096, self.width)
        self.long: dict[bytes, int] = {}

    def _add(self, packed: list[bytes]) -> np.ndarray:
        """Numbers of new entries with these ids; their lanes are set by the caller."""
        n, size = len(packed), self.width.itemsize
        counts = np.array([len(p) // size for p in packed], np.int64)
        new = np.frombuffer(b"".join(packed), self.width)
        if self.n_ids + len(new) > len(self.ids):
            self.ids = np.concatenate([self.ids[:self.n_ids], np.zeros(max(len(self.ids), len(new)), self.width)])
        self.ids[self.n_ids:self.n_ids + len(new)] = new
        if self.size + n > len(self.first):
            grow = max(len(self.first), n)
            for name in ("low", "high", "length", "count", "first"):
                own = getattr(self, name)
                setattr(self, name, np.concatenate([own, np.zeros(grow, own.dtype)]))
        at = np.arange(self.size, self.size + n)
        self.count[at] = counts
        self.first[at] = self.n_ids + np.cumsum(counts) - counts
        self.size += n
        self.n_ids += len(new)
        return at

    def _find(self, key: np.ndarray, low: np.ndarray, high: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Entry of each span; -1 if it has none."""
        mask = np.uint64(len(self.slots) - 1)
        out = np.full(len(key), -1, np.int32)
        live, slot = np.arange(len(key)), (key & mask).astype(np.int64)
        while len(live):
            entry = self.slots[slot]
            there = entry >= 0
            live, slot, entry = live[there], slot[there], entry[there]
            same = (self.low[entry] == low[live]) & (self.high[entry] == high[live]) & (self.length[entry] == length[live])
            out[live[same]] = entry[same]
            live, slot = live[~same], (slot[~same] + 1) & int(mask)
        return out

    def _insert(self, entries: np.ndarray) -> None:
        """Puts distinct new entries into free slots; more than half of the slots are always free."""
        if 2 * self.size > len(self.slots):
            self.slots = np.full(1 << (4 * self.size).bit_length(), -1, np.int32)
            entries = np.flatnonzero(self.length[:self.size]).astype(np.int32)    # long spans have no slot and no length
        key = _key(self.low[entries], self.high[entries], self.length[entries])
        mask = len(self.slots) - 1
        slot = (key & np.uint64(mask)).astype(np.int64)
        while len(entries):
            free = np.flatnonzero(self.slots[slot] < 0)
            _, first = np.unique(slot[free], return_index=True)
            won = free[first]
            self.slots[slot[won]] = entries[won]
            lost = np.ones(len(entries), bool)
            lost[won] = False
            entries, slot = entries[lost], (slot[lost] + 1) & mask

    def _entries(self, data: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        """The entry of each span, new ones added."""
        buffer = np.zeros(len(data) + LANES, np.uint8)
        buffer[:len(data)] = data
        lanes = np.ndarray((len(buffer) - 7,), "<u8", buffer, 0, (1,))
        size = e - s
        out = np.full(len(s), -1, np.int32)
        raw = data.tobytes()
        short = np.flatnonzero(size <= LANES)
        a, n = s[short], size[short]
        low, high = lanes[a] & _MASKS[np.minimum(n, 8)], lanes[a + 8] & _MASKS[np.maximum(n - 8, 0)]
        key = _key(low, high, n)
        found = self._find(key, low, high, n.astype(np.uint8))
        new = np.flatnonzero(found < 0)
        if len(new):
            words = [raw[x:y] for x, y in zip(a[new].tolist(), (a[new] + n[new]).tolist(), strict=True)]
            place: dict[bytes, int] = {}
            which = np.array([place.setdefault(w, len(place)) for w in words], np.int64)
            entries = self._add(self.encode(list(place)))
            at = np.empty(len(place), np.int64)
            at[which] = new                                  # one occurrence of each
            self.low[entries], self.high[entries], self.length[entries] = low[at], high[at], n[at]
            self._insert(entries.astype(np.int32))
            found[new] = entries[which]
        out[short] = found
        far = np.flatnonzero(size > LANES)
        if len(far):
            words = [raw[x:y] for x, y in zip(s[far].tolist(), e[far].tolist(), strict=True)]
            unknown = [w for w in dict.fromkeys(words) if w not in self.long]
            if unknown:
                entries = self._add(self.encode(unknown))
                self.length[entries] = 0
                self.long.update(zip(unknown, entries.tolist(), strict=True))
            out[far] = [self.long[w] for w in words]
        return out

    def encode_run(self, data: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ends): the ids of the run's texts with the end id behind each; text k has ids[ends[k]:ends[k + 1]]."""
        if self.size > ENTRIES or len(self.long) > LONG_ENTRIES:
            self._empty()
        data = lower_ascii(data)
        s, e, owner = parts(data, *word_spans(data, offsets))
        at = self._entries(data, s, e)
        counts = self.count[at].astype(np.int64)
        texts, total = len(offsets) - 1, int(counts.sum())
        per = np.bincount(owner, weights=counts, minlength=texts).astype(np.int64) + 1
        ends = np.concatenate([[0], np.cumsum(per)])
        out = np.empty(total + texts, self.width)
        source = np.repeat(self.first[at] - (np.cumsum(counts) - counts), counts) + np.arange(total)
        out[np.arange(total) + np.repeat(owner, counts)] = self.ids[source]       # each text before has one end id
        out[ends[1:] - 1] = end_id
        return out, ends
