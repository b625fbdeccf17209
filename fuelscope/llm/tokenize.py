"""Ids of public tokenizers, piece by piece.

Both tokenizers cut a text into pieces before they merge, and no piece reaches from a
visible character over white space. A run of white space with the visible run behind
it therefore has the same ids wherever it stands; each such run is encoded once per
task and remembered by its 64-bit hash, in arrays. New runs are encoded many at a time
with a separator between them whose ids stand nowhere else. Texts with characters for
which this is not plain (other scripts' white space, combining marks, special-token
strings) are encoded whole.
"""

from __future__ import annotations

import hashlib
import os
import re

import numpy as np

from .common import Words, mix64

# Printable ASCII, the white space that Python and the tokenizers agree on, Latin letters.
_OTHER = re.compile(r"[^\t\n\x0b\x0c\r\x20-\x7e\xa1-ɏ]|<\|")
_PLAIN = bytes([9, 10, 11, 12, 13, *range(32, 127)])
# Where white space has no ids, a letter of a script that no run has parts the runs; where
# it has, a line break does, of which only runs behind one space or none are free.
_MARK, _BREAK = " 龍 ", "\n"
_JOINED = 512
# Bytes of text worked on at a time, about.
_BATCH = 1 << 22


class Encoder:
    """``spaces``: whether white space has ids of its own."""

    def __init__(self, name: str, spaces: bool, limit: int = 1 << 21):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        self.spaces = spaces
        self.limit = limit
        self.between = _BREAK if spaces else _MARK
        self.mark = self._direct([self.between.strip(" ")])[0]
        self.tails: dict[bytes, np.ndarray] = {}
        self._forget()

    def _forget(self) -> None:
        # Hashes of known runs, ascending, and where in ``pool`` their ids stand.
        self.known, self.at, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool, self.used = np.zeros(1 << 16, "<u4"), 0

    def _direct(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _runs(self, runs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all runs in a row, and how many each has."""
        texts = [r.decode("utf-8", "surrogatepass") for r in runs]
        plain = np.array([not self.spaces or t[0] > " " or (t[0] == " " and t[1] > " ") for t in texts], bool)
        size = np.zeros(len(texts), np.int64)
        at = np.flatnonzero(plain)
        groups = [at[k : k + _JOINED] for k in range(0, len(at), _JOINED)]
        found = self._direct([self.between.join([texts[i] for i in g]) for g in groups])
        parts = []
        for g, ids in zip(groups, found):
            ends = np.append(np.flatnonzero(ids == self.mark[0]), len(ids))
            begins = np.concatenate([[0], ends[:-1] + len(self.mark)])
            size[g] = ends - begins
            keep = np.ones(len(ids), bool)
            for k in range(len(self.mark)):
                keep[ends[:-1] + k] = False
            parts.append(ids[keep])
        if not len(parts) or not plain.all():
            odd = np.flatnonzero(~plain)
            ids = self._direct([texts[i] for i in odd])
            size[odd] = [len(x) for x in ids]
            order = np.argsort(np.concatenate([at, odd]), kind="stable")
            flat = np.concatenate([*parts, *ids, np.zeros(0, "<u4")])
            lengths = np.concatenate([size[at], size[odd]])
            return flat[_ranges((np.cumsum(lengths) - lengths)[order], lengths[order])], size
        return np.concatenate(parts), size

    def _learn(self, hashes: np.ndarray, runs: list[bytes]) -> None:
        """``hashes`` ascending and unknown."""
        ids, size = self._runs(runs)
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(len(self.pool), "<u4")])
        self.pool[self.used : self.used + len(ids)] = ids
        to = np.searchsorted(self.known, hashes)
        self.at = np.insert(self.at, to, self.used + np.cumsum(size) - size)
        self.size = np.insert(self.size, to, size)
        self.known = np.insert(self.known, to, hashes)
        self.used += len(ids)

    def _tail(self, raw: bytes) -> np.ndarray:
        if raw not in self.tails:
            if len(self.tails) > 1 << 12:
                self.tails.clear()
            self.tails[raw] = self._direct([raw.decode()])[0]
        return self.tails[raw]

    def _plain(self, texts: list[str]) -> list[np.ndarray]:
        found = Words(texts)
        begins, starts, ends, hashes = found.begins, found.starts, found.ends, found.hashes
        limits = np.cumsum([0] + [len(t) + 1 if t.isascii() else len(t.encode("utf-8", "surrogatepass")) + 1 for t in texts])
        raw = found.joined.tobytes()
        if self.spaces and len(starts):
            # The white space in front belongs to the run.
            before = np.concatenate([[0], ends[:-1]])
            first = begins[:-1][begins[1:] > begins[:-1]]
            before[first] = limits[:-1][begins[1:] > begins[:-1]]
            gap = starts - before
            salt = np.where(gap == 1, found.joined[before].astype(np.uint64) + np.uint64(1), np.uint64(0))
            for i in np.flatnonzero(gap > 1).tolist():
                salt[i] = int.from_bytes(hashlib.blake2b(raw[before[i] : starts[i]], digest_size=8).digest(), "little")
            hashes = mix64(hashes + mix64(salt))
            starts = before
        different, which = np.unique(hashes, return_inverse=True)
        some = np.zeros(len(different), np.int64)
        some[which] = np.arange(len(which))
        if len(self.known) + len(different) > self.limit:
            self._forget()
        place = np.searchsorted(self.known, different)
        new = np.ones(len(different), bool)
        inside = place < len(self.known)
        new[inside] = self.known[place[inside]] != different[inside]
        if new.any():
            at = some[new]
            self._learn(different[new], [raw[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist())])
            place = np.searchsorted(self.known, different)
        place = place[which]
        size = self.size[place]
        flat = self.pool[_ranges(self.at[place], size)]
        edges = np.concatenate([[0], np.cumsum(size)])[begins]
        out = [flat[a:b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]
        if self.spaces:
            for i in range(len(texts)):
                at = int(ends[begins[i + 1] - 1]) if begins[i + 1] > begins[i] else int(limits[i])
                if at < limits[i + 1] - 1:
                    out[i] = np.concatenate([out[i], self._tail(raw[at : limits[i + 1] - 1])])
        return out

    def __call__(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        out: list[np.ndarray] = [np.zeros(0, "<u4")] * len(texts)
        held, size = [], 0
        for i, text in enumerate(texts):
            if text and _is_other(text):
                out[i] = self._direct([text])[0]
            elif text:
                held.append(i)
                size += len(text)
            if held and (size >= _BATCH or i + 1 == len(texts)):
                for k, ids in zip(held, self._plain([texts[k] for k in held])):
                    out[k] = ids
                held, size = [], 0
        return out


def _is_other(text: str) -> bool:
    if text.isascii():
        return "<|" in text or bool(text.encode().translate(None, _PLAIN))
    return _OTHER.search(text) is not None


def _ranges(begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """begins[0], begins[0] + 1, ... (lengths[0] of them), begins[1], ..."""
    total = int(lengths.sum())
    return np.repeat(begins - (np.cumsum(lengths) - lengths), lengths) + np.arange(total)


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(name: str, spaces: bool) -> Encoder:
    """One for each worker process."""
    key = (name, spaces)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(name, spaces)
    return _ENCODERS[key]
