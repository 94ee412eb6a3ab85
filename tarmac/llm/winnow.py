"""Content-defined anchors of texts: equal windows of ``span`` units (bytes, or words by hash) pick the same anchor."""

from __future__ import annotations

import numpy as np

GRAM = 64  # units that a fingerprint covers
STEP = 1 << 21  # windows taken at once; a step's places must fit 24 bits
_R = 0x5851F42D4C957F2D  # odd, so powers can be undone
_POS = np.uint64((1 << 24) - 1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Anchors:
    """Anchors for windows of ``span`` units; keeps tables of powers as long as a step."""

    def __init__(self, span: int, gram: int = GRAM, step: int = STEP):
        if step + span > int(_POS):
            raise ValueError("a step's places must fit 24 bits")
        self.span, self.gram, self.width, self.step = span, gram, span - gram + 1, step
        self.up = self.down = np.zeros(0, dtype=np.uint64)

    def _tables(self, n: int) -> None:
        if len(self.up) < n:
            self.up = _powers(_R, n)
            self.down = _powers(pow(_R, -1, 1 << 64), n)

    def fingerprints(self, raw: np.ndarray) -> np.ndarray:
        """Mixed hash of the ``gram`` units at every place that has them."""
        n = len(raw) - self.gram + 1
        self._tables(len(raw) + 1)
        sums = np.zeros(len(raw) + 1, dtype=np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * self.up[: len(raw)], out=sums[1:])
        h = (sums[self.gram:] - sums[:-self.gram]) * self.down[:n]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        return h

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text number, place, fingerprint) of the anchors: leftmost smallest fingerprint of every window."""
        return self.of_units(np.frombuffer(b"".join(texts), dtype=np.uint8),
                             np.cumsum(np.array([0] + [len(t) for t in texts], dtype=np.int64)))

    def of_units(self, raw: np.ndarray, texts_at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As for texts, of joined units (bytes, or word hashes); ``texts_at`` holds each text's first unit and the end.

        Windows are taken in steps of at most ``step``, so texts may have any length.
        """
        at, fp, last = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.uint64)], -1
        for lo in range(0, len(raw) - self.span + 1, self.step):
            hi = min(len(raw), lo + self.step + self.span - 1)
            places, prints = self._step(raw[lo:hi], np.clip(texts_at, lo, hi) - lo)
            if len(places):
                again = int(lo + places[0] == last)  # the last window before had it too
                last = lo + int(places[-1])
                at.append(lo + places[again:])
                fp.append(prints[again:])
        at, fp = np.concatenate(at), np.concatenate(fp)
        owner = np.searchsorted(texts_at, at, side="right") - 1
        return owner, at - texts_at[owner], fp

    def _step(self, raw: np.ndarray, texts_at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, fingerprint) of the anchors of all windows in ``raw`` that lie inside one text."""
        h = self.fingerprints(raw)
        w, n = self.width, len(h)
        key = (h & ~_POS) | np.arange(n, dtype=np.uint64)
        grid = np.full(-(-n // w) * w, np.uint64(0xFFFFFFFFFFFFFFFF))
        grid[:n] = key
        grid = grid.reshape(-1, w)
        ahead = np.minimum.accumulate(grid, axis=1).ravel()
        behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        starts = len(raw) - self.span + 1
        least = np.minimum(behind[:starts], ahead[w - 1: w - 1 + starts])
        # windows inside one text
        inside = np.zeros(starts + 1, dtype=np.int32)
        for_text = np.diff(texts_at) >= self.span
        np.add.at(inside, texts_at[:-1][for_text], 1)
        np.add.at(inside, np.minimum(texts_at[1:][for_text] - self.span + 1, starts), -1)
        least = least[np.cumsum(inside[:-1]) > 0]
        new = np.ones(len(least), dtype=bool)
        new[1:] = least[1:] != least[:-1]
        at = (least[new] & _POS).astype(np.int64)
        return at, h[at]
