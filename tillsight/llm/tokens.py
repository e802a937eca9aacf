"""Tokenizer ids of whole texts, with the ids of repeated pre-tokens kept.

The tokenizers library takes about a second a megabyte. A text is therefore cut
where the tokenizer files below cut it anyway, and the library is asked once for
each distinct piece. Texts in Latin-1 without an apostrophe, the bulk of western
text, are cut, hashed and looked up as arrays; other texts are cut only at white
space, and what lies inside is left to the library. Both ways give the ids that
the library gives for the whole text.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable

import numpy as np
import pandas as pd

from .workers import STORES

# Unicode's White_Space, which is what \s means in the tokenizer files.
_SPACE = r"\t-\r \x85\xa0  -     　"

#: How a tokenizer sees white space. "words": it only separates, digits stand
#: alone, case is folded. "spaced": one space belongs to the next pre-token.
KINDS = {
    "words": re.compile(rf"[^{_SPACE}]+"),
    "spaced": re.compile(rf" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"),
}

#: Pre-tokens kept by one worker, bytes of their text and ids, and characters worked on at once. Tables of
#: powers as long as the longest stretch without a cut are kept up to WIDEST.
KEPT, KEPT_BYTES, AT_ONCE, WIDEST = 500_000, 16 << 20, 1 << 18, 1 << 20

_LETTER, _DIGIT, _OTHER, _BLANK = range(4)


def _classes() -> np.ndarray:
    """Class of each Latin-1 character: \\p{L}, \\p{N}, white space or other."""
    kinds = np.full(256, _OTHER, dtype=np.uint8)
    for code in range(256):
        if chr(code).isalpha():
            kinds[code] = _LETTER
        elif chr(code).isnumeric():
            kinds[code] = _DIGIT
    kinds[[*range(9, 14), 0x20, 0x85, 0xA0]] = _BLANK
    return kinds


def _byte_letters() -> dict[int, str]:
    """Latin-1 characters as byte-level models spell them."""
    from tokenizers.pre_tokenizers import ByteLevel

    spell = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
    return {code: spell(chr(code))[0][0] for code in range(256)}


def sections(text: str, most: int = AT_ONCE) -> Iterable[str]:
    """The text in parts of about ``most`` characters.

    A cut lies before a single space between two words, where no pre-token
    reaches across; a stretch without such a place stays whole.
    """
    start = 0
    cut = re.compile(r"(?<=[0-9A-Za-z]) (?=[0-9A-Za-z])")
    while len(text) - start > most and (m := cut.search(text, start + most)):
        yield text[start:m.start()]
        start = m.start()
    yield text[start:] if start else text


class Encoder:
    """Ids of texts; no special tokens are added.

    ``added`` says whether strings of added tokens get their ids, as in the library
    with the file as it is; if not, they are ordinary text.
    """

    def __init__(self, path: str, kind: str, kept: int = KEPT, added: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added
        strings = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()] if added else []
        # Normalizers may fold case, so any case goes to the library.
        self.whole = re.compile("|".join(map(re.escape, strings)), re.IGNORECASE) if strings else None
        self.model = self.tokenizer.model
        self.kind, self.kept = kind, kept
        self.classes, self.letters = _classes(), _byte_letters()
        draw = np.random.default_rng(7)
        self.weights = draw.integers(1, 2**63, 256, dtype=np.uint64)
        self.base = 0x9E3779B97F4A7C15
        self.powers = self.inverses = np.ones(1, dtype=np.uint64)
        self._forget()

    def _forget(self) -> None:
        self.slots: dict[int, int] = {}
        self.chunks: dict[str, bytes] = {}
        self.counts, self.places = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.pool, self.filled, self.chunk_bytes = np.zeros(1 << 18, np.uint32), 0, 0

    def _powers(self, n: int) -> None:
        if len(self.powers) < n:
            with np.errstate(over="ignore"):
                for name, base in (("powers", self.base), ("inverses", pow(self.base, -1, 1 << 64))):
                    steps = np.full(n, base, dtype=np.uint64)
                    steps[0] = 1
                    setattr(self, name, np.multiply.accumulate(steps))

    def _cut(self, codes: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """True where a pre-token begins; begins: where a text begins."""
        kinds = self.classes[codes]
        starts = np.empty(len(codes), dtype=bool)
        starts[0] = True
        np.not_equal(kinds[1:], kinds[:-1], out=starts[1:])
        if self.kind == "words":
            starts |= kinds == _DIGIT
        else:
            blank = kinds == _BLANK
            last = np.zeros(len(codes), dtype=bool)  # blanks right before something else
            last[:-1] = blank[:-1] & ~blank[1:]
            joined = np.zeros(len(codes), dtype=bool)
            joined[1:] = last[:-1] & (codes[:-1] == 0x20)
            last[begins[1:] - 1] = False
            starts |= last
            starts &= ~joined
        starts[begins] = True
        return starts

    def _model_ids(self, piece: bytes) -> list[int]:
        text = piece.decode("latin-1")
        if self.kind == "words":
            text = text.lower()
        if not text.isascii() or text[0] <= " " or "\x7f" in text or not text.isprintable():
            text = text.translate(self.letters)
        elif " " in text:
            text = text.replace(" ", self.letters[32])
        return [t.id for t in self.model.tokenize(text)]

    def _learn(self, hashes: list[int], pieces: list[bytes]) -> None:
        ids = [self._model_ids(p) for p in pieces]
        first, flat = len(self.slots), np.array([x for i in ids for x in i], dtype=np.uint32)
        while first + len(ids) > len(self.counts):
            self.counts, self.places = (np.concatenate([a, np.zeros_like(a)])
                                        for a in (self.counts, self.places))
        while self.filled + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        own = slice(first, first + len(ids))
        self.counts[own] = [len(i) for i in ids]
        self.places[own] = self.filled + np.cumsum(self.counts[own]) - self.counts[own]
        self.pool[self.filled:self.filled + len(flat)] = flat
        self.filled += len(flat)
        self.slots.update(zip(hashes, range(first, first + len(ids))))

    def _latin(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of texts that are not empty, all at once."""
        begins = np.cumsum([0] + [len(t) for t in texts])
        whole = b"".join(texts)
        codes = np.frombuffer(whole, dtype=np.uint8)
        n = len(codes)
        self._powers(n + 1)
        starts = np.flatnonzero(self._cut(codes, begins[:-1]))
        ends = np.append(starts[1:], n)
        if self.kind == "words":
            kept = self.classes[codes[starts]] != _BLANK
            starts, ends = starts[kept], ends[kept]
        with np.errstate(over="ignore"):
            sums = np.zeros(n + 1, dtype=np.uint64)
            np.cumsum(self.weights[codes] * self.powers[:n], out=sums[1:])
            hashes = (sums[ends] - sums[starts]) * self.inverses[starts]
        which, distinct = pd.factorize(hashes)
        hashes = distinct.tolist()
        if n > WIDEST:
            self.powers = self.inverses = np.ones(1, dtype=np.uint64)
        if len(self.slots) > self.kept or self.pool.nbytes > KEPT_BYTES:
            self._forget()
        new = [k for k, h in enumerate(hashes) if h not in self.slots]
        if new:
            seen = np.empty(len(hashes), dtype=np.int64)
            seen[which[::-1]] = np.arange(len(which) - 1, -1, -1)
            at = seen[new]
            self._learn([hashes[k] for k in new],
                        [whole[s:e] for s, e in zip(starts[at].tolist(), ends[at].tolist())])
        slots = np.fromiter(map(self.slots.__getitem__, hashes), np.int64, len(hashes))[which]
        counts = self.counts[slots]
        until = np.cumsum(counts)
        total = int(until[-1]) if len(until) else 0
        ids = self.pool[np.repeat(self.places[slots] - until + counts, counts) + np.arange(total)]
        edges = np.concatenate([[0], until])[np.searchsorted(starts, begins)]
        return [ids[a:b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]

    def _any(self, text: str) -> np.ndarray:
        chunks = KINDS[self.kind].findall(text)
        new = [c for c in dict.fromkeys(chunks) if c not in self.chunks]
        if len(self.chunks) + len(new) > self.kept or self.chunk_bytes > KEPT_BYTES:
            self.chunks.clear()
            self.chunk_bytes = 0
            new = list(dict.fromkeys(chunks))
        for c, e in zip(new, self.tokenizer.encode_batch_fast(new, add_special_tokens=False)):
            self.chunks[c] = np.array(e.ids, dtype=np.uint32).tobytes()
            self.chunk_bytes += 4 * len(c) + len(self.chunks[c])
        return np.frombuffer(b"".join([self.chunks[c] for c in chunks]), dtype=np.uint32)

    def many(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids (uint32) of each text; null is an empty text."""
        parts: list[list[np.ndarray | None]] = []
        waiting: list[tuple[int, int, bytes]] = []
        size = 0

        def flush() -> None:
            nonlocal size
            if waiting:
                for (i, k, _), ids in zip(waiting, self._latin([w for _, _, w in waiting])):
                    parts[i][k] = ids
            waiting.clear()
            size = 0

        for i, text in enumerate(texts):
            parts.append([])
            if text and self.whole and self.whole.search(text):
                parts[i].append(np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32))
                continue
            for section in sections(text or ""):
                if not section:
                    continue
                parts[i].append(None)
                try:
                    if "'" in section:
                        raise ValueError
                    latin = section.encode("latin-1")
                except ValueError:
                    parts[i][-1] = self._any(section)
                    continue
                waiting.append((i, len(parts[i]) - 1, latin))
                size += len(latin)
                if size >= AT_ONCE:
                    flush()
        flush()
        none = np.zeros(0, np.uint32)
        return [p[0] if len(p) == 1 else np.concatenate([none, *p]) for p in parts]


_loaded: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, kind: str) -> Encoder:
    """The worker's encoder for a tokenizer file as it is, loaded once."""
    if (path, kind) not in _loaded:
        _loaded[path, kind] = Encoder(path, kind, added=True)
    STORES["tokens"] = _loaded.clear
    return _loaded[path, kind]
