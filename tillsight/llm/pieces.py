"""SentencePiece BPE: ids by a table of each prefix's last token, and texts from ids.

The encoding of a text's prefix ends in exactly one token. It is the piece that ends
there and goes with the last token of the prefix before it: two tokens go together
if merging their joint text from characters gives these two again. So one walk of an
Aho-Corasick automaton over the pieces fills a table of last tokens, and the ids are
read from it backwards. Whether two tokens go together depends on the merges inside
each that touch their border (``_border``) and is kept by pair.

Merges take the best score first and the leftmost of equal ones, as in the library, which
is asked for the vocabulary only. Characters without a piece are bytes; no merge
reaches across them. A text is cut where no piece can lie across (``CUTS``), and the
ids of repeated parts are kept by each worker, up to ``KEPT`` characters of them. Work
per text is linear in its length, whatever its parts are.

Defined results: a null or empty text has no tokens but the begin and end ids, and decodes
to an empty text. Rows with equal or null ``doc_id`` are encoded one by one. No rows give
no rows. Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterable, Iterator
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .workers import STORES, mapped

SPACE = "▁"
#: Where texts are cut, finest first; the first that leaves every piece whole is used.
CUTS = (r" *(?:[^\W\d_²]+|\d|(?:[^\w \n]|[_²])+|\n)| +", r" *[^ ]+| +", r"(?s:.+)")
#: Characters of parts kept by a worker, the longest part kept, and characters worked on at once.
KEPT, LONGEST, AT_ONCE = 10_000_000, 48, 1 << 18
#: Pairs of tokens whose verdict a worker keeps.
PAIRS = 400_000

codecs.register_error("tillsight-bytes", lambda e: ("�", e.start + 1))


class Pieces:
    """A SentencePiece BPE model with an identity normalizer and a space put first."""

    def __init__(self, path: str):
        import ahocorasick
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        ids = range(model.vocab_size())
        self.begin, self.end, self.unknown = model.bos_id(), model.eos_id(), model.unk_id()
        self.byte_ids = {int(model.id_to_piece(i)[1:-1], 16): i for i in ids if model.is_byte(i)}
        plain = [i for i in ids if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        self.texts = {i: model.id_to_piece(i).replace(SPACE, " ") for i in plain}
        self.ids = {text: i for i, text in self.texts.items()}
        self.scores = {text: model.get_score(i) for text, i in self.ids.items()}
        if missing := {c for text in self.ids for c in text} - self.ids.keys():
            raise ValueError(f"characters of pieces are no pieces: {sorted(missing)[:5]}")
        if max(map(len, self.ids), default=0) > 255 or len(ids) > 1 << 23:
            raise ValueError("pieces are longer, or more, than the table holds")
        self.cut = next(c for c in map(re.compile, CUTS) if all(c.findall(t) == [t] for t in self.ids)).findall
        self.automaton = ahocorasick.Automaton()
        for text, i in self.ids.items():
            if self._merged(text) == [text]:  # other pieces never come out of merges
                self.automaton.add_word(text, i << 8 | len(text))
        self.automaton.make_automaton()
        self.borders: tuple[dict[int, list], dict[int, list]] = ({}, {})
        self.pairs: dict[int, bool] = {}
        self.parts: dict[str, bytes] = {}
        self.kept = 0
        surfaces = {**{i: t.encode() for i, t in self.texts.items()}, self.unknown: " ⁇ ".encode()}
        self.surfaces = [surfaces.get(i, b"") for i in ids]
        self.bytes_of = {i: bytes([b]) for b, i in self.byte_ids.items()}

    def _merged(self, text: str, steps: list | None = None) -> list[str]:
        """The symbols that merging leaves of a short text; ``steps`` gets (score, place, symbols)."""
        symbols = list(text)
        while True:
            best = max(((self.scores[a + b], -k) for k, (a, b) in enumerate(zip(symbols, symbols[1:]))
                        if a + b in self.scores), default=None)
            if best is None:
                return symbols
            k = -best[1]
            symbols[k:k + 2] = [symbols[k] + symbols[k + 1]]
            if steps is not None:
                steps.append((best[0], symbols[0], symbols[-1]))

    def _border(self, token: int, side: int) -> list[tuple[float, str]]:
        """For every merge inside a token, its score and the token's symbol at the border after
        it; first of all, the border character. Side 0: the right end, 1: the left end."""
        known = self.borders[side].get(token)
        if known is None:
            text, steps = self.texts[token], []
            self._merged(text, steps)
            known = [(0.0, text[0] if side else text[-1]), *((s, first if side else last) for s, first, last in steps)]
            self.borders[side][token] = known
        return known

    def _together(self, a: int, b: int) -> bool:
        """Whether merging the joint text of two tokens gives the two: no merge crosses their
        border while those inside the tokens take their turns."""
        left, right, scores = self._border(a, 0), self._border(b, 1), self.scores
        i, j, none = 1, 1, float("-inf")
        while True:
            crossing = scores.get(left[i - 1][1] + right[j - 1][1], none)
            p = left[i][0] if i < len(left) else none
            q = right[j][0] if j < len(right) else none
            if crossing > p and crossing >= q and crossing > none:
                return False
            if p == q == none:
                return True
            if p >= q:
                i += 1
            else:
                j += 1

    def _part(self, part: str) -> bytes:
        """Ids (little-endian uint32) of a part that no piece lies across."""
        last = [-1] * (len(part) + 1)  # token and length, as in the automaton
        pairs, known = self.pairs, self.pairs.get
        for at, found in self.automaton.iter(part):
            if last[at + 1] < 0:
                before = last[at + 1 - (found & 255)]
                if before >= 0:  # else it is the start, or a character without a piece
                    pair = before << 32 | found
                    fits = known(pair)
                    if fits is None:
                        if len(pairs) >= PAIRS:
                            pairs.clear()
                        fits = pairs[pair] = self._together(before >> 8, found >> 8)
                    if not fits:
                        continue
                last[at + 1] = found
        ids: list[int] = []
        at = len(part)
        while at:
            found = last[at]
            if found < 0:
                ids.extend(self.byte_ids.get(b, self.unknown) for b in reversed(part[at - 1].encode()))
                at -= 1
            else:
                ids.append(found >> 8)
                at -= found & 255
        ids.reverse()
        return pack(f"<{len(ids)}I", *ids)

    def _parts(self, text: str) -> bytes:
        parts, own = self.cut(text), self.parts
        long: dict[str, bytes] = {}
        for part in set(parts).difference(own):
            ids = self._part(part)
            if len(part) > LONGEST:
                long[part] = ids
                continue
            if self.kept > KEPT:
                long.update(own)  # still wanted for this text
                own.clear()
                self.kept = 0
            own[part] = ids
            self.kept += len(part) + 8
        if long:
            return b"".join([long.get(p) or own[p] for p in parts])
        return b"".join(map(own.__getitem__, parts))

    def encode(self, text: str | None, begin: bool = True, end: bool = True) -> bytes:
        """Ids of a whole text, little-endian uint32."""
        out = [np.array([self.begin] if begin else [], dtype="<u4").tobytes()]
        if text:
            text, start = " " + text.replace(SPACE, " "), 0
            # A space after something else begins a part, so texts are worked on in sections.
            places = re.compile(r"(?<=[^ ]) ")
            while len(text) - start > AT_ONCE and (m := places.search(text, start + AT_ONCE)):
                out.append(self._parts(text[start:m.start()]))
                start = m.start()
            out.append(self._parts(text[start:]))
        out.append(np.array([self.end] if end else [], dtype="<u4").tobytes())
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """The text of little-endian uint32 ids; bytes that are no UTF-8 become U+FFFD one by one."""
        own = np.frombuffer(ids, dtype="<u4")
        out: list[str] = []
        first = True
        # Runs of byte tokens are decoded by themselves.
        is_byte = np.isin(own, list(self.bytes_of))
        edges = np.flatnonzero(np.diff(is_byte.astype(np.int8), prepend=-1, append=-1))
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            if is_byte[a]:
                out.append(b"".join(map(self.bytes_of.__getitem__, own[a:b].tolist())).decode("utf-8", "tillsight-bytes"))
                first = False
                continue
            for at in range(a, b, AT_ONCE):
                surfaces = list(map(self.surfaces.__getitem__, own[at:min(b, at + AT_ONCE)].tolist()))
                text = b"".join(surfaces).decode()
                if first and text:
                    opening = next(s for s in surfaces if s)
                    text, first = text[1:] if opening.startswith(b" ") and opening != " ⁇ ".encode() else text, False
                out.append(text)
        return "".join(out)


_loaded: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    """The worker's model of a file, loaded once."""
    if path not in _loaded:
        _loaded[path] = Pieces(path)
    STORES["pieces"] = _loaded.clear
    return _loaded[path]


def _mapped(rows: DataFrame, model: str, ddl: str, schema: pa.Schema, of) -> DataFrame:
    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pieces(model)
        for batch in batches:
            for at in range(0, len(batch), 64):
                some = batch.slice(at, 64)
                made = [of(own, value.as_py()) for value in some.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), *(pa.array(c, f.type) for c, f in zip(zip(*made), list(schema)[1:]))],
                    schema=schema)

    return mapped(rows, work, ddl, "pieces")


_ID, _COUNT = ("doc_id", pa.int64()), ("n_tokens", pa.int64())


def encode(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, n_tokens, ids): ids with begin and end, little-endian uint32."""
    def of(own: Pieces, text: str | None):
        ids = own.encode(text)
        return len(ids) // 4, ids

    return _mapped(docs.select(F.col("doc_id").cast("long"), "text"), model, "doc_id long, n_tokens long, ids binary",
                   pa.schema([_ID, _COUNT, ("ids", pa.binary())]), of)


def decode(rows: DataFrame, model: str) -> DataFrame:
    """(doc_id, text) of rows with ``doc_id`` and ``ids`` as ``encode`` gives them; null ids are none."""
    return _mapped(rows.select(F.col("doc_id").cast("long"), "ids"), model, "doc_id long, text string",
                   pa.schema([_ID, ("text", pa.string())]), lambda own, ids: (own.decode(ids or b""),))


def round_trip(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) in one pass over the texts."""
    def of(own: Pieces, text: str | None):
        ids = own.encode(text)
        return len(ids) // 4, ids, own.decode(ids)

    return _mapped(docs.select(F.col("doc_id").cast("long"), "text"), model,
                   "doc_id long, n_tokens long, ids binary, decoded string",
                   pa.schema([_ID, _COUNT, ("ids", pa.binary()), ("decoded", pa.string())]), of)
