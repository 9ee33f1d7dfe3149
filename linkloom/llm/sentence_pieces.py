"""SentencePiece byte-pair models: texts to ids and back, as Column functions.

Such a model merges the adjacent pair whose joined piece has the highest score, the leftmost of equals, until none can be
merged; any two neighbours whose joined text is a piece may merge. A row of pieces is the encoding of a text exactly if each
piece alone and each two neighbours, merged anew, come out as they are: the first merge across a border in the
whole text would be made in the text of the two neighbours too. So a text is encoded from the left, longest match
first: an Aho-Corasick automaton gives the longest piece at every place, shorter ones are its prefixes, neighbours are
accepted when re-merging the two leaves them apart, and where nothing fits the last piece is taken back. Places
where nothing fitted are marked in a bitfield and never reached again, so the work is linear in the text.

Texts are cut where no piece can reach across (before spaces, after letters, around line feeds), and the ids of these stretches are
remembered, ``WORDS`` at most in each worker. A stretch without spaces may have any length.

Only models without text normalisation are taken (spaces become U+2581, one is put in front); others are an error.

Defined cases: a null or empty text has no ids; characters without a piece become byte pieces; U+2581 in a text is
a space. Decoding takes any ids: control pieces are empty, bytes that are no UTF-8 become U+FFFD one by one, null ids and ids outside the
vocabulary count as the unknown piece, a null list gives null. Rows are independent, so repeated rows, ties, empty tables and
further columns need no rule.
"""

from __future__ import annotations

import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F

SPACE = "▁"
UNKNOWN_TEXT = " ⁇ "
# Stretches end before a space, after letters and at line feeds: whether they do depends on the two characters there alone, so
# where no piece of a model is cut by it, no text of that model is cut within a piece.
LETTERS = "A-Za-z\u00c0-\u024f\u0370-\u052f"
STRETCH_RE = re.compile(
    rf"\n|{SPACE}*[^{SPACE}\n{LETTERS}]*[{LETTERS}]+|{SPACE}+[^{SPACE}\n{LETTERS}]*|[^{SPACE}\n{LETTERS}]+"
)
# What a worker remembers; it starts anew beyond that.
WORDS = 300_000
LONGEST_WORD = 64
PAIRS = 200_000
# Characters of text, or ids, worked on at a time.
SLICE = 1 << 18
ROWS = 256


class Model:
    """The vocabulary of a model file, ready for encoding and decoding."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        given = sentencepiece.SentencePieceProcessor(model_file=path)
        if given.normalize(f" a  b \n{SPACE}ﬁ") != f"{SPACE * 2}a{SPACE * 2}b{SPACE}\n{SPACE}ﬁ":
            raise ValueError("the model normalises texts")
        self.size = given.get_piece_size()
        self.unknown = given.unk_id()
        self.ids: dict[str, int] = {}
        self.scores: dict[str, float] = {}
        self.byte_ids = [0] * 256
        self.control = np.zeros(self.size, dtype=bool)
        self.spaced = np.zeros(self.size, dtype=bool)
        surface = []
        for i in range(self.size):
            piece = given.id_to_piece(i)
            if given.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value] = i
                surface.append(bytes([value]))
            elif given.is_control(i):
                self.control[i] = True
                surface.append(b"")
            elif given.is_unknown(i):
                surface.append(UNKNOWN_TEXT.encode())
            else:
                self.ids[piece] = i
                self.scores[piece] = given.get_score(i)
                self.spaced[i] = piece.startswith(SPACE)
                surface.append(piece.replace(SPACE, " ").encode())
        self.surface = surface
        self.lengths = np.array([len(s) for s in surface], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(surface), dtype=np.uint8)
        self.automaton = ahocorasick.Automaton()
        for piece in self.ids:
            self.automaton.add_word(piece, piece)
        self.automaton.make_automaton()
        # The longest piece, or else the first character, that a piece starts with.
        self.shorter = {
            piece: next((piece[:k] for k in range(len(piece) - 1, 0, -1) if piece[:k] in self.ids), piece[0])
            for piece in self.ids
            if len(piece) > 1
        }
        whole = all(len(STRETCH_RE.findall(piece)) == 1 for piece in self.ids)
        self.stretches = STRETCH_RE if whole else re.compile("(?s).+")
        self.forget()

    def forget(self) -> None:
        self.places = _Places(self)
        self.found = array("i")
        self.first = array("q", [0])
        self.apart: dict[tuple[str, str], bool] = {}

    def remerged(self, text: str) -> list[str]:
        """The pieces of a short text, by merging its characters."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fits(self, last: str, piece: str) -> bool:
        """Whether ``piece`` can follow ``last`` (empty at the start), by merging the two anew; kept in ``apart``."""
        if len(self.apart) >= PAIRS:
            self.apart.clear()
        known = self.remerged(last + piece) == ([last, piece] if last else [piece])
        self.apart[last, piece] = known
        return known

    def pieces(self, text: str) -> list[str]:
        """Exact pieces of a stretch, with backtracking; characters without a piece stand for themselves."""
        longest = list(text)
        for end, piece in self.automaton.iter(text):
            # Ends come in order, so the last match from a place is its longest.
            longest[end - len(piece) + 1] = piece
        open_ = bytearray(b"\xff") * (len(text) // 8 + 1)
        shorter, apart, n = self.shorter.get, self.apart, len(text)
        taken: list[str] = []
        at, piece, last = 0, longest[0], ""
        while at < n:
            end = at + len(piece)
            if open_[end >> 3] >> (end & 7) & 1:
                fits = apart.get((last, piece))
                if fits if fits is not None else self.fits(last, piece):
                    taken.append(piece)
                    at, last = end, piece
                    piece = longest[at] if at < n else ""
                    continue
            piece = shorter(piece)
            if piece is None:
                open_[at >> 3] &= ~(1 << (at & 7))
                piece = taken.pop()
                at -= len(piece)
                last = taken[-1] if taken else ""
        return taken

    def encode_stretch(self, text: str) -> list[int]:
        ids: list[int] = []
        for piece in self.pieces(text):
            known = self.ids.get(piece)
            if known is not None:
                ids.append(known)
            else:
                ids.extend(self.byte_ids[b] for b in piece.encode())
        return ids

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and how many each text has."""
        flat, counts = [], np.zeros(len(texts), dtype=np.int64)
        start = 0
        while start < len(texts):
            words, ends, chars, i = [], [], 0, start
            while i < len(texts) and (i == start or chars < SLICE):
                text = texts[i]
                if text:
                    chars += len(text)
                    words += self.stretches.findall(SPACE + text.replace(" ", SPACE))
                ends.append(len(words))
                i += 1
            if len(self.places) > WORDS:
                self.forget()
            at = np.fromiter(map(self.places.__getitem__, words), dtype=np.int64, count=len(words))
            first, found = np.frombuffer(self.first, dtype=np.int64), np.frombuffer(self.found, dtype=np.int32)
            sizes = first[at + 1] - first[at]
            upto = np.concatenate(([0], np.cumsum(sizes)))
            flat.append(found[np.repeat(first[at] - upto[:-1], sizes) + np.arange(upto[-1])])
            counts[start:i] = np.diff(upto[np.array(ends)], prepend=0)
            # Let the arrays grow again; stretches too long to be kept are the last in them.
            del first, found
            self.places.drop_passing()
            start = i
        return np.concatenate([np.zeros(0, dtype=np.int32), *flat]), counts

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """UTF-8 texts of lists of ids that lie one after the other."""
        texts: list[bytes] = []
        ends = np.cumsum(counts)
        start = 0
        while start < len(counts):
            base = ends[start] - counts[start]
            stop = max(int(np.searchsorted(ends, base + SLICE, side="right")), start + 1)
            texts += self._decode_slice(ids[base : ends[stop - 1]], counts[start:stop])
            start = stop
        return texts

    def _decode_slice(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        firsts, sizes = self.starts[ids], self.lengths[ids]
        upto = np.cumsum(counts)
        # The space in front of a text goes, with any control pieces before it.
        seen = np.concatenate((np.flatnonzero(~self.control[ids]), [len(ids)]))
        lead = seen[np.searchsorted(seen, upto - counts)]
        lead = lead[lead < upto]
        lead = lead[self.spaced[ids[lead]]]
        firsts[lead] += 1
        sizes[lead] -= 1
        reach = np.concatenate(([0], np.cumsum(sizes)))
        joined = self.bytes[np.repeat(firsts - reach[:-1], sizes) + np.arange(reach[-1])].tobytes()
        cuts = np.concatenate(([0], reach[upto])).tolist()
        texts = [joined[a:b] for a, b in zip(cuts, cuts[1:])]
        if not joined.isascii():
            for i, text in enumerate(texts):
                try:
                    text.decode()
                except UnicodeDecodeError:
                    texts[i] = _mended(text)
        # Bytes on both sides of a control piece are no character.
        for i in np.unique(np.searchsorted(upto, np.flatnonzero(self.control[ids]), side="right")).tolist():
            runs = np.split(np.arange(upto[i] - counts[i], upto[i]), np.flatnonzero(self.control[ids[upto[i] - counts[i] : upto[i]]]))
            texts[i] = b"".join(_mended(joined[reach[r[0]] : reach[r[-1] + 1]]) for r in runs if len(r))
        return texts


class _Places(dict):
    """Place of each stretch among those found; a new stretch is encoded."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model
        self.passing: list[str] = []

    def __missing__(self, stretch: str) -> int:
        model = self.model
        place = len(model.first) - 1
        model.found.extend(model.encode_stretch(stretch))
        model.first.append(len(model.found))
        self[stretch] = place
        if len(stretch) > LONGEST_WORD:
            self.passing.append(stretch)
        return place

    def drop_passing(self) -> None:
        """Forget all when long stretches have come to more than the rest may."""
        if self.passing:
            for stretch in self.passing:
                del self[stretch]
            self.passing = []
            if len(self.model.found) > 16 * WORDS:
                self.model.forget()


def _mended(text: bytes) -> bytes:
    """Bytes that belong to no UTF-8 character are replaced, each by one U+FFFD."""
    out, at = [], 0
    while at < len(text):
        lead = text[at]
        size = 1 if lead < 0x80 else 2 if 0xC2 <= lead < 0xE0 else 3 if 0xE0 <= lead < 0xF0 else 4 if 0xF0 <= lead < 0xF5 else 0
        part = text[at : at + size]
        try:
            out.append(part.decode() if size else "�")
            at += size or 1
        except UnicodeDecodeError:
            out.append("�")
            at += 1
    return "".join(out).encode()


@lru_cache(maxsize=2)
def model(path: str) -> Model:
    return Model(path)


def lists(flat: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    """An Arrow array of lists from values side by side and the size of each list."""
    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def encode(text: Column | str, path: str) -> Column:
    """Ids of a text by the model file at ``path``, without begin and end ids; ``array<int>``."""

    @F.arrow_udf("array<int>")
    def ids(texts: pa.Array) -> pa.Array:
        # Few of the texts are Python strings at a time.
        found = [model(path).encode(texts.slice(i, ROWS).to_pylist()) for i in range(0, len(texts), ROWS)]
        flat, counts = zip(*found) if found else ([np.zeros(0, dtype=np.int32)], [np.zeros(0, dtype=np.int64)])
        return lists(np.concatenate(flat), np.concatenate(counts))

    return ids(text)


def _texts(known: Model, given: pa.Array) -> pa.Array:
    counts = np.asarray(given.value_lengths().fill_null(0)).astype(np.int64)
    flat = np.asarray(given.flatten().cast(pa.int64()).fill_null(known.unknown))
    flat = np.where((flat < 0) | (flat >= known.size), known.unknown, flat)
    found = pa.array(known.decode(flat, counts), type=pa.binary()).cast(pa.string())
    return pa.compute.if_else(given.is_null(), pa.scalar(None, pa.string()), found)


def decode(ids: Column | str, path: str) -> Column:
    """Text of a list of ids by the model file at ``path``."""

    @F.arrow_udf("string")
    def text(given: pa.Array) -> pa.Array:
        known = model(path)
        parts = [_texts(known, given.slice(i, ROWS)) for i in range(0, len(given), ROWS)]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.string())

    return text(ids)


def round_trip(text: Column | str, path: str) -> Column:
    """``ids`` of a text and the ``text`` they decode to, with one vocabulary in memory for both."""

    @F.arrow_udf("struct<ids: array<int>, text: string>")
    def both(texts: pa.Array) -> pa.Array:
        known, parts = model(path), []
        for i in range(0, len(texts), ROWS):
            ids = lists(*known.encode(texts.slice(i, ROWS).to_pylist()))
            parts.append(pa.StructArray.from_arrays([ids, _texts(known, ids)], names=["ids", "text"]))
        return pa.concat_arrays(parts) if parts else pa.array([], pa.struct([("ids", pa.list_(pa.int32())), ("text", pa.string())]))

    return both(text)
