"""The parts of a piece model file that offset-preserving encoding needs: pieces and the normaliser's compiled map."""

from __future__ import annotations

import re
import struct
from functools import lru_cache

import numpy as np

SPACE = "▁".encode()

#: Field numbers and types of the model file's message format (fixed values).
PIECES, NORMALISER = 1, 3
PIECE_TEXT, PIECE_TYPE = 1, 3
MAP, DUMMY_PREFIX, STRIP, ESCAPE = 2, 3, 4, 5
USER_DEFINED, BYTE = 4, 6


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 127) << shift
        at, shift = at + 1, shift + 7
        if byte < 128:
            return value, at


def message(data: bytes) -> list[tuple[int, int | bytes, bytes]]:
    """(field, value, the field as it stands) of one message in wire format."""
    fields, at = [], 0
    while at < len(data):
        start = at
        tag, at = _varint(data, at)
        kind = tag & 7
        if kind == 0:
            value, at = _varint(data, at)
        else:
            if kind == 2:
                size, at = _varint(data, at)
            else:
                size = {1: 8, 5: 4}[kind]
            value, at = data[at : at + size], at + size
        fields.append((tag >> 3, value, data[start:at]))
    return fields


def _field(number: int, value: int | bytes) -> bytes:
    def varint(n: int) -> bytes:
        out = bytearray()
        while n > 127:
            out.append(n & 127 | 128)
            n >>= 7
        return bytes([*out, n])

    if isinstance(value, int):
        return varint(number << 3) + varint(value)
    return varint(number << 3 | 2) + varint(len(value)) + value


class CharacterMap:
    """The compiled map: a double-array trie over UTF-8 prefixes, and the replacements it points to."""

    def __init__(self, blob: bytes):
        size = struct.unpack("<I", blob[:4])[0] if blob else 0
        self.units = np.frombuffer(blob[4 : 4 + size], "<u4").tolist()
        self.replacements = blob[4 + size :]
        starts = [b for b in range(256) if self.units and self._step(0 ^ self._offset(self.units[0]), b)]
        self.first = re.compile(b"[" + b"".join(b"\\x%02x" % b for b in starts) + b"]") if starts else None

    @staticmethod
    def _offset(unit: int) -> int:
        return unit >> 10 << ((unit & 512) >> 6)

    def _step(self, place: int, byte: int) -> tuple[int, int | None] | None:
        place ^= byte
        if place >= len(self.units):
            return None
        unit = self.units[place]
        if unit & 0x800000FF != byte:
            return None
        place ^= self._offset(unit)
        return place, self.units[place] & 0x7FFFFFFF if unit >> 8 & 1 else None

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest mapped prefix of ``data[at:]`` and its replacement."""
        if not self.units:
            return None
        place, found, i = self._offset(self.units[0]), None, at
        while i < len(data) and (step := self._step(place, data[i])):
            place, value = step
            i += 1
            if value is not None:
                found = i - at, value
        if not found:
            return None
        return found[0], self.replacements[found[1] : self.replacements.index(b"\0", found[1])]


class PieceModel:
    """Pieces of a model file, its normaliser, and the encoder behind it."""

    def __init__(self, data: bytes):
        import sentencepiece

        texts, kinds, spec, rest = [], [], {}, []
        for number, value, raw in message(data):
            if number == PIECES:
                fields = {n: v for n, v, _ in message(value)}
                texts.append(fields.get(PIECE_TEXT, b""))
                kinds.append(fields.get(PIECE_TYPE, 1))
            if number == NORMALISER:
                spec = {n: v for n, v, _ in message(value)}
            else:
                rest.append(raw)
        self.texts = texts
        self.map = CharacterMap(spec.get(MAP, b""))
        self.prefix, self.strip, self.escape = (bool(spec.get(n, 1)) for n in (DUMMY_PREFIX, STRIP, ESCAPE))
        own = sorted((t for t, k in zip(texts, kinds) if k == USER_DEFINED), key=len, reverse=True)
        self.own = re.compile(b"|".join(map(re.escape, own))) if own else None
        plain = _field(DUMMY_PREFIX, 0) + _field(STRIP, 0) + _field(ESCAPE, int(self.escape))
        # Normalisation is done here, so the encoder gets the same pieces behind an idle normaliser.
        self.encoder = sentencepiece.SentencePieceProcessor(model_proto=b"".join(rest) + _field(NORMALISER, plain))
        self.decoder = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.length = np.array([1 if k == BYTE else len(t) for t, k in zip(texts, kinds)], np.int64)
        self.unknown = self.encoder.unk_id()
        self.spells = BYTE in kinds  # characters without a piece become bytes, so none is unknown

    @property
    def idle(self) -> bool:
        """Whether normalising maps, strips and collapses nothing."""
        return not (self.map.units or self.own or self.strip)

    def normalise(self, data: bytes) -> tuple[bytes, np.ndarray]:
        """Normalised bytes, and for each of them and the end the offset in ``data`` it stands for.

        Longest-prefix replacement through the compiled map, white space stripped and collapsed if the model says so,
        spaces written as the model's mark, one more at the front if it says so. Bytes of a replacement stand for the
        start of what they replace; unmapped bytes for themselves.
        """
        if not data:
            return b"", np.zeros(1, np.int64)
        mark = SPACE if self.escape else b" "
        if not self.map.units and not self.own and not self.strip:
            text, origin = data, np.arange(len(data) + 1, dtype=np.int64)
        else:
            text, origin = self._replaced(data)
            if self.strip:
                text, origin = self._collapsed(text, origin, mark)
                if not text:
                    return b"", np.array([len(data)], np.int64)
        if self.escape and b" " in text:
            codes = np.frombuffer(text, np.uint8)
            origin = np.repeat(origin, np.append(np.where(codes == 32, len(mark), 1), 1))
            text = text.replace(b" ", mark)
        if self.prefix:
            text = mark + text
            origin = np.concatenate([np.full(len(mark), origin[0]), origin])
        return text, origin

    def _replaced(self, data: bytes) -> tuple[bytes, np.ndarray]:
        out, origins, at, end = [], [], 0, len(data)
        while at < end:
            own = self.own and self.own.match(data, at)
            if own:
                size, new, origin = own.end() - at, own.group(), np.arange(at, own.end())
            elif found := self.map.longest(data, at):
                size, new = found
                origin = np.full(len(new), at)
            else:  # on to the next place where anything can match, at a character's start
                place = at + 1
                while place < end:
                    jump = self.map.first.search(data, place) if self.map.first else None
                    mine = self.own.search(data, place) if self.own else None
                    place = min([m.start() for m in (jump, mine) if m], default=end)
                    if place == end or data[place] & 192 != 128:
                        break
                    place += 1
                size, new, origin = place - at, data[at:place], np.arange(at, place)
            out.append(new)
            origins.append(origin)
            at += size
        return b"".join(out), np.concatenate([*origins, [end]]).astype(np.int64)

    @staticmethod
    def _collapsed(text: bytes, origin: np.ndarray, mark: bytes) -> tuple[bytes, np.ndarray]:
        codes = np.frombuffer(text, np.uint8)
        space = codes == 32
        keep = ~space | ~np.concatenate([[True], space[:-1]])
        kept, starts, end = codes[keep].tobytes(), origin[:-1][keep], origin[-1]
        while kept.endswith((b" ", mark)):  # a mark at the end counts as a space, one elsewhere does not
            size = 1 if kept.endswith(b" ") else len(mark)
            kept, end, starts = kept[:-size], starts[-size], starts[:-size]
        return kept, np.append(starts, end)

    def encode(self, text: str) -> tuple[list[int], np.ndarray, np.ndarray, np.ndarray]:
        """Ids, the same as an array, and for each of them the first and the end byte of its span in the UTF-8 text."""
        normal, origin = self.normalise(text.encode())
        ids = self.encoder.encode(normal.decode())
        at = np.array(ids, np.int64)
        sizes = self.length[at]
        if not self.spells and (at == self.unknown).any():  # an unknown piece has no length of its own
            parts = self.encoder.encode(normal.decode(), out_type="immutable_proto").pieces
            sizes = np.array([len(p.surface.encode()) for p in parts], np.int64)
        ends = np.cumsum(sizes)
        return ids, at, origin[ends - sizes], origin[ends]


@lru_cache(maxsize=4)
def load(path: str) -> PieceModel:
    """The model at ``path``, read once per Python worker."""
    with open(path, "rb") as file:
        return PieceModel(file.read())
