"""Encoding and decoding with a SentencePiece BPE model, every piece projected to bytes of the text.

1. A text is normalised by the longest prefixes found in the model's compiled character map. A text's map
   lookups run together, one trie step for all places at a time. Each normalised byte remembers the byte of the
   text that it comes from.
2. The normalised text is cut where no piece of the vocabulary reaches across (in front of a run of blanks, and
   around characters that are in no longer piece), so merges on both sides do not see each other. A worker merges
   each different cut once, many at a time, and remembers its pieces, up to ``REMEMBERED`` of them; this changes the
   work only.
3. Pieces of all cuts are gathered with NumPy. Their sizes, added up, give places in the normalised text, and the
   remembered bytes turn these into spans of the text.

The model is read once by the driver, at most ``MODEL_BYTES``, and goes to the tasks with the plan. Models that are
not BPE, or that have user-defined or unused pieces, are refused.

Odd input: a null text is an empty one, an empty text has the end id only (span at 0). Bytes that are no UTF-8 are
read as U+FFFD, and spans count in the text so read. A text is never cut, however long: one without any
place to cut takes time in proportion to n log n. Repeated rows and ids give a row each; an empty table gives an
empty table; other columns of the table are not looked at.
"""

from __future__ import annotations

import codecs
import functools
import heapq
import os
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import id_and_text

#: A model file above this is refused, cuts a worker remembers, and bytes of text handled at a time.
MODEL_BYTES, REMEMBERED, RUN_BYTES = 64 << 20, 400_000, 4 << 20
#: Fixed values of the model format: piece types, the model type, and the sign for a blank.
NORMAL, UNKNOWN, CONTROL, BYTE, BPE = 1, 2, 3, 6, 2
BLANK = "▁"
_BLANK_BYTES = np.frombuffer(BLANK.encode(), dtype=np.uint8)

codecs.register_error("one_for_each_byte", lambda e: ("�", e.start + 1))


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and values of the fields of a protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = number()
        kind = key & 7
        if kind == 0:
            yield key >> 3, number()
            continue
        size = {1: 8, 5: 4}.get(kind)
        if size is None:
            size = number()
        yield key >> 3, data[at : at + size]
        at += size


@dataclass(frozen=True)
class CharMap:
    """The compiled character map: a double-array trie over UTF-8 prefixes, and what they turn into."""

    units: np.ndarray
    outputs: np.ndarray

    @staticmethod
    def read(blob: bytes) -> CharMap | None:
        if not blob:
            return None
        size = struct.unpack_from("<I", blob)[0]
        units = np.frombuffer(blob, dtype="<u4", count=size // 4, offset=4).astype(np.int64)
        return CharMap(units, np.frombuffer(blob, dtype=np.uint8, offset=4 + size))

    def longest(self, data: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Length of the longest prefix at each place (0: none), and where its output begins."""
        length, value = np.zeros(len(places), np.int64), np.zeros(len(places), np.int64)
        live = np.arange(len(places))
        node = np.full(len(places), self._child(self.units[:1])[0])
        depth = 0
        while len(live):
            inside = places[live] + depth < len(data)
            live, node = live[inside], node[inside]
            byte = data[places[live] + depth].astype(np.int64)
            node = node ^ byte
            known = node < len(self.units)
            live, node, byte = live[known], node[known], byte[known]
            unit = self.units[node]
            fits = (unit & 0x800000FF) == byte
            live, unit = live[fits], unit[fits]
            node = node[fits] ^ self._child(unit)
            depth += 1
            leaf = (unit >> 8) & 1 == 1
            length[live[leaf]] = depth
            value[live[leaf]] = self.units[node[leaf]] & 0x7FFFFFFF
        return length, value

    @staticmethod
    def _child(unit: np.ndarray) -> np.ndarray:
        return (unit >> 10) << ((unit & 512) >> 6)


@dataclass(frozen=True)
class Model:
    """Pieces and settings of a model file."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    types: tuple[int, ...]
    chars: CharMap | None
    dummy: bool
    squeeze: bool
    escape: bool
    suffix: bool
    byte_fallback: bool
    unknown_surface: str

    @staticmethod
    def read(data: bytes) -> Model:
        pieces, scores, types, trainer, rules = [], [], [], {}, {}
        for field, value in _fields(data):
            if field == 1:
                piece = dict(_fields(value))
                pieces.append(piece[1].decode())
                scores.append(struct.unpack("<f", piece.get(2, b"\0\0\0\0"))[0])
                types.append(piece.get(3, NORMAL))
            elif field == 2:
                trainer = dict(_fields(value))
            elif field == 3:
                rules = dict(_fields(value))
            elif field == 5 and dict(_fields(value)).get(2):
                raise ValueError("models that rewrite decoded texts are not supported")
        if trainer.get(3, 1) != BPE or set(types) - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("only BPE models without user-defined or unused pieces are supported")
        return Model(
            tuple(pieces), tuple(scores), tuple(types), CharMap.read(rules.get(2, b"")),
            bool(rules.get(3, 1)), bool(rules.get(4, 1)), bool(rules.get(5, 1)), bool(trainer.get(24, 0)),
            bool(trainer.get(35, 0)), trainer.get(44, " ⁇ ".encode()).decode(),
        )

    def id_of(self, name: str, kind: int) -> int:
        found = [i for i, (p, t) in enumerate(zip(self.pieces, self.types, strict=True)) if t == kind and p == name]
        if not found:
            raise ValueError(f"the model has no piece {name}")
        return found[0]


def read_model(path: str) -> bytes:
    """The bytes of a model file on the driver's machine."""
    if os.path.getsize(path) > MODEL_BYTES:
        raise ValueError(f"{path} is larger than {MODEL_BYTES} bytes")
    with open(path, "rb") as file:
        return file.read()


def normalised(model: Model, text: str) -> tuple[np.ndarray, np.ndarray]:
    """The normalised text as bytes, and for each byte (and the end) the place in the text that it comes from."""
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    out, source, end = data, np.arange(len(data)), len(data)
    leading = np.ones(len(data), dtype=bool)
    if model.chars is not None and len(data):
        out, source, leading = _mapped(model.chars, data)
    if model.squeeze:
        blank = out == 0x20
        before = np.ones(len(out), dtype=bool)
        before[1:] = blank[:-1]
        kept = ~(blank & before & leading)
        out, source = out[kept], source[kept]
    if not len(data) or (model.squeeze and not len(out) and not _any_step(model, data)):
        return data[:0], np.zeros(1, np.int64)
    if model.escape:
        sizes = np.where(out == 0x20, 3, 1)
        at = np.concatenate([[0], np.cumsum(sizes)])
        wide = np.repeat(out, sizes)
        for j in range(3):
            wide[at[:-1][sizes == 3] + j] = _BLANK_BYTES[j]
        out, source = wide, np.repeat(source, sizes)
    sign = _BLANK_BYTES if model.escape else np.array([0x20], np.uint8)
    if model.dummy and not model.suffix:
        # The sign stands where the first byte that is kept begins.
        first = _first_place(model, data)
        out, source = np.concatenate([sign, out]), np.concatenate([np.full(len(sign), first), source])
    if model.squeeze:
        while len(out) >= len(sign) and (out[-len(sign) :] == sign).all():
            end = source[-len(sign)]
            out, source = out[: -len(sign)], source[: -len(sign)]
    if model.dummy and model.suffix:
        out, source = np.concatenate([out, sign]), np.concatenate([source, np.full(len(sign), end)])
    return out, np.concatenate([source, [end]])


def _steps(chars: CharMap, data: np.ndarray) -> tuple[np.ndarray, ...]:
    """Beginning and length of each prefix from left to right, and place and size of what it turns into."""
    starts = np.flatnonzero((data & 0xC0) != 0x80)
    size = np.diff(np.concatenate([starts, [len(data)]]))
    matched, value = chars.longest(data, starts)
    taken = np.where(matched > 0, matched, size)
    kept = np.ones(len(starts), dtype=bool)
    reach = 0
    for i in np.flatnonzero(taken > size):
        if starts[i] >= reach:
            reach = starts[i] + taken[i]
            kept[i + 1 : np.searchsorted(starts, reach)] = False
    starts, taken, matched, value = starts[kept], taken[kept], matched[kept], value[kept]
    ends = np.flatnonzero(chars.outputs == 0)
    out_at = np.where(matched > 0, value + len(data), starts)
    out_size = np.where(matched > 0, ends[np.minimum(np.searchsorted(ends, value), len(ends) - 1)] - value, taken)
    return starts, taken, out_at, out_size


def _mapped(chars: CharMap, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes after the character map, their sources, and whether only blanks of their prefix stand before them."""
    starts, _, out_at, out_size = _steps(chars, data)
    first = np.concatenate([[0], np.cumsum(out_size)])
    places = np.arange(first[-1]) + np.repeat(out_at - first[:-1], out_size)
    out = np.concatenate([data, chars.outputs])[places]
    filled = np.concatenate([[0], np.cumsum(out != 0x20)])
    leading = filled[:-1] == np.repeat(filled[first[:-1]], out_size)
    return out, np.repeat(starts, out_size), leading


def _heading(model: Model, data: np.ndarray) -> int:
    """How many steps at the beginning turn into one blank each."""
    if model.chars is None:
        blank, sizes = data == 0x20, None
    else:
        starts, taken, out_at, sizes = _steps(model.chars, data)
        both = np.concatenate([data, model.chars.outputs])
        blank = (sizes == 1) & (both[np.minimum(out_at, len(both) - 1)] == 0x20)
    return len(blank) if blank.all() else int(np.argmin(blank))


def _any_step(model: Model, data: np.ndarray) -> bool:
    """Whether a step is left after the blanks at the beginning."""
    steps = len(data) if model.chars is None else len(_steps(model.chars, data)[0])
    return _heading(model, data) < steps


def _first_place(model: Model, data: np.ndarray) -> int:
    if not model.squeeze:
        return 0
    heading = _heading(model, data)
    if model.chars is None:
        return heading
    starts = _steps(model.chars, data)[0]
    return int(starts[heading]) if heading < len(starts) else len(data)


class _Growing:
    """Numbers that are appended in runs."""

    def __init__(self, kind: type):
        self.held, self.size = np.zeros(1 << 16, dtype=kind), 0

    def extend(self, values: np.ndarray) -> None:
        while self.size + len(values) > len(self.held):
            self.held = np.concatenate([self.held, np.zeros_like(self.held)])
        self.held[self.size : self.size + len(values)] = values
        self.size += len(values)


class Merges:
    """Joins neighbours, best score and leftmost first, as long as they form a piece: of many cuts at a time.

    Signs are pieces and the characters in them, by number; a table of all pairs that form a piece gives its rank.
    Each round does the best join of every cut that has one.
    """

    NONE = 1 << 30

    def __init__(self, rank: dict[str, float]):
        signs = list(rank)
        number = {p: i for i, p in enumerate(signs)}
        for c in sorted({c for p in rank for c in p}):
            if c not in number:
                number[c] = len(signs)
                signs.append(c)
        self.signs, self.number = signs, number
        order = {score: i for i, score in enumerate(sorted(set(rank.values())))}
        pairs = {}
        for piece, score in rank.items():
            for i in range(1, len(piece)):
                left, right = number.get(piece[:i]), number.get(piece[i:])
                if left is not None and right is not None:
                    pairs[left * len(signs) + right] = (order[score], number[piece])
        self.keys = np.array(sorted(pairs), dtype=np.int64)
        self.ranks = np.array([pairs[k][0] for k in self.keys.tolist()], dtype=np.int64)
        self.wholes = np.array([pairs[k][1] for k in self.keys.tolist()], dtype=np.int64)
        single = [(ord(p), i) for p, i in number.items() if len(p) == 1]
        self.table = np.full(0x110000, -1, dtype=np.int32)
        if single:
            points, numbers = zip(*single, strict=True)
            self.table[list(points)] = numbers

    def _look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and number of what two signs form; ``NONE`` if that is no piece."""
        if not len(self.keys):
            return np.full(len(left), self.NONE), np.zeros(len(left), np.int64)
        key = left * len(self.signs) + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        fits = (self.keys[at] == key) & (left >= 0) & (right >= 0)
        return np.where(fits, self.ranks[at], self.NONE), self.wholes[at]

    def joined(self, points: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Signs of the pieces, the place of the first character of each, and its cut. Cuts come one after another."""
        sign, place = self.table[points].astype(np.int64), np.arange(len(points))
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        rank, whole = np.full(len(sign), self.NONE), np.zeros(len(sign), np.int64)
        inner = np.flatnonzero(cut[1:] == cut[:-1])
        rank[inner], whole[inner] = self._look_up(sign[inner], sign[inner + 1])
        while len(sign):
            starts = np.flatnonzero(np.concatenate([[True], cut[1:] != cut[:-1]]))
            best = np.minimum.reduceat((rank << 32) | np.arange(len(rank)), starts)
            live = best < self.NONE << 32
            if 2 * np.count_nonzero(live) <= len(live):
                # Cuts without a join are done and leave.
                stays = np.repeat(live, np.diff(np.concatenate([starts, [len(sign)]])))
                done.append((sign[~stays], place[~stays], cut[~stays]))
                sign, place, cut, rank, whole = (a[stays] for a in (sign, place, cut, rank, whole))
                continue
            at = best[live] & 0xFFFFFFFF
            sign[at] = whole[at]
            rest = np.ones(len(sign), dtype=bool)
            rest[at + 1] = False
            at = at - np.arange(len(at))
            sign, place, cut, rank, whole = (a[rest] for a in (sign, place, cut, rank, whole))
            # The joined sign has new neighbours on both sides.
            changed = np.concatenate([at, at[at > 0] - 1])
            last = changed + 1 >= len(sign)
            last[~last] = cut[changed[~last]] != cut[changed[~last] + 1]
            # A neighbour of the cut in front stays as it is: its last sign has no pair.
            rank[changed[last]] = self.NONE
            pair = changed[~last]
            rank[pair], whole[pair] = self._look_up(sign[pair], sign[pair + 1])
        order = np.argsort(np.concatenate([d[1] for d in done])) if done else np.zeros(0, np.int64)
        return tuple(np.concatenate([d[i] for d in done])[order] if done else order for i in range(3))


class Encoder:
    """Cuts of normalised texts and their pieces, merged when first met."""

    def __init__(self, data: bytes):
        model = self.model = Model.read(data)
        named = {p: i for i, (p, t) in enumerate(zip(model.pieces, model.types, strict=True)) if t == NORMAL}
        self.rank = {p: -model.scores[i] for p, i in named.items()}
        self.id = named
        self.unknown = model.types.index(UNKNOWN) if UNKNOWN in model.types else 0
        self.bytes = np.array([model.id_of(f"<0x{b:02X}>", BYTE) for b in range(256)]) if model.byte_fallback else None
        self.merges = Merges(self.rank)
        signs = self.merges.signs
        self.sign_id = np.array([named.get(p, -1) for p in signs], dtype=np.int64)
        self.sign_size = np.array([len(p.encode()) for p in signs], dtype=np.int64)
        self.blank_signs = np.array([p.count(BLANK) for p in signs], dtype=np.int64)
        longer = [p for p in named if len(p) > 1]
        inner = any(BLANK in p.lstrip(BLANK) for p in longer)
        joined = re.escape("".join(sorted({c for p in longer for c in p} - {BLANK})))
        #: A blank inside a piece would join cuts: such a model's texts are not cut.
        self.cut = re.compile("(?s).+" if inner or not joined else f"[^{joined}{BLANK}]|{BLANK}*[{joined}]+|{BLANK}+").findall
        #: The text is normalised by putting signs for blanks alone.
        self.plain = model.chars is None and model.dummy and model.escape and not model.squeeze and not model.suffix
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.ids, self.sizes, self.blanks, self.counts = (_Growing(np.int64) for _ in range(4))

    def _learn(self, cuts: list[str]) -> None:
        """Merge cuts never met before, the long ones each on its own."""
        self.number.update(zip(cuts, range(len(self.number), len(self.number) + len(cuts)), strict=True))
        points = np.frombuffer("".join(cuts).encode("utf-32-le"), dtype=np.uint32)
        lengths = np.array([len(c) for c in cuts])
        cut = np.repeat(np.arange(len(cuts)), lengths)
        long = np.flatnonzero(lengths > 64)
        short = np.flatnonzero(~np.isin(cut, long)) if len(long) else np.arange(len(points))
        sign, place, of = self.merges.joined(points[short], cut[short])
        place = short[place]
        if len(long):
            extra = [self._join_many(points[cut == i]) for i in long.tolist()]
            begins = np.concatenate([[0], np.cumsum(lengths)])
            sign = np.concatenate([sign, *[e[0] for e in extra]])
            place = np.concatenate([place, *[e[1] + begins[i] for e, i in zip(extra, long.tolist(), strict=True)]])
            order = np.argsort(place)
            sign, place = sign[order], place[order]
            of = cut[place]
        known = (sign >= 0) & (self.sign_id[sign] >= 0)
        ids, sizes = np.where(known, self.sign_id[sign], self.unknown), np.where(known, self.sign_size[sign], 0)
        blanks = np.where(known, self.blank_signs[sign], 0)
        odd = np.flatnonzero(~known)
        if len(odd):
            raw = [chr(p).encode() for p in points[place[odd]].tolist()]
            sizes[odd] = [len(r) for r in raw]
            blanks[odd] = [r == _BLANK_BYTES.tobytes() for r in raw]
            if self.bytes is not None:
                # Bytes of an unknown character; only the last holds its span.
                copies = np.ones(len(ids), dtype=np.int64)
                copies[odd] = [len(r) for r in raw]
                last = np.cumsum(copies) - 1
                spread = np.zeros(int(copies.sum()), dtype=np.int64)
                wide = {name: spread.copy() for name in ("ids", "sizes", "blanks")}
                wide["ids"], of = np.repeat(ids, copies), np.repeat(of, copies)
                wide["sizes"][last], wide["blanks"][last] = sizes, blanks
                inside = np.concatenate([np.arange(at - len(r) + 1, at + 1) for at, r in zip(last[odd].tolist(), raw, strict=True)])
                wide["ids"][inside] = self.bytes[np.frombuffer(b"".join(raw), dtype=np.uint8)]
                ids, sizes, blanks = wide["ids"], wide["sizes"], wide["blanks"]
        self.ids.extend(ids)
        self.sizes.extend(sizes)
        self.blanks.extend(blanks)
        self.counts.extend(np.bincount(of, minlength=len(cuts)))

    def _join_many(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The joins of one long cut from a heap, in n log n; joined parts leave a gap."""
        part: list[str | None] = [chr(p) for p in points.tolist()]
        size = len(part)
        before, after = list(range(-1, size - 1)), [*range(1, size), -1]
        rank, heap = self.rank, []
        for i in range(size - 1):
            score = rank.get(part[i] + part[i + 1])
            if score is not None:
                heap.append((score, i, i + 1, 2))
        heapq.heapify(heap)
        while heap:
            _, left, right, length = heapq.heappop(heap)
            if part[left] is None or part[right] is None or after[left] != right:
                continue
            whole = part[left] + part[right]
            if len(whole) != length:
                continue
            part[left], part[right] = whole, None
            follower = after[left] = after[right]
            if follower >= 0:
                before[follower] = left
                score = rank.get(whole + part[follower])
                if score is not None:
                    heapq.heappush(heap, (score, left, follower, length + len(part[follower])))
            leader = before[left]
            if leader >= 0:
                score = rank.get(part[leader] + whole)
                if score is not None:
                    heapq.heappush(heap, (score, leader, left, length + len(part[leader])))
        places = [i for i, p in enumerate(part) if p is not None]
        return np.array([self.merges.number.get(part[i], -1) for i in places], dtype=np.int64), np.array(places)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids, begins and ends of the pieces of some texts, and each text's first piece (and the end of all)."""
        if len(self.number) > REMEMBERED or self.ids.size > 16 * REMEMBERED:
            self.forget()
        # A sign for a blank that stands in the text itself has three bytes there, not one.
        plain = self.plain and not any(BLANK in t for t in texts)
        sources, cuts, per_text = [], [], []
        for text in texts:
            if plain:
                shown = BLANK + text.replace(" ", BLANK) if text else ""
            else:
                out, source = normalised(self.model, text)
                sources.append(source)
                shown = out.tobytes().decode()
            own = self.cut(shown)
            cuts += own
            per_text.append(len(own))
        codes = list(map(self.number.get, cuts))
        if None in codes:
            self._learn(list(dict.fromkeys(c for c, n in zip(cuts, codes, strict=True) if n is None)))
            codes = list(map(self.number.get, cuts))
        code = np.array(codes, dtype=np.int64)
        counts = self.counts.held[: self.counts.size]
        first = np.cumsum(counts) - counts
        count = counts[code]
        ends = np.cumsum(count)
        places = np.arange(ends[-1] if len(ends) else 0) + np.repeat(first[code] - (ends - count), count)
        ids, sizes = self.ids.held[places], self.sizes.held[places]
        cut_at = np.concatenate([[0], np.cumsum(per_text)]).astype(np.int64)
        begin = np.concatenate([[0], ends])[cut_at]
        if plain:
            sizes = sizes - 2 * self.blanks.held[places]
        if self.bytes is None:
            ids, sizes, begin = self._unknown_joined(ids, sizes, begin)
        stop = np.cumsum(sizes)
        base = np.concatenate([[0], stop])[begin[:-1]]
        pieces = np.diff(begin)
        if plain:
            # The sign in front is no byte of the text.
            stop = stop - np.repeat(base + 1, pieces)
            return ids, np.maximum(stop - sizes, 0), stop, begin
        # Places in all normalised texts one after another, each followed by its end.
        shift = np.cumsum([0] + [len(s) for s in sources])[:-1]
        move = np.repeat(shift - base, pieces)
        every = np.concatenate(sources) if sources else np.zeros(0, np.int64)
        return ids, every[stop - sizes + move], every[stop + move], begin

    def _unknown_joined(self, ids, sizes, begin):
        """Neighbouring unknown pieces of a text are one."""
        unknown = ids == self.unknown
        again = np.zeros(len(ids), dtype=bool)
        again[1:] = unknown[1:] & unknown[:-1]
        again[begin[:-1][begin[:-1] < len(ids)]] = False
        kept = np.flatnonzero(~again)
        sizes = np.add.reduceat(sizes, kept) if len(kept) else sizes
        return ids[kept], sizes, np.searchsorted(kept, begin)


class Decoder:
    def __init__(self, data: bytes):
        model = self.model = Model.read(data)
        self.surface = []
        for piece, kind in zip(model.pieces, model.types, strict=True):
            if kind == CONTROL:
                self.surface.append(b"")
            elif kind == UNKNOWN:
                self.surface.append(model.unknown_surface.encode())
            elif kind == BYTE:
                self.surface.append(bytes([int(piece[3:5], 16)]))
            else:
                self.surface.append(piece.replace(BLANK, " ").encode())
        self.strips = model.dummy or model.squeeze

    def decode(self, ids: list[int]) -> str:
        """The text of some ids; the blank in front, put there by normalising, is left out."""
        parts = list(map(self.surface.__getitem__, ids))
        if self.strips:
            for i, (part, number) in enumerate(zip(parts, ids, strict=True)):
                kind = self.model.types[number]
                if kind == CONTROL:
                    continue
                if kind == NORMAL and part.startswith(b" "):
                    parts[i] = part[1:]
                    if self.model.squeeze and not parts[i]:
                        continue
                break
        whole = b"".join(parts)
        try:
            return whole.decode()
        except UnicodeDecodeError:
            return whole.decode(errors="one_for_each_byte")


@functools.lru_cache(maxsize=2)
def _encoder(data: bytes) -> Encoder:
    return Encoder(data)


@functools.lru_cache(maxsize=2)
def _decoder(data: bytes) -> Decoder:
    return Decoder(data)


def _runs(column: pa.Array) -> Iterator[slice]:
    """Slices of a string column of about ``RUN_BYTES``; one text is never cut."""
    sizes = column.cast(pa.large_binary())
    offsets = np.frombuffer(sizes.buffers()[1], dtype=np.int64)[sizes.offset : sizes.offset + len(sizes) + 1]
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + RUN_BYTES, "right")) - 1)
        yield slice(at, to)
        at = to


def _texts(column: pa.Array) -> list[str]:
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


def encoded(docs: DataFrame, model: bytes, bos: bool = False, eos: bool = True, decode: bool = False) -> DataFrame:
    """``doc_id``, ``ids``, and ``begins`` and ``ends`` of every piece, in bytes of the text; with ``decode`` also the
    ``decoded`` text of the ids, which then need not travel once more."""
    read = Model.read(model)
    first = read.id_of("<s>", CONTROL) if bos else None
    last = read.id_of("</s>", CONTROL) if eos else None
    whole = pa.list_(pa.int32())
    out = pa.schema([("doc_id", pa.int64()), ("ids", whole), ("begins", whole), ("ends", whole)])
    out = out.append(pa.field("decoded", pa.string())) if decode else out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(model)
        for batch in batches:
            column = batch.column("text")
            for part in _runs(column):
                own = column.slice(part.start, part.stop - part.start)
                texts = [t.decode(errors="one_for_each_byte") for t in _texts(own)]
                ids, begins, ends, at = encoder.encode(texts)
                sizes = np.array([len(t.encode()) for t in texts], dtype=np.int64)
                if last is not None:
                    ids, begins, ends = (np.insert(a, at[1:], v) for a, v in ((ids, last), (begins, sizes), (ends, sizes)))
                    at = at + np.arange(len(at))
                if first is not None:
                    ids, begins, ends = (np.insert(a, at[:-1], v) for a, v in ((ids, first), (begins, 0), (ends, 0)))
                    at = at + np.arange(len(at))
                lists = [pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(a, pa.int32())) for a in (ids, begins, ends)]
                if decode:
                    back, whole_ids = _decoder(model).decode, ids.tolist()
                    lists.append(pa.array([back(whole_ids[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)], pa.string()))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(part.start, len(texts)), *lists], schema=out)

    shape = "doc_id bigint, ids array<int>, begins array<int>, ends array<int>" + ", decoded string" * decode
    return id_and_text(docs).mapInArrow(run, shape)


def decoded(found: DataFrame, model: bytes) -> DataFrame:
    """``doc_id``, ``ids`` and the ``decoded`` text of ids. A null list is an empty one; an unknown id is an error."""
    Model.read(model)
    out = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = _decoder(model).decode
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.slice(at, 500)
                column = part.column("ids")
                texts = [decode(column[i].values.to_numpy().tolist() if column[i].is_valid else []) for i in range(len(part))]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), column, pa.array(texts, pa.string())], schema=out)

    rows = found.select(F.col("doc_id").cast("bigint"), F.col("ids").cast("array<int>"))
    return rows.mapInArrow(run, "doc_id bigint, ids array<int>, decoded string")


def round_trips(docs: DataFrame, model: bytes) -> DataFrame:
    """Number and digest of the ids of each text, with an end id, and the digest of what they decode to."""
    found = encoded(docs, model, decode=True)
    return found.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
