"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

The vocabulary is read from an existing model file (a path parameter).  A text
is escaped as the library does for models with an identity normaliser (a
leading space, every space as U+2581) and cut into units: runs of U+2581 with
the letters or the other characters after them, and single characters that
occur in no longer piece.  That no piece reaches over such a cut is checked when
the file is read, so units merge independently and each distinct unit of a batch
is encoded once.

All distinct units of a batch lie in one flat symbol array.  A round looks up
every adjacent pair, takes the best (smallest) rank of each unit, merges the
leftmost non-overlapping occurrences of it in all units at once and compacts
the array; rounds end when no unit has a mergeable pair.  The library merges
one pair at a time, so a unit where a merge would create a pair that ranks
before the one being merged takes only its leftmost merge in that round.
Symbols that are no piece become the byte pieces of their UTF-8 bytes.

Decoding joins the bytes of the pieces, puts spaces back, drops the leading
space that encoding added and replaces bytes that are not UTF-8 by U+FFFD.

Defined cases: null and empty texts encode to the end id alone and decode to
the empty text; a null list of ids decodes to the empty text.  Rows keep their
order within a task, repeated rows give equal results, other columns stay.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map


SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
NONE = np.iinfo(np.int64).max
ROWS, CHARS = 256, 1_000_000    # texts encoded at once: bounds of a worker's arrays


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(field number, value) of a protobuf message (varint, 32/64-bit, bytes)."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        else:
            size = varint() if kind == 2 else 8 if kind == 1 else 4
            yield tag >> 3, data[at:at + size]
            at += size


class Pieces:
    """Pieces of a model file: text, score, kind and the settings that matter here."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            data = f.read()
        self.text: list[str] = []
        score, kind = [], []
        trainer, normalizer = {}, {}
        for number, value in _fields(data):
            if number == 1:
                piece = dict(_fields(value))
                self.text.append(piece.get(1, b"").decode("utf-8"))
                score.append(np.frombuffer(piece.get(2, bytes(4)), "<f4")[0])
                kind.append(piece.get(3, NORMAL))
            elif number == 2:
                trainer = {n: v for n, v in _fields(value)}
            elif number == 3:
                normalizer = {n: v for n, v in _fields(value)}
        if trainer.get(3, 1) != 2 or normalizer.get(2) or normalizer.get(4, 1):
            raise ValueError("only BPE models with an identity normaliser that keeps white space are handled")
        self.score, self.kind = np.array(score, np.float32), np.array(kind)
        self.prefix = bool(normalizer.get(3, 1))
        self.unk = int(np.flatnonzero(self.kind == UNKNOWN)[0])
        self.eos = self.text.index("</s>")
        self.byte = {int(t[3:5], 16): i for i, t in enumerate(self.text) if self.kind[i] == BYTE}

    def __len__(self) -> int:
        return len(self.text)


class PairTable:
    """Two-choice hash table from a pair of symbols to the piece they make."""

    FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)

    def __init__(self, pairs: dict[int, int]):
        self.shift = np.uint64(64 - max(4, (2 * len(pairs)).bit_length()))
        size = 1 << (64 - int(self.shift))
        keys, made = np.full((2, size), -1, np.int64), np.full((2, size), -1, np.int32)
        for key, value in pairs.items():
            side = 0
            for _ in range(1000):  # put it in; what it displaces goes to the other side
                at = (key * int(self.FACTORS[side]) % 2**64) >> int(self.shift)
                key, keys[side, at] = int(keys[side, at]), key
                value, made[side, at] = int(made[side, at]), value
                if key < 0:
                    break
                side = 1 - side
            else:
                raise ValueError("the pair table is too full")
        self.keys, self.made = keys, made

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that two symbols make, or -1."""
        key = left << 32 | right
        bits = key.view(np.uint64)
        a, b = (((bits * f) >> self.shift).astype(np.int64) for f in self.FACTORS)
        out = np.where(self.keys[0][a] == key, self.made[0][a], -1)
        other = np.flatnonzero(self.keys[1][b] == key)
        out[other] = self.made[1][b[other]]
        return out


class Merger:
    """Encoder and decoder over one vocabulary."""

    def __init__(self, path: str):
        p = self.pieces = Pieces(path)
        usable = np.isin(p.kind, (NORMAL, USER_DEFINED, UNUSED))
        if (p.kind == USER_DEFINED).any() or (p.kind == UNUSED).any():
            raise ValueError("user-defined and unused pieces are not handled")
        ids = {t: i for i, t in enumerate(p.text) if usable[i]}
        longer = [t for t in ids if len(t) > 1]
        # equal scores rank equal, as in the library's queue (then the leftmost goes first)
        self.rank = np.full(len(p) + 1, NONE, np.int64)  # the last is read for -1, no piece
        self.rank[:-1][usable] = np.unique(-p.score[usable], return_inverse=True)[1]
        # every way to join two symbols into a piece: a sorted key and the piece it makes
        known = set("".join(longer))
        self.chars = {c: n for n, c in enumerate(sorted(known | {t for t in ids if len(t) == 1}))}
        symbols = {**{c: len(p) + n for c, n in self.chars.items()}, **ids}  # a character that is no piece can still merge
        self.symbol = symbols
        pairs = {}
        for t in longer:
            for cut in range(1, len(t)):
                left, right = symbols.get(t[:cut]), symbols.get(t[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = ids[t]
        self.pairs = PairTable(pairs)
        self.unit = self._cuts(longer, known)
        self.base = len(p) + len(self.chars)  # symbols from here on are unknown characters
        self.bytes = [(b"" if p.kind[i] in (CONTROL, UNKNOWN) else bytes([int(t[3:5], 16)]) if p.kind[i] == BYTE
                       else t.replace(SPACE, " ").encode("utf-8")) for i, t in enumerate(p.text)]
        self.bytes[p.unk] = b" \xe2\x81\x87 "  # the library's surface of the unknown piece

    @staticmethod
    def _cuts(longer: list[str], known: set[str]) -> re.Pattern:
        """Pattern of a unit; every cut it makes lies where no piece reaches over."""
        alone = "".join(sorted(set("\n\t\r") - known))
        if any(SPACE in t.lstrip(SPACE) for t in longer):
            raise ValueError("a piece reaches over a space")
        letter = re.compile(r"[^\W\d_]")
        touching = {(a, b) for t in longer for a, b in zip(t, t[1:]) if a != SPACE}
        across = [(a, b) if letter.match(a) else (b, a) for a, b in touching if bool(letter.match(a)) != bool(letter.match(b))]
        odd = {a for a, _ in across}  # letters that pieces join to other characters count as such
        if any((a in odd or not letter.match(a)) != (b in odd or not letter.match(b)) for a, b in touching):
            return re.compile(f"{SPACE}*[^{SPACE}{alone}]+|[{alone}]|{SPACE}+")
        odd = re.escape("".join(sorted(odd)))
        return re.compile(f"{SPACE}*[^\\W\\d_{odd}]+|{SPACE}*(?:(?![{SPACE}{alone}])[\\W\\d_{odd}])+|[{alone}]|{SPACE}+")

    def merge(self, symbols: np.ndarray, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge rounds over flat ``symbols``; ``unit`` (ascending) says whose they are.
        Returns the final symbols and their units."""
        done_s, done_u = [], []
        made = np.full(len(symbols), -1, np.int64)  # piece that a symbol and the next one make
        same = np.flatnonzero(unit[1:] == unit[:-1])
        made[same] = self.pairs(symbols[same], symbols[same + 1])
        while len(symbols):
            rank = self.rank[made]
            starts = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1]])
            best = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.r_[starts, len(unit)])
            if (best == NONE).any():  # units without a pair are finished: compaction
                active = np.repeat(best < NONE, sizes)
                done_s.append(symbols[~active])
                done_u.append(unit[~active])
                symbols, unit, made, rank = symbols[active], unit[active], made[active], rank[active]
                if not len(symbols):
                    break
                sizes, best = sizes[best < NONE], best[best < NONE]
            limit = np.repeat(best, sizes)
            hit = self._leftmost(rank == limit)
            after, early = self._merged(symbols, unit, made, limit, hit)
            if len(early):  # only the leftmost merge in units where a merge makes an earlier pair
                careful = np.isin(unit, early)
                first = np.r_[True, unit[1:] != unit[:-1]]
                at = np.arange(len(hit))
                lead = np.minimum.reduceat(np.where(hit, at, len(hit)), np.flatnonzero(first))
                hit &= ~careful | (at == np.repeat(lead, sizes))
                after, _ = self._merged(symbols, unit, made, limit, hit)
            symbols, unit, made = after
        symbols, unit = np.concatenate([*done_s, symbols]), np.concatenate([*done_u, unit])
        order = np.argsort(unit, kind="stable")
        return symbols[order], unit[order]

    def _merged(self, symbols, unit, made, limit, hit):
        """The arrays after the hits are merged, and the units in which that made
        a pair which ranks no later than the one just merged."""
        keep = np.r_[True, ~hit[:-1]]
        fresh = hit[keep]
        symbols, unit, limit, made = np.where(hit, made, symbols)[keep], unit[keep], limit[keep], made[keep].copy()
        near = fresh | np.r_[fresh[1:], False]
        last = np.r_[unit[1:] != unit[:-1], True]
        made[near & last] = -1
        at = np.flatnonzero(near & ~last)
        made[at] = self.pairs(symbols[at], symbols[at + 1])
        return (symbols, unit, made), np.unique(unit[at[self.rank[made[at]] <= limit[at]]])

    @staticmethod
    def _leftmost(hit: np.ndarray) -> np.ndarray:
        """Of adjacent hits (overlapping pairs) keep the 1st, 3rd, 5th ... of a run."""
        if not (hit[1:] & hit[:-1]).any():
            return hit
        at = np.arange(len(hit))
        start = np.maximum.accumulate(np.where(hit & ~np.r_[False, hit[:-1]], at, -1))
        return hit & ((at - start) % 2 == 0)

    def encode_units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of the units and the offset of each (one more than units)."""
        text = "".join(units)
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        distinct, inverse = np.unique(codes, return_inverse=True)
        unknown: list[str] = []
        table = []
        for c in map(chr, distinct.tolist()):
            if c in self.symbol:
                table.append(self.symbol[c])
            else:
                table.append(self.base + len(unknown))
                unknown.append(c)
        symbols = np.array(table, np.int64)[inverse] if len(codes) else np.empty(0, np.int64)
        unit = np.repeat(np.arange(len(units)), np.fromiter(map(len, units), np.int64, len(units)))
        symbols, unit = self.merge(symbols, unit)
        odd = np.flatnonzero(symbols >= len(self.pieces))
        if len(odd):  # byte pieces stand in for characters that are no piece
            back = {n + len(self.pieces): c for c, n in self.chars.items()}
            back.update({self.base + n: c for n, c in enumerate(unknown)})
            runs = [[self.pieces.byte.get(b, self.pieces.unk) for b in back[s].encode("utf-8", "surrogatepass")]
                    for s in symbols[odd].tolist()]
            count = np.ones(len(symbols), np.int64)
            count[odd] = [len(r) for r in runs]
            out = np.repeat(symbols, count)
            out[np.repeat(symbols >= len(self.pieces), count)] = [b for r in runs for b in r]
            symbols, unit = out, np.repeat(unit, count)
        return symbols.astype(np.int32), np.searchsorted(unit, np.arange(len(units) + 1))

    def units(self, text: str) -> list[str]:
        if not text:
            return []
        return self.unit.findall((SPACE + text if self.pieces.prefix else text).replace(" ", SPACE))

    def decode(self, ids: np.ndarray) -> str:
        """Text of a list of ids."""
        control = self.pieces.kind[ids] == CONTROL if len(ids) else ids
        start, stop = 0, len(ids)
        while start < stop and control[start]:
            start += 1
        while stop > start and control[stop - 1]:
            stop -= 1
        if start == stop:
            return ""
        ids = ids[start:stop]
        raw = b"".join(map(self.bytes.__getitem__, ids.tolist()))
        try:
            if control[start:stop].any():
                raise UnicodeError  # bytes before and after a control piece are no character
            text = raw.decode("utf-8")
        except UnicodeError:
            text = self._decode_runs(ids)
        return text[1:] if self.pieces.prefix and self.pieces.text[ids[0]].startswith(SPACE) else text

    def _decode_runs(self, ids: np.ndarray) -> str:
        """Runs of byte pieces one by one; each byte that starts no character is U+FFFD."""
        out = []
        cuts = np.flatnonzero(np.diff(self.pieces.kind[ids])) + 1
        for part in np.split(ids, cuts):
            raw = b"".join(map(self.bytes.__getitem__, part.tolist()))
            while raw:
                try:
                    out.append(raw.decode("utf-8"))
                    raw = b""
                except UnicodeDecodeError as e:
                    out.append(raw[:e.start].decode("utf-8") + "\ufffd")
                    raw = raw[e.start + 1:]
        return "".join(out)


class BatchEncoder:
    """Encodes lists of texts; remembers the ids of units, within a bound."""

    def __init__(self, path: str, limit: int = 250_000):
        self.merger, self.limit = Merger(path), limit
        self._reset()

    def _reset(self):
        self.seen: dict[str, int] = {}
        self.flat, self.at = np.empty(0, np.int32), np.zeros(1, np.int64)

    def _learn(self, fresh: list[str]) -> None:
        flat, at = self.merger.encode_units(fresh)
        self.seen.update(zip(fresh, range(len(self.seen), len(self.seen) + len(fresh))))
        self.at = np.concatenate([self.at, at[1:] + len(self.flat)])
        self.flat = np.concatenate([self.flat, flat])

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Ids of each text with the end id, a group of texts at a time."""
        held, size = [], 0
        for text in texts:
            held.append(text)
            size += len(text)
            if size > CHARS:
                yield from self._group(held)
                held, size = [], 0
        yield from self._group(held)

    def _group(self, texts: list[str]) -> Iterator[np.ndarray]:
        if len(self.seen) > self.limit:
            self._reset()
        units = [self.merger.units(t) for t in texts]
        fresh = list(set(chain.from_iterable(units)).difference(self.seen))
        if fresh:
            self._learn(fresh)
        end = np.array([self.merger.pieces.eos], np.int32)
        length = np.diff(self.at)
        for us in units:
            which = np.fromiter(map(self.seen.__getitem__, us), np.int64, len(us))
            n = length[which]
            stop = np.cumsum(n)
            total = int(stop[-1]) if len(stop) else 0
            take = np.arange(total) + np.repeat(self.at[which] - (stop - n), n)
            yield np.concatenate([self.flat[take], end])


def encode(docs: DataFrame, model: str, text: str = "text", ids: str = "ids", decoded: str | None = None,
           keep: list[str] | None = None) -> DataFrame:
    """Adds ``ids`` (array of int, end id last) to every row; with ``decoded``
    also the text that these ids decode to, in the same pass.  ``keep`` lists the
    columns to return beside them (all)."""
    made = [ids, *([decoded] if decoded else [])]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in made]
    new = [F.lit(None).cast("array<int>").alias(ids), *([F.lit(None).cast("string").alias(decoded)] if decoded else [])]
    schema = docs.select(*keep, *new).schema

    def task(batches):
        encoder = BatchEncoder(model)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                out = list(encoder.encode([t or "" for t in part.column(text).to_pylist()]))
                at = np.cumsum([0, *map(len, out)]).astype(np.int32)
                columns = [pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(out), pa.int32()))]
                if decoded:
                    columns.append(pa.array([encoder.merger.decode(i) for i in out], pa.string()))
                yield pa.RecordBatch.from_arrays([part.column(n) for n in keep] + columns, keep + made)

    return arrow_map(docs.select(*dict.fromkeys([*keep, text])), task, schema)


def decode(rows: DataFrame, model: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Adds the text of a column of ids to every row."""
    schema = rows.drop(text).select("*", F.lit(None).cast("string").alias(text)).schema

    def task(batches):
        merger = Merger(model)
        for batch in batches:
            keep = [n for n in batch.schema.names if n != text]
            out = [merger.decode(np.asarray(x.values) if x.is_valid else np.empty(0, np.int32)) for x in batch.column(ids)]
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in keep] + [pa.array(out, pa.string())], keep + [text])

    return arrow_map(rows.drop(text), task, schema)
