"""Quality rules from compression: zstandard ratios in bands.

A text is compressed whole and in fixed chunks.  The ratio (compressed bytes /
bytes) of prose falls with length, so each length band has its own limits:
below the band it repeats itself, above it is incompressible (random strings,
encoded data).  Chunks find a part inside a text whose whole ratio looks normal;
a document goes when at least ``LOW_SHARE`` of its chunks are repetitive or at
least ``HIGH_SHARE`` of them incompressible, by the limits of their own
length.  That share is below a half, as the chunk in which an encoded half begins
holds prose too.

The lower limits lie 0.01 to 0.03 below the lowest ratios of prose (quality-1 documents of
over 24,000 labelled ones, by length; few are longer than 60,000 bytes, so limits fall further there), the upper limits 0.03 to 0.05 above the highest.  Hex digits compress as well as prose
does, so no ratio tells them apart: a chunk also counts as incompressible when
``HEX_SHARE`` of its word bytes stand in words of hex digits only (most in prose:
0.10), of them at least ``HEX_LETTERS`` letters, which tables of numbers lack.

Counted over the whole text beside it: words, their code points, symbol
characters, repeated lines and words in repeated 3-word windows.  Texts under 50
words, or with over half of their words in repeated windows, fail at once.

Defined cases: null counts as the empty text (no words, ratio 1, fails); rows
are judged one by one, so repeated rows get equal results; an empty table gives
an empty result; input columns named like a result column are replaced.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, hashes, mix64, small, texts_of, word_hasher

#: (texts of fewer bytes, least ratio, most ratio); the last band has no end.
BANDS = ((400, 0.50, 0.80), (500, 0.52, 0.78), (650, 0.51, 0.75), (800, 0.50, 0.72), (1100, 0.475, 0.69), (1600, 0.465, 0.65),
         (2200, 0.445, 0.61), (3200, 0.44, 0.59), (6400, 0.415, 0.55), (12800, 0.40, 0.52), (25600, 0.39, 0.49),
         (60_000, 0.38, 0.48), (120_000, 0.36, 0.48), (None, 0.30, 0.48))
CHUNK, LOW_SHARE, HIGH_SHARE = 1024, 0.5, 0.4
HEX, HEX_SHARE, HEX_LETTERS = re.compile(rb"[0-9a-fA-F]+"), 0.4, 0.1
LEVEL = 3
MIN_WORDS, MAX_REPEATED = 50, 50
SPACES, SYMBOLS = b" \t\n\v\f\r", b"#*$%&|<>"

RESULT = {"n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long", "n_repeat_words": "long",
          "base_failed": "boolean", "ratio": "double", "n_chunks": "long", "n_low_chunks": "long",
          "n_high_chunks": "long", "verdict": "string", "kept": "boolean"}


class Judge:
    """All figures and the verdict of one text; holds a worker's compressor and word table."""

    def __init__(self, bands=BANDS, chunk: int = CHUNK):
        self.bands, self.chunk = bands, chunk
        self.compressor = zstandard.ZstdCompressor(level=LEVEL)
        self.table = word_hasher(23)
        self.factors = (np.random.default_rng(9).integers(0, 2**63, 3, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)

    def ratio(self, data: bytes) -> float:
        return len(self.compressor.compress(data)) / len(data) if data else 1.0

    def repeated(self, words: list[bytes]) -> int:
        """Words inside 3-word windows that occur twice or more."""
        n = len(words) - 2
        if n < 2:
            return 0
        h = hashes(self.table, words)
        window = mix64(h[:n] * self.factors[0] + h[1:n + 1] * self.factors[1] + h[2:] * self.factors[2])
        order = np.argsort(window, kind="stable")
        same = window[order[1:]] == window[order[:-1]]
        again = np.zeros(n, bool)
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        covered = np.zeros(len(words), bool)
        for i in range(3):
            covered[i:n + i] |= again
        return int(covered.sum())

    def limits(self, size: int) -> tuple[float, float]:
        """Least and most ratio of a text of that many bytes."""
        return next((lo, hi) for end, lo, hi in self.bands if end is None or size < end)

    def chunks(self, data: bytes) -> list[bytes]:
        """The fixed chunks; a rest under half a chunk joins the one before."""
        starts = list(range(0, len(data), self.chunk)) or [0]
        if len(starts) > 1 and len(data) - starts[-1] < self.chunk // 2:
            starts.pop()
        return [data[a:b] for a, b in zip(starts, [*starts[1:], len(data)])]

    def hexadecimal(self, data: bytes) -> bool:
        """Whether a large share of the words' bytes are in words of hex digits."""
        words = data.split()
        own = b"".join(w for w in words if HEX.fullmatch(w))
        letters = len(own.translate(None, b"0123456789"))
        return bool(own) and len(own) >= HEX_SHARE * sum(map(len, words)) and letters >= HEX_LETTERS * len(own)

    def __call__(self, data: bytes) -> tuple:
        words = data.split()
        lines = [x for x in data.split(b"\n") if x.strip()]
        n, repeat = len(words), self.repeated(words)
        failed = n < MIN_WORDS or 100 * repeat > MAX_REPEATED * n
        whole, parts = self.ratio(data), self.chunks(data)
        ratios = [self.ratio(p) for p in parts]
        low = sum(r < self.limits(len(p))[0] for r, p in zip(ratios, parts))
        high = sum(r > self.limits(len(p))[1] or self.hexadecimal(p) for r, p in zip(ratios, parts))
        least, most = self.limits(len(data))
        verdict = ("base" if failed else "repetitive" if whole < least or low >= LOW_SHARE * len(parts)
                   else "incompressible" if whole > most or high >= HIGH_SHARE * len(parts) else "kept")
        return (n, len(data.translate(None, SPACES).decode("utf-8", "replace")), len(data) - len(data.translate(None, SYMBOLS)),
                len(lines) - len(set(lines)), repeat, failed, whole, len(parts), low, high, verdict, verdict == "kept")


def judged(docs: DataFrame, keep: list[str] | None = None, text: str = "text") -> DataFrame:
    """The columns ``keep`` (all) of every document and the result columns."""
    keep = [c for c in (docs.columns if keep is None else keep) if c not in RESULT]
    schema = docs.select(*keep, *[F.lit(None).cast(t).alias(c) for c, t in RESULT.items()]).schema
    rows = docs.select(*dict.fromkeys([*keep, text]))
    kinds = [{"long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string()}[t] for t in RESULT.values()]

    def task(batches):
        judge = Judge()
        for batch in small(batches):
            found = [judge(t) for t in texts_of(batch, text)]
            columns = [pa.array([f[i] for f in found], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + columns, [*keep, *RESULT])

    return arrow_map(rows, task, schema)
