import itertools
import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import sentencepiece

from tillflow.llm import lattice_lm, piece_merge

from .helpers import corpus, frame

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()


def test_marginal_is_the_sum_over_all_segmentations():
    pieces = piece_merge.Pieces(MODEL)
    rng = np.random.default_rng(1)
    logs = np.log(rng.dirichlet(np.ones(len(pieces))))
    own = lattice_lm.Lattice(pieces, logs)
    ids = {t: i for i, t in enumerate(pieces.text) if pieces.kind[i] == 1}
    for word in ("the", "reading", "a", "naïve", "x日y", "\U0001F600"):
        text = "▁" + word
        total = 0.0
        for cuts in itertools.product((0, 1), repeat=len(text) - 1):
            at = [0, *[i + 1 for i, c in enumerate(cuts) if c], len(text)]
            p = 1.0
            for a, b in zip(at, at[1:]):
                part = text[a:b]
                if part in ids:
                    p *= math.exp(logs[ids[part]])
                elif len(part) == 1:
                    p *= math.exp(sum(logs[pieces.byte[x]] for x in part.encode()))
                else:
                    p = 0.0
            total += p
        assert math.isclose(own(word), math.log10(total), rel_tol=1e-9)


def test_scores_against_brute_force(spark):
    rows = [r for r in corpus() if r[0] is None or r[0] != 207]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    train = [r for r in rows if not held(r[0])]
    counts = Counter(w for r in train for w in low(r[1]))
    n, v = sum(counts.values()) + len(train), len(counts) + 1
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    pieces = piece_merge.Pieces(MODEL)
    used = np.zeros(len(pieces))
    for w, c in counts.items():
        for i in library.encode(w.decode()):
            used[i] += c
    used[2] = len(train)
    usable = np.array([k not in (2, 3) for k in pieces.kind])
    usable[2] = True
    logs = np.where(usable, np.log((used + 0.5) / (used[usable].sum() + 0.5 * usable.sum())), -np.inf)
    own = lattice_lm.Lattice(pieces, logs)
    want = {}
    for i, t, *_ in rows:
        ws = low(t)
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws) + math.log10((len(train) + 0.5) / (n + 0.5 * (v + 1)))
        score = sum(own(w.decode()) for w in ws) + logs[2] / math.log(10)
        want[i] = (held(i), len(ws) + 1, sum(counts[w] > 0 for w in ws) + 1, n, base, score)
    out = lattice_lm.scores(frame(spark, rows), MODEL, chunk_bytes=4000).collect()
    assert len(out) == len(rows)
    for r in out:
        w = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == w[:4]
        assert math.isclose(r.base_score, w[4], rel_tol=1e-9) and math.isclose(r.score, w[5], rel_tol=1e-9)


def test_no_training_documents(spark):
    ids = [i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1][:3]
    out = lattice_lm.scores(frame(spark, [(i, "some text", "en", "s", 9) for i in ids]), MODEL).collect()
    assert all((r.n_known, r.train_tokens, r.base_score) == (0, 0, 0.0) and r.score < 0 for r in out)


def test_empty(spark):
    assert lattice_lm.scores(frame(spark, []), MODEL).collect() == []


def test_equal_rows_spread_over_chunks(spark):
    rows = [(7, "the same words again", "en", "s", 20)] * 400 + [(1000 + i, f"other words {i} here", "en", "s", 20) for i in range(800)]
    docs = frame(spark, rows)
    sizes = [r["count"] for r in lattice_lm._chunked(docs, 3000).groupBy("chunk").count().collect()]
    assert len(sizes) > 8 and max(sizes) < 3 * len(rows) / len(sizes)
    out = lattice_lm.scores(docs, MODEL, chunk_bytes=3000).collect()
    assert len(out) == len(rows)
    assert max(r.score for r in out if r.doc_id == 7) - min(r.score for r in out if r.doc_id == 7) < 1e-9
