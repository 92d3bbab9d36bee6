from __future__ import annotations

import numpy as np
import pyarrow as pa

from assay.llm import kernels as K
from assay.llm import substring_dedup as S


def test_windows_are_told_apart_by_64_bits(monkeypatch):
    """Windows with one anchor whose hashes differ in the upper 32 bits only are no repeats; equal ones are."""
    real = K.ngrams
    monkeypatch.setattr(K, "ngrams", lambda h, n: (real(h, n) << K.U(32)) | K.U(7) if n == S.WINDOW else real(h, n))
    line = [f"hot{i}" for i in range(10)]
    texts = [" ".join(line + [f"d{d}w{i}" for i in range(20)]) for d in range(40)]
    settled = lambda t: S.settle(S.text_entries(*K.string_parts(pa.array(t)), np.arange(len(t)), np.zeros(len(t), np.uint32)))
    first, spans = settled(texts)
    assert len(spans) == 0
    assert len(S._load(S._dump(first))[1]) == len(first[1]) == 40 * 11
    assert settled(texts + texts[:1])[1].tolist() == [(40, 0, 0, 30)]
