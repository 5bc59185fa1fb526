from __future__ import annotations

import numpy as np
import plain
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from pairloom.llm.words import Runs, chunks, joined, split, utf8, word_hashes

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab é\t\n\x0b\x1c\x85 中", max_size=30)), min_size=1, max_size=6)


@settings(max_examples=80, deadline=None)
@given(TEXTS)
def test_words_and_hashes(texts):
    words = split(*utf8(pa.array(texts, pa.string())))
    got = [words.data[a:b].tobytes().decode() for a, b in zip(words.starts, words.ends)]
    want = [plain.WORD.findall(t or "") for t in texts]
    assert got == [w for ws in want for w in ws]
    assert np.diff(words.first).tolist() == [len(ws) for ws in want]
    hashes = word_hashes(words)
    assert len(set(hashes.tolist())) == len(set(got))
    own = joined(words)
    assert [own.data[a:b].tobytes().decode() for a, b in zip(own.starts, own.ends)] == got


def test_runs_are_equal_wherever_they_are():
    values = np.array([5, 6, 7, 1, 5, 6, 7, 2], dtype=np.uint64)
    runs = Runs(values, 0xC2B2AE3D27D4EB4F)
    a = runs.hashes(np.array([0, 4, 1]), np.array([3, 7, 4]))
    assert a[0] == a[1] != a[2]


def test_slices_and_chunks():
    batch = pa.record_batch([pa.array(["x" * 600_000, None, "y" * 600_000, "z z", ""])], names=["text"])
    parts = list(chunks(iter([batch.slice(1), batch])))
    assert sum(p.num_rows for p in parts) == 9 and max(p.num_rows for p in parts) < 5
    words = split(*utf8(parts[-1].column("text")))
    assert len(words) >= 2
