"""What a Python worker holds at once is bounded."""

import pyarrow as pa

from ledgerloom.llm import common
from ledgerloom.llm.shingles import Shingler


def test_a_worker_holds_few_words_at_hand():
    """Most words of junk occur once: what a task keeps of them is bounded, and the shingles are the same."""
    words = [f"w{n}" for n in range(120_000)]
    shingler = Shingler()
    found = set(shingler.shingles(" ".join(words)))
    assert len(shingler.prints) <= 50_000 and len(found) == len(words) - 4
    assert {Shingler().shingles(" ".join(words[n : n + 5]))[0] for n in range(0, len(words) - 4, 1000)} <= found


def test_batches_are_worked_on_in_slices():
    batches = [pa.record_batch([pa.array(range(n, n + many), pa.int64())], names=["n"]) for n, many in ((0, 600), (600, 0), (600, 5))]
    parts = list(common.slices(iter(batches), 256))
    assert [part.num_rows for part in parts] == [256, 256, 88, 5]
    assert [n for part in parts for n in part.column(0).to_pylist()] == list(range(605))
