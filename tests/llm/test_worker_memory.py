"""Python workers outlive a task: its worker function gives freed memory back."""

import hashlib

import pyarrow as pa
import pytest

from meterframe.llm import bpe, line_dedup, minhash, textops


@pytest.mark.parametrize(
    "run, batch",
    [
        (minhash._confirm(3, 85), {"a": [1], "b": [2], "text_a": ["a b c d"], "text_b": ["a b c d"]}),
        (minhash._shingle_rows(3), {"uid": [1], "root": [1], "text": ["a b c d"]}),
        (line_dedup._rebuild(["text"], 0), {"text": ["a\nb"], "kept": [[0]]}),
    ],
)
def test_memory_is_given_back_at_the_end_of_a_task(monkeypatch, run, batch):
    calls = []
    monkeypatch.setattr(textops, "release", lambda: calls.append(len(calls)))
    assert sum(b.num_rows for b in run(iter([pa.record_batch(batch)]))) > 0
    assert calls == [0]


def test_release_leaves_what_is_in_use():
    held = pa.array(range(1000))
    textops.release()
    assert held.to_pylist() == list(range(1000))


def test_kept_words_are_ids_only():
    """A worker keeps up to CACHE_WORDS words, so each is kept as its ids alone."""
    codec = bpe.Codec({"vocab": {"a": 1, "b": 2, "ab": 3}, "merges": [("a", "b")], "suffix": "", "special": {"<s>": 4}})
    n, _, decoded = codec.digests("ab<s>a")
    assert (n, decoded) == (3, hashlib.sha256(b"ab <s> a").hexdigest())
    assert codec.digests("")[0] == 0
    assert codec.cache == {"ab": b"\3\0\0\0", "a": b"\1\0\0\0"}
