"""Memory of chunks of the packing operator."""
import numpy as np

from aidspark.llm import packing


def test_chunk_memory_keeps_common_chunks_when_full(monkeypatch):
    worked_out = []
    short = packing.ChunkIds._short
    monkeypatch.setattr(packing.ChunkIds, "_short", lambda self, text: worked_out.append(text) or short(self, text))
    memo = packing.ChunkIds(packing.tokenizer_path())
    memo.LIMIT = 10
    words = [w for i in range(200) for w in ("the", f"w{i}x", "(the)", f"café{i}", "don't")]
    got = packing.token_bytes(memo, [w.encode() for w in words])
    assert np.frombuffer(got, "<u4").tolist() == memo.tokenizer.encode(" ".join(words), add_special_tokens=False).ids
    assert worked_out.count("the") == worked_out.count("(the)") == worked_out.count("don't") == 1
