"""What a worker remembers of the token ids between tasks, and what it forgets."""

import numpy as np
import public_tokenizers

from txnfeatures.llm import dac


def _texts(*texts):
    data = [t.encode() for t in texts]
    return np.frombuffer(b"".join(data), np.uint8), np.concatenate(([0], np.cumsum([len(d) for d in data])))


def test_a_worker_keeps_its_encoder_and_units_met_lately(monkeypatch):
    path = public_tokenizers.path("byte_bpe_50k.json")
    encode = dac.Encoder.kept(path)
    assert dac.Encoder.kept(path) is encode
    monkeypatch.setattr(dac, "CACHE", 3)
    encode = dac.Encoder(path)
    for turn in range(5):
        text = f"the same words come again word{turn} word{turn + 10}"
        ids, at = encode(*_texts(text, ""))
        assert ids.tolist() == encode.tokenizer.encode(text, add_special_tokens=False).ids
        assert at.tolist() == [0, len(ids), len(ids)]
        # Words of every turn stay; those met once only are forgotten after two generations.
        assert b" again" in encode.known and len(encode.known) + len(encode.older) <= 16
