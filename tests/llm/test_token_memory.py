"""The tokeniser's memory: what was encoded is given back, and what is remembered changes no id."""

import random
import resource

import pytest

from clickwise.llm import rans, tokens


def test_encoded_texts_are_given_back():
    texts = [b"the cat sat on the mat " * 2000] * 64
    want = rans.id_bytes(texts, None, 2)
    assert len(want[0].as_py()) == 4 * (2000 * 6 + 1)
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    for _ in range(60):  # 3 MB each
        rans.id_bytes(texts, None, 2)
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 80_000  # KB


@pytest.mark.parametrize("bounds", [{}, {"SLOT_BITS": 2, "SEEN_BITS": 3, "GROUP_BYTES": 40}, {"CACHE_PIECES": 3, "GROUP_BYTES": 200}])
def test_ids_do_not_depend_on_what_is_remembered(monkeypatch, bounds):
    monkeypatch.setattr(tokens, "_loaded", {})
    for name, value in bounds.items():
        monkeypatch.setattr(tokens, name, value)
    rng = random.Random(5)
    some = ["the", "The", "cat.", "cat", "sat,", "a.b", "x", ".", ",.", "12.", "\u00e9t\u00e9.", "\u0130I", "e\u0301.", "\u00c9", "\x1ca", "<|", "zzqx,"]
    gaps = [" ", "  ", "\n", "\t\x0b", "\u00a0", "\u3000"]
    texts = [None, "", " ", "\n\n"] + ["".join(rng.choice(some) + rng.choice(gaps) for _ in range(rng.randrange(20))) for _ in range(300)]
    tok, _ = tokens._tokenizer(None)
    want = [tok.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]
    for _ in range(3):
        assert [x.tolist() for x in tokens.encode_texts(texts)] == want
    assert [x.tolist() for x in tokens.encode_texts(texts[:9], end_id=None)] == [w[:-1] for w in want[:9]]
    assert list(tokens.encode_texts([])) == []
