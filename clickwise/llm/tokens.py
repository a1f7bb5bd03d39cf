"""Token ids of whole texts by a public vocabulary file (the tokenizers library, no special tokens).

The vocabulary drops white space, so a text's ids are the ids of its pieces between ASCII white space, one
after another. Arrow splits a group of texts and finds its distinct pieces; those that came again before are remembered by each
Python worker in Arrow arrays (about 40 bytes a piece), the others are encoded once a group. The memory of a worker is bounded
by ``CACHE_PIECES``, ``SLOT_BITS``, ``SEEN_BITS`` and ``GROUP_BYTES``; none of them changes an id.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pieces that a worker remembers; the others are encoded again in each group of texts.
CACHE_PIECES = 500_000
#: Slots of the remembered pieces (four bytes each): 2**SLOT_BITS.
SLOT_BITS = 21
#: A piece is remembered when it is new for the second time: its hash is marked in a table of 2**SEEN_BITS bytes, emptied when a
#: third is marked. Most pieces of the long tail never come again.
SEEN_BITS = 22
#: Texts are taken together up to so many bytes (a longer text alone).
GROUP_BYTES = 1 << 21
END_ID = 2
_IDS = pa.list_(pa.uint32())

_loaded: dict[str, tuple] = {}


def vocabulary() -> str:
    """Path of the default vocabulary file, resolved where it is used."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Known:
    """Remembered pieces and the ids of each, found by their hash; a piece whose slot another has is not remembered."""

    def __init__(self):
        self.pieces, self.ids = pa.array([""]), pa.array([[]], _IDS)
        self.slots = np.zeros(1 << SLOT_BITS, np.int32)  # 0: free, or the empty piece's
        self.seen = np.zeros(1 << SEEN_BITS, bool)

    def find(self, pieces: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """The place of each piece, -1 if it is not known, and its hash."""
        h = np.fromiter(map(hash, pieces.to_numpy(zero_copy_only=False)), np.int64, len(pieces))
        at = self.slots[h & (len(self.slots) - 1)]
        same = pc.equal(self.pieces.take(pa.array(at)), pieces)
        return np.where(same.to_numpy(zero_copy_only=False), at, -1), h

    def remember(self, pieces: pa.StringArray, ids: pa.ListArray, h: np.ndarray) -> None:
        """Of these new pieces those whose hash was marked before, as far as there is room. All are marked."""
        slot, mark = h & (len(self.slots) - 1), h & (len(self.seen) - 1)
        again = self.seen[mark] & (self.slots[slot] == 0)
        again &= np.cumsum(again) <= CACHE_PIECES - len(self.pieces)
        if again.any():
            self.slots[slot[again]] = len(self.pieces) + np.arange(again.sum(), dtype=np.int32)
            again = pa.array(again)
            self.pieces = pa.concat_arrays([self.pieces, pieces.filter(again)])
            self.ids = pa.concat_arrays([self.ids, ids.filter(again)])
        self.seen[mark] = True
        if np.count_nonzero(self.seen) > len(self.seen) // 3:
            self.seen[:] = False


def _tokenizer(path: str | None):
    path = path or vocabulary()
    if path not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        _loaded[path] = (Tokenizer.from_file(path), Known())
    return _loaded[path]


def encode_texts(texts: list[str | bytes | None], path: str | None = None, end_id: int | None = END_ID) -> Iterator[np.ndarray]:
    """The uint32 ids of each text (null: empty; as a string or in UTF-8), followed by ``end_id``."""
    tok, known = _tokenizer(path)
    tail = np.array([] if end_id is None else [end_id], "<u4")
    some: list[bytes] = []
    size = 0
    for t in texts:
        raw = _lowered(t.encode() if isinstance(t, str) else t) if t else b""
        if some and size + len(raw) > GROUP_BYTES:
            yield from _group(tok, known, some, tail)
            some, size = [], 0
        some.append(raw)
        size += len(raw)
    if some:
        yield from _group(tok, known, some, tail)


def _group(tok, known: Known, texts: list[bytes], tail: np.ndarray) -> Iterator[np.ndarray]:
    """The ids of some texts."""
    words = pc.ascii_split_whitespace(pa.array(texts, pa.binary()).cast(pa.string()))
    coded = words.values.dictionary_encode()
    pieces, at = coded.dictionary, coded.indices.to_numpy()
    # a comma or full stop behind a letter is a piece of its own to the vocabulary's splitter
    stems = pc.replace_substring_regex(pieces, "([A-Za-z])[,.]$", r"\1")
    stop = pc.not_equal(stems, pieces)
    parts = pa.concat_arrays([stems, pc.utf8_slice_codeunits(pieces.filter(stop), -1)]).dictionary_encode()
    place, ids = _places(tok, known, parts.dictionary)
    place = place[parts.indices.to_numpy()]
    stop = stop.to_numpy(zero_copy_only=False)
    first, last = place[:len(pieces)], np.zeros(len(pieces), place.dtype)
    last[stop] = place[len(pieces):]
    cut = stop[at]
    row, ends = np.repeat(first[at], 1 + cut), np.cumsum(np.append(0, 1 + cut))
    row[ends[1:][cut] - 1] = last[at[cut]]
    found = ids.take(pa.array(row))
    values, offsets = found.values.to_numpy(), found.offsets.to_numpy()[ends[words.offsets.to_numpy()]]
    for start, end in pairwise(offsets):
        yield np.append(values[start:end], tail)


def _places(tok, known: Known, pieces: pa.StringArray) -> tuple[np.ndarray, pa.ListArray]:
    """The place of each piece in the lists of ids that are returned with them."""
    place, h = known.find(pieces)
    ids, new = known.ids, place < 0
    if new.any():
        fresh = pieces.filter(pa.array(new))
        fresh_ids = _encode_pieces(tok, fresh.cast(pa.binary()).to_numpy(zero_copy_only=False))
        place[new] = np.arange(len(ids), len(ids) + len(fresh))
        ids = pa.concat_arrays([ids, fresh_ids])
        known.remember(fresh, fresh_ids, h[new])
    return place, ids


def _lowered(raw: bytes) -> bytes:
    """The vocabulary lower-cases, so A-Z may be lowered before (fewer distinct pieces), except beside
    combining marks, which it composes first, and special tokens."""
    return raw if b"\xcc" in raw or b"<|" in raw else raw.lower()


def _encode_pieces(tok, pieces: np.ndarray) -> pa.ListArray:
    """Ids of each piece. Lower-case letters below U+0180 are their own normal form and one unit to the
    splitter, so the vocabulary's merge model takes them directly; all else goes the whole way."""
    out, rest, merge = [None] * len(pieces), [], tok.model.tokenize
    for i, p in enumerate(pieces):
        s = p.decode()
        if p.isalpha() and p.islower():
            units = s
        elif s.isalpha() and max(s) < "\u0180" and s.lower() == s:
            units = p.decode("latin-1").translate(_BYTE_CHARS)
        else:
            rest.append(i)
            continue
        out[i] = [t.id for t in merge(units)]
    for k in range(0, len(rest), 4096):
        part = rest[k:k + 4096]
        for i, e in zip(part, tok.encode_batch_fast([pieces[i].decode() for i in part], add_special_tokens=False)):
            out[i] = e.ids
    return pa.array(out, _IDS)


def _byte_chars() -> dict[int, int]:
    """The characters that stand for bytes in byte-level vocabularies: printable Latin-1 ones for themselves,
    the others, in order, from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: 256 + i for i, b in enumerate(hidden)}


_BYTE_CHARS = _byte_chars()
