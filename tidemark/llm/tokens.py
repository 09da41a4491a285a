"""Tokenizer ids of whole texts, quickly: a worker encodes each distinct piece between spaces once.

Both tokenizers cut a text before any rule joins characters, and never join across a space that a
non-space follows (byte-level: the space belongs to the next piece; word ends: spaces are dropped). So a
text's ids are the ids of its pieces in order. Texts for which that is not certain are encoded whole, and so are those that
hold the name of a special token, which gives that token's id, as the library has it by default.
"""

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tidemark.llm.common import hashed, texts_of

#: A space before more white space, in the widest sense: the byte-level rule joins such runs.
ODD = r"[ \x01][\x01\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{180E}\x{2000}-\x{200F}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]|\x01"
#: Pieces that a worker remembers, at most, and how many are encoded in one call.
REMEMBERED, JOINED = 500_000, 500
#: Bytes of text for one call of ``encode``: the more at once, the fewer distinct pieces.
SLICE = 2 << 20
#: Stands between pieces that are encoded in one call and drop their spaces.
MARK = "\x01"
#: Words that are letters before U+0180 and then marks: one or two parts for the word tokenizer, and lower case is all that its
#: normaliser makes of them.
SIMPLE = re.compile("[A-Za-zÀ-ÖØ-öø-įı-ſ]+([.,!?;:]*)")

_encoders: dict[tuple[str, bool], "Encoder"] = {}


def encoder(path: str, spaced: bool) -> "Encoder":
    """One per worker process. spaced: the space before a word is part of its token."""
    if (path, spaced) not in _encoders:
        _encoders[path, spaced] = Encoder(path, spaced)
    return _encoders[path, spaced]


class Memory:
    """An open hash table from pieces, known by two hashes, to the numbers of their encodings; whole arrays at a time."""

    def __init__(self, bits: int = 20):
        self.mask = np.uint64((1 << bits) - 1)
        self.keys, self.checks = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.uint64)
        self.slots = np.full(1 << bits, -1, np.int32)

    def find(self, keys: np.ndarray, checks: np.ndarray) -> np.ndarray:
        """The number of each piece, or -1."""
        out, left, at = np.full(len(keys), -1, np.int64), np.arange(len(keys)), (keys & self.mask).astype(np.int64)
        while len(left):
            there = at[left]
            slots = self.slots[there]
            same = (slots >= 0) & (self.keys[there] == keys[left]) & (self.checks[there] == checks[left])
            out[left[same]] = slots[same]
            left = left[(slots >= 0) & ~same]
            at[left] = (at[left] + 1) & int(self.mask)
        return out

    def add(self, keys: np.ndarray, checks: np.ndarray, slots: np.ndarray) -> None:
        left, at = np.arange(len(keys)), (keys & self.mask).astype(np.int64)
        while len(left):
            free = left[self.slots[at[left]] < 0]
            first = free[np.unique(at[free], return_index=True)[1]]
            self.keys[at[first]], self.checks[at[first]], self.slots[at[first]] = keys[first], checks[first], slots[first]
            done = np.zeros(len(keys), bool)
            done[first] = True
            left = left[~done[left]]
            at[left] = (at[left] + (self.slots[at[left]] >= 0)) & int(self.mask)


class Encoder:
    def __init__(self, path: str, spaced: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.spaced = spaced
        vocabulary = self.tokenizer.get_vocab()
        names = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = f"(?i:{'|'.join(names)})" if names else None
        # Ids that begin a piece (byte-level: those with a leading space), or that stand between two.
        self.edge = np.zeros(max(vocabulary.values()) + 1, bool)
        if spaced:
            self.edge[[i for token, i in vocabulary.items() if token.startswith("\u0120")]] = True
        else:
            mark = self._encode([MARK])[0]
            self.edge[mark[:1]] = len(mark) == 1
            self.ends = np.zeros(len(self.edge), bool)
            self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
            self.bare = Tokenizer.from_file(path)
            self.bare.normalizer = None
        self.memory = Memory()
        self.starts = np.zeros(1024, np.int64)
        self.sizes = np.zeros(1024, np.int32)
        self.ids = np.zeros(8192, np.uint16 if len(self.edge) <= 1 << 16 else np.uint32)
        self.n_slots = self.n_ids = 0

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _put(self, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        while self.n_slots + len(sizes) > len(self.starts):
            self.starts, self.sizes = np.resize(self.starts, 2 * len(self.starts)), np.resize(self.sizes, 2 * len(self.sizes))
        while self.n_ids + len(ids) > len(self.ids):
            self.ids = np.resize(self.ids, 2 * len(self.ids))
        slots = np.arange(self.n_slots, self.n_slots + len(sizes))
        self.sizes[slots] = sizes
        self.starts[slots] = self.n_ids + np.cumsum(sizes) - sizes
        self.ids[self.n_ids : self.n_ids + len(ids)] = ids
        self.n_slots += len(sizes)
        self.n_ids += len(ids)
        return slots

    def _put_each(self, texts: list[str]) -> np.ndarray:
        encoded = self._encode(texts)
        return self._put(np.array([i for x in encoded for i in x], np.uint32), np.array([len(x) for x in encoded], np.int64))

    def _put_joined(self, pieces: list[str]) -> np.ndarray:
        """Many pieces in one text; their ids fall apart again at the edges, or each piece is encoded alone."""
        out = []
        for at in range(0, len(pieces), JOINED):
            some = pieces[at : at + JOINED]
            ids = np.array(self._encode([("" if self.spaced else f" {MARK} ").join(some)])[0], np.uint32)
            edge = self.edge[ids]
            if self.spaced:
                sizes = np.diff(np.append(np.flatnonzero(edge), len(ids)))
                right = len(sizes) == len(some) and bool(edge[0])
            else:
                ends = np.append(np.flatnonzero(edge), len(ids))
                sizes = np.diff(ends, prepend=-1) - 1
                ids, right = ids[~edge], len(sizes) == len(some)
            out.append(self._put(ids, sizes) if right else self._put_each(some))
        return np.concatenate(out) if out else np.zeros(0, np.int64)

    def _put_simple(self, words: list[str], parts: list[int]) -> np.ndarray:
        """Simple words with their numbers of parts, many in one text, without the normaliser."""
        out = []
        for at in range(0, len(words), JOINED):
            some = words[at : at + JOINED]
            ids = np.array(self.bare.encode(" ".join(some).lower(), add_special_tokens=False).ids, np.uint32)
            ends, wanted = np.flatnonzero(self.ends[ids]) + 1, np.cumsum(parts[at : at + JOINED])
            right = len(ends) == wanted[-1] and ends[-1] == len(ids)
            out.append(self._put(ids, np.diff(ends[wanted - 1], prepend=0)) if right else self._put_each(some))
        return np.concatenate(out) if out else np.zeros(0, np.int64)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids (uint32) and the number of ids of each text. NULL counts as empty."""
        frozen = (self.n_slots, self.n_ids) if self.n_slots >= REMEMBERED else None
        texts = texts.cast(pa.string()).fill_null("")
        odd = pc.match_substring_regex(texts, self.special) if self.special else pa.repeat(False, len(texts))
        if self.spaced:
            odd = pc.or_(odd, pc.match_substring_regex(texts, ODD))
        pieces = pc.if_else(odd, "", texts)
        if self.spaced:
            pieces = pc.replace_substring(pieces, " ", "\x01 ")
        pieces = pc.split_pattern(pieces, "\x01" if self.spaced else " ")
        offsets = pieces.offsets.to_numpy() - pieces.offsets[0].as_py()
        coded = pieces.flatten().dictionary_encode()
        data, ends = texts_of(coded.dictionary)
        keys, checks = (hashed(data, ends[:-1], ends[1:], seed) for seed in (11, 12))
        slots = self.memory.find(keys, checks)
        new = np.flatnonzero(slots < 0)
        words = coded.dictionary.take(pa.array(new)).to_pylist()
        if self.spaced:
            apart = [k for k, w in enumerate(words) if w[:1] != " " or w[-1:].isspace()]
        else:
            apart = [k for k, w in enumerate(words) if not w or MARK in w]
        together = np.ones(len(new), bool)
        together[apart] = False
        if not self.spaced:
            simple = [k for k, w in enumerate(words) if w[-1:] < "\u0180" and SIMPLE.fullmatch(w)]
            slots[new[simple]] = self._put_simple([words[k] for k in simple], [1 + (words[k][-1] in ".,!?;:") for k in simple])
            together[simple] = False
        slots[new[together]] = self._put_joined([words[k] for k in np.flatnonzero(together).tolist()])
        slots[new[apart]] = self._put_each([words[k] for k in apart])
        if frozen is None:
            self.memory.add(keys[new], checks[new], slots[new])
        indices = coded.indices
        if pc.any(odd).as_py():
            whole = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
            slots = np.concatenate([slots, self._put_each(texts.take(pa.array(whole)).to_pylist())])
            indices = indices.to_numpy().copy()
            indices[offsets[whole]] = np.arange(len(keys), len(slots))
            indices = pa.array(indices)
        sizes = self.sizes[slots].astype(np.int64)
        ends = np.cumsum(sizes)
        take = np.repeat(self.starts[slots] - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)
        distinct = pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], ends])), pa.array(self.ids[take]))
        if frozen:
            self.n_slots, self.n_ids = frozen
        taken = distinct.take(indices)
        ends = taken.offsets.to_numpy()
        return taken.flatten().to_numpy().astype(np.uint32), np.diff(ends[offsets])


def forget() -> None:
    """Give up the encoders of this worker process, for tasks that need none."""
    _encoders.clear()


def with_end(ids: np.ndarray, counts: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Append one id to each text."""
    ends = np.cumsum(counts + 1)
    out = np.full(int(ends[-1]) if len(ends) else 0, end, np.uint32)
    keep = np.ones(len(out), bool)
    keep[ends - 1] = False
    out[keep] = ids
    return out, counts + 1
