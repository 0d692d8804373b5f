r"""Tokens of texts by way of their segments.

A segment is a maximal run of text that starts with a space which follows a character
other than white space (or with the text), and ends before the next such space. For a
vocabulary file with the properties that `separable` checks, no token crosses such a
place, and what stands before it does not change the tokens after it:

* .json: a byte-level pre-tokenizer cuts a text from left to right into pieces. Only
  its white-space pieces and the first character of others are white space, and it
  looks ahead only at the end of white space; so a piece ends before each such
  space, and what follows depends on the text from there on alone. Special
  strings hold no white space, so none crosses the place.
* .model: pieces are joined from neighbouring ones that are in the vocabulary. No
  piece holds a space after another character, so no join crosses the place.

So the tokens of a text are those of its segments, one after the other. Segments
repeat, as words do: each distinct one is encoded by the library once and remembered,
within a bounded memory. Other files are encoded as whole texts.
"""

from __future__ import annotations

import json
import os
import re
import sys
import types
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: White space, and characters that some engines or vocabulary files treat as such. Texts
#: that begin with one, or where one precedes a space, are cut with more care.
_WHITE = r"\x09-\x0D\x1C-\x1F" + "\x85\xa0\u1680\u180e\u200b\u2000-\u200a\u2028\u2029\u202f\u205f\u2581\u3000"
_ODD = f"[ {_WHITE}] |^[ {_WHITE}]"
_CUT = re.compile(f"(?<=[^ {_WHITE}]) ")
_ALONE = f"^$|[ {_WHITE}]$"
#: Segments and token ids remembered at most, beyond those of the texts at hand.
ENTRIES, IDS = 600_000, 6_000_000
#: Segments encoded as one text.
JOINED = 256


def tokenizer(path: str):
    """The library's encoder for a vocabulary file: tokenizers for .json, sentencepiece for .model."""
    if path.endswith(".model"):
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_file=path)
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation(), t.no_padding()
    return t


def encode(t, texts: list[str]) -> list[list[int]]:
    """Ids of whole texts without begin, end or added special tokens."""
    if hasattr(t, "encode_batch_fast"):
        return [x.ids for x in t.encode_batch_fast(texts, add_special_tokens=False)]
    return t.encode(texts, num_threads=1)


def separable(path: str, t) -> bool:
    """Whether the tokens of every text are those of its segments."""
    if path.endswith(".model"):
        return all("▁" not in t.id_to_piece(i).lstrip("▁") for i in range(t.get_piece_size()))
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre, model = spec.get("pre_tokenizer") or {}, spec.get("model") or {}
    plain = all(not (a["lstrip"] or a["rstrip"] or a["single_word"] or re.search(r"\s", a["content"]))
                for a in spec.get("added_tokens") or [])
    return (plain and spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
            and not pre.get("add_prefix_space") and model.get("type") == "BPE" and not model.get("dropout"))


def parts(texts: pa.Array) -> pa.ListArray:
    """The segments of each text, all but the first without the space they start with."""
    odd = pc.match_substring_regex(texts, _ODD)
    if not pc.any(odd).as_py():
        return pc.split_pattern(texts, " ")
    odd = odd.to_numpy(zero_copy_only=False)
    rare = pa.array([_CUT.split(t) for t in texts.filter(pa.array(odd)).to_pylist()], pa.list_(pa.string()))
    both = pa.concat_arrays([pc.split_pattern(texts.filter(pa.array(~odd)), " "), rare])
    return both.take(pa.array(np.argsort(np.argsort(odd, kind="stable"), kind="stable")))


class Flat:
    """Lists of numbers kept end to end in one array, appended to and gathered by their places."""

    def __init__(self, dtype):
        self.data, self.start = np.empty(1 << 16, dtype), np.zeros(1 << 12, np.int64)
        self.n = 0

    def __len__(self):
        return int(self.start[self.n])

    def extend(self, data: np.ndarray, size: np.ndarray) -> None:
        while len(self) + len(data) > len(self.data):
            self.data = np.concatenate((self.data, np.empty_like(self.data)))
        while self.n + len(size) + 1 > len(self.start):
            self.start = np.concatenate((self.start, np.zeros_like(self.start)))
        at = len(self)
        self.data[at:at + len(data)] = data
        self.start[self.n + 1:self.n + 1 + len(size)] = at + np.cumsum(size)
        self.n += len(size)

    def sizes(self, i: np.ndarray) -> np.ndarray:
        return self.start[i + 1] - self.start[i]

    def gather(self, i: np.ndarray) -> np.ndarray:
        """The lists at places `i`, one after the other."""
        size = self.sizes(i)
        end = np.cumsum(size)
        if not len(end) or not end[-1]:
            return np.empty(0, self.data.dtype)
        return self.data[np.repeat(self.start[i] - (end - size), size) + np.arange(end[-1])]


def flattened(lists: list, dtype) -> tuple[np.ndarray, np.ndarray]:
    """Lists end to end, and their sizes."""
    size = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), dtype, int(size.sum())), size


def token_bytes(path: str, t) -> list[bytes | None]:
    """What each id of a vocabulary file stands for, as bytes (None for an id without an entry).

    .json: byte-level entries decoded, an added token's own text; .model: the piece, U+2581
    as a space, <0xHH> as a byte.
    """
    if path.endswith(".model"):
        return [bytes([int(p[3:5], 16)]) if t.is_byte(i) else p.replace("▁", " ").encode()
                for i, p in enumerate(map(t.id_to_piece, range(t.get_piece_size())))]
    # the byte-level alphabet: printable bytes stand for themselves, the others for characters from 256 on
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(sorted(set(range(256)) - set(own)))}
    added = {i: a.content.encode() for i, a in t.get_added_tokens_decoder().items()}
    vocabulary = t.get_vocab(with_added_tokens=False)
    out: list = [None] * (max([*vocabulary.values(), *added]) + 1)
    for entry, i in vocabulary.items():
        out[i] = bytes(byte_of[c] for c in entry) if all(c in byte_of for c in entry) else None
    for i, content in added.items():
        out[i] = content
    return out


class SegmentEncoder:
    """Token ids of texts by a vocabulary file, its segments' ids remembered.

    With `spaced`, a space is put in front of each text (sentencepiece adds one by itself).
    With `plain`, special strings inside texts are ordinary text.
    """

    def __init__(self, path: str, spaced: bool = False, plain: bool = False):
        self.tokenizer, self.model = tokenizer(path), path.endswith(".model")
        if plain and not self.model:
            self.tokenizer.encode_special_tokens = True
        self.separable = separable(path, self.tokenizer)
        self.spaced = spaced and not self.model
        self.lead = "" if self.model else " "
        self.bytes = token_bytes(path, self.tokenizer) if self.separable else []
        self.n_bytes = np.array([-1 if b is None else len(b) for b in self.bytes], np.int64)
        self.reset()

    def reset(self) -> None:
        # places of segments (known by the text after their space) and of whole texts
        self.place, self.whole, self.ids = {}, {}, Flat(np.uint32)

    def _joined(self, keys: pa.Array):
        """Ids of segments that end in no white space, encoded many as one text: (ids, sizes, which failed).

        No token crosses from one segment to the next, so their bytes tell the tokens apart.
        """
        names, ends = keys.to_pylist(), 1 + pc.binary_length(keys).to_numpy(zero_copy_only=False).astype(np.int64)
        texts = [self.lead + " ".join(names[g:g + JOINED]) for g in range(0, len(names), JOINED)]
        data, size, failed = [], np.zeros(len(names), np.int64), np.zeros(len(names), bool)
        for k, ids in enumerate(encode(self.tokenizer, texts) if texts else ()):
            ids, g = np.array(ids, np.uint32), slice(k * JOINED, (k + 1) * JOINED)
            at, want = np.cumsum(self.n_bytes[ids]), np.cumsum(ends[g])
            cut = np.searchsorted(at, want) + 1
            if len(ids) and self.n_bytes[ids].min() > 0 and at[-1] == want[-1] and (at[cut - 1] == want).all():
                data.append(ids)
                size[g] = np.diff(cut, prepend=0)
            else:
                failed[g] = True
        return np.concatenate(data) if data else np.empty(0, np.uint32), size[~failed], failed

    def remember(self, keys: pa.Array, whole: bool) -> np.ndarray:
        """Encode segments (or `whole` texts) not met before; their places."""
        out, base = np.empty(len(keys), np.int64), self.ids.n
        alone = np.ones(len(keys), bool)
        if not whole:
            alone = pc.match_substring_regex(keys, _ALONE).to_numpy(zero_copy_only=False)
            some = np.flatnonzero(~alone)
            data, size, failed = self._joined(keys.take(pa.array(some)))
            alone = alone.copy()
            alone[some[failed]] = True
            self.added(keys.take(pa.array(some[~failed])), whole, data, size)
            out[some[~failed]] = base + np.arange(len(size))
        rest = np.flatnonzero(alone)
        if len(rest):
            texts = [k if whole else self.lead + k for k in keys.take(pa.array(rest)).to_pylist()]
            lists = encode(self.tokenizer, texts)
            if self.model and not whole:  # a lone space: the library adds none to an empty text
                lists = [x if t else [self.tokenizer.piece_to_id("▁")] for x, t in zip(lists, texts)]
            out[rest] = self.ids.n + np.arange(len(rest))
            self.added(keys.take(pa.array(rest)), whole, *flattened(lists, np.uint32))
        return out

    def added(self, keys: pa.Array, whole: bool, data: np.ndarray, size: np.ndarray) -> None:
        self.ids.extend(data, size)

    def _numbers(self, values: pa.Array, whole: bool) -> np.ndarray:
        d = values.dictionary_encode()
        keys, place = d.dictionary.to_pylist(), self.whole if whole else self.place
        of = np.fromiter((place.get(k, -1) for k in keys), np.int64, len(keys))
        new = np.flatnonzero(of < 0)
        if len(new):
            of[new] = self.remember(d.dictionary.take(pa.array(new)), whole)
            place.update(zip([keys[k] for k in new.tolist()], of[new].tolist()))
        return of[d.indices.to_numpy(zero_copy_only=False)] if len(keys) else np.empty(0, np.int64)

    def places(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Places in `ids` of the texts' segments, and where each text's begin (and the end).

        Texts are strings without nulls. An empty text has one empty segment.
        """
        if len(self.place) + len(self.whole) > ENTRIES or len(self.ids) > IDS:
            self.reset()
        texts = texts.cast(pa.string())
        if not self.separable:
            texts = pc.binary_join_element_wise("", texts, " ") if self.spaced else texts
            return self._numbers(texts, True), np.arange(len(texts) + 1)
        lists = parts(texts)
        values, at = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
        at = at - at[0]
        first = values.take(pa.array(at[:-1]))
        empty = pc.equal(first, "").to_numpy(zero_copy_only=False) & (np.diff(at) == 1)
        i = self._numbers(values, False)
        if self.spaced:
            i[at[:-1][empty]] = self._numbers(pa.array([""]), True)[0]
        elif len(first):
            i[at[:-1]] = self._numbers(first, True)
        return i, at

    def counts(self, texts: pa.Array) -> np.ndarray:
        """Number of tokens of each text."""
        i, at = self.places(texts)
        return np.diff(np.concatenate(([0], np.cumsum(self.ids.sizes(i))))[at])

    def encoded(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and where each text's begin (and the end)."""
        i, at = self.places(texts)
        return self.ids.gather(i), np.concatenate(([0], np.cumsum(self.ids.sizes(i))))[at]


def kept(key: tuple, make):
    """An encoder that a Python worker keeps from task to task, with what it remembers.

    The functions of this package travel by value, so its own globals live for one task only.
    """
    worker = sys.modules.setdefault("_kept_by_this_worker", types.ModuleType("_kept_by_this_worker")).__dict__
    if key not in worker:
        worker[key] = make()
    return worker[key]


def slices(column: pa.Array, most: int = 4_000_000):
    """Parts of a string column of about `most` bytes each, a longer text alone, nulls as empty texts."""
    column = column.cast(pa.string()).fill_null("")
    size = np.concatenate(([0], np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64))))
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(size, size[i] + most, side="right")) - 1)
        yield i, column.slice(i, j - i)
        i = j
