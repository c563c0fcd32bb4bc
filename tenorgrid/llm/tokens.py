"""Token ids of whole texts, word by word: a distinct word of a batch is encoded once, and looked up if a worker has met
it before. Words that a worker meets for the second time are kept, up to a bound; most rare words never are.

Byte-level BPE with the usual split pattern never joins what stands before a single space to the word after it, so a
text is the concatenation of its first word and of " word" units. Texts in which a space has white space after it, or
ends the text, and texts with the string of an added token are encoded as they are.
"""

from __future__ import annotations

import itertools
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

END = 0
KNOWN, MET, LONG, JOINED = 500_000, 1 << 23, 64, 512
# A space before white space of any kind (a superset of what the pattern takes as such) or at the end of the text.
ODD = " ([\\s\x0b\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]|$)"
_coders: dict[str, "WordCoder"] = {}


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def coder(path: str) -> "WordCoder":
    """The worker's coder of a vocabulary file, which lies at the same place on every machine."""
    if path not in _coders:
        _coders[path] = WordCoder(path)
    return _coders[path]


class WordCoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.bytes_of = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.bytes_of[i] = len(token)  # a character of a token's name stands for one byte
        # Texts with the string of an added token are encoded whole, as the library takes the string for the token.
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.odd = "|".join([ODD, *added])
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.met = np.zeros(MET, bool)
        self.pool, self.start, self.size = np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.int32)

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype=np.int32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _units(self, new: list[str], width: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units of ``width`` bytes, encoded many in one string, and where they end: a unit's ids are those that
        cover its bytes.
        """
        if not new:
            return np.zeros(0, np.int32), np.zeros(0, np.int32)
        parts = self._whole([" " + " ".join(new[k: k + JOINED]) for k in range(0, len(new), JOINED)])
        ids = np.concatenate(parts)
        return ids, (np.searchsorted(np.cumsum(self.bytes_of[ids]), np.cumsum(width + 1)) + 1).astype(np.int32)

    def _places(self, names: list[str], width: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pool of ids, and start and size in it of each name; names met before stay known."""
        if len(self.known) > KNOWN:
            self._forget()
        index = np.fromiter(map(self.known.get, names, itertools.repeat(-1)), np.int64, len(names))
        where = np.flatnonzero(index < 0)
        spot = np.fromiter(map(hash, map(names.__getitem__, where.tolist())), np.int64, len(where)) & (len(self.met) - 1)
        stay = self.met[spot] & (width[where] <= LONG)
        self.met[spot] = True
        where = where[np.argsort(~stay, kind="stable")]  # those to keep come first
        order = list(map(names.__getitem__, where.tolist()))
        ids, stop = self._units(order, width[where])
        first = np.concatenate([np.zeros(1, np.int32), stop[:-1]]) if len(stop) else stop
        pool = np.concatenate([self.pool, ids])
        start, size = np.concatenate([self.start, first + len(self.pool)]), np.concatenate([self.size, stop - first])
        n, kept = len(self.known), int(stay.sum())
        index[where] = n + np.arange(len(where))
        if kept:
            self.known.update(zip(order[:kept], range(n, n + kept)))
            self.pool, self.start, self.size = pool[: start[n + kept - 1] + size[n + kept - 1]], start[: n + kept], size[: n + kept]
        return pool, start[index], size[index]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each followed by the end id, and the places where texts begin and the last ends."""
        texts = pc.fill_null(texts, "")
        n = len(texts)
        odd = np.flatnonzero(pc.match_substring_regex(texts, self.odd).to_numpy(zero_copy_only=False))
        plain = pc.if_else(pa.array(np.isin(np.arange(n), odd)), "", texts) if len(odd) else texts
        lists = pc.split_pattern(plain, " ")
        at = lists.offsets.to_numpy().astype(np.int64)
        units = lists.values.slice(at[0], at[-1] - at[0]).dictionary_encode()
        at = at - at[0]
        code = units.indices.to_numpy()
        tail = np.ones(len(code), bool)
        tail[at[:-1]] = False
        wanted = np.zeros(len(units.dictionary), bool)
        wanted[code[tail]] = True
        names = units.dictionary.filter(pa.array(wanted))
        # Units hold no space, so one joined string gives them back as Python strings.
        one = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), names), " ")[0].as_py()
        pool, start_of, size_of = self._places(one.split(" ") if len(names) else [], pc.binary_length(names).to_numpy().astype(np.int64))
        heads = [t.split(" ", 1)[0] for t in plain.to_pylist()]

        # Pool of this call: the units', then the first words' (whole texts for odd ones), then the end id.
        whole = dict(zip(odd.tolist(), self._whole(texts.take(pa.array(odd)).to_pylist()))) if len(odd) else {}
        first = [whole.get(k, h) for k, h in enumerate(self._whole(heads))]
        sizes = np.array([len(x) for x in first], np.int32)
        begins = len(pool) + np.concatenate([[0], np.cumsum(sizes)])
        pool = np.concatenate([pool, *first, np.array([END], np.int32)])
        start_all, size_all = np.zeros(len(wanted), np.int32), np.zeros(len(wanted), np.int32)
        start_all[wanted], size_all[wanted] = start_of, size_of
        start, size = np.empty(len(code) + n, np.int32), np.empty(len(code) + n, np.int32)
        body = np.ones(len(start), bool)
        last = at[1:] + np.arange(n)
        body[last] = False
        start[body], size[body] = start_all[code], size_all[code]
        start[at[:-1] + np.arange(n)], size[at[:-1] + np.arange(n)] = begins[:-1], sizes
        start[last], size[last] = len(pool) - 1, 1
        edge = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
        if edge[-1] < 1 << 30:
            shift = start - edge[:-1].astype(np.int32)
            ids = pool[np.repeat(shift, size) + np.arange(edge[-1], dtype=np.int32)]
        else:
            ids = pool[np.repeat(start - edge[:-1], size) + np.arange(edge[-1])]
        return ids, edge[np.concatenate([[0], last + 1])]


def slices(batch: pa.RecordBatch, column: int, limit: int = 6 << 20):
    """Parts of a batch with about ``limit`` bytes of text each."""
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    total, row = np.concatenate([[0], np.cumsum(size, dtype=np.int64)]), 0
    while row < len(batch):
        stop = max(row + 1, int(np.searchsorted(total, total[row] + limit, "right")) - 1)
        yield batch.slice(row, stop - row)
        row = stop
