"""Alignment of the tokens of two tokenizers over the same texts, and how often their ids end together.

Tokenizer A (tokenizers library, byte level) reads a space and the text, tokenizer B (sentencepiece) reads the text and
adds the space itself. The library's character offsets for A and the spans of B's pieces (the installed sentencepiece gives
those of its former immutable proto as an offset mapping) are coarse cuts: a place where a token of each ends and the
next ones begin. Offsets do not divide characters, so between two coarse cuts the bytes
that the tokens decode to say where further tokens end together. A stretch with a single token on one side needs none.
Places where tokens of both end cut the tokens into groups, and link the two tokens that end there.

What a space begins is a unit: no token of either reaches from before a space into it, so distinct units are aligned once,
many in one call, and those that a worker meets again are looked up. Texts in which white space follows a space, ends the
text or begins it are aligned whole.

Counts of linked id pairs over the corpus come from sums per slice of rows, so the shuffle sees a distinct pair once per
slice. Pairs with at least a 65536th of all links, of which there are at most 65536, are handed to every task; all others
are joined, and none of them is frequent enough to make a hot key.

Null and empty texts, and texts that the tokens of A or B do not give back byte by byte, have no tokens: zeros and an
empty hash. Repeated rows and null ids are documents of their own and count each time. Texts of any length are taken
whole. Extra columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenorgrid.llm.common import keep, named
from tenorgrid.llm.pieces import MODEL, piece_model
from tenorgrid.llm.tokens import ODD, slices, tokenizer_path

SHIFT = 20  # bits of an id in a pair
SHARE = 1 << 16
KNOWN, MET, LONG, JOINED = 150_000, 1 << 22, 48, 512
_aligners: dict[tuple[str, str], "Aligner"] = {}
Aligned = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def aligner(a: str, b: str) -> "Aligner":
    if (a, b) not in _aligners:
        _aligners[a, b] = Aligner(a, b)
    return _aligners[a, b]


def byte_values() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: itself if printable, else the next from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def _common(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the values common to two increasing arrays stand in each."""
    at = np.minimum(np.searchsorted(y, x), max(len(y) - 1, 0))
    i = np.flatnonzero(y[at] == x) if len(y) else np.zeros(0, np.int64)
    return i, at[i]


def _both(x: np.ndarray, y: np.ndarray, most: int) -> np.ndarray:
    """The values of either array, in order; none is above ``most``."""
    has = np.zeros(most + 1, bool)
    has[x] = has[y] = True
    return np.flatnonzero(has)


class Aligner:
    def __init__(self, a: str, b: str):
        from tokenizers import Tokenizer, processors

        self.a, self.b = Tokenizer.from_file(a), piece_model(b)
        self.a.encode_special_tokens = True  # their names in a text are plain text
        self.a.post_processor = processors.ByteLevel(trim_offsets=False)
        value = byte_values()
        added = {i: t.content.encode() for i, t in self.a.get_added_tokens_decoder().items()}
        names = self.a.get_vocab()
        if max(max(names.values()), len(self.b.pieces)) >= 1 << SHIFT:
            raise ValueError(f"ids take at most {SHIFT} bits")
        self.a_bytes = [b""] * (max(names.values()) + 1)
        for token, i in names.items():
            self.a_bytes[i] = added.get(i) or bytes(value[c] for c in token)
        self.a_size, self.b_size = np.array([len(x) for x in self.a_bytes]), np.array([len(x) for x in self.b.pieces])
        # Written ids with what follows: of A inside a group and at its end, then of B.
        self.marked = np.array([f"{k}{c}" for x, c in ((self.a_bytes, ","), (self.a_bytes, "|"), (self.b.pieces, ","), (self.b.pieces, ";"))
                                for k in range(len(x))], object)
        self.marked_size = np.array([len(x) for x in self.marked])
        self.met = np.zeros(MET, bool)
        self._forget()

    def align(self, text: str) -> Aligned | None:
        """Ids of A and B, and the numbers of tokens of A and of B up to the end of each group; None if bytes differ."""
        whole = (" " + text).encode()
        got = self.a.encode(" " + text, add_special_tokens=False)
        spans = self.b.library.encode(text.encode(), return_type="offset_mapping")
        a, b = np.array(got.ids, np.int64), np.array(spans["ids"], np.int64)
        offsets = np.fromiter(itertools.chain.from_iterable(got.offsets), np.int64, 2 * len(a)).reshape(-1, 2)
        stop = np.fromiter(itertools.chain.from_iterable(spans["offsets"]), np.int64, 2 * len(b))[1::2] + 1  # behind the added space
        a_text, b_text = b"".join(map(self.a_bytes.__getitem__, a)), b"".join(map(self.b.pieces.__getitem__, b))
        if a_text != whole or b_text != whole:
            return None
        # Coarse cuts, in bytes: A's offsets are in characters, and tokens that share a character overlap.
        width = np.frombuffer((" " + text).encode("utf-32-le"), np.uint32)
        place = np.concatenate([[0], np.cumsum(1 + (width > 0x7F) + (width > 0x7FF) + (width > 0xFFFF))])
        a_clean = np.append(offsets[:-1, 1] <= offsets[1:, 0], True)
        b_clean = stop > np.concatenate([[0], np.maximum.accumulate(stop)[:-1]])
        a_at, b_at = np.flatnonzero(a_clean), np.flatnonzero(b_clean)
        i, j = _common(place[offsets[a_at, 1]], stop[b_at])
        a_cut, b_cut = a_at[i] + 1, b_at[j] + 1
        # Between two coarse cuts with several tokens on both sides, decoded bytes show the other common ends.
        a_end, b_end = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        right = a_end[a_cut - 1] == b_end[b_cut - 1]
        a_cut, b_cut = a_cut[right], b_cut[right]
        open_ = (np.diff(a_cut, prepend=0) > 1) & (np.diff(b_cut, prepend=0) > 1)
        a_in, b_in = (np.flatnonzero(np.repeat(open_, np.diff(c, prepend=0))) for c in (a_cut, b_cut))
        i, j = _common(a_end[a_in], b_end[b_in])
        return a, b, _both(a_cut, a_in[i] + 1, len(a)), _both(b_cut, b_in[j] + 1, len(b))

    def _written(self, found: Aligned) -> tuple[str, np.ndarray]:
        """The written groups, each with a semicolon behind it, and where each ends."""
        a, b, a_cut, b_cut = found
        n, m = len(self.a_bytes), len(self.b.pieces)
        of_a, of_b = (np.repeat(np.arange(len(c)), np.diff(c, prepend=0)) for c in (a_cut, b_cut))
        what = np.empty(len(a) + len(b), np.int64)
        last_a, last_b = (np.zeros(len(x), np.int64) for x in (a, b))
        last_a[a_cut - 1] = last_b[b_cut - 1] = 1
        what[np.arange(len(a)) + np.concatenate([[0], b_cut])[of_a]] = a + n * last_a
        at_b = np.arange(len(b)) + a_cut[of_b]
        what[at_b] = 2 * n + b + m * last_b
        return "".join(self.marked[what].tolist()), np.cumsum(self.marked_size[what])[at_b[b_cut - 1]]

    def _hash(self, found: Aligned) -> str:
        return hashlib.sha256(self._written(found)[0][:-1].encode()).hexdigest()

    def _links(self, found: Aligned) -> np.ndarray:
        """The pair of ids linked at each group's end."""
        a, b, a_cut, b_cut = found
        return (a[a_cut - 1] << SHIFT) | b[b_cut - 1]

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.texts: list[str | None] = []
        self.size = np.zeros((3, 0), np.int64)  # tokens of A, of B, groups
        self.pairs, self.start = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _units(self, new: list[str]) -> tuple[list[str | None], np.ndarray, np.ndarray]:
        """Written groups (None where bytes differ), sizes and all pairs of units."""
        texts: list[str | None] = []
        sizes, pairs = [np.zeros((3, 0), np.int64)], [np.zeros(0, np.int64)]
        todo = [new[k: k + JOINED] for k in range(0, len(new), JOINED)][::-1]
        while todo:
            part = todo.pop()
            found = self.align(" ".join(part))
            if found is None and len(part) > 1:  # a unit that does not come back: look for it in halves
                todo += [part[len(part) // 2:], part[: len(part) // 2]]
                continue
            if found is None:
                texts.append(None)
                sizes.append(np.zeros((3, 1), np.int64))
                continue
            a, b, a_cut, b_cut = found
            whole = np.frombuffer((" " + " ".join(part)).encode(), np.uint8)
            edge = np.append(np.flatnonzero(whole == 32)[1:], len(whole))
            last = np.searchsorted(np.cumsum(self.a_size[a])[a_cut - 1], edge)  # the group that ends with the unit
            written, stops = self._written(found)
            stops = stops[last].tolist()
            texts += [written[p: q - 1] for p, q in zip([0, *stops[:-1]], stops)]
            sizes.append(np.stack([np.diff(a_cut[last], prepend=0), np.diff(b_cut[last], prepend=0), np.diff(last + 1, prepend=0)]))
            pairs.append(self._links(found))
        return texts, np.concatenate(sizes, axis=1), np.concatenate(pairs)

    def _places(self, names: list[str]) -> tuple[list[str | None], np.ndarray, np.ndarray, np.ndarray]:
        """Of units: written groups, sizes, start in the pool of pairs, the pool; units met before stay known."""
        if len(self.known) > KNOWN:
            self._forget()
        index = np.fromiter(map(self.known.get, names, itertools.repeat(-1)), np.int64, len(names))
        where = np.flatnonzero(index < 0)
        spot = np.fromiter(map(hash, map(names.__getitem__, where.tolist())), np.int64, len(where)) & (MET - 1)
        stay = self.met[spot] & (np.fromiter(map(len, map(names.__getitem__, where.tolist())), np.int64, len(where)) <= LONG)
        self.met[spot] = True
        where = where[np.argsort(~stay, kind="stable")]  # those to keep come first
        order = list(map(names.__getitem__, where.tolist()))
        texts, size, pairs = self._units(order)
        start = np.cumsum(size[2]) - size[2] + len(self.pairs)
        pool, begins, sizes = np.concatenate([self.pairs, pairs]), np.concatenate([self.start, start]), np.concatenate([self.size, size], axis=1)
        n, kept = len(self.texts), int(stay.sum())
        everything = self.texts + texts
        if kept:
            m = n + kept
            self.known.update(zip(order[:kept], range(n, m)))
            self.texts, self.start, self.size = everything[:m], begins[:m], sizes[:, :m]
            self.pairs = pool[: begins[m - 1] + sizes[2, m - 1]]
        index[where] = n + np.arange(len(where))
        return [everything[k] for k in index.tolist()], sizes[:, index], begins[index], pool

    def documents(self, texts: pa.Array) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Per text: sizes (A, B, groups) and the hash of its groups; then all distinct (text, pair) with their number."""
        n = len(texts)
        texts = pc.binary_join_element_wise(pa.scalar(""), pc.fill_null(texts, ""), " ")
        odd = pc.match_substring_regex(texts, ODD).to_numpy(zero_copy_only=False)
        lists = pc.split_pattern(pc.if_else(pa.array(odd), "", texts), " ")
        # Every text but an odd one begins with its space: the first part is empty.
        at = lists.offsets.to_numpy().astype(np.int64)
        units = lists.values.slice(at[0], at[-1] - at[0]).dictionary_encode()
        at = at - at[0]
        code = units.indices.to_numpy()
        names = units.dictionary.to_pylist()
        use = [k for k, u in enumerate(names) if u]
        written, size, start, pool = self._places([names[k] for k in use])
        full = np.zeros((3, len(names) + 1), np.int64)
        full[:, use] = size
        begin = np.zeros(len(names) + 1, np.int64)
        begin[use] = start
        text_of = np.full(len(names), "", object)
        text_of[use] = written

        sizes, hashes, owner, found = np.zeros((3, n), np.int64), [""] * n, [], []
        # A text is good with at least one unit, all of which come back from both tokenizers.
        lost = np.concatenate([[0], np.cumsum(full[0, code] == 0)])
        good = ~odd & (at[1:] > at[:-1] + 1) & (lost[at[1:]] == lost[np.minimum(at[:-1] + 1, len(code))])
        parts, edges = text_of[code].tolist(), at.tolist()
        for k in np.flatnonzero(good).tolist():
            hashes[k] = hashlib.sha256(";".join(parts[edges[k] + 1: edges[k + 1]]).encode()).hexdigest()
        total = np.concatenate([np.zeros((3, 1), np.int64), np.cumsum(full[:, code], axis=1)], axis=1)
        sizes[:, good] = (total[:, at[1:]] - total[:, at[:-1]])[:, good]
        doc = np.repeat(np.arange(n), np.diff(at))
        mine = good[doc]
        c = code[mine]
        m = full[2, c]
        owner.append(np.repeat(doc[mine], m))
        found.append(pool[np.repeat(begin[c] - np.concatenate([[0], np.cumsum(m)[:-1]])[: len(c)], m) + np.arange(m.sum())])
        for k in np.flatnonzero(odd).tolist():
            text = texts[k].as_py()[1:]
            aligned = self.align(text) if text else None
            if aligned is not None:
                links = self._links(aligned)
                hashes[k] = self._hash(aligned)
                sizes[:, k] = len(aligned[0]), len(aligned[1]), len(links)
                owner.append(np.full(len(links), k))
                found.append(links)
        key, number = np.unique((np.concatenate(owner) << 2 * SHIFT) | np.concatenate(found), return_counts=True)
        return sizes, hashes, key >> 2 * SHIFT, key & ((1 << 2 * SHIFT) - 1), number


ROW = ("row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, pairs array<bigint>, "
       "numbers array<bigint>, slice_pairs array<bigint>, slice_numbers array<bigint>")
PART = ("row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
        "n_best bigint, count_sum bigint, pairs array<bigint>, numbers array<bigint>")


def _parted(edge: np.ndarray, values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(edge.astype(np.int32)), pa.array(values))


def _align(a: str, b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 2, 3 << 20):
                n = len(batch)
                sizes, hashes, owner, pairs, number = aligner(a, b).documents(batch.column(2))
                links = np.bincount(owner, weights=number, minlength=n).astype(np.int64)
                edge = np.searchsorted(owner, np.arange(n + 1))
                kinds, where = np.unique(pairs, return_inverse=True)
                sums = np.bincount(where, weights=number, minlength=len(kinds)).astype(np.int64)
                head = np.append(0, np.full(n, len(kinds)))  # the slice's sums stand on its first row
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), *map(pa.array, sizes), pa.array(links), pa.array(hashes, pa.string()),
                     _parted(edge, pairs), _parted(edge, number), _parted(head, kinds), _parted(head, sums)],
                    names=[c.split(" ")[0] for c in ROW.split(", ")])
    return run


def _add_frequent(pair: np.ndarray, count: np.ndarray, best: np.ndarray):
    """Sums over the frequent pairs (sorted); the other pairs of a row stay as lists."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = len(batch)
            lists = batch.column(7)
            edge = lists.offsets.to_numpy().astype(np.int64)
            mine = lists.values.to_numpy()[edge[0]: edge[-1]]
            number = batch.column(8).values.to_numpy()[edge[0]: edge[-1]]
            owner = np.repeat(np.arange(n), np.diff(edge))
            at = np.minimum(np.searchsorted(pair, mine), max(len(pair) - 1, 0))
            hit = pair[at] == mine if len(pair) else np.zeros(len(mine), bool)
            at = at[hit]
            sums = np.zeros(n, np.int64)
            np.add.at(sums, owner[hit], number[hit] * count[at])
            tops = np.zeros(n, np.int64)
            np.add.at(tops, owner[hit], number[hit] * best[at])
            rest = np.concatenate([[0], np.cumsum(np.bincount(owner[~hit], minlength=n))])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:7], pa.array(tops), pa.array(sums), _parted(rest, mine[~hit]), _parted(rest, number[~hit])],
                names=[c.split(" ")[0] for c in PART.split(", ")])
    return run


def aligned(docs: DataFrame, id: str = "doc_id", text: str = "text", a: str | None = None, b: str | None = None) -> tuple[DataFrame, DataFrame]:
    """``(documents, pairs)``: figures of every row; of every id pair linked anywhere a_id, b_id, count, and best, whether
    no other A id is linked more often with the B id.
    """
    a, b = a or tokenizer_path(), b or tokenizer_path(MODEL)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), named(id).cast("long").alias("doc_id"), named(text).alias("text"))
    found = keep(rows.mapInArrow(_align(a, b), ROW))
    each = (found.where(F.size("slice_pairs") > 0).select(F.explode(F.arrays_zip("slice_pairs", "slice_numbers")).alias("x"))
            .select(F.col("x.slice_pairs").alias("pair"), F.col("x.slice_numbers").alias("number")))
    counts = each.groupBy("pair").agg(F.sum("number").alias("count"))
    counts = keep(counts)
    b_of = F.col("pair").bitwiseAND((1 << SHIFT) - 1)
    most = counts.groupBy(b_of.alias("b_id")).agg(F.max("count").alias("most"))
    stats = keep(counts.withColumn("b_id", b_of).join(most, "b_id")
                 .select("pair", F.shiftright("pair", SHIFT).alias("a_id"), "b_id", "count", (F.col("count") == F.col("most")).alias("best")))
    total = stats.agg(F.sum("count")).first()[0] or 0
    # At most SHARE pairs can have a SHARE-th of all links each.
    top = stats.where(F.col("count") >= -(-total // SHARE)).select("pair", "count", "best").toPandas().sort_values("pair")
    part = keep(found.select(*[c.split(" ")[0] for c in ROW.split(", ")][:9]).mapInArrow(
        _add_frequent(top["pair"].to_numpy(np.int64), top["count"].to_numpy(np.int64), top["best"].to_numpy(np.int64)), PART))
    rare = (part.where(F.size("pairs") > 0).select("row", F.explode(F.arrays_zip("pairs", "numbers")).alias("x"))
            .select("row", F.col("x.pairs").alias("pair"), F.col("x.numbers").alias("number")))
    rare = (rare.join(stats.select("pair", "count", "best"), "pair").groupBy("row")
            .agg(F.sum(F.col("number") * F.col("count")).alias("more"), F.sum(F.when(F.col("best"), F.col("number")).otherwise(0)).alias("more_best")))
    documents = part.join(rare, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more", F.lit(0))).alias("count_sum"), "groups_sha256")
    return documents, stats.drop("pair")


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment figures of all documents under the two vocabularies."""
    return aligned(spark.read.parquet(f"{sf_dir}/documents.parquet"))[0]
