"""SentencePiece encoding that keeps offsets, and decoding.

A text is normalised here, not in the library: at every place the longest key of the model's compiled character map
that the text continues with is replaced by its value, other characters stay. Every byte of the normalised text
records the bytes of the source that it stands for. White space is treated as the model says (dummy prefix, removal of
repeated spaces, U+2581 for a space), keeping the record. The library then segments the normalised text under a copy of
the model that normalises nothing more, and the bytes of every piece are projected to a byte span of the source text.

A piece's span is ``[start, end)`` in the UTF-8 bytes of the text. Bytes that the character map left alone stand for
themselves, so byte pieces of one character have one byte each; what the map changed stands for its whole key. The dummy
prefix has an empty span. Removed white space belongs to the piece that holds the space that was kept before it.

Null text is an empty text, which has no pieces. Texts of any length are encoded whole. Rows keep their key columns,
repeated rows and null keys included; other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenorgrid.llm.common import named
from tenorgrid.llm.tokens import slices, tokenizer_path

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
BYTE, USER = 6, 4  # types of pieces in a model file
_models: dict[str, "PieceModel"] = {}


def piece_model(path: str) -> "PieceModel":
    """The worker's model of a file, which lies at the same place on every machine."""
    if path not in _models:
        with open(path, "rb") as f:
            _models[path] = PieceModel(f.read())
    return _models[path]


def character_map(compiled: bytes) -> dict[str, str]:
    """Keys and values of a compiled character map.

    The map is the size of a double-array trie, the trie in 32-bit units, and the values, each ended by a zero byte. A
    unit holds its label in bits 0-7 and 31, in bit 8 whether a value follows, in bits 10-30 the offset of its children
    (256 times as far with bit 9). A value's unit has its place among the values.
    """
    if not compiled:
        return {}
    size = int.from_bytes(compiled[:4], "little")
    units = np.frombuffer(compiled, "<u4", size // 4, 4).astype(np.int64)
    values = compiled[4 + size:]

    def below(unit: np.ndarray) -> np.ndarray:
        return (unit >> 10) << ((unit >> 6) & 8)

    found: dict[str, str] = {}
    node, name = below(units[:1]), [b""]
    labels = np.arange(1, 256)
    while len(node):
        child = node[:, None] ^ labels
        unit = units[np.minimum(child, len(units) - 1)]
        row, col = np.nonzero((child < len(units)) & (unit & ((1 << 31) | 255) == labels))
        unit, label = unit[row, col], labels[col]
        name = [name[r] + bytes([b]) for r, b in zip(row.tolist(), label.tolist())]
        node = child[row, col] ^ below(unit)
        for k in np.flatnonzero((unit >> 8) & 1).tolist():
            at = int(units[node[k]]) & ((1 << 31) - 1)
            found[name[k].decode()] = values[at: values.index(b"\0", at)].decode()
    return found


class PieceModel:
    def __init__(self, proto: bytes):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto.FromString(proto)
        self.library = SentencePieceProcessor(model_proto=proto)
        self.prefix, self.suffix = model.normalizer_spec.add_dummy_prefix, model.trainer_spec.treat_whitespace_as_suffix
        self.single, self.escape = model.normalizer_spec.remove_extra_whitespaces, model.normalizer_spec.escape_whitespaces
        self.map = character_map(model.normalizer_spec.precompiled_charsmap)
        self.fixed = {p.piece for p in model.pieces if p.type == USER}
        self.size = np.array([1 if p.type == BYTE else len(p.piece.encode()) for p in model.pieces], np.int64)
        self.unknown = self.library.unk_id()
        self.names = [str(k) for k in range(len(model.pieces))]
        self.pieces = [bytes([int(p.piece[3:5], 16)]) if p.type == BYTE else p.piece.replace(SPACE, " ").encode() for p in model.pieces]
        # No piece goes on after a space that follows something else: what a space begins can be encoded on its own.
        self.by_words = not self.fixed and not any(SPACE in p.piece.lstrip(SPACE) for p in model.pieces if p.type != BYTE)
        self.plain = not self.map and not self.single and self.prefix and not self.suffix and self.escape
        self._changes()

        spec = model.normalizer_spec
        spec.name, spec.precompiled_charsmap, spec.normalization_rule_tsv = "identity", b"", ""
        spec.add_dummy_prefix = spec.remove_extra_whitespaces = False
        self.core = SentencePieceProcessor(model_proto=model.SerializeToString())

    def _changes(self) -> None:
        """A pattern that finds every place where a key may begin, and the lengths of keys by their first character."""
        keys = self.fixed | self.map.keys()
        lengths: dict[str, set[int]] = {}
        for key in keys:
            lengths.setdefault(key[0], set()).add(len(key))
        self.lengths = {c: sorted(n, reverse=True) for c, n in lengths.items()}
        one, first, second = ({k[0] for k in keys if len(k) == 1}, {k[0] for k in keys if len(k) > 1},
                              {k[1] for k in keys if len(k) > 1})

        def one_of(chars: set[str]) -> str:
            return "[" + "".join(map(re.escape, sorted(chars))) + "]"

        parts = [one_of(one)] if one else []
        if first:
            parts.append(f"{one_of(first)}(?={one_of(second)})")
        self.change = re.compile("|".join(parts)) if parts else None

    def _mapped(self, text: str) -> Iterator[tuple[str, str | None]]:
        """Stretches ``(source, value)`` of a text; value is None where the source stays as it is."""
        at = 0
        for m in self.change.finditer(text) if self.change else ():
            start = m.start()
            if start < at:
                continue
            tries = [text[start: start + n] for n in self.lengths[text[start]]]
            key = next((k for k in tries if k in self.fixed), None) or next((k for k in tries if k in self.map), None)
            if key is None or key in self.fixed:
                if key:
                    yield text[at: start + len(key)], None
                    at = start + len(key)
                continue
            if start > at:
                yield text[at:start], None
            yield key, self.map[key]
            at = start + len(key)
        if at < len(text):
            yield text[at:], None

    def normalise(self, text: str) -> tuple[str, np.ndarray, np.ndarray]:
        """The normalised text; for each of its bytes where its source starts and ends, with the end of all as last start."""
        if not text:
            return "", np.zeros(1, np.int64), np.zeros(0, np.int64)
        data, starts, ends, at = [], [], [], 0
        lead = None if self.single else 0  # where the dummy prefix stands: behind the spaces that a text begins with
        for source, value in self._mapped(text):
            if lead is None and value != " " and (value is not None or source.strip(" ")):
                lead = at + (len(source) - len(source.lstrip(" ")) if value is None else 0)
            size = len(source.encode())
            new = (source if value is None else value).encode()
            if value is None:
                own = np.arange(at, at + size)
                starts.append(own)
                ends.append(own + 1)
            else:
                starts.append(np.full(len(new), at))
                ends.append(np.full(len(new), at + size))
            data.append(new)
            at += size
        raw = np.frombuffer(b"".join(data), np.uint8)
        start, end = np.concatenate(starts), np.concatenate(ends)
        space = raw == 32
        first = np.diff(start, prepend=-1) != 0
        if self.single:  # a space that begins its stretch goes if a space, or nothing, stands before the stretch
            begin = np.maximum.accumulate(np.where(first, np.arange(len(raw)), 0))
            solid = np.concatenate([[0], np.cumsum(~space)])
            leading = solid[begin] == solid[1:]
            after = (begin == 0) | (space[begin - 1] if len(raw) else False)
            stay = ~(space & leading & after)
            if lead is None:
                return "", np.zeros(1, np.int64), np.zeros(0, np.int64)
            raw, space, start, end = raw[stay], space[stay], start[stay], end[stay]
        wide = np.where(space, 3, 1) if self.escape else np.ones(len(raw), np.int64)
        start, end = np.append(np.repeat(start, wide), at), np.repeat(end, wide)
        mark = SPACE if self.escape else " "
        normal = raw.tobytes().decode()
        normal = normal.replace(" ", mark)
        edge = len(mark.encode())
        if self.prefix and not self.suffix:
            normal, start, end = mark + normal, np.concatenate([np.full(edge, lead), start]), np.concatenate([np.full(edge, lead), end])
        if self.single:
            short = normal.rstrip(mark)
            cut = len(short.encode())
            normal, start, end = short, start[: cut + 1], end[:cut]
        if self.prefix and self.suffix:
            normal, end = normal + mark, np.concatenate([end, np.full(edge, start[-1])])
            start = np.concatenate([start, np.full(edge, start[-1])])
        return normal, start, end

    def _edges(self, normal: str, ids: np.ndarray) -> np.ndarray:
        """Where the pieces of a normalised text end in it."""
        size = self.size[ids]
        if self.unknown in ids:  # as long as the text it stands for
            spans = self.core.encode(normal.encode(), return_type="offset_mapping")["offsets"]
            size = np.where(ids == self.unknown, [b - a for a, b in spans], size)
        edge = np.cumsum(size)
        if len(edge) and edge[-1] != len(normal.encode()):
            raise RuntimeError("pieces do not cover the normalised text")
        return edge

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Ids, starts and ends of the pieces of each text."""
        normal = [self.normalise(t) for t in texts]
        out = []
        for (text, start, end), ids in zip(normal, self.core.encode([n[0] for n in normal], num_threads=1, return_type="numpy")):
            if not len(ids):
                out.append((ids, np.zeros(0, np.int32), np.zeros(0, np.int32)))
                continue
            edge = self._edges(text, ids)
            begin = np.concatenate([[0], edge[:-1]])
            stop = np.where(start[edge] > start[edge - 1], start[edge], end[edge - 1])
            out.append((ids, start[begin].astype(np.int32), stop.astype(np.int32)))
        return out


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    edge = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(edge), pa.array(np.concatenate([np.zeros(0, np.int32), *parts]).astype(np.int32)))


def _places(rows: DataFrame) -> list[str]:
    """Inner names of the columns, by place, so that any name is allowed outside."""
    return [f"_{k}" for k in range(len(rows.columns))]


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 0, 4 << 20):
                found = piece_model(path).encode(pc.fill_null(batch.column(0), "").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[1:], *(_lists([f[k] for f in found]) for k in range(3))],
                    names=[*batch.schema.names[1:], "ids", "starts", "ends"])
    return run


def encode_pieces(docs: DataFrame, keys: list[str], text: str = "text", model: str | None = None) -> DataFrame:
    """Key columns, and the ``ids``, ``starts`` and ``ends`` of the pieces of each row's text, without begin or end ids."""
    clash = {"ids", "starts", "ends"} & set(keys)
    if clash:
        raise ValueError(f"rename the key columns {sorted(clash)}")
    rows = docs.select(named(text).alias("_0"), *map(named, keys))
    schema = T.StructType([*rows.schema[1:], *(T.StructField(n, T.ArrayType(T.IntegerType())) for n in ("ids", "starts", "ends"))])
    return rows.toDF(*_places(rows)).mapInArrow(_encode(model or tokenizer_path(MODEL)), schema)


def _rows(lists: pa.ListArray) -> list[list[int]]:
    edge, values = lists.offsets.to_numpy(), lists.values.to_numpy()
    return [values[a:b].tolist() for a, b in zip(edge[:-1], edge[1:])]


def _decode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = piece_model(path).library.decode(_rows(batch.column(0)), num_threads=1) if len(batch) else []
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(texts, pa.string())], names=[*batch.schema.names[1:], "decoded"])
    return run


def decode_pieces(rows: DataFrame, keys: list[str], ids: str = "ids", model: str | None = None) -> DataFrame:
    """Key columns and ``decoded``, the text of each row's ids."""
    if "decoded" in keys:
        raise ValueError("rename the key column decoded")
    rows = rows.select(F.coalesce(named(ids), F.array().cast("array<int>")).alias("_0"), *map(named, keys))
    return rows.toDF(*_places(rows)).mapInArrow(_decode(model or tokenizer_path(MODEL)), T.StructType([*rows.schema[1:], T.StructField("decoded", T.StringType())]))


def _digest(path: str):
    """Ids to their hash, next to the hash of what they decode to."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(path)
        for whole in batches:
            for k in range(0, len(whole), 1024):
                batch = whole.slice(k, 1024)
                ids = _rows(batch.column(0))
                texts = model.library.decode(ids, num_threads=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1), batch.column(2), batch.column(3),
                     pa.array([hashlib.sha256(",".join(map(model.names.__getitem__, x)).encode()).hexdigest() for x in ids], pa.string()),
                     pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts], pa.string())],
                    names=["doc_id", "n_tokens", "end_byte", "ids_sha256", "decoded_sha256"])
    return run


def op11_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents, digested, with the byte where the last piece's span ends (0 without pieces)."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    pieces = encode_pieces(docs, ["doc_id"])
    last = F.coalesce(F.try_element_at("ends", F.lit(-1)), F.lit(0)).cast("long")
    rows = pieces.select("ids", "doc_id", F.size("ids").cast("long").alias("n_tokens"), last.alias("end_byte"))
    return rows.mapInArrow(_digest(tokenizer_path(MODEL)),
                           "doc_id bigint, n_tokens bigint, end_byte bigint, ids_sha256 string, decoded_sha256 string")
