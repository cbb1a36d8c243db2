"""SentencePiece encoding and decoding by a table of distinct chunks.

A chunk is a run of spaces (or of the mark that stands for one) with the word behind it. Where no piece of the model
holds a mark behind another character and none is user-defined, no merge crosses the front of a chunk, so a text's ids
are those of its chunks one after the other. Each task segments a distinct chunk once while its table holds it, and
joins the ids back by position; the model is checked for the property, and texts are encoded whole if it lacks it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .batches import mapped, record_batch, text_chunks
from .chunks import ChunkTable, flattened

MARK = "▁"
_CHUNK = re.compile(" +[^ ]*")
_OUT = pa.schema([("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])
_DIGEST = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


class PieceCoder:
    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        from sentencepiece.sentencepiece_model_pb2 import ModelProto

        self.lib = SentencePieceProcessor(model_file=path)
        with open(path, "rb") as f:
            model = ModelProto.FromString(f.read())
        norm = model.normalizer_spec
        self.plain = (
            model.trainer_spec.model_type == 2 and norm.add_dummy_prefix and not norm.remove_extra_whitespaces and norm.escape_whitespaces and not norm.precompiled_charsmap
            and not model.trainer_spec.treat_whitespace_as_suffix and not any(MARK in p.piece.lstrip(MARK) or p.type == 4 for p in model.pieces)
        )
        self.mark, self.ends = self.lib.piece_to_id(MARK), (self.lib.bos_id(), self.lib.eos_id())
        self.table = ChunkTable(self._segment, limit=150_000)

    def _segment(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Chunks without their first space, which the library puts in front itself, except before nothing."""
        return flattened([ids if c else [self.mark] for c, ids in zip(chunks, self.lib.encode(chunks, num_threads=1))])

    @staticmethod
    def chunks(text: str) -> list[str]:
        if not text:
            return []
        text = text.replace(MARK, " ")
        words = text.split(" ")
        return words if "" not in words else [c[1:] for c in _CHUNK.findall(" " + text)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """ids of each text with begin and end ids."""
        if not self.plain:
            return [np.array(ids, np.uint32) for ids in self.lib.encode(texts, add_bos=True, add_eos=True, num_threads=1)]
        ids, counts = self.table.ids_of(pa.array([self.chunks(t) for t in texts], pa.list_(pa.string())))
        edges = np.cumsum(counts)
        begin, end = np.uint32(self.ends[0]), np.uint32(self.ends[1])
        return [np.concatenate([[begin], ids[e - n : e], [end]]).astype(np.uint32) for e, n in zip(edges.tolist(), counts.tolist())]

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        return self.lib.decode([x.tolist() for x in ids], num_threads=1) if ids else []


@cache  # a worker that is used again keeps its table
def piece_coder(path: str) -> PieceCoder:
    return PieceCoder(path)


def digests(docs: DataFrame, model_path: str) -> DataFrame:
    """docs(doc_id, text) -> (doc_id, n_tokens, ids_sha256, decoded_sha256) of ``encode_decode``, a row for each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = piece_coder(model_path)
        for part, texts in text_chunks(batches):
            ids = coder.encode(texts)
            yield record_batch(_DIGEST, part.column("doc_id"), [len(x) for x in ids], [hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in ids], [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in coder.decode(ids)])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode_decode(docs: DataFrame, model_path: str) -> DataFrame:
    """All columns of docs and piece_ids array<int>, piece_text string (the ids decoded); clashing columns are replaced.

    A null text counts as empty: begin and end ids only, decoded as ''. Rows are kept one for one, repeated ones too.
    """
    rows = docs.drop("piece_ids", "piece_text")
    schema = rows.select("*", F.lit(None).cast("array<int>").alias("piece_ids"), F.lit("").alias("piece_text")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = piece_coder(model_path)
        for part, texts in text_chunks(batches):
            ids = coder.encode(texts)
            arrays = [*part.columns, pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())), pa.array(coder.decode(ids), pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*part.schema.names, "piece_ids", "piece_text"])

    return mapped(rows, run, schema)
