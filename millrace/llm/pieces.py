"""Operator 6: SentencePiece encoding and decoding by a table of distinct chunks.

No piece of the vocabulary has a white space marker behind other characters, and none has a line
end. A text therefore falls into chunks (markers with the characters up to the next marker or line
end, and line ends) whose segmentations do not touch. Every task segments each distinct chunk once
and joins ids, and decoded characters, back by position.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .base import query, table
from .packing import _portions
from .text import column

MARK = "▁"
# Chunks that a task remembers at one time.
REMEMBERED = 300_000
_CHUNK = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")


class Chunks:
    """Ids and decoded bytes of texts, through a table of the distinct chunks met so far."""

    _loaded: dict[str, Chunks] = {}

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any("\n" in p or (MARK in p[1:] and p.strip(MARK)) for p in names):
            raise ValueError("this vocabulary has pieces that cross a marker or a line end")
        # What a line end in front of a chunk adds to its ids; it keeps the library from adding a marker.
        self.lead = self.model.encode("\n")
        if self.model.decode(self.lead) != "\n":
            raise ValueError("this model changes line ends")
        self.begin, self.end = self.model.bos_id(), self.model.eos_id()
        self.known: dict[str, tuple[bytes, bytes]] = {}

    @classmethod
    def of(cls, path: str) -> Chunks:
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def _learn(self, chunks: list[str]) -> None:
        n = len(self.lead)
        for at in range(0, len(chunks), 10_000):
            part = chunks[at : at + 10_000]
            ids = self.model.encode(["\n" + c for c in part], num_threads=1)
            decoded = self.model.decode(ids, num_threads=1)
            for chunk, found, text in zip(part, ids, decoded):
                self.known[chunk] = np.array(found[n:], dtype="<u4").tobytes(), text[1:].encode()

    def encode(self, texts: list[str]) -> Iterator[tuple[bytes, bytes]]:
        """(ids with begin and end, decoded bytes) of each text."""
        cut = [_CHUNK.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        wanted = set().union(*cut)
        new = wanted.difference(self.known)
        if len(self.known) + len(new) > REMEMBERED:
            self.known, new = {}, wanted
        self._learn(list(new))
        get = self.known.__getitem__
        first, last = (np.array([i], dtype="<u4").tobytes() for i in (self.begin, self.end))
        for chunks in cut:
            rows = list(map(get, chunks))
            decoded = b"".join([r[1] for r in rows])
            yield first + b"".join([r[0] for r in rows]) + last, decoded[1:]  # without the marker put in front


def encode(docs: DataFrame, model: str, doc_id: str = "doc_id", text: str = "text", digests: bool = False) -> DataFrame:
    """One row per document: id, n_tokens, then ids and decoded, or their digests.

    ids are those of the library with begin and end ids, `decoded` is what it decodes them to. A
    null text counts as empty and has the begin and the end id. Rows with the same id are encoded
    one by one.
    """
    id_type = docs.schema[doc_id].dataType.simpleString()
    last = ["ids_sha256", "decoded_sha256"] if digests else ["ids", "decoded"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table_ = Chunks.of(model)
        for batch in batches:
            sizes, ids, decoded = [], [], []
            for part in _portions([t or "" for t in column(batch, "text").to_pylist()]):
                for a, b in table_.encode(part):
                    sizes.append(len(a) // 4)
                    ids.append(hashlib.sha256(a).hexdigest() if digests else np.frombuffer(a, dtype="<i4"))
                    decoded.append(hashlib.sha256(b).hexdigest() if digests else b.decode())
            kind = pa.string() if digests else pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [column(batch, "doc_id"), pa.array(sizes, pa.int64()), pa.array(ids, kind), pa.array(decoded, pa.string())],
                names=["doc_id", "n_tokens", *last],
            )

    rows = docs.select(docs[doc_id].alias("doc_id"), docs[text].cast("string").alias("text"))
    kinds = f"{last[0]} {'string' if digests else 'array<int>'}, {last[1]} string"
    return rows.mapInArrow(work, f"doc_id {id_type}, n_tokens bigint, {kinds}").withColumnRenamed("doc_id", doc_id)


@query("op6_sentencepiece")
def op6(spark, folder):
    """Digests of every document's ids and of the text they decode to."""
    import public_tokenizers

    return encode(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"), digests=True)
