"""Byte-pair encoding and decoding of whole texts.

Encoding keeps a priority queue of merge ranks over a doubly linked list of symbols; an
entry whose symbols have changed since it was queued is stale and skipped. Decoding
concatenates vocabulary strings, with a space between tokens where the vocabulary file
names no decoder (as its library does).

Null and empty texts have no tokens. Rows keep their number and order of columns: a
repeated row gives a repeated result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from emberscope.llm.pretokens import BatchEncoder, byte_letters
from emberscope.llm.storage import text_of
from emberscope.session import ship_package

OUTPUTS = {
    "ids": ("array<int>", pa.list_(pa.int32())),
    "n_tokens": ("long", pa.int64()),
    "ids_sha256": ("string", pa.string()),
    "decoded": ("string", pa.string()),
    "decoded_sha256": ("string", pa.string()),
}


class Bpe:
    """A vocabulary with ranked merges."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        suffix = model["end_of_word_suffix"] or ""
        letters = byte_letters()
        self.inner = [vocab.get(c) for c in letters]
        self.last = [vocab.get(c + suffix) for c in letters]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[vocab[a], vocab[b]] = (rank, vocab[a + b])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        strings = {i: s for s, i in [*vocab.items(), *self.special.items()]}
        self.strings = [strings.get(i, "") for i in range(max(strings) + 1)]
        self.words = spec["normalizer"] is not None
        self.joint = " " if spec["decoder"] is None else ""
        self.byte_of = None if spec["decoder"] is None else {c: b for b, c in enumerate(letters)}

    def encode_word(self, word: str) -> list[int]:
        raw = word.encode("utf-8", "surrogatepass")
        symbol = [self.inner[b] for b in raw]
        symbol[-1] = self.last[raw[-1]]
        n = len(symbol)
        if n == 1:
            return symbol
        merges = self.merges
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        queue = []
        for i in range(n - 1):
            found = merges.get((symbol[i], symbol[i + 1]))
            if found:
                queue.append((found[0], i, symbol[i], symbol[i + 1], found[1]))
        heapify(queue)
        while queue:
            _, i, left, right, merged = heappop(queue)
            j = after[i]
            if symbol[i] != left or j < 0 or symbol[j] != right:
                continue  # stale
            symbol[i], symbol[j] = merged, -1
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                found = merges.get((merged, symbol[k]))
                if found:
                    heappush(queue, (found[0], i, merged, symbol[k], found[1]))
            h = before[i]
            if h >= 0:
                found = merges.get((symbol[h], merged))
                if found:
                    heappush(queue, (found[0], h, symbol[h], merged, found[1]))
        return [s for s in symbol if s >= 0]

    def encoder(self) -> BatchEncoder:
        each = self.encode_word
        plain = BatchEncoder(self.words, lambda found: [each(w) for w in found], lambda t: [], ())

        def whole(text: str) -> list[int]:
            """Special strings are cut out first, the longest at a place; the rest is ordinary text."""
            out: list[int] = []
            while text:
                hits = [(text.find(s), -len(s), s) for s in self.special if s in text]
                at, _, s = min(hits) if hits else (len(text), 0, "")
                out += plain.encode([text[:at]])[0].tolist()
                if s:
                    out.append(self.special[s])
                text = text[at + len(s) :]
            return out

        plain.whole, plain.special = whole, tuple(self.special)
        whole_encoder = BatchEncoder(self.words, plain.encode_words, whole, tuple(self.special))
        plain.special = ()
        return whole_encoder

    def decode(self, ids: list[int]) -> str:
        text = self.joint.join(map(self.strings.__getitem__, ids))
        if self.byte_of is None:
            return text
        return bytes(map(self.byte_of.__getitem__, text)).decode("utf-8", "replace")


@lru_cache(2)
def _loaded(text: str) -> tuple[Bpe, BatchEncoder]:
    bpe = Bpe(text)
    return bpe, bpe.encoder()


def encode(docs: DataFrame, vocabulary: str, outputs: tuple[str, ...] = ("ids", "decoded"), key: str = "doc_id") -> DataFrame:
    """``key`` and the named ``OUTPUTS`` of each row's text, over the vocabulary file ``vocabulary``.

    ``ids_sha256`` digests the ids as little-endian unsigned 32-bit integers. The file is
    read on the driver and sent along (a few MB, whatever the data).
    """
    spark = docs.sparkSession
    ship_package(spark)
    with open(vocabulary, encoding="utf-8") as f:
        sent = spark.sparkContext.broadcast(f.read())
    kept = docs.select(key, text_of().alias("text"))
    key_type = kept.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, encoder = _loaded(sent.value)
        for batch in batches:
            for a, b, ids, counts in encoder.chunks(batch.column(1)):
                ends = np.cumsum(counts)
                each = [ids[e - n : e] for e, n in zip(ends.tolist(), counts.tolist())]
                made: dict[str, list] = {"n_tokens": counts.tolist()}
                if "ids" in outputs:
                    made["ids"] = each
                if "ids_sha256" in outputs:
                    made["ids_sha256"] = [hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in each]
                if "decoded" in outputs or "decoded_sha256" in outputs:
                    texts = [bpe.decode(x.tolist()) for x in each]
                    made["decoded"] = texts
                    made["decoded_sha256"] = [hashlib.sha256(t.encode("utf-8")).hexdigest() for t in texts]
                columns = [batch.column(0).slice(a, b - a)]
                columns += [pa.array(made[o], OUTPUTS[o][1]) for o in outputs]
                yield pa.RecordBatch.from_arrays(columns, names=[key, *outputs])

    schema = ", ".join([f"{key} {key_type}", *(f"{o} {OUTPUTS[o][0]}" for o in outputs)])
    return kept.mapInArrow(run, schema)


def decode(tokens: DataFrame, vocabulary: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key`` and ``decoded``, the text of a column of ids; null ids decode to the empty text."""
    spark = tokens.sparkSession
    ship_package(spark)
    with open(vocabulary, encoding="utf-8") as f:
        sent = spark.sparkContext.broadcast(f.read())
    kept = tokens.select(key, ids)

    def run(batches):
        bpe, _ = _loaded(sent.value)
        for batch in batches:
            texts = [bpe.decode(x or []) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[key, "decoded"])

    return kept.mapInArrow(run, f"{key} {kept.schema[key].dataType.simpleString()}, decoded string")
