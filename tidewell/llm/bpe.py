"""BPE encoding and decoding with a segment tree over adjacent pair ranks.

Every leaf of the tree holds rank * 2^32 + position of the pair that starts at a
symbol; an inner node holds the least of its children. The root is therefore the
leftmost pair of lowest rank. A merge rewrites three leaves, each in O(log n), until
the root says that no pair can be merged.

Defined results: a null text is an empty text (0 tokens, hashes of nothing); rows
are encoded one by one, so ties, repeats and order do not matter; further input
columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import struct

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm import common

QUERY = "op10_bpe"

#: The published byte-level pre-tokenizer's pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

NONE = 1 << 62
#: Distinct pieces, and stretches between spaces, that a worker remembers in two generations.
MEMORY = 500_000


def byte_alphabet() -> dict[str, int]:
    """Printable stand-in of each byte, as byte-level vocabularies spell them."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in plain}
    for k, b in enumerate(b for b in range(256) if b not in set(plain)):
        out[chr(256 + k)] = b
    return out


class BytePairCodec:
    """Encoder and decoder of one byte-level vocabulary, given as tokenizer JSON."""

    def __init__(self, spec: str):
        held = json.loads(spec)
        model, alphabet = held["model"], byte_alphabet()
        vocab = model["vocab"]
        self.tokens = [b""] * (1 + max([*vocab.values(), *(a["id"] for a in held["added_tokens"])]))
        for text, i in vocab.items():
            self.tokens[i] = bytes(alphabet[c] for c in text)
        self.special = {a["content"]: a["id"] for a in held["added_tokens"]}
        for text, i in self.special.items():
            self.tokens[i] = text.encode()
        self.of_byte = [0] * 256
        for c, b in alphabet.items():
            self.of_byte[b] = vocab[c]
        self.pairs: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.pairs[vocab[a] << 32 | vocab[b]] = (rank << 32, vocab[a + b])
        self.pieces = regex.compile(PATTERN)
        self.double = regex.compile(r"\s\s")
        self.splits = regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))) if self.special else None
        self.of_piece: dict[str, bytes] = {}
        self.of_chunk: dict[str, bytes] = {}
        self.old_piece: dict[str, bytes] = {}
        self.old_chunk: dict[str, bytes] = {}

    def merge(self, symbols: list[int]) -> list[int]:
        """Merge a piece's byte symbols as far as the ranks allow."""
        n = len(symbols)
        if n < 2:
            return symbols
        pairs, size = self.pairs, 1
        while size < n:
            size *= 2
        tree = [NONE] * (2 * size)
        for i in range(n - 1):
            found = pairs.get(symbols[i] << 32 | symbols[i + 1])
            if found:
                tree[size + i] = found[0] + i
        for k in range(size - 1, 0, -1):
            a, b = tree[2 * k], tree[2 * k + 1]
            tree[k] = a if a < b else b
        if tree[1] == NONE:
            return symbols
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))

        def put(leaf: int, value: int) -> None:
            k = size + leaf
            tree[k] = value
            while k > 1:
                other = tree[k ^ 1]
                if other < value:
                    value = other
                k >>= 1
                if tree[k] == value:
                    return
                tree[k] = value

        while (least := tree[1]) != NONE:
            i = least & 0xFFFFFFFF
            j = after[i]
            symbols[i] = pairs[symbols[i] << 32 | symbols[j]][1]
            end = after[j]
            after[i] = end
            symbols[j] = -1
            put(j, NONE)
            if end < n:
                before[end] = i
                found = pairs.get(symbols[i] << 32 | symbols[end])
                put(i, found[0] + i if found else NONE)
            else:
                put(i, NONE)
            h = before[i]
            if h >= 0:
                found = pairs.get(symbols[h] << 32 | symbols[i])
                put(h, found[0] + h if found else NONE)
        return [s for s in symbols if s >= 0]

    def _piece(self, piece: str) -> bytes:
        found = self.of_piece.get(piece)
        if found is None:
            found = self.old_piece.get(piece)
            if found is None:
                ids = self.merge([self.of_byte[b] for b in piece.encode()])
                found = struct.pack(f"<{len(ids)}I", *ids)
            if len(self.of_piece) >= MEMORY // 2:
                self.old_piece, self.of_piece = self.of_piece, {}
            if len(piece) <= 256:
                self.of_piece[piece] = found
        return found

    def _chunk(self, chunk: str) -> bytes:
        found = self.old_chunk.get(chunk)
        if found is None:
            found = b"".join(map(self._piece, self.pieces.findall(chunk)))
        if len(self.of_chunk) >= MEMORY // 2:
            self.old_chunk, self.of_chunk = self.of_chunk, {}
        if len(chunk) <= 256:
            self.of_chunk[chunk] = found
        return found

    def _ordinary(self, text: str) -> bytes:
        """Pieces never reach over a lone space, which always opens one: such stretches repeat and are remembered."""
        if not text:
            return b""
        if self.double.search(text) or text[0].isspace() or text[-1].isspace():
            return b"".join(map(self._piece, self.pieces.findall(text)))
        out = []
        first, *rest = text.split(" ")
        out.append(self._chunk(first))
        for word in rest:
            word = " " + word
            out.append(self.of_chunk.get(word) or self._chunk(word))
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not self.splits or not any(s in text for s in self.special):
            return self._ordinary(text)
        out, at = [], 0
        for m in self.splits.finditer(text):
            out += [self._ordinary(text[at : m.start()]), np.uint32(self.special[m[0]]).tobytes()]
            at = m.end()
        return b"".join([*out, self._ordinary(text[at:])])

    def decode(self, ids: bytes) -> str:
        """Text of the ids; bytes that are no UTF-8 become replacement characters."""
        tokens = self.tokens
        return b"".join([tokens[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


def encode(docs: DataFrame, tokenizer_path: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keep columns, ids (binary, little-endian unsigned 32-bit) and decoded (string) of every text."""
    spark = docs.sparkSession
    common.bound_batches(spark)
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = f.read()
    shipped, key = spark.sparkContext.broadcast(spec), "bpe_" + hashlib.sha256(spec.encode()).hexdigest()[:16]
    source = docs.select(*keep, F.coalesce("text", F.lit("")).alias("__text"))
    schema = source.select(*keep).schema.add("ids", "binary").add("decoded", "string")

    def run(batches):
        codec = common.worker_state(key, lambda: BytePairCodec(shipped.value))
        for batch in batches:
            ids = [codec.encode(t) for t in batch.column("__text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in keep), pa.array(ids, pa.binary()), pa.array(map(codec.decode, ids), pa.string())],
                names=[*keep, "ids", "decoded"],
            )

    return source.mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    done = encode(common.read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return done.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
