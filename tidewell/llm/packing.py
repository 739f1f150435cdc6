"""Packing: concatenate all documents' tokens and cut them into fixed windows.

Two passes. The first tokenises each partition once, writes the ids with a running
offset inside the partition, and totals each partition; a prefix sum over the totals
gives every partition its global offset. The second adds the two and cuts at the
window borders: a document that crosses one becomes several boundary records.

Defined results: a null text is an empty text, whose document is the single end id;
rows that repeat are packed as often as they stand there; a null doc_id stays null;
an empty table gives no rows; further input columns are not read. Order of documents
is that of the input's partitions.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewell.llm import bpe, common

QUERY = "op2_packing"

#: Tokens of a window, and the id that ends every document.
WINDOW, END = 2048, 1
#: How byte-level vocabularies spell a space.
SPACE = "\u0120"
#: Kinds of bytes to the byte-level pre-tokenizer: spaces, line ends, letters (U+00C0 to U+017F among them), digits and other
#: ASCII; a piece is a run of one kind, and perhaps a space before it. Not OTHER: controls, the apostrophe (contractions are
#: pieces) and further characters.
GAP, LINE, LETTER, DIGIT, SIGN, OTHER = range(6)
KIND = np.full(256, OTHER, np.uint8)
KIND[33:127], KIND[39] = SIGN, OTHER
KIND[32], KIND[10], KIND[48:58] = GAP, LINE, DIGIT
KIND[65:91] = KIND[97:123] = KIND[128:192] = KIND[0xC3:0xC6] = LETTER
#: ASCII white space, and the first and second bytes of other white space (and of some characters besides).
WHITE, FIRST, SECOND = (np.isin(np.arange(256), x) for x in ([*range(9, 14), *range(28, 33)], [0xC2, 0xE1, 0xE2, 0xE3], [0x80, 0x81, 0x85, 0x9A, 0xA0]))
#: New pieces that are asked for in one text; more of them fill the processor's caches.
TOGETHER = 250
#: Distinct pieces, and other stretches, that a worker remembers with their ids, each in two generations, and their characters at most.
MEMORY, MEMORY_CHARS = 600_000, 64
#: Partition totals up to this number are broadcast, others joined by shuffle.
BROADCAST_TOTALS = 100_000


def buffers(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where each of a large array's values begins, with the last one's end, and their bytes."""
    _, stops, data = values.buffers()
    stops = np.frombuffer(stops, np.int64, len(values) + 1, values.offset * 8) if len(values) else np.zeros(1, np.int64)
    return stops - stops[0], np.frombuffer(data, np.uint8)[stops[0] : stops[-1]] if stops[-1] else np.zeros(0, np.uint8)


class Tokens:
    """Ids by the tokenizers library, remembered for each space-delimited stretch.

    The library's byte-level pre-tokenizer starts a new piece at every lone space, so
    a text's ids are those of its stretches; texts with other white space next to each
    other go to the library whole. Stretches of plain characters are cut into their
    pieces by the kinds of their bytes, and of a batch each distinct piece or other
    stretch is looked up once. Pieces that aren't remembered go to the same model without
    its pre-tokenizer's pattern, some hundreds in a text; what it gives is cut by the
    bytes that tokens stand for. Other stretches are asked for in few texts, cut before
    each token that begins with a space.
    """

    def __init__(self, spec: str):
        import regex
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_str(spec)
        # Stretches that aren't remembered are new words, most of which the library's own small cache doesn't hold either.
        self.uncached = Tokenizer.from_str(spec)
        if hasattr(self.uncached.model, "_resize_cache"):
            self.uncached.model._resize_cache(0)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.double = regex.compile(r"\s\s")
        # Pieces need no pattern: the same model behind a splitter at spaces, given as bytes are spelled, zeros between pieces as spaces.
        self.plain = Tokenizer(self.uncached.model)
        self.plain.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.spelt = np.zeros(256, "<u4")
        for c, b in bpe.byte_alphabet().items():
            self.spelt[b] = ord(c)
        self.spelt[0] = 32
        held = json.loads(spec)
        byte_level = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        self.by_pieces = not held.get("normalizer") and byte_level.items() <= (held.get("pre_tokenizer") or {}).items()
        vocab = self.library.get_vocab(with_added_tokens=True)
        self.opens = np.zeros(1 + max(vocab.values()), bool)
        self.opens[[i for t, i in vocab.items() if t.startswith(SPACE)]] = True
        # Bytes that a token stands for.
        self.size = np.zeros(len(self.opens), np.int64)
        self.size[list(vocab.values())] = [len(t) for t in vocab]
        self.pieces: dict[bytes, bytes] = {}
        self.old_pieces: dict[bytes, bytes] = {}
        # Other stretches after a space, named without it, and their ids, in two generations.
        none = pa.array([], pa.large_string()), pa.array([], pa.large_binary())
        self.held: tuple[pa.Array, pa.Array] = none
        self.old: tuple[pa.Array, pa.Array] = none

    def _ask(self, texts: list[str], library: str = "library") -> list[bytes]:
        done = getattr(self, library).encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in done]

    def _ask_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each plain piece, asked for in few texts."""
        groups = [pieces[a : a + TOGETHER] for a in range(0, len(pieces), TOGETHER)]
        raw = [np.frombuffer(b"\0".join(some), np.uint8) for some in groups]
        out = []
        for some, text, data in zip(groups, raw, self._ask([self.spelt[t].tobytes().decode("utf-32-le") for t in raw], "plain"), strict=True):
            ends = np.append(np.flatnonzero(text == 0), len(text)) - np.arange(len(some))
            reached = np.cumsum(self.size[np.frombuffer(data, "<u4")])
            cuts = np.searchsorted(reached, ends) + 1
            if cuts[-1] * 4 != len(data) or (reached[cuts - 1] != ends).any():  # a vocabulary whose tokens don't spell the bytes
                out += self._ask([p.decode() for p in some])
                continue
            cuts = (cuts * 4).tolist()
            out += [data[a:b] for a, b in zip([0, *cuts], cuts, strict=False)]
        return out

    def _pieces(self, words: pa.Array) -> pa.Array:
        """Ids of each of different plain pieces, remembered or asked for."""
        if len(self.pieces) > MEMORY // 2:
            self.old_pieces, self.pieces = self.pieces, {}
        named = words.cast(pa.large_binary()).to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.pieces.get, named))
        missing = [w for w, x in zip(named, found, strict=True) if x is None]
        old = list(map(self.old_pieces.get, missing))
        fresh = iter(self._ask_pieces([w for w, x in zip(missing, old, strict=True) if x is None]))
        old = [next(fresh) if x is None else x for x in old]
        self.pieces.update((w, x) for w, x in zip(missing, old, strict=True) if len(w) <= MEMORY_CHARS)
        fresh = iter(old)
        return self._binary([next(fresh) if x is None else x for x in found])

    def _binary(self, ids: list[bytes]) -> pa.Array:
        stops = np.cumsum(np.fromiter((0, *map(len, ids)), np.int64, len(ids) + 1))
        return pa.Array.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(stops), pa.py_buffer(b"".join(ids))])

    def _ask_stretches(self, words: list[str]) -> pa.Array:
        """Ids of each stretch after a space, asked for in few texts."""
        parts, sizes = [], []
        for a in range(0, len(words), 2_000):
            some = words[a : a + 2_000]
            ids = np.frombuffer(self._ask([" " + " ".join(some)], "uncached")[0], "<u4")
            cuts = np.flatnonzero(self.opens[ids])
            if len(cuts) != len(some):  # a vocabulary whose tokens don't keep to the stretches
                one_by_one = self._ask([" " + w for w in some])
                ids, cuts = np.frombuffer(b"".join(one_by_one), "<u4"), np.cumsum([0, *map(len, one_by_one)])[:-1] // 4
            parts.append(ids)
            sizes.append(np.diff(cuts, append=len(ids)))
        stops = np.cumsum(np.concatenate([[0], *sizes]), dtype=np.int64) * 4
        data = np.concatenate([np.zeros(0, "<u4"), *parts])
        return pa.Array.from_buffers(pa.large_binary(), len(words), [None, pa.py_buffer(stops), pa.py_buffer(data)])

    def _stretches(self, words: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Ids, and the place among them of those of each of different stretches after a space."""
        if len(self.held[0]) > MEMORY // 2:
            self.old, self.held = self.held, (self.old[0][:0], self.old[1][:0])
        known, ids = (pa.concat_arrays(x) for x in zip(self.held, self.old, strict=True))
        at = pc.index_in(words, value_set=known)
        new = words.filter(pc.is_null(at))
        fresh = self._ask_stretches(new.to_pylist())
        again, short = pc.greater_equal(at, len(self.held[0])), pc.less_equal(pc.utf8_length(new), MEMORY_CHARS)
        self.held = (
            pa.concat_arrays([self.held[0], words.filter(again), new.filter(short)]),
            pa.concat_arrays([self.held[1], ids.take(at.filter(again)), fresh.filter(short)]),
        )
        place = pc.fill_null(at, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        place[place < 0] = np.arange(len(ids), len(ids) + len(new))
        return pa.concat_arrays([ids, fresh]), place

    def _look_up(self, words: pa.Array, plain: np.ndarray) -> tuple[pa.Array, pa.Array]:
        """Ids, and the place among them of those of each of different pieces and other stretches."""
        opens = pc.starts_with(words, " ").to_numpy(zero_copy_only=False)
        kinds = [plain, ~plain & opens, ~plain & ~opens]
        pieces, stretches, heads = (words.filter(k) for k in kinds)
        ids = [self._pieces(pieces), None, self._binary(self._ask(heads.to_pylist()))]
        ids[1], place = self._stretches(pc.utf8_slice_codeunits(stretches, 1))
        places = np.empty(len(words), np.int64)
        for k, at in zip(kinds, (np.arange(len(pieces)), len(pieces) + place, len(pieces) + len(ids[1]) + np.arange(len(heads))), strict=True):
            places[k] = at
        return pa.concat_arrays(ids), pa.array(places)

    def _whole(self, texts: pa.Array) -> np.ndarray:
        """Which texts go to the library whole."""
        stops, data = buffers(texts)
        sizes, first = np.diff(stops), stops[:-1]
        white, other = WHITE[data], np.flatnonzero(FIRST[data[:-1]])
        odd = np.concatenate([np.flatnonzero(white[1:] & white[:-1]), other[SECOND[data[other + 1]]]])
        doubtful = np.zeros(len(texts), bool)
        doubtful[np.searchsorted(stops, odd, "right") - 1] = True
        some = np.flatnonzero(sizes)
        doubtful[some] |= white[first[some]] | white[stops[some + 1] - 1]
        out = np.zeros(len(texts), bool)
        for k in np.flatnonzero(doubtful):
            t = texts[k].as_py()
            out[k] = self.double.search(t) is not None or t[:1].isspace() or t[-1:].isspace()
        for s in self.special:
            out |= pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
        return out

    def _cut(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """Pieces and other stretches of all texts, which of them are plain pieces, and how many come before each text and in all."""
        stops, data = buffers(texts)
        kinds = KIND[data]
        c3 = np.flatnonzero(data == 0xC3)
        c3 = c3[np.isin(data[c3 + 1], (0x97, 0xB7))]  # signs among letters: multiplication and division
        kinds[c3] = OTHER
        if not self.by_pieces:
            kinds[kinds > GAP] = OTHER
        begins = np.zeros(len(data) + 1, bool)
        begins[1:-1] = (kinds[1:] != kinds[:-1]) & (kinds[:-1] != GAP)
        begins[stops] = True
        at = np.flatnonzero(begins[:-1])
        # Stretches begin at spaces and with texts; one with other bytes stays whole.
        opens = kinds[at] == GAP
        opens[np.searchsorted(at, stops[:-1][np.diff(stops) > 0])] = True
        stretch = np.cumsum(opens) - 1
        other = np.zeros(len(at) + 1, bool)
        other[np.searchsorted(at[opens], np.flatnonzero(kinds == OTHER), "right") - 1] = True
        other = other[stretch]
        keep = opens | ~other
        at, plain = at[keep], ~other[keep]
        ends = np.append(at, len(data))
        units = pa.Array.from_buffers(pa.large_string(), len(at), [None, pa.py_buffer(ends), pa.py_buffer(data)])
        return units, plain, np.searchsorted(at, stops)

    def column(self, texts: pa.Array, end: bytes = b"") -> pa.Array:
        """Ids of each text as little-endian unsigned 32-bit integers, and end after them; no text is null."""
        texts = texts.cast(pa.large_string())
        whole = self._whole(texts)
        asked = iter(self._ask(texts.filter(whole).to_pylist()))
        units, plain, counts = self._cut(texts.filter(~whole))
        units = units.dictionary_encode()
        kinds = np.zeros(len(units.dictionary), bool)
        kinds[units.indices.to_numpy(zero_copy_only=False)[plain]] = True
        ids, place = self._look_up(units.dictionary, kinds)
        ids = ids.take(place.take(units.indices))
        # The ids of all texts' units lie one after another; those of one text end where its last unit does.
        stops, data = buffers(ids)
        stops = stops[counts].tolist()
        data = memoryview(data)
        split = iter([b"".join((data[a:b], end)) for a, b in zip(stops, stops[1:], strict=False)])
        return pa.array([next(asked) + end if w else next(split) for w in whole.tolist()], pa.binary())

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        return self.column(pa.array(texts, pa.string())).to_pylist()


def tokenise(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """First pass: (doc_id, part, start_in_part, doc_tokens, ids), written to the shared folder."""
    spark = docs.sparkSession
    common.bound_batches(spark)
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = f.read()
    shipped, key = spark.sparkContext.broadcast(spec), "pack_" + hashlib.sha256(spec.encode()).hexdigest()[:16]
    source = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("__text"))
    schema = source.select("doc_id").schema.add("part", "integer").add("start_in_part", "long").add("doc_tokens", "long").add("ids", "binary")
    end = np.array([END], "<u4").tobytes()

    def run(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tokens = common.worker_state(key, lambda: Tokens(shipped.value))
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            ids = tokens.column(batch.column("__text"), end)
            lengths = pc.binary_length(ids).to_numpy(zero_copy_only=False).astype(np.int64) // 4
            starts = at + np.cumsum(lengths) - lengths
            at += int(lengths.sum())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.full(len(ids), part, np.int32)), pa.array(starts), pa.array(lengths), ids],
                names=["doc_id", "part", "start_in_part", "doc_tokens", "ids"],
            )
        common.tidy()

    return common.table(source.mapInArrow(run, schema), "tokens")


def pack(docs: DataFrame, tokenizer_path: str, window: int = WINDOW) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (binary), doc_tokens, sequence_id, offset."""
    done = tokenise(docs, tokenizer_path)
    totals = done.groupBy("part").agg(F.sum("doc_tokens").alias("total"))
    # One row per partition of the first pass, so one task can sum them.
    bases = totals.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("base"))
    if totals.limit(BROADCAST_TOTALS + 1).count() <= BROADCAST_TOTALS:
        bases = F.broadcast(bases)
    placed = done.join(bases, "part").select("doc_id", "doc_tokens", "ids", (F.col("base") + F.col("start_in_part")).alias("at"))
    first, last = F.expr(f"at div {window}"), F.expr(f"(at + doc_tokens - 1) div {window}")
    # A piece is what the document and the window have in common; its ids are cut out before the pieces become rows.
    at = F.col("at")

    def piece(k):
        start = F.greatest(F.lit(0).cast("long"), k * window - at)
        stop = F.least(F.col("doc_tokens"), (k + 1) * window - at)
        ids = F.substring("ids", (start * 4 + 1).cast("int"), ((stop - start) * 4).cast("int"))
        return F.struct(start.alias("start"), (stop - start).alias("length"), ids.alias("ids"), k.alias("sequence_id"), (at + start - k * window).alias("offset"))

    pieces = placed.select("doc_id", "doc_tokens", F.explode(F.transform(F.sequence(first, last), piece)).alias("p"))
    return pieces.select("doc_id", "p.start", "p.length", "p.ids", "doc_tokens", "p.sequence_id", "p.offset")


def digest(pieces: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digest(pack(common.read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")))
