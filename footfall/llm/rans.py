"""Token ids in a binary format coded by a static range asymmetric numeral system (rANS).

A store is a folder with two tables. ``table`` holds the one frequency table, quantised to
``2**SCALE``, that all blocks share. ``blocks`` holds a row per block: a run of whole documents in
ascending order of their ids, closed once it has ``BLOCK`` token ids, with the documents' ids and
lengths, the ids' checksum, and a payload. A payload interleaves ``LANES`` coders: lane j codes ids
j, j + LANES, … A checkpoint with all lane states and the place in the stream stands before every
``EVERY`` steps, so a reader decodes all stretches of all its blocks side by side.

Coding is vectorised over lanes and blocks (decoding over lanes and stretches). Nothing depends on
where a block is read: any executor can decode any block with the shared table.

Defined cases: null and empty texts hold only the end id; a null ``doc_id`` sorts first; repeated
rows are stored as often as given, texts of one id in order of their ids' hash; an empty table gives an empty
store; further columns are ignored. A token the table has not seen can't be coded and raises.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from itertools import repeat
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm.common import per_process, pieces, ragged, segments, shuffle_partitions
from footfall.session import materialise

SCALE = 18
LANES = 32
EVERY = 256
BLOCK = 1 << 15
LOW = np.uint64(1 << 31)
WORD = np.uint64(32)


# --- coding ---------------------------------------------------------------------------------


def quantise(counts: np.ndarray) -> np.ndarray:
    """Frequencies that sum to ``2**SCALE``, at least 1 where a count is positive."""
    total, seen = int(counts.sum()), int((counts > 0).sum())
    if not total:
        return np.zeros(len(counts), dtype=np.int64)
    room = (1 << SCALE) - seen
    if room < 0:
        raise ValueError(f"{seen} different ids don't fit a table of 2**{SCALE}")
    exact = counts.astype(np.float64) * room / total
    freq = np.floor(exact).astype(np.int64)
    missing = room - int(freq.sum())
    freq[np.argsort(freq - exact, kind="stable")[:missing]] += 1
    return freq + (counts > 0)


class Table:
    def __init__(self, freq: np.ndarray):
        self.freq = freq.astype(np.uint64)
        self.start = segments(freq)[:-1].astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.int32), freq)


def encode_blocks(table: Table, blocks: list[np.ndarray]) -> list[bytes]:
    """Payload of each block of ids."""
    if not blocks:
        return []
    sizes = np.array([len(b) for b in blocks])
    steps = -(-sizes // LANES)
    deepest = int(steps.max())
    grid = np.zeros((deepest, len(blocks), LANES), dtype=np.int32)
    for i, ids in enumerate(blocks):
        own = np.full(steps[i] * LANES, ids[-1], dtype=np.int32)
        own[: len(ids)] = ids
        grid[: steps[i], i] = own.reshape(-1, LANES)
    state = np.full((len(blocks), LANES), LOW, dtype=np.uint64)
    words = np.zeros(grid.shape, dtype=np.uint32)
    sent = np.zeros(grid.shape, dtype=bool)
    marks = {}
    full = int(steps.min())
    for t in range(deepest - 1, -1, -1):
        on = slice(None) if t < full else np.flatnonzero(steps > t)
        ids, x = grid[t, on], state[on]
        freq = table.freq[ids]
        if not freq.all():
            raise ValueError("an id is not in the frequency table")
        out = x >= freq << np.uint64(63 - SCALE)
        words[t, on], sent[t, on] = x & np.uint64(0xFFFFFFFF), out
        x = np.where(out, x >> WORD, x)
        state[on] = (x // freq << np.uint64(SCALE)) + x % freq + table.start[ids]
        if t % EVERY == 0:
            marks[t] = state.copy()
    payloads = []
    for i, n in enumerate(sizes):
        used = sent[: steps[i], i]
        places = segments(used.sum(axis=1))
        at = range(0, int(steps[i]), EVERY)
        heads = b"".join(np.uint32(places[t]).tobytes() + marks[t][i].astype("<u8").tobytes() for t in at)
        payloads.append(np.array([n, len(at)], "<u4").tobytes() + heads + words[: steps[i], i][used].astype("<u4").tobytes())
    return payloads


HEAD = np.dtype([("place", "<u4"), ("state", "<u8", (LANES,))])


def decode_blocks(table: Table, payloads: list[bytes]) -> list[np.ndarray]:
    """Ids of each payload; all stretches between checkpoints advance together."""
    if not payloads:
        return []
    states, places, lengths, streams, sizes, base = [], [], [], [], [], 0
    for payload in payloads:
        n, count = np.frombuffer(payload, "<u4", 2).tolist()
        heads = np.frombuffer(payload, HEAD, count, 8)
        stream = np.frombuffer(payload, "<u4", offset=8 + count * HEAD.itemsize)
        total = -(-n // LANES)
        states.append(heads["state"])
        places.append(heads["place"].astype(np.int64) + base)
        lengths += [min(EVERY, total - k * EVERY) for k in range(count)]
        streams.append(stream)
        sizes.append((n, count))
        base += len(stream)
    state, place = np.concatenate(states).astype(np.uint64), np.concatenate(places)
    stream = np.concatenate([*streams, np.zeros(LANES, "<u4")]).astype(np.uint64)
    lengths = np.array(lengths)
    out = np.zeros((len(lengths), EVERY, LANES), dtype=np.int32)
    mask, full = np.uint64((1 << SCALE) - 1), int(lengths.min()) if len(lengths) else 0
    for t in range(int(lengths.max()) if len(lengths) else 0):
        on = slice(None) if t < full else np.flatnonzero(lengths > t)
        x = state[on]
        slot = x & mask
        ids = table.symbol[slot.view(np.int64)]
        out[on, t] = ids
        x = table.freq[ids] * (x >> np.uint64(SCALE)) + slot - table.start[ids]
        need = x < LOW
        rank = np.cumsum(need, axis=1)
        at = place[on]
        x = np.where(need, x << WORD | stream[np.where(need, at[:, None] + rank - 1, 0)], x)
        place[on] = at + rank[:, -1]
        state[on] = x
    found, first = [], 0
    for n, count in sizes:
        found.append(out[first : first + count].reshape(-1)[:n])
        first += count
    return found


# --- tokens ---------------------------------------------------------------------------------


#: What is no ASCII or Latin-1 letter, sign or blank: such words may change in length in lower case or when composed.
#: Special tokens, which the tokenizer looks for first, hold ``<|``.
ODD = re.compile("<\\||[^\x09-\x0d\x20-\x7e\xc0-\xd6\xd8-\xf6\xf8-\xff]")
#: Fixed value of the tokenizer: its pattern for the parts of all other words, in lower case; a line end stands between words.
PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^\x09-\x0d a-z0-9\xdf-\xf6\xf8-\xff]+|\n")
#: Fixed values of the tokenizer: how it prepares and cuts a text. Others are given whole texts.
PREPARED = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
CUT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


def cuts_at_blanks(definition: dict) -> bool:
    """Whether the tokenizer drops blanks and cuts words as ``PARTS`` does."""
    prepared = (definition.get("normalizer") or {}).get("normalizers")
    cut = ((definition.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
    return (
        prepared == PREPARED
        and (cut.get("type"), cut.get("pattern"), cut.get("behavior"), cut.get("invert")) == ("Split", {"Regex": CUT}, "Removed", True)
        and all("<|" in t["content"] and not re.search(r"\s", t["content"]) for t in definition.get("added_tokens", []))
        and not definition.get("post_processor")
    )


class Ids:
    """Ids of different strings, one after another, and where each string's begin; a line end has none."""

    def __init__(self):
        self.place = {"\n": 0}
        self.ids, self.ends = np.zeros(0, np.int32), np.zeros(2, np.int64)

    def add(self, strings: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        self.place.update(zip(strings, range(len(self.place), len(self.place) + len(strings))))
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(counts)])
        self.ids = np.concatenate([self.ids, ids])

    def of(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the strings at ``places``, and how many each has."""
        counts = self.ends[places + 1] - self.ends[places]
        return ragged(self.ids, self.ends[places], counts).astype(np.int32), counts


class Encoder:
    """Ids of texts by the library, which is given every different part of a word once, many in a line.

    Texts are cut at ASCII blanks and their different words numbered by Arrow; the different words of a batch are cut into
    parts in one pass, but odd ones stay whole. The table of parts is emptied when it holds ``most``. A
    tokenizer that doesn't cut at blanks is given whole texts.
    """

    LINE = 512

    def __init__(self, definition: str, most: int = 3 << 18):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer, self.most = Tokenizer.from_str(definition), most
        loaded = json.loads(definition)
        self.by_part = cuts_at_blanks(loaded)
        # parts are in lower case and cut already: the same model, without preparing them again
        self.plain = Tokenizer.from_str(definition)
        self.plain.normalizer = normalizers.Sequence([])
        self.plain.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        suffix = loaded["model"].get("end_of_word_suffix")
        self.last = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)  # ids that end a part
        if suffix:
            self.last[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith(suffix)]] = True
        self.parts = Ids()

    def _whole(self, strings: list[str]) -> tuple[list[int], list[int]]:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(strings, add_special_tokens=False)]
        return [i for own in found for i in own], [len(own) for own in found]

    def _line(self, parts: list[str]) -> tuple[list[int], list[int]]:
        """Ids of parts that are encoded as one line; a part's last id tells where it ends."""
        ids = self.plain.encode_batch_fast([" ".join(parts)], add_special_tokens=False)[0].ids
        ends = np.flatnonzero(self.last[np.array(ids, dtype=np.int64)])
        if len(ends) != len(parts) or ends[-1] != len(ids) - 1:
            return self._whole(parts)
        return ids, np.diff(ends, prepend=-1).tolist()

    def _places(self, strings: list[str], encode) -> np.ndarray:
        """Where the table holds the strings, after those it lacks have been encoded."""
        places = np.fromiter(map(self.parts.place.get, strings, repeat(-1)), np.int64, len(strings))
        lacking = np.flatnonzero(places < 0)
        new, ids, counts = [strings[i] for i in lacking], [], []
        for low in range(0, len(new), self.LINE):
            more = encode(new[low : low + self.LINE])
            ids += more[0]
            counts += more[1]
        if new:
            places[lacking] = len(self.parts.place) + np.arange(len(new))
            self.parts.add(new, np.array(ids, np.int32), np.array(counts, np.int64))
        return places

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all words, and each word's place and number there."""
        joined = "\n".join([*words, ""])
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        odd = np.unique(np.searchsorted(ends, [m.start() for m in ODD.finditer(joined)], side="right"))
        whole = [words[i] for i in odd]
        if whole:
            for i in odd:
                words[i] = ""
            joined = "\n".join([*words, ""])
        cut = pa.array(PARTS.findall(joined.lower()), pa.large_string()).dictionary_encode()
        codes, different = cut.indices.to_numpy(zero_copy_only=False), cut.dictionary.to_numpy(zero_copy_only=False).tolist()
        places = self._places(different, self._line)
        ids, counts = self.parts.of(places[codes])
        after = np.flatnonzero(codes == different.index("\n")) + 1 if words else np.zeros(0, np.int64)
        bounds = segments(counts)[np.append(0, after)]  # a word's parts stand before its line end, which has no ids
        start, size = bounds[:-1].copy(), np.diff(bounds)
        more, own = self.parts.of(self._places(whole, self._whole))
        start[odd], size[odd] = len(ids) + segments(own)[:-1], own
        return np.concatenate([ids, more]), start, size

    def encode(self, texts: pa.Array, end: int) -> list[np.ndarray]:
        """Ids of each text, then ``end``; null is empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if not self.by_part:
            found = self.tokenizer.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)
            return [np.array([*own.ids, end], dtype=np.int32) for own in found]
        if len(self.parts.place) > self.most:
            self.parts = Ids()
        lists = pc.ascii_split_whitespace(texts)
        words = lists.flatten().dictionary_encode()
        ids, start, size = self._words(words.dictionary.to_numpy(zero_copy_only=False).tolist())
        codes = words.indices.to_numpy(zero_copy_only=False)
        counts = size[codes]
        flat = ragged(ids, start[codes], counts)
        sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = segments(counts)[segments(sizes)].tolist()
        return [np.append(flat[a:b], np.int32(end)) for a, b in zip(ends[:-1], ends[1:])]


def tokenize(docs: DataFrame, key: Column, text: Column, path: str, end: int) -> DataFrame:
    """``doc_id`` and ``ids``, as little-endian unsigned integers of 16 bits, or of 32 where needed.

    The driver reads the tokenizer's file; tasks get its text, whose size the file fixes. A worker
    keeps its tables from task to task.
    """
    definition = Path(path).read_text(encoding="utf-8")
    shared = docs.sparkSession.sparkContext.broadcast(definition)
    name = f"encoder-{zlib.crc32(definition.encode())}-{len(definition)}"
    kinds = [("doc_id", pa.int64()), ("ids", pa.binary()), ("wide", pa.bool_())]

    def run(batches):
        for rows in pieces(batches, "text"):
            found = per_process(name, lambda: Encoder(shared.value)).encode(rows.column(0), end)
            wide = [bool(i.max() > 0xFFFF) for i in found]
            ids = [i.astype("<u4" if w else "<u2").tobytes() for i, w in zip(found, wide)]
            yield pa.RecordBatch.from_arrays(
                [rows.column(1).cast(pa.int64()), pa.array(ids, pa.binary()), pa.array(wide)], schema=pa.schema(kinds)
            )

    source = docs.select(text.cast("string").alias("text"), key.cast("long").alias("doc_id"))
    return source.mapInArrow(run, "doc_id long, ids binary, wide boolean")


# --- stores ---------------------------------------------------------------------------------

BLOCKS = (
    "part int, number int, first long, doc_ids array<bigint>, sizes array<bigint>, crc32 long, payload binary"
)


def _ids(rows: pa.RecordBatch) -> list[np.ndarray]:
    columns = (rows.column(rows.schema.get_field_index(c)).to_pylist() for c in ("ids", "wide"))
    return [np.frombuffer(b, "<u4" if w else "<u2").astype(np.int32) for b, w in zip(*columns)]


def frequencies(tokens: DataFrame) -> np.ndarray:
    """How often each id occurs; as many numbers as the vocabulary has ids."""

    def count(batches):
        total = np.zeros(1, dtype=np.int64)
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                own = np.concatenate(_ids(batch.slice(low, 256)))
                more = np.bincount(own, minlength=len(total))
                more[: len(total)] += total
                total = more
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["id", "n"])

    rows = tokens.select("ids", "wide").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(max((r.id for r in rows), default=-1) + 1, dtype=np.int64)
    for r in rows:
        out[r.id] = r.n
    return out


def write_store(tokens: DataFrame, path: str, together: int = 32) -> None:
    """Code ``tokens`` (as of ``tokenize``) into a new store at ``path``."""
    spark = tokens.sparkSession
    freq = quantise(frequencies(tokens))
    spark.createDataFrame([(freq.tolist(),)], "freq array<bigint>").coalesce(1).write.parquet(f"{path}/table")
    shared = spark.sparkContext.broadcast(freq)

    def blocks(batches) -> Iterator[tuple]:
        keys, own, size = [], [], 0
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                rows = batch.slice(low, 256)
                for key, ids in zip(rows.column(0).to_pylist(), _ids(rows)):
                    keys.append(key)
                    own.append(ids)
                    size += len(ids)
                    if size >= BLOCK:
                        yield keys, own
                        keys, own, size = [], [], 0
        if own:
            yield keys, own

    def run(batches):
        table, part = Table(shared.value), TaskContext.get().partitionId()
        number = first = 0
        held: list[tuple] = []

        def coded():
            nonlocal number, first
            ids = [np.concatenate(own) for _, own in held]
            rows = []
            for (keys, own), flat, payload in zip(held, ids, encode_blocks(table, ids)):
                crc = zlib.crc32(flat.astype("<u4").tobytes())
                rows.append((part, number, first, keys, [len(i) for i in own], crc, payload))
                number += 1
                first += len(flat)
            held.clear()
            names = [c.split()[0] for c in BLOCKS.split(", ")]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        weight = 0
        for keys, own in blocks(batches):
            held.append((keys, own))
            weight = max(weight, sum(map(len, own)))
            if len(held) * weight >= together * BLOCK:
                yield coded()
                weight = 0
        if held:
            yield coded()

    # many rows of one id, or of none, are spread by their ids' hash, and equal rows by their place
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("ids")]
    ordered = tokens.repartitionByRange(shuffle_partitions(spark), *order, F.monotonically_increasing_id())
    ordered = ordered.sortWithinPartitions(*order, "ids").select("doc_id", "ids", "wide")
    ordered.mapInArrow(run, BLOCKS).write.option("compression", "none").parquet(f"{path}/blocks")


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, ids`` of every stored document; a wrong checksum raises."""
    stored = spark.read.parquet(f"{path}/blocks")
    row = spark.read.parquet(f"{path}/table").first()
    shared = spark.sparkContext.broadcast(np.array(row.freq if row else [], dtype=np.int64))
    parts = stored.groupBy("part").agg(F.max(F.col("first") + F.aggregate("sizes", F.lit(0).cast("long"), lambda a, b: a + b)).alias("n"))
    offsets, total = {}, 0
    for r in sorted(parts.collect()):  # a row per partition that wrote
        offsets[r.part], total = total, total + r.n

    def run(batches):
        table = Table(shared.value)
        for batch in batches:
            for low in range(0, batch.num_rows, 32):
                rows = batch.slice(low, 32).to_pydict()
                decoded = decode_blocks(table, rows["payload"])
                keys, starts, ids = [], [], []
                for part, first, own, sizes, crc, flat in zip(
                    rows["part"], rows["first"], rows["doc_ids"], rows["sizes"], rows["crc32"], decoded
                ):
                    raw = flat.astype("<u4").tobytes()
                    if zlib.crc32(raw) != crc:
                        raise ValueError(f"block of part {part} at {first} is damaged")
                    ends = segments(np.array(sizes)).tolist()
                    keys += own
                    starts += [offsets[part] + first + e for e in ends[:-1]]
                    ids += [raw[4 * a : 4 * b] for a, b in zip(ends[:-1], ends[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()), pa.array(starts, pa.int64()), pa.array(ids, pa.binary())],
                    names=["doc_id", "start", "ids"],
                )

    return stored.mapInArrow(run, "doc_id long, start long, ids binary")


def store_documents(docs: DataFrame, key: Column, text: Column, tokenizer: str, path: str, end: int = 2) -> DataFrame:
    """Tokenize, write a store at ``path`` and read it back: ``doc_id, start, ids``."""
    write_store(materialise(tokenize(docs, key, text, tokenizer, end), "tokens"), path)
    return read_store(docs.sparkSession, path)


def digest(stored: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of what a store holds."""
    return stored.select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )
