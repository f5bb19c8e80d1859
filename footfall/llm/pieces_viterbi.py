"""SentencePiece encoding and decoding by batched Viterbi search in numpy.

White space is escaped as the word mark and a mark is put before the text; the best-scoring
sequence of pieces is searched per segment (the marks before a word, and the word), because no
piece of such a vocabulary continues over a mark. All different segments of one length advance
together: at each end the 64-bit rolling hashes of the substrings probe the sorted keys of the
pieces of that length, and a vectorised maximum stores the backpointer. A character that no piece
holds becomes its UTF-8 bytes. Segments whose pieces don't spell them again (a hash collision) are
searched once more with a dictionary. A task remembers the segments it has met, up to a fixed number.

The scores of a unigram model are used as stored. A BPE model stores merge ranks, which are no log
probabilities; there a piece of rank r scores ``-log(r + 1)`` (Zipf's law).

Defined cases: null and empty texts have no ids and decode to an empty text; a mark in a text
decodes to a space; ties go to the longer last piece; repeated rows are encoded alike; an empty
table gives an empty table; further columns are ignored.
"""

from __future__ import annotations

import math
import re

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession

from footfall.llm.common import Shared, crc_of_ids, map_texts, numbered, ragged, segments

MARK = "▁"
BASE = 0x9E3779B97F4A7C15 | 1
UNKNOWN_PENALTY = 10.0  # fixed value of the format: below the lowest piece


class Pieces:
    """Vocabulary of a model file: texts, scores and byte pieces by id."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        stored = [model.get_score(i) for i in range(n)]
        special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(n)]
        self.bytes_of = [b""] * n
        self.byte_id = np.full(256, model.unk_id(), dtype=np.int32)
        self.score: dict[str, float] = {}
        self.id: dict[str, int] = {}
        normal = [i for i in range(n) if not special[i] and not model.is_byte(i)]
        ranks = all(stored[i] == int(stored[i]) <= 0 for i in normal)
        for i in range(n):
            if model.is_byte(i):
                value = int(model.id_to_piece(i)[3:-1], 16)
                self.byte_id[value], self.bytes_of[i] = i, bytes([value])
        for i in normal:
            piece = model.id_to_piece(i)
            if MARK in piece.lstrip(MARK):
                raise ValueError(f"piece {piece!r} continues over a word mark")
            self.bytes_of[i] = piece.encode()
            self.id[piece] = i
            self.score[piece] = -math.log(1 - stored[i]) if ranks else stored[i]
        self.unknown = min(self.score.values()) - UNKNOWN_PENALTY
        self.longest = max(map(len, self.id))
        alone = "".join(c for c in "\n\t\r" if not any(c in p for p in self.id))
        self.segment = re.compile(f"{MARK}*[^{MARK}{alone}]+|{MARK}+" + (f"|[{alone}]" if alone else ""))
        self.tables = {}
        for length in sorted({len(p) for p in self.id}):
            own = [p for p in self.id if len(p) == length]
            keys = hashes(code_points(own, length))[:, -1]
            order = np.argsort(keys)
            maybe = np.zeros(1 << 16, dtype=bool)
            maybe[keys >> np.uint64(48)] = True
            self.tables[length] = (
                maybe,
                keys[order],
                np.array([self.id[p] for p in own], dtype=np.int32)[order],
                np.array([self.score[p] for p in own])[order],
            )


def code_points(texts: list[str], length: int) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le"), dtype="<u4").reshape(len(texts), length)


def hashes(points: np.ndarray) -> np.ndarray:
    """Rolling hashes of all prefixes, the empty one first."""
    out = np.zeros((points.shape[0], points.shape[1] + 1), dtype=np.uint64)
    for i in range(points.shape[1]):
        out[:, i + 1] = out[:, i] * np.uint64(BASE) + (points[:, i].astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    return out


def best_by_dictionary(vocabulary: Pieces, segment: str) -> list[int]:
    """The same search, one segment at a time."""
    best = [(0.0, 0, -1)] + [(-math.inf, 0, -1)] * len(segment)
    for end in range(1, len(segment) + 1):
        for start in range(max(0, end - vocabulary.longest), end):
            piece = segment[start:end]
            known = piece in vocabulary.id
            if known or end - start == 1:
                score = best[start][0] + (vocabulary.score[piece] if known else vocabulary.unknown)
                if score > best[end][0]:
                    best[end] = (score, start, vocabulary.id.get(piece, -1))
    out, end = [], len(segment)
    while end:
        _, start, piece = best[end]
        out += [piece] if piece >= 0 else vocabulary.byte_id[list(segment[start:end].encode())].tolist()[::-1]
        end = start
    return out[::-1]


def viterbi(vocabulary: Pieces, words: list[str], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of ``words``, which all have ``length`` characters, one after another, and their counts."""
    prefix = np.ascontiguousarray(hashes(code_points(words, length)).T)
    n = len(words)
    best = np.full((length + 1, n), -np.inf)
    best[0] = 0.0
    start = np.zeros((length + 1, n), dtype=np.int32)
    chosen = np.full((length + 1, n), -1, dtype=np.int32)
    power = [1]
    for _ in range(length):
        power.append(power[-1] * BASE & 0xFFFFFFFFFFFFFFFF)
    for end in range(1, length + 1):
        top, origin, piece = best[end], start[end], chosen[end]
        for size in range(min(end, vocabulary.longest), 0, -1):
            if size == 1:  # a character counts as unknown unless a piece is found below
                total = best[end - 1] + vocabulary.unknown
                better = total > top
                top[better], origin[better], piece[better] = total[better], end - 1, -1
            if size not in vocabulary.tables:
                continue
            maybe, keys, ids, scores = vocabulary.tables[size]
            key = prefix[end] - prefix[end - size] * np.uint64(power[size])
            at = np.flatnonzero(maybe.take((key >> np.uint64(48)).view(np.int64)))
            own = key[at]
            place = np.searchsorted(keys, own)
            place[place == len(keys)] = 0
            hit = keys[place] == own
            at, place = at[hit], place[hit]
            total = best[end - size][at] + scores[place]
            better = total > top[at]
            at = at[better]
            top[at], origin[at], piece[at] = total[better], end - size, ids[place[better]]
    rows, back, steps = np.arange(n), np.full(n, length), []
    while back.any():
        steps.append(np.where(back > 0, chosen[back, rows], -2))
        back = np.where(back > 0, start[back, rows], 0)
    path = np.stack(steps[::-1], axis=1)
    used = path != -2
    flat, counts = path[used].astype(np.int32), used.sum(axis=1)
    if flat.min() >= 0 and b"".join([vocabulary.bytes_of[p] for p in flat.tolist()]) == "".join(words).encode():
        return flat, counts
    lists, ends = [], segments(counts)
    for i, word in enumerate(words):
        own = flat[ends[i] : ends[i + 1]].tolist()
        spelt = b"".join(vocabulary.bytes_of[p] for p in own) if min(own) >= 0 else None
        lists.append(own if spelt == word.encode() else best_by_dictionary(vocabulary, word))
    return np.array([p for own in lists for p in own], dtype=np.int32), np.array([len(own) for own in lists])


class Known:
    """Ids of the segments that a task has met; emptied when it holds ``most``."""

    def __init__(self, most: int = 1 << 19):
        self.most = most
        self.clear()

    def clear(self):
        self.place: dict[str, int] = {}
        self.flat = np.zeros(0, np.int32)
        self.counts = np.zeros(0, np.int64)

    def add(self, words: list[str], flat: list[np.ndarray], counts: list[np.ndarray]):
        self.place.update(zip(words, range(len(self.counts), len(self.counts) + len(words))))
        self.flat = np.concatenate([self.flat, *flat])
        self.counts = np.concatenate([self.counts, *counts])


def encode(vocabulary: Pieces, texts: list[str], known: Known | None = None, limit: int = 1 << 12) -> list[np.ndarray]:
    """Ids of each text. Segments over ``limit`` characters are searched by dictionary."""
    known = known or Known()
    if len(known.place) > known.most:
        known.clear()
    found = [vocabulary.segment.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
    codes, sizes, different = numbered(found)
    new = [s for s in different if s not in known.place]
    lengths = np.array([len(s) for s in new], dtype=np.int64)
    order = np.argsort(lengths, kind="stable")
    words, flat, counts = [], [], []
    for same in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1) if len(order) else []:
        length = int(lengths[same[0]])
        step = max(1, (1 << 19) // (length + 1))
        for low in range(0, len(same), step):
            part = [new[i] for i in same[low : low + step].tolist()]
            if length <= limit:
                ids, times = viterbi(vocabulary, part, length)
            else:
                lists = [best_by_dictionary(vocabulary, w) for w in part]
                ids, times = np.array([p for i in lists for p in i], np.int32), np.array([len(i) for i in lists])
            words += part
            flat.append(ids)
            counts.append(times)
    known.add(words, flat, counts)
    place = np.fromiter(map(known.place.__getitem__, different), np.int64, len(different))[codes]
    times = known.counts[place]
    everything = ragged(known.flat, segments(known.counts)[:-1][place], times)
    ends = segments(times)[segments(sizes)]
    return [everything[a:b] for a, b in zip(ends[:-1], ends[1:])]


def decode(vocabulary: Pieces, ids: np.ndarray) -> str:
    table = vocabulary.bytes_of
    text = b"".join([table[i] for i in ids.tolist()]).decode("utf-8", errors="replace").replace(MARK, " ")
    return text[1:] if text.startswith(" ") else text


def encode_documents(docs: DataFrame, key: Column, text: Column, path: str) -> DataFrame:
    """``doc_id, ids, decoded``: the ids and the text that they decode to."""
    shared, known = _share(docs.sparkSession, path), Known()

    def run(texts, rows):
        ids = encode(shared.value, texts, known)
        return {"doc_id": rows.column(1), "ids": ids, "decoded": [decode(shared.value, i) for i in ids]}

    return map_texts(docs, [text, key.cast("long").alias("doc_id")], run, "doc_id long, ids array<int>, decoded string")


def digest_documents(docs: DataFrame, key: Column, text: Column, path: str) -> DataFrame:
    """``doc_id, n_tokens, ids_crc32, n_chars, decodes``: sizes, and whether decoding restores the text."""
    shared, known = _share(docs.sparkSession, path), Known()

    def run(texts, rows):
        ids = encode(shared.value, texts, known)
        return {
            "doc_id": rows.column(1),
            "n_tokens": [len(i) for i in ids],
            "ids_crc32": [crc_of_ids(i) for i in ids],
            "n_chars": [len(t) for t in texts],
            "decodes": [decode(shared.value, i) == t.replace(MARK, " ") for i, t in zip(ids, texts)],
        }

    schema = "doc_id long, n_tokens long, ids_crc32 long, n_chars long, decodes boolean"
    return map_texts(docs, [text, key.cast("long").alias("doc_id")], run, schema)


def _share(spark: SparkSession, path: str):
    """The vocabulary, whose size the model file fixes, for all tasks."""
    return Shared(spark, Pieces(path))
